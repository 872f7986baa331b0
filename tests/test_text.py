import json

import pytest
from pyspark.sql import functions as F

from seriesloom.functions import tokens as tok
from seriesloom.operators import text
from seriesloom.sources.readers import parse_messages


def tokens_of(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.select(tok.tokens(F.col("t")), "i").orderBy("i").collect()]


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("Hello, World", ["hello", ",", "world"]),
        ("call 555-123-4567 or +1 (555) 123 4567", ["call", "555-123-4567", "or", "+1 (555) 123 4567"]),
        ("see HTTP://T.co/AbC now", ["see", "HTTP://T.co/AbC", "now"]),
        (":) :-D <3 (: 8-)", [":)", ":-d", "<", "3", "(:", "8-)"]),
        ("<b>bold</b> <a href='http://X.Y'>", ["<b>", "bold", "</b>", "<a href='http://X.Y'>"]),
        ("@User_1 said #BigData #a ##x1", ["@user_1", "said", "#bigdata", "#", "a", "##x1"]),
        ("don't re-run a-b", ["don't", "re-run", "a-b"]),
        ("3.14 -2/3 10:30+ 7", ["3.14", "-2/3", "10:30+", "7"]),
        ("wait... . . .", ["wait", "... . . ."]),
        ("a &amp; b", ["a", "&", "amp", ";", "b"]),
        ("a &amp; b &lt; c", ["a", "and", "b", "&", "lt", ";", "c"]),
        ("été 日本 l'ami", ["été", "日本", "l'ami"]),
        ("ok 😀 x", ["ok", "😀", "x"]),
        ("  ", []),
    ],
)
def test_tokens(spark, given, expected):
    assert tokens_of(spark, given) == [expected]


def test_phone_numbers_have_seven_eight_ten_or_eleven_digits(spark):
    """Groups of three and four digits, an area code and a prefix of 0 or 1 before them; gaps may be absent."""
    whole = ["555-1234", "5551234", "555 . 1234", "1-555-1234", "212-555-1234", "(212)5551234", "+1 (212) 555-1234", "0 212.555.1234", "12125551234"]
    for number in whole:
        assert tokens_of(spark, f"x {number}, y") == [["x", number, ",", "y"]]
    for given, expected in (("55-1234", ["55-1234"]), ("555123", ["555123"]), ("9-555-1234", ["9-555-1234"]), ("(555)1234", ["(", "555", ")", "1234"]), ("123456789", ["12345678", "9"])):
        assert tokens_of(spark, given) == [expected]


@pytest.mark.parametrize("shape", tok.FACE_SHAPES)
def test_faces_of_every_shape_read_both_ways(spark, shape):
    signs = [tok.FACE_SIGNS[part] for part in shape.split()]
    faces = ["".join(s[i % len(s)] for s in signs) for i in range(12)]
    for face in [*faces, *(f[::-1] for f in faces)]:
        assert tokens_of(spark, f"a {face} b") == [["a", face.lower(), "b"]], face


def test_noses_and_hats_alone_are_no_faces(spark):
    assert tokens_of(spark, "- ) > 8 < o") == [["-", ")", ">", "8", "<", "o"]]


def test_words_keep_case_and_marks(spark):
    df = spark.createDataFrame([("You are  My sunshine\nmy only sunshine",)], "text string")
    counts = {r["word"]: r["n"] for r in text.word_counts(df).collect()}
    assert counts == {"You": 1, "are": 1, "My": 1, "sunshine": 2, "my": 1, "only": 1}


@pytest.fixture(scope="module")
def messages(spark):
    def message(user, body):
        return json.dumps({"created_at": "Mon", "user": {"id_str": user}, "text": body, "id_str": "1"})

    lines = [
        message("u1", "go go team"),
        message("u1", "go again"),
        message("u2", "team spirit"),
        message("u3", "go home"),
        message("stranger", "go away"),
        "{broken",
        '{"limit": {"track": 5}}',
        "[1]",
        "",
    ]
    return parse_messages(spark.createDataFrame([(line,) for line in lines], "value string"))


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame([("u1", 0), ("u2", 0), ("u3", 1)], "user_id string, group_id int")


def test_only_messages_pass(messages):
    assert messages.count() == 5
    assert messages.select("user_id").distinct().count() == 4


def test_users_not_messages_are_counted(messages):
    counts = {r["token"]: r["users"] for r in text.token_mentions(messages).collect()}
    assert counts["go"] == 3 and counts["team"] == 2 and counts["again"] == 1


def test_posts_per_group(messages, lookup):
    assert [tuple(r) for r in text.posts_per_group(messages, lookup).collect()] == [(0, 3), (1, 1), (7, 1)]


def test_relative_popularity(messages, lookup):
    got = text.relative_popularity(messages, lookup, min_users=2).collect()
    found = {(r["group_id"], r["token"]): r["popularity"] for r in got}
    third = pytest.approx(-1.584962500721156)
    assert found == {(0, "team"): 0.0, (0, "go"): third, (1, "go"): third, (7, "go"): third}
    assert [r["token"] for r in sorted(got, key=lambda r: (r["group_id"], r["rank"])) if r["group_id"] == 0] == ["team", "go"]


def test_ties_go_by_word(spark):
    df = spark.createDataFrame([("b a c a b d",)], "text string")
    top = text.most_common(text.word_counts(df), "word", "n", 3).collect()
    assert [r["word"] for r in top] == ["a", "b", "c"]


def test_long_texts_are_read_to_the_end(spark):
    body = "lead " + "filler words here " * 20000 + "zenith"
    df = spark.createDataFrame([("u", body)], "user_id string, text string")
    assert {r["token"] for r in text.token_mentions(df).collect()} == {"lead", "filler", "words", "here", "zenith"}
