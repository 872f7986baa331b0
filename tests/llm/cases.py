"""Small tables that hold every awkward case."""

LONG = " ".join(f"word{i % 997}x{i}" for i in range(30_000))
PASSAGE = (
    "alpha beta gamma delta epsilon zeta, eta theta iota kappa lambda mu, nu xi omicron pi rho sigma. Tau upsilon phi chi psi omega "
    "one two three, four five six seven eight nine ten, eleven twelve thirteen fourteen fifteen. Sixteen seventeen eighteen nineteen, "
    "twenty and more words to make it fifty in all."
)

DOCUMENTS = [
    (1, "The cat sat on the mat. It was happy there, very happy indeed.\nBoilerplate line here\n", "en", "a"),
    (2, "The cat sat on the mat. It was happy there, very happy indeed.\nBoilerplate line here\n", "en", "a"),
    (3, "", "en", "a"),
    (4, None, "en", "a"),
    (5, " \n\t ", None, None),
    (6, LONG, "en", "b"),
    (7, LONG + " tail", "en", "b"),
    (8, f"Intro one two three. {PASSAGE} End of it\nBoilerplate line here", "de", "a"),
    (9, f"Quite another start; {PASSAGE} Different end\nBoilerplate line here", "de", "a"),
    (None, "A document without an id, but with words in it", None, "b"),
    (10, "naïve Ünïcode tëxt – 漢字かな交じり文 😀   İΣΑΣ don't", "xx", "c"),
    (11, "###$$$ %%% &&& <s>[INST] | |", "en", "c"),
    (12, "to to to to to to to to to to to to to to to to to to to to to to to to", "en", "c"),
    (13, "Short one.\nReleased under the MIT License.", "en", "c"),
]
REPEATED = [*DOCUMENTS, DOCUMENTS[0], DOCUMENTS[9]]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Names that the operators use inside.
CLASHING = "key string, uid string, doc string, n string, token string, term string, word string, host string, lines string, page string, kept string, label string"


def documents(spark, rows=REPEATED, clashing=False):
    frame = spark.createDataFrame(rows, SCHEMA)
    if clashing:
        from pyspark.sql import functions as F

        names = [part.split()[0] for part in CLASHING.split(", ")]
        frame = frame.select("*", *[F.lit("x").alias(name) for name in names])
    return frame


def counted(rows):
    """Rows as a sorted list, comparable whatever their order and NULLs."""
    return sorted(map(repr, rows))
