"""Tokens of informal text as native column expressions.

A token kind is built from small parts: sets of characters, and ways to put parts
together.  Earlier kinds win over later ones at the same position.  The grammar uses
explicit character classes and no look-around, so that any engine with
leftmost-first alternation finds the same tokens.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters of faces, and of URLs as the generic URI syntax lists them.
FACE_SIGNS = {"eyes": ":;=8", "nose": "-o*'", "mouth": ")]([dDpP/:}{@|\\", "hat": "<>"}
URI = "-._~:/?#[]@!$&'()*+,;=%"

FACE_SHAPES = ["hat eyes nose mouth", "hat eyes mouth", "eyes nose mouth", "eyes mouth"]  # longer ones first
PHONE_GROUPS = {11: (1, 3, 3, 4), 10: (3, 3, 4), 8: (1, 3, 4), 7: (3, 4)}  # longer ones first

SPACE = r"\x09-\x0d\x1c-\x20\x85\p{Z}"
WORD = r"\p{L}\p{N}_"
DIGIT = r"\p{Nd}"
LETTER = "A-Za-z"
MARK = "'_-"


def one_of(characters: str) -> str:
    """Any of these characters, small or capital."""
    both = dict.fromkeys(c for given in characters for c in (given, given.upper()))
    return "[" + "".join(c if c.isalnum() else f"\\x{ord(c):02x}" for c in both) + "]"


def joined(characters: str, marks: str) -> str:
    """Two or more runs of ``characters`` with ``marks`` between them."""
    return f"[{characters}]+(?:[{marks}]+[{characters}]+)+"


def either(parts: Iterable[str]) -> str:
    """One of the parts, the first that fits."""
    return "(?:" + "|".join(parts) + ")"


def phone(digits: int) -> str:
    """A number of so many digits in the groups of ``PHONE_GROUPS``, with any blanks, dots and dashes between groups.

    A single digit in front is a trunk prefix or country code of the North American plan; a group of three that others
    follow at least twice is an area code and may be in brackets.
    """
    groups = PHONE_GROUPS[digits]

    def spelled(place: int) -> str:
        size = groups[place]
        if size == 1:
            return r"\+?[01]"
        plain = f"{DIGIT}{{{size}}}"
        return either([rf"\({plain}\)", plain]) if size == 3 and place + 2 < len(groups) else plain

    return f"[-.{SPACE}]*".join(map(spelled, range(len(groups))))


def face(shape: str) -> str:
    """The signs of a shape one after the other, as ``FACE_SIGNS`` has them."""
    return "".join(one_of(FACE_SIGNS[part]) for part in shape.split())


def mirrored(shape: str) -> str:
    return " ".join(reversed(shape.split()))


URL = rf"[hH][tT][tT][pP][sS]?://(?:[{LETTER}0-9]|{one_of(URI)})+"
KINDS = {
    "phone": either(map(phone, PHONE_GROUPS)),
    "url": URL,
    "face": either(map(face, FACE_SHAPES)),
    "mirrored face": either(face(mirrored(shape)) for shape in FACE_SHAPES),
    "markup": "<[^<>]+>",
    "user": f"@[{WORD}]+",
    "topic": f"#+(?:{joined(WORD, MARK)}|[{WORD}]{{2,}})",  # a single character is no topic
    "word with marks inside": joined(LETTER, MARK),
    "number with separators": rf"[-+]?{joined(DIGIT, ',/.:-')}[-+]?",
    "word": f"[{WORD}]+",
    "dots": rf"\.(?:[{SPACE}]*\.)+",
    "anything else": f"[^{SPACE}]",
}
TOKEN = "|".join(KINDS.values())
NAMED_ENTITY = rf"&[{WORD}]+;"


def ampersands(text: Column) -> Column:
    """Spell out ``&amp;`` in texts that hold some other named entity as well.

    Entities stay encoded otherwise, so ``&amp;`` alone yields three tokens.
    """
    others = F.replace(text, F.lit("&amp;"), F.lit(" ")).rlike(NAMED_ENTITY)
    return F.when(others, F.replace(text, F.lit("&amp;"), F.lit(" and "))).otherwise(text)


def tokens(text: Column) -> Column:
    """Array of tokens in order; lower case, except that tokens with a URL keep theirs."""
    found = F.regexp_extract_all(ampersands(text), F.lit(TOKEN), F.lit(0))
    # The plain search keeps the pattern away from most tokens.
    return F.transform(found, lambda t: F.when(t.contains("://") & t.rlike(URL), t).otherwise(F.lower(t)))


def words(text: Column) -> Column:
    """Pieces between single spaces of each line; only empty pieces are dropped."""
    return F.filter(F.split(text, "[ \n]"), lambda w: w != "")
