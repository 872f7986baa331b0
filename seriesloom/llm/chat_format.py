"""Prefix-target expansion of conversations.

Every assistant turn becomes an example: all turns before it are its context and
only the reply itself is trainable.  Turns after the last reply form one more
example without a target, so that no turn is lost.  Control strings inside texts
are escaped, and the text of an example can be read back turn by turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The control strings of the template.
OPEN, CLOSE = "<s>", "</s>"
MARKS = {"system": "SYS", "user": "INST", "assistant": "RESP"}
OTHER, COLON = "ROLE", "[:]"
CONTROLS = [OPEN, CLOSE, *(f"[{slash}{mark}]" for mark in [*MARKS.values(), OTHER] for slash in ("", "/")), COLON]

TURN = rf"(?s)\[({'|'.join([*MARKS.values(), OTHER])})\](.*?)\[/\1\]"


def escaped(text: Column) -> Column:
    """Backslashes doubled, and a backslash after the first character of every control string."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROLS:
        out = F.replace(out, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return out


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _head(turn: Column) -> Column:
    """What stands before the text of a turn."""
    out = F.concat(F.lit(f"[{OTHER}]"), escaped(turn["role"]), F.lit(COLON))
    for role, mark in MARKS.items():
        out = F.when(turn["role"] == role, F.lit(f"[{mark}]")).otherwise(out)
    return out


def _tail(turn: Column) -> Column:
    out = F.lit(f"[/{OTHER}]")
    for role, mark in MARKS.items():
        out = F.when(turn["role"] == role, F.lit(f"[/{mark}]")).otherwise(out)
    return out


def prefix_targets(
    conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Examples of every conversation: ``key``, example, n_turns, text, target_start, target_chars, last.

    ``text`` holds the turns up to and with the target; the target is ``target_chars`` code points from
    ``target_start`` (0-based) on, escaped as in the text; ``target_start`` is NULL if there is none.
    ``last`` marks the example that holds all turns.  Rows of a conversation are put in order of turn, role
    and text; NULL turns come first, NULL roles and texts are empty, NULL keys are one conversation, repeated
    rows are turns of their own.  Other columns are not read.  An empty table gives no example.
    """
    rows = conversations.select(
        F.col(key).alias("key"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        ).alias("row"),
    )
    ordered = rows.groupBy("key").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    parts = ordered.select(
        "key",
        F.transform(
            "rows",
            lambda t: F.struct(
                (t["role"] == "assistant").alias("reply"),
                _head(t).alias("head"),
                escaped(t["text"]).alias("body"),
                _tail(t).alias("tail"),
            ),
        ).alias("parts"),
    )
    ends = F.filter(
        F.transform("parts", lambda p, i: F.when(p["reply"] | (i + 1 == F.size("parts")), i + 1)),
        lambda i: i.isNotNull(),
    )
    examples = parts.select("key", "parts", F.posexplode(ends).alias("example", "n_turns"))
    whole = lambda p: F.concat(p["head"], p["body"], p["tail"])
    before = F.array_join(F.transform(F.slice("parts", 1, F.col("n_turns") - 1), whole), "")
    end = F.element_at("parts", F.col("n_turns"))
    out = examples.select(
        "key", "example", "n_turns", (F.col("n_turns") == F.size("parts")).alias("last"), before.alias("before"), end.alias("end")
    )
    return out.select(
        F.col("key").alias(key),
        F.col("example").cast("long").alias("example"),
        F.col("n_turns").cast("long").alias("n_turns"),
        F.concat(F.lit(OPEN), "before", whole(F.col("end")), F.lit(CLOSE)).alias("text"),
        F.when(F.col("end.reply"), F.length("before") + F.length("end.head") + len(OPEN)).cast("long").alias("target_start"),
        F.when(F.col("end.reply"), F.length("end.body")).cast("long").alias("target_chars"),
        "last",
    )


def target_of(examples: DataFrame) -> Column:
    """The trainable text, cut out of the formatted text and unescaped; empty without a target."""
    cut = F.substring(examples["text"], examples["target_start"].cast("int") + 1, examples["target_chars"].cast("int"))
    return F.coalesce(unescaped(cut), F.lit(""))


def turns_of(text: Column) -> Column:
    """Role and text of every turn, read back from a formatted text."""
    names = F.create_map(*[F.lit(x) for role, mark in MARKS.items() for x in (mark, role)])

    def read(turn: Column) -> Column:
        mark, body = F.regexp_extract(turn, TURN, 1), F.regexp_extract(turn, TURN, 2)
        other = mark == OTHER
        at = F.instr(body, COLON)
        return F.struct(
            F.when(other, unescaped(F.substr(body, F.lit(1), at - 1))).otherwise(names[mark]).alias("role"),
            unescaped(F.when(other, F.substr(body, at + len(COLON))).otherwise(body)).alias("text"),
        )

    return F.transform(F.regexp_extract_all(text, F.lit(TURN), F.lit(0)), read)
