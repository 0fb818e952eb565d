"""Chat formatting by relational means: DataFrame functions only.

The turns of a conversation are collected as structs and sorted, adjacent turns of one role are
merged into a block with array functions, and blocks are rendered between marks:

    <s>                                  before the conversation
    <<SYS>> ... <</SYS>>                 a system block
    [INST] ... [/INST]                   a user block
    [OUT] ... </s>                       an assistant block
    [ROLE] name [/ROLE] ... [/TURN]      a block of any other role
    [AND]                                between merged turns of a block

Texts and names are escaped so that no mark occurs in them: a backslash goes behind the first
character of each mark, and one more where backslashes stand there already; ``</s>`` becomes
``<\\/s>`` and ``<\\/s>`` becomes ``<\\\\/s>``. Taking one backslash away gives the text back, so the
output can be read back without loss, the turns inside a merged block too.

The result is a list of segments (text, loss); the formatted conversation is their concatenation,
and a model learns from segments with ``loss``: the texts of assistant turns and nothing between.
All steps are linear in the length of a conversation. A conversation becomes one row, as its text
does, so it must fit one; conversations themselves are shared out by their id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, END = "<s>", "</s>"
AND = "[AND]"
#: Opening and closing marks of the roles that have their own.
MARKS = {
    "system": ("<<SYS>>", "<</SYS>>"),
    "user": ("[INST] ", " [/INST]"),
    "assistant": ("[OUT] ", END),
}
ROLE, ROLE_END, TURN_END = "[ROLE] ", " [/ROLE] ", "[/TURN]"

#: Each mark without spaces, split behind its first character, where backslashes go.
_ANGLE, _SQUARE = r"(/?s>|</?SYS>>)", r"(/?INST\]|OUT\]|/?ROLE\]|/TURN\]|AND\])"
_MARK = rf"(<)(\\*){_ANGLE}|(\[)(\\*){_SQUARE}"
_ESCAPED = rf"(<)\\(\\*){_ANGLE}|(\[)\\(\\*){_SQUARE}"

_BLOCK = (
    r"(?s)<<SYS>>.*?<</SYS>>|\[INST\] .*? \[/INST\]|\[OUT\] .*?</s>"
    r"|\[ROLE\] .*? \[/ROLE\] .*?\[/TURN\]"
)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _MARK, r"$1$4\\$2$5$3$6")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$4$2$5$3$6")


def _by_role(role: Column, values: dict[str, Column], other: Column) -> Column:
    picked = F.when(role == "system", values["system"])
    for name in ("user", "assistant"):
        picked = picked.when(role == name, values[name])
    return picked.otherwise(other)


def _opening(role: Column) -> Column:
    own = F.concat(F.lit(ROLE), escaped(role), F.lit(ROLE_END))
    return _by_role(role, {r: F.lit(m[0]) for r, m in MARKS.items()}, own)


def _closing(role: Column) -> Column:
    return _by_role(role, {r: F.lit(m[1]) for r, m in MARKS.items()}, F.lit(TURN_END))


def _segments(block: Column) -> Column:
    """Opening mark, each turn's text with marks between, closing mark."""
    role, turns = block["role"], block["texts"]

    def plain(text: Column) -> Column:
        return F.struct(text.alias("text"), F.lit(False).alias("loss"))

    def inner(text: Column, i: Column) -> Column:
        own = F.struct(text.alias("text"), (role == "assistant").alias("loss"))
        return F.when(i == 0, F.array(own)).otherwise(F.array(plain(F.lit(AND)), own))

    return F.flatten(
        F.array(
            F.array(plain(_opening(role))),
            F.flatten(F.transform(turns, inner)),
            F.array(plain(_closing(role))),
        )
    )


def format_chats(conversations: DataFrame) -> DataFrame:
    """One row for each conversation of rows (conv_id, turn, role, text): conv_id, n_blocks, segments
    (array of struct text, loss) and formatted, their concatenation.

    Turns go by turn, nulls first, equal ones by role and text; repeated rows are turns of their
    own. A null text or role is taken as empty, and an empty role is a role without a name. Rows
    without a conv_id form one conversation. Other columns are ignored, whatever their names; an
    empty table gives no rows.
    """
    turns = conversations.select(
        F.col("conv_id"),
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    told = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    #: Places (from 0) at which the role changes: the blocks' first turns.
    first = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]),
    )
    placed = told.withColumn("firsts", first)

    def block(i: Column, k: Column) -> Column:
        end = F.coalesce(F.get("firsts", k + 1), F.size("turns"))
        texts = F.transform(F.slice("turns", i + 1, end - i), lambda t: escaped(t["text"]))
        return F.struct(F.get("turns", i)["role"].alias("role"), texts.alias("texts"))

    blocks = placed.select("conv_id", F.transform("firsts", block).alias("blocks"))
    begin = F.array(F.struct(F.lit(BEGIN).alias("text"), F.lit(False).alias("loss")))
    cut = blocks.select(
        "conv_id",
        F.size("blocks").cast("long").alias("n_blocks"),
        F.concat(begin, F.flatten(F.transform("blocks", _segments))).alias("segments"),
    )
    return cut.withColumn(
        "formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")
    )


def _inside(block: Column) -> Column:
    """Role and text parts (still escaped) of a block as it stands in a formatted text."""

    def own(role: str) -> Column:
        opening, closing = MARKS[role]
        text = F.substring(
            block, F.lit(len(opening) + 1), F.length(block) - len(opening) - len(closing)
        )
        return F.struct(F.lit(role).alias("role"), text.alias("text"))

    named = F.regexp_extract(block, r"(?s)^\[ROLE\] (.*?) \[/ROLE\] ", 1)
    skipped = F.length(named) + len(ROLE) + len(ROLE_END)
    rest = F.substring(block, skipped + 1, F.length(block) - skipped - len(TURN_END))
    return (
        F.when(F.startswith(block, F.lit("<<SYS>>")), own("system"))
        .when(F.startswith(block, F.lit("[INST]")), own("user"))
        .when(F.startswith(block, F.lit("[OUT]")), own("assistant"))
        .otherwise(F.struct(unescaped(named).alias("role"), rest.alias("text")))
    )


def read_turns(formatted: Column) -> Column:
    """The turns (array of struct role, text) of a formatted conversation, as they went in."""

    def turns(block: Column) -> Column:
        parts = F.split(block["text"], r"\[AND\]", -1)
        return F.transform(
            parts, lambda p: F.struct(block["role"].alias("role"), unescaped(p).alias("text"))
        )

    found = F.regexp_extract_all(formatted, F.lit(_BLOCK), F.lit(0))
    return F.flatten(F.transform(F.transform(found, _inside), turns))


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    learnt = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learnt, lambda s: unescaped(s["text"])), "")
