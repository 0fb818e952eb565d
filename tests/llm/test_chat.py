"""Chat formatting against a plain formatter, and back again."""

import itertools
import random

from pyspark.sql import functions as F

from shelfcast.llm.chat import AND, BEGIN, MARKS, format_chats, read_loss, read_turns
from tests.conftest import explained

SCHEMA = "conv_id long, turn long, role string, text string, segments int, Formatted string"
MARKED = ["<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "[OUT]", "[AND]", "[ROLE]", "[/ROLE]", "[/TURN]"]


def frame(spark, rows):
    return spark.createDataFrame([(*row, 1, "x") for row in rows], SCHEMA)


def told(df):
    df = format_chats(df)
    df = df.select("*", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("segments")).alias("learnt"))
    return {row.conv_id: row for row in df.collect()}


def safe(text):
    """Escapes mark by mark, without a pattern."""
    out, at = "", 0
    while at < len(text):
        for mark in MARKED:
            n = 0
            while text[at + 1 + n : at + 2 + n] == "\\":
                n += 1
            if text[at] == mark[0] and text[at + 1 + n :].startswith(mark[1:]):
                out += text[at] + "\\" * (n + 1) + mark[1:]
                at += 1 + n + len(mark) - 1
                break
        else:
            out += text[at]
            at += 1
    return out


def plain(turns):
    out = BEGIN
    for role, group in itertools.groupby(turns, key=lambda t: t[0]):
        opening, closing = MARKS.get(role, (f"[ROLE] {safe(role)} [/ROLE] ", "[/TURN]"))
        out += opening + AND.join(safe(text) for _, text in group) + closing
    return out


def expected(rows):
    chats = {}
    for conv, turn, role, text in rows:
        chats.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [t[2:] for t in sorted(turns)] for conv, turns in chats.items()}


def holds(spark, rows):
    found, chats = told(frame(spark, rows)), expected(rows)
    assert set(found) == set(chats)
    for conv, turns in chats.items():
        row = found[conv]
        assert row.formatted == plain(turns)
        assert row.formatted == "".join(s.text for s in row.segments)
        assert [tuple(t) for t in row.turns] == turns
        assert row.learnt == "".join(text for role, text in turns if role == "assistant")
        assert row.n_blocks == len(list(itertools.groupby(turns, key=lambda t: t[0])))


def test_usual_and_odd_conversations(spark):
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "user", "hello"), (1, 2, "assistant", "hi"),
        (2, 2, "assistant", "third"), (2, 0, "user", "first"), (2, 1, "user", "second"),
        (3, 0, "assistant", "a"), (3, 1, "assistant", ""), (3, 2, "assistant", None), (3, 3, "tool", "{}"),
        (4, 0, None, "x"), (4, None, "user", "before"), (4, 1, "", "y"),
        (5, 0, "user", "again"), (5, 0, "user", "again"), (5, 0, "assistant", "tie"),
        (None, 0, "user", "nobody"), (6, 0, None, None), (7, 0, "a] [/ROLE] <s>", "é\n\t "),
    ]
    holds(spark, rows)


def test_marks_in_texts_come_back(spark):
    rng = random.Random(3)
    pieces = [*MARKED, "\\", "\\\\", "<", "[", " ", "\n", "s>", "/INST]", "SYS>>", "$1", "ö", "ok", "[/", "</"]
    roles = ["user", "assistant", "system", "tool", "</s>", "[ROLE]", ""]
    rows = [
        (conv, turn, rng.choice(roles), "".join(rng.choices(pieces, k=rng.randrange(9))))
        for conv in range(150)
        for turn in range(rng.randrange(1, 9))
    ]
    holds(spark, rows)


def test_long_conversations_and_texts(spark):
    long = "</s> word " * 30_000
    rows = [(1, i, "user" if i % 3 else "assistant", f"{i}</s>") for i in range(6000)]
    holds(spark, [*rows, (2, 0, "user", long), (2, 1, "assistant", long)])


def test_empty_table(spark):
    assert format_chats(frame(spark, [])).collect() == []


def test_no_python_in_the_plan(spark):
    df = format_chats(frame(spark, [(1, 0, "user", "a")]))
    plan = explained(df.select(read_turns(F.col("formatted")), read_loss(F.col("segments"))))
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
