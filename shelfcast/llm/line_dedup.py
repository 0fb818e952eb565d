"""Removal of repeated passages by the words they share.

A word goes if it is part of a run of ``min_words`` words or more that also starts at an earlier
place, in order of doc_id, row and word, wherever in a line or sentence the run starts and ends.
These are the words of all windows of ``min_words`` words that an earlier place has too. Words are
what lies between white space; which white space that is does not matter.

Not every window is compared. Of the numbers of the shorter runs in it a window selects the least,
its anchor, so equal windows have equal anchors. The windows next to one another with the same anchor
form a span (16 on average), and spans are what is counted:

* A window whose anchor occurs once is unique.
* Of spans with the same words all but the first go whole.
* First spans whose anchor other spans have too are the ends of repeated passages. Only their windows
  are compared one by one.

A text is also a sequence of lines: it is cut at line breaks and behind sentence ends (``.``, ``!``,
``?`` before any white space). Lines are only counted, before and those of which no word is left.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import mixed, ship_code, stored, with_row_ids

RUN = ("id", "row", "at", "size")
SPAN = "id long, row long, at int, size int, anchor long, name long"
WINDOW = "id long, row long, at int, name long"
FACTOR = 0x9E3779B97F4A7C15  # of a polynomial of word hashes modulo 2^64
CHUNK_WORDS = 250_000  # held at a time, or one text
LINE_END = re.compile(r"\n|(?<=[.!?])\s")
#: White space by code point; there is none above.
SPACE = np.array([chr(c).isspace() for c in range(0x3002)])
SPACES = "".join(chr(c) for c in np.flatnonzero(SPACE))
_SPACE = "[" + "".join(rf"\u{ord(c):04x}" for c in SPACES) + "]"
#: A line break or sentence end and the white space behind, but at the text's end, as a Java pattern.
LINE_GAP = rf"[.!?\n](?:(?<=\n)|{_SPACE}){_SPACE}*+(?!\z)"


@dataclass(frozen=True)
class LineParams:
    min_words: int = 50


def _cut_up(text: str) -> list[str]:
    """The text in parts that end with a line; joined by one character each they have its length."""
    return LINE_END.split(text)


def lines_of(text: str | None) -> list[str]:
    return [line for part in _cut_up(text) if (line := part.strip())] if text else []


class _Hashes(dict):
    """64-bit hashes of words; those first met are remembered, for one task."""

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < 100_000 and len(word) < 64:
            self[word] = value
        return value


class _Words:
    """The words of several texts one behind the other, and numbers for runs of them."""

    def __init__(self, hashes: list[np.ndarray]):
        ids = np.concatenate(hashes)
        lengths = np.array([len(h) for h in hashes], dtype=np.int64)
        self.ends = np.cumsum(lengths)
        self.begins = self.ends - lengths
        self.doc = np.repeat(np.arange(len(hashes)), lengths)
        power = np.full(len(ids) + 1, FACTOR, dtype=np.uint64)
        back = np.full(len(ids) + 1, pow(FACTOR, -1, 1 << 64), dtype=np.uint64)
        power[0] = back[0] = 1
        self.back = np.cumprod(back)
        self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(ids * np.cumprod(power)[:-1])])

    def names(self, at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """One number for each run of size words from place at."""
        value = (self.sums[at + size] - self.sums[at]) * self.back[at]
        return mixed(value + np.asarray(size).astype(np.uint64))


def _chunks(batches: Iterator[pd.DataFrame], min_words: int) -> Iterator[tuple[pd.DataFrame, _Words]]:
    """The rows whose texts have min_words words or more, some at a time, with their words."""
    hashes = _Hashes()
    for docs in batches:
        rows: list[int] = []
        held: list[np.ndarray] = []
        size = 0
        for n, text in enumerate(docs["text"]):
            found = text.split() if text else ()
            if len(found) >= min_words:
                rows.append(n)
                held.append(np.fromiter(map(hashes.__getitem__, found), dtype=np.uint64, count=len(found)))
                size += len(found)
            if size >= CHUNK_WORDS:
                yield docs.iloc[rows], _Words(held)
                rows, held, size = [], [], 0
        if rows:
            yield docs.iloc[rows], _Words(held)


def anchor_width(min_words: int) -> int:
    """Of how many runs a window selects one: a power of two, about two thirds of its words at most."""
    return 1 << max(0, (2 * (min_words + 1) // 3).bit_length() - 1)


def selected(names: np.ndarray, width: int) -> np.ndarray:
    """For each place the place of the least of the width names from there on, the first of equals."""
    at = np.arange(max(0, len(names) - width + 1) and len(names))
    step = 1
    while step < width:
        first, second = at[:-step], at[step:]
        at = np.where(names[second] < names[first], second, first)
        step *= 2
    return at


def _spans(min_words: int):
    """From (id, row, text) to the spans: their first window's first word, number of windows, anchor
    and the number of all their words."""
    width = anchor_width(min_words)
    short = min_words - width + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for docs, words in _chunks(batches, min_words):
            n = len(words.doc)
            names = words.names(np.arange(n - short + 1), short)
            anchors = selected(names, width)
            starts = np.arange(len(anchors))
            starts = starts[starts + min_words <= words.ends[words.doc[: len(anchors)]]]
            chosen = anchors[starts]
            begin = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1]))
            size = np.diff(np.append(begin, len(starts)))
            at = starts[begin]
            doc = words.doc[at]
            yield pd.DataFrame(
                {
                    "id": docs["id"].to_numpy()[doc],
                    "row": docs["row"].to_numpy()[doc],
                    "at": (at - words.begins[doc]).astype(np.int32),
                    "size": size.astype(np.int32),
                    "anchor": names[chosen[begin]].view(np.int64),
                    "name": words.names(at, size + min_words - 1).view(np.int64),
                }
            )

    return run


def _every(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places from each begin on, size of them."""
    return np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())


def _windows(min_words: int):
    """From (id, row, text, ats, sizes) to the windows of these spans."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for docs, words in _chunks(batches, min_words):
            counts = docs["ats"].map(len).to_numpy()
            begin = np.concatenate(docs["ats"].to_list()).astype(np.int64)
            size = np.concatenate(docs["sizes"].to_list()).astype(np.int64)
            begin += np.repeat(words.begins, counts)
            at = _every(begin, size)
            doc = words.doc[at]
            yield pd.DataFrame(
                {
                    "id": docs["id"].to_numpy()[doc],
                    "row": docs["row"].to_numpy()[doc],
                    "at": (at - words.begins[doc]).astype(np.int32),
                    "name": words.names(at, min_words).view(np.int64),
                }
            )

    return run


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """The rows whose key others have too; the distinct keys are the side that is hashed. They are
    stored first, as AQE splits the rows of a hot key only where the join follows its shuffle."""
    keys = rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key)
    return rows.join(stored(keys, "keys").hint("shuffle_hash"), key, "left_semi")


def _per_text(rows: DataFrame, size: Column) -> DataFrame:
    return rows.groupBy("id", "row").agg(
        F.collect_list("at").alias("ats"), F.collect_list(size).alias("sizes")
    )


def repeated_runs(rows: DataFrame, params: LineParams) -> DataFrame:
    """Rows (id, row, at, size): runs of ``size`` words from word ``at`` that also start earlier;
    from rows (id, row, text)."""
    n = max(1, params.min_words)
    place = F.struct("id", "row", "at")
    spans = stored(_shared(stored(rows.mapInPandas(_spans(n), SPAN), "spans"), "anchor"), "shared")
    firsts = stored(
        spans.groupBy("name").agg(
            F.count("*").alias("n"),
            F.min(place).alias("first"),
            F.first("anchor").alias("anchor"),
            F.first("size").alias("size"),
        ),
        "firsts",
    )
    copied = firsts.where("n > 1").select("name", "first")
    copies = (
        spans.join(copied.hint("shuffle_hash"), "name")
        .where(place != F.col("first"))
        .select("id", "row", "at", (F.col("size") + F.lit(n - 1)).alias("size"))
    )
    ends = stored(_per_text(_shared(firsts.select("first.*", "anchor", "size"), "anchor"), F.col("size")), "ends")
    windows = rows.join(ends.hint("shuffle_hash"), ["id", "row"]).select("id", "row", "text", "ats", "sizes")
    windows = stored(windows.mapInPandas(_windows(n), WINDOW), "windows")
    earliest = windows.groupBy("name").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    earliest = stored(earliest.where("n > 1").select("name", "first"), "earliest")
    again = (
        windows.join(earliest.hint("shuffle_hash"), "name")
        .where(place != F.col("first"))
        .select("id", "row", "at", F.lit(n).alias("size"))
    )
    return copies.unionByName(again)


def line_count(text: Column) -> Column:
    """The number of lines with words, as ``cut_text`` counts them; 0 for null."""
    begun = F.ltrim(text, F.lit(SPACES))
    return F.when(begun != "", F.regexp_count(begun, F.lit(LINE_GAP)) + 1).otherwise(0)


def cut_text(text: str | None, at: np.ndarray, size: np.ndarray) -> tuple[str | None, int, int]:
    """The text without the runs of words, its number of lines before, and of those of which no word
    is left. A run goes with the white space behind it, or with that before it if only the one behind
    has a line break."""
    if not text:
        return text, 0, 0
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    space = SPACE[np.minimum(codes, len(SPACE) - 1)]
    begins = np.flatnonzero(~space & np.append(True, space[:-1]))
    ends = np.flatnonzero(~space & np.append(space[1:], True)) + 1
    if not len(begins):
        return text, 0, 0
    stops = (codes == ord(".")) | (codes == ord("!")) | (codes == ord("?"))
    breaks = (codes == ord("\n")) | (space & np.append(False, stops[:-1]))
    line = np.cumsum(breaks)[begins]
    line = np.cumsum(np.append(False, line[1:] != line[:-1]))
    n_lines = int(line[-1]) + 1
    gone = np.zeros(len(begins) + 1, dtype=np.int64)
    np.add.at(gone, at, 1)
    np.add.at(gone, at + size, -1)
    gone = np.cumsum(gone)[:-1] > 0
    if not gone.any():
        return text, n_lines, 0
    n_removed = n_lines - len(np.unique(line[~gone]))
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]]))).reshape(-1, 2)
    parts, done = [], 0
    for i, j in edges.tolist():
        if i == 0:
            parts.append(text[: begins[0]])
        else:
            before = text[ends[i - 1] : begins[i]]
            behind = text[ends[j - 1] : begins[j]] if j < len(begins) else ""
            parts += [text[done : ends[i - 1]], behind if "\n" in behind and "\n" not in before else before]
        done = begins[j] if j < len(begins) else len(text)
    return ("".join(parts) + text[done:]).rstrip(), n_lines, n_removed


def _cut(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """For texts that lose words; null for the others, which do not come here."""
    for texts, ats, sizes in batches:
        yield pd.DataFrame(
            [
                (None, 0, 0) if a is None else cut_text(t, np.asarray(a, np.int64), np.asarray(s, np.int64))
                for t, a, s in zip(texts, ats, sizes, strict=True)
            ],
            columns=["text", "n_lines", "n_removed"],
        )


def dedup_lines(docs: DataFrame, params: LineParams) -> DataFrame:
    """Rows (doc, text, n_lines, n_removed), one per row of docs: all its columns as the struct
    ``doc``, the text without later copies of repeated passages, the lines it had and those of which
    nothing is left. Of a line that a passage starts or ends in, the other words stay.

    Null and empty texts stay as they are, without lines. Rows of one doc_id are put in an order of
    their own, rows without doc_id come first; of a repeated row all copies but the first lose the
    runs that are long enough. Within a run that overlaps its own copy, all behind the first period
    goes. An empty table gives no rows.
    """
    ship_code(docs.sparkSession)
    rows = with_row_ids(docs)
    runs = repeated_runs(rows.select("id", "row", F.col("doc.text").alias("text")), params)
    per_doc = _per_text(runs, F.col("size"))
    cut = F.pandas_udf(_cut, "text string, n_lines int, n_removed int")
    whole, text = F.col("ats").isNull(), F.col("doc.text")
    sent = F.when(~whole, text)  # only texts that lose words are sent to Python
    return (
        rows.join(stored(per_doc, "removals").hint("shuffle_hash"), ["id", "row"], "left")
        .select("doc", "ats", cut(sent, F.col("ats"), F.col("sizes")).alias("cut"))
        .select(
            "doc",
            F.when(whole, text).otherwise(F.col("cut.text")).alias("text"),
            F.when(whole, line_count(text)).otherwise(F.col("cut.n_lines")).alias("n_lines"),
            F.col("cut.n_removed").alias("n_removed"),
        )
    )
