"""Groups spelling variants with an index of variable-length grams.

1. A gram dictionary is pruned by frequency: a gram of more than ``q_min`` characters is in it if the
   gram without its last character is frequent. Rare grams thus stay short, frequent ones grow.
2. A word is decomposed from left to right: at each place the longest gram of the dictionary, or
   ``q_min`` characters, unless a gram before it covers it.
3. For each word the grams that one edit can change are counted, at most over all places of the
   edit: grams around it, grams before it that a longer gram could replace (some stretch up to the
   edit begins a gram of the dictionary) and, likewise, grams behind it. A near word therefore shares
   all but that many grams, at the same place or, behind an added character, one place further.
4. So two near words share one of their rarest grams: of as many as can change, and one more. Words
   are listed under these, with place and length. Where the bounds ask for two shared grams, the
   second is among one more of each word's rarest: the words of a list are merged by it in cells of
   bounded size. Pairs that share fewer grams than the larger of both words' bounds asks for are
   passed over, the others are compared character by character.

One edit leaves the first or the last gram of every word with ``2 * q_max`` characters or more, so no
word has an empty bound and no near word is lost; shorter limits are refused. A list of any length is
shared out over cells of two blocks; only near pairs leave a cell.

The dictionary holds grams with at least ``frequent / 64`` of all gram places, which bounds it at
``64 / frequent`` grams of each length whatever the alphabet; it goes to the driver and all tasks.
Grams are told apart by 64-bit hashes; words of one million different grams hold two equal ones with
a chance of 3 in 100 million.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import mixed, ship_code, stored

LETTERS = "A-Za-zÀ-ÿ"
TIMES = np.uint64(0xB5297A4D3F84D5B5)


@dataclass(frozen=True)
class VariantParams:
    min_chars: int = 7
    min_count: int = 2
    times: int = 10
    q_min: int = 2
    q_max: int = 3
    frequent: float = 1 / 2000
    block_rows: int = 16_384
    bin_rows: int = 60_000
    remembered_words: int = 200_000

    def __post_init__(self) -> None:
        if not 1 <= self.q_min <= self.q_max or 2 * self.q_max > self.min_chars:
            raise ValueError("q_min <= q_max <= min_chars / 2 is needed")


def _run_counts(p: VariantParams, typo_every: int | None):
    found = re.compile(f"[{LETTERS}]{{{p.min_chars},}}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()

        def given() -> pd.DataFrame:
            out = pd.DataFrame({"word": list(counts.keys()), "n": list(counts.values())})
            counts.clear()
            return out

        for batch in batches:
            for name, text in zip(batch["name"], batch["text"], strict=True):
                own = Counter(found.findall(text.encode().lower().decode()))  # bytes: A-Z only
                start = zlib.crc32(f"{name}:".encode())
                for word, n in own.items():
                    if typo_every:
                        h = zlib.crc32(word.encode(), start)
                        if h % typo_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < p.min_chars:
                                continue
                    counts[word] += n
                if len(counts) > p.remembered_words:
                    yield given()
        if counts:
            yield given()

    return run


def word_counts(docs: DataFrame, p: VariantParams, typo_every: int | None = None) -> DataFrame:
    """Stored rows (word, n): the words of at least min_chars code points that occur min_count times
    or more in docs (doc_id, text). Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, with
    A-Z lower-cased; a null text has none, a null doc_id counts as empty.

    With typo_every, words are misspelt on purpose: where it divides h, the crc32 of
    ``<doc_id>:<word>``, the word loses its code point ``h % length`` throughout that document.
    """
    ship_code(docs.sparkSession)
    texts = docs.where(F.col("text").isNotNull()).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name"), "text"
    )
    counts = texts.mapInPandas(_run_counts(p, typo_every), "word string, n long")
    return stored(counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= p.min_count), "words")


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """Hashes of the q-grams at each place of code points (words, places)."""
    places = max(codes.shape[1] - q + 1, 0)
    h = np.ones((codes.shape[0], places), dtype=np.uint64)
    for i in range(q):
        h = h * TIMES + codes[:, i : i + places].astype(np.uint64)
    return h


def _hashes_of(grams: set[str]) -> np.ndarray:
    by_length: dict[int, list[str]] = {}
    for g in grams:
        by_length.setdefault(len(g), []).append(g)
    parts = [gram_hashes(code_points(g), q)[:, 0] for q, g in by_length.items()]
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, dtype=np.uint64)


def code_points(words: list[str]) -> np.ndarray:
    """Code points (words, places) of words of one length."""
    joined = "".join(words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, dtype=np.uint32).reshape(len(words), -1)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(values.shape, dtype=bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


@dataclass(frozen=True)
class GramDictionary:
    """Sorted hashes of the dictionary's grams, of what begins and ends them, and gram counts."""

    q_min: int
    q_max: int
    grams: np.ndarray
    beginnings: np.ndarray
    endings: np.ndarray
    counted: np.ndarray
    counts: np.ndarray

    @staticmethod
    def of(q_min: int, q_max: int, counts: dict[str, int], grams: set[str]) -> GramDictionary:
        cut = range(q_min, q_max)
        hashes = {int(_hashes_of({g})[0]): n for g, n in counts.items()}
        counted = np.array(sorted(hashes), dtype=np.uint64)
        return GramDictionary(
            q_min,
            q_max,
            _hashes_of(grams),
            _hashes_of({g[:k] for g in grams for k in cut if k < len(g)}),
            _hashes_of({g[-k:] for g in grams for k in cut if k < len(g)}),
            counted,
            np.array([hashes[int(h)] for h in counted], dtype=np.int64),
        )

    def decomposed(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and lengths of each word's grams by place; length 0 where no gram starts."""
        n = codes.shape[1]
        grams = gram_hashes(codes, self.q_min)
        lengths = np.full(grams.shape, self.q_min, dtype=np.int64)
        for q in range(self.q_min + 1, self.q_max + 1):
            longer = gram_hashes(codes, q)
            known = _among(longer, self.grams)
            places = longer.shape[1]
            grams[:, :places] = np.where(known, longer, grams[:, :places])
            lengths[:, :places][known] = q
        end = np.full(len(codes), -1)
        for p in range(n - self.q_min + 1):
            last = p + lengths[:, p] - 1
            covered = last <= end
            lengths[covered, p] = 0
            end = np.maximum(end, last)
        return grams, lengths

    def changed(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The most grams of each word that one replaced or deleted character can change, and the
        most that one added character can."""
        m, n = codes.shape
        places = lengths.shape[1]
        reach_left = np.tile(np.arange(n + 1), (m, 1))
        reach_right = reach_left - 1
        for q in range(self.q_min, self.q_max):
            h = gram_hashes(codes, q)
            begins, ends = _among(h, self.beginnings), _among(h, self.endings)
            reach_left[:, q:] = np.where(begins, np.arange(n - q + 1), reach_left[:, q:])
            reach_right[:, : n - q + 1] = np.where(ends, np.arange(n - q + 1) + q - 1, reach_right[:, : n - q + 1])
        replaced, added = np.zeros(m, dtype=np.int64), np.zeros(m, dtype=np.int64)
        for i in range(n + 1):
            by_replacing, by_adding = np.zeros(m, dtype=np.int64), np.zeros(m, dtype=np.int64)
            for p in range(max(0, i - self.q_max), min(places, i + self.q_max)):
                there = lengths[:, p] > 0
                last = p + lengths[:, p] - 1
                left = there & (last < i) & (p >= reach_left[:, i])
                across = there & (last >= i)
                if p < i:
                    by_adding += left | across
                    by_replacing += left | across
                else:
                    by_adding += there & (last <= reach_right[:, i])
                    if p == i:
                        by_replacing += there
                    elif i < n:
                        by_replacing += there & (last <= reach_right[:, i + 1])
            added = np.maximum(added, by_adding)
            if i < n:
                replaced = np.maximum(replaced, by_replacing)
        return replaced, added

    def rarest(self, grams: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Places of each word's grams, rarest first, places without a gram last. The order is one
        of grams, equal ones by place."""
        counts = np.zeros(grams.shape, dtype=np.int64)
        if len(self.counted):
            at = np.minimum(np.searchsorted(self.counted, grams), len(self.counted) - 1)
            counts = np.where(self.counted[at] == grams, self.counts[at], 0)
        counts[lengths == 0] = np.iinfo(np.int64).max
        places = np.broadcast_to(np.arange(grams.shape[1]), grams.shape)
        return np.lexsort((places, grams, counts))


def gram_dictionary(words: DataFrame, p: VariantParams) -> GramDictionary:
    """The dictionary of words (word, n), each counted once."""
    word = F.col("word")
    total = words.agg(F.sum(F.greatest(F.length(word) - (p.q_min - 1), F.lit(0)))).first()[0] or 0
    counts: dict[str, int] = {}
    grams: set[str] = set()
    frequent: set[str] = set()
    for q in range(p.q_min, p.q_max + 1):
        places = F.sequence(F.lit(1), F.length(word) - (q - 1))
        every = words.where(F.length(word) >= q).select(
            F.explode(F.transform(places, lambda i, q=q: F.substring(word, i, F.lit(q)))).alias("gram")
        )
        if q > p.q_min:
            every = every.where(F.substring("gram", 1, q - 1).isin(sorted(frequent)))
        kept = every.groupBy("gram").count().where(F.col("count") >= p.frequent / 64 * total)
        found = {row["gram"]: row["count"] for row in kept.collect()}  # at most 64 / frequent rows
        counts |= found
        frequent = {g for g, n in found.items() if n > p.frequent * total}
        if q > p.q_min:
            grams |= found.keys()
    return GramDictionary.of(p.q_min, p.q_max, counts, grams)


def _by_length(words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the words of each length, and their code points."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield at, code_points(words[at].tolist())


def _list_keys(grams: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    return mixed(grams + places.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(length)).view(np.int64)


LISTED = "key long, home boolean, word string, n long, rank int, shift int, changed int"


def _listed(dictionary: GramDictionary):
    """A word under its rarest grams, with its own length (home) and, as the shorter word of a pair,
    with the next length; rank of the gram, places added to it, and how many grams an edit of that
    kind changes at most."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words, n = batch["word"].to_numpy(), batch["n"].to_numpy()
            for at, codes in _by_length(words):
                length = codes.shape[1]
                grams, lengths = dictionary.decomposed(codes)
                replaced, added = dictionary.changed(codes, lengths)
                order = dictionary.rarest(grams, lengths)
                have = (lengths > 0).sum(axis=1)
                found = []
                for rank in range(int(min(max(replaced.max(), added.max()) + 1, have.max()))):
                    place = order[:, rank]
                    gram = grams[np.arange(len(at)), place]
                    for home, shift, bound in ((True, 0, replaced), (False, 0, added), (False, 1, added)):
                        row = np.flatnonzero((rank <= bound) & (rank < have))
                        key = _list_keys(gram[row], place[row] + shift, length + (not home))
                        found.append((key, home, row, rank, shift, bound[row]))
                sizes = [len(f[0]) for f in found]
                row = at[np.concatenate([f[2] for f in found])]
                yield pd.DataFrame(
                    {
                        "key": np.concatenate([f[0] for f in found]),
                        "home": np.repeat([f[1] for f in found], sizes),
                        "word": words[row],
                        "n": n[row],
                        "rank": np.repeat([f[3] for f in found], sizes),
                        "shift": np.repeat([f[4] for f in found], sizes),
                        "changed": np.concatenate([f[5] for f in found]),
                    }
                )

    return run


def _packed(values: np.ndarray) -> np.ndarray:
    """Bytes (words, places), eight to a whole number: (words, ceil(places / 8))."""
    wide = np.zeros((len(values), -(-values.shape[1] // 8) * 8), dtype=np.uint8)
    wide[:, : values.shape[1]] = values
    return wide.view(np.uint64)


_LOW, _HIGH = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080)


def _equal_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The high bit of each byte in which a and b are equal."""
    x = a ^ b
    return ~(((x & _LOW) + _LOW) | x) & _HIGH


class _Words:
    """The words of a bin by length: code points, grams and their order, grams as bytes."""

    def __init__(self, words: np.ndarray, dictionary: GramDictionary):
        self.length = np.zeros(len(words), dtype=np.int64)
        self.row = np.zeros(len(words), dtype=np.int64)
        self.have = np.zeros(len(words), dtype=np.int64)
        self.codes: dict[int, np.ndarray] = {}
        self.grams: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.left: dict[int, np.ndarray] = {}
        self.right: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for at, codes in _by_length(words):
            n = codes.shape[1]
            grams, lengths = dictionary.decomposed(codes)
            self.length[at], self.row[at] = n, np.arange(len(at))
            self.have[at] = (lengths > 0).sum(axis=1)
            self.codes[n], self.grams[n] = codes, (grams, dictionary.rarest(grams, lengths))
            # a byte a gram: equal grams stay equal, and different ones that look equal only let a
            # pair through to the comparison of characters; no byte stands for no gram
            short = (mixed(grams) % np.uint64(254) + np.uint64(1)).astype(np.uint8)
            right = np.where(lengths > 0, short, 255).astype(np.uint8)
            self.left[n] = _packed(np.where(lengths > 0, short, 0).astype(np.uint8))
            self.right[n] = tuple(_packed(x) | _beyond(x.shape[1]) for x in (right, right[:, :-1], right[:, 1:]))

    def same(self, n: int, x: np.ndarray, y: np.ndarray, need: np.ndarray) -> np.ndarray:
        """Which pairs of words of length n share as many grams as needed and differ in one
        character."""
        row, other = self.row[x], self.row[y]
        equal = _equal_bytes(self.left[n][row], self.right[n][0][other])
        at = np.flatnonzero(_count(equal) >= need)
        codes = self.codes[n]
        return at[(codes[row[at]] != codes[other[at]]).sum(axis=1) == 1]

    def one_more(self, n: int, x: np.ndarray, y: np.ndarray, need: np.ndarray) -> np.ndarray:
        """The same for words x of length n that one added character turns into words y."""
        row, other = self.row[x], self.row[y]
        grams, (_, here, further) = self.left[n][row], self.right[n + 1]
        equal = _equal_bytes(grams, here[other]) | _equal_bytes(grams, further[other])
        at = np.flatnonzero(_count(equal) >= need)
        codes, more = self.codes[n][row[at]], self.codes[n + 1][other[at]]
        before = np.logical_and.accumulate(codes == more[:, :-1], axis=1).sum(axis=1)
        behind = np.logical_and.accumulate((codes == more[:, 1:])[:, ::-1], axis=1).sum(axis=1)
        return at[before + behind >= n]


def _beyond(places: int) -> np.ndarray:
    """255 in the bytes that fill up the last whole number."""
    filled = np.zeros((1, -(-places // 8) * 8), dtype=np.uint8)
    filled[:, places:] = 255
    return filled.view(np.uint64)


def _count(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits).astype(np.int64).sum(axis=1)


PAIRS_AT_ONCE = 250_000
NEAR = "word string, near string, near_n long"


def _seconds(words: _Words, name: np.ndarray, home: np.ndarray, rank: np.ndarray, shift: np.ndarray, changed: np.ndarray):
    """What a list is merged by: (row, key) for each row of a list and each gram that can be the
    second that it shares, which is one behind the list's own in the order of grams. Rows that may
    share one gram only have the key 0 too, under which they meet one another."""
    rows, keys = [np.flatnonzero(words.have[name] - changed <= 1)], []
    keys.append(np.zeros(len(rows[0]), dtype=np.uint64))
    for n in np.unique(words.length[name]):
        at = np.flatnonzero(words.length[name] == n)
        grams, order = words.grams[int(n)]
        own = words.row[name[at]]
        first = order[own, rank[at]]
        upto = np.minimum(changed[at] + 1, words.have[name[at]] - 1)
        for second in range(1, int(upto.max()) + 1):
            use = np.flatnonzero((second > rank[at]) & (second <= upto))
            place = order[own[use], second]
            key = mixed(grams[own[use], place] + place.astype(np.uint64) * TIMES) | np.uint64(1)
            later = mixed(grams[own[use], place] + (place + 1).astype(np.uint64) * TIMES) | np.uint64(1)
            behind, moved, short = place > first[use], shift[at[use]] == 1, ~home[at[use]]
            stays = ~short | ~(behind & moved)
            moves = short & (behind | moved)
            rows += [at[use[stays]], at[use[moves]]]
            keys += [key[stays], later[moves]]
    return np.concatenate(rows), np.concatenate(keys)


def _merged(dictionary: GramDictionary):
    """The near pairs of a bin of cells, both ways."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        names, texts = pd.factorize(rows["word"].to_numpy())
        words = _Words(np.asarray(texts, dtype=object), dictionary)
        counts = np.zeros(len(texts), dtype=np.int64)
        counts[names] = rows["n"].to_numpy()
        changed, homes = rows["changed"].to_numpy(), rows["home"].to_numpy().astype(bool)
        cells = rows.groupby(["key", "c1", "c2"], sort=False).ngroup().to_numpy()
        own, second = _seconds(words, names, homes, rows["rank"].to_numpy(), rows["shift"].to_numpy(), changed)
        length = words.length[names] + ~homes  # of the longer word
        sides = rows["side"].to_numpy()
        order = np.lexsort((~homes[own], sides[own], second, cells[own], length[own]))
        own, second = own[order], second[order]
        name, home, side, cell = names[own], homes[own], sides[own], cells[own]
        need, length = words.have[name] - changed[own], length[own]
        size = len(own)
        new = np.ones(size, dtype=bool)
        new[1:] = (cell[1:] != cell[:-1]) | (second[1:] != second[:-1]) | (length[1:] != length[:-1])
        number, starts = np.cumsum(new) - 1, np.flatnonzero(new)
        ends = np.append(starts[1:], size)[number] if size else starts

        def in_list(values: np.ndarray) -> np.ndarray:
            return np.add.reduceat(values.astype(np.int64), starts)[number] if size else values.astype(np.int64)

        # partners of a row lie together: homes, then shorter words, of its own or the other block
        other = starts[number] + in_list(side < 2)
        low = np.where(side == 0, np.arange(size) + 1, other)
        middle = np.where(side == 0, starts[number] + in_list((side == 0) & home), other + in_list((side == 2) & home))
        found = [np.empty(0, dtype=np.int64)]
        for from_, to, which, add in (
            (low, middle, home & (side < 2), 0),
            (middle, ends, home & (side < 2), 1),
            (low, middle, ~home & (side == 1), -1),
        ):
            many = np.where(which, np.maximum(to - from_, 0), 0)
            used = np.flatnonzero(many)
            edges = np.flatnonzero(np.diff(length[used])) + 1
            for part in np.split(used, edges):
                upto, first = np.cumsum(many[part]), 0
                while first < len(part):
                    done = upto[first - 1] if first else 0
                    last = max(int(np.searchsorted(upto, done + PAIRS_AT_ONCE, side="right")), first + 1)
                    at, n = part[first:last], many[part[first:last]]
                    i = np.repeat(at, n)
                    j = np.repeat(from_[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    asked = np.maximum(need[i], need[j])
                    i, j, long = name[i], name[j], int(length[at[0]])
                    if add == 0:
                        kept = words.same(long, i, j, asked)
                    elif add == 1:
                        kept = words.one_more(long - 1, j, i, asked)
                    else:
                        kept = words.one_more(long - 1, i, j, asked)
                    a, b = i[kept], j[kept]
                    found.append(np.unique(np.minimum(a, b) * len(texts) + np.maximum(a, b)))
                    first = last
        pairs = np.unique(np.concatenate(found))
        a, b = pairs // max(len(texts), 1), pairs % max(len(texts), 1)
        ab, ba = np.concatenate([a, b]), np.concatenate([b, a])
        return pd.DataFrame({"word": texts[ab], "near": texts[ba], "near_n": counts[ba]})

    return run


def near_words(words: DataFrame, p: VariantParams) -> DataFrame:
    """Rows (word, near, near_n), each once, for all words of (word, n) that are one inserted, deleted
    or replaced code point apart; every word is there once and has min_chars code points or more."""
    ship_code(words.sparkSession)
    dictionary = gram_dictionary(words, p)
    listed = stored(words.mapInPandas(_listed(dictionary), LISTED), "lists")
    sizes = listed.groupBy("key").agg(F.count("*").alias("rows"))
    long = stored(
        sizes.where(F.col("rows") > p.block_rows).select(
            "key", F.ceil(F.col("rows") / p.block_rows).cast("int").alias("blocks")
        ),
        "long-lists",
    )
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)
    cells = (
        listed.join(long, "key", "left")
        .withColumn("own", F.coalesce(own, F.lit(0)))
        .withColumn("other", F.explode(every))
        .select(
            "key",
            "home",
            "word",
            "n",
            "rank",
            "shift",
            "changed",
            F.least("own", "other").alias("c1"),
            F.greatest("own", "other").alias("c2"),
            F.when(F.col("own") == F.col("other"), 0)
            .when(F.col("own") < F.col("other"), 1)
            .otherwise(2)
            .alias("side"),
        )
    )
    bins = max(1, listed.count() // p.bin_rows)
    dealt = cells.withColumn("bin", F.pmod(F.xxhash64("key", "c1", "c2"), F.lit(bins)))
    merge = _merged(dictionary)
    found = dealt.groupBy("bin").applyInPandas(lambda rows: merge(rows), NEAR)
    return found.groupBy("word", "near").agg(F.max("near_n").alias("near_n"))


def spelling_variants(words: DataFrame, p: VariantParams) -> DataFrame:
    """Each word of (word, n) with n_near (how many words are one edit away), form (the near word of
    largest n, ties to the smallest, if that is at least ``times`` the word's own n; else null),
    form_n, and root: where following forms ends, the word itself if it has none.

    Words are distinct and of min_chars code points or more, as ``word_counts`` gives them. An empty
    table gives no rows.
    """
    best = (
        near_words(words, p)
        .groupBy("word")
        .agg(
            F.count("*").alias("n_near"),
            F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"),
        )
    )
    own = F.when(-F.col("best.less") >= p.times * F.col("n"), F.col("best"))
    told = stored(
        words.join(best, "word", "left").select(
            "word",
            own["near"].alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            (-own["less"]).alias("form_n"),
        ),
        "variants",
    )
    # Forms grow in n by ``times`` at least, so there is no circle; each round doubles the steps.
    roots = told.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = stored(
            roots.join(further, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("stepped")
            ),
            "roots",
        )
        roots = stepped.select("word", "root")
        if stepped.where("stepped").isEmpty():
            break
    return told.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
