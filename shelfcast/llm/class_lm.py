"""Language-model scores by Brown classes.

The corpus is stored once as blocks of documents: a block's distinct words as 64-bit hashes, and its
texts as places in that list. Word counts are summed over the blocks and sent back to them, so no
task needs the whole vocabulary.

Words that the training tokens have ``min_count`` times or more, at any size of the corpus, are put
into ``n_classes`` classes, to start with by the one of the n_classes most frequent words that it stands
next to most, for that word's count. Then the exchange: in each round every block counts its words'
neighbours by class, the counts that are not zero meet by range of words, and each word of the half
whose turn it is moves to the class that raises the likelihood of class bigrams most, given the others'
classes. Rarer words form classes by the power of two of their count, unknown words a class of their
own. The driver and each task hold the hashes and classes of the words that are exchanged, so they grow
with the vocabulary; neighbour counts are held for ``held_counts`` of them at a time.

A token has the probability of its class after the previous token's class, smoothed with ``prior``
observations of the class itself, times its share of its class. As in the base, all unknown words
are one outcome beside the known ones; after every class it has the share of training tokens seen once,
and the probabilities of all outcomes add up to one. Scores of the known tokens alone are given as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import hashed_words, ship_code, stored

#: Stands for the end of a text among the word hashes.
END = np.uint64(0x00454E44)
RARE = 40  # classes of rare words, by power of two of the count
BLOCK = (
    "block long, held_out binary, doc_ids binary, no_id binary, lengths binary, places binary, "
    "words binary, trained binary"
)


@dataclass(frozen=True)
class ClassLmParams:
    n_classes: int = 32
    min_count: int = 20
    rounds: int = 8
    prior: float = 20.0
    block_tokens: int = 2_000_000
    range_words: int = 1024
    held_counts: int = 1_500_000


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _array(value: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(value), dtype=kind)


def _blocks(p: ClassLmParams):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number_of_block = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        tokens: list[np.ndarray] = []

        def block() -> pd.DataFrame:
            flat = np.concatenate(tokens)
            places, distinct = pd.factorize(flat)
            # frequent words get small numbers, equally frequent ones by their hashes
            order = np.lexsort((distinct, -np.bincount(places)))
            number = np.empty(len(order), dtype=np.int32)
            number[order] = np.arange(len(order), dtype=np.int32)
            places = number[places]
            lengths = np.array([len(t) for t in tokens], dtype=np.int64)
            held = np.array([r[1] for r in rows], dtype=np.bool_)
            trained = np.bincount(places[np.repeat(~held, lengths)], minlength=len(order))
            nonlocal number_of_block
            number_of_block += 1
            return pd.DataFrame(
                {
                    "block": [number_of_block],
                    "held_out": [_packed(held)],
                    "doc_ids": [_packed(np.array([r[0] or 0 for r in rows], dtype=np.int64))],
                    "no_id": [_packed(np.array([r[0] is None for r in rows], dtype=np.bool_))],
                    "lengths": [_packed(lengths)],
                    "places": [_packed(places.astype(np.int32))],
                    "words": [_packed(distinct[order].view(np.int64))],
                    "trained": [_packed(trained.astype(np.int64))],
                }
            )

        size = 0
        for docs in batches:
            ids = docs["id"].to_list()
            for doc_id, held, text in zip(ids, docs["held_out"], docs["text"], strict=True):
                tokens.append(np.append(hashed_words(text), END))
                rows.append((int(doc_id) if doc_id is not None else None, bool(held)))
                size += len(tokens[-1])
                if size >= p.block_tokens:
                    yield block()
                    rows, tokens, size = [], [], 0
        if rows:
            yield block()

    return run


def _words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for blocks in batches:
        for b in blocks.itertuples():
            words = _array(b.words, np.int64)
            yield pd.DataFrame(
                {
                    "block": b.block,
                    "place": np.arange(len(words), dtype=np.int32),
                    "word": words,
                    "trained": _array(b.trained, np.int64),
                }
            )


def _with_counts(frequent: Broadcast):
    """A block with its words' counts in the corpus and their places among the frequent words (-1
    for others) instead of their hashes and counts in the block."""

    def run(blocks: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        if not len(blocks):
            return pd.DataFrame({c: [] for c in COUNTED_COLUMNS}, dtype=object)
        n = _array(blocks["trained"].iloc[0], np.int64).copy()
        n[counts["place"].to_numpy()] = counts["n"].to_numpy()
        known = places_among(frequent.value, _array(blocks["words"].iloc[0], np.int64))
        return blocks.assign(known=[_packed(known.astype(np.int32))], counts=[_packed(n)])[COUNTED_COLUMNS]

    return run


def places_among(sorted_words: np.ndarray, words: np.ndarray) -> np.ndarray:
    if not len(sorted_words):
        return np.full(len(words), -1)
    at = np.minimum(np.searchsorted(sorted_words, words), len(sorted_words) - 1)
    return np.where(sorted_words[at] == words, at, -1)


COUNTED = BLOCK.replace("words binary, trained binary", "known binary, counts binary")
COUNTS = "range int, keys binary, counts binary"
COUNTED_COLUMNS = [c.split()[0] for c in COUNTED.split(", ")]


@dataclass(frozen=True)
class Model:
    """Classes of the frequent words; other words are classed by count. Classes from n_classes on
    are those of rare words, the last one that of unknown words."""

    classes: np.ndarray
    n_classes: int

    @property
    def total(self) -> int:
        return self.n_classes + RARE + 1

    def classes_of(self, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
        rare = self.n_classes + np.log2(np.maximum(counts, 1)).astype(np.int64)
        out = np.where(counts > 0, np.minimum(rare, self.total - 2), self.total - 1)
        return np.where(known >= 0, self.classes[known].astype(np.int64) if len(self.classes) else out, out)


def word_neighbours(
    places: np.ndarray,
    known: np.ndarray,
    cls: np.ndarray,
    c: int,
    bins: int = 4_000_000,
    due: np.ndarray | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """How often each known word of a block stands behind (left) and before (right) each class, as
    sorted keys and their counts; places are those of the training tokens, text after text. With due,
    a flag for each known word of the corpus, only the words that have it are counted. Counted in
    arrays of about ``bins`` numbers, a stretch of words at a time."""
    wanted = known >= 0 if due is None else np.append(due, False)[known]  # -1, other words, is the last
    at = np.flatnonzero(wanted[places])
    word, now = places[at], cls[places]
    # a text's first token comes after an end, as the last token of all is one
    earlier, later = now[at - 1], np.append(now, now[:1])[at + 1]
    found = np.flatnonzero(wanted)
    found = found[np.argsort(known[found])]
    step = max(1, bins // c)
    for i in range(0, len(found), step):
        words = found[i : i + step]
        bin_of = np.full(len(known), len(words))  # all other words share the last bin
        bin_of[words] = np.arange(len(words))
        first = bin_of[word] * c
        for near, side in ((earlier, 0), (later, c)):
            count = np.bincount(first + near, minlength=(len(words) + 1) * c)[: len(words) * c]
            at = np.flatnonzero(count)
            yield known[words].astype(np.int64)[at // c] * (2 * c) + side + at % c, count[at]


def _flags(bits: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(bits, count=n).astype(np.bool_)


def _previous(lengths: np.ndarray, n: int) -> np.ndarray:
    """For each token the place of the token before it, -1 at the start of a text."""
    before = np.arange(n) - 1
    before[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = -1
    return before


def _summed_keys(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and the sum of the counts of each."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, dtype=np.int64)
    return key[first], np.add.reduceat(count, first) if len(key) else count


def _neighbours(sent: Broadcast, p: ClassLmParams):
    """Counts of training bigrams by class: (range, keys, counts) with the counts of ``range_words``
    words by left and right class that are not zero, a key being the word's place in the range times
    twice the number of classes and the class (right ones behind the left ones), and as range -1 those
    of class bigrams. sent: the words' classes, and as packed bits which words are due; only those
    are counted."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classes, bits = sent.value
        model, due = Model(classes, p.n_classes), _flags(bits, len(classes))
        c = model.total
        pairs = np.zeros(c * c, dtype=np.int64)
        any_block = False
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        held = 0

        def parts() -> Iterator[pd.DataFrame]:
            key, count = _summed_keys(keys, counts)
            width = 2 * c * p.range_words
            ranges = key // width
            begin = np.flatnonzero(np.append(len(key) > 0, ranges[1:] != ranges[:-1]))
            stretches = list(zip(begin, np.append(begin, len(key))[1:], strict=True))
            yield pd.DataFrame(
                {
                    "range": [int(ranges[i]) for i, _ in stretches],
                    "keys": [
                        _packed(np.diff(key[i:j] - ranges[i] * width, prepend=0).astype(np.int32))
                        for i, j in stretches
                    ],
                    "counts": [_packed(count[i:j]) for i, j in stretches],
                }
            )

        for blocks in batches:
            for b in blocks.itertuples():
                any_block = True
                known, lengths = _array(b.known, np.int32), _array(b.lengths, np.int64)
                train = np.repeat(~_array(b.held_out, np.bool_), lengths)
                places = _array(b.places, np.int32)[train]
                cls = model.classes_of(known, _array(b.counts, np.int64))
                now = cls[places]
                pairs += np.bincount(np.roll(now, 1) * c + now, minlength=c * c)
                for key, count in word_neighbours(places, known, cls, c, due=due):
                    keys.append(key)
                    counts.append(count)
                    held += len(key)
                if held > p.held_counts:
                    key, count = _summed_keys(keys, counts)
                    keys, counts, held = [key], [count], len(key)
                    if 2 * held > p.held_counts:
                        yield from parts()
                        keys, counts, held = [], [], 0
        if any_block:
            yield pd.DataFrame({"range": [-1], "keys": [b""], "counts": [_packed(pairs)]})
            if keys:
                yield from parts()

    return run


def _dense(keys: bytes, counts: bytes, words: int, c: int) -> np.ndarray:
    """The counts of a range as rows of words and columns of left and right classes."""
    out = np.zeros(words * 2 * c, dtype=np.int64)
    out[np.cumsum(_array(keys, np.int32))] = _array(counts, np.int64)
    return out.reshape(words, 2 * c)


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds up the counts of each range that meet in a partition sorted by range."""
    now: int | None = None
    keys: list[np.ndarray] = []
    counts: list[np.ndarray] = []

    def row() -> pd.DataFrame:
        if now == -1:
            return pd.DataFrame({"range": [now], "keys": [b""], "counts": [_packed(np.sum(counts, axis=0))]})
        key, count = _summed_keys(keys, counts)
        packed = _packed(np.diff(key, prepend=0).astype(np.int32))
        return pd.DataFrame({"range": [now], "keys": [packed], "counts": [_packed(count)]})

    for rows in batches:
        for r, some_keys, some_counts in zip(rows["range"], rows["keys"], rows["counts"], strict=True):
            if r != now:
                if now is not None:
                    yield row()
                now, keys, counts = r, [], []
            if r >= 0:
                keys.append(np.cumsum(_array(some_keys, np.int32)).astype(np.int64))
            counts.append(_array(some_counts, np.int64))
            if len(counts) == 64:  # what is held stays near one range's size
                if r >= 0:
                    key, count = _summed_keys(keys, counts)
                    keys, counts = [key], [count]
                else:
                    counts = [np.sum(counts, axis=0)]
    if now is not None:
        yield row()


def _x_log_x(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchanged(
    left: np.ndarray, right: np.ndarray, own: np.ndarray, pairs: np.ndarray, n_classes: int
) -> np.ndarray:
    """The best class for each word, from its neighbour counts by class and the class bigrams.

    Moving a word with left counts l and right counts r into class h changes the likelihood by the
    growth of the bigrams (h, x) by r, of (x, h) by l, less that of the class's totals; its own
    class is rated as it would be without the word.
    """
    pairs = pairs.astype(np.float64)
    out_total, in_total = pairs.sum(axis=1), pairs.sum(axis=0)
    n_out, n_in = right.sum(axis=1), left.sum(axis=1)
    gain = np.empty((len(own), n_classes))
    bases = _x_log_x(pairs), _x_log_x(out_total), _x_log_x(in_total)
    for h in range(n_classes):
        gain[:, h] = (_x_log_x(pairs[h] + right) - bases[0][h]).sum(axis=1)
        gain[:, h] += (_x_log_x(pairs[:, h] + left) - bases[0][:, h]).sum(axis=1)
        gain[:, h] -= _x_log_x(out_total[h] + n_out) - bases[1][h]
        gain[:, h] -= _x_log_x(in_total[h] + n_in) - bases[2][h]
    # the words' own classes, without them
    row, column = np.maximum(pairs[own] - right, 0), np.maximum(pairs[:, own].T - left, 0)
    out_rest, in_rest = np.maximum(out_total[own] - n_out, 0), np.maximum(in_total[own] - n_in, 0)
    stays = (_x_log_x(row + right) - _x_log_x(row)).sum(axis=1)
    stays += (_x_log_x(column + left) - _x_log_x(column)).sum(axis=1)
    stays -= _x_log_x(out_rest + n_out) - _x_log_x(out_rest)
    stays -= _x_log_x(in_rest + n_in) - _x_log_x(in_rest)
    gain[np.arange(len(own)), own] = stays
    best = gain.argmax(axis=1)
    stay = gain[np.arange(len(own)), own] >= gain.max(axis=1) - 1e-9
    return np.where(stay, own, best)


def first_class(near: np.ndarray, own: np.ndarray, frequency: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """For each word the class of the frequent word it stands next to most, by its frequency; a
    frequent word stays in its class (own below the number of classes), others without such a
    neighbour go by spread."""
    n = len(frequency)
    rate = near[:, :n] / np.maximum(frequency, 1)
    found = np.where(rate.max(axis=1) > 0, rate.argmax(axis=1), spread % n)
    return np.where(own < n, own, found)


def learnt_classes(
    blocks: DataFrame, words: np.ndarray, counts: np.ndarray, p: ClassLmParams
) -> tuple[Model, np.ndarray]:
    """The exchange. words come sorted; the driver holds their counts and classes."""
    spread = ((words.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64)
    turn = (spread // p.n_classes) % 2
    top = np.lexsort((words, -counts))[: p.n_classes]
    classes = np.full(len(words), p.n_classes, dtype=np.int64)
    classes[top] = np.arange(len(top))
    frequency = np.zeros(p.n_classes)
    frequency[: len(top)] = counts[top]
    for r in range(-1, p.rounds + 1):
        model = Model(classes, p.n_classes)
        c = model.total
        starting, last_round = r < 0, r == p.rounds
        # half of the words may move in a round, and after the last one only the bigrams count
        turns = np.full(len(words), starting) if starting or last_round else turn == r % 2
        context = blocks.sparkSession.sparkContext
        sent = context.broadcast((classes.astype(np.int16), np.packbits(turns)))
        counted = (
            blocks.mapInPandas(_neighbours(sent, p), COUNTS)
            .repartition("range")
            .sortWithinPartitions("range")
            .mapInPandas(_summed, COUNTS)
        )
        if last_round:
            last = counted.where("range = -1").first()
            pairs = _array(last["counts"], np.int64).reshape(c, c) if last else np.zeros((c, c), dtype=np.int64)
            return model, pairs
        counted = stored(counted, "neighbours")
        first = counted.where("range = -1").first()
        if first is None:
            return model, np.zeros((c, c), dtype=np.int64)
        pairs = _array(first["counts"], np.int64).reshape(c, c)
        sent = context.broadcast((classes.astype(np.int16), np.packbits(turns), pairs))

        def moved(batches: Iterator[pd.DataFrame], n: int = p.n_classes, size: int = p.range_words):
            own, bits, between = sent.value
            due = _flags(bits, len(own))
            for rows in batches:
                for k, keys, counts in zip(rows["range"], rows["keys"], rows["counts"], strict=True):
                    mine = own[k * size : (k + 1) * size].astype(np.int64)
                    both = _dense(keys, counts, len(mine), len(between))
                    now = np.flatnonzero(due[k * size : (k + 1) * size])  # only these words may move
                    mine, both, at = mine[now], both[now], k * size + now
                    lefts, rights = np.hsplit(both.astype(np.float64), 2)
                    if starting:
                        new = [first_class(lefts + rights, mine, frequency, at)]
                    else:
                        new = [
                            exchanged(lefts[i : i + 256], rights[i : i + 256], mine[i : i + 256], between, n)
                            for i in range(0, len(both), 256)
                        ]
                    if not len(at):
                        continue
                    yield pd.DataFrame({"at": at, "class": np.concatenate(new)})

        found = counted.where("range >= 0").mapInPandas(moved, "at long, class long").toPandas()
        at, new = found["at"].to_numpy(dtype=np.int64), found["class"].to_numpy(dtype=np.int64)
        classes = classes.copy()
        classes[at] = new
        # a word without neighbours among the training tokens has no counts and goes by spread
        classes = np.where(classes < p.n_classes, classes, spread % p.n_classes)
    raise AssertionError


@dataclass(frozen=True)
class Corpus:
    n: int
    v: int
    once: int


def transition_logs(pairs: np.ndarray, corpus: Corpus, prior: float) -> np.ndarray:
    """log10 of the probability of each class after each class, rows adding up to one: the last class,
    the unknown words, has the same share of every row, and the known ones share the rest."""
    known = pairs[:, :-1].astype(np.float64)
    own = known.sum(axis=0)
    share = own / max(own.sum(), 1.0)
    smoothed = (known + prior * share) / (known.sum(axis=1, keepdims=True) + prior)
    unknown = unknown_share(corpus)
    rows = np.column_stack([smoothed * (1 - unknown), np.full(len(pairs), unknown)])
    return np.log10(np.maximum(rows, 1e-300))


def unknown_share(corpus: Corpus) -> float:
    floor = 0.5 / (corpus.n + 0.5 * (corpus.v + 1))
    return min(max(corpus.once / corpus.n if corpus.n else 1.0, floor), 0.5 if corpus.n else 1.0)


def _scores(classes: Broadcast, p: ClassLmParams, logs: np.ndarray, class_totals: np.ndarray, corpus: Corpus):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Model(classes.value, p.n_classes)
        floor = corpus.n + 0.5 * (corpus.v + 1)
        for blocks in batches:
            for b in blocks.itertuples():
                counts = _array(b.counts, np.int64)
                lengths, places = _array(b.lengths, np.int64), _array(b.places, np.int32)
                cls = model.classes_of(_array(b.known, np.int32), counts)
                within = np.log10(np.maximum(counts, 1) / np.maximum(class_totals[cls], 1))
                emission = np.where(counts > 0, within, 0.0)
                base = np.log10((counts + 0.5) / floor)
                now = cls[places]
                before = _previous(lengths, len(places))
                earlier = np.where(before >= 0, now[before], now[-1])
                starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                each = logs[earlier, now] + emission[places]
                score = np.add.reduceat(each, starts)
                seen = (counts > 0)[places]
                no_id = _array(b.no_id, np.bool_)
                ids = pd.array(_array(b.doc_ids, np.int64).copy(), dtype="Int64")
                ids[no_id] = pd.NA
                yield pd.DataFrame(
                    {
                        "doc_id": ids,
                        "held_out": _array(b.held_out, np.bool_),
                        "n_tokens": lengths,
                        "n_known": np.add.reduceat(seen.astype(np.int64), starts),
                        "train_tokens": corpus.n,
                        "base_score": np.add.reduceat(base[places], starts),
                        "score": score,
                        "known_base_score": np.add.reduceat(np.where(seen, base[places], 0), starts),
                        "known_score": np.add.reduceat(np.where(seen, each, 0), starts),
                        "perplexity": 10 ** np.minimum(-score / lengths, 300),
                    }
                )

    return run


SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double, known_base_score double, known_score double, "
    "perplexity double"
)


def class_lm_scores(docs: DataFrame, params: ClassLmParams) -> DataFrame:
    """One row per row of docs (doc_id, text): held_out (crc32 of doc_id as text is 1 modulo 5),
    counts of tokens, of those known from training and of all training tokens, the unigram base
    score and the class model's score, both log10 probabilities of the whole text, the same of its known
    tokens alone, and perplexity.

    Tokens are the words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end, so a null or
    empty text is one end. A null doc_id counts as the empty text in crc32. Repeated rows count and
    are scored each for itself; other columns are ignored; an empty table gives no rows.
    """
    p = params
    ship_code(docs.sparkSession)
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("string").alias("id"), (F.crc32(id_text) % 5 == 1).alias("held_out"), "text"
    )
    raw = stored(rows.mapInPandas(_blocks(p), BLOCK), "blocks")
    listed = raw.select("block", "words", "trained").mapInPandas(
        _words, "block long, place int, word long, trained long"
    )
    counts = stored(
        listed.where("trained > 0").groupBy("word").agg(F.sum("trained").alias("n")), "counts"
    )
    n, v, once = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)),
        F.count("*"),
        F.count(F.when(F.col("n") == 1, 1)),
    ).first()
    corpus = Corpus(n, v, once)
    frequent = counts.where(F.col("n") >= p.min_count)
    listed_words = frequent.select("word", "n").toPandas().sort_values("word")
    words, sizes = (listed_words[c].to_numpy(dtype=np.int64) for c in ("word", "n"))
    # a word that only one block has keeps the block's own count
    sent_back = listed.join(counts, "word").where("n <> trained").select("block", "place", "n")
    context = docs.sparkSession.sparkContext
    counted = _with_counts(context.broadcast(words))
    blocks = stored(
        raw.groupBy("block")
        .cogroup(sent_back.groupBy("block"))
        .applyInPandas(lambda a, b: counted(a, b), COUNTED),
        "counted",
    )
    model, pairs = learnt_classes(blocks, words, sizes, p)
    logs = transition_logs(pairs, corpus, p.prior)
    classes = context.broadcast(model.classes.astype(np.int16))
    return blocks.mapInPandas(_scores(classes, p, logs, pairs.sum(axis=0), corpus), SCORES)
