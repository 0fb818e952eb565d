"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates the vocabulary's pieces by the place where they end; dynamic
programming carries the best score and the number of pieces up to each place, and no pieces are
kept. Rules of ties and unknown characters are those of the unigram model in the ``tokenizers``
library: of equally good ways to reach a place the one with the longest last piece wins; a character
that is no piece costs ten less than the worst piece and falls back to its UTF-8 bytes. Scores are
the whole numbers stored in the vocabulary file, so sums are exact.

A text is normalised as its spaces becoming word marks, with one mark put before it. No piece holds
a mark after another character (checked when the vocabulary is read), nor a line break, so best
paths meet at these places and each stretch between them is counted for itself; stretches seen
before are looked up.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import ship_code

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Stretches that a worker remembers; when it is full, new ones are counted and not kept.
REMEMBERED = 600_000
LONGEST_REMEMBERED = 64


@dataclass(frozen=True)
class Vocabulary:
    """Pieces and scores, normal pieces only (no control, unknown or byte pieces)."""

    pieces: tuple[tuple[str, float], ...]

    @staticmethod
    def read(path: str) -> Vocabulary:
        """From a sentencepiece model file, about half a megabyte, on the driver."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return Vocabulary(
            tuple(
                (model.id_to_piece(i), model.get_score(i))
                for i in range(model.get_piece_size())
                if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
            )
        )


class Counter:
    def __init__(self, vocabulary: Vocabulary):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), score))
        if vocabulary.pieces:
            self.automaton.make_automaton()
        self.single = {p for p, _ in vocabulary.pieces if len(p) == 1}
        self.unknown = min((s for _, s in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY
        inner = any(re.search(f"[^{MARK}]{MARK}", p) for p, _ in vocabulary.pieces)
        breaks = any("\n" in p for p, _ in vocabulary.pieces)
        self.stretches = re.compile(
            r"[\s\S]+" if inner or breaks else f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n"
        )
        self.seen: dict[str, int] = {}

    def count_stretch(self, text: str) -> int:
        best: list[float] = [0.0] + [float("-inf")] * len(text)
        count = [0] * (len(text) + 1)
        single, unknown = self.single, self.unknown
        matches = self.automaton.iter(text) if len(self.automaton) else iter(())
        match = next(matches, None)
        for i, char in enumerate(text):
            top, pieces = float("-inf"), 0
            while match is not None and match[0] == i:
                size, score = match[1]
                before = i + 1 - size
                if best[before] + score > top:  # longest pieces come first
                    top, pieces = best[before] + score, count[before] + 1
                match = next(matches, None)
            if char not in single and best[i] + unknown > top:
                top, pieces = best[i] + unknown, count[i] + len(char.encode())
            best[i + 1], count[i + 1] = top, pieces
        return count[-1]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        total, seen = 0, self.seen
        for stretch in self.stretches.findall(MARK + text.replace(" ", MARK)):
            n = seen.get(stretch)
            if n is None:
                n = self.count_stretch(stretch)
                if len(seen) < REMEMBERED and len(stretch) <= LONGEST_REMEMBERED:
                    seen[stretch] = n
            total += n
        return total


@functools.lru_cache(maxsize=2)
def _counter(vocabulary: Vocabulary) -> Counter:
    return Counter(vocabulary)


def with_token_counts(docs: DataFrame, vocabulary: Vocabulary, name: str = "n_tokens") -> DataFrame:
    """docs with a column of the number of tokens of ``text``, 0 for a null or empty text.

    The vocabulary is broadcast; its size is that of its file, whatever the documents. Other columns
    and repeated rows stay; a column of the same name is replaced.
    """
    ship_code(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(sent.value)
        for texts in batches:
            yield pd.Series([counter.count(t) for t in texts], dtype="int64")

    return docs.withColumn(name, tokens(F.col("text")))


def token_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, characters and tokens of each row of docs; an empty table gives no rows."""
    counted = with_token_counts(docs.select("doc_id", "text"), vocabulary)
    n_chars = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    return counted.select("doc_id", n_chars.alias("text_chars"), "n_tokens")
