"""Exact token counts of every prefix by dynamic programming over piece ends."""

from __future__ import annotations

import re
from array import array
from bisect import bisect_right
from collections.abc import Sequence
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.llm import tokens
from codeloom.llm.common import documents, map_columns

VOCABULARY = "piece_bpe_32k.model"
LIMIT = 4096
BLANK = "▁"
# A run of blanks with what follows it: no piece reaches over the start of such a stretch.
STRETCH = re.compile(f"{BLANK}+[^{BLANK}]*")
# Stretches a worker remembers, the longest it remembers, and pairs of pieces it remembers.
REMEMBERED = 600_000
LONGEST = 64
PAIRS = 1_000_000

Counts = Sequence[int]


class PrefixCounter:
    """Counts the pieces of all prefixes of a text, as the library's merges by score would give them.

    The pieces of a prefix end in the one piece that ends there and is compatible with the last piece of
    what stands before it: merging the two from single characters must leave just these two.
    So one table entry per place, the last piece, is enough, and each count is an earlier count plus one.
    """

    def __init__(self, path: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [
            i for i in range(library.get_piece_size())
            if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))
        ]
        self.scores = {library.id_to_piece(i): library.get_score(i) for i in normal}
        if any(BLANK in p.lstrip(BLANK) for p in self.scores):
            raise ValueError("the vocabulary has pieces that reach over a blank")
        # Pieces spelled backwards, one level per character; the empty key holds the piece.
        self.ends: dict = {}
        for piece in self.scores:
            level = self.ends
            for c in reversed(piece):
                level = level.setdefault(c, {})
            level[""] = piece
        self.pairs: dict[tuple[str, str], bool] = {}
        self.known: dict[str, Counts] = {}

    def merged(self, text: str) -> list[str]:
        """The pieces of ``text`` by merging the neighbours of the best score, leftmost first."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: str, right: str) -> bool:
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            wanted = [left, right] if left else [right]
            found = self.pairs[left, right] = self.merged(left + right) == wanted
        return found

    def stretch(self, text: str) -> Counts:
        """Token counts of the prefixes of 1, 2, ... characters of a stretch."""
        counts, last = [0], [""]
        ends, compatible = self.ends, self.compatible
        for end in range(1, len(text) + 1):
            level, at = ends, end
            while at and (level := level.get(text[at - 1])) is not None:
                at -= 1
                piece = level.get("")
                if piece is not None and compatible(last[at], piece):
                    counts.append(counts[at] + 1)
                    last.append(piece)
                    break
            else:
                # A character of no piece falls back to its bytes and joins nothing.
                counts.append(counts[-1] + len(text[end - 1].encode()))
                last.append("")
        counts = counts[1:]
        return bytes(counts) if max(counts) < 256 else array("I", counts)

    def stretches(self, text: str | None) -> tuple[list[str], list[Counts]]:
        """The stretches of a text behind the blank that the library puts in front, and their counts."""
        if not text:
            return [], []
        parts = STRETCH.findall(BLANK + text.replace(" ", BLANK))
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        counts = []
        for part in parts:
            found = known.get(part)
            if found is None:
                found = self.stretch(part)
                if len(part) <= LONGEST:
                    known[part] = found
            counts.append(found)
        return parts, counts


class Prefixes:
    """The counts of one text: answers what is asked of it without encoding again."""

    def __init__(self, counter: PrefixCounter, text: str | None):
        _, self.counts = counter.stretches(text)
        self.tokens = [0, *accumulate(c[-1] for c in self.counts)]
        # Characters of the text before each stretch; the blank in front is not one of them.
        self.chars = [0, *accumulate(map(len, self.counts))]

    def total(self) -> int:
        return self.tokens[-1]

    def at(self, chars: int) -> int:
        """Tokens of the first ``chars`` characters."""
        if chars <= 0:
            return 0
        part = bisect_right(self.chars, chars) - 1
        rest = chars + 1 - self.chars[part] if part < len(self.counts) else 0
        if part == len(self.counts):
            return self.tokens[-1]
        return self.tokens[part] + self.counts[part][rest - 1]

    def longest(self, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens."""
        if not self.counts or self.total() <= budget:
            return max(0, self.chars[-1] - 1)
        part = min(bisect_right(self.tokens, budget) - 1, len(self.counts) - 1)
        counts = self.counts[part]
        for length in range(len(counts), 0, -1):
            if self.tokens[part] + counts[length - 1] <= budget:
                return max(0, self.chars[part] + length - 1)
        return max(0, self.chars[part] - 1)

    def every(self) -> list[int]:
        """Tokens of the prefixes of 0, 1, 2, ... characters."""
        flat = [before + n for before, counts in zip(self.tokens, self.counts) for n in counts]
        return [0, *flat[1:]] if flat else [0]


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    """One counter per worker process and vocabulary."""
    return PrefixCounter(path)


def token_counts(docs: DataFrame, limit: int = LIMIT, vocabulary: str | None = None, every: bool = False) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit, kept_chars)``, one row per row; ``kept_chars`` are the
    characters of the longest prefix of at most ``limit`` tokens. With ``every`` also ``prefix_tokens``, the
    count at each prefix from the empty one on.

    Nothing but the text's own characters is counted: no begin, end or special tokens; special strings are
    text. Null and empty texts have no tokens; null ids stay null; repeated rows are each counted; an empty table
    gives an empty one. Nothing is shuffled, and a worker's memory holds a bounded table of stretches.
    """
    path = vocabulary or tokens.path(VOCABULARY)
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, kept_chars long"

    def batch(b: pa.RecordBatch) -> dict[str, object]:
        own = counter(path)
        out: dict[str, list] = {"n_bytes": [], "n_tokens": [], "over_limit": [], "kept_chars": [], "prefix_tokens": []}
        for text in b.column(1).to_pylist():
            prefixes = Prefixes(own, text)
            out["n_bytes"].append(len((text or "").encode()))
            out["n_tokens"].append(prefixes.total())
            out["over_limit"].append(prefixes.total() > limit)
            out["kept_chars"].append(prefixes.longest(limit))
            if every:
                out["prefix_tokens"].append(prefixes.every())
        return {"doc_id": b.column(0), **out}

    wanted = docs.select(F.col("doc_id").cast("long"), "text")
    return map_columns(wanted, batch, schema + (", prefix_tokens array<int>" if every else ""))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))
