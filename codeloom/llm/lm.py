"""Bigram language model: Elias-Fano tries by shard, and scores of whole texts."""

from __future__ import annotations

import math
from array import array
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.llm.common import documents, hits_remainder, map_columns, split_words, written
from codeloom.llm.eliasfano import LOW, Trie, mapped, narrow

FOLDS, HELD_FOLD = 5, 1
# Tokens that one block of documents and one shard of the model hold on average.
BLOCK_TOKENS = 1_000_000
# Others that a block, a node between or a shard hears from and sends to, at most.
FAN = 256
# Contexts that may be spread over shards are more frequent than one in so many tokens, so they are fewer.
HOT = 65_536
# Weight of the lower order, in tokens.
PRIOR = 200.0
# Quantised log10 probabilities: code 1 to 255 stand for so much each, code 0 for none.
STEP = 0.04
# Hashes of what is no word: words are bytes without blanks, these names have one.
START = xxhash.xxh64_intdigest(b"start of text", 7)
END = xxhash.xxh64_intdigest(b"end of text", 7)
MASK = np.uint64((1 << LOW) - 1)


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 7)


def coded(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10 / STEP) + 1, 1, 255).astype(np.uint8)


def uncoded(codes: np.ndarray) -> np.ndarray:
    return np.where(codes == 0, 0.0, 10.0 ** (-(codes.astype(float) - 1) * STEP))


def unigrams(docs: DataFrame) -> DataFrame:
    """``(word, n)`` counts of ``docs(text, train)``, summed up per batch before the shuffle.

    ``word`` is the hash of a word as a long; the end of each text counts as a token, its start is counted too.
    """

    def batch(b: pa.RecordBatch) -> dict[str, object]:
        counts: Counter = Counter()
        rows = 0
        for text, train in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if train:
                counts.update(split_words((text or b"").lower()))
                rows += 1
        hashes = [word_hash(w) for w in counts] + ([START, END] if rows else [])
        return {
            "word": np.array(hashes, np.uint64).view(np.int64).tolist(),
            "n": [*counts.values(), *([rows, rows] if rows else [])],
        }

    return map_columns(docs.select("text", "train"), batch, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Demand:
    """Contexts in order of hash with their counts, and pairs in order of context number and successor with theirs."""

    contexts: np.ndarray
    counts: np.ndarray
    owner: np.ndarray
    successor: np.ndarray
    n: np.ndarray


class Numbers(dict):
    """Numbers of words in the order they are met, after those of the start and the end."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) + 2
        return number


class Block:
    """The distinct words and word pairs of some texts, and where they stand."""

    def __init__(self, texts: list[bytes | None]):
        numbers = Numbers()
        flat = array("q")
        sizes = []
        for text in texts:
            words = split_words((text or b"").lower())
            flat.append(0)
            flat.extend(map(numbers.__getitem__, words))
            flat.append(1)
            sizes.append(len(words) + 1)
        self.words = np.array([START, END, *map(word_hash, numbers)], np.uint64)
        ids = np.array(flat, np.int64)
        self.sizes = np.array(sizes, np.int64)
        # Each token but the start with what stands before it.
        token = np.flatnonzero(ids != 0)
        self.tokens = ids[token]
        pair = (ids[token - 1] << 32) | self.tokens
        self.pairs, self.pair_of = np.unique(pair, return_inverse=True)
        self.left, self.right = self.pairs >> 32, self.pairs & 0xFFFFFFFF
        self.text_of = np.repeat(np.arange(len(sizes)), self.sizes)
        # Places of words and pairs in a demand.
        self.by_hash = np.argsort(self.words, kind="stable")
        rank = np.empty_like(self.by_hash)
        rank[self.by_hash] = np.arange(len(self.by_hash))
        key = (rank[self.left].astype(np.uint64) << np.uint64(LOW)) | (self.words[self.right] & MASK)
        self.pair_order = np.argsort(key, kind="stable")
        self.owner = rank[self.left][self.pair_order]

    def demand(self, words: np.ndarray | None = None, pairs: np.ndarray | None = None) -> Demand:
        """What the block asks for, with its own counts of ``words`` and ``pairs`` where they are given."""
        counts = np.zeros(len(self.words), np.int64) if words is None else words
        n = np.zeros(len(self.pairs), np.int64) if pairs is None else pairs
        successor = self.words[self.right[self.pair_order]] & MASK
        return Demand(self.words[self.by_hash], counts[self.by_hash], self.owner, successor, n[self.pair_order])


@dataclass
class Part:
    """What of a demand goes to one node: places of contexts, which of them are counted there, places of pairs, and
    their contexts' places among the part's."""

    node: int
    contexts: np.ndarray
    at_home: np.ndarray
    pairs: np.ndarray
    owner: np.ndarray


@dataclass(frozen=True)
class Route:
    """How demands get from blocks to shards: in ``levels`` steps, each of which settles one digit of the shard.

    The node of level j has the first j digits of a shard and the last ``levels - j`` of a block, so
    it hears from at most ``fan`` nodes, whose demands it adds up, and sends to at most ``fan``. Level 0 are the blocks, the last
    level are the shards. Pairs lie with their context, those of a ``hot`` one all over.
    """

    shards: int
    fan: int
    levels: int
    hot: np.ndarray
    totals: np.ndarray

    @staticmethod
    def through(shards: int, fan: int, hot: dict[int, int]) -> Route:
        levels = 1
        while fan**levels < shards:
            levels += 1
        width = 1
        while width**levels < shards:
            width += 1
        names = np.array(sorted(hot), np.uint64)
        return Route(shards, width, levels, names, np.array([hot[h] for h in sorted(hot)], np.int64))

    def frequent(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which contexts are hot, and the whole counts of those that are."""
        if not len(self.hot):
            return np.zeros(len(contexts), bool), np.zeros(len(contexts), np.int64)
        place = np.minimum(np.searchsorted(self.hot, contexts), len(self.hot) - 1)
        among = self.hot[place] == contexts
        return among, np.where(among, self.totals[place], 0)

    def parts(self, level: int, node: int, asked: Demand) -> list[Part]:
        here, below = self.fan ** (self.levels - level), self.fan ** (self.levels - level - 1)
        home = (asked.contexts % np.uint64(self.shards)).astype(np.int64)
        spread = ((asked.successor * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)) % np.uint64(self.shards)
        moved = np.where(self.frequent(asked.contexts)[0][asked.owner], spread.astype(np.int64), 0)
        of_pair = (home[asked.owner] + moved) % self.shards // below
        # Contexts of another digit so far are here only for pairs.
        own = np.flatnonzero(home // here == node // here)
        size = max(len(asked.contexts), 1)
        wanted = np.unique(np.concatenate((home[own] // below * size + own, of_pair * size + asked.owner)))
        group, context = wanted // size, wanted % size
        order = np.argsort(of_pair, kind="stable")
        place = np.searchsorted(wanted, of_pair[order] * size + asked.owner[order])
        digits, first = np.unique(group, return_index=True)
        last = np.append(first[1:], len(group))
        edges = np.searchsorted(of_pair[order], np.append(digits, digits[-1:] + 1))
        out = []
        for i, digit in enumerate(digits.tolist()):
            contexts, pairs = context[first[i] : last[i]], slice(edges[i], np.searchsorted(of_pair[order], digit, "right"))
            to = digit * below + node % here % below
            out.append(Part(to, contexts, home[contexts] // below == digit, order[pairs], place[pairs] - first[i]))
        return out

    def sent(self, level: int, node: int, asked: Demand) -> pa.Table:
        """Rows ``(node, source, asked)`` of the next level."""
        parts = self.parts(level, node, asked)
        tries = [
            Trie.encode(asked.contexts[p.contexts], np.where(p.at_home, asked.counts[p.contexts], 0), p.owner, asked.successor[p.pairs], asked.n[p.pairs])
            for p in parts
        ]
        return pa.table(
            {
                "node": pa.array([p.node for p in parts], pa.int64()),
                "source": pa.array([node] * len(parts), pa.int64()),
                "asked": pa.array(tries, pa.binary()),
            }
        )

    def gathered(self, level: int, node: int, asked: Demand, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Counts of all contexts and codes of all pairs of a demand, from what the nodes of the next level answered."""
        counts, codes = np.zeros(len(asked.contexts), np.int64), np.zeros(len(asked.owner), np.uint8)
        found = {s: (c, q) for s, c, q in zip(*(answers.column(n).to_pylist() for n in ("source", "counts", "codes")))}
        for part in self.parts(level, node, asked):
            c, q = found[part.node]
            n = np.frombuffer(c, f"<u{len(c) // max(len(part.contexts), 1) or 1}")
            counts[part.contexts[part.at_home]] = n[part.at_home]
            codes[part.pairs] = np.frombuffer(q, "<u1")
        return counts, codes


SENT = "node long, source long, asked binary"
ANSWERED = "node long, source long, counts binary, codes binary"


def _answer_rows(node: int, table: pa.Table, counts: list[np.ndarray], codes: list[np.ndarray]) -> pa.Table:
    """Answers of ``node`` to each row of ``table(source)``: they go where the demands came from."""
    return pa.table(
        {
            "node": table.column("source"),
            "source": pa.array([node] * table.num_rows, pa.int64()),
            "counts": pa.array([narrow(c).tobytes() for c in counts], pa.binary()),
            "codes": pa.array([c.astype(np.uint8).tobytes() for c in codes], pa.binary()),
        }
    )


def added_up(tries: list[Trie]) -> tuple[Demand, list[np.ndarray], list[np.ndarray]]:
    """One demand from several, and for each where its contexts and its pairs are in the sum."""
    contexts, inverse = np.unique(np.concatenate([t.contexts.all() for t in tries]), return_inverse=True)
    counts = np.zeros(len(contexts), np.int64)
    np.add.at(counts, inverse, np.concatenate([t.context_payload for t in tries]).astype(np.int64))
    edges = np.cumsum([0, *(t.contexts.size for t in tries)])
    of_context = [inverse[a:b] for a, b in zip(edges[:-1], edges[1:])]
    keys = []
    for t, places in zip(tries, of_context):
        own, rest = t.pairs()
        keys.append((places[own].astype(np.uint64) << np.uint64(LOW)) | rest)
    key, place = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.zeros(len(key), np.int64)
    np.add.at(n, place, np.concatenate([t.payload for t in tries]).astype(np.int64))
    edges = np.cumsum([0, *map(len, keys)])
    of_pair = [place[a:b] for a, b in zip(edges[:-1], edges[1:])]
    return Demand(contexts, counts, (key >> np.uint64(LOW)).astype(np.int64), key & MASK, n), of_context, of_pair


def _tries(table: pa.Table) -> list[Trie]:
    return [Trie(x) for x in table.column("asked").to_pylist()]


def _requests(route: Route):
    def run(table: pa.Table) -> pa.Table:
        block = Block(table.column("text").to_pylist())
        train = np.array(table.column("train").to_pylist(), bool)
        learns = train[block.text_of]
        words = np.bincount(block.tokens[learns], minlength=len(block.words))
        words[0] = train.sum()
        pairs = np.bincount(block.pair_of[learns], minlength=len(block.pairs))
        return route.sent(0, table.column("block")[0].as_py(), block.demand(words, pairs))

    return run


def _passed_on(route: Route, level: int):
    def run(table: pa.Table) -> pa.Table:
        return route.sent(level, table.column("node")[0].as_py(), added_up(_tries(table))[0])

    return run


def _passed_back(route: Route, level: int):
    def run(asked: pa.Table, answers: pa.Table) -> pa.Table:
        node = asked.column("node")[0].as_py()
        whole, of_context, of_pair = added_up(_tries(asked))
        counts, codes = route.gathered(level, node, whole, answers)
        return _answer_rows(node, asked, [counts[p] for p in of_context], [codes[p] for p in of_pair])

    return run


def build(counted: Demand, totals: np.ndarray) -> bytes:
    """One trie of the model; ``totals`` are the whole counts of hot contexts, 0 for others."""
    used = np.flatnonzero(counted.n)
    owner, n = counted.owner[used], counted.n[used]
    whole = np.where(totals > 0, totals, counted.counts)
    share = coded(np.log10(n) - np.log10(whole[owner] + PRIOR)) if len(used) else np.empty(0, np.uint8)
    return Trie.encode(counted.contexts, counted.counts, owner, counted.successor[used], share)


def _answers(route: Route):
    def run(table: pa.Table) -> pa.Table:
        asked = _tries(table)
        counted, of_context, of_pair = added_up(asked)
        model = Trie(mapped(build(counted, route.frequent(counted.contexts)[1])))
        # Each distinct question is looked up once.
        wanted = model.find_contexts(counted.contexts)
        place = model.find(wanted[counted.owner], counted.successor)
        codes = np.where(place >= 0, model.payload[place] if model.successors.size else 0, 0).astype(np.uint8)
        counts = model.context_payload[wanted]
        return _answer_rows(table.column("node")[0].as_py(), table, [counts[p] for p in of_context], [codes[p] for p in of_pair])

    return run


def _scores(route: Route, tokens: int, distinct: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(docs.column("text").to_pylist())
        found, codes = route.gathered(0, docs.column("block")[0].as_py(), block.demand(), answers)
        counts = np.zeros(len(block.words))
        share = np.zeros(len(block.pairs))
        counts[block.by_hash] = found
        share[block.pair_order] = uncoded(codes)
        plain = (counts + 0.5) / (tokens + 0.5 * (distinct + 1))
        mixed = share + PRIOR / (counts[block.left] + PRIOR) * plain[block.right]
        texts = len(block.sizes)

        def summed(values):
            return np.bincount(block.text_of, values, minlength=texts)

        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "held_out": docs.column("held_out"),
                "n_tokens": pa.array(block.sizes),
                "n_known": pa.array(summed((counts > 0)[block.tokens]).astype(np.int64)),
                "train_tokens": pa.array(np.full(texts, tokens, np.int64)),
                "base_score": pa.array(summed(np.log10(plain)[block.tokens])),
                "score": pa.array(summed(np.log10(mixed)[block.pair_of])),
            }
        )

    return run


def score_held_out(
    docs: DataFrame, folds: int = FOLDS, held: int = HELD_FOLD, block_tokens: int = BLOCK_TOKENS, fan: int = FAN
) -> DataFrame:
    """Scores of all rows of ``docs(doc_id, text)`` by a model of those outside fold ``held``.

    Columns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``. A word's
    probability after another is its share of what follows there plus a weight for its own smoothed share, the
    weight falling with how often the context was seen (a Dirichlet prior of ``PRIOR`` tokens).

    Documents are dealt into blocks by a hash. A block asks the shards for its distinct words and pairs, as
    small tries; a shard adds up all counts, builds its trie of the model, maps it into memory
    and answers with exact word counts and one byte per pair. Demands and answers pass through nodes that
    add up, so that each block, node and shard deals with at most ``fan`` others (``Route``): the rows between them grow
    with the corpus and the number of levels, one level up to ``fan`` shards. Pairs lie with their context; contexts
    above a quarter of a shard and above a ``HOT``-th of all tokens, fewer than ``HOT`` in all, are spread by
    successor and their totals known to all tasks. Words are known by 64-bit hashes, successors of a context by 40 bits.

    Null and empty texts are one end token; a null doc_id is in no held-out fold, so it is learned from; repeated
    rows are each learned and scored; an empty table gives an empty one, a table with
    nothing to learn from gives every token the smoothed share of nothing.
    """
    spark = docs.sparkSession
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(
        doc_id.alias("doc_id"), F.col("text").cast("binary").alias("text"), hits_remainder(doc_id, folds, held).alias("held_out")
    )
    rows = rows.withColumn("train", ~F.col("held_out"))
    counts = written(unigrams(rows), "lm-words")
    start = START - (1 << 64) if START >> 63 else START
    total = counts.where(F.col("word") != start).agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    tokens, distinct = total["n"] or 0, total["v"]
    shards = max(1, math.ceil(tokens / block_tokens))
    hot = counts.where(F.col("n") * min(4 * shards, HOT) > tokens).collect() if shards > 1 else []
    route = Route.through(shards, fan, {r["word"] % (1 << 64): r["n"] for r in hot})

    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("long").alias("block")
    dealt = rows.select("doc_id", "text", "held_out", "train", block)
    asked = [dealt.groupBy("block").applyInArrow(_requests(route), SENT)]
    for level in range(1, route.levels):
        # Read again on the way back.
        asked[-1] = written(asked[-1], f"lm-asked-{level}")
        asked.append(asked[-1].groupBy("node").applyInArrow(_passed_on(route, level), SENT))
    answers = asked.pop().groupBy("node").applyInArrow(_answers(route), ANSWERED)
    for level in range(route.levels - 1, 0, -1):
        answers = asked.pop().groupBy("node").cogroup(answers.groupBy("node")).applyInArrow(_passed_back(route, level), ANSWERED)
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.groupBy("block").cogroup(answers.groupBy("node")).applyInArrow(_scores(route, tokens, distinct), schema)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_held_out(documents(spark, sf_dir))
