"""Elias-Fano against plain arrays, and the model against dictionaries."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from codeloom.llm import lm
from codeloom.llm.eliasfano import LOW, EliasFano, Trie, mapped

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_sequence_equals_plain_array():
    draw = np.random.default_rng(1)
    for size, top in ((0, 1), (1, 1), (1, 2**64 - 1), (5, 3), (300, 2**64 - 1), (5000, 10_000), (2000, 2**52), (700, 2**63)):
        values = np.sort(draw.integers(0, top, size, dtype=np.uint64, endpoint=True))
        data = b"x" + EliasFano.encode(values) + b"tail"
        ef = EliasFano(mapped(data), 1)
        assert data[ef.end :] == b"tail" and (ef.all() == values).all()
        wanted = np.concatenate((values, draw.integers(0, top, 200, dtype=np.uint64, endpoint=True), values + np.uint64(1)))
        assert (ef.successor(wanted) == np.searchsorted(values, wanted)).all()


def test_trie_finds_what_it_holds_and_nothing_else():
    draw = np.random.default_rng(2)
    contexts = np.unique(draw.integers(0, 2**64 - 1, 400, dtype=np.uint64))
    owner = np.sort(draw.integers(0, len(contexts), 3000))
    successor = draw.integers(0, 50, 3000).astype(np.uint64)
    key = np.unique((owner.astype(np.uint64) << np.uint64(LOW)) | successor)
    owner, successor = (key >> np.uint64(LOW)).astype(np.int64), key & np.uint64((1 << LOW) - 1)
    payload = draw.integers(0, 255, len(key)).astype(np.uint8)
    trie = Trie(mapped(Trie.encode(contexts, np.arange(len(contexts)), owner, successor, payload)))
    assert (trie.find_contexts(contexts) == np.arange(len(contexts))).all()
    assert (trie.find_contexts(contexts + np.uint64(1)) == -1).all()
    held = {(a, b): p for a, b, p in zip(owner.tolist(), successor.tolist(), payload.tolist())}
    ask = [(a, b) for a in range(-1, len(contexts)) for b in range(0, 55, 3)]
    found = trie.find(np.array([a for a, _ in ask]), np.array([b for _, b in ask], np.uint64))
    assert [None if p < 0 else trie.payload[p] for p in found] == [held.get(x) for x in ask]


def test_demands_reach_their_shards_through_few_nodes():
    """Whatever the number of shards, nobody has more than ``fan`` partners, and every pair and word arrives once at its shard."""
    draw = np.random.default_rng(3)
    for shards, fan in ((1, 4), (4, 4), (5, 4), (30, 4), (64, 4), (65, 4)):
        words = np.unique(draw.integers(0, 2**64 - 1, 60, dtype=np.uint64))
        route = lm.Route.through(shards, fan, {int(words[0]): 9, int(words[7]): 5})
        assert route.fan <= fan and route.fan**route.levels >= shards
        messages, asked, hot = {}, {}, {int(words[0]), int(words[7])}
        for node in range(shards):
            owner = np.sort(draw.integers(0, len(words), 80))
            successor = draw.integers(0, 2**40, 80).astype(np.uint64)
            order = np.lexsort((successor, owner))
            asked[node] = lm.Demand(words, np.ones(len(words), np.int64), owner[order], successor[order], np.ones(80, np.int64))
        wanted = Counter((int(words[o]), int(s)) for d in asked.values() for o, s in zip(d.owner, d.successor))
        for level in range(route.levels):
            senders = Counter()
            messages = {}
            for node, demand in asked.items():
                table = route.sent(level, node, demand).to_pylist()
                assert len(table) <= route.fan
                for row in table:
                    senders[row["node"]] += 1
                    messages.setdefault(row["node"], []).append(Trie(row["asked"]))
            assert max(senders.values()) <= route.fan
            asked = {node: lm.added_up(tries)[0] for node, tries in messages.items()}
        assert set(asked) <= set(range(shards))
        counted, arrived = Counter(), Counter()
        for node, demand in asked.items():
            for h, c in zip(demand.contexts.tolist(), demand.counts.tolist()):
                assert c == 0 or node == h % shards
                counted[h] += c
            for o, s, n in zip(demand.owner, demand.successor.tolist(), demand.n.tolist()):
                assert node == int(demand.contexts[o]) % shards or int(demand.contexts[o]) in hot
                arrived[int(demand.contexts[o]), s] += n
        assert arrived == wanted and set(counted.values()) == {shards}


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_scores(rows):
    held = [d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows]
    one, two = Counter(), Counter()
    for (_, text), h in zip(rows, held):
        if not h:
            line = [0, *words_of(text), 1]
            one.update(line)
            two.update(zip(line, line[1:]))
    starts = one.pop(0, 0)
    n, v = sum(one.values()), len(one)
    out = []
    for (d, text), h in zip(rows, held):
        line = [0, *words_of(text), 1]
        base = score = 0.0
        for a, b in zip(line, line[1:]):
            p = (one[b] + 0.5) / (n + 0.5 * (v + 1))
            before = starts if a == 0 else one[a]
            share = two[a, b] / (before + lm.PRIOR) if two[a, b] else 0
            if share:
                share = 10 ** -((min(255, max(1, round(-math.log10(share) / lm.STEP) + 1)) - 1) * lm.STEP)
            base += math.log10(p)
            score += math.log10(share + lm.PRIOR / (before + lm.PRIOR) * p)
        out.append((d, h, len(line) - 1, sum(one[w] > 0 for w in line[1:]), n, round(base, 6), round(score, 6)))
    return sorted(out, key=str)


def rounded(frame):
    return sorted(((*tuple(r)[:5], round(r.base_score, 6), round(r.score, 6)) for r in frame.collect()), key=str)


@pytest.mark.parametrize("block_tokens, fan", [(10_000_000, 256), (4_000, 256), (4_000, 3)])
def test_documents_equal_dictionaries(spark, sf, block_tokens, fan):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    out = lm.score_held_out(docs, block_tokens=block_tokens, fan=fan)
    assert rounded(out) == plain_scores(rows)
    held = [r for r in out.collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "A a É é a\x1cb"), (None, "a b"), (None, "a b"), (5, "go " * 5000), (6, "go stop"), (5, "x")]
    docs = spark.createDataFrame([(d, t, "n") for d, t in rows], "doc_id long, text string, train string")
    assert rounded(lm.score_held_out(docs)) == plain_scores(rows)
    assert rounded(lm.score_held_out(docs, block_tokens=700)) == plain_scores(rows)
    assert rounded(lm.score_held_out(docs, block_tokens=700, fan=2)) == plain_scores(rows)
    assert lm.score_held_out(docs.where("false")).collect() == []
    nothing = [(d, "a b") for d in range(30) if zlib.crc32(str(d).encode()) % 5 == 1]
    frame = spark.createDataFrame(nothing, "doc_id long, text string")
    assert rounded(lm.score_held_out(frame)) == plain_scores(nothing)


def test_block_numbers_words_as_they_come_and_orders_pairs_by_context_and_successor():
    numbers = lm.Numbers()
    assert [numbers[w] for w in (b"b", b"a", b"b", b"", b"a")] == [2, 3, 2, 4, 3] and list(numbers) == [b"b", b"a", b""]
    block = lm.Block([b"b A b", None, b"", b"c b a " * 50])
    assert block.words.tolist() == [lm.START, lm.END, *map(lm.word_hash, (b"b", b"a", b"c"))] and block.sizes.tolist() == [4, 1, 1, 151]
    key = [(block.words[a], block.words[b] & lm.MASK) for a, b in zip(block.left, block.right)]
    assert [key[i] for i in block.pair_order] == sorted(key)
