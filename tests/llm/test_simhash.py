"""SimHash against a direct computation over all pairs."""

import random
import re

import xxhash
from pyspark.sql import functions as F

from codeloom.llm import simhash
from codeloom.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_print(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def plain_groups(prints):
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def expected(rows):
    prints = [plain_print(t) for _, t in rows]
    roots = plain_groups(prints)
    low = {}
    for (d, _), r in zip(rows, roots):
        low[r] = min(x for x in (low.get(r), d) if x is not None) if d is not None else low.get(r)
    return sorted((d, f"{p:016x}", low[r]) for (d, _), p, r in zip(rows, prints, roots))


def test_documents_equal_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in simhash.near_duplicates(docs).collect())
    assert got == expected(rows)


def test_edge_cases(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "a b"), (7, "a\x0bb c"),
        (8, "A B\rC"), (9, "É b c d"), (10, "é b c d"), (10, "é b c d"), (11, "x y z w"),
        (12, "word " * 70_000), (13, "word " * 3),
    ]
    docs = spark.createDataFrame([(d, t, "z", 1) for d, t in rows], "doc_id long, text string, component_id string, fingerprint int")
    got = sorted(tuple(r) for r in simhash.near_duplicates(docs).collect())
    assert got == expected(rows)
    empty = simhash.near_duplicates(docs.where("false"))
    assert empty.collect() == [] and empty.columns == ["doc_id", "fingerprint", "component_id"]


def _linked(spark, prints, paired, segments=5):
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fingerprint long")
    found = connected_components(simhash.links(frame, segments=segments, paired=paired))
    return {r.node % (1 << 64): r.component % (1 << 64) for r in found.collect()}


def test_links_light_and_heavy_keys_equal_all_pairs(spark):
    draw = random.Random(5)
    prints = set()
    for _ in range(12):
        base = draw.getrandbits(64)
        for _ in range(25):
            prints.add(base)
            base ^= 1 << draw.randrange(64)
            if draw.random() < 0.3:
                base ^= 1 << draw.randrange(64)
            if draw.random() < 0.2:
                base ^= draw.getrandbits(64) & draw.getrandbits(64) & draw.getrandbits(64) & draw.getrandbits(64)
    prints = sorted(prints)
    groups = plain_groups(prints)
    for paired, segments in ((64, 5), (0, 5), (3, 7)):
        label = _linked(spark, prints, paired, segments)
        mine = [label.get(p, p) for p in prints]
        assert len(set(zip(mine, groups))) == len(set(mine)) == len(set(groups))


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(70)] + [(1000, i) for i in range(1001, 1200)] + [(7, 7), (2, 1)]
    found = connected_components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {i: 0 for i in range(71)} | {i: 1000 for i in range(1000, 1200)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_keep_one(spark):
    rows = [
        (3, "a b c", "x"), (1, "a b c", "y"), (2, "entirely other words here", "z"), (2, "entirely other words here", "a"),
        (2, "and of the same id, but no copy of it at all", "b"), (4, "AND of the same id, but no copy of it at all", "c"),
        (None, "q", "n"), (5, None, "e"), (6, "", "f"),
    ]
    schema = "doc_id long, text string, kept_doc string, _doc int, kept_digest map<string,int>, digest array<int>, nth_row int, _place_of_doc_id int"
    docs = spark.createDataFrame([(*r, 1, {"k": 1}, [2], 3, 4) for r in rows], schema)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text, r.kept_doc) for r in kept.collect()), key=str)
    assert [g[:2] for g in got] == sorted(
        [(1, "a b c"), (2, rows[2][1]), (2, rows[4][1]), (None, "q"), (5, None)], key=str
    )
    assert [tuple(r) for r in kept.where("doc_id = 1").collect()] == [(1, "a b c", "y", 1, {"k": 1}, [2], 3, 4)]
    assert kept.where(F.col("doc_id") == 2).collect() == kept.where(F.col("doc_id") == 2).collect()
    assert simhash.keep_one(docs.where("false")).collect() == []
