"""Shared lines against a direct computation."""

import hashlib
import random
import re

import numpy as np
import pytest

from codeloom.llm import linededup

ENDS = re.compile(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$")


def plain_key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in ENDS.sub("", line))


def plain(rows):
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key := plain_key(line)) >= 20:
                holders.setdefault(key, set()).add(-(10**9) if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        own = -(10**9) if doc is None else doc
        kept = [x for x in lines if len(h := holders.get(plain_key(x), ())) < 3 or own == max(h)]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def got(docs):
    bitmaps = linededup.keep_bitmaps(docs)
    texts = linededup.deduplicated(docs, bitmaps).collect()
    return bitmaps, sorted(((r.doc_id, r.text) for r in texts), key=str)


def test_documents_equal_direct_computation(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    rows = linededup.op12(spark, sf).collect()
    mine = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in rows), key=str)
    assert mine == [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in want]
    assert any(k for _, _, k, _ in want)


def test_edge_cases(spark):
    notice = "all rights are reserved to the owner"
    rows = [
        (1, None), (2, ""), (3, "\n\n"), (4, notice), (5, f" \t{notice.upper()}\r\nown words of the fifth text\n{notice}"),
        (6, f"{notice}\n{notice}\nlast"), (6, f"x\n{notice}"), (6, f"x\n{notice}"), (None, notice), (None, "é" * 19),
        (7, "é" * 20), (8, "é" * 20), (9, "É" * 20), (10, "é" * 20), (11, "e" * 19), (12, "e" * 19), (13, "e" * 19),
        (14, ("word " * 9 + "\n") * 30_000), (15, "word " * 200_000), (16, "word " * 9), (17, "word " * 9),
        (18, "line of two documents only"), (19, "line of two documents only"), (19, "line of two documents only\n!"),
    ]
    docs = spark.createDataFrame([(d, t, b"k", 3, 9) for d, t in rows], "doc_id long, text string, keep binary, digest int, n_lines int")
    bitmaps, texts = got(docs)
    want = plain(rows)
    assert texts == sorted(((d, t) for d, _, _, t in want), key=str)
    found = {(r.doc_id, r.n_lines, r.n_dropped) for r in bitmaps.collect()}
    assert found == {(d, n, k) for d, n, k, _ in want}
    for r in bitmaps.collect():
        assert (~linededup.unpacked_bits(r.keep, r.n_lines)).sum() == r.n_dropped
    empty = linededup.keep_bitmaps(docs.where("false"))
    assert empty.collect() == [] and empty.columns == ["doc_id", "digest", "n_lines", "n_dropped", "keep"]
    assert linededup.deduplicated(docs.where("false"), empty).collect() == []


@pytest.mark.parametrize("held", [2, 1000])
@pytest.mark.parametrize("pieces", [1, 7, 40])
def test_runs_cut_anywhere(held, pieces, monkeypatch):
    """Whatever cuts a sorted table, streams and edges give what the whole run gives."""
    monkeypatch.setattr(linededup, "HELD", held)
    draw = random.Random(pieces * held)
    rows = set()
    for key in range(60):
        for _ in range(draw.choice([1, 1, 2, 3, 4, 30])):
            rows.add((key, 0, draw.randrange(12), draw.randrange(3)))
    rows = sorted(rows, key=lambda r: (r[0], -r[2], r[3]))
    cuts = sorted(draw.randrange(len(rows)) for _ in range(pieces - 1))
    out = []
    for a, z in zip([0, *cuts], [*cuts, len(rows)]):
        stream = linededup._Stream(3)
        for row in rows[a:z]:
            stream.add((*row, b"p"))
        stream.end()
        out += stream.out
    docs = {}
    for key, _, doc, _, _, kind in out:
        if kind == "edge":
            docs.setdefault(key, set()).add(doc)
    dropped = sorted(
        r[:4] for r in out if r[5] == "drop" or r[5] == "open" and len(docs[r[0]]) >= 3 and r[2] != max(docs[r[0]])
    )
    holders = {k: {r[2] for r in rows if r[0] == k} for k in {r[0] for r in rows}}
    assert dropped == sorted(r for r in rows if len(holders[r[0]]) >= 3 and r[2] != max(holders[r[0]]))


def test_bitmaps_round_trip():
    for n in (1, 7, 8, 9, 5000):
        keep = np.random.default_rng(n).random(n) < 0.9
        assert (linededup.unpacked_bits(linededup.packed_bits(keep), n) == keep).all()
