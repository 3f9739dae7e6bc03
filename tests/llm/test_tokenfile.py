"""Range-coded token files: exact round trips, checksums and order."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from codeloom.llm import rangecoder, tokenfile, tokens


def test_ids_come_back():
    draw = np.random.default_rng(0)
    for size in (0, 1, 2049):
        for top in (1, 65_536):
            ids = draw.integers(0, top, size)
            assert (rangecoder.decode(rangecoder.encode(ids)) == ids).all(), (size, top)
    # What the predictions know well, what breaks off suddenly, and the extreme ids.
    hard = np.concatenate((np.zeros(3000, int), np.full(3000, 65_535), np.tile([1, 2, 3], 2000), np.arange(5000), draw.zipf(1.3, 5000) % 65_536))
    data = rangecoder.encode(hard)
    assert (rangecoder.decode(data) == hard).all() and len(data) < 2 * len(hard)
    assert len(rangecoder.encode(np.tile(np.arange(64), 200))) < 2600
    for seed in range(2):
        draw = np.random.default_rng(seed)
        ids = np.where(draw.random(4000) < 0.9, np.tile(draw.integers(0, 60_000, 7), 572)[:4000], draw.integers(0, 65_536, 4000))
        assert (rangecoder.decode(rangecoder.encode(ids)) == ids).all()


def test_damage_is_found_and_blocks_are_independent():
    ids = np.arange(10_000) % 777
    data = bytearray(rangecoder.encode(ids))
    data[-900] ^= 16
    with pytest.raises(ValueError, match="damaged"):
        rangecoder.decode(bytes(data))
    with pytest.raises(ValueError, match="format"):
        rangecoder.decode(b"nope" + bytes(data[4:]))
    head, more = rangecoder.encode(ids[: 2 * rangecoder.BLOCK]), rangecoder.encode(ids)
    assert more[-100:] and head[12 + 16 :][:500] == more[12 + 40 :][:500]


def expected(rows, library):
    out, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def in_order(frame):
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: r[1])


def test_documents_come_back_in_order(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    library = Tokenizer.from_file(tokens.path("word_bpe_49k.json"))
    want = expected([(r.doc_id, r.text) for r in docs.collect()], library)
    assert in_order(tokenfile.op4(spark, sf)) == want
    tokenfile.write_ids(docs, str(tmp_path / "small"), stretch_ids=9_000)
    assert in_order(tokenfile.read_ids(spark, str(tmp_path / "small"))) == want


def test_edge_cases(spark, tmp_path):
    library = Tokenizer.from_file(tokens.path("word_bpe_49k.json"))
    rows = [(5, None), (1, ""), (None, "a"), (3, "word " * 30_000), (2, '" <|endoftext|> "'), (4, "z" * 9000), (4, "z" * 9000)]
    docs = spark.createDataFrame([(d, t, 9) for d, t in rows], "doc_id long, text string, part int")
    tokenfile.write_ids(docs, str(tmp_path / "a"))
    assert in_order(tokenfile.read_ids(spark, str(tmp_path / "a"))) == expected(rows, library)
    tokenfile.write_ids(docs.where("false"), str(tmp_path / "b"))
    assert tokenfile.read_ids(spark, str(tmp_path / "b")).collect() == []
