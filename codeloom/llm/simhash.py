"""Near-duplicates by SimHash, with candidates from pigeonring chains."""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codeloom.llm.common import documents, map_columns, split_words, text_digest, unused, written
from codeloom.llm.components import connected_components

BITS = 64
SHINGLE = 3
SEED = 42
DIFFERING = 2
SEGMENTS = 5
# Members of a chain key that are still compared pair by pair; larger keys go the exact way round.
PAIRED = 64
# Shingles that are unpacked to bits at a time.
_AT_ONCE = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of a UTF-8 text as a signed 64-bit number.

    A-Z is lower-cased; a text of fewer words than a shingle is one shingle; no words give 0.
    """
    words = split_words((text or b"").lower())
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words), initial=-1))
    starts = [e + 1 for e in ends[:-1]]
    ends = ends[min(shingle, len(words)) :]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for low in range(0, len(ends), _AT_ONCE):
        high = min(low + _AT_ONCE, len(ends))
        hashes = np.array(
            [digest(line[a:b], SEED) for a, b in zip(starts[low:high], ends[low:high])], np.uint64
        )
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > len(ends), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, digest, fingerprint long)`` for each row of ``docs(doc_id, text)``; other columns are not read."""
    return map_columns(
        docs.select(F.col("doc_id").cast("long"), text_digest(F.col("text")).alias("digest"), F.col("text").cast("binary")),
        lambda b: {
            "doc_id": b.column(0),
            "digest": b.column(1),
            "fingerprint": [fingerprint(t) for t in b.column(2).to_pylist()],
        },
        "doc_id long, digest long, fingerprint long",
    )


def _masks(segments: int) -> list[list[int]]:
    """For each segment of the ring, the signed masks of the chains of 1, 2, ... segments from it."""
    cuts = [BITS * i // segments for i in range(segments + 1)]
    single = [(1 << cuts[i + 1]) - (1 << cuts[i]) for i in range(segments)]
    chains = []
    for start in range(segments):
        whole = accumulate((single[(start + k) % segments] for k in range(segments)), lambda a, b: a | b)
        chains.append([m - (1 << BITS) if m >> (BITS - 1) else m for m in whole])
    return chains


def _at(values: list[int], place: Column) -> Column:
    return F.element_at(F.array(*(F.lit(v).cast("long") for v in values)), place)


def links(prints: DataFrame, differing: int = DIFFERING, segments: int = SEGMENTS, paired: int = PAIRED) -> DataFrame:
    """Edges ``(a, b)`` that connect all fingerprints of ``prints(fingerprint)`` within ``differing`` bits.

    If two fingerprints differ in at most t bits, some segment starts a chain around the ring in
    which every prefix of l segments differs in at most l * t / segments bits. The leading
    segments whose budget is below one bit must be equal: they are the join key. Pairs that meet
    there must keep the budget of every longer prefix before the full distance is taken.

    A key that more than ``paired`` different fingerprints share is not paired up. Within it the
    chain goes on with the flips of one remaining bit: two members within two bits have such a
    flip in common, at most one per bit shares it, so its smallest member links them all. Only this
    step asks for ``differing`` of 2 or less; beyond that every key is paired up.
    """
    chains = _masks(segments)
    fixed = max(n for n in range(1, segments) if n * differing < segments)
    keys = prints.select("fingerprint").distinct()
    keys = keys.select(
        "fingerprint",
        F.posexplode(
            F.array(*(F.col("fingerprint").bitwiseAND(F.lit(c[fixed - 1]).cast("long")) for c in chains))
        ).alias("ring", "chain"),
    )
    sizes = keys.groupBy("ring", "chain").agg(F.count("*").alias("members")).where("members > 1")
    members = keys.join(sizes, ["ring", "chain"])
    heavy = F.col("members") > paired if differing <= 2 else F.lit(False)

    light = members.where(~heavy)
    other = light.select("ring", "chain", F.col("fingerprint").alias("other"))
    differs = F.col("fingerprint").bitwiseXOR(F.col("other"))
    place = F.col("ring") + 1
    viable = F.lit(True)
    for n in range(fixed, segments):
        mask = _at([c[n] for c in chains], place)
        viable = viable & (F.bit_count(differs.bitwiseAND(mask)) <= (n + 1) * differing // segments)
    near = (
        light.join(other, ["ring", "chain"])
        .where(F.col("fingerprint") < F.col("other"))
        .where(viable)
        .where(F.bit_count(differs) <= differing)
        .select(F.col("fingerprint").alias("a"), F.col("other").alias("b"))
    )

    open_bits = [[F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(BITS) if not c[fixed - 1] >> b & 1] for c in chains]
    flips = F.element_at(F.array(*(F.array(F.lit(0).cast("long"), *bits) for bits in open_bits)), place)
    flipped = members.where(heavy).select(
        "ring", "fingerprint", F.explode(flips).alias("flip")
    )
    shared = Window.partitionBy("ring", "shared")
    stars = (
        flipped.select("ring", "fingerprint", F.col("fingerprint").bitwiseXOR(F.col("flip")).alias("shared"))
        .withColumn("low", F.min("fingerprint").over(shared))
        .where("fingerprint > low")
        .select(F.col("fingerprint").alias("a"), F.col("low").alias("b"))
        .distinct()
    )
    return near.unionByName(stars)


def grouped(docs: DataFrame, segments: int = SEGMENTS, paired: int = PAIRED) -> DataFrame:
    """``(doc_id, digest, fingerprint long, component, component_id)``, one row per row of ``docs(doc_id, text)``.

    ``component`` is the group's smallest fingerprint, ``component_id`` its smallest doc_id.
    """
    prints = written(fingerprints(docs), "simhash")
    linked = connected_components(links(prints, segments=segments, paired=paired))
    lowest = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("own"))
    lowest = lowest.join(linked.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "own", F.coalesce("component", "fingerprint").alias("component")
    )
    named = lowest.groupBy("component").agg(F.min("own").alias("component_id"))
    groups = lowest.join(named, "component").select("fingerprint", "component", "component_id")
    return prints.join(groups, "fingerprint").select("doc_id", "digest", "fingerprint", "component", "component_id")


def near_duplicates(docs: DataFrame, segments: int = SEGMENTS, paired: int = PAIRED) -> DataFrame:
    """``(doc_id, fingerprint hex, component_id)``, one row per row of ``docs(doc_id, text)``.

    ``component_id`` is the smallest doc_id reachable over links of at most two differing bits,
    the document itself included. Copies meet in their fingerprint and are never paired.
    Null and empty texts have fingerprint 0 and link like others; a row with a null doc_id is
    kept and links, but names no component; rows that repeat a doc_id all stay; an empty table
    gives an empty one.
    """
    return grouped(docs, segments, paired).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each near-duplicate group of ``near_duplicates``, the one with the smallest doc_id, all columns kept.

    Null and empty texts are one group with others of fingerprint 0. Different texts of one doc_id are told apart: each stands
    for its own group, and of several in one group the one with the smallest digest stays. Of rows that repeat
    doc_id and text the first by a hash of the other columns stays (columns of maps, which have no order, are left out of it).
    Rows without a doc_id stay. An empty table gives an empty one; columns of any name may be there.
    """
    first = F.min(F.struct("doc_id", "digest"))
    kept = grouped(docs).where("doc_id = component_id").groupBy("component").agg(first.alias("first"))
    doc, digest, nth = (unused(docs.columns, name) for name in ("kept_doc", "kept_digest", "nth_row"))
    kept = kept.select(F.col("first.doc_id").alias(doc), F.col("first.digest").alias(digest))
    # The kept ids grow with the input, so they meet the documents in a merge join at every size.
    own = text_digest(docs["text"])
    single = docs.join(kept.hint("merge"), (docs["doc_id"].cast("long") == kept[doc]) & (own == kept[digest]))
    others = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    rows = Window.partitionBy(doc, digest).orderBy(F.xxhash64(*others))
    single = single.withColumn(nth, F.row_number().over(rows)).where(F.col(nth) == 1).drop(doc, digest, nth)
    return single.unionByName(docs.where("doc_id is null"))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
