"""Quality counts and the vote model against direct computations."""

import math
import random
import re

from pyspark.sql import functions as F

from codeloom.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, g in enumerate(grams) for k in range(3) if grams.count(g) > 1}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


TEXTS = [
    None, "", " \n\t", "a", "a\n\na", "x y z x y z", "a b\na b\n a b", "é# ü| <ñ>", "a\x0bb\x0cc\x1cd\xa0e",
    "� \U0001f600 ok", "go " * 3000, "one two three " * 40,
]


def test_counts_equal_plain(spark, sf):
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    for text in texts:
        if len(text or "") < 20_000:
            assert quality.text_counts(None if text is None else text.encode())[:5] == plain_counts(text)


def test_judge_edge_cases(spark):
    docs = spark.createDataFrame([(i, t, 5, "k") for i, t in enumerate(TEXTS)] + [(None, "a b", 5, "k"), (0, None, 5, "k")], "doc_id long, text string, n_words int, kept string")
    rows = quality.judge(docs).collect()
    assert len(rows) == len(TEXTS) + 2 and all(r.base_failed and not r.kept for r in rows)
    assert quality.judge(docs.where("false")).collect() == []
    assert quality.keep_good(docs).collect() == [] and quality.keep_good(docs).columns == docs.columns


def test_em_recovers_the_accuracies():
    draw = random.Random(1)
    seen = {}
    for _ in range(20_000):
        bad = draw.random() < 0.15
        votes = []
        for hit, false in ((0.5, 0.01), (0.4, 0.02), (0.6, 0.01), (0.3, 0.005)):
            if draw.random() < (hit if bad else false):
                votes.append(-1)
            else:
                votes.append(1 if draw.random() < (0.5 if bad else 0.9) else 0)
        seen[tuple(votes)] = seen.get(tuple(votes), 0) + 1
    model = quality.fit(sorted(seen.items()))
    assert abs(model.bad_share - 0.15) < 0.02
    for (bad, good), (hit, false) in zip(model.chances, ((0.5, 0.01), (0.4, 0.02), (0.6, 0.01), (0.3, 0.005))):
        assert abs(bad[0] - hit) < 0.05 and abs(good[0] - false) < 0.01
    assert quality.fit([]).bad_share == quality.START_BAD_SHARE


def test_verdicts_agree_with_held_labels(spark, sf):
    judged = quality.judge(spark.read.parquet(f"{sf}/documents.parquet")).where("not base_failed")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = judged.select("doc_id", "kept").join(labels.select("doc_id", F.col("quality").alias("y")), "doc_id").collect()
    good = [r for r in rows if r.y == 1]
    bad = [r for r in rows if r.y == 0]
    assert sum(r.kept for r in good) >= 0.97 * len(good)
    assert sum(not r.kept for r in bad) >= 0.8 * len(bad)


def plain_votes(text):
    """The eight votes from a text alone, by their definitions."""
    words = WORD.findall(text)
    n = len(words)
    if not n:
        return (0,) * 8
    _, chars, symbols, dup, repeats = plain_counts(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    marks = sum(not re.search(r"[^!-/:-@\[-`{-~]", w) for w in words)
    ends = sum(w[-1] in ".!?" for w in words)
    upper = sum(len(w.encode()) > 1 and bool(re.search("[A-Z]", w)) and not re.search("[a-z]", w) for w in words)
    stretches = [words[i : i + quality.STRETCH] for i in range(0, n, quality.STRETCH)]
    distinct = sum(len(set(s)) for s in stretches) / n
    copied = dup / len(lines)
    tests = [
        (not 3 <= chars / n <= 10, 4 <= chars / n <= 7), (symbols / n > 0.1, symbols / n < 0.01), (repeats / n > 0.4, repeats / n < 0.1),
        (copied > 0.4, copied < 0.05 and len(lines) > 1), (marks / n > 0.3, marks / n < 0.05),
        (ends / n > 0.4, 0.01 < ends / n < 0.25), (upper / n > 0.3, upper / n < 0.05), (distinct < 0.2, distinct > 0.45),
    ]
    return tuple(-1 if bad else 1 if good else 0 for bad, good in tests)


def plain_posteriors(votes):
    """EM row by row, without histogram, logs or clamp; the posterior of good of each row."""
    share, start = 0.2, ((0.4, 0.2, 0.4), (0.02, 0.28, 0.7))
    tables = [start] * 8
    for _ in range(300):
        bad_of = []
        for row in votes:
            bad = share * math.prod(t[0][v + 1] for t, v in zip(tables, row))
            good = (1 - share) * math.prod(t[1][v + 1] for t, v in zip(tables, row))
            bad_of.append(bad / (bad + good))
        tables = []
        for j in range(8):
            mass = [[2 * x for x in side] for side in start]
            for row, bad in zip(votes, bad_of):
                mass[0][row[j] + 1] += bad
                mass[1][row[j] + 1] += 1 - bad
            tables.append(tuple(tuple(x / sum(side) for x in side) for side in mass))
        share = (sum(bad_of) + 0.2) / (len(votes) + 1)
    return [1 - b for b in bad_of]


def test_verdicts_equal_direct_em(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect() if len(r.text or "") < 60_000}
    long = set(r.doc_id for r in docs.collect()) - set(texts)
    rows = {r.doc_id: r for r in quality.judge(docs.where(~F.col("doc_id").isin(*long) if long else F.lit(True))).collect()}
    names = [r.name for r in quality.rules()]
    passing = [d for d, r in rows.items() if not r.base_failed]
    for d in passing:
        assert tuple(rows[d][n] for n in names) == plain_votes(texts[d]), d
    want = dict(zip(passing, plain_posteriors([plain_votes(texts[d]) for d in passing])))
    for d, good in want.items():
        assert abs(rows[d].quality - good) < 1e-4 and rows[d].kept == (good >= 0.5)
    assert all(not rows[d].kept for d in set(rows) - set(passing))


def test_long_texts_vote_like_short_ones():
    few, many = [f"w{i % 90}" for i in range(20_000)], [f"w{i}" for i in range(20_000)]
    for n in (1_000, 4_999, 5_001, 20_000):
        assert quality.text_counts(" ".join(few[:n]).encode())[-1] / n < 0.2
        assert quality.text_counts(" ".join(many[:n]).encode())[-1] / n == 1


def test_column_names_of_its_own(spark):
    docs = spark.createDataFrame([(1, "word one two. " * 30, 7, "x")], "doc_id long, text string, _counts int, __COUNTS string")
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() <= 1
