"""Quality by weak supervision: rules vote or abstain, EM weighs them, a posterior decides."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.llm.common import documents, map_columns, slices, split_words, unused, written

BLANK = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
FEWEST_WORDS = 50
WINDOW = 3
# Words of which the different ones are counted together, so that the count of a text of any length means the same.
STRETCH = 1000
KEEP_FROM = 0.5

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_marks", "n_ends", "n_upper", "n_distinct",
)


def text_counts(text: bytes | None) -> tuple[int, ...]:
    """The ``COUNTS`` of one UTF-8 text; null and empty texts count nothing.

    ``n_marks``: words of ASCII punctuation alone; ``n_ends``: words that end in ``.``, ``!`` or ``?``;
    ``n_upper``: words whose ASCII letters are all capitals, two bytes or more; ``n_distinct``: different words of
    each ``STRETCH`` words, added up.
    """
    text = text or b""
    words = split_words(text)
    points = len(text.decode("utf-8", "replace"))
    lines = [line for line in text.split(b"\n") if line.strip(BLANK)]
    windows = list(zip(*(words[k:] for k in range(WINDOW))))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = Counter(windows)
        covered = bytearray(len(words))
        for i, window in enumerate(windows):
            if often[window] > 1:
                covered[i : i + WINDOW] = b"\1" * WINDOW
        repeated = sum(covered)
    return (
        len(words),
        points - sum(text.count(bytes([c])) for c in BLANK),
        sum(text.count(bytes([c])) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        sum(not w.strip(MARKS) for w in words),
        sum(w.endswith((b".", b"!", b"?")) for w in words),
        sum(w.isupper() and len(w) > 1 for w in words),
        sum(len(set(words[i : i + STRETCH])) for i in range(0, len(words), STRETCH)),
    )


def counted(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the ``COUNTS`` of each row."""

    def batch(b):
        rows = [text_counts(t) for t in b.column(1).to_pylist()]
        return {"doc_id": b.column(0)} | {c: [r[i] for r in rows] for i, c in enumerate(COUNTS)}

    return map_columns(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")),
        batch,
        "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS),
    )


@dataclass(frozen=True)
class Rule:
    """Votes bad or good where its condition holds, abstains elsewhere."""

    name: str
    bad: Column
    good: Column

    def vote(self) -> Column:
        vote = F.when(self.bad, -1).when(self.good, 1).otherwise(0)
        return F.coalesce(vote, F.lit(0)).cast("int").alias(self.name)


def rules(at: str = "") -> list[Rule]:
    """The standing rules, over shares of a text's words and lines. A text without words gets no vote.

    ``at`` stands before the names of the counts, such as a struct and a dot.
    """

    def col(name: str) -> Column:
        return F.col(at + name)

    words = F.when(col("n_words") > 0, col("n_words"))
    lines = F.when(col("n_lines") > 0, col("n_lines"))
    length = col("word_chars") / words
    symbols = col("n_symbols") / words
    repeats = col("n_repeat_words") / words
    copied = col("n_dup_lines") / lines
    marks = col("n_marks") / words
    ends = col("n_ends") / words
    upper = col("n_upper") / words
    distinct = col("n_distinct") / words
    return [
        Rule("word_length", (length < 3) | (length > 10), (length >= 4) & (length <= 7)),
        Rule("symbols", symbols > 0.1, symbols < 0.01),
        Rule("repeated_words", repeats > 0.4, repeats < 0.1),
        Rule("repeated_lines", copied > 0.4, (copied < 0.05) & (lines > 1)),
        Rule("bare_marks", marks > 0.3, marks < 0.05),
        Rule("sentence_ends", ends > 0.4, (ends > 0.01) & (ends < 0.25)),
        Rule("capitals", upper > 0.3, upper < 0.05),
        Rule("distinct_words", distinct < 0.2, distinct > 0.45),
    ]


@dataclass(frozen=True)
class VoteModel:
    """Share of bad texts, and per rule the chance of each vote (bad, none, good) in a bad and in a good text."""

    bad_share: float
    chances: tuple[tuple[tuple[float, float, float], tuple[float, float, float]], ...]

    def quality(self, votes: list[Column]) -> Column:
        """Posterior probability of good from the votes."""
        total = F.lit(math.log((1 - self.bad_share) / self.bad_share))
        for vote, (bad, good) in zip(votes, self.chances):
            gain = [math.log(g / b) for b, g in zip(bad, good)]
            total = total + F.when(vote == -1, gain[0]).when(vote == 1, gain[2]).otherwise(gain[1])
        return 1 / (1 + F.exp(-total))


# Where EM starts: bad votes are rare in good texts, good votes are common in both.
START_BAD_SHARE = 0.2
START_IN_BAD = (0.4, 0.2, 0.4)
START_IN_GOOD = (0.02, 0.28, 0.7)
# Votes that each rule's table is given in advance, spread as at the start.
PRIOR_VOTES = 2.0
# A bad vote is taken to be at least so many times likelier in a bad text than in a good one: better than chance, no more.
BETTER_THAN_CHANCE = 1.0


def _sound(bad: list[float], good: list[float]) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Vote chances from vote masses, held to what a rule means by its votes.

    Without this, EM may name two kinds of bad text "bad" and "good" and learn that a rule is always wrong.
    """
    bad, good = ([x / sum(side) for x in side] for side in (bad, good))
    most = bad[0] / BETTER_THAN_CHANCE
    if good[0] > most:
        good = [most, *(x * (1 - most) / (1 - good[0]) for x in good[1:])]
    if bad[2] > good[2]:
        bad = [bad[0], *(x * (1 - bad[0]) / sum(good[1:]) for x in good[1:])]
    return tuple(bad), tuple(good)


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200, tolerance: float = 1e-9) -> VoteModel:
    """EM over the histogram of vote patterns, at most 3 to the number of rules long.

    Votes are taken as independent given the quality. An empty histogram gives the start.
    """
    width = len(patterns[0][0]) if patterns else 0
    model = VoteModel(START_BAD_SHARE, ((START_IN_BAD, START_IN_GOOD),) * width)
    total = sum(n for _, n in patterns)
    for _ in range(rounds if total else 0):
        mass = [[[PRIOR_VOTES * p for p in START_IN_BAD], [PRIOR_VOTES * p for p in START_IN_GOOD]] for _ in range(width)]
        bad_total = 0.0
        for votes, n in patterns:
            odds = math.log(model.bad_share / (1 - model.bad_share))
            for v, (bad, good) in zip(votes, model.chances):
                odds += math.log(bad[v + 1] / good[v + 1])
            share = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
            bad_total += n * share
            for j, v in enumerate(votes):
                mass[j][0][v + 1] += n * share
                mass[j][1][v + 1] += n * (1 - share)
        after = VoteModel(
            (bad_total + START_BAD_SHARE) / (total + 1),
            tuple(_sound(bad, good) for bad, good in mass),
        )
        moved = abs(after.bad_share - model.bad_share)
        model = after
        if moved < tolerance:
            break
    return model


def _fails_base(at: str = "") -> Column:
    words = F.col(f"{at}n_words")
    return (words < FEWEST_WORDS) | (100 * F.col(f"{at}n_repeat_words") > 50 * words)


def _fit_votes(votes: DataFrame, names: list[str]) -> VoteModel:
    """EM on the histogram of the votes of all rows that pass the base; it is summed up before it is shuffled."""
    histogram = votes.where("not base_failed").groupBy(names).agg(F.count("*").alias("rows")).orderBy(names)
    return fit([(tuple(row[n] for n in names), row["rows"]) for row in histogram.collect()])


def _votes(docs: DataFrame) -> DataFrame:
    return counted(docs).select(
        "doc_id", *COUNTS, _fails_base().alias("base_failed"), *(r.vote() for r in rules())
    )


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts, every vote, ``base_failed``, ``quality`` (posterior) and ``kept``, one row per row.

    ``base_failed``: under 50 words, or more than half of them in repeated three-word windows. The
    votes of all rows that pass the base give the histogram that EM is fitted on; it
    holds at most 3 to the number of rules rows. A null or empty text has no words, gets no vote and fails the
    base; a null doc_id stays null; repeated rows are each judged; an empty table gives an empty one.
    """
    names = [r.name for r in rules()]
    votes = written(_votes(docs), "quality")
    model = _fit_votes(votes, names)
    return votes.withColumn("quality", model.quality([F.col(n) for n in names])).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_FROM)
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, all columns, each row judged by its own text.

    The texts are counted twice, for the fit and for the verdicts, and never shuffled. Null and empty texts fail the base,
    long ones are counted whole, repeated rows are each kept or not, columns of any name stay, and an empty table
    gives an empty one.
    """
    names = [r.name for r in rules()]
    model = _fit_votes(_votes(docs), names)
    inner = ", ".join(f"{c}: bigint" for c in COUNTS)
    counts = unused(docs.columns, "_counts")
    target = docs.withColumn(counts, F.lit(None).cast(f"struct<{inner}>")).schema

    def with_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = b.column(b.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
            rows = [dict(zip(COUNTS, text_counts(t))) for t in texts]
            kind = pa.struct([(c, pa.int64()) for c in COUNTS])
            yield b.append_column(counts, pa.array(rows, kind))

    votes = [r.vote() for r in rules(f"{counts}.")]
    good = ~_fails_base(f"{counts}.") & (model.quality(votes) >= KEEP_FROM)
    return docs.mapInArrow(with_counts, target).where(good).drop(counts)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.round("quality", 6).alias("quality"),
    )
