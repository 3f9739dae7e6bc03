"""Toxicity by a weighted finite-state grammar over clauses, with weights learned from labels."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.llm.common import documents, hits_remainder, map_columns, written

FOLDS, HELD_FOLD = 3, 1
PREDICT_FROM = 0.7
# Labelled rows that the weights are fitted on at most, and entries of the lexicon at most.
FIT_ROWS = 20_000
LEXICON = 5_000
# A piece enters the lexicon if so many toxic texts hold it and its log odds are at least so high.
LEAST_TEXTS = 5
LEAST_WEIGHT = 2.5
# Lengths of word beginnings that may stand for a word stem.
STEMS = (4, 5, 6, 7)
# Words over which a target, a negation or a reporting verb reaches.
REACH = 4

# Fixed words of the grammar, by symbol.
WORDS = {
    "target": (
        "you your you're u he she they him her them his their tu toi te vous ton votre il elle ils du dich dir "
        "dein ihr sie er tú ti usted ustedes él ella"
    ),
    "negation": "not no never nor isn't aren't wasn't don't ne pas jamais non nicht kein keine nie nunca jamás tampoco",
    "report": (
        "said says say told wrote writes claimed claims quoted quotes called reported alleged dit écrit déclaré "
        "sagte schrieb behauptete dijo escribió afirmó"
    ),
}
# Fixed stems of verbs of harm and their endings, by language: each stem with each ending is the symbol "threat".
HARM = {
    "en": [
        ("kill murder hurt destroy shoot burn poison drown hang slaughter execut beat chok behead", " e s es d ed en ing"),
        ("stab slit gut", " s bed ted bing ting"), ("strangl", "e es ed ing"), ("shot hung", ""),
    ],
    "fr": [
        ("tu égorg frapp étrangl poignard assassin brûl noi massacr", "e es er ez ons ent é és ée ées era erai erais erez eront eras"),
        ("abatt", "re rai ra u us ons ez ent"),
    ],
    "de": [
        ("töt ermord erschieß erwürg erstech verbrenn verprügel abstech umbring ersäuf erschlag", " e st t et en est n"),
        ("getötet ermordet erschossen erwürgt erstochen umgebracht erschlagen umzubringen", ""),
    ],
    "es": [
        (
            "mat apuñal golpe quem estrangul dispar asesin ahog degoll degüell",
            "o a as amos an ar arte arlo arla aré arás ará arán aremos aría ado ada ados adas",
        ),
    ],
}
THREATS = {
    stem + ending for pairs in HARM.values() for stems, endings in pairs for stem in stems.split() for ending in endings.split(" ")
}
# Fixed verbs that harm with a word some places later: the later word is the threat.
PHRASES = (
    (re.compile("bring(?:e|st|t|en)?"), {"um"}), (re.compile("schlag(?:e|t|en)|schläg(?:st|t)"), {"tot", "zusammen"}),
    (re.compile("mach(?:e|st|t|en)?"), {"kalt", "fertig"}), (re.compile("beat(?:s|ing|en)?|blow(?:s|ing|n)?"), {"up"}),
    (re.compile("break|breaks|smash|smashes|cut|cuts|rip|rips"), {"neck", "skull", "throat", "bones", "face", "off"}),
)
CLAUSE = re.compile(r"[.!?;:\n]+")
TRIM = ".,;:!?|\"'()[]{}<>*#-_"

Step = tuple[int, str]


@dataclass(frozen=True)
class Transducer:
    """A deterministic transducer over symbols: ``step(state, symbol)`` gives the next state and the output."""

    states: int
    step: Callable[[int, str], Step]


def marks_after(trigger: str, mark: str, reach: int) -> Transducer:
    """Appends ``mark`` to matches within ``reach`` words after ``trigger``."""

    def step(state: int, symbol: str) -> Step:
        if symbol == trigger:
            return reach, symbol
        out = symbol + mark if state and symbol.startswith(("insult", "threat")) else symbol
        return max(0, state - 1), out

    return Transducer(reach + 1, step)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """One transducer that feeds the output of ``first`` to ``second``."""

    def step(state: int, symbol: str) -> Step:
        a, b = divmod(state, second.states)
        a, middle = first.step(a, symbol)
        b, out = second.step(b, middle)
        return a * second.states + b, out

    return Transducer(first.states * second.states, step)


def phrase(first: int, reach: int) -> Transducer:
    """Turns the symbol ``late<n>`` into a threat within ``reach`` words after ``early<n>``; passes others on."""

    def step(state: int, symbol: str) -> Step:
        if symbol == f"early{first}":
            return reach, "other"
        if symbol == f"late{first}":
            return 0, "threat" if state else "other"
        return max(0, state - 1), symbol

    return Transducer(reach + 1, step)


GRAMMAR = compose(
    compose(marks_after("target", "@", REACH), marks_after("negation", "~", REACH)),
    marks_after("report", '"', REACH * 3),
)
# Read from right to left: a threat usually comes before its target.
AHEAD = marks_after("target", "@", REACH)
SYMBOLS = ("other", "insult", "threat", *WORDS)
FEATURES = 11
# Where the weights start and what they are drawn to: a threat at a target counts without any example of one. The rest is learned.
PRIOR = np.zeros(FEATURES)
PRIOR[5] = 7.0


def grammar_table() -> dict[tuple[int, str], Step]:
    """The composed grammar as a table of its reachable states."""
    table, open_states, seen = {}, [0], {0}
    while open_states:
        state = open_states.pop()
        for symbol in SYMBOLS:
            table[state, symbol] = after = GRAMMAR.step(state, symbol)
            if after[0] not in seen:
                seen.add(after[0])
                open_states.append(after[0])
    return table


TABLE = grammar_table()
FIXED = dict.fromkeys(THREATS, "threat") | {w: symbol for symbol, words in WORDS.items() for w in words.split()}
LATE = {w for _, words in PHRASES for w in words}
PHRASED = [phrase(n, REACH) for n in range(len(PHRASES))]


def symbol_of(word: str) -> str:
    """The symbol of a lower-cased word without outer punctuation."""
    return FIXED.get(word, "other")


def phrased(words: list[str], symbols: list[str]) -> list[str]:
    """``symbols`` after the phrase transducers, each of which reads its own words in place of the others."""
    out = list(symbols)
    for n, ((first, last), machine) in enumerate(zip(PHRASES, PHRASED)):
        if last.isdisjoint(words):
            continue
        state = 0
        for i, word in enumerate(words):
            read = f"late{n}" if word in last else f"early{n}" if first.fullmatch(word) else symbols[i]
            state, found = machine.step(state, read)
            if found == "threat":
                out[i] = "threat"
    return out


def targets_ahead(symbols: list[str]) -> set[int]:
    """Places of threats that a target follows within reach."""
    state, places = 0, set()
    for i in reversed(range(len(symbols))):
        state, out = AHEAD.step(state, symbols[i])
        if out == "threat@":
            places.add(i)
    return places


def pieces_of(text: str | None) -> set[str]:
    """Lower-cased words without outer punctuation, and their beginnings, marked by a trailing star."""
    words = {w.strip(TRIM) for clause in CLAUSE.split((text or "").lower()) for w in clause.split()}
    words.discard("")
    return words | {w[:k] + "*" for w in words for k in STEMS if len(w) > k}


@dataclass
class Model:
    """Lexicon of ``piece -> (toxic texts, other texts)`` of the fit, and the weights of the clause features."""

    toxic: int
    other: int
    lexicon: dict[str, tuple[int, int]]
    weights: list[float] = field(default_factory=list)

    def __post_init__(self):
        self.cost = {p: self.weight(p) for p in self.lexicon}
        self.lengths = sorted({len(p) - 1 for p in self.lexicon if p.endswith("*")})

    def weight(self, piece: str, without: int | None = None) -> float:
        """Log odds of a piece; ``without`` leaves one text of that label out of the counts."""
        yes, no = self.lexicon[piece]
        toxic, other = self.toxic, self.other
        if without is not None:
            yes, toxic = yes - without, toxic - without
            no, other = no - (1 - without), other - (1 - without)
        return math.log((yes + 0.5) / (toxic + 1)) - math.log((no + 0.5) / (other + 1))

    def features(self, text: str | None, without: int | None = None) -> list[float]:
        """Sums over the clauses in which the grammar matches; zeros for a text without a match."""
        lower = (text or "").lower()
        sums = dict.fromkeys(("insult", "insult@", "insult~", 'insult"', "threat", "threat~", 'threat"'), 0.0)
        most, matched, size = 0.0, set(), 0
        for clause in CLAUSE.split(lower):
            words = clause.split()
            size += len(words)
            found = {i: m for i, w in enumerate(words) if (m := self._match(w, without))}
            bare = [w.strip(TRIM) for w in words]
            late = not LATE.isdisjoint(bare)
            if not found and not late and THREATS.isdisjoint(bare):
                continue
            symbols = ["insult" if i in found else symbol_of(w) for i, w in enumerate(bare)]
            if late:
                symbols = phrased(bare, symbols)
            if not found and "threat" not in symbols:
                continue
            state, total = 0, 0.0
            ahead = targets_ahead(symbols) if "threat" in symbols else ()
            for i, symbol in enumerate(symbols):
                piece, gain = found.get(i, (None, 1.0))
                state, out = TABLE[state, symbol]
                if out.startswith("insult"):
                    key = 'insult"' if '"' in out else "insult~" if "~" in out else "insult@" if "@" in out else "insult"
                    sums[key] += gain
                    total += gain
                    matched.add(piece)
                elif symbol == "threat" and ("@" in out or i in ahead):
                    sums['threat"' if '"' in out else "threat~" if "~" in out else "threat"] += gain
                    total += gain
            most = max(most, total)
        every = sum(sums.values())
        return [
            1.0, *(math.log1p(v) for v in sums.values()), math.log1p(most),
            math.log1p(len(matched)), math.log1p(100 * every / max(size, 1)),
        ]

    def _match(self, word: str, without: int | None) -> tuple[str, float] | None:
        """Heaviest path of a word through the lexicon."""
        word = word.strip(TRIM)
        paths = [word] if word in self.cost else []
        paths += [p for k in self.lengths if len(word) > k and (p := word[:k] + "*") in self.cost]
        best = None
        for p in paths:
            gain = self.cost[p] if without is None else self.weight(p, without)
            if gain > 0 and (best is None or gain > best[1]):
                best = (p, gain)
        return best

    def score(self, text: str | None) -> float:
        odds = sum(w * x for w, x in zip(self.weights, self.features(text)))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))


def pruned(counts: list[tuple[str, int, int]], toxic: int, other: int, most: int = LEXICON) -> dict[str, tuple[int, int]]:
    """The heaviest pieces; one whose own beginning weighs no less is left out."""
    model = Model(toxic, other, {p: (yes, no) for p, yes, no in counts})
    kept = {}
    for piece, counted in sorted(model.lexicon.items(), key=lambda x: (-model.cost[x[0]], x[0])):
        whole = piece.rstrip("*")
        shorter = (whole[:k] + "*" for k in STEMS if k < len(whole))
        if len(kept) < most and model.cost[piece] >= LEAST_WEIGHT and not any(s in kept for s in shorter):
            kept[piece] = counted
    return kept


def logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, ridge: float = 1.0, rounds: int = 60) -> np.ndarray:
    """Logistic regression by Newton steps, drawn to ``prior``; the first column is the intercept and is not."""
    w = prior.copy()
    shrink = np.full(len(w), ridge)
    shrink[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(
            (x * (p * (1 - p))[:, None]).T @ x + np.diag(shrink + 1e-9), x.T @ (y - p) - shrink * (w - prior)
        )
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on at most ``fit_rows`` labelled documents outside the held-out fold, drawn by a hash of their id.

    A document with several labels is toxic if one says so. Without both kinds of rows every text
    gets the share of toxic rows as its score.
    """
    rows = labels.where("toxic is not null and doc_id is not null").where(~hits_remainder(F.col("doc_id"), FOLDS, HELD_FOLD))
    rows = rows.groupBy(F.col("doc_id").cast("long").alias("_doc")).agg(F.max("toxic").cast("int").alias("toxic"))
    drawn = rows.orderBy(F.xxhash64("_doc"), "_doc").limit(fit_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), "text")
    # At most ``fit_rows`` rows of two numbers.
    sample = written(texts.join(F.broadcast(drawn), "_doc").select("text", "toxic"), "toxicity-sample")
    total = sample.agg(F.sum("toxic").alias("yes"), F.count("*").alias("n")).first()
    toxic, other = total["yes"] or 0, total["n"] - (total["yes"] or 0)
    if not toxic or not other:
        share = (toxic + 0.5) / (toxic + other + 1)
        return Model(toxic, other, {}, [math.log(share / (1 - share))] + [0.0] * (FEATURES - 1))

    def count(batch: pa.RecordBatch) -> dict[str, list]:
        found: dict[str, list[int]] = {}
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for p in pieces_of(text):
                found.setdefault(p, [0, 0])[1 - y] += 1
        return {"piece": list(found), "yes": [v[0] for v in found.values()], "no": [v[1] for v in found.values()]}

    counts = map_columns(sample, count, "piece string, yes long, no long").groupBy("piece")
    counts = counts.agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).where(F.col("yes") >= LEAST_TEXTS)
    odds = F.log((F.col("yes") + 0.5) / (toxic + 1)) - F.log((F.col("no") + 0.5) / (other + 1))
    # Beginnings of equal weight go with their longer forms, so more are read than are kept.
    heavy = counts.where(odds >= LEAST_WEIGHT).orderBy(F.desc(odds), F.length("piece"), "piece").limit(20 * LEXICON)
    model = Model(toxic, other, pruned([(r["piece"], r["yes"], r["no"]) for r in heavy.collect()], toxic, other))

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batch: pa.RecordBatch) -> dict[str, list]:
        labels = batch.column(1).to_pylist()
        rows = [shared.value.features(t, y) for t, y in zip(batch.column(0).to_pylist(), labels)]
        return {f"f{i}": [r[i] for r in rows] for i in range(FEATURES)} | {"y": labels}

    schema = ", ".join(f"f{i} double" for i in range(FEATURES)) + ", y int"
    table = map_columns(sample, measure, schema).orderBy(*(f"f{i}" for i in range(FEATURES)), "y").toPandas().to_numpy(float)
    model.weights = logistic(table[:, :FEATURES], table[:, FEATURES], PRIOR).tolist()
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` for each row. Null and empty texts match nothing and get the intercept's score;
    repeated rows are each scored, null ids stay null, an empty table gives an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def batch(b: pa.RecordBatch) -> dict[str, object]:
        return {"doc_id": b.column(0), "score": [shared.value.score(t) for t in b.column(1).to_pylist()]}

    return map_columns(docs.select(F.col("doc_id").cast("long"), "text"), batch, "doc_id long, score double")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id",
        hits_remainder(F.col("doc_id"), FOLDS, HELD_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"),
    )
