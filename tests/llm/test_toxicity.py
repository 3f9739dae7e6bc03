"""Toxicity: the composed grammar, the fit on planted words, and held-out accuracy."""

import math
import random
import re

from pyspark.sql import functions as F

from codeloom.llm import toxicity as tox


def plain_marks(symbols):
    out = []
    for i, s in enumerate(symbols):
        if s in ("insult", "threat"):
            last = {}
            for k, trigger in enumerate(symbols[:i]):
                last[trigger] = i - k
            s += "@" if last.get("target", 99) <= tox.REACH else ""
            s += "~" if last.get("negation", 99) <= tox.REACH else ""
            s += '"' if last.get("report", 99) <= 3 * tox.REACH else ""
        out.append(s)
    return out


def test_composed_grammar_equals_each_rule():
    draw = random.Random(6)
    for _ in range(500):
        symbols = [draw.choice(tox.SYMBOLS) for _ in range(draw.randrange(30))]
        state, out = 0, []
        for s in symbols:
            state, o = tox.TABLE[state, s]
            out.append(o)
        assert out == plain_marks(symbols)


def test_clauses_separate_and_kinds_are_told_apart():
    model = tox.Model(100, 900, {"fool": (60, 0), "vilk*": (40, 0)}, [0.0] * tox.FEATURES)
    plain, target, negated, reported = (
        model.features(t)[1:5] for t in ("a fool here", "you are a FOOL!", "this is not a fool", "he wrote such big fool words")
    )
    assert plain[0] > 0 and plain[1:] == [0, 0, 0]
    assert target[1] > 0 and negated[2] > 0 and reported[3] > 0
    assert model.features("you. a fool")[1:3] == plain[:2]
    assert model.features("vilkan")[1] > 0 and model.features("vilk")[1] == 0 and model.features("avilkan")[1] == 0
    assert model.features(None) == model.features("") == [1.0] + [0.0] * (tox.FEATURES - 1)
    assert len(model.features("fool " * 100_000)) == tox.FEATURES


def test_threats_before_and_after_their_target():
    model = tox.Model(100, 900, {}, [0.0] * tox.FEATURES)
    kinds = lambda text: [x > 0 for x in model.features(text)[5:8]]
    for text in ("Kill you", "someone should burn them", "voy a matar a usted", "they will strangle"):
        assert kinds(text) == [True, False, False]
    assert kinds("never kill you") == kinds("they do not kill") == [False, True, False]
    assert kinds("she wrote kill you") == [False, False, True]
    for text in ("kill the process", "kill. you", "kill one two three four you"):
        assert kinds(text) == [False] * 3


def test_threats_whose_words_are_not_in_the_lexicon(spark):
    draw = random.Random(4)
    words = ["".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    docs, labels = [], []
    for i in range(600):
        text = [draw.choice(words) for _ in range(40)]
        text[5:8] = ["kill", "you", "x"] if i % 4 == 0 else ["kill", "process", "x"]
        text[20] = "you"
        docs.append((i, " ".join(text)))
        labels.append((i, int(i % 4 == 0)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    model = tox.fit(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert not {"kill", "you"} & set(model.lexicon)
    rows = tox.score(frame, model).where(tox.hits_remainder(F.col("doc_id"), 3, 1)).collect()
    assert all((r.score >= 0.7) == (r.doc_id % 4 == 0) for r in rows)


def test_held_out_accuracy_and_edges(spark):
    draw = random.Random(2)
    words = ["".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    docs, labels = [], []
    for i in range(900):
        text = [draw.choice(words) for _ in range(60)]
        toxic = i % 6 == 0
        if toxic:
            for k in range(3):
                text[draw.randrange(60)] = draw.choice(["zonk", "zorp", "quaxo" + draw.choice(words)])
        docs.append((i, " ".join(text), "zz", 1.0))
        labels.append((i, int(toxic), "x"))
    docs += [(900, None, "zz", 1.0), (901, "", "zz", 1.0), (None, "zonk zorp zonk", "zz", 1.0), (5, docs[5][1], "zz", 1.0)]
    labels += [(901, None, "x"), (None, 1, "x"), (7, 0, "x"), (5000, 1, "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, score double")
    held = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    model = tox.fit(frame, held)
    assert {"zonk", "zorp"} <= set(model.lexicon) and any(p.startswith("quax") for p in model.lexicon)
    rows = tox.score(frame, model).withColumn("held", tox.hits_remainder(F.col("doc_id"), 3, 1)).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    wrong = [r for r in rows if r.held and r.doc_id < 900 and (r.score >= 0.7) != (r.doc_id % 6 == 0)]
    assert len(wrong) <= 0.03 * sum(r.held for r in rows)
    assert tox.score(frame.where("false"), model).collect() == []
    none = tox.fit(frame, held.where("toxic = 0"))
    assert all(0 <= r.score < 0.1 for r in tox.score(frame, none).collect())
    assert tox.fit(frame, held.where("false")).score("x") == 0.5


def test_query_on_given_tables(spark, sf):
    rows = tox.op10(spark, sf).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == 200 and all((r.score >= 0.7) == bool(r.predicted) for r in rows)
    held = [(r.score >= 0.5, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) >= 0.85 * len(held)


THREATS = [
    "I will kill you", "Ich bringe dich um", "you will be murdered", "slit your throat", "je vais te tuer", "te voy a matar",
    "ich werde dich töten", "he is going to beat you up", "they will strangle her", "wir schlagen dich zusammen", "I break your neck",
]
HARMLESS = [
    "kill the process", "he never killed anyone", "she said they kill him", "das Programm bringt Gewinn", "the bank beat all forecasts",
    "ich bringe das Buch", "cut the bread", "no one will hurt you", "bring up the file",
]


def test_threats_alone_reach_the_verdict(spark, sf):
    """Threats at a target count by their prior; without one, negated or reported they do not."""
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    model = tox.fit(docs, labels)
    assert {t: model.score(t) >= 0.7 for t in THREATS} == dict.fromkeys(THREATS, True)
    assert {t: model.score(t) >= 0.7 for t in HARMLESS} == dict.fromkeys(HARMLESS, False)


def test_score_equals_direct_computation(spark, sf):
    """The score of each given text, taken anew from the lexicon, the rules and the weights."""
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    model = tox.fit(docs, labels)

    def plain(text):
        sums, most, matched, size = dict.fromkeys(("i", "i@", "i~", 'i"', "t", "t~", 't"'), 0.0), 0.0, set(), 0
        for clause in re.split(r"[.!?;:\n]+", (text or "").lower()):
            words = clause.split()
            size += len(words)
            bare = [w.strip(tox.TRIM) for w in words]
            entry = {}
            for i, w in enumerate(bare):
                own = [p for p in model.lexicon if p == w or (p[-1] == "*" and len(w) > len(p) - 1 and w.startswith(p[:-1]))]
                if own and (gain := max(model.weight(p) for p in own)) > 0:
                    entry[i] = gain, max(own, key=model.weight)
            kind = ["insult" if i in entry else tox.symbol_of(w) for i, w in enumerate(bare)]
            for first, last in tox.PHRASES:
                for i, w in enumerate(bare):
                    early = [k for k in range(max(0, i - tox.REACH), i) if first.fullmatch(bare[k]) and not any(x in last for x in bare[k + 1 : i])]
                    if w in last and early:
                        kind[i] = "threat"
            total = 0.0
            for i, marks in enumerate(plain_marks(kind)):
                if kind[i] == "insult":
                    gain, piece = entry[i]
                    matched.add(piece)
                    sums["i" + ('"' if '"' in marks else "~" if "~" in marks else "@" if "@" in marks else "")] += gain
                    total += gain
                elif kind[i] == "threat" and ("@" in marks or "target" in kind[i + 1 : i + 1 + tox.REACH]):
                    sums["t" + ('"' if '"' in marks else "~" if "~" in marks else "")] += 1
                    total += 1
            most = max(most, total)
        x = [1.0, *(math.log1p(v) for v in sums.values()), math.log1p(most), math.log1p(len(matched))]
        x.append(math.log1p(100 * sum(sums.values()) / max(size, 1)))
        return 1 / (1 + math.exp(-sum(w * v for w, v in zip(model.weights, x))))

    texts = [r.text for r in docs.collect()] + THREATS + HARMLESS + [None, ""]
    for text in texts:
        assert abs(model.score(text) - plain(text)) < 1e-9, text
