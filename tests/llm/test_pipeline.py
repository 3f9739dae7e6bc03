"""The pipeline stage by stage against plain computations on the rows each stage is given."""

import corpus_pipeline
from codeloom.llm import pseudonyms, quality
from tests.llm.test_decontaminate import plain_leaks
from tests.llm.test_quality import plain_counts
from tests.llm.test_simhash import expected


def test_stages_follow_each_other(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    seen = [{r.doc_id: r.text for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, sf), name)
        assert docs.columns == columns
        seen.append({r.doc_id: r.text for r in docs.collect()})
    start, good, single, clean, named = seen
    failing = {d for d, t in start.items() if (c := plain_counts(t))[0] < 50 or 2 * c[4] > c[0]}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert not failing & set(good)
    for d in set(start) - failing:
        assert labels.get(d) is None or (d in good) == (labels[d] == 1)
    assert set(single) == {d for d, _, c in expected(list(good.items())) if d == c}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert set(clean) == set(single) - {r[0] for r in plain_leaks(list(single.items()), items)}
    assert named == {d: pseudonyms.pseudonymise(t, pseudonyms.SAMPLE_KEY)[0] for d, t in clean.items()}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in pieces} == set(named)
    whole = corpus_pipeline.run(spark, sf).collect()
    key = lambda r: (r.doc_id, r.start)
    assert [(key(r), r.ids_crc32) for r in sorted(whole, key=key)] == [(key(r), r.ids_crc32) for r in sorted(pieces, key=key)]


def test_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, sf), name)
    assert docs.collect() == [] and quality.COUNTS
