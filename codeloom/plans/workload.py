"""One registered query per operator, over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codeloom.functions import effects as E
from codeloom.functions import vectors as V
from codeloom.operators import (
    classification as C,
    clustering as K,
    embedding as M,
    enrichment as N,
    extract as X,
    labelling as L,
    layout,
    neighbours as P,
    reporting as R,
    retrieval as Q,
)
from codeloom.plans import scoring as S
from codeloom.schemas import FEATURE_ORDER
from codeloom.session import stored
from codeloom.sources import corpus, io
from codeloom.sources.corpus import document_code, sources_from_part, words
from codeloom.sources.tables import (
    corpus_facts,
    corpus_functions,
    corpus_sources,
    labelled_vectors,
    scratch,
    spread,
    table,
    vectors_with_features,
)
from codeloom.sources.vectorstore import VectorStore, embed_missing
from codeloom.streaming import jobs

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def joined(col: str, sep: str = ","):
    return F.array_join(col, sep)


# --- sources and sinks ------------------------------------------------------------


@query
def src1_read_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Every document written as a file of its own and read back whole."""
    path = scratch(spark, "sources")
    io.write_sources(spread(table(spark, sf, "documents")).select("text"), path)
    body = F.regexp_replace("text", r"\n\z", "")
    return io.read_sources(spark, path, "*.txt").select(
        F.md5(body).alias("digest"), F.length(body).alias("n_chars")
    )


@query
def src2_read_functions(spark, sf):
    """The function table through JSON Lines and back with the fixed schema."""
    path = scratch(spark, "functions")
    io.write_functions(corpus_functions(spark, sf), path, "json")
    return io.read_functions(spark, path).select(
        "function_id",
        "fn_no",
        "function_name",
        F.col("ast_features.call_count").alias("call_count"),
        joined("control_flow_elements").alias("control_flow"),
        F.md5(joined("call_names", "|")).alias("calls_digest"),
        F.col("labels").isNull().alias("unlabelled"),
    )


@query
def src3_write_functions(spark, sf):
    """Two stages, each with a path of its own; the second adds its columns."""
    first, second = scratch(spark, "stage1"), scratch(spark, "stage2")
    io.write_functions(corpus_functions(spark, sf), first)
    labelled = L.deterministic_side_effects(spark.read.parquet(first))
    io.write_functions(labelled, second)
    return (
        spark.read.parquet(second)
        .groupBy("side_effects_source", joined("side_effects").alias("effects"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def src4_write_snapshot(spark, sf):
    """Two versions of one output; a reader gets the later one."""
    path = scratch(spark, "snapshot")
    documents = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    io.write_snapshot(documents, path)
    io.write_snapshot(documents.withColumn("n_chars", F.col("n_chars") * 2), path)
    return io.read_snapshot(spark, path).select("doc_id", "lang", "n_chars")


@query
def src4_claimed_versions(spark, sf):
    """A version that another writer has claimed is left to it, and old versions are retired."""
    path = scratch(spark, "snapshots")
    documents = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    io.write_snapshot(documents, path)
    io.claim(spark, path, 2)
    last = io.write_snapshot(documents.withColumn("n_chars", F.col("n_chars") + 3), path, keep=1)
    return io.read_snapshot(spark, path).select("doc_id", "n_chars", F.lit(int(last.rpartition("=")[2])).alias("version"))


@query
def src5_save_vectors_and_labels(spark, sf):
    path = scratch(spark, "vectors")
    io.save_vectors_and_labels(
        labelled_vectors(spark, sf), path, id_col="vec_id", vec_col="embedding", label_col="labels"
    )
    v = F.col("embedding").cast("array<double>")
    return spark.read.parquet(path).select(
        "vec_id",
        F.size("embedding").alias("dim"),
        F.round(V.dot(v, v), 4).alias("norm"),
        joined("labels").alias("labels"),
    )


def _line_numbers() -> dict:
    return {
        "l_quantity": F.col("l_quantity"),
        "l_extendedprice": F.col("l_extendedprice"),
        "l_discount": F.col("l_discount"),
        "l_tax": F.col("l_tax"),
        "constant": F.lit(5.0),
    }


@query
def src6_model_tables(spark, sf):
    """Scaler and classifier tables saved, checked for and loaded."""
    path = scratch(spark, "models")
    scaler = M.fit_scaler(table(spark, sf, "lineitem"), _line_numbers())
    io.save_model_tables(scaler, fixed_model(64).table(spark), path)
    loaded, model = io.load_model_tables(spark, path)
    return loaded.select(
        "feature", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"),
        F.lit(len(model.classes)).alias("n_classes"),
    )


@query
def src7_write_metrics(spark, sf):
    path = scratch(spark, "metrics")
    metrics = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("name")).agg(
        F.avg("l_quantity").alias("value"), F.count(F.lit(1)).alias("n")
    )
    io.write_metrics(metrics, path, {"value": 4})
    return io.read_metrics(spark, path, "name string, value double, n bigint")


# --- extraction -------------------------------------------------------------------


@query
def ext1_tokenize_sources(spark, sf):
    """Tokens of every whole document text with offset and line."""
    sources = spread(table(spark, sf, "documents")).select(
        F.col("doc_id").cast("string").alias("file_path"), "text"
    )
    return (
        X.tokenize_sources(sources)
        .groupBy("file_path")
        .agg(
            F.count(F.lit(1)).alias("n_tokens"),
            F.sum(F.col("off").cast("bigint")).cast("bigint").alias("sum_off"),
            F.sum(F.col("line").cast("bigint")).cast("bigint").alias("sum_line"),
            F.max(F.length("tok")).cast("int").alias("longest"),
        )
    )


@query
def ext2_extract_functions(spark, sf):
    return X.function_slices(corpus_sources(spark, sf)).select(
        "function_id", "file_path", "fn_no", F.md5("function_code").alias("code_digest")
    )


def _feature(name: str):
    def run(spark, sf):
        return corpus_facts(spark, sf).select("function_id", name)

    return run


@query
def ext3_function_name(spark, sf):
    return corpus_functions(spark, sf).select("function_id", "function_name")


for _number, _name in (
    (4, "if_count"), (5, "loop_count"), (6, "return_count"), (7, "call_count"),
    (8, "pointer_count"), (9, "param_count"), (10, "line_count"), (11, "nesting_depth"),
):
    QUERIES[f"ext{_number}_{_name}"] = _feature(_name)


@query
def ext8_pointers_by_types(spark, sf):
    """Pointers where statements ``a * b;`` are declarations or products by the type names of the corpus."""
    sources = sources_from_part(spread(table(spark, sf, "part")))
    functions = X.resolve_pointers(X.extract_functions(sources), X.known_types(sources))
    return functions.select("function_id", F.col("ast_features.pointer_count").alias("pointer_count"))


@query
def ext11_tree_height(spark, sf):
    """Heights of the syntax trees of all functions that follow from line items."""
    sources = corpus.sources_from_lineitem(spread(table(spark, sf, "lineitem")))
    return X.with_tree_height(X.function_slices(sources)).select("function_id", "tree_height")


@query
def ext12_control_flow_elements(spark, sf):
    return corpus_functions(spark, sf).select(
        "function_id", joined("control_flow_elements").alias("control_flow")
    )


@query
def ext13_call_names(spark, sf):
    return corpus_functions(spark, sf).select(
        "function_id", F.md5(joined("call_names", "|")).alias("calls_digest")
    )


@query
def ext14_feature_struct(spark, sf):
    return corpus_functions(spark, sf).select("function_id", "ast_features.*")


@query
def ext15_functions_per_file(spark, sf):
    sources = corpus_sources(spark, sf)
    return X.functions_per_file(sources, X.function_slices(sources))


@query
def ext16_corpus_stats(spark, sf):
    return X.corpus_stats(corpus_facts(spark, sf)).withColumn(
        "avg_lines", F.round("avg_lines", 4)
    )


# --- labelling --------------------------------------------------------------------

# A dictionary for document words in place of call names.
WORD_SIGNALS = {
    "memory": {"exact": ["the", "de", "und"], "prefix": ["me"]},
    "io": {"exact": ["and", "to"], "prefix": ["st", "pr"]},
    "hardware": {"exact": ["der", "la"], "prefix": ["hard"]},
}


@query
def lab1_signal_table(spark, sf):
    """Every signal with the number of functions that call it by exact name."""
    used = (
        corpus_functions(spark, sf)
        .select(F.explode(F.array_distinct("call_names")).alias("pattern"))
        .groupBy("pattern")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return (
        L.signal_table(spark)
        .join(used, "pattern", "left")
        .select("label", "kind", "pattern", F.coalesce("_n", F.lit(0)).alias("n_functions"))
    )


@query
def lab2_deterministic_side_effects(spark, sf):
    return L.deterministic_side_effects(corpus_functions(spark, sf)).select(
        "function_id", joined("side_effects").alias("effects")
    )


def _document_words(spark, sf):
    return spread(table(spark, sf, "documents")).select(
        "doc_id", words(F.col("text")).alias("call_names")
    )


@query
def lab2_side_effects_from_table(spark, sf):
    """The dictionary as a table, matched by joins."""
    return L.side_effects_from_table(
        _document_words(spark, sf), L.signal_table(spark, WORD_SIGNALS), id_col="doc_id"
    ).select("doc_id", joined("side_effects").alias("effects"))


@query
def lab3_is_ambiguous(spark, sf):
    return L.deterministic_side_effects(corpus_functions(spark, sf)).select(
        "function_id", "is_ambiguous"
    )


@query
def lab4_side_effects_source(spark, sf):
    return L.deterministic_side_effects(
        _document_words(spark, sf), signals=WORD_SIGNALS
    ).select("doc_id", "side_effects_source", joined("side_effects").alias("effects"))


SOME_SIGNALS = {"io": {"exact": ["and"], "prefix": ["st"]}}


def _label_generate(prompt):
    """Replies of four kinds by the length of the prompt."""
    kind = len(prompt) % 4
    if kind == 3:
        raise RuntimeError("no reply")
    return ('{"side_effects": ["memory"]}', "not JSON", "[1]")[kind]


def _label_chat(messages):
    if len(messages[0]["content"]) % 5 == 0:
        raise RuntimeError("no answer")
    return f"turn {len(messages)}"


@query
def lab_label_functions(spark, sf):
    """All labelling steps on documents as functions: rules, fallback, purpose, error records."""
    rows = spread(table(spark, sf, "documents")).select(
        "doc_id",
        F.col("text").alias("function_code"),
        words(F.col("text")).alias("call_names"),
        F.array(F.col("lang")).alias("control_flow_elements"),
    )
    done = N.label_functions(rows, _label_generate, _label_chat, signals=SOME_SIGNALS)
    labels = F.col("labels")
    return done.select(
        "doc_id", "side_effects_source",
        labels["high_level_purpose"].alias("purpose"),
        joined("labels.side_effects").alias("effects"),
        joined("labels.control_flow_elements").alias("control_flow"),
    )


@query
def lab5_prompts(spark, sf):
    """Per conversation: its even turns as the code, its odd turns as the reply."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))

    def side(parity: int) -> Column:
        own = F.collect_list(F.when(F.col("turn") % 2 == parity, F.struct("turn", "text")))
        return F.array_join(F.array_sort(own)["text"], "\n")

    chats = turns.groupBy("conv_id").agg(side(0).alias("code"), side(1).alias("reply"))
    messages = E.purpose_messages(F.col("code"), F.col("reply"))
    flat = F.array_join(F.transform("messages", lambda m: F.concat_ws(":", m["role"], m["content"])), "\n")
    return (
        chats.withColumn("messages", messages)
        .select(
            "conv_id",
            F.md5(E.effects_prompt(F.col("code"))).alias("prompt_digest"),
            F.md5(flat).alias("messages_digest"),
        )
    )


@query
def lab6_parse_effects_reply(spark, sf):
    """Replies of ten shapes made from the event columns."""
    kind = F.element_at(
        F.array(*[F.lit(x) for x in ("io", "memory", "hardware", "none", "disk")]),
        (F.col("user_id") % 5 + 1).cast("int"),
    )
    shapes = [
        F.concat(F.lit('```json\n{"side_effects": ["'), kind, F.lit('", "io", "disk"]}\n```')),
        F.concat(F.lit('{"side_effects": ["'), kind, F.lit('", "'), kind, F.lit('"]}')),
        F.concat(F.lit("I think it is "), kind),
        F.col("props"),
        F.lit('{"side_effects": []}'),
        F.concat(F.lit('{"side_effects": "'), kind, F.lit('"}')),
        F.concat(F.lit('["'), kind, F.lit('"]')),
        F.lit('{"side_effects": null}'),
        F.concat(F.lit('{"side_effects": [1, null, "'), kind, F.lit('"]}')),
        F.concat(F.lit('{"side_effects": [["'), kind, F.lit('"]]}')),
    ]
    shape = (F.col("event_id") % 10).cast("int")
    reply = F.coalesce(*[F.when(shape == i, s) for i, s in enumerate(shapes)])
    # Without a user the kind is undefined, and the lists of these two shapes were never read.
    unread = F.col("user_id").isNull() & shape.isin(0, 9)
    unlabelled = F.struct(F.array(F.lit("none")).alias("effects"), F.lit("default").alias("status"))
    return (
        table(spark, sf, "events")
        .withColumn("_reply", reply)
        .withColumn("_p", F.when(~unread, E.parse_effects_reply(F.col("_reply"))).otherwise(unlabelled))
        .select("event_id", joined("_p.effects").alias("effects"), F.col("_p.status").alias("status"))
    )


def _measured(text: str) -> str:
    if len(text) % 7 == 0:
        raise ValueError("length divisible by seven")
    return str(len(text))


@query
def lab7_enrich(spark, sf):
    """A model function that fails on some rows; English rows are not asked."""
    documents = spread(table(spark, sf, "documents"))
    asked = N.enrich(
        documents, _measured, F.when(F.col("lang") != "en", F.col("text")), "answer"
    )
    return asked.select("doc_id", "answer.value", F.col("answer.error").alias("error"))


def _talk(messages: list[dict]) -> str:
    total = sum(len(m["content"]) for m in messages)
    if len(messages) == 3 and len(messages[0]["content"]) % 11 == 0:
        raise RuntimeError("no answer")
    return f"{len(messages)} messages of {total}"


@query
def lab8_purpose(spark, sf):
    documents = spread(table(spark, sf, "documents")).select("doc_id", "text")
    return N.add_purpose(documents, _talk, "text").select("doc_id", "high_level_purpose")


@query
def lab9_assemble_labels(spark, sf):
    rows = L.deterministic_side_effects(corpus_functions(spark, sf)).withColumn(
        "high_level_purpose", F.concat(F.lit("about "), F.col("function_name"))
    )
    return L.assemble_labels(rows).select(
        "function_id",
        F.col("labels.high_level_purpose").alias("purpose"),
        joined("labels.control_flow_elements").alias("control_flow"),
        joined("labels.side_effects").alias("effects"),
    )


@query
def lab10_pending(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang")
    return L.pending(documents, table(spark, sf, "labels"), "doc_id")


@query
def lab11_enrich_incremental(spark, sf):
    """Staged in files, enriched as a stream with progress per batch."""
    staged, out, progress = (scratch(spark, n) for n in ("staged", "enriched", "progress"))
    documents = table(spark, sf, "documents").select("doc_id", "text")
    jobs.stage_for_enrichment(documents, staged, batch=500)
    run = jobs.enrich_incremental(
        spark,
        staged,
        documents.schema,
        lambda batch: N.enrich(batch, _measured, F.col("text"), "answer").drop("text"),
        out,
        progress,
        files_per_batch=8,
    )
    run.awaitTermination()
    return spark.read.parquet(out).select(
        "doc_id", F.col("answer.value").alias("value"), F.col("answer.error").alias("error")
    )


@query
def lab12_limit_rows(spark, sf):
    return L.limit_rows(corpus_functions(spark, sf), 25).select("function_id", "function_name")


@query
def lab13_source_breakdown(spark, sf):
    documents = table(spark, sf, "documents").select(
        F.nullif(F.col("source"), F.lit("src0")).alias("side_effects_source")
    )
    return L.source_breakdown(documents)


# --- embedding and fusion ---------------------------------------------------------


def _counting_encoder():
    def encode(texts: list[str]) -> list[list[float]]:
        return [[len(t), t.count("a"), t.count("\n"), t.count(" ")] for t in texts]

    return encode


@query
def emb1_embed(spark, sf):
    documents = spread(table(spark, sf, "documents")).select("doc_id", "text")
    v = F.col("embedding")
    return M.embed(documents, "text", _counting_encoder, 4).select(
        "doc_id", *[v[i].cast("double").alias(f"v{i}") for i in range(4)]
    )


@query
def emb2_hash_embed(spark, sf):
    return M.hash_embed(_document_words(spark, sf), "call_names", 64).select(
        "doc_id", F.posexplode("embedding").alias("bucket", "v")
    ).select("doc_id", "bucket", F.round(F.col("v").cast("double"), 4).alias("value"))


@query
def emb3_truncation_flag(spark, sf):
    flagged = M.truncation_flag(_document_words(spark, sf), "call_names", 128)
    return flagged.select(
        "doc_id", "truncated", F.md5(joined("head_tokens", " ")).alias("head_digest")
    )


@query
def emb3_truncated_count(spark, sf):
    return M.truncated_count(M.truncation_flag(_document_words(spark, sf), "call_names"))


@query
def emb4_pending_embeddings(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id").join(
        table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding"),
        "doc_id",
        "left",
    )
    return M.pending_embeddings(rows).select("doc_id")


@query
def emb4_write_back(spark, sf):
    """The given vectors merged into a store, then every document that lacks one embedded, twice over."""
    store = VectorStore(spark, scratch(spark, "vectors"), "doc_id")
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    store.merge(vectors)
    documents = table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("long").alias("n_chars"))

    def encode(rows):
        return rows.withColumn("embedding", F.array((F.col("n_chars") % 1000).cast("float"), F.lit(1.0).cast("float")))

    first = embed_missing(documents, store, encode)
    second = embed_missing(documents, store, encode)
    found = store.read(vectors).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_vectors"), F.round(F.max(F.col("embedding")[0].cast("double")), 4).alias("first_entry")
    )
    return documents.select("doc_id").join(found, "doc_id", "left").select(
        "doc_id", "n_vectors", "first_entry", F.lit(first.n_new).cast("long").alias("n_first"), F.lit(second.n_written).cast("long").alias("n_second")
    )


@query
def emb5_missing_counts(spark, sf):
    rows = (
        table(spark, sf, "documents")
        .select("doc_id")
        .join(table(spark, sf, "labels"), "doc_id", "left")
        .join(
            table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding"),
            "doc_id",
            "left",
        )
    )
    return M.missing_counts(rows, ["doc_id", "quality", "embedding"])


@query
def emb6_embedding_preview(spark, sf):
    head = V.preview(F.col("embedding"))
    return table(spark, sf, "embeddings").select(
        "vec_id",
        F.size("embedding").alias("dim"),
        *[F.round(head[i].cast("double"), 5).alias(f"p{i}") for i in range(3)],
    )


@query
def fus1_feature_vector(spark, sf):
    return corpus_functions(spark, sf).select(
        "function_id",
        joined(V.feature_vector(F.col("ast_features")).cast("array<int>"), " ").alias("features"),
    )


@query
def fus2_fit_scaler(spark, sf):
    return M.fit_scaler(table(spark, sf, "lineitem"), _line_numbers()).select(
        "feature", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std")
    )


@query
def fus3_apply_scaler(spark, sf):
    lines = table(spark, sf, "lineitem")
    scaled = M.apply_scaler(lines, _line_numbers(), M.fit_scaler(lines, _line_numbers()))
    v = F.col("scaled_features")
    return scaled.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        *[F.round(v[i], 4).alias(f"z{i}") for i in range(5)],
    )


def _fused(spark, sf):
    rows = vectors_with_features(spark, sf)
    scaler = M.fit_scaler(rows, M.feature_columns())
    return M.fuse(M.apply_scaler(rows, M.feature_columns(), scaler), expect_dim=72)


@query
def fus4_fuse(spark, sf):
    v = F.col("fused_embedding")
    return _fused(spark, sf).select(
        "vec_id",
        F.size(v).alias("dim"),
        *[F.round(v[i], 4).alias(f"f{i}") for i in (0, 63, 64, 67, 71)],
    )


# --- classification ---------------------------------------------------------------

CLASSES = ["hardware", "io", "memory", "none"]


def fixed_model(dim: int) -> C.LinearModel:
    """Weights given by a rule."""

    def weight(c: int, i: int) -> float:
        return ((i * 7 + c * 3) % 11 - 5) / 10

    return C.LinearModel(
        CLASSES,
        [(c - 1) / 10 for c in range(4)],
        [[weight(c, i) for i in range(dim)] for c in range(4)],
    )


def _predicted(spark, sf):
    return C.predict_labels(labelled_vectors(spark, sf), "embedding", fixed_model(64))


@query
def cls1_binarize_labels(spark, sf):
    rows = labelled_vectors(spark, sf)
    classes = C.class_list(rows, "labels")
    return C.binarize_labels(rows, "labels", classes).select(
        "vec_id", *[f"is_{c}" for c in classes]
    )


@query
def cls2_label_distribution(spark, sf):
    return C.label_distribution(labelled_vectors(spark, sf), "labels").select(
        "label", "n", F.round("pct", 4).alias("pct")
    )


@query
def cls3_split(spark, sf):
    return C.split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query
def cls4_fit_one_vs_rest(spark, sf):
    """At the fitted weights no entry of the objective's gradient, taken anew in SQL, is far from zero."""
    rows = labelled_vectors(spark, sf)
    classes = C.class_list(rows, "labels")
    model = C.fit_one_vs_rest(rows, "embedding", "labels", classes)
    fitted = model.table(spark).select("class", "intercept", "coefficients")
    asked = F.explode(F.array(*(F.lit(c) for c in classes)))
    wrong = rows.select("labels", F.col("embedding").cast("array<double>").alias("x"), asked.alias("class"))
    wrong = wrong.join(F.broadcast(fitted), "class")
    score = V.dot(F.col("x"), F.col("coefficients")) + F.col("intercept")
    wrong = wrong.withColumn("r", 1 / (1 + F.exp(-score)) - F.array_contains("labels", F.col("class")).cast("double"))
    # The intercept is the entry of a component that is always 1.
    sums = wrong.select("class", "r", F.posexplode(F.concat(F.col("x"), F.array(F.lit(1.0))))).groupBy("class", "pos").agg(
        F.sum(F.col("r") * F.col("col")).alias("slope"), F.count(F.lit(1)).alias("n")
    )
    weights = fitted.select("class", F.posexplode(F.concat("coefficients", F.array(F.lit(0.0)))).alias("pos", "w"))
    return sums.join(weights, ["class", "pos"]).groupBy("class").agg(
        (F.count(F.lit(1)) - 1).cast("int").alias("dim"),
        (F.max(F.abs(F.col("slope") + F.col("w")) / F.col("n")) < 1e-5).alias("is_optimal"),
    )


@query
def cls5_predict_labels(spark, sf):
    return _predicted(spark, sf).select("vec_id", joined("predicted_labels").alias("predicted"))


def _report(spark, sf):
    return C.classification_report(
        _predicted(spark, sf), "labels", "predicted_labels", CLASSES
    )


@query
def cls6_classification_report(spark, sf):
    return _report(spark, sf).select(
        "class",
        *[F.round(m, 4).alias(m) for m in ("precision", "recall", "f1")],
        "support",
    )


VARIANTS = {
    "counts (8-dim)": "scaled_features",
    "vector (64-dim)": "embedding",
    "fused (72-dim)": "fused_embedding",
}


@query
def cls7_ablation(spark, sf):
    """Counts only, vector only and fused on one split: support, and what holds for the scores of any fit."""
    report, _ = C.ablation(C.split(_fused(spark, sf), "vec_id"), VARIANTS, "labels", CLASSES)
    own = Window.partitionBy("variant")
    is_class = ~F.col("class").endswith(" avg")
    support = F.sum(F.when(is_class, F.col("support"))).over(own)
    weighted = F.sum(F.when(is_class, F.col("f1") * F.col("support"))).over(own) / support
    macro = F.sum(F.when(is_class, F.col("f1"))).over(own) / len(CLASSES)
    mean = F.when(F.col("class") == "macro avg", macro).when(F.col("class") == "weighted avg", weighted)
    low, high = F.least("precision", "recall"), F.greatest("precision", "recall")
    between = (F.col("f1") >= low - 1e-9) & (F.col("f1") <= high + 1e-9)
    return report.select(
        "variant", "class", "support",
        F.when(is_class | (F.col("class") == "micro avg"), between).otherwise(F.col("f1").between(0, 1)).alias("in_range"),
        F.coalesce(F.abs(F.col("f1") - mean) < 1e-9, F.lit(True)).alias("averages_fit"),
    )


@query
def cls8_worst_class(spark, sf):
    return C.worst_class(_report(spark, sf)).select("class", F.round("f1", 4).alias("f1"))


@query
def cls9_examples_for_label(spark, sf):
    return C.examples_for_label(
        labelled_vectors(spark, sf), "memory", "labels", ["vec_id"], 5
    ).select("vec_id", joined("labels").alias("labels"))


# --- retrieval --------------------------------------------------------------------


def _neighbouring_rows(spark, sf):
    """Each vector beside the one with the next number."""
    rows = labelled_vectors(spark, sf)
    shifted = rows.select(
        (F.col("vec_id") - 1).alias("vec_id"),
        F.col("embedding").alias("other"),
        F.col("labels").alias("other_labels"),
    )
    return rows.join(shifted, "vec_id")


def _hits(spark, sf, k=5):
    rows = labelled_vectors(spark, sf)
    return rows, P.nearest(rows, rows, k, "vec_id", "embedding", "labels")


@query
def ret1_cosine(spark, sf):
    return _neighbouring_rows(spark, sf).select(
        "vec_id", F.round(V.cosine(F.col("embedding"), F.col("other")), 5).alias("cosine")
    )


@query
def ret2_top_k_neighbours(spark, sf):
    _, hits = _hits(spark, sf)
    return hits.select(
        "query_id", "rank", "neighbour_id", F.round("similarity", 5).alias("similarity")
    )


@query
def ret2_top_k_pruned(spark, sf):
    """The same by pivot cells, in blocks so small that there are many; kept up even where bounds do not pay."""
    rows = labelled_vectors(spark, sf)
    found = P.pruned_neighbours(rows, rows, 5, "vec_id", "embedding", "labels", block_rows=64, worth=float("inf"))
    return found.hits.select(
        "query_id", "rank", "neighbour_id", F.round("similarity", 5).alias("similarity")
    )


@query
def ret2_pruned_customers(spark, sf):
    """Vectors of four columns, whose bounds leave out more than half of all pairs."""
    entries = [F.col("c_nationkey") + 1, F.col("c_acctbal") / 1000, F.col("c_custkey") % 7 + 1, F.lit(5)]
    rows = table(spark, sf, "customer").select(
        "c_custkey", F.array(*(x.cast("double") for x in entries)).cast("array<float>").alias("v")
    )
    found = P.pruned_neighbours(rows, rows, 3, "c_custkey", "v", block_rows=32, worth=float("inf"))
    return found.hits.select(
        "query_id", "rank", "neighbour_id", F.round("similarity", 5).alias("similarity"),
        F.lit(2 * found.compared < found.possible).alias("under_half"),
    )


@query
def ret3_relevant(spark, sf):
    return _neighbouring_rows(spark, sf).select(
        "vec_id", E.relevant(F.col("labels"), F.col("other_labels")).alias("rel")
    )


@query
def ret4_mrr_at_k(spark, sf):
    rows, hits = _hits(spark, sf)
    return Q.mrr_at_k(hits, rows, "vec_id", 5).select("query_id", F.round("mrr", 4).alias("mrr"))


@query
def ret5_relevant_count(spark, sf):
    return Q.relevant_count(labelled_vectors(spark, sf), "vec_id", "labels")


@query
def ret6_recall_at_k(spark, sf):
    rows, hits = _hits(spark, sf)
    return Q.recall_at_k(hits, Q.relevant_count(rows, "vec_id", "labels"), 3).select(
        "query_id", F.round("recall", 4).alias("recall")
    )


@query
def ret7_retrieval_report(spark, sf):
    rows, hits = _hits(spark, sf)
    return Q.retrieval_report(rows, hits, "vec_id", "labels")


@query
def ret8_chance_level(spark, sf):
    return Q.chance_level(labelled_vectors(spark, sf), "labels").select(
        F.round("chance", 4).alias("chance")
    )


@query
def ret9_worst_query(spark, sf):
    rows, hits = _hits(spark, sf)
    per_query = Q.per_query_metrics(rows, hits, "vec_id", "labels")
    return Q.worst_query_hits(per_query, hits).select(
        "query_id", F.round("mrr", 4).alias("mrr"), "rank", "neighbour_id",
        joined("query_labels").alias("query_labels"),
        joined("neighbour_labels").alias("neighbour_labels"),
    )


@query
def ret10_inspect_query(spark, sf):
    rows, hits = _hits(spark, sf)
    return Q.inspect_query(rows, hits, "vec_id", "labels", ["none"]).select(
        "query_id", "n_such_rows", "rank", "neighbour_id", "rel",
        joined("neighbour_labels").alias("neighbour_labels"),
    )


# --- clustering -------------------------------------------------------------------


def fixed_centroids(dim: int = 64, k: int = 3) -> list[list[float]]:
    return [[((i * 5 + j * 7) % 9 - 4) / 20 for i in range(dim)] for j in range(k)]


def _clustered(spark, sf):
    return K.assign_clusters(labelled_vectors(spark, sf), "embedding", fixed_centroids())


def _profile(spark, sf):
    return K.cluster_profile(_clustered(spark, sf), "cluster", "labels", 3)


@query
def clu1_fit_kmeans(spark, sf):
    """Each fitted centre is the mean of the rows that are nearest to it."""
    vectors = labelled_vectors(spark, sf)
    centres = K.centroids_of(K.fit_kmeans_shared(vectors, "embedding", k=3))
    fitted = spark.createDataFrame(list(enumerate(centres)), "cluster int, centroid array<double>")
    entries = K.assign_clusters(vectors, "embedding", centres).select("cluster", F.posexplode("embedding"))
    means = entries.groupBy("cluster", "pos").agg(F.avg(F.col("col").cast("double")).alias("mean"))
    return (
        fitted.select("cluster", F.size("centroid").alias("dim"), F.posexplode("centroid"))
        .join(means, ["cluster", "pos"])
        .groupBy("cluster", "dim")
        .agg((F.max(F.abs(F.col("col") - F.col("mean"))) < 1e-3).alias("is_mean"))
    )


@query
def clu2_assign_clusters(spark, sf):
    return _clustered(spark, sf).select("vec_id", "cluster")


@query
def clu3_dominant_label(spark, sf):
    return labelled_vectors(spark, sf).select(
        "vec_id", E.dominant_label(F.col("labels")).alias("dominant")
    )


@query
def clu4_cluster_profile(spark, sf):
    return _profile(spark, sf).select(
        "cluster", "size", "dominant_label", "purity",
        F.array_join(
            F.transform(
                F.array_sort(F.map_entries("distribution")),
                lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")),
            ),
            ",",
        ).alias("distribution"),
    )


@query
def clu5_overall_purity(spark, sf):
    return K.overall_purity(_profile(spark, sf)).select(
        F.round("purity", 4).alias("purity"), F.round("majority_share", 4).alias("majority_share")
    )


@query
def clu6_misfits(spark, sf):
    rows = K.misfits(_clustered(spark, sf), _profile(spark, sf), "cluster", "labels")
    return K.misfit_report(rows, "vec_id").select(
        "vec_id", "cluster", "true_label", "cluster_label", "n_misfits"
    )


@query
def clu7_drill_down(spark, sf):
    """The row of a function found by its key."""
    rows = L.deterministic_side_effects(corpus_functions(spark, sf)).withColumn(
        "high_level_purpose", F.lit("")
    )
    return K.drill_down(L.assemble_labels(rows), "d7.c#1").withColumn(
        "side_effects", joined("side_effects")
    )


@query
def clu8_project_2d(spark, sf):
    """Points of every series of both views, and whether the first component varies more than the second."""
    points = K.project_2d(
        _fused(spark, sf),
        {"vector": "embedding", "fused": "fused_embedding"},
        "vec_id",
        "labels",
    )
    spread = points.dropDuplicates(["view", "vec_id"]).groupBy("view").agg(
        (F.var_pop("x") >= F.var_pop("y")).alias("is_ordered")
    )
    return points.groupBy("view", "label").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(spread), "view")


@query
def clu8_neighbour_layout(spark, sf):
    """The axes of the layout satisfy the eigen equation of the neighbour graph, taken anew, and do not lean on each other."""
    found = layout.neighbour_layout(labelled_vectors(spark, sf), "embedding", "vec_id")
    degree = found.edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree")).withColumnRenamed("src", "id")
    sums = found.points.join(degree, "id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("x") * F.col("y") * F.col("degree")).alias("xy"),
        F.greatest(F.abs(F.sum(F.col("x") * F.col("degree"))), F.abs(F.sum(F.col("y") * F.col("degree")))).alias("lean"),
    )
    facts = layout.residuals(found)
    return facts.join(F.broadcast(sums.withColumn("axis", F.explode(F.array(F.lit("x"), F.lit("y"))))), "axis").select(
        "axis", "n", (F.abs(F.col("length") - 1) < 1e-6).alias("is_unit"), (F.col("residual") < 0.05).alias("is_eigenvector"),
        ((F.abs("xy") < 1e-6) & (F.col("lean") < 1e-6)).alias("is_orthogonal"),
    )


# --- reports ----------------------------------------------------------------------


def _report_columns() -> dict:
    return {
        "l_quantity": F.col("l_quantity"),
        "l_extendedprice": F.col("l_extendedprice"),
        "l_discount": F.col("l_discount"),
    }


@query
def rep1_histogram(spark, sf):
    columns = _report_columns() | {"constant": F.lit(5.0)}
    return R.histogram(table(spark, sf, "lineitem"), columns).select(
        "column", "bin", F.round("lo", 3).alias("lo"), F.round("hi", 3).alias("hi"), "n"
    )


@query
def rep2_describe(spark, sf):
    return R.describe(table(spark, sf, "lineitem"), _report_columns())


@query
def rep2_describe_features(spark, sf):
    """Summary of the structural counts of the whole function table."""
    return R.describe(corpus_facts(spark, sf), {f: F.col(f) for f in FEATURE_ORDER})


@query
def rep3_evaluation_summary(spark, sf):
    rows, hits = _hits(spark, sf)
    f1 = _report(spark, sf).where(F.col("class").isin("macro avg", "weighted avg", "micro avg"))
    return R.evaluation_summary(
        {
            "classification": f1.select(F.col("class").alias("name"), F.col("f1").alias("value")),
            "retrieval": Q.retrieval_report(rows, hits, "vec_id", "labels").withColumnRenamed(
                "metric", "name"
            ),
        }
    )


# --- scoring ----------------------------------------------------------------------

SCORE_DIM = 16


def _encode_small(df):
    """How often the first letters stand in a function, in eighths: exact in any float."""
    code = F.col("function_code")
    letters = [chr(ord("a") + i) for i in range(SCORE_DIM)]
    entries = [((F.octet_length(code) - F.octet_length(F.replace(code, F.lit(x), F.lit("")))) / 8).cast("float") for x in letters]
    return df.withColumn("embedding", F.array(*entries))


def _score_chat(messages):
    return f"turn {len(messages)} after {len(messages[0]['content'])} characters"


def _score_generate(prompt):
    return '{"side_effects": ["%s"]}' % ("memory" if len(prompt) % 2 else "io")


def _scored(spark, sf):
    sources = corpus_sources(spark, sf)
    # Read by the fit and by the scores: extracted once.
    functions = stored(X.extract_functions(sources), "functions")
    scaler = M.fit_scaler(functions, M.feature_columns())
    return S.score_sources(
        sources, scaler, fixed_model(SCORE_DIM + 8), functions=functions, encode=_encode_small,
        chat=_score_chat, generate=_score_generate, dim=SCORE_DIM + 8,
    )


@query
def sco1_score_sources(spark, sf):
    return _scored(spark, sf).select(
        "function_id", "name", "high_level_purpose",
        joined("predicted_side_effects").alias("predicted"),
        joined("rule_side_effects").alias("ruled"),
        joined("control_flow_elements").alias("control_flow"),
        "embedding_dim",
        F.size("embedding_preview").alias("preview_dim"),
    )


def _requests(spark, sf):
    """Documents as requests of C code; those of source ``src0`` send blank code, those of ``src1`` no function."""
    code = spread(table(spark, sf, "documents")).where("doc_id IS NOT NULL").select(
        "doc_id", "source", document_code().alias("code")
    )
    requests = code.select(
        F.col("doc_id").alias("request_id"),
        F.when(F.col("source") == "src0", "  \n").when(F.col("source") == "src1", "int x;\n").otherwise(F.col("code")).alias("code"),
    )
    functions = X.extract_functions(
        code.select(F.col("doc_id").cast("string").alias("file_path"), F.col("code").alias("text"))
    )
    return requests, functions


def _answered(spark, requests, functions, rounds):
    """Outcomes of a stream that is started ``rounds`` times on its checkpoint, each time with all requests in new files."""
    inbox, models, out, progress = (
        scratch(spark, n) for n in ("requests", "models", "scored", "progress")
    )
    io.save_model_tables(
        M.fit_scaler(functions, M.feature_columns()),
        fixed_model(SCORE_DIM + 8).table(spark),
        models,
    )
    for _ in range(rounds):
        requests.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", 2000).json(inbox)
        jobs.score_stream(
            spark, inbox, models, out, progress, encode=_encode_small, dim=SCORE_DIM + 8
        ).awaitTermination()
    scored = spark.read.parquet(f"{out}/scored").select(
        "request_id", "name", "embedding_dim", F.lit("scored").alias("outcome")
    )
    rejected = spark.read.parquet(f"{out}/rejected").select(
        "request_id", F.lit("").alias("name"), F.lit(0).alias("embedding_dim"),
        F.col("reason").alias("outcome"),
    )
    return scored.unionByName(rejected)


@query
def sco2_score_stream(spark, sf):
    return _answered(spark, *_requests(spark, sf), rounds=1)


@query
def sco2_score_stream_once(spark, sf):
    """Every request sent twice in one run and once more after a restart; the answers of each are counted."""
    requests, functions = _requests(spark, sf)
    answers = _answered(spark, requests.unionByName(requests), functions, rounds=2)
    return answers.groupBy("request_id", "outcome").agg(F.count(F.lit(1)).alias("n_answers"))


@query
def sco3_compare_rule_and_model(spark, sf):
    return S.compare_rule_and_model(_scored(spark, sf)).select(
        joined("only_rule").alias("only_rule"), joined("only_model").alias("only_model"),
        "n", "agree",
    )
