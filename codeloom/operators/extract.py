"""From source files to one row per function definition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeloom.functions import clex, treeheight
from codeloom.schemas import FEATURE_ORDER


# Text whose tokens a task orders in memory; as rows they take some thirty times as much.
TOKENIZED_BYTES = 8 << 20


def _token_tasks(sources: DataFrame) -> int:
    """Tasks over which the text is dealt, from a sum over it; never fewer than the session's partitions."""
    size = sources.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TOKENIZED_BYTES))


def tokenize_sources(sources: DataFrame) -> DataFrame:
    """Token table ``(file_path, pos, tok, off, line)`` with trivia tokens kept.

    The files move before they are exploded, so the exchange carries text once
    and the window reuses its partitioning. The number of tasks follows from the
    text: a count of its own keeps adaptive execution from merging them by the
    size of the text, whose tokens a merged task would spill. ``off`` counts
    characters from 0, ``line`` from 1.
    """
    exploded = (
        sources.select("file_path", "text")
        .repartition(_token_tasks(sources), "file_path")
        .select("file_path", F.posexplode(clex.tokens(F.col("text"))).alias("pos", "tok"))
    )
    before = (
        Window.partitionBy("file_path")
        .orderBy("pos")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    newlines = F.length("tok") - F.length(F.replace("tok", F.lit("\n"), F.lit("")))
    return exploded.select(
        "file_path",
        "pos",
        "tok",
        F.coalesce(F.sum(F.length("tok")).over(before), F.lit(0)).alias("off"),
        (F.coalesce(F.sum(newlines).over(before), F.lit(0)) + 1).alias("line"),
    )


def _scanned(sources: DataFrame) -> DataFrame:
    return sources.select(
        "file_path", clex.chunks(F.col("text")).alias("_chunks")
    ).withColumn("_scan", clex.scan_chunks(F.col("_chunks")))


def function_slices(sources: DataFrame) -> DataFrame:
    """One row ``(function_id, file_path, fn_no, function_code)`` per definition.

    Only files that are not of plain shape are cut into chunks and folded.
    """
    text, plain, cut = F.col("text"), F.col("_plain"), F.col("_chunks")
    scanned = (
        sources.select("file_path", "text", clex.plain_parts(text).alias("_parts"))
        .select("file_path", "text", clex.plain_definitions(F.col("_parts")).alias("_plain"))
        .select("file_path", "_plain", F.when(plain.isNull(), clex.chunks(text)).alias("_chunks"))
        .select("file_path", "_plain", "_chunks", clex.scan_chunks(cut).alias("_scan"))
    )
    # The generator takes the expression itself: a bare column would make the
    # optimizer infer a filter on it and evaluate the whole scan a second time.
    exploded = scanned.select(
        "file_path",
        F.posexplode(F.coalesce(plain, clex.definition_texts(cut, F.col("_scan")))).alias(
            "_no", "function_code"
        ),
    )
    fn_no = (F.col("_no") + 1).alias("fn_no")
    return exploded.select(
        F.concat_ws("#", "file_path", (F.col("_no") + 1).cast("string")).alias("function_id"),
        "file_path",
        fn_no,
        "function_code",
    )


def function_facts(slices: DataFrame) -> DataFrame:
    """Add name, counts, control flow and call names to rows with ``function_code``.

    Each step is its own projection, so the costly expressions (cleaning, calls,
    keywords) are computed once per function and shared by all that read them.
    """
    keep = slices.columns
    steps = (
        slices.withColumn("_clean", clex.without_trivia(F.col("function_code")))
        .withColumns(
            {
                "_header": clex.header_of(F.col("_clean")),
                "_body": clex.body_of(F.col("_clean")),
                "_words": clex.keywords(F.col("_clean")),
            }
        )
        .withColumns(
            {
                "_signature": clex.signature(F.col("_header")),
                "_counts": clex.keyword_counts(F.col("_words")),
                "call_names": clex.call_names(F.col("_body")),
                "_brackets": clex.brackets(F.col("_clean")),
            }
        )
    )
    counts = F.col("_counts")
    return steps.select(
        *keep,
        clex.function_name(F.col("_signature")).alias("function_name"),
        counts["if"].alias("if_count"),
        (counts["for"] + counts["while"]).alias("loop_count"),
        counts["return"].alias("return_count"),
        F.size("call_names").alias("call_count"),
        clex.bracket_depth(F.col("_brackets")).alias("nesting_depth"),
        clex.line_count(F.col("function_code")).alias("line_count"),
        clex.param_count(F.col("_signature")).alias("param_count"),
        clex.pointer_count(F.col("_header"), F.col("_body")).alias("pointer_count"),
        clex.control_flow_elements(counts).alias("control_flow_elements"),
        "call_names",
    )


def with_tree_height(functions: DataFrame) -> DataFrame:
    """Add ``tree_height``, the height of the syntax tree of ``function_code``; row by row, without a shuffle."""
    return functions.withColumn("tree_height", treeheight.tree_height(F.col("function_code")))


def feature_struct() -> Column:
    """The eight counts as one struct in canonical order."""
    return F.struct(*[F.col(f).cast("int").alias(f) for f in FEATURE_ORDER])


def extract_functions(sources: DataFrame) -> DataFrame:
    """The function table: one row per definition, all features attached."""
    return function_facts(function_slices(sources)).select(
        "function_id",
        "file_path",
        "fn_no",
        "function_name",
        "function_code",
        feature_struct().alias("ast_features"),
        "control_flow_elements",
        "call_names",
    )


def known_types(sources: DataFrame) -> DataFrame:
    """``(name)``: every type name that some file of the corpus defines or uses as a type without doubt, and the standard ones.

    Names are told apart within a file before they are exploded, and summed up before they are shuffled.
    """
    clean = clex.squeezed(clex.without_trivia(F.col("text")))
    standard = sources.sparkSession.createDataFrame([(n,) for n in clex.STANDARD_TYPES], "name string")
    return sources.select(F.explode(clex.type_names(clean)).alias("name")).unionByName(standard).distinct()


def resolve_pointers(functions: DataFrame, types: DataFrame) -> DataFrame:
    """``functions`` with ``pointer_count`` less the stars of statements ``a * b;`` that only multiply.

    Such a statement declares pointers if ``a`` is one of ``types(name)`` and the function declares no variable of this
    name. Only functions that hold such statements take part in the joins; the others are not moved for them where these are few.
    """
    clean = F.col("_clean")
    either = (
        functions.where(F.col("function_code").contains("*"))
        .select("function_id", clex.squeezed(clex.without_trivia(F.col("function_code"))).alias("_clean"))
        .select("function_id", "_clean", F.explode(clex.either_pointers(clex.body_of(clean))).alias("_one"))
        .select(
            "function_id", F.col("_one.name").alias("name"), F.col("_one.stars").alias("_stars"),
            clex.declares_variable(clean, F.col("_one.name")).alias("_variable"),
        )
        .groupBy("function_id", "name").agg(F.sum("_stars").alias("_stars"), F.first("_variable").alias("_variable"))
    )
    known = types.select("name").distinct().withColumn("_known", F.lit(True))
    surplus = (
        either.join(known, "name", "left").where(F.col("_known").isNull() | F.col("_variable"))
        .groupBy("function_id").agg(F.sum("_stars").cast("int").alias("_surplus"))
    )
    less = F.col("ast_features.pointer_count") - F.coalesce("_surplus", F.lit(0))
    return functions.join(surplus, "function_id", "left").withColumn(
        "ast_features", F.col("ast_features").withField("pointer_count", less)
    ).select(*functions.columns)


def rejected_sources(sources: DataFrame) -> DataFrame:
    """Files in which a definition may be missing: braces that do not balance, or top-level
    blocks that are neither function, type, initialiser nor linkage block."""
    return (
        _scanned(sources)
        .where((F.col("_scan.depth") > 0) | (F.col("_scan.odd") > 0))
        .select(
            "file_path",
            F.col("_scan.depth").alias("open_braces"),
            F.col("_scan.odd").alias("unknown_blocks"),
        )
    )


def functions_per_file(sources: DataFrame, functions: DataFrame) -> DataFrame:
    """Functions per file, files without any included.

    The function side is counted before the join, so a file that holds most of
    the functions reaches the join as one row.
    """
    counted = functions.groupBy("file_path").agg(F.count(F.lit(1)).alias("_n"))
    return (
        sources.select("file_path")
        .join(counted, "file_path", "left")
        .select("file_path", F.coalesce("_n", F.lit(0)).cast("long").alias("n_functions"))
    )


def corpus_stats(functions: DataFrame) -> DataFrame:
    """One row: size, mean and greatest length, functions with loops and pointers.

    Reads the flat counts of ``function_facts`` where they are, so that no other
    count is computed, and the stored struct otherwise.
    """
    flat = "line_count" in functions.columns
    f = {
        name: F.col(name) if flat else F.col("ast_features")[name]
        for name in ("line_count", "loop_count", "pointer_count")
    }
    return functions.agg(
        F.count(F.lit(1)).alias("n_functions"),
        F.coalesce(F.avg(f["line_count"]), F.lit(0.0)).alias("avg_lines"),
        F.max(f["line_count"]).alias("max_lines"),
        F.count_if(f["loop_count"] > 0).alias("with_loops"),
        F.count_if(f["pointer_count"] > 0).alias("with_pointers"),
    )
