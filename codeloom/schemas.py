"""Fixed schemas of the tables that pass between the stages."""

from pyspark.sql import types as T

# Canonical order of the structural features.
FEATURE_ORDER = [
    "if_count", "loop_count", "return_count", "call_count",
    "nesting_depth", "line_count", "param_count", "pointer_count",
]

SOURCES = T.StructType(
    [T.StructField("file_path", T.StringType()), T.StructField("text", T.StringType())]
)

FEATURES = T.StructType([T.StructField(f, T.IntegerType()) for f in FEATURE_ORDER])

LABELS = T.StructType(
    [
        T.StructField("high_level_purpose", T.StringType()),
        T.StructField("control_flow_elements", T.ArrayType(T.StringType())),
        T.StructField("side_effects", T.ArrayType(T.StringType())),
    ]
)

FUNCTIONS = T.StructType(
    [
        T.StructField("function_id", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("fn_no", T.IntegerType()),
        T.StructField("function_name", T.StringType()),
        T.StructField("function_code", T.StringType()),
        T.StructField("ast_features", FEATURES),
        T.StructField("control_flow_elements", T.ArrayType(T.StringType())),
        T.StructField("call_names", T.ArrayType(T.StringType())),
    ]
)

# Every later stage adds nullable columns; a null means "not there yet".
ALL_STAGES = T.StructType(
    FUNCTIONS.fields
    + [
        T.StructField("side_effects_source", T.StringType()),
        T.StructField("labels", LABELS),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("truncated", T.BooleanType()),
        T.StructField("fused_embedding", T.ArrayType(T.DoubleType())),
    ]
)

SIGNALS = T.StructType(
    [
        T.StructField("label", T.StringType(), False),
        T.StructField("kind", T.StringType(), False),
        T.StructField("pattern", T.StringType(), False),
    ]
)

REQUESTS = T.StructType(
    [T.StructField("request_id", T.LongType()), T.StructField("code", T.StringType())]
)
