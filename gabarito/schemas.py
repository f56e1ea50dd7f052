"""Fixed schemas of the pipeline tables; nothing is ever inferred from data."""

from pyspark.sql import types as T

TURNS = T.StructType(
    [
        T.StructField("system", T.StringType()),
        T.StructField("user", T.StringType()),
        T.StructField("with_answer", T.StringType()),
        T.StructField("without_answer", T.StringType()),
    ]
)

ALTERNATIVES = T.StructType(
    [
        T.StructField("text", T.ArrayType(T.StringType())),
        T.StructField("label", T.ArrayType(T.StringType())),
    ]
)

PROMPT_MAP = T.MapType(
    T.StringType(),
    T.StructType(
        [
            T.StructField("prompt", T.StringType()),
            T.StructField("models", T.ArrayType(T.StringType())),
        ]
    ),
)

PROMPTS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("id_bench", T.StringType()),
        T.StructField("benchmark", T.StringType()),
        T.StructField("prompt", T.StringType()),
        T.StructField("shot_indices", T.ArrayType(T.StringType())),
        T.StructField("label", T.StringType()),
    ]
)

# In CSV form every answers column but the id is text, so that "1" never turns into 1.0.
ANSWERS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("id_bench", T.StringType()),
        T.StructField("benchmark", T.StringType()),
        T.StructField("prompt", T.StringType()),
        T.StructField("shot_indices", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("model_answer", T.StringType()),
        T.StructField("explanation", T.StringType()),
        T.StructField("parsed_model_answer", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

EVAL = T.StructType(
    [
        T.StructField("model_name", T.StringType()),
        T.StructField("benchmark", T.StringType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("precision", T.DoubleType()),
        T.StructField("recall", T.DoubleType()),
        T.StructField("f1_score", T.DoubleType()),
        T.StructField("pearson_correlation", T.DoubleType()),
        T.StructField("non_parsed_rate", T.DoubleType()),
        T.StructField("non_parsed_total_rate", T.DoubleType()),
    ]
)

METRICS = ["accuracy", "precision", "recall", "f1_score", "pearson_correlation"]
