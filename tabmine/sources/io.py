"""Readers and writers.

Reads never infer a schema. Results go to Parquet/CSV/JSON on the shared
folder the caller names; models use Spark ML's own writer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabmine.functions.text import nan_to_null, null_tokens
from tabmine.sources.csv_records import read_csv

# Raw review table: the CSV's unnamed first column is the row index.
REVIEW_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType(), False),
    T.StructField("country", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("designation", T.StringType()),
    T.StructField("points", T.IntegerType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("province", T.StringType()),
    T.StructField("region_1", T.StringType()),
    T.StructField("region_2", T.StringType()),
    T.StructField("taster_name", T.StringType()),
    T.StructField("taster_twitter_handle", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("variety", T.StringType()),
    T.StructField("winery", T.StringType()),
])


def normalize_missing(df: DataFrame) -> DataFrame:
    """CSV null tokens -> null for strings, NaN -> null for doubles."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            out.append(null_tokens(F.col(f.name)).alias(f.name))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(nan_to_null(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def read_reviews_csv(spark: SparkSession, path: str, schema: T.StructType = REVIEW_SCHEMA) -> DataFrame:
    """Header CSV with quoted multi-line text, typed by column NAME.

    Files are cut into records by many tasks each (``csv_records``), and every
    file's header is checked. Types are looked up by name in ``schema`` (the
    unnamed index column becomes ``row_id``; unknown columns are strings).
    Then pandas-style null tokens become null and NaN becomes null.
    """
    raw = read_csv(spark, path)
    names = [n.strip() or "row_id" for n in raw.columns]
    by_name = {f.name: f for f in schema.fields}
    # every column comes as text: null tokens apply to numbers too ("nan", "NA")
    raw = raw.toDF(*names)
    keep = [f.name for f in schema.fields if f.name in names] + [n for n in names if n not in by_name]
    typed = raw.select(*[null_tokens(F.col(n)).cast(by_name[n].dataType if n in by_name else T.StringType()).alias(n)
                         for n in keep])
    return normalize_missing(typed)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Re-read a written table."""
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: tuple[str, ...] = ()) -> str:
    """Write a table (Parquet by default; CSV keeps a header)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        # quotes are doubled and blanks kept, as other CSV readers expect
        (w.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(path))
    else:
        w.format(fmt).save(path)
    return path


DOC_SCHEMA = T.StructType([
    T.StructField("section", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("text", T.StringType()),
])


def to_doc(df: DataFrame, section: str, key_col: str | None, value_cols: list[str]) -> DataFrame:
    """Long (section, key, value, text) rows from a small result table."""
    parts = []
    for v in value_cols:
        key = F.lit(v) if key_col is None else F.concat_ws(".", F.col(key_col).cast("string"), F.lit(v))
        parts.append(df.select(F.lit(section).alias("section"), key.alias("key"),
                               F.col(v).cast("double").alias("value"),
                               F.lit(None).cast("string").alias("text")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_doc(doc: DataFrame, path: str) -> str:
    """Metric document as JSON lines."""
    doc.select([f.name for f in DOC_SCHEMA.fields]).write.mode("overwrite").json(path)
    return path


def read_doc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DOC_SCHEMA).json(path)


def save_model(model, path: str) -> str:
    """Persist a fitted Spark ML model (PipelineModel or estimator model)."""
    model.write().overwrite().save(path)
    return path


def load_pipeline_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
