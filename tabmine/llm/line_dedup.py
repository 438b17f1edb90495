"""Line dedup: drop lines that repeat across documents.

Lines are normalised and hashed, distinct documents are counted per hash, and
every line whose hash reaches the threshold goes, in every document; the rest
is put together again in its old order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabmine.llm.common import BLANKS, ascii_lower, digest128, small, stage, text_of


def line_key(line: Column) -> Column:
    """Blanks stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def dedup_lines(docs: DataFrame, text_col: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Rows of ``docs`` with ``text_col`` cut to its kept lines, plus n_lines and n_dropped (long).

    A line key of at least ``min_chars`` code points found in at least
    ``min_docs`` documents loses all its lines. A document is a row, so
    repeated rows count each. Null text stays null and counts as one empty
    line; a text whose lines all go becomes empty; an empty table gives an
    empty result; input columns named like a result column are replaced.

    A text's md5 is its key; its lines' keys are worked out once and staged. Counting shuffles keys only, combined before the
    shuffle, so a line found in a third of all documents is one row per task.
    Lines meet the hot keys (broadcast while their counted bytes are few), and
    a text's dropped positions are collected as a set, once whatever its copies.
    Texts are shuffled once, to meet their positions; that side has one row per
    text, so Spark can split the partition of a text with many copies. What lies
    between dropped positions is sliced out: linear in a text's lines.
    """
    docs = docs.drop("n_lines", "n_dropped")
    key = lambda x: F.when(F.char_length(x) >= min_chars, digest128(x))
    keys = F.transform(F.transform(F.split(text_of(text_col), "\n"), line_key), key)  # null where too short
    keyed = stage(docs.select(digest128(text_of(text_col)).alias("__t"), keys.alias("__keys")), "line-keys")
    hot = stage(keyed.select(F.explode(F.array_distinct("__keys")).alias("__k")).filter("__k IS NOT NULL")
                .groupBy("__k").agg(F.count("*").alias("__n")).filter(F.col("__n") >= min_docs).select("__k"), "line-hot")
    at = keyed.select("__t", F.posexplode("__keys").alias("__i", "__k")).filter("__k IS NOT NULL")
    hit = stage(at.join(small(hot, 32), "__k", "left_semi")
                .groupBy("__t").agg(F.sort_array(F.collect_set("__i")).alias("__at")), "line-docs")
    rows = (docs.withColumn("__t", digest128(text_of(text_col)))
            .withColumn("__lines", F.split(text_of(text_col), "\n"))
            .join(hit, "__t", "left"))
    # runs of kept lines: from after one dropped position (or the start) to the next (or the end)
    after = F.concat(F.array(F.lit(-1)), F.col("__at"))
    upto = F.concat(F.col("__at"), F.array(F.size("__lines")))
    kept = F.flatten(F.zip_with(after, upto, lambda a, b: F.slice(F.col("__lines"), a + 2, b - a - 1)))
    rows = rows.withColumn("__kept", F.when(F.col("__at").isNull(), F.col("__lines")).otherwise(kept))
    return (rows
            .withColumn("n_lines", F.size("__lines").cast("long"))
            .withColumn("n_dropped", (F.size("__lines") - F.size("__kept")).cast("long"))
            .withColumn(text_col, F.when(F.col(text_col).isNotNull(), F.concat_ws("\n", "__kept")))
            .drop("__t", "__lines", "__at", "__kept"))
