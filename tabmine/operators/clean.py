"""Deduplication, cleaning and derived columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmine.functions.text import (char_count, collapse_ws, flag, last_match_int, strip_ws,
                                    word_count)
from tabmine.operators.ranks import quantile_values
from tabmine.session import materialize
from tabmine.spec import Preset


def dup_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows repeating an earlier key (D1); null keys compare equal.

    One partial+final aggregate on the keys, then a one-row sum.
    """
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.sum(F.col("_n") - 1).cast("bigint").alias("duplicates"),
                 F.sum("_n").cast("bigint").alias("rows"),
                 F.count(F.lit(1)).cast("bigint").alias("distinct_keys"))


#: Lists up to this many bytes are broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 32 << 20


def _listed(df: DataFrame, row_bytes: int) -> DataFrame:
    """A staged list with a broadcast hint if its rows fit in ``BROADCAST_BYTES``, else as it is."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def key_digest(keys: Sequence[str]):
    """128 bits of the keys' values; null differs from every value, and lengths keep neighbours apart."""
    said = [F.coalesce(F.concat(F.octet_length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string")),
                       F.lit("-")) for k in keys]
    return F.unhex(F.md5(F.concat(*said)))


def later_copies(df: DataFrame, keys: Sequence[str], order_col: str = "row_id") -> DataFrame:
    """(_d, order_col) of the rows of a key that are not its first, ``_d`` being the key's digest; staged.

    Digests alone are counted (a hash aggregate that combines map-side, so a key that a third
    of the rows share is one row a task). Only rows of digests that occur again are looked at
    whole: they are compared by the keys themselves, so that equal digests of different keys do no harm.
    """
    keys = list(keys)
    d = key_digest(keys).alias("_d")
    again = materialize(df.select(d).groupBy("_d").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_d"), "dedup-again")
    some = materialize(df.select(d, order_col, *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
                       .join(_listed(again, 64), "_d", "left_semi"), "dedup-rows")
    same = [f"_k{i}" for i in range(len(keys))]
    # written, so that Spark splits a key that many rows share on the other side of the join
    first = materialize(some.groupBy("_d", *same).agg(F.min(order_col).alias("_first")), "dedup-first")
    # keys are told apart by digest and first row: texts meet in the comparison only
    on = (some["_d"] == first["_d"]) & (some[order_col] > F.col("_first"))
    for k in same:
        on = on & some[k].eqNullSafe(first[k])
    return materialize(some.join(first, on, "left_semi").select("_d", order_col), "dedup-later")


def dedup_first(df: DataFrame, keys: Sequence[str], order_col: str = "row_id") -> DataFrame:
    """Keep the first row (smallest ``order_col``) of every key.

    ``order_col`` has no nulls and differs among the rows of a key. The later rows are named by
    (digest, order) and taken out by an anti join, so whole rows are not shuffled where the
    list of later copies is of at most ``BROADCAST_BYTES``; ``dropDuplicates`` would keep an arbitrary row.
    """
    later = later_copies(df, keys, order_col)
    return df.withColumn("_d", key_digest(list(keys))).join(_listed(later, 96), ["_d", order_col], "left_anti").select(*df.columns)


def strip_columns(df: DataFrame, cols: Sequence[str], unicode: bool = True) -> DataFrame:
    """C1 over the listed (present) columns."""
    present = set(df.columns)
    return df.withColumns({c: strip_ws(c, unicode) for c in cols if c in present})


def fill_constant(df: DataFrame, cols: Sequence[str], value: str) -> DataFrame:
    """Categorical nulls -> constant."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in cols})


def missing_flags(df: DataFrame, cols: Sequence[str], present: bool = False, suffix: str | None = None) -> DataFrame:
    """C4: 0/1 indicators of missing (or present) values."""
    sfx = suffix or ("_present" if present else "_missing")
    return df.withColumns({f"{c}{sfx}": flag(F.col(c).isNotNull() if present else F.col(c).isNull())
                           for c in cols})


def winsorize_upper(col: str, cap: float):
    """Values above ``cap`` become ``cap``; nulls stay null (not ``least``)."""
    return F.when(F.col(col) > F.lit(cap), F.lit(cap)).otherwise(F.col(col))


def vintage_year(col: str, preset: Preset):
    """C7+C8: last 1950-2019 token, nulled above the reference year."""
    y = last_match_int(F.col(col), preset.year_regex)
    return F.when(y <= F.lit(preset.ref_year), y)


def label_leak_scan(df: DataFrame, text: str, score: str, pattern: str = r"\b(8\d|9\d|100)\b") -> DataFrame:
    """C14: share of texts naming a standalone 80-100 number, and share of
    those whose numbers include the row's own score."""
    nums = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))
    t = df.select(F.size(nums).alias("_k"),
                  F.array_contains(F.transform(nums, lambda s: s.cast("int")), F.col(score)).alias("_hit"))
    has = F.col("_k") > 0
    return t.agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                 F.sum(has.cast("int")).cast("bigint").alias("with_number"),
                 F.round(F.avg(has.cast("double")), 6).alias("share_with_number"),
                 F.round(F.try_divide(F.sum((has & F.col("_hit")).cast("double")),
                                      F.sum(has.cast("double"))), 6).alias("share_equal_score"))


@dataclass
class Cleaned:
    table: DataFrame
    cap: float
    raw: DataFrame
    preset: Preset

    @property
    def rows_raw(self) -> int:
        return self.raw.count()

    def audit(self) -> DataFrame:
        """D3: one row describing the cleaning steps."""
        t = self.table
        rows_raw = self.rows_raw
        return t.agg(
            F.lit(rows_raw).cast("bigint").alias("rows_raw"),
            F.count(F.lit(1)).cast("bigint").alias("rows_after_dedup"),
            (F.lit(rows_raw) - F.count(F.lit(1))).cast("bigint").alias("duplicates_removed"),
            F.round(F.lit(self.cap), 6).alias("price_cap"),
            F.count_if(F.col("price") > F.lit(self.cap)).cast("bigint").alias("price_capped_rows"),
            F.count(F.lit(1)).cast("bigint").alias("rows_final"),
            F.round(F.avg(F.col(self.preset.spec.target).cast("double")), 6).alias("share_high_quality"),
            F.round(F.avg(F.col("log_price").isNull().cast("double")), 6).alias("missing_log_price"),
            F.round(F.avg(F.col("age").isNull().cast("double")), 6).alias("missing_age"),
            F.min("age").alias("age_min"), F.max("age").alias("age_max"),
            F.round(F.avg(F.col("desc_words").cast("double")), 6).alias("desc_words_mean"),
            F.round(100 * (1 - F.avg(F.col("age_missing").cast("double"))), 6).alias("year_extracted_pct"))


KEEP = ("row_id", "title", "description", "points", "high_quality", "price", "log_price", "age",
        "desc_len_chars", "desc_words", "price_missing", "age_missing", "has_designation", "has_region",
        "country", "province", "variety", "taster_name")


def clean_reviews(raw: DataFrame, preset: Preset) -> Cleaned:
    """The whole cleaning step (D2, P1, C1-C11, P6, P2) in one lazy plan.

    Order matters: dedup on the raw text, then normalise; the cap is the exact
    interpolated 0.999 quantile of the deduplicated prices (one small job, the
    only driver round-trip; the audit adds the raw row count).
    """
    uw = preset.unicode_ws
    d = dedup_first(raw, preset.dedup_keys)
    d = d.drop(*[c for c in preset.drop_cols if c in d.columns])
    d = strip_columns(d, preset.strip_cols, uw)
    d = d.withColumn("description", collapse_ws("description", uw))
    d = fill_constant(d, preset.fill_cols, preset.fill_value)
    # written once: the cap's jobs and every consumer read it instead of
    # repeating the dedup shuffle
    d = materialize(d, "dedup")
    cap = quantile_values(d.select("price"), "price", [preset.cap_q])[0]
    year = vintage_year("title", preset)
    d = d.withColumns({
        "price_missing": flag(F.col("price").isNull()),
        "log_price": F.log1p(winsorize_upper("price", cap)),
        "year": year,
    })
    d = d.withColumns({
        "age_missing": flag(F.col("year").isNull()),
        "age": (F.lit(preset.ref_year) - F.col("year")).cast("double"),
        "desc_len_chars": char_count("description"),
        "desc_words": word_count("description", uw),
        "has_designation": flag(F.col("designation").isNotNull()),
        "has_region": flag(F.col("region_1").isNotNull()),
        preset.spec.target: flag(F.col("points") >= F.lit(preset.threshold)),
    })
    return Cleaned(d.select(*KEEP), cap, raw, preset)
