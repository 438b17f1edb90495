"""Mixing sources to target weights by Pfair scheduling.

A source's rows are dealt into blocks. With p as its share of all weights,
block k of a source is released at slot floor(k / p) and due before slot
ceil((k + 1) / p); in each slot the released block with the earliest deadline
goes first. That keeps every source less than one block away from its share at
every slot. Shares are exact fractions and hold over the whole run, for any
number of sources: the driver works the order of the blocks out from the
sources' sizes and weights alone (a heap step a block, written out in pieces of
fixed size), and Spark places the rows by it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabmine.llm.common import stage

#: Blocks of the schedule the driver holds at a time.
PIECE = 1 << 20


def whole_weights(weights: list[float]) -> list[int]:
    """Whole numbers in exactly the proportions of ``weights`` (floats are fractions by powers of two)."""
    exact = [Fraction(w) for w in weights]
    d = max((w.denominator for w in exact), default=1)
    return [int(w * d) for w in exact]


def schedule(rows: list[int], weights: list[int], block_rows: int) -> Iterator[tuple[int, int, int, int]]:
    """(source, block, slot, rows before it) of every block, slot by slot: the earliest deadline among released blocks.

    Sources are places in ``rows`` and ``weights``. A source that has run out
    leaves its turns to the next block of the others.
    """
    total = sum(weights)
    blocks = [-(-n // block_rows) for n in rows]
    waiting = [(0, j) for j, b in enumerate(blocks) if b]  # by release
    heapq.heapify(waiting)
    had, ready, now, pos = [0] * len(rows), [], 0, 0
    for slot in range(sum(blocks)):
        if not ready and waiting[0][0] > now:
            now = waiting[0][0]
        while waiting and waiting[0][0] <= now:
            j = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (-(-(had[j] + 1) * total // weights[j]), j))
        j = heapq.heappop(ready)[1]
        k = had[j]
        yield j, k, slot, pos
        had[j] = k + 1
        now += 1
        pos += min(block_rows, rows[j] - k * block_rows)
        if k + 1 < blocks[j]:
            heapq.heappush(waiting, ((k + 1) * total // weights[j], j))


def schedule_table(sources: DataFrame, block_rows: int) -> DataFrame:
    """(__s, block, slot, pos): ``schedule`` of the sources (s, rows, weight), staged."""
    spark = sources.sparkSession
    at = sources.orderBy("s").collect()  # a row per source
    run = schedule([r.rows for r in at], whole_weights([r.weight for r in at]), block_rows)
    out, first = None, True
    while first or piece:
        piece, first = list(islice(run, PIECE)), False
        if piece or out is None:
            cols = [pa.array(c, pa.int64()) for c in zip(*piece)] or [pa.array([], pa.int64())] * 4
            part = stage(spark.createDataFrame(pa.table(cols, ["j", "block", "slot", "pos"])), "mix-schedule")
            out = part if out is None else out.unionByName(part)
    names = spark.createDataFrame([(j, r.s) for j, r in enumerate(at)], "j long, __s string")
    return out.join(F.broadcast(names), "j").drop("j")


def quotas(sources: DataFrame, slots: int) -> DataFrame:
    """(s, rows, w): whole slots per period in proportion to ``weight``, at least 1, ``slots`` in all. Not read by ``mix``.

    Largest remainder after one slot for each source. ``sources`` has one row
    per source (s, rows, weight), at most ``slots`` of them.
    """
    n, total = sources.agg(F.count("*"), F.sum("weight")).first()
    if n > slots:
        raise ValueError(f"{n} sources need at least as many slots a period, not {slots}")
    if not n:
        return sources.select("s", "rows", F.lit(0).alias("w"))
    share = F.col("weight") / F.lit(float(total)) * F.lit(float(slots - n))
    q = sources.withColumn("base", F.floor(share).cast("int")).withColumn("left", share - F.floor(share))
    spare = slots - n - q.agg(F.sum("base")).first()[0]
    rank = F.row_number().over(Window.orderBy(F.desc("left"), "s"))  # at most `slots` rows
    return q.select("s", "rows", (F.col("base") + 1 + F.when(rank <= spare, 1).otherwise(0)).alias("w"))


def period(quota: DataFrame, slots: int) -> DataFrame:
    """(s, i, slot, before): slot of the i-th block of each source in a period, and the blocks each
    source (in the order of s) has had before that slot. At most ``slots`` rows. Not read by ``mix``."""
    all_ = F.array_sort(F.collect_list(F.struct("s", "w")))
    one = quota.agg(all_.alias("q")).withColumn("w", F.col("q")["w"]).withColumn("s", F.col("q")["s"])
    due = lambda k, w: F.ceil((k + 1) * F.lit(slots) / w).cast("long")
    free = lambda k, w: F.floor(k * F.lit(slots) / w).cast("long")

    def step(acc, slot):
        ready = F.filter(F.zip_with(
            F.sequence(F.lit(0), F.size("w") - 1),
            F.zip_with(acc["had"], F.col("w"), lambda k, w: F.struct(due(k, w).alias("due"), free(k, w).alias("free"))),
            lambda j, x: F.struct(x["due"].alias("due"), j.alias("j"), x["free"].alias("free"))),
            lambda x: x["free"] <= slot)
        j = F.array_min(ready)["j"]
        return F.struct(
            F.transform(acc["had"], lambda k, i: k + F.when(i == j, 1).otherwise(0)).alias("had"),
            F.concat(acc["out"], F.array(F.struct(j.alias("j"), F.get(acc["had"], j).alias("i"), slot.alias("slot"),
                                                  acc["had"].alias("before")))).alias("out"))

    zero = F.struct(F.transform("w", lambda x: F.lit(0)).alias("had"),
                    F.array().cast("array<struct<j:int,i:int,slot:int,before:array<int>>>").alias("out"))
    runs = one.filter(F.size("w") > 0).select(
        "s", F.aggregate(F.sequence(F.lit(0), F.lit(slots - 1)), zero, step)["out"].alias("out"))
    return (runs.select("s", F.explode("out").alias("x"))
            .select(F.get(F.col("s"), F.col("x.j")).alias("s"), "x.i", "x.slot", "x.before"))


def mix(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", weights: DataFrame | None = None,
        temperature: float = 0.5, block_rows: int = 16, slots: int = 1000, bucket_rows: int = 5000) -> DataFrame:
    """Rows of ``docs`` plus slot, block and mix_pos (long): every row once, in the mixed order of mix_pos.

    ``weights`` (source_col, weight) gives target weights; without it a source's
    weight is its row count to the power ``temperature``. Weights are kept
    exactly, and ``slots`` no longer bounds them (it is not read). Until the
    first source runs out, each source is less than one block of ``block_rows``
    rows from its share after every slot; then the others go on in their order
    and nothing is dropped or repeated. slot and mix_pos count from 0 without
    gaps. Within a source rows are ordered by a hash of the identifier, then by
    it and by the whole row.

    A null source is a source of its own; sources without a weight, or with
    none above 0, get a billionth of the least weight. Repeated rows count each;
    an empty table gives an empty result; input columns named like a result
    column are replaced.

    Places within a source come from counts per (source, hash bucket), so a
    source with a third of all rows spreads over many tasks.
    """
    docs = docs.drop("slot", "block", "mix_pos")
    keyed = docs.withColumn("__s", F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")))
    keyed = keyed.withColumn("__h", F.xxhash64(F.col(id_col).cast("string")))
    total = docs.count()
    buckets = max(1, -(-total // bucket_rows))
    keyed = keyed.withColumn("__b", F.pmod("__h", F.lit(buckets)))
    counts = stage(keyed.groupBy("__s", "__b").agg(F.count("*").alias("__c")), "mix-counts")
    sources = counts.groupBy(F.col("__s").alias("s")).agg(F.sum("__c").alias("rows"))
    if weights is None:
        sources = sources.withColumn("weight", F.pow("rows", F.lit(temperature)))
    else:
        w = weights.select(F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("s"),
                           F.col("weight").cast("double").alias("weight")).filter(
            "weight > 0 AND weight < double('Infinity')").groupBy("s").agg(F.max("weight").alias("weight"))
        sources = stage(sources.join(w, "s", "left"), "mix-sources")
        least = sources.agg(F.coalesce(F.min("weight"), F.lit(1.0))).first()[0] * 1e-9
        sources = sources.withColumn("weight", F.coalesce("weight", F.lit(least)))
    plan = stage(schedule_table(sources, block_rows), "mix-plan")  # a row per block
    before = Window.partitionBy("__s").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__s", "__b", "__c", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__o"))
    spans = offsets.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("__o") / block_rows), F.floor((F.col("__o") + F.col("__c") - 1) / block_rows))))
    # the blocks of each bucket, in their order: rows meet them where they are ranked, without another shuffle
    spans = spans.join(plan, ["__s", "block"]).groupBy("__s", "__b", "__o").agg(
        F.array_sort(F.collect_list(F.struct("block", "slot", "pos"))).alias("__plan"))
    place = Window.partitionBy("__s", "__b").orderBy("__h", F.col(id_col).cast("string"), F.xxhash64(*docs.columns))
    rows = keyed.withColumn("__r", F.row_number().over(place)).join(spans, ["__s", "__b"])
    rows = rows.withColumn("__k", F.col("__o") + F.col("__r") - 1)
    rows = rows.withColumn("__x", F.get("__plan", (F.floor(F.col("__k") / block_rows) - F.col("__plan")[0]["block"]).cast("int")))
    return rows.select(*docs.columns, F.col("__x.slot").alias("slot"), F.col("__x.block").alias("block"),
                       (F.col("__x.pos") + F.col("__k") % block_rows).alias("mix_pos"))
