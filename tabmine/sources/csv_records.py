"""Splittable reading of quoted CSV.

A line break ends a record unless it stands inside quotes, that is, unless the
quotes before it are odd in number; a doubled quote adds two. Files are read by
lines, in byte blocks, by as many tasks as they have blocks: a first pass counts
each block's quotes, the sums of the blocks before tell a block whether it begins
inside quotes, and a second pass cuts every block into records on its own. Only the
pieces of records that cross a block's edge, two a block, meet by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabmine.session import materialize

WHOLE, REST, BEGUN = 0, 1, 2
#: Block tables up to this many bytes are broadcast.
BROADCAST_BYTES = 32 << 20


def _blocks(lines: DataFrame) -> DataFrame:
    """(b, file, block, inside): does a block begin inside quotes? A file whose quotes are odd is an error."""
    n = F.octet_length("value") - F.octet_length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    q = lines.groupBy("file", "block").agg(F.sum(n).alias("q"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    q = q.select("file", "block", F.xxhash64("file", "block").alias("b"), "q",
                 (F.coalesce(F.sum("q").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    q = materialize(q, "csv-blocks")
    odd = q.groupBy("file").agg(F.sum("q").alias("q")).filter("q % 2 = 1").select("file").head(1)
    if odd:
        raise ValueError(f"{odd[0][0]} ends inside quotes")
    return q.drop("q")


class _Cutter:
    """Cuts the lines of one block after the other into (b, kind, top, record)."""

    def __init__(self):
        self.b, self.out = None, ([], [], [], [])

    def put(self, kind: int, record: str) -> None:
        top = self.top and kind != REST
        self.top &= not top
        for c, x in zip(self.out, (self.b, kind, top, record)):
            c.append(x)

    def end(self) -> None:
        """A record still open at the block's end: a begun one, or a further piece of an earlier one."""
        if self.b is not None and self.inside:
            self.put(BEGUN if self.own else REST, "\n".join(self.open))

    def lines(self, b: int, inside: bool, block: int, values: pa.Array) -> pa.Array:
        """Takes lines of block ``b``; returns those that are whole records."""
        if b != self.b:
            self.end()
            self.b, self.inside, self.own, self.open, self.top = b, inside, False, [], block == 0
        odd = pc.bit_wise_and(pc.count_substring(values, '"'), 1).to_numpy(zero_copy_only=False)
        after = (np.cumsum(odd) + self.inside) % 2 == 1
        before = np.concatenate([[self.inside], after[:-1]])
        whole = ~before & ~after
        if self.top and len(whole) and whole[0]:
            self.put(WHOLE, values[0].as_py())
            whole[0] = False
        done = np.flatnonzero(before | after)
        for i, v in zip(done.tolist(), values.take(pa.array(done)).to_pylist()):
            if not before[i]:
                self.own, self.open = True, [v]
            else:
                self.open.append(v)
                if not after[i]:
                    self.put(WHOLE if self.own else REST, "\n".join(self.open))
                    self.open = []
        self.inside = bool(after[-1]) if len(after) else self.inside
        return values.filter(pa.array(whole))

    def taken(self) -> pa.RecordBatch:
        out, self.out = self.out, ([], [], [], [])
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
                                           pa.array(out[2], pa.bool_()), pa.array(out[3], pa.string())],
                                          names=["b", "kind", "top", "record"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cutter = _Cutter()
    for batch in batches:
        b = batch.column("b").to_numpy()
        edges = [0, *(np.flatnonzero(b[1:] != b[:-1]) + 1).tolist(), len(b)]
        for at, to in zip(edges, edges[1:]):
            if at < to:
                whole = cutter.lines(int(b[at]), batch.column("inside")[at].as_py(), batch.column("block")[at].as_py(),
                                     batch.column("value").slice(at, to - at))
                n = len(whole)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, b[at])), pa.array(np.full(n, WHOLE, np.int32)),
                                                  pa.array(np.zeros(n, bool)), whole], names=["b", "kind", "top", "record"])
        yield cutter.taken()
    cutter.end()
    yield cutter.taken()


def csv_records(spark: SparkSession, path: str | list[str], broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(file, top, record): the records of quoted CSV files, quoted line breaks inside; ``top`` marks each file's first.

    Lines end in \\n or \\r\\n; the latter's \\r is not part of a record, line breaks inside
    quotes stay as they are. Quotes stand around whole values and double inside them, as
    CSV writers make them. Empty lines are no records; empty files have none. Files
    are read by blocks of spark.sql.files.maxPartitionBytes.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    blocks = _blocks(lines)
    keyed = lines.select("value", F.xxhash64("file", "block").alias("b"), F.monotonically_increasing_id().alias("nth"))
    small = blocks.count() * 32 <= broadcast_bytes
    known = blocks.select("b", "inside", "block")
    # a broadcast join leaves the lines in their order; a shuffle needs them sorted again
    keyed = keyed.join(F.broadcast(known) if small else known, "b")
    if not small:
        keyed = keyed.repartition("b").sortWithinPartitions("b", "nth")
    cut = keyed.select("b", "inside", "block", "value").mapInArrow(_cut, "b long, kind int, top boolean, record string")
    cut = materialize(cut, "csv-records")
    names = blocks.select("b", "file", "block")
    whole = cut.filter(F.col("kind") == WHOLE).join(F.broadcast(names) if small else names, "b").select("file", "top", "record")
    # within a block the rest of an earlier record comes before the record that the block begins
    pieces = cut.filter(F.col("kind") != WHOLE).join(names, "b")
    nth = F.count_if(F.col("kind") == BEGUN).over(Window.partitionBy("file").orderBy("block", "kind"))
    crossing = pieces.withColumn("n", nth).groupBy("file", "n").agg(
        F.max("top").alias("top"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "kind", "record"))),
                                                            lambda p: p["record"]), "\n").alias("record"))
    out = whole.union(crossing.select("file", "top", "record"))
    r = F.col("record")
    return out.withColumn("record", F.when(F.endswith(r, F.lit("\r")), F.substring(r, F.lit(1), F.char_length(r) - 1)).otherwise(r)).filter("record != ''")


def read_csv(spark: SparkSession, path: str | list[str], broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The columns of CSV files with a header, all strings; empty values are null, quoted or not.

    Every file's header is read: the same names in another order are matched by name,
    other names are an error that says which file has them. A header's unnamed columns are
    called "", "_1" and so on. Records with too few or too many values fail the read.
    """
    import csv

    records = csv_records(spark, path, broadcast_bytes)
    heads = records.filter("top").groupBy("record").agg(F.min("file").alias("file")).orderBy("file").limit(100).collect()
    if not heads:
        raise ValueError(f"no header in {path}")
    names = {}
    for h in heads:
        found = [n.strip("﻿") for n in next(csv.reader([h["record"]], strict=True))]
        names[h["record"]] = [n if n or i == 0 else f"_{i}" for i, n in enumerate(found)]
    first = names[heads[0]["record"]]
    for h in heads:
        if sorted(names[h["record"]]) != sorted(first) or len(set(first)) < len(first) or len(heads) == 100:
            raise ValueError(f"the header of {h['file']} does not name the columns {first}")
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST", "maxCharsPerColumn": "-1"}
    rows = records.filter("NOT top")
    orders = {}  # header orders; most often one
    for record, found in names.items():
        orders.setdefault(tuple(found), []).append(record)
    out = None
    for order, heads_of in orders.items():
        part = rows
        if len(orders) > 1:
            files = records.filter("top").filter(F.col("record").isin(heads_of)).select("file")
            part = rows.join(files, "file", "left_semi")
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(order))])
        parsed = part.select(F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), options).alias("r"))
        part = parsed.select(*[F.col(f"r.c{order.index(n)}").alias(n) for n in first])
        out = part if out is None else out.union(part)
    return out
