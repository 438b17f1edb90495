"""Exact dedup as a stateful stream.

Two streams run to the end of what the table holds. The first reads documents
and writes, for each, the digest of its normalised text, its identifier and
its locator (file, row in file). The second keeps one state row per digest,
without expiry, on disk (RocksDB): the smallest identifier, that row's locator
and the count. Texts whose digest was seen before are then compared with the
kept row's text in full.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabmine.llm.common import BROADCAST_BYTES, small, stage, text_of
from tabmine.session import ensure_checkpoint_dir

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: State on disk; without allocating file space ahead, which costs megabytes for every state partition.
STATE_CONF = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
              "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}
#: Rows of one group that are compared with one copy of the kept text.
GROUP_ROWS = 1000


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _run(frame: DataFrame, mode: str, checkpoint: str, sink: str, path: str | None = None) -> None:
    w = (frame.writeStream.format(sink).outputMode(mode).trigger(availableNow=True)
         .option("checkpointLocation", checkpoint))
    q = w.start(path) if path else w.start()
    q.awaitTermination()


def dedup_state(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text", digest=sha256,
                files_per_trigger: int = 1000) -> tuple[DataFrame, DataFrame]:
    """(rows, state): rows (id, file, row, digest) of the Parquet table at ``path`` and the final keyed state.

    state has digest, keep_id, keep_file, keep_row and n. Null identifiers sort last.
    """
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tabmine-stage/llm-stream-{uuid.uuid4().hex}"
    path = path.rstrip("/")
    raw = (spark.readStream.schema(spark.read.parquet(path).schema)
           .option("maxFilesPerTrigger", files_per_trigger)
           .parquet(f"{path[:-1]}[{path[-1]}]"))  # as a pattern: a plain path must be a folder, not one file
    meta = raw.metadataColumn("_metadata")
    seen = raw.select(F.col(id_col).alias("id"), meta["file_path"].alias("file"), meta["row_index"].alias("row"),
                      digest(normalised(text_of(text_col))).alias("digest"))
    _run(seen, "append", f"{base}/ingest", "parquet", f"{base}/rows")
    rows = spark.read.schema(seen.schema).parquet(f"{base}/rows")

    keyed = (spark.readStream.schema(seen.schema).option("maxFilesPerTrigger", files_per_trigger)
             .parquet(f"{base}/rows").groupBy("digest")
             .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "file", "row")).alias("keep"),
                  F.count("*").alias("n")))
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    try:
        for k, v in STATE_CONF.items():
            spark.conf.set(k, v)
        _run(keyed, "update", f"{base}/state", "noop")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    if rows.isEmpty():  # no batch ran, so there is no state to read
        state = rows.groupBy("digest").agg(F.first(F.struct(F.lit(True), "id", "file", "row")), F.count("*"))
        state = state.select("digest", F.struct(*state.columns[1:]).alias("value"))
    else:
        state = spark.read.format("statestore").option("path", f"{base}/state").load()
        state = state.select(F.col("key")["digest"].alias("digest"), "value")
    keep, n = (F.col("value")[f] for f in state.schema["value"].dataType.fieldNames())
    state = state.select("digest", keep["id"].alias("keep_id"), keep["file"].alias("keep_file"),
                         keep["row"].alias("keep_row"), n.alias("n"))
    return rows, stage(state, "stream-state")


def dedup_exact(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text", digest=sha256,
                files_per_trigger: int = 1000, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per row of the table at ``path``: id_col, keep_id, group_size, kept, file, row, digest.

    Texts are equal when identical after each run of blanks became one space;
    null counts as empty. Of equal texts the smallest identifier stays (ties:
    the first file and row; null identifiers last). Texts that share a digest
    but differ are told apart by their bytes. An empty table gives no rows;
    further columns, whatever their names, are not read.

    A hot group never meets in one task: the state combines before the shuffle,
    and the byte check deals each group into shares of ``GROUP_ROWS`` rows, each
    with its own copy of the kept text.
    """
    rows, state = dedup_state(spark, path, id_col, text_col, digest, files_per_trigger)
    joined = stage(rows.join(state, "digest"), "stream-rows")
    hits = stage(joined.filter("n > 1").select(
        "digest", "id", "file", "row", "n", ((F.col("file") == F.col("keep_file"))
                                             & (F.col("row") == F.col("keep_row"))).alias("is_keep")), "stream-hits")
    docs = spark.read.parquet(path)
    meta = docs.metadataColumn("_metadata")
    texts = stage(docs.select(meta["file_path"].alias("file"), meta["row_index"].alias("row"),
                              text_of(text_col).alias("text"))
                  .join(small(hits, 256, broadcast_bytes), ["file", "row"])
                  .withColumn("text", normalised(F.col("text")))
                  .withColumn("shares", F.ceil(F.col("n") / GROUP_ROWS).cast("int")), "stream-texts")
    members = texts.withColumn("share", F.pmod(F.xxhash64("file", "row"), F.col("shares")).cast("int"))
    keepers = (texts.filter("is_keep")
               .select("digest", F.col("text").alias("keep_text"),
                       F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share")))
    odd = stage(members.join(keepers, ["digest", "share"]).filter("text != keep_text")
                .select("digest", "id", "file", "row", "text"), "stream-odd")
    out = joined.select("id", "file", "row", "digest", "keep_id", "keep_file", "keep_row", "n")
    if not odd.isEmpty():  # digests shared by different texts: group those by their bytes
        own = (odd.groupBy("digest", "text").agg(
            F.min(F.struct(F.col("id").isNull().alias("none"), "id", "file", "row")).alias("k"), F.count("*").alias("m")))
        own = odd.join(own, ["digest", "text"]).select(
            "file", "row", F.col("k")["id"].alias("k_id"), F.col("k")["file"].alias("k_file"),
            F.col("k")["row"].alias("k_row"), "m")
        less = odd.groupBy("digest").agg(F.count("*").alias("less"))
        out = out.join(less, "digest", "left").join(own, ["file", "row"], "left")
        is_odd = F.col("m").isNotNull()
        out = out.select(
            "id", "file", "row", "digest", F.when(is_odd, F.col("k_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.when(is_odd, F.col("k_file")).otherwise(F.col("keep_file")).alias("keep_file"),
            F.when(is_odd, F.col("k_row")).otherwise(F.col("keep_row")).alias("keep_row"),
            F.coalesce("m", F.col("n") - F.coalesce("less", F.lit(0))).alias("n"))
    kept = (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))
    return out.select(F.col("id").alias(id_col), "keep_id", F.col("n").alias("group_size"), kept.alias("kept"),
                      "file", "row", "digest")
