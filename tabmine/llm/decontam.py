"""Benchmark decontamination by a prefix-filtered set join.

Benchmark items are cut into windows of item words, windows into shingles.
Shingles are ordered by how rare they are in the whole corpus; as a window must
be contained whole, its prefix is its one rarest shingle. Documents meet
windows on that shingle only; position and length bounds place the window, and
the words at that place are compared in full.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmine.llm.common import (BROADCAST_BYTES, ascii_lower, digest128, small, stage, text_of, words_of)


def _shingles(h, k: int):
    """Hashes of k consecutive word hashes; ``h`` is a column name."""
    n = F.greatest(F.size(h) - F.lit(k - 1), F.lit(0))
    return F.transform(F.slice(h, F.lit(1), n), lambda x, i: F.xxhash64(
        x, *[F.get(F.col(h), i + F.lit(j)) for j in range(1, k)]))


def benchmark_windows(bench: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item, win, len): each window of each item once; win is its words joined by spaces."""
    b = bench.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                     words_of(ascii_lower(text_of(text_col))).alias("w"))
    b = stage(b.filter(F.size("w") > 0), "bench-words")
    b = b.withColumn("len", F.least(F.lit(window), F.size("w")))
    b = b.select("item", "w", "len", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("len"))).alias("at"))
    return b.select("item", F.concat_ws(" ", F.slice("w", F.col("at") + 1, F.col("len"))).alias("win"),
                    "len").distinct()


def contaminate(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id",
                item_text_col: str = "text", window: int = 13, shingle: int = 5, share: int = 20,
                broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of ``docs`` plus n_words, n_hit, n_items (long), items (array of string) and contaminated.

    A window is ``window`` consecutive words of an item, or all of a shorter
    one; a document word inside any occurrence of a window is hit. A document
    is contaminated if it has hits and at least one word in ``share`` is hit.
    Null or empty texts have no words, items without words no windows; repeated
    items count once; a null item id is the empty string; an empty benchmark
    hits nothing; input columns named like a result column are replaced.

    The corpus is cut into shingles in one narrow pass that keeps only the
    benchmark's shingles, so what is shuffled grows with the matches. A text's
    md5 is its key; texts move only if the matches are too many to broadcast.
    """
    docs = docs.drop("n_words", "n_hit", "n_items", "items", "contaminated")
    owned = stage(benchmark_windows(bench, item_col, item_text_col, window), "bench-windows")
    wins = owned.select("win", "len").distinct().withColumn("h", F.transform(F.split("win", " "), lambda x: F.xxhash64(x)))
    wins = stage(wins.withColumn("k", F.least(F.lit(shingle), "len")), "bench-hashed")
    sizes = [r.k for r in wins.select("k").distinct().collect()]  # at most `shingle` values
    parts = [wins.filter(F.col("k") == k).select("win", "len", "k", F.posexplode(_shingles("h", k)).alias("off", "sh"))
             for k in sizes]
    words = docs.select(digest128(text_of(text_col)).alias("t"), words_of(ascii_lower(text_of(text_col))).alias("w"))
    found = None
    if parts:
        wsh = parts[0]
        for p in parts[1:]:
            wsh = wsh.union(p)
        wsh = stage(wsh, "bench-shingles")
        known = stage(wsh.select("k", "sh").distinct(), "bench-known")
        # the length here, or the whole array would be carried along with each shingle
        hashed = words.select("t", F.transform("w", lambda x: F.xxhash64(x)).alias("h"), F.size("w").alias("n"))
        cut = None
        for k in sizes:
            p = hashed.select("t", "n", F.lit(k).alias("k"), F.posexplode(_shingles("h", k)).alias("pos", "sh"))
            cut = p if cut is None else cut.union(p)
        found = stage(cut.join(small(known, 48, broadcast_bytes), ["k", "sh"], "left_semi"), "shingle-hits")
        # rarity over the whole corpus; a window with a shingle that never occurs cannot occur
        rare = found.groupBy("k", "sh").agg(F.count("*").alias("c"))
        prefix = (wsh.join(rare, ["k", "sh"], "left")
                  .groupBy("win", "len", "k")
                  .agg(F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "off", "sh")).alias("p"))
                  .filter("p.c > 0").select("win", "len", "k", "p.off", "p.sh"))
        prefix = stage(prefix, "bench-prefix")
        spots = (found.distinct().join(small(prefix, 512, broadcast_bytes), ["k", "sh"])
                 .withColumn("start", F.col("pos") - F.col("off"))
                 .filter((F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n")))
                 .groupBy("t").agg(F.collect_set(F.struct("start", "len", "win")).alias("spots")))
        spots = stage(spots, "window-spots")
        exact = (docs.select(digest128(text_of(text_col)).alias("t"), text_of(text_col).alias("x"))
                 .join(small(spots, 1024, broadcast_bytes), "t")
                 .groupBy("t").agg(F.first("x").alias("x"), F.first("spots").alias("spots"))
                 .select("t", words_of(ascii_lower(F.col("x"))).alias("w"), "spots"))
        # staged: the words must not be cut again for each spot
        exact = stage(exact, "window-words")
        seen = exact.select("t", F.filter("spots", lambda s: F.concat_ws(
            " ", F.slice("w", s["start"] + 1, s["len"])) == s["win"]).alias("spots")).filter(F.size("spots") > 0)
        seen = stage(seen, "window-seen")
        hits = seen.select("t", F.size(F.array_distinct(F.flatten(F.transform(
            "spots", lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1))))).cast("long").alias("n_hit"))
        items = (seen.select("t", F.explode(F.array_distinct(F.col("spots")["win"])).alias("win"))
                 .join(owned.select("win", "item"), "win")
                 .groupBy("t").agg(F.array_sort(F.collect_set("item")).alias("items")))
        result = stage(hits.join(items, "t"), "window-result")
    base = docs.withColumn("__t", digest128(text_of(text_col)))
    base = base.withColumn("n_words", F.size(words_of(ascii_lower(text_of(text_col)))).cast("long"))
    if found is None:
        out = base.withColumn("n_hit", F.lit(0).cast("long")).withColumn("items", F.array().cast("array<string>"))
    else:
        out = base.join(small(result.withColumnRenamed("t", "__t"), 256, broadcast_bytes), "__t", "left")
        out = (out.withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))
               .withColumn("items", F.coalesce("items", F.array().cast("array<string>"))))
    return (out.withColumn("n_items", F.size("items").cast("long"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))
            .drop("__t"))
