"""Substring dedup with difference-cover anchors.

A set of places modulo a period is a difference cover if every difference is
one between two of its places. Each text hashes runs of words at the cover's places
only; two texts that share a long enough run of words, wherever it stands in either, then share
the hash of a shorter run inside it (an anchor). Anchors that several documents
have are extended to the whole windows that hold them, and windows alone
decide: by 128 bits of their words, against the smallest document that has them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabmine.llm.arrow_text import STEP, mixed, nth, raw_texts
from tabmine.llm.common import BROADCAST_BYTES, stage, text_of

#: A perfect difference cover: 6 places give all 31 differences.
COVER, PERIOD = (0, 1, 3, 8, 12, 18), 31
PIECE = 1 << 20
IS_BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * STEP)
#: Odd, so that they have inverses modulo 2^64.
BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


class Powers:
    """Powers of a base modulo 2^64 and of its inverse, as many as were ever asked for."""

    def __init__(self, base: int):
        self.bases = [np.uint64(base), np.uint64(pow(base, -1, 1 << 64))]
        self.tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def upto(self, n: int) -> list[np.ndarray]:
        if len(self.tables[0]) < n:
            size = max(n, 1 << 12)
            self.tables = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, b)])) for b in self.bases]
        return self.tables

    def runs(self, x: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of x[start:end] for each pair, whatever the place."""
        up, down = self.upto(len(x) + 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(x * up[:len(x)])])
        return (sums[end] - sums[start]) * down[start]


POWERS = [Powers(b) for b in BASES]


def pieces(text: bytes, most: int = PIECE) -> Iterator[np.ndarray]:
    """The text's bytes in pieces of about ``most`` that end at blanks; a longer word stays whole."""
    b = np.frombuffer(text, np.uint8)
    at = 0
    while len(b) - at > most:
        gaps = np.flatnonzero(IS_BLANK[b[at:at + most]])
        end = at + most
        while not len(gaps) and end < len(b):
            gaps = np.flatnonzero(IS_BLANK[b[end:end + most]]) + (end - at)
            end += most
        if not len(gaps):
            break
        yield b[at:at + int(gaps[-1]) + 1]
        at += int(gaps[-1]) + 1
    yield b[at:]


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of a text's words, runs of anything but ASCII blanks."""
    out = []
    for b in pieces(text):
        word = np.concatenate([[False], ~IS_BLANK[b], [False]])
        edge = np.flatnonzero(word[1:] != word[:-1])
        start, end = edge[::2], edge[1::2]
        out.append(mixed(POWERS[0].runs(BYTE[b], start, end) + (end - start).astype(np.uint64) * STEP))
    return np.concatenate(out)


def window_hashes(h: np.ndarray, at: np.ndarray, window: int, family: int = 0) -> np.ndarray:
    """Hashes of ``window`` consecutive words from each place of ``at``; families are independent."""
    return mixed(POWERS[family].runs(h if family == 0 else mixed(h ^ nth(family)), at, at + window))


def cover_places(n: int, cover: tuple[int, ...], period: int) -> np.ndarray:
    """Places below n that lie in the cover modulo the period, ascending."""
    x = (np.arange(0, max(n, 0), period)[:, None] + np.array(sorted(cover))[None, :]).ravel()
    return x[x < n]


def joined(start: np.ndarray, width: int) -> tuple[list[int], list[int]]:
    """The union of [s, s + width) as disjoint ascending runs."""
    s = np.unique(start)
    if not len(s):
        return [], []
    new = np.flatnonzero(np.concatenate([[True], s[1:] > s[:-1] + width]))
    return s[new].tolist(), (s[np.concatenate([new[1:] - 1, [len(s) - 1]])] + width).tolist()


def _map(df: DataFrame, fn, columns: str) -> DataFrame:
    """``df`` with fn(batch) -> list of arrays as further ``columns``; fn sees 256 rows at a time."""
    added = T.StructType.fromDDL(columns)
    kept, names = df.columns, added.names

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + fn(part), names=kept + names)
    return df.mapInArrow(run, T.StructType(df.schema.fields + added.fields))


def anchors(docs: DataFrame, window: int, cover: tuple[int, ...], period: int) -> DataFrame:
    """(id, t, places): hashes of the runs at a text's cover places, in order."""
    width = window - period + 1

    def hashed(batch):
        out = []
        for text in raw_texts(batch.column("x")):
            h = word_hashes(text) if len(text) >= 2 * width - 1 else ()
            out.append(window_hashes(h, cover_places(len(h) - width + 1, cover, period), width).view(np.int64)
                       if len(h) >= width else np.zeros(0, np.int64))
        ends = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
        return [pa.ListArray.from_arrays(ends, np.concatenate(out) if out else np.zeros(0, np.int64))]
    return _map(docs, hashed, "places array<bigint>").select("id", "t", "places")


def _runs(df: DataFrame, fn, width: int, columns: tuple[str, ...], name: str) -> DataFrame:
    """``df`` with each of ``columns`` (arrays) as the runs that [fn(column), + width) cover; staged."""
    def run(batch):
        out = []
        for c in columns:
            both = [joined(fn(np.array(x, np.int64)), width) for x in batch.column(c).to_pylist()]
            out.append(pa.array([[{"from": a, "to": z} for a, z in zip(*x)] for x in both],
                                pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))))
        return out
    made = ", ".join(f"__{c} array<struct<from: bigint, to: bigint>>" for c in columns)
    return stage(_map(df, run, made).drop(*columns).withColumnsRenamed({f"__{c}": c for c in columns}), name)


def _fitting(df: DataFrame, column: str, limit: int) -> DataFrame:
    """A staged table of runs with a broadcast hint if it fits in ``limit`` bytes, else as it is."""
    size = df.agg(F.sum(F.lit(96) + F.size(column) * 24)).head()[0] or 0
    return F.broadcast(df) if size <= limit else df


def _windows(docs: DataFrame, marks: DataFrame, column: str, window: int, limit: int) -> DataFrame:
    """(id, row, s, h, g): the windows that begin in a text's runs, with 128 bits of their words."""
    def cut(batch):
        keys, ends = [[np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)]], [0]
        for text, runs in zip(raw_texts(batch.column("x")), batch.column("runs").to_pylist()):
            h = word_hashes(text)
            last = len(h) - window + 1
            s = np.concatenate([np.arange(r["from"], min(r["to"], last)) for r in runs]).astype(np.int64)
            keys.append([s, window_hashes(h, s, window), window_hashes(h, s, window, 1)])
            ends.append(ends[-1] + len(s))
        s, h, g = (np.concatenate(x) for x in zip(*keys))
        items = pa.StructArray.from_arrays([pa.array(s.astype(np.int32)), pa.array(h.view(np.int64)), pa.array(g.view(np.int64))],
                                           names=["s", "h", "g"])
        return [pa.ListArray.from_arrays(np.array(ends, np.int32), items)]
    runs = marks.filter(F.size(column) > 0).select("id", "t", "row", F.col(column).alias("runs"))
    cutting = docs.join(_fitting(runs, "runs", limit), ["id", "t"])
    return _map(cutting, cut, "w array<struct<s: int, h: bigint, g: bigint>>").select("id", "row", F.inline("w"))


def repeated_words(docs: DataFrame, window: int = 50, cover: tuple[int, ...] = COVER, period: int = PERIOD,
                   broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(id, t, cuts): the runs (from, to) of words of each text that windows of smaller documents cover.

    ``docs`` has id (bigint), x (text) and t (digest of x). Staged; texts without such words have no row.
    """
    if {(a - b) % period for a in cover for b in cover} != set(range(period)) or not period <= window:
        raise ValueError(f"{cover} is no difference cover modulo {period}, or the window {window} is shorter than that")
    # 1: anchors that several documents have. Counted map-side first; the extremes of the ids suffice.
    found = anchors(docs, window, cover, period)
    shared = (found.select("id", F.explode("places").alias("h")).groupBy("h")
              .agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi").select("h", "lo"))
    shared = stage(shared, "anchors-shared")
    # 2: where each text has them, and where a smaller document has them too (sets: repeated rows add nothing).
    # Frequent anchors are split on the left side of this join, the right has each once.
    at = found.select("id", "t", F.posexplode("places").alias("i", "h")).join(shared, "h")
    at = at.groupBy("id", "t").agg(F.collect_set("i").alias("all"), F.collect_set(F.when(F.col("lo") < F.col("id"), F.col("i"))).alias("mine"))
    places = np.array(sorted(cover))
    marks = _runs(at, lambda i: np.maximum(i // len(places) * period + places[i % len(places)] - period + 1, 0),
                  period, ("all", "mine"), "anchors-marks")
    marks = stage(marks.withColumn("row", F.monotonically_increasing_id()), "anchors-rows")
    # 3: extend them to the windows that hold them. All count for who is first; those that
    # hold an anchor of a smaller document can go.
    first = (_windows(docs, marks, "all", window, broadcast_bytes).groupBy("h", "g")
             .agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi").select("h", "g", "lo"))
    first = stage(first, "anchors-first")
    gone = (_windows(docs, marks, "mine", window, broadcast_bytes).join(first, ["h", "g"]).filter("lo < id")
            .groupBy("row").agg(F.collect_set("s").alias("cuts")))
    gone = stage(gone, "anchors-gone").join(marks.select("row", "id", "t"), "row").drop("row")
    return _runs(gone, lambda s: s, window, ("cuts",), "anchors-cuts")


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50,
                 cover: tuple[int, ...] = COVER, period: int = PERIOD,
                 broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of ``docs`` plus n_words, n_removed (long) and kept (string): the words that stay, joined by one space.

    Words are runs of anything but ASCII blanks. A word goes if a window of ``window``
    consecutive words covers it whose words also stand, in a row, in a document of smaller
    id; windows are judged on the texts as given. Ids are integers; a null id counts as
    larger than all others. Rows of one id never take words from each other; repeated rows
    are treated alike. Null and empty texts have no words, and texts of fewer words than
    the window lose none, however often they occur. Input columns named like a result
    column are replaced.

    Exact up to 128-bit hashes of windows over 64-bit hashes of words. Texts are read in
    place: anchors and windows are shuffled as numbers, combined before the shuffle, and
    where the runs to cut fit in ``broadcast_bytes`` the texts are not shuffled at all.
    """
    docs = docs.drop("n_words", "n_removed", "kept")
    own = {c: f"__own_{i}" for i, c in enumerate(docs.columns)}
    rows = docs.withColumnsRenamed(own)
    ident = F.coalesce(F.col(own[id_col]).cast("bigint"), F.lit((1 << 63) - 1)).alias("id")
    body = text_of(own[text_col])
    keyed = rows.select(ident, body.alias("x"), F.xxhash64(body).alias("t"))  # tells texts of one id apart
    cuts = repeated_words(keyed, window, cover, period, broadcast_bytes)
    rows = rows.select("*", ident, F.xxhash64(body).alias("t"))
    rows = rows.join(_fitting(cuts, "cuts", broadcast_bytes), ["id", "t"], "left")

    def keep(batch):
        n, gone, kept = [], [], []
        for text, cuts in zip(raw_texts(batch.column(own[text_col])), batch.column("cuts").to_pylist()):
            words = left = text.split()
            n.append(len(words))
            if cuts:
                left = [w for x, y in zip([0, *[c["to"] for c in cuts]], [*[c["from"] for c in cuts], len(words)]) for w in words[x:y]]
            gone.append(len(words) - len(left))
            kept.append(b" ".join(left))
        return [pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
    out = _map(rows, keep, "n_words bigint, n_removed bigint, kept string").drop("id", "t", "cuts")
    return out.withColumnsRenamed({v: k for k, v in own.items()})
