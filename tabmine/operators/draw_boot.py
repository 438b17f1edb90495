"""Exact bootstrap draws (E15, E16) counted by blocks of rows, without a row per draw in any shuffle.

All replicates' draws are numbers ``row * B + rep``; they are packed, some thousands to a
shuffled row, and sent to the block of rows they fall in. A packed row holds its sorted draws' distances,
Huffman coded: half a byte for each of many draws. A block of rows counts its draws in one
array and hands on its scores with their B counts, coded likewise (a quarter of a byte a count) and
packed by ranges of scores. Each range adds up equal scores and works out its part of all B
areas (``bucket_boot``).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabmine.operators.bucket_boot import TOTALS, _Area
from tabmine.operators.ranks import default_parts, value_cuts
from tabmine.operators.resample import dense_index
from tabmine.session import materialize

#: Counts (rows times replicates) of a block, draws packed at a time, draws of a task.
CELLS, PACK, TASK = 1 << 22, 1 << 23, 1 << 24
#: Bytes of counts that a range of scores holds before it adds up equal scores.
HELD = 1 << 23


#: MD5's fixed values: start, added constants, rotations of the four rounds.
START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
SINES = [int(abs(math.sin(i + 1)) * (1 << 32)) for i in range(64)]
TURNS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))


def _first_word(words: list) -> np.ndarray:
    """The first 32 bits of the MD5 of messages of one block: 16 words, each an array or the same number in all."""
    n = next(len(w) for w in words if isinstance(w, np.ndarray))
    a, b, c, d = (np.full(n, x, np.uint32) for x in START)
    f, high = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(64):
        if i < 16:
            np.bitwise_xor(c, d, out=f)
            np.bitwise_and(f, b, out=f)
            np.bitwise_xor(f, d, out=f)
            g = i
        elif i < 32:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_and(f, d, out=f)
            np.bitwise_xor(f, c, out=f)
            g = (5 * i + 1) % 16
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
            g = (3 * i + 5) % 16
        else:
            np.bitwise_not(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
            g = 7 * i % 16
        np.add(f, a, out=f)
        if isinstance(words[g], np.ndarray):
            np.add(f, words[g], out=f)
            np.add(f, np.uint32(SINES[i]), out=f)
        else:
            np.add(f, np.uint32((SINES[i] + words[g]) % (1 << 32)), out=f)
        turn = TURNS[i // 16][i % 4]
        np.left_shift(f, np.uint32(turn), out=high)
        np.right_shift(f, np.uint32(32 - turn), out=f)
        np.bitwise_or(f, high, out=f)
        np.add(f, b, out=f)
        a, d, c, b, f = d, c, b, f, a
    return (a + np.uint32(START[0])).byteswap()


def hashed(rep: np.ndarray, i: np.ndarray, seed: int) -> np.ndarray:
    """``hash_int(rep, i, seed)`` of a batch: the first 8 hex digits of md5(rep-i-seed)."""
    out, tail = np.empty(len(rep), np.int64), f"-{seed}".encode()
    tens = 10 ** np.arange(1, 19, dtype=np.int64)
    sizes = [np.searchsorted(tens, x[[0, -1]] if (x[1:] >= x[:-1]).all() else x, side="right") + 1 for x in (rep, i)]
    if all((x == x[0]).all() for x in sizes):  # all texts have one length
        codes = {int(sizes[0][0] * 32 + sizes[1][0]): slice(None)}
    else:
        both = (np.searchsorted(tens, rep, side="right") + 1) * 32 + np.searchsorted(tens, i, side="right") + 1
        codes = {code: np.flatnonzero(both == code) for code in np.unique(both).tolist()}
    for code, at in codes.items():
        lengths, words = divmod(code, 32), [0] * 16

        def put(place: int, byte) -> None:
            words[place // 4] = words[place // 4] + (byte << 8 * (place % 4))
        for x, length, start in ((rep[at], lengths[0], 0), (i[at], lengths[1], lengths[0] + 1)):
            x = x.astype(np.uint32) if length < 10 else x.astype(np.uint64)
            for j in reversed(range(length)):
                rest = x // x.dtype.type(10)
                put(start + j, (x - rest * x.dtype.type(10)).astype(np.uint32) + np.uint32(48))
                x = rest
        put(lengths[0], np.uint32(45))
        end = sum(lengths) + 1
        for j, byte in enumerate(tail + b"\x80"):
            put(end + j, np.uint32(byte))
        words[14] = (end + len(tail)) * 8
        out[at] = _first_word([w if isinstance(w, np.ndarray) else int(w) for w in words])
    return out


def _huffman(x: bytes) -> bytes:
    c = zlib.compressobj(1, zlib.DEFLATED, -15, 9, zlib.Z_HUFFMAN_ONLY)
    return c.compress(x) + c.flush()


def _coded(at: np.ndarray) -> bytes:
    """Sorted numbers below 2^32: the first, their number, distances from 255 up, and all distances, a byte each, coded."""
    far = np.diff(at)
    large = far[far >= 255].astype(np.uint32)
    return np.array([at[0], len(large)], np.uint32).tobytes() + large.tobytes() + _huffman(np.minimum(far, 255).astype(np.uint8).tobytes())


def _decoded(x: bytes) -> np.ndarray:
    first, n = np.frombuffer(x, np.uint32, 2).tolist()
    far = np.frombuffer(zlib.decompress(x[8 + 4 * n:], -15), np.uint8).astype(np.int64)
    far[far == 255] = np.frombuffer(x, np.uint32, n, 8)
    return first + np.concatenate([[0], np.cumsum(far)])


def _numbers(batches: Iterator[pa.RecordBatch], total: int, step: int) -> Iterator[pa.RecordBatch]:
    """Places of pieces of 0..total-1, ``step`` long, to the pieces' numbers."""
    for batch in batches:
        for t in batch.column(0).to_pylist():
            for lo in range(t * step, min((t + 1) * step, total), 8192):
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(lo, min(lo + 8192, (t + 1) * step, total)))], ["id"])


def _squeezed(pack, total: int, step: int, size: int, reps: int):
    """Places of pieces of all draws to ``pack``'s rows (block, at), each block's draws by replicate, then row, sorted and coded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pack(_numbers(batches, total, step)):
            made = []
            for x in batch.column("at"):
                off, rep = np.divmod(np.frombuffer(x.as_buffer(), np.uint32), np.uint32(reps))
                made.append(_coded(np.sort(rep * np.uint32(size) + off)))
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(made, pa.binary())], ["block", "at"])
    return run


def _pack(cells: int, n: int, reps: int, seed: int):
    """Numbers r * n + i to (block, at): draw i of replicate r as a 32-bit place in a block of ``cells`` numbers."""

    def emit(held: list[np.ndarray]) -> pa.RecordBatch:
        x = np.concatenate(held)
        block = x // cells
        order = np.argsort(block.astype(np.uint16) if block.max() < 1 << 16 else block, kind="stable")
        block, at = block[order], (x - block * cells).astype(np.uint32)[order]
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        return pa.RecordBatch.from_pydict({"block": block[first], "at": pa.array(
            [p.tobytes() for p in np.split(at, first[1:])], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            rep, i = np.divmod(batch.column(0).to_numpy(), n)
            held.append(hashed(rep, i, seed) % n * reps + rep)
            count += len(rep)
            if count >= PACK:
                yield emit(held)
                held, count = [], 0
        if count:
            yield emit(held)
    return run


def _narrow(w: np.ndarray) -> np.ndarray:
    return w.astype(np.uint8 if w.max() < 256 else np.int64)


def _block_counts(size: int, reps: int, cuts: list[float]):
    """A block's draws and rows to (model, part, p, y, w, wide): the scores of each range, their counts in all replicates."""

    def counts(draws: pa.Table, rows: pa.Table) -> pa.Table:
        kind = rows.schema.field("model").type
        schema = pa.schema([("model", kind), ("part", pa.int32()), ("p", pa.list_(pa.float64())), ("y", pa.list_(pa.int32())),
                            ("w", pa.binary()), ("wide", pa.bool_())])
        models, p, y, off, copies = (rows.column(c).to_pylist() if c == "model" else rows.column(c).to_numpy()
                                     for c in ("model", "p", "y", "off", "copies"))
        if not len(models) or not len(draws):
            return schema.empty_table()
        w = np.zeros(reps * size, np.int32)
        for chunk in draws.column("at").chunks:
            for x in chunk:
                at = _decoded(x.as_py())
                first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                w[at[first]] += np.diff(first, append=len(at)).astype(np.int32)
        w = w.reshape(reps, size)
        place = {m: i for i, m in enumerate(dict.fromkeys(models))}
        code = np.fromiter((place[m] for m in models), np.int64, len(models))
        order = np.lexsort((y, p, code))
        code, p, y, off, copies = code[order], p[order], y[order], off[order], copies[order]
        new = (code[1:] != code[:-1]) | (p[1:] != p[:-1]) | (y[1:] != y[:-1])
        first = np.flatnonzero(np.concatenate([[True], new]))
        total = np.empty((len(first), reps), np.int64 if copies.max() > 1 << 16 else np.int32)
        for lo in range(0, reps, 16):
            total[:, lo:lo + 16] = np.add.reduceat(w[lo:lo + 16, off] * copies, first, axis=1).T
        code, p, y = code[first], p[first], y[first]
        part = np.searchsorted(np.array(cuts, float), p, side="left")
        cut = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (part[1:] != part[:-1]), [True]]))
        names, out = list(place), []
        for lo, hi in zip(cut[:-1], cut[1:]):
            x = _narrow(total[lo:hi])
            out.append({"model": names[code[lo]], "part": int(part[lo]), "p": p[lo:hi], "y": y[lo:hi], "w": _huffman(x.tobytes()),
                        "wide": x.dtype != np.uint8})
        return pa.Table.from_pylist(out, schema)
    return counts


def _unpacked(reps: int):
    """Packed rows of a few ranges to rows (model, part, p, y, w) for their scores, equal ones added up as far as ``HELD`` goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, kind = {}, 0, None

        def merged(found: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            p, y = (np.concatenate([x[k] for x in found]) for k in (0, 1))
            w = np.concatenate([x[2] for x in found])
            order = np.lexsort((y, p))
            p, y, w = p[order], y[order], w[order]
            first = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (y[1:] != y[:-1])]))
            return p[first], y[first], _narrow(np.add.reduceat(w, first, axis=0, dtype=np.int64))

        def done() -> Iterator[pa.RecordBatch]:
            for (model, part), found in held.items():
                p, y, w = merged(found)
                for lo in range(0, len(p), 4096):
                    q = p[lo:lo + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([model] * len(q), kind), pa.array([part] * len(q), pa.int32()), pa.array(q),
                         pa.array(y[lo:lo + 4096], pa.int32()), pa.array([x.tobytes() for x in w[lo:lo + 4096]], pa.binary())],
                        ["model", "part", "p", "y", "w"])
        for batch in batches:
            kind = batch.schema.field("model").type
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i] for c in batch.schema.names}
                p, y = r["p"].values.to_numpy(), r["y"].values.to_numpy()
                w = np.frombuffer(zlib.decompress(r["w"].as_py(), -15), np.int64 if r["wide"].as_py() else np.uint8)
                held.setdefault((r["model"].as_py(), r["part"].as_py()), []).append((p, y, w.reshape(-1, reps)))
                size += w.nbytes
                if size > HELD:
                    held = {k: [merged(found)] for k, found in held.items()}
                    size = sum(found[0][2].nbytes for found in held.values())
                    if size > HELD // 2:
                        yield from done()
                        held, size = {}, 0
        yield from done()
    return run


def _areas(reps: int, threshold: float):
    """Sorted (model, part, p, y, w) to the totals of each model and part."""

    def decoded(w: list[bytes]) -> np.ndarray:
        if all(len(x) == reps for x in w):
            return np.frombuffer(b"".join(w), np.uint8).reshape(-1, reps).astype(float)
        return np.stack([np.frombuffer(x, np.uint8 if len(x) == reps else np.int64) for x in w]).astype(float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, area, seen = None, None, None

        def done() -> pa.RecordBatch:
            area.flush()
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * reps, kind), pa.array([key[1]] * reps, pa.int32()), pa.array(range(reps), pa.int32()),
                 pa.array(seen), *[pa.array(area.total[k]) for k in TOTALS]], ["model", "part", "rep", "seen", *TOTALS])
        for batch in batches:
            kind = batch.schema.field("model").type
            names = list(zip(batch.column("model").to_pylist(), batch.column("part").to_pylist()))
            p, y = (batch.column(c).to_numpy() for c in ("p", "y"))
            cuts = sorted({0, len(p), *range(0, len(p), 512), *(i for i in range(1, len(p)) if names[i] != names[i - 1])})
            for a, b in zip(cuts, cuts[1:]):
                if names[a] != key:
                    if key is not None:
                        yield done()
                    key, area, seen = names[a], _Area(reps), np.zeros(reps)
                w = decoded(batch.column("w").slice(a, b - a).to_pylist())
                seen = seen + w.sum(axis=0)
                area.add(p[a:b], w * (y[a:b] == 1)[:, None], w * (y[a:b] == 0)[:, None], threshold)
        if key is not None:
            yield done()
    return run


def exact_replicates(scores: DataFrame, B: int, seed: int = 42, model_col: str = "model", id_col: str = "row_id",
                     threshold: float = 0.5) -> DataFrame:
    """(model_col, rep, roc_auc, f1) of B resamples of the ids; draw i of replicate r is row md5(r-i-seed) mod n.

    Ids are numbered in their order; rows that share an id are drawn together. y is 0, 1 or null. A row without
    p counts nowhere, one without y in neither metric; a replicate that draws no row of a model has no f1
    there, one without both classes no area.
    """
    spark = scores.sparkSession
    rows = scores.groupBy(F.col(model_col).alias("model"), F.col(id_col).alias("id"), F.col("y").cast("int").alias("y"),
                          F.col("p").cast("double").alias("p")).agg(F.count(F.lit(1)).alias("copies"))
    rows = materialize(rows, "boot-scores")
    idx, n = dense_index(rows, "id")
    size = max(1, CELLS // B)
    rows = rows.where("model IS NOT NULL AND p IS NOT NULL").join(idx, "id").select(
        "model", F.when(F.isnan("p"), float("inf")).otherwise(F.col("p")).alias("p"), F.coalesce("y", F.lit(-1)).alias("y"),
        "copies", F.floor(F.col("idx") / size).cast("bigint").alias("block"), (F.col("idx") % size).cast("int").alias("off"))
    rows = materialize(rows, "boot-index")
    kind = rows.schema["model"].dataType.simpleString()
    tasks = max(default_parts(rows), -(-B * n // TASK))
    step = max(1, -(-B * n // tasks))
    draws = spark.range(0, tasks, 1, tasks).mapInArrow(
        _squeezed(_pack(size * B, n, B, seed), B * n, step, size, B), "block long, at binary")
    parts = default_parts(rows)
    counts = draws.groupBy("block").cogroup(rows.groupBy("block")).applyInArrow(
        _block_counts(size, B, value_cuts(rows, "p", parts)),
        f"model {kind}, part int, p array<double>, y array<int>, w binary, wide boolean")
    scored = counts.repartition(parts, "model", "part").mapInArrow(
        _unpacked(B), f"model {kind}, part int, p double, y int, w binary")
    totals = scored.sortWithinPartitions("model", "part", "p").mapInArrow(
        _areas(B, threshold), f"model {kind}, part int, rep int, seen double, " + ", ".join(f"{k} double" for k in TOTALS))
    totals = materialize(totals, "boot-parts")
    before = F.sum("neg").over(Window.partitionBy("model", "rep").orderBy("part")) - F.col("neg")
    t = totals.withColumn("conc", F.col("conc") + F.col("pos") * before).groupBy("model", "rep").agg(
        *[F.sum(k).alias(k) for k in ("seen", *TOTALS)])
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("pos")), F.lit(0.0))
    return t.select(F.col("model").alias(model_col), "rep", F.try_divide("conc", F.col("pos") * F.col("neg")).alias("roc_auc"),
                    F.when(F.col("seen") > 0, f1).alias("f1"))
