"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Every token falls into a slot: words by hash, other shapes (shouting, trailing
symbols, symbols alone, numbers, a token said twice running) into slots of
their own. A slot has a fixed sparse random index vector; its word vector is the
sum of the index vectors of its neighbours over the whole corpus. A document is
the weighted mean of its slots' index and word vectors. A two-layer network in
numpy scores it, and a temperature fitted on rows it was not trained on makes
the score a probability.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabmine.llm.arrow_text import mixed, nth, raw_texts, shares
from tabmine.llm.common import stage, text_of

WORD_SLOTS, SHAPES, DIM, NONZERO, REACH = 4096, 16, 48, 4, 2
SLOTS = WORD_SLOTS + SHAPES
TWICE = WORD_SLOTS + SHAPES - 1
LETTER = re.compile(rb"[A-Za-z\x80-\xff]")
SYMBOL_TAIL = re.compile(rb"[^A-Za-z0-9\x80-\xff]{2,}$")
MARKS = frozenset([b".", b",", b";", b":", b"!", b"?"])
EDGE = re.compile(rb"^[^A-Za-z0-9\x80-\xff]+|[^A-Za-z0-9\x80-\xff]+$")


def slot_of(token: bytes) -> int:
    """A shape's slot, or a word's by its hash."""
    plain = token[:-1] if token[-1:] in MARKS else token
    if plain.isalpha():  # ASCII letters, a mark behind them at most: what the rules below come to
        return WORD_SLOTS + 5 if len(plain) > 1 and plain.isupper() else xxhash.xxh64_intdigest(plain.lower()) % WORD_SLOTS
    if not LETTER.search(token):
        if not re.search(rb"[0-9]", token):
            return WORD_SLOTS + (0 if len(token) == 1 else 1)
        return WORD_SLOTS + (2 if token.isalnum() else 3)
    if SYMBOL_TAIL.search(token):
        return WORD_SLOTS + 4
    word = EDGE.sub(b"", token)
    if len(word) > 1 and word.isascii() and word.isupper() or len(word) > 2 and word.decode("utf-8", "replace").isupper():
        return WORD_SLOTS + 5
    if re.search(rb"[0-9]", word):
        return WORD_SLOTS + (6 if b"@" in word or b"." in word else 7)
    if re.search(rb"[^A-Za-z\x80-\xff'-]", word):
        return WORD_SLOTS + 8
    return xxhash.xxh64_intdigest(word.lower()) % WORD_SLOTS


class Slots(dict):
    def __missing__(self, token: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        s = self[token] = slot_of(token)
        return s


def index_places() -> list[tuple[np.ndarray, np.ndarray]]:
    """NONZERO pairs (dimension, sign) of every slot's index vector, the same everywhere."""
    hashes = [mixed(np.arange(SLOTS, dtype=np.uint64) + nth(k + 1)) for k in range(NONZERO)]
    return [((h % np.uint64(DIM)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)) for h in hashes]


def index_vectors() -> np.ndarray:
    """(SLOTS, DIM) sparse vectors."""
    out = np.zeros((SLOTS, DIM))
    for dim, sign in index_places():
        out[np.arange(SLOTS), dim] += sign
    return out


def slots_of(texts: list[bytes], known: Slots) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all tokens in one array, and how many each text has."""
    parts = [t.split() for t in texts]
    n = np.array([len(p) for p in parts])
    out = np.fromiter(map(known.__getitem__, chain.from_iterable(parts)), np.int64, n.sum())
    if len(out):
        same = np.concatenate([[False], out[1:] == out[:-1]])
        first = np.cumsum(n)[:-1]
        same[first[first < len(out)]] = False
        out[same & (out < WORD_SLOTS)] = TWICE
    return out, n


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sums: (slot, count, vector) of the slots it met."""
    known, places = Slots(), index_places()
    near, count = np.zeros((SLOTS, DIM)), np.zeros(SLOTS)
    for batch in batches:
        texts = raw_texts(batch.column(0))
        for a, b in shares(texts):
            s, n = slots_of(texts[a:b], known)
            doc = np.repeat(np.arange(b - a), n)
            count += np.bincount(s, minlength=SLOTS)
            for d in range(1, REACH + 1):
                ok = doc[d:] == doc[:-d]
                left, right = s[:-d][ok], s[d:][ok]
                for x, y in ((left, right), (right, left)):
                    for dim, sign in places:
                        near += np.bincount(x * DIM + dim[y], sign[y], SLOTS * DIM).reshape(SLOTS, DIM)
    met = np.flatnonzero(count)
    if len(met):
        yield pa.record_batch([pa.array(met), pa.array(count[met]), *[pa.array(near[met, j].copy()) for j in range(DIM)]],
                              ["slot", "n", *[f"v{j}" for j in range(DIM)]])


def word_vectors(docs: DataFrame, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, weights) of the slots, summed over every text of ``docs``; at most SLOTS rows come back."""
    cols = ["n", *[f"v{j}" for j in range(DIM)]]
    schema = "slot long, " + ", ".join(f"{c} double" for c in cols)
    rows = (docs.select(text_of(text_col)).mapInArrow(_gather, schema).groupBy("slot")
            .agg(*[F.sum(c).alias(c) for c in cols]).toPandas())
    near, count = np.zeros((SLOTS, DIM)), np.zeros(SLOTS)
    if len(rows):
        count[rows["slot"]] = rows["n"]
        near[rows["slot"]] = rows[cols[1:]]
    mean = near.sum(axis=0) / max(1.0, count.sum())
    near = near / np.maximum(count, 1.0)[:, None] - mean
    near /= np.maximum(np.linalg.norm(near, axis=1, keepdims=True), 1e-9)
    share = count / max(1.0, count.sum())
    weight = 1e-2 / (1e-2 + share)  # frequent words weigh less, shapes do not
    weight[WORD_SLOTS:] = 1.0
    return np.concatenate([index_vectors(), near * (count > 0)[:, None]], axis=1), weight


def pooled(texts: list[bytes], known: Slots, vectors: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A row per text: weighted mean of its slots' vectors, log length, share of each shape."""
    out = np.zeros((len(texts), vectors.shape[1] + 1 + SHAPES))
    weighted = vectors * weight[:, None]
    for a, b in shares(texts, 1 << 16):  # a share's token vectors fit the cache
        s, n = slots_of(texts[a:b], known)
        own = np.flatnonzero(n) + a
        out[a:b, vectors.shape[1]] = np.log1p(n) / 10
        if not len(own):
            continue
        start = np.concatenate([[0], np.cumsum(n[own - a])[:-1]])
        w = weight[s]
        out[own, :vectors.shape[1]] = (np.add.reduceat(weighted[s], start)
                                       / np.add.reduceat(w, start)[:, None])
        shape = np.bincount(np.repeat(own - a, n[own - a]) * SHAPES + np.maximum(s - WORD_SLOTS, 0),
                            s >= WORD_SLOTS, (b - a) * SHAPES).reshape(-1, SHAPES)
        out[own, -SHAPES:] = shape[own - a] / n[own - a][:, None]
    return out


@dataclass
class Network:
    """tanh layer and sigmoid output; ``heat`` divides the logit."""
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    mean: np.ndarray
    scale: np.ndarray
    heat: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(np.clip((x - self.mean) / self.scale, -8, 8) @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.heat, -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, held: np.ndarray, hidden: int = 32, epochs: int = 60, rate: float = 0.005,
        decay: float = 1e-4, seed: int = 7) -> Network:
    """Adam on the rows that are not ``held``; the temperature is fitted on those that are."""
    rng = np.random.default_rng(seed)
    xs, ys = x[~held], y[~held]
    mean, scale = xs.mean(axis=0), xs.std(axis=0) + 1e-3
    base = float(np.clip(ys.mean(), 0.01, 0.99))
    net = Network(rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden),
                  rng.normal(0, 0.1, hidden), float(np.log(base / (1 - base))), mean, scale)
    z = np.clip((xs - mean) / scale, -8, 8)
    p = [net.w1, net.b1, net.w2, np.array([net.b2])]
    m, v, step = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
    for _ in range(epochs):
        for i in np.array_split(rng.permutation(len(z)), max(1, len(z) // 128)):
            h = np.tanh(z[i] @ p[0] + p[1])
            d = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3][0], -500, 500))) - ys[i]) / len(i)
            back = np.outer(d, p[2]) * (1 - h * h)
            g = [z[i].T @ back + decay * p[0], back.sum(axis=0), h.T @ d + decay * p[2], np.array([d.sum()])]
            step += 1
            for q, gq, mq, vq in zip(p, g, m, v):
                mq += 0.1 * (gq - mq)
                vq += 0.001 * (gq * gq - vq)
                q -= rate * (mq / (1 - 0.9 ** step)) / (np.sqrt(vq / (1 - 0.999 ** step)) + 1e-8)
    net.b2 = float(p[3][0])
    if held.any():  # the temperature of least log loss
        t = net.logit(x[held])
        heats = np.geomspace(0.2, 8, 60)
        loss = [np.mean(np.logaddexp(0, t / c) - y[held] * t / c) for c in heats]
        net.heat = float(heats[int(np.argmin(loss))])
    return net


def remainder(id_col: str, by: int):
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(by))


def score_quality(docs: DataFrame, labels: DataFrame, corpus: DataFrame | None = None, id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "quality", folds: int = 5, max_labelled: int = 20000,
                  threshold: float = 0.3) -> DataFrame:
    """Rows of ``docs`` plus held_out, score (double in [0, 1]) and predicted (int, 1 from ``threshold`` on).

    Word vectors come from all texts of ``docs``. Labels are learnt from rows of
    ``corpus`` (``docs`` if not given) whose crc32(identifier as text) mod
    ``folds`` is not 0, about ``max_labelled`` of them at most, picked by hash:
    that bounds what the driver trains on. One fold of those (remainder 1) is
    kept for the temperature. Inputs are texts alone.

    Null counts as the empty text, which has a score like any other. Labels are
    averaged per identifier and count as 1 from a half on; null labels and
    identifiers do not count. Without any label every score is 0.5. Repeated rows
    are scored alike; an empty table gives an empty result; input columns named
    like a result column are replaced.
    """
    docs = docs.drop("held_out", "score", "predicted")
    corpus = docs if corpus is None else corpus
    vectors, weight = word_vectors(docs, text_col)
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("__id")).agg(F.avg(label_col).alias("__y"))
             .filter(F.pmod(F.crc32(F.col("__id").cast("string")), F.lit(folds)) != 0))
    known = stage(known, "labels")
    n = known.count()
    if n > max_labelled:
        known = known.filter(F.pmod(F.xxhash64("__id"), F.lit(1 << 30)) < int((1 << 30) * max_labelled / n))
    chosen = corpus.select(F.col(id_col).alias("__id"), text_of(text_col).alias("__x")).join(
        F.broadcast(known), "__id").withColumn("__f", F.pmod(F.crc32(F.col("__id").cast("string")), F.lit(folds)))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = Slots()
        for b in batches:
            x = pooled(raw_texts(b.column(0)), slots, vectors, weight)
            yield pa.record_batch([b.column(1), b.column(2), b.column(3), pa.array([r.astype("f4").tobytes() for r in x], pa.binary())],
                                  ["id", "y", "f", "x"])

    rows = chosen.select("__x", F.col("__id").cast("string"), "__y", "__f").mapInArrow(
        features, "id string, y double, f long, x binary").orderBy("id").collect()  # about max_labelled rows
    net = None
    if rows:
        x = np.stack([np.frombuffer(r.x, "f4") for r in rows]).astype(float)
        y, held = np.array([float(r.y >= 0.5) for r in rows]), np.array([r.f == 1 for r in rows])
        net = fit(x, y, held if 0 < held.sum() < len(held) else np.zeros(len(held), bool))

    at = docs.columns.index(text_col)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = Slots()
        for b in batches:
            texts = raw_texts(b.column(at))
            s = net.score(pooled(texts, slots, vectors, weight)) if net else np.full(len(texts), 0.5)
            yield pa.record_batch([*b.columns, pa.array(s), pa.array((s >= threshold).astype("i4"))],
                                  [*b.schema.names, "score", "predicted"])

    rows = docs.withColumn("held_out", remainder(id_col, folds) == 0)
    schema = T.StructType([*rows.schema.fields]).add("score", "double").add("predicted", "integer")
    return rows.mapInArrow(judge, schema)
