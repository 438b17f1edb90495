"""Language-model scoring: a gated recurrent network with a class-factored softmax.

The corpus counts of every training token come from a Spark aggregation. The
most frequent tokens are the network's vocabulary, cut into classes of like
frequency; all others are one more class, inside which a token's probability
follows from its corpus count. P(token) = P(class | state) P(token | class,
state). The network is trained in numpy by truncated backpropagation inside
tasks, each on its own partition of training documents, and the tasks' weights
are averaged by Spark. Scoring carries the state across windows from the first
token of a document to its end.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmine.llm.arrow_text import raw_texts, shares
from tabmine.llm.common import stage, text_of
from tabmine.llm.quality import remainder

#: The end of a text, as a token: no word holds a blank.
END = b"\n"
#: Tokens with at least this share of all training tokens are sent to every task: at most 2^20 of them.
HOT_SHARE = 1 << 20
ALPHA = 0.1
#: Text laid out in lanes at once: enough that the longest text doesn't outlast all others, and lanes stay full.
LAID_BYTES = 1 << 24


def tokens(text: bytes) -> list[bytes]:
    """A-Z lower-cased, cut at space and \\t-\\r, one end. bytes.lower() and split() touch ASCII only."""
    out = text.lower().split()
    out.append(END)
    return out


def key(token: bytes) -> int:
    """64-bit identity of a token, signed."""
    h = xxhash.xxh64_intdigest(token)
    return h - (1 << 64) if h >> 63 else h


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.record_batch([pa.array(map(key, seen.keys()), pa.int64()), pa.array(seen.values(), pa.int64())], ["h", "c"])

    for batch in batches:
        for t in raw_texts(batch.column(0)):
            seen.update(tokens(t))
            if len(seen) > 500_000:
                yield out()
                seen.clear()
    if seen:
        yield out()


def token_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(h, c): how often each token of ``docs`` occurs, ends included. Tokens are told apart by 64-bit hashes."""
    return docs.select(text_of(text_col)).mapInArrow(_counts, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


class Vocabulary:
    """Frequent tokens (by key) with their counts; the first ``size`` by count are the network's, in classes."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, size: int, classes: int):
        order = np.lexsort((keys, -counts))
        self.keys, self.counts = keys[order], counts[order]
        self.size = min(size, len(keys))
        self.classes = max(1, min(classes, self.size))
        cut = np.array_split(np.arange(self.size), self.classes)
        self.start = np.array([c[0] if len(c) else 0 for c in cut] + [self.size])
        self.class_of = np.repeat(np.arange(self.classes), np.diff(self.start))
        self.at = {int(k): i for i, k in enumerate(self.keys)}


class Codes(dict):
    """token -> place in the vocabulary, or len(vocabulary) + a running number, whose key is in ``rare``."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.rare = vocab, []

    def __missing__(self, token: bytes) -> int:
        h = key(token)
        i = self.vocab.at.get(h, -1)
        if i < 0:
            i = len(self.vocab.keys) + len(self.rare)
            self.rare.append(h)
        self[token] = i
        return i

    def trim(self) -> None:
        if len(self) > 500_000:
            self.clear()
            self.rare = []


class Gru:
    """Parameters by name. Inputs: network vocabulary, then rare, then start of text."""

    def __init__(self, vocab: Vocabulary, hidden: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        k, c, h = vocab.size, vocab.classes, hidden
        tail = max(1.0, float(vocab.counts[k:].sum()))
        mass = np.array([vocab.counts[a:b].sum() for a, b in zip(vocab.start[:-1], vocab.start[1:])] + [tail], float)
        self.start, self.class_of, self.hidden, self.size = vocab.start, vocab.class_of, h, k
        self.p = {
            "x": rng.normal(0, 0.3, (k + 2, 3 * h)).astype("f4"), "u": rng.normal(0, h ** -0.5, (h, 3 * h)).astype("f4"),
            "b": np.zeros(3 * h, "f4"),
            "wc": np.zeros((h, c + 1), "f4"), "bc": np.log(mass + 1).astype("f4"),
            "ww": np.zeros((h, k), "f4"), "bw": np.log(vocab.counts[:k] + 1.0).astype("f4")}

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def load(self, flat: np.ndarray) -> "Gru":
        at = 0
        for n, v in self.p.items():
            self.p[n] = flat[at:at + v.size].reshape(v.shape).astype("f4")
            at += v.size
        return self

    def view(self, flat: np.ndarray) -> None:
        """Parameters become views of ``flat``."""
        at = 0
        for n, v in self.p.items():
            self.p[n] = flat[at:at + v.size].reshape(v.shape)
            at += v.size

    def steps(self, x: np.ndarray, first: np.ndarray, h: np.ndarray) -> list[tuple]:
        """States of a window; x, first: (time, lanes). Each entry: h before, z, r, n, h u_n, h after."""
        p, d, out = self.p, self.hidden, []
        table = p["x"] + p["b"]
        table[:, :2 * d] *= 0.5  # a sigmoid is a tanh of half its argument
        u = p["u"].copy()
        u[:, :2 * d] *= 0.5
        a, begin = table[x], first.any(axis=1)
        for t in range(len(x)):
            if begin[t]:
                h = np.where(first[t][:, None], np.float32(0), h)
            g = h @ u
            zr = a[t, :, :2 * d] + g[:, :2 * d]
            np.tanh(zr, out=zr)
            zr += 1
            zr *= 0.5
            un = g[:, 2 * d:]
            n = zr[:, d:] * un
            n += a[t, :, 2 * d:]
            np.tanh(n, out=n)
            new = h - n
            new *= zr[:, :d]
            new += n
            out.append((h, zr[:, :d], zr[:, d:], n, un, new))
            h = new
        return out

    def outputs(self, h: np.ndarray, y: np.ndarray, grad: bool = False):
        """Log probability of each target's class and, in the vocabulary, of the target in it; gradients of the mean.

        Targets lie along the last axis, sorted by class, so sums over a class's words run along whole rows.
        """
        p, c, n = self.p, len(self.start) - 1, len(y)
        cls = np.append(self.class_of, c)[np.minimum(y, self.size)]
        order = np.argsort(cls, kind="stable")
        h, cls, y = h[order].T.copy(), cls[order], y[order]
        ends = np.searchsorted(cls, np.arange(c + 1))
        m, cols = ends[c], np.arange(n)  # the first m targets are in the vocabulary
        lc = p["wc"].T @ h
        lc += p["bc"][:, None]
        lc -= lc.max(axis=0)
        logp = lc[cls, cols]
        np.exp(lc, out=lc)
        s = lc.sum(axis=0)
        logp -= np.log(s)
        width = int(np.diff(self.start).max())
        lw = np.full((width, m), -np.inf, h.dtype)  # a class with fewer words than the widest: probability 0 beyond them
        for k in range(c):
            i, j, a, b = ends[k], ends[k + 1], self.start[k], self.start[k + 1]
            if i < j:
                np.matmul(p["ww"][:, a:b].T, h[:, i:j], out=lw[:b - a, i:j])
                lw[:b - a, i:j] += p["bw"][a:b, None]
        lw -= lw.max(axis=0)
        own = y[:m] - self.start[cls[:m]]
        logp[:m] += lw[own, cols[:m]]
        np.exp(lw, out=lw)
        sw = lw.sum(axis=0)
        logp[:m] -= np.log(sw)
        back = np.empty_like(order)
        back[order] = cols
        if not grad:
            return logp[back]
        lc /= s
        lc[cls, cols] -= 1
        lc /= n
        dh = p["wc"] @ lc
        g = {"wc": h @ lc.T, "bc": lc.sum(axis=1), "ww": np.zeros_like(p["ww"]), "bw": np.zeros_like(p["bw"])}
        lw /= sw
        lw[own, cols[:m]] -= 1
        lw /= n
        for k in range(c):
            i, j, a, b = ends[k], ends[k + 1], self.start[k], self.start[k + 1]
            if i < j:
                dw = lw[:b - a, i:j]
                g["ww"][:, a:b] = h[:, i:j] @ dw.T
                g["bw"][a:b] = dw.sum(axis=1)
                dh[:, i:j] += p["ww"][:, a:b] @ dw
        return logp[back], dh.T[back], g

    def window_grad(self, x, first, y, live, h):
        """Mean loss of a window, its gradients, and the state after it; backpropagation stops at the window's start."""
        p, d = self.p, self.hidden
        run = self.steps(x, first, h)
        hs = np.stack([s[5] for s in run])
        at = np.flatnonzero(live.ravel())
        logp, dh, g = self.outputs(hs.reshape(-1, d)[at], y.ravel()[at], True)
        into = np.zeros((live.size, d), hs.dtype)
        into[at] = dh
        into = into.reshape(hs.shape)
        # what each gate's gradient is times, for the whole window at once
        h0, z, r, n, un = (np.stack([s[i] for s in run]) for i in range(5))
        for_z, for_n, for_r = (h0 - n) * z * (1 - z), (1 - z) * (1 - n * n), un * r * (1 - r)
        da = np.empty((*hs.shape[:2], 3 * d), hs.dtype)
        dg = np.empty_like(da)
        back, ut, begin = np.zeros_like(h), p["u"].T.copy(), first.any(axis=1)
        for t in range(len(run) - 1, -1, -1):
            dn = into[t] + back
            keep = dn * z[t]
            np.multiply(dn, for_z[t], out=dg[t, :, :d])
            dn *= for_n[t]
            np.multiply(dn, for_r[t], out=dg[t, :, d:2 * d])
            np.multiply(dn, r[t], out=dg[t, :, 2 * d:])
            da[t, :, 2 * d:] = dn
            back = dg[t] @ ut
            back += keep
            if begin[t]:
                back[first[t]] = 0
        da[:, :, :2 * d] = dg[:, :, :2 * d]
        da, dg = da.reshape(-1, 3 * d), dg.reshape(-1, 3 * d)
        g |= {"x": np.zeros_like(p["x"]), "u": h0.reshape(-1, d).T @ dg}
        xs = x.ravel()
        order = np.argsort(xs, kind="stable")
        met = np.flatnonzero(np.diff(xs[order], prepend=-1))
        g["x"][xs[order[met]]] = np.add.reduceat(da[order], met)
        g["b"] = da.sum(axis=0)
        return -float(logp.mean()), g, run[-1][5]


def lanes(lengths: np.ndarray, n: int) -> list[list[int]]:
    """Texts dealt to at most ``n`` lanes of about the same number of tokens, longest lane first."""
    import heapq
    heap = [(0, i) for i in range(min(n, len(lengths)))]
    out: list[list[int]] = [[] for _ in heap]
    for d in np.argsort(-lengths, kind="stable"):
        size, i = heapq.heappop(heap)
        out[i].append(int(d))
        heapq.heappush(heap, (size + int(lengths[d]), i))
    return sorted(out, key=lambda ds: -int(lengths[ds].sum()))


def lay_out(codes: list[np.ndarray], size: int, n: int):
    """(x, y, first, doc): (time, lanes) arrays of inputs, targets, text starts and text numbers (-1: none)."""
    lengths = np.array([len(c) for c in codes])
    ls = lanes(lengths, n)
    time = int(lengths[ls[0]].sum())
    x, y = np.full((time, len(ls)), size + 1, np.int32), np.zeros((time, len(ls)), np.int32)
    first, doc = np.zeros((time, len(ls)), bool), np.full((time, len(ls)), -1, np.int32)
    for i, ds in enumerate(ls):
        at = 0
        for d in ds:
            c = np.minimum(codes[d], size)
            y[at:at + len(c), i] = c
            x[at + 1:at + len(c), i] = c[:-1]
            first[at, i] = True
            doc[at:at + len(c), i] = d
            at += len(c)
    return x, y, first, doc


def _encoded(texts: list[bytes], codes: Codes) -> list[np.ndarray]:
    out = []
    for t in texts:
        ts = tokens(t)
        out.append(np.fromiter(map(codes.__getitem__, ts), np.int64, len(ts)))
    return out


def trainer(vocab: Vocabulary, hidden: int, start: np.ndarray | None, window: int, n_lanes: int, rate: float):
    """mapInArrow function: trains on a task's texts, yields its weights times its tokens in pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, codes, seen, step = Gru(vocab, hidden), Codes(vocab), 0, 0
        if start is not None:
            net.load(start)
        flat = net.flat()
        net.view(flat)
        m, v = np.zeros_like(flat), np.zeros_like(flat)
        for batch in batches:
            texts = raw_texts(batch.column(0))
            for a, b in shares(texts, LAID_BYTES):
                codes.trim()
                x, y, first, doc = lay_out(_encoded(texts[a:b], codes), vocab.size, n_lanes)
                live = doc >= 0
                h = np.zeros((x.shape[1], hidden), "f4")
                for t in range(0, len(x), window):
                    k = int(live[t].sum())  # the lanes that still hold text
                    w = slice(t, t + window)
                    _, g, h = net.window_grad(x[w, :k], first[w, :k], y[w, :k], live[w, :k], h[:k])
                    step, seen = step + 1, seen + int(live[w, :k].sum())
                    g = np.concatenate([g[name].ravel() for name in net.p])
                    g *= min(1.0, 1.0 / (math.sqrt(float(g @ g)) + 1e-9))
                    m += np.float32(0.1) * (g - m)
                    g *= g
                    g -= v
                    g *= np.float32(0.01)
                    v += g
                    by = np.sqrt(v * np.float32(1 / (1 - 0.99 ** step)))
                    by += np.float32(1e-6)
                    np.divide(m, by, out=by)
                    by *= np.float32(rate / (1 - 0.9 ** step))
                    flat -= by
        if seen:
            flat = net.flat().astype("f8") * seen
            for i in range(0, len(flat), 4096):
                yield pa.record_batch([pa.array([i // 4096]), pa.array([seen]), pa.array([flat[i:i + 4096].tobytes()], pa.binary())],
                                      ["piece", "n", "w"])
    return run


def _sum_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, list] = {}
    for b in batches:
        for piece, n, w in zip(*(c.to_pylist() for c in b.columns)):
            old = total.setdefault(piece, [0, 0.0])
            total[piece] = [old[0] + n, old[1] + np.frombuffer(w, "f8")]
    for piece, (n, w) in total.items():
        yield pa.record_batch([pa.array([piece]), pa.array([n]), pa.array([w.tobytes()], pa.binary())], ["piece", "n", "w"])


def train(docs: DataFrame, text_col: str, vocab: Vocabulary, hidden: int, window: int = 16, n_lanes: int = 128,
          rate: float = 0.01, rounds: int = 2) -> np.ndarray:
    """Weights after ``rounds`` rounds, each on its own share of ``docs`` (by hash), averaged over tasks by tokens."""
    flat = None
    schema = "piece long, n long, w binary"
    for i in range(rounds):
        part = docs.select(text_of(text_col).alias("x")).filter(
            F.pmod(F.xxhash64(F.lit("round"), "x"), F.lit(rounds)) == i)
        fit = trainer(vocab, hidden, flat, window, n_lanes, rate / (1 + i))
        got = part.mapInArrow(fit, schema).repartition("piece").mapInArrow(_sum_pieces, schema).collect()
        if got:  # as many rows as the network has pieces
            flat = np.concatenate([np.frombuffer(r.w, "f8") / r.n for r in sorted(got, key=lambda r: r.piece)])
    return Gru(vocab, hidden).flat() if flat is None else flat


def scorer(vocab: Vocabulary, hidden: int, flat: np.ndarray, window: int, n_lanes: int):
    """mapInArrow function: per text the network's log probability, counts, and its tokens beyond the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, codes = Gru(vocab, hidden).load(flat), Codes(vocab)
        hot, size = len(vocab.keys), vocab.size
        logc = np.log10(vocab.counts + ALPHA)
        for batch in batches:
            texts = raw_texts(batch.column(1))
            for a, b in shares(texts, LAID_BYTES):
                codes.trim()
                coded = _encoded(texts[a:b], codes)
                x, y, first, doc = lay_out(coded, size, n_lanes)
                total = np.zeros(b - a)
                h = np.zeros((x.shape[1], hidden), "f4")
                for t in range(0, len(x), window):
                    k = int((doc[t] >= 0).sum())
                    w = slice(t, t + window)
                    run_ = net.steps(x[w, :k], first[w, :k], h[:k])
                    h = run_[-1][5]  # carried into the next window
                    own = doc[w, :k].ravel()
                    at = np.flatnonzero(own >= 0)
                    logp = net.outputs(np.concatenate([s[5] for s in run_])[at], y[w, :k].ravel()[at])
                    total += np.bincount(own[at], logp, b - a)
                base, tail, n_tail, known, rare, times = [], [], [], [], [], []
                for c in coded:
                    far = c[c >= size]
                    hit = c[c < hot]
                    lc = logc[hit]
                    base.append(lc.sum()), tail.append(lc[hit >= size].sum()), n_tail.append(len(far)), known.append(len(hit))
                    u, k = np.unique(c[c >= hot], return_counts=True)
                    rare.append([codes.rare[i - hot] for i in u.tolist()]), times.append(k)
                yield pa.record_batch([
                    batch.column(0).slice(a, b - a), pa.array(total / math.log(10)), pa.array([len(c) for c in coded], pa.int64()),
                    pa.array(base, pa.float64()), pa.array(tail, pa.float64()), pa.array(n_tail, pa.int64()), pa.array(known, pa.int64()),
                    pa.array(rare, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64()))],
                    ["id", "net", "n", "base", "tail", "n_tail", "known", "rare", "times"])
    return run


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, train_share: int = 1,
                vocabulary: int = 1000, classes: int = 32, hidden: int = 24, window: int = 16, n_lanes: int = 256) -> DataFrame:
    """One row per row of ``docs``: id_col, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from rows whose crc32(identifier as text) mod ``folds`` is not 0. All
    of their tokens are counted, and the network is trained on the whole texts of
    all of them, each once; a ``train_share`` above 1 keeps one in so many of
    them for the network, drawn by hash. base_score is the add-0.1 unigram log10 probability,
    score the model's; both cover every token of every text and its end.

    Null counts as the empty text, which is its end alone. Repeated rows are
    scored each, and alike. Without any training row the counts are 0 and the
    network untrained. An empty table gives an empty result; further columns are
    not read. Tokens are told apart by 64-bit hashes.

    Tokens of a share of 2^-20 or more (at most 2^20 tokens) are looked up inside
    tasks; only the rarer ones are shuffled to meet their counts, so no token is
    a hot key.
    """
    held = remainder(id_col, folds) == 0
    train_docs = docs.filter(~held)
    counts = stage(token_counts(train_docs, text_col), "token-counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    hot = counts.filter(F.col("c") >= max(1, -(-n // HOT_SHARE))).toPandas()  # at most 2^20 rows
    if not len(hot):
        hot = counts.sparkSession.createDataFrame([(key(END), 0)], "h long, c long").toPandas()
    vocab = Vocabulary(hot["h"].to_numpy(), hot["c"].to_numpy(), vocabulary, classes)
    learnt = train_docs if train_share == 1 else train_docs.filter(
        F.pmod(F.xxhash64(F.lit("train"), F.col(id_col).cast("string"), text_of(text_col)), F.lit(train_share)) == 0)
    flat = train(learnt, text_col, vocab, hidden, window, min(n_lanes, 128))
    head = vocab.counts[:vocab.size]
    n_tail, v_tail = int(n - head.sum()), max(0, int(v - vocab.size))

    plain = docs.select(F.struct(F.col(id_col).alias("id"), held.alias("held_out")).alias("id"), text_of(text_col).alias("x"))
    made = plain.mapInArrow(scorer(vocab, hidden, flat, 4 * window, n_lanes), (
        f"id struct<id: {docs.schema[id_col].dataType.simpleString()}, held_out: boolean>, net double, n long, base double, "
        "tail double, n_tail long, known long, rare array<long>, times array<long>"))
    made = stage(made.withColumn("row", F.monotonically_increasing_id()), "lm-texts")
    rare = made.select("row", F.explode(F.arrays_zip("rare", "times")).alias("z")).select(
        "row", F.col("z.rare").alias("h"), F.col("z.times").alias("k"))
    cold = counts.filter(F.col("c") < max(1, -(-n // HOT_SHARE)))
    more = (rare.join(cold, "h", "left").withColumn("c", F.coalesce("c", F.lit(0)))
            .groupBy("row").agg(F.sum(F.col("k") * F.log10(F.col("c") + ALPHA)).alias("more"),
                                F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("more_known")))
    out = made.drop("rare", "times").join(more, "row", "left").withColumns(
        {"more": F.coalesce("more", F.lit(0.0)), "more_known": F.coalesce("more_known", F.lit(0))})
    norm, tail_norm = (math.log10(a + ALPHA * (b + 1)) for a, b in ((n, v), (n_tail, v_tail)))
    return out.select(
        F.col("id.id").alias(id_col), "id.held_out", F.col("n").alias("n_tokens"),
        (F.col("known") + F.col("more_known")).alias("n_known"), F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("more") - F.col("n") * F.lit(norm)).alias("base_score"),
        (F.col("net") + F.col("tail") + F.col("more") - F.col("n_tail") * F.lit(tail_norm)).alias("score"))
