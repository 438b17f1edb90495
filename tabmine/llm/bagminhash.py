"""Near-duplicate detection by BagMinHash signatures of word-shingle multisets.

A document is the multiset of its five-word shingles. Weights are discretised
at the whole numbers and grouped into dyadic ranges [0,1), [1,2), [2,4), ...;
each (shingle, range) runs a Poisson process of its own, whose points fall on
signature places and on a weight level drawn within the range; points below the shingle's count are in. A signature keeps the first
point per place, so two documents agree at a place with probability equal to
their weighted Jaccard similarity. Processes stop once they are later than all
places, which makes a signature cost about one point per shingle.

Signatures are cut into bands; documents sharing a band are candidates, and the
multisets of candidates are compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabmine.llm.arrow_text import STEP, Hashes, mixed, nth, raw_texts, shares, words
from tabmine.llm.common import digest128, small, stage, text_of


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` word hashes; fewer words, but not none, make one shingle."""
    if not len(hashes):
        return hashes
    if len(hashes) < size:
        hashes = np.concatenate([hashes, np.zeros(size - len(hashes), np.uint64)])
    n = len(hashes) - size + 1
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = mixed(out * np.uint64(31) + hashes[i:i + n] + np.uint64(i + 1))
    return out


def signatures(items: np.ndarray, counts: np.ndarray, doc: np.ndarray, n_docs: int, places: int) -> np.ndarray:
    """(n_docs, places) times of the first points; ``doc`` is sorted, infinite where a document has no items."""
    low, length, item, count, owner = [], [], [], [], []
    r = 0
    while len(items):  # the ranges that begin below the count
        a, ln = (0, 1) if r == 0 else (1 << (r - 1), 1 << (r - 1))
        keep = counts > a
        items, counts, doc = items[keep], counts[keep], doc[keep]
        low.append(np.full(len(items), a)), length.append(np.full(len(items), ln))
        item.append(mixed(items + nth(r + 1))), count.append(counts), owner.append(doc)
        r += 1
    sig = np.full((n_docs, places), np.inf)
    if not item:
        return sig
    low, length, item, count, owner = map(np.concatenate, (low, length, item, count, owner))
    time, flat, n = np.zeros(len(item)), sig.reshape(-1), 0
    while len(item):
        n += 1
        x = mixed(item + nth(n))
        time = time - np.log1p(-(x >> np.uint64(11)).astype(np.float64) * 2.0 ** -53) / length
        y = mixed(x ^ np.uint64(0xD6E8FEB86659FD93))
        level = low + (((y >> np.uint64(40)) * length.astype(np.uint64)) >> np.uint64(24)).astype(np.int64)
        at = owner * places + (y & np.uint64(0xFFFFFFFF)).astype(np.int64) % places
        hit = level < count
        np.minimum.at(flat, at[hit], time[hit])
        live = np.unique(owner)
        last = np.empty(n_docs)
        last[live] = sig[live].max(axis=1)
        keep = time < last[owner]
        if not keep.all():
            low, length, item, count, owner, time = (v[keep] for v in (low, length, item, count, owner, time))
    return sig


def bands_of(sig: np.ndarray, rows: int) -> np.ndarray:
    """(documents, bands) keys of ``rows`` consecutive places."""
    bits = sig.view(np.uint64).reshape(len(sig), -1, rows)
    out = np.broadcast_to(np.arange(bits.shape[1], dtype=np.uint64) + np.uint64(1), bits.shape[:2]) * STEP
    for i in range(rows):
        out = mixed(out ^ bits[:, :, i])
    return out.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch], size: int, places: int, rows: int) -> Iterator[pa.RecordBatch]:
    known = Hashes()
    for batch in batches:
        texts, ids = raw_texts(batch.column(1)), batch.column(0)
        for a, b in shares(texts):
            sets = [np.unique(shingles(known.of(words(t)), size), return_counts=True) for t in texts[a:b]]
            n = np.array([len(s) for s, _ in sets])
            keys = bands_of(signatures(np.concatenate([s for s, _ in sets]), np.concatenate([c for _, c in sets]),
                                       np.repeat(np.arange(b - a), n), b - a, places), rows)
            total = np.array([c.sum() for _, c in sets])
            keys = [k if m else [] for k, m in zip(keys, total)]
            yield pa.record_batch([ids.slice(a, b - a), pa.array(total, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                                  ["t", "n", "bands"])


def _bags(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    known = Hashes()
    for batch in batches:
        texts = raw_texts(batch.column(1))
        for a, b in shares(texts):
            bags = [np.sort(shingles(known.of(words(t)), size)).tobytes() for t in texts[a:b]]
            yield pa.record_batch([batch.column(0).slice(a, b - a), pa.array(bags, pa.binary())], ["t", "bag"])


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted multisets."""
    (ua, ca), (ub, cb) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    both, i, j = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    shared = np.minimum(ca[i], cb[j]).sum() if len(both) else 0
    return float(shared / max(1, len(a) + len(b) - shared))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sim = [jaccard(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
               for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(sim, pa.float64())], ["a", "b", "sim"])


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(t, c): the least node of each node's connected component.

    Every round each node takes the least label among its neighbours and then
    that label's own label; a star is done in one round, a chain in the
    logarithm of its length or so.
    """
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "links")
    label = stage(nodes.select("t", F.col("t").alias("c")), "labels")
    if both.isEmpty():
        return label
    while True:
        near = both.join(label, both.b == label.t).groupBy("a").agg(F.min("c").alias("near"))
        took = label.join(near.withColumnRenamed("a", "t"), "t", "left").select(
            "t", "c", F.least("c", F.coalesce("near", "c")).alias("d"))
        took = stage(took, "labels-near")
        jump = took.select(F.col("t").alias("d"), F.col("d").alias("e"))
        new = stage(took.join(jump, "d").select("t", F.col("e").alias("c"), (F.col("c") != F.col("e")).alias("moved")),
                    "labels")
        label = new.select("t", "c")
        if new.filter("moved").isEmpty():
            return label


def merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label`` after further links: the components of the graph whose nodes are the labels so far."""
    name = label.select(F.col("t").alias("a"), F.col("c").alias("ca"))
    ends = (links.join(name, "a").join(name.withColumnsRenamed({"a": "b", "ca": "cb"}), "b")
            .filter("ca != cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
    ends = stage(ends, "component-links")
    if ends.isEmpty():
        return label
    nodes = ends.select(F.col("a").alias("t")).union(ends.select("b")).distinct()
    new = components(nodes, ends).select(F.col("t").alias("c"), F.col("c").alias("d"))
    return stage(label.join(new, "c", "left").select("t", F.coalesce("d", "c").alias("c")), "labels-merged")


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per element of each bag; the i-th copy of a shingle is an element of its own."""
    for batch in batches:
        for u, bag in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            bag = np.frombuffer(bag, np.uint64)
            if len(bag):
                new = np.concatenate([[True], bag[1:] != bag[:-1]])
                start = np.flatnonzero(new)
                copy = np.arange(len(bag)) - np.repeat(start, np.diff(np.append(start, len(bag))))
                tok = mixed(bag + copy.astype(np.uint64) * STEP).view(np.int64)
                yield pa.record_batch([pa.array(np.full(len(bag), u, np.int64)), pa.array(tok)], ["u", "tok"])


def _prefix_pairs(bags: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Every pair (a, b) of texts in different components that can still be linked.

    ``bags`` has (u, bag), ``texts`` (u, t, n, c). Elements are ordered by how rare
    they are. The first element that two multisets of similarity ``threshold`` share
    lies in the first n - ceil(threshold n) + 1 of the longer one and in the first
    n - ceil(2 threshold / (1 + threshold) n) + 1 of the shorter one, and its places
    bound what they can share in all; so texts that all share one passage, but too
    little to be linked, do not meet. Elements of one text alone come first and are
    only counted; a text whose prefix they fill meets nobody.
    """
    tok = stage(bags.mapInArrow(_tokens, "u long, tok long"), "elements")
    often = tok.groupBy("tok").agg(F.count("*").alias("df")).filter("df > 1")
    text = Window.partitionBy("u")
    ranked = (tok.join(often, "tok").select("u", "tok", F.row_number().over(text.orderBy("df", "tok")).alias("r"),
                                            F.count("*").over(text).alias("s"))
              .join(texts, "u").withColumn("at", F.col("n") - F.col("s") + F.col("r")))

    def prefix(share: float):
        return F.col("at") <= F.col("n") - F.ceil(F.col("n") * share - 1e-6) + 1

    ranked = ranked.filter(prefix(threshold)).select(
        "tok", "t", "n", "at", "c", prefix(2 * threshold / (1 + threshold)).alias("short"))
    ranked = stage(ranked, "prefixes")
    mixed_ = ranked.groupBy("tok").agg(F.min("c").alias("c1"), F.max("c").alias("c2")).filter("c1 != c2").select("tok")
    x = ranked.join(mixed_, "tok")
    y = x.filter("short").select("tok", *[F.col(v).alias(f"{v}2") for v in ("t", "n", "at", "c")])
    share = F.least(F.col("n") - F.col("at"), F.col("n2") - F.col("at2")) + 1
    shorter = (F.col("n2") < F.col("n")) | ((F.col("n2") == F.col("n")) & (F.col("t2") < F.col("t")))
    return (x.drop("short").join(y, "tok").filter(shorter & (F.col("c") != F.col("c2")))
            .filter(share >= (F.col("n") + F.col("n2")) * (threshold / (1 + threshold)) - 1e-6)
            .select(F.col("t").alias("a"), F.col("t2").alias("b")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8,
                    shingle: int = 5, places: int = 128, band_rows: int = 4) -> DataFrame:
    """Rows of ``docs`` plus class_id, class_size (long), kept (boolean) and n_copies (long).

    Texts of weighted Jaccard similarity ``threshold`` or more over their
    ``shingle``-word multisets are linked; classes are the connected groups of
    linked or equal texts. class_id is the least identifier in the class (null
    if all are null), n_copies the rows with the very same text. Of each class
    one row is kept: that of class_id (of several with that identifier the least
    text; of repeated rows one). Null counts as the empty text; texts without
    words are linked to equal texts only; an empty table gives an empty result;
    input columns named like a result column are replaced.

    At 128 places in bands of 4 a link of similarity 0.8 is missed with
    probability 5e-8. No bucket emits all its pairs. Each bucket compares its
    members with one of them, drawn anew in every eighth of the bands, then,
    where several components are left, with the member that has the most links.
    Texts of buckets still not in one component are joined on the rarest
    elements of their multisets, which loses no link. Equal texts count as one
    text throughout; buckets and elements name texts by 64 bits, all else by 128.
    """
    own = ["class_id", "class_size", "kept", "n_copies"]
    rows = docs.drop(*own).withColumn("__t", digest128(text_of(text_col)))
    sign_schema = "t binary, n long, bands array<long>"
    signed = docs.select(digest128(text_of(text_col)).alias("t"), text_of(text_col).alias("x")).mapInArrow(
        lambda bs: _sign(bs, shingle, places, band_rows), sign_schema)
    signed = stage(signed.dropDuplicates(["t"]), "signed")
    text = signed.select(F.xxhash64("t").alias("u"), "t", "n")
    spread = signed.select(F.xxhash64("t").alias("u"), F.explode("bands").alias("k"))
    turn = F.xxhash64(F.pmod("k", F.lit(8)))
    crowded = spread.groupBy("k").agg(F.min(F.col("u").bitwiseXOR(turn)).alias("d"), F.count("*").alias("m")).filter("m > 1")
    member = stage(spread.join(crowded.select("k", F.col("d").bitwiseXOR(turn).alias("lead")), "k"), "bucket-members")

    fits = lambda x, y: F.least(x, y) >= threshold * F.greatest(x, y)  # noqa: E731  a bound on the similarity
    wanted = stage(member.select("u").distinct().join(text, "u"), "bag-keys")
    first = (member.filter("u != lead").select("lead", "u").distinct().join(wanted, "u")
             .join(wanted.select(F.col("u").alias("lead"), F.col("t").alias("a"), F.col("n").alias("lead_n")), "lead")
             .filter(fits(F.col("n"), F.col("lead_n"))).select("a", F.col("t").alias("b")))
    # the names go to the texts: texts are shuffled only beyond 4 million names (another text of the same name does no harm)
    bags = (docs.select(digest128(text_of(text_col)).alias("t"), text_of(text_col).alias("x")).withColumn("u", F.xxhash64("t"))
            .join(small(wanted.select("u"), 8), "u", "left_semi").select("t", "x").mapInArrow(lambda bs: _bags(bs, shingle), "t binary, bag binary"))
    bags = stage(bags.dropDuplicates(["t"]), "bags")

    def compared(pairs: DataFrame, name: str) -> DataFrame:
        p = (pairs.join(bags.select(F.col("t").alias("a"), F.col("bag").alias("x")), "a")
             .join(bags.select(F.col("t").alias("b"), F.col("bag").alias("y")), "b").select("a", "b", "x", "y"))
        return stage(p.mapInArrow(_compare, "a binary, b binary, sim double"), name)

    links = compared(first, "links-1")
    label = components(wanted, links.filter(F.col("sim") >= threshold))
    # buckets that still hold several components
    named = stage(wanted.join(label, "t"), "labelled")
    short = named.select("u", F.xxhash64("c").alias("c"))
    open_ = (member.select("k", "u").join(short, "u").groupBy("k").agg(F.min("c").alias("c1"), F.max("c").alias("c2"))
             .filter("c1 != c2").select("k"))
    left = stage(member.select("k", "u").join(open_, "k").join(named, "u"), "open-buckets")
    if not left.isEmpty():
        good = links.filter(F.col("sim") >= threshold)
        degree = good.select(F.col("a").alias("t")).union(good.select("b")).groupBy("t").agg(F.count("*").alias("deg"))
        lead = (left.join(degree, "t", "left").groupBy("k")
                .agg(F.max(F.struct(F.coalesce("deg", F.lit(0)).alias("deg"), "t", "c", "n")).alias("x"))
                .select("k", F.col("x.t").alias("a"), F.col("x.c").alias("ca"), F.col("x.n").alias("na")))
        second = left.join(lead, "k").filter(F.col("c") != F.col("ca")).filter(fits(F.col("n"), F.col("na"))).select(
            "a", F.col("t").alias("b")).distinct()
        second = second.join(links.select("a", "b"), ["a", "b"], "left_anti").join(
            links.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti")
        links2 = compared(second, "links-2")
        links = links.union(links2)
        label = merged(label, links2.filter(F.col("sim") >= threshold))
        some = left.select("t").distinct()
        rest = _prefix_pairs(bags.join(some, "t", "left_semi").select(F.xxhash64("t").alias("u"), "bag"),
                             wanted.join(some, "t", "left_semi").join(label, "t"), threshold)
        rest = rest.join(links.select("a", "b"), ["a", "b"], "left_anti").join(
            links.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti")
        label = merged(label, compared(rest, "links-3").filter(F.col("sim") >= threshold))

    narrow = rows.select(F.col("__t"), F.col(id_col).alias("id"))
    texts = narrow.groupBy("__t").agg(F.count("*").alias("n_copies"),
                                      F.min(F.struct(F.col("id").isNull().alias("none"), "id", "__t")).alias("best"))
    texts = stage(texts.join(label.select(F.col("t").alias("__t"), F.col("c").alias("__c")), "__t", "left")
                  .withColumn("__c", F.coalesce("__c", "__t")), "texts")
    classes = texts.groupBy("__c").agg(F.sum("n_copies").alias("class_size"), F.min("best").alias("best"))
    texts = stage(texts.select("__t", "__c", "n_copies").join(classes, "__c").select(
        "__t", "n_copies", "class_size", F.col("best.id").alias("class_id"), (F.col("best.__t") == F.col("__t")).alias("__own")),
        "classes")
    # repeated rows: how many carry the kept identifier and text
    again = (narrow.join(texts.filter("__own"), "__t").filter(F.col("id").eqNullSafe(F.col("class_id")))
             .groupBy("__t").agg(F.count("*").alias("__same")))
    texts = stage(texts.join(again, "__t", "left"), "class-table")
    out = rows.join(texts, "__t").withColumn(
        "kept", F.col("__own") & F.col(id_col).eqNullSafe(F.col("class_id")))
    single = out.filter(~(F.col("kept") & (F.col("__same") > 1)))
    if texts.filter("__same > 1").isEmpty():
        return single.drop("__t", "__own", "__same")
    several = out.filter(F.col("kept") & (F.col("__same") > 1)).select(
        "*", F.row_number().over(Window.partitionBy("__t").orderBy("__t")).alias("__i")).withColumn("kept", F.col("__i") == 1).drop("__i")
    return single.union(several).drop("__t", "__own", "__same")
