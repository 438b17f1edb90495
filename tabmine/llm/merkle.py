"""Merkle manifest of a dataset: a content-addressed DAG, and proofs by descent from its root.

Rows become leaves; the leaves of one tree (a source), in order, are hashed in
runs of ``FAN`` until one digest is left, and the trees' digests likewise give
the root. What is stored are records digest -> children, ``HEIGHT`` levels of
them under one digest, so that the build and the descent take one shuffle for
each ``FAN ** HEIGHT``-fold of the rows. Proofs come from the records alone: requests
start at the root, go down by the digits of their ranks, collect the children
they pass by, and reverse what they have collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabmine.llm.common import small, stage

FAN = 3
HEIGHT = 6
STEP = "struct<at: int, others: array<string>>"


def digest(c: Column) -> Column:
    """Lowercase hex sha256 of a string."""
    return F.sha2(c, 256)


def leaf_of(*fields: Column) -> Column:
    """Digest of a row: each field as ``-`` if null, else its UTF-8 byte count, ``:`` and its value."""
    said = [f.cast("string") for f in fields]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in said]))


def tree_key(c: Column) -> Column:
    """A tree's name without nulls; the null tree is the first in byte order."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))


def ranked(rows: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """``rows`` plus rank (place in the tree by ``order``, from 0) and n (rows of the tree).

    Rows are dealt by range and sorted where they land, whichever tree they are of, so a
    tree that holds most rows is spread like any other; only the counts of (partition,
    tree) are added up. Rows equal in ``order`` take any order among themselves.
    """
    rows = rows.withColumn("__tie", F.monotonically_increasing_id())
    keys = [tree, *order, "__tie"]
    rows = stage(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                 .withColumn("__at", F.monotonically_increasing_id()), f"{name}-sorted")
    rows = rows.withColumn("__part", F.shiftright("__at", 33))
    counts = rows.groupBy(tree, "__part").agg(F.count("*").alias("c"), F.min("__at").alias("first"))
    whole = Window.partitionBy(tree)
    offsets = counts.select(tree, "__part", F.sum("c").over(whole).alias("n"),
                            (F.sum("c").over(whole.orderBy("__part")) - F.col("c") - F.col("first")).alias("shift"))
    offsets = stage(offsets, f"{name}-offsets")
    return (rows.join(small(offsets, 128), [tree, "__part"])
            .withColumn("rank", F.col("__at") + F.col("shift")).drop("__at", "__part", "__tie", "shift"))


def above(level: Column) -> Column:
    """The digests over a level of digests."""
    runs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / FAN).cast("int"))
    return F.transform(runs, lambda i: digest(F.array_join(F.slice(level, i * FAN + 1, FAN), "")))


def levels_of(bottom: Column, lone: Column, height: int) -> Column:
    """Levels over ``bottom``, itself first: ``height`` more, or where the block is all of its tree (``lone``), as
    many as lead to one digest."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(height)), F.array(bottom), lambda done, _: F.when(
        lone & (F.size(F.element_at(done, -1)) == 1), done).otherwise(
        F.concat(done, F.array(above(F.element_at(done, -1))))))


@dataclass
class Dag:
    """``rounds[i]``: rows (tree, block, n, digest, levels, asks) over the nodes of round i - 1, over leaves at 0.

    ``levels`` holds all nodes under ``digest`` down to the bottom of its block, children
    of a node in a run of FAN; ``asks`` (round 0) what was given with each leaf; ``n`` is
    the number of nodes that the tree has at the block's bottom.
    """
    rounds: list[DataFrame]
    height: int

    @property
    def width(self) -> int:
        return FAN ** self.height

    def tops(self, i: int) -> DataFrame:
        """(tree, digest) of the trees that end in round i."""
        return self.rounds[i].filter(F.col("n") <= self.width).select("tree", "digest")

    def roots(self) -> DataFrame:
        """(tree, digest) of all trees."""
        out = self.tops(0)
        for i in range(1, len(self.rounds)):
            out = out.union(self.tops(i))
        return out

    def records(self) -> DataFrame:
        """The store as single records: digest, children. Equal nodes are one record."""
        out = None
        for r in self.rounds:
            k = F.explode(F.sequence(F.lit(1), F.size("levels") - 1))
            r = r.filter(F.size("levels") > 1).select("levels", k.alias("k"))
            r = r.select(F.get("levels", F.col("k") - 1).alias("low"), F.posexplode(F.get("levels", F.col("k"))).alias("i", "digest"))
            r = r.select("digest", F.slice("low", F.col("i") * FAN + 1, FAN).alias("children"))
            out = r if out is None else out.union(r)
        return out.dropDuplicates(["digest"])


def build(leaves: DataFrame, name: str, height: int = HEIGHT) -> Dag:
    """The DAG over ``leaves`` (tree, rank, n, digest, ask): one shuffle and one written table a round.

    A group is a block of FAN ** height neighbours, however large its tree. The number of
    rounds is the logarithm of the largest tree's size, and all that the driver learns.
    """
    width = FAN ** height
    rounds, nodes = [], leaves
    while True:
        # neighbours are still together, so what is collected map-side is mostly whole blocks
        blocks = nodes.groupBy("tree", F.floor(F.col("rank") / width).cast("long").alias("block")).agg(
            F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("rank", "digest", "ask"))).alias("kids"))
        blocks = blocks.withColumn("levels", levels_of(F.col("kids.digest"), F.col("n") <= width, height))
        blocks = stage(blocks.select("tree", "block", "n", F.element_at(F.element_at("levels", -1), 1).alias("digest"),
                                     "levels", F.col("kids.ask").alias("asks")), f"{name}-round")
        rounds.append(blocks)
        more = blocks.filter(F.col("n") > width)
        if more.isEmpty():
            return Dag(rounds, height)
        nodes = more.select("tree", F.col("block").alias("rank"), F.ceil(F.col("n") / width).cast("long").alias("n"),
                            "digest", F.lit(None).cast("string").alias("ask"))


def _passed(levels: Column, j: Column) -> Column:
    """From a block's top down to its j-th bottom node: the digit taken and the children passed by, at each level."""
    def step(k):
        i = F.floor(j / F.pow(F.lit(FAN), k)).cast("int")
        at = F.pmod(i, F.lit(FAN))
        run = F.slice(F.get(levels, k), i - at + 1, FAN)
        others = F.concat(F.slice(run, F.lit(1), at), F.slice(run, at + 2, F.lit(FAN)))
        return F.struct(at.alias("at"), others.alias("others"))
    none = F.array().cast(f"array<{STEP}>")
    return F.when(F.size(levels) < 2, none).otherwise(
        F.transform(F.sequence(F.size(levels) - 2, F.lit(0), F.lit(-1)), step))


def descend(dag: Dag, start: DataFrame) -> DataFrame:
    """(tree, subroot, ask, digest, path) of every leaf, from ``start``: (tree, digest, path so far).

    The frontier of each round is joined to the records by digest alone; equal digests have
    equal records. ``path`` ends at the leaf, top first.
    """
    start = start.withColumn("subroot", F.col("digest"))
    frontier = None
    for i in reversed(range(len(dag.rounds))):
        here = (start.join(dag.tops(i).select("tree"), "tree")
                .withColumn("block", F.lit(0).cast("long"))) if len(dag.rounds) > 1 else start.withColumn("block", F.lit(0).cast("long"))
        here = here.select("tree", "subroot", "block", "digest", "path")
        frontier = here if frontier is None else frontier.union(here)
        records = dag.rounds[i].select("digest", "levels").dropDuplicates(["digest"])
        at = frontier.join(records, "digest")
        if i == 0:
            at = at.join(dag.rounds[0].select("tree", "block", "asks"), ["tree", "block"])
        else:
            at = at.withColumn("asks", F.lit(None).cast("array<string>"))
        kids = at.select("tree", "subroot", "block", "path", "levels", "asks", F.posexplode(F.get("levels", F.lit(0))).alias("j", "kid"))
        frontier = kids.select(
            "tree", "subroot", (F.col("block") * dag.width + F.col("j")).alias("block"), F.col("kid").alias("digest"),
            F.concat("path", _passed(F.col("levels"), F.col("j"))).alias("path"), F.get("asks", F.col("j")).alias("ask"))
        if i:
            frontier = frontier.drop("ask")
    return frontier.drop("block")


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` leads to along ``path`` (leaf first)."""
    return F.aggregate(path, leaf, lambda d, p: digest(F.concat(
        F.array_join(F.slice(p["others"], F.lit(1), p["at"]), ""), d,
        F.array_join(F.slice(p["others"], p["at"] + 1, F.lit(FAN)), ""))))


@dataclass
class Manifest:
    """A dataset's DAG: trees over leaves, and the tree over their digests."""
    trees: Dag
    top: Dag

    def root(self) -> DataFrame:
        """One row (root); none for a table without rows."""
        return self.top.roots().select(F.col("digest").alias("root"))

    def records(self) -> DataFrame:
        """All records digest -> children."""
        return self.trees.records().union(self.top.records()).dropDuplicates(["digest"])

    def proofs(self) -> DataFrame:
        """(tree, ask, leaf, subroot, root, path) of every row: ``path`` from the leaf to the root, each step the
        place among its run and the run's other digests."""
        none = F.array().cast(f"array<{STEP}>").alias("path")
        first = self.top.roots().select("tree", "digest", none)
        under = descend(self.top, first).select(F.col("ask.tree").alias("tree"), "digest", "path", F.col("subroot").alias("root"))
        under = stage(under, "merkle-subroots")
        found = descend(self.trees, under.select("tree", "digest", "path"))
        found = found.join(small(under.select("tree", "root"), 256), "tree")
        return found.select("tree", "ask", F.col("digest").alias("leaf"), "subroot", "root", F.reverse("path").alias("path"))


def manifest(rows: DataFrame, tree: Column, order: Column, leaf: Column, keep: dict[str, Column] | None = None,
             height: int = HEIGHT) -> Manifest:
    """The manifest of ``rows``: a tree for each value of ``tree``, its leaves ascending by ``order``.

    ``keep`` names what proofs carry of each row in their column ``ask``. A null tree is a
    tree of its own, before the others; trees go in byte order. Null orders come first; rows
    of equal order go by their leaf, equal rows are leaves each. Null or empty values
    count as ``leaf`` says. A tree of one row has its leaf as digest, a table without rows no root and no
    proofs. Columns other than those given are not read, whatever their names. Texts
    are hashed in the scan; digests alone are shuffled.
    """
    kept = F.struct(*[c.alias(k) for k, c in (keep or {"order": order}).items()])
    leaves = stage(rows.select(tree_key(tree).alias("tree"), order.alias("order"), leaf.alias("digest"), kept.alias("ask")),
                   "merkle-leaves")
    trees = build(ranked(leaves, "tree", ["order", "digest"], "merkle").select("tree", "rank", "n", "digest", "ask"),
                  "merkle", height)
    heads = trees.roots().select(F.lit("").alias("all"), "tree", "digest")
    heads = ranked(heads, "all", ["tree"], "merkle-heads").select(
        F.col("all").alias("tree"), "rank", "n", "digest", F.struct("tree").alias("ask"))
    return Manifest(trees, build(heads, "merkle-top", height))
