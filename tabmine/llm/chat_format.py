r"""Chat formatting of reply trees.

Messages form trees by parent links. Self-joins by pointer doubling give every
message its ancestor 2^k levels up and the score of the way there, so a tree d
levels deep takes log2(d) joins, not d. Branches (root-to-leaf paths) are
ranked by score; the chosen ones are unrolled with the same doubled pointers
and formatted as one conversation each.

A turn reads ``<|im_start|>role\ntext<|im_end|>\n``. Inside texts and roles each
``<`` that is followed by pipes gets one pipe more, so no control string can
appear there; taking one pipe away restores the text. Roles also write a
backslash as ``\s`` and a line break as ``\n``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabmine.llm.common import stage, text_of

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\|+)", r"<|$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\|(\|+)", "<$1")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


def parse_turns(formatted: Column) -> Column:
    """The formatted conversation as array<struct<role, text>>, unescaped."""
    turns = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 1 << 30)
    return F.transform(turns, lambda t: F.struct(
        unescape_role(F.substring_index(t, "\n", 1)).alias("role"),
        unescape(F.substring(t, F.locate("\n", t) + 1, F.char_length(t) - F.locate("\n", t) - len(END))).alias("text")))


def masked_text(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped and joined with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def _doubled(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Pointer tables (t, n, up) by level, and (t, n, depth, total) of the nodes that reach a root.

    ``up`` is the ancestor 2^level above; a node is in the levels it has one in.
    Level k + 1 is a self-join of level k, of those nodes alone, so the joins
    make as many rows as there are pointers.
    """
    ids = nodes.select("t", F.col("n").alias("up"), F.lit(True).alias("there"))
    jump = stage(nodes.select("t", "n", F.col("p").alias("up"), F.col("s").alias("total"))
                 .join(ids, ["t", "up"], "left")
                 .select("t", "n", F.when(F.col("there"), F.col("up")).alias("up"), F.lit(1).cast("long").alias("depth"),
                         "total"), "tree-0")
    levels, ended, most = [], [], None
    while True:
        going = jump.filter("up IS NOT NULL")
        ended.append(jump.filter("up IS NULL"))
        if going.isEmpty():
            break
        if most is None:
            most = nodes.groupBy("t").count().agg(F.max("count")).first()[0]
        if 1 << len(levels) > most:  # what has an ancestor this far up runs in a circle
            break
        levels.append(going.select("t", "n", "up"))
        far = reduce(DataFrame.union, [going, *ended]).select(
            "t", F.col("n").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("d2"), F.col("total").alias("s2"))
        jump = stage(going.join(far, ["t", "up"], "left").select(
            "t", "n", F.col("up2").alias("up"), (F.col("depth") + F.coalesce("d2", F.lit(0))).alias("depth"),
            (F.col("total") + F.coalesce("s2", F.lit(0.0))).alias("total")), f"tree-{len(levels)}")
    return levels, reduce(DataFrame.union, ended).select("t", "n", "depth", "total")


def format_trees(messages: DataFrame, tree_col: str, node_col: str, parent_col: str, role_col: str, text_col: str,
                 score_col: str | None = None, top_k: int | None = None, trained_role: str = "assistant") -> DataFrame:
    """One row per chosen branch: tree_col, leaf, branch_rank, branch_score, n_turns, formatted, loss_spans.

    A branch's score is the sum of its messages' scores (null or no column: 0).
    Per tree the ``top_k`` best branches are kept, all of them for None (rank
    null then); ties go to the longer branch, then to the smaller leaf.
    ``loss_spans`` are array<struct<start, end>> of code points in ``formatted``
    (end exclusive), the escaped texts of ``trained_role`` in order.

    Null text or role is empty; a null tree is a tree of its own. A message
    whose parent is null or missing is a root. Of messages with the same tree
    and node the least by (parent, role, text) counts. Messages without a node
    id, and those on a circle of parents, have no root-to-leaf path and are left
    out. An empty table gives no rows; other columns are not read.

    Joins are on (tree, node), so a tree with a third of all messages spreads
    over all partitions; only a branch's own messages meet, in its one string.
    """
    score = F.coalesce(F.col(score_col).cast("double"), F.lit(0.0)) if score_col else F.lit(0.0)
    rows = messages.select(
        F.col(tree_col).alias("tree"),
        F.coalesce(F.concat(F.lit("="), F.col(tree_col).cast("string")), F.lit("")).alias("t"),
        F.col(node_col).alias("n"), F.col(parent_col).alias("p"), text_of(role_col).alias("role"),
        text_of(text_col).alias("text"), score.alias("s")).filter("n IS NOT NULL")
    least = F.min(F.struct(F.col("p"), F.col("role"), F.col("text"), F.col("s"), F.col("tree"))).alias("m")
    rows = stage(rows.groupBy("t", "n").agg(least).select(
        "t", "n", "m.p", "m.role", "m.text", "m.s", "m.tree"), "messages")
    nodes = rows.select("t", "n", "p", "s")
    levels, ways = _doubled(nodes)
    leaves = ways.join(nodes.select("t", F.col("p").alias("n")).distinct(), ["t", "n"], "left_anti")
    if top_k is None:
        chosen = leaves.withColumn("branch_rank", F.lit(None).cast("int"))
    else:
        best = Window.partitionBy("t").orderBy(F.desc("total"), F.desc("depth"), "n")
        chosen = leaves.withColumn("branch_rank", F.row_number().over(best)).filter(F.col("branch_rank") <= top_k)
    chosen = stage(chosen.withColumnRenamed("n", "leaf"), "branches")
    walk = chosen.select("t", "leaf", "depth", F.col("leaf").alias("n"), F.lit(0).cast("long").alias("off"))
    for k in range(len(levels) - 1, -1, -1):  # each node stands for 2^(k+1) ancestors; split that in two
        walk = walk.join(levels[k], ["t", "n"], "left").select("t", "leaf", "depth", F.explode(F.filter(F.array(
            F.struct("n", "off"), F.struct(F.col("up").alias("n"), (F.col("off") + (1 << k)).alias("off"))),
            lambda x: x["n"].isNotNull())).alias("x")).select("t", "leaf", "depth", "x.n", "x.off")
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    turns = (walk.join(rows.select("t", "n", "role", "text"), ["t", "n"])
             .select("t", "leaf", (F.col("depth") - F.col("off")).alias("at"), (F.col("role") == trained_role).alias("own"),
                     F.concat(head, body, F.lit(END)).alias("turn"), F.char_length(head).alias("before"),
                     F.char_length(body).alias("len")))
    order = Window.partitionBy("t", "leaf").orderBy("at")
    until = F.sum(F.char_length("turn").cast("long")).over(order)
    turns = turns.withColumn("start", until - F.char_length("turn") + F.col("before"))
    made = turns.groupBy("t", "leaf").agg(
        F.count("*").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("at", "turn", "own", "start", "len"))).alias("x"))
    made = made.select(
        "t", "leaf", "n_turns", F.array_join(F.col("x")["turn"], "").alias("formatted"),
        F.transform(F.filter("x", lambda x: x["own"]), lambda x: F.struct(
            x["start"].alias("start"), (x["start"] + x["len"]).alias("end"))).alias("loss_spans"))
    names = rows.groupBy("t").agg(F.first("tree").alias("tree"))
    return (made.join(chosen.select("t", "leaf", "branch_rank", F.col("total").alias("branch_score")), ["t", "leaf"])
            .join(names, "t")
            .select(F.col("tree").alias(tree_col), "leaf", "branch_rank", "branch_score", "n_turns", "formatted",
                    "loss_spans"))
