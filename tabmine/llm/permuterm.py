"""Spelling variants by permuterm rotations.

A word with a mark at its end is turned in all ways. The words that differ from
``ab`` by one code point put between a and b, and those that have another one there, are
the rotations of the form b, mark, a, one code point more: one range of the
sorted rotations, read with the edited code point left out. A range holds one word
for each code point at most, so its size is bounded by the alphabet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabmine.llm.common import stage

MARK = "\x00"


def rotations(word: Column) -> Column:
    """Array of (prefix, whole, first): the rotations of a marked word, whole, and less their last code point.

    ``first`` says that the code point left out does not repeat the one before it: of a run of
    equal ones, whose removal gives the same word each time, it is the first.
    """
    n = F.char_length(word)

    def turned(i, skip):  # i code points go behind the mark; skip: the next one is left out
        return F.concat(F.substring(word, i + 1 + skip, n), F.lit(MARK), F.substring(word, F.lit(1), i))
    whole = F.transform(F.sequence(F.lit(0), n), lambda i: F.struct(
        turned(i, 0).alias("prefix"), F.lit(True).alias("whole"), F.lit(False).alias("first")))
    less = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
        turned(i, 1).alias("prefix"), F.lit(False).alias("whole"),
        ((i == 0) | (F.substring(word, i, F.lit(1)) != F.substring(word, i + 1, F.lit(1)))).alias("first")))
    return F.concat(whole, less)


def neighbours(words: DataFrame) -> DataFrame:
    """``words`` (word, n; words distinct and not empty) plus n_near and near: (n, word) of the best near word.

    One shuffle brings the rotations of a prefix together, sorted; a scan of each range
    counts and knows its two best words, so that no pairs are made. Neighbours are added up by word.
    """
    turned = words.select("word", "n", F.inline(rotations(F.col("word"))))
    by_prefix = Window.partitionBy("prefix")
    best = by_prefix.orderBy(F.col("n").desc(), "word").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    one = F.struct((-F.col("n")).alias("less"), "word")
    seen = turned.select(
        "word", "n", "prefix", "whole", "first", F.count("*").over(best).alias("size"),
        F.count_if("whole").over(best).alias("wholes"), F.count_if("first").over(best).alias("firsts"),
        F.first(one).over(best).alias("top"), F.nth_value(one, 2).over(best).alias("next"))
    # a word with no company is still needed once, for its row in the result
    seen = seen.filter((F.col("size") > 1) | (F.col("whole") & F.startswith("prefix", F.col("word"))))
    near = F.when(F.col("whole"), F.col("firsts")).otherwise(
        F.col("size") - F.col("wholes") - 1 + F.when(F.col("first"), F.col("wholes")).otherwise(0))
    other = F.when(F.col("top.word") == F.col("word"), F.col("next")).otherwise(F.col("top"))
    out = seen.groupBy("word", "n").agg(F.sum(near).alias("n_near"), F.min(other).alias("near"))
    return out.select("word", "n", "n_near", F.when(F.col("near").isNotNull(), F.struct(
        (-F.col("near.less")).alias("n"), F.col("near.word").alias("word"))).alias("near"))


def follow(links: DataFrame) -> DataFrame:
    """(word, root) for ``links`` (word, form) without circles: each word's last form, by pointer doubling."""
    at = stage(links.select("word", F.col("form").alias("root")), "forms")
    while True:
        # most words share few forms; Spark splits the left side of such keys
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stage(at.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        at = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return at


def group_variants(words: DataFrame, times: int = 5) -> DataFrame:
    """``words`` (word, n) as word, form, root, n, n_near, form_n: spelling variants led to their frequent form.

    Two words are near if one code point inserted, deleted or replaced makes one the
    other. A word's form is its near word of largest n (of equals the smallest in code-point
    order), if that is at least ``times`` its own n, else null; root is the last of the
    forms' forms, the word itself if it has none. Rows of one word are added up; null and empty words
    are left out; further columns are not read; an empty table gives an empty result.
    ``times`` is above 1, so that forms make no circle, and a chain's length is at most the logarithm of n.
    Words hold no U+0000.
    """
    if times <= 1:
        raise ValueError("times must be above 1")
    words = words.filter(F.col("word") != "").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    seen = stage(neighbours(words), "variants")
    fits = F.col("near.n") >= F.lit(times) * F.col("n")
    seen = seen.select("word", "n", "n_near", F.when(fits, F.col("near.word")).alias("form"), F.when(fits, F.col("near.n")).alias("form_n"))
    roots = follow(seen.filter(F.col("form").isNotNull()))
    return seen.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce(F.col("n_near"), F.lit(0)).cast("long").alias("n_near"), "form_n")
