import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabmine.operators import draw_boot
from tabmine.operators.metrics import binary_metrics, roc_auc, score_cumulatives
from tabmine.operators.resample import replicate_weights


@pytest.mark.parametrize("cells", [64, 1 << 21])
def test_blocks_count_what_the_joined_draws_count(spark, monkeypatch, cells):
    """Nulls, repeated ids and rows, ties, a model with few rows: the areas of a row for each draw, bit for bit."""
    monkeypatch.setattr(draw_boot, "CELLS", cells)
    r = random.Random(5)
    rows = [(m, r.choice([i, i, i, 7, None]), r.choice([0, 1, 1, None]), r.choice([0.5, None, round(r.random(), 2)]))
            for i in range(150) for m in ("a", "b", None)] + [("few", 3, 1, 0.9)] + [("b", 7, 1, 0.5)] * 300
    df = spark.createDataFrame(rows, "model string, row_id long, y int, p double")
    g = ["rep", "model"]
    rw = replicate_weights(df, 20, 42)
    old = roc_auc(rw, g, ndigits=None, cum=score_cumulatives(rw, g, weight="w")).join(
        binary_metrics(rw, g, ndigits=None, weight="w").select(*g, "f1"), g)
    want = {(x["model"], x["rep"]): (x["roc_auc"], x["f1"]) for x in old.collect()}
    got = {(x["model"], x["rep"]): (x["roc_auc"], x["f1"]) for x in draw_boot.exact_replicates(df, 20, 42).collect()}
    assert {k: v for k, v in got.items() if v != (None, None)} == want


def test_hashes_are_those_of_md5():
    rep = np.array([0, 9, 10, 299, 100000, 7, 2147483647])
    i = np.array([0, 10, 9, 8_999_999, 53_999_999, 10 ** 18, 9 * 10 ** 18])
    for seed in (42, 0, -7, 2 ** 62):
        assert draw_boot.hashed(rep, i, seed).tolist() == [
            int(hashlib.md5(f"{a}-{b}-{seed}".encode()).hexdigest()[:8], 16) for a, b in zip(rep, i)]


def test_no_row_of_a_shuffle_is_a_draw(spark):
    """600 000 draws, 300 of 2 000 rows, go to their one block of rows in a few packed rows."""
    cells = draw_boot.CELLS // 300 * 300
    packed = spark.range(0, 600_000, 1, 2).mapInArrow(draw_boot._pack(cells, 2000, 300, 42), "block long, at binary")
    assert packed.count() <= 4
    assert packed.agg(F.sum(F.octet_length("at"))).first()[0] == 4 * 600_000
