"""Draws and counts are shuffled in a few bits each, and equal scores are added up before they are sorted."""

import random

import numpy as np
import pytest

from tabmine.operators import draw_boot


@pytest.mark.parametrize("top", [1, 30, 255, 256, 3000, 4_000_000_000])
def test_sorted_numbers_are_read_back(top):
    for n in (1, 2, 500):
        x = np.sort(np.random.default_rng(n).integers(0, top, n, dtype=np.uint32))
        assert (draw_boot._decoded(draw_boot._coded(x)) == x).all()


def test_a_draw_takes_a_few_bits_of_the_shuffle(spark):
    """600 000 draws, 300 of 2 000 rows: four bytes each before."""
    size = draw_boot.CELLS // 300
    rows = spark.range(0, 3, 1, 3).mapInArrow(draw_boot._squeezed(
        draw_boot._pack(size * 300, 2000, 300, 42), 600_000, 200_000, size, 300), "block long, at binary").collect()
    assert sum(len(r["at"]) for r in rows) < 600_000 // 2
    w = np.zeros((300, size), int)
    for r in rows:
        at = draw_boot._decoded(r["at"])
        np.add.at(w, (at // size, at % size), 1)
    rep, i = np.divmod(np.arange(600_000), 2000)
    want = np.zeros((300, size), int)
    np.add.at(want, (rep, draw_boot.hashed(rep, i, 42) % 2000), 1)
    assert (w == want).all()


@pytest.mark.parametrize("held", [1, 400, 1 << 23])
def test_blocks_of_one_row_and_full_buffers_change_nothing(spark, monkeypatch, held):
    r = random.Random(9)
    df = spark.createDataFrame([(m, i, r.choice([0, 1, 1, None]), r.choice([0.5, round(r.random(), 1)])) for i in range(90) for m in "ab"]
                               + [("a", 5, 1, 0.7)] * 400, "model string, row_id long, y int, p double")
    whole = {tuple(x) for x in draw_boot.exact_replicates(df, 12, 3).collect()}
    monkeypatch.setattr(draw_boot, "CELLS", 40)
    monkeypatch.setattr(draw_boot, "PACK", 50)
    monkeypatch.setattr(draw_boot, "TASK", 170)
    monkeypatch.setattr(draw_boot, "HELD", held)
    assert {tuple(x) for x in draw_boot.exact_replicates(df, 12, 3).collect()} == whole and len(whole) == 24


def test_equal_scores_of_many_blocks_are_added_up_before_the_sort(spark, monkeypatch):
    monkeypatch.setattr(draw_boot, "HELD", 1 << 20)
    w = draw_boot._huffman(np.ones((2, 10), np.uint8).tobytes())
    packed = spark.createDataFrame([("a", 0, [0.1, 0.2], [1, 0], w, False)] * 50,
                                   "model string, part int, p array<double>, y array<int>, w binary, wide boolean").coalesce(1)
    out = packed.mapInArrow(draw_boot._unpacked(10), "model string, part int, p double, y int, w binary").collect()
    assert [(r.p, r.y, list(r.w)) for r in out] == [(0.1, 1, [50] * 10), (0.2, 0, [50] * 10)]
