"""K-Means restarts: fitted side by side, the first of the cheapest wins."""

import threading
from types import SimpleNamespace

from tabmine.operators import cluster


def fake(monkeypatch, cost, meet=None):
    class Fake:
        def __init__(self, seed, **_):
            self.seed = seed

        def fit(self, x):
            if meet:
                meet.wait(timeout=20)
            return SimpleNamespace(seed=self.seed, summary=SimpleNamespace(trainingCost=cost(self.seed)))
    monkeypatch.setattr(cluster, "KMeans", Fake)


def test_restarts_run_side_by_side(monkeypatch):
    fake(monkeypatch, lambda s: -s, threading.Barrier(5))  # one alone would wait in vain
    assert cluster.kmeans_best(None, 3, 10, 42).seed == 51


def test_of_equal_costs_the_first_seed_wins(monkeypatch):
    fake(monkeypatch, lambda s: 1.0 if s in (44, 47) else 2.0)
    assert cluster.kmeans_best(None, 3, 10, 42).seed == 44
