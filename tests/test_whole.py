"""Queries over the whole of their tables, against brute force."""

import numpy as np
import pytest

from tickframe.operators import repair
from tickframe.plans import registry


def test_lag_scan_covers_every_track(spark, small):
    v = spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = {r.vec_id: (r.lag, r.score) for r in registry.queries()["lag_scan"](spark, small).collect()}
    assert set(got) == {r.vec_id for r in v}
    for r in v:
        a = np.asarray(r.embedding, float)
        m = np.concatenate([np.zeros(3), a[:-3]])
        scores = {k: float(np.mean(a[k:] * m[: len(m) - k] if k >= 0 else a[:k] * m[-k:])) for k in range(-12, 13)}
        best = min(scores, key=lambda k: (-round(abs(scores[k]), 9), k))
        assert got[r.vec_id][0] == best and abs(got[r.vec_id][1] - scores[best]) < 2e-6


def test_clock_offset_both_ways(spark, small):
    t = np.cumsum(np.random.default_rng(1).integers(5_000, 90_000, 1000)).tolist()
    drift = t[:500] + [u + 5_000 for u in t[500:]]
    rows = [(1, t[7:], t), (2, t, t[7:]), (3, drift, t), (4, t[:30], t), (5, t, [u + 10**9 for u in t[:400]])]
    got = repair.clock_offset(spark.createDataFrame(rows, "k long, a array<long>, b array<long>"), "k")
    assert {r.k: (r.offset, r.prefix) for r in got.collect()} == {1: (7, 992), 2: (-7, 992), 3: (None, None), 4: (None, None), 5: (0, 399)}


def test_clock_offset_aligns_whole_clocks(spark, small):
    n = {r.session_id: r.n for r in registry.queries()["times_from_clock"](spark, small).groupBy("session_id").agg({"*": "count"}).toDF("session_id", "n").collect()}
    got = registry.queries()["clock_offset"](spark, small).collect()
    assert len(got) == len(n)
    for r in got:
        assert (r.offset, r.prefix) == ((3, n[r.session_id] - 4) if n[r.session_id] >= 54 else (None, None))


def test_roots_of_long_chains(spark):
    from tickframe.operators import ledger, patterns

    rows = [(i, i - 1 if i % 100 else None) for i in range(300)] + [(1000, 5555), (1001, 1000)]
    nodes = spark.createDataFrame(rows, "n long, p long")
    got = {r.node: (r.root, r.depth) for r in patterns.top_roots(nodes, "n", "p").collect()}
    assert got == {i: (i // 100 * 100, i % 100) for i in range(300)} | {1000: (5555, 1), 1001: (5555, 2)}
    assert {(r.root, r.n, r.deepest) for r in ledger.descendants(nodes, "n", "p").collect()} == {(0, 100, 99), (100, 100, 99), (200, 100, 99), (5555, 2, 2)}
    with pytest.raises(ValueError):
        patterns.top_roots(spark.createDataFrame([(1, 2), (2, 1)], "n long, p long"), "n", "p")
