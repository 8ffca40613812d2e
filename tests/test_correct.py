"""Lag correction against planted shifts, and cases that rows must survive."""

import numpy as np
import pytest

from tickframe.operators import correct


def tracks(shift, n=600, seed=3):
    rng = np.random.default_rng(seed)
    motion = np.convolve(rng.normal(size=n), np.ones(5) / 5, "same") * 4
    return correct.shifted(motion, shift).tolist(), motion.tolist()


def test_planted_shifts_are_corrected(spark):
    rows = [(k, *tracks(k), 30.0) for k in (-40, -9, 0, 1, 7, 25)]
    rows += [(100, [0.0] * 300, tracks(0, 300)[1], 30.0), (101, np.random.default_rng(1).normal(size=20000).tolist(), tracks(0, 20000)[1], 30.0), (102, [], [], 30.0), (103, None, None, 30.0), (104, [1.0], [1.0], 0.0)]
    got = {r.k: r for r in correct.corrected(spark.createDataFrame(rows, "k int, action array<double>, motion array<double>, fps double"), "k").collect()}
    for k in (-40, -9, 0, 1, 7, 25):
        expected = -k if abs(k) / 30 * 1000 > correct.TARGET_MS else 0
        assert got[k].shift == expected and got[k].status == "PASS", got[k]
        assert got[k].lag_was_ms == pytest.approx(k / 30 * 1000)
        assert abs(got[k].residual_ms) <= correct.TARGET_MS
    assert got[100].status == "SKIP" and got[101].status in ("WARN", "FAIL") and got[102].status == "SKIP" and got[103].status == "SKIP"


def test_header_keeps_order_and_fills(spark):
    out = correct.projected(spark.createDataFrame([(1, "x")], "b int, z string"), ["a", "b"])
    assert out.columns == ["a", "b"] and out.collect() == [("", 1)]
