"""Findings of round 2: memory of large buckets, rows that candidates make, what the driver holds."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from tests.llm.test_llm import plain_dedup
from tickframe.llm import chunks, jaccard_join, suffix_dedup


def runs_around_one_anchor(n, messages=10):
    """A bucket of open runs, each of 16 strings that begin alike and end in bytes of their own."""
    rng = np.random.default_rng(0)
    payloads = []
    for k in range(messages):
        m = n // messages
        head = np.tile(np.frombuffer((b"the same passage before the anchor and in it " * 2)[:55], np.uint8), (m, 1))
        data = np.concatenate([head, rng.integers(97, 101, (m, 10), dtype=np.uint8)], axis=1)
        parts = [chunks.squeeze(x) for x in (np.arange(m), np.full(m, 16, np.uint8), data)]
        payloads.append(np.array([m, k * m, *map(len, parts)], np.int64).tobytes() + b"".join(parts))
    return pa.table({"bucket": pa.array([0] * messages, pa.int32()), "chunk_id": pa.array(range(messages), pa.int64()), "payload": pa.array(payloads, pa.binary())})


def test_memory_of_runs_around_one_anchor():
    bucket = runs_around_one_anchor(100_000)
    tracemalloc.start()
    suffix_dedup._compare(bucket)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6  # 1.6 M suffixes; expanded at once they took 370 MB


@pytest.mark.parametrize("piece", [7, 1 << 18])
def test_suffixes_in_pieces(spark, monkeypatch, piece):
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    rng = random.Random(5)
    passage = "".join(rng.choice("abcd ") for _ in range(90))
    rows = [(i, "".join(rng.choice("ab ") for _ in range(rng.randrange(40))) + passage[rng.randrange(20) :] + rng.choice("xyz") * rng.randrange(60)) for i in range(60)]
    bucket = runs_around_one_anchor(500)
    monkeypatch.setattr(suffix_dedup, "PIECE", 1 << 30)
    whole = suffix_dedup._compare(bucket)
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    assert suffix_dedup._compare(bucket).equals(whole)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.dedup_report(df).collect())
    assert got == plain_dedup(rows)


def signature_message(sigs, docs):
    order = np.argsort(docs, kind="stable")
    return np.int64(len(docs)).tobytes() + sigs[order].astype(np.uint32).tobytes() + chunks.squeeze(np.diff(docs[order], prepend=0).astype(np.uint32))


def test_candidates_are_made_once_however_many_buckets():
    rng = np.random.default_rng(1)
    docs = np.repeat(np.arange(40), 60)
    sigs = np.where(docs < 20, np.tile(np.arange(60), 40), rng.integers(1000, 2**32, len(docs)))  # 20 documents alike in all 60 signatures
    packed = []
    for bucket in range(12):
        mine = sigs % 12 == bucket
        table = pa.table({"bucket": pa.array([bucket], pa.int32()), "chunk_id": pa.array([7], pa.int64()), "payload": pa.array([signature_message(sigs[mine], docs[mine])], pa.binary())})
        packed.append(jaccard_join._send_candidates(3)(table))
    packed = pa.concat_tables(packed)
    assert len(packed) <= 12 * 3  # a row for each pair and bucket would be 12 * 190
    got = [jaccard_join._unite(packed.filter(pc.equal(packed["target"], k))) for k in range(3)]
    rows = [r for t in got for r in zip(*(t[c].to_pylist() for c in ("kind", "a", "b")))]
    assert sorted(rows) == [(0, (7 << 20) | a, (7 << 20) | b) for a in range(20) for b in range(a + 1, 20)]


def test_first_parts_lose_no_link_and_are_no_more_than_needed():
    rng = np.random.default_rng(3)
    for n in (1, 2, 4, 9, 10, 30, 200, 1000):
        for _ in range(20):
            x = rng.integers(0, 2**63, n).astype(np.uint64)
            most = n // 9  # removed and added elements, each, of a link
            y = np.concatenate([x[: n - most], rng.integers(0, 2**63, most).astype(np.uint64)])
            sizes = np.array([len(x), len(y)])
            d = np.repeat([0, 1], sizes)
            h = np.concatenate([np.sort(x), np.sort(y)])
            doc, sig = jaccard_join.signatures(d, h, sizes, np.zeros(0, np.uint64))
            assert set(sig[doc == 0].tolist()) & set(sig[doc == 1].tolist())
            band = np.searchsorted(jaccard_join.BANDS, n, side="right") - 1
            if n >= 200:  # the first level is complete here, for both pairs of bands
                assert np.count_nonzero(doc == 0) == jaccard_join.DIFFER[band] + jaccard_join.DIFFER[band + 1] + 2
