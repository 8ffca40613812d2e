"""Suffix-array deduplication of repeated byte strings.

A byte is removed if a string of WINDOW bytes that covers it also starts in a document with a smaller doc_id. All
strings of that length are compared, across all documents, exactly; strings never cross documents.

A suffix array over every byte would carry WINDOW bytes for each position through a shuffle. Instead:

1. Runs. Every string has an anchor: the GRAM bytes inside it with the least hash, a property of the string alone.
   Neighbouring strings with the same anchor form a run, about one for every 16 bytes. Equal strings have equal
   anchors, so only runs with the same anchor need comparing.
2. Whole runs. Each chunk sends, per hash bucket and once per distinct run, a short hash of the anchor and a hash of
   the run's bytes with its least doc_id. A run whose bytes also occur in a document with a smaller id is settled.
   Of the others only the first holder of each of several different runs with one anchor stays open.
3. Suffixes. Open runs go, with their bytes, to buckets by range: splitters are sampled from the leading bytes of
   anchored suffixes. A bucket expands its runs into suffixes of WINDOW bytes, sorts them locally as a multikey sort
   over machine words (the next word only inside ties), and reads off from neighbours which suffixes are equal to one of
   a document with a smaller id. Range boundaries lie between different leading bytes, so no group of equal
   suffixes crosses one. There are as many buckets as open runs need, which were counted in step 2, and a bucket expands
   PIECE suffixes at a time, equal ones together: runs around one anchor, however many, cost their bytes and not their suffixes.
4. Answers return to their chunk by position in the message, as bits; each chunk then cuts its texts.

A passage that a third of all documents share is sent once per chunk, and after step 2 only one copy of it is open.
Messages carry hashes (64 bits) and positions; bytes decide in step 3, 64-bit hashes of whole runs in step 2.

Null text: no bytes. Null doc_id: after all others. Rows with the same doc_id never count as earlier than each
other. Empty table: no rows. Further columns are ignored. Intermediate results lie in the shared folder.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.chunks import Chunk, expand, mixed, pack, powers, prefix_sums, sliding_min, span_hashes, squeeze
from tickframe.llm.common import drop_written, release, trim, written

WINDOW = 50
GRAM = 20
SEGMENT = 1 << 20
CHUNK = 4 << 20
#: Runs that a bucket of step 2 and one of step 3 should hold, and suffixes that are sorted at a time.
BUCKET_RUNS, OPEN_RUNS, PIECE = 600_000, 50_000, 1 << 18
#: Chunks that splitters are sampled from, and samples of each.
SPLIT_CHUNKS, SPLIT_SAMPLES = 64, 400
MESSAGE = "bucket int, chunk_id long, payload binary"
_U = np.uint64
_MULT = mixed(np.arange(1, -(-WINDOW // 8) + 1, dtype=_U)) | _U(1)


class Runs:
    """The runs of a chunk in text order: first string, number of strings, anchor, document, hashes."""

    def __init__(self, c: Chunk):
        width = WINDOW - GRAM + 1
        parts = []
        n = len(c.data)
        doc = c.doc_of()
        for at in range(0, max(n - WINDOW + 1, 0), SEGMENT - WINDOW):
            piece = c.data[at : at + SEGMENT]
            if len(piece) < WINDOW:
                break
            sums = prefix_sums(piece)
            _, inv = powers(len(sums))
            grams = mixed((sums[GRAM:] - sums[: len(sums) - GRAM]) * inv[: len(sums) - GRAM])
            low = _U(SEGMENT - 1)
            least = sliding_min((grams & ~low) | np.arange(len(grams), dtype=_U), width) & low
            count = len(piece) - WINDOW + 1
            anchor = least[:count].astype(np.int64)
            last = at + SEGMENT >= n
            keep = min(count, SEGMENT - WINDOW) if not last else count
            valid = doc[at : at + keep] == doc[at + WINDOW - 1 : at + WINDOW - 1 + keep]
            first = valid.copy()
            first[1:] &= ~valid[:-1] | (anchor[1:keep] != anchor[: keep - 1])
            begin = np.flatnonzero(first)
            if not len(begin):
                continue
            ends = np.flatnonzero(valid & np.append(~valid[1:] | (anchor[1:keep] != anchor[: keep - 1]), True))
            a = anchor[begin]
            hashes = span_hashes(sums, begin, ends + WINDOW)
            parts.append((begin + at, ends - begin + 1, a + at, doc[begin + at], grams[a], hashes))
            if last:
                break
        empty = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.int32),) + (np.zeros(0, _U),) * 2
        self.first, self.strings, self.anchor, self.doc, self.gram, self.run = (np.concatenate(x) for x in zip(*parts)) if parts else empty

    def distinct(self, ids: np.ndarray, buckets: int):
        """For each bucket: (positions of one holder with the least id of each distinct run); and each run's holder."""
        order = np.lexsort((ids[self.doc], self.run))
        run = self.run[order]
        new = np.append(True, run[1:] != run[:-1]) if len(run) else np.zeros(0, bool)
        holders = order[new]
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        bucket = ((self.gram[holders] & _U(0xFFFF)) * _U(buckets) >> _U(16)).astype(np.int64)  # anchors are least in their high bits
        by = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[by], np.arange(buckets + 1))
        return [by[bounds[b] : bounds[b + 1]] for b in range(buckets)], holders, which


def _rows(buckets, chunks, payloads):
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(chunks, pa.int64()), pa.array(payloads, pa.binary())], names=["bucket", "chunk_id", "payload"])


def _announce(buckets: int):
    """Step 2, sending: payload = gram (32 bits), run (64 bits), doc_id of each distinct run."""

    def run(batches):
        for b in batches:
            for chunk_id, meta, data in zip(*(b.column(i).to_pylist() for i in range(3))):
                c = Chunk(meta, data)
                r = Runs(c)
                per, holders, _ = r.distinct(c.ids, buckets)
                rows = ([], [], [])
                for k, mine in enumerate(per):
                    if len(mine):
                        at = holders[mine]
                        gram = ((r.gram[at] >> _U(16)) & _U(0xFFFFFFFF)).astype(np.uint32)
                        ids = c.ids[r.doc[at]]
                        base = ids.min()
                        wide = ids - base
                        small = wide.max() < 2**32
                        head = np.array([len(at), base, small], dtype=np.int64).tobytes()
                        body = squeeze(wide.astype(np.uint32) if small else wide)
                        for col, x in zip(rows, (k, chunk_id, head + gram.tobytes() + r.run[at].tobytes() + body)):
                            col.append(x)
                yield _rows(*rows)
                del c, r, per, holders, rows
                trim()

    return run


def _settle(table: pa.Table) -> pa.Table:
    """Step 2, in a bucket: 0 nothing to do, 1 all strings of the run occur in an earlier document, 2 open; and how many are open."""
    chunks, payloads = table["chunk_id"].to_pylist(), table["payload"].to_pylist()
    grams, runs, ids, sizes = [], [], [], []
    for p in payloads:
        n, base, small = np.frombuffer(p, np.int64, 3)
        grams.append(np.frombuffer(p, np.uint32, n, 24))
        runs.append(np.frombuffer(p, _U, n, 24 + 4 * n))
        ids.append(expand(p[24 + 12 * n :], np.uint32 if small else np.int64).astype(np.int64) + base)
        sizes.append(n)
    del payloads
    gram, run, doc = np.concatenate(grams), np.concatenate(runs), np.concatenate(ids)
    del grams, runs, ids
    order = np.lexsort((doc, run, gram))
    gram, run, doc = gram[order], run[order], doc[order]
    new_gram = np.append(True, gram[1:] != gram[:-1])
    new_run = new_gram | np.append(True, run[1:] != run[:-1])
    run_at, gram_at = np.flatnonzero(new_run), np.flatnonzero(new_gram)
    in_run, in_gram = np.cumsum(new_run) - 1, np.cumsum(new_gram) - 1
    later = doc > doc[run_at][in_run]
    kinds = np.add.reduceat(new_run.astype(np.int64), gram_at)
    apart = np.minimum.reduceat(doc, gram_at) != np.maximum.reduceat(doc, gram_at)
    state = np.where(later, 1, np.where(((kinds > 1) & apart)[in_gram], 2, 0)).astype(np.uint8)
    back = np.empty(len(state), np.uint8)
    back[order] = state
    cuts = np.cumsum(sizes)[:-1]
    parts = np.split(back, cuts)
    out = [squeeze(x) for x in parts]
    open_runs = [int(np.count_nonzero(x == 2)) for x in parts]
    del gram, run, doc, order, in_run, in_gram, later, state
    trim()
    return pa.table({"bucket": table["bucket"].cast(pa.int32()), "chunk_id": pa.array(chunks, pa.int64()), "payload": pa.array(out, pa.binary()), "open_runs": pa.array(open_runs, pa.int64())})


STATES = f"{MESSAGE}, open_runs long"


def _states(r: Runs, ids: np.ndarray, answers: dict, buckets: int) -> np.ndarray:
    """The state of every run of a chunk, from the answers about its distinct runs."""
    per, holders, which = r.distinct(ids, buckets)
    known = np.zeros(len(holders), np.uint8)
    for k, mine in enumerate(per):
        if len(mine):
            known[mine] = expand(answers[k], np.uint8)
    state = known[which]
    state[ids[r.doc] > ids[r.doc[holders]][which]] = 1
    return state


def _open_runs(c: Chunk, r: Runs, state: np.ndarray, splitters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Open runs, one holder of each distinct one, and their range buckets by the anchor's leading bytes."""
    at = np.flatnonzero(state == 2)
    _, keep = np.unique(r.run[at], return_index=True)
    # among equal runs of a chunk the state is 2 only for the least id; any of its occurrences will do
    at = at[np.sort(keep)]
    return at, np.searchsorted(splitters, _leading(c, r.anchor[at]), side="right")


def _leading(c: Chunk, at: np.ndarray) -> np.ndarray:
    """The first 16 bytes of anchored suffixes."""
    if not len(at):
        return np.zeros(0, "S16")
    return np.ascontiguousarray(c.data[at[:, None] + np.arange(16)]).view("S16").ravel()


def _send_open(splitters: np.ndarray, buckets: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = ([], [], [])
        for chunk_id, meta, data in zip(*(left[n].to_pylist() for n in ("chunk_id", "meta", "data"))):
            c = Chunk(meta, data)
            r = Runs(c)
            answers = dict(zip(right["bucket"].to_pylist(), right["payload"].to_pylist()))
            at, bucket = _open_runs(c, r, _states(r, c.ids, answers, buckets), splitters)
            for k in np.unique(bucket):
                mine = at[bucket == k]
                strings = r.strings[mine]
                size = strings + WINDOW - 1
                ends = np.cumsum(size)
                where = np.repeat(r.first[mine] - (ends - size), size) + np.arange(ends[-1])
                ids = c.ids[r.doc[mine]]
                head = np.array([len(mine), ids.min()], np.int64).tobytes()
                parts = [squeeze(ids - ids.min()), squeeze(strings.astype(np.uint8)), squeeze(c.data[where])]
                sizes = np.array([len(p) for p in parts], np.int64).tobytes()
                for col, x in zip(rows, (int(k), chunk_id, head + sizes + b"".join(parts))):
                    col.append(x)
            del c, r
        trim()
        return pa.Table.from_batches([_rows(*rows)])

    return run


def multikey_order(words: np.ndarray, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by their words from left to right, then by tie; and where a new value of the words begins.

    Sorts by the first word, then sorts by the next word only inside groups that are still tied.
    """
    n = len(words)
    order = np.argsort(words[:, 0], kind="stable")
    group = np.zeros(n, np.int64)  # rank of each position's tied group
    value = words[order, 0]
    group[1:] = np.cumsum(value[1:] != value[:-1])
    for k in range(1, words.shape[1] + 1):
        size = np.bincount(group)
        open_at = np.flatnonzero(size[group] > 1)
        if not len(open_at):
            break
        rows, g = order[open_at], group[open_at]
        key = words[rows, k] if k < words.shape[1] else tie[rows]
        sub = np.lexsort((key, g))
        order[open_at] = rows[sub]
        if k < words.shape[1]:
            value, same = key[sub], g[sub]
            split = np.zeros(n, np.int64)
            split[open_at[1:]] = (value[1:] != value[:-1]) & (same[1:] == same[:-1])
            begins = np.append(True, group[1:] != group[:-1]) | (split > 0)
            group = np.cumsum(begins) - 1
    return order, np.append(True, group[1:] != group[:-1]) if n else np.zeros(0, bool)


def _compare(table: pa.Table) -> pa.Table:
    """Step 3, in a bucket: for every open run, which of its strings occur in a document with a smaller id."""
    chunks, payloads = table["chunk_id"].to_pylist(), table["payload"].to_pylist()
    ids, strings, data, sizes = [], [], [], []
    for p in payloads:
        n, base = np.frombuffer(p, np.int64, 2)
        a, b, c = np.frombuffer(p, np.int64, 3, 16)
        ids.append(expand(p[40 : 40 + a], np.int64) + base)
        strings.append(expand(p[40 + a : 40 + a + b], np.uint8).astype(np.int64))
        data.append(expand(p[40 + a + b :], np.uint8))
        sizes.append(int(n))
    del payloads
    doc, count, text = np.concatenate(ids), np.concatenate(strings), np.concatenate(data)
    del ids, strings, data
    begin = np.cumsum(count + WINDOW - 1) - (count + WINDOW - 1)
    ends = np.cumsum(count)
    windows = np.lib.stride_tricks.sliding_window_view(text, WINDOW)
    total = int(ends[-1])

    def strings_at(which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Run, place in it, and words (8 bytes each, most significant first) of strings by their number."""
        run = np.searchsorted(ends, which, side="right")
        nth = which - (ends[run] - count[run])
        raw = np.zeros((len(which), 8 * len(_MULT)), np.uint8)
        raw[:, :WINDOW] = windows[begin[run] + nth]
        return run, nth, raw.view(">u8").astype(_U)

    # equal strings get the same piece
    pieces = total // PIECE + 1
    piece = np.zeros(total, np.int32)
    for at in range(0, total if pieces > 1 else 0, PIECE):
        words = strings_at(np.arange(at, min(at + PIECE, total)))[2]
        piece[at : at + PIECE] = ((mixed(words @ _MULT) >> _U(32)) * _U(pieces)) >> _U(32)
    masks = np.zeros(len(count), _U)
    for k in range(pieces):
        run, nth, words = strings_at(np.flatnonzero(piece == k))
        order, new = multikey_order(words, doc[run])
        lead = np.flatnonzero(new)[np.cumsum(new) - 1]
        sorted_doc = doc[run][order]
        hit = order[sorted_doc > sorted_doc[lead]]
        np.bitwise_or.at(masks, run[hit], _U(1) << nth[hit].astype(_U))
    out = [squeeze(m) for m in np.split(masks, np.cumsum(sizes)[:-1])]
    del doc, count, text, windows, piece
    trim()
    return pa.table({"bucket": table["bucket"].cast(pa.int32()), "chunk_id": pa.array(chunks, pa.int64()), "payload": pa.array(out, pa.binary())})


RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def _cut(splitters: np.ndarray, buckets: int, with_bytes: bool):
    """Step 4: the texts of a chunk without what is marked."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {f.name: [] for f in RESULT}
        kinds, which, payloads = (right[n].to_pylist() for n in ("kind", "bucket", "payload"))
        answers = {k: p for t, k, p in zip(kinds, which, payloads) if t == 0}
        masks = {k: p for t, k, p in zip(kinds, which, payloads) if t == 1}
        for meta, data in zip(left["meta"].to_pylist(), left["data"].to_pylist()):
            c = Chunk(meta, data)
            r = Runs(c)
            state = _states(r, c.ids, answers, buckets)
            bits = np.where(state == 1, (_U(1) << r.strings.astype(_U)) - _U(1), _U(0))
            at, bucket = _open_runs(c, r, state, splitters)
            for k in np.unique(bucket):
                bits[at[bucket == k]] = expand(masks[int(k)], _U)
            # other occurrences of an open run in its document have the same strings
            if len(at):
                by = np.argsort(r.run[at])
                known = r.run[at][by]
                again = np.flatnonzero(state == 2)
                bits[again] = bits[at[by[np.searchsorted(known, r.run[again])]]]
            edge = np.zeros(len(c.data) + 1, np.int32)
            for k in range(WINDOW - GRAM + 1):
                hit = r.first[(bits >> _U(k)) & _U(1) == 1] + k
                np.add.at(edge, hit, 1)
                np.add.at(edge, hit + WINDOW, -1)
            gone = np.cumsum(edge[:-1]) > 0
            for i, null, s, n in zip(c.ids.tolist(), c.null.tolist(), c.starts.tolist(), c.lens.tolist()):
                mine, text = gone[s : s + n], c.data[s : s + n]
                removed = int(np.count_nonzero(mine))
                spans = int(mine[0]) + int(np.count_nonzero(mine[1:] & ~mine[:-1])) if removed else 0
                left_over = (text[~mine] if removed else text).tobytes()
                row = (None if null else i, n, removed, spans, hashlib.sha256(left_over).hexdigest(), left_over if with_bytes else None)
                for name, x in zip(out, row):
                    out[name].append(x)
            del c, r, state, bits, edge, gone
        trim()
        return pa.table(out, schema=RESULT)

    return run


def deduplicate(docs: DataFrame, with_bytes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes, if asked for): one row a document."""
    spark = docs.sparkSession
    chunks = pack(docs, CHUNK)
    total = chunks.agg(F.count("*").alias("n")).first()["n"]
    # a chunk has about one run for every 16 bytes; as few messages as memory allows
    buckets = max(8, min(4096, int(total * CHUNK / 16 / BUCKET_RUNS) + 1))
    word = spark.createDataFrame([], "bucket int") if total == 0 else None
    if word is not None:
        return spark.createDataFrame([], "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")

    def leading(batches):
        for b in batches:
            for meta, data in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                c = Chunk(meta, data)
                r = Runs(c)
                pick = r.anchor[np.argsort(mixed(r.run))[:SPLIT_SAMPLES]]
                yield pa.RecordBatch.from_arrays([pa.array(_leading(c, pick).tolist(), pa.binary())], names=["w"])

    first = chunks.filter(f"chunk_id & 16777215 = 0 and chunk_id >> 24 < {SPLIT_CHUNKS}")  # first chunks of the first partitions
    announced = chunks.mapInArrow(_announce(buckets), MESSAGE)
    states = written(announced.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_settle, STATES))
    release(spark)
    open_runs = states.agg(F.sum("open_runs").alias("n")).first()["n"] or 0
    ranges = max(8, min(4096, open_runs // OPEN_RUNS + 1))
    sample = sorted(x["w"] for x in first.mapInArrow(leading, "w binary").collect())
    splitters = np.array([sample[i * len(sample) // ranges] for i in range(1, ranges)] if sample else [], dtype="S16")
    opened = chunks.groupBy("chunk_id").cogroup(states.groupBy("chunk_id")).applyInArrow(_send_open(splitters, buckets), MESSAGE)
    masks = written(opened.repartition(ranges, "bucket").groupBy("bucket").applyInArrow(_compare, MESSAGE))
    release(spark)
    answers = states.drop("open_runs").withColumn("kind", F.lit(0)).unionByName(masks.withColumn("kind", F.lit(1)))
    out = chunks.groupBy("chunk_id").cogroup(answers.groupBy("chunk_id")).applyInArrow(_cut(splitters, buckets, with_bytes), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out


def dedup_report(docs: DataFrame) -> DataFrame:
    return deduplicate(docs).drop("kept")


__all__ = ["deduplicate", "dedup_report", "multikey_order", "drop_written"]
