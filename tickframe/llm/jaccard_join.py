"""N-gram Jaccard join by PartEnum signatures.

A document's set holds its distinct shingles of SHINGLE words (A to Z in lower case); with fewer words the whole
sequence is its one shingle; without words the set is empty and linked with nothing. Two documents link when
100 * intersection >= 80 * union. The result names each document's component: the smallest doc_id that links reach.

1. Equal sets are found first by two 64-bit sums over the set and its size; one document of each class goes on, so
   copies, however many, cost one row each.
2. Sizes fall into bands, each 5/4 as wide as the one before: linked sets lie in the same or in neighbouring bands.
   Within a pair of bands linked sets differ in at most k = 2 * (largest size) / 9 elements. The feature domain is
   partitioned by hash into m > k parts, so linked sets agree in at least m - k parts, and every non-empty part's
   content is a signature. If one of the sets fills more than k parts, the pair shares a signature for certain: of the first
   k + 1 parts that either set fills at least one agrees, so no set needs more than the first k + 1 that it fills. A set
   that does not is enumerated again under the next partition (LEVELS), and at last every single element becomes a
   signature. So no link is lost.
   The first partitions set frequent shingles apart (those of passages that many documents share, found by counting
   within chunks; at most HEAVY of them, whose choice decides cost and never results), with more and smaller parts from
   level to level. Signatures of rare shingles are shared by few documents; only documents that are mostly made
   of frequent shingles, such as members of large groups of copies, come to the levels that use all shingles.
3. Documents that share a signature are candidates. Groups of up to SMALL give all their pairs. A larger group gives
   the pairs of one member, its centre, with all others: the one that most large groups hold, which is the text that
   was copied and changed. A pair with many common signatures is found in many buckets; these send their candidates packed
   to targets, by a hash of the pair, where each is named once.
4. Sets of candidates are stored once. A pair whose size or histogram of BINS hashed bins bounds its similarity below the
   limit is dropped; for the others sets meet in joins and are compared in full. Links become components.
5. Large groups whose centres are alike make a cluster. Its pivot holds the elements that more than half of the members
   have; d counts in how many elements a member differs from it. Members f and x differ in d_f + d_x - 2 s elements, where
   s counts the differences from the pivot that both have, and link when 9 times that is at most n_f + n_x. All pairs that link
   with s = 0 hang together over the member with the least 9 d - n, whose star is compared in full. What is left are pairs
   of a member f that is not connected with it, and s > 0: differences meet in blocks of FAR by NEAR members through an inverted
   index, and a block answers with the edges of a spanning forest. That is complete; work in a cluster grows with the number
   of members that link with few others, times all, but memory does not, nor does what is sent but for copies of the blocks.

Texts are read in chunks; step 2 sends hashes of signatures only, and false candidates from hash collisions are
dropped in step 4. Shingles are compared by hashes of 62 bits. Null text counts as empty. Null doc_id: linked like others, but never the smallest. Empty table:
no rows. Further columns are ignored. Intermediate results lie in the shared folder.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.chunks import NO_ID, Chunk, expand, mixed, pack, squeeze, word_hashes
from tickframe.llm.common import drop_written, release, scratch, settle, trim, written

SHINGLE = 5
SEGMENT = 1 << 19
#: (whether frequent shingles are set apart, parts of the domain for each difference that linked sets may have)
LEVELS = [(True, 1.3), (True, 3.0), (True, 8.0), (False, 1.3), (False, 1.3), (False, 3.0), (False, 8.0)]
HEAVY = 1_000_000
#: A shingle counts in chunks where so many documents hold it, and is frequent from so many such documents on.
HEAVY_IN_CHUNK, HEAVY_IN_ALL = 2, 4
SMALL = 32
BINS = 256
CHUNK = 2 << 20
EDGES_AT_ONCE = 500_000
BUCKET_SIGNATURES = 1_000_000
#: Buckets for each target of their candidates, and candidates after which a target drops repeats.
BUCKETS_A_TARGET, UNITE_AT = 4, 1_000_000
_U = np.uint64
_MULT = mixed(np.arange(1, SHINGLE + 2, dtype=_U)) | _U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

#: Least sizes of bands: each at least 5/4 of the one before.
BANDS = [1]
while BANDS[-1] < 1 << 40:
    BANDS.append(-(-BANDS[-1] * 5 // 4) if BANDS[-1] > 3 else BANDS[-1] + 1)
BANDS = np.array(BANDS, dtype=np.int64)
#: For the pair of bands below each bound: differences of linked sets.
DIFFER = np.append(2 * (BANDS[1:] - 1) // 9, 1 << 40)


def shingles(c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document index and hash of each distinct shingle, in order of both; and the number of shingles a document."""
    docs, hashes = [], []
    n_docs, i = len(c.lens), 0
    ends_at = np.cumsum(c.lens)
    while i < n_docs:
        j = max(i + 1, int(np.searchsorted(ends_at, ends_at[i] - c.lens[i] + SEGMENT, side="right")))
        lo, hi = int(c.starts[i]), int(ends_at[j - 1])
        text = _LOWER[c.data[lo:hi]]
        if len(text):
            doc = np.repeat(np.arange(i, j), c.lens[i:j])
            word = ~_SPACE[text]
            apart = np.append(True, doc[1:] != doc[:-1])
            begin = np.flatnonzero(word & (apart | np.append(True, ~word[:-1])))
            end = np.flatnonzero(word & np.append(apart[1:] | ~word[1:], True)) + 1
            if len(begin):
                h = word_hashes(text, begin, end)
                wd = doc[begin]
                if len(h) >= SHINGLE:
                    n = len(h) - SHINGLE + 1
                    full = wd[:n] == wd[SHINGLE - 1 :]
                    s = np.zeros(n, _U)
                    for k in range(SHINGLE):
                        s += mixed(h[k : k + n]) * _MULT[k]
                    docs.append(wd[:n][full])
                    hashes.append(mixed(s[full]))
                count = np.bincount(wd - i, minlength=j - i)
                short = (count > 0) & (count < SHINGLE)
                if short.any():
                    at = np.flatnonzero(short[wd - i])
                    first = np.cumsum(count) - count
                    term = mixed(h[at]) * _MULT[at - first[wd[at] - i]]
                    d = wd[at]
                    cut = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
                    docs.append(d[cut])
                    hashes.append(mixed(np.add.reduceat(term, cut) + count[d[cut] - i].astype(_U) * _MULT[SHINGLE]))
        i = j
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(n_docs, np.int64)
    d, h = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    new = np.append(True, (d[1:] != d[:-1]) | (h[1:] != h[:-1]))
    d, h = d[new], h[new]
    return d, h, np.bincount(d, minlength=n_docs)


def _batch(**cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(cols)


def _gid(chunk_id: int, idx):
    return (chunk_id << 20) | idx


def _describe(batches):
    """Step 1: a row a document (gid, doc_id, n, two set hashes); frequent shingles as rows of kind 1."""
    for b in batches:
        for chunk_id, meta, data in zip(*(b.column(i).to_pylist() for i in range(3))):
            c = Chunk(meta, data)
            d, h, n = shingles(c)
            one, two = np.zeros(len(n), _U), np.zeros(len(n), _U)
            if len(d):
                cut = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
                one[d[cut]] = np.add.reduceat(mixed(h + _MULT[0]), cut)
                two[d[cut]] = np.add.reduceat(mixed(h ^ _MULT[1]), cut)
            gid = _gid(chunk_id, np.arange(len(n)))
            yield _batch(kind=pa.array(np.zeros(len(n), np.int32)), gid=pa.array(gid), doc_id=pa.array(c.ids.copy()), n=pa.array(n.astype(np.int64)), one=pa.array(one.view(np.int64)), two=pa.array(two.view(np.int64)))
            value, df = np.unique(h, return_counts=True)
            often = df >= HEAVY_IN_CHUNK
            k = int(often.sum())
            if k:
                zero = np.zeros(k, np.int64)
                yield _batch(kind=pa.array(np.ones(k, np.int32)), gid=pa.array(value[often].view(np.int64)), doc_id=pa.array(zero), n=pa.array(df[often].astype(np.int64)), one=pa.array(zero), two=pa.array(zero))
            del c, d, h, n, one, two, value, df, often
            trim()


DESCRIPTION = "kind int, gid long, doc_id long, n long, one long, two long"


def signatures(d: np.ndarray, h: np.ndarray, n: np.ndarray, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document index and signature of every signature of the documents in d; n: set sizes by document index."""
    docs, sigs = [], []
    band = np.searchsorted(BANDS, n, side="right") - 1
    if len(heavy) and len(h):
        at = np.minimum(np.searchsorted(heavy, h), len(heavy) - 1)
        light = heavy[at] != h
    else:
        light = np.ones(len(h), bool)
    for slot in (0, 1):
        inst = band + slot
        short = np.zeros(len(n), bool)
        short[d] = True
        for level in range(len(LEVELS) + 1):
            rare, spread = LEVELS[level] if level < len(LEVELS) else (False, 0)
            mine = short[d] & light if rare else short[d]
            todo_d, todo_h = d[mine], h[mine]
            if not short.any():
                break
            if not spread:
                owner, part, content = todo_d, np.zeros(len(todo_d), np.int64), mixed(todo_h)
            else:
                m = (np.ceil(spread * (DIFFER[inst[todo_d]] + 1)) + 2).astype(_U)
                part = (((mixed(todo_h ^ (_MULT[2] * _U(level + 1))) >> _U(32)) * m) >> _U(32)).astype(np.int64)
                key = (todo_d.astype(np.int64) << 32) | part
                order = np.argsort(key, kind="stable")
                key = key[order]
                cut = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
                content = np.add.reduceat(mixed(todo_h[order] + _MULT[3]), cut) if len(cut) else np.zeros(0, _U)
                owner, part = key[cut] >> 32, key[cut] & 0xFFFFFFFF
            # in an order that all sets share, the first k + 1 filled parts of either set hold one that agrees
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, np.int64)
            rank = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
            lead = rank <= DIFFER[inst[owner]]
            owner, part, content = owner[lead], part[lead], content[lead]
            docs.append(owner)
            sigs.append(mixed(content + mixed(inst[owner].astype(_U) * _MULT[4] + part.astype(_U) * _MULT[0] + _U(level))))
            short &= np.bincount(owner, minlength=len(n)) <= DIFFER[inst]
    return (np.concatenate(docs), np.concatenate(sigs)) if docs else (np.zeros(0, np.int64), np.zeros(0, _U))


def _send_signatures(heavy, buckets: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"bucket": [], "chunk_id": [], "payload": []}
        own = right["gid"].to_numpy() & ((1 << 20) - 1)
        for chunk_id, meta, data in zip(*(left[x].to_pylist() for x in ("chunk_id", "meta", "data"))):
            d, h, n = shingles(Chunk(meta, data))
            chosen = np.zeros(len(n), bool)
            chosen[own] = True
            mine = chosen[d]
            doc, sig = signatures(d[mine], h[mine], n, heavy.value)
            bucket = ((sig >> _U(48)) * _U(buckets) >> _U(16)).astype(np.int64)
            order = np.lexsort((doc, bucket))
            bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for k in range(buckets):
                at = order[bounds[k] : bounds[k + 1]]
                if len(at):
                    steps = np.diff(doc[at], prepend=0).astype(np.uint32)
                    out["bucket"].append(k)
                    out["chunk_id"].append(chunk_id)
                    out["payload"].append(np.int64(len(at)).tobytes() + (sig[at] & _U(0xFFFFFFFF)).astype(np.uint32).tobytes() + squeeze(steps))
        trim()
        return pa.table({"bucket": pa.array(out["bucket"], pa.int32()), "chunk_id": pa.array(out["chunk_id"], pa.int64()), "payload": pa.array(out["payload"], pa.binary())})

    return run


CANDIDATES = "kind int, a long, b long"
PACKED = "target int, payload binary"


def _candidates(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Step 3, in a bucket: pairs of documents; and large groups' centres with a member each."""
    sigs, gids = [], []
    for chunk_id, p in zip(table["chunk_id"].to_pylist(), table["payload"].to_pylist()):
        n = int(np.frombuffer(p, np.int64, 1)[0])
        sigs.append(np.frombuffer(p, np.uint32, n, 8))
        gids.append(_gid(chunk_id, np.cumsum(expand(p[8 + 4 * n :], np.uint32).astype(np.int64))))
    sig, gid = np.concatenate(sigs), np.concatenate(gids)
    order = np.lexsort((gid, sig))
    sig, gid = sig[order], gid[order]
    new = np.append(True, (sig[1:] != sig[:-1]) | (gid[1:] != gid[:-1]))
    sig, gid = sig[new], gid[new]
    cut = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
    size = np.diff(np.append(cut, len(sig)))
    pairs, stars = [], []
    for s in range(2, SMALL + 1):
        at = cut[size == s]
        if len(at):
            rows = gid[at[:, None] + np.arange(s)]
            for x in range(s):
                for y in range(x + 1, s):
                    pairs.append(rows[:, [x, y]])
    large = [gid[at : at + s] for at, s in zip(cut[size > SMALL].tolist(), size[size > SMALL].tolist())]
    # the member that most large groups hold stands nearest to the others: the text that was copied and changed
    often = dict(zip(*(x.tolist() for x in np.unique(np.concatenate(large), return_counts=True)))) if large else {}
    for group in large:
        center = max(group.tolist(), key=lambda g: (often[g], -g))
        rest = group[group != center]
        stars.append(np.stack([np.full(len(rest), center), rest], axis=1))
    return distinct_pairs(pairs), distinct_pairs(stars)


def distinct_pairs(parts: list[np.ndarray]) -> np.ndarray:
    """The distinct rows (a, b), in order."""
    p = np.concatenate(parts) if parts else np.zeros((0, 2), np.int64)
    p = p[np.lexsort((p[:, 1], p[:, 0]))]
    return p[np.append(True, (p[1:] != p[:-1]).any(axis=1))] if len(p) else p


def _send_candidates(targets: int):
    """Pairs with many common signatures come from many buckets, so a bucket sends them packed, and they are told apart by target."""

    def run(table: pa.Table) -> pa.Table:
        out = {}
        for kind, p in enumerate(_candidates(table)):
            target = ((mixed(mixed(p[:, 0].view(_U)) + p[:, 1].view(_U)) >> _U(32)) * _U(targets) >> _U(32)).astype(np.int64)
            order = np.argsort(target, kind="stable")
            p, bounds = p[order], np.searchsorted(target[order], np.arange(targets + 1))
            for k in np.flatnonzero(np.diff(bounds)).tolist():
                mine = p[bounds[k] : bounds[k + 1]]
                packed = squeeze(np.stack([np.diff(mine[:, 0], prepend=0), mine[:, 1] - mine[:, 0]]))
                out.setdefault(k, []).append(np.array([kind, len(packed)], np.int64).tobytes() + packed)
        trim()
        return pa.table({"target": pa.array(list(out), pa.int32()), "payload": pa.array([b"".join(x) for x in out.values()], pa.binary())})

    return run


def _unite(table: pa.Table) -> pa.Table:
    """Each candidate of a target once. kind 0: a pair of documents; kind 1: a large group's centre and a member."""
    held, count = ([], []), [0, 0]
    for raw in table["payload"]:
        raw, at = raw.as_py(), 0
        while at < len(raw):
            kind, size = np.frombuffer(raw, np.int64, 2, at).tolist()
            steps, apart = expand(raw[at + 16 : at + 16 + size], np.int64).reshape(2, -1)
            a = np.cumsum(steps)
            held[kind].append(np.stack([a, a + apart], axis=1))
            count[kind] += len(a)
            if count[kind] > UNITE_AT:
                held[kind][:] = [distinct_pairs(held[kind])]
                count[kind] = 0
            at += 16 + size
    both = [distinct_pairs(x) for x in held]
    trim()
    kind = np.repeat(np.arange(2, dtype=np.int32), [len(x) for x in both])
    return pa.table({"kind": kind, "a": np.concatenate([x[:, 0] for x in both]), "b": np.concatenate([x[:, 1] for x in both])})


def _sets(left: pa.Table, right: pa.Table) -> pa.Table:
    """Sets of the wanted documents of a chunk: sorted hashes, 6 bytes each, and their histogram."""
    out = {"gid": [], "n": [], "bins": [], "elements": []}
    for chunk_id, meta, data in zip(*(left[x].to_pylist() for x in ("chunk_id", "meta", "data"))):
        d, h, n = shingles(Chunk(meta, data))
        begin = np.cumsum(n) - n
        low = (h >> _U(16)).view(np.uint8).reshape(-1, 8)[:, :6]
        bin_of = (h & _U(BINS - 1)).astype(np.int64)
        for g in right["gid"].to_pylist():
            i = g & ((1 << 20) - 1)
            mine = slice(begin[i], begin[i] + n[i])
            out["gid"].append(g)
            out["n"].append(int(n[i]))
            out["bins"].append(np.minimum(np.bincount(bin_of[mine], minlength=BINS), 255).astype(np.uint8).tobytes())
            out["elements"].append(low[mine].tobytes())
    trim()
    return pa.table({"gid": pa.array(out["gid"], pa.int64()), "n": pa.array(out["n"], pa.int64()), "bins": pa.array(out["bins"], pa.binary()), "elements": pa.array(out["elements"], pa.binary())})


def _possible(batches):
    """Pairs (a, b, na, nb, bins of a, bins of b) whose similarity may reach the limit: common elements are at most the sum of the lesser bins."""
    for b in batches:
        keep = []
        a, c, na, nc = (b.column(i).to_numpy() for i in range(4))
        for at in range(0, len(a), 4096):
            x, y = (np.frombuffer(b"".join(b.column(i)[at : at + 4096].to_pylist()), np.uint8).reshape(-1, BINS) for i in (4, 5))
            both = np.minimum(x, y).sum(axis=1, dtype=np.int64)
            full = ((x == 255) & (y == 255)).any(axis=1)
            total = na[at : at + 4096] + nc[at : at + 4096]
            keep.append(full | (100 * both >= 80 * (total - both)))
        k = np.concatenate(keep) if keep else np.zeros(0, bool)
        yield pa.RecordBatch.from_arrays([pa.array(a[k]), pa.array(c[k])], names=["a", "b"])


def _elements(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view(_U).ravel()


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """For sorted sets."""
    both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
    return 100 * both >= 80 * (len(x) + len(y) - both)


def _verify(batches):
    for b in batches:
        a, c = b.column(0).to_pylist(), b.column(1).to_pylist()
        last, held, keep = None, None, []
        for g, x, y in zip(a, b.column(2), b.column(3)):
            if g != last:
                last, held = g, _elements(x.as_py())
            keep.append(linked(held, _elements(y.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(c, pa.int64()), pa.array(keep, pa.bool_())], names=["a", "b", "link"])


def sets_of(wanted: DataFrame, chunks: DataFrame) -> DataFrame:
    """gid, n, bins, elements of the wanted documents (gid), in the shared folder."""
    wanted = wanted.distinct().withColumn("chunk_id", F.shiftright("gid", 20))
    return written(chunks.groupBy("chunk_id").cogroup(wanted.groupBy("chunk_id")).applyInArrow(_sets, "gid long, n long, bins binary, elements binary"))


def links_of(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b of those pairs that link, in the shared folder."""
    one = lambda x, c: sets.select(F.col("gid").alias(x), *[F.col(k).alias(f"{k}_{x}") for k in c])
    sized = pairs.join(one("a", ["n", "bins"]), "a").join(one("b", ["n", "bins"]), "b").filter("100 * least(n_a, n_b) >= 80 * greatest(n_a, n_b)")
    binned = sized.select("a", "b", "n_a", "n_b", "bins_a", "bins_b")
    possible = written(binned.mapInArrow(_possible, "a long, b long"))
    both = possible.join(one("b", ["elements"]), "b").join(one("a", ["elements"]), "a").select("a", "b", "elements_a", "elements_b")
    return written(both.mapInArrow(_verify, "a long, b long, link boolean").filter("link").select("a", "b"))


def _compare(batches):
    """For (a, b) with their sets: sizes and common elements."""
    for batch in batches:
        a, b = batch.column(0), batch.column(1)
        out = []
        for x, y in zip(batch.column(2), batch.column(3)):
            x, y = _elements(x.as_py()), _elements(y.as_py())
            out.append((len(x), len(y), len(x) + len(y) - len(np.unique(np.concatenate([x, y])))))
        n_a, n_b, both = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([a, b, pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()), pa.array(both, pa.int64())], names=["a", "b", "n_a", "n_b", "both"])


def stars_of(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, n_a, n_b, both of centres a and members b, in the shared folder."""
    one = lambda x: sets.select(F.col("gid").alias(x), F.col("elements").alias(f"e_{x}"))
    met = pairs.join(one("b"), "b").join(one("a"), "a").select("a", "b", "e_a", "e_b")
    return written(met.mapInArrow(_compare, "a long, b long, n_a long, n_b long, both long"))


def _count(batches):
    """(cluster, elements) as (cluster, e, times), added up in batches."""
    for batch in batches:
        held: dict[int, list[np.ndarray]] = {}
        for c, x in zip(batch.column(0).to_pylist(), batch.column(1)):
            held.setdefault(c, []).append(_elements(x.as_py()))
        for c, sets in held.items():
            e, n = np.unique(np.concatenate(sets), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(e), c)), pa.array(e.view(np.int64)), pa.array(n.astype(np.int64))], names=["cluster", "e", "times"])


def _differ(batches):
    """(cluster, gid, elements, pivot) as (cluster, gid, w, apart): the elements that one of set and pivot has, and 9 d - n."""
    for batch in batches:
        w, apart = [], []
        for x, pivot in zip(batch.column(2), batch.column(3)):
            x = _elements(x.as_py()).view(np.int64)
            d = np.setxor1d(x, np.array(pivot.as_py() or [], np.int64))
            w.append(9 * len(d) - len(x))
            apart.append(d)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(w, pa.int64()), pa.array(apart, pa.list_(pa.int64()))], names=["cluster", "gid", "w", "apart"])


APART = "cluster long, gid long, w long, apart array<bigint>"


def clusters_of(stars: DataFrame, sets: DataFrame) -> DataFrame:
    """cluster, gid, w, apart of the members of large groups, in the shared folder; a member may be in several clusters."""
    centres = stars.select(F.col("a").alias("b")).distinct()
    alike = components(stars.filter("2 * both >= greatest(n_a, n_b)").join(centres, "b", "left_semi").select("a", "b"))
    cluster = lambda c: F.coalesce("root", c).alias("cluster")
    members = stars.join(alike, F.col("a") == F.col("node"), "left").select(cluster("a"), F.col("b").alias("gid"))
    members = members.union(centres.join(alike, F.col("b") == F.col("node"), "left").select(cluster("b"), F.col("b").alias("gid"))).distinct()
    held = written(members.join(sets.select("gid", "elements"), "gid").select("cluster", "gid", "elements"))
    size = held.groupBy("cluster").agg(F.count("*").alias("size"))
    times = held.select("cluster", "elements").mapInArrow(_count, "cluster long, e long, times long").groupBy("cluster", "e").agg(F.sum("times").alias("times"))
    pivot = times.join(size, "cluster").filter("2 * times > size").groupBy("cluster").agg(F.collect_list("e").alias("pivot"))
    out = written(held.join(pivot, "cluster", "left").select("cluster", "gid", "elements", "pivot").mapInArrow(_differ, APART))
    drop_written(held)
    return out


def _star(batches):
    """(least, w, apart, gid, w, apart) as links (a, b) of a cluster's least member."""
    for batch in batches:
        a, b = batch.column(0).to_pylist(), batch.column(3).to_pylist()
        keep, last, held = [], None, None
        for k, (x, y, u, v) in enumerate(zip(a, b, batch.column(1).to_pylist(), batch.column(4).to_pylist())):
            if x != last:
                last, held = x, batch.column(2)[k].values.to_numpy()
            both = len(np.intersect1d(held, batch.column(5)[k].values.to_numpy(), assume_unique=True))
            keep.append(x != y and u + v <= 18 * both)
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(3).filter(keep)], names=["a", "b"])


#: Members in a block, about.
FAR, NEAR = 512, 2048
#: Common differences counted at a time.
MATCHES = 4_000_000


def _lists(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """gid, w, and the elements of all lists with the row of each."""
    lists = t["apart"].combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    return t["gid"].to_numpy(), t["w"].to_numpy(), lists.flatten().to_numpy(), np.repeat(np.arange(len(n)), n)


def _meet(left: pa.Table, right: pa.Table) -> pa.Table:
    """Spanning edges of the links between a block of members that are apart and a block of all, by their differences from the pivot."""
    if not len(left) or not len(right):
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    f_gid, f_w, f_e, f_row = _lists(left)
    x_gid, x_w, x_e, x_row = _lists(right)
    order = np.argsort(f_e, kind="stable")
    f_e, f_row = f_e[order], f_row[order]
    lo, hi = np.searchsorted(f_e, x_e), np.searchsorted(f_e, x_e, side="right")
    n = hi - lo
    found_f, found_x, i, ends = [], [], 0, np.cumsum(n)
    while i < len(x_e):  # whole rows of the right side
        j = int(np.searchsorted(ends, (ends[i - 1] if i else 0) + MATCHES, side="right"))
        j = int(np.searchsorted(x_row, x_row[min(max(j, i), len(x_e) - 1)])) if j < len(x_e) else len(x_e)
        j = j if j > i else int(np.searchsorted(x_row, x_row[i], side="right"))
        part = n[i:j]
        at = np.arange(int(part.sum())) + np.repeat(lo[i:j] - np.cumsum(part) + part, part)
        key, both = np.unique(np.repeat(x_row[i:j], part) * len(f_gid) + f_row[at], return_counts=True)
        x, f = key // len(f_gid), key % len(f_gid)
        link = (f_w[f] + x_w[x] <= 18 * both) & (f_gid[f] != x_gid[x])
        found_f.append(f_gid[f[link]])
        found_x.append(x_gid[x[link]])
        i = j
    edges = pa.table({"a": np.concatenate(found_f) if found_f else np.zeros(0, np.int64), "b": np.concatenate(found_x) if found_x else np.zeros(0, np.int64)})
    (forest,) = _forest(edges.to_batches())
    return pa.table({"a": forest.column(0), "b": forest.column(1)})


def _left_over(stars: DataFrame, links: DataFrame, sets: DataFrame) -> DataFrame:
    """Step 5: links (a, b), in the shared folder, that with those given connect all members of large groups that links connect."""
    members = clusters_of(stars, sets)
    least = members.groupBy("cluster").agg(F.min(F.struct("w", "gid")).alias("l")).select("cluster", F.col("l.gid").alias("least"))
    centre = members.join(least, "cluster").filter("gid = least").select("cluster", "least", F.col("w").alias("w_l"), F.col("apart").alias("apart_l"))
    spokes = written(members.join(centre, "cluster").select("least", "w_l", "apart_l", "gid", "w", "apart").mapInArrow(_star, "a long, b long"))
    comp = components(links.union(spokes))
    root = lambda c: F.coalesce(f"root_{c}", c)
    at = lambda c: comp.select(F.col("node").alias(f"_{c}"), F.col("root").alias(f"root_{c}"))
    placed = members.select("cluster", "gid").join(least, "cluster")
    placed = placed.join(at("gid"), F.col("gid") == F.col("_gid"), "left").join(at("least"), F.col("least") == F.col("_least"), "left")
    far = written(members.join(placed.filter(root("gid") != root("least")).select("cluster", "gid"), ["cluster", "gid"], "left_semi"))
    count = lambda rows, size, name: rows.groupBy("cluster").agg(F.ceil(F.count("*") / size).cast("int").alias(name))
    blocks = count(far, FAR, "n_f").join(count(members, NEAR, "n_x"), "cluster")
    own = lambda n: F.pmod(F.xxhash64("gid"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = far.join(blocks, "cluster").select("cluster", own(F.col("n_f")).alias("f"), every("n_x").alias("x"), "gid", "w", "apart")
    right = members.join(blocks, "cluster").select("cluster", own(F.col("n_x")).alias("x"), every("n_f").alias("f"), "gid", "w", "apart")
    met = left.groupBy("cluster", "f", "x").cogroup(right.groupBy("cluster", "f", "x")).applyInArrow(_meet, "a long, b long")
    return written(spokes.union(met))


def _forest(batches):
    """Edges (a, b) of one task as (node, root): union-find, the least node as root."""
    up: dict[int, int] = {}

    def find(x):
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = find(x), find(y)
            if x != y:
                up[max(x, y)] = min(x, y)
    nodes = [x for x in up if find(x) != x]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], names=["node", "root"])


def components(edges: DataFrame, at_once: int = EDGES_AT_ONCE) -> DataFrame:
    """node, root (the least node reachable), for the nodes of edges (a, b) other than roots.

    At most at_once edges (counted) are joined in one task. Beyond that every task contracts its own edges, and large and
    small stars alternate over what is left.
    """
    if edges.count() <= at_once:
        return written(edges.select("a", "b").coalesce(1).mapInArrow(_forest, "node long, root long"))
    edges = edges.select("a", "b").mapInArrow(_forest, "a long, b long")
    current = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    while True:
        both = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: larger neighbours go to the least of the node and its neighbours
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        # small star: smaller neighbours and the node itself go to the least neighbour
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).distinct()
        after = written(small)
        # a star forest: every node has one root, and no root has one
        again = after.groupBy("u").count().filter("count > 1").select("u")
        inner = after.select("u").join(after.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
        flat = again.union(inner).limit(1).count() == 0
        drop_written(current)
        current = after
        if flat:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))


def link_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per input row. Tables stored on the way are dropped when nothing reads them any more."""
    with scratch() as made:
        chunks = pack(docs, CHUNK)
        described = written(chunks.mapInArrow(_describe, DESCRIPTION))
        documents, by_class, comp = _link(docs.sparkSession, chunks, described)
        comp = written(comp)
        for t in made:
            if t is not described and t is not comp:
                drop_written(t)
    release(docs.sparkSession)
    return _named(documents, by_class, comp)


def _link(spark, chunks: DataFrame, described: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents, classes of equal sets, and (node, root) of the classes that links connect."""
    documents = described.filter("kind = 0").drop("kind")
    frequent = described.filter("kind = 1").groupBy("gid").agg(F.sum("n").alias("df")).filter(F.col("df") >= HEAVY_IN_ALL).orderBy(F.desc("df"), "gid").limit(HEAVY)
    heavy = spark.sparkContext.broadcast(np.sort(frequent.select("gid").toArrow()["gid"].to_numpy().astype(np.int64).view(_U)))
    # one document of each class of equal sets: the one with the least id
    by_class = documents.filter("n > 0").groupBy("one", "two", "n").agg(F.min(F.struct("doc_id", "gid")).alias("first")).select("one", "two", "n", F.col("first.gid").alias("rep"), F.col("first.doc_id").alias("least"))
    reps = by_class.select(F.col("rep").alias("gid")).withColumn("chunk_id", F.shiftright("gid", 20))
    total = documents.agg(F.sum("n").alias("n")).first()["n"] or 0
    buckets = max(8, min(4096, int(total * 0.7 / BUCKET_SIGNATURES) + 1))
    sent = chunks.groupBy("chunk_id").cogroup(reps.groupBy("chunk_id")).applyInArrow(_send_signatures(heavy, buckets), "bucket int, chunk_id long, payload binary")
    targets = max(8, buckets // BUCKETS_A_TARGET)
    packed = sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_send_candidates(targets), PACKED)
    found = written(packed.repartition(targets, "target").groupBy("target").applyInArrow(_unite, CANDIDATES))
    heavy.unpersist()
    release(spark)
    pairs = found.filter("kind = 0").select("a", "b")
    centres = found.filter("kind = 1").select("a", "b")
    wanted = found.select(F.col("a").alias("gid")).union(found.select("b"))
    sets = sets_of(wanted, chunks)
    drop_written(chunks)
    release(spark)
    links = links_of(pairs, sets)
    if centres.limit(1).count():
        stars = stars_of(centres, sets)
        links = written(links.union(stars.filter("100 * both >= 80 * (n_a + n_b - both)").select("a", "b")))
        release(spark)
        links = links.union(_left_over(stars, links, sets))
        release(spark)
    return documents, by_class, components(links)


def _named(documents: DataFrame, by_class: DataFrame, comp: DataFrame) -> DataFrame:
    """Components are named class by class; documents, of which a class may have very many, meet their class once."""
    rooted = by_class.join(comp, F.col("rep") == F.col("node"), "left").select("one", "two", "n", "least", F.coalesce("root", "rep").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("one", "two", "n", "component_id")
    out = documents.filter("n > 0").join(named, ["one", "two", "n"]).select("doc_id", "n", "component_id")
    out = out.unionByName(documents.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    real = [F.when(F.col(c) != NO_ID, F.col(c)).alias(c) for c in ("doc_id", "component_id")]
    return out.select(real[0], F.col("n").alias("n_shingles"), real[1])


def link_report(docs: DataFrame) -> DataFrame:
    return link_documents(docs)


def keep_one(docs: DataFrame, stored: bool = True) -> DataFrame:
    """The rows of docs without those linked, over any number of links, to a document with a smaller id.

    Exactly one row of each component stays: the one with the least id, null ids last. Rows with equal ids in one component
    count as copies of one document. Rows without words are linked with nothing; of those, only exact repeats with an id go.
    stored=False numbers the rows again at every use instead of storing them; docs must then be read from files.
    """
    names = docs.columns
    settle(docs.sparkSession)
    rows = docs.withColumn("_row", F.monotonically_increasing_id())
    rows = written(rows) if stored else rows
    linked = link_documents(rows.select(F.col("_row").alias("doc_id"), "text")).select(F.col("doc_id").alias("_row"), "n_shingles", "component_id")
    ids = rows.select("_row", "doc_id", F.when(F.col("doc_id").isNotNull(), F.sha2(F.coalesce("text", F.lit("")), 256)).alias("_text")).join(linked, "_row")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))["_row"].alias("_row")
    worded = ids.filter("n_shingles > 0").groupBy("component_id").agg(first).select("_row")
    empty = ids.filter("n_shingles = 0")
    stay = worded.union(empty.filter("doc_id is not null").groupBy("doc_id", "_text").agg(first).select("_row"))
    stay = stay.union(empty.filter("doc_id is null").select("_row"))
    return rows.join(stay, "_row", "left_semi").select(*names)
