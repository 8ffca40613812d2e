"""Approximate nearest neighbours by adaptive dimension scan within probed lists.

Nearness is the largest inner product. Adding one dimension, sqrt(M - |x|^2) with M the largest squared length, turns
it into the least Euclidean distance, which a fixed random rotation keeps.

Index. Equal vectors are one class, which keeps its TOP + 1 smallest ids: more can never be among the TOP of anything.
k-means on at most SAMPLE classes (those with the least id hash; a documented bound on training only) gives the lists,
about one for every LIST_ROWS classes; every class is then assigned to its nearest list. Rotated vectors lie in column
blocks of BLOCK dimensions.

Search. Each query class probes the lists whose centres are nearest: PROBE_SHARE of them, and PROBES at least (vectors
without clusters need that for a recall of 0.9; lower it for clustered ones). Lists are grouped into blocks of LISTS_IN_BLOCK
and blocks cut into parts of PART_ROWS classes, so no list is one task and a query is sent to a block once. Within a
list, partial distances to all probing queries are computed one column block after the other. After each, a
candidate is dropped whose partial distance, scaled up by a hypothesis test on the rotated dimensions seen so far, lies
above the query's bound. The bound is the query's distance to its (TOP + 2)-th nearest of BOUND_ROWS sample vectors,
computed once a query: never below the distance that is looked for. What survives all blocks is scored on the
original vectors in double precision; parts pass on their TOP + 1 classes for each query.

Vectors that are null, zero, of another length than most, or that hold null or non-finite components take no part. A
null id takes no part. Repeated rows are candidates each, and ask once. One id with
different vectors is not supported: where it is the least of both, their classes get the same number. Tables with fewer candidates than TOP return them all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickframe.llm.common import written

TOP = 20
SAMPLE = 16_384
BOUND_ROWS = 8_192
LIST_ROWS = 256
MAX_LISTS = 1_024
PROBES = 32
PROBE_SHARE = 0.6
LISTS_IN_BLOCK = 16
#: Of its so many nearest lists a query drops nothing, so that it always finds TOP.
WHOLE = 3
PART_ROWS = 8_192
BLOCK = 16
#: Standard deviations that a partial distance may lie above the bound.
EPSILON = 1.5
#: Below this share of candidates left, the rest of their dimensions is computed for each alone.
SPARSE = 0.1
SALTS = 32


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, v: the rows that take part."""
    v = F.col(vec_col)
    finite = F.forall(v, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    rows = vectors.filter(F.col(id_col).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("v"))
    common = rows.groupBy(F.size("v").alias("s")).count().orderBy(F.desc("count"), "s").limit(1).collect()
    return rows.filter(F.size("v") == (common[0]["s"] if common else -1))


def classes_of(rows: DataFrame) -> DataFrame:
    """cid (the least id), v, ids (the TOP + 1 least ids with repeats) of each distinct vector; salted, so that no vector is one task's."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(SALTS)))
    w = Window.partitionBy("v", "salt").orderBy("vec_id")
    least = salted.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= TOP + 1)
    again = Window.partitionBy("v").orderBy("vec_id")
    least = least.withColumn("r", F.row_number().over(again)).filter(F.col("r") <= TOP + 1)
    return least.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("cid", F.col("ids")[0])


class Index:
    """Rotation, centres and bounds sample, made on the driver from a bounded sample."""

    def __init__(self, sample: np.ndarray, largest: float, n: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.largest = largest
        d = sample.shape[1] + 1
        self.rotation = np.linalg.qr(rng.standard_normal((d, d)))[0]
        x = self.lift(sample)
        k = int(min(MAX_LISTS, max(1, n // LIST_ROWS), len(x)))
        self.centres = x[np.sort(rng.choice(len(x), k, replace=False))]
        for _ in range(12):
            near = self.lists(x, 1)[:, 0]
            sums, count = np.zeros_like(self.centres), np.bincount(near, minlength=k)
            np.add.at(sums, near, x)
            self.centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], self.centres)
        self.bound_rows = x[:BOUND_ROWS]

    def lift(self, v: np.ndarray) -> np.ndarray:
        """Rotated vectors with one dimension more."""
        more = np.sqrt(np.maximum(self.largest - (v * v).sum(axis=1), 0))
        return np.concatenate([v, more[:, None]], axis=1) @ self.rotation

    def ask(self, v: np.ndarray) -> np.ndarray:
        return np.concatenate([v, np.zeros((len(v), 1))], axis=1) @ self.rotation

    @staticmethod
    def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * a @ b.T, 0)

    def lists(self, x: np.ndarray, n: int) -> np.ndarray:
        d = self.distances(x, self.centres)
        n = min(n, d.shape[1])
        near = np.argpartition(d, n - 1, axis=1)[:, :n]
        return np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, axis=1), axis=1), axis=1)

    def bounds(self, q: np.ndarray) -> np.ndarray:
        if len(self.bound_rows) < TOP + 2:
            return np.full(len(q), np.inf)
        return np.partition(self.distances(q, self.bound_rows), TOP + 1, axis=1)[:, TOP + 1] * (1 + 1e-9)


def _matrix(column) -> np.ndarray:
    if hasattr(column, "combine_chunks"):
        column = column.combine_chunks()
        column = column.chunk(0) if hasattr(column, "num_chunks") and column.num_chunks else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def scan(index: Index, x: np.ndarray, cids: np.ndarray, q: np.ndarray, qids: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Query, candidate and score of the best TOP + 1 candidates of each query; and the partial products computed."""
    lifted, asked = index.lift(x), index.ask(q)
    dims, work = lifted.shape[1], 0
    found = ([], [], [])

    def below(partial, seen, limit):
        return partial * (dims / seen) <= limit * ((1 + EPSILON / np.sqrt(seen)) ** 2 if seen < dims else 1 + 1e-9)

    step = max(1, 2_000_000 // max(1, len(x)))
    for at in range(0, len(q), step):
        a, limit = asked[at : at + step], bound[at : at + step]
        part, seen, ok = 0.0, 0, None
        while seen < dims and (ok is None or ok.mean() > SPARSE):
            cols = slice(seen, min(seen + BLOCK, dims))
            part = part + Index.distances(a[:, cols], lifted[:, cols])
            work += part.size * (cols.stop - seen)
            seen = cols.stop
            ok = below(part, seen, limit[:, None])
        qi, xi = np.nonzero(ok)
        partial = part[qi, xi]
        while seen < dims and len(qi):
            cols = slice(seen, min(seen + BLOCK, dims))
            diff = a[qi, cols] - lifted[xi, cols]
            partial = partial + (diff * diff).sum(axis=1)
            work += diff.size
            seen = cols.stop
            ok = below(partial, seen, limit[qi])
            qi, xi, partial = qi[ok], xi[ok], partial[ok]
        score = (q[at + qi] * x[xi]).sum(axis=1)
        order = np.lexsort((cids[xi], -score, qi))
        qi, xi, score = qi[order], xi[order], score[order]
        rank = np.arange(len(qi)) - np.searchsorted(qi, qi, side="left")
        keep = rank <= TOP
        for out, v in zip(found, (qids[at + qi[keep]], cids[xi[keep]], score[keep])):
            out.append(v)
    return *(np.concatenate(v) if v else np.zeros(0) for v in found), work


def nearest(vectors: DataFrame, every: int = 20, probe_share: float = PROBE_SHARE, top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest of every row whose id is divisible by every, among all other rows."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    classes = written(classes_of(rows))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    n, largest = classes.agg(F.count("*"), F.max(square)).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = classes.select("v", F.xxhash64("cid").alias("h"), "cid").orderBy("h", "cid").limit(SAMPLE).select("v").toArrow()
    shared = spark.sparkContext.broadcast(Index(_matrix(sample["v"]), float(largest), n))

    def assign(batches):
        for b in batches:
            near = shared.value.lists(shared.value.lift(_matrix(b.column(1))), 1)[:, 0] if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(near.astype(np.int32))], names=["cid", "v", "list"])

    placed = written(classes.select("cid", "v").mapInArrow(assign, "cid long, v array<double>, list int"))
    block = F.floor(F.col("list") / LISTS_IN_BLOCK).cast("int")
    sizes = {r["block"]: r["count"] for r in placed.groupBy(block.alias("block")).count().collect()}  # at most MAX_LISTS / LISTS_IN_BLOCK rows
    parts = F.create_map(*[F.lit(x).cast("int") for k, c in sizes.items() for x in (k, -(-c // PART_ROWS))])
    data = placed.withColumn("block", block).withColumn("part", F.pmod(F.xxhash64("cid"), F.element_at(parts, F.col("block"))).cast("int"))
    asking = written(rows.filter(F.pmod("vec_id", F.lit(every)) == 0).join(classes.select("cid", "v"), "v").select("vec_id", "cid").distinct())
    wanted = classes.select("cid", "v").join(asking.select("cid").distinct(), "cid")

    def probe(batches):
        for b in batches:
            if not b.num_rows:
                continue
            asked = shared.value.ask(_matrix(b.column(1)))
            near = shared.value.lists(asked, max(PROBES, int(np.ceil(probe_share * len(shared.value.centres)))))
            where = pa.array([np.unique(x // LISTS_IN_BLOCK).tolist() for x in near], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(near.astype(np.int32).tolist(), pa.list_(pa.int32())), where, pa.array(shared.value.bounds(asked))], names=["cid", "v", "lists", "blocks", "bound"])

    probing = wanted.mapInArrow(probe, "cid long, v array<double>, lists array<int>, blocks array<int>, bound double").withColumn("block", F.explode("blocks")).drop("blocks")
    probing = probing.filter(F.element_at(parts, F.col("block")).isNotNull())
    probing = probing.withColumn("part", F.explode(F.sequence(F.lit(0), F.element_at(parts, F.col("block")) - 1)))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
        if len(left) and len(right):
            x, cids, lists = _matrix(left["v"]), left["cid"].to_numpy(), left["list"].to_numpy()
            q, qids, bound = _matrix(right["v"]), right["cid"].to_numpy(), right["bound"].to_numpy()
            probed = [np.array(p) for p in right["lists"].to_pylist()]
            owner = np.repeat(np.arange(len(probed)), [len(p) for p in probed])
            flat = np.concatenate(probed)
            first = np.concatenate([np.arange(len(p)) < WHOLE for p in probed])
            for k in np.unique(lists):
                mine, ask = np.flatnonzero(lists == k), owner[flat == k]
                if len(ask):
                    limit = np.where(first[flat == k], np.inf, bound[ask])
                    got = scan(shared.value, x[mine], cids[mine], q[ask], qids[ask], limit)
                    for o, v in zip(out, got):
                        o.append(v)
        q, c, s = (np.concatenate(o) for o in out)
        order = np.lexsort((c, -s, q))  # the best of the part, not of each list
        q, c, s = q[order], c[order], s[order]
        keep = np.arange(len(q)) - np.searchsorted(q, q, side="left") <= TOP
        return pa.table({"query": q[keep].astype(np.int64), "cid": c[keep].astype(np.int64), "score": s[keep].astype(np.float64)})

    keys = ["block", "part"]
    hits = data.select(*keys, "list", "cid", "v").groupBy(*keys).cogroup(probing.select(*keys, "cid", "v", "lists", "bound").groupBy(*keys)).applyInArrow(search, "query long, cid long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "cid")
    hits = hits.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= top + 1)
    named = hits.join(classes.select("cid", "ids"), "cid").select("query", "score", F.col("cid").alias("found"), F.explode("ids").alias("vec_id"))
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    named = named.withColumn("r", F.row_number().over(ranked)).filter(F.col("r") <= top + 1)
    # the query's own row is dropped once; rows that repeat its id are not its own
    asked = asking.select(F.col("vec_id").alias("query_id"), "cid")
    pairs = asked.join(named.select(F.col("query").alias("cid"), "score", "found", "vec_id"), "cid")
    pairs = pairs.withColumn("own", (F.col("vec_id") == F.col("query_id")) & (F.col("found") == F.col("cid")))
    pairs = pairs.withColumn("nth", F.row_number().over(Window.partitionBy("query_id", "cid", "own").orderBy("vec_id")))
    pairs = pairs.filter(~(F.col("own") & (F.col("nth") == 1)))
    last = Window.partitionBy("query_id", "cid").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= top).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
