"""Exact k-means on whole numbers with norm-of-sum bounds.

Every vector keeps an upper bound on the distance to its own centroid and a
lower bound for each other one, each with the round in which it was measured.
All centroids of all rounds are kept, so a bound of round T is loosened in round
t by the distance between the centroid of t and that of T, the norm of the total
displacement, which is never more than the sum of the steps between. A centroid
whose loosened bound does not rule it out is measured again, exactly, in whole
numbers; bounds are used only with a margin above the error of floating point,
so every assignment is that of the plain method.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ledgerloom.session import discard, new_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIZE = 64
CLUSTERS = 8
ROUNDS = 10
SEED = 3
#: Components beyond it could make a squared distance that no 64-bit integer holds.
LARGEST = 1 << 27
#: Part of a distance by which a bound has to clear another before it is believed.
MARGIN = 1e-9


def whole_vectors(table: DataFrame, ident: str = "vec_id", vector: str = "embedding", size: int = SIZE) -> DataFrame:
    """``id`` and ``v`` (floor of 1024 times each component) of the vectors with exactly ``size`` components, all finite.

    A component of 2^27 or more after scaling is an error: its squared distances need not fit a 64-bit integer.
    """
    x = F.col(vector)
    fine = x.isNotNull() & (F.size(x) == size) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    v = F.transform(x, lambda c: F.floor(c.cast("double") * 1024.0))
    large = F.raise_error(F.lit(f"a component beyond {LARGEST} after scaling")).cast("array<bigint>")
    v = F.when(F.exists(x, lambda c: F.abs(c.cast("double")) * 1024.0 >= LARGEST), large).otherwise(v)
    return table.filter(fine).select(F.col(ident).alias("id"), v.alias("v"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors with the least SHA-256 of ``seed:id``; of equal ids the lesser vector first, NULL ids last. Fewer vectors than clusters: as many as there are."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = vectors.select("v", digest.alias("d")).orderBy(F.col("d").asc_nulls_last(), "v").limit(clusters).collect()
    return np.array([r["v"] for r in rows], np.int64)


def measured(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``v`` to ``c``, exactly."""
    d = v - c
    return np.einsum("ij,ij->i", d, d)


STATE = "id {id}, v array<bigint>, cluster int, before int, upper double, upper_round int, lower array<double>, lower_round array<int>, measured int"


def assign(v: np.ndarray, history: np.ndarray, own: np.ndarray, upper: np.ndarray, upper_round: np.ndarray, lower: np.ndarray, lower_round: np.ndarray):
    """One round for the rows of ``v``: new cluster, bounds, their rounds, and how many distances were measured for each row.

    ``history`` has the centroids of every round so far (round, cluster,
    component). ``own`` is -1 for a row without bounds.
    """
    t, k = len(history) - 1, history.shape[1]
    now = history[-1]
    drift = np.sqrt(np.square((history - now).astype(float)).sum(-1))  # (round, cluster): norm of the total displacement since that round
    own, upper, upper_round, lower, lower_round = own.copy(), upper.copy(), upper_round.copy(), lower.copy(), lower_round.copy()
    n = np.zeros(len(v), np.int32)
    rows, all_k = np.arange(len(v)), np.arange(k)
    new = own < 0
    low = lower - drift[lower_round, all_k[None, :]]
    low[new] = -np.inf
    high = np.where(new, np.inf, upper + drift[upper_round, np.maximum(own, 0)])
    low[rows[~new], own[~new]] = np.inf  # its own centroid is not a rival

    def rivals(high: np.ndarray, low: np.ndarray) -> np.ndarray:
        return ~(low * (1 - MARGIN) - MARGIN > high[:, None] * (1 + MARGIN))

    open_ = rivals(high, low).any(1)
    # first the upper bound is made exact, which often settles it
    tight = np.flatnonzero(open_ & ~new)
    exact = np.full((len(v), k), -1, np.int64)
    for c in range(k):
        i = tight[own[tight] == c]
        exact[i, c] = measured(v[i], now[c])
    high[tight] = np.sqrt(exact[tight, own[tight]])
    upper[tight], upper_round[tight] = high[tight], t
    n[tight] += 1
    again = rivals(high, low) & open_[:, None]
    for c in range(k):
        i = np.flatnonzero(again[:, c])
        exact[i, c] = measured(v[i], now[c])
        lower[i, c], lower_round[i, c] = np.sqrt(exact[i, c]), t
        n[i] += 1
    looked = np.flatnonzero(again.any(1))
    if len(looked):
        d = np.where(exact[looked] < 0, np.iinfo(np.int64).max, exact[looked])
        best = d.argmin(1)  # the smaller number on ties
        old, least = own[looked], d[np.arange(len(looked)), best]
        moved = (best != old) & (old >= 0)
        # the centroid it leaves was measured in this round
        lower[looked[moved], old[moved]] = np.sqrt(exact[looked[moved], old[moved]])
        lower_round[looked[moved], old[moved]] = t
        own[looked] = best
        upper[looked], upper_round[looked] = np.sqrt(least), t
    return own, upper, upper_round, lower, lower_round, n


def _step(history: np.ndarray, arrow: pa.Schema):
    k = history.shape[1]

    def flat(column: pa.Array, width: int) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)

    def lists(x: np.ndarray) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            v = flat(b.column("v"), history.shape[2])
            if "cluster" in b.schema.names:
                own = b.column("cluster").to_numpy()
                kept = own, b.column("upper").to_numpy(), b.column("upper_round").to_numpy(), flat(b.column("lower"), k), flat(b.column("lower_round"), k)
            else:
                n = len(v)
                own = np.full(n, -1, np.int32)
                kept = own, np.zeros(n), np.zeros(n, np.int32), np.zeros((n, k)), np.zeros((n, k), np.int32)
            new, upper, upper_round, lower, lower_round, n = assign(v, history, *kept)
            columns = [b.column("id"), lists(v), pa.array(new), pa.array(own), pa.array(upper), pa.array(upper_round), lists(lower), lists(lower_round), pa.array(n)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return task


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> tuple[DataFrame, np.ndarray, list[int]]:
    """Rows of ``vectors`` (id, v) with their cluster and bounds, the final centroids, and the distances measured in each round.

    Each round writes its state to the shared folder and drops the one before,
    so a lost executor costs a round at most. The driver holds the centroids of
    all rounds and the sums of each cluster, whose size no data changes; sums
    follow the vectors that changed cluster. Empty clusters stay where they are.
    """
    spark = vectors.sparkSession
    start = first_centroids(vectors, clusters, seed)
    schema = StructType.fromDDL(STATE.format(id=vectors.schema["id"].dataType.simpleString()))
    if not len(start):
        return spark.createDataFrame([], schema), start, []
    arrow = to_arrow_schema(schema)
    history = start[None]
    sums, sizes = [[0] * start.shape[1] for _ in start], [0] * len(start)
    state, path, work = vectors, None, []
    for t in range(rounds + 1):
        following = new_path(spark, "clusters")
        state.mapInArrow(_step(history, arrow), schema).write.parquet(following)
        if path:
            discard(spark, path)
        path = following
        state = spark.read.schema(schema).parquet(path)
        work.append(state.agg(F.sum("measured").alias("n")).first()["n"])
        if t == rounds:
            break
        moved = state.filter("cluster <> before")
        both = moved.select(F.col("cluster").alias("c"), F.lit(1).alias("sign"), "v").unionAll(moved.filter("before >= 0").select("before", F.lit(-1), "v"))
        change = both.select("c", "sign", F.posexplode("v").alias("i", "x")).groupBy("c", "i").agg(F.sum(F.col("sign") * F.col("x")).alias("x"), F.sum("sign").alias("n"))
        for r in change.collect():  # at most clusters x components rows
            sums[r["c"]][r["i"]] += r["x"]
            if r["i"] == 0:
                sizes[r["c"]] += r["n"]
        following_centroids = [[s // n for s in row] if n else history[-1][c].tolist() for c, (row, n) in enumerate(zip(sums, sizes))]
        history = np.concatenate([history, np.array(following_centroids, np.int64)[None]])
    return state, history[-1], work


def clustered(table: DataFrame, ident: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """Per kept vector: the id, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and ``centroid_sha256``.

    Vectors that are NULL, of another length, or with a NULL or non-finite
    component are left out; repeated rows stay; an empty table gives no rows.
    """
    state, centroids, _ = cluster(whole_vectors(table, ident, vector), clusters, rounds, seed)
    spark = table.sparkSession
    # one row per cluster
    names = [(c, [int(x) for x in row], hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest()) for c, row in enumerate(centroids)]
    final = F.broadcast(spark.createDataFrame(names, "cluster int, centre array<bigint>, centroid_sha256 string"))
    apart = F.aggregate(F.zip_with("v", "centre", lambda x, y: (x - y) * (x - y)), F.lit(0).cast("bigint"), lambda s, x: s + x)
    rows = state.select("id", "cluster", "v").join(final, "cluster").select("id", "cluster", apart.alias("distance"), "centroid_sha256")
    sums = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = rows.agg(F.sum("distance").alias("inertia")).scalar()
    return rows.join(F.broadcast(sums), "cluster").select(F.col("id").alias(ident), "cluster", "distance", "cluster_inertia", whole.alias("inertia"), "centroid_sha256")
