"""Centroid clustering with a filter in rotated coordinates.

The principal axes come from sums over all vectors. Each vector is stored once with its whole numbers, its leading
coordinates along these axes and the length of what is left. For a vector x and a centroid c, the squared distance of
the leading coordinates plus the squared difference of the two lengths is at most the squared distance of x and c. In
each round the centroid with the least bound is measured first; only centroids whose bound doesn't exceed that distance
are measured too, in 64-bit whole numbers, so the assignment is exact whatever the axes are.

Sums for new centroids are made per task, then per centroid and component: no group of vectors is ever collected, and
the driver holds the centroids alone.

Defined cases: vectors that are null, of another length, or with a null or non-finite component are left out, and so
are those with a component of 2**27 or more after scaling, whose distances needn't fit into a long; rows that repeat an
id are vectors of their own; a null id is hashed as an empty text; equal hashes go by the vectors' components, then
by chance among equal vectors; fewer vectors than centroids make fewer centroids; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import small_batches, stored

#: Rotated coordinates that are kept, and the largest whole number a component may become.
LEADING, MOST = 16, 2**27
#: Added to bounds for the rounding of doubles, as a share of the squared lengths.
SLACK = 1e-9


def whole_numbers(table: DataFrame, id_col: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(id, v) of the vectors that are kept, components as floor(scale * x)."""
    scaled = F.transform(vector, lambda x: x.cast("double") * scale)
    fine = (F.size(vector) == dims) & F.forall("s", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < MOST))
    return table.select(F.col(id_col).alias("id"), scaled.alias("s"), F.col(vector)).where(fine).select("id", F.transform("s", lambda x: F.floor(x).cast("int")).alias("v"))


def matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def summed(rows: DataFrame, keys: list[str], list_col: str) -> DataFrame:
    """Lists added up place by place: (keys, pos, total)."""
    return rows.select(*keys, F.posexplode(list_col).alias("pos", "x")).groupBy(*keys, "pos").agg(F.sum("x").alias("total"))


def axes(vectors: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The mean and the principal axes as columns, the ones with most variance first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + dims + dims * dims)
        for batch in batches:
            x = matrix(batch.column(0), dims, np.float64)
            total += np.concatenate(([len(x)], x.sum(0), (x.T @ x).ravel()))
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["x"])

    found = np.zeros(1 + dims + dims * dims)
    for row in summed(vectors.select("v").mapInArrow(run, "x array<double>"), [], "x").collect():  # one row a place
        found[row.pos] = row.total
    mean = found[1 : 1 + dims] / max(found[0], 1)
    spread = found[1 + dims :].reshape(dims, dims) / max(found[0], 1) - np.outer(mean, mean)
    return mean, np.linalg.eigh(spread)[1][:, ::-1]


def rotated(vectors: DataFrame, mean: np.ndarray, turn: np.ndarray) -> DataFrame:
    """(id, v, lead, rest): leading coordinates, and the length of the rest."""
    dims = len(mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = (matrix(batch.column(1), dims, np.float64) - mean) @ turn
            lead = pa.array(list(y[:, :LEADING]), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lead, pa.array(np.sqrt((y[:, LEADING:] ** 2).sum(1)))], names=["id", "v", "lead", "rest"])

    return vectors.mapInArrow(run, f"id {vectors.schema['id'].dataType.simpleString()}, v array<int>, lead array<double>, rest double")


def nearest(x: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, c_lead: np.ndarray, c_rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, the smaller number among equally near ones, and the squared distance."""
    own, theirs = (lead**2).sum(1) + rest**2, (c_lead**2).sum(1) + c_rest**2
    bound = own[:, None] + theirs - 2 * (lead @ c_lead.T + np.outer(rest, c_rest))
    bound -= SLACK * (own[:, None] + theirs) + 1e-6
    first = bound.argmin(1)
    distance = np.full(bound.shape, np.iinfo(np.int64).max)
    known = ((x - centroids[first]) ** 2).sum(1)
    distance[np.arange(len(x)), first] = known
    bound[np.arange(len(x)), first] = np.inf
    row, at = np.nonzero(bound <= known[:, None])
    for k in range(0, len(row), 65536):
        r, c = row[k : k + 65536], at[k : k + 65536]
        distance[r, c] = ((x[r] - centroids[c]) ** 2).sum(1)
    found = distance.argmin(1)
    return found, distance[np.arange(len(x)), found]


class Model:
    """Centroids with their rotated coordinates: what goes to every task."""

    def __init__(self, centroids: np.ndarray, mean: np.ndarray, turn: np.ndarray):
        y = (centroids.astype(np.float64) - mean) @ turn
        self.centroids, self.lead, self.rest = centroids, y[:, :LEADING], np.sqrt((y[:, LEADING:] ** 2).sum(1))

    def assign(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = matrix(batch.column(1), self.centroids.shape[1], np.int64)
        lead = matrix(batch.column(2), self.lead.shape[1], np.float64)
        return x, *nearest(x, lead, batch.column(3).to_numpy(), self.centroids, self.lead, self.rest)


def moved(points: DataFrame, model: Model) -> np.ndarray:
    """The centroids after a round: componentwise floor(sum / count); an empty one stays."""
    k, dims = model.centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            x, found, _ = model.assign(batch)
            order = np.argsort(found, kind="stable")
            starts = np.unique(found[order], return_index=True)
            if len(x):
                total[starts[0], :dims] += np.add.reduceat(x[order], starts[1], axis=0)
                total[:, dims] += np.bincount(found, minlength=k)
        some = np.nonzero(total[:, dims])[0]
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some].tolist(), pa.list_(pa.int64()))], names=["cluster", "x"])

    sums = np.zeros((k, dims + 1), np.int64)
    for row in summed(points.mapInArrow(run, "cluster int, x array<bigint>"), ["cluster"], "x").collect():  # one row a centroid and component
        sums[row.cluster, row.pos] = row.total
    some = sums[:, dims] > 0
    out = model.centroids.copy()
    out[some] = sums[some, :dims] // sums[some, dims:]
    return out


def clustered(table: DataFrame, *, id_col: str = "vec_id", vector: str = "embedding", dims: int = 64, scale: int = 256, k: int = 40, rounds: int = 5, seed: str = "2") -> DataFrame:
    """(id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that is kept.

    The first centroids are the k vectors with the smallest sha256 of `seed:id`; after `rounds` rounds the vectors are
    assigned once more.
    """
    spark = table.sparkSession
    small_batches(spark)
    vectors = whole_numbers(table, id_col, vector, dims, scale)
    mean, turn = axes(vectors, dims)
    points = stored(rotated(vectors, mean, turn))
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    starts = points.select(mark.alias("mark"), "v").orderBy("mark", "v").limit(k).collect()
    kind = vectors.schema["id"].dataType.simpleString()
    if not starts:
        return spark.createDataFrame([], f"`{id_col}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = np.array([r.v for r in starts], np.int64)
    for _ in range(rounds):
        centroids = moved(points, Model(centroids, mean, turn))
    model = Model(centroids, mean, turn)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, found, distance = model.assign(batch)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])

    last = stored(points.mapInArrow(run, f"id {kind}, cluster int, distance long"))
    sums = {r.cluster: r.s for r in last.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = spark.createDataFrame([(c, s, sum(sums.values()), digests[c]) for c, s in sums.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return last.join(F.broadcast(facts), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_centroids(spark, sf_dir: str) -> DataFrame:
    return clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def sql(k: int = 40, rounds: int = 5) -> str:
    """DuckDB SQL for the same rows: a pair of steps a round."""
    square = "list_sum(list_transform(range(1, 65), lambda i: ((p.v[i] - c.v[i]) * (p.v[i] - c.v[i]))::HUGEINT))::BIGINT"
    out = rf"""
WITH p AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1)::INT AS cluster, v FROM p QUALIFY cluster < {k})"""
    for r in range(rounds + 1):
        out += f",\na{r} AS MATERIALIZED (SELECT vec_id, any_value(v) AS v, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (SELECT vec_id, p.v AS v, c.cluster, {square} AS d FROM p, c{r} c) GROUP BY vec_id)"
        if r < rounds:
            out += f""",
s{r} AS (SELECT cluster, i, ((sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x FROM a{r}, range(1, 65) t(i) GROUP BY cluster, i),
c{r + 1} AS MATERIALIZED (SELECT cluster, coalesce(n.v, c.v) AS v FROM c{r} c LEFT JOIN (SELECT cluster, list(x ORDER BY i) AS v FROM s{r} GROUP BY cluster) n USING (cluster))"""
    return out + f"""
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c USING (cluster)
"""


OP12_SQL = sql()
