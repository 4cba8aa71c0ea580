"""Centroid clustering of whole-number vectors, exact, with Ptolemaic lower bounds.

A few vectors are pivots, fixed for all rounds, and every vector's distances to
them are kept beside it. For a vector x, a centroid c and pivots p, q, Ptolemy's
inequality gives ``d(x, c) >= |d(x, p) d(c, q) - d(x, q) d(c, p)| / d(p, q)``. The
bound is rounded down by more than its rounding errors; centroids that it does
not rule out are compared in whole numbers, so every assignment is exact.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tallyroom.llm.common import schema_of, ship, stored
from tallyroom.llm.topk import usable

#: Components up to this size have squared distances that fit a long (at 64 components and some more).
LARGE = 2**27
#: Relative rounding error allowed for in a product of two kept distances; each is off by 2**-52 at most.
SLACK = 1e-13
#: Sums travel in digits of this many bits, so that they are exact for any finite components and any number of rows.
DIGIT = 40
LONGEST = 2**63 - 1


def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` for a power of two: longs, or Python's integers where any component is large."""
    scaled = np.floor(vectors * float(scale)) if np.abs(vectors).max(initial=0) < 2.0**900 else np.full(1, np.inf)
    if np.abs(scaled).max(initial=0) <= LARGE:
        return scaled.astype(np.int64)
    # Doubles of this size are whole, or small enough to be scaled first.
    return np.array([[math.floor(x * scale) if abs(x) < 2.0**900 else int(x) * scale for x in v] for v in vectors], object)


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``x`` to ``y`` (one vector, or one per row)."""
    apart = x - y
    return np.einsum("ij,ij->i", apart, apart) if apart.dtype != object else (apart * apart).sum(1)


def distances(x: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Rounded distances, a row per vector and a column per row of ``to``; not a number where longs do not hold them."""
    if x.dtype == object or to.dtype == object:
        return np.full((len(x), len(to)), np.nan)
    return np.sqrt(np.stack([squares(x, t) for t in to], 1).astype(float))


def points(rows: list[list[int]]) -> np.ndarray:
    large = any(abs(v) > LARGE for row in rows for v in row)
    return np.array(rows, object if large else np.int64)


class Nearest:
    """The centroids of one round and what pivots say about them."""

    def __init__(self, centroids: list[list[int]], pivots: list[list[int]]) -> None:
        self.centroids = points(centroids)
        at = points(pivots)
        apart = distances(at, at)
        # A pair per pivot, with the farthest other one: the divisor is large then, and so the bound.
        far = np.nan_to_num(apart).argmax(1)
        pairs = {(min(p, q), max(p, q)) for p, q in enumerate(far.tolist()) if apart[p, q] > 0}
        self.pairs = [(p, q, apart[p, q]) for p, q in sorted(pairs)]
        self.known = distances(self.centroids, at)

    def bounds(self, kept: np.ndarray) -> np.ndarray:
        """Lower bounds of the distances from vectors to centroids, from the vectors' kept pivot distances."""
        low = np.zeros((len(kept), len(self.centroids)))
        for p, q, apart in self.pairs:
            one, other = np.outer(kept[:, p], self.known[:, q]), np.outer(kept[:, q], self.known[:, p])
            bound = (np.abs(one - other) - SLACK * (one + other)) / apart * (1 - SLACK)
            low = np.fmax(low, bound)  # what is not a number rules nothing out
        return low

    def assign(self, x: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid, ties to the smaller, squared distance, and how many distances were computed."""
        low = self.bounds(kept)
        first = low.argmin(1)
        cluster, best = first.copy(), squares(x, self.centroids[first])
        if best.dtype == object:
            low[:] = 0
        work = len(x)
        for c, centroid in enumerate(self.centroids):
            limit = np.sqrt(best.astype(float)) * (1 + SLACK) if best.dtype != object else np.inf
            rows = np.flatnonzero((first != c) & (low[:, c] <= limit))
            work += len(rows)
            found = squares(x[rows], centroid)
            nearer = (found < best[rows]) | ((found == best[rows]) & (c < cluster[rows]))
            best[rows[nearer]], cluster[rows[nearer]] = found[nearer], c
        return cluster, best, work


def digits(value: int) -> list[int]:
    """A number in digits of ``DIGIT`` bits, the lowest first; the last one has the sign."""
    out = []
    while not -(1 << DIGIT) <= value < 1 << DIGIT:
        out.append(value & ((1 << DIGIT) - 1))
        value >>= DIGIT
    return [*out, value]


def dense(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


@dataclass
class Clustering:
    """Vectors with their kept pivot distances (a written table) and the centroids they ended with."""

    vectors: DataFrame
    pivots: list[list[int]]
    centroids: list[list[int]]
    scale: int

    def assigned(self) -> DataFrame:
        """Per vector: the key, ``cluster``, and ``distance`` (squared; null beyond a long)."""
        if not self.centroids:
            return self.vectors.select("key").withColumns(
                {"cluster": F.lit(None).cast("int"), "distance": F.lit(None).cast("long")}
            )
        schema = schema_of(self.vectors, ["key"], "cluster int, distance long")
        arrow = to_arrow_schema(schema)
        centroids, pivots, scale = self.centroids, self.pivots, self.scale

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nearest = Nearest(centroids, pivots)
            for batch in batches:
                x, kept = whole(dense(batch.column(1)), scale), dense(batch.column(2))
                cluster, best, _ = nearest.assign(x, kept)
                fits = [int(d) if d <= LONGEST else None for d in best.tolist()]
                columns = [batch.column(0), pa.array(cluster, pa.int32()), pa.array(fits, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

        return self.vectors.mapInArrow(run, schema)


def moved(vectors: DataFrame, nearest: Nearest, scale: int) -> list[list[int]]:
    """The centroids after one round: componentwise ``floor(sum / count)``, empty ones as they were.

    Every task sums its own vectors; what is shuffled, and what the driver
    receives, is one row per centroid, component and digit.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[int]] = {}
        for batch in batches:
            x, kept = whole(dense(batch.column(0)), scale), dense(batch.column(1))
            cluster, _, _ = nearest.assign(x, kept)
            for c in np.unique(cluster).tolist():
                own = x[cluster == c]
                total = [len(own), *own.sum(0).tolist()]
                sums[c] = [a + b for a, b in zip(sums[c], total, strict=True)] if c in sums else total
        rows = [(c, i, j, d) for c, s in sums.items() for i, v in enumerate(s) for j, d in enumerate(digits(v))]
        columns = [list(c) for c in zip(*rows, strict=True)] if rows else [[], [], [], []]
        yield pa.RecordBatch.from_pydict(dict(zip(("cluster", "place", "digit", "value"), columns, strict=True)))

    flat = vectors.select("raw", "kept").mapInArrow(run, "cluster long, place long, digit long, value long")
    sums: dict[tuple[int, int], int] = {}
    for r in flat.groupBy("cluster", "place", "digit").agg(F.sum("value").alias("value")).collect():
        sums[r.cluster, r.place] = sums.get((r.cluster, r.place), 0) + (r.value << DIGIT * r.digit)
    return [
        [sums[c, i] // sums[c, 0] for i in range(1, len(centroid) + 1)] if (c, 0) in sums else centroid
        for c, centroid in enumerate(nearest.centroids.tolist())
    ]


def clustered(
    data: DataFrame, k: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024, seed: str = "3",
    key: str = "vec_id", vector: str = "embedding",
) -> Clustering:
    """Cluster the vectors with exactly ``width`` components, none null or non-finite, scaled and rounded down.

    The first centroids, and the pivots, are the vectors whose key hashes
    lowest with ``seed``; ties (repeated keys) go by the vector. Repeated rows
    each count. A null key is clustered but starts no centroid. With fewer than
    ``k`` such vectors there are as many centroids; with none, or an empty
    table, the result is empty or has null clusters. Ties in distance go to the
    smaller number. Vectors are short by ``width``, so there are no long ones.
    """
    ship(data.sparkSession)
    rows = data.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("raw")).filter(
        (F.size("raw") == width) & usable(F.col("raw"))
    )
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    firsts = rows.filter(F.col("key").isNotNull()).orderBy(hashed, "raw").limit(k).collect()
    starts = [whole(np.array([r.raw], float), scale)[0].tolist() for r in firsts]

    schema = schema_of(rows, ["key", "raw"], "kept array<double>")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = points(starts)
        for batch in batches:
            kept = distances(whole(dense(batch.column(1)), scale), at) if starts else np.empty((batch.num_rows, 0))
            columns = [batch.column(0), batch.column(1), pa.array(list(kept), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    vectors = stored(rows.mapInArrow(run, schema), "vectors")
    centroids = starts
    for _ in range(rounds if starts else 0):
        centroids = moved(vectors, Nearest(centroids, starts), scale)
    return Clustering(vectors, starts, centroids, scale)


def reported(found: Clustering, key: str = "vec_id") -> DataFrame:
    """Per vector: the key, ``cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Sums beyond a long are null, as is a distance beyond it.
    """
    spark = found.vectors.sparkSession
    assigned = stored(found.assigned(), "assigned")
    # A row per centroid reaches the driver.
    sums = assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"), F.count_if(F.col("distance").isNull()).alias("lost")
    )
    totals = {r.cluster: None if r.lost else int(r.total) for r in sums.collect()}
    whole_sum = None if None in totals.values() else sum(totals.values())
    fits = {c: t if t is not None and t <= LONGEST else None for c, t in totals.items()}
    rows = [
        (c, fits.get(c), whole_sum if whole_sum is not None and whole_sum <= LONGEST else None,
         hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest())
        for c, centroid in enumerate(found.centroids)
    ]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row per centroid, whatever the data.
    return assigned.join(F.broadcast(about), "cluster").select(
        F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def sql(k: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024, seed: str = "3") -> str:
    """The report as DuckDB SQL over ``embeddings``, a row per component, the rounds one after the other."""
    finite = "list_count(list_filter(embedding, lambda x: x is not null and not isnan(x) and not isinf(x)))"
    parts = [
        f"""kept as materialized (
            select row_number() over () as row_no, vec_id,
                   list_transform(embedding, lambda x: cast(floor({scale} * cast(x as double)) as bigint)) as v
            from embeddings where len(embedding) = {width} and {finite} = {width})""",
        """flat as materialized (
            select row_no, unnest(range(1, len(v) + 1)) as place, unnest(v) as x from kept)""",
        f"""c0 as materialized (
            select row_number() over (order by h, v) - 1 as cluster, v from (
                select sha256('{seed}:' || vec_id) as h, v from kept where vec_id is not null order by h, v limit {k}))""",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""f{r} as (select cluster, unnest(range(1, len(v) + 1)) as place, unnest(v) as c from c{r}),
            a{r} as materialized (
                select row_no, min_by(cluster, (d, cluster)) as cluster, min(d) as distance from (
                    select row_no, cluster, sum((x - c) * (x - c)) as d
                    from flat join f{r} using (place) group by row_no, cluster) group by row_no)"""
        )
        if r < rounds:
            floored = "(s - ((s % n) + n) % n) // n"
            parts.append(
                f"""c{r + 1} as materialized (
                    select cluster, coalesce(new.v, old.v) as v from c{r} old left join (
                        select cluster, list(cast({floored} as bigint) order by place) as v from (
                            select cluster, place, sum(x) as s, count(*) as n
                            from a{r} join flat using (row_no) group by cluster, place)
                        group by cluster) new using (cluster))"""
            )
    last = rounds
    return f"""with {", ".join(parts)}
        select vec_id, cast(cluster as int) as cluster, cast(distance as bigint) as distance,
               cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia,
               cast(sum(distance) over () as bigint) as inertia,
               sha256(array_to_string(c{last}.v, ',')) as centroid_sha256
        from a{last} join kept using (row_no) join c{last} using (cluster)"""
