"""Exact top-k search by a Voronoi join.

The largest inner product becomes the smallest distance by one more component
that gives all vectors the same length. Pivots split the space into cells. From
a few numbers per cell follows how far the k-th neighbour of any query of a
group can be, and so which vectors that group can need; only those are copied
to it, and the group is solved there, exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.llm.common import in_units, matrix, ranked, ship, stored

#: Pivots: one for so many vectors, up to a bound, as all their distances are kept.
PER_PIVOT, PIVOTS = 500, 128
#: Queries of a group and vectors of a slice of a group, about.
GROUP, SLICE = 1024, 16_384
#: Vectors multiplied at once.
STEP = 2048
LARGEST = 2**63 - 1


def usable(vector: Column) -> Column:
    """Neither null nor holding null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def quantised(vector: Column, scale: int = 256) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


class Cells:
    """Pivots with the extra component, for vectors of one length."""

    def __init__(self, pivots: np.ndarray, top: float) -> None:
        self.top = top
        self.pivots = self.lifted(pivots)
        self.apart = np.sqrt(np.maximum(self._squares(self.pivots), 0))

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Data vectors, all of the length ``sqrt(top)``."""
        return np.c_[x, np.sqrt(np.maximum(self.top - (x * x).sum(1), 0))]

    def _squares(self, x: np.ndarray) -> np.ndarray:
        return (x * x).sum(1)[:, None] + (self.pivots**2).sum(1) - 2 * x @ self.pivots.T

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell = self._squares(x).argmin(1)
        return cell, np.sqrt(((x - self.pivots[cell]) ** 2).sum(1))


def bounds(
    cells: Cells, reach: np.ndarray, nearest: list[list[tuple[float, int]]], k: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each cell with queries (rows) and each cell (columns): the distances to the pivot that can matter.

    ``reach`` is the largest distance of a cell's queries to its pivot, below
    zero without queries; ``nearest`` has each cell's smallest distances of
    vectors to its pivot, one for an id. Neighbours of one id more than ``k``
    are bounded, as the query's own rows, however many, may be one.
    """
    count = len(reach)
    low, high = np.full((count, count), np.inf), np.full((count, count), -np.inf)
    cell = np.repeat(np.arange(count), [len(n) for n in nearest])
    near = np.array([d for n in nearest for d, _ in n])
    _, id_ = np.unique(np.array([i for n in nearest for _, i in n], np.int64), return_inverse=True)
    for i in np.flatnonzero(reach >= 0):
        of_id = np.full(id_.max(initial=-1) + 1, np.inf)
        np.minimum.at(of_id, id_, reach[i] + cells.apart[i][cell] + near)
        far = np.sort(of_id)
        worst = far[k] if len(far) > k else np.inf
        slack = 1e-6 * (1 + reach[i] + cells.apart[i].max() + (worst if np.isfinite(worst) else 0))
        low[i] = cells.apart[i] - reach[i] - worst - slack
        high[i] = cells.apart[i] + reach[i] + worst + slack
    return low, high


def exact_scores(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers. Doubles are exact up to 2**53; beyond, Python's integers are used."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(data).max(initial=0)) * max(1, queries.shape[1])
    if most < 2**53:
        return (queries.astype(float) @ data.astype(float).T).astype(np.int64)
    exact = queries.astype(object) @ data.astype(object).T
    return np.clip(exact, -LARGEST - 1, LARGEST).astype(np.int64)


class Best:
    """The best ``k`` of each query so far, ties to the smaller id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> None:
        self.ids, self.vectors, self.k = ids, vectors, k
        self.query = self.found = self.score = np.empty(0, np.int64)
        self.least = np.full(len(ids), -LARGEST - 1)

    def add(self, ids: np.ndarray, data: np.ndarray) -> None:
        scores = exact_scores(self.vectors, data)
        hit = self.ids[:, None] != ids
        if len(ids) > self.k:
            # All that reach a query's k-th score here, its own rows left out, ties included.
            kth = np.partition(np.where(hit, scores, -LARGEST - 1), -self.k, axis=1)[:, -self.k]
            hit &= scores >= np.maximum(kth, self.least)[:, None]
        query, place = np.nonzero(hit)
        query = np.r_[self.query, query]
        found = np.r_[self.found, ids[place]]
        score = np.r_[self.score, scores[hit]]
        # By query, then the score from the highest (~ turns the order without overflow), then the id.
        order = np.lexsort((found, ~score, query))
        query, found, score = query[order], found[order], score[order]
        starts = np.searchsorted(query, query)
        rank = np.arange(len(query)) - starts
        kept = rank < self.k
        self.query, self.found, self.score = query[kept], found[kept], score[kept]
        full = rank[kept] == self.k - 1
        self.least[self.query[full]] = self.score[full]


def top_k(
    data: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` largest inner products, all if there are fewer.

    ``data`` holds the candidates, and the queries are its rows with
    ``is_query``; rows with the query's id are its own. Vectors are scaled and
    rounded down to whole numbers, and scores are exact (held within a long).
    Vectors with another number of components are never compared. Null keys
    take no part, exact repeats of a row count once, and an empty table gives
    an empty table.
    """
    rows = data.select(
        F.col(f"`{key}`").cast("long").alias("vec_id"),
        F.col(f"`{vector}`").alias("raw"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    ).filter(F.col("vec_id").isNotNull() & usable(F.col("raw")))
    rows = rows.select("vec_id", quantised(F.col("raw"), scale).alias("vector"), "is_query")
    rows = stored(rows.distinct().withColumn("dim", F.size("vector")), "topk-vectors")
    # One row per vector length.
    lengths = [r.dim for r in rows.groupBy("dim").agg(F.count("*")).collect()]
    found = [_of_length(rows.filter(F.col("dim") == d).drop("dim"), d, k) for d in sorted(lengths) if d > 0]
    if not found:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    everything = found[0]
    for f in found[1:]:
        everything = everything.union(f)
    return ranked(everything, k)


def _of_length(rows: DataFrame, dim: int, k: int) -> DataFrame:
    ship(rows.sparkSession)
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    total, asked, top = rows.agg(F.count("*"), F.count_if("is_query"), F.max(squares)).first()
    count = max(1, min(PIVOTS, total // PER_PIVOT))
    chance = F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(1 << 30))
    sample = rows.filter(chance <= int((1 << 30) * min(1.0, 2 * (count + 8) / total))).select("vector")
    pivots = np.array([r.vector for r in sample.limit(count).collect() or rows.select("vector").limit(1).collect()], float)
    cells = Cells(pivots, float(top))

    def assign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1), float)
            cell, away = cells.nearest(cells.lifted(x))
            asks = batch.column(2).to_numpy(zero_copy_only=False)
            # A query has no extra component, so its distances differ from its row's.
            cell_q, away_q = cells.nearest(np.c_[x, np.zeros(len(x))])
            made = [cell.astype(np.int32), away, np.where(asks, cell_q, -1).astype(np.int32), away_q]
            arrays = [batch.column(0), batch.column(1), *map(pa.array, made)]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "vector", "cell", "away", "cell_q", "away_q"])

    schema = "vec_id long, vector array<long>, cell int, away double, cell_q int, away_q double"
    placed = stored(rows.select("vec_id", "vector", "is_query").mapInArrow(assign, schema), "topk-cells")

    # Summaries: k + 1 numbers per cell, of different ids, and one per cell of queries.
    order = Window.partitionBy("cell").orderBy("away", "vec_id")
    closest = placed.groupBy("cell", "vec_id").agg(F.min("away").alias("away")).withColumn("n", F.row_number().over(order))
    nearest: list[list[tuple[float, int]]] = [[] for _ in pivots]
    for r in closest.filter(F.col("n") <= k + 1).collect():
        nearest[r.cell].append((r.away, r.vec_id))
    reach, asking = np.full(len(pivots), -1.0), np.zeros(len(pivots), np.int64)
    for r in placed.filter("cell_q >= 0").groupBy("cell_q").agg(F.max("away_q").alias("u"), F.count("*").alias("n")).collect():
        reach[r.cell_q], asking[r.cell_q] = r.u, r.n
    low, high = bounds(cells, reach, nearest, k)

    # Groups of cells with about GROUP queries, neighbouring pivots together; a larger cell is cut by ids.
    group_of: list[list[int]] = [[] for _ in pivots]
    members: list[list[int]] = []
    room = 0
    for i in sorted(np.flatnonzero(asking).tolist(), key=lambda i: (cells.apart[i].argsort(kind="stable")[:2].tolist(), i)):
        parts = -(-int(asking[i]) // GROUP)
        for _ in range(parts):
            if room < asking[i] / parts or parts > 1:
                members.append([])
                room = GROUP
            members[-1].append(i)
            group_of[i].append(len(members) - 1)
            room -= asking[i] / parts
    slices = max(1, -(-total // SLICE))
    first = np.array([g[0] if g else -1 for g in group_of])
    parts_of = np.array([max(1, len(g)) for g in group_of])

    def deal(batches):
        """Queries to every slice of their group, vectors to the groups that can need them."""
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, cell, away, cell_q = (batch.column(i).to_numpy() for i in (0, 2, 3, 4))
            spread = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            for kind in (0, 1):
                if kind == 0:
                    row = np.flatnonzero(cell_q >= 0)
                    group = first[cell_q[row]] + spread[row] % parts_of[cell_q[row]]
                    row, group = np.repeat(row, slices), np.repeat(group, slices)
                    slice_ = np.tile(np.arange(slices), len(row) // slices)
                else:
                    needed = [
                        np.flatnonzero(((low[m][:, cell] <= away) & (away <= high[m][:, cell])).any(0)) for m in members
                    ]
                    row = np.concatenate(needed) if needed else np.empty(0, np.int64)
                    group = np.repeat(np.arange(len(needed)), [len(n) for n in needed])
                    slice_ = spread[row] % slices
                for a in range(0, len(row), 8192):
                    r = row[a : a + 8192]
                    arrays = [
                        pa.array(group[a : a + 8192] * slices + slice_[a : a + 8192]),
                        pa.array(np.full(len(r), kind, np.int32)),
                        batch.column(0).take(pa.array(r)),
                        batch.column(1).take(pa.array(r)),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, names=["unit", "kind", "vec_id", "vector"])

    dealt = placed.mapInArrow(deal, "unit long, kind int, vec_id long, vector array<long>")
    names = ["query_id", "vec_id", "score"]

    def make():
        queries: list[tuple[np.ndarray, np.ndarray]] = []
        best: list[Best] = []

        def each(unit, batch):
            if batch is None:
                made = best[0] if best else None
                queries.clear()
                best.clear()
                if made is None or not len(made.query):
                    return []
                arrays = [pa.array(x) for x in (made.ids[made.query], made.found, made.score)]
                return [pa.RecordBatch.from_arrays(arrays, names=names)]
            kind, ids, x = batch.column(1).to_numpy(), batch.column(2).to_numpy(), matrix(batch.column(3), np.int64)
            asks = kind == 0
            if asks.any():
                queries.append((ids[asks], x[asks]))
            ids, x = ids[~asks], x[~asks]
            if len(ids) and queries and not best:
                best.append(Best(np.concatenate([q for q, _ in queries]), np.concatenate([v for _, v in queries]), k))
            for a in range(0, len(ids) if best else 0, STEP):
                best[0].add(ids[a : a + STEP], x[a : a + STEP])
            return []

        return each

    return in_units(dealt, "unit", ["kind"], max(1, len(members)) * slices, make, "query_id long, vec_id long, score long")


#: The contract's search in DuckDB.
SQL = """
with usable as (
    select distinct vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0
),
scores as (
    select q.vec_id as query_id, b.vec_id,
           list_inner_product(q.v::double[], b.v::double[])::bigint as score
    from usable q join usable b on q.vec_id <> b.vec_id and len(q.v) = len(b.v)
    where q.vec_id % 50 = 0
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from scores
qualify rank <= 5
"""
