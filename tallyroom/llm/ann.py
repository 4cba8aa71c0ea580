"""Approximate nearest neighbours by hierarchical navigable small-world graphs, one per shard.

A shard's graph is a few flat arrays: the vectors, and per level the nodes and
their neighbours. Many queries walk a graph in step, so each step is a handful
of array operations. The best of all shards are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.llm.common import in_units, matrix, ranked, ship, stored
from tallyroom.llm.topk import usable

#: Distinct vectors of a shard, about.
SHARD = 8192
#: Neighbours of a node at level 0; half as many above.
LINKS = 32
#: Candidates kept while building, and while searching.
EF_BUILD, EF_SEARCH = 64, 96
#: Nodes inserted together, and queries searched together.
BATCH = 256
#: Queries of one pass over a shard's graph; more are dealt to copies of it.
PASS = 65_536


class Graph:
    """Vectors in rows, and per level the neighbours of each row, -1 where there is none.

    Similarity is the inner product. One more component, zero in queries, gives
    the rows of a shard one length, so that similar also means near and the
    graph is that of a metric.
    """

    def __init__(self, vectors: np.ndarray, levels: list[np.ndarray]) -> None:
        self.vectors, self.levels = vectors, levels

    @staticmethod
    def lifted(vectors: np.ndarray) -> np.ndarray:
        # Scaled first, so that squares of large components stay finite.
        scale = np.abs(vectors).max(initial=0.0) or 1.0
        x = vectors / scale
        squares = (x * x).sum(1)
        return np.c_[x, np.sqrt(np.maximum(squares.max(initial=0.0) - squares, 0))].astype(np.float32)

    def walk(self, level: int, queries: np.ndarray, entry: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """Each query's ``ef`` most similar rows that a best-first walk from ``entry`` meets, best first."""
        links, n = self.levels[level], len(queries)
        every = np.arange(n)
        ids = np.full((n, ef), -1)
        similar = np.full((n, ef), -np.inf, np.float32)
        open_ = np.zeros((n, ef), bool)
        seen = np.zeros((n, len(self.vectors)), bool)
        width = min(entry.shape[1], ef)
        ids[:, :width] = entry[:, :width]
        there = ids[:, :width] >= 0
        similar[:, :width] = np.where(
            there, np.einsum("ijk,ik->ij", self.vectors[ids[:, :width]], queries), -np.inf
        )
        open_[:, :width] = there
        rows, columns = np.nonzero(there)
        seen[rows, ids[rows, columns]] = True
        while True:
            # The open candidate that is best, while there is one.
            hope = np.where(open_, similar, -np.inf)
            at = hope.argmax(1)
            active = np.flatnonzero(hope[every, at] > -np.inf)
            if not len(active):
                break
            node = ids[active, at[active]]
            open_[active, at[active]] = False
            near = links[node]
            new = (near >= 0) & ~seen[active[:, None], near]
            r, c = np.nonzero(new)
            if not len(r):
                continue
            seen[active[r], near[r, c]] = True
            got = np.full(near.shape, -np.inf, np.float32)
            got[r, c] = np.einsum("ij,ij->i", self.vectors[near[r, c]], queries[active[r]])
            worth = (got > similar[active].min(1)[:, None]).any(1)
            active, near, got, new = active[worth], near[worth], got[worth], new[worth]
            all_similar = np.c_[similar[active], got]
            all_ids = np.c_[ids[active], np.where(new, near, -1)]
            all_open = np.c_[open_[active], new]
            best = np.argpartition(-all_similar, ef - 1, axis=1)[:, :ef]
            similar[active] = np.take_along_axis(all_similar, best, 1)
            ids[active] = np.take_along_axis(all_ids, best, 1)
            open_[active] = np.take_along_axis(all_open, best, 1)
        order = np.argsort(-similar, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(similar, order, 1)

    def search(self, queries: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """From the top level down; row 0 is a node of every level."""
        entry = np.zeros((len(queries), 1), np.int64)
        for level in range(len(self.levels) - 1, 0, -1):
            entry = self.walk(level, queries, entry, 1)[0]
        return self.walk(0, queries, entry, ef)

    def spread(self, nodes: np.ndarray, candidates: np.ndarray, similar: np.ndarray, most: int) -> np.ndarray:
        """Up to ``most`` neighbours per node: nearer to it than to those chosen before, then the nearest others."""
        n, width = candidates.shape
        x = self.vectors[np.maximum(candidates, 0)]
        between = np.matmul(x, x.transpose(0, 2, 1))
        there = (candidates >= 0) & (candidates != nodes[:, None])
        chosen = np.zeros((n, width), bool)
        count = np.zeros(n, np.int64)
        for k in range(width):
            clear = ~(chosen & (between[:, k, :] >= similar[:, k, None])).any(1)
            take = there[:, k] & clear & (count < most)
            chosen[:, k] = take
            count += take
        # Chosen ones first, then the others, each in order of similarity.
        order = np.argsort(np.where(chosen, 0, np.where(there, 1, 2)) * width + np.arange(width), axis=1)[:, :most]
        kept = np.take_along_axis(np.where(there, candidates, -1), order, 1)
        return kept if kept.shape[1] == most else np.c_[kept, np.full((n, most - kept.shape[1]), -1)]

    def link(self, level: int, nodes: np.ndarray, near: np.ndarray) -> None:
        """Set the neighbours of new nodes, and the links back; a full list is chosen anew."""
        links = self.levels[level]
        links[nodes] = near
        r, c = np.nonzero(near >= 0)
        target, source = near[r, c], nodes[r]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        owner, start = np.unique(target, return_index=True)
        count = np.diff(np.r_[start, len(target)])
        place = np.arange(len(target)) - np.repeat(start, count)
        # Lists of like length together, so that one long list does not widen all.
        for low in (0, 8, 64, 512):
            pick = np.flatnonzero((count > low) & (count <= (low * 8 or 8)))
            if not len(pick):
                continue
            wide = np.full((len(pick), int(count[pick].max())), -1)
            position = np.full(len(owner), -1)
            position[pick] = np.arange(len(pick))
            mine = np.flatnonzero(position[np.repeat(np.arange(len(owner)), count)] >= 0)
            wide[position[np.searchsorted(owner, target[mine])], place[mine]] = source[mine]
            old = links[owner[pick]]
            fresh = (wide >= 0) & ~(wide[:, :, None] == old[:, None, :]).any(2)
            both = np.c_[old, np.where(fresh, wide, -1)]
            similar = np.einsum("ijk,ik->ij", self.vectors[np.maximum(both, 0)], self.vectors[owner[pick]])
            best = np.argsort(-np.where(both >= 0, similar, -np.inf), axis=1, kind="stable")
            both, similar = np.take_along_axis(both, best, 1), np.take_along_axis(similar, best, 1)
            full = (both >= 0).sum(1) > links.shape[1]
            links[owner[pick[~full]]] = both[~full, : links.shape[1]]
            crowded = np.flatnonzero(full)
            for a in range(0, len(crowded), 512):
                part = crowded[a : a + 512]
                nodes = owner[pick[part]]
                links[nodes] = self.spread(nodes, both[part], similar[part], links.shape[1])


def build(vectors: np.ndarray, links: int = LINKS, ef: int = EF_BUILD, seed: int = 1) -> Graph:
    """Insert the rows in batches that grow with the graph; rows are expected to be distinct."""
    n = len(vectors)
    rng = np.random.default_rng(seed)
    height = np.minimum(np.floor(-np.log(rng.random(n)) / math.log(links / 2)).astype(int), 8)
    height[0] = height.max(initial=0)
    graph = Graph(
        Graph.lifted(vectors),
        [np.full((n, links if level == 0 else links // 2), -1) for level in range(int(height[0]) + 1)],
    )
    done = 1
    while done < n:
        nodes = np.arange(done, min(n, done + min(BATCH, done)))
        x = graph.vectors[nodes]
        inside = x @ x.T
        np.fill_diagonal(inside, -np.inf)
        entry = np.zeros((len(nodes), 1), np.int64)
        for level in range(len(graph.levels) - 1, -1, -1):
            here = np.flatnonzero(height[nodes] >= level)
            ids, similar = graph.walk(level, x, entry, ef if len(here) else 1)
            entry = ids[:, : max(1, ef // 4)]
            if not len(here):
                continue
            # The batch's own nodes of this level are candidates too.
            peers = here[np.argsort(-inside[np.ix_(here, here)], axis=1, kind="stable")[:, : ef // 4]]
            own = peers != here[:, None]
            all_ids = np.c_[ids[here], np.where(own, nodes[peers], -1)]
            all_similar = np.c_[similar[here], np.where(own, inside[here[:, None], peers], -np.inf)]
            order = np.argsort(-all_similar, axis=1, kind="stable")
            all_ids, all_similar = np.take_along_axis(all_ids, order, 1), np.take_along_axis(all_similar, order, 1)
            graph.link(
                level, nodes[here], graph.spread(nodes[here], all_ids, all_similar, graph.levels[level].shape[1])
            )
        done += len(nodes)
    return graph


def _vectors(data: DataFrame, is_query: Column, key: str, vector: str) -> DataFrame:
    some = F.exists("vector", lambda x: x != 0)
    rows = data.select(
        F.col(f"`{key}`").cast("long").alias("vec_id"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    )
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector"))).filter(some)
    return rows.withColumns({"dim": F.size("vector").cast("long"), "hash": F.xxhash64("vector")})


INDEX = "shard long, rows long, dim long, vectors binary, owners binary, ids binary, levels array<binary>"


def indexed(rows: DataFrame, k: int, shard: int = SHARD) -> DataFrame:
    """One row per shard: its graph, and for each distinct vector its ``k + 1`` smallest ids.

    Only those ids of equal vectors can be among the ``k`` nearest of any
    query, its own left out. They are picked in every task before the shuffle,
    and a hot vector first in parts, so it takes little room anywhere.
    """
    ship(rows.sparkSession)
    part = Window.partitionBy("hash", "vector", "salt").orderBy("vec_id")
    whole = Window.partitionBy("hash", "vector").orderBy("vec_id")
    first = rows.select("vec_id", "vector", "dim", "hash", F.pmod("vec_id", F.lit(16)).alias("salt")).distinct()
    first = first.withColumn("n", F.row_number().over(part)).filter(F.col("n") <= k + 1)
    first = first.withColumn("n", F.row_number().over(whole)).filter(F.col("n") <= k + 1)
    members = stored(first.select("vec_id", "vector", "dim", "hash"), "ann-vectors")
    shards = max(1, -(-members.count() // shard))
    # Vectors of different lengths never share a shard.
    of = F.shiftleft("dim", 32) + F.pmod("hash", F.lit(shards))
    sharded = members.select(of.alias("shard"), "dim", "hash", "vector", "vec_id")

    def make():
        got: list[pa.RecordBatch] = []

        def each(unit, batch):
            if batch is not None:
                got.append(batch)
                return []
            rows = pa.Table.from_batches(got).combine_chunks()
            got.clear()
            x = matrix(rows.column(3).combine_chunks(), float)
            ids = rows.column(4).to_numpy()
            # Equal vectors lie together, as do the ids of each, in order.
            starts = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]).any(1)])
            owner = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(x)]))
            # An order that has nothing to do with the vectors.
            shuffle = np.random.default_rng(0).permutation(len(starts))
            place = np.empty(len(starts), np.int64)
            place[shuffle] = np.arange(len(starts))
            distinct = x[starts][shuffle]
            graph = build(distinct)
            order = np.lexsort((ids, place[owner]))
            levels = [level.astype("<i4").tobytes() for level in graph.levels]
            row = [unit, len(distinct), x.shape[1], distinct.astype("<f8").tobytes(),
                   place[owner][order].astype("<i4").tobytes(), ids[order].astype("<i8").tobytes(), levels]
            kinds = [pa.int64()] * 3 + [pa.binary()] * 3 + [pa.list_(pa.binary())]
            names = ["shard", "rows", "dim", "vectors", "owners", "ids", "levels"]
            return [pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=names)]

        return each

    return stored(in_units(sharded, "shard", ["hash", "vector", "vec_id"], 2 * shards, make, INDEX), "ann-index")


class Shard:
    """A shard's graph read back from its flat arrays."""

    def __init__(self, row: dict) -> None:
        n = row["rows"]
        self.vectors = np.frombuffer(row["vectors"], "<f8").reshape(n, row["dim"])
        levels = [np.frombuffer(b, "<i4").reshape(n, -1).astype(np.int64) for b in row["levels"]]
        self.graph = Graph(Graph.lifted(self.vectors), levels)
        owners = np.frombuffer(row["owners"], "<i4")
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.start = np.searchsorted(owners, np.arange(n + 1))
        self.sorted_ids = np.sort(self.ids)

    def nearest(self, ids: np.ndarray, queries: np.ndarray, k: int, ef: int) -> tuple[np.ndarray, ...]:
        """``(query id, vec_id, score)`` of each query's ``k`` nearest found, not its own id; scores in double."""
        own = np.searchsorted(self.sorted_ids, ids, "right") - np.searchsorted(self.sorted_ids, ids)
        # Own rows are found first, perhaps; a query with many of them looks further.
        many = own + k > ef
        if many.any() and not many.all():
            parts = [self.nearest(ids[m], queries[m], k, ef) for m in (many, ~many)]
            return tuple(np.concatenate(p) for p in zip(*parts, strict=True))
        most = k + int(own.max(initial=0))
        ef = max(ef, most)
        scale = np.abs(queries).max(1, keepdims=True)
        lifted = np.c_[queries / scale, np.zeros(len(queries))].astype(np.float32)
        found, _ = self.graph.search(lifted, ef)
        found = found[:, :most]
        query, column = np.nonzero(found >= 0)
        node = found[query, column]
        score = (queries[query] * self.vectors[node]).sum(1)
        count = self.start[node + 1] - self.start[node]
        total = int(count.sum())
        member = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.start[node], count)
        query, score, other = np.repeat(query, count), np.repeat(score, count), self.ids[member]
        kept = other != ids[query]
        query, score, other = query[kept], score[kept], other[kept]
        order = np.lexsort((other, -score, query))
        query, score, other = query[order], score[order], other[order]
        best = np.arange(len(query)) - np.searchsorted(query, query) < k
        return ids[query[best]], other[best], score[best]


def nearest(
    data: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding",
    ef: int = EF_SEARCH, shard: int = SHARD,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products found for each query.

    Queries are the rows of ``data`` with ``is_query``; rows with the query's
    id are its own and no candidates. Vectors that are null, zero, or hold null
    or non-finite components take no part, nor do null keys; vectors with
    another number of components are never compared; exact repeats of a row
    count once. An empty table gives an empty table.
    """
    rows = _vectors(data, is_query, key, vector)
    index = indexed(rows, k, shard)
    queries = stored(rows.filter("is_query").select("vec_id", "vector", "dim").distinct(), "ann-queries")
    copies = max(1, -(-queries.count() // PASS))
    places = stored(index.select("shard", "dim"), "ann-shards")
    units = places.count()
    number = F.lit(copies).cast("long")
    graphs = index.select(
        F.explode(F.sequence(F.col("shard") * number, (F.col("shard") + 1) * number - 1)).alias("unit"),
        F.lit(0).alias("kind"),
        F.struct(*index.columns).alias("graph"),
        F.lit(None).cast("long").alias("vec_id"),
        F.lit(None).cast("array<double>").alias("vector"),
    )
    # Every query meets every shard of its vector length, in blocks.
    asked = queries.join(places, "dim").select(
        (F.col("shard") * number + F.pmod(F.xxhash64("vec_id"), number)).alias("unit"),
        F.lit(1).alias("kind"),
        F.lit(None).cast(graphs.schema["graph"].dataType).alias("graph"),
        "vec_id",
        "vector",
    )

    def make():
        graph: list[Shard] = []

        def each(unit, batch):
            if batch is None:
                graph.clear()
                return []
            kind = batch.column(1).to_numpy()
            out = []
            split = int(np.searchsorted(kind, 1))
            if split:
                graph[:] = [Shard(batch.column(2)[0].as_py())]
            for a in range(split, batch.num_rows, BATCH):
                part = batch.slice(a, BATCH)
                found = graph[0].nearest(part.column(3).to_numpy(), matrix(part.column(4), float), k, ef)
                arrays = [pa.array(x) for x in found]
                out.append(pa.RecordBatch.from_arrays(arrays, names=["query_id", "vec_id", "score"]))
            return out

        return each

    found = in_units(
        graphs.union(asked), "unit", ["kind"], 2 * units * copies, make, "query_id long, vec_id long, score double"
    )
    return ranked(found, k)
