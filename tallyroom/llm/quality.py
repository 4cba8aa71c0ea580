"""Text quality by a generalised additive model with pairwise interactions.

Every feature has a lookup table over its bins, and so has every chosen pair of
features. Shallow trees, boosted in turn over the features, build the tables; a
score is the sum of the entries that a text's bins select.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tallyroom.llm.common import fresh, schema_of, ship, slices

FEATURES = (
    "log_words", "upper", "symbols", "exclaims", "pipes", "digits", "commas", "other_bytes",
    "distinct_words", "adjacent_repeats", "word_length", "distinct_lines", "line_words", "distinct_pairs",
)

#: About so many labelled rows are fitted, chosen by a hash of their keys.
SAMPLE = 20_000
#: Bins of a feature, and of each side of a pair.
BINS, COARSE = 32, 8
#: Boosting rounds over all features, rounds over the pairs, pairs, and the step.
ROUNDS, PAIR_ROUNDS, PAIRS, STEP = 120, 40, 6, 0.15
#: Leaves of a tree, the least hessian of a leaf, and the shrinking of its value.
LEAVES, LEAST, SHRINK = 4, 5.0, 1.0
#: A text is accepted from this score on.
ACCEPT = 0.3


def _classes() -> np.ndarray:
    """Per byte, to which of the counted classes it belongs."""
    table = np.zeros((256, 7))
    groups = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*+/<=>@[\\]^_`{}~", b"!", b"|", b"0123456789", b",.;:")
    for column, group in enumerate(groups):
        table[list(group), column] = 1
    table[128:, 6] = 1
    return table


CLASSES = _classes()


def features(text: bytes | None) -> list[float]:
    """One number per entry of ``FEATURES``, from the whole text; shares, so that length matters once."""
    text = text or b""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ CLASSES
    shares = (counts / max(1, len(text))).tolist()
    words = text.split()
    n = len(words)
    lines = text.split(b"\n")
    return [
        math.log1p(n),
        *shares,
        len(set(words)) / math.sqrt(max(1, n)),
        sum(map(eq, words, words[1:])) / max(1, n),
        sum(map(len, words)) / max(1, n),
        len(set(lines)) / len(lines),
        n / len(lines),
        len(set(zip(words, words[1:], strict=False))) / max(1, n - 1),
    ]


@dataclass
class Gam:
    """Lookup tables on the logit scale."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for rows of features."""
        total = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, j], side="right")]
        for a, b, first, second, table in self.pairs:
            total += table[
                np.searchsorted(first, x[:, a], side="right"), np.searchsorted(second, x[:, b], side="right")
            ]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def quantile_edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="higher"))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + SHRINK)


def tree_values(g: np.ndarray, h: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """A tree over ordered bins with gradients ``g`` and hessians ``h``: the value of each bin."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-9, 0, 0)
        for k, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            left_g, left_h = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            all_g, all_h = g[a:b].sum(), h[a:b].sum()
            gains = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h) - _gain(all_g, all_h)
            gains = np.where((left_h >= LEAST) & (all_h - left_h >= LEAST), gains, 0)
            at = int(gains.argmax())
            best = max(best, (float(gains[at]), k, a + at + 1))
        if best[1:] == (0, 0):
            break
        a, b = parts[best[1]]
        parts[best[1] : best[1] + 1] = [(a, best[2]), (best[2], b)]
    values = np.zeros(len(g))
    for a, b in parts:
        values[a:b] = g[a:b].sum() / (h[a:b].sum() + SHRINK)
    return values


def cross_values(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The gain and the values of the best tree with one cut of each of two binned features."""
    corner_g, corner_h = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def quadrants(c: np.ndarray) -> list[np.ndarray]:
        low = c[:-1, :-1]
        return [low, c[:-1, -1:] - low, c[-1:, :-1] - low, c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + low]

    qg, qh = quadrants(corner_g), quadrants(corner_h)
    if not qg[0].size:
        return 0.0, np.zeros_like(g)
    gains = sum(_gain(a, b) for a, b in zip(qg, qh, strict=True)) - _gain(corner_g[-1, -1], corner_h[-1, -1])
    x, y = np.unravel_index(int(gains.argmax()), gains.shape)
    values = np.zeros_like(g)
    for k, (rows, columns) in enumerate(
        ((slice(0, x + 1), slice(0, y + 1)), (slice(0, x + 1), slice(y + 1, None)),
         (slice(x + 1, None), slice(0, y + 1)), (slice(x + 1, None), slice(y + 1, None)))
    ):
        values[rows, columns] = qg[k][x, y] / (qh[k][x, y] + SHRINK)
    return float(gains[x, y]), values


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """Boost the tables of single features in turn, then those of the pairs that still explain most."""
    if not len(y):
        return Gam()
    rate = (y.sum() + 0.5) / (len(y) + 1)
    model = Gam(intercept=math.log(rate / (1 - rate)))
    model.edges = [quantile_edges(x[:, j], BINS) for j in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    logit = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-logit))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, table in enumerate(model.tables):
            g, h = slopes()
            step = STEP * tree_values(
                np.bincount(bins[j], g, len(table)), np.bincount(bins[j], h, len(table))
            )
            table += step
            logit += step[bins[j]]

    coarse = [quantile_edges(x[:, j], COARSE) for j in range(x.shape[1])]
    cells = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(coarse)]

    def grid(a: int, b: int, weight: np.ndarray) -> np.ndarray:
        shape = len(coarse[a]) + 1, len(coarse[b]) + 1
        return np.bincount(cells[a] * shape[1] + cells[b], weight, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    ranked = sorted(
        ((cross_values(grid(a, b, g), grid(a, b, h))[0], a, b) for a, b in combinations(range(x.shape[1]), 2)),
        reverse=True,
    )
    model.pairs = [
        (a, b, coarse[a], coarse[b], np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)))
        for gain, a, b in ranked[:PAIRS]
        if gain > 0
    ]
    for _ in range(PAIR_ROUNDS):
        for a, b, _first, _second, table in model.pairs:
            g, h = slopes()
            step = STEP * cross_values(grid(a, b, g), grid(a, b, h))[1]
            table += step
            logit += step[cells[a], cells[b]]
    return model


def _over_texts(df: DataFrame, keep: list[str], text: str, extra: str, result) -> DataFrame:
    """The ``keep`` columns and what ``result`` makes of the feature rows of a batch."""
    ship(df.sparkSession)
    schema = schema_of(df, keep, extra)
    arrow = to_arrow_schema(schema)
    kept = len(keep)
    columns = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = np.array([features(t) for t in part.column(kept).to_pylist()])
                arrays = [part.column(i).cast(arrow.field(i).type) for i in range(kept)]
                made = result(rows)
                arrays += [pa.array(m, arrow.field(kept + i).type) for i, m in enumerate(made)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.select(*columns, F.col(f"`{text}`").cast("binary").alias("text")).mapInArrow(run, schema)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learned(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
    sample: int = SAMPLE,
) -> Gam:
    """A model of ``label`` from about ``sample`` labelled documents that are not held out.

    The sample is chosen by a hash of the key; only its features come to the
    driver. Without labels every text scores one half.
    """
    known = (
        labels.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").cast("double").alias("label"))
        .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    share = min(1.0, sample / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    texts = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    # The broadcast side is the bounded sample: a key and a number a row.
    rows = texts.join(F.broadcast(chosen), "id").select("label", "text")
    found = _over_texts(rows, ["label"], "text", "features array<double>", lambda x: [list(x)])
    rows = sorted((r.features, r.label) for r in found.limit(2 * sample).collect())
    x = np.array([r[0] for r in rows]).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r[1] for r in rows]))


def scored(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """Per document: the key, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from ``ACCEPT`` on).

    A null text counts as empty and is scored like one; a null key is not held
    out; an empty table gives an empty table.
    """
    model = learned(docs, labels, text, key, **options)
    found = _over_texts(docs, [key], text, "_score double", lambda x: [model.score(x)])
    return found.select(
        F.col(f"`{key}`"),
        held_out(F.col(f"`{key}`")).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= ACCEPT).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that score ``ACCEPT`` or more, with all their columns."""
    model = learned(docs, labels, text, key, **options)
    (score,) = fresh(docs, "score")
    found = _over_texts(docs, docs.columns, text, f"`{score}` double", lambda x: [model.score(x)])
    return found.filter(F.col(score) >= ACCEPT).drop(score)
