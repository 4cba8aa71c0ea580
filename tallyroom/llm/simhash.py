"""SimHash near-duplicates through a Gray-order hierarchical index.

Two fingerprints at most ``radius`` bits apart agree on at least one of
``radius + 1`` blocks of bits. So every distinct fingerprint goes to one bucket
per block, an upper node whose masked pattern is that block. In a bucket the
fingerprints are sorted by Gray rank, which puts similar ones side by side.
Neighbours are factored into nodes that hold the bits all their members share;
a query adds up its differences from node to node and drops a whole group as
soon as they exceed the radius.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.common import components, fresh, map_texts, ship, stored

BITS = 64
SEED = 42
#: Members of a leaf node, and children of an upper node.
FANOUT = 8
#: A bucket of more fingerprints is cut into parts, and each pair of parts is solved apart.
BUCKET = 4096
#: Query and node pairs looked at together.
FRONTIER = 1 << 20


def bit_votes(hashes: np.ndarray) -> np.ndarray:
    """For each bit, from the lowest, how many of the hashes have it set."""
    lanes = np.uint64(0x0101010101010101)
    starts = np.arange(0, len(hashes), 255)
    votes = np.zeros(BITS, np.int64)
    for bit in range(8):
        # Eight counters of a byte each; 255 hashes cannot overflow them.
        sums = np.add.reduceat((hashes >> np.uint64(bit)) & lanes, starts)
        votes[bit::8] = sums.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return votes


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """The fingerprint as a signed 64-bit integer; zero for a text without words.

    Bytes split and fold like the contract's words: ASCII white space separates
    and only A to Z change.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[:n].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array(
            [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)],
            np.uint64,
        )
    bits = (2 * bit_votes(hashes) > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def with_fingerprints(
    docs: DataFrame, keep: list[str], shingle: int = 4, text: str = "text", name: str = "fingerprint"
) -> DataFrame:
    """The ``keep`` columns and the fingerprint of each whole text, as a long."""

    def make():
        return lambda texts: {name: [fingerprint(t, shingle) for t in texts]}

    return map_texts(docs, keep, [F.col(f"`{text}`").cast("binary")], f"`{name}` long", make)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The position of each code in the Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def blocks(radius: int) -> list[tuple[int, int]]:
    """``(lowest bit, width)`` of ``radius + 1`` blocks that cover all bits."""
    edges = [BITS * i // (radius + 1) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


class GrayIndex:
    """Nodes over the codes of one or more buckets; codes of a bucket lie together, in Gray order.

    Level 0 has a node per code, each further level one for up to ``FANOUT``
    nodes of the same bucket below, up to one root per bucket. A node holds
    the mask of bits its members share and their pattern.
    """

    def __init__(self, codes: np.ndarray, bucket: np.ndarray) -> None:
        full = np.full(len(codes), np.uint64(0xFFFFFFFFFFFFFFFF))
        self.levels = [(codes, full)]
        self.first_child: list[np.ndarray] = []
        self.buckets = [bucket]
        while True:
            pattern, mask = self.levels[-1]
            owner = self.buckets[-1]
            starts_bucket = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            if len(starts_bucket) == len(owner):
                break
            place = np.arange(len(owner)) - np.repeat(starts_bucket, np.diff(np.r_[starts_bucket, len(owner)]))
            starts = np.flatnonzero(place % FANOUT == 0)
            head = np.repeat(pattern[starts], np.diff(np.r_[starts, len(owner)]))
            shared = np.bitwise_and.reduceat(mask & ~(pattern ^ head), starts)
            self.first_child.append(np.r_[starts, len(owner)])
            self.levels.append((pattern[starts] & shared, shared))
            self.buckets.append(owner[starts])

    def pairs(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions ``a < b`` of codes of a bucket at most ``radius`` bits apart, part by part."""
        codes, bucket = self.levels[0][0], self.buckets[0]
        roots = self.buckets[-1]
        root_of = np.searchsorted(roots, bucket)
        sizes = np.diff(np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(bucket)])
        weight = np.repeat(sizes, sizes).cumsum()
        cuts = np.searchsorted(weight, np.arange(FRONTIER, weight[-1] + FRONTIER, FRONTIER))
        begin = 0
        for cut in cuts:
            end = max(begin + 1, min(len(codes), int(cut) + 1))
            if begin >= len(codes):
                break
            yield self._search(codes, np.arange(begin, end), root_of[begin:end], radius)
            begin = end

    def _search(self, codes, query, node, radius):
        top = len(self.levels) - 1
        pattern, mask = self.levels[top]
        differ = np.bitwise_count((codes[query] ^ pattern[node]) & mask[node])
        for level in range(top, 0, -1):
            alive = differ <= radius
            query, node, differ = query[alive], node[alive], differ[alive]
            first = self.first_child[level - 1]
            count = first[node + 1] - first[node]
            total = int(count.sum())
            # The children of every pair, and the bits they hold beyond their parent's.
            up = np.repeat(np.arange(len(node)), count)
            child = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + first[node[up]]
            below = self.levels[level - 1]
            query, parent = query[up], node[up]
            more = below[1][child] & ~mask[parent]
            differ = differ[up] + np.bitwise_count((codes[query] ^ below[0][child]) & more)
            # Only later codes: a node that ends before the query has none.
            last = child
            for deeper in range(level - 1, 0, -1):
                last = self.first_child[deeper - 1][last + 1] - 1
            ahead = last > query
            query, node, differ = query[ahead], child[ahead], differ[ahead]
            pattern, mask = below
        found = (differ <= radius) & (node > query)
        return query[found], node[found]


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Give both ends of every link the smallest label either can reach."""
    while len(a):
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        np.minimum.at(label, high, low)
        while True:
            deeper = label[label]
            if np.array_equal(deeper, label):
                break
            label = deeper
    return label


def bucket_links(codes: np.ndarray, bucket: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the codes of each bucket like all pairs within ``radius`` would, at most one per code."""
    unsigned = codes.view(np.uint64)
    order = np.lexsort((gray_rank(unsigned), bucket))
    codes, unsigned, bucket = codes[order], unsigned[order], bucket[order]
    label = np.arange(len(codes))
    for a, b in GrayIndex(unsigned, bucket).pairs(radius):
        label = join_labels(label, a, b)
    far = np.flatnonzero(label != np.arange(len(codes)))
    return codes[far], codes[label[far]]


def fingerprint_links(distinct: DataFrame, radius: int = 4) -> DataFrame:
    """Links ``(a, b)`` between the distinct ``fingerprint`` values, enough to join all that lie within ``radius``."""
    ship(distinct.sparkSession)
    keys = [
        F.struct(
            F.lit(i).alias("block"),
            F.shiftrightunsigned("fingerprint", low).bitwiseAND(F.lit((1 << width) - 1)).alias("bits"),
        )
        for i, (low, width) in enumerate(blocks(radius))
    ]
    members = distinct.select("fingerprint", F.inline(F.array(*keys)))
    # Buckets beyond the bound: parts by a hash, and every pair of parts.
    crowded = (
        members.groupBy("block", "bits")
        .agg(F.ceil(F.count("*") / BUCKET).cast("int").alias("parts"))
        .filter("parts > 1")
    )
    part = F.pmod(F.xxhash64("fingerprint", F.lit(1)), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
    units = (
        members.join(crowded, ["block", "bits"], "left")
        .select("block", "bits", "fingerprint", F.coalesce(part, F.lit(0)).alias("own"), other.alias("other"))
        .select(
            "fingerprint",
            F.xxhash64(
                "block", "bits", F.least("own", "other"), F.greatest("own", "other")
            ).alias("unit"),
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sorted by unit: what is known of the last unit waits for the next batch.
        codes, unit = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            codes = np.r_[codes, batch.column(0).to_numpy()]
            unit = np.r_[unit, batch.column(1).to_numpy()]
            whole = int(np.searchsorted(unit, unit[-1])) if len(unit) else 0
            if whole:
                yield links(codes[:whole], unit[:whole])
                codes, unit = codes[whole:], unit[whole:]
        if len(codes):
            yield links(codes, unit)

    def links(codes, unit):
        a, b = bucket_links(codes, unit, radius)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return (
        units.repartition("unit").sortWithinPartitions("unit").mapInArrow(run, "a long, b long").distinct()
    )


def grouped(prints: DataFrame, radius: int = 4, key: str = "doc_id") -> DataFrame:
    """Per distinct ``fingerprint``: ``root`` (one fingerprint per group) and ``component_id`` (its smallest key).

    Fingerprints at most ``radius`` bits apart are linked, and groups are the
    connected components. Null keys are passed over; a group of them has none.
    """
    distinct = stored(
        prints.groupBy("fingerprint").agg(F.min(F.col(f"`{key}`")).alias("least")), "fingerprints"
    )
    roots = components(fingerprint_links(distinct, radius), "simhash-links")
    rooted = distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "least"
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.select("fingerprint", "root").join(smallest, "root")


def near_duplicates(
    docs: DataFrame, shingle: int = 4, radius: int = 4, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Per document: the key, ``fingerprint`` (16 hex digits) and ``component_id``.

    A null text counts as empty and has fingerprint zero; repeated rows come
    back as often as they came in; an empty table gives an empty table.
    """
    prints = stored(with_fingerprints(docs, [key], shingle, text), "simhash")
    groups = grouped(prints, radius, key)
    return prints.join(groups, "fingerprint").select(
        F.col(f"`{key}`"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def without_near_duplicates(
    docs: DataFrame, shingle: int = 4, radius: int = 4, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """The rows of one document per group, the one with the smallest key; all columns of ``docs``.

    Rows that repeat that key within the group count as copies too.
    """
    code, root, least = fresh(docs, "fingerprint", "root", "component_id")
    prints = stored(with_fingerprints(docs, docs.columns, shingle, text, code), "simhash-docs")
    key_of = F.col(f"`{key}`")
    groups = grouped(prints.select(F.col(code).alias("fingerprint"), key_of), radius, key)
    groups = groups.select(
        F.col("fingerprint").alias(code), F.col("root").alias(root), F.col("component_id").alias(least)
    )
    first = prints.join(groups, code).filter(key_of.eqNullSafe(F.col(least)))
    return first.dropDuplicates([root]).select(*[F.col(f"`{c}`") for c in docs.columns])
