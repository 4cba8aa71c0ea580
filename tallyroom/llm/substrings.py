"""Removal of repeated byte strings by suffix arrays of shards.

A string of ``LENGTH`` bytes repeats if it occurs at two places. Every string
has an anchor, the ``GRAM`` bytes within it that hash lowest, so equal strings
have equal anchors at the same offset, and only anchors that occur twice matter.
The strings of one anchor form a snippet. Equal snippets are settled by their
first occurrence; where the snippets of an anchor differ, one of each goes to
the anchor's shard. There a suffix array by induced sorting and its permuted
common prefixes show which strings are equal. Only for an anchor with too many
different snippets each string is hashed, and equal hashes are settled by their
first occurrence.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.common import in_units, ship, stored
from tallyroom.llm.induced import permuted_prefixes, suffix_order

LENGTH = 100
GRAM = 24
#: Bytes of texts hashed together: with eight bytes each they stay in the processor's cache.
CHUNK = 128 << 10
#: Snippets of a shard, about, and most of an anchor that goes to one; beyond, its strings are settled by hashes.
SHARD, HOT = 8192, 16_384
NULL_KEY = 2**63 - 1

#: The bits of a hash that choose an anchor; the others hold a place.
HIGH = np.uint64(2**64 - 2**31)
ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` for ``i < n``, modulo 2 ** 64."""
    out = np.ones(max(1, n), np.uint64)
    done = 1
    while done < n:
        step = np.uint64(pow(base, done, 1 << 64))
        more = out[: min(done, n - done)] * step
        out[done : done + len(more)] = more
        done += len(more)
    return out


_chunk_powers = lru_cache(maxsize=2)(lambda base: _powers(base, CHUNK + 1))


def _first_powers(base: int, n: int) -> np.ndarray:
    """As ``_powers``; those for a chunk are kept."""
    return _chunk_powers(base)[: max(1, n)] if n <= CHUNK + 1 else _powers(base, n)


class Hashes:
    """Hashes of any range of a byte array, from running sums of a polynomial."""

    letters = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        self.back = _first_powers(_inverse(int(ODD)), n + 1)
        self.sums = np.empty(n + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(self.letters[data] * _first_powers(int(ODD), n + 1)[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self._mixed((self.sums[end] - self.sums[start]) * self.back[start])

    def grams(self, length: int) -> np.ndarray:
        """Of every range of ``length``."""
        return self._mixed((self.sums[length:] - self.sums[:-length]) * self.back[: len(self.sums) - length])

    @staticmethod
    def _mixed(h: np.ndarray) -> np.ndarray:
        h ^= h >> np.uint64(32)
        h *= MIX
        h ^= h >> np.uint64(29)
        return h


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row."""
    least, done = values, 1
    while done < width:
        step = min(done, width - done)
        least = np.minimum(least[:-step], least[step:])
        done += step
    return least


def anchors(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchor key, position, and first and last start of its strings, for texts that lie end to end in ``data``.

    A string's anchor is its lowest-hashing gram by the ``HIGH`` bits of the
    hash, the leftmost of equals, so it follows from the string alone; the key
    is the whole hash. Strings do not cross the ``ends`` of texts.
    """
    empty = np.empty(0, np.int64)
    if len(data) < length:
        return np.empty(0, np.uint64), empty, empty, empty, None
    hashes = Hashes(data)
    grams = hashes.grams(gram)
    # Below the high bits of a hash stands its place, so the least of a window tells where it is.
    least = sliding_least(grams & HIGH | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
    anchor = (least & ~HIGH).view(np.int64)
    starts = np.r_[0, ends[:-1]]
    long = ends - starts >= length
    # Where the strings of one text with one anchor begin and end.
    change = np.zeros(len(anchor) + 1, bool)
    np.not_equal(anchor[1:], anchor[:-1], out=change[1:-1])
    change[starts[long]] = True
    change[ends[long] - length + 1] = True
    edges = np.r_[np.flatnonzero(change), len(anchor)]
    low, high = edges[:-1], edges[1:] - 1
    # A string that crosses an end starts after the last one of its text.
    inside = low <= ends[np.searchsorted(ends, low, side="right")] - length
    low, high = low[inside], high[inside]
    place = anchor[low]
    return grams[place], place, low, high, hashes


def _chunks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.diff(np.frombuffer(batch.column(column).buffers()[1], np.int32)[batch.column(column).offset :][: batch.num_rows + 1])
        start = total = 0
        for i, size in enumerate(sizes.tolist()):
            if total and total + size > CHUNK:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)


def keep_freed_memory() -> None:
    """Free one large block untouched: glibc then keeps what arrays free for the next ones, instead of giving it back."""
    np.empty(24 << 20, np.uint8)


def _end_to_end(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column and the end of each value."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return data, (offsets[1:] - offsets[0]).astype(np.int64)


#: ``place`` holds, from its high bits down, where the first string starts, how many there are, and how far ahead
#: of the first the anchor is: one number moves through the shuffle instead of three.
ANCHOR = "doc long, print long, key long, snippet long, place long"


def anchored(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """The anchors of ``texts (doc, print, text)``: key, a hash of the snippet, and where its strings start."""

    def run(batches):
        keep_freed_memory()
        for batch in _chunks(batches, 2):
            data, ends = _end_to_end(batch.column(2))
            key, place, low, high, hashes = anchors(data, ends, length, gram)
            if not len(key):
                continue
            text = np.searchsorted(ends, low, side="right")
            starts = np.r_[0, ends[:-1]][text]
            rows = pa.array(text)
            arrays = [
                batch.column(0).take(rows),
                batch.column(1).take(rows),
                pa.array(key.view(np.int64)),
                pa.array(hashes.of(low, high + length).view(np.int64)),
                pa.array((low - starts) << 32 | (high - low + 1) << 16 | (place - low)),
            ]
            yield pa.RecordBatch.from_arrays(
                arrays, names=["doc", "print", "key", "snippet", "place"]
            )

    return texts.mapInArrow(run, ANCHOR)


def anchor_keys(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """``key`` of each anchor of ``texts (doc, print, text)``."""

    def run(batches):
        keep_freed_memory()
        for batch in _chunks(batches, 2):
            key = anchors(*_end_to_end(batch.column(2)), length, gram)[0]
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], names=["key"])

    return texts.mapInArrow(run, "key long")


def hot_strings(texts: DataFrame, keys: list[int], length: int, gram: int) -> DataFrame:
    """``doc, print, key, low, strings``: per snippet of the anchors ``keys`` the hashes of its strings."""
    hot = np.array(keys, np.int64)

    def run(batches):
        keep_freed_memory()
        for batch in _chunks(batches, 2):
            data, ends = _end_to_end(batch.column(2))
            key, _, low, high, hashes = anchors(data, ends, length, gram)
            pick = np.flatnonzero(np.isin(key.view(np.int64), hot))
            if not len(pick):
                continue
            key, low, count = key[pick], low[pick], high[pick] - low[pick] + 1
            offsets = np.r_[0, np.cumsum(count)]
            start = np.arange(offsets[-1]) + np.repeat(low - offsets[:-1], count)
            strings = pa.array(hashes.of(start, start + length).view(np.int64))
            text = np.searchsorted(ends, low, side="right")
            rows = pa.array(text)
            arrays = [
                batch.column(0).take(rows),
                batch.column(1).take(rows),
                pa.array(key.view(np.int64)),
                pa.array((low - np.r_[0, ends[:-1]][text]).astype(np.int32)),
                pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), strings),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc", "print", "key", "low", "strings"])

    return texts.mapInArrow(run, "doc long, print long, key long, low int, strings array<long>")


def _settle_hot(texts: DataFrame, snippets: DataFrame, length: int, gram: int) -> DataFrame | None:
    """``doc, print, begin, end`` to remove in the ``snippets (doc, print, key, low)`` of hot anchors, if there are any.

    An anchor's equal strings have equal hashes: the first place of each is a
    minimum, combined before its shuffle, and the others follow from a join,
    whose hot strings Spark splits. No task gathers a string's places.
    """
    # One key for over HOT snippets.
    keys = [r.key for r in snippets.select("key").distinct().collect()]
    if not keys:
        return None
    where = ["doc", "print", "key", "low"]
    found = hot_strings(texts, keys, length, gram).join(snippets.select(*where), where, "left_semi")
    each = stored(found, "hot-strings").select("doc", "print", "key", "low", F.posexplode("strings").alias("at", "string"))
    each = each.select("doc", "print", "key", "string", (F.col("low") + F.col("at")).alias("start"))
    place = F.struct("doc", "print", "start")
    first = each.groupBy("key", "string").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    first = stored(first.drop("n"), "first-strings")
    later = each.join(first, ["key", "string"]).filter(place != F.col("first"))
    begin = F.col("start").cast("long")
    return later.select("doc", "print", begin.alias("begin"), (begin + length).alias("end"))


def repeated_strings(
    snippets: np.ndarray, sizes: np.ndarray, order: np.ndarray, at: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """Snippet and start of every string of ``length`` that some snippet has too, with a smaller place.

    ``snippets`` are the bytes end to end and ``sizes`` their numbers. A
    string's place is its snippet's ``order`` (equal for one text) and then
    ``at`` plus its start.
    """
    n = len(sizes)
    owner = np.repeat(np.arange(n), sizes + 1)
    base = np.cumsum(sizes + 1) - (sizes + 1)
    start = np.arange(len(owner)) - base[owner]
    # A letter lower than all bytes ends each snippet.
    text = np.zeros(len(owner), np.int64)
    text[start < sizes[owner]] = snippets.astype(np.int64) + 1
    suffixes = suffix_order(text)
    shared = permuted_prefixes(text, suffixes, length)[suffixes]
    # Suffixes that share LENGTH bytes with the one before form a class.
    joined = shared >= length
    member = joined | np.r_[joined[1:], False]
    class_ = np.cumsum(~joined)[member]
    place = suffixes[member]
    where = owner[place]
    # The sentinel cannot be inside a shared string unless snippets end alike there.
    inside = start[place] + length <= sizes[where]
    class_, place, where = class_[inside], place[inside], where[inside]
    position = at[where] + start[place]
    sort = np.lexsort((position, order[where], class_))
    class_, place, where, position = class_[sort], place[sort], where[sort], position[sort]
    first = np.flatnonzero(np.r_[True, class_[1:] != class_[:-1]])[: len(class_)]
    count = np.diff(np.r_[first, len(class_)])
    least_order, least_position = np.repeat(order[where][first], count), np.repeat(position[first], count)
    later = (order[where] != least_order) | (position != least_position)
    return where[later], start[place[later]]


def runs(where: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive starts of one snippet, as snippet, first and last start."""
    sort = np.lexsort((start, where))
    where, start = where[sort], start[sort]
    new = np.r_[True, (where[1:] != where[:-1]) | (start[1:] != start[:-1] + 1)][: len(where)]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(where)] - 1
    return where[first], start[first], start[last]


def _settle(snippets: DataFrame, parts: int, length: int) -> DataFrame:
    """``doc, print, begin, end`` of the bytes in ``snippets (unit, doc, print, low, bytes)`` to remove."""
    names = ["doc", "print", "begin", "end"]

    def make():
        keep_freed_memory()
        got: list[pa.RecordBatch] = []

        def each(unit, batch):
            if batch is not None:
                got.append(batch)
                return []
            rows = pa.Table.from_batches(got).combine_chunks()
            got.clear()
            doc, print_, low = (rows.column(i).to_numpy() for i in (1, 2, 3))
            data, ends = _end_to_end(rows.column(4).combine_chunks())
            # Texts in order: the document, then the text's print.
            sort = np.lexsort((print_, doc))
            new = np.r_[True, (doc[sort][1:] != doc[sort][:-1]) | (print_[sort][1:] != print_[sort][:-1])]
            order = np.empty(len(doc), np.int64)
            order[sort] = np.cumsum(new)
            where, a, b = runs(*repeated_strings(data, np.diff(np.r_[0, ends]), order, low.astype(np.int64), length))
            arrays = [doc[where], print_[where], low[where] + a, low[where] + b + length]
            return [pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in arrays], names=names)]

        return each

    return in_units(snippets, "unit", ["key"], parts, make, "doc long, print long, begin long, end long")


def spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc, print, begin, end``: bytes of ``texts (doc, print, text)`` in strings that also start earlier."""
    # The anchors are found twice rather than kept: they take as much room as the texts.
    keys = anchor_keys(texts, length, gram).groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    keys = stored(keys, "repeated-keys")
    place = F.col("place")
    again = anchored(texts, length, gram).join(keys, "key", "left_semi").select(
        "doc",
        "print",
        "key",
        "snippet",
        F.shiftright(place, 32).cast("int").alias("low"),
        F.shiftright(place, 16).bitwiseAND(F.lit(0xFFFF)).cast("short").alias("strings"),
        place.bitwiseAND(F.lit(0xFFFF)).cast("short").alias("ahead"),
    )
    again = stored(again, "repeated-anchors")

    # Equal snippets: all but the first are settled without their bytes.
    same = ["key", "snippet", "strings", "ahead"]
    first = again.groupBy(*same).agg(F.min(F.struct("doc", "print", "low")).alias("first"))
    first = stored(first, "first-anchors")
    later = again.join(first, same).filter(F.struct("doc", "print", "low") != F.col("first"))
    settled = later.select(
        "doc",
        "print",
        F.col("low").cast("long").alias("begin"),
        (F.col("low") + F.col("strings") - 1 + length).cast("long").alias("end"),
    )

    # Anchors with different snippets: one of each goes to the shards with its bytes.
    mixed = first.groupBy("key").agg(F.count("*").alias("snippets")).filter("snippets > 1")
    open_ = stored(
        first.join(mixed, "key").select("key", "first.doc", "first.print", "first.low", "strings", "snippets"), "open-anchors"
    )
    hot = _settle_hot(texts, open_.filter(F.col("snippets") > HOT), length, gram)
    settled = settled if hot is None else settled.union(hot)
    open_ = open_.filter(F.col("snippets") <= HOT)
    shards = max(1, -(-open_.count() // SHARD))
    wanted = open_.groupBy("doc", "print").agg(F.collect_list(F.struct("key", "low", "strings")).alias("wanted"))

    def cut(batches):
        """The bytes of each snippet."""
        for batch in _chunks(batches, 2):
            data, ends = _end_to_end(batch.column(2))
            rows = np.repeat(np.arange(batch.num_rows), batch.column(3).value_lengths().to_numpy())
            key, low, strings = (c.to_numpy() for c in batch.column(3).flatten().flatten())
            size = strings.astype(np.int64) - 1 + length
            offsets = np.r_[0, np.cumsum(size)]
            begin = np.r_[0, ends[:-1]][rows] + low
            cut_out = data[np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], size)]
            buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(cut_out)]
            rows = pa.array(rows)
            arrays = [
                pa.array(key % shards),
                pa.array(key),
                batch.column(0).take(rows),
                batch.column(1).take(rows),
                pa.array(low),
                pa.Array.from_buffers(pa.binary(), len(key), buffers),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["unit", "key", "doc", "print", "low", "bytes"])

    asked = texts.join(wanted, ["doc", "print"]).select("doc", "print", "text", "wanted").dropDuplicates(["doc", "print"])
    snippets = asked.mapInArrow(cut, "unit long, key long, doc long, print long, low int, bytes binary")
    resolved = _settle(snippets.select("unit", "doc", "print", "low", "bytes", "key"), 2 * shards, length)
    return settled.union(resolved)


def gathered(removed: DataFrame) -> DataFrame:
    """``doc, print, spans`` from the rows of ``spans``: each span once, so a row repeated many times has the list of one."""
    return removed.groupBy("doc", "print").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))


def merged(begin: np.ndarray, end: np.ndarray, count: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the unions of spans begin and end, ``count`` spans in each of the texts that lie end to end."""
    text = np.repeat(np.arange(len(ends)), count)
    base = np.r_[0, ends[:-1]][text]
    sort = np.argsort(begin + base, kind="stable")
    text, begin, reach = text[sort], (begin + base)[sort], np.maximum.accumulate((end + base)[sort])
    # Spans of one text that touch are one; those of two texts are not.
    apart = (begin[1:] > reach[:-1]) | (text[1:] != text[:-1])
    return begin[np.r_[True, apart][: len(begin)]], reach[np.r_[apart, True][: len(begin)]]


def _keys_tell_texts(docs: DataFrame, key: str, body: Column) -> bool:
    """Whether no key but null has two different texts; one number per key moves."""
    prints = docs.select(F.col(f"`{key}`").alias("key"), F.xxhash64(body).alias("print")).filter("key is not null")
    ends = prints.groupBy("key").agg(F.min("print").alias("least"), F.max("print").alias("most"))
    return ends.filter("least <> most").isEmpty()


def deduplicated(
    docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """Per document: the key, ``n_bytes, n_removed, n_spans, kept_sha256``.

    A byte goes if a string of ``length`` bytes over it also starts earlier: in
    a document with a smaller key, or before in the same one. Null keys come
    last. Rows with one key and different texts count as different documents,
    in the order of a hash of their texts; rows with one key and one text are
    one document, and each comes back with its result. A null text counts as
    empty; an empty table gives an empty table.
    """
    ship(docs.sparkSession)
    body = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b""))
    # The hash tells texts of one key apart. Where keys do that alone it is
    # left out, as it takes a quarter of every row that moves.
    told = F.xxhash64(body)
    if _keys_tell_texts(docs, key, body):
        told = F.when(F.col(f"`{key}`").isNull(), told).otherwise(F.lit(0).cast("long"))
    texts = docs.select(
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NULL_KEY)).alias("doc"),
        told.alias("print"),
        body.alias("text"),
    )
    per_text = gathered(spans(texts, length, gram))
    rows = docs.select(
        F.col(f"`{key}`").alias("key"),
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NULL_KEY)).alias("doc"),
        told.alias("print"),
        body.alias("text"),
    ).join(per_text, ["doc", "print"], "left")
    kind = docs.schema[key].dataType.simpleString()
    rows = rows.select("key", "text", "spans.begin", "spans.end")

    def take_out(batches):
        for batch in _chunks(batches, 1):
            data, ends = _end_to_end(batch.column(1))
            begin, end = batch.column(2), batch.column(3)
            count = begin.value_lengths().fill_null(0).to_numpy()
            first, last = merged(begin.flatten().to_numpy(), end.flatten().to_numpy(), count, ends)
            n_bytes = np.diff(np.r_[0, ends])
            # The unions of a text begin before its end.
            upto = np.r_[0, np.searchsorted(first, ends)]
            n_removed = np.diff(np.r_[0, np.cumsum(last - first)][upto])
            step = np.zeros(len(data) + 1, np.int8)
            step[first] += 1
            step[last] -= 1
            kept = data[np.cumsum(step[:-1], dtype=np.int8) == 0]
            stops = np.cumsum(n_bytes - n_removed).tolist()
            digests = [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip([0, *stops], stops, strict=False)]
            columns = [batch.column(0), *map(pa.array, (n_bytes, n_removed, np.diff(upto), digests))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    done = rows.mapInArrow(take_out, f"key {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return done.withColumnRenamed("key", key)
