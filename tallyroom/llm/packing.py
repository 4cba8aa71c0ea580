"""Packing documents into token sequences by best-two-fit.

A bin is filled greedily with the longest unpacked piece that fits. When
nothing fits any more and a gap is left, its smallest piece is put back if two
unpacked pieces fill the widened gap more tightly.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tallyroom.llm.common import map_texts, schema_of, ship, stored

#: The vocabulary of ``byte_bpe_50k.json`` as ranks: the same ids, made about four times as fast.
RANKS = "byte_bpe_50k.tiktoken"
#: The vocabulary itself, for the tokens added to it: their strings in a text are those tokens.
VOCABULARY = "byte_bpe_50k.json"
#: Distinct words whose ids a worker remembers; further ones are encoded each time they occur.
REMEMBERED = 300_000


@lru_cache(maxsize=1)
def _remembered(path: str) -> tuple[tiktoken.Encoding, dict[str, bytes | None]]:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return (
        tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}),
        {},
    )


@lru_cache(maxsize=1)
def _added(path: str) -> dict[str, int]:
    with open(path, encoding="utf-8") as file:
        return {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}


class Encoder:
    """Token ids of whole texts as little-endian 32-bit integers.

    The tokenizer starts a new piece at a space that follows a visible
    character, so the words between spaces can be encoded one by one and
    remembered. A text with other runs of white space is encoded at once. Added
    tokens are cut out first; what is between them is encoded by itself.
    """

    def __init__(self, path: str | None = None, vocabulary: str | None = None) -> None:
        self.encoding, self.known = _remembered(path or public_tokenizers.path(RANKS))
        self.added = _added(vocabulary or public_tokenizers.path(VOCABULARY))
        longest = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(map(re.escape, longest))})") if longest else None

    def whole(self, text: str) -> bytes:
        return array("I", self.encoding.encode_ordinary(text)).tobytes()

    def _word(self, word: str) -> bytes | None:
        if not word or word[-1].isspace():
            ids = None  # the space after it may belong to a longer run
        elif word.isascii() and word.isalpha():
            ids = array("I", self.encoding._core_bpe.encode_single_piece(b" " + word.encode())).tobytes()
        else:
            ids = self.whole(" " + word)
        if len(self.known) < REMEMBERED:
            self.known[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if self.cut and any(t in text for t in self.added):
            parts = [p for p in self.cut.split(text) if p]
            return b"".join(
                array("I", [self.added[p]]).tobytes() if p in self.added else self._between(p) for p in parts
            )
        return self._between(text)

    def _between(self, text: str) -> bytes:
        first, *words = text.split(" ")
        if not words:
            return self.whole(text)
        if not first or first[-1].isspace():
            return self.whole(text)
        known, word = self.known, self._word
        try:
            ids = [known[w] if w in known else word(w) for w in words]
            return self.whole(first) + b"".join(ids)
        except TypeError:  # a word that cannot stand alone
            return self.whole(text)


def token_pieces(
    docs: DataFrame,
    limit: int = 2048,
    end_id: int = 0,
    text: str = "text",
    key: str = "doc_id",
    path: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: the key, ``piece, start, length, ids_crc32`` and, if asked for, ``ids``.

    A document is its ids and then ``end_id``. Only a document of more than
    ``limit`` ids is cut, into pieces of ``limit``; its first piece takes what
    is left over. A null text counts as empty: one piece, the end id alone.
    """
    ship(docs.sparkSession)

    def make():
        encoder = Encoder(path)
        end = array("I", [end_id]).tobytes()

        def each(texts: list[str | None]) -> dict[str, list]:
            rows = []
            for t in texts:
                ids = encoder.encode(t or "") + end
                n = len(ids) // 4
                cuts = [0, *range(n % limit or limit, n + 1, limit)] if n > limit else [0, n]
                rows.append(
                    [
                        {
                            "piece": i,
                            "start": a,
                            "length": b - a,
                            "ids_crc32": zlib.crc32(ids[4 * a : 4 * b]),
                            **({"ids": array("I", ids[4 * a : 4 * b]).tolist()} if with_ids else {}),
                        }
                        for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
                    ]
                )
            return {"_pieces": rows}

        return each

    fields = "piece: int, start: long, length: long, ids_crc32: long" + ", ids: array<int>" * with_ids
    pieces = map_texts(docs, [key], [F.col(f"`{text}`")], f"_pieces array<struct<{fields}>>", make)
    return pieces.select(F.col(f"`{key}`"), F.inline("_pieces"))


class Lengths:
    """The unpacked pieces of a shard by length, with the largest length up to a bound."""

    def __init__(self, limit: int) -> None:
        self.rows: list[list[int]] = [[] for _ in range(limit + 1)]
        self.present = 0

    def add(self, length: int, row: int) -> None:
        self.rows[length].append(row)
        self.present |= 1 << length

    def take(self, length: int) -> int:
        row = self.rows[length].pop()
        if not self.rows[length]:
            self.present &= ~(1 << length)
        return row

    def largest(self, bound: int) -> int:
        """0 if no piece is that short."""
        return (self.present & ((2 << bound) - 1)).bit_length() - 1 if bound > 0 and self.present else 0

    def pair(self, bound: int) -> tuple[int, int]:
        """The two lengths with the largest sum up to ``bound``; zeros if there are none."""
        best = (0, 0)
        a = self.largest(bound - 1)
        while a > 0 and 2 * a > sum(best):
            b = self.largest(min(a, bound - a))
            if b == a and len(self.rows[a]) < 2:
                b = self.largest(a - 1)
            if b > 0 and a + b > sum(best):
                best = (a, b)
                if a + b == bound:
                    break
            a = self.largest(a - 1)
        return best


def best_two_fit(lengths: list[int], limit: int) -> list[list[int]]:
    """Bins of row numbers, each of at most ``limit`` in all."""
    left = Lengths(limit)
    for row, length in enumerate(lengths):
        left.add(length, row)
    bins = []
    while left.present:
        chosen: list[tuple[int, int]] = []
        gap = limit
        while (fit := left.largest(gap)) > 0:
            chosen.append((fit, left.take(fit)))
            gap -= fit
        if gap and chosen:
            smallest, row = chosen[-1]
            a, b = left.pair(gap + smallest)
            if a + b > smallest:
                chosen[-1:] = [(a, left.take(a)), (b, left.take(b))]
                left.add(smallest, row)
        bins.append([row for _, row in chosen])
    return bins


def pack(pieces: DataFrame, limit: int = 2048, shard_tokens: int = 1 << 22, shard_rows: int = 400_000) -> DataFrame:
    """``pieces`` (with a ``length`` from 1 to ``limit``) and ``sequence_id, offset``.

    The pieces are dealt evenly, whatever their keys, into shards of about
    ``shard_tokens`` tokens, each packed on its own: at ``1 << 22`` a shard is
    some 2048 sequences, of which one or two are not full. Sequence ids are
    unique over all shards. An empty table gives an empty table.
    """
    pieces = stored(pieces, "pieces")
    ship(pieces.sparkSession)
    rows, tokens = pieces.agg(F.count("*"), F.sum("length")).first()
    shards = max(1, -(-(tokens or 0) // shard_tokens), -(-rows // shard_rows))
    schema = schema_of(pieces, pieces.columns, "sequence_id long, offset long")
    arrow = to_arrow_schema(schema)
    at = pieces.columns.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        whole = pa.Table.from_batches(got).combine_chunks()
        lengths = whole.column(at).to_pylist()
        sequence, offset = [0] * len(lengths), [0] * len(lengths)
        for number, members in enumerate(best_two_fit(lengths, limit)):
            place = 0
            for row in members:
                sequence[row], offset[row] = (shard << 32) + number, place
                place += lengths[row]
        columns = [c.cast(arrow.field(i).type) for i, c in enumerate(whole.columns)]
        columns += [pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
        yield from pa.Table.from_arrays(columns, schema=arrow).to_batches()

    return pieces.repartition(shards).mapInArrow(run, schema)


def packed(docs: DataFrame, limit: int = 2048, **options) -> DataFrame:
    """Cut and pack documents; see ``token_pieces`` and ``pack``."""
    return pack(token_pieces(docs, limit, **options), limit)


def size_bound(lengths: Column, limit: int = 2048) -> Column:
    """No packing has fewer sequences than this."""
    return F.ceil(F.sum(lengths) / limit)
