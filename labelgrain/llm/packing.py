"""Best-two-fit packing of tokenised documents into fixed-length sequences.

Texts become pieces of at most ``CAPACITY`` tokens where they are read; from
there on only lengths move. Pieces are dealt to shards of bounded size, and each
shard fills its sequences by itself, so a shard wastes at most its last one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgrain.llm.storage import stored
from labelgrain.llm.tokenizing import CachedTokenizer

CAPACITY = 2048
END_OF_DOCUMENT = 0
#: Pieces that one task packs.
SHARD_PIECES = 1 << 14


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document: full ones, and a shorter first one if they don't come out even."""
    first = length % capacity or min(length, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)]


def token_pieces(docs: DataFrame, ranks_file: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", added: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32."""

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = CachedTokenizer.at(ranks_file, added)
        end = END_OF_DOCUMENT.to_bytes(4, "little")
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = []
            for doc_id, text in zip(ids, batch.column(1), strict=True):
                tokens = encoder.encode(text.as_py() or "") + end
                for k, (start, length) in enumerate(cut(len(tokens) // 4, capacity)):
                    rows.append((doc_id, k, start, length, zlib.crc32(tokens[4 * start : 4 * (start + length)])))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            types = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=NAMES)

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(tokenise, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]


@dataclass
class Lengths:
    """How many unpacked pieces there are of each length, and which lengths there are, as the bits of a number."""

    counts: list[int]
    there: int = 0

    def __post_init__(self) -> None:
        self.there = sum(1 << n for n, c in enumerate(self.counts) if c)

    def largest(self, most: int) -> int:
        """The largest length up to ``most`` that is left, or 0."""
        return (self.there & ((2 << most) - 1)).bit_length() - 1 if most > 0 and self.there & ((2 << most) - 1) else 0

    def take(self, n: int) -> None:
        self.counts[n] -= 1
        if not self.counts[n]:
            self.there &= ~(1 << n)

    def put(self, n: int) -> None:
        self.counts[n] += 1
        self.there |= 1 << n

    def best_two(self, gap: int) -> tuple[int, int]:
        """The two lengths left whose sum is largest within ``gap``, or (0, 0)."""
        best = (0, 0)
        first = self.largest(gap - 1)
        while first * 2 >= gap or (first and first * 2 > sum(best)):
            self.take(first)
            second = self.largest(gap - first)
            self.put(first)
            if second and first + second > sum(best):
                best = (first, second)
                if first + second == gap:
                    break
            first = self.largest(first - 1)
        return best


def best_two_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of lengths from 1 to ``capacity``, each of at most ``capacity`` in sum.

    A bin takes the longest piece that fits until none does. If a gap is left, its
    shortest piece goes back for the two unpacked ones that fill the gap so
    widened best, as long as they fill it better.
    """
    counts = [0] * (capacity + 1)
    for n in lengths:
        counts[n] += 1
    left, bins = Lengths(counts), []
    while left.there:
        packed, gap = [], capacity
        while n := left.largest(gap):
            left.take(n)
            packed.append(n)
            gap -= n
        while gap and left.there:
            smallest = packed[-1]
            two = left.best_two(gap + smallest)
            if sum(two) <= smallest:
                break
            packed.pop()
            left.put(smallest)
            for n in two:
                left.take(n)
            packed = sorted([*packed, *two], reverse=True)
            gap += smallest - sum(two)
        bins.append(packed)
    return bins


def pack_sequences(
    docs: DataFrame, ranks_file: str, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES, id_col: str = "doc_id", text_col: str = "text", added: bool = False
) -> DataFrame:
    """One row per piece: its document, tokens, sequence and place there.

    ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. A null or
    empty text is the end mark alone. Only documents longer than ``capacity`` are
    cut. Rows alike are packed as often as they occur; a null id is packed like
    any other. An empty table gives an empty result. With ``added`` the added token
    of the vocabulary is found inside texts.
    """
    pieces = stored(token_pieces(docs, ranks_file, capacity, id_col, text_col, added))
    shards = max(1, -(-pieces.count() // shard_pieces))

    def pack(key: tuple[int], rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece", "start", "ids_crc32"], kind="stable").reset_index(drop=True)
        lengths = rows["length"].to_numpy()
        of_length: dict[int, list[int]] = {}
        for i in range(len(lengths) - 1, -1, -1):
            of_length.setdefault(int(lengths[i]), []).append(i)
        sequence, offset = np.empty(len(rows), dtype=np.int64), np.empty(len(rows), dtype=np.int64)
        for number, packed in enumerate(best_two_fit(lengths.tolist(), capacity)):
            at = 0
            for n in packed:
                i = of_length[n].pop()
                sequence[i], offset[i] = number, at
                at += n
        return rows.drop(columns="shard").assign(sequence_id=key[0] * (1 << 32) + sequence, offset=offset)

    kind = pieces.schema["doc_id"].dataType.simpleString()
    return (
        pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)))
        .groupBy("shard")
        .applyInPandas(
            pack, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
        )
        .withColumnRenamed("doc_id", id_col)
    )
