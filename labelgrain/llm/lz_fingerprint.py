"""Fingerprints of documents from their Lempel-Ziv phrases.

A text is parsed from left to right into phrases, each the shortest string not
in the dictionary yet, which it then joins. Texts that compress well together
share phrases, and the Jaccard likeness of their phrase sets is estimated from
the smallest hashes of each set, which are its fingerprint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelgrain.llm.hashing import mix, powers_for

#: Smallest phrase hashes in a fingerprint.
HASHES = 128
#: Phrases at which the dictionary starts anew, which bounds the memory of a very long text to some 60 MB.
DICTIONARY = 1 << 18
FIELDS = {"n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"}


class Parse:
    """The phrases of a text that is fed in pieces, as the places where they end."""

    def __init__(self) -> None:
        self.root: dict = {}
        self.node = self.root
        self.size = self.at = 0

    def feed(self, piece: str) -> list[int]:
        ends = []
        root, node, size, at = self.root, self.node, self.size, self.at
        for at, char in enumerate(piece, at + 1):
            follow = node.get(char)
            if follow is None:
                node[char] = {}
                ends.append(at)
                size += 1
                if size == DICTIONARY:
                    root, size = {}, 0
                node = root
            else:
                node = follow
        self.root, self.node, self.size, self.at = root, node, size, at
        return ends

    def feed_and_forget(self, piece: str) -> list[int]:
        """As ``feed``, with the dictionary as before at the end."""
        ends, added = [], []
        root, node, size = self.root, self.node, self.size
        for at, char in enumerate(piece, self.at + 1):
            follow = node.get(char)
            if follow is None:
                node[char] = {}
                added.append((node, char))
                ends.append(at)
                size += 1
                if size == DICTIONARY:
                    root, size = {}, 0
                node = root
            else:
                node = follow
        for node, char in added:
            del node[char]
        return ends


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def smallest_hashes(codes: np.ndarray, ends: list[int]) -> np.ndarray:
    """The sorted smallest distinct 32-bit hashes of the phrases of a text."""
    if not ends:
        return np.empty(0, dtype=np.uint32)
    up, down = powers_for(len(codes))
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], out=sums[1:])
    bounds = np.array([0, *ends])
    start, end = bounds[:-1], bounds[1:]
    return np.unique((mix((sums[end] - sums[start]) * down[start]) >> np.uint64(32)).astype(np.uint32))[:HASHES]


def as_text(hashes: np.ndarray) -> str:
    return hashes.astype(">u4").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), dtype=">u4")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The estimated Jaccard likeness of two phrase sets; exact for sets within a fingerprint, 1 for two empty ones."""
    both = np.union1d(a, b)[:HASHES]
    return len(np.intersect1d(np.intersect1d(a, b, True), both, True)) / len(both) if len(both) else 1.0


@dataclass
class Document:
    """A parsed text, with the parse of its first part kept for an edited end."""

    id: object
    text: str

    def __post_init__(self) -> None:
        self.kept = len(self.text) - len(self.text) // 4
        self.codes = code_points(self.text)
        self.parse = Parse()
        self.ends = self.parse.feed(self.text[: self.kept])
        self.hashes = smallest_hashes(self.codes, self.ends + self.parse.feed_and_forget(self.text[self.kept :]))

    def against(self, following: Document) -> tuple:
        """The values of ``FIELDS`` for this document before ``following``."""
        tail = following.text[: len(self.text) - self.kept]
        codes = np.concatenate((self.codes[: self.kept], following.codes[: len(tail)]))
        edited = smallest_hashes(codes, self.ends + self.parse.feed_and_forget(tail))
        digest = hashlib.sha256((self.text[: self.kept] + tail).encode()).hexdigest()
        return (len(self.text), digest, as_text(self.hashes), as_text(edited), likeness(self.hashes, edited), likeness(self.hashes, following.hashes))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id_col`` and ``fingerprint``, 8 hexadecimal digits a hash in ascending order.

    Equal texts have equal fingerprints; a null text is an empty one, whose
    fingerprint is empty. An empty table gives an empty result.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [as_text(Document(None, text.as_py() or "").hashes) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], names=["_id", "fingerprint"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"_id {kind}, fingerprint string").withColumnRenamed("_id", id_col)


def neighbour_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """Per row: ``id_col`` and ``FIELDS``, on its text, an edited text and the next row.

    The edited text has the last quarter of the code points, rounded down,
    replaced by as many of the first ones of the next row by ``id_col``, or all
    of them; the row after the last is the first. Null ids come first, and rows
    of one id are in the order of a hash of their texts. A null text is an empty
    one, and two empty texts have a likeness of 1. A single row follows itself;
    an empty table gives an empty result.

    Texts move once, to ranges of the order in ``partitions`` partitions, by
    default those of the session's shuffles. Only the last row of each needs a
    row of another; these, two rows a partition, are paired apart, from the same
    shuffle.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    order = ["_id", "_hash", "_place"]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # rows alike in id and text may be many, so their place parts them too
    ranged = rows.withColumns({"_hash": F.xxhash64("_text"), "_place": F.monotonically_increasing_id()}).repartitionByRange(n, *order)
    kind = rows.schema["_id"].dataType
    schema = ", ".join([f"_id {kind.simpleString()}", *(f"{k} {v}" for k, v in FIELDS.items())])
    names = ["_id", *FIELDS]

    def made(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        types = [id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            done = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                document = Document(i, text.as_py())
                if before is not None:
                    done.append((before.id, *before.against(document)))
                before = document
            yield made(done, batch.schema.field(0).type)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [(i, *Document(i, a.as_py()).against(Document(None, b.as_py()))) for i, a, b in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True)]
            yield made(done, batch.schema.field(0).type)

    inner = ranged.sortWithinPartitions(*order).select("_id", "_text").mapInArrow(within, schema)
    row = F.struct(*order, "_text")
    ends = ranged.withColumn("_part", F.spark_partition_id()).groupBy("_part").agg(F.min(row).alias("first"), F.max(row).alias("last"))
    by_part = Window.orderBy("_part")
    after = F.coalesce(F.lead("first._text").over(by_part), F.first("first._text").over(by_part))
    outer = ends.select(F.col("last._id").alias("_id"), F.col("last._text").alias("_text"), after.alias("_next")).mapInArrow(across, schema)
    return inner.unionByName(outer).withColumnRenamed("_id", id_col)
