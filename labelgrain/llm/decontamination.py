"""Benchmark decontamination by spaced-seed hashing.

A mask names the places of a window that count; the others may differ. Windows
of the benchmark and of the documents meet on the hash of their counted words,
and around each meeting the overlap is followed along its diagonal, with single
words substituted, and measured.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgrain.llm.hashing import FOLD, mix, text_chunks, word_hashes

#: Fixed masks over ten words, of which five count. However the words that differ
#: are placed in 10 to 19 words of which three quarters are equal, a mask misses
#: them at some place, and longer overlaps have such a part.
MASKS = ("1100001011", "1011010001", "0001100111", "1101010100", "0010011110", "0011101001", "1110100100", "0001111010")
SPAN = len(MASKS[0])
#: The same for items below ten words, which must be there whole.
SHORT_MASKS = {
    5: ("01111", "11110", "11011", "11101", "10111"),
    6: ("100111", "011101", "111010"),
    7: ("1100111", "0111011", "1011110", "1110101"),
    8: ("10011010", "01001101", "00110110", "11100001", "10101100", "01010011"),
    9: ("110011010", "001101011", "110100101", "101110100", "011010101", "011001110", "000011111", "110110001"),
}
#: An overlap counts from this many words on, or from the whole item if that is shorter ...
MIN_WORDS = 10
#: ... if this share of its words is equal.
MIN_SHARE = 0.75
#: Items of fewer words than this are too short to tell a leak from chance.
MIN_ITEM = 5
#: The words of the benchmark that one pass over the documents looks for.
BLOCK_WORDS = 1 << 18
#: Longer items are looked for in pieces of this many words, which overlap by four spans; only the last has fewer.
PIECE_WORDS = 1 << 12


def masked(words: np.ndarray, mask: str) -> np.ndarray:
    """A hash of the counted words of each window, by position."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            total = total * FOLD + words[k : n + k]
    return mix(total ^ np.uint64(int(mask, 2)))


@dataclass
class Seeds:
    """A block of the benchmark: word hashes of its pieces, and their windows by hash."""

    items: list[int]
    starts: list[int]
    words: list[np.ndarray]
    #: Per mask: sorted hashes, piece numbers, places.
    tables: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)

    def index(self) -> Seeds:
        found: dict[str, list[tuple[np.ndarray, int]]] = {}
        for number, words in enumerate(self.words):
            for mask in SHORT_MASKS.get(len(words), MASKS):
                found.setdefault(mask, []).append((masked(words, mask), number))
        for key, rows in found.items():
            hashes = np.concatenate([h for h, _ in rows])
            order = np.argsort(hashes, kind="stable")
            pieces = np.concatenate([np.full(len(h), n) for h, n in rows])[order]
            places = np.concatenate([np.arange(len(h)) for h, _ in rows])[order]
            self.tables[key] = (hashes[order], pieces, places)
        return self


def overlap(doc: np.ndarray, item: np.ndarray, diagonal: int, first: bool = True, last: bool = True) -> list[tuple[int, int, int]]:
    """The overlaps of two word sequences on one diagonal: start in the document, words, equal words.

    The longest run with enough words and equal words is taken, then the longest
    ones on its two sides, and so on. A run begins and ends in equal words or at
    an end of the item, which is within ``item`` if ``first`` and ``last`` say so.
    """
    low, high = max(0, diagonal), min(len(doc), len(item) + diagonal)
    same = doc[low:high] == item[low - diagonal : high - diagonal]
    gain = np.concatenate(([0.0], np.cumsum(np.where(same, 1 - MIN_SHARE, -MIN_SHARE))))
    begins, ends = np.append(same, False), np.append(False, same)
    begins[0] |= first and low == diagonal
    ends[-1] |= last and high == len(item) + diagonal
    least, found, open_ = min(MIN_WORDS, len(item)), [], [(0, high - low)]
    while open_:
        start, end = open_.pop()
        if end - start < least:
            continue
        starts = start + np.flatnonzero(begins[start:end])
        # the most that any end from here on has gained, which falls with the place
        most = np.maximum.accumulate(np.where(ends[start : end + 1], gain[start : end + 1], -np.inf)[::-1])
        until = end - np.searchsorted(most, gain[starts], side="left")
        if not len(starts) or (words := int((until - starts).max())) < least:
            continue
        at = int(starts[(until - starts).argmax()])
        found.append((low + at, words, int(same[at : at + words].sum())))
        open_ += [(start, at), (at + words, end)]
    return found


def overlaps(words: np.ndarray, at: np.ndarray, seeds: Seeds) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Of some documents, whose words begin at ``at``: document, item, start in both, words and equal words of each overlap."""
    tried: set[tuple[int, int, int]] = set()
    for key, (hashes, pieces, places) in seeds.tables.items():
        own, width = masked(words, key), len(key)
        left = np.searchsorted(hashes, own, side="left")
        hits = np.flatnonzero(hashes[np.minimum(left, len(hashes) - 1)] == own)
        docs = np.searchsorted(at, hits, side="right") - 1
        inside = hits + width <= at[docs + 1]
        for hit, doc in zip(hits[inside].tolist(), docs[inside].tolist(), strict=True):
            entry, first = int(left[hit]), int(at[doc])
            while entry < len(hashes) and hashes[entry] == own[hit]:
                piece, diagonal = int(pieces[entry]), int(hit - first - places[entry])
                entry += 1
                if (doc, piece, diagonal) in tried:
                    continue
                tried.add((doc, piece, diagonal))
                item, begin = seeds.words[piece], seeds.starts[piece]
                for start, n, equal in overlap(words[first : at[doc + 1]], item, diagonal, begin == 0, len(item) < PIECE_WORDS):
                    yield doc, seeds.items[piece], start, start - diagonal + begin, n, equal


def benchmark_pieces(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Word hashes of the items, in pieces of bounded length; items that are too short are left out."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column(1)):
                words, at = word_hashes(data, offsets)
                ids = batch.column(0)[first:end].to_pylist()
                rows = [
                    (ids[i], start, words[at[i] + start : min(at[i + 1], at[i] + start + PIECE_WORDS)])
                    for i in range(end - first)
                    if at[i + 1] - at[i] >= MIN_ITEM
                    for start in range(0, max(1, at[i + 1] - at[i] - 4 * SPAN + 1), PIECE_WORDS - 4 * SPAN)
                ]
                yield pa.RecordBatch.from_pydict(
                    {
                        "item_id": pa.array([r[0] for r in rows], pa.int64()),
                        "start": pa.array([r[1] for r in rows], pa.int64()),
                        "n": pa.array([len(r[2]) for r in rows], pa.int64()),
                        "words": pa.array([r[2].tobytes() for r in rows], pa.binary()),
                    }
                )

    return benchmark.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(pieces, "item_id bigint, start bigint, n bigint, words binary")


def blocks(pieces: DataFrame) -> Iterator[Seeds]:
    """The benchmark in blocks of at most ``BLOCK_WORDS`` words; a block's size is checked before it is fetched."""
    total = pieces.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if not total:
        return
    count = -(-total // BLOCK_WORDS)
    while True:
        dealt = pieces.withColumn("block", F.pmod(F.xxhash64("item_id", "start"), F.lit(count)))
        sizes = dealt.groupBy("block").agg(F.sum("n").alias("n"))
        if count == 1 or sizes.agg(F.max("n")).first()[0] <= BLOCK_WORDS:
            break
        count *= 2
    for block in range(count):
        rows = dealt.where(F.col("block") == block).orderBy("item_id", "start").collect()
        if rows:
            yield Seeds([r.item_id for r in rows], [r.start for r in rows], [np.frombuffer(r.words, dtype=np.uint64) for r in rows])


def benchmark_overlaps(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Per document and item that overlap, the longest overlap.

    Columns: ``id_col``, ``item_id``, ``doc_start`` and ``item_start`` (in words
    from 0), ``n_words``, ``n_equal``, and ``n_overlaps``, the number of places.
    Words are lower-cased A-Z and compared by 64-bit hash. An overlap has at
    least ``MIN_WORDS`` words, or the whole item if that is shorter, of which
    ``MIN_SHARE`` are equal, and begins and ends in equal words or at an end of
    the item. Items of fewer than ``MIN_ITEM`` words, null or
    empty texts and rows with a null item id are in no overlap; rows of a null
    document id are looked at and reported like others. Rows that repeat an id
    are taken together. The documents are read once for each block of the
    benchmark, and only what is found is shuffled.
    """
    sources = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    found: DataFrame | None = None
    for seeds in blocks(benchmark_pieces(benchmark.where(F.col(item_col).isNotNull()), item_col, item_text)):
        shared = docs.sparkSession.sparkContext.broadcast(seeds)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            held = shared.value if shared.value.tables else shared.value.index()
            for batch in batches:
                for first, end, data, offsets in text_chunks(batch.column(1)):
                    words, at = word_hashes(data, offsets)
                    ids = batch.column(0)[first:end].to_pylist()
                    rows = [(ids[doc], *hit) for doc, *hit in overlaps(words, at, held)]
                    columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=NAMES)

        part = sources.mapInArrow(search, ", ".join(f"{n} bigint" for n in NAMES))
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], ", ".join(f"{n} bigint" for n in NAMES))
    best = F.struct("n_equal", "n_words", (-F.col("doc_start")).alias("d"), (-F.col("item_start")).alias("i"))
    return (
        found.groupBy("doc_id", "item_id")
        .agg(F.max(best).alias("best"), F.count_distinct("doc_start", "item_start").alias("n_overlaps"))
        .select(
            F.col("doc_id").alias(id_col),
            "item_id",
            (-F.col("best.d")).alias("doc_start"),
            (-F.col("best.i")).alias("item_start"),
            F.col("best.n_words").alias("n_words"),
            F.col("best.n_equal").alias("n_equal"),
            "n_overlaps",
        )
    )


NAMES = ["doc_id", "item_id", "doc_start", "item_start", "n_words", "n_equal"]


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item.

    Rows are judged one by one where they are read, so rows that share an id, or
    have none, stand for themselves; nothing is shuffled. Null and empty texts stay,
    and with an empty benchmark all rows do.
    """
    place = docs.columns.index(text_col)
    for seeds in blocks(benchmark_pieces(benchmark.where(F.col("item_id").isNotNull()), "item_id", "text")):
        shared = docs.sparkSession.sparkContext.broadcast(seeds)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            held = shared.value if shared.value.tables else shared.value.index()
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                for first, _, data, offsets in text_chunks(batch.column(place)):
                    words, at = word_hashes(data, offsets)
                    keep[[first + doc for doc, *_ in overlaps(words, at, held)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
