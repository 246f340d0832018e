"""Similarity join on word shingles with filters under several token orders.

Two sets that are similar enough share a token among the first ones of each,
whatever order all tokens are put in. Candidates meet on such prefix tokens under
a rare-first order; before two sets are compared in full, their prefixes under
further orders must meet too.

A group of near copies never becomes all its pairs. In each bucket of documents
with one prefix token, the members are first compared with the smallest one. Only
where a bucket still holds several components are pairs across them compared, so
that every link between components is found, and none within one is needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgrain.llm.components import components
from labelgrain.llm.hashing import mix, shingle_sets
from labelgrain.llm.storage import stored

WIDTH = 5
#: Similar: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Bytes of text for each cell of the counters that the rare-first order goes by, and bounds of the number of
#: cells, as powers of two. Any cells serve; more of them only make buckets smaller.
CELL_BYTES = 128
LEAST_CELLS, MOST_CELLS = 16, 24
CELL_PARTS = 16
#: Prefix entries that one task sorts, and those of one token from which its documents are dealt to several tasks.
RANGE_ENTRIES = 1 << 19
HOT_ENTRIES = 1 << 17
#: Entries that a task holds before it hands them on.
HELD_ENTRIES = 1 << 21
ORDERS = (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F)


def prefix_length(n: int, percent: int) -> int:
    return n + (percent * n) // -100 + 1


@dataclass(frozen=True)
class Counters:
    """Per cell how often its tokens occur, in eighths of powers of two; and the median, as a number."""

    levels: np.ndarray
    usual: float

    def of(self, tokens: np.ndarray) -> np.ndarray:
        return self.levels[cell(tokens, len(self.levels))]

    def parts(self, tokens: np.ndarray) -> np.ndarray:
        """How many tasks the documents of each token are dealt to."""
        return ((2.0 ** (self.of(tokens) / 8) - self.usual) // HOT_ENTRIES + 1).clip(1).astype(np.uint64)


def cell(tokens: np.ndarray, cells: int) -> np.ndarray:
    return (tokens >> np.uint64(65 - cells.bit_length())).astype(np.int64)


def prefix(tokens: np.ndarray, counters: Counters, order: int, percent: int) -> np.ndarray:
    """The first tokens of a set under one order: rare first, then by a hash that differs between orders.

    The first order goes by eighths of powers of two, the others by whole powers.
    """
    seen = counters.of(tokens)
    if order:
        seen = seen >> 3
    ranked = np.lexsort((mix(tokens ^ np.uint64(ORDERS[order])), seen))
    return tokens[ranked[: prefix_length(len(tokens), percent)]]


def similar(left: np.ndarray, right: np.ndarray, counters: Counters, percent: int) -> bool:
    """Whether two sets are similar; sizes and prefixes under the further orders are tried before the sets."""
    small, large = sorted((left, right), key=len)
    if 100 * len(small) < percent * len(large):
        return False
    for order in range(1, len(ORDERS)):
        a, b = prefix(small, counters, order, percent), prefix(large, counters, order, percent)
        if not np.isin(a, b, assume_unique=True).any():
            return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(small) + len(large) - both)


def described(docs: DataFrame, width: int, cells: int) -> DataFrame:
    """Per row its id, set size and set digest; and, per task, the cell counts of its sets in parts."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(cells, dtype=np.uint32)
        for batch in batches:
            sizes, digests = [], []
            for tokens in shingle_sets(batch.column(1), width):
                sizes.append(len(tokens))
                digests.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                np.add.at(counts, cell(tokens, cells), 1)
            none = pa.nulls(len(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), none.cast(pa.int32()), none.cast(pa.binary())],
                names=["doc", "n", "digest", "part", "counts"],
            )
        if counts.any():
            parts = [pa.compress(p.tobytes(), "zstd", asbytes=True) for p in np.split(counts, CELL_PARTS)]
            none = pa.nulls(CELL_PARTS)
            yield pa.RecordBatch.from_arrays(
                [none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.binary()), pa.array(range(CELL_PARTS), pa.int32()), pa.array(parts, pa.binary())],
                names=["doc", "n", "digest", "part", "counts"],
            )

    return docs.mapInArrow(describe, "doc bigint, n bigint, digest binary, part int, counts binary")


def cell_counts(parts: DataFrame, cells: int) -> Counters:
    """The sum of all tasks' cell counts, as eighths of powers of two, a byte for each cell."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.frombuffer(pa.decompress(counts.as_buffer(), cells // CELL_PARTS * 4, "zstd"), dtype=np.uint32)
                sums[part] = sums.get(part, 0) + own.astype(np.float64)
        eighths = [np.rint(8 * np.log2(s + 1)).astype(np.uint8) for s in sums.values()]
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array(list(sums), pa.int32()), "counts": pa.array([s.tobytes() for s in eighths], pa.binary())}
        )

    summed = parts.repartition(CELL_PARTS, "part").mapInArrow(add, "part int, counts binary").collect()
    found = np.zeros((CELL_PARTS, cells // CELL_PARTS), dtype=np.uint8)
    for row in summed:
        found[row.part] = np.frombuffer(row.counts, dtype=np.uint8)
    levels = found.reshape(-1)
    return Counters(levels, float(2.0 ** (np.median(levels) / 8)))


def entry_blob(tokens: np.ndarray, docs: np.ndarray, sizes: np.ndarray, places: np.ndarray) -> bytes:
    """Tokens, the numbers of their documents and their places, with the documents and their set sizes."""
    distinct, first, at = np.unique(docs, return_index=True, return_inverse=True)
    kinds = ["<u4" if n > 1 << 16 else "<u2" for n in (len(distinct), int(places.max()) + 1)]
    head = np.array([len(tokens), len(distinct), kinds[0] == "<u4", kinds[1] == "<u4"], dtype="<i8")
    parts = (head, distinct, sizes[first], tokens, at.astype(kinds[0]), places.astype(kinds[1]))
    return b"".join(x.tobytes() for x in parts)


def from_entry_blob(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n, d, wide_docs, wide_places = np.frombuffer(blob, dtype="<i8", count=4).tolist()
    at, found = 32, []
    for kind, count in (("<i8", d), ("<i8", d), ("<u8", n), ("<u4" if wide_docs else "<u2", n), ("<u4" if wide_places else "<u2", n)):
        found.append(np.frombuffer(blob, dtype=kind, count=count, offset=at))
        at += count * found[-1].itemsize
    docs, sizes, tokens, number, places = found
    return tokens, docs[number], sizes[number], places.astype(np.int64)


def prefix_entries(docs: DataFrame, counters, ranges: int, width: int, percent: int) -> DataFrame:
    """Prefix tokens with their documents, set sizes and places in the order, packed by range of tokens.

    Of documents with equal sets a task passes on one. The documents of a hot
    token are dealt to as many parts of its range as its count asks for.
    """

    def pack(held: list[tuple[np.ndarray, int, int, np.ndarray]]) -> pa.RecordBatch:
        lengths = [len(h[0]) for h in held]
        token, part = (np.concatenate([h[k] for h in held]) for k in (0, 3))
        doc, size = (np.repeat(np.array([h[k] for h in held], dtype=np.int64), lengths) for k in (1, 2))
        place = np.concatenate([np.arange(n) for n in lengths])
        order = np.argsort(part, kind="stable")
        token, doc, size, place, part = (x[order] for x in (token, doc, size, place, part))
        cuts = np.flatnonzero(np.diff(part)) + 1
        blobs = [entry_blob(*x) for x in zip(*(np.split(y, cuts) for y in (token, doc, size, place)), strict=True)]
        return pa.RecordBatch.from_pydict({"part": pa.array(part[np.concatenate(([0], cuts))]), "entries": pa.array(blobs, pa.binary())})

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        held: list[tuple[np.ndarray, int, int, np.ndarray]] = []
        n_held = 0
        for batch in batches:
            for doc, full in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), width), strict=True):
                if doc is None or not len(full):
                    continue
                digest = hashlib.blake2b(full.tobytes(), digest_size=16).digest()
                if digest in seen:
                    continue
                seen.add(digest)
                own = prefix(full, counters.value, 0, percent)
                salt = mix(np.array([doc], dtype=np.int64).view(np.uint64)) % counters.value.parts(own)
                held.append((own, doc, len(full), (own % np.uint64(ranges) + salt * np.uint64(ranges)).astype(np.int64)))
                n_held += len(own)
                if n_held >= HELD_ENTRIES:
                    yield pack(held)
                    held, n_held = [], 0
        if held:
            yield pack(held)

    return docs.mapInArrow(entries, "part bigint, entries binary")


def least_overlap(n, m, percent: int):
    """How many tokens two sets of these sizes must share, at least, without rounding up."""
    return (n + m) * (percent / (100 + percent))


def hopeful(bucket: np.ndarray, size: np.ndarray, left: np.ndarray, percent: int) -> np.ndarray:
    """Which members of sorted buckets may have a partner there.

    A token is the first that two sets share only if what is ``left`` of either
    from it on is enough for their least overlap. So the smaller set has it near
    its beginning, and the larger one bounds the sizes of its partners.
    """
    early = left + 1e-6 >= least_overlap(size, size, percent)
    scale = int(size.max()) + 2
    keys = np.sort(bucket[early] * scale + size[early])
    low = np.ceil(size * (percent / 100) - 1e-6).astype(np.int64)
    high = np.minimum(size, np.floor(left * ((100 + percent) / percent) - size + 1e-6).astype(np.int64))
    partners = np.searchsorted(keys, bucket * scale + np.maximum(high, 0), side="right") - np.searchsorted(keys, bucket * scale + low, side="left")
    as_larger = (partners - early > 0) & (high >= low)
    # an early one may also be the smaller of a pair, with anyone up to the size that its own rest allows
    everyone = np.sort(bucket * scale + size)
    top = np.minimum(np.floor(size * (100 / percent) + 1e-6), np.floor(left * ((100 + percent) / percent) - size + 1e-6)).astype(np.int64)
    top = np.minimum(top, scale - 1)
    as_smaller = early & (np.searchsorted(everyone, bucket * scale + top, side="right") - np.searchsorted(everyone, bucket * scale + size, side="left") > 1)
    return as_larger | as_smaller


def bucket_rows(entries: DataFrame, counters, percent: int) -> DataFrame:
    """What the buckets of prefix tokens say: pairs with a leading member, and who shares a bucket.

    ``kind`` 0: candidate pair ``a``, ``b``. ``kind`` 1: document ``b`` is in
    bucket ``a``, with its set size ``n`` and how much of it is ``left`` from the
    token on, for buckets of three and more; of buckets with the same members the
    one of the first token counts. ``kind`` 2: ``b`` is the smallest document in
    one part of the hot bucket ``a``.
    """

    def split(rows: pd.DataFrame) -> pd.DataFrame:
        token, doc, size, place = (np.concatenate(x) for x in zip(*map(from_entry_blob, rows["entries"]), strict=True))
        order = np.lexsort((doc, token))
        token, doc, size, left = token[order], doc[order], size[order], (size - place)[order]
        keep = np.concatenate(([True], (token[1:] != token[:-1]) | (doc[1:] != doc[:-1])))
        for _ in range(2):  # once for rows alike, once for members without hope
            token, doc, size, left = token[keep], doc[keep], size[keep], left[keep]
            if not len(token):
                return pd.DataFrame({"kind": [], "a": [], "b": [], "n": [], "left": []}).astype({"kind": "int32", "a": "int64", "b": "int64", "n": "int64", "left": "int64"})
            start = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
            members = np.diff(np.append(start, len(token)))
            hot = counters.value.parts(token[start]) > 1
            bucket = np.repeat(np.arange(len(start)), members)
            keep = hopeful(bucket, size, left, percent) | hot[bucket]

        # the early member of the smallest id leads its bucket
        late = left + 1e-6 < least_overlap(size, size, percent)
        lead = np.lexsort((doc, late, bucket))[start]
        first, first_size, first_left = doc[lead][bucket], size[lead][bucket], left[lead][bucket]
        close = (doc != first) & (np.minimum(left, first_left) + 1e-6 >= least_overlap(size, first_size, percent))
        pairs = np.unique(np.sort(np.stack([first, doc], axis=1)[close], axis=1), axis=0)

        who = mix(np.add.reduceat(mix(doc.view(np.uint64)), start) ^ members.astype(np.uint64))
        key = np.where(hot, token[start], who)
        by = np.lexsort((-left[start], key))
        chosen = np.zeros(len(start), dtype=bool)
        chosen[by[np.concatenate(([True], key[by][1:] != key[by][:-1]))]] = True
        shared = (chosen & (hot | (members >= 3)))[bucket]
        n_hot = int(hot.sum())
        none = np.zeros(len(pairs) + n_hot, dtype=np.int64)
        return pd.DataFrame(
            {
                "kind": np.concatenate([np.zeros(len(pairs), np.int32), np.ones(int(shared.sum()), np.int32), np.full(n_hot, 2, np.int32)]),
                "a": np.concatenate([pairs[:, 0], key[bucket][shared].view(np.int64), key[hot].view(np.int64)]),
                "b": np.concatenate([pairs[:, 1], doc[shared], doc[start[hot]]]),
                "n": np.concatenate([none[: len(pairs)], size[shared], none[len(pairs) :]]),
                "left": np.concatenate([none[: len(pairs)], left[shared], none[len(pairs) :]]),
            }
        )

    return entries.groupBy("part").applyInPandas(split, "kind int, a bigint, b bigint, n bigint, left bigint")


def verified(pairs: DataFrame, texts: DataFrame, counters, width: int, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose texts are similar.

    Pairs and texts both grow with the input, so neither side is broadcast.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, np.ndarray] | None = None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            for i, right in enumerate(shingle_sets(batch.column(3), width)):
                if last is None or last[0] != a[i]:
                    last = (a[i], next(shingle_sets(batch.column(2).slice(i, 1), width)))
                if similar(last[1], right, counters.value, percent):
                    keep.append(i)
            yield pa.RecordBatch.from_pydict({"a": pa.array([a[i] for i in keep], pa.int64()), "b": pa.array([b[i] for i in keep], pa.int64())})

    right = texts.select(F.col("doc").alias("b"), F.col("text").alias("right"))
    left = texts.select(F.col("doc").alias("a"), F.col("text").alias("left"))
    return pairs.join(right.hint("merge"), "b").join(left.hint("merge"), "a").select("a", "b", "left", "right").mapInArrow(check, "a bigint, b bigint")


def sized(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs as classes ``a`` < ``b``, once each, without those whose sizes rule them out."""
    of = classes.select("doc", "class", "n")
    both = (
        pairs.distinct().join(of.select(F.col("doc").alias("a"), F.col("class").alias("ca"), F.col("n").alias("na")), "a")
        .join(of.select(F.col("doc").alias("b"), F.col("class").alias("cb"), F.col("n").alias("nb")), "b")
        .where((F.col("ca") != F.col("cb")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")))
    )
    return both.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct()


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``n_shingles`` and ``component_id``.

    The set of a text is its distinct shingles of ``width`` words, lower-cased
    A-Z, compared by 64-bit hash; a text with fewer words has its whole sequence
    as its one shingle. Texts link when 100 * intersection >= ``percent`` *
    union, and ``component_id`` is the smallest id that links lead to. A text
    that is null or has no word is linked with nothing. Ids must be whole
    numbers; rows that repeat an id are one document with all their links, and
    a row without an id has no component and gives none. Other columns are not
    looked at; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text"))
    n_bytes = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    cells = 1 << min(MOST_CELLS, max(LEAST_CELLS, (n_bytes // CELL_BYTES).bit_length()))
    seen = stored(described(source, width, cells))
    rows = seen.where("part is null")
    counters = spark.sparkContext.broadcast(cell_counts(seen.where("part is not null").select("part", "counts"), cells))
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ranges = max(1, -(-total * (100 - percent) // (100 * RANGE_ENTRIES)))

    first = rows.where("n > 0 and doc is not null").groupBy("digest").agg(F.min("doc").alias("class"))
    classes = stored(rows.where("n > 0 and doc is not null").join(first, "digest").select("doc", "class", "n").distinct())
    met = stored(bucket_rows(prefix_entries(source, counters, ranges, width, percent), counters, percent))
    leaders = met.where("kind = 2").select("a", "b")
    least = leaders.groupBy("a").agg(F.min("b").alias("least"))
    hot = leaders.join(least, "a").where("least != b").select(F.col("least").alias("a"), "b")
    pairs = stored(sized(met.where("kind = 0").select("a", "b").union(hot), classes, percent))
    shared = met.where("kind = 1").select(F.col("a").alias("bucket"), F.col("b").alias("doc"), "n", "left")
    members = stored(
        shared.join(classes.select("doc", "class"), "doc").groupBy("bucket", "class", "n").agg(F.max("left").alias("left"))
    )

    wanted = pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).union(members.select("class")).distinct()
    texts = stored(source.join(wanted.hint("merge"), "doc", "left_semi"))
    links = stored(verified(pairs, texts, counters, width, percent))
    known = components(links)

    placed = members.join(known, members["class"] == known["node"], "left").withColumn("component", F.coalesce("component", "class")).drop("node")
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
    placed = stored(placed.join(mixed.select("bucket"), "bucket", "left_semi"))
    one = placed.select("bucket", F.col("component").alias("ca"), F.col("class").alias("a"), F.col("n").alias("na"), F.col("left").alias("la"))
    other = placed.select(F.col("bucket").alias("other"), F.col("component").alias("cb"), F.col("class").alias("b"), F.col("n").alias("nb"), F.col("left").alias("lb"))
    near = (
        (F.col("bucket") == F.col("other"))
        & (F.col("a") < F.col("b"))
        & (F.col("ca") != F.col("cb"))
        & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        & ((100 + percent) * F.least("la", "lb") >= percent * (F.col("na") + F.col("nb")))
    )
    more = stored(one.join(other, near).select("a", "b").distinct().join(pairs, ["a", "b"], "left_anti"))
    found = stored(verified(more, texts, counters, width, percent))
    repeated = classes.groupBy("doc").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a != b").select("a", "b")
    labels = components(links.union(found).union(repeated))
    of = (
        classes.select("doc", "class").distinct().join(labels, F.col("class") == labels["node"], "left")
        .groupBy("doc").agg(F.min(F.coalesce("component", "class")).alias("component_id"))
    )
    return rows.select("doc", "n").join(of, "doc", "left").select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc").alias("component_id")
    )


def keep_one_of_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are the first of their component, with all their columns; rows without an id stay."""
    groups = similar_groups(docs, id_col, text_col)
    later = groups.where(F.col("component_id") != F.col(id_col)).select(F.col(id_col).alias("_later")).distinct()
    return docs.join(later, F.col(id_col) == F.col("_later"), "left_anti")
