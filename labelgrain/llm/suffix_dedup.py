"""Removal of repeated 50-byte strings by prefix-free parsing.

A rolling hash over 24 bytes cuts every text at its triggers. The phrases between
triggers, each with the 49 bytes that follow it, form a dictionary, and the
parse says which documents hold which phrase. A phrase that an earlier document
holds is settled whole, so however repetitive the corpus is, only the first
holder of a phrase goes on.

What is left are strings that begin in one phrase and were met in another. All
strings of 50 bytes have a smallest rolling hash among their 24-byte windows, at
the same place wherever they occur. Strings whose smallest window occurs in one
document only are unique. The rest, as pieces of neighbouring strings with one
smallest window, are a second dictionary, in ranges by that window, whose parse
lists document and place of each piece. Each range sorts its suffixes by their
bytes into a suffix array. Strings end after 50 bytes, which every piece still
holds, so what follows a piece in the parse can't order two of its suffixes;
the parse says where a suffix lies in the corpus. Equal neighbours of the array
take the first document that the parse names for any of them.

Every exchange is combined in the task that reads the texts, so a string that a
third of all documents hold is sent once per task.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgrain.llm.hashing import mix, text_chunks, window_hashes
from labelgrain.llm.storage import stored

#: Bytes of a string that counts as repeated, and of the rolling hash's window.
LENGTH, WINDOW = 50, 24
SPAN = LENGTH - WINDOW + 1
#: A window is a trigger if its hash is 0 modulo this, so phrases have some 64 bytes.
MODULUS = 64
#: Text that is hashed at a time; and entries that a task holds, or one task of the other side sorts.
CHUNK = 1 << 18
HELD = 1 << 21
#: A window of more documents than this gives up its pieces string by string, to as many ranges.
HOT = 4096
#: Documents of a window are spread over this many when hot windows are marked.
SALTS = 64
ENTRY = np.dtype([("key", "<u8"), ("more", "<u8"), ("doc", "<i8"), ("version", "<u4"), ("start", "<i4"), ("end", "<i4"), ("settled", "u1")])
RANGES = "doc bigint, version bigint, start int, end int"


def runs(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins, of sorted keys."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))


def settle(entries: np.ndarray) -> np.ndarray:
    """The entries in order, those settled for which an entry with the same key has a smaller document."""
    entries = entries[np.lexsort((entries["more"], entries["key"]))]
    key, more = entries["key"], entries["more"]
    start = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (more[1:] != more[:-1]))))
    least = np.repeat(np.minimum.reduceat(entries["doc"], start), np.diff(np.append(start, len(entries))))
    entries["settled"] |= entries["doc"] > least
    return entries


def squeeze(columns: list[np.ndarray], *counts: int) -> bytes:
    """Counts and columns as compressed bytes."""
    raw = np.array(counts, dtype="<u4").tobytes() + b"".join(np.ascontiguousarray(x).tobytes() for x in columns)
    return np.array([len(raw)], dtype="<u4").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unsqueezed(blob: bytes) -> bytes:
    return pa.decompress(blob[4:], int(np.frombuffer(blob, dtype="<u4", count=1)[0]), codec="zstd", asbytes=True)


def taken(raw: bytes, at: int, kinds: list[str], n: int) -> tuple[list[np.ndarray], int]:
    """Columns of ``n`` values that lie one after the other from a place on, and the place behind them."""
    found = []
    for kind in kinds:
        found.append(np.frombuffer(raw, dtype=kind, count=n, offset=at))
        at += n * np.dtype(kind).itemsize
    return found, at


def deltas(docs: np.ndarray) -> np.ndarray:
    return np.diff(docs, prepend=np.int64(0))


def entry_blob(entries: np.ndarray) -> bytes:
    return squeeze([deltas(entries[n]) if n == "doc" else entries[n] for n in ENTRY.names], len(entries))


def from_entry_blob(blob: bytes) -> np.ndarray:
    raw = unsqueezed(blob)
    entries = np.empty(int(np.frombuffer(raw, dtype="<u4", count=1)[0]), dtype=ENTRY)
    at = 4
    for name in ENTRY.names:
        (column,), at = taken(raw, at, [ENTRY[name].str], len(entries))
        entries[name] = np.cumsum(column) if name == "doc" else column
    return entries


def packed(entries: np.ndarray, parts: int) -> pa.RecordBatch:
    """Entries by part, open ones by key and settled ones by document; within a part by document, which packs well."""
    entries = settle(entries)
    by = np.where(entries["settled"] > 0, entries["doc"].astype(np.uint64), entries["key"])
    part = (mix(by) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((entries["start"], entries["doc"], part))
    entries, part = entries[order], part[order]
    first = runs(part)
    return pa.RecordBatch.from_pydict(
        {"part": pa.array(part[first]), "entries": pa.array([entry_blob(x) for x in np.split(entries, first[1:])], pa.binary())}
    )


def joined_ranges(doc: np.ndarray, version: np.ndarray, start: np.ndarray, end: np.ndarray) -> pd.DataFrame:
    """Ranges of beginnings, those that touch joined."""
    order = np.lexsort((start, version, doc))
    doc, version, start, end = doc[order], version[order], start[order], end[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (version[1:] != version[:-1]) | (start[1:] > end[:-1])
    first = np.flatnonzero(new)
    end = np.maximum.reduceat(end, first) if len(first) else end
    return pd.DataFrame({"doc": doc[first], "version": version[first].astype(np.int64), "start": start[first], "end": end})


def settled_ranges(blobs: DataFrame) -> DataFrame:
    """The settled ones of the exchanged phrases, neighbours joined to ranges."""

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        entries = settle(np.concatenate([from_entry_blob(x) for x in rows["entries"]]))
        entries = entries[entries["settled"] > 0]
        return joined_ranges(*(entries[n] for n in ("doc", "version", "start", "end")))

    return blobs.groupBy("part").applyInPandas(gather, RANGES)


def of_pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Some texts' bytes at a time: first row, end row, bytes, offsets, and where each text's last string begins.

    A text longer than a chunk comes in pieces that overlap by less than a
    string, with its place as the negative of the first offset.
    """
    for first, end, data, offsets in text_chunks(column, CHUNK):
        if len(data) <= 4 * CHUNK:
            yield first, end, data, offsets, np.maximum(offsets[1:] - LENGTH + 1, offsets[:-1])
        else:
            for at in range(0, len(data) - LENGTH + 1, CHUNK):
                piece = data[at : at + CHUNK + LENGTH - 1]
                yield first, end, piece, np.array([-at, len(piece)]), np.array([len(piece) - LENGTH + 1])


def smallest_windows(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per string of 50 bytes the place of its smallest 24-byte window; and the hashes of all windows."""
    hashes = window_hashes(data, WINDOW)
    if len(hashes) < SPAN:
        return np.empty(0, dtype=np.int64), hashes
    ranked = (hashes & np.uint64(~((1 << 22) - 1) & (1 << 64) - 1)) | np.arange(len(hashes), dtype=np.uint64)
    for step in (1, 2, 4, 8):
        ranked = np.minimum(ranked[:-step], ranked[step:])
    ranked = np.minimum(ranked[: len(ranked) - (SPAN - 16)], ranked[SPAN - 16 :])
    return (ranked & np.uint64((1 << 22) - 1)).astype(np.int64), hashes


def open_strings(n: int, offsets: np.ndarray, last: np.ndarray, covered: list, versions: list) -> np.ndarray:
    """Which places begin a string that lies in one text and in no settled phrase."""
    change = np.zeros(n + 2, dtype=np.int32)
    np.add.at(change, np.clip(offsets[:-1], 0, n), 1)
    np.add.at(change, np.minimum(last, n), -1)
    for i, ranges in enumerate(covered):
        for r in ranges or ():
            if r["version"] == versions[i]:
                low, high = (min(max(offsets[i] + x, max(offsets[i], 0)), last[i]) for x in (r["start"], r["end"]))
                if low < high:
                    change[low] -= 1
                    change[high] += 1
    return np.cumsum(change)[:n] > 0


def phrase_entries(docs: DataFrame, parts: int) -> DataFrame:
    """The phrases of all texts, combined per task."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            ids, versions = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, end, data, offsets, last in of_pieces(batch.column(2)):
                cuts = np.flatnonzero(window_hashes(data, WINDOW) % np.uint64(MODULUS) == 0)
                view = memoryview(np.ascontiguousarray(data))
                for i in range(end - first):
                    begin, stop = max(0, int(offsets[i])), int(last[i])
                    if ids[first + i] is None or begin >= stop:
                        continue
                    own = cuts[np.searchsorted(cuts, begin + 1) : np.searchsorted(cuts, stop)].tolist()
                    for a, b in zip([begin, *own], [*own, stop], strict=True):
                        key = hashlib.blake2b(view[a : b + LENGTH - 1], digest_size=16).digest()
                        held.append((int.from_bytes(key[:8], "little"), int.from_bytes(key[8:], "little"), ids[first + i], versions[first + i], a - offsets[i], b - offsets[i], 0))
            if len(held) >= HELD >> 2:
                yield packed(np.array(held, dtype=ENTRY), parts)
                held = []
        if held:
            yield packed(np.array(held, dtype=ENTRY), parts)

    return docs.mapInArrow(parse, "part bigint, entries binary")


def key_blob(keys: np.ndarray, docs: np.ndarray) -> bytes:
    """Keys cut to 48 bits, documents by number, and the documents."""
    distinct, at = np.unique(docs, return_inverse=True)
    head = np.array([len(keys), len(distinct)], dtype="<i8").tobytes()
    cut = np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, 2:])
    return head + distinct.tobytes() + at.astype("<u4" if len(distinct) > 1 << 16 else "<u2").tobytes() + cut.tobytes()


def from_key_blob(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, d = np.frombuffer(blob, dtype="<i8", count=2)
    distinct = np.frombuffer(blob, dtype="<i8", count=d, offset=16)
    kind = np.dtype("<u4" if d > 1 << 16 else "<u2")
    at = np.frombuffer(blob, dtype=kind, count=n, offset=16 + 8 * d)
    keys = np.zeros((n, 8), dtype=np.uint8)
    keys[:, 2:] = np.frombuffer(blob, dtype=np.uint8, offset=16 + 8 * d + kind.itemsize * n).reshape(n, 6)
    return keys.reshape(-1).view(np.uint64), distinct[at]


def key48(hashes: np.ndarray) -> np.ndarray:
    return hashes & np.uint64(0xFFFFFFFFFFFF0000)


#: Stands for a key that its task has found in several documents.
SEVERAL = np.iinfo(np.int64).min


def shared_entries(texts: DataFrame, parts: int) -> DataFrame:
    """Smallest windows of the open strings: rows ``doc, key`` of those a task has found in several documents, and the rest packed for exchange."""

    def pack(keys: list[np.ndarray], docs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, doc = np.concatenate(keys), np.concatenate(docs)
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])))
        key, doc = key[new], doc[new]
        first = runs(key)
        size = np.diff(np.append(first, len(key)))
        several = np.repeat(size > 1, size)
        if several.any():
            n = int(several.sum())
            yield batch_of(pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(doc[several]), pa.array(key[several].view(np.int64)))
        key, doc = key[first], np.where(size > 1, SEVERAL, doc[first])
        part = (mix(key) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        key, doc, part = key[order], doc[order], part[order]
        first = runs(part)
        blobs = [key_blob(k, d) for k, d in zip(np.split(key, first[1:]), np.split(doc, first[1:]), strict=True)]
        n = len(blobs)
        yield batch_of(pa.array(part[first]), pa.array(blobs, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()))

    def batch_of(part: pa.Array, entries: pa.Array, doc: pa.Array, key: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([part, entries, doc, key], names=["part", "entries", "doc", "key"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        docs: list[np.ndarray] = []
        held = 0
        for batch in batches:
            ids, versions, covered = (batch.column(k).to_pylist() for k in (0, 1, 3))
            for first, end, data, offsets, last in of_pieces(batch.column(2)):
                at, hashes = smallest_windows(data)
                places = np.flatnonzero(open_strings(len(at), offsets, last, covered[first:end], versions[first:end]))
                if not len(places):
                    continue
                doc = np.searchsorted(offsets, places, side="right") - 1
                at = at[places]
                new = np.concatenate(([True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])))
                keys.append(key48(hashes[at[new]]))
                docs.append(np.array([SEVERAL if x is None else x for x in ids[first:end]], dtype=np.int64)[doc[new]])
                held += int(new.sum())
                if held >= HELD:
                    yield from pack(keys, docs)
                    keys, docs, held = [], [], 0
        if held:
            yield from pack(keys, docs)

    return texts.mapInArrow(find, "part bigint, entries binary, doc bigint, key bigint")


def shared_keys(blobs: DataFrame) -> DataFrame:
    """``doc``, ``key`` for exchanged keys that more than one document holds."""

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        both = [from_key_blob(x) for x in rows["entries"]]
        key, doc = np.concatenate([k for k, _ in both]), np.concatenate([d for _, d in both])
        order = np.argsort(key, kind="stable")
        key, doc = key[order], doc[order]
        first = runs(key)
        size = np.diff(np.append(first, len(key)))
        # one task's entry of a key is one document or SEVERAL; a document may come from two tasks if its id repeats
        several = np.repeat((np.maximum.reduceat(doc, first) != np.minimum.reduceat(doc, first)) & (size > 1), size) & (doc != SEVERAL)
        return pd.DataFrame({"doc": doc[several], "key": key[several].view(np.int64)})

    return blobs.groupBy("part").applyInPandas(gather, "doc bigint, key bigint")


#: Columns of a parse: the piece, or for settled ones the number of strings, then document, version and first place.
PARSE = ["<u4", "<i8", "<u4", "<i4"]


def piece_blob(pieces: list[bytes], parse: np.ndarray, settled: np.ndarray) -> bytes:
    """Distinct pieces, and rows of their parse: open ones with the number of their piece, settled ones with that of their strings."""
    columns = [np.array([len(x) for x in pieces], dtype="<u1"), np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    for rows in (parse, settled):
        columns += [rows[:, 0].astype("<u4"), deltas(rows[:, 1]), rows[:, 2].astype("<u4"), rows[:, 3].astype("<i4")]
    return squeeze(columns, len(pieces), len(parse), len(settled))


def from_piece_blob(blob: bytes) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Lengths of the pieces, their bytes, and the columns of open and settled rows."""
    raw = unsqueezed(blob)
    n_pieces, n_open, n_settled = (int(x) for x in np.frombuffer(raw, dtype="<u4", count=3))
    (lengths,), at = taken(raw, 12, ["<u1"], n_pieces)
    lengths = lengths.astype(np.int64)
    (data,), at = taken(raw, at, ["<u1"], int(lengths.sum()))
    parse, at = taken(raw, at, PARSE, n_open)
    settled, at = taken(raw, at, PARSE, n_settled)
    for rows in (parse, settled):
        rows[1] = np.cumsum(rows[1])
    return lengths, data, parse, settled


def packed_pieces(held: dict[bytes, tuple[int, list[tuple[int, int, int]]]], parts: int) -> pa.RecordBatch:
    """Pieces by range, each once, with the places of its first document; other places are settled and go by document."""
    by_part: dict[int, tuple[list, list, list]] = {}
    for piece, (key, places) in held.items():
        pieces, parse, settled = by_part.setdefault(key % parts, ([], [], []))
        least = min(places)[0]
        parse += [(len(pieces), *x) for x in places if x[0] == least]
        pieces.append(piece)
        for x in places:
            if x[0] > least:
                by_part.setdefault(x[0] % parts, ([], [], []))[2].append((len(piece) - LENGTH + 1, *x))
    rows = lambda x: np.array(sorted(x, key=lambda y: y[1:]), dtype=np.int64).reshape(-1, 4)
    blobs = [piece_blob(pieces, rows(parse), rows(settled)) for pieces, parse, settled in by_part.values()]
    return pa.RecordBatch.from_pydict({"part": pa.array(list(by_part), pa.int64()), "entries": pa.array(blobs, pa.binary())})


def string_pieces(texts: DataFrame, parts: int) -> DataFrame:
    """The open strings whose smallest window several documents hold, neighbours of one window as one piece, combined per task.

    Pieces go to the range of their window; strings of a hot window go alone, to the range of the whole string.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, tuple[int, list[tuple[int, int, int]]]] = {}
        n_held = 0
        for batch in batches:
            ids, versions, covered = (batch.column(k).to_pylist() for k in (0, 1, 3))
            for first, end, data, offsets, last in of_pieces(batch.column(2)):
                at, hashes = smallest_windows(data)
                begins = open_strings(len(at), offsets, last, covered[first:end], versions[first:end])
                view = memoryview(np.ascontiguousarray(data))
                whole = None
                for i in range(end - first):
                    low, high = max(0, int(offsets[i])), int(last[i])
                    if low >= high:
                        continue
                    keys = key48(hashes[at[low:high]])
                    wanted, hot = (batch.column(k)[first + i].values.to_numpy() for k in (4, 5))
                    own = np.isin(keys.view(np.int64), wanted) & begins[low:high]
                    places = np.flatnonzero(own)
                    if not len(places):
                        continue
                    alone = np.isin(keys[places].view(np.int64), hot)
                    if alone.any() and whole is None:
                        whole = mix(window_hashes(data, LENGTH))
                    new = np.concatenate(([True], (np.diff(places) > 1) | (np.diff(at[places + low]) != 0) | alone[1:]))
                    begin = places[new] + low
                    size = np.diff(np.append(np.flatnonzero(new), len(places)))
                    ranges = mix(keys[places[new]])
                    if alone.any():
                        ranges = np.where(alone[new], whole[begin], ranges)
                    doc, version, shift = ids[first + i], versions[first + i], int(offsets[i])
                    for a, n, key in zip(begin.tolist(), size.tolist(), ranges.tolist(), strict=True):
                        piece = bytes(view[a : a + n + LENGTH - 1])
                        if piece not in held:
                            held[piece] = key, []
                        held[piece][1].append((doc, version, a - shift))
                    n_held += len(begin)
                    if n_held >= HELD >> 4:
                        yield packed_pieces(held, parts)
                        held, n_held = {}, 0
        if n_held:
            yield packed_pieces(held, parts)

    return texts.mapInArrow(find, "part bigint, entries binary")


def suffix_array(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the strings of 50 bytes that begin at some places by their bytes, and whether each differs from the one before."""
    strings = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[places].view(f"S{LENGTH}").reshape(-1)
    order = np.argsort(strings, kind="stable")
    strings = strings[order]
    return order, np.concatenate(([True], strings[1:] != strings[:-1]))


def repeated_ranges(blobs: DataFrame) -> DataFrame:
    """The strings of all pieces that a smaller document holds, neighbours joined to ranges."""

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        blobs = [from_piece_blob(x) for x in rows["entries"]]
        lengths, data = (np.concatenate([x[k] for x in blobs]) for k in (0, 1))
        shift = np.cumsum([0, *(len(x[0]) for x in blobs[:-1])])
        own, doc, version, start = (np.concatenate([x[2][k] for x in blobs]) for k in range(4))
        own = own.astype(np.int64) + np.repeat(shift, [len(x[2][0]) for x in blobs])
        n, *gone = (np.concatenate([x[3][k] for x in blobs]) for k in range(4))
        ends = [gone[2] + n.astype(np.int32)]
        if len(lengths):
            size = lengths - LENGTH + 1
            at = np.cumsum(size) - size
            piece = np.repeat(np.arange(len(size)), size)
            places = (np.cumsum(lengths) - lengths - at)[piece] + np.arange(len(piece))
            order, new = suffix_array(data, places)
            holder = np.full(len(size), np.iinfo(np.int64).max)
            np.minimum.at(holder, own, doc)
            first = np.flatnonzero(new)
            least = np.empty(len(order), dtype=np.int64)
            least[order] = np.repeat(np.minimum.reduceat(holder[piece[order]], first), np.diff(np.append(first, len(order))))
            # one row per string of each place of a piece
            many = size[own]
            row = np.repeat(np.arange(len(own)), many)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            late = doc[row] > least[at[own[row]] + nth]
            row, nth = row[late], nth[late].astype(np.int32)
            gone = [np.concatenate((x, y[row])) for x, y in zip(gone, (doc, version, start), strict=True)]
            gone[2][len(ends[0]) :] += nth
            ends.append(gone[2][len(ends[0]) :] + 1)
        return joined_ranges(*gone, np.concatenate(ends))

    return blobs.groupBy("part").applyInPandas(gather, RANGES)


def spans(n: int, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Removed byte spans, maximal and in order, of ranges of string beginnings."""
    found: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        end += LENGTH - 1
        if found and start <= found[-1][1]:
            found[-1] = (found[-1][0], max(end, found[-1][1]))
        else:
            found.append((start, min(end, n)))
    return found


def by_document(ranges: DataFrame, name: str) -> DataFrame:
    return ranges.groupBy("doc").agg(F.collect_list(F.struct("version", "start", "end")).alias(name))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc``, ``text`` (null is empty) and ``spans``, the byte spans to remove.

    A byte goes if a string of 50 bytes that covers it also begins in a row with
    a smaller id. A row without an id loses nothing and takes nothing from
    others; rows that share an id take nothing from each other. Ids must be whole
    numbers. Phrases are compared by 128-bit hashes, strings by their bytes, and
    rows that share an id are told apart by 32 bits of a hash of their text.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF)).alias("version"), text.alias("text"))
    n_bytes = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    name = f"texts_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_doc = source.repartition(buckets, "doc").write.option("compression", "zstd").bucketBy(buckets, "doc")
    by_doc.saveAsTable(name)
    table = spark.table(name)

    phrases = phrase_entries(source, max(1, n_bytes // MODULUS * 2 // HELD))
    covered = stored(settled_ranges(phrases))
    open_texts = table.join(by_document(covered, "covered"), "doc", "left").select("doc", "version", "text", "covered")
    entries = stored(shared_entries(open_texts, max(1, n_bytes // (SPAN // 2) // HELD)))
    keys = entries.where("part is null").select("doc", "key").union(shared_keys(entries.where("part is not null").select("part", "entries")))
    keys = stored(keys.where(F.col("doc") != int(SEVERAL)))
    often = keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT)
    often = often.select("key", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.col("key").alias("hot"))
    salted = keys.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int"))
    wanted = salted.join(often, ["key", "salt"], "left").groupBy("doc").agg(F.collect_set("key").alias("keys"), F.collect_set("hot").alias("hot"))
    asked = open_texts.join(wanted, "doc").select("doc", "version", "text", "covered", "keys", "hot")
    strings = repeated_ranges(string_pieces(asked, max(1, n_bytes // 16 // (HELD >> 2))))

    found = by_document(covered.unionByName(strings), "ranges")
    return table.join(found, "doc", "left").select("doc", "version", "text", "ranges")


def map_kept(rows: DataFrame, schema: str, kinds: list[pa.DataType], of: Callable[[int | None, bytes, list[tuple[int, int]]], tuple]) -> DataFrame:
    """One row per text: what ``of`` makes of its id, bytes and removed spans."""
    names = [x.split()[0] for x in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for doc, version, text, ranges in zip(*(batch.column(k) for k in range(4)), strict=True):
                data = text.as_buffer().to_pybytes()
                own = [(r["start"], r["end"]) for r in ranges.as_py() or () if r["version"] == version.as_py()]
                made.append(of(doc.as_py(), data, spans(len(data), own)))
            columns = list(zip(*made, strict=True)) if made else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return rows.mapInArrow(work, schema)


def kept_bytes(data: bytes, removed: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in removed for x in span), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs`` the id, ``kept`` (the bytes that stay) and ``spans`` removed, as start and end."""

    def of(doc, data, removed):
        return doc, kept_bytes(data, removed), [{"start": a, "end": b} for a, b in removed]

    schema = f"{id_col} bigint, kept binary, spans array<struct<start:bigint,end:bigint>>"
    kinds = [pa.int64(), pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
    return map_kept(repeated_spans(docs, id_col, text_col), schema, kinds, of)


def repeat_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs`` the id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``."""

    def of(doc, data, removed):
        digest = hashlib.sha256(kept_bytes(data, removed)).hexdigest()
        return doc, len(data), sum(b - a for a, b in removed), len(removed), digest

    schema = f"{id_col} bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return map_kept(repeated_spans(docs, id_col, text_col), schema, kinds, of)
