"""Language identification with hyperdimensional profiles.

A letter has a random vector of +1 and -1 that follows from its code point. A
letter trigram is the product of its letters' vectors, each rotated by its place;
a text is the sum of its trigrams; a language's prototype is the sum of its
training texts. Texts are compared with prototypes by cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelgrain.llm.hashing import mix

DIMENSIONS = 1024
UNKNOWN = "und"
CHUNK_TEXTS, CHUNK_CHARS = 256, 1 << 19
#: Distinct trigrams whose vectors are held at a time.
TRIGRAMS = 1 << 12
SEED = np.uint64(0x5851F42D4C957F2D)


@dataclass(frozen=True)
class Profiles:
    """Languages in order, and their prototypes as unit vectors."""

    names: list[str]
    vectors: np.ndarray


@lru_cache(maxsize=1)
def letter_mask() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def letter_vectors(codes: np.ndarray, dims: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        words = mix(mix(codes.astype(np.uint64) + SEED)[:, None] + np.arange(dims // 64, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    bits = np.unpackbits(words.view(np.uint8), axis=1)
    return (bits.astype(np.int8) << 1) - 1


def trigram_vectors(keys: np.ndarray, dims: int) -> np.ndarray:
    """Binding: the product of the letters' vectors, rotated by two, one and no places."""
    mask = np.uint64((1 << 21) - 1)
    parts = [(keys >> np.uint64(42)) & mask, (keys >> np.uint64(21)) & mask, keys & mask]
    letters, at = np.unique(np.concatenate(parts), return_inverse=True)
    table = letter_vectors(letters, dims)
    first, second, third = np.split(at.reshape(-1), 3)
    bound = np.roll(table, 2, axis=1)[first]
    bound *= np.roll(table, 1, axis=1)[second]
    bound *= table[third]
    return bound


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text number and key of every letter trigram, and each text's number of letters.

    Letters are lower-cased; a run of anything else counts as one boundary, which
    may be a trigram's first or last place.
    """
    low = [t.lower() for t in texts]
    whole = " " + " ".join(low) + " "
    codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.append(np.repeat(np.arange(len(low)), [len(t) + 1 for t in low]), len(low) - 1)
    letter = letter_mask()[codes]
    n_letters = np.bincount(owner[letter], minlength=len(low))
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:-1] |= letter[1:] & ~letter[:-1]
    codes, owner = np.where(letter, codes, 0)[keep].astype(np.uint64), owner[keep]
    middle = np.flatnonzero(codes[1:-1]) + 1
    return owner[middle], codes[middle - 1] << np.uint64(42) | codes[middle] << np.uint64(21) | codes[middle + 1], n_letters


def text_slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    at = size = 0
    for i, t in enumerate(texts):
        if i > at and (i - at >= CHUNK_TEXTS or size + len(t) > CHUNK_CHARS):
            yield at, i
            at, size = i, 0
        size += len(t)
    if texts:
        yield at, len(texts)


def bundled(texts: list[str], group: np.ndarray, n_groups: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Per group the sum of the hypervectors of its texts' trigrams; per text its letters."""
    owner, keys, n_letters = trigrams(texts)
    distinct, at = np.unique(keys, return_inverse=True)
    if not len(distinct):
        return np.zeros((n_groups, dims)), n_letters
    # pairs of group and trigram, and how often each occurs; a part of the trigrams has its vectors made at a time
    place, times = np.unique(at.reshape(-1) * n_groups + group[owner], return_counts=True)
    total = np.zeros((n_groups, dims))
    for start in range(0, len(distinct), TRIGRAMS):
        low, high = np.searchsorted(place, (start * n_groups, (start + TRIGRAMS) * n_groups))
        some = distinct[start : start + TRIGRAMS]
        counts = np.zeros((len(some), n_groups), dtype=np.float32)
        counts.reshape(-1)[place[low:high] - start * n_groups] = times[low:high]
        total += counts.T @ trigram_vectors(some, dims).astype(np.float32)
    return total, n_letters


def training_part(id_col: str) -> F.Column:
    """Whether a row may be learned from: the CRC-32 of its id, as text, modulo 3 is not 1."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) != 1, F.lit(False))


def fit_profiles(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", dims: int = DIMENSIONS) -> Profiles:
    """Prototypes of the languages in ``lang_col``, from every row that has text and language.

    Each task bundles the texts it reads, so what moves is one vector per task
    and language, and what the driver gets is one vector per language.
    """

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in text_slices(texts):
                names = sorted(set(langs[a:b]))
                place = {name: i for i, name in enumerate(names)}
                group = np.array([place[x] for x in langs[a:b]])
                for name, total in zip(names, bundled(texts[a:b], group, len(names), dims)[0], strict=True):
                    sums[name] = sums.get(name, 0) + total.astype(np.float64)
        names = sorted(sums)
        yield pa.RecordBatch.from_pydict(
            {"lang": pa.array(names, pa.string()), "sums": pa.array([sums[n].astype(np.int64) for n in names], pa.list_(pa.int64()))}
        )

    usable = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    parts = usable.mapInArrow(bundle, "lang string, sums array<bigint>")
    sums = parts.select("lang", F.posexplode("sums")).groupBy("lang", "pos").agg(F.sum("col").alias("total"))
    found = sums.collect()
    names = sorted({r.lang for r in found})
    place = {name: i for i, name in enumerate(names)}
    vectors = np.zeros((len(names), dims))
    for r in found:
        vectors[place[r.lang], r.pos] = r.total
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return Profiles(names, (vectors / np.where(norms == 0, 1, norms)).astype(np.float32))


def predict_language(docs: DataFrame, profiles: Profiles, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the cosine with that language's prototype, at least 0.

    A text that is null or has no letter, or any text if nothing was learned,
    gets ``und`` and 0. Of equal cosines the first language by name wins. All
    columns of ``docs`` stay, except that the two results replace columns of
    those names.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    held = docs.select(*kept)
    schema = T.StructType([*held.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    names, vectors, text_at = profiles.names, profiles.vectors, kept.index(text_col)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(text_at).to_pylist()]
            best, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for a, b in text_slices(texts) if names else ():
                sums, letters = bundled(texts[a:b], np.arange(b - a), b - a, vectors.shape[1])
                norms = np.linalg.norm(sums, axis=1)
                cosines = (sums @ vectors.T) / np.where(norms == 0, 1, norms)[:, None]
                top = cosines.argmax(axis=1)
                for i in np.flatnonzero(letters):
                    best[a + i], score[a + i] = names[top[i]], min(1.0, max(0.0, float(cosines[i, top[i]])))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(best, pa.string()), pa.array(score)], names=[*batch.schema.names, "lang_pred", "score"]
            )

    return held.mapInArrow(predict, schema)


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row of ``docs`` the id, ``held_out``, ``lang_pred`` and ``score``.

    Profiles are learned from the rows of the training part and never see the
    rest. A null id is neither learned from nor held out.
    """
    part = training_part(id_col)
    profiles = fit_profiles(docs.where(part), text_col, lang_col)
    asked = docs.select(F.col(id_col), F.col(text_col), (F.col(id_col).isNotNull() & ~part).alias("held_out"))
    return predict_language(asked, profiles, text_col).select(id_col, "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose text has a language; texts that are null or have no letter go.

    Where no row may be learned from, every text with a letter stays.
    """
    profiles = fit_profiles(docs.where(training_part(id_col)), text_col, lang_col)
    if not profiles.names:
        return docs.where(F.col(text_col).rlike(r"\p{L}"))
    return predict_language(docs, profiles, text_col).where(F.col("lang_pred") != UNKNOWN).select(*docs.columns)
