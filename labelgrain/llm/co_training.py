"""A quality classifier by co-training.

Two logistic regressions see the same document from two sides: its words, and
its page data (source, language, size and layout). Both learn from labelled
documents; then, over some rounds, each learns again with all the further
documents that the other is sure of. A third regression, fitted on labelled
documents that neither has seen, calibrates and combines their scores.

Features are made and stored once. Both sides are fitted side by side, and a
pass over the features gives loss and gradient of both: every document without a
label is scored by the last round's models in each pass and takes part on a side
if the other is sure of it. Tasks add up gradients over their own documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Generator, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgrain.llm.hashing import SPACE, text_chunks, word_hashes
from labelgrain.llm.storage import stored
from labelgrain.operators.focal import direction

#: Hashed words of the text view; and hashed facts of the page view.
TEXT_BITS, PAGE_BITS = 16, 18
DRAWS = 1_000_000
#: Documents that a task looks at together.
ROWS = 2048
#: ASCII marks become spaces, so that words are bare.
BARE = np.array([c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)], dtype=np.uint8)


@dataclass(frozen=True)
class Params:
    """``labelled`` bounds the labels that fitting looks at, about; documents beyond it count as unlabelled. The rest is as named."""

    labelled: int = 20_000
    rounds: int = 2
    sure: float = 0.97
    reg: float = 0.002
    max_iter: int = 15


def text_features(words: np.ndarray) -> np.ndarray:
    """Distinct hashed words, in order."""
    return np.unique(words & np.uint64((1 << TEXT_BITS) - 1)).astype(np.int32)


def step_of(share: float, steps: int = 12) -> int:
    return int(min(steps, share * steps))


def page_features(source: str | None, lang: str | None, data: np.ndarray, n_words: int) -> list[int]:
    """Hashed facts on a page: where it is from, its language, size and layout."""
    n = max(1, len(data))
    letters = (data | 32) - ord("a") < 26
    upper = int(((data >= 65) & (data <= 90)).sum()) / max(1, int(letters.sum()))
    marks = int((~letters & ~SPACE[data] & (data < 128)).sum()) / n
    facts = [
        f"source {source}",
        f"lang {lang}",
        f"size {n.bit_length()}",
        f"lines {int((data == 10).sum() + 1).bit_length()}",
        f"upper {step_of(upper)}",
        f"marks {step_of(3 * marks)}",
        f"word size {min(12, n // max(1, n_words))}",
    ]
    return sorted({fact_feature(f) for f in facts})


@lru_cache(maxsize=1 << 14)
def fact_feature(fact: str) -> int:
    return zlib.crc32(fact.encode()) & ((1 << PAGE_BITS) - 1)


def views(column: pa.Array, sources: list, langs: list) -> Iterator[tuple[np.ndarray, list[int]]]:
    """Per document its features of the text view and of the page view."""
    for first, end, data, offsets in text_chunks(column):
        words, at = word_hashes(BARE[data], offsets)
        for i in range(end - first):
            own = data[offsets[i] : offsets[i + 1]]
            yield text_features(words[at[i] : at[i + 1]]), page_features(sources[first + i], langs[first + i], own, int(at[i + 1] - at[i]))


def featurised(docs: DataFrame) -> DataFrame:
    """``doc``, ``label``, ``held``, and ``words`` and ``page``, the indices of its features in either view."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = list(views(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()))
            words = pa.array([w for w, _ in both], pa.list_(pa.int32()))
            page = pa.array([p for _, p in both], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(4), batch.column(5), words, page], names=["doc", "label", "held", "words", "page"])

    rows = docs.select("doc", "text", "source", "lang", "label", "held")
    return rows.mapInArrow(work, "doc bigint, label double, held boolean, words array<int>, page array<int>")


def lists_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The features of some documents in a row, and the document of each."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes)


def margins(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Log-odds by one view; the bias is the last weight."""
    features, rows = lists_of(column)
    return weights[-1] + np.bincount(rows, weights[features], len(column))


def probability(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def surely(z: np.ndarray, sure: float) -> np.ndarray:
    """1 or 0 where a view is sure, else NaN."""
    p = probability(z)
    return np.where(np.maximum(p, 1 - p) >= sure, np.round(p), np.nan)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


Weights = tuple[np.ndarray, np.ndarray]


def losses(table: DataFrame, weights: Weights, frozen: Weights | None, params: Params) -> list[tuple[float, np.ndarray]]:
    """Mean log loss and its gradient of both views, in one pass.

    Labelled documents that are not held back take part in both. With the last
    round's ``frozen`` weights the others take part in a view with the label
    that the other view is sure of.
    """
    sizes = [len(w) for w in weights]
    shared = table.sparkSession.sparkContext.broadcast((weights, frozen))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, frozen = shared.value
        # behind each gradient: the loss and the number of documents
        sums = [np.zeros(n + 2) for n in sizes]
        for batch in slices(batches):
            label = batch.column(0).to_numpy(zero_copy_only=False)
            columns = (batch.column(2), batch.column(3))
            held = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            pseudo = [surely(margins(c, w), params.sure) for c, w in zip(columns, frozen, strict=True)] if frozen else [label, label]
            for k in (0, 1):
                target = np.where(held, np.nan, np.where(np.isnan(label), pseudo[1 - k], label))
                known = ~np.isnan(target)
                z, y = margins(columns[k], weights[k]), np.where(known, target, 0.0)
                slope = np.where(known, probability(z) - y, 0.0)
                features, rows = lists_of(columns[k])
                sums[k][: sizes[k] - 1] += np.bincount(features, slope[rows], sizes[k] - 1)
                sums[k][sizes[k] - 1 :] += slope.sum(), np.where(known, np.logaddexp(0, z) - y * z, 0.0).sum(), known.sum()
        for k in (0, 1):
            used = np.flatnonzero(sums[k])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), k), pa.int32()), pa.array(used, pa.int32()), pa.array(sums[k][used])], names=["view", "feature", "total"])

    taking_part = table if frozen else table.where("label is not null and not held")
    parts = taking_part.select("label", "held", "words", "page").mapInArrow(work, "view int, feature int, total double")
    found = parts.groupBy("view", "feature").agg(F.sum("total").alias("total")).toArrow()
    # a pass's weights would else stay on the disks to the end
    shared.destroy()
    view, feature, total = (found[c].to_numpy() for c in ("view", "feature", "total"))
    results = []
    for k in (0, 1):
        sums = np.zeros(sizes[k] + 2)
        sums[feature[view == k]] = total[view == k]
        n = max(sums[-1], 1.0)
        plain = np.append(weights[k][:-1], 0.0)
        results.append((float(sums[-2] / n) + params.reg / 2 * float(plain @ plain), sums[:-2] / n + params.reg * plain))
    return results


def minimise(weights: np.ndarray, steps: int) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """L-BFGS that yields the weights it wants loss and gradient of, and returns the best ones."""
    value, gradient = yield weights
    changes: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        if np.abs(gradient).max() < 1e-11:
            break
        way = direction(gradient, changes)
        slope, length = float(gradient @ way), 1.0
        for _ in range(25):
            found = weights + length * way
            new, slopes = yield found
            if new <= value + 1e-4 * length * slope:
                break
            length /= 2
        else:
            break
        changes = [*changes, (found - weights, slopes - gradient)][-10:]
        weights, value, gradient = found, new, slopes
    return weights


def fit_views(table: DataFrame, start: Weights, frozen: Weights | None, params: Params) -> Weights:
    """Both views' weights, fitted side by side."""
    searches = [minimise(w, params.max_iter) for w in start]
    wanted = [next(search) for search in searches]
    done: list[np.ndarray | None] = [None, None]
    while any(d is None for d in done):
        for k, result in enumerate(losses(table, (wanted[0], wanted[1]), frozen, params)):
            if done[k] is None:
                try:
                    wanted[k] = searches[k].send(result)
                except StopIteration as end:
                    done[k] = wanted[k] = end.value
    return done[0], done[1]


def combination(z: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Bias and weights of a logistic regression on both views' log-odds, by Newton's method."""
    x = np.column_stack((np.ones(len(z)), z))
    w = np.zeros(3)
    for _ in range(50):
        p = probability(x @ w)
        # a faint pull to 0 keeps weights finite where the classes part
        gradient = x.T @ (p - label) + 1e-3 * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(3), gradient)
        w -= step * min(1.0, 5.0 / max(float(np.abs(step).max()), 1e-12))
        if np.abs(step).max() < 1e-10:
            break
    return w


@dataclass(frozen=True)
class Combined:
    """Weights of both views, and of their combination: bias, text, page."""

    words: np.ndarray
    page: np.ndarray
    mixed: np.ndarray


def co_train(table: DataFrame, params: Params) -> Combined:
    """Fit both views and their combination on what ``featurised`` made."""
    labelled = table.where("label is not null")
    classes = {r["held"]: r["n"] for r in labelled.groupBy("held").agg(F.count_distinct("label").alias("n")).collect()}
    weights: Weights = (np.zeros((1 << TEXT_BITS) + 1), np.zeros((1 << PAGE_BITS) + 1))
    if classes.get(False, 0) > 1:
        frozen = None
        for _ in range(params.rounds + 1):
            weights = fit_views(table, weights, frozen, params)
            frozen = weights
    if classes.get(False, 0) < 2 or classes.get(True, 0) < 2:
        return Combined(*weights, np.array([0.0, 1.0, 1.0]))
    # a share of the labels that fitting looks at, whose number is bounded
    held = labelled.where("held").select("label", "words", "page").toArrow().combine_chunks()
    words, page = (held[c].combine_chunks() if isinstance(held[c], pa.ChunkedArray) else held[c] for c in ("words", "page"))
    z = np.column_stack((margins(words, weights[0]), margins(page, weights[1])))
    return Combined(*weights, combination(z, held["label"].to_numpy()))


def quality_scores(
    docs: DataFrame, labels: DataFrame, params: Params = Params(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang"
) -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``text_score``, ``page_score``, ``score`` and ``keep``.

    ``labels`` has ``id_col``, ``quality`` and ``toxic``; a document is good if
    its quality is 1 and it is not known to be toxic, and rows without a quality
    are left out; of several labels the worst counts. Scores are probabilities
    of being good, and ``keep`` is a ``score`` of at least a half. Null and empty
    texts and null sources and languages are scored by what remains; without
    usable labels of both kinds every score is a half. Ids must be whole
    numbers and may be null or repeat; every row is scored. An empty table gives
    an empty result.
    """
    source = docs.select(
        F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text"), F.col(source_col).cast("string").alias("source"), F.col(lang_col).cast("string").alias("lang")
    )
    good = ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("double")
    usable = labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull()).select(F.col(id_col).cast("bigint").alias("_doc"), good.alias("label"))
    worst = usable.groupBy("_doc").agg(F.min("label").alias("label"))
    share = min(1.0, params.labelled / max(1, worst.count()))
    # about as many rows as ``labelled`` says, so they can be broadcast
    sample = F.broadcast(worst.where(F.pmod(F.xxhash64("_doc", F.lit(1)), F.lit(DRAWS)) < int(DRAWS * share)))
    marked = source.join(sample, F.col("doc") == F.col("_doc"), "left")
    held = F.col("label").isNotNull() & (F.pmod(F.xxhash64("doc", F.lit(3)), F.lit(4)) == 0)
    table = stored(featurised(marked.withColumn("held", held)))
    shared = docs.sparkSession.sparkContext.broadcast(co_train(table, params))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches):
            z = [margins(batch.column(1), model.words), margins(batch.column(2), model.page)]
            bias, text, page = model.mixed
            p = [probability(x) for x in (*z, bias + text * z[0] + page * z[1])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, p)], names=["doc", "text_score", "page_score", "score"])

    scored = table.select("doc", "words", "page").mapInArrow(score, "doc bigint, text_score double, page_score double, score double")
    return scored.select(F.col("doc").alias(id_col), "text_score", "page_score", "score", (F.col("score") >= 0.5).alias("keep"))
