"""Corpus exploration: class balance, token counts, histograms, n-grams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelgrain.fixed_values import HISTOGRAM_BINS, NGRAM_SIZE, STOP_WORDS, TOP_K
from labelgrain.functions import numbers as N
from labelgrain.functions import text as T
from labelgrain.operators.shared import stored, top_per_group


def preview(df: DataFrame, n: int = 5, order_col: str = "row_no") -> DataFrame:
    return df.orderBy(order_col).limit(n)


def class_distribution(df: DataFrame, label_col: str) -> DataFrame:
    """Rows and percentage of all rows per class, by class.

    Rows without a class count in the total but form no class. The total is a
    scalar over the same grouped counts; it names both of them, and the row
    without a class goes by its count, so that one shuffle serves both.
    """
    counted = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"), F.count(label_col).alias("labelled"))
    sums = counted.agg(F.struct(F.sum("n").alias("n"), F.sum("labelled").alias("labelled")).alias("sums")).scalar()
    shares = counted.where(F.col("labelled") > 0)
    return shares.select(label_col, "n", (100.0 * F.col("n") / sums["n"]).alias("pct")).orderBy(label_col)


def class_counts(df: DataFrame, label_col: str) -> DataFrame:
    """Rows per class, most frequent first, ties by class."""
    counted = df.where(F.col(label_col).isNotNull()).groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), label_col)


def _value_counts(df: DataFrame, value_col: str, class_col: str) -> DataFrame:
    """How often each value occurs per class: all a statistic needs of the rows.

    Null values are kept as a group. A filter on the value would move below the
    aggregate and work out an expensive value, such as a token count, twice.
    """
    return df.groupBy(F.col(class_col).alias("class"), F.col(value_col).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )


def token_stats(
    df: DataFrame, count_col: str, label_col: str, q: float = 0.95, exact: bool = True, in_rounds: bool = False
) -> DataFrame:
    """Texts, mean, maximum and interpolated ``q`` percentile, overall and per class.

    Rows are first counted per class and token count, before the shuffle, so the
    exact percentile works on distinct counts with frequencies and not on rows.
    For values without such a narrow range ``in_rounds`` finds the same
    percentile by ``exact_percentile``, in which no task sees all distinct values,
    and ``exact=False`` takes Spark's
    approximate percentile, a value of the data, from bounded sketches. Rows
    without a class count in the overall line only.
    """
    value, n = F.col("value"), F.col("n")
    if exact and not in_rounds:
        known = F.when(value.isNotNull(), n)
        rolled = _value_counts(df, count_col, label_col).rollup("class").agg(
            F.grouping("class").alias("all_classes"),
            F.sum(known).alias("n"),
            N.ratio(F.sum(value * known), F.sum(known)).alias("mean"),
            F.max(value).alias("max"),
            F.percentile(value, F.lit(float(q)), n).alias("percentile"),
        )
    else:
        rows = df.select(F.col(label_col).alias("class"), F.col(count_col).alias("value"))
        rows = stored(rows) if in_rounds else rows
        rolled = rows.rollup("class").agg(
            F.grouping("class").alias("all_classes"),
            F.count(value).alias("n"),
            F.avg(value).alias("mean"),
            F.max(value).alias("max"),
            *([] if in_rounds else [F.percentile_approx(value, float(q), 10000).cast("double").alias("percentile")]),
        )
    overall = F.col("all_classes") == 1
    kept = rolled.where((n > 0) & (overall | F.col("class").isNotNull()))
    scope = F.when(overall, "overall").otherwise(F.col("class").cast("string"))
    if not in_rounds:
        return kept.select(scope.alias("scope"), "n", "mean", "max", "percentile")
    classes = exact_percentile(rows.where(F.col("class").isNotNull()), "value", q, "class").withColumn("all_classes", F.lit(0))
    whole = exact_percentile(rows, "value", q).select(F.lit(None).cast(rows.schema["class"].dataType).alias("class"), "n", "percentile", F.lit(1).alias("all_classes"))
    ends = classes.unionByName(whole).select(F.col("class").alias("_class"), F.col("all_classes").alias("_all"), "percentile")
    joined = kept.join(ends, F.col("class").eqNullSafe(F.col("_class")) & (F.col("all_classes") == F.col("_all")))
    return joined.select(scope.alias("scope"), "n", "mean", "max", "percentile")


def histogram(df: DataFrame, value_col: str, class_col: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins over each class's own range, empty bins included.

    The last bin is closed. A value on an edge goes where the computed edges put
    it, as in numpy; a class with one distinct value gets a range of width 1.
    """
    counted = _value_counts(df, value_col, class_col)
    # one row per class; Spark measures it and broadcasts it if it is small. The
    # sum keeps the counted table as it is, so both sides share its shuffle.
    ranges = counted.groupBy("class").agg(
        F.min(F.col("value").cast("double")).alias("lo"), F.max(F.col("value").cast("double")).alias("hi"),
        F.sum("n").alias("all"),
    ).where((F.col("all") > 0) & F.col("lo").isNotNull())
    flat = F.col("lo") == F.col("hi")
    ranges = ranges.select(
        "class",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    lo, hi, x = F.col("lo"), F.col("hi"), F.col("value").cast("double")
    width = (hi - lo) / F.lit(float(bins))
    last = F.lit(bins - 1)

    def edge(i: Column) -> Column:
        return i.cast("double") * width + lo

    guess = F.least(last, F.floor((x - lo) / (hi - lo) * F.lit(float(bins))).cast("int"))
    index = F.when(x < edge(guess), guess - 1).when((guess != last) & (x >= edge(guess + 1)), guess + 1).otherwise(guess)
    binned = counted.join(ranges, "class").select("class", "lo", "hi", index.alias("bin"), "n")
    summed = binned.where(F.col("bin").isNotNull()).groupBy("class", "lo", "hi", "bin").agg(F.sum("n").alias("n"))
    # at most ``bins`` entries per class
    folded = summed.groupBy("class", "lo", "hi").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("counts")
    )
    filled = folded.select("class", "lo", "hi", "counts", F.explode(F.sequence(F.lit(0), last)).alias("bin"))
    return filled.select(
        F.col("class").alias(class_col), "bin",
        edge(F.col("bin")).alias("bin_from"),
        F.when(F.col("bin") == last, hi).otherwise(edge(F.col("bin") + 1)).alias("bin_to"),
        F.coalesce(F.try_element_at(F.col("counts"), F.col("bin")), F.lit(0).cast("bigint")).alias("n"),
    )


def ngram_rows(
    df: DataFrame, text_col: str, class_col: str, n: int = NGRAM_SIZE,
    stop_words: Sequence[str] = STOP_WORDS, tokeniser: str = "words", null_text: str = "nan",
    keep_cols: Sequence[str] = (),
) -> DataFrame:
    """One row per n-gram: ``class``, ``pos`` in its text, ``ngram``.

    Stop words and tokens that are not alphabetic go before n-grams are formed,
    so an n-gram may span removed tokens.
    """
    lowered = F.lower(T.coerce_null(F.col(text_col), null_text))
    if tokeniser == "words":
        tokens = T.content_tokens(T.word_tokens(lowered), stop_words)
    elif tokeniser == "letters":
        tokens = T.drop_stop_words(T.letter_tokens(lowered), stop_words)
    else:
        raise ValueError("tokeniser must be 'words' or 'letters'")
    kept = df.select(F.col(class_col).alias("class"), *keep_cols, tokens.alias("tokens"))
    return kept.select("class", *keep_cols, F.posexplode(T.ngrams(F.col("tokens"), n)).alias("pos", "ngram"))


#: Counters per class of the first pass of ``top_ngrams``, and how many times k of the largest are looked into for a threshold.
COUNTERS, LOOKED_INTO = 1 << 17, 8


def top_ngrams(
    df: DataFrame, text_col: str, class_col: str, n: int = NGRAM_SIZE, k: int = TOP_K,
    stop_words: Sequence[str] = STOP_WORDS, tokeniser: str = "words", null_text: str = "nan",
    order_col: str | None = None, counters: int | None = None,
) -> DataFrame:
    """The ``k`` most frequent n-grams of every class with ``n`` and ``rank``.

    Equal counts are ranked by first appearance if ``order_col`` numbers the
    texts, otherwise by the n-gram itself. Counting combines before the shuffle
    and no token list outlives its row.

    With ``counters`` (such as ``COUNTERS``) far fewer n-grams are shuffled than
    there are, and the result is the same: see ``frequent_ngrams``.
    """
    keep = [order_col] if order_col else []
    grams = ngram_rows(df, text_col, class_col, n, stop_words, tokeniser, null_text, keep)
    if counters is not None:
        grams = frequent_ngrams(stored(grams.select("class", *keep, "pos", "ngram")), k, counters)
    aggs = [F.count(F.lit(1)).alias("n")]
    ties = [F.col("ngram")]
    if order_col:
        # text number and position in one fixed-width value keeps hash aggregation
        wide = F.col(order_col).cast("decimal(20,0)") * F.lit(10**10).cast("decimal(11,0)") + F.col("pos").cast("decimal(10,0)")
        aggs.append(F.min(wide).alias("first_at"))
        ties = [F.col("first_at"), *ties]
    counted = grams.groupBy("class", "ngram").agg(*aggs)
    top = top_per_group(counted, ["class"], [F.desc("n"), *ties], k, ["ngram"])
    return top.select(F.col("class").alias(class_col), "rank", "ngram", "n")


def frequent_ngrams(grams: DataFrame, k: int, counters: int = COUNTERS) -> DataFrame:
    """The rows of ``grams`` that can be among the ``k`` most frequent n-grams of their class, and all of those.

    ``grams`` has class and ngram and is read three times, so it should be
    stored. A first pass counts n-grams together by their hash in ``counters``
    places per class: a task sends at most that many numbers a class. The n-grams of the
    places with the highest counts are then counted one by one; the k-th of them
    bounds from below what a class's k-th n-gram can have, and no n-gram has
    more than its place. So only places that reach the bound are kept.
    """
    placed = grams.withColumn("_place", F.pmod(F.xxhash64("ngram"), F.lit(counters)).cast("int"))
    places = stored(placed.groupBy("class", "_place").agg(F.count("*").alias("_n")))
    first = top_per_group(places.withColumnRenamed("class", "_class"), ["_class"], [F.desc("_n"), F.col("_place")], LOOKED_INTO * k, ["_place"])
    some = placed.join(first.select("_class", F.col("_place").alias("_at")), F.col("class").eqNullSafe(F.col("_class")) & (F.col("_place") == F.col("_at")), "left_semi")
    exact = some.groupBy("class", "ngram").agg(F.count("*").alias("n"))
    ranked = top_per_group(exact, ["class"], [F.desc("n"), F.col("ngram")], k, ["ngram"])
    # with fewer than k n-grams there, nothing is known of the k-th
    bound = ranked.groupBy("class").agg(F.when(F.count("*") == k, F.min("n")).otherwise(F.lit(1)).alias("_bound"))
    bound = bound.withColumnRenamed("class", "_class")
    open_places = places.join(bound, F.col("class").eqNullSafe(F.col("_class"))).where(F.col("_n") >= F.col("_bound"))
    chosen = open_places.select("_class", F.col("_place").alias("_at"))
    return placed.join(chosen, F.col("class").eqNullSafe(F.col("_class")) & (F.col("_place") == F.col("_at")), "left_semi").drop("_place")


def exact_percentile(df: DataFrame, value_col: str, q: float = 0.95, class_col: str | None = None, ranges: int = 256) -> DataFrame:
    """The interpolated ``q`` percentile of a number per class, with ``n``, and without a class's values in one task.

    Each round cuts the range that is known to hold the wanted order statistics,
    two neighbours, into ``ranges`` equal ones and counts the values of each, combined
    before the shuffle; the next round goes into those that hold them. It ends
    when the range holds one distinct value, so after some eight rounds at most
    for doubles, and each round sends ``ranges`` counts a class at most. Nulls and
    NaN are left out, infinities too; a class without values has no row. ``df`` is read in each round and should be stored.
    """
    value = F.col(value_col).cast("double")
    cls = F.col(class_col) if class_col else F.lit(None).cast("string")
    rows = df.select(cls.alias("class"), value.alias("v")).where(value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf")))
    sizes = stored(rows.groupBy("class").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")))
    place = (F.col("n") - 1) * F.lit(float(q))
    # per class two statistics, as ranks from 0, each with its range and the number of values below it
    wanted = stored(sizes.select("class", "n", F.explode(F.array(F.floor(place), F.ceil(place))).alias("rank"), "lo", "hi", F.lit(0).cast("bigint").alias("below")).distinct())
    while not wanted.where("lo < hi").isEmpty():
        # halves, so that no difference overflows; the ends have cells of their own, so that each round gets somewhere
        share = F.try_divide(F.col("v") / 2 - F.col("lo") / 2, F.col("hi") / 2 - F.col("lo") / 2)
        guess = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * F.lit(float(ranges))), F.lit(ranges - 1))
        cell = F.when(F.col("v") == F.col("lo"), 0).when(F.col("v") == F.col("hi"), ranges - 1).otherwise(guess).cast("int")
        open_ = wanted.where("lo < hi").withColumnRenamed("class", "_class")
        inside = rows.join(open_, F.col("class").eqNullSafe(F.col("_class")) & F.col("v").between(F.col("lo"), F.col("hi")))
        counts = inside.groupBy("_class", "n", "rank", "lo", "hi", "below", cell.alias("cell")).agg(F.count("*").alias("m"), F.min("v").alias("from"), F.max("v").alias("to"))
        # at most ``ranges`` rows of a class and rank meet here
        before = Window.partitionBy("_class", "rank").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        summed = counts.withColumn("start", F.col("below") + F.coalesce(F.sum("m").over(before), F.lit(0)))
        found = summed.where((F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("m")))
        closer = found.select(F.col("_class").alias("class"), "n", "rank", F.col("from").alias("lo"), F.col("to").alias("hi"), F.col("start").alias("below"))
        wanted = stored(wanted.where("lo = hi").unionByName(closer))
    ends = wanted.groupBy("class", "n").agg(F.min("lo").alias("low"), F.max("lo").alias("high"))
    share = place - F.floor(place)
    return ends.select(*([F.col("class").alias(class_col)] if class_col else []), "n", (F.col("low") + share * (F.col("high") - F.col("low"))).alias("percentile"))
