"""Category lists per paragraph and their binary vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelgrain.fixed_values import TAG_IDS
from labelgrain.functions.labels import tag_id


def category_lists(
    df: DataFrame, key_cols: Sequence[str], tag_col: str, tags: dict[str, int] = TAG_IDS,
    order_col: str = "row_no",
) -> DataFrame:
    """Distinct category ids per key in first-seen order, as ``ids``.

    The dictionary is fixed, so the first position of every id is one
    fixed-width minimum per key: repeated annotations are combined before the
    single shuffle and no list of rows is ever built. ``order_col`` of the
    result is the position of a key's first annotation.
    """
    with_id = df.select(*key_cols, F.col(order_col).cast("bigint").alias("_at"), tag_id(F.col(tag_col), tags).alias("_id"))
    ids = sorted(set(tags.values()))
    grouped = with_id.groupBy(*key_cols).agg(
        F.min("_at").alias(order_col),
        *[F.min(F.when(F.col("_id") == i, F.col("_at"))).alias(f"_first{i}") for i in ids],
    )
    seen = F.filter(
        F.array(*[F.struct(F.col(f"_first{i}").alias("at"), F.lit(i).alias("id")) for i in ids]),
        lambda s: s["at"].isNotNull(),
    )
    ordered = F.transform(F.array_sort(seen), lambda s: s["id"])
    return grouped.select(*key_cols, order_col, ordered.alias("ids"))


def seen_ids(df: DataFrame, tag_col: str, tags: dict[str, int] = TAG_IDS) -> Column:
    """Ascending ids of the tags that occur, as a scalar for ``binarise``.

    Reads the tag column of the annotations only, which is far less than the
    grouped lists.
    """
    return _one_list(df.select(tag_id(F.col(tag_col), tags).alias("c")))


def _one_list(values: DataFrame) -> Column:
    """Distinct class ids in one row; no wider than the vectors made from it."""
    return values.distinct().agg(F.array_sort(F.collect_list("c")).alias("classes")).scalar()


def binarise(
    df: DataFrame, ids_col: str, classes: str | Sequence[int] | Column = "seen", out_col: str = "vector"
) -> DataFrame:
    """Add a 0/1 vector with one position per class in ascending order.

    ``'seen'`` takes the classes that occur in ``ids_col``, so the vector may be
    shorter than the dictionary, and plans ``df`` twice; ``seen_ids`` gives the
    same classes from the annotations. ``'all'`` takes the dictionary; a list of
    ids is used as given.
    """
    if isinstance(classes, Column):
        chosen = classes
    elif classes == "seen":
        chosen = _one_list(df.select(F.explode(ids_col).alias("c")))
    else:
        wanted = sorted(TAG_IDS.values()) if classes == "all" else list(classes)
        chosen = F.array(*[F.lit(c) for c in wanted])
    vector = F.transform("_classes", lambda c: F.array_contains(F.col(ids_col), c).cast("int"))
    return df.withColumn("_classes", chosen).withColumn(out_col, vector).drop("_classes")
