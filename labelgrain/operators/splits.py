"""Split selection, ordered attachment, positional pairing and class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelgrain.functions import numbers as N
from labelgrain.functions.labels import fail_when
from labelgrain.operators.shared import stored


def keep_split(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is listed; repeated list entries add no rows.

    No broadcast hint: Spark picks one from the size it knows or measures, and
    splits hot keys of ``df`` when it has to shuffle.
    """
    return df.join(ids.select(key), key, "left_semi")


def attach_in_order(
    ids: DataFrame, df: DataFrame, key: str, order_col: str = "row_no", renumber: bool = False
) -> DataFrame:
    """Every listed id with its row of ``df``, ids without one get nulls.

    Repeated ids on either side multiply. ``order_col`` of ``ids`` is kept as a
    column; the order itself is only produced where the result is written. With
    ``renumber`` the result is numbered densely in list order, ties in the order
    of ``df``, which differs from the list's own numbers once rows multiply.

    Found and missing ids are joined apart. An inner join can broadcast a short
    list, so that a large ``df`` stays in place, and can split a hot key of
    either side; a left join from the list can do neither. The listed keys that
    ``df`` has are stored, from a read of its key alone; no other column of it is,
    and those that the result does not need are not read.
    """
    if order_col not in ids.columns:
        raise ValueError(f"the id list has no column {order_col}")
    place = "_place"
    right = df.withColumnRenamed(order_col, place) if order_col in df.columns else df.withColumn(place, F.lit(0))
    known = stored(right.select(key).join(ids.select(key).distinct(), key, "left_semi").distinct())
    found = ids.join(right, key)
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name != key]
    rest = [c for c in ids.columns if c != key]
    joined = found.union(ids.join(known, key, "left_anti").select(key, *rest, *nulls))
    if renumber:
        joined = with_row_no(joined.withColumnRenamed(order_col, "_listed"), ["_listed", place], order_col).drop("_listed")
    return joined.drop(place)


def with_row_no(df: DataFrame, order_cols: Sequence[str], out_col: str = "row_no") -> DataFrame:
    """Number rows from 0 without gaps in the order of ``order_cols``.

    A distributed sort is stored once; partitions then get their first number
    from the running count of the ones before, and rows their place inside.
    """
    ordered = stored(df.orderBy(*order_cols).withColumn("_id", F.monotonically_increasing_id()))
    # Spark puts the partition in the upper 31 bits of the id
    parted = ordered.withColumn("_part", F.shiftright("_id", 33))
    sizes = parted.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("_first"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n").over(before), F.lit(0).cast("bigint"))
    # one row per sort partition
    starts = sizes.select("_part", (base - F.col("_first")).alias("_shift"))
    numbered = parted.join(F.broadcast(starts), "_part").withColumn(out_col, F.col("_id") + F.col("_shift"))
    return numbered.drop("_id", "_part", "_shift")


def replace_label(df: DataFrame, label_col: str, new_col: str) -> DataFrame:
    """Take ``new_col`` as the label and drop its old name."""
    return df.withColumn(label_col, F.col(new_col)).drop(new_col)


def align(gold: DataFrame, pred: DataFrame, on: str = "row_no", extra: str = "error") -> DataFrame:
    """Pair gold rows and predictions by position.

    A gold row without a prediction always raises. A surplus prediction raises
    with ``extra='error'`` and is dropped with ``extra='ignore'``. The check is
    part of the plan, as a filter, so it needs no job of its own and stays when
    columns are pruned.
    """
    if extra not in ("error", "ignore"):
        raise ValueError("extra must be 'error' or 'ignore'")
    left = gold.withColumn("_gold", F.lit(True))
    right = pred.withColumn("_pred", F.lit(True))
    paired = left.join(right, on, "full" if extra == "error" else "left")
    unpaired = F.col("_gold").isNull() | F.col("_pred").isNull()
    message = F.concat(
        F.lit("gold and predictions differ in length, first seen at position "), F.col(on).cast("string")
    )
    return paired.where(fail_when(unpaired, message, F.lit(True))).drop("_gold", "_pred")


def split_summary(df: DataFrame, label_col: str) -> DataFrame:
    """Rows, positives and percentage of positives; the mean skips null labels."""
    label = F.col(label_col)
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(label.cast("bigint")), F.lit(0).cast("bigint")).alias("positives"),
        N.ratio(100 * F.sum(label.cast("bigint")), F.count(label)).alias("positive_pct"),
    )


def class_weights(df: DataFrame, label_col: str) -> DataFrame:
    """Balanced weight ``n / (classes * n_class)`` for every class up to the maximum.

    Labels are class numbers from 0. A class number without rows counts as a
    class, and its own weight is null.
    """
    counted = df.groupBy(F.col(label_col).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    bad = F.col("label").isNull() | (F.col("label") < 0)
    checked = counted.where(fail_when(bad, "class labels must be 0, 1, 2, ...", F.lit(True)))
    # one row; its lists are as long as the number of classes
    folded = checked.agg(
        F.max("label").alias("top"), F.sum("n").alias("total"),
        F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("counts"),
    ).where(F.col("top").isNotNull())
    filled = folded.select("top", "total", "counts", F.explode(F.sequence(F.lit(0), F.col("top"))).alias("label"))
    n = F.coalesce(F.try_element_at(F.col("counts"), F.col("label")), F.lit(0).cast("bigint"))
    weight = F.try_divide(F.col("total").cast("double"), ((F.col("top") + 1) * n).cast("double"))
    return filled.select("label", n.alias("n"), weight.alias("weight"))
