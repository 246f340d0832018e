"""Exact duplicates by skew-safe combining.

Rows are combined where they lie, then per digest and salt, then per digest over
the salts, and the whole normalised text is part of every grouping key, so no
two texts are merged by digest alone. A group that holds a third of all rows
reaches the last step as one row per salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 32


def normalised(text: F.Column) -> F.Column:
    """``text`` with every run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Of equal texts the smallest id stays; null ids are larger than all others,
    and ``keep_id`` is null only if the whole group has none. A null text equals
    an empty one. A row that is repeated whole counts, and is listed, as often
    as it occurs. An empty table gives an empty result; other columns of
    ``docs`` are not looked at. Should two texts share a digest, the job fails
    and merges nothing.
    """
    rows = docs.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_norm")).select(
        "_id", "_norm", F.sha2("_norm", 256).alias("_sha"), F.pmod(F.xxhash64("_id"), F.lit(salts)).cast("int").alias("_salt")
    )
    salted = rows.groupBy("_sha", "_salt", "_norm").agg(F.min("_id").alias("_id"), F.count("*").alias("_n"))
    whole = (
        salted.repartition("_sha")
        .groupBy("_sha", "_norm")
        .agg(F.min("_id").alias("keep_id"), F.sum("_n").alias("group_size"), F.collect_set("_salt").alias("_salts"))
    )
    classes = whole.groupBy("_sha").agg(
        F.count("*").alias("_texts"), F.first("keep_id").alias("keep_id"), F.first("group_size").alias("group_size"), F.first("_salts").alias("_salts")
    )
    owner = classes.select(
        "_sha",
        "keep_id",
        F.when(F.col("_texts") == 1, F.col("group_size"))
        .otherwise(F.raise_error(F.lit("two texts share a SHA-256 digest")).cast("long"))
        .alias("group_size"),
        F.explode("_salts").alias("_salt"),
    )
    return (
        rows.select("_id", "_sha", "_salt")
        .join(owner, ["_sha", "_salt"])
        .select(
            F.col("_id").alias(id_col),
            "keep_id",
            "group_size",
            F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.col("_sha").alias("text_sha256"),
        )
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows alike in id and text one."""
    # null ids have a key of their own, so that join and removal of repeats share one shuffle
    keys = {"_none": F.col(id_col).isNull(), "_key": F.coalesce(F.col(id_col).cast("string"), F.lit(""))}
    kept = exact_groups(docs, id_col, text_col).where("kept").withColumns(keys).select(*keys, F.col("text_sha256").alias("_sha"))
    marked = docs.withColumns({**keys, "_sha": F.sha2(normalised(F.col(text_col)), 256)})
    found = marked.join(kept.hint("merge"), [*keys, "_sha"], "left_semi")
    return found.dropDuplicates([*keys, "_sha"]).drop(*keys, "_sha")
