"""Dense row numbers for ordered text files.

Line *n* of a file is part of the data here, and a header is skipped by
position. A file is read in blocks by many tasks; one light pass counts the rows
of every block, the running sum of these counts gives each block its first
number, and the second pass adds a row's place within its block.

Both passes have to see the same blocks, so every read that numbers rows sets
``spark.sql.files.minPartitionNum`` of the session, where it is unset, to the
number of cores at that moment, and leaves it set.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelgrain.functions.labels import fail_when

BLOCK = ["file", "block", "length", "task"]


def pin_splits(spark: SparkSession) -> None:
    """Let file splits depend on settings only, not on the executors of the moment."""
    setting = "spark.sql.files.minPartitionNum"
    if spark.conf.get(setting, None) is None:
        spark.conf.set(setting, str(spark.sparkContext.defaultParallelism))


def file_order(file: Column) -> list[Column]:
    """Order of files: by folder, then by the number of a part file, then by name."""
    name = F.substring_index(file, "/", -1)
    number = F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("bigint")
    return [F.substring(file, F.lit(1), F.length(file) - F.length(name)), number, name]


def number_rows(scan: DataFrame, header_lines: int = 0, index: str | None = None) -> DataFrame:
    """Add ``row_no`` to a file scan, counting from 0 in the order of files.

    ``scan`` comes straight from a file reader. The first ``header_lines`` rows
    of every file are dropped and not counted. ``file`` and ``line_no`` (the
    place within the file) are added as well.

    A task's rows carry rising numbers, so all a row needs is its task's short
    list of blocks, of which it takes the last that begins at or before it. The
    list is broadcast: a few numbers per block of at most
    ``spark.sql.files.maxPartitionBytes``, and no more than the driver holds when
    it plans the scan.

    The lists take a pass over the data. With ``index``, a folder, they are kept
    there under a fingerprint of the files and of the settings that split them,
    and later reads of the same files take them from there. Files that have
    changed are counted again.
    """
    pin_splits(scan.sparkSession)
    data = list(scan.columns)
    placed = scan.select(
        *data,
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_block_length").alias("length"),
        F.spark_partition_id().alias("task"),
        F.monotonically_increasing_id().alias("seq"),
    )
    blocks = placed.groupBy(*BLOCK).agg(F.count(F.lit(1)).alias("rows"), F.min("seq").alias("first_seq"))
    starts = _block_starts(blocks, header_lines)
    if index is not None:
        starts = _kept(starts, f"{index}/blocks-{_fingerprint(scan, header_lines)}")
    starts = F.broadcast(starts)
    found = placed.join(starts, "task", "left").withColumn("_own", F.try_element_at(F.filter("begins", lambda b: b["first_seq"] <= F.col("seq")), F.lit(-1)))
    moved = (F.col("_own.key") != F.xxhash64("file", "block", "length")) | F.col("_own").isNull()
    message = F.concat(F.lit("file splits moved between the two passes over "), F.col("file"))
    line_no = fail_when(moved, message, F.col("_own.line_base") + F.col("seq") - F.col("_own.first_seq"))
    numbered = found.withColumn("line_no", line_no)
    if header_lines:
        numbered = numbered.where(F.col("line_no") >= header_lines)
    row_no = F.col("_own.file_base") + F.col("line_no") - F.lit(header_lines)
    return numbered.select(row_no.cast("bigint").alias("row_no"), "file", "line_no", *data)


def _fingerprint(scan: DataFrame, header_lines: int) -> str:
    """What the lists of blocks depend on: paths, lengths and times of the files, and the settings that split them.

    No file is opened.
    """
    spark = scan.sparkSession
    listed = spark.read.format("binaryFile").load(scan.inputFiles()).select(F.xxhash64("path", "length", "modificationTime").alias("h"))
    found = listed.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor("h"), F.lit(0)).alias("x"), F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0)).alias("s")).first()
    settings = [spark.conf.get(f"spark.sql.files.{name}") for name in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum")]
    plan = [*found, *settings, spark.conf.get("spark.sql.files.maxPartitionNum", None), header_lines, scan.columns]
    return hashlib.sha256(repr(plan).encode()).hexdigest()[:32]


def _kept(starts: DataFrame, path: str) -> DataFrame:
    """``starts`` as stored in ``path``, where it is written unless it is there."""
    spark = starts.sparkSession
    try:
        return spark.read.schema(starts.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    starts.write.mode("overwrite").parquet(path)
    return spark.read.schema(starts.schema).parquet(path)


def _block_starts(blocks: DataFrame, header_lines: int) -> DataFrame:
    """Per task its blocks in order: a hash of the block, and the first number of its rows, lines and file.

    Works on one row per block, a list no longer than the one the driver makes
    when it plans the scan; the last window therefore runs in a single task.
    """
    whole = Window.partitionBy("file")
    in_file = whole.orderBy("block")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy(F.lit(0)).orderBy(*file_order(F.col("file")), "block").rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0).cast("bigint")
    lined = blocks.select(
        *BLOCK, "first_seq",
        F.coalesce(F.sum("rows").over(earlier), zero).alias("line_base"),
        F.greatest(F.sum("rows").over(whole) - header_lines, zero).alias("kept"),
        (F.row_number().over(in_file) == 1).alias("opens"),
    )
    through_file = F.sum(F.when(F.col("opens"), F.col("kept")).otherwise(zero)).over(so_far)
    based = lined.withColumn("file_base", through_file - F.col("kept"))
    entry = F.struct("first_seq", "line_base", "file_base", F.xxhash64("file", "block", "length").alias("key"))
    return based.groupBy("task").agg(F.sort_array(F.collect_list(entry)).alias("begins"))


def read_lines(spark: SparkSession, path: str | list[str], header_lines: int = 0, index: str | None = None) -> DataFrame:
    """Numbered lines of text files: ``row_no``, ``file``, ``line_no``, ``value``."""
    return number_rows(spark.read.text(path), header_lines, index)
