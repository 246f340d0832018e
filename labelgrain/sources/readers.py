"""Readers for corpus, split, label and probability files.

Every schema is declared; nothing is inferred.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelgrain.fixed_values import (
    ANNOTATION_COLUMNS,
    GRADED_COLUMNS,
    HEADER_LINES,
    TASK_FILES,
    UNLABELLED_COLUMNS,
    VECTOR_NAMES,
    WHITESPACE,
)
from labelgrain.functions.labels import collapse_grade, fail_when, normalise_key, parse_vector
from labelgrain.functions.text import strip, tab_field_count, tab_fields
from labelgrain.sources.lines import number_rows, read_lines
from labelgrain.sources.quoted import read_quoted_records

Path = str | list[str]


def _checked(lines: DataFrame, bad: Column, what: str, on_bad: str) -> DataFrame:
    """Raise at the first bad line, or keep only the good ones."""
    if on_bad == "raise":
        message = F.concat(F.lit(f"{what}, row "), F.col("row_no").cast("string"), F.lit(": "), F.col("value"))
        return lines.where(fail_when(bad, message, F.lit(True)))
    if on_bad == "drop":
        return lines.where(~bad)
    raise ValueError("on_bad must be 'raise' or 'drop'")


def read_graded(
    spark: SparkSession, path: Path, header_lines: int = HEADER_LINES, on_bad: str = "raise",
    strict_labels: bool = False, quoted: bool = False, index: str | None = None,
) -> DataFrame:
    """Graded paragraphs: five fields and the last non-empty one as the grade.

    Columns ``row_no, par_id, art_id, keyword, country, text, label,
    orig_label``. A row of fewer than five fields raises, or with
    ``on_bad='drop'`` is left to ``rejected_lines``. ``strict_labels`` also
    raises on grades outside 0..4. ``quoted`` reads fields with CSV quoting.
    ``index`` names a folder that keeps block counts, see ``number_rows``.
    """
    if quoted:
        return _read_graded_quoted(spark, path, header_lines, strict_labels, index)
    # exploded out of an array of one, the fields are made once: a filter on them would else repeat them below itself
    fields = F.explode(F.array(tab_fields(strip(F.col("value")))))
    lines = read_lines(spark, path, header_lines, index).select("row_no", "value", fields.alias("f"))
    good = _checked(lines, F.size("f") < 5, "fewer than 5 fields", on_bad)
    grade = F.element_at("f", -1)
    return good.select(
        "row_no",
        *[F.get("f", F.lit(i)).alias(c) for i, c in enumerate(GRADED_COLUMNS[:5])],
        collapse_grade(grade, strict_labels).alias("label"),
        grade.alias("orig_label"),
    )


def _read_graded_quoted(spark: SparkSession, path: Path, header_lines: int, strict_labels: bool, index: str | None) -> DataFrame:
    """Six columns with double quotes as in CSV; a quoted field may hold tabs and line breaks."""
    schema = ", ".join(f"{c} string" for c in GRADED_COLUMNS)
    # with multiLine the parser leaves line ends in quoted fields as they are
    fields = F.from_csv("value", schema, {"sep": "\t", "quote": '"', "escape": '"', "multiLine": "true"})
    records = read_quoted_records(spark, path, header_lines, index=index).select("row_no", fields.alias("f"))
    grade = F.col("f.label")
    return records.select("row_no", *[f"f.{c}" for c in GRADED_COLUMNS[:5]], collapse_grade(grade, strict_labels).alias("label"), grade.alias("orig_label"))


def rejected_lines(spark: SparkSession, path: Path, header_lines: int = HEADER_LINES, fields: int = 5) -> DataFrame:
    """The lines that a lenient read leaves out, with their row numbers."""
    count = tab_field_count(strip(F.col("value")))
    lines = read_lines(spark, path, header_lines).withColumn("fields", count)
    return lines.where(F.col("fields") < fields).select("row_no", "file", "value", "fields")


def read_annotations(
    spark: SparkSession, path: Path, header_lines: int = HEADER_LINES, on_bad: str = "raise", index: str | None = None
) -> DataFrame:
    """Category annotations, ten fields per line, with ``row_no``.

    The two ids, the tag and the annotator count come from the stripped line,
    counted from its ends; the fields between come from the line as it is.
    """
    raw = F.col("value")
    # exploded out of an array of one, the fields are made once; few lines have white space at an end to strip
    lines = read_lines(spark, path, header_lines, index).select("row_no", "value", F.explode(F.array(tab_fields(raw))).alias("q"))
    padded = F.substring(raw, 1, 1).isin(*WHITESPACE) | F.substring(raw, -1, 1).isin(*WHITESPACE)
    stripped = F.when(padded, tab_fields(strip(raw))).otherwise(F.col("q"))
    lines = lines.select("row_no", "value", F.explode(F.array(stripped)).alias("p"), "q")
    split = _checked(lines, (F.size("p") < 2) | (F.size("q") < 8), "too few fields", on_bad)
    ends = {"par_id": F.get("p", F.lit(0)), "art_id": F.get("p", F.lit(1)),
            "label": F.element_at("p", -2), "num_annotators": F.element_at("p", -1)}
    return split.select(
        "row_no",
        *[ends.get(c, F.get("q", F.lit(i))).alias(c) for i, c in enumerate(ANNOTATION_COLUMNS)],
    )


def read_unlabelled(spark: SparkSession, path: Path, header_lines: int = 0, on_bad: str = "raise", index: str | None = None) -> DataFrame:
    """Five fields per line, no header; short lines get nulls, longer ones raise."""
    line = strip(F.col("value"))
    good = _checked(read_lines(spark, path, header_lines, index), tab_field_count(line) > 5, "more than 5 fields", on_bad)
    return good.select("row_no", tab_fields(line).alias("f")).select("row_no", *[F.get("f", F.lit(i)).alias(c) for i, c in enumerate(UNLABELLED_COLUMNS)])


def read_split(spark: SparkSession, path: Path) -> DataFrame:
    """Split list in file order: ``row_no``, stripped ``par_id``, ``label`` text."""
    reader = spark.read.schema("par_id string, label string").option("header", True)
    scan = reader.option("quote", '"').option("escape", '"').csv(path)
    return number_rows(scan).select("row_no", normalise_key(F.col("par_id")).alias("par_id"), "label")


def read_label_lines(spark: SparkSession, path: Path, label_col: str = "label", index: str | None = None) -> DataFrame:
    """One int per line with ``row_no``; anything else raises."""
    lines = read_lines(spark, path, index=index)
    number = strip(F.col("value")).try_cast("int")
    bad = F.concat(F.lit("not an int, row "), F.col("row_no").cast("string"), F.lit(": "), F.col("value"))
    return lines.select("row_no", fail_when(number.isNull(), bad, number).alias(label_col))


def read_vector_lines(
    spark: SparkSession, path: Path, width: int = len(VECTOR_NAMES), vec_col: str = "vector"
) -> DataFrame:
    """``width`` comma-joined ints per line with ``row_no``; anything else raises."""
    return read_lines(spark, path).select("row_no", parse_vector(F.col("value"), width).alias(vec_col))


def read_probs(spark: SparkSession, path: str) -> DataFrame | None:
    """Stored ``(row_no, prob)``, or None if nothing was stored."""
    try:
        return spark.read.schema("row_no bigint, prob float").parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def available_tasks(spark: SparkSession, path: str) -> dict[str, str]:
    """Tasks with a label file (or folder of part files) right in a directory.

    Only asks whether the path is there; no data is read.
    """
    found = {}
    for task, name in TASK_FILES.items():
        file = f"{path.rstrip('/')}/{name}"
        try:
            spark.read.text(file)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            found[task] = file
    return found
