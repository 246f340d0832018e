"""Quoted records of text files, joined from lines in many tasks.

A quoted field may hold line breaks, so whether a line opens a record depends on
all lines before it, but only on one bit of them: is a quoted field open where
the line starts? A line maps that bit to the one at its end. These maps are
composed over chunks of lines, the chunks' maps over each file, and with the bit
at the start of every chunk its lines know which of them open a record and are
brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelgrain.sources.lines import file_order, number_rows

#: Lines whose maps are composed as one.
CHUNK_LINES = 1 << 16

# Groups are possessive, so that long lines need no stack. A quote opens a field
# only at its start; behind the closing quote the field runs on to the separator.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_FIELDS = rf'(?:(?:"{_INSIDE}"[^\t]*+|(?!")[^\t]*+)\t)*+'
#: Lines that end inside a quoted field if they start outside one, and if they start inside one.
OPEN_FROM_OUTSIDE = rf'^{_FIELDS}"{_INSIDE}$'
OPEN_FROM_INSIDE = rf'^{_INSIDE}(?:"[^\t]*+\t{_FIELDS}"{_INSIDE})?+$'


def _chunk_maps(lines: DataFrame) -> DataFrame:
    """Per chunk of lines, for either bit at its start: the bit at its end, the first and last line that open a record, and how many do.

    ``lines`` has file, chunk, line_no, outside, inside and blank.
    """

    def start(bit: bool) -> Column:
        none = F.lit(None).cast("bigint")
        return F.struct(F.lit(bit).alias("open"), none.alias("first"), none.alias("last"), F.lit(0).cast("bigint").alias("n"))

    def step(at: Column, line: Column) -> Column:
        opens = F.when(~at["open"], line["line_no"])
        return F.struct(
            F.when(at["open"], line["inside"]).otherwise(line["outside"]).alias("open"),
            F.coalesce(at["first"], opens).alias("first"),
            F.coalesce(opens, at["last"]).alias("last"),
            (at["n"] + F.when(at["open"] | line["blank"], 0).otherwise(1)).alias("n"),
        )

    # a bounded list: a chunk's lines without their texts
    rows = F.array_sort(F.collect_list(F.struct("line_no", "outside", "inside", "blank")))
    folded = lines.groupBy("file", "chunk").agg(rows.alias("rows"))
    return folded.select("file", "chunk", *(F.aggregate("rows", start(bit), step).alias(name) for bit, name in ((False, "from_outside"), (True, "from_inside"))))


def _open_before(outside: Column, inside: Column, whole: Window) -> Column:
    """Whether a field is open before a row, where none is before the first; the columns are the row's map.

    It follows from the last row that sets the bit whatever it was, and from how
    many have turned it since.
    """
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.when(outside & ~inside, 1).otherwise(0)
    fixed = F.last(F.when(outside == inside, F.struct(outside.alias("bit"), F.col("_turned"))), ignorenulls=True).over(before)
    since = F.coalesce(F.sum(turns).over(before), F.lit(0)) - F.coalesce(fixed["_turned"], F.lit(0))
    return F.coalesce(fixed["bit"], F.lit(False)) != (since % 2 == 1)


def _with_open(rows: DataFrame, outside: Column, inside: Column, whole: Window) -> DataFrame:
    turned = F.sum(F.when(outside & ~inside, 1).otherwise(0)).over(whole.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("_turned", turned).withColumn("within", _open_before(outside, inside, whole)).drop("_turned")


def _chunk_starts(maps: DataFrame) -> DataFrame:
    """Per chunk: its first line that opens a record, the line that opened the record before it, and the number of earlier records.

    One window runs over the chunks of a file, another over the files.
    """
    whole = Window.partitionBy("file").orderBy("chunk")
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    known = _with_open(maps, F.col("from_outside.open"), F.col("from_inside.open"), whole)
    known = known.select("file", "chunk", F.when(F.col("within"), F.col("from_inside")).otherwise(F.col("from_outside")).alias("own"))
    placed = known.select(
        "file", "chunk", F.col("own.first").alias("first"), F.last("own.last", ignorenulls=True).over(before).alias("opened_before"),
        F.coalesce(F.sum("own.n").over(before), F.lit(0)).alias("records_before"),
    )
    earlier = Window.partitionBy(F.lit(0)).orderBy(*file_order(F.col("file"))).rowsBetween(Window.unboundedPreceding, -1)
    files = known.groupBy("file").agg(F.sum("own.n").alias("n"))
    files = files.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("file_base"))
    return placed.join(files, "file").select("file", "chunk", "first", "opened_before", (F.col("file_base") + F.col("records_before")).alias("base"))


def read_quoted_records(spark: SparkSession, path: str | list[str], header_lines: int = 0, chunk_lines: int = CHUNK_LINES, index: str | None = None) -> DataFrame:
    """``row_no`` and ``value`` of the records of tab-separated files with double quotes.

    A record is one line, or the lines that a quoted field goes over. The first
    ``header_lines`` lines of a file are dropped as lines; blank lines between
    records are none and are not counted. A quoted field that is never closed
    runs to the end of its file, less the last line end. Lines end with LF or CR LF, which is LF inside a
    quoted field; a CR alone is a character.

    Texts move once, to the chunk in which their record opens.
    """
    lines = number_rows(spark.read.option("lineSep", "\n").text(path), header_lines, index)
    lines = lines.withColumn("value", F.when(F.col("value").endswith("\r"), F.col("value").substr(F.lit(1), F.length("value") - 1)).otherwise(F.col("value")))
    lines = lines.select(
        "file", "line_no", "value", F.floor(F.col("line_no") / chunk_lines).alias("chunk"),
        F.col("value").rlike(OPEN_FROM_OUTSIDE).alias("outside"), F.col("value").rlike(OPEN_FROM_INSIDE).alias("inside"),
        (F.col("value") == "").alias("blank"),
    )
    starts = _chunk_starts(_chunk_maps(lines.drop("value")))
    # lines before the first that opens a record belong to the chunk where the record before them opened
    leads = F.col("first").isNull() | (F.col("line_no") < F.col("first"))
    home = F.when(leads, F.floor(F.col("opened_before") / chunk_lines)).otherwise(F.col("chunk"))
    rows = lines.join(starts, ["file", "chunk"]).withColumn("home", home).drop("chunk", "first", "opened_before")
    whole = Window.partitionBy("file", "home").orderBy("line_no")
    so_far = whole.rowsBetween(Window.unboundedPreceding, 0)
    rows = _with_open(rows, F.col("outside"), F.col("inside"), whole)
    opens = ~F.col("within")
    rows = rows.select(
        "file", "home", "line_no", "value", (opens & F.col("blank")).alias("nothing"),
        F.last(F.when(opens, F.col("line_no")), ignorenulls=True).over(so_far).alias("opened"),
        (F.first("base").over(so_far) + F.count_if(opens & ~F.col("blank")).over(so_far) - 1).cast("bigint").alias("row_no"),
    )
    records = rows.where(~F.col("nothing")).groupBy("file", "home", "opened").agg(
        F.max("row_no").alias("row_no"), F.array_sort(F.collect_list(F.struct("line_no", "value"))).alias("lines")
    )
    return records.select("row_no", F.array_join(F.transform("lines", lambda line: line["value"]), "\n").alias("value"))
