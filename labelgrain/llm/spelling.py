"""Spelling variants of words by asymmetric chunks.

Two words are near if one edit turns one into the other. Seen from the longer
word (either, if they are equally long) the edit replaces or deletes one of its
code points. Cut in two disjoint chunks, it keeps one of them whole, and the
other word has that chunk as a gram at the same place, or one place earlier if it
stands behind a deletion. One half word alone would be shared by ever more words
as a vocabulary grows, so the rule is applied again to the open half, and again
to what is open then: at most three times, or until two code points are open. A
word so contributes up to eight keys of kept chunks, the other word the grams at
the places that such chunks can have in a word as long as itself or one longer,
and a key is shared by few words whatever the vocabulary. Pairs that share a key
are verified: what is open by edit distance, what is kept letter by letter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelgrain.llm.storage import stored

LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH, MIN_COUNT = 5, 3
#: A run loses a code point where this divides the hash of document and run.
TYPO_RATE = 97
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Halvings of a word; and the open code points at which halving ends.
LEVELS, OPEN = 3, 2
#: A form is this many times as frequent as its variant.
FORM_RATIO = 2


def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, typo_rate: int | None = TYPO_RATE) -> DataFrame:
    """``word`` for each run of letters of at least ``min_length``, A-Z in lower case.

    With ``typo_rate`` a run loses code point ``h % length`` where the rate
    divides ``h``, the CRC-32 of ``<id>:<run>``; a null id counts as empty there.
    A null text has no runs.
    """
    runs = F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0)))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), runs.alias("_run"))
    # lower() alone would change accented letters too
    rows = rows.select("_id", F.when(F.lower("_run") == F.col("_run"), F.col("_run")).otherwise(F.translate("_run", UPPER, LOWER)).alias("word"))
    if typo_rate is None:
        return rows.select("word")
    rows = rows.select("word", F.crc32(F.concat_ws(":", "_id", "word").cast("binary")).alias("_h"))
    at = F.pmod("_h", F.length("word")).cast("int")
    cut = F.concat(F.substring(F.col("word"), F.lit(1), at), F.substring(F.col("word"), at + 2, F.length("word")))
    return rows.select(F.when(F.col("_h") % typo_rate == 0, cut).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word`` and ``n``, counted before the shuffle and again behind it."""
    counts = words.where(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= min_count)


def _keyed(words: DataFrame, shifts: list[int], levels: int) -> DataFrame:
    """``words`` once per key, for partners that are longer by one of ``shifts``: the open part and where it starts.

    The key is a hash of the kept chunks and of what part of a word of which
    length is open.
    """
    rows = words.withColumn("_shift", F.explode(F.array(*map(F.lit, shifts))))
    length = F.length("word") + F.col("_shift")
    parts = F.lit(1 << levels)
    for level in reversed(range(1, levels)):
        parts = F.when(length <= OPEN << level, F.lit(1 << level)).otherwise(parts)
    rows = rows.withColumns({"_length": length, "_parts": parts})
    rows = rows.withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    length, k, parts = F.col("_length"), F.col("_k"), F.col("_parts")
    rows = rows.withColumn("_start", F.floor(k * length / parts).cast("int")).withColumn(
        "_open", F.substring(F.col("word"), F.col("_start") + 1, F.floor((k + 1) * length / parts).cast("int") - F.col("_start") - F.col("_shift"))
    )
    return rows.withColumn("_key", F.xxhash64(length, k, _before(F.col("word"), F.col("_start")), _behind(F.col("word"), F.col("_start"), F.col("_open"))))


def _before(word: Column, start: Column) -> Column:
    return F.substring(word, F.lit(1), start)


def _behind(word: Column, start: Column, part: Column) -> Column:
    return F.substring(word, start + F.length(part) + 1, F.length(word))


def moved(df: DataFrame) -> DataFrame:
    """``df``, never broadcast in a join.

    Spark sizes a table by its compressed file, and takes an explode for one row
    each, so it would send a whole vocabulary and all its keys by the driver.
    """
    return df.hint("merge")


def near_words(words: DataFrame, levels: int = LEVELS) -> DataFrame:
    """All pairs of near words once: ``a``, ``n_a``, ``b``, ``n_b``, with ``a`` the longer word, or the first in code-point order.

    ``words`` has distinct ``word`` and ``n``; more ``levels`` make keys more
    selective and change no result.
    """
    names = ["word", "n", "_start", "_open"]
    chunks = moved(_keyed(words, [0], levels).select("_key", F.struct(*names).alias("a")))
    grams = moved(_keyed(words, [0, 1], levels).select("_key", F.struct(*names).alias("b")))
    a, b = ({n: F.col(f"{side}.{n}") for n in names} for side in "ab")
    found = chunks.join(grams, "_key").where(
        ((F.length(a["_open"]) > F.length(b["_open"])) | (a["word"] < b["word"]))
        & (F.levenshtein(a["_open"], b["_open"], 1) == 1)
        & (a["_start"] == b["_start"])
        & (_before(a["word"], a["_start"]) == _before(b["word"], b["_start"]))
        & (_behind(a["word"], a["_start"], a["_open"]) == _behind(b["word"], b["_start"], b["_open"]))
    )
    # a deletion in a run of equal letters is found in each part that the run touches
    return found.select(a["word"].alias("a"), a["n"].alias("n_a"), b["word"].alias("b"), b["n"].alias("n_b")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of ``forms``' ``word`` and ``form``: where following forms ends.

    Each round doubles the steps taken; a form is more frequent than its
    variant, so chains are short and have no loops.
    """
    steps = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        on = steps.select(F.col("word").alias("_up"), F.col("root").alias("_next"))
        step = steps.join(moved(on), steps["root"] == on["_up"], "left")
        steps = stored(step.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")))
        if steps.where("moved").isEmpty():
            return steps.select("word", "root")
        steps = steps.select("word", "root")


def spelling_variants(words: DataFrame, levels: int = LEVELS, ratio: int = FORM_RATIO) -> DataFrame:
    """Per word of ``words`` (distinct ``word``, ``n``): ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    ``n_near`` counts near words. ``form`` is the most frequent of them, the
    first in code-point order among equals, if it is at least ``ratio`` times as
    frequent as the word, else null, as is ``form_n``. ``root`` is where forms
    lead to. An empty table gives an empty result.
    """
    words = stored(words.select("word", "n"))
    pairs = stored(near_words(words, levels))
    ends = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))
    )
    best = ends.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    best_n = -F.col("best.less")
    is_form = best_n >= ratio * F.col("n")
    rows = stored(
        words.join(moved(best), "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"),
            F.when(is_form, best_n).alias("form_n"),
        )
    )
    ends_at = roots(rows.where("form is not null"))
    return rows.join(moved(ends_at), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def document_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", typo_rate: int | None = TYPO_RATE) -> DataFrame:
    """``spelling_variants`` of the words of ``docs``.

    Null and empty texts have no words; rows alike count as often as they occur;
    a very long run is a word like any other. Other columns are not looked at.
    """
    return spelling_variants(vocabulary(words_of(docs, id_col, text_col, typo_rate=typo_rate)))
