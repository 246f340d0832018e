"""Sentence ends learned from a corpus: abbreviations and collocations by log likelihood.

Whether a full stop ends a sentence or belongs to an abbreviation is told from
counts alone, as Kiss and Strunk describe it in "Unsupervised multilingual
sentence boundary detection" (2006): an abbreviation nearly always has its stop,
is short, and may have stops inside; and two words that often meet across a
stop are a collocation, with no sentence between them. All counts are sums over
token types, combined before the shuffle and stored, so that texts are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelgrain.functions.text import ws_tokens
from labelgrain.operators.shared import stored

#: Fixed values of the paper: the share of stops an abbreviation has, and from which scores on types are abbreviations and pairs collocations.
STOP_SHARE, ABBREVIATION_SCORE, COLLOCATION_SCORE = 0.99, 0.3, 7.88
_OPENING, _CLOSING = "([{\"'“‘„«", ")]}\"'”’»"
_MARKS = ",;:!?"


def token_rows(df: DataFrame, text_col: str, keep_cols: tuple[str, ...] = ()) -> DataFrame:
    """``keep_cols``, ``pos``, ``type``, ``stop``, ``mark`` and the following token's ``next``, per white-space token of a text.

    The type is in lower case, without brackets, quotes and marks around it
    and without one full stop at its end, which ``stop`` tells of; ``mark`` tells
    of a question or exclamation mark there. Null texts have no tokens.
    """
    def bare(t: Column) -> Column:
        return F.rtrim(F.ltrim(t, F.lit(_OPENING)), F.lit(_CLOSING + _MARKS))

    def kind(t: Column) -> Column:
        return F.when(t.endswith("."), F.substring(t, F.lit(1), F.length(t) - 1)).otherwise(t)

    # exploded out of an array of one, tokens are made once; white space splits words for the
    # rules of lower case, too, so that a whole text may go there at once
    made = F.explode(F.array(ws_tokens(F.lower(F.coalesce(F.col(text_col), F.lit(""))))))
    rows = df.select(*keep_cols, made.alias("_tokens"))
    rows = rows.select(*keep_cols, "_tokens", F.posexplode("_tokens").alias("pos", "_token"))
    # one step after the other and outside of lambdas, no value is worked out twice
    last = F.substring(F.rtrim(F.col("_token"), F.lit(_CLOSING)), -1, 1)
    rows = rows.select(*keep_cols, "pos", bare(F.col("_token")).alias("_bare"), last.isin("!", "?").alias("mark"), bare(F.get("_tokens", F.col("pos") + 1)).alias("_after"))
    return rows.select(*keep_cols, "pos", kind(F.col("_bare")).alias("type"), F.col("_bare").endswith(".").alias("stop"), "mark", kind(F.col("_after")).alias("next"))


def pair_counts(tokens: DataFrame) -> DataFrame:
    """``type``, ``stop``, ``next`` and ``n`` of the tokens; ``next`` only of those with a stop. Stored.

    The statistics here take it wherever they take tokens.
    """
    after = F.when(F.col("stop"), F.col("next"))
    return stored(tokens.select("type", "stop", after.alias("next")).groupBy("type", "stop", "next").agg(F.count("*").alias("n")))


def _log_binomial(hits: Column, n: Column, p: Column) -> Column:
    """The log likelihood of ``hits`` of ``n`` at a probability; impossible ones are bounded."""
    def part(count: Column, share: Column) -> Column:
        return F.when(count == 0, 0.0).otherwise(count * F.ln(F.greatest(share, F.lit(1e-300))))

    return part(hits, p) + part(n - hits, 1.0 - p)


def abbreviation_statistics(tokens: DataFrame) -> DataFrame:
    """Per type with a letter that occurs before a stop: ``type``, ``with_stop``, ``without_stop`` and ``score``.

    The score is the log likelihood ratio of a type that nearly always has a
    stop against one that has it as often as any token, times factors for
    its length, its inner stops and its occurrences without a stop.
    """
    if "n" in tokens.columns:
        times = [F.sum(F.when(of, F.col("n")).otherwise(0)) for of in (F.col("stop"), ~F.col("stop"))]
    else:
        times = [F.count_if(of) for of in (F.col("stop"), ~F.col("stop"))]
    # a filter on the type would else move below and count the tokens a second time
    counts = stored(tokens.groupBy("type").agg(times[0].alias("with_stop"), times[1].alias("without_stop")))
    sums = counts.agg(F.struct(F.sum("with_stop").alias("stops"), F.sum(F.col("with_stop") + F.col("without_stop")).alias("n")).alias("s")).scalar()
    stops, without = F.col("with_stop"), F.col("without_stop")
    n = stops + without
    likely = _log_binomial(stops, n, F.lit(STOP_SHARE))
    usual = _log_binomial(stops, n, (sums["stops"] / sums["n"]).cast("double"))
    inner = F.length("type") - F.length(F.replace("type", F.lit("."), F.lit("")))
    size = F.length("type") - inner
    score = 2.0 * (likely - usual) * F.exp(-size) * (inner + 1) * F.exp(-without * F.ln(size.cast("double")))
    known = counts.where((stops > 0) & F.col("type").rlike(r"\p{L}"))
    return known.select("type", "with_stop", "without_stop", score.alias("score"))


def abbreviations(statistics: DataFrame, least: float = ABBREVIATION_SCORE) -> DataFrame:
    """The types taken for abbreviations."""
    return statistics.where(F.col("score") >= least).select("type")


def collocation_statistics(tokens: DataFrame) -> DataFrame:
    """Per pair of a type with a stop and the type after it: ``type``, ``next``, ``n`` and ``score``.

    Dunning's log likelihood ratio of the pair against chance; it is 0 for pairs
    rarer than chance.
    """
    counts = tokens if "n" in tokens.columns else pair_counts(tokens)
    pairs = counts.where("stop and next is not null").select("type", "next", "n")
    firsts = counts.where("stop").groupBy("type").agg(F.sum("n").alias("n_first"))
    seconds = counts.groupBy(F.col("type").alias("next")).agg(F.sum("n").alias("n_second"))
    total = seconds.agg(F.sum("n_second").alias("n")).scalar().cast("double")
    joined = pairs.join(firsts, "type").join(seconds, "next")
    n, a, b = F.col("n"), F.col("n_first"), F.col("n_second")
    p, p1, p2 = b / total, n / a, (b - n) / (total - a)
    ratio = 2.0 * (_log_binomial(n, a, p1) + _log_binomial(b - n, total - a, p2) - _log_binomial(n, a, p) - _log_binomial(b - n, total - a, p))
    return joined.select("type", "next", "n", F.when(p1 > p, ratio).otherwise(0.0).alias("score"))


def sentence_ends(tokens: DataFrame, abbreviation_types: DataFrame, collocations: DataFrame, keep_cols: tuple[str, ...]) -> DataFrame:
    """``keep_cols`` and ``pos`` of the tokens that end a sentence.

    These are tokens with a question or exclamation mark, those with a stop
    that are no abbreviation (a number or a single letter before a further word is none either
    way: they go by the same counts) and make no collocation with the next
    token, and the last token of a text.
    """
    marked = tokens.where(F.col("stop") | F.col("mark") | F.col("next").isNull())
    short = marked.join(abbreviation_types.withColumn("_short", F.lit(True)), "type", "left")
    paired = short.join(collocations.select("type", "next", F.lit(True).alias("_pair")), ["type", "next"], "left")
    ends = F.col("mark") | F.col("next").isNull() | (F.col("_short").isNull() & F.col("_pair").isNull())
    return paired.where(ends).select(*keep_cols, "pos")
