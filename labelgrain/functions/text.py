"""Stripping, tokenising, filtering and n-grams, all as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelgrain.fixed_values import MAX_TOKENS, NGRAM_SIZE, SNIPPET_CHARS, WHITESPACE

# Same characters as WHITESPACE: Unicode white space plus the four separators.
_WS_RUN = r"(?U)[\s\x1c-\x1f]+"


def strip(text: Column) -> Column:
    """Remove leading and trailing white space, tabs and Unicode spaces too."""
    return F.btrim(text, F.lit(WHITESPACE))


def tab_fields(text: Column) -> Column:
    return F.split(text, "\t")


def tab_field_count(text: Column) -> Column:
    """Number of ``tab_fields``, without making them."""
    return F.length(text) - F.length(F.translate(text, "\t", "")) + 1


def coerce_null(text: Column, null_text: str = "skip") -> Column:
    """``'nan'`` writes a null text as that word; ``'skip'`` leaves it null."""
    if null_text == "nan":
        return F.coalesce(text, F.lit("nan"))
    if null_text == "skip":
        return text
    raise ValueError("null_text must be 'nan' or 'skip'")


def ws_tokens(text: Column) -> Column:
    return F.filter(F.split(text, _WS_RUN), lambda t: t != "")


def ws_token_count(text: Column) -> Column:
    """Number of white-space separated tokens; null for a null text."""
    return F.when(text.isNotNull(), F.size(ws_tokens(text)))


def truncate_tokens(tokens: Column, n: int = MAX_TOKENS) -> Column:
    return F.slice(tokens, 1, n)


def snippet(text: Column, n: int = SNIPPET_CHARS) -> Column:
    return F.substring(text, 1, n)


def letter_tokens(text: Column) -> Column:
    """Maximal runs of letters: the simple tokeniser for n-gram reports."""
    return F.filter(F.split(text, r"[^\p{L}]+"), lambda t: t != "")


# The word-tokenisation rules of the public Penn Treebank
# convention, as one pattern that matches a token at a time. A text is scanned
# once, however many rules there are; every repetition is possessive, so the
# matcher neither backtracks nor recurses on long texts.
ABBREVIATIONS = (
    "mr", "mrs", "ms", "dr", "prof", "st", "jr", "sr", "vs", "etc", "inc", "ltd", "co", "corp",
    "e.g", "i.e", "u.s", "u.k", "a.m", "p.m",
)
_SPACE = r"[\s\x1c-\x1f]"
_SYMBOL = r";@#$%&?!*\[\](){}<>«“‘„»”’"
_NO_WORD = r"(?![\p{L}\p{N}])"
# a full stop that belongs to an abbreviation or an initial
_KEPT_STOP = (
    r"(?<=(?:^|[^\p{L}\p{N}])(?i:" + "|".join(a.replace(".", r"\.") for a in ABBREVIATIONS) + r"|\p{L})\.)"
)
# one that ends a sentence: closing marks, then white space, an opening quote or the end
_FINAL_STOP = r"\.(?=[\])}>'»”’]*+(?:" + _SPACE + r"|[«“‘„`]|\z))(?!" + _KEPT_STOP + ")"
_SEPARATOR = r"[:,](?![0-9])"
_NOT = r"[nN]'[tT]" + _NO_WORD
_CLITIC = r"'(?i:s|m|d|ll|re|ve)" + _NO_WORD
_LONE_QUOTE = f"'(?={_SPACE}|[{_SYMBOL}`]|--|\\.\\.|{_SEPARATOR}|{_FINAL_STOP}|\\z)"
_HALVES = (("can", "not"), ("gim|lem", "me"), ("gon|wan", "na"), ("got", "ta"), ("'t", "is|was"))
_CONTRACTIONS = "|".join(f"(?:{first})(?=(?:{second}){_NO_WORD})" for first, second in _HALVES)
# the common case, tried first: letters and digits with nothing to decide behind them
_PLAIN = (
    r"(?![cglwCGLW](?i:annot|imme|emme|onna|anna|otta))[\p{L}\p{N}]++"
    f"(?={_SPACE}|[;!?()]|,(?![0-9])|\\z)"
)
_WORD = (
    f"(?:[^\\s\\x1c-\\x1f{_SYMBOL}:,.'`nN-]++|[nN](?!'[tT]{_NO_WORD})|-(?!-)|[:,](?=[0-9])"
    f"|(?!{_FINAL_STOP})\\.(?!\\.)|(?!''|{_CLITIC}|{_LONE_QUOTE})')++"
)
WORD_PATTERN = (
    f"(?U){_PLAIN}|[{_SYMBOL}]|`++|''|\\.\\.++|--|{_SEPARATOR}|{_NOT}|{_CLITIC}"
    f"|(?<![^\\s\\x1c-\\x1f])(?i:{_CONTRACTIONS})|{_WORD}|[^\\s\\x1c-\\x1f]"
)
_OPENING = r"(?<![^\s(\[{<])" + '"' + r"|(?<=[\s(\[{<])''"


def word_tokens(text: Column) -> Column:
    """Word tokens: punctuation apart, contractions split, hyphens kept.

    Straight double quotes become `` and ''. Sentence ends are recognised by a
    rule (a full stop before white space or the end, unless it closes a listed
    abbreviation or an initial) and not by a trained splitter.
    """
    opened = F.regexp_replace(text, _OPENING, "``")
    quoted = F.when(text.contains('"') | text.contains("''"), F.replace(opened, F.lit('"'), F.lit("''"))).otherwise(text)
    return F.regexp_extract_all(quoted, F.lit(WORD_PATTERN), F.lit(0))


def content_tokens(tokens: Column, stop_words: list[str] | tuple[str, ...] = ()) -> Column:
    """Keep alphabetic tokens that are not stop words, duplicates included."""
    alphabetic = F.filter(tokens, lambda t: t.rlike(r"^\p{L}+$"))
    return drop_stop_words(alphabetic, stop_words)


def drop_stop_words(tokens: Column, stop_words: list[str] | tuple[str, ...]) -> Column:
    stops = list(stop_words)
    return F.filter(tokens, lambda t: ~t.isin(stops)) if stops else tokens


def ngrams(tokens: Column, n: int = NGRAM_SIZE) -> Column:
    """Space-joined runs of ``n`` neighbouring tokens; empty for short lists."""
    if n < 1:
        raise ValueError("n must be at least 1")
    grams = F.transform(tokens, lambda t, i: F.concat_ws(" ", t, *[F.get(tokens, i + j) for j in range(1, n)]))
    whole = F.slice(grams, F.lit(1), F.size(tokens) - (n - 1))
    return F.when(F.size(tokens) >= n, whole).otherwise(F.array().cast("array<string>"))
