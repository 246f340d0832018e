"""Label collapse, votes, tags, keys and label vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelgrain.fixed_values import MIN_VOTES, NEGATIVE_GRADES, SEED, TAG_IDS
from labelgrain.functions.text import strip


def fail_when(bad: Column, message: Column | str, value: Column) -> Column:
    """``value``, or a run-time error carrying ``message`` where ``bad`` holds."""
    text = message if isinstance(message, Column) else F.lit(message)
    return F.when(F.coalesce(bad, F.lit(False)), F.raise_error(text)).otherwise(value)


def collapse_grade(grade: Column, strict: bool = False) -> Column:
    """Graded label text to 0/1: exactly ``'0'`` or ``'1'`` is 0, all else 1.

    ``strict`` raises on text outside ``'0'..'4'`` instead of calling it 1.
    """
    binary = F.when(grade.isin(*NEGATIVE_GRADES), 0).otherwise(1)
    if strict:
        known = F.coalesce(grade.isin("0", "1", "2", "3", "4"), F.lit(False))
        binary = fail_when(~known, F.concat(F.lit("unknown grade: "), F.coalesce(grade, F.lit("null"))), binary)
    return binary


def collapse_number(grade: Column) -> Column:
    """Numeric collapse: below 2 is 0, everything else including null is 1."""
    return F.when(~F.isnan(grade.cast("double")) & (grade < 2), 0).otherwise(1)


def normalise_key(key: Column) -> Column:
    return strip(key.cast("string"))


def vote_vector(votes: Column) -> Column:
    """A list literal such as ``[0, 1, 1]`` as an int array; raises on garbage."""
    parsed = F.from_json(votes, "array<int>")
    bad = votes.isNull() | parsed.isNull() | F.exists(parsed, lambda v: v.isNull())
    return fail_when(bad, F.concat(F.lit("not a vote list: "), F.coalesce(votes, F.lit("null"))), parsed)


def vote_label(votes: Column, min_votes: int = MIN_VOTES) -> Column:
    """1 when the votes of a list literal sum to at least ``min_votes``."""
    total = F.aggregate(vote_vector(votes), F.lit(0).cast("bigint"), lambda acc, v: acc + v)
    return (total >= min_votes).cast("int")


def tag_id(tag: Column, tags: dict[str, int] = TAG_IDS) -> Column:
    """Id of a category name; raises on an unknown name."""
    mapping = F.create_map(*[F.lit(x) for pair in tags.items() for x in pair])
    found = F.try_element_at(mapping, tag)
    return fail_when(found.isNull(), F.concat(F.lit("unknown tag: "), F.coalesce(tag, F.lit("null"))), found)


def as_vector(label: Column) -> Column:
    return F.array(label)


def parse_vector(text: Column, width: int) -> Column:
    """Comma-joined ints as an array of exactly ``width``; raises otherwise."""
    items = F.transform(F.split(strip(text), ","), lambda x: strip(x).try_cast("int"))
    bad = (F.size(items) != width) | F.exists(items, lambda x: x.isNull())
    return fail_when(bad, F.concat(F.lit(f"not {width} comma-joined ints: "), text), items)


def format_vector(vector: Column) -> Column:
    return F.array_join(F.transform(vector, lambda x: x.cast("string")), ",")


def hash_bits(key: Column, width: int, seed: int = SEED) -> Column:
    """``width`` (up to 32) coin flips per key, one per hex digit of its MD5.

    They depend on key and seed only, so any partitioning gives the same ones.
    """
    if not 1 <= width <= 32:
        raise ValueError("width must be 1..32")
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string")))
    return F.array(*[(F.substring(digest, i + 1, 1) >= "8").cast("int") for i in range(width)])


def random_bits(width: int, seed: int = SEED) -> Column:
    """``width`` seeded coin flips per row from Spark's generator."""
    return F.array(*[(F.rand(seed + i) < 0.5).cast("int") for i in range(width)])
