import random

import pytest
from pyspark.sql import functions as F

from labelgrain.fixed_values import TAG_IDS, WHITESPACE
from labelgrain.functions import labels as L
from labelgrain.functions import numbers as N
from labelgrain.functions import text as T

t = F.col("t")


def test_strip_and_tokens_follow_python_whitespace(texts, values):
    rng = random.Random(1)
    alphabet = list(WHITESPACE) + list("ab'é​中")
    samples = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(300)] + [""]
    df = texts(*samples)
    assert values(df, T.strip(t)) == [s.strip() for s in samples]
    assert values(df, T.ws_tokens(t)) == [s.split() for s in samples]
    assert values(df, T.ws_token_count(t)) == [len(s.split()) for s in samples]


def test_null_text(texts, values):
    df = texts(None)
    assert values(df, T.ws_token_count(t)) == [None]
    assert values(df, F.size(T.word_tokens(T.coerce_null(t, "nan")))) == [1]
    assert values(df, T.coerce_null(t, "skip")) == [None]
    with pytest.raises(ValueError):
        T.coerce_null(t, "other")


@pytest.mark.parametrize(
    "text, tokens",
    [
        ("The cat can't say no.", ["The", "cat", "ca", "n't", "say", "no", "."]),
        ("It's John's, isn't it?", ["It", "'s", "John", "'s", ",", "is", "n't", "it", "?"]),
        ('He said: "well-known (so)".', ["He", "said", ":", "``", "well-known", "(", "so", ")", "''", "."]),
        ("Mr. J. R. Smith left. He won 3,000 at 5:30!", ["Mr.", "J.", "R.", "Smith", "left", ".", "He", "won", "3,000", "at", "5:30", "!"]),
        ("wait... no -- yes", ["wait", "...", "no", "--", "yes"]),
        ("cannot gimme wanna gotta 'tis", ["can", "not", "gim", "me", "wan", "na", "got", "ta", "'t", "is"]),
        ("canna cannot", ["canna", "can", "not"]),
        ("the dogs' bowl", ["the", "dogs", "'", "bowl"]),
        ("I'd've gone", ["I", "'d", "'ve", "gone"]),
        ("$5.00 & 50%", ["$", "5.00", "&", "50", "%"]),
        ("L'été «bon».", ["L'été", "«", "bon", "»", "."]),
        ("", []),
        (" \n\t ", []),
    ],
)
def test_word_tokens(texts, values, text, tokens):
    assert values(texts(text), T.word_tokens(t)) == [tokens]


def plain_quotes(text):
    return text.replace('"', "''").replace("`", "'")


def test_word_tokens_lose_no_character_and_survive_long_runs(texts, values):
    rng = random.Random(2)
    samples = ["".join(rng.choices("nNt'.,:-`\"() aA1“\n", k=200)) for _ in range(200)]
    samples += ["n" * 50_000, "n't" * 20_000, "." * 50_000, "-" * 50_001, "'" * 50_000, "a." * 20_000]
    for sample, tokens in zip(samples, values(texts(*samples), T.word_tokens(t))):
        assert all(tokens)
        assert plain_quotes("".join(tokens)) == plain_quotes("".join(sample.split()))


def test_ngrams_span_removed_tokens(texts, values):
    df = texts("The river and the Hills, the river")
    tokens = T.drop_stop_words(T.letter_tokens(F.lower(t)), ["the", "and"])
    assert values(df, tokens) == [["river", "hills", "river"]]
    assert values(df, T.ngrams(tokens, 2)) == [["river hills", "hills river"]]
    assert values(df, T.ngrams(tokens, 3)) == [["river hills river"]]
    assert values(df, T.ngrams(tokens, 4)) == [[]]
    assert values(df, T.ngrams(tokens, 1)) == [["river", "hills", "river"]]


def test_content_tokens_keep_duplicates(texts, values):
    df = texts("a b2 c c été don't the")
    assert values(df, T.content_tokens(T.ws_tokens(t), ["the", "a"])) == [["c", "c", "été"]]


def test_truncate_and_snippet(texts, values):
    df = texts("a b c", "x" * 300)
    assert values(df, T.truncate_tokens(T.ws_tokens(t), 2)) == [["a", "b"], ["x" * 300]]
    assert [len(s) for s in values(df, T.snippet(t))] == [5, 200]


def test_grades(spark, texts, values):
    df = texts("0", "1", "2", "3", "4", "5", "text", None)
    assert values(df, L.collapse_grade(t)) == [0, 0, 1, 1, 1, 1, 1, 1]
    assert values(texts("0", "4"), L.collapse_grade(t, strict=True)) == [0, 1]
    with pytest.raises(Exception, match="unknown grade: 5"):
        values(texts("5"), L.collapse_grade(t, strict=True))
    numbers = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (None,), (float("nan"),)], "t double")
    assert values(numbers, L.collapse_number(t)) == [0, 0, 1, 1, 1]


def test_votes(texts, values):
    df = texts("[0, 0, 0]", "[0, 1, 0]", "[1, 1]", "[1,1,1,1,1,1,1]", "[]", "[2]")
    assert values(df, L.vote_label(t)) == [0, 0, 1, 1, 0, 1]
    for bad in ("oops", "[1, x]", None):
        with pytest.raises(Exception, match="not a vote list"):
            values(texts(bad), L.vote_label(t))


def test_tags(texts, values):
    df = texts(*TAG_IDS)
    assert values(df, L.tag_id(t)) == list(TAG_IDS.values())
    for bad in ("Other", None):
        with pytest.raises(Exception, match="unknown tag"):
            values(texts(bad), L.tag_id(t))


def test_vectors(texts, values):
    assert values(texts(" 1,0, 1 \n"), L.parse_vector(t, 3)) == [[1, 0, 1]]
    assert values(texts("1,0,1"), L.format_vector(L.parse_vector(t, 3))) == ["1,0,1"]
    for bad in ("1,0", "1,0,1,1", "1,x,0", ""):
        with pytest.raises(Exception, match="not 3 comma-joined ints"):
            values(texts(bad), L.parse_vector(t, 3))


def test_coin_flips_do_not_depend_on_partitions(spark):
    ids = spark.range(500)
    one = ids.repartition(1).select("id", L.hash_bits(F.col("id"), 7).alias("v")).collect()
    many = ids.repartition(7).select("id", L.hash_bits(F.col("id"), 7).alias("v")).collect()
    assert sorted(one) == sorted(many)
    ones = sum(sum(r["v"]) for r in one)
    assert 0.45 < ones / 3500 < 0.55
    random_ones = ids.select(F.aggregate(L.random_bits(7), F.lit(0), lambda a, b: a + b).alias("s")).agg(F.sum("s")).first()[0]
    assert 0.45 < random_ones / 3500 < 0.55


def test_half_even_rounding(spark, values):
    df = spark.createDataFrame([(0.25,), (0.35,), (0.125,), (None,)], "t double")
    assert values(df, N.half_even(t, 1)) == [0.2, 0.4, 0.1, None]
    assert values(df, N.half_even(t, 2)) == [0.25, 0.35, 0.12, None]


def test_ratio_guard(spark, values):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 4)], "a int, b int")
    assert values(df, N.ratio(F.col("a"), F.col("b"))) == [0.0, 0.0, 0.25]


def test_decision_is_single_precision(spark, values):
    df = spark.createDataFrame([(0.12,), (0.1199999,), (float("nan"),)], "t float")
    assert values(df, N.decide(t, 0.12)) == [1, 0, 0]


def test_length_bins(spark, values):
    df = spark.createDataFrame([(n,) for n in (0, 1, 20, 21, 200, 201, 1000, 1001, None)], "t int")
    expected = [None, "0-20", "0-20", "21-40", "101-200", "200+", "200+", None, None]
    assert values(df, N.bin_label(N.bin_ordinal(t))) == expected


def test_error_types_and_correctness(spark, values):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0)], "p int, g int")
    assert values(df, N.error_type(F.col("p"), F.col("g"))) == ["TP", "FP", "FN", "TN"]
    assert values(df, N.correct(F.col("p"), F.col("g"))) == [1, 0, 0, 1]


def test_softmax(spark, values):
    import math

    df = spark.createDataFrame([(0.0, 0.0), (1.0, 3.0)], "a double, b double")
    got = values(df, N.positive_probability(F.col("a"), F.col("b")))
    assert got == pytest.approx([0.5, math.exp(3) / (math.exp(1) + math.exp(3))])


def test_float_text_is_the_way_python_prints(spark, values):
    numbers = [0.0, 1.0, 0.5714285714285714, 0.1, 0.0005, 0.00012345, 5e-05, 5.5e-05, 1.25e-10, 123.5]
    df = spark.createDataFrame([(x,) for x in numbers], "t double")
    assert values(df, N.python_float_text(t)) == [str(x) for x in numbers]
    assert values(df.limit(1), N.fixed_point(t, 4)) == ["0.0000"]
    assert values(df.limit(1), N.fixed_point(t, 1, "%")) == ["0.0%"]


def test_fixed_point_rounds_the_exact_value_half_to_even(spark, values):
    import random

    rng = random.Random(3)
    numbers = [6.25, 6.35, 0.15, 0.25, 0.35, 0.03125, 1.005, 2.675, 0.5, 1.5, -0.04, -6.25, 0.0, 1e-9, 123456.785, 1e15, float("nan"), float("inf"), float("-inf")]
    numbers += [rng.randint(0, 10**6) / 2 ** rng.randint(1, 12) for _ in range(200)] + [rng.randint(-(10**6), 10**6) / 10 ** rng.randint(1, 6) for _ in range(200)]
    df = spark.createDataFrame([(x,) for x in numbers], "t double")
    for digits in (0, 1, 2, 3, 4):
        assert values(df, N.fixed_point(t, digits)) == [f"{x:.{digits}f}" for x in numbers]


def test_missing_scores_are_decided_as_0(spark, values):
    df = spark.createDataFrame([(None,), (float("nan"),), (0.5,)], "t double")
    assert values(df, N.decide(t, 0.1)) == [0, 0, 1]
