"""Learned sentence ends against plain counting."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from labelgrain.operators import sentences

TEXTS = [
    "Dr. Smith met Prof. Jones. They talked to Dr. Brown about e.g. the plan.",
    "Prof. Brown left. Dr. Jones stayed (at St. Ives). Why? Nobody knew!",
    "The plan failed. The plan was bad. It ended there. It rained.",
    'He said "stop." Then he left. A plan e.g. this one. The end',
    "", None, "one", "...", "St. Ives. St. Ives is far. Dr. Who? 3. 4. x",
] * 3
AROUND = r"^[(\[{\"'“‘„«]+|[)\]}\"'”’»,;:!?]+$"


def tokens(text):
    made = []
    for t in (text or "").split():
        bare = re.sub(AROUND, "", t.lower())
        stop = bare.endswith(".")
        made.append((bare[:-1] if stop else bare, stop, bool(re.search(r"[!?][)\]}\"'”’»]*$", t))))
    return made


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string").repartition(3)
    return sentences.token_rows(df, "text", ("doc_id",)).cache()


def likely(hits, n, p):
    return sum(c * math.log(q) for c, q in ((hits, p), (n - hits, 1 - p)) if c)


def abbreviation_scores():
    every = [t for text in TEXTS for t in tokens(text)]
    stops, n = Counter(t for t, s, _ in every if s), Counter(t for t, _, _ in every)
    p = sum(stops.values()) / len(every)
    found = {}
    for t, k in stops.items():
        if re.search("[^\\W\\d_]", t):
            inner = t.count(".")
            size = len(t) - inner
            ratio = 2 * (likely(k, n[t], 0.99) - likely(k, n[t], p))
            found[t] = (k, n[t] - k, ratio * math.exp(-size) * (inner + 1) * size ** -(n[t] - k))
    return found


def collocation_scores():
    every = [t for text in TEXTS for t in tokens(text)]
    pairs = Counter((a[0], b[0]) for text in TEXTS for a, b in zip(tokens(text), tokens(text)[1:]) if a[1])
    first, second, total = Counter(t for t, s, _ in every if s), Counter(t for t, _, _ in every), len(every)
    found = {}
    for (x, y), n in pairs.items():
        a, b = first[x], second[y]
        p, p1, p2 = b / total, n / a, (b - n) / (total - a)
        ratio = 2 * (likely(n, a, p1) + likely(b - n, total - a, p2) - likely(n, a, p) - likely(b - n, total - a, p))
        found[x, y] = (n, ratio if p1 > p else 0.0)
    return found


def test_token_rows(rows):
    found = sorted((r.doc_id, r.pos, r.type, r.stop, r.mark, r.next) for r in rows.collect())
    expected = []
    for i, text in enumerate(TEXTS):
        own = tokens(text)
        expected += [(i, k, *t, own[k + 1][0] if k + 1 < len(own) else None) for k, t in enumerate(own)]
    assert found == expected


def test_abbreviation_statistics(rows):
    found = {r.type: (r.with_stop, r.without_stop, pytest.approx(r.score, abs=1e-12)) for r in sentences.abbreviation_statistics(rows).collect()}
    assert found == abbreviation_scores()
    short = {r.type for r in sentences.abbreviations(sentences.abbreviation_statistics(rows)).collect()}
    assert {"dr", "e.g"} <= short and not {"plan", "left", "jones"} & short


def test_collocation_statistics(rows):
    found = {(r.type, r.next): (r.n, pytest.approx(r.score, abs=1e-9)) for r in sentences.collocation_statistics(rows).collect()}
    assert found == collocation_scores()


def test_sentence_ends(rows):
    short = {t for t, (_, _, s) in abbreviation_scores().items() if s >= 0.3}
    pairs = {p for p, (_, s) in collocation_scores().items() if s >= 7.88}
    expected = []
    for i, text in enumerate(TEXTS):
        own = tokens(text)
        for k, (t, stop, mark) in enumerate(own):
            after = own[k + 1][0] if k + 1 < len(own) else None
            if mark or after is None or (stop and t not in short and (t, after) not in pairs):
                expected.append((i, k))
    statistics = sentences.collocation_statistics(rows).where(f"score >= {sentences.COLLOCATION_SCORE}")
    ends = sentences.sentence_ends(rows, sentences.abbreviations(sentences.abbreviation_statistics(rows)), statistics, ("doc_id",))
    assert sorted((r.doc_id, r.pos) for r in ends.collect()) == expected


def test_no_tokens(spark):
    none = sentences.token_rows(spark.createDataFrame([(1, None), (2, "")], "doc_id int, text string"), "text", ("doc_id",))
    assert none.count() == 0 and sentences.abbreviation_statistics(none).count() == 0 and sentences.collocation_statistics(none).count() == 0


@pytest.mark.parametrize("statistics", [sentences.abbreviation_statistics, sentences.collocation_statistics])
def test_statistics_read_the_texts_once(spark, statistics):
    read = spark.sparkContext.accumulator(0)

    def counted(text):
        read.add(1)
        return text

    df = spark.createDataFrame([(t,) for t in TEXTS], "text string").select(F.udf(counted).asNondeterministic()("text").alias("text"))
    assert statistics(sentences.token_rows(df, "text")).count() > 0
    assert read.value == len(TEXTS)


def test_statistics_of_pair_counts_are_those_of_tokens(rows):
    counts = sentences.pair_counts(rows)
    for statistics in (sentences.abbreviation_statistics, sentences.collocation_statistics):
        assert sorted(map(tuple, statistics(counts).drop("score").collect())) == sorted(map(tuple, statistics(rows).drop("score").collect()))


def test_marks_and_brackets_around_words_of_other_scripts(spark):
    text = "(ΟΔΟΣ. «ΟΔΟΣ» ΟΔΟΣ?) ''\u2009İstanbul.\u3000\"(a).\" ,;: “B!”» .c.. )("
    df = spark.createDataFrame([(text,)], "text string")
    found = sentences.token_rows(df, "text").orderBy("pos").select("type", "stop", "mark").collect()
    assert [tuple(r) for r in found] == tokens(text)
