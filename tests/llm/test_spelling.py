"""Spelling variants against brute force."""

import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from labelgrain.llm import spelling
from labelgrain.llm.oracles import ORACLES
from labelgrain.llm.spelling import document_variants, near_words, roots, spelling_variants, vocabulary, words_of

from corpus import frame

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def edit_one(a, b):
    """Whether one edit turns ``a`` into ``b``."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) < len(b):
        a, b = b, a
    i = next((i for i in range(len(b)) if a[i] != b[i]), len(b))
    return a[i + 1 :] == (b[i:] if len(a) > len(b) else b[i + 1 :])


def counted(rows, typo_rate=97):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if typo_rate and h % typo_rate == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def variants(counts):
    near = {w: [v for v in counts if edit_one(w, v)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 2 * n else None
    found = {}
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        found[w] = (form[w], root, counts[w], len(near[w]), counts.get(form[w]))
    return found


def rows_of(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: tuple(r)[1:] for r in rows}


def misspelt(seed, n):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcdé") for _ in range(rnd.randint(5, 11))) for _ in range(40)]
    texts = []
    for _ in range(n):
        words = []
        for w in rnd.choices(base, weights=[2**-(k % 7) for k in range(40)], k=60):
            if rnd.random() < 0.3:
                k = rnd.randrange(len(w))
                w = rnd.choice([w[:k] + w[k + 1 :], w[:k] + "b" + w[k:], w[:k] + "a" + w[k + 1 :]])
            words.append(rnd.choice([w, w.capitalize(), w.upper()]))
        texts.append("".join(w + rnd.choice([" ", "-", "1", "\n", ", "]) for w in words))
    return texts


def test_variants_of_documents(spark):
    rows = list(enumerate(misspelt(1, 60))) + [(None, "Null Null NULLS nulls nulls"), (3, None), (4, ""), (5, "12 34"), (6, "Élan élan ÉLAN×÷ élans"), (6, "again again again")]
    counts = counted(rows)
    expected = variants(counts)
    assert len(counts) > 150 and sum(f is not None for f, *_ in expected.values()) > 50
    assert any(expected[w][1] != expected[w][0] for w in expected if expected[w][0])
    assert rows_of(document_variants(frame(spark, rows))) == expected
    assert rows_of(document_variants(frame(spark, rows), typo_rate=None)) == variants(counted(rows, None))
    narrow = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert rows_of(document_variants(narrow)) == expected


@pytest.mark.parametrize("levels", [1, 2, 3, 5])
def test_near_words_at_all_levels(spark, levels):
    rnd = random.Random(7)
    words = {"".join(rnd.choice("ab") for _ in range(rnd.randint(1, 9))) for _ in range(250)} | {"a" * 30, "a" * 31, "b" + "a" * 30, "日本語日本語", "日本語日本"}
    frame_ = spark.createDataFrame([(w, i) for i, w in enumerate(sorted(words))], "word string, n bigint")
    found = [(r.a, r.b) for r in near_words(frame_, levels).collect()]
    assert len(set(found)) == len(found)
    assert all(len(a) > len(b) or (len(a) == len(b) and a < b) for a, b in found)
    assert {frozenset(p) for p in found} == {frozenset((a, b)) for a in words for b in words if edit_one(a, b)}


def test_a_half_word_that_all_words_share_makes_few_candidates(spark):
    """Keys keep bounded buckets where one chunk is in all words."""
    from labelgrain.llm.spelling import _keyed

    words = [f"prefix{a}{b}{c}{d}" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh" for d in "abcdefgh"]
    rows = spark.createDataFrame([(w, 3) for w in words], "word string, n bigint")
    largest = {k: _keyed(rows, [0], k).groupBy("_key").count().agg({"count": "max"}).first()[0] for k in (1, 3)}
    assert largest[1] == len(words) and largest[3] <= 64
    assert near_words(rows).count() == len(words) * 4 * 7 // 2


def test_no_vocabulary_is_broadcast(spark, conf, monkeypatch):
    """However small Spark takes a stored vocabulary to be, keys and words go by shuffles."""
    conf("spark.sql.autoBroadcastJoinThreshold", "1g")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "1g")
    plans = []
    kept = spelling.stored

    def recorded(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df)

    monkeypatch.setattr(spelling, "stored", recorded)
    words = [("".join(w), 3 + i) for i, w in enumerate(itertools.product("abc", repeat=5))]
    found = spelling_variants(spark.createDataFrame(words, "word string, n bigint"))
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in plan for plan in plans) >= 4
    assert not any("Broadcast" in plan for plan in plans)
    assert rows_of(found) == variants(dict(words))


def test_very_long_words_and_empty_tables(spark):
    long = "ab" * 10_000
    rows = [(i, f"{long} {long}a plain") for i in range(3)]
    found = rows_of(document_variants(frame(spark, rows), typo_rate=None))
    assert {len(w): v[2:4] for w, v in found.items()} == {20_000: (3, 1), 20_001: (3, 1), 5: (3, 0)}
    assert rows_of(document_variants(frame(spark, []))) == {}
    assert rows_of(spelling_variants(spark.createDataFrame([], "word string, n bigint"))) == {}
    assert words_of(frame(spark, [(1, None), (2, "")])).count() == 0
    assert vocabulary(words_of(frame(spark, [(1, "twice twice")]), typo_rate=None)).count() == 0


def test_roots_of_chains(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(20)] + [(f"x{i}", "w3") for i in range(50)]
    found = {r.word: r.root for r in roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert found == {w: "w20" for w, _ in chain}


def test_sql_agrees(spark):
    rows = list(enumerate(misspelt(2, 40)))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    sql = con.sql(ORACLES["op11_spelling_variants"])
    found = {dict(zip(sql.columns, r, strict=True))["word"]: r for r in sql.fetchall()}
    assert {w: r[1:] for w, r in found.items()} == rows_of(document_variants(frame(spark, rows)))
