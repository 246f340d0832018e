"""The registered queries on whole tables: against their SQL where there is one, and by what their contracts promise."""

import os
import re
import zlib

import duckdb
import numpy as np
import pytest

from labelgrain.llm.oracles import ORACLES
from labelgrain.llm.queries import QUERIES

TABLES = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TABLES}/{name}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, TABLES)
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(columns, result.fetchall())


def test_whitening_of_the_table(spark, duck):
    """Counts, exact deviations and the identity, from the table itself."""
    rows = QUERIES["op12_embedding_whitening"](spark, TABLES).toPandas()
    table = duck.execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    x = np.floor(1024 * np.array([v for _, v in table], dtype=float)).astype(object).astype(int) + 100_000
    n, sums = len(x), x.sum(axis=0)
    deviation = {i: int(d) for (i, _), d in zip(table, ((n * x - sums) ** 2).sum(axis=1), strict=True)}
    assert len(rows) == 8 * n and set(rows["component"]) == set(range(1, 9)) and set(rows["n"]) == {n}
    assert all(deviation[i] == d for i, d in zip(rows["vec_id"], rows["deviation"], strict=True))
    wide = rows.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    error = np.abs(np.cov(wide.T, bias=True) - np.eye(8)).max()
    assert error < 1e-9 and rows["identity_error"].nunique() == 1 and rows["identity_error"][0] < 1e-9


def test_fingerprints_of_the_table(spark, duck):
    rows = {r.doc_id: r for r in QUERIES["op13_document_fingerprints"](spark, TABLES).collect()}
    texts = duck.execute("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall()
    assert len(rows) == len(texts)
    import hashlib

    by_text = {}
    for (i, text), (after, following) in zip(texts, texts[1:] + texts[:1], strict=True):
        r, cut = rows[i], len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == rows[after].fingerprint) <= (r.near_next == 1.0)
    far, near = ([getattr(r, k) for r in rows.values()] for k in ("near_next", "near_edited"))
    assert np.mean(near) > 0.5 > 0.3 > np.mean(far)


def test_words_of_the_table_are_those_of_plain_counting(spark, duck):
    """Counts of ``op11`` with a counter over runs."""
    counts = {}
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, text in duck.execute("SELECT doc_id, text FROM documents").fetchall():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(upper)
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    found = {r.word: r.n for r in QUERIES["op11_spelling_variants"](spark, TABLES).collect()}
    assert found == {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
