"""Exact, near, byte-string and line duplicates against brute force."""

import hashlib
import re
from collections import defaultdict

import pytest

from labelgrain.llm import suffix_dedup
from labelgrain.llm.components import components
from labelgrain.llm.exact_dedup import exact_groups, keep_first
from labelgrain.llm.jaccard_join import keep_one_of_similar, prefix_length, similar_groups
from labelgrain.llm.line_dedup import FREQUENT, STRETCH, drop_repeated_lines, few_edits, line_groups, repeated_lines
from labelgrain.llm.suffix_dedup import CHUNK, repeat_digests, spans, without_repeats

from corpus import SCHEMA, frame, prose, texts


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, k) for k in range(101, 130)] + [(200, 201), (201, 202), (202, 200), (300, 300), (None, 5)]
    links = [(b, a) if i % 2 else (a, b) for i, (a, b) in enumerate(links)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    nodes = {n for link in links for n in link if None not in link}
    assert found == roots(nodes, [x for x in links if None not in x])
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_exact_groups(spark):
    rows = list(enumerate(texts())) + [(None, "one"), (None, "alone"), (3000, "one"), (3000, "one")]
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    found = exact_groups(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    expected = []
    for norm, ids in groups.items():
        first = min((i for i in ids if i is not None), default=None)
        expected += [(i, first, len(ids), i == first, hashlib.sha256(norm.encode()).hexdigest()) for i in ids]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))
    kept = keep_first(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert kept.count() == len(groups)
    assert exact_groups(frame(spark, [])).count() == 0


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def test_similar_groups(spark):
    rows = list(enumerate(texts(2, 80)))
    sets = {i: shingles(t) for i, t in rows}
    links = [(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) > 0]
    assert len(links) > 50
    expected = roots(sets, links)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(frame(spark, rows)).collect()}
    assert found == {i: (len(s), expected[i]) for i, s in sets.items()}
    kept = keep_one_of_similar(frame(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))


def test_similar_groups_of_a_large_group_of_near_copies(spark):
    """Members that share 0.6 to 0.9 of their words with each other: not all links hold."""
    import random

    rnd = random.Random(5)
    base = prose(rnd, 60).split()
    rows = []
    for i in range(150):
        words = base.copy()
        for k in range(rnd.choice([1, 1, 2])):
            words[rnd.randrange(60)] = f"new{i}x{k}"
        rows.append((i, " ".join(words)))
    sets = {i: shingles(t) for i, t in rows}
    links = [(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    assert 0 < len(links) < 150 * 149 / 2
    expected = roots(sets, links)
    found = {r.doc_id: r.component_id for r in similar_groups(frame(spark, rows)).collect()}
    assert found == expected


def test_similar_groups_edges(spark):
    assert similar_groups(frame(spark, [])).count() == 0
    found = sorted(map(tuple, similar_groups(frame(spark, [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, None)])).collect()), key=repr)
    assert found == [(1, 2, 1), (1, 2, 1), (2, 0, 2), (None, 2, None)]
    assert [prefix_length(n, 75) for n in (1, 2, 4, 100)] == [1, 1, 2, 26]


def removed(rows):
    """Per id the bytes that a smaller id's 50-byte strings cover."""
    found = {}
    for i, t in rows:
        data = (t or "").encode()
        earlier = set()
        for j, u in rows:
            if j < i:
                other = (u or "").encode()
                earlier.update(other[k : k + 50] for k in range(len(other) - 49))
        gone = bytearray(len(data))
        for k in range(len(data) - 49):
            if data[k : k + 50] in earlier:
                gone[k : k + 50] = b"\1" * 50
        found[i] = (data, gone)
    return found


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 2])
def test_repeated_strings(spark, monkeypatch, hot):
    """By pieces, and with the strings of windows that more than two documents hold going alone."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    extra = ["ab" * 400, "ab" * 30 + "c" + "ab" * 30, "é" * 60, "é" * 26 + "e", "x" * 49, "x" * 50, "x" * 51, "\0" * 60, "\0" * 52 + "z" * 50]
    rows = list(enumerate(texts(3, 40) + extra))
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeat_digests(frame(spark, rows)).collect()}
    for i, (data, gone) in removed(rows).items():
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        n_spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        assert found[i] == (len(data), sum(gone), n_spans, hashlib.sha256(kept).hexdigest()), i


def test_suffix_array_is_in_byte_order():
    import numpy as np

    rnd = __import__("random").Random(11)
    data = bytes(rnd.choice(b"\0\1\xff") for _ in range(400))
    order, new = suffix_dedup.suffix_array(np.frombuffer(data * 2, dtype=np.uint8), np.arange(700))
    strings = [(data * 2)[k : k + 50] for k in range(700)]
    assert [strings[k] for k in order] == sorted(strings) and new.sum() == len(set(strings))


def test_repeated_strings_of_a_very_long_text(spark):
    import random

    rnd = random.Random(4)
    long = prose(rnd, 400_000)
    assert len(long) > 5 * CHUNK
    piece = long[5 * CHUNK - 500 : 5 * CHUNK + 500]
    rows = [(1, piece), (2, long), (3, "start " + long[CHUNK - 30 : CHUNK + 40] + " end"), (None, piece), (2, "other")]
    found = {(r.doc_id, len(r.kept)): r.spans for r in without_repeats(frame(spark, rows)).collect()}
    assert found[2, len(long) - 1000] == [(5 * CHUNK - 500, 5 * CHUNK + 500)]
    assert found[3, 10] == [(6, 76)]
    assert found[1, 1000] == [] and found[None, 1000] == [] and found[2, 5] == []


def test_spans_and_empty_table(spark):
    assert spans(200, [(0, 1), (30, 31), (120, 130)]) == [(0, 80), (120, 179)]
    assert repeat_digests(frame(spark, [])).count() == 0


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_lines(spark):
    rnd = __import__("random").Random(7)
    line = prose(rnd, 40)
    close = line.replace(line.split()[3], line.split()[3] + "x", 1)
    rows = [
        (5, f"{line}\n{prose(rnd, 20)}\n!!!\n{line.upper()}!"),
        (2, f"{close}\n\n---"),
        (9, line),
        (1, None),
        (3, ""),
        (None, line),
        (7, prose(rnd, 30)),
    ]
    docs = frame(spark, rows)
    found = {r[0]: (r.n_grouped, r.dropped) for r in repeated_lines(docs).collect()}
    assert found == {2: (1, []), 5: (2, [0, 3]), 9: (1, [0]), None: (1, [0])}
    after = {r.doc_id: r.text for r in drop_repeated_lines(docs).collect()}
    assert after[1] is None and after[3] == "" and after[9] == "" and after[7] == rows[6][1]
    assert after[5].split("\n")[-1] == "!!!"
    assert repeated_lines(frame(spark, [])).count() == 0


def test_rows_of_one_id_keep_what_only_they_hold(spark):
    for same in (None, 5):
        rows = [(same, "a line of boilerplate\nfirst"), (same, "second\nthird"), (1, "a line of boilerplate"), (9, "third")]
        kept = drop_repeated_lines(frame(spark, rows)).select("doc_id", "text").collect()
        assert sorted(map(tuple, kept), key=repr) == sorted([(same, "first"), (same, "second\nthird" if same else "second"), (1, "a line of boilerplate"), (9, "" if same else "third")], key=repr)


def test_linked_lines_are_alike(spark):
    """Every link within a group of two is an edit similarity of 0.8 or more."""
    rnd = __import__("random").Random(8)
    base = [prose(rnd, 50) for _ in range(20)]
    rows = [(i, b) for i, b in enumerate(base)] + [(100 + i, b.replace(b.split()[7], "zz", 1)) for i, b in enumerate(base)]
    text = {hashlib.md5(t.encode()).hexdigest(): t for _, t in rows}
    members = defaultdict(list)
    for r in line_groups(frame(spark, rows)).collect():
        members[r.group.hex()].append(text[r.line.hex()])
    assert len(members) >= 5
    for pair in members.values():
        assert len(pair) == 2 and 1 - levenshtein(*pair) / max(map(len, pair)) >= 0.8


@pytest.mark.parametrize("operator", [exact_groups, similar_groups, repeat_digests, repeated_lines])
def test_extra_columns_do_not_matter(spark, operator):
    rows = list(enumerate(texts(6, 10)))
    wide = frame(spark, rows)
    narrow = wide.select("doc_id", "text")
    assert sorted(map(repr, operator(wide).collect())) == sorted(map(repr, operator(narrow).collect()))
    assert SCHEMA.count(",") == 6


def test_recall_of_alike_lines_by_length(spark):
    """Of lines with a tenth to a quarter of their words changed, nine in ten that are alike by brute force are found, at each length."""
    rnd = __import__("random").Random(9)
    word = lambda: "".join(rnd.choices("etaoinshrdlu", k=rnd.choice([1, 2, 2, 3, 4, 5, 6, 8, 10])))
    made = {}
    for n in (8, 15, 27, 40, 80):
        for _ in range(40):
            line = [word() for _ in range(n)]
            other = line.copy()
            for k in rnd.sample(range(n), max(1, round(n * rnd.choice([0.1, 0.15, 0.2, 0.25])))):
                other[k] = word()
            pair = " ".join(line), " ".join(other)
            if 1 - levenshtein(*pair) / max(map(len, pair)) >= 0.8:
                made.setdefault(n, []).append(pair)
    rows = list(enumerate(t for pairs in made.values() for pair in pairs for t in pair))
    found = {r.line.hex(): r.group.hex() for r in line_groups(frame(spark, rows)).collect()}
    digest = lambda t: hashlib.md5(t.encode()).hexdigest()
    recall = {n: sum(found.get(digest(a), a) == found.get(digest(b), b) for a, b in pairs) / len(pairs) for n, pairs in made.items()}
    print({n: (round(recall[n], 3), len(pairs)) for n, pairs in made.items()})
    assert all(len(pairs) >= 20 for pairs in made.values()) and min(recall.values()) >= 0.9, recall


def test_few_edits_is_the_edit_distance(spark):
    """Pairs that either bound decides, and pairs that neither does: the distance decides as before."""
    rnd = __import__("random").Random(10)
    pairs = [("", ""), ("", "abc"), ("é" * 300, "é" * 299 + "e"), (FREQUENT * 40, FREQUENT * 30), ("x" * STRETCH, "x" * (STRETCH + 1))]
    for n in (1, 3, 12, 40, 90):
        for share in (0, 0.05, 0.2, 0.4, 1):
            line = prose(rnd, n).split()
            other = [prose(rnd, 1) if rnd.random() < share else w for w in line]
            pairs += [(" ".join(line), " ".join(other)), (" ".join(line), " ".join([*other[n // 4 :], *prose(rnd, n // 5).split()])), (" ".join(line), " ".join([*prose(rnd, n // 6).split(), *other]))]
    rows = [(a, b, int(s * max(len(a), len(b)) + 1e-9), levenshtein(a, b)) for a, b in pairs for s in (0, 0.1, 0.2, 0.35)]
    found = spark.createDataFrame(rows, "a string, b string, most int, d int").select("most", "d", few_edits("a", "b", "most").alias("few")).collect()
    assert all(r.few == (r.d <= r.most) for r in found)
    assert 50 < sum(r.few for r in found) < len(found) - 50


def test_lines_leave_no_shuffle_files(spark, monkeypatch):
    """Each stored step of the operator ends without the shuffle files of those before it; the session's option stays as it was."""
    import os
    import time

    from labelgrain.llm import components as of_components
    from labelgrain.llm import line_dedup
    from labelgrain.llm.storage import CLEANUP

    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    files = lambda: {f for top in folders for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}
    left, there = [], files()

    def watched(df, stored=line_dedup.stored):
        out = stored(df)
        end = time.time() + 5
        while files() - there and time.time() < end:
            time.sleep(0.05)
        left.append(len(files() - there))
        return out

    monkeypatch.setattr(line_dedup, "stored", watched)
    monkeypatch.setattr(of_components, "stored", watched)
    rows = list(enumerate(texts(12, 30)))
    assert repeated_lines(frame(spark, rows + [(100 + i, t) for i, t in rows])).count() > 0
    assert len(left) > 6 and not any(left), left
    assert spark.conf.get(CLEANUP, None) is None


def test_keys_of_lines_meet_in_turns(spark, monkeypatch):
    """No step shuffles more than a share of the keys, all turns together have each key once, and the hashes go."""
    from labelgrain.llm import line_dedup

    rows = list(enumerate(texts(13, 30)))
    whole, seen = line_dedup.block_keys, []

    def counted(hashes, *turn):
        keys = whole(hashes, *turn)
        seen.append((sorted(map(tuple, whole(hashes).collect())), sorted(map(tuple, keys.collect()))))
        return keys

    monkeypatch.setattr(line_dedup, "block_keys", counted)
    tables = {t.name for t in spark.catalog.listTables()}
    assert repeated_lines(frame(spark, rows + [(100 + i, t) for i, t in rows])).count() > 0
    everything = seen[0][0]
    assert everything and sorted(k for _, keys in seen for k in keys) == everything
    assert max(len(keys) for _, keys in seen) < 0.35 * len(everything)
    assert not [t.name for t in spark.catalog.listTables() if t.name not in tables and t.name.startswith("hashes_")]
