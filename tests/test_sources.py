import random

import pytest
from pyspark.sql import functions as F

from labelgrain.fixed_values import GRADED_COLUMNS
from labelgrain.operators import categories
from labelgrain.sources import readers, sinks
from labelgrain.sources.lines import read_lines
from labelgrain.sources.quoted import read_quoted_records

HEADER = "-----\nnotice\twith\ttabs\n\n=====\n"


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode("utf-8"))
    return str(path)


def rows(df, *cols):
    return [tuple(r) for r in df.orderBy("row_no").select(*cols).collect()]


@pytest.mark.parametrize("split_bytes", ["64", "1000", "100000"])
def test_row_numbers_are_dense_in_file_order(spark, tmp_path, conf, split_bytes):
    conf("spark.sql.files.maxPartitionBytes", split_bytes)
    conf("spark.sql.files.openCostInBytes", "1")
    expected = []
    for f in range(3):
        lines = [f"{f}:{i} {'x' * (i * 7 % 23)}" for i in range(40 * f + 5)]
        ends = ["\n", "\r\n", "\r"]
        put(tmp_path, f"part-{f}.txt", HEADER + "".join(l + ends[i % 3] for i, l in enumerate(lines)))
        expected += lines
    put(tmp_path, "part-0a.txt", "only\ntwo lines\n")
    put(tmp_path, "part-0b.txt", "")
    got = read_lines(spark, str(tmp_path), 4)
    assert got.rdd.getNumPartitions() > 1 or split_bytes == "100000"
    assert rows(got, "row_no", "value") == list(enumerate(expected))


def test_graded_edge_rows(spark, tmp_path):
    body = "".join([
        "01\ta1\thomeless\tgb\tsome text\t0\n",
        "2\ta2\tpoor\tus\ttext two\t1\t  \t\n",
        " 3\ta3\tkw\tie\t\"open quote\t2\r\n",
        "4\ta4\tkw\tie\ta \"quoted\" word\t3\n",
        "5\ta5\tkw\tie\t\t4\n",
        "6\ta6\tkw\tie\tlast field is text\n",
        "7\ta7\tkw\tie\ttext\t5\n",
    ])
    path = put(tmp_path, "g.tsv", HEADER + body)
    got = rows(readers.read_graded(spark, path), *GRADED_COLUMNS, "orig_label")
    assert got == [
        ("01", "a1", "homeless", "gb", "some text", 0, "0"),
        ("2", "a2", "poor", "us", "text two", 0, "1"),
        ("3", "a3", "kw", "ie", '"open quote', 1, "2"),
        ("4", "a4", "kw", "ie", 'a "quoted" word', 1, "3"),
        ("5", "a5", "kw", "ie", "", 1, "4"),
        ("6", "a6", "kw", "ie", "last field is text", 1, "last field is text"),
        ("7", "a7", "kw", "ie", "text", 1, "5"),
    ]
    with pytest.raises(Exception, match="unknown grade"):
        readers.read_graded(spark, path, strict_labels=True).collect()


def test_short_graded_rows_raise_or_are_listed(spark, tmp_path):
    path = put(tmp_path, "g.tsv", HEADER + "1\ta\tk\tc\tt\t0\n2\ta\tk\n3\ta\tk\tc\tt\t4\n")
    with pytest.raises(Exception, match="fewer than 5 fields, row 1"):
        readers.read_graded(spark, path).count()
    good = readers.read_graded(spark, path, on_bad="drop")
    assert rows(good, "row_no", "par_id", "label") == [(0, "1", 0), (2, "3", 1)]
    assert rows(readers.rejected_lines(spark, path), "row_no", "value", "fields") == [(1, "2\ta\tk", 3)]


def test_header_is_dropped_per_file(spark, tmp_path):
    for name in ("a.tsv", "b.tsv"):
        put(tmp_path, name, HEADER + f"{name}\ta\tk\tc\tt\t0\n")
    assert rows(readers.read_graded(spark, str(tmp_path)), "row_no", "par_id") == [(0, "a.tsv"), (1, "b.tsv")]


def test_quoted_mode_merges_lines(spark, tmp_path):
    body = '1\ta\tk\tc\tplain\t0\n2\ta\tk\tc\t"tab\tand\nline"\t3\n3\ta\tk\tc\tsays ""x""\t1\n'
    path = put(tmp_path, "g.tsv", HEADER + body)
    got = rows(readers.read_graded(spark, path, quoted=True), "row_no", "par_id", "text", "label")
    assert got == [(0, "1", "plain", 0), (1, "2", "tab\tand\nline", 1), (2, "3", 'says ""x""', 0)]
    put(tmp_path, "h.tsv", HEADER + body)
    both = readers.read_graded(spark, str(tmp_path), quoted=True)
    assert rows(both, "row_no", "par_id") == list(enumerate("123123"))
    swallowed = put(tmp_path / "open", "g.tsv", HEADER + '1\ta\tk\tc\t"never closed\t0\n2\ta\tk\tc\tt\t1\n')
    assert readers.read_graded(spark, swallowed, quoted=True).count() == 1
    assert readers.read_graded(spark, swallowed).count() == 2


def as_csv(spark, path):
    """One file by the reader that gives it to one task."""
    reader = spark.read.schema("a string, b string, c string").options(sep="\t", quote='"', escape='"', multiLine=True)
    return [tuple(r) for r in reader.csv(path).coalesce(1).collect()]


def as_records(spark, path, **options):
    fields = F.from_csv("value", "a string, b string, c string", {"sep": "\t", "quote": '"', "escape": '"', "multiLine": "true"})
    found = read_quoted_records(spark, path, **options).select("row_no", fields.alias("f")).orderBy("row_no").collect()
    assert [r.row_no for r in found] == list(range(len(found)))
    return [tuple(r.f) for r in found]


@pytest.mark.parametrize(("chunk_lines", "end"), [(1, "\n"), (3, "\r\n"), (1000, "\n")])
def test_quoted_records_equal_the_csv_reader(spark, tmp_path, chunk_lines, end):
    rnd = random.Random(chunk_lines)
    pieces = ["a", "b ", '"', "\t", "\n", '""', '"x\ny"\t', '"p\tq"\n', 'z"z', '"\t', '"\n', "\n\n"]
    for k in range(2):
        # a field left open keeps no line end at the end of the file
        text = "".join(rnd.choice(pieces) for _ in range(300)).strip("\n").replace("\n", end)
        (tmp_path / str(k)).mkdir()
        (tmp_path / str(k) / "f.tsv").write_bytes(text.encode())
        path = str(tmp_path / str(k) / "f.tsv")
        assert as_records(spark, path, chunk_lines=chunk_lines) == as_csv(spark, path)


def test_quoted_file_is_read_by_many_tasks(spark, tmp_path, conf):
    """Records go over line ends at the borders of splits and of chunks."""
    lines = [f'{i}\t"{"word " * (i % 9)}{chr(10) * (i % 4)}""x"""\t{i % 5}' for i in range(3000)]
    path = put(tmp_path, "q.tsv", "\n".join(lines) + "\n")
    conf("spark.sql.files.maxPartitionBytes", "8k")
    conf("spark.sql.files.openCostInBytes", "1k")
    assert spark.read.text(path).rdd.getNumPartitions() > 8
    assert as_records(spark, path, chunk_lines=100) == as_csv(spark, path)
    long = put(tmp_path / "long", "q.tsv", 'a\t"' + 'long ""text"" ' * 50_000 + '"\tc\n' + "p" * 200_000 + "\tq\tr\n")
    assert [tuple(map(len, r)) for r in as_records(spark, long)] == [(1, 600_000, 1), (200_000, 1, 1)]
    assert as_records(spark, put(tmp_path / "none", "q.tsv", "")) == []
    assert as_records(spark, put(tmp_path / "blank", "q.tsv", "\n\n\n")) == []


def test_block_counts_are_kept(spark, tmp_path, monkeypatch):
    """A second read of the same files counts nothing; changed files are counted again."""
    import labelgrain.sources.lines as module

    counted = []
    plain = module._block_starts
    monkeypatch.setattr(module, "_block_starts", lambda *a: counted.append(1) or plain(*a))
    for name in "ba":
        put(tmp_path / "in", f"{name}.txt", "".join(f"{name}{i}\n" for i in range(50)))
    index, path = str(tmp_path / "index"), str(tmp_path / "in")
    expected = rows(read_lines(spark, path, 2), "row_no", "value")

    def scans(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [value")

    first = read_lines(spark, path, 2, index)
    kept = sorted((tmp_path / "index").iterdir())
    again = read_lines(spark, path, 2, index)
    assert rows(first, "row_no", "value") == rows(again, "row_no", "value") == expected
    assert len(kept) == 1 and sorted((tmp_path / "index").iterdir()) == kept
    assert scans(read_lines(spark, path, 2)) == 2 and scans(first) == scans(again) == 1
    put(tmp_path / "in", "a.txt", "".join(f"new {i}\n" for i in range(70)))
    assert rows(read_lines(spark, path, 2, index), "row_no", "value") == rows(read_lines(spark, path, 2), "row_no", "value")
    assert len(list((tmp_path / "index").iterdir())) == 2


def test_metrics_are_recorded_once(spark, tmp_path):
    """Two writes of the same epoch leave one row, and others stay."""
    path, schema = str(tmp_path / "log"), "run string, epoch int, f1 double"
    assert sinks.recorded_metrics(spark, path, schema) is None
    for row in [("a", 1, 0.1), ("a", 2, 0.2), ("b", 1, 0.3), ("a", 2, 0.25), (None, 1, 0.4), ("a", 1, 0.1)]:
        sinks.record_metrics(spark.createDataFrame([row], schema), path, ["run", "epoch"])
    found = sinks.recorded_metrics(spark, path, schema).select("run", "epoch", "f1").collect()
    assert sorted(map(tuple, found), key=repr) == sorted([("a", 1, 0.1), ("a", 2, 0.25), ("b", 1, 0.3), (None, 1, 0.4)], key=repr)


def test_annotations_make_the_fields_of_a_line_once(spark, tmp_path):
    """White space of all kinds at either end, and a plan that neither strips nor cuts a line twice."""
    fields = ["1", "@a", "text", "kw", "us", "0", "4", "sp an", "tag", "2"]
    lines = ["\t".join(fields), " \t" + "\t".join(fields), "\t".join(fields) + "\t\u2003", "\u00a0" + "\t".join(fields) + "\x1c", "\t".join(["1", "@a", "", "", "", "", "", "", "tag", " 2 "])]
    path = str(tmp_path / "padded.tsv")
    (tmp_path / "padded.tsv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    back = readers.read_annotations(spark, path, header_lines=0)
    names = [c for c in back.columns if c != "row_no"]
    expected = []
    for line in lines:
        p, q = line.strip().split("\t"), line.split("\t")
        expected.append((p[0], p[1], *q[2:8], p[-2], p[-1]))
    assert [tuple(r) for r in back.orderBy("row_no").select(*names).collect()] == expected
    plan = back._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("trim(") == 1 and plan.count("split(") == 2 and "translate(" not in plan


def test_annotations_mix_stripped_and_raw_fields(spark, tmp_path):
    line = " 9\ta\t text \tkw\tgb\t0\t4\tspan\tCompassion\t2\t \n"
    path = put(tmp_path, "c.tsv", HEADER + line)
    got = rows(readers.read_annotations(spark, path), "par_id", "text", "keyword", "text_span", "label", "num_annotators")
    assert got == [("9", " text ", "kw", "span", "Compassion", "2")]
    bad = put(tmp_path / "bad", "c.tsv", HEADER + "1\ta\tt\n")
    with pytest.raises(Exception, match="too few fields"):
        readers.read_annotations(spark, bad).collect()


def test_category_lists_from_a_file(spark, tmp_path):
    def line(par, country, tag):
        return f"{par}\ta\ttext\tkw\t{country}\t0\t4\tspan\t{tag}\t1\n"

    body = line(1, "gb", "Compassion") + line(1, "gb", "Metaphors") + line(1, "us", "Metaphors") + line(1, "gb", "Compassion")
    path = put(tmp_path, "c.tsv", HEADER + body)
    keys = ["par_id", "art_id", "text", "keyword", "country"]
    notes = readers.read_annotations(spark, path)
    lists = categories.category_lists(notes, keys, "label")
    assert rows(lists, "country", "ids") == [("gb", [5, 4]), ("us", [4])]
    seen = [categories.binarise(lists, "ids", c) for c in ("seen", categories.seen_ids(notes, "label"), [4, 5])]
    for vectors in seen:
        assert rows(vectors, "vector") == [([1, 1],), ([1, 0],)]
    assert rows(categories.binarise(lists, "ids", "all"), "vector") == [([0, 0, 0, 0, 1, 1, 0],), ([0, 0, 0, 0, 1, 0, 0],)]
    wrong = put(tmp_path / "wrong", "c.tsv", HEADER + line(1, "gb", "Unheard"))
    with pytest.raises(Exception, match="unknown tag: Unheard"):
        categories.category_lists(readers.read_annotations(spark, wrong), keys, "label").collect()


def test_unlabelled(spark, tmp_path):
    path = put(tmp_path, "t.tsv", "t_0\ta\tkw\tgb\ttext\nt_1\ta\tkw\tgb\n")
    got = rows(readers.read_unlabelled(spark, path), "row_no", "par_id", "text")
    assert got == [(0, "t_0", "text"), (1, "t_1", None)]
    long = put(tmp_path / "long", "t.tsv", "1\t2\t3\t4\t5\t6\n")
    with pytest.raises(Exception, match="more than 5 fields"):
        readers.read_unlabelled(spark, long).collect()


def test_split_list(spark, tmp_path):
    path = put(tmp_path, "s.csv", 'par_id,label\n 007 ,"[0, 1, 0]"\n3,"[1, 1]"\n007,"[0]"\n')
    assert rows(readers.read_split(spark, path), "row_no", "par_id", "label") == [
        (0, "007", "[0, 1, 0]"), (1, "3", "[1, 1]"), (2, "007", "[0]"),
    ]


def test_label_lines(spark, tmp_path):
    path = put(tmp_path, "l.txt", "1\n 0 \n1")
    assert rows(readers.read_label_lines(spark, path), "row_no", "label") == [(0, 1), (1, 0), (2, 1)]
    for i, bad in enumerate(("1\n\n0\n", "x\n", "1.5\n")):
        with pytest.raises(Exception, match="not an int"):
            readers.read_label_lines(spark, put(tmp_path, f"bad{i}.txt", bad)).collect()


def test_label_and_vector_files_round_trip(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").alias("row_no"), (F.col("id") % 3).cast("int").alias("label")).repartition(7)
    sinks.write_label_lines(df, str(tmp_path / "labels"))
    back = readers.read_label_lines(spark, str(tmp_path / "labels"))
    assert rows(back, "row_no", "label") == [(i, i % 3) for i in range(1000)]
    vectors = df.withColumn("vector", F.array("label", F.lit(1)))
    sinks.write_vector_lines(vectors, str(tmp_path / "vectors"))
    back = readers.read_vector_lines(spark, str(tmp_path / "vectors"), 2)
    assert rows(back, "row_no", "vector") == [(i, [i % 3, 1]) for i in range(1000)]


def test_part_files_go_by_their_numbers(spark, tmp_path):
    for folder in ("a", "b"):
        for number in (9, 10000, 10001, 100000):
            put(tmp_path / "in" / folder, f"part-{number:05d}-x.txt", f"{folder}{number}\n")
    got = read_lines(spark, [str(tmp_path / "in" / f) for f in "ba"])
    assert rows(got, "row_no", "value") == [(i, v) for i, v in enumerate(f"{f}{n}" for f in "ab" for n in (9, 10000, 10001, 100000))]


def test_block_table_has_no_paths(spark, tmp_path):
    put(tmp_path / "in", "one.txt", "1\n2\n")
    text = read_lines(spark, str(tmp_path / "in"))._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in text.splitlines() if "Join" in line]
    assert joins and all("BroadcastHashJoin [task" in line for line in joins)


def test_probabilities(spark, tmp_path):
    path = str(tmp_path / "probs")
    assert readers.read_probs(spark, path) is None
    sinks.write_probs(spark.createDataFrame([(0, 0.25), (1, 0.12)], "row_no bigint, prob double"), path)
    back = readers.read_probs(spark, path)
    assert back.schema["prob"].dataType.simpleString() == "float"
    assert rows(back, F.col("prob").cast("double"))[0] == (0.25,)


def test_available_tasks(spark, tmp_path):
    put(tmp_path / "one", "task1.txt", "1\n")
    assert list(readers.available_tasks(spark, str(tmp_path / "one"))) == ["task1"]
    sinks.write_label_lines(spark.createDataFrame([(0, 1)], "row_no int, label int"), str(tmp_path / "one" / "task2.txt"))
    assert sorted(readers.available_tasks(spark, str(tmp_path / "one"))) == ["task1", "task2"]
    put(tmp_path / "none", "other.txt", "1\n")
    put(tmp_path / "none" / "old", "task1.txt", "1\n")
    put(tmp_path / "task2.txt" / "none", "other.txt", "1\n")
    assert readers.available_tasks(spark, str(tmp_path / "task2.txt" / "none")) == {}
    assert readers.available_tasks(spark, str(tmp_path / "none")) == {}


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_metrics_are_appended(spark, tmp_path, file_format):
    path = str(tmp_path / "log")
    for epoch in (1, 2):
        sinks.append_metrics(spark.createDataFrame([(epoch, 0.5)], "epoch int, f1 double"), path, file_format)
    reader = spark.read.schema("epoch int, f1 double").option("header", True)
    assert sorted(tuple(r) for r in reader.format(file_format).load(path).collect()) == [(1, 0.5), (2, 0.5)]
