"""The operators as queries over the given tables.

The corpus is ``documents`` joined with ``labels``; grades, scores and category
bits are derived from the ids with integer arithmetic, so that another engine
can check every figure.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelgrain.fixed_values import GRADED_COLUMNS, TAG_IDS, TASK_FILES, VECTOR_NAMES
from labelgrain.functions import labels as L
from labelgrain.functions import numbers as N
from labelgrain.functions import text as T
from labelgrain.operators import categories, classify, curves, errors, explore, focal, metrics, sentences, splits, trials
from labelgrain.operators.shared import shared_folder, shuffles_removed, stored
from labelgrain.plans.score_files import named_binary_scores, score_submission
from labelgrain.sources import readers, sinks

WIDTH = len(VECTOR_NAMES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with grade, score and decision."""
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    milli = F.col("toxic") * 300 + (F.col("doc_id") * 7919) % 700
    graded = joined.select(
        "doc_id", F.col("source").alias("keyword"), F.col("lang").alias("country"), "text", "toxic",
        (F.col("toxic") * 2 + F.col("quality")).cast("string").alias("orig_label"),
        milli.cast("int").alias("score_milli"),
    )
    scored = graded.withColumn("label", L.collapse_grade(F.col("orig_label"))).withColumn(
        "score", (F.col("score_milli") / 1000).cast("float")
    )
    return scored.withColumn("pred", N.decide(F.col("score"), 0.5))


def bits(key: str, times: int = 1):
    """Seven bits of an id as a 0/1 vector."""
    number = F.col(key) * times
    return F.array(*[F.shiftright(number, k).bitwiseAND(F.lit(1)).cast("int") for k in range(WIDTH)])


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", bits("doc_id").alias("gold"), bits("doc_id", 31).alias("guess"))


def annotations(spark: SparkSession, sf_dir: str, in_order: bool = False) -> DataFrame:
    """One row per set bit, in an order that depends on the id, and each twice.

    ``in_order`` puts texts on one line and sorts documents before rows multiply,
    so that each text moves once; row numbers rise with the ids.
    """
    docs = table(spark, sf_dir, "documents")
    if in_order:
        docs = docs.withColumn("text", T.strip(_one_line(F.col("text")))).orderBy("doc_id")
    names = F.array(*[F.lit(t) for t in sorted(TAG_IDS, key=TAG_IDS.get)])
    places = F.sequence(F.lit(0), F.lit(2 * WIDTH - 1))
    rows = docs.select("doc_id", "text", F.col("source").alias("keyword"), F.col("lang").alias("country"),
                       "n_chars", F.explode(places).alias("place"))
    tag = ((F.col("place") * 5 + F.col("doc_id")) % WIDTH).cast("int")
    chosen = rows.where(F.call_function("shiftright", F.col("doc_id"), tag).bitwiseAND(F.lit(1)) == 1)
    return chosen.select(
        F.col("doc_id").cast("string").alias("par_id"), F.col("n_chars").cast("string").alias("art_id"),
        "text", "keyword", "country", F.get(names, tag).alias("tag"),
        (F.col("doc_id") * 16 + F.col("place")).alias("row_no"),
    )


def keyword_metrics(spark, sf_dir):
    return metrics.group_metrics(corpus(spark, sf_dir), "keyword", "label", "pred")


def binary_scores(spark, sf_dir):
    return metrics.binary_scores(corpus(spark, sf_dir), "label", "pred")


def country_scores(spark, sf_dir):
    return metrics.binary_scores(corpus(spark, sf_dir), "label", "pred", ["country"])


def multilabel_scores(spark, sf_dir):
    return metrics.multilabel_scores(vectors(spark, sf_dir), "gold", "guess")


def classification_report(spark, sf_dir):
    return metrics.classification_report(corpus(spark, sf_dir), "label", "pred")


def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(corpus(spark, sf_dir), "label", "pred")


def length_bin_errors(spark, sf_dir):
    counted = corpus(spark, sf_dir).withColumn("tokens", T.ws_token_count(F.col("text")))
    return metrics.length_bin_errors(counted, "tokens", "label", "pred")


def error_breakdown(spark, sf_dir):
    return errors.error_breakdown(corpus(spark, sf_dir), "keyword", "label", "pred")


def error_totals(spark, sf_dir):
    return errors.error_totals(corpus(spark, sf_dir), "label", "pred")


def error_sample(spark, sf_dir):
    return errors.error_sample(corpus(spark, sf_dir), "doc_id", "label", "pred", "text", ["keyword"], n=8)


def label_collapse(spark, sf_dir):
    rows = corpus(spark, sf_dir)
    return rows.select("doc_id", "orig_label", "label", L.format_vector(L.as_vector(F.col("label"))).alias("vector"))


def numeric_collapse(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    grade = F.col("toxic") * 2 + F.col("quality")
    return docs.select("doc_id", grade.alias("grade"), L.collapse_number(grade).alias("label"))


def vote_labels(spark, sf_dir):
    votes = vectors(spark, sf_dir).select(
        "doc_id", F.concat(F.lit("["), F.array_join(F.transform("gold", lambda b: b.cast("string")), ", "), F.lit("]")).alias("votes")
    )
    return votes.withColumn("label", L.vote_label(F.col("votes")))


def _category_lists(spark, sf_dir):
    keys = ["par_id", "art_id", "text", "keyword", "country"]
    return categories.category_lists(annotations(spark, sf_dir), keys, "tag")


def category_lists(spark, sf_dir):
    lists = _category_lists(spark, sf_dir)
    return lists.select("par_id", "art_id", "keyword", "country", "row_no", L.format_vector(F.col("ids")).alias("ids"))


def category_vectors(spark, sf_dir):
    lists = _category_lists(spark, sf_dir)
    seen = categories.seen_ids(annotations(spark, sf_dir), "tag")
    both = categories.binarise(lists, "ids", seen, "seen")
    both = categories.binarise(both, "ids", "all", "all")
    return both.select("par_id", L.format_vector(F.col("seen")).alias("seen"), L.format_vector(F.col("all")).alias("all"))


def pr_curve(spark, sf_dir):
    return curves.pr_curve(corpus(spark, sf_dir), "score", "label")


def average_precision(spark, sf_dir):
    area = curves.average_precision(pr_curve(spark, sf_dir))
    return area.select(F.round("average_precision", 9).alias("average_precision"))


def operating_point(spark, sf_dir):
    return curves.operating_point(pr_curve(spark, sf_dir))


def threshold_sweep(spark, sf_dir):
    return curves.threshold_sweep(corpus(spark, sf_dir), "score", "label")


def best_threshold(spark, sf_dir):
    return curves.best_threshold(threshold_sweep(spark, sf_dir))


def dataset_loss(spark, sf_dir):
    rows = corpus(spark, sf_dir)
    weights = splits.class_weights(rows, "label")
    logit0, logit1 = (1000 - F.col("score_milli")) / 500, F.col("score_milli") / 500
    with_prob = rows.withColumn("prob", N.positive_probability(logit0, logit1))
    loss = metrics.dataset_loss(with_prob, "prob", "label", weights)
    return loss.select(F.round("loss", 6).alias("loss"), "n")


def dataset_loss_extreme(spark, sf_dir):
    """Logits so far apart that most probabilities are 0 or 1 in double precision."""
    rows = corpus(spark, sf_dir).withColumn("margin", (2 * F.col("score_milli") - 1000).cast("double"))
    loss = metrics.dataset_loss(rows, "margin", "label", splits.class_weights(rows, "label"), log_odds=True)
    return loss.select(F.round("loss", 6).alias("loss"), "n")


def class_weights(spark, sf_dir):
    return splits.class_weights(corpus(spark, sf_dir), "label")


def class_distribution(spark, sf_dir):
    return explore.class_distribution(corpus(spark, sf_dir), "label")


def class_counts(spark, sf_dir):
    return explore.class_counts(table(spark, sf_dir, "documents"), "lang")


def _rounded_stats(stats):
    return stats.select("scope", "n", F.round("mean", 6).alias("mean"), "max", F.round("percentile", 6).alias("percentile"))


def token_stats(spark, sf_dir):
    counted = corpus(spark, sf_dir).withColumn("tokens", T.ws_token_count(F.col("text")))
    return _rounded_stats(explore.token_stats(counted, "tokens", "label"))


def token_percentiles(spark, sf_dir):
    """As ``token_stats``, with the percentile found in rounds of range counts."""
    counted = corpus(spark, sf_dir).withColumn("tokens", T.ws_token_count(F.col("text")))
    return _rounded_stats(explore.token_stats(counted, "tokens", "label", in_rounds=True))


def word_token_stats(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("tokens", F.size(T.word_tokens(T.coerce_null(F.col("text"), "nan"))))
    return _rounded_stats(explore.token_stats(docs, "tokens", "lang"))


def null_text_stats(spark, sf_dir):
    """Words of all documents, of which those without a label have no text; null texts count as the word they are read as."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    texts = docs.select("lang", F.when(F.col("quality").isNotNull(), F.col("text")).alias("text"))
    counted = texts.withColumns({"tokens": T.ws_token_count(T.coerce_null(F.col("text"), "nan")), "known": F.col("text").isNotNull()})
    skipped = T.ws_token_count(T.coerce_null(F.col("text"), "skip"))
    return counted.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("known")).alias("n_null"),
        F.sum("tokens").alias("tokens"), F.sum(skipped).cast("bigint").alias("tokens_skipping"),
    )


def token_histogram(spark, sf_dir):
    counted = corpus(spark, sf_dir).withColumn("tokens", T.ws_token_count(F.col("text")))
    bars = explore.histogram(counted, "tokens", "label")
    return bars.select("label", "bin", F.round("bin_from", 6).alias("bin_from"), F.round("bin_to", 6).alias("bin_to"), "n")


def top_ngrams(spark, sf_dir):
    return explore.top_ngrams(corpus(spark, sf_dir), "text", "label", k=15, tokeniser="letters")


def frequent_ngrams(spark, sf_dir):
    """As ``top_ngrams``, but only n-grams that can be among the first are counted one by one."""
    return explore.top_ngrams(corpus(spark, sf_dir), "text", "label", k=15, tokeniser="letters", counters=explore.COUNTERS)


def top_ngrams_by_role(spark, sf_dir):
    return explore.top_ngrams(table(spark, sf_dir, "conversations"), "text", "role", k=15, tokeniser="letters")


def top_word_ngrams(spark, sf_dir):
    """Full word tokeniser, equal counts ranked by first appearance."""
    return explore.top_ngrams(corpus(spark, sf_dir), "text", "label", k=15, order_col="doc_id")


def _token_rows(spark, sf_dir):
    return sentences.token_rows(table(spark, sf_dir, "documents"), "text", ("doc_id",))


def abbreviation_statistics(spark, sf_dir):
    """How often every word of the documents has a full stop, and how much of an abbreviation that makes it."""
    found = sentences.abbreviation_statistics(_token_rows(spark, sf_dir))
    return found.withColumn("score", F.round("score", 3))


def collocation_statistics(spark, sf_dir):
    """Pairs of words across a full stop, and how far they are from chance."""
    found = sentences.collocation_statistics(_token_rows(spark, sf_dir))
    return found.withColumn("score", F.round("score", 3))


def sentence_counts(spark, sf_dir):
    """Sentences per document, with abbreviations and collocations learned from all documents."""
    tokens = _token_rows(spark, sf_dir)
    counts = sentences.pair_counts(tokens)
    short = sentences.abbreviations(sentences.abbreviation_statistics(counts))
    pairs = sentences.collocation_statistics(counts).where(F.col("score") >= sentences.COLLOCATION_SCORE)
    ends = sentences.sentence_ends(tokens, short, pairs, ("doc_id",))
    return ends.groupBy("doc_id").agg(F.count("*").alias("n_sentences"))


def train_split(spark, sf_dir):
    """Rows of the corpus whose id is in the split list, with their classes."""
    ids = table(spark, sf_dir, "labels").select(L.normalise_key(F.col("doc_id")).alias("par_id"))
    docs = table(spark, sf_dir, "documents").select(
        L.normalise_key(F.col("doc_id")).alias("par_id"),
        L.collapse_number(F.col("doc_id") % 5).alias("label"),
    )
    return splits.split_summary(splits.keep_split(docs, ids, "par_id"), "label")


def dev_split(spark, sf_dir):
    """The split list in list order with its vote label and the text's length."""
    ids = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("row_no"), L.normalise_key(F.col("doc_id")).alias("par_id"), F.col("toxic").alias("vote_label")
    )
    docs = table(spark, sf_dir, "documents").select(
        L.normalise_key(F.col("doc_id")).alias("par_id"), "text", F.lit(-1).alias("label")
    )
    dev = splits.replace_label(splits.attach_in_order(ids, docs, "par_id"), "label", "vote_label")
    return dev.select("row_no", "par_id", "label", F.length("text").cast("bigint").alias("chars"))


def preview_rows(spark, sf_dir):
    return explore.preview(dev_split(spark, sf_dir))


def scored_rows(spark, sf_dir):
    rows = corpus(spark, sf_dir)
    gold = rows.select(F.col("doc_id").alias("row_no"), "label")
    guess = rows.select(F.col("doc_id").alias("row_no"), "pred")
    paired = splits.align(gold, guess)
    kind = N.error_type(F.col("pred"), F.col("label"))
    return paired.select("row_no", "label", "pred", N.correct(F.col("pred"), F.col("label")).alias("correct"), kind.alias("err_type"))


def hash_baseline(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", L.format_vector(L.hash_bits(F.col("doc_id"), 1)).alias("one"),
        L.format_vector(L.hash_bits(F.col("doc_id"), WIDTH)).alias("seven"),
    )


def truncated_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = T.truncate_tokens(T.ws_tokens(F.col("text")))
    return docs.select("doc_id", F.size(kept).alias("tokens"), F.md5(F.array_join(kept, " ")).alias("digest"))


def report_lines(spark, sf_dir):
    scores = named_binary_scores(binary_scores(spark, sf_dir))
    return scores.select(
        "line", "name", N.fixed_point(F.col("value"), 4).alias("short"),
        N.fixed_point(100 * F.col("value"), 1, "%").alias("pct"),
    )


def fixed_point_ties(spark, sf_dir):
    """Ids as sixteenths and thirty-seconds, many of them ties, with few decimals; and hundredths, which only look like ties."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    texts = {
        f"{name}_{digits}": N.fixed_point((F.col("doc_id") + add) / F.lit(by), digits)
        for name, by, add in (("of16", 16.0, 0), ("of32", 32.0, 0), ("of100", 100.0, 0.05))
        for digits in (1, 3, 4)
    }
    return docs.select("doc_id", *[c.alias(n) for n, c in texts.items()])


def score_file_lines(spark, sf_dir):
    scores = named_binary_scores(binary_scores(spark, sf_dir))
    return sinks.score_lines(scores)


def _trial_log(spark, sf_dir):
    """A log with one run per country and one epoch per keyword of the corpus."""
    rows = corpus(spark, sf_dir).withColumn("epoch", F.substring("keyword", 4, 9).cast("int"))
    keys = ["country", "epoch"]
    best = curves.best_threshold(curves.threshold_sweep(rows, "score", "label", keys), keys)
    return best.withColumnRenamed("f1", "best_tuned_f1")


def best_trial(spark, sf_dir):
    return trials.best_trial(_trial_log(spark, sf_dir), "country")


def best_so_far(spark, sf_dir):
    return trials.best_so_far(_trial_log(spark, sf_dir), "country")


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _one_line(column):
    return F.regexp_replace(column, r"[ \t\r\n\x0b\f]+", " ")


def _under_headers(ordered: DataFrame, line) -> DataFrame:
    """Lines in the order given, four header lines before the first of each part file."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    head = F.lit("about\tthis\n\nfile\nheader\n")
    return ordered.select(F.when(place == 0, F.concat(head, line)).otherwise(line).alias("value"))


def graded_file(spark, sf_dir):
    """Documents written as graded TSV files with headers and read back."""
    rows = corpus(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("par_id"), F.lit("@art").alias("art_id"), "keyword", "country",
        T.strip(_one_line(F.col("text"))).alias("text"), F.col("orig_label").alias("label"), "doc_id",
    )
    path = _scratch(spark, "graded")
    line = F.concat_ws("\t", *GRADED_COLUMNS)
    _under_headers(rows.orderBy("doc_id"), line).write.text(path)
    back = readers.read_graded(spark, path)
    return back.select("row_no", "par_id", "art_id", "keyword", "country", F.md5("text").alias("text"), "label", "orig_label")


def quoted_file(spark, sf_dir):
    """Documents written as a quoted TSV file, texts with their tabs, quotes and line breaks, and read back."""
    text = F.concat(F.lit('say "'), F.col("text"), F.lit('"\t.'))
    rows = corpus(spark, sf_dir).withColumns({"doc": F.col("doc_id").cast("string"), "quoted": F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))})
    line = F.concat_ws("\t", "doc", F.lit("@art"), "keyword", "country", "quoted", "orig_label")
    path = _scratch(spark, "quoted")
    _under_headers(rows.orderBy("doc_id"), line).write.text(path)
    back = readers.read_graded(spark, path, quoted=True)
    return back.select("row_no", "par_id", "art_id", "keyword", "country", F.md5("text").alias("text"), "label", "orig_label")


def annotation_file(spark, sf_dir):
    """Annotations written as a ten-field TSV file, read back and grouped.

    The file has each text once for every tag, one line after the other, and is
    packed, so that copies near each other take hardly any disk.
    """
    rows = annotations(spark, sf_dir, in_order=True)
    line = F.concat_ws(
        "\t", "par_id", "art_id", "text", "keyword", "country", F.lit("0"), F.lit("4"), F.lit("span"), "tag", F.lit("2")
    )
    path = _scratch(spark, "annotations")
    with shuffles_removed(spark):
        _under_headers(rows, line).write.text(path, compression="lz4")
    back = readers.read_annotations(spark, path)
    keys = ["par_id", "art_id", "text", "keyword", "country"]
    lists = categories.category_lists(back, keys, "label")
    return lists.select("row_no", "par_id", "keyword", F.md5("text").alias("text"), L.format_vector(F.col("ids")).alias("ids"))


def unlabelled_file(spark, sf_dir):
    """Documents written without labels, each with a second line that lacks the text field."""
    docs = table(spark, sf_dir, "documents").orderBy("doc_id")
    fields = [F.col("doc_id").cast("string"), F.lit("@art"), F.col("source"), F.col("lang")]
    lines = F.array(F.concat_ws("\t", *fields, T.strip(_one_line(F.col("text")))), F.concat_ws("\t", *fields))
    path = _scratch(spark, "unlabelled")
    docs.select(F.explode(lines).alias("value")).write.text(path)
    back = readers.read_unlabelled(spark, path)
    return back.select("row_no", "par_id", "art_id", "keyword", "country", F.md5("text").alias("text"))


def split_file(spark, sf_dir):
    """A split list with votes written as CSV, read back and given its texts."""
    votes = vote_labels(spark, sf_dir).select("doc_id", F.col("doc_id").cast("string").alias("par_id"), F.col("votes").alias("label"))
    path = _scratch(spark, "split")
    votes.orderBy(F.desc("doc_id")).select("par_id", "label").write.option("header", True).csv(path)
    ids = readers.read_split(spark, path).withColumn("label", L.vote_label(F.col("label")))
    texts = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id")
    known = texts.select(F.col("doc_id").cast("string").alias("par_id"), F.length("text").cast("bigint").alias("chars"))
    return splits.attach_in_order(ids, known, "par_id").select("row_no", "par_id", "label", "chars")


def row_numbers(spark, sf_dir):
    """Documents numbered from the longest to the shortest."""
    docs = table(spark, sf_dir, "documents").select("doc_id", (-F.length("text")).alias("order"))
    return splits.with_row_no(docs, ["order", "doc_id"]).select("row_no", "doc_id")


def stored_probabilities(spark, sf_dir):
    """Scores stored as probabilities, read back and decided at 0.12."""
    path = _scratch(spark, "probs")
    sinks.write_probs(corpus(spark, sf_dir), path, "score", "doc_id")
    return readers.read_probs(spark, path).withColumn("pred", N.decide(F.col("prob"), 0.12))


def metrics_log(spark, sf_dir):
    """The trial log written in two portions, the second of them twice, and read back."""
    path = _scratch(spark, "log")
    log = _trial_log(spark, sf_dir)
    for portion in (F.col("country") == "en", F.col("country") != "en", F.col("country") != "en"):
        sinks.record_metrics(log.where(portion), path, ["country", "epoch"])
    found = sinks.recorded_metrics(spark, path, "country string, epoch int, threshold double, best_tuned_f1 double")
    return found.select("country", "epoch", "threshold", "best_tuned_f1")


def label_file_scores(spark, sf_dir):
    """Gold and decisions written as label files, read back and scored."""
    rows = corpus(spark, sf_dir)
    gold_path, pred_path = _scratch(spark, "gold"), _scratch(spark, "pred")
    sinks.write_label_lines(rows, gold_path, "label", "doc_id")
    sinks.write_label_lines(rows, pred_path, "pred", "doc_id")
    gold = readers.read_label_lines(spark, gold_path)
    pred = readers.read_label_lines(spark, pred_path, "pred")
    return metrics.binary_scores(splits.align(gold, pred), "label", "pred")


def submission_scores(spark, sf_dir):
    """Label files of both tasks written to two folders, and the whole submission scored."""
    gold, guess = _scratch(spark, "ref"), _scratch(spark, "res")
    rows, pairs = corpus(spark, sf_dir), vectors(spark, sf_dir)
    for folder, label, vector in ((gold, "label", "gold"), (guess, "pred", "guess")):
        sinks.write_label_lines(rows, f"{folder}/{TASK_FILES['task1']}", label, "doc_id")
        sinks.write_vector_lines(pairs, f"{folder}/{TASK_FILES['task2']}", vector, "doc_id")
    return score_submission(spark, gold, guess)


def vector_file_scores(spark, sf_dir):
    """Gold and guessed vectors written as files, read back and scored."""
    rows = vectors(spark, sf_dir)
    gold_path, pred_path = _scratch(spark, "goldvec"), _scratch(spark, "predvec")
    sinks.write_vector_lines(rows, gold_path, "gold", "doc_id")
    sinks.write_vector_lines(rows, pred_path, "guess", "doc_id")
    gold = readers.read_vector_lines(spark, gold_path, vec_col="gold")
    pred = readers.read_vector_lines(spark, pred_path, vec_col="guess")
    return metrics.multilabel_scores(splits.align(gold, pred, extra="ignore"), "gold", "guess")


def _in_parts(rows):
    """Two thirds are trained on, the others are dev."""
    part = F.pmod(F.xxhash64("doc_id"), F.lit(3))
    return rows.where(part != 0), rows.where(part == 0)


def _epochs(spark, sf_dir, settings=focal.Settings()):
    return focal.train_epochs(*_in_parts(corpus(spark, sf_dir).select("doc_id", "text", "label")), settings)


def _classified(spark, sf_dir):
    model, log = _epochs(spark, sf_dir)
    threshold = trials.best_trial(log).first()["threshold"]
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return focal.predict(model, docs, threshold, "text").drop("text"), threshold


def classifier_scores(spark, sf_dir):
    """Every document scored by a model trained on the labelled ones."""
    return _classified(spark, sf_dir)[0].select("doc_id", "prob", "pred")


def classifier_checks(spark, sf_dir):
    """Per language the documents scored, and how many scores and decisions hold what they promise."""
    scored, threshold = _classified(spark, sf_dir)
    langs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    decided = (F.col("prob") >= F.lit(threshold).cast("float")).cast("int")
    return langs.join(scored, "doc_id").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("n_ids"),
        F.count_if(F.col("prob").between(0, 1)).alias("n_probabilities"), F.count_if(F.col("pred") == decided).alias("n_decisions"),
    )


def epoch_log(spark, sf_dir):
    """Ten epochs of training on the focal loss, with loss, dev F1 and threshold, and whether each was the best so far."""
    return trials.best_so_far(_epochs(spark, sf_dir)[1].withColumn("run", F.lit("focal")), "run").drop("run")


def epoch_checks(spark, sf_dir):
    """Per epoch whether its loss is below the last one's, its threshold one of the grid's and its F1 possible."""
    log = _epochs(spark, sf_dir, focal.Settings(reg=0.0))[1]
    before = F.lag("train_loss").over(Window.partitionBy(F.lit(0)).orderBy("epoch"))
    return log.select("epoch", F.coalesce(F.col("train_loss") < before, F.lit(True)).alias("falls"), *_possible())


def focal_gradient(spark, sf_dir):
    """The focal loss of the labelled documents and its gradient, at weights and features made of small numbers."""
    settings = focal.Settings(features=64)
    words = F.array(F.length("text") % 32, 32 + F.col("score_milli") % 16, 48 + F.col("doc_id") % 16, 48 + F.col("score_milli") % 7).cast("array<int>")
    rows = corpus(spark, sf_dir).select(words.alias("_words"), "label", F.when(F.col("label") == 1, 2.0).otherwise(0.5).alias("_alpha"))
    weights = np.array([(f * 37 % 101) / 50 - 1 for f in range(65)])
    loss, gradient = focal.loss_and_gradient(rows, "label", weights, settings)
    values = [(f, float(g)) for f, g in enumerate(gradient)] + [(65, loss)]
    return spark.createDataFrame(values, "feature int, value double").select("feature", F.round("value", 9).alias("value"))


def _trials(spark, sf_dir):
    rows = corpus(spark, sf_dir).select("doc_id", "text", "label")
    train, dev = _in_parts(classify.term_vectors(rows, "text"))
    return classify.run_trials(train, dev, [classify.Params(), classify.Params(reg=0.1)])[1]


def _possible():
    """Whether a logged threshold is one of the grid's, the loss finite and the F1 possible."""
    near = F.rint((F.col("threshold") - curves.GRID_LOW) / curves.GRID_STEP)
    on_grid = F.abs(F.col("threshold") - curves.GRID_LOW - near * curves.GRID_STEP) < 1e-9
    loss = F.col("train_loss")
    return [
        (on_grid & F.col("threshold").between(curves.GRID_LOW, curves.GRID_HIGH)).alias("on_grid"),
        (loss.isNotNull() & ~F.isnan(loss) & (loss >= 0) & (loss < float("inf"))).alias("finite_loss"),
        F.col("best_tuned_f1").between(F.col("dev_f1_05") * 0, 1.0).alias("possible_f1"),
    ]


def trial_log(spark, sf_dir):
    """Two trials that differ in regularisation, with loss, dev F1 and threshold."""
    return trials.best_so_far(_trials(spark, sf_dir).withColumn("run", F.lit("grid")), "run").drop("run")


def trial_checks(spark, sf_dir):
    """Of each trial, whether its threshold is one of the grid's, its loss finite and its F1 possible."""
    return _trials(spark, sf_dir).select("epoch", *_possible())


QUERIES = {
    f.__name__: f
    for f in (
        keyword_metrics, binary_scores, country_scores, multilabel_scores, classification_report,
        confusion_matrix, length_bin_errors, error_breakdown, error_totals, error_sample, label_collapse,
        numeric_collapse, vote_labels, category_lists, category_vectors, pr_curve, average_precision,
        operating_point, threshold_sweep, best_threshold, dataset_loss, dataset_loss_extreme, class_weights, class_distribution,
        class_counts, token_stats, token_percentiles, null_text_stats, word_token_stats, token_histogram, top_ngrams, frequent_ngrams, top_ngrams_by_role,
        top_word_ngrams, abbreviation_statistics, collocation_statistics, sentence_counts, train_split, dev_split, preview_rows, scored_rows, hash_baseline,
        truncated_text, report_lines, fixed_point_ties, score_file_lines, best_trial, best_so_far, graded_file, quoted_file,
        annotation_file, unlabelled_file, split_file, row_numbers, stored_probabilities, metrics_log,
        label_file_scores, vector_file_scores, submission_scores, classifier_scores, classifier_checks,
        epoch_log, epoch_checks, focal_gradient, trial_log, trial_checks,
    )
}
