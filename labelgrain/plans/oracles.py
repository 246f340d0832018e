"""SQL for another engine (DuckDB) that gives the same rows as the table queries.

Written from the operators' definitions, mostly by brute force, and not from
the Spark plans. Only fixed values and rule lists are shared.
"""

from __future__ import annotations

from labelgrain.fixed_values import (
    GRID_HIGH, GRID_LOW, GRID_STEP, HISTOGRAM_BINS, LENGTH_EDGES, LENGTH_LABELS, SEED, STOP_WORDS, TAG_IDS, VECTOR_NAMES,
)
from labelgrain.functions.text import ABBREVIATIONS

WIDTH = len(VECTOR_NAMES)

CORPUS = """
corpus AS (
  SELECT d.doc_id, d.source AS keyword, d.lang AS country, d.text, l.toxic,
         CAST(l.toxic * 2 + l.quality AS VARCHAR) AS orig_label,
         CAST(CASE WHEN l.toxic * 2 + l.quality IN (0, 1) THEN 0 ELSE 1 END AS INTEGER) AS label,
         CAST(l.toxic * 300 + (d.doc_id * 7919) % 700 AS INTEGER) AS score_milli,
         CAST((l.toxic * 300 + (d.doc_id * 7919) % 700) / 1000 AS FLOAT) AS score,
         CAST(l.toxic * 300 + (d.doc_id * 7919) % 700 >= 500 AS INTEGER) AS pred
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
)"""

COUNT = """
  CAST(count(*) FILTER (WHERE pred = 1 AND label = 1) AS BIGINT) AS tp,
  CAST(count(*) FILTER (WHERE pred = 1 AND label = 0) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE pred = 0 AND label = 1) AS BIGINT) AS fn,
  CAST(count(*) FILTER (WHERE pred = 0 AND label = 0) AS BIGINT) AS tn"""


def div(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN 0.0::DOUBLE ELSE ({a})::DOUBLE / ({b})::DOUBLE END)"


P, R, F1 = div("tp", "tp + fp"), div("tp", "tp + fn"), div("2 * tp", "2 * tp + fp + fn")
SCORES = f"{P} AS precision, {R} AS recall, {F1} AS f1"


def even(x: str, digits: int) -> str:
    scale = 10**digits
    return f"(round_even(({x}) * {scale}::DOUBLE, 0) / {scale}::DOUBLE)"


def with_corpus(body: str, *more: str) -> str:
    return "WITH " + ",\n".join([CORPUS, *more]) + "\n" + body


WS_TOKENS = r"list_filter(string_split_regex(text, '[\s\x0b\x1c-\x1f]+'), lambda t: t <> '')"
LETTERS = r"list_filter(string_split_regex(lower(text), '[^\p{L}]+'), lambda t: t <> '')"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# Word tokens by rewriting: each rule puts spaces where tokens part. \x01 stands
# for a full stop, \x02 for a comma and \x03 for a colon that belong to a word.
NO_WORD = r"([^\p{L}\p{N}]|\z)"
KEEP_STOP = (r"(^|[^\p{L}\p{N}])(" + "|".join(a.replace(".", r"\.") for a in ABBREVIATIONS) + r"|\p{L})\.", "\\1\\2\x01")
WORD_RULES = (
    (r'^"', " `` "),
    (r"([\s(\[{<])(\"|'')", r"\1 `` "),
    (r'"', "''"),
    ("(?i)" + KEEP_STOP[0], KEEP_STOP[1]),
    ("(?i)" + KEEP_STOP[0], KEEP_STOP[1]),
    (r"([«“‘„]|`+)", r" \1 "),
    (r"([^.\s])\.([\])}>'»”’]*)(\s|\z)", r"\1 . \2 \3"),
    (r",(\d)", "\x02\\1"),
    (r":(\d)", "\x03\\1"),
    (r"([:,])", r" \1 "),
    (r"(\.\.+)", r" \1 "),
    (r"([;@#$%&?!*]|[\](){}<>\[]|[»”’]|--|'')", r" \1 "),
    (r"([^'\s])'(\s|\z)", r"\1 ' \2"),
    (rf"(?i)([^'\s])('s|'m|'d|'ll|'re|'ve|n't){NO_WORD}", r"\1 \2 \3"),
    (rf"(?i)([^'\s])('s|'m|'d|'ll|'re|'ve|n't){NO_WORD}", r"\1 \2 \3"),
    (rf"(?i)(^|\s)(can)(not){NO_WORD}", r"\1\2 \3\4"),
    (rf"(?i)(^|\s)(gim|lem)(me){NO_WORD}", r"\1\2 \3\4"),
    (rf"(?i)(^|\s)(gon|wan)(na){NO_WORD}", r"\1\2 \3\4"),
    (rf"(?i)(^|\s)(got)(ta){NO_WORD}", r"\1\2 \3\4"),
    (rf"(?i)(^|\s)('t)(is|was){NO_WORD}", r"\1\2 \3\4"),
)


def word_chain(column: str) -> str:
    expr = column
    for pattern, replacement in WORD_RULES:
        expr = f"regexp_replace({expr}, {quoted(pattern)}, {quoted(replacement)}, 'g')"
    expr = f"translate({expr}, '\x01\x02\x03', '.,:')"
    return rf"list_filter(string_split_regex({expr}, '[\s\x0b\x1c-\x1f]+'), lambda t: t <> '')"


def vectors() -> str:
    gold = ", ".join(f"CAST((doc_id >> {k}) & 1 AS INTEGER)" for k in range(WIDTH))
    guess = ", ".join(f"CAST(((doc_id * 31) >> {k}) & 1 AS INTEGER)" for k in range(WIDTH))
    return f"vectors AS (SELECT doc_id, [{gold}] AS gold, [{guess}] AS guess FROM documents)"


def multilabel() -> str:
    parts = []
    for i, name in enumerate(VECTOR_NAMES):
        cells = {"tp": (1, 1), "fp": (0, 1), "fn": (1, 0), "tn": (0, 0)}
        counts = ", ".join(
            f"count(*) FILTER (WHERE gold[{i + 1}] = {g} AND guess[{i + 1}] = {p}) AS {c}" for c, (g, p) in cells.items()
        )
        parts.append(f"SELECT {i} AS position, '{name}' AS label, {counts} FROM vectors")
    mean = " + ".join(f"max(f1) FILTER (WHERE position = {i})" for i in range(WIDTH))
    return f"""
WITH {vectors()},
cells AS ({" UNION ALL ".join(parts)}),
scored AS (SELECT CAST(position AS INTEGER) AS position, label, tp, fp, fn, tn, {F1} AS f1 FROM cells)
SELECT * FROM scored
UNION ALL
SELECT {WIDTH}, 'avg', NULL, NULL, NULL, NULL, ({mean}) / {WIDTH}.0::DOUBLE FROM scored"""


def report() -> str:
    return with_corpus(
        f"""
, per AS (
  SELECT 0 AS line, 'negative' AS label, tn AS tp, fn AS fp, fp AS fn FROM c
  UNION ALL SELECT 1, 'positive', tp, fp, fn FROM c),
s AS (SELECT line, label, {SCORES}, tp + fn AS support FROM per),
pair AS (
  SELECT max(precision) FILTER (WHERE line = 0) p0, max(precision) FILTER (WHERE line = 1) p1,
         max(recall) FILTER (WHERE line = 0) r0, max(recall) FILTER (WHERE line = 1) r1,
         max(f1) FILTER (WHERE line = 0) f0, max(f1) FILTER (WHERE line = 1) f1,
         max(support) FILTER (WHERE line = 0) n0, max(support) FILTER (WHERE line = 1) n1 FROM s)
SELECT CAST(line AS INTEGER) AS line, label, precision, recall, f1, support FROM s
UNION ALL SELECT 2, 'accuracy', NULL, NULL, {div("tp + tn", "tp + fp + fn + tn")}, tp + fp + fn + tn FROM c
UNION ALL SELECT 3, 'macro avg', (p0 + p1) / 2::DOUBLE, (r0 + r1) / 2::DOUBLE, (f0 + f1) / 2::DOUBLE, n0 + n1 FROM pair
UNION ALL SELECT 4, 'weighted avg', (p0 * n0 + p1 * n1) / (n0 + n1)::DOUBLE, (r0 * n0 + r1 * n1) / (n0 + n1)::DOUBLE,
                 (f0 * n0 + f1 * n1) / (n0 + n1)::DOUBLE, n0 + n1 FROM pair""",
        f"c AS (SELECT {COUNT} FROM corpus)",
    ).replace("\n\n, per", ",\nper")


def length_bins() -> str:
    cases = " ".join(
        f"WHEN tokens > {LENGTH_EDGES[i]} AND tokens <= {LENGTH_EDGES[i + 1]} THEN {i}" for i in range(len(LENGTH_LABELS))
    )
    names = ", ".join(quoted(x) for x in LENGTH_LABELS)
    return with_corpus(
        f"""
SELECT bin, ([{names}])[bin + 1] AS length_bin, count(*) AS n, count(*) FILTER (WHERE label = 1) AS positives,
  {even(div("count(*) FILTER (WHERE label = 1 AND pred = 0)", "count(*) FILTER (WHERE label = 1)"), 3)} AS fn_rate,
  CASE WHEN count(*) FILTER (WHERE label = 0) = 0 THEN NULL ELSE
  {even(div("count(*) FILTER (WHERE label = 0 AND pred = 1)", "count(*) FILTER (WHERE label = 0)"), 3)} END AS fp_rate
FROM binned WHERE bin IS NOT NULL GROUP BY bin""",
        f"counted AS (SELECT *, len({WS_TOKENS}) AS tokens FROM corpus)",
        f"binned AS (SELECT *, CAST(CASE {cases} END AS INTEGER) AS bin FROM counted)",
    )


ERRORS = """errs AS (SELECT *, CASE WHEN pred = 1 THEN 'FP' ELSE 'FN' END AS err_type FROM corpus WHERE pred <> label)"""


def annotations() -> str:
    names = ", ".join(quoted(t) for t in sorted(TAG_IDS, key=TAG_IDS.get))
    return f"""
placed AS (SELECT doc_id, text, source AS keyword, lang AS country, n_chars, unnest(range(0, {2 * WIDTH})) AS place FROM documents),
ann AS (SELECT *, (place * 5 + doc_id) % {WIDTH} AS tag_no, ([{names}])[(place * 5 + doc_id) % {WIDTH} + 1] AS tag,
               doc_id * 16 + place AS row_no
        FROM placed WHERE (doc_id >> ((place * 5 + doc_id) % {WIDTH})) & 1 = 1),
firsts AS (SELECT doc_id, text, keyword, country, n_chars, tag_no, min(row_no) AS first_at
           FROM ann GROUP BY ALL),
lists AS (SELECT CAST(doc_id AS VARCHAR) AS par_id, CAST(n_chars AS VARCHAR) AS art_id, keyword, country,
                 CAST(min(first_at) AS BIGINT) AS row_no, string_agg(CAST(tag_no AS VARCHAR), ',' ORDER BY first_at) AS ids,
                 list(tag_no) AS tag_list
          FROM firsts GROUP BY doc_id, text, keyword, country, n_chars)"""


def category_vectors() -> str:
    def vector(classes: str) -> str:
        return f"array_to_string(list_transform({classes}, lambda c: CAST(list_contains(tag_list, c) AS INTEGER)), ',')"

    return f"""WITH {annotations()},
seen AS (SELECT list_sort(list(DISTINCT tag_no)) AS classes FROM ann)
SELECT par_id, {vector("(SELECT classes FROM seen)")} AS seen, {vector(f"range(0, {WIDTH})")} AS "all" FROM lists"""


CURVE = """
per_score AS (SELECT score, sum(label) AS pos, count(*) - sum(label) AS neg FROM corpus GROUP BY score),
cum AS (SELECT score, pos, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS all_pos
        FROM per_score WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
curve AS (
  SELECT score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(pos AS BIGINT) AS positives,
         tp::DOUBLE / (tp + fp)::DOUBLE AS precision,
         CASE WHEN all_pos = 0 THEN 1.0::DOUBLE ELSE tp::DOUBLE / all_pos::DOUBLE END AS recall FROM cum
  UNION ALL SELECT NULL, NULL, NULL, NULL, 1.0::DOUBLE, 0.0::DOUBLE)"""

GRID = f"""
grid AS (SELECT CAST(i AS INTEGER) AS i, {GRID_LOW}::DOUBLE + i * (({GRID_LOW}::DOUBLE + {GRID_STEP}::DOUBLE) - {GRID_LOW}::DOUBLE) AS threshold
         FROM range(0, CAST(ceil(({GRID_HIGH}::DOUBLE - {GRID_LOW}::DOUBLE) / {GRID_STEP}::DOUBLE) AS BIGINT)) t(i))"""


def sweep(keys: str = "") -> str:
    lead = f"{keys}, " if keys else ""
    return f"""{GRID},
sweep AS (
  SELECT {lead}i, threshold, tp, fp, fn, {F1} AS f1 FROM (
    SELECT {lead}i, threshold,
      count(*) FILTER (WHERE score >= CAST(threshold AS FLOAT) AND label = 1) AS tp,
      count(*) FILTER (WHERE score >= CAST(threshold AS FLOAT) AND label = 0) AS fp,
      count(*) FILTER (WHERE score < CAST(threshold AS FLOAT) AND label = 1) AS fn
    FROM scored CROSS JOIN grid GROUP BY {lead}i, threshold))"""


def best(keys: str = "") -> str:
    lead = f"{keys}, " if keys else ""
    over = f"PARTITION BY {keys} " if keys else ""
    return f"""
best AS (SELECT {lead}CASE WHEN f1 > 0 THEN threshold ELSE 0.5::DOUBLE END AS threshold, f1
         FROM sweep QUALIFY row_number() OVER ({over}ORDER BY f1 DESC, threshold) = 1)"""


SCORED = "scored AS (SELECT * FROM corpus)"
SCORED_LOG = "scored AS (SELECT *, CAST(substr(keyword, 4) AS INTEGER) AS epoch FROM corpus)"


def trial_log() -> tuple[str, ...]:
    keys = "country, epoch"
    return SCORED_LOG, sweep(keys), best(keys), "log AS (SELECT country, epoch, threshold, f1 AS best_tuned_f1 FROM best)"


def stats(source: str, keys: str) -> str:
    agg = """CAST(count(*) AS BIGINT) AS n, round(sum(tokens)::DOUBLE / count(*), 6) AS mean,
  CAST(max(tokens) AS INTEGER) AS max, round(quantile_cont(tokens, 0.95), 6) AS percentile"""
    return f"""
SELECT 'overall' AS scope, {agg} FROM {source}
UNION ALL SELECT CAST({keys} AS VARCHAR), {agg} FROM {source} GROUP BY {keys}"""


def histogram() -> str:
    b = HISTOGRAM_BINS
    return with_corpus(
        f"""
SELECT label, bin, round(bin * width + lo, 6) AS bin_from,
  round(CASE WHEN bin = {b - 1} THEN hi ELSE (bin + 1) * width + lo END, 6) AS bin_to,
  (SELECT count(*) FROM counted c WHERE c.label = e.label
     AND c.tokens >= e.bin * e.width + e.lo
     AND (e.bin = {b - 1} OR c.tokens < (e.bin + 1) * e.width + e.lo)) AS n
FROM edges e""",
        f"counted AS (SELECT label, CAST(len({WS_TOKENS}) AS DOUBLE) AS tokens FROM corpus)",
        """spans AS (SELECT label, CASE WHEN min(tokens) = max(tokens) THEN min(tokens) - 0.5 ELSE min(tokens) END AS lo,
   CASE WHEN min(tokens) = max(tokens) THEN max(tokens) + 0.5 ELSE max(tokens) END AS hi FROM counted GROUP BY label)""",
        f"""edges AS (SELECT label, lo, hi, (hi - lo) / {b}::DOUBLE AS width, CAST(unnest(range(0, {b})) AS INTEGER) AS bin FROM spans)""",
    )


def ngrams(source: str, key: str, cls: str, tokens: str, ties: str, k: int = 15) -> str:
    stops = "[" + ", ".join(quoted(w) for w in STOP_WORDS) + "]"
    return f"""
toks AS (SELECT {cls} AS class, {key} AS text_no, list_filter({tokens}, lambda t: NOT list_contains({stops}, t)) AS tk FROM {source}),
grams AS (SELECT class, text_no, unnest(range(1, len(tk))) AS pos, tk FROM toks),
pairs AS (SELECT class, text_no, pos, tk[pos] || ' ' || tk[pos + 1] AS ngram FROM grams),
counted AS (SELECT class, ngram, count(*) AS n, min({{'text_no': text_no, 'pos': pos}}) AS first_at FROM pairs GROUP BY class, ngram)
SELECT class AS {cls}, CAST(row_number() OVER (PARTITION BY class ORDER BY n DESC, {ties}) AS INTEGER) AS rank, ngram, n
FROM counted QUALIFY rank <= {k}"""


def hash_bits(width: int) -> str:
    digits = ", ".join(
        f"CAST(CAST(substr(md5('{SEED}|' || CAST(doc_id AS VARCHAR)), {i + 1}, 1) >= '8' AS INTEGER) AS VARCHAR)" for i in range(width)
    )
    return f"concat_ws(',', {digits})"


NAMED = """
named AS (
  SELECT 0 AS line, 'task1_precision' AS name, precision AS value FROM s
  UNION ALL SELECT 1, 'task1_recall', recall FROM s
  UNION ALL SELECT 2, 'task1_f1', f1 FROM s)"""


ONE_LINE = r"trim(regexp_replace(text, '[ \t\r\n\x0b\f]+', ' ', 'g'))"


SENTENCE_TOKENS = rf"""lists AS (SELECT doc_id, {WS_TOKENS} AS words FROM documents),
raw AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos FROM lists),
bare AS (SELECT doc_id, pos, regexp_replace(lower(word), '^[(\[{{"''“‘„«]+|[)\]}}"''”’»,;:!?]+$', '', 'g') AS bare,
  regexp_matches(word, '[!?][)\]}}"''”’»]*$') AS mark FROM raw),
typed AS (SELECT doc_id, pos, CASE WHEN bare LIKE '%.' THEN left(bare, length(bare) - 1) ELSE bare END AS type, bare LIKE '%.' AS stop, mark FROM bare),
tokens AS (SELECT *, lead(type) OVER (PARTITION BY doc_id ORDER BY pos) AS next FROM typed)"""

ABBREVIATION_SCORES = r"""counts AS (SELECT type, count(*) FILTER (WHERE stop) AS with_stop, count(*) FILTER (WHERE NOT stop) AS without_stop FROM tokens GROUP BY type),
totals AS (SELECT sum(with_stop)::DOUBLE / sum(with_stop + without_stop) AS p FROM counts),
shaped AS (SELECT *, length(type) - length(replace(type, '.', '')) AS inner_stops, length(replace(type, '.', '')) AS size
  FROM counts, totals WHERE with_stop > 0 AND regexp_matches(type, '\p{L}')),
short AS (SELECT type, with_stop, without_stop, 2 * (with_stop * (ln(0.99::DOUBLE) - ln(p)) + without_stop * (ln(1 - 0.99::DOUBLE) - ln(1 - p)))
  * exp(-size) * (inner_stops + 1) / size::DOUBLE ** without_stop AS score FROM shaped)"""


def log_binomial(hits: str, n: str, p: str) -> str:
    parts = ((hits, p), (f"({n} - {hits})", f"(1 - {p})"))
    return "(" + " + ".join(f"CASE WHEN {c} = 0 THEN 0 ELSE {c} * ln({s}) END" for c, s in parts) + ")"


_EXPECTED, _FIRST, _REST = "(b / total)", "(n / a)", "((b - n) / (total - a))"
COLLOCATION_SCORES = f"""sides AS (SELECT type, next, n::DOUBLE AS n, a::DOUBLE AS a, b::DOUBLE AS b, (SELECT count(*) FROM tokens)::DOUBLE AS total
  FROM (SELECT type, next, count(*) AS n FROM tokens WHERE stop AND next IS NOT NULL GROUP BY ALL)
  JOIN (SELECT type, count(*) AS a FROM tokens WHERE stop GROUP BY type) USING (type)
  JOIN (SELECT type AS next, count(*) AS b FROM tokens GROUP BY type) USING (next)),
pairs AS (SELECT type, next, n::BIGINT AS n, CASE WHEN {_FIRST} > {_EXPECTED} THEN
  2 * ({log_binomial("n", "a", _FIRST)} + {log_binomial("(b - n)", "(total - a)", _REST)}
       - {log_binomial("n", "a", _EXPECTED)} - {log_binomial("(b - n)", "(total - a)", _EXPECTED)}) ELSE 0.0 END AS score FROM sides)"""


def build() -> dict[str, str]:
    counts, s = f"c AS (SELECT {COUNT} FROM corpus)", f"s AS (SELECT *, {SCORES} FROM c)"
    words = rf"list_filter({word_chain('lower(text)')}, lambda t: regexp_full_match(t, '\p{{L}}+'))"
    harmonic = div("2 * p * r", "p + r")
    return {
        "keyword_metrics": with_corpus(
            f"""
SELECT keyword, total, tp + fn AS positives, {even("100.0::DOUBLE * (tp + fn) / total", 1)} AS positive_pct,
  {even("p", 3)} AS precision, {even("r", 3)} AS recall, {even(harmonic, 3)} AS f1,
  {even(harmonic, 3)} < (SELECT {F1} FROM c) AS below_overall
FROM (SELECT *, {P} AS p, {R} AS r FROM g) ORDER BY f1, keyword""",
            counts,
            f"g AS (SELECT keyword, count(*) AS total, {COUNT} FROM corpus WHERE keyword IS NOT NULL GROUP BY keyword)",
        ),
        "binary_scores": with_corpus(f"SELECT *, {SCORES} FROM c", counts),
        "country_scores": with_corpus(
            f"SELECT *, {SCORES} FROM c", f"c AS (SELECT country, {COUNT} FROM corpus GROUP BY country)"
        ),
        "multilabel_scores": multilabel(),
        "classification_report": report(),
        "confusion_matrix": with_corpus(
            """SELECT 0 AS gold, 0 AS pred, 'TN' AS cell, tn AS n FROM c UNION ALL SELECT 0, 1, 'FP', fp FROM c
UNION ALL SELECT 1, 0, 'FN', fn FROM c UNION ALL SELECT 1, 1, 'TP', tp FROM c""", counts),
        "length_bin_errors": length_bins(),
        "error_breakdown": with_corpus(
            "SELECT err_type, keyword, count(*) AS n FROM errs WHERE keyword IS NOT NULL GROUP BY ALL", ERRORS),
        "error_totals": with_corpus(
            """SELECT count(*) FILTER (WHERE pred = 1 AND label = 0) AS false_positives,
       count(*) FILTER (WHERE pred = 0 AND label = 1) AS false_negatives FROM corpus"""),
        "error_sample": with_corpus(
            f"""SELECT err_type, doc_id, keyword, substr(text, 1, 200) AS snippet,
  CAST(row_number() OVER (PARTITION BY err_type ORDER BY md5('{SEED}|' || CAST(doc_id AS VARCHAR)), doc_id) AS INTEGER) AS rank
FROM errs QUALIFY rank <= 8""", ERRORS),
        "label_collapse": with_corpus(
            "SELECT doc_id, orig_label, label, CAST(label AS VARCHAR) AS vector FROM corpus"),
        "numeric_collapse": """SELECT d.doc_id, CAST(toxic * 2 + quality AS INTEGER) AS grade,
  CAST(CASE WHEN toxic * 2 + quality < 2 THEN 0 ELSE 1 END AS INTEGER) AS label
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
        "vote_labels": f"""WITH {vectors()} SELECT doc_id, '[' || array_to_string(gold, ', ') || ']' AS votes,
  CAST(list_sum(gold) >= 2 AS INTEGER) AS label FROM vectors""",
        "category_lists": f"WITH {annotations()} SELECT par_id, art_id, keyword, country, row_no, ids FROM lists",
        "category_vectors": category_vectors(),
        "pr_curve": with_corpus("SELECT * FROM curve", CURVE),
        "average_precision": with_corpus(
            """SELECT round(sum((recall - before) * precision), 9) AS average_precision FROM (
  SELECT precision, recall, lag(recall, 1, 0.0::DOUBLE) OVER (ORDER BY threshold DESC) AS before FROM curve WHERE threshold IS NOT NULL)""", CURVE),
        "operating_point": with_corpus(
            """SELECT threshold, precision, recall FROM curve WHERE threshold IS NOT NULL
ORDER BY abs(threshold - CAST(0.12 AS FLOAT)), threshold LIMIT 1""", CURVE),
        "threshold_sweep": with_corpus("SELECT * FROM sweep", SCORED, sweep()),
        "best_threshold": with_corpus("SELECT * FROM best", SCORED, sweep(), best()),
        "dataset_loss": with_corpus(
            """SELECT round(avg(a * (1 - p) ** 2.0 * -(0.9::DOUBLE * ln(p) + 0.1::DOUBLE * ln(1 - p))), 6) AS loss, count(*) AS n
FROM (SELECT CASE WHEN label = 1 THEN p1 ELSE 1 - p1 END AS p,
             (SELECT count(*) FROM corpus)::DOUBLE / (2 * (SELECT count(*) FROM corpus c WHERE c.label = probs.label)) AS a FROM probs)""",
            "probs AS (SELECT label, 1 / (1 + exp((1000 - score_milli) / 500 - score_milli / 500)) AS p1 FROM corpus)"),
        "dataset_loss_extreme": with_corpus(
            """SELECT round(avg(a * exp(2.0 * lq) * -(0.9::DOUBLE * lp + 0.1::DOUBLE * lq)), 6) AS loss, count(*) AS n
FROM (SELECT a, -(greatest(-z, 0) + ln(1 + exp(-abs(z)))) AS lp, -(greatest(z, 0) + ln(1 + exp(-abs(z)))) AS lq FROM margins)""",
            """margins AS (SELECT (CASE WHEN label = 1 THEN 2 * score_milli - 1000 ELSE 1000 - 2 * score_milli END)::DOUBLE AS z,
  (SELECT count(*) FROM corpus)::DOUBLE / (2 * (SELECT count(*) FROM corpus c WHERE c.label = corpus.label)) AS a FROM corpus)"""),
        "class_weights": with_corpus(
            """SELECT label, count(*) AS n, (SELECT count(*) FROM corpus)::DOUBLE / ((SELECT max(label) + 1 FROM corpus) * count(*))::DOUBLE AS weight
FROM corpus GROUP BY label"""),
        "class_distribution": with_corpus(
            "SELECT label, count(*) AS n, 100.0::DOUBLE * count(*) / (SELECT count(*) FROM corpus) AS pct FROM corpus GROUP BY label"),
        "class_counts": "SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang",
        "token_stats": with_corpus(stats("counted", "label"), f"counted AS (SELECT label, len({WS_TOKENS}) AS tokens FROM corpus)"),
        "word_token_stats": f"WITH counted AS (SELECT lang, len({word_chain('text')}) AS tokens FROM documents)" + stats("counted", "lang"),
        "null_text_stats": f"""SELECT lang, count(*) AS n, count(*) FILTER (WHERE quality IS NULL) AS n_null,
  CAST(sum(CASE WHEN quality IS NULL THEN 1 ELSE len({WS_TOKENS}) END) AS BIGINT) AS tokens,
  CAST(sum(CASE WHEN quality IS NOT NULL THEN len({WS_TOKENS}) END) AS BIGINT) AS tokens_skipping
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""",
        "token_histogram": histogram(),
        "top_ngrams": with_corpus(*reversed_pair(ngrams("corpus", "doc_id", "label", LETTERS, "ngram"))),
        "top_ngrams_by_role": "WITH " + ngrams("conversations", "conv_id", "role", LETTERS, "ngram"),
        "top_word_ngrams": with_corpus(*reversed_pair(ngrams("corpus", "doc_id", "label", words, "first_at"))),
        "frequent_ngrams": with_corpus(*reversed_pair(ngrams("corpus", "doc_id", "label", LETTERS, "ngram"))),
        "token_percentiles": with_corpus(stats("counted", "label"), f"counted AS (SELECT label, len({WS_TOKENS}) AS tokens FROM corpus)"),
        "abbreviation_statistics": f"WITH {SENTENCE_TOKENS},\n{ABBREVIATION_SCORES}\nSELECT type, with_stop, without_stop, round(score, 3) + 0.0 AS score FROM short",
        "collocation_statistics": f"WITH {SENTENCE_TOKENS},\n{COLLOCATION_SCORES}\nSELECT type, next, n, round(score, 3) + 0.0 AS score FROM pairs",
        "sentence_counts": f"""WITH {SENTENCE_TOKENS},\n{ABBREVIATION_SCORES},\n{COLLOCATION_SCORES}
SELECT doc_id, count(*) AS n_sentences FROM tokens t
WHERE mark OR next IS NULL OR (stop AND NOT EXISTS (SELECT 1 FROM short s WHERE s.type = t.type AND score >= 0.3)
  AND NOT EXISTS (SELECT 1 FROM pairs p WHERE p.type = t.type AND p.next = t.next AND score >= 7.88)) GROUP BY doc_id""",
        "train_split": """SELECT count(*) AS n, CAST(sum(CASE WHEN doc_id % 5 < 2 THEN 0 ELSE 1 END) AS BIGINT) AS positives,
  100 * sum(CASE WHEN doc_id % 5 < 2 THEN 0 ELSE 1 END)::DOUBLE / count(*) AS positive_pct
FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)""",
        "dev_split": """SELECT l.doc_id AS row_no, CAST(l.doc_id AS VARCHAR) AS par_id, l.toxic AS label, len(d.text) AS chars
FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id""",
        "preview_rows": """SELECT l.doc_id AS row_no, CAST(l.doc_id AS VARCHAR) AS par_id, l.toxic AS label, len(d.text) AS chars
FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id ORDER BY l.doc_id LIMIT 5""",
        "scored_rows": with_corpus(
            """SELECT doc_id AS row_no, label, pred, CAST(label = pred AS INTEGER) AS correct,
  (CASE WHEN label = pred THEN 'T' ELSE 'F' END) || (CASE WHEN pred = 1 THEN 'P' ELSE 'N' END) AS err_type FROM corpus"""),
        "hash_baseline": f"SELECT doc_id, {hash_bits(1)} AS one, {hash_bits(WIDTH)} AS seven FROM documents",
        "truncated_text": f"""SELECT doc_id, CAST(least(len({WS_TOKENS}), 128) AS INTEGER) AS tokens,
  md5(array_to_string(({WS_TOKENS})[1:128], ' ')) AS digest FROM documents""",
        "report_lines": with_corpus(
            """SELECT line, name, printf('%.4f', value) AS short, printf('%.1f%%', 100 * value) AS pct FROM named""", counts, s, NAMED),
        "fixed_point_ties": "SELECT doc_id, " + ", ".join(
            f"printf('%.{digits}f', (doc_id + {add}::DOUBLE) / {by}::DOUBLE) AS of{by}_{digits}"
            for by, add in ((16, 0), (32, 0), (100, 0.05)) for digits in (1, 3, 4)) + " FROM documents",
        "score_file_lines": with_corpus(
            "SELECT line, name || ':' || CAST(value AS VARCHAR) AS value FROM named", counts, s, NAMED),
        "best_trial": with_corpus(
            "SELECT country, epoch, best_tuned_f1, threshold FROM log QUALIFY row_number() OVER (PARTITION BY country ORDER BY best_tuned_f1 DESC, epoch) = 1",
            *trial_log()),
        "best_so_far": with_corpus(
            """SELECT *, best_tuned_f1 > best_before AS improved FROM (
  SELECT *, (SELECT coalesce(max(o.best_tuned_f1), 0.0::DOUBLE) FROM log o WHERE o.country = log.country AND o.epoch < log.epoch) AS best_before FROM log)""",
            *trial_log()),
        "graded_file": with_corpus(
            r"""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_no, CAST(doc_id AS VARCHAR) AS par_id, '@art' AS art_id, keyword, country,
  md5(""" + ONE_LINE + """) AS text, label, orig_label FROM corpus"""),
        "quoted_file": with_corpus(
            r"""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_no, CAST(doc_id AS VARCHAR) AS par_id, '@art' AS art_id, keyword, country,
  md5('say "' || text || '"' || chr(9) || '.') AS text, label, orig_label FROM corpus"""),
        "annotation_file": rf"""WITH {annotations()},
numbered AS (SELECT doc_id, keyword, text, tag_no, row_number() OVER (ORDER BY row_no) - 1 AS row_no FROM ann),
seen AS (SELECT doc_id, keyword, text, tag_no, min(row_no) AS first_at FROM numbered GROUP BY ALL)
SELECT CAST(min(first_at) AS BIGINT) AS row_no, CAST(doc_id AS VARCHAR) AS par_id, keyword, md5({ONE_LINE}) AS text,
  string_agg(CAST(tag_no AS VARCHAR), ',' ORDER BY first_at) AS ids FROM seen GROUP BY doc_id, keyword, text""",
        "unlabelled_file": rf"""SELECT 2 * (row_number() OVER (PARTITION BY line ORDER BY doc_id) - 1) + line AS row_no, CAST(doc_id AS VARCHAR) AS par_id,
  '@art' AS art_id, source AS keyword, lang AS country, CASE WHEN line = 0 THEN md5({ONE_LINE}) END AS text
FROM documents, (VALUES (0), (1)) AS lines(line)""",
        "split_file": f"""WITH {vectors()} SELECT row_number() OVER (ORDER BY v.doc_id DESC) - 1 AS row_no, CAST(v.doc_id AS VARCHAR) AS par_id,
  CAST(list_sum(gold) >= 2 AS INTEGER) AS label, CASE WHEN l.doc_id IS NOT NULL THEN len(d.text) END AS chars
FROM vectors v JOIN documents d ON d.doc_id = v.doc_id LEFT JOIN labels l ON l.doc_id = v.doc_id""",
        "row_numbers": "SELECT row_number() OVER (ORDER BY len(text) DESC, doc_id) - 1 AS row_no, doc_id FROM documents",
        "stored_probabilities": with_corpus(
            "SELECT doc_id AS row_no, score AS prob, CAST(score >= CAST(0.12 AS FLOAT) AS INTEGER) AS pred FROM corpus"),
        "metrics_log": with_corpus("SELECT country, epoch, threshold, best_tuned_f1 FROM log", *trial_log()),
        "label_file_scores": with_corpus(f"SELECT *, {SCORES} FROM c", counts),
        "vector_file_scores": multilabel(),
        "submission_scores": f"SELECT line, name, value FROM ({with_corpus('SELECT * FROM named', counts, s, NAMED)})"
        f" UNION ALL SELECT position + 3, 'task2_' || label, f1 FROM ({multilabel()})",
        "classifier_checks": "SELECT lang, count(*) AS n, count(*) AS n_ids, count(*) AS n_probabilities, count(*) AS n_decisions FROM documents GROUP BY lang",
        "epoch_checks": "SELECT CAST(epoch AS INTEGER) AS epoch, true AS falls, true AS on_grid, true AS finite_loss, true AS possible_f1 FROM range(1, 11) AS epochs(epoch)",
        "focal_gradient": with_corpus(
            """SELECT CAST(feature AS INTEGER) AS feature, round(coalesce(value, 0) / (SELECT count(*) FROM corpus), 9) AS value
FROM range(66) AS features(feature) LEFT JOIN (
  SELECT f AS feature, sum(CASE WHEN f = 65 THEN loss WHEN f = 64 THEN slope ELSE slope / 4 END) AS value
  FROM (SELECT slope, loss, unnest(list_concat(words, [64, 65])) AS f FROM slopes) GROUP BY f
) USING (feature)""",
            """words AS (SELECT label, [len(text) % 32, 32 + score_milli % 16, 48 + doc_id % 16, 48 + score_milli % 7] AS words FROM corpus)""",
            """margins AS (SELECT *, (64 * 37 % 101)::DOUBLE / 50 - 1 + list_sum(list_transform(words, lambda f: (f * 37 % 101)::DOUBLE / 50 - 1)) / 4 AS m FROM words)""",
            """own AS (SELECT *, 1 / (1 + exp(CASE WHEN label = 1 THEN -m ELSE m END)) AS p, CASE WHEN label = 1 THEN 2.0 ELSE 0.5 END::DOUBLE AS a FROM margins)""",
            """slopes AS (SELECT words, a * (1 - p) ** 2 * -(0.9::DOUBLE * ln(p) + 0.1::DOUBLE * ln(1 - p)) AS loss,
  -- the loss by p, times the derivative of p by the log-odds
  CASE WHEN label = 1 THEN 1 ELSE -1 END * p * (1 - p) * a * (2 * (1 - p) * (0.9::DOUBLE * ln(p) + 0.1::DOUBLE * ln(1 - p)) - (1 - p) ** 2 * (0.9::DOUBLE / p - 0.1::DOUBLE / (1 - p))) AS slope FROM own)"""),
        "trial_checks": "SELECT CAST(epoch AS INTEGER) AS epoch, true AS on_grid, true AS finite_loss, true AS possible_f1 FROM (VALUES (1), (2)) AS trials(epoch)",
    }


def reversed_pair(ctes_and_select: str) -> tuple[str, str]:
    """Split a list of CTEs from the select that follows, for ``with_corpus``."""
    head, _, tail = ctes_and_select.rpartition("\nSELECT class AS")
    return "SELECT class AS" + tail, head.strip()
