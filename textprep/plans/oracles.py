"""The registered queries as ANSI SQL, for checking against another engine."""

from __future__ import annotations

from textprep.config import NA_TOKENS, SEQUENCE_SEPARATORS
from textprep.plans.queries import LABEL_SPELLINGS, NFKC_PAIRS

_W = r"\p{L}\p{N}_"
_S = r"\s\x0b\x1c-\x1f\x85\p{Z}"


def _clean(column: str, emails: bool = True, punctuation: bool = True) -> str:
    """The cleaning rules; this engine has no look-behind and needs none."""
    sql = f"coalesce({column}, '')"

    def replace(pattern: str, by: str = " ") -> None:
        nonlocal sql
        sql = f"regexp_replace({sql}, '{pattern}', '{by}', 'g')"

    replace("<[^>]+>")
    replace(rf"(?i)https?://[^{_S}]+|www\.[^{_S}]+")
    if emails:
        replace(rf"[{_W}][{_W}.\-]*@[{_W}.\-]+\.[{_W}]+")
    replace(rf"(^|[^{_W}])@[A-Za-z0-9_]+", r"\1 ")
    sql = f"lower({sql})"
    replace(r"[^a-z0-9.!?,''\-]+" if punctuation else "[^a-z0-9]+")
    return f"trim({sql})"


_LABELLED = "labelled AS (SELECT d.doc_id AS row_id, d.text, l.quality AS label, d.source FROM documents d JOIN labels l USING (doc_id))"
_CONFLICTING = "labelled AS (SELECT doc_id AS row_id, text, (doc_id % 2)::INT AS label FROM documents)"
_CLEANED = f"""cleaned AS (SELECT * FROM (SELECT row_id, label, {_clean('text')} AS clean_text FROM labelled)
  WHERE length(clean_text) >= 5)"""
_GROUPS = """groups AS (SELECT clean_text, count(*) AS n, min(label) AS lo, max(label) AS hi, min(row_id) AS first_row
  FROM cleaned GROUP BY clean_text)"""
_KEPT = """kept AS (SELECT c.* FROM cleaned c JOIN groups g ON c.row_id = g.first_row WHERE g.lo = g.hi)"""


def _stage_sql(name: str, source: str, fraction: str) -> str:
    """Rows per label left after holding out a fraction, by largest remainder."""
    return f"""{name}_a AS (SELECT label, c, sum(c) OVER ()::BIGINT AS n FROM {source}),
{name}_b AS (SELECT label, c, n, n - ceil({fraction}::DOUBLE * n)::BIGINT AS draws FROM {name}_a),
{name}_c AS (SELECT label, c, draws, (c * draws) // n AS base, (c * draws) % n AS rem FROM {name}_b),
{name} AS (SELECT label, c AS before, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, label)
  <= draws - sum(base) OVER () THEN 1 ELSE 0 END AS c FROM {name}_c)"""


_SPLIT = f"""cnt AS (SELECT label, count(*) AS c FROM kept GROUP BY label),
{_stage_sql('s1', 'cnt', '0.2')},
{_stage_sql('s2', 's1', '0.1')},
ranked AS (SELECT kept.*, row_number() OVER (PARTITION BY kept.label ORDER BY md5('42:' || row_id), row_id) AS rk FROM kept),
done AS (SELECT r.row_id, r.label, r.clean_text,
  CASE WHEN rk <= s1.before - s1.c THEN 'test' WHEN rk <= (s1.before - s1.c) + (s2.before - s2.c) THEN 'val' ELSE 'train' END AS split
  FROM ranked r JOIN s1 ON r.label = s1.label JOIN s2 ON r.label = s2.label)"""

_PREPARED = f"{_LABELLED}, {_CLEANED}, {_GROUPS}, {_KEPT}"
_PREPARED_CONFLICTING = f"{_CONFLICTING}, {_CLEANED}, {_GROUPS}, {_KEPT}"
_DONE = f"{_PREPARED}, {_SPLIT}"
_PARTS = """parts AS (SELECT split AS part, label, clean_text FROM done UNION ALL SELECT 'full', label, clean_text FROM done)"""

_SPELLED = "[" + ", ".join(f"'{s}'" for s in LABEL_SPELLINGS) + "]"
_RAW = f"""raw AS (SELECT doc_id AS row_id, text, {_SPELLED}[(doc_id % {len(LABEL_SPELLINGS)}) + 1] AS raw_label FROM documents),
coerced AS (SELECT row_id, text, CASE WHEN regexp_full_match(raw_label, '\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*')
  THEN trunc(trim(raw_label)::DOUBLE)::BIGINT END AS label FROM raw)"""

_PRESPLIT = """numbered AS (SELECT doc_id, text, ('0x' || substr(md5(doc_id::VARCHAR), 1, 4))::INT % 100 AS b FROM documents),
rows AS (SELECT doc_id AS row_id, text, coalesce(text, '') AS k, (doc_id % 2)::INT AS label,
  CASE WHEN b < 72 THEN 'train' WHEN b < 80 THEN 'val' ELSE 'test' END AS split FROM numbered)"""
_TEXTS = """texts AS (SELECT k, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val,
  count(*) FILTER (split = 'test') AS test FROM rows GROUP BY k)"""
_AFTER = """after_rows AS (SELECT * FROM rows WHERE split = 'train' OR k NOT IN (SELECT k FROM rows WHERE split = 'train'))"""


def _overlap(texts: str = "texts") -> str:
    return f"""SELECT count(*) FILTER (train > 0 AND val > 0) AS train_val, count(*) FILTER (train > 0 AND test > 0) AS train_test,
  count(*) FILTER (val > 0 AND test > 0) AS val_test, count(*) FILTER (train > 0 AND val > 0 AND test > 0) AS triple_overlap FROM {texts}"""


def _conflicts(rows: str) -> str:
    pairs = (("train", "val"), ("train", "test"), ("val", "test"))
    sets = f"SELECT text, split, list_sort(list(DISTINCT label)) AS s FROM {rows} WHERE text IS NOT NULL GROUP BY text, split"
    one = [
        f"(SELECT count(*) FROM ({sets}) a JOIN ({sets}) b USING (text) "
        f"WHERE a.split = '{a}' AND b.split = '{b}' AND a.s <> b.s) AS {a}_{b}"
        for a, b in pairs
    ]
    return "SELECT " + ", ".join(one)


def _audit_lines(stage: str, rows: str) -> str:
    texts = _TEXTS.replace("FROM rows", f"FROM {rows}").replace("texts AS ", "", 1)
    return f"""SELECT '{stage}' AS stage, s.*, o.*, c.train_test AS conflicts_train_test FROM
  (SELECT split, count(*) AS rows, count(DISTINCT k) AS unique_texts, count(*) - count(DISTINCT k) AS duplicate_within_split
   FROM {rows} GROUP BY split) s, ({_overlap(texts)}) o, ({_conflicts(rows)}) c"""


_SMALL = f"""{_LABELLED}, scores AS (SELECT row_id, source, label,
  0.35::DOUBLE * label + 0.65::DOUBLE * ((row_id * 7919) % 1000)::DOUBLE / 999.0::DOUBLE AS prob FROM labelled)"""
_LARGE = """scores AS (SELECT (l_returnflag = 'R')::INT AS label,
  ((l_orderkey * 31 + l_linenumber * 17) % 1000)::DOUBLE / 999.0::DOUBLE AS prob FROM lineitem)"""
_LOGITS = f"""{_SMALL}, logits AS (SELECT row_id, label, ln((prob + 0.001::DOUBLE) / (1.001::DOUBLE - prob)) AS z FROM scores),
soft AS (SELECT row_id, label, exp(z - greatest(z, 0)) / (exp(0 - greatest(z, 0)) + exp(z - greatest(z, 0))) AS prob FROM logits)"""


def _counts(scores: str = "scores", by: str = "") -> str:
    return f"""counts AS (SELECT {by + ',' if by else ''} count(*) FILTER (label = 0 AND prob < 0.5::DOUBLE) AS tn,
  count(*) FILTER (label = 0 AND prob >= 0.5::DOUBLE) AS fp, count(*) FILTER (label = 1 AND prob < 0.5::DOUBLE) AS fn,
  count(*) FILTER (label = 1 AND prob >= 0.5::DOUBLE) AS tp FROM {scores} {'GROUP BY ' + by if by else ''})"""


def _ratio(top: str, bottom: str) -> str:
    return f"CASE WHEN ({bottom}) > 0 THEN ({top})::DOUBLE / ({bottom}) ELSE 0.0::DOUBLE END"


_P1, _R1, _F1 = _ratio("tp", "tp + fp"), _ratio("tp", "tp + fn"), _ratio("2 * tp", "2 * tp + fp + fn")
_P0, _R0, _F0 = _ratio("tn", "tn + fn"), _ratio("tn", "tn + fp"), _ratio("2 * tn", "2 * tn + fp + fn")
_ACC = _ratio("tn + tp", "tn + fp + fn + tp")


def _auc(scores: str = "scores", by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    keys = f"{by}, " if by else ""
    return f"""tied AS (SELECT {keys}prob, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM {scores} GROUP BY {keys}prob),
below AS (SELECT *, sum(neg) OVER ({part} ORDER BY prob) - neg AS lower FROM tied),
auc AS (SELECT {keys}CASE WHEN sum(pos) * sum(neg) > 0 THEN sum(pos * (2 * lower + neg))::DOUBLE / (2 * sum(pos) * sum(neg))::DOUBLE END AS roc_auc
  FROM below {'GROUP BY ' + by if by else ''})"""


_BOARD = f"""{_SMALL}, {_counts(by='source')}, {_auc(by='source')},
board AS (SELECT source AS model_name, 'test' AS split, tn + fp + fn + tp AS num_samples, round({_ACC}, 6) AS accuracy,
  round({_P1}, 6) AS precision, round({_R1}, 6) AS recall, round({_F1}, 6) AS f1, round(roc_auc, 6) AS roc_auc,
  {_F1} AS f1_full, auc.roc_auc AS auc_full FROM counts JOIN auc USING (source))"""


def _sweep(scores: str) -> str:
    return f"""tied AS (SELECT prob, sum(label) AS pos, count(*) - sum(label) AS neg FROM {scores} GROUP BY prob),
thresholds AS (SELECT 0.1::DOUBLE + i * ((0.1::DOUBLE + 0.01::DOUBLE) - 0.1::DOUBLE) AS thr FROM range(81) r(i)),
cells AS (SELECT thr, coalesce(sum(pos) FILTER (prob >= thr), 0) AS tp, coalesce(sum(neg) FILTER (prob >= thr), 0) AS fp,
  coalesce(sum(pos) FILTER (prob < thr), 0) AS fn FROM tied CROSS JOIN thresholds GROUP BY thr),
best AS (SELECT thr, {_F1} AS f1 FROM cells ORDER BY f1 DESC, thr LIMIT 1)"""


def _report_line(name: str, p: str, r: str, f: str, n: str) -> str:
    return (
        f"SELECT '{name}' AS line, round({p}, 6) AS precision, round({r}, 6) AS recall, "
        f"round({f}, 6) AS f1_score, ({n})::DOUBLE AS support FROM counts"
    )


def _mean(a: str, b: str) -> str:
    return f"(({a}) + ({b})) / 2"


def _weighted(a: str, b: str) -> str:
    return f"(({a}) * (tn + fp) + ({b}) * (fn + tp)) / (tn + fp + fn + tp)"


_GRAMS = r"""tok AS (SELECT row_id, regexp_extract_all(lower(clean_text), '[\p{L}\p{N}_]{2,}') AS t FROM cleaned),
grams AS (SELECT row_id, unnest(list_concat(t, list_concat(
  list_transform(range(1, len(t)), lambda i: array_to_string(t[i:i+1], ' ')),
  list_transform(range(1, len(t) - 1), lambda i: array_to_string(t[i:i+2], ' '))))) AS term FROM tok),
per_row AS (SELECT row_id, term, count(*) AS n FROM grams GROUP BY row_id, term),
stats AS (SELECT term, sum(n)::BIGINT AS tf, count(*) AS df FROM per_row GROUP BY term)"""
_VOCAB = """docs AS (SELECT count(*) AS n_docs FROM cleaned),
chosen AS (SELECT stats.*, n_docs FROM stats, docs WHERE df >= 2 AND df <= 0.95::DOUBLE * n_docs ORDER BY tf DESC, term LIMIT 120000),
vocab AS (SELECT term, (row_number() OVER (ORDER BY term) - 1)::INT AS id, tf, df, ln((1 + n_docs)::DOUBLE / (1 + df)) + 1 AS idf FROM chosen)"""
_WEIGHTS = """raw_weights AS (SELECT row_id, id, (1 + ln(n)) * idf AS w FROM per_row JOIN vocab USING (term)),
norms AS (SELECT row_id, sqrt(sum(w * w)) AS norm FROM raw_weights GROUP BY row_id)"""
_FEATURES = f"{_LABELLED}, {_CLEANED}, {_GRAMS}, {_VOCAB}"

_SEPARATORS = SEQUENCE_SEPARATORS.replace("\t", "").replace("\n", "")
_WORDS = f"""lists AS (SELECT row_id, list_filter(string_split(translate(lower(clean_text), '{_SEPARATORS}' || chr(9) || chr(10),
  repeat(' ', {len(SEQUENCE_SEPARATORS)})), ' '), lambda x: x <> '') AS w FROM cleaned),
placed AS (SELECT row_id, unnest(w) AS term, unnest(range(1, len(w) + 1)) AS pos FROM lists),
counted AS (SELECT term, count(*) AS tf, min(row_id) AS first_row FROM placed GROUP BY term),
firsts AS (SELECT c.term, c.tf, c.first_row, min(p.pos) AS first_pos FROM counted c JOIN placed p ON p.term = c.term AND p.row_id = c.first_row
  GROUP BY c.term, c.tf, c.first_row),
words AS (SELECT term, (row_number() OVER (ORDER BY tf DESC, first_row, first_pos) + 1)::INT AS id, tf FROM firsts)"""


def _encoded(cut: str) -> str:
    return f"""WITH {_LABELLED}, {_CLEANED}, {_WORDS},
vocab AS (SELECT * FROM words WHERE id < 2000),
cut AS (SELECT row_id, {cut} AS w FROM lists),
cells AS (SELECT row_id, unnest(w) AS term, unnest(range(1, len(w) + 1)) AS pos FROM cut),
ids AS (SELECT row_id, list(coalesce(id, 1) ORDER BY pos) AS ids FROM cells LEFT JOIN vocab USING (term) GROUP BY row_id),
filled AS (SELECT cut.row_id, coalesce(ids.ids, []::INT[]) AS ids FROM cut LEFT JOIN ids USING (row_id))
SELECT row_id, array_to_string(list_concat(ids, list_transform(range(500 - len(ids)), lambda i: 0)), ' ') AS ids,
  array_to_string(list_concat(list_transform(ids, lambda i: 1), list_transform(range(500 - len(ids)), lambda i: 0)), ' ') AS mask FROM filled"""


# The vocabulary of the training split, applied to all splits.
_TRAIN_WORDS = _WORDS.replace("FROM cleaned", "FROM done WHERE split = 'train'")
_JOB_ENCODED = f"""{_DONE}, {_TRAIN_WORDS}, vocab AS (SELECT * FROM words WHERE id < 2000),
{_WORDS.split(",\nplaced")[0].replace("lists AS", "all_lists AS").replace("FROM cleaned", "FROM done")},
cut AS (SELECT row_id, CASE WHEN len(w) <= 500 THEN w ELSE list_concat(w[1:250], w[len(w) - 249:len(w)]) END AS w FROM all_lists),
word_cells AS (SELECT row_id, unnest(w) AS term, unnest(range(1, len(w) + 1)) AS pos FROM cut),
found AS (SELECT row_id, list(coalesce(id, 1) ORDER BY pos) AS ids FROM word_cells LEFT JOIN vocab USING (term) GROUP BY row_id),
encoded AS (SELECT done.row_id, done.label, done.split, coalesce(found.ids, []::INT[]) AS ids FROM done LEFT JOIN found USING (row_id))"""
_JOB_SCORED = f"""{_JOB_ENCODED}, odds AS (SELECT label, split, (coalesce(list_sum(ids), 0)::BIGINT % 1000)::DOUBLE / 250.0::DOUBLE - 2.0::DOUBLE AS z
  FROM encoded WHERE split <> 'train'),
scores AS (SELECT label, split, exp(z - greatest(z, 0)) / (exp(0 - greatest(z, 0)) + exp(z - greatest(z, 0))) AS prob FROM odds),
{_sweep("(SELECT * FROM scores WHERE split = 'val')")}"""

_BY_ROW_NFKC = (
    f"CASE doc_id % {len(NFKC_PAIRS)} " + " ".join(f"WHEN {i} THEN '{form}'" for i, (_, form) in enumerate(NFKC_PAIRS)) + " END"
)
# Probabilities of a classifier whose coefficients follow a rule.
_GIVEN_ODDS = "coalesce(sum(w / norm * (((id * 7919) % 1000)::DOUBLE / 500.0::DOUBLE - 1.0::DOUBLE)), 0) + 0.25::DOUBLE AS z"
_TRAIN_FEATURES = ", ".join(
    [
        _GRAMS.replace("FROM cleaned", "FROM done").replace(
            "FROM per_row GROUP BY term", "FROM per_row JOIN (SELECT row_id FROM done WHERE split = 'train') USING (row_id) GROUP BY term"
        ),
        _VOCAB.replace("FROM cleaned", "FROM done WHERE split = 'train'"),
        _WEIGHTS,
    ]
)


def _at(threshold: str, scores: str) -> str:
    return _counts(scores).replace("0.5::DOUBLE", threshold)


SQL: dict[str, str] = {
    "clean_documents": f"SELECT doc_id AS row_id, {_clean('text')} AS clean_text FROM documents",
    "clean_pages_text": f"SELECT page_id, {_clean('html')} AS clean_text FROM pages",
    "clean_strict": f"SELECT doc_id AS row_id, {_clean('text', emails=False, punctuation=False)} AS clean_text FROM documents",
    "label_coercion": f"WITH {_RAW} SELECT row_id, label FROM coerced WHERE label IS NOT NULL",
    "label_share_clean": f"""WITH {_PREPARED} SELECT label, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM kept GROUP BY label""",
    "dedup_keep_first": f"WITH {_PREPARED_CONFLICTING} SELECT row_id, label, clean_text FROM kept",
    "dedup_stats": f"""WITH {_PREPARED_CONFLICTING} SELECT sum(n)::BIGINT AS rows_before,
  coalesce(sum(n) FILTER (lo < hi), 0)::BIGINT AS conflicting_text_rows_dropped,
  coalesce(sum(n - 1) FILTER (lo = hi), 0)::BIGINT AS exact_text_duplicates_dropped,
  count(*) FILTER (lo = hi) AS rows_after FROM groups""",
    "drop_conflicts": f"""WITH {_PREPARED_CONFLICTING} SELECT row_id, label FROM cleaned
  WHERE clean_text IN (SELECT clean_text FROM groups WHERE lo = hi)""",
    "conflict_rows": f"""WITH {_PREPARED_CONFLICTING} SELECT row_id, label FROM cleaned
  WHERE clean_text IN (SELECT clean_text FROM groups WHERE lo < hi)""",
    "row_funnel": f"""WITH {_RAW}, labelled AS (SELECT row_id, text, label FROM coerced WHERE label IN (0, 1)), {_CLEANED}, {_GROUPS}, {_KEPT}
SELECT (SELECT count(*) FROM raw) AS rows_before, (SELECT count(label) FROM coerced) AS rows_with_label,
  (SELECT count(*) FROM labelled) AS rows_with_binary_label, (SELECT count(*) FROM cleaned) AS rows_long_enough,
  (SELECT count(*) FROM kept) AS rows_after, (SELECT count(*) FROM raw) - (SELECT count(*) FROM kept) AS rows_dropped""",
    "stratified_split": f"WITH {_DONE} SELECT row_id, label, split FROM done",
    "split_sizes": f"WITH {_PREPARED_CONFLICTING}, {_SPLIT} SELECT split, label, count(*) AS n FROM done GROUP BY split, label",
    "prep_report": f"""WITH {_DONE}, {_PARTS} SELECT part, count(*) AS num_samples,
  round(sum(length(clean_text))::DOUBLE / count(*), 6) AS mean_length,
  round((count(*) FILTER (label = 0))::DOUBLE / count(*), 6) AS share_0, round((count(*) FILTER (label = 1))::DOUBLE / count(*), 6) AS share_1,
  (SELECT count(*) FROM (SELECT clean_text FROM done GROUP BY clean_text HAVING count(DISTINCT split) = 3)) AS triple_overlap,
  5::BIGINT AS min_text_length FROM parts GROUP BY part""",
    "label_distribution": f"""WITH {_DONE}, {_PARTS} SELECT part AS split, label::VARCHAR AS label,
  round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY part), 6) AS share FROM parts GROUP BY part, label""",
    "length_stats": f"""WITH {_DONE}, {_PARTS} SELECT part AS split, count(*) AS num_samples,
  round(sum(length(clean_text))::DOUBLE / count(*), 6) AS mean_length FROM parts GROUP BY part""",
    "length_histogram": f"""WITH {_PRESPLIT} SELECT split, label, (length(text) // 500 * 500)::BIGINT AS length_from, count(*) AS n
  FROM rows GROUP BY ALL""",
    "write_read_splits": f"WITH {_DONE} SELECT row_id, label, length(clean_text)::INT AS n_chars FROM done WHERE split = 'test'",
    "prepare_job": f"WITH {_DONE} SELECT row_id, label, split FROM done",
    "na_tokens": f"""WITH v AS (SELECT doc_id AS row_id, CASE WHEN doc_id % 3 = 0 THEN text
  ELSE {list((*NA_TOKENS, "na", "Null", " NA", "none", "text"))}[doc_id % {len(NA_TOKENS) + 5} + 1] END AS value
  FROM documents) SELECT row_id, CASE WHEN value NOT IN {NA_TOKENS} THEN value END AS value FROM v""",
    "nfkc_strings": f"SELECT doc_id AS row_id, {_BY_ROW_NFKC} AS value FROM documents",
    "nfkc_texts": f"SELECT doc_id AS row_id, replace(text, ' ', ' ' || {_BY_ROW_NFKC}) AS value FROM documents",
    "report_document": f"""WITH {_DONE}, {_PARTS} SELECT part, count(*) AS num_samples,
  round(sum(length(clean_text))::DOUBLE / count(*), 6) AS mean_length, (SELECT count(*) FROM labelled) AS rows_read,
  (SELECT count(*) FROM labelled) - (SELECT count(*) FROM done) AS rows_dropped FROM parts GROUP BY part""",
    "train_job": f"WITH {_DONE} SELECT split, count(*) AS n, true AS at_minimum FROM done GROUP BY split",
    "score_job": f"""WITH {_DONE} SELECT 'tfidf_logreg' AS model_kind, 'test' AS split, count(*) AS num_samples,
  0.5::DOUBLE AS threshold_used, true AS as_in_training FROM done WHERE split = 'test'""",
    "encode_job": f"""WITH {_JOB_ENCODED} SELECT row_id, label, split,
  array_to_string(list_concat(ids, list_transform(range(500 - len(ids)), lambda i: 0)), ' ') AS ids FROM encoded""",
    "evaluate_job": f"WITH {_JOB_SCORED} SELECT round(thr, 6) AS threshold, round(f1, 6) AS best_val_f1 FROM best",
    "training_table": f"""WITH {_JOB_SCORED}, {_counts("(SELECT label, split, CASE WHEN prob >= thr THEN 1.0 ELSE 0.0 END::DOUBLE AS prob FROM scores, best)", "split")},
{_auc(by="split").replace("tied AS", "tied_by AS").replace("FROM tied)", "FROM tied_by)")}
SELECT 'fixed' AS model, split, round({_ACC}, 6) AS accuracy, round({_P1}, 6) AS precision, round({_R1}, 6) AS recall,
  round({_F1}, 6) AS f1, round(roc_auc, 6) AS roc_auc FROM counts JOIN auc USING (split)""",
    "read_corpus_csv": f"WITH {_LABELLED}, {_CLEANED} SELECT row_id, label, clean_text FROM cleaned",
    "split_overlap": f"WITH {_PRESPLIT}, {_TEXTS} {_overlap()}",
    "split_stats": f"""WITH {_PRESPLIT} SELECT split, count(*) AS rows, count(DISTINCT k) AS unique_texts,
  count(*) - count(DISTINCT k) AS duplicate_within_split FROM rows GROUP BY split""",
    "overlap_label_conflicts": f"WITH {_PRESPLIT} {_conflicts('rows')}",
    "drop_train_overlap": f"WITH {_PRESPLIT}, {_AFTER} SELECT row_id, split, label FROM after_rows",
    "dropped_eval_rows": f"""WITH {_PRESPLIT}, {_AFTER} SELECT
  (SELECT count(*) FROM rows WHERE split = 'val') - (SELECT count(*) FROM after_rows WHERE split = 'val') AS val_dropped,
  (SELECT count(*) FROM rows WHERE split = 'test') - (SELECT count(*) FROM after_rows WHERE split = 'test') AS test_dropped""",
    "leakage_audit": f"WITH {_PRESPLIT}, {_AFTER} {_audit_lines('before', 'rows')} UNION ALL {_audit_lines('after', 'after_rows')}",
    "class_weights": f"""WITH {_LABELLED} SELECT label, count(*) AS n,
  round(sum(count(*)) OVER ()::DOUBLE / (count(*) OVER () * count(*)), 6) AS weight FROM labelled GROUP BY label""",
    "binary_metrics": f"""WITH {_LARGE}, {_counts()} SELECT round({_ACC}, 6) AS accuracy, round({_P1}, 6) AS precision,
  round({_R1}, 6) AS recall, round({_F1}, 6) AS f1 FROM counts""",
    "confusion_matrix": f"WITH {_LARGE} SELECT label, (prob >= 0.5::DOUBLE)::INT AS pred, count(*) AS n FROM scores GROUP BY ALL",
    "classification_report": f"WITH {_LARGE}, {_counts()} "
    + " UNION ALL ".join(
        [
            _report_line("0", _P0, _R0, _F0, "tn + fp"),
            _report_line("1", _P1, _R1, _F1, "fn + tp"),
            _report_line("macro avg", _mean(_P0, _P1), _mean(_R0, _R1), _mean(_F0, _F1), "tn + fp + fn + tp"),
            _report_line("weighted avg", _weighted(_P0, _P1), _weighted(_R0, _R1), _weighted(_F0, _F1), "tn + fp + fn + tp"),
        ]
    ),
    "roc_auc": f"WITH {_LARGE}, {_auc()} SELECT round(roc_auc, 6) AS roc_auc FROM auc",
    "best_f1_threshold": f"""WITH {_LARGE}, {_sweep('scores')} SELECT round(thr, 6) AS threshold, round(f1, 6) AS best_f1 FROM best""",
    "val_threshold_on_test": f"""WITH {_SMALL}, {_PRESPLIT}, parted AS (SELECT s.*, r.split FROM scores s JOIN rows r USING (row_id)),
{_sweep("(SELECT * FROM parted WHERE split = 'val')")}, counts AS (SELECT count(*) FILTER (label = 0 AND prob < thr) AS tn,
  count(*) FILTER (label = 0 AND prob >= thr) AS fp, count(*) FILTER (label = 1 AND prob < thr) AS fn,
  count(*) FILTER (label = 1 AND prob >= thr) AS tp FROM parted, best WHERE split = 'test')
SELECT round(thr, 6) AS threshold, round(best.f1, 6) AS best_val_f1, round({_F1}, 6) AS test_f1, round({_ACC}, 6) AS test_accuracy
  FROM best, counts""",
    "softmax_prob": f"WITH {_LOGITS} SELECT row_id, round(prob, 6) AS prob FROM soft",
    "checkpoint_metrics": f"""WITH {_LOGITS}, {_counts('soft')}, {_auc('soft')} SELECT round({_ACC}, 6) AS accuracy,
  round({_P1}, 6) AS precision, round({_R1}, 6) AS recall, round({_F1}, 6) AS f1, round(roc_auc, 6) AS roc_auc FROM counts, auc""",
    "rank_models": f"WITH {_BOARD} SELECT model_name, split, num_samples, accuracy, precision, recall, f1, roc_auc FROM board",
    "result_documents": f"WITH {_BOARD} SELECT model_name, split, num_samples, accuracy, precision, recall, f1, roc_auc FROM board",
    "compare_job": f"WITH {_BOARD} SELECT model_name, split, num_samples, accuracy, precision, recall, f1, roc_auc FROM board",
    "best_model": f"""WITH {_BOARD} SELECT model_name, num_samples, f1, roc_auc FROM board
  ORDER BY f1_full DESC NULLS LAST, auc_full DESC NULLS LAST, model_name LIMIT 1""",
    "metrics_long": f"WITH {_BOARD} "
    + " UNION ALL ".join(
        f"SELECT model_name, '{m}' AS metric, {m} AS value FROM board"
        for m in ("accuracy", "precision", "recall", "f1", "roc_auc")
    ),
    "term_stats": f"WITH {_LABELLED}, {_CLEANED}, {_GRAMS} SELECT term, tf, df FROM stats",
    "term_stats_accents": f"""WITH {_LABELLED}, words AS (SELECT row_id,
  unnest(regexp_extract_all(strip_accents(lower(text)), '[{_W}]{{2,}}')) AS term FROM labelled)
SELECT term, count(*) AS tf, count(DISTINCT row_id) AS df FROM words GROUP BY term""",
    "tfidf_vocab": f"WITH {_FEATURES} SELECT term, id, tf, df, round(idf, 6) AS idf FROM vocab",
    "tfidf_weights": f"WITH {_FEATURES}, {_WEIGHTS} SELECT row_id, id, round(w / norm, 6) AS value FROM raw_weights JOIN norms USING (row_id)",
    "tfidf_vectors": f"WITH {_FEATURES}, {_WEIGHTS} SELECT row_id, id, round(w / norm, 6) AS value FROM raw_weights JOIN norms USING (row_id)",
    "word_vocab": f"WITH {_LABELLED}, {_CLEANED}, {_WORDS} SELECT term, id, tf FROM words WHERE id < 12000",
    "encode_sequences_head_tail": _encoded(
        "CASE WHEN len(w) <= 500 THEN w ELSE list_concat(w[1:250], w[len(w) - 249:len(w)]) END"
    ),
    "encode_sequences_post": _encoded("w[1:500]"),
    "score_sequences_job": f"""WITH {_JOB_SCORED}, tested AS (SELECT label, prob, thr FROM scores, best WHERE split = 'test'),
{_at('thr', 'tested')} SELECT 'rnn_family' AS model_kind, 'test' AS split, tn + fp + fn + tp AS num_samples,
  (SELECT round(thr, 6) FROM best) AS threshold_used, round({_ACC}, 6) AS accuracy, round({_F1}, 6) AS f1 FROM counts""",
    "given_coefficients": f"""WITH {_FEATURES}, {_WEIGHTS}, odds AS (SELECT c.row_id, {_GIVEN_ODDS}
  FROM cleaned c LEFT JOIN raw_weights USING (row_id) LEFT JOIN norms USING (row_id) GROUP BY c.row_id)
SELECT row_id, round(1 / (1 + exp(-z)), 6) AS prob FROM odds""",
    "saved_threshold": f"""WITH {_DONE}, {_TRAIN_FEATURES}, odds AS (SELECT d.row_id, d.label, {_GIVEN_ODDS}
  FROM done d LEFT JOIN raw_weights USING (row_id) LEFT JOIN norms USING (row_id) WHERE d.split = 'test' GROUP BY d.row_id, d.label),
tested AS (SELECT label, 1 / (1 + exp(-z)) AS prob FROM odds), {_at('0.55::DOUBLE', 'tested')}
SELECT 'tfidf_logreg' AS model_kind, 'test' AS split, tn + fp + fn + tp AS num_samples, 0.55::DOUBLE AS threshold_used,
  round({_ACC}, 6) AS accuracy, round({_F1}, 6) AS f1 FROM counts""",
    "custom_metric": f"""WITH {_LARGE}, p AS (SELECT label, prob, greatest(least(prob, 1 - 1e-15::DOUBLE), 1e-15::DOUBLE) AS q FROM scores)
SELECT round(-avg(CASE WHEN label = 1 THEN ln(q) ELSE ln(1 - q) END), 6) AS log_loss, round(avg((prob - label) * (prob - label)), 6) AS brier FROM p""",
    "score_batches": """WITH z AS (SELECT doc_id AS row_id, ((length(text) * 7919) % 1000)::DOUBLE / 250.0 - 2.0 AS z FROM documents)
SELECT row_id, round(exp(z - greatest(z, 0)) / (exp(0 - greatest(z, 0)) + exp(z - greatest(z, 0))), 6) AS prob FROM z""",
}
