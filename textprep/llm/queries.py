"""The registered query of each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from textprep.llm import (
    exact_dedup,
    hard_negatives,
    jaccard_join,
    language_id,
    licenses,
    minhash,
    mixing,
    packing,
    phrases,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    toxicity,
)
from textprep.llm.columns import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        F.round("quality", 6).alias("quality"),
    )


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), size=4, percent=85)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_languages(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_spans(table(spark, sf_dir, "documents")).drop("spans")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.withColumn("dice", F.round("dice", 6))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "pipeline": corpus_pipeline.run,
    **{f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_toxicity,
        op3_quality_rules,
        op4_quality_classifier,
        op5_ngram_jaccard,
        op6_best_fit_packing,
        op7_mixing,
        op8_language_id,
        op9_suffix_dedup,
        op10_license_scan,
        op11_minhash,
        op12_collocations,
        op13_hard_negatives,
    )},
}


def _license_sql() -> str:
    """Dice over word bigrams of all candidates and templates that share one."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    templates = ", ".join(f"({k}, {quoted(name)}, {quoted(body)})" for k, (name, body) in enumerate(licenses.TEMPLATES))
    return rf"""
        WITH t AS (
            SELECT rank, name, regexp_extract_all(lower(body), '[\p{{L}}\p{{N}}]+') AS w FROM (VALUES {templates}) v(rank, name, body)
        ),
        tg AS (SELECT DISTINCT rank, name, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i+1])) AS g FROM t),
        tn AS (SELECT rank, any_value(name) AS name, count(*) AS n FROM tg GROUP BY rank),
        pieces AS (
            SELECT DISTINCT ON (doc_id, piece) doc_id, piece, pos FROM (
                SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS pos FROM (
                    SELECT doc_id, list_concat(string_split_regex(c, '\r?\n'),
                        list_filter(string_split_regex(c, '\r?\n[\x20\x09\x0B-\x0D]*\r?\n[\x20\x09-\x0D]*'), lambda b: contains(b, chr(10)))) AS p
                    FROM (SELECT doc_id, coalesce(text, '') AS c FROM documents)
                )
            ) WHERE length(piece) > 1 ORDER BY doc_id, piece, pos
        ),
        worded AS (SELECT doc_id, piece, pos, regexp_extract_all(lower(piece), '[\p{{L}}\p{{N}}]+') AS w FROM pieces),
        pg AS (SELECT DISTINCT doc_id, piece, pos, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i+1])) AS g FROM worded),
        pn AS (SELECT doc_id, pos, any_value(piece) AS piece, count(*) AS m FROM pg GROUP BY doc_id, pos),
        shared AS (SELECT doc_id, pos, rank, count(*) AS o FROM pg JOIN tg USING (g) GROUP BY ALL),
        best AS (
            SELECT doc_id, pos, piece, name, rank, 2.0::DOUBLE * o / (m + n) AS d FROM shared JOIN pn USING (doc_id, pos) JOIN tn USING (rank)
            WHERE 2.0::DOUBLE * o / (m + n) >= {licenses.MIN_DICE}::DOUBLE
            QUALIFY row_number() OVER (PARTITION BY doc_id, pos ORDER BY d DESC, rank) = 1
        ),
        found AS (
            SELECT doc_id, count(*) AS n_statements, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses,
                arg_min(struct_pack(name := name, d := d, piece := piece), struct_pack(d := -d, rank := rank, pos := pos)) AS top
            FROM best GROUP BY doc_id
        )
        SELECT doc_id, f.top.name AS license, round(coalesce(f.top.d, 0), 6) AS dice, coalesce(n_statements, 0) AS n_statements,
            coalesce(licenses, '') AS licenses, f.top.piece AS statement
        FROM documents LEFT JOIN found f USING (doc_id)
    """


def _component_sql(size: int, percent: int, more: str = "") -> str:
    """Components of documents linked by the Jaccard similarity of their word shingles."""
    return rf"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ),
        shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - {size} + 2), lambda i: array_to_string(w[i:i+{size}-1], ' ')) END) AS g
            FROM words
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o
            FROM shingles x JOIN shingles y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL
        ),
        links AS (
            SELECT a, b FROM common JOIN sizes s ON a = s.doc_id JOIN sizes t ON b = t.doc_id
            WHERE 100 * o >= {percent} * (s.n + t.n - o)
        ),
        reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
        SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, coalesce(r.low, d.doc_id) AS component_id{more}
        FROM documents d LEFT JOIN sizes s USING (doc_id)
        LEFT JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a) r USING (doc_id)
    """


SQL: dict[str, str] = {
    "op10_license_scan": _license_sql(),
    "op1_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
        )
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY t)
    """,
    "op12_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
            FROM documents
        ),
        grams AS (
            SELECT lang, unnest(list_concat(
                w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i+1]),
                list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])
            )) AS phrase FROM pieces
        ),
        f AS (SELECT lang, phrase, count(*) AS f, len(string_split(phrase, ' ')) AS size FROM grams GROUP BY ALL),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
        cand AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
        inner_pairs AS (
            SELECT lang, part AS phrase, max(f) AS cover FROM (
                SELECT lang, f, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS part FROM cand WHERE size = 3
            ) GROUP BY ALL
        ),
        bare AS (
            SELECT c.* FROM cand c LEFT JOIN inner_pairs i ON c.lang = i.lang AND c.phrase = i.phrase
            WHERE i.cover IS NULL OR 100 * i.cover < 50 * c.f
        ),
        cuts AS (
            SELECT lang, phrase, f AS a, unnest(range(1, size)) AS k, w FROM bare
        ),
        parted AS (
            SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
            FROM cuts c
            JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
            JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k+1:], ' ')
            QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.k) = 1
        )
        SELECT lang, row_number() OVER best AS rank, phrase, a, l, r, n, score FROM parted JOIN n USING (lang)
        WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
        QUALIFY row_number() OVER best <= 2000
    """,
    "op13_hard_negatives": r"""
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256.0::DOUBLE * x::DOUBLE)) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        s AS (
            SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, list_dot_product(a.q, r.q)::BIGINT AS score
            FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id AND len(a.q) = len(r.q)
        ),
        p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT p.anchor_id, p.id AS positive_id, (row_number() OVER best)::INTEGER AS rank, n.id AS negative_id,
            p.score AS positive_score, n.score AS negative_score
        FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
        WINDOW best AS (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)
        QUALIFY row_number() OVER best <= 5
    """,
    "op5_ngram_jaccard": _component_sql(4, 85),
    "op11_minhash": _component_sql(3, 85, ", coalesce(r.low, d.doc_id) = d.doc_id AS kept"),
    "op7_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
        ),
        per AS (
            SELECT source, encode(source) AS code, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
        ),
        weighed AS (
            SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY code NULLS LAST) - 1) % 3 + 1] AS w,
                2.0::DOUBLE * source_size AS cap FROM per
        ),
        summed AS (
            SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS total, sum(w) OVER () AS w_all,
                coalesce(sum(cap) OVER earlier, 0) AS cap_before, coalesce(sum(w) OVER earlier, 0) AS w_before
            FROM weighed WINDOW earlier AS (ORDER BY cap / w, code NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ),
        levels AS (SELECT *, (total - cap_before) / (w_all - w_before) AS level FROM summed),
        final AS (SELECT level AS common FROM levels WHERE level * w < cap ORDER BY cap / w, level LIMIT 1),
        targets AS (
            SELECT source, source_size, CASE WHEN level * w >= cap THEN cap ELSE common * w END AS target
            FROM levels LEFT JOIN final ON true
        ),
        rated AS (
            SELECT s.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 1 END AS rate
            FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
        ),
        drawn AS (
            SELECT *, floor(rate) + (('0x' || substr(md5((k // 4)::VARCHAR || ':' || coalesce(doc_id::VARCHAR, 'null')), 8 * (k % 4) + 1, 8))::BIGINT
                / 4294967296.0::DOUBLE < rate - floor(rate))::INT AS copies
            FROM rated, range(32) seeds(k)
        ),
        misses AS (SELECT source, k, abs(sum(copies * size) - any_value(target)) AS miss FROM drawn GROUP BY source, k),
        best AS (SELECT source, k FROM misses QUALIFY row_number() OVER (PARTITION BY source ORDER BY miss, k) = 1)
        SELECT d.doc_id, d.size, d.source_size, d.target, (d.copies * d.size)::BIGINT AS taken
        FROM drawn d JOIN best b ON d.source IS NOT DISTINCT FROM b.source AND d.k = b.k
    """,
}
