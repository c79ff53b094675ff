"""The operators as registered queries, with production parameters over whole tables, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import (
    decontaminate,
    line_rules,
    lm_score,
    mixing,
    ngram_join,
    passages,
    quality_model,
    secrets,
    source_divergence,
    token_alignment,
    token_counts,
    url_filters,
    warc,
)
from meterlake.llm.shared import rows_of
from meterlake.session import scratch_path

#: Token limit of a document, and the vocabulary that counts its tokens.
TOKEN_LIMIT = 2048
VOCABULARY = "word_bpe_49k.json"
#: The two vocabularies that are aligned.
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Rules for urls: (verdict, host/path).
URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.prefix_counts(rows_of(spark, sf_dir, "documents"), vocabulary_path(), TOKEN_LIMIT, keep_prefixes=False)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "chars_in_budget")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(rows_of(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess")


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(rows_of(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.archive_pages(rows_of(spark, sf_dir, "pages"), path)
    back = warc.read_warc(spark, path, ["page_id", "payload_length", "payload_sha1", "warc_type", "refers_to_page"])
    return back.select(
        "page_id",
        F.col("payload_length").alias("payload_bytes"),
        F.col("payload_sha1").alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        F.col("refers_to_page").alias("refers_to"),
    )


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.jaccard_components(rows_of(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(rows_of(spark, sf_dir, "documents"), rows_of(spark, sf_dir, "benchmark"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = rows_of(spark, sf_dir, "documents"), rows_of(spark, sf_dir, "labels")
    learned = labels.where(~quality_model.held_out(labels["doc_id"]))
    scored = quality_model.score(docs, quality_model.train(docs, learned))
    return scored.select(
        "doc_id",
        F.coalesce(quality_model.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_texts(rows_of(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_rules.judge_lines(rows_of(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(rows_of(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filters.judge_urls(rows_of(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_documents(
        rows_of(spark, sf_dir, "documents"), vocabulary_path(BYTE_LEVEL), vocabulary_path(PIECES)
    )


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit_sources(rows_of(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_token_counts,
            op2_secrets,
            op3_passages,
            op4_warc,
            op5_ngram_jaccard,
            op6_decontaminate,
            op7_quality,
            op8_lm_score,
            op9_quality_rules,
            op10_mix_sources,
            op11_url_filters,
            op12_token_alignment,
            op13_source_divergence,
        )
    }


# ---------------------------------------------------------------- DuckDB

_WORD = r"[^\x20\x09-\x0D]+"
_SPACE = r"[\x20\x09-\x0D]"


def _sql(pattern: str) -> str:
    """The pattern inside a quoted SQL text."""
    return pattern.replace("'", "''")


def _split(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host, slash + path


ORACLE_SQL = {
    "op4_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, url FROM pages),
        g AS (SELECT html, max(page_id) AS kept FROM p WHERE strlen(html) >= {warc.LEAST_REVISIT} GROUP BY html)
        SELECT page_id, strlen(p.html)::BIGINT AS payload_bytes, sha1(p.html) AS payload_digest,
               CASE WHEN kept IS NOT NULL AND page_id IS DISTINCT FROM kept THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN kept IS NOT NULL AND page_id IS DISTINCT FROM kept THEN kept END AS refers_to
        FROM p LEFT JOIN g ON p.html = g.html""",
    "op5_ngram_jaccard": f"""
        WITH RECURSIVE d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
        s AS (SELECT r, doc_id, list_distinct(CASE
                  WHEN len(w) >= {ngram_join.GRAM} THEN list_transform(range(1, len(w) - {ngram_join.GRAM - 2}), lambda i: hash(array_to_string(w[i:i + {ngram_join.GRAM - 1}], ' ')))
                  WHEN len(w) > 0 THEN [hash(array_to_string(w, ' '))] ELSE [] END) AS grams FROM d),
        g AS (SELECT r, len(grams) AS n, unnest(grams) AS gram FROM s),
        link AS (SELECT a.r AS a, b.r AS b FROM g a JOIN g b ON a.gram = b.gram AND a.r <> b.r
                 GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= {ngram_join.PERCENT} * (a.n + b.n - count(*))),
        reach AS (SELECT r, r AS other FROM s UNION SELECT reach.r, link.b FROM reach JOIN link ON reach.other = link.a)
        SELECT s.doc_id, len(s.grams)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
        FROM s JOIN reach USING (r) JOIN s o ON o.r = reach.other GROUP BY s.r, s.doc_id, len(s.grams)""",
    "op9_quality_rules": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
        w AS (SELECT *, regexp_extract_all(text, '{_WORD}') AS words,
                     list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS lines FROM d),
        places AS (SELECT r, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3),
        grams AS (SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) AS n FROM places),
        covered AS (SELECT r, count(DISTINCT j) AS n_repeat
                    FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM grams WHERE n > 1) GROUP BY r),
        line AS (SELECT r, unnest(list_distinct(lines)) AS l FROM w),
        judged AS (SELECT r, length(regexp_replace(l, '{_SPACE}', '', 'g')) AS solid,
                          length(regexp_replace(l, '[^#*$%&|<>]', '', 'g')) AS signs,
                          length(regexp_replace(l, '[^|]', '', 'g')) AS bars,
                          length(regexp_replace(l, '[^!]', '', 'g')) AS shouts, lower(l) AS low FROM line),
        good AS (SELECT r, sum(solid) AS solid FROM judged
                 WHERE NOT (100 * signs > {line_rules.MOST_SYMBOLS} * solid OR bars >= {line_rules.NAVIGATION_MARKS}
                            OR 100 * shouts > {line_rules.MOST_SHOUTS} * solid
                            OR regexp_matches(low, '{"|".join(line_rules.BOILERPLATE)}')) GROUP BY r),
        t AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
                     length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                     (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                     coalesce(n_repeat, 0)::BIGINT AS n_repeat_words, coalesce(good.solid, 0) AS left_chars
              FROM w LEFT JOIN covered USING (r) LEFT JOIN good USING (r)),
        b AS (SELECT *, n_words < {line_rules.LEAST_WORDS}
                        OR 100 * n_repeat_words > {line_rules.MOST_REPEATED} * n_words AS base_failed FROM t)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND 100 * (word_chars - left_chars) <= {line_rules.MOST_LOST} * word_chars AS kept
        FROM b""",
    "op11_url_filters": rf"""
        WITH RECURSIVE rules(verdict, host, path) AS (VALUES {', '.join(repr((v, *_split(r))) for v, r in URL_RULES)}),
        u AS (SELECT row_number() OVER () AS r, page_id, url, coalesce(html, '') AS html,
                     CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        p AS (SELECT r, page_id, url, html, translate(regexp_extract(rest, '^[^/?#]*'), '{url_filters.UPPER}', '{url_filters.LOWER}') AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) AS query FROM u),
        link AS (SELECT r, host, path, unnest([
                     regexp_extract(list_filter(regexp_extract_all(html, '{_sql(url_filters.LINK_TAG)}'), lambda t: regexp_matches(t, '{_sql(url_filters.IS_CANONICAL)}'))[1], '{_sql(url_filters.HREF)}', ['a', 'b', 'c']),
                     regexp_extract(list_filter(regexp_extract_all(html, '{_sql(url_filters.META_TAG)}'), lambda t: regexp_matches(t, '{_sql(url_filters.IS_REFRESH)}'))[1], '{_sql(url_filters.REFRESH_URL)}()()', ['a', 'b', 'c'])]) AS f
                 FROM p WHERE host <> ''),
        named AS (SELECT r, host, path, replace(trim(f.a || f.b || f.c), '&amp;', '&') AS l FROM link),
        aimed AS (SELECT r, CASE WHEN regexp_matches(l, '^[^/?#]*://') THEN l WHEN l[1:2] = '//' THEN 'any:' || l
                                 WHEN l[1] = '/' THEN 'any://' || host || l WHEN l[1] = '?' THEN 'any://' || host || path || l
                                 ELSE 'any://' || host || CASE WHEN path LIKE '%/%' THEN regexp_extract(path, '^(.*/)', 1) ELSE '/' END || l END AS url
                  FROM named WHERE l <> ''),
        ends AS (SELECT -row_number() OVER () AS r, r AS page, substr(url, strpos(url, '://') + 3) AS rest FROM aimed),
        urls AS (SELECT r, NULL::BIGINT AS page, host, path, query FROM p
                 UNION ALL SELECT r, page, translate(regexp_extract(rest, '^[^/?#]*'), '{url_filters.UPPER}', '{url_filters.LOWER}'),
                                  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) FROM ends),
        fit AS (SELECT urls.r, arg_max(rules.host || rules.path, length(rules.host || rules.path)) AS rule, arg_max(verdict, length(rules.host || rules.path)) AS says
                FROM urls JOIN rules ON (urls.host = rules.host OR ends_with(urls.host, '.' || rules.host)) AND starts_with(urls.path, rules.path) GROUP BY urls.r),
        form AS (SELECT r, page, CASE WHEN host <> '' THEN host || CASE WHEN path = '' THEN '/' ELSE path END || query END AS node FROM urls),
        edge AS (SELECT a.node AS a, b.node AS b FROM form b JOIN form a ON b.page = a.r WHERE a.node <> b.node),
        edges AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
        reach AS (SELECT DISTINCT node AS a, node AS b FROM form WHERE node IS NOT NULL UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
        said AS (SELECT reach.a AS node, max((says = 'allow')::INT) AS allows FROM reach JOIN form ON form.node = reach.b JOIN fit ON fit.r = form.r GROUP BY reach.a)
        SELECT page_id, p.host, p.path, rule, CASE WHEN says IS NOT NULL THEN says WHEN allows = 0 THEN 'block' ELSE 'allow' END AS verdict
        FROM p JOIN form ON form.r = p.r LEFT JOIN fit ON fit.r = p.r LEFT JOIN said ON said.node = form.node""",
    "op13_source_divergence": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          regexp_extract_all(translate(coalesce(text, ''), '{url_filters.UPPER}', '{url_filters.LOWER}'),
                                             '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
        e AS (SELECT lang, source, r, unnest(w) AS term FROM d),
        kept AS (SELECT lang, term, count(*) AS lang_n FROM e GROUP BY lang, term HAVING count(DISTINCT r) >= {source_divergence.LEAST_DOCUMENTS}),
        c AS (SELECT lang, source, term, count(*) AS n FROM e JOIN kept USING (lang, term) GROUP BY ALL),
        v AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
        g AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY lang, source),
        p AS (SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n,
                     1 + ({source_divergence.SCALE}::HUGEINT * (coalesce(n, 0) + 2)) // (total + 2 * v) AS p,
                     1 + ({source_divergence.SCALE}::HUGEINT * (lang_n + 2)) // (lang_total + 2 * v) AS q
              FROM g JOIN v ON g.lang = v.lang JOIN kept ON kept.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
        pv AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
               FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pv.value, 0)::BIGINT AS value
                  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
                  LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
        terms AS (SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM p WHERE n > 0 AND p > q),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
                   FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
        SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= {source_divergence.TOP_TERMS}""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
