"""The queries of the corpus operators over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedloom.llm import (
    divergence, exact_dedup, language, leaks, line_dedup, lm, near_dedup, packing, pieces, pii, spelling, topk_search, url_filter,
)
from feedloom.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with its SQL form where there is one."""

    def register(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query(r"""
WITH lines AS (
    SELECT doc_id, line, raw, trim(regexp_replace(raw, '[\x20\x09\x0B-\x0D]+', ' ', 'g')) AS clean
    FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line FROM documents)
), worded AS (
    SELECT doc_id, line, clean, len(string_split(clean, ' ')) AS words,
        row_number() OVER (PARTITION BY doc_id ORDER BY line) AS n
    FROM lines WHERE clean <> ''
), pairs AS (
    SELECT a.doc_id AS earlier, b.doc_id, b.line, b.words, b.n - a.n AS shift, b.n
    FROM worded a JOIN worded b ON a.clean = b.clean AND (a.doc_id < b.doc_id OR a.doc_id = b.doc_id AND a.n < b.n)
), runs AS (
    SELECT doc_id, min(line) AS line, max(line) AS last FROM (
        SELECT *, n - row_number() OVER (PARTITION BY earlier, doc_id, shift ORDER BY n) AS island FROM pairs
    ) GROUP BY earlier, doc_id, shift, island HAVING sum(words) >= 50
), gone AS (
    SELECT DISTINCT doc_id, unnest(generate_series(line, last)) AS line FROM runs
)
SELECT l.doc_id AS doc_id, count(*) AS n_lines, count(g.line) AS n_deleted,
    sha256(coalesce(string_agg(raw, chr(10) ORDER BY l.line) FILTER (WHERE g.line IS NULL), '')) AS left_sha256
FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.line = l.line
GROUP BY l.doc_id
""")
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_report(documents(spark, folder))


@query()
def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(documents(spark, folder))


@query(r"""
WITH coded AS (
    SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS code FROM embeddings
), near AS (
    SELECT q.vec_id AS query_id, e.vec_id,
        CAST(len(list_filter(list_zip(q.code, e.code), lambda p: p[1] <> p[2])) AS INTEGER) AS distance
    FROM coded q JOIN coded e ON q.vec_id <> e.vec_id
    WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, distance
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM near)
WHERE rank <= 10
""")
def op3_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.search(spark.read.parquet(f"{folder}/embeddings.parquet"))


@query(r"""
WITH digests AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM digests
WINDOW same AS (PARTITION BY text_sha256)
""".replace("\\\\", "\\"))
def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.dedup(documents(spark, folder))


@query()
def op5_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score(documents(spark, folder))


@query()
def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.digest_pieces(documents(spark, folder), tokenizer_file("piece_bpe_32k.model"))


@query()
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(documents(spark, folder))


@query(r"""
WITH cut AS (
    SELECT page_id,
        CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), named AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), rules(rule, kind, rule_host, rule_path) AS (
    VALUES ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'),
        ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')
), best AS (
    SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(kind, length(rule)) AS kind
    FROM named JOIN rules
        ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id
)
SELECT page_id, host, path, rule,
    coalesce(kind, CASE WHEN regexp_matches(host, '(^|[.-])spam') THEN 'block' ELSE 'allow' END) AS verdict
FROM named LEFT JOIN best USING (page_id)
""")
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_pages(spark.read.parquet(f"{folder}/pages.parquet"))


@query()
def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_groups(documents(spark, folder))


@query()
def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder), tokenizer_file("word_bpe_49k.json"))


@query(r"""
WITH docs AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS row,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), tokens AS (
    SELECT lang, source, term, count(DISTINCT row) AS docs, count(*) AS n
    FROM (SELECT lang, source, row, unnest(terms) AS term FROM docs) GROUP BY ALL
), vocabulary AS (
    SELECT lang, term, sum(n)::HUGEINT AS n FROM tokens GROUP BY lang, term HAVING sum(docs) >= 10
), sizes AS (
    SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM vocabulary GROUP BY lang
), counts AS (
    SELECT t.lang, t.source, t.term, t.n::HUGEINT AS n FROM tokens t JOIN vocabulary USING (lang, term)
), groups AS (
    SELECT g.lang, g.source, coalesce(any_value(v), 0) AS v, coalesce(sum(c.n), 0)::HUGEINT AS total
    FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN sizes USING (lang) LEFT JOIN counts c USING (lang, source)
    GROUP BY g.lang, g.source
), spread AS (
    SELECT g.lang, g.source, t.term, coalesce(c.n, 0) AS count,
        1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (g.total + 2 * g.v) AS p,
        1 + (1000000000 * (t.n + 2)) // (s.n + 2 * s.v) AS q
    FROM groups g JOIN vocabulary t USING (lang) JOIN sizes s USING (lang) LEFT JOIN counts c USING (lang, source, term)
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (
        SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
        FROM spread a JOIN spread b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    ) x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
), found AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM spread WHERE count > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
WHERE part = 'pair' OR rank <= 10
""")
def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(documents(spark, folder))


@query()
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(documents(spark, folder))


@query(r"""
WITH words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
    FROM documents
), items AS (
    SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + 9], ' ') AS run
    FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM items WHERE len(w) > 0)
), places AS (
    SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS run
    FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM words, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
), found AS (
    SELECT doc_id, item_id, size, i FROM places JOIN windows USING (size, run)
), hits AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS k FROM found) GROUP BY doc_id
), met AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hits USING (doc_id) LEFT JOIN met USING (doc_id)
""")
def op13_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    found = leaks.report(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))
    return found.drop("spans")
