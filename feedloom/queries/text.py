"""Text cleaning, words, stems, sentiment and HTML over the documents and pages tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.functions import html, text
from feedloom.functions.stemmer import stem_word
from feedloom.functions.wordlists import BODY_STOP_WORDS, TITLE_STOP_WORDS
from feedloom.operators import aggregates as agg
from feedloom.operators import elements, lookups, shape
from feedloom.operators.quality import contains_ci, valid_records
from feedloom.operators.running import numbered
from feedloom.plans.catalogue import Selectors, listing_elements, venue_catalogue
from feedloom.plans.posts import text_features as text_features_plan
from feedloom.queries.registry import query, spread_table, table
from feedloom.schemas import RECORD_METRICS, STOP_WORDS
from feedloom.session import pinned
from feedloom.sources.readers import local_rows, page_urls

# Fixed value: pages whose addresses one task lists.
LISTED_PAGES = 256

# SQL form of the Unicode white-space and word classes.
_SPACE = r"\s\p{Z}\x{85}\x{1c}-\x{1f}"


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _word_list(words) -> str:
    return ", ".join(_quoted(w) for w in words)


def _clean_sql(column: str) -> str:
    """The body rules as nested replacements."""
    for pattern, replacement in text.BODY_RULES:
        column = f"regexp_replace({column}, {_quoted(pattern)}, {_quoted(replacement)}, 'g')"
    return f"lower({column})"


def _without_sql(tokens: str, words) -> str:
    return f"[t for t in {tokens} if t NOT IN ({_word_list(words)})]"


def _tokens_sql(column: str) -> str:
    return f"[t for t in regexp_split_to_array({column}, '[{_SPACE}]+') if t <> '']"


_CLEANED = f"""
cleaned AS (
  SELECT doc_id, lang, text, {_clean_sql('text')} AS clean FROM documents
), stripped AS (
  SELECT doc_id, lang, array_to_string({_without_sql("string_split(clean, ' ')", BODY_STOP_WORDS)}, ' ')
         AS cleaned_body FROM cleaned
)"""


def _cleaned(spark, folder):
    docs = spread_table(spark, folder, "documents", "doc_id", "lang", "text")
    return docs.withColumn("cleaned_body", text.strip_stop_words(text.clean_post("text")))


@query(f"WITH {_CLEANED} SELECT doc_id, clean AS cleaned_text FROM cleaned")
def clean_text(spark, folder):
    docs = spread_table(spark, folder, "documents", "doc_id", "text")
    return docs.select("doc_id", text.clean_post("text").alias("cleaned_text"))


@query(f"WITH {_CLEANED} SELECT doc_id, cleaned_body FROM stripped")
def clean_text_stopwords(spark, folder):
    return _cleaned(spark, folder).select("doc_id", "cleaned_body")


@query(f"""
SELECT doc_id, title, array_to_string({_without_sql(_tokens_sql('title'), TITLE_STOP_WORDS)}, ' ') AS title_tokens
FROM (SELECT doc_id, regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}_{_SPACE}]', '', 'g') AS title FROM documents)
""")
def normalise_title(spark, folder):
    docs = spread_table(spark, folder, "documents", "doc_id", "text")
    titles = docs.select("doc_id", text.normalise_title("text").alias("title"))
    return titles.withColumn("title_tokens", F.array_join(text.title_tokens("title"), " "))


_CONTRACTED = "bare"
for _whole in ("can not", "gim me", "gon na", "got ta", "lem me", "wan na"):
    _CONTRACTED = f"regexp_replace({_CONTRACTED}, '\\b{_whole.replace(' ', '')}\\b', '{_whole}', 'g')"


@query(f"""
SELECT doc_id, bare, array_to_string({_tokens_sql(_CONTRACTED)}, '|') AS tokens
FROM (SELECT doc_id, translate(lower(text), {_quoted(text.PUNCTUATION)}, '') AS bare FROM documents)
""")
def punctuation_and_tokens(spark, folder):
    docs = spread_table(spark, folder, "documents", "doc_id", "text")
    bare = docs.select("doc_id", text.strip_punctuation("text").alias("bare"))
    return bare.withColumn("tokens", F.array_join(text.word_tokens("bare"), "|"))


@query("""
SELECT doc_id, array_to_string(string_split(text, ' '), '_') AS joined, len(string_split(text, ' ')) AS pieces,
       concat_ws(' / ', lang, source) AS label
FROM documents
""")
def split_and_join(spark, folder):
    pieces = F.split("text", " ")
    return table(spark, folder, "documents").select(
        "doc_id",
        F.array_join(pieces, "_").alias("joined"),
        F.size(pieces).cast("bigint").alias("pieces"),
        F.concat_ws(" / ", "lang", "source").alias("label"),
    )


_WORDS = f"WITH {_CLEANED}, words AS (SELECT lang AS category, unnest(string_split(cleaned_body, ' ')) AS word FROM stripped)"


@query(f"{_WORDS} SELECT category, word, count(*) AS count FROM words GROUP BY 1, 2")
def word_counts(spark, folder):
    return agg.word_counts(_cleaned(spark, folder).withColumnRenamed("lang", "category"), "category", "cleaned_body")


@query(f"""
{_WORDS} SELECT category, word, count FROM (
  SELECT category, word, count(*) AS count,
         row_number() OVER (PARTITION BY category ORDER BY count(*) DESC, word) AS rn
  FROM words GROUP BY 1, 2) WHERE rn <= 15
""")
def top_words_per_category(spark, folder):
    return agg.top_words(_cleaned(spark, folder).withColumnRenamed("lang", "category"), "category", "cleaned_body")


@query("""
SELECT lang AS category, doc_id // 256 AS chunk, string_agg(text, ' ' ORDER BY doc_id) AS joined_text
FROM documents GROUP BY 1, 2
""")
def joined_text(spark, folder):
    docs = table(spark, folder, "documents").withColumnRenamed("lang", "category")
    return agg.joined_text(docs, "category", "doc_id", "text")


@query(f"""
WITH {_CLEANED}, words AS (SELECT doc_id, unnest(string_split(clean, ' ')) AS word FROM cleaned)
SELECT doc_id, word, count(*) AS count FROM words WHERE word NOT IN ({_word_list(TITLE_STOP_WORDS)}) GROUP BY 1, 2
""")
def stop_word_anti_join(spark, folder):
    docs = spread_table(spark, folder, "documents", "doc_id", "text")
    words = docs.select("doc_id", F.explode(F.split(text.clean_post("text"), " ")).alias("word"))
    stops = local_rows(spark, [(w,) for w in TITLE_STOP_WORDS], STOP_WORDS)
    return agg.count_by(lookups.drop_stop_rows(words, stops), "doc_id", "word")


def _document_lexicon(spark, folder):
    """A lexicon that grows with the data: every benchmark word, its polarity from its length."""
    words = table(spark, folder, "benchmark").select(F.explode(text.space_tokens(text.normalise_title("text"))).alias("word"))
    return words.distinct().withColumn("polarity", (F.length("word") % 5 - 2) / 2)


_TITLED = f"regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}_{_SPACE}]', '', 'g')"
_SENTIMENT = f"""
WITH lexicon AS (
  SELECT word, (length(word) % 5 - 2) / 2.0::DOUBLE AS polarity
  FROM (SELECT DISTINCT unnest({_tokens_sql(_TITLED)}) AS word FROM benchmark)
), tokens AS (SELECT doc_id, unnest({_tokens_sql(_TITLED)}) AS word FROM documents),
hits AS (SELECT doc_id, avg(polarity) AS mean FROM tokens JOIN lexicon USING (word) GROUP BY 1)
SELECT doc_id, round(coalesce(mean, 0), 6) AS sentiment FROM documents LEFT JOIN hits USING (doc_id)
"""


def _sentiment(spark, folder, max_rows):
    docs = spread_table(spark, folder, "documents", "doc_id", "text")
    titled = docs.select("doc_id", text.space_tokens(text.normalise_title("text")).alias("words"))
    scored = lookups.add_polarity(titled, "words", _document_lexicon(spark, folder), max_rows=max_rows)
    return scored.select("doc_id", F.round("sentiment", 6).alias("sentiment"))


@query(_SENTIMENT)
def sentiment(spark, folder):
    return _sentiment(spark, folder, lookups.LEXICON_ROWS)


@query(_SENTIMENT)
def sentiment_large_lexicon(spark, folder):
    """The join form, taken when a lexicon is over its bound."""
    return _sentiment(spark, folder, 0)


@query()
def stem_vocabulary(spark, folder):
    """Each distinct word is stemmed once, after the counts are combined."""
    words = _cleaned(spark, folder).select(F.explode(text.space_tokens("cleaned_body")).alias("word"))
    return agg.count_by(words, "word").withColumn("stem", stem_word("word"))


@query()
def text_features(spark, folder):
    docs = spread_table(spark, folder, "documents", "doc_id", "text")
    done = text_features_plan(docs, "text")
    return done.select("doc_id", "cleaned_body", "tokens", "stems", "tokens_nostop")


@query("SELECT p_partkey, p_type FROM part WHERE p_type ILIKE '%econ%'")
def contains_case_insensitive(spark, folder):
    return contains_ci(table(spark, folder, "part").select("p_partkey", "p_type"), "p_type", "eCoN")


_NUMBER = r"([0-9]+(?:\.[0-9]+)?)"
_METRICS_SQL = ", ".join(
    f"CASE WHEN (doc_id + nth) % {i + 5} = 0 THEN lang ELSE numbers[(nth + {i}) % len(numbers) + 1] END AS {m}"
    for i, m in enumerate(RECORD_METRICS)
)
_CASTS_SQL = ", ".join(f"CAST(TRY_CAST({m} AS DECIMAL(38, 9)) AS VARCHAR) AS {m}" for m in RECORD_METRICS)
_VALID_SQL = " AND ".join(
    f"{m} IS NOT NULL AND {m} <> '' AND TRY_CAST({m} AS DECIMAL(38, 9)) IS NOT NULL" for m in RECORD_METRICS
)


@query(f"""
WITH found AS (SELECT doc_id, lang, regexp_extract_all(text, '{_NUMBER}') AS numbers FROM documents),
numbered AS (SELECT *, unnest(generate_series(0, len(numbers) - 1)) AS nth FROM found),
metrics AS (SELECT doc_id AS id, nth, {_METRICS_SQL} FROM numbered)
SELECT id, nth, {_CASTS_SQL} FROM metrics WHERE {_VALID_SQL}
""")
def safe_cast_metrics(spark, folder):
    """Metrics taken from the numbers of texts, a row for each number and those after it; some hold words."""
    docs = spread_table(spark, folder, "documents", "doc_id", "lang", "text")
    found = docs.withColumn("numbers", F.regexp_extract_all("text", F.lit(_NUMBER), 0)).where("size(numbers) > 0")
    numbered_ = found.withColumn("nth", F.explode(F.sequence(F.lit(0), F.size("numbers") - 1)))
    stored = numbered_.select(
        F.col("doc_id").alias("id"), F.col("nth").cast("bigint").alias("nth"),
        *[
            F.when((F.col("doc_id") + F.col("nth")) % (i + 5) == 0, F.col("lang"))
            .otherwise(F.get("numbers", (F.col("nth") + i) % F.size("numbers"))).alias(m)
            for i, m in enumerate(RECORD_METRICS)
        ],
    )
    valid = valid_records(stored, ("id", "nth", *RECORD_METRICS))
    return valid.select("id", "nth", *[F.col(m).cast("string").alias(m) for m in RECORD_METRICS])


_TEXT_SQL = "regexp_replace(%s, '\\s*<[^>]+>\\s*', '', 'g')"
for _mark, _plain in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
    _TEXT_SQL = f"replace({_TEXT_SQL}, '{_mark}', '{_plain}')"
_TEXT_SQL = f"nullif(trim({_TEXT_SQL}), '')"


@query(f"""
SELECT page_id, {_TEXT_SQL % "regexp_extract(html, '(?s)<h1(?:\\s[^>]*)?>(.*?)</h1>', 1)"} AS title,
       {_TEXT_SQL % '''regexp_extract(html, '(?s)<div\\s[^>]*?class="ad"[^>]*>(.*?)</div>', 1)'''} AS ad
FROM pages
""")
def html_titles(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id",
        html.node_text(html.first_block("html", "h1")).alias("title"),
        html.node_text(html.first_block("html", "div", "ad")).alias("ad"),
    )


@query("""
SELECT page_id, count(*) AS links, min(link) AS first_link, max(link) AS last_link
FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1)) AS link FROM pages)
GROUP BY 1
""")
def html_links(spark, folder):
    links = table(spark, folder, "pages").select("page_id", F.explode(html.attributes("html", "a", "href")).alias("link"))
    return links.groupBy("page_id").agg(
        F.count(F.lit(1)).alias("links"), F.min("link").alias("first_link"), F.max("link").alias("last_link")
    )


_PLAIN_SQL = "replace(replace(replace(replace(%s, '&quot;', '\"'), '&middot;', '·'), '&copy;', '©'), '&amp;', '&')"


def _between_sql(start: str, end: str) -> str:
    """What stands between two marks, references decoded; NULL if empty."""
    after = f"substr(html, strpos(html, '{start}') + {len(start)})"
    inner = f"CASE WHEN strpos(html, '{start}') > 0 THEN split_part({after}, '{end}', 1) END"
    return f"nullif(trim({_PLAIN_SQL % inner}), '')"


@query(f"""
SELECT page_id, {_between_sql('<title>', '</title>')} AS title, {_between_sql('<h1>', '</h1>')} AS heading,
  {_between_sql('<div class="ad">', '</div>')} AS ad, {_between_sql('<footer>', '</footer>')} AS footer,
  len(string_split(html, '<p>')) - 1 AS paragraphs, len(string_split(html, '<br>')) - 1 AS breaks,
  len(string_split(split_part(split_part(html, '<nav>', 2), '</nav>', 1), '<li>')) - 1 AS entries
FROM pages
""")
def page_elements(spark, folder):
    """Elements of the given pages, each up to its own closing tag; scripts and comments hold none."""
    pages = table(spark, folder, "pages").select("page_id", "html")
    found = pinned(elements.tags(pages), "tags")
    every = pinned(elements.elements(found), "elements")
    result = pages.select("page_id")
    for name, tag, css_class in (("title", "title", None), ("heading", "h1", None), ("ad", "div", "ad"), ("footer", "footer", None)):
        wanted = every.where((F.col("name") == tag) & elements.has_class(css_class)).select("page_id", "start", "stop")
        value = elements.texts(wanted, found).select("page_id", F.col("text").alias(name))
        result = result.join(value, "page_id", "left")
    items = elements.within(every.where("name = 'li'"), every.where("name = 'nav'"))
    inside = items.groupBy("page_id").agg(F.count(F.lit(1)).alias("entries"))
    counted = every.groupBy("page_id").agg(F.count_if(F.col("name") == "p").alias("paragraphs"), F.count_if(F.col("name") == "br").alias("breaks"))
    result = result.join(counted, "page_id", "left").join(inside, "page_id", "left")
    return result.fillna(0, ["paragraphs", "breaks", "entries"])


@query(f"""
WITH entries AS (
  SELECT page_id, unnest(regexp_extract_all(html, '<li>(.*?)</li>', 1)) AS entry,
    generate_subscripts(regexp_extract_all(html, '<li>(.*?)</li>', 1), 1) AS n FROM pages
)
SELECT row_number() OVER (ORDER BY page_id, n) AS entry_id, page_id, n - 1 AS position,
  {_PLAIN_SQL % "regexp_extract(entry, '>(.*)</a>', 1)"} AS name, {_PLAIN_SQL % "regexp_extract(entry, 'href=.([^>]*).>', 1)"} AS link
FROM entries
""")
def page_catalogue(spark, folder):
    """The entries of the given pages' lists as a numbered catalogue of names and links."""
    pages = table(spark, folder, "pages").select("page_id", "html")
    rows = pinned(listing_elements(pages, ("li", None), {"name": ("a", None, None), "link": ("a", None, "href")}), "entries")
    counted = numbered(rows, ["page_id", "position"], [F.floor(F.col("page_id") / 1024)], "entry_id")
    return counted.select("entry_id", "page_id", F.col("position").cast("bigint").alias("position"), "name", "link")


@query("""
SELECT page_id, count(*) AS pages, sha256(string_agg(page_url, chr(10) ORDER BY n)) AS urls_sha256 FROM (
  SELECT page_id, n, 'https://' || regexp_extract(url, '://([^/]+)/', 1) || '/search/page/' || n || '/3' AS page_url
  FROM pages, unnest(range(1, 10000)) AS r(n)
) GROUP BY page_id
""")
def page_url_list(spark, folder):
    """Listing addresses 1..9999 for the host of every page, as a digest per page."""
    host = F.regexp_extract("url", "://([^/]+)/", 1)
    templates = table(spark, folder, "pages").select(
        "page_id", F.concat(F.lit("https://"), host, F.lit("/search/page/1/3")).alias("url")
    )
    # Tasks of a bounded number of pages: the templates are small, what is made of them is not.
    parts = max(1, -(-templates.count() // LISTED_PAGES))
    by_page = templates.repartition(parts, "page_id").groupBy("page_id").agg(
        F.collect_list("url").alias("templates"), F.count(F.lit(1)).alias("n")
    )
    urls = page_urls(by_page, "templates", F.lit(9999), "urls", rows=False)
    lines = F.array_join("urls", "\n")
    return urls.select("page_id", (F.col("n") * 9999).alias("pages"), F.sha2(lines, 256).alias("urls_sha256"))


@query("""
SELECT page_id, string_split(url, 'example.')[-1] AS after_host, string_split(url, '://')[1] AS scheme FROM pages
""")
def url_parts(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id",
        F.substring_index("url", "example.", -1).alias("after_host"),
        F.substring_index("url", "://", 1).alias("scheme"),
    )


@query("""
SELECT count(*) AS rows, count(text) AS text_present, count(lang) AS lang_present,
       count(nullif(source, 'src1')) AS source_present FROM documents
""")
def length_report(spark, folder):
    docs = table(spark, folder, "documents").withColumn("source", F.nullif("source", F.lit("src1")))
    return agg.present_counts(docs, ["text", "lang", "source"])


@query("""
WITH lists AS (SELECT doc_id, string_split(text, ' ') AS a, string_split(text, '.') AS b FROM documents)
SELECT doc_id, p - 1 AS position, a[p] AS word, b[p] AS sentence
FROM (SELECT *, unnest(range(1, greatest(len(a), len(b)) + 1)) AS p FROM lists)
""")
def zip_lists(spark, folder):
    lists = table(spark, folder, "documents").select(
        "doc_id", F.split("text", " ").alias("word"), F.split("text", r"\.").alias("sentence")
    )
    zipped = shape.zip_lists(lists, ["doc_id"], ["word", "sentence"])
    return zipped.withColumn("position", F.col("position").cast("bigint"))


def _listing_pages(spark, folder):
    """One listing page per supplier, two entries each: one scored, one with an empty brand and no score."""
    css = Selectors()
    entry = (
        f"<div class='row'><div class='{css.container}'><a href='/w'><h5> %s <b>%s</b></h5></a><h6>%s</h6></div>"
        f"<div class='{css.region}'>%s, USA</div><div class='{css.appellation}'>%s</div>%s</div>"
    ).replace("'", '"')
    scored = f'<div class="{css.score}"> %.1f </div>'
    suppliers = table(spark, folder, "supplier").join(
        table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    first = F.format_string(
        entry, "s_name", "n_name", "n_name", "n_name", "s_name",
        F.format_string(scored, F.lit(80.0) + F.col("s_suppkey") % 20),
    )
    blank = F.lit("  ")
    second = F.format_string(entry, "n_name", F.lit("reserve"), blank, F.lit("Napa, California"), blank, F.lit(""))
    page = F.concat(F.lit("<html><body>intro"), first, second, F.lit("</body></html>"))
    return suppliers.select(F.col("s_suppkey").alias("page_id"), page.alias("html"))


@query("""
WITH named AS (SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey),
entries AS (
  SELECT s_suppkey, 0 AS position, s_name || n_name AS name, n_name AS brand, n_name || ', USA' AS location,
         s_name AS appellation, CAST(80.0::DOUBLE + s_suppkey % 20 AS VARCHAR) AS score FROM named
  UNION ALL
  SELECT s_suppkey, 1, n_name || 'reserve', NULL, 'Napa, California, USA', NULL, NULL FROM named
)
SELECT row_number() OVER (ORDER BY s_suppkey, position) AS restaurant_id, name AS wine_name, brand AS company_name,
       location, appellation, score, '07:30' AS opening_time,
       CASE WHEN position = 0 THEN '15:30' ELSE '00:30' END AS closing_time
FROM entries
""")
def venue_catalogue_rows(spark, folder):
    """Pages written from supplier rows and read back as a catalogue; filled scores are not compared."""
    hours = F.when(F.col("position") == 0, 8).otherwise(17)
    table_ = venue_catalogue(_listing_pages(spark, folder), F.lit("07:30"), hours, pages_per_slice=16)
    score = F.when(F.col("Company Name").isNotNull(), F.col("Tasting Score"))
    return table_.select(
        F.col("Restaurant ID").alias("restaurant_id"), F.col("Wine Name").alias("wine_name"),
        F.col("Company Name").alias("company_name"), F.col("Location").alias("location"),
        F.col("Appellation").alias("appellation"), score.alias("score"),
        F.col("Opening Time").alias("opening_time"), F.col("Closing Time").alias("closing_time"),
    )


@query("SELECT n_name || 'reserve' AS wine_name, 'Napa, California, USA' AS location FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def venue_catalogue_in_place(spark, folder):
    kept = venue_catalogue(_listing_pages(spark, folder), F.lit("08:00"), F.lit(9), place="california")
    return kept.select(F.col("Wine Name").alias("wine_name"), F.col("Location").alias("location"))
