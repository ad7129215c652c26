"""Token search, index-page links and cone search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions.scalar import base_name
from driftline.functions.stemming import stem_sql
from driftline.operators import search, sky
from driftline.queries.registry import query, table
from driftline.session import work_path
from driftline.sources import listing

_STOP_LIST = ", ".join(f"'{w}'" for w in search.ENGLISH_STOP_WORDS)


@query(
    rf"""
    SELECT token, count(*) AS doc_count FROM (
        SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+')) AS token FROM documents
    ) WHERE token NOT IN ({_STOP_LIST}) GROUP BY 1
    """
)
def token_index(spark: SparkSession, sf: str) -> DataFrame:
    return search.token_document_counts(table(spark, sf, "documents"), "text")


@query(
    r"""
    WITH postings AS (
        SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS token FROM documents
    )
    SELECT doc_id FROM postings WHERE token IN ('under', 'license') GROUP BY 1 HAVING count(*) = 1 AND min(token) = 'license'
    UNION ALL
    SELECT doc_id FROM postings WHERE token IN ('license') AND doc_id IN (SELECT doc_id FROM postings WHERE token = 'under')
    """
)
def token_search(spark: SparkSession, sf: str) -> DataFrame:
    """Lookup in a written index; the stop word in the request does not restrict the result."""
    path = work_path(spark, "token-index")
    search.write_token_index(search.token_postings(table(spark, sf, "documents"), "doc_id", "text"), "doc_id", path)
    return search.find_documents(spark.read.parquet(path), "doc_id", ["license", "under"])


@query(
    r"""
    SELECT lang, count(*) AS doc_count FROM documents
    WHERE list_contains(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), 'license') GROUP BY 1
    """
)
def token_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The same test as a filter, without an index."""
    hits = table(spark, sf, "documents").filter(search.text_matches("text", ["license"]))
    return hits.groupBy("lang").agg(F.count(F.lit(1)).alias("doc_count"))


_WORDS_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"
_PLACES_SQL = f"""
    SELECT * FROM (
        SELECT doc_id, unnest(words) AS token, generate_subscripts(words, 1) AS place FROM (SELECT doc_id, {_WORDS_SQL} AS words FROM documents)
    ) WHERE token NOT IN ({_STOP_LIST})
"""
_STEMMED_SQL = f"""
    WITH places AS MATERIALIZED ({_PLACES_SQL}),
    vocabulary AS MATERIALIZED ({stem_sql('(SELECT token, count(*) AS occurrences FROM places GROUP BY 1)')}),
    stemmed AS (SELECT doc_id, place, stem FROM places JOIN vocabulary USING (token))
"""


def _stemmed_index(spark: SparkSession, sf: str) -> search.StemmedIndex:
    index = search.StemmedIndex(spark, work_path(spark, "stemmed-index"), "doc_id")
    index.write(table(spark, sf, "documents"), "text")
    return index


@query(
    f"""
    {_STEMMED_SQL} SELECT stem, count(*) AS words, CAST(sum(occurrences) AS BIGINT) AS occurrences FROM vocabulary GROUP BY 1
    """
)
def stem_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Stems of the whole vocabulary, with their distinct words and occurrences."""
    words = search.stem_vocabulary(search.token_places(table(spark, sf, "documents"), "doc_id", "text"))
    return words.groupBy("stem").agg(F.count(F.lit(1)).alias("words"), F.sum("occurrences").alias("occurrences"))


@query(
    f"""
    {_STEMMED_SQL} SELECT doc_id FROM stemmed WHERE stem IN ('licens', 'public') GROUP BY 1 HAVING count(DISTINCT stem) = 2
    """
)
def stemmed_search(spark: SparkSession, sf: str) -> DataFrame:
    """Texts that hold both words in any form, from a written index."""
    return _stemmed_index(spark, sf).find(["licenses", "publicly"])


@query(
    f"""
    {_STEMMED_SQL} SELECT a.doc_id, count(*) AS hits FROM stemmed a JOIN stemmed b ON a.doc_id = b.doc_id AND b.place = a.place + 2
    WHERE a.stem = 'work' AND b.stem = 'licens' GROUP BY 1
    """
)
def phrase_search(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with a phrase, its words in any form and at the right places; the stop word between them only takes a place."""
    return _stemmed_index(spark, sf).find_phrase("works are licensed")


_LINKS_SQL = r"""
    SELECT page_id, url, unnest(regexp_extract_all(
        regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', '', 'g'),
        '(?is)<a\b[^>]*?\shref\s*=\s*("[^"]*"|''[^'']*''|[^\s>"'']+)', 1)) AS raw
    FROM pages
"""


@query(
    rf"""
    SELECT href, count(*) AS link_count, count(DISTINCT url || href) AS url_count FROM (
        SELECT url, replace(regexp_replace(raw, '^["'']|["'']$', '', 'g'), '&amp;', '&') AS href FROM ({_LINKS_SQL})
    ) WHERE regexp_matches(href, '^/[a-z]+$') GROUP BY 1
    """
)
def link_extract(spark: SparkSession, sf: str) -> DataFrame:
    links = listing.extract_links(table(spark, sf, "pages"), "html", F.col("url"), r"^/[a-z]+$")
    return links.groupBy("href").agg(
        F.count(F.lit(1)).alias("link_count"), F.count_distinct("link_url").alias("url_count")
    )


@query(
    rf"""
    WITH targets AS (
        SELECT page_id, list_transform(regexp_extract_all(
            regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', '', 'g'),
            '(?is)<a\b[^>]*?\shref\s*=\s*("[^"]*"|''[^'']*''|[^\s>"'']+)', 1),
            lambda t: replace(regexp_replace(t, '^["'']|["'']$', '', 'g'), '&amp;', '&')) AS hrefs
        FROM pages
    ), links AS (
        SELECT page_id, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) - 1 AS position FROM targets
    ), chosen AS (
        SELECT * FROM links WHERE regexp_matches(href, '^/[A-Za-z]+$') ORDER BY page_id, position LIMIT 500
    )
    SELECT page_id, CAST(position AS INTEGER) AS position, 'https://host' || href AS link_url FROM chosen
    WHERE regexp_extract(href, '([^/]+)$', 1) NOT IN (SELECT lang FROM documents)
    """
)
def next_downloads(spark: SparkSession, sf: str) -> DataFrame:
    """The first 500 links in page order without those whose target name is already present."""
    links = listing.extract_links(table(spark, sf, "pages"), "html", "https://host", "^/[A-Za-z]+$")
    present = table(spark, sf, "documents").select(F.col("lang").alias("file_name"))
    return listing.next_downloads(links, present, first=500).select("page_id", "position", "link_url")


@query(
    """
    SELECT d.doc_id, d.source FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)
    """
)
def skip_processed(spark: SparkSession, sf: str) -> DataFrame:
    """Inputs named after documents whose output, named after a label, does not exist yet."""
    inputs = table(spark, sf, "documents").select(
        "doc_id", "source", F.format_string("/in/%d.dly", "doc_id").alias("file_name")
    )
    outputs = table(spark, sf, "labels").select(F.format_string("/out/%d.csv", "doc_id").alias("file_name"))
    return listing.without_output(inputs, outputs).drop("file_name")


@query(
    """
    SELECT file_name, 'PENDING' AS status, count(*) AS row_count
    FROM (SELECT unnest(string_split(text, chr(10))) AS file_name FROM documents)
    WHERE length(trim(file_name)) > 0 GROUP BY 1
    """
)
def file_list_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = listing.split_file_names(table(spark, sf, "documents"), "text")
    return lines.groupBy("file_name", "status").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    r"""
    SELECT page_id, regexp_replace(regexp_extract(url, '([^/]+)/?$', 1), '(?:\.[^.]*){1}$', '') AS name FROM pages
    """
)
def base_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", base_name("url").alias("name"))


# --- cone search -------------------------------------------------------------------

# Positions on the sphere from the first two vector components: the first runs around it, the second is clamped.
_STARS_SQL = """
    SELECT vec_id, label, CASE WHEN x % 360 < 0 THEN (x % 360 + 360) % 360 ELSE x % 360 END AS ra,
           greatest(-90.0, least(90.0, embedding[2]::DOUBLE * 200)) AS dec
    FROM (SELECT *, embedding[1]::DOUBLE * 450 + 180 AS x FROM embeddings)
"""


def _stars(spark: SparkSession, sf: str) -> DataFrame:
    first, second = F.col("embedding")[0].cast("double"), F.col("embedding")[1].cast("double")
    ra = F.pmod(first * 450 + 180, F.lit(360.0))
    dec = F.greatest(F.lit(-90.0), F.least(F.lit(90.0), second * 200))
    return table(spark, sf, "embeddings").select("vec_id", "label", ra.alias("ra"), dec.alias("dec"))


def _haversine_sql(ra: str, dec: str) -> str:
    return (
        f"degrees(2 * asin(sqrt(least(1.0, pow(sin(radians({dec} - s.dec) / 2), 2) + "
        f"cos(radians(s.dec)) * cos(radians({dec})) * pow(sin(radians({ra} - s.ra) / 2), 2)))))"
    )


@query(
    f"""
    SELECT vec_id, round({_haversine_sql('180.0', '10.0')}, 6) AS distance_deg FROM ({_STARS_SQL}) s
    WHERE {_haversine_sql('180.0', '10.0')} <= 25
    """
)
def cone_search(spark: SparkSession, sf: str) -> DataFrame:
    """One cone over a table written by sky cell."""
    path = work_path(spark, "star-cells")
    sky.write_by_cell(_stars(spark, sf), path, 5.0)
    near = sky.cone_search_cells(spark.read.parquet(path), 180.0, 10.0, 25.0, 5.0)
    return near.select("vec_id", F.round("distance_deg", 6).alias("distance_deg"))


@query(
    f"""
    SELECT c.vec_id AS center_id, s.vec_id AS vec_id, round({_haversine_sql('c.ra', 'c.dec')}, 6) AS distance_deg
    FROM ({_STARS_SQL}) s, ({_STARS_SQL}) c
    WHERE c.vec_id IN (SELECT min(vec_id) FROM embeddings GROUP BY label) AND {_haversine_sql('c.ra', 'c.dec')} <= 2.5
    """
)
def cone_join(spark: SparkSession, sf: str) -> DataFrame:
    """Stars within 2.5 degrees of the first star of each label."""
    stars = _stars(spark, sf)
    chosen = stars.groupBy("label").agg(F.min("vec_id").alias("vec_id")).select("vec_id")
    centers = stars.join(chosen, "vec_id", "left_semi").select(
        F.col("vec_id").alias("center_id"), F.col("ra").alias("center_ra"), F.col("dec").alias("center_dec")
    )
    near = sky.cone_join(stars, centers, 2.5)
    return near.select("center_id", "vec_id", F.round("distance_deg", 6).alias("distance_deg"))
