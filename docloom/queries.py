"""Queries over the driver's tables for every relational operator, and their SQL.

documents stands in for parsed files: doc_id is the order of arrival, source the path's folder, lang the
language. Tags are (lang, source) and, where labelled, the quality class.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import plugins
from docloom.functions import text as T
from docloom.functions.gazetteer import REGIONS, gazetteer, region_of
from docloom.functions.vectors import cosine
from docloom.operators import documents as D
from docloom.operators import names as N
from docloom.operators import search as R
from docloom.operators import summary as E
from docloom.operators import terms as M
from docloom.operators import taxonomy as X
from docloom.operators.index import VectorIndex, overlap
from docloom.operators.language import LanguageModel
from docloom.operators.store import VectorStore, merge_points
from docloom.schemas import PAYLOAD
from docloom.scratch import new_folder, written
from docloom.sources import files as S
from docloom.sources.record_files import write_record_files
from docloom.streaming import ingest as I

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


#: SQL pieces. W is Python's white space, which Spark's helper functions follow.
W = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
STRIP = f"regexp_replace(text, '^{W}+|{W}+$', '', 'g')"
WORDS = f"CASE WHEN {STRIP} = '' THEN [] ELSE string_split_regex({STRIP}, '{W}+') END"
EMAILS = r"len(regexp_extract_all(text, '[\p{L}\p{M}\p{N}_.-]+@[\p{L}\p{M}\p{N}_.-]+'))"
PHONES = r"len(regexp_extract_all(text, '\+?[0-9]{6,}'))"
LINES = "length(text) - length(replace(text, chr(10), '')) + 1"


@query(
    f"""SELECT doc_id, sha1(text) AS hash_sha1, CAST(strlen(text) AS BIGINT) AS size_bytes_text,
    CAST({LINES} AS INTEGER) AS line_count, CAST(len({WORDS}) AS INTEGER) AS token_estimate,
    round_even(({EMAILS} + {PHONES}) / greatest(len({WORDS}), 1), 4) AS pii_risk FROM documents"""
)
def text_metrics(spark, sf_dir):
    rows = D.quality_flags(D.enrich(docs(spark, sf_dir)))
    return rows.select("doc_id", "hash_sha1", "size_bytes_text", "line_count", "token_estimate", "pii_risk")


@query(
    f"""SELECT lang, count(*) AS n_docs, CAST(sum(len({WORDS})) AS BIGINT) AS n_tokens,
    CAST(count(*) FILTER (WHERE doc_id > f) AS BIGINT) AS n_duplicates,
    CAST(count(*) FILTER (WHERE strlen(text) > 2000 OR {LINES} > 20) AS BIGINT) AS n_split
    FROM (SELECT *, min(doc_id) OVER (PARTITION BY text) AS f FROM documents) GROUP BY lang"""
)
def corpus_summary(spark, sf_dir):
    rows = D.quality_flags(D.enrich(docs(spark, sf_dir)), 2000, 20)
    rows = D.flag_duplicates(rows, "doc_id")
    return rows.groupBy("lang").agg(
        F.count("*").alias("n_docs"),
        F.sum("token_estimate").alias("n_tokens"),
        F.count_if("is_duplicate").alias("n_duplicates"),
        F.count_if("requires_split").alias("n_split"),
    )


@query(
    f"""SELECT doc_id, strlen(text) > 2000 OR {LINES} > 20 AS requires_split,
    length({STRIP}) < 50 AS needs_ocr FROM documents"""
)
def quality_limits(spark, sf_dir):
    rows = D.quality_flags(docs(spark, sf_dir), 2000, 20)
    return rows.select("doc_id", "requires_split", T.needs_ocr(F.col("text")).alias("needs_ocr"))


@query(
    rf"""SELECT doc_id, md5(regexp_replace(regexp_replace(nfc_normalize(regexp_replace(regexp_replace(text,
    '(?i)(from|sent|to|subject):.+?\n', '', 'g'), 'Page \d+ of \d+', '', 'g')), '{W}+', ' ', 'g'), '^{W}+|{W}+$', '', 'g'))
    AS digest FROM documents"""
)
def normalize_intended(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.md5(T.normalize(F.col("text"))).alias("digest"))


@query(f"SELECT doc_id, md5(regexp_replace(nfc_normalize(text), '^{W}+|{W}+$', '', 'g')) AS digest FROM documents")
def normalize_literal(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.md5(T.normalize(F.col("text"), "literal")).alias("digest"))


@query(
    """SELECT doc_id, sha1(text) AS hash_content, doc_id > min(doc_id) OVER (PARTITION BY text) AS is_duplicate
    FROM documents"""
)
def dedup_flag_first_seen(spark, sf_dir):
    return D.flag_duplicates(docs(spark, sf_dir), "doc_id").select("doc_id", "hash_content", "is_duplicate")


@query("SELECT min(doc_id) AS doc_id, sha1(text) AS hash_content FROM documents GROUP BY text")
def dedup_keep_first(spark, sf_dir):
    return D.keep_first(docs(spark, sf_dir), "doc_id").select("doc_id", "hash_content")


@query("SELECT max(doc_id) AS doc_id, sha1(text) AS hash_content, count(*) > 1 AS is_duplicate FROM documents GROUP BY text")
def dedup_keep_last(spark, sf_dir):
    return D.keep_last(docs(spark, sf_dir), "doc_id").select("doc_id", "hash_content", "is_duplicate")


UUID = """lower(substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
    printf('%02x', (CAST('0x' || substr(h, 17, 2) AS INTEGER) & 63) | 128) || substr(h, 19, 2) || '-' || substr(h, 21, 12))"""


@query(
    f"""SELECT doc_id, {UUID} AS id FROM (SELECT doc_id,
    sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(sha1(text))) AS h FROM documents)"""
)
def point_ids(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.point_id(F.sha1("text"), F.col("source")).alias("id"))


@query(
    """SELECT doc_id, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS summary,
    lang AS language, source FROM documents WHERE trim(text) <> ''"""
)
def summary_fallback(spark, sf_dir):
    rows = docs(spark, sf_dir).where(~T.blank(F.col("text")))
    summary = T.summary_or_preview(F.lit(None).cast("string"), F.col("text"))
    return rows.select("doc_id", summary.alias("summary"), F.col("lang").alias("language"), "source")


@query(
    f"""SELECT sha1(text) AS hash_content, source, lang AS language, '' AS category, false AS is_duplicate,
    CAST(0 AS BIGINT) AS size_bytes, CAST(len({WORDS}) AS INTEGER) AS token_estimate, md5(text) AS text,
    CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS summary, '' AS tags,
    0.0::DOUBLE AS created_ts, 0.0::DOUBLE AS modified_ts, 0.0::DOUBLE AS pii_risk FROM documents WHERE {STRIP} <> ''"""
)
def payload_defaults(spark, sf_dir):
    """All fields of a point's payload, most of them by their defaults."""
    rows = D.enrich(docs(spark, sf_dir)).withColumns({"hash_content": F.col("hash_sha1"), "language": F.col("lang")})
    points = D.prepare_points(rows.drop("pii_risk"), "source").select("payload.*")
    return points.withColumns({"text": F.md5("text"), "tags": F.array_join("tags", ",")})


@query(
    f"""WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
    s AS (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 100 - 1, 0) + 1, 350)) AS start FROM d WHERE len(w) > 0)
    SELECT doc_id, CAST(start // 350 AS INTEGER) AS idx, CAST(start AS INTEGER) AS start,
    CAST(len(w[start + 1 : start + 450]) AS INTEGER) AS n_words, sha1(array_to_string(w[start + 1 : start + 450], ' ')) AS digest
    FROM s"""
)
def chunks(spark, sf_dir):
    return D.chunks(docs(spark, sf_dir)).select("doc_id", "idx", "start", "n_words", F.sha1("chunk").alias("digest"))


#: Words for countries as documents name them, and words that only hold one: each document gets one of both lists.
NAMED = [word.title() for _, words in gazetteer() for word in words] + ["Uk", "", "of the"]
NEAR = ["ukulele", "Indiana", "islands", "usage_usa", "Romaniac", "srx", "Maltese", "chinaware", "Turkeys", "egypt2"]


def place_text(doc_id: str = "doc_id", text: str = "text"):
    """The text, then a country and a word that isn't one."""
    pick = lambda words, n: F.element_at(F.array(*map(F.lit, words)), (F.col(doc_id) % n + 1).cast("int"))
    named, near = pick(NAMED, len(NAMED)), pick(NEAR, len(NEAR))
    return F.when(F.col(text) == "", "").otherwise(F.concat_ws(" ", text, named, near, pick(NAMED, 7)))


LISTED = lambda words: "list_value(" + ", ".join(f"'{w}'" for w in words) + ")"
PLACE_TEXT = f"""CASE WHEN text = '' THEN '' ELSE text || ' ' || {LISTED(NAMED)}[doc_id % {len(NAMED)} + 1] || ' ' ||
    {LISTED(NEAR)}[doc_id % {len(NEAR)} + 1] || ' ' || {LISTED(NAMED)}[doc_id % 7 + 1] END"""
BOUND = r"[^\p{L}\p{N}_]"


def gazetteer_sql(texts: str) -> str:
    """(key, name, region) of every text of a table (key, text, ...) and every country named in it."""
    each = " UNION ALL ".join(
        f"SELECT *, '{name}' AS name, '{region_of(name)}' AS region FROM ({texts}) "
        f"WHERE regexp_matches(lower(text), '(^|{BOUND})({'|'.join(words)})($|{BOUND})')"
        for name, words in gazetteer()
    )
    return f"SELECT * FROM ({each})"


def tagged(spark, sf_dir) -> DataFrame:
    marks = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = docs(spark, sf_dir).join(marks, "doc_id", "left")
    mark = F.when(F.col("quality").isNotNull(), F.concat(F.lit("quality-"), F.col("quality")))
    return rows.select(
        "doc_id",
        place_text().alias("text"),
        F.col("lang").alias("language"),
        F.concat_ws("/", F.lit("corpus"), "lang", "source").alias("source"),
        F.col("lang").alias("category"),
        F.array_compact(F.array(F.col("lang"), F.col("source"), mark)).alias("tags"),
    )


TAGGED = f"""d AS (SELECT doc_id, {PLACE_TEXT} AS text, lang, 'corpus/' || lang || '/' || source AS path, source,
    (SELECT max(quality) FROM labels l WHERE l.doc_id = documents.doc_id) AS q FROM documents WHERE text <> ''),
    t AS (SELECT doc_id, lang AS category, unnest(list_filter([lang, source, 'quality-' || q], lambda x: x IS NOT NULL)) AS tag FROM d)"""


@query(
    f"""WITH {TAGGED} SELECT 'category' AS dimension, lang AS key, count(*) AS n FROM d GROUP BY lang
    UNION ALL SELECT 'language', lang, count(*) FROM d GROUP BY lang
    UNION ALL SELECT 'source', path, count(*) FROM d GROUP BY path
    UNION ALL SELECT 'tag', tag, count(*) FROM t GROUP BY tag
    UNION ALL SELECT 'country', name, count(*) FROM ({gazetteer_sql("SELECT * FROM d")}) GROUP BY name"""
)
def taxonomy_counters(spark, sf_dir):
    return X.counters(tagged(spark, sf_dir))


@query(
    f"""WITH {TAGGED}, c AS (SELECT tag, count(*) AS n FROM t GROUP BY tag)
    SELECT CASE WHEN n >= 10 THEN 'high' WHEN n >= 3 THEN 'medium' ELSE 'low' END AS band, tag AS key, n FROM c"""
)
def taxonomy_tag_bands(spark, sf_dir):
    return X.tag_bands(X.counters(tagged(spark, sf_dir)))


@query(f"WITH {TAGGED} SELECT tag AS key, count(*) AS n FROM t GROUP BY tag ORDER BY n DESC, tag LIMIT 10")
def taxonomy_top_tags(spark, sf_dir):
    return X.ranked(X.counters(tagged(spark, sf_dir)), "tag", 10)


@query(
    f"""WITH {TAGGED}, c AS (SELECT tag, count(*) AS n FROM t GROUP BY tag)
    SELECT (SELECT count(DISTINCT lang) FROM d) AS total_categories, (SELECT count(*) FROM c) AS total_tags,
    (SELECT count(DISTINCT path) FROM d) AS total_sources, (SELECT count(*) FROM c WHERE n = 1) AS unique_tags,
    (SELECT count(*) FROM c WHERE n >= 5) AS common_tags,
    (SELECT count(DISTINCT name) FROM ({gazetteer_sql("SELECT * FROM d")})) AS total_countries"""
)
def taxonomy_statistics(spark, sf_dir):
    return X.statistics(X.counters(tagged(spark, sf_dir)))


@query(f"WITH {TAGGED} SELECT DISTINCT category, tag AS value FROM t")
def taxonomy_category_tags(spark, sf_dir):
    return X.category_values(tagged(spark, sf_dir), "tags")


@query(f"WITH {TAGGED} SELECT DISTINCT lang AS category, path AS value FROM d")
def taxonomy_category_sources(spark, sf_dir):
    return X.category_values(tagged(spark, sf_dir), "source")


@query(
    """WITH p AS (SELECT DISTINCT string_split(url, '/') AS p FROM pages), i AS (SELECT p, unnest(range(1, len(p))) AS i FROM p)
    SELECT DISTINCT array_to_string(p[1:i], '/') AS parent, array_to_string(p[1:i + 1], '/') AS child FROM i"""
)
def source_hierarchy(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.col("url").alias("source"), F.lit("x").alias("text"))
    return X.source_edges(pages)


#: Words of the test tables that stand for places, as the gazetteer's countries do in its own texts.
PLACES = [("the-land", ["the", "than"]), ("der-land", ["der", "die"]), ("les-land", ["les", "échque"]), ("el-land", ["ciónosta", "el"])]
def place_sql(names: list[tuple[str, list[str]]]) -> str:
    return " UNION ALL ".join(
        f"SELECT doc_id, '{name}' AS country FROM documents WHERE regexp_matches(lower(text), '(^|{BOUND})({'|'.join(words)})($|{BOUND})')"
        for name, words in names
    )


@query(f"SELECT country, count(*) AS n FROM ({place_sql(PLACES)}) GROUP BY country")
def places_frequency(spark, sf_dir):
    rows = docs(spark, sf_dir).select("text", F.col("lang").alias("category"))
    return X.ranked(X.counters(rows, PLACES), "country").withColumnRenamed("key", "country")


@query(f"WITH {TAGGED} SELECT region, name AS country, count(*) AS n FROM ({gazetteer_sql('SELECT * FROM d')}) GROUP BY ALL")
def countries_by_region(spark, sf_dir):
    """The whole gazetteer, as a table, over all documents, each of which names countries and words that aren't."""
    names = N.names_table(spark, gazetteer())
    return X.by_region(X.counters(tagged(spark, sf_dir), names))


@query(f"WITH {TAGGED} SELECT DISTINCT doc_id, name FROM ({gazetteer_sql('SELECT * FROM d')})")
def gazetteer_mentions(spark, sf_dir):
    """Countries of each document, from n-grams joined with a table that has a hundred thousand other names, too."""
    more = spark.range(100_000).select(F.concat(F.lit("place "), "id").alias("name"), F.concat(F.lit("the place no. "), "id").alias("variant"))
    names = N.names_table(spark, gazetteer()).unionByName(more)
    return N.names_of(tagged(spark, sf_dir), names, F.col("text"), "doc_id")


@query(
    f"""WITH {TAGGED}, m AS ({gazetteer_sql("SELECT doc_id, lang AS category, text FROM d")}),
    g AS (SELECT CASE GROUPING_ID(region, country, category) WHEN 0 THEN 'category of country' WHEN 1 THEN 'country' WHEN 2 THEN 'category of region'
    WHEN 3 THEN 'region' ELSE 'total' END AS level, region, country, category, count(*) AS n, count(DISTINCT doc_id) AS n_documents
    FROM (SELECT doc_id, region, name AS country, category FROM m)
    GROUP BY GROUPING SETS ((region, country, category), (region, country), (region, category), (region), ()))
    SELECT * FROM g UNION ALL SELECT 'region', r, NULL, NULL, 0, 0 FROM (SELECT unnest({LISTED(REGIONS)}) AS r) WHERE r NOT IN (SELECT region FROM m)"""
)
def countries_rollup(spark, sf_dir):
    """Countries by region and category with all subtotals; documents count once a region."""
    return X.region_rollup(tagged(spark, sf_dir))


KEYWORDS = [key for keys in X.TAG_GROUPS.values() for key in keys]
GROUPED = f"""d AS (SELECT list_value({", ".join(f"'{k}'" for k in KEYWORDS)})[doc_id % {len(KEYWORDS)} + 1] || ' ' || source AS tag,
    list_value({", ".join(f"'{g}'" for g, keys in X.TAG_GROUPS.items() for _ in keys)})[doc_id % {len(KEYWORDS)} + 1] AS g FROM documents),
    t AS (SELECT tag, g, count(*) AS n FROM d GROUP BY ALL ORDER BY n DESC, tag LIMIT 100)"""


@query(f'WITH {GROUPED} SELECT g AS "group", tag, n FROM t')
def tag_keyword_groups(spark, sf_dir):
    """Tags made of a keyword and a document's source; the most frequent hundred are grouped."""
    key = F.element_at(F.array(*map(F.lit, KEYWORDS)), (F.col("doc_id") % len(KEYWORDS) + 1).cast("int"))
    rows = docs(spark, sf_dir).select(F.lit("x").alias("text"), F.array(F.concat_ws(" ", key, "source")).alias("tags"))
    return X.tag_groups(X.counters(rows))


@query(
    """SELECT count(*) AS total, CAST(0 AS BIGINT) AS corrupt, count(*) FILTER (WHERE text = '') AS empty,
    count(*) FILTER (WHERE text <> '') AS valid FROM documents"""
)
def file_counts(spark, sf_dir):
    return X.file_counts(docs(spark, sf_dir).withColumn("summary", F.lit("")))


def vectors(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


def asked(points: DataFrame) -> DataFrame:
    """Every point whose id is divisible by 50 asks for its neighbours."""
    return points.where(F.col("vec_id") % 50 == 0).select(
        F.col("vec_id").alias("query_id"),
        F.col("embedding").alias("query_vector"),
        F.array(F.col("label").cast("string")).alias("user_tags"),
    )


def hits_of(spark, sf_dir, k: int = 10) -> DataFrame:
    points = vectors(spark, sf_dir)
    return R.top_k(asked(points), points, k, point_id="vec_id", vector="embedding")


COSINE = """list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) /
    (sqrt(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[]))) *
     sqrt(list_dot_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))))"""
HITS = f"""h AS (SELECT * FROM (SELECT a.vec_id AS query_id, b.vec_id AS id, a.label AS ql, b.label AS pl, {COSINE} AS score,
    row_number() OVER (PARTITION BY a.vec_id ORDER BY {COSINE} DESC, b.vec_id) AS rank
    FROM embeddings a, embeddings b WHERE a.vec_id % 50 = 0) WHERE rank <= 10),
    r AS (SELECT query_id, id, score AS original_score, ql = pl AS was_boosted,
    score * CASE WHEN ql = pl THEN 1.25 ELSE 1.0 END AS score, rank AS original_rank,
    row_number() OVER (PARTITION BY query_id ORDER BY score * CASE WHEN ql = pl THEN 1.25 ELSE 1.0 END DESC, rank) AS rank FROM h)"""


@query(f"WITH {HITS} SELECT query_id, id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM h")
def topk_cosine(spark, sf_dir):
    return hits_of(spark, sf_dir).select("query_id", "id", F.round("score", 6).alias("score"), "rank")


def boosted(spark, sf_dir) -> DataFrame:
    points = vectors(spark, sf_dir)
    tags = points.select(F.col("vec_id").alias("id"), F.array(F.col("label").cast("string")).alias("tags"))
    mine = asked(points).select("query_id", "user_tags")
    return R.boost(hits_of(spark, sf_dir).join(tags, "id").join(mine, "query_id"), 0.25)


@query(
    f"""WITH {HITS} SELECT query_id, id, round(score, 6) AS score, round(original_score, 6) AS original_score, was_boosted,
    CAST(CASE WHEN was_boosted THEN 1.25 ELSE 1.0 END AS DOUBLE) AS boost_factor, CAST(rank AS INTEGER) AS rank FROM r"""
)
def boosted_rerank(spark, sf_dir):
    return boosted(spark, sf_dir).select(
        "query_id",
        "id",
        F.round("score", 6).alias("score"),
        F.round("original_score", 6).alias("original_score"),
        "was_boosted",
        "boost_factor",
        "rank",
    )


def truth(spark, sf_dir) -> DataFrame:
    """Each query expects the next point after it."""
    return asked(vectors(spark, sf_dir)).select("query_id", (F.col("query_id") + 1).alias("expected_id"))


TRUTH = """e AS (SELECT vec_id AS query_id, vec_id + 1 AS expected_id FROM embeddings WHERE vec_id % 50 = 0),
    x AS (SELECT e.query_id, e.expected_id, r.rank IS NOT NULL AS found, CAST(r.rank AS INTEGER) AS rank,
    (SELECT max(was_boosted) FROM r s WHERE s.query_id = e.query_id) AS was_boosted
    FROM e LEFT JOIN r ON r.query_id = e.query_id AND r.id = e.expected_id)"""


@query(f"WITH {HITS}, {TRUTH} SELECT * FROM x")
def rank_of_expected(spark, sf_dir):
    return R.ranks_of_expected(boosted(spark, sf_dir), truth(spark, sf_dir))


@query(
    f"""WITH {HITS}, {TRUTH} SELECT count(*) AS total, count(*) FILTER (WHERE found) AS found,
    avg(CASE WHEN rank <= 5 THEN 1.0 ELSE 0.0 END) AS recall_at_5, avg(CASE WHEN rank <= 10 THEN 1.0 ELSE 0.0 END) AS recall_at_10,
    avg(CASE WHEN was_boosted THEN 1.0 ELSE 0.0 END) AS boost_rate FROM x"""
)
def recall_at_k(spark, sf_dir):
    return R.recall(R.ranks_of_expected(boosted(spark, sf_dir), truth(spark, sf_dir)), 5, 10)


@query(
    """SELECT a.vec_id, round(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) /
    (sqrt(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[]))) *
     sqrt(list_dot_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])))), 6) AS similarity
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"""
)
def pair_similarity(spark, sf_dir):
    a = vectors(spark, sf_dir)
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return a.join(b, "vec_id").select("vec_id", F.round(cosine(F.col("embedding"), F.col("other")), 6).alias("similarity"))


@query("SELECT vec_id AS id, label, CAST(1.0 AS DOUBLE) AS score FROM embeddings WHERE vec_id = 42")
def get_by_id(spark, sf_dir):
    points = vectors(spark, sf_dir).select(F.col("vec_id").alias("id"), "label")
    return R.by_id(points, 42)


@query("SELECT count(*) AS points_count, max(len(embedding)) AS dim FROM embeddings")
def collection_stats(spark, sf_dir):
    return vectors(spark, sf_dir).agg(F.count("*").alias("points_count"), F.max(F.size("embedding")).cast("bigint").alias("dim"))


@query(
    """SELECT vec_id AS id, CASE WHEN vec_id % 3 = 0 THEN label + 100 ELSE label END AS label FROM embeddings"""
)
def upsert_merge(spark, sf_dir):
    points = vectors(spark, sf_dir).select(F.col("vec_id").alias("id"), "label")
    new = points.where("id % 3 = 0").withColumn("label", F.col("label") + 100)
    return merge_points(points.where("id % 2 = 0"), points.where("id % 2 = 1").unionByName(new).groupBy("id").agg(F.max("label").alias("label")))


ASKED = [key for keys, _ in T.QUERY_TAGS for key in keys]
HIT = " || ".join(
    "CASE WHEN " + " OR ".join(f"contains(lower(q), '{k}')" for k in keys) + " THEN [" + ", ".join(f"'{t}'" for t in tags) + "] ELSE [] END"
    for keys, tags in T.QUERY_TAGS
)


@query(
    f"""WITH d AS (SELECT doc_id, upper(list_value({", ".join(f"'{k}'" for k in ASKED)})[doc_id % {len(ASKED)} + 1]) || ' ' ||
    list_value({", ".join(f"'{k}'" for k in ASKED)})[doc_id % 5 + 1] || ' ' || text AS q FROM documents)
    SELECT doc_id, array_to_string({HIT}, '|') AS tags FROM d"""
)
def query_tag_rules(spark, sf_dir):
    """Two keywords, one in capitals, before every document's text."""
    key = lambda n: F.element_at(F.array(*map(F.lit, ASKED)), (F.col("doc_id") % n + 1).cast("int"))
    asked_of = F.concat_ws(" ", F.upper(key(len(ASKED))), key(5), "text")
    return docs(spark, sf_dir).select("doc_id", F.array_join(T.tags_of_query(asked_of), "|").alias("tags"))


def records(spark, sf_dir) -> DataFrame:
    """Documents as corpus records."""
    d = docs(spark, sf_dir)
    rows = D.enrich(d.select(F.coalesce("text", F.lit("")).alias("text"), "doc_id", F.col("lang").alias("category"), F.col("source").alias("origin")))
    return rows.select(
        "text", F.concat_ws("/", "origin", F.col("doc_id").cast("string")).alias("source"), "category", "hash_sha1", "token_estimate",
        F.array("category", "origin").alias("tags"), F.col("doc_id").alias("seq"),
    )


RECORDS = "r AS (SELECT *, coalesce(text, '') AS t, source || '/' || doc_id AS path FROM documents)"


@query(
    f"""WITH {RECORDS} SELECT path AS source, lang AS category, sha1(t) AS hash_sha1, CAST(length(t) AS INTEGER) AS n_chars,
    lang || ',' || source AS tags FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) AS n FROM r) WHERE n = 1"""
)
def jsonl_last_writer(spark, sf_dir):
    """Records written as JSON lines, the last of equal texts, and read again by the readers' defaults."""
    folder = new_folder(spark, "jsonl")
    S.write_jsonl(records(spark, sf_dir), folder, "seq")
    found = S.read_jsonl(spark, folder).where("_corrupt is null and text is not null")
    return found.select("source", "category", "hash_sha1", F.length("text").alias("n_chars"), F.array_join("tags", ",").alias("tags"))


@query(
    f"""WITH {RECORDS} SELECT sha1(t) || '.jsonl' AS file, path AS source, lang AS category, CAST(length(t) AS INTEGER) AS n_chars
    FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) AS n FROM r) WHERE n = 1"""
)
def record_files(spark, sf_dir):
    """Every record in a file of its own, named by its hash; the last of equal texts."""
    folder = new_folder(spark, "records")
    write_record_files(records(spark, sf_dir), folder, "seq")
    found = S.read_record_files(spark, folder).where("_corrupt is null and text is not null")
    return found.select(T.file_name(F.col("path")).alias("file"), "source", "category", F.length("text").alias("n_chars"))


@query(
    f"""WITH {RECORDS}, x AS (SELECT lang, source, count(*) AS n FROM r WHERE t <> '' GROUP BY ALL)
    SELECT 'category' AS dimension, lang AS key, sum(n)::BIGINT AS n FROM x GROUP BY lang
    UNION ALL SELECT 'tag', key, sum(n)::BIGINT FROM (SELECT unnest([lang, source]) AS key, n FROM x) GROUP BY key"""
)
def taxonomy_of_records(spark, sf_dir):
    """Records appended as JSON lines in two parts, read again and counted."""
    folder = new_folder(spark, "jsonl")
    rows = records(spark, sf_dir)
    for part in (F.col("seq") % 2 == 0, F.col("seq") % 2 == 1):
        S.write_jsonl(rows.where(part).drop("seq"), folder, append=True)
    counts = X.counters(S.read_jsonl(spark, folder).where("_corrupt is null"), [])
    return counts.where("dimension in ('category', 'tag')")


def stored(spark, sf_dir) -> VectorStore:
    """All embeddings in a store: the even ones, then all with another payload."""
    store = VectorStore(spark, new_folder(spark, "store"))
    store.create(64)
    empty = F.from_json(F.lit("{}"), f"struct<{PAYLOAD}>")
    body = F.col("embedding").cast("array<float>")
    rows = vectors(spark, sf_dir).select(
        F.col("vec_id").cast("string").alias("id"), body.alias("body"), body.alias("summary_vec"),
        empty.withField("category", F.col("label").cast("string")).withField("text", F.lit("old")).alias("payload"),
    )
    store.upsert(rows.where("CAST(id AS long) % 2 = 0"))
    store.upsert(rows.withColumn("payload", F.col("payload").withField("text", F.concat(F.lit("new "), "id"))))
    return store


@query("SELECT CAST(vec_id AS VARCHAR) AS id, CAST(label AS VARCHAR) AS category, 'new ' || vec_id AS text, len(embedding) AS dim FROM embeddings")
def store_upsert(spark, sf_dir):
    points = stored(spark, sf_dir).read()
    return points.select("id", "payload.category", "payload.text", F.size("body").cast("long").alias("dim"))


@query(
    f"""WITH e AS (SELECT vec_id, label, CAST(CAST(embedding AS FLOAT[]) AS DOUBLE[]) AS embedding FROM embeddings)
    SELECT query_id, id, round(score, 5) AS score, CAST(rank AS INTEGER) AS rank, category FROM (SELECT CAST(a.vec_id AS VARCHAR) AS query_id,
    CAST(b.vec_id AS VARCHAR) AS id, CAST(b.label AS VARCHAR) AS category, {COSINE} AS score,
    row_number() OVER (PARTITION BY a.vec_id ORDER BY {COSINE} DESC, CAST(b.vec_id AS VARCHAR)) AS rank
    FROM e a, e b WHERE a.vec_id % 50 = 0) WHERE rank <= 10"""
)
def store_search(spark, sf_dir):
    """Searches in a store; queries are every point whose id is divisible by 50."""
    store = stored(spark, sf_dir)
    asks = asked(vectors(spark, sf_dir)).select(F.col("query_id").cast("string").alias("query_id"), F.col("query_vector").cast("array<float>").alias("query_vector"))
    return store.search(asks, 10).select("query_id", "id", F.round("score", 5).alias("score"), "rank", "category")


@query(
    """SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total
    FROM events GROUP BY ALL"""
)
def event_windows(spark, sf_dir):
    found = I.window_counts(table(spark, sf_dir, "events"))
    return found.select("window_start", "event_type", "n", F.round("total", 4).alias("total"))


EXACT = f"""(SELECT a.vec_id AS query_id, b.vec_id AS id, {COSINE} AS score,
    row_number() OVER (PARTITION BY a.vec_id ORDER BY {COSINE} DESC, b.vec_id) AS rank
    FROM embeddings a, embeddings b WHERE a.vec_id % 50 = 0)"""


def indexed(spark, sf_dir) -> VectorIndex:
    return VectorIndex.build(vectors(spark, sf_dir), new_folder(spark, "index"), id_col="vec_id", vector="embedding")


@query(f"SELECT query_id, id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM {EXACT} WHERE rank <= 10")
def index_all_cells(spark, sf_dir):
    """Searches that probe every cell of an index find what an exact search finds."""
    found = indexed(spark, sf_dir).search(asked(vectors(spark, sf_dir)), 10, probes=1 << 30)
    return found.select("query_id", "id", F.round("score", 6).alias("score"), "rank")


@query()
def index_search(spark, sf_dir):
    """The same with as many cells as the index has measured to find nineteen in twenty."""
    return indexed(spark, sf_dir).search(asked(vectors(spark, sf_dir)), 10)


@query(f"SELECT count(*) AS expected, true AS nine_in_ten FROM {EXACT} WHERE rank <= 10")
def index_recall(spark, sf_dir):
    """How many hits an exact search has, and whether the index finds nine in ten of them."""
    asks = asked(vectors(spark, sf_dir))
    met = overlap(indexed(spark, sf_dir).search(asks, 10), hits_of(spark, sf_dir))
    return met.select("expected", (F.col("recall") >= 0.9).alias("nine_in_ten"))


@query("SELECT CAST(vec_id AS VARCHAR) AS id, CAST(label AS VARCHAR) AS category, 1.0::DOUBLE AS score FROM embeddings WHERE vec_id = 42")
def store_get(spark, sf_dir):
    """One point from the one folder of the store that can hold it."""
    return stored(spark, sf_dir).get("42").select("id", "payload.category", "score")


@query("SELECT 'documents' AS name, count(*) AS points_count, 'ready' AS status, CAST(64 AS BIGINT) AS dim, 'cosine' AS metric FROM embeddings")
def store_stats(spark, sf_dir):
    """What the store says of itself."""
    said = stored(spark, sf_dir).stats()
    return spark.createDataFrame([tuple(said[c] for c in ("name", "points_count", "status", "dim", "metric"))], "name string, points_count long, status string, dim long, metric string")


@query(
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g)
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM s GROUP BY user_id, s"""
)
def event_sessions(spark, sf_dir):
    return I.sessions(table(spark, sf_dir, "events"))


@query()
def language_detection(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", "lang", plugins.detect_language(F.col("text")).alias("detected"))


@query(
    r"""WITH d AS (SELECT doc_id, lang, string_split(' ' || trim(regexp_replace(lower(text), '[^\p{L}\p{M}]+', ' ', 'g')) || ' ', '') AS c FROM documents
    WHERE regexp_matches(text, '[\p{L}\p{M}]')),
    g AS (SELECT doc_id, lang, c[i] || c[i + 1] || c[i + 2] AS gram, count(*) AS n FROM (SELECT *, unnest(range(1, len(c) - 1)) AS i FROM d) GROUP BY ALL),
    m AS (SELECT lang, gram, sum(n) AS n FROM g WHERE doc_id % 5 <> 0 GROUP BY ALL), t AS (SELECT lang, sum(n) AS total FROM m GROUP BY lang),
    v AS (SELECT count(DISTINCT gram) AS v FROM m),
    s AS (SELECT doc_id, t.lang, CAST(sum(g.n * CAST(floor(1000 * ln((coalesce(m.n, 0) + 1) / (total + v)::DOUBLE)) AS BIGINT)) AS BIGINT) AS score
    FROM g CROSS JOIN t CROSS JOIN v LEFT JOIN m ON m.gram = g.gram AND m.lang = t.lang GROUP BY ALL),
    r AS (SELECT *, row_number() OVER w AS r, score - lead(score) OVER w AS margin FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY score DESC, lang))
    SELECT documents.doc_id, coalesce(r.lang, 'unknown') AS detected, score, margin FROM documents LEFT JOIN r ON r.doc_id = documents.doc_id AND r = 1"""
)
def language_scores(spark, sf_dir):
    """The language of every document, by trigrams of four documents in five."""
    rows = docs(spark, sf_dir)
    model = LanguageModel.fit(rows.where("doc_id % 5 <> 0"), "lang", F.col("text"))
    return model.detect(rows, "doc_id", F.col("text"))


SENTENCES = rf"""n AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(10), 'g'), chr(10)),
    lambda x: trim(x)), lambda x: x <> '') AS l FROM documents), s AS (SELECT doc_id, unnest(range(len(l))) AS s, unnest(l) AS sentence FROM n),
    w AS (SELECT doc_id, s, unnest(list_filter(string_split_regex(lower(sentence), '[^\p{{L}}\p{{M}}\p{{N}}\p{{Pc}}]+'), lambda x: x <> '')) AS term FROM s),
    x AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY ALL),
    f AS (SELECT term, CAST(floor(1000 * ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)::DOUBLE)) AS BIGINT) AS idf FROM x GROUP BY term),
    y AS (SELECT DISTINCT doc_id, s, term FROM w)"""


@query(
    f"""WITH {SENTENCES} SELECT doc_id, CAST(s AS INTEGER) AS s, CAST(trunc(sum(tf * idf) / (count(*) + 3)) AS BIGINT) AS score
    FROM y JOIN x USING (doc_id, term) JOIN f USING (term) GROUP BY doc_id, s"""
)
def sentence_scores(spark, sf_dir):
    """The score of every sentence of every document."""
    return E.scored(E.weighed_words(docs(spark, sf_dir), "doc_id", F.col("text")), "doc_id").select("doc_id", "s", "score")


@query()
def sentence_summaries(spark, sf_dir):
    """Three telling sentences of each document that aren't alike, and its most telling words."""
    found = E.summaries(docs(spark, sf_dir), "doc_id", F.col("text"))
    return found.select("doc_id", "summary", F.array_join("tags", ",").alias("tags"))


@query()
def extractive_summary(spark, sf_dir):
    said = plugins.summarize(F.col("text"), plugins.ExtractiveSummarizer(), chars=None)
    return docs(spark, sf_dir).select("doc_id", said.alias("s")).select("doc_id", "s.summary", F.array_join("s.tags", ",").alias("tags"))


@query()
def text_embedding_search(spark, sf_dir):
    embedder = plugins.HashingEmbedder(64)
    points = docs(spark, sf_dir).select("doc_id", plugins.embed(F.col("text"), embedder).alias("body"))
    asks = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), plugins.embed(F.col("text"), embedder).alias("query_vector")
    )
    return R.top_k(asks.where("query_vector is not null"), points, 5, point_id="doc_id")


@query(
    f"""WITH {TAGGED}, a AS (SELECT count(*) AS n FROM documents), c AS (SELECT doc_id, tag, count(*) AS tf FROM t GROUP BY ALL),
    v AS (SELECT tag, row_number() OVER (ORDER BY tag) - 1 AS term_id, count(*) AS df FROM c GROUP BY tag)
    SELECT doc_id, term_id, tf, round(tf * ln((a.n + 1) / (df + 1)), 9) AS weight FROM c JOIN v USING (tag), a"""
)
def tag_tfidf(spark, sf_dir):
    """Documents x tags as a table, with dense ids in the order of the tags."""
    found, _ = M.tf_idf(tagged(spark, sf_dir), "doc_id", F.when(F.col("text") != "", F.col("tags")))
    return found.select("doc_id", "term_id", "tf", F.round("weight", 9).alias("weight"))


@query(
    f"""WITH {TAGGED}, u AS (SELECT DISTINCT doc_id, tag FROM t), f AS (SELECT tag, count(*) AS n FROM u GROUP BY tag),
    b AS (SELECT x.tag AS child, y.tag AS parent, fx.n AS n_child, fy.n AS n_parent, count(*) AS n_both FROM u x JOIN u y USING (doc_id)
    JOIN f fx ON fx.tag = x.tag JOIN f fy ON fy.tag = y.tag WHERE fy.n > fx.n OR fy.n = fx.n AND y.tag < x.tag GROUP BY ALL),
    p AS (SELECT *, row_number() OVER (PARTITION BY child ORDER BY n_parent, n_both DESC, parent) AS r FROM b WHERE 100 * n_both >= 25 * n_child)
    SELECT f.tag AS child, parent, f.n AS n_child, n_parent, n_both FROM f LEFT JOIN p ON f.tag = p.child AND r = 1"""
)
def tag_subsumption(spark, sf_dir):
    """Each tag below the tag that subsumes it most closely, from a quarter of its documents on."""
    rows = tagged(spark, sf_dir).where("text <> ''")
    return M.tag_tree(rows, "doc_id", F.col("tags"), 25)


@query()
def latent_search(spark, sf_dir):
    """Documents most alike to each benchmark item, by vectors fitted on the documents' words."""
    rows = docs(spark, sf_dir)
    blocks = M.bags(rows, "doc_id", M.words_of(F.col("text")))
    model = M.LatentModel.fit_bags(blocks, spent=True)
    items = M.counted(table(spark, sf_dir, "benchmark"), "item_id", M.words_of(F.col("text")))
    asks = model.embed(items, "item_id").select(F.col("item_id").alias("query_id"), F.col("vector").alias("query_vector"))
    return R.top_k(asks, model.embed_bags(blocks, "doc_id"), 5, point_id="doc_id", vector="vector")


@query()
def tag_tfidf_clusters(spark, sf_dir):
    return X.tag_clusters(tagged(spark, sf_dir), 4, "doc_id").select("doc_id", F.col("cluster").cast("int"))
