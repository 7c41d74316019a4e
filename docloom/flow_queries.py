"""Queries that go through files, stores and streams made of the driver's tables, and their SQL."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import plugins
from docloom.functions import text as T
from docloom.monitoring import Monitor
from docloom.operators import search as R
from docloom.operators.store import VectorStore
from docloom.plans import corpus as C
from docloom.queries import RECORDS, STRIP, WORDS, docs, query, records, table
from docloom.scratch import new_folder
from docloom.sources import files as S
from docloom.sources.parsers import ParserRegistry, RtfParser
from docloom.sources.record_files import write_files
from docloom.streaming.changes import watch_changes

KINDS = [".pdf", ".docx", ".msg", ".txt"]


def files_made(rows: DataFrame, label: str, suffix: str = "") -> str:
    """A folder with a file (name, value) for each row."""
    folder = new_folder(rows.sparkSession, label)
    write_files(rows, folder, suffix)
    return folder


def as_files(spark, sf_dir) -> str:
    """Every document as a file, of one of four kinds."""
    kind = F.element_at(F.array(*map(F.lit, KINDS)), (F.col("doc_id") % 4 + 1).cast("int"))
    name = F.concat(F.lit("d"), "doc_id", kind)
    return files_made(docs(spark, sf_dir).select(name.alias("name"), F.coalesce("text", F.lit("")).alias("value")), "files")


FILES = """f AS (SELECT 'd' || doc_id || k AS name, k AS suffix, coalesce(text, '') || chr(10) AS content FROM
    (SELECT *, list_value('.pdf', '.docx', '.msg', '.txt')[doc_id % 4 + 1] AS k FROM documents))"""


@query(f"WITH {FILES} SELECT name, suffix, CAST(strlen(content) AS BIGINT) AS size_bytes, md5(content) AS digest FROM f WHERE suffix <> '.txt'")
def file_scan(spark, sf_dir):
    """Files of the kinds that have parsers, with their content."""
    found = S.ingest(spark, as_files(spark, sf_dir))
    return found.select(T.file_name(F.col("path")).alias("name"), T.suffix(F.col("path")).alias("suffix"), "size_bytes", F.md5("content").alias("digest"))


@query(f"WITH {FILES} SELECT name, suffix, CAST(strlen(content) AS BIGINT) AS size_bytes, CAST(NULL AS VARCHAR) AS error FROM f")
def file_inventory(spark, sf_dir):
    """All files listed in a CSV, and the CSV read again."""
    out = new_folder(spark, "inventory")
    S.write_csv(S.inventory(spark, as_files(spark, sf_dir)), out)
    rows = spark.read.option("header", "true").option("escape", '"').csv(out)
    return rows.select(T.file_name(F.col("path")).alias("name"), "suffix", F.col("size_bytes").cast("long"), "error")


@query(f"WITH {FILES} SELECT name, length(substr(content, 1, 800)) AS n_chars, md5(substr(content, 1, 800)) AS digest FROM f")
def file_snippets(spark, sf_dir):
    """The first 800 characters of every file."""
    found = S.snippets(S.all_files(spark, as_files(spark, sf_dir)).select("path", "content"))
    return found.select(T.file_name(F.col("path")).alias("name"), F.length("snippet").cast("long").alias("n_chars"), F.md5("snippet").alias("digest"))


@query(f"WITH {FILES} SELECT name, 'added' AS change, CAST(strlen(content) AS BIGINT) AS size_bytes FROM f WHERE suffix <> '.txt'")
def folder_events(spark, sf_dir):
    """A stream that finds every file of a folder added, once, over two runs from one checkpoint."""
    folder, out, state, check = as_files(spark, sf_dir), *(new_folder(spark, x) for x in ("events", "state", "check"))
    for _ in range(2):
        rows = watch_changes(spark, folder.removeprefix("file://"), state.removeprefix("file://"))
        stream = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", check)
        stream.trigger(availableNow=True).start().awaitTermination()
    events = spark.read.schema(rows.schema).parquet(out)
    return events.select(T.file_name(F.col("path")).alias("name"), "change", "size_bytes")


def rich_text(text):
    """A text as rich text: braces and backslashes escaped, lines as paragraphs, other than ASCII by number."""
    plain = F.coalesce(text, F.lit(""))
    for char, escape in (("\\", "\\\\"), ("{", "\\{"), ("}", "\\}"), ("\n", "\\par ")):
        plain = F.replace(plain, F.lit(char), F.lit(escape))
    number = lambda c: F.when(F.ascii(c) > 127, F.concat(F.lit("\\u"), F.ascii(c), F.lit("?"))).otherwise(c)
    # Runs of ASCII stay whole: most texts have few other characters.
    coded = F.array_join(F.transform(F.regexp_extract_all(plain, F.lit(r"[\x00-\x7F]+|[^\x00-\x7F]"), F.lit(0)), number), "")
    return F.concat(F.lit("{\\rtf1\\ansi "), coded, F.lit("}"))


@query(
    rf"""WITH p AS (SELECT doc_id, regexp_replace(nfc_normalize(coalesce(text, '')), '^[\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]+|[\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]+$', '', 'g') AS text FROM documents),
    r AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id DESC) AS n, count(*) OVER (PARTITION BY text) AS copies FROM p)
    SELECT 'd' || lpad(doc_id::VARCHAR, 12, '0') || '.rtf' AS name, 'root' AS category, sha1(text) AS hash_sha1, CAST(len({WORDS}) AS INTEGER) AS token_estimate,
    CAST(strlen(text) AS BIGINT) AS size_bytes_text, CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS INTEGER) AS line_count, copies > 1 AS is_duplicate
    FROM r WHERE n = 1"""
)
def corpus_records(spark, sf_dir):
    """Every document as a rich text file, through the whole pipeline to a file for each record, and read again."""
    name = F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 12, "0"))
    folder = files_made(docs(spark, sf_dir).select(name.alias("name"), rich_text(F.col("text")).alias("value")), "rich", ".rtf")
    out = new_folder(spark, "records")
    C.run_pipeline(spark, folder, out, registry=ParserRegistry([RtfParser()]), mode="literal", file_per_record=True)
    rows = S.read_record_files(spark, out).where("_corrupt is null and text is not null")
    hashed = F.regexp_extract("path", r"([0-9a-f]+)\.jsonl$", 1)
    return rows.select(
        T.file_name(F.col("source")).alias("name"), "category", hashed.alias("hash_sha1"), "token_estimate", "size_bytes_text", "line_count", "is_duplicate"
    )


@query("SELECT count(*) AS parsed, CAST(0 AS BIGINT) AS failed, count(*) - count(DISTINCT coalesce(text, '')) AS duplicates FROM documents")
def corpus_metrics(spark, sf_dir):
    """What the jobs of a pipeline counted while they ran."""
    monitor = Monitor()
    name = F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 12, "0"))
    folder = files_made(docs(spark, sf_dir).select(name.alias("name"), rich_text(F.col("text")).alias("value")), "rich", ".rtf")
    C.run_pipeline(spark, folder, new_folder(spark, "records"), registry=ParserRegistry([RtfParser()]), mode="literal", monitor=monitor)
    parse, made = monitor.stage("parse"), monitor.stage("enrich")
    return spark.createDataFrame([(parse.rows, parse.failed, made.counts["duplicates"])], "parsed long, failed long, duplicates long")


class Letters:
    """How often each letter from a to z stands in a text, as a vector of length one."""

    dim = 26

    def embed(self, texts: list[str]) -> np.ndarray:
        counts = np.array([[low.count(chr(97 + i)) for i in range(26)] for low in map(str.lower, texts)], float).reshape(len(texts), 26)
        size = np.linalg.norm(counts, axis=1, keepdims=True)
        return np.divide(counts, size, out=counts, where=size > 0)


def letters_sql(text: str) -> str:
    return f"list_transform(range(26), lambda i: CAST(length({text}) - length(replace(lower({text}), chr(CAST(97 + i AS INTEGER)), '')) AS DOUBLE))"


def loaded(spark, sf_dir) -> tuple[VectorStore, C.LoadStats]:
    """All records as JSON lines, loaded into a store."""
    folder = new_folder(spark, "jsonl")
    rows = records(spark, sf_dir).withColumn("hash_content", F.col("hash_sha1"))
    S.write_jsonl(rows, folder, "seq")
    store = VectorStore(spark, new_folder(spark, "store"))
    return store, C.load_folder(spark, folder, store, Letters())


LETTERS = f"""{RECORDS}, o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) AS n FROM r) WHERE n = 1),
    k AS (SELECT *, {letters_sql("t")} AS raw FROM o), l AS (SELECT * FROM k WHERE list_sum(raw) > 0)"""


@query(
    f"""WITH {LETTERS} SELECT (SELECT count(*) FROM o) AS total, (SELECT count(*) FROM l) AS uploaded, (SELECT count(*) FROM o) - (SELECT count(*) FROM l) AS failed,
    round(100.0 * (SELECT count(*) FROM l) / (SELECT count(*) FROM o), 6) AS success_rate"""
)
def load_statistics(spark, sf_dir):
    """Records read, points written and records that gave none."""
    _, stats = loaded(spark, sf_dir)
    row = (stats.total, stats.uploaded, stats.failed, round(stats.success_rate, 6))
    return spark.createDataFrame([row], "total long, uploaded long, failed long, success_rate double")


def item_queries(spark, sf_dir) -> DataFrame:
    """Every benchmark item asks for its text's like, and for documents in German; one asks nothing."""
    asks = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"), F.array(F.lit("de"), F.lit("none")).alias("user_tags"))
    return asks.unionByName(asks.limit(1).select(F.lit(-1).cast("long").alias("query_id"), F.lit("  ").alias("query"), "user_tags"))


FOUND = f"""{LETTERS}, e AS (SELECT *, list_transform(raw, lambda x: CAST(CAST(x / sqrt(list_dot_product(raw, raw)) AS FLOAT) AS DOUBLE)) AS v FROM l),
    b AS (SELECT item_id, {letters_sql("text")} AS raw FROM benchmark), q AS (SELECT item_id, list_transform(raw, lambda x: CAST(CAST(x / sqrt(list_dot_product(raw, raw)) AS FLOAT) AS DOUBLE)) AS v FROM b WHERE list_sum(raw) > 0),
    s AS (SELECT item_id AS query_id, path AS source_path, lang, list_dot_product(q.v, e.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(e.v, e.v))) AS score, t FROM q, e),
    h AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, sha1(t)) AS original_rank FROM s QUALIFY original_rank <= 10),
    z AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score * CASE WHEN lang = 'de' THEN 1.25 ELSE 1 END DESC, original_rank) AS rank FROM h)"""


@query(
    f"""WITH {FOUND} SELECT query_id, CAST(rank AS INTEGER) AS rank, CAST(original_rank AS INTEGER) AS original_rank, lang = 'de' AS was_boosted,
    round(score, 5) AS original_score, lang AS category, CASE WHEN lang = 'de' THEN 'de' ELSE '' END AS matched FROM z"""
)
def engine_search(spark, sf_dir):
    """Hybrid search of a loaded store: the ten nearest by letters, those that share a tag boosted and ranked anew."""
    store, _ = loaded(spark, sf_dir)
    hits = C.RetrievalEngine(store, Letters()).search_batch(item_queries(spark, sf_dir), 10, 0.25)
    return hits.select(
        "query_id", "rank", "original_rank", "was_boosted", F.round("original_score", 5).alias("original_score"), "category", F.array_join("matched_tags", ",").alias("matched")
    )


@query(f"WITH {FOUND} SELECT query_id, count(*) AS n_hits, count(*) FILTER (WHERE lang = 'de') AS n_boosted FROM z GROUP BY query_id")
def engine_boosts(spark, sf_dir):
    """How many hits of each search were boosted."""
    store, _ = loaded(spark, sf_dir)
    return R.boosted_counts(C.RetrievalEngine(store, Letters()).search_batch(item_queries(spark, sf_dir), 10, 0.25))


UUID5 = """lower(substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
    printf('%02x', (CAST('0x' || substr(h, 17, 2) AS INTEGER) & 63) | 128) || substr(h, 19, 2) || '-' || substr(h, 21, 12))"""


@query(
    f"""SELECT query, {UUID5} AS expected_doc_id FROM (SELECT 'find ' || doc_id || ', "quoted"' AS query,
    sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(sha1(text))) AS h FROM documents WHERE doc_id % 3 <> 0)
    UNION ALL SELECT 'find ' || doc_id || ', "quoted"', left(sha1(text), 39) FROM documents WHERE doc_id % 3 = 0 AND doc_id % 2 = 0"""
)
def ground_truth(spark, sf_dir):
    """Ground truth written as CSV with stray quotes, spaces and blank rows; read, cleaned, its ids made points' ids and saved again."""
    first, second = new_folder(spark, "truth"), new_folder(spark, "truth")
    wanted = F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit(' "'), F.sha1("text"), F.lit(" "))).when(F.col("doc_id") % 2 == 0, F.substring(F.sha1("text"), 1, 39))
    rows = docs(spark, sf_dir).select(F.concat(F.lit(" find "), "doc_id", F.lit(', "quoted" ')).alias("query"), F.coalesce(wanted, F.lit(" ")).alias("expected_doc_id"))
    S.write_csv(rows, first)
    S.save_ground_truth(S.read_ground_truth(spark, first, clean=True), second)
    return S.read_ground_truth(spark, second)


@query(
    f"""WITH {RECORDS}, x AS (SELECT lang, path, count(*) AS n FROM r WHERE t <> '' GROUP BY ALL)
    SELECT 'category_sources' AS part, lang AS key, path AS value, CAST(NULL AS BIGINT) AS n FROM x
    UNION ALL SELECT 'counts', 'category', lang, count(*) FROM x GROUP BY lang
    UNION ALL SELECT DISTINCT 'category_tags', lang, unnest([lang, split_part(path, '/', 1)]), NULL FROM x
    UNION ALL SELECT 'statistics', k, NULL, v FROM (SELECT unnest(['total_categories', 'total_sources', 'total_tags']) AS k,
    unnest([count(DISTINCT lang), count(DISTINCT path), count(DISTINCT lang) + count(DISTINCT split_part(path, '/', 1))]) AS v FROM x)"""
)
def taxonomy_files(spark, sf_dir):
    """The taxonomy of records written as JSON documents and tables, some of which are read again."""
    folder, out = new_folder(spark, "jsonl"), new_folder(spark, "taxonomy")
    S.write_jsonl(records(spark, sf_dir).drop("seq"), folder)
    C.analyze(spark, folder, out)
    none = lambda kind: F.lit(None).cast(kind)
    part = lambda name, rows, key, value, n: rows.select(F.lit(name).alias("part"), key.alias("key"), value.alias("value"), n.alias("n"))
    pairs = "category string, value string"
    stats = spark.read.option("multiLine", "true").json(f"{out}/taxonomy_stats.json")
    shown = F.explode(F.create_map(*[x for c in ("total_categories", "total_sources", "total_tags") for x in (F.lit(c), F.col(c).cast("long"))]))
    sums = stats.select(shown.alias("k", "v"))
    counts = spark.read.schema("dimension string, key string, n long").json(f"{out}/tables/counts").where("dimension = 'category'")
    out_of = lambda name: spark.read.schema(pairs).json(f"{out}/tables/{name}")
    found = part("statistics", sums, F.col("k"), none("string"), F.col("v"))
    found = found.unionByName(part("counts", counts, F.col("dimension"), F.col("key"), F.col("n")))
    for name in ("category_sources", "category_tags"):
        found = found.unionByName(part(name, out_of(name), F.col("category"), F.col("value"), none("long")))
    return found


class Answers:
    """Replies in fenced JSON with the file's name, its kind and the first word of its text; every seventh is no JSON."""

    def complete(self, prompts: list[str]) -> list[str]:
        out = []
        for p in prompts:
            name, kind, text = p.split("|", 2)
            word = (text.split() or ["none"])[0]
            said = json.dumps({"nazov_suboru": name.upper(), "tagy": f"{kind[1:]}, x,", "sumar": word})
            out.append("sorry" if name.startswith("d7") else f"```json\n{said}\n```")
        return out


@query(
    f"""WITH {FILES} SELECT CASE WHEN name LIKE 'd7%' THEN name ELSE upper(name) END AS nazov_suboru, suffix AS typ_suboru,
    CASE WHEN name NOT LIKE 'd7%' THEN suffix[2:] || ',x' END AS tagy, CASE WHEN name NOT LIKE 'd7%' THEN
    CASE WHEN {STRIP} = '' THEN 'none' ELSE {WORDS}[1] END END AS sumar FROM (SELECT *, substr(content, 1, 800) AS text FROM f)"""
)
def raw_metadata(spark, sf_dir):
    """Metadata that a model gives for every file, written as JSON lines and loaded again."""
    out = new_folder(spark, "metadata")
    C.extract_metadata(spark, as_files(spark, sf_dir), out, plugins.MetadataModel(Answers(), "{file_name}|{file_type}|{snippet}"))
    return S.load_raw_metadata(spark, out).select("nazov_suboru", "typ_suboru", F.array_join("tagy", ",").alias("tagy"), "sumar")
