"""From files to corpus records, and from records to a searchable store."""

from __future__ import annotations

import json
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docloom.functions import plugins
from docloom.functions import text as T
from docloom.functions.plugins import Embedder, LanguageDetector, OcrBackend, Summarizer
from docloom.operators import documents as D
from docloom.operators import taxonomy as X
from docloom.monitoring import Monitor
from docloom.operators.language import LanguageModel
from docloom.operators.store import VectorStore
from docloom.operators.summary import summaries
from docloom.operators.terms import tag_tree
from docloom.scratch import written
from docloom.settings import Settings
from docloom.sources import files as S
from docloom.sources.parsers import ParserRegistry
from docloom.sources.record_files import write_record_files


@dataclass
class Metrics:
    """What a run counted while it wrote: records, copies among them, files that failed, its seconds, and all by stage."""

    processed: int
    duplicates: int
    failed: int
    seconds: float
    monitor: Monitor | None = None


@dataclass
class Corpus:
    """Records of a run, and what failed: (path, stage, error)."""

    records: DataFrame
    dead: DataFrame
    metrics: Metrics | None = None


def ocr(rows: DataFrame, backend: OcrBackend) -> DataFrame:
    """Where thin is true the text becomes what the backend reads in content, stripped, and ocr true; both columns leave."""

    def run(batches):
        for b in batches:
            thin = b["thin"].to_numpy(dtype=bool)
            if thin.any():
                b.loc[thin, "text"] = [t.strip() for t in backend.read(b.loc[thin, "content"].tolist())]
            b["ocr"] = [True if t else None for t in thin]
            yield b.drop(columns=["content", "thin"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.drop("content", "thin").schema)
    return rows.mapInPandas(run, schema + ", ocr boolean")


def build_corpus(
    spark: SparkSession,
    root: str,
    *,
    registry: ParserRegistry | None = None,
    ocr_backend: OcrBackend | None = None,
    detector: LanguageDetector | None = None,
    summarizer: Summarizer | None = None,
    mode: str = "intended",
    max_bytes: int = 8_000_000,
    max_lines: int = 1000,
    monitor: Monitor | None = None,
    language_model: LanguageModel | None = None,
    extract: bool = False,
) -> Corpus:
    """Scan, parse, normalise, OCR where a PDF has next to no text, enrich, flag copies, flag sizes.

    Line counts and sizes are those before white space is folded. Files that no parser reads go to
    dead with their error; nothing else is lost. Copies are flagged in order of (suffix, path). A language model takes
    the detector's place; with extract, summaries are the texts' own telling sentences instead of the summarizer's.
    """
    found = S.ingest(spark, root, tuple(s for p in (registry or ParserRegistry()).parsers for s in p.suffixes))
    parsed = S.parse(found, registry, keep_content=ocr_backend is not None)
    if ocr_backend is None:
        parsed = parsed.withColumn("ocr", F.lit(None).cast("boolean"))
    else:
        thin = F.col("error").isNull() & (T.suffix(F.col("path")) == ".pdf") & T.needs_ocr(T.normalize(F.col("text"), mode))
        thin = F.coalesce(thin, F.lit(False))
        parsed = ocr(parsed.withColumn("thin", thin).withColumn("content", F.when(F.col("thin"), F.col("content"))), ocr_backend)
    # Written, so that records and dead letters come from one parse; counted while it is.
    monitor = monitor or Monitor()
    parsed = monitor.observe("parse", parsed, F.col("error").isNotNull(), "seconds")
    parsed = monitor.run("parse", lambda: written(parsed, "parsed")).drop("seconds")
    dead = parsed.where("error is not null").select("path", F.lit("parse").alias("stage"), "error")
    good = parsed.where("error is null").drop("error")
    rows = good.withColumn("raw", T.normalize(F.col("text"), mode, collapse=False)).withColumn(
        "text", T.normalize(F.col("text"), mode)
    )
    spoken = plugins.summarize(F.col("text"), summarizer)
    if extract:
        rows = rows.join(summaries(rows, "path", F.col("text")).select("path", F.struct("summary", "tags").alias("_said")), "path", "left")
        spoken = F.col("_said")
    language = plugins.detect_language(F.col("text"), detector)
    if language_model is not None:
        rows = rows.join(language_model.detect(rows, "path", F.col("text")).select("path", "detected"), "path", "left")
        language = F.col("detected")
    rows = rows.withColumns(
        {
            "source": F.col("path"),
            "language": language,
            "category": T.category_of(F.col("path"), root),
            "created_ts": F.lit(None).cast("double"),
            "modified_ts": F.unix_micros("modified_ts") / 1e6,
            "_s": spoken,
            "size_bytes_text": T.size_bytes_text(F.col("raw")),
            "line_count": T.line_count(F.col("raw")),
            "requires_split": T.requires_split(F.col("raw"), max_bytes, max_lines),
            "_seq": F.concat_ws(" ", T.suffix(F.col("path")), "path"),
        }
    )
    rows = D.enrich(rows, mode=mode).withColumns({"summary": F.col("_s.summary"), "tags": F.col("_s.tags")})
    rows = D.flag_duplicates(rows, "_seq").drop("raw", "_s", "_said", "detected")
    return Corpus(rows, dead)


def run_pipeline(spark: SparkSession, root: str, out: str, *, file_per_record: bool = False, monitor: Monitor | None = None, **options) -> Corpus:
    """build_corpus, written as JSON lines: one record for each content, the last writer's.

    With file_per_record each goes to its own file <hash_sha1>.jsonl, which replaces an earlier one; otherwise out is
    written anew. What the metrics say was counted by the jobs that parsed, enriched and wrote.
    """
    began = time.perf_counter()
    monitor = monitor or Monitor()
    corpus = build_corpus(spark, root, monitor=monitor, **options)
    # Written once: summaries and languages may come from costly models.
    records = monitor.observe("enrich", corpus.records, duplicates=F.col("is_duplicate"))
    corpus.records = monitor.run("enrich", lambda: written(records, "records"))
    write = write_record_files if file_per_record else S.write_jsonl
    monitor.run("write", lambda: write(corpus.records, out, "_seq"))
    made = monitor.stage("enrich")
    corpus.metrics = Metrics(made.rows, made.counts["duplicates"], monitor.stage("parse").failed, time.perf_counter() - began, monitor)
    return corpus


def extract_metadata(spark: SparkSession, root: str, out: str, summarizer: Summarizer | None = None) -> DataFrame:
    """Metadata records of all files from their names and first characters, appended to out as JSON lines.

    A model that takes fields of its own (MetadataModel) may answer with any of them; a summarizer answers with summary
    and tags. The records that come back are those written: no model is called again when they are used.
    """
    rows = S.snippets(S.all_files(spark, root).select("path", "content"))
    named = rows.withColumns({"_name": T.file_name(F.col("path")), "_suffix": T.suffix(F.col("path"))})
    if isinstance(summarizer, plugins.MetadataModel):
        said = plugins.describe(F.col("_name"), F.col("_suffix"), F.col("snippet"), summarizer)
        answer = {"name": F.col("_s.nazov_suboru"), "suffix": F.col("_s.typ_suboru"), "tags": F.col("_s.tagy"), "summary": F.col("_s.sumar")}
    else:
        said = plugins.summarize(F.col("snippet"), summarizer, 800)
        none = F.lit(None).cast("string")
        answer = {"name": none, "suffix": none, "tags": F.col("_s.tags"), "summary": F.col("_s.summary")}
    records = named.withColumn("_s", said).select(
        F.col("path").alias("cesta_k_suboru"),
        F.coalesce(answer["name"], "_name").alias("nazov_suboru"),
        F.coalesce(answer["suffix"], "_suffix").alias("typ_suboru"),
        answer["tags"].alias("tagy"),
        answer["summary"].alias("sumar"),
    )
    records = written(records, "metadata")
    records.write.mode("append").json(out)
    return records


def analyze(spark: SparkSession, records: str, out: str | None = None) -> dict:
    """Taxonomy of a folder of records, a report of bounded lists; with out also written as JSON documents, and every list whole as a table."""
    docs = written(S.read_jsonl(spark, records).withColumn("_id", F.monotonically_increasing_id()), "records")
    counts = written(X.counters(docs), "counts")
    taxonomy = X.taxonomy_document(docs, counts=counts)
    if out:
        tables = {
            "counts": counts, "category_tags": X.category_values(docs, "tags"), "category_sources": X.category_values(docs, "source"),
            "source_edges": X.source_edges(docs), "regions": X.region_rollup(docs), "tag_tree": tag_tree(docs, "_id", F.col("tags")),
        }
        for name, table in tables.items():
            table.write.mode("overwrite").json(f"{out.rstrip('/')}/tables/{name}")
        parts = {
            "taxonomy_complete": taxonomy,
            "categories": taxonomy["categories"],
            "tags": taxonomy["tags"],
            "countries": taxonomy["countries"],
            "sources": taxonomy["sources"],
            "taxonomy_rag": X.rag_document(taxonomy),
            "taxonomy_stats": taxonomy["statistics"],
        }
        path = spark._jvm.org.apache.hadoop.fs.Path
        for name, part in parts.items():
            target = path(f"{out.rstrip('/')}/{name}.json")
            stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
            stream.write(bytearray(json.dumps(part, ensure_ascii=False, indent=2).encode()))
            stream.close()
    return taxonomy


@dataclass
class LoadStats:
    """Records read; points written, which replace those of equal ids; records that gave no point; seconds."""

    total: int
    uploaded: int
    failed: int
    seconds: float = 0.0

    @property
    def success_rate(self) -> float:
        return 100.0 * self.uploaded / self.total if self.total else 0.0


def embedded(points: DataFrame, embedder: Embedder, settings: Settings | None = None) -> DataFrame:
    """Both vectors as columns of the row they belong to; rows without a body vector leave."""
    settings = settings or Settings()
    of = lambda c: plugins.embed(
        F.col(c), embedder, batch_size=settings.batch_size, max_retries=settings.max_retries, retry_delay=settings.retry_delay
    )
    rows = points.withColumns({"body": of("text"), "summary_vec": of("summary")})
    return rows.where("body is not null").select("id", "body", "summary_vec", "payload")


def load_folder(
    spark: SparkSession,
    records: str,
    store: VectorStore,
    embedder: Embedder | None = None,
    pattern: str = S.RECORDS,
    recursive: bool = False,
    settings: Settings | None = None,
) -> LoadStats:
    """Records into the store: prepared, embedded, and merged by id. Loading the same folder again writes it again."""
    began = time.perf_counter()
    embedder = embedder or plugins.embedder_of(settings or Settings())
    store.create(embedder.dim)
    # Counted while they are loaded, so that the files are read once.
    seen = Observation()
    docs = S.read_jsonl(spark, records, recursive, pattern).observe(seen, F.count("*").alias("records"))
    ready = D.prepare_points(docs.where("_corrupt is null"))
    ready = embedded(ready, embedder, settings).withColumn("_seq", F.col("payload.source"))
    done = store.upsert(ready, "_seq")
    total = seen.get["records"]
    return LoadStats(total, done, total - done, time.perf_counter() - began)


class RetrievalEngine:
    """Hybrid search over a store: exact cosine top k, then tag boosting."""

    def __init__(self, store: VectorStore, embedder: Embedder | None = None, settings: Settings | None = None):
        self.settings = settings or Settings()
        self.store, self.embedder = store, embedder or plugins.embedder_of(self.settings)

    def search_batch(
        self, queries: DataFrame, limit: int | None = None, tag_boost: float | None = None, use_summary: bool | None = None,
        approximate: bool = False,
    ) -> DataFrame:
        """queries: query_id, query, user_tags. Blank queries give nothing. All in one plan; approximate needs the store's index."""
        from docloom.operators.search import boost

        limit = limit or self.settings.search_limit
        factor = self.settings.tag_boost if tag_boost is None else tag_boost
        summary = self.settings.use_summary_vector if use_summary is None else use_summary
        asked = queries.where(~T.blank(F.col("query"))).withColumn("query_vector", plugins.embed(F.col("query"), self.embedder))
        # A query without a vector is left out where the search reads it, so that it is embedded once.
        hits = self.store.search(asked.select("query_id", "query_vector"), limit, summary, approximate)
        return boost(hits.join(queries.select("query_id", "user_tags"), "query_id"), factor).drop("user_tags")

    def search(self, query: str, user_tags: list[str] | None = None, **options) -> DataFrame:
        row = self.store.spark.createDataFrame(
            [(0, query, list(user_tags or []))], "query_id long, query string, user_tags array<string>"
        )
        return self.search_batch(row, **options).orderBy("rank")

    def search_summary(self, query: str, user_tags: list[str] | None = None, **options) -> DataFrame:
        return self.search(query, user_tags, use_summary=True, **options)

    def get(self, point_id: str) -> DataFrame:
        return self.store.get(point_id)

    def stats(self) -> dict:
        return self.store.stats()

    def evaluate(self, truth: DataFrame, *ks: int, tag_boost: float = 0.25) -> tuple[DataFrame, DataFrame]:
        """(row for each query, one row of recall and boost rate) for truth (query, expected_doc_id)."""
        from docloom.operators.search import ranks_of_expected, recall

        ids = truth.withColumn("query_id", F.xxhash64("query", "expected_doc_id")).withColumn(
            "user_tags", T.tags_of_query(F.col("query"))
        )
        hits = self.search_batch(ids.select("query_id", "query", "user_tags"), max(ks), tag_boost)
        wanted = ids.select("query_id", T.expected_id(F.col("expected_doc_id")).alias("expected_id"))
        ranked = ranks_of_expected(hits, wanted)
        return ranked, recall(ranked, *ks)
