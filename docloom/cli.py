"""Command line: python -m docloom.cli COMMAND."""

from __future__ import annotations

import argparse
import json
import logging

from docloom.session import get_session

VERSION = "0.1.0"


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="docloom", description="Prepare, describe and search document collections.")
    p.add_argument("-v", "--verbose", action="store_true")
    p.add_argument("-c", "--config", help="JSON file of settings")
    p.add_argument("--master", help="Spark master; default: what the session is given")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("preprocess", help="files to records")
    c.add_argument("-i", "--input", required=True)
    c.add_argument("-o", "--output", required=True)
    c = sub.add_parser("taxonomy-extract", help="metadata records of raw files")
    c.add_argument("root")
    c.add_argument("--out", default="metadata_raw.jsonl")
    c = sub.add_parser("taxonomy-analyze", help="taxonomy of records")
    c.add_argument("--preprocessed", required=True)
    c.add_argument("--out")
    c = sub.add_parser("vector-load", help="records into a vector store")
    c.add_argument("folder")
    c.add_argument("--glob")
    c.add_argument("--store", default="vectors")
    c.add_argument("--collection", default="documents")
    c = sub.add_parser("search", help="hybrid search")
    c.add_argument("query")
    c.add_argument("--tag", action="append", default=[])
    c.add_argument("--limit", type=int)
    c.add_argument("--store", default="vectors")
    c.add_argument("--collection", default="documents")
    c = sub.add_parser("inventory", help="list files as CSV")
    c.add_argument("root")
    c.add_argument("-o", "--output", default="inventory.csv")
    c = sub.add_parser("full-pipeline", help="preprocess, taxonomy-analyze, vector-load")
    c.add_argument("-i", "--input", required=True)
    c.add_argument("--preprocessed", required=True)
    c.add_argument("--taxonomy-out")
    c.add_argument("--store", default="vectors")
    c.add_argument("--collection", default="documents")
    c.add_argument("--skip-vectors", action="store_true")
    sub.add_parser("version")
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if a.verbose else logging.INFO)
    if a.command == "version":
        print(f"docloom {VERSION}")
        return 0
    from docloom.operators.store import VectorStore
    from docloom.plans import corpus as C
    from docloom.settings import Settings
    from docloom.sources import files as S

    settings = Settings.from_env()
    if a.config:
        with open(a.config, encoding="utf-8") as f:
            settings = Settings.from_env(**json.load(f))
    logging.getLogger().setLevel(logging.DEBUG if a.verbose else settings.log_level)
    spark = get_session(master=a.master)
    if a.command in ("preprocess", "full-pipeline"):
        out = a.output if a.command == "preprocess" else a.preprocessed
        done = C.run_pipeline(spark, a.input, out)
        for row in done.dead.toLocalIterator():
            logging.warning("%s: %s", row.path, row.error)
    if a.command == "taxonomy-extract":
        C.extract_metadata(spark, a.root, a.out)
    if a.command in ("taxonomy-analyze", "full-pipeline"):
        taxonomy = C.analyze(spark, a.preprocessed, a.out if a.command == "taxonomy-analyze" else a.taxonomy_out)
        print(json.dumps(taxonomy["statistics"], ensure_ascii=False))
        for part, top in (("categories", 10), ("tags", 15), ("countries", 10)):
            print(part, json.dumps(dict(list(taxonomy[part]["overview"].items())[:top]), ensure_ascii=False))
    if a.command == "vector-load" or a.command == "full-pipeline" and not a.skip_vectors:
        folder, glob = (a.folder, a.glob) if a.command == "vector-load" else (a.preprocessed, None)
        stats = C.load_folder(spark, folder, VectorStore(spark, a.store, a.collection, settings.max_retries, settings.retry_delay), pattern=glob or S.RECORDS, settings=settings)
        print(f"{stats.uploaded} of {stats.total} uploaded ({stats.success_rate:.1f} %)")
    if a.command == "search":
        engine = C.RetrievalEngine(VectorStore(spark, a.store, a.collection), settings=settings)
        engine.search(a.query, a.tag, limit=a.limit).show(truncate=80)
    if a.command == "inventory":
        S.write_csv(S.inventory(spark, a.root), a.output)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
