"""A vector store as Parquet: versions of a table with two named vectors, keyed upsert, lookup, statistics."""

from __future__ import annotations

import json
import logging
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.operators.index import VectorIndex
from docloom.operators.search import by_id, top_k
from docloom.schemas import POINT

#: Folders that the points of a collection are dealt to by id, unless it was created with more.
BUCKETS = 64
#: Points of a file at most, about.
FILE = 1 << 20


def merge_points(existing: DataFrame, new: DataFrame, key: str = "id", seq_col: str | None = None) -> DataFrame:
    """Rows of new replace those of existing with equal key; of equal keys in new the last by seq_col stays."""
    if seq_col:
        last = Window.partitionBy(key).orderBy(F.desc(seq_col))
        new = new.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n", seq_col)
    return existing.join(new.select(key), key, "left_anti").select(*existing.columns).unionByName(
        new.select(*existing.columns)
    )


class ConflictError(RuntimeError):
    """Another writer's version came first, more often than there were retries."""


class VectorStore:
    """Collections under a root folder on any file system that Spark reaches.

    Points are dealt to folders by a hash of their id. A version is a small file that names the folder of each
    bucket; an upsert writes new folders for the buckets that it touches only, and then the next version, which a file
    system creates once: of two writers the second merges anew. What fails is tried again as often as told, each time after twice
    the delay. Readers see whole versions. A lookup opens the folder of its id only. Folders that neither of the last two versions names are deleted.
    """

    def __init__(self, spark: SparkSession, root: str, collection: str = "documents", max_retries: int = 3, retry_delay: float = 1.0):
        self.spark, self.path = spark, f"{root.rstrip('/')}/{collection}"
        self.max_retries, self.retry_delay = max_retries, retry_delay
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        at = self._path(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _write(self, name: str, what: dict, overwrite: bool = True) -> bool:
        """Whether the file was created."""
        try:
            out = self._fs.create(self._path(f"{self.path}/{name}"), overwrite)
        except Exception:
            if not overwrite and self._fs.exists(self._path(f"{self.path}/{name}")):
                return False
            raise
        out.write(bytearray(json.dumps(what).encode()))
        out.close()
        return True

    def _read(self, name: str) -> dict:
        stream = self._fs.open(self._path(f"{self.path}/{name}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._names("versions") if n.endswith(".json")]

    def folders(self, version: int | None = None) -> dict[int, str]:
        """The folder of each bucket that holds points."""
        found = self.versions()
        if not found:
            raise FileNotFoundError(f"no collection at {self.path}")
        named = self._read(f"versions/{found[-1] if version is None else version:08d}.json")
        return {int(k): v for k, v in named.items()}

    def exists(self) -> bool:
        return bool(self._fs.exists(self._path(self.path)))

    def create(self, dim: int, metric: str = "cosine", buckets: int = BUCKETS) -> bool:
        """False if it was there already."""
        if self.exists():
            return False
        self._write("collection.json", {"dim": dim, "metric": metric, "vectors": ["body", "summary_vec"], "buckets": buckets})
        return self._write(f"versions/{0:08d}.json", {}, overwrite=False)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(self._read("collection.json").get("buckets", BUCKETS))).cast("int")

    def drop(self) -> bool:
        """False if there was none."""
        return bool(self.exists() and self._fs.delete(self._path(self.path), True))

    def _points(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], POINT)
        return self.spark.read.schema(POINT).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self) -> DataFrame:
        return self._points(list(self.folders().values()))

    def upsert(self, points: DataFrame, seq_col: str | None = None) -> int:
        """Merge points by id; of equal ids the last by seq_col stays. Returns how many rows points had.

        points is evaluated once, into a folder of its own, so a costly column isn't computed for every use of it, nor
        again when a merge is tried anew. The last failure is raised once there were max_retries more.
        """
        staged = f"{self.path}/staged/{uuid.uuid4().hex}"
        try:
            points.withColumn("_bucket", self._bucket()).write.parquet(staged)
            new = self.spark.read.parquet(staged)
            counts = {r[0]: r[1] for r in new.groupBy("_bucket").count().collect()}  # a row a bucket
            failed: Exception = ConflictError(self.path)
            for attempt in range(self.max_retries + 1):
                if attempt:
                    time.sleep(self.retry_delay * 2 ** (attempt - 1))
                try:
                    if not counts or self._merge(new, counts, seq_col):
                        return sum(counts.values())
                    failed = ConflictError(self.path)
                except Exception as e:
                    logging.getLogger(__name__).warning("upsert to %s, attempt %d: %s", self.path, attempt + 1, e)
                    failed = e
            raise failed
        finally:
            self._fs.delete(self._path(staged), True)

    def _merge(self, new: DataFrame, counts: dict[int, int], seq_col: str | None) -> bool:
        found, touched = self.versions()[-1], sorted(counts)
        held = self.folders(found)
        old = self._points([held[b] for b in touched if b in held])
        merged = merge_points(old, new.drop("_bucket"), seq_col=seq_col)
        # Files of one bucket are as many as its points ask for.
        files = -(-(sum(counts.values()) + old.count()) // (len(touched) * FILE))
        folder = f"points/{uuid.uuid4().hex}"
        dealt = merged.withColumn("bucket", self._bucket()).repartition(len(touched) * files, "bucket", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(files)))
        try:
            dealt.write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
            held |= {b: f"{folder}/bucket={b}" for b in touched}
            done = self._write(f"versions/{found + 1:08d}.json", held, overwrite=False)
        except Exception:
            self._fs.delete(self._path(f"{self.path}/{folder}"), True)
            raise
        if not done:
            self._fs.delete(self._path(f"{self.path}/{folder}"), True)
            return False
        keep = {x.split("/")[1] for v in self.versions()[-2:] for x in self.folders(v).values()}
        for v in self.versions()[:-2]:
            for x in {x.split("/")[1] for x in self.folders(v).values()} - keep:
                self._fs.delete(self._path(f"{self.path}/points/{x}"), True)
            self._fs.delete(self._path(f"{self.path}/versions/{v:08d}.json"), False)
        return True

    def get(self, point_id: str) -> DataFrame:
        """The point of an id, from the one folder that can hold it."""
        bucket = self.spark.range(1).select(F.lit(point_id).alias("id")).select(self._bucket()).first()[0]
        folder = self.folders().get(bucket)
        return by_id(self._points([folder] if folder else []), point_id)

    def sample(self, n: int = 5) -> DataFrame:
        return self.read().limit(n)

    def stats(self) -> dict:
        if not self.exists():
            return {}
        name = self.path.rsplit("/", 1)[-1]
        return {"name": name, "points_count": self.read().count(), "status": "ready"} | self._read("collection.json")

    def build_index(self, use_summary: bool = False, **options) -> VectorIndex:
        """Index one of the two vectors of the points as they are now, for approximate searches; see VectorIndex.build()."""
        vector = "summary_vec" if use_summary else "body"
        folder, version = f"indexes/{uuid.uuid4().hex}", self.versions()[-1]
        index = VectorIndex.build(self._points(list(self.folders(version).values())), f"{self.path}/{folder}", vector=vector, **options)
        before = self._indexes()
        self._write("indexes.json", before | {vector: {"folder": folder, "version": version}})
        if vector in before:
            self._fs.delete(self._path(f"{self.path}/{before[vector]['folder']}"), True)
        return index

    def _indexes(self) -> dict:
        return self._read("indexes.json") if self._fs.exists(self._path(f"{self.path}/indexes.json")) else {}

    def index(self, use_summary: bool = False) -> VectorIndex:
        """The index of a vector; an error if there is none of the current version of the points."""
        found = self._indexes().get("summary_vec" if use_summary else "body")
        if not found or found["version"] != self.versions()[-1]:
            raise LookupError(f"{self.path} has no index of its current points: build_index() makes one")
        return VectorIndex(self.spark, f"{self.path}/{found['folder']}")

    def search(self, queries: DataFrame, k: int = 10, use_summary: bool = False, approximate: bool = False, probes: int | None = None) -> DataFrame:
        """queries: query_id, query_vector. Hits with their payload; approximate reads the cells of an index only."""
        points = self.read()
        if approximate:
            hits = self.index(use_summary).search(queries, k, probes=probes)
        else:
            hits = top_k(queries, points, k, vector="summary_vec" if use_summary else "body")
        return hits.join(points.select("id", "payload"), "id").select("query_id", "id", "score", "rank", "payload.*")
