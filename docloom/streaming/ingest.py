"""Streams: files as they arrive, copies flagged against all that came before, windows over events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom.sources.files import SUFFIXES, local_path, pattern_of

BINARY = "path string, modificationTime timestamp, length long, content binary"


def watch(spark: SparkSession, root: str, suffixes: tuple[str, ...] = SUFFIXES, max_files: int = 1000) -> DataFrame:
    """New files below root, suffixes in any case. A file is read once for each path."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern_of(suffixes, any_case=True))
        .option("maxFilesPerTrigger", max_files)
        .load(root)
    )
    return files.select(
        local_path(F.col("path")).alias("path"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_ts"),
        "content",
    )


def runs_before(batches: int) -> list[str]:
    """Names (first-end) of the runs that hold so many batches: a run for each bit of their number, long ones first."""
    out, at = [], 0
    for bit in reversed(range(batches.bit_length())):
        if batches >> bit & 1:
            out.append(f"{at}-{at + (1 << bit)}")
            at += 1 << bit
    return out


def flag_new_copies(rows: DataFrame, out: str, checkpoint: str, seq_col: str = "path", text_col: str = "text") -> StreamingQuery:
    """Write rows with hash_content and is_duplicate, each batch judged against all batches before it.

    Hashes that a batch saw first stand beside the written table, in folders for runs of batches: as many batches as
    there are in a run are merged into the next longer one, so a batch reads a number of folders that grows with the
    logarithm of the batches and each distinct hash is rewritten as often. A batch that is run again after a failure
    replaces its own folders and sees the same earlier ones: results are written once.
    """

    def write(batch: DataFrame, number: int) -> None:
        from docloom.operators.documents import flag_duplicates

        spark = batch.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path
        fs = path(out).getFileSystem(spark._jsc.hadoopConfiguration())
        runs = lambda upto: [r for r in runs_before(upto) if fs.exists(path(f"{out}/_hashes/{r}"))]
        read = lambda names: spark.read.schema("hash_content string").parquet(*[f"{out}/_hashes/{r}" for r in names])
        flagged = flag_duplicates(batch, seq_col, text_col)
        earlier = runs(number)
        if earlier:
            seen = read(earlier).withColumn("_seen", F.lit(True))
            flagged = flagged.join(seen, "hash_content", "left").withColumn(
                "is_duplicate", F.col("is_duplicate") | F.coalesce("_seen", F.lit(False))
            ).drop("_seen")
        flagged.write.mode("overwrite").parquet(f"{out}/batch={number}")
        new = spark.read.parquet(f"{out}/batch={number}").where("not is_duplicate").select("hash_content")
        merged = [r for r in earlier if r not in runs_before(number + 1)]
        if merged:
            new = new.unionByName(read(merged))
        new.write.mode("overwrite").parquet(f"{out}/_hashes/{runs_before(number + 1)[-1]}")
        # What the batch before this one merged: this one's own runs stay, in case it is run again.
        for old in set(runs_before(max(number - 1, 0))) - set(runs_before(number)):
            fs.delete(path(f"{out}/_hashes/{old}"), True)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def window_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours", ts: str = "ts") -> DataFrame:
    """(window_start, event_type, n, total) in tumbling windows; rows later than the watermark are left out."""
    if events.isStreaming:
        events = events.withWatermark(ts, late)
    return (
        events.groupBy(F.window(ts, width).alias("w"), "event_type")
        .agg(F.count("*").alias("n"), F.sum("value").alias("total"))
        .select(F.col("w.start").alias("window_start"), "event_type", "n", "total")
    )


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours", ts: str = "ts", key: str = "user_id") -> DataFrame:
    """(key, session_start, session_end, n): runs of events of a key with no longer gap; of a stream, once they are closed."""
    if events.isStreaming:
        events = events.withWatermark(ts, late)
    return (
        events.groupBy(F.session_window(ts, gap).alias("w"), key)
        .agg(F.count("*").alias("n"))
        .select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
    )
