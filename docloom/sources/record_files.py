"""A file for each record: a sink whose files appear when the whole job has written them."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.scratch import written

#: Files that a task moves at a time where a move is a request to a server.
MOVERS = 8


def file_system(path: str):
    """(file system, path in it) of a path or URI, by pyarrow; a path without a scheme is local to a folder all share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def files_in(fs, folder: str) -> list:
    from pyarrow.fs import FileSelector, FileType

    return [f for f in fs.get_file_info(FileSelector(folder, allow_not_found=True)) if f.type == FileType.File]


def counted(folder: str, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([folder]), pa.array([n], pa.int64())], names=["folder", "files"])


def staged(path: str, suffix: str):
    """Tasks of rows (name, value) that write value and a line feed to <name><suffix> in a folder for each attempt."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        fs, root = file_system(path)
        folder, n = f"{root}/{context.partitionId()}-{context.taskAttemptId()}", 0
        try:
            for batch in batches:
                if batch.num_rows and not n:
                    fs.create_dir(folder, recursive=True)
                for name, value in zip(batch.column(0), batch.column(1)):
                    with fs.open_output_stream(f"{folder}/{quote(name.as_py() or '', safe='')}{suffix}") as out:
                        out.write(f"{value.as_py()}\n".encode())
                n += batch.num_rows
        except BaseException:
            if n:
                fs.delete_dir(folder)
            raise
        if n:
            yield counted(folder, n)

    return task


def moved(path: str):
    """Tasks of rows (folder) that move the files of each folder to path. What an earlier attempt has moved is there already."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(path)

        def move(file: str) -> None:
            target = f"{root.rstrip('/')}/{file.rsplit('/', 1)[1]}"
            try:
                fs.move(file, target)
            except OSError:
                if fs.get_file_info(file).type.name == "NotFound":  # another attempt has moved it
                    return
                fs.delete_file(target)  # file systems that don't rename over a file
                fs.move(file, target)

        with ThreadPoolExecutor(MOVERS) as pool:
            every = map if fs.type_name == "local" else pool.map
            for batch in batches:
                for folder in batch.column(0).to_pylist():
                    found = [f.path for f in files_in(fs, folder)]
                    for a in range(0, len(found), 1024):
                        list(every(move, found[a : a + 1024]))
                    yield counted(folder, len(found))

    return task


def names_of(path: str, suffix: str):
    """Tasks of rows (folder), folders of path's file system, that give the names of their files of a suffix."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(path)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                names = [f.base_name for f in files_in(fs, folder) if f.base_name.endswith(suffix)]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["name"])

    return task


def deleted(path: str):
    """Tasks of rows (name) that delete these files of path."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(path)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                if fs.get_file_info(f"{root.rstrip('/')}/{name}").type.name != "NotFound":
                    fs.delete_file(f"{root.rstrip('/')}/{name}")
            yield counted(path, batch.num_rows)

    return task


def write_files(rows: DataFrame, path: str, suffix: str = ".jsonl", overwrite: bool = False) -> None:
    """Each row (name, value): value and a line feed in the file <name><suffix> of the folder path.

    Tasks write below _temporary, in a folder for each attempt; when all are done, tasks of a second job move the files of
    the attempts that count. The driver sees a folder for each task, never a file. If the first job fails, _temporary's
    part of it is deleted and the folder is as it was. A record replaces the file of its name; with overwrite all other
    files of the suffix go once the new ones are complete.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    above, job = f"{path}/_temporary", f"{path}/_temporary/{uuid.uuid4().hex}"
    said = "folder string, files long"
    listed = lambda folders: spark.createDataFrame([(f,) for f in folders], "folder string")
    try:
        made = [r.folder for r in rows.select("name", "value").mapInArrow(staged(job, suffix), said).collect()]  # a row a task
        old = None
        if overwrite:
            names = lambda folders: listed(folders).mapInArrow(names_of(path, suffix), "name string")
            there = names([file_system(path)[1].rstrip("/")])
            old = written(there.join(names(made), "name", "left_anti") if made else there, "old")
        if made:
            listed(made).mapInArrow(moved(path), said).collect()
        if old is not None:
            old.mapInArrow(deleted(path), said).agg(F.sum("files")).collect()
    finally:
        from pyarrow.fs import FileSelector

        for folder, whole in ((job, True), (above, False)):
            fs, at = file_system(folder)
            if fs.get_file_info(at).type.name == "Directory" and (whole or not fs.get_file_info(FileSelector(at))):
                fs.delete_dir(at)


def last_of_each(docs: DataFrame, key: str, seq_col: str) -> DataFrame:
    """Of rows with equal key the one with the greatest seq_col, and of those that tie one by its content.

    Each task first keeps one row a key, so many copies of one content don't meet.
    """
    content = F.xxhash64(F.to_json(F.struct(*docs.columns)))
    last = Window.partitionBy(key).orderBy(F.desc_nulls_last(seq_col), content)
    return docs.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def write_record_files(docs: DataFrame, path: str, seq_col: str | None = None, name_col: str = "hash_sha1", overwrite: bool = False) -> None:
    """Each record as JSON in its own file <name_col>.jsonl, without that column; of equal names the last by seq_col.

    Null fields are left out. A record without a name is the file ".jsonl". Files that were there stay or are replaced,
    unless overwrite. See write_files().
    """
    last = last_of_each(docs.withColumn(name_col, F.coalesce(name_col, F.lit(""))), name_col, seq_col) if seq_col else docs
    fields = [c for c in docs.columns if c not in (name_col, seq_col)]
    rows = last.select(F.col(name_col).alias("name"), F.to_json(F.struct(*fields)).alias("value"))
    write_files(rows, path, overwrite=overwrite)
