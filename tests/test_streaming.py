from pyspark.sql import functions as F

from docloom.streaming import ingest as I


def test_watch_lists_new_files_in_any_case(spark, tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    (root / "a.PDF").write_bytes(b"x")
    (root / "c.txt").write_bytes(b"x")
    stream = I.watch(spark, str(root)).drop("content")
    q = stream.writeStream.format("memory").queryName("watched").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r.path.rsplit("/", 1)[-1] for r in spark.table("watched").collect()] == ["a.PDF"]


def test_copies_are_flagged_across_batches(spark, tmp_path):
    source, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    schema = "path string, text string"
    more = [[(str(10 * k), f"t{k}"), (str(10 * k + 1), f"t{k - 1}")] for k in range(1, 7)]
    for rows in ([("1", "a"), ("2", "a"), ("3", "b")], [("4", "b"), ("5", "c")], *more):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        I.flag_new_copies(spark.readStream.schema(schema).parquet(source), out, check).awaitTermination()
    got = {r.path: r.is_duplicate for r in spark.read.parquet(out).collect()}
    first = {"1": False, "2": True, "3": False, "4": True, "5": False, "10": False, "11": False}
    assert got == first | {str(10 * k + j): j == 1 for k in range(2, 7) for j in (0, 1)}
    assert I.runs_before(7) == ["0-4", "4-6", "6-7"] and I.runs_before(8) == ["0-8"]
    assert {x.name for x in (tmp_path / "out" / "_hashes").iterdir()} <= {"0-8", "0-4", "4-6", "6-7"}


def test_windows_and_sessions_of_a_stream(spark, tmp_path):
    schema = "user_id int, ts timestamp, event_type string, value double"
    rows = [(1, "2024-01-01 00:10:00", "a", 1.0), (1, "2024-01-01 00:20:00", "a", 2.0), (1, "2024-01-02 00:00:00", "a", 4.0)]
    parts = [rows, [(1, "2024-01-01 00:30:00", "a", 8.0), (2, "2024-01-03 00:00:00", "a", 0.0)]]  # the second's first row is late
    for name, f in (("windows", I.window_counts), ("spells", I.sessions)):
        source, check = str(tmp_path / name), str(tmp_path / f"{name}-check")
        for part in parts:
            df = spark.createDataFrame(part, "user_id int, ts string, event_type string, value double")
            df.withColumn("ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(source)
            q = f(spark.readStream.schema(schema).parquet(source)).writeStream.format("parquet")
            q = q.option("path", f"{source}-out").option("checkpointLocation", check).trigger(availableNow=True).start()
            q.awaitTermination()
    counts = lambda name: sorted(r.n for r in spark.read.parquet(str(tmp_path / f"{name}-out")).collect())
    assert counts("windows") == [1, 2] and counts("spells") == [1, 2]


def test_windows_and_sessions(spark):
    rows = [(1, "2024-01-01 00:10:00", "a", 1.0), (1, "2024-01-01 00:20:00", "a", 2.0), (1, "2024-01-01 02:00:00", "a", 4.0)]
    df = spark.createDataFrame(rows, "user_id int, ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    assert sorted((r.n, r.total) for r in I.window_counts(df).collect()) == [(1, 4.0), (2, 3.0)]
    assert sorted(r.n for r in I.sessions(df).collect()) == [1, 2]
