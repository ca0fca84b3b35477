from pyspark.sql import functions as F

from feedloom.streaming import updates


def test_patches_from_a_stream(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    schema = "id string, provider string, status string, at timestamp"

    def feed(rows):
        df = spark.createDataFrame(rows, "id string, provider string, status string, at string").withColumn("at", F.col("at").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        updates.apply_patches(stream, out, "id", "at", f"{tmp_path}/cp").awaitTermination()

    assert updates.current(spark, out) is None
    feed([("1", "A", "active", "2024-01-01"), ("2", "B", None, "2024-01-01"), ("1", "A2", "active", "2024-01-02")])
    feed([("1", None, "inactive", "2024-01-03"), ("3", "C", None, "2024-01-03")])
    assert sorted(tuple(r) for r in updates.current(spark, out).select("id", "provider", "status").collect()) == [("1", "A2", "inactive"), ("2", "B", None), ("3", "C", None)]


def test_batches_do_not_change_the_result(spark, tmp_path):
    schema = "id string, data_type string, provider string, place struct<country:string,city:string>, features array<string>, at timestamp"
    rows = [
        ("1", "gtfs", "A", ("XA", None), ["f"], "2024-01-01"), ("1", "other", None, (None, "Town"), None, "2024-01-02"), ("1", None, "B", None, [], "2024-01-03"), ("2", "gtfs", None, None, None, "2024-01-01"),
        ("2", None, "late", None, None, "2024-01-05"), ("2", None, "earlier", ("XB", "C"), None, "2024-01-04"), ("3", "gtfs", "tie a", None, None, "2024-01-01"), ("3", None, "tie b", None, None, "2024-01-01"), (None, "gtfs", "no key", None, None, "2024-01-01"),
    ]
    whole = None
    for n, (order, size) in enumerate((([*range(9)], 9), ([*range(8, -1, -1)], 9), ([4, 0, 7, 2, 5, 8, 1, 3, 6], 3))):
        src, out = f"{tmp_path}/in{n}", f"{tmp_path}/out{n}"
        for k in range(0, 9, size):
            part = spark.createDataFrame([rows[i] for i in order[k : k + size]], schema.replace("timestamp", "string")).withColumn("at", F.col("at").cast("timestamp"))
            part.coalesce(1).write.mode("append").parquet(src)
            updates.apply_patches(spark.readStream.schema(schema).parquet(src), out, "id", "at", f"{out}-cp", buckets=4).awaitTermination()
        got = sorted(map(str, updates.current(spark, out).select("id", "data_type", "provider", "place", "features").collect()))
        whole = got if whole is None else whole
        assert got == whole
    assert any("provider='B', place=Row(country='XA', city='Town'), features=[]" in r for r in whole) and any("'late'" in r and "'XB'" in r for r in whole) and len(whole) == 3


def test_old_versions_are_removed_and_others_stay(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for k in range(4):
        spark.createDataFrame([(str(k % 2), f"v{k}", k)], "id string, v string, at long").coalesce(1).write.mode("append").parquet(src)
        updates.apply_patches(spark.readStream.schema("id string, v string, at long").parquet(src), out, "id", "at", f"{out}-cp", buckets=8).awaitTermination()
    assert sorted(tuple(r) for r in updates.current(spark, out).collect()) == [("0", "v2"), ("1", "v3")]
    assert sorted(p.name for p in (tmp_path / "out/data").iterdir()) == ["version=1", "version=2", "version=3"]
    assert len(list((tmp_path / "out/done").iterdir())) == 2
    # a batch without keys that the table has
    spark.createDataFrame([("9", "new", 9)], "id string, v string, at long").coalesce(1).write.mode("append").parquet(src)
    updates.apply_patches(spark.readStream.schema("id string, v string, at long").parquet(src), out, "id", "at", f"{out}-cp", new_rows=False, buckets=8).awaitTermination()
    assert updates.current(spark, out).count() == 2


def test_windows_and_repeats(spark, tmp_path):
    rows = [("a", "2024-01-01 00:01:00"), ("a", "2024-01-01 00:01:00"), ("b", "2024-01-01 00:40:00"), ("c", "2024-01-01 02:00:00")]
    spark.createDataFrame(rows, "id string, at string").withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id string, at timestamp").parquet(f"{tmp_path}/in")
    q = updates.fresh_rows(stream, ["id"], "at", "10 minutes").writeStream.format("memory").queryName("fresh").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("fresh").count() == 3
    q = updates.counts_by_window(stream, "at", "10 minutes", "1 hour", ["id"]).writeStream.format("memory").outputMode("complete").queryName("windows").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r["id"], r["n"]) for r in spark.table("windows").collect()} == {("a", 2), ("b", 1), ("c", 1)}
