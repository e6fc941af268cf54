import pytest
from pyspark.sql import functions as F

from quarrymill.operators.upsert import duplicate_keys
from quarrymill.sources import tables
from quarrymill.streaming import ingest


def test_exports_need_their_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text\n1,"two\nlines"\n,\n')
    df = tables.read_export(spark, f"{tmp_path}/a.csv", ["id"])
    assert [(r.id, r.text) for r in df.collect()] == [("1", "two\nlines")]
    with pytest.raises(tables.MissingColumns):
        tables.read_export(spark, f"{tmp_path}/a.csv", ["stars"])


def test_newest_file_by_name(spark, tmp_path):
    for n in ("Export Reviews.csv", "~$Export Reviews.csv", "other.csv", "export reviews.txt"):
        (tmp_path / n).write_text("x")
    assert tables.newest_file(spark, str(tmp_path), ["export", "reviews"], [".csv", ".xlsx"]).first().path.rpartition("/")[2] in ("Export Reviews.csv", "Export%20Reviews.csv")
    assert tables.newest_file(spark, str(tmp_path), ["nothing"], [".csv"]).first().path is None


def test_reviews_of_sources_get_ids(spark):
    a = spark.createDataFrame([("7", 0), (None, 1)], "review_id string, position int")
    b = spark.createDataFrame([("7", "x")], "review_id string, extra string").withColumn("position", F.lit(0))
    out = tables.load_reviews({("shop", "product"): a, ("market", "service"): b})
    assert {r.uid for r in out.collect()} == {"shop:product:7", "shop:product:row1", "market:service:7"}


def test_checkpoint_keeps_the_last_good_record(spark, tmp_path):
    lines = ['{"seq":1,"uid":"a","ok":true,"s":"x"}', '{"seq":2,"uid":"a","ok":true,"s":"y"}', '{"seq":3,"uid":"b","ok":false}', '{"seq":4,"uid":"c","o']
    (tmp_path / "c.jsonl").write_text("\n".join(lines))
    out = tables.read_checkpoint(spark, f"{tmp_path}/c.jsonl", "seq int, uid string, ok boolean, s string").collect()
    assert [(r.uid, r.s) for r in out] == [("a", "y")]


def test_snapshots_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    tables.save_snapshot({"rows": df}, f"{tmp_path}/s", {"pool": "p"})
    frames, manifest = tables.load_snapshot(spark, f"{tmp_path}/s")
    assert manifest == {"pool": "p"} and frames["rows"].schema == df.schema and frames["rows"].count() == 2
    assert tables.content_version(frames["rows"]).first() == tables.content_version(df.repartition(3)).first()
    assert not tables.write_by_market(df.limit(0).withColumn("market", F.lit("x")), f"{tmp_path}/m")
    assert tables.keep_first(df.unionByName(df), ["k"], "v").count() == 2


def test_upsert_stream_merges_batches(spark, tmp_path):
    schema = "k int, v int, seq int"
    inbox = tmp_path / "in"
    spark.createDataFrame([(1, 10, 1), (2, 20, 1)], schema).coalesce(1).write.parquet(f"{inbox}/a")
    spark.createDataFrame([(2, 21, 2), (3, 30, 2)], schema).coalesce(1).write.parquet(f"{inbox}/b")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(inbox))
    ingest.upsert_stream(stream, f"{tmp_path}/t", ["k"], "seq", f"{tmp_path}/c").awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/t")
    assert {(r.k, r.v) for r in out.collect()} >= {(1, 10), (3, 30)} and duplicate_keys(out, ["k"]).count() == 0

    # a second stream updates, and leaves the files of other buckets alone
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    spark.createDataFrame([(2, 22, 3), (2, 23, 4)], schema).coalesce(1).write.parquet(f"{tmp_path}/more")
    more = spark.readStream.schema(schema).parquet(f"{tmp_path}/more")
    ingest.upsert_stream(more, f"{tmp_path}/t", ["k"], "seq", f"{tmp_path}/c2").awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/t")
    assert {(r.k, r.v) for r in out.collect()} == {(1, 10), (2, 23), (3, 30)}
    kept = [p for p in before if p.exists()]
    assert len(kept) == len(before) - 1 and all(p.stat().st_mtime_ns == before[p] for p in kept)


def test_reload_counts_what_it_wrote(spark, tmp_path):
    df = spark.range(7)
    assert tables.reload_table(df, f"{tmp_path}/r") == 7 and tables.reload_table(df.where("id > 4"), f"{tmp_path}/r") == 2
    assert [r.id for r in spark.read.parquet(f"{tmp_path}/r").orderBy("id").collect()] == [5, 6]


def test_late_weeks_are_dropped(spark, tmp_path):
    spark.sql("select timestamp'2024-03-20 10:00:00' ts, 'a' event_type, 2.0D value").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("ts timestamp, event_type string, value double").parquet(f"{tmp_path}/in")
    q = ingest.on_time_weeks(stream, "ts").writeStream.outputMode("complete").format("memory").queryName("weeks").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [(str(r.week_start), r.rows) for r in spark.table("weeks").collect()] == [("2024-03-17", 1)]
