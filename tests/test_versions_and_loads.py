"""Versions that appear whole, and loads whose parts add up."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from quarrymill.sources import tolerant
from quarrymill.sources.versions import Conflict, VersionedTable, append_batch, replace_groups


def table(spark, tmp_path):
    return VersionedTable(spark, f"{tmp_path}/t")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_versions_are_read_as_they_were(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.versions() == [] and t.read() is None
    assert t.publish(spark.range(3), 0) == 1 and t.publish(spark.range(5), 1) == 2
    assert (t.read().count(), t.read(1).count(), t.versions()) == (5, 3, [1, 2])
    assert t.publish(spark.range(0), 2) == 3 and t.read().count() == 0


def test_a_write_that_is_killed_between_files_leaves_the_old_version(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    t.publish(spark.range(3), 0)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(t, "_context", type("Killed", (), {"rename": killed})())
        with pytest.raises(KeyboardInterrupt):
            t.publish(spark.range(9), 1)
    boom = F.udf(lambda x: 1 // (x - 7), "long")
    with pytest.raises(Exception, match="ZeroDivisionError"):
        t.publish(spark.range(9).select(boom("id").alias("id")), 1)
    assert t.read().count() == 3 and t.versions() == [1]
    orphans = len(list((tmp_path / "t" / "data").iterdir())) - 1
    assert orphans == 2 and t.clean() == 0  # too young to remove
    assert t.clean(older_than_ms=0) == orphans and t.read().count() == 3
    assert t.publish(spark.range(4), 1) == 2 and t.read().count() == 4


def test_of_two_writers_one_wins(spark, tmp_path):
    t = table(spark, tmp_path)
    t.publish(spark.range(3), 0)
    outcomes, barrier = [], threading.Barrier(2)

    def write(n):
        own = VersionedTable(spark, f"{tmp_path}/t")
        barrier.wait()
        try:
            outcomes.append((own.publish(spark.range(n), 1), n))
        except Conflict:
            outcomes.append((None, n))

    threads = [threading.Thread(target=write, args=(n,)) for n in (10, 20)]
    [x.start() for x in threads]
    [x.join() for x in threads]
    won = [n for v, n in outcomes if v == 2]
    assert len(won) == 1 and t.versions() == [1, 2] and t.read().count() == won[0]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2  # the loser's rows are gone


def test_changes_go_on_from_the_newest_version(spark, tmp_path):
    t = table(spark, tmp_path)
    t.publish(spark.range(1), 0)
    seen = []

    def add(old):
        if not seen:  # someone else publishes meanwhile
            VersionedTable(spark, f"{tmp_path}/t").publish(spark.range(10, 12), 1)
        seen.append(old.count())
        return old.unionByName(spark.range(50, 51))

    assert t.change(add) == 3 and seen == [1, 2] and rows(t.read()) == [(10,), (11,), (50,)]


def test_stores_replace_groups_and_batches(spark, tmp_path):
    t = table(spark, tmp_path)
    make = lambda data: spark.createDataFrame(data, "k int, v string")
    replace_groups(t, make([(1, "a"), (1, "b"), (2, "c")]), ["k"])
    replace_groups(t, make([(1, "z"), (3, "y")]), ["k"])
    assert rows(t.read()) == [(1, "z"), (2, "c"), (3, "y")] and rows(t.read(1)) == [(1, "a"), (1, "b"), (2, "c")]
    b = VersionedTable(spark, f"{tmp_path}/b")
    append_batch(b, make([(1, "a")]), "run", "r1")
    append_batch(b, make([(2, "b")]), "run", "r2")
    append_batch(b, make([(9, "again")]), "run", "r1")
    assert rows(b.read().select("k", "v", "run")) == [(2, "b", "r2"), (9, "again", "r1")]


def test_parts_are_replaced_alone_and_old_versions_go(spark, tmp_path):
    t = table(spark, tmp_path)
    make = lambda data: spark.createDataFrame(data, "k int, part string")
    t.publish(make([(1, "a"), (2, "b")]), 0, part="part")
    t.publish(make([(3, "b"), (4, "c")]), 1, part="part")
    assert rows(t.read().select("k")) == [(1,), (3,), (4,)] and rows(t.read(1).select("k")) == [(1,), (2,)]
    t.publish(make([(5, "c")]), 2, part="part")
    assert t.clean(keep=1, older_than_ms=0) == 0 and t.versions() == [3]  # each folder still has a part in use
    t.publish(make([(6, "a"), (7, "b"), (8, "c")]), 3, part="part")
    assert t.clean(keep=1, older_than_ms=0) == 3 and rows(t.read().select("k")) == [(6,), (7,), (8,)]


def test_good_rows_quarantine_and_counts_add_up(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text('id,stars,text,error\n1,5,"two\tparts",\n2,x,bad number,\n,4,no id,\nnan,4,nan id,\n3,3,has one,timeout\n1,1,again,\n5,2\n6,,no stars,\n')
    (tmp_path / "in" / "b.csv").write_text("id,stars,text,error\n1,2,other file,\n7,4,fine,\n")
    load = tolerant.load_export(spark, f"{tmp_path}/in", "id string, stars int, text string, error string", ["id"], ["id"], error="error", grain="stars")
    found = load.judged.collect()
    counts = load.counts.get
    assert counts["rows"] == len(found) == 10 == counts["good"] + counts["quarantined"] and counts["without_grain"] >= 1
    good, bad = load.good.collect(), load.quarantine.collect()
    assert (len(good), len(bad)) == (counts["good"], counts["quarantined"])
    assert sorted(r["id"] for r in good) == ["1", "6", "7"]
    reasons = sorted(r["reason"] for r in bad)
    assert reasons == ["duplicate", "duplicate", "error", "malformed", "malformed", "missing id", "missing id"]
    assert {r["raw"] for r in bad if r["reason"] == "malformed"} == {"2,x,bad number,", "5,2"} and all(r["file"].endswith(".csv") for r in bad)


def test_json_arrays_keep_the_first_of_an_id(spark, tmp_path):
    (tmp_path / "batch.json").write_text(json.dumps([{"id": "a", "n": 1}, {"id": "b", "n": "x"}, {"n": 3}, {"id": "a", "n": 4}, {"id": "c", "n": 5, "extra": 1}]))
    load = tolerant.load_export(spark, f"{tmp_path}/batch.json", "id string, n int", ["id"], ["id"], kind="json_array")
    assert sorted((r["id"], r["n"]) for r in load.good.collect()) == [("a", 1), ("c", 5)]
    assert sorted(r["reason"] for r in load.quarantine.collect()) == ["duplicate", "malformed", "missing id"]
    (tmp_path / "torn.json").write_text('[{"id": "a", "n": 1}, {"id')
    load = tolerant.load_export(spark, f"{tmp_path}/torn.json", "id string, n int", ["id"], ["id"], kind="json_array")
    assert load.good.count() == 0 and [(r["reason"], r["raw"]) for r in load.quarantine.collect()] == [("malformed", '[{"id": "a", "n": 1}, {"id')]


def test_code_maps_are_cleaned(spark, tmp_path):
    (tmp_path / "m.csv").write_text("ASIN,Product Code,Market\n b0a , d1 ,uk\nB0A,d2,UK\n,d3,UK\nb0b,nan,DE\nb0c,None,\n")
    load = tolerant.code_map(spark, f"{tmp_path}/m.csv", {"ASIN": "asin", "Product Code": "code", "Market": "market"}, ["asin", "market"])
    assert sorted((r["asin"], r["market"], r["code"] or "") for r in load.good.collect()) == [("B0A", "UK", "d1"), ("B0B", "DE", "")]
    assert sorted(r["reason"] for r in load.quarantine.collect()) == ["duplicate", "missing asin", "missing market"]
    with pytest.raises(ValueError, match="missing Nope"):
        tolerant.code_map(spark, f"{tmp_path}/m.csv", {"Nope": "x"}, ["x"])
