"""Snapshot layers: what a commit shows, replays, crashes, packing and expiry."""

import pytest
from pyspark.sql import functions as F

from sensorflow.session import work_path
from sensorflow.sinks.snapshots import Layer, Snapshots

LAYERS = {"log": Layer(), "state": Layer(("device", "id"), ("version",), ("device",), buckets=2), "notes": Layer(kind="json", codec="gzip")}


@pytest.fixture
def held(spark):
    return Snapshots(spark, work_path(spark, "held"), LAYERS)


def tables(spark, rows):
    df = spark.createDataFrame(rows, "device string, id long, version int").withColumn("at", F.current_timestamp())
    return {"log": df, "state": df, "notes": df.select("device", F.lit("x").alias("note"))}


def state(held, version=None, **parts):
    return sorted((r.device or "", r.id, r.version) for r in held.read("state", version, **parts).collect())


def test_versions_and_keys(spark, held):
    assert held.head()["version"] == 0 and held.versions() == []
    assert held.write(tables(spark, [("007", 1, 1), ("8", 1, 1), (None, 5, 1)], ), "a", 0) == 1
    assert held.write(tables(spark, [("007", 1, 3), ("007", 2, 1), ("007", 1, 2), ("9", 1, 1)]), "a", 1) == 2
    assert state(held) == [("", 5, 1), ("007", 1, 3), ("007", 2, 1), ("8", 1, 1), ("9", 1, 1)]
    assert state(held, 1) == [("", 5, 1), ("007", 1, 1), ("8", 1, 1)]
    assert state(held, device="007") == [("007", 1, 3), ("007", 2, 1)] and state(held, device=None) == [("", 5, 1)]
    assert held.read("log").count() == 7 and held.read("notes").count() == 7
    assert dict(held.read("state").dtypes)["device"] == "string"
    # an older row does not come back
    held.write({"state": tables(spark, [("007", 1, 2)])["state"]}, "a", 2)
    assert state(held, device="007") == [("007", 1, 3), ("007", 2, 1)] and held.read("log").count() == 7


def test_untouched_parts_keep_their_files(spark, held):
    held.write(tables(spark, [("a", i, 1) for i in range(20)] + [("b", i, 1) for i in range(20)]), "r", 0)
    files = lambda: {r.file for r in held.manifest().filter("layer = 'state'").collect() if '"a"' in r.part}
    before = files()
    held.write(tables(spark, [("b", 1, 2)]), "r", 1)
    assert files() == before
    assert held.manifest().filter("layer = 'state'").agg(F.sum("rows")).first()[0] == 40


def test_a_batch_is_ranked_once(spark, held, monkeypatch):
    ranked, whole = [], Layer.newest
    monkeypatch.setattr(Layer, "newest", lambda self, df: ranked.append(1) or whole(self, df))
    parsed, read = [], Snapshots._write_files
    monkeypatch.setattr(Snapshots, "_write_files", lambda *a: parsed.append(read(*a)) or parsed[-1])
    held.write(tables(spark, [("a", 1, 1), ("a", 1, 2), ("b", 1, 1)]), "r", 0)
    held.write(tables(spark, [("a", 1, 4), ("a", 1, 3), ("b", 2, 1), ("c", 1, 1)]), "r", 1)
    assert len(ranked) == 2  # by layer and batch, not again for its parts and for what is held
    assert state(held) == [("a", 1, 4), ("b", 1, 1), ("b", 2, 1), ("c", 1, 1)]
    for files in parsed:  # the rows that were written are counted, lines of text in place of JSON
        plan = files._jdf.queryExecution().optimizedPlan().toString()
        assert " json" not in plan and "Window" not in plan
    notes = held.manifest().filter("layer = 'notes'").agg(F.sum("rows")).first()[0]
    assert notes == 7 == held.read("notes").count()


def test_reading_does_not_grow_with_batches(spark, held):
    for batch in range(4):
        held.write({"state": tables(spark, [("a", 1, batch)])["state"]}, "r", batch)
    assert held.manifest().filter("layer = 'state'").count() == 1 and state(held) == [("a", 1, 3)]


def test_replays_and_other_runs(spark, held):
    rows = tables(spark, [("a", 1, 1)])
    assert [held.write(rows, "one", 0), held.write(rows, "one", 0), held.write(rows, "two", 0), held.write(rows, "one", 1)] == [1, 1, 2, 3]
    assert held.read("log").count() == 3 and state(held) == [("a", 1, 1)]


def test_a_crash_between_layers_shows_nothing(spark, held, monkeypatch):
    held.write(tables(spark, [("a", 1, 1)]), "r", 0)
    whole = Snapshots._write_files

    def dies(self, name, layer, placed):
        if name == "notes":
            raise OSError("lost")
        return whole(self, name, layer, placed)

    monkeypatch.setattr(Snapshots, "_write_files", dies)
    with pytest.raises(OSError, match="lost"):
        held.write(tables(spark, [("a", 1, 2), ("b", 1, 1)]), "r", 1)
    assert held.versions() == [1] and held.read("log").count() == 1 and state(held) == [("a", 1, 1)]
    monkeypatch.setattr(Snapshots, "_write_files", whole)
    assert held.write(tables(spark, [("a", 1, 2), ("b", 1, 1)]), "r", 1) == 2
    assert held.read("log").count() == 3 and held.read("notes").count() == 3


def test_packing_leaves_large_files(spark, held):
    wide = spark.range(200_000).select(F.lit("a").alias("device"), F.col("id"), F.rand(1).alias("x"))
    held.write({"log": wide.coalesce(1)}, "r", 0)
    for batch in range(1, 4):
        held.write({"log": wide.limit(10).coalesce(1)}, "r", batch)
    sizes = sorted(r.bytes for r in held.manifest().collect())
    done = held.compact("log", target_bytes=2 * sizes[-1])  # below half of it is small
    assert done == {"files": 3, "bytes": sum(sizes[:3])}
    assert held.manifest().count() == 2 and held.read("log").count() == 200_030 and held.read("log", 4).count() == 200_030
    assert held.compact("log", target_bytes=2 * sizes[-1]) == {"files": 0, "bytes": 0} and held.versions() == [1, 2, 3, 4, 5]


def test_expiry(spark, held):
    for batch in range(4):
        held.write(tables(spark, [("a", 1, batch)]), "r", batch)
    old = [r.file for r in held.manifest(1).filter("layer = 'state'").collect()]
    assert held.expire(2) == 2 and held.versions() == [3, 4]
    assert state(held) == [("a", 1, 3)] and held.read("log", 3).count() == 3
    with pytest.raises(Exception, match=r"(?i)not.exist|not.found"):
        spark.read.schema("device string").parquet(*old).collect()


def test_parts_of_a_keyed_layer_follow_from_its_key():
    with pytest.raises(ValueError, match="key columns"):
        Layer(("id",), ("version",), ("day",))
