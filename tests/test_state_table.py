import random

import pytest
from pyspark.sql import functions as F

from postloom.operators.stats import SKETCH_ERROR, estimated_ids, id_sketches, merged_sketches
from postloom.sources.state_table import StaleVersion, StateTable

DDL = "task_name STRING, n INT"


def rows(spark, values):
    return spark.createDataFrame(list(values.items()), DDL)


def held(frame):
    return {r.task_name: r.n for r in frame.collect()}


def test_merges_equal_a_dictionary(spark, tmp_path):
    table, rng, want, version = StateTable(spark, str(tmp_path / "s"), DDL, parts=4), random.Random(1), {}, 0
    for _ in range(4):
        changes = {f"t{rng.randrange(30)}": rng.randrange(100) for _ in range(8)}
        version = table.merge(rows(spark, changes), version)
        want |= changes
    assert held(table.read()[0]) == want and table.read()[1] == version == 4
    assert table.merge(rows(spark, {}), version) == 5 and held(table.read()[0]) == want


def test_an_older_version_stays_readable(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "s"), DDL)
    table.merge(rows(spark, {"a": 1, "b": 2}), 0)
    before, version = table.read()
    table.merge(rows(spark, {"a": 9}), version)
    assert held(before) == {"a": 1, "b": 2} == held(table.read(1)[0]) and held(table.read()[0]) == {"a": 9, "b": 2}


def test_a_stale_writer_fails(spark, tmp_path, monkeypatch):
    table = StateTable(spark, str(tmp_path / "s"), DDL)
    table.merge(rows(spark, {"a": 1}), 0)
    version = table.version()
    table.merge(rows(spark, {"a": 2}), version)
    with pytest.raises(StaleVersion):
        table.merge(rows(spark, {"a": 3}), version)
    # Also when the other run writes after the check.
    with monkeypatch.context() as m:
        m.setattr(StateTable, "version", lambda self: version)
        with pytest.raises(StaleVersion):
            table.merge(rows(spark, {"a": 3}), version)
    assert held(table.read()[0]) == {"a": 2} and table.version() == 2


def test_only_touched_parts_are_written(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "s"), DDL, parts=8)
    table.merge(rows(spark, {f"t{i}": i for i in range(100)}), 0)
    first = table._folders(1)
    table.merge(rows(spark, {"t5": 50}), 1)
    second = table._folders(2)
    assert len(first) == 8 and sum(first[p] != second[p] for p in first) == 1
    assert held(table.read()[0])["t5"] == 50 and table.read()[0].count() == 100


@pytest.mark.parametrize("keys", [["a", "a"], [None]])
def test_keys_must_be_single(spark, tmp_path, keys):
    table = StateTable(spark, str(tmp_path / "s"), DDL)
    with pytest.raises(ValueError, match="comes twice"):
        table.merge(spark.createDataFrame([(k, 1) for k in keys], DDL), 0)
    assert table.version() == 0


def test_sketches_of_batches_merge(spark):
    ids = spark.range(30_000).select((F.col("id") % 20_000).cast("string").alias("id"), (F.col("id") % 7).alias("batch"))
    sketches = id_sketches(ids, ["batch"])
    told = {r.batch: r.ids for r in estimated_ids(sketches).collect()}
    exact = {r.batch: r.n for r in ids.groupBy("batch").agg(F.count_distinct("id").alias("n")).collect()}
    assert all(abs(told[b] - n) <= 3 * SKETCH_ERROR * n for b, n in exact.items())
    whole = estimated_ids(merged_sketches(sketches, [])).head().ids
    assert abs(whole - 20_000) <= 3 * SKETCH_ERROR * 20_000
    assert estimated_ids(id_sketches(ids.limit(0), ["batch"])).count() == 0
