import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from postloom.operators import order
from postloom.sources import rotation
from postloom.sources.envelope import read_log, write_log


def log_of(spark, sizes, times=None):
    """Records of the given payload sizes in one block each of three; times in seconds."""
    times = times or [0] * len(sizes)
    rows = [("a", i // 3, i, "tweet", json.dumps({"id": str(i), "x": "y" * n}, separators=(",", ":")), t) for i, (n, t) in enumerate(zip(sizes, times))]
    df = spark.createDataFrame(rows, "log STRING, block BIGINT, seq BIGINT, kind STRING, data STRING, t BIGINT")
    return df.withColumn("at", F.timestamp_seconds("t").cast("timestamp_ntz")).repartition(5)


def read(folder):
    out = []
    for path in sorted(folder.glob("t.rot-*")):
        text = gzip.open(path, "rt").read() if path.suffix == ".gz" else path.read_text()
        out.append([(int(json.loads(line)["data"]["id"]), len(line) + 1) for line in text.splitlines()])
    return out


@pytest.mark.parametrize("limit", [1, 90, 700, 10**9])
def test_files_by_size(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(order, "RANGE_ROWS", 7)  # many splits
    rng = random.Random(limit)
    records = log_of(spark, [rng.choice([0, 5, 60, 400]) for _ in range(60)])
    n = write_log(records, str(tmp_path), "t", "1", rotate_bytes=limit)
    files = read(tmp_path)
    assert n == len(files) and all(files)
    assert [i for f in files for i, _ in f] == list(range(60))
    assert all(sum(b for _, b in f[:-1]) < limit for f in files)
    assert n <= -(-sum(b for f in files for _, b in f) // limit)
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith("_")] == []


def test_files_by_age(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(order, "RANGE_ROWS", 3)
    times = [0, 10, 59, 60, 61, 30, 119, 500, 490, 501, 540]  # 30 and 490 come late
    write_log(log_of(spark, [0] * 11, times), str(tmp_path), "t", "1", rotate_seconds=60, at="at", compress=True)
    assert [[i for i, _ in f] for f in read(tmp_path)] == [[0, 1, 2], [3, 4, 5, 6], [7, 8, 9], [10]]


def test_files_by_both(spark, tmp_path):
    one = len('{"kind":"tweet","data":{"id":"0","x":""}}') + 1
    write_log(log_of(spark, [0] * 8, [0, 1, 2, 60, 61, 62, 63, 64]), str(tmp_path), "t", "1", rotate_bytes=2 * one, rotate_seconds=60, at="at")
    assert [[i for i, _ in f] for f in read(tmp_path)] == [[0, 1], [2], [3, 4], [5, 6], [7]]
    scan = read_log(spark, str(tmp_path), "t")
    assert [json.loads(r.data)["id"] for r in scan.records.orderBy("log", "block", "seq").collect()] == list("01234567")


def test_an_empty_log_writes_no_file(spark, tmp_path):
    assert write_log(log_of(spark, [0]).limit(0), str(tmp_path), "t", "1", rotate_bytes=5) == 0
    assert write_log(log_of(spark, [0]).limit(0), str(tmp_path), "t", "2") == 0


def test_starts_of_slots_are_found_once(spark, tmp_path, monkeypatch):
    plans, real = [], rotation.lookup_join

    def join(rows, lookup, *rest):
        plans.append(lookup._jdf.queryExecution().optimizedPlan().toString())
        return real(rows, lookup, *rest)

    monkeypatch.setattr(rotation, "lookup_join", join)
    write_log(log_of(spark, [0] * 8, list(range(8))), str(tmp_path), "t", "1", rotate_bytes=90, rotate_seconds=3, at="at")
    assert len(plans) == 1 and "Aggregate" not in plans[0]  # a written table


def test_a_scan_has_no_empty_parts(spark, tmp_path):
    write_log(log_of(spark, [0] * 8), str(tmp_path), "t", "1", rotate_bytes=90)
    plan = read_log(spark, str(tmp_path), "t").records._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "LogicalRDD" not in plan
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) <= 32
