"""Reading the first rows of a file list, and how much of it that reads."""

import bz2
import json
import os
import random
import sys

import pytest

from skein.sources import files
sys.path.insert(0, os.path.dirname(__file__))
from plan_check import rows_scanned, watch  # noqa: E402


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000000")
    spark.conf.unset("spark.sql.files.minPartitionNum")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def dump(tmp_path_factory):
    """A bz2 file of five splits and more, and its lines."""
    rng = random.Random(1)
    lines = [f"{i} {rng.randrange(10**6)}" for i in range(1_200_000)]
    path = tmp_path_factory.mktemp("dump") / "big.bz2"
    path.write_bytes(bz2.compress("\n".join(lines).encode()))
    return str(path), lines


def test_five_splits_and_a_hundred_rows(spark, small_splits, dump):
    path, lines = dump
    assert spark.read.text(path).rdd.getNumPartitions() >= 5
    split = len(lines) // spark.read.text(path).rdd.getNumPartitions()
    got, read = rows_scanned(spark, lambda: files.read_lines(spark, path, first=100).orderBy("pos").collect())
    assert [r.value for r in got] == lines[:100]
    assert read < split


@pytest.mark.parametrize("first", [250_000, 1_199_999, 5_000_000])
def test_cut_inside_and_behind_the_splits(spark, small_splits, dump, first):
    path, lines = dump
    df = files.read_lines(spark, path, first=first)
    n, least, most = df.selectExpr("count(*)", "min_by(value, pos)", "max_by(value, pos)").first()
    assert n == min(first, len(lines)) and (least, most) == (lines[0], lines[n - 1])


def test_numbers_in_scan_order(spark, small_splits, dump):
    path, lines = dump
    df = files.read_lines(spark, path, path, dense_pos=True)
    got, plans = watch(spark, lambda: df.selectExpr(
        "count(*) n", f"count_if(pos % {len(lines)} = cast(split(value, ' ')[0] AS bigint)) ok", "max(pos) top",
        "count(distinct pos) d").first())
    assert (got.n, got.ok, got.top, got.d) == (2 * len(lines), 2 * len(lines), 2 * len(lines) - 1, 2 * len(lines))
    assert not any("rangepartitioning" in p or "LogicalRDD" in p for p in plans)


def test_many_small_files(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"f{i:02}").write_text("".join(f"{i} {k}\n" for k in range(i % 4)))
    want = [f"{i} {k}" for i in range(12) for k in range(i % 4)]
    for first in (0, 1, 3, 4, 9, 17, 18, 19, 100):
        got = files.read_lines(spark, str(tmp_path), first=first).orderBy("pos").collect()
        assert [r.value for r in got] == want[:first]
    got = files.read_lines(spark, str(tmp_path), first=9, dense_pos=True).collect()
    assert sorted((r.pos, r.value) for r in got) == list(enumerate(want[:9]))


def test_records_with_blank_and_malformed_lines(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text("".join(json.dumps({"id": f"c{i}", "edited": [False, 1.5][i % 2]}) + "\n \t\n" for i in range(20)))
    for schema in (None, "id string, edited variant"):
        df = files.read_records(spark, str(path), schema=schema, first=7, dense_pos=True)
        assert [r.pos for r in df.orderBy("pos").collect()] == list(range(7))
        assert df.columns == (["value", "pos"] if schema is None else ["id", "edited", "pos"])
        every = files.read_records(spark, str(path), schema=schema, dense_pos=True)
        assert sorted(r.pos for r in every.select("pos").collect()) == list(range(20))
    path.write_text('{"id": "c1"}\n{"id": \n')
    assert files.read_records(spark, str(path), schema="id string", first=1).count() == 1
    with pytest.raises(Exception):
        files.read_records(spark, str(path), schema="id string", first=2).collect()
