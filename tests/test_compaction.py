"""Batches packed into segments: the same rows, fewer files, nothing lost by a failure."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from salesmart import files
from salesmart.config import INDIA
from salesmart.operators import compaction
from salesmart.operators.compaction import Piece, compact, pack
from salesmart.operators.sinks import SEGMENTS, STATE, read_if_present
from salesmart.plans.upkeep import compact_sources
from salesmart.streaming.incremental import load_new_files
from tests.samples import csv_line, values
from tests.test_changes import Shop
from tests.test_incremental import paths_below
from tests.test_ingest import lines, put

MB = 1 << 20


def table(spark, path, batches, first=0):
    for b in range(first, first + batches):
        spark.range(b * 40, b * 40 + 40, numPartitions=4).withColumn("text", F.lit(None).cast("string")) \
            .write.mode("overwrite").parquet(f"{path}/batch_id={b}")


def folders(path):
    return sorted(p.name for p in path.iterdir() if p.name.startswith("batch_id="))


def test_rows_stay_and_files_become_few(spark, tmp_path):
    path = tmp_path / "rows"
    table(spark, path, 5)
    before = values(read_if_present(spark, str(path)), "id", "batch_id", "text")
    assert compact(spark, str(path), ["id"], through=3) == 1
    after = read_if_present(spark, str(path))
    assert values(after, "id", "batch_id", "text") == before and len(before) == 200
    assert after.columns == ["id", "text", "batch_id"]
    [segment] = json.loads((path / STATE).read_text())["segments"]
    assert (segment["first"], segment["last"], segment["files"]) == (0, 3, 1)
    assert [r["id"] for r in spark.read.parquet(f"{path}/{SEGMENTS}/{segment['name']}").collect()] == list(range(160))
    # Replaced folders stay for readers until the next compaction, which finds nothing else to do.
    assert len(folders(path)) == 5
    assert compact(spark, str(path), ["id"], through=3) == 0
    assert folders(path) == ["batch_id=4"]
    assert values(read_if_present(spark, str(path)), "id", "batch_id", "text") == before
    # A batch that is delivered again replaces its own folder, which is never packed.
    table(spark, path, 1, first=4)
    assert read_if_present(spark, str(path)).count() == 200


def test_a_failure_leaves_the_rows(spark, tmp_path, monkeypatch):
    path = tmp_path / "rows"
    table(spark, path, 3)
    with monkeypatch.context() as broken:
        def fails(*_):
            raise OSError("no space")
        broken.setattr(files, "write_text", fails)
        with pytest.raises(OSError, match="no space"):
            compact(spark, str(path), ["id"], through=1)
    assert len(list((path / SEGMENTS).iterdir())) == 1
    assert read_if_present(spark, str(path)).count() == 120
    assert compact(spark, str(path), ["id"], through=1) == 1
    assert len(list((path / SEGMENTS).iterdir())) == 1
    assert read_if_present(spark, str(path)).count() == 120


def test_old_segments_are_copied_rarely():
    """A thousand loads of one size: each is copied some log2(1000) times and few segments remain."""
    segments, copied = [], 0
    for number in range(1000):
        batch = Piece(f"batch_id={number}", number, number, MB, 9)
        for run in pack(segments, [batch], 1 << 40, 10 * MB):
            segments = [s for s in segments if s not in run]
            size = compaction.size(run)
            segments.append(Piece(f"segment-{number}", run[0].first, run[-1].last, size, -(-size // (10 * MB))))
            copied += size // MB
    assert sum(s.bytes for s in segments) == 1000 * MB
    assert len(segments) <= 11 and copied <= 11 * 1000


def test_runs_are_bounded_and_large_batches_stay():
    def batch(number, size, count=9):
        return Piece(f"batch_id={number}", number, number, size, count)

    def packed(segments, batches, limit):
        return [[p.name for p in run] for run in pack(segments, batches, limit * MB, 10 * MB)]

    few = [batch(n, MB) for n in range(4)]
    assert packed([], few, 3) == [["batch_id=0", "batch_id=1", "batch_id=2"], ["batch_id=3"]]
    assert packed([], [few[0], batch(1, 90 * MB), few[2], few[3]], 50) == [["batch_id=0"], ["batch_id=2", "batch_id=3"]]
    assert packed([], [batch(0, MB, count=1)], 50) == packed([], [], 50) == []
    old = [Piece("segment-a", 0, 3, 8 * MB, 1), Piece("segment-b", 4, 4, MB, 1)]
    assert packed(old, [batch(5, 2 * MB)], 50) == [["segment-b", "batch_id=5"]]
    assert packed(old, [batch(5, 8 * MB)], 50) == [["segment-a", "segment-b", "batch_id=5"]]
    assert packed(old, [batch(5, 8 * MB)], 9) == [["segment-b", "batch_id=5"]]


def test_loads_go_on_after_compaction(spark, tmp_path):
    landing, paths = tmp_path / "landing", paths_below(tmp_path)
    for k in range(6):
        put(landing, INDIA, f"{k}.csv", lines(csv_line(**{"Order ID": f"O-{k}"}), csv_line(Tax="n/a")))
        load_new_files(spark, str(landing), INDIA, paths)
        if k:
            compact(spark, paths.rows, ["SALES_ORDER_KEY"], through=k - 1)
            compact(spark, paths.rejects, ["_METADATA_FILENAME", "_METADATA_ROW_NUMBER"], through=k - 1)
            compact(spark, paths.keys, ["batch_id"], through=k - 1)
    rows = values(read_if_present(spark, paths.rows), "ORDER_ID", "SALES_ORDER_KEY", "batch_id")
    assert rows == [(f"O-{k}", 2 * k + 1, k) for k in range(6)]
    assert values(read_if_present(spark, paths.keys), "last_key") == [(2 * k + 2,) for k in range(6)]
    assert read_if_present(spark, paths.rejects).count() == 6


def test_builds_between_compactions_equal_one_build(spark, tmp_path):
    shops = [Shop(spark, tmp_path / name) for name in ("packed", "plain") if not (tmp_path / name).mkdir()]
    orders = [(f"O-{k}", day, k + 1) for k, day in enumerate(
        ("2020-01-31", "2020-02-01", "2021-05-05", "2020-01-31"))]
    for k, order in enumerate(orders):
        for shop in shops:
            shop.india(f"{k}.csv", order, at=1_600_000_000 + k)
            shop.build()
        compact_sources(shops[0].warehouse)
    packed, plain = shops
    assert packed.fact() == plain.fact()
    source = packed.warehouse.path("source", "in_sales_order")
    assert json.loads(files.read_text(spark, f"{source}/{STATE}"))["segments"]
    packed.warehouse.publish("source", "in_sales_order")
    try:
        found = spark.sql("SELECT ORDER_ID, batch_id FROM source.in_sales_order ORDER BY 1").collect()
        assert [tuple(r) for r in found] == [(f"O-{k}", k) for k in range(4)]
        packed.warehouse.publish("source", "in_sales_order")
    finally:
        spark.sql("DROP DATABASE source CASCADE")
    assert compaction.SEGMENT_BYTES > compaction.FILE_BYTES
