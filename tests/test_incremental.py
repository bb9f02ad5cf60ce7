from __future__ import annotations

import shutil
from dataclasses import replace

from pyspark.sql import functions as F

from salesmart.config import INDIA, USA
from salesmart.streaming.incremental import LoadPaths, load_new_files
from tests.samples import LINE, csv_line, values
from tests.test_ingest import lines, put


def paths_below(folder):
    return LoadPaths(*[str(folder / name) for name in ("rows", "rejects", "keys", "seen")])


def test_only_new_files_are_loaded(spark, tmp_path):
    landing, paths = tmp_path / "landing", paths_below(tmp_path)

    def run():
        load_new_files(spark, str(landing), INDIA, paths)
        return values(spark.read.parquet(paths.rows), "ORDER_ID", "SALES_ORDER_KEY")

    put(landing, INDIA, "a.csv", lines(csv_line(), csv_line(**{"Order ID": "O-2"})))
    assert run() == [("O-1", 1), ("O-2", 2)]
    assert run() == [("O-1", 1), ("O-2", 2)]

    put(landing, INDIA, "b.csv", lines(
        csv_line(**{"Order ID": "O-3"}), csv_line(**{"Order ID": "O-4", "Tax": "n/a"})
    ))
    assert run() == [("O-1", 1), ("O-2", 2), ("O-3", 3)]
    assert values(spark.read.parquet(paths.rejects), "ORDER_ID") == [("O-4",)]
    # the rejected row has used up its key
    put(landing, INDIA, "c.csv", lines(csv_line(**{"Order ID": "O-5"})))
    assert run()[-1] == ("O-5", 5)


def test_a_file_of_rejects_only(spark, tmp_path):
    landing, paths = tmp_path / "landing", paths_below(tmp_path)
    put(landing, INDIA, "a.csv", lines(csv_line(Tax="n/a")))
    load_new_files(spark, str(landing), INDIA, paths)
    assert spark.read.parquet(paths.rows).count() == 0
    assert spark.read.parquet(paths.rejects).count() == 1


def test_small_batches(spark, tmp_path):
    landing, paths = tmp_path / "landing", paths_below(tmp_path)
    for i in range(3):
        put(landing, INDIA, f"{i}.csv", lines(csv_line(**{"Order ID": f"O-{i}"})))
    load_new_files(spark, str(landing), INDIA, paths, files_per_batch=1)
    rows = values(spark.read.parquet(paths.rows), "SALES_ORDER_KEY", "batch_id")
    assert rows == [(1, 0), (2, 1), (3, 2)]


def test_types_may_differ_between_and_within_batches(spark, tmp_path):
    paths = paths_below(tmp_path)
    for wave in (("2", 3), (4.0, "5")):
        for k, quantity in enumerate(wave):
            frame = spark.createDataFrame([LINE]).withColumn("Quantity", F.lit(quantity))
            frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/landing/{USA.directory}/[{k}]")
        load_new_files(spark, f"{tmp_path}/landing", USA, paths)
    rows = spark.read.parquet(paths.rows)
    assert [int(q) for q, in values(rows, "ORDER_QUANTITY")] == [2, 3, 4, 5]
    assert values(rows, "SALES_ORDER_KEY") == [(1,), (2,), (3,), (4,)]


def test_a_repeated_batch_writes_the_same_rows_and_keys(spark, tmp_path):
    """Losing the note that a batch was finished makes Spark deliver it again."""
    landing, paths = tmp_path / "landing", paths_below(tmp_path)
    put(landing, INDIA, "a.csv", lines(csv_line()))
    load_new_files(spark, str(landing), INDIA, paths)
    put(landing, INDIA, "b.csv", lines(csv_line(**{"Order ID": "O-2"})))
    load_new_files(spark, str(landing), INDIA, paths)
    before = values(spark.read.parquet(paths.rows), "ORDER_ID", "SALES_ORDER_KEY", "batch_id")

    commits = tmp_path / "seen" / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    again = replace(paths, checkpoint=str(tmp_path / "seen-again"))
    shutil.copytree(
        paths.checkpoint, again.checkpoint, ignore=shutil.ignore_patterns(f"{last}", f".{last}.crc")
    )
    offsets = tmp_path / "seen" / "offsets"
    shutil.copytree(offsets, tmp_path / "seen-again" / "offsets", dirs_exist_ok=True)
    shutil.copytree(
        tmp_path / "seen" / "sources", tmp_path / "seen-again" / "sources", dirs_exist_ok=True
    )
    load_new_files(spark, str(landing), INDIA, again)
    after = values(spark.read.parquet(paths.rows), "ORDER_ID", "SALES_ORDER_KEY", "batch_id")
    assert after == before == [("O-1", 1, 0), ("O-2", 2, 1)]


def test_old_and_nested_files_are_new_files(spark, tmp_path):
    """Backfilled files keep their old times and may lie deeper; the stream loads them too."""
    import os

    from salesmart.config import COUNTRIES
    from salesmart.sources.landing import NO_AGE_LIMIT, stream_landing

    country = next(c for c in COUNTRIES if c.file_format == "csv")
    root = tmp_path / "landing"
    line = ",".join("1" for _ in country.fields) + "\n"
    head = ",".join(f.label for f in country.fields) + "\n"
    for k, name in enumerate(("a.csv", "2020/b.csv", "c.csv")):
        file = root / country.directory / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text((head if country.csv_header else "") + line)
        if k:
            os.utime(file, (1_500_000_000, 1_500_000_000))
    assert NO_AGE_LIMIT
    query = stream_landing(spark, str(root), country, 1).writeStream.format("memory").queryName("late") \
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert spark.table("late").count() == 3
