from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from salesmart.config import FRANCE, INDIA, USA
from salesmart.sources import landing
from salesmart.sources.landing import load_landing, read_landing, with_row_numbers
from salesmart.sources.manifest import landing_files
from salesmart.sources.rates import read_rate_files, repeated_rate_dates
from tests.samples import LINE, csv_line, values

HEADER = ",".join(LINE)


def put(root, country, name, text):
    folder = root / f"source={country.code}" / f"format={country.file_format}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def lines(*rows):
    return "\n".join([HEADER, *rows]) + "\n"


def test_bad_rows_are_rejected_and_good_rows_kept(spark, tmp_path):
    put(tmp_path, INDIA, "a.csv", lines(
        csv_line(),
        csv_line(**{"Order ID": "O-2", "Quantity": "many"}),
        csv_line(**{"Order ID": "O-3", "Order Date": "31st", "Tax": "n/a"}),
        "O-4,Bob,too,short",
        csv_line(**{"Order ID": "O-5"}) + ",extra",
        csv_line(**{"Order ID": "O-6", "Promotion Code": ""}),
    ))
    put(tmp_path, INDIA, "empty.csv", "")
    load = load_landing(spark, str(tmp_path), INDIA)
    assert values(load.rows, "ORDER_ID", "_METADATA_ROW_NUMBER") == [("O-1", 1), ("O-6", 6)]
    assert values(load.rows, "PROMOTION_CODE") == [(None,), ("P1",)]
    rejected = {r["ORDER_ID"]: r for r in load.rejects.collect()}
    assert rejected["O-2"]["bad_fields"] == ["Quantity"]
    assert rejected["O-3"]["bad_fields"] == ["Tax", "Order Date"]
    assert rejected["O-4"]["broken_line"] == "O-4,Bob,too,short"
    assert rejected["O-5"]["broken_line"].endswith(",extra")
    assert [rejected[k]["_METADATA_ROW_NUMBER"] for k in ("O-2", "O-3", "O-4", "O-5")] == [
        2, 3, 4, 5,
    ]


def test_json_by_name_with_missing_and_broken(spark, tmp_path):
    short = {k: v for k, v in LINE.items() if k != "Promotion Code"}
    number = {**LINE, "Order ID": "O-2", "Quantity": 3, "Tax": 0.5}
    text = "\n".join([json.dumps(short), json.dumps(number), '{"Order ID": "O-3", ', ""])
    put(tmp_path, FRANCE, "a.json", text)
    load = load_landing(spark, str(tmp_path), FRANCE)
    assert values(load.rows, "ORDER_ID", "PROMOTION_CODE") == [("O-1", None), ("O-2", "P1")]
    # The default scale of the French tax is whole units: 1.25 and 0.5 are rounded half up.
    assert [int(r[0]) for r in values(load.rows, "TAX_AMOUNT")] == [1, 1]
    assert load.rejects.count() == 1


def test_scale_is_a_parameter(spark, tmp_path):
    put(tmp_path, FRANCE, "a.json", json.dumps(LINE))
    exact = load_landing(spark, str(tmp_path), FRANCE.with_scale("TAX_AMOUNT"))
    assert str(exact.rows.first()["TAX_AMOUNT"]) == "1.25"


def test_amounts_beyond_their_type_are_rejected(spark, tmp_path):
    put(tmp_path, FRANCE, "a.json", json.dumps({**LINE, "Tax": "1" + "0" * 38}))
    load = load_landing(spark, str(tmp_path), FRANCE)
    assert load.rows.count() == 0 and load.rejects.first()["bad_fields"] == ["Tax"]


def test_amounts_of_38_digits_are_kept(spark, tmp_path):
    put(tmp_path, FRANCE, "a.json", json.dumps({**LINE, "Tax": "9" * 38, "Price per Unit": "10000000000"}))
    row = load_landing(spark, str(tmp_path), FRANCE).rows.first()
    assert (int(row["TAX_AMOUNT"]), int(row["UNIT_PRICE"])) == (10**38 - 1, 10**10)


def test_a_source_without_files_has_no_rows(spark, tmp_path):
    for country in (INDIA, USA):
        load = load_landing(spark, str(tmp_path), country)
        assert load.rows.count() == load.rejects.count() == 0
        assert load.rows.columns[-1] == "_METADATA_LAST_MODIFIED"


def test_parquet_files_of_different_types(spark, tmp_path):
    root = f"{tmp_path}/{USA.directory}"
    kinds = {"a": F.lit("2"), "b": F.lit(3), "c": F.lit(4.0), "d": F.lit(5).cast("decimal(5,1)")}
    for name, quantity in kinds.items():
        frame = spark.createDataFrame([{**LINE, "Order ID": name}]).withColumn("Quantity", quantity)
        frame.coalesce(1).write.mode("append").parquet(root if name != "c" else f"{root}/deep{{er}}")
    rows = load_landing(spark, str(tmp_path), USA).rows
    assert values(rows, "ORDER_ID", "ORDER_QUANTITY") == [("a", 2), ("b", 3), ("c", 4), ("d", 5)]
    assert values(rows, "_METADATA_ROW_NUMBER") == [(1,)] * 4
    assert values(rows, "SALES_ORDER_KEY") == [(1,), (2,), (3,), (4,)]


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_numbering_does_not_move_rows_however_many_splits(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(landing, "MOST_BROADCAST_SPLITS", most)
    for k in range(40):
        put(tmp_path, INDIA, f"{k:02}.csv", lines(csv_line(), csv_line()))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "10", "spark.sql.adaptive.enabled": "false",
                "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        numbered = with_row_numbers(read_landing(spark, str(tmp_path), INDIA), "key")
        plan = numbered._jdf.queryExecution().executedPlan().toString()
        found = numbered.select("_row", "key").collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sorted(r["key"] for r in found) == list(range(1, 81))
    assert all(r["_row"] in (1, 2) for r in found)
    # the dictionary is small enough to be sent, whatever the threshold for other tables is
    assert ("SortMergeJoin" in plan) == (most == 0)


def test_parquet_with_native_types_and_an_absent_column(spark, tmp_path):
    frame = spark.createDataFrame([LINE]).drop("Promotion Code").withColumns(
        {"Quantity": F.lit(2), "Order Date": F.to_date("Order Date"), "Tax": F.lit(0.6)}
    )
    frame.write.parquet(f"{tmp_path}/{USA.directory}")
    row = load_landing(spark, str(tmp_path), USA).rows.first()
    assert (row["ORDER_QUANTITY"], row["TAX_AMOUNT"], row["PROMOTION_CODE"]) == (2, 1, None)
    assert row["PHONE"] == "1" and str(row["ORDER_DT"]) == "2020-01-31"


@pytest.mark.parametrize("split_bytes", ["2000", "128m"])
def test_row_numbers_of_split_files(spark, tmp_path, split_bytes):
    """A file that many tasks read is numbered like one that a single task reads."""
    rows = [csv_line(**{"Order ID": f"{i}"}) for i in range(1, 301)]
    put(tmp_path, INDIA, "big.csv", lines(*rows))
    put(tmp_path, INDIA, "small.csv", lines(*rows[:7]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        raw = read_landing(spark, str(tmp_path), INDIA)
        assert raw.select("_split").distinct().count() > 5 or split_bytes == "128m"
        numbered = with_row_numbers(raw, "key", first_key=11).select(
            F.col("`Order ID`").cast("int").alias("id"), "_row", "key", "_file"
        )
        found = numbered.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert all(r["id"] == r["_row"] for r in found)
    assert sorted(r["key"] for r in found) == list(range(11, 318))


def test_manifest(spark, tmp_path):
    put(tmp_path, INDIA, "a.csv", lines())
    put(tmp_path, INDIA, "b.csv", lines(csv_line()))
    put(tmp_path, FRANCE, "c.json", "{}")
    (tmp_path / "top.csv").write_text("x")
    files = landing_files(spark, str(tmp_path), ".csv")
    assert values(files, "file_name", "partition_dir") == [
        ("a.csv", "source=IN/format=csv"), ("b.csv", "source=IN/format=csv"), ("top.csv", ""),
    ]


def test_rates(spark, tmp_path):
    (tmp_path / "rates.csv").write_text(
        "DATE,USD2USD,USD2EUR,USD2INR,USD2CAD,USD2UK,USD2JP\n"
        "2020-01-01,1,0.9,70.5,1.3,0.8,110\n"
        "2020-01-02,1,0.91,,1.3,0.8,110\n"
        "2020-01-02,1,0.92,71,1.3,0.8,110\n"
        "never,1,1,1,1,1,1\n"
    )
    load = read_rate_files(spark, str(tmp_path / "rates.csv"))
    # the last line of a day counts
    assert [(str(d), float(r)) for d, r in values(load.rows, "DATE", "USD2EU")] == [
        ("2020-01-01", 0.9), ("2020-01-02", 0.92),
    ]
    assert repeated_rate_dates(load.rows).count() == 0
    assert values(load.rejects, "row_number", "bad_fields") == [(3, ["repeated day"]), (5, ["DATE"])]
    twice = load.rows.unionByName(load.rows)
    assert repeated_rate_dates(twice).count() == 2


def test_rates_by_any_header(spark, tmp_path):
    folder = tmp_path / "rates"
    folder.mkdir()
    (folder / "a.csv").write_text('usd2inr, date ,"USD2EU"\n70,2020-01-01,0.9\n,2020-01-02,x\n71,,1\n\n')
    (folder / "b.csv").write_text("Date,USD2EUR\r\n2020-01-03,0.8\r\n")
    load = read_rate_files(spark, str(folder))
    found = [(str(r["DATE"]), r["USD2EU"] and float(r["USD2EU"]), r["USD2INR"] and float(r["USD2INR"]))
             for r in load.rows.orderBy("DATE").collect()]
    assert found == [("2020-01-01", 0.9, 70.0), ("2020-01-03", 0.8, None)]
    assert values(load.rejects, "row_number", "bad_fields") == [(3, ["USD2EU"]), (4, ["DATE"])]
