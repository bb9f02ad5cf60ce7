"""Queries over several sources read and join the order tables once, and write compactly."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from salesmart.checks import queries
from salesmart.config import COUNTRIES, FRANCE, INDIA
from salesmart.operators.compaction import compact
from salesmart.operators.sinks import SEGMENTS
from salesmart.plans import fact
from salesmart.plans.build import build_warehouse
from salesmart.plans.dimensions import REGION
from salesmart.sources.landing import load_landing
from salesmart.sources.testdata import exchange_rates, landing_text, write_landing, write_rates
from salesmart.sources.warehouse import Warehouse
from salesmart.staging import application_folder


@pytest.mark.parametrize("name", ["ingest_lineage", "assign_load_key", "file_manifest", "ingest_compacted"])
def test_the_order_tables_are_joined_once(spark, sf_dir, monkeypatch, name):
    passes, lines = [], queries.sales_lines

    def counted(*args):
        passes.append(args)
        return lines(*args)

    monkeypatch.setattr(queries, "sales_lines", counted)
    monkeypatch.setattr("salesmart.sources.testdata.sales_lines", counted)
    queries.QUERIES[name](spark, sf_dir)
    assert len(passes) == 1


def test_the_files_of_a_year_take_no_shuffle(spark, sf_dir):
    scratch = Path(application_folder(spark))
    before = set(scratch.iterdir()) if scratch.exists() else set()
    rows = queries.file_manifest(spark, sf_dir).collect()
    [root] = [f for f in scratch.iterdir() if f not in before and list(f.glob("source=*/format=*"))]
    sent = [f for f in root.rglob("part-*") if "source=" in str(f)]
    assert len(sent) == len(rows) and {f.suffix for f in sent} == {".gz", ".parquet"}
    for country in COUNTRIES:
        loaded = load_landing(spark, str(root), country).rows
        assert loaded.count() == landing_text(spark, sf_dir, country).count()


def test_packed_files_hold_the_same_rows(spark, sf_dir, tmp_path):
    text = landing_text(spark, sf_dir, FRANCE)
    for packed in (False, True):
        write_landing(text, f"{tmp_path}/{packed}", FRANCE, packed=packed)
    plain, small = (
        load_landing(spark, f"{tmp_path}/{p}", FRANCE).rows.drop(
            "SALES_ORDER_KEY", "_METADATA_FILENAME", "_METADATA_ROW_NUMBER", "_METADATA_LAST_MODIFIED"
        )
        for p in (False, True)
    )
    assert plain.exceptAll(small).count() == small.exceptAll(plain).count() == 0


def test_a_file_of_a_segment_has_so_many_rows(spark, tmp_path):
    for batch in range(3):
        spark.range(batch * 1000, batch * 1000 + 1000, 1, 4).write.parquet(f"{tmp_path}/batch_id={batch}")
    assert compact(spark, str(tmp_path), ["id"], through=1, file_rows=250) == 1
    files = sorted(tmp_path.glob(f"{SEGMENTS}/*/part-*"))
    found = [[r["id"] for r in spark.read.parquet(str(f)).collect()] for f in files]
    assert len(files) == 8 and max(map(len, found)) < 500
    assert sum(found, []) == list(range(2000))


def test_only_rows_of_the_same_regions_are_compared(spark, sf_dir):
    star = queries.fact_rows(spark, sf_dir)[1]
    keys = {r["Country"]: r[REGION.key] for r in star.region.collect()}
    existing = spark.createDataFrame([(k, n) for n, k in enumerate([*keys.values(), None])],
                                     "region_id_fk bigint, n int")
    own = star.region.where(F.col("Country") == INDIA.country).select("Country", "Region")
    found = fact.of_same_regions(own, star, existing).collect()
    assert [r["region_id_fk"] for r in found] == [keys[INDIA.country]]


def test_a_build_leaves_no_intermediate_tables(spark, sf_dir, tmp_path):
    scratch, warehouse = Path(application_folder(spark)), Warehouse(spark, f"{tmp_path}/warehouse")
    write_rates(exchange_rates(spark, sf_dir), f"{tmp_path}/rates")
    before = set(scratch.rglob("*.parquet"))
    for country in (INDIA, FRANCE):  # the second build replaces months of the fact
        write_landing(landing_text(spark, sf_dir, country), f"{tmp_path}/landing", country)
        build_warehouse(warehouse, f"{tmp_path}/landing", f"{tmp_path}/rates")
    assert warehouse.read("consumption", fact.FACT_TABLE).count()
    assert not set(scratch.rglob("*.parquet")) - before


def test_only_sources_that_need_whole_days_are_dealt_by_day(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "LINES_A_FILE", 100)
    for country in (INDIA, FRANCE):
        text = landing_text(spark, sf_dir, country).coalesce(2)
        queries._landing_of_days(spark, text, str(tmp_path), country)
        sent = spark.read.format(country.file_format).option("header", True).load(f"{tmp_path}/{country.directory}")
        assert sent.select(*sorted(text.columns)).exceptAll(text.select(*sorted(text.columns))).count() == 0
        assert sent.count() == text.count()
        placed = sent.withColumn("file", F.col("_metadata.file_path"))
        if country is INDIA:
            files = placed.groupBy("Order Date").agg(F.countDistinct("file").alias("n"))
            assert files.agg(F.max("n")).first()[0] == 1
        else:
            assert placed.groupBy("file").count().agg(F.max("count")).first()[0] == 100
