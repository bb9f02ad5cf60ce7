"""Intermediate tables of the operators that are deleted once nothing reads them."""

from __future__ import annotations

from pathlib import Path

import pyarrow.parquet as pq

from salesmart.llm import near_dedup
from salesmart.staging import application_folder


def test_no_table_with_tokens_or_paths_outlives_the_trees(spark):
    docs = spark.createDataFrame(
        [(k, " ".join(f"w{k % 7}-{n}" for n in range(30))) for k in range(40)] + [(40, None)],
        "doc_id long, text string")
    folder = Path(application_folder(spark))
    before = set(folder.rglob("*.parquet"))
    found = near_dedup.near_duplicates(docs, 2)
    left = set(folder.rglob("*.parquet")) - before
    assert not [f for f in left if {"tokens", "paths"} & set(pq.read_schema(f).names)]
    assert {(r["doc_id"], r["component_id"]) for r in found.collect()} == {(k, k % 7) for k in range(40)} | {(40, 40)}
