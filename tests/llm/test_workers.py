"""Python workers take memory beside an executor's heap and stay for a while: a task has one at most."""

from __future__ import annotations

import pytest

from salesmart.llm.common import local_table
from salesmart.llm.packing import packing_stage
from salesmart.llm.suffix_dedup import suffix_dedup_stage

WORDS = " ".join(f"w{k}" for k in range(60))
TEXTS = [f"one é {WORDS} ende", f"two ж {WORDS}\n\nmore", "日本語のテキスト alone", "", None]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def documents_of(spark):
    rows = [(k, t, "en", "made", None if t is None else len(t)) for k, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_a_task_that_removes_passages_has_one_python_worker(spark, sf_dir):
    found = suffix_dedup_stage(spark, documents_of(spark), sf_dir)
    assert plan_of(found).count("ArrowEvalPython") == 1
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in found.collect()}
    left = ["one é  ende", "two ж \n\nmore", *TEXTS[2:]]
    assert texts == {k: (t, None if t is None else len(t)) for k, t in enumerate(left)}


@pytest.mark.parametrize("rows", [[], [(1, 2), (3, -4)]])
def test_the_drivers_tables_need_no_rdd_and_so_no_workers(spark, rows):
    table = local_table(spark, rows, "one long, two long")
    assert "ExistingRDD" not in plan_of(table)
    assert table.schema.simpleString() == "struct<one:bigint,two:bigint>"
    assert sorted(map(tuple, table.collect())) == rows


def test_packing_starts_no_workers_but_those_of_its_tasks(spark, sf_dir):
    packed = packing_stage(spark, documents_of(spark), sf_dir)
    assert "ExistingRDD" not in plan_of(packed)
    assert packed.count() == len(TEXTS)
