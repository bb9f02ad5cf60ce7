"""The joins of near duplicates move their rows no more often than they must."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from salesmart.llm import near_dedup


def shuffles(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_nearest_pairs(spark):
    draw = random.Random(3)
    pairs = [(a, b, draw.randrange(15, 33)) for a in range(60) for b in range(a) if draw.random() < 0.2]
    found = near_dedup.nearest_pairs(spark.createDataFrame(pairs, near_dedup.CANDIDATES))
    below = {a: max((n, b) for x, b, n in pairs if x == a)[1] for a in {p[0] for p in pairs}}
    above = {b: max((n, a) for a, x, n in pairs if x == b)[1] for b in {p[1] for p in pairs}}
    rows = [tuple(r) for r in found.select("a", "b").collect()]
    assert sorted(rows) == sorted({*below.items(), *((a, b) for b, a in above.items())})
    assert shuffles(found) == 2


def test_small_nodes_meet_in_one_shuffle(spark):
    draw = random.Random(4)
    rows = [(node, 100 * node + k, draw.randrange(3) if node % 4 else 7) for node in range(40) for k in range(9)]
    df = spark.createDataFrame(rows + rows[::3], "node long, class long, color long")
    found = near_dedup.facing_in_small_nodes(df)
    assert shuffles(found) == 1
    met = {}
    for r in found.collect():
        met.setdefault(r["node"], []).append((r["class"], r["color"], r["few"], r["bucket"]))
    mixed = {n for n in range(40) if len({c for x, _, c in rows if x == n}) > 1}
    assert set(met) == mixed and len(mixed) == 30
    for node, members in met.items():
        assert sorted(m[:2] for m in members) == sorted((k, c) for n, k, c in rows if n == node)
        # All of one colour, the others are the few.
        assert len({c for _, c, few, _ in members if not few}) == 1
        assert not {c for _, c, few, _ in members if not few} & {c for _, c, few, _ in members if few}
        assert {m[3] for m in members} == {0}


def test_roots_are_counted_in_one_shuffle(spark):
    rows = spark.range(1000).select(
        (F.col("id") % 90).alias("node"), F.col("id").alias("class"), F.col("id").alias("color"),
        F.lit(5).cast("long").alias("n_shingles"), F.lit(b"s" * near_dedup.SKETCH).alias("sketch"))
    classes = rows.select("class", "n_shingles", "sketch")
    found = near_dedup.mixed_nodes(rows, 0, classes).select("node", "class", "node_size", "dominant_size").collect()
    assert len(found) == 1000 and {r["dominant_size"] for r in found} == {1}
    assert {r["node"]: r["node_size"] for r in found} == {n: 12 if n < 10 else 11 for n in range(90)}
