"""Data-quality and reconciliation checks. Each returns a small table of findings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.casts import failed_cast


def _rows() -> Column:
    return F.count(F.lit(1))


def _as_rows(one_row: DataFrame, label: str, value: str) -> DataFrame:
    """Turn a one-row table of measures into (label, value) rows."""
    return one_row.unpivot([], list(one_row.columns), label, value)


def count_where(df: DataFrame, tests: Mapping[str, Column], label: str, value: str) -> DataFrame:
    """Rows that pass each test, all counted in one pass."""
    counts = [F.count_if(test).alias(name) for name, test in tests.items()]
    return _as_rows(df.agg(*counts), label, value)


def type_errors(raw: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Per column, values that are present and do not fit their type."""
    tests = {c: failed_cast(F.col(f"`{c}`"), t) for c, t in types.items()}
    return count_where(raw, tests, "column_name", "n_errors")


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column, how many values are NULL."""
    tests = {c: F.col(c).isNull() for c in columns}
    return count_where(df, tests, "column_name", "n_nulls")


def out_of_range(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Per rule, how many rows break it."""
    return count_where(df, {name: ~rule for name, rule in rules.items()}, "rule", "n_broken")


def _wrong_dollars(local: str, dollars: str) -> Column:
    """Whether dollars are missing or given without ground, or times the rate not the amount.

    They have six places, so their product with the rate may be off by the rate's millionth.
    """
    rate = F.col("EXCHANGE_RATE")
    convertible = F.col(local).isNotNull() & F.coalesce(rate != 0, F.lit(False))
    difference = F.abs(F.col(dollars) * rate - F.col(local))
    off = difference > F.abs(rate) * F.lit("0.000001").cast("decimal(7,6)")
    return (convertible != F.col(dollars).isNotNull()) | F.coalesce(off, F.lit(False))


def conversion_errors(curated: DataFrame) -> DataFrame:
    """Rows whose dollars are not what amount and rate give, per country; a result that did not
    fit its type and is NULL is one of them."""
    wrong = _wrong_dollars("LOCAL_TOTAL_ORDER_AMT", "USD_TOTAL_ORDER_AMT") | _wrong_dollars(
        "LOCAL_TAX_AMT", "USD_TAX_AMT"
    )
    return curated.groupBy("Country").agg(
        _rows().alias("n_rows"), F.count_if(wrong).alias("n_wrong")
    )


def repeated(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: how many value tuples of ``columns`` occur more than once."""
    copies = df.groupBy(*columns).agg(_rows().alias("n")).where("n > 1")
    return copies.agg(_rows().alias("n_repeated"))


def duplicate_members(tables: Mapping[str, tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Per dimension (table, key, identity): repeated keys and repeated identities."""
    checks = []
    for name, (rows, key, identity) in tables.items():
        for what, columns in (("key", [key]), ("identity", list(identity))):
            checks.append(
                repeated(rows, columns).select(
                    F.lit(name).alias("dimension"), F.lit(what).alias("checked"), "n_repeated"
                )
            )
    return reduce(DataFrame.unionByName, checks)


def orphans(fact: DataFrame, references: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per foreign key, fact rows whose key is NULL or missing from its dimension.

    One pass over the fact: its keys become (foreign key, value) rows that are counted on the map
    side, so what is shuffled and joined has each value once however hot it is.
    """
    names = list(references)
    values = fact.select(*[F.col(n).cast("bigint").alias(n) for n in names])
    per_value = values.unpivot([], names, "foreign_key", "value").groupBy(
        "foreign_key", "value"
    ).agg(_rows().alias("n"))
    known = reduce(
        DataFrame.unionByName,
        [
            dimension.select(F.lit(n).alias("foreign_key"), F.col(key).cast("bigint").alias("value"))
            for n, (dimension, key) in references.items()
        ],
    ).distinct().withColumn("known", F.lit(True))
    lost = F.when(F.col("known").isNull(), F.col("n")).otherwise(0)
    return (
        per_value.join(known, ["foreign_key", "value"], "left")
        .groupBy("foreign_key")
        .agg(F.sum(lost).alias("n_orphans"))
    )


def row_counts(tables: Mapping[str, DataFrame], label: str = "table_name") -> DataFrame:
    """Rows of each table."""
    counts = [
        df.agg(_rows().alias("n_rows")).select(F.lit(name).alias(label), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
