"""Quality rules as a short-circuit cascade.

A rule needs measures of the text and rejects on them. Rules are tried on a sample first: the
time each takes there and the share it rejects give its rejection per cost, and the rules run in
that order. A measure is computed only for rows that no earlier rule has rejected. The order
changes the cost and the name of the first failed rule, never which rows are kept.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import WORD_SPACE, documents, words_of
from salesmart.staging import stage

#: Rows of the sample on which cost and rejection are estimated, about.
SAMPLE_ROWS = 2000


def has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(WORD_SPACE)) != ""


def window_hashes(words: Column) -> Column:
    """A 64-bit hash of each five-word window."""
    return F.when(
        F.size(words) > 5,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 5),
            lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(5)]),
        ),
    )


def sorted_windows(words: Column, hashes: Column) -> Column:
    """The five-word windows with their positions in order, where two hashes agree."""
    return F.when(
        F.size(F.array_distinct(hashes)) < F.size(hashes),
        F.array_sort(
            F.transform(
                F.sequence(F.lit(0), F.size(words) - 5),
                lambda i: F.struct(
                    F.array_join(F.slice(words, i + 1, 5), " ").alias("window"), i.alias("at")
                ),
            )
        ),
    )


def repeated_at(windows: Column) -> Column:
    """Positions of the windows equal to a neighbour in sorted order, ascending."""
    def equal(k: Column, other: Column) -> Column:
        # get() gives NULL beyond either end
        return F.coalesce(F.get(windows, other)["window"] == F.get(windows, k)["window"], F.lit(False))

    return F.array_sort(
        F.transform(
            F.filter(
                F.sequence(F.lit(0), F.size(windows) - 1),
                lambda k: equal(k, k - 1) | equal(k, k + 1),
            ),
            lambda k: F.get(windows, k)["at"],
        )
    )


def covered(positions: Column) -> Column:
    """Words in the five-word windows that begin at ascending ``positions``."""
    total = F.aggregate(
        positions,
        F.struct(F.lit(-5).alias("last"), F.lit(0).cast("long").alias("words")),
        lambda a, p: F.struct(
            p.alias("last"), (a["words"] + F.least(F.lit(5), p - a["last"])).alias("words")
        ),
    )
    return F.coalesce(total["words"], F.lit(0).cast("long"))


def left_of(text: Column, dropped: str) -> Column:
    return F.char_length(F.regexp_replace(text, dropped, "")).cast("long")


#: Measures in order: each may use earlier ones. A later projection never repeats an earlier one.
MEASURES: dict[str, Callable[[], Column]] = {
    "words": lambda: words_of(F.col("text")),
    "n_words": lambda: F.size("words").cast("long"),
    "word_chars": lambda: F.char_length(F.array_join("words", "")).cast("long"),
    "n_symbols": lambda: F.char_length("text").cast("long") - left_of(F.col("text"), r"[#*$%&|<>]"),
    "lines": lambda: F.filter(F.split("text", "\n"), has_word),
    "n_lines": lambda: F.size("lines").cast("long"),
    "n_dup_lines": lambda: (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
    "hashes": lambda: window_hashes(F.col("words")),
    "windows": lambda: sorted_windows(F.col("words"), F.col("hashes")),
    "positions": lambda: repeated_at(F.col("windows")),
    "n_repeat_words": lambda: covered(F.col("positions")),
    "n_letters": lambda: left_of(F.col("text"), r"[^\p{L}]+"),
    "n_capitals": lambda: left_of(F.col("text"), r"[^\p{Lu}]+"),
}

NEEDS = {
    "n_words": ("words",),
    "word_chars": ("words",),
    "n_lines": ("lines",),
    "n_dup_lines": ("lines",),
    "n_repeat_words": ("words", "hashes", "windows", "positions"),
}


@dataclass(frozen=True)
class Rule:
    """Rejects a row for which the SQL condition ``fails``, on ``measures``, holds."""

    name: str
    measures: tuple[str, ...]
    fails: str


BASE_FAILED = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"

RULES = (
    Rule("few_words", ("n_words",), "n_words < 10"),
    Rule("repeated_words", ("n_words", "n_repeat_words"), "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", ("n_words", "n_symbols"), "100 * n_symbols > 10 * n_words"),
    Rule("repeated_lines", ("n_lines", "n_dup_lines"), "100 * n_dup_lines > 40 * n_lines"),
    Rule("long_words", ("n_words", "word_chars"), "word_chars > 20 * n_words"),
    Rule("capitals", ("n_letters", "n_capitals"), "100 * n_capitals > 60 * n_letters"),
    Rule("few_letters", ("word_chars", "n_letters"), "100 * n_letters < 40 * word_chars"),
)


def steps(rule: Rule) -> list[str]:
    """All measures the rule needs, in the order of MEASURES."""
    wanted = {n for m in rule.measures for n in (m, *NEEDS.get(m, ()))}
    return [m for m in MEASURES if m in wanted]


def judged(rows: DataFrame, rules: Sequence[Rule], always: Sequence[str] = ()) -> DataFrame:
    """Add ``failed_rule``, NULL where no rule rejects, and the measures ``always`` wanted.

    ``rows`` has a non-null ``text``. Measures not in ``always`` are NULL for rows that an
    earlier rule has rejected.
    """
    df, have = rows.withColumn("failed_rule", F.lit(None).cast("string")), set()
    unconditional = {n for m in always for n in (m, *NEEDS.get(m, ()))}
    for rule in rules:
        for name in steps(rule):
            if name not in have:
                value = MEASURES[name]()
                open_ = F.col("failed_rule").isNull()
                df = df.withColumn(name, value if name in unconditional else F.when(open_, value))
                have.add(name)
        fails = F.coalesce(F.expr(rule.fails), F.lit(False))
        df = df.withColumn("failed_rule", F.coalesce("failed_rule", F.when(fails, rule.name)))
    for name in MEASURES:
        if name in unconditional and name not in have:
            df = df.withColumn(name, MEASURES[name]())
    return df


def ordered(texts: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejection per cost, both measured on a sample of about ``sample_rows``."""
    total = texts.count()
    sample = stage(texts.sample(fraction=min(1.0, sample_rows / max(1, total)), seed=7), "sample")
    scores = []
    for place, rule in enumerate(rules):
        begin = time.perf_counter()
        rejected = judged(sample, [rule]).agg(F.count("failed_rule")).first()[0]
        cost = time.perf_counter() - begin
        scores.append((-rejected / cost, place, rule))
    return [rule for _, _, rule in sorted(scores, key=lambda s: s[:2])]


def cascade(
    docs: DataFrame, rules: Sequence[Rule] = RULES, always: Sequence[str] = (),
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Judge every row of ``docs``: the row as struct ``row``, ``failed_rule`` and ``kept``.

    A NULL text counts as empty. Rows are judged alone, so ties, repeated rows and NULL ids
    change nothing; an empty table gives no rows. The struct keeps all input columns, whatever
    their names.
    """
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", F.coalesce("row.text", F.lit("")).alias("text")
    )
    order = ordered(rows.select("text"), rules, sample_rows)
    return judged(rows, order, always).withColumn("kept", F.col("failed_rule").isNull())


def quality_rules_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that no rule rejects."""
    # A plain filter would be pushed below the cascade, each measure spelled out again in it.
    kept = cascade(docs).select(F.explode_outer(F.when(F.col("kept"), F.array("row"))).alias("row"))
    return kept.filter(F.col("row").isNotNull()).select("row.*")


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    """All documents with their measures and the cascade's verdict."""
    return cascade(documents(spark, sf_dir), always=BASE).select(
        F.col("row.doc_id").alias("doc_id"), *BASE,
        F.expr(BASE_FAILED).alias("base_failed"), "kept",
    )


OP10_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), w AS (
    SELECT doc_id, unnest(range(0, len(words) - 4)) AS i, words FROM d WHERE len(words) > 4
), g AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(words[i + 1:i + 5], ' ')) AS n
    FROM w
), r AS (
    SELECT doc_id, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM g WHERE n > 1) GROUP BY doc_id
), m AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
           CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(lines) AS BIGINT) AS n_lines,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
           length(regexp_replace(text, '[^\p{L}]+', '', 'g')) AS n_letters,
           length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) AS n_capitals
    FROM d LEFT JOIN r USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words
            OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 40 * n_lines
            OR word_chars > 20 * n_words OR 100 * n_capitals > 60 * n_letters
            OR 100 * n_letters < 40 * word_chars) AS kept
FROM m
"""
