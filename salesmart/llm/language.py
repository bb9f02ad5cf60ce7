"""Language identification by rank-order profiles.

A language's profile is the ranking of its most frequent letter n-grams over all its training
texts. A document's own most frequent n-grams are ranked too; its distance to a language is the
sum, over its n-grams, of how far each is from its place in the profile, an n-gram outside the
profile counting as the profile's length. The nearest language wins.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import by_bytes, documents, id_remainder

#: n-grams in a profile, of a language and of a document.
PROFILE = 300
#: Different n-grams a training task holds before it hands their counts on.
HELD_GRAMS = 1_000_000
FOLDS = 5
UNDETERMINED = "und"


def letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)])


def grams(text: str, letter: np.ndarray) -> np.ndarray:
    """Sorted keys of all n-grams of one to three letters, words being padded with a space.

    A key holds up to three code points of 21 bits; n-grams do not reach across words.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    codes = np.concatenate([[0], np.where(letter[codes], codes, 0), [0]])
    codes = codes[(codes > 0) | np.concatenate([[True], codes[:-1] > 0])]
    pairs = codes[:-1] << 21 | codes[1:]
    triples = (pairs[:-1] << 21 | codes[2:])[codes[1:-1] > 0]
    found = np.concatenate([codes[codes > 0], pairs[pairs > 0], triples])
    found.sort()
    return found


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values of sorted ``keys`` and how often each occurs."""
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[begin], np.diff(np.append(begin, len(keys)))


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(c) for c in zip(*parts, strict=True))
    different, place = np.unique(keys, return_inverse=True)
    return different, np.bincount(place, counts, len(different)).astype(np.int64)


def gram_counts(training: DataFrame) -> DataFrame:
    """lang, gram, n: the n-grams of all texts of each language, summed per task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter, held = letters(), {}

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, (keys, counts) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts)],
                    names=["lang", "gram", "n"])
            held.clear()

        for batch in by_bytes(batches, limit=1 << 20):
            parts: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "text")), strict=True):
                parts.setdefault(lang, []).append(grams(text, letter))
            for lang, found in parts.items():
                keys = np.concatenate(found)
                keys.sort()
                held[lang] = merged([*([held[lang]] if lang in held else []), counted(keys)])
            if sum(len(keys) for keys, _ in held.values()) > HELD_GRAMS:
                yield from rows()
        yield from rows()

    return training.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")


def learn(training: DataFrame, size: int = PROFILE) -> dict[str, np.ndarray]:
    """Language -> its ``size`` most frequent n-grams, by rank, from all rows of ``training``
    (lang, text). Ties go to the smaller key. What reaches the driver is ``size`` numbers for
    each language."""
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = (
        gram_counts(training.filter("lang IS NOT NULL AND text IS NOT NULL"))
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= size)
    )
    profiles: dict[str, list] = {}
    for row in top.collect():
        profiles.setdefault(row["lang"], []).append((row["rank"], row["gram"]))
    return {lang: np.array([g for _, g in sorted(found)], np.int64) for lang, found in sorted(profiles.items())}


class Profiles:
    def __init__(self, profiles: dict[str, np.ndarray], size: int = PROFILE):
        self.size, self.names = size, list(profiles)
        self.order = [np.argsort(p) for p in profiles.values()]
        self.keys = [p[o] for p, o in zip(profiles.values(), self.order, strict=True)]
        self.letter = letters()

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language and 1 minus its distance as a share of the largest possible."""
        keys, counts = counted(grams(text or "", self.letter))
        if not len(keys) or not self.names:
            return UNDETERMINED, 0.0
        mine = keys[np.lexsort((keys, -counts))[:self.size]]
        ranks, distances = np.arange(len(mine)), []
        for sorted_keys, order in zip(self.keys, self.order, strict=True):
            at = np.minimum(np.searchsorted(sorted_keys, mine), len(sorted_keys) - 1)
            off = np.where(sorted_keys[at] == mine, np.abs(order[at] - ranks), self.size)
            distances.append(int(np.minimum(off, self.size).sum()))
        nearest = int(np.argmin(distances))
        return self.names[nearest], 1 - distances[nearest] / (self.size * len(mine))


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], size: int = PROFILE) -> DataFrame:
    """doc_id, lang_pred and score of every row of ``docs`` (doc_id, text).

    Without text, without a letter, or without any profile the answer is ``und`` with score 0;
    between equally near languages the first by name. Rows are independent of each other.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Profiles(profiles, size)
        for batch in by_bytes(batches):
            found = [known.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([n for n, _ in found], pa.string()),
                pa.array([s for _, s in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text") \
        .mapInArrow(run, "doc_id long, lang_pred string, score double")


def op6_language(spark, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from those outside the held-out fold."""
    docs = documents(spark, sf_dir)
    fold = id_remainder(F.col("doc_id"), FOLDS)
    profiles = learn(docs.filter(fold != 0))
    return identify(docs, profiles).select(
        "doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
