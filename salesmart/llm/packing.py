"""Packing documents into sequences: shortest pack first, over the histogram of lengths.

Documents are cut into pieces of the sequence length and one rest. The histogram of piece
lengths, at most one count per possible length, is all that packing looks at: from the longest
length down, pieces go to the pattern with the least content so far, and patterns carry the
number of sequences made like them. Pieces then meet the patterns by their rank among the pieces
of their length, so that no piece passes the driver and no length is handled by one task. Very long
texts are cut like others; a task holds some megabytes of text, or one longer document.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from salesmart.llm.bpe import byte_characters
from salesmart.llm.common import by_bytes, crc32_of_ids, documents, give_memory_back, local_table
from salesmart.staging import stage

END_ID = 0
LENGTH = 1024


class Ids:
    """Ids exactly as the tokenizers library gives them, of a byte-level vocabulary file.

    The same vocabulary is loaded into tiktoken, whose merge loop takes a fifth of the time and
    which splits all code points alike. It cannot split very long runs of white space; such
    texts go to the tokenizers library itself.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        ranks = {bytes(byte_of[c] for c in t): i
                 for t, i in spec["model"]["vocab"].items() if t not in special}
        self.fast = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN,
                                      mergeable_ranks=ranks, special_tokens=special)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.long_space = regex.compile(r"\s{10000}")

    def encode(self, text: str) -> list[int]:
        if len(text) >= 10_000 and self.long_space.search(text):
            return self.library.encode(text, add_special_tokens=False).ids
        return self.fast.encode(text, allowed_special="all", disallowed_special=())


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, nth long"
#: Counts of pieces by part and length that are sent to all executors, 24 bytes each.
MOST_BROADCAST_COUNTS = 2_000_000


def pieces(
    docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """The pieces of all documents: ids of the text and ``end_id``, cut every ``length`` ids.

    A NULL or empty text is one piece with ``end_id`` alone. ``nth`` counts, from 0, the pieces of
    one length that a task makes. ``with_ids`` adds the ids.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, seen = Ids(path), [0] * (length + 1)
        for batch in by_bytes(batches):
            rows: list[tuple] = []
            for doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
                ids = np.array([*(ids_of.encode(text) if text else ()), end_id], np.int32)
                for start in range(0, len(ids), length):
                    part = ids[start:start + length]
                    row = (doc_id, start, len(part), crc32_of_ids(part), len(ids), seen[len(part)])
                    seen[len(part)] += 1
                    rows.append((*row, part) if with_ids else row)
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(c, pa.int64()) for c in columns[:6]]
            if with_ids:
                arrays.append(pa.array(columns[6], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in schema.split(", ")])
        del ids_of
        give_memory_back()

    schema = PIECES + ", ids array<int>" * with_ids
    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text").mapInArrow(run, schema)


def shortest_pack_first(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in one sequence) with the number of sequences of each.

    A length opens one new pattern at most and splits one at most, so there are at most two
    patterns per possible length, whatever the number of documents.
    """
    room: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            most = max((r for r, patterns in room.items() if patterns and r >= size), default=None)
            if most is None:
                room[length - size].append(((size,), left))
                break
            pattern, count = room[most].pop()
            take = min(left, count)
            if count > take:
                room[most].append((pattern, count - take))
            room[most - size].append(((*pattern, size), take))
            left -= take
    return sorted(p for patterns in room.values() for p in patterns)


def runs(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """For each place in each pattern: length, first and last rank, first sequence, offset."""
    used: dict[int, int] = defaultdict(int)
    result, sequence = [], 0
    for pattern, count in patterns:
        offset = 0
        for size in pattern:
            result.append((size, used[size], used[size] + count - 1, sequence, offset))
            used[size] += count
            offset += size
        sequence += count
    return result


def pack(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """Add sequence_id (gapless from 0) and offset to ``pieces`` that have a ``length`` of 1 to
    ``length``. Pieces of a length may change places. No pieces give no sequences.

    A piece's rank among those of its length is its number in the task that made it, after the
    pieces of earlier tasks; these counts are all that is shuffled, ids stay where they were written.
    """
    spark = cut.sparkSession
    rows = stage(cut.withColumn("part", F.spark_partition_id()), "pieces")
    counts = stage(rows.groupBy("part", "length").count(), "piece-counts")
    histogram = {r["length"]: r["sum(count)"] for r in counts.groupBy("length").sum("count").collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("earlier"))
    if counts.count() <= MOST_BROADCAST_COUNTS:
        starts = F.broadcast(starts)
    table = local_table(
        spark, runs(shortest_pack_first(histogram, length)),
        "length long, first long, last long, first_sequence long, offset long",
    )
    # Bounded by the sequence length, not by the data: small enough for every executor.
    return (
        rows.join(starts, ["part", "length"])
        .withColumn("rank", F.col("earlier") + F.col("nth"))
        .join(F.broadcast(table), "length")
        .filter(F.col("rank").between(F.col("first"), F.col("last")))
        .withColumn("sequence_id", F.col("first_sequence") + F.col("rank") - F.col("first"))
        .select(*[c for c in cut.columns if c != "nth"], "sequence_id", "offset")
    )


def packed_documents(docs: DataFrame, path: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """All documents cut into pieces and packed.

    NULL and repeated doc_ids are kept as they are; a NULL text is an empty document. Other
    columns are not read. An empty table gives no rows.
    """
    return pack(pieces(docs, path, length, END_ID, with_ids), length)


def packing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: what is left of the documents, packed, with the ids. Nulls, empty texts and
    empty tables as in ``packed_documents``."""
    return packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


def op5_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 ids."""
    return packed_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
