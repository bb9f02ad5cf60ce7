"""Removal of repeated passages: suffixes sorted into buckets that are refined at later offsets.

Two suffixes share 400 bytes if they stay in one bucket until 400 bytes are read. A suffix array
of the corpus would hold a row for each byte; here only one suffix in about 170 is bucketed, and
all others follow it:

* Of the 337 starts of 64-byte strings in a 400-byte window, the one with the least hash is the
  window's anchor. Equal windows have their anchors at equal distances. Consecutive windows with
  one anchor are a block.
* The initial q-gram buckets hold the anchors by their 64 bytes. An anchor alone in its bucket
  is done: none of its windows occurs elsewhere.
* A block's windows lie in the string from its first window's begin to its last one's end. If
  that whole string occurs elsewhere, all its windows do, and the block is done; one of the
  blocks with that string stays as a witness for blocks that share only a part of it.
* Other blocks are refined: cut at fixed distances from the anchor into blocks of 42 windows,
  then of 6, then single windows. A block's bucket is the string that all its windows share,
  64 bytes and the later offsets that the cut adds; the same two questions are asked again. A
  block asks only while its bucket holds others, so each level passes on what it has decided.

Buckets are named by hashes of content, so sorting is grouping, on shuffles with partial
aggregation, and a passage that every document has costs no task more than another. What decides
on removal is 128 bits of BLAKE2b over the string; the 64-bit bucket names only choose what to
look at further, so texts that collide in them cost work and change nothing.

The query reads bytes. The pipeline stage reads words: its passages are 51 words and more, however
many bytes those take, and each word is one number in place of a byte (``WORDS``).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import by_bytes, documents, give_memory_back
from salesmart.llm.near_dedup import MEMO_WORDS, WordHashes, mixed
from salesmart.staging import stage

LENGTH = 400
#: The least number of words of a passage that the pipeline removes.
LENGTH_WORDS = 51
#: Characters of scripts without spaces, each a word of its own: Thai, Lao, Burmese, Khmer, and from the
#: Chinese radicals to the end of the Chinese and Japanese signs; in UTF-8.
UNSPACED = re.compile(
    rb"\xe0[\xb8-\xbb].|\xe1(?:[\x80\x81\x9e\x9f].|\x82[\x80-\x9f])|\xe2[\xba-\xbf].|[\xe3-\xe9].."
    rb"|\xef[\xa4-\xab].|\xf0[\xa0-\xbf]..", re.DOTALL)
#: Windows of a long document that are hashed at once.
SEGMENT = 1 << 18
POSITION_BITS = 20


def word_edges(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text begin and end, in bytes: what stands between white space, however
    long, but for the characters of scripts without spaces."""
    found = np.frombuffer(data, np.uint8)
    inside = np.concatenate([[False], (found != 32) & ((found < 9) | (found > 13)), [False]])
    starts, stops = inside[1:] & ~inside[:-1], ~inside[1:] & inside[:-1]
    if len(found) and found.max() >= 0xE0:
        spans = np.array([m.span() for m in UNSPACED.finditer(data)], np.int64).reshape(-1, 2)
        first, after = spans[:, 0], spans[:, 1]
        starts[first] = stops[after] = True
        # Such a character ends the word before it and begins the one after it.
        stops[first] = inside[first]
        starts[after] = inside[after + 1]
    return np.flatnonzero(starts), np.flatnonzero(stops)


@dataclass(frozen=True)
class Passages:
    """What counts as a passage: ``length`` units, and how its windows are anchored and cut."""

    words: bool
    length: int
    gram: int
    #: Distances from the anchor are cut at multiples of these, level after level.
    widths: tuple[int, ...]

    @property
    def windows(self) -> int:
        return self.length - self.gram + 1

    @property
    def dtype(self) -> type:
        return np.uint64 if self.words else np.uint8

    def units(self, text: str, memo: WordHashes) -> np.ndarray:
        data = text.encode()
        if not self.words:
            return np.frombuffer(data, np.uint8)
        if len(memo) > MEMO_WORDS:
            memo.clear()
        begin, end = word_edges(data)
        found = (memo[data[b:e]] for b, e in zip(begin.tolist(), end.tolist(), strict=True))
        return np.fromiter(found, np.uint64, len(begin))


BYTES = Passages(words=False, length=LENGTH, gram=64, widths=(42, 6, 1))
WORDS = Passages(words=True, length=LENGTH_WORDS, gram=8, widths=(6, 1))


class Hashes:
    """A polynomial hash of any run of units of a text, from prefix sums modulo 2^64. Texts can be
    made to collide in it, so it only names buckets and chooses anchors."""

    def __init__(self, size: int = SEGMENT + 2 * LENGTH):
        random = np.random.default_rng(3)
        base = int(random.integers(1 << 62, 1 << 63)) * 2 + 1
        self.table = random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.powers = self.series(base, size)
        self.inverses = self.series(pow(base, -1, 1 << 64), size)

    @staticmethod
    def series(base: int, size: int) -> np.ndarray:
        return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, base, np.uint64))])

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        values = self.table[data] if data.dtype == np.uint8 else mixed(data ^ self.table[0]) | np.uint64(1)
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * self.powers[:len(data)])])

    def between(self, prefixes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (prefixes[end] - prefixes[begin]) * self.inverses[begin]
        value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return value ^ (value >> np.uint64(32))


def digests(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """128 bits of BLAKE2b of each run of units, in two rows of 64: what decides on equality."""
    whole = memoryview(np.ascontiguousarray(data)).cast("B")
    size = data.itemsize
    found = b"".join([blake2b(whole[b:e], digest_size=16).digest()
                      for b, e in zip((begin * size).tolist(), (end * size).tolist(), strict=True)])
    return np.frombuffer(found, np.int64).reshape(-1, 2).T


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from minima running both ways through tiles."""
    padded = np.concatenate([values, np.full(-len(values) % width, ~np.uint64(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, 1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return np.minimum(behind[:count], ahead[width - 1:width - 1 + count])


def blocks_of(data: np.ndarray, hashes: Hashes, passages: Passages) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks of a text's windows: first and last window, anchor, bucket, the outer string's digest."""
    length, gram, windows = passages.length, passages.gram, passages.windows
    for offset in range(0, len(data) - length + 1, SEGMENT):
        part = data[offset:offset + SEGMENT + length - 1]
        prefixes = hashes.prefixes(part)
        at = np.arange(len(part) - gram + 1)
        grams = hashes.between(prefixes, at, at + gram)
        # The leftmost of equal values is the anchor: the low bits hold the place.
        low = np.uint64((1 << POSITION_BITS) - 1)
        anchors = (least_in_windows((grams & ~low) | at.astype(np.uint64), windows) & low).astype(np.int64)
        begin = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
        end = np.append(begin[1:], len(anchors)) - 1
        outer = digests(part, begin, end + length)
        yield begin + offset, end + offset, anchors[begin] + offset, grams[anchors[begin]], *outer


BLOCKS = ("text_key binary, context int, anchor int, first int, last int, "
          "bucket long, outer_1 long, outer_2 long")
NAMES = [c.split()[0] for c in BLOCKS.split(", ")]


def blocks_batch(keys: pa.Array, context, anchor, first, last, *hashes: np.ndarray) -> pa.RecordBatch:
    ints = [pa.array(np.asarray(c), pa.int32()) for c in (context, anchor, first, last)]
    longs = [pa.array(h.view(np.int64)) for h in hashes]
    return pa.RecordBatch.from_arrays([keys, *ints, *longs], names=NAMES)


def keyed(docs: DataFrame, passages: Passages) -> DataFrame:
    """Texts that may hold a window (a unit has a byte at least), under a key of their content."""
    return docs.select(F.unhex(F.md5("text")).alias("text_key"), "text") \
        .filter(F.octet_length("text") >= passages.length)


def first_blocks(texts: DataFrame, passages: Passages) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen, memo = Hashes(), set(), WordHashes()
        for batch in by_bytes(batches):
            for key, text in zip(batch.column("text_key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if key in seen:  # the same text gives the same blocks
                    continue
                seen.add(key)
                for first, last, anchor, *found in blocks_of(passages.units(text, memo), hashes, passages):
                    keys = pa.array([key] * len(first), pa.binary())
                    yield blocks_batch(keys, first, anchor, first, last, *found)
        del hashes, seen, memo
        give_memory_back()

    return texts.mapInArrow(run, BLOCKS)


def refined(contexts: DataFrame, width: int, passages: Passages) -> DataFrame:
    """Blocks of ``width`` distances. ``contexts`` has text_key, context, anchor, data (the units
    from window ``context`` on) and blocks (first and last windows)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in by_bytes(batches, "data", SEGMENT // 2):
            rows = batch.to_pylist()
            # The contexts of a batch lie one after the other; hashes do not depend on the place.
            data = np.frombuffer(b"".join(r["data"] for r in rows), passages.dtype)
            sizes = np.array([len(r["data"]) for r in rows]) // data.itemsize
            shift = np.cumsum(sizes) - sizes - np.array([r["context"] for r in rows])
            blocks = [(k, b["first"], b["last"]) for k, r in enumerate(rows) for b in r["blocks"]]
            owner, first, last = np.array(blocks, np.int64).T
            anchor = np.array([r["anchor"] for r in rows])[owner]
            # One row for each cell that a block touches.
            near_cell, far_cell = (anchor - last) // width, (anchor - first) // width
            count = far_cell - near_cell + 1
            part = np.repeat(np.arange(len(owner)), count)
            cell = near_cell[part] + np.arange(len(part)) - np.repeat(np.cumsum(count) - count, count)
            owner, anchor = owner[part], anchor[part]
            near, far = cell * width, cell * width + width - 1
            first, last = np.maximum(first[part], anchor - far), np.minimum(last[part], anchor - near)
            at = shift[owner]
            prefixes = hashes.prefixes(data)
            # What all windows of the whole cell share, though this block may lack some of them.
            bucket = hashes.between(prefixes, at + anchor - near, at + anchor - far + passages.length)
            outer = digests(data, at + first, at + last + passages.length)
            keys = batch.column("text_key").take(pa.array(owner))
            yield blocks_batch(keys, batch.column("context").take(pa.array(owner)), anchor, first, last, bucket, *outer)
        del hashes
        give_memory_back()

    return contexts.mapInArrow(run, BLOCKS)


def places(blocks: DataFrame, *names: str) -> DataFrame:
    """The names that blocks at different places carry, with the least place. A place is a hash
    of text and position, so copies of a text are one place."""
    place = F.xxhash64("text_key", "first")
    return blocks.groupBy(*names).agg(F.min(place).alias("least"), F.max(place).alias("most")) \
        .filter("least <> most").drop("most")


def decided(blocks: DataFrame) -> DataFrame:
    """Blocks whose bucket holds others, with ``repeated``: whether all their windows recur.

    Of the blocks that recur whole, alike, one is the ``witness``: it stays to be met by others.
    """
    shared = stage(blocks.join(places(blocks, "bucket"), "bucket", "left_semi").select(*NAMES), "shared")
    whole = places(shared, "outer_1", "outer_2")
    return stage(shared.join(whole, ["outer_1", "outer_2"], "left").select(
        "text_key", "context", "anchor", "first", "last", "bucket",
        F.col("least").isNotNull().alias("repeated"),
        (F.col("least") == F.xxhash64("text_key", "first")).alias("witness")), "decided")


def open_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks to refine, by context: the undecided, and the witnesses in their buckets."""
    undecided = blocks.filter("NOT repeated")
    witnesses = blocks.filter("witness").join(undecided.select("bucket").distinct(), "bucket", "left_semi")
    return undecided.unionByName(witnesses.select(*undecided.columns)).groupBy("text_key", "context").agg(
        F.first("anchor").alias("anchor"), F.sort_array(F.collect_set(F.struct("first", "last"))).alias("blocks"))


def contexts_of(texts: DataFrame, undecided: DataFrame, passages: Passages) -> DataFrame:
    """The units, as bytes, of all windows of each undecided block of the first level."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, memo = set(), WordHashes()
        for batch in by_bytes(batches):
            for row in batch.to_pylist():
                if row["text_key"] in seen:
                    continue
                seen.add(row["text_key"])
                data, found = passages.units(row["text"], memo), row["found"]
                begin = [f["context"] for f in found]
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["text_key"]] * len(found), pa.binary()), pa.array(begin, pa.int32()),
                    pa.array([data[f["context"]:f["upto"] + passages.length].tobytes() for f in found], pa.binary()),
                ], names=["text_key", "context", "data"])
        del seen, memo
        give_memory_back()

    by_text = undecided.groupBy("text_key").agg(F.collect_list(
        F.struct("context", F.get("blocks", F.size("blocks") - 1)["last"].alias("upto"))).alias("found"))
    return texts.join(by_text, "text_key").mapInArrow(run, "text_key binary, context int, data binary") \
        .groupBy("text_key", "context").agg(F.first("data").alias("data"))


def repeated_windows(docs: DataFrame, passages: Passages) -> DataFrame:
    """text_key and spans: first and last of runs of windows that occur elsewhere.

    All windows of a text that several rows have are repeated; those rows are marked by
    ``copied`` and need no spans.
    """
    texts = keyed(docs, passages)
    found = [decided(stage(first_blocks(texts, passages), "blocks"))]
    undecided = stage(open_blocks(found[0]), "open")
    contexts = stage(contexts_of(texts, undecided, passages), "contexts")
    for width in passages.widths:
        blocks = stage(refined(contexts.join(undecided, ["text_key", "context"]), width, passages), "blocks")
        found.append(decided(blocks))
        undecided = open_blocks(found[-1])
    spans = reduce(DataFrame.union, found).filter("repeated").groupBy("text_key") \
        .agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    copied = texts.groupBy("text_key").agg((F.count("*") > 1).alias("copied")).filter("copied")
    return stage(spans.join(copied, "text_key", "full"), "spans")


def with_spans(docs: DataFrame, passages: Passages) -> DataFrame:
    """``docs`` as struct ``row`` with ``spans`` and ``copied`` of its text, NULL where it has none."""
    rows = docs.select(F.struct("*").alias("row")).withColumn("text_key", F.unhex(F.md5("row.text")))
    return rows.join(repeated_windows(docs, passages), "text_key", "left")


def removed(data: bytes, spans: list | None, copied: bool, passages: Passages) -> list[tuple[int, int]]:
    """Maximal runs of bytes to remove, from begin to end."""
    if spans is None and not copied:
        return []
    begins, ends = word_edges(data) if passages.words else (range(len(data)), range(1, len(data) + 1))
    if copied and len(begins) >= passages.length:
        return [(int(begins[0]), int(ends[-1]))]
    runs: list[tuple[int, int]] = []
    for begin, last in sorted((s["first"], s["last"]) for s in (() if spans is None else spans)):
        if runs and begin <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], last + passages.length))
        else:
            runs.append((begin, last + passages.length))
    return [(int(begins[a]), int(ends[b - 1])) for a, b in runs]


def kept_bytes(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    ends = [0, *(e for _, e in runs)]
    return b"".join(data[a:b] for a, b in zip(ends, [*(b for b, _ in runs), len(data)], strict=True))


def cut(text: Column, spans: Column, copied: Column, passages: Passages) -> Column:
    """n_bytes, n_removed, n_spans, kept (the bytes that remain) and n_kept (their whole characters) of a text."""

    def run(texts: pd.Series, spans: pd.Series, copied: pd.Series) -> pd.DataFrame:
        rows = []
        for t, s, c in zip(texts, spans, copied, strict=True):
            data = (t or "").encode()
            runs = removed(data, s, bool(c), passages)
            kept = kept_bytes(data, runs)
            rows.append((len(data), sum(b - a for a, b in runs), len(runs), kept, len(kept.decode("utf-8", "ignore"))))
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept", "n_kept"])

    schema = "n_bytes long, n_removed long, n_spans long, kept binary, n_kept long"
    return F.pandas_udf(run, schema)(text, spans, F.coalesce(copied, F.lit(False)))


def remove_repeats(docs: DataFrame, passages: Passages = BYTES) -> DataFrame:
    """All rows of ``docs`` as struct ``row``, with ``cut`` (see there).

    Every byte covered by a 400-byte string that also starts elsewhere goes, whether in another
    row, in the same one, or in a repeated row; strings are judged on the input. With ``WORDS``
    the strings are 51 words, whatever white space is between them. A NULL text is
    empty and loses nothing. Ids are not looked at; all input columns are kept in the struct.
    """
    found = cut(F.col("row.text"), F.col("spans"), F.col("copied"), passages)
    return with_spans(docs, passages).select("row", found.alias("cut"))


def readable(kept: Column) -> Column:
    """Bytes as text; a character of which only a part is left goes."""
    def run(data: pd.Series) -> pd.Series:
        return data.map(lambda b: bytes(b).decode("utf-8", "ignore"))

    return F.pandas_udf(run, "string")(kept)


def text_left() -> Column:
    """The text that ``remove_repeats`` leaves of a row; NULL stays NULL."""
    return F.when(F.col("row.text").isNotNull(), readable(F.col("cut.kept")))


def suffix_dedup_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document without its passages of over 50 words that repeat. A text that is left empty
    stays as an empty text, a NULL text as NULL; n_chars counts what is left."""
    # Words begin and end at whole characters, so what is left of them is text as it is. A function that made it
    # of what ``cut`` returns would need a second Python worker in every task, and executors keep their workers.
    left = F.when(F.col("row.text").isNotNull(), F.col("cut.kept").cast("string"))
    rows = remove_repeats(docs, WORDS).withColumn("text", left)
    fresh = {"text": F.col("text"), "n_chars": F.char_length("text")}
    fields = docs.schema.fields
    return rows.select(*[
        (fresh[f.name].cast(f.dataType) if f.name in fresh else F.col("row").getField(f.name)).alias(f.name)
        for f in fields])


def op3_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """What is left of all documents without strings of 400 bytes that occur again: its digest, its
    whole characters as text, and their number n_kept, as n_chars is that of a document. The sizes alone do
    not show what has gone."""
    return remove_repeats(documents(spark, sf_dir)).select(
        F.col("row.doc_id").alias("doc_id"), "cut.n_bytes", "cut.n_removed", "cut.n_spans",
        F.sha2("cut.kept", 256).alias("kept_sha256"), "cut.n_kept", text_left().alias("text"))
