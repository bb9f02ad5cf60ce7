"""Token-id files: every document compressed on its own with a shared zstandard dictionary.

A file is a sequence of blocks, a block a Parquet row: the documents' ids as little-endian
integers, each compressed alone, one after the other in ``payload``; ``ends`` is the offset
index into it. ``dictionary`` names the dictionary by its hash, and the dictionary itself lies
beside the blocks. To read one short document, only its block's index and its own frame are
decoded. Blocks ascend by doc_id in and across files; ``part`` and ``ids_before`` say where a
block's ids begin.

The dictionary is trained on about ``DICTIONARY_ROWS`` documents spread over the table, of which
those of at most ``DICTIONARY_TEXT`` bytes are used; it changes the size of the files, never what they hold.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from salesmart.llm.bpe import LETTER, NUMBER, SPACE, ByteBpe, Splitter, byte_characters
from salesmart.llm.common import by_bytes, crc32_of_ids, documents
from salesmart.staging import scratch_path

END_ID = 1
DICTIONARY_ROWS = 1000
DICTIONARY_TEXT = 16 << 10
DICTIONARY_BYTES = 32 << 10
BLOCK_BYTES = 1 << 20
LEVEL = 3

# ---- Fixed values: the split pattern of the vocabulary file, for words already normalised ----
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN_WORD_PATTERN = f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^{SPACE}{LETTER}{NUMBER}]+"


class WordIds(ByteBpe):
    """Ids as the tokenizers library gives them, of a vocabulary file with word ends.

    Words are cut out as the file's normaliser and splitter do and merged in numpy rounds, the
    last byte of each being a symbol of its own. Texts with characters that this Python's
    Unicode does not know, and texts with a special token's string, go to the library whole.
    """

    def __init__(self, path: str):
        super().__init__(path)
        vocab = self.library.get_vocab()
        self.end_ids = np.array([vocab[c + "</w>"] for c in byte_characters()], np.int64)
        self.splitter = Splitter(WORD_PATTERN, LATIN_WORD_PATTERN)

    def symbols(self, words: list[bytes]) -> np.ndarray:
        found, data = super().symbols(words), np.frombuffer(b"".join(words), np.uint8)
        last = np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) - 1
        found[last] = self.end_ids[data[last]]
        return found

    def words(self, text: str) -> list[str]:
        # Character by character, capital sigma is never a final one, unlike in str.lower().
        text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()
        return self.splitter.matches(text)

    def encode_each(self, texts: list[str]) -> list[np.ndarray]:
        whole = {k: self.library.encode(t, add_special_tokens=False).ids for k, t in enumerate(texts)
                 if any(s in t for s in self.special) or self.splitter.odd(t)}
        table = self.encode(["" if k in whole else t for k, t in enumerate(texts)])
        return [np.array(whole[k], np.int64) if k in whole else table.flat[a:a + n]
                for k, (a, n) in enumerate(zip(table.starts, table.lengths, strict=True))]


@lru_cache(maxsize=1)
def encoder_of(path: str) -> WordIds:
    """One encoder for each Python worker, which goes on to the next task with what it remembers."""
    return WordIds(path)


def serialized(ids: np.ndarray, width: int) -> bytes:
    return ids.astype(f"<u{width}").tobytes()


def codec(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def train_dictionary(docs: DataFrame, path: str, width: int, end_id: int) -> bytes:
    """A dictionary from the id arrays of sampled short documents; empty if there are too few."""
    rows = docs.count()  # from the files' footers, without reading a text
    sample = docs.select("text").sample(fraction=min(1.0, DICTIONARY_ROWS / max(1, rows)), seed=7)
    short = sample.filter(F.octet_length("text").between(1, DICTIONARY_TEXT))
    texts = [r["text"] for r in short.limit(2 * DICTIONARY_ROWS).collect()]
    if len(texts) < 20:
        return b""
    samples = [serialized(np.append(ids, end_id), width) for ids in encoder_of(path).encode_each(texts)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # the samples are too small or too alike to train on
        return b""


BLOCKS = ("part int, block int, ids_before long, dictionary string, width int, "
          "doc_ids array<long>, n_tokens array<long>, ends array<long>, payload binary")


def write_ids(docs: DataFrame, path: str, target: str, end_id: int = END_ID) -> None:
    """Write the ids of all documents, in ascending doc_id order, to the folder ``target``.

    A NULL text counts as empty and has the end id alone. A NULL doc_id comes first; documents
    that share a doc_id follow each other. Other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text")
    width = 2 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else 4
    dictionary = train_dictionary(docs, path, width, end_id)
    name = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(name, dictionary)], "dictionary string, content binary").coalesce(1) \
        .write.parquet(f"{target}/dictionary")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder = TaskContext.get().partitionId(), encoder_of(path)
        compressor = zstandard.ZstdCompressor(level=LEVEL, **codec(dictionary))
        written, number = 0, 0
        for batch in by_bytes(batches, limit=BLOCK_BYTES):
            arrays = [np.append(ids, end_id)
                      for ids in encoder.encode_each([t or "" for t in batch.column("text").to_pylist()])]
            frames = [compressor.compress(serialized(ids, width)) for ids in arrays]
            sizes = [len(ids) for ids in arrays]
            yield pa.RecordBatch.from_pylist([{
                "part": part, "block": number, "ids_before": written, "dictionary": name,
                "width": width, "doc_ids": batch.column("doc_id").to_pylist(), "n_tokens": sizes,
                "ends": np.cumsum(list(map(len, frames))).tolist(), "payload": b"".join(frames),
            }], schema=arrow_schema)
            written, number = written + sum(sizes), number + 1

    longs = pa.list_(pa.int64())
    arrow_schema = pa.schema([
        ("part", pa.int32()), ("block", pa.int32()), ("ids_before", pa.int64()),
        ("dictionary", pa.string()), ("width", pa.int32()), ("doc_ids", longs),
        ("n_tokens", longs), ("ends", longs), ("payload", pa.binary())])
    # The row number lets a doc_id that many rows share fall into several ranges.
    ordered = docs.withColumn("row", F.monotonically_increasing_id()) \
        .repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")
    ordered.select("doc_id", "text").mapInArrow(run, BLOCKS).write \
        .option("compression", "none").parquet(f"{target}/blocks")


def dictionary_of(spark: SparkSession, target: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{target}/dictionary").first()
    return row["dictionary"], bytes(row["content"])


def ids_of_document(spark: SparkSession, target: str, doc_id: int) -> list[list[int]]:
    """The ids of one document (of each with that id), decoding no other frame."""
    name, dictionary = dictionary_of(spark, target)
    decompressor = zstandard.ZstdDecompressor(**codec(dictionary))
    found = spark.read.parquet(f"{target}/blocks") \
        .filter(F.array_contains("doc_ids", F.lit(doc_id).cast("long"))).orderBy("part", "block")
    result = []
    for block in found.toLocalIterator():
        if block["dictionary"] != name:
            raise ValueError("the block was written with another dictionary")
        for k, owner in enumerate(block["doc_ids"]):
            if owner == doc_id:
                begin = block["ends"][k - 1] if k else 0
                frame = bytes(block["payload"][begin:block["ends"][k]])
                result.append(np.frombuffer(decompressor.decompress(frame), f"<u{block['width']}").tolist())
    return result


def read_ids(spark: SparkSession, target: str, with_ids: bool = True) -> DataFrame:
    """Every document in the files: doc_id, start (ids of all before it), n_tokens, ids_crc32,
    and the ids themselves unless ``with_ids`` is false."""
    name, dictionary = dictionary_of(spark, target)
    columns = ["doc_id", "part", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = zstandard.ZstdDecompressor(**codec(dictionary))
        for batch in batches:
            for k in range(batch.num_rows):
                block = {c: batch.column(c)[k] for c in batch.schema.names}
                if block["dictionary"].as_py() != name:
                    raise ValueError("the block was written with another dictionary")
                payload, width = block["payload"].as_py(), block["width"].as_py()
                ends = block["ends"].as_py()
                frames = [payload[a:b] for a, b in zip([0, *ends], ends, strict=False)]
                ids = [np.frombuffer(decompressor.decompress(f), f"<u{width}") for f in frames]
                sizes = np.array(list(map(len, ids)), np.int64)
                values = [
                    pa.array(block["doc_ids"].as_py(), pa.int64()),
                    pa.array(np.full(len(ids), block["part"].as_py()), pa.int32()),
                    pa.array(block["ids_before"].as_py() + np.cumsum(sizes) - sizes),
                    pa.array(sizes), pa.array([crc32_of_ids(i) for i in ids], pa.int64()),
                ]
                if with_ids:
                    values.append(pa.array([i.astype(np.int64) for i in ids], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(values, names=columns)

    schema = "doc_id long, part int, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    blocks = spark.read.parquet(f"{target}/blocks")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file part, so this window is small.
    parts = blocks.groupBy("part").agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, n: a + n)).alias("ids")) \
        .select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("part_start"))
    return blocks.mapInArrow(run, schema).join(parts, "part") \
        .withColumn("start", F.col("start") + F.col("part_start")).drop("part", "part_start")


def op7_token_files(spark, sf_dir: str) -> DataFrame:
    """All documents written to token-id files and read back."""
    target = scratch_path(spark, "token-files")
    write_ids(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), target)
    return read_ids(spark, target, with_ids=False)
