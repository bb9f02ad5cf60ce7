"""Exact top-k search by BM25: an inverted index per shard, block-max WAND, one exact merge.

A shard holds the postings of some megabytes of text. Document counts and lengths are those of the
whole table, so scores of different shards compare and the shards' best merge exactly.

WAND skips a document when the upper bounds of its terms do not reach the threshold, the k-th
best score so far; block-max WAND takes the largest weight in the document's block as the bound.
Here a shard's cursors move together, as arrays, for many queries at a time. Terms in few of its
documents are read from their postings; for the frequent terms, whose postings are the bulk, the block
maxima of all blocks are added up instead. A document is a pivot if both together reach the
threshold. Pivots are scored in falling order of their bounds, each group raises the threshold
for the next, and the frequent postings of all others are never read.

The threshold rises from shard to shard within a task, and over rounds: a sample of the shards is
searched first, then eight times as many with the k-th best scores that it gave, and so on. So a
round finds a bounded number of documents for a query, however many shards there are.

Queries are handed to the shards in blocks of about ``QUERY_TERMS`` terms; a block is what the
driver and each executor hold at once.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.bpe import gather
from salesmart.llm.common import by_bytes, documents, give_memory_back
from salesmart.staging import stage

TOP = 10
K1, B = 1.2, 0.75
SHARD_BYTES = 16 << 20
BLOCK_DOCS = 2
#: A term in more than one of so many of a shard's documents is a frequent one.
FREQUENT = 64
#: Queries whose bounds are added up together, and pivots that are scored together at first.
TOGETHER, PIVOTS = 64, 32
#: Shards that are searched without thresholds of an earlier round, and the growth of the rounds.
FIRST_SHARDS, ROUND_GROWTH = 256, 8
QUERY_TERMS = 1_000_000
#: A search has so many tasks a core at most: each returns up to k documents for every query, so
#: with tasks by files their number would grow with the square of the input.
SEARCH_TASKS = 3
EVERY = 100


def terms_of(text: str | None) -> Counter:
    """Words by the word pattern, A to Z in lower case, with their counts."""
    return Counter((text or "").encode("utf-8", "surrogatepass").lower().split())


INDEX = ("draw double, doc_ids array<long>, lengths array<long>, terms array<binary>, counts array<long>, "
         "docs binary, tfs binary")


def build_index(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row for each shard: its documents, its sorted terms with their document counts, and
    the postings (place of the document, count in it) term after term. ``draw`` is a number from
    0 to 1 that its contents decide; it tells the round in which the shard is searched."""
    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text") \
        .mapInArrow(lambda batches: index_of(batches, shard_bytes), INDEX)


def index_of(batches: Iterable[pa.RecordBatch], shard_bytes: int) -> Iterator[pa.RecordBatch]:
    longs = pa.list_(pa.int64())
    schema = pa.schema([("draw", pa.float64()), ("doc_ids", longs), ("lengths", longs), ("terms", pa.list_(pa.binary())),
                        ("counts", longs), ("docs", pa.binary()), ("tfs", pa.binary())])

    def shard(ids: list, sizes: list, place: dict[bytes, int], found: list, tfs: list) -> pa.RecordBatch:
        terms = pa.array(list(place), pa.binary())
        in_order = pc.array_sort_indices(terms)
        rank = np.empty(len(terms), np.int32)
        rank[in_order.to_numpy()] = np.arange(len(terms), dtype=np.int32)
        which, counted = rank[np.concatenate(found)], np.concatenate(tfs)
        owner = np.repeat(np.arange(len(found), dtype=np.int32), [len(own) for own in found])
        order = np.argsort(which, kind="stable")
        draw = zlib.crc32(np.array([-1 if i is None else i for i in ids], np.int64).tobytes()) / 2**32
        values = (pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), terms.take(in_order),
                  pa.array(np.bincount(which, minlength=len(terms)), pa.int64()))
        lists = [pa.ListArray.from_arrays([0, len(v)], v) for v in values]
        bulk = [pa.array([a[order].tobytes()], pa.binary()) for a in (owner, counted)]
        return pa.RecordBatch.from_arrays([pa.array([draw]), *lists, *bulk], schema=schema)

    # Terms are numbered as they come and a document is two small arrays: as dictionaries, the
    # documents of a shard would take many times its text.
    held: tuple[list, list, dict, list, list] = ([], [], {}, [], [])
    size = 0
    for batch in by_bytes(batches, limit=min(1 << 20, shard_bytes)):
        for doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
            found, place = terms_of(text), held[2]
            numbers = np.fromiter((place.setdefault(t, len(place)) for t in found), np.int32, len(found))
            tfs = np.fromiter(found.values(), np.int32, len(found))
            for column, value in zip((held[0], held[1], *held[3:]), (doc_id, sum(found.values()), numbers, tfs), strict=True):
                column.append(value)
            size += len(text or "")
        if size >= shard_bytes:
            yield shard(*held)
            held, size = ([], [], {}, [], []), 0
    if held[0]:
        yield shard(*held)
    del held
    give_memory_back()


class Shard:
    def __init__(self, row: pa.RecordBatch, mean_length: float):
        values = {c: row.column(c)[0] for c in row.schema.names}
        ids = values["doc_ids"].values
        self.doc_ids, self.null_id = pc.fill_null(ids, -1).to_numpy(), pc.is_null(ids).to_numpy(zero_copy_only=False)
        self.terms = values["terms"].values
        size, terms = len(self.doc_ids), len(self.terms)
        docs = np.frombuffer(values["docs"].as_buffer(), np.int32)
        tfs = np.frombuffer(values["tfs"].as_buffer(), np.int32).astype(float)
        norm = K1 * (1 - B + B * values["lengths"].values.to_numpy() / mean_length)
        weight = tfs * (K1 + 1) / (tfs + norm[docs])
        counts = values["counts"].values.to_numpy()
        term = np.repeat(np.arange(terms, dtype=np.int32), counts)
        # Document after document, for scores; a document's terms are in their order.
        order = np.argsort(docs.astype(np.uint16) if size <= 1 << 16 else docs, kind="stable")
        self.doc_term, self.doc_weight = term[order], weight[order]
        self.doc_size = np.bincount(docs, minlength=size)
        self.doc_start = np.cumsum(self.doc_size) - self.doc_size
        self.query = np.zeros(terms)  # the weights of one query's terms at a time
        # Term after term, for the rare ones.
        self.docs, self.weight = docs, weight
        self.count, self.start = counts, np.cumsum(counts) - counts
        # Block maxima of the frequent ones: a row for each term, a column for each block.
        frequent = np.flatnonzero(counts * FREQUENT > size)
        self.row = np.full(terms, -1, np.int32)
        self.row[frequent] = np.arange(len(frequent), dtype=np.int32)
        self.blocks = -(-size // BLOCK_DOCS)
        most = np.zeros(len(frequent) * self.blocks, np.float32)
        at = gather(self.start[frequent], counts[frequent])
        np.maximum.at(most, self.row[term[at]].astype(np.int64) * self.blocks + docs[at] // BLOCK_DOCS,
                      weight[at].astype(np.float32))
        self.most = most.reshape(len(frequent), self.blocks)
        # A sum of m positive 32-bit products is at most m + 4 roundings too small.
        self.slack = 1 + (len(frequent) + 8) * 2.0**-23

    def bounds(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """For each query, given by places and weights of terms, sums of block maxima by block."""
        weights = np.zeros((len(queries), len(self.most)), np.float32)
        for k, (places, weight) in enumerate(queries):
            rows = self.row[places]
            weights[k, rows[rows >= 0]] = weight[rows >= 0]
        return (weights @ self.most) * np.float32(self.slack)

    def search(self, places: np.ndarray, weights: np.ndarray, bound: np.ndarray, best: Best) -> None:
        """Put the documents that belong to the query's best into ``best``."""
        rare = self.row[places] < 0
        sizes = self.count[places[rare]]
        postings = gather(self.start[places[rare]], sizes)
        most = np.bincount(self.docs[postings], np.repeat(weights[rare], sizes) * self.weight[postings], len(self.doc_ids))
        most = most + np.repeat(bound, BLOCK_DOCS)[:len(most)]
        # Scores add in another order than bounds.
        most = most * (1 + 1e-6)
        pivots = np.flatnonzero((most >= best.threshold) & (most > 0) & (self.doc_size > 0))
        pivots = pivots[np.argsort(-most[pivots], kind="stable")]
        together = PIVOTS
        self.query[places] = weights
        while len(pivots):
            some, pivots = pivots[:together], pivots[together:]
            at = gather(self.doc_start[some], self.doc_size[some])
            ends = np.cumsum(self.doc_size[some])
            scores = np.add.reduceat(self.query[self.doc_term[at]] * self.doc_weight[at], ends - self.doc_size[some])
            best.add(scores, self.doc_ids[some], self.null_id[some])
            # Bounds fall, so those that reach the new threshold come first.
            pivots = pivots[:np.count_nonzero(most[pivots] >= best.threshold)]
            together *= 4
        self.query[places] = 0.0


class Best:
    """The k best documents of a query so far; equal scores are ranked by id, NULL first."""

    def __init__(self, k: int, threshold: float = 0.0):
        self.k, self.threshold = k, threshold
        self.scores, self.ids, self.null = np.zeros(0), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        wanted = (scores >= self.threshold) & (scores > 0)
        scores, ids, null = (np.concatenate([a, b[wanted]])
                             for a, b in ((self.scores, scores), (self.ids, ids), (self.null, null)))
        order = np.lexsort((ids, ~null, -scores))[:self.k]
        self.scores, self.ids, self.null = scores[order], ids[order], null[order]
        if len(order) == self.k:
            self.threshold = max(self.threshold, float(self.scores[-1]))


def query_terms(queries: DataFrame) -> DataFrame:
    """query_id, query (a key of id and text), term and its count, for all different queries."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, limit=1 << 20):
            rows = [(i, q, t, n) for i, q, text in zip(*(batch.column(c).to_pylist() for c in names), strict=True)
                    for t, n in sorted(terms_of(text).items())]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                    names=["query_id", "query", "term", "n"])

    names, types = ("query_id", "query", "text"), (pa.int64(), pa.int64(), pa.binary(), pa.int64())
    keyed = queries.select(F.col("doc_id").cast("long").alias("query_id"),
                           F.xxhash64("doc_id", "text").alias("query"), "text")
    return keyed.mapInArrow(run, "query_id long, query long, term binary, n long").distinct()


def search(
    docs: DataFrame, queries: DataFrame, k: int = TOP, shard_bytes: int = SHARD_BYTES, first_shards: int = FIRST_SHARDS
) -> DataFrame:
    """query_id, rank (from 1), doc_id and score of the k best documents for each query.

    ``docs`` and ``queries`` have doc_id and text; a query is a whole text, each word as often as
    it occurs. Equal scores are ranked by doc_id, NULL first; documents that share no word with
    the query are not found. Queries that repeat id and text count once; texts without words, or
    NULL, find nothing and are not found. A very long text is one document, in a shard of about its
    size. Empty tables find nothing. Other columns are not read. ``shard_bytes`` and
    ``first_shards`` change the work, never the result.
    """
    spark = docs.sparkSession
    # A shard is a row of some 20 MB. Spark writes the rows of a file, and reads up to 4,096 of them, at
    # once, so the memory of a task would grow with the shards in its file: each is a file of its own.
    index = stage(build_index(docs, shard_bytes), "index", rows_a_file=1)
    total = index.select(F.size("doc_ids").alias("n"), F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("length")) \
        .agg(F.sum("n"), F.sum("length")).first()
    rows, mean_length = total[0] or 0, (total[1] or 0) / max(1, total[0] or 0) or 1.0
    terms = stage(query_terms(queries), "query-terms")
    counts = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")) \
        .groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.counts").alias("df"))
    idf = F.log(1 + (F.lit(rows) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    blocks = max(1, -(-terms.count() // QUERY_TERMS))
    weighted = stage(terms.join(counts, "term").groupBy("query_id", "query").agg(
        F.sort_array(F.collect_list(F.struct("term", (idf * F.col("n")).alias("weight")))).alias("terms"))
        .withColumn("block", F.pmod("query", F.lit(blocks))), "queries")
    rounds = rounds_of(index.count(), first_shards)
    tasks, found = SEARCH_TASKS * spark.sparkContext.defaultParallelism, None
    for block in range(blocks):
        part = QueryBlock(weighted.filter(F.col("block") == block).select("query_id", "query", "terms").toArrow())
        best = None
        for low, high in rounds:
            if best is not None:
                part.raise_to(best.filter(F.col("rank") == k).select("query_id", "query", "score").toArrow())
            held = spark.sparkContext.broadcast(part)
            shards = index.filter((F.col("draw") >= low) & (F.col("draw") < high)).coalesce(tasks)
            hits = stage(shards.mapInArrow(searcher(held, mean_length, k), HITS), "hits")
            held.destroy()
            found = hits if found is None else found.union(hits)
            best = best_of(hits if best is None else best.drop("rank").union(hits), k)
    return best_of(found, k).select("query_id", "rank", "doc_id", "score")


HITS = "query_id long, query long, doc_id long, score double"


def best_of(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def rounds_of(shards: int, first: int) -> list[tuple[float, float]]:
    """Ranges of draws: about ``first`` shards or fewer, then ``ROUND_GROWTH`` times as many, to all."""
    cuts = [1.0]
    while shards * cuts[0] > first:
        cuts.insert(0, cuts[0] / ROUND_GROWTH)
    return list(zip([0.0, *cuts], cuts, strict=False))


class QueryBlock:
    """Queries as arrays: their different terms, and for each query places among these and weights."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        lists = pa.concat_arrays(table.column("terms").chunks) if table.num_rows else pa.array([], table.schema.field("terms").type)
        self.ends = lists.offsets.to_numpy()
        terms, weights = lists.values.flatten()
        encoded = pc.dictionary_encode(terms)
        self.terms, self.places = encoded.dictionary, encoded.indices.to_numpy()
        self.weights = weights.to_numpy()
        self.query_id, self.query = table.column("query_id").to_pylist(), table.column("query").to_numpy()
        self.thresholds = np.zeros(len(self.query))

    def raise_to(self, reached: pa.Table) -> None:
        """Take the k-th best score of an earlier round as each query's threshold."""
        score = {(i, q): s for i, q, s in zip(*(c.to_pylist() for c in reached.columns), strict=True)}
        keys = zip(self.query_id, self.query.tolist(), strict=True)
        self.thresholds = np.array([score.get(key, 0.0) for key in keys])

    def inside(self, shard: Shard, k: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the shard and weights of the terms of query ``k`` that the shard has."""
        begin, end = self.ends[k], self.ends[k + 1]
        found = places[self.places[begin:end]]
        return found[found >= 0], self.weights[begin:end][found >= 0]


def searcher(held, mean_length: float, k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = held.value
        best = [Best(k, t) for t in queries.thresholds.tolist()]
        for batch in batches:
            for at in range(batch.num_rows):
                if not len(batch.column("terms")[at]):
                    continue
                shard = Shard(batch.slice(at, 1), mean_length)
                places = pc.fill_null(pc.index_in(queries.terms, value_set=shard.terms), -1).to_numpy()
                for first in range(0, len(best), TOGETHER):
                    some = range(first, min(first + TOGETHER, len(best)))
                    inside = [queries.inside(shard, q, places) for q in some]
                    for q, mine, bound in zip(some, inside, shard.bounds(inside), strict=True):
                        shard.search(*mine, bound, best[q])
                del shard
        ids: list[list] = [[], [], [], []]
        for query_id, query, one in zip(queries.query_id, queries.query.tolist(), best, strict=True):
            ids[0] += [query_id] * len(one.ids)
            ids[1] += [query] * len(one.ids)
            ids[2] += [None if n else i for i, n in zip(one.ids.tolist(), one.null.tolist(), strict=True)]
            ids[3] += one.scores.tolist()
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in ids[:3]), pa.array(ids[3], pa.float64())],
            names=["query_id", "query", "doc_id", "score"])
        give_memory_back()

    return run


def op4_search(spark, sf_dir: str) -> DataFrame:
    """The ten best documents for every document whose id is divisible by 100."""
    docs = documents(spark, sf_dir)
    return search(docs, docs.filter(F.col("doc_id") % EVERY == 0))
