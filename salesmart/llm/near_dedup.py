"""MinHash near-duplicates by a chosen-path set similarity join.

Documents with equal shingle sets are one class. Every class walks down ``TREES`` trees. At the
root of a tree it goes to the node of its least shingle under the tree's hash. A node of at most
``SMALL`` classes compares all its pairs. In a larger node all classes are compared with a few
of them, the pivots, and then branch: the node chooses ``BRANCHES`` times ``TOKENS`` of the ``PATH``
minwise bytes of its tree, and each class goes to the children named by its values there. Pairs of
similarity 0.75 and less meet in less than one child (3 * 0.75^4 < 1), so they thin out; pairs of
0.8 and more meet in more than one (3 * 0.8^4 > 1.2).

Each level has two passes. The first compares by size and sketch (``AGREE`` of ``SKETCH`` bytes)
and confirms, on the texts, each class's nearest in each node and all pairs with pivots; their
links colour the classes by component. The second decides all that is left: nodes in which all
but ``MINORITY`` classes have one colour. Classes with a candidate of another colour there bring
their full set of shingle hashes, once for each node, and the task counts all intersections with
the few. Only links that join two colours leave it, so what leaves is never more than what came,
however many pairs a group has; they too are confirmed on the texts. A node's one-coloured rows
are dealt out in buckets, each with a copy of the few. Other nodes branch. A task holds the sets
of ``MINORITY`` classes at most.

Recall: a tree's root keeps a pair of similarity j together with probability j. Below it, a pair
whose paths agree in k of ``PATH`` bytes stays together with s = 1 - (1 - (k / PATH)^4 s)^3, level
by level, if its nodes stay large. All levels of a tree share its path, so s is averaged over the
binomial k; trees share nothing, so ten of them miss a pair with (1 - j s)^10. That finds a pair
of 0.8 with 0.9989 after 3 levels, 0.9971 after 5 and 0.9939 after 10; of 0.85 after 10 with
0.9999; a pair whose nodes are small after the root with 1 - 0.2^10 at least. The sketch rejects a pair of 0.8
with about 5e-6. Nodes left after ``LEVELS`` levels are finished exactly, pivot by pivot.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.bpe import gather
from salesmart.llm.common import by_bytes, documents, give_memory_back
from salesmart.llm.components import components
from salesmart.staging import drop, let_shuffles_go, scratch_scope, stage

TREES = 10
SKETCH = 32
#: Minwise bytes of each tree by which it branches, apart from the sketch and from other trees.
PATH = 32
AGREE = 15
SMALL = 256
MINORITY = 256
BUCKET = 4096
PIVOTS = 3
BRANCHES = 3
TOKENS = 4
LEVELS = 10
PERCENT = 80
MEMO_WORDS = 300_000
MARKS = 1 << 19
BLOCK_ROWS = 64
BLOCK_HASHES = 20_000
#: Text of either side of the pairs that are confirmed at once.
CONFIRM_BYTES = 1 << 20

MASK = (1 << 64) - 1


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def mixed(values: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread, wrapping around."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def words_in(text: str | None) -> list[bytes]:
    """Words by the pattern, A to Z in lower case (bytes methods leave all else alone)."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], size: int, memo: WordHashes) -> np.ndarray:
    """Sorted different hashes of the word shingles; the whole sequence if there are fewer words."""
    hashes = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    total = np.zeros(len(words) - size + 1 if words else 0, np.uint64)
    for k in range(size):
        total = mixed(total + hashes[k:len(words) - size + 1 + k] + np.uint64(k + size))
    return np.unique(total)


def shingles(text: str | None, size: int) -> set[tuple[bytes, ...]]:
    words = words_in(text)
    size = min(size, len(words))
    return set(zip(*(words[k:] for k in range(size)), strict=False)) if words else set()


def describe(docs: DataFrame, size: int) -> DataFrame:
    """One row for each document: keys of the row and of its text, n_shingles, a key of its set,
    one minwise token for each tree, the sketch, and the trees' paths one after the other; the last
    four NULL without words."""

    seeds = [np.uint64(xxhash.xxh3_64_intdigest(f"minwise {k}")) for k in range(TREES + SKETCH)]
    # The hashes are well spread already; for the many path bytes a product with an odd number does.
    odd = [np.uint64(xxhash.xxh3_64_intdigest(f"path {k}") | 1) for k in range(TREES * PATH)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in by_bytes(batches, limit=1 << 20):
            if len(memo) > MEMO_WORDS:
                memo.clear()
            sets = [shingle_hashes(words_in(t), size, memo) for t in batch.column("text").to_pylist()]
            sizes = np.array(list(map(len, sets)), np.int64)
            some = np.flatnonzero(sizes)
            flat = np.concatenate([sets[k] for k in some]) if len(some) else np.zeros(0, np.uint64)
            starts = np.cumsum(sizes[some]) - sizes[some]
            least = [np.minimum.reduceat(mixed(flat ^ s), starts) if len(some) else flat for s in seeds]
            product = np.empty_like(flat)
            tokens, sketch, paths = [None] * len(sets), [None] * len(sets), [None] * len(sets)
            if len(some):
                all_tokens = np.stack(least[:TREES], 1).view(np.int64)
                all_bytes = (np.stack(least[TREES:], 1) >> np.uint64(20)).astype(np.uint8)
                all_paths = np.stack([
                    (np.minimum.reduceat(np.multiply(flat, m, out=product), starts) >> np.uint64(20)).astype(np.uint8)
                    for m in odd], 1)
                for k, t, b, p in zip(some, all_tokens, all_bytes, all_paths, strict=True):
                    tokens[k], sketch[k], paths[k] = t, b.tobytes(), p.tobytes()
            keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("row_key"), batch.column("text_key"),
                pa.array(sizes), pa.array(keys, pa.binary()),
                pa.array(tokens, pa.list_(pa.int64())), pa.array(sketch, pa.binary()), pa.array(paths, pa.binary()),
            ], names=["doc_id", "row_key", "text_key", "n_shingles", "set_key", "tokens", "sketch", "paths"])
        del memo
        give_memory_back()

    return keyed(docs).mapInArrow(
        run, "doc_id long, row_key long, text_key long, n_shingles long, set_key binary, "
             "tokens array<long>, sketch binary, paths binary")


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id and text with two hashes that together tell rows with different ones apart."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.xxhash64("doc_id", "text").alias("row_key"), F.xxhash64(F.lit(1), "text").alias("text_key"))


def sizes_allow(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(a, b) >= PERCENT * np.maximum(a, b)


def sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SKETCH)


PAIRS = "a long, b long"
CANDIDATES = "a long, b long, agree long"
LARGE = f"node_size > {SMALL}"
BRANCHING = f"node_size - dominant_size > {MINORITY}"


def candidates(a: np.ndarray, b: np.ndarray, one: np.ndarray, two: np.ndarray) -> pa.RecordBatch:
    """Pairs whose sketches agree enough, each once."""
    agree = (one == two).sum(1)
    rows = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b), agree], 1)[agree >= AGREE], axis=0)
    return pa.RecordBatch.from_arrays([pa.array(rows[:, k], pa.int64()) for k in range(3)], names=["a", "b", "agree"])


def nearest_in_small_nodes(live: DataFrame) -> DataFrame:
    """The classes of small nodes that have a candidate there (a), each with its nearest (b).

    Rows of a node lie together, so its pairs are rows at a distance of 1 to SMALL - 1; the last
    rows of a batch are kept for the next, and may then be named once more.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "class", "color", "n_shingles")]
            rows.append(sketches(batch.column("sketch")))
            old = 0
            if tail is not None:
                old = len(tail[0])
                rows = [np.concatenate([t, r]) for t, r in zip(tail, rows, strict=True)]
            node, member, color, size, sketch = rows
            found = [np.zeros((3, 0), np.int64)]
            for gap in range(1, SMALL):
                second = np.arange(max(old, gap), len(node))
                first = second - gap
                near = node[first] == node[second]
                if not near.any():
                    break
                near &= (color[first] != color[second]) & sizes_allow(size[first], size[second])
                first, second = first[near], second[near]
                agree = (sketch[first] == sketch[second]).sum(1)
                found.append(np.stack([first, second, agree])[:, agree >= AGREE])
            one, two, agree = np.concatenate(found, 1)
            one, two, agree = np.append(one, two), np.append(two, one), np.append(agree, agree)
            order = np.lexsort((member[two], -agree, one))
            one, two, agree = one[order], two[order], agree[order]
            best = np.flatnonzero(np.diff(one, prepend=-1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (node[one[best]], member[one[best]], member[two[best]], agree[best])],
                names=["node", "a", "b", "agree"])
            tail = [r[-(SMALL - 1):] for r in rows]

    small = live.filter(~F.expr(LARGE)).select("node", "class", "color", "n_shingles", "sketch")
    return small.repartition("node").sortWithinPartitions("node") \
        .mapInArrow(run, "node long, a long, b long, agree long")


def pairs_with_pivots(live: DataFrame) -> DataFrame:
    """Candidates of each large node's classes with its pivots, whose sketches every row has."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                faced = batch.column("faced")
                pivot, n, sketch = faced.flatten().flatten()
                row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(faced).to_numpy())
                a, m = (batch.column(c).to_numpy(zero_copy_only=False)[row] for c in ("class", "n_shingles"))
                b = pivot.to_numpy(zero_copy_only=False)
                close = sizes_allow(m, n.to_numpy(zero_copy_only=False)) & (a != b)
                yield candidates(a[close], b[close], sketches(batch.column("sketch"))[row[close]],
                                 sketches(sketch)[close])

    return live.filter(LARGE).select("class", "n_shingles", "sketch", "faced").mapInArrow(run, CANDIDATES)


def with_faced(nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """Large nodes with their pivots' sizes and sketches: a few rows for each node are joined, and
    the node's own rows get them when they meet what else is known of it."""
    pivots = classes.select(F.col("class").alias("pivot"), "n_shingles", "sketch")
    faced = nodes.filter(LARGE).select("node", F.explode("pivots").alias("pivot")).join(pivots, "pivot") \
        .groupBy("node").agg(F.collect_list(F.struct("pivot", "n_shingles", "sketch")).alias("faced"))
    return nodes.join(faced, "node", "left")


def facing(live: DataFrame, *columns: str) -> DataFrame:
    """The rows of nodes that need not branch, in buckets. The few rows that are not of the
    dominant colour (``few``) are in all buckets of their node, the others in one."""
    closed = live.filter(~F.expr(BRANCHING))
    buckets = F.ceil(F.col("node_size") / BUCKET).cast("int")
    few = F.col("color") != F.col("dominant")
    every = F.sequence(F.lit(0), buckets - 1)
    one = F.array(F.pmod(F.xxhash64("class"), buckets).cast("int"))
    return closed.select("node", F.explode(F.when(few, every).otherwise(one)).alias("bucket"),
                         few.alias("few"), "class", "color", *columns)


def together(rows: DataFrame) -> DataFrame:
    """Rows of a node and bucket in one task and one after the other, the few first."""
    return rows.repartition("node", "bucket").sortWithinPartitions("node", "bucket", F.desc("few"))


def runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], bool, int, int]]:
    """Key (node, bucket), whether they are the few, and the bounds of each run of rows."""
    node, bucket, few = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "bucket", "few"))
    changes = (np.diff(node) != 0) | (np.diff(bucket) != 0) | (few[1:] != few[:-1])
    cuts = [0, *(np.flatnonzero(changes) + 1), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:], strict=False):
        if begin < end:
            yield (node[begin], bucket[begin]), bool(few[begin]), begin, end


CONTESTED = "node long, bucket int, few boolean, class long, color long"


def contested(rows: DataFrame) -> DataFrame:
    """Of ``facing`` rows with sketches, those with a candidate of another colour beside them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        kept: list[tuple] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            color, size = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("color", "n_shingles"))
            member, sketch = batch.column("class").to_numpy(), sketches(batch.column("sketch"))
            for key, few, begin, end in runs(batch):
                part = [c[begin:end] for c in (member, color, size, sketch)]
                if held is None or held[0] != key:
                    held = (key, [p[:0] for p in part], np.zeros(0, bool))
                if few:
                    held = (key, [np.concatenate(c) for c in zip(held[1], part, strict=True)],
                            np.append(held[2], np.zeros(end - begin, bool)))
                _, (few_member, few_color, few_size, few_sketch), seen = held
                met = np.zeros(end - begin, bool)
                for at in range(0, end - begin, BLOCK_ROWS):
                    cut = slice(at, at + BLOCK_ROWS)
                    near = (part[1][cut, None] != few_color) & sizes_allow(part[2][cut, None], few_size)
                    near &= (part[3][cut, None] == few_sketch).sum(2) >= AGREE
                    met[cut] = near.any(1)
                    for k in np.flatnonzero(near.any(0) & ~seen):
                        seen[k] = True
                        kept.append((*key, True, few_member[k], few_color[k]))
                if not few:
                    kept += [(*key, False, part[0][k], part[1][k]) for k in np.flatnonzero(met)]
            yield batch_of(kept)
            kept = []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 5
        types = (pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                          names=["node", "bucket", "few", "class", "color"])

    return together(rows).mapInArrow(run, CONTESTED)


class Few:
    """The few classes of a node, with an index of their shingles and the colours united so far."""

    def __init__(self):
        self.member, self.color = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.sets: list[np.ndarray] = []
        self.root: dict[int, int] = {}

    def add(self, member: np.ndarray, color: np.ndarray, sets: list[np.ndarray]) -> None:
        self.member, self.color = np.append(self.member, member), np.append(self.color, color)
        self.sets += sets
        self.size = np.array(list(map(len, self.sets)))
        flat, owner = np.concatenate(self.sets), np.repeat(np.arange(len(self.sets)), self.size)
        order = np.argsort(flat, kind="stable")
        self.owner = owner[order]
        self.hashes, self.starts, self.counts = np.unique(flat[order], return_index=True, return_counts=True)

    def find(self, color: int) -> int:
        while (above := self.root.get(color, color)) != color:
            color = above
        return color

    def common(self, sets: list[np.ndarray]) -> np.ndarray:
        """Sizes of the intersections of each set with each of the few."""
        flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), list(map(len, sets)))
        counted = np.zeros(len(sets) * len(self.sets), np.int64)
        for at in range(0, len(flat), BLOCK_HASHES):
            hashes = flat[at:at + BLOCK_HASHES]
            place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            hit = self.hashes[place] == hashes
            place, rows = place[hit], row[at:at + BLOCK_HASHES][hit]
            owner = self.owner[gather(self.starts[place], self.counts[place])]
            counted += np.bincount(np.repeat(rows, self.counts[place]) * len(self.sets) + owner, minlength=len(counted))
        return counted.reshape(len(sets), -1)

    def links(self, member: np.ndarray, color: np.ndarray, sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
        """Links of the classes with the few, as many as it takes to unite their colours."""
        for at in range(0, len(sets) if self.sets else 0, BLOCK_ROWS):
            cut = slice(at, at + BLOCK_ROWS)
            common = self.common(sets[cut])
            total = np.array(list(map(len, sets[cut])))[:, None] + self.size - common
            alike = (100 * common >= PERCENT * total) & (color[cut, None] != self.color)
            one, two = np.nonzero(alike)
            colors = np.stack([color[cut][one], self.color[two]], 1)
            for k in np.unique(colors, axis=0, return_index=True)[1]:
                a, b = map(self.find, colors[k].tolist())
                if a != b:
                    self.root[a] = b
                    yield member[cut][one[k]], self.member[two[k]]


def different(rows: DataFrame) -> DataFrame:
    """``facing`` rows without the nodes and buckets that hold the same rows as another, as the same
    few classes often meet in several trees."""
    place = F.struct("node", "bucket")
    content = rows.groupBy("node", "bucket").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("class", "color", "few")).alias("one"),
        F.bit_xor(F.xxhash64(F.lit(1), "class", "color", "few")).alias("two"))
    first = content.groupBy("n", "one", "two").agg(F.min(place).alias("place")).select("place.*")
    return rows.join(first, ["node", "bucket"], "left_semi")


def uniting_links(rows: DataFrame) -> DataFrame:
    """Links between colours, decided on full sets, of contested rows with their ``hashes``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, few_of = None, Few()
        for batch in by_bytes(batches, "hashes"):
            member, color = (batch.column(c).to_numpy() for c in ("class", "color"))
            sets = [np.frombuffer(h, np.uint64) for h in batch.column("hashes").to_pylist()]
            found = []
            for key, few, begin, end in runs(batch):
                if key != held:
                    held, few_of = key, Few()
                part = member[begin:end], color[begin:end], sets[begin:end]
                if few:
                    few_of.add(*part)
                found += few_of.links(*part)
            pairs = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs.max(1)), pa.array(pairs.min(1))], names=["a", "b"])

    return together(rows).mapInArrow(run, PAIRS).distinct()


def hashed_sets(texts: DataFrame, size: int) -> DataFrame:
    """class and the sorted hashes of its shingles as bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in by_bytes(batches, limit=1 << 20):
            if len(memo) > MEMO_WORDS:
                memo.clear()
            sets = [shingle_hashes(words_in(t), size, memo).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("class"), pa.array(sets, pa.binary())], names=["class", "hashes"])
        del memo
        give_memory_back()

    return texts.mapInArrow(run, "class long, hashes binary")


def texts_of(members: DataFrame, classes: DataFrame, docs: DataFrame, have: DataFrame | None) -> DataFrame:
    """``have`` and one text of each of ``members`` that is not in it; rows repeated with the same id
    and text count once, told apart by the keys that they are joined by, so no text moves twice.
    The classes are written first: if they are few, no text is shuffled."""
    if have is not None:
        members = members.join(have.select("class"), "class", "left_anti")
    wanted = stage(classes.join(members, "class", "left_semi").select("class", "row_key", "text_key"), "wanted")
    more = stage(likely(keyed(docs), wanted).join(wanted, ["row_key", "text_key"])
                 .groupBy("row_key", "text_key").agg(F.first("class").alias("class"), F.first("text").alias("text"))
                 .select("class", "text"), "texts", keep=True)
    return more if have is None else have.union(more)


def likely(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose ``row_key`` may be in ``wanted``, so that a join moves few other texts.

    A bitmap of MARKS words of 64 bits marks the wanted keys; however many they are, it has no more
    rows than that, which is what bounds the broadcast. Each wanted row stays; where the bitmap is
    full, so do the others, and the join that follows drops them.
    """
    word = F.pmod(F.shiftrightunsigned("row_key", 6), F.lit(MARKS))
    bit = F.expr("shiftleft(1L, CAST(row_key & 63 AS INT))")
    words = wanted.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    return rows.join(F.broadcast(words), word == F.col("word")).filter(F.col("bits").bitwiseAND(bit) != 0) \
        .drop("word", "bits")


def confirmed(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sets of word tuples take some 25 times the bytes of their texts.
        for batch in by_bytes(by_bytes(batches, "text_a", CONFIRM_BYTES), "text_b", CONFIRM_BYTES):
            known: dict[int, set] = {}
            good = []
            a, b, text_a, text_b = (batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))
            for k in range(batch.num_rows):
                for key, text in ((a[k], text_a[k]), (b[k], text_b[k])):
                    if key not in known:
                        known[key] = shingles(text, size)
                one, two = known[a[k]], known[b[k]]
                common = len(one & two)
                if 100 * common >= PERCENT * (len(one) + len(two) - common):
                    good.append(k)
            yield pa.RecordBatch.from_arrays(
                [pa.array([c[k] for k in good], pa.int64()) for c in (a, b)], names=["a", "b"])
        give_memory_back()

    # Where the pairs are few, the texts of others stay where they are.
    seconds = texts.toDF("b", "text_b").join(pairs.select("b"), "b", "left_semi")
    return (
        pairs.select("a", "b").join(texts.toDF("a", "text_a"), "a").join(seconds, "b")
        .mapInArrow(run, PAIRS)
    )


def branched(large: DataFrame, level: int) -> DataFrame:
    """Rows of large nodes in the children that the path of their tree chooses.

    After LEVELS levels nodes stay as they are and only lose the pivots, which have met all others.
    """
    if level >= LEVELS:
        return large.filter(~F.array_contains("pivots", F.col("class"))).select("node", "class", "color", "n_shingles", "sketch", "path")
    children = []
    for branch in range(BRANCHES):
        chosen = F.xxhash64("node", F.lit(level), F.lit(branch))
        picks = [F.pmod(F.shiftrightunsigned(chosen, 8 * k), F.lit(PATH)).cast("int") for k in range(TOKENS)]
        children.append(F.xxhash64(chosen, *[F.substring("path", p + 1, F.lit(1)) for p in picks]))
    children = F.array(*children)
    return large.select(F.explode(children).alias("node"), "class", "color", "n_shingles", "sketch", "path")


def path_of(tree: str) -> Column:
    """The part of ``paths`` by which a tree branches."""
    return F.substring("paths", F.col(tree) * PATH + 1, F.lit(PATH))


def with_path(rows: DataFrame, needed: str) -> DataFrame:
    """Rows that keep their path only where it is ``needed``."""
    return rows.withColumn("path", F.when(F.expr(needed), F.col("path")))


def nearest_pairs(pairs: DataFrame) -> DataFrame:
    """Each class with the one below it and the one above it whose sketches agree most."""
    ends = pairs.select("agree", F.explode(F.array(*[
        F.struct(F.col(one).alias("class"), F.lit(one == "a").alias("above"), F.col(two).alias("other"))
        for one, two in ("ab", "ba")])).alias("end")).select("agree", "end.*")
    best = ends.groupBy("class", "above").agg(F.max_by("other", F.struct("agree", "other")).alias("other"))
    return best.select(F.greatest("class", "other").alias("a"), F.least("class", "other").alias("b")).distinct()


def joined(stars: DataFrame | None, links: DataFrame) -> DataFrame:
    """node and root after more links."""
    return components(links if stars is None else stars.toDF("a", "b").union(links))


def apart(pairs: DataFrame, stars: DataFrame) -> DataFrame:
    """Pairs that are not in one component yet."""
    return (
        pairs.join(stars.toDF("a", "root_a"), "a", "left").join(stars.toDF("b", "root_b"), "b", "left")
        .filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")
    )


def recolored(rows: DataFrame, stars: DataFrame) -> DataFrame:
    """Rows with ``color``, the root of their class's component."""
    return rows.join(stars.toDF("class", "root"), "class", "left") \
        .withColumn("color", F.coalesce("root", "class")).drop("root")


def mixed_nodes(rows: DataFrame, level: int, classes: DataFrame | None = None) -> DataFrame:
    """Rows of nodes with more than one colour, with what is known of the node; given the classes,
    large nodes know their pivots' sketches too. A class is in a node once."""
    orders = [F.xxhash64("class", F.lit(level), F.lit(k)) for k in range(PIVOTS)]
    if classes is not None and not level:
        # The roots' classes are colours of their own.
        colors = rows.select("node", "color", F.lit(1).cast("long").alias("n"), "class")
    else:
        colors = rows.groupBy("node", "color").agg(F.count("*").alias("n"), F.min_by("class", orders[0]).alias("class"))
    nodes = colors.groupBy("node").agg(
        F.sum("n").alias("node_size"), F.max("n").alias("dominant_size"),
        F.max_by("color", F.struct("n", "color")).alias("dominant"),
        F.array_distinct(F.array(*[F.min_by("class", o) for o in orders])).alias("pivots"), F.count("*").alias("colors"),
    ).filter("colors > 1").drop("colors").withColumn("pivots", F.when(F.expr(LARGE), F.col("pivots")))
    return rows.join(nodes if classes is None else with_faced(stage(nodes, "nodes"), classes), "node")


def facing_in_small_nodes(rows: DataFrame) -> DataFrame:
    """What ``facing`` gives for rows (node, class, color) of small nodes, of which some may be repeated."""
    nodes = rows.groupBy("node").agg(
        F.collect_set(F.struct("class", "color")).alias("members"), F.mode("color", True).alias("dominant"),
    ).filter(F.exists("members", lambda m: m["color"] != F.col("dominant")))
    return nodes.select("node", "dominant", F.inline("members")).select(
        "node", F.lit(0).alias("bucket"), (F.col("color") != F.col("dominant")).alias("few"), "class", "color")


def linked(classes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """node and root: the components that the trees' links make of the classes.

    ``classes`` is deleted once the trees' roots are written; after that no tokens and paths are read.
    """
    tokens = F.posexplode("tokens").alias("tree", "token")
    rows = classes.select(tokens, "class", "n_shingles", "sketch", "paths").select(
        F.xxhash64("tree", "token").alias("node"), "class", F.col("class").alias("color"), "n_shingles", "sketch",
        path_of("tree").alias("path"))
    wide, classes = classes, stage(classes.drop("tokens", "paths"), "classes")
    texts, stars, tested, level = None, None, None, 0
    while True:
        with scratch_scope(docs.sparkSession, "level"):
            live = stage(with_path(mixed_nodes(rows, level, classes), LARGE), "live")
            drop(rows if level else wide)
            # First pass: the nearest ones and the pivots.
            small = stage(nearest_in_small_nodes(live), "small")
            pairs = small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), "agree") \
                .union(pairs_with_pivots(live)).groupBy("a", "b").agg(F.max("agree").alias("agree"))
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            pairs = stage(pairs, "pairs", keep=True)
            tested = pairs.select("a", "b") if tested is None else tested.union(pairs.select("a", "b"))
            texts = texts_of(pairs.select("a").union(pairs.select("b")).toDF("class"), classes, docs, texts)
            nearest = stage(nearest_pairs(pairs), "nearest")
            stars = joined(stars, stage(confirmed(nearest, texts, size), "links"))
            others = stage(apart(pairs.join(nearest, ["a", "b"], "left_anti"), stars), "others")
            if not others.isEmpty():
                stars = joined(stars, stage(confirmed(others, texts, size), "links"))
            # Second pass: all that is left in nodes nearly of one colour.
            columns = ("node", "class", "n_shingles", "sketch", "path")
            large = mixed_nodes(recolored(live.filter(LARGE).select(*columns), stars), level)
            large = stage(with_path(large, BRANCHING), "large")
            left = facing_in_small_nodes(recolored(small.select("node", F.col("a").alias("class")), stars))
            left = stage(left.union(contested(facing(large, "n_shingles", "sketch"))), "contested")
            if not left.isEmpty():
                left = stage(different(left), "different")
                members = stage(left.select("class").distinct(), "members")
                texts = texts_of(members, classes, docs, texts)
                sets = stage(hashed_sets(texts.join(members, "class", "left_semi"), size), "sets")
                # The sets move with each node they are in, which takes the most disk of all steps.
                let_shuffles_go(docs.sparkSession)
                links = stage(uniting_links(left.join(sets, "class")), "links")
                stars = joined(stars, stage(confirmed(links, texts, size), "links"))
            stars = stage(stars, "stars", keep=True)
            large = large.filter(BRANCHING)
            if large.isEmpty():
                return stars
            if level >= LEVELS:
                # Pivots are those that the first pass compared.
                pivots = live.filter(LARGE).select("node", "pivots").distinct()
                large = large.drop("pivots").join(pivots, "node")
            rows = stage(branched(recolored(large, stars), level), "rows", keep=True)
        level += 1


def near_duplicates(docs: DataFrame, size: int = 5) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, row_key, text_key, n_shingles,
    group (NULL without words) and component_id, the least doc_id of the group.

    Documents without a word, or without text, are linked with nothing and are their own
    component. A NULL doc_id is never the least one unless the group has no other. Rows that
    repeat a doc_id are rows like others. An empty table gives no rows; other columns are not
    read.
    """
    described = stage(describe(docs, size), "described")
    classes = stage(
        described.filter("set_key IS NOT NULL").groupBy("set_key").agg(
            F.min("doc_id").alias("least_id"), F.min_by(F.struct("row_key", "text_key"), "row_key").alias("keys"),
            F.first("n_shingles").alias("n_shingles"), F.first("tokens").alias("tokens"),
            F.first("sketch").alias("sketch"), F.first("paths").alias("paths")), "classes")
    # The table is written, so a number by place in it is the same whenever it is read again.
    numbered = stage(classes.withColumn("class", F.monotonically_increasing_id())
                     .select("*", "keys.row_key", "keys.text_key").drop("keys"), "classes")
    # The rows need their set's key alone from now on; what the trees are made of is in the classes.
    members = stage(described.select("doc_id", "row_key", "text_key", "n_shingles", "set_key"), "members")
    drop(classes, described)
    del classes, described
    let_shuffles_go(docs.sparkSession)
    known = stage(numbered.select("class", "set_key", "least_id"), "known")
    roots = linked(numbered, docs, size).toDF("class", "root")
    grouped = stage(known.join(roots, "class", "left")
                    .select("set_key", "least_id", F.coalesce("root", "class").alias("group")), "grouped")
    least = grouped.groupBy("group").agg(F.min("least_id").alias("group_id"))
    member = grouped.join(least, "group").select("set_key", "group", "group_id")
    return members.join(member, "set_key", "left").select(
        "doc_id", "row_key", "text_key", "n_shingles", "group",
        F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("group_id")).alias("component_id"))


def near_dedup_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of near duplicates, on five-word shingles.

    The one with the least doc_id stays, with all its columns, once even if its row is repeated.
    Documents without words all stay.
    """
    found = stage(near_duplicates(docs, 5), "near-duplicates")
    grouped, alone = found.filter("group IS NOT NULL"), found.filter("group IS NULL")
    stays = grouped.groupBy("group").agg(F.min_by(
        F.struct("row_key", "text_key"),
        F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_key"), F.col("text_key"))).alias("keys")) \
        .select("keys.*", F.lit(True).alias("once"))
    stays = stays.union(alone.select("row_key", "text_key", F.lit(False).alias("once")).distinct())
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", F.xxhash64("row.doc_id", "row.text").alias("row_key"),
        F.xxhash64(F.lit(1), "row.text").alias("text_key")).join(stays, ["row_key", "text_key"])
    repeated = found.groupBy("row_key", "text_key").count().filter("count > 1").select("row_key", "text_key")
    marked = stage(rows.join(repeated.withColumn("again", F.lit(True)), ["row_key", "text_key"], "left"), "kept")
    several = F.col("once") & F.col("again").isNotNull()
    single = marked.filter(several).dropDuplicates(["row_key", "text_key"])
    return marked.filter(~several).union(single).select("row.*")


def op8_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Near duplicates among all documents, on two-word shingles."""
    return near_duplicates(documents(spark, sf_dir), 2).select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
