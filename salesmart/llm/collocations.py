"""Phrase collocations: frequent phrases whose words belong together.

First pass: every task adds up the n-grams of its texts by a 64-bit hash, and deals them to hash
partitions by the first bits of it. Each partition merges what it gets into a Misra-Gries summary. Its
capacity exceeds the partition's mass (all its n-grams) over the threshold, so what the summary
takes off any counter in all stays below the threshold, and every n-gram that occurs as often as the
threshold survives. Of the survivors those go whose counter and all that was taken off stay below it. The partition's mass is known before its first counter: the rows that state
the tasks' shares of it sort first. Two n-grams with one hash share a counter, which can only let
more survive. Second pass: the n-grams whose hash may be a survivor's are counted exactly, as
text, and those below the threshold go. The survivors travel as a bitmap of a fixed size, by the first
bits of the hash; the fuller it is, the more n-grams are counted in vain, and none is lost.

Everything is per language; a NULL language is ``und``. A NULL or empty text has no words. Repeated rows
count as often as they occur, whatever their ids; ids and other columns are not read. An empty table
gives no rows. A task holds a few megabytes of text, or one longer document, and about
ENTRIES counters.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import by_bytes, documents, give_memory_back
from salesmart.staging import stage

LONGEST = 3
THRESHOLD = 10
COVERED_PERCENT = 50
TOP = 2000
NO_LANGUAGE = "und"

#: Counters that a task adds up before it deals them out, about.
ENTRIES = 1_000_000
#: Text that a task counts at once, in bytes.
BATCH_TEXT = 2 << 20
#: Bytes of text for each hash partition; it has up to three n-grams for two bytes.
PARTITION_BYTES = 1 << 20
#: At least eight bits of the bitmap are left to each partition.
MOST_PARTITION_BITS = 24
#: Bits of a hash, after those of its partition, by which counters are told apart.
KEY_BITS = 40
#: The bitmap of survivors takes 2^27 bits, 16 MB.
BITMAP_BITS = 27

# ---- Fixed values: what ends a piece, and what separates words within one ----
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(bytes(range(65, 91)) + PIECE_ENDS + b"\t",
                         bytes(range(97, 123)) + b"\n" * len(PIECE_ENDS) + b" ")


def mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Counted:
    """The different n-grams of some texts of one language: counts, hashes, and their words."""

    def __init__(self, lang: str, texts: list[bytes], longest: int):
        flat = b"\n".join(texts).translate(_PLAIN).replace(b"\n", b" \n ")
        tokens = [b"\n", *[w for w in flat.split(b" ") if w]]
        words = list(dict.fromkeys(tokens))
        place = {w: k for k, w in enumerate(words)}
        ids = np.fromiter(map(place.__getitem__, tokens), np.int64, len(tokens))
        seed = xxhash.xxh32_intdigest(lang.encode())
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))
        self.words = pa.array(words, pa.binary())
        # Word 0 ends a piece.
        self.n_words = int((ids != 0).sum())
        self.sizes: list[tuple[list[np.ndarray], np.ndarray, np.ndarray]] = []
        inside, gram, hashed = ids != 0, ids, hashes
        parts: list[np.ndarray] = [np.arange(len(words))]
        for size in range(1, longest + 1):
            if size > 1:
                # An n-gram is the one that ends a word earlier, and a word more.
                ends = ids[size - 1:]
                inside = inside[:-1] & (ends != 0)
                key = gram[:-1] * len(words) + ends
            else:
                key = ids
            grams, found, counts = np.unique(key[inside], return_inverse=True, return_counts=True)
            gram = np.zeros(len(key), np.int64)
            gram[inside] = found
            if size > 1:
                before, last = grams // len(words), grams % len(words)
                parts = [*[p[before] for p in parts], last]
                hashed = mixed(hashed[before] * np.uint64(0x9E3779B97F4A7C15) + hashes[last] + np.uint64(size))
            else:
                parts, hashed = [grams], hashes[grams]
            self.sizes.append((parts, hashed, counts))

    def phrases(self, parts: list[np.ndarray], chosen: np.ndarray) -> pa.Array:
        return pc.binary_join_element_wise(
            *[self.words.take(pa.array(p[chosen])) for p in parts], pa.scalar(b" ", pa.binary()))


def by_language(batches: Iterable[pa.RecordBatch], longest: int) -> Iterator[tuple[str, Counted]]:
    for batch in by_bytes(batches, limit=BATCH_TEXT):
        texts: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(),
                              batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
            if text:
                texts.setdefault(NO_LANGUAGE if lang is None else lang, []).append(text)
        for lang, held in texts.items():
            yield lang, Counted(lang, held, longest)


def added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Counters by rising key, those of one key added up."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    if not len(key):
        return key, count
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(count, first)


SHARES = "part int, mass long, keys binary, counts binary"


def dealt(longest: int, bits: int):
    """Counters of all n-grams by hash partition: first a row with the mass, then the counters."""
    low = np.uint64(64 - bits - KEY_BITS)

    def rows(keys: list, counts: list) -> pa.RecordBatch:
        key, count = added(keys, counts)
        part = (key >> np.uint64(KEY_BITS)).astype(np.int64) if bits else np.zeros(len(key), np.int64)
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        ends = np.append(starts[1:], len(part))
        # Five bytes of a key are left after its partition.
        five = key.view(np.uint8).reshape(-1, 8)[:, :KEY_BITS // 8]
        count32 = np.minimum(count, 0xFFFFFFFF).astype("<u4")
        columns: list[list] = [[], [], [], []]
        for a, b in zip(starts, ends, strict=True):
            mass = int(count[a:b].sum())
            for column, values in zip(columns, ((int(part[a]),) * 2, (mass, None), (None, five[a:b].tobytes()),
                                                (None, count32[a:b].tobytes())), strict=True):
                column.extend(values)
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                          names=["part", "mass", "keys", "counts"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held, fresh = [], [], 0, 0
        for _, counted in by_language(batches, longest):
            for _, hashed, count in counted.sizes:
                keys.append(hashed >> low)
                counts.append(count)
                held += len(count)
                fresh += len(count)
            if fresh > ENTRIES:
                key, count = added(keys, counts)
                keys, counts, held, fresh = [key], [count], len(key), 0
                if held > ENTRIES:
                    yield rows(keys, counts)
                    keys, counts, held = [], [], 0
        if held:
            yield rows(keys, counts)
        del keys, counts
        give_memory_back()

    return run


def summary(keys: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Misra-Gries: with more than ``capacity`` counters, the largest beyond it is taken off all.
    Also says how much that is."""
    if len(keys) <= capacity:
        return keys, counts, 0
    taken = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
    kept = counts > taken
    return keys[kept], counts[kept] - taken, taken


def survivors(threshold: int, bits: int):
    """Each partition's section of the bitmap, from rows by partition, masses first."""
    width = BITMAP_BITS - bits

    def bitmap(part: int, keys: np.ndarray) -> tuple[int, bytes]:
        marks = np.zeros(1 << width, np.uint8)
        marks[(keys >> np.uint64(KEY_BITS - width)).astype(np.int64)] = 1
        return part, np.packbits(marks, bitorder="little").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, taken = None, 0, 0
        keys, counts, fresh = [], [], 0
        done: list[tuple[int, bytes]] = []

        def merge() -> None:
            nonlocal keys, counts, taken, fresh
            # The capacity exceeds mass / threshold.
            key, count, more = summary(*added(keys, counts), mass // threshold + 1)
            keys, counts, taken, fresh = [key], [count], taken + more, 0

        def finished() -> tuple[int, bytes]:
            merge()
            # An n-gram occurs its counter and what was taken off in all at most.
            return bitmap(part, keys[0][counts[0] + taken >= threshold])

        for batch in batches:
            for at, share, key, count in zip(*(batch.column(c) for c in ("part", "mass", "keys", "counts")), strict=True):
                if at.as_py() != part:
                    if keys:
                        done.append(finished())
                    part, mass, taken, keys, counts, fresh = at.as_py(), 0, 0, [], [], 0
                if share.is_valid:
                    mass += share.as_py()
                    continue
                five = np.frombuffer(key.as_buffer(), np.uint8).reshape(-1, KEY_BITS // 8)
                whole = np.zeros((len(five), 8), np.uint8)
                whole[:, :KEY_BITS // 8] = five
                keys.append(whole.view("<u8").ravel())
                counts.append(np.frombuffer(count.as_buffer(), "<u4").astype(np.int64))
                fresh += len(five)
                if fresh > mass // threshold + 1:
                    merge()
            if done:
                yield sections(done)
                done = []
        if keys:
            yield sections([finished()])

    def sections(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                           pa.array([r[1] for r in rows], pa.binary())], names=["part", "marks"])

    return run


def frequent_marks(texts: DataFrame, threshold: int, longest: int) -> bytes:
    """The bitmap of the hashes that may be those of frequent n-grams: 2^BITMAP_BITS bits."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MOST_PARTITION_BITS, max(0, (size // PARTITION_BYTES).bit_length()))
    shares = texts.mapInArrow(dealt(longest, bits), SHARES).repartition("part")
    # NULL counters sort first: these rows have the masses.
    parts = shares.sortWithinPartitions("part", F.col("mass").isNull()).mapInArrow(
        survivors(threshold, bits), "part int, marks binary")
    marks = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    width = BITMAP_BITS - bits
    found = parts.toArrow()
    for part, section in zip(found.column("part").to_pylist(), found.column("marks"), strict=True):
        marks[part << (width - 3):(part + 1) << (width - 3)] = np.frombuffer(section.as_buffer(), np.uint8)
    return marks.tobytes()


def frequent(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST) -> DataFrame:
    """lang, phrase (words joined by spaces) and its count ``n``, for all phrases of up to
    ``longest`` words that occur ``threshold`` times; and lang, NULL and the count of all words."""
    texts = docs.select("lang", "text").where(F.octet_length("text") > 0)
    held = docs.sparkSession.sparkContext.broadcast(frequent_marks(texts, threshold, longest))
    schema = "lang string, phrase string, n long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(held.value, np.uint8)
        for lang, counted in by_language(batches, longest):
            phrases, counts = [pa.nulls(1, pa.string())], [np.array([counted.n_words])]
            for parts, hashed, count in counted.sizes:
                bit = hashed >> np.uint64(64 - BITMAP_BITS)
                byte = marks[(bit >> np.uint64(3)).astype(np.int64)]
                chosen = np.flatnonzero(byte >> (bit & np.uint64(7)).astype(np.uint8) & 1)
                phrases.append(counted.phrases(parts, chosen).cast(pa.string()))
                counts.append(count[chosen])
            n = np.concatenate(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]).take(pa.array(np.zeros(len(n), np.int64))), pa.concat_arrays(phrases),
                 pa.array(n, pa.int64())], names=["lang", "phrase", "n"])
        give_memory_back()

    counted = texts.mapInArrow(run, schema).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return counted.where(F.col("phrase").isNull() | (F.col("n") >= threshold))


def collocations(
    docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, top: int = TOP,
    covered_percent: int = COVERED_PERCENT,
) -> DataFrame:
    """The best phrases of two to ``longest`` words of each language.

    A phrase is cut in two at each place; a cut's score is the floor of 1,000,000 a a / (l r), with
    the counts of the phrase and of its two sides, and the cut of the lowest score (of those, the first)
    is the phrase's. A phrase goes if a longer one around it occurs ``covered_percent`` of its times.
    The rest is ranked by score, count, and the phrase's bytes.
    """
    counts = stage(frequent(docs, threshold, longest), "phrase-counts")
    phrases = counts.where("phrase IS NOT NULL").withColumn("words", F.split("phrase", " "))
    candidates = phrases.where(F.size("words") > 1).select("lang", "phrase", F.col("n").alias("a"), "words")

    def joined(begin, length):
        return F.array_join(F.slice("words", begin, length), " ")

    size = F.size("words")
    cuts = F.flatten(F.transform(F.sequence(F.lit(1), size - 1), lambda k: F.array(
        F.struct(k.alias("k"), F.lit("l").alias("side"), joined(F.lit(1), k).alias("part")),
        F.struct(k.alias("k"), F.lit("r").alias("side"), joined(k + 1, size - k).alias("part")))))
    sides = candidates.select("lang", "phrase", "a", F.explode(cuts).alias("cut")).select(
        "lang", "phrase", "a", "cut.*")
    # A part occurs at least as often as its phrase, so all parts have been counted.
    measured = sides.join(phrases.select("lang", F.col("phrase").alias("part"), "n"), ["lang", "part"])
    of_side = {s: F.max(F.when(F.col("side") == s, F.col("n"))).alias(s) for s in "lr"}
    wide = F.col("a").cast("decimal(16,0)")
    score = F.expr("CAST(square * 1000000 AS DECIMAL(38,0)) div product")
    scored = measured.groupBy("lang", "phrase", "a", "k").agg(*of_side.values()).withColumns({
        "square": wide * wide, "product": F.col("l").cast("decimal(16,0)") * F.col("r").cast("decimal(16,0)"),
    }).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))

    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda length: F.transform(
        F.sequence(F.lit(1), size - length + 1), lambda begin: joined(begin, length))))
    longer = candidates.where(size > 2).select("lang", F.explode(inner).alias("phrase"), "a")
    cover = longer.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = scored.join(cover, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (F.col("around") * 100 < F.col("a") * covered_percent))

    totals = counts.where("phrase IS NULL").select("lang", F.col("n").alias("all_words"))
    best_first = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "best.l", "best.r",
        F.col("all_words").alias("n"), "best.score")


def op13_collocations(spark, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of two or three words of each language of the documents."""
    return collocations(documents(spark, sf_dir))


OP13_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\n\x0B\f\r]')) AS piece
    FROM documents
), w AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS words FROM pieces
), grams AS (
    SELECT lang, s.size AS size, words, unnest(range(1, len(words) - s.size + 2)) AS i
    FROM w, (VALUES (1), (2), (3)) s(size) WHERE len(words) >= s.size
), f AS (
    SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase, count(*) AS n
    FROM grams GROUP BY ALL
), totals AS (
    SELECT lang, sum(n) AS n FROM f WHERE size = 1 GROUP BY lang
), c AS (
    SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS words FROM f WHERE size > 1 AND n >= 10
), cuts AS (
    SELECT c.*, unnest(range(1, size)) AS k FROM c
), parts AS (
    SELECT lang, size, phrase, a, k, array_to_string(words[1:k], ' ') AS lp,
           array_to_string(words[k + 1:size], ' ') AS rp FROM cuts
), scores AS (
    SELECT p.lang, p.phrase, p.a, p.k, x.n AS l, y.n AS r,
           CAST((1000000::HUGEINT * p.a * p.a) // (x.n::HUGEINT * y.n) AS BIGINT) AS score
    FROM parts p JOIN f x ON x.lang = p.lang AND x.phrase = p.lp JOIN f y ON y.lang = p.lang AND y.phrase = p.rp
), best AS (
    SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), around AS (
    SELECT lang, phrase, max(a) AS a FROM (
        SELECT lang, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) AS phrase, a
        FROM c WHERE size = 3) GROUP BY lang, phrase
), kept AS (
    SELECT b.* FROM best b LEFT JOIN around o ON o.lang = b.lang AND o.phrase = b.phrase
    WHERE o.a IS NULL OR 100 * o.a < 50 * b.a
)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(t.n AS BIGINT) AS n, score
FROM kept k JOIN totals t ON t.lang = k.lang QUALIFY rank <= 2000
"""
