"""The training-data operators against brute force, the libraries, and odd inputs."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from salesmart.llm import bm25, bpe, components, language, near_dedup, packing, quality_model, quality_rules
from salesmart.llm import sharding, suffix_dedup, token_files
from salesmart.llm.queries import ORACLE, QUERIES
from tests.oracle import connect, difference

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

PASSAGE = " ".join(f"word{k} of a passage" for k in range(30))
ODD = [
    (1, "A short text, here."), (1, "A short text, here."), (None, "no id <|endoftext|> end"),
    (2, None), (3, ""), (4, "   \n\t "), (5, "x" * 30_000), (6, PASSAGE + " tail one"),
    (7, "Other head " + PASSAGE), (8, PASSAGE + " tail one"), (9, "Ünïcode ՘ \U0001f600 ΑΣ " * 30),
    (10, "one two three four five six " * 40), (10, "another text with the same id"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated ids and rows, and columns with the results' names."""
    schema = ("doc_id long, text string, lang string, source string, n_chars long, shard int, part int, "
              "rank int, n_words long, component_id long, length long, row int, score double")
    rows = [(i, t, "en" if i else None, None, None, *[None] * 8) for i, t in ODD]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def small(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE[name]) is None


def test_sharding_fills_shards_evenly(odd, small):
    for docs, shards in ((odd, 3), (small, 16)):
        rows = sharding.shard_rows(docs, shards).collect()
        places = collections.defaultdict(list)
        for r in rows:
            places[r["shard"]].append(r["slot"])
        sizes = [len(places[s]) for s in range(shards)]
        assert sum(sizes) == docs.count() and max(sizes) - min(sizes) <= 1
        assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_sharding_follows_the_ring_where_there_is_room():
    counts = {slot: slot % 5 for slot in range(0, 4096, 7)}
    liked = sharding.preferences(sharding.ring(4), 4096)
    runs = sharding.place(counts, 4)
    assert sum(r["last"] - r["first"] + 1 for r in runs) == sum(counts.values())
    home = sum(r["last"] - r["first"] + 1 for r in runs if r["shard"] == liked[r["ring_slot"]][0])
    assert home > 0.8 * sum(counts.values())


def test_bpe_equals_the_library(odd, small):
    library = Tokenizer.from_file(BYTE_BPE)
    for docs in (odd, small):
        texts = [r["text"] or "" for r in docs.collect()]
        expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
        table = bpe.ByteBpe(BYTE_BPE).encode(texts)
        assert [table.flat[a:a + n].tolist() for a, n in zip(table.starts, table.lengths)] == expected
        rows = bpe.encode_decode(docs, BYTE_BPE).collect()
        decoded = [library.decode(ids, skip_special_tokens=False) for ids in expected]
        assert sorted(r["decoded_sha256"] for r in rows) == sorted(hashlib.sha256(d.encode()).hexdigest() for d in decoded)


def test_tokenizers_split_all_code_points_alike():
    texts = [f"a{chr(c)}1{chr(c)}. {chr(c)}{chr(c)} x{chr(c)} \n {chr(c)}"
             for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    for path, ids in ((BYTE_BPE, packing.Ids(BYTE_BPE)), (WORD_BPE, None)):
        library = Tokenizer.from_file(path)
        expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
        if ids:
            assert [ids.encode(t) for t in texts] == expected
        else:
            assert [list(i) for i in token_files.WordIds(path).encode_each(texts)] == expected


def test_packing_places_every_piece_once(odd):
    rows = packing.packed_documents(odd, BYTE_BPE, with_ids=True).collect()
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert r["length"] == len(r["ids"])
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    library = Tokenizer.from_file(BYTE_BPE)
    total = sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in ODD)
    assert sum(r["length"] for r in rows) == total


def test_patterns_stay_few_and_use_the_histogram_up():
    histogram = {k: 1000 + 7 * k for k in range(1, 1025)}
    patterns = packing.shortest_pack_first(histogram)
    used = collections.Counter()
    for pattern, count in patterns:
        assert sum(pattern) <= 1024
        for size in pattern:
            used[size] += count
    assert used == histogram and len(patterns) <= 2 * 1024


def test_token_files_round_trip(spark, odd, tmp_path):
    target = str(tmp_path / "ids")
    token_files.write_ids(odd, WORD_BPE, target)
    library = Tokenizer.from_file(WORD_BPE)
    expected = sorted(((i is not None, i or 0), [*library.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in ODD)
    rows = token_files.read_ids(spark, target).collect()
    assert sorted(((r["doc_id"] is not None, r["doc_id"] or 0), list(r["ids"])) for r in rows) == expected
    start = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == start
        start += r["n_tokens"]
    assert len(token_files.ids_of_document(spark, target, 10)) == 2


def check_near_duplicates(docs, size):
    """The components against those of all pairs of texts."""
    rows = near_dedup.near_duplicates(docs, size).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    sets = [near_dedup.shingles(t, size) for _, t in texts]
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if group[a] != group[b] and common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {}
    for g, (i, _) in zip(group, texts):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    assert sorted(map(repr, ((i, least.get(g)) for g, (i, _) in zip(group, texts)))) == \
        sorted(repr((r["doc_id"], r["component_id"])) for r in rows)
    return least


def test_near_duplicates_equal_brute_force(odd, small):
    for docs, size in ((odd, 2), (small, 5)):
        check_near_duplicates(docs, size)


def test_near_duplicates_in_a_crowd_around_the_threshold(spark, monkeypatch):
    """More variants of one text than a node compares, many just under the threshold."""
    draw = random.Random(3)
    base = [f"w{k}" for k in range(100)]
    crowd = [(k, " ".join(f"x{draw.randrange(9999)}" if draw.random() < share else w for w in base))
             for k in range(600) for share in [draw.choice((0.01, 0.05, 0.08, 0.12))]]
    docs = spark.createDataFrame(crowd, "doc_id long, text string")
    monkeypatch.setattr(near_dedup, "BUCKET", 50)
    assert 10 < len(check_near_duplicates(docs, 2)) < 500


def test_pairs_over_the_threshold_meet_in_some_tree_after_all_levels(spark):
    """Lone pairs of similarity 0.802 whose nodes stay large on every level."""
    n_pairs = 1000
    docs = spark.createDataFrame(
        [(2 * k + side, " ".join([f"p{k}w{w}" for w in range(89)] + [f"p{k}s{side}w{w}" for w in range(11)]))
         for k in range(n_pairs) for side in (0, 1)], "doc_id long, text string")
    described = near_dedup.stage(near_dedup.describe(docs, 1))
    pair = F.expr("doc_id div 2")
    rows = described.select("*", F.posexplode("tokens").alias("tree", "token")).select(
        F.xxhash64("tree", "token", pair).alias("node"), F.col("doc_id").alias("class"), pair.alias("color"),
        "n_shingles", "sketch", near_dedup.path_of("tree").alias("path"))
    met = {}
    for level in range(near_dedup.LEVELS):
        both = rows.groupBy("node", "color").count().filter("count = 2").select("node", "color")
        rows = near_dedup.stage(rows.join(both, ["node", "color"], "left_semi"))
        met[level] = rows.select("color").distinct().count()
        rows = near_dedup.branched(rows, level)
    both = rows.groupBy("node", "color").count().filter("count = 2")
    met[near_dedup.LEVELS] = both.select("color").distinct().count()
    print(met)
    assert met[near_dedup.LEVELS] > 0.96 * n_pairs


def test_near_dedup_stage_keeps_one_row_of_each_group(spark, odd, sf_dir):
    kept = near_dedup.near_dedup_stage(spark, odd, sf_dir)
    assert kept.columns == odd.columns
    texts = [r["text"] for r in kept.collect()]
    assert texts.count("A short text, here.") == 1 and texts.count(PASSAGE + " tail one") == 1


@pytest.mark.parametrize("share", [10, 10_000])
def test_components_of_one_or_many_shares(spark, monkeypatch, share):
    """A long path, a star, a cycle with repeated edges and nodes in falling order."""
    edges = [(k, k + 1) for k in range(100, 140)] + [(500, k) for k in range(501, 530)]
    edges += [(k + 1, k) for k in range(900, 920)] + [(900, 920)] * 3
    monkeypatch.setattr(components, "EDGES_A_TASK", share)
    found = components.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()
    expected = {k: 100 for k in range(101, 141)} | {k: 500 for k in range(501, 530)} | {k: 900 for k in range(901, 921)}
    assert len(found) == len(expected) and {r["node"]: r["root"] for r in found} == expected


def test_suffix_dedup_equals_brute_force(odd):
    rows = suffix_dedup.remove_repeats(odd).select("row.text", "cut.*").collect()
    texts = [(t or "").encode() for _, t in ODD]
    length = suffix_dedup.LENGTH
    seen = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))

    def left(data: bytes) -> bytes:
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if seen[data[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        return bytes(b for b, g in zip(data, gone) if not g)

    assert sorted(bytes(r["kept"]) for r in rows) == sorted(map(left, texts))


def test_suffix_dedup_stage_removes_passages_of_over_50_words(spark, sf_dir):
    """Passages of 48 to 70 words, of short and of long words, that otherwise different texts share."""
    draw = random.Random(5)

    def word(most):
        return "".join(draw.choice("abcdefghij") for _ in range(draw.randint(1, most)))

    texts = [None, "", "lone", "kept " * 50, "\u4e2d\u6587\u5b57\u8bcd" * 40, "head " + "\u4e2d\u6587\u5b57\u8bcd" * 40]
    for count in (48, 50, 51, 52, 55, 60, 65, 70):
        for most in (1, 9, 20):
            passage = " ".join(word(most) for _ in range(count))
            for _ in range(2):
                texts.append(" ".join([*(word(12) + "X" for _ in range(draw.randint(0, 90))), passage,
                                       *(word(12) + "Y" for _ in range(draw.randint(0, 90)))]))
    spaced = " ".join(word(9) for _ in range(60))
    texts += ["a  b\n" + spaced.replace(" ", "\n"), spaced + " end", "again", "again"]
    split = [[c for w in (t or "").split() for c in ([w] if len(w.encode()) <= 32 else w)] for t in texts]
    seen = collections.Counter(tuple(w[i:i + 51]) for w in split for i in range(len(w) - 50))

    def left(units):
        gone = set()
        for i in range(len(units) - 50):
            if seen[tuple(units[i:i + 51])] > 1:
                gone.update(range(i, i + 51))
        return "".join(u for i, u in enumerate(units) if i not in gone)

    docs = spark.createDataFrame([(k, t, None) for k, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    found = {r["doc_id"]: r["text"] for r in suffix_dedup.suffix_dedup_stage(spark, docs, sf_dir).collect()}
    assert found[0] is None and sum(len(left(u)) < sum(map(len, u)) for u in split) >= 36
    assert {k: "".join((t or "").split()) for k, t in found.items()} == {k: left(u) for k, u in enumerate(split)}


def test_search_equals_brute_force(odd):
    rows = bm25.search(odd, odd.filter("doc_id IN (1, 6, 10)"), 5).collect()
    terms = [(i, bm25.terms_of(t)) for i, t in ODD]
    mean = sum(sum(c.values()) for _, c in terms) / len(terms)
    df = collections.Counter(t for _, c in terms for t in c)

    def score(query, doc):
        norm = 1.2 * (0.25 + 0.75 * sum(doc.values()) / mean)
        return sum(n * math.log(1 + (len(terms) - df[t] + 0.5) / (df[t] + 0.5)) * doc[t] * 2.2 / (doc[t] + norm)
                   for t, n in query.items() if t in doc)

    query = bm25.terms_of(PASSAGE + " tail one")
    expected = sorted((s for s in (score(query, c) for _, c in terms) if s > 0), reverse=True)[:5]
    found = sorted((r["score"] for r in rows if r["query_id"] == 6), reverse=True)
    assert found == pytest.approx(expected)


def test_texts_made_to_collide_are_not_repeats(spark):
    """Thue-Morse strings and their complements agree in polynomial hashes modulo 2^64."""
    import numpy as np
    bits = [0]
    while len(bits) < 2048:
        bits += [1 - b for b in bits]
    one = "".join("ab"[b] for b in bits)
    other = "".join("ba"[b] for b in bits)
    hashes = suffix_dedup.Hashes()
    ends = np.array([0]), np.array([2048])
    both = [np.frombuffer(t.encode(), np.uint8) for t in (one, other)]
    assert len({int(hashes.between(hashes.prefixes(d), *ends)[0]) for d in both}) == 1
    assert (suffix_dedup.digests(both[0], *ends) != suffix_dedup.digests(both[1], *ends)).all()
    texts = [one[:512], other[:512], "x" + one[:700], other[:1500] + "y", "once " + one[512:1000]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["row"]["doc_id"]: r["cut"] for r in suffix_dedup.remove_repeats(docs).collect()}
    seen = collections.Counter(t[i:i + 400] for t in texts for i in range(len(t) - 399))
    for k, t in enumerate(texts):
        gone = set()
        for i in range(len(t) - 399):
            if seen[t[i:i + 400]] > 1:
                gone.update(range(i, i + 400))
        kept = "".join(c for i, c in enumerate(t) if i not in gone)
        assert found[k]["n_removed"] == len(gone) and bytes(found[k]["kept"]) == kept.encode()


@pytest.fixture(scope="module")
def ranked_by_brute_force(small):
    """The ten best of every tenth document, by plain sums over all documents."""
    rows = sorted((r["doc_id"], r["text"]) for r in small.select("doc_id", "text").collect())
    rows += [(i + 10**6, t) for i, t in rows[:60]]  # ties, smaller id first
    terms = [(i, bm25.terms_of(t)) for i, t in rows]
    mean = sum(c.total() for _, c in terms) / len(terms)
    holders = collections.defaultdict(list)
    for at, (_, c) in enumerate(terms):
        norm = 1.2 * (0.25 + 0.75 * c.total() / mean)
        for t, n in c.items():
            holders[t].append((at, n * 2.2 / (n + norm)))
    idf = {t: math.log(1 + (len(terms) - len(h) + 0.5) / (len(h) + 0.5)) for t, h in holders.items()}
    best = {}
    for i, c in terms:
        if i % 10 == 0:
            score = collections.Counter()
            for t in sorted(c):
                for at, weight in holders[t]:
                    score[at] += c[t] * idf[t] * weight
            best[i] = sorted(((-round(s, 7), terms[at][0]) for at, s in score.items()))[:10]
    return rows, best


@pytest.mark.parametrize(("shard_bytes", "first_shards"), [(1 << 24, 256), (20_000, 256), (20_000, 1)])
def test_search_over_many_shards_and_rounds(spark, ranked_by_brute_force, shard_bytes, first_shards):
    rows, best = ranked_by_brute_force
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    index = bm25.build_index(docs, shard_bytes)
    assert index.count() > 12 or shard_bytes > 20_000
    found = collections.defaultdict(list)
    for r in bm25.search(docs, docs.filter("doc_id % 10 = 0"), 10, shard_bytes, first_shards).orderBy("rank").collect():
        found[r["query_id"]].append((-round(r["score"], 7), r["doc_id"]))
    assert {q: [i for _, i in f] for q, f in found.items()} == {q: [i for _, i in b] for q, b in best.items() if b}
    assert all([s for s, _ in found[q]] == pytest.approx([s for s, _ in b]) for q, b in best.items())


def test_search_keeps_each_shard_in_a_file_of_its_own(spark, small, monkeypatch):
    """One task makes many shards; no file, and so no task that writes or reads one, holds two."""
    staged = {}

    def spy(df, name, **how):
        staged[name] = stage(df, name, **how)
        return staged[name]

    stage = bm25.stage
    monkeypatch.setattr(bm25, "stage", spy)
    docs = small.select("doc_id", "text").limit(100).coalesce(1)
    assert bm25.search(docs, docs.filter("doc_id % 10 = 0"), shard_bytes=20_000).count()
    shards = staged["index"].count()
    assert shards > 3 and len(staged["index"].inputFiles()) == shards


def test_search_rounds_cover_all_shards():
    assert bm25.rounds_of(0, 256) == bm25.rounds_of(256, 256) == [(0.0, 1.0)]
    rounds = bm25.rounds_of(100_000, 256)
    assert rounds[0][1] * 100_000 <= 256 and rounds[0][0] == 0.0 and rounds[-1][1] == 1.0
    assert all(a[1] == b[0] for a, b in zip(rounds, rounds[1:], strict=False))


def test_search_skips_documents_below_the_threshold():
    """Few pivots are scored, and the best are those of a full evaluation."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(5)
    lists = [[b"w%05d" % t for t in rng.zipf(1.3, 120) % 5000] + [b"own%d" % (k % 400)] * 3 for k in range(4000)]
    frame = pa.RecordBatch.from_pylist([{"doc_id": k, "text": b" ".join(t).decode()} for k, t in enumerate(lists)])
    shard = bm25.Shard(next(iter(bm25.index_of([frame], bm25.SHARD_BYTES))), 123.0)
    place = {t: k for k, t in enumerate(shard.terms.to_pylist())}
    assert (shard.row >= 0).any() and (shard.row < 0).any()
    scored = 0
    for k in range(0, 4000, 400):
        words = collections.Counter(lists[k])
        places = np.array([place[t] for t in words])
        weights = np.array(list(words.values())) * np.log(4000 / shard.count[places])
        query = np.zeros(len(place))
        query[places] = weights
        full = np.add.reduceat(query[shard.doc_term] * shard.doc_weight, shard.doc_start)
        best = bm25.Best(10)
        before = best.add
        counted = []
        best.add = lambda scores, *rest: (counted.append(len(scores)), before(scores, *rest))
        shard.search(places, weights, shard.bounds([(places, weights)])[0], best)
        scored += sum(counted)
        expected = sorted(range(4000), key=lambda d: (-full[d], d))[:10]
        assert best.ids.tolist() == expected and best.scores.tolist() == full[expected].tolist()
    assert scored < 0.2 * 10 * 4000


def test_language_of_odd_texts_and_held_out_accuracy(spark, odd, small, sf_dir):
    profiles = language.learn(small)
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(odd, profiles).collect()}
    assert found[2] == found[3] == found[4] == "und"
    result = QUERIES["op6_language"](spark, sf_dir).filter("held_out").join(small.select("doc_id", "lang"), "doc_id")
    assert result.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.95


def test_quality_scores(spark, odd, sf_dir):
    rows = QUERIES["op9_quality_model"](spark, sf_dir).join(
        spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) > 0.9 * len(rows)
    labels = spark.createDataFrame([(1, 1, None), (None, 0, None)], "doc_id long, quality int, toxic int")
    model, described = quality_model.fit(odd, labels.filter("false"))
    assert {r["s"] for r in described.select(quality_model.score_of(model, F.col("statistics")).alias("s")).collect()} == {0.5}


def test_quality_stage_learns_from_documents_that_its_input_lacks(spark, small, sf_dir):
    """The input holds no example labelled as bad, and bad documents that no label covers."""
    verdicts = QUERIES["op9_quality_model"](spark, sf_dir).select("doc_id", "held_out", "predicted")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    rows = small.join(verdicts, "doc_id").join(labels, "doc_id", "left") \
        .filter("quality = 1 OR (held_out AND predicted = 0)")
    expected = sorted(r["doc_id"] for r in rows.filter("predicted = 1").collect())
    assert len(expected) < rows.count()
    kept = quality_model.quality_model_stage(spark, rows.select(small.columns), sf_dir)
    assert sorted(r["doc_id"] for r in kept.collect()) == expected


def test_rules_do_not_depend_on_their_order(odd):
    def verdicts(rules):
        rows = odd.select(F.coalesce("text", F.lit("")).alias("text"))
        return sorted((r["text"], r["failed_rule"] is None) for r in quality_rules.judged(rows, rules).collect())

    assert verdicts(quality_rules.RULES) == verdicts(quality_rules.RULES[::-1])
    assert quality_rules.cascade(odd).count() == len(ODD)


def test_empty_tables(spark, odd, sf_dir):
    none = odd.filter("false")
    assert sharding.shard_rows(none).count() == 0
    assert bpe.encode_decode(none, BYTE_BPE).count() == 0
    assert packing.packed_documents(none, BYTE_BPE).count() == 0
    assert near_dedup.near_duplicates(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert bm25.search(none, none).count() == 0
    assert language.identify(none, language.learn(none)).count() == 0
    assert quality_rules.cascade(none).count() == 0


def test_crc_of_ids():
    from salesmart.llm.common import crc32_of_ids
    assert crc32_of_ids([1, 2]) == zlib.crc32(b"\1\0\0\0\2\0\0\0")
