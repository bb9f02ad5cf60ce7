"""Chat formatting, whitening and collocations against plain versions and odd inputs."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.llm import chat, collocations, whitening
from salesmart.llm.queries import QUERIES

LOG = "conv_id long, seq long, message long, kind string, role string, text string, start long, loss int, n int"


def log_of(spark, events):
    rows = [(*e, None, None, None) for e in events]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, LOG)


def replay(events):
    """The final (role, text) of each conversation's messages, event after event."""
    state: dict = {}
    for conv, seq, number, kind, role, text in sorted(
            events, key=lambda e: (e[1], e[3] or "", e[4] or "", e[5] or "")):
        messages = state.setdefault(conv, {})
        if kind == "message":
            messages[number] = [role or "", text or ""]
        elif kind == "regenerate":
            for later in [m for m in messages if m > number]:
                del messages[later]
            if number in messages:
                messages[number][1] = text or ""
        elif number in messages and kind == "edit":
            messages[number][1] = text or ""
        elif number in messages and kind == "delta":
            messages[number][1] += text or ""
    return {c: [tuple(m[n]) for n in sorted(m)] for c, m in state.items() if m}


def plain_digest(turns):
    whole = "".join(f"{role}\n{text}\n" for role, text in turns)
    trained = "".join(text for role, text in turns if role == "assistant")
    return (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(trained),
            hashlib.sha256(trained.encode()).hexdigest())


def digests(log):
    rows = chat.read_back(chat.chat_format(log)).collect()
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in rows}


SNIPPETS = ["", "plain words ", "### assistant: ", "</turn>\n", "\\", "\\### user: </turn> ", "#", "<", "ü\U0001f600", ": "]


def random_log(seed, conversations=40, events=30):
    rng, log = random.Random(seed), []
    for conv in range(conversations):
        opened = 0
        for seq in range(rng.randrange(1, events)):
            kind = rng.choice(["message", "delta", "delta", "delta", "edit", "regenerate"])
            if kind == "message":
                opened += 1
                number, role = opened, rng.choice(["user", "assistant", "sys:tem", "#\\x"])
            else:
                number, role = rng.randrange(1, opened + 2), None
            log.append((conv, seq, number, kind, role, "".join(rng.choices(SNIPPETS, k=3))))
            if kind == "regenerate":
                opened = min(opened, number)
    return log


def test_a_log_folds_as_if_replayed(spark):
    log = random_log(3)
    expected = {c: plain_digest(t) for c, t in replay(log).items()}
    assert len(expected) > 30 and digests(log_of(spark, log)) == expected


def test_edits_keep_and_regenerations_discard_later_messages(spark):
    log = [
        (1, 1, 1, "message", "user", "Hi"), (1, 2, 2, "message", "assistant", ""), (1, 3, 2, "delta", None, "Hel"),
        (1, 4, 2, "delta", None, "lo"), (1, 5, 3, "message", "user", "And?"), (1, 6, 1, "edit", None, "Hi there"),
        (2, 1, 1, "message", "user", "Hi"), (2, 2, 2, "message", "assistant", "No"), (2, 3, 3, "message", "user", "x"),
        (2, 4, 2, "regenerate", None, None), (2, 5, 2, "delta", None, "Yes"), (2, 6, 3, "delta", None, "lost"),
    ]
    formatted = chat.chat_format(log_of(spark, log)).collect()
    text = {c: "".join(r["formatted"] for r in formatted if r["conv_id"] == c) for c in (1, 2)}
    assert text[1] == "### user: Hi there</turn>\n### assistant: Hello</turn>\n### user: And?</turn>\n"
    assert text[2] == "### user: Hi</turn>\n### assistant: Yes</turn>\n"
    spans = [(s["start"], s["stop"]) for r in formatted if r["conv_id"] == 2 for s in r["loss"]]
    assert [text[2][a:b] for a, b in spans] == ["Yes"]


def test_chat_takes_odd_logs(spark):
    log = [
        (None, None, None, "message", None, None), (None, 1, None, "delta", None, "x"), (5, 1, 1, "delta", None, "stray"),
        (6, 1, 1, "noise", "user", "y"), (7, 1, 1, "message", "assistant", "z" * 200_000), (7, 2, 1, "delta", None, "end"),
        (7, 2, 1, "delta", None, "end"), (8, 1, 1, "message", "user", "b"), (8, 1, 1, "message", "user", "a"),
    ]
    expected = {c: plain_digest(t) for c, t in {
        None: [("", "x")], 7: [("assistant", "z" * 200_000 + "endend")], 8: [("user", "b")]}.items()}
    assert digests(log_of(spark, log)) == expected
    assert digests(spark.createDataFrame([], LOG)) == {}


def test_long_conversations_come_in_segments(spark):
    log = [(1, 0, 1, "message", "assistant", "")] + [(1, k, 1, "delta", None, f"<{k}>" * 50) for k in range(1, 2000)]
    rows = chat.chat_format(log_of(spark, log)).collect()
    assert len(rows) > 3 and [r["segment"] for r in rows] == list(range(len(rows)))
    sizes = np.cumsum([0] + [len(r["formatted"]) for r in rows])
    assert [r["start"] for r in rows] == sizes[:-1].tolist() and max(np.diff(sizes)) < 2 * chat.SEGMENT
    again = chat.read_back(spark.createDataFrame(rows).orderBy(F.desc("segment")), in_order=False).collect()
    assert tuple(again[0])[1:5] == plain_digest([("assistant", "".join(f"<{k}>" * 50 for k in range(1, 2000)))])


def test_repeated_turns_are_turns_of_their_own(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (2, 1, "assistant", "t" * 2000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    expected = {1: plain_digest([("", ""), ("user", "a"), ("user", "a"), ("user", "b")]), 2: plain_digest([("assistant", "t" * 2000)])}
    assert digests(chat.turn_log(turns)) == expected


# ---- Whitening ----

VECTORS = "vec_id long, embedding array<float>, label int, n long, x int, whitened double"


def vectors_of(spark, vectors):
    return spark.createDataFrame([(i, v, None, None, None, None) for i, v in vectors], VECTORS)


def whitened_plainly(vectors, components=16):
    """Fit list, deviations and components by plain integers and a library's eigenvectors."""
    x = [(i, [int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v]) for i, v in vectors]
    fit = sorted({tuple(v) for _, v in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    y = np.array([[n * a - s for a, s in zip(v, sums, strict=True)] for v in fit], float) / n
    values, unit = np.linalg.eigh(y.T @ y / n)
    values, unit = values[::-1], unit[:, ::-1]
    out = {}
    for i, v in x:
        far = [n * a - s for a, s in zip(v, sums, strict=True)]
        z = np.array(far, float) / n @ unit[:, :components] / np.sqrt(values[:components])
        out[i] = (n, sum(f * f for f in far), z, values[:components] / values.sum())
    return out


@pytest.mark.parametrize("offset", [0.0, 3e4])
def test_whitening_matches_plain_eigenvectors(spark, offset):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((300, 20)) @ np.diag(np.linspace(9, 1, 20)) + offset
    vectors = [(k, base[k % 250].tolist()) for k in range(300)]
    expected = whitened_plainly(vectors)
    rows = whitening.whiten(vectors_of(spark, vectors)).collect()
    assert len(rows) == 300 * 16
    got = collections.defaultdict(dict)
    for r in rows:
        got[r["vec_id"]][r["component"]] = r
    signs = None
    for i, (n, deviation, z, explained) in expected.items():
        mine = np.array([got[i][c]["whitened"] for c in range(1, 17)])
        signs = np.sign(mine * z) if signs is None else signs
        assert np.allclose(mine, z * signs, atol=1e-7)
        assert {(r["n"], r["deviation"]) for r in got[i].values()} == {(n, deviation)}
        assert np.allclose([got[i][c]["explained"] for c in range(1, 17)], explained, rtol=1e-6)
    assert rows[0]["identity_error"] < 1e-8


@pytest.mark.parametrize("kind", ["random", "repeated", "rank", "falling", "diagonal", "equal"])
def test_components_match_library_eigenvalues(kind):
    rng = np.random.default_rng(2)
    turn = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    values = {"random": rng.random(40), "repeated": np.repeat([4.0, 2, 2, 1], 10), "rank": np.r_[np.ones(3), np.zeros(37)],
              "falling": 10.0 ** -np.arange(40), "diagonal": np.arange(40.0), "equal": np.ones(40)}[kind]
    a = np.diag(values) if kind == "diagonal" else turn @ np.diag(values) @ turn.T
    found, unit = whitening.components_of(a)
    assert np.allclose(found, np.sort(values)[::-1], atol=1e-13 * max(values) * 40)
    assert np.allclose(unit.T @ unit, np.eye(40), atol=1e-12)
    assert np.allclose(a @ unit, unit * found, atol=1e-12 * max(values))


def test_whitening_takes_odd_vectors(spark):
    rng = np.random.default_rng(1)
    good = [(k % 30, rng.standard_normal(3).tolist()) for k in range(40)]
    odd = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [1.0, float("nan"), 2.0]), (94, [float("inf"), 0.0, 0.0]),
           (95, [1.0, 2.0]), (None, good[0][1])]
    rows = whitening.whiten(vectors_of(spark, good + odd)).collect()
    assert len(rows) == 41 * 3 and {r["vec_id"] for r in rows} == {*range(30), None}
    assert {r["n"] for r in rows} == {40}
    for none in ([], [(1, [2.0, 3.0])] * 5, odd[:4]):
        assert whitening.whiten(vectors_of(spark, none)).collect() == []
    huge = whitening.whiten(vectors_of(spark, [*good, (99, [3e38, 0.0, 0.0])])).collect()
    assert len(huge) >= 41 and all(r["deviation"] is None for r in huge if r["vec_id"] == 99)


# ---- Collocations ----


def collocations_plainly(rows, threshold, longest, top, percent=50):
    counts = collections.defaultdict(collections.Counter)
    totals = collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        plain = (text or "").encode().translate(collocations._PLAIN).decode()
        for piece in plain.split("\n"):
            words = [w for w in piece.split(" ") if w]
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i:i + size])] += 1
    result = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= threshold}
        covered = set()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    if 100 * a >= percent * f[p[i:i + size]]:
                        covered.add(p[i:i + size])
        ranked = []
        for p, a in candidates.items():
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if p not in covered:
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(result)


DOCS = "doc_id long, text string, lang string, phrase string, n long, rank int, a long"


def docs_of(spark, rows):
    return spark.createDataFrame([(1, text, lang, None, None, None, None) for lang, text in rows], DOCS)


def random_texts(seed, texts=400):
    rng = random.Random(seed)
    vocabulary = [w + s for w in ("the", "Of", "ünï", "data", "x y", "big", "\x00", "new york") for s in ("", "s", "ed")]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    return [(rng.choice(["en", "de", None]), "".join(
        w + rng.choice([" ", " ", " ", "\t", ". ", "\n", "  ", ", "]) for w in rng.choices(vocabulary, weights, k=rng.randrange(60))))
        for _ in range(texts)]


@pytest.mark.parametrize(("threshold", "longest", "top"), [(10, 3, 2000), (3, 4, 25)])
def test_collocations_match_plain_counts(spark, monkeypatch, threshold, longest, top):
    # Small sizes: many shares, many hash partitions, and summaries that have to give up counters.
    monkeypatch.setattr(collocations, "PARTITION_BYTES", 500)
    monkeypatch.setattr(collocations, "ENTRIES", 300)
    rows = random_texts(threshold)
    got = collocations.collocations(docs_of(spark, rows), threshold, longest, top).collect()
    assert sorted(map(tuple, got)) == collocations_plainly(rows, threshold, longest, top)


def test_summaries_keep_what_is_frequent():
    rng = np.random.default_rng(4)
    stream = np.concatenate([np.repeat(np.arange(20), 30), rng.integers(100, 100_000, 30_000)])
    rng.shuffle(stream)
    capacity = len(stream) // 30 + 1
    keys, counts, taken = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    for share in np.array_split(stream, 40):
        more, n = np.unique(share, return_counts=True)
        keys, counts, off = collocations.summary(*collocations.added([keys, more], [counts, n]), capacity)
        taken += off
        assert len(keys) <= capacity
    assert 0 < taken < 30 and set(range(20)) <= set(keys.tolist())
    true = np.array([(stream == k).sum() for k in keys.tolist()])
    assert (counts <= true).all() and (true <= counts + taken).all()


def test_collocations_take_odd_texts(spark):
    text = "new york city is, new york city "
    rows = [("en", text * 10), ("en", None), (None, ""), ("en", " \t\n.,"), (None, "a b " * 5000), ("", "a b " * 12)]
    got = collocations.collocations(docs_of(spark, rows)).collect()
    assert sorted(map(tuple, got)) == collocations_plainly(rows, 10, 3, 2000)
    assert collocations.collocations(docs_of(spark, [])).collect() == []
    assert collocations.collocations(docs_of(spark, rows[1:4])).collect() == []


@pytest.mark.parametrize(("name", "columns"), [
    ("op11_chat", "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars"),
    ("op12_whitening", "vec_id component n deviation whitened explained identity_error"),
    ("op13_collocations", "lang rank phrase a l r n score"),
])
def test_queries_return_their_columns(spark, sf_dir, name, columns):
    assert QUERIES[name](spark, sf_dir).columns == columns.split()
