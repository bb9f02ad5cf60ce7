"""Byte-level BPE encoding and decoding by batched numpy merge rounds.

The distinct words of a batch lie one after the other in a flat array of symbols. A round looks
up the rank of every adjacent pair by binary search in the sorted pair keys, takes each word's
lowest rank and merges its pairs of that rank, for all words at once. Only pairs beside a merge
are looked up again; finished words leave the array. Words met before come from a memo of
bounded size.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from salesmart.llm.common import by_bytes, documents

#: Words a task remembers with their ids; then it starts anew.
MEMO_WORDS = 200_000
NO_RANK = np.iinfo(np.int64).max


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file.

    Printable Latin-1 bytes stand for themselves, the others for the characters from 256 on.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


# The classes \\p{L}, \\p{N} and \\s within Latin-1.
LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
SPACE = "\t-\r \x85\xa0"


class Splitter:
    """Finds a pattern's matches; the standard library's engine does it for Latin-1 texts."""

    def __init__(self, pattern: str, latin: str):
        self.general, self.latin = regex.compile(pattern), re.compile(latin)
        self.unknown = unassigned()

    def odd(self, text: str) -> bool:
        """Whether a character may be classed otherwise by other libraries."""
        if is_latin(text):
            return False
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return bool(self.unknown[points].any())

    def matches(self, text: str) -> list[str]:
        return (self.latin if is_latin(text) else self.general).findall(text)


def is_latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


#: The pattern of byte-level vocabularies, for Latin-1.
LATIN_PATTERN = (f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+"
                 f"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def unassigned() -> np.ndarray:
    """Code points that this Python's Unicode does not know; libraries may class them otherwise."""
    return np.array([unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)])


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of runs of ``lengths`` beginning at ``starts``, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


class Table:
    """Runs of numbers of different lengths, found by their place."""

    def __init__(self, flat: np.ndarray, lengths: np.ndarray):
        self.flat, self.lengths = flat, np.asarray(lengths, np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.lengths[places]
        return self.flat[gather(self.starts[places], lengths)], lengths

    def extended(self, other: Table) -> Table:
        return Table(np.concatenate([self.flat, other.flat]),
                     np.concatenate([self.lengths, other.lengths]))


class Merges:
    """The vocabulary's merges as sorted pair keys."""

    def __init__(self, model: dict):
        vocab = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def apply(self, symbols: np.ndarray, lengths: np.ndarray) -> Table:
        """Merge words given as flat symbols; every word has one symbol at least."""
        words, done = np.arange(len(lengths)), []
        symbols, lengths = symbols.astype(np.int64), np.asarray(lengths, np.int64)
        starts = np.cumsum(lengths) - lengths
        ranks = np.full(len(symbols), NO_RANK)
        if len(symbols) > 1:
            ranks[:-1] = self.rank(symbols[:-1], symbols[1:])
        ranks[starts + lengths - 1] = NO_RANK
        while len(words):
            best = np.minimum.reduceat(ranks, starts)
            over = best == NO_RANK
            if over.any():
                out = np.repeat(over, lengths)
                done.append((words[over], symbols[out], lengths[over]))
                words, best, lengths = words[~over], best[~over], lengths[~over]
                symbols, ranks = symbols[~out], ranks[~out]
                starts = np.cumsum(lengths) - lengths
                if not len(words):
                    break
            chosen = ranks == np.repeat(best, lengths)
            at = np.flatnonzero(chosen)
            # In a run of overlapping pairs (one symbol repeated) every second one merges.
            begins = np.concatenate([[True], np.diff(at) != 1])
            run_start = np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run_start) % 2 == 0]
            symbols[at] = self.made[ranks[at]]
            # The right half goes; where it ended its word, the merged symbol does now.
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            lengths = np.add.reduceat(keep, starts, dtype=np.int64)
            moved = (np.cumsum(keep) - 1)[at]
            symbols, ranks = symbols[keep], ranks[keep]
            starts = np.cumsum(lengths) - lengths
            last = np.zeros(len(symbols), bool)
            last[starts + lengths - 1] = True
            first = np.zeros(len(symbols), bool)
            first[starts] = True
            again = np.concatenate([moved, (moved - 1)[~first[moved]]])
            ranks[again] = NO_RANK
            again = again[~last[again]]
            ranks[again] = self.rank(symbols[again], symbols[again + 1])
        order = np.concatenate([d[0] for d in done]) if done else np.zeros(0, np.int64)
        table = Table(np.concatenate([d[1] for d in done] or [np.zeros(0, np.int64)]),
                      np.concatenate([d[2] for d in done] or [np.zeros(0, np.int64)]))
        return Table(*table.take(np.argsort(order)))


class ByteBpe:
    """Encoder and decoder for one vocabulary file of the byte-level kind."""

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, letters = spec["model"]["vocab"], byte_characters()
        self.merges = Merges(spec["model"])
        self.byte_ids = np.array([vocab[c] for c in letters], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.splitter = Splitter(public_tokenizers.PATTERN, LATIN_PATTERN)
        self.library = Tokenizer.from_file(path)
        self.memo_words = memo_words
        self.forget()
        byte_of = {c: b for b, c in enumerate(letters)}
        pieces = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items() if t not in self.special}
        pieces |= {i: t.encode() for t, i in self.special.items()}
        spelled = [pieces.get(i, b"") for i in range(max(pieces) + 1)]
        self.spelled = Table(np.frombuffer(b"".join(spelled), np.uint8), list(map(len, spelled)))

    def forget(self) -> None:
        # Special tokens have the first places and ids of their own.
        self.places = defaultdict(None, {t: k for k, t in enumerate(self.special)})
        self.places.default_factory = self.places.__len__  # a new word has the next place
        self.ids = Table(np.array(list(self.special.values()), np.int64), [1] * len(self.special))

    def words(self, text: str) -> list[str]:
        if self.splitter.odd(text):  # the library's own splitter decides on characters of a newer Unicode
            at = [x for _, x in self.library.pre_tokenizer.pre_tokenize_str(text)]
            return [text[a:b] for a, b in at]
        return self.splitter.matches(text)

    def split(self, text: str) -> list[str]:
        if not any(t in text for t in self.special):
            return self.words(text)
        found = []
        for k, part in enumerate(self.special_split.split(text)):
            found += [part] if k % 2 else self.words(part)
        return found

    def symbols(self, words: list[bytes]) -> np.ndarray:
        return self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]

    def encode(self, texts: list[str]) -> Table:
        """The ids of each text."""
        if len(self.places) > self.memo_words:
            self.forget()
        places, known, counts, flat = self.places, len(self.places), [], []
        for text in texts:
            words = self.split(text) if text else []
            counts.append(len(words))
            flat += map(places.__getitem__, words)
        new = [w.encode() for w in islice(places, known, None)]
        if new:
            sizes = np.fromiter(map(len, new), np.int64, len(new))
            self.ids = self.ids.extended(self.merges.apply(self.symbols(new), sizes))
        ids, lengths = self.ids.take(np.fromiter(flat, np.int64, len(flat)))
        upto = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.cumsum(np.array(counts, np.int64))
        return Table(ids, upto[ends] - upto[ends - np.array(counts, np.int64)])

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the text that ``ids`` spell; invalid bytes become replacement characters."""
        return self.spelled.take(ids)[0].tobytes().decode("utf-8", "replace").encode()


RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """Encode every text of ``docs`` (doc_id, text), decode the ids, and return digests of both.

    A NULL text counts as empty and has no ids; NULL or repeated doc_ids are kept as they are.
    Rows are independent of each other; other columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(path)
        for batch in by_bytes(batches):
            table = bpe.encode([t or "" for t in batch.column("text").to_pylist()])
            parts = [table.flat[a:a + n] for a, n in zip(table.starts, table.lengths, strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(table.lengths, pa.int64()),
                pa.array([hashlib.sha256(p.astype("<u4").tobytes()).hexdigest() for p in parts]),
                pa.array([hashlib.sha256(bpe.decode(p)).hexdigest() for p in parts]),
            ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text").mapInArrow(run, RESULT)


def op2_bpe(spark, sf_dir: str) -> DataFrame:
    """Encode and decode all documents."""
    return encode_decode(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
