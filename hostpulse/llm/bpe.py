"""Byte-pair encoding with word ends, and decoding, by batched merge rounds.

The symbols of all new words of a batch lie in one flat array. Each round looks up every neighbouring pair by
binary search in the sorted pair keys, takes the lowest rank of each word and merges all its places at once, from
left to right. Words without a known pair leave the array. Merging all places of the lowest rank together gives
the result of one-by-one merging, since a pair that contains a merged symbol always has a higher rank.

Letters that are newer than the library's Unicode tables may be cut otherwise than there; all others are cut alike.
Null texts count as empty and give no ids. Special tokens in a text become their own id, as the library does.
Very long texts and words are encoded whole. Repeated rows give repeated results; columns besides the id and
the text are ignored.
"""

from __future__ import annotations

import hashlib
import json
import pickle
import re
import unicodedata
from collections.abc import Iterator
from itertools import islice
from operator import add

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from hostpulse.llm import common

#: Words, and pieces of words, whose ids a worker remembers, some 200 MB each; beyond it, it forgets the later half. The
#: earlier half holds the frequent ones, which come up first.
CACHED_WORDS = 1_000_000
_NONE = np.int64(1) << 60
_CONTROLS = re.compile("[\x1c-\x1f]")
_BLANKS = regex.compile(r"[^\S\x1c-\x1f]+")


def _trim(known: dict) -> None:
    if len(known) > CACHED_WORDS:
        early = list(islice(known.items(), CACHED_WORDS // 2))
        known.clear()
        known.update(early)


class Vocabulary:
    """The tables of a tokenizer file, read on the driver and sent with the job; its size is that of the file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        ids = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in content["added_tokens"] if t["special"]}
        self.pattern = content["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.size = max([*ids.values(), *self.special.values()]) + 1
        names = {number: name for name, number in (ids | self.special).items()}
        self.names = [names.get(number, "").encode() for number in range(self.size)]
        suffix = model["end_of_word_suffix"]
        letters = _byte_letters()
        self.inner = np.array([ids[c] for c in letters], np.int64)
        self.final = np.array([ids[c + suffix] for c in letters], np.int64)
        left = np.array([ids[a] for a, _ in model["merges"]], np.int64)
        right = np.array([ids[b] for _, b in model["merges"]], np.int64)
        self.merged = np.array([ids[a + b] for a, b in model["merges"]], np.int64)
        keys = left * self.size + right
        self.ranks = np.argsort(keys, kind="stable")
        self.keys = keys[self.ranks]


def _byte_letters() -> list[str]:
    """The printable letter of each byte: itself where it is visible Latin-1, else the next letter from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, spare = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in visible else spare))
        spare += byte not in visible
    return letters


class Encoder:
    """Encodes texts with a vocabulary; remembers the ids of words it has seen, within `CACHED_WORDS`."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.pieces = regex.compile(vocabulary.pattern)
        self.special = re.compile("(" + "|".join(map(re.escape, vocabulary.special)) + ")")
        self.known: dict[str, bytes] = {}
        self.known_pieces: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        parts = [self._words(text) for text in texts]
        _trim(self.known)
        new = set().union(*parts).difference(self.known)
        self._learn(list(new))
        return [b"".join(map(self.known.__getitem__, words)) for words in parts]

    def decode(self, ids: np.ndarray) -> bytes:
        """The names of the ids with a space between, in UTF-8, special tokens included."""
        return b" ".join(map(self.v.names.__getitem__, ids.tolist()))

    def _words(self, text: str) -> list[str]:
        """The text cut at white space, special tokens apart. No piece of the pattern crosses white space."""
        if "<|" in text and self.v.special:
            return [
                word
                for part in self.special.split(text)
                for word in ([part] if part in self.v.special else _split(part))
            ]
        return _split(text)

    def _learn(self, words: list[str]) -> None:
        _trim(self.known_pieces)
        ids, special = self.known_pieces, self.v.special
        # Most words are one piece, or one and a mark; they are kept in plain lists, as an object for each would cost more than the rest.
        whole, whole_pieces, marked, heads, marks, others = [], [], [], [], [], []
        for word in words:
            if word in special:
                self.known[word] = np.array([special[word]], "<u4").tobytes()
                continue
            # The library lowers letter by letter, without the special form of a final sigma.
            plain = word.lower() if word.isascii() else unicodedata.normalize("NFC", word).replace("Σ", "σ").lower()
            if plain.isalpha():  # all letters, so the pattern takes it whole
                whole.append(word)
                whole_pieces.append(plain)
            elif plain[-1] in ".,!" and plain[:-1].isalpha():
                marked.append(word)
                heads.append(plain[:-1])
                marks.append(plain[-1])
            else:
                others.append((word, self.pieces.findall(plain)))
        new = set(whole_pieces).union(heads, marks, *(found for _, found in others)).difference(ids)
        order = list(new)
        ids.update(zip(order, self.merge([piece.encode() for piece in order])))
        of = ids.__getitem__
        self.known.update(zip(whole, map(of, whole_pieces)))
        self.known.update(zip(marked, map(add, map(of, heads), map(of, marks))))
        self.known.update((word, b"".join(map(of, found))) for word, found in others)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, all words together in rounds."""
        if not words:
            return []
        v = self.v
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(lengths)
        symbols = v.inner[flat]
        symbols[ends - 1] = v.final[flat[ends - 1]]
        owner = np.repeat(np.arange(len(words)), lengths)
        done_owner, done_symbols = [], []

        def look_up(places: np.ndarray) -> None:
            """Ranks of the pairs that begin at these places; none at the end of a word."""
            rank[places] = _NONE
            places = places[places < len(symbols) - 1]
            places = places[owner[places] == owner[places + 1]]
            pair = symbols[places] * v.size + symbols[places + 1]
            found = np.minimum(np.searchsorted(v.keys, pair), len(v.keys) - 1)
            same = v.keys[found] == pair
            rank[places[same]] = v.ranks[found[same]]

        rank = np.empty(len(symbols), np.int64)
        look_up(np.arange(len(symbols)))
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(symbols)]))
            ended = best == _NONE
            if ended.any():
                done_owner.append(owner[ended])
                done_symbols.append(symbols[ended])
            hits = np.flatnonzero((rank == best) & ~ended)
            # Of hits in a row (as in "aaa") every second one overlaps the one before it.
            first = np.r_[True, np.diff(hits) != 1] if len(hits) else np.zeros(0, bool)
            run = np.maximum.accumulate(np.where(first, np.arange(len(hits)), 0)) if len(hits) else hits
            hits = hits[(np.arange(len(hits)) - run) % 2 == 0]
            symbols[hits] = v.merged[rank[hits]]
            keep = ~ended
            keep[hits + 1] = False
            place = np.cumsum(keep) - 1
            symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
            # Only pairs with a new symbol have another rank.
            new = place[hits]
            look_up(np.concatenate([new, new[new > 0] - 1]))
        owner, symbols = np.concatenate(done_owner), np.concatenate(done_symbols).astype("<u4")
        order = np.argsort(owner, kind="stable")
        counts = np.bincount(owner, minlength=len(words))
        data, stops = symbols[order].tobytes(), (np.cumsum(counts) * 4).tolist()
        return [data[a:b] for a, b in zip([0, *stops], stops)]


def _split(text: str) -> list[str]:
    """Words between white space. Four control characters count as letters here, but as blanks in `str.split`."""
    if not _CONTROLS.search(text):
        return text.split()
    return [word for word in _BLANKS.split(text) if word]


_encoders: dict[int, Encoder] = {}


def worker_encoder(sent) -> Encoder:
    """One encoder for a broadcast vocabulary and worker process."""
    if sent.id not in _encoders:
        _encoders[sent.id] = Encoder(sent.value)
    return _encoders[sent.id]


class _Sent:
    """A broadcast value with a number that worker processes can key their caches by.

    Broadcasts are pickled by reference, which needs the package on every executor; so the value goes out as bytes that carry its class.
    """

    def __init__(self, spark, value):
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
        self.id = self._sent._jbroadcast.id()
        self._value = value

    @property
    def value(self):
        if self._value is None:
            self._value = pickle.loads(self._sent.value)
        return self._value

    def __getstate__(self):
        return {"_sent": self._sent, "id": self.id, "_value": None}


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column and `ids`, an array of integers, for each row."""
    sent = _Sent(docs.sparkSession, Vocabulary(path))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(sent)
        for batch in batches:
            for part in common.slices(batch, text_col):
                rows = encoder.encode(common.texts_of(part, text_col))
                ends = np.cumsum([0, *(len(row) // 4 for row in rows)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(rows), "<i4")))
                yield pa.RecordBatch.from_arrays([part.column(id_col), ids], [id_col, "ids"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The id column and `text`, the decoded ids, for each row. Null ids give an empty text."""
    sent = _Sent(rows.sparkSession, Vocabulary(path))
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(sent)
        for batch in batches:
            texts = [
                encoder.decode(np.asarray(ids or [], np.int64)).decode()
                for ids in batch.column(ids_col).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(texts, pa.string())], [id_col, "text"])

    return rows.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, text string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes each text in one pass and returns the digests of both, without moving ids or texts on."""
    sent = _Sent(docs.sparkSession, Vocabulary(path))
    kind = docs.schema[id_col].dataType.simpleString()
    numbers = [str(n).encode() for n in range(len(sent.value.names))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(sent)
        for batch in batches:
            for part in common.slices(batch, text_col):
                counts, ids_hash, text_hash = [], [], []
                for row in encoder.encode(common.texts_of(part, text_col)):
                    ids = np.frombuffer(row, "<u4")
                    counts.append(len(ids))
                    ids_hash.append(hashlib.sha256(b" ".join(map(numbers.__getitem__, ids.tolist()))).hexdigest())
                    text_hash.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(id_col), pa.array(counts, pa.int64()), pa.array(ids_hash), pa.array(text_hash)],
                    [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(id_col, text_col).mapInArrow(run, schema)
