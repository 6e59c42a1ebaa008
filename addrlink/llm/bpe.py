"""Operator 7: byte-pair encoding and decoding with contiguous rank arrays.

A word is held as the ids between its part boundaries and, beside them, the
ranks of all adjacent pairs.  The smallest rank is found by a scan, its
boundary is deleted, the two neighbouring ranks are refreshed, until no pair
has a rank.  Short words of one length are the rows of one matrix and take each
step together; longer words use a heap over linked boundaries, since a scan per
merge would be quadratic.

Text is cut so that a cut piece always encodes alike: at special tokens, then
at single spaces (or white space, for vocabularies that drop it), then by the
vocabulary's pattern.  Pieces met before come from a dictionary of bounded
size; it saves time and decides nothing.

Cases: null text is the empty text (no ids); repeated rows and any other
columns pass through; an empty table gives an empty result; ids that the
vocabulary lacks raise an error on decoding.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import text_parts

#: Longest word (bytes) that is encoded in the matrices.
SHORT = 48
#: Entries of the dictionary of chunks from which it is begun anew.
KNOWN = 300_000
NONE = np.int32(2**31 - 1)

# fixed values of the byte-level vocabularies: the pieces of a text, and the
# bytes that stand for themselves; the others are shifted to 256 and up
SPACED = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
OWN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_chars() -> list[str]:
    """The character that stands for each byte in the vocabulary."""
    out, n = [], 0
    for b in range(256):
        out.append(chr(b) if b in OWN_BYTES else chr(256 + n))
        n += b not in OWN_BYTES
    return out


class Numbers(dict):
    """Numbers of chunks, given out at the first look-up, and the ids of every number."""

    def __init__(self):
        self.new: list[str] = []  # without ids so far
        self.ids = np.zeros(0, "<u4")
        self.start = self.size = np.zeros(0, np.int64)

    def __missing__(self, chunk: str) -> int:
        self.new.append(chunk)
        n = self[chunk] = len(self)
        return n

    def settle(self, ids: list[bytes]) -> None:
        """Take the ids of the new chunks."""
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        self.start = np.r_[self.start, len(self.ids) + np.cumsum(size) - size]
        self.size = np.r_[self.size, size]
        self.ids = np.r_[self.ids, np.frombuffer(b"".join(ids), "<u4")]
        self.new = []


class Vocabulary:
    """Encoder and decoder of one tokenizer file (its JSON text)."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        ids, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        chars = byte_chars()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = (re.compile("(" + "|".join(
            re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")")
            if self.special else None)
        # white space is dropped, and letters are lower-cased, where the file says so
        self.drops_space = spec["pre_tokenizer"]["type"] != "ByteLevel"
        self.pattern = regex.compile(
            spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] if self.drops_space else SPACED)
        self.first = np.array([ids[c] for c in chars], np.int32)
        self.last = np.array([ids[c + suffix] for c in chars], np.int32)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int32)
        keys = np.array([ids[a] << 20 | ids[b] for a, b in pairs], np.int64)
        self.rank_of = {int(k): r for r, k in reversed(list(enumerate(keys)))}
        self._hash(keys)
        of_char = {c: b for b, c in enumerate(chars)}
        self.bytes_of: list[bytes | None] = [None] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in ids.items():
            end = bool(suffix) and token.endswith(suffix)
            token = token.removesuffix(suffix) if end else token
            if all(c in of_char for c in token):
                self.bytes_of[i] = bytes(of_char[c] for c in token) + b" " * end
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.chunks = Numbers()

    # -- ranks of pairs: a hash table that numpy looks up for whole arrays

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64)

    def _hash(self, keys: np.ndarray) -> None:
        self.table = np.full(1 << 20, -1, np.int64)
        self.table_rank = np.full(1 << 20, NONE, np.int32)
        for rank, (key, at) in enumerate(zip(keys.tolist(), self._slot(keys).tolist())):
            while self.table[at] not in (-1, key):
                at = at + 1 & (1 << 20) - 1
            if self.table[at] == -1:
                self.table[at], self.table_rank[at] = key, rank

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 20 | right
        at = self._slot(keys)
        held = self.table[at]
        out = np.where(held == keys, self.table_rank[at], NONE)
        more = np.flatnonzero((held != keys) & (held != -1))
        while len(more):
            at[more] = at[more] + 1 & (1 << 20) - 1
            held = self.table[at[more]]
            hit = held == keys[more]
            out[more[hit]] = self.table_rank[at[more[hit]]]
            more = more[~hit & (held != -1)]
        return out

    # -- merging

    def merge_short(self, words: np.ndarray) -> list[bytes]:
        """Ids (little-endian, 4 bytes each) of words of one length: a matrix of bytes."""
        n, length = words.shape
        ids = self.first[words]
        ids[:, -1] = self.last[words[:, -1]]
        rank = np.full((n, length), NONE, np.int32)  # of the part and the next one
        if length > 1:
            rank[:, :-1] = self.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, -1)
        size = np.full(n, length)
        done, row = np.zeros((n, length), np.int32), np.arange(n)
        cols = np.arange(length)
        while len(row):
            at = rank.argmin(axis=1)
            here = np.arange(len(row))
            least = rank[here, at]
            ended = least == NONE
            if ended.any():
                done[row[ended], :ids.shape[1]] = ids[ended]
                go = ~ended
                ids, rank, row, at, least = ids[go], rank[go], row[go], at[go], least[go]
                if not len(row):
                    break
                here = np.arange(len(row))
            ids[here, at] = self.merged[least]
            # delete the boundary after ``at``: what follows moves one place left
            width = ids.shape[1]
            move = cols[:width - 1] > at[:, None]
            ids[:, :-1] = np.where(move, ids[:, 1:], ids[:, :-1])
            rank[:, :-1] = np.where(cols[:width - 1] >= at[:, None], rank[:, 1:], rank[:, :-1])
            rank[:, -1] = NONE
            size[row] -= 1
            left = np.flatnonzero(at > 0)
            rank[left, at[left] - 1] = self.ranks(ids[left, at[left] - 1], ids[left, at[left]])
            right = np.flatnonzero(at + 1 < size[row])
            rank[right, at[right]] = self.ranks(ids[right, at[right]], ids[right, at[right] + 1])
            ids, rank = ids[:, :-1], rank[:, :-1]
        raw, width = done.astype("<u4").tobytes(), 4 * length
        return [raw[i * width:i * width + 4 * s] for i, s in enumerate(size.tolist())]

    def merge_long(self, word: bytes) -> bytes:
        """The same by a heap of (rank, place) over linked boundaries."""
        ids = self.first[np.frombuffer(word, np.uint8)].tolist()
        ids[-1] = int(self.last[word[-1]])
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        get, merged = self.rank_of.get, self.merged
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1)
                if (r := get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue  # one of the two was merged meanwhile
            ids[i], ids[j], after[i] = int(merged[r]), -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := get(ids[x] << 20 | ids[y])) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of every word (pieces of the pattern)."""
        out: list[bytes] = [b""] * len(words)
        held = pa.array(words, pa.string())  # all words in one buffer
        ends = np.frombuffer(held.buffers()[1], np.int32)[:len(words) + 1]
        data = np.frombuffer(held.buffers()[2] or b"", np.uint8)
        sizes = np.diff(ends)
        order = np.argsort(sizes, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
            length = int(sizes[group[0]]) if len(group) else 0
            for k in range(0, len(group) if length else 0, 50_000):
                part = group[k:k + 50_000]
                if length > SHORT:
                    ids = [self.merge_long(words[i].encode()) for i in part]
                else:
                    ids = self.merge_short(data[ends[part][:, None] + np.arange(length)])
                for i, b in zip(part.tolist(), ids):
                    out[i] = b
        return out

    # -- whole texts

    def normal(self, text: str) -> str:
        """NFC and lower case letter by letter (a final sigma gets no form of its own)."""
        if not self.drops_space:
            return text
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:
                text = text.replace("Σ", "σ")
        return text.lower()

    def cut(self, text: str) -> list[str]:
        """Chunks of a text without special tokens; each encodes alike wherever it stands."""
        text = self.normal(text)
        if self.drops_space:
            # what str.split takes for white space and the pattern does not
            if any(c in text for c in "\x1c\x1d\x1e\x1f"):
                return self.pattern.findall(text)
            return text.split()
        first, *rest = text.split(" ")
        if all(rest) and (not first or not first[-1].isspace()):
            chunks = [first] * bool(first) + [" " + p for p in rest]
            if not any(p[1:2].isspace() or p[-1].isspace() for p in chunks):
                return chunks
        return self.pattern.findall(text)

    def encode_chunks(self, new: list[str]) -> list[bytes]:
        """Ids of every chunk."""
        # a run of letters is one piece, and a mark after it another: no need of the pattern
        skip, special = (0 if self.drops_space else 1), self.special
        out: list[bytes | None] = [None] * len(new)
        words, marked, pieces = [], [], []
        for i, c in enumerate(new):
            if c[skip:].isalpha() and (not skip or c[0] == " "):
                words.append(i)
            elif c[-1] in ".," and c[skip:-1].isalpha() and (not skip or c[0] == " "):
                marked.append(i)
            elif c in special:
                out[i] = special[c].to_bytes(4, "little")
            else:
                pieces.append((i, self.pattern.findall(c)))
        for i, ids in zip(words, self.encode_words([new[i] for i in words])):
            out[i] = ids
        rest = list({new[i][:-1] for i in marked} | {".", ","}.union(*[ps for _, ps in pieces]))
        of = dict(zip(rest, self.encode_words(rest)))
        for i in marked:
            out[i] = of[new[i][:-1]] + of[new[i][-1]]
        for i, ps in pieces:
            out[i] = b"".join([of[p] for p in ps])
        return out

    def encode_texts(self, batch: list[str]) -> list[bytes]:
        """Ids of every text, as little-endian unsigned 32-bit integers.

        Every chunk is looked up once, which gives its number; the ids of the
        texts are then gathered from those of the numbers in one step.
        """
        if len(self.chunks) > KNOWN:
            self.chunks = Numbers()
        known, special = self.chunks, self.special
        cut = []
        for text in batch:
            parts = [text]
            if special and any(s in text for s in special):
                parts = self.special_split.split(text)
            cut.append([c for p in parts for c in ([p] if p in special else self.cut(p))]
                       if len(parts) > 1 else self.cut(text))
        counts = list(map(len, cut))
        at = np.fromiter(map(known.__getitem__, chain.from_iterable(cut)), np.int64, sum(counts))
        known.settle(self.encode_chunks(known.new))
        n = known.size[at]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        ids = known.ids[np.repeat(known.start[at] - (ends - n), n) + np.arange(total)]
        until = np.r_[0, ends][np.cumsum([0, *counts])].tolist()
        return [ids[a:b].tobytes() for a, b in zip(until, until[1:])]

    def decode(self, ids: bytes) -> str:
        """Text of the ids; broken UTF-8 becomes U+FFFD."""
        of = self.bytes_of
        return b"".join([of[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


_loaded: dict[int, Vocabulary] = {}


def loaded(source: str) -> Vocabulary:
    """The vocabulary of a tokenizer file, built once per process."""
    key = hash(source)
    if key not in _loaded:
        _loaded[key] = Vocabulary(source)
    return _loaded[key]


def shared(spark: SparkSession, path: str):
    """The tokenizer file, read on the driver and sent to the executors (a few MB, whatever the corpus)."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(text: Column, vocabulary) -> Column:
    """Binary column of the ids of ``text`` (4 bytes each); ``vocabulary`` from ``shared``."""
    @pandas_udf("binary")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = loaded(vocabulary.value)
        for part in text_parts(batches):
            yield pd.Series(v.encode_texts(part), dtype=object)

    return ids(text)


def decode(ids: Column, vocabulary) -> Column:
    """Text of a column from ``encode``; null for null."""
    @pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = loaded(vocabulary.value)
        for batch in batches:
            yield pd.Series([None if b is None else v.decode(b) for b in batch], dtype=object)

    return text(ids)


def encode_decode(text: Column, vocabulary) -> Column:
    """Struct of ``ids`` as from ``encode`` and ``decoded``, the text they decode to, in one pass."""
    @pandas_udf("ids binary, decoded string")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        v = loaded(vocabulary.value)
        for part in text_parts(batches):
            ids = v.encode_texts(part)
            yield pd.DataFrame({"ids": ids, "decoded": [v.decode(b) for b in ids]}, dtype=object)

    return both(text)


def id_array(ids: Column) -> Column:
    """The ids of a column from ``encode`` as an array of longs."""
    byte = lambda at: F.conv(F.hex(F.substring(ids, at, 1)), 16, 10).cast("long")
    one = lambda i: sum((byte(4 * i + k + 1) * 256**k for k in range(1, 4)), byte(4 * i + 1))
    n = (F.octet_length(ids) / 4).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), one)).otherwise(
        F.array().cast("array<bigint>"))
