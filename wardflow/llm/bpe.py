"""Byte-level BPE encoding and decoding of whole texts.

A text is cut into pre-tokens by vectorised character classes; each pre-token is merged by a
segment tree (of ``FAN`` children a node) over the ranks of its adjacent pairs.  The root holds
the lowest rank, of equal ones the leftmost; a merge changes three leaves, each in logarithmic
time, until the root holds no mergeable pair.  A worker remembers the ids of pre-tokens it has
merged, a bounded number of them; texts are cut and their pre-tokens looked up as whole arrays.

Null texts count as empty and give no ids; repeated rows give repeated results; an empty table
gives an empty one.  Only the named text column is read.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.batches import per_text, raw

# Pre-tokens after which a worker forgets those it has met.  Bounds memory, not results.
MEMO = 1_000_000

# Pre-tokens that are encoded in one call.
BATCH = 256

# Places for pre-tokens of at most 15 bytes.  Such a one is two numbers: its first eight bytes, and
# the rest with its length.
_PLACES, _PADDING = 1 << 21, 16
_FIRST = np.array([(1 << 8 * min(k, 8)) - 1 for k in range(17)], np.uint64)
_SECOND = np.array([(1 << 8 * min(max(k - 8, 0), 7)) - 1 for k in range(17)], np.uint64)
_LENGTH = np.array([k << 56 for k in range(17)], np.uint64)

# Children of a segment-tree node.
FAN = 16

# The contractions that the published pre-tokenizer cuts off.
CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")

_LETTER, _NUMBER, _SPACE, _OTHER, _MARK, _BREAK = 0, 1, 2, 3, 4, 5

# Bytes that UTF-8 does not have: between parts of a text, for a special token, and after a text.
_PART_BYTE, _MARK_BYTE, _END_BYTE = 0xFD, 0xFE, 0xFF
_NONE = 1 << 62


def _byte_letters() -> dict[str, int]:
    """The published byte alphabet: printable bytes stand for themselves, the rest follow 255."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def character_classes() -> np.ndarray:
    """Letter, number, space or other for each code point."""
    kinds = np.full(0x110000, _OTHER, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\p{White_Space}+")):
        for first in range(0, 0x110000, 0x8000):
            points = "".join(
                "\0" if 0xD800 <= c < 0xE000 else chr(c) for c in range(first, first + 0x8000)
            )
            for found in regex.finditer(pattern, points):
                kinds[first + found.start() : first + found.end()] = kind
    return kinds


def kinds_of(data: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The class of each byte's character, for texts in UTF-8 with byte 255 after each."""
    table = classes[:256].copy()
    table[[_PART_BYTE, _MARK_BYTE, _END_BYTE]] = _BREAK, _MARK, _BREAK
    kind = table[data]
    lead = np.flatnonzero(data >= 0xC0)
    lead = lead[data[lead] < _PART_BYTE]
    if len(lead):
        first = data[lead]
        size = np.where(first < 0xE0, 2, np.where(first < 0xF0, 3, 4))
        points = first.astype(np.int32) & (0x7F >> size)
        for k in (1, 2, 3):
            more = np.flatnonzero(size > k)
            points[more] = points[more] << 6 | data[lead[more] + k] & 0x3F
        found = classes[points]
        for k in (0, 1, 2, 3):
            more = np.flatnonzero(size > k)
            kind[lead[more] + k] = found[more]
    return kind


def cut(data: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Starts of the pre-tokens of texts in UTF-8, with byte 255 after each.

    Bytes 253 and 255, and runs of bytes 254, are pre-tokens of their own.
    """
    n, kind = len(data), kinds_of(data, classes)
    first = np.ones(n + 1, bool)
    first[1:n] = kind[1:] != kind[:-1]
    breaks = np.flatnonzero(kind == _BREAK)
    first[breaks] = True
    # the last of some white space goes with what follows it, if it is a plain space
    space = kind == _SPACE
    last = np.flatnonzero(space[:-1] & (kind[1:] < _MARK) & ~space[1:])
    plain = data[last] == 0x20
    first[last[plain]] = True
    first[last[plain] + 1] = False
    lead = last[~plain]
    while len(lead):
        inner = data[lead] & 0xC0 == 0x80
        first[lead[~inner]] = True
        lead = lead[inner] - 1
    # contractions: an apostrophe that begins a pre-token, and the letters after it
    quotes = np.flatnonzero(data == 0x27)
    quotes = quotes[first[quotes]]
    quotes = quotes[kind[quotes + 1] == _LETTER]
    for at in quotes.tolist():
        a, b = int(data[at + 1]), int(data[at + 2])
        length = next(
            (
                len(c)
                for c in CONTRACTIONS
                if a == ord(c[0]) and (len(c) == 1 or b == ord(c[1]))
            ),
            0,
        )
        if length:
            first[at + 1] = False
            if kind[at + 1 + length] == _LETTER:
                first[at + 1 + length] = True
    return np.flatnonzero(first[:n])


class Bpe:
    """Encoder and decoder of one byte-level vocabulary in the tokenizers library's JSON."""

    def __init__(self, model: str):
        data = json.loads(model)
        letters = _byte_letters()
        vocabulary = data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        size = max([*vocabulary.values(), *self.special.values()]) + 1
        self.bytes = [b""] * size
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        single = {letters[t]: i for t, i in vocabulary.items() if len(t) == 1}
        self.single = [single[b] for b in range(256)]
        self.merges = {}
        for rank, pair in enumerate(data["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocabulary[a] << 32 | vocabulary[b]] = (rank, vocabulary[a + b])
        self.encode = Encoder(self.special, lambda tokens: [self.merge(t) for t in tokens])

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token."""
        single, merges = self.single, self.merges
        ids: list[int] = [single[b] for b in word]
        n = len(ids)
        if n == 1:
            return ids
        get = merges.get
        # leaf k: rank and place of the pair of position k and the position after it
        leaves = [
            found[0] << 32 | k if (found := get(ids[k] << 32 | ids[k + 1])) else _NONE
            for k in range(n - 1)
        ]
        tree = [leaves]  # a node of each level is the least of FAN nodes below
        while len(tree[-1]) > FAN:
            below = tree[-1]
            tree.append([min(below[k : k + FAN]) for k in range(0, len(below), FAN)])
        top = tree[-1]
        deep = len(tree) > 1
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while (low := min(top)) != _NONE:
            k = low & 0xFFFFFFFF
            gone = after[k]
            ids[k] = new = merges[ids[k] << 32 | ids[gone]][1]
            ids[gone] = -1
            after[k] = right = after[gone]
            if right < n:
                before[right] = k
                leaves[gone] = _NONE
                found = get(new << 32 | ids[right])
                leaves[k] = found[0] << 32 | k if found else _NONE
            else:
                leaves[k] = _NONE
            left = before[k]
            if left >= 0:
                found = get(ids[left] << 32 | new)
                leaves[left] = found[0] << 32 | left if found else _NONE
            if deep:
                for at in (left, k, gone):
                    if 0 <= at < n - 1:
                        _climb(tree, at)
        return [i for i in ids if i >= 0]

    def decode(self, ids: bytes) -> str:
        """The text of ids, special tokens included; broken UTF-8 becomes U+FFFD."""
        table = self.bytes
        found = b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()])
        return found.decode("utf-8", "replace")


def _climb(tree: list[list[int]], at: int) -> None:
    """Renew the nodes above leaf ``at``."""
    for below, level in zip(tree, tree[1:], strict=False):
        at //= FAN
        level[at] = min(below[at * FAN : (at + 1) * FAN])


class Encoder:
    """Encodes whole texts by their pre-tokens; ``ids_of`` gives the ids of each of a list of them.

    Each text is followed by the ids ``end``.
    """

    def __init__(
        self,
        special: dict[str, int],
        ids_of: Callable[[list[bytes]], list[list[int]]],
        end: tuple[int, ...] = (),
    ):
        self.special, self.ids_of = [s.encode() for s in special], ids_of
        self.classes = character_classes()
        self.splitter = regex.compile(b"(" + b"|".join(map(regex.escape, self.special)) + b")")
        self.fixed = {bytes([_MARK_BYTE]) * (k + 1): [i] for k, i in enumerate(special.values())}
        self.fixed |= {bytes([_PART_BYTE]): [], bytes([_END_BYTE]): list(end)}
        self.forget()

    def forget(self) -> None:
        """Remembers the fixed pre-tokens only.  A pre-token is known by its number, from 1."""
        self.number = np.zeros(_PLACES, np.int32)  # by hash, for pre-tokens of at most 15 bytes
        self.keys = [_Growing(np.uint64), _Growing(np.uint64)]
        self.long: dict[bytes, int] = {}
        self.ids, self.begin, self.size = _Growing(np.uint32), _Growing(np.int64), _Growing(np.int64)
        self.add([b""], [[]], False)
        self.add(list(self.fixed), list(self.fixed.values()))

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids, ends = self.flat(pa.array(texts, pa.string()))
        data, ends = ids.tobytes(), (4 * ends).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where those of each text end."""
        if len(texts) == 0:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        texts.validate(full=True)  # UTF-8
        if len(self.begin) > MEMO or len(self.ids) > 8 * MEMO:
            self.forget()
        padded = self.joined(texts)
        data = np.frombuffer(padded, np.uint8)[:-_PADDING]
        starts = cut(data, self.classes)
        numbers = self.numbers(padded, starts, np.diff(starts, append=len(data)))
        counts = self.size.values.take(numbers)
        stops = np.cumsum(counts)
        at = np.arange(int(stops[-1])) + np.repeat(self.begin.values.take(numbers) - stops + counts, counts)
        return self.ids.values.take(at), stops[data[starts] == _END_BYTE]

    def joined(self, texts: pa.Array) -> bytes:
        """UTF-8 of all texts, byte 255 after each; as many bytes 254 as its number for a special token."""
        data, at = raw(texts)
        data, parts, special = data.tobytes(), [], self.special
        found = any(s in data for s in special)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            text = data[a:b]
            if found and any(s in text for s in special):
                cuts = self.splitter.split(text)
                cuts[1::2] = [bytes([_MARK_BYTE]) * (special.index(s) + 1) for s in cuts[1::2]]
                text = bytes([_PART_BYTE]).join(cuts)
            parts.append(text)
        parts.append(bytes(_PADDING))
        return bytes([_END_BYTE]).join(parts)

    def numbers(self, data: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The number of each pre-token, given by its place; new ones are encoded."""
        eight = np.ascontiguousarray(np.ndarray((len(data) - 7,), "<u8", data, strides=(1,)))
        short = np.minimum(sizes, 16)
        first = eight.take(starts) & _FIRST.take(short)
        second = eight.take(starts + 8) & _SECOND.take(short) | _LENGTH.take(short)
        del eight
        out = self.placed(first, second)
        for k in np.flatnonzero(sizes > 15).tolist():
            out[k] = self.long.get(data[starts[k] : starts[k] + sizes[k]], 0)
        missing = np.flatnonzero(out == 0)
        if len(missing):
            a, b = starts[missing], starts[missing] + sizes[missing]
            tokens = [data[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
            places = dict(zip(reversed(tokens), reversed(missing.tolist()), strict=True))
            new, at = list(places), list(places.values())
            base = len(self.begin)
            for k in range(0, len(new), BATCH):
                self.add(new[k : k + BATCH], self.ids_of(new[k : k + BATCH]), False)
            self.place(first[at], second[at], sizes[at], base)
            self.long |= {t: base + k for k, t in enumerate(new) if 15 < len(t) <= 64}
            number = dict(zip(new, range(base, base + len(new)), strict=True))
            out[missing] = [number[t] for t in tokens]
        return out

    def add(self, tokens: list[bytes], ids: list[list[int]], place: bool = True) -> None:
        """Numbers for the next pre-tokens and their ids."""
        base, size = len(self.begin), np.fromiter(map(len, ids), np.int64, len(ids))
        self.begin.extend(len(self.ids) + np.cumsum(size) - size)
        self.size.extend(size)
        self.ids.extend(np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum())))
        if place:
            words = np.frombuffer(b"".join(t[:16].ljust(16, b"\0") for t in tokens), "<u8")
            sizes = np.array([min(len(t), 16) for t in tokens])
            self.place(words[::2], words[1::2] | _LENGTH.take(sizes), sizes, base)
            self.long |= {t: base + k for k, t in enumerate(tokens) if len(t) > 15}

    def placed(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The number of each pre-token of at most 15 bytes, 0 where it is not remembered."""
        place = _place(first, second)
        out, keys = self.number.take(place), [k.values for k in self.keys]
        wrong = (keys[0].take(out) != first) | (keys[1].take(out) != second)
        left = np.flatnonzero(wrong & (out > 0))
        out[wrong] = 0
        while len(left):
            place[left] = place[left] + 1 & _PLACES - 1
            found = self.number.take(place[left])
            same = (keys[0].take(found) == first[left]) & (keys[1].take(found) == second[left])
            out[left[same]] = found[same]
            left = left[~same & (found > 0)]
        return out

    def place(self, first: np.ndarray, second: np.ndarray, sizes: np.ndarray, base: int) -> None:
        """Remembers pre-tokens numbered from ``base``, those that fit."""
        while len(self.keys[0]) < base:
            for keys in self.keys:
                keys.extend(np.zeros(base - len(keys), np.uint64))
        for keys, words in zip(self.keys, (first, second), strict=True):
            keys.extend(words)
        room = max(0, _PLACES * 3 // 4 - base)
        left = np.flatnonzero(sizes[:room] < 16)
        place, number = _place(first, second), np.arange(base, base + len(sizes), dtype=np.int32)
        while len(left):
            free = left[self.number[place[left]] == 0]
            self.number[place[free]] = number[free]
            left = left[self.number[place[left]] != number[left]]
            place[left] = place[left] + 1 & _PLACES - 1


def _place(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = (first + second * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0x94D049BB133111EB)
    return (mixed >> np.uint64(43)).astype(np.int64)


class _Growing:
    """An array that grows at its end."""

    def __init__(self, kind: type):
        self.room, self.used = np.zeros(1 << 12, kind), 0

    def __len__(self) -> int:
        return self.used

    @property
    def values(self) -> np.ndarray:
        return self.room[: self.used]

    def extend(self, more: np.ndarray) -> None:
        while self.used + len(more) > len(self.room):
            self.room = np.concatenate([self.room, np.zeros_like(self.room)])
        self.room[self.used : self.used + len(more)] = more
        self.used += len(more)


_loaded: dict[int, Bpe] = {}


def loaded(model: Broadcast) -> Bpe:
    """The vocabulary, built once per worker."""
    key = hash(model.value)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Bpe(model.value)
    return _loaded[key]


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """A vocabulary file, sent to the workers: a fixed file of a few MB."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


FOUND = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(text: Column, model: Broadcast, with_ids: bool = False) -> Column:
    """Number of ids, and SHA-256 of the ids and of the text decoded from them.

    ``with_ids`` adds the ids, as little-endian unsigned 32-bit integers in one binary value.
    """

    def one(texts: pa.Array) -> pa.Array:
        bpe, counts, ids_sha, text_sha = loaded(model), [], [], []
        encoded = bpe.encode(texts.to_pylist())
        for ids in encoded:
            counts.append(len(ids) // 4)
            ids_sha.append(hashlib.sha256(ids).hexdigest())
            text_sha.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
        columns = [pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
        names = ["n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            columns, names = [*columns, pa.array(encoded, pa.binary())], [*names, "ids"]
        return pa.StructArray.from_arrays(columns, names)

    return per_text(one, FOUND + ", ids binary" if with_ids else FOUND)(text)


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` with the digests of each row's ids and decoded text."""
    found = digests(F.col(text), vocabulary(docs.sparkSession, path))
    return docs.select(F.col(key), found.alias("found")).select(key, "found.*")


def with_ids(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with the ids of each row's text and their digests.

    All columns stay, the text too; one named like an added column is replaced by it.
    """
    found = digests(F.col(text), vocabulary(docs.sparkSession, path), with_ids=True)
    names = ["n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    kept = [c for c in docs.columns if c not in names]
    rows = docs.select(F.struct(*kept).alias("row"), found.alias("found"))
    return rows.select("row.*", *[F.col(f"found.{c}") for c in names])
