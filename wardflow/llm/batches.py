"""Text columns as Arrow batches: bounded pieces, words and their hashes as numpy arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.session import prepare

# Bytes of text that one numpy step handles; a longer single text is a piece of its own.
PIECE_BYTES = 1 << 20

# Bytes after which Spark closes an Arrow batch, so that long texts do not pile up in a worker.
ARROW_BYTES = 8 << 20

# Words in lower-cased text: digits, a-z and everything outside ASCII.  Byte 0 separates.
WORD_BYTES = np.zeros(256, np.uint8)
for _b in range(256):
    _c = _b + 32 if 0x41 <= _b <= 0x5A else _b
    WORD_BYTES[_b] = _c if 0x30 <= _c <= 0x39 or 0x61 <= _c <= 0x7A or _c >= 0x80 else 0

# The same as a table for ``bytes.translate``, with a space between words.
WORD_TABLE = bytes(int(b) or 0x20 for b in WORD_BYTES)


def ready(spark: SparkSession) -> SparkSession:
    """The session with the settings these operators rely on."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def per_text(fn: Callable[[list[str]], pa.Array], returns) -> Callable:
    """An Arrow column function of texts; a null text counts as empty.

    Declared non-deterministic only so that the optimizer does not evaluate it twice, once for
    a filter and once for the result.
    """

    @F.arrow_udf(returns)
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            done = [fn(piece) for piece in pieces(texts)]
            yield pa.concat_arrays(done) if done else pa.array([], fn([]).type)

    return apply.asNondeterministic()


def pieces(texts: pa.Array, size: int = PIECE_BYTES) -> Iterator[pa.Array]:
    """Slices of consecutive rows holding at most ``size`` bytes, or one longer text."""
    texts = pc.fill_null(texts, "")
    if len(texts) == 0:
        return
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, start, base = np.cumsum(sizes), 0, 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(ends, base + size, "right")))
        yield texts.slice(start, stop - start)
        start, base = stop, int(ends[stop - 1])


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows in one array, and the offset at which each row begins."""
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data or b"", np.uint8)[at[0] : at[-1]]
    return data, at - at[0]


class Words:
    """The words of a piece: normalised bytes, where each word starts and ends, per-row bounds."""

    def __init__(self, data: np.ndarray, rows: np.ndarray, kinds: np.ndarray = WORD_BYTES):
        self.bytes = kinds[data]
        inside = self.bytes != 0
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        starts, ends = rows[:-1][rows[1:] > rows[:-1]], rows[1:][rows[1:] > rows[:-1]] - 1
        first[starts] = inside[starts]
        last[ends] = inside[ends]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        # words of row r are bounds[r] to bounds[r + 1]
        self.bounds = np.searchsorted(self.starts, rows)

    def __len__(self) -> int:
        return len(self.starts)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def text(self, first: int, stop: int) -> str:
        """Words ``first`` to ``stop`` of one row, space-joined."""
        found = self.bytes[self.starts[first] : self.ends[stop - 1]].tobytes()
        return b" ".join(found.replace(b"\0", b" ").split()).decode()

    def hashes(self, starts: np.ndarray | None = None, ends: np.ndarray | None = None):
        """64-bit hash of each word, or of the given spans."""
        starts = self.starts if starts is None else starts
        ends = self.ends if ends is None else ends
        return span_hashes(self.bytes, starts, ends)


_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_powers: list[np.ndarray] = []


def _power_tables(size: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < size:
        size = max(size, PIECE_BYTES + 1)
        _powers[:] = [
            np.cumprod(np.r_[np.uint64(1), np.full(size, base, np.uint64)], dtype=np.uint64)
            for base in (_BASE, _INVERSE)
        ]
    if len(_powers[0]) > 8 * PIECE_BYTES and size <= PIECE_BYTES + 1:
        _powers[:] = [p[: PIECE_BYTES + 2].copy() for p in _powers]
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``data[start:end]`` for each span: a polynomial over prefix sums, then mixed."""
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = (out ^ words[k : k + n]) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(k)
    return mixed(out)
