"""Text embedding as a pluggable, Arrow-batched column function."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.functions.text import TOKEN

# Fixed value: vector length.
EMBED_DIM = 384


class Model(Protocol):
    def encode(self, texts: list[str]) -> np.ndarray: ...


ModelLoader = Callable[[], Model]


class HashedWords:
    """Word counts in ``dim`` hash buckets: a deterministic stand-in needing no model file.

    A token's bucket is the first 32 bits of its MD5 modulo ``dim``.  Counts are kept as they
    are; cosine similarity does the normalising.
    """

    def __init__(self, dim: int = EMBED_DIM):
        self.dim = dim
        self._token = re.compile(TOKEN)
        self._buckets: dict[str, int] = {}

    def _bucket(self, token: str) -> int:
        found = self._buckets.get(token)
        if found is None:
            found = int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % self.dim
            if len(self._buckets) < 1_000_000:  # a memo, bounded for endless vocabularies
                self._buckets[token] = found
        return found

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), dtype=np.float32)
        for row, text in enumerate(texts):
            buckets = [self._bucket(t) for t in self._token.findall((text or "").lower())]
            if buckets:
                out[row] = np.bincount(buckets, minlength=self.dim)
        return out


def embed(text: Column, load: ModelLoader = HashedWords) -> Column:
    """Embedding of ``text`` as ``array<float>``; the model is loaded once per Python worker."""

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load()
        for texts in batches:
            vectors = np.ascontiguousarray(model.encode(texts.to_pylist()), dtype=np.float32)
            ends = np.arange(len(texts) + 1, dtype=np.int32) * vectors.shape[1]
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(vectors.ravel()))

    return encode(text)
