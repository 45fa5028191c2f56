"""Token ids as files: written in the order of the keys, coded, checksummed, and read back.

A file set is a Parquet folder with one row for each block, so that any store Spark writes to can
hold it and lost executors are made good by Spark's commits.  A row has

- ``part`` and ``block``: blocks in this order hold all ids in the order of the keys;
- ``payload``: magic, version, number of ids, CRC-32 of the ids as unsigned 16-bit integers, and
  the ids as the range coder left them; every block decodes alone;
- ``index``: the documents with ids in the block: their number within the part, their key, how
  many of their ids are here, and how many ids of the part come before.

Each document ends with id 0.  Ids come from the tokenizers library, which encodes each pre-token
once a worker as long as it is remembered.

A null text counts as empty and has only the end id.  Null keys come first, and rows of equal keys
are documents of their own in the order of their texts' hashes.  An empty table gives an empty
file set and an empty result.  A text longer than a block goes over as many blocks as it needs.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from wardflow.llm import range_coder
from wardflow.llm.batches import pieces
from wardflow.llm.bpe import Encoder, vocabulary
from wardflow.session import shared_dir

MAGIC, VERSION, END = b"WFTK", 2, 0
_HEAD = struct.Struct("<4sHHII")

INDEX = "array<struct<document:bigint,key:bigint,n:int,before:bigint>>"
ROW = f"part int, block int, payload binary, index {INDEX}"

# Blocks held by a worker until they are coded together.
GROUP = range_coder.LANES

# Bytes of text encoded together: the more, the fewer distinct pre-tokens for each of them.
PIECE = 2 << 20

_loaded: dict[int, Encoder] = {}


def library(model: Broadcast) -> Encoder:
    """The tokenizers library on one vocabulary, with ``END`` after each text, built once per worker."""
    key = hash(model.value)
    if key not in _loaded:
        _loaded.clear()
        tokenizer = Tokenizer.from_str(model.value)
        tokenizer.no_padding()
        tokenizer.no_truncation()
        special = {t["content"]: t["id"] for t in json.loads(model.value)["added_tokens"]}
        # pre-tokens come cut already, and a task has one core
        tokenizer.pre_tokenizer.use_regex = False
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = tokenizer.encode_batch_fast

        def ids_of(tokens: list[bytes]) -> list[list[int]]:
            return [e.ids for e in encode([t.decode() for t in tokens], add_special_tokens=False)]

        _loaded[key] = Encoder(special, ids_of, (END,))
    return _loaded[key]


def narrow(ids: np.ndarray) -> np.ndarray:
    """The ids in 16 bits; an id that does not fit is an error."""
    if len(ids) and int(ids.max()) > 0xFFFF:
        raise ValueError(f"token id {int(ids.max())} does not fit 16 bits")
    return ids.astype(np.uint16)


def packed(blocks: list[np.ndarray]) -> list[bytes]:
    """Blocks of ids as payloads."""
    return [
        _HEAD.pack(MAGIC, VERSION, 0, len(ids), zlib.crc32(ids.astype("<u2").tobytes())) + coded
        for ids, coded in zip(blocks, range_coder.encode(blocks), strict=True)
    ]


def unpacked(payloads: list[bytes]) -> list[np.ndarray]:
    """The ids of payloads; raises ValueError for one that is not what was written."""
    heads = []
    for payload in payloads:
        if len(payload) < _HEAD.size:
            raise ValueError("a token block is too short")
        magic, version, _, n, check = _HEAD.unpack_from(payload)
        if magic != MAGIC or version != VERSION or not 0 < n <= range_coder.BLOCK:
            raise ValueError("not a token block of this format")
        heads.append((n, check))
    blocks = range_coder.decode([p[_HEAD.size :] for p in payloads], [n for n, _ in heads])
    for ids, (_, check) in zip(blocks, heads, strict=True):
        if zlib.crc32(ids.astype("<u2").tobytes()) != check:
            raise ValueError("a token block fails its checksum")
    return blocks


def _write(model: Broadcast) -> Callable:
    """Sorted rows of (key, text) to rows of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = library(model), TaskContext.get().partitionId()
        document = before = block = 0
        held, size = [], 0  # ids that do not fill a block yet
        index: list[dict] = []  # documents of the block that is being filled
        blocks: list[np.ndarray] = []
        indexes: list[list[dict]] = []

        def rows() -> pa.RecordBatch:
            nonlocal block
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(blocks), pa.int32()),
                    pa.array(range(block, block + len(blocks)), pa.int32()),
                    pa.array(packed(blocks), pa.binary()),
                    pa.array(indexes, _INDEX),
                ],
                ["part", "block", "payload", "index"],
            )
            block += len(blocks)
            blocks.clear()
            indexes.clear()
            return out

        def close() -> None:
            nonlocal held, size, index
            blocks.append(np.concatenate(held))
            indexes.append(index)
            held, size, index = [], 0, []

        for batch in batches:
            start = 0
            for texts in pieces(batch.column(1), PIECE):
                keys = batch.column(0).slice(start, len(texts)).to_pylist()
                start += len(texts)
                ids, ends = encode.flat(texts)
                for key, whole in zip(keys, np.split(narrow(ids), ends[:-1]), strict=True):
                    at = 0
                    while at < len(whole):
                        n = min(len(whole) - at, range_coder.BLOCK - size)
                        held.append(whole[at : at + n])
                        index.append({"document": document, "key": key, "n": n, "before": before})
                        at, size = at + n, size + n
                        if size == range_coder.BLOCK:
                            close()
                            if len(blocks) == GROUP:
                                yield rows()
                    document, before = document + 1, before + len(whole)
        if size:
            close()
        if blocks:
            yield rows()

    return run


_INDEX = pa.list_(
    pa.struct(
        [
            ("document", pa.int64()),
            ("key", pa.int64()),
            ("n", pa.int32()),
            ("before", pa.int64()),
        ]
    )
)


def write(docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text") -> None:
    """Write the ids of all texts to ``path`` in ascending order of the integer key."""
    model = vocabulary(docs.sparkSession, tokenizer)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    tie = F.xxhash64("text")
    # a stated number, as coding costs far more than its bytes tell the adaptive planner
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "key", tie).sortWithinPartitions("key", tie)
    ordered.mapInArrow(_write(model), ROW).write.parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of blocks to one row for each stretch of a document: its place, size and CRC-32."""
    held: list[pa.RecordBatch] = []

    def rows() -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        out: tuple[list, ...] = ([], [], [], [], [], [], [])
        parts, numbers = table.column(0).to_pylist(), table.column(1).to_pylist()
        index = table.column(3).to_pylist()
        for part, number, ids, documents in zip(
            parts, numbers, unpacked(table.column(2).to_pylist()), index, strict=True
        ):
            wide, at = ids.astype("<u4").tobytes(), 0
            for d in documents:
                piece = wide[4 * at : 4 * (at + d["n"])]
                at += d["n"]
                row = (part, d["document"], d["key"], d["before"], number, d["n"], zlib.crc32(piece))
                for column, x in zip(out, row, strict=True):
                    column.append(x)
            if at != len(ids):
                raise ValueError("a token block does not hold the documents of its index")
        kinds = [pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int32(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, kinds, strict=True)],
            ["part", "document", "key", "before", "block", "n", "crc"],
        )

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= GROUP:
            yield rows()
    if sum(b.num_rows for b in held):
        yield rows()


def crc32_joined(pieces_: list[tuple[int, int]]) -> int:
    """CRC-32 of a concatenation from the (CRC-32, number of bytes) of its pieces.

    Appending zero bytes is linear over the bits of a checksum: the matrix of one zero byte is
    squared for each bit of the length.
    """
    total = 0
    for crc, size in pieces_:
        total = (_after_zeros(total, size) if total else 0) ^ crc
    return total


def _times(matrix: list[int], vector: int) -> int:
    out = 0
    for row in matrix:
        if vector & 1:
            out ^= row
        vector >>= 1
    return out


@cache
def _zeros(power: int) -> list[int]:
    """The matrix of 2^power zero bits."""
    if power == 0:
        return [0xEDB88320, *[1 << k for k in range(31)]]
    half = _zeros(power - 1)
    return [_times(half, x) for x in half]


def _after_zeros(crc: int, size: int) -> int:
    power = 3  # of a byte
    while size:
        if size & 1:
            crc = _times(_zeros(power), crc)
        size >>= 1
        power += 1
    return crc


@F.arrow_udf(T.LongType())
def _joined(stretches: pa.Array) -> pa.Array:
    return pa.array(
        [crc32_joined([(x["crc"], 4 * x["n"]) for x in row]) for row in stretches.to_pylist()],
        pa.int64(),
    )


def read(spark, path: str, key: str = "doc_id") -> DataFrame:
    """Per document of the files: key, ``start``, ``n_tokens`` and ``ids_crc32``."""
    blocks = spark.read.schema(ROW).parquet(path)
    stretches = blocks.mapInArrow(
        _read, "part int, document long, key long, before long, block int, n int, crc long"
    )
    documents = stretches.groupBy("part", "document").agg(
        F.first("key").alias("key"),
        F.first("before").alias("before"),
        F.sum("n").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("block", "n", "crc"))).alias("stretches"),
    )
    # a row for each part, of which there are as many as tasks wrote
    sizes = blocks.select("part", F.explode("index").alias("x")).groupBy("part").agg(F.sum("x.n").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    return documents.join(offsets, "part").select(
        F.col("key").alias(key),
        (F.col("offset") + F.col("before")).alias("start"),
        "n_tokens",
        _joined("stretches").alias("ids_crc32"),
    )


def round_trip(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the files to the shared folder, then read them back."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/tokens/{uuid.uuid4().hex}"
    write(docs, path, tokenizer, key, text)
    return read(spark, path, key)
