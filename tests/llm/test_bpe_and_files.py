"""BPE round trips, the range coder and token files."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import ODD_TEXTS, documents
from tokenizers import Tokenizer

from wardflow.llm import bpe, range_coder, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Bpe(f.read())


def ids_of(own, texts):
    return [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)]


def test_odd_texts_as_the_library_has_them(own, library):
    wanted = [e.ids for e in library.encode_batch(ODD_TEXTS, add_special_tokens=False)]
    assert ids_of(own, ODD_TEXTS) == wanted
    for text, ids in zip(ODD_TEXTS, own.encode(ODD_TEXTS), strict=True):
        assert own.decode(ids) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("a'strevmld Z9é²\n\t  '\x1c<|>字"), max_size=30), max_size=5))
def test_any_text_as_the_library_has_it(own, library, texts):
    wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ids_of(own, texts) == wanted


def test_a_long_pretoken_uses_every_level_of_the_tree(own, library):
    text = "abcdefghij" * 400 + "the" * 900
    assert ids_of(own, [text])[0] == library.encode(text, add_special_tokens=False).ids


def test_broken_ids_decode_like_the_library(own, library):
    ids = library.encode("日本語 é", add_special_tokens=False).ids
    for k in range(len(ids)):
        part = ids[k:]
        assert own.decode(np.array(part, "<u4").tobytes()) == library.decode(
            part, skip_special_tokens=False
        )


def test_documents(spark, library):
    docs = documents(spark)
    rows = bpe.encode_documents(docs, PATH).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert len(rows) == docs.count()
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert bpe.encode_documents(docs.limit(0), PATH).count() == 0


@pytest.mark.parametrize("most", [2, 300, 65_536])
def test_range_coder_round_trip(most):
    rng = np.random.default_rng(most)
    blocks = [rng.integers(0, most, n).astype(np.uint16) for n in (1, 2, 7, 900, 4096)]
    blocks += [np.zeros(4096, np.uint16), np.tile(np.arange(9, dtype=np.uint16), 40)]
    coded = range_coder.encode(blocks)
    found = range_coder.decode(coded, [len(b) for b in blocks])
    assert all((a == b).all() for a, b in zip(found, blocks, strict=True))
    # a block does not depend on those beside it, and repetition is learnt
    assert range_coder.encode(blocks[2:3]) == coded[2:3]
    assert len(coded[5]) < 200


def test_damaged_blocks_are_refused():
    payload = token_files.packed([np.arange(500, dtype=np.uint16)])[0]
    for at in (0, 5, 9, 13, len(payload) // 2):
        broken = bytearray(payload)
        broken[at] ^= 0x55
        with pytest.raises(ValueError):
            token_files.unpacked([bytes(broken)])
    with pytest.raises(ValueError):
        token_files.unpacked([b"short"])


def test_checksums_join():
    data = bytes(range(256)) * 9
    cuts = [data[:5], data[5:5], data[5:1000], data[1000:]]
    joined = token_files.crc32_joined([(zlib.crc32(c), len(c)) for c in cuts])
    assert joined == zlib.crc32(data)


def test_files(spark, library):
    docs = documents(spark).filter("doc_id is not null").dropDuplicates(["doc_id"])
    rows = token_files.round_trip(docs, PATH).orderBy("doc_id").collect()
    start = 0
    for r, d in zip(rows, docs.orderBy("doc_id").collect(), strict=True):
        ids = [*library.encode(d.text or "", add_special_tokens=False).ids, 0]
        assert (r.doc_id, r.start, r.n_tokens) == (d.doc_id, start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert max(r.n_tokens for r in rows) > 2 * range_coder.BLOCK
    assert token_files.round_trip(docs.limit(0), PATH).count() == 0


def test_files_with_repeated_and_null_keys(spark):
    docs = documents(spark)
    rows = token_files.round_trip(docs, PATH).orderBy("start").collect()
    assert len(rows) == docs.count()
    assert rows[0].doc_id is None
    assert [r.start for r in rows] == list(np.cumsum([0, *[r.n_tokens for r in rows]])[:-1])


def test_ids_beyond_16_bits_are_refused():
    fits = np.array([0, 50256, 65535], "<u4")
    assert token_files.narrow(fits).tolist() == fits.tolist()
    assert token_files.narrow(fits[:0]).tolist() == []
    with pytest.raises(ValueError, match="65536"):
        token_files.narrow(np.array([1, 65536], "<u4"))


def test_bytes_of_an_id(library):
    """Measured 1.297 on these documents; a weaker model would take more."""
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist()
    found = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    ids = np.concatenate([token_files.narrow(np.array([*e.ids, token_files.END], "<u4")) for e in found])
    blocks = [ids[k : k + range_coder.BLOCK] for k in range(0, len(ids), range_coder.BLOCK)]
    assert sum(map(len, range_coder.encode(blocks))) < 1.31 * len(ids)


def test_blocks_are_smaller_than_those_of_zlib(library):
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist()
    found = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    ids = np.concatenate([np.array([*e.ids, token_files.END], "<u2") for e in found])
    blocks = [ids[k : k + range_coder.BLOCK] for k in range(0, len(ids), range_coder.BLOCK)]
    coded = range_coder.encode(blocks)
    assert sum(map(len, coded)) < 0.99 * sum(len(zlib.compress(b.tobytes(), 6)) for b in blocks)
    found = range_coder.decode(coded, [len(b) for b in blocks])
    assert all((a == b).all() for a, b in zip(found, blocks, strict=True))


def test_pretokens_are_encoded_once_and_many_at_a_time(own):
    calls = []

    def ids_of(tokens):
        calls.append(tokens)
        return [own.merge(t) for t in tokens]

    encode = bpe.Encoder(own.special, ids_of)
    texts = [" ".join(f"w{x:x}" for x in range(k, k + 2000)) for k in range(0, 20_000, 2000)]
    texts += ["a" * 15, "b" * 16, "c" * 64, "d" * 65, "\0", "\0\0", "e" * 8 + "\0"]
    first, second = encode(texts), encode(texts)
    assert first == second == own.encode(texts)
    tokens = [t for c in calls for t in c]
    # only those of more than 64 bytes come again
    assert [t for t, n in Counter(tokens).items() if n > 1] == [b"d" * 65]
    assert len(calls) < len(tokens) / 100


def test_forgotten_pretokens_are_encoded_again(own, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 40)
    encode = bpe.Encoder(own.special, lambda tokens: [own.merge(t) for t in tokens])
    for text in [*ODD_TEXTS, *(f"x{k} y{k * k} <|endoftext|> {'z' * k}" for k in range(60)), *ODD_TEXTS]:
        wanted = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode([text])[0], "<u4").tolist() == wanted


def test_many_special_tokens(own):
    special = {f"<|{k}|>": 60_000 + k for k in range(40)}
    encode = bpe.Encoder(special, lambda tokens: [own.merge(t) for t in tokens], (7, 8))
    ids, ends = encode.flat(pa.array(["", "<|39|><|0|><|39|>", "<|15|> <|14|>", ""]))
    assert ids.tolist() == [7, 8, 60_039, 60_000, 60_039, 7, 8, 60_015, *own.merge(b" "), 60_014, 7, 8, 7, 8]
    assert ends.tolist() == [2, 7, 12, 14]
