"""Tokens, token files and packing against the library and exact round trips."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import common, packing, token_files
from quarry.llm.queries import vocabulary
from quarry.llm.tokens import PieceTokenizer, sub_batches
from tests.conftest import SF001
from tests.llm import plain

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"


@pytest.fixture(scope="module")
def odd(spark):
    return plain.table(spark, plain.odd_rows()).cache()


def library(name, texts, end):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(vocabulary(name))
    tk.encode_special_tokens = True
    return [tk.encode(t or "", add_special_tokens=False).ids + [end] for t in texts]


@pytest.mark.parametrize("name,byte", [(BYTE, True), (WORD, False)])
def test_pieces_give_the_library_ids(name, byte):
    tk = PieceTokenizer(vocabulary(name), byte)
    rnd = random.Random(4)
    bits = list("ab1.,'\n\t  \x0b é\x01\x1c!?AÉ") + ["the", " ", "\n", "'s", "日本", "😀", "ĀǍ", "İ", "ß", " ", " ", "…"]
    texts = ["", "\n", " a", "a ", "a  b", "a\n\nb c", "x\x01y", "it's we'll", "<|endoftext|> a <|startoftext|>", "é x ́y",
             "ΣΑΣ ΣΣ", "﻿abc d", "a.\nB c,\nd", "Über, straße! été; ÊTRE..."]
    texts += ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 50))) for _ in range(4000)]
    got = [np.frombuffer(x, tk.dtype).tolist() for x in tk.encode_batch([t.encode() for t in texts])]
    expect = [ids[:-1] for ids in library(name, texts, 0)]
    assert got == expect


def test_cache_generations(monkeypatch):
    monkeypatch.setattr("quarry.llm.tokens.CACHE_PIECES", 7)
    tk = PieceTokenizer(vocabulary(BYTE), True)
    text = plain.prose(8, 500)
    assert np.frombuffer(tk.encode_batch([text.encode()])[0], tk.dtype).tolist() == library(BYTE, [text], 0)[0][:-1]
    assert len(tk.cache) <= 8


def test_sub_batches_cover():
    texts = [b"x" * n for n in (5, 0, 30, 1, 1, 100)] + [None]
    spans = list(sub_batches(texts, 20))
    assert [i for s, e in spans for i in range(s, e)] == list(range(7))
    assert list(sub_batches([])) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2 ** 32 - 1)), max_size=900), max_size=6))
def test_image_round_trip(docs):
    ids = np.array([x for d in docs for x in d], dtype=np.uint64)
    image = token_files.Image(token_files.encode_image(ids, np.array([len(d) for d in docs], dtype=np.int64)))
    assert image.ids().tolist() == ids.tolist()
    assert image.counts.tolist() == [len(d) for d in docs]
    for k in range(image.n_blocks):
        assert image.block(k).tolist() == ids[k * token_files.BLOCK:(k + 1) * token_files.BLOCK].tolist()


@pytest.mark.parametrize("width", [1, 7, 16, 31, 32])
def test_packed_width(width):
    v = np.random.default_rng(width).integers(0, 1 << width, (3, token_files.BLOCK)).astype(np.uint64)
    packed = token_files.pack_blocks(v, width)
    assert packed.nbytes == 3 * width * token_files.BLOCK // 8
    assert (token_files.unpack_blocks(packed, width) == v).all()


def test_outliers_go_to_exceptions():
    v = np.arange(token_files.BLOCK, dtype=np.uint64) % 8
    v[::300] = 1 << 31
    image = token_files.Image(token_files.encode_image(v, np.array([len(v)])))
    assert image.width.tolist() == [3] and image.n_over.tolist() == [4]
    assert (image.ids() == v).all()


@pytest.mark.parametrize("shard", [500, 1 << 20])
def test_token_files(spark, odd, monkeypatch, shard):
    monkeypatch.setattr(token_files, "SHARD_IDS", shard)
    path = common.scratch(spark, "test-files")
    token_files.write_token_files(odd, path, vocabulary(WORD), end_id=2)
    got = token_files.read_token_files(spark, path).collect()
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    expect = Counter((i, tuple(ids)) for (i, _), ids in zip(rows, library(WORD, [t for _, t in rows], 2)))
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == expect
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert [plain.order(r.doc_id) for r in got if r.doc_id is not None] == sorted(plain.order(r.doc_id) for r in got if r.doc_id is not None)
    assert all(r.doc_id is None for r in got[:2])
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.n_tokens for r in got)


def whole(pieces, length):
    """Documents put together from pieces; checks the sequences on the way."""
    by_seq = defaultdict(list)
    for p in pieces:
        by_seq[p.sequence_id].append(p)
    last = max(by_seq)
    assert sorted(by_seq) == list(range(last + 1))
    for s, ps in by_seq.items():
        ps.sort(key=lambda p: p.offset)
        assert [p.offset for p in ps] == np.cumsum([0] + [p.length for p in ps])[:-1].tolist()
        assert sum(p.length for p in ps) == length or s == last
    stream = [p for s in sorted(by_seq) for p in by_seq[s]]
    docs, open_ = [], []
    for p in stream:
        assert p.start == sum(len(x) for x in open_)
        open_.append(np.frombuffer(p.ids, "<u4").tolist())
        assert len(open_[-1]) == p.length and zlib.crc32(p.ids) == p.ids_crc32
        if p.start + p.length == p.doc_tokens:
            docs.append((p.doc_id, tuple(x for o in open_ for x in o)))
            open_ = []
    assert not open_
    return docs


@pytest.mark.parametrize("length", [64, 2048])
def test_packing(odd, length):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    docs = whole(packing.pack_documents(odd, vocabulary(BYTE), 1, length).collect(), length)
    assert Counter(docs) == Counter((i, tuple(ids)) for (i, _), ids in zip(rows, library(BYTE, [t for _, t in rows], 1)))


def test_packing_follows_the_curve(spark):
    """Documents of one vocabulary stand together."""
    rows = [(i, (plain.prose(i, 200) if i % 2 else " ".join(f"{i * 7 + j} {j}%" for j in range(200)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs = [d for d, _ in whole(packing.pack_documents(df, vocabulary(BYTE), 1, 512).collect(), 512)]
    changes = sum(a % 2 != b % 2 for a, b in zip(docs, docs[1:]))
    assert changes < 10  # about 30 in a random order


def test_hilbert_curve_is_a_walk():
    for dims, bits in ((2, 4), (3, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = packing.hilbert_key(cells, bits)
        assert sorted(key.tolist()) == list(range(len(cells)))
        path = cells[np.argsort(key)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_empty_tables(spark):
    none = spark.createDataFrame([], plain.DOC_SCHEMA)
    path = common.scratch(spark, "test-none")
    token_files.write_token_files(none, path, vocabulary(WORD), end_id=2)
    assert token_files.read_token_files(spark, path).count() == 0
    assert packing.pack_documents(none, vocabulary(BYTE), 1).count() == 0


def test_documents_of_the_small_tables(spark):
    docs = common.read(spark, SF001, "documents", "doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = whole(packing.pack_documents(docs, vocabulary(BYTE), 1).collect(), 2048)
    assert Counter(got) == Counter((i, tuple(x)) for (i, _), x in zip(rows, library(BYTE, [t for _, t in rows], 1)))


def test_sub_batches_of_lengths():
    texts = [b"a" * n for n in (3, 0, 30, 5, 5, 9, 1)] + [None]
    assert list(sub_batches([len(t or b"") for t in texts], 10)) == list(sub_batches(texts, 10))


def test_curve_keys_hold_no_row_per_id():
    """Against sums written out, without arrays as long as all ids of a batch in wide types."""
    import tracemalloc

    from quarry.llm import packing

    rng = np.random.default_rng(4)
    docs = [rng.integers(0, 500, n).astype("<u2") for n in (0, 1, 40, 2000)]
    tables = place, matrix = packing.projection(500)
    want = []
    for ids in docs:
        vec = np.zeros(packing.HASH_DIMS)
        for p in place[ids]:
            vec[p % packing.HASH_DIMS] += 1 if p < packing.HASH_DIMS else -1
        xy = vec / (np.linalg.norm(vec) or 1) @ matrix
        cells = np.minimum((1 / (1 + np.exp(-1.702 * xy)) * (1 << packing.BITS)).astype(np.int64), (1 << packing.BITS) - 1)
        want.append(packing.hilbert_key(cells[None])[0])
    assert packing.curve_keys(docs, tables).tolist() == want
    many = [rng.integers(0, 500, 1000).astype("<u2") for _ in range(1000)]
    tracemalloc.start()
    packing.curve_keys(many, tables)
    assert tracemalloc.get_traced_memory()[1] < 8e6  # a million ids
    tracemalloc.stop()
