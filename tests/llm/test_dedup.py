"""Exact, near and passage duplicates against plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import common, exact_dedup, near_dedup, passage_dedup
from tests.conftest import SF001
from tests.llm import plain


@pytest.fixture(scope="module")
def odd(spark):
    return plain.table(spark, plain.odd_rows()).cache()


@pytest.fixture(scope="module")
def documents(spark):
    return common.read(spark, SF001, "documents")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_exact_groups(request, which):
    df = request.getfixturevalue(which)
    rows = pairs(df)
    got = exact_dedup.exact_groups(df).collect()
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    expect = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            expect[(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expect
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_names_tell_blocks_apart(spark, monkeypatch):
    """Texts of shared blocks in other orders, lengths at block bounds, and prefixes of each other."""
    monkeypatch.setattr(exact_dedup, "BLOCK", 4)
    parts = ["aaaa", "bbbb", "cc", "aaaab", ""]
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9))) for _ in range(300)] + ["é" * 7, "é" * 8, "aaaa" * 33]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.keep_id, r.group_size) for r in
           exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, t in rows:
        same = [j for j, u in rows if u == t]
        assert got[i] == (max(same), len(same))


def test_drop_copies_keeps_columns_and_one_row(odd):
    out = exact_dedup.drop_copies(odd)
    assert out.columns == odd.columns
    texts = [r.text or "" for r in out.collect()]
    assert len(texts) == len(set(texts)) == len({t or "" for _, t in pairs(odd)})


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_near_groups(request, which):
    df = request.getfixturevalue(which)
    got = near_dedup.near_groups(df).collect()
    expect, n = plain.near_components(pairs(df))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(expect)
    kept = [r for r in got if r.kept]
    assert all(r.doc_id == r.component_id for r in kept)
    assert len(kept) == n


def test_near_chain_and_unlike_buckets(spark):
    """A chain of links whose ends differ is one component; lookalikes below the threshold stay apart."""
    base = plain.prose(11, 400).split()
    rows, w = [], list(base)
    for i in range(25):
        rows.append((i, " ".join(w)))
        for j in range(4):
            w[(i * 16 + j * 4) % 400] = f"new{i}x{j}"
    for i in range(40):  # about 0.7 of the shingles in common
        v = list(base)
        for j in range(14):
            v[(j * 28 + i % 5)] = f"far{i}y{j}"
        rows.append((100 + i, " ".join(v)))
    got = near_dedup.near_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(plain.near_components(rows)[0])


def test_near_copies_between_the_thresholds(spark):
    """A pair of similarity 0.80 to 0.85 is one in the pipeline and two under op5's contract."""
    base = plain.prose(17, 400).split()
    edited = list(base)
    for j in range(8):
        edited[20 + j * 45] = f"new{j}"
    rows = [(1, " ".join(base)), (2, " ".join(edited))]
    a, b = (plain.shingles(t) for _, t in rows)
    assert 0.80 <= len(a & b) / len(a | b) < 0.85
    df = plain.table(spark, [(i, t, "en", "s", 1) for i, t in rows])
    assert {r.doc_id for r in corpus_pipeline.near_stage(spark, df, "").collect()} == {1}
    assert {r.doc_id for r in near_dedup.drop_near_copies(df).collect()} == {1, 2}
    assert near_dedup.n_bands(85) == 25
    for percent in (80, 85):
        n = near_dedup.n_bands(percent)
        assert (1 - (percent / 100) ** near_dedup.ROWS) ** n <= near_dedup.MISS < (1 - (percent / 100) ** near_dedup.ROWS) ** (n - 1)


def test_superminhash_is_the_scalar_algorithm():
    rng = np.random.default_rng(0)
    sets = [rng.integers(0, 1 << 62, n).astype(np.uint64) for n in (1, 2, 7, 40, 0, 300)]
    sig = near_dedup.superminhash(np.concatenate(sets), np.repeat(np.arange(6), [len(s) for s in sets]), 6)
    gold = int(near_dedup._GOLD)
    for s, row in zip(sets, sig):
        h = [np.iinfo(np.int64).max] * near_dedup.SLOTS
        for e in s.tolist():
            p = list(range(near_dedup.SLOTS))
            for j in range(near_dedup.SLOTS):
                x = int(near_dedup.mix(np.array([(e + (j + 1) * gold) % (1 << 64)], dtype=np.uint64))[0])
                k = j + (((x >> 32) * (near_dedup.SLOTS - j)) >> 32)
                p[j], p[k] = p[k], p[j]
                h[p[j]] = min(h[p[j]], j << 32 | x & 0xFFFFFFFF)
        assert row.tolist() == h


def test_drop_near_copies(odd):
    out = near_dedup.drop_near_copies(odd)
    assert out.columns == odd.columns
    expect, n = plain.near_components(pairs(odd))
    rows = out.collect()
    assert len(rows) == n
    assert {r.doc_id for r in rows if plain.shingles(r.text)} == {c for _, k, c in expect if k}


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_passages(request, which):
    df = request.getfixturevalue(which)
    got = passage_dedup.cut_passages(df).withColumn("sha", F.sha2("kept_text", 256)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.sha) for r in got) == plain.cut_passages(pairs(df))
    for r in got:
        assert sum(s.last - s.first + 1 for s in r.removed) == r.n_removed


def test_passage_windows_from_two_documents(spark):
    """A window made of the end of one passage and the start of another is found where it stands."""
    a, b = plain.prose(21, 80), plain.prose(22, 80)
    rows = [(5, a), (3, b), (9, a + " " + b), (12, a + " " + b + " x"), (14, b + " " + a), (2, "\n".join(a.split()[:49])),
            (20, a.replace(" ", "  \n") + " tail"), (30, plain.prose(23, 60) + " " + " ".join(b.split()[10:61]))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = passage_dedup.cut_passages(df).withColumn("sha", F.sha2("kept_text", 256)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.sha) for r in got) == plain.cut_passages(rows)


def test_every_window_hash_and_choice():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    whole = passage_dedup.run_hashes(h, 50, 2)
    assert all(whole[i] == passage_dedup.run_hashes(h[i:i + 50], 50, 2)[0] for i in range(0, 351, 7))
    phrases, at = passage_dedup.chosen_phrases(h)
    span = passage_dedup.WINDOW - passage_dedup.PHRASE + 1
    assert all(i <= at[i] < i + span and phrases[at[i]] >> np.uint64(6) == phrases[i:i + span].min() >> np.uint64(6)
               for i in range(351))


def test_empty_tables(spark):
    none = spark.createDataFrame([], plain.DOC_SCHEMA)
    assert exact_dedup.exact_groups(none).count() == 0
    assert near_dedup.near_groups(none).count() == 0
    assert passage_dedup.cut_passages(none).count() == 0
    assert exact_dedup.drop_copies(none).columns == none.columns
    assert near_dedup.drop_near_copies(none).count() == 0


@pytest.mark.parametrize("percent", [80, 85])
def test_near_copies_without_their_original(spark, percent):
    """Edits in common places, of common words, additions and cuts: components are those of all pairs."""
    r = random.Random(percent)
    base = plain.prose(21, 150).split()
    rows = []
    for i in range(160):
        w = list(base)
        for _ in range(r.randint(1, 4)):
            w[r.choice([20, 21, 50, 80, 110, 140, r.randrange(len(w))])] = r.choice(["one", "two", f"edit{i}", f"edit{i // 3}"])
        if i % 5 == 0:
            w += plain.prose(i // 10, r.randint(1, 25)).split()
        if i % 7 == 0:
            w = w[r.randint(1, 20):]
        rows.append((i, " ".join(w)))
    found, n = plain.near_components(rows, percent)
    got = near_dedup.near_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), percent).collect()
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in got) == sorted(found)
    assert 1 < n < len(rows)
