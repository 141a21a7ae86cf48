"""Phrase mining, the conversation trie and SimHash balls against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quarry.llm import common, setm, sim_balls, turn_trie
from tests.conftest import SF001
from tests.llm import plain

CONV_SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def phrases(rows, longest, least, most, covered=80):
    """(lang, rank, phrase, a, l, r, n, score) of rows (lang, text)."""
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(plain._LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    found = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= least:
            cuts = [(2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found[lang, p] = (score, a, f[lang, p[:k]], f[lang, p[k:]])
    longer = Counter()
    for (lang, p), v in found.items():
        for m in range(2, len(p)):
            for s in range(len(p) - m + 1):
                longer[lang, p[s:s + m]] = max(longer[lang, p[s:s + m]], v[1])
    out = []
    for lang in {x for x, _ in found}:
        kept = [(-v[0], -v[1], " ".join(p).encode(), v) for (x, p), v in found.items()
                if x == lang and 100 * longer[x, p] < covered * v[1]]
        for rank, (_, _, phrase, (score, a, left, right)) in enumerate(sorted(kept)[:most], 1):
            out.append((lang, rank, phrase.decode(), a, left, right, n[lang], score))
    return sorted(out)


def said(seed):
    """Few words, piece ends, tabs, odd white space, one lang null, one document far longer than the rest."""
    r = random.Random(seed)
    vocabulary = ["a", "B", "cé", "d\x85e", "😀", "f\x00", "und", "x-y"]
    rows = []
    for i in range(60):
        m = 3000 if i == 7 else r.randint(0, 60)
        words = [r.choice(vocabulary) + r.choice(["", "", "", ".", ",", "\n", "!?", "\v"]) for _ in range(m)]
        rows.append((r.choice(["en", "en", None, "und"]), r.choice([" ", "\t", "  "]).join(words)))
    return rows + [("en", None), ("fr", ""), ("fr", " . "), *[("en", "the same text. again")] * 40]


@pytest.mark.parametrize("carried", [setm.CARRIED, 3])
def test_phrases(spark, carried):
    rows = said(1)
    df = spark.createDataFrame(rows, "lang string, text string").withColumns({c: F.lit("x") for c in ("doc", "pos", "w", "words", "f", "id")})
    got = setm.collocations(df, least=4, most=25, carried=carried)
    assert [t for _, t in got.dtypes] == ["string", "bigint", "string", *["bigint"] * 5]
    assert sorted(map(tuple, got.collect())) == phrases(rows, 4, 4, 25)


def test_phrases_of_documents(spark):
    docs = common.read(spark, SF001, "documents")
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    assert sorted(map(tuple, setm.collocations(docs, least=5).collect())) == phrases(rows, 4, 5, 2000)
    assert setm.collocations(docs.limit(0)).count() == 0


def test_phrase_settings_are_put_back(spark):
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    setm.relations(spark.createDataFrame(said(2), "lang string, text string"), least=4)
    assert spark.conf.get(name) == before
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("setm_")]


def trie(rows):
    """Set of the contract's rows for rows (conv_id, turn, role, text)."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), (role is not None, role or ""), (text is not None, text or "")))
    own = {c: [(r[1], t[1]) for _, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = int(c - np.fmod(c, 100))
        built[c] = own.get(base, [])[:h] + turns[h:]
    nodes = {}
    for c, t in built.items():
        for d in range(len(t) + 1):
            nodes.setdefault(tuple(t[:d]), []).append(c)
    kids = Counter(p[:-1] for p in nodes if p)
    leaves, saved = Counter(), Counter()
    for p, m in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, m in nodes.items():
        ends = ",".join(map(str, sorted(c for c in m if len(built[c]) == len(p))))
        out.append((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def talks():
    """Shared openings, equal conversations, ties, nulls, gaps, one very long conversation, one without a base."""
    r = random.Random(5)
    rows = []
    for c in [*range(0, 60), *range(100, 130), *range(305, 320), 10**15, 10**15 + 7, -5, -250]:
        for t in range(r.randint(1, 7)):
            rows.append((c, t, r.choice(["user", "assistant"]) if t else "user", r.choice(["hi", "", "né 😀", "ho"]) if t else "hi"))
    rows += [(42, t, "user", f"long {t % 3}") for t in range(100, 140)]
    rows += [(7, None, "user", "first of all"), (8, 3, None, None), (9, 1, "user", "tie"), (9, 1, "assistant", "tie"),
             (9, 1, "user", "tie"), (None, 1, "user", "nobody's"), (11, None, None, "x"), (11, None, None, None)]
    return rows


def test_trie(spark):
    rows = talks()
    df = spark.createDataFrame(rows, CONV_SCHEMA).repartition(5).withColumns({c: F.lit("x") for c in ("conv", "place", "depth", "k1", "length")})
    got = turn_trie.conversation_trie(df)
    assert sorted(map(tuple, got.collect()), key=str) == trie(rows)
    assert turn_trie.conversation_trie(df.limit(0)).count() == 0


def test_trie_of_conversations(spark, monkeypatch):
    monkeypatch.setattr(turn_trie, "PIECE", 100)
    df = common.read(spark, SF001, "conversations")
    got = turn_trie.conversation_trie(df).collect()
    assert sorted(map(tuple, got), key=str) == trie([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def fingerprint(text):
    w = plain.WORD.findall((text or "").translate(plain._LOW))
    h = [xxhash.xxh64_intdigest(" ".join(w[s:s + 4]).encode(), 42) for s in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def balls(rows, radius=4):
    """Counter of (doc_id, fingerprint, component) for rows (doc_id, text)."""
    fps = [fingerprint(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    a = np.array(fps, dtype=np.uint64)
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(a[:i] ^ a[i]) <= radius):
            up[root(i)] = root(int(j))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), plain.order(doc_id)), plain.order(doc_id))
    return Counter((doc_id, f"{fps[i]:016x}", None if least[root(i)][0] else least[root(i)][1]) for i, (doc_id, _) in enumerate(rows))


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_balls(spark, which):
    df = plain.table(spark, plain.odd_rows()) if which == "odd" else common.read(spark, SF001, "documents")
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = sim_balls.near_groups(df)
    assert Counter(map(tuple, got.collect())) == balls(rows)
    assert sim_balls.near_groups(df.limit(0)).count() == 0


@pytest.mark.parametrize("group", [sim_balls.GROUP, 20])
def test_dense_balls_are_split(spark, group):
    """Every two fingerprints within the radius are connected, also where prefixes are dealt by longer ones."""
    r = random.Random(11)
    centres = [0, (1 << 64) - 1, *[r.getrandbits(64) for _ in range(6)]]
    fps = set(centres)
    for c in centres[:4]:
        for _ in range(150):
            fps.add(c ^ sum(1 << b for b in r.sample(range(64), r.randint(1, 5))))
    for c in centres[4:]:  # chains whose ends are far apart
        for step in range(8):
            c ^= sum(1 << b for b in r.sample(range(64), 4))
            fps.add(c)
    fps.update(r.getrandbits(64) for _ in range(200))
    a = np.array(sorted(fps), dtype=np.uint64)
    df = spark.createDataFrame([(int(x),) for x in a.view(np.int64)], "fp bigint")
    links = sim_balls.near_links(df, group=group).collect()
    signed = a.view(np.int64).tolist()
    up = {x: x for x in signed}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for x, y in links:
        assert bin((x ^ y) & (1 << 64) - 1).count("1") <= 4
        up[root(x)] = root(y)
    got = {x: root(x) for x in signed}
    label = dict(zip(signed, range(len(signed))))
    changed = True
    near = [np.flatnonzero(np.bitwise_count(a ^ x) <= 4) for x in a]
    while changed:
        changed = False
        for i, x in enumerate(signed):
            low = min(label[signed[j]] for j in near[i])
            if low < label[x]:
                label[x], changed = low, True
    groups = {}
    for x in signed:
        groups.setdefault(label[x], set()).add(got[x])
    assert all(len(g) == 1 for g in groups.values()) and len({*got.values()}) == len(groups)


def test_majority_counts_over_many_runs():
    """More hashes than a byte lane holds, ties, and documents without any."""
    r = np.random.default_rng(2)
    sizes = np.array([0, 1, 2, 255, 256, 1000, 0, 3])
    h = r.integers(0, 1 << 63, size=sizes.sum(), dtype=np.uint64) * np.uint64(2)
    expect, at = [], 0
    for n in sizes:
        part = h[at:at + n]
        at += n
        expect.append(sum(1 << b for b in range(64) if 2 * int((part >> np.uint64(b) & np.uint64(1)).sum()) > n))
    assert sim_balls.majority(h, sizes).tolist() == expect
