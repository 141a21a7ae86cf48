"""Quality, language, neighbours, secrets and mixing against labels, plain Python and SQL."""

import math
import struct
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quarry.llm import common, language, mixing, neighbours, quality, secret_scan
from quarry.llm.queries import ORACLE, QUERIES
from quarry.sources.tables import table_path
from tests.conftest import SF001, SF01
from tests.llm import plain


@pytest.fixture(scope="module")
def odd(spark):
    return plain.table(spark, plain.odd_rows()).cache()


# quality

def test_quality_held_out_accuracy(spark):
    got = {r.doc_id: r for r in QUERIES["op1_quality"](spark, SF01).collect()}
    labels = {r.doc_id: r.quality for r in common.read(spark, SF01, "labels").collect()}
    assert len(got) == common.read(spark, SF01, "documents").count()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [i for i in labels if got[i].held_out]
    assert sum(got[i].predicted == labels[i] for i in held) / len(held) >= 0.97
    good = [i for i in held if labels[i] == 1]
    assert sum(got[i].predicted for i in good) / len(good) >= 0.98


def test_quality_score_is_the_density_difference():
    rng = np.random.default_rng(2)
    texts = [plain.prose(i, 60).encode() for i in range(40)] + [b"spam!! " * rng.integers(5, 60) for _ in range(20)]
    counts = np.array([quality.count_text(t) for t in texts], dtype=float)
    x = quality.features(counts, counts.sum(axis=0))
    centre, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.clip((x - centre) / spread, -quality.CLIP, quality.CLIP)
    covs, means = [], []
    for rows in (z[40:], z[:40]):
        means.append(rows.mean(axis=0))
        covs.append(np.cov(rows.T, bias=True) * 0.9 + 0.1 * np.eye(z.shape[1]))
    factors = [np.linalg.inv(np.linalg.cholesky(c)) for c in covs]
    offsets = [math.log(n / 60) - np.log(np.diag(np.linalg.cholesky(c))).sum() for n, c in zip((20, 40), covs)]
    model = quality.Model(counts.sum(axis=0), centre, spread, tuple(means), tuple(factors), tuple(offsets), 0.6)
    score, margin = quality.score_counts(counts, model)
    for i in range(60):
        log = [math.log(n / 60) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * (z[i] - m) @ np.linalg.solve(c, z[i] - m)
               for n, c, m in zip((20, 40), covs, means)]
        assert margin[i] == pytest.approx(log[1] - log[0], rel=1e-6, abs=1e-6)
    assert (score[:40] >= 0.5).all() and (score[40:] < 0.5).all()


def test_quality_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1, "x"), (5, 0, "x"), (5, 0, "x"), (11, 1, "x"), (13, 0, "x"), (None, 1, "x"), (6, None, "x"), (99999, 1, "x")],
                                   "doc_id bigint, quality int, text string")
    got = quality.score_documents(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    none = labels.filter("false")
    assert {r.score for r in quality.score_documents(odd, none).collect()} == {0.5}
    assert quality.drop_rejected(odd, none).count() == odd.count()
    one = quality.score_documents(odd, labels.filter("quality = 1")).collect()
    assert all(r.score > 0.5 for r in one)
    empty = odd.filter("false")
    assert quality.score_documents(empty, labels).count() == 0
    out = quality.drop_rejected(odd, labels)
    assert out.columns == odd.columns
    kept = Counter(r.doc_id for r in got if r.predicted)
    assert Counter(r.doc_id for r in out.collect()) == kept


def test_quality_statistics():
    c = dict(zip(quality.COUNTS, quality.count_text("Ab é!! | x x\nx, 12\n\n".encode())))
    assert c["words"] == 7 and c["lines"] == 4 and c["upper"] == 1 and c["high"] == 2 and c["digits"] == 2
    assert c["echoes"] == 1 and c["bars"] == 1 and c["lone_bars"] == 1 and c["bangs"] == 2 and c["distinct_lines"] == 3
    assert quality.count_text(None) == quality.count_text(b"")


# language

def test_language_held_out_accuracy(spark):
    got = QUERIES["op6_language"](spark, SF01).collect()
    true = {r.doc_id: r.lang for r in common.read(spark, SF01, "documents").collect()}
    assert len(got) == len(true)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.lang_pred == true[r.doc_id] for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_odd_rows(spark, odd):
    got = language.predict_language(odd).collect()
    assert len(got) == odd.count()
    for r in got:
        assert r.lang_pred in ("und", "en", "fr")
    by_id = {r.doc_id: r for r in got}
    for i in (4, 5, 9, 13):
        assert by_id[i].lang_pred == "und" and by_id[i].score == 0 and not by_id[i].accepted
    unlearnt = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.predict_language(unlearnt).collect()} == {"und"}
    assert language.predict_language(odd.filter("false")).count() == 0


def test_language_learns_from_whole_texts(spark, monkeypatch):
    """Against a plain ``learn``: rows and chunks of least hash, wherever in the text they are."""
    monkeypatch.setattr(language, "SAMPLE_TEXTS", 6)
    rng = np.random.default_rng(5)
    rows = []
    for i in range(60):
        lang = ("en", "fr", None, "xx")[i % 4]
        text = " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range([1, 40, 9000][i % 3]))
        rows.append((None if i == 8 else i, None if i in (3, 4) else text, lang))
    rows += [rows[1], rows[5]]  # repeated rows
    docs = spark.createDataFrame([(i, t, "s", lang) for i, t, lang in rows], "doc_id long, text string, source string, lang string")

    def row_hash(i, t):
        seed = xxhash.xxh64_intdigest(struct.pack("<q", i), seed=42)
        return seed if t is None else xxhash.xxh64_intdigest(t.encode(), seed=seed)

    train = [(i, t, lang) for i, t, lang in rows if lang and i is not None and zlib.crc32(str(i).encode()) % 5]
    monkeypatch.setattr(language, "MODEL", 60_000)  # three dictionaries of 20,000 bytes
    langs, dicts, bits = language.learn(docs)
    assert langs == sorted({lang for *_, lang in train}) and sum(map(len, dicts)) <= 60_000
    for lang, d, b in zip(langs, dicts, bits):
        own = [(i, t) for i, t, g in train if g == lang]
        assert b == pytest.approx(-math.log2(len(own) / len(train)))
        signed = lambda h: h - (1 << 64) if h >> 63 else h
        picked = sorted(set(own), key=lambda r: (row_hash(*r) % (1 << 20), signed(row_hash(*r)), r[0]))[:6]
        found = {c for _, t in picked for c in language.chunks((t or "").encode())}
        expect, used = [], 0
        for _, c in sorted(found):
            if used + len(c) > 20_000:
                break
            expect.append(c)
            used += len(c) + 1
        assert d == b" ".join(expect)
        if sum(len(c) for _, c in found) > 20_000:
            assert len(d) > 20_000 - language.CHUNK - 1


def test_language_reads_beyond_the_opening(spark):
    """The languages differ only after 5,000 characters of what all share."""
    shared = " ".join(plain.prose(1, 900).split())[:5000]
    ends = {"aa": "the quick brown fox jumps over lazy dogs ", "bb": "portez ce vieux whisky au juge blond "}
    rows = [(i, shared + " " + ends["aa" if i % 2 else "bb"] * 60, "s", "aa" if i % 2 else "bb") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    asked = spark.createDataFrame([(100, ends["aa"] * 3, "s", None), (101, ends["bb"] * 3, "s", None)], docs.schema)
    got = {r.doc_id: r.lang_pred for r in language.predict_language(docs.unionByName(asked)).collect()}
    assert got[100] == "aa" and got[101] == "bb"


def test_language_takes_the_shortest_code():
    dicts = [b"the quick brown fox jumps over the lazy dog " * 3, b"portez ce vieux whisky au juge blond qui fume " * 3]
    by_lang = language.compressors(dicts)
    bits = language.code_bits(b"The QUICK brown fox; jumps over...", by_lang, [1.0, 1.0])
    assert bits[0] < bits[1]
    again = language.code_bits(b"the quick brown fox jumps over", by_lang, [0.0, 0.0])
    assert bits == [x + 1 for x in again]
    long = b"vieux whisky juge " * 5000
    assert language.code_bits(long, by_lang, [0, 0])[1] == 8 * sum(
        len(by_lang[1].compress(language.letters(long)[i:i + language.BLOCK])) for i in range(0, len(long), language.BLOCK))


# neighbours

def brute(ids, v, every=20, k=20):
    out = {}
    for q in sorted({i for i in ids if i % every == 0}):
        for row in np.unique(v[ids == q], axis=0):
            s = v @ row
            o = np.lexsort((ids, -s))
            out[q] = [(int(ids[i]), float(s[i])) for i in o if ids[i] != q][:k]
    return out


def test_neighbours_recall(spark):
    rows = common.read(spark, SF01, "embeddings").collect()
    ids, v = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=np.float64)
    expect = brute(ids, v)
    got: dict = {}
    for r in QUERIES["op3_neighbours"](spark, SF01).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(expect)
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        exact = dict(zip(ids.tolist(), (v @ v[ids == q][0]).tolist()))
        assert all(abs(exact[i] - s) < 1e-12 for _, i, s in found)
        hits += len({i for _, i, _ in found} & {i for i, _ in expect[q]})
    assert hits / (20 * len(expect)) >= 0.9


def test_neighbours_whole_index_is_exact(spark):
    """At a share of 1 the search is exact, with ties, a hot vector and rows that take no part."""
    rng = np.random.default_rng(3)
    v = rng.integers(-9, 10, (300, 6)) / 2  # products are exact, ties are ties
    v[100:200] = v[100]
    ids = np.arange(300)
    bad = [(1000, None), (1020, []), (1040, [0.0] * 6), (1060, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1080, [float("nan")] * 6),
           (1100, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]), (1120, [1.0, 2.0]), (None, [1.0] * 6)]
    rows = [(int(i), x.tolist()) for i, x in zip(ids, v)] + bad
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("v", F.lit(1)).withColumn("ids", F.lit(2))
    got: dict = {}
    for r in neighbours.search(df, share=1.0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    expect = {q: [i for i, _ in found] for q, found in brute(ids, v).items()}
    assert {q: [i for _, i in sorted(f)] for q, f in got.items()} == expect
    few = df.filter("vec_id < 25")
    assert neighbours.search(few).groupBy("query_id").count().collect()[0]["count"] <= 20
    assert neighbours.search(df.filter("vec_id = 20")).count() == 0
    assert neighbours.search(df.filter("false")).count() == 0


def test_neighbours_of_an_id_with_several_vectors(spark):
    """One list for each of an id's vectors; a row that is repeated as it is has one."""
    rng = np.random.default_rng(9)
    v = rng.integers(-9, 10, (120, 6)) / 2
    ids = np.arange(120)
    ids[61:63] = 20
    rows = [(int(i), x.tolist()) for i, x in zip(ids, v)]
    df = spark.createDataFrame(rows + rows[40:41], "vec_id bigint, embedding array<double>")
    got: dict = {}
    for r in neighbours.search(df, share=1.0).collect():
        got.setdefault((r.query_id, r.query_key), []).append((r["rank"], r.vec_id, r.score))
    assert Counter(q for q, _ in got) == {0: 1, 20: 3, 40: 1, 60: 1, 80: 1, 100: 1}
    lists = [[(i, s) for _, i, s in sorted(f)] for (q, _), f in got.items() if q == 20]
    everyone = np.append(ids, 40), np.vstack([v, v[40:41]])
    for at in (20, 61, 62):
        s = everyone[1] @ v[at]
        o = [(int(everyone[0][i]), float(s[i])) for i in np.lexsort((everyone[0], -s)) if everyone[0][i] != 20][:20]
        assert o in lists


@pytest.mark.parametrize("lengths", ["lognormal", "few_long"])
def test_neighbours_recall_at_unequal_lengths(spark, lengths):
    rng = np.random.default_rng(8)
    v = rng.standard_normal((1500, 32))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v *= (np.exp(0.5 * rng.standard_normal(1500)) if lengths == "lognormal" else np.where(rng.random(1500) < 0.05, 10, 1))[:, None]
    ids = np.arange(1500)
    df = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "vec_id bigint, embedding array<double>")
    got: dict = {}
    for r in neighbours.search(df).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    expect = brute(ids, v)
    assert set(got) == set(expect)
    assert sum(len(got[q] & {i for i, _ in found}) for q, found in expect.items()) / (20 * len(expect)) >= 0.9


def test_heap_visits_cells_in_order():
    rng = np.random.default_rng(4)
    for _ in range(50):
        d1, d2 = rng.random(rng.integers(1, 9)).round(1), rng.random(rng.integers(1, 9)).round(1)
        sizes = rng.integers(0, 4, (len(d1), len(d2)))
        for budget in (1, 5, 10 ** 6):
            out = neighbours.visit(d1, d2, sizes, budget)
            cells = {(i, j) for i, m in out.items() for j in range(len(d2)) if m >> j & 1}
            total = sum(sizes[c] for c in cells)
            assert total >= min(budget, sizes.sum())
            if cells:
                far = max(d1[i] + d2[j] for i, j in cells)
                nearer = {(i, j) for i in range(len(d1)) for j in range(len(d2)) if d1[i] + d2[j] < far and sizes[i, j]}
                assert nearer <= cells
                assert sum(sizes[c] for c in nearer) < budget


# secrets

@pytest.mark.parametrize("which", ["odd", "documents"])
def test_secrets(spark, odd, which):
    df = odd if which == "odd" else common.read(spark, SF01, "documents")
    spans = F.col("spans")
    got = secret_scan.scan_secrets(df).select(
        "doc_id", *[secret_scan.counted(spans, k).alias(k) for k in secret_scan.STRONG],
        F.sha2(secret_scan.listed(spans, secret_scan.STRONG), 256).alias("sha"), secret_scan.listed(spans).alias("all"))
    expect = Counter((r.doc_id, *plain.secrets(r.text)) for r in df.select("doc_id", "text").collect())
    assert Counter(tuple(r) for r in got.collect()) == expect


def test_weak_parts_need_company(spark):
    far = " x" * 500
    texts = ["user=bob only", "user=bob password=hunter2", "user=bob" + far + " password=hunter2", "ftp://host.example/x alone",
             "login: ann token: abcd see http://a.example.org/p", "user=bob http://a.example.org/p", "secret=abcde",
             "é😀 secret:token:abcdefghij", "token=token=abcdefgh", "AKIAAKIAAKIAAKIA user=ann", "PassWord = 'a.b/c+d=e-f_g'",
             "passwd=" + "a" * 5000 + " client_id=joe", "a" * 31 + " " + "a" * 32 + "g" + "0" * 33]
    rnd = __import__("random").Random(6)
    bits = ["user=", "token", "=", ":", " ", "secret", "abcdefgh", "AKIA", "ABCDEFGHIJKL", "://", "http", "a.b", '"', "'", "é", "0123456789abcdef", "\n", "api_key", "login"]
    texts += ["".join(rnd.choice(bits) for _ in range(40)) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.s for r in secret_scan.scan_secrets(df).select("doc_id", secret_scan.listed(F.col("spans")).alias("s")).collect()}
    assert got == {i: plain.secrets(t)[4] for i, t in enumerate(texts)}
    assert got[0] == "" and "login" in got[1] and "short" in got[1] and got[2] == "" and got[3] == ""
    assert "endpoint" in got[4] and got[5] == "" and got[6] == ""
    assert secret_scan.scan_secrets(df.filter("false")).count() == 0


# mixing

def test_mixing_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{table_path(SF001, 'documents')}'")
    o = con.sql(ORACLE["op10_mixing"])
    df = QUERIES["op10_mixing"](spark, SF001)
    assert sorted(df.columns) == sorted(o.columns)
    names = sorted(df.columns)
    assert sorted(tuple(r[c] for c in names) for r in df.collect()) == sorted(
        tuple(r[o.columns.index(c)] for c in names) for r in o.fetchall())


def test_mixing_meets_targets(spark):
    rows = [(i, "w " * (1 + i % 7), ["en", "fr"][i % 10 == 0], ["a", "b", "c"][min(i % 6, 2)], 0) for i in range(4000)]
    df = plain.table(spark, rows)
    topic = F.when(F.col("doc_id") % 2 == 0, "even").otherwise("odd")
    goal = {"source": {"a": 0.5, "b": 0.25, "c": 0.25}, "lang": {"en": 0.7, "fr": 0.3}, "topic": {"even": 0.6, "odd": 0.4}}
    tables = {d: spark.createDataFrame(list(g.items()) + [("absent", 5.0)], f"{d} string, target double") for d, g in goal.items()}
    got = mixing.sample(df, tables, topic).collect()
    assert len(got) == 4000
    expected = Counter()
    for r in got:
        assert 0 <= r.probability <= 1
        for d in goal:
            expected[d, r[d]] += r.probability * r.n_words
    total = sum(v for (d, _), v in expected.items() if d == "lang")
    for d, g in goal.items():
        for value, share in g.items():
            assert expected[d, value] / total == pytest.approx(share, abs=0.01)
    kept = sum(r.n_words for r in got if r.kept)
    assert kept == pytest.approx(total, rel=0.1)
    assert max(r.probability for r in got) == 1


def test_mixing_one_rare_document_does_not_thin_the_rest(spark):
    """A tiny source of a new language: the corpus keeps the stated share, cells above the scale stay whole."""
    rows = [(i, "w " * (40 + i % 7), ["en", "fr"][i % 10 == 0], ["a", "b", "c"][min(i % 6, 2)], 0) for i in range(4000)]
    df = plain.table(spark, [*rows, (9999, "w " * 50, "xx", "tiny", 0)])
    got = mixing.sample(df).collect()
    total = sum(r.n_words for r in got)
    assert sum(r.probability * r.n_words for r in got) / total >= mixing.KEEP - 1e-6
    assert sum(r.kept * r.n_words for r in got) / total == pytest.approx(mixing.KEEP, abs=0.03)
    assert all(r.probability == 1 for r in got if r.source == "tiny")
    share, cells = Counter(), {}
    for r in got:
        share[r.source, r.lang, r.topic] += r.n_words / total
        cells[r.source, r.lang, r.topic] = (r.weight, r.probability)
    scales = {round(w / share[c] / p, 4) for c, (w, p) in cells.items() if p < 1}
    assert len(scales) == 1 and all(w / share[c] >= min(scales) - 1e-3 for c, (w, p) in cells.items() if p == 1)
    thin = mixing.sample(df, keep=0.0).collect()
    assert sum(r.probability * r.n_words for r in thin) / total < 0.2


def test_mixing_odd_rows(spark, odd):
    got = mixing.sample(odd).collect()
    assert len(got) == odd.count()
    assert all(r.kept and r.probability == 1 and r.topic == "empty" for r in got if r.n_words == 0)
    assert {r.source for r in got if r.doc_id == 3} == {"(none)"}
    out = mixing.mix(odd)
    assert out.columns == odd.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter(r.doc_id for r in got if r.kept)
    zero = {"lang": spark.createDataFrame([("en", 1.0), ("fr", 0.0)], "lang string, target double")}
    assert all(r.probability == 0 for r in mixing.sample(odd, zero).collect() if r.lang == "fr" and r.n_words)
    assert mixing.sample(odd.filter("false")).count() == 0
    assert mixing.mix(odd.filter("false")).columns == odd.columns
