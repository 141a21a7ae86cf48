"""Phrase collocations by set-oriented relational mining (SETM).

The relation of level 1 has a row (doc, pos, word) for each occurrence of a
frequent word, in order of (doc, pos), persisted in buckets of ``doc``.  Positions
count the words and piece ends of a text, so neighbours of one piece are one
apart and pieces never touch.  Level k merge-joins the relation of level k - 1
with that of level 1 on the same document and the adjacent position; both lie in
the same buckets, so neither is shuffled.  Its phrases are counted per group,
and the occurrences are semi-joined with the groups of at least ``LEAST``, which
leaves the relation that the next level extends; from level 3 on, only words that
end a frequent pair are joined.  Phrases are ids: a word's id is
of its language and word, a longer phrase's of its first part and last word, so
equal ids are equal phrases.  Occurrences of words come as 64-bit hashes, under a
salt for which no word of the table has the hash of a frequent one; that is
checked on all words, so ids are exact.

A semi-join takes the groups along to the occurrences while they are at most
``CARRIED`` rows, counted on the written table.  Beyond, it is a shuffle join, and
what is left is dealt by document again.

The score of a candidate of a occurrences is the least over its cuts of
floor(2000000 * a / (l + r)), l and r the occurrences of the two parts, in
decimal arithmetic.  A candidate goes if a longer one that holds its words in a
row has at least 80 percent of its occurrences.

Defined results: null text is empty; null lang is ``und``, with the documents
that say so themselves; repeated rows count each time; a document without words
adds nothing; equal scores and counts are ranked by the phrase's bytes; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import common
from quarry.llm.tokens import sub_batches

LONGEST = 4
LEAST = 30
COVERED = 80
BEST = 2000
#: Groups that a semi-join carries to the occurrences; a row has about 100 bytes.
CARRIED = 500_000

SUB_BATCH = 1 << 22
COUNTED = 1 << 24
SALTS = 8

#: Characters that end a piece become line feeds, tabs become spaces.
_PLAIN = bytes.maketrans(b".,;:!?\x0b\x0c\x0d\x09", b"\n" * 9 + b" ")
_SPACED = bytes.maketrans(b".,;:!?", b" " * 6)


def _pieces(text: bytes | None) -> list[list[bytes]]:
    """The words of each piece, A-Z lower-cased."""
    return [p.split() for p in (text or b"").lower().translate(_PLAIN).split(b"\n")]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text) to (lang, word, f): the words of a batch, counted."""
    for b in batches:
        langs, texts = b.column("lang").to_pylist(), b.column("text").to_pylist()
        for s, e in sub_batches(texts, COUNTED):
            for lang in set(langs[s:e]):
                spaced = [(t or b"").lower().translate(_SPACED) for x, t in zip(langs[s:e], texts[s:e]) if x == lang]
                found = pc.value_counts(pc.ascii_split_whitespace(pa.array(spaced, pa.binary()).cast(pa.string())).flatten())
                found = found.filter(pc.not_equal(found.field("values"), ""))
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), found.field("values"), found.field("counts")],
                                                     names=["lang", "word", "f"])


def _occurrences(salt: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (doc, lang, text) to (doc, pos, h) for each word; h is Spark's xxhash64 of salted language and word."""
    def occur(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, langs, texts = (b.column(c).to_pylist() for c in ("doc", "lang", "text"))
            for s, e in sub_batches(texts, SUB_BATCH):
                ids, at, hashes = [], [], []
                for doc, lang, text in zip(docs[s:e], langs[s:e], texts[s:e]):
                    seed = xxhash.xxh64_intdigest((salt + lang).encode(), 42)
                    pieces = _pieces(text)
                    sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
                    hashes += [xxhash.xxh64_intdigest(w, seed) for words in pieces for w in words]
                    # a piece's end takes a position of its own
                    at.append(np.arange(sizes.sum()) + np.repeat(np.arange(len(sizes)), sizes))
                    ids.append(np.full(sizes.sum(), doc))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(ids).astype(np.int64)), pa.array(np.concatenate(at).astype(np.int64)),
                     pa.array(np.array(hashes, dtype=np.uint64).view(np.int64))], names=["doc", "pos", "h"])

    return occur


def _lexicon(counts: DataFrame, least: int) -> tuple[DataFrame, str]:
    """(id, lang, word, f, h) of the frequent words, and the salt: no other word at all has the hash of one."""
    level = _groups(counts.filter(F.col("f") >= least), "1")
    for salt in map(str, range(SALTS)):
        h = F.xxhash64(F.concat(F.lit(salt), "lang"), "word")
        hashed = common.materialise(level.withColumn("h", h), "setm-lexicon")
        shared = counts.select(h.alias("h")).join(hashed.select("h"), "h", "left_semi").groupBy("h").count().filter("count > 1")
        if shared.isEmpty():
            return hashed, salt
    raise RuntimeError("words share hashes under every salt")


def _groups(counted: DataFrame, name: str) -> DataFrame:
    """Numbered groups; numbers are fixed by the written table."""
    written = common.materialise(counted, f"setm-groups-{name}")
    return common.materialise(written.withColumn("id", F.monotonically_increasing_id()), f"setm-numbered-{name}")


@contextmanager
def _settings(spark, **values: str) -> Iterator[None]:
    """Planner settings while relations are joined; all that needs them runs inside."""
    names = {k: f"spark.sql.{k.replace('__', '.')}" for k in values}
    before = {k: spark.conf.get(name, None) for k, name in names.items()}
    try:
        for k, v in values.items():
            spark.conf.set(names[k], v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(names[k], v) if v is not None else spark.conf.unset(names[k])


class _Buckets:
    """Tables in buckets of ``doc``, sorted by (doc, position), in the shared folder."""

    def __init__(self, spark, n: int):
        self.spark, self.n, self.names = spark, n, []

    def write(self, rows: DataFrame, position: str) -> DataFrame:
        name = f"setm_{uuid.uuid4().hex}"
        (rows.write.format("parquet").option("path", common.scratch(self.spark, "setm-relation"))
         .bucketBy(self.n, "doc").sortBy("doc", position).saveAsTable(name))
        self.names.append(name)
        return self.spark.table(name)

    def forget(self) -> None:
        """The names only; the files belong to the application's folder."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _semi(rows: DataFrame, groups: DataFrame, on: list[str], carried: int) -> tuple[DataFrame, bool]:
    """``rows`` with the id of their group; whether they stayed where they were."""
    small = groups.limit(carried + 1).count() <= carried
    return rows.join(F.broadcast(groups) if small else groups, on), small


def relations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, carried: int = CARRIED) -> tuple[DataFrame, DataFrame]:
    """(lang, n): all words; and (lang, words, phrase, f) of each frequent phrase of up to ``longest`` words.

    ``words`` holds the words' ids.
    """
    spark = docs.sparkSession
    # a join on (doc, position) may use buckets of doc, and the order within them
    with _settings(spark, requireAllClusterKeysForCoPartition="false", legacy__bucketedTableScan__outputOrdering="true"):
        return _relations(docs, longest, least, carried)


def _relations(docs: DataFrame, longest: int, least: int, carried: int) -> tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = _Buckets(spark, n)
    try:
        src = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
        counts = common.materialise(src.mapInArrow(_count, "lang string, word string, f bigint")
                                    .groupBy("lang", "word").agg(F.sum("f").alias("f")), "setm-words")
        total = counts.groupBy("lang").agg(F.sum("f").alias("n"))
        level, salt = _lexicon(counts, least)
        lexicon = level.select(F.col("id").alias("w"), "lang", "word")

        dealt = src.withColumn("doc", F.monotonically_increasing_id()).repartition(n, "doc").sortWithinPartitions("doc")
        found = dealt.select("doc", "lang", "text").mapInArrow(_occurrences(salt), "doc bigint, pos bigint, h bigint")
        found, stayed = _semi(found, level.select("h", F.col("id").alias("w")), ["h"], carried)
        found = found.select("doc", "pos", "w")
        first = buckets.write(found if stayed else found.repartition(n, "doc"), "pos")

        phrases = level.select("id", "lang", F.array("id").alias("words"), F.col("word").alias("phrase"), "f")
        everything = phrases
        before = first.select("doc", (F.col("pos") + 1).alias("next"), F.col("w").alias("start"))
        after = first.withColumnRenamed("pos", "next")
        for k in range(2, longest + 1):
            met = before.join(after, ["doc", "next"])
            level = _groups(met.groupBy("start", "w").agg(F.count("*").alias("f")).filter(F.col("f") >= least), str(k))
            part = phrases.select(F.col("id").alias("start"), "lang", F.col("words").alias("sofar"), F.col("phrase").alias("text"))
            phrases = common.materialise(
                level.join(part, "start").join(lexicon.drop("lang"), "w")
                .select("id", "lang", F.array_append("sofar", F.col("w")).alias("words"), F.concat_ws(" ", "text", "word").alias("phrase"), "f"),
                f"setm-phrases-{k}")
            everything = everything.unionByName(phrases)
            if k < longest:
                kept, stayed = _semi(met, level.select("start", "w", "id"), ["start", "w"], carried)
                kept = kept.select("doc", "next", F.col("id").alias("start"), "w")
                kept = buckets.write(kept if stayed else kept.repartition(n, "doc"), "next")
                before = kept.select("doc", (F.col("next") + 1).alias("next"), "start")
                if k == 2:  # a word that ends no frequent pair can't end a longer phrase
                    after = kept.select("doc", "next", "w")
        return total, everything.drop("id")
    finally:
        buckets.forget()


def _score(a: Column, both: Column) -> Column:
    return F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * a.cast("decimal(20,0)"), both.cast("decimal(21,0)"))


def scored(phrases: DataFrame) -> DataFrame:
    """Candidates (phrases of two words or more) with the cut that scores least: a, l, r, score."""
    known = phrases.select("words", "f")
    cuts = phrases.filter(F.size("words") > 1).select(
        "*", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.withColumn("head", F.slice("words", F.lit(1), F.col("k"))).withColumn("tail", F.expr("slice(words, k + 1, size(words) - k)"))
    both = (cuts.join(known.select(F.col("words").alias("head"), F.col("f").alias("l")), "head")
            .join(known.select(F.col("words").alias("tail"), F.col("f").alias("r")), "tail")
            .withColumn("score", _score(F.col("f"), F.col("l") + F.col("r"))))
    least = both.groupBy("words").agg(F.min(F.struct("score", "k", "l", "r", "lang", "phrase", F.col("f").alias("a"))).alias("cut"))
    return least.select("words", "cut.lang", "cut.phrase", "cut.a", "cut.l", "cut.r", "cut.score")


def uncovered(candidates: DataFrame, percent: int = COVERED) -> DataFrame:
    """``candidates`` without those that a longer one holds ``percent`` of."""
    size = F.size("words")
    spans = candidates.filter(size > 2).select("words", "a", F.explode(F.sequence(F.lit(2), size - 1)).alias("m"))
    spans = spans.select("words", "a", "m", F.explode(F.expr("sequence(1, size(words) - m + 1)")).alias("s"))
    inside = spans.groupBy(F.expr("slice(words, s, m)").alias("words")).agg(F.max("a").alias("longer"))
    return (candidates.join(inside, "words", "left")
            .filter(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a"))).drop("longer"))


def best(candidates: DataFrame, most: int = BEST) -> DataFrame:
    """The first ``most`` of each language with their rank; parts of a language are cut before they meet."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    n = int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(n))
    some = (candidates.withColumn("part", part)
            .withColumn("nth", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("nth") <= most))
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= most)


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, most: int = BEST, carried: int = CARRIED) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of ``docs`` (lang, text)."""
    total, phrases = relations(docs, longest, least, carried)
    candidates = common.materialise(scored(phrases), "setm-candidates")
    ranked = best(uncovered(candidates), most)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH token AS (
  SELECT doc, lang, unnest(t) AS w, generate_subscripts(t, 1) AS pos
  FROM (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
               regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x20\x09.,;:!?\x0A-\x0D]+|[.,;:!?\x0A-\x0D]') AS t FROM documents)),
word AS MATERIALIZED (SELECT * FROM token WHERE NOT regexp_matches(w, '^[.,;:!?\x0A-\x0D]')),
total AS (SELECT lang, count(*) AS n FROM word GROUP BY lang),
two AS MATERIALIZED (SELECT x.doc, x.lang, x.pos, [x.w, y.w] AS p FROM word x JOIN word y ON y.doc = x.doc AND y.pos = x.pos + 1),
three AS MATERIALIZED (SELECT x.doc, x.lang, x.pos, list_append(x.p, y.w) AS p FROM two x JOIN word y ON y.doc = x.doc AND y.pos = x.pos + 2),
four AS (SELECT x.lang, list_append(x.p, y.w) AS p FROM three x JOIN word y ON y.doc = x.doc AND y.pos = x.pos + 3),
f AS MATERIALIZED (
  SELECT lang, p, count(*) AS f FROM (
    SELECT lang, [w] AS p FROM word UNION ALL SELECT lang, p FROM two UNION ALL SELECT lang, p FROM three UNION ALL SELECT lang, p FROM four)
  GROUP BY lang, p HAVING count(*) >= 30),
cut AS (SELECT lang, p, f AS a, unnest(range(1, len(p))) AS k FROM f WHERE len(p) > 1),
part AS (
  SELECT c.*, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
  FROM cut c JOIN f x ON x.lang = c.lang AND x.p = c.p[1:c.k] JOIN f y ON y.lang = c.lang AND y.p = c.p[c.k + 1:]),
cand AS MATERIALIZED (SELECT * FROM part QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
size AS (SELECT lang, p, a, unnest(range(2, len(p))) AS m FROM cand),
span AS (SELECT lang, p, a, m, unnest(range(1, len(p) - m + 2)) AS s FROM size),
inside AS (SELECT lang, p[s:s + m - 1] AS p, max(a) AS longer FROM span GROUP BY ALL),
kept AS (
  SELECT c.*, array_to_string(c.p, ' ') AS phrase FROM cand c LEFT JOIN inside i ON i.lang = c.lang AND i.p = c.p
  WHERE i.longer IS NULL OR 100 * i.longer < 80 * c.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN total USING (lang) QUALIFY rank <= 2000
"""
