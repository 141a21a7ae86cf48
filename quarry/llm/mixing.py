"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic.  The cells' shares of
all tokens are raked: scaled to the target of each source, then each language,
then each topic, ``ROUNDS`` times over.  A cell's calibrated weight over its
present share is its ratio, and min(1, ratio / scale) the probability of each of
its documents: no document is wanted more than once.  With the greatest ratio of
any cell as scale, expected tokens stand in the calibrated proportions, but one
tiny cell of a great ratio then thins the whole corpus.  So the scale is at most
what keeps ``keep`` of all tokens in expectation: cells of greater ratios stay
whole and fall short of their calibrated share, all others stand in proportion.
By default ``KEEP`` is wanted with tempered targets, and nothing (the exact
proportions) where a caller gives targets.  A document stays if a uniform
number from the MD5 of its id is below its probability, so a sample is the same
at every partitioning and after every retry.

Targets default to tempered shares (share ** alpha, normalised): large sources
and languages give way to small ones.  Tokens are words
(``[^\\x20\\x09-\\x0D]+``); the topic defaults to the text's form.

Cells stay a table: rounds are joins and aggregates over it, and only totals
reach the driver.

Defined results: null text is empty; null source, language or topic is the
value ``(none)``; documents without words weigh nothing and stay (probability
1); values with a target of zero get probability 0, and a target for a value
without documents is left out; a null doc_id hashes as the empty string;
repeated rows share one decision; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import common

ROUNDS = 10
ALPHAS = {"source": 0.7, "lang": 0.7, "topic": 1.0}
KEEP = 0.6
SEED = 7
DIGITS = 9
NONE = "(none)"


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def form(text: str = "text", words: str = "n_words") -> Column:
    """The default topic: what shape a text has."""
    t, n = F.col(text), F.col(words)
    return (F.when(n == 0, "empty").when(F.contains(t, F.lit(" | ")), "table")
            .when(n < 100, "note").when(n < 1000, "article").otherwise("long"))


def celled(docs: DataFrame, topic: Column | None = None) -> DataFrame:
    """doc_id, text_key, source, lang, topic, n_words."""
    rows = docs.select("doc_id", common.row_key().alias("text_key"), "text",
                       F.coalesce("source", F.lit(NONE)).alias("source"), F.coalesce("lang", F.lit(NONE)).alias("lang"),
                       n_words().alias("n_words"), *([topic.alias("topic")] if topic is not None else []))
    t = F.coalesce(F.col("topic"), F.lit(NONE)) if topic is not None else form()
    return rows.select("doc_id", "text_key", "source", "lang", t.alias("topic"), "n_words")


def tempered(cells: DataFrame, dim: str, alpha: float) -> DataFrame:
    """Default targets (dim, target): shares of the tokens, tempered; they need not add up to 1."""
    by = cells.groupBy(dim).agg(F.sum("share").alias("share"))
    return by.select(dim, F.when(F.col("share") > 0, F.pow("share", F.lit(alpha))).otherwise(0.0).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (dims, share, ...) with ``weight``, shares fitted to the marginal targets in turn.

    Targets become columns of the cells once, so a step is one aggregate and one
    join with its sums, whose size AQE measures; a round is written as it ends.
    """
    fitted = cells.withColumn("weight", F.col("share"))
    for dim, goal in targets.items():
        held = cells.groupBy(dim).agg(F.sum("share").alias("now")).filter("now > 0").select(dim)
        held = common.materialise(held.join(goal, dim).select(dim, F.col("target").cast("double").alias("target")), f"mix-{dim}")
        total = held.agg(F.sum("target")).first()[0] or 1.0
        fitted = fitted.join(held.select(dim, (F.col("target") / F.lit(total)).alias(f"target_{dim}")), dim, "left")
    fitted = common.materialise(fitted.na.fill(0.0, [f"target_{dim}" for dim in targets]), "mix-start")
    for _ in range(rounds):
        for dim in targets:
            now = fitted.groupBy(dim).agg(F.sum("weight").alias("now"))
            scaled = F.coalesce(F.try_divide(F.col("weight") * F.col(f"target_{dim}"), F.col("now")), F.lit(0.0))
            fitted = fitted.join(now, dim).withColumn("weight", scaled).drop("now")
        fitted = common.materialise(fitted, "mix-round")
    return fitted.drop(*[f"target_{dim}" for dim in targets])


def inverse_scale(fitted: DataFrame, keep: float) -> float:
    """The least u, from 1 / the greatest ratio on, at which probabilities min(1, ratio * u) keep ``keep`` of the tokens.

    What is kept is concave in u and linear between the ratios' inverses, so
    tangents rise to the answer in a few steps; each needs two sums.  Where the
    cells with a weight hold less than ``keep``, all of them become whole.
    """
    ratio = F.try_divide("weight", "share")
    most = fitted.agg(F.max(ratio)).first()[0]
    if not most:
        return 1.0
    u = 1.0 / most
    while True:
        whole = ratio * F.lit(u) >= 1 - 10.0 ** -DIGITS
        full, rest = fitted.filter("share > 0").agg(F.coalesce(F.sum(F.when(whole, F.col("share"))), F.lit(0.0)),
                                                    F.coalesce(F.sum(F.when(~whole, F.col("weight"))), F.lit(0.0))).first()
        if rest <= 0 or (keep - full) / rest <= u * (1 + 1e-12):
            return u
        # not beyond the point where the least ratio is whole: rounding can leave a tangent almost flat
        least = fitted.filter("share > 0 and weight > 0").agg(F.min(ratio)).first()[0]
        u = min((keep - full) / rest, 1.0 / least)


def probabilities(rows: DataFrame, targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS,
                  keep: float | None = None) -> DataFrame:
    """source, lang, topic, share, weight, probability of each cell of ``celled`` rows."""
    dims = list(ALPHAS)
    cells = rows.groupBy(*dims).agg(F.sum("n_words").alias("tokens"))
    cells = common.materialise(cells, "mix-cells")
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    cells = cells.select(*dims, (F.col("tokens") / F.lit(total)).alias("share"))
    goals = {d: (targets or {}).get(d) for d in dims}
    fitted = rake(cells, {d: g if g is not None else tempered(cells, d, ALPHAS[d]) for d, g in goals.items()}, rounds)
    ratio = F.try_divide("weight", "share")
    wanted = keep if keep is not None else 0.0 if targets else KEEP
    most = fitted.agg(F.max(ratio)).first()[0] or 1.0
    scale = min(most, 1.0 / inverse_scale(fitted, wanted)) if wanted else most
    p = F.when(F.col("share") == 0, 1.0).otherwise(F.round(F.least(ratio / F.lit(scale), F.lit(1.0)), DIGITS))
    return fitted.select(*dims, "share", "weight", p.alias("probability"))


def uniform(doc_id: str = "doc_id") -> Column:
    """[0, 1) from 52 bits of the MD5 of seed and id."""
    digest = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def sample(docs: DataFrame, targets: dict[str, DataFrame] | None = None, topic: Column | None = None,
           keep: float | None = None) -> DataFrame:
    """doc_id, source, lang, topic, n_words, weight (of the cell), probability, kept, text_key."""
    rows = common.materialise(celled(docs, topic), "mix-rows")  # words are counted once
    cells = common.materialise(probabilities(rows, targets, keep=keep), "mix-probabilities")
    return (rows.join(cells, list(ALPHAS))
            .select("doc_id", "source", "lang", "topic", "n_words", F.round("weight", DIGITS).alias("weight"),
                    "probability", (uniform() < F.col("probability")).alias("kept"), "text_key"))


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, topic: Column | None = None,
        keep: float | None = None) -> DataFrame:
    """The sampled rows of ``docs``, all columns kept."""
    return common.keep_rows(docs, sample(docs, targets, topic, keep).filter("kept").select("doc_id", "text_key"))


def oracle() -> str:
    """The digest query in SQL, its rounds written out."""
    dims = list(ALPHAS)
    step = "SELECT *, share AS w0 FROM cells"
    n = 0
    for _ in range(ROUNDS):
        for d in dims:
            step = (f"SELECT * REPLACE (coalesce(w0 * target_{d} / nullif(sum(w0) OVER (PARTITION BY {d}), 0), 0) AS w0) FROM ({step})")
            n += 1
    goals = "\n".join(
        f"""goal_{d} AS (SELECT {d}, CASE WHEN sum(share) > 0 THEN pow(sum(share), {a}) ELSE 0.0 END AS t FROM cell GROUP BY {d}),"""
        for d, a in ALPHAS.items())
    joins = " ".join(f"JOIN goal_{d} USING ({d})" for d in dims)
    goal_cols = ", ".join(f"goal_{d}.t / (SELECT sum(t) FROM goal_{d}) AS target_{d}" for d in dims)
    return rf"""
WITH words AS (
  SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang, text,
         coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS n_words
  FROM documents),
docs AS MATERIALIZED (
  SELECT doc_id, source, lang, n_words,
         CASE WHEN n_words = 0 THEN 'empty' WHEN contains(text, ' | ') THEN 'table' WHEN n_words < 100 THEN 'note'
              WHEN n_words < 1000 THEN 'article' ELSE 'long' END AS topic
  FROM words),
cell AS MATERIALIZED (
  SELECT source, lang, topic, sum(n_words) / greatest((SELECT sum(n_words) FROM docs), 1) AS share
  FROM docs GROUP BY source, lang, topic),
{goals}
cells AS MATERIALIZED (SELECT source, lang, topic, share, {goal_cols} FROM cell {joins}),
fitted AS MATERIALIZED (SELECT source, lang, topic, share, w0 AS weight FROM ({step})),
odds AS MATERIALIZED (
  SELECT source, lang, topic, weight, CASE WHEN share = 0 THEN 1.0 ELSE
         round(weight / share / (SELECT max(weight / nullif(share, 0)) FROM fitted), {DIGITS}) END AS probability
  FROM fitted)
SELECT doc_id, source, lang, topic, n_words, round(weight, {DIGITS}) AS weight, probability,
       ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / {float(1 << 52)} < probability AS kept
FROM docs JOIN odds USING (source, lang, topic)"""
