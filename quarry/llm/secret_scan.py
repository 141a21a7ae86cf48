"""Secrets in texts, with weak candidates confirmed by their company.

Strong kinds are reported wherever they stand.  Weak kinds (a login name, a
short secret value, an endpoint) mean little alone: each is reported only if
the parts that complement it occur in the same scope, so that together they
form a credential.  Scopes are intervals of ``2 * SCOPE`` code points that
start every ``SCOPE``; each part lies in two of them, and any two parts less
than ``SCOPE`` apart share one.  The interval join is on (row, scope): parts
meet one summary row per scope, never each other.

Spans come from DataFrame functions alone: the matches of a regex and the
pieces between them (``regexp_extract_all`` and ``split`` by the same regex)
give every span's place by a running sum.

Defined results: null text is empty; a row without spans gives empty lists;
repeated rows, and rows with null ids, are scanned on their own; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import common

SCOPE = 400

_SEP = r"""["']?\x20*[:=]\x20*["']?"""


class Kind(NamedTuple):
    name: str
    regex: str
    group: int  # whose length counts
    least: int
    part: str  # role in a credential
    needs: tuple[str, ...]  # parts that a weak kind must meet in its scope
    hint: str | None = None  # a string every match holds


#: Strong kinds first, in the order of reports.  ``short`` are the matches of
#: the assignment regex whose value is too short for ``assign``.
KINDS = (
    Kind("assign", r"(?i:password|passwd|secret|token|api_?key)" + _SEP + r"([A-Za-z0-9+/_.=-]+)", 1, 8, "secret", ()),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 16, "identifier", (), "AKIA"),
    Kind("hex", r"[0-9a-f]{32,}", 0, 32, "secret", ()),
    Kind("login", r"(?i:user(?:name)?|login|client_?id)" + _SEP + r"([A-Za-z0-9._@+-]+)", 1, 3, "identifier", ("secret",)),
    Kind("short", "", 1, 4, "secret", ("identifier",)),
    Kind("endpoint", r"[a-z][a-z0-9+]*://[A-Za-z0-9._~:/?#@$&*+,;=%-]+", 0, 10, "endpoint", ("identifier", "secret"), "://"),
)
NAMES = [k.name for k in KINDS]
STRONG = [k.name for k in KINDS if not k.needs]


def _matches(kind: Kind, text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(kind.regex), F.lit(0))
    return F.when(F.contains(text, F.lit(kind.hint)), found) if kind.hint else found


def _pieces(kind: Kind, i: int, text: Column, matches: Column) -> Column:
    """Array of (kind, nth, gap before, length, counted length); null if there is no match."""
    args = [matches, F.split(text, kind.regex, -1)]
    if kind.group:
        args.append(F.regexp_extract_all(text, F.lit(kind.regex), F.lit(kind.group)))
    names = [f"{i}" for i in range(len(args))]
    zipped = F.arrays_zip(*[a.alias(n) for a, n in zip(args, names)])
    piece = F.transform(zipped, lambda x, n: F.struct(
        F.lit(i).alias("kind"), n.alias("nth"), F.length(x["1"]).alias("gap"), F.length(x["0"]).alias("len"),
        F.length(x["2" if kind.group else "0"]).alias("counted")))
    return F.when(F.size(matches) > 0, piece)


def find_parts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (row, doc_id), and their parts (row, kind, start, end), weak candidates included."""
    scanned = [(i, k) for i, k in enumerate(KINDS) if k.regex]
    src = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                      F.coalesce("text", F.lit("")).alias("text"))
    found = src.select("*", *[_matches(k, F.col("text")).alias(f"m{i}") for i, k in scanned])
    rows = common.materialise(found.select(
        "row", "doc_id",
        F.flatten(F.array_compact(F.array(*[_pieces(k, i, F.col("text"), F.col(f"m{i}")) for i, k in scanned])))
        .alias("pieces")), "secret-pieces")
    piece = rows.select("row", F.explode("pieces").alias("p")).select("row", "p.*").filter("len is not null")
    upto = Window.partitionBy("row", "kind").orderBy("nth")
    placed = piece.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(upto))
    kind = F.col("kind")
    short = NAMES.index("short")
    for i, k in enumerate(KINDS):
        if k.name == "assign":
            kind = F.when((F.col("kind") == i) & (F.col("counted") < k.least),
                          F.when(F.col("counted") >= KINDS[short].least, F.lit(short))).otherwise(kind)
        elif k.regex:
            kind = F.when((F.col("kind") == i) & (F.col("counted") < k.least), F.lit(None)).otherwise(kind)
    parts = (placed.select("row", kind.alias("kind"), (F.col("end") - F.col("len")).alias("start"), "end")
             .filter("kind is not null"))
    return rows.select("row", "doc_id"), parts


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and spans: array of (start, nth kind, end, kind, scope), in that order.

    scope is null for strong kinds, else the first scope in which the
    candidate met its complements.
    """
    rows, found = find_parts(docs)
    parts = common.materialise(found, "secret-parts")
    role = F.element_at(F.array(*[F.lit(k.part) for k in KINDS]), F.col("kind") + 1)
    scope = F.floor(F.col("start") / SCOPE)
    spread = parts.withColumn("part", role).withColumn("scope", F.explode(F.array(scope - 1, scope)))
    has = {p: F.max((F.col("part") == p).cast("int")).alias(p) for p in ("identifier", "secret", "endpoint")}
    scopes = spread.groupBy("row", "scope").agg(*has.values())
    weak = [i for i, k in enumerate(KINDS) if k.needs]
    met = F.lit(False)
    for i in weak:
        need = F.lit(True)
        for p in KINDS[i].needs:
            need = need & (F.col(p) == 1)
        met = F.when(F.col("kind") == i, need).otherwise(met)
    linked = (spread.filter(F.col("kind").isin(weak)).join(scopes, ["row", "scope"]).filter(met)
              .groupBy("row", "kind", "start", "end").agg(F.min("scope").alias("scope")))
    strong = parts.filter(~F.col("kind").isin(weak)).select("row", "kind", "start", "end", F.lit(None).cast("bigint").alias("scope"))
    name = F.element_at(F.array(*[F.lit(n) for n in NAMES]), F.col("kind") + 1)
    spans = (strong.unionByName(linked)
             .select("row", F.struct("start", F.col("kind").alias("nth"), "end", name.alias("kind"), "scope").alias("span"))
             .groupBy("row").agg(F.array_sort(F.collect_list("span")).alias("spans")))
    return rows.join(spans, "row", "left").select("doc_id", "spans")


def listed(spans: Column, kinds: list[str] | None = None) -> Column:
    """Spans as kind:start:end, comma-joined; null lists are empty."""
    if kinds is not None:
        spans = F.filter(spans, lambda s: s["kind"].isin(kinds))
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.coalesce(F.array_join(F.transform(spans, one), ","), F.lit(""))


def counted(spans: Column, kind: str) -> Column:
    n = F.size(F.filter(spans, lambda s: s["kind"] == kind))
    return F.when(spans.isNull(), F.lit(0)).otherwise(n).cast("bigint")
