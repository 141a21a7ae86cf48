"""SQL-style analysis of the rating data.

The rating fact is one event per order line: user = o_custkey, part =
l_partkey, rating = l_quantity (1..50), rated_at = o_orderdate; titles come
from ``part``, segments and places from ``customer``/``nation``/``region``.
``nation`` and ``region`` are fixed-size code tables (25 and 5 rows), so they
are broadcast explicitly; ``part`` and ``customer`` grow with the data and
are left to AQE, which broadcasts them only when their runtime size is small.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.operators import distinct as D
from quarry.operators import relational as R
from quarry.session import cut_lineage
from quarry.sources.fixtures import rating_events
from quarry.sources.tables import TABLES, read_table, register_views

# Parameters of the registered queries.
TOP_K = 10
MIN_RATINGS = 30
MONTH = (1996, 3)
SEGMENTS = ("BUILDING", "AUTOMOBILE")


def _events(spark, sf_dir) -> DataFrame:
    return rating_events(spark, sf_dir)


def _with_item(spark, sf_dir, df) -> DataFrame:
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"])
    return df.join(part, df.partkey == part.p_partkey).withColumnRenamed("p_name", "item")


def _with_segment(spark, sf_dir, df, *more) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment", *more])
    return df.join(cust, df.user == cust.c_custkey).withColumnRenamed("c_mktsegment", "segment")


def _in_month(df, ym=MONTH) -> DataFrame:
    """A date range, so that it is pushed into the scan."""
    first = datetime.date(ym[0], ym[1], 1)
    nxt = datetime.date(ym[0] + ym[1] // 12, ym[1] % 12 + 1, 1)
    return df.where((F.col("rated_at") >= F.lit(first)) & (F.col("rated_at") < F.lit(nxt)))


def q_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table registered as a view; row count per view via SQL."""
    names = register_views(spark, sf_dir, TABLES)
    sql = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in names)
    return spark.sql(sql)


def q_star_join(spark, sf_dir):
    """Fact with item, segment, nation and region attributes."""
    ev = _with_segment(spark, sf_dir, _with_item(spark, sf_dir, _events(spark, sf_dir)), "c_nationkey")
    nation = F.broadcast(read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"]))
    region = F.broadcast(read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"]))
    return (ev.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("user", "partkey", "item", "rating", "rated_at", "segment",
                    F.col("n_name").alias("nation"), F.col("r_name").alias("region")))


def _item_counts(spark, sf_dir):
    ev = _with_item(spark, sf_dir, _events(spark, sf_dir))
    return ev.groupBy("item").agg(F.count("*").alias("n_ratings"),
                                  F.round(F.avg("rating"), 6).alias("mean_rating"))


def q_most_rated(spark, sf_dir):
    """S3: items by number of ratings, top k (ties by title)."""
    return R.top_k(_item_counts(spark, sf_dir), ["-n_ratings"], TOP_K, ["item"])


def q_top_rated(spark, sf_dir):
    """Parts by mean rating among those with >= MIN_RATINGS ratings."""
    ev = _events(spark, sf_dir)
    agg = (ev.groupBy("partkey").agg(F.count("*").alias("n_ratings"),
                                     F.round(F.avg("rating"), 6).alias("mean_rating"))
           .where(F.col("n_ratings") >= MIN_RATINGS))
    return R.top_k(agg, ["-mean_rating"], TOP_K, ["partkey"])


def _segment_items(spark, sf_dir):
    ev = _with_segment(spark, sf_dir, _with_item(spark, sf_dir, _events(spark, sf_dir)))
    return ev.groupBy("segment", "item").agg(F.count("*").alias("n_ratings"),
                                             F.round(F.avg("rating"), 6).alias("mean_rating"))


def q_top_by_group(spark, sf_dir):
    """Best 3 items by mean rating per customer segment."""
    return R.top_per_group(_segment_items(spark, sf_dir), ["segment"], ["-mean_rating"], 3, ["item"])


def q_rank_ties(spark, sf_dir):
    """Rank and dense_rank of items by rating count within each segment."""
    items = cut_lineage(_segment_items(spark, sf_dir).select("segment", "item", "n_ratings"))
    return R.ranks(items, ["segment"], "n_ratings").select("segment", "item", "n_ratings", "rnk", "dense_rnk")


def _rating_cells(spark, sf_dir):
    ev = _with_item(spark, sf_dir, _events(spark, sf_dir))
    return ev.groupBy("user", "item").agg(F.avg("rating").alias("rating"))


def q_rating_hist(spark, sf_dir):
    """Star histogram (stars = ceil(rating / 10)) per segment, a column per
    star; ratings outside 1 to 5 stars, or none, count in ``stars_other``."""
    cells = _with_segment(spark, sf_dir, _rating_cells(spark, sf_dir))
    stars = cells.select("segment", F.ceil(F.col("rating") / 10).cast("int").alias("stars"))
    count = lambda cond: F.count(F.when(cond, 1))
    known = F.coalesce(F.col("stars").between(1, 5), F.lit(False))
    return stars.groupBy("segment").agg(*[count(F.col("stars") == s).alias(f"stars_{s}") for s in range(1, 6)],
                                        count(~known).alias("stars_other"))


def _monthly(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return (ev.groupBy(F.year("rated_at").alias("yr"), F.month("rated_at").alias("mon"))
            .agg(F.count("*").alias("n_ratings"), F.avg("rating").alias("mean_raw")))


def q_trend(spark, sf_dir):
    """Ratings and mean rating per year and month."""
    return _monthly(spark, sf_dir).select("yr", "mon", "n_ratings",
                                          F.round("mean_raw", 6).alias("mean_rating"))


def q_trend_change(spark, sf_dir):
    """Change in count and mean against the previous month (lag).

    The window runs over the monthly aggregate (one row per month), so its
    single partition is bounded by the calendar, not by the data volume.
    """
    w = Window.orderBy("yr", "mon")
    m = _monthly(spark, sf_dir)
    return m.select("yr", "mon", "n_ratings",
                    (F.col("n_ratings") - F.lag("n_ratings").over(w)).alias("d_ratings"),
                    F.round(F.col("mean_raw") - F.lag("mean_raw").over(w), 6).alias("d_mean"))


def q_moving_avg(spark, sf_dir):
    """3-month moving mean of the monthly mean rating."""
    w = Window.orderBy("yr", "mon").rowsBetween(-2, 0)
    m = _monthly(spark, sf_dir)
    return m.select("yr", "mon", F.round(F.avg("mean_raw").over(w), 6).alias("mean_3m"))


def q_genre_explode(spark, sf_dir):
    """Title words as a multi-valued attribute; mean rating per word."""
    ev = _with_item(spark, sf_dir, _events(spark, sf_dir))
    words = ev.select("rating", F.explode(F.split("item", " ")).alias("genre"))
    return words.groupBy("genre").agg(F.count("*").alias("n_ratings"),
                                      F.round(F.avg("rating"), 6).alias("mean_rating"))


def q_active_users(spark, sf_dir):
    """Users by ratings given, top k (ties by user)."""
    agg = _events(spark, sf_dir).groupBy("user").agg(F.count("*").alias("n_ratings"))
    return R.top_k(agg, ["-n_ratings"], TOP_K, ["user"])


def q_above_user_mean(spark, sf_dir):
    """Per user, ratings strictly above the user's own mean."""
    counts = cut_lineage(R.value_counts(_events(spark, sf_dir), ["user"], "rating"))
    return R.above_mean(counts, ["user"], "rating")


def q_never_rated(spark, sf_dir):
    """Parts with no rating in MONTH (anti-join)."""
    part = read_table(spark, sf_dir, "part", ["p_partkey"])
    rated = _in_month(_events(spark, sf_dir)).select("partkey")
    return part.join(rated, part.p_partkey == rated.partkey, "left_anti")


def _segment_parts(spark, sf_dir):
    """partkey, and whether it was rated in each of SEGMENTS in MONTH: one pass."""
    ev = _with_segment(spark, sf_dir, _in_month(_events(spark, sf_dir))).where(F.col("segment").isin(*SEGMENTS))
    return ev.groupBy("partkey").agg(*[F.max(F.col("segment") == s).alias(c) for s, c in zip(SEGMENTS, ("a", "b"))])


def q_rated_by_both(spark, sf_dir):
    """Parts rated in both SEGMENTS in MONTH (INTERSECT, distinct)."""
    return _segment_parts(spark, sf_dir).where(F.col("a") & F.col("b")).select("partkey")


def q_only_in_one(spark, sf_dir):
    """Parts rated in the first segment and not the second (EXCEPT)."""
    return _segment_parts(spark, sf_dir).where(F.col("a") & ~F.col("b")).select("partkey")


def q_summary_stats(spark, sf_dir):
    """Mean, sd, median and quartiles of ratings per segment."""
    ev = _with_segment(spark, sf_dir, _events(spark, sf_dir))
    counts = cut_lineage(R.value_counts(ev.where(F.col("rating").isNotNull()), ["segment"], "rating"))
    s = R.summary(counts, ["segment"], "rating", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return s.select("segment", F.col("n_rows").alias("n_ratings"), F.round("mean", 6).alias("mean_rating"),
                    F.round("sd", 6).alias("sd_rating"), "q1", "median", "q3")


def q_region_rating(spark, sf_dir):
    """Mean rating by region and nation with subtotals (ROLLUP)."""
    ev = _events(spark, sf_dir)
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    nation = F.broadcast(read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"]))
    region = F.broadcast(read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"]))
    j = (ev.join(cust, ev.user == cust.c_custkey)
         .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    return (j.rollup(F.col("r_name").alias("region"), F.col("n_name").alias("nation"))
            .agg(F.count("*").alias("n_ratings"), F.round(F.avg("rating"), 6).alias("mean_rating")))


def q_distinct_raters(spark, sf_dir):
    """Exact number of distinct raters per item."""
    ev = _with_item(spark, sf_dir, _events(spark, sf_dir))
    return ev.groupBy("item").agg(F.count_distinct("user").alias("n_raters"))


def q_raters_rollup(spark, sf_dir):
    """Distinct raters per item and month, item, month and in all, from one sketch per item and month."""
    ev = _with_item(spark, sf_dir, _events(spark, sf_dir)).select("user", "item", F.date_format("rated_at", "yyyy-MM").alias("month"))
    cells = cut_lineage(D.sketches(ev, ["item", "month"], "user"))
    return D.roll_up(cells, [["item", "month"], ["item"], ["month"], []], ["item", "month"]).withColumnRenamed("n_distinct", "n_raters")


def q_json_attr(spark, sf_dir):
    """Mean event value per JSON attribute ``k`` of events.props."""
    ev = read_table(spark, sf_dir, "events", ["props", "value"])
    return (ev.select(F.get_json_object("props", "$.k").alias("k"), "value")
            .groupBy("k").agg(F.count("*").alias("n_events"),
                              F.round(F.avg("value"), 6).alias("mean_value")))


QUERIES = {
    "sql_load": q_load,
    "sql_star_join": q_star_join,
    "sql_most_rated": q_most_rated,
    "sql_top_rated": q_top_rated,
    "sql_top_by_group": q_top_by_group,
    "sql_rank_ties": q_rank_ties,
    "sql_rating_hist": q_rating_hist,
    "sql_trend": q_trend,
    "sql_trend_change": q_trend_change,
    "sql_moving_avg": q_moving_avg,
    "sql_genre_explode": q_genre_explode,
    "sql_active_users": q_active_users,
    "sql_above_user_mean": q_above_user_mean,
    "sql_never_rated": q_never_rated,
    "sql_rated_by_both": q_rated_by_both,
    "sql_only_in_one": q_only_in_one,
    "sql_summary_stats": q_summary_stats,
    "sql_region_rating": q_region_rating,
    "sql_distinct_raters": q_distinct_raters,
    "sql_raters_rollup": q_raters_rollup,
    "sql_json_attr": q_json_attr,
}

_EV = ("ev AS (SELECT o_custkey AS \"user\", l_partkey AS partkey, l_quantity AS rating, "
       "o_orderdate AS rated_at FROM lineitem JOIN orders ON l_orderkey = o_orderkey)")
_EVI = f"{_EV}, evi AS (SELECT ev.*, p_name AS item FROM ev JOIN part ON partkey = p_partkey)"
_EVS = f"{_EVI}, evs AS (SELECT evi.*, c_mktsegment AS segment FROM evi JOIN customer ON \"user\" = c_custkey)"
_SEGITEM = (f"{_EVS}, si AS (SELECT segment, item, count(*) AS n_ratings, round(avg(rating), 6) AS mean_rating "
            f"FROM evs GROUP BY 1, 2)")
_MONTHLY = (f"{_EV}, m AS (SELECT CAST(year(rated_at) AS INTEGER) AS yr, CAST(month(rated_at) AS INTEGER) AS mon, "
            f"count(*) AS n_ratings, avg(rating) AS mean_raw FROM ev GROUP BY 1, 2)")
_INMONTH = f"year(rated_at) = {MONTH[0]} AND month(rated_at) = {MONTH[1]}"


def _seg_parts(seg):
    return (f"SELECT partkey FROM ev JOIN customer ON \"user\" = c_custkey "
            f"WHERE {_INMONTH} AND c_mktsegment = '{seg}'")


ORACLE = {
    "sql_load": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES),
    "sql_star_join": f"""WITH {_EVS}
  SELECT "user", partkey, item, rating, rated_at, segment, n_name AS nation, r_name AS region
  FROM evs JOIN customer ON "user" = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey""",
    "sql_most_rated": f"""WITH {_EVI} SELECT item, count(*) AS n_ratings, round(avg(rating), 6) AS mean_rating
  FROM evi GROUP BY item ORDER BY n_ratings DESC, item LIMIT {TOP_K}""",
    "sql_top_rated": f"""WITH {_EV} SELECT partkey, count(*) AS n_ratings, round(avg(rating), 6) AS mean_rating
  FROM ev GROUP BY partkey HAVING count(*) >= {MIN_RATINGS} ORDER BY mean_rating DESC, partkey LIMIT {TOP_K}""",
    "sql_top_by_group": f"""WITH {_SEGITEM} SELECT * FROM (SELECT *, CAST(row_number() OVER
  (PARTITION BY segment ORDER BY mean_rating DESC, item) AS INTEGER) AS rnk FROM si) WHERE rnk <= 3""",
    "sql_rank_ties": f"""WITH {_SEGITEM} SELECT segment, item, n_ratings,
  CAST(rank() OVER (PARTITION BY segment ORDER BY n_ratings DESC) AS INTEGER) AS rnk,
  CAST(dense_rank() OVER (PARTITION BY segment ORDER BY n_ratings DESC) AS INTEGER) AS dense_rnk FROM si""",
    "sql_rating_hist": f"""WITH {_EVI}, cells AS (SELECT "user", item, avg(rating) AS rating FROM evi GROUP BY 1, 2),
  st AS (SELECT c_mktsegment AS segment, CAST(ceil(rating / 10) AS INTEGER) AS stars
         FROM cells JOIN customer ON "user" = c_custkey)
  SELECT segment, count(*) FILTER (WHERE stars = 1) AS stars_1, count(*) FILTER (WHERE stars = 2) AS stars_2,
         count(*) FILTER (WHERE stars = 3) AS stars_3, count(*) FILTER (WHERE stars = 4) AS stars_4,
         count(*) FILTER (WHERE stars = 5) AS stars_5,
         count(*) FILTER (WHERE stars IS NULL OR stars NOT BETWEEN 1 AND 5) AS stars_other FROM st GROUP BY segment""",
    "sql_trend": f"WITH {_MONTHLY} SELECT yr, mon, n_ratings, round(mean_raw, 6) AS mean_rating FROM m",
    "sql_trend_change": f"""WITH {_MONTHLY} SELECT yr, mon, n_ratings,
  n_ratings - lag(n_ratings) OVER (ORDER BY yr, mon) AS d_ratings,
  round(mean_raw - lag(mean_raw) OVER (ORDER BY yr, mon), 6) AS d_mean FROM m""",
    "sql_moving_avg": f"""WITH {_MONTHLY} SELECT yr, mon,
  round(avg(mean_raw) OVER (ORDER BY yr, mon ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS mean_3m FROM m""",
    "sql_genre_explode": f"""WITH {_EVI}, g AS (SELECT rating, unnest(string_split(item, ' ')) AS genre FROM evi)
  SELECT genre, count(*) AS n_ratings, round(avg(rating), 6) AS mean_rating FROM g GROUP BY genre""",
    "sql_active_users": f"""WITH {_EV} SELECT "user", count(*) AS n_ratings FROM ev GROUP BY 1
  ORDER BY n_ratings DESC, "user" LIMIT {TOP_K}""",
    "sql_above_user_mean": f"""WITH {_EV} SELECT "user", count(*) AS n_ratings,
  count(*) FILTER (WHERE rating > (SELECT avg(rating) FROM ev e2 WHERE e2."user" = ev."user")) AS n_above
  FROM ev GROUP BY "user" """,
    "sql_never_rated": f"""WITH {_EV} SELECT p_partkey FROM part
  WHERE NOT EXISTS (SELECT 1 FROM ev WHERE partkey = p_partkey AND {_INMONTH})""",
    "sql_rated_by_both": f"WITH {_EV} {_seg_parts(SEGMENTS[0])} INTERSECT {_seg_parts(SEGMENTS[1])}",
    "sql_only_in_one": f"WITH {_EV} {_seg_parts(SEGMENTS[0])} EXCEPT {_seg_parts(SEGMENTS[1])}",
    "sql_summary_stats": f"""WITH {_EVS} SELECT segment, count(*) AS n_ratings, round(avg(rating), 6) AS mean_rating,
  round(stddev_samp(rating), 6) AS sd_rating, quantile_cont(rating, 0.25) AS q1,
  quantile_cont(rating, 0.5) AS median, quantile_cont(rating, 0.75) AS q3 FROM evs GROUP BY segment""",
    "sql_region_rating": f"""WITH {_EV} SELECT r_name AS region, n_name AS nation, count(*) AS n_ratings,
  round(avg(rating), 6) AS mean_rating FROM ev JOIN customer ON "user" = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY ROLLUP (r_name, n_name)""",
    "sql_distinct_raters": f"WITH {_EVI} SELECT item, count(DISTINCT \"user\") AS n_raters FROM evi GROUP BY item",
    "sql_json_attr": """SELECT json_extract_string(props, '$.k') AS k, count(*) AS n_events,
  round(avg(value), 6) AS mean_value FROM events GROUP BY 1""",
}
