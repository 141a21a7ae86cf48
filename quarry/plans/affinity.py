"""Affinity plans over order baskets (basket = order, item = part brand/name)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from quarry.operators import affinity as A
from quarry.operators import item_bits as I
from quarry.session import cut_lineage
from quarry.sources.fixtures import order_baskets

# Parameters of the registered affinity queries.
ITEMSET_MIN_SUPPORT = 0.002   # share of baskets; keeps brand itemsets at size <= 3
RULE_MIN_CONFIDENCE = 0.16
TOP_K = 20


def _brands(spark, sf_dir):
    """Baskets with a known number of consumers: read and de-duplicated once."""
    return cut_lineage(order_baskets(spark, sf_dir, "p_brand"))


def _n_baskets(b):
    return b.select(F.count_distinct("basket")).first()[0]


def _min_count(b, share, n=None):
    n = _n_baskets(b) if n is None else n
    return max(1, math.ceil(share * n - 1e-9))


def q_baskets(spark, sf_dir):
    return order_baskets(spark, sf_dir, "p_brand")


def q_item_support(spark, sf_dir):
    return A.item_support(_brands(spark, sf_dir))


def q_pair_counts(spark, sf_dir):
    return A.pair_counts(cut_lineage(order_baskets(spark, sf_dir, "p_name")))


def q_pair_rules(spark, sf_dir):
    return A.pair_rules(_brands(spark, sf_dir))


def q_top_rules(spark, sf_dir):
    return A.top_rules(A.pair_rules(_brands(spark, sf_dir)), TOP_K, "confidence")


def q_itemsets_l3(spark, sf_dir):
    b = _brands(spark, sf_dir)
    return A.itemsets(b, _min_count(b, ITEMSET_MIN_SUPPORT), max_k=3).drop("items")


def q_itemsets_fp(spark, sf_dir):
    b = _brands(spark, sf_dir)
    n = _n_baskets(b)
    return A.itemsets_fp(b, _min_count(b, ITEMSET_MIN_SUPPORT, n), n).drop("items")


def _multi_rules(b):
    """Rules with antecedents of two items or more, from itemsets of any size."""
    n = _n_baskets(b)
    sets = cut_lineage(A.itemsets_fp(b, _min_count(b, ITEMSET_MIN_SUPPORT, n), n))
    return A.with_lift(A.multi_rules(sets), F.lit(n)).where(F.size("ante_items") > 1)


def q_multi_rules(spark, sf_dir):
    return _multi_rules(_brands(spark, sf_dir)).drop("n_ante", "n_cons", "ante_items")


def q_apply_multi(spark, sf_dir):
    """A9 with antecedents of two items or more."""
    b = _brands(spark, sf_dir)
    return A.apply_rules(b, _multi_rules(b))


def q_apply_rules(spark, sf_dir):
    b = _brands(spark, sf_dir)
    rules = A.pair_rules(b, min_confidence=RULE_MIN_CONFIDENCE)
    return A.apply_rules(b, rules)


def q_rule_holdout(spark, sf_dir):
    return A.rule_holdout(_brands(spark, sf_dir), folds=5)


def _bit_sets(spark, sf_dir):
    b = _brands(spark, sf_dir)
    return I.itemsets_bits(b, _min_count(b, ITEMSET_MIN_SUPPORT))


def q_itemsets_bits(spark, sf_dir):
    return _bit_sets(spark, sf_dir).select(F.array_join("items", A.ITEM_SEP).alias("itemset"), "k", "n")


def q_closed(spark, sf_dir):
    return I.closed(_bit_sets(spark, sf_dir)).select(F.array_join("items", A.ITEM_SEP).alias("itemset"), "k", "n", "maximal")


QUERIES = {
    "aff_baskets": q_baskets,
    "aff_item_support": q_item_support,
    "aff_pair_counts": q_pair_counts,
    "aff_pair_rules": q_pair_rules,
    "aff_top_rules": q_top_rules,
    "aff_itemsets_l3": q_itemsets_l3,
    "aff_itemsets_fp": q_itemsets_fp,
    "aff_itemsets_bits": q_itemsets_bits,
    "aff_closed": q_closed,
    "aff_multi_rules": q_multi_rules,
    "aff_apply_rules": q_apply_rules,
    "aff_apply_multi": q_apply_multi,
    "aff_rule_holdout": q_rule_holdout,
}

_B = ("b AS (SELECT DISTINCT l_orderkey AS basket, p_brand AS item "
      "FROM lineitem JOIN part ON l_partkey = p_partkey)")
_N = "nb AS (SELECT count(DISTINCT basket) AS n FROM b)"
_ITEMS = "it AS (SELECT item, count(*) AS n_item FROM b GROUP BY item)"
_PAIRS = ("pr AS (SELECT x.item AS antecedent, y.item AS consequent, count(*) AS n_ab "
          "FROM b x JOIN b y ON x.basket = y.basket AND x.item <> y.item GROUP BY 1, 2)")
_RULES = (f"rules AS (SELECT antecedent, consequent, n_ab, n_ab / nb.n AS support, "
          f"n_ab / a.n_item AS confidence, n_ab * nb.n / (a.n_item * c.n_item) AS lift "
          f"FROM pr JOIN it a ON pr.antecedent = a.item JOIN it c ON pr.consequent = c.item CROSS JOIN nb)")
FP_ORACLE_MAX_K = 6   # the FP twin enumerates itemsets up to this size


def _sets_sql(max_k: int) -> str:
    """sets(itemset, k, n): every itemset of size 1..max_k with n >= threshold."""
    aliases = [f"x{i}" for i in range(max_k)]
    levels = []
    for k in range(1, max_k + 1):
        al = aliases[:k]
        joins = " ".join(f"JOIN b {a} ON {a}.basket = x0.basket AND {al[i - 1]}.item < {a}.item"
                         for i, a in enumerate(al) if i > 0)
        label = " || '|' || ".join(f"{a}.item" for a in al)
        levels.append(f"SELECT {label} AS itemset, {k} AS k, count(*) AS n FROM b x0 {joins} "
                      f"GROUP BY {', '.join(a + '.item' for a in al)} "
                      f"HAVING count(*) >= {ITEMSET_MIN_SUPPORT} * (SELECT n FROM nb)")
    return "sets AS (" + " UNION ALL ".join(levels) + ")"


_SETS = _sets_sql(3)
# rules with two antecedent items or more, of sets up to FP_ORACLE_MAX_K items
_MULTI = f"""{_sets_sql(FP_ORACLE_MAX_K)},
  big AS (SELECT n, string_split(itemset, '|') AS it FROM sets WHERE k >= 3),
  each AS (SELECT n, it, unnest(it) AS consequent FROM big),
  r AS (SELECT n, consequent, array_to_string(list_filter(it, lambda x: x <> consequent), '|') AS antecedent,
        list_filter(it, lambda x: x <> consequent) AS ante FROM each),
  mr AS (SELECT r.antecedent, r.ante, r.consequent, r.n, r.n / a.n AS confidence,
         r.n * (SELECT n FROM nb) / (a.n * c.n) AS lift
         FROM r JOIN sets a ON a.itemset = r.antecedent JOIN sets c ON c.itemset = r.consequent)"""

ORACLE = {
    "aff_baskets": f"WITH {_B} SELECT basket, item FROM b",
    "aff_item_support": f"WITH {_B}, {_N} SELECT item, count(*) AS n_item, "
                        f"count(*) / (SELECT n FROM nb) AS support FROM b GROUP BY item",
    "aff_pair_counts": "WITH b AS (SELECT DISTINCT l_orderkey AS basket, p_name AS item "
                       "FROM lineitem JOIN part ON l_partkey = p_partkey) "
                       "SELECT x.item AS item_a, y.item AS item_b, count(*) AS n_ab "
                       "FROM b x JOIN b y ON x.basket = y.basket AND x.item < y.item GROUP BY 1, 2",
    "aff_pair_rules": f"WITH {_B}, {_N}, {_ITEMS}, {_PAIRS}, {_RULES} SELECT * FROM rules",
    "aff_top_rules": f"WITH {_B}, {_N}, {_ITEMS}, {_PAIRS}, {_RULES} SELECT * FROM rules "
                     f"ORDER BY confidence DESC, antecedent, consequent LIMIT {TOP_K}",
    "aff_itemsets_l3": f"WITH {_B}, {_N}, {_SETS} SELECT itemset, k, n FROM sets",
    "aff_itemsets_fp": f"WITH {_B}, {_N}, {_sets_sql(FP_ORACLE_MAX_K)} SELECT itemset, k, n FROM sets",
    "aff_itemsets_bits": f"WITH {_B}, {_N}, {_sets_sql(FP_ORACLE_MAX_K)} SELECT itemset, k, n FROM sets",
    "aff_closed": f"""WITH {_B}, {_N}, {_sets_sql(FP_ORACLE_MAX_K)},
  l AS (SELECT *, string_split(itemset, '|') AS items FROM sets)
  SELECT itemset, k, n, NOT EXISTS (SELECT 1 FROM l m WHERE m.k > l.k AND list_has_all(m.items, l.items)) AS maximal
  FROM l WHERE NOT EXISTS (SELECT 1 FROM l m WHERE m.k > l.k AND m.n = l.n AND list_has_all(m.items, l.items))""",
    "aff_multi_rules": f"""WITH {_B}, {_N}, {_MULTI}
  SELECT antecedent, consequent, n, confidence, lift FROM mr""",
    "aff_apply_multi": f"""WITH {_B}, {_N}, {_MULTI},
  held AS (SELECT basket, list(item) AS items FROM b GROUP BY basket),
  fired AS (SELECT h.basket, mr.consequent, max(mr.confidence) AS confidence
            FROM b JOIN mr ON b.item = mr.ante[1] JOIN held h ON h.basket = b.basket
            WHERE list_has_all(h.items, mr.ante) AND NOT list_contains(h.items, mr.consequent) GROUP BY 1, 2),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY basket ORDER BY confidence DESC, consequent) AS rn FROM fired)
  SELECT basket, consequent AS item, confidence FROM ranked WHERE rn = 1""",
    "aff_apply_rules": f"""WITH {_B}, {_N}, {_ITEMS}, {_PAIRS}, {_RULES},
  good AS (SELECT * FROM rules WHERE confidence >= {RULE_MIN_CONFIDENCE}),
  fired AS (SELECT b.basket, g.consequent, max(g.confidence) AS confidence
            FROM b JOIN good g ON b.item = g.antecedent
            WHERE NOT EXISTS (SELECT 1 FROM b h WHERE h.basket = b.basket AND h.item = g.consequent)
            GROUP BY 1, 2),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY basket ORDER BY confidence DESC, consequent) AS rn FROM fired)
  SELECT basket, consequent AS item, confidence FROM ranked WHERE rn = 1""",
    "aff_rule_holdout": f"""WITH {_B},
  tr AS (SELECT * FROM b WHERE basket % 5 <> 0), te AS (SELECT * FROM b WHERE basket % 5 = 0),
  tri AS (SELECT item, count(*) AS n_item FROM tr GROUP BY item),
  trp AS (SELECT x.item AS antecedent, y.item AS consequent, count(*) AS n_ab FROM tr x JOIN tr y
          ON x.basket = y.basket AND x.item <> y.item GROUP BY 1, 2),
  tei AS (SELECT item, count(*) AS n_item FROM te GROUP BY item),
  tep AS (SELECT x.item AS antecedent, y.item AS consequent, count(*) AS n_ab FROM te x JOIN te y
          ON x.basket = y.basket AND x.item <> y.item GROUP BY 1, 2)
  SELECT trp.antecedent, trp.consequent, trp.n_ab / tri.n_item AS train_confidence,
         coalesce(tep.n_ab, 0) AS test_n_ab,
         coalesce(tep.n_ab, 0) / tei.n_item AS test_confidence
  FROM trp JOIN tri ON trp.antecedent = tri.item
  LEFT JOIN tep ON tep.antecedent = trp.antecedent AND tep.consequent = trp.consequent
  LEFT JOIN tei ON tei.item = trp.antecedent""",
}
