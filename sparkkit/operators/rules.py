"""Association rules."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.durable import stored
from ..plans.ordered import largest_group

MAX_RULE_ITEMS = 20
MAX_BASKET_ITEMS = 1_000_000


def baskets(df: DataFrame, group: str, item: str) -> DataFrame:
    """(group, items): the distinct items of each group, sorted.

    An array has to fit into one row, so larger groups are refused; `market_basket` has no such
    limit, since it collects frequent items only.
    """
    pairs = df.select(group, item).dropna().distinct()
    if largest_group(pairs, [group]) > MAX_BASKET_ITEMS:
        raise ValueError(f"a group has more than {MAX_BASKET_ITEMS} distinct items")
    return pairs.groupBy(group).agg(F.sort_array(F.collect_list(item)).alias("items"))


def _threshold(n_groups: int, min_support: float) -> int:
    return max(math.ceil(min_support * n_groups - 1e-9), 1)


def _candidates(level: DataFrame, k: int) -> DataFrame:
    """(node, allowed): items that may extend a frequent set of k items, since every set of k of them is frequent."""
    left, right = level.select("parent", "node", "ids", "item"), level.select("parent", F.col("item").alias("next"))
    joined = left.join(right, "parent").filter(F.col("item") < F.col("next"))
    # without the last item or the one before it the set is one of the two that were joined
    grown = joined.select("node", "next", F.concat("ids", F.array("next")).alias("ids"), F.explode(F.sequence(F.lit(0), F.lit(k - 2))).alias("out"))
    smaller = grown.select("node", "next", F.filter("ids", lambda x, i: i != F.col("out")).alias("ids"))
    whole = smaller.join(level.select("ids"), "ids").groupBy("node", "next").count().filter(F.col("count") == k - 1)
    return whole.groupBy("node").agg(F.collect_list("next").alias("allowed"))


def _mine(baskets_: DataFrame, single: DataFrame, least: int, max_length: int) -> list[DataFrame]:
    """(items, freq) of the frequent sets of 2, 3 .. `max_length` items.

    `baskets_` holds (rest, m): sorted item numbers and how many groups have just these; `single` (item, i, freq) names the numbers.
    A frequent set is a node below the set without its last item.  Every row is a node that a basket holds and the basket's later items, so
    a level reads the rows of the level before and no set above `max_length` is looked at.
    """
    level = single.select(F.lit(-1).cast("long").alias("parent"), F.col("item").alias("node"), F.array("item").alias("ids"), "item", F.array("i").alias("items"))
    names = single.select("item", F.col("i").alias("name"))
    held = baskets_.select(F.lit(-1).cast("long").alias("node"), "rest", "m")
    found = []

    def split(rows):
        return rows.select("node", "m", "rest", F.posexplode("rest").alias("at", "item"))

    def below(rows):
        return rows.select(F.col("child").alias("node"), F.slice("rest", F.col("at") + 2, F.size("rest")).alias("rest"), "m").filter(F.size("rest") > 0)

    held = below(split(held).withColumn("child", F.col("item")))
    for k in range(2, max_length + 1):
        grown = split(held)
        counts = grown.groupBy("node", "item").agg(F.sum("m").alias("freq")).filter(F.col("freq") >= least)
        above = level.select("node", "ids", "items")
        named = counts.join(above, "node").join(names, "item").select(
            F.col("node").alias("parent"), F.monotonically_increasing_id().alias("node"), F.concat("ids", F.array("item")).alias("ids"), "item",
            F.array_sort(F.concat("items", F.array("name"))).alias("items"), "freq")
        # the numbers of the nodes are fixed by the stored table
        level = stored(named)
        if level.isEmpty():
            break
        found.append(level.select("items", "freq"))
        if k == max_length:
            break
        longer = stored(_candidates(level, k))
        if longer.isEmpty():
            break
        children = level.select(F.col("parent").alias("node"), "item", F.col("node").alias("child"))
        held = below(grown.join(children, ["node", "item"])).join(longer, "node")
        held = stored(held.select("node", F.array_intersect("rest", "allowed").alias("rest"), "m").filter(F.size("rest") > 0))
    return found


def frequent_itemsets(df: DataFrame, group: str, item: str, min_support: float = 0.5, max_length: int = 8) -> DataFrame:
    """(items, freq, support), items sorted.

    Items below the support threshold go before any basket is collected: the number of remaining
    items, and so the size of a basket, is then bounded by rows / (min_support * groups).  Sets grow
    by an item per level up to `max_length`; equal baskets are counted once.
    """
    if not 0 < min_support <= 1:
        raise ValueError("min_support must lie in (0, 1]")
    if max_length < 1:
        raise ValueError("max_length must be 1 or more")
    pairs = df.select(F.col(group).alias("g"), F.col(item).cast("string").alias("i")).dropna().distinct().persist()
    n_groups = pairs.select("g").distinct().count()
    least = _threshold(n_groups, min_support)
    single = pairs.groupBy("i").agg(F.count(F.lit(1)).alias("freq")).filter(F.col("freq") >= least)
    # rare items first: their sets are pruned soonest; at most rows / (min_support * groups) items are left to number
    rarest = Window.partitionBy(F.lit(0)).orderBy("freq", "i")
    single = stored(single.withColumn("item", F.row_number().over(rarest).cast("long")))
    found = single.select(F.array("i").alias("items"), "freq")
    if max_length > 1 and n_groups:
        kept = pairs.join(single.select("i", "item"), "i").groupBy("g").agg(F.sort_array(F.collect_list("item")).alias("rest"))
        rows = stored(kept.filter(F.size("rest") > 1).groupBy("rest").agg(F.count(F.lit(1)).alias("m")))
        for level in _mine(rows, single, least, max_length):
            found = found.unionByName(level)
    pairs.unpersist()
    return found.withColumn("support", F.col("freq") / F.lit(float(max(n_groups, 1))))


def rules(itemsets: DataFrame, min_confidence: float = 0.5, max_length: int = 8) -> DataFrame:
    """(lhs, rhs, support, confidence, lift): every split of every itemset into two non-empty sides."""
    if max_length > MAX_RULE_ITEMS:
        raise ValueError(f"rules have at most {MAX_RULE_ITEMS} items")
    sized = itemsets.filter((F.size("items") > 1) & (F.size("items") <= max_length))
    masks = F.sequence(F.lit(1), F.call_function("shiftleft", F.lit(1), F.size("items")) - 2)
    split = sized.select("items", "freq", "support", F.explode(masks).alias("mask"))

    def side(bit):
        return F.filter(F.col("items"), lambda x, i: F.call_function("shiftright", F.col("mask"), i).bitwiseAND(F.lit(1)) == bit)

    sides = split.select(side(1).alias("lhs"), side(0).alias("rhs"), "freq", "support")
    left = itemsets.select(F.col("items").alias("lhs"), F.col("freq").alias("lhs_freq"))
    confident = sides.join(left, "lhs").withColumn("confidence", F.col("freq") / F.col("lhs_freq"))
    confident = confident.filter(F.col("confidence") >= min_confidence - 1e-12)
    right = itemsets.select(F.col("items").alias("rhs"), F.col("support").alias("rhs_support"))
    return confident.join(right, "rhs").select(
        "lhs", "rhs", "support", "confidence", (F.col("confidence") / F.col("rhs_support")).alias("lift"))


def _text(items: str) -> Column:
    return F.array_join(items, ", ")


def format_rules(found: DataFrame) -> DataFrame:
    """(rule, rule_lhs, rule_rhs, support, confidence, lift), strongest lift first."""
    named = found.select(
        F.concat(_text("lhs"), F.lit(" -> "), _text("rhs")).alias("rule"),
        _text("lhs").alias("rule_lhs"), _text("rhs").alias("rule_rhs"), "support", "confidence", "lift")
    return named.orderBy(F.desc("lift"), "rule")


def market_basket(df: DataFrame, group: str, item: str, min_support: float = 0.5, min_confidence: float = 0.5,
                  max_length: int = 8) -> DataFrame:
    """Association rules between items that occur in the same group (no rules: an empty table)."""
    itemsets = frequent_itemsets(df, group, item, min_support, max_length).persist()
    return format_rules(rules(itemsets, min_confidence, max_length))
