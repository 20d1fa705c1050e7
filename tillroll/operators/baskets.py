"""Market baskets and frequent item pairs.

A basket is one customer's purchases at one transaction timestamp. Baskets
are kept in long form (one row per basket and item, with its multiplicity)
instead of an array per basket, so no basket, however large, is collected
into a single row.

Pair support counts every co-occurrence, so an item bought twice in a basket
counts twice (pair weight = multiplicity_a x multiplicity_b); support divides
by all baskets, single-item ones included. ``distinct_items=True`` counts each
item once per basket.

Scale plan (heavy-light decomposition, every step exact):
1. (basket, item) multiplicities with map-side combine, shuffled by all three
   keys, so a hot basket is spread by item.
2. Apriori bounds before any pair is formed: pair_count(a, b) <= purchases of a *
   largest multiplicity of all, and <= sum over baskets of mult_a * largest
   multiplicity there. Items that cannot reach min_support go: by the first bound
   before any basket is looked at, by the second from the baskets that are left.
3. Each basket is split by multiplicity: its light maximum is the smallest
   multiplicity that at most sqrt(items) of its items exceed; those are heavy.
   Pairs with a heavy item are joined linearly: heavy items x items.
4. Light pairs can only be frequent by themselves if both items reach min_support
   under the *light* maximum; only those items are paired, so one item bought 200
   times does not make every item of its basket a candidate.
5. A pair that needs its heavy part to be frequent is looked up: the light rows of
   its rarer item meet the other item's by (basket, item).
6. Joins inside a basket are salted: its items are dealt into blocks of about
   ``BLOCK_ITEMS`` and pairs of blocks are joined, so a big basket is many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.exprs import money_sum, one_row
from ..plans.durable import durable

BASKET = ("customer_id", "transaction_date")
BLOCK_ITEMS = 512
PAIR = ("product_1", "product_2")


def basket_limits(items: DataFrame) -> DataFrame:
    """Per basket of at least two items: ``max_mult`` and ``light_max``, the
    smallest multiplicity of it that at most sqrt(items) items exceed. The window
    holds one row per distinct multiplicity (at most about sqrt(2 x purchases))."""
    at = items.groupBy(*BASKET, "item_count").agg(F.count(F.lit(1)).alias("_n"))
    basket = W.partitionBy(*BASKET)
    higher = basket.orderBy(F.desc("item_count")).rowsBetween(W.unboundedPreceding, -1)
    told = at.select(*BASKET, "item_count", F.coalesce(F.sum("_n").over(higher), F.lit(0)).alias("_above"),
                     F.sum("_n").over(basket).alias("_items"))
    return (told.groupBy(*BASKET).agg(
        F.max("_items").alias("_items"), F.max("item_count").alias("max_mult"),
        F.min(F.when(F.col("_above") <= F.floor(F.sqrt("_items")), F.col("item_count"))).alias("light_max"))
        .filter("_items >= 2").drop("_items"))


def _own_block(item: Column) -> Column:
    return F.pmod(F.xxhash64(item), F.col("blocks"))


def _block_pairs(left: DataFrame, right: DataFrame, once: Column) -> DataFrame:
    """Sums of mult_a * mult_b of pairs from ``left`` and ``right`` (basket, item,
    item_count, _i, _j), joined by basket and pair of blocks where ``once`` holds."""
    met = left.alias("a").join(right.alias("b"), [F.col(f"a.{c}") == F.col(f"b.{c}")
                                                  for c in (*BASKET, "_i", "_j")], "inner").filter(once)
    return met.groupBy(F.least("a.item", "b.item").alias("product_1"),
                       F.greatest("a.item", "b.item").alias("product_2")).agg(
        F.sum(F.col("a.item_count") * F.col("b.item_count")).alias("pair_count"))


def light_pairs(light: DataFrame) -> DataFrame:
    """All pairs of light rows of a basket; rows carry the basket's ``blocks``."""
    own = _own_block(F.col("item"))
    left = light.select("*", own.alias("_i"), F.explode(F.sequence(own, F.col("blocks") - 1)).alias("_j"))
    right = light.select("*", F.explode(F.sequence(F.lit(0).cast("long"), own)).alias("_i"), own.alias("_j"))
    return _block_pairs(left, right, (F.col("a._i") < F.col("a._j")) | (F.col("a.item") < F.col("b.item")))


def heavy_pairs(cand: DataFrame) -> DataFrame:
    """All pairs of a basket with at least one heavy item."""
    zero = F.lit(0).cast("long")
    heavy = cand.filter("heavy").select("*", F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("_i"),
                                        zero.alias("_j"))
    others = cand.select("*", _own_block(F.col("item")).alias("_i"), zero.alias("_j"))
    return _block_pairs(heavy, others, (F.col("a.item") != F.col("b.item")) & (
        ~F.col("b.heavy") | (F.col("a.item") < F.col("b.item"))))


def _light_bounds(light: DataFrame) -> DataFrame:
    return light.groupBy("item").agg(F.sum(F.col("item_count") * F.col("light_max")).alias("light_bound"))


def looked_up_pairs(wanted: DataFrame, light: DataFrame) -> DataFrame:
    """The light part of the pairs in ``wanted`` (product_1, product_2, and item: the
    rarer of the two)."""
    rows = light.select(*BASKET, "item", "item_count")
    other = F.when(F.col("item") == F.col("product_1"), F.col("product_2")).otherwise(F.col("product_1"))
    first = wanted.join(rows, "item").select(*PAIR, *BASKET, F.col("item_count").alias("_c1"),
                                             other.alias("item"))
    return (first.join(rows, [*BASKET, "item"]).groupBy(*PAIR)
            .agg(F.sum(F.col("_c1") * F.col("item_count")).alias("pair_count")))


def _bought_enough(grouped: DataFrame, keys: list[str], frequent) -> DataFrame:
    """The rows (basket, ``keys`` with the item, _rows) of the items that could be in a
    frequent pair if every basket held the other item as often as any basket can hold
    any item. Counted before items are brought together by basket."""
    bought = durable(grouped.groupBy(*keys).agg(F.sum("_rows").alias("_bought"), F.max("_rows").alias("_most"))
                     .groupBy("item").agg(F.sum("_bought").alias("_bought"), F.sum("_most").alias("_most")),
                     "basket_item_totals")
    most = F.lit(one_row(bought.agg(F.max("_most").cast("double")))[0]).cast("double")
    keep = durable(bought.filter(frequent(F.col("_bought").cast("double") * most)).select("item"),
                   "basket_items_kept")
    if keep.count() == bought.count():
        return grouped
    return durable(grouped.join(keep, "item", "left_semi"), "basket_rows_kept")


def _pair_counts(items: DataFrame, frequent, block_items: int) -> DataFrame:
    """Exact pair_count (sum of mult_a * mult_b over baskets, a < b) of every pair
    that can be ``frequent`` (a test of a count or of an upper bound)."""
    sized = items.join(basket_limits(items), list(BASKET), "inner")
    bound = sized.groupBy("item").agg(F.sum(F.col("item_count") * F.col("max_mult")).alias("_bound"))
    keep = bound.filter(frequent(F.col("_bound"))).select("item")
    kept = durable(sized.join(keep, "item", "left_semi").drop("max_mult"), "basket_candidates")
    # Baskets are counted again: few of a big basket's items may be left.
    blocks = kept.groupBy(*BASKET).agg(F.count(F.lit(1)).alias("_left")).filter("_left >= 2").select(
        *BASKET, F.ceil(F.col("_left") / block_items).alias("blocks"))
    cand = kept.join(blocks, list(BASKET), "inner").withColumn(
        "heavy", F.col("item_count") > F.col("light_max"))
    light = cand.filter("not heavy")
    heavy = durable(heavy_pairs(cand), "basket_heavy_pairs")
    bounds = durable(_light_bounds(light), "basket_light_bounds")
    alone = bounds.filter(frequent(F.col("light_bound"))).select("item")
    from_light = light_pairs(light.join(alone, "item", "left_semi"))
    # Pairs of which an item is not in ``alone``: their light part is below min_support.
    b1 = bounds.select(F.col("item").alias("product_1"), F.col("light_bound").alias("_b1"))
    b2 = bounds.select(F.col("item").alias("product_2"), F.col("light_bound").alias("_b2"))
    least = F.least("_b1", "_b2")
    wanted = (heavy.join(b1, "product_1").join(b2, "product_2")
              .filter(~frequent(least) & frequent(F.col("pair_count") + least))
              .select(*PAIR, F.when(F.col("_b1") <= F.col("_b2"), F.col("product_1"))
                      .otherwise(F.col("product_2")).alias("item")))
    return (from_light.unionByName(heavy).unionByName(looked_up_pairs(wanted, light))
            .groupBy(*PAIR).agg(F.sum("pair_count").alias("pair_count")))


def baskets(enriched: DataFrame) -> DataFrame:
    """customer_id, transaction_date -> basket_value, basket_size (item rows),
    distinct_items."""
    return enriched.groupBy(*BASKET).agg(
        money_sum("total_amount").alias("basket_value"),
        F.count("product_id").alias("basket_size"),
        F.count_distinct("product_id").alias("distinct_items"),
    )


def basket_items(enriched: DataFrame, item_col: str = "product_id") -> DataFrame:
    """Long-form basket contents: basket key, item, item_count (multiplicity)."""
    return (enriched.filter(F.col(item_col).isNotNull())
            .groupBy(*BASKET, F.col(item_col).alias("item"))
            .agg(F.count("*").alias("item_count")))


def basket_pairs(enriched: DataFrame, min_support: float = 0.01, item_col: str = "product_id",
                 distinct_items: bool = False, with_info: bool | None = None,
                 materialize: bool = True, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Item pairs (product_1 < product_2) with pair_count and support >= min_support.

    With ``item_col == "product_id"`` each side gets its category and brand
    (lookups into the distinct (product, category, brand) triples), as published.

    The enriched input is read once: every later step derives from one
    pre-aggregated (basket, item[, category, brand]) table, written once to the
    shared checkpoint folder by default (``materialize``). The candidates left by the
    Apriori bound, their heavy pairs and their light bounds (each used several
    times, each much smaller) are written too.
    """
    if with_info is None:
        with_info = item_col == "product_id"
    info_cols = ["category", "brand"] if with_info else []
    # (basket, item, attrs) -> multiplicity; null items kept so that every
    # basket is counted in the support denominator.
    grouped = enriched.groupBy(*BASKET, F.col(item_col).alias("item"), *info_cols).agg(
        F.count("*").alias("_rows"))
    if materialize:
        grouped = durable(grouped, "basket_items")
    # All baskets (single-item ones included), counted once over the written table.
    total_baskets = one_row(grouped.groupBy(*BASKET).agg(F.lit(1).alias("_one"))
                            .select(F.count("*")))[0]
    total = F.lit(total_baskets)

    def frequent(count: Column) -> Column:
        return count / total >= F.lit(min_support)

    grouped = _bought_enough(grouped.filter(F.col("item").isNotNull()), ["item", *info_cols], frequent)
    items = grouped.groupBy(*BASKET, "item").agg(F.sum("_rows").alias("item_count"))
    if distinct_items:
        items = items.withColumn("item_count", F.lit(1).cast("long"))
    pairs = _pair_counts(items, frequent, block_items)
    out = pairs.withColumn("support", F.col("pair_count") / total).filter(F.col("support") >= F.lit(min_support))
    if with_info:
        info = grouped.select("item", *info_cols).distinct()
        i1 = info.select(F.col("item").alias("product_1"),
                         F.col("category").alias("category_1"), F.col("brand").alias("brand_1"))
        i2 = info.select(F.col("item").alias("product_2"),
                         F.col("category").alias("category_2"), F.col("brand").alias("brand_2"))
        out = out.join(i1, "product_1", "inner").join(i2, "product_2", "inner")
    return out.orderBy(F.col("support").desc(), "product_1", "product_2")
