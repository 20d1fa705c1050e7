"""Heavy-light basket pairs: brute force, what is enumerated, no size switch."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tillroll.operators import baskets


def frame(spark, rows):
    """(customer, day, item) purchases."""
    df = spark.createDataFrame(rows, "customer_id string, b int, product_id long")
    return df.select("customer_id", F.timestamp_seconds(F.col("b") * 86400).alias("transaction_date"),
                     "product_id", F.lit("c").alias("category"), F.lit("x").alias("brand"),
                     F.lit(1.0).alias("total_amount"))


def brute(rows, min_support):
    bought = defaultdict(Counter)
    for c, b, p in rows:
        bought[c, b][p] += 1
    counts = Counter()
    for items in bought.values():
        names = sorted(items)
        for i, a in enumerate(names):
            for other in names[i + 1:]:
                counts[a, other] += items[a] * items[other]
    return {k: v for k, v in counts.items() if v / len(bought) >= min_support}


def found(df, min_support, **parameters):
    return {(r.product_1, r.product_2): r.pair_count
            for r in baskets.basket_pairs(df, min_support, **parameters).collect()}


@pytest.mark.parametrize("seed", range(3))
def test_multiplicities_of_all_sizes(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for b in range(120):
        for _ in range(rnd.choice([1, 2, 4, 9, 30])):
            item = rnd.choice([rnd.randint(0, 6), rnd.randint(0, 40)])
            rows += [(f"c{b % 11}", b, item)] * rnd.choice([1, 1, 1, 2, 3, 25])
    df = frame(spark, rows).cache()
    for min_support in (0.0, 0.05, 0.5, 3.0):
        assert found(df, min_support, block_items=rnd.choice([3, 512])) == brute(rows, min_support)


def big_basket(items=3000, times=200, others=400):
    """A basket of ``items`` items, one of them bought ``times`` times, beside small
    baskets that hold few of them."""
    rows = [("big", 0, i) for i in range(items)] + [("big", 0, 0)] * (times - 1)
    for b in range(1, others):
        rows += [("small", b, 1), ("small", b, 2), ("small", b, b % items)]
    return rows


def test_one_much_bought_item_does_not_pair_its_basket(spark):
    rows = big_basket()
    df = frame(spark, rows)
    support = 0.25                       # 100 of 400 baskets
    assert found(df, support) == brute(rows, support)
    items = baskets.basket_items(df)
    sized = items.join(baskets.basket_limits(items), list(baskets.BASKET)).withColumn(
        "blocks", F.lit(6).cast("long")).withColumn("heavy", F.col("item_count") > F.col("light_max"))
    light = sized.filter("not heavy")
    bounds = baskets._light_bounds(light).filter("light_bound >= 100").select("item")
    assert bounds.count() == 2           # of 3000 items
    assert sized.filter("heavy and customer_id = 'big'").count() == 1
    assert baskets.light_pairs(light.join(bounds, "item", "left_semi")).count() == 1
    assert baskets.heavy_pairs(sized).filter("pair_count >= 100").count() == 2999


def test_pairs_that_need_both_parts(spark):
    """A pair that is frequent only by its heavy part in one basket and its light
    part in others, where neither item's light part is enough."""
    rows = [("h", 0, 1)] * 60 + [("h", 0, i) for i in range(2, 12)]
    rows += [r for b in range(1, 51) for r in (("l", b, 1), ("l", b, 2), ("l", b, 50 + b))]
    df = frame(spark, rows)
    support = 100 / 51
    want = brute(rows, support)
    assert want == {(1, 2): 110}
    assert found(df, support) == want


def test_light_pairs_once_over_blocks(spark):
    rows = [("c", b, i) for b in range(2) for i in range(200)]
    items = baskets.basket_items(frame(spark, rows)).withColumn("blocks", F.lit(7).cast("long"))
    pairs = baskets.light_pairs(items)
    assert pairs.count() == 200 * 199 // 2
    assert pairs.filter("pair_count <> 2 or product_1 >= product_2").count() == 0
