"""Steps of a publish whose work per row was too large: same results, cheaper plans."""

from collections import defaultdict

from pyspark.sql import functions as F

from conftest import ts
from tillroll.operators import baskets, customers
from tillroll.plans import versions

SALE = ("customer_id string, transaction_id string, product_id string, category string, total_amount double, "
        "profit_amount double, transaction_date timestamp, customer_segment string, country string, age_group string")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sales(spark):
    """Customers with repeated, null and differing values in every column."""
    nan, rows = float("nan"), []
    for i in range(200):
        rows.append((None if i % 11 == 0 else f"c{i % 7}", None if i % 13 == 0 else f"t{i}",
                     None if i % 5 == 0 else f"p{i % 17}", None if i % 3 == 0 else f"k{i % 4}",
                     nan if i % 19 == 0 else None if i % 23 == 0 else i / 7, -i / 3 if i % 29 else float("inf"),
                     ts(f"2023-0{1 + i % 9}-15 10:00:00"), None if i % 2 else "Trade", ["A", "B"][i % 2], None))
    rows.append(("none", None, None, None, None, None, ts("2023-03-03 10:00:00"), None, None, None))
    return spark.createDataFrame(rows, SALE).repartition(5), rows


def test_customer_totals_by_brute_force(spark):
    df, rows = sales(spark)
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    got = {r.customer_id: r for r in customers.customer_lifetime(df, materialize=False).collect()}
    assert set(got) == set(groups)
    for key, own in groups.items():
        amounts = [r[4] for r in own if r[4] is not None and abs(r[4]) < float("inf")]
        profits = [r[5] for r in own if r[5] is not None and abs(r[5]) < float("inf")]
        g = got[key]
        assert g.total_orders == sum(r[1] is not None for r in own)
        assert g.unique_products_purchased == len({r[2] for r in own} - {None})
        assert g.categories_explored == len({r[3] for r in own} - {None})
        assert (g.last_purchase_date, g.first_purchase_date) == (max(r[6] for r in own), min(r[6] for r in own))
        for name, at in (("customer_segment", 7), ("country", 8), ("age_group", 9)):
            assert g[name] == max((r[at] for r in own if r[at] is not None), default=None)
        assert (g.total_spent is None) == (not amounts) and (g.avg_order_value is None) == (not amounts)
        if amounts:
            assert abs(g.total_spent - sum(amounts)) < 1e-3
            assert abs(g.avg_order_value - sum(amounts) / len(amounts)) < 1e-3
        assert (g.total_profit_generated is None) == (not profits)
        if profits:
            assert abs(g.total_profit_generated - sum(profits)) < 1e-3


def test_customer_totals_make_one_row_of_a_sale(spark):
    """No Expand, which made three rows of every sale for the two distinct counts."""
    assert "Expand" not in plan(customers.customer_lifetime(sales(spark)[0], as_of="2024-01-01", materialize=False))


def test_items_bought_too_rarely_reach_no_basket_step(spark, monkeypatch):
    """100 baskets of one customer each hold the same two items, and two of their own."""
    rows = [(f"c{i}", ts("2023-05-05 05:05:05"), item, "k", "b") for i in range(100)
            for item in ("x", "y", f"u{i}", f"v{i}")]
    df = spark.createDataFrame(rows, "customer_id string, transaction_date timestamp, product_id string, "
                                     "category string, brand string")
    seen, limits = [], baskets.basket_limits
    monkeypatch.setattr(baskets, "basket_limits", lambda items: seen.append(
        {r.item for r in items.collect()}) or limits(items))
    assert [(r.product_1, r.product_2, r.pair_count, r.support) for r in
            baskets.basket_pairs(df, 0.5).collect()] == [("x", "y", 100, 1.0)]
    assert seen == [{"x", "y"}]
    assert baskets.basket_pairs(df, 0.005).count() == 1 + 100 * 5 and len(seen[1]) == 202
    assert baskets.basket_pairs(df, 1.5).count() == 0 and seen[2] == set()


def test_digest_sums_longs(spark):
    """The digest is the sum of the row hashes, without a decimal for every row."""
    df = spark.range(1000).select(F.xxhash64("id").alias("x"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("y"))
    hashes = [r[0] for r in df.select(versions.row_hash(df.columns)).collect()]
    assert min(hashes) < 0 < max(hashes)
    out = df.agg(versions.digest(df.columns).alias("d"))
    assert int(out.first().d) == sum(hashes)
    assert "partial_sum(cast(xxhash64" not in plan(out)
    assert int(df.limit(0).agg(versions.digest(df.columns)).first()[0]) == 0
    one = df.limit(1)
    assert int(one.agg(versions.digest(df.columns)).first()[0]) == one.select(versions.row_hash(df.columns)).first()[0]


def test_partition_digests_group_by_value(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, None)], "_rows long, part string")
    got = {r.part: (r.rows, int(r.digest)) for r in versions.partition_digests(df, df.columns, ["part"]).collect()}
    hashes = [r[0] for r in df.select(versions.row_hash(df.columns), "_rows").orderBy("_rows").collect()]
    assert got == {'{"part":"a"}': (2, hashes[0] + hashes[2]), "{}": (2, hashes[1] + hashes[3])}
    assert [tuple(r)[:2] for r in versions.partition_digests(df, df.columns, []).collect()] == [("{}", 4)]
    assert versions.partition_digests(df.limit(0), df.columns, []).count() == 0
