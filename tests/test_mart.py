from __future__ import annotations

import datetime as dt

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from martflow.operators.joins import Skew
from martflow.plans import measures
from martflow.plans.mart import (
    Thresholds,
    build_mart,
    customers_with_flag,
    frequent_customers,
    full_join_products,
)
from martflow.plans.star import FACT, build_star, date_dim, order_fact
from martflow.sources import lookups
from martflow.sources.workdir import at_hand, stage, store
from suite import queries, standins

SPREAD = Skew(min_bytes=0, min_hot_rows=20, salts=4)


@pytest.fixture(scope="module")
def star(spark, sf_dir):
    return queries.the_star(spark, sf_dir)


def test_default_calendar(spark):
    days = lookups.date_lookup(spark)
    first, last, n, ids = days.agg(
        F.min("date"), F.max("date"), F.count("*"), F.max("date_id")
    ).first()
    assert (first, last, n, ids) == (dt.date(2016, 1, 1), dt.date(2019, 12, 31), 1461, 1461)
    assert "SinglePartition" not in plan_of(days)


def test_date_dim_columns(spark):
    day = dt.date(2016, 1, 1)
    found = date_dim(lookups.date_lookup(spark, day, day)).first()
    assert tuple(found) == (day, 1, 2016, 1, 1, 53, 1, 6, "Friday")


def test_statuses(spark):
    found = lookups.status_lookup(spark)
    assert dict(found.dtypes) == {"status_id": "int", "status": "string"}
    assert [r[0] for r in found.collect()] == [1, 2, 3, 4]


def small_star(spark):
    day = "date '2020-01-0{}'"
    tables = {
        "customers": "SELECT 1 AS customer_id, 'North' AS customers_state, 's' AS source",
        "stores": "SELECT 1 AS store_id, 'Main' AS store_name",
        "staffs": "SELECT 1 AS staff_id, 1 AS store_id, 'Ann' AS staffs_first_name",
        "products": """SELECT * FROM VALUES (10, 'Road', 1, 1, 2018, 900.0D), (11, 'City', 1, 2, 2018, 500.0D),
            (12, 'Old', 9, 9, 2010, 100.0D) AS p(product_id, product_name, brand_id, category_id,
                                                  model_year, list_price)""",
        "brands": "SELECT 1 AS brand_id, 'Swift' AS brand_name, 's' AS source",
        "categories": """SELECT * FROM VALUES (1, 'Race'), (2, 'Town')
            AS c(category_id, category_name)""",
        "orders": f"""SELECT * FROM VALUES
            (100, 1, 4, {day.format(1)}, {day.format(3)}, {day.format(5)}, 1, 1),
            (101, 1, 1, {day.format(2)}, {day.format(4)}, NULL, 1, 1),
            (102, NULL, 2, {day.format(9)}, {day.format(9)}, {day.format(9)}, 7, 7)
            AS o(order_id, customer_id, order_status, order_date, required_date, shipped_date,
                 store_id, staff_id)""",
        "order_items": """SELECT * FROM VALUES
            (100, 1, 10, 2, 900.0D, 0.1D), (100, 2, 11, 1, 500.0D, 0.0D), (102, 1, 99, 1, 5.0D, 0.0D)
            AS i(order_id, item_id, product_id, quantity, list_price, discount)""",
    }
    stage1 = {name: spark.sql(sql) for name, sql in tables.items()}
    calendar = lookups.Calendar(dt.date(2020, 1, 1), dt.date(2020, 1, 7))
    return build_star(stage1, calendar, lookups.status_lookup(spark))


def test_mart_of_a_small_star(spark):
    mart = build_mart(small_star(spark), Thresholds(high_value=1000, frequent=2))
    found = {(r["order_id"], r["product_id"], r["quantity"]): r for r in mart.collect()}
    assert set(found) == {
        (100, 10, 2),
        (100, 11, 1),
        (101, None, None),
        (102, None, 1),
        (None, 12, None),
    }
    line = found[(100, 10, 2)]
    assert line["revenue_per_product"] == 1800.0
    assert line["price_after_discount"] == 810.0
    assert line["revenue_after_discount"] == 1620.0
    assert (line["delay_time"], line["days_to_ship"]) == (2, 4)
    assert (line["brand_name"], line["category_name"], line["status"]) == (
        "Swift",
        "Race",
        "Completed",
    )
    flags = ("fulfilled_order_flag", "high_value_order_flag", "frequent_customer_flag")
    assert [line[f] for f in flags] == [1, 1, 1]
    assert [found[(100, 11, 1)][f] for f in flags] == [1, 0, 1]
    assert [found[(101, None, None)][f] for f in flags] == [0, 0, 1]
    # Shipped, but on a day that the calendar lacks; no customer, store or product.
    stray = found[(102, None, 1)]
    assert [stray[f] for f in flags] == [0, 0, 0]
    assert (stray["store_name"], stray["ordered_date"]) == (None, None)
    unsold = found[(None, 12, None)]
    assert (unsold["product_name"], unsold["brand_name"]) == ("Old", None)
    assert [unsold[f] for f in flags] == [0, 0, 0]


def test_default_thresholds_are_strict(spark):
    assert Thresholds() == Thresholds(1000, 5, "lines")
    fact = spark.createDataFrame(
        [(1, n) for n in range(5)] + [(2, n) for n in range(6)] + [(3, 1)] * 7 + [(4, None)] * 9,
        "customer_id int, order_id int",
    )
    assert [r[0] for r in frequent_customers(fact).orderBy("customer_id").collect()] == [2, 3]
    assert [r[0] for r in frequent_customers(fact, by="orders").collect()] == [2]
    with pytest.raises(ValueError):
        frequent_customers(fact, by="days")


def test_mart_is_the_same_with_spread_joins(spark, star, no_broadcast):
    plain = build_mart(star, queries.THRESHOLDS)
    spread = build_mart(star, queries.THRESHOLDS, skew=SPREAD)
    assert sorted(plain.columns) == sorted(spread.columns)
    assert plain.count() == spread.count()
    columns = sorted(plain.columns)
    assert plain.select(columns).exceptAll(spread.select(columns)).isEmpty()


def test_fact_is_the_same_with_spread_joins(spark, sf_dir, no_broadcast):
    tables = queries.stage1(spark, sf_dir)
    built = [
        order_fact(tables["orders"], tables["order_items"], standins.CALENDAR, skew)
        for skew in (Skew(), SPREAD)
    ]
    assert rows(built[0]) == rows(built[1])


def test_full_join_is_left_plus_unsold(spark, sf_dir):
    lines = standins.stand_in(spark, sf_dir, "order_items").select("product_id", "quantity")
    products = standins.stand_in(spark, sf_dir, "products").select("product_id", "product_name")
    expected = lines.withColumnRenamed("product_id", "line_product").join(
        products, F.col("line_product") == F.col("product_id"), "full"
    )
    assert rows(full_join_products(lines, products)) == rows(expected.drop("line_product"))


def test_fact_is_not_shuffled_for_small_customers(spark, star):
    """Customers are measured by themselves; the fact behind their flag is above the limit."""
    stored = {name: store(df, name) for name, df in star.items()}
    buyers = stage(customers_with_flag(stored["customers_dim"], stored[FACT], Thresholds()))
    assert buyers.rows == stored["customers_dim"].count()
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, str(buyers.size))
    try:
        plan = plan_of(build_mart(stored, parts=("customers",)))
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
        spark.conf.set(name, "1000")
        plan = plan_of(build_mart(stored, parts=("customers",)))
        assert "Exchange hashpartitioning(customer_id" in plan
    finally:
        spark.conf.set(name, before)


def test_a_joined_fact_is_made_once_and_shuffled_before_it_is_wide(spark, star, no_broadcast):
    """The mart reads a stored fact, and its rows meet the products before they hold any other table's texts."""
    mart = build_mart(star, queries.THRESHOLDS, skew=SPREAD)
    plan = plan_of(mart)
    assert "lineitem" not in plan
    assert 0 < plan.index("hashpartitioning(customer_id") < plan.index("hashpartitioning(product_id")
    assert plan.index("hashpartitioning(staff_id") < plan.index("hashpartitioning(customer_id")
    # a stored fact is read where it lies, and so is one made from little
    stored = store(star[FACT], "fact")
    assert at_hand(stored, "fact", 0) is stored
    assert at_hand(star[FACT], "fact", 1 << 40) is star[FACT]
    assert rows(at_hand(star[FACT], "fact", 0)) == rows(stored)


def test_dates_need_no_join(spark, star):
    calendar = lookups.calendar_of(star["date_dim"])
    assert calendar == standins.CALENDAR
    computed = build_mart(star, parts=("dates",), calendar=calendar)
    assert plan_of(computed).count("Join") == plan_of(star[FACT]).count("Join")
    joined = build_mart(star, parts=("dates",))
    columns = sorted(computed.columns)
    assert sorted(joined.columns) == columns
    assert computed.select(columns).exceptAll(joined.select(columns)).isEmpty()


def test_calendar_ids(spark):
    calendar = lookups.Calendar(dt.date(2020, 1, 1), dt.date(2020, 12, 31))
    longer = lookups.Calendar(dt.date(2020, 1, 1), dt.date(2021, 12, 31))
    days = [dt.date(2019, 12, 31), dt.date(2020, 1, 1), dt.date(2020, 12, 31), dt.date(9999, 12, 31), None]
    df = spark.createDataFrame([(d,) for d in days], "day date")
    found = df.select(
        "day", calendar.date_id(F.col("day")).alias("id"), longer.date_id(F.col("day")).alias("later")
    )
    assert [r["id"] for r in found.collect()] == [None, 1, 366, None, None]
    assert [r["later"] for r in found.collect()] == [None, 1, 366, None, None]
    back = found.select(calendar.date(F.col("id")).alias("d")).collect()
    assert [r["d"] for r in back] == [None, *days[1:3], None, None]
    ids = spark.createDataFrame([(0,), (1,), (366,), (367,), (None,)], "id int")
    assert [r[0] for r in ids.select(calendar.date(F.col("id"))).collect()] == [None, days[1], days[2], None, None]
    assert calendar.table(spark).count() == calendar.days == 366
    assert lookups.calendar_of(calendar.table(spark)) == calendar
    for wrong in ("date_id <> 7", "date_id > 1", "date_id < 0"):
        with pytest.raises(ValueError):
            lookups.calendar_of(calendar.table(spark).filter(wrong))
    with pytest.raises(ValueError):
        lookups.calendar_of(calendar.table(spark).withColumn("date_id", F.lit(1)))
    with pytest.raises(ValueError):
        lookups.Calendar(days[2], days[1])


def test_measured_sizes(spark):
    df = spark.sql("SELECT 1 AS a, 'four' AS b UNION ALL SELECT 2, NULL")
    found = stage(df)
    assert (found.rows, found.size) == (2, 2 * 32 + 4)
    assert rows(found.table) == rows(df)
    assert stage(df.filter("a > 5")).size == 0
    nested = spark.sql("SELECT array(1, 2) AS `x.y`, map('k', 'v') AS m")
    assert stage(nested).size > 0


def test_mart_plan_has_no_cross_join_and_no_python(star):
    plan = plan_of(build_mart(star))
    for name in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython"):
        assert name not in plan


def test_parts_select_dimensions(star):
    mart = build_mart(star, parts=("dates",))
    assert "store_name" not in mart.columns
    assert {"ordered_date", "delay_time", "revenue_after_discount"} <= set(mart.columns)
    with pytest.raises(ValueError):
        build_mart(star, parts=("weather",))


def test_parts_do_not_change_a_measure(star):
    whole = build_mart(star, queries.THRESHOLDS)
    part = build_mart(star, queries.THRESHOLDS, ("dates",))
    assert rows(measures.revenue_by_quarter(whole)) == rows(measures.revenue_by_quarter(part))


PRODUCT_MEASURES = (
    measures.quantity_by_product,
    measures.revenue_by_product,
    measures.top_selling_product,
    measures.highest_quantity_product,
    measures.least_selling_product,
    measures.revenue_by_category,
)


def test_measures_summed_by_product_first_are_those_of_the_mart(spark, star):
    """One line's product is unknown, one product is unsold, and one is listed twice under two names."""
    small = small_star(spark)
    twice = small["products_dim"].filter("product_id = 10").withColumn("product_name", F.lit("Other"))
    small["products_dim"] = small["products_dim"].union(twice)
    for tables in (small, star):
        whole, alone = build_mart(tables), build_mart(tables, parts=())
        for measure in PRODUCT_MEASURES:
            assert rows(measure(alone, tables["products_dim"])) == rows(measure(whole))


def test_products_meet_a_row_per_product(spark, star):
    alone = build_mart(star, parts=())
    for measure in PRODUCT_MEASURES:
        plan = plan_of(measure(alone, star["products_dim"]))
        assert plan.count("lineitem.parquet") == 1  # lines are read and joined with their orders once


def test_measures_of_a_small_star(spark):
    mart = build_mart(small_star(spark))
    totals = measures.sales_totals(mart).first()
    assert (totals["revenue"], totals["quantity"], totals["orders"]) == (2125.0, 4, 3)
    assert measures.least_selling_product(mart).first()["product_id"] == 12
    assert measures.top_selling_product(mart).first()["product_id"] == 10
    assert measures.customers_total(mart).first()[0] == 1
    retention = measures.retention_rate(mart).first()
    assert tuple(retention) == (1, 1, 1.0)
    impact = {r["discount"]: r for r in measures.discount_impact(mart).collect()}
    assert impact[0.1]["given_away"] == 180.0


def test_net_never_exceeds_gross(star):
    mart = build_mart(star, queries.THRESHOLDS)
    for row in measures.discount_impact(mart).collect():
        assert row["net"] <= row["gross"]
        assert row["given_share"] == pytest.approx(row["discount"], abs=1e-9)


def test_fact_key_sets(star):
    assert set(star) == {
        "customers_dim",
        "date_dim",
        "products_dim",
        "staffs_dim",
        "stores_dim",
        "status_dim",
        FACT,
    }
