"""Retail source tables, derived from the test tables by SQL.

The texts run in Spark and in DuckDB alike. They only map columns: every row of
the test tables is used. The formulas put markers, blanks and malformed
values where cleansing needs them, and three quarters of the products remain
without sales, since an order line refers to the first of each four products.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from martflow.contract import Contract
from martflow.sources.lookups import Calendar, status_lookup

_AUDIT = (
    "'fixture' AS source, cast('2024-01-01' AS date) AS \"timestamp\", 1 AS extraction_id"
)

STAND_INS = {
    "customers": """
        SELECT c_custkey AS customer_id,
               'Customer' AS first_name,
               substr(c_name, 10) AS last_name,
               CASE WHEN c_custkey % 7 = 0 THEN 'NULL'
                    WHEN c_custkey % 11 = 0 THEN NULL
                    WHEN c_custkey % 13 = 0 THEN '12-34'
                    ELSE '(555) ' || lpad(cast((c_custkey * 7919) % 1000 AS string), 3, '0')
                         || '-' || lpad(cast((c_custkey * 104729) % 10000 AS string), 4, '0')
               END AS phone,
               CASE WHEN c_custkey % 17 = 0 THEN 'NA'
                    WHEN c_custkey % 19 = 0 THEN 'bad.address'
                    ELSE ' User' || cast(c_custkey AS string) || '@Mail.Example.com '
               END AS email,
               n_name AS city,
               r_name AS state,
               lpad(cast((c_custkey * 7919) % 100000 AS string), 5, '0') AS zip_code,
               {audit}
        FROM {customer} c
        JOIN {nation} n ON c_nationkey = n_nationkey
        JOIN {region} r ON n_regionkey = r_regionkey
    """,
    "orders": """
        SELECT order_id, customer_id, order_status, order_date,
               order_date + 7 * cast(substr(priority, 1, 1) AS int) AS required_date,
               CASE WHEN order_status = 1 THEN NULL
                    ELSE order_date + cast(order_id % 45 AS int) END AS shipped_date,
               cast(customer_id % 25 AS int) AS store_id,
               cast(order_id % 10 AS bigint) AS staff_id,
               {audit}
        FROM (SELECT o_orderkey AS order_id, o_custkey AS customer_id,
                     CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 ELSE 4 END AS order_status,
                     cast(o_orderdate AS date) AS order_date,
                     o_orderpriority AS priority
              FROM {orders}) o
    """,
    "order_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS item_id,
               l_partkey - l_partkey % 4 AS product_id,
               cast(l_quantity AS int) AS quantity,
               l_extendedprice AS list_price, l_discount AS discount,
               {audit}
        FROM {lineitem} l
    """,
    "products": """
        SELECT p_partkey AS product_id, p_name AS product_name,
               cast(substr(p_brand, 7) AS int) AS brand_id,
               CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
                           WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 ELSE 6 END AS category_id,
               1990 + p_size % 10 AS model_year,
               p_retailprice AS list_price,
               {audit}
        FROM {part} p
    """,
    "brands": """
        SELECT DISTINCT cast(substr(p_brand, 7) AS int) AS brand_id, p_brand AS brand_name, {audit}
        FROM {part} p
    """,
    "categories": """
        SELECT DISTINCT CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
                                    WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 ELSE 6 END AS category_id,
               p_type AS category_name, {audit}
        FROM {part} p
    """,
    "stores": """
        SELECT n_nationkey AS store_id, 'Store ' || n_name AS store_name,
               n_name AS city, r_name AS state,
               lpad(cast((n_nationkey * 7919) % 100000 AS string), 5, '0') AS zip_code,
               {audit}
        FROM {nation} n JOIN {region} r ON n_regionkey = r_regionkey
    """,
    "staffs": """
        SELECT s_suppkey AS staff_id, s_name AS first_name, s_nationkey AS store_id, {audit}
        FROM {supplier} s
    """,
    # Texts as a landing file may hold them, some of which cannot be cast.
    "raw_customers": """
        SELECT cast(c_custkey AS string) AS customer_id, c_name AS name,
               CASE WHEN c_custkey % 23 = 0 THEN 'x1' ELSE cast(c_acctbal AS string) END AS balance
        FROM {customer} c
    """,
    "raw_orders": """
        SELECT CASE WHEN o_orderkey % 23 = 0 THEN 'x1' ELSE cast(o_orderkey AS string) END AS order_id,
               CASE WHEN o_orderkey % 29 = 0 THEN NULL
                    WHEN o_orderkey % 31 = 0 THEN 'NA'
                    ELSE cast(cast(o_orderdate AS date) AS string) END AS order_date,
               cast(o_totalprice AS string) AS total
        FROM {orders} o
    """,
}

SOURCE_TABLES = (
    "customers",
    "categories",
    "staffs",
    "orders",
    "order_items",
    "brands",
    "products",
    "stores",
)

CONTRACT = Contract.of(
    [
        ("customers", "customers", "customer_id", "int", "N", "Y", "Y"),
        ("customers", "customers", "first_name", "string", "Y", "N", "N"),
        ("customers", "customers", "last_name", "string", "Y", "N", "N"),
        ("customers", "customers", "phone", "string", "Y", "N", "N"),
        ("customers", "customers", "email", "string", "Y", "N", "N"),
        ("customers", "customers", "city", "string", "Y", "N", "N"),
        ("customers", "customers", "state", "string", "Y", "N", "N"),
        ("customers", "customers", "zip_code", "string", "Y", "N", "N"),
        ("categories", "categories", "category_id", "int", "N", "Y", "Y"),
        ("categories", "categories", "category_name", "string", "N", "N", "N"),
        ("staffs", "staffs", "staff_id", "int", "N", "Y", "Y"),
        ("staffs", "staffs", "first_name", "string", "Y", "N", "N"),
        ("staffs", "staffs", "store_id", "int", "N", "N", "N"),
        ("orders", "orders", "order_id", "int", "N", "Y", "Y"),
        ("orders", "orders", "customer_id", "int", "N", "N", "N"),
        ("orders", "orders", "order_status", "int", "N", "N", "N"),
        ("orders", "orders", "order_date", "datetime", "N", "N", "N"),
        ("orders", "orders", "required_date", "datetime", "N", "N", "N"),
        ("orders", "orders", "shipped_date", "datetime", "Y", "N", "N"),
        ("orders", "orders", "store_id", "int", "N", "N", "N"),
        ("orders", "orders", "staff_id", "int", "N", "N", "N"),
        ("order_items", "order_items", "order_id", "int", "N", "N", "Y"),
        ("order_items", "order_items", "item_id", "int", "N", "N", "Y"),
        ("order_items", "order_items", "product_id", "int", "N", "N", "N"),
        ("order_items", "order_items", "quantity", "int", "N", "N", "N"),
        ("order_items", "order_items", "list_price", "float", "N", "N", "N"),
        ("order_items", "order_items", "discount", "float", "N", "N", "N"),
        ("brands", "brands", "brand_id", "int", "N", "Y", "Y"),
        ("brands", "brands", "brand_name", "string", "N", "N", "N"),
        ("products", "products", "product_id", "int", "N", "Y", "Y"),
        ("products", "products", "product_name", "string", "Y", "N", "N"),
        ("products", "products", "brand_id", "int", "N", "N", "N"),
        ("products", "products", "category_id", "int", "N", "N", "N"),
        ("products", "products", "model_year", "int", "N", "N", "N"),
        ("products", "products", "list_price", "float", "N", "N", "N"),
        ("stores", "stores", "store_id", "int", "N", "Y", "Y"),
        ("stores", "stores", "store_name", "string", "Y", "N", "N"),
        ("stores", "stores", "city", "string", "Y", "N", "N"),
        ("stores", "stores", "state", "string", "Y", "N", "N"),
        ("stores", "stores", "zip_code", "string", "Y", "N", "N"),
    ]
)

# Keys that hold NULLs and repeated values, for the key gate.
_LOOSE_KEYS = {
    "customers": ("city",),
    "staffs": ("store_id",),
    "orders": ("customer_id", "shipped_date"),
    "products": ("brand_id", "category_id"),
}
LOOSE_CONTRACT = Contract(
    tuple(
        replace(r, primary_key="Y" if r.table_columns in _LOOSE_KEYS[r.source_table] else "N")
        if r.source_table in _LOOSE_KEYS
        else r
        for r in CONTRACT.rules
    )
)

LOOSE_TABLES = tuple(_LOOSE_KEYS)

RAW_CONTRACT = Contract.of(
    [
        ("raw_customers", "raw_customers", "customer_id", "int", "N", "Y", "Y"),
        ("raw_customers", "raw_customers", "name", "string", "Y", "N", "N"),
        ("raw_customers", "raw_customers", "balance", "float", "Y", "N", "N"),
        ("raw_orders", "raw_orders", "order_id", "int", "N", "Y", "Y"),
        ("raw_orders", "raw_orders", "order_date", "datetime", "Y", "N", "N"),
        ("raw_orders", "raw_orders", "total", "float", "Y", "N", "N"),
    ]
)

# Columns of the test tables that the queries read.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}

# Some orders fall outside this calendar and get no date id.
FIRST_DAY, LAST_DAY = dt.date(1996, 1, 1), dt.date(2000, 12, 31)


def tables_of(sql: str) -> list[str]:
    names = (field for _, field, _, _ in Formatter().parse(sql) if field)
    return [n for n in dict.fromkeys(names) if n != "audit"]


def duckdb_text(name: str) -> str:
    sql = STAND_INS[name]
    return sql.format(audit=_AUDIT, **{t: t for t in tables_of(sql)})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def stand_in(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = STAND_INS[name].replace("{audit}", _AUDIT.replace('"', "`"))
    inputs = {t: table(spark, sf_dir, t) for t in tables_of(sql)}
    return spark.sql(sql, **inputs)


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: stand_in(spark, sf_dir, name) for name in SOURCE_TABLES}


CALENDAR = Calendar(FIRST_DAY, LAST_DAY)
# One that covers all orders, for whole runs.
WIDE_CALENDAR = Calendar(dt.date(1990, 1, 1), dt.date(2009, 12, 31))


def statuses(spark: SparkSession) -> DataFrame:
    return status_lookup(spark)


def postal_codes(spark: SparkSession) -> DataFrame:
    """Every seventh five-digit number, as a table of known postal codes."""
    return spark.range(0, 100_000, 7).selectExpr(
        "lpad(cast(id AS string), 5, '0') AS postal_code", "'US' AS country_code"
    )
