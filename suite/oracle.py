"""SQL texts that give the results of the queries, for an independent engine.

They state each operator in its plain form (full outer join, IN subquery,
numbering over everything), not in the form the library uses.
"""

from __future__ import annotations

from suite.standins import (
    CONTRACT,
    FIRST_DAY,
    LAST_DAY,
    LOOSE_CONTRACT,
    SOURCE_TABLES,
    duckdb_text,
)

_SHARED = ("first_name", "last_name", "phone", "email", "city", "state", "zip_code")
_HAS = {
    "customers": _SHARED,
    "stores": ("city", "state", "zip_code"),
    "staffs": ("first_name",),
}
_AUDIT = "source, \"timestamp\", extraction_id"

EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def base(*names: str) -> list[str]:
    return [f"{n} AS ({duckdb_text(n)})" for n in names]


def prefixed(table: str, source: str | None = None) -> str:
    renames = ", ".join(f"{c} AS {table}_{c}" for c in _HAS[table])
    plain = ", ".join(_HAS[table])
    return f"(SELECT * EXCLUDE ({plain}, {_AUDIT}), {renames} FROM {source or table})"


# Stand-ins named like a test table need another name in a text that reads both.
def src(*names: str) -> list[str]:
    return [f"src_{n} AS ({duckdb_text(n)})" for n in names]


CALENDAR = f"""calendar AS (
  SELECT cast(d AS date) AS "date", cast(row_number() OVER (ORDER BY d) AS int) AS date_id
  FROM generate_series(timestamp '{FIRST_DAY}', timestamp '{LAST_DAY}', interval 1 day) t(d))"""

SPAN_CALENDAR = """span AS (
  SELECT min(least(order_date, required_date, coalesce(shipped_date, order_date))) AS lo,
         max(greatest(order_date, required_date, coalesce(shipped_date, order_date))) AS hi
  FROM {orders}),
calendar AS (
  SELECT cast(d AS date) AS "date", cast(row_number() OVER (ORDER BY d) AS int) AS date_id
  FROM (SELECT unnest(generate_series(cast(lo AS timestamp), cast(hi AS timestamp), interval 1 day)) AS d
        FROM span))"""

STATUS = """statuses AS (
  SELECT * FROM (VALUES (1, 'Pending'), (2, 'Processing'), (3, 'Rejected'), (4, 'Completed'))
  v(status_id, status))"""


def fact(orders: str = "src_orders", items: str = "src_order_items") -> str:
    return f"""fact AS (
  SELECT o.order_id, o.customer_id, o.order_status, o.store_id, o.staff_id,
         i.product_id, i.quantity, i.list_price, i.discount,
         d1.date_id AS order_date_id, d2.date_id AS required_date_id, d3.date_id AS shipped_date_id
  FROM {orders} o
  LEFT JOIN {items} i ON o.order_id = i.order_id
  LEFT JOIN calendar d1 ON o.order_date = d1."date"
  LEFT JOIN calendar d2 ON o.required_date = d2."date"
  LEFT JOIN calendar d3 ON o.shipped_date = d3."date")"""


def products_dim(products="src_products", brands="src_brands", categories="src_categories") -> str:
    return f"""products_dim AS (
  SELECT p.product_id, p.product_name, p.model_year, p.list_price, b.brand_name, c.category_name
  FROM {products} p
  LEFT JOIN {brands} b ON p.brand_id = b.brand_id
  LEFT JOIN {categories} c ON p.category_id = c.category_id)"""


def mart(stores="src_stores", staffs="src_staffs", customers="src_customers") -> str:
    """The mart in stages: who buys often, dates by role, products or the lack of sales, attributes, amounts."""
    return f"""buyers AS (
  SELECT customer_id, CASE WHEN count(order_id) > 40 THEN 1 ELSE 0 END AS often
  FROM fact WHERE customer_id IS NOT NULL GROUP BY ALL),
timed AS (
  SELECT fact.* EXCLUDE (order_date_id, required_date_id, shipped_date_id),
         max(c."date") FILTER (c.date_id = order_date_id) AS ordered_date,
         max(c."date") FILTER (c.date_id = required_date_id) AS required_date,
         max(c."date") FILTER (c.date_id = shipped_date_id) AS shipped_date
  FROM (SELECT *, row_number() OVER () AS line FROM fact) fact
  LEFT JOIN calendar c ON c.date_id IN (order_date_id, required_date_id, shipped_date_id)
  GROUP BY ALL),
stocked AS (
  SELECT timed.* EXCLUDE (line, product_id, list_price), timed.list_price AS order_list_price,
         p.* EXCLUDE (list_price), p.list_price AS product_list_price
  FROM timed LEFT JOIN products_dim p USING (product_id)
  UNION ALL BY NAME
  SELECT p.* EXCLUDE (list_price), p.list_price AS product_list_price
  FROM products_dim p ANTI JOIN fact USING (product_id)),
known AS (
  SELECT stocked.*, statuses.status, coalesce(buyers.often, 0) AS frequent_customer_flag,
         c.* EXCLUDE (customer_id), w.* EXCLUDE (staff_id, store_id), s.* EXCLUDE (store_id)
  FROM stocked
  LEFT JOIN statuses ON statuses.status_id = stocked.order_status
  LEFT JOIN buyers ON buyers.customer_id = stocked.customer_id
  LEFT JOIN {prefixed("customers", customers)} c ON c.customer_id = stocked.customer_id
  LEFT JOIN {prefixed("staffs", staffs)} w ON w.staff_id = stocked.staff_id
  LEFT JOIN {prefixed("stores", stores)} s ON s.store_id = stocked.store_id),
mart AS (
  SELECT * EXCLUDE (store_id, staff_id), order_list_price * quantity AS revenue_per_product,
         order_list_price * (1 - discount) AS price_after_discount,
         (order_list_price * (1 - discount)) * quantity AS revenue_after_discount,
         cast(shipped_date - required_date AS int) AS delay_time,
         cast(shipped_date - ordered_date AS int) AS days_to_ship,
         (shipped_date IS NOT NULL)::int AS fulfilled_order_flag,
         coalesce(order_list_price * quantity > 1000000, false)::int AS high_value_order_flag
  FROM known)"""


MART_COLUMNS = (
    "order_id customer_id order_status quantity discount order_list_price product_id product_name "
    "model_year brand_name category_name product_list_price store_name stores_city stores_state "
    "stores_zip_code staffs_first_name customers_first_name customers_last_name customers_phone "
    "customers_email customers_city customers_state customers_zip_code status ordered_date "
    "required_date shipped_date revenue_per_product delay_time price_after_discount "
    "revenue_after_discount days_to_ship fulfilled_order_flag high_value_order_flag "
    "frequent_customer_flag"
).split()

FACT = ctes(*src("orders", "order_items"), CALENDAR, fact())
STAR = ctes(*src(*SOURCE_TABLES), CALENDAR, STATUS, fact(), products_dim())
MART = ctes(*src(*SOURCE_TABLES), CALENDAR, STATUS, fact(), products_dim(), mart())


def money(expression: str) -> str:
    return f"cast(sum(cast({expression} AS decimal(18,4))) AS double)"


NET = money("revenue_after_discount")
GROSS = money("revenue_per_product")

ORACLE: dict[str, str] = {}


def counts(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows FROM {source}"
        for name, source in tables.items()
    )


def dim(name: str) -> str:
    if name in _HAS:
        return ctes(*src(name)) + f"SELECT * FROM {prefixed(name, f'src_{name}')}"
    return ctes(*src(name)) + f"SELECT * EXCLUDE ({_AUDIT}) FROM src_{name}"


# --- sources, sinks, catalog ---------------------------------------------------

ORACLE["contract_columns"] = ctes(*src(*SOURCE_TABLES)) + " UNION ALL ".join(
    f"SELECT '{r.source_table}' AS table_name, '{r.table_columns}' AS column_name, "
    f"'{r.datatype}' AS datatype, '{r.nullable}' AS nullable, '{r.unique}' AS is_unique, "
    f"'{r.primary_key}' AS primary_key, count({r.table_columns}) AS present, "
    f"cast(0 AS bigint) AS failed FROM src_{r.source_table}"
    for r in CONTRACT.rules
)
ORACLE["ingest_landing_counts"] = ctes(*src(*SOURCE_TABLES)) + counts(
    {n: f"src_{n}" for n in SOURCE_TABLES}
)
ORACLE["lookup_date"] = (
    ctes(*src("orders"), SPAN_CALENDAR.format(orders="src_orders")) + "SELECT * FROM calendar"
)
ORACLE["lookup_status"] = ctes(*src("orders"), STATUS) + """
SELECT status_id, status, count(order_id) AS orders
FROM statuses LEFT JOIN src_orders ON status_id = order_status GROUP BY ALL"""
ORACLE["sink_overwrite_idempotent"] = dim("customers")
ORACLE["catalog_register_list"] = STAR + counts(
    {
        "customers_dim": "src_customers",
        "date_dim": "calendar",
        "order_fact": "fact",
        "products_dim": "products_dim",
        "staffs_dim": "src_staffs",
        "status_dim": "statuses",
        "stores_dim": "src_stores",
    }
)
ORACLE["catalog_scan_dim"] = STAR + "SELECT * FROM products_dim"
ORACLE["publish_mart"] = MART + "SELECT * FROM mart"
ORACLE["publish_schema_merge"] = ctes(*src("customers")) + f"""
SELECT customer_id, first_name AS customers_first_name, last_name AS customers_last_name,
       cast(NULL AS varchar) AS customers_phone, email AS customers_email,
       city AS customers_city, state AS customers_state, zip_code AS customers_zip_code
FROM src_customers"""

# --- casting and projection -----------------------------------------------------

ORACLE["cast_contract"] = ctes(*src("raw_orders")) + """
SELECT try_cast(order_id AS int) AS order_id, try_cast(order_date AS date) AS order_date,
       try_cast(total AS double) AS total FROM src_raw_orders"""
ORACLE["cast_failures"] = ctes(*src("raw_customers", "raw_orders")) + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{shown}' AS target, "
    f"count({c}) AS present, "
    f"count(*) FILTER (WHERE {c} IS NOT NULL AND try_cast({c} AS {shown}) IS NULL) AS failed "
    f"FROM src_{t}"
    for t, c, shown in (
        ("raw_customers", "customer_id", "int"),
        ("raw_customers", "name", "string"),
        ("raw_customers", "balance", "double"),
        ("raw_orders", "order_id", "int"),
        ("raw_orders", "order_date", "date"),
        ("raw_orders", "total", "double"),
    )
)
ORACLE["recast_after_cleanse"] = ctes(*src("raw_customers")) + """
SELECT cast(customer_id AS int) AS customer_id, name, try_cast(balance AS double) AS balance
FROM src_raw_customers"""
ORACLE["rename_prefixed"] = ctes(*src("customers")) + (
    f"SELECT customer_id, {', '.join(f'{c} AS customers_{c}' for c in _SHARED)}, {_AUDIT} "
    "FROM src_customers"
)
ORACLE["drop_audit_columns"] = (
    ctes(*src("stores")) + "SELECT store_id, store_name, city, state, zip_code FROM src_stores"
)
ORACLE["mart_columns"] = MART + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM mart" for c in MART_COLUMNS
)

# --- missing values --------------------------------------------------------------

_MARKERS = "('unknown', 'NA', 'NAN', 'NULL')"


def unmarked(name: str, source: str, columns: tuple[str, ...]) -> str:
    cleared = ", ".join(
        f"CASE WHEN {c} IN {_MARKERS} THEN NULL ELSE {c} END AS {c}" for c in columns
    )
    return f"{name} AS (SELECT * REPLACE ({cleared}) FROM {source})"


_UNMARKED = ctes(*src("customers"), unmarked("u", "src_customers", _SHARED))
_FILL = "coalesce({0}, 'unknown') AS {0}"

ORACLE["nulls_flag_to_null"] = _UNMARKED + "SELECT * FROM u"
ORACLE["nulls_fill"] = _UNMARKED + (
    f"SELECT * REPLACE ({_FILL.format('phone')}, {_FILL.format('email')}) FROM u"
)
ORACLE["nulls_drop_required"] = (
    _UNMARKED + "SELECT * FROM u WHERE phone IS NOT NULL AND email IS NOT NULL"
)
ORACLE["cleanse_nulls_customers"] = _UNMARKED + (
    f"SELECT * REPLACE ({', '.join(_FILL.format(c) for c in _SHARED)}) FROM u "
    "WHERE customer_id IS NOT NULL"
)

# --- duplicates ------------------------------------------------------------------

_PART = "p_partkey p_name p_brand p_type p_size p_retailprice".split()


def first_of(source: str, key: str, order: str) -> str:
    return (
        f"(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} "
        f"ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1)"
    )


def order_by(columns: list[str], *keys: str) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in columns if c not in keys)


_ITEM_ORDER = order_by(["product_id", "quantity", "list_price", "discount"])
_BY_NAME = first_of("part", "p_name", order_by(_PART, "p_name"))

ORACLE["dedupe_single_key"] = f"SELECT * FROM {_BY_NAME}"
ORACLE["dedupe_chain"] = (
    f"SELECT * FROM {first_of(_BY_NAME, 'p_size', order_by(_PART, 'p_size'))}"
)
ORACLE["dedupe_composite_key"] = ctes(*src("order_items")) + (
    f"SELECT * FROM {first_of('src_order_items', 'order_id, item_id', _ITEM_ORDER)}"
)
ORACLE["dup_groups"] = (
    "SELECT p_name, count(*) AS rows FROM part GROUP BY p_name HAVING count(*) > 1"
)

# --- outliers --------------------------------------------------------------------

_IQR = """WITH q AS (SELECT quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3 FROM events),
b AS (SELECT q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM q)
"""
_Z = """WITH b AS (SELECT avg(value) - 3 * stddev_samp(value) AS low,
                          avg(value) + 3 * stddev_samp(value) AS high FROM events)
"""
_CAPPED = "CASE WHEN value < low THEN low WHEN value > high THEN high ELSE value END"

ORACLE["outlier_iqr_bounds"] = _IQR + """
SELECT low, high, count(*) FILTER (WHERE value < low) AS below,
       count(*) FILTER (WHERE value > high) AS above FROM events, b GROUP BY low, high"""
ORACLE["outlier_iqr_remove"] = _IQR + (
    "SELECT event_id, event_type, value FROM events, b WHERE value >= low AND value <= high"
)
ORACLE["outlier_iqr_cap"] = _IQR + f"SELECT event_id, event_type, {_CAPPED} AS value FROM events, b"
ORACLE["outlier_z_bounds"] = (
    "SELECT count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd "
    "FROM events"
)
ORACLE["outlier_z_remove"] = _Z + (
    "SELECT event_id, event_type, value FROM events, b WHERE value > low AND value < high"
)
ORACLE["outlier_z_cap"] = _Z + (
    f"SELECT event_id, event_type, round({_CAPPED}, 6) AS value FROM events, b"
)


def z_chain(source: str, columns: tuple[str, ...], threshold: float) -> list[str]:
    parts = []
    for c in columns:
        fences = (
            f"(SELECT avg({c}) - {threshold} * stddev_samp({c}) AS low, "
            f"avg({c}) + {threshold} * stddev_samp({c}) AS high FROM {source})"
        )
        parts.append(
            f"kept_{c} AS (SELECT s.* FROM {source} s, {fences} b WHERE {c} > low AND {c} < high)"
        )
        source = f"kept_{c}"
    return parts


_LINE_COLUMNS = ("list_price", "quantity", "discount")

ORACLE["outlier_z_chain"] = ctes(
    *src("order_items"), *z_chain("src_order_items", _LINE_COLUMNS, 1.5)
) + f"SELECT * EXCLUDE ({_AUDIT}) FROM kept_discount"

# --- contact columns ---------------------------------------------------------------


def clean(column: str, strip: str) -> str:
    return f"lower(regexp_replace({column}, '{strip}', '', 'g'))"


_EMAIL = clean("email", "[^\\w@.%+-]")
_PHONE = clean("phone", "[^0-9]")
_ZIP = clean("zip_code", "[^0-9-]")
_RULES = {
    "email": (_EMAIL, EMAIL),
    "phone": (_PHONE, r"^\d{3}[-.]?\d{3}[-.]?\d{4}$"),
    "zip_code": (_ZIP, r"^\d{5}(-\d{4})?$"),
}


def valid(column: str) -> str:
    value, pattern = _RULES[column]
    return f"coalesce(regexp_matches({value}, '{pattern}'), false)"


def kept(column: str) -> str:
    return ctes(*src("customers")) + (
        f"SELECT customer_id, {_RULES[column][0]} AS {column} FROM src_customers "
        f"WHERE {valid(column)}"
    )


ORACLE["normalize_strip"] = (
    "SELECT doc_id, trim(lower(regexp_replace(text, '[^\\w\\s]', '', 'g'))) AS text FROM documents"
)
ORACLE["normalize_email"] = kept("email")
ORACLE["normalize_phone"] = kept("phone")
ORACLE["normalize_zip"] = kept("zip_code")
ORACLE["normalize_contract"] = ctes(*src("customers")) + (
    "SELECT * REPLACE (" + ", ".join(f"{_RULES[c][0]} AS {c}" for c in _RULES) + "), "
    + ", ".join(f"{valid(c)} AS {c}_valid" for c in _RULES)
    + " FROM src_customers"
)
ORACLE["normalize_reject_counts"] = ctes(*src("customers", "stores")) + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{kind}' AS kind, count(*) AS rows, "
    f"count(*) FILTER (WHERE {valid(c)}) AS valid, "
    f"count(*) FILTER (WHERE NOT {valid(c)} AND {c} IS NOT NULL) AS rejected, "
    f"count(*) - count({c}) AS missing FROM src_{t}"
    for t, c, kind in (
        ("customers", "phone", "phone"),
        ("customers", "email", "email"),
        ("customers", "zip_code", "zip"),
        ("stores", "zip_code", "zip"),
    )
)

# --- quality -------------------------------------------------------------------------

_POSTAL = """postal AS (SELECT lpad(cast(range AS varchar), 5, '0') AS postal_code
            FROM range(0, 100000, 7))"""

ORACLE["pk_nulls"] = ctes(*src("customers")) + (
    "SELECT count(*) AS rows, count(*) FILTER (WHERE customer_id IS NULL OR phone IS NULL) "
    "AS null_rows FROM src_customers"
)
ORACLE["pk_duplicates"] = ctes(*src("order_items")) + (
    "SELECT order_id, count(*) AS rows FROM src_order_items GROUP BY order_id HAVING count(*) > 1"
)
ORACLE["pk_composite_duplicates"] = ctes(*src("order_items")) + (
    "SELECT order_id, item_id, count(*) AS rows FROM src_order_items "
    "GROUP BY order_id, item_id HAVING count(*) > 1"
)
ORACLE["pk_bad_type"] = ctes(*src("raw_orders")) + (
    "SELECT count(*) AS rows, count(*) - count(try_cast(order_id AS int)) AS bad_rows "
    "FROM src_raw_orders"
)


def key_checks() -> str:
    texts = []
    for name in CONTRACT.tables:
        keys = [r.table_columns for r in CONTRACT.primary_key(name)]
        for check in ("null", "type"):
            texts += [
                f"SELECT '{name}' AS table_name, '{k}' AS column_name, '{check}' AS check_name, "
                f"count(*) - count({k}) AS bad_rows FROM src_{name}"
                for k in keys
            ]
        texts.append(
            f"SELECT '{name}', '{','.join(keys)}', 'duplicate', "
            f"cast(coalesce(sum(n - 1), 0) AS bigint) FROM (SELECT count(*) AS n FROM src_{name} "
            f"GROUP BY {', '.join(keys)})"
        )
    return " UNION ALL ".join(texts)


ORACLE["pk_report"] = ctes(*src(*SOURCE_TABLES)) + key_checks()
ORACLE["zip_valid"] = ctes(*src("customers"), _POSTAL) + (
    "SELECT * FROM src_customers WHERE zip_code IN (SELECT postal_code FROM postal)"
)
ORACLE["zip_rejects"] = ctes(*src("customers"), _POSTAL) + (
    "SELECT * FROM src_customers WHERE zip_code NOT IN (SELECT postal_code FROM postal)"
)
ORACLE["fact_store_check"] = ctes(*src("orders", "order_items", "stores"), CALENDAR, fact()) + (
    "SELECT f.*, s.store_name FROM fact f JOIN src_stores s ON f.store_id = s.store_id"
)
_ORPHANS = " UNION ALL ".join(
    f"SELECT '{k}' AS column_name, '{d}' AS dim_name, count(DISTINCT {k}) AS orphan_keys, "
    f"count(*) AS orphan_rows FROM fact WHERE {k} IS NOT NULL "
    f"AND {k} NOT IN (SELECT {'status_id' if d == 'statuses' else k} FROM {source})"
    for k, d, source in (
        (
            "customer_id",
            "customers",
            "src_customers WHERE zip_code IN (SELECT postal_code FROM postal)",
        ),
        ("product_id", "products", "src_products"),
        ("store_id", "stores", "src_stores"),
        ("staff_id", "staffs", "src_staffs"),
        ("order_status", "statuses", "statuses"),
    )
)
ORACLE["fk_orphans"] = (
    ctes(
        *src("orders", "order_items", "customers", "products", "stores", "staffs"),
        _POSTAL,
        CALENDAR,
        STATUS,
        fact(),
    )
    + _ORPHANS
)
ORACLE["udf_batch_predicate"] = (
    "SELECT doc_id, text FROM documents WHERE "
    "regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}')"
)

# --- recipes ---------------------------------------------------------------------------

# The key columns hold neither duplicates nor NULLs, hence no step for them here.
_CONTACT_STAGE = (
    "normed AS (SELECT * REPLACE ("
    + ", ".join(f"CASE WHEN {valid(c)} THEN {_RULES[c][0]} END AS {c}" for c in _RULES)
    + ") FROM src_customers)"
)
CLEAN_CUSTOMERS = [
    _CONTACT_STAGE,
    unmarked("unmarked", "normed", _SHARED),
    "clean_customers AS (SELECT * REPLACE ("
    + ", ".join(_FILL.format(c) for c in _SHARED)
    + ") FROM unmarked)",
]
CLEAN_ITEMS = [
    "keyed_items AS (SELECT * FROM "
    + first_of("src_order_items", "order_id, item_id", _ITEM_ORDER)
    + ")",
    *z_chain("keyed_items", _LINE_COLUMNS, 1.5),
]
CLEAN_STORES = [
    _POSTAL,
    "clean_stores AS (SELECT * FROM src_stores "
    "WHERE zip_code IN (SELECT postal_code FROM postal))",
]
_ITEM_INTS = ", ".join(
    f"cast({c} AS bigint) AS {c}" for c in ("order_id", "item_id", "product_id", "quantity")
)

ORACLE["cleanse_customers"] = (
    ctes(*src("customers"), *CLEAN_CUSTOMERS) + "SELECT * FROM clean_customers"
)
ORACLE["cleanse_order_items"] = ctes(*src("order_items"), *CLEAN_ITEMS) + (
    f"SELECT * REPLACE ({_ITEM_INTS}) FROM kept_discount"
)
ORACLE["cleanse_stores"] = ctes(*src("stores"), *CLEAN_STORES) + (
    "SELECT * REPLACE (cast(store_id AS bigint) AS store_id) FROM clean_stores"
)
_STEPS = {
    "order_items": (
        ("input", "src_order_items"),
        ("normalize", "src_order_items"),
        ("nulls", "src_order_items"),
        ("unique columns", "src_order_items"),
        ("unique key", "keyed_items"),
        ("outliers", "kept_discount"),
        ("recast", "kept_discount"),
    ),
    "stores": (
        ("input", "src_stores"),
        ("normalize", "src_stores"),
        ("unique columns", "src_stores"),
        ("nulls", "src_stores"),
        ("postal code", "clean_stores"),
        ("recast", "clean_stores"),
    ),
}
_PLAIN_STEPS = {
    "customers": ("normalize", "unique columns", "nulls", "recast"),
    "categories": ("normalize", "unique columns", "nulls", "recast"),
    "staffs": ("normalize", "nulls", "unique columns", "recast"),
    "orders": ("normalize", "nulls", "unique columns", "recast"),
    "brands": ("normalize", "unique columns", "nulls", "recast"),
    "products": ("normalize", "unique columns", "nulls", "recast"),
}
_STEPS |= {t: tuple((s, f"src_{t}") for s in ("input", *steps)) for t, steps in _PLAIN_STEPS.items()}
ORACLE["cleanse_audit"] = ctes(
    *src(*SOURCE_TABLES), *CLEAN_ITEMS, *CLEAN_STORES
) + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {i} AS step_no, '{s}' AS step, count(*) AS rows FROM {source}"
    for t, steps in _STEPS.items()
    for i, (s, source) in enumerate(steps)
)


def recast(table: str) -> str:
    """A table that cleansing leaves as it is, but for its types."""
    ints = [r.table_columns for r in CONTRACT.table(table) if r.datatype == "int"]
    casts = ", ".join(f"cast({c} AS bigint) AS {c}" for c in ints)
    return ctes(*src(table)) + f"SELECT * REPLACE ({casts}) FROM src_{table}"


for _table in ("categories", "staffs", "orders", "brands", "products"):
    ORACLE[f"cleanse_{_table}"] = recast(_table)

# --- the key gate ------------------------------------------------------------------------

ORACLE["key_gate_raw"] = ctes(*src("raw_orders")) + """
SELECT *, CASE WHEN order_id IS NULL THEN 'null' WHEN try_cast(order_id AS int) IS NULL THEN 'type'
               WHEN row_number() OVER (PARTITION BY order_id ORDER BY order_date NULLS FIRST, total NULLS FIRST) > 1
               THEN 'duplicate' END AS reject_reason
FROM src_raw_orders"""

_LOOSE = {
    "customers": "clean_customers",
    "staffs": "src_staffs",
    "orders": "src_orders",
    "products": "src_products",
}


def loose_keys(table: str) -> list[str]:
    return [r.table_columns for r in LOOSE_CONTRACT.primary_key(table)]


def gated(table: str) -> str:
    """Rows at the gate with the reason for which they are turned away; equal keys are told apart by
    any order, which does not matter for counts."""
    keys = loose_keys(table)
    missing = " OR ".join(f"{k} IS NULL" for k in keys)
    return (
        f"SELECT CASE WHEN {missing} THEN 'null' WHEN row_number() OVER (PARTITION BY {', '.join(keys)}) > 1 "
        f"THEN 'duplicate' END AS reason FROM {_LOOSE[table]}"
    )


ORACLE["run_key_gate"] = ctes(*src(*_LOOSE), *CLEAN_CUSTOMERS) + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS reached, count(*) FILTER (WHERE reason IS NULL) AS passed, "
    "count(*) FILTER (WHERE reason = 'null') AS rejected_null, cast(0 AS bigint) AS rejected_type, "
    f"count(*) FILTER (WHERE reason = 'duplicate') AS rejected_duplicate FROM ({gated(t)})"
    for t in _LOOSE
)
_ORDER_INTS = ", ".join(
    f"cast({c} AS bigint) AS {c}"
    for c in ("order_id", "customer_id", "order_status", "store_id", "staff_id")
)
ORACLE["run_rejects"] = ctes(*src("orders")) + f"""
SELECT * FROM (
  SELECT * REPLACE ({_ORDER_INTS}),
         CASE WHEN shipped_date IS NULL THEN 'null'
              WHEN row_number() OVER (PARTITION BY customer_id, shipped_date
                                      ORDER BY order_id, order_status, order_date, required_date,
                                               store_id, staff_id) > 1 THEN 'duplicate'
         END AS reject_reason
  FROM src_orders)
WHERE reject_reason IS NOT NULL"""


def loose_checks() -> str:
    texts = []
    for name, source in _LOOSE.items():
        keys = loose_keys(name)
        shown = [f"{name}_{k}" if k in _HAS.get(name, ()) else k for k in keys]
        texts += [
            f"SELECT '{name}' AS table_name, '{s}' AS column_name, '{check}' AS check_name, "
            f"count(*) - count({k}) AS bad_rows FROM {source}"
            for check in ("null", "type")
            for k, s in zip(keys, shown)
        ]
        texts.append(
            f"SELECT '{name}', '{','.join(shown)}', 'duplicate', "
            f"cast(coalesce(sum(n - 1), 0) AS bigint) FROM (SELECT count(*) AS n FROM {source} "
            f"GROUP BY {', '.join(keys)})"
        )
    return " UNION ALL ".join(texts)


ORACLE["run_key_report"] = ctes(*src(*_LOOSE), *CLEAN_CUSTOMERS) + loose_checks()

# --- profiling -------------------------------------------------------------------------

_CUSTOMER_TYPES = (
    ("customer_id", "bigint"),
    ("first_name", "string"),
    ("last_name", "string"),
    ("phone", "string"),
    ("email", "string"),
    ("city", "string"),
    ("state", "string"),
    ("zip_code", "string"),
    ("source", "string"),
    ("timestamp", "date"),
    ("extraction_id", "int"),
)
ORACLE["profile_schema"] = ctes(*src("customers")) + " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, "
    f'count("{c}") AS present FROM src_customers'
    for i, (c, t) in enumerate(_CUSTOMER_TYPES)
)
_ORDER_COLUMNS = (
    "order_id customer_id order_status order_date required_date shipped_date store_id staff_id"
).split()


def described(column: str, source: str) -> str:
    if column.endswith("_date"):
        values = (
            f"cast(NULL AS double) AS mean, cast(NULL AS double) AS sd, "
            f"cast(NULL AS double) AS min_number, cast(NULL AS double) AS max_number, "
            f"cast(min({column}) AS varchar) AS min_text, cast(max({column}) AS varchar) AS max_text"
        )
    else:
        values = (
            f"round(avg({column}), 6) AS mean, round(stddev_samp({column}), 6) AS sd, "
            f"cast(min({column}) AS double) AS min_number, "
            f"cast(max({column}) AS double) AS max_number, "
            f"cast(NULL AS varchar) AS min_text, cast(NULL AS varchar) AS max_text"
        )
    return (
        f"SELECT '{column}' AS column_name, count({column}) AS present, "
        f"count(*) - count({column}) AS nulls, {values} FROM {source}"
    )


ORACLE["profile_describe"] = ctes(*src("orders")) + " UNION ALL ".join(
    described(c, "src_orders") for c in _ORDER_COLUMNS
)
ORACLE["profile_nulls"] = ctes(*src("orders")) + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count(\"{c}\") AS nulls FROM src_orders"
    for c in (*_ORDER_COLUMNS, "source", "timestamp", "extraction_id")
)
ORACLE["profile_duplicates"] = """
SELECT count(*) AS duplicate_groups, cast(coalesce(sum(n - 1), 0) AS bigint) AS surplus_rows
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber, l_returnflag
      HAVING count(*) > 1)"""
ORACLE["profile_duplicates_hashed"] = " UNION ALL ".join(
    f"SELECT '{name}' AS columns, count(*) AS duplicate_groups, "
    "cast(coalesce(sum(n - 1), 0) AS bigint) AS surplus_rows "
    f"FROM (SELECT count(*) AS n FROM lineitem GROUP BY {columns} HAVING count(*) > 1)"
    for name, columns in (("some", "l_orderkey, l_returnflag, l_linestatus"), ("all", "ALL"))
).replace(
    "SELECT count(*) AS n FROM lineitem GROUP BY ALL", "SELECT count(*) AS n, * FROM lineitem GROUP BY ALL"
)
ORACLE["profile_distribution"] = (
    "SELECT p_name AS value, count(*) AS rows FROM part GROUP BY p_name "
    "ORDER BY p_name NULLS FIRST LIMIT 10"
)
ORACLE["profile_topk"] = (
    "SELECT p_name AS value, count(*) AS rows FROM part GROUP BY p_name "
    "ORDER BY rows DESC, p_name NULLS FIRST LIMIT 10"
)
ORACLE["profile_text_distributions"] = ctes(*src("customers")) + " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{c}' AS column_name, cast(row_number() OVER "
    f"(ORDER BY {c} NULLS FIRST) AS int) AS place, {c} AS value, count(*) AS rows "
    f"FROM src_customers GROUP BY {c}) WHERE place <= 10"
    for c in (*_SHARED, "source")
)


def histogram(column: str, axis: str, source: str) -> str:
    return f"""SELECT '{column}' AS column_name, bin, low, high, count(x) AS rows
FROM (SELECT cast(range AS int) AS bin FROM range(30)),
     (SELECT cast(min({axis}) AS double) AS low, cast(max({axis}) AS double) AS high FROM {source})
LEFT JOIN (SELECT cast({axis} AS double) AS x FROM {source})
  ON bin = least(29, coalesce(cast(floor((x - low) / nullif(high - low, 0) * 30) AS int), 0))
GROUP BY bin, low, high"""


ORACLE["profile_histogram"] = " UNION ALL ".join(
    f"SELECT * FROM ({histogram(c, axis, 'events')})"
    for c, axis in (
        ("value", "value"),
        ("ts", "datediff('day', date '1970-01-01', cast(ts AS date))"),
        ("user_id", "user_id"),
    )
)
_NUMBERS = {
    "customers": ("customer_id", "extraction_id"),
    "categories": ("category_id", "extraction_id"),
    "staffs": ("staff_id", "store_id", "extraction_id"),
    "orders": (
        "order_id",
        "customer_id",
        "order_status",
        "store_id",
        "staff_id",
        "extraction_id",
    ),
    "order_items": (
        "order_id",
        "item_id",
        "product_id",
        "quantity",
        "list_price",
        "discount",
        "extraction_id",
    ),
    "brands": ("brand_id", "extraction_id"),
    "products": (
        "product_id",
        "brand_id",
        "category_id",
        "model_year",
        "list_price",
        "extraction_id",
    ),
    "stores": ("store_id", "extraction_id"),
}


def profiled(table: str) -> list[str]:
    columns = [r.table_columns for r in CONTRACT.table(table)]
    columns += ["source", "timestamp", "extraction_id"]
    texts = []

    def finding(column, name, value="NULL", label="NULL", place="0", rest=""):
        return (
            f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{name}' AS finding, "
            f"cast({place} AS int) AS place, cast({label} AS varchar) AS label, "
            f"round(cast({value} AS double), {7 if name == 'mean' else 6}) AS value FROM {rest or 'src_' + table}"
        )

    for c in columns:
        texts.append(finding(c, "present", f'count("{c}")'))
        texts.append(finding(c, "nulls", f'count(*) - count("{c}")'))
        if c in _NUMBERS[table]:
            for name, value in (("mean", "avg"), ("sd", "stddev_samp"), ("min", "min"), ("max", "max")):
                texts.append(finding(c, name, f'{value}("{c}")'))
        else:
            texts += [finding(c, name, label=f'{name}("{c}")') for name in ("min", "max")]
        day = c == "timestamp" or c.endswith("_date")
        if c in _NUMBERS[table] or day:
            axis = f"""datediff('day', date '1970-01-01', "{c}")""" if day else c
            bins = f"({histogram(c, axis, 'src_' + table)}) WHERE low IS NOT NULL"
            texts.append(finding(c, "bin", "rows", place="bin", rest=bins))
        else:
            first = (
                f'(SELECT row_number() OVER (ORDER BY "{c}" NULLS FIRST) AS place, "{c}" AS value, '
                f'count(*) AS rows FROM src_{table} GROUP BY "{c}") WHERE place <= 10'
            )
            texts.append(finding(c, "first_value", "rows", "value", "place", first))
    groups = (
        f"(SELECT count(*) AS n FROM src_{table} GROUP BY {', '.join(chr(34) + c + chr(34) for c in columns)} "
        "HAVING count(*) > 1)"
    )
    texts.append(finding("*", "duplicate_groups", "count(*)", rest=groups))
    texts.append(finding("*", "surplus_rows", "coalesce(sum(n - 1), 0)", rest=groups))
    return texts


ORACLE["profile_all"] = ctes(*src(*SOURCE_TABLES)) + " UNION ALL ".join(
    text for t in SOURCE_TABLES for text in profiled(t)
)
ORACLE["profile_distinct"] = ctes(*src("customers")) + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT \"{c}\") AS distinct_values FROM src_customers"
    for c, _ in _CUSTOMER_TYPES
)

# --- star --------------------------------------------------------------------------------

ORACLE["dim_customers"] = dim("customers")
ORACLE["dim_staffs"] = dim("staffs")
ORACLE["dim_stores"] = dim("stores")
ORACLE["dim_status"] = STAR + """
SELECT status_id, status, count(order_id) AS rows
FROM statuses LEFT JOIN fact ON status_id = order_status GROUP BY ALL"""
ORACLE["dim_date"] = ctes(*src("orders"), SPAN_CALENDAR.format(orders="src_orders")) + """
SELECT "date", date_id, cast(year("date") AS int) AS year, cast(quarter("date") AS int) AS quarter,
       cast(month("date") AS int) AS month, cast(week("date") AS int) AS week,
       cast(day("date") AS int) AS day, cast(dayofweek("date") + 1 AS int) AS day_of_week,
       dayname("date") AS day_name
FROM calendar"""
ORACLE["dim_products"] = STAR + "SELECT * FROM products_dim"
ORACLE["fact_order"] = FACT + "SELECT * FROM fact"
ORACLE["fact_orders_without_lines"] = FACT + "SELECT * FROM fact WHERE product_id IS NULL"
ORACLE["fact_uncovered_dates"] = ctes(*src("orders")) + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS dated, count(*) FILTER (WHERE {c} NOT BETWEEN "
    f"date '{FIRST_DAY}' AND date '{LAST_DAY}') AS uncovered FROM src_orders"
    for c in ("order_date", "required_date", "shipped_date")
)
ORACLE["surrogate_key_brands"] = (
    "SELECT p_brand, row_number() OVER (ORDER BY p_brand) AS brand_key "
    "FROM (SELECT DISTINCT p_brand FROM part)"
)
ORACLE["distinct_values"] = "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders"

# --- joins -------------------------------------------------------------------------------

ORACLE["join_left_order_lines"] = ctes(*src("orders", "order_items")) + """
SELECT o.order_id, o.customer_id, i.item_id, i.list_price
FROM src_orders o LEFT JOIN src_order_items i ON o.order_id = i.order_id"""
ORACLE["join_date_roles"] = ctes(*src("orders"), CALENDAR) + """
SELECT o.order_id, o.customer_id, o.order_status, o.store_id, o.staff_id,
       d1.date_id AS order_date_id, d2.date_id AS required_date_id, d3.date_id AS shipped_date_id
FROM src_orders o
LEFT JOIN calendar d1 ON o.order_date = d1."date"
LEFT JOIN calendar d2 ON o.required_date = d2."date"
LEFT JOIN calendar d3 ON o.shipped_date = d3."date" """
ORACLE["join_full_outer_products"] = ctes(*src("order_items", "products")) + """
SELECT i.order_id, p.product_id, i.quantity, p.product_name
FROM src_order_items i FULL OUTER JOIN src_products p ON i.product_id = p.product_id"""

# --- mart --------------------------------------------------------------------------------

ORACLE["mart_sales"] = MART + "SELECT * FROM mart"
ORACLE["mart_revenue"] = MART + (
    "SELECT order_id, product_id, revenue_per_product, price_after_discount, "
    "revenue_after_discount FROM mart"
)
ORACLE["mart_delays"] = MART + (
    "SELECT DISTINCT order_id, ordered_date, required_date, shipped_date, delay_time, "
    "days_to_ship FROM mart WHERE order_id IS NOT NULL"
)
ORACLE["mart_flags"] = MART + (
    "SELECT fulfilled_order_flag, high_value_order_flag, frequent_customer_flag, "
    "count(*) AS rows FROM mart GROUP BY ALL"
)
_FREQUENT = ", ".join(
    f"CASE WHEN {by} > {n} THEN 1 ELSE 0 END AS over_{n}_{by}"
    for n in (5, 40)
    for by in ("lines", "orders")
)
ORACLE["mart_frequent_customer"] = FACT + f"""
SELECT customer_id, lines, orders, {_FREQUENT}
FROM (SELECT customer_id, count(order_id) AS lines, count(DISTINCT order_id) AS orders
      FROM fact GROUP BY customer_id)"""
ORACLE["mart_unsold_products"] = STAR + (
    "SELECT * FROM products_dim p WHERE NOT EXISTS "
    "(SELECT 1 FROM fact f WHERE f.product_id = p.product_id)"
)

# --- measures ----------------------------------------------------------------------------

_QUARTER = "cast(year(ordered_date) AS int) AS year, cast(quarter(ordered_date) AS int) AS quarter"
_SALES = "FROM mart WHERE order_id IS NOT NULL"
_CUSTOMERS = f"""(SELECT customer_id, customers_state, count(DISTINCT order_id) AS orders,
  coalesce({NET}, 0) AS revenue, min(ordered_date) AS first_order, max(ordered_date) AS last_order
  {_SALES} AND customer_id IS NOT NULL GROUP BY customer_id, customers_state)"""
_PRODUCTS = "FROM mart WHERE product_id IS NOT NULL GROUP BY product_id, product_name"
_BY_REVENUE = f"SELECT product_id, product_name, coalesce({NET}, 0) AS revenue {_PRODUCTS}"
_BY_QUANTITY = (
    "SELECT product_id, product_name, cast(coalesce(sum(quantity), 0) AS bigint) AS quantity "
    f"{_PRODUCTS}"
)
_VALUES = f"""(SELECT customer_id, revenue, first_order, last_order,
  cast(last_order - first_order AS double) / cast(365 AS double) AS active_years,
  revenue / greatest(cast(1 AS double),
                     cast(last_order - first_order AS double) / cast(365 AS double)) AS value
  FROM {_CUSTOMERS})"""


def retained(orders: int) -> str:
    return (
        f"count(*) AS customers, count(*) FILTER (WHERE orders >= {orders}) AS retained, "
        f"cast(count(*) FILTER (WHERE orders >= {orders}) AS double) / count(*) AS retention_rate"
    )


ORACLE["kpi_sales_totals"] = MART + (
    f"SELECT {NET} AS revenue, cast(sum(quantity) AS bigint) AS quantity, "
    f"count(DISTINCT order_id) AS orders, {NET} / count(DISTINCT order_id) AS aov {_SALES}"
)
ORACLE["kpi_aov_quarter"] = MART + (
    f"SELECT {_QUARTER}, count(DISTINCT order_id) AS orders, "
    f"{NET} / count(DISTINCT order_id) AS aov {_SALES} GROUP BY 1, 2"
)
ORACLE["kpi_revenue_quarter"] = MART + (
    f"SELECT {_QUARTER}, {NET} AS revenue {_SALES} GROUP BY 1, 2"
)
ORACLE["kpi_revenue_state"] = MART + (
    f"SELECT customers_state, {NET} AS revenue {_SALES} GROUP BY customers_state"
)
ORACLE["kpi_discount_impact"] = MART + (
    "SELECT *, gross - net AS given_away, (gross - net) / nullif(gross, 0) AS given_share FROM "
    f"(SELECT discount, count(*) AS lines, {GROSS} AS gross, {NET} AS net {_SALES} "
    "AND discount IS NOT NULL GROUP BY discount)"
)
ORACLE["kpi_product_top"] = MART + f"{_BY_REVENUE} ORDER BY revenue DESC, product_id LIMIT 1"
ORACLE["kpi_product_max_qty"] = MART + f"{_BY_QUANTITY} ORDER BY quantity DESC, product_id LIMIT 1"
ORACLE["kpi_product_least"] = MART + f"{_BY_QUANTITY} ORDER BY quantity, product_id LIMIT 1"
ORACLE["kpi_qty_product"] = MART + _BY_QUANTITY
ORACLE["kpi_revenue_product"] = MART + _BY_REVENUE
ORACLE["kpi_brand_loyalty"] = MART + (
    f"SELECT brand_name, {retained(2)} FROM (SELECT brand_name, customer_id, "
    f"count(DISTINCT order_id) AS orders {_SALES} AND brand_name IS NOT NULL "
    "AND customer_id IS NOT NULL GROUP BY brand_name, customer_id) GROUP BY brand_name"
)
ORACLE["kpi_revenue_category"] = MART + (
    f"SELECT category_name, {NET} AS revenue {_SALES} AND product_id IS NOT NULL "
    "GROUP BY category_name"
)
ORACLE["kpi_customers_total"] = MART + f"SELECT count(DISTINCT customer_id) AS customers {_SALES}"
ORACLE["kpi_customer_value"] = MART + f"SELECT * FROM {_VALUES}"
ORACLE["kpi_clv"] = MART + (
    "SELECT round(avg(value), 2) AS mean_value, round(avg(active_years), 4) AS mean_years, "
    f"round(avg(value) * avg(active_years), 2) AS clv FROM {_VALUES}"
)
ORACLE["kpi_retention_rate"] = MART + f"SELECT {retained(2)} FROM {_CUSTOMERS}"
ORACLE["kpi_customer_distribution"] = MART + (
    f"SELECT customers_state, count(*) AS customers FROM {_CUSTOMERS} GROUP BY customers_state"
)
ORACLE["kpi_retention_state"] = MART + (
    f"SELECT customers_state, {retained(10)} FROM {_CUSTOMERS} GROUP BY customers_state"
)
ORACLE["kpi_retention_state_twice"] = MART + (
    f"SELECT customers_state, {retained(2)} FROM {_CUSTOMERS} GROUP BY customers_state"
)
ORACLE["kpi_retention_yoy"] = MART.rstrip() + f""",
active AS (SELECT DISTINCT customer_id, cast(year(ordered_date) AS int) AS year {_SALES}
           AND customer_id IS NOT NULL AND ordered_date IS NOT NULL)
SELECT a.year, count(*) AS customers, count(b.customer_id) AS retained,
       cast(count(b.customer_id) AS double) / count(*) AS retention_rate
FROM active a LEFT JOIN active b ON a.customer_id = b.customer_id AND b.year = a.year + 1
GROUP BY a.year"""
ORACLE["kpi_acquisition"] = MART + (
    "SELECT cast(date_trunc('month', first_order) AS date) AS month, count(*) AS customers "
    f"FROM {_CUSTOMERS} GROUP BY 1"
)
ORACLE["kpi_value_over_time"] = MART + (
    f"SELECT *, revenue / customers AS value FROM (SELECT {_QUARTER}, {NET} AS revenue, "
    f"count(DISTINCT customer_id) AS customers {_SALES} GROUP BY 1, 2)"
)

# --- whole runs --------------------------------------------------------------------------

_RUN = ctes(
    *src(*SOURCE_TABLES),
    *CLEAN_CUSTOMERS,
    *CLEAN_ITEMS,
    *CLEAN_STORES,
    SPAN_CALENDAR.format(orders="src_orders"),
    STATUS,
    fact("src_orders", "kept_discount"),
    products_dim(),
    mart("clean_stores", "src_staffs", "clean_customers"),
)
ORACLE["run_stage1_counts"] = _RUN + counts(
    {
        "customers": "clean_customers",
        "categories": "src_categories",
        "staffs": "src_staffs",
        "orders": "src_orders",
        "order_items": "kept_discount",
        "brands": "src_brands",
        "products": "src_products",
        "stores": "clean_stores",
    }
)
ORACLE["run_mart_counts"] = _RUN + f"""
SELECT count(*) AS rows, count(order_id) AS order_rows, count(product_id) AS product_rows,
       count(ordered_date) AS dated_rows, count(store_name) AS store_rows,
       cast(sum(fulfilled_order_flag) AS bigint) AS fulfilled,
       cast(sum(high_value_order_flag) AS bigint) AS high_value,
       cast(sum(frequent_customer_flag) AS bigint) AS frequent, {NET} AS revenue
FROM mart"""
