"""SQL for every named query, written independently of the Spark code.

``VIEWS`` repeats the table adapters of ``martflow.fixtures``; ``_with`` prepends the ones
a statement needs, in dependency order.
"""

from __future__ import annotations

VIEWS = {
    "sales": """
        SELECT o_custkey AS customer_id, l_partkey AS product_id,
               CAST(o_orderdate AS DATE) AS order_date,
               o_orderkey AS order_key, l_linenumber AS line_no
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "menu": """
        SELECT p_partkey AS product_id, p_name AS product_name,
               CAST(p_retailprice AS DECIMAL(18,2)) AS price FROM part""",
    "menu_partial": """
        SELECT CASE WHEN product_id % 50 <> 0 THEN product_id END AS product_id,
               product_name, price FROM menu""",
    "members": """
        SELECT c_custkey AS customer_id,
               CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY')
                    THEN DATE '1996-01-01' + 60 * CAST(c_nationkey AS INTEGER) END AS join_date
        FROM customer""",
    "products": """
        SELECT replace(p_brand, '#', '_') AS product_number,
               p_name || ' ' || CAST(1990 + p_partkey % 30 AS VARCHAR) AS product_name,
               p_type AS product_category, CAST(p_size * 100 AS DOUBLE) AS length,
               p_retailprice AS width
        FROM part""",
    "stats": """
        SELECT avg(length) - 3 * stddev_samp(length) AS l0,
               avg(length) + 3 * stddev_samp(length) AS l1,
               avg(width) - 3 * stddev_samp(width) AS w0,
               avg(width) + 3 * stddev_samp(width) AS w1
        FROM products""",
    "kept": """
        SELECT p.*, split_part(product_number, '_', 1) AS storeid,
               CASE WHEN product_number LIKE '%\\_%' ESCAPE '\\'
                    THEN split_part(product_number, '_', 2) END AS productid,
               regexp_extract(product_name, '\\b(\\d{4})\\b', 1) AS year,
               CASE WHEN length < 1000 THEN 'Small' WHEN length <= 2000 THEN 'Medium'
                    WHEN length <= 3000 THEN 'Large' ELSE 'Extra Large' END AS product_size
        FROM products p, stats
        WHERE length BETWEEN l0 AND l1 AND width BETWEEN w0 AND w1""",
    "reading_parts": """
        SELECT event_id, CAST(user_id AS VARCHAR) AS sensor_id, CAST(value AS FLOAT) AS temperature
        FROM events WHERE event_id % 31 <> 0""",
    "raw_once": """
        SELECT event_id, user_id,
               CASE WHEN event_id % 13 = 0 THEN 'NA' ELSE event_type END AS event_type,
               CASE WHEN event_id % 17 = 0 THEN 'na' ELSE CAST(value AS VARCHAR) END AS value,
               CASE WHEN event_id % 29 <> 0 THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS date,
               ts, props
        FROM events""",
    "raw_events": "SELECT * FROM raw_once UNION ALL SELECT * FROM raw_once WHERE event_id % 100 = 0",
    "tidy": """
        SELECT DISTINCT event_id, user_id, nullif(event_type, 'NA') AS event_type,
               TRY_CAST(nullif(value, 'na') AS DOUBLE) AS value, TRY_CAST(date AS DATE) AS date
        FROM raw_events""",
    "all_sales": """
        SELECT CAST(l_suppkey AS INTEGER) AS store, l_linenumber AS dept,
               CAST(l_shipdate AS DATE) AS date, l_extendedprice AS weekly_sales,
               l_returnflag = 'R' AS isholiday,
               l_shipdate + to_hours(l_linenumber) AS last_modified,
               l_orderkey AS order_key, l_shipdate < TIMESTAMP '2000-01-01' AS past
        FROM lineitem""",
    "past_sales": """
        SELECT store, dept, date, weekly_sales, isholiday, last_modified
        FROM all_sales WHERE past""",
    "new_sales": """
        SELECT store, dept, date, weekly_sales, isholiday, last_modified
        FROM all_sales WHERE NOT past""",
    "readable": """
        SELECT *, CASE WHEN order_key % 11 <> 0 AND order_key % 13 <> 0 THEN date END AS day
        FROM all_sales""",
    "features": """
        SELECT CAST(l_suppkey AS INTEGER) AS store,
               CAST(date_trunc('week', l_shipdate) AS DATE) AS date,
               max(l_quantity) AS temperature, max(l_discount) AS fuel_price,
               max(l_tax) AS cpi, min(l_quantity) AS unemployment
        FROM lineitem GROUP BY 1, 2""",
    "features_id": """
        SELECT CAST(store AS BIGINT) * 4294967296 + CAST(date - DATE '1970-01-01' AS BIGINT)
               AS feature_id, * FROM features""",
    "store": """
        SELECT CAST(s_suppkey AS INTEGER) AS store,
               substr('ABC', CAST(s_nationkey % 3 + 1 AS BIGINT), 1) AS type,
               CAST(floor(abs(s_acctbal)) AS INTEGER) AS size
        FROM supplier""",
    "fact": """
        SELECT p.store AS store_id, p.dept AS dept_id, p.date AS date_id, f.feature_id,
               p.weekly_sales, p.isholiday AS holiday_id, p.last_modified,
               f.fuel_price, f.cpi, f.unemployment
        FROM past_sales p JOIN features_id f ON p.store = f.store AND p.date = f.date""",
    "items": """
        SELECT p_partkey AS item_id, p_name AS item,
               CAST(p_retailprice AS DECIMAL(18,2)) AS cost FROM part""",
    "lines": """
        SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_suppkey AS supplier,
               l_partkey AS item_id, CAST(l_quantity AS INTEGER) AS quantity,
               l_returnflag = 'R' AS returned
        FROM lineitem""",
    "totals": """
        SELECT order_id, count(*) AS line_count,
               sum(CAST(cost * quantity AS DECIMAL(18,2))) AS items_total
        FROM (SELECT * FROM answered WHERE accepted) JOIN items USING (item_id) GROUP BY order_id""",
    "charged": """
        SELECT t.*, 1.5 * c_nationkey AS distance_km,
               CASE WHEN 1.5 * c_nationkey <= 15 THEN 50
                    WHEN 1.5 * c_nationkey <= 30 THEN 100 END AS charge
        FROM totals t JOIN orders ON o_orderkey = order_id
             JOIN customer ON c_custkey = o_custkey""",
    "bills": """
        SELECT order_id, items_total, charge, items_total + charge AS total
        FROM charged WHERE charge IS NOT NULL""",
    "headers": "SELECT *, row_number() OVER (ORDER BY order_id) AS id FROM bills",
    "decoded": """
        SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS date FROM events""",
}

NEEDS = {
    "menu_partial": ["menu"],
    "stats": ["products"],
    "kept": ["products", "stats"],
    "raw_events": ["raw_once"],
    "tidy": ["raw_events"],
    "past_sales": ["all_sales"],
    "new_sales": ["all_sales"],
    "readable": ["all_sales"],
    "features_id": ["features"],
    "fact": ["past_sales", "features_id"],
    "totals": ["answered", "items"],
    "answered": ["lines"],
    "charged": ["totals"],
    "bills": ["charged"],
    "headers": ["bills"],
}


def _with(views: str, body: str, recursive: bool = False, more: str = "") -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for n in NEEDS.get(name, []):
            add(n)
        if name not in ordered:
            ordered.append(name)

    for name in views.split():
        add(name)
    ctes = [f"{n} AS ({VIEWS[n]})" for n in ordered] + ([more] if more else [])
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(ctes) + "\n" + body if ctes else body


def _money(expression: str, name: str) -> str:
    return f"CAST({expression} AS DOUBLE) AS {name}"


SQL: dict[str, str] = {}

# -- loyalty -------------------------------------------------------------------------

SQL["customer_total_spent"] = _with(
    "sales menu_partial",
    f"SELECT customer_id, {_money('sum(price)', 'total_spent')} "
    "FROM sales LEFT JOIN menu_partial USING (product_id) GROUP BY customer_id",
)
SQL["customer_visit_days"] = _with(
    "sales",
    "SELECT customer_id, count(DISTINCT order_date) AS visit_days FROM sales GROUP BY customer_id",
)
SQL["customer_first_product"] = _with(
    "sales menu_partial",
    """SELECT customer_id, product_name FROM (
         SELECT customer_id, product_name, row_number() OVER (PARTITION BY customer_id
                ORDER BY order_date, order_key, line_no, product_id) AS rn
         FROM sales JOIN menu_partial USING (product_id)) WHERE rn = 1""",
)
SQL["top_product"] = _with(
    "sales menu",
    """SELECT product_name, total_purchases FROM (
         SELECT product_id, count(*) AS total_purchases FROM sales GROUP BY product_id
         ORDER BY total_purchases DESC, product_id LIMIT 1) JOIN menu USING (product_id)""",
)
SQL["favourite_products_by_name"] = _with(
    "sales menu",
    """SELECT customer_id, product_name, frequency FROM counts c
       WHERE frequency = (SELECT max(frequency) FROM counts d WHERE d.customer_id = c.customer_id)""",
    more="""counts AS (SELECT customer_id, product_name, count(product_id) AS frequency
            FROM sales JOIN menu USING (product_id) GROUP BY ALL)""",
)
SQL["favourite_products_by_id"] = _with(
    "sales menu_partial",
    """SELECT n.customer_id, product_name, frequency FROM (
         SELECT customer_id, product_name, count(s.product_id) AS frequency
         FROM sales s LEFT JOIN menu_partial m ON s.product_id = m.product_id GROUP BY ALL) n
       JOIN (SELECT customer_id, max(c) AS top FROM (
               SELECT customer_id, product_id, count(product_id) AS c FROM sales GROUP BY ALL)
             GROUP BY customer_id) t ON n.customer_id = t.customer_id AND frequency = top""",
)


def _member_first(menu: str, test: str, shown: str) -> str:
    return _with(
        f"sales {menu} members",
        f"""SELECT {shown} FROM theirs t JOIN (
              SELECT customer_id, min(order_date) AS first FROM theirs GROUP BY customer_id) f
            USING (customer_id) WHERE order_date = first""",
        more=f"""theirs AS (SELECT customer_id, product_name, join_date, order_date
                 FROM sales JOIN {menu} USING (product_id) JOIN members USING (customer_id)
                 WHERE {test})""",
    )


_DATED = "customer_id, product_name, join_date, order_date"
SQL["first_purchase_after_join"] = _member_first("menu", "order_date >= join_date", _DATED)
SQL["first_purchase_after_join_partial_menu"] = _member_first(
    "menu_partial", "order_date >= join_date", _DATED
)
SQL["first_purchase_before_join"] = _member_first(
    "menu", "order_date < join_date", "customer_id, product_name"
)
SQL["first_purchase_before_join_dates"] = _member_first("menu", "order_date < join_date", _DATED)
SQL["spend_before_join"] = _with(
    "sales menu members",
    f"""SELECT customer_id, count(product_id) AS total_items_purchased,
              {_money('sum(price)', 'total_amount_spent')}
       FROM sales JOIN menu USING (product_id) JOIN members USING (customer_id)
       WHERE order_date < join_date GROUP BY customer_id""",
)
SQL["loyalty_points"] = _with(
    "sales menu",
    f"""SELECT customer_id,
         {_money("sum(CASE WHEN product_id = 1 THEN price * 20 ELSE price * 10 END)", "points")}
       FROM sales JOIN menu USING (product_id) GROUP BY customer_id""",
)


def _promotion(days: str) -> str:
    bonus = f"{days} BETWEEN 0 AND 7 OR product_id = 1"
    total = f"sum(CASE WHEN {bonus} THEN price * 20 ELSE price * 10 END)"
    return _with(
        "sales menu members",
        f"""SELECT customer_id, {_money(total, 'total_points')}
            FROM sales JOIN menu USING (product_id) JOIN members USING (customer_id)
            WHERE order_date >= join_date AND order_date <= DATE '1999-12-31'
            GROUP BY customer_id""",
    )


SQL["promo_points_as_written"] = _promotion("(join_date - order_date)")
SQL["promo_points_first_week"] = _promotion("(order_date - join_date)")

# -- products ------------------------------------------------------------------------

SQL["product_key_parts"] = _with(
    "products",
    """SELECT product_number, split_part(product_number, '_', 1) AS storeid,
              split_part(product_number, '_', 2) AS productid, count(*) AS products
       FROM products GROUP BY product_number""",
)
SQL["product_year"] = _with(
    "products",
    """SELECT product_number, product_name, length,
              regexp_extract(product_name, '\\b(\\d{4})\\b', 1) AS year FROM products""",
)
SQL["product_size_bucket"] = _with(
    "products",
    """SELECT CASE WHEN length < 1000 THEN 'Small' WHEN length BETWEEN 1000 AND 2000 THEN 'Medium'
                   WHEN length BETWEEN 2000 AND 3000 THEN 'Large' ELSE 'Extra Large' END
              AS product_size, count(*) AS products FROM products GROUP BY 1""",
)
SQL["cleaned_products"] = _with(
    "kept",
    """SELECT product_number, product_name, product_category, length, width,
              storeid, productid, year, product_size FROM kept""",
)
SQL["category_size_pivot"] = _with(
    "kept",
    "SELECT product_category, "
    + ", ".join(
        f"nullif(count(*) FILTER (product_size = '{s}'), 0) AS \"{s}\""
        for s in ("Small", "Medium", "Large", "Extra Large")
    )
    + " FROM kept GROUP BY product_category",
)
SQL["second_longest_per_category"] = _with(
    "kept",
    """SELECT product_category, product_name, length FROM (
         SELECT *, row_number() OVER (PARTITION BY product_category
                ORDER BY length DESC, product_number, product_name) AS rn FROM kept)
       WHERE rn = 2""",
)

# -- sensors -------------------------------------------------------------------------

SQL["sensor_max"] = _with(
    "reading_parts", "SELECT max(temperature) AS max_temperature FROM reading_parts"
)
SQL["sensor_hot_counts"] = _with(
    "reading_parts",
    """SELECT sensor_id, count(*) AS readings FROM reading_parts WHERE temperature > 50
       GROUP BY sensor_id""",
)
SQL["sensor_rejects"] = """
    SELECT CASE WHEN event_id % 31 = 0 THEN 'arity' ELSE 'none' END AS reject,
           count(*) AS lines FROM events GROUP BY 1"""

# -- cleaning and quality ------------------------------------------------------------

SQL["missing_profile"] = _with(
    "raw_events",
    """SELECT count(*) FILTER (event_id IS NULL) AS event_id,
              count(*) FILTER (user_id IS NULL) AS user_id,
              count(*) FILTER (event_type IS NULL OR event_type IN ('NA', 'na')) AS event_type,
              count(*) FILTER (value IS NULL OR value IN ('NA', 'na')) AS value,
              count(*) FILTER (date IS NULL OR date IN ('NA', 'na')) AS date,
              count(*) FILTER (ts IS NULL) AS ts,
              count(*) FILTER (props IS NULL OR props IN ('NA', 'na')) AS props
       FROM raw_events""",
)
SQL["duplicate_profile"] = _with(
    "raw_events",
    """SELECT count(*) AS row_count,
              count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_events)) AS duplicate_rows
       FROM raw_events""",
)
SQL["full_profile"] = _with(
    "raw_events",
    """SELECT 'rows' AS metric, '' AS "column", count(*) AS value FROM raw_events
       UNION ALL SELECT 'duplicates', '', count(*) - (SELECT count(*) FROM
                 (SELECT DISTINCT * FROM raw_events)) FROM raw_events
       UNION ALL SELECT 'missing', 'event_id', count(*) - count(event_id) FROM raw_events
       UNION ALL SELECT 'missing', 'user_id', count(*) - count(user_id) FROM raw_events
       UNION ALL SELECT 'missing', 'event_type', count(*) FILTER (event_type = 'NA') FROM raw_events
       UNION ALL SELECT 'missing', 'value', count(*) FILTER (value = 'na') FROM raw_events
       UNION ALL SELECT 'missing', 'date', count(*) - count(date) FROM raw_events
       UNION ALL SELECT 'missing', 'ts', count(*) - count(ts) FROM raw_events
       UNION ALL SELECT 'missing', 'props', count(*) - count(props) FROM raw_events""",
)
SQL["label_profile"] = """
    SELECT count(*) - count(d.doc_id) AS doc_id,
           count(*) FILTER (text IS NULL OR text IN ('NA', 'na', '')) AS text,
           count(*) - count(lang) AS lang, count(*) - count(source) AS source,
           count(*) - count(n_chars) AS n_chars,
           count(*) - count(quality) AS quality, count(*) - count(toxic) AS toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
SQL["outliers_removed"] = """
    SELECT event_id, value FROM events,
      (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events)
    WHERE value BETWEEN m - 3 * s AND m + 3 * s"""
SQL["outlier_report"] = """
    SELECT 'value' AS "column", count(*) FILTER (abs(value - m) > 3 * s) AS outliers
    FROM events, (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events)
    UNION ALL
    SELECT 'user_id', count(*) FILTER (abs(user_id - m) > 3 * s)
    FROM events, (SELECT avg(user_id) AS m, stddev_samp(user_id) AS s FROM events)"""
_CHECKS = """checks AS (
      SELECT 'duplicates' AS "check", '' AS "column", count(*) - (SELECT count(*) FROM
             (SELECT DISTINCT * FROM events)) AS observed FROM events
      UNION ALL SELECT 'missing', 'event_id', count(*) - count(event_id) FROM events
      UNION ALL SELECT 'missing', 'user_id', count(*) - count(user_id) FROM events
      UNION ALL SELECT 'missing', 'event_type', count(*) - count(event_type) FROM events
      UNION ALL SELECT 'missing', 'value', count(*) - count(value) FROM events
      UNION ALL SELECT 'missing', 'ts', count(*) - count(ts) FROM events
      UNION ALL SELECT 'missing', 'props', count(*) - count(props) FROM events
      UNION ALL SELECT 'outliers', 'value', count(*) FILTER (abs(value - m) > 3 * s)
                FROM events, (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events))"""
SQL["quality_checks"] = f"""WITH {_CHECKS}
    SELECT "check", "column", observed, observed = 0 AS passed FROM checks"""
SQL["quality_verdict"] = f"""WITH {_CHECKS}
    SELECT CAST(sum(observed) AS BIGINT) AS issues, sum(observed) = 0 AS passed
    FROM checks WHERE "check" IN ('duplicates', 'outliers')"""
SQL["clean_drop_rows"] = _with(
    "raw_events",
    """SELECT event_id, user_id, event_type, round(CAST(value AS DOUBLE), 6) AS value,
              CAST(date AS DATE) AS date
       FROM raw_events WHERE event_type <> 'NA' AND value <> 'na' AND date IS NOT NULL
         AND ts IS NOT NULL AND props NOT IN ('NA', 'na')""",
)
SQL["impute_mean"] = _with(
    "tidy",
    "SELECT event_id, round(coalesce(value, (SELECT avg(value) FROM tidy)), 6) AS value FROM tidy",
)
_MODE = """(SELECT event_type FROM {0} WHERE event_type IS NOT NULL GROUP BY event_type
            ORDER BY count(*) DESC, event_type LIMIT 1)"""
SQL["impute_mode"] = _with(
    "tidy",
    f"SELECT event_id, coalesce(event_type, {_MODE.format('tidy')}) AS event_type FROM tidy",
)


def _most_frequent(table: str, column: str) -> str:
    return f"""coalesce({column}, (SELECT {column} FROM {table} WHERE {column} IS NOT NULL
               GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1)) AS {column}"""


SQL["impute_mode_events"] = _with(
    "raw_events",
    f"""SELECT event_id, {_most_frequent("e", "event_type")}, {_most_frequent("e", "props")} FROM e""",
    more="""e AS (SELECT event_id, CASE WHEN event_type NOT IN ('NA', 'na') THEN event_type END AS event_type,
                  CASE WHEN props NOT IN ('NA', 'na') THEN props END AS props FROM raw_events)""",
)
SQL["impute_mode_documents"] = f"""
    WITH d AS (SELECT doc_id,
            CASE WHEN doc_id % 29 <> 0 AND text NOT IN ('NA', 'na') THEN text END AS text,
            CASE WHEN doc_id % 13 <> 0 AND lang NOT IN ('NA', 'na') THEN lang END AS lang,
            CASE WHEN doc_id % 17 <> 0 AND source NOT IN ('NA', 'na') THEN source END AS source
        FROM documents)
    SELECT doc_id, {_most_frequent("d", "text")}, {_most_frequent("d", "lang")},
           {_most_frequent("d", "source")} FROM d"""
SQL["forward_fill_date"] = _with(
    "tidy",
    """SELECT event_id, last_value(date IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS date FROM tidy""",
)
SQL["forward_fill_date_global"] = _with(
    "tidy",
    """SELECT event_id, last_value(date IGNORE NULLS) OVER (ORDER BY event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS date FROM tidy""",
)


def _imputed(tidy: str) -> str:
    return f"""SELECT event_id, user_id, coalesce(event_type, {_MODE.format(tidy)}) AS event_type,
        coalesce(value, (SELECT avg(value) FROM {tidy})) AS value,
        last_value(date IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS date FROM {tidy}"""


_ROUNDED = "SELECT event_id, user_id, event_type, round(value, 6) AS value, date"
SQL["clean_impute_rows"] = _with("tidy", f"{_ROUNDED} FROM ({_imputed('tidy')})")
SQL["merge_increment"] = _with(
    "tidy",
    f"{_ROUNDED} FROM ({_imputed('whole')})",
    more=f"""fresh AS (SELECT * FROM tidy WHERE date >= DATE '2024-01-20'),
        whole AS (SELECT * FROM tidy WHERE date IS NULL OR date < DATE '2024-01-20'
                  UNION SELECT * FROM ({_imputed('fresh')}))""",
)
SQL["merge_increment_stateful"] = SQL["clean_impute_rows"]
SQL["merge_increment_drop"] = SQL["clean_drop_rows"]
SQL["constraint_violations"] = """
    WITH rows AS (SELECT d.doc_id, lang, quality FROM documents d
                  LEFT JOIN labels l ON d.doc_id = l.doc_id)
    SELECT 'not_null' AS "constraint", 'lang' AS "column",
           count(*) - count(lang) AS violations FROM rows
    UNION ALL SELECT 'not_null', 'quality', count(*) - count(quality) FROM rows
    UNION ALL SELECT 'unique', 'doc_id', count(doc_id) - count(DISTINCT doc_id) FROM rows
    UNION ALL SELECT 'foreign_key', 'doc_id', count(*) FROM rows r
              WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = r.doc_id)"""

# -- incremental loading -------------------------------------------------------------

SQL["high_water_mark"] = """
    SELECT o_orderdate, o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1"""
SQL["fetch_since_mark"] = """
    SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01'
    ORDER BY o_orderdate, o_orderkey LIMIT 100"""
SQL["all_since_mark"] = """
    SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
    WHERE o_orderdate > TIMESTAMP '2001-01-01'
       OR (o_orderdate = TIMESTAMP '2001-01-01' AND o_orderkey > 12000)"""
SQL["stamped_batch"] = """
    SELECT o_orderkey, o_orderdate, TIMESTAMP '2001-01-01' AS last_modified FROM orders
    ORDER BY o_orderdate, o_orderkey LIMIT 100"""
SQL["load_by_key"] = """
    SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem WHERE l_orderkey > 12000"""
SQL["next_load_key"] = """
    SELECT coalesce(max(l_orderkey), 12000) AS last_key FROM lineitem WHERE l_orderkey > 12000"""

SQL["incremental_files"] = """
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderkey % 3 AS part, o_orderkey % 3 AS batch FROM orders"""
SQL["incremental_job"] = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"

# -- star schema ---------------------------------------------------------------------

_FLOAT_SALES = "round(CAST(CAST(weekly_sales AS FLOAT) AS DOUBLE), 2) AS weekly_sales"
SQL["typed_load"] = _with(
    "readable",
    f"""SELECT store, dept, date, {_FLOAT_SALES}, isholiday, CAST(last_modified AS DATE) AS last_modified
        FROM readable WHERE past AND day IS NOT NULL""",
)
SQL["typed_load_summary"] = _with(
    "readable",
    """SELECT count(*) AS rows_read, count(day) AS rows_kept, count(*) - count(day) AS rows_dropped
       FROM readable WHERE past""",
)
SQL["dim_store"] = _with(
    "store",
    "SELECT DISTINCT store AS store_id, type AS store_type, size AS store_size FROM store",
)


def _days(source: str, column: str) -> str:
    return f"""SELECT DISTINCT {column} AS date_id, CAST(year({column}) AS INTEGER) AS year,
        CAST(month({column}) AS INTEGER) AS month, CAST(day({column}) AS INTEGER) AS day
        FROM {source}"""


SQL["dim_date"] = _with("past_sales", _days("past_sales", "date"))
SQL["dim_date_guarded"] = _with("readable", _days("(SELECT day AS d FROM readable)", "d"))
SQL["dim_department"] = _with(
    "past_sales",
    "SELECT dept AS dept_id, max(last_modified) AS last_modified FROM past_sales GROUP BY dept",
)
SQL["dim_holiday"] = _with(
    "all_sales",
    """SELECT isholiday AS holiday_id, max(last_modified) AS last_modified
       FROM all_sales GROUP BY isholiday""",
)
SQL["dim_features"] = _with(
    "features_id",
    "SELECT feature_id, temperature, fuel_price, cpi, unemployment FROM features_id",
)
SQL["dim_features_dense"] = _with(
    "features",
    """SELECT row_number() OVER (ORDER BY store, date) AS feature_id,
              temperature, fuel_price, cpi, unemployment FROM features""",
)
SQL["fact_sales"] = _with(
    "fact",
    """SELECT store_id, dept_id, date_id, feature_id, weekly_sales, holiday_id, last_modified
       FROM fact""",
)
SQL["fact_sales_bucketed"] = SQL["fact_sales"]
SQL["fact_sales_all"] = _with(
    "readable features_id store",
    """SELECT r.store AS store_id, dept AS dept_id, day AS date_id, feature_id,
              weekly_sales, isholiday AS holiday_id
       FROM readable r JOIN features_id f ON r.store = f.store AND r.day = f.date
       WHERE r.store IN (SELECT store FROM store)""",
)
SQL["wide_sales"] = _with(
    "past_sales features store",
    """SELECT p.store AS past_store, p.dept AS past_dept, p.date AS past_date,
              p.weekly_sales AS past_weekly_sales, p.isholiday AS past_isholiday,
              f.store, f.date, temperature, fuel_price, cpi, unemployment,
              s.store AS store_info, type, size
       FROM past_sales p LEFT JOIN features f ON p.store = f.store AND p.date = f.date
            LEFT JOIN store s ON p.store = s.store
       WHERE f.store IS NOT NULL AND s.store IS NOT NULL""",
)
SQL["renamed_sales"] = _with(
    "past_sales",
    """SELECT CAST(store AS BIGINT) AS right_store, CAST(dept AS BIGINT) AS right_dept,
              CAST(date AS VARCHAR) AS right_date, weekly_sales AS right_weekly_sales,
              isholiday AS right_isholiday FROM past_sales""",
)
SQL["right_join_by_store"] = _with(
    "past_sales features",
    """SELECT CAST(p.store AS BIGINT) AS right_store, count(*) AS joined_rows,
              CAST(sum(CAST(weekly_sales AS DECIMAL(18,2))) AS DOUBLE) AS sum_weekly_sales,
              CAST(sum(CAST(fuel_price AS DECIMAL(18,2))) AS DOUBLE) AS sum_fuel_price
       FROM features f RIGHT JOIN past_sales p ON f.store = p.store GROUP BY p.store""",
)

# -- reports -------------------------------------------------------------------------

_TOTAL = _money("sum(CAST(weekly_sales AS DECIMAL(18,2)))", "total_sales")
SQL["sales_over_time"] = _with("fact", f"SELECT date_id, {_TOTAL} FROM fact GROUP BY date_id")
SQL["sales_by_month"] = _with(
    "fact",
    f"""SELECT CAST(year(date_id) AS INTEGER) AS year, CAST(month(date_id) AS INTEGER) AS month,
               {_TOTAL} FROM fact GROUP BY 1, 2""",
)
SQL["holiday_sales"] = _with("fact", f"SELECT holiday_id, {_TOTAL} FROM fact GROUP BY holiday_id")
SQL["sales_with_drivers"] = _with(
    "fact", "SELECT store_id, date_id, weekly_sales, fuel_price, cpi, unemployment FROM fact"
)
SQL["driver_correlations"] = _with(
    "fact",
    " UNION ALL ".join(
        f"""SELECT '{d}' AS driver, CAST(regr_count(weekly_sales, {d}) AS BIGINT) AS pairs,
            round(corr({d}, weekly_sales), 6) AS correlation,
            round(regr_slope(weekly_sales, {d}), 3) AS slope FROM fact"""
        for d in ("fuel_price", "cpi", "unemployment")
    ),
)
SQL["driver_bins"] = _with(
    "fact",
    f"""SELECT CAST(floor(unemployment / 5) AS BIGINT) AS bin, count(*) AS sales_rows,
               round(CAST(sum(CAST(weekly_sales AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2)
               AS mean_sales, {_TOTAL} FROM fact GROUP BY 1""",
)

# -- orders --------------------------------------------------------------------------

SQL["cart_lines"] = _with(
    "lines items",
    f"""SELECT order_id, line_no, item_id, quantity, item, {_money('cost', 'cost')},
               {_money('cost * quantity', 'line_total')}
        FROM lines JOIN items USING (item_id)""",
)
def _settled(quantity: str, opening: int) -> str:
    """One step per request of an item, all items side by side."""
    fits = f"coalesce(CAST(held + q AS BIGINT) BETWEEN 0 AND {opening}, false)"
    return f"""asked AS (SELECT *, {quantity} AS q, row_number() OVER (PARTITION BY item_id
                    ORDER BY order_id, line_no, supplier, {quantity} NULLS FIRST) AS rn FROM lines),
            run AS (
              SELECT p_partkey AS item_id, CAST(0 AS BIGINT) AS rn, CAST(0 AS BIGINT) AS held,
                     false AS accepted
              FROM part
              UNION ALL
              SELECT a.item_id, a.rn,
                     CASE WHEN {fits} THEN held + q ELSE held END, {fits}
              FROM run JOIN asked a ON a.item_id = run.item_id AND a.rn = run.rn + 1),
            answered AS (SELECT a.*, r.accepted, r.held
                         FROM run r JOIN asked a ON a.item_id = r.item_id AND a.rn = r.rn)"""


def _sequential(quantity: str, opening: int, body: str) -> str:
    return _with("lines", body, recursive=True, more=_settled(quantity, opening))


# Only accepted lines are billed, placed and taken from stock; returned lines ask for nothing.
VIEWS["answered"] = (
    "SELECT * FROM (WITH RECURSIVE "
    + _settled("CASE WHEN NOT returned THEN quantity END", 500)
    + " SELECT * FROM answered)"
)
SQL["order_totals"] = _with(
    "totals", f"SELECT order_id, line_count, {_money('items_total', 'items_total')} FROM totals"
)
SQL["order_bills"] = _with(
    "bills",
    f"""SELECT order_id, {_money('items_total', 'items_total')},
               {_money('charge', 'delivery_charge')}, {_money('total', 'total_amount')}
        FROM bills""",
)
SQL["undeliverable_orders"] = _with(
    "charged",
    f"""SELECT order_id, {_money('items_total', 'items_total')},
               CAST(distance_km AS DOUBLE) AS distance_km, 'too far' AS reason
        FROM charged WHERE charge IS NULL""",
)


SQL["stock_allocation"] = _sequential(
    "quantity",
    500,
    "SELECT order_id, line_no, supplier, item_id, quantity, accepted, held FROM answered",
)
_SIGNED = "CASE WHEN returned THEN -quantity ELSE quantity END"
SQL["cart_requests"] = _sequential(
    _SIGNED,
    200,
    """SELECT order_id, line_no, supplier, item_id, CAST(q AS INTEGER) AS quantity, accepted, held
       FROM answered""",
)
SQL["cart_after_removals"] = _sequential(
    _SIGNED,
    200,
    """SELECT item_id, CAST(sum(q) AS BIGINT) AS held FROM answered WHERE accepted
       GROUP BY item_id HAVING sum(q) > 0""",
)
SQL["placed_orders"] = _with(
    "headers",
    f"""SELECT id, order_id, {_money('total', 'total_amount')},
               {_money('charge', 'delivery_charge')}, TIMESTAMP '2024-01-01' AS order_date
        FROM headers""",
)
SQL["placed_order_lines"] = _with(
    "headers",
    """SELECT row_number() OVER (ORDER BY h.id, item_id) AS id, h.id AS order_id, item_id,
              CAST(sum(quantity) AS BIGINT) AS quantity
       FROM answered l JOIN headers h ON l.order_id = h.order_id WHERE accepted
       GROUP BY h.id, item_id""",
)
SQL["remaining_stock"] = _with(
    "answered items",
    """SELECT i.item_id, item, CAST(500 - coalesce(sum(quantity), 0) AS BIGINT) AS remaining
       FROM items i LEFT JOIN (SELECT * FROM answered WHERE accepted) l ON i.item_id = l.item_id
       GROUP BY i.item_id, item""",
)

# -- change feed ---------------------------------------------------------------------

_MESSAGE = """'{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' ||
    event_type || '","value":' || value || ',"ts":"' || ts || '"}'"""
SQL["changes_encoded"] = f"""
    SELECT CASE WHEN event_id % 2 = 0 THEN '"' || replace(m, '"', '\\"') || '"' ELSE m END AS value
    FROM (SELECT event_id, {_MESSAGE} AS m FROM events)"""
for _name in (
    "changes_decoded",
    "published_changes",
    "stream_changes_logged",
    "stream_changes_to_table",
    "stream_changes_to_json",
    "json_roundtrip",
):
    SQL[_name] = _with("decoded", "SELECT * FROM decoded")
SQL["unreadable_changes"] = """
    SELECT '{"event_id": ' || (event_id % 7) AS value,
           count(*) + count(*) FILTER (event_id % 50 = 0) + count(*) FILTER (event_id % 20 = 0) AS times
    FROM events WHERE event_id % 37 = 0 GROUP BY 1"""
SQL["sales_changes_decoded"] = _with(
    "past_sales",
    f"""SELECT store AS store_id, dept, date, {_FLOAT_SALES}, isholiday, last_modified
        FROM past_sales""",
)
SQL["captured_changes"] = """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01'"""

# -- sources and sinks ---------------------------------------------------------------

SQL["csv_roundtrip"] = _with(
    "readable",
    """SELECT CAST(store AS VARCHAR) AS store, CAST(dept AS VARCHAR) AS dept,
              CASE WHEN order_key % 11 = 0 THEN 'NA' WHEN order_key % 13 <> 0
                   THEN CAST(date AS VARCHAR) END AS date,
              CAST(CAST(weekly_sales AS DECIMAL(18,2)) AS VARCHAR) AS weekly_sales,
              CAST(isholiday AS VARCHAR) AS isholiday,
              strftime(last_modified, '%Y-%m-%dT%H:%M:%S.000Z') AS last_modified
       FROM readable WHERE past""",
)
SQL["typed_csv_roundtrip"] = _with(
    "past_sales", "SELECT store, dept, date, weekly_sales, isholiday FROM past_sales"
)
SQL["orc_table_roundtrip"] = SQL["dim_store"]
SQL["external_csv_table"] = SQL["dim_date"]
for _name in ("csv_table_with_catalog", "parquet_table_with_catalog", "orc_table_overwritten", "recursive_csv"):
    SQL[_name] = SQL["typed_csv_roundtrip"]
SQL["inferred_csv"] = _with(
    "past_sales",
    "SELECT store, CAST(dept AS INTEGER) AS dept, weekly_sales, isholiday FROM past_sales",
)
SQL["ddl_csv"] = _with("store", "SELECT store, type, size FROM store")
SQL["replaced_if_any"] = SQL["dim_store"]
SQL["replaced_csv_if_any"] = SQL["dim_store"]
SQL["fact_sales_by_month"] = _with(
    "fact",
    """SELECT store_id, dept_id, date_id, feature_id,
              weekly_sales, holiday_id, CAST(year(date_id) AS INTEGER) AS year,
              CAST(month(date_id) AS INTEGER) AS month
       FROM fact""",
)
SQL["unloaded_tables"] = _with(
    "past_sales",
    f"""SELECT * FROM ({_days("past_sales", "date")}) UNION ALL
        SELECT * FROM ({_days("past_sales", "date")})""",
)
SQL["appended_extract"] = "SELECT DISTINCT o_orderkey, o_custkey FROM orders"
SQL["seeded_table"] = f"""
    SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS item,
           {_money("CAST(p_retailprice AS DECIMAL(10,2))", "cost")}, 500 AS quantity,
           CAST(4 AS BIGINT) AS columns FROM part
    UNION ALL SELECT -1, 'sample one', NULL, NULL, 4
    UNION ALL SELECT -2, 'sample two', NULL, NULL, 4"""

# -- checked and pinned CSV ----------------------------------------------------------

SQL["csv_rejects"] = """
    WITH f AS (SELECT l_orderkey % 83 = 0 OR l_orderkey % 79 = 0 AS a, l_orderkey % 97 = 0 AS q,
                      l_orderkey % 89 = 0 AS d FROM lineitem)
    SELECT 'arity' AS kind, '' AS "column", count(*) AS cells FROM f WHERE a HAVING count(*) > 0
    UNION ALL SELECT 'type', 'l_quantity', count(*) FROM f WHERE q AND NOT a HAVING count(*) > 0
    UNION ALL SELECT 'type', 'l_shipdate', count(*) FROM f WHERE d AND NOT a HAVING count(*) > 0
    UNION ALL SELECT 'none', '', count(*) FROM f WHERE NOT a AND NOT q AND NOT d HAVING count(*) > 0"""
SQL["pinned_rows"] = """
    SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
           floor(o_totalprice) + CASE WHEN o_orderkey % 2 = 1 THEN 0.5 ELSE 0 END AS price,
           CAST(CASE WHEN o_orderkey % 2 = 0 THEN 1 END AS INTEGER) AS lane,
           CASE WHEN o_orderkey % 2 = 1 THEN 'web' END AS channel
    FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 11 <> 0"""
SQL["schema_drift"] = """
    WITH late AS (SELECT count(*) AS n, count(*) FILTER (o_orderkey % 11 = 0) AS odd FROM orders WHERE o_orderkey % 2 = 1)
    SELECT v.*, CASE WHEN v."column" = 'o_custkey' THEN odd ELSE 0 END AS cells
    FROM late, (VALUES ('o_custkey', 'conflict', 'int', 'string'), ('price', 'wider', 'int', 'double'),
                       ('lane', 'missing', 'int', NULL), ('channel', 'new', NULL, 'string'))
               v("column", change, pinned, found)
    WHERE n > 0"""
