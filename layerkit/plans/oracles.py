"""Independent DuckDB SQL for every registered query (the correctness oracle).

Column names and types are aliased/cast to match the Spark results exactly;
dates appear as midnight TIMESTAMPs, as the registered Spark results hand them out.
"""
from __future__ import annotations

_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]

_SALES_BY_TYPE_YEAR = """
    SELECT p.p_type, CAST(year(o.o_orderdate) AS INTEGER) AS year,
           CAST(l.l_quantity AS BIGINT) AS quantity
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    LEFT JOIN part p ON l.l_partkey = p.p_partkey
    WHERE o.o_orderdate >= TIMESTAMP '1996-01-01' AND o.o_orderdate < TIMESTAMP '2001-01-01'
"""

_PIVOT_GROUPS = ("SELECT year, " + ", ".join(
    f"CAST(SUM(CASE WHEN p_type = '{t}' THEN quantity END) AS BIGINT) AS {t.lower()}"
    for t in _TYPES) + f" FROM ({_SALES_BY_TYPE_YEAR}) GROUP BY year")

_PROCESSING = """
    SELECT n.n_name, o.o_orderdate,
           date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS d
    FROM lineitem l
    LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
    LEFT JOIN customer c ON c.c_custkey = o.o_custkey
    LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
"""

_AVG_INT = "CAST(sign(SUM(d)) * floor(abs(SUM(d)) / COUNT(d)) AS INTEGER)"

RETAIL = {
    "q01_or_join": """
        SELECT c.c_custkey, c.c_name, s.s_suppkey, s.s_name
        FROM customer c LEFT JOIN supplier s
          ON c.c_custkey = s.s_suppkey OR c.c_nationkey = s.s_nationkey""",
    "q02_join_residual": """
        SELECT c.c_custkey, c.c_name, s.s_suppkey
        FROM supplier s JOIN customer c ON s.s_nationkey = c.c_nationkey
        WHERE right(s.s_name, 2) = right(c.c_name, 2)""",
    "q03_lapsed_customers": """
        SELECT o.o_custkey FROM orders o
        WHERE o.o_orderdate < TIMESTAMP '2001-06-01'
          AND o.o_custkey NOT IN (SELECT DISTINCT o_custkey FROM orders
                                  WHERE o_orderdate >= TIMESTAMP '2001-06-01')""",
    "q04_count_by_name": """
        SELECT p.p_name, COUNT(p.p_name) AS quantity
        FROM orders o
        LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
        LEFT JOIN part p ON l.l_partkey = p.p_partkey
        WHERE year(o.o_orderdate) = 1997
        GROUP BY p.p_name""",
    "q04_archive_count": """
        WITH h AS (
            SELECT p_partkey, p_name, unnest(range(1, CAST(p_partkey % 3 + 1 AS INTEGER) + 1)) AS version
            FROM part)
        SELECT h.p_name, COUNT(h.p_name) AS quantity
        FROM orders o
        LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
        LEFT JOIN h ON l.l_partkey = h.p_partkey
        WHERE year(o.o_orderdate) = 1997
        GROUP BY h.p_name""",
    "q05_len_filter": "SELECT p_partkey, p_name FROM part WHERE length(rtrim(p_name)) > 10",
    "q06_not_in_regions": """
        SELECT DISTINCT p.p_name FROM part p
        LEFT JOIN lineitem l ON l.l_partkey = p.p_partkey
        LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
        LEFT JOIN customer c ON c.c_custkey = o.o_custkey
        LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
        WHERE n.n_name NOT IN ('NATION_1', 'NATION_2') AND year(o.o_orderdate) = 1998""",
    "q07_avg_days": f"SELECT n_name, {_AVG_INT} AS avg_process_days FROM ({_PROCESSING}) GROUP BY n_name",
    "q08_by_month": f"""
        SELECT n_name, CAST(month(o_orderdate) AS INTEGER) AS month, {_AVG_INT} AS avg_process_days
        FROM ({_PROCESSING}) GROUP BY n_name, month(o_orderdate)""",
    "q09_bought_gt_sold": """
        WITH sold AS (
            SELECT p.p_partkey, CAST(SUM(CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS quantity_sold
            FROM part p
            LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag <> 'R') l ON l.l_partkey = p.p_partkey
            LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
            WHERE year(o.o_orderdate) = 1999
            GROUP BY p.p_partkey),
        bought AS (
            SELECT p.p_partkey, p.p_name,
                   CAST(SUM(CAST(l.l_quantity AS BIGINT) * p.p_size) AS BIGINT) AS quantity_purchased
            FROM part p
            LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') l ON l.l_partkey = p.p_partkey
            LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
            WHERE year(o.o_orderdate) = 1999
            GROUP BY p.p_partkey, p.p_name)
        SELECT b.p_partkey, b.p_name, b.quantity_purchased, s.quantity_sold
        FROM bought b LEFT JOIN sold s ON s.p_partkey = b.p_partkey
        WHERE b.quantity_purchased > s.quantity_sold""",
    "q10_having_like": """
        WITH per_order AS (
            SELECT o.o_custkey, o.o_orderkey, SUM(CAST(l.l_quantity AS BIGINT)) AS sold_num
            FROM orders o
            JOIN lineitem l ON o.o_orderkey = l.l_orderkey AND year(o.o_orderdate) = 1996
            JOIN part p ON l.l_partkey = p.p_partkey
            WHERE p.p_name ILIKE '%ring%'
            GROUP BY o.o_custkey, o.o_orderkey),
        cte AS (SELECT o_custkey FROM per_order GROUP BY o_custkey HAVING SUM(sold_num) <= 100)
        SELECT c.c_custkey, c.c_name, n.n_name AS primary_contact
        FROM cte LEFT JOIN customer c ON cte.o_custkey = c.c_custkey
        LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "q11_between": """
        SELECT o_orderkey, o_orderdate FROM orders
        WHERE o_orderdate BETWEEN TIMESTAMP '2001-01-01' AND TIMESTAMP '2001-07-15'""",
    "q12_wide_join": """
        SELECT l.l_orderkey, l.l_linenumber, p.p_name, c.c_name, c.c_mktsegment, n.n_name, r.r_name,
               CAST(l.l_quantity AS BIGINT) AS quantity
        FROM lineitem l
        LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
        LEFT JOIN customer c ON c.c_custkey = o.o_custkey
        LEFT JOIN part p ON p.p_partkey = l.l_partkey
        LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
        LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
        WHERE o.o_orderdate = TIMESTAMP '1995-07-12'""",
    "q13_group_balance": """
        WITH bought AS (
            SELECT p.p_type, CAST(SUM(CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS quantity_purchased
            FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
            WHERE l.l_returnflag = 'R' GROUP BY p.p_type),
        sold AS (
            SELECT p.p_type, CAST(SUM(CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS quantity_ordered
            FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
            WHERE l.l_returnflag <> 'R' GROUP BY p.p_type)
        SELECT b.p_type, b.quantity_purchased, s.quantity_ordered,
               b.quantity_purchased - s.quantity_ordered AS quantity_remaining
        FROM bought b LEFT JOIN sold s ON b.p_type IS NOT DISTINCT FROM s.p_type""",
    "q14_top_item_by_city": """
        WITH cte1 AS (
            SELECT l.l_partkey, c.c_nationkey, COUNT(*) AS deliveries
            FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
            JOIN customer c ON o.o_custkey = c.c_custkey
            WHERE year(o.o_orderdate) = 1996
            GROUP BY l.l_partkey, c.c_nationkey),
        cte2 AS (
            SELECT l_partkey, c_nationkey FROM (
                SELECT l_partkey, c_nationkey,
                       dense_rank() OVER (PARTITION BY c_nationkey ORDER BY deliveries DESC) AS rnk
                FROM cte1) WHERE rnk = 1)
        SELECT n.n_name, coalesce(p.p_name, 'No Sale') AS most_delivered_item
        FROM cte2 JOIN part p ON cte2.l_partkey = p.p_partkey
        RIGHT JOIN nation n ON cte2.c_nationkey = n.n_nationkey""",
    "q15_json_index": """
        WITH docs AS (
            SELECT l_orderkey,
                   to_json({'Events': list({'Line': l_linenumber, 'Event': l_returnflag, 'Comment': CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)}
                                           ORDER BY l_linenumber, l_returnflag, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR))}) AS ReturnedDeliveryData
            FROM lineitem GROUP BY l_orderkey)
        SELECT l_orderkey, json_extract_string(ReturnedDeliveryData, '$.Events[1].Comment') AS comment FROM docs
        WHERE json_extract_string(ReturnedDeliveryData, '$.Events[1].Comment') IS NOT NULL""",
    "q16_json_value_eq": """
        SELECT DISTINCT user_id FROM events WHERE json_extract_string(props, '$.k') = '9'""",
    "q17_json_group": """
        SELECT json_extract_string(props, '$.k') AS k,
               CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
        FROM events WHERE event_type = 'purchase' GROUP BY 1""",
    "q18_pivot_years": "SELECT p_type, " + ", ".join(
        f"CAST(SUM(CASE WHEN year = {y} THEN quantity END) AS BIGINT) AS y{y}"
        for y in (1996, 1997, 1998, 1999, 2000)) + f" FROM ({_SALES_BY_TYPE_YEAR}) GROUP BY p_type",
    "q19_pivot_groups": _PIVOT_GROUPS,
    "q20_tvf_apply": """
        SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderdate, f.total
        FROM orders o JOIN (
            SELECT l_orderkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
            FROM lineitem GROUP BY l_orderkey) f ON f.l_orderkey = o.o_orderkey""",
    "q25_for_json": f"""
        SELECT year, '{{"Year":' || year || ',"StockGroup":{{' || concat_ws(',', """ + ", ".join(
        f"CASE WHEN {t.lower()} IS NOT NULL THEN '\"{t}\":' || {t.lower()} END" for t in _TYPES)
        + f""") || '}}}}' AS json FROM ({_PIVOT_GROUPS})""",
    "q26_for_xml": f"""
        SELECT year, '<StockItems Year="' || year || '">' || chr(10) || concat_ws('', """ + ", ".join(
        f"CASE WHEN {t.lower()} IS NOT NULL THEN '    <{t}>' || {t.lower()} || '</{t}>' || chr(10) END"
        for t in _TYPES) + f""") || '</StockItems>' AS xml FROM ({_PIVOT_GROUPS})""",
}



_ODS_ROWS = """
    SELECT o.o_orderkey AS OrderID,
           CAST(CAST(SUM({amount}) AS DECIMAL(18,2)) AS DOUBLE) AS OrderTotal,
           o.o_custkey AS CustomerID, CAST(CAST(o.o_orderdate AS DATE) AS TIMESTAMP) AS OrderDate
    FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
    WHERE o.o_orderdate >= TIMESTAMP '{lo}' AND o.o_orderdate < TIMESTAMP '{hi}'
    GROUP BY o.o_orderkey, o.o_custkey, o.o_orderdate"""
_NO_TAX = "CAST(l.l_extendedprice AS DECIMAL(18,2))"
_TAX = "CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 + CAST(l.l_tax AS DECIMAL(18,3)))"

INCREMENTAL = {
    "q21_load_date": _ODS_ROWS.format(amount=_NO_TAX, lo="1995-01-01", hi="1995-01-06"),
    "q23_load_week": _ODS_ROWS.format(amount=_NO_TAX, lo="1995-01-03", hi="1995-01-11"),
    "q23_with_tax": _ODS_ROWS.format(amount=_TAX, lo="1995-01-06", hi="1995-01-14"),
    "q22_shred_json": """
        SELECT event_id, ts, user_id, event_type, value, json_extract_string(props, '$.k') AS k
        FROM events""",
    "q24_scalar_or_array": r"""
        WITH mx AS (SELECT max(p_partkey) AS m FROM part),
        r AS (
            SELECT p_partkey, p_name, p_brand, p_retailprice,
                   unnest(CASE WHEN p_size % 2 = 0 THEN [p_size, p_size + 1] ELSE [p_size] END) AS pkg,
                   CASE WHEN p_partkey % 50 = 0 THEN NULL
                        ELSE CAST(DATE '2018-01-01' + CAST(p_partkey % 28 AS INTEGER) AS TIMESTAMP) END AS OrderDate
            FROM part),
        n AS (SELECT *, row_number() OVER (ORDER BY p_partkey, pkg) AS rn FROM r)
        SELECT CAST(mx.m + n.rn AS BIGINT) AS StockItemID,
               n.p_name || '(' || CAST(n.rn AS VARCHAR) || ')' AS StockItemName,
               CAST(regexp_extract(n.p_brand, '(\d+)', 1) AS INTEGER) AS SupplierID,
               CAST(1 AS INTEGER) AS UnitPackageID, CAST(n.pkg AS INTEGER) AS OuterPackageID,
               n.p_brand AS Brand, CAST(CAST(n.p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS UnitPrice,
               n.OrderDate, false AS IsChillerStock
        FROM n, mx""",
    "i_watermark_increment": """
        SELECT o_orderkey, o_custkey, o_orderdate FROM orders
        WHERE o_orderdate > TIMESTAMP '2001-01-01'
          AND o_orderdate <= (SELECT max(o_orderdate) FROM orders)""",
    "i_upsert": """
        SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders
        WHERE o_orderdate < TIMESTAMP '1999-07-01'
        UNION ALL
        SELECT o_orderkey, 'U' AS o_orderstatus, o_orderdate FROM orders
        WHERE o_orderdate >= TIMESTAMP '1999-07-01'""",
    "i_insert_missing": """
        SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders""",
    "i_delete_matched": """
        WITH nb AS (SELECT user_id, ts FROM events ORDER BY ts, event_id LIMIT 30)
        SELECT e.event_id, e.user_id, e.ts, e.event_type FROM events e
        WHERE NOT EXISTS (SELECT 1 FROM nb WHERE nb.user_id = e.user_id AND nb.ts = e.ts)""",
    "x_topn": "SELECT event_id, user_id, ts FROM events ORDER BY ts, event_id LIMIT 30",
}

_MOVIES = """
    SELECT p_partkey AS Id, p_name AS Title, p_retailprice AS Price,
           (['en', 'fr', 'de', 'es'])[p_partkey % 4 + 1] AS OriginalLanguage,
           CASE WHEN p_partkey % 23 = 0 THEN NULL
                ELSE CAST(DATE '1990-01-01' + CAST(p_partkey % 9000 AS INTEGER) AS TIMESTAMP) END AS ReleaseDate,
           CAST(CASE WHEN p_partkey % 29 = 0 THEN NULL WHEN p_partkey % 31 = 0 THEN 0
                     WHEN p_partkey % 17 = 0 THEN -p_size ELSE p_size END AS BIGINT) AS RunTime
    FROM part"""
_BRONZE_ROWS = f"""
    SELECT * EXCLUDE (copy) FROM (
        SELECT *, unnest(CASE WHEN Id % 10 = 0 THEN [1, 2] ELSE [1] END) AS copy FROM ({_MOVIES}))"""
_RULE = "(Id IS NOT NULL AND ReleaseDate IS NOT NULL AND RunTime >= 0)"
_SILVER_COLS = ("Id, Title, OriginalLanguage, Price, ReleaseDate, RunTime, "
                "CAST(year(ReleaseDate) AS INTEGER) AS p_ReleaseYear")
_WORDS = """
    SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part"""

MEDALLION = {
    "m_bronze": f"SELECT Id, Title, 'New' AS Status, TIMESTAMP '2024-01-15 00:00:00' AS p_Ingestdate FROM ({_BRONZE_ROWS})",
    "m_silver_clean": f"SELECT {_SILVER_COLS} FROM ({_MOVIES}) WHERE {_RULE}",
    "m_quarantine": f"SELECT {_SILVER_COLS} FROM ({_MOVIES}) WHERE NOT coalesce({_RULE}, false)",
    "m_genres": f"""
        SELECT CAST(ascii(w) * 1000 + ascii(substr(w, 2, 1)) AS INTEGER) AS Genre_Id, min(w) AS Genre_Name
        FROM ({_WORDS}) GROUP BY 1""",
    "m_unroll_genres": f"""
        SELECT p_partkey AS Movie_Id, CAST(ascii(w) * 1000 + ascii(substr(w, 2, 1)) AS INTEGER) AS Genre_Id,
               w AS Genre_Name
        FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w
              FROM (SELECT p_partkey, p_name,
                           unnest(CASE WHEN p_partkey % 10 = 0 THEN [1, 2] ELSE [1] END) AS copy
                    FROM part))""",
    "m_genres_by_name": f"""
        SELECT row_number() OVER (ORDER BY w) AS Genre_Key, w AS Genre_Name
        FROM (SELECT DISTINCT w FROM ({_WORDS}))""",
    "m_junction": f"""
        SELECT DISTINCT p_partkey AS Movie_Id,
               CAST(ascii(w) * 1000 + ascii(substr(w, 2, 1)) AS INTEGER) AS Genre_Id FROM ({_WORDS})""",
    "m_languages": f"SELECT DISTINCT OriginalLanguage AS Language_Code, 'English' AS Language_Name FROM ({_MOVIES})",
    "m_bronze_status": f"""
        SELECT Id, CASE WHEN coalesce({_RULE}, false) THEN 'Loaded' ELSE 'Quarantined' END AS Status
        FROM ({_BRONZE_ROWS})""",
    "m_rerun": f"""
        SELECT Id, CASE WHEN coalesce({_RULE}, false) THEN 'Loaded' ELSE 'Quarantined' END AS Status,
               CASE WHEN coalesce({_RULE}, false) THEN 'silver' ELSE 'quarantine' END AS layer
        FROM ({_BRONZE_ROWS})""",
    "m_repair_by_action": f"""
        SELECT Id, Title, OriginalLanguage, Price, ReleaseDate, abs(RunTime) AS RunTime, CAST(year(ReleaseDate) AS INTEGER) AS p_ReleaseYear,
               CASE WHEN ReleaseDate IS NOT NULL AND RunTime IS NOT NULL THEN 'silver' ELSE 'quarantine' END AS layer
        FROM ({_MOVIES})""",
    "m_repaired": f"""
        SELECT Id, Title, OriginalLanguage, Price, ReleaseDate, abs(RunTime) AS RunTime,
               CAST(year(ReleaseDate) AS INTEGER) AS p_ReleaseYear
        FROM ({_MOVIES}) WHERE Id IS NOT NULL AND ReleaseDate IS NOT NULL AND RunTime IS NOT NULL""",
    "m_repaired_status": f"""
        SELECT Id, CASE WHEN Id IS NOT NULL AND ReleaseDate IS NOT NULL AND RunTime IS NOT NULL
                        THEN 'Loaded' ELSE 'Quarantined' END AS Status
        FROM ({_BRONZE_ROWS})""",
    "x_null_profile": """
        WITH m AS (""" + _BRONZE_ROWS + """)
        SELECT column_name, null_count, (SELECT count(*) FROM m) AS row_count FROM (
            SELECT 'Id' AS column_name, count(*) - count(Id) AS null_count FROM m
            UNION ALL SELECT 'Title', count(*) - count(Title) FROM m
            UNION ALL SELECT 'Overview', 0
            UNION ALL SELECT 'OriginalLanguage', count(*) - count(OriginalLanguage) FROM m
            UNION ALL SELECT 'Price', count(*) - count(Price) FROM m
            UNION ALL SELECT 'ReleaseDate', count(*) - count(ReleaseDate) FROM m
            UNION ALL SELECT 'Budget', 0
            UNION ALL SELECT 'Revenue', count(*) FROM m
            UNION ALL SELECT 'RunTime', count(*) - count(RunTime) FROM m
            UNION ALL SELECT 'Tagline', 0
            UNION ALL SELECT 'CreatedBy', count(*) FROM m
            UNION ALL SELECT 'CreatedDate', count(*) FROM m
            UNION ALL SELECT 'UpdatedBy', count(*) FROM m
            UNION ALL SELECT 'UpdatedDate', count(*) FROM m
            UNION ALL SELECT 'ImdbUrl', 0
            UNION ALL SELECT 'TmdbUrl', 0
            UNION ALL SELECT 'PosterUrl', count(*) FROM m
            UNION ALL SELECT 'BackdropUrl', count(*) FROM m)""",
}

WAREHOUSE = {
    "w_customer_dim": """
        WITH contact AS (
            SELECT s.s_nationkey, s.s_name FROM supplier s
            JOIN (SELECT s_nationkey, min(s_suppkey) AS k FROM supplier GROUP BY 1) m
              ON s.s_suppkey = m.k),
        head AS (SELECT c_nationkey, c_mktsegment, min(c_custkey) AS bill_to FROM customer GROUP BY 1, 2)
        SELECT c.c_custkey AS SourceCustomerID, c.c_name AS Customer, b.c_custkey AS BillToCustomerID,
               b.c_name AS BillToCustomer, c.c_mktsegment AS CustomerCategory,
               c.c_nationkey AS BuyingGroupID, ct.s_name AS PrimaryContact
        FROM customer c
        JOIN contact ct ON c.c_nationkey = ct.s_nationkey
        JOIN head h ON h.c_nationkey = c.c_nationkey AND h.c_mktsegment = c.c_mktsegment
        JOIN customer b ON b.c_custkey = h.bill_to""",
    "w_employee_dim": """
        SELECT s_suppkey AS SourceEmployeeID, s_name AS Employee, split_part(s_name, '#', 2) AS PreferredName,
               s_acctbal > 5000 AS IsSalesperson
        FROM supplier WHERE s_acctbal >= 0""",
    "w_stockitem_dim": """
        SELECT p_partkey AS SourceStockItemID, p_name AS StockItem, p_brand AS Brand,
               CAST(p_size AS VARCHAR) AS Size, p_type AS StockGroup,
               CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS UnitPrice FROM part""",
    "w_order_fact": """
        SELECT o.o_orderkey AS SourceOrderID, l.l_linenumber AS SourceOrderLineID, o.o_custkey AS CustomerKey,
               l.l_partkey AS StockItemKey, l.l_suppkey AS SalespersonKey,
               CAST(CAST(o.o_orderdate AS DATE) AS TIMESTAMP) AS OrderDate,
               CAST(CAST(l.l_shipdate AS DATE) AS TIMESTAMP) AS PickedDate,
               CAST(l.l_quantity AS BIGINT) AS Quantity,
               CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS TotalExcludingTax,
               l.l_tax AS TaxRate
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "w_sales": """
        SELECT o_orderkey AS SourceInvoiceID, o_custkey AS CustomerKey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS InvoiceDate,
               o_orderstatus AS InvoiceStatus, o_orderpriority AS Priority, o_totalprice AS TotalIncludingTax
        FROM orders""",
}

WAREHOUSE["w_pipeline"] = " UNION ALL BY NAME ".join(
    f"(SELECT '{sink}' AS sink, * FROM ({WAREHOUSE['w_' + name]}))" for sink, name in (
        ("customer_dim", "customer_dim"), ("employee_dim", "employee_dim"), ("stockitem_dim", "stockitem_dim"),
        ("order_fact", "order_fact"), ("sales", "sales")))

_PEOPLE = r"""
    SELECT
      CASE WHEN c_custkey % 4 = 0 THEN '  ' WHEN c_custkey % 4 = 1 THEN chr(9) ELSE '' END AS pad,
      c_custkey, c_mktsegment AS seg, n_name, c_nationkey, n_regionkey
    FROM customer JOIN nation ON c_nationkey = n_nationkey"""
_DIRTY = f"""
    SELECT pad || (CASE WHEN c_custkey % 3 = 0 THEN lower(seg) WHEN c_custkey % 3 = 1 THEN seg
                        ELSE lower(substr(seg, 1, 2)) || substr(seg, 3, 100) END) || pad AS FirstName,
           (CASE WHEN c_custkey % 2 = 0 THEN lower(n_name) ELSE n_name END) || pad AS LastName,
           CASE WHEN c_custkey % 11 = 0 THEN NULL
                ELSE pad || '555-' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '-'
                         || lpad(CAST(n_regionkey AS VARCHAR), 2, '0') END AS Phone,
           'No.' || CAST(c_nationkey AS VARCHAR) || ' #' || CAST(n_regionkey AS VARCHAR) || ' Rd ' AS Address
    FROM ({_PEOPLE})"""


def _strip(c):
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def _cap(c):
    return f"upper(substr({c}, 1, 1)) || lower(substr({c}, 2))"


MISC = {
    "m_split_chunks": """
        WITH n AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders),
        per AS (SELECT count(*) // 8 AS k FROM orders)
        SELECT o_orderkey, o_custkey, o_orderdate, CAST(CASE WHEN k > 0 THEN least(pos // k, 7) ELSE 7 END AS INTEGER) AS chunk
        FROM n, per""",
    "c_clean_text": f"""
        SELECT DISTINCT {_cap(_strip('FirstName'))} AS FirstName, {_cap(_strip('LastName'))} AS LastName,
               replace({_strip('Phone')}, '-', '') AS Phone,
               replace(replace({_strip('Address')}, 'No.', ''), '#', '') AS Address
        FROM ({_DIRTY})""",
    "k_surrogate_key": """
        SELECT row_number() OVER (ORDER BY p_name, p_partkey) AS sk, p_partkey, p_name FROM part""",
    "x_union_by_name": """
        SELECT c_name AS name, c_custkey AS id, 'customer' AS kind, c_mktsegment AS segment FROM customer
        UNION ALL SELECT s_name, s_suppkey, 'supplier', NULL FROM supplier""",
    "x_pk_check": """
        SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
        GROUP BY 1, 2 HAVING count(*) > 1""",
}

def _loop_part(name, key, time, text, amount, first):
    # rows after the first mark; those of the last 30 days were delivered again, edited
    return f"""
        SELECT '{name}' AS TABLE_NAME, {key} AS row_key, CAST({time} AS TIMESTAMP) AS row_time,
               {text} || CASE WHEN {time} > (SELECT max({time}) FROM {name}) - INTERVAL 30 DAY THEN '*' ELSE '' END AS row_text,
               CAST({amount} AS DOUBLE) AS amount
        FROM {name} WHERE {time} > least(TIMESTAMP '{first}', (SELECT max({time}) FROM {name}) - INTERVAL 30 DAY)"""


_TABLE_LOOP = " UNION ALL ".join([
    _loop_part("orders", "CAST(o_orderkey AS VARCHAR)", "o_orderdate", "o_orderstatus", "o_totalprice", "2000-06-30"),
    _loop_part("lineitem", "concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber)", "l_shipdate", "l_returnflag",
               "l_extendedprice", "2001-01-31"),
    _loop_part("events", "CAST(event_id AS VARCHAR)", "ts", "event_type", "value", "2024-01-20 12:00:00")])

PIPELINES = {
    "g07_config_loop": _TABLE_LOOP,
    "g03_upsert_compacted": _TABLE_LOOP,
    "g08_ods_to_parquet": """
        SELECT 'orders' AS table_name, o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS o_totalprice,
               CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS o_orderdate, o_orderpriority,
               NULL::BIGINT AS c_custkey, NULL::VARCHAR AS c_name, NULL::INTEGER AS c_nationkey, NULL::DOUBLE AS c_acctbal, NULL::VARCHAR AS c_mktsegment,
               NULL::BIGINT AS p_partkey, NULL::VARCHAR AS p_name, NULL::VARCHAR AS p_brand, NULL::VARCHAR AS p_type, NULL::INTEGER AS p_size,
               NULL::DOUBLE AS p_retailprice FROM orders
        UNION ALL SELECT 'customer', NULL, NULL, NULL, NULL, NULL, NULL, c_custkey, c_name, CAST(c_nationkey AS INTEGER),
               CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE), c_mktsegment, NULL, NULL, NULL, NULL, NULL, NULL FROM customer
        UNION ALL SELECT 'part', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, p_partkey, p_name, p_brand, p_type,
               CAST(p_size AS INTEGER), CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) FROM part""",
    "g05_retention_delete": """
        SELECT o_orderkey, o_orderdate, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders
        WHERE o_orderdate >= TIMESTAMP '1996-07-01'""",
    "g14_gdpr_delete": """
        SELECT o_orderkey, o_custkey FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
    "a13_activity_parts": """
        SELECT user_id AS name, ts AS time, event_id, CAST(day(ts) AS INTEGER) AS day,
               CAST(month(ts) AS INTEGER) AS month, CAST(hour(ts) AS INTEGER) AS hour
        FROM events""",
}

_RECORDS = """
    SELECT p_partkey AS Id, p_size * 1000.0 AS Budget, p_name, (['en', 'fr', 'de', 'es'])[p_partkey % 4 + 1] AS lang FROM part"""
_GENRE_KEYS = f"""
    SELECT row_number() OVER (ORDER BY late, Genre_Name, Genre_Id) AS Genre_Key, Genre_Name, Genre_Id FROM (
        SELECT w AS Genre_Name, CAST(ascii(w) * 1000 + ascii(substr(w, 2, 1)) AS INTEGER) AS Genre_Id, min(CASE WHEN Budget < 25000 THEN 0 ELSE 1 END) AS late
        FROM (SELECT Budget, unnest(string_split(p_name, ' ')) AS w FROM ({_RECORDS})) GROUP BY ALL)"""

EXCHANGE = {
    "b01_batch_writer": "SELECT c_custkey, c_name, c_mktsegment, CAST(c_nationkey AS INTEGER) AS c_nationkey FROM customer",
    "b02_lookup_writer": "SELECT * EXCLUDE (n_regionkey) FROM nation",
    "a05_read_by_path": "SELECT s_suppkey, s_name, s_acctbal, NULL::INTEGER AS s_rating FROM supplier",
    "a07_new_records": f"""
        SELECT Id, true AS stamped, true AS same_day
        FROM (SELECT Id, unnest(CASE WHEN Id % 10 = 0 THEN [1, 2] ELSE [1] END) AS copy FROM ({_RECORDS}) WHERE NOT coalesce(Budget < 25000, false))""",
    "a04_row_limit": f"SELECT Id FROM ({_BRONZE_ROWS})",
    "b15_views": RETAIL["q18_pivot_years"],
    "l04_preview": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
        ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 20""",
    "c03_duplicate_names": 'SELECT p_partkey AS "Key", p_name AS "Name", p_size AS "Size" FROM part',
    "c20_strict_split": f"SELECT Id, RunTime, CASE WHEN RunTime >= 0 THEN 'clean' ELSE 'quarantine' END AS branch FROM ({_BRONZE_ROWS}) WHERE RunTime IS NOT NULL",
    "d13_repair_by_lookup": """
        SELECT event_id, user_id, CAST(c_nationkey AS VARCHAR) AS device_id FROM events JOIN customer ON user_id = c_custkey""",
    "d11_ignore_spaces": """
        SELECT p_partkey, ' ' || substr(p_type, 1, 2) || ' ' || substr(p_type, 3) AS label, p_type, count(*) OVER (PARTITION BY p_type) AS n_items FROM part""",
    "e11_distinct_by_key": """
        SELECT l_partkey, l_suppkey, l_returnflag FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_suppkey, l_returnflag) = 1""",
    "l06_union_by_position": """
        SELECT p_partkey, unnest([p_size, p_size + 1])::INTEGER AS package_id, CAST(CAST(p_retailprice AS DECIMAL(10,1)) AS DOUBLE) AS price
        FROM part WHERE p_size % 2 = 0
        UNION ALL SELECT p_partkey, CAST(p_size AS INTEGER), CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) FROM part WHERE p_size % 2 <> 0""",
    "l01_q07_ordered": f"SELECT row_number() OVER (ORDER BY n_name NULLS FIRST) AS row_no, * FROM ({RETAIL['q07_avg_days']})",
    "l01_q08_ordered": f"SELECT row_number() OVER (ORDER BY n_name NULLS FIRST, month NULLS FIRST) AS row_no, * FROM ({RETAIL['q08_by_month']})",
    "l01_q19_ordered": f"SELECT row_number() OVER (ORDER BY year) AS row_no, * FROM ({RETAIL['q19_pivot_groups']})",
    "f25_json_document": f"SELECT row_number() OVER (ORDER BY o_orderkey) AS row_no, o_orderkey, o_custkey, total FROM ({RETAIL['q20_tvf_apply']})",
    "f26_xml_document": """
        SELECT row_no, CASE WHEN row_no = 1 THEN '<Years>' ELSE '' END || xml || CASE WHEN row_no = max(row_no) OVER () THEN '</Years>' ELSE '' END AS value
        FROM (SELECT row_number() OVER (ORDER BY year) AS row_no, '<StockItems Year="' || year || '">' || """ + " || ".join(
        f"coalesce('<{t.lower()}>' || {t.lower()} || '</{t.lower()}>', '')" for t in _TYPES) + f""" || '</StockItems>' AS xml FROM ({_PIVOT_GROUPS}))""",
    "b05_schema_drift": """
        SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' OR o_orderdate >= TIMESTAMP '1999-01-01' THEN o_orderstatus END AS o_orderstatus,
               CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1999-01-01' THEN CAST(CAST(o_totalprice AS DECIMAL(18,1)) AS DOUBLE)
                    ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) END AS o_totalprice,
               CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) ELSE o_orderdate END AS o_orderdate,
               CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1999-01-01' THEN o_orderpriority END AS o_orderpriority,
               CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN o_custkey END AS o_custkey
        FROM orders""",
    "m_genre_keys": _GENRE_KEYS,
    "m_language_keys": f"""
        SELECT row_number() OVER (ORDER BY late, Language_Code) AS Language_Key, Language_Code
        FROM (SELECT lang AS Language_Code, min(CASE WHEN Budget < 25000 THEN 0 ELSE 1 END) AS late FROM ({_RECORDS}) GROUP BY 1)""",
    "m_junction_keys": f"""
        SELECT DISTINCT Id AS Movie_Id, Genre_Key FROM (SELECT Id, unnest(string_split(p_name, ' ')) AS w FROM ({_RECORDS}))
        JOIN ({_GENRE_KEYS}) ON w = Genre_Name""",
}

STREAMING = {
    "s_new_only": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "s_drip_feed": "SELECT event_id, event_type, value FROM events",
}


def all_sql() -> dict[str, str]:
    out = {}
    for group in (RETAIL, INCREMENTAL, MEDALLION, WAREHOUSE, MISC, PIPELINES, EXCHANGE, STREAMING):
        out.update(group)
    return out
