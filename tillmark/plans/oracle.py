"""SQL for the queries of ``registry``, over the same tables.

The SQL is written from what each query must return, not from how it computes it: quarantine is NOT EXISTS, the
median is ``quantile_disc``, the dates of the fact come from a join.
"""

from __future__ import annotations

_RAW = """
WITH nation_codes AS (
  SELECT n_nationkey, n_name,
         CASE n_regionkey WHEN 0 THEN '22' WHEN 1 THEN '55' WHEN 2 THEN '33' WHEN 3 THEN '11'
                          WHEN 4 THEN '13' END || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code,
         CAST(n_regionkey + 1 AS VARCHAR) AS region
  FROM nation
),
raw_countries AS (
  SELECT code AS "CountryID", n_name AS "CountryName" FROM nation_codes
),
raw_transactions AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS "InvoiceNo",
         CAST(l_partkey AS VARCHAR) AS "StockCode",
         CASE WHEN o_orderkey % 40 <> 9 THEN CAST(l_quantity AS INTEGER) END AS "Quantity",
         CASE WHEN o_orderkey % 50 = 7 THEN strftime(o_orderdate, '%Y.%m.%d')
              ELSE strftime(o_orderdate, '%d/%m/%Y %H:%M') END AS "InvoiceDate",
         CAST(o_custkey AS VARCHAR) AS "CustomerID",
         CASE WHEN o_orderkey % 12 = 0 THEN '9999' ELSE code END
           || CASE WHEN o_orderkey % 25 = 3 THEN '' ELSE '-' || region END AS "Country"
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation_codes ON c_nationkey = n_nationkey
),
raw_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS "StockCode", p_name AS "ProductDescription",
         CASE WHEN l_partkey % 30 = 11 THEN 'n/a'
              ELSE CAST(TRY_CAST(p_retailprice AS DECIMAL(10, 2)) AS VARCHAR) END AS "UnitPrice",
         CASE WHEN l_partkey % 20 = 0 THEN strftime(o_orderdate, '%Y.%m.%d')
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS "Date"
  FROM (SELECT DISTINCT l_partkey, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS days
  JOIN part ON l_partkey = p_partkey
),
messages AS (
  SELECT p_partkey AS message_offset, p_name AS message FROM part
)"""

_BRONZE = (
    _RAW
    + """,
countries AS (
  SELECT "CountryID", "CountryName", TRY_CAST(substr("CountryID", 1, 2) AS INTEGER) AS "ContinentID",
         CASE TRY_CAST(substr("CountryID", 1, 2) AS INTEGER)
              WHEN 11 THEN 'Europe' WHEN 22 THEN 'Africa' WHEN 33 THEN 'Asia' WHEN 44 THEN 'Australia and Oceania'
              WHEN 55 THEN 'North America' WHEN 66 THEN 'South America' WHEN 13 THEN 'Europe/Asia'
              WHEN 10 THEN 'Europe/Worldwide' WHEN 50 THEN 'North America/Worldwide'
              ELSE 'Unknown' END AS "ContinentName"
  FROM raw_countries
),
products AS (
  SELECT "StockCode", "ProductDescription", TRY_CAST("UnitPrice" AS DECIMAL(10, 2)) AS "UnitPrice",
         CAST(try_strptime("Date", '%Y-%m-%d') AS DATE) AS "Date"
  FROM raw_products
),
parsed AS (
  SELECT *, try_strptime("InvoiceDate", '%d/%m/%Y %H:%M') AS "InvoiceTimestamp",
         split_part("Country", '-', 1) AS "CountryID", nullif(split_part("Country", '-', 2), '') AS "RegionID"
  FROM raw_transactions
),
valid AS (
  SELECT * FROM parsed WHERE "CountryID" IN (SELECT "CountryID" FROM countries)
),
quarantine AS (
  SELECT * FROM parsed
  WHERE NOT EXISTS (SELECT 1 FROM countries WHERE countries."CountryID" = parsed."CountryID")
)"""
)

_GOLD = (
    _BRONZE
    + """,
dim_date AS (
  SELECT full_date, CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_id,
         CAST(year(full_date) AS INTEGER) AS "year", CAST(month(full_date) AS INTEGER) AS "month",
         CAST(day(full_date) AS INTEGER) AS "day"
  FROM (SELECT DISTINCT CAST("InvoiceTimestamp" AS DATE) AS full_date FROM valid) AS days
),
dim_customers AS (
  SELECT DISTINCT "CustomerID", TRY_CAST("CustomerID" AS INTEGER) AS customer_id FROM valid
),
dim_products AS (
  SELECT DISTINCT "StockCode" AS product_id, "ProductDescription" AS description FROM products
),
dim_geography AS (
  SELECT DISTINCT "CountryID" AS geo_id, "CountryName" AS country, "ContinentName" AS continent FROM countries
),
fct_sales AS (
  SELECT t."InvoiceNo" || '-' || t."StockCode" AS sale_id, t."InvoiceNo" AS invoice_no, d.date_id,
         t."CustomerID" AS customer_id, t."StockCode" AS product_id, g.geo_id, t."Quantity" AS quantity,
         p."UnitPrice" AS unit_price, CAST(t."Quantity" * p."UnitPrice" AS DECIMAL(21, 2)) AS total_price
  FROM valid AS t
  JOIN products AS p ON t."StockCode" = p."StockCode" AND CAST(t."InvoiceTimestamp" AS DATE) = p."Date"
  LEFT JOIN dim_date AS d ON CAST(t."InvoiceTimestamp" AS DATE) = d.full_date
  LEFT JOIN dim_geography AS g ON t."CountryID" = g.geo_id
)"""
)

_QUALITY = (
    _GOLD
    + """,
stats AS (
  SELECT "StockCode", quantile_disc("Quantity", 0.5) AS median_quantity, stddev_samp("Quantity") AS stddev_quantity
  FROM valid GROUP BY "StockCode"
),
outliers AS (
  SELECT DISTINCT "CustomerID", "InvoiceNo", "StockCode", "Quantity", median_quantity
  FROM valid JOIN stats USING ("StockCode")
  WHERE "Quantity" > median_quantity + 2 * stddev_quantity
),
invalid_countries AS (
  SELECT "InvoiceNo", "StockCode", "Quantity", "CustomerID", "CountryID" FROM parsed
  WHERE NOT EXISTS (SELECT 1 FROM dim_geography WHERE geo_id = parsed."CountryID")
),
outlier_lines AS (
  SELECT 'User: ' || "CustomerID" || ', Invoice: ' || "InvoiceNo" || ', Product: ' || "StockCode"
         || ', Quantity: ' || CAST("Quantity" AS VARCHAR) || ', Median: ' || CAST(median_quantity AS VARCHAR) AS line
  FROM outliers
),
invalid_lines AS (
  SELECT concat_ws(',', "InvoiceNo", "StockCode", coalesce(CAST("Quantity" AS VARCHAR), ''), "CustomerID", "CountryID")
           AS line
  FROM invalid_countries
)"""
)

_TRENDS = (
    _RAW
    + """,
mentions AS (
  SELECT message AS "text",
         CASE WHEN contains(lower(message), 'gizmo') THEN 'gizmo' WHEN contains(lower(message), 'widget') THEN 'widget'
              WHEN contains(lower(message), 'ring') THEN 'ring' WHEN contains(lower(message), 'red') THEN 'red'
         END AS product_mention
  FROM messages
),
trending AS (
  SELECT product_mention, count(*) AS "count" FROM mentions WHERE product_mention IS NOT NULL
  GROUP BY product_mention ORDER BY "count" DESC, product_mention LIMIT 10
)"""
)

_RAW_COLUMNS = '"InvoiceNo", "StockCode", "Quantity", "InvoiceDate", "CustomerID", "Country"'
_PARSED_COLUMNS = _RAW_COLUMNS + ', "InvoiceTimestamp", "CountryID", "RegionID"'
_FACT = "SELECT * FROM fct_sales"
_CUSTOMER_SALES = 'SELECT customer_id, CAST(sum(total_price) AS DECIMAL(31, 2)) AS total_sales FROM fct_sales GROUP BY 1'


def _by(label: str, dimension: str, key: str) -> str:
    return (
        f"SELECT {label}, CAST(sum(total_price) AS DECIMAL(31, 2)) AS total_sales FROM fct_sales AS f "
        f"LEFT JOIN {dimension} AS d ON f.{key} = d.{key} GROUP BY {label}"
    )


def _counts(label: str, tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS {label}, count(*) AS row_count FROM {source}" for name, source in tables.items()
    )


_STAR_COUNTS = {
    "dim_date": "dim_date",
    "dim_customers": "dim_customers",
    "dim_products": "dim_products",
    "dim_geography": "dim_geography",
    "fct_sales": "fct_sales",
}

_MANIFEST = {
    "countries": (
        "countries",
        "struct<CountryID:string,CountryName:string,ContinentID:int,ContinentName:string>",
    ),
    "products": (
        "products",
        "struct<StockCode:string,ProductDescription:string,UnitPrice:decimal(10,2),Date:date>",
    ),
    "transactions": (
        "valid",
        "struct<InvoiceNo:string,StockCode:string,Quantity:int,InvoiceDate:string,CustomerID:string,Country:string,"
        "InvoiceTimestamp:timestamp,CountryID:string,RegionID:string>",
    ),
    "quarantine": (
        "quarantine",
        "struct<InvoiceNo:string,StockCode:string,Quantity:int,InvoiceDate:string,CustomerID:string,Country:string,"
        "InvoiceTimestamp:timestamp,CountryID:string,RegionID:string>",
    ),
}

_DIGEST = """
SELECT 'High-Value Orders' AS alert, count(*) AS row_count,
       CASE WHEN count(*) = 0 THEN 'No high-value order anomalies detected.'
            ELSE CAST(count(*) AS VARCHAR) || ' rows detected.' END AS message
FROM outliers
UNION ALL
SELECT 'Invalid CountryID Transactions', count(*),
       CASE WHEN count(*) = 0 THEN 'No invalid CountryID transactions detected.'
            ELSE CAST(count(*) AS VARCHAR) || ' rows detected.' END
FROM invalid_countries"""

_ALERT_LINES = """
SELECT 'High-Value Orders' AS alert, line FROM outlier_lines
UNION ALL SELECT 'High-Value Orders', 'No high-value order anomalies detected.'
  WHERE NOT EXISTS (SELECT 1 FROM outlier_lines)
UNION ALL SELECT 'Invalid CountryID Transactions', line FROM invalid_lines
UNION ALL SELECT 'Invalid CountryID Transactions', 'No invalid CountryID transactions detected.'
  WHERE NOT EXISTS (SELECT 1 FROM invalid_lines)"""

_REPORT_FILE_COLUMNS = (
    '"InvoiceNo", "StockCode", CAST("Quantity" AS VARCHAR) AS "Quantity", "CustomerID", "CountryID"'
)

ORACLE: dict[str, str] = {
    "raw_transactions_csv": f"{_RAW} SELECT {_RAW_COLUMNS} FROM raw_transactions",
    "raw_countries_csv": f'{_RAW} SELECT "CountryID", "CountryName" FROM raw_countries',
    "raw_products_csv": f'{_RAW} SELECT "StockCode", "ProductDescription", "UnitPrice", "Date" FROM raw_products',
    "layer_round_trip": f"{_BRONZE} SELECT * FROM products",
    "layer_append": f"{_BRONZE} SELECT {_PARSED_COLUMNS} FROM parsed",
    "message_log": f"{_RAW} SELECT 'part_names' AS topic, 0 AS \"partition\", message_offset AS \"offset\", message "
    "FROM messages",
    "transactions_parsed": f"{_BRONZE} SELECT {_PARSED_COLUMNS} FROM parsed",
    "countries_bronze": f"{_BRONZE} SELECT * FROM countries",
    "products_bronze": f"{_BRONZE} SELECT * FROM products",
    "transactions_valid": f"{_BRONZE} SELECT {_PARSED_COLUMNS} FROM valid",
    "transactions_quarantine": f"{_BRONZE} SELECT {_PARSED_COLUMNS} FROM quarantine",
    "transactions_tagged": f"""{_BRONZE}
SELECT "CountryID" IN (SELECT "CountryID" FROM countries) AS is_valid, "CountryID", count(*) AS row_count,
       CAST(sum("Quantity") AS BIGINT) AS quantity
FROM parsed GROUP BY 1, 2""",
    "dim_date": f"{_GOLD} SELECT * FROM dim_date",
    "dim_customers": f"{_GOLD} SELECT * FROM dim_customers",
    "dim_products": f"{_GOLD} SELECT * FROM dim_products",
    "dim_geography": f"{_GOLD} SELECT * FROM dim_geography",
    "fct_sales": f"{_GOLD} {_FACT}",
    "fct_sales_with_date_lookup": f"{_GOLD} {_FACT}",
    "unpriced_sales": f"""{_BRONZE}
SELECT "InvoiceNo", "StockCode", "Quantity", "InvoiceDate", "CustomerID" FROM valid
WHERE NOT EXISTS (SELECT 1 FROM products AS p
                  WHERE p."StockCode" = valid."StockCode" AND p."Date" = CAST(valid."InvoiceTimestamp" AS DATE))""",
    "repeated_sale_ids": f"{_GOLD} SELECT sale_id, count(*) AS row_count FROM fct_sales GROUP BY 1 HAVING count(*) > 1",
    "product_uniqueness": f"""{_GOLD}
SELECT count(*) AS product_count, count(*) FILTER (WHERE description_count > 1) AS ambiguous_count
FROM (SELECT product_id, count(*) AS description_count FROM dim_products GROUP BY 1) AS descriptions""",
    "layer_row_counts": f"{_GOLD} "
    + _counts("table_name", {"transactions": "valid", "countries": "countries", **_STAR_COUNTS}),
    "product_quantity_stats": f'{_QUALITY} SELECT "StockCode", median_quantity, '
    "round(stddev_quantity, 6) AS stddev_quantity FROM stats",
    "quantity_outliers": f"{_QUALITY} SELECT * FROM outliers",
    "outlier_report_lines": f"{_QUALITY} SELECT line FROM outlier_lines",
    "outlier_report_file": f"{_QUALITY} SELECT line FROM outlier_lines",
    "missing_country_refs": f"{_QUALITY} SELECT * FROM invalid_countries",
    "invalid_country_report_file": f"{_QUALITY} SELECT {_REPORT_FILE_COLUMNS} FROM invalid_countries",
    "alert_digest": f"{_QUALITY} {_DIGEST}",
    "alert_lines": f"{_QUALITY} {_ALERT_LINES}",
    "sales_by_day": f"{_GOLD} {_by('full_date', 'dim_date', 'date_id')}",
    "sales_by_product": f"{_GOLD} {_by('description', 'dim_products', 'product_id')}",
    "top_products": f"{_GOLD} {_by('description', 'dim_products', 'product_id')} "
    "ORDER BY total_sales DESC NULLS LAST, description LIMIT 5",
    "sales_by_country": f"{_GOLD} {_by('country', 'dim_geography', 'geo_id')}",
    "sales_by_customer": f"{_GOLD} {_CUSTOMER_SALES}",
    "top_customers": f"{_GOLD} {_CUSTOMER_SALES} ORDER BY total_sales DESC NULLS LAST, customer_id LIMIT 5",
    "product_mentions": f'{_TRENDS} SELECT "text", product_mention FROM mentions WHERE product_mention IS NOT NULL',
    "trending_products": f"{_TRENDS} SELECT * FROM trending",
    "dashboard_trends": f"{_TRENDS} SELECT * FROM trending",
    "trending_ledger": f"{_TRENDS} SELECT * FROM trending",
    "trend_offsets": f"{_RAW} SELECT 'part_names' AS topic, CAST(message_offset % 4 AS INTEGER) AS \"partition\", "
    'max(message_offset) + 1 AS next_offset FROM messages GROUP BY 2',
    "trending_streaming": f"{_TRENDS} SELECT * FROM trending",
    "ingest_incremental": f"{_BRONZE} SELECT {_PARSED_COLUMNS} FROM valid",
    "ingest_incremental_quarantine": f"{_BRONZE} SELECT {_PARSED_COLUMNS} FROM quarantine",
    "ingest_compacted": f"{_BRONZE} SELECT {_PARSED_COLUMNS} FROM valid",
    "ingest_quantity_stats": f'{_QUALITY} SELECT "StockCode", median_quantity, '
    "round(stddev_quantity, 6) AS stddev_quantity FROM stats",
    "ingest_replayed": f"""{_BRONZE}
SELECT {_PARSED_COLUMNS}, 'valid' AS quality FROM valid
UNION ALL SELECT {_PARSED_COLUMNS}, 'quarantine' FROM quarantine""",
    "backup_restored": f"""{_BRONZE}
SELECT {_PARSED_COLUMNS}, 'valid' AS quality FROM valid
UNION ALL SELECT {_PARSED_COLUMNS}, 'quarantine' FROM quarantine""",
    "daily_sales_incremental": f"{_GOLD} {_FACT}",
    "snapshot_manifest": f"{_BRONZE} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, '{ddl}' AS table_schema FROM {source}"
        for name, (source, ddl) in _MANIFEST.items()
    ),
    "daily_run_metrics": f"{_QUALITY} "
    + _counts(
        "metric",
        {
            "countries": "countries",
            "products": "products",
            "ingest_valid": "valid",
            "ingest_quarantine": "quarantine",
            **_STAR_COUNTS,
            "outliers": "outliers",
            "invalid_countries": '(SELECT * FROM valid WHERE "CountryID" NOT IN (SELECT geo_id FROM dim_geography))',
        },
    ),
    "kept_metrics": f"{_BRONZE} "
    + " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{metric}' AS metric, COUNT(*) FILTER ({test}) AS value, 3::BIGINT AS runs FROM {source}"
        for table, source, tests in (
            (
                "transactions",
                "parsed",
                {
                    "unreadable_dates": '"InvoiceTimestamp" IS NULL',
                    "unreadable_quantities": '"Quantity" IS NULL',
                    "missing_products": '"StockCode" IS NULL',
                    "missing_customers": '"CustomerID" IS NULL',
                    "missing_countries": '"CountryID" IS NULL',
                },
            ),
            (
                "products",
                "products",
                {
                    "unreadable_prices": '"UnitPrice" IS NULL',
                    "unreadable_dates": '"Date" IS NULL',
                    "missing_products": '"StockCode" IS NULL',
                },
            ),
            (
                "countries",
                "countries",
                {"missing_countries": '"CountryID" IS NULL', "unknown_continents": '"ContinentID" IS NULL'},
            ),
        )
        for metric, test in {"row_count": "TRUE", **tests}.items()
    ),
    "daily_run_sales": f"{_GOLD} {_FACT}",
}
