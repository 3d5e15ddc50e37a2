"""Feeds derived from the star-schema test tables (FIXTURES.md), one SQL text for both engines.

Names in braces are tables or other views.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

#: The rows of a feed's third delivery that come as a fourth where two deliveries are folded onto a filled state.
LATER = {"daily": "SourceSystem < 'SRC2'", "weekly": "coalesce(Remarks, '') < 'm'", "multimarket": "coalesce(Remarks, '') < 'm'"}

VIEWS = {
    "fx_market": """
SELECT substr('ABCDEFGHIJKLMNOPQRSTUVWXY', n_nationkey + 1, 1) || 'X' AS code, n_name AS market
FROM {nation}""",
    "fx_region_market": """
SELECT substr('ABCDEFGHIJKLMNOPQRSTUVWXY', n.n_nationkey + 1, 1) || 'X' AS code, r.r_name AS market
FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey""",
    "fx_daily_raw": """
SELECT event_id AS row_no,
       CASE WHEN event_id % 50 = 0 THEN 'C' ELSE 'L' END AS Marker,
       replace(substr(CAST(ts AS STRING), 1, 10), '-', '') || '000000' AS DatumKPI,
       replace(substr(CAST(ts AS STRING), 1, 10), '-', '') || '235959' AS TimestampTo,
       'NATION_' || CAST(user_id % 25 AS STRING) AS Natco,
       'SRC' || CAST(event_id % 4 AS STRING) AS SourceSystem,
       CASE WHEN event_id % 2 = 0 THEN event_type ELSE ' ' || upper(event_type) || ' ' END AS KPINameDaily,
       CAST(user_id AS STRING) AS Denominator,
       CAST(event_id % 7 AS STRING) AS Numerator,
       CASE WHEN event_id % 97 = 0 THEN 'n/a' WHEN event_id % 89 = 0 THEN NULL
            ELSE replace(CAST(value AS STRING), '.', ',') END AS Value,
       event_id % 3 + 1 AS delivery_seq,
       'daily_' || CAST(event_id % 3 + 1 AS STRING) || '.csv' AS file_name
FROM {events}""",
    "fx_weekly_raw": """
SELECT o_orderkey AS row_no, r_name AS Region, o_orderpriority AS kpi_name,
       CASE o_orderkey % 3
         WHEN 0 THEN substr(d, 9, 2) || '.' || substr(d, 6, 2) || '.' || substr(d, 1, 4)
         WHEN 1 THEN substr(d, 9, 2) || '-' || substr('JanFebMarAprMayJunJulAugSepOctNovDec', 3 * CAST(substr(d, 6, 2) AS INT) - 2, 3) || '-' || substr(d, 3, 2)
         ELSE d || ' 00:00:00' END AS Date,
       CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE replace(CAST(o_totalprice AS STRING), '.', ',') END AS Value,
       CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'late' WHEN 2 THEN 'late delivery' ELSE 'ok' END AS Remarks,
       o_orderkey % 3 + 1 AS delivery_seq,
       'weekly_' || CAST(o_orderkey % 3 + 1 AS STRING) || '.csv' AS file_name
FROM (SELECT o.*, r.r_name, substr(CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS STRING), 1, 10) AS d
      FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
      JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey) t""",
    "fx_monthly_raw": """
SELECT o_orderkey AS row_no, code AS Region, o_orderpriority AS kpi_name,
       CASE WHEN o_orderkey % 2 = 0 THEN '01.' || substr(d, 6, 2) || '.' || substr(d, 1, 4)
            ELSE substr(d, 1, 8) || '01 00:00:00' END AS Date,
       CASE WHEN o_orderkey % 103 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS STRING) END AS Value,
       CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'late' ELSE 'ok' END AS Remarks,
       o_orderkey % 3 + 1 AS delivery_seq,
       'monthly_' || CAST(o_orderkey % 3 + 1 AS STRING) || '.csv' AS file_name
FROM (SELECT o.*, m.code, substr(CAST(o_orderdate AS STRING), 1, 10) AS d
      FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
      JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {fx_market} m ON m.market = n.n_name) t""",
    "fx_registry": """
SELECT KPI_ID, KPI_Name, 'unit' AS Unit, 'Vendor_' || substr(KPI_ID, 1, 1) AS Vendor,
       CASE WHEN KPI_ID = 'P5' THEN NULL ELSE 'Service_' || substr(KPI_ID, 1, 1) END AS Service,
       CASE WHEN KPI_ID = 'P4' THEN 'N' WHEN KPI_ID = 'P3' THEN 'y' ELSE 'Y' END AS PM_Report,
       CASE WHEN KPI_ID IN ('P1', 'P2') THEN 'yes' WHEN KPI_ID = 'P3' THEN 'no' END AS more,
       CASE WHEN KPI_ID < 'P' THEN 'x' END AS AX, CASE WHEN KPI_ID > 'P' THEN 'x' END AS AX_1, 'x' AS AX_2,
       CASE WHEN KPI_ID = 'CLICK' THEN 'x' END AS BX, CASE WHEN KPI_ID = 'P1' THEN 'x' END AS BX_1, CASE WHEN KPI_ID > 'P1' THEN 'x' END AS BX_2,
       'x' AS CX, CAST(NULL AS STRING) AS CX_1, CASE WHEN KPI_ID LIKE 'P%' THEN 'x' END AS CX_2
FROM (SELECT DISTINCT upper(event_type) AS KPI_ID, 'KPI ' || upper(event_type) AS KPI_Name FROM {events} WHERE event_type <> 'error'
      UNION ALL
      SELECT DISTINCT 'P' || substr(o_orderpriority, 1, 1), upper(o_orderpriority) FROM {orders}) t""",
    "fx_report_mapping": """
SELECT KPI_ID, CASE WHEN KPI_ID = 'P1' THEN NULL ELSE '250000' END AS Threshold,
       CASE WHEN KPI_ID = 'P2' THEN 'F' ELSE 'T' END AS Threshold_flag,
       'x' AS AX, CASE WHEN KPI_ID <> 'P3' THEN 'x' END AS BX, 'x' AS CX
FROM {fx_registry}""",
    "fx_ims_raw": """
SELECT CASE WHEN l_orderkey % 2 = 0 THEN substr(d, 9, 2) || '.' || substr(d, 6, 2) || '.' || substr(d, 1, 4)
            WHEN l_orderkey % 41 = 0 THEN NULL WHEN l_orderkey % 43 = 0 THEN replace(d, '-', '/') ELSE d || ' 00:00:00' END AS Date,
       '1-urgent' AS kpi_name, CAST(l_extendedprice AS STRING) AS Value,
       'NATION_' || CAST(l_suppkey % 25 AS STRING) AS Region
FROM (SELECT l.*, substr(CAST(l_shipdate AS STRING), 1, 10) AS d FROM {lineitem} l) t""",
    "fx_manifest": """
SELECT DISTINCT e.event_type || '_' || substr(CAST(ts AS STRING), 1, 10) || '.csv_' || lower(m.code) || '.csv' AS name
FROM {events} e JOIN {fx_market} m ON m.market = 'NATION_' || CAST(e.user_id % 25 AS STRING)
WHERE (CAST(substr(CAST(ts AS STRING), 9, 2) AS INT) + ascii(m.code) + length(e.event_type)) % 7 <> 0""",
}

GRID = ("AX", "AX_1", "AX_2", "BX", "BX_1", "BX_2", "CX", "CX_1", "CX_2")
COUNTRIES = ("AX", "BX", "CX")


def references(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    inputs = {
        r: table(spark, sf_dir, r) if r in TABLES else view(spark, sf_dir, r) for r in references(sql)
    }
    return spark.sql(sql, **inputs)
