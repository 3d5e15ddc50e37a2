"""The registered queries once more as plain SQL for a second engine, written row by row from the
business rules and sharing nothing with the operators but the input views."""

from __future__ import annotations

from kpiweave.plans.views import COUNTRIES, GRID, LATER, TABLES, VIEWS, references

NUMBER = (
    r"(?i)^[+-]?(inf(inity)?|nan|(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?)$"
)


def _number(v: str) -> str:
    dotted = f"trim(replace({v}, ',', '.'))"
    return f"CASE WHEN regexp_matches({dotted}, '{NUMBER}') THEN TRY_CAST(replace({dotted}, '_', '') AS DOUBLE) END"


def _is_number(v: str) -> str:
    return f"coalesce(regexp_matches(trim(replace({v}, ',', '.')), '{NUMBER}'), false)"


def _period_date(v: str) -> str:
    head = f"split_part({v}, ' ', 1)"
    return (
        f"CASE WHEN regexp_matches({head}, '^\\d{{2}}\\.\\d{{2}}\\.\\d{{4}}$') THEN TRY_STRPTIME({head}, '%d.%m.%Y')"
        f" WHEN regexp_matches({head}, '^\\d{{2}}-\\w{{3}}-\\d{{2}}$') THEN TRY_STRPTIME({head}, '%d-%b-%y')"
        f" ELSE TRY_STRPTIME({head}, '%Y-%m-%d') END"
    )


_STAMP = "'2024-02-0' || CAST(delivery_seq AS VARCHAR) || '-07:05:00'"

CTES = dict(VIEWS)


def _period_norm(view: str, suffix: str, region: str = "Region", join: str = "") -> str:
    return f"""
SELECT {region} || '-' || upper(trim(kpi_name)) || '-' || strftime(d, '%d.%m.%Y') || '-{suffix}' AS Input_ID,
       strftime(d, '%d.%m.%Y') AS "Date", upper(trim(kpi_name)) AS "KPI name", {region} AS Region, v AS "Value",
       Remarks, file_name AS Input_File, {_STAMP} AS Input_File_Time, delivery_seq AS delivery
FROM (SELECT r.*, {_number('r."Value"')} AS v, {_period_date('r."Date"')} AS d FROM {{{view}}} r) t {join}
WHERE v IS NOT NULL AND d IS NOT NULL AND kpi_name IS NOT NULL"""


CTES["comment"] = """
SELECT file_name AS Input_File, delivery_seq AS delivery, arg_min(DatumKPI, row_no) AS CommentFileNew
FROM {fx_daily_raw} WHERE Marker = 'C' GROUP BY 1, 2"""

CTES["daily"] = f"""
SELECT Natco || '-' || upper(trim(KPINameDaily)) || '-' || strftime(d, '%d.%m.%Y') || '-d' AS Input_ID,
       strftime(d, '%d.%m.%Y') AS "Date", TimestampTo, Natco AS Region, SourceSystem,
       upper(trim(KPINameDaily)) AS KPI_ID, Denominator, Numerator, v AS "Value",
       file_name AS Input_File, {_STAMP} AS Input_File_Time, delivery_seq AS delivery,
       coalesce(c.CommentFileNew, 'null') AS CommentFileNew
FROM (SELECT r.*, {_number('r."Value"')} AS v, TRY_STRPTIME(r.DatumKPI, '%Y%m%d%H%M%S') AS d
      FROM {{fx_daily_raw}} r WHERE r.Marker = 'L') t
LEFT JOIN {{comment}} c ON c.Input_File = t.file_name AND c.delivery = t.delivery_seq
WHERE v IS NOT NULL AND d IS NOT NULL"""

CTES["weekly"] = _period_norm("fx_weekly_raw", "w")
CTES["monthly"] = _period_norm("fx_monthly_raw", "m")
CTES["multimarket"] = _period_norm("fx_monthly_raw", "m", "m.market", "JOIN {fx_market} m ON m.code = t.Region")
CTES["ims"] = f"""
SELECT strftime(d, '%d.%m.%Y') AS "Date", upper(kpi_name) AS "KPI name", "Value", Region,
       Region || upper(kpi_name) || '-' || strftime(d, '%d.%m.%Y') AS Input_ID
FROM (SELECT r.*, {_period_date('r."Date"')} AS d FROM {{fx_ims_raw}} r WHERE r."Date" IS NOT NULL AND r."Date" <> '') t
WHERE d IS NOT NULL"""

# --- one delivery (the third) against the first two side by side, and all three in order ----------

_CHANGED = {"daily": "n.\"Value\" IS DISTINCT FROM o.old", "remark": (
    "n.\"Value\" IS DISTINCT FROM o.old OR NOT contains(coalesce(r.Remarks, 'nan'), coalesce(n.Remarks, 'nan'))"
)}

_LOG_COLUMNS = """n.Input_ID AS Key_Corr, n."Date" AS DatumKPI, n.{kpi} AS KPINameQVD, n.Region AS Natco,
       o.old AS KPIValueOld, n."Value" AS KPIValueNew, {comments}, n.Input_File_Time AS TimestampCorrFile,
       '{code}' AS Granularity, r.Input_File AS FileOld, n.Input_File AS FileNew,
       CAST(0 AS DOUBLE) AS correction_timestamp"""

_ROW_COMMENTS = """r.Remarks AS CommentRowOld, n.Remarks AS CommentRowNew,
       CAST(NULL AS VARCHAR) AS CommentFileOld, CAST(NULL AS VARCHAR) AS CommentFileNew"""


def _file_comments(old: str) -> str:
    return f"""CAST(NULL AS VARCHAR) AS CommentRowOld, CAST(NULL AS VARCHAR) AS CommentRowNew,
       {old} AS CommentFileOld, n.CommentFileNew"""


for feed, code in (("daily", "D"), ("weekly", "W"), ("monthly", "M"), ("multimarket", "M")):
    daily = feed == "daily"
    kpi = "KPI_ID" if daily else '"KPI name"'
    changed = _CHANGED["daily" if daily else "remark"]
    output = (
        "Input_ID, \"Date\", TimestampTo, Region, SourceSystem, KPI_ID, Denominator, Numerator, \"Value\", Input_File"
        if daily else 'Input_ID, "Date", "KPI name", Region, "Value", Remarks, Input_File'
    )
    old_tuple = "Input_File" if daily else "Input_File, Remarks"
    CTES[f"{feed}_log"] = f"""
SELECT {_LOG_COLUMNS.format(kpi=kpi, code=code, comments=_file_comments('CAST(NULL AS VARCHAR)') if daily else _ROW_COMMENTS)}
FROM {{{feed}}} n
JOIN (SELECT Input_ID, max("Value") AS old FROM {{{feed}}} WHERE delivery < 3 GROUP BY 1) o ON o.Input_ID = n.Input_ID
LEFT JOIN (SELECT DISTINCT Input_ID, {old_tuple} FROM {{{feed}}} WHERE delivery < 3) r ON r.Input_ID = n.Input_ID
WHERE n.delivery = 3 AND ({changed})"""
    CTES[f"{feed}_out"] = f"""
SELECT {output}, CASE WHEN Input_ID IN (SELECT Key_Corr FROM {{{feed}_log}}) THEN 'Correction' END AS was_corrected_Flag
FROM {{{feed}}} WHERE delivery = 3
UNION ALL
SELECT {output}, NULL FROM {{{feed}}}
WHERE delivery < 3 AND Input_ID NOT IN (SELECT Input_ID FROM {{{feed}}} WHERE delivery = 3)"""
    CTES[f"{feed}_prev"] = f"""
SELECT Input_ID, delivery, lag(v) OVER w AS old, lag(delivery) OVER w AS previous
FROM (SELECT Input_ID, delivery, max("Value") AS v FROM {{{feed}}} GROUP BY 1, 2) t
WINDOW w AS (PARTITION BY Input_ID ORDER BY delivery)"""
    raw_log = f"""
SELECT {_LOG_COLUMNS.format(kpi=kpi, code=code, comments=_file_comments("'?'") if daily else _ROW_COMMENTS)}, n.delivery
FROM {{{feed}}} n
JOIN {{{feed}_prev}} o ON o.Input_ID = n.Input_ID AND o.delivery = n.delivery
LEFT JOIN (SELECT DISTINCT Input_ID, delivery, {old_tuple} FROM {{{feed}}}) r ON r.Input_ID = o.Input_ID AND r.delivery = o.previous
WHERE o.old IS NOT NULL AND ({changed})"""
    CTES[f"{feed}_fold_rows"] = raw_log
    if daily:
        CTES["daily_fold_log"] = """
SELECT l.* EXCLUDE (delivery, CommentFileOld),
       (SELECT max(e.CommentFileNew) FROM {daily_fold_rows} e
        WHERE e.Key_Corr = l.Key_Corr AND e.delivery < l.delivery) AS CommentFileOld
FROM {daily_fold_rows} l"""
    else:
        CTES[f"{feed}_fold_log"] = f"SELECT * EXCLUDE (delivery) FROM {{{feed}_fold_rows}}"
    CTES[f"{feed}_fold_out"] = f"""
SELECT {output}, CASE WHEN Input_ID IN (SELECT Key_Corr FROM {{{feed}_fold_rows}}) THEN 'Correction' END AS was_corrected_Flag
FROM (SELECT *, rank() OVER (PARTITION BY Input_ID ORDER BY delivery DESC) AS rk FROM {{{feed}}}) t WHERE rk = 1"""

# the third delivery as two, folded onto what the first two leave: the same as all four in order
for feed, later in LATER.items():
    CTES[f"{feed}4"] = f"SELECT * REPLACE (CASE WHEN delivery = 3 AND {later} THEN 4 ELSE delivery END AS delivery) FROM {{{feed}}}"
    for part in ("prev", "fold_rows", "fold_log", "fold_out"):
        CTES[f"{feed}4_{part}"] = CTES[f"{feed}_{part}"].replace(f"{{{feed}", f"{{{feed}4")

# --- roll-ups ------------------------------------------------------------------------------------


def _averages(source: str, grain: str, suffix: str, where: str = "") -> str:
    return f"""
SELECT Region || '-' || name || '-' || strftime(p, '%d.%m.%Y') || '-{suffix}' AS Input_ID,
       strftime(p, '%d.%m.%Y') AS "Date", name AS "KPI name", Region, avg(v) AS "Value", '' AS Remarks,
       'calculation' AS Input_File, CASE WHEN min(flag) = 'Correction' THEN 'Correction(s)' ELSE '' END AS was_corrected_Flag
FROM (SELECT s.Region, s."Value" AS v, coalesce(s.flag0, '') AS flag,
             date_trunc('{grain}', strptime(s."Date", '%d.%m.%Y')) AS p,
             coalesce(k.KPI_Name, '*nonamefor_' || upper(s.KPI_ID)) AS name
      FROM (SELECT * FROM {source} {where}) s
      LEFT JOIN (SELECT DISTINCT upper(trim(KPI_ID)) AS KPI_ID, upper(trim(KPI_Name)) AS KPI_Name FROM {{fx_registry}}) k
        ON k.KPI_ID = upper(s.KPI_ID)) t
GROUP BY Region, name, p"""


CTES["daily_flagged"] = 'SELECT Region, "Date", KPI_ID, "Value", was_corrected_Flag AS flag0 FROM {daily_fold_out}'
CTES["daily_plain"] = 'SELECT Region, "Date", KPI_ID, "Value", delivery, CAST(NULL AS VARCHAR) AS flag0 FROM {daily}'

_PERIOD_COLUMNS = 'Input_ID, "Date", "KPI name", Region, "Value", Remarks, Input_File'
for grain, unit, suffix in (("weekly", "week", "w"), ("monthly", "month", "m")):
    CTES[f"{grain}_avg"] = _averages("{daily_flagged}", unit, suffix)
    CTES[f"{grain}_avg_before"] = _averages("{daily_plain}", unit, suffix, "WHERE delivery < 3")
    CTES[f"{grain}_avg_plain"] = _averages("{daily_plain}", unit, suffix)
    CTES[f"{grain}_before"] = f"""
SELECT {_PERIOD_COLUMNS}, CAST(NULL AS VARCHAR) AS was_corrected_Flag FROM {{{grain}}}
UNION ALL
SELECT * REPLACE (CASE WHEN "KPI name" = 'KPI CLICK' THEN 'delivered.csv' ELSE Input_File END AS Input_File)
FROM {{{grain}_avg_before}}"""
    CTES[f"{grain}_merged"] = f"""
SELECT * FROM {{{grain}_avg}} a
WHERE NOT EXISTS (SELECT 1 FROM {{{grain}_before}} b WHERE b.Input_ID = a.Input_ID AND b.Input_File IS DISTINCT FROM 'calculation')
UNION ALL
SELECT * FROM {{{grain}_before}} b
WHERE NOT EXISTS (SELECT 1 FROM {{{grain}_avg}} a WHERE a.Input_ID = b.Input_ID
                  AND NOT EXISTS (SELECT 1 FROM {{{grain}_before}} d WHERE d.Input_ID = a.Input_ID
                                  AND d.Input_File IS DISTINCT FROM 'calculation'))"""

# --- registry, calendar, matrix -----------------------------------------------------------------

_CELLS = " UNION ALL ".join(
    f"SELECT KPI_ID, KPI_Name, '{c}' AS cell, {c} AS req FROM {{fx_registry}}" for c in GRID
)
CTES["cells"] = f"""
SELECT trim(KPI_ID) AS KPI_ID, trim(KPI_Name) AS KPI_Name, left(cell, 2) AS Natco,
       CASE WHEN req IS NOT NULL AND NOT contains(cell, '1') AND NOT contains(cell, '2') THEN 1 ELSE 0 END AS requested_Daily,
       CASE WHEN req IS NOT NULL AND contains(cell, '1') THEN 1 ELSE 0 END AS requested_Weekly,
       CASE WHEN req IS NOT NULL AND NOT contains(cell, '1') AND contains(cell, '2') THEN 1 ELSE 0 END AS requested_Monthly
FROM ({_CELLS}) t
WHERE KPI_ID <> '' AND coalesce(KPI_Name, 'x') <> ''"""

CTES["flags"] = """
SELECT KPI_ID, KPI_Name, Natco, max(requested_Daily) AS requested_Daily, max(requested_Weekly) AS requested_Weekly,
       max(requested_Monthly) AS requested_Monthly FROM {cells} GROUP BY ALL"""


def _calendar(bounds: str, iso: bool = True) -> str:
    week_year = (
        "CAST(isoyear(d) AS VARCHAR)" if iso
        else "CAST(year(d) - CASE WHEN month(d) = 12 THEN 1 ELSE 0 END AS VARCHAR)"
    )
    return f"""
SELECT CAST(d AS DATE) AS "Date", strftime(d, '%Y%m%d') AS normDate, CAST(weekofyear(d) AS INTEGER) AS Week,
       CAST(month(d) AS INTEGER) AS Month, CAST(year(d) AS INTEGER) AS Year, CAST(day(d) AS INTEGER) AS Day,
       strftime(d, '%Y%m') AS YearMonth, 'Q' || CAST(quarter(d) AS VARCHAR) AS Quarter,
       {week_year} || '-cw' || CAST(weekofyear(d) AS VARCHAR) AS YearWeek,
       CAST(isodow(d) - 1 AS INTEGER) AS WeekDay,
       CASE WHEN year(d) = year(as_of) THEN 1 ELSE 0 END AS CurYTDFlag,
       CASE WHEN year(d - INTERVAL 1 DAY) = year(as_of) THEN 1 ELSE 0 END AS LastYTDFlag,
       year(d) = year(as_of) - 1 AS RC12
FROM (SELECT as_of, unnest(generate_series(lo, as_of - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM ({bounds}) b) t"""


CTES["calendar"] = _calendar(
    "SELECT min(x) AS lo, max(x) + INTERVAL 1 DAY AS as_of FROM "
    "(SELECT strptime(DatumKPI, '%Y%m%d%H%M%S') AS x FROM {fx_daily_raw}) y"
)
CTES["calendar_literal"] = _calendar(
    f"SELECT min(x) AS lo, max(x) AS as_of FROM (SELECT {_period_date('\"Date\"')} AS x FROM {{fx_monthly_raw}}) y", iso=False
)
CTES["matrix_days"] = _calendar("SELECT TIMESTAMP '2024-01-01' AS lo, TIMESTAMP '2024-02-05' AS as_of")
CTES["matrix_days_literal"] = _calendar("SELECT TIMESTAMP '2024-01-01' AS lo, TIMESTAMP '2024-02-05' AS as_of", iso=False)
CTES["matrix_months"] = _calendar("SELECT TIMESTAMP '1994-12-26' AS lo, TIMESTAMP '2001-08-15' AS as_of")


def _grid(days: str, kpi: str, requested: str, suffix: str, extra: str = "", where: str = "true") -> str:
    return f"""
SELECT g.Natco, g.KPI_ID, g.KPI_Name, g.{requested}, c."Date", {extra}
       m.market || '-' || upper(g.{kpi}) || '-' || strftime(c."Date", '%d.%m.%Y') || '-{suffix}' AS KEY1
FROM {{flags}} g JOIN {{fx_market}} m ON m.code = g.Natco CROSS JOIN (SELECT * FROM {days} WHERE {where}) c"""


def _lookups(source: str, attributes: tuple[str, ...], value: str = 'max("Value")', product: bool = False) -> str:
    if not product:
        return f"""
SELECT * FROM (WITH s AS (SELECT *, "Date" AS "Time" FROM {source})
SELECT v.Input_ID, v.KPI_Value, CASE WHEN v.KPI_Value IS NULL THEN '0' ELSE '1' END AS IsDelivered, {", ".join(attributes)}
FROM (SELECT Input_ID, {value} AS KPI_Value FROM s GROUP BY 1) v
JOIN (SELECT DISTINCT Input_ID, {", ".join(attributes)} FROM s) a ON a.Input_ID = v.Input_ID) q"""
    selected = ", ".join(f"a{i}.x{i} AS {a}" for i, a in enumerate(attributes))
    joins = "\n".join(
        f"JOIN (SELECT DISTINCT Input_ID, {a} AS x{i} FROM s) a{i} ON a{i}.Input_ID = v.Input_ID"
        for i, a in enumerate(attributes)
    )
    return f"""
SELECT * FROM (WITH s AS (SELECT *, "Date" AS "Time" FROM {source})
SELECT v.Input_ID, v.KPI_Value, CASE WHEN v.KPI_Value IS NULL THEN '0' ELSE '1' END AS IsDelivered, {selected}
FROM (SELECT Input_ID, {value} AS KPI_Value FROM s GROUP BY 1) v
{joins}) q"""


_DAILY_ATTRIBUTES = ('"Time"', "Input_File", "was_corrected_Flag", "Denominator", "Numerator", "SourceSystem")
_PERIOD_ATTRIBUTES = ('"Time"', "Input_File", "was_corrected_Flag", "Remarks")
_CALENDAR_EXTRA = "c.normDate, c.Week, c.Year, c.Month, c.Day, c.YearMonth, c.Quarter, c.YearWeek, c.WeekDay,"

CTES["grid_d"] = _grid("{matrix_days}", "KPI_ID", "requested_Daily", "d", _CALENDAR_EXTRA)
CTES["grid_d_literal"] = _grid("{matrix_days_literal}", "KPI_ID", "requested_Daily", "d", _CALENDAR_EXTRA)
CTES["grid_w"] = _grid("{matrix_days}", "KPI_Name", "requested_Weekly", "w", where="WeekDay = 0")
CTES["grid_m"] = _grid("{matrix_months}", "KPI_Name", "requested_Monthly", "m", where="Day = 1")
CTES["state_d"] = "SELECT *, CAST(NULL AS VARCHAR) AS was_corrected_Flag FROM {daily} WHERE Input_ID IN (SELECT KEY1 FROM {grid_d})"
CTES["weekly_table"] = f"""
SELECT * FROM {{weekly_avg_plain}}
UNION ALL SELECT {_PERIOD_COLUMNS}, CAST(NULL AS VARCHAR) FROM {{weekly}}"""
CTES["state_w"] = "SELECT * FROM {weekly_table} WHERE Input_ID IN (SELECT KEY1 FROM {grid_w})"
CTES["state_m"] = "SELECT *, CAST(NULL AS VARCHAR) AS was_corrected_Flag FROM {multimarket} WHERE Input_ID IN (SELECT KEY1 FROM {grid_m})"
CTES["look_d"] = _lookups("{state_d}", _DAILY_ATTRIBUTES)
CTES["look_d_literal"] = _lookups("{state_d}", _DAILY_ATTRIBUTES, 'arg_max("Value", CAST("Value" AS VARCHAR))', product=True)
CTES["look_w"] = _lookups("{state_w}", _PERIOD_ATTRIBUTES)
CTES["look_m"] = _lookups("{state_m}", _PERIOD_ATTRIBUTES)

_MATRIX_D = """
SELECT g.*, l.KPI_Value, l."Time", {delivered} AS IsDelivered, l.Input_File, l.SourceSystem, {denominator} AS Denominator,
       l.Numerator, l.was_corrected_Flag
FROM {{{grid}}} g LEFT JOIN {{{look}}} l ON l.Input_ID = g.KEY1"""
CTES["matrix_d"] = _MATRIX_D.format(
    grid="grid_d", look="look_d", delivered="coalesce(l.IsDelivered, '0')", denominator="coalesce(l.Denominator, '0')"
)
CTES["matrix_d_literal"] = _MATRIX_D.format(
    grid="grid_d_literal", look="look_d_literal", delivered="l.IsDelivered", denominator="l.Denominator"
)
for g in "wm":
    value = "round(l.KPI_Value + 0.0000001, 4)" if g == "w" else "l.KPI_Value"
    CTES[f"matrix_{g}"] = f"""
SELECT g.*, {value} AS KPI_Value, coalesce(l.IsDelivered, '0') AS IsDelivered, l."Time", l.Input_File, l.Remarks,
       l.was_corrected_Flag
FROM {{grid_{g}}} g LEFT JOIN {{look_{g}}} l ON l.Input_ID = g.KEY1"""

CTES["grid_wd"] = _grid("{matrix_months}", "KPI_Name", "requested_Weekly", "w", where="WeekDay = 0").replace("{fx_market}", "{fx_region_market}")
CTES["state_wd"] = "SELECT * FROM {weekly_table} WHERE Input_ID IN (SELECT KEY1 FROM {grid_wd})"
CTES["look_wd"] = _lookups("{state_wd}", _PERIOD_ATTRIBUTES)
CTES["matrix_wd"] = CTES["matrix_w"].replace("{grid_w}", "{grid_wd}").replace("{look_w}", "{look_wd}")

_OUTER_ATTRIBUTES = ("KPI_Value", "IsDelivered", *_PERIOD_ATTRIBUTES)
_OUTER_JOINS = "\n".join(
    f"JOIN (SELECT DISTINCT Input_ID, {a} AS x{i} FROM s) a{i} ON a{i}.Input_ID = v.Input_ID"
    for i, a in enumerate(_OUTER_ATTRIBUTES)
)
CTES["look_outer"] = f"""
SELECT DISTINCT Input_ID, {", ".join(_OUTER_ATTRIBUTES)}
FROM (SELECT *, "Date" AS "Time", "Value" AS KPI_Value, CASE WHEN "Value" IS NULL THEN 0 ELSE 1 END AS IsDelivered
      FROM {{weekly_table}}) s"""
CTES["look_outer_literal"] = f"""
SELECT * FROM (WITH s AS (SELECT *, "Date" AS "Time", "Value" AS KPI_Value, CASE WHEN "Value" IS NULL THEN 0 ELSE 1 END AS IsDelivered
                          FROM {{weekly_table}})
SELECT v.Input_ID, {", ".join(f"a{i}.x{i} AS {a}" for i, a in enumerate(_OUTER_ATTRIBUTES))}
FROM (SELECT DISTINCT Input_ID FROM s) v
{_OUTER_JOINS}) q"""

# --- deliveries ----------------------------------------------------------------------------------

_NAME = r"'^(\w+)_(\d+-\d+-\d+)\.csv_(\w+)\.csv$'"
CTES["parsed"] = f"""
SELECT name, regexp_extract(name, {_NAME}, 1) AS file_type,
       CAST(TRY_STRPTIME(regexp_extract(name, {_NAME}, 2), '%Y-%m-%d') AS DATE) AS delivery_date,
       regexp_extract(name, {_NAME}, 3) AS market
FROM {{fx_manifest}} WHERE regexp_matches(name, {_NAME})"""
CTES["expected"] = """
SELECT lower(m.code) AS market, m.code < 'HX' AS stable, t.file_type, CAST(d.day AS DATE) AS delivery_date
FROM {fx_market} m CROSS JOIN (VALUES ('click'), ('view'), ('purchase')) t(file_type)
CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-03', INTERVAL 1 DAY)) AS day) d"""
CTES["missing"] = """
SELECT e.*, CASE WHEN e.stable THEN 'report' ELSE 'placeholder' END AS action FROM {expected} e
WHERE NOT EXISTS (SELECT 1 FROM {parsed} p WHERE p.market = e.market AND p.file_type = e.file_type
                  AND p.delivery_date = e.delivery_date)"""
CTES["counts"] = """
SELECT market, delivery_date, count(*) AS files, min(name) AS first_file FROM {parsed}
WHERE file_type IN ('click', 'view', 'purchase') GROUP BY 1, 2"""

_STATUS = """
SELECT m.Natco,
       CASE WHEN m.requested_Monthly <> 1 THEN 'Not requested' WHEN m.IsDelivered <> '1' THEN 'MISSING'
            WHEN t.Threshold IS NULL OR t.Threshold = '' OR k.more IS NULL OR k.more NOT IN ('yes', 'no') THEN 'OK'
            WHEN k.more = 'yes' AND CAST(t.Threshold AS DOUBLE) <= m.KPI_Value THEN 'OK'
            WHEN k.more = 'no' AND CAST(t.Threshold AS DOUBLE) >= m.KPI_Value THEN 'OK'
            ELSE 'SLA Breach' END AS "Last Month Status",
       m.KPI_Name, m.KPI_Value AS "2001-Jul", b."2001-Jun", c."2001-May", k.Unit, t.Threshold
FROM {matrix_m} m
LEFT JOIN (SELECT DISTINCT Natco, KPI_ID, KPI_Value AS "2001-Jun" FROM {matrix_m} WHERE "Date" = DATE '2001-06-01') b
  ON b.Natco = m.Natco AND b.KPI_ID = m.KPI_ID
LEFT JOIN (SELECT DISTINCT Natco, KPI_ID, KPI_Value AS "2001-May" FROM {matrix_m} WHERE "Date" = DATE '2001-05-01') c
  ON c.Natco = m.Natco AND c.KPI_ID = m.KPI_ID
LEFT JOIN (SELECT trim(KPI_ID) AS KPI_ID, Unit, more FROM {fx_registry}) k ON k.KPI_ID = m.KPI_ID
LEFT JOIN {thresholds} t ON t.KPI_ID = m.KPI_ID AND t.Natco = m.Natco
WHERE m."Date" = DATE '2001-07-01'"""
CTES["thresholds"] = " UNION ALL ".join(
    f"SELECT trim(KPI_ID) AS KPI_ID, Threshold, '{c}' AS Natco FROM {{fx_report_mapping}} "
    f"WHERE Threshold_flag = 'T' AND {c} IS NOT NULL" for c in COUNTRIES
)

_EXTRACT = r"'(\d+)[./\-](\d+)[./\-](\d+)'"
_STAMP14 = r"'(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})'"


def _rounded(source: str, column: str = '"Value"') -> str:
    return f"SELECT * REPLACE (round({column} + 0.0000001, 4) AS {column}) FROM {{{source}}}"


# Statements written outside an f-string: double braces are for regular expressions only.
FINAL: dict[str, str] = {
    "scan_daily_feed": """
SELECT row_no, Marker, DatumKPI, Natco, "Value", file_name AS Input_File FROM {fx_daily_raw}
WHERE (Marker = 'L' AND "Value" IS NOT NULL) OR Marker = 'C'""",
    "normalize_values": " UNION ALL ".join(
        f"SELECT '{feed}' AS feed, row_no, {_is_number('\"Value\"')} AS is_number, {_number('\"Value\"')} AS number FROM {{fx_{feed}_raw}}"
        for feed in ("daily", "weekly", "monthly")
    ),
    "normalize_dates": f"""
SELECT 'daily' AS feed, row_no, strftime(TRY_STRPTIME(DatumKPI, '%Y%m%d%H%M%S'), '%d.%m.%Y') AS business_date FROM {{fx_daily_raw}}
UNION ALL SELECT 'weekly', row_no, strftime({_period_date('"Date"')}, '%d.%m.%Y') FROM {{fx_weekly_raw}}
UNION ALL SELECT 'monthly', row_no, strftime({_period_date('"Date"')}, '%d.%m.%Y') FROM {{fx_monthly_raw}}""",
    "date_helpers": f"""
SELECT feed, row_no, '00' || substr(x, 5, 2) || substr(x, 1, 4) AS month_code,
       CASE WHEN regexp_matches(x, {_STAMP14}) THEN regexp_extract(x, {_STAMP14}, 3) || '.' || regexp_extract(x, {_STAMP14}, 2)
            || '.' || regexp_extract(x, {_STAMP14}, 1) ELSE 'Unknown Format' END AS business_date,
       CASE WHEN regexp_matches(x, {_EXTRACT}) THEN '01.' || regexp_extract(x, {_EXTRACT}, 2) || '.' || regexp_extract(x, {_EXTRACT}, 3)
            ELSE x END AS first_of_month,
       CASE WHEN regexp_matches(x, {_EXTRACT}) THEN regexp_extract(x, {_EXTRACT}, 1) || '.' || regexp_extract(x, {_EXTRACT}, 2)
            || '.' || regexp_extract(x, {_EXTRACT}, 3) ELSE 'Unknown Format' END AS dotted
FROM (SELECT 'daily' AS feed, row_no, DatumKPI AS x FROM {{fx_daily_raw}}
      UNION ALL SELECT 'weekly', row_no, "Date" FROM {{fx_weekly_raw}}) t""",
    "text_helpers": """
SELECT row_no,
       CASE WHEN Remarks IS NULL OR Remarks = '' THEN '*nonamefor_' || upper(kpi_name) ELSE Remarks END AS name,
       CASE WHEN Remarks IS NULL OR Remarks = '' THEN "Value" ELSE Remarks END AS compare,
       trim(coalesce("Value", 'nan')) <> upper(trim(coalesce(Remarks, 'nan'))) AS has_update
FROM {fx_weekly_raw}""",
    "build_keys": """
SELECT feed, Input_ID, count(*) AS n FROM (
  SELECT 'daily' AS feed, Input_ID FROM {daily} UNION ALL SELECT 'weekly', Input_ID FROM {weekly}
  UNION ALL SELECT 'monthly', Input_ID FROM {monthly} UNION ALL SELECT 'ims', Input_ID FROM {ims}
  UNION ALL SELECT 'registry', coalesce(Service, 'nan') || '-' || coalesce(Vendor, 'nan') || '-' || coalesce(KPI_Name, 'nan')
  FROM {fx_registry}) t GROUP BY 1, 2""",
    "file_comment": "SELECT * FROM {comment}",
    "normalize_daily": "SELECT * FROM {daily}",
    "normalize_weekly": "SELECT * FROM {weekly}",
    "normalize_monthly": "SELECT * FROM {monthly}",
    "old_value_map": 'SELECT Input_ID, max("Value") AS KPIValueOld FROM {daily} GROUP BY 1',
    "old_comment_map": """
SELECT Key_Corr AS Input_ID, max(coalesce(CommentFileNew, '')) AS CommentFileOld FROM {daily_log} GROUP BY 1""",
    "corrections_daily": "SELECT * FROM {daily_log}",
    "corrections_weekly": "SELECT * FROM {weekly_log}",
    "corrections_monthly": "SELECT * FROM {monthly_log}",
    "corrections_multimarket_compat": f"""
SELECT {_LOG_COLUMNS.format(kpi='"KPI name"', code="M", comments=_ROW_COMMENTS)}
FROM {{multimarket}} n
LEFT JOIN (SELECT Input_ID, arg_max("Value", CAST("Value" AS VARCHAR)) AS old FROM {{multimarket}} WHERE delivery < 3 GROUP BY 1) o
  ON o.Input_ID = n.Input_ID
LEFT JOIN (SELECT f.Input_ID, f.Input_File, m.Remarks FROM (SELECT DISTINCT Input_ID, Input_File FROM {{multimarket}} WHERE delivery < 3) f
  JOIN (SELECT DISTINCT Input_ID, Remarks FROM {{multimarket}} WHERE delivery < 3) m ON m.Input_ID = f.Input_ID) r ON r.Input_ID = n.Input_ID
WHERE n.delivery = 3
  AND (o.old IS NOT NULL OR NOT contains(coalesce(r.Remarks, 'nan'), coalesce(n.Remarks, 'nan')))""",
    "correction_flag": """
SELECT Input_ID, Input_File, "Value",
       CASE WHEN Input_ID IN (SELECT Key_Corr FROM {weekly_log}) THEN 'Correction' END AS was_corrected_Flag
FROM {weekly}""",
    "upsert_daily": "SELECT * FROM {daily_out}",
    "upsert_weekly": "SELECT * FROM {weekly_out}",
    "upsert_monthly": "SELECT * FROM {monthly_out}",
    "upsert_monthly_compat": "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS was_corrected_Flag) FROM {monthly_out}",
    "multimarket_split": "SELECT * FROM {multimarket_out} WHERE Region IN (SELECT market FROM {fx_market})",
    "fold_deliveries": "SELECT * FROM {daily_fold_out}",
    "fold_corrections": "SELECT * FROM {daily_fold_log}",
    "fold_corrections_compat": f"""
SELECT l.* EXCLUDE (delivery, CommentFileOld),
       (SELECT max(e.CommentFileNew) FROM {{daily}} e JOIN {{daily_prev}} p ON p.Input_ID = e.Input_ID AND p.delivery = e.delivery
        WHERE e.Input_ID = l.Key_Corr AND e.delivery < l.delivery AND p.previous IS NOT NULL) AS CommentFileOld
FROM (SELECT {_LOG_COLUMNS.format(kpi="KPI_ID", code="D", comments=_file_comments("'?'"))}, n.delivery
      FROM {{daily}} n
      JOIN (SELECT Input_ID, delivery, lag(v) OVER w AS old, lag(delivery) OVER w AS previous
            FROM (SELECT Input_ID, delivery, arg_max("Value", CAST("Value" AS VARCHAR)) AS v FROM {{daily}} GROUP BY 1, 2) t
            WINDOW w AS (PARTITION BY Input_ID ORDER BY delivery)) o ON o.Input_ID = n.Input_ID AND o.delivery = n.delivery
      JOIN (SELECT DISTINCT Input_ID, delivery, Input_File FROM {{daily}}) r ON r.Input_ID = o.Input_ID AND r.delivery = o.previous
      WHERE o.old IS NOT NULL) l""",
    "fold_deliveries_weekly": "SELECT * FROM {weekly_fold_out}",
    "fold_corrections_weekly": "SELECT * FROM {weekly_fold_log}",
    "fold_multimarket": "SELECT * FROM {multimarket_fold_out}",
    "fold_stored_deliveries": "SELECT * FROM {daily4_fold_out}",
    "fold_stored_corrections": "SELECT * FROM {daily4_fold_log}",
    "fold_stored_deliveries_weekly": "SELECT * FROM {weekly4_fold_out}",
    "fold_stored_corrections_weekly": "SELECT * FROM {weekly4_fold_log}",
    "fold_stored_multimarket": "SELECT * FROM {multimarket4_fold_out}",
    "weekly_averages": _rounded("weekly_avg"),
    "monthly_averages": _rounded("monthly_avg"),
    "weekly_averages_merged": _rounded("weekly_merged"),
    "monthly_averages_merged": _rounded("monthly_merged"),
    "registry_names": """
SELECT DISTINCT upper(trim(KPI_ID)) AS KPI_ID, upper(trim(KPI_Name)) AS KPI_Name FROM {fx_registry} WHERE KPI_ID IS NOT NULL""",
    "registry_unpivot": "SELECT * FROM {cells}",
    "registry_flags": "SELECT * FROM {flags}",
    "calendar_day": "SELECT * FROM {calendar}",
    "calendar_week": "SELECT * FROM {calendar} WHERE WeekDay = 0",
    "calendar_month": "SELECT * FROM {calendar} WHERE Day = 1",
    "calendar_compat": 'SELECT "Date", YearWeek, Quarter, RC12 FROM {calendar_literal}',
    "matrix_daily": "SELECT * FROM {matrix_d}",
    "matrix_daily_compat": "SELECT * FROM {matrix_d_literal}",
    "matrix_weekly": "SELECT * FROM {matrix_w}",
    "matrix_weekly_delivered": "SELECT * FROM {matrix_wd}",
    "matrix_monthly": "SELECT * FROM {matrix_m}",
    "matrix_outer": """
SELECT g.Natco, g.KPI_ID, g.KPI_Name, g.requested_Weekly, g."Date", coalesce(g.KEY1, l.Input_ID) AS KEY1,
       round(l.KPI_Value + 0.0000001, 4) AS KPI_Value, l.IsDelivered, l."Time", l.Input_File, l.Remarks, l.was_corrected_Flag
FROM {grid_w} g FULL JOIN {look_outer} l ON l.Input_ID = g.KEY1""",
    "matrix_outer_compat": """
SELECT g.Natco, g.KPI_ID, g.KPI_Name, g.requested_Weekly, g."Date", coalesce(g.KEY1, l.Input_ID) AS KEY1,
       round(l.KPI_Value + 0.0000001, 4) AS KPI_Value, l.IsDelivered, l."Time", l.Input_File, l.Remarks, l.was_corrected_Flag
FROM {grid_w} g FULL JOIN {look_outer_literal} l ON l.Input_ID = g.KEY1""",
    "unknown_grid_codes": """
SELECT *, 'unknown country' AS reason FROM {flags} WHERE Natco NOT IN (SELECT code FROM {fx_market} WHERE code <> 'CX')""",
    "rejected_ims": f"""
SELECT "Date", kpi_name AS "KPI name", "Value", Region, 'unreadable date' AS reason
FROM {{fx_ims_raw}} WHERE "Date" <> '' AND {_period_date('"Date"')} IS NULL""",
    "ims_normalize": "SELECT * FROM {ims}",
    "facts": f"""
SELECT a."Date", a."KPI name" AS "Kpi name", a."Value", a.Region, a.Input_ID, k.Vendor, k.Service, k.Unit AS Units,
       CASE k.more WHEN 'yes' THEN 'more is better' WHEN 'no' THEN 'less is better' ELSE '' END AS Polarity,
       k.Service || '-' || k.Vendor || '-' || upper(trim(k.KPI_Name)) AS "%SVKPI_Key", k.PM_Report AS "PM Report"
FROM (SELECT "Date", "KPI name", "Value", Region, Input_ID FROM {{weekly}}
      UNION ALL SELECT "Date", "KPI name", {_number('"Value"')}, Region, Input_ID || '-w' FROM {{ims}}) a
JOIN {{fx_registry}} k ON upper(trim(k.KPI_Name)) = a."KPI name"
WHERE k.Vendor <> '' AND k.Service <> '' AND k.PM_Report IN ('Y', 'y')""",
    "report_thresholds": "SELECT * FROM {thresholds}",
    "report_status": _STATUS + " AND m.requested_Monthly = 1",
    "report_status_unrequested": _STATUS,
    "report_three_months": """
SELECT Natco, KPI_ID, KPI_Name, max(CASE WHEN "Date" = DATE '2001-07-01' THEN KPI_Value END) AS "2001-Jul",
       max(CASE WHEN "Date" = DATE '2001-06-01' THEN KPI_Value END) AS "2001-Jun",
       max(CASE WHEN "Date" = DATE '2001-05-01' THEN KPI_Value END) AS "2001-May"
FROM {matrix_m} WHERE "Date" IN (DATE '2001-07-01', DATE '2001-06-01', DATE '2001-05-01') GROUP BY 1, 2, 3""",
    "expected_vs_delivered": "SELECT * FROM {missing}",
    "run_verdict": """
SELECT e.delivery_date, CAST(count(*) FILTER (WHERE m.market IS NOT NULL) AS BIGINT) AS missing_files,
       CASE WHEN count(*) FILTER (WHERE m.market IS NOT NULL) = 0 THEN 'check_files' ELSE 'terminate' END AS next_step
FROM {expected} e LEFT JOIN {missing} m
  ON m.market = e.market AND m.file_type = e.file_type AND m.delivery_date = e.delivery_date
WHERE e.stable GROUP BY 1""",
    "pending_files": """
SELECT * FROM {parsed} WHERE file_type IN ('click', 'view', 'purchase') AND market IN (SELECT lower(code) FROM {fx_market})""",
    "incomplete_deliveries": "SELECT * FROM {counts} WHERE files < 3",
    "complete_deliveries": "SELECT * FROM {counts} WHERE files >= 3",
    "reprocess_plan": """
SELECT DISTINCT market, delivery_date, 1 AS step, CAST(delivery_date - INTERVAL 1 DAY AS DATE) AS run_date, 'update' AS mode
FROM {parsed} WHERE delivery_date IS NOT NULL
UNION ALL
SELECT DISTINCT market, delivery_date, 2, delivery_date, 'daily' FROM {parsed} WHERE delivery_date IS NOT NULL""",
    "run_dates": """
SELECT DISTINCT delivery_date AS as_of, strftime(delivery_date - INTERVAL 2 DAY, '%Y-%m-%d') AS run_date,
       strftime(delivery_date - INTERVAL 2 DAY, '%Y%m%d') AS output_date, strftime(delivery_date - INTERVAL 2 DAY, '%Y%m') AS output_month,
       strftime(delivery_date - INTERVAL 2 DAY, '%Y') AS output_year, strftime(delivery_date - INTERVAL 3 DAY, '%Y-%m-%d') AS update_date,
       strftime(delivery_date - INTERVAL 3 DAY, '%Y%m%d') AS update_output_date,
       strftime(delivery_date - INTERVAL 3 DAY, '%Y%m') AS update_output_month
FROM {parsed}""",
    "publish_allow_list": """
SELECT name FROM {fx_manifest} WHERE name IN
  (SELECT file_type || '_' || strftime(delivery_date, '%Y-%m-%d') || '.csv_' || market || '.csv' FROM {expected} WHERE stable)""",
    "rejected_names": r"""
SELECT name FROM {fx_manifest} WHERE NOT regexp_matches(name, '^click_2024-01-15\.csv_[a-z]x\.csv$')
  AND NOT regexp_matches(name, '^view_2024-01-15\.csv_[a-m]x\.csv$')""",
    "report_recipients": """
SELECT f.name, lower(m.code) AS market, 'kpi@' || lower(m.code) AS address
FROM {fx_manifest} f JOIN {fx_market} m ON contains(f.name, lower(m.code))""",
}


def statement(final: str) -> str:
    """``final`` with every view it needs in front of it."""
    ordered: list[str] = []

    def need(sql: str) -> None:
        for name in references(sql):
            if name in CTES and name not in ordered:
                need(CTES[name])
                ordered.append(name)

    def plain(sql: str) -> str:
        for name in references(sql):
            if name in CTES or name in TABLES:
                sql = sql.replace("{" + name + "}", name)
        return sql.strip()

    need(final)
    body = plain(final)
    if not ordered:
        return body
    ctes = ",\n".join(f"{n} AS ({plain(CTES[n])})" for n in ordered)
    return f"WITH {ctes}\n{body}"


def oracle_sql() -> dict[str, str]:
    return {name: statement(sql) for name, sql in FINAL.items()}
