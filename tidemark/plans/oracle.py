"""DuckDB SQL equal to each registered query, run on the same parquet tables."""

RATES_CTE = """
lines AS (
  SELECT l_suppkey AS k, CAST(l_shipdate AS DATE) AS rate_date, l_extendedprice AS price,
         row_number() OVER (PARTITION BY l_suppkey, CAST(l_shipdate AS DATE)
                            ORDER BY l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) AS rn FROM lineitem),
rates_src AS (
  SELECT k, rate_date, CAST(price AS DECIMAL(12,6)) AS exchange_rate,
         CAST(rate_date AS TIMESTAMP) + INTERVAL '18' HOUR AS load_timestamp,
         CASE WHEN k % 10 = 7 THEN 'S-' || lpad(CAST(k AS VARCHAR), 10, '0')
              ELSE chr(CAST(65 + (k // 676) % 26 AS INTEGER)) || chr(CAST(65 + (k // 26) % 26 AS INTEGER)) || chr(CAST(65 + k % 26 AS INTEGER))
                   || CASE WHEN k >= 17576 THEN CAST(k // 17576 AS VARCHAR) ELSE '' END END AS currency_code
  FROM lines WHERE rn = 1),
rates AS (
  SELECT currency_code, 'Series ' || currency_code || CASE WHEN k % 10 = 9 THEN repeat(' of a long name', 7) ELSE '' END AS currency_name,
         exchange_rate, rate_date, 'daily' AS rate_type, CASE k % 3 WHEN 0 THEN 1 WHEN 1 THEN 10 ELSE 100 END AS nominal, load_timestamp
  FROM rates_src
  UNION ALL
  SELECT currency_code, CASE k % 18 WHEN 0 THEN 'Доллара США к рублю' WHEN 1 THEN 'Евро к рублю' WHEN 2 THEN 'Юаня к рублю'
           WHEN 3 THEN 'Фунта стерлингов к рублю' WHEN 4 THEN 'Йены к рублю' WHEN 5 THEN 'Франка к рублю'
           WHEN 6 THEN 'Казахстанского тенге' WHEN 7 THEN 'Белорусского рубля' WHEN 8 THEN 'Гривны' WHEN 9 THEN 'Лари'
           WHEN 10 THEN 'Доллар' WHEN 11 THEN 'ЕВР' WHEN 12 THEN 'Юань' WHEN 13 THEN 'Фунт' WHEN 14 THEN 'Йена'
           WHEN 15 THEN 'Франк' WHEN 16 THEN 'Рупия' ELSE 'XYZ coin' END, max(exchange_rate),
         CAST(date_trunc('month', rate_date) AS DATE), 'monthly', 1, max(load_timestamp)
  FROM rates_src GROUP BY k, currency_code, CAST(date_trunc('month', rate_date) AS DATE))
"""

#: code of each name of the test relation, written out by hand
CODE_OF_NAME = """CASE currency_name WHEN 'Доллара США к рублю' THEN 'USD' WHEN 'Евро к рублю' THEN 'EUR' WHEN 'Юаня к рублю' THEN 'CNY'
  WHEN 'Фунта стерлингов к рублю' THEN 'GBP' WHEN 'Йены к рублю' THEN 'JPY' WHEN 'Франка к рублю' THEN 'CHF'
  WHEN 'Казахстанского тенге' THEN 'KZT' WHEN 'Белорусского рубля' THEN 'BYN' WHEN 'Гривны' THEN 'UAH' WHEN 'Лари' THEN 'GEL'
  WHEN 'Доллар' THEN 'DOL' WHEN 'ЕВР' THEN 'EUR' WHEN 'Юань' THEN 'UAN' WHEN 'Фунт' THEN 'FUN' WHEN 'Йена' THEN 'YEN'
  WHEN 'Франк' THEN 'FRA' WHEN 'Рупия' THEN 'РУП' WHEN 'XYZ coin' THEN 'XYZ' ELSE 'SER' END"""

EVENTS_CTE = """
ev AS (
  SELECT event_type AS currency_code, event_type AS currency_name,
         CAST(value AS DECIMAL(12,6)) AS exchange_rate, CAST(ts AS DATE) AS rate_date,
         'daily' AS rate_type, 1 AS nominal, ts AS load_timestamp
  FROM events)
"""


def with_rates(body: str) -> str:
    return "WITH " + RATES_CTE + ", " + body


def with_events(body: str) -> str:
    return "WITH " + EVENTS_CTE + ", " + body


def _period(unit: str, col: str) -> str:
    return with_rates(f"""
base AS (
  SELECT currency_code, CAST(date_trunc('{unit}', rate_date) AS DATE) AS {col},
         CAST(SUM(exchange_rate) AS DOUBLE) / COUNT(*) AS avg_rate,
         CAST(MIN(exchange_rate) AS DOUBLE) AS min_rate, CAST(MAX(exchange_rate) AS DOUBLE) AS max_rate,
         ROUND(STDDEV_SAMP(CAST(exchange_rate AS DOUBLE)), 4) AS volatility, COUNT(*) AS days_count
  FROM rates WHERE rate_type = 'daily' GROUP BY 1, 2)
SELECT *, avg_rate - LAG(avg_rate) OVER w AS abs_change,
       ROUND((avg_rate / LAG(avg_rate) OVER w - 1) * 100, 4) AS pct_change
FROM base WINDOW w AS (PARTITION BY currency_code ORDER BY {col})""")


def _volatility(extra_filter: str, with_range: bool, with_name: bool, n: int | None) -> str:
    cols = ["currency_code"]
    if with_name:
        cols.append("MAX(currency_name) AS currency_name")
    cols += ["ROUND(STDDEV_SAMP(CAST(exchange_rate AS DOUBLE)), 4) AS volatility",
             "ROUND(CAST(SUM(exchange_rate) AS DOUBLE) / COUNT(*), 2) AS avg_rate",
             "CAST(ROUND(MIN(exchange_rate), 2) AS DOUBLE) AS min_rate",
             "CAST(ROUND(MAX(exchange_rate), 2) AS DOUBLE) AS max_rate"]
    if with_range:
        cols.append("CAST(ROUND(MAX(exchange_rate) - MIN(exchange_rate), 2) AS DOUBLE) AS range")
    cols.append("ROUND(CAST(MAX(exchange_rate) - MIN(exchange_rate) AS DOUBLE) / "
                "(CAST(SUM(exchange_rate) AS DOUBLE) / COUNT(*)) * 100, 2) AS pct_range")
    if with_name:
        cols.append("COUNT(*) AS days_count")
    limit = f" LIMIT {n}" if n is not None else ""
    return with_rates(f"""
t AS (SELECT {', '.join(cols)} FROM rates
      WHERE rate_date > DATE '2001-11-04' - INTERVAL 30 DAY {extra_filter}
      GROUP BY currency_code)
SELECT * FROM t ORDER BY volatility DESC NULLS FIRST, currency_code{limit}""")


ORACLE = {
    "daily_changes": with_rates("""
d AS (SELECT currency_code, rate_date, exchange_rate FROM rates WHERE rate_type = 'daily')
SELECT currency_code, rate_date, CAST(exchange_rate AS DOUBLE) AS exchange_rate,
       CAST(LAG(exchange_rate) OVER w AS DOUBLE) AS prev_rate,
       CAST(exchange_rate - LAG(exchange_rate) OVER w AS DOUBLE) AS abs_change,
       ROUND((CAST(exchange_rate AS DOUBLE) / CAST(LAG(exchange_rate) OVER w AS DOUBLE) - 1) * 100, 4) AS pct_change
FROM d WINDOW w AS (PARTITION BY currency_code ORDER BY rate_date)"""),
    "weekly_stats": _period("week", "week_start"),
    "monthly_stats": _period("month", "month_start"),
    "quarterly_stats": _period("quarter", "quarter_start"),
    "top_volatile": _volatility("AND rate_type = 'daily'", True, False, 10),
    "top5_volatile": _volatility("AND rate_type = 'daily'", True, False, 5),
    "volatility_panel": _volatility("", False, True, 10),
    "anchor_correlation": with_rates("""
a AS (SELECT rate_date, CAST(exchange_rate AS DOUBLE) AS y FROM rates
      WHERE currency_code = 'AAA' AND rate_type = 'daily'),
o AS (SELECT currency_code, rate_date, CAST(exchange_rate AS DOUBLE) AS x FROM rates
      WHERE currency_code <> 'AAA' AND rate_type = 'daily')
SELECT currency_code,
       ROUND(CASE WHEN MIN(x) < MAX(x) AND MIN(y) < MAX(y)
                  THEN COVAR_SAMP(x, y) / (STDDEV_SAMP(x) * STDDEV_SAMP(y)) END, 4) AS correlation_with_anchor,
       COUNT(*) AS days_count
FROM o JOIN a USING (rate_date)
GROUP BY currency_code HAVING COUNT(*) > 10"""),
    "load_stats": with_events("""
x AS (SELECT 1)
SELECT CAST(load_timestamp AS DATE) AS load_date, COUNT(*) AS records_loaded,
       COUNT(DISTINCT currency_code) AS currencies_count, COUNT(DISTINCT rate_date) AS dates_count,
       MIN(rate_date) AS min_date, MAX(rate_date) AS max_date,
       MIN(load_timestamp) AS first_load, MAX(load_timestamp) AS last_load
FROM ev GROUP BY 1"""),
    "loads_last_7d": with_events("""
x AS (SELECT 1)
SELECT CAST(load_timestamp AS DATE) AS day, COUNT(*) AS records
FROM ev WHERE load_timestamp > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY
GROUP BY 1"""),
    "total_records": with_rates("x AS (SELECT 1) SELECT COUNT(*) AS value FROM rates"),
    "distinct_entities": with_rates("x AS (SELECT 1) SELECT COUNT(DISTINCT currency_code) AS value FROM rates"),
    "entity_trailing": with_rates("""
x AS (SELECT 1)
SELECT rate_date AS time, CAST(exchange_rate AS DOUBLE) AS value FROM rates
WHERE currency_code = 'AAA' AND rate_date > DATE '2001-11-04' - INTERVAL 30 DAY"""),
    "entity_last_week_changes": with_rates("""
d AS (SELECT rate_date, exchange_rate,
             ROUND((CAST(exchange_rate AS DOUBLE) / CAST(LAG(exchange_rate) OVER (ORDER BY rate_date) AS DOUBLE) - 1) * 100, 4) AS pct_change
      FROM rates WHERE rate_type = 'daily' AND currency_code = 'AAA')
SELECT rate_date, CAST(exchange_rate AS DOUBLE) AS exchange_rate, pct_change FROM d
WHERE rate_date > DATE '2001-10-16' - INTERVAL 7 DAY"""),
    "majors_labelled": with_rates("""
x AS (SELECT 1)
SELECT rate_date AS time,
       CASE WHEN currency_code = 'AAA' THEN 'series_a'
            WHEN currency_code = 'AAB' THEN 'series_b'
            WHEN currency_code = 'AAC' THEN 'series_c' END AS metric,
       CAST(exchange_rate AS DOUBLE) AS value
FROM rates WHERE currency_code IN ('AAA', 'AAB', 'AAC')
  AND rate_date > DATE '2001-11-04' - INTERVAL 30 DAY"""),
    "majors_wide": with_rates("""
x AS (SELECT 1)
SELECT rate_date AS time,
       MAX(CASE WHEN currency_code = 'AAA' THEN CAST(exchange_rate AS DOUBLE) END) AS series_a,
       MAX(CASE WHEN currency_code = 'AAB' THEN CAST(exchange_rate AS DOUBLE) END) AS series_b,
       MAX(CASE WHEN currency_code = 'AAC' THEN CAST(exchange_rate AS DOUBLE) END) AS series_c
FROM rates WHERE currency_code IN ('AAA', 'AAB', 'AAC')
  AND rate_date > DATE '2001-11-04' - INTERVAL 30 DAY
GROUP BY 1"""),
}


# ---- validation, store, reports -------------------------------------------------

RECORDS_CTE = """
daily AS (SELECT * FROM rates WHERE rate_type = 'daily'),
rec0 AS (SELECT CAST(exchange_rate * 100 AS BIGINT) % 13 AS k, * FROM daily),
rec AS (
  SELECT CASE WHEN k = 0 THEN '   ' WHEN k = 9 THEN '  ' || currency_code || ' ' ELSE currency_code END AS currency_code,
         CASE WHEN k = 1 THEN '' ELSE currency_name END AS currency_name,
         CASE WHEN k = 2 THEN 'n/a' WHEN k = 3 THEN '-' || CAST(exchange_rate AS VARCHAR)
              WHEN k = 4 THEN CAST(exchange_rate * 100 AS VARCHAR) WHEN k = 10 THEN 'NaN'
              ELSE CAST(exchange_rate AS VARCHAR) END AS exchange_rate,
         CASE WHEN k = 5 THEN strftime(rate_date, '%Y/%m/%d') WHEN k = 8 THEN strftime(rate_date, '%Y-%-m-%-d')
              ELSE strftime(rate_date, '%Y-%m-%d') END AS rate_date,
         CASE WHEN k = 8 THEN 'Weekly' WHEN k = 9 THEN 'MONTHLY' WHEN k = 11 THEN NULL ELSE 'daily' END AS rate_type,
         CASE WHEN k = 6 THEN 'x' WHEN k = 7 THEN '0' WHEN k = 9 THEN NULL WHEN k = 11 THEN '10' ELSE '1' END AS nominal
  FROM rec0),
p AS (
  SELECT trim(currency_code) AS c, trim(currency_name) AS n, TRY_CAST(exchange_rate AS DOUBLE) AS r,
         CAST(TRY_STRPTIME(rate_date, '%Y-%m-%d') AS DATE) AS d, lower(rate_type) AS t,
         trim(nominal) AS nt, TRY_CAST(trim(nominal) AS INTEGER) AS nm,
         concat(currency_code, '|', currency_name, '|', exchange_rate, '|', rate_date, '|', rate_type, '|', nominal) AS original
  FROM rec),
chk AS (
  SELECT c AS currency_code, n AS currency_name, TRY_CAST(r AS DECIMAL(12,6)) AS exchange_rate, d AS rate_date,
         CASE WHEN t IN ('daily', 'monthly') THEN t ELSE 'daily' END AS rate_type, coalesce(nm, 1) AS nominal,
         original,
         CASE WHEN c IS NULL OR c = '' THEN 'empty_code'
              WHEN length(c) > 8 THEN 'code_too_long'
              WHEN n IS NULL OR n = '' THEN 'empty_name'
              WHEN length(n) > 100 THEN 'name_too_long'
              WHEN r IS NULL OR isnan(r) OR isinf(r) THEN 'bad_rate'
              WHEN r <= 0 THEN 'non_positive_rate'
              WHEN TRY_CAST(r AS DECIMAL(12,6)) IS NULL THEN 'rate_overflow'
              WHEN d IS NULL THEN 'bad_date'
              WHEN nt IS NOT NULL AND nm IS NULL THEN 'bad_nominal'
              WHEN coalesce(nm, 1) <= 0 THEN 'non_positive_nominal' END AS reason
  FROM p),
ok AS (SELECT currency_code, currency_name, exchange_rate, rate_date, rate_type, nominal FROM chk WHERE reason IS NULL),
batch AS (
  SELECT *, 1 AS seq FROM ok
  UNION ALL
  SELECT currency_code, currency_name, CAST(exchange_rate + 1 AS DECIMAL(12,6)), rate_date, rate_type, nominal, 2 FROM ok)
"""


def with_records(body: str) -> str:
    return "WITH " + RATES_CTE + ", " + RECORDS_CTE + ", " + body


_CAL = """
rng AS (SELECT MIN(rate_date) AS a, MAX(rate_date) AS b FROM rates WHERE rate_type = 'daily'),
cal AS (SELECT CAST(g AS DATE) AS rate_date FROM rng, generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY) t(g))
"""

ORACLE.update({
    "validate_records": with_records("""
x AS (SELECT 1)
SELECT currency_code, currency_name, CAST(exchange_rate AS DOUBLE) AS exchange_rate, rate_date, rate_type, nominal, reason,
       CASE WHEN reason IS NOT NULL THEN original END AS original
FROM chk"""),
    "reject_reasons": with_records("""
x AS (SELECT 1)
SELECT coalesce(reason, 'valid') AS reason, COUNT(*) AS rows FROM chk GROUP BY 1"""),
    "constraint_violations": with_rates("""
x AS (SELECT 1)
SELECT 'code_pattern' AS rule, COUNT(*) FILTER (WHERE NOT coalesce(regexp_matches(currency_code, '^[A-Z]{3}$'), false)) AS violations FROM rates
UNION ALL SELECT 'rate_positive', COUNT(*) FILTER (WHERE NOT coalesce(exchange_rate > 0, false)) FROM rates
UNION ALL SELECT 'rate_type_known', COUNT(*) FILTER (WHERE NOT coalesce(rate_type IN ('daily', 'monthly'), false)) FROM rates
UNION ALL SELECT 'code_length', COUNT(*) FILTER (WHERE length(currency_code) > 3) FROM rates
UNION ALL SELECT 'name_length', COUNT(*) FILTER (WHERE length(currency_name) > 100) FROM rates"""),
    "upsert_rates": with_records("""
u AS (
  SELECT currency_code, currency_name, exchange_rate, rate_date, rate_type, nominal, load_timestamp, 0 AS src, 0 AS seq FROM rates
  UNION ALL
  SELECT currency_code, currency_name, exchange_rate, rate_date, rate_type, nominal, TIMESTAMP '2001-11-05 00:00:00', 1, seq FROM batch),
r AS (SELECT *, row_number() OVER (PARTITION BY currency_code, rate_date, rate_type ORDER BY src DESC, seq DESC) AS rn FROM u)
SELECT currency_code, currency_name, CAST(exchange_rate AS DOUBLE) AS exchange_rate, rate_date, rate_type, nominal, load_timestamp
FROM r WHERE rn = 1"""),
    "upsert_counts": with_records("""
k AS (SELECT DISTINCT currency_code, rate_date, rate_type FROM batch),
m AS (SELECT k.*, r.currency_code IS NOT NULL AS hit FROM k LEFT JOIN rates r USING (currency_code, rate_date, rate_type))
SELECT COUNT(*) FILTER (WHERE NOT hit) AS inserted, COUNT(*) FILTER (WHERE hit) AS updated FROM m"""),
    "insert_ignore_facts": with_records("""
b AS (SELECT *, row_number() OVER (PARTITION BY currency_code, rate_date, rate_type ORDER BY seq) AS rn FROM batch),
new AS (SELECT b.currency_code, b.exchange_rate, b.rate_date, b.rate_type, b.nominal, CAST(NULL AS TIMESTAMP) AS load_timestamp
        FROM b WHERE rn = 1 AND NOT EXISTS (
          SELECT 1 FROM rates r WHERE r.currency_code = b.currency_code AND r.rate_date = b.rate_date AND r.rate_type = b.rate_type))
SELECT currency_code, CAST(exchange_rate AS DOUBLE) AS exchange_rate, rate_date, rate_type, nominal, load_timestamp FROM rates
UNION ALL
SELECT currency_code, CAST(exchange_rate AS DOUBLE), rate_date, rate_type, nominal, load_timestamp FROM new"""),
    "sync_dimension": with_rates("""
dim AS (SELECT DISTINCT currency_code, currency_name, DATE '2000-01-01' AS first_seen, DATE '2000-01-01' AS last_seen, true AS is_active
        FROM rates WHERE rate_type = 'monthly'),
src AS (SELECT currency_code, currency_name FROM (
          SELECT *, row_number() OVER (PARTITION BY currency_code
                   ORDER BY (rate_type = 'daily') DESC, load_timestamp DESC, currency_name DESC) AS rn FROM rates) WHERE rn = 1)
SELECT coalesce(t.currency_code, s.currency_code) AS currency_code,
       coalesce(s.currency_name, t.currency_name) AS currency_name,
       coalesce(t.first_seen, DATE '2001-11-04') AS first_seen,
       CASE WHEN s.currency_name IS NOT NULL THEN DATE '2001-11-04' ELSE t.last_seen END AS last_seen,
       coalesce(t.is_active, true) AS is_active
FROM dim t FULL OUTER JOIN src s ON t.currency_code = s.currency_code"""),
    "union_sources": with_rates("""
x AS (SELECT 1)
SELECT currency_code, currency_name, CAST(exchange_rate AS DOUBLE) AS exchange_rate, rate_date, rate_type, nominal, load_timestamp
FROM rates"""),
    "dq_report": with_rates("""
c AS (SELECT COUNT(*) FILTER (WHERE rate_date = DATE '2001-10-31' AND rate_type = 'daily') AS rows_on_date,
             COUNT(*) FILTER (WHERE exchange_rate <= 0 OR exchange_rate > 100000) AS anomalies,
             COUNT(*) FILTER (WHERE rate_date = DATE '2001-10-31' AND currency_code IN ('AAA', 'AAB', 'AAC')) AS major_values,
             COUNT(*) AS total_records FROM rates)
SELECT 'rows_on_date' AS "check", rows_on_date AS value, CASE WHEN rows_on_date = 0 THEN 'warn' ELSE 'ok' END AS status FROM c
UNION ALL SELECT 'anomalies', anomalies, CASE WHEN anomalies > 0 THEN 'warn' ELSE 'ok' END FROM c
UNION ALL SELECT 'major_values', major_values, CASE WHEN major_values = 0 THEN 'warn' ELSE 'ok' END FROM c
UNION ALL SELECT 'total_records', total_records, 'info' FROM c"""),
    "dq_major_values": with_rates("""
x AS (SELECT 1)
SELECT currency_code, rate_type, CAST(exchange_rate AS DOUBLE) AS exchange_rate FROM rates
WHERE rate_date = DATE '2001-10-31' AND currency_code IN ('AAA', 'AAB', 'AAC')"""),
    "record_stats": with_rates("""
x AS (SELECT 1)
SELECT rate_type, COUNT(*) AS count, MIN(rate_date) AS min_date, MAX(rate_date) AS max_date,
       CAST(MIN(rate_date) AS VARCHAR) || ' - ' || CAST(MAX(rate_date) AS VARCHAR) AS date_range,
       COUNT(DISTINCT currency_code) AS currencies
FROM rates GROUP BY rate_type"""),
    "batch_stats": with_records("""
s AS (SELECT string_agg(currency_code, ', ' ORDER BY currency_code) AS sample_codes
      FROM (SELECT DISTINCT currency_code FROM ok ORDER BY currency_code LIMIT 3))
SELECT COUNT(DISTINCT currency_code) AS currencies, COUNT(DISTINCT rate_date) AS dates,
       COUNT(DISTINCT rate_type) AS rate_types,
       string_agg(DISTINCT rate_type, ', ' ORDER BY rate_type) AS types,
       MIN(rate_date) AS min_date, MAX(rate_date) AS max_date, (SELECT sample_codes FROM s) AS sample_codes
FROM ok"""),
    "run_totals": with_records("""
x AS (SELECT 1)
SELECT COUNT(*) FILTER (WHERE rate_type = 'daily') AS daily, COUNT(*) FILTER (WHERE rate_type = 'monthly') AS monthly,
       COUNT(*) AS total FROM ok"""),
    "load_report": with_rates("""
x AS (SELECT 1)
SELECT DATE '2001-06-01' AS period_start, DATE '2001-08-01' AS period_end, 62 AS days,
       COUNT(*) FILTER (WHERE rate_date BETWEEN DATE '2001-06-01' AND DATE '2001-08-01') AS records_loaded,
       COUNT(*) AS total_records, COUNT(DISTINCT currency_code) AS currencies,
       MIN(rate_date) AS min_date, MAX(rate_date) AS max_date
FROM rates"""),
    "rows_per_date": with_rates("""
x AS (SELECT 1)
SELECT rate_date, COUNT(*) AS rows FROM rates WHERE rate_type = 'daily' GROUP BY rate_date"""),
    "period_analysis": with_rates("""
d AS (SELECT * FROM rates WHERE rate_type = 'daily')
SELECT MIN(rate_date) AS min_date, MAX(rate_date) AS max_date, COUNT(DISTINCT rate_date) AS dates,
       COUNT(DISTINCT currency_code) AS currencies, COUNT(*) AS records,
       ROUND(COUNT(*) / COUNT(DISTINCT rate_date), 1) AS avg_per_day
FROM d"""),
    "existing_dates": with_rates("""
x AS (SELECT 1)
SELECT DISTINCT rate_date FROM rates WHERE rate_type = 'daily'"""),
    "calendar_days": with_rates(_CAL + """
SELECT rate_date FROM cal WHERE isodow(rate_date) < 6"""),
    "day_status": with_rates(_CAL + """,
per_day AS (SELECT rate_date, COUNT(*) AS n FROM rates WHERE rate_type = 'daily' GROUP BY 1)
SELECT c.rate_date,
       CAST(CASE WHEN isodow(c.rate_date) >= 6 THEN 0 ELSE coalesce(n, 0) END AS BIGINT) AS rows,
       CASE WHEN isodow(c.rate_date) >= 6 THEN 'skipped' WHEN n IS NULL THEN 'missing' ELSE 'loaded' END AS status
FROM cal c LEFT JOIN per_day p USING (rate_date)"""),
    "sample_rows": with_rates("""
x AS (SELECT 1)
SELECT currency_code, currency_name, CAST(exchange_rate AS DOUBLE) AS exchange_rate, rate_date, rate_type, nominal, load_timestamp
FROM rates ORDER BY currency_code, rate_date, rate_type LIMIT 10"""),
})


# ---- payloads, code extraction, streaming ingest, mart refresh ------------------

ORACLE.update({
    "entity_code_from_name": with_rates(f"""
n AS (SELECT DISTINCT currency_name FROM rates)
SELECT currency_name, {CODE_OF_NAME} AS code FROM n"""),
    "daily_xml_normalise": with_rates("""
x AS (SELECT 1)
SELECT currency_code, currency_name, CAST(exchange_rate AS DOUBLE) AS exchange_rate, rate_date,
       'daily' AS rate_type, nominal, CAST(exchange_rate AS DOUBLE) / nominal AS unit_rate,
       CAST(length(currency_code) AS VARCHAR) AS num_code, currency_code AS char_code, 'soap_daily' AS source
FROM rates WHERE rate_type = 'daily'"""),
    "catalogue_normalise": with_rates("""
e AS (SELECT currency_code, MIN(currency_name) AS name FROM rates GROUP BY currency_code)
SELECT name AS vname, 1 AS vnom, 'R' || currency_code AS vcode, lower(name) AS vengname,
       currency_code AS vcommoncode, CAST(length(currency_code) AS VARCHAR) AS vnumcode,
       CASE WHEN length(currency_code) % 2 = 0 THEN currency_code ELSE '' END AS vcharcode
FROM e"""),
    "monthly_json_normalise": with_rates(f"""
m AS (SELECT * FROM rates WHERE rate_type = 'monthly')
SELECT length(currency_code) * 100000 + year(rate_date) AS element_id,
       {CODE_OF_NAME} AS currency_code, currency_name,
       CAST(exchange_rate AS DOUBLE) AS exchange_rate, rate_date, 'monthly' AS rate_type, 1 AS nominal,
       strftime(rate_date, '%B %Y') AS period
FROM m"""),
    "monthly_json_rejects": with_rates("""
y AS (SELECT DISTINCT currency_code, year(rate_date) AS y FROM rates WHERE rate_type = 'monthly'),
d AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (y % 5 = 0) AS fifth FROM y)
SELECT 'unknown_element' AS reason, n AS rows FROM d
UNION ALL SELECT 'bad_document', 3 * fifth FROM d WHERE fifth > 0
UNION ALL SELECT 'bad_date', n FROM d
UNION ALL SELECT 'bad_value', 2 * n FROM d
UNION ALL SELECT 'value_overflow', n FROM d"""),
    "incremental_ingest": ORACLE["upsert_rates"],
    "refresh_marts": with_rates("""
d AS (SELECT * FROM rates WHERE rate_type = 'daily'),
c AS (
  SELECT 'daily_changes' AS mart, COUNT(*) AS rows FROM d
  UNION ALL SELECT 'weekly_stats', COUNT(*) FROM (SELECT DISTINCT currency_code, date_trunc('week', rate_date) FROM d)
  UNION ALL SELECT 'monthly_stats', COUNT(*) FROM (SELECT DISTINCT currency_code, date_trunc('month', rate_date) FROM d)
  UNION ALL SELECT 'quarterly_stats', COUNT(*) FROM (SELECT DISTINCT currency_code, date_trunc('quarter', rate_date) FROM d)
  UNION ALL SELECT 'top_volatile', LEAST(10, COUNT(DISTINCT currency_code)) FROM d WHERE rate_date > DATE '2001-11-04' - INTERVAL 30 DAY
  UNION ALL SELECT 'anchor_correlation', COUNT(*) FROM (
      SELECT o.currency_code FROM d o JOIN (SELECT rate_date FROM d WHERE currency_code = 'AAA') a USING (rate_date)
      WHERE o.currency_code <> 'AAA' GROUP BY o.currency_code HAVING COUNT(*) > 10)
  UNION ALL SELECT 'load_stats', COUNT(DISTINCT CAST(load_timestamp AS DATE)) FROM rates)
SELECT mart, rows FROM c UNION ALL SELECT 'total', CAST(SUM(rows) AS BIGINT) FROM c"""),
})

_UPSERTED = """
u AS (
  SELECT currency_code, currency_name, exchange_rate, rate_date, rate_type, nominal, load_timestamp, 0 AS src, 0 AS seq FROM rates
  UNION ALL
  SELECT currency_code, currency_name, exchange_rate, rate_date, rate_type, nominal, TIMESTAMP '2001-11-05 00:00:00', 1, seq FROM batch),
up AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY currency_code, rate_date, rate_type ORDER BY src DESC, seq DESC) AS rn FROM u)
       WHERE rn = 1)
"""

ORACLE["weekly_stats_incremental"] = with_records(_UPSERTED + """,
base AS (
  SELECT currency_code, CAST(date_trunc('week', rate_date) AS DATE) AS week_start,
         CAST(SUM(exchange_rate) AS DOUBLE) / COUNT(*) AS avg_rate,
         CAST(MIN(exchange_rate) AS DOUBLE) AS min_rate, CAST(MAX(exchange_rate) AS DOUBLE) AS max_rate,
         ROUND(STDDEV_SAMP(CAST(exchange_rate AS DOUBLE)), 4) AS volatility, COUNT(*) AS days_count
  FROM up WHERE rate_type = 'daily' GROUP BY 1, 2)
SELECT *, avg_rate - LAG(avg_rate) OVER w AS abs_change,
       ROUND((avg_rate / LAG(avg_rate) OVER w - 1) * 100, 4) AS pct_change
FROM base WINDOW w AS (PARTITION BY currency_code ORDER BY week_start)""")

# ---- the rest of the relation, landed files, period reads and jobs ------------------

ORACLE.update({
    "superseded_lines": """
WITH d AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, COUNT(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT CAST(date_trunc('month', day) AS DATE) AS month, CAST(SUM(n) AS BIGINT) AS lines, COUNT(*) AS rates,
       CAST(SUM(n) - COUNT(*) AS BIGINT) AS superseded FROM d GROUP BY 1""",
    "per_unit_changes": with_rates("""
d AS (SELECT currency_code, rate_date, CAST(exchange_rate / nominal AS DECIMAL(12,6)) AS r FROM rates WHERE rate_type = 'daily')
SELECT currency_code, rate_date, CAST(r AS DOUBLE) AS exchange_rate, CAST(LAG(r) OVER w AS DOUBLE) AS prev_rate,
       CAST(r - LAG(r) OVER w AS DOUBLE) AS abs_change,
       ROUND((CAST(r AS DOUBLE) / CAST(LAG(r) OVER w AS DOUBLE) - 1) * 100, 4) AS pct_change
FROM d WINDOW w AS (PARTITION BY currency_code ORDER BY rate_date)"""),
    "daily_xml_files": with_rates("""
x AS (SELECT 1)
SELECT currency_code, currency_name, CAST(exchange_rate AS DOUBLE) AS exchange_rate, rate_date,
       'daily' AS rate_type, nominal, CAST(exchange_rate AS DOUBLE) / nominal AS unit_rate,
       CAST(length(currency_code) AS VARCHAR) AS num_code, currency_code AS char_code, 'soap_daily' AS source
FROM rates WHERE rate_type = 'daily' AND rate_date BETWEEN DATE '2001-06-01' AND DATE '2001-08-01'"""),
    "period_rows": with_rates("""
x AS (SELECT 1)
SELECT currency_code, currency_name, CAST(exchange_rate AS DOUBLE) AS exchange_rate, rate_date, rate_type, nominal, load_timestamp
FROM rates WHERE rate_type = 'daily' AND rate_date BETWEEN DATE '2001-06-01' AND DATE '2001-08-01' AND isodow(rate_date) < 6"""),
    "period_day_summary": with_rates(_CAL + """,
per_day AS (SELECT rate_date, COUNT(*) AS n FROM rates WHERE rate_type = 'daily' GROUP BY 1)
SELECT COUNT(*) FILTER (isodow(c.rate_date) < 6 AND n IS NOT NULL) AS successful_days,
       COUNT(*) FILTER (isodow(c.rate_date) < 6 AND n IS NULL) AS failed_days,
       COUNT(*) FILTER (isodow(c.rate_date) >= 6) AS skipped_days,
       CAST(SUM(CASE WHEN isodow(c.rate_date) < 6 THEN coalesce(n, 0) ELSE 0 END) AS BIGINT) AS total_rows
FROM cal c LEFT JOIN per_day p USING (rate_date)"""),
    "run_daily": with_rates("""
d AS (SELECT *, length(currency_code) > 8 AS long_code, length(currency_name) > 100 AS long_name
      FROM rates WHERE rate_type = 'daily' AND rate_date = DATE '2001-10-31'),
o AS (SELECT * FROM d WHERE NOT long_code AND NOT long_name),
m AS (SELECT """ + CODE_OF_NAME + """ AS code, rate_date, year(rate_date) IN (2000, 2001) AS kept FROM rates WHERE rate_type = 'monthly'),
k AS (SELECT DISTINCT code, rate_date FROM m WHERE kept),
h AS (SELECT COUNT(*) AS n FROM k WHERE EXISTS (SELECT 1 FROM rates r WHERE r.rate_type = 'monthly' AND r.currency_code = k.code AND r.rate_date = k.rate_date)),
docs AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT currency_code, year(rate_date) FROM rates WHERE rate_type = 'monthly'))
SELECT 'daily' AS name, (SELECT COUNT(*) FROM o) AS value
UNION ALL SELECT 'monthly', (SELECT COUNT(*) FROM m WHERE kept)
UNION ALL SELECT 'outside_years', (SELECT COUNT(*) FROM m WHERE NOT kept)
UNION ALL SELECT 'total', (SELECT COUNT(*) FROM o) + (SELECT COUNT(*) FROM m WHERE kept)
UNION ALL SELECT 'inserted', (SELECT COUNT(*) FROM o WHERE nominal = 1) + (SELECT COUNT(*) FROM k) - (SELECT n FROM h)
UNION ALL SELECT 'updated', (SELECT COUNT(*) FROM o WHERE nominal <> 1) + (SELECT n FROM h)
UNION ALL SELECT 'rejected', (SELECT COUNT(*) FROM d) - (SELECT COUNT(*) FROM o) + (SELECT 5 * n FROM docs)
UNION ALL SELECT 'total_records', (SELECT COUNT(*) FROM rates) - (SELECT COUNT(*) FROM d WHERE nominal = 1 AND (long_code OR long_name))
                                  + (SELECT COUNT(*) FROM k) - (SELECT n FROM h)"""),
    "daily_xml_rejects": with_rates("""
x AS (SELECT currency_code AS c, currency_name AS n, day(rate_date) IN (3, 17) AS broken FROM rates WHERE rate_type = 'daily')
SELECT CASE WHEN broken THEN 'bad_document' WHEN length(c) > 8 THEN 'code_too_long' WHEN length(n) > 100 THEN 'name_too_long' ELSE 'valid' END AS reason,
       COUNT(*) AS rows FROM x GROUP BY 1"""),
    "period_load": with_rates("""
d AS (SELECT *, CASE WHEN length(currency_code) > 8 THEN 'code_too_long' WHEN length(currency_name) > 100 THEN 'name_too_long' END AS reason
      FROM rates WHERE rate_type = 'daily' AND rate_date BETWEEN DATE '2001-06-01' AND DATE '2001-08-01'),
w AS (SELECT * FROM d WHERE isodow(rate_date) < 6),
cal AS (SELECT CAST(g AS DATE) AS rate_date FROM generate_series(TIMESTAMP '2001-06-01', TIMESTAMP '2001-08-01', INTERVAL 1 DAY) t(g)),
day AS (SELECT c.rate_date, isodow(c.rate_date) > 5 AS weekend, COUNT(w.rate_date) FILTER (reason IS NULL) AS n
        FROM cal c LEFT JOIN w ON w.rate_date = c.rate_date GROUP BY 1, 2),
s AS (SELECT *, CASE WHEN weekend THEN 'skipped' WHEN n = 0 OR rate_date = DATE '2001-06-04' THEN 'failed' ELSE 'done' END AS status FROM day),
after AS (SELECT currency_code, rate_date, rate_type FROM rates EXCEPT
          SELECT currency_code, rate_date, rate_type FROM d WHERE nominal = 1 AND (reason IS NOT NULL OR isodow(rate_date) > 5))
SELECT 'read_days_1' AS name, (SELECT COUNT(*) FROM s WHERE NOT weekend) AS value
UNION ALL SELECT 'read_days_2', (SELECT COUNT(*) FROM s WHERE status = 'failed')
UNION ALL SELECT 'inserted_1', (SELECT COUNT(*) FROM w WHERE reason IS NULL AND nominal = 1)
UNION ALL SELECT 'updated_1', (SELECT COUNT(*) FROM w WHERE reason IS NULL AND nominal <> 1)
UNION ALL SELECT 'inserted_2', 0
UNION ALL SELECT 'updated_2', (SELECT COUNT(*) FROM w JOIN s USING (rate_date) WHERE reason IS NULL AND status = 'failed')
UNION ALL SELECT 'rejected_' || reason, COUNT(*) FROM w WHERE reason IS NOT NULL GROUP BY reason
UNION ALL SELECT 'rejected_bad_document', 1
UNION ALL SELECT 'successful_days', (SELECT COUNT(*) FROM s WHERE status = 'done')
UNION ALL SELECT 'failed_days', (SELECT COUNT(*) FROM s WHERE status = 'failed')
UNION ALL SELECT 'skipped_days', (SELECT COUNT(*) FROM s WHERE status = 'skipped')
UNION ALL SELECT 'total_rows', (SELECT CAST(SUM(n) AS BIGINT) FROM s)
UNION ALL SELECT 'days', 62
UNION ALL SELECT 'records_loaded', (SELECT COUNT(*) FROM after WHERE rate_date BETWEEN DATE '2001-06-01' AND DATE '2001-08-01')
UNION ALL SELECT 'total_records', (SELECT COUNT(*) FROM after)
UNION ALL SELECT 'currencies', (SELECT COUNT(DISTINCT currency_code) FROM after)"""),
})
ORACLE["mart_status"] = with_rates("SELECT mart, true AS exists, rows FROM (" + ORACLE["refresh_marts"].replace("WITH " + RATES_CTE + ", ", "WITH ") + ") WHERE mart <> 'total'").replace(
    ", SELECT mart, true", " SELECT mart, true")

ORACLE["published_weekly_stats"] = ORACLE["weekly_stats"]
ORACLE["upsert_facts"] = with_records("""
b AS (SELECT *, row_number() OVER (PARTITION BY currency_code, rate_date, rate_type ORDER BY seq DESC) AS rn FROM batch),
new AS (SELECT currency_code, exchange_rate, rate_date, rate_type, nominal FROM b WHERE rn = 1)
SELECT currency_code, CAST(exchange_rate AS DOUBLE) AS exchange_rate, rate_date, rate_type, nominal, load_timestamp FROM rates r
WHERE NOT EXISTS (SELECT 1 FROM new n WHERE r.currency_code = n.currency_code AND r.rate_date = n.rate_date AND r.rate_type = n.rate_type)
UNION ALL
SELECT currency_code, CAST(exchange_rate AS DOUBLE), rate_date, rate_type, nominal, CAST(NULL AS TIMESTAMP) FROM new""")

ORACLE["upsert_raw_table"] = ORACLE["upsert_rates"]

_LOADED = _UPSERTED.replace("1, seq FROM batch)", "1, seq FROM batch WHERE rate_date >= DATE '2001-08-01')")


def _after_load(name: str) -> str:
    """A mart's SQL over the relation after the load of the last months."""
    body = ORACLE[name].replace("WITH " + RATES_CTE + ", ", "").replace("FROM rates", "FROM up")
    return with_records(_LOADED + ", " + body.lstrip())


ORACLE.update({
    "moments_weekly_stats": _after_load("weekly_stats"),
    "moments_correlation": _after_load("anchor_correlation"),
    "moments_top_volatile": _after_load("top_volatile"),
    "daily_changes_incremental": _after_load("daily_changes"),
    "load_stats_bitmaps": ORACLE["load_stats"],
    "refresh_log": with_rates("SELECT 'mart refreshed' AS log_message, mart, rows FROM (" + ORACLE["refresh_marts"].replace("WITH " + RATES_CTE + ", ", "WITH ")
                              + ") WHERE mart <> 'total'").replace(", SELECT 'mart refreshed'", " SELECT 'mart refreshed'"),
})

_DRIFT = """
m AS (SELECT *, year(rate_date) % 4 AS way FROM rates WHERE rate_type = 'monthly'),
y AS (SELECT currency_code, year(rate_date) % 4 AS way, COUNT(*) AS n FROM m GROUP BY currency_code, year(rate_date)),
d AS (SELECT way, COUNT(*) AS docs, CAST(SUM(n) AS BIGINT) AS n FROM y GROUP BY way),
"""

ORACLE.update({
    "bucketed_daily_changes": _after_load("daily_changes"),
    "bucketed_monthly_stats": _after_load("monthly_stats"),
    "bucketed_entity": with_records(_LOADED + """
SELECT currency_code, currency_name, CAST(exchange_rate AS DOUBLE) AS exchange_rate, rate_date, rate_type, nominal, load_timestamp
FROM up WHERE currency_code = 'AAA'"""),
    "monthly_json_drift": with_rates(_DRIFT + f"""
x AS (SELECT 1)
SELECT length(currency_code) * 100000 + year(rate_date) AS element_id, {CODE_OF_NAME} AS currency_code, currency_name,
       CAST(exchange_rate AS DOUBLE) AS exchange_rate, rate_date, 'monthly' AS rate_type, 1 AS nominal, strftime(rate_date, '%B %Y') AS period,
       CASE WHEN way = 2 THEN '{{"unit":"RUB"}}' END AS extra
FROM m WHERE way <> 3"""),
    # every document has five items with a defect; where values are objects, those with a known id and a date are all bad values
    "monthly_json_drift_rejects": with_rates(_DRIFT + """
r AS (SELECT way, 'unknown_element' AS reason, docs AS rows FROM d
      UNION ALL SELECT way, 'bad_date', docs FROM d
      UNION ALL SELECT way, 'bad_value', 2 * docs FROM d WHERE way <> 3
      UNION ALL SELECT way, 'value_overflow', docs FROM d WHERE way <> 3
      UNION ALL SELECT way, 'bad_value', n + 3 * docs FROM d WHERE way = 3)
SELECT reason, CASE WHEN way = 2 THEN '{"unit":"RUB"}' END AS extra, CAST(SUM(rows) AS BIGINT) AS rows FROM r GROUP BY ALL"""),
    "monthly_json_fields": with_rates(_DRIFT + """
f AS (SELECT 'document' AS level, unnest(['RawData', 'headerData', 'units']) AS field, 'ARRAY' AS type, docs AS rows FROM d
      UNION ALL SELECT 'headerData', 'id', 'BIGINT', 2 * docs FROM d
      UNION ALL SELECT 'headerData', 'elname', 'STRING', 2 * docs FROM d
      UNION ALL SELECT 'RawData', unnest(['date', 'dt']), 'STRING', n + 5 * docs FROM d
      UNION ALL SELECT 'RawData', 'element_id', CASE WHEN way = 0 THEN 'STRING' ELSE 'BIGINT' END, n + 5 * docs FROM d
      UNION ALL SELECT 'RawData', 'unit', 'STRING', n + 5 * docs FROM d WHERE way = 2
      UNION ALL SELECT 'RawData', 'obs_val', CASE WHEN way = 3 THEN 'OBJECT' ELSE 'STRING' END, n + 5 * docs FROM d WHERE way <> 1
      UNION ALL SELECT 'RawData', 'obs_val', 'STRING', 2 * docs FROM d WHERE way = 1
      UNION ALL SELECT 'RawData', 'obs_val', 'DECIMAL', n + 3 * docs FROM d WHERE way = 1)
SELECT level, field, type, field NOT IN ('units', 'unit') AS known, CAST(SUM(rows) AS BIGINT) AS rows FROM f GROUP BY ALL"""),
})
