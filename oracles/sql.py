"""One SQL text per registered query."""

from __future__ import annotations

TS = r"^\s*\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})?)?\s*$"
NUM = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI]nf(inity)?)\s*$"
TEXT_TS = "%Y-%m-%dT%H:%M:%S.%g"
COLUMNS = ["unique_key", "created_date", "closed_date", "agency", "complaint_type", "descriptor",
           "status", "borough", "incident_zip", "latitude", "longitude"]
LIMITS = {"unique_key": 0, "created_date": 0, "closed_date": 70, "agency": 0, "complaint_type": 0,
          "descriptor": 10, "status": 0, "borough": 0, "incident_zip": 10, "latitude": 10,
          "longitude": 10}
REQUIRED = ["created_date", "agency", "complaint_type", "status", "borough"]
RANGES = {"latitude": (-90, 90), "longitude": (-180, 180)}
DATES = ["created_date", "closed_date"]


def blank(c: str) -> str:
    return rf"({c} IS NULL OR regexp_matches({c}, '^\s*$'))"


def ts(c: str) -> str:
    return f"(CASE WHEN regexp_matches({c}, '{TS}') THEN try_cast({c} AS TIMESTAMP) END)"


def num(c: str) -> str:
    return f"(CASE WHEN regexp_matches({c}, '{NUM}') THEN try_cast({c} AS DOUBLE) END)"


def bad_ts(c: str) -> str:
    return f"(NOT {blank(c)} AND {ts(c)} IS NULL)"


def bad_num(c: str) -> str:
    return f"(NOT {blank(c)} AND {num(c)} IS NULL)"


def out_of_range(c: str) -> str:
    low, high = RANGES[c]
    return f"coalesce({num(c)} < {low} OR {num(c)} > {high}, false)"


REVERSED = f"coalesce({ts('closed_date')} < {ts('created_date')}, false)"
DAY = f"strftime({ts('created_date')}, '%Y-%m-%d')"


def count(condition: str) -> str:
    return f"count_if({condition})::BIGINT"


def pct(part: str, total: str) -> str:
    return f"(CASE WHEN {total} = 0 THEN 0.0 ELSE round(({part})::DOUBLE / ({total})::DOUBLE * 100, 2) END)::DOUBLE"


FEED = f"""feed AS (
  SELECT event_id AS row_id, event_id::VARCHAR AS unique_key,
    strftime(ts, '{TEXT_TS}') AS created_date,
    CASE WHEN event_id % 3 = 0 THEN NULL
         ELSE strftime(ts + to_hours(CAST(event_id % 50 AS INT)), '{TEXT_TS}') END AS closed_date,
    'A' || (user_id % 7)::VARCHAR AS agency, event_type AS complaint_type,
    CASE WHEN event_id % 50 = 0 THEN NULL ELSE props END AS descriptor,
    CASE WHEN event_id % 3 = 0 THEN 'Open' ELSE 'Closed' END AS status,
    'B' || (user_id % 5)::VARCHAR AS borough, lpad(user_id::VARCHAR, 5, '0') AS incident_zip,
    (value / 10)::VARCHAR AS latitude, (-value / 10)::VARCHAR AS longitude, ts
  FROM events)"""

_DIRTY = f"""
  CASE WHEN row_id % 422 = 0 THEN '' WHEN row_id % 211 = 0 THEN '   '
       WHEN row_id % 101 = 0 THEN (row_id - 1)::VARCHAR ELSE unique_key END AS unique_key,
  CASE WHEN row_id % 97 = 0 THEN 'not-a-date' ELSE created_date END AS created_date,
  CASE WHEN row_id % 71 = 0 THEN strftime(ts - INTERVAL 1 DAY, '{TEXT_TS}')
       ELSE closed_date END AS closed_date,
  CASE WHEN row_id % 61 = 0 THEN '  ' ELSE agency END AS agency,
  complaint_type, descriptor, status, borough, incident_zip,
  CASE WHEN row_id % 89 = 0 THEN 'north' WHEN row_id % 83 = 0 THEN '123.5'
       ELSE latitude END AS latitude, longitude"""
DIRTY = f"""{FEED}, dirty AS (
  SELECT row_id, {_DIRTY} FROM feed
  UNION ALL SELECT -1 - row_id, {_DIRTY} FROM feed WHERE row_id % 151 = 0)"""

DUP_KEYS = f"""dup_keys AS (
  SELECT unique_key, count(*)::BIGINT AS n FROM dirty WHERE NOT {blank('unique_key')}
  GROUP BY unique_key HAVING count(*) > 1)"""


def reason_items() -> list[tuple[str, str, str]]:
    """(type, field, condition) of every reject reason, in issue order but for duplicates."""
    items = []
    for c in COLUMNS:
        if c in DATES:
            items.append(("invalid_timestamp", c, bad_ts(c)))
        if c in RANGES:
            items.append(("invalid_numeric_value", c, bad_num(c)))
            items.append(("numeric_out_of_range", c, out_of_range(c)))
    items.append(("missing_unique_key", "unique_key", blank("unique_key")))
    items.append(("invalid_date_order", "closed_date/created_date", REVERSED))
    items += [("missing_required_value", c, blank(c)) for c in REQUIRED]
    return items


DUPLICATED = f"(NOT {blank('unique_key')} AND unique_key IN (SELECT unique_key FROM dup_keys))"
REASON_ROWS = f"""reason_rows AS (
  SELECT row_id, seq, issue_type, affected_field FROM (
""" + "\n    UNION ALL ".join(
    f"SELECT row_id, {i} AS seq, '{t}' AS issue_type, '{f}' AS affected_field FROM dirty WHERE {c}"
    for i, (t, f, c) in enumerate(
        reason_items() + [("duplicate_unique_key", "unique_key", DUPLICATED)])
) + "))"
REJECTED = f"""rejected AS (
  SELECT row_id, string_agg(issue_type || ':' || affected_field, ',' ORDER BY seq) AS reasons
  FROM reason_rows GROUP BY row_id)"""
DIRTY_ALL = f"{DIRTY}, {DUP_KEYS}, {REASON_ROWS}, {REJECTED}"
SAMPLES = """samples AS (
  SELECT issue_type, affected_field, string_agg(row_id::VARCHAR, ',' ORDER BY row_id) AS ids
  FROM (SELECT *, row_number() OVER (PARTITION BY issue_type, affected_field ORDER BY row_id) AS rk
        FROM reason_rows) WHERE rk <= 10 GROUP BY 1, 2)"""

DIGEST_COLUMNS = ", ".join(COLUMNS)


def metrics_sql(table: str) -> str:
    """A one-row CTE body with the quality metrics of a table."""
    bad = " OR ".join(c for _, _, c in reason_items())
    return f"""
  SELECT total_rows_processed, duplicate_row_count,
    {pct('duplicate_row_count', 'total_rows_processed')} AS duplicate_row_percentage,
    duplicate_unique_key_count,
    {pct('duplicate_unique_key_count', 'total_rows_processed')} AS duplicate_unique_key_percentage,
    invalid_timestamp_row_count, invalid_date_order_count, invalid_numeric_row_count,
    missing_unique_key_count, rejected_row_count
  FROM (SELECT count(*)::BIGINT AS total_rows_processed,
      {count(' OR '.join(bad_ts(c) for c in DATES))} AS invalid_timestamp_row_count,
      {count(REVERSED)} AS invalid_date_order_count,
      {count(' OR '.join(f'{bad_num(c)} OR {out_of_range(c)}' for c in RANGES))} AS invalid_numeric_row_count,
      {count(blank('unique_key'))} AS missing_unique_key_count,
      {count(f'copies > 1 AND NOT {blank("unique_key")}')} AS duplicate_unique_key_count,
      {count(f'(copies > 1 AND NOT {blank("unique_key")}) OR {bad}')} AS rejected_row_count
    FROM (SELECT *, count(*) OVER (PARTITION BY unique_key) AS copies FROM {table})),
    (SELECT coalesce(sum(n - 1), 0)::BIGINT AS duplicate_row_count FROM
      (SELECT count(*) AS n FROM {table} GROUP BY {DIGEST_COLUMNS}))"""


METRIC_COLUMNS = ["total_rows_processed", "duplicate_row_count", "duplicate_row_percentage",
                  "duplicate_unique_key_count", "duplicate_unique_key_percentage", "invalid_timestamp_row_count",
                  "invalid_date_order_count", "invalid_numeric_row_count", "missing_unique_key_count",
                  "rejected_row_count"]


def missing_sql(table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS field, count(*)::BIGINT AS total_rows, {count(blank(c))} AS missing_count, "
        f"{LIMITS[c]}::DOUBLE AS threshold FROM {table}" for c in COLUMNS
    )


MISSING = f"""missing AS (
  SELECT *, {pct('missing_count', 'total_rows')} AS missing_percentage FROM ({missing_sql('dirty')}))"""


def issue_rows() -> str:
    """Findings on the dirty feed: type, field, count, number and observed JSON."""
    text = '\'{"count":\' || n || \',"sample_row_ids":[\' || ids || \']}\''
    return f"""issue_rows AS (
  SELECT issue_type, 'error' AS severity, affected_field, {text} AS observed_value,
         n AS issue_count, n::DOUBLE AS observed_number
  FROM (SELECT issue_type, affected_field, count(*)::BIGINT AS n FROM reason_rows GROUP BY 1, 2)
       JOIN samples USING (issue_type, affected_field)
  UNION ALL
  SELECT 'missingness_threshold_exceeded', 'error', field, missing_percentage::VARCHAR,
         missing_count, missing_percentage
  FROM missing WHERE missing_percentage > threshold)"""


ISSUES = f"{DIRTY_ALL}, {SAMPLES}, {MISSING}, {issue_rows()}"
PENALTY = """CASE issue_type WHEN 'missing_required_column' THEN 30 WHEN 'invalid_numeric_value' THEN 15
  WHEN 'unexpected_column' THEN 5 WHEN 'duplicate_unique_key' THEN 10
  WHEN 'missingness_threshold_exceeded' THEN 10 WHEN 'invalid_timestamp' THEN 10
  WHEN 'invalid_date_order' THEN 10 WHEN 'numeric_out_of_range' THEN 10
  WHEN 'missing_unique_key' THEN 10 WHEN 'missing_required_value' THEN 10 ELSE 0 END"""
_CLEAN_ISSUES = " UNION ALL ".join(
    [f"SELECT '{t}' AS issue_type, {count(c)} AS n FROM feed" for t, _, c in reason_items()]
    + [f"SELECT 'missingness_threshold_exceeded', CASE WHEN {pct(count(blank(c)), 'count(*)')} > {LIMITS[c]} THEN 1 ELSE 0 END FROM feed"
       for c in COLUMNS]
    + ["SELECT 'duplicate_unique_key', (count(*) - count(DISTINCT unique_key))::BIGINT FROM feed"]
)
VERDICTS = f"""{ISSUES}, both_issues AS (
  SELECT 'dirty' AS scenario, issue_type FROM issue_rows
  UNION ALL SELECT 'clean', issue_type FROM ({_CLEAN_ISSUES}) WHERE n > 0),
verdicts AS (
  SELECT s.scenario, count(i.issue_type)::BIGINT AS issue_count,
    count_if(coalesce(i.issue_type, '') IN ('missing_required_column', 'unexpected_column',
             'invalid_timestamp', 'invalid_numeric_value')) = 0 AS schema_passed,
    greatest(0, least(100, 100 - coalesce(sum({PENALTY}), 0)))::BIGINT AS reliability_score
  FROM (VALUES ('clean'), ('dirty')) s(scenario) LEFT JOIN both_issues i USING (scenario)
  GROUP BY s.scenario)"""
HEALTH = "CASE WHEN reliability_score >= 90 THEN 'Healthy' WHEN reliability_score >= 75 THEN 'Warning' ELSE 'Critical' END"


# --- volume ------------------------------------------------------------------------
def compare_sql(base: str, current: str, threshold: float, minimum: int, decreases: bool) -> str:
    """Compare two (calendar_date, n) relations."""
    gate = f"(d >= {minimum} AND z >= {threshold})"
    if decreases:
        gate += f" OR (d <= -{minimum} AND z <= -{threshold})"
    return f"""
  SELECT calendar_date, baseline_count, current_count, abs(d)::BIGINT AS absolute_difference,
    round(CASE WHEN baseline_count > 0 THEN d / baseline_count::DOUBLE * 100 END, 6) AS percentage_change,
    round(z, 6) AS standardized_count_difference, ({gate}) AS is_anomaly
  FROM (SELECT *, current_count - baseline_count AS d,
          (current_count - baseline_count) / sqrt(greatest(baseline_count, 1)) AS z
        FROM (SELECT calendar_date, coalesce(b.n, 0)::BIGINT AS baseline_count,
                coalesce(c.n, 0)::BIGINT AS current_count
              FROM {base} b FULL JOIN {current} c USING (calendar_date)))"""


EVENT_DAYS = """
b AS (SELECT strftime(ts, '%Y-%m-%d') AS calendar_date, count(*) AS n FROM events WHERE event_id % 2 = 0 GROUP BY 1),
c AS (SELECT strftime(ts, '%Y-%m-%d') AS calendar_date, count(*) AS n FROM events WHERE event_id % 2 <> 0 GROUP BY 1)"""


def rolling_sql(gate: str) -> str:
    return f"""WITH {FEED}, days AS (
  SELECT {DAY} AS calendar_date, count(*)::BIGINT AS request_count FROM feed GROUP BY 1),
h AS (SELECT *, avg(request_count) OVER w AS m, stddev_pop(request_count) OVER w AS s,
        count(*) OVER w AS k
      FROM days WINDOW w AS (ORDER BY calendar_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
z AS (SELECT calendar_date, request_count, CASE WHEN k >= 3 THEN m END AS m,
        CASE WHEN k >= 3 THEN s END AS s FROM h),
q AS (SELECT *, coalesce(s > 0, false) AS usable,
        CASE WHEN s > 0 THEN (request_count - m) / s END AS zs FROM z)
SELECT calendar_date, request_count, round(m, 6) AS rolling_mean,
  round(s, 6) AS rolling_standard_deviation, round(zs, 6) AS rolling_z_score,
  usable AS history_sufficient, coalesce({gate}, false) AS is_anomaly FROM q"""


# --- drift -------------------------------------------------------------------------
def aligned_sql(parts: list[tuple[str, str, str, str]]) -> str:
    """CTEs for (field, expression, baseline filter, current filter) over given sources."""
    counts = " UNION ALL ".join(
        f"SELECT '{f}' AS field, '{side}' AS side, trim({e}) AS category, count(*) AS n "
        f"FROM {src} WHERE {e} IS NOT NULL AND trim({e}) <> '' GROUP BY 3"
        for f, e, base, cur in parts for side, src in (("b", base), ("c", cur))
    )
    return f"""counts AS ({counts}),
totals AS (SELECT field, coalesce(sum(n) FILTER (side = 'b'), 0) AS bt,
             coalesce(sum(n) FILTER (side = 'c'), 0) AS ct FROM counts GROUP BY field),
aligned AS (
  SELECT field, category, baseline_count, current_count,
    CASE WHEN bt > 0 THEN baseline_count / bt::DOUBLE ELSE 0.0 END AS p,
    CASE WHEN ct > 0 THEN current_count / ct::DOUBLE ELSE 0.0 END AS q
  FROM (SELECT field, category, coalesce(sum(n) FILTER (side = 'b'), 0)::BIGINT AS baseline_count,
          coalesce(sum(n) FILTER (side = 'c'), 0)::BIGINT AS current_count
        FROM counts GROUP BY field, category) JOIN totals USING (field))"""


JSD = """sqrt(greatest(sum(
    CASE WHEN p > 0 THEN 0.5 * p * log2(p / ((p + q) / 2)) ELSE 0 END
  + CASE WHEN q > 0 THEN 0.5 * q * log2(q / ((p + q) / 2)) ELSE 0 END), 0))"""
SHIFTED = "(baseline_count > 0 AND current_count > 0 AND abs(q - p) >= 0.02)"
NEW = "(baseline_count = 0 AND (current_count >= 10 OR q >= 0.01))"
GONE = "(current_count = 0 AND baseline_count >= 10)"
HALVES = f"""{FEED},
f1 AS (SELECT * FROM feed WHERE substr(created_date, 9, 2) < '16'),
f2 AS (SELECT * FROM feed WHERE NOT substr(created_date, 9, 2) < '16'),
{aligned_sql([('complaint_type', 'complaint_type', 'f1', 'f2'), ('borough', 'borough', 'f1', 'f2')])}"""
_YEAR = "year(o_orderdate)::VARCHAR"
YEARS = f"""o1 AS (SELECT * FROM orders WHERE year(o_orderdate) <= 1995),
o2 AS (SELECT * FROM orders WHERE year(o_orderdate) >= 1994),
{aligned_sql([('order_year', _YEAR, 'o1', 'o2'), ('o_orderpriority', 'o_orderpriority', 'o1', 'o2')])}"""


def verdict_sql(alert: str) -> str:
    return f"""found AS (
  SELECT field, {JSD} AS d, {count(SHIFTED)} AS sh, {count(NEW)} AS nw, {count(GONE)} AS gn
  FROM aligned GROUP BY field),
verdict AS (
  SELECT field, true AS field_available, round(d, 9) AS jensen_shannon_distance,
    sh AS shifted_count, nw AS new_count, gn AS disappearing_count,
    d >= 0.05 AND (sh > 0 OR gn > 0) AS category_drift, field = '{alert}' AND nw > 0 AS unexpected_category,
    (d >= 0.05 AND (sh > 0 OR gn > 0)) OR (field = '{alert}' AND nw > 0) AS drift_detected
  FROM found)"""


def frequencies_sql(source: str, fields: list[str]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{f}' AS field, trim({f}::VARCHAR) AS category, count(*)::BIGINT AS n FROM {source} "
        f"WHERE {f} IS NOT NULL AND trim({f}::VARCHAR) <> '' GROUP BY 2" for f in fields
    )
    return f"""SELECT field, category, n, round(n / sum(n) OVER (PARTITION BY field)::DOUBLE, 6) AS frequency
  FROM ({parts})"""


# --- faults --------------------------------------------------------------------------
FEED_COLUMNS = ["row_id", *COLUMNS]
SCENARIOS = {  # name: (seed, kind, expected labels, affected columns)
    "deleted_required_agency_column": (101, "deleted_required_column", "missing_required_column", "agency"),
    "renamed_complaint_type_column": (102, "renamed_column", "missing_required_column,unexpected_column", "complaint_type,complaint_category"),
    "invalid_latitude_text": (103, "invalid_numeric_text", "invalid_numeric_value", "latitude"),
    "duplicate_rows_preserved_unique_keys": (104, "duplicate_rows", "duplicate_unique_key", "unique_key"),
    "invalid_created_date_text": (105, "invalid_timestamp_text", "invalid_timestamp", "created_date"),
    "descriptor_missingness_plus_10_points": (106, "increased_missingness", "missingness_threshold_exceeded", "descriptor"),
    "descriptor_missingness_plus_25_points": (107, "increased_missingness", "missingness_threshold_exceeded", "descriptor"),
    "descriptor_missingness_plus_50_points": (108, "increased_missingness", "missingness_threshold_exceeded", "descriptor"),
    "daily_request_volume_spike": (109, "volume_spike", "volume_anomaly", "created_date,unique_key"),
    "complaint_type_frequency_shift": (110, "category_frequency_shift", "category_drift", "complaint_type"),
    "unseen_complaint_type_category": (111, "unseen_category", "unexpected_category", "complaint_type"),
    "closed_date_before_created_date": (112, "reversed_date_order", "invalid_date_order", "created_date,closed_date"),
}
MODE = """mode AS (SELECT complaint_type AS m, count(*) AS mode_rows FROM feed WHERE complaint_type IS NOT NULL
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1)"""
BUSIEST = f"""busiest AS (SELECT {DAY} AS d, count(*) AS day_rows FROM feed WHERE {DAY} IS NOT NULL
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1)"""
STATS = f"""stats AS (SELECT count(*) AS n, max(row_id) AS max_id, min(row_id) AS min_id,
    max(try_cast(unique_key AS BIGINT)) AS max_key, count_if(NOT {blank('descriptor')}) AS filled FROM feed)"""


def scaled(size: int) -> str:
    return f"(-((-n * {size}) // 5000))"


def points(pp: int) -> str:
    return f"least(-((-n * {pp}) // 100), filled)"


# (sampled set, eligibility, size, changed column, new value)
_ISO = "%Y-%m-%dT%H:%M:%S.000"
VALUE_FAULTS = {
    "invalid_latitude_text": ("true", scaled(50), "latitude", "'invalid-latitude'"),
    "invalid_created_date_text": ("true", scaled(50), "created_date", "'invalid-created-date'"),
    "descriptor_missingness_plus_10_points": (f"NOT {blank('descriptor')}", points(10), "descriptor", "NULL"),
    "descriptor_missingness_plus_25_points": (f"NOT {blank('descriptor')}", points(25), "descriptor", "NULL"),
    "descriptor_missingness_plus_50_points": (f"NOT {blank('descriptor')}", points(50), "descriptor", "NULL"),
    "complaint_type_frequency_shift": ("complaint_type IS DISTINCT FROM (SELECT m FROM mode)", scaled(1000), "complaint_type", "(SELECT m FROM mode)"),
    "unseen_complaint_type_category": ("true", scaled(250), "complaint_type", "'Synthetic Unseen Complaint Type'"),
    "closed_date_before_created_date": (f"{ts('created_date')} IS NOT NULL", scaled(100), "closed_date",
                                        f"strftime({ts('created_date')} - INTERVAL 1 DAY, '{_ISO}')"),
}


def sample_sql(name: str, eligible: str, size: str) -> str:
    seed = SCENARIOS[name][0]
    return f"""(SELECT row_id FROM (
    SELECT row_id, row_number() OVER (ORDER BY md5('{seed}|' || row_id), row_id) AS rk
    FROM feed WHERE {eligible}) WHERE rk <= (SELECT {size} FROM stats))"""


def fault_sql(name: str) -> str:
    """SELECT of one corrupted table."""
    plain = ", ".join(FEED_COLUMNS)
    if name in VALUE_FAULTS:
        eligible, size, column, value = VALUE_FAULTS[name]
        hit = f"row_id IN {sample_sql(name, eligible, size)}"
        cols = ", ".join(
            f"CASE WHEN {hit} THEN {value} ELSE {column} END AS {column}" if c == column else c
            for c in FEED_COLUMNS)
        return f"SELECT {cols} FROM feed"
    if name == "deleted_required_agency_column":
        return f"SELECT {', '.join(c for c in FEED_COLUMNS if c != 'agency')} FROM feed"
    if name == "renamed_complaint_type_column":
        return "SELECT " + ", ".join(
            "complaint_type AS complaint_category" if c == "complaint_type" else c
            for c in FEED_COLUMNS) + " FROM feed"
    if name == "duplicate_rows_preserved_unique_keys":
        moved = ", ".join("row_id - min_id + max_id + 1 AS row_id" if c == "row_id" else c
                          for c in FEED_COLUMNS)
        return f"""SELECT {plain} FROM feed UNION ALL
  SELECT {moved} FROM feed, stats WHERE row_id IN {sample_sql(name, 'true', scaled(100))}"""
    moved = ", ".join(
        {"row_id": "max_id + 1 + pick AS row_id",
         "unique_key": "(max_key + 1 + pick)::VARCHAR AS unique_key"}.get(c, c) for c in FEED_COLUMNS)
    return f"""SELECT {plain} FROM feed UNION ALL
  SELECT {moved} FROM {SPIKED_ROWS}, stats"""


def levels_sql(sizes: str) -> str:
    """CTE ``levels`` (level from 0, size, levels): rows picked more often than ``level`` times.

    ``sizes`` selects k (picks) and n (rows); picks a row are Poisson distributed.
    """
    return f"""kn AS ({sizes}),
pmf AS (SELECT m, k, n, k / n::DOUBLE AS rate,
  exp(-(k / n::DOUBLE) + m * ln(k / n::DOUBLE) - lgamma(m + 1)) AS p FROM kn, range(0, 100) r(m)),
cdf AS (SELECT *, sum(p) OVER (ORDER BY m) AS upto FROM pmf),
sums AS (
  SELECT 0 AS level, k AS picks FROM kn UNION ALL
  SELECT m + 1, floor(n * (rate * (1 - (upto - p)) - (m + 1) * (1 - upto)) + 0.5)::BIGINT FROM cdf),
levels AS (
  SELECT level, picks - lead(picks) OVER (ORDER BY level) AS size, count(*) FILTER (picks > 0) OVER () AS levels
  FROM sums QUALIFY picks > 0)"""


SPIKED_ROWS = f"""(WITH {levels_sql(f'SELECT {scaled(500)} AS k, day_rows AS n FROM stats, busiest')}
  SELECT e.*, (e.row_id - min_id) * levels + level AS pick
  FROM (SELECT *, row_number() OVER (ORDER BY md5('109|' || row_id), row_id) - 1 AS pos FROM feed
        WHERE {DAY} = (SELECT d FROM busiest)) e JOIN levels ON pos < size, stats)"""
FAULTS = f"{FEED}, {STATS}, {MODE}, {BUSIEST}"
AFFECTED = {
    "deleted_required_agency_column": "n", "renamed_complaint_type_column": "n",
    "duplicate_rows_preserved_unique_keys": scaled(100), "daily_request_volume_spike": scaled(500),
    **{name: size for name, (_, size, _, _) in VALUE_FAULTS.items()},
}


def manifest_sql() -> str:
    rows = []
    for name, (seed, kind, expected, columns) in SCENARIOS.items():
        empty = kind == "increased_missingness"
        before = pct("n - filled", "n") if empty else "NULL::DOUBLE"
        after = pct(f"n - filled + {AFFECTED[name]}", "n") if empty else "NULL::DOUBLE"
        rows.append(f"""SELECT '{name}' AS scenario_name, '{kind}' AS fault_type,
  '{expected}' AS expected_issue_types, '{columns}' AS affected_columns,
  ({AFFECTED[name]})::BIGINT AS affected_row_count, {seed}::BIGINT AS random_seed,
  {before} AS baseline_missingness_percentage, {after} AS resulting_missingness_percentage FROM stats""")
    return f"WITH {FAULTS} " + " UNION ALL ".join(rows)


# --- evaluation ------------------------------------------------------------------------
CLEAN = "clean_baseline"
NAMES = [CLEAN, *SCENARIOS]
TYPES = ["missing_required_column", "unexpected_column", "invalid_numeric_value",
         "duplicate_unique_key", "volume_anomaly", "category_drift", "unexpected_category",
         "invalid_timestamp", "missingness_threshold_exceeded", "invalid_date_order"]


def tagged(name: str) -> str:
    body = "SELECT * FROM feed" if name == CLEAN else fault_sql(name)
    columns = []
    for c in COLUMNS:
        if name == "deleted_required_agency_column" and c == "agency":
            columns.append("NULL::VARCHAR AS agency")
        elif name == "renamed_complaint_type_column" and c == "complaint_type":
            columns.append("NULL::VARCHAR AS complaint_type")
        else:
            columns.append(c)
    extra = "complaint_category" if name == "renamed_complaint_type_column" else "NULL::VARCHAR AS complaint_category"
    return f"SELECT '{name}' AS scenario, {', '.join(columns)}, {extra} FROM ({body})"


def _held(c: str) -> str:
    """Is the column part of the scenario's table?"""
    absent = {"agency": "deleted_required_agency_column",
              "complaint_type": "renamed_complaint_type_column"}.get(c)
    return f"scenario <> '{absent}'" if absent else "true"


ALL = f"{FAULTS}, every_row AS (" + " UNION ALL ".join(tagged(n) for n in NAMES) + ")"
_FLAGS = {
    "invalid_timestamp": " OR ".join(bad_ts(c) for c in DATES),
    "invalid_numeric_value": " OR ".join(bad_num(c) for c in RANGES),
    "numeric_out_of_range": " OR ".join(out_of_range(c) for c in RANGES),
    "invalid_date_order": REVERSED,
    "missing_unique_key": blank("unique_key"),
    "missing_required_value": " OR ".join(f"({_held(c)} AND {blank(c)})" for c in REQUIRED),
}
_MISS = " UNION ALL ".join(
    f"SELECT scenario, 'missingness_threshold_exceeded' AS issue_type FROM every_row WHERE {_held(c)} "
    f"GROUP BY scenario HAVING {pct(count(blank(c)), 'count(*)')} > {LIMITS[c]}" for c in COLUMNS
)
_SCENARIO_DRIFT = f"""
s_counts AS (
  SELECT scenario, 'complaint_type' AS field, trim(complaint_type) AS category, count(*) AS n
  FROM every_row WHERE trim(complaint_type) <> '' GROUP BY 1, 3
  UNION ALL SELECT scenario, 'borough', trim(borough), count(*) FROM every_row
  WHERE trim(borough) <> '' GROUP BY 1, 3),
s_freq AS (SELECT *, n / sum(n) OVER (PARTITION BY scenario, field)::DOUBLE AS share FROM s_counts),
s_names AS (SELECT unnest([{', '.join(repr(n) for n in NAMES)}]) AS scenario),
s_pairs AS (
  SELECT scenario, field, category FROM s_freq
  UNION SELECT s.scenario, field, category FROM s_names s, s_freq f WHERE f.scenario = '{CLEAN}'),
s_aligned AS (
  SELECT x.scenario, x.field, coalesce(b.n, 0) AS baseline_count, coalesce(c.n, 0) AS current_count,
    coalesce(b.share, 0) AS p, coalesce(c.share, 0) AS q
  FROM s_pairs x
  LEFT JOIN s_freq b ON b.scenario = '{CLEAN}' AND b.field = x.field AND b.category = x.category
  LEFT JOIN s_freq c ON c.scenario = x.scenario AND c.field = x.field AND c.category = x.category
  WHERE NOT (x.scenario = 'renamed_complaint_type_column' AND x.field = 'complaint_type')),
s_drift AS (
  SELECT scenario, field, {JSD} >= 0.05 AND count_if({SHIFTED} OR {GONE}) > 0 AS drifted,
    field = 'complaint_type' AND count_if({NEW}) > 0 AS unseen
  FROM s_aligned GROUP BY 1, 2)"""
_SCENARIO_VOLUME = f"""
s_days AS (SELECT scenario, {DAY} AS d, count(*) AS n FROM every_row WHERE {DAY} IS NOT NULL GROUP BY 1, 2),
s_volume AS (
  SELECT DISTINCT c.scenario FROM s_days c LEFT JOIN s_days b ON b.scenario = '{CLEAN}' AND b.d = c.d
  WHERE c.n - coalesce(b.n, 0) >= 200
    AND (c.n - coalesce(b.n, 0)) / sqrt(greatest(coalesce(b.n, 0), 1)) >= 3)"""
LABELS = f"""{ALL},{_SCENARIO_DRIFT},{_SCENARIO_VOLUME},
labels_found AS (
  SELECT DISTINCT scenario, issue_type FROM (
  SELECT scenario, 'volume_anomaly' AS issue_type FROM s_volume
  UNION ALL SELECT scenario, 'category_drift' FROM s_drift WHERE drifted
  UNION ALL SELECT scenario, 'unexpected_category' FROM s_drift WHERE unseen
  UNION ALL SELECT * FROM (VALUES ('deleted_required_agency_column', 'missing_required_column'),
    ('renamed_complaint_type_column', 'missing_required_column'),
    ('renamed_complaint_type_column', 'unexpected_column'))
  UNION ALL {" UNION ALL ".join(f"SELECT scenario, '{t}' FROM every_row WHERE {c}" for t, c in _FLAGS.items())}
  UNION ALL SELECT scenario, 'duplicate_unique_key' FROM every_row WHERE NOT {blank('unique_key')}
    GROUP BY scenario, unique_key HAVING count(*) > 1
  UNION ALL {_MISS}))"""
_EXPECTED = ", ".join(
    f"('{n}', '{label}')" for n, (_, _, e, _) in SCENARIOS.items() for label in e.split(","))
MATRIX = f"""{LABELS}, wanted AS (SELECT * FROM (VALUES {_EXPECTED}) v(scenario, issue_type)),
types AS (SELECT unnest([{', '.join(repr(t) for t in TYPES)}]) AS issue_type),
matrix AS (
  SELECT s.scenario, t.issue_type, w.scenario IS NOT NULL AS expected, f.scenario IS NOT NULL AS detected,
    CASE WHEN w.scenario IS NOT NULL AND f.scenario IS NOT NULL THEN 'true_positive'
         WHEN w.scenario IS NOT NULL THEN 'false_negative'
         WHEN f.scenario IS NOT NULL THEN 'false_positive' ELSE 'true_negative' END AS outcome
  FROM s_names s CROSS JOIN types t
  LEFT JOIN wanted w ON w.scenario = s.scenario AND w.issue_type = t.issue_type
  LEFT JOIN labels_found f ON f.scenario = s.scenario AND f.issue_type = t.issue_type),
sizes AS (SELECT scenario, count(*)::BIGINT AS row_count FROM every_row GROUP BY 1)"""


def ratio(a: str, b: str) -> str:
    return f"(CASE WHEN {b} = 0 THEN 0.0 ELSE round({a} / ({b})::DOUBLE, 6) END)::DOUBLE"


# Quality metrics of all scenarios: a row is judged only on the columns its table has.
_S_BAD = " OR ".join(f"({c})" for c in _FLAGS.values())
_S_COLS = ", ".join([*COLUMNS, "complaint_category"])
SCENARIO_METRICS = f"""WITH {ALL}, judged AS (
  SELECT *, count(*) OVER (PARTITION BY scenario, unique_key) AS copies,
    row_number() OVER (PARTITION BY scenario, {_S_COLS}) AS copy_number FROM every_row)
SELECT scenario, total_rows_processed, duplicate_row_count,
  {pct('duplicate_row_count', 'total_rows_processed')} AS duplicate_row_percentage,
  duplicate_unique_key_count,
  {pct('duplicate_unique_key_count', 'total_rows_processed')} AS duplicate_unique_key_percentage,
  invalid_timestamp_row_count, invalid_date_order_count, invalid_numeric_row_count,
  missing_unique_key_count, rejected_row_count
FROM (SELECT scenario, count(*)::BIGINT AS total_rows_processed,
    {count('copy_number > 1')} AS duplicate_row_count,
    {count('copies > 1')} AS duplicate_unique_key_count,
    {count(_FLAGS['invalid_timestamp'])} AS invalid_timestamp_row_count,
    {count(REVERSED)} AS invalid_date_order_count,
    {count(f"{_FLAGS['invalid_numeric_value']} OR {_FLAGS['numeric_out_of_range']}")} AS invalid_numeric_row_count,
    {count(blank('unique_key'))} AS missing_unique_key_count,
    {count(f'copies > 1 OR {_S_BAD}')} AS rejected_row_count
  FROM judged GROUP BY scenario)"""


def cells(items: list[tuple[str, str]]) -> str:
    return f"WITH {DIRTY} " + " UNION ALL ".join(
        f"SELECT row_id, '{f}' AS field, {f} AS value FROM dirty WHERE {c}" for f, c in items)


_SPIKED = f"""{FAULTS}, spiked AS ({fault_sql('daily_request_volume_spike')}),
b AS (SELECT {DAY} AS calendar_date, count(*) AS n FROM feed GROUP BY 1),
c AS (SELECT {DAY} AS calendar_date, count(*) AS n FROM spiked GROUP BY 1),
cmp AS ({compare_sql('b', 'c', 3.0, 200, False)})"""

ORACLE: dict[str, str] = {
    "ingest_project": f"WITH {FEED} SELECT {', '.join(c for c in COLUMNS if c != 'incident_zip')} FROM feed",
    "recent_top_n": f"WITH {FEED} SELECT {', '.join(COLUMNS)} FROM feed ORDER BY created_date DESC, unique_key LIMIT 5000",
    "ingest_metadata": f"""WITH {FEED} SELECT 'events' AS source_url, count(*)::BIGINT AS rows_downloaded,
  {len(COLUMNS)}::BIGINT AS columns_downloaded, '{','.join(COLUMNS)}' AS column_names,
  max(created_date) AS latest_created_date FROM feed""",
    "ingest_metadata_dirty": f"""WITH {DIRTY} SELECT 'events' AS source_url, count(*)::BIGINT AS rows_downloaded,
  {len(COLUMNS)}::BIGINT AS columns_downloaded, '{','.join(COLUMNS)}' AS column_names,
  strftime(max({ts('created_date')}), '{TEXT_TS}') AS latest_created_date FROM dirty""",
    "blank_rows": f"WITH {DIRTY} SELECT * FROM (SELECT row_id, concat_ws(',', "
                  + ", ".join(f"CASE WHEN {blank(c)} THEN '{c}' END" for c in COLUMNS)
                  + ") AS blank_fields FROM dirty) WHERE blank_fields <> ''",
    "invalid_timestamps": cells([(c, bad_ts(c)) for c in DATES]),
    "invalid_numerics": cells([(c, bad_num(c)) for c in RANGES]),
    "numeric_out_of_range": cells([(c, out_of_range(c)) for c in RANGES]),
    "numeric_out_of_range_customer": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0",
    "date_order_violations": f"WITH {DIRTY} SELECT row_id, created_date, closed_date FROM dirty WHERE {REVERSED}",
    "date_order_violations_lineitem": """SELECT l_orderkey, l_linenumber,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ordered, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipped
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate""",
    "schema_issues": f"""WITH {ISSUES} SELECT issue_type, affected_field, severity,
    CASE WHEN issue_type = 'missingness_threshold_exceeded' THEN observed_value
         ELSE '{{"count":' || issue_count || '}}' END AS observed_value, issue_count
  FROM issue_rows WHERE affected_field NOT IN ('agency', 'complaint_type')
  UNION ALL VALUES ('missing_required_column', 'agency', 'error', '{{"present":false}}', 1),
    ('missing_required_column', 'complaint_type', 'error', '{{"present":false}}', 1),
    ('unexpected_column', 'complaint_category', 'error', '{{"present":true}}', 1)""",
    "normalize_labels": r"""SELECT regexp_replace(trim(regexp_replace(lower('  ' || o_orderpriority || ' - Type '), '[-\s]+', ' ', 'g')), '\s+', '_', 'g') AS label,
  count(*)::BIGINT AS n FROM orders GROUP BY 1""",
    "missing_keys": f"WITH {DIRTY} SELECT count(*)::BIGINT AS total_rows_processed, {count(blank('unique_key'))} AS missing_unique_key_count FROM dirty",
    "missing_required_values": f"WITH {DIRTY}, {MISSING} SELECT field, missing_count FROM missing WHERE missing_count > 0 AND field IN ({', '.join(repr(c) for c in REQUIRED)})",
    "missingness": f"WITH {DIRTY}, {MISSING} SELECT field, total_rows, missing_count, missing_percentage FROM missing",
    "missingness_exceeded": f"WITH {DIRTY}, {MISSING} SELECT field, missing_percentage AS observed_missing_percentage, threshold AS maximum_missing_percentage FROM missing WHERE missing_percentage > threshold",
    "missingness_vs_threshold": f"WITH {DIRTY}, {MISSING} SELECT field, missing_percentage, threshold, missing_percentage > threshold AS exceeded FROM missing",
    "datatype_profile": f"WITH {DIRTY} " + " UNION ALL ".join(
        [f"SELECT '{f}' AS field, '{t}' AS \"check\", {count(c)} AS row_count FROM dirty"
         for t, f, c in reason_items() if t in ("invalid_timestamp", "invalid_numeric_value", "numeric_out_of_range")]
        + [f"SELECT '*', 'invalid_timestamp_rows', {count(' OR '.join(bad_ts(c) for c in DATES))} FROM dirty",
           f"SELECT '*', 'invalid_numeric_rows', {count(' OR '.join(f'{bad_num(c)} OR {out_of_range(c)}' for c in RANGES))} FROM dirty"]),
    "duplicate_rows": f"""WITH {DIRTY} SELECT total_rows, duplicate_row_count, {pct('duplicate_row_count', 'total_rows')} AS duplicate_row_percentage
  FROM (SELECT sum(n)::BIGINT AS total_rows, sum(n - 1)::BIGINT AS duplicate_row_count FROM (SELECT count(*) AS n FROM dirty GROUP BY {DIGEST_COLUMNS}))""",
    "duplicate_rows_documents": f"""SELECT total_rows, duplicate_row_count, {pct('duplicate_row_count', 'total_rows')} AS duplicate_row_percentage
  FROM (SELECT sum(n)::BIGINT AS total_rows, sum(n - 1)::BIGINT AS duplicate_row_count FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang))""",
    "duplicate_keys": f"WITH {DIRTY}, {DUP_KEYS} SELECT * FROM dup_keys",
    "duplicate_keys_lineitem": "SELECT l_orderkey, l_linenumber, count(*)::BIGINT AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "duplicate_key_rows": f"WITH {DIRTY}, {DUP_KEYS} SELECT row_id, unique_key, created_date FROM dirty WHERE {DUPLICATED}",
    "duplicate_key_rows_lineitem": """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
  WHERE (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
    "duplicate_key_rows_part": """WITH keyed AS (SELECT p_partkey,
    CASE WHEN p_partkey % 100 IN (0, 1) THEN 0.0 ELSE floor(p_retailprice) END AS price FROM part)
  SELECT p_partkey FROM keyed WHERE price IN (SELECT price FROM keyed GROUP BY price HAVING count(*) > 1)""",
    "quality_metrics": f"WITH {DIRTY} {metrics_sql('dirty')}",
    "quality_metrics_clean": f"WITH {FEED} {metrics_sql('feed')}",
    "rejected_rows": f"WITH {DIRTY_ALL} SELECT row_id, reasons FROM rejected",
    "rejected_count": f"WITH {DIRTY_ALL} SELECT count(*)::BIGINT AS rejected_row_count FROM rejected",
    "rejected_preview": f"WITH {DIRTY_ALL} SELECT d.*, reasons AS reject_reasons FROM dirty d JOIN rejected USING (row_id) ORDER BY row_id LIMIT 25",
    "issue_samples": f"WITH {DIRTY_ALL}, {SAMPLES} SELECT issue_type, affected_field, ids AS sample_row_ids FROM samples",
    "validation_issues": f"WITH {ISSUES} SELECT issue_type, severity, affected_field, observed_value, issue_count, round(observed_number, 6) AS observed_number FROM issue_rows",
    "validation_verdict": f"WITH {VERDICTS} SELECT scenario, issue_count = 0 AS validation_passed, schema_passed, issue_count FROM verdicts",
    "reliability_score": f"WITH {VERDICTS} SELECT scenario, reliability_score, {HEALTH} AS health_status FROM verdicts",
    "incidents": f"WITH {ISSUES} SELECT severity, issue_type, affected_field, observed_value FROM issue_rows",
    "kpi_overview": f"""WITH {VERDICTS}, metric_row AS ({metrics_sql('dirty')}),
  wide AS (SELECT issue_count = 0 AS validation_passed, schema_passed, issue_count, reliability_score, {HEALTH} AS health_status, m.*
    FROM verdicts, metric_row m WHERE scenario = 'dirty')
  UNPIVOT (SELECT COLUMNS(*)::VARCHAR FROM wide) ON COLUMNS(*) INTO NAME metric VALUE value""",
    "report_fields": f"""WITH {VERDICTS}, metric_row AS ({metrics_sql('dirty')}),
  wide AS (SELECT 'events' AS source_url,
      (SELECT strftime(max({ts('created_date')}), '{TEXT_TS}') FROM dirty) AS latest_source_data_timestamp,
      m.total_rows_processed AS rows_processed, reliability_score, {HEALTH} AS health_status,
      issue_count = 0 AS validation_passed, schema_passed, issue_count,
      {', '.join(f'm.{c} AS "quality_metrics.{c}"' for c in METRIC_COLUMNS)},
      {', '.join(f"(SELECT missing_percentage FROM missing WHERE field = '{c}') AS " + '"quality_metrics.missing_value_percentages.' + c + '"' for c in COLUMNS)}
    FROM verdicts, metric_row m WHERE scenario = 'dirty')
  UNPIVOT (SELECT COLUMNS(*)::VARCHAR FROM wide) ON COLUMNS(*) INTO NAME field VALUE value""",
    "report_incidents": f"WITH {ISSUES} SELECT issue_type, severity, affected_field, observed_value FROM issue_rows",
    "daily_counts": f"WITH {FEED} SELECT {DAY} AS calendar_date, count(*)::BIGINT AS request_count FROM feed GROUP BY 1",
    "daily_counts_orders": "SELECT strftime(o_orderdate, '%Y-%m-%d') AS calendar_date, count(*)::BIGINT AS request_count FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1",
    "volume_compare": f"WITH {EVENT_DAYS} {compare_sql('b', 'c', 3.0, 200, False)}",
    "volume_compare_decrease": f"WITH {EVENT_DAYS} {compare_sql('b', 'c', 0.5, 5, True)}",
    "volume_rolling": rolling_sql("(usable AND request_count - m >= 10 AND zs >= 1.5)"),
    "volume_rolling_decrease": rolling_sql("(usable AND request_count - m <= -10 AND zs <= -1.5)"),
    "volume_issues": f"""WITH {_SPIKED} SELECT 'volume_anomaly' AS issue_type, 'warning' AS severity,
  'created_date' AS affected_field, current_count AS issue_count,
  round(standardized_count_difference, 6) AS observed_number, calendar_date, baseline_count FROM cmp WHERE is_anomaly""",
    "volume_anomaly_days": f"WITH {_SPIKED} SELECT calendar_date, baseline_count, current_count, absolute_difference FROM cmp WHERE is_anomaly",
    "category_frequencies": f"WITH {FEED} {frequencies_sql('feed', ['complaint_type', 'borough'])}",
    "category_frequencies_documents": frequencies_sql("documents", ["lang", "source"]),
    "category_frequencies_labels": frequencies_sql("labels", ["quality", "toxic"]),
    "js_distance": f"WITH {HALVES} SELECT field, round({JSD}, 9) AS jensen_shannon_distance FROM aligned GROUP BY field",
    "shifted_categories": f"WITH {YEARS} SELECT field, category, round(p, 6) AS baseline_frequency, round(q, 6) AS current_frequency, round(abs(q - p), 6) AS absolute_frequency_change FROM aligned WHERE {SHIFTED}",
    "new_categories": f"WITH {YEARS} SELECT field, category, current_count AS count, round(q, 6) AS frequency FROM aligned WHERE {NEW}",
    "disappearing_categories": f"WITH {YEARS} SELECT field, category, baseline_count, round(p, 6) AS baseline_frequency FROM aligned WHERE {GONE}",
    "disappearing_categories_documents": f"""WITH long_docs AS (SELECT lang || '-' || source AS origin FROM documents WHERE n_chars > 500),
  short_docs AS (SELECT lang || '-' || source AS origin FROM documents WHERE n_chars <= 500),
  {aligned_sql([('origin', 'origin', 'long_docs', 'short_docs')])}
  SELECT field, category, baseline_count, round(p, 6) AS baseline_frequency FROM aligned
  WHERE current_count = 0 AND baseline_count >= 1""",
    "drift_findings": f"""WITH l1 AS (SELECT l_suppkey || '/' || (l_partkey % 16) AS source FROM lineitem WHERE l_returnflag = 'A'),
  l2 AS (SELECT l_suppkey || '/' || (l_partkey % 16) AS source FROM lineitem WHERE l_returnflag <> 'A'),
  {aligned_sql([('source', 'source', 'l1', 'l2')])},
  told AS (SELECT *, CASE WHEN baseline_count > 0 AND current_count > 0 AND abs(q - p) >= 1e-5 THEN 'shifted'
      WHEN baseline_count = 0 AND (current_count >= 2 OR q >= 0.01) THEN 'new'
      WHEN current_count = 0 AND baseline_count >= 2 THEN 'gone' END AS kind FROM aligned)
  SELECT field, kind, category, baseline_count, current_count, round(p, 6) AS baseline_frequency,
    round(q, 6) AS current_frequency FROM told WHERE kind IS NOT NULL""",
    "drift_verdict": f"WITH {YEARS}, {verdict_sql('order_year')} SELECT * FROM verdict",
    "drift_multi_field": f"WITH {HALVES}, {verdict_sql('complaint_type')} SELECT * FROM verdict",
    "drift_issues": f"""WITH {YEARS}, {verdict_sql('order_year')}
  SELECT 'category_drift' AS issue_type, 'warning' AS severity, field AS affected_field,
    shifted_count + disappearing_count AS issue_count, jensen_shannon_distance AS observed_number,
    shifted_count, disappearing_count, NULL::BIGINT AS new_count, 'drift_findings' AS findings_table FROM verdict WHERE category_drift
  UNION ALL SELECT 'unexpected_category', 'warning', field, new_count, new_count::DOUBLE,
    NULL, NULL, new_count, 'drift_findings' FROM verdict WHERE unexpected_category""",
    "top_categories": f"""WITH l1 AS (SELECT * FROM lineitem WHERE l_returnflag = 'A'), l2 AS (SELECT * FROM lineitem WHERE l_returnflag <> 'A'),
  {aligned_sql([('supplier', 'l_suppkey::VARCHAR', 'l1', 'l2')])}
  SELECT category, baseline_count, current_count, round(p, 6) AS baseline_frequency, round(q, 6) AS current_frequency
  FROM aligned ORDER BY greatest(p, q) DESC, category LIMIT 12""",
    "seeded_sample": f"WITH {FEED} SELECT {', '.join(FEED_COLUMNS)} FROM feed ORDER BY md5('7|' || row_id), row_id LIMIT 137",
    "sample_with_replacement": f"""WITH {FEED}, open_rows AS (
    SELECT row_id, created_date, row_number() OVER (ORDER BY md5('7|' || row_id), row_id) - 1 AS pos FROM feed WHERE status = 'Open'),
  k AS (SELECT count(*) AS n FROM open_rows), picks AS (SELECT unnest(range(n // 2)) AS pick FROM k)
  SELECT row_id, created_date, pick FROM picks JOIN open_rows
    ON pos = ('0x' || substr(md5('7|draw|' || pick), 1, 15))::BIGINT % (SELECT n FROM k)""",
    "fault_manifest": manifest_sql(),
    "detected_labels": f"WITH {LABELS} SELECT * FROM labels_found",
    "confusion_matrix": f"WITH {MATRIX} SELECT * FROM matrix",
    "scenario_results": f"""WITH {MATRIX},
  e AS (SELECT scenario, string_agg(issue_type, ', ' ORDER BY issue_type) AS t FROM wanted GROUP BY 1),
  d AS (SELECT scenario, string_agg(issue_type, ', ' ORDER BY issue_type) AS t FROM labels_found GROUP BY 1),
  v AS (SELECT scenario, bool_and(expected = detected) AS ok FROM matrix GROUP BY 1)
  SELECT scenario, coalesce(e.t, '') AS expected_issue_types, coalesce(d.t, '') AS detected_issue_types,
    'evaluated' AS evaluation_status, ok AS scenario_passed, row_count
  FROM v LEFT JOIN e USING (scenario) LEFT JOIN d USING (scenario) JOIN sizes USING (scenario)""",
    "scenario_totals": f"WITH {ALL}, sizes AS (SELECT scenario, count(*) AS n FROM every_row GROUP BY 1) SELECT sum(n)::BIGINT AS total_rows_evaluated, max(n)::BIGINT AS peak_scenario_row_count FROM sizes",
    "evaluation_metrics": f"""WITH {MATRIX}, k AS (SELECT
    {count("outcome = 'true_positive'")} AS tp, {count("outcome = 'false_positive'")} AS fp,
    {count("outcome = 'false_negative'")} AS fn, {count("outcome = 'true_negative'")} AS tn FROM matrix)
  SELECT tp AS true_positives, fp AS false_positives, fn AS false_negatives, tn AS true_negatives,
    {ratio('tp', 'tp + fp')} AS precision, {ratio('tp', 'tp + fn')} AS recall,
    {ratio('2 * tp', '2 * tp + fp + fn')} AS f1_score, {ratio('fp', 'fp + tn')} AS false_positive_rate,
    tp AS detected_expected_incidents, tp + fn AS total_expected_incidents, 0::BIGINT AS pending_scenario_count FROM k""",
    "detection_rate": f"""WITH {MATRIX} SELECT issue_type, {count('expected')} AS expected_incidents,
    {count("outcome = 'true_positive'")} AS detected_expected_incidents,
    {ratio(count("outcome = 'true_positive'"), count('expected'))} AS detection_rate FROM matrix GROUP BY issue_type""",
    "scenario_quality_metrics": SCENARIO_METRICS,
}
ORACLE["snapshot_roundtrip"] = f"WITH {DIRTY} SELECT * FROM dirty"
ORACLE["csv_roundtrip"] = f"""WITH {FEED} SELECT row_id::VARCHAR AS row_id, {', '.join(
    "concat_ws(chr(10), descriptor, 'said " + chr(34) + "' || status || '" + chr(34) + ", then') AS descriptor"
    if c == 'descriptor' else c for c in COLUMNS)} FROM feed"""
ORACLE["scenario_roundtrip"] = f"WITH {FAULTS} {fault_sql('closed_date_before_created_date')}"
_EVALUATED = ORACLE["evaluation_metrics"].removeprefix("WITH ")
ORACLE["kpi_overview_evaluation"] = f"""WITH whole AS (WITH {_EVALUATED}),
  clean_row AS (WITH {FEED} {metrics_sql('feed')}),
  total_row AS ({ORACLE['scenario_totals']}),
  verdict_row AS (WITH {VERDICTS} SELECT issue_count = 0 AS validation_passed, schema_passed, issue_count,
    reliability_score, {HEALTH} AS health_status FROM verdicts WHERE scenario = 'clean'),
  wide AS (SELECT * FROM verdict_row, clean_row, whole, total_row)
  UNPIVOT (SELECT COLUMNS(*)::VARCHAR FROM wide) ON COLUMNS(*) INTO NAME metric VALUE value"""
for _query, _name in {
    "fault_drop_column": "deleted_required_agency_column",
    "fault_rename_column": "renamed_complaint_type_column",
    "fault_invalid_numeric": "invalid_latitude_text",
    "fault_duplicate_rows": "duplicate_rows_preserved_unique_keys",
    "fault_invalid_timestamp": "invalid_created_date_text",
    "fault_missingness_10": "descriptor_missingness_plus_10_points",
    "fault_missingness_25": "descriptor_missingness_plus_25_points",
    "fault_missingness_50": "descriptor_missingness_plus_50_points",
    "fault_volume_spike": "daily_request_volume_spike",
    "fault_category_shift": "complaint_type_frequency_shift",
    "fault_unseen_category": "unseen_complaint_type_category",
    "fault_reversed_dates": "closed_date_before_created_date",
}.items():
    ORACLE[_query] = f"WITH {FAULTS} {fault_sql(_name)}"

_CHANGED = {n: f"SELECT '{n}' AS scenario, row_id FROM {sample_sql(n, VALUE_FAULTS[n][0], VALUE_FAULTS[n][1])}"
            for n in VALUE_FAULTS}
_APPENDED = {n: f"SELECT '{n}' AS scenario, row_id FROM ({fault_sql(n)}) WHERE row_id > (SELECT max_id FROM stats)"
             for n in ("duplicate_rows_preserved_unique_keys", "daily_request_volume_spike")}
ORACLE["affected_rows"] = f"WITH {FAULTS} " + " UNION ALL ".join([*_CHANGED.values(), *_APPENDED.values()])
ORACLE["changed_rows"] = f"WITH {FAULTS} " + " UNION ALL ".join(
    f"SELECT '{n}' AS scenario, t.* FROM ({fault_sql(n)}) t SEMI JOIN ({ids}) i USING (row_id)"
    for n, ids in [*_CHANGED.items(), *_APPENDED.items()])
ORACLE["spike_sources"] = f"""WITH {FAULTS}
  SELECT max_id + 1 + pick AS row_id, row_id AS source_row_id FROM {SPIKED_ROWS}, stats"""
