"""SQL of the queries over levels, ranks, summaries, sessions and sliding windows."""

from __future__ import annotations

import json

from oracles.sql import DIRTY, blank, count


def pct(part: str, total: str) -> str:
    """A percentage to two places; halves, which small groups often have, go to the even digit."""
    return f"round_even(({part})::DOUBLE / ({total})::DOUBLE * 100, 2)::DOUBLE"


_BLANKS = ("agency", "descriptor", "closed_date")

_CHECKS = {
    ("open_with_closing_date", "closed_date", 7): "status = 'Open' and closed_date is not null",
    ("wrong_hemisphere", "latitude", 30): "try_cast(latitude as double) > 100",
    ("unknown_borough", "borough", 10): "borough not like 'B%'",
}
_REASONS = [("missing_unique_key", "unique_key", blank("unique_key"))] + [
    (n, f, f"coalesce({c}, false)") for (n, f, _), c in _CHECKS.items()] + [
    ("duplicate_unique_key", "unique_key", f"(NOT {blank('unique_key')} AND count(*) OVER (PARTITION BY unique_key) > 1)")]
_OWN = f"""{DIRTY}, flagged AS (
  SELECT row_id, {', '.join(f'{c} AS "{n}"' for n, _, c in _REASONS)} FROM dirty),
reasons AS ({' UNION ALL '.join(
    f"SELECT row_id, {i} AS seq, '{n}' AS issue_type, '{f}' AS affected_field FROM flagged WHERE \"{n}\""
    for i, (n, f, _) in enumerate(_REASONS))}),
found AS (SELECT issue_type, affected_field, count(*) AS issue_count FROM reasons GROUP BY 1, 2)"""


def _expected() -> str:
    rows = [("missing_unique_key", {"blank": False}), ("duplicate_unique_key", {"rows_per_key": 1})]
    rows += [(n, {"fails_when": c}) for (n, _, _), c in _CHECKS.items()]
    return ", ".join("('{}', '{}')".format(n, json.dumps(e).replace("'", "''")) for n, e in rows)


SUMMARY_ORACLE = {
    "own_check_issues": f"""WITH {_OWN}, expected AS (SELECT * FROM (VALUES {_expected()}) v(issue_type, expected_value))
SELECT issue_type, affected_field, issue_count, '{{"count":' || issue_count || '}}' AS observed_value, expected_value
FROM found JOIN expected USING (issue_type)""",
    "own_check_rejected_rows": f"""WITH {_OWN}
SELECT row_id, string_agg(issue_type || ':' || affected_field, ',' ORDER BY seq) AS reasons FROM reasons GROUP BY 1""",
    "own_check_score": f"""WITH {_OWN}, points AS (SELECT * FROM (VALUES ('missing_unique_key', 10), ('duplicate_unique_key', 10),
  {', '.join(f"('{n}', {p})" for n, _, p in _CHECKS)}) v(issue_type, penalty))
SELECT count(*) AS issue_count, greatest(0, 100 - sum(penalty))::BIGINT AS reliability_score,
  (SELECT count(DISTINCT row_id) FROM reasons) AS rejected_row_count FROM found JOIN points USING (issue_type)""",
    "missingness_cube": f"""WITH {DIRTY}, levels AS (
  SELECT borough, agency, complaint_type, grouping_id(borough, agency, complaint_type)::BIGINT AS level, count(*) AS row_count,
    {', '.join(f'{count(blank("b_" + c))} AS missing_{c}' for c in _BLANKS)}
  FROM (SELECT *, {', '.join(f'{c} AS b_{c}' for c in _BLANKS)} FROM dirty) GROUP BY CUBE (borough, agency, complaint_type))
SELECT *, {', '.join(f'{pct(f"missing_{c}", "row_count")} AS missing_{c}_percentage' for c in _BLANKS)} FROM levels""",
    "volume_rollup": f"""WITH days AS (
  SELECT strftime(o_orderdate, '%Y') AS "year", strftime(o_orderdate, '%m') AS "month", strftime(o_orderdate, '%d') AS "day",
    o_orderpriority = '1-URGENT' AS u FROM orders),
levels AS (
  SELECT "year", "month", "day", grouping_id("year", "month", "day")::BIGINT AS level, count(*) AS row_count, {count('u')} AS urgent
  FROM days GROUP BY ROLLUP ("year", "month", "day"))
SELECT *, {pct('urgent', 'row_count')} AS urgent_percentage FROM levels""",
    "drift_grouping_sets": f"""WITH levels AS (
  SELECT l_returnflag, l_linestatus, l_suppkey, grouping_id(l_returnflag, l_linestatus, l_suppkey)::BIGINT AS level,
    count(*) AS row_count, {count('l_quantity > 40')} AS large
  FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_suppkey), ()))
SELECT *, {pct('large', 'row_count')} AS large_percentage FROM levels""",
    "global_ranks_lineitem": """WITH rows AS (
  SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber < 7 THEN l_quantity END AS q FROM lineitem),
ranked AS (
  SELECT *, rank() OVER (ORDER BY q) AS "rank", dense_rank() OVER (ORDER BY q) AS "dense_rank",
    ntile(7) OVER (ORDER BY q, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS "ntile",
    round(percent_rank() OVER (ORDER BY q), 6) AS "percent_rank", round(cume_dist() OVER (ORDER BY q), 6) AS "cume_dist"
  FROM rows WHERE q IS NOT NULL)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "rank", "dense_rank", "ntile", "percent_rank", "cume_dist" FROM ranked
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, NULL, NULL, NULL, NULL, NULL FROM rows WHERE q IS NULL""",
    "global_ranks_orders": """SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS "row_number",
  rank() OVER (ORDER BY o_totalprice) AS "rank", ntile(10) OVER (ORDER BY o_totalprice, o_orderkey) AS "ntile",
  round(percent_rank() OVER (ORDER BY o_totalprice), 6) AS "percent_rank" FROM orders""",
    "sketch_distinct": " UNION ALL ".join(
        f"SELECT '{c}' AS field, count({c}) AS n, count(DISTINCT {c}) AS exact, true AS within_bound FROM events"
        for c in ("user_id", "event_type", "props", "value")),
    "sketch_quantiles": "SELECT unnest([0.01, 0.25, 0.5, 0.75, 0.99])::DOUBLE AS share, true AS within_bound",
    "frequent_values": " UNION ALL ".join(
        f"""(SELECT '{name}' AS field, {value} AS value, count(*) AS n FROM lineitem WHERE {value} IS NOT NULL GROUP BY 2
  HAVING count(*) >= 0.001 * (SELECT count({value}) FROM lineitem))"""
        for name, value in (("l_suppkey", "l_suppkey::VARCHAR"), ("l_partkey", "l_partkey::VARCHAR"),
                            ("shipped", "strftime(l_shipdate, '%Y-%m-%d')"))),
    "user_sessions": """WITH marked AS (
  SELECT user_id, ts, coalesce(ts - lag(ts) OVER w >= INTERVAL 2 HOUR, true)::INT AS begins FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING)::BIGINT AS session FROM marked)
SELECT user_id, session, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_start,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_end, count(*) AS events FROM numbered GROUP BY 1, 2""",
    "sliding_volume": """WITH rows AS (
  SELECT 'all' AS series, ts::DATE AS d FROM events UNION ALL
  SELECT 'few', ts::DATE FROM events WHERE event_type = 'error' AND user_id % 20 = 3),
counted AS (SELECT series, d, count(*) AS n FROM rows GROUP BY 1, 2),
days AS (SELECT series, unnest(generate_series(min(d), max(d), INTERVAL 1 DAY))::DATE AS d FROM counted GROUP BY 1),
filled AS (SELECT days.series, days.d, coalesce(n, 0) AS n FROM days LEFT JOIN counted USING (series, d))
SELECT series, strftime(d, '%Y-%m-%d') AS calendar_date, n AS request_count, (sum(n) OVER w)::BIGINT AS sliding_count,
  CASE WHEN count(*) OVER w = 7 THEN round((sum(n) OVER w) / 7, 6) END AS sliding_mean
FROM filled WINDOW w AS (PARTITION BY series ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
}
