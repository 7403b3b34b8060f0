"""SQL of the queries over time."""

from __future__ import annotations

from oracles.sql import DAY, DIRTY, blank, ts

_LANDED = f"""{DIRTY}, landed AS (
  SELECT *, CASE WHEN row_id < 0 THEN -1 - row_id ELSE row_id END AS number,
    {ts('created_date')} AS moment FROM dirty),
placed AS (
  SELECT *, least(floor(number * 4.0 / (SELECT max(event_id) + 1 FROM events))::BIGINT
    + CASE WHEN number % 20 = 0 THEN 1 ELSE 0 END, 3) AS epoch FROM landed WHERE moment IS NOT NULL),
marks AS (SELECT epoch, max(moment) AS newest FROM placed GROUP BY epoch),
judged AS (
  SELECT placed.*, coalesce(date_trunc('day', moment) + INTERVAL 1 DAY <=
    (SELECT max(newest) FROM marks WHERE marks.epoch < placed.epoch) - INTERVAL 1 DAY, false) AS is_late
  FROM placed)"""

_OPEN = f"""WITH {_LANDED}
SELECT {DAY} AS calendar_date, count(*) AS request_count FROM judged WHERE NOT is_late GROUP BY 1"""

_REQUESTS = f"""{DIRTY}, requests AS (
  SELECT row_id, agency, borough, {ts('created_date')} AS s, {ts('closed_date')} AS e FROM dirty),
usable AS (SELECT * FROM requests WHERE s IS NOT NULL AND (e IS NULL OR e >= s))"""


def _concurrency(groups: str, unit: str) -> str:
    using = f"{groups}, " if groups else ""
    same = f"AND points.{groups} IS NOT DISTINCT FROM spans.{groups}" if groups else ""
    part = f"PARTITION BY {groups}" if groups else ""
    return f"""WITH {_REQUESTS},
points AS (
  SELECT {using} moment, sum(o) AS o, sum(c) AS c FROM (
    SELECT {using} s AS moment, 1 AS o, 0 AS c FROM usable UNION ALL
    SELECT {using} e, 0, 1 FROM usable WHERE e IS NOT NULL) GROUP BY ALL),
levels AS (
  SELECT *, date_trunc('{unit}', moment) AS span, sum(o - c) OVER ({part} ORDER BY moment) AS level FROM points),
spans AS (
  SELECT {using} unnest(generate_series(min(span), max(span), INTERVAL 1 {unit})) AS span
  FROM levels {'GROUP BY ' + groups if groups else ''}),
sums AS (
  SELECT {', '.join(f'spans.{g}' for g in [groups] if g)}{',' if groups else ''} spans.span,
    coalesce(sum(o), 0) AS opened, coalesce(sum(c), 0) AS closed, max(level) AS peak, min(moment) AS first
  FROM spans LEFT JOIN levels AS points ON points.span = spans.span {same} GROUP BY ALL),
running AS (SELECT *, sum(opened - closed) OVER ({part} ORDER BY span) AS open_after FROM sums)
SELECT {using} strftime(span, '%Y-%m-%d %H:%M:%S') AS span_start,
  (open_after - opened + closed)::BIGINT AS open_before, opened::BIGINT AS opened, closed::BIGINT AS closed,
  open_after::BIGINT AS open_after,
  (CASE WHEN peak IS NULL THEN open_after WHEN first = span THEN peak
        ELSE greatest(peak, open_after - opened + closed) END)::BIGINT AS most_open
FROM running"""


TIME_ORACLE = {
    "volume_stream": f"""WITH {DIRTY} SELECT {DAY} AS calendar_date, count(*) AS request_count
FROM dirty WHERE {ts('created_date')} IS NOT NULL GROUP BY 1""",
    "volume_stream_open_days": _OPEN,
    "volume_stream_state": _OPEN,
    "volume_stream_late": f"WITH {_LANDED} SELECT epoch, row_id, created_date FROM judged WHERE is_late",
    "keys_across_snapshots": f"""WITH {DIRTY}, keyed AS (
  SELECT unique_key AS key, ((row_id % 3) + 3) % 3 AS part, count(*) AS n FROM dirty
  WHERE NOT {blank('unique_key')} GROUP BY ALL)
SELECT key, max(n) FILTER (part = 2) AS rows_now, 'day ' || min(part) AS first_snapshot,
  count(*) FILTER (part < 2) AS snapshots_before, (sum(n) FILTER (part < 2))::BIGINT AS rows_before
FROM keyed GROUP BY key HAVING count(*) FILTER (part = 2) > 0 AND count(*) FILTER (part < 2) > 0""",
    "copies_across_snapshots": """WITH kinds AS (
  SELECT l_quantity, l_discount, l_tax, l_returnflag, l_linestatus, l_linenumber,
    count_if(l_orderkey % 2 = 0) AS rows_now, count_if(l_orderkey % 2 = 1) AS rows_before
  FROM lineitem GROUP BY 1, 2, 3, 4, 5, 6)
SELECT rows_now::BIGINT AS rows_now, rows_before::BIGINT AS rows_before, count(*) AS keys
FROM kinds WHERE rows_now > 0 AND rows_before > 0 GROUP BY 1, 2""",
    "asof_error_after_click": """
SELECT event_id, user_id, (
  SELECT arg_max(c.event_id, (c.ts, c.event_id)) FROM events c
  WHERE c.event_type = 'click' AND c.user_id = e.user_id AND c.ts < e.ts AND c.ts >= e.ts - INTERVAL 6 HOUR) AS click_id
FROM events e WHERE event_type = 'error'""",
    "asof_orders_events": """WITH best AS (
  SELECT user_id % 5 AS part, date_trunc('hour', ts) AS hour, max(event_id) AS event_id FROM events GROUP BY 1, 2),
placed AS (
  SELECT o_orderkey, o_custkey % 5 AS part, TIMESTAMP '2024-01-01' + to_hours((o_orderkey * 7 % 720)::INT) AS moment FROM orders)
SELECT o_orderkey, best.event_id, value
FROM placed ASOF LEFT JOIN best ON placed.part = best.part AND moment >= hour
LEFT JOIN events ON events.event_id = best.event_id""",
    "requests_open_per_hour": _concurrency("borough", "hour"),
    "requests_open_per_day": _concurrency("", "day"),
    "overlapping_requests": f"""WITH {_REQUESTS}, counted AS (
  SELECT a.row_id, count(*) AS overlap_count
  FROM usable a JOIN usable b ON a.agency = b.agency
    AND a.row_id <> b.row_id AND b.s < coalesce(a.e, TIMESTAMP '9999-01-01') AND a.s < coalesce(b.e, TIMESTAMP '9999-01-01')
  GROUP BY a.row_id)
SELECT requests.row_id, CASE WHEN usable.row_id IS NOT NULL AND requests.agency IS NOT NULL
  THEN coalesce(overlap_count, 0)::BIGINT END AS overlap_count
FROM requests LEFT JOIN usable USING (row_id) LEFT JOIN counted ON counted.row_id = requests.row_id""",
}
