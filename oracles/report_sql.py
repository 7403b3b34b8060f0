"""SQL of the queries over what is written and read back."""

from __future__ import annotations

import json

from oracles.sql import (
    COLUMNS, DATES, FEED, ISSUES, LIMITS, ORACLE, RANGES, REQUIRED,
)

_ODD = """CASE l_linenumber % 4 WHEN 1 THEN 'nan'::DOUBLE WHEN 2 THEN 'inf'::DOUBLE WHEN 3 THEN '-inf'::DOUBLE ELSE l_quantity END"""
_SAFE = f"CASE WHEN isfinite({_ODD}) THEN {_ODD} END"


def _expected() -> str:
    """(issue_type, affected_field, expected_value) of every finding, as the contract has it."""
    rows = [("invalid_timestamp", c, {"readable_as": "timestamp"}) for c in DATES]
    rows += [("invalid_numeric_value", c, {"readable_as": "number"}) for c in RANGES]
    rows += [("numeric_out_of_range", c, {"minimum": low, "maximum": high}) for c, (low, high) in RANGES.items()]
    rows += [("missing_unique_key", "unique_key", {"blank": False}), ("duplicate_unique_key", "unique_key", {"rows_per_key": 1}),
             ("invalid_date_order", "closed_date/created_date", "closed_date_must_not_be_earlier_than_created_date")]
    rows += [("missing_required_value", c, {"blank": False}) for c in REQUIRED]
    rows += [("missingness_threshold_exceeded", c, float(LIMITS[c])) for c in COLUMNS]
    return ", ".join(f"('{t}', '{f}', '{json.dumps(e)}')" for t, f, e in rows)


def _worded(rows: str, place: str) -> str:
    """Texts of ``rows`` (issue_type, severity, affected_field, expected_value, issue_count)."""
    return f"""SELECT issue_type, severity, affected_field, expected_value,
  'Check ' || issue_type || ' on ' || affected_field || ' counts ' || issue_count || '; expected: '
    || coalesce(expected_value, 'none') AS description, 'See ' || {place} || '.' AS suggested_action FROM ({rows})"""


_PLACE = """CASE issue_type WHEN 'missingness_threshold_exceeded' THEN 'tables/feed_counters'
  ELSE 'rejected_rows, reason ' || issue_type || ':' || affected_field END"""
_VOLUME = json.dumps({"minimum_absolute_increase": 200, "standardized_threshold": 3.0})
_DRIFT = json.dumps({"maximum_jensen_shannon_distance": 0.05, "minimum_absolute_category_frequency_change": 0.02})
_NEW = json.dumps({"minimum_new_category_count": 10, "minimum_new_category_frequency": 0.01})

REPORT_ORACLE = {
    "records_roundtrip": f"WITH {FEED} SELECT {', '.join(COLUMNS)} FROM feed",
    "json_safe_values": f"""SELECT l_orderkey, l_linenumber, {_SAFE} AS plain, {_SAFE} AS "first", l_tax AS "second",
  {_SAFE} AS mapped_k, l_discount AS mapped_t, {_SAFE} AS deep, {_SAFE} AS deeper FROM lineitem""",
    "evaluation_fields": f"""WITH m AS ({ORACLE['evaluation_metrics']}), t AS ({ORACLE['scenario_totals']}),
wide AS (SELECT true_positives, true_negatives, false_positives, false_negatives, "precision", recall, f1_score,
  false_positive_rate, total_rows_evaluated, peak_scenario_row_count, 12 AS manifest_scenario_count FROM m, t)
SELECT field, round(number, 6) AS number FROM (
  UNPIVOT (SELECT COLUMNS(*)::DOUBLE FROM wide) ON COLUMNS(*) INTO NAME field VALUE number)""",
    "evaluation_outcomes": f"""WITH m AS ({ORACLE['confusion_matrix']}), r AS ({ORACLE['scenario_results']})
SELECT scenario, row_count, issue_type, outcome FROM m JOIN r USING (scenario)""",
    "incident_texts": f"WITH {ISSUES}, expected AS (SELECT * FROM (VALUES {_expected()}) v(issue_type, affected_field, expected_value)) "
                      + _worded("SELECT * FROM issue_rows JOIN expected USING (issue_type, affected_field)", _PLACE),
    "volume_incident_texts": _worded(
        f"SELECT *, '{_VOLUME}' AS expected_value FROM ({ORACLE['volume_issues']})", "'tables/volume_records'"),
    "drift_incident_texts": _worded(
        f"""SELECT *, CASE issue_type WHEN 'category_drift' THEN '{_DRIFT}' ELSE '{_NEW}' END AS expected_value
        FROM ({ORACLE['drift_issues']})""", "'tables/drift_findings'"),
    "disappearing_categories_years": """WITH years AS (
  SELECT strftime(o_orderdate, '%Y') AS category, count(*) AS n FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1)
SELECT 'order_year' AS field, category, n AS baseline_count,
  round(n / (SELECT sum(n) FROM years), 6) AS baseline_frequency
FROM years WHERE category < '1997' AND n >= 10""",
}
