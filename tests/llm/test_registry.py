from __future__ import annotations

import __spark_entry__ as entry


def test_one_query_for_each_operator_and_the_pipeline():
    numbers = [int(name[2:].split("_")[0]) for name in entry.queries() if name.startswith("op")]
    assert sorted(numbers) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
