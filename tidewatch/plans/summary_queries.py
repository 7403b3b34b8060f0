"""Queries over levels, ranks, summaries, sessions and sliding windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.contract import Contract
from tidewatch.operators import quarantine, sketches
from tidewatch.operators.issues import validation_issues, validation_verdict
from tidewatch.operators.profile import profile, quality_metrics
from tidewatch.operators.ranking import global_ranks
from tidewatch.operators.rollup import missingness_levels, rolled_up
from tidewatch.operators.spans import sessions, sliding_volume
from tidewatch.operators.tables import SCENARIO, one_table, split_table
from tidewatch.operators.volume import daily_counts
from tidewatch.plans.feeds import read_table
from tidewatch.plans.queries import dirty, query, r6
from tidewatch.session import stored


OWN = Contract.from_mapping({"unique_key_column": "unique_key", "checks": [
    {"name": "open_with_closing_date", "column": "closed_date", "fails_when": "status = 'Open' and closed_date is not null", "penalty": 7},
    {"name": "wrong_hemisphere", "column": "latitude", "fails_when": "try_cast(latitude as double) > 100", "penalty": 30},
    {"name": "unknown_borough", "column": "borough", "fails_when": "borough not like 'B%'"},
    {"name": "of_another_table", "column": "no_such_column", "fails_when": "no_such_column = 1"},
]})


def _own(spark, folder):
    table = one_table(dirty(spark, folder), "row_id")
    return table, profile(table, OWN)


@query("own_check_issues")
def _(spark, folder):
    """Row checks that a contract defines itself, found by the one scan that finds the others."""
    _, checked = _own(spark, folder)
    return validation_issues(checked).select("issue_type", "affected_field", "issue_count", "observed_value", "expected_value")


@query("own_check_rejected_rows")
def _(spark, folder):
    table, _ = _own(spark, folder)
    rows = quarantine.rejected_rows(table, OWN)
    return rows.select("row_id", F.concat_ws(",", quarantine.REASONS).alias("reasons"))


@query("own_check_score")
def _(spark, folder):
    table, checked = _own(spark, folder)
    verdict = validation_verdict(validation_issues(checked), table.names_frame(), OWN)
    counted = quality_metrics(checked).select(SCENARIO, "rejected_row_count")
    return verdict.join(counted, SCENARIO).select(
        "issue_count", F.col("reliability_score").cast("long").alias("reliability_score"), "rejected_row_count")


@query("missingness_cube")
def _(spark, folder):
    """Blank values for every borough, agency and type, all their pairs, and alone."""
    return missingness_levels(dirty(spark, folder), ["borough", "agency", "complaint_type"], ["agency", "descriptor", "closed_date"])


@query("volume_rollup")
def _(spark, folder):
    """Orders by year, month and day, with their shares of urgent ones."""
    orders = read_table(spark, folder, "orders").select(
        *(F.date_format("o_orderdate", form).alias(name) for name, form in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))),
        "o_orderpriority")
    return rolled_up(orders, ["year", "month", "day"], {"urgent": F.col("o_orderpriority") == "1-URGENT"}, "rollup")


@query("drift_grouping_sets")
def _(spark, folder):
    """Lines by flag and status, by supplier, and in all, with the returned ones."""
    lines = read_table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_suppkey", "l_quantity")
    return rolled_up(lines, ["l_returnflag", "l_linestatus", "l_suppkey"], {"large": F.col("l_quantity") > 40},
                     [["l_returnflag", "l_linestatus"], ["l_suppkey"], []])


@query("global_ranks_lineitem")
def _(spark, folder):
    """Ranks of all lines by quantity, of which there are few: long ties."""
    lines = read_table(spark, folder, "lineitem")
    value = F.when(F.col("l_linenumber") < 7, F.col("l_quantity")).alias("quantity")
    rows = lines.groupBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", value).agg(F.max("l_shipdate").alias("shipped"))
    ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    found = global_ranks(rows, "quantity", ids, tiles=7).select(*ids, "rank", "dense_rank", "ntile", r6("percent_rank"), r6("cume_dist"))
    return found


@query("global_ranks_orders")
def _(spark, folder):
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return global_ranks(orders, "o_totalprice", ["o_orderkey"], tiles=10).select(
        "o_orderkey", "row_number", "rank", "ntile", r6("percent_rank"))


def _event_states(spark, folder) -> DataFrame:
    """Summaries of every day's events, stored as a monitor would keep them."""
    events = read_table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    return stored(sketches.summaries(events, ["day"], ["user_id", "event_type", "props", "value"], ["value"]), "states")


@query("sketch_distinct")
def _(spark, folder):
    """Distinct values of a month from its days' states, against the exact count."""
    found = sketches.distinct_counts(sketches.merged(_event_states(spark, folder)))
    events = read_table(spark, folder, "events")
    exact = events.agg(*(F.countDistinct(c).alias(c) for c in ("user_id", "event_type", "props", "value")))
    exact = exact.unpivot([], ["user_id", "event_type", "props", "value"], "field", "exact")
    close = F.abs(F.col("distinct_estimate") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * sketches.DISTINCT_ERROR)
    return found.join(exact, "field").select("field", "n", "exact", close.alias("within_bound"))


@query("sketch_quantiles")
def _(spark, folder):
    """Quantiles of a month from its days' states: is their true rank within the bound?"""
    state = sketches.merged(_event_states(spark, folder)).where("field = 'value'")
    shares = (0.01, 0.25, 0.5, 0.75, 0.99)
    found = None
    for share in shares:
        one = sketches.quantile(state, share).select(F.lit(share).alias("share"), "quantile")
        found = one if found is None else found.unionByName(one)
    events = read_table(spark, folder, "events").select("value")
    # five rows
    ranks = events.join(F.broadcast(found), events["value"] <= found["quantile"]).groupBy("share").agg(F.count(F.lit(1)).alias("below"))
    total = events.agg(F.count("value")).scalar()
    close = F.abs(F.col("below") / total - F.col("share")) <= sketches.RANK_ERROR + 1 / total
    return ranks.select("share", close.alias("within_bound"))


@query("frequent_values")
def _(spark, folder):
    """Suppliers, parts and ship days with at least a thousandth of all lines, from daily summaries."""
    lines = read_table(spark, folder, "lineitem").select(
        "l_suppkey", "l_partkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"))
    fields = ["l_suppkey", "l_partkey", "shipped"]
    daily = stored(sketches.slot_counts(lines, fields, by=[], slots=4096), "slots")
    return sketches.frequent_values(lines, fields, 0.001, daily, slots=4096).select("field", "value", "n")


@query("user_sessions")
def _(spark, folder):
    """Sessions of every user: events less than two hours apart."""
    found = sessions(read_table(spark, folder, "events"), ["user_id"], "ts", "2 hours")
    clock = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
    return found.select("user_id", "session", clock("session_start"), clock("session_end"), "events")


@query("sliding_volume")
def _(spark, folder):
    """Weeks that slide over the calendar: errors of the users of one kind, on whose quiet days nothing lands."""
    events = read_table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type")
    error = F.col("event_type") == "error"
    parts = split_table(events, {"few": error & (F.col("user_id") % 20 == 3), "all": F.lit(True)}, "event_id")
    found = sliding_volume(daily_counts(parts, "ts"))
    return found.select(F.col(SCENARIO).alias("series"), "calendar_date", "request_count", "sliding_count", r6("sliding_mean"))
