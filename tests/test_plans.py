"""What the physical plans must keep: pruned scans, partial aggregation, no blind products."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from rollcall.operators import funnel, sample, state, totals
from rollcall.sources import logs
from rollcall.plans import bindings as b

SF = "/root/testdata/sf0.001"


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_panel_is_a_scan(spark):
    agents = b.table(spark, SF, "orders").select(F.col("o_orderkey").cast("string")
                                                 .alias("agent_id"))
    text = plan(sample.panel_candidates(agents, 7))
    assert "Exchange" not in text and "ReadSchema: struct<o_orderkey:bigint>" in text


def test_state_is_one_shuffle(spark):
    text = plan(state.current_state(b.event_log(spark, SF)))
    assert "Join" not in text and text.count("hashpartitioning") == 1
    assert "partial_min" in text and "partial_max" in text


def test_group_funnel_folds_before_the_shuffle(spark):
    text = plan(funnel.owner_funnel(funnel.analysed(b.order_checks(spark, SF))))
    assert "partial_max" in text and "Window" not in text


def test_all_filters_of_stored_logs_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "logs")
    logs.write_logs(b.raw_logs(spark, SF), path, 250_000)
    text = plan(logs.scan_logs(logs.stored_logs(spark, path), 41_500_000, 41_600_000,
                               range_blocks=250_000).select("transactionHash"))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    for column in ("EqualTo(address", "GreaterThanOrEqual(block_number,41500000)",
                   "LessThanOrEqual(block_number,41600000)", "In(topic0"):
        assert column in pushed
    assert "(block_range#" in next(x for x in text.splitlines() if "PartitionFilters" in x)
    read = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert "data:" not in read and "logIndex" not in read


@pytest.mark.parametrize("query", ["survival", "three_denominators", "top_projects", "verdict",
                                   "block_times", "panel_growth", "owner_top5"])
def test_no_products(spark, query):
    import __spark_entry__ as contract

    text = plan(contract.queries()[query](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_monthly_window_sees_months(spark):
    text = plan(totals.monthly(b.order_checks(spark, SF), F.col("registered_at")))
    assert text.index("Window") < text.index("HashAggregate")


def test_grading_packs_no_rows_to_compare(spark):
    """Attempts and passes are chosen by windows; only the five short probe answers are aggregated."""
    from rollcall.operators import verdict

    targets = b.probe_targets(spark, SF)
    graded = verdict.grade(targets.select("run_id", "agent_id", "pass", "uri", "checked_at"),
                           b.fetches(targets), b.endpoint_probes(targets))
    tree = plan(verdict.reconcile(graded)).split("\n\n")[0]
    assert tree.count("SortAggregate") <= 2 and tree.count("Generate") <= 21


def test_hosts_need_no_grading(spark):
    from rollcall.operators import verdict

    pages = b.table(spark, SF, "pages").select(F.col("page_id").alias("agent_id"),
                                               F.col("url").alias("uri"))
    text = plan(verdict.target_hosts(pages))
    assert "Exchange" not in text and "Join" not in text
