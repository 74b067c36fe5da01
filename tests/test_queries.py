"""Registered queries against their SQL, and the shape of their plans."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests import oracle

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")

SQL = entry.oracle_sql()
# The queries of the training-data operators have tests of their own.
QUERIES = {n: fn for n, fn in entry.queries().items() if n not in entry.LLM_QUERIES}
BATCH = [n for n in QUERIES if not n.startswith("stream_") or n == "stream_as_table"]
STREAMS = ["stream_window_topn", "stream_reconcile", "stream_periodic_pv", "stream_broadcast_rules"]


@pytest.fixture(scope="module")
def con():
    with oracle.connect(SF_DIR) as c:
        yield c


@pytest.mark.parametrize("name", [*BATCH, *STREAMS])
def test_same_as_sql(spark, con, name):
    assert oracle.difference(spark, con, name, QUERIES[name], SQL[name], SF_DIR) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) - set(entry.LLM_ORACLES)


def test_a_missing_optional_package_leaves_the_rest():
    code = ("import sys, warnings; sys.modules['ahocorasick'] = None; warnings.simplefilter('ignore'); "
            "import __spark_entry__ as e; assert not e.LLM_QUERIES and len(e.queries()) == len(e.QUERIES) > 130")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).parent.parent)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_start", "window_end", "url", "cnt", "row_num"] and df.count() > 0


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in BATCH if not n.startswith("sink_")])
def test_no_product_of_tables(spark, name):
    assert "Cartesian" not in (p := plan(spark, name)) and "NestedLoop" not in p


@pytest.mark.parametrize("name, filtered", [("filter_user", "EqualTo(user_id,7)"), ("where_select", "EqualTo(event_type,click)"),
                                            ("window_join", "EqualTo(event_type,click)")])
def test_filters_reach_the_scan(spark, name, filtered):
    assert filtered in plan(spark, name)


@pytest.mark.parametrize("name, columns", [
    ("map_user", "struct<user_id:bigint>"), ("word_count", "struct<text:string>"),
    ("url_view_count", "struct<ts:timestamp_ntz,event_type:string>"), ("user_click_count", "struct<user_id:bigint>")])
def test_scans_read_only_what_they_need(spark, name, columns):
    assert f"ReadSchema: {columns}" in plan(spark, name)


@pytest.mark.parametrize("name", ["window_topn", "topn_url_sliding", "top2_agg"])
def test_top_n_is_limited_before_the_shuffle(spark, name):
    p = plan(spark, name)
    assert p.count("WindowGroupLimit") == 2


def test_overall_top_n_is_not_a_sort(spark):
    assert "TakeOrderedAndProject" in plan(spark, "topn_users")
