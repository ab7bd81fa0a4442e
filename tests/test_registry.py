"""Every registered query against its SQL, and the shape of the plans."""

from __future__ import annotations

import io
import re
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as entry
from catalog.oracles import ORACLES
from catalog.queries import QUERIES
from parity import connect, differences

SF = "/root/testdata/sf0.001"
ROWS_ONLY = {"pairwise_ranker", "ranker_scores"}


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def plan_of(frame) -> str:
    text = io.StringIO()
    with redirect_stdout(text):
        frame.explain("formatted")
    return text.getvalue()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_is_checked():
    assert set(ORACLES) == set(QUERIES) - ROWS_ONLY
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, connection, name):
    frame = entry.queries()[name](spark, SF)
    assert differences(frame, connection, entry.oracle_sql()[name]) is None
    plan = plan_of(frame)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    python = re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups", plan)
    assert bool(python) == (name == "batch_score")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ROWS_ONLY))
def test_single_tasks_get_aggregates_only(spark, name):
    text = io.StringIO()
    with redirect_stdout(text):
        entry.queries()[name](spark, SF).explain()
    lines = text.getvalue().splitlines()
    for line, child in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in line:
            assert "Aggregate" in child or "LocalLimit" in child, child


def test_scans_read_only_what_they_need(spark):
    def schemas(name):
        return re.findall(r"ReadSchema: struct<(.*)>", plan_of(entry.queries()[name](spark, SF)))

    assert schemas("win_counts") == ["doc_id:bigint"]
    assert schemas("batch_assign") == ["doc_id:bigint"] * 2
    assert all("event_type" not in s and "props" not in s for s in schemas("rollout_metrics"))


def test_recorded_tables_names_what_durable_stores(spark):
    from prefspark.storage import durable, recorded_tables, remove

    with recorded_tables() as paths:
        table = durable(spark.range(3))
    assert len(paths) == 1 and table.count() == 3
    remove(spark, paths[0])
    with recorded_tables() as later:
        pass
    assert later == []


def test_nested_recorded_tables(spark):
    from prefspark.storage import durable, recorded_tables

    with recorded_tables() as outer:
        with recorded_tables() as inner:
            durable(spark.range(1))
        durable(spark.range(2))
    assert len(inner) == 1 and len(outer) == 2 and outer[0] == inner[0]
