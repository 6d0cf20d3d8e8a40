"""Shapes of physical plans that matter once the input is large."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import DATA

SF = f"{DATA}/sf0.01"


def plan(spark, name: str) -> str:
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "dedup_keep_first", "pending_work", "first_seen", "latest_status", "progress_summary", "validation_report",
    "failure_burst", "listing_stop_rule", "progress_rate", "assign_chunk_8", "sized_parts", "attach_category",
])
def test_no_cross_join(spark, name):
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan(spark, name))


@pytest.mark.parametrize("name", ["first_seen", "latest_status", "validation_report", "failure_burst", "duplicates_report"])
def test_reductions_are_hash_aggregates(spark, name):
    text = plan(spark, name)
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_few_repeats_do_not_shuffle_the_texts(spark):
    text = plan(spark, "dedup_keep_first")
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_extraction_runs_once_and_is_narrow(spark):
    text = plan(spark, "article_extract")
    assert text.count("ArrowEvalPython") == 1 and "hashpartitioning" not in text
    assert len(re.findall(r"- (?:\*\(\d+\) )?Filter \(", text)) == 1 and "PushedFilters: [IsNotNull(html), Not(EqualTo(html,))]" in text


def test_scans_read_only_what_is_used(spark):
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string>" in plan(spark, "pending_work")
    assert "ReadSchema: struct<url:string>" in plan(spark, "discover_fallback")


def test_number_windows_see_one_row_per_file(spark):
    text = plan(spark, "assign_chunk_8")
    single = text[text.index("SinglePartition"):]
    assert "ReadSchema: struct<>" in single
