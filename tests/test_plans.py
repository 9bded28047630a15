"""What the physical plans must and must not do."""

import pytest
from pyspark.sql import functions as F

from conftest import plan
from playline.bindings import MIDDLE, ntz, raw_events, raw_media
from playline.operators.filters import received_after
from playline.operators.joins import engagement
from playline.operators.project import flatten_media
from playline.plans import reports

SF = "/root/testdata/sf0.001"


def fact(spark):
    return engagement(raw_events(spark, SF), flatten_media(raw_media(spark, SF)), "2024-01-30")


def test_small_dimension_is_broadcast_and_events_are_not_shuffled(spark):
    text = plan(fact(spark))
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


def test_large_dimension_is_never_broadcast(spark, settings):
    settings(playline__lookup__broadcastBytes=0, spark__sql__autoBroadcastJoinThreshold=-1)
    text = plan(fact(spark))
    assert "Broadcast" not in text and "SortMergeJoin" in text


@pytest.mark.parametrize("limit", [10**9, 0])
def test_facts_are_read_once_however_they_are_joined(spark, settings, limit):
    settings(playline__lookup__broadcastBytes=limit, spark__sql__autoBroadcastJoinThreshold=-1)
    text = plan(fact(spark))
    assert text.count("events.parquet]") == 1 and text.count("part.parquet]") == 1


def test_cutoff_reaches_the_scan(spark):
    text = plan(received_after(raw_events(spark, SF), ntz(MIDDLE)))
    assert "GreaterThan(ts,2024-01-16" in text


def test_only_used_columns_are_read(spark):
    text = plan(reports.daily(fact(spark)))
    assert "event_type" not in text and "p_brand" not in text and "p_name" not in text


@pytest.mark.parametrize("report", [reports.by_media, reports.by_visitor, reports.daily])
def test_reports_reduce_before_the_shuffle(spark, report):
    text = plan(report(fact(spark)))
    assert "partial_" in text and "partial_sum" in text


def test_no_python_in_any_plan(spark):
    for df in (fact(spark), reports.by_media(fact(spark))):
        text = plan(df)
        assert "Python" not in text and "Pandas" not in text
