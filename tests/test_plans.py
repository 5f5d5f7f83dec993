"""Properties of the physical plans."""

import re

import pytest

from commwatch.plans.catalog import CATALOG

BATCH = [name for name in CATALOG if not name.startswith("stream_")]
# queries whose result is made within the row
NARROW = """
wire_trans wire_email sanitise_text address_normalise parse_trans trans_flags reject_trans
tolerant_flags business_days horizon parse_email doc_tokens doc_token_total term_freq
term_freq_reset freq_json topic_hits topic_scores topic_label sentiment power fraud_score
email_scores edges
""".split()


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    return {name: plan(CATALOG[name](spark, sf_dir)) for name in BATCH}


def test_no_python_in_any_plan(plans):
    for name, text in plans.items():
        assert "EvalPython" not in text and "InPandas" not in text, name


def test_no_nested_loops(plans):
    for name, text in plans.items():
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name


@pytest.mark.parametrize("name", NARROW)
def test_narrow_queries_do_not_shuffle(plans, name):
    text = plans[name]
    # the one round-robin exchange spreads a small input and is absent on a large one
    assert text.count("Exchange") <= text.count("Exchange RoundRobinPartitioning") <= 1
    assert "Aggregate" not in text and "Join" not in text and "Window" not in text


@pytest.mark.parametrize("name", ["term_freq_reset", "topic_hits", "email_scores", "edges"])
def test_text_is_split_once(plans, name):
    # a filter inferred or pushed below the scoring would evaluate it a second time
    assert not re.search(r"\bFilter ", plans[name])


def test_filters_reach_the_scan(plans):
    assert "LessThan(o_orderdate,1999-01-01T00:00)" in plans["horizon"]
    assert "StringContains(text,@)" in plans["people_filter"]


def test_counts_aggregate_before_the_shuffle(plans):
    for name in ("message_counts", "fourth_char_counts", "batch_counts"):
        text = plans[name]
        assert text.count("Exchange hashpartitioning") == 1, name
        assert text.index("Exchange") < text.index("partial_count"), name


def test_large_lexicon_is_not_copied_and_small_one_broadcast(spark, sf_dir, plans):
    """On the lexicon's side of the join there is nothing but its own words, dealt out once."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("topic_hits_joined", "email_scores_by_table"):
            text = plan(CATALOG[name](spark, sf_dir))
            side = text[text.index("SortMergeJoin") :].split("Generate explode")[-1]
            assert side.count("Exchange hashpartitioning(light") == 1, name
            assert "collect_set" in side and "Generate" not in side, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plans["table_lexicon_hits"]


def test_emails_by_table_are_parsed_and_counted_once(plans):
    assert plans["email_scores_by_table"].count("regexp_extract_all") == 2  # subject and content
