"""The plans that the scale depends on."""

from tallylake.checks import QUERIES

SF = "/root/testdata/sf0.01"


def plan(spark, name):
    df = QUERIES[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_version_is_cut_before_the_shuffle(spark):
    text = plan(spark, "latest_by_lsn")
    assert "WindowGroupLimit" in text and "Partial" in text
    before_exchange = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in before_exchange
    assert text.count("Exchange hashpartitioning") == 1


def test_top_positions_rank_with_a_group_limit(spark):
    assert "WindowGroupLimit" in plan(spark, "top_positions")


def test_positions_are_summed_before_they_meet_accounts(spark):
    text = plan(spark, "partner_net_position")
    # The scans read the columns they need and nothing else.
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in text
    join = text.index("account_id")
    assert "partial_sum" in text[join:]


def test_events_are_parsed_once(spark):
    df = QUERIES["state_events"](spark, SF)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("parseJson") <= 1 and "Generate posexplode" in text
