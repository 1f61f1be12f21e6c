from cellforge.operators import relations
from cellforge.sources import fixtures as fx
from tests.conftest import SF_MID, lines_df


def counts(df):
    return {r.reason: r.n for r in df.collect()}


def test_follow_edge_rows(spark):
    df = lines_df(spark, ["x\t\t5", "x\t5\t", "x\t5\t\ty", "x\t1\t2"])
    c = counts(relations.follow_rejects(df))
    assert c == {"MISSING_A_ID": 1, "MISSING_B_ID": 1, "BAD_RECORD": 3}
    cells = sorted(tuple(r) for r in relations.follow_cells(df, ts=1).collect())
    assert cells == [("1:2", "follow", "ab", 1, ""), ("2:1", "follow", "ba", 1, "")]


def test_mention_edge_rows(spark):
    df = lines_df(spark, ["x\t1\t2\tre\t9\t\ts\t8", "x\t1\t2\tzz\t9\t0", "x\t1\t2\tme\t\t0", "x\t1\t2\trt\t9"])
    out = relations.mention_cells(df, ts=1).collect()
    assert len(out) == 1
    assert out[0].value == '{"created_at":"","rel_tw_id":"8"}'
    assert (out[0].row, out[0].family, out[0].qualifier) == ("1:2", "reply", "9")
    c = counts(relations.mention_rejects(df))
    assert c["MISSING_RELATIONSHIP"] == 1 and c["MISSING_TWEET_ID"] == 1 and c["BAD_RECORD"] == 3


def test_fixture_counts_sf001(spark):
    lines = fx.line_input(spark, SF_MID, "follow_lines")
    c = counts(relations.follow_rejects(lines))
    assert c == {"MISSING_A_ID": 1204, "MISSING_B_ID": 198, "BAD_RECORD": 3154}
    assert relations.follow_cells(lines, ts=1).count() == 2 * (15000 - 3154)
    m = counts(relations.mention_rejects(fx.line_input(spark, SF_MID, "atsign_lines")))
    assert m == {"MISSING_A_ID": 527, "MISSING_B_ID": 412, "MISSING_RELATIONSHIP": 1818,
                 "MISSING_TWEET_ID": 241, "BAD_RECORD": 2998}


def test_observed_rejects_same_pass(spark):
    from cellforge.operators.rejects import observe_rejects

    lines = lines_df(spark, ["x\t\t5", "x\t1\t2"])
    observed, obs = observe_rejects(relations.follow_parsed(lines), relations.FOLLOW_REASONS)
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get == {"MISSING_A_ID": 1, "MISSING_B_ID": 0, "BAD_RECORD": 1}


def test_counters_in_the_load_pass(spark):
    from pyspark.sql import Observation

    lines = fx.line_input(spark, SF_MID, "atsign_lines")
    obs = Observation("mention_counters")
    relations.mention_cells(lines, ts=1, observation=obs).write.format("noop").mode("overwrite").save()
    assert obs.get == {"MISSING_A_ID": 527, "MISSING_B_ID": 412, "MISSING_RELATIONSHIP": 1818,
                       "MISSING_TWEET_ID": 241, "BAD_RECORD": 2998}


def test_mentions_with_related_tweet(spark):
    from pyspark.sql import functions as F

    cells = relations.mention_cells(fx.line_input(spark, SF_MID, "atsign_lines"), ts=1)
    assert cells.count() == 7002
    assert cells.where(F.col("value").contains('"rel_tw_id"')).count() == 2324
