"""The relation loaders against a plain-Python model of their rules, on random lines."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from cellforge.operators import relations
from tests.conftest import lines_df
from tests.test_split import java_like

FAMILIES = {"re": "reply", "rt": "retweet", "me": "mention"}


def model_mention(line):
    """(cell or None, specific counter or None) for one mention line."""
    f = java_like(line)

    def at(i):
        return f[i] if i < len(f) else None

    checks = [(1, "MISSING_A_ID"), (2, "MISSING_B_ID")]
    for i, name in checks:
        if at(i) is None:
            return None, None
        if at(i) == "":
            return None, name
    if at(3) is None:
        return None, None
    if at(3) not in FAMILIES:
        return None, "MISSING_RELATIONSHIP"
    if at(4) is None:
        return None, None
    if at(4) == "":
        return None, "MISSING_TWEET_ID"
    if at(5) is None:
        return None, None
    value = {"created_at": at(5)}
    if len(f) > 7:
        value["rel_tw_id"] = at(7)
    return (f"{at(1)}:{at(2)}", FAMILIES[at(3)], at(4), json.dumps(value, separators=(",", ":"))), "OK"


FIELD = st.sampled_from(["", "1", "22", "re", "rt", "me", "zz", "x y"])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(FIELD, min_size=0, max_size=9), min_size=1, max_size=40))
def test_mentions_match_the_model(spark, records):
    lines = ["\t".join(r) for r in records]
    df = lines_df(spark, lines)
    got_cells = sorted((r.row, r.family, r.qualifier, r.value) for r in relations.mention_cells(df, ts=1).collect())
    got_counts = {r.reason: r.n for r in relations.mention_rejects(df).collect()}
    expected_cells, counts = [], {k: 0 for k in ["MISSING_A_ID", "MISSING_B_ID", "MISSING_RELATIONSHIP", "MISSING_TWEET_ID", "BAD_RECORD"]}
    for line in lines:
        cell, reason = model_mention(line)
        if cell is not None:
            expected_cells.append(cell)
            continue
        counts["BAD_RECORD"] += 1
        if reason is not None:
            counts[reason] += 1
    assert got_cells == sorted(expected_cells)
    assert got_counts == counts
