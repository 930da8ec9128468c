"""Golden outputs of one earlier run, re-derived from its input columns."""

import io

import pandas as pd
import pytest

from anchorwise.operators import enrich as EN
from anchorwise.operators import reports as R
from anchorwise.operators import selection as SEL

from tests.golden_values import PREDICTIONS, TEAM


@pytest.fixture(scope="module")
def golden(spark):
    g = pd.read_csv(io.StringIO(PREDICTIONS))
    df = spark.createDataFrame(
        [(1, int(r.player_id), int(r.team_id), float(r.fp_pred), r.role) for r in g.itertuples()],
        "request_id long, player_id long, team_no int, fp_pred double, role string")
    return g, df


def test_enrichment_matches_golden(golden):
    g, df = golden
    out = EN.enrich_predictions(df).toPandas()
    m = out.merge(g, on=["player_id", "fp_pred"], suffixes=("", "_ref")).drop_duplicates(["player_id", "predicted_rank"])
    assert len(out) == 37
    assert (m["credits"] - m["credits_ref"]).abs().max() < 1e-9
    assert (m["prediction_confidence"] - m["prediction_confidence_ref"]).abs().max() < 1e-6
    assert (m["variance_category"] == m["variance_category_ref"]).all()
    by_rank = out.sort_values("predicted_rank")
    ref = g.sort_values("predicted_rank")
    assert list(by_rank["percentile"].round(9)) == list(ref["percentile"].round(9))


def test_report_matches_golden(golden):
    _, df = golden
    q = R.quality_report(df).collect()[0]
    assert (q["tier_high_variance"], q["tier_above_average"], q["tier_average"], q["tier_below_average"],
            q["tier_low_variance"]) == (6, 9, 7, 9, 6)
    assert q["unique_predictions"] == 35 and q["total_players"] == 37
    assert q["avg_prediction"] == pytest.approx(46.0759, abs=1e-4)
    assert q["prediction_std"] == pytest.approx(14.6362, abs=1e-4)
    assert q["variance_quality"] == "Moderate" and q["range_quality"] == "Good"


def test_captains_match_golden(spark):
    t = pd.read_csv(io.StringIO(TEAM))
    df = spark.createDataFrame(
        [(1, int(r.player_id), int(r.team_id), float(r.fp_pred), float(r.starting_probability),
          float(r.prediction_confidence), r.role_std) for r in t.itertuples()],
        "request_id long, player_id long, team_no int, fp_pred double, starting_probability double, "
        "prediction_confidence double, role_std string")
    c = SEL.captains(df).toPandas().merge(t, on="player_id", suffixes=("", "_ref"))
    assert (c["captain_score"] - c["captain_score_ref"]).abs().max() < 2e-6
    assert (c["captain"] == c["captain_ref"]).all() and (c["vice_captain"] == c["vice_captain_ref"]).all()
    v = SEL.validate_team(SEL.captains(df)).collect()[0]
    assert v["valid"]
