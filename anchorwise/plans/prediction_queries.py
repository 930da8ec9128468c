"""Registered enrichment / report queries over the per-request candidate predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import enrich as EN
from ..operators import reports as R
from ..sources import fixtures as fx
from .views_sql import with_views

R6 = 6


def _r(c: str, name: str | None = None):
    return F.round(F.col(c), R6).alias(name or c)


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return EN.enrich_predictions(fx.predictions(spark, sf), fx.profiles(spark, sf))


def enrich_rank(spark, sf):
    e = _enriched(spark, sf)
    return e.select("request_id", "player_id", "team_no", "fp_pred", "name", "predicted_rank", _r("percentile"))


def enrich_confidence(spark, sf):
    return _enriched(spark, sf).select("request_id", "player_id", "team_no", _r("prediction_confidence"))


def enrich_credits(spark, sf):
    return _enriched(spark, sf).select("request_id", "player_id", "team_no", "role", _r("credits"))


def enrich_category(spark, sf):
    return _enriched(spark, sf).select("request_id", "player_id", "team_no", "variance_category")


def _preds_with_role(spark, sf):
    return EN.with_profiles(fx.predictions(spark, sf), None)


def report_team(spark, sf):
    g = R.group_stats(_preds_with_role(spark, sf), ["request_id", "team_no"])
    return g.select("request_id", "team_no", _r("mean"), _r("std"), "count", "min", "max")


def report_role(spark, sf):
    g = R.group_stats(_preds_with_role(spark, sf), ["request_id", "role"], minmax=False)
    return g.select("request_id", "role", _r("mean"), _r("std"), "count")


def report_levels(spark, sf):
    """The reports by request, side and role from one shuffle."""
    d = R.level_report(_preds_with_role(spark, sf), {"team": "team_no", "role": "role"})
    return d.select(*[_r(c) if c in ("mean", "std") else F.col(c) for c in d.columns])


def report_category(spark, sf):
    f = R.frequency(_enriched(spark, sf), "variance_category")
    return f.select("request_id", "variance_category", "n", _r("share"))


def report_distribution(spark, sf):
    d = R.distribution_report(fx.predictions(spark, sf))
    dbl = {"mean", "std", "min", "max", "range", "p10", "p25", "p50", "p75", "p90", "coefficient_of_variation"}
    return d.select(*[_r(c) if c in dbl else F.col(c) for c in d.columns])


def report_quality(spark, sf):
    d = R.quality_report(fx.predictions(spark, sf))
    dbl = {"avg_prediction", "prediction_std", "prediction_variety", "prediction_range_span", "variance_score"}
    return d.select(*[_r(c) if c in dbl else F.col(c) for c in d.columns])


def top_players(spark, sf):
    t = EN.top_n(fx.predictions(spark, sf), 15)
    return t.select("request_id", "player_id", "team_no", "fp_pred", "rank")


def dedupe_candidates(spark, sf):
    p = fx.predictions(spark, sf)
    counts = p.groupBy("request_id", "player_id").agg(F.count(F.lit(1)).alias("n_copies"))
    d = EN.dedupe_first(p, ["request_id", "player_id"], [F.col("fp_pred").desc(), F.col("team_no").asc()])
    return d.join(counts, ["request_id", "player_id"]).select(
        "request_id", "player_id", "team_no", "fp_pred", "starting_probability", "role", "n_copies")


def standardize_roles(spark, sf):
    p = EN.with_role_std(fx.predictions(spark, sf))
    return p.select("request_id", "player_id", "role", "role_std")


def probability_summary(spark, sf):
    """A17 + P17 over the deduplicated candidates."""
    p = EN.dedupe_first(fx.predictions(spark, sf), ["request_id", "player_id"],
                        [F.col("fp_pred").desc(), F.col("team_no").asc()])
    sp = F.col("starting_probability")
    return p.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("n_candidates"),
        F.round(F.avg(sp), R6).alias("mean_probability"),
        F.min(sp).alias("min_probability"),
        F.max(sp).alias("max_probability"),
        F.count(F.when(sp >= 0.5, 1)).alias("likely_starters"),
        F.count(F.when(sp >= 0.8, 1)).alias("high_probability"),
    )


def roundtrip_sinks(spark, sf):
    """Tagged predictions sorted by request, the report as JSON; read back from the shared folder."""
    from ..sources.sinks import output_path, save_predictions

    e = _enriched(spark, sf).select("request_id", "player_id", "team_no", "fp_pred", "predicted_rank",
                                    "variance_category")
    path = save_predictions(e, output_path(spark, "predictions"), MODEL_TYPE,
                            report=R.quality_report(fx.predictions(spark, sf)))
    back = spark.read.parquet(f"{path}/predictions")
    return back.select("request_id", "player_id", "team_no", "fp_pred", "predicted_rank", "variance_category",
                       "model_type")


def roundtrip_report(spark, sf):
    """The JSON report read back, under its own column types."""
    from ..sources.sinks import output_path, save_predictions

    report = report_quality(spark, sf)
    path = save_predictions(fx.predictions(spark, sf), output_path(spark, "predictions"), MODEL_TYPE, report=report)
    return spark.read.schema(report.schema).json(f"{path}/analysis")


def roundtrip_by_date(spark, sf):
    """Predictions stored by cutoff date, those of one half of the dates written a second time over their own; read back."""
    from ..sources.sinks import output_path, store_by_date

    dates = fx.requests(spark, sf).select("request_id", "cutoff_date").distinct()
    preds = fx.predictions(spark, sf).select("request_id", "player_id", "team_no", "fp_pred").join(dates, "request_id")
    path = store_by_date(preds, output_path(spark, "by_date"))
    store_by_date(preds.where(F.dayofmonth("cutoff_date") % 2 == 0), path)
    return spark.read.schema(preds.schema).parquet(path).select(*preds.columns)


MODEL_TYPE = "Spark GBT Variance Model with 30-Feature System"

QUERIES = {
    "roundtrip_sinks": roundtrip_sinks,
    "roundtrip_report": roundtrip_report,
    "roundtrip_by_date": roundtrip_by_date,
    "report_levels": report_levels,
    "enrich_rank": enrich_rank,
    "enrich_confidence": enrich_confidence,
    "enrich_credits": enrich_credits,
    "enrich_category": enrich_category,
    "report_team": report_team,
    "report_role": report_role,
    "report_category": report_category,
    "report_distribution": report_distribution,
    "report_quality": report_quality,
    "top_players": top_players,
    "dedupe_candidates": dedupe_candidates,
    "standardize_roles": standardize_roles,
    "probability_summary": probability_summary,
}

ENRICH_CTES = r"""prof AS (SELECT CAST(TRUNC(TRY_CAST(TRIM(player_id) AS DOUBLE)) AS BIGINT) AS pid,
   REGEXP_REPLACE(TRIM(name), '\s+', ' ', 'g') AS pname
   FROM profiles WHERE TRIM(player_id) <> 'nan' AND TRY_CAST(TRIM(player_id) AS DOUBLE) IS NOT NULL),
prof1 AS (SELECT pid, MIN(pname) AS pname FROM prof GROUP BY pid),
pb AS (SELECT p.request_id, p.player_id, p.team_no, p.fp_pred, p.starting_probability,
   COALESCE(p.role, 'Batter') AS role, COALESCE(f.pname, 'Player_' || CAST(p.player_id AS VARCHAR)) AS name
   FROM predictions p LEFT JOIN prof1 f ON f.pid = p.player_id),
st AS (SELECT request_id, COUNT(*) AS n, AVG(fp_pred) AS mu, STDDEV_SAMP(fp_pred) AS sd,
   QUANTILE_CONT(fp_pred, 0.25) AS q25, QUANTILE_CONT(fp_pred, 0.5) AS q50,
   QUANTILE_CONT(fp_pred, 0.75) AS q75, QUANTILE_CONT(fp_pred, 0.9) AS q90 FROM pb GROUP BY request_id),
en0 AS (SELECT pb.*, st.n, st.mu, st.sd, st.q25, st.q50, st.q75, st.q90,
   ROW_NUMBER() OVER (PARTITION BY pb.request_id ORDER BY fp_pred DESC, player_id ASC) AS predicted_rank,
   (RANK() OVER (PARTITION BY pb.request_id ORDER BY fp_pred)
     + (COUNT(*) OVER (PARTITION BY pb.request_id, fp_pred) - 1) / CAST(2 AS DOUBLE)) / st.n AS pct
   FROM pb JOIN st USING (request_id)),
en AS (SELECT *,
   LEAST(GREATEST(CASE WHEN sd < 5 THEN CAST(0.3 AS DOUBLE) WHEN sd < 15 THEN CAST(0.6 AS DOUBLE) ELSE CAST(0.8 AS DOUBLE) END
     + CAST(0.2 AS DOUBLE) * TANH(ABS(fp_pred - mu) / (sd + 1e-8)), CAST(0.2 AS DOUBLE)), CAST(0.95 AS DOUBLE))
     AS prediction_confidence,
   LEAST(GREATEST(CAST(9 AS DOUBLE) + pct * CAST(3 AS DOUBLE)
     + (CASE WHEN LOWER(role) LIKE '%all-rounder%' THEN CAST(0.7 AS DOUBLE) ELSE 0 END
        + CASE WHEN LOWER(role) LIKE '%wicketkeeper%' THEN CAST(0.5 AS DOUBLE) ELSE 0 END
        + CASE WHEN LOWER(role) LIKE '%bowler%' THEN CAST(-0.1 AS DOUBLE) ELSE 0 END)
     + CASE WHEN sd > 15 AND pct >= CAST(0.8 AS DOUBLE) THEN CAST(0.5 AS DOUBLE) ELSE 0 END,
     CAST(7 AS DOUBLE)), CAST(12.5 AS DOUBLE)) AS credits,
   CASE WHEN fp_pred >= q90 THEN 'High Variance' WHEN fp_pred >= q75 THEN 'Above Average'
        WHEN fp_pred >= q50 THEN 'Average' WHEN fp_pred >= q25 THEN 'Below Average'
        WHEN fp_pred < q25 THEN 'Low Variance' ELSE 'Medium' END AS variance_category,
   (1 - CAST(predicted_rank - 1 AS DOUBLE) / n) * 100 AS percentile
   FROM en0)"""


def oracles() -> dict[str, str]:
    we = with_views("predictions", "profiles", extra=ENRICH_CTES)
    wp = with_views("predictions")
    pr = "pr AS (SELECT request_id, player_id, team_no, fp_pred, starting_probability, COALESCE(role, 'Batter') AS role FROM predictions)"
    wr = with_views("predictions", extra=pr)
    dd = """dd AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY request_id, player_id
          ORDER BY fp_pred DESC, team_no) AS r, COUNT(*) OVER (PARTITION BY request_id, player_id) AS n_copies
          FROM predictions) WHERE r = 1)"""
    wd = with_views("predictions", extra=dd)
    quality = with_views("predictions", extra="""q AS (SELECT request_id, COUNT(fp_pred) AS total_players,
   AVG(fp_pred) AS avg_prediction, MIN(fp_pred) AS min_prediction, MAX(fp_pred) AS max_prediction,
   STDDEV_SAMP(fp_pred) AS prediction_std, COUNT(DISTINCT fp_pred) AS unique_predictions,
   QUANTILE_CONT(fp_pred, 0.85) AS q85, QUANTILE_CONT(fp_pred, 0.6) AS q60,
   QUANTILE_CONT(fp_pred, 0.4) AS q40, QUANTILE_CONT(fp_pred, 0.15) AS q15
   FROM predictions GROUP BY request_id),
t AS (SELECT p.request_id,
   COUNT(CASE WHEN fp_pred >= q85 THEN 1 END) AS tier_high_variance,
   COUNT(CASE WHEN fp_pred >= q60 AND fp_pred < q85 THEN 1 END) AS tier_above_average,
   COUNT(CASE WHEN fp_pred >= q40 AND fp_pred < q60 THEN 1 END) AS tier_average,
   COUNT(CASE WHEN fp_pred >= q15 AND fp_pred < q40 THEN 1 END) AS tier_below_average,
   COUNT(CASE WHEN fp_pred < q15 THEN 1 END) AS tier_low_variance
   FROM predictions p JOIN q USING (request_id) GROUP BY p.request_id)""") + """SELECT request_id, total_players,
  ROUND(avg_prediction, 6) AS avg_prediction, min_prediction, max_prediction, ROUND(prediction_std, 6) AS prediction_std,
  unique_predictions, ROUND(unique_predictions / total_players, 6) AS prediction_variety,
  prediction_std >= 10 AS variance_maintained,
  CASE WHEN prediction_std > 20 THEN 'Excellent' WHEN prediction_std > 15 THEN 'Good'
       WHEN prediction_std > 10 THEN 'Moderate' ELSE 'Poor' END AS variance_quality,
  ROUND(max_prediction - min_prediction, 6) AS prediction_range_span,
  CASE WHEN max_prediction - min_prediction > 40 THEN 'Good' WHEN max_prediction - min_prediction > 20 THEN 'Moderate'
       ELSE 'Poor' END AS range_quality,
  ROUND(prediction_std / 25, 6) AS variance_score,
  unique_predictions < total_players * 0.8 AS many_duplicates,
  max_prediction - min_prediction < 20 AS narrow_range,
  tier_high_variance, tier_above_average, tier_average, tier_below_average, tier_low_variance
FROM q JOIN t USING (request_id)"""
    figures = """ROUND(AVG(fp_pred), 6) AS mean, ROUND(STDDEV_SAMP(fp_pred), 6) AS std, COUNT(fp_pred) AS count,
  MIN(fp_pred) AS min, MAX(fp_pred) AS max, COUNT(CASE WHEN fp_pred < 20 THEN 1 END) AS low_scores,
  COUNT(CASE WHEN fp_pred >= 20 AND fp_pred < 50 THEN 1 END) AS medium_scores,
  COUNT(CASE WHEN fp_pred >= 50 THEN 1 END) AS high_scores, COUNT(CASE WHEN fp_pred >= 70 THEN 1 END) AS very_high_scores"""
    return {
        "roundtrip_by_date": with_views("predictions", "requests") + """SELECT request_id, player_id, team_no, fp_pred, cutoff_date
FROM predictions JOIN (SELECT DISTINCT request_id, cutoff_date FROM requests) USING (request_id)""",
        "report_levels": wr + f"""SELECT request_id, 'request' AS level, CAST(NULL AS VARCHAR) AS item, {figures},
  CASE WHEN STDDEV_SAMP(fp_pred) > 15 THEN 'EXCELLENT' WHEN STDDEV_SAMP(fp_pred) >= 10 THEN 'GOOD'
       WHEN STDDEV_SAMP(fp_pred) > 5 THEN 'MODERATE' ELSE 'POOR' END AS system_quality FROM pr GROUP BY request_id
UNION ALL SELECT request_id, 'team', CAST(team_no AS VARCHAR), {figures}, NULL FROM pr GROUP BY request_id, team_no
UNION ALL SELECT request_id, 'role', role, {figures}, NULL FROM pr GROUP BY request_id, role""",
        "roundtrip_sinks": we + f"""SELECT request_id, player_id, team_no, fp_pred, CAST(predicted_rank AS INTEGER) AS predicted_rank,
  variance_category,
  '{MODEL_TYPE}' AS model_type FROM en""",
        "enrich_rank": we + """SELECT request_id, player_id, team_no, fp_pred, name, CAST(predicted_rank AS INTEGER) AS predicted_rank,
  ROUND(percentile, 6) AS percentile FROM en""",
        "enrich_confidence": we + "SELECT request_id, player_id, team_no, ROUND(prediction_confidence, 6) AS prediction_confidence FROM en",
        "enrich_credits": we + "SELECT request_id, player_id, team_no, role, ROUND(credits, 6) AS credits FROM en",
        "enrich_category": we + "SELECT request_id, player_id, team_no, variance_category FROM en",
        "report_team": wr + """SELECT request_id, team_no, ROUND(AVG(fp_pred), 6) AS mean, ROUND(STDDEV_SAMP(fp_pred), 6) AS std,
  COUNT(fp_pred) AS count, MIN(fp_pred) AS min, MAX(fp_pred) AS max FROM pr GROUP BY request_id, team_no""",
        "report_role": wr + """SELECT request_id, role, ROUND(AVG(fp_pred), 6) AS mean, ROUND(STDDEV_SAMP(fp_pred), 6) AS std,
  COUNT(fp_pred) AS count FROM pr GROUP BY request_id, role""",
        "report_category": we + """SELECT request_id, variance_category, COUNT(*) AS n,
  ROUND(COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY request_id), 6) AS share FROM en GROUP BY request_id, variance_category""",
        "report_distribution": wp + """SELECT request_id, COUNT(fp_pred) AS total_predictions, ROUND(AVG(fp_pred), 6) AS mean,
  ROUND(STDDEV_POP(fp_pred), 6) AS std, ROUND(MIN(fp_pred), 6) AS min, ROUND(MAX(fp_pred), 6) AS max,
  ROUND(MAX(fp_pred) - MIN(fp_pred), 6) AS range,
  ROUND(QUANTILE_CONT(fp_pred, 0.1), 6) AS p10, ROUND(QUANTILE_CONT(fp_pred, 0.25), 6) AS p25,
  ROUND(QUANTILE_CONT(fp_pred, 0.5), 6) AS p50, ROUND(QUANTILE_CONT(fp_pred, 0.75), 6) AS p75,
  ROUND(QUANTILE_CONT(fp_pred, 0.9), 6) AS p90,
  COUNT(CASE WHEN fp_pred < 20 THEN 1 END) AS low_scores,
  COUNT(CASE WHEN fp_pred >= 20 AND fp_pred < 50 THEN 1 END) AS medium_scores,
  COUNT(CASE WHEN fp_pred >= 50 THEN 1 END) AS high_scores,
  COUNT(CASE WHEN fp_pred >= 70 THEN 1 END) AS very_high_scores,
  STDDEV_POP(fp_pred) >= 10 AS sufficient_spread,
  ROUND(CASE WHEN AVG(fp_pred) > 0 THEN STDDEV_POP(fp_pred) / AVG(fp_pred) ELSE 0 END, 6) AS coefficient_of_variation
FROM predictions GROUP BY request_id""",
        "report_quality": quality,
        "roundtrip_report": quality,
        "top_players": wp + """SELECT * FROM (SELECT request_id, player_id, team_no, fp_pred,
  CAST(ROW_NUMBER() OVER (PARTITION BY request_id ORDER BY fp_pred DESC, player_id) AS INTEGER) AS rank FROM predictions)
  WHERE rank <= 15""",
        "dedupe_candidates": wd + "SELECT request_id, player_id, team_no, fp_pred, starting_probability, role, n_copies FROM dd",
        "standardize_roles": wp + """SELECT request_id, player_id, role,
  CASE WHEN UPPER(COALESCE(role, 'NONE')) LIKE '%WK%' OR UPPER(COALESCE(role, 'NONE')) LIKE '%KEEPER%'
            OR UPPER(COALESCE(role, 'NONE')) LIKE '%WICKET%' THEN 'Wicketkeeper'
       WHEN UPPER(COALESCE(role, 'NONE')) LIKE '%BAT%' THEN 'Batter'
       WHEN UPPER(COALESCE(role, 'NONE')) LIKE '%ALL%' OR UPPER(COALESCE(role, 'NONE')) LIKE '%AR%'
            OR UPPER(COALESCE(role, 'NONE')) LIKE '%ROUND%' THEN 'Allrounder'
       WHEN UPPER(COALESCE(role, 'NONE')) LIKE '%BOWL%' OR UPPER(COALESCE(role, 'NONE')) LIKE '%BWL%' THEN 'Bowler'
       ELSE 'Batter' END AS role_std FROM predictions""",
        "probability_summary": wd + """SELECT request_id, COUNT(*) AS n_candidates,
  ROUND(AVG(starting_probability), 6) AS mean_probability, MIN(starting_probability) AS min_probability,
  MAX(starting_probability) AS max_probability, COUNT(CASE WHEN starting_probability >= 0.5 THEN 1 END) AS likely_starters,
  COUNT(CASE WHEN starting_probability >= 0.8 THEN 1 END) AS high_probability FROM dd GROUP BY request_id""",
    }
