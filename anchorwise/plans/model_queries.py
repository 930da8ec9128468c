"""Registered model queries: training / prediction (rows-only) and SQL-checkable metrics and folds."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import anchors as A
from ..operators import enrich as EN
from ..operators import features as FE
from ..operators import model as M
from ..sources import fixtures as fx
from ..sources.sinks import output_path
from . import oracle_features as OF
from .prep_queries import TEST_END, TEST_START, TRAIN_CUTOFF
from .views_sql import with_views

R6 = 6
_MODELS: dict = {}
_IN_RANGE = "isnan(predicted_fantasy_points) = false and predicted_fantasy_points between -2 and 200"  # P16's clip


def _round(df: DataFrame, cols: set[str]) -> DataFrame:
    return df.select(*[F.round(c, R6).alias(c) if c in cols else F.col(c) for c in df.columns])


def _features(spark: SparkSession, sf: str, anchors_fn) -> DataFrame:
    ds = fx.load_datasets(spark, sf)
    anc = anchors_fn(ds.innings)
    f = FE.build_features(anc, ds.innings, ds.deliveries, ds.matchstat, ds.venue_stats,
                          keep=["match_id", "player_id", "match_date", "fantasy_points"], with_prior_venue=False)
    return f.where("is_valid")


def _test_features(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf, lambda inn: A.test_anchors(inn, TEST_START, TEST_END))


def _trained(spark: SparkSession, sf: str) -> M.TrainResult:
    """Fitted once per session and folder (the fitted model is a small driver-side object): up to the library's 500
    rounds, ended by 50 rounds without a lower error alone (M6)."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MODELS:
        train = _features(spark, sf, lambda inn: A.training_anchors(inn, TRAIN_CUTOFF))
        _MODELS[key] = M.train(spark, train, early_stopping=True)
    return _MODELS[key]


def train_predict(spark, sf):
    """M1 -> M4 -> M2 -> M12: train before the cutoff, predict the test month, clip."""
    res = _trained(spark, sf)
    p = M.predict(res.model, _test_features(spark, sf))
    return p.select("match_id", "player_id", "match_date", "fantasy_points", "predicted_fantasy_points")


def model_metrics(spark, sf):
    """M10 (+ M7-M9 in-sample and CV summary): one row."""
    return _trained(spark, sf).metrics


def cv_folds_metrics(spark, sf):
    return _trained(spark, sf).cv


def feature_importance(spark, sf):
    return M.feature_importance(spark, _trained(spark, sf).model, top_n=15)


def save_load_model(spark, sf):
    """Save the fitted pipeline to the shared folder, load it back, score the test month."""
    loaded = _saved_and_loaded(spark, sf)
    return M.predict(loaded, _test_features(spark, sf)).select("match_id", "player_id", "predicted_fantasy_points")


def _saved_and_loaded(spark: SparkSession, sf: str) -> PipelineModel:
    return M.load_model(M.save_model(_trained(spark, sf).model, output_path(spark, "model")))


def train_predict_check(spark, sf):
    """Which rows train_predict scores, with what actuals, and that every score is finite and inside the clip."""
    return train_predict(spark, sf).select("match_id", "player_id", "match_date", "fantasy_points",
                                           F.expr(_IN_RANGE).alias("in_range"))


def model_metrics_check(spark, sf):
    """The parts of model_metrics that don't depend on the trees."""
    return model_metrics(spark, sf).select("n", F.round("target_std", R6).alias("target_std"), "feature_count",
                                           F.col("best_iteration").between(1, 500).alias("rounds_ok"))


def cv_fold_check(spark, sf):
    """The parts of cv_fold_metrics that don't depend on the trees, and that no fold ended for lack of patience."""
    waited = (F.col("rounds") - F.col("best_iteration") >= M.PATIENCE) | (F.col("rounds") == M.GBT_DEFAULTS["maxIter"])
    return cv_folds_metrics(spark, sf).select("fold", "n", F.round("target_std", R6).alias("target_std"),
                                              F.col("best_iteration").between(1, 500).alias("rounds_ok"), waited.alias("waited"))


def feature_importance_check(spark, sf):
    """All 30 features, each importance in [0, 1], their sum 1."""
    imp = M.feature_importance(spark, _trained(spark, sf).model)
    return imp.select("feature", F.col("importance").between(0, 1).alias("in_range"),
                      F.round(imp.select(F.sum("importance")).scalar(), R6).alias("total"))


def save_load_model_check(spark, sf):
    """The model read back scores every test row as the one in memory does. Both score the same stored features."""
    loaded, own = _saved_and_loaded(spark, sf), _trained(spark, sf).model
    test = _test_features(spark, sf).checkpoint()
    key = ["match_id", "player_id"]
    scored = M.predict(loaded, test).select(*key, F.col("predicted_fantasy_points").alias("_loaded"))
    return scored.join(M.predict(own, test).select(*key, "predicted_fantasy_points"), key).select(
        "match_id", "player_id", (F.col("_loaded") == F.col("predicted_fantasy_points")).alias("equal"))


def predict_requests_check(spark, sf):
    """Every request row is scored inside the clip and ranked within its request."""
    return predict_requests(spark, sf).groupBy("request_id", "player_id", "team_no").agg(
        F.count(F.lit(1)).alias("n"), F.every(F.expr(_IN_RANGE)).alias("in_range"),
        F.every(F.expr("predicted_rank >= 1 and percentile between 0 and 100")).alias("ranked"))


def predict_requests(spark, sf):
    """Requests -> anchors + 30 features (P10, M21, P11) -> model (M12) -> enrichment."""
    from .prep_queries import prediction_features

    feats = prediction_features(spark, sf)
    p = M.predict(_trained(spark, sf).model, feats).withColumn("fp_pred", F.col("predicted_fantasy_points")).checkpoint()
    e = EN.enrich_predictions(p.select("request_id", "player_id", "team_no", "predicted_fantasy_points", "fp_pred"),
                              fx.profiles(spark, sf))
    return e.select("request_id", "player_id", "team_no", "predicted_fantasy_points", "fp_pred", "role", "name",
                    "prediction_confidence", "credits", "predicted_rank", "percentile", "variance_category")


def pick_teams(spark, sf):
    """The whole flow: predictions of every request -> starting probability from the innings
    -> candidates (W10, P17, F3, G1) -> exact selection (G2) -> captains (W14)."""
    from ..operators import pick_status as PS
    from ..operators import selection as SEL

    inn = fx.innings(spark, sf)
    preds = predict_requests(spark, sf).join(
        fx.requests(spark, sf).select("request_id", "cutoff_date").distinct(), "request_id")
    cands = PS.prepare_candidates(preds, inn)
    team = SEL.captains(SEL.select_teams(spark, cands))
    return team.select("request_id", "player_id", "team_no", "role", "role_std", "fp_pred", "starting_probability",
                       "prediction_confidence", "captain_score", "captain", "vice_captain")


def _pred_vs_actual(spark: SparkSession, sf: str) -> DataFrame:
    """Candidate scores joined to the innings actuals on the (match, player) key."""
    inn = fx.innings(spark, sf)
    p = EN.dedupe_first(fx.predictions(spark, sf), ["request_id", "player_id"],
                        [F.col("fp_pred").desc(), F.col("team_no").asc()])
    act = inn.where(F.col("fantasy_points").isNotNull()).select(
        F.col("match_id").alias("request_id"), "player_id", F.col("fantasy_points").alias("y"))
    return p.join(act, ["request_id", "player_id"]).select("request_id", "player_id", "y", F.col("fp_pred").alias("yhat"))


def regression_metrics(spark, sf):
    m = M.regression_metrics(_pred_vs_actual(spark, sf))
    return _round(m, {"rmse", "mae", "r2", "variance_score", "prediction_std", "target_std"})


def variance_score(spark, sf):
    m = M.regression_metrics(_pred_vs_actual(spark, sf), by=["request_id"])
    return _round(m.select("request_id", "n", "variance_score", "prediction_std", "avoiding_average_trap"),
                  {"variance_score", "prediction_std"})


def ts_folds(spark, sf):
    rows = A.training_anchors(fx.innings(spark, sf))
    f = M.time_series_folds(rows)
    return f.select("match_id", "player_id", "pos", "test_fold", "first_train_fold")


QUERIES = {
    "predict_requests": predict_requests,
    "pick_teams": pick_teams,
    "train_predict": train_predict,
    "model_metrics": model_metrics,
    "cv_fold_metrics": cv_folds_metrics,
    "feature_importance": feature_importance,
    "save_load_model": save_load_model,
    "regression_metrics": regression_metrics,
    "variance_score": variance_score,
    "ts_folds": ts_folds,
    "train_predict_check": train_predict_check,
    "model_metrics_check": model_metrics_check,
    "cv_fold_check": cv_fold_check,
    "feature_importance_check": feature_importance_check,
    "save_load_model_check": save_load_model_check,
    "predict_requests_check": predict_requests_check,
}

_PVA = """dd AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY request_id, player_id ORDER BY fp_pred DESC, team_no)
   AS r FROM predictions) WHERE r = 1),
pva AS (SELECT dd.request_id, dd.player_id, i.fantasy_points AS y, dd.fp_pred AS yhat
   FROM dd JOIN innings i ON i.match_id = dd.request_id AND i.player_id = dd.player_id WHERE i.fantasy_points IS NOT NULL)"""

_METRICS = """COUNT(*) AS n, ROUND(SQRT(AVG((y - yhat) * (y - yhat))), 6) AS rmse, ROUND(AVG(ABS(y - yhat)), 6) AS mae,
  ROUND(1 - AVG((y - yhat) * (y - yhat)) / VAR_POP(y), 6) AS r2,
  ROUND(CASE WHEN VAR_POP(y) = 0 THEN 0 ELSE 1 / (1 + ABS(VAR_POP(yhat) / VAR_POP(y) - 1)) END, 6) AS variance_score,
  ROUND(STDDEV_POP(yhat), 6) AS prediction_std, ROUND(STDDEV_POP(y), 6) AS target_std,
  STDDEV_POP(yhat) >= 10 AS avoiding_average_trap"""


def oracles() -> dict[str, str]:
    w = with_views("innings", "predictions", extra=_PVA)
    valid = f"""vf AS (SELECT f.match_id, f.player_id, f.match_date, i.fantasy_points
   FROM ({OF.ALL_SELECT}) f JOIN innings i ON i.match_id = f.match_id AND i.player_id = f.player_id WHERE f.is_valid),
tr AS (SELECT *, ROW_NUMBER() OVER (ORDER BY match_date, match_id, player_id) - 1 AS pos, COUNT(*) OVER () AS n FROM vf
   WHERE match_date < DATE '{TRAIN_CUTOFF}' AND fantasy_points BETWEEN -5 AND 200),
te AS (SELECT * FROM vf WHERE match_date >= DATE '{TEST_START}' AND match_date < DATE '{TEST_END}')"""
    v = with_views("innings", "deliveries", "matchstat", "venue_stats", extra=",\n".join([OF.ANCHORS, *OF.ALL_CTES, valid]))
    names = ", ".join(f"'{f}'" for f in FE.FEATURES)
    return {
        "train_predict_check": v + "SELECT *, TRUE AS in_range FROM te",
        "model_metrics_check": v + f"""SELECT COUNT(*) AS n, ROUND(STDDEV_POP(fantasy_points), 6) AS target_std,
  CAST({len(FE.FEATURES)} AS INTEGER) AS feature_count, TRUE AS rounds_ok FROM tr""",
        "cv_fold_check": v + """SELECT CAST((pos - (n - (n // 6) * 5)) // (n // 6) AS INTEGER) AS fold, COUNT(*) AS n,
  ROUND(STDDEV_POP(fantasy_points), 6) AS target_std, TRUE AS rounds_ok, TRUE AS waited FROM tr WHERE pos >= n - (n // 6) * 5 GROUP BY 1""",
        "feature_importance_check": f"SELECT UNNEST([{names}]) AS feature, TRUE AS in_range, CAST(1 AS DOUBLE) AS total",
        "save_load_model_check": v + "SELECT match_id, player_id, TRUE AS equal FROM te",
        "predict_requests_check": with_views("requests") + """SELECT request_id, player_id, team_no, COUNT(*) AS n,
  TRUE AS in_range, TRUE AS ranked FROM requests GROUP BY request_id, player_id, team_no""",
        "regression_metrics": w + f"SELECT {_METRICS} FROM pva",
        "variance_score": w + """SELECT request_id, COUNT(*) AS n,
  ROUND(CASE WHEN VAR_POP(y) = 0 THEN 0 ELSE 1 / (1 + ABS(VAR_POP(yhat) / VAR_POP(y) - 1)) END, 6) AS variance_score,
  ROUND(STDDEV_POP(yhat), 6) AS prediction_std, STDDEV_POP(yhat) >= 10 AS avoiding_average_trap
FROM pva GROUP BY request_id""",
        "ts_folds": with_views("innings", extra="""t AS (SELECT match_id, player_id,
   ROW_NUMBER() OVER (ORDER BY match_date, match_id, player_id) - 1 AS pos, COUNT(*) OVER () AS n
   FROM innings WHERE fantasy_points IS NOT NULL AND match_date IS NOT NULL),
s AS (SELECT *, n // 6 AS size, n - (n // 6) * 5 AS start FROM t)""") + """SELECT match_id, player_id, pos,
  CAST(CASE WHEN pos >= start THEN (pos - start) // size ELSE -1 END AS INTEGER) AS test_fold,
  CAST(CASE WHEN GREATEST(FLOOR(5 - (n - pos) / size) + 1, 0) <= 4 THEN GREATEST(FLOOR(5 - (n - pos) / size) + 1, 0)
       ELSE -1 END AS INTEGER) AS first_train_fold
FROM s""",
    }
