"""Model path: forward-chaining folds, early stopping, and the end-to-end selection flow."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from anchorwise.operators import anchors as A
from anchorwise.operators import features as FE
from anchorwise.operators import model as M
from anchorwise.operators import selection as SEL
from anchorwise.sources import fixtures as fx
from tests.conftest import SF0001, SF001


def test_cv_with_early_stopping(spark):
    ds = fx.load_datasets(spark, SF0001)
    f = FE.build_features(A.training_anchors(ds.innings), ds.innings, ds.deliveries, ds.matchstat, ds.venue_stats,
                          keep=["match_id", "player_id", "match_date", "fantasy_points"]).where("is_valid")
    res = M.train(spark, f, cv=True, early_stopping=True, maxIter=3, maxDepth=3)
    assert res.cv.count() == 5
    m = res.metrics.collect()[0]
    assert m["n"] > 0 and m["feature_count"] == 30
    assert res.feature_importance.count() == 30


@pytest.mark.parametrize("errors, patience, want", [
    ([5, 4, 3, 4, 5, 6], 3, (3, True)),
    ([5, 4, 3, 4, 5], 3, (3, False)),  # only two rounds behind the best
    ([5, 6, 7, 8, 1], 3, (1, True)),  # a lower error after the patience ran out isn't seen
    ([3, 3, 3, 3], 3, (1, True)),  # equal is not lower
    ([9, 8, 7], 1, (3, False)),
    ([1], 50, (1, False)),
])
def test_best_round(errors, patience, want):
    assert M.best_round(errors, patience) == want


def _learnable(spark, n, noise):
    rows = spark.range(n).select("id", *[(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)) / 1000.0).alias(f"x{k}") for k in range(3)])
    return rows.withColumn("y", F.col("x0") * 20 + F.col("x1") * F.col("x0") * 10 + F.col("x2") * F.lit(noise))


def test_patience_finds_the_best_round(spark):
    """Fits that start short reach the round that one long fit shows to be the best, also over a rise of the error."""
    train, test = _learnable(spark, 400, 0.0), _learnable(spark, 900, 0.0).where("id >= 400")
    pipe = M.build_pipeline(["x0", "x1", "x2"], "y", maxDepth=2, maxIter=24, subsamplingRate=0.5, stepSize=0.2)
    clean, assembler, gbt = pipe.getStages()
    ready = [assembler.transform(clean.transform(df)) for df in (train, test)]
    errors = gbt.fit(ready[0]).evaluateEachIteration(ready[1], "squared")
    for patience in (1, 4):
        want, over = M.best_round(errors, patience)
        model, best, rounds = M.fit_with_patience(pipe, train, test, patience, stages=(3, 9))
        assert (best, model.stages[-1].getNumTrees) == (want, want)
        assert rounds - best >= patience if over else rounds == 24
    error = M.predict(model, test).agg(F.avg((F.col("y") - F.col("predicted_fantasy_points")) ** 2)).first()[0]
    assert abs(error - errors[want - 1]) < 1.0  # the model cut to its best round


def test_model_of_the_best_round_is_cut_not_fitted_again(spark, monkeypatch, tmp_path):
    rows = _learnable(spark, 900, 0.0).withColumn("y", F.col("y") + F.pmod(F.xxhash64("id"), F.lit(40)))  # too noisy for 24 rounds
    train, test = rows.where("id < 400").coalesce(1), rows.where("id >= 400")
    pipe = M.build_pipeline(["x0", "x1", "x2"], "y", maxDepth=4, maxIter=24, subsamplingRate=0.5, stepSize=0.2)
    fits = []
    fit = M.GBTRegressor._fit
    monkeypatch.setattr(M.GBTRegressor, "_fit", lambda self, df: (fits.append(self.getMaxIter()), fit(self, df))[1])
    model, best, rounds = M.fit_with_patience(pipe, train, test, 4, stages=(24,))
    assert fits == [24] and 0 < best < rounds == 24
    ready = pipe.getStages()[1].transform(pipe.getStages()[0].transform(train))
    again = pipe.getStages()[2].copy({pipe.getStages()[2].maxIter: best}).fit(ready)
    cut = model.stages[-1]
    assert (cut.getNumTrees, cut.numFeatures, cut.treeWeights, cut.getMaxIter()) == (best, 3, again.treeWeights, best)
    assert [t.toDebugString.split("\n", 1)[1] for t in cut.trees] == [t.toDebugString.split("\n", 1)[1] for t in again.trees]
    of = lambda m: {r["id"]: r["raw_prediction"] for r in m.transform(ready.select("id", "features")).collect()}
    assert of(cut) == of(again) == of(M.load_model(M.save_model(model, str(tmp_path / "cut")), ["x0", "x1", "x2"]).stages[-1])


def test_fit_waves():
    assert M.fit_waves([10, 20, 30, 40, 50], 150) == [[0, 1, 2, 3, 4]]
    assert M.fit_waves([10, 20, 30, 40, 50], 40) == [[0, 1], [2], [3], [4]]  # the last is too large and runs alone
    assert M.fit_waves([30, 10, 20], 30) == [[1, 2], [0]]
    assert M.fit_waves([], 10) == []
    assert M.stages_after(3, 50) == (61, 80, 160, 320) and M.stages_after(200, 50) == (455,)


def test_folds_that_do_not_fit_in_memory_are_fitted_in_waves(spark, monkeypatch):
    """The same folds, models and metrics; a wave tries the rounds that those before it ask for."""
    days = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 4).cast("int"))
    rows = spark.range(600).select(
        F.col("id").alias("match_id"), F.lit(1).alias("player_id"), days.alias("match_date"),
        *[(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)) / 10.0).alias(name) for k, name in enumerate(FE.FEATURES)],
        F.pmod(F.xxhash64("id"), F.lit(90)).cast("double").alias("fantasy_points"))
    assert M.rows_in_memory(spark) > 100_000
    whole = M.fit_with_patience
    got, tried = [], []
    monkeypatch.setattr(M, "fit_with_patience", lambda pipe, tr, te, patience, stages: (tried.append((tr.count(), stages)), whole(
        pipe, tr, te, patience, stages))[1])
    for room in (10**6, 350):
        monkeypatch.setattr(M, "rows_in_memory", lambda spark, room=room: room)
        res = M.train(spark, rows, early_stopping=True, patience=2, maxIter=8, maxDepth=2)
        got.append(sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in res.cv.drop("rounds").collect()))
    assert got[0] == got[1] and len(got[0]) == 5
    assert sorted(n for n, _ in tried[:5]) == [100, 200, 300, 400, 500] and {s for _, s in tried[:5]} == {M.ROUND_STAGES}
    assert sorted(n for n, _ in tried[5:7]) == [100, 200] and [n for n, _ in tried[7:]] == [300, 400, 500]
    assert all(s[0] < M.ROUND_STAGES[0] for _, s in tried[7:])


def test_folds_learn_a_learnable_target(spark):
    """Fold errors lie well below the spread of the target, and the features that make it lead the importances."""
    days = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 4).cast("int"))
    feats = spark.range(600).select(
        F.col("id").alias("match_id"), F.lit(1).alias("player_id"), days.alias("match_date"),
        *[(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)) / 10.0).alias(name) for k, name in enumerate(FE.FEATURES)])
    a, b = FE.FEATURES[0], FE.FEATURES[7]
    res = M.train(spark, feats.withColumn("fantasy_points", F.col(a) + F.when(F.col(b) > 50, 40.0).otherwise(0.0)),
                  early_stopping=True, patience=3, maxIter=20, maxDepth=4)
    for r in res.cv.collect():
        assert r["rmse"] < 0.5 * r["target_std"] and r["r2"] > 0.75
        assert r["rounds"] - r["best_iteration"] >= 3 or r["rounds"] == 20
    assert {r["feature"] for r in res.feature_importance.limit(2).collect()} == {a, b}


def test_model_from_the_first_place_that_fits(spark, tmp_path):
    """A missing place, a damaged model and models of other features are passed over."""
    rows = _learnable(spark, 60, 0.0)
    fit = lambda names: M.build_pipeline(names, "y", maxDepth=1, maxIter=1).fit(rows)
    path = {k: str(tmp_path / k) for k in ("missing", "damaged", "few", "turned", "right")}
    right = fit(["x0", "x1", "x2"])
    M.save_model(right, path["right"])
    M.save_model(fit(["x0", "x1"]), path["few"])
    M.save_model(fit(["x1", "x0", "x2"]), path["turned"])
    M.save_model(right, path["damaged"])
    for f in (tmp_path / "damaged" / "metadata").glob("*"):
        f.unlink()
    for f in (tmp_path / "damaged" / "metadata").glob(".*"):
        f.unlink()
    wanted = ["x0", "x1", "x2"]
    got = M.load_model(list(path.values()), wanted)
    assert M.model_features(got) == wanted
    both = [sorted(r["predicted_fantasy_points"] for r in M.predict(m, rows).collect()) for m in (got, right)]
    assert both[0] == both[1]
    assert M.model_features(M.load_model(path["few"], None)) == ["x0", "x1"]
    with pytest.raises(ValueError) as e:
        M.load_model([path[k] for k in ("missing", "damaged", "few", "turned")], wanted)
    assert all(path[k] in str(e.value) for k in ("missing", "damaged", "few", "turned"))
    assert "lacks ['x2']" in str(e.value) and "another order" in str(e.value)


def test_both_models_score_the_same_stored_features(spark, monkeypatch):
    from anchorwise.plans import model_queries as Q

    train = Q._features(spark, SF001, lambda inn: A.training_anchors(inn, Q.TRAIN_CUTOFF))
    small = M.train(spark, train, cv=False, maxIter=2, maxDepth=2)
    built = []
    build = FE.build_features
    monkeypatch.setattr(Q, "_trained", lambda spark, sf: small)
    monkeypatch.setattr(FE, "build_features", lambda *a, **kw: (built.append(1), build(*a, **kw))[1])
    got = Q.save_load_model_check(spark, SF001)
    assert len(built) == 1 and got.columns == ["match_id", "player_id", "equal"]
    rows = got.collect()
    want = Q.train_predict(spark, SF001).select("match_id", "player_id").collect()
    assert len(rows) > 100 and sorted((r[0], r[1], True) for r in want) == sorted(map(tuple, rows))


def test_folds_partition_time_order(spark):
    rows = A.training_anchors(fx.innings(spark, SF0001))
    f = M.time_series_folds(rows).collect()
    n = len(f)
    assert sorted(r["pos"] for r in f) == list(range(n))
    size = n // 6
    for r in f:
        if r["test_fold"] >= 0:  # a test row is never in its own fold's training set
            assert r["first_train_fold"] == -1 or r["first_train_fold"] > r["test_fold"]


def test_full_flow_teams_are_valid(spark):
    team = E.queries()["pick_teams"](spark, SF001)
    v = SEL.validate_team(team).collect()
    assert len(v) > 0 and all(r["valid"] for r in v)
