"""Boosted-tree regressor with forward-chaining validation.

* The feature table is checkpointed (reliably, into ``spark.checkpoint.dir``)
  before the folds, so six fits reuse one materialisation and survive executor loss.
* A fit reads its rows once a level of every tree, from the executors' memory while they fit there. Folds are fitted at
  once only as far as their rows fit together (``fit_waves``).
* Fold ids come from each row's position in (match_date, match_id, player_id)
  order; the position is a two-level prefix sum (season subtotals, then a
  running count inside the season), so no single task sees every row.
* Metrics are plain aggregates on the prediction table, joined on the anchor
  key (the reference compared rows by position, Q19).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.cleaning import clip
from ..session import shared_dir
from .features import FEATURES
from .tasks import task_count

# Reference hyper-parameters mapped to Spark ML. xgboost's L1/L2 leaf penalties and
# gamma have no Spark counterpart (Spark's split gain is a per-row impurity drop).
GBT_DEFAULTS = dict(maxDepth=8, minInstancesPerNode=3, subsamplingRate=0.8, featureSubsetStrategy="0.8",
                    stepSize=0.05, maxIter=500, seed=42)
TARGET_RANGE = (-5.0, 200.0)
PREDICTION_CLIP = (-2.0, 200.0)
VARIANCE_THRESHOLD = 10.0
N_SPLITS = 5
ROWS_PER_TASK = 3_000_000  # at most (some 250 bytes each in the store, which goes to disk when full)
BUSY_ROWS = 1_000_000  # rows a core of fits that run at once: more keep it no busier
MATCH_ROWS = 100_000  # rows of a task that ranks whole matches, on average
PATIENCE, ROUND_STAGES = 50, (80, 160, 320)  # rounds without a lower error; rounds that are tried before all
SPARE_ROUNDS = 5  # tried beyond what the folds before ask for
# In the executors' memory a row of a fit is a tree point (an int a feature), a sample count and up to three errors of past rounds.
POINT_BYTES, BYTES_A_FEATURE = 160, 4


def _clean_sql(features: list[str]) -> str:
    """P14 as a pipeline stage: null, NaN, +-inf -> 0 for every feature."""
    exprs = []
    for f in features:
        d = f"CAST(`{f}` AS DOUBLE)"
        exprs.append(f"CASE WHEN {d} IS NULL OR isnan({d}) OR abs({d}) = double('inf') THEN 0D ELSE {d} END AS `{f}__x`")
    return f"SELECT *, {', '.join(exprs)} FROM __THIS__"


def build_pipeline(features: list[str] = FEATURES, label: str = "fantasy_points", **gbt) -> Pipeline:
    """P14 -> assembler (carries the feature list) -> GBT."""
    return Pipeline(stages=[
        SQLTransformer(statement=_clean_sql(features)),
        VectorAssembler(inputCols=[f"{f}__x" for f in features], outputCol="features"),
        GBTRegressor(featuresCol="features", labelCol=label, predictionCol="raw_prediction", **{**GBT_DEFAULTS, **gbt}),
    ])


# ---------------------------------------------------------------- early stopping with patience (M6)

def best_round(errors: list[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """The round (from 1) of the lowest error seen before ``patience`` rounds went by without a lower one, and
    whether those rounds went by: if not, more rounds may still find a better one."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_with_patience(pipe: Pipeline, train: DataFrame, validation: DataFrame, patience: int = PATIENCE,
                      stages: tuple[int, ...] = ROUND_STAGES) -> tuple[PipelineModel, int, int]:
    """M6: the model at its best round on ``validation``, that round, and the number of rounds that were looked at.

    Spark's own early stopping ends at the first round that doesn't improve. Here a fit of ``stages[0]`` rounds is judged
    round by round (``evaluateEachIteration``); while its best round has fewer than ``patience`` rounds behind it, the
    next stage fits more, up to the estimator's ``maxIter``. A seeded fit begins with the trees of any shorter one,
    so the last fit, cut to the best round, is the model: it isn't fitted again.
    """
    clean, assembler, gbt = pipe.getStages()
    most = gbt.getMaxIter()
    ready = [assembler.transform(clean.transform(df)).select("features", gbt.getLabelCol()) for df in (train, validation)]
    best = rounds = 0
    trees = None
    for rounds in sorted({min(n, most) for n in (*stages, most)}):
        trees = gbt.copy({gbt.maxIter: rounds}).fit(ready[0])
        best, over = best_round(trees.evaluateEachIteration(ready[1], "squared"), patience)
        if over:
            break
    return PipelineModel([clean, assembler, first_trees(train.sparkSession, gbt, trees, best)]), best, rounds


def first_trees(spark: SparkSession, gbt: GBTRegressor, model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The model that ``gbt`` gives in so many rounds, from one of more rounds: its first trees with their weights."""
    if rounds >= model.getNumTrees:
        return model
    kinds, whole, array = spark._jvm.org.apache.spark.ml.regression, model._java_obj, spark.sparkContext._gateway.new_array
    trees, weights = array(kinds.DecisionTreeRegressionModel, rounds), array(spark._jvm.double, rounds)
    for i, (tree, weight) in enumerate(zip(whole.trees()[:rounds], model.treeWeights[:rounds])):
        trees[i], weights[i] = tree, weight
    cut = GBTRegressionModel(kinds.GBTRegressionModel(whole.uid(), trees, weights, model.numFeatures))
    return gbt.copy({gbt.maxIter: rounds})._copyValues(cut)


def stages_after(best: int, patience: int = PATIENCE) -> tuple[int, ...]:
    """The rounds to try where other folds had their best round by ``best``: twice as many, and the patience."""
    first = 2 * best + SPARE_ROUNDS + patience
    return first, *[n for n in ROUND_STAGES if n > first]


def rows_in_memory(spark: SparkSession, features: int = len(FEATURES)) -> int:
    """How many rows of fits the executors hold in memory together (with a local master, the driver)."""
    status, most = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().iterator(), {}
    while status.hasNext():
        entry = status.next()
        most[entry._1()] = entry._2()._1()
    driver = most.pop(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().blockManagerId().hostPort(), 0)
    return (sum(most.values()) or driver) // (POINT_BYTES + BYTES_A_FEATURE * features)


def fit_waves(sizes: Sequence[int], most: int) -> list[list[int]]:
    """Which fits (by place in ``sizes``, their rows) run at once, the smallest first: as many as ``most`` rows hold, one at least."""
    waves, room = [], 0
    for i in sorted(range(len(sizes)), key=sizes.__getitem__):
        if not waves or sizes[i] > room:
            waves.append([])
            room = most
        waves[-1].append(i)
        room -= sizes[i]
    return waves


def training_rows(features: DataFrame, label: str = "fantasy_points") -> DataFrame:
    """P13 + P15: rows with a target inside the outlier range."""
    return features.where(F.col(label).isNotNull() & F.col(label).between(*TARGET_RANGE))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Transform, clip to [-2, 200], keep the input columns."""
    out = model.transform(df)
    return out.withColumn("predicted_fantasy_points", clip(F.col("raw_prediction"), *PREDICTION_CLIP)).drop(
        "features", "raw_prediction", *[c for c in out.columns if c.endswith("__x")])


def time_series_folds(rows: DataFrame, n_splits: int = N_SPLITS) -> DataFrame:
    """M5: sklearn ``TimeSeriesSplit`` on (match_date, match_id, player_id) order.

    Adds ``pos``, ``test_fold`` (-1 = only ever train) and ``first_train_fold``
    (-1 = never train). test size = n div (n_splits + 1); fold f tests
    [n - (n_splits - f) * size, n - (n_splits - f - 1) * size) and trains on
    everything before it. A match is ranked in one task, so the rows are dealt by match into tasks counted in rows.
    """
    spark = rows.sparkSession
    tasks = task_count(spark, rows.count(), MATCH_ROWS)
    if tasks > 1:  # no fewer than the session's, or the join with the matches deals the rows once more
        rows = rows.repartition(max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions"))), "match_date", "match_id")
    per_match = rows.groupBy(F.year("match_date").alias("_yr"), "match_date", "match_id").agg(F.count(F.lit(1)).alias("_m"))
    per_year = per_match.groupBy("_yr").agg(F.sum("_m").alias("_y"))
    wy = Window.orderBy("_yr")  # one row per season: bounded by the number of seasons
    per_year = per_year.select("_yr", F.coalesce(F.sum("_y").over(wy.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                               .alias("_yoff"), F.sum("_y").over(wy.rowsBetween(Window.unboundedPreceding,
                                                                                Window.unboundedFollowing)).alias("_n"))
    wm = Window.partitionBy("_yr").orderBy("match_date", "match_id").rowsBetween(Window.unboundedPreceding, -1)
    per_match = per_match.withColumn("_moff", F.coalesce(F.sum("_m").over(wm), F.lit(0))).join(per_year, "_yr")
    wr = Window.partitionBy("match_date", "match_id").orderBy("player_id")
    r = rows.join(per_match.drop("_m"), ["match_date", "match_id"]).withColumn(
        "pos", F.col("_yoff") + F.col("_moff") + F.row_number().over(wr) - 1)
    n, pos = F.col("_n"), F.col("pos")
    size = (n / (n_splits + 1)).cast("long")
    start = n - size * n_splits
    test_fold = F.when(pos >= start, ((pos - start) / size).cast("long")).otherwise(F.lit(-1))
    first = F.greatest(F.floor(F.lit(n_splits) - (n - pos) / size) + 1, F.lit(0))
    first = F.when(first <= n_splits - 1, first).otherwise(F.lit(-1))
    return r.select(*rows.columns, pos.alias("pos"), test_fold.cast("int").alias("test_fold"),
                    first.cast("int").alias("first_train_fold"), size.alias("test_size"))


def regression_metrics(pred: DataFrame, y: str = "y", yhat: str = "yhat", by: list[str] | None = None) -> DataFrame:
    """M7-M9: RMSE, MAE, R², variance score and spread gate as aggregates (population std, numpy)."""
    e = F.col(y) - F.col(yhat)
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(e * e).alias("_mse"), F.avg(F.abs(e)).alias("mae"),
            F.var_pop(y).alias("_vy"), F.var_pop(yhat).alias("_vp"), F.stddev_pop(yhat).alias("prediction_std"),
            F.stddev_pop(y).alias("target_std")]
    g = pred.groupBy(*(by or [])).agg(*aggs)
    ratio = F.col("_vp") / F.col("_vy")
    return g.select(
        *(by or []), "n",
        F.sqrt("_mse").alias("rmse"), "mae",
        (F.lit(1.0) - F.col("_mse") / F.col("_vy")).alias("r2"),
        F.when(F.col("_vy") == 0, F.lit(0.0)).otherwise(F.lit(1.0) / (F.lit(1.0) + F.abs(ratio - F.lit(1.0)))).alias("variance_score"),
        "prediction_std", "target_std",
        (F.col("prediction_std") >= VARIANCE_THRESHOLD).alias("avoiding_average_trap"),
    )


@dataclass
class TrainResult:
    model: PipelineModel
    metrics: DataFrame
    cv: DataFrame
    feature_importance: DataFrame
    extra: dict = field(default_factory=dict)


def train(spark: SparkSession, features: DataFrame, label: str = "fantasy_points", n_splits: int = N_SPLITS,
          key: tuple[str, ...] = ("match_id", "player_id"), cv: bool = True, early_stopping: bool = False,
          patience: int = PATIENCE, **gbt) -> TrainResult:
    """M4 + M5 + M10 + M11: forward-chaining CV (optional), final fit on everything, metrics record.

    ``early_stopping`` (M6): each fold's model is the one at its best round on its own test block (the reference's
    eval set), found with ``patience``; the final model is fitted on all rows with the mean of the rounds that the folds
    found (rounded up), its ``best_iteration``. Without it, or without folds, every fit trains all ``maxIter`` rounds.
    """
    shared_dir(spark)
    rows = training_rows(features, label).checkpoint()  # reliable, in spark.checkpoint.dir: the folds read them three times
    folded = time_series_folds(rows, n_splits)
    early_stopping = early_stopping and cv
    n, cores = rows.count(), spark.sparkContext.defaultParallelism
    sizes = [n - (n_splits - f) * (n // (n_splits + 1)) for f in range(n_splits)] if cv else []
    if not early_stopping:
        sizes.append(n)  # the final fit, which then needs no fold
    waves = fit_waves(sizes, min(rows_in_memory(spark), cores * BUSY_ROWS))
    # a tree is one job a level, and each of its tasks costs a start, a full set of split statistics and a result to the driver: where
    # all folds are fitted at once, half a task a core each keeps the cores busy; where they are not, a task a core, or some a core
    # each. Dealt by the key, every fold's rows lie in all tasks
    tasks = task_count(spark, n, ROWS_PER_TASK, share=0.5 if len(waves) == 1 else 1.0)
    if len(waves) > 1 and tasks > cores:
        tasks = math.ceil(tasks / cores) * cores
    folded = (folded.repartition(tasks, *key).checkpoint() if tasks > 1 else folded.checkpoint().coalesce(1))
    pipe = build_pipeline(label=label, **gbt)

    def fit_fold(f: int, stages: tuple[int, ...]) -> tuple[DataFrame, int]:
        tr = folded.where((F.col("first_train_fold") >= 0) & (F.col("first_train_fold") <= f))
        te = folded.where(F.col("test_fold") == f)
        if early_stopping:
            m, best, rounds = fit_with_patience(pipe, tr, te, patience, stages)
        else:
            m = pipe.fit(tr)
            best = rounds = m.stages[-1].getNumTrees
        p = predict(m, te).select(F.col(label).alias("y"), F.col("predicted_fantasy_points").alias("yhat"))
        r = regression_metrics(p).withColumns({"fold": F.lit(f), "best_iteration": F.lit(best), "rounds": F.lit(rounds)})
        return spark.createDataFrame(r.collect(), r.schema), best  # one metrics row per fold, kept with its fold

    # the folds of a wave are fitted concurrently, Spark interleaves their jobs on the executors (small per-iteration GBT
    # jobs otherwise leave most cores idle); so is the final fit, unless the folds tell its rounds. A wave tries the rounds
    # that those before it ask for
    found: dict[int, tuple[DataFrame, int]] = {}
    final_fit = None
    for wave in waves:
        stages = stages_after(max(best for _, best in found.values()), patience) if found else ROUND_STAGES
        with ThreadPoolExecutor(max_workers=len(wave)) as pool:
            fits = {f: pool.submit(fit_fold, f, stages) if cv and f < n_splits else pool.submit(pipe.fit, folded) for f in wave}
            for f, fit in fits.items():
                if cv and f < n_splits:
                    found[f] = fit.result()
                else:
                    final_fit = fit.result()
    parts = [found[f] for f in sorted(found)]
    model = final_fit or build_pipeline(
        label=label, **{**gbt, "maxIter": math.ceil(sum(n for _, n in parts) / len(parts))}).fit(folded)
    best = F.lit(model.stages[-1].getNumTrees).alias("best_iteration")
    if not parts:
        final = regression_metrics(predict(model, folded).select(
            F.col(label).alias("y"), F.col("predicted_fantasy_points").alias("yhat")))
        no_folds = final.withColumn("fold", F.lit(0)).withColumns(
            {"best_iteration": F.lit(0), "rounds": F.lit(0)}).limit(0)
        return TrainResult(model, final.select("*", F.lit(len(FEATURES)).alias("feature_count"), best), no_folds,
                           feature_importance(spark, model))
    cv = parts[0][0]
    for c, _ in parts[1:]:
        cv = cv.unionByName(c)
    fitted = predict(model, folded).select(*key, F.col(label).alias("y"), F.col("predicted_fantasy_points").alias("yhat"))
    final = regression_metrics(fitted)
    cv_sum = cv.agg(F.avg("rmse").alias("cv_mean_rmse"), (F.stddev_pop("rmse") * 2).alias("cv_rmse_2std"),
                    F.avg("variance_score").alias("cv_mean_variance_score"),
                    (F.stddev_pop("variance_score") * 2).alias("cv_variance_2std"))
    metrics = final.select("*", *[cv_sum.select(c).scalar().alias(c) for c in cv_sum.columns],
                           F.lit(len(FEATURES)).alias("feature_count"), best)
    return TrainResult(model, metrics, cv, feature_importance(spark, model))


def feature_importance(spark: SparkSession, model: PipelineModel, top_n: int | None = None) -> DataFrame:
    """Importances zipped with the assembler's inputs (the saved model carries the feature list)."""
    names = model_features(model)
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = sorted(zip(names, imp), key=lambda t: (-t[1], t[0]))
    df = spark.createDataFrame(rows, "feature string, importance double")  # one row per feature (30)
    return df.limit(top_n) if top_n else df


def save_model(model: PipelineModel, path: str) -> str:
    """The fitted pipeline (cleaning, assembler with the feature list, trees)."""
    model.write().overwrite().save(path)
    return path


def model_features(model: PipelineModel) -> list[str]:
    """The features that the model was trained on, in order: the assembler's inputs."""
    assembler = next((s for s in model.stages if isinstance(s, VectorAssembler)), None)
    return [c.removesuffix("__x") for c in assembler.getInputCols()] if assembler else []


def load_model(paths: str | Sequence[str], features: Sequence[str] | None = tuple(FEATURES)) -> PipelineModel:
    """The first of the places that holds a readable model of these features, in this order (None: any).

    A place without a model, with a damaged one or with one of other features is passed over; if none is left, the
    error names what is wrong with each."""
    wrong = []
    for path in [paths] if isinstance(paths, str) else paths:
        try:
            model = PipelineModel.load(path)
        except (Py4JJavaError, PySparkException, ValueError, TypeError) as e:  # the last two: damaged metadata
            wrong.append(f"{path}: no readable model ({type(e).__name__})")
            continue
        own = model_features(model)
        if features is None or own == list(features):
            return model
        lacking, surplus = [f for f in features if f not in own], [f for f in own if f not in features]
        wrong.append(f"{path}: other features (lacks {lacking}, has besides {surplus})" if lacking or surplus
                     else f"{path}: the features in another order")
    raise ValueError("no usable model: " + "; ".join(wrong))
