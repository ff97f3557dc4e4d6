"""Model jobs on pyspark.ml: features to split, fit, scores and reports."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml import Pipeline as Stages
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staylytics import constants as C
from staylytics.operators import features as fe
from staylytics.operators.monitoring import classification_metrics, regression_metrics, roc_auc
from staylytics.plans.scoring import meal_outputs, price_outputs, risk_level
from staylytics.session import scratch_path, scratch_root, settle

# Sizes of the models: (boosting rounds or trees, depth). Every round sees a fresh 80 % of the rows, a parameter of the model.
FULL_SIZES = {"occupancy": (300, 5), "pricing": (300, 5), "restaurant": (250, 4), "staffing": (250, 4), "churn": (300, 5), "forest": (300, 8)}


LEAST_ROWS = 15_000  # rows that make a partition of a boosted model worth its tasks
BAG_ROWS = 4_000  # the same for a forest, whose task reads a row once for every tree
CHECKPOINT_ROUNDS = 5  # every task of a round is sent the lineage since the last checkpoint


def date_split(df: DataFrame, day: str, test_share: float = 0.2) -> DataFrame:
    """Train on the earliest dates: the cut is a date, so rows of one date never straddle it.

    The dates are distinct days, so the window runs over one row per calendar day.
    """
    ranked = df.select(day).distinct().withColumn("_p", F.percent_rank().over(Window.orderBy(day)))
    cut = ranked.where(F.col("_p") <= 1 - test_share).agg(F.max(day)).scalar()
    return df.withColumn("split", F.when(F.col(day) <= cut, "train").otherwise("test"))


def boosted_regressor(inputs: Sequence[str], label: str, size: tuple[int, int], out: str = "prediction") -> Stages:
    rounds, depth = size
    return Stages(stages=[
        VectorAssembler(inputCols=list(inputs), outputCol="_x", handleInvalid="keep"),
        GBTRegressor(featuresCol="_x", labelCol=label, predictionCol=out, maxIter=rounds, maxDepth=depth, stepSize=0.05,
                     subsamplingRate=0.8, checkpointInterval=CHECKPOINT_ROUNDS, seed=42),
    ])


def _gathered(train: DataFrame, least: int = LEAST_ROWS) -> DataFrame:
    """The training rows dealt over the cores: boosting runs thousands of short jobs, each with a task per partition, so few rows
    stay together. Tables with more partitions than cores keep them. Checkpoints keep the lineage of the rounds short."""
    context = train.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(train.sparkSession))
    train = settle(train)
    dealt = min(context.defaultParallelism, -(-train.count() // least))
    return train.repartition(max(1, dealt)) if train.rdd.getNumPartitions() <= context.defaultParallelism else train


def fit_regressor(df: DataFrame, inputs: Sequence[str], label: str, size: tuple[int, int], out: str = "prediction") -> PipelineModel:
    train = df.where("split = 'train'").withColumn(label, F.col(label).cast("double")).na.drop(subset=[label])
    return boosted_regressor(inputs, label, size, out).fit(_gathered(train.select(*inputs, label)))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).drop("_x", "rawPrediction")


def evaluate_regressor(model: PipelineModel, df: DataFrame, label: str, name: str, out: str = "prediction") -> DataFrame:
    """Errors on the test part, and the error there of always predicting the mean of the training part."""
    mean = df.where("split = 'train'").agg(F.avg(label)).scalar()
    test = predict(model, df.where("split = 'test'")).withColumn("_mean", mean)
    naive = regression_metrics(test, label, "_mean").select("rmse").scalar()
    return regression_metrics(test, label, out).select(F.lit(name).alias("model_name"), "mae", "rmse", "mape", naive.alias("naive_rmse"), "n")


# ---- domain tables ---------------------------------------------------------------------------------------------


def occupancy_table(daily: DataFrame, calendar: DataFrame) -> DataFrame:
    return date_split(fe.occupancy_features(daily, calendar), "occupancy_date")


def pricing_table(daily: DataFrame, calendar: DataFrame, room_types: DataFrame) -> DataFrame:
    df = fe.add_calendar(daily.withColumnRenamed("occupancy_date", "date"), "date", calendar)
    df = fe.fill_with_medians(fe.add_room_types(fe.add_demand_index(df), room_types), ["base_price_multiplier"])
    for c in ("season", "room_type_name"):
        df = fe.apply_categories(df, c, fe.fit_categories(df, c))
    return date_split(df, "date")


def scaled_prices(df: DataFrame) -> DataFrame:
    """Numeric inputs scaled by the training part; the raw occupancy is kept for the revenue arithmetic."""
    fitted = fe.fit_scaler(df.where("split = 'train'"), C.PRICING_NUMERIC)
    raw = df.withColumn("_raw_pct", F.col("occupancy_pct"))
    return fe.apply_scaler(raw, C.PRICING_NUMERIC, fitted)


def restaurant_table(mart: DataFrame, calendar: DataFrame) -> DataFrame:
    return date_split(fe.restaurant_features(mart, calendar), "date")


def staffing_table(mart: DataFrame, calendar: DataFrame) -> DataFrame:
    return date_split(fe.staff_features(mart, calendar), "date")


def churn_table(dim_guest: DataFrame, fact: DataFrame) -> DataFrame:
    df = fe.churn_features(dim_guest, fact).na.drop(subset=["last_stay_date"])
    return df.withColumn("split", fe.hash_split(F.col("guest_key")))


# ---- churn -----------------------------------------------------------------------------------------------------


BINS = 32  # values of a feature that the trees tell apart, as by default in pyspark.ml
PARTS = 50_000  # a part of equal rows holds at most this share of the training rows
_BINNED = [f"_{c}" for c in C.CHURN_FEATURES]


def _edges(rows: DataFrame, columns: Sequence[str]) -> list[list[float]]:
    """Where the bins of each column begin: between all values of a column that has at most ``BINS`` of them, at quantiles otherwise."""
    cuts = [i / BINS for i in range(1, BINS)]
    typed = rows.select(*[F.col(c).cast("double").alias(c) for c in columns])
    first = typed.agg(*[F.struct(F.approx_count_distinct(c).alias("n"), F.percentile_approx(c, cuts, 10_000).alias("q")).alias(c) for c in columns]).first()
    few = [c for c in columns if first[c]["n"] <= 2 * BINS]  # the count is near, so a set that is collected stays small
    sets = typed.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in few]).first() if few else {}
    edges = []
    for c in columns:
        if c in few and len(sets[c]) <= BINS:
            found = [(a + b) / 2 for a, b in zip(sets[c], sets[c][1:])]
        else:
            found = first[c]["q"]
        edges.append([-math.inf, *(sorted({x for x in found if math.isfinite(x)}) or [0.0]), math.inf])
    return edges


def _parts(train: DataFrame, label: str, binned: Bucketizer, balanced: bool) -> DataFrame:
    """The training rows by bins and label, with the weight of their class as often as they occur.

    Trees see nothing but bins, so equal rows count as one of their joint weight, and the table stays small when the rows grow. Draws of rows
    (bags, rounds) take a part or leave it: equal rows make several parts if they are more than the ``PARTS``-th share of all.
    """
    cells = settle(binned.transform(train).groupBy(*_BINNED, label).agg(F.count("*").alias("_rows")))
    most = F.ceil(cells.agg(F.sum("_rows")).scalar() / PARTS)
    parts = F.ceil(F.col("_rows") / most)
    weighted = cells.withColumn("_weight", _class_weight(cells, label, "_rows", balanced) * F.col("_rows") / parts)
    return weighted.select(*_BINNED, label, "_weight", F.explode(F.sequence(F.lit(1), parts.cast("int")))).drop("col")


def _class_weight(df: DataFrame, label: str, rows: str, balanced: bool) -> Column:
    """Balanced: n / (2 * class size) for both classes; otherwise positives weigh negatives / positives. ``rows`` counts equal rows."""
    sizes = df.agg(F.struct(
        F.sum(rows).alias("n"), F.sum(F.when(F.col(label) == 1, F.col(rows)).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label) == 0, F.col(rows)).otherwise(0)).alias("neg"),
    )).scalar()
    n, pos, neg = sizes["n"], sizes["pos"], sizes["neg"]
    if balanced:
        own = F.when(F.col(label) == 1, pos).otherwise(neg)
        return n / (2 * own)
    return F.when(F.col(label) == 1, F.coalesce(F.try_divide(neg, pos), F.lit(1.0))).otherwise(1.0)


def _stored(model: PipelineModel, spark: SparkSession) -> PipelineModel:
    """The model as read back from the shared folder. A fitted forest holds its training summary, and with that the session, which
    no task can be sent once it has observed metrics; a stored model has no summary."""
    path = scratch_path(spark, "model")
    model.write().save(path)
    return PipelineModel.read().session(spark).load(path)


def fit_churn(df: DataFrame, kind: str, size: tuple[int, int]) -> PipelineModel:
    train = df.where("split = 'train'").select(*C.CHURN_FEATURES, "churn")
    binned = Bucketizer(splitsArray=_edges(train, C.CHURN_FEATURES), inputCols=C.CHURN_FEATURES, outputCols=_BINNED)
    shared = {"featuresCol": "_x", "labelCol": "churn", "weightCol": "_weight", "maxDepth": size[1], "maxBins": BINS, "seed": 42}
    forest = kind == "random_forest"
    if forest:
        learner = RandomForestClassifier(numTrees=size[0], **shared)
    else:
        learner = GBTClassifier(maxIter=size[0], stepSize=0.05, subsamplingRate=0.8, checkpointInterval=CHECKPOINT_ROUNDS, **shared)
    vectors = VectorAssembler(inputCols=_BINNED, outputCol="_x")
    rows = _gathered(_parts(train, "churn", binned, balanced=forest), BAG_ROWS if forest else LEAST_ROWS)
    fitted = PipelineModel([binned, vectors, learner.fit(vectors.transform(rows))])
    return _stored(fitted, df.sparkSession)


def churn_probabilities(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with prediction and probability. Rows of equal bins get the same, so the trees are asked once for them."""
    binned = model.stages[0].transform(df)
    found = PipelineModel(model.stages[1:]).transform(binned.select(*_BINNED).distinct())
    cells = settle(found.select(*_BINNED, "prediction", vector_to_array("probability")[1].alias("probability")))
    return binned.join(cells, _BINNED).drop(*_BINNED)


def evaluate_churn(model: PipelineModel, df: DataFrame, name: str) -> DataFrame:
    test = churn_probabilities(model, df.where("split = 'test'"))
    area = roc_auc(test, "churn", "probability").scalar()
    return classification_metrics(test, "churn", "prediction").select(F.lit(name).alias("model_name"), "*", area.alias("roc_auc"))


def score_guests(model: PipelineModel, guests: DataFrame, requests: DataFrame, model_name: str) -> DataFrame:
    """Churn score for a table of requested guest ids.

    Guests without bookings get the level 'Unknown'; ids that do not exist get an error text instead of a score.
    """
    scored = churn_probabilities(model, guests.where("lifetime_bookings >= 1").na.drop(subset=C.CHURN_FEATURES)).select(
        F.col("guest_key").alias("guest_id"), "probability"
    )
    known = guests.select(F.col("guest_key").alias("guest_id"), F.lit(True).alias("_known"))
    out = requests.select("guest_id").join(known, "guest_id", "left").join(scored, "guest_id", "left")
    p = F.col("probability")
    return out.select(
        "guest_id", F.bround(p, 4).alias("churn_probability"),
        F.when(F.col("_known").isNull(), None).when(p.isNull(), "Unknown").otherwise(risk_level(p)).alias("risk_level"),
        F.lit(model_name).alias("model_used"),
        F.when(F.col("_known").isNull(), F.concat(F.lit("guest_id "), F.col("guest_id").cast("string"), F.lit(" not found"))).alias("error"),
    )


# ---- forecast --------------------------------------------------------------------------------------------------


KNOTS = 25  # possible changes of the trend, evenly over the first nine tenths of the history
RIDGE = 0.5  # holds changes of the trend down
ORIGINS = 12  # past days from which the interval is tried out
COVERAGE = 0.95


def _design(days: np.ndarray, span: float) -> np.ndarray:
    """Level, slope and changes of slope, weekday and yearly waves; ``days`` count from the first day, a Monday-0 week."""
    t = days / span
    knots = np.linspace(0, 0.9, KNOTS + 2)[1:-1]
    year = 2 * np.pi * days / 365.25
    weekday = (days[:, None] % 7 == np.arange(6)).astype(float)
    waves = [f(m * year) for m in (1, 2, 3) for f in (np.sin, np.cos)]
    return np.column_stack([np.ones_like(t), t, np.maximum(t[:, None] - knots, 0), weekday, *waves])


def fit_and_extend(days: np.ndarray, values: np.ndarray, future: np.ndarray) -> np.ndarray:
    """Values at ``future`` days from a least-squares fit whose changes of slope are held down by a ridge."""
    span = max(float(days[-1]), 1.0)
    known = _design(days, span)
    hold = np.zeros(known.shape[1])
    hold[2 : 2 + KNOTS] = RIDGE
    hold[2 + KNOTS :] = 1.0
    weights = np.linalg.lstsq(np.vstack([known, np.diag(np.sqrt(hold))]), np.concatenate([values, np.zeros(len(hold))]), rcond=None)[0]
    # the slope at the end goes on, but no change of it does
    return _design(future, span) @ weights


def interval_width(days: np.ndarray, values: np.ndarray, horizon: int) -> float:
    """Half the width that would have held ``COVERAGE`` of the values in forecasts from ``ORIGINS`` earlier days.

    A history too short for that is judged by its own fit.
    """
    missed = []
    for k in range(1, ORIGINS + 1):
        cut = int(np.searchsorted(days, days[-1] - k * horizon, "right"))
        if cut < 2 * horizon:
            break
        ahead = days[cut:] <= days[cut - 1] + horizon
        missed.append(np.abs(values[cut:][ahead] - fit_and_extend(days[:cut], values[:cut], days[cut:][ahead])))
    errors = np.concatenate(missed) if missed else np.abs(values - fit_and_extend(days, values, days))
    rank = min(1.0, COVERAGE * (1 + 1 / len(errors)))
    return float(np.quantile(errors, rank))


def forecast_occupancy(daily: DataFrame, horizon_days: int = 30) -> DataFrame:
    """Daily forecast per branch with a 95 % interval, starting the day after the branch's last date.

    Trend with changepoints, weekday and yearly waves; the interval comes from forecasts that start at earlier days of
    the history. A branch holds at most one row per day, so the group that reaches one task is bounded by the calendar.
    """
    schema = (
        "branch_id int, occupancy_date date, predicted_occupancy_pct double, ci_lower double, ci_upper double, model_used string"
    )

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("occupancy_date")
        dates = pd.DatetimeIndex(pd.to_datetime(rows["occupancy_date"]))
        start = dates[0] - pd.Timedelta(days=int(dates[0].dayofweek))
        days, values = (dates - start).days.to_numpy(dtype=float), rows["occupancy_pct"].to_numpy(dtype=float)
        known = np.isfinite(values)
        future = pd.date_range(dates[-1] + pd.Timedelta(days=1), periods=horizon_days, freq="D")
        predicted = fit_and_extend(days[known], values[known], (future - start).days.to_numpy(dtype=float))
        width = interval_width(days[known], values[known], horizon_days)
        return pd.DataFrame({
            "branch_id": int(rows["branch_id"].iloc[0]), "occupancy_date": future.date, "predicted_occupancy_pct": predicted,
            "ci_lower": predicted - width, "ci_upper": predicted + width, "model_used": "trend_and_season",
        })

    return daily.where("occupancy_pct IS NOT NULL").select("branch_id", "occupancy_date", "occupancy_pct").groupBy("branch_id").applyInPandas(fit, schema)


def backtest(daily: DataFrame, horizon_days: int = 30, windows: int = 10) -> DataFrame:
    """(branch_id, n, covered, mae, naive_mae): forecasts of the last ``windows`` periods, each from the days before it alone.

    ``covered`` is the share of values inside their interval; the naive forecast is the last known value of the weekday.
    """
    last = daily.groupBy("branch_id").agg(F.max("occupancy_date").alias("_last"))
    # every window is a history of its own, at most ``windows`` copies of the calendar
    cut = F.explode(F.sequence(F.lit(1), F.lit(windows))).alias("window")
    placed = daily.select("branch_id", "occupancy_date", "occupancy_pct", cut).join(last, "branch_id")
    ends = F.date_sub("_last", F.col("window") * horizon_days)
    known = placed.where(F.col("occupancy_date") <= ends).withColumn("key", F.col("branch_id") * windows + F.col("window") - 1)
    found = forecast_occupancy(known.select(F.col("key").alias("branch_id"), "occupancy_date", "occupancy_pct"), horizon_days)
    found = found.select(F.floor(F.col("branch_id") / windows).cast("int").alias("branch_id"), F.pmod("branch_id", F.lit(windows)).alias("window"), "occupancy_date", "predicted_occupancy_pct", "ci_lower", "ci_upper")
    truth = placed.where(F.col("occupancy_date") > ends).withColumn("window", F.col("window") - 1)
    weeks = F.ceil(F.datediff("occupancy_date", F.date_sub("_last", (F.col("window") + 1) * horizon_days)) / 7).cast("int")
    truth = truth.select("branch_id", "window", "occupancy_date", "occupancy_pct", F.date_sub("occupancy_date", weeks * 7).alias("naive_day"))
    past = daily.select("branch_id", F.col("occupancy_date").alias("naive_day"), F.col("occupancy_pct").alias("naive"))
    both = truth.join(found, ["branch_id", "window", "occupancy_date"]).join(past, ["branch_id", "naive_day"])
    off = F.abs(F.col("occupancy_pct") - F.col("predicted_occupancy_pct"))
    inside = F.col("occupancy_pct").between(F.col("ci_lower"), F.col("ci_upper"))
    return both.groupBy("branch_id").agg(
        F.count("*").alias("n"), F.avg(inside.cast("double")).alias("covered"), F.avg(off).alias("mae"),
        F.avg(F.abs(F.col("occupancy_pct") - F.col("naive"))).alias("naive_mae"),
    )


# ---- scoring ---------------------------------------------------------------------------------------------------


def score_prices(model: PipelineModel, scaled: DataFrame) -> DataFrame:
    return price_outputs(predict(model, scaled).withColumn("occupancy_pct", F.col("_raw_pct")), "prediction")


def side_by_side(run: Callable, inputs: Sequence) -> list:
    """``run`` for each input, from one driver thread each: fits of small tables leave most of a cluster idle."""
    with ThreadPool(max(1, len(inputs))) as pool:
        return pool.map(inheritable_thread_target(run), inputs)


def fit_meals(df: DataFrame, size: tuple[int, int]) -> dict[str, PipelineModel]:
    models = side_by_side(lambda m: fit_regressor(df, C.RESTAURANT_FEATURES, f"{m}_revenue", size), C.MEALS)
    return dict(zip(C.MEALS, models, strict=True))


def score_meals(models: dict[str, PipelineModel], df: DataFrame) -> DataFrame:
    """Expected revenue and quantity of every meal for each request row."""
    parts = [
        meal_outputs(predict(model, df), "prediction", "avg_item_value").select(
            "branch_id", "date", F.lit(meal).alias("meal"), "expected_quantity", "expected_revenue"
        )
        for meal, model in models.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def score_staffing(model: PipelineModel, df: DataFrame) -> DataFrame:
    return predict(model, df).select(
        "branch_id", "department_name", "date", F.bround("prediction", 0).cast("int").alias("required_staff")
    )
