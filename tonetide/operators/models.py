"""Two binary classifiers over n-gram vectors: positive and negative."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from statistics import fmean, pstdev

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tonetide.constants import (
    FOLDS,
    MAX_ITERATIONS,
    NEGATIVE_THRESHOLD,
    POSITIVE_THRESHOLD,
    REG_PARAMS,
)
from tonetide.functions.values import class_probability, flag
from tonetide.operators.sampling import key_position
from tonetide.sources.readers import estimated_bytes
from tonetide.sources.stages import shared_dir, stage, stage_model

FEATURES = "features"
FOLD = "__fold"
# Bytes of stored vectors that a task of the optimizer reads, at least.
TASK_BYTES = 16 << 20


@dataclass(frozen=True)
class Models:
    """A vocabulary and the two cross-validated classifiers trained on its vectors."""

    vocabulary: CountVectorizerModel
    positive: CrossValidatorModel
    negative: CrossValidatorModel

    def save(self, path: str) -> None:
        self.vocabulary.write().overwrite().save(f"{path}/vocabulary")
        self.positive.write().overwrite().save(f"{path}/positive")
        self.negative.write().overwrite().save(f"{path}/negative")

    @staticmethod
    def load(path: str) -> Models:
        return Models(
            CountVectorizerModel.load(f"{path}/vocabulary"),
            CrossValidatorModel.load(f"{path}/positive"),
            CrossValidatorModel.load(f"{path}/negative"),
        )


def grid(lr: LogisticRegression, reg_params: Sequence[float] = REG_PARAMS):
    """Parameter grid over the regularization strength."""
    return ParamGridBuilder().addGrid(lr.regParam, list(reg_params)).build()


def evaluator(label: str, score: str = "rawPrediction") -> BinaryClassificationEvaluator:
    """Area under ROC over all thresholds; ``numBins=0`` turns binning off."""
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=0
    )


class FoldsTogether(CrossValidator):
    """Cross-validation whose folds train at the same time, not one after the other.

    Every fit is a chain of short jobs, each waiting for the one before it. ``parallelism`` of them
    run side by side, whatever fold and parameters they belong to; with a grid of one point, the fit
    on all rows is among them. Folds, metrics and models are those of ``CrossValidator``.
    """

    def _fit(self, dataset: DataFrame) -> CrossValidatorModel:
        estimator, points = self.getOrDefault("estimator"), self.getOrDefault("estimatorParamMaps")
        judge, folds = self.getOrDefault("evaluator"), self.getOrDefault("numFolds")
        fold = F.col(self.getOrDefault("foldCol"))

        def metric(number: int, point: dict) -> float:
            model = estimator.fit(dataset.where(fold != number), point)
            return judge.evaluate(model.transform(dataset.where(fold == number)))

        with ThreadPoolExecutor(self.getOrDefault("parallelism")) as pool:
            whole = pool.submit(estimator.fit, dataset, points[0]) if len(points) == 1 else None
            found = [[pool.submit(metric, n, point) for n in range(folds)] for point in points]
            metrics = [[m.result() for m in of_point] for of_point in found]
        averages = [fmean(m) for m in metrics]
        best = averages.index(max(averages) if judge.isLargerBetter() else min(averages))
        model = whole.result() if whole else estimator.fit(dataset, points[best])
        return self._copyValues(
            CrossValidatorModel(model, averages, stdMetrics=[pstdev(m) for m in metrics])
        )


def cross_validator(
    label: str,
    reg_params: Sequence[float] = REG_PARAMS,
    folds: int = FOLDS,
    seed: int = 0,
    parallelism: int | None = None,
) -> CrossValidator:
    """``parallelism`` fits run at the same time; by default the folds and the fit on all rows."""
    lr = LogisticRegression(labelCol=label, featuresCol=FEATURES, maxIter=MAX_ITERATIONS)
    return FoldsTogether(
        estimator=lr,
        evaluator=evaluator(label),
        estimatorParamMaps=grid(lr, reg_params),
        numFolds=folds,
        foldCol=FOLD,
        seed=seed,
        parallelism=parallelism or folds + 1,
    )


def in_few_parts(df: DataFrame) -> DataFrame:
    """The rows of a stored table in parts of ``TASK_BYTES`` or more.

    Each iteration sends the weights to every task and a gradient back, so small tables take few.
    Spark deals a small table over all cores; a large one already has parts of this size.
    """
    parts = -(-estimated_bytes(df) // TASK_BYTES)
    return df.coalesce(parts) if 0 < parts < df.rdd.getNumPartitions() else df


@contextmanager
def held(df: DataFrame, *columns: str) -> Iterator[DataFrame]:
    """The columns of a stored table, decoded once and kept in memory or on disk, for many fits."""
    rows = in_few_parts(df.select(*columns)).persist()
    try:
        yield rows
    finally:
        rows.unpersist()


def storage_memory(spark: SparkSession) -> int:
    """Bytes that the executors have for stored blocks; in a local session, the driver's."""
    status = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().values().iterator()
    found = []
    while status.hasNext():
        found.append(status.next()._1())
    # One entry is the driver's, which stores no rows on a cluster; at most the largest is its own.
    return sum(found) - (max(found) if len(found) > 1 else 0)


def fits_at_once(rows: DataFrame, most: int, memory: int, classifiers: int = 2) -> int:
    """How many fits of a classifier may run side by side: ``most``, if their rows fit ``memory``.

    Each stores its own standardized copy of its rows, about as large as the ``held`` rows are. Copies
    beyond the memory would be read from disk again in each iteration; then the fits take turns.
    """
    if not rows.is_cached:
        return most
    rows.count()  # now Spark knows their size in memory
    copies = memory // max(1, estimated_bytes(rows)) - 1
    return max(1, min(most, copies // classifiers))


def with_folds(df: DataFrame, key: str, folds: int, seed: int) -> DataFrame:
    """Number each row's fold by its key, so that folds do not depend on row order."""
    return df.withColumn(
        FOLD, F.floor(key_position(key, f":fold:{seed}") * folds).cast("int")
    )


def train_one(
    df: DataFrame,
    key: str,
    label: str,
    reg_params: Sequence[float] = REG_PARAMS,
    folds: int = FOLDS,
    seed: int = 0,
    parallelism: int | None = None,
) -> CrossValidatorModel:
    """Cross-validate one classifier on a table with ``key``, ``label`` and ``features``.

    Without ``parallelism``, fits on ``held`` rows run side by side as far as half of the storage
    memory holds what two classifiers store.
    """
    if parallelism is None:
        parallelism = fits_at_once(df, folds + 1, storage_memory(df.sparkSession) // 2)
    rows = with_folds(in_few_parts(df.select(key, FEATURES, label)), key, folds, seed)
    return cross_validator(label, reg_params, folds, seed, parallelism).fit(rows)


def train_pair(
    df: DataFrame,
    key: str,
    pos: str = "pos_label",
    neg: str = "neg_label",
    reg_params: Sequence[float] = REG_PARAMS,
    folds: int = FOLDS,
    seed: int = 0,
    parallelism: int | None = None,
) -> tuple[CrossValidatorModel, CrossValidatorModel]:
    return (
        train_one(df, key, pos, reg_params, folds, seed, parallelism),
        train_one(df, key, neg, reg_params, folds, seed, parallelism),
    )


def stage_classifier(
    spark: SparkSession, path: str, build, parameters: str = "{}"
) -> CrossValidatorModel:
    """Load the classifier saved under ``path``, or train and save it."""
    return stage_model(spark, path, CrossValidatorModel.load, build, parameters)


def stage_vocabulary(
    spark: SparkSession, path: str, build, parameters: str = "{}"
) -> CountVectorizerModel:
    return stage_model(spark, path, CountVectorizerModel.load, build, parameters)


def _probability_only(model: CrossValidatorModel, out: str) -> LogisticRegressionModel:
    """The best model, set to compute its probability vector and nothing else."""
    best = model.bestModel.copy()
    best.setFeaturesCol(FEATURES)
    best.setProbabilityCol(out)
    best.setRawPredictionCol("")
    best.setPredictionCol("")
    return best


def score(
    models: Models,
    df: DataFrame,
    positive_threshold: float = POSITIVE_THRESHOLD,
    negative_threshold: float = NEGATIVE_THRESHOLD,
    float32: bool = False,
) -> DataFrame:
    """Add ``pos_probability``, ``neg_probability`` and the flags ``pos`` and ``neg``.

    Both models run over the same vectors in one pass; the input is read and cleaned once. The
    token and vector columns are dropped.
    """
    scored = models.vocabulary.transform(df)
    scored = _probability_only(models.positive, "__pos").transform(scored)
    scored = _probability_only(models.negative, "__neg").transform(scored)
    scored = scored.withColumns(
        {
            "pos_probability": class_probability("__pos"),
            "neg_probability": class_probability("__neg"),
        }
    )
    scored = scored.withColumns(
        {
            "pos": flag("pos_probability", positive_threshold, float32),
            "neg": flag("neg_probability", negative_threshold, float32),
        }
    )
    return scored.drop("__pos", "__neg", FEATURES, models.vocabulary.getInputCol())


def evaluate_auc(df: DataFrame, score_col: str, label: str) -> float:
    """Area under ROC of any numeric score against a 0/1 label."""
    return evaluator(label, score_col).evaluate(
        df.select(F.col(score_col).cast("double"), F.col(label).cast("double"))
    )


def rank_sum_auc(df: DataFrame, score_col: str, label: str) -> DataFrame:
    """``n`` and ``auc``: the area under ROC as a rank sum, ties counted half, in one row.

    Scores are dealt by ranges, and each range ranks its own scores behind the rows of the
    ranges before it: no task orders all of them. Rows of equal score are counted first, so a score
    that most rows have is one row.
    """
    spark = df.sparkSession
    by_score = df.groupBy(F.col(score_col).alias("s")).agg(
        F.sum(F.col(label).cast("double")).alias("ones"), F.count(F.lit(1)).alias("rows")
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Written, so that the numbers of the ranges stay what they are.
    ranges = stage(
        spark,
        f"{shared_dir(spark)}/scores",
        lambda: by_score.repartitionByRange(parts, "s").withColumn("part", F.spark_partition_id()),
    )
    before, firsts = 0, []
    for part, rows in sorted(map(tuple, ranges.groupBy("part").agg(F.sum("rows")).collect())):
        firsts.append((part, before))
        before += rows
    first = F.broadcast(spark.createDataFrame(firsts, "part int, before long"))  # a row per range
    mine = Window.partitionBy("part").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("rows").over(mine), F.lit(0))
    ranked = ranges.join(first, "part").withColumn(
        "rank", F.col("before") + within + (F.col("rows") + 1) / 2
    )
    ones, rows = F.sum("ones"), F.sum("rows")
    auc = (F.sum(F.col("ones") * F.col("rank")) - ones * (ones + 1) / 2) / (ones * (rows - ones))
    return ranked.agg(F.coalesce(rows, F.lit(0)).alias("n"), auc.alias("auc"))


def evaluate(models: Models, df: DataFrame, pos: str, neg: str) -> tuple[float, float]:
    """Area under ROC of both classifiers on held-out rows with ``features`` and labels."""
    return (
        evaluator(pos).evaluate(models.positive.transform(df.select(FEATURES, pos))),
        evaluator(neg).evaluate(models.negative.transform(df.select(FEATURES, neg))),
    )
