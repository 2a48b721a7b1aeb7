"""Training, scoring and evaluation on ``documents`` and ``labels``."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonetide.catalog import bindings as B
from tonetide.catalog.registry import query
from tonetide.catalog.files import _write_json, _write_labels
from tonetide.catalog.samples import _position
from tonetide.catalog.terms import LABELED_TERMS
from tonetide.constants import (
    FOLDS,
    NEGATIVE_THRESHOLD,
    POSITIVE_THRESHOLD,
    REG_PARAMS,
    TRAIN_WEIGHTS,
)
from tonetide.functions.values import class_probability
from tonetide.operators.joins import merge_scores
from tonetide.operators.models import (
    FOLD,
    Models,
    cross_validator,
    evaluate_auc,
    rank_sum_auc,
    score,
    with_folds,
)
from tonetide.operators.ngrams import with_ngram_bag
from tonetide.operators.sampling import hash_split
from tonetide.plans import reports as R
from tonetide.plans.full_run import run
from tonetide.plans.train import GRAMS, held_out_auc, train
from tonetide.sources.stages import shared_dir, stage

SEED = 11
_KEPT = "__kept"
_ROW = "__row"
_MARK = " "  # no term has a space
_TRAINED: dict[tuple[str, str], tuple[Models, str]] = {}


def _plain_comments(spark, sf_dir):
    docs = B.documents(spark, sf_dir, "text")
    return docs.select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("body"))


def _trained(spark, sf_dir):
    """Models for a scale, trained once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TRAINED:
        workdir = shared_dir(spark)
        models, _ = train(
            spark,
            B.labels(spark, sf_dir),
            _plain_comments(spark, sf_dir),
            workdir,
            SEED,
        )
        _TRAINED[key] = (models, workdir)
    return _TRAINED[key]


def _grams(spark, sf_dir):
    return with_ngram_bag(_plain_comments(spark, sf_dir), "body", GRAMS).drop("body")


def _scored(spark, sf_dir, models=None):
    return score(models or _trained(spark, sf_dir)[0], _grams(spark, sf_dir))


def _scored_again(spark, sf_dir, *rounds):
    """Each document's score columns of several rounds, its text cleaned once.

    A round gives models and new names for the columns of ``score`` it keeps. Every round vectorizes
    and scores for itself; only the n-grams are shared. The rows are written, so what joins them to
    one another reads a few numbers per document. A row without an id would join none: it is left out.
    """

    def build():
        df, found = _grams(spark, sf_dir).where(F.col("id").isNotNull()), {}
        for models, names in rounds:
            grams = models.vocabulary.getInputCol()
            scored = score(models, df.withColumn(_KEPT, F.col(grams)))
            # Under names that the next round's columns cannot take.
            mine = {f"{_KEPT}_{new}": (c, new) for c, new in names.items()}
            df = scored.select(
                "id",
                F.col(_KEPT).alias(grams),
                *found,
                *[F.col(c).alias(held) for held, (c, _) in mine.items()],
            )
            found |= {held: new for held, (_, new) in mine.items()}
        return df.select("id", *[F.col(held).alias(new) for held, new in found.items()])

    return stage(spark, f"{shared_dir(spark)}/scored", build)


def _sure(condition):
    """The condition, with null as false: a missing score agrees with nothing."""
    return F.coalesce(condition, F.lit(False))


@query("M3 M4 M5 M7")
def trained_classifiers(spark, sf_dir):
    models, _ = _trained(spark, sf_dir)
    rows = [
        (
            name,
            float(model.bestModel.intercept),
            int(model.bestModel.numFeatures),
            float(model.avgMetrics[0]),
        )
        for name, model in (("positive", models.positive), ("negative", models.negative))
    ]
    return spark.createDataFrame(
        rows, "classifier string, intercept double, features int, fold_auc double"
    )


@query("M8 F10 P7")
def scored_documents(spark, sf_dir):
    return _scored(spark, sf_dir)


@query(
    "M8 F10 P7 U2",
    "SELECT count(*) AS n, CAST(0 AS BIGINT) AS out_of_range, CAST(0 AS BIGINT) AS wrong_flags "
    "FROM documents",
)
def scores_are_consistent(spark, sf_dir):
    """Every document is scored; probabilities are in range and agree with their flags."""
    p, q = F.col("pos_probability"), F.col("neg_probability")
    in_range = _sure(p.between(0.0, 1.0) & q.between(0.0, 1.0))
    agree = _sure(
        (F.col("pos") == (p > POSITIVE_THRESHOLD).cast("int"))
        & (F.col("neg") == (q > NEGATIVE_THRESHOLD).cast("int"))
    )
    return _scored(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~in_range).alias("out_of_range"),
        F.count_if(~agree).alias("wrong_flags"),
    )


@query("M8 J3", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS different FROM documents")
def one_pass_equals_join(spark, sf_dir):
    """Scoring in one pass gives what scoring twice and joining gives."""
    models, _ = _trained(spark, sf_dir)
    scored = _scored_again(
        spark,
        sf_dir,
        (models, {"pos": "pos", "neg": "neg"}),
        (models, {"pos": "pos2"}),
        (models, {"neg": "neg2"}),
    )
    joined = merge_scores(
        scored.select("id", F.col("pos2").alias("pos")),
        scored.select("id", F.col("neg2").alias("neg")),
        "id",
    ).select("id", F.col("pos").alias("pos2"), F.col("neg").alias("neg2"))
    return (
        scored.select("id", "pos", "neg")
        .join(joined, "id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(
                ~_sure((F.col("pos") == F.col("pos2")) & (F.col("neg") == F.col("neg2")))
            ).alias("different"),
        )
    )


@query("M8 M2 F10", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS different FROM documents")
def scores_recomputed_from_terms(spark, sf_dir):
    """The models' probabilities from their coefficients, by joining terms to weights."""
    models, _ = _trained(spark, sf_dir)
    best = [m.bestModel for m in (models.positive, models.negative)]
    weights = spark.createDataFrame(
        [
            (term, float(w), float(v))
            for term, w, v in zip(
                models.vocabulary.vocabulary, *[b.coefficients.toArray() for b in best]
            )
        ]
        + [(_MARK, 0.0, 0.0)],
        "term string, w double, v double",
    )
    # The text is cleaned once: each row is scored and hands on its distinct terms and a mark, which has
    # the weight 0, so that a row without a term of the vocabulary stays.
    grams = _grams(spark, sf_dir).withColumn(_KEPT, F.col(GRAMS))
    scored = score(models, grams).withColumn(_ROW, F.monotonically_increasing_id())
    row = (_ROW, "id", "pos_probability", "neg_probability")
    none = F.array().cast("array<string>")
    terms = scored.select(
        *row,
        F.explode(
            F.concat(F.coalesce(F.array_distinct(_KEPT), none), F.array(F.lit(_MARK)))
        ).alias("term"),
    )
    # A weight per vocabulary term: sent to the rows, whose sums are then combined where they are.
    sums = terms.join(F.broadcast(weights), "term").groupBy(*row).agg(
        F.sum("w").alias("w"), F.sum("v").alias("v")
    )
    # Rows of one id have the sum of all of them; a row without an id has none.
    of_id = Window.partitionBy("id")
    totals = sums.withColumns(
        {c: F.when(F.col("id").isNotNull(), F.sum(c).over(of_id)) for c in ("w", "v")}
    )

    def probability(total, intercept):
        margin = F.coalesce(F.col(total), F.lit(0.0)) + F.lit(float(intercept))
        return 1.0 / (1.0 + F.exp(-margin))

    different = ~_sure(
        (F.abs(F.col("pos_probability") - probability("w", best[0].intercept)) <= 1e-9)
        & (F.abs(F.col("neg_probability") - probability("v", best[1].intercept)) <= 1e-9)
    )
    return totals.agg(F.count(F.lit(1)).alias("n"), F.count_if(different).alias("different"))


@query("S8 K2", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS different FROM documents")
def saved_models_score_alike(spark, sf_dir):
    models, _ = _trained(spark, sf_dir)
    path = shared_dir(spark)
    models.save(path)
    names = {"pos_probability": "p2", "neg_probability": "q2"}
    scored = _scored_again(
        spark, sf_dir, (models, {n: n for n in names}), (Models.load(path), names)
    )
    different = ~_sure(
        (F.col("pos_probability") == F.col("p2")) & (F.col("neg_probability") == F.col("q2"))
    )
    return (
        scored.select("id", *names)
        .join(scored.select("id", *names.values()), "id")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(different).alias("different"))
    )


@query("K2", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS different FROM documents")
def staged_models_are_reused(spark, sf_dir):
    """A second training run over a finished work folder loads the same models."""
    models, workdir = _trained(spark, sf_dir)
    reused, _ = train(
        spark, B.labels(spark, sf_dir), _plain_comments(spark, sf_dir), workdir, SEED
    )
    names = {"pos_probability": "p2"}
    scored = _scored_again(spark, sf_dir, (models, {n: n for n in names}), (reused, names))
    return (
        scored.select("id", "pos_probability")
        .join(scored.select("id", "p2"), "id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(~_sure(F.col("pos_probability") == F.col("p2"))).alias("different"),
        )
    )


@query(
    "M6",
    """WITH s AS (SELECT d.n_chars AS x, l.quality AS y
                  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
            r AS (SELECT y, rank() OVER (ORDER BY x)
                            + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS r FROM s)
       SELECT round((sum(CASE WHEN y = 1 THEN r END)::DOUBLE
                     - count_if(y = 1)::DOUBLE * (count_if(y = 1) + 1) / 2)
                    / (count_if(y = 1)::DOUBLE * count_if(y = 0)), 6) AS auc
       FROM r""",
)
def auc_of_length(spark, sf_dir):
    docs = B.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    joined = docs.join(B.table(spark, sf_dir, "labels"), "doc_id")
    auc = evaluate_auc(joined, "n_chars", "quality")
    return spark.createDataFrame([(round(auc, 6),)], "auc double")


@query("M9")
def held_out_quality(spark, sf_dir):
    _, workdir = _trained(spark, sf_dir)
    models, held_out = train(
        spark, B.labels(spark, sf_dir), _plain_comments(spark, sf_dir), workdir, SEED
    )
    pos, neg = held_out_auc(models, held_out)
    return spark.createDataFrame(
        [("positive", pos), ("negative", neg)], "classifier string, auc double"
    )


def _split(spark, sf_dir):
    """Training and held-out rows, with vectors and both labels."""
    _, workdir = _trained(spark, sf_dir)
    data = spark.read.parquet(f"{workdir}/sentiment")
    return hash_split(data, "Input_id", TRAIN_WEIGHTS, salt=f":split:{SEED}")


_LABELED = "SELECT CAST(l.doc_id AS VARCHAR) AS id FROM labels l JOIN documents USING (doc_id)"
_FIRST = f"{_position('id', f':split:{SEED}')} < CAST({TRAIN_WEIGHTS[0] / sum(TRAIN_WEIGHTS)} AS DOUBLE)"


@query(
    "M5 M7",
    f"""SELECT CASE WHEN {_FIRST} THEN
                 CAST(floor({_position('id', f':fold:{SEED}')} * {FOLDS}) AS INTEGER) ELSE -1 END AS fold,
               count(*) AS n
        FROM ({_LABELED}) GROUP BY ALL""",
)
def fold_sizes(spark, sf_dir):
    """Rows of each fold of the training part; fold -1 is the part held out."""
    training, held_out = _split(spark, sf_dir)
    folds = with_folds(training, "Input_id", FOLDS, SEED).select(F.col(FOLD).alias("fold"))
    apart = held_out.select(F.lit(-1).alias("fold"))
    return folds.unionByName(apart).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@query(
    "M3 M4",
    f"""SELECT c AS classifier, (SELECT count(*) FROM ({LABELED_TERMS})) AS features,
               TRUE AS better_than_constant
        FROM (VALUES ('positive'), ('negative')) t(c)""",
)
def classifiers_beat_a_constant(spark, sf_dir):
    """A feature per vocabulary term, and a lower training loss than the intercept-only model's."""
    models, _ = _trained(spark, sf_dir)
    training, _ = _split(spark, sf_dir)
    parts = []
    for name, model, label in (
        ("positive", models.positive, "pos_label"), ("negative", models.negative, "neg_label")
    ):
        y = F.col(label)
        best = model.bestModel
        p = class_probability(best.getProbabilityCol())
        scored = best.transform(training.select("features", label))
        loss = -F.avg(F.when(y == 1, F.log(p)).otherwise(F.log(1 - p)))
        rate = F.avg(y.cast("double"))
        constant = -(rate * F.log(rate) + (1 - rate) * F.log(1 - rate))
        parts.append(
            scored.agg(_sure(loss < constant).alias("better_than_constant")).select(
                F.lit(name).alias("classifier"),
                F.lit(int(best.numFeatures)).cast("long").alias("features"),
                "better_than_constant",
            )
        )
    return parts[0].unionByName(parts[1])


def _loss_and_weights(model, training, label):
    """Mean log loss of the rows, and the sum of the squared standardized weights.

    The one vector that reaches the driver has a number per vocabulary term.
    """
    y, p = F.col(label), class_probability(model.getProbabilityCol())
    of = model.transform(training.select("features", label)).agg(
        (-F.avg(F.when(y == 1, F.log(p)).otherwise(F.log(1 - p)))).alias("loss"),
        Summarizer.std(F.col("features")).alias("std"),
    ).first()
    return of.loss, float(((model.coefficients.toArray() * of.std.toArray()) ** 2).sum())


@query(
    "M3 M4 M5",
    f"""SELECT c AS classifier, CAST({REG_PARAMS[0]} AS DOUBLE) AS reg_param,
               (SELECT count(*) FROM ({LABELED_TERMS})) AS features, TRUE AS equal
        FROM (VALUES ('positive'), ('negative')) t(c)""",
)
def objective_has_the_penalty_of_the_grid(spark, sf_dir):
    """What the optimizer minimized is the rows' log loss and the penalty of the grid's ``regParam``."""
    training, _ = _split(spark, sf_dir)
    rows = []
    for name, label in (("positive", "pos_label"), ("negative", "neg_label")):
        validator = cross_validator(label)
        point = validator.getEstimatorParamMaps()[0]
        model = validator.getEstimator().fit(training.select("features", label), point)
        loss, squares = _loss_and_weights(model, training, label)
        told = model.summary.objectiveHistory[-1]
        off = [abs(told - loss - r * REG_PARAMS[0] / 2 * squares) for r in (1.0, 0.0, 0.5, 2.0)]
        equal = off[0] < 1e-9 and min(off[1:]) > 1e-6
        rows.append((name, float(model.getRegParam()), int(model.numFeatures), equal))
    return spark.createDataFrame(
        rows, "classifier string, reg_param double, features long, equal boolean"
    )


@query(
    "M9 M6",
    f"""SELECT c AS classifier, CAST(count_if(NOT {_FIRST}) AS BIGINT) AS n, TRUE AS equal
        FROM ({_LABELED}), (VALUES ('positive'), ('negative')) t(c) GROUP BY c""",
)
def held_out_auc_is_a_rank_sum(spark, sf_dir):
    """The evaluator's area under ROC is the rank sum of the scored held-out rows."""
    models, _ = _trained(spark, sf_dir)
    _, held_out = _split(spark, sf_dir)
    told = dict(zip(("positive", "negative"), held_out_auc(models, held_out)))
    parts = []
    for name, model, label in (
        ("positive", models.positive, "pos_label"), ("negative", models.negative, "neg_label")
    ):
        best = model.bestModel
        scored = best.transform(held_out.select("features", label)).select(
            F.col(label).alias("y"), vector_to_array(best.getRawPredictionCol())[1].alias("s")
        )
        ranked = rank_sum_auc(scored, "s", "y")
        equal = _sure(F.abs(F.col("auc") - F.lit(told[name])) < 1e-9)
        parts.append(ranked.select(F.lit(name).alias("classifier"), "n", equal.alias("equal")))
    return parts[0].unionByName(parts[1])


_RUNS: dict[tuple[str, str], DataFrame] = {}


def _whole_run(spark, sf_dir):
    """Raw files to the scored table and its reports, once per application and scale."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        out = shared_dir(spark)
        _RUNS[key] = run(
            spark,
            _write_json(B.comments(spark, sf_dir), f"{out}/raw/comments.json"),
            _write_json(B.threads(spark, sf_dir), f"{out}/raw/threads.json"),
            _write_labels(B.labels(spark, sf_dir), f"{out}/raw/labels.csv"),
            f"{out}/work",
            SEED,
        )
    return _RUNS[key]


@query("S10 J1 M8 J2 A3 K1")
def full_run_percent_by_region(spark, sf_dir):
    """The whole run from raw files: ingest, train, join, score, report."""
    return R.by_region(_whole_run(spark, sf_dir))


@query(
    "S10 J2 P1 P4 P5 K1",
    f"""SELECT c.id AS comment_id, t.id AS submission_id, c.created_utc AS timestamp,
               c.author_flair_text AS state, t.title AS title, c.score AS comment_score,
               t.score AS submission_score
        FROM ({B.COMMENTS}) c JOIN ({B.THREADS}) t ON substr(c.link_id, 4) = t.id
        WHERE NOT contains(c.body, '/s') AND NOT starts_with(c.body, '&gt')""",
)
def full_run_scored_rows(spark, sf_dir):
    """Which rows the whole run scores, with everything but the two flags."""
    return _whole_run(spark, sf_dir).drop("pos", "neg")
