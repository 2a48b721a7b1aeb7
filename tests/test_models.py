"""Vocabulary, training, scoring and evaluation."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from tonetide.operators.models import Models, evaluate_auc, score, train_pair
from tonetide.operators.ngrams import with_ngram_bag
from tonetide.operators.vocabulary import fit_vocabulary, vectorize
from tonetide.plans.full_run import run
from tonetide.plans.score import score as score_plan
from tonetide.plans.train import GRAMS, held_out_auc, train
from tonetide.sources.stages import shared_dir

GOOD, BAD, FLAT = "great fine day", "awful sad day", "plain grey day"


@pytest.fixture(scope="module")
def tables(spark):
    """300 comments in three clear tones; a third of them under one thread."""
    rows = []
    for i in range(300):
        body = (GOOD, BAD, FLAT)[i % 3] + f" word{i % 5}"
        thread = "hot" if i % 3 == 0 else f"3t{i % 20}"
        rows.append((f"c{i}", body, 1514700000 + i, "Ohio", f"t3_{thread}", i % 7))
    comments = spark.createDataFrame(
        rows,
        "id string, body string, created_utc long, author_flair_text string,"
        " link_id string, score long",
    )
    threads = comments.select(
        F.regexp_replace("link_id", "^t3_", "").alias("id")
    ).distinct().select("id", F.lit("title").alias("title"), F.length("id").cast("long").alias("score"))
    labels = spark.createDataFrame(
        [(f"c{i}", "0", "0", ("1", "-1", "0")[i % 3]) for i in range(240)] + [("c7", "0", "0", None)],
        "Input_id string, labeldem string, labelgop string, labeldjt string",
    )
    return comments, threads, labels


@pytest.fixture(scope="module")
def trained(spark, tables):
    comments, _, labels = tables
    workdir = shared_dir(spark)
    models, held_out = train(spark, labels, comments, workdir, seed=5)
    return models, held_out, workdir


def test_vocabulary_order_and_vectors(spark):
    df = spark.createDataFrame(
        [(["b", "a", "a"],), (["a", "b"],), (["c"],)], "tokens array<string>"
    )
    model = fit_vocabulary(df, "tokens", "v", min_df=1)
    assert model.vocabulary == ["a", "b", "c"]
    assert fit_vocabulary(df, "tokens", "v", min_df=2).vocabulary == ["a", "b"]
    assert fit_vocabulary(df, "tokens", "v", min_df=1, size=1).vocabulary == ["a"]
    seen = spark.createDataFrame([(["a", "a", "zzz"],)], "tokens array<string>")
    vector = vectorize(model, seen).first().v
    assert (vector.size, list(vector.indices), list(vector.values)) == (3, [0], [1.0])
    counted = fit_vocabulary(df, "tokens", "v", min_df=1, binary=False)
    assert list(vectorize(counted, seen).first().v.values) == [2.0]
    with pytest.raises(ValueError, match="min_df"):
        fit_vocabulary(df, "tokens", "v", min_df=10)


def test_held_out_rows_are_separated(trained):
    models, held_out, _ = trained
    assert held_out_auc(models, held_out) == (1.0, 1.0)
    assert models.positive.bestModel.getRegParam() == 1.0
    assert models.positive.bestModel.getMaxIter() == 10
    assert models.positive.getNumFolds() == 5


def test_same_seed_same_models(spark, tables, trained):
    comments, _, labels = tables
    again, _ = train(spark, labels.repartition(3), comments, shared_dir(spark), seed=5)
    first = trained[0]
    assert again.vocabulary.vocabulary == first.vocabulary.vocabulary
    for a, b in ((again.positive, first.positive), (again.negative, first.negative)):
        assert a.bestModel.coefficients.toArray() == pytest.approx(
            b.bestModel.coefficients.toArray(), abs=1e-9
        )


def test_scores_do_not_depend_on_the_join_order(tables, trained):
    """Threads broadcast, threads shuffled last, hot threads split: the same rows."""
    comments, threads, _ = tables
    models = trained[0]
    want = sorted(map(tuple, score_plan(models, comments, threads).collect()))
    assert len(want) == 300
    shuffled = score_plan(models, comments, threads, broadcast_limit=-1)
    assert sorted(map(tuple, shuffled.collect())) == want
    split = score_plan(models, comments, threads, broadcast_limit=-1, hot_rows=20)
    assert sorted(map(tuple, split.collect())) == want


def test_sampled_scoring_is_a_subset(tables, trained):
    comments, threads, _ = tables
    models = trained[0]
    whole = {r.comment_id: tuple(r) for r in score_plan(models, comments, threads).collect()}
    for limit in (None, -1):
        part = score_plan(models, comments, threads, fraction=0.6, broadcast_limit=limit).collect()
        assert 0 < len(part) < 300
        assert all(whole[r.comment_id] == tuple(r) for r in part)


def test_flags_follow_the_tone(tables, trained):
    comments, threads, _ = tables
    rows = score_plan(trained[0], comments, threads, positive_threshold=0.5,
                      negative_threshold=0.5).collect()
    for r in rows:
        tone = int(r.comment_id[1:]) % 3
        assert (r.pos, r.neg) == (int(tone == 0), int(tone == 1))


def test_saved_models_score_alike(spark, tables, trained):
    models = trained[0]
    path = shared_dir(spark)
    models.save(path)
    models.save(path)  # replaces the first
    grams = with_ngram_bag(tables[0], "body", GRAMS).select("id", GRAMS)
    columns = ["id", "pos_probability", "neg_probability", "pos", "neg"]
    a = score(models, grams)
    assert a.columns == columns
    assert sorted(a.collect()) == sorted(score(Models.load(path), grams).collect())


def test_staged_training_is_reused(spark, trained):
    workdir = trained[2]

    class Untouchable:
        def __getattr__(self, name):
            raise AssertionError("training read its inputs again")

    models, held_out = train(spark, Untouchable(), Untouchable(), workdir, seed=5)
    assert models.vocabulary.vocabulary == trained[0].vocabulary.vocabulary
    assert held_out.count() == trained[1].count()


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame(
        [(1, 0), (2, 0), (2, 1), (3, 1), (3, 0), (5, 1)], "s int, y int"
    )
    pairs = [(a, b) for a in (2, 3, 5) for b in (1, 2, 3)]
    want = sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs)
    assert evaluate_auc(df, "s", "y") == pytest.approx(want)


def test_grid_over_several_values(spark, tables):
    comments, _, labels = tables
    df = with_ngram_bag(comments, "body", GRAMS)
    data = vectorize(fit_vocabulary(df, GRAMS), df).withColumns(
        {"p": (F.col("body").startswith("great")).cast("int"),
         "n": (F.col("body").startswith("awful")).cast("int")}
    )
    pos, neg = train_pair(data, "id", "p", "n", reg_params=[0.1, 1.0], folds=2, seed=1)
    assert len(pos.avgMetrics) == len(neg.avgMetrics) == 2


def test_whole_run(spark, tables):
    comments, threads, labels = tables
    out = shared_dir(spark)
    comments.write.option("compression", "bzip2").json(f"{out}/raw/comments")
    threads.write.json(f"{out}/raw/threads")
    labels.write.option("header", True).csv(f"{out}/raw/labels")
    paths = (f"{out}/raw/comments", f"{out}/raw/threads", f"{out}/raw/labels")
    scored = run(spark, *paths, f"{out}/work", seed=5)
    assert scored.count() == 300
    shutil.rmtree(f"{out}/raw")  # finished stages need no input any more
    again = run(spark, *paths, f"{out}/work", seed=5)
    with pytest.raises(ValueError, match="seed"):
        run(spark, *paths, f"{out}/work", seed=6)
    with pytest.raises(ValueError, match="no/such"):
        run(spark, "/no/such", *paths[1:], f"{out}/work", seed=5)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, scored.collect()))
    overall = spark.read.option("header", True).csv(f"{out}/work/reports/raw_percentages.csv")
    assert overall.columns == ["Positive", "Negative"] and overall.count() == 1


def test_vocabulary_ties_over_many_partitions(spark):
    rows = [([f"t{i:03d}"] * (3 if i < 10 else 2),) for i in range(300)]
    df = spark.createDataFrame(rows, "tokens array<string>").repartition(64)
    for size in (5, 10, 57, 300, 1000):
        got = fit_vocabulary(df, "tokens", "v", min_df=1, size=size).vocabulary
        assert got == [f"t{i:03d}" for i in range(min(size, 300))]


def test_a_half_saved_model_is_rebuilt(spark, tmp_path):
    from pyspark.ml.feature import CountVectorizerModel

    from tonetide.operators.models import stage_vocabulary

    path = f"{tmp_path}/vocabulary"
    calls = []

    def build():
        calls.append(1)
        return CountVectorizerModel.from_vocabulary(["a", "b"], inputCol="t", outputCol="v")

    assert stage_vocabulary(spark, path, build).vocabulary == ["a", "b"]
    assert stage_vocabulary(spark, path, build).vocabulary == ["a", "b"] and len(calls) == 1
    os.remove(f"{path}/_SUCCESS")  # as when the save broke after the metadata
    shutil.rmtree(f"{path}/data")
    assert stage_vocabulary(spark, path, build).vocabulary == ["a", "b"] and len(calls) == 2


def test_folds_together_are_folds_in_turn(spark, tables):
    from pyspark.ml.tuning import CrossValidator

    from tonetide.operators.models import cross_validator, with_folds

    comments = tables[0]
    df = with_ngram_bag(comments, "body", GRAMS).withColumn(
        "p", (F.col("body").startswith("great") | (F.col("score") == 3)).cast("int")
    )
    rows = with_folds(vectorize(fit_vocabulary(df, GRAMS), df), "id", 3, 1).cache()
    for reg_params in ([1.0], [0.01, 1.0]):
        together = cross_validator("p", reg_params, folds=3)
        in_turn = CrossValidator(
            estimator=together.getEstimator(), evaluator=together.getEvaluator(),
            estimatorParamMaps=together.getEstimatorParamMaps(), numFolds=3, foldCol="__fold",
        )
        a, b = together.fit(rows), in_turn.fit(rows)
        assert a.avgMetrics == pytest.approx(b.avgMetrics, abs=1e-9)
        assert a.stdMetrics == pytest.approx(b.stdMetrics, abs=1e-9)
        assert a.bestModel.getRegParam() == b.bestModel.getRegParam()
        assert a.bestModel.coefficients.toArray() == pytest.approx(
            b.bestModel.coefficients.toArray(), abs=1e-6
        )


def test_small_tables_train_in_few_parts(spark, tmp_path):
    from tonetide.operators.models import in_few_parts

    spark.range(0, 1000, 1, 8).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    assert df.rdd.getNumPartitions() > 1 and in_few_parts(df).rdd.getNumPartitions() == 1
    assert in_few_parts(df).count() == 1000


def test_training_knows_its_tables(spark, tables, trained):
    comments, _, labels = tables
    workdir = trained[2]
    models, _ = train(spark, labels, comments, workdir, seed=5)
    assert models.vocabulary.vocabulary == trained[0].vocabulary.vocabulary
    with pytest.raises(ValueError, match="was made with"):
        train(spark, labels.where("Input_id > 'c2'"), comments, workdir, seed=5)
    with pytest.raises(ValueError, match="was made with"):
        train(spark, labels, comments.withColumn("body", F.lower("body")).where("score > 2"), workdir, seed=5)


def test_rank_sum_in_ranges(spark):
    from tonetide.operators.models import rank_sum_auc

    rows = [(float((i * 7919) % 53), int((i * 31) % 7 < 3)) for i in range(400)] + [(5.0, 1)] * 300
    df = spark.createDataFrame(rows, "s double, y int").repartition(6)
    pairs = [(a, b) for a, y in rows if y for b, z in rows if not z]
    want = sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs)
    got = rank_sum_auc(df, "s", "y")
    assert tuple(got.first()) == (700, pytest.approx(want, abs=1e-12))
    # One row per task reaches the last aggregate; nothing else goes to a single partition.
    plan = got._jdf.queryExecution().executedPlan().toString()
    window = plan[plan.index("Window"):]
    assert "SinglePartition" not in window
    assert tuple(rank_sum_auc(df.limit(0), "s", "y").first()) == (0, None)


@pytest.fixture
def small_scale(spark, tables, trained, tmp_path):
    """A folder with ``documents``, one id twice, one null, and models for it."""
    from tonetide.catalog import models as M

    rows = [(i, (GOOD, BAD, FLAT)[i % 3] + f" word{i % 5}") for i in range(40)]
    rows += [(3, GOOD + " word3"), (41, ""), (None, BAD)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    key = (spark.sparkContext.applicationId, str(tmp_path))
    M._TRAINED[key] = (trained[0], trained[2])
    yield str(tmp_path)
    del M._TRAINED[key]


def test_rounds_of_scoring_are_apart(spark, trained, small_scale):
    """Each round scores with its own models, whatever the rounds before it left."""
    from tonetide.catalog import models as M

    a = trained[0]
    b = Models(a.vocabulary, a.negative, a.positive)
    names = {"pos_probability": "p", "pos": "pos"}
    both = M._scored_again(spark, small_scale, (a, names), (b, {"pos_probability": "q", "pos": "pos2"}))
    assert both.columns == ["id", "p", "pos", "q", "pos2"] and both.count() == 42

    def rows(df, *columns):
        return sorted(map(str, df.select(*columns).collect()))

    alone = [M._scored(spark, small_scale, m).where("id IS NOT NULL") for m in (a, b)]
    alone = [df.select("id", "pos_probability", "pos") for df in alone]
    assert rows(both, "id", F.col("p").alias("pos_probability"), "pos") == rows(alone[0], *alone[0].columns)
    again = both.select("id", F.col("q").alias("pos_probability"), F.col("pos2").alias("pos"))
    assert rows(again, *again.columns) == rows(alone[1], *alone[1].columns)
    assert both.where("p != q").count() > 0


@pytest.mark.parametrize(
    "name, rounds, rows",
    # The rows of the id that comes twice meet each other; the row without an id meets none.
    [("one_pass_equals_join", 3, 40 + 8), ("saved_models_score_alike", 2, 40 + 4)],
)
def test_scoring_twice_cleans_the_text_once(spark, small_scale, monkeypatch, name, rounds, rows):
    from tonetide.catalog import QUERIES
    from tonetide.catalog import models as M

    calls, bag, scored = [], M.with_ngram_bag, M.score
    monkeypatch.setattr(M, "with_ngram_bag", lambda *a: calls.append("text") or bag(*a))
    monkeypatch.setattr(M, "score", lambda *a: calls.append("score") or scored(*a))
    result = QUERIES[name].run(spark, small_scale).first()
    assert (calls.count("text"), calls.count("score")) == (1, rounds)
    assert tuple(result) == (rows, 0)


def test_weights_go_to_the_terms(spark, small_scale):
    """No term is shuffled to find its weight."""
    from tonetide.catalog import QUERIES

    df = QUERIES["scores_recomputed_from_terms"].run(spark, small_scale)
    tree = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [term" in tree and "hashpartitioning(term" not in tree
    assert df.first().n == 43


def test_terms_and_scores_share_the_cleaned_text(spark, small_scale, monkeypatch):
    """One cleaning for the scores and the sums; ids that repeat or are missing count as before."""
    from tonetide.catalog import QUERIES
    from tonetide.catalog import models as M

    calls, bag, scored = [], M.with_ngram_bag, M.score
    monkeypatch.setattr(M, "with_ngram_bag", lambda *a: calls.append("text") or bag(*a))
    monkeypatch.setattr(M, "score", lambda *a: calls.append("score") or scored(*a))
    df = QUERIES["scores_recomputed_from_terms"].run(spark, small_scale)
    assert calls == ["text", "score"]
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    # Both rows of the id that comes twice have the sum of the two; the row without an id has none.
    assert tuple(df.first()) == (43, 2 + 1)


def test_fits_share_the_decoded_rows(spark, tables, monkeypatch):
    """The rows are held for all fits of both classifiers, and let go after them."""
    from tonetide.plans import train as P

    comments, _, labels = tables
    given, one = [], P.train_one

    def train_one(df, *rest):
        given.append((df, df.is_cached))
        return one(df, *rest)

    monkeypatch.setattr(P, "train_one", train_one)
    models, _ = train(spark, labels, comments, shared_dir(spark), seed=5)
    (first, kept), (second, kept_too) = given
    assert first is second and kept and kept_too
    assert not first.storageLevel.useMemory and not first.storageLevel.useDisk
    plan = first.select("features")._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryTableScan" not in plan
    assert models.positive.getNumFolds() == 5


def test_fits_take_turns_if_their_rows_do_not_fit(spark, tables, monkeypatch):
    """Copies of the rows are stored side by side only as far as the memory holds them."""
    from threading import Lock

    from pyspark.ml.classification import LogisticRegression

    from tonetide.operators import models as M
    from tonetide.sources.readers import estimated_bytes

    df = with_ngram_bag(tables[0], "body", GRAMS).withColumn(
        "p", F.col("body").startswith("great").cast("int")
    )
    data = vectorize(fit_vocabulary(df, GRAMS), df)
    with M.held(data, "id", "features", "p") as rows:
        rows.count()
        size = estimated_bytes(rows)
        assert [M.fits_at_once(rows, 6, n * size) for n in (0, 1, 2, 5, 12, 13, 99)] == [1, 1, 1, 2, 5, 6, 6]
        fit, lock, now, most = LogisticRegression._fit, Lock(), [0], []

        def counted(self, dataset):
            with lock:
                now[0] += 1
                most.append(now[0])
            try:
                return fit(self, dataset)
            finally:
                with lock:
                    now[0] -= 1

        monkeypatch.setattr(LogisticRegression, "_fit", counted)
        monkeypatch.setattr(M, "storage_memory", lambda spark: 0)
        slow = M.train_one(rows, "id", "p", folds=3)
        assert max(most) == 1 and len(most) == 4
        monkeypatch.undo()
        fast = M.train_one(rows, "id", "p", folds=3)
    assert M.storage_memory(spark) > 1 << 30
    assert slow.avgMetrics == pytest.approx(fast.avgMetrics, abs=1e-12)
    assert slow.bestModel.coefficients.toArray() == pytest.approx(
        fast.bestModel.coefficients.toArray(), abs=1e-12
    )
