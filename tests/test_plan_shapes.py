"""What the optimizer makes of the operators."""

import pytest
from pyspark.sql import functions as F

from tonetide.catalog import QUERIES
from tonetide.catalog import bindings as B
from tonetide.functions.sql_surface import register_functions
from tonetide.operators.filters import in_set, not_containing, not_starting_with
from tonetide.operators.joins import fits_broadcast, join_labels, join_threads, skewed_join
from tonetide.operators.ngrams import with_ngram_bag, with_sanitized
from tonetide.operators.sampling import hash_sample
from tonetide.operators.vocabulary import document_frequency
from tonetide.plans import reports
from tonetide.plans.inspect import plan_text, register_global_view, register_view, schema_table
from tonetide.constants import REGIONS
from tonetide.sources.stages import shared_dir

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark):
    """Comments, threads and a scored table as stored tables."""
    out = shared_dir(spark)
    B.comments(spark, SF).write.parquet(f"{out}/comments")
    B.threads(spark, SF).write.parquet(f"{out}/threads")
    B.flagged(spark, SF).write.parquet(f"{out}/scored")
    return {n: spark.read.parquet(f"{out}/{n}") for n in ("comments", "threads", "scored")}


def test_no_query_runs_python(spark):
    for name, q in QUERIES.items():
        plan = plan_text(q.run(spark, SF))
        assert "EvalPython" not in plan and "InPandas" not in plan, name


def test_region_filter_reaches_the_scan(stored):
    plan = plan_text(reports.by_region(stored["scored"]))
    assert "PushedFilters: [In(state, " in plan
    assert "ReadSchema: struct<state:string,pos:int,neg:int>" in plan
    assert plan.count("HashAggregate") == 4  # two operators, in the tree and in the details


def test_reports_read_only_their_columns(stored):
    scored = stored["scored"]
    assert "ReadSchema: struct<pos:int,neg:int>" in plan_text(reports.overall(scored))
    assert "struct<timestamp:bigint,pos:int,neg:int>" in plan_text(reports.by_day(scored))
    assert "struct<comment_score:bigint,pos:int,neg:int>" in plan_text(
        reports.by_comment_score(scored)
    )


def test_top_k_is_not_a_full_sort(stored):
    assert "TakeOrderedAndProject" in plan_text(reports.top_threads(stored["scored"], "Positive"))


def test_sample_does_not_block_other_filters(stored):
    df = in_set(hash_sample(stored["comments"], "id", 0.2), "author_flair_text", REGIONS)
    assert "In(author_flair_text, " in plan_text(df)
    marks = not_starting_with(not_containing(stored["comments"], "body", "/s"), "body", "&gt")
    assert "IsNotNull(body)" in plan_text(marks)


def test_joins_broadcast_only_what_fits(stored, conf):
    comments, threads = stored["comments"], stored["threads"]
    assert "BroadcastHashJoin" in plan_text(join_threads(comments, threads))
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert not fits_broadcast(threads)
    plan = plan_text(join_threads(comments, threads))
    assert "SortMergeJoin Inner" in plan
    # Only the list of hot keys, fewer than 1 / HOT_SHARE, is broadcast.
    assert plan.split("\n\n")[0].count("BroadcastExchange") == 2


def test_a_limit_above_the_session_threshold_still_broadcasts(stored, conf):
    comments, threads = stored["comments"], stored["threads"]
    conf("spark.sql.autoBroadcastJoinThreshold", "100")

    def plan(limit):
        return plan_text(
            skewed_join(comments, threads.withColumnRenamed("id", "t"), "link_id", "t", "id",
                        hot_rows=1000, broadcast_limit=limit)
        ).split("\n\n")[0]

    assert "BroadcastHashJoin" in plan(1 << 30) and "SortMergeJoin" not in plan(1 << 30)
    assert "SortMergeJoin" in plan(1000)


def test_label_keys_filter_the_texts_first(spark, stored, conf):
    out = shared_dir(spark)
    wide = B.labels(spark, SF).select(
        *[F.col(c) for c in B.labels(spark, SF).columns], F.repeat("Input_id", 500).alias("note")
    )
    wide.write.parquet(f"{out}/labels")
    labels = spark.read.parquet(f"{out}/labels")
    conf("spark.sql.autoBroadcastJoinThreshold", "4000")
    assert not fits_broadcast(labels) and fits_broadcast(labels.select("Input_id"))
    tree = plan_text(join_labels(labels, stored["comments"], "Input_id", "id")).split("\n\n")[0]
    assert "BroadcastHashJoin LeftSemi" in tree and "SortMergeJoin Inner" in tree


def test_label_join_reads_two_text_columns(spark, stored):
    labels = B.labels(spark, SF)
    plan = plan_text(join_labels(labels, stored["comments"], "Input_id", "id"))
    assert "ReadSchema: struct<id:string,body:string>" in plan


def test_text_steps_are_computed_once(spark, stored):
    for make in (with_ngram_bag, with_sanitized):
        plan = plan_text(make(stored["comments"].select("id", "body"), "body", "x"))
        tree = plan.split("\n\n")[0]
        assert "Exchange" not in tree
        assert plan.count("regexp_extract_all(") <= 2  # once as input text, once as output
    terms = document_frequency(
        with_ngram_bag(stored["comments"].select("id", "body"), "body", "x"), "x"
    )
    plan = plan_text(terms)
    tree = plan.split("\n\n")[0]
    assert tree.count("Exchange") == 1 and tree.count("Filter") == 1
    assert plan.count("regexp_extract_all(") <= 2


def test_sql_function_is_expanded(spark, stored):
    register_functions(spark)
    stored["comments"].createOrReplaceTempView("plan_comments")
    plan = plan_text(spark.sql("SELECT sanitize(body) AS g FROM plan_comments"))
    assert "EvalPython" not in plan and plan.count("regexp_extract_all(") <= 2


def test_scoring_reads_comments_once(spark, stored):
    from tonetide.operators.models import Models, train_pair
    from tonetide.operators.vocabulary import fit_vocabulary, vectorize
    from tonetide.plans.score import score
    from tonetide.plans.train import GRAMS

    grams = with_ngram_bag(stored["comments"].select("id", "body"), "body", GRAMS)
    vocabulary = fit_vocabulary(grams, GRAMS)
    data = vectorize(vocabulary, grams).withColumns(
        {"p": (F.length("body") % 2).cast("int"), "n": (F.length("body") % 3 == 0).cast("int")}
    )
    models = Models(vocabulary, *train_pair(data, "id", "p", "n", folds=2))
    plan = plan_text(score(models, stored["comments"], stored["threads"]))
    tree = plan.split("\n\n")[0]
    assert tree.count("Scan parquet") == 2  # comments, threads
    assert "SortMergeJoin" not in tree and "EvalPython" not in tree
    late = plan_text(score(models, stored["comments"], stored["threads"], broadcast_limit=-1))
    joins = [line for line in late.split("\n\n")[0].splitlines() if "Join" in line]
    assert joins and "score" not in joins[0]
    exchanged = [
        block
        for block in late.split("\n\n")
        if "Exchange\n" in block and "hashpartitioning" in block
    ]
    assert exchanged and not any("body" in block for block in exchanged)


def test_views_and_inspection(spark, capsys):
    df = spark.range(3)
    register_view(df, "three")
    register_view(df, "three")
    assert spark.table("three").count() == 3
    register_global_view(df, "three_everywhere")
    assert spark.newSession().table("global_temp.three_everywhere").count() == 3
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        register_global_view(df, "three_everywhere")
    spark.catalog.dropGlobalTempView("three_everywhere")
    assert [tuple(r)[:2] for r in schema_table(df).collect()] == [("id", "bigint")]
    df.printSchema()
    df.show()
    assert "id: long" in capsys.readouterr().out


def test_key_filter_is_applied_before_texts_shuffle(spark, conf):
    """Labels and their keys above the broadcast limit: a filter of bounded size goes first."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    labels = spark.range(0, 3000, 3).select(F.col("id").cast("string").alias("Input_id"), F.lit("1").alias("l"))
    texts = spark.range(5000).select(F.col("id").cast("string").alias("id"), F.lit("text").alias("body"))
    texts = texts.unionByName(spark.createDataFrame([(None, "no id")], "id string, body string"))
    joined = join_labels(labels, texts, "Input_id", "id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    side = plan[plan.index("SortMergeJoin"):]
    exchange, at = side.index("Exchange hashpartitioning(__text_key"), side.index("getbit")
    assert exchange < at < side.index("BroadcastHashJoin") + len(side)
    assert side.index("BroadcastHashJoin") > exchange
    assert sorted(r.Input_id for r in joined.collect()) == sorted(str(i) for i in range(0, 3000, 3))


def test_key_filter_lets_few_others_through(spark):
    from tonetide.operators.joins import key_filter, maybe_in

    keys = spark.range(0, 2000, 2).select(F.col("id").cast("string").alias("k"))
    keys = keys.unionByName(spark.createDataFrame([(None,), ("0",)], "k string"))
    built = key_filter(keys, "k", 1 << 17)
    assert built.count() <= 4
    texts = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    passed = {r.k for r in maybe_in(texts, "k", built, 1 << 17).collect()}
    assert {str(i) for i in range(0, 2000, 2)} <= passed and len(passed) < 1400
    assert maybe_in(texts, "k", key_filter(keys.limit(0), "k")).count() == 0
