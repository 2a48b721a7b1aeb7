"""Filters, joins, rollups, series and samples on small literal tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tonetide.constants import REGIONS
from tonetide.operators import filters as P
from tonetide.operators import joins as J
from tonetide.operators import sampling as K
from tonetide.operators.rollups import ordered, percent_rollup, top_k
from tonetide.operators.series import densify_daily, series_range
from tonetide.operators.vocabulary import document_frequency


def values(df, c):
    return sorted(r[c] for r in df.select(c).collect())


# --- filters -------------------------------------------------------------------


def test_text_marks(spark):
    rows = [(None,), ("a/s b",), ("&gt; q",), ("a &gt q",), ("ok",)]
    df = spark.createDataFrame(rows, "body string")
    kept = P.not_starting_with(P.not_containing(df, "body", "/s"), "body", "&gt")
    assert values(kept, "body") == ["a &gt q", "ok"]


def test_strict_mark(spark):
    rows = [("http://x/story",), ("so good /s",), ("/s",), ("a/s",), (None,)]
    df = spark.createDataFrame(rows, "body string")
    assert values(P.not_containing(df, "body", "/s", strict=True), "body") == [
        "a/s",
        "http://x/story",
    ]


def test_allowed_regions(spark):
    assert len(REGIONS) == len(set(REGIONS)) == 51
    rows = [("Ohio",), ("ohio",), (None,), ("District of Columbia",), ("Puerto Rico",)]
    df = spark.createDataFrame(rows, "state string")
    expected = ["District of Columbia", "Ohio"]
    assert values(P.in_set(df, "state", REGIONS), "state") == expected
    dim = spark.createDataFrame([(r,) for r in REGIONS], "name string")
    assert values(P.in_set(df, "state", dim), "state") == expected


def test_drop_values_project_derive(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert values(P.drop_values(df, "k", ["a"]), "k") == ["b"]
    assert values(P.drop_values(df, "k", []), "k") == ["a", "b"]
    assert P.project(df, {"key": "k", "twice": F.col("v") * 2}).columns == ["key", "twice"]
    assert P.derive(df, {"w": F.col("v") + 1}).columns == ["k", "v", "w"]


# --- joins ---------------------------------------------------------------------


def comments(spark, rows):
    return spark.createDataFrame(
        rows,
        "id string, body string, created_utc long, author_flair_text string,"
        " link_id string, score long",
    )


def test_join_threads_strip_modes(spark):
    left = comments(
        spark,
        [
            ("c1", "fine", 1, "Ohio", "t3_3tabc", 5),
            ("c2", "no /s", 1, "Ohio", "t3_3tabc", 5),
            ("c3", "&gt; no", 1, None, "t3_x", 5),
            ("c4", "fine too", 2, None, "t3_x", 7),
            ("c5", None, 2, None, "t3_x", 7),
            ("c6", "lost", 2, None, None, 7),
        ],
    )
    threads = spark.createDataFrame(
        [("3tabc", "A", 10), ("abc", "B", 20), ("x", "C", 30)], "id string, title string, score long"
    )
    got = {r.comment_id: r.title for r in J.join_threads(left, threads).collect()}
    assert got == {"c1": "A", "c4": "C"}
    got = {r.comment_id: r.title for r in J.join_threads(left, threads, strip="charset").collect()}
    assert got == {"c1": "B", "c4": "C"}
    with pytest.raises(ValueError):
        J.thread_key("link_id", "other")


@pytest.mark.parametrize("hot_rows", [1, 50, 10**9])
def test_skewed_join_equals_plain_join(spark, conf, hot_rows):
    """A third of all rows under one key; repeated and missing keys on both sides."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    left = [(i, "hot" if i % 3 == 0 else f"k{i % 40}" if i % 7 else None) for i in range(900)]
    right = [("hot", "h1"), ("hot", "h2"), (None, "n")] + [(f"k{i}", f"v{i}") for i in range(60)]
    want = Counter((i, k, v) for i, k in left for k2, v in right if k is not None and k == k2)
    joined = J.skewed_join(
        spark.createDataFrame(left, "i int, a string"),
        spark.createDataFrame(right, "b string, v string"),
        "a",
        "b",
        spread_by="i",
        hot_rows=hot_rows,
        broadcast_limit=-1,
    )
    assert joined.columns == ["i", "a", "b", "v"]
    assert Counter((r.i, r.a, r.v) for r in joined.collect()) == want


def test_hot_keys_are_split(spark, conf):
    """No task of the shuffled join gets all rows of the hot key."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    left = spark.range(8000).select("id", F.lit("hot").alias("a"))
    right = spark.createDataFrame([("hot", 1)], "b string, v int")
    joined = J.skewed_join(
        left, right, "a", "b", spread_by="id", hot_rows=100, broadcast_limit=-1
    )
    per_task = [
        r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()
    ]
    assert sum(per_task) == 8000
    assert len(per_task) == 8 and max(per_task) < 8000 / 3


def test_join_labels(spark):
    labels = spark.createDataFrame([("a", "1"), ("b", "0"), ("z", "1")], "Input_id string, l string")
    texts = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "id string, body string, n int")
    joined = J.join_labels(labels, texts, "Input_id", "id")
    assert joined.columns == ["Input_id", "l", "body"]
    assert {tuple(r) for r in joined.collect()} == {("a", "1", "x"), ("b", "0", "y")}


def test_merge_scores_fans_out(spark):
    a = spark.createDataFrame([(1, 0.1), (1, 0.2)], "k int, p double")
    b = spark.createDataFrame([(1, 0.3), (1, 0.4)], "k int, q double")
    assert J.merge_scores(a, b, "k").count() == 4


def test_attach_to_dimension(spark):
    agg = spark.createDataFrame([("Ohio", 1.0), ("Utah", 2.0)], "state string, Positive double")
    dim = spark.createDataFrame([("ohio", 1), ("guam", 2)], "state string, n int")
    got = {r.state: r.Positive for r in J.attach_to_dimension(agg, dim, "state").collect()}
    assert got == {"ohio": 1.0, "guam": None}
    with pytest.raises(LookupError, match="guam"):
        J.attach_to_dimension(agg, dim, "state", strict=True)
    exact = J.attach_to_dimension(agg, dim, "state", lower=False)
    assert {r.Positive for r in exact.collect()} == {None}


# --- rollups -------------------------------------------------------------------


def scored(spark):
    rows = [("a", 1, 0), ("a", 1, 1), ("b", 0, 1), (None, 1, 1)]
    return spark.createDataFrame(rows, "k string, pos int, neg int")


def test_percent_rollup(spark):
    overall = percent_rollup(scored(spark)).first()
    assert (overall.Positive, overall.Negative) == (75.0, 75.0)
    by_key = {r.k: (r.Positive, r.Negative, r.n) for r in
              percent_rollup(scored(spark), ["k"], count="n").collect()}
    assert by_key == {"a": (100.0, 50.0, 2), "b": (0.0, 100.0, 1), None: (100.0, 100.0, 1)}
    empty = percent_rollup(scored(spark).filter("k = 'none'")).first()
    assert empty.Positive is None


def test_top_k_ties_are_fixed(spark):
    rows = [("t2", 5, 100.0, 1), ("t1", 5, 100.0, 9), ("t0", 4, 100.0, 9), ("t9", 1, 50.0, 9)]
    df = spark.createDataFrame(rows, "id string, score long, Positive double, n long")
    best = top_k(df, "Positive", 2, ["score", "id"])
    assert [r.id for r in best.collect()] == ["t0", "t1"]
    best = top_k(df, "Positive", 3, ["score", "id"], min_group=5, size="n")
    assert [r.id for r in best.collect()] == ["t0", "t1", "t9"]
    with pytest.raises(ValueError):
        top_k(df, "Positive", 3, ["id"], min_group=5)


def test_ordered(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    assert [r.k for r in ordered(df, ["k"]).collect()] == [None, "a", "b"]


def test_document_frequency(spark):
    df = spark.createDataFrame(
        [(["a", "b", "a"],), (["a"],), ([],), (None,), (["", ""],)], "tokens array<string>"
    )
    got = {r.term: (r.df, r.tf) for r in document_frequency(df, "tokens").collect()}
    assert got == {"a": (2, 3), "b": (1, 1), "": (1, 2)}
    assert values(document_frequency(df, "tokens", 2), "term") == ["a"]


@pytest.mark.parametrize("size", [1, 3, 4_000_000])
def test_terms_are_counted_in_pieces(spark, monkeypatch, size):
    """The counts do not depend on where a piece ends; no row per occurrence is made."""
    from tonetide.operators import vocabulary

    rows = [[f"t{i % 3}", "every", f"t{i % 7}", "é", None if i % 5 else ""] for i in range(60)]
    rows += [[], None, ["every"] * 9, [None]]
    monkeypatch.setattr(vocabulary, "PIECE_TOKENS", size)
    df = spark.createDataFrame([(r,) for r in rows], "tokens array<string>").repartition(3)
    counted = document_frequency(df, "tokens")
    tf, seen = Counter(), Counter()
    for r in filter(None, rows):
        tf.update(r)
        seen.update(set(r))
    assert {r.term: (r.df, r.tf) for r in counted.collect()} == {t: (seen[t], tf[t]) for t in tf}
    assert "Generate" not in counted._jdf.queryExecution().executedPlan().toString()
    assert document_frequency(df.limit(0), "tokens").count() == 0


# --- series --------------------------------------------------------------------


def test_series(spark):
    rows = [("2024-02-27", 1), ("2024-02-28", 2), ("2024-03-01", 4)]
    df = spark.createDataFrame(rows, "day string, v int").withColumn("day", F.to_date("day"))
    span = series_range(df, "day").first()
    assert (str(span.first_day), str(span.last_day)) == ("2024-02-27", "2024-03-01")
    dense = densify_daily(df, "day").orderBy("day").collect()
    assert [(r.day.day, r.v) for r in dense] == [(27, 1), (28, 2), (29, None), (1, 4)]


# --- samples -------------------------------------------------------------------


def test_hash_sample_is_the_same_on_any_layout(spark):
    df = spark.range(5000)
    a = values(K.hash_sample(df.repartition(3), "id", 0.2), "id")
    b = values(K.hash_sample(df.repartition(7), "id", 0.2), "id")
    assert a == b and 850 < len(a) < 1150
    assert values(K.hash_sample(df, "id", 0.2, salt="x"), "id") != a
    assert K.hash_sample(df, "id", 1.0).count() == 5000


@pytest.mark.parametrize(
    "parts",
    [
        lambda df: K.split(df, [0.5, 0.5], seed=3),
        lambda df: K.hash_split(df, "id", [0.5, 0.5]),
        lambda df: K.hash_split(df, "id", [1, 2, 3], salt="s"),
    ],
)
def test_splits_are_disjoint_and_complete(spark, parts):
    ids = [values(part, "id") for part in parts(spark.range(2000))]
    assert sorted(x for part in ids for x in part) == list(range(2000))
    assert all(len(part) > 200 for part in ids)


def test_sample_repeats_with_its_seed(spark):
    df = spark.range(1000)
    assert values(K.sample(df, 0.2, 5), "id") == values(K.sample(df, 0.2, 5), "id")
