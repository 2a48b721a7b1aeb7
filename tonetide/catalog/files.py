"""Sources, sinks, ingest and stages: write whole tables, read them back, compare.

Every call writes to a new folder, see ``shared_dir``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tonetide.catalog import bindings as B
from tonetide.catalog.registry import query
from tonetide.catalog.texts import grams, t1, t2, t3, t4, t5, t6, t8
from tonetide.plans import reports as R
from tonetide.plans.postprocess import load_report
from tonetide.sources.ingest import clean_file, ingest
from tonetide.sources.readers import read_comments, read_labels, read_table, read_threads
from tonetide.sources.stages import shared_dir, stage
from tonetide.sources.writers import write_report, write_table


def _write_json(df, path, compression="bzip2"):
    df.write.option("compression", compression).json(path)
    return path


def _write_labels(df, path):
    df.write.option("header", True).csv(path)
    return path


def _digest(comments):
    return comments.withColumn("body_md5", F.md5("body")).drop("body")


_COMMENTS = f"SELECT * EXCLUDE (body), md5(body) AS body_md5 FROM ({B.COMMENTS})"
_KEPT = ["id", "body", "created_utc", "author_flair_text", "link_id", "score"]


@query("S1", _COMMENTS)
def comments_from_json(spark, sf_dir):
    path = _write_json(B.comments(spark, sf_dir), f"{shared_dir(spark)}/comments.json")
    return _digest(read_comments(spark, path).select(*_KEPT))


@query("S2", B.THREADS)
def threads_from_json(spark, sf_dir):
    path = _write_json(B.threads(spark, sf_dir), f"{shared_dir(spark)}/threads.json")
    return read_threads(spark, path)


@query("S3", B.LABELS)
def labels_from_csv(spark, sf_dir):
    path = _write_labels(B.labels(spark, sf_dir), f"{shared_dir(spark)}/labels.csv")
    return read_labels(spark, path)


@query("S4 S5", "SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM documents")
def documents_through_parquet(spark, sf_dir):
    path = f"{shared_dir(spark)}/documents"
    write_table(B.table(spark, sf_dir, "documents"), path)
    back = read_table(spark, path)
    return back.select("doc_id", F.md5("text").alias("text_md5"), "lang", "source", "n_chars")


@query(
    "S6 S7",
    f"SELECT comment_score, {B.PERCENT} FROM ({B.FLAGGED}) GROUP BY comment_score",
)
def report_through_csv(spark, sf_dir):
    out = shared_dir(spark)
    report = R.by_comment_score(B.flagged(spark, sf_dir))
    write_report(report, f"{out}/comment_score.csv", ["comment_score"])
    return load_report(spark, out, "comment_score")


@query(
    "S9 T10",
    f"""SELECT md5(array_to_string(tokens, ' ')) AS parsed,
               md5(array_to_string(g, ' ')) AS unigrams,
               md5(array_to_string({grams(2)}, ' ')) AS bigrams,
               md5(array_to_string({grams(3)}, ' ')) AS trigrams
        FROM (SELECT tokens, {t8("tokens")} AS g
              FROM (SELECT {t6(t5(t4(t3(t2(t1("body"))))))} AS tokens FROM ({B.COMMENTS})))""",
)
def cleaned_file(spark, sf_dir):
    out = shared_dir(spark)
    path = _write_json(B.comments(spark, sf_dir), f"{out}/comments.json", "none")
    cleaned = clean_file(spark, path, f"{out}/cleaned")
    return cleaned.select(*[F.md5(c).alias(c) for c in cleaned.columns])


@query(
    "S10",
    f"""SELECT 'comments' AS name, count(*) AS n, sum(length(body))::BIGINT AS size
        FROM ({B.COMMENTS})
        UNION ALL SELECT 'threads', count(*), sum(score)::BIGINT FROM ({B.THREADS})
        UNION ALL SELECT 'labels', count(*), sum(length(labeldjt))::BIGINT FROM ({B.LABELS})""",
)
def ingested_tables(spark, sf_dir):
    out = shared_dir(spark)
    comments, threads, labels = ingest(
        spark,
        _write_json(B.comments(spark, sf_dir), f"{out}/raw/comments.json"),
        _write_json(B.threads(spark, sf_dir), f"{out}/raw/threads.json"),
        _write_labels(B.labels(spark, sf_dir), f"{out}/raw/labels.csv"),
        f"{out}/tables",
    )

    def size(df, name, measure):
        return df.agg(F.count(F.lit(1)).alias("n"), F.sum(measure).cast("bigint").alias("size")
                      ).select(F.lit(name).alias("name"), "n", "size")

    return (
        size(comments, "comments", F.length("body"))
        .unionByName(size(threads, "threads", F.col("score")))
        .unionByName(size(labels, "labels", F.length("labeldjt")))
    )


@query("K1", "SELECT conv_id, turn, role FROM conversations")
def staged_once(spark, sf_dir):
    """The second call must read what the first wrote: its own build would fail."""
    path = f"{shared_dir(spark)}/stage"
    turns = B.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")

    def must_not_run():
        raise AssertionError("a finished stage was built again")

    stage(spark, path, lambda: turns)
    return stage(spark, path, must_not_run)
