"""Joins.

No side carries an unconditional broadcast hint: Spark broadcasts a side whose estimated size
is below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise. ``skewed_join`` keeps
the shuffled form balanced when a few keys hold much of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonetide.constants import QUOTE_MARK, SARCASM_MARK, THREAD_PREFIX
from tonetide.functions.values import ltrim_chars, strip_prefix
from tonetide.operators.filters import not_containing, not_starting_with
from tonetide.sources.readers import estimated_bytes

# A key is split if it holds more than ``hot_rows`` rows and more than this share of all rows. By
# counting, fewer than 1 / share keys do, which bounds what is broadcast; a key below the share is
# small beside what a task reads anyway.
HOT_SHARE = 1 / 100_000
# Bits of the filter that label keys set: 32 MB, whatever their number.
FILTER_BITS = 1 << 28
_ROW_SHIFT = 15
_ROW_BITS = 1 << _ROW_SHIFT


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """True if Spark's own size estimate for ``df`` is within the session's broadcast limit.

    ``limit`` (bytes) overrides ``spark.sql.autoBroadcastJoinThreshold``.
    """
    if limit is None:
        limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return estimated_bytes(df) <= limit


def hot_keys(df: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """The keys with more than ``hot_rows`` rows and more than ``HOT_SHARE`` of all rows.

    Columns ``__hot`` and ``__splits``, the number of parts of that size. Counting is pre-aggregated
    on the map side and reads one column; every key that passes is listed.
    """
    least = max(hot_rows, int(df.count() * HOT_SHARE))
    return (
        df.groupBy(F.col(key).alias("__hot"))
        .count()
        .filter((F.col("count") > least) & F.col("__hot").isNotNull())
        .select("__hot", F.ceil(F.col("count") / least).cast("int").alias("__splits"))
    )


def skewed_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    spread_by: str,
    keys_of: DataFrame | None = None,
    hot_rows: int = 2_000_000,
    broadcast_limit: int | None = None,
) -> DataFrame:
    """Inner equi-join in which the left rows of a hot key are split over many tasks.

    A key with more than ``hot_rows`` left rows is split into parts of about that size; a row
    goes to the part its ``spread_by`` value hashes to. The right rows of hot keys, and only
    those, are repeated once per part. Every pair still meets exactly once. ``keys_of`` may name
    a cheaper table with the left keys (before row filters) to count. If the right side is small
    enough to broadcast, there is no shuffle to balance.
    """
    if fits_broadcast(right, broadcast_limit):
        # Within the session's limit Spark broadcasts by itself; above it, the checked size must
        # be said, or both sides would shuffle with their hot keys whole.
        checked = right if broadcast_limit is None else F.broadcast(right)
        return left.join(checked, F.col(left_key) == F.col(right_key))
    hot = F.broadcast(hot_keys(left if keys_of is None else keys_of, left_key, hot_rows))
    splits = F.coalesce(F.col("__splits"), F.lit(1))
    left = (
        left.join(hot, F.col(left_key) == F.col("__hot"), "left")
        .withColumn(
            "__split",
            F.when(splits > 1, F.pmod(F.xxhash64(spread_by), splits).cast("int")).otherwise(0),
        )
        .drop("__hot", "__splits")
    )
    right = (
        right.join(hot, F.col(right_key) == F.col("__hot"), "left")
        .withColumn("__part", F.explode(F.sequence(F.lit(0), splits - 1)))
        .drop("__hot", "__splits")
    )
    matches = (F.col(left_key) == F.col(right_key)) & (F.col("__split") == F.col("__part"))
    return left.join(right, matches).drop("__split", "__part")


def key_filter(keys: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """``__bucket`` and ``__bits``: a bit is set where the hash of some key falls.

    A Bloom filter of one hash, built in the cluster. Each row holds 32,768 bits, so the whole takes
    ``bits`` / 8 bytes at most, however many keys there are.
    """
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    in_row = F.bitmap_construct_agg(place.bitwiseAND(F.lit(_ROW_BITS - 1)))
    return (
        keys.where(F.col(key).isNotNull())
        .groupBy(F.shiftright(place, _ROW_SHIFT).alias("__bucket"))
        .agg(in_row.alias("__bits"))
    )


def maybe_in(df: DataFrame, key: str, built: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The rows whose key may be among those of ``key_filter``; the others are surely not."""
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    within = place.bitwiseAND(F.lit(_ROW_BITS - 1))
    byte = F.substring("__bits", F.shiftright(within, 3).cast("int") + 1, F.lit(1))
    number = F.conv(F.hex(byte), 16, 10).cast("int")
    near = df.join(F.broadcast(built), F.shiftright(place, _ROW_SHIFT) == F.col("__bucket"))
    is_set = F.getbit(number, within.bitwiseAND(F.lit(7)).cast("int")) == 1
    return near.where(is_set).drop("__bucket", "__bits")


def join_labels(
    labels: DataFrame, texts: DataFrame, label_key: str, text_key: str, body: str = "body"
) -> DataFrame:
    """Labels with the text they belong to; only the key and ``body`` of the texts are read.

    If the labels are too large to broadcast but their keys are not, the keys alone filter the
    texts first, so that only labelled texts shuffle. If the keys are too large as well, a filter of
    ``FILTER_BITS`` made from them does so for nearly all texts without a label.
    """
    bodies = texts.select(F.col(text_key).alias("__text_key"), F.col(body).alias("body"))
    keys = labels.select(F.col(label_key).alias("__label_key"))
    if not fits_broadcast(labels):
        if fits_broadcast(keys):
            wanted = F.broadcast(keys.where(F.col("__label_key").isNotNull()).distinct())
            bodies = bodies.join(wanted, F.col("__text_key") == F.col("__label_key"), "left_semi")
        else:
            bodies = maybe_in(bodies, "__text_key", key_filter(keys, "__label_key"))
    return labels.join(bodies, F.col(label_key) == F.col("__text_key")).drop("__text_key")


def thread_key(link: str, strip: str = "prefix") -> Column:
    """Thread id from a link id.

    ``"prefix"`` removes the prefix once. ``"charset"`` removes any leading run of its
    characters, which also eats the start of ids such as ``3t…``.
    """
    if strip == "prefix":
        return strip_prefix(link, THREAD_PREFIX)
    if strip == "charset":
        return ltrim_chars(link, THREAD_PREFIX)
    raise ValueError(f"strip must be 'prefix' or 'charset', not {strip!r}")


def comments_with_key(comments: DataFrame, link_col: str, strip: str) -> DataFrame:
    """Comments without sarcastic and quoting ones, renamed, their thread id as ``__thread``."""
    kept = not_starting_with(
        not_containing(comments, "body", SARCASM_MARK), "body", QUOTE_MARK
    )
    return kept.select(
        F.col("id").alias("comment_id"),
        "body",
        F.col("created_utc").alias("timestamp"),
        F.col("author_flair_text").alias("state"),
        F.col("score").alias("comment_score"),
        thread_key(link_col, strip).alias("__thread"),
    )


def attach_threads(
    keyed: DataFrame, threads: DataFrame, keys_of: DataFrame | None = None, **skew
) -> DataFrame:
    """Add id, title and score of the thread named by ``__thread``.

    One thread may hold a large share of all comments, hence the skewed join.
    """
    parents = threads.select(
        F.col("id").alias("submission_id"), "title", F.col("score").alias("submission_score")
    )
    joined = skewed_join(
        keyed,
        parents,
        "__thread",
        "submission_id",
        spread_by="comment_id",
        keys_of=keys_of,
        **skew,
    )
    return joined.drop("__thread")


def join_threads(
    comments: DataFrame,
    threads: DataFrame,
    link_col: str = "link_id",
    strip: str = "prefix",
    **skew,
) -> DataFrame:
    """Comments with their thread, without sarcastic and quoting comments.

    Keys are counted before the text filters, so that counting reads the link column alone.
    """
    joined = attach_threads(
        comments_with_key(comments, link_col, strip),
        threads,
        keys_of=comments.select(thread_key(link_col, strip).alias("__thread")),
        **skew,
    )
    return joined.select(
        "comment_id",
        "submission_id",
        "body",
        "timestamp",
        "state",
        "title",
        "comment_score",
        "submission_score",
    )


def merge_scores(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Re-unite two scored copies of a table on ``key``; repeated keys multiply.

    Scoring both models in one pass (``operators.models.score``) needs no join at all.
    """
    return a.join(b, key)


def attach_to_dimension(
    agg: DataFrame, dim: DataFrame, key: str, lower: bool = True, strict: bool = False
) -> DataFrame:
    """Every dimension row with the aggregate of the same ``key``, null where there is none.

    ``lower`` compares lower-cased names. ``strict`` raises if a dimension row finds nothing;
    that check runs at once and reads ``agg``, so give it a stored rollup.
    """

    def name(c: str) -> Column:
        return F.lower(c) if lower else F.col(c)

    values = agg.withColumn("__key", name(key)).drop(key)
    attached = values.join(dim, F.col("__key") == name(key), "right")
    if strict:
        missing = dim.join(values, F.col("__key") == name(key), "left_anti")
        first = missing.select(key).take(1)
        if first:
            raise LookupError(f"no data for {key} {first[0][0]!r}")
    return attached.drop("__key").select(*dim.columns, *[c for c in agg.columns if c != key])
