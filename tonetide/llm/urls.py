"""URL filtering by mined association rules.

A labelled url is a transaction of its tokens and its label. FP-growth finds the combinations of
tokens that occur often together with the bad label; those confident enough become rules, and a rule
is dropped if a part of it is as confident. Rules are indexed under their rarest token, so a url
looks up its own tokens and tests the few rules listed there. Only DataFrame functions run here.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonetide.llm.shared import stored

MIN_SUPPORT = 0.002
MIN_COUNT = 10  # urls that a combination needs, however few are labelled
MIN_CONFIDENCE = 0.6
MIN_LIFT = 2.0
_BAD, _GOOD = "label:bad", "label:good"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """Up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    name = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(name, string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def tokens(url: Column) -> Column:
    """Distinct lower-case tokens: labels of the host, words of the path, names in the query.

    Numbers are no tokens. A null url has none.
    """

    def marked(mark: str, words: Column) -> Column:
        kept = F.filter(words, lambda w: (w != "") & ~w.rlike(r"^[0-9]+$"))
        return F.transform(kept, lambda w: F.concat(F.lit(mark), w))

    words = F.split(F.lower(path(url)), r"[^\p{L}\p{N}]+")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    names = F.transform(F.split(F.lower(query), "&"), lambda x: F.substring_index(x, "=", 1))
    every = F.concat(
        marked("host:", F.split(host(url), r"\.")), marked("path:", words), marked("query:", names)
    )
    return F.coalesce(F.array_distinct(every), F.array().cast("array<string>"))


def mine(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_lift: float = MIN_LIFT,
) -> DataFrame:
    """Rules from ``url`` and boolean ``bad``: ``tokens confidence lift support anchor``.

    Rows with a null url or label are left out. If more than one in (2 ``min_lift`` - 1) labels are
    bad, a lift of ``min_lift`` is hard or impossible to reach (it is at most 1 / bad share), and the
    least confidence is the middle between the bad share and 1 instead. There are at most (tokens in a url / min_support)
    frequent tokens, whatever the number of urls. Without a labelled url there are no rules.
    """
    labelled = labelled.where(F.col("url").isNotNull() & F.col("bad").isNotNull())
    label = F.when(F.col("bad"), _BAD).otherwise(_GOOD)
    items = stored(labelled.select(F.concat(tokens(F.col("url")), F.array(label)).alias("items")))
    total, bad = items.agg(F.count("*"), F.count_if(F.array_contains("items", _BAD))).first()
    support = min(1.0, max(min_support, MIN_COUNT / max(1, total)))
    lift = min(min_lift, (1 + total / bad) / 2) if bad else min_lift
    growth = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence)
    model = growth.fit(items)
    rules = stored(
        model.associationRules.where(
            (F.col("consequent") == F.array(F.lit(_BAD))) & (F.col("lift") >= lift)
        ).select(F.array_sort("antecedent").alias("tokens"), "confidence", "lift", "support")
    )
    counts = model.freqItemsets.where(F.size("items") == 1).select(
        F.col("items")[0].alias("token"), "freq"
    )
    rarest = (
        rules.select("tokens", F.explode("tokens").alias("token"))
        .join(counts, "token")
        .groupBy("tokens")
        .agg(F.min(F.struct("freq", "token")).alias("rarest"))
        .select("tokens", F.col("rarest.token").alias("anchor"))
    )
    rules = stored(rules.join(rarest, "tokens"))
    part = rules.select(
        F.col("anchor").alias("__token"),
        F.col("tokens").alias("__part"),
        F.col("confidence").alias("__confidence"),
    )
    longer = rules.select("tokens", "confidence", F.explode("tokens").alias("__token"))
    covered = longer.join(part, "__token").where(
        (F.size("__part") < F.size("tokens"))
        & (F.size(F.array_except("__part", "tokens")) == 0)
        & (F.col("__confidence") >= F.col("confidence"))
    )
    return stored(rules.join(covered.select("tokens").distinct(), "tokens", "left_anti"))


def matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url matched confidence`` for each distinct url with a rule; the most confident is named."""
    index = rules.select("anchor", F.col("tokens").alias("matched"), "confidence")
    seen = (
        urls.where(F.col("url").isNotNull())
        .select("url")
        .distinct()
        .select("url", tokens(F.col("url")).alias("__tokens"))
        .select("url", "__tokens", F.explode(F.col("__tokens")).alias("anchor"))
    )
    hits = seen.join(index, "anchor").where(F.size(F.array_except("matched", "__tokens")) == 0)
    best = F.max(F.struct("confidence", "matched")).alias("best")
    return hits.groupBy("url").agg(best).select("url", "best.matched", "best.confidence")


def listed(host_: Column, path_: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest of the given (verdict, rule) that fits, and its verdict; null if none fits.

    A rule is a host and, from its first slash on, a path. It fits its host and all subdomains, if
    the url's path starts with the rule's.
    """
    rule = verdict = None
    for say, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        own = (host_ == name) | host_.endswith(f".{name}")
        fits = own & path_.startswith(slash + rest)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, say) if verdict is None else verdict.when(fits, say)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def judge(pages: DataFrame, mined: DataFrame, rules: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """``page_id host path rule verdict matched confidence`` for every page.

    The verdict is the fitting rule's, else ``block`` if a mined rule matches, else ``allow``.
    ``matched`` are the mined rule's tokens, null if none matches. A null url has an empty host and
    path and is allowed. Rows that repeat a url are judged alike.
    """
    found = matches(pages, mined).withColumnRenamed("url", "__url")
    url = F.coalesce("url", F.lit(""))
    split = pages.select("page_id", "url", host(url).alias("host"), path(url).alias("path"))
    rule, verdict = listed(F.col("host"), F.col("path"), rules)
    mined_says = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return split.join(found, F.col("url") == F.col("__url"), "left").select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, mined_says).alias("verdict"),
        "matched",
        "confidence",
    )
