"""N-gram operators, at frame level so that every step is a column computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonetide.functions import text as X

_STEP = "__step_"


def with_ngrams(df: DataFrame, tokens: str, n: int, out: str, sep: str = "_") -> DataFrame:
    """Add windows of ``n`` tokens; fewer than ``n`` tokens give an empty array.

    An n-gram is an (n-1)-gram extended by one token, zipped array by array. That is linear;
    indexing into the array from a lambda would re-evaluate it per element.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    grams = tokens
    for k in range(2, n + 1):
        step = out if k == n else f"{_STEP}{out}_{k}"
        df = df.withColumn(step, _extend(tokens, grams, k, sep))
        grams = step
    if n == 1:
        df = df.withColumn(out, F.col(tokens))
    return df.drop(*[f"{_STEP}{out}_{k}" for k in range(2, n)])


def _extend(tokens: str, shorter: str, k: int, sep: str) -> Column:
    count = F.greatest(F.size(tokens) - (k - 1), F.lit(0))
    return F.zip_with(
        F.slice(shorter, F.lit(1), count),
        F.slice(tokens, F.lit(k), count),
        lambda left, right: F.concat(left, F.lit(sep), right),
    )


def _with_words(df: DataFrame, text: str, tokens: Column, raw: str) -> DataFrame:
    """Add ``tokens`` over the prepared text; each preparing step is computed once."""
    body = f"{_STEP}body"
    df = df.withColumn(body, X.normalize_ws(text))
    df = df.withColumn(body, X.strip_links(body))
    df = df.withColumn(body, X.strip_mentions(body))
    return df.withColumn(raw, tokens).drop(body)


def with_sanitized(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add a struct of four strings: parsed text, unigrams, bigrams, trigrams."""
    raw, parsed, uni, bi, tri = (f"{_STEP}{s}" for s in ("raw", "parsed", "uni", "bi", "tri"))
    df = _with_words(df, text, X.tokenize(f"{_STEP}body"), raw)
    df = df.withColumn(parsed, X.clean_joined(raw))
    df = df.withColumn(uni, X.drop_punctuation(X.split_joined(parsed, raw)))
    df = df.withColumn(bi, _extend(uni, uni, 2, "_"))
    df = df.withColumn(tri, _extend(uni, bi, 3, "_"))
    fields = F.struct(
        F.col(parsed).alias("parsed"),
        X.join_tokens(uni).alias("unigrams"),
        X.join_tokens(bi).alias("bigrams"),
        X.join_tokens(tri).alias("trigrams"),
    )
    df = df.withColumn(out, F.when(F.col(text).isNotNull(), fields))
    return df.drop(raw, parsed, uni, bi, tri)


def with_ngram_bag(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add one array: unigrams, then bigrams, then trigrams.

    Empty unigrams are left out; bigrams and trigrams built over them stay. Punctuation marks
    never reach an n-gram, so only words are tokenized here; the one mark that is also a word
    character is the apostrophe.
    """
    raw, uni, bi = (f"{_STEP}{s}" for s in ("raw", "uni", "bi"))
    df = _with_words(df, text, X.words(f"{_STEP}body"), raw)
    df = df.withColumn(uni, F.array_remove(X.split_joined(X.clean_joined(raw), raw), "'"))
    df = df.withColumn(bi, _extend(uni, uni, 2, "_"))
    tri = _extend(uni, bi, 3, "_")
    df = df.withColumn(out, F.concat(F.array_remove(uni, ""), F.col(bi), tri))
    return df.drop(raw, uni, bi)
