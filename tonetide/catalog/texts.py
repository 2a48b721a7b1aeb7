"""Text operators over whole texts of whole tables.

Results are reduced to a count and a digest per row to keep the compared rows small.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tonetide.catalog import bindings as B
from tonetide.catalog.registry import query
from tonetide.functions import text as X
from tonetide.functions.sql_surface import register_functions
from tonetide.operators.ngrams import with_ngram_bag, with_ngrams, with_sanitized

# Appended to every text, so that the link and mention rules have something to remove.
TAIL = " see [a](http://x.com/p?q=1) mid [b](https://y.org/z). end /r/pol /u/me_1-x www.a .b .c)"

# --- SQL twins ----------------------------------------------------------------
_W = r"\p{L}\p{N}_"
_S = r"[^\t-\r\x{1c}-\x{1f}\x{85}\p{Z}]"
LINK_SQL = rf"\[[^\n]*\]\(https?://{_S}*[{_W}]|www\.([{_W}] +\.)+{_S}*\)"
STRAY_SQL = "[^0-9a-zA-Z.,!?;:''-]+"


def t1(c: str) -> str:
    return f"replace(replace({c}, chr(9), ' '), chr(10), ' ')"


def t2(c: str) -> str:
    return f"regexp_replace({c}, '{LINK_SQL}', '', 'g')"


def t3(c: str) -> str:
    return f"regexp_replace({c}, '/[ru]/[a-zA-Z0-9_-]+', '', 'g')"


def t4(c: str) -> str:
    return f"regexp_extract_all({c}, '[{_W}'']+|[.,!?;:]')"


def t5(c: str) -> str:
    return f"list_transform({c}, lambda t: regexp_replace(t, '{STRAY_SQL}', '', 'g'))"


def t6(c: str) -> str:
    return f"list_transform({c}, lambda t: lower(t))"


def t8(c: str) -> str:
    return f"""list_filter({c}, lambda t: t NOT IN ('''', '-', '!', '.', '?', ':', ';', ','))"""


def grams(n: int) -> str:
    """``g`` is the list of unigrams."""
    parts = [f"g[{k + 1}:len(g) - {n - 1 - k}]" for k in range(n)]
    joined = " || '_' || ".join(f"p[{k + 1}]" for k in range(n))
    return (
        f"CASE WHEN len(g) < {n} THEN CAST([] AS VARCHAR[]) "
        f"ELSE list_transform(list_zip({', '.join(parts)}), lambda p: {joined}) END"
    )


def digest(c: str) -> str:
    return f"md5(array_to_string({c}, ' '))"


def bag_sql(source: str, text: str) -> str:
    """Rows of ``source`` with ``bag``: unigrams without empty ones, bigrams, trigrams."""
    return f"""
        SELECT * EXCLUDE (g),
               list_concat(list_concat(list_filter(g, lambda t: t <> ''), {grams(2)}),
                           {grams(3)}) AS bag
        FROM (SELECT *, {t8(t6(t5(t4(t3(t2(t1(text)))))))} AS g FROM ({source}))"""


_TAILED = f"SELECT doc_id, text || '{TAIL}' AS t FROM documents"


def _tailed(spark, sf_dir):
    docs = B.documents(spark, sf_dir, "text")
    return docs.select("doc_id", F.concat("text", F.lit(TAIL)).alias("t"))


def _column_digest(df, column):
    return df.select("doc_id", F.length(column).alias("n"), F.md5(column).alias("digest"))


def _list_digest(df, column):
    return df.select(
        "doc_id", F.size(column).alias("n"), F.md5(F.array_join(column, " ")).alias("digest")
    )


def _text_sql(expr: str) -> str:
    return f"""SELECT doc_id, CAST(length(x) AS INTEGER) AS n, md5(x) AS digest
               FROM (SELECT doc_id, {expr} AS x FROM ({_TAILED}))"""


def _list_sql(expr: str) -> str:
    return f"""SELECT doc_id, CAST(len(x) AS INTEGER) AS n, {digest('x')} AS digest
               FROM (SELECT doc_id, {expr} AS x FROM ({_TAILED}))"""


@query("T1", _text_sql(t1("t")))
def text_whitespace(spark, sf_dir):
    return _column_digest(_tailed(spark, sf_dir).withColumn("x", X.normalize_ws("t")), "x")


@query("T2", _text_sql(t2("t")))
def text_links_removed(spark, sf_dir):
    return _column_digest(_tailed(spark, sf_dir).withColumn("x", X.strip_links("t")), "x")


@query("T3", _text_sql(t3("t")))
def text_mentions_removed(spark, sf_dir):
    return _column_digest(_tailed(spark, sf_dir).withColumn("x", X.strip_mentions("t")), "x")


@query("T4", _list_sql(t4("t")))
def text_tokens(spark, sf_dir):
    return _list_digest(_tailed(spark, sf_dir).withColumn("x", X.tokenize("t")), "x")


@query("T5", _list_sql(t5(t4("t"))))
def text_clean_tokens(spark, sf_dir):
    df = _tailed(spark, sf_dir).withColumn("tokens", X.tokenize("t"))
    return _list_digest(df.withColumn("x", X.clean_tokens("tokens")), "x")


@query("T6", _list_sql(t6(t5(t4("t")))))
def text_lower_tokens(spark, sf_dir):
    df = _tailed(spark, sf_dir).withColumn("tokens", X.tokenize("t"))
    return _list_digest(df.withColumn("x", X.lower_tokens(X.clean_tokens("tokens"))), "x")


@query("T8", _list_sql(t8(t6(t5(t4("t"))))))
def text_without_punctuation(spark, sf_dir):
    df = _tailed(spark, sf_dir).withColumn("raw", X.tokenize("t"))
    tokens = X.split_joined(X.clean_joined("raw"), "raw")
    return _list_digest(df.withColumn("x", X.drop_punctuation(tokens)), "x")


@query(
    "T9",
    f"""SELECT doc_id, CAST(length(x) AS INTEGER) AS n, md5(x) AS digest
        FROM (SELECT doc_id, array_to_string({t6(t5(t4("t")))}, ' ') AS x FROM ({_TAILED}))""",
)
def text_parsed(spark, sf_dir):
    df = _tailed(spark, sf_dir).withColumn("tokens", X.tokenize("t"))
    parsed = X.join_tokens(X.lower_tokens(X.clean_tokens("tokens")))
    return _column_digest(df.withColumn("x", parsed), "x")


@query(
    "T7",
    f"""SELECT doc_id, CAST(len(x) AS INTEGER) AS n, {digest('x')} AS digest
        FROM (SELECT doc_id, {grams(4)} AS x
              FROM (SELECT doc_id, {t8(t6(t5(t4("t"))))} AS g FROM ({_TAILED})))""",
)
def text_four_grams(spark, sf_dir):
    df = _tailed(spark, sf_dir).withColumn("raw", X.tokenize("t"))
    df = df.withColumn("g", X.drop_punctuation(X.split_joined(X.clean_joined("raw"), "raw")))
    return _list_digest(with_ngrams(df, "g", 4, "x"), "x")


@query(
    "T10",
    f"""SELECT doc_id, md5(array_to_string(tokens, ' ')) AS parsed,
               md5(array_to_string(g, ' ')) AS unigrams,
               md5(array_to_string({grams(2)}, ' ')) AS bigrams,
               md5(array_to_string({grams(3)}, ' ')) AS trigrams
        FROM (SELECT doc_id, tokens, {t8("tokens")} AS g
              FROM (SELECT doc_id, {t6(t5(t4(t3(t2(t1("t"))))))} AS tokens FROM ({_TAILED})))""",
)
def text_sanitized(spark, sf_dir):
    df = with_sanitized(_tailed(spark, sf_dir), "t", "s")
    parts = ("parsed", "unigrams", "bigrams", "trigrams")
    return df.select("doc_id", *[F.md5(f"s.{p}").alias(p) for p in parts])


_BAG = f"""SELECT doc_id, CAST(len(bag) AS INTEGER) AS n, {digest('bag')} AS digest
           FROM ({bag_sql(_TAILED, 't')})"""


@query("T11 U1", _BAG)
def text_ngram_bag(spark, sf_dir):
    return _list_digest(with_ngram_bag(_tailed(spark, sf_dir), "t", "x"), "x")


@query("T11 U1", _BAG)
def text_ngram_bag_in_sql_text(spark, sf_dir):
    register_functions(spark)
    _tailed(spark, sf_dir).createOrReplaceTempView("tailed_texts")
    return _list_digest(spark.sql("SELECT doc_id, sanitize(t) AS x FROM tailed_texts"), "x")


@query(
    "T7 T10",
    f"""SELECT doc_id, {digest('tokens')} AS parsed, CAST(len(g) AS INTEGER) AS n,
               {digest(grams(5))} AS five_grams
        FROM (SELECT doc_id, tokens, {t8("tokens")} AS g
              FROM (SELECT doc_id, {t6(t5(t4(t3(t2(t1("t"))))))} AS tokens FROM ({_TAILED})))""",
)
def text_parts_in_sql_text(spark, sf_dir):
    register_functions(spark)
    _tailed(spark, sf_dir).createOrReplaceTempView("tailed_texts")
    return spark.sql(
        """
        FROM tailed_texts
        |> SELECT doc_id, sanitize_parts(t) AS s
        |> SELECT doc_id, s.parsed AS parsed, split(s.unigrams, ' ') AS g
        |> SELECT doc_id, md5(parsed) AS parsed, size(g) AS n,
                  md5(array_join(ngrams(g, 5), ' ')) AS five_grams
        """
    )


_TURNS = "SELECT conv_id, turn, text FROM conversations"


@query(
    "T11",
    f"""SELECT conv_id, turn, CAST(len(bag) AS INTEGER) AS n, {digest('bag')} AS digest
        FROM ({bag_sql(_TURNS, 'text')})""",
)
def conversation_ngram_bag(spark, sf_dir):
    turns = B.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return with_ngram_bag(turns, "text", "x").select(
        "conv_id", "turn", F.size("x").alias("n"), F.md5(F.array_join("x", " ")).alias("digest")
    )


@query(
    "T10",
    f"""SELECT page_id, md5(array_to_string(tokens, ' ')) AS parsed,
               CAST(len(g) AS INTEGER) AS n
        FROM (SELECT page_id, tokens, {t8("tokens")} AS g
              FROM (SELECT page_id, {t6(t5(t4(t3(t2(t1("html"))))))} AS tokens FROM pages))""",
)
def pages_sanitized(spark, sf_dir):
    pages = B.table(spark, sf_dir, "pages").select("page_id", "html")
    df = with_sanitized(pages, "html", "s")
    empty = F.col("s.unigrams") == ""
    return df.select(
        "page_id",
        F.md5("s.parsed").alias("parsed"),
        F.when(empty, 0).otherwise(F.size(F.split("s.unigrams", " "))).alias("n"),
    )
