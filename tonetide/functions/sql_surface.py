"""The same expressions for SQL text: temporary SQL functions, expanded by the optimizer.

No Python runs behind them. From DataFrame code, call them with ``F.call_function``. The helper
functions ``ngram_*`` split the work into steps: a function's argument is computed once, however
often its body uses it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tonetide.constants import PUNCTUATION_TOKENS, REGIONS
from tonetide.functions import text as X


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_functions(spark: SparkSession) -> None:
    """Register the functions for this session.

    ``sanitize(text)``          array of unigrams, bigrams and trigrams
    ``sanitize_parts(text)``    struct of parsed text, unigrams, bigrams, trigrams
    ``ngrams(tokens, n)``       windows of ``n`` tokens
    ``valid_state(region)``     true for an allowed region, else false
    ``first_element(array)``    probability of class 1 from ``[p0, p1]``, in 32 bits
    """

    def create(name: str, args: str, returns: str, body: str) -> None:
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {returns} RETURN {body}"
        )

    list_of = "ARRAY<STRING>"
    create(
        "ngram_spaces",
        "body STRING",
        "STRING",
        "replace(replace(body, '\\t', ' '), '\\n', ' ')",
    )
    create(
        "ngram_no_links",
        "body STRING",
        "STRING",
        "CASE WHEN contains(body, '](http') OR contains(body, 'www.')"
        f" THEN regexp_replace(body, {_quoted(X.LINK)}, '') ELSE body END",
    )
    create(
        "ngram_no_mentions",
        "body STRING",
        "STRING",
        "CASE WHEN contains(body, '/r/') OR contains(body, '/u/')"
        f" THEN regexp_replace(body, {_quoted(X.MENTION)}, '') ELSE body END",
    )
    create(
        "ngram_prepare",
        "body STRING",
        "STRING",
        "ngram_no_mentions(ngram_no_links(ngram_spaces(body)))",
    )
    create(
        "ngram_clean",
        f"raw {list_of}",
        list_of,
        f"CASE WHEN size(raw) = 0 THEN CAST(array() AS {list_of}) ELSE split(lower("
        f"regexp_replace(array_join(raw, ' '), {_quoted(X.STRAY_IN_TOKENS)}, '')), ' ') END",
    )
    create(
        "ngram_extend",
        f"shorter {list_of}, uni {list_of}, n INT",
        list_of,
        "zip_with(slice(shorter, 1, greatest(size(uni) - n + 1, 0)),"
        " slice(uni, n, greatest(size(uni) - n + 1, 0)), (a, b) -> concat(a, '_', b))",
    )
    create(
        "ngrams",
        f"tokens {list_of}, n INT",
        list_of,
        f"CASE WHEN size(tokens) < n THEN CAST(array() AS {list_of}) ELSE"
        " transform(sequence(1, size(tokens) - n + 1),"
        " i -> array_join(slice(tokens, i, n), '_')) END",
    )
    create(
        "ngram_bag_of",
        f"uni {list_of}, bi {list_of}",
        list_of,
        "concat(array_remove(uni, ''), bi, ngram_extend(bi, uni, 3))",
    )
    create(
        "ngram_bag",
        f"uni {list_of}",
        list_of,
        "ngram_bag_of(uni, ngram_extend(uni, uni, 2))",
    )
    create(
        "sanitize",
        "text STRING",
        list_of,
        "ngram_bag(array_remove(ngram_clean("
        f"regexp_extract_all(ngram_prepare(text), {_quoted(X.WORD_TOKEN)}, 0)), '\\''))",
    )
    parts = "STRUCT<parsed: STRING, unigrams: STRING, bigrams: STRING, trigrams: STRING>"
    marks = ", ".join(_quoted(m) for m in PUNCTUATION_TOKENS)
    create(
        "ngram_parts_of",
        f"parsed {list_of}, uni {list_of}, bi {list_of}",
        parts,
        "CASE WHEN parsed IS NOT NULL THEN named_struct('parsed', array_join(parsed, ' '),"
        " 'unigrams', array_join(uni, ' '), 'bigrams', array_join(bi, ' '),"
        " 'trigrams', array_join(ngram_extend(bi, uni, 3), ' ')) END",
    )
    create(
        "ngram_parts_from",
        f"parsed {list_of}, uni {list_of}",
        parts,
        "ngram_parts_of(parsed, uni, ngram_extend(uni, uni, 2))",
    )
    create(
        "ngram_parts",
        f"parsed {list_of}",
        parts,
        f"ngram_parts_from(parsed, filter(parsed, t -> t NOT IN ({marks})))",
    )
    create(
        "sanitize_parts",
        "text STRING",
        parts,
        "ngram_parts(ngram_clean("
        f"regexp_extract_all(ngram_prepare(text), {_quoted(X.TOKEN)}, 0)))",
    )
    regions = ", ".join(_quoted(r) for r in REGIONS)
    create(
        "valid_state", "region STRING", "BOOLEAN", f"coalesce(region IN ({regions}), false)"
    )
    create(
        "first_element", "probability ARRAY<DOUBLE>", "FLOAT", "CAST(probability[1] AS FLOAT)"
    )
