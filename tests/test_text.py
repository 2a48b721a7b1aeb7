"""Text operators against a plain-Python statement of the same rules."""

import re
import unicodedata

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tonetide.functions import text as X
from tonetide.functions.sql_surface import register_functions
from tonetide.operators.ngrams import with_ngram_bag, with_ngrams, with_sanitized

# --- fixed values: the patterns in Python's dialect ---------------------------
LINK = re.compile(r"\[.*\]\(https?://\S+\b|www\.(\w +\.)+\S*\)")
MENTION = re.compile(r"/[ru]/[a-zA-Z0-9_-]+")
TOKEN = re.compile(r"[\w']+|[.,!?;:]")
STRAY = re.compile(r"[^0-9a-zA-Z.,!?;:\-']+")
MARKS = frozenset("'-!.?:;,")


def expected(text):
    """(tokens, unigrams with empty ones, bag) of a text."""
    body = MENTION.sub("", LINK.sub("", text.translate({9: " ", 10: " "})))
    tokens = [STRAY.sub("", m.group()).lower() for m in TOKEN.finditer(body)]
    uni = [t for t in tokens if t not in MARKS or t == ""]
    bi = ["_".join(pair) for pair in zip(uni, uni[1:])]
    tri = ["_".join(three) for three in zip(uni, uni[1:], uni[2:])]
    return tokens, uni, [t for t in uni if t] + bi + tri


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, t string")


def column(df, name):
    return [r[name] for r in df.orderBy("i").select(name).collect()]


SAMPLES = [
    "",
    " ",
    "é",
    "'",
    "é'",
    "__",
    "one",
    "see [a](http://x.com/p?q=1) mid [b](https://y.org/z). end /r/pol",
    "é a__b x² don't -- a-b c.d!?",
    "tab\tnew\nline\rreturn\x0bvt sep nbsp",
    "[x](http:// ) [y](https://é) [z](http://!!!)",
    "[a](http://b.c/d)) (e) [f] (g)",
    "www.a .b .c) www.ab .c) www.a .b .c www.é  .x .yz)",
    "/u/me_1-x /r//u/ a/r/b /s /R/x",
    "日本語 テスト 🎉 é ½ Ⅷ ＡＢ",
    "İstanbul ẞ ǅ K",
    "a" * 5000 + " " + "b." * 3000,
    "[" * 300 + "](http://x.y",
    "www." + "a ." * 4000 + ")",
]


def test_samples_match_python(spark):
    rows = with_ngram_bag(frame(spark, SAMPLES), "t", "bag")
    assert column(rows, "bag") == [expected(t)[2] for t in SAMPLES]


def test_sanitized_matches_python(spark):
    got = column(with_sanitized(frame(spark, SAMPLES), "t", "s"), "s")
    for text, s in zip(SAMPLES, got):
        tokens, uni, _ = expected(text)
        assert s.parsed == " ".join(tokens)
        assert s.unigrams == " ".join(uni)
        assert s.bigrams == " ".join("_".join(p) for p in zip(uni, uni[1:]))
        assert s.trigrams == " ".join("_".join(p) for p in zip(uni, uni[1:], uni[2:]))


def test_steps_one_by_one(spark):
    df = frame(spark, SAMPLES)
    raw = [TOKEN.findall(t) for t in SAMPLES]
    assert column(df.withColumn("x", X.tokenize("t")), "x") == raw
    assert column(df.withColumn("x", X.clean_tokens(X.tokenize("t"))), "x") == [
        [STRAY.sub("", t) for t in tokens] for tokens in raw
    ]
    assert column(df.withColumn("x", X.strip_links("t")), "x") == [
        LINK.sub("", t) for t in SAMPLES
    ]
    assert column(df.withColumn("x", X.strip_mentions("t")), "x") == [
        MENTION.sub("", t) for t in SAMPLES
    ]
    assert column(df.withColumn("x", X.normalize_ws("t")), "x") == [
        t.replace("\t", " ").replace("\n", " ") for t in SAMPLES
    ]


def test_clean_tokens_on_any_string(spark):
    every = ["".join(map(chr, range(1, 256))), "a-b--c", "x y\tz"]
    df = spark.createDataFrame([(0, every)], "i int, x array<string>")
    got = column(df.withColumn("x", X.clean_tokens("x")), "x")[0]
    assert got == [STRAY.sub("", t) for t in every]


def test_documented_rows(spark):
    texts = [
        "see [a](http://x.com/p?q=1) mid [b](https://y.org/z). end /r/pol",
        "é a__b x² don't -- a-b c.d!?",
    ]
    first, second = column(with_ngram_bag(frame(spark, texts), "t", "bag"), "bag")
    assert first == ["see", "end", "see_end"]
    assert second[:7] == ["ab", "x", "don't", "a", "b", "c", "d"]
    assert second[7:14] == ["_ab", "ab_x", "x_don't", "don't_a", "a_b", "b_c", "c_d"]


def test_null_text_stays_null(spark):
    df = frame(spark, [None, "a b"])
    assert column(with_ngram_bag(df, "t", "x"), "x") == [None, ["a", "b", "a_b"]]
    assert column(with_sanitized(df, "t", "x"), "x")[0] is None
    for step in (X.normalize_ws, X.strip_links, X.strip_mentions, X.tokenize):
        assert column(df.withColumn("x", step("t")), "x")[0] is None


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10])
def test_ngrams_of_any_length(spark, n):
    lists = [[f"t{i}" for i in range(k)] for k in range(13)] + [["", "a", ""]]
    df = spark.createDataFrame(list(enumerate(lists)), "i int, tokens array<string>")
    out = with_ngrams(df, "tokens", n, "g")
    assert out.columns == ["i", "tokens", "g"]
    assert column(out, "g") == [
        ["_".join(x[k : k + n]) for k in range(len(x) - n + 1)] for x in lists
    ]


def test_ngrams_reject_bad_length(spark):
    with pytest.raises(ValueError):
        with_ngrams(spark.range(1), "id", 0, "g")


PIECES = st.sampled_from(
    ["[a](http://x.y/z)", "](https://", "www.", "www.a .b .)", "/r/", "/u/me", "--", "_", "'"]
)
# Characters every Unicode version in use agrees on; newer letters depend on the runtime's tables.
CHARACTERS = st.sampled_from(
    [chr(c) for c in range(1, 0x3000) if unicodedata.ucd_3_2_0.category(chr(c)) not in ("Cn", "Cs")]
)
TEXTS = st.lists(
    st.one_of(PIECES, st.text(st.sampled_from("aB0 _'.,!?;:-\t\n\r[]()/é½²"), max_size=8),
              st.text(CHARACTERS, max_size=6)),
    max_size=12,
).map("".join)


@settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=list(HealthCheck),
    derandomize=True,
    phases=[Phase.generate],
)
@given(st.lists(TEXTS, min_size=60, max_size=120))
def test_random_texts_match_python(spark, texts):
    register_functions(spark)
    df = frame(spark, texts)
    bags = [expected(t)[2] for t in texts]
    assert column(with_ngram_bag(df, "t", "bag"), "bag") == bags
    parsed = column(with_sanitized(df, "t", "s").select("i", "s.parsed"), "parsed")
    assert parsed == [" ".join(expected(t)[0]) for t in texts]
    assert column(df.withColumn("bag", F.call_function("sanitize", "t")), "bag") == bags
    parts = df.withColumn("s", F.expr("sanitize_parts(t)"))
    assert column(parts, "s") == column(with_sanitized(df, "t", "s"), "s")


def test_sql_functions(spark):
    register_functions(spark)
    row = spark.sql(
        """SELECT sanitize('It''s "fine", isn''t it?') AS bag, sanitize(NULL) AS nothing,
                  valid_state('Ohio') AS a, valid_state('ohio') AS b, valid_state(NULL) AS c,
                  first_element(array(0.9D, 0.1D)) AS p"""
    ).first()
    assert row.bag == expected("It's \"fine\", isn't it?")[2]
    assert (row.nothing, row.a, row.b, row.c) == (None, True, False, False)
    assert row.p == pytest.approx(0.1)
    row = spark.sql("SELECT sanitize_parts(NULL) AS nothing, sanitize_parts('A, b c') AS s").first()
    assert row.nothing is None
    assert tuple(row.s) == ("a , b c", "a b c", "a_b b_c", "a_b_c")
    for n in (1, 2, 3, 4):
        row = spark.sql(f"SELECT ngrams(array('a', 'b', 'c'), {n}) AS g").first()
        assert row.g == ["_".join("abc"[k : k + n]) for k in range(3 - n + 1)]
