"""Operators on pages and vectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tonetide.llm import html, topk, urls


def test_topk_matches_brute_force(spark):
    random = np.random.default_rng(3)
    vectors = [(i, [float(x) for x in random.normal(0, 1, 12)]) for i in range(400)]
    vectors += [(400 + i, vectors[50][1]) for i in range(30)]  # ties
    vectors += [(440, vectors[0][1]), (440, vectors[1][1])]  # a repeated id
    vectors += [(500, None), (501, [1.0, None] * 6), (502, [math.nan] * 12), (503, [math.inf] * 12)]
    vectors += [(None, vectors[3][1]), (550, [0.5] * 3), (551, [0.25] * 3), (600, []), (650, [1e9] * 12)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(5)
    usable = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in vectors
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    want = set()
    for q, v in usable:
        if q % 50 == 0:
            scored = sorted(
                (-sum(a * b for a, b in zip(v, w)), i)
                for i, w in usable
                if i != q and len(w) == len(v)
            )[:5]
            want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)}
    df = df.withColumn("score", F.lit("clash")).withColumn("rank", F.lit(0))
    got = topk.search(df, F.col("vec_id") % 50 == 0, k=5).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_topk_of_ids_with_different_vectors(spark):
    random = np.random.default_rng(5)
    vectors = [(0, [1.0] * 4), (7, [100.0, 0, 0, 0]), (7, [0, 100.0, 0, 0]), (8, [90.0, 60.0, 0, 0])]
    vectors = [(i, [float(x) for x in v]) for i, v in vectors]
    vectors += [(i % 6 + 1, [float(x) for x in 50 * np.eye(4)[i % 4] + random.integers(0, 9, 4)]) for i in range(60)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(3)
    for k in (1, 5):
        scored = sorted((-int(sum(v)) * 256 * 256, i) for i, v in vectors if i != 0)[:k]
        got = topk.search(df, F.col("vec_id") == 0, k=k).collect()
        assert sorted((r["rank"], r.vec_id, r.score) for r in got) == [
            (n + 1, i, -s) for n, (s, i) in enumerate(scored)
        ]


def test_topk_in_blocks_of_queries(spark, monkeypatch):
    sf = "/root/testdata/sf0.001/embeddings.parquet"
    vectors = spark.read.parquet(sf)
    query = F.col("vec_id") % 20 == 0
    want = {tuple(r) for r in topk.search(vectors, query).collect()}
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    assert {tuple(r) for r in topk.search(vectors, query).collect()} == want
    assert topk.search(vectors.limit(0), query).count() == 0


RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("block", "com/de/"))


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        ("http://A.Example.ORG/en/17?x=/es/", "a.example.org", "/en/17", "example.org/en/1", "block"),
        ("https://example.org/es/1#top", "example.org", "/es/1", "example.org/es/", "block"),
        ("https://notexample.org/es/1", "notexample.org", "/es/1", "org/", "allow"),
        ("x://org", "org", "", None, "allow"),
        ("x://ÀB.com?q/de/", "Àb.com", "", None, "allow"),
        ("ftp://b.com/de/://c.org/", "b.com", "/de/://c.org/", "com/de/", "block"),
        ("no scheme.org/", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ],
)
def test_urls_are_judged(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, "h", "p")], "page_id long, url string, host string, path string")
    none = spark.createDataFrame([], "tokens array<string>, confidence double, anchor string")
    r = urls.judge(pages, none, RULES).first()
    assert (r.page_id, r.host, r.path, r.rule, r.verdict) == (1, host, path, rule, verdict)


def test_mined_rules_match_brute_force(spark):
    def url(i):
        spam = i % 4 == 0
        return f"http://h{i % 7}.example.net/{'win/casino' if spam else 'news'}/{i}?{'ref' if i % 3 else 'page'}=1"

    rows = [(url(i), i % 4 == 0) for i in range(600)] + [(None, True), ("http://a/b", None)]
    labelled = spark.createDataFrame(rows, "url string, bad boolean")
    mined = urls.mine(labelled, min_support=0.02)
    rules = [(set(r.tokens), r.confidence) for r in mined.collect()]
    assert {frozenset(t) for t, _ in rules} == {frozenset({"path:win"}), frozenset({"path:casino"})}
    pages = spark.createDataFrame(
        [(i, url(i)) for i in range(50)] * 2 + [(None, None)], "page_id long, url string"
    )
    seen = pages.select("page_id", "url", urls.tokens(F.col("url")).alias("t")).collect()
    want = sorted(
        (str(r.page_id), "block" if any(x <= set(r.t) for x, _ in rules) else "allow") for r in seen
    )
    got = urls.judge(pages, mined).collect()
    assert sorted((str(r.page_id), r.verdict) for r in got) == want
    assert urls.mine(labelled.limit(0)).count() == 0


@pytest.mark.parametrize("good, bad", [(9, 11), (4, 16), (0, 20)])
def test_rules_are_mined_from_mostly_bad_labels(spark, good, bad):
    def rows(host, n, is_bad):
        return [(f"http://{host}.net/x", is_bad)] * (10 * n)

    labelled = rows("fine", good, False) + rows("worst", bad - 3, True) + rows("mixed", 3, True)
    labelled += rows("mixed", good // 3, False)
    mined = urls.mine(spark.createDataFrame(labelled, "url string, bad boolean"))
    blocked = {t for r in mined.collect() for t in r.tokens}
    assert "host:worst" in blocked and "host:fine" not in blocked
    assert not good or blocked == {"host:worst"}


def test_longer_rules_need_more_confidence(spark):
    rows = [("http://x.net/a/b", True)] * 40 + [("http://x.net/a/c", False)] * 30 + [("http://y.net/b", False)] * 30
    mined = urls.mine(spark.createDataFrame(rows, "url string, bad boolean"), min_lift=1.2)
    found = {frozenset(r.tokens): r.confidence for r in mined.collect()}
    assert found[frozenset({"path:a", "path:b"})] == 1.0
    assert frozenset({"path:a", "path:b", "host:x"}) not in found


@pytest.mark.parametrize(
    "page, text",
    [
        ("<body><main><h1>A &amp; B</h1><p>one <b>t</b>wo<p>x&nbsp;&eacute;<br>y</main>after", "A & B\none two\nx é y"),
        ("<nav>menu</nav><div class='post'><p>text</p></div><div id=comments><p>c</p></div>", "text"),
        ("<article><p>a</p><aside>s</aside><form>f</form><div class='ad box'>b</div>c</article>", "a\nc"),
        ("<p>1 < 2 & 3</p><script>if (a < b) '</p>'</script><!-- <p>no</p> --><style>p{}</style>", "1 < 2 & 3"),
        ("<article><header><h1>T</h1></header><p>t<footer>f</footer></article>", "T\nt"),
        ("<header>top</header><div>plain<section class=newsletter>n</section></div>", "plain"),
        ("<p hidden>h</p><div style='display: none'>h</div><ul><li>a<li>b</ul>", "a\nb"),
        ("<p title='a > b'>q</p><p class=\"broken>x</p>", "q\nx"),
        ("no tags at all", "no tags at all"),
        ("<script>never closed <p>x", ""),
        ("", ""),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page) == text


def test_pages_of_a_host_share_a_template(spark):
    def page(i):
        return (
            f"<html><body><div class='x'><a href=/>home</a> <a href=/{i}>go {i}</a></div>"
            f"<div class='body'><p>Own text number {i} of this page</p><p>Same line everywhere</p></div></body></html>"
        )

    rows = [(i, "http://a.example/p", page(i), "t", 1) for i in range(30)]
    rows += [(100, None, None, "t", 1), (101, "no", "", "t", 1), (102, "http://b.example/", page(5), "t", 1)]
    rows += [(0, "http://a.example/p", page(0), "t", 1)]
    schema = "page_id long, url string, html string, text string, n_chars int"
    out = html.extract(spark.createDataFrame(rows, schema).repartition(4))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted((r.page_id, r.text, r.n_chars) for r in out.collect())
    want = [(i, f"Own text number {i} of this page") for i in range(30)]
    want += [(0, "Own text number 0 of this page"), (100, ""), (101, "")]
    want += [(102, "home go 5\nOwn text number 5 of this page\nSame line everywhere")]
    assert got == sorted((i, t, len(t)) for i, t in want)
    assert html.extract(spark.createDataFrame([], schema)).count() == 0


def extracted(spark, pages):
    rows = [(i, "http://a.example/p", p) for i, p in enumerate(pages)]
    out = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3))
    return {r.page_id: r.text for r in out.collect()}


def test_classes_name_templates_of_any_share(spark):
    def first(i):
        return f"<body><div class='a/b'><p>First line</p></div><div class='x'><p>Own text {i} here</p></div></body>"

    def second(i):
        return f"<body><div class='y'><p>Own text {i} there</p><div><p>Second line</p></div></div></body>"

    got = extracted(spark, [(first, second)[i % 2](i) for i in range(24)])
    assert got == {i: f"Own text {i} {('here', 'there')[i % 2]}" for i in range(24)}
    got = extracted(spark, [first(i) for i in range(9)])
    assert got == {i: f"Own text {i} here" for i in range(9)}
    inside = [f"<main><p>Share this</p><p>Own text of page {'abcdef'[i]}</p></main>" for i in range(6)]
    assert extracted(spark, inside) == {i: f"Own text of page {'abcdef'[i]}" for i in range(6)}


def test_copies_are_no_template(spark):
    def page(text, more=""):
        return f"<body><main><h1>{text} title</h1><p>{text} body</p>{more}</main></body>"

    table = "<table><tr><td>Cell</td></tr></table>"
    pages = [page(f"Number {'abcdefgh'[i]}") for i in range(8)] + [page("Copied", table)] * 3
    got = extracted(spark, pages)
    assert {got[i] for i in (8, 9, 10)} == {"Copied title\nCopied body\nCell"}
    long = " ".join(["words"] * 60)
    near = extracted(spark, [page(f"{i} a", f"<p>{long}</p>") for i in range(4)])
    assert all(long in t for t in near.values())


@pytest.mark.parametrize(
    "page, text",
    [
        ("<div class='content has-sidebar'><p>story</p></div>", "story"),
        ("<main class='with-comments'><p>story</p></main><p>other</p>", "story"),
        ("<article class='no-share'><p>story</p></article>", "story"),
        ("<div class='page sidebar'><main><p>long story</p><div class=ad>ad</div></main></div><p>x</p>", "long story"),
        ("<article class='widget'><p>story</p></article>", "story"),
        ("<div class='widget'><p>story</p></div><nav>menu</nav>", "story"),
        ("<article>a</article><article class='ad'>advert of more words</article>", "a"),
        ("<p>story of a day</p><div id=comments><article>c</article></div>", "story of a day"),
        ("<main></main><div class='comments'>c</div>", ""),
        ("<div class='site-header'>h</div><p>story</p><div class='ad-slot-1'>a</div>", "story"),
    ],
)
def test_names_of_wrappers_leave_out_no_main_text(page, text):
    assert html.main_text(page) == text
