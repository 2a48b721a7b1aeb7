"""Operators on documents, against brute force and on awkward rows."""

import random
import re
import textwrap
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from tests.llm import plain
from tonetide.llm import contamination, jaccard, language, licenses, mixing, repeats, toxicity
from tonetide.llm.queries import QUERIES

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, "
    "name string, component_id long, spans string, copy int"
)


def sentence(n, seed):
    r = random.Random(seed)
    syllables = "ta re mi lo nu ska ber ion"
    return " ".join(
        "".join(r.choice(syllables.split()) for _ in range(r.randint(1, 3))) for _ in range(n)
    )


def awkward_rows():
    a, b, c = sentence(120, 1), sentence(90, 2), sentence(400, 3)
    near = a.split()
    near[60] = "changed"
    texts = [
        (1, a), (2, a.upper()), (3, a), (3, a), (4, " ".join(near)), (5, b + " " + c[:700]),
        (6, c), (6, b), (7, None), (8, ""), (9, " \n\t "), (10, "one"), (11, "One"),
        (12, "two words"), (None, a), (None, None), (13, "the " * 3000), (14, "the " * 500),
        (15, "x" * 300_000), (16, "é ü ß\u2028ñ \u00a0 z " * 30), (17, "123 456 --- !!!"),
        (18, c + "\r\n" + b), (19, sentence(60_000, 4)), (20, "\x0b".join(near)),
    ]
    return [
        (d, t, ("en", "fr", None)[i % 3], ("s1", None, "s2", "é")[i % 4], None, 0.5, "n", 7, "s", 3)
        for i, (d, t) in enumerate(texts)
    ]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("window", [5, 50])
def test_repeats_match_brute_force(awkward, small, window):
    for docs in (awkward, small):
        assert rows(repeats.digest(docs, window)) == plain.repeats_digest(pairs(docs), window)


def test_extended_prefixes_find_the_same(small):
    few, many = (repeats.repeated_spans(small, 20, group_rows=n) for n in (2, 100_000))

    def covered(spans):
        return {(r.doc, r.key, i) for r in spans.collect() for i in range(r.since, r.until)}

    assert covered(few) == covered(many) and covered(few)


def test_long_runs_count_by_their_suffixes(spark, monkeypatch):
    line = "a line that comes again and again in the text\n"
    texts = [(i, line * 300) for i in range(4)] + [(9, sentence(200, 8)), (10, sentence(200, 8))]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    counted = docs.mapInArrow(repeats._paths(50), "h long, n long").groupBy("h").sum("n").collect()
    assert sum(r[1] for r in counted) == sum(len(t.split()) - 49 for _, t in texts)
    assert max(r[1] for r in counted) > 4 * 2900
    want = plain.repeats_digest(texts, 50)
    assert rows(repeats.digest(docs)) == want
    monkeypatch.setattr(repeats, "GROUP_ROWS", 1000)
    monkeypatch.setattr(repeats, "RUN_SUFFIXES", 700)
    monkeypatch.setattr(repeats, "SLICE_SUFFIXES", 900)
    hot = repeats.repeated_spans(docs, 50, group_rows=1000)
    spans = [(r.doc, r.since, r.until) for r in hot.collect()]
    assert {(d, i) for d, a, b in spans for i in range(a, b)} == {
        (d, i) for d in (1, 2, 3) for i in range(3000)
    } | {(10, i) for i in range(200)}


def test_texts_without_repeats_stay_as_they_are(awkward):
    out = repeats.remove_repeats(awkward, 50)
    assert out.columns == awkward.columns
    got = {(r.doc_id, r.text) for r in out.collect()}
    assert (1, awkward_rows()[0][1]) in got and (9, " \n\t ") in got and (7, None) in got
    assert not [1 for d, t in got if d == 3]  # nothing of it is left
    assert repeats.remove_repeats(awkward, 50).count() == len(
        [1 for (_, t), (w, k) in zip(pairs(awkward), plain.kept_words(pairs(awkward), 50)) if k or not w]
    )


def test_jaccard_matches_brute_force(awkward, small):
    for docs in (awkward, small):
        want = plain.classes(pairs(docs))
        assert rows(jaccard.classes(docs)) == want
        small_parts = dict(bucket_tokens=500, block_tokens=200, frequent_share=0.02)
        assert rows(jaccard.classes(docs, **small_parts)) == want


def test_jaccard_links_chains_and_large_groups(spark):
    base = sentence(200, 9).split()
    texts = []
    for i in range(120):  # neighbours are similar, ends are not
        w = list(base)
        for j in range(i):
            w[j] = f"new{j}"
        texts.append((i, " ".join(w)))
    texts += [(1000 + i, sentence(100, 50)) for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    got = rows(jaccard.classes(docs, block_tokens=3000))
    assert got == plain.classes(texts) and len({k[2] for k in got}) == 2


def test_one_of_each_group_stays(awkward):
    out = jaccard.one_of_each(awkward)
    assert out.columns == awkward.columns
    got = Counter((r.doc_id, r.text) for r in out.collect())
    docs = pairs(awkward)
    sets, comp = plain.groups(docs)
    kept = Counter()
    for c in set(comp):
        members = [d for d, x, s in zip(docs, comp, sets) if x == c and s]
        if members:
            kept[min(members, key=lambda d: (d[0] is None, d[0] or 0))[0]] += 1
    kept.update(d for (d, _), s in zip(docs, sets) if not s)
    assert Counter(d for d, _ in got.elements()) == kept


def test_mix_matches_brute_force(awkward, small):
    for docs in (awkward, small):
        table = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
        target, sizes, copies = plain.copies(table)
        want = Counter()
        for (d, t, s), n in zip(table, copies):
            want[d, len(plain.words(t)), sizes[s], round(target[s], 6), n * len(plain.words(t))] += 1
        got = mixing.plan(docs).select("doc_id", "size", "source_size", "target", "taken")
        assert Counter((*k[:3], round(k[3], 6), k[4]) for k in rows(got).elements()) == want
        emitted = Counter(r.doc_id for r in mixing.mix(docs).collect())
        wanted = Counter()
        for (d, _, _), n in zip(table, copies):
            wanted[d] += n
        assert emitted == +wanted


def test_mix_comes_near_its_targets(spark):
    docs = spark.range(20_000).selectExpr(
        "id AS doc_id", "repeat('w ', int(5 + id % 50)) AS text", "concat('s', int(sqrt(id / 100))) AS source"
    )
    got = mixing.plan(docs).groupBy("source_size", "target").sum("taken").collect()
    for size, target, taken in got:
        assert taken <= 2 * size
        assert abs(taken - target) <= 0.1 * target + 500


def test_rows_with_one_id_draw_each_for_themselves(spark, monkeypatch):
    equal = [(None, "w " * 4, "s")] * 400 + [(5, "w " * 4, "s")] * 300
    other = [(6, f"w{i} b c d", "s") for i in range(300)]
    small = [(i, "a b c", "t") for i in range(20)]
    docs = spark.createDataFrame(equal + other + small, "doc_id long, text string, source string").repartition(4)
    table = [tuple(r) for r in docs.collect()]
    want = Counter()
    for (d, _, s), n in zip(table, plain.copies(table)[2]):
        want[d, s] += n
    emitted = Counter((r.doc_id, r.source) for r in mixing.mix(docs).collect())
    assert emitted == +want
    monkeypatch.setattr(mixing, "MOST_EQUAL", 100)
    for taken in (mixing.plan(docs).collect(), mixing.plan(docs).collect()):
        big = [r for r in taken if r.source_size == 4000]
        assert len(big) == 1000 and abs(sum(r.taken for r in big) - big[0].target) < 0.1 * big[0].target


def test_language_is_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = QUERIES["op10_language_id"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(truth)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    apart = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in apart) / len(apart) > 0.97


def test_language_of_awkward_rows(awkward, empty):
    profiles = language.fit(awkward)
    got = language.identify(awkward, profiles, score="score")
    assert got.columns == [c for c in awkward.columns if c != "score"] + ["lang_pred", "score"]
    found = {(r.doc_id, r.text): r for r in got.collect()}
    letterless = [k for k in found if not any(c.isalpha() for c in k[1] or "")]
    assert len(letterless) == 5
    for k, r in found.items():
        assert (r.lang_pred == "und") == (k in letterless) and 0 <= r.score <= 1
        assert r.lang_pred in ("en", "fr", "und")
    none = language.fit(empty)
    assert none.languages == []
    assert {r.lang_pred for r in language.identify(awkward, none).collect()} == {"und"}


def test_toxicity_is_learned(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op7_toxicity"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    joined = got.join(labels, "doc_id").where("held_out").collect()
    toxic = [r.predicted for r in joined if r.toxic == 1]
    clean = [r.predicted for r in joined if r.toxic == 0]
    # Some of the labelled texts hold no toxic word at all.
    assert sum(toxic) / len(toxic) > 0.8 and sum(clean) / len(clean) < 0.05
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity.fit(docs, labels)
    calm = [r.doc_id for r in joined if r.toxic == 0 and r.score < 0.1][:50]
    texts = [r.text for r in docs.where(docs.doc_id.isin(calm)).collect() if len(r.text) < 10_000]
    longer = model.score(pa.array([f"{t} " * 1000 for t in texts]))
    assert len(texts) > 20 and (longer < 0.5).all()
    assert (model.score(pa.array([f"{t} " * 100_000 for t in ("a b", "and then")])) < 0.5).all()


def test_toxicity_of_awkward_rows(spark, awkward, empty):
    words = [("you vlork", 1), ("such a fine day", 0), ("such a vlorker", 1), ("you are long", 0)]
    docs = spark.createDataFrame(
        [(i, words[i % 4][0]) for i in range(200)], "doc_id long, text string"
    )
    labels = spark.createDataFrame(
        [(i, words[i % 4][1]) for i in range(200)] + [(None, 1), (1, None), (3, 7)],
        "doc_id long, toxic int",
    )
    model = toxicity.fit(docs, labels)
    probe = spark.createDataFrame([(1, "you vl0rk vlorkk"), (2, "a long day")], "doc_id long, text string")
    by_id = {r.doc_id: r.predicted for r in toxicity.scores(probe, model).collect()}
    assert by_id == {1: 1, 2: 0}
    got = toxicity.scores(awkward, model).collect()
    assert len(got) == awkward.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.doc_id in (7, 8, 9)} == {0.0}
    blank = toxicity.fit(empty, labels.limit(0))
    assert {r.predicted for r in toxicity.scores(awkward, blank).collect()} == {0}


def test_leaks_match_brute_force(spark, small):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")

    def norm(text):
        out = "".join(c if c.isalnum() or ord(c) > 127 else " " for c in plain.lower(text))
        return out.split()

    want = set()
    texts = {d: " " + " ".join(norm(t)) + " " for d, t in pairs(small)}
    for r in items.collect():
        whole = " " + " ".join(norm(r.text)) + " "
        want |= {(d, r.item_id) for d, t in texts.items() if whole in t}
    got = {(r.doc_id, r.item_id) for r in contamination.leaks(small, items).collect()}
    assert want and got == want
    cut = {(r.doc_id, r.item_id) for r in contamination.leaks(small, items, 100).collect()}
    assert cut == want
    clean = contamination.without_leaks(small, items, 100)
    assert {r.doc_id for r in clean.collect()} == set(texts) - {d for d, _ in want}


def test_leaks_tolerate_changed_words(spark, awkward, empty):
    item = sentence(40, 77).split()
    changed = list(item)
    for i in range(3, 40, 7):
        changed[i] = "other"
    half = sentence(30, 5).split() + item[:20] + sentence(30, 6).split()
    few = sentence(30, 7).split() + item[:6] + sentence(30, 8).split()
    docs = spark.createDataFrame(
        [(1, " ".join(changed).upper()), (2, " ".join(half)), (3, " ".join(few)), (4, None)],
        "doc_id long, text string",
    )
    items = spark.createDataFrame(
        [(9, " ".join(item)), (10, "short item"), (None, None), (11, "")],
        "item_id long, text string",
    )
    got = {r.doc_id: r for r in contamination.leaks(docs, items).collect()}
    assert set(got) == {1, 2}
    # The last word alone does not outweigh the changed one before it.
    assert got[1].equal == 33 and got[2].start == 30 and got[2].words == 20
    assert contamination.leaks(awkward, items).count() == 0
    assert contamination.without_leaks(awkward, items).count() == awkward.count()
    assert contamination.leaks(empty, items).count() == 0
    assert contamination.leaks(awkward, items.limit(0)).count() == 0


def test_licenses_are_found(spark, awkward, empty):
    known = [(f, t) for f, texts in licenses.TEXTS.items() for t in texts]
    prose = [sentence(12, i) for i in range(50)]
    lines = [x for i, (_, t) in enumerate(known) for x in (prose[i % 50], t)]
    docs = spark.createDataFrame(
        [(1, "\n".join(lines)), (2, "\n".join(prose)), (3, None), (4, ""), (None, known[0][1]),
         (5, "the license to sing was a permission he never used")],
        "doc_id long, text string",
    )
    corpus = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    scanner = licenses.fit(corpus)
    got = licenses.scan(docs, scanner).collect()
    assert {(r.paragraph, r.family) for r in got if r.doc_id == 1} >= {
        (2 * i + 1, f) for i, (f, _) in enumerate(known)
    }
    assert {r.doc_id for r in got} == {1, None}
    assert licenses.scan(awkward, scanner).count() == 0
    assert licenses.scan(empty, scanner).count() == 0
    assert licenses.fit(empty).families[-1] == "unknown"


def covering_windows(text, coverage):
    """(start, words) of windows that hold most words of a known text, by trying every start."""
    words = [w for w in re.split(r"[\W_]+", plain.lower(text)) if w]
    found = set()
    for known in (t for texts in licenses.TEXTS.values() for t in texts):
        own = licenses._plain(known)
        for start in range(-len(own) + 1, len(words)):
            window = words[max(start, 0) : start + len(own)]
            if len(set(own) & set(window)) < coverage * len(set(own)):
                continue
            anchors = set(licenses._anchors_of(known, coverage))
            if any(0 <= start + i < len(words) and w in anchors and words[start + i] == w for i, w in enumerate(own)):
                found.add((max(start, 0), tuple(window)))
    return found


def test_license_windows_match_brute_force(spark):
    known = [t for texts in licenses.TEXTS.values() for t in texts]
    texts = [f"{sentence(i % 9, i)} {t} {sentence(5, -i)}\n{known[i - 1]}" for i, t in enumerate(known)]
    texts += [t.split(" ", 2)[-1] for t in known] + ["", "rights", sentence(50, 3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = docs.withColumn("w", licenses.words(docs.text))
    got = docs.select("doc_id", licenses._windows("w", licenses.COVERAGE).alias("found")).collect()
    for r in got:
        found = [(x.start, tuple(x.words)) for x in r.found]
        assert len(found) == len(set(found))
        assert set(found) == covering_windows(texts[r.doc_id], licenses.COVERAGE)


def test_wrapped_and_embedded_licenses_are_found(spark):
    corpus = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    scanner = licenses.fit(corpus)
    prose = " ".join(r.text for r in corpus.where("lang = 'en'").orderBy("doc_id").limit(40).collect()).split()
    assert len(prose) > 4000
    known = [(f, t) for f, texts in licenses.TEXTS.items() for t in texts]
    before, long = " ".join(prose[:300]), " ".join(prose[:2000])
    shapes = {
        "alone": lambda t: t,
        "wrapped": lambda t: textwrap.fill(t, 72),
        "wrapped inside": lambda t: f"{before}\n\n" + textwrap.fill(f"Note. {t} {before}", 72),
        "behind": lambda t: f"{before} {t}",
        "inside": lambda t: f"{long} {t} {long}",
        "paragraphs": lambda t: f"{before}\n\n{t}\n\n{before}",
    }
    rows = [(i, n, shape(t)) for i, (_, t) in enumerate(known) for n, shape in shapes.items()]
    rows += [(-1, "none", " ".join(prose[:4000])), (-1, "none", textwrap.fill(" ".join(prose[:4000]), 72))]
    docs = spark.createDataFrame(rows, "i long, shape string, text string")
    docs = docs.selectExpr("struct(i, shape) AS doc_id", "text", "1 AS words", "2 AS license").repartition(8)
    found = {}
    for r in licenses.scan(docs, scanner).collect():
        found.setdefault(tuple(r.doc_id), set()).add(r.family)
    missed = [(i, n) for i, n, _ in rows if i >= 0 and known[i][0] not in found.get((i, n), ())]
    assert missed == [] and (-1, "none") not in found


def test_every_anchor_rule_is_exact():
    anchors = set(licenses._anchors(licenses.COVERAGE))
    for texts in licenses.TEXTS.values():
        for text in texts:
            own = set(licenses._plain(text))
            assert len(own - anchors) < licenses.COVERAGE * len(own)


@pytest.mark.parametrize(
    "run",
    [repeats.digest, repeats.remove_repeats, jaccard.classes, jaccard.one_of_each, mixing.plan, mixing.mix],
)
def test_empty_tables(empty, run):
    assert run(empty).count() == 0
