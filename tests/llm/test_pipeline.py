"""The pipeline against a brute-force version, and what the driver calls."""

from collections import Counter

import pytest

import __spark_entry__
import corpus_pipeline
from tests.llm import plain
from tests.llm.test_documents import SCHEMA, awkward_rows
from tonetide.llm.shared import stored

SF = "/root/testdata/sf0.001"


def brute_force(docs, items):
    """Rows (id, text, lang, source, n_chars) to the rows of the mix, with their copy."""
    docs = [d for d in docs if any(c.isalpha() for c in d[1] or "")]
    sets, comp = plain.groups([d[:2] for d in docs])
    first = {}
    for i, (d, c) in enumerate(zip(docs, comp)):
        if sets[i]:
            key = (d[0] is None, d[0] or 0)
            if c not in first or key < first[c][0]:
                first[c] = (key, i)
    stay = {i for _, i in first.values()} | {i for i, s in enumerate(sets) if not s}
    docs = [d for i, d in enumerate(docs) if i in stay]
    cut = []
    for d, (w, kept) in zip(docs, plain.kept_words([d[:2] for d in docs], 50)):
        if len(kept) < len(w):
            if not kept:
                continue
            text = " ".join(kept)
            d = (d[0], text, d[2], d[3], len(text))
        cut.append(d)

    def normal(text):
        return " ".join(
            "".join(c if c.isalnum() or ord(c) > 127 else " " for c in plain.lower(text)).split()
        )

    known = [f" {normal(t)} " for t in items]
    clean = [d for d in cut if not any(k in f" {normal(d[1])} " for k in known)]
    _, _, copies = plain.copies([(d[0], d[1], d[3]) for d in clean])
    return Counter((*d, c + 1) for d, n in zip(clean, copies) for c in range(n))


def test_pipeline_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    out = __spark_entry__.queries()["pipeline"](spark, SF)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy"]
    got = Counter(tuple(r) for r in out.collect())
    want = brute_force(docs, items)
    assert want and got == want


@pytest.mark.parametrize("rows", [awkward_rows(), []])
def test_stages_keep_the_columns_of_documents(spark, rows):
    docs = stored(spark.createDataFrame(rows, SCHEMA).repartition(2))
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF))
        columns = [c for c in SCHEMA.replace(",", "").split()[::2]]
        if name == corpus_pipeline.STAGES[-1][0]:
            assert sorted(out.columns) == sorted(columns)  # copy is numbered anew
        else:
            assert out.columns == columns
            docs = out
    assert (docs.count() > 0) == bool(rows)


@pytest.mark.parametrize("label", [None, "und", "xx"])
def test_labels_alone_reject_nothing(spark, label):
    rows = [(i, f"clean text number {i} of some words", label, "s", 30) for i in range(20)]
    rows += [(20, "123 456 !", label, "s", 9), (21, None, label, "s", 0), (22, "漢字", label, "s", 2)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    kept = corpus_pipeline.known_language(spark, docs, SF)
    assert sorted(r.doc_id for r in kept.collect()) == [*range(20), 22]


def test_every_operator_has_a_query():
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names
