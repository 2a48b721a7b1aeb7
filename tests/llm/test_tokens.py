"""Operators on token ids: alignment of two tokenizers, files of sequences."""

import hashlib
import itertools
import json
import random
import zlib
from bisect import bisect
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tonetide.llm import alignment, encoding, sequences

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
ODD = [*"ab  \t\n.'s1é▁ 　漢字\x1c\u0085🙂-====zq", "<|endoftext|>", "<s>", "the ", "and", "====", "\r\n"]


@lru_cache
def tokenizer(special_text):
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = special_text
    return t


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ODD) | st.characters(exclude_categories=["Cs"]), max_size=40).map("".join), max_size=6))
def test_pieces_encode_like_whole_texts(texts):
    a, b = encoding.byte_bpe(A), encoding.piece_bpe(B)
    pieces, n = encoding.cut(texts)
    (a_ids, a_n), (b_ids, b_n) = encoding.Pieces(a.spaced, b.spaced).encode(pieces)
    model = encoding.piece_bpe(B).model
    whole = tokenizer(True)
    want = [whole.encode(" " + t, add_special_tokens=False).ids for t in texts]
    assert a_ids.tolist() == sum(want, []) and encoding.sums_by(a_n, n).tolist() == [len(x) for x in want]
    if all(texts):
        assert b_ids.tolist() == sum((model.encode(t) for t in texts), [])
    ids, counts = encoding.Texts(encoding.byte_bpe(A, False)).encode(texts)
    want = [tokenizer(False).encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == sum(want, []) and counts.tolist() == [len(x) for x in want]


def test_pieces_are_forgotten(monkeypatch):
    monkeypatch.setattr(encoding, "MEMORY_PIECES", 10)
    known = encoding.Pieces(encoding.byte_bpe(A).spaced)
    for i in range(0, 60, 6):
        words = ["again", *(f"word{j}" for j in range(i, i + 8)), "again"]
        (ids, _), = known.encode(words)
        assert ids.tolist() == tokenizer(True).encode(" " + " ".join(words)).ids
        assert len(known.numbers) <= 19 and known.numbers["again"] == 0


ends = st.lists(st.integers(1, 4), max_size=60).map(lambda x: np.cumsum(np.array(x, np.int64)))


def test_equal_pieces_of_a_call_are_asked_for_once(monkeypatch):
    asked, encode = [], encoding.Pieces.encode
    monkeypatch.setattr(encoding.Pieces, "encode", lambda self, pieces, *uses: asked.append(list(pieces)) or encode(self, pieces, *uses))
    texts = ["b a b a", "", "a  a\n b b a", "b", "a b \u2581 a b"]
    ids, counts = encoding.Texts(encoding.byte_bpe(A, False)).encode(texts)
    want = [tokenizer(False).encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == sum(want, []) and counts.tolist() == [len(w) for w in want]
    assert len(asked) == 2 and all(len(pieces) == len(set(pieces)) for pieces in asked)


@given(ends, ends, st.integers(1, 40))
def test_pieces_of_the_merge_path_find_all_common_ends(a, b, work):
    i, j = alignment.diagonals(a, b, work)
    steps = np.diff(i + j)
    assert (steps <= work).all() and (steps[:-1] == work).all()
    x, y = alignment.common_ends(a, b, work)
    assert a[x].tolist() == b[y].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def brute(docs):
    first, second = tokenizer(True), sentencepiece.SentencePieceProcessor(model_file=B)
    a_bytes, b_bytes = encoding.byte_bpe(A).bytes, encoding.piece_bpe(B).bytes
    rows, counts = [], Counter()
    for doc, text in docs:
        groups = []
        if text:
            a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
            if b"".join(a_bytes[i] for i in a) == (" " + text).encode() == b"".join(b_bytes[i] for i in b):
                a_end = list(itertools.accumulate(len(a_bytes[i]) for i in a))
                b_end = list(itertools.accumulate(len(b_bytes[i]) for i in b))
                at = 0
                for end in sorted({*a_end} & {*b_end}):
                    groups.append([ids[bisect(es, at) : bisect(es, end)] for ids, es in ((a, a_end), (b, b_end))])
                    at = end
        links = [(x, y) for left, right in groups for x in left for y in right]
        counts.update(set(links))
        rows.append((doc, groups, links))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = Counter()
    for doc, groups, links in rows:
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        sizes = [sum(len(g[k]) for g in groups) for k in (0, 1)]
        agreed = sum(counts[x] == best[x[0]] for x in links)
        sha = hashlib.sha256(text.encode()).hexdigest() if text else ""
        out[doc, *sizes, len(groups), len(links), agreed, sum(counts[x] for x in links), sha] += 1
    return out


def odd_documents():
    r = random.Random(2)
    docs = [(i if i % 9 else None, "".join(r.choices(ODD, k=r.randint(0, 60)))) for i in range(150)]
    docs += [(5, None), (5, ""), (7, "=-" * 900), (7, "=-" * 900), (8, "".join(r.choices("=-_.#", k=1500)))]
    return docs + [(9, "a▁b"), (10, "same words here"), (11, "same words here")]


@pytest.mark.parametrize("frequent, pairs", [(1 << 21, 1 << 20), (40, 1 << 20), (0, 50)])
def test_alignment_matches_brute_force(spark, monkeypatch, frequent, pairs):
    docs = odd_documents()
    monkeypatch.setattr(alignment, "PAIRS", pairs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    df = df.withColumn("n_a", F.lit("clash")).withColumn("pair", F.lit(0))
    got = alignment.align(df, A, B, frequent=frequent)
    assert Counter(map(tuple, got.collect())) == brute(docs)
    assert alignment.align(df.limit(0), A, B).count() == 0


def test_alignment_of_the_smallest_table(spark):
    from tonetide.llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(map(tuple, QUERIES["op12_token_alignment"](spark, SF).collect())) == brute(docs)


def test_alignment_of_a_long_text(spark):
    text = "Ein langer Satz über Züge. " * 40_000
    got = alignment.align(spark.createDataFrame([(1, text), (2, "漢字" * 50_000)], "doc_id long, text string"), A, B).collect()
    rows = {r.doc_id: r for r in got}
    assert rows[1].n_a == len(tokenizer(True).encode(" " + text).ids) and rows[1].n_links >= rows[1].n_groups
    assert rows[2].n_b >= 100_000 and rows[2].n_best <= rows[2].n_links


def digested(docs):
    whole, at, out = tokenizer(False), 0, []
    for doc, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = whole.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return sorted(out, key=str)


def documents_by_id():
    r = random.Random(4)
    docs = [(3 * i, "".join(r.choices(ODD, k=r.randint(0, 60)))) for i in range(200)]
    return docs + [(None, "no id"), (-5, None), (9000, ""), (9001, "=-x " * 9000), (9002, "<|endoftext|> in a text")]


@pytest.mark.parametrize("length", [8, 100])
def test_files_give_back_what_was_written(spark, tmp_path, length):
    docs, folder = documents_by_id(), f"{tmp_path}/ids"
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("start", F.lit("clash"))
    shards = sequences.write(df, folder, A, length=length)
    got = sequences.digest(spark, folder)
    assert sorted(map(tuple, got.collect()), key=str) == digested(docs)
    found = sequences.Sequences(spark, folder)
    assert len(found) == sum(s["sequences"] for s in shards)
    ids = [found[i][0][found[i][1].to_numpy(zero_copy_only=False)] for i in range(len(found))]
    want = sum((tokenizer(False).encode(t or "").ids + [2] for _, t in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0))), [])
    assert np.concatenate(ids).tolist() == want
    with pytest.raises(IndexError):
        found[len(found)]


def test_sequences_are_views_of_the_file(spark, tmp_path):
    folder = f"{tmp_path}/ids"
    sequences.write(spark.createDataFrame(documents_by_id(), "doc_id long, text string"), folder, A, length=32)
    found = sequences.Sequences(spark, folder)
    found[70], found[len(found) - 1]
    before = pa.total_allocated_bytes()
    ids, mask = found[70]
    assert pa.total_allocated_bytes() == before
    assert not ids.flags.owndata and not ids.flags.writeable and len(ids) == len(mask) == 32
    # Behind its mark, a file is Arrow's stream format.
    name = json.loads(open(f"{folder}/manifest.json").read())["shards"][0]["ids_file"]
    body = open(f"{folder}/{name}", "rb").read()
    streamed = pa.ipc.open_stream(pa.BufferReader(body[8:])).read_all()
    assert streamed.equals(pa.ipc.open_file(pa.BufferReader(body)).read_all())
    assert {len(b) for b in streamed.to_batches()[:-1]} <= {sequences.BATCH}


def test_equal_ids_and_rows_are_dealt_over_shards(spark, tmp_path):
    folder, docs = f"{tmp_path}/ids", [(1, "one text")] * 300 + [(1, "another")] + [(2, "x")] * 3
    shards = sequences.write(spark.createDataFrame(docs, "doc_id long, text string").repartition(8), folder, A)
    assert sum(s["documents"] for s in shards) == 304 and max(s["documents"] for s in shards) < 150
    got = sequences.digest(spark, folder).collect()
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:])) and starts[0][0] == 0


def test_no_documents_make_no_files(spark, tmp_path):
    folder = f"{tmp_path}/ids"
    assert sequences.write(spark.createDataFrame([], "doc_id long, text string"), folder, A) == []
    assert sequences.digest(spark, folder).collect() == [] and len(sequences.Sequences(spark, folder)) == 0


def test_token_files_of_the_smallest_table(spark):
    from tonetide.llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_token_files"](spark, SF).collect()
    assert sorted(map(tuple, got), key=str) == digested(docs)
