"""Toxicity with subword bags.

A word is the bag of its character n-grams and itself, each with an embedding found by hash. The
embeddings of a passage of two neighbouring words are averaged (by word, then over both) and go through a
linear softmax. In training, a text is as toxic as the chance that any of its passages is; a score
takes the ``STRONGEST`` passages only, so that it does not grow with a text's length. Embeddings and
softmax are trained jointly in numpy, from text-level labels only. An unseen misspelling shares most n-grams
with the word it hides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonetide.llm import words as W
from tonetide.llm.shared import bounded_sample, held_out, stored

BUCKETS = 1 << 18
DIMENSIONS = 16
GRAMS = (3, 4, 5)
STRONGEST = 4
SAMPLE_PER_LABEL = 1000
STEPS = 60
TOXIC_WEIGHT = 0.5  # share of all toxic texts in the loss
RATE = 0.1
DECAY = 1e-2
_OWN = np.uint64(0x51ED27F5)


def _bags(text: W.Words, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every subword of the chosen words, and how many each word has."""
    start, end = text.starts[chosen], text.ends[chosen]
    data = text.data.astype(np.uint64)
    own = W.run_hashes(data + np.uint64(1), start, end, _OWN)
    parts, counts = [own], [np.ones(len(chosen), dtype=np.int64)]
    for n in GRAMS:
        many = np.maximum(end - start - n + 1, 0)
        at = W.ranges(start, many)
        value = np.full(len(at), n, dtype=np.uint64)
        for i in range(n):
            value = (value << np.uint64(8)) | data[at + i]
        parts.append(W.mixed(value))
        counts.append(many)
    # Put the parts of each word side by side.
    total = sum(counts)
    first = np.cumsum(total) - total
    out = np.zeros(int(total.sum()), dtype=np.int32)
    for part, many in zip(parts, counts):
        out[W.ranges(first, many)] = part & np.uint64(BUCKETS - 1)
        first = first + many
    return out, total


@dataclass
class Features:
    """Distinct words as bags, and passages: every two words side by side, or a text's only one."""

    bags: np.ndarray
    sizes: np.ndarray  # subwords of each distinct word
    heads: np.ndarray  # distinct word that each passage begins with
    tails: np.ndarray  # and ends with
    row: np.ndarray  # text of each passage
    rows: int


def features(column: pa.Array) -> Features:
    text = W.split(pc.utf8_lower(W.valid(column)))
    _, chosen, word = np.unique(text.hashes(), return_index=True, return_inverse=True)
    bags, sizes = _bags(text, chosen)
    many = np.where(text.counts > 1, text.counts - 1, text.counts)
    row = np.repeat(np.arange(len(column)), many)
    heads = text.first[row] + W.ranges(np.zeros(len(many), np.int64), many)
    tails = np.minimum(heads + 1, text.first[row + 1] - 1)
    return Features(bags, sizes, word[heads], word[tails], row, len(column))


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each run of ``counts`` values; every run has one value at least."""
    head = np.cumsum(counts) - counts
    return np.add.reduceat(values, head) if len(head) else np.zeros(0)


def passage_logits(f: Features, subword: np.ndarray, bias: float) -> np.ndarray:
    """Averages are linear: the projections of subwords are averaged instead of their vectors."""
    word = _sums(subword[f.bags].astype(np.float64), f.sizes) / f.sizes
    return (word[f.heads] + word[f.tails]) / 2 + bias


def _chances(logits: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text the chance that any passage is toxic, and each passage's own."""
    logits = np.clip(logits, -30, 30)
    missed = np.bincount(row, weights=np.logaddexp(0, logits), minlength=rows)
    return -np.expm1(-missed), 1 / (1 + np.exp(-logits))


def _strongest(logits: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Places of the ``STRONGEST`` passages of each text; all, if there are fewer."""
    order = np.lexsort((-logits, row))
    ordered = row[order]
    place = np.arange(len(row)) - np.searchsorted(ordered, ordered)
    return order[place < STRONGEST]


@dataclass(frozen=True)
class Model:
    subword: np.ndarray  # embedding of each bucket, projected on toxic minus clean
    bias: float

    def score(self, column: pa.Array) -> np.ndarray:
        f = features(column)
        if not len(f.row):
            return np.zeros(f.rows)
        logits = passage_logits(f, self.subword, self.bias)
        strong = _strongest(logits, f.row)
        return _chances(logits[strong], f.row[strong], f.rows)[0].clip(0, 1)


def train(texts: list[Features], labels: np.ndarray) -> Model:
    """Fit embeddings and softmax jointly by Adam over all texts at once; always the same result.

    Without an example of both labels there is nothing to tell apart, and every text scores 0.
    """
    if len(np.unique(labels)) < 2:
        return Model(np.zeros(BUCKETS, dtype=np.float32), -30.0)
    random = np.random.default_rng(7)
    embed = random.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    softmax = random.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.array([0.0, -4.0], dtype=np.float32)
    used = np.unique(np.concatenate([f.bags for f in texts] or [np.zeros(0, np.int32)]))
    place = np.zeros(BUCKETS, dtype=np.int64)
    place[used] = np.arange(len(used))
    local = [place[f.bags] for f in texts]
    embed_used = embed[used]
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (embed_used, softmax, bias)]
    first = np.cumsum([0, *[f.rows for f in texts]])
    toxic = (labels == 1).sum()
    share = np.where(
        labels == 1, TOXIC_WEIGHT / max(1, toxic), (1 - TOXIC_WEIGHT) / max(1, len(labels) - toxic)
    )
    weight = share * len(labels)
    for step in range(1, STEPS + 1):
        direction = softmax[:, 1] - softmax[:, 0]
        subword = embed_used @ direction
        pull = np.zeros(len(used))
        pull_bias = 0.0
        for f, bags, a, b in zip(texts, local, first, first[1:]):
            if not len(f.row):
                continue
            word = _sums(subword[bags].astype(np.float64), f.sizes) / f.sizes
            logits = (word[f.heads] + word[f.tails]) / 2 + float(bias[1] - bias[0])
            chance, own = _chances(logits, f.row, f.rows)
            toxic = labels[a:b] == 1
            outer = np.where(toxic, -(1 - chance) / np.maximum(chance, 1e-12), 1.0)
            outer *= weight[a:b]
            slope = own * outer[f.row]
            pull_bias += slope.sum()
            of_word = sum(
                np.bincount(w, weights=slope / 2, minlength=len(f.sizes)) for w in (f.heads, f.tails)
            )
            of_bag = np.repeat(of_word / f.sizes, f.sizes)
            pull += np.bincount(bags, weights=of_bag, minlength=len(used))
        g_embed = np.outer(pull, direction).astype(np.float32) + DECAY * embed_used
        g_dir = (pull @ embed_used).astype(np.float32)
        g_soft = np.stack((-g_dir, g_dir), axis=1)
        g_bias = np.array([-pull_bias, pull_bias], dtype=np.float32)
        for p, g, (m, v) in zip((embed_used, softmax, bias), (g_embed, g_soft, g_bias), state):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    out = np.zeros(BUCKETS, dtype=np.float32)
    out[used] = embed_used @ (softmax[:, 1] - softmax[:, 0])
    return Model(out, float(bias[1] - bias[0]))


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts, labels = [], [np.zeros(0)]
    for batch in batches:
        for piece in W.chunks([batch]):
            texts.append(features(piece.column("text")))
            labels.append(piece.column("toxic").to_numpy())
    model = train(texts, np.concatenate(labels))
    yield pa.RecordBatch.from_pydict(
        {"subword": [model.subword.tobytes()], "bias": [float(model.bias)]}
    )


def fit(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> Model:
    """Learn from at most about ``per_label`` toxic and as many clean documents.

    Held-out documents, null labels and null ids are left out; a document with contradicting labels
    counts as toxic. The sample is bounded, so one task trains on it, in order of id; the model it
    returns has a fixed size.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    sample = stored(bounded_sample(known, "doc_id", F.col("toxic"), per_label))
    sample = F.broadcast(sample.withColumnRenamed("doc_id", "__id"))
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text")
    rows = texts.join(sample, F.col("doc_id") == F.col("__id"))
    rows = rows.repartition(1).sortWithinPartitions("doc_id", "text").select("text", "toxic")
    row = rows.mapInArrow(_trained, "subword binary, bias double").first()
    if row is None:
        return train([], np.zeros(0))
    return Model(np.frombuffer(row["subword"], np.float32), row["bias"])


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id score predicted`` for every whole text, in one pass; a text without words has 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            score = shared.value.score(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, score double, predicted int")
