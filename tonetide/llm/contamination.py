"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over a run of words; the words under its zeros are ignored, so a hash of the
others still meets its counterpart if those were changed. Hashes of all masks at every place of
every document are joined with those of the benchmark. Around each hit, item and document are laid
side by side, and the stretch with the best balance of equal and changed words decides.

Words are runs of letters and digits, A-Z lower-cased. The benchmark goes to the tasks in blocks of
bounded size, one pass over the documents for each: no document is shuffled or grouped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonetide.llm import words as W

# Masks over 8 to 12 words, six of them counted.
MASKS = ("11101011", "1101100101", "110010100011")
BLOCK_WORDS = 1 << 19
CHANGED = 2  # an unequal word outweighs so many equal ones
# A stretch counts with so many equal words, or with fewer if it is most of a short item.
MIN_EQUAL = 12
SHORT_EQUAL = 8
SHORT_SHARE = 0.8
_HITS = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FILTER = 1 << 22


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    text = W.split(column, lower=True, between=W.MARKS)
    return text.hashes(), text.first


def _seeds(words: np.ndarray, first: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the counted words from every place where the mask fits, and the places."""
    at = W.gram_starts(first, len(mask))
    value = np.zeros(len(at), dtype=np.uint64)
    for i, counted in enumerate(mask):
        if counted == "1":
            value = value * _BASE + words[at + i]
    return W.mixed(value), at


@dataclass(frozen=True)
class Block:
    """Items of a benchmark: their words, and the seeds of each mask in order of hash."""

    ids: list
    words: np.ndarray
    first: np.ndarray
    seeds: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # hash, place, filter

    @classmethod
    def of(cls, ids: list, texts: list) -> Block:
        words, first = _words(W.valid(pa.array(texts, pa.string())))
        seeds = []
        for mask in MASKS:
            value, at = _seeds(words, first, mask)
            order = np.argsort(value, kind="stable")
            present = np.zeros(_FILTER, dtype=bool)
            present[value & np.uint64(_FILTER - 1)] = True
            seeds.append((value[order], at[order], present))
        return cls(ids, words, first, seeds)


def _hits(words: np.ndarray, first: np.ndarray, block: Block) -> Iterator[tuple]:
    """Pairs of places, in documents and in items, with equal seeds; in slices."""
    for mask, (known, places, present) in zip(MASKS, block.seeds):
        value, at = _seeds(words, first, mask)
        maybe = np.flatnonzero(present[value & np.uint64(_FILTER - 1)])
        low = np.searchsorted(known, value[maybe], "left")
        many = np.searchsorted(known, value[maybe], "right") - low
        some = many > 0
        maybe, low, many = maybe[some], low[some], many[some]
        cuts = np.flatnonzero(np.diff(np.cumsum(many) // _HITS, prepend=0))
        for a, b in zip([0, *cuts], [*cuts, len(many)]):
            if b > a:
                entry = W.ranges(low[a:b], many[a:b])
                yield np.repeat(at[maybe[a:b]], many[a:b]), places[entry]


def _stretches(words, first, block: Block) -> dict[str, np.ndarray]:
    """The best stretch of every document and item that share a seed and enough words."""
    pairs = []
    for mine, theirs in _hits(words, first, block):
        row = np.searchsorted(first, mine, "right") - 1
        item = np.searchsorted(block.first, theirs, "right") - 1
        shift = mine - theirs  # the same for all hits of one alignment
        pairs.append(np.unique(np.stack((row, item, shift), axis=1), axis=0))
    found = np.unique(np.concatenate(pairs or [np.zeros((0, 3), np.int64)]), axis=0)
    parts = []
    for piece in np.array_split(found, max(1, len(found) // 2048)):
        if len(piece):
            parts.append(_verified(words, first, block, *piece.T))
    names = ("row", "item", "start", "item_start", "words", "equal", "item_words")
    merged = np.concatenate(parts, axis=1) if parts else np.zeros((7, 0), np.int64)
    order = np.lexsort((merged[2], -merged[5], merged[1], merged[0]))
    merged = merged[:, order]
    best = np.ones(merged.shape[1], dtype=bool)
    best[1:] = (merged[0, 1:] != merged[0, :-1]) | (merged[1, 1:] != merged[1, :-1])
    return dict(zip(names, merged[:, best]))


def _verified(words, first, block: Block, row, item, shift) -> np.ndarray:
    """Lay items along documents and keep the alignments whose best stretch is long enough."""
    begin = np.maximum(block.first[item], first[row] - shift)
    end = np.minimum(block.first[item + 1], first[row + 1] - shift)
    length = end - begin
    line = np.repeat(np.arange(len(row)), length)
    place = W.ranges(begin, length)
    equal = words[place + shift[line]] == block.words[place]
    gain = np.where(equal, 1, -CHANGED)
    sums = np.cumsum(gain)
    before = sums - gain
    # Least sum before each place of the line: lines are sunk one below the other, to start anew.
    sunk = line * (np.int64(CHANGED + 1) * (len(gain) + 1) * 2)
    low = np.minimum.accumulate(before - sunk) + sunk
    best = np.maximum.reduceat(sums - low, np.cumsum(length) - length)
    at_end = np.flatnonzero(sums - low == best[line])
    _, pick = np.unique(line[at_end], return_index=True)
    last = at_end[pick]
    starts = np.flatnonzero(before == low)
    head = starts[np.searchsorted(starts, last, "right") - 1]
    count = np.concatenate(([0], np.cumsum(equal)))
    same = count[last + 1] - count[head]
    size = np.diff(block.first)[item]
    enough = (same >= MIN_EQUAL) | ((same >= SHORT_EQUAL) & (same >= SHORT_SHARE * size))
    columns = (
        row,
        item,
        place[head] + shift - first[row],
        place[head] - block.first[item],
        last - head + 1,
        same,
        size,
    )
    return np.stack(columns)[:, enough]


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[Block]:
    """The benchmark in blocks of about ``block_words`` words (or one longer item)."""
    items = benchmark.where(F.col("text").isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"), "text"
    )
    letters = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-letters // (4 * block_words)))
    for i in range(count):
        place = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
        rows = items.where(place == i).collect()
        rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"], r["text"]))
        if rows:
            yield Block.of([r["item_id"] for r in rows], [r["text"] for r in rows])


_FOUND = "doc_id long, item_id long, start long, item_start long, words long, equal long, item_words long"


def leaks(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document and item with a common stretch.

    ``start item_start words equal item_words``: where the best stretch begins in both (in words),
    its length, its equal words, and the item's length. Items of fewer than eight words are too
    short to tell. Null texts have no words; rows that repeat an id are searched each.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = spark.createDataFrame([], _FOUND)
    for i, block in enumerate(_blocks(benchmark, block_words)):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids = pa.array(shared.value.ids, pa.int64())
            for batch in W.chunks(batches):
                found = _stretches(*_words(batch.column("text")), shared.value)
                row, item = found.pop("row"), found.pop("item")
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").take(pa.array(row)),
                        "item_id": ids.take(pa.array(item)),
                        **found,
                    }
                )

        part = texts.mapInArrow(run, _FOUND)
        out = part if i == 0 else out.unionByName(part)
    return out


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """The documents, all columns, without those that hold a stretch of a benchmark item."""
    out = docs.select(*[F.col(f"`{c}`") for c in docs.columns])
    for block in _blocks(benchmark, block_words):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in W.chunks(batches):
                found = _stretches(*_words(batch.column("text")), shared.value)
                clean = np.ones(batch.num_rows, dtype=bool)
                clean[found["row"]] = False
                yield batch.filter(pa.array(clean))

        out = out.mapInArrow(run, out.schema)
    return out
