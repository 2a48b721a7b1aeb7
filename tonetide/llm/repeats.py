"""Substring deduplication by depth-limited suffixes, partitioned by a prefix path.

A word is removed if it lies in a window of ``window`` words whose sequence also starts in a
document with a smaller id.

This stands for suffix trees that are cut at ``window`` words, of which only the nodes at full depth
are needed: no inner node is built, and a node is named by a hash of its words. Suffixes are split
by a path: the least hash of the runs of ``PREFIX`` words anywhere in their first ``window`` words,
so that neighbouring suffixes mostly share their group and travel in one row, and equal windows
always meet. A path with more suffixes than a task should hold is extended to the full depth, where
only the least id of each node is needed. In a group, suffixes are sorted by node; nodes with several
documents are the repeats; runs of neighbouring ones are the maximal repeats that are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonetide.llm import words as W
from tonetide.llm.shared import stored

WINDOW = 50
PREFIX = 8
# Paths with more suffixes than this are extended; if they are more than ``MOST_EXTENDED``, only those
# with more than that part of all their suffixes.
GROUP_ROWS = 100_000
MOST_EXTENDED = 100_000
RUN_SUFFIXES = 20_000  # a longer run is cut into rows of so many
SLICE_SUFFIXES = 1 << 18  # that are unpacked at once

_SUFFIXES = "h long, doc long, key long, start int, nodes binary"


def _sliding_least(values: np.ndarray, span: int) -> np.ndarray:
    """Least of ``values[i : i + span]`` for each i, by doubling."""
    width = 1
    while width * 2 <= span:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = span - width
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _runs(column: pa.Array, window: int):
    """Neighbouring suffixes of a row with the same prefix path.

    Returns path, row and first word (within the row) of each run, the bounds of runs in the list
    of suffixes, and the depth-``window`` node of each suffix.
    """
    text = W.split(column)
    hashes = text.hashes()
    nodes, at = W.gram_hashes(hashes, text.first, window)
    if not len(at):
        return None
    prefix = min(PREFIX, window)
    grams = np.full(len(hashes), np.uint64(0xFFFFFFFFFFFFFFFF))
    found, places = W.gram_hashes(hashes, text.first, prefix)
    grams[places] = found
    path = _sliding_least(grams, window - prefix + 1)[at]
    row = np.repeat(np.arange(len(column)), np.maximum(text.counts - window + 1, 0))
    new = np.flatnonzero(np.concatenate(([True], (path[1:] != path[:-1]) | (row[1:] != row[:-1]))))
    length = np.diff(np.append(new, len(at)))
    cuts = -(-length // RUN_SUFFIXES)
    new = np.repeat(new, cuts) + W.ranges(np.zeros(len(cuts), np.int64), cuts) * RUN_SUFFIXES
    return path[new], row[new], at[new] - text.first[row[new]], np.append(new, len(at)), nodes


def _suffixes(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            runs = _runs(batch.column("text"), window)
            if runs is None:
                continue
            path, row, start, bounds, nodes = runs
            # 48 bits name a node: only nodes of the same 64-bit prefix path are compared.
            short = nodes.view(np.uint16).reshape(-1, 4)[:, :3].reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(path.view(np.int64)),
                    batch.column("doc").take(pa.array(row)),
                    batch.column("key").take(pa.array(row)),
                    pa.array(start.astype(np.int32)),
                    W.packed(short, bounds * 3),
                ],
                names=["h", "doc", "key", "start", "nodes"],
            )

    return run


def _paths(window: int):
    """The number of suffixes of each path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            runs = _runs(batch.column("text"), window)
            if runs is not None:
                path, which = np.unique(runs[0].view(np.int64), return_inverse=True)
                count = np.zeros(len(path), np.int64)
                np.add.at(count, which, np.diff(runs[3]))
                yield pa.RecordBatch.from_pydict({"h": path, "n": count})

    return run


def _nodes(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Node of each suffix in the rows of ``table``, and the number of suffixes in each row."""
    short = W.unpacked(table.column("nodes"), np.uint16).reshape(-1, 3)
    full = np.zeros((len(short), 4), dtype=np.uint16)
    full[:, :3] = short
    return full.view(np.uint64).reshape(-1), W.unpacked_counts(table.column("nodes"), np.uint16) // 3


def _spans(doc, key, start, counts, repeated, window: int) -> pa.RecordBatch:
    """Word ranges covered by repeated suffixes; neighbours in a row become one range."""
    row = np.repeat(np.arange(len(counts)), counts)
    place = W.ranges(start, counts)
    at = np.flatnonzero(repeated)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (np.diff(at) != 1) | (np.diff(row[at]) != 0)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(at)) - 1
    rows = row[at[head]]
    return pa.RecordBatch.from_pydict(
        {
            "doc": doc[rows],
            "key": key[rows],
            "since": place[at[head]].astype(np.int32),
            "until": (place[at[tail]] + window).astype(np.int32),
        }
    )


def _subtrees(window: int):
    """Within groups of one prefix path: suffixes whose node has a smaller document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in W.whole_groups(batches, "h"):
            h = table.column("h").to_numpy()
            doc = table.column("doc").to_numpy()
            head = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            several = np.minimum.reduceat(doc, head) < np.maximum.reduceat(doc, head)
            keep = np.repeat(several, np.diff(np.append(head, len(h))))
            if not keep.any():
                continue
            table = table.filter(pa.array(keep))
            h, doc = h[keep], doc[keep]
            nodes, counts = _nodes(table)
            node = W.mixed(np.repeat(h.view(np.uint64), counts) ^ W.mixed(nodes))
            owner = np.repeat(doc, counts)
            order = np.argsort(node, kind="stable")
            head = np.flatnonzero(np.concatenate(([True], np.diff(node[order]) != 0)))
            least = np.minimum.reduceat(owner[order], head)
            repeated = np.zeros(len(node), dtype=bool)
            repeated[order] = owner[order] > np.repeat(least, np.diff(np.append(head, len(node))))
            if repeated.any():
                start = table.column("start").to_numpy().astype(np.int64)
                key = table.column("key").to_numpy()
                yield _spans(doc, key, start, counts, repeated, window)

    return run


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most ``SLICE_SUFFIXES`` suffixes, or one row."""
    ends = np.cumsum(W.unpacked_counts(batch.column("nodes"), np.uint16) // 3)
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + SLICE_SUFFIXES, "right")))
        yield batch.slice(at, to - at)
        at = to


def _single(window: int):
    """Nodes at full depth. The ranges of a node in a text are one row if they touch, as they do in
    a text of repeated lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _slices(whole)):
            table = pa.Table.from_batches([batch])
            nodes, counts = _nodes(table)
            row = np.repeat(np.arange(len(counts)), counts)
            place = W.ranges(table.column("start").to_numpy().astype(np.int64), counts)
            h, doc, key = (table.column(c).to_numpy()[row] for c in ("h", "doc", "key"))
            order = np.lexsort((place, nodes, h, key, doc))
            new = np.ones(len(order), dtype=bool)
            new[1:] = np.diff(place[order]) > window
            for column in (nodes, h, key, doc):
                new[1:] |= column[order][1:] != column[order][:-1]
            head = np.flatnonzero(new)
            first, last = order[head], order[np.append(head[1:], len(order)) - 1]
            yield pa.RecordBatch.from_pydict(
                {
                    "h": h[first],
                    "node": nodes.view(np.int64)[first],
                    "doc": doc[first],
                    "key": key[first],
                    "since": place[first].astype(np.int32),
                    "until": (place[last] + window).astype(np.int32),
                }
            )

    return run


def repeated_spans(docs: DataFrame, window: int = WINDOW, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``doc key since until``: word ranges to remove; ``key`` tells texts of one id apart."""
    texts = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("key"), "text"
    )
    sizes = texts.select("text").mapInArrow(_paths(window), "h long, n long").groupBy("h")
    sizes = sizes.agg(F.sum("n").alias("n"))
    extended = stored(sizes.where(F.col("n") > group_rows))
    if extended.isEmpty():
        split, hot = texts.mapInArrow(_suffixes(window), _SUFFIXES), None
    else:
        number, total = extended.agg(F.count("*"), F.sum("n")).first()
        limit = group_rows if number <= MOST_EXTENDED else max(group_rows, total // MOST_EXTENDED)
        hot = F.broadcast(stored(extended.where(F.col("n") > limit).select("h")))
        split = texts.mapInArrow(_suffixes(window), _SUFFIXES).join(hot, "h", "left_anti")
    schema = "doc long, key long, since int, until int"
    spans = split.repartition("h").sortWithinPartitions("h").mapInArrow(_subtrees(window), schema)
    if hot is None:
        return spans
    deep = (
        texts.mapInArrow(_suffixes(window), _SUFFIXES)
        .join(hot, "h", "left_semi")
        .mapInArrow(_single(window), "h long, node long, doc long, key long, since int, until int")
    )
    least = deep.groupBy("h", "node").agg(F.min("doc").alias("least"))
    later = deep.join(least, ["h", "node"]).where(F.col("doc") > F.col("least"))
    return spans.unionByName(later.select("doc", "key", "since", "until"))


def _kept(batch: pa.RecordBatch) -> tuple[W.Words, np.ndarray]:
    """The words of a batch of texts with ``__spans``, and which of them stay."""
    text = W.split(batch.column("text"))
    step = np.zeros(len(text.starts) + 1, dtype=np.int64)
    spans = batch.column("__spans")
    flat = spans.flatten()
    if len(flat):
        length = pc.fill_null(pc.list_value_length(spans), 0).to_numpy()
        row = np.repeat(np.arange(batch.num_rows), length)
        since, until = (flat.field(i).to_numpy() + text.first[row] for i in (0, 1))
        np.add.at(step, since, 1)
        np.add.at(step, until, -1)
    return text, np.cumsum(step[:-1]) == 0


def _joined(text: W.Words, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words, each followed by a space, and where each row begins."""
    length = (text.ends - text.starts)[kept]
    begin = np.cumsum(length + 1) - (length + 1)
    out = np.full(int(length.sum()) + len(length), 0x20, dtype=np.uint8)
    out[W.ranges(begin, length)] = text.data[W.ranges(text.starts[kept], length)]
    before = np.concatenate(([0], np.cumsum(kept)))[text.first]
    return out, np.append(begin, len(out))[before]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.chunks(batches):
        text, kept = _kept(batch)
        out, first = _joined(text, kept)
        whole = out.tobytes()
        sums = np.concatenate(([0], np.cumsum(~kept)))[text.first]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(text.counts.astype(np.int64)),
                pa.array(np.diff(sums)),
                pa.array(
                    [
                        hashlib.sha256(whole[a : max(a, b - 1)]).hexdigest()
                        for a, b in zip(first[:-1].tolist(), first[1:].tolist())
                    ]
                ),
            ],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def _rewritten(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            text, kept = _kept(batch)
            out, first = _joined(text, kept)
            whole = out.tobytes()
            sums = np.concatenate(([0], np.cumsum(~kept)))[text.first]
            old = batch.column("text")
            new = [
                whole[a : max(a, b - 1)].decode("utf-8", "replace") if gone else old[i].as_py()
                for i, (a, b, gone) in enumerate(
                    zip(first[:-1].tolist(), first[1:].tolist(), np.diff(sums).tolist())
                )
            ]
            columns = [pa.array(new, pa.string()) if n == "text" else batch.column(n) for n in names]
            columns += [pa.array(np.diff(sums))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "__removed"])

    return run


def _with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Add the spans of each row. Ids and text hashes hardly repeat, so no key is hot by itself."""
    lists = spans.groupBy("doc", "key").agg(
        F.collect_list(F.struct("since", "until")).alias("__spans")
    )
    lists = lists.select(F.col("doc").alias("__doc"), F.col("key").alias("__key"), "__spans")
    mine = (F.col("doc_id").cast("long") == F.col("__doc")) & (F.xxhash64("text") == F.col("__key"))
    return docs.join(lists, mine, "left").drop("__doc", "__key")


def digest(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: ``doc_id n_words n_removed kept_sha256``.

    A null or empty text has no words. Rows that repeat an id are judged by themselves, an id never
    counts as smaller than itself, and rows with a null id keep all and remove nothing elsewhere.
    """
    found = _with_spans(docs.select("doc_id", "text"), repeated_spans(docs, window))
    return found.mapInArrow(
        _digests, "doc_id long, n_words long, n_removed long, kept_sha256 string"
    )


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without repeated passages, and without documents of which nothing is left.

    A text that loses words is its other words joined by single spaces; others stay as they are.
    All columns stay; ``n_chars``, if present, is counted anew for texts that changed.
    """
    names = docs.columns
    plain = docs.select(*[F.col(f"`{n}`") for n in names])
    schema = T.StructType([*plain.schema.fields, T.StructField("__removed", T.LongType())])
    out = _with_spans(plain, repeated_spans(docs, window)).mapInArrow(_rewritten(names), schema)
    out = out.where((F.col("__removed") == 0) | (F.length("text") > 0))
    if "n_chars" in names:
        counted = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn(
            "n_chars", F.when(F.col("__removed") > 0, counted).otherwise(F.col("n_chars"))
        )
    return out.select(*[F.col(f"`{n}`") for n in names])
