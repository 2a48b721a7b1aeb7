"""Alignment of the tokens of two tokenizers by merge-path partitioning.

The byte offsets where tokens end are two ascending lists. Merging them finds the offsets in both,
which cut the tokens into groups. The merge of a whole chunk of texts is a path of as many steps as
both lists are long; diagonals at equal distances cross it at points found by binary search, which
divide both lists into pieces of equal work. Each piece is merged on its own and emits the ends in
both of its parts; where a diagonal falls between two equal ends, and where groups run over one, the
pieces are stitched.

1. One pass encodes and merges. It writes ids (two bytes each) and a bit per token, set on the last
   of each group.
2. A second one counts in how many documents each id pair is linked: each task adds up its own
   documents before the shuffle, so a pair in every document is one row per task.
3. A third one looks pairs up. The most frequent ones, at most ``frequent``, are broadcast; they
   make up nearly all links. Pairs beyond them have few documents each by their count, so those
   are joined by shuffle without hot keys. No occurrence pairs are written: a document's links
   are id pairs with a number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonetide.llm.encoding import byte_bpe, cut, piece_bpe, sums_by, two_kinds
from tonetide.llm.shared import stored
from tonetide.llm.words import chunks, packed, ranges, unpacked, unpacked_counts, valid

FREQUENT = 1 << 21
WORK = 1 << 14
PAIRS = 1 << 20
_ID_BITS = 16


def diagonals(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """How much of each list lies before each diagonal; equal ends come from ``a`` first."""
    d = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))
    low, high = np.maximum(d - len(b), 0), np.minimum(d, len(a))
    while (low < high).any():
        middle = (low + high) // 2
        open_ = low < high
        # The path takes a[middle] before the diagonal if the b it would displace is not smaller.
        takes = np.zeros(len(d), dtype=bool)
        m = middle[open_]
        takes[open_] = a[m] <= b[d[open_] - m - 1]
        low = np.where(open_ & takes, middle + 1, low)
        high = np.where(open_ & ~takes, middle, high)
    return low, d - low


def common_ends(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` of the numbers in both; each list strictly ascends."""
    i, j = diagonals(a, b, work)
    in_a, in_b = [], []
    for i0, i1, j0, j1 in zip(i[:-1], i[1:], j[:-1], j[1:]):
        part, other = a[i0:i1], b[j0:j1]
        # Stitch: the diagonal before this piece lies between two equal ends.
        if i0 and len(other) and a[i0 - 1] == other[0]:
            in_a.append(np.array([i0 - 1]))
            in_b.append(np.array([j0]))
        if len(part) and len(other):
            at = np.minimum(np.searchsorted(other, part), len(other) - 1)
            same = np.flatnonzero(other[at] == part)
            in_a.append(i0 + same)
            in_b.append(j0 + at[same])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *in_a]), np.concatenate([none, *in_b])


def _bits(last: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A bit per token, each row's in bytes of its own."""
    size = (counts + 7) // 8
    first = np.cumsum(size) - size
    at = ranges(first * 8, counts)
    flags = np.zeros(int(size.sum()) * 8, dtype=np.uint8)
    flags[at] = last
    return packed(np.packbits(flags, bitorder="little"), np.append(first, size.sum()))


def _marked(column, counts: np.ndarray) -> np.ndarray:
    size = (counts + 7) // 8
    flags = np.unpackbits(unpacked(column, np.uint8), bitorder="little")
    return flags[ranges((np.cumsum(size) - size) * 8, counts)].astype(bool)


def _written(ids: np.ndarray, separators: np.ndarray, table: np.ndarray) -> list[bytes]:
    return table[separators * len(table) // 3 + ids].tolist()


def _decimal(size: int) -> np.ndarray:
    """Every id in decimal with a comma, a bar or a semicolon behind it."""
    return np.array([b"%d%s" % (i, s) for s in (b",", b"|", b";") for i in range(size)], dtype=object)


def _encoder(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_bpe(a_path), piece_bpe(b_path)
        size = max(len(a.bytes), len(b.bytes))
        if size > 1 << _ID_BITS:
            raise ValueError(f"ids of more than {_ID_BITS} bits")
        known = two_kinds(a_path, b_path)
        a_bytes, b_bytes = np.array(a.bytes, dtype=object), np.array(b.bytes, dtype=object)
        decimal = _decimal(size)
        for batch in chunks(batches):
            texts = [t or "" for t in valid(batch.column("text")).to_pylist()]
            kept = np.flatnonzero([bool(t) for t in texts])
            pieces, n = cut([texts[i] for i in kept])
            (a_ids, a_per), (b_ids, b_per) = known.encode(pieces)
            na, nb = sums_by(a_per, n), sums_by(b_per, n)
            same = np.zeros(len(kept), dtype=bool)
            ia = ib = 0
            for r, (i, x, y) in enumerate(zip(kept, na, nb)):
                body = b" " + texts[i].encode()
                same[r] = (
                    b"".join(a_bytes[a_ids[ia : ia + x]].tolist()) == body
                    and b"".join(b_bytes[b_ids[ib : ib + y]].tolist()) == body
                )
                ia, ib = ia + x, ib + y
            a_ids, b_ids = a_ids[np.repeat(same, na)], b_ids[np.repeat(same, nb)]
            na, nb, kept = na[same], nb[same], kept[same]
            in_a, in_b = common_ends(np.cumsum(a.sizes[a_ids]), np.cumsum(b.sizes[b_ids]))
            a_last, b_last = np.zeros(len(a_ids), bool), np.zeros(len(b_ids), bool)
            a_last[in_a], b_last[in_b] = True, True
            p, q = np.diff(in_a, prepend=-1), np.diff(in_b, prepend=-1)
            groups = sums_by(a_last.astype(np.int64), na)
            links = sums_by(p * q, groups)
            # Each group's a ids, then its b ids: the order of the text that is hashed.
            together = np.empty(len(a_ids) + len(b_ids), np.int64)
            marks = np.zeros(len(together), np.int64)
            a_at = ranges(np.cumsum(p + q) - (p + q), p)
            b_at = ranges(np.cumsum(p + q) - q, q)
            together[a_at], together[b_at] = a_ids, b_ids
            marks[a_at[a_last]], marks[b_at[b_last]] = 1, 2
            written = _written(together, marks, decimal)
            sha, at = [""] * len(texts), 0
            for i, x in zip(kept, na + nb):
                sha[i] = hashlib.sha256(b"".join(written[at : at + x])[:-1]).hexdigest()
                at += x

            def whole(values: np.ndarray) -> np.ndarray:
                out = np.zeros(len(texts), np.int64)
                out[kept] = values
                return out

            n_a, n_b = whole(na), whole(nb)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_a": n_a,
                    "n_b": n_b,
                    "n_groups": whole(groups),
                    "n_links": whole(links),
                    "groups_sha256": sha,
                    "a": packed(a_ids.astype(np.uint16), np.append(0, np.cumsum(n_a))),
                    "b": packed(b_ids.astype(np.uint16), np.append(0, np.cumsum(n_b))),
                    "a_last": _bits(a_last, n_a),
                    "b_last": _bits(b_last, n_b),
                }
            )

    return run


def _products(p: np.ndarray, q: np.ndarray, limit: int) -> Iterator[slice]:
    """Consecutive groups whose products sum to at most ``limit``, or one larger group."""
    ends, at = np.cumsum(p * q), 0
    while at < len(p):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield slice(at, to)
        at = to


def _distinct(key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sum of their weights."""
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))[: len(key)])
    return key[first], np.add.reduceat(weight, first) if len(first) else weight


def _sides(groups: np.ndarray, ids: np.ndarray):
    """Group and id of the distinct ids of each group, how often each occurs, ids per group."""
    key, often = _distinct((groups << _ID_BITS) | ids, np.ones(len(ids), np.int64))
    return key & ((1 << _ID_BITS) - 1), often, np.bincount(key >> _ID_BITS)


def linked_pairs(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row, pair (a id, b id as one number) and number of links, rows one after the other.

    Ids that repeat in a group are counted first, so that a group is the product of its distinct
    ids. Yields about ``PAIRS`` pairs at a time. A row has each pair once within what is yielded; a
    row of more pairs comes in parts, which is said by the same last and first row.
    """
    na, nb = (unpacked_counts(batch.column(c), np.uint16) for c in ("a", "b"))
    a_last, b_last = (_marked(batch.column(c), n) for c, n in (("a_last", na), ("b_last", nb)))
    a, b = (unpacked(batch.column(c), np.uint16).astype(np.int64) for c in ("a", "b"))
    if not len(a):
        return
    row_of = np.repeat(np.arange(len(na)), na)[a_last]
    a_group = np.cumsum(a_last) - a_last
    b_group = np.cumsum(b_last) - b_last
    a_id, a_often, p = _sides(a_group, a)
    b_id, b_often, q = _sides(b_group, b)
    a_first, b_first = np.cumsum(p) - p, np.cumsum(q) - q
    # Work is cut by distinct a ids, each with its group's b ids.
    width = np.repeat(q, p)
    group = np.repeat(np.arange(len(p)), p)
    for part in _products(width, np.ones_like(width), PAIRS):
        w, g = width[part], group[part]
        left = np.repeat(np.arange(part.start, part.stop), w)
        right = ranges(b_first[g], w)
        key = (np.repeat(row_of[g], w) << 2 * _ID_BITS) | (a_id[left] << _ID_BITS) | b_id[right]
        key, often = _distinct(key, a_often[left] * b_often[right])
        yield key >> 2 * _ID_BITS, key & ((1 << 2 * _ID_BITS) - 1), often


def _per_document(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``linked_pairs`` with whole rows, each pair of a row once."""
    held = (np.zeros(0, np.int64),) * 3
    for found in linked_pairs(batch):
        row, pair, often = (np.concatenate(x) for x in zip(held, found))
        if len(held[0]):
            key, often = _distinct((row << 2 * _ID_BITS) | pair, often)
            row, pair = key >> 2 * _ID_BITS, key & ((1 << 2 * _ID_BITS) - 1)
        done = np.searchsorted(row, row[-1])  # the last row may go on
        if done:
            yield row[:done], pair[:done], often[:done]
        held = (row[done:], pair[done:], often[done:])
    if len(held[0]):
        yield held


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's documents by pair."""
    pairs, counts, waiting, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def added():
        own, n = np.unique(np.concatenate([np.zeros(0, np.int64), *waiting]), return_counts=True)
        return _distinct(np.concatenate((pairs, own)), np.concatenate((counts, n)))

    for batch in chunks(batches, "a"):
        for _, pair, _ in _per_document(batch):
            waiting.append(pair)
            size += len(pair)
        if size > 2 * PAIRS:
            pairs, counts = added()
            waiting, size = [], 0
            if len(pairs) > 4 * PAIRS:
                yield pa.RecordBatch.from_pydict({"pair": pairs, "n": counts})
                pairs = counts = np.zeros(0, np.int64)
    pairs, counts = added()
    yield pa.RecordBatch.from_pydict({"pair": pairs, "n": counts})


def _looked_up(table):
    """Best links and sum of counts by row; pairs that ``table`` lacks as lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = table.value
        for batch in chunks(batches, "a"):
            n_best, total = (np.zeros(batch.num_rows, np.int64) for _ in range(2))
            rare: list[tuple[np.ndarray, ...]] = []
            for row, pair, often in _per_document(batch):
                at = np.searchsorted(pairs, pair)
                hit = pairs[at] == pair
                rows = np.searchsorted(row, np.arange(batch.num_rows + 1))
                total += sums_by(np.where(hit, counts[at] * often, 0), np.diff(rows))
                n_best += sums_by(np.where(hit, best[at] * often, 0), np.diff(rows))
                if not hit.all():
                    rare.append((row[~hit], pair[~hit], often[~hit]))
            row, pair, often = (
                np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*rare) if rare else [()] * 3)
            )
            cuts = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_pydict(
                {c: batch.column(c) for c in _SHOWN}
                | {
                    "n_best": n_best,
                    "count_sum": total,
                    "pair": pa.ListArray.from_arrays(cuts, pair),
                    "often": pa.ListArray.from_arrays(cuts, often),
                }
            )

    return run


_SHOWN = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def tokens(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Ids and groups of every document, a row each.

    ``a`` and ``b`` hold the ids of space + text as little-endian 16-bit numbers, ``a_last`` and
    ``b_last`` a bit per token, set on the last of each group. ``a_path`` is a byte-level file of the
    tokenizers library, ``b_path`` a byte-fallback model of the sentencepiece library that adds the
    space itself; both are read where the tasks run. A text that is null or empty, or that either
    tokenizer does not give back byte by byte, has no tokens.
    """
    return docs.select("doc_id", "text").mapInArrow(
        _encoder(a_path, b_path),
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_a long, n_b long, n_groups long, "
        "n_links long, groups_sha256 string, a binary, b binary, a_last binary, b_last binary",
    )


def pair_counts(encoded: DataFrame) -> DataFrame:
    """``pair`` (a id * 65,536 + b id), ``n`` documents that hold it linked, ``best`` of its a id."""
    counts = stored(
        encoded.select("a", "b", "a_last", "b_last")
        .mapInArrow(_count, "pair long, n long")
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
    )
    # At most 65,536 rows, by the size of ids.
    most = counts.groupBy(F.shiftright("pair", _ID_BITS).alias("__a")).agg(F.max("n").alias("__most"))
    joined = counts.join(F.broadcast(most), F.shiftright("pair", _ID_BITS) == F.col("__a"))
    return joined.select("pair", "n", (F.col("n") == F.col("__most")).alias("best"))


def _frequent(counts: DataFrame, limit: int) -> int:
    """The least number of documents that at most ``limit`` pairs have or exceed."""
    left, least = limit, None
    for row in counts.groupBy("n").agg(F.count(F.lit(1)).alias("pairs")).sort(F.desc("n")).toLocalIterator():
        if row["pairs"] > left:
            break
        left, least = left - row["pairs"], row["n"]
    return least


def align(docs: DataFrame, a_path: str, b_path: str, frequent: int = FREQUENT) -> DataFrame:
    """A row per document: numbers of tokens, groups and links, and what the links' counts say.

    ``n_links`` counts the pairs of a token of each kind that share a group, ``count_sum`` adds up in
    how many documents of ``docs`` each such id pair is linked, ``n_best`` counts links whose count
    is the highest of their first id, ties included. ``groups_sha256`` digests the groups as
    decimal ids (``a1,a2|b1;a3|b2,b3``); without tokens it is empty and the numbers are zero.
    Repeated and null ids are documents of their own; other columns are left out.
    """
    spark = docs.sparkSession
    encoded = stored(tokens(docs, a_path, b_path), compression="zstd")
    counts = stored(pair_counts(encoded))
    least = _frequent(counts, frequent)
    all_pairs = counts.where(F.lit(False) if least is None else F.col("n") >= least)
    found = all_pairs.toArrow()
    order = np.argsort(found["pair"].to_numpy())
    last = {"pair": np.iinfo(np.int64).max, "n": 0, "best": 0}  # so that every search has a place
    table = spark.sparkContext.broadcast(
        tuple(np.append(found[c].to_numpy()[order].astype(np.int64), x) for c, x in last.items())
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    looked_up = encoded.mapInArrow(
        _looked_up(table),
        f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "n_best long, count_sum long, pair array<long>, often array<long>",
    )
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if counts.count() == found.num_rows:
        return looked_up.select(*columns)
    first = stored(looked_up.withColumn("__row", F.monotonically_increasing_id()))
    rare = first.select(
        "__row", F.explode(F.arrays_zip("pair", "often")).alias("__rare")
    ).select("__row", "__rare.pair", "__rare.often")
    rest = counts if least is None else counts.where(F.col("n") < least)
    added = rare.join(rest, "pair").groupBy("__row").agg(
        F.sum(F.col("n") * F.col("often")).alias("__sum"),
        F.sum(F.when(F.col("best"), F.col("often")).otherwise(0)).alias("__best"),
    )
    return (
        first.drop("pair", "often")
        .join(added, "__row", "left")
        .withColumn("count_sum", F.col("count_sum") + F.coalesce("__sum", F.lit(0)))
        .withColumn("n_best", F.col("n_best") + F.coalesce("__best", F.lit(0)))
        .select(*columns)
    )
