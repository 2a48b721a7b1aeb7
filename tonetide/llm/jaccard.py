"""Jaccard self-join of shingle sets by index lists that are skipped through set relations.

Equal sets are one class. Shingles are ordered by the number of classes that hold them, rarest
first; two similar sets share a shingle among the first (1 - t) n + 1 of each. A shingle of one
class only cannot be shared, so a set with that many such shingles is left out at once: this leaves
near copies and little else. The rest are grouped by shared leading shingles, and each group joins
its sets in memory:

* index lists hold their sets by size, so the block of sets that are too small is skipped by one
  search, and entries whose positions leave too few shingles are skipped before any comparison;
* answers are derived from those of a similar set: a set of the same component needs no comparison,
  and the overlaps of an earlier set bound the overlaps of one that resembles it.

Groups larger than a task should hold are cut into blocks, and each pair of blocks is joined alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tonetide.llm import words as W
from tonetide.llm.components import components
from tonetide.llm.shared import stored

SHINGLE = 5
PERCENT = 80
BUCKET_TOKENS = 1_000_000
BLOCK_TOKENS = 1_000_000
# A shingle in more than this share of documents is listed as frequent and sorted last. At most
# (mean set size / share) shingles can be, whatever the number of documents.
FREQUENT_SHARE = 0.01
_LOW = np.uint64((1 << 40) - 1)
_FREQUENT = 255


def shingles(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, rows in order, and the number of each row."""
    text = W.split(column, lower=True)
    hashes = text.hashes()
    grams, at = W.gram_hashes(hashes, text.first, k)
    rows = len(column)
    row = np.repeat(np.arange(rows), np.maximum(text.counts - k + 1, 0))
    short = np.flatnonzero((text.counts > 0) & (text.counts < k))
    whole = W.run_hashes(hashes, text.first[short], text.first[short + 1], W._WORD_BASE)
    grams, row = np.concatenate((grams, whole)), np.concatenate((row, short))
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    return grams[new], np.bincount(row[new], minlength=rows)


def _classes(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A hash of each row's set."""
    sums = np.zeros(len(grams) + 1, dtype=np.uint64)
    np.cumsum(W.mixed(grams), out=sums[1:])
    cuts = np.concatenate(([0], np.cumsum(counts)))
    return W.mixed(sums[cuts[1:]] - sums[cuts[:-1]] + counts.astype(np.uint64))


def _documents(k: int, share: float):
    """Per document its set's size and class; and shingles frequent within a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            grams, counts = shingles(batch.column("text"), k)
            names = _classes(grams, counts).view(np.int64)
            found, times = np.unique(grams, return_counts=True)
            often = times >= max(4, share * batch.num_rows)
            found, times = found[often], times[often]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column("doc_id"), pa.nulls(len(found), pa.int64())]),
                    pa.concat_arrays([batch.column("key"), pa.nulls(len(found), pa.int64())]),
                    pa.array(np.concatenate((counts, times)).astype(np.int64)),
                    pa.concat_arrays(
                        [pa.array(names, mask=counts == 0), pa.array(found.view(np.int64))]
                    ),
                    pa.array(np.arange(len(counts) + len(found)) >= len(counts)),
                ],
                names=["doc_id", "key", "n", "name", "frequent"],
            )

    return run


def _bucketed(k: int, buckets: int, frequent):
    """Shingles of distinct sets by bucket, packed: per bucket the sets, then their shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            grams, counts = shingles(batch.column("text"), k)
            names = _classes(grams, counts)
            first = np.zeros(len(counts), dtype=bool)
            first[np.unique(names, return_index=True)[1]] = True
            row = np.repeat(np.arange(len(counts)), counts)
            grams, row = grams[first[row]], row[first[row]]
            bucket = ((grams >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
            listed = np.searchsorted(frequent.value, grams)
            often = np.zeros(len(grams), dtype=bool)
            inside = listed < len(frequent.value)
            often[inside] = frequent.value[listed[inside]] == grams[inside]
            # Frequent shingles need no counting: they go by set, under negative numbers.
            by_set = _by_set(names[row], buckets)
            target = np.where(often, -1 - by_set, bucket)
            # A set's size goes with its first shingle only.
            begin = np.flatnonzero(np.diff(row, prepend=-1))
            told = target[begin], names[row[begin]], counts[row[begin]]
            yield _packed_rows(target, bucket, names[row], grams & _LOW, told)

    return run


_PACKED = (
    "target int, names binary, runs binary, low binary, high binary, "
    "told_names binary, told_sizes binary, home binary"
)
_RUN = 255


def _packed_rows(target, bucket, names, low, told, df=None) -> pa.RecordBatch:
    """One row per target: its sets with a count of shingles each, the shingles, and sizes of sets.

    A set costs nine bytes where it has shingles. Its size is told in one row, not in all: ``told``
    has a target, a name and a size for each.
    """
    order = np.lexsort((names, target)) if df is not None else np.argsort(target, kind="stable")
    target, bucket, names, low = (x[order] for x in (target, bucket, names, low))
    new = np.ones(len(target), dtype=bool)
    new[1:] = (target[1:] != target[:-1]) | (names[1:] != names[:-1])
    head = np.flatnonzero(new)
    begin = np.repeat(head, np.diff(np.append(head, len(target))))
    head = np.flatnonzero((np.arange(len(target)) - begin) % _RUN == 0)  # long runs go in parts
    runs = np.diff(np.append(head, len(target)))
    to, told_names, told_sizes = (x[np.argsort(told[0], kind="stable")] for x in told)
    rows = np.unique(np.concatenate((target, to)))

    def cuts(of: np.ndarray) -> np.ndarray:
        return np.append(np.searchsorted(of, rows), len(of))

    columns = [
        pa.array(rows.astype(np.int32)),
        W.packed(names[head], cuts(target[head])),
        W.packed(runs.astype(np.uint8), cuts(target[head])),
        W.packed(low.astype(np.uint32), cuts(target)),
        W.packed((low >> np.uint64(32)).astype(np.uint8), cuts(target)),
        W.packed(told_names, cuts(to)),
        W.packed(told_sizes.astype(np.uint32), cuts(to)),
    ]
    if df is None:
        # The bucket of an ordinary row is its target; rows of frequent shingles list them.
        home = np.concatenate(([0], np.cumsum(target < 0)))
        columns.append(W.packed(bucket[target < 0].astype(np.uint32), home[cuts(target)]))
    else:
        columns.append(W.packed(bucket.astype(np.uint32), cuts(target)))
        columns.append(W.packed(df[order].astype(np.uint8), cuts(target)))
    columns_ = ["target", "names", "runs", "low", "high", "told_names", "told_sizes", "home", "df"]
    return pa.RecordBatch.from_arrays(columns, names=columns_[: len(columns)])


def _entries(table: pa.Table, homes: bool):
    """Set and shingle of every entry in packed rows."""
    runs = W.unpacked(table.column("runs"), np.uint8).astype(np.int64)
    names = np.repeat(W.unpacked(table.column("names"), np.uint64), runs)
    low = W.unpacked(table.column("low"), np.uint32).astype(np.uint64)
    low |= W.unpacked(table.column("high"), np.uint8).astype(np.uint64) << np.uint64(32)
    if homes:
        home = W.unpacked(table.column("home"), np.uint32).astype(np.uint64)
    else:
        home = np.repeat(
            table.column("target").to_numpy(), W.unpacked_counts(table.column("low"), np.uint32)
        ).astype(np.uint64)
    return names, low | (home << np.uint64(40))


def _told(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sets and sizes told in packed rows, each set once, in order."""
    sizes = W.unpacked(table.column("told_sizes"), np.uint32).astype(np.int64)
    names, at = np.unique(W.unpacked(table.column("told_names"), np.uint64), return_index=True)
    return names, sizes[at]


def _counted(buckets: int):
    """Shingles that several classes hold, with that number, by set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in W.whole_groups(batches, "target"):
            told_names, told_sizes = _told(table)
            often = table.filter(pa.array(table.column("target").to_numpy() < 0))
            table = table.filter(pa.array(table.column("target").to_numpy() >= 0))
            names, token = _entries(often, True)
            parts = [(names, token, np.full(len(names), _FREQUENT))]
            names, token = _entries(table, False)
            order = np.lexsort((names, token))
            names, token = names[order], token[order]
            fresh = np.ones(len(token), dtype=bool)
            fresh[1:] = (token[1:] != token[:-1]) | (names[1:] != names[:-1])
            names, token = names[fresh], token[fresh]
            head = np.flatnonzero(np.diff(token, prepend=~token[:1]))
            df = np.diff(np.append(head, len(token)))
            df = np.repeat(df, df)
            several = df > 1
            parts.append((names[several], token[several], np.minimum(df[several], _FREQUENT - 1)))
            names, token, df = (np.concatenate(x) for x in zip(*parts))
            home = (token >> np.uint64(40)).astype(np.int64)
            told = _by_set(told_names, buckets), told_names, told_sizes
            yield _packed_rows(_by_set(names, buckets), home, names, token & _LOW, told, df)

    return run


def _by_set(names: np.ndarray, buckets: int) -> np.ndarray:
    return (names % np.uint64(buckets)).astype(np.int64)


def _least_overlap(size, percent: int):
    """Overlap that a set of this size needs with any similar set."""
    return -(-size * percent // 100)


def _candidates(percent: int):
    """Sets whose leading shingles are not all their own, shingles rarest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in W.whole_groups(batches, "target"):
            names, token = _entries(table, True)
            df = W.unpacked(table.column("df"), np.uint8)
            order = np.lexsort((token, df, names))
            names, token = names[order], token[order]
            # A set's frequent shingles can come from several chunks.
            fresh = np.ones(len(token), dtype=bool)
            fresh[1:] = (token[1:] != token[:-1]) | (names[1:] != names[:-1])
            names, token = names[fresh], token[fresh]
            head = np.flatnonzero(np.diff(names, prepend=~names[:1]))
            count = np.diff(np.append(head, len(names)))
            told_names, told_sizes = _told(table)
            size = told_sizes[np.searchsorted(told_names, names[head])]
            own = size - count
            lead = size - _least_overlap(size, percent) + 1 - own
            keep = lead > 0
            entry = np.repeat(keep, count)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names[head][keep].view(np.int64)),
                    pa.array(size[keep]),
                    pa.array(own[keep]),
                    pa.array(np.minimum(lead, count)[keep].astype(np.int32)),
                    W.lists_of(token[entry].view(np.int64), count[keep], pa.int64()),
                ],
                names=["name", "size", "own", "lead", "tokens"],
            )

    return run


class _Group:
    """The sets of one group (or pair of blocks), joined in memory."""

    def __init__(self, size, own, lead, tokens, counts, percent):
        order = np.argsort(size, kind="stable")
        cuts = np.concatenate(([0], np.cumsum(counts)))
        self.size, self.own, self.lead, self.order = size[order], own[order], lead[order], order
        counts = counts[order]
        tokens = tokens[W.ranges(cuts[:-1][order], counts)]
        self.tokens = np.unique(tokens, return_inverse=True)[1]
        self.cuts = np.concatenate(([0], np.cumsum(counts)))
        self.percent = percent
        self.marked = np.zeros(int(self.tokens.max(initial=-1)) + 1, dtype=np.int32)
        self.label = np.arange(len(size))
        self.links: list[tuple[int, int]] = []
        self.answers: list[tuple[int, np.ndarray]] = []  # overlaps of a few earlier sets

    def index(self) -> None:
        """Leading shingles to sets by size: entries are sorted by (shingle, set)."""
        members = np.repeat(np.arange(len(self.size)), self.lead)
        at = W.ranges(self.cuts[:-1], self.lead)
        place = W.ranges(self.own, self.lead)
        order = np.lexsort((members, self.tokens[at]))
        self.member, self.place = members[order], place[order]
        self.list_cuts = np.searchsorted(self.tokens[at][order], np.arange(len(self.marked) + 1))

    def candidates(self, x: int) -> np.ndarray:
        """Earlier (not larger) sets of other components that may be similar to ``x``."""
        low = int(np.searchsorted(self.size, _least_overlap(self.size[x], self.percent)))
        if (self.label[low:x] == self.label[x]).all():
            return np.zeros(0, dtype=np.int64)
        at = slice(self.cuts[x], self.cuts[x] + self.lead[x])
        token = self.tokens[at]
        begin, end = self.list_cuts[token], self.list_cuts[token + 1]
        entry = W.ranges(begin, end - begin)
        mine = np.repeat(self.own[x] + np.arange(self.lead[x]), end - begin)
        other = self.member[entry]
        inside = (other >= low) & (other < x)
        entry, mine, other = entry[inside], mine[inside], other[inside]
        left = np.minimum(self.size[x] - mine, self.size[other] - self.place[entry])
        other = np.unique(other[left >= self.needed(x, other)])
        return other[self.label[other] != self.label[x]]

    def needed(self, x: int, other: np.ndarray) -> np.ndarray:
        return -(-(self.size[x] + self.size[other]) * self.percent // (100 + self.percent))

    def overlaps(self, x: int, other: np.ndarray) -> np.ndarray:
        self.marked[self.tokens[self.cuts[x] : self.cuts[x + 1]]] = 1
        counts = self.cuts[other + 1] - self.cuts[other]
        hits = np.cumsum(self.marked[self.tokens[W.ranges(self.cuts[other], counts)]])
        hits = np.concatenate(([0], hits))[np.concatenate(([0], np.cumsum(counts)))]
        self.marked[self.tokens[self.cuts[x] : self.cuts[x + 1]]] = 0
        return np.diff(hits)

    def join(self) -> None:
        self.index()
        for x in range(1, len(self.size)):
            rest = self.candidates(x)
            known = np.full(len(self.size), -1, dtype=np.int32)
            step = 1
            while len(rest):
                # One set of each component first: if it is similar, the others need no look.
                _, first = np.unique(self.label[rest], return_index=True)
                chosen = np.zeros(len(rest), dtype=bool)
                chosen[first] = True
                chosen[:step] = True
                other, rest = rest[chosen], rest[~chosen]
                overlap = self.overlaps(x, other)
                known[other] = overlap
                for y in other[overlap >= self.needed(x, other)]:
                    self.link(x, int(y))
                rest = rest[self.label[rest] != self.label[x]]
                rest = self.derived(x, rest, known)
                step *= 4
            known[x] = self.size[x]
            self.answers = [*self.answers[-7:], (x, known)]

    def derived(self, x: int, rest: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Drop candidates that a similar earlier set's overlaps show to be too far from ``x``."""
        for y, overlap in self.answers:
            if known[y] > 0 and len(rest):
                shared = overlap[rest]
                most = np.minimum(known[y], shared) + np.minimum(
                    self.size[x] - known[y], self.size[rest] - shared
                )
                rest = rest[(shared < 0) | (most >= self.needed(x, rest))]
        return rest

    def link(self, x: int, y: int) -> None:
        if self.label[x] != self.label[y]:
            old, new = sorted((self.label[x], self.label[y]))[::-1]
            self.label[self.label == old] = new
            self.links.append((x, y))


def _joined(percent: int):
    """The links that connect each group's similar sets, one fewer than the sets they connect."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in W.whole_groups(batches, "group"):
            table = table.combine_chunks()
            group = table.column("group").to_numpy()
            name = table.column("name").to_numpy()
            size, own = table.column("size").to_numpy(), table.column("own").to_numpy()
            lead = table.column("lead").to_numpy().astype(np.int64)
            lists = table.column("tokens").combine_chunks()
            tokens = lists.flatten().to_numpy()
            counts = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            cuts = np.concatenate(([0], np.cumsum(counts)))
            head = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
            left, right = [], []
            for a, b in zip(head, np.append(head[1:], len(group))):
                if b - a > 1:
                    part = tokens[cuts[a] : cuts[b]]
                    g = _Group(size[a:b], own[a:b], lead[a:b], part, counts[a:b], percent)
                    g.join()
                    if g.links:
                        x, y = (g.order[np.array(side)] + a for side in zip(*g.links))
                        left.append(name[x])
                        right.append(name[y])
            if left:
                yield pa.RecordBatch.from_pydict(
                    {"a": np.concatenate(left), "b": np.concatenate(right)}
                )

    return run


def _blocks(sets: DataFrame, groups: DataFrame, block_tokens: int) -> DataFrame:
    """Give each set its group's number; a set of a large group one for each pair of blocks."""
    weights = sets.select("name", F.size("tokens").cast("long").alias("__tokens"))
    members = groups.join(weights, F.col("node") == F.col("name")).drop("node")
    sizes = members.groupBy("root").agg(F.sum("__tokens").alias("__all"))
    placed = (
        members.join(sizes, "root")
        .withColumn("__cut", F.ceil(F.col("__all") / block_tokens).cast("int"))
        .withColumn("__block", F.pmod(F.xxhash64("name"), F.col("__cut")).cast("int"))
        .withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__cut") - 1)))
    )
    pair = F.xxhash64("root", F.least("__block", "__other"), F.greatest("__block", "__other"))
    return sets.join(placed.select("name", pair.alias("group")), "name")


def similar_sets(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, **sizes) -> tuple:
    """Documents with size and class (``doc_id key n name``), and the links between classes (``a b``).

    The links are a forest: they connect exactly the classes that similarity connects.
    """
    spark: SparkSession = docs.sparkSession
    bucket_tokens = sizes.get("bucket_tokens", BUCKET_TOKENS)
    share = sizes.get("frequent_share", FREQUENT_SHARE)
    block_tokens = sizes.get("block_tokens", BLOCK_TOKENS)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), "text"
    )
    both = stored(
        texts.mapInArrow(
            _documents(k, share), "doc_id long, key long, n long, name long, frequent boolean"
        )
    )
    members = both.where(~F.col("frequent")).drop("frequent")
    total, count = members.agg(F.sum("n"), F.count(F.lit(1))).first()
    often = (
        both.where("frequent").groupBy("name").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= max(4, share * count))
    )
    listed = np.array([r["name"] for r in often.select("name").collect()], dtype=np.int64)
    frequent = spark.sparkContext.broadcast(np.sort(listed.view(np.uint64)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(max(parts, -(-(total or 0) // bucket_tokens)), 1 << 20)

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(buckets, "target").sortWithinPartitions("target")

    counted = dealt(texts.select("text").mapInArrow(_bucketed(k, buckets, frequent), _PACKED))
    counted = dealt(counted.mapInArrow(_counted(buckets), f"{_PACKED}, df binary"))
    schema = "name long, size long, own long, lead int, tokens array<long>"
    sets = stored(counted.mapInArrow(_candidates(percent), schema))
    entries = sets.select("name", F.explode(F.slice("tokens", 1, F.col("lead"))).alias("token"))
    leaders = (
        entries.groupBy("token")
        .agg(F.min("name").alias("a"), F.max("name").alias("__last"))
        .where(F.col("a") != F.col("__last"))
        .drop("__last")
    )
    near = entries.join(leaders, "token").select("a", F.col("name").alias("b"))
    groups = stored(components(near.where(F.col("a") != F.col("b")).distinct()))
    dealt_sets = _blocks(sets, groups, block_tokens).repartition("group").sortWithinPartitions("group")
    return members, stored(dealt_sets.mapInArrow(_joined(percent), "a long, b long"))


def classes(docs: DataFrame, **options) -> DataFrame:
    """Per document: ``doc_id n_shingles component_id``.

    Words are runs without white space, A-Z lower-cased; a set holds the distinct ``k``-word
    shingles, or the whole sequence of a shorter text. A null or empty text has no set and links
    with nothing. Equal sets are linked whatever their ids; rows that repeat an id count as one
    document each. ``component_id`` is the smallest id reachable, null ids aside.
    """
    members, roots = _rooted(docs, **options)
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    by_name = roots.join(least, "root").select(F.col("name").alias("__name"), "component_id")
    by_name = stored(by_name)
    return members.join(by_name, F.col("name") == F.col("__name"), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def _rooted(docs: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """Documents, and per class the ``root`` of its component and its ``least`` id and first row."""
    members, links = similar_sets(docs, **options)
    own = (
        members.where(F.col("name").isNotNull())
        .groupBy("name")
        .agg(
            F.min("doc_id").alias("least"),
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first"),
        )
    )
    roots = stored(components(links))
    named = own.join(roots, F.col("name") == F.col("node"), "left").drop("node")
    return members, stored(named.withColumn("root", F.coalesce("root", "name")))


def row_key():
    """Tells rows apart by id and text."""
    return F.xxhash64("doc_id", "text")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents, all columns, without those similar to another that stays.

    Of each component the row of least id stays (null ids last); rows that repeat both id and text
    count as one. Documents without words stay, all of them.
    """
    members, roots = _rooted(docs, **options)
    first = roots.groupBy("root").agg(F.min("first").alias("first"))
    kept = first.select(F.col("first.key").alias("__key"), F.lit(True).alias("__once"))
    empty = members.where(F.col("name").isNull()).select(F.col("key").alias("__key")).distinct()
    kept = stored(kept.unionByName(empty.withColumn("__once", F.lit(False))))
    place = F.row_number().over(Window.partitionBy("__row").orderBy("__row"))
    return (
        docs.withColumn("__row", row_key())
        .join(kept, F.col("__row") == F.col("__key"))
        .withColumn("__place", place)
        .where(~F.col("__once") | (F.col("__place") == 1))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
