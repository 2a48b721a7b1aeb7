"""Hard negatives by Kronecker-packed inner products.

Components are integers. Both sides are biased by their least component, so that none is negative,
and the components of several candidates are put into separate fields of one wide integer, a field
wide enough for the largest sum. A product of such a word with an anchor's component holds the
products with all its candidates; summed over the components, the fields hold whole inner products,
and what the biases add is subtracted from each. As long as two or more fields fit into 53 bits, words are doubles that
hold integers exactly, which the matrix product of numpy multiplies at full speed; wider ones are
Python integers that hold a whole block of candidates, so components of any size give exact scores.

Anchors go in blocks of bounded size, each in two passes over all rows. The first finds every
anchor's positives, comparing rows of its label only. Their scores bound the negatives' scores,
and the second collects the best rows of other labels within those bounds; what is below the worst
kept so far never leaves its matrix. A task keeps as many rows per anchor and positive as are asked
for, so ties and copies cost nothing. A block's result is written and its broadcasts are released
before the next begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonetide.llm.shared import stored
from tonetide.sources.stages import shared_dir

ANCHOR_BLOCK = 4096
_CELLS = 1 << 20
_DOUBLE_BITS = 53
_MOST = (1 << 63) - 1


def fields(n: int, left: int, right: int) -> tuple[int, int]:
    """Bits of a field for sums of ``n`` products up to left * right, and fields in a double."""
    width = (n * max(1, left) * max(1, right)).bit_length()
    return width, _DOUBLE_BITS // width


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors given as doubles; beyond 64 bits they saturate."""
    n = anchors.shape[1]
    if not n or not len(anchors) or not len(rows):
        return np.zeros((len(anchors), len(rows)), np.int64)
    low = int(anchors.min()), int(rows.min())
    width, count = fields(n, int(anchors.max()) - low[0], int(rows.max()) - low[1])
    most = [max(1, int(np.abs(x).max())) for x in (anchors, rows)]
    if max(most) >= 1 << 45 or n * most[0] * most[1] >= 1 << 62:
        count = 0  # biases would not be exact
    if count < 2:
        return _wide(anchors, rows, low, width)
    a, c = anchors - low[0], rows - low[1]
    words = -(-len(c) // count)
    packed = np.zeros((words, n))
    for field in range(count):
        part = c[field * words : (field + 1) * words]
        packed[: len(part)] += part * 2.0 ** (width * field)
    sums = (a @ packed.T).astype(np.int64)  # a multiplication per word and anchor component
    found = np.concatenate(
        [(sums >> (width * field)) & ((1 << width) - 1) for field in range(count)], axis=1
    )[:, : len(c)]
    # (a - x)(c - y) = ac - ya - xc + nxy, with the biases x and y.
    return found + (
        low[1] * a.sum(axis=1).astype(np.int64)[:, None]
        + low[0] * c.sum(axis=1).astype(np.int64)[None, :]
        + n * low[0] * low[1]
    )


def _wide(anchors: np.ndarray, rows: np.ndarray, low: tuple[int, int], width: int) -> np.ndarray:
    """The same with one Python integer per component for all rows."""
    size = -(-width // 8)
    a = [[int(x) - low[0] for x in v] for v in anchors]
    c = [[int(x) - low[1] for x in v] for v in rows]
    packed = [
        int.from_bytes(b"".join(x.to_bytes(size, "little") for x in column), "little")
        for column in zip(*c)
    ]
    n, c_sums = len(packed), [sum(v) for v in c]
    out = np.empty((len(a), len(c)), np.int64)
    for i, v in enumerate(a):
        whole = sum(x * word for x, word in zip(v, packed)).to_bytes(size * len(c), "little")
        more = low[1] * sum(v) + n * low[0] * low[1]
        for j, c_sum in enumerate(c_sums):
            exact = int.from_bytes(whole[j * size : (j + 1) * size], "little") + more + low[0] * c_sum
            out[i, j] = max(-_MOST, min(_MOST, exact))
    return out


class _Best:
    """The k best (score, then smaller id) of each of n slots."""

    def __init__(self, slots: int, k: int):
        self.k, self.waiting, self.size = k, [], 0
        self.kept = (np.zeros(0, np.int64),) * 3
        self.edge = np.full(slots, -_MOST - 1)  # no lower score can be among the best any more

    def add(self, slot: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        self.waiting.append((slot, ids, score))
        self.size += len(slot)
        if self.size > max(len(self.kept[0]), _CELLS // 16):
            self.settle()

    def settle(self) -> None:
        slot, ids, score = (np.concatenate(x) for x in zip(self.kept, *self.waiting))
        order = np.lexsort((ids, -score, slot))
        slot, ids, score = slot[order], ids[order], score[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        last = place == self.k - 1
        self.edge[slot[last]] = score[last]
        self.kept = tuple(x[place < self.k] for x in (slot, ids, score))
        self.waiting, self.size = [], 0

    def batch(self) -> pa.RecordBatch:
        self.settle()
        slot, ids, score = self.kept
        return pa.RecordBatch.from_pydict({"slot": slot.astype(np.int32), "vec_id": ids, "score": score})


class _Anchors:
    """A block's anchors, those of each length as a matrix; their numbers are slots."""

    def __init__(self, rows: list, scale: int):
        rows = sorted(rows, key=lambda r: len(r["embedding"]))
        self.ids = np.array([r["vec_id"] for r in rows], dtype=np.int64)
        self.labels = np.array([r["label"] for r in rows], dtype=np.int64)
        size = np.array([len(r["embedding"]) for r in rows])
        self.of_size = {}
        for n in np.unique(size).tolist():
            at = np.flatnonzero(size == n)
            matrix = np.array([rows[i]["embedding"] for i in at], dtype=np.float64).reshape(len(at), n)
            self.of_size[n] = (at, np.floor(scale * matrix))


def _blocks(batches: Iterator[pa.RecordBatch], anchors: _Anchors, scale: int):
    """Length, ids, labels and integer vectors of some rows at a time, if anchors have that length."""
    for batch in batches:
        column = batch.column("embedding")
        size = np.diff(column.offsets.to_numpy()).astype(np.int64)
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        start = np.cumsum(size) - size
        ids, labels = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
        for n in np.unique(size).tolist():
            if n not in anchors.of_size:
                continue
            rows = np.flatnonzero(size == n)
            step = max(1, _CELLS // len(anchors.of_size[n][0]))
            for i in range(0, len(rows), step):
                some = rows[i : i + step]
                vectors = np.floor(scale * flat[start[some][:, None] + np.arange(n)])
                yield n, ids[some], labels[some], vectors


def _positives(block, scale: int, k: int):
    """A task's best rows of each anchor's label, other than the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = block.value
        best = _Best(len(anchors.ids), k)
        for n, ids, labels, rows in _blocks(batches, anchors, scale):
            at, matrix = anchors.of_size[n]
            own_labels = anchors.labels[at]
            for label in np.intersect1d(own_labels, labels):
                chosen, own = np.flatnonzero(own_labels == label), np.flatnonzero(labels == label)
                mine = at[chosen]
                s = scores(matrix[chosen], rows[own])
                keep = (s >= best.edge[mine][:, None]) & (anchors.ids[mine][:, None] != ids[own])
                i, j = np.nonzero(keep)
                best.add(mine[i], ids[own[j]], s[i, j])
        yield best.batch()

    return run


def _negatives(block, bounds, scale: int, k: int):
    """A task's best rows of other labels between the bounds of each positive.

    Slots are the positives of one anchor after the other; ``first`` says where each begins.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, (first, low, high) = block.value, bounds.value
        best = _Best(len(low), k)
        for n, ids, labels, rows in _blocks(batches, anchors, scale):
            at, matrix = anchors.of_size[n]
            s = scores(matrix, rows)
            other = anchors.labels[at][:, None] != labels
            for place in range(int(np.diff(first).max(initial=0))):
                slot = first[at] + place
                has = np.flatnonzero(slot < first[at + 1])
                slot = slot[has]
                floor = np.maximum(low[slot], best.edge[slot])
                own = s[has]
                keep = other[has] & (own >= floor[:, None]) & (own <= high[slot][:, None])
                i, j = np.nonzero(keep)
                best.add(slot[i], ids[j], own[i, j])
        yield best.batch()

    return run


def _first(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each slot, numbered from 1."""
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def least_score(score: np.ndarray, percent: int) -> np.ndarray:
    """The least whole number of which 100 times is at least ``percent`` times ``score``."""
    return score // 100 * percent + -(-(score % 100 * percent) // 100)


def usable(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id label embedding`` of the rows that take part.

    Those have an id and a label, and every component is a number that stays finite when scaled.
    """
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < F.lit(float("inf"))),
    )
    return vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding"
    )


def mine(
    vectors: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    percent: int = 80,
    scale: int = 256,
    label: Column | None = None,
) -> DataFrame:
    """``anchor_id positive_id rank negative_id positive_score negative_score``, a row per negative.

    Each component x counts as floor(scale * x). An anchor's positives are the best ``positives``
    other rows of its label; a positive's negatives the best ``negatives`` rows of other labels
    that score from ``percent`` hundredths of its score up to that score. Ties go to the smaller
    ``vec_id``. Fewer rows give all there are; a negative positive score leaves no room.

    ``label`` replaces the column ``label``. Rows with null ids, labels, vectors or components, or
    components that are not finite, take no part; vectors are compared with those of their length.
    Rows of the anchor's own id are not its positives or negatives; other rows that share an id
    each count, an anchor id that occurs more than once is the row of least label and vector. Scores
    saturate at 64 bits, and saturated ones tie. Empty input gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    chosen = vectors if label is None else vectors.withColumn("label", label)
    rows = stored(usable(chosen, scale))
    anchors = stored(
        rows.where(anchor).groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("row"))
    )
    cores = spark.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < cores:
        rows = rows.repartition(cores)
    blocks = max(1, -(-anchors.count() // ANCHOR_BLOCK))
    out, some = shared_dir(spark), False
    for number in range(blocks):
        own = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number)
        found = own.select("vec_id", "row.label", "row.embedding").collect()
        if found:
            some = True
            block = _Anchors(found, scale)
            _mine_block(rows, block, positives, negatives, percent, scale, f"{out}/block-{number}")
    if not some:
        return spark.createDataFrame([], _FOUND)
    return spark.read.schema(_FOUND).option("recursiveFileLookup", True).parquet(out)


_FOUND = (
    "anchor_id long, positive_id long, rank int, negative_id long, "
    "positive_score long, negative_score long"
)


def _mine_block(
    rows: DataFrame, anchors: _Anchors, positives: int, negatives: int, percent: int, scale: int, path: str
) -> None:
    """Both passes for the anchors of one block, written to ``path``."""
    spark = rows.sparkSession
    block = spark.sparkContext.broadcast(anchors)
    found = rows.mapInArrow(_positives(block, scale, positives), _KEPT)
    best = _first(found, positives).sort("slot", "rank").toArrow()  # at most block x positives rows
    slot, ids, score = (best[c].to_numpy() for c in ("slot", "vec_id", "score"))
    first = np.searchsorted(slot, np.arange(len(anchors.ids) + 1))
    bounds = spark.sparkContext.broadcast((first, least_score(score, percent), score))
    names = spark.createDataFrame(
        list(zip(range(len(slot)), anchors.ids[slot].tolist(), ids.tolist(), score.tolist())),
        "slot int, anchor_id long, positive_id long, positive_score long",
    )
    near = _first(rows.mapInArrow(_negatives(block, bounds, scale, negatives), _KEPT), negatives)
    named = near.join(F.broadcast(names), "slot").select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
    named.write.parquet(path)
    block.destroy()
    bounds.destroy()


_KEPT = "slot int, vec_id long, score long"
