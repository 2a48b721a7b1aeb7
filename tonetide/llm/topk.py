"""Exact top-k search by inner product with a three-phase uniform threshold.

The components of a vector are cut into lists; a list holds every vector's partial score. Phase 1
gathers the best entries of each list, by row, and each list's least score. Measured from these least scores,
partial sums are lower bounds of whole scores; the k-th best of them, divided by the number of
lists, is a cutoff that a vector among the k best must pass in at least one list. Phase 2 broadcasts
the cutoffs and collects entries that pass, without those whose upper bound (own scores, and the
cutoff for every other list) stays below. Phase 3 resolves the others' remaining scores.

Rows stay where Spark read them; queries are sent in blocks of bounded size, one pass over the
vectors per block and phase. Each task keeps the k best only, so ties and repeats cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonetide.llm.shared import stored

LISTS = 4
QUERY_BLOCK = 2048
_ROWS = 512


def integer_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id`` and ``v``, each component as floor(scale * x) with x as double.

    Rows are left out if the id or the vector is null, or a component is null or not finite.
    """
    usable = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vectors.where(F.col("vec_id").isNotNull() & usable).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"),
    )


def _matrices(batch: pa.RecordBatch, key: str = "vec_id") -> Iterator[tuple[np.ndarray, ...]]:
    """Ids, vectors and column ``key`` of a batch, vectors of each length apart."""
    ids, keys = batch.column("vec_id").to_numpy(), batch.column(key).to_numpy()
    column = batch.column("v")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    size = np.diff(column.offsets.to_numpy()).astype(np.int64)
    start = np.concatenate(([0], np.cumsum(size)))
    for n in np.unique(size):
        rows = np.flatnonzero(size == n)
        yield ids[rows], flat[start[rows][:, None] + np.arange(n)], keys[rows]


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Integer inner products, as doubles (BLAS) where whole scores are exact in them."""
    return q @ v.T


def _exact(q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles if every whole score and partial sum is exact in them."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(1, q.shape[1])
    return (q.astype(np.float64), v.astype(np.float64)) if most < 2.0**52 else (q, v)


def _lists(n: int) -> list[slice]:
    cuts = np.linspace(0, n, LISTS + 1).astype(int)
    return [slice(a, b) for a, b in zip(cuts, cuts[1:])]


class _Best:
    """The k best (score, then smaller id or row) of each of n queries, over blocks of entries."""

    def __init__(self, k: int):
        self.k = k
        self.q = self.id = self.s = np.zeros(0, np.int64)

    def add(self, q: np.ndarray, ids: np.ndarray, s: np.ndarray) -> None:
        q, ids, s = (np.concatenate(x) for x in ((self.q, q), (self.id, ids), (self.s, s)))
        order = np.lexsort((ids, -s, q))
        q, ids, s = q[order], ids[order], s[order]
        first = np.searchsorted(q, q, "left")
        keep = np.arange(len(q)) - first < self.k
        self.q, self.id, self.s = q[keep], ids[keep], s[keep]


def _top(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the entries not below each row's k-th best score, ties included."""
    if scores.shape[1] > k:
        edge = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
        return np.nonzero(scores >= edge[:, None])
    return tuple(x.ravel() for x in np.indices(scores.shape))


_FAR = np.int64(-(1 << 62))


def _gather(ids: np.ndarray, queries: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    """Phase 1 in a task: each list's k best entries and least score, by query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {part: _Best(k) for part in range(LISTS)}
        least = np.full((LISTS, len(ids)), -_FAR)
        for batch in batches:
            for vec_ids, v, rows in _matrices(batch, "row"):
                if v.shape[1] not in queries:
                    continue
                at, q = queries[v.shape[1]]
                q, v = _exact(q, v)
                for i in range(0, len(v), _ROWS):
                    own = ids[at][:, None] == vec_ids[i : i + _ROWS][None, :]
                    for part, cut in enumerate(_lists(v.shape[1])):
                        s = _scores(q[:, cut], v[i : i + _ROWS, cut])
                        s[own] = -_FAR
                        low = s.min(axis=1).astype(np.int64)
                        least[part, at] = np.minimum(least[part, at], low)
                        s[own] = _FAR
                        row, col = _top(s, k)
                        keep = s[row, col] > _FAR
                        row, col = row[keep], col[keep]
                        best[part].add(at[row], rows[i + col], s[row, col].astype(np.int64))
        for part, b in best.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "q": b.q.astype(np.int32),
                    "part": np.full(len(b.q), part, np.int32),
                    "row": b.id,
                    "s": b.s,
                    "least": least[part, b.q],
                }
            )

    return run


def _collect(
    ids: np.ndarray, queries: dict[int, tuple[np.ndarray, np.ndarray]], cutoff, total, k: int
):
    """Phases 2 and 3 in a task. ``cutoff`` by list and query, ``total`` by query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(k)
        for batch in batches:
            for vec_ids, v, _ in _matrices(batch):
                if v.shape[1] not in queries:
                    continue
                at, q = queries[v.shape[1]]
                q, v = _exact(q, v)
                cuts = _lists(v.shape[1])
                for i in range(0, len(v), _ROWS):
                    block, block_ids = v[i : i + _ROWS], vec_ids[i : i + _ROWS]
                    passed = np.zeros((len(at), len(block)), dtype=bool)
                    bound = np.zeros((len(at), len(block)))
                    lists = []
                    for part, cut in enumerate(cuts):
                        s = _scores(q[:, cut], block[:, cut])
                        edge = cutoff[part, at][:, None]
                        passed |= s >= edge
                        bound += np.maximum(s, edge)
                        lists.append(s)
                    passed &= bound >= total[at][:, None]
                    passed &= ids[at][:, None] != block_ids[None, :]
                    row, col = np.nonzero(passed)
                    if len(row):
                        s = sum(x[row, col] for x in lists).astype(np.int64)
                        keep = s >= total[at][row]
                        best.add(at[row[keep]], block_ids[col[keep]], s[keep])
        yield pa.RecordBatch.from_pydict({"q": best.q.astype(np.int32), "vec_id": best.id, "s": best.s})

    return run


def search(vectors: DataFrame, query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """``query_id rank vec_id score``: the k best of all rows for the rows that ``query`` names.

    Scores are inner products of integer vectors (see ``integer_vectors``), ties go to the smaller
    ``vec_id``. Only vectors of the query's length are compared. Rows with the query's own id are no
    candidates; a query id that occurs more than once is searched with its least vector. Candidates
    that repeat an id count as rows of their own. Empty input gives no rows.
    """
    spark = vectors.sparkSession
    table = stored(integer_vectors(vectors, scale))
    asked = stored(table.where(query).groupBy("vec_id").agg(F.min("v").alias("v")))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    found = []
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).collect()
        ids = np.array([r["vec_id"] for r in rows], dtype=np.int64)
        by_size: dict[int, list[int]] = {}
        for i, r in enumerate(rows):
            by_size.setdefault(len(r["v"]), []).append(i)
        queries = {
            n: (np.array(at), np.array([rows[i]["v"] for i in at], dtype=np.int64).reshape(len(at), n))
            for n, at in by_size.items()
        }
        if not rows:
            continue
        # Ids may repeat, so bounds are summed by row.
        gathered = table.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
            _gather(ids, queries, k), "q int, part int, row long, s long, least long"
        )
        low, need = _cutoffs(stored(gathered), len(ids), k)
        cutoff = low + (need - low.sum(axis=0))[None, :] / LISTS
        part = table.mapInArrow(
            _collect(ids, queries, np.floor(cutoff), need, k), "q int, vec_id long, s long"
        )
        names = spark.createDataFrame([(i, int(x)) for i, x in enumerate(ids)], "q int, query_id long")
        found.append(part.join(F.broadcast(names), "q"))
    schema = "query_id long, rank int, vec_id long, score long"
    if not found:
        return spark.createDataFrame([], schema)
    every = found[0]
    for other in found[1:]:
        every = every.unionByName(other)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("s"), "vec_id"))
    return (
        every.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", F.col("s").alias("score"))
    )


def _cutoffs(gathered: DataFrame, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Least score by list and query, and by query a score that k candidates reach for sure."""
    mine = Window.partitionBy("q", "part")
    lists = gathered.withColumn("least", F.min("least").over(mine)).withColumn(
        "__place", F.row_number().over(mine.orderBy(F.desc("s"), "row"))
    )
    above = (
        lists.where(F.col("__place") <= k)
        .groupBy("q", "row")
        .agg(F.sum(F.col("s") - F.col("least")).alias("above"))
    )
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("above")))
    kth = above.withColumn("__place", place).where(F.col("__place") == k)
    low = np.zeros((LISTS, n))
    for r in lists.groupBy("q", "part").agg(F.min("least").alias("least")).collect():
        low[r["part"], r["q"]] = r["least"]
    need = low.sum(axis=0)  # with fewer than k candidates, all are collected
    for r in kth.select("q", "above").collect():
        need[r["q"]] += r["above"]
    return low, need
