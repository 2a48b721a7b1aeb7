"""Token ids in Arrow files: equal-length sequences and masks, read without copying.

Documents are ordered by id and dealt over shards by ranges of it. A shard is two files in Arrow's
file format, which is its stream format between a mark and a footer of batch places. One holds the
shard's ids one after the other, cut into sequences of ``length``: record batches of ``BATCH`` rows
with the columns ``ids`` (fixed-size lists of 16- or 32-bit numbers) and ``mask`` (fixed-size lists
of bits, false where the last sequence is filled up). All batches but the last have one size, so the
place of a sequence follows by division, and a memory-mapped file gives it as a view. The other
file says where each document begins and how many ids it has.

``manifest.json`` lists the shards that count. Tasks write files under names of their own and return
them, so what a lost or repeated task leaves behind is in no manifest.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonetide.llm.encoding import byte_bpe, byte_texts
from tonetide.llm.shared import stored
from tonetide.llm.words import chunks, valid
from tonetide.sources.stages import _write_text

LENGTH = 2048
BATCH = 64
# Bytes of text encoded at once: the more, the fewer equal pieces are asked for again.
TEXT_BYTES = 4 << 20
MANIFEST = "manifest.json"
_SHARD = "shard int, documents_file string, ids_file string, documents long, ids long, sequences long"


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder, which may be a local path or an address."""
    if folder.startswith("file:") and not folder.startswith("file://"):
        folder = "file://" + folder.removeprefix("file:")
    return pafs.FileSystem.from_uri(folder)


class _Writer:
    """Cuts a stream of ids into sequences and writes them in batches of ``BATCH``."""

    def __init__(self, sink, length: int, kind: pa.DataType):
        self.length, self.kind = length, kind
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.held = np.zeros(0, kind.to_pandas_dtype())
        self.ids = self.sequences = 0

    def add(self, ids: np.ndarray) -> None:
        self.ids += len(ids)
        flat = np.concatenate((self.held, ids.astype(self.held.dtype)))
        step = self.length * BATCH
        whole = len(flat) // step * step
        for at in range(0, whole, step):
            self._write(flat[at : at + step], step)
        self.held = flat[whole:].copy()

    def _write(self, ids: np.ndarray, used: int) -> None:
        lists = [
            pa.FixedSizeListArray.from_arrays(pa.array(ids, self.kind), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(ids)) < used), self.length),
        ]
        self.writer.write_batch(pa.record_batch(lists, schema=self.schema))
        self.sequences += len(lists[0])

    def close(self) -> None:
        if len(self.held):
            filled = np.zeros(-(-len(self.held) // self.length) * self.length, self.held.dtype)
            filled[: len(self.held)] = self.held
            self._write(filled, len(self.held))
        self.writer.close()


def _written(folder: str, path: str, length: int, end_id: int):
    """A task: its documents to the two files of a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = byte_bpe(path, special_text=False)
        small = max(len(tokenizer.bytes) - 1, end_id) < 1 << 16
        encoder, shard, documents = byte_texts(path), TaskContext.get().partitionId(), 0
        names = [f"shard-{shard:06d}-{uuid.uuid4().hex}-{x}.arrow" for x in ("documents", "ids")]
        files, base = _store(folder)
        sinks, sequences, index = [], None, None
        for batch in chunks(batches, size=TEXT_BYTES):
            if sequences is None:
                files.create_dir(base, recursive=True)
                sinks = [files.open_output_stream(f"{base}/{name}") for name in names]
                sequences = _Writer(sinks[1], length, pa.uint16() if small else pa.uint32())
                kinds = [("doc_id", batch.column("doc_id").type), ("start", pa.int64()), ("n_tokens", pa.int64())]
                columns = pa.schema(kinds)
                index = pa.ipc.new_file(sinks[0], columns)
            ids, counts = encoder.encode([t or "" for t in valid(batch.column("text")).to_pylist()])
            ids = np.insert(ids, np.cumsum(counts), end_id)
            counts = counts + 1
            starts = sequences.ids + np.cumsum(counts) - counts
            rows = [batch.column("doc_id"), pa.array(starts), pa.array(counts)]
            index.write_batch(pa.record_batch(rows, schema=columns))
            sequences.add(ids)
            documents += len(counts)
        if sequences is None:
            return
        for closing in (sequences, index, *sinks):
            closing.close()
        totals = {"documents": documents, "ids": sequences.ids, "sequences": sequences.sequences}
        yield pa.RecordBatch.from_pydict(
            {"shard": pa.array([shard], pa.int32()), "documents_file": names[:1], "ids_file": names[1:]}
            | {name: [n] for name, n in totals.items()}
        )

    return run


def write(
    docs: DataFrame,
    folder: str,
    path: str,
    length: int = LENGTH,
    end_id: int = 2,
    shards: int | None = None,
) -> list[dict]:
    """Encode whole texts and write them in ascending order of ``doc_id``; returns the shards.

    ``path`` is a tokenizer file that executors can read; texts are encoded as they are, strings of
    special tokens as these, and ``end_id`` follows each document. ``folder`` is a new one on storage
    that driver and executors reach, through pyarrow's file systems. Null texts are empty. Null ids
    come first; rows of equal id stand in the order of a hash of their text, and may lie in several
    shards. Without rows there are no shards. ``shards`` defaults to the number of parts in which Spark reads ``docs``, or its cores.
    """
    spark = docs.sparkSession
    if shards is None:
        shards = max(spark.sparkContext.defaultParallelism, docs.rdd.getNumPartitions())
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("__hash"))
    # The last key parts rows that are equal in both others, however many there are.
    rows = rows.withColumn("__row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(shards, "doc_id", "__hash", "__row")
    ordered = ordered.sortWithinPartitions("doc_id", "__hash").select("doc_id", "text")
    made = stored(ordered.mapInArrow(_written(folder, path, length, end_id), _SHARD))
    manifest = [row.asDict() for row in made.sort("shard").collect()]  # two names and four numbers each
    kind = docs.schema["doc_id"].dataType.simpleString()
    told = {"length": length, "end_id": end_id, "doc_id": kind, "shards": manifest}
    _write_text(spark, f"{folder}/{MANIFEST}", json.dumps(told))
    return manifest


class Shard:
    """The two files of a shard; memory-mapped where the storage is local."""

    def __init__(self, folder: str, ids_file: str, documents_file: str):
        files, base = _store(folder)

        def opened(name: str):
            local = isinstance(files, pafs.LocalFileSystem)
            path = f"{base}/{name}"
            return pa.ipc.open_file(pa.memory_map(path) if local else files.open_input_file(path))

        self.reader, self.documents = opened(ids_file), opened(documents_file)
        self.length = self.reader.schema.field("ids").type.list_size
        self._at, self._batch = -1, None

    def _of(self, sequence: int) -> tuple[pa.RecordBatch, int]:
        at, row = divmod(sequence, BATCH)
        if at != self._at:
            self._at, self._batch = at, self.reader.get_batch(at)
        return self._batch, row

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of a sequence, both views of the file."""
        batch, row = self._of(i)
        ids, mask = (
            batch.column(c).values.slice((batch.column(c).offset + row) * self.length, self.length)
            for c in ("ids", "mask")
        )
        return ids.to_numpy(zero_copy_only=True), mask

    def runs(self, start: int, size: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` on, as views of one batch each."""
        step, end = self.length * BATCH, start + size
        while start < end:
            batch, _ = self._of(start // self.length)
            flat = batch.column("ids").flatten().to_numpy(zero_copy_only=True)
            skip = start % step
            yield flat[skip : skip + end - start]
            start += min(end - start, step - skip)

    def used(self) -> int:
        """Ids that the masks mark as such."""
        counted = (self.reader.get_batch(i).column("mask") for i in range(self.reader.num_record_batches))
        return sum(mask.flatten().true_count for mask in counted)


class Sequences:
    """Random access to all sequences of a folder, shards opened when they are first read."""

    def __init__(self, spark: SparkSession, folder: str):
        self.folder, self.manifest = folder, read_manifest(spark, folder)
        self.ends = np.cumsum([s["sequences"] for s in self.manifest["shards"]], dtype=np.int64)
        self.open: dict[int, Shard] = {}

    def __len__(self) -> int:
        return int(self.ends[-1]) if len(self.ends) else 0

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        if not 0 <= i < len(self):
            raise IndexError(i)
        k = int(np.searchsorted(self.ends, i, "right"))
        if k not in self.open:
            s = self.manifest["shards"][k]
            self.open[k] = Shard(self.folder, s["ids_file"], s["documents_file"])
        return self.open[k].sequence(i - (int(self.ends[k - 1]) if k else 0))


def read_manifest(spark: SparkSession, folder: str) -> dict:
    text = spark.read.text(f"{folder}/{MANIFEST}", wholetext=True).first()
    return json.loads(text[0])


def _digested(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(folder, row["ids_file"], row["documents_file"])
                if shard.used() != row["ids"]:
                    raise ValueError(f"{row['ids_file']} does not hold {row['ids']} ids")
                for i in range(shard.documents.num_record_batches):
                    docs = shard.documents.get_batch(i)
                    crcs = []
                    for start, n in zip(docs.column("start").to_pylist(), docs.column("n_tokens").to_pylist()):
                        crc = 0
                        for run_ids in shard.runs(start, n):
                            crc = zlib.crc32(run_ids.astype("<u4"), crc)
                        crcs.append(crc)
                    starts = docs.column("start").to_numpy() + row["base"]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": docs.column("doc_id"),
                            "start": starts,
                            "n_tokens": docs.column("n_tokens"),
                            "ids_crc32": pa.array(crcs, pa.int64()),
                        }
                    )

    return run


def digest(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id start n_tokens ids_crc32`` of every document, read from the files of ``folder``.

    ``start`` counts the ids of all documents before it; the sum is over the unsigned 32-bit ids with
    the end id. A shard is a task; masks that do not mark the ids of the manifest are an error.
    """
    manifest = read_manifest(spark, folder)
    schema = f"doc_id {manifest['doc_id']}, start long, n_tokens long, ids_crc32 long"
    base, rows = 0, []
    for shard in manifest["shards"]:
        rows.append((shard["ids_file"], shard["documents_file"], shard["ids"], base))
        base += shard["ids"]
    listed = spark.createDataFrame(rows, "ids_file string, documents_file string, ids long, base long")
    return listed.repartition(max(1, len(rows))).mapInArrow(_digested(folder), schema)
