"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1. An n-gram is the product (binding) of its
letters' vectors, each permuted (rotated) by its place in the n-gram. A text is the sum (bundling)
of its n-grams, a language the sum of its training texts at unit length. A text gets the language
whose prototype has the greatest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonetide.llm.shared import bounded_sample, held_out
from tonetide.llm.words import chunks, code_points, mixed, valid

DIMENSIONS = 1024
GRAM = 3
SAMPLE_PER_LANGUAGE = 1024
MOST_LANGUAGES = 10_000
UNKNOWN = "und"
_ROWS = 128
# Distinct grams whose vectors are held at a time, 5 KB each.
_GRAMS = 1 << 14
_CHUNK = 2 << 20
_UNIT = 1 << 24


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    table = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    table.flags.writeable = False
    return table


def letter_vectors(points: np.ndarray) -> np.ndarray:
    """The +1/-1 vector of each code point: bits of a hash, so every task makes the same."""
    words = np.arange(DIMENSIONS // 64, dtype=np.uint64)
    seeds = (points.astype(np.uint64)[:, None] << np.uint64(16)) + words[None, :]
    bits = np.unpackbits(mixed(mixed(seeds + np.uint64(1))).view(np.uint8), axis=1)
    return bits.astype(np.int8) * 2 - 1


def _symbols(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case letters with one gap (0) for each run of other characters, around the text too.

    Returns symbols, the row of each, and which rows hold a letter.
    """
    rows = len(column)
    column = pc.binary_join_element_wise(" ", pc.utf8_lower(pc.fill_null(column, "")), " ", "")
    points, first = code_points(column)
    letter = _letters()[points]
    previous = np.concatenate(([True], letter[:-1]))
    previous[first[:-1]] = True
    row = np.repeat(np.arange(rows), np.diff(first))
    with_letter = np.zeros(rows, dtype=bool)
    with_letter[row[letter]] = True
    keep = letter | previous
    return np.where(letter, points, 0)[keep], row[keep], with_letter


def text_vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One vector per text, and which texts hold a letter."""
    symbols, row, with_letter = _symbols(column)
    known, local = _compact(symbols)
    grams = np.zeros(max(0, len(symbols) - GRAM + 1), dtype=np.int64)
    for place in range(GRAM):
        grams = grams * len(known) + local[place : place + len(grams)]
    within = row[: len(grams)] == row[GRAM - 1 :] if len(grams) else np.zeros(0, bool)
    grams, row = grams[within], row[: len(within)][within]
    found, gram = _compact(grams)
    letters = letter_vectors(known)
    out = np.zeros((len(column), DIMENSIONS), dtype=np.float32)
    for start in range(0, len(found), _GRAMS):
        some = found[start : start + _GRAMS]
        inside = slice(None) if len(found) <= _GRAMS else (gram >= start) & (gram < start + _GRAMS)
        _add_grams(out, row[inside], gram[inside] - start, _gram_vectors(some, letters))
    return out, with_letter


def _gram_vectors(grams: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """The product of a gram's letter vectors: the last is not rotated, the one before by one, ..."""
    vectors = np.ones((len(grams), DIMENSIONS), dtype=np.int8)
    for place in range(GRAM):
        vectors *= np.roll(letters[grams % len(letters)], place, axis=1)
        grams = grams // len(letters)
    return vectors.astype(np.float32)


def _add_grams(out: np.ndarray, row: np.ndarray, gram: np.ndarray, vectors: np.ndarray) -> None:
    """Add each row's counts of grams times their vectors; rows ascend."""
    cuts = np.searchsorted(row, np.arange(0, len(out) + _ROWS, _ROWS))
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if a < b:
            at = (row[a:b] - i * _ROWS) * len(vectors) + gram[a:b]
            n = min(_ROWS, len(out) - i * _ROWS)
            counts = np.bincount(at, minlength=n * len(vectors)).reshape(n, len(vectors))
            out[i * _ROWS : i * _ROWS + n] += counts.astype(np.float32) @ vectors


def _compact(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and the place of each value among them."""
    top = int(values.max()) + 1 if len(values) else 0
    if top > 1 << 24:
        return np.unique(values, return_inverse=True)
    seen = np.zeros(top, dtype=bool)
    seen[values] = True
    place = np.cumsum(seen) - 1
    return np.flatnonzero(seen), place[values]


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = np.sqrt(np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64))
    return vectors / np.maximum(length, 1e-30)[:, None]


@dataclass(frozen=True)
class Profiles:
    languages: list[str]
    prototypes: np.ndarray  # one row of unit length per language


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in chunks(batches, size=_CHUNK):
        vectors, _ = text_vectors(valid(batch.column("text")))
        units = np.rint(_unit(vectors) * _UNIT).astype(np.int64)
        lang = np.array(batch.column("lang").to_pylist(), dtype=object)
        for name in set(lang):
            total[name] = total.get(name, 0) + units[lang == name].sum(axis=0)
    names = sorted(total)
    yield pa.RecordBatch.from_pydict(
        {
            "lang": pa.array(names, pa.string()),
            "parts": pa.array([total[n].tolist() for n in names], pa.list_(pa.int64())),
        }
    )


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Profiles:
    """Prototypes from ``text`` and ``lang`` of a bounded sample of each language.

    At most about ``per_language`` documents of each language are read, never held-out ones or
    ones without language or text. Sums are of whole numbers, so every run gives the same. More
    than ``MOST_LANGUAGES`` language values raise an error, since all profiles go to every task.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).where(
        ~held_out(F.col("doc_id"))
    )
    if usable.select("lang").distinct().limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    sample = bounded_sample(usable, "doc_id", F.col("lang"), per_language).select("lang", "text")
    sums = (
        sample.mapInArrow(_sums, "lang string, parts array<long>")
        .select("lang", F.posexplode("parts").alias("pos", "part"))
        .groupBy("lang", "pos")
        .agg(F.sum("part").alias("part"))
        .groupBy("lang")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "part"))).alias("__parts"))
        .select("lang", F.col("__parts.part").alias("v"))
        .orderBy("lang")
        .collect()
    )
    prototypes = np.array([r["v"] for r in sums], dtype=np.float64).reshape(-1, DIMENSIONS)
    return Profiles([r["lang"] for r in sums], _unit(prototypes).astype(np.float32))


def identify(
    docs: DataFrame,
    profiles: Profiles,
    keep_text: bool = True,
    language="lang_pred",
    score="score",
    letters: str | None = None,
) -> DataFrame:
    """Add the language of every whole text and its cosine (0 to 1), in one pass without shuffle.

    A null text, or one without a letter, gets ``und`` and 0. So does every text if nothing was
    learned, and ``und`` may be a learned language too; ``letters`` names a column that says whether
    a text has a letter. Equal cosines give the language first in order. Columns named like the new
    ones are replaced; all others stay.
    """
    kept = [f for f in docs.schema.fields if f.name not in (language, score, letters)]
    kept = [f for f in kept if keep_text or f.name != "text"]
    added = [T.StructField(language, T.StringType()), T.StructField(score, T.DoubleType())]
    added += [T.StructField(letters, T.BooleanType())] if letters else []
    schema = T.StructType([*kept, *added])
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*shared.value.languages, UNKNOWN], dtype=object)
        prototypes = shared.value.prototypes
        for batch in chunks(batches, size=_CHUNK):
            vectors, with_letter = text_vectors(valid(batch.column("text")))
            best, cosine = np.full(len(vectors), len(names) - 1), np.zeros(len(vectors))
            if len(prototypes):
                cosines = _unit(vectors) @ prototypes.T.astype(np.float64)
                best = np.where(with_letter, cosines.argmax(axis=1), best)
                cosine = np.where(with_letter, cosines.max(axis=1).clip(0, 1), 0.0)
            columns = [batch.column(f.name) for f in kept]
            columns += [pa.array(names[best], pa.string()), pa.array(cosine)]
            columns += [pa.array(with_letter)] if letters else []
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)
