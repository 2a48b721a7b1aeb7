"""Profiles of texts with very many distinct n-grams."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from tonetide.llm import language


def test_grams_in_slices_give_the_same_vectors(monkeypatch):
    texts = pa.array(["one small text", None, "", "12 34", "Ein zweiter Text, größer", "漢字と仮名", "ab"])
    whole, letters = language.text_vectors(texts)
    for size in (1, 3, 1000):
        monkeypatch.setattr(language, "_GRAMS", size)
        parts, again = language.text_vectors(texts)
        assert np.array_equal(whole, parts) and np.array_equal(letters, again)
    assert letters.tolist() == [True, False, False, False, True, True, True]


def test_memory_does_not_grow_by_distinct_gram():
    r = random.Random(1)
    text = "".join(chr(r.randrange(0x4E00, 0x9FFF)) for _ in range(300_000))
    tracemalloc.start()
    vectors, letters = language.text_vectors(pa.array([text * 4]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert letters[0] and np.abs(vectors).sum() > 0
    assert peak < 700e6  # 300,000 vectors alone would take 1.2 GB
