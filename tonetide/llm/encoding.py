"""Token ids of whole texts, each distinct piece of a task's texts encoded once.

A text is cut before a space that stands between two characters that are neither white space nor
U+2581. No token of the tokenizers used here crosses such a cut: the byte-level one splits texts
there before it merges, and no piece of the other holds its space mark behind another character
(``piece_bpe`` checks that). So the ids of a text are those of its pieces, one after the other, and
a text of any length is encoded in parts of the size of a word.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tonetide.llm.words import ranges

CUT = re.compile(r"(?<=[^\s\u2581]) (?=[^\s\u2581])")
# A space that is no such cut.
ODD = re.compile(r" (?:[\s\u2581]|\Z|(?<=\A )|(?<=[\s\u2581] ))")
MEMORY_PIECES = 1 << 19
_JOINED = 1 << 12

Encode = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


def _flat(lists: Iterable[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lists = list(lists)
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(counts.sum())), counts


class ByteBpe:
    """A byte-level tokenizer file of the tokenizers library."""

    def __init__(self, path: str, special_text: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_text
        # Byte-level entries write each byte as one character, in this order of the alphabet.
        letters = {c: i for i, c in enumerate(_byte_letters(pre_tokenizers.ByteLevel.alphabet()))}
        self.bytes = [b""] * self.tokenizer.get_vocab_size()
        for entry, i in self.tokenizer.get_vocab().items():
            self.bytes[i] = bytes(letters[c] for c in entry)
        self.sizes = np.array([len(b) for b in self.bytes], dtype=np.int64)

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat(e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False))

    def spaced(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each piece behind a space; many pieces go through the tokenizer as one text."""
        text = " ".join(["", *pieces])
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1)
        body = np.frombuffer(text.encode(), np.uint8)
        letters = np.append(np.flatnonzero((body & 0xC0) != 0x80), len(body))
        cuts = np.searchsorted(ends, np.arange(_JOINED, len(text) + _JOINED, _JOINED))
        cuts = np.unique(ends[np.minimum(cuts, len(ends) - 1)]).tolist()
        ids, _ = self.texts([text[i:j] for i, j in zip([0, *cuts], cuts)])
        found, wanted = np.cumsum(self.sizes[ids]), letters[ends]
        last = np.searchsorted(found, wanted)
        if last[-1] < len(found) and np.array_equal(found[last], wanted):
            return ids, np.diff(last + 1, prepend=0)
        return self.texts([" " + p for p in pieces])


def _byte_letters(alphabet: list[str]) -> list[str]:
    """The letter of each byte: printable Latin-1 stands for itself, the others follow U+0100 on."""
    own = [c for c in map(chr, range(256)) if c in alphabet]
    extra = iter(sorted(set(alphabet) - set(own)))
    return [chr(i) if chr(i) in own else next(extra) for i in range(256)]


class PieceBpe:
    """A byte-fallback model of the sentencepiece library; the model itself adds the space."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(re.search("[^▁]▁", n) for n in names):
            raise ValueError(f"{path} has pieces that run over a space")
        self.bytes = [
            bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode()
            for i, n in enumerate(names)
        ]
        self.sizes = np.array([len(b) for b in self.bytes], dtype=np.int64)

    def spaced(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat(self.model.encode(pieces, num_threads=1))


@lru_cache(maxsize=4)
def byte_bpe(path: str, special_text: bool = True) -> ByteBpe:
    """``special_text``: the strings of special tokens inside texts are ordinary text."""
    return ByteBpe(path, special_text)


@lru_cache(maxsize=4)
def piece_bpe(path: str) -> PieceBpe:
    return PieceBpe(path)


class _Numbers(dict):
    """Numbers strings in the order in which they are first asked for."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self.new.append(piece)
        return number


class Pieces:
    """Remembers the ids of pieces, ``MEMORY_PIECES`` (fewer for two encoders) and those of one call.

    When there are more, only pieces stay that were asked for again.
    """

    def __init__(self, *encoders: Encode):
        self.encoders = encoders
        self.limit = 2 * MEMORY_PIECES // (1 + len(encoders))
        self.numbers = _Numbers()
        self.used = np.zeros(0, np.int64)
        self.known = [(np.zeros(0, np.int32), np.zeros(0, np.int32)) for _ in encoders]

    def _forget(self) -> None:
        kept = np.flatnonzero(self.used > 1)
        if len(kept) > self.limit // 2:
            kept = kept[:0]
        names = list(self.numbers)
        self.numbers = _Numbers()
        self.numbers.update((names[i], n) for n, i in enumerate(kept.tolist()))
        self.used = np.zeros(len(kept), np.int64)
        self.known = [_taken(*known, kept) for known in self.known]

    def encode(
        self, pieces: list[str], uses: np.ndarray | None = None
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each encoder the ids of all pieces in a row, and how many each piece has.

        With ``uses``, the pieces are distinct, and those in these places are asked for.
        """
        if len(self.numbers) > self.limit:
            self._forget()
        if uses is None:
            at = np.fromiter(map(self.numbers.__getitem__, pieces), np.int64, len(pieces))
            new, self.numbers.new = self.numbers.new, []
        else:
            at = np.fromiter(map(self.numbers.get, pieces, repeat(-1)), np.int64, len(pieces))
            unknown, known = np.flatnonzero(at < 0), len(self.numbers)
            new = [pieces[i] for i in unknown.tolist()]
            at[unknown] = np.arange(known, known + len(new))
            self.numbers.update(zip(new, at[unknown].tolist()))
        if new:
            more = [encode(new) for encode in self.encoders]
            self.known = [
                tuple(np.concatenate((x, y.astype(np.int32))) for x, y in zip(known, found))
                for known, found in zip(self.known, more)
            ]
            self.used = np.append(self.used, np.zeros(len(new), np.int64))
        if uses is not None:
            at = at[uses]
        self.used += np.bincount(at, minlength=len(self.used))
        return [tuple(x.astype(np.int64) for x in _taken(*known, at)) for known in self.known]


def _taken(flat: np.ndarray, counts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists numbered ``at`` out of flat lists."""
    starts = np.cumsum(counts, dtype=np.int64) - counts
    return flat[ranges(starts[at], counts[at].astype(np.int64))], counts[at]


def cut(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The pieces of all texts, and how many each text has."""
    parts = [CUT.split(t) if ODD.search(t) else t.split(" ") for t in texts]
    return list(chain.from_iterable(parts)), np.fromiter(map(len, parts), np.int64, len(parts))


def cut_distinct(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pieces of all texts, where in them each piece is, and how many each text has."""
    odd = np.fromiter((ODD.search(t) is not None for t in texts), bool, len(texts))
    whole = pa.array(texts, pa.large_string())
    parts = pc.split_pattern(whole.filter(pa.array(~odd)), " ")
    pieces, n = parts.flatten(), np.zeros(len(texts), np.int64)
    n[~odd] = np.diff(parts.offsets.to_numpy())
    if odd.any():
        others, n[odd] = cut([texts[i] for i in np.flatnonzero(odd)])
        pieces = pa.concat_arrays([pieces, pa.array(others, pa.large_string())])
    found = pieces.dictionary_encode()
    places = np.empty(len(pieces), np.int64)
    order = np.concatenate((np.flatnonzero(~odd), np.flatnonzero(odd)))
    places[ranges((np.cumsum(n) - n)[order], n[order])] = found.indices.to_numpy()
    return found.dictionary.to_numpy(zero_copy_only=False), places, n


class Texts:
    """Ids of whole texts as they are, without a space before them."""

    def __init__(self, tokenizer: ByteBpe):
        self.first, self.later = Pieces(tokenizer.texts), Pieces(tokenizer.spaced)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has."""
        distinct, places, n = cut_distinct(texts)
        first = np.zeros(len(places), dtype=bool)
        first[np.cumsum(n) - n] = True
        parts = []
        for memory, chosen in ((self.first, first), (self.later, ~first)):
            asked = np.bincount(places[chosen], minlength=len(distinct)) > 0
            uses = (np.cumsum(asked) - 1)[places[chosen]]
            parts.append((chosen, *memory.encode(distinct[asked].tolist(), uses)[0]))
        counts = np.zeros(len(places), np.int64)
        for chosen, _, own in parts:
            counts[chosen] = own
        starts = np.cumsum(counts) - counts
        ids = np.empty(int(counts.sum()), np.int64)
        for chosen, own_ids, own in parts:
            ids[ranges(starts[chosen], own)] = own_ids
        return ids, sums_by(counts, n)


@lru_cache(maxsize=1)
def byte_texts(path: str) -> Texts:
    """One memory for all tasks of a Python worker; strings of special tokens are special."""
    return Texts(byte_bpe(path, special_text=False))


@lru_cache(maxsize=1)
def two_kinds(a_path: str, b_path: str) -> Pieces:
    """The same for the pieces of two tokenizers, strings of special tokens as plain text."""
    return Pieces(byte_bpe(a_path).spaced, piece_bpe(b_path).spaced)


def sums_by(counts: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Sum of ``counts`` over consecutive groups of the given sizes."""
    total = np.concatenate(([0], np.cumsum(counts)))
    ends = np.cumsum(groups)
    return total[ends] - total[ends - groups]
