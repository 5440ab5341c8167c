"""Token ids of whole texts with a public tokenizer, by way of a table of the words a task has seen.

The tokenizer's words never hold white space, and its normalisation does not reach over a space. So the ids of a text
are the ids of its blank-separated chunks in a row, and each chunk needs to be encoded once per worker. Two steps keep
the chunks few and change no id: ASCII capitals are lowered, as the tokenizer does itself, and a full stop or comma with
a letter or digit before it and a letter, digit, space or the end after it (always a word of its own) is set apart.

A text that holds the string of one of the tokenizer's added tokens, in capitals or not, goes through the tokenizer whole.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks kept per Python worker before those seen in one group of texts only leave (memory bound; results do not depend on it).
MAX_CHUNKS = 600_000
#: Texts are worked on in groups of about so many characters.
GROUP_CHARS = 4_000_000
#: New chunks that the tokenizer gets at a time: long strings cost it more a word.
ADD_CHUNKS = 1000
#: Longer chunks are encoded but not kept.
LONG_CHUNK = 64

_APART = re.compile(r"[.,](?<=[^\W_][.,])(?=[^\W_]|\s|\Z)")

#: Letters of plain words, as the tokenizer lowers them: each stands for itself and joins with no other.
_PLAIN = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_WORD = re.compile("[a-zÀ-ÖØ-öø-ÿ]+")

_ENCODERS: dict[str, ChunkEncoder] = {}


class ChunkEncoder:
    """Encodes batches of texts. Chunk c has ids flat[starts[c] : starts[c] + sizes[c]]."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)), re.IGNORECASE) if added else None
        self.letters = self._letters()
        self._clear()

    def _letters(self) -> dict[int, str] | None:
        """How the tokenizer's model spells each letter of plain words, if it takes such words whole; else none."""
        if self.tokenizer.pre_tokenizer is None or self.tokenizer.normalizer is None:
            return None
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        spelt = {ord(c): "".join(piece for piece, _ in split(c)) for c in _PLAIN}
        whole = [piece for piece, _ in split(_PLAIN)] == [_PLAIN.translate(spelt)]
        return spelt if whole and self.tokenizer.normalizer.normalize_str(_PLAIN) == _PLAIN else None

    def _clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.sizes, self.n = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0
        self.seen = np.zeros(1 << 14, np.int64)

    def _shrink(self) -> None:
        """Keep the chunks that more than one group of texts held, the most often seen if they are many."""
        at = np.fromiter(self.index.values(), np.int64, len(self.index))
        floor = max(2, int(np.partition(self.seen[at], -(MAX_CHUNKS // 2))[-(MAX_CHUNKS // 2)]) + 1) if len(at) > MAX_CHUNKS // 2 else 2
        stay = self.seen[at] >= floor
        words, at = [w for w, s in zip(self.index, stay.tolist()) if s], at[stay]
        flat, starts, sizes, seen = self.flat, self.starts[at], self.sizes[at], self.seen[at]
        self._clear()
        ends = np.cumsum(sizes)
        self.used, self.n = int(sizes.sum()), len(at)
        self.flat = flat[np.arange(self.used) + np.repeat(starts - (ends - sizes), sizes)]
        self.starts, self.sizes, self.seen = ends - sizes, sizes, np.ones_like(seen)
        self.index = {w: k for k, w in enumerate(words)}
        room = max(1 << 16, 2 * self.used) - self.used, max(1 << 14, 2 * self.n) - self.n
        self.flat = np.concatenate([self.flat, np.zeros(room[0], np.uint32)])
        self.starts, self.sizes, self.seen = (np.concatenate([x, np.zeros(room[1], np.int64)]) for x in (self.starts, self.sizes, self.seen))

    def _of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has."""
        found = self.tokenizer.encode("\n".join(words), add_special_tokens=False)
        ids = np.array(found.ids, np.uint32)
        begins = np.cumsum([0, *(len(w) + 1 for w in words)])
        at = np.fromiter((o[0] for o in found.offsets), np.int64, len(ids))
        return ids, np.bincount(np.searchsorted(begins, at, "right") - 1, minlength=len(words))

    def _of_plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of plain letters: they go straight to the tokenizer's model."""
        model = self.tokenizer.model
        found = [model.tokenize(w if w.isascii() else w.lower().translate(self.letters)) for w in words]
        sizes = np.fromiter(map(len, found), np.int64, len(words))
        return np.array([t.id for one in found for t in one], np.uint32), sizes

    def _add(self, chunks: list[bytes]) -> None:
        """Put new chunks into the table, in this order."""
        words = [c.decode("utf-8") for c in chunks]
        plain = np.array([bool(self.letters and _WORD.fullmatch(w)) for w in words])
        sizes = np.empty(len(chunks), np.int64)
        parts = []
        for which, encode in ((plain, self._of_plain), (~plain, self._of_words)):
            some = np.flatnonzero(which)
            if len(some):
                ids, sizes[some] = encode([words[i] for i in some.tolist()])
                parts.append(ids)
        order = np.argsort(~plain, kind="stable")  # the chunks in the order in which their ids came
        new = np.concatenate(parts)
        while self.used + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n + len(chunks) > len(self.starts):
            self.starts, self.sizes, self.seen = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes, self.seen))
        came = sizes[order]
        self.flat[self.used : self.used + len(new)] = new
        self.starts[self.n + order] = self.used + np.cumsum(came) - came
        self.sizes[self.n : self.n + len(chunks)] = sizes
        self.index.update((c, k) for k, c in enumerate(chunks, self.n) if len(c) <= LONG_CHUNK)
        self.used, self.n = self.used + len(new), self.n + len(chunks)

    def _where(self, chunks: list[bytes]) -> np.ndarray:
        """Table position of distinct chunks; unknown ones are encoded first."""
        at = np.fromiter(map(self.index.get, chunks, repeat(-1)), np.int64, len(chunks))
        missed = np.flatnonzero(at < 0)
        for low in range(0, len(missed), ADD_CHUNKS):
            some, n = missed[low : low + ADD_CHUNKS], self.n
            self._add([chunks[i] for i in some.tolist()])
            at[some] = np.arange(n, self.n)
        return at

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of whole texts in order (None: no ids), worked on in groups of bounded length."""
        group, length = [], 0
        for text in texts:
            if text and self.added and self.added.search(text):
                yield from self._encode_group(group)
                group, length = [], 0
                yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
                continue
            group.append(text or "")
            length += len(group[-1])
            if length > GROUP_CHARS:
                yield from self._encode_group(group)
                group, length = [], 0
        if group:
            yield from self._encode_group(group)

    def _encode_group(self, texts: list[str]) -> Iterator[np.ndarray]:
        if self.n > MAX_CHUNKS:
            self._shrink()
        lowered = [_APART.sub(r" \g<0>", text).encode("utf-8").lower() for text in texts]  # ASCII case and white space only
        chunks = pc.ascii_split_whitespace(pa.array(lowered, pa.large_binary()).cast(pa.large_string()))
        ends, named = chunks.offsets.to_numpy(), chunks.flatten().dictionary_encode()
        known = self._where(named.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist())
        self.seen[known] += 1
        where = known[named.indices.to_numpy()]
        sizes = self.sizes[where]
        stops = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.arange(stops[-1]) + np.repeat(self.starts[where] - stops[:-1], sizes)]
        borders = stops[ends].tolist()
        for a, b in zip(borders, borders[1:]):
            yield ids[a:b]


def encoder(path: str) -> ChunkEncoder:
    """The encoder of this Python worker (kept between tasks, so that words stay known)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def forget() -> None:
    """Drop what this Python worker has kept: other work calls it, as workers are shared and a full table is large."""
    _ENCODERS.clear()


def crc32_of(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())
