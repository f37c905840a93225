"""Token ids of whole texts, with each distinct word of a block encoded once by the tokenizers library."""

from __future__ import annotations

import string
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEPARATOR = "<|startoftext|>"
WORD_END = "</w>"
MARKS = string.punctuation
IS_MARK = np.zeros(256, bool)
IS_MARK[np.frombuffer(MARKS.encode(), np.uint8)] = True


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """The place of a public tokenizer's file, found on whichever machine asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


def prepared(texts: pa.Array) -> pa.Array:
    """texts with line ends as blanks and ASCII capitals as small letters; null is empty.

    A text that may name a special token, whose letters count as written, keeps
    its capitals.
    """
    flat = pc.fill_null(texts, "").cast(pa.large_string())
    _, where, held = flat.buffers()
    offsets = np.frombuffer(where, np.int64)[flat.offset : flat.offset + len(flat) + 1]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]].copy() if held is not None else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    named = np.flatnonzero(pc.match_substring(flat, "<|").to_numpy(zero_copy_only=False))
    as_written = [(offsets[i], data[offsets[i] : offsets[i + 1]].copy()) for i in named.tolist()]
    data += np.uint8(32) * ((data - np.uint8(65)) < 26)
    for at, raw in as_written:
        data[at : at + len(raw)] = raw
    data[data == 10] = 32
    # "word%%, " becomes "word %%, ": letters and a run of marks up to a blank are always apart, and there are fewer distinct words so.
    if len(data) > 2:
        mark = IS_MARK[data]
        at = np.flatnonzero(((data[:-1] - np.uint8(97)) < 26) & mark[1:]) + 1
        for i in named.tolist():
            at = at[(at <= offsets[i]) | (at >= offsets[i + 1])]
        past = _past_marks(mark, at)
        at = at[past < len(data)]
        at = at[data[past[: len(at)]] == 32]
        data = np.insert(data, at, 32)
        offsets = offsets + np.searchsorted(at, offsets, "left")
    return pa.Array.from_buffers(pa.large_string(), len(flat), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _past_marks(mark: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The first place from each of some on (ascending) that is no mark; the length if there is none."""
    past, going = at.copy(), np.arange(len(at))
    for _ in range(16):
        going = going[past[going] < len(mark)]
        going = going[mark[past[going]]]
        if not len(going):
            return past
        past[going] += 1
    other = np.append(np.flatnonzero(~mark), len(mark))  # runs of very many marks
    past[going] = other[np.searchsorted(other, past[going])]
    return past


class WordEncoder:
    """Ids of whole texts, a block of texts at a time.

    This vocabulary drops white space and never lets a token span it, so a
    text's ids are its words' ids in a row. Words are cut at blanks and line
    ends only; other white space stays inside and is left to the library.
    Words of letters go to the library's model joined by blanks; all others, one
    by one in effect, through its whole pipeline. Capital ASCII letters are made small first, which the vocabulary
    does anyway. The words of a block are numbered by Arrow, so that only its
    distinct words are looked up, and ids are gathered by number. The memory
    for words is bounded: when it is full, it starts over with the block's.
    """

    def __init__(self, path: str, words: int = 400_000, end_id: int = 1):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.whole.model)
        self.plain.normalizer = normalizers.Lowercase()
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(" ", behavior="removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.whole.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(WORD_END)]] = True
        self.separator = vocab.get(SEPARATOR)
        self.limit = words
        self.end_id = end_id
        self._clear()

    def _clear(self) -> None:
        """Forgets all words. Number 0 is no word, number 1 the end id; ids of all numbers lie in one store."""
        self.known: dict[str, int] = {"": 0}
        self.store = np.array([self.end_id], np.uint32)
        self.begins = np.array([0, 0], np.int64)
        self.sizes = np.array([0, 1], np.int32)

    def _plain_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, how many each word has) of words of letters."""
        ids = np.array(self.plain.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.uint32)
        past = np.flatnonzero(self.ends[ids]) + 1
        if len(past) != len(words):
            raise ValueError("the vocabulary doesn't mark the ends of words as expected")
        return ids, np.diff(past, prepend=0)

    def _other_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for any words, through the whole pipeline."""
        apart = [w for w in words if self.separator is None or "<|" in w]  # may name a special token
        joined = [w for w in words if self.separator is not None and "<|" not in w]
        found = {w: np.array(self.whole.encode(w, add_special_tokens=False).ids, np.uint32) for w in apart}
        if joined:
            ids = np.array(self.whole.encode_batch_fast([SEPARATOR.join(joined)], add_special_tokens=False)[0].ids, np.uint32)
            parts = np.split(ids, np.flatnonzero(ids == self.separator))
            if len(parts) != len(joined):
                raise ValueError("the vocabulary doesn't keep its special tokens apart as expected")
            found |= dict(zip(joined, (p[i > 0 :] for i, p in enumerate(parts)), strict=True))
        out = [found[w] for w in words]
        return np.concatenate(out), np.array([len(x) for x in out])

    def _learn(self, words: list[str]) -> None:
        """Numbers new words."""
        # Letters below U+0250 lower-case one by one and are whole in NFC.
        plain = [w for w in words if w.isalpha() and len(w) < 200 and (w.isascii() or (max(w) < "\u0250" and w.lower().isalpha()))]
        rest = list(set(words).difference(plain))
        for some, encode in ((plain, self._plain_ids), (rest, self._other_ids)):
            if not some:
                continue
            ids, sizes = encode(some)
            first = len(self.sizes)
            self.known.update(zip(some, range(first, first + len(some)), strict=True))
            self.begins = np.concatenate((self.begins, len(self.store) + np.cumsum(sizes) - sizes))
            self.sizes = np.concatenate((self.sizes, sizes.astype(np.int32)))
            self.store = np.concatenate((self.store, ids))

    def _numbers(self, words: list[str]) -> np.ndarray:
        """The number of each of a block's distinct words."""
        numbers = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            if len(self.known) + len(missing) > self.limit:
                self._clear()
                missing = np.arange(len(words))
            new = [words[i] for i in missing.tolist()]
            self._learn([w for w in new if w])
            numbers[missing] = np.fromiter(map(self.known.__getitem__, new), np.int64, len(new))
        return numbers

    def encode_block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, each with its end id; how many each has); null counts as empty."""
        if len(texts) == 0:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        split = pc.split_pattern(prepared(texts), " ")
        numbered = split.flatten().dictionary_encode()
        numbers = np.append(self._numbers(numbered.dictionary.to_numpy(zero_copy_only=False).tolist()), 1)
        sizes, begins = self.sizes[numbers], self.begins[numbers].astype(np.int32)
        offsets = split.offsets.to_numpy()
        offsets = offsets - offsets[0]
        word = np.insert(numbered.indices.to_numpy(), offsets[1:], len(numbers) - 1)
        of = sizes[word]
        done = np.cumsum(of, dtype=np.int64)
        out = self.store[np.repeat((begins[word] - (done - of)).astype(np.int32), of) + np.arange(int(done[-1]), dtype=np.int32)]
        past = offsets[1:] + np.arange(1, len(texts) + 1)  # words up to each text's end id
        return out, np.diff(np.concatenate(([0], done[past - 1])))

    def blocks(self, texts: pa.Array, size: int = 2 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, sizes) of texts, about size bytes at a time."""
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        row = 0
        while row < len(texts):
            before = int(ends[row - 1]) if row else 0
            past = max(row + 1, int(np.searchsorted(ends, before + size, "right")))
            yield row, *self.encode_block(texts.slice(row, past - row))
            row = past

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as bytes."""
        ids, sizes = self.encode_block(pa.array(texts, pa.string()))
        ends = np.cumsum(sizes)
        return [ids[e - n : e].tobytes() for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]


_ENCODERS: dict[tuple, WordEncoder] = {}


def encoder(path: str | None = None, end_id: int = 1) -> WordEncoder:
    """One encoder per process and vocabulary."""
    key = (path, end_id)
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(path or vocabulary_path(), end_id=end_id)
    return _ENCODERS[key]
