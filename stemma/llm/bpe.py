"""Token ids by the tokenizers library, whole texts, with a bounded cache of word encodings.

The byte-level pre-tokeniser never joins what stands before a space and what follows it, unless the
space lies inside a run of white space; so a text's ids are those of its parts, cut before such
spaces.  Parts repeat, and each is encoded by the library once for as long as the cache holds it.
"""

from __future__ import annotations

import os
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from stemma.llm.ragged import Ragged, WordCache

#: A space where a text may be cut: after other than white space, or before it.
_CUT = re.compile(r"(?<!\s) | (?=\S)")
#: Where white space runs together; elsewhere a line feed is a unit and the word after it begins anew.
_SPACES = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_RUN = f"{_SPACES}{_SPACES}"
MOST_WORDS, LONG_WORD, CHUNK, ROWS = 1_300_000, 48, 20_000, 2000
#: Marks that the pre-tokeniser never joins to the letters before them.
_MARKS = ".,;:!?%&$*#|)"
#: Stands before the first word of a text; nowhere else does a word begin so.
_HEAD = "\n\n"
#: Letters alone, or letters after a line feed: one unit of the pre-tokeniser.
_LETTERS = "^\n?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+$"

#: The byte alphabet: printable Latin-1 as it is, the other bytes in order from U+0100.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_OTHERS = dict(zip([b for b in range(256) if b not in _PRINTABLE], range(0x100, 0x200)))
_ALPHABET = np.array([_OTHERS.get(b, b) for b in range(256)], "<u4")


class Encoder:
    """Little-endian unsigned 32-bit ids of texts."""

    def __init__(self, path: str, most_words: int = MOST_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = Tokenizer.from_file(path)
        self.model.pre_tokenizer = None
        self.line_feed = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        self.words = WordCache(1, most_words, LONG_WORD)
        self.marks: dict[str, list[int]] = {}

    def _ask(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole units by the library, one after the other, and how many each has."""
        ids: list[np.ndarray] = [np.zeros(0, np.uint32)]
        sizes: list[int] = []
        for at in range(0, len(units), CHUNK):
            for e in self.tokenizer.encode_batch_fast(units[at : at + CHUNK], add_special_tokens=False):
                ids.append(np.array(e.ids, np.uint32))
                sizes.append(len(ids[-1]))
        return np.concatenate(ids), np.array(sizes, np.int64)

    def _ask_letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters, after a space or (marked by a line feed) without one.

        Each is one unit of the byte-level pre-tokeniser.  They go to the library's model already
        mapped to the byte alphabet, with a line feed between each two, whose id no word has.
        """
        ids = []
        for at in range(0, len(words), CHUNK):
            text = "\n".join([w[1:] if w[0] == "\n" else " " + w for w in words[at : at + CHUNK]])
            mapped = _ALPHABET[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le").split("\u010a")
            units = ["\u010a"] * (2 * len(mapped))
            units[::2] = mapped
            ids.append(np.array(self.model.encode_batch_fast([units], add_special_tokens=False, is_pretokenized=True)[0].ids, np.uint32))
        flat = np.concatenate(ids)
        ends = np.flatnonzero(flat == self.line_feed)
        return np.delete(flat, ends), np.diff(ends, prepend=-1) - 1

    def _learn(self, missing: pa.Array) -> None:
        """Rows of different words: letters and the marks that follow them apart.

        A word stands after a space; one that begins with a line feed stands after that alone; one
        that begins with a space is a part of a text with runs of white space, and is whole; one that
        begins with two line feeds is the beginning of a text, without them.
        """
        base = pc.utf8_rtrim(missing, characters=_MARKS)
        plain = pc.match_substring_regex(base, _LETTERS)
        letters = base.filter(plain).dictionary_encode()
        rest = [w[2:] if w[:2] == _HEAD else w if w[:1] in ("\n", " ") else " " + w for w in missing.filter(pc.invert(plain)).to_pylist()]
        parts = Ragged()  # bases, whole words, marks
        listed = letters.dictionary.to_pylist()
        known = np.fromiter(map(self.words.number.get, listed, repeat(-1)), np.int64, len(listed))
        have = np.flatnonzero(known >= 0)
        parts.add(*self.words.stores[0].take(known[have]))
        fresh = np.flatnonzero(known < 0)
        if len(fresh):
            asked = [listed[i] for i in fresh.tolist()]
            ids, size = self._ask_letters(asked)
            fed = np.fromiter((w[0] == "\n" for w in asked), bool, len(asked))
            before = (np.cumsum(size) - size)[fed]
            size[fed] += 1
            parts.add(np.insert(ids, before, self.line_feed), size)
        row = np.empty(len(listed), np.int64)
        row[have], row[fresh] = np.arange(len(have)), len(have) + np.arange(len(fresh))
        at = parts.add(*self._ask(rest))
        marks = ends_of(missing.filter(plain), base.filter(plain)).dictionary_encode()
        for m in marks.dictionary.to_pylist():
            if m not in self.marks:
                self.marks[m] = self.tokenizer.encode(m, add_special_tokens=False).ids
        of_marks = [self.marks[m] for m in marks.dictionary.to_pylist()]
        mark = parts.add(np.array([i for x in of_marks for i in x], np.uint32), np.array([len(x) for x in of_marks], np.int64))
        good = plain.to_numpy(zero_copy_only=False)
        pair = np.zeros((len(missing), 2), np.int64)  # each word is two parts, the second may be empty
        pair[good, 0] = row[letters.indices.to_numpy()]
        pair[good, 1] = mark + marks.indices.to_numpy()
        none = parts.add(np.zeros(0, np.uint32), np.zeros(1, np.int64))
        pair[~good, 0], pair[~good, 1] = at + np.arange(len(rest)), none
        ids, size = parts.take(pair.ravel())
        self.words.stores[0].add(ids, size.reshape(-1, 2).sum(1))

    def encode(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """The ids of each text as bytes, four for each id; null is empty.

        Arrow splits the texts and numbers their different words; only those are looked up, and numpy
        puts the ids of all words in a row.
        """
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if len(texts) > ROWS:
            return [ids for at in range(0, len(texts), ROWS) for ids in self.encode(texts.slice(at, ROWS))]
        if not len(texts):
            return []
        runs = pc.match_substring_regex(texts, _RUN).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(pc.binary_join_element_wise(_HEAD, pc.replace_substring(texts, "\n", " \n"), ""), " ")
        if runs.any():  # there the parts after the first are marked by their space
            parts = [_CUT.split(t) if r else None for r, t in zip(runs.tolist(), texts.to_pylist(), strict=True)]
            listed = [x if p is None else [_HEAD + p[0], *[" " + w for w in p[1:]]] for x, p in zip(lists.to_pylist(), parts, strict=True)]
            lists = pa.array(listed, pa.list_(pa.string()))
        ends = np.cumsum(lists.value_lengths().to_numpy())
        coded = lists.flatten().dictionary_encode()
        if self.words.full():
            self.words.clear()
        rows = self.words.find(coded.dictionary, self._learn)
        ids, sizes = self.words.stores[0].take(rows[coded.indices.to_numpy()])
        data = ids.tobytes()
        cuts = (4 * np.cumsum(sizes)[ends - 1]).tolist()
        return [data[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]


def ends_of(words: pa.Array, bases: pa.Array) -> pa.Array:
    """What stands behind each base, all ASCII: slices of the words' bytes."""
    words, bases = words.cast(pa.large_binary()), bases.cast(pa.large_binary())
    if not len(words):
        return pa.array([], pa.string())
    size = pc.binary_length(words).to_numpy() - pc.binary_length(bases).to_numpy()
    data = np.frombuffer(words.buffers()[2], np.uint8)
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    total = np.cumsum(size)
    flat = data[np.repeat(offsets[1:] - total, size) + np.arange(total[-1] if len(total) else 0)]
    ends = np.append(0, total).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(words), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(flat.tobytes())])


_encoders: dict[str, Encoder] = {}


def encoder(path: str, most_words: int = MOST_WORDS) -> Encoder:
    """One for each worker process and vocabulary; ``most_words`` are remembered, some 150 bytes each."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, most_words)
    return _encoders[path]


def forget(path: str) -> None:
    """Drop the worker's encoder of a vocabulary; the next task makes a new one."""
    _encoders.pop(path, None)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
