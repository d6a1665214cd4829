"""Token ids of whole texts by a word-level BPE vocabulary that drops white space.

Such a vocabulary never joins text across white space, so a text's ids are the ids of its words one after the other, and a
worker encodes each different word once.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from shoptally.llm.common import words_of

CACHED_BYTES = 48_000_000  # of words and ids; a worker takes about twice that with the table around them
LONGEST_CACHED = 100
PER_ENTRY = 120  # bytes that an entry takes besides its text

# Byte -> character of byte-level vocabularies: visible Latin-1 characters stand for themselves, the others follow U+00FF.
_HIDDEN = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
AS_CHARACTERS = {byte: 0x100 + place for place, byte in enumerate(_HIDDEN)}

# Marks that the vocabulary's pattern always parts from a letter before them.
MARKS = frozenset((b".", b",", b";", b":", b"!", b"?"))

# Visible ASCII characters besides letters and digits: the pattern parts a run of them that ends a word from a letter before it.
LAST_MARKS = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum())

# Letters whose composed form, lower case and bytes need no look at their neighbours.
PLAIN_WORD = "^[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+$"


class WordIds:
    """Word (UTF-8) -> bytes of its ids, filled on demand and started anew when it holds ``CACHED_BYTES``."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # names of special tokens in a text are ordinary text
        self.spelled = Tokenizer(self.tokenizer.model)  # the merges alone, of words in ``AS_CHARACTERS`` parted by spaces
        self.spelled.pre_tokenizer = WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.bytes_of = [n.to_bytes(4, "little") for n in range(len(self.ends_word))]
        self.known: dict[bytes, bytes] = {}
        self.held = 0

    def forget(self) -> None:
        self.known, self.held = {}, 0

    def learn(self, words) -> None:
        """Encode new words.

        The vocabulary's pattern takes a run of letters as one piece, its normalisation composes and lower-cases it, and its
        bytes are written as characters. For letters below U+0100, which are composed already, lower-casing and the table
        ``AS_CHARACTERS`` are all of that, so they go to the merges directly, as does such a run before one last mark, which
        the pattern parts. Other runs of letters are encoded in one text and parted after the tokens that end a word; should
        these not be as many as the words, and for all remaining words, each word is a text of its own.
        """
        known, marked, plain, letters, others = self.known, [], {}, {}, []
        for word in words:
            stem = word[:-1] if word[-1:] in MARKS and len(word) > 1 else word
            if stem.isalpha():  # of bytes: ASCII letters only
                if stem is not word:
                    marked.append((word, stem))
                if stem not in known:
                    plain[stem] = stem.lower().decode()
                continue
            text = stem.decode("utf-8", "replace")
            if not text.isalpha() or not normalize("NFC", text).lower().isalpha():  # lower case may bring a mark of its own
                others.append(word)
                continue
            if stem is not word:
                marked.append((word, stem))
            if stem not in known:
                if max(text) < "\u0100":
                    plain[stem] = text.lower().encode().decode("latin-1").translate(AS_CHARACTERS)
                else:
                    letters[stem] = text
        merges, bytes_of = self.tokenizer.model.tokenize, self.bytes_of
        for stem, text in plain.items():
            known[stem] = b"".join([bytes_of[t.id] for t in merges(text)])
        if letters:
            ids = self.tokenizer.encode_batch_fast([" ".join(letters.values())], add_special_tokens=False)[0].ids
            stops = (4 * np.flatnonzero(self.ends_word[ids]) + 4).tolist()
            if len(stops) == len(letters):
                data, start = array("I", ids).tobytes(), 0
                for stem, stop in zip(letters, stops, strict=True):
                    known[stem] = data[start:stop]
                    start = stop
            else:
                others += {*letters, *(word for word, stem in marked if stem in letters)}
                marked = [(word, stem) for word, stem in marked if stem not in letters]
        if marked:
            others += [mark for mark in {word[-1:] for word, _ in marked} if mark not in known]
        if others:
            texts = [word.decode("utf-8", "replace") for word in others]
            for word, found in zip(others, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                known[word] = array("I", found.ids).tobytes()
        for word, stem in marked:
            known[word] = known[stem] + known[word[-1:]]
        self.held += PER_ENTRY * len(words) + sum(map(len, words))

    def encode(self, words: list[bytes]) -> array:
        """Ids of words, one after the other."""
        if self.held > CACHED_BYTES:
            self.forget()
        new = set(words).difference(self.known)
        if new:
            self.learn(new)
        known, out = self.known, array("I")
        out.frombytes(b"".join([known[w] for w in words]))
        for word in [w for w in new if len(w) > LONGEST_CACHED]:
            del known[word]
        return out

    def _learned(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different words, one after the other, and how many each has; nothing stays in the cache."""
        self.forget()
        self.learn(words)
        found = [self.known[w] for w in words]
        self.forget()
        return np.frombuffer(b"".join(found), dtype=np.uint32), np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4

    def _merged(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same of words that match ``PLAIN_WORD``, by one call of the merges.

        The ids are parted after those that end a word; should these not be as many as the words, each is learned by itself.
        """
        text = " ".join(words.to_pylist()).lower()
        if not text.isascii():
            character = np.array([AS_CHARACTERS.get(byte, byte) if byte != 0x20 else byte for byte in range(256)], dtype="<u2")
            text = character[np.frombuffer(text.encode(), dtype=np.uint8)].tobytes().decode("utf-16-le")
        ids = np.array(self.spelled.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)
        stops = np.flatnonzero(self.ends_word[ids]) + 1
        if len(stops) != len(words) or (len(stops) and stops[-1] != len(ids)):
            return self._learned(words.cast(pa.binary()).to_pylist())
        return ids, np.diff(stops, prepend=0)

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the places where each text begins and the last one ends.

        The different words of all texts are found first and cut into letters and the marks after them; each different piece
        is encoded once, those of plain letters all in one call. Words of other kinds are one piece.
        """
        parted = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
        coded = parted.flatten().dictionary_encode()
        words = coded.dictionary
        stems = pc.ascii_rtrim(words, LAST_MARKS)
        plain = pc.match_substring_regex(stems, PLAIN_WORD).to_numpy(zero_copy_only=False)
        begin = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset : words.offset + len(words) + 1]
        cut = begin[1:].copy()
        cut[plain] = begin[:-1][plain] + pc.binary_length(stems).to_numpy()[plain]
        bounds = np.append(np.column_stack([begin[:-1], cut]), begin[-1])  # a word's second piece may be empty
        halves = pa.Array.from_buffers(pa.large_string(), 2 * len(words), [None, pa.py_buffer(bounds), words.buffers()[2]])
        pieces = halves.dictionary_encode()
        letters = pc.match_substring_regex(pieces.dictionary, PLAIN_WORD).to_numpy(zero_copy_only=False)
        filled = pc.binary_length(pieces.dictionary).to_numpy() > 0
        sizes = np.zeros(len(letters), dtype=np.int64)
        merged, sizes[letters] = self._merged(pieces.dictionary.filter(pa.array(letters)))
        others = filled & ~letters
        learned, sizes[others] = self._learned(pieces.dictionary.filter(pa.array(others)).cast(pa.large_binary()).to_pylist())
        first = np.zeros(len(sizes), dtype=np.int64)
        first[letters] = np.cumsum(sizes[letters]) - sizes[letters]
        first[others] = len(merged) + np.cumsum(sizes[others]) - sizes[others]
        ids = np.concatenate([merged, learned])
        chosen = pieces.indices.to_numpy().reshape(-1, 2)[coded.indices.to_numpy()].reshape(-1)
        stops = np.concatenate([[0], np.cumsum(sizes[chosen])])
        at = np.repeat(first[chosen] - stops[:-1], sizes[chosen])
        at += np.arange(len(at))
        return ids[at], stops[2 * (parted.offsets.to_numpy() - parted.offsets[0].as_py())]


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The vocabulary of a file, read once in a worker."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


@contextmanager
def known_words(path: str) -> Iterator[WordIds]:
    """The vocabulary of a file for one task: the words that the task has learned are forgotten at its end.

    Workers are used again by later tasks and stages, which need the memory.
    """
    ids = word_ids(path)
    try:
        yield ids
    finally:
        ids.forget()


def document_ids(text: str | None, ids: WordIds, end_id: int) -> array:
    """All ids of a text and ``end_id``, as unsigned 32-bit integers; a null text counts as empty."""
    out = ids.encode(words_of(text))
    out.append(end_id)
    return out
