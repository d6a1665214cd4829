"""Byte-level BPE by monoid tree reduction.

The encodings of byte strings form a monoid: ``join(encode(a), encode(b)) = encode(a + b)``. A piece is encoded by halves;
two neighbours join by encoding anew a window of tokens around their border, which grows until it is stable. It is stable
when the token before the window followed by the window's first token, and the window's last token followed by the token
after it, are each the encoding of their own bytes: a sequence all of whose neighbouring pairs encode to themselves is
*the* encoding of its bytes, since the first merge across a border would also happen in that pair alone. Decoding
concatenates up the same tree.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from array import array
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptally.llm.common import table

CACHED = 400_000
LONGEST_CACHED = 64
LEAF = 4096
SHORT = 48
REMEMBERED = 12
NONE = 1 << 32

# A single space between two characters that are no white space for any engine: the pattern always parts before it.
_PART = re.compile(r"(?<=[^\s]) (?=[^\s])")


class BytePairs:
    """A vocabulary of ranked byte strings with the pattern that cuts texts into pieces."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.strings = {v: k for k, v in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.parts: dict[str, tuple[int, ...]] = {}
        self.stable: dict[tuple[int, int], bool] = {}
        self.short: dict[bytes, list[int]] = {}

    def remembered(self, data: bytes, encode) -> list[int]:
        """``encode(data)``; byte strings of up to ``REMEMBERED`` bytes are encoded once."""
        ids = self.short.get(data)
        if ids is None:
            ids = encode(data)
            if len(data) <= REMEMBERED:
                if len(self.short) > CACHED:
                    self.short.clear()
                self.short[data] = ids
        return ids

    def merged(self, data: bytes) -> list[int]:
        """Plain encoding of a byte string: merge the pair of lowest rank, leftmost first, until none is left."""
        n = len(data)
        if n <= SHORT:
            return self.remembered(data, self._merged_short)
        ends, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        queue = []

        def offer(i):
            j = ends[i]
            if j < n:
                rank = self.ranks.get(data[i : ends[j]])
                if rank is not None:
                    heapq.heappush(queue, (rank, i, ends[j]))

        for i in range(n):
            offer(i)
        while queue:
            _, i, stop = heapq.heappop(queue)
            j = ends[i]
            if not alive[i] or j >= n or ends[j] != stop:
                continue
            alive[j], ends[i] = False, stop
            if stop < n:
                before[stop] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(self.ranks[data[i : ends[i]]])
            i = ends[i]
        return out

    def _merged_short(self, data: bytes) -> list[int]:
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = [self.ranks.get(a + b, NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks and (least := min(ranks)) != NONE:
            i = ranks.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = self.ranks.get(parts[i - 1] + parts[i], NONE)
            if i < len(ranks):
                ranks[i] = self.ranks.get(parts[i] + parts[i + 1], NONE)
        return [self.ranks[p] for p in parts]

    def pair_is_stable(self, a: int, b: int) -> bool:
        if (a, b) not in self.stable:
            if len(self.stable) > CACHED:
                self.stable.clear()
            both = self.strings[a] + self.strings[b]
            self.stable[a, b] = both not in self.ranks and self.merged(both) == [a, b]
        return self.stable[a, b]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of the bytes of two encodings, one after the other."""
        if not left or not right or self.pair_is_stable(left[-1], right[0]):
            return left + right
        back, ahead = 1, 1
        while True:
            window = self.merged(self.decode(left[len(left) - back :]) + self.decode(right[:ahead]))
            fits_left = back == len(left) or self.pair_is_stable(left[len(left) - back - 1], window[0])
            fits_right = ahead == len(right) or self.pair_is_stable(window[-1], right[ahead])
            if fits_left and fits_right:
                return left[: len(left) - back] + window + right[ahead:]
            if not fits_left:
                back = min(2 * back, len(left))
            if not fits_right:
                ahead = min(2 * ahead, len(right))

    def encode_piece(self, data: bytes) -> list[int]:
        known = self.ranks.get(data)
        if known is not None:
            return [known]
        return self.remembered(data, self._by_halves) if data else []

    def _by_halves(self, data: bytes) -> list[int]:
        half = len(data) // 2
        return self.join(self.encode_piece(data[:half]), self.encode_piece(data[half:]))

    def _part_ids(self, part: str) -> tuple[int, ...]:
        ids = tuple(chain.from_iterable(self.encode_piece(p.encode("utf-8", "replace")) for p in self.pattern.findall(part)))
        if len(part) <= LONGEST_CACHED:
            if len(self.parts) >= CACHED:
                self.parts.clear()
            self.parts[part] = ids
        return ids

    def encode(self, text: str | None) -> array:
        """Ids of a whole text; a null text counts as empty. Equal parts are encoded once by a worker."""
        if not text:
            return array("I")
        first, *rest = _PART.split(text)
        known = self.parts.get
        parts = chain((first,), (" " + p for p in rest))
        return array("I", chain.from_iterable(known(p) or self._part_ids(p) for p in parts))

    def decode(self, ids) -> bytes:
        """Bytes of a sequence of ids, concatenated up the tree of its halves."""
        if len(ids) <= LEAF:
            return b"".join([self.strings[i] for i in ids])
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


_LOADED: dict[tuple[str, str], BytePairs] = {}


def loaded(path: str, pattern: str) -> BytePairs:
    """The vocabulary of this worker."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = BytePairs(path, pattern)
    return _LOADED[path, pattern]


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with ``ids``, the ids of ``text`` as little-endian unsigned 32-bit integers."""

    @F.pandas_udf("binary")
    def encode(text: pd.Series) -> pd.Series:
        pairs = loaded(path, pattern)
        return pd.Series([pairs.encode(t).tobytes() for t in text], dtype=object)

    return docs.withColumn("ids", encode("text"))


def decoded(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """``df`` with ``bytes``, the byte string of ``ids``."""

    @F.pandas_udf("binary")
    def decode(ids: pd.Series) -> pd.Series:
        pairs = loaded(path, pattern)
        return pd.Series([pairs.decode(array("I", bytes(i))) for i in ids], dtype=object)

    return df.withColumn("bytes", decode("ids"))


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of every row of ``docs (doc_id, text)``.

    Null and empty texts have no ids; rows that repeat an id are reported each; an empty table gives an empty result.
    """

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def report(text: pd.Series) -> pd.DataFrame:
        pairs, rows = loaded(path, pattern), []
        for t in text:
            ids = pairs.encode(t)
            rows.append((len(ids), hashlib.sha256(ids).hexdigest(), hashlib.sha256(pairs.decode(ids)).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", report("text").alias("r")).select("doc_id", "r.*")


def op10_byte_pairs(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


QUERIES = {"op10_byte_pairs": op10_byte_pairs}
