"""Byte-level BPE by merge replay over the distinct words of a corpus.

A chunk of documents is cut into words by the tokenizer's pattern. Over its distinct new
words an inverted index from the rank of a token pair to its positions is kept; the ranks
are taken in order, each merge is applied at all its positions at once, and only the pairs
with the touched neighbours are looked up and entered anew. The first index, of pairs of
bytes, is made by one sort. The words' tokens then spell the documents. Chunks are independent: nothing is shuffled and a lost task is redone alone.

Tokens are stored packed, as little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import base64
import bisect
import functools
import heapq
import itertools
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .common import as_bytes, as_texts, with_columns

#: Characters of a chunk (a longer document is a chunk of its own).
CHUNK = 1 << 20
#: Words a task remembers from earlier chunks, twice.
REMEMBERED = 250_000
#: Pairs a task remembers the rank of.
_PAIRS = 200_000
#: Stands between words; no byte of UTF-8.
_END = 0xFF


class _Follow(dict):
    """The rank of a first token with each second one, -1 if they don't merge; looked up when first asked for."""

    __slots__ = ("first", "vocabulary")

    def __init__(self, first: int, vocabulary: Vocabulary):
        self.first, self.vocabulary = first, vocabulary

    def __missing__(self, second: int) -> int:
        found, v = -1, self.vocabulary
        if self.first < v.end and second < v.end:
            found = v.rank.get(v.name[self.first] + v.name[second], -1)
        self[second] = found
        v.met += 1
        return found


class Vocabulary:
    """Ranks of a vocabulary in ``.tiktoken`` form: a line has a token in base64 and its rank."""

    def __init__(self, data: bytes, pattern: str):
        self.rank = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}
        self.name = dict(zip(self.rank.values(), self.rank, strict=True))
        self.byte = [self.rank[bytes([b])] for b in range(256)]
        self.cut = regex.compile(pattern).findall
        # Two numbers that are no token, and merge with nothing: the end of a word, a token merged away.
        self.end = max(self.name) + 1
        self.gone = self.end + 1
        self.met = 0

    @functools.cached_property
    def follow(self) -> list[_Follow]:
        """By first token."""
        return [_Follow(first, self) for first in range(self.gone + 1)]

    @functools.cached_property
    def _bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """The token of each byte, and the rank of each pair of bytes; ``_END`` ends a word."""
        one, two = np.array(self.byte), np.full((256, 256), -1)
        for name, rank in self.rank.items():
            if len(name) == 2:
                two[name[0], name[1]] = rank
        one[_END], two[_END], two[:, _END] = self.end, -1, -1
        return one, two

    def replay(self, words: list[bytes]) -> list[bytes]:
        """The tokens of each word, packed, all words at once.

        A word always takes its lowest rank, leftmost first. If a merge opens a pair of a
        lower rank, the word's other positions wait until that one has been replayed.
        """
        if not words:
            return []
        follow, gone, (one, two) = self.follow, self.gone, self._bytes
        if self.met > _PAIRS:
            self.met = 0
            for ranks in follow:
                ranks.clear()
        # All words one after the other; an end follows each and ends every chain.
        data = np.frombuffer(bytes([_END]).join([*words, b""]), np.uint8)
        token: list[int] = one[data].tolist()
        ends = np.flatnonzero(data == _END)
        starts = [0, *(ends[:-1] + 1).tolist()]
        after, ahead = list(range(1, len(token) + 1)), list(range(-1, len(token) - 1))
        ranks = two[data[:-1], data[1:]]
        at = np.flatnonzero(ranks >= 0)
        at = at[np.argsort(ranks[at], kind="stable")]
        met, first = np.unique(ranks[at], return_index=True)
        queue = met.tolist()  # sorted, so a heap
        places: list[list[int] | None] = [None] * self.end
        for rank, found in zip(queue, np.split(at, first[1:]), strict=False):
            places[rank] = found.tolist()
        push = heapq.heappush
        while queue:
            rank = heapq.heappop(queue)
            turn, places[rank] = sorted(places[rank]), None
            waiting, again, beside = -1, [], follow[rank]
            for at in turn:
                right = after[at]
                # Pairs of a token that has been merged away are no longer there.
                if follow[token[at]][token[right]] != rank:
                    continue
                if at < waiting:
                    again.append(at)
                    continue
                token[at], token[right] = rank, gone
                following, before = after[right], ahead[at]
                after[at], ahead[following] = following, at
                low = False
                new = beside[token[following]]
                if new >= 0:
                    low = new < rank
                    if (known := places[new]) is not None:
                        known.append(at)
                    else:
                        places[new] = [at]
                        push(queue, new)
                # Before the first word lies place -1, the last one: an end too.
                new = follow[token[before]][rank]
                if new >= 0:
                    low = low or new < rank
                    if (known := places[new]) is not None:
                        known.append(before)
                    else:
                        places[new] = [before]
                        push(queue, new)
                if low:
                    # Positions up to this word's end wait.
                    waiting = starts[bisect.bisect_right(starts, at)] if at < starts[-1] else len(token)
            if again:
                if places[rank] is None:
                    places[rank] = again
                    push(queue, rank)
                else:
                    places[rank] += again
        left = np.array(token)
        kept = left < self.end
        packed = left[kept].astype("<u4").tobytes()
        cuts = [0, *(4 * np.cumsum(kept)[ends]).tolist()]
        return [packed[start:end] for start, end in itertools.pairwise(cuts)]


class Encoder:
    """Encodes chunks; words met before are remembered, within a bound."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        pieces = [self.vocabulary.cut(text) for text in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        new, replayed = set().union(*pieces).difference(self.known), []
        for word in new:
            if word in self.older:
                self.known[word] = self.older[word]
                continue
            data = word.encode("utf-8")
            whole = self.vocabulary.rank.get(data)
            if whole is None:
                replayed.append((word, data))
            else:
                self.known[word] = _packed([whole])
        words = [word for word, _ in replayed]
        self.known.update(zip(words, self.vocabulary.replay([data for _, data in replayed]), strict=True))
        spell = self.known.__getitem__
        return [b"".join(map(spell, words)) for words in pieces]


def _packed(tokens: list[int]) -> bytes:
    return struct.pack(f"<{len(tokens)}I", *tokens)


def read_vocabulary(spark: SparkSession, path: str, pattern: str):
    """Broadcast a vocabulary file of the driver (about a megabyte) with its pattern."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast((file.read(), pattern))


def encode(docs: DataFrame, vocabulary, text_col: str = "text") -> DataFrame:
    """Add ``tokens`` (packed) and ``n_tokens`` of each whole text, without special tokens.

    A null text is encoded as the empty one: no tokens. Very long texts are chunks of their
    own. Repeated rows and empty tables need no care. Input columns with the names of added
    ones are replaced.
    """

    def make(batches):
        encoder = Encoder(Vocabulary(*vocabulary.value))
        for batch in batches:
            texts, out, chunk, size = as_texts(batch[text_col]), [], [], 0
            for i, text in enumerate(texts):
                chunk.append(text)
                size += len(text)
                if size >= CHUNK or i == len(texts) - 1:
                    out += encoder.encode(chunk)
                    chunk, size = [], 0
            yield {"tokens": pa.array(out, pa.binary()), "n_tokens": pa.array([len(t) // 4 for t in out], pa.int64())}

    return with_columns(docs, [text_col], StructType([StructField("tokens", BinaryType()), StructField("n_tokens", LongType())]), make)


def decode(rows: DataFrame, vocabulary, tokens_col: str = "tokens") -> DataFrame:
    """Add ``decoded``: the bytes the packed tokens spell; null reads as no tokens."""

    def make(batches):
        known = Vocabulary(*vocabulary.value)
        name = np.empty(known.end, object)
        for token, spelling in known.name.items():
            name[token] = spelling
        for batch in batches:
            spelled = [b"".join(name[np.frombuffer(t, "<u4")].tolist()) for t in as_bytes(batch[tokens_col])]
            yield {"decoded": pa.array(spelled, pa.binary())}

    return with_columns(rows, [tokens_col], StructType([StructField("decoded", BinaryType())]), make)
