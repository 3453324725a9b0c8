"""Find benchmark passages in documents by a broadcast set of word n-grams.

Items are cut to words; each run of ``n`` words is a window (a shorter item is one window).
The hashes of all windows, and the words themselves for the check, are broadcast. Tasks
turn whole documents into arrays of word numbers, roll a hash over them, look the hashes
up and verify each hit word by word.

The benchmark is broadcast in blocks of at most ``BLOCK_WINDOWS`` windows, as sorted arrays
that are built once. One block is the rule and needs one pass and no shuffle. More blocks
are one pass each, one after the other, and their hits are joined by text, so the broadcast
stays bounded however large the benchmark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from .common import as_bytes, checkpointed, packed, small_batches, unpacked, with_columns

BLOCK_WINDOWS = 1_000_000
#: Words of a batch that are hashed at once.
WORDS_AT_ONCE = 1 << 18
# On UTF-8 bytes: digits, lower-case letters and everything beyond ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def _rolled(numbers: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` numbers."""
    n = len(numbers) - size + 1
    out = np.zeros(max(0, n), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size if n > 0 else 0):
            out = out * _BASE + numbers[j : j + n].astype(np.uint64)
            out ^= out >> np.uint64(29)
    return out


class Windows:
    """The windows of a block of items as sorted arrays, ready for lookup.

    Built once for a block and broadcast: words in one string, items as runs of word
    numbers, and for each window size the hashes in order, each with the place of its
    window and its item. Tasks only number the words.
    """

    def __init__(self, items: list[tuple[str | None, bytes]], n: int):
        number: dict[bytes, int] = {}
        self.names = sorted({item for item, _ in items}, key=lambda i: (i is not None, i or ""))
        place = {name: at for at, name in enumerate(self.names)}
        runs: list[np.ndarray] = []
        owners: list[int] = []
        for item, text in items:
            words = words_of(text)
            if words:
                runs.append(np.array([number.setdefault(w, len(number) + 1) for w in words], dtype=np.int64))
                owners.append(place[item])
        self.words = b" ".join(number)
        #: Made by the task that first scans.
        self._number: dict[bytes, int] | None = None
        self.flat = np.concatenate(runs) if runs else np.zeros(0, np.int64)
        lengths = np.array([len(run) for run in runs], dtype=np.int64)
        starts = np.cumsum(lengths) - lengths
        sizes = np.minimum(lengths, n)
        self.known: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in np.unique(sizes).tolist():
            rolled = _rolled(self.flat, size)
            those = np.flatnonzero(sizes == size)
            counts = lengths[those] - size + 1
            at = np.repeat(starts[those] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            owner = np.repeat(np.array(owners)[those], counts)
            order = np.lexsort((at, owner, rolled[at]))
            at, owner = at[order], owner[order]
            # The same window once more in its item says nothing new.
            same = np.zeros(len(at), dtype=bool)
            same[1:] = (rolled[at[1:]] == rolled[at[:-1]]) & (owner[1:] == owner[:-1])
            same[same] = self._equal(self.flat, at[same], at[np.flatnonzero(same) - 1], size)
            self.known[size] = rolled[at[~same]], at[~same], owner[~same]

    def _equal(self, numbers: np.ndarray, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
        """Whether the ``size`` numbers at ``a`` are those of the items at ``b``."""
        out = np.ones(len(a), dtype=bool)
        for j in range(size):
            out &= numbers[a + j] == self.flat[b + j]
        return out

    def numbering(self) -> dict[bytes, int]:
        return {word: at for at, word in enumerate(self.words.split(b" "), 1)} if self.words else {}

    def hits(self, documents: list[list[bytes]], number: dict[bytes, int]) -> list[tuple[np.ndarray, set]]:
        """For each document the numbers of the words hit, and the items that occur."""
        lengths = np.array([len(words) for words in documents], dtype=np.int64)
        # A zero, which no window holds, stands after each document.
        ends = np.cumsum(lengths + 1)
        starts = ends - lengths - 1
        numbers = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
        find = number.get
        for start, words in zip(starts.tolist(), documents, strict=True):
            numbers[start : start + len(words)] = [find(word, 0) for word in words]
        marks = np.zeros(len(numbers) + 1, dtype=np.int64)
        found: list[set] = [set() for _ in documents]
        for size, (known, at, owner) in self.known.items():
            rolled = _rolled(numbers, size)
            low = np.searchsorted(known, rolled)
            low[low == len(known)] = 0
            places = np.flatnonzero(known[low] == rolled)
            low = low[places]
            # Every entry of a hash is verified word by word.
            counts = np.searchsorted(known, rolled[places], side="right") - low
            entry = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            place = np.repeat(places, counts)
            good = self._equal(numbers, place, at[entry], size)
            place, item = place[good], owner[entry[good]]
            np.add.at(marks, np.unique(place), 1)
            np.add.at(marks, np.unique(place) + size, -1)
            document = np.searchsorted(ends, place, side="right")
            for pair in np.unique(document * len(self.names) + item).tolist():
                found[pair // len(self.names)].add(self.names[pair % len(self.names)])
        inside = np.cumsum(marks) > 0
        return [
            (np.flatnonzero(inside[start : start + size]), items)
            for start, size, items in zip(starts.tolist(), lengths.tolist(), found, strict=True)
        ]

    def scan(self, texts: list[bytes]) -> Iterator[tuple[list[bytes], np.ndarray, set]]:
        """(words, numbers of the words hit, items) of each text, some texts at a time."""
        held: list[list[bytes]] = []
        size = 0
        if self._number is None:
            self._number = self.numbering()
        for i, text in enumerate(texts):
            held.append(words_of(text))
            size += len(held[-1])
            if size >= WORDS_AT_ONCE or i == len(texts) - 1:
                yield from ((words, *hit) for words, hit in zip(held, self.hits(held, self._number), strict=True))
                held, size = [], 0


def _without_words(text: bytes, hit: np.ndarray) -> str:
    """The text without the stretches from the first to the last word of each run of hit words."""
    places = [m.span() for m in _WORD.finditer(text.lower())]
    kept, at = [], 0
    for run in np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1):
        kept.append(text[at : places[run[0]][0]])
        at = places[run[-1]][1]
    return b"".join([*kept, text[at:]]).decode("utf-8", "replace")


ADDED = StructType(
    [
        StructField("n_words", LongType()),
        StructField("n_hit", LongType()),
        StructField("items", ArrayType(StringType())),
        StructField("contaminated", BooleanType()),
    ]
)


def _blocks(benchmark: DataFrame, item_col: str, item_text: str, block_windows: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """Items in blocks of at most ``block_windows`` windows (one item may exceed it), one block at a time."""
    items = benchmark.select(F.col(item_col).cast("string"), F.col(item_text)).where(F.col(item_text).isNotNull())
    block: list[tuple[str | None, bytes]] = []
    size = 0
    for item, text in items.toLocalIterator():
        data = text.encode("utf-8")
        # An item has no more windows than half its bytes.
        if block and size + len(data) // 2 > block_windows:
            yield block
            block, size = [], 0
        block.append((item, data))
        size += len(data) // 2
    yield block


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = 10,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    remove_spans: bool = False,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Add ``n_words``, ``n_hit``, ``items`` (ids as sorted strings) and ``contaminated``.

    A word is hit if it lies inside any occurrence of a window. With ``remove_spans`` the
    stretches hit are cut from the text; dropping ``contaminated`` rows removes documents.
    A null or empty text has no words, and an item without words no window. Items with a
    null id hit words but are not listed; repeated items count once. Empty tables are fine
    on both sides. Input columns with the names of added ones are replaced.
    """
    small_batches(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    blocks = _blocks(benchmark, item_col, item_text, block_windows)
    block = next(blocks)
    following = next(blocks, None)
    added = StructType([StructField(text_col, StringType()), *ADDED.fields]) if remove_spans else ADDED

    def columns(texts, hits):
        out = {
            "n_words": pa.array([n_words for n_words, _, _ in hits], pa.int64()),
            "n_hit": pa.array([len(hit) for _, hit, _ in hits], pa.int64()),
            "items": pa.array([sorted(i for i in items if i is not None) for _, _, items in hits], pa.list_(pa.string())),
            "contaminated": pa.array([len(hit) > 0 for _, hit, _ in hits], pa.bool_()),
        }
        if remove_spans:
            clean = [
                _without_words(t, hit) if len(hit) else t.decode("utf-8", "replace") for t, (_, hit, _) in zip(texts, hits, strict=True)
            ]
            out[text_col] = pa.array(clean, pa.string())
        return out

    if following is None:
        held = context.broadcast(Windows(block, n))

        def scan(batches):
            windows = held.value
            for batch in batches:
                texts = as_bytes(batch[text_col])
                yield columns(texts, [(len(words), hit, items) for words, hit, items in windows.scan(texts)])

        return with_columns(docs, [text_col], added, scan)

    def partial(held):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            windows = held.value
            for batch in batches:
                found = [(hit, items) for _, hit, items in windows.scan(as_bytes(batch.column(1)))]
                some = [i for i, (hit, _) in enumerate(found) if len(hit)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(some, pa.int64())),
                        pa.array([found[i][0].tolist() for i in some], pa.list_(pa.int64())),
                        pa.array([sorted(x for x in found[i][1] if x is not None) for i in some], pa.list_(pa.string())),
                    ],
                    names=["row", "hit", "items"],
                )

        return slim.mapInArrow(run, "row binary, hit array<long>, items array<string>")

    # Hits depend on the text alone, so rows are told apart by it: by 256 bits, which no two texts share.
    row = F.unhex(F.sha2(text_col, 256))
    slim = docs.where(F.col(text_col).isNotNull()).select(row.alias("row"), text_col)
    hits = None
    while block is not None:
        # One block at a time: its hits are written before the next is sent.
        held = context.broadcast(Windows(block, n))
        found = checkpointed(partial(held).distinct())
        held.unpersist()
        hits = found if hits is None else hits.unionByName(found)
        block, following = following, next(blocks, None)
    hits = hits.groupBy("row").agg(
        F.array_distinct(F.flatten(F.collect_set("hit"))).alias("hit"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items")
    )
    names = docs.columns
    apart = docs.select(packed(names).alias("_kept"), F.col(text_col).alias("_text"), row.alias("row")).join(hits, "row", "left")

    def merge(batches):
        for batch in batches:
            texts = as_bytes(batch["_text"])
            pairs = zip(texts, batch["hit"].to_pylist(), batch["items"].to_pylist(), strict=True)
            made = columns(texts, [(len(words_of(t)), np.sort(np.array(h or [], np.int64)), set(i or ())) for t, h, i in pairs])
            yield {"_made": pa.StructArray.from_arrays([made[name] for name in added.names], names=added.names)}

    made = with_columns(apart, ["_text", "hit", "items"], StructType([StructField("_made", added)]), merge)
    new = {name.lower(): name for name in added.names}
    replaced = [F.col(f"_made.{new.pop(name.lower())}").alias(name) if name.lower() in new else unpacked([name])[0] for name in names]
    return made.select(*replaced, *[F.col(f"_made.{name}").alias(name) for name in new.values()])
