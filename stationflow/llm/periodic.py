"""Periodic runs of words, found online by dyadic square catching.

A text is a sequence of words, appended step by step. Each completed block of 2^k words
becomes a catcher: it watches for its own copy to be completed at a distance p between
2^k and 2^(k+1) - 1. Then the block and the copy are parts of a square, or of a stretch in which
words p apart are identical. A suffix comparison extends the stretch to the left at once,
and to the right with every appended word, until a word differs. Every stretch of at least
three periods holds an aligned block of the level of its period and that block's copy, so
none is missed; stretches with the same borders are one run, whose period is the smallest.

Blocks are compared by fingerprints. Equal blocks have equal ones, so nothing is lost, and
each run is compared word by word before it is returned.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import as_bytes, with_columns

#: A run has at least so many words, and at least so many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Words of the beginning by which a catcher knows its copy; the whole block is compared after.
GRAM = 8
#: Words appended at a time.
STEP = 1 << 15
#: Primes of the fingerprints, and the bases that are tried in turn.
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = ((48_271, 69_621), (16_807, 39_373), (62_089_911, 742_938_285), (630_360_016, 397_204_094))

_MIX = np.uint64(0x9E3779B97F4A7C15)

RUN = StructType([StructField("start", LongType()), StructField("length", LongType()), StructField("period", LongType())])


class Prints:
    """Fingerprints of any stretch of a growing sequence, modulo two primes."""

    def __init__(self, bases: tuple[int, int]):
        self.bases = bases
        self.sums = [np.zeros(1, dtype=np.int64) for _ in PRIMES]
        self.powers = [np.ones(1, dtype=np.int64) for _ in PRIMES]

    def append(self, words: np.ndarray) -> None:
        for lane, (prime, base) in enumerate(zip(PRIMES, self.bases, strict=True)):
            old, power = self.sums[lane], self.powers[lane]
            size = len(old) + len(words)
            while len(power) < size:
                power = np.concatenate([power, power * pow(base, len(power), prime) % prime])
            added = (words + 1) % prime * power[len(old) - 1 : size - 1] % prime
            # Fewer than 2^32 words: sums of residues stay below 2^63.
            self.sums[lane] = np.concatenate([old, (old[-1] + np.cumsum(added)) % prime])
            self.powers[lane] = power

    def equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the stretches of ``size`` words from ``a`` and from ``b`` (``a < b``) look the same."""
        same = np.ones(len(a), dtype=bool)
        for prime, sums, powers in zip(PRIMES, self.sums, self.powers, strict=True):
            first = (sums[a + size] - sums[a]) % prime
            second = (sums[b + size] - sums[b]) % prime
            same &= first * powers[b - a] % prime == second
        return same

    def reach(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray, back: bool) -> np.ndarray:
        """How many words from ``a`` and ``b`` on (or before them) are the same, at most ``limit``."""
        low, high = np.zeros_like(limit), limit.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.equal(a - middle, b - middle, middle) if back else self.equal(a, b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


class Catchers:
    """Online detection of runs in a sequence of word numbers."""

    def __init__(self, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS, bases: tuple[int, int] = BASES[0]):
        if periods < 3 or least < 3 * GRAM:
            raise ValueError(f"catchers find runs of three periods and {3 * GRAM} words or more")
        self.least, self.periods = least, periods
        self.words = np.zeros(0, dtype=np.int64)
        self.grams = np.zeros(0, dtype=np.uint64)
        self.prints = Prints(bases)
        # Stretches that end with the sequence, as start by period: appended words may extend them.
        self.open: dict[int, int] = {}
        # Ended runs, as the smallest period by (start, end), and those that ended in this step.
        self.ended: dict[tuple[int, int], int] = {}
        self.recent: list[tuple[int, int, int]] = []

    def append(self, words: np.ndarray) -> None:
        """Append word numbers; any division into steps gives the same runs."""
        if not len(words):
            return
        old = len(self.words)
        self.recent.clear()
        self.words = np.concatenate([self.words, words])
        self.prints.append(words)
        self._advance(old)
        self._complete_grams()
        n = len(self.words)
        block = 1
        # Of greater blocks no copy can be complete.
        while 2 * block <= n:
            self._catch(block, old)
            block *= 2

    def _complete_grams(self) -> None:
        at, n = len(self.grams), len(self.words)
        if n - GRAM < at:
            return
        part = self.words[at:n].astype(np.uint64)
        made = np.zeros(n - GRAM + 1 - at, dtype=np.uint64)
        for i in range(GRAM):
            made = (made ^ (part[i : i + len(made)] + np.uint64(1))) * _MIX
            made ^= made >> np.uint64(29)
        self.grams = np.concatenate([self.grams, made])

    def _end(self, start: int, end: int, period: int) -> None:
        if end - start >= max(self.least, self.periods * period):
            known = self.ended.get((start, end))
            if known is None or period < known:
                self.ended[start, end] = period
                self.recent.append((start, end, period))

    def _advance(self, old: int) -> None:
        """Carry the open stretches on over the words from ``old`` on."""
        for period, start in list(self.open.items()):
            differ = self.words[old:] != self.words[old - period : len(self.words) - period]
            at = int(differ.argmax())
            if differ[at]:
                del self.open[period]
                self._end(start, old + at, period)

    def _catch(self, block: int, old: int) -> None:
        """Copies of blocks of this level that the words from ``old`` on completed."""
        need, n = max(block, GRAM), len(self.words)
        first = max(block, old - need + 1)
        copies = np.arange(first, n - need + 1)
        if not len(copies):
            return
        # For each place one block is in reach: the multiple of its length from 2 to 1 lengths before.
        blocks = (copies // block - 1) * block
        hit = self.grams[blocks] == self.grams[copies]
        copies, blocks = copies[hit], blocks[hit]
        if len(copies) and block > GRAM:
            hit = self.prints.equal(blocks, copies, np.full(len(copies), block))
            copies, blocks = copies[hit], blocks[hit]
        if len(copies):
            self._extend(blocks, copies, need)

    def _known(self, blocks: np.ndarray, copies: np.ndarray, need: int) -> np.ndarray:
        """Hits within a stretch whose period divides theirs: they tell nothing new.

        A stretch that ended before this step cannot hold a copy that this step completed.
        """
        known = np.zeros(len(blocks), dtype=bool)
        n = len(self.words)
        stretches = [(start, n, period) for period, start in self.open.items()]
        stretches += self.recent
        least = need + int((copies - blocks).min(initial=n))
        order = np.argsort(blocks, kind="stable")
        placed = blocks[order]
        for start, end, period in stretches:
            if end - start < least:
                continue
            low, high = np.searchsorted(placed, [start, end])
            those = order[low:high]
            known[those] |= (copies[those] + need <= end) & ((copies[those] - blocks[those]) % period == 0)
        return known

    def _extend(self, blocks: np.ndarray, copies: np.ndarray, need: int) -> None:
        fresh = ~self._known(blocks, copies, need)
        blocks, copies = blocks[fresh], copies[fresh]
        n = len(self.words)
        order = np.lexsort((blocks, copies - blocks))
        blocks, copies = blocks[order], copies[order]
        periods = copies - blocks
        # Of blocks that follow each other with the same distance the first and the last tell the stretch.
        joined = (np.diff(periods) == 0) & (np.diff(blocks) <= need)
        heads, tails = np.append(True, ~joined)[: len(blocks)], np.append(~joined, True)[: len(blocks)]
        head, tail, period = blocks[heads], blocks[tails], periods[heads]
        if not len(head):
            return
        left = head - self.prints.reach(head, head + period, head, back=True)
        ends = tail + period
        right = ends + self.prints.reach(tail, ends, n - ends, back=False)
        for start, end, p in zip(left.tolist(), right.tolist(), period.tolist(), strict=True):
            if end == n:
                self.open[p] = start
            else:
                self._end(start, end, p)

    def finish(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs, by start, then period. No words may follow."""
        for period, start in self.open.items():
            self._end(start, len(self.words), period)
        self.open.clear()
        return sorted(((start, end - start, period) for (start, end), period in self.ended.items()), key=lambda r: (r[0], r[2]))

    def holds(self, run: tuple[int, int, int]) -> bool:
        """Whether a run has its period and no neighbouring word extends it, word by word."""
        start, length, period = run
        end, words = start + length, self.words
        return (
            np.array_equal(words[start : end - period], words[start + period : end])
            and (start == 0 or words[start - 1] != words[start - 1 + period])
            and (end == len(words) or words[end] != words[end - period])
        )


def numbered(words: list[bytes]) -> np.ndarray:
    """The same number for the same word."""
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    return np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))


def runs_of(
    numbers: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS, step: int = STEP
) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs, by start, then period."""
    if len(numbers) < least:
        return []
    for bases in BASES:
        catchers = Catchers(least, periods, bases)
        for at in range(0, len(numbers), step):
            catchers.append(numbers[at : at + step])
        runs = catchers.finish()
        if all(map(catchers.holds, runs)):
            return runs
    raise RuntimeError("fingerprints of different words agree under all bases")


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each word stays: none of a run after its first period does."""
    edges = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges)[:n] == 0


def find_runs(
    docs: DataFrame, text_col: str = "text", least: int = LEAST_WORDS, periods: int = LEAST_PERIODS
) -> DataFrame:
    """Add ``runs`` (structs of start, length, period, in words, by start, then period), ``n_words``
    and ``collapsed``: the words joined by one space, those dropped that a run holds after its first period.

    Words are cut at ASCII white space. A run is a stretch of at least ``least`` words and
    ``periods`` smallest periods in which words one period apart are identical, and that no
    neighbouring word extends. Null, empty and blank texts have no words, no runs and an empty
    ``collapsed``. Each row is judged by its text alone, so repeated rows, ties, null ids and
    empty tables need no care. Input columns with the names of added ones are replaced.
    """
    added = StructType([StructField("runs", ArrayType(RUN)), StructField("n_words", LongType()), StructField("collapsed", StringType())])

    def make(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            found, sizes, collapsed = [], [], []
            for text in as_bytes(batch[text_col]):
                words = text.split()
                runs = runs_of(numbered(words), least, periods) if len(words) >= least else []
                sizes.append(len(words))
                found.append([dict(zip(RUN.names, run, strict=True)) for run in runs])
                if runs:
                    words = [words[i] for i in np.flatnonzero(kept_words(len(words), runs))]
                collapsed.append(b" ".join(words))
            kind = pa.list_(pa.struct([(name, pa.int64()) for name in RUN.names]))
            yield {
                "runs": pa.array(found, kind),
                "n_words": pa.array(sizes, pa.int64()),
                "collapsed": pa.array(collapsed, pa.binary()).cast(pa.string()),
            }

    return with_columns(docs, [text_col], added, make)
