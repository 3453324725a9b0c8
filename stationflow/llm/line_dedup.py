"""Drop lines that many documents share, by probing perfect-hash arrays.

1. Each document emits the 128-bit hash of each distinct line key; counting gives, for
   every key, in how many documents it lies and the largest id among them.
2. The keys that can drop lines (enough documents) are dealt to shards of about
   ``SHARD_KEYS`` keys. A shard becomes a minimal perfect hash and three compact arrays:
   fingerprint, count, keeper.
3. Documents probe the arrays line by line. Texts are not shuffled and lines not joined.

As a rule all arrays together have at most ``GROUP_BYTES``: they are broadcast, and the
texts are cut in the same pass. Larger ones stay where they were written: each document
sends the hashes of its lines to the shards, whose arrays meet them in a task, and the hashes of lines
that go come back. A shard whose lines very many documents hold has several copies. Nothing
passes through the driver then, and no text is shuffled but with its answer at the end.

The index holds the keys that were found in enough documents. ``counts`` is kept, so the
same index serves a higher limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import as_bytes, checkpointed, packed, small_batches, unpacked, with_columns

SHARD_KEYS = 1 << 16
GROUP_BYTES = 64 << 20
#: Lines that one copy of a shard is asked for, as a rule; shards with more copies, at most (they are broadcast).
ASKS, LARGE_SHARDS = 1 << 20, 1_000_000
#: Bytes of the arrays for each key, the hash itself included.
KEY_BYTES = 28
SEEDS = (42, 2_654_435_761)
_MIX = np.uint64(0x9E3779B97F4A7C15)


# --- line keys ----------------------------------------------------------------------


def line_key(line: bytes) -> bytes:
    """Stripped of ASCII white space, A-Z lower-cased (bytes methods touch ASCII only)."""
    return line.strip().lower()


def long_keys(text: bytes, least: int) -> list[tuple[int, bytes]]:
    """(line number, key) of the lines whose key has at least ``least`` code points."""
    found = []
    for number, line in enumerate(text.split(b"\n")):
        if len(line) >= least:
            key = line_key(line)
            if len(key) >= least and (key.isascii() or len(key.decode("utf-8", "replace")) >= least):
                found.append((number, key))
    return found


def hashes(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    first, second = (np.array([xxhash.xxh64_intdigest(k, seed) for k in keys], dtype=np.uint64) for seed in SEEDS)
    return first, second


# --- minimal perfect hash -------------------------------------------------------------


class PerfectHash:
    """Maps n known keys to 0..n-1: a bit map per level, and ranks over all bits.

    On each level a key that is alone at its bit stays; the others go on to the next
    level. A key's number is the rank of its bit.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.starts = np.cumsum([0] + [len(bits) for bits in levels])
        self.rank = np.cumsum(np.concatenate(levels), dtype=np.int64) if levels else np.zeros(0, np.int64)

    @staticmethod
    def _at(first: np.ndarray, second: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = (first ^ (second * np.uint64(2 * level + 1))) * _MIX
            mixed ^= mixed >> np.uint64(32)
            return ((mixed * _MIX) >> np.uint64(16)) % np.uint64(size)

    @classmethod
    def build(cls, first: np.ndarray, second: np.ndarray) -> PerfectHash:
        levels: list[np.ndarray] = []
        while len(first):
            at = cls._at(first, second, len(levels), 2 * len(first))
            alone = np.bincount(at, minlength=2 * len(first)) == 1
            levels.append(alone)
            rest = ~alone[at]
            first, second = first[rest], second[rest]
        return cls(levels)

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Numbers of the keys; for an unknown key any number, or -1."""
        out = np.full(len(first), -1, dtype=np.int64)
        open_ = np.arange(len(first))
        for level, bits in enumerate(self.levels):
            at = self._at(first[open_], second[open_], level, len(bits)).astype(np.int64)
            hit = bits[at]
            out[open_[hit]] = self.rank[self.starts[level] + at[hit]] - 1
            open_ = open_[~hit]
        return out

    def dump(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], dtype=np.int64)
        return sizes.tobytes() + b"".join(np.packbits(bits).tobytes() for bits in self.levels)

    @classmethod
    def load(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, np.int64, 1)[0])
        at, levels = 8 + 8 * n, []
        for size in np.frombuffer(data, np.int64, n, 8):
            packed = np.frombuffer(data, np.uint8, -(-int(size) // 8), at)
            levels.append(np.unpackbits(packed, count=int(size)).astype(bool))
            at += len(packed)
        return cls(levels)


class Shard:
    """One shard's perfect hash with the arrays it indexes."""

    def __init__(self, row: dict):
        self.hash = PerfectHash.load(row["hash"])
        self.prints = np.frombuffer(row["prints"], np.uint64)
        self.counts = np.frombuffer(row["counts"], np.int32)
        self.keepers = np.frombuffer(row["keepers"], np.int64)


def _build(keys: pd.DataFrame) -> pd.DataFrame:
    first, second = keys["first"].to_numpy().view(np.uint64), keys["second"].to_numpy().view(np.uint64)
    made = PerfectHash.build(first, second)
    at = made.find(first, second)
    prints, counts, keepers = np.empty(len(at), np.uint64), np.empty(len(at), np.int32), np.empty(len(at), np.int64)
    prints[at], counts[at], keepers[at] = second, np.minimum(keys["docs"], 2**31 - 1), keys["keeper"]
    parts = {"hash": made.dump(), "prints": prints.tobytes(), "counts": counts.tobytes(), "keepers": keepers.tobytes()}
    return pd.DataFrame([{"shard": keys["shard"].iloc[0], "asks": int(keys["docs"].sum()), **parts}])


class Probe:
    """Which lines of a batch go, by the shards of one group."""

    def __init__(self, rows: list[dict], shards: int, least: int, min_docs: int):
        self.shards = {row["shard"]: Shard(row) for row in rows}
        self.n, self.least, self.min_docs = shards, least, min_docs

    def doomed(self, texts: list[bytes], ids: list[int | None]) -> list[set[int]]:
        """For each text the numbers of its lines that go."""
        found = [long_keys(text, self.least) for text in texts]
        first, second = hashes([key for keys in found for _, key in keys])
        owner = np.repeat(np.arange(len(texts)), [len(keys) for keys in found])
        own = np.array([-1 if i is None else i for i in ids], dtype=np.int64)[owner] if len(owner) else np.zeros(0, np.int64)
        none = np.array([i is None for i in ids], dtype=bool)[owner] if len(owner) else np.zeros(0, bool)
        shard = (first % np.uint64(self.n)).astype(np.int64)
        gone = np.zeros(len(first), dtype=bool)
        for number in np.unique(shard):
            held = self.shards.get(int(number))
            if held is None:
                continue
            mine = np.flatnonzero(shard == number)
            at = held.hash.find(first[mine], second[mine])
            known = (at >= 0) & (held.prints[at] == second[mine]) & (held.counts[at] >= self.min_docs)
            gone[mine[known]] = none[mine[known]] | (held.keepers[at[known]] != own[mine[known]])
        lines = np.array([number for keys in found for number, _ in keys], dtype=np.int64)
        out: list[set[int]] = [set() for _ in texts]
        for text, line in zip(owner[gone].tolist(), lines[gone].tolist(), strict=True):
            out[text].add(line)
        return out


# --- operator -------------------------------------------------------------------------


def _line_hashes(docs: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, firsts, seconds = [], [], []
            for id_, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
                first, second = hashes(list({key: None for _, key in long_keys(text, least)}))
                ids += [id_] * len(first)
                firsts.append(first)
                seconds.append(second)
            columns = [np.concatenate(c).view(np.int64) if c else np.zeros(0, np.int64) for c in (firsts, seconds)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0]), pa.array(columns[1]), pa.array(ids, pa.int64())], names=["first", "second", "doc"]
            )

    slim = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "first long, second long, doc long")


def _shards(docs: DataFrame, id_col: str, text_col: str, least: int, min_docs: int, shard_keys: int) -> tuple[DataFrame, int]:
    keys = (
        _line_hashes(docs, id_col, text_col, least)
        .groupBy("first", "second")
        # A null id is one document, smaller than every other.
        .agg(
            (F.count_distinct("doc") + F.max(F.col("doc").isNull().cast("int"))).alias("docs"),
            F.max("doc").alias("keeper"),
        )
        .where(F.col("docs") >= min_docs)
    )
    keys = checkpointed(keys.select("first", "second", "docs", F.coalesce("keeper", F.lit(-1)).alias("keeper")))
    n = max(1, -(-keys.count() // shard_keys))
    # The hash is unsigned where it is probed.
    shard = F.expr(f"cast(((first % {n}L) + if(first < 0, {pow(2, 64, n)}L, 0L) + {n}L) % {n}L as long)")
    built = (
        keys.withColumn("shard", shard)
        .groupBy("shard")
        .applyInPandas(_build, "shard long, asks long, hash binary, prints binary, counts binary, keepers binary")
    )
    return checkpointed(built), n


def _lines_of(text: bytes, gone: list[dict], least: int) -> set[int]:
    """Numbers of the lines whose hashes are among those that go."""
    found = long_keys(text, least)
    first, second = hashes([key for _, key in found])
    wanted = {(g["first"], g["second"]) for g in gone}
    pairs = zip(first.view(np.int64).tolist(), second.view(np.int64).tolist(), strict=True)
    return {number for (number, _), pair in zip(found, pairs, strict=True) if pair in wanted}


def _answers(rows: DataFrame, built: DataFrame, n: int, least: int, min_docs: int) -> DataFrame:
    """(row, gone): for each ``row`` (with its ``text``) the hashes of its lines that go."""
    asked = StructType(
        [StructField("shard", LongType()), StructField("first", LongType()), StructField("second", LongType()), StructField("row", rows.schema["row"].dataType)]
    )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, firsts, seconds = [], [], []
            for at, text in enumerate(as_bytes(batch.column(1))):
                first, second = hashes(list({key: None for _, key in long_keys(text, least)}))
                owner += [at] * len(first)
                firsts.append(first)
                seconds.append(second)
            first, second = (np.concatenate(c) if c else np.zeros(0, np.uint64) for c in (firsts, seconds))
            shard = (first % np.uint64(n)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard), pa.array(first.view(np.int64)), pa.array(second.view(np.int64)), batch.column(0).take(pa.array(owner, pa.int64()))],
                names=asked.names,
            )

    asks = rows.distinct().mapInArrow(ask, asked)
    copies = F.greatest(F.lit(1), F.ceil(F.col("asks") / ASKS)).cast("int")
    # Shards above the border cannot be more than LARGE_SHARDS.
    total = built.agg(F.sum("asks")).first()[0] or 0
    many = built.where(F.col("asks") > max(ASKS, total // LARGE_SHARDS)).select("shard", copies.alias("copies"))
    asks = asks.join(F.broadcast(many), "shard", "left").withColumn(
        "copy", F.pmod(F.xxhash64("row"), F.coalesce("copies", F.lit(1))).cast("int")
    )
    arrays = [name for name in built.columns if name not in ("shard", "asks")]
    held = built.join(F.broadcast(many), "shard", "left").withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1))
    )
    none = [F.lit(None).cast("binary").alias(name) for name in arrays]
    both = held.select(
        "shard", "copy", F.lit(0).alias("kind"), *arrays, F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("second"),
        F.lit(None).cast(rows.schema["row"].dataType).alias("row"),
    ).unionByName(asks.select("shard", "copy", F.lit(1).alias("kind"), *none, "first", "second", "row"))
    met = both.repartition("shard", "copy").sortWithinPartitions("shard", "copy", "kind")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, shard = None, None
        for batch in batches:
            column = {name: batch.column(batch.schema.get_field_index(name)) for name in batch.schema.names}
            keys = list(zip(column["shard"].to_pylist(), column["copy"].to_pylist(), strict=True))
            kinds = column["kind"].to_numpy(zero_copy_only=False)
            cuts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1] or kinds[i] != kinds[i - 1]] + [len(keys)]
            for start, stop in zip(cuts, cuts[1:], strict=False):
                if kinds[start] == 0:
                    key, shard = keys[start], Shard({name: column[name][start].as_py() for name in arrays})
                    continue
                # No array, no line that goes.
                if keys[start] != key:
                    continue
                first, second = (column[name].slice(start, stop - start).to_numpy(zero_copy_only=False).astype(np.int64) for name in ("first", "second"))
                asker = column["row"].slice(start, stop - start)
                ids = asker.field("id") if hasattr(asker, "field") else asker.combine_chunks().field("id")
                at = shard.hash.find(first.view(np.uint64), second.view(np.uint64))
                known = (at >= 0) & (shard.prints[at] == second.view(np.uint64)) & (shard.counts[at] >= min_docs)
                own = np.array([-1 if i is None else i for i in ids.to_pylist()], dtype=np.int64)
                none_ = np.array([i is None for i in ids.to_pylist()], dtype=bool)
                goes = np.flatnonzero(known & (none_ | (shard.keepers[np.maximum(at, 0)] != own)))
                yield pa.RecordBatch.from_arrays(
                    [asker.take(pa.array(goes)), pa.array(first[goes]), pa.array(second[goes])], names=["row", "first", "second"]
                )

    back = StructType([asked["row"], asked["first"], asked["second"]])
    goes = met.mapInArrow(answer, back)
    return goes.groupBy("row").agg(F.collect_set(F.struct("first", "second")).alias("gone"))


ADDED = StructType([StructField("n_lines", LongType()), StructField("n_dropped", LongType())])


def _cut(text: bytes, gone: set[int]) -> str:
    return b"\n".join(line for n, line in enumerate(text.split(b"\n")) if n not in gone).decode("utf-8", "replace")


def dedup_lines(
    docs: DataFrame,
    min_docs: int = 5,
    least: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_keys: int = SHARD_KEYS,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """Replace each text by its kept lines, and add ``n_lines`` (before) and ``n_dropped``.

    Keys of at least ``least`` code points that at least ``min_docs`` documents hold lose
    all their lines, except in the document with the largest id that holds them; there all
    stay. Rows with the same id are one document. A null id is one document, smaller than
    every other. A null or empty text is one empty line and becomes the empty text. An
    empty table gives an empty one; input columns with the names of added ones are
    replaced, all others are kept.
    """
    small_batches(docs.sparkSession)
    built, n = _shards(docs, id_col, text_col, least, min_docs, shard_keys)
    added = StructType([StructField(text_col, StringType()), *ADDED.fields])

    def columns(texts: list[bytes], gone: list[set[int]]) -> dict:
        return {
            text_col: pa.array([_cut(t, g) if g else t.decode("utf-8", "replace") for t, g in zip(texts, gone, strict=True)], pa.string()),
            "n_lines": pa.array([t.count(b"\n") + 1 for t in texts], pa.int64()),
            "n_dropped": pa.array([len(g) for g in gone], pa.int64()),
        }

    if n * shard_keys * KEY_BYTES <= group_bytes:
        # At most group_bytes, by the number of keys counted.
        rows = [{k: bytes(v) if isinstance(v, bytearray) else v for k, v in row.asDict().items()} for row in built.collect()]
        held = docs.sparkSession.sparkContext.broadcast((rows, n, least, min_docs))

        def cut(batches):
            probe = Probe(*held.value)
            for batch in batches:
                texts = as_bytes(batch[text_col])
                yield columns(texts, probe.doomed(texts, batch[id_col].to_pylist()))

        return with_columns(docs, [id_col, text_col], added, cut)

    # Rows alike in id and text lose the same lines. Of the text 256 bits, which no two texts share.
    row = F.struct(F.col(id_col).cast("long").alias("id"), F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("said"))
    gone = _answers(docs.select(row.alias("row"), F.col(text_col).alias("text")), built, n, least, min_docs)
    names = docs.columns
    apart = docs.select(packed(names).alias("_kept"), F.col(text_col).alias("_text"), row.alias("row")).join(gone, "row", "left")

    def cut_answered(batches):
        for batch in batches:
            texts = as_bytes(batch["_text"])
            lines = [_lines_of(t, g, least) if g else set() for t, g in zip(texts, batch["gone"].to_pylist(), strict=True)]
            made = columns(texts, lines)
            yield {"_made": pa.StructArray.from_arrays([made[name] for name in added.names], names=added.names)}

    made = with_columns(apart, ["_text", "gone"], StructType([StructField("_made", added)]), cut_answered)
    new = {name.lower(): name for name in added.names}
    replaced = [F.col(f"_made.{new.pop(name.lower())}").alias(name) if name.lower() in new else unpacked([name])[0] for name in names]
    return made.select(*replaced, *[F.col(f"_made.{name}").alias(name) for name in new.values()])
