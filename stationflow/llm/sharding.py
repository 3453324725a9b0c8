"""Shards by a keyed permutation of global row numbers.

Rows are numbered in the order of their id, size and text, whatever the partitioning. A
Feistel network over the numbers 0 to n-1 moves number r to p(r); shard p mod k and slot
p div k follow by arithmetic, so shard sizes differ by one at most and the place of a row,
or the row of a place, can be computed without the data.

Nothing but DataFrame functions. Each row is shuffled once, by range; repeated rows may
lie in several ranges, so no id is a hot spot.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import before, in_order, packed, short_reads, unpacked

ROUNDS = 4
LONGEST_WALK = 64


class Permutation:
    """A permutation of 0 to n-1, as Column expressions in both directions.

    The network works on pairs (left, right) with left < a and right < b, a power of two
    near the root of n. At most b-1 of the a*b pairs lie beyond n; a number that lands
    there walks on. A walk takes b steps at most, and beyond ``LONGEST_WALK`` steps (a
    chance below n^-32) the query fails rather than place a row twice.
    """

    def __init__(self, n: int, seed: int = 42):
        self.n, self.seed = max(1, n), seed
        self.bits = int(math.log2(math.isqrt(self.n)))
        self.b = 1 << self.bits
        self.a = -(-self.n // self.b)
        self.steps = min(self.a * self.b - self.n + 1, LONGEST_WALK)

    def _noise(self, value: Column, turn: int, below: int) -> Column:
        return F.pmod(F.xxhash64(value, F.lit(turn), F.lit(self.seed)), F.lit(below).cast("long"))

    def _apply(self, x: Column, sign: int) -> Column:
        left, right = F.shiftright(x, self.bits), x.bitwiseAND(F.lit(self.b - 1).cast("long"))
        for turn in range(ROUNDS)[::sign]:
            if turn % 2 == 0:
                left = F.pmod(left + sign * self._noise(right, turn, self.a), F.lit(self.a).cast("long"))
            else:
                right = F.pmod(right + sign * self._noise(left, turn, self.b), F.lit(self.b).cast("long"))
        return left * F.lit(self.b).cast("long") + right

    def _walk(self, x: Column, sign: int) -> Column:
        n = F.lit(self.n).cast("long")
        out = F.aggregate(
            F.sequence(F.lit(1), F.lit(self.steps)),
            self._apply(x.cast("long"), sign),
            lambda at, _: F.when(at < n, at).otherwise(self._apply(at, sign)),
        )
        return F.when(out < n, out).otherwise(F.raise_error(F.lit("walk too long; take another seed")).cast("long"))

    def forward(self, x: Column) -> Column:
        return self._walk(x, 1)

    def backward(self, x: Column) -> Column:
        return self._walk(x, -1)


def row_at(shard: Column, slot: Column, shards: int, permutation: Permutation) -> Column:
    """The row number at a place."""
    return permutation.backward(slot * F.lit(shards) + shard)


def assign(
    df: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, seed: int = 42
) -> DataFrame:
    """Give every row a shard and a slot; law ``rows``.

    Adds ``size`` (UTF-8 bytes plus 16), ``text_crc32``, ``law``, ``row_number``, ``shard``,
    ``slot`` (0 up, without gaps) and ``grown_shard`` (null: this law moves rows when a
    shard is added). ``keep`` names the columns to carry, all by default.

    Null ids come first, a null text counts as no bytes. Rows alike in id and text are
    interchangeable: which of them gets which of their places is left open. An empty table
    gives an empty one. Input columns with the names of added ones are replaced.
    """
    added = ["size", "text_crc32", "law", "row_number", "shard", "slot", "grown_shard"]
    text = F.coalesce(F.col(text_col), F.lit("")) if text_col in df.columns else F.lit("")
    kept = [name for name in (df.columns if keep is None else keep) if name not in added]
    narrow = df.select(
        packed(kept).alias("_kept"),
        F.col(id_col).alias("_id"),
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("_hash"),
    )
    # The only step that reads whole texts, and it runs here.
    with short_reads(df.sparkSession):
        rows = in_order(narrow, "_id", "size", "text_crc32", "_hash")
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    n = parts.agg(F.sum("_rows")).first()[0] or 0
    # One row for each range, so the broadcast is as small as the list of tasks.
    starts = parts.select("_part", F.coalesce(before(parts, F.sum("_rows")), F.lit(0)).alias("_start"))
    place = Permutation(n, seed).forward(F.col("row_number"))
    return (
        rows.join(F.broadcast(starts), "_part")
        .withColumn("row_number", F.col("_start") + F.col("_at"))
        .withColumn("_to", place)
        .select(
            *unpacked(kept),
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            "row_number",
            (F.col("_to") % shards).cast("int").alias("shard"),
            F.expr(f"_to div {int(shards)}").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
