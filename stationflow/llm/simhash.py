"""SimHash near-duplicates by bit-sliced comparison.

A text's word shingles are hashed; each fingerprint bit is the majority over all shingles.
Documents with the same fingerprint are one node. Nodes that can be close meet in blocks:

* bands: the 64 bits are cut into ``radius + 2`` bands. Two fingerprints that differ in at
  most ``radius`` bits agree in two bands at least, so a block for each pair of bands and
  their values loses no link;
* minima: for a wide radius, where bands would be too short, a block for each of
  ``MINIMA`` smallest shingle hashes. Texts whose shingle sets have similarity s share
  none of them with probability (1 - s)^MINIMA only: 6e-5 for s = 0.8.

In a block the fingerprints are stored as vertical bit planes. A query bit turns a plane
into the differences of 64 fingerprints per machine word; carry-save counters add them for
all at once, and a tile is abandoned as soon as all its counts exceed the radius. Links
are reduced to a spanning forest within the block, never listed as pairs. A key too large for
a block has a hub: what is close to it is linked by that, and only the rest meets all others.

Fingerprints only estimate similarity. With ``similarity`` they choose candidates: nodes
that candidate links connect are a family, the sets of shingles of its members are
compared, and only pairs that have that Jaccard similarity are linked.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from .common import as_bytes, checkpointed, with_columns
from .components import components, join_dealt

SEED = 42
MINIMA = 6
#: Fingerprints of a block; what is far from the hub of a key with more is split into blocks that meet in pairs.
BLOCK = 2048
#: Members of a family that meet in a unit of a comparison by sets, and their shingles; a family with more is dealt.
MEMBERS, WEIGHT = 256, 1 << 19
#: Units of a task, at most.
UNITS = 1000
#: Keys known to be larger than a block, at most: they are broadcast (16 bytes each).
LARGE_KEYS = 1_000_000
#: Edges of two sides that meet, from which on they are reduced to those between the trees of each side.
FEW = 64
#: Shingles that are unpacked to bits at once.
AT_ONCE = 1 << 17
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


# --- fingerprints ---------------------------------------------------------------------


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of each run of ``words`` words, repeats included; of all words if there are fewer."""
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]).tolist()
    size = min(words, len(parts))
    starts = [0, *ends[: len(parts) - size]]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s : e - 1], SEED) for s, e in zip(starts, ends[size - 1 :], strict=True)], dtype=np.uint64)


def _majority(hashes: np.ndarray, owner_starts: np.ndarray, counts: np.ndarray, lanes: int) -> np.ndarray:
    """Bits (64 per lane) set in over half the hashes of each owner; owners without hashes are zero."""
    out = np.zeros((len(counts), lanes), dtype="<u8")
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    for lane in range(lanes):
        with np.errstate(over="ignore"):
            mixed = hashes if lane == 0 else (hashes ^ (_SPREAD * np.uint64(lane))) * _SPREAD
            if lane:
                mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
                mixed ^= mixed >> np.uint64(29)
        sums = np.zeros((len(full), 64), dtype=np.int64)
        for at in range(0, len(mixed), AT_ONCE):
            part = mixed[at : at + AT_ONCE].astype("<u8")
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            first = np.searchsorted(owner_starts[full], at, side="right") - 1
            last = np.searchsorted(owner_starts[full], at + len(part) - 1, side="right") - 1
            cuts = np.maximum(owner_starts[full][first : last + 1] - at, 0)
            sums[first : last + 1] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
        majority = (2 * sums > counts[full][:, None]).astype(np.uint8)
        out[full, lane] = np.packbits(majority, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprints(parts: list[np.ndarray], lanes: int, minima: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints (texts x lanes) and the ``minima`` smallest mixed hashes, given the shingle hashes of each text."""
    counts = np.array([len(p) for p in parts], dtype=np.int64)
    starts = np.cumsum(counts) - counts
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    least = np.zeros((len(parts), minima), dtype=np.uint64)
    full = np.flatnonzero(counts)
    for k in range(minima if len(full) else 0):
        with np.errstate(over="ignore"):
            mixed = (flat ^ (np.uint64(k + 1) * np.uint64(0xD6E8FEB86659FD93))) * _SPREAD
            mixed ^= mixed >> np.uint64(32)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
        least[full, k] = np.minimum.reduceat(mixed, starts[full])
    return _majority(flat, starts, counts, lanes), least


def with_fingerprint(
    docs: DataFrame, words: int = 3, lanes: int = 1, minima: int = 0, text_col: str = "text", sets: bool = False
) -> DataFrame:
    """Add ``print`` (8 bytes a lane, big-endian) and, if asked for, ``minima`` (array of long).

    With ``sets`` a repeated shingle counts once, and ``node`` (a hash of the set) is added.
    """
    fields = [StructField("print", BinaryType())] + [StructField("minima", ArrayType(LongType()))] * bool(minima)
    fields += [StructField("node", LongType())] * sets

    def make(batches):
        for batch in batches:
            texts = as_bytes(batch[text_col])
            found, least, nodes = [], [], []
            # A few texts at a time: their hashes are held together.
            for i in range(0, len(texts), 256):
                parts = [shingle_hashes(t, words) for t in texts[i : i + 256]]
                if sets:
                    parts = [np.unique(part) for part in parts]
                    nodes += [_signed(xxhash.xxh64_intdigest(part.tobytes(), SEED)) for part in parts]
                prints, smallest = fingerprints(parts, lanes, minima)
                found += [row.astype(">u8").tobytes() for row in prints]
                least += smallest.view(np.int64).tolist()
            out = {"print": pa.array(found, pa.binary())}
            if minima:
                out["minima"] = pa.array(least, pa.list_(pa.int64()))
            if sets:
                out["node"] = pa.array(nodes, pa.int64())
            yield out

    return with_columns(docs, [text_col], StructType(fields), make)


# --- bit-sliced comparison ------------------------------------------------------------


def planes(prints: np.ndarray) -> np.ndarray:
    """Vertical bit planes: row b holds bit b of every fingerprint, 64 to a word."""
    bits = np.unpackbits(np.ascontiguousarray(prints.astype("<u8")).view(np.uint8), axis=1, bitorder="little").T
    padded = np.zeros((bits.shape[0], -(-bits.shape[1] // 64) * 64), dtype=np.uint8)
    padded[:, : bits.shape[1]] = bits
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def close(queries: np.ndarray, block: np.ndarray, radius: int, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(query, fingerprint) numbers that differ in at most ``radius`` bits.

    ``skip`` (queries x words) marks pairs not asked for, in the layout of the planes.
    """
    stored = planes(block)
    n_words = stored.shape[1]
    ones = ~np.uint64(0)
    asked = np.unpackbits(np.ascontiguousarray(queries.astype("<u8")).view(np.uint8), axis=1, bitorder="little").astype(bool)
    over = np.zeros((len(queries), n_words), dtype=np.uint64) if skip is None else skip.copy()
    if len(block) % 64:
        over[:, -1] |= ones << np.uint64(len(block) % 64)
    # The counters start so that radius + 1 differences overflow into the top one.
    width = max(1, radius.bit_length()) + 1
    start = (1 << (width - 1)) - (radius + 1)
    counters = [np.full(over.shape, ones if start >> i & 1 else 0, dtype=np.uint64) for i in range(width - 1)]
    for bit in range(stored.shape[0]):
        carry = stored[bit][None, :] ^ np.where(asked[:, bit], ones, np.uint64(0))[:, None]
        for counter in counters:
            carry, counter[...] = counter & carry, counter ^ carry
        over |= carry
        if bit >= radius and bit % 8 == 7 and (over == ones).all():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, columns = np.nonzero(np.unpackbits((~over).view(np.uint8), axis=1, bitorder="little"))
    return rows, columns


def _later(first: int, count: int, size: int) -> np.ndarray:
    """Marks for each query number first.. all fingerprints up to itself."""
    marks = np.arange(-(-size // 64) * 64)[None, :] <= np.arange(first, first + count)[:, None]
    return np.packbits(marks, axis=1, bitorder="little").view("<u8").astype(np.uint64)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number each number is linked to."""
    root = np.arange(n)
    while True:
        before = root.copy()
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = root[root]
        if (root == before).all():
            return root


def forest(prints: np.ndarray, radius: int, halves: int | None = None, tile: int = 256) -> np.ndarray:
    """For each fingerprint of a block the first one it is linked to.

    With ``halves`` only pairs across that border are compared: the sides of two blocks.
    """
    n = len(prints)
    root = np.arange(n)
    border = n if halves is None else halves
    if halves == n:
        return root
    for at in range(0, border, tile):
        part = prints[at : min(at + tile, border)]
        if halves is None:
            # Fingerprints before this tile have met it already.
            base = at - at % 64
            rows, columns = close(part, prints[base:], radius, _later(at - base, len(part), n - base))
            columns = columns + base
        else:
            rows, columns = close(part, prints[border:], radius)
            columns = columns + border
        if len(rows):
            root = _roots(n, np.concatenate([np.arange(n), rows + at]), np.concatenate([root, columns]))
    return root


def bridges(root: np.ndarray, nodes: np.ndarray, prints: np.ndarray, radius: int, side: int) -> np.ndarray:
    """``root`` of two sides that meet, reduced to edges between trees: those within a side are found in a block of its own.

    A second side of one node only, however many fingerprints it has, is one tree.
    """
    n = len(root)
    second = np.zeros(n - side, dtype=np.int64) if (nodes[side:] == nodes[side]).all() else forest(prints[side:], radius)
    tree = np.concatenate([forest(prints[:side], radius), side + second])
    linked = np.flatnonzero(root != np.arange(n))
    return _roots(n, tree[linked], tree[root[linked]])


# --- links ----------------------------------------------------------------------------


def _band_pairs(radius: int) -> list[tuple[int, int]]:
    """Masks, as (shift, bits) joined pairwise, of bands of which close prints share two."""
    n = radius + 2
    edges = [64 * i // n for i in range(n + 1)]
    masks = [(((1 << (e - s)) - 1) << s) for s, e in itertools.pairwise(edges)]
    return [a | b for a, b in itertools.combinations(masks, 2)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def band_keys(nodes: DataFrame, radius: int) -> DataFrame:
    """(key, node, print): a row for each pair of bands of each fingerprint; ``node`` is its 64 bits."""
    value = F.col("node")
    keys = [F.xxhash64(value.bitwiseAND(F.lit(_signed(mask))), F.lit(i)) for i, mask in enumerate(_band_pairs(radius))]
    bytes_ = F.unhex(F.lpad(F.hex(value), 16, "0")).alias("print")
    return nodes.select(F.explode(F.array(*keys)).alias("key"), "node", bytes_)


def minima_keys(rows: DataFrame) -> DataFrame:
    """(key, node, print): a row for each smallest shingle hash of the texts behind a fingerprint."""
    keys = F.explode(F.transform("minima", lambda m, i: F.xxhash64(m, i))).alias("key")
    return rows.select(keys, "node", "print").distinct()


def links(keyed: DataFrame, lanes: int, radius: int) -> DataFrame:
    """Edges (a, b) between nodes whose fingerprints are close: a spanning forest for each block.

    ``keyed`` has ``key``, ``node`` (both long) and ``print``. Rows of one key are sorted
    together; keys of a single row are passed over, short keys share a
    block, and what is far from the hub of a key with more than ``BLOCK`` rows is dealt to blocks that
    meet in pairs, each pair in a group of its own.
    """
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    total, largest = (n or 0 for n in sizes.agg(F.sum("size"), F.max("size")).first())
    # Keys above a border cannot be more than LARGE_KEYS.
    border = max(BLOCK, total // LARGE_KEYS)
    whole = [F.lit(0).alias(name) for name in ("low", "high", "mine")]
    if largest <= border:
        return _forests(keyed.select("key", *whole, "node", "print"), lanes, radius)
    large = F.broadcast(sizes.where(F.col("size") > border).select("key"))
    short = keyed.join(large, "key", "left_anti").select("key", *whole, "node", "print")
    found, placed = _large_keys(keyed.join(large, "key"), lanes, radius, total)
    return found.unionByName(_forests(short.unionByName(placed), lanes, radius))


def _large_keys(rows: DataFrame, lanes: int, radius: int, total: int) -> tuple[DataFrame, DataFrame]:
    """Links of keys too large for a block: edges to the hub, and the blocks that are still to be compared.

    The hub of a key is its smallest node. Nodes close to it are connected by that and need
    no comparison among themselves: they come as the hub, in parts that meet those of the
    far nodes only.
    """
    hubs = rows.groupBy("key").agg(F.min(F.struct("node", "print")).alias("hub"))
    met = join_dealt(rows, hubs.select("key", F.col("hub.node").alias("hub"), F.col("hub.print").alias("of_hub")), "key", "node", total)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "node", "print", "hub"]
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(name)) for name in [*names, "of_hub"]]
            mine, hub = (np.frombuffer(b"".join(columns[i].to_pylist()), dtype=">u8").reshape(-1, lanes) for i in (2, 4))
            near = np.bitwise_count(mine ^ hub).sum(axis=1, dtype=np.int64) <= radius
            yield pa.RecordBatch.from_arrays([*columns[:-1], pa.array(near)], names=[*names, "near"])

    judged = checkpointed(met.mapInArrow(judge, "key long, node long, print binary, hub long, near boolean"))
    found = judged.where(F.col("near") & (F.col("node") != F.col("hub"))).select(F.col("node").alias("a"), F.col("hub").alias("b"))
    parts = lambda rows_: F.ceil(F.count_if(rows_) / BLOCK).cast("int")
    left = judged.groupBy("key").agg(parts(~F.col("near")).alias("_far"), parts(F.col("near")).alias("_near")).where(F.col("_far") > 0)
    spot = lambda parts_: F.pmod(F.xxhash64("node", F.lit(7)), F.col(parts_)).cast("int")
    every = F.sequence(F.lit(0), F.when(F.col("near"), F.col("_far")).otherwise(F.col("_far") + F.col("_near")) - 1)
    placed = (
        judged.join(F.broadcast(left), "key")
        .withColumn("mine", F.when(F.col("near"), F.col("_far") + spot("_near")).otherwise(spot("_far")))
        .withColumn("other", F.explode(every))
        .withColumn("node", F.when(F.col("near"), F.col("hub")).otherwise(F.col("node")))
        .select(
            "key", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine", "node", "print"
        )
    )
    return found, placed


def _forests(placed: DataFrame, lanes: int, radius: int) -> DataFrame:
    """Edges (a, b): a spanning forest for each block.

    ``placed`` has ``key``, ``low`` and ``high`` (a block or, if they differ, two whose sides
    meet), ``mine`` (one of both), ``node`` and ``print``.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]):
            nodes_ = np.concatenate([b[0] for b in blocks])
            prints = np.concatenate([b[1] for b in blocks])
            side = int((blocks[0][2] == blocks[0][2].min()).sum()) if blocks[0][3] else None
            root = forest(prints, radius, side)
            if side is not None and np.count_nonzero(root != np.arange(len(root))) > FEW:
                root = bridges(root, nodes_, prints, radius, side)
            linked = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_arrays([pa.array(nodes_[linked]), pa.array(nodes_[root[linked]])], names=["a", "b"])

        def groups():
            """Rows of one (key, low, high), in order; they may span Arrow batches."""
            rest = None
            for batch in batches:
                prints = np.frombuffer(b"".join(batch.column(5).to_pylist()), dtype=">u8").astype(np.uint64).reshape(-1, lanes)
                keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1, 2, 3, 4)], axis=1)
                if rest is not None:
                    keys, prints = np.concatenate([rest[0], keys]), np.concatenate([rest[1], prints])
                if not len(keys):
                    continue
                cuts = np.flatnonzero((keys[1:, :3] != keys[:-1, :3]).any(axis=1)) + 1
                last = int(cuts[-1]) if len(cuts) else 0
                sizes_ = np.diff(np.concatenate([[0], cuts]))
                for i in np.flatnonzero(sizes_ > 1).tolist():
                    start = int(cuts[i] - sizes_[i])
                    yield keys[start : cuts[i]], prints[start : cuts[i]]
                rest = keys[last:], prints[last:]
            if rest is not None and len(rest[0]) > 1:
                yield rest

        held, size = [], 0
        for keys, prints in groups():
            crossing = keys[0, 1] != keys[0, 2]
            block = (keys[:, 4], prints, keys[:, 3], crossing)
            if crossing:
                yield flush([block])
                continue
            if held and size + len(keys) > 512:
                yield flush(held)
                held, size = [], 0
            held.append(block)
            size += len(keys)
        if held:
            yield flush(held)

    # In the order of their nodes, so that trees found by several keys have the same edges.
    order = ["key", "low", "high", "mine", "node"]
    return placed.repartition("key", "low", "high").sortWithinPartitions(*order).mapInArrow(compare, "a long, b long")


def similar(a: np.ndarray, b: np.ndarray, similarity: tuple[int, int]) -> bool:
    """Whether two sorted sets have at least this Jaccard similarity (a fraction)."""
    part, whole = similarity
    if whole * min(len(a), len(b)) < part * max(len(a), len(b)):
        return False
    common = len(a) + len(b) - len(np.union1d(a, b))
    return whole * common >= part * (len(a) + len(b) - common)


def alike(sets: list[np.ndarray], similarity: tuple[int, int], asking: np.ndarray | None = None) -> np.ndarray:
    """For each set one that it is reached from over pairs of at least this Jaccard similarity (a fraction).

    With ``asking`` (marks) only pairs count of which one or both are marked.
    """
    part, whole = similarity
    order = np.argsort([len(s) for s in sets], kind="stable")
    asks = np.ones(len(sets), dtype=bool) if asking is None else asking[order]
    sizes = np.array([len(sets[i]) for i in order], dtype=np.int64)
    codes = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)[1]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    # Smaller and larger sets than these cannot be similar enough.
    lows = np.maximum(np.searchsorted(sizes, -(-sizes * part // whole)), int((sizes == 0).sum()))
    highs = np.searchsorted(sizes, sizes * whole // part, side="right")
    root = np.arange(len(sets))
    mine = np.zeros(int(codes.max(initial=-1)) + 1, dtype=bool)
    for i in np.flatnonzero(asks & (sizes > 0)).tolist():
        # A pair of two marked sets is met once.
        low, high = (int(lows[i]), int(highs[i])) if asking is not None else (i + 1, int(highs[i]))
        if low >= high or not (root[low:high] != root[i]).any():
            continue
        mine[codes[starts[i] : ends[i]]] = True
        common = np.add.reduceat(mine[codes[starts[low] : ends[high - 1]]], starts[low:high] - starts[low], dtype=np.int64)
        mine[codes[starts[i] : ends[i]]] = False
        hit = whole * common >= part * (sizes[i] + sizes[low:high] - common)
        root[np.isin(root, root[low:high][hit])] = root[i]
    out = np.arange(len(sets))
    out[order] = order[root]
    return out


def _sets(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(value, dtype="<u8") for value in column.to_pylist()]


def shingle_sets(families: DataFrame, rows: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(family, node, hub, weight, shingles): the sorted set of each candidate, hashed once; ``hub`` is a node of the family.

    ``rows`` has ``node`` and ``said``, ``texts`` has ``said`` and ``text``. Equal texts
    shrink before the shuffle.
    """
    spoken = rows.groupBy("node").agg(F.min("said").alias("said"))
    unique = texts.groupBy("said").agg(F.first("text").alias("text"))
    first = F.min(F.struct(F.xxhash64("node"), F.col("node").alias("hub"))).alias("first")
    hubs = families.groupBy("family").agg(first).select("family", "first.hub")
    named = join_dealt(families, hubs, "family", "node", families.count())
    placed = named.join(spoken, "node").join(unique, "said").select("family", "node", "hub", "text")

    def make(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            sets = [np.unique(shingle_hashes(t, words)) for t in as_bytes(batch["text"])]
            yield {
                "weight": pa.array([len(s) for s in sets], pa.int64()),
                "shingles": pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary()),
            }

    added = StructType([StructField("weight", LongType()), StructField("shingles", BinaryType())])
    return checkpointed(with_columns(placed, ["text"], added, make).drop("text"))


def _trees(placed: DataFrame, keys: list[str], similarity: tuple[int, int]) -> DataFrame:
    """Edges (a, b) between similar sets of each unit: a spanning forest.

    ``placed`` has the key columns, ``node``, ``asks`` (pairs of which one asks are compared)
    and ``shingles``, the rows of a unit in one partition. A node may come twice, once asking.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            nodes, firsts = np.unique(np.array(held["node"], dtype=np.int64), return_index=True)
            marks = np.array(held["asks"], dtype=bool)
            asking = None if marks.all() else np.isin(nodes, np.array(held["node"], dtype=np.int64)[marks])
            root = alike([held["set"][i] for i in firsts], similarity, asking)
            linked = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_arrays([pa.array(nodes[linked]), pa.array(nodes[root[linked]])], names=["a", "b"])

        current, held = None, {"node": [], "asks": [], "set": []}
        for batch in batches:
            at = zip(*[batch.column(i).to_pylist() for i in range(len(keys))], strict=True)
            rest = (batch.column(i).to_pylist() for i in (len(keys), len(keys) + 1))
            for key, node, asks, set_ in zip(at, *rest, _sets(batch.column(len(keys) + 2)), strict=True):
                if key != current:
                    if len(held["node"]) > 1:
                        yield flush()
                    current, held = key, {"node": [], "asks": [], "set": []}
                for name, value in (("node", node), ("asks", asks), ("set", set_)):
                    held[name].append(value)
        if len(held["node"]) > 1:
            yield flush()

    rows = placed.select(*keys, "node", "asks", "shingles").sortWithinPartitions(*keys)
    return rows.mapInArrow(compare, "a long, b long")


def verified(sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Edges (a, b) that connect what pairs of a family with that similarity of their sets connect.

    Families of at most ``MEMBERS`` (and ``WEIGHT`` shingles) are compared in one place. In a
    larger one every member is compared with one of them, the hub; those that are similar
    to it need no other comparison among themselves. The rest meet all members of their
    family, in units of at most ``MEMBERS`` of either side, dealt over tasks.
    """
    sizes = sets.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("heavy"))
    total, weight = (n or 0 for n in sizes.agg(F.sum("n"), F.sum("heavy")).first())
    # Families above a border cannot be more than LARGE_KEYS; two members need no more than one comparison.
    over = (F.col("n") > max(MEMBERS, total // LARGE_KEYS)) | (F.col("heavy") > max(WEIGHT, weight // LARGE_KEYS))
    large = checkpointed(sizes.where(over & (F.col("n") > 2)).select("family", F.lit(True).alias("large")), total // 3)
    marked = sets.join(F.broadcast(large), "family", "left")
    small = marked.where(F.col("large").isNull()).withColumn("asks", F.lit(True))
    found = _trees(small.repartition("family"), ["family"], similarity)
    if large.isEmpty():
        return found
    return found.unionByName(_large_families(checkpointed(marked.where("large").drop("large")), similarity))


def _large_families(sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    total = sets.count()
    hubs = sets.where(F.col("node") == F.col("hub")).select("family", F.col("shingles").alias("of_hub"))
    met = join_dealt(sets, hubs, "family", "node", total)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ["family", "node", "hub", "weight"]
            columns = [batch.column(batch.schema.get_field_index(name)) for name in names]
            pairs = zip(*[_sets(batch.column(batch.schema.get_field_index(name))) for name in ("shingles", "of_hub")], strict=True)
            near = pa.array([similar(a, b, similarity) for a, b in pairs], pa.bool_())
            yield pa.RecordBatch.from_arrays([*columns, near], names=[*names, "near"])

    judged = checkpointed(met.mapInArrow(judge, "family long, node long, hub long, weight long, near boolean"))
    found = judged.where(F.col("near") & (F.col("node") != F.col("hub"))).select(F.col("node").alias("a"), F.col("hub").alias("b"))
    far = ~F.col("near")
    stats = judged.groupBy("family").agg(
        F.count(F.lit(1)).alias("n"), F.sum("weight").alias("heavy"),
        F.count_if(far).alias("n_far"), F.sum(F.when(far, F.col("weight")).otherwise(0)).alias("heavy_far"),
    )
    parts = lambda n, heavy: F.ceil(F.greatest(F.col(n) / MEMBERS, F.least(n, F.col(heavy) / WEIGHT))).cast("int")
    left = checkpointed(
        stats.where(F.col("n_far") > 0).select("family", parts("n_far", "heavy_far").alias("rows"), parts("n", "heavy").alias("columns")),
        total // 3,
    )
    if left.isEmpty():
        return found
    open_ = join_dealt(judged.select("family", "node", "near"), left, "family", "node", total).where(F.col("rows").isNotNull())
    # Each set travels once more, for the families that are left.
    members = sets.select("node", "shingles").join(open_, "node")
    spot = lambda parts_: F.pmod(F.xxhash64("node", F.lit(7)), F.col(parts_)).cast("int")
    every = lambda parts_: F.explode(F.sequence(F.lit(0), F.col(parts_) - 1))
    asking = members.where(~F.col("near")).withColumn("row", spot("rows")).withColumn("column", every("columns"))
    asked = members.withColumn("column", spot("columns")).withColumn("row", every("rows"))
    both = asking.withColumn("asks", F.lit(True)).unionByName(asked.withColumn("asks", F.lit(False)))
    # Units of one family go round all partitions, so none gets many of them by chance.
    units = left.agg(F.sum(F.col("rows").cast("long") * F.col("columns"))).first()[0]
    n = max(min(units, int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))), -(-units // UNITS))
    turn = F.pmod(F.xxhash64("family"), F.lit(n)) + F.col("row").cast("long") * F.col("columns") + F.col("column")
    placed = both.repartitionById(n, F.pmod(turn, F.lit(n)).cast("int"))
    return found.unionByName(_trees(placed, ["family", "row", "column"], similarity))


# --- operator -------------------------------------------------------------------------


def _with_smallest(named: DataFrame) -> DataFrame:
    """Add ``component_id``: the smallest ``least`` of each component.

    ``named`` has ``node``, ``least``, ``component`` and ``linked``; a node without links is
    its own component and needs no partner.
    """
    linked = named.where("linked")
    smallest = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    return join_dealt(named, smallest, "component", "node", named.count()).select(
        "node", "component", F.coalesce("component_id", "least").alias("component_id")
    )


def group_near_duplicates(
    docs: DataFrame,
    words: int = 3,
    radius: int = 2,
    lanes: int = 1,
    minima: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: str | None = None,
    similarity: tuple[int, int] | None = None,
) -> DataFrame:
    """(doc_id, fingerprint, component_id, component), a row for each input row.

    Fingerprints (64 bits a lane, as hex digits) link at ``radius`` differing bits or
    fewer; ``component`` names the set reachable over links, ``component_id`` is the
    smallest id in it. Equal fingerprints are linked, zero ones (texts without words,
    nulls) too. With ``minima`` = 0 every link is found; otherwise those of texts that
    share one of so many smallest shingle hashes. With ``similarity`` (a fraction, part and
    whole) a link also needs that Jaccard similarity of the sets of shingles, and equal sets
    are linked instead of equal fingerprints. Null ids are ignored for the smallest
    id; a component of null ids has a null one. Repeated rows are fine; an empty table
    gives an empty one; of other columns only ``carry`` is kept.
    """
    if not minima and (lanes != 1 or radius > 4):
        raise ValueError("bands are for one lane and a radius of up to 4; ask for minima")
    if similarity and not minima:
        raise ValueError("similarity needs minima")
    carried = [carry] if carry else []
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *carried)
    said = F.xxhash64(F.coalesce("text", F.lit(""))).alias("said")
    if similarity:
        rows = checkpointed(with_fingerprint(slim.select("*", said), words, lanes, minima, sets=True).drop("text"))
    else:
        printed = with_fingerprint(slim, words, lanes, minima).drop("text")
        # Wider fingerprints are named by a hash of theirs.
        node = F.xxhash64("print") if lanes > 1 else F.conv(F.hex("print"), 16, -10).cast("long")
        rows = checkpointed(printed.withColumn("node", node))
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("least"))
    if similarity:
        candidates = components(links(minima_keys(rows), lanes, radius))
        families = candidates.withColumnRenamed("component", "family")
        found = verified(shingle_sets(families, rows, slim.select(said, "text"), words), similarity)
    else:
        found = links(minima_keys(rows) if minima else band_keys(nodes, radius), lanes, radius)
    reached = components(found)
    linked = nodes.join(reached, "node", "left").withColumn("linked", F.col("component").isNotNull())
    to_id = _with_smallest(checkpointed(linked.withColumn("component", F.coalesce("component", "node"))))
    return rows.join(to_id, "node").select(
        "doc_id", *carried, F.lower(F.hex("print")).alias("fingerprint"), "component_id", "component"
    )


def keep_one(
    docs: DataFrame,
    words: int,
    radius: int,
    lanes: int,
    minima: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: tuple[int, int] | None = None,
) -> DataFrame:
    """The rows of ``docs``, one of each group of near-duplicates: that with the smallest id.

    Null ids count as greater than others. Of rows alike in id and text one stays.
    """
    by_text = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), by_text.alias("_text"))
    grouped = group_near_duplicates(slim, words, radius, lanes, minima, carry="_text", similarity=similarity)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("_none"), F.col("doc_id").alias("_id"), F.col("_text"))).alias("first")
    winners = grouped.groupBy("component").agg(first).select("first.*").withColumn("_id", F.coalesce("_id", F.lit(-1)))
    named = docs.withColumns({"_none": F.col(id_col).isNull(), "_id": F.coalesce(F.col(id_col).cast("long"), F.lit(-1)), "_text": by_text})
    one = F.row_number().over(Window.partitionBy("_none", "_id", "_text").orderBy("_id"))
    kept = named.join(winners, ["_none", "_id", "_text"]).withColumn("_place", one).where(F.col("_place") == 1)
    return kept.select(*docs.columns)
