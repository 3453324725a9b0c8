"""Line dedup, decontamination, near-duplicates, quality, tokens and pages against plain Python."""

import base64
import hashlib
import itertools
import random
import re
import struct
import sys
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from compare import connect, duckdb_rows, spark_rows

import corpus_pipeline
from stationflow.llm import bpe, common, components, decontaminate, html_extract, line_dedup, quality, simhash
from stationflow.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, name):
    assert spark_rows(QUERIES[name](spark, sf_dir)) == duckdb_rows(connect(sf_dir), ORACLE[name])


# --- lines ------------------------------------------------------------------------------

LONG = "A line that is long enough to be a key, é, really"


def cut_lines(rows, min_docs=5, least=40):
    key = lambda line: re.sub("[A-Z]", lambda c: c[0].lower(), line.strip(" \t\n\r\x0b\x0c"))
    docs = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            docs[key(line)].add(i)
    order = lambda i: (i is not None, i or 0)
    gone = {k: max(v, key=order) for k, v in docs.items() if len(k) >= least and len(v) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in gone or gone[key(x)] == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group_bytes", [1 << 26, 1])
def test_line_dedup_equals_brute_force(make_docs, edges, group_bytes):
    rng = random.Random(2)
    lines = [f"{LONG} {i}" for i in range(40)] + ["short", "", f"  {LONG.upper()} 3\t", f"\x1c{LONG} 3"]
    rows = [*edges, *[(i, "\n".join(rng.choices(lines, k=8))) for i in range(20, 50)], (None, f"{LONG} 1\n{LONG} 1\nx"), (30, f"{LONG} 2")]
    got = line_dedup.dedup_lines(make_docs(rows), shard_keys=7, group_bytes=group_bytes)
    assert got.columns == ["doc_id", "text", "shard", "n_lines", "n_dropped"]
    found = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=repr)
    assert found == cut_lines(rows)
    assert any(r[3] for r in found)


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(3)
    first, second = (rng.integers(0, 2**63, 5000).astype(np.uint64) for _ in range(2))
    first[:10] = first[0]
    made = line_dedup.PerfectHash.load(line_dedup.PerfectHash.build(first, second).dump())
    assert sorted(made.find(first, second)) == list(range(5000))


# --- benchmark --------------------------------------------------------------------------


@pytest.mark.parametrize("block_windows", [1_000_000, 1])
def test_decontamination_finds_each_occurrence(spark, make_docs, edges, block_windows):
    item = " ".join(f"w{i}" for i in range(14))
    bench = spark.createDataFrame([("b", item), ("a", "Two Words!"), ("z", None), (None, item), ("e", "...")], "item_id string, text string")
    rows = [*edges, (50, "Intro. " + item.upper().replace(" ", "; ") + " end two words"), (51, " ".join(item.split()[:9]) + " no"), (52, "two words two words")]
    got = {r.doc_id: r for r in decontaminate.mark(make_docs(rows), bench, remove_spans=True, block_windows=block_windows).where("doc_id >= 50").collect()}
    assert (got[50].n_words, got[50].n_hit, got[50].items, got[50].text) == (18, 16, ["a", "b"], "Intro.  end ")
    assert (got[51].n_hit, got[51].items, got[51].contaminated) == (0, [], False)
    assert (got[52].n_hit, got[52].text) == (4, "")
    assert decontaminate.mark(make_docs(rows), bench.limit(0)).where("contaminated").count() == 0


# --- near-duplicates ---------------------------------------------------------------------


def fingerprint(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda c: c[0].lower(), text or "")) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in itertools.combinations(nodes, 2):
        if linked(a, b):
            root[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def test_simhash_equals_brute_force(make_docs, edges):
    rng = random.Random(4)
    base = [" ".join(rng.choices("abcdefgh", k=300)) for _ in range(6)]
    rows = [*edges]
    for i in range(60):
        words = rng.choice(base).split()
        words[rng.randrange(300)] = "Q"
        rows.append((100 + i, " ".join(words)))
    prints = {t: fingerprint(t) for _, t in rows}
    top = smallest_reachable(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i, t in rows:
        if i is not None:
            least[top[prints[t]]] = min(i, least.get(top[prints[t]], i))
    got = simhash.group_near_duplicates(make_docs(rows)).collect()
    want = sorted(((i, f"{prints[t]:016x}", least.get(top[prints[t]])) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=repr) == want


def test_bit_sliced_distances():
    rng = np.random.default_rng(5)
    block = rng.integers(0, 2**63, (150, 2)).astype(np.uint64)
    block[40:80] = block[:40] ^ np.uint64(5)
    for radius in (0, 1, 2, 3, 4, 51):
        rows, columns = simhash.close(block[:30], block, radius)
        near = np.bitwise_count(block[:30, None, :] ^ block[None, :, :]).sum(2) <= radius
        assert set(zip(rows.tolist(), columns.tolist(), strict=True)) == set(zip(*map(np.ndarray.tolist, np.nonzero(near)), strict=True))
    assert (simhash.forest(block, 4) == np.where(np.arange(150) // 40 == 1, np.arange(150) - 40, np.arange(150))).all()


def test_large_keys_meet_in_pairs(make_docs, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rng = random.Random(6)
    base = rng.choices("abcdefghijklmnop", k=400)
    rows = [(i, " ".join([*base[:i], f"n{i}", *base[i + 1 :]])) for i in range(60)]
    kept = simhash.keep_one(make_docs([*rows, (None, "alone")]), 5, 51, 4, 6).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in kept) == [(False, 0), (True, None)]


@pytest.mark.parametrize("few", [0, simhash.FEW])
def test_links_of_a_large_key_equal_brute_force(spark, monkeypatch, few):
    """Keys whose hub is close to all, some and none of their nodes, and one that fits a block."""
    monkeypatch.setattr(simhash, "BLOCK", 8)
    monkeypatch.setattr(simhash, "FEW", few)
    rng = np.random.default_rng(31)
    rows, nodes = [], rng.permutation(10**6)[:243].tolist()
    for key, (count, flips) in enumerate([(90, (0, 10)), (90, (20, 42)), (60, (0, 200)), (3, (0, 10))]):
        base = rng.integers(0, 2, 256)
        for _ in range(count):
            bits = base.copy()
            bits[rng.choice(256, int(rng.integers(*flips)), replace=False)] ^= 1
            rows.append((key, nodes[len(rows)], bytearray(np.packbits(bits).tobytes())))
    prints = {n: (key, int.from_bytes(p)) for key, n, p in rows}
    near = lambda a, b: prints[a][0] == prints[b][0] and (prints[a][1] ^ prints[b][1]).bit_count() <= 50
    edges = {(e.a, e.b) for e in simhash.links(spark.createDataFrame(rows, "key long, node long, print binary"), 4, 50).collect()}
    either = edges | {(b, a) for a, b in edges}
    top = smallest_reachable(sorted(prints), near)
    made = smallest_reachable(sorted(prints), lambda a, b: (a, b) in either)
    assert {frozenset(n for n in top if top[n] == t) for t in top.values()} == {frozenset(n for n in made if made[n] == t) for t in made.values()}
    assert 10 < len(set(top.values())) < 200
    hub = {key: min(n for k, n, _ in rows if k == key) for key in range(4)}
    far = [n for n in prints if (prints[n][1] ^ prints[hub[prints[n][0]]][1]).bit_count() > 50]
    assert any(prints[n][0] == 1 for n in far) and not any(prints[n][0] == 0 for n in far)


def test_edges_of_a_large_key_grow_with_its_size(spark, monkeypatch):
    """Near copies of one text in parts of 8: an edge for each, not one for each part and copy."""
    monkeypatch.setattr(simhash, "BLOCK", 8)
    monkeypatch.setattr(simhash, "FEW", 0)
    rng = np.random.default_rng(32)
    for flips, most in (((5, 20), 1), ((20, 36), 3)):
        for count in (80, 160):
            rows = []
            for node in range(count):
                bits = np.zeros(256, dtype=np.uint8)
                bits[rng.choice(256, int(rng.integers(*flips)), replace=False)] = 1
                rows += [(key, node, bytearray(np.packbits(bits).tobytes())) for key in range(2)]
            edges = simhash.links(spark.createDataFrame(rows, "key long, node long, print binary"), 4, 50)
            assert edges.distinct().count() < most * count
            assert components.components(edges).where("component = 0").count() == count


@pytest.mark.parametrize("dealt", [4, components.DEALT])
def test_components_read_the_edges_once_a_round(spark, monkeypatch, dealt):
    """A hub and a chain: as the sizes of nodes stay, edges meet them before the first round only."""
    monkeypatch.setattr(components, "DEALT", dealt)
    plans = []
    real = components.checkpointed

    def noted(df, *rows):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, *rows)

    monkeypatch.setattr(components, "checkpointed", noted)
    edges = [(0, i) for i in range(1, 40)] + [(i, i + 1) for i in range(40, 60)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(40)}, **{i: 40 for i in range(40, 61)}}
    # What a round needs several times is written: the offers read the edges once, the labels that follow do not.
    reads = [sum("RDD" in line and "other#" in line for line in plan.splitlines()) for plan in plans[-2:]]
    assert len(plans) > 4 and reads == [0, 1]


@pytest.mark.parametrize("dealt", [4, components.DEALT])
def test_components(spark, monkeypatch, dealt):
    monkeypatch.setattr(components, "DEALT", dealt)
    edges = [(i + 1, i) for i in range(30)] + [(50, 40), (50, 50), (60, 50)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 40: 40, 50: 40, 60: 40}


def test_components_write_few_files(spark, monkeypatch):
    """One checkpoint of the edges and one of the labels a round, of few files however many partitions there are."""
    set_ = {"spark.sql.shuffle.partitions": "101", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in set_}
    written = []
    real = components.checkpointed

    def noted(*args):
        written.append(real(*args))
        return written[-1]

    monkeypatch.setattr(components, "checkpointed", noted)
    try:
        for key, value in set_.items():
            spark.conf.set(key, value)
        found = components.components(spark.createDataFrame([(1, 2), (2, 3), (3, 4), (9, 8)], "a long, b long"))
        files = [df.rdd.getNumPartitions() for df in written]
        got = {r.node: r.component for r in found.collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 8: 8, 9: 8}
    assert files[0] == 101 and 1 < len(files) <= 4 and max(files[1:]) <= common.FILES


def test_dealt_join_equals_plain_join(spark, monkeypatch):
    monkeypatch.setattr(components, "DEALT", 3)
    rows = spark.createDataFrame([(i % 20 and 1, i) for i in range(60)] + [(None, 60), (7, 61)], "k long, n long")
    unique = spark.createDataFrame([(0, "zero"), (1, "one"), (9, "nine"), (None, "none")], "k long, v string")
    for some in (rows, rows.limit(0)):
        got = components.join_dealt(some, unique, "k", "n", 62)
        assert got.columns == ["k", "n", "v"]
        assert sorted(got.collect(), key=str) == sorted(some.join(unique, "k", "left").collect(), key=str)


def test_keep_one_keeps_nulls_and_one_of_equal_rows(make_docs, edges):
    kept = simhash.keep_one(make_docs(edges), 5, 51, 4, 6).collect()
    assert sorted((r.doc_id or 0) for r in kept) == sorted([1, 0, 4, 5, 7, -8])
    assert simhash.keep_one(make_docs([]), 5, 51, 4, 6).count() == 0


def shingle_set(text, words=5):
    parts = text.split()
    return {tuple(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))}


def test_keep_one_joins_by_true_similarity(spark, make_docs, monkeypatch):
    rng = random.Random(21)
    texts, want, similarities = [], [], []
    for extra in (25, 43, 57, 100, 120, 171, 200):
        for _ in range(8):
            base = [f"w{rng.randrange(10**9)}" for _ in range(404)]
            pair = " ".join(base), " ".join([*base, *[f"v{rng.randrange(10**9)}" for _ in range(extra)]])
            similar = len(shingle_set(pair[0]) & shingle_set(pair[1])) / len(shingle_set(pair[0]) | shingle_set(pair[1]))
            similarities.append(round(similar, 2))
            want += [len(texts)] if similar >= 0.8 else [len(texts), len(texts) + 1]
            texts += pair
    assert {0.8, 0.77, 0.7} <= set(similarities)
    # One repeated phrase decides every bit, yet the sets share one shingle.
    for _ in range(2):
        want.append(len(texts))
        texts.append(" ".join(["same"] * 2000 + [f"u{rng.randrange(10**9)}" for _ in range(100)]))
    for weight, members in ((simhash.WEIGHT, 256), (500, 256), (1 << 20, 2)):
        monkeypatch.setattr(simhash, "WEIGHT", weight)
        monkeypatch.setattr(simhash, "MEMBERS", members)
        kept = corpus_pipeline.drop_near_duplicates(spark, make_docs(enumerate(texts)), "")
        assert sorted(r.doc_id for r in kept.collect()) == want


@pytest.mark.parametrize("members", [256, 5])
def test_verified_families_equal_all_pairs(spark, monkeypatch, members):
    """Families whose hub is near some members, near none, or has copies; dealt and whole."""
    monkeypatch.setattr(simhash, "MEMBERS", members)
    monkeypatch.setattr(components, "DEALT", 4)
    rng = np.random.default_rng(3)
    rows = []
    for family in range(6):
        base = rng.permutation(5000)[:60]
        for n in range(4 + 6 * family):
            own = base if n % 3 else np.r_[base[:30], rng.permutation(5000)[:30]]
            own = np.unique(np.r_[own[: 60 - n % 9], rng.integers(0, 9000, n % 4)]).astype("<u8")
            rows.append((family, 100 * family + n, len(own), own.tobytes()))
    hubs = {}
    for family, node, _, _ in rows:
        hubs.setdefault(family, node + family % 3)
    frame = spark.createDataFrame([(f, n, hubs[f], w, s) for f, n, w, s in rows], "family long, node long, hub long, weight long, shingles binary")
    sets = {n: set(np.frombuffer(s, "<u8").tolist()) for _, n, _, s in rows}
    family = {n: f for f, n, _, _ in rows}
    near = lambda a, b: family[a] == family[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    edges = simhash.verified(frame, (4, 5)).collect()
    top = smallest_reachable(sorted(sets), near)
    found = {pair for e in edges for pair in ((e.a, e.b), (e.b, e.a))}
    made = smallest_reachable(sorted(sets), lambda a, b: (a, b) in found)
    assert {frozenset(n for n in sets if top[n] == t) for t in top.values()} == {frozenset(n for n in sets if made[n] == t) for t in made.values()}
    assert 6 < len(set(top.values())) < len(sets)


def test_alike_of_asking_sets_only():
    rng = np.random.default_rng(7)
    bases = [rng.permutation(400)[:30] for _ in range(4)]
    sets = [np.unique(np.r_[bases[i % 4][: 30 - i % 6], rng.integers(0, 999, i % 5)]).astype(np.uint64) for i in range(60)] + [np.zeros(0, np.uint64)] * 2
    asking = rng.random(62) < 0.3

    def near(a, b):
        both = len(np.intersect1d(sets[a], sets[b]))
        return (asking[a] or asking[b]) and both and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both)

    root, top = simhash.alike(sets, (4, 5), asking), smallest_reachable(list(range(62)), near)
    assert {frozenset(np.flatnonzero(root == r).tolist()) for r in root} == {frozenset(n for n in top if top[n] == t) for t in top.values()}
    for a, b in itertools.combinations(range(0, 62, 3), 2):
        both = len(np.intersect1d(sets[a], sets[b]))
        whole = len(sets[a]) + len(sets[b]) - both
        assert simhash.similar(sets[a], sets[b], (4, 5)) == (5 * both >= 4 * whole)


def test_alike_equals_brute_force():
    rng = np.random.default_rng(22)
    bases = [rng.permutation(1000)[:40].astype(np.uint64) for _ in range(8)]
    sets = [np.sort(rng.permutation(bases[i % 8])[: rng.integers(20, 41)]) for i in range(120)] + [np.zeros(0, np.uint64)] * 2
    near = lambda a, b: a < 120 and b < 120 and 5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b]))
    root, top = simhash.alike(sets, (4, 5)), smallest_reachable(list(range(122)), near)
    assert all((root[a] == root[b]) == (top[a] == top[b]) for a in range(122) for b in range(122))
    assert 2 < len(set(root.tolist())) < 122


# --- quality -----------------------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    graded = quality.grade_of(labels)
    model = quality.train(docs, graded.where("_id % 5 != 0"))
    assert model.thresholds[0] < model.thresholds[1]
    rows = quality.grade(docs.join(graded, docs.doc_id == graded["_id"]).where("_id % 5 = 0"), model).collect()
    right = {g: [(r.p_good >= 0.5) == (g == 2) for r in rows if r["_grade"] == g] for g in range(3)}
    assert np.mean(right[2]) > 0.97 and np.mean(right[1]) > 0.85 and np.mean(right[0]) > 0.85
    assert all(abs(r.p_poor + r.p_good - 1) < 1e-9 and 0 <= r.expected_grade <= 2 for r in rows)


def test_quality_edges(spark, make_docs, edges):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.train(make_docs(edges), quality.grade_of(labels))
    assert [r.p_good > 0.99 for r in quality.grade(make_docs(edges), model).collect()] == [True] * len(edges)


# --- tokens ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference_encoding():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken(spark, make_docs, edges, reference_encoding):
    rng = random.Random(7)
    texts = ["".join(rng.choices("abcdehilnorst  \n\t'12éßあ漢👍", k=rng.randrange(80))) for _ in range(400)] + ["ab" * 20_000, "<|endoftext|>", "a" * 999]
    vocabulary = bpe.read_vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = [*edges, *enumerate(texts, 100)]
    for r in bpe.decode(bpe.encode(make_docs(rows), vocabulary), vocabulary).collect():
        ids = reference_encoding.encode_ordinary(r.text or "")
        assert (bytes(r.tokens), r.n_tokens) == (struct.pack(f"<{len(ids)}I", *ids), len(ids))
        assert bytes(r.decoded) == (r.text or "").encode()


def test_bpe_replay_takes_few_steps(reference_encoding):
    """Bytecode steps a byte, as seconds differ from run to run; 129 when a pair was looked up under one large number."""
    rng, steps = random.Random(8), 0
    words = ["".join(rng.choices(("th", "re", "on", "an", "er", "ou", "é", "漢"), k=6)) for _ in range(300)] + ["", "a"]
    data = [word.encode() for word in words]
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        vocabulary = bpe.Vocabulary(file.read(), public_tokenizers.PATTERN)
    expected = [struct.pack(f"<{len(ids)}I", *ids) for ids in map(reference_encoding.encode_ordinary, words)]
    assert vocabulary.replay(data) == expected and vocabulary.replay([]) == [] and vocabulary.replay([b""]) == [b""]

    def trace(frame, event, _):
        nonlocal steps
        frame.f_trace_opcodes = True
        steps += event == "opcode"
        return trace

    traced = sys.gettrace()
    sys.settrace(trace)
    try:
        again = vocabulary.replay(data)
    finally:
        sys.settrace(traced)
    assert again == expected
    assert steps < 80 * sum(map(len, data))


def test_bpe_forgets_pairs(reference_encoding, monkeypatch):
    monkeypatch.setattr(bpe, "_PAIRS", 10)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        encoder = bpe.Encoder(bpe.Vocabulary(file.read(), public_tokenizers.PATTERN))
    for text in ("tho thon re\0thon erou", "Größe 漢字 Größen", "thonre erounan"):
        ids = reference_encoding.encode_ordinary(text)
        assert encoder.encode([text, "", text]) == [spelled := struct.pack(f"<{len(ids)}I", *ids), b"", spelled]
        assert encoder.vocabulary.met < 500


def test_bpe_query(spark, sf_dir, reference_encoding):
    got = {r.doc_id: r for r in QUERIES["op9_bpe"](spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = reference_encoding.encode_ordinary(r.text or "")
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()


# --- pages -------------------------------------------------------------------------------


def page(title, paragraphs, extra=""):
    body = "".join(f"<p>{p}" for p in paragraphs)
    return (
        f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style></head><body><script>var t='</p>';</script>"
        f"<nav><ul><li><a href=/>Menu {title}</a></ul></nav><div class='ad top'>Buy {title}</div>"
        f"<div id=main-text><h1>{title}</h1>{body}<p>Subscribe to our letter.</p></div>{extra}<footer>&copy; {title}</footer>"
    )


def test_constant_nodes_are_template(spark):
    rows = [(i, f"http://a.org/{i}", page(f"T{i}", [f"One {i} &amp;\n more", f"<b>Two</b>{i}"], "<div class=comments><p>No</div>")) for i in range(8)]
    rows += [(100, None, None), (101, "x", ""), (102, "http://b.org/", page("Lone", ["A<br>b"]))]
    got = {r.page_id: r for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i].text == f"T{i}\nOne {i} & more\nTwo{i}" for i in range(8))
    assert got[100].text == got[101].text == "" and got[100].n_chars == 0
    assert got[102].text == "Lone\nA b\nSubscribe to our letter."


def test_pages_equal_their_articles(spark, sf_dir):
    import html

    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = {r.page_id: r.text for r in QUERIES["op6_html_extract"](spark, sf_dir).collect()}
    for r in rows:
        article = re.search("(?s)<article>(.*?)</article>", r.html)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]+>", "", b))).strip() for b in re.split("</?(?:p|h1)>", article.replace("<br>", " "))]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


@pytest.mark.parametrize(
    "html",
    [
        "<body class='search-enabled'><div>{}</div></body>",
        "<div class='content no-sidebar'><p>{}</p></div><ul class='menu'><li><a>Home</a></ul>",
        "<article class='post comments-open'><p>{}</p></article><footer>About us</footer>",
        "<body><form id='aspnetForm'><div><p>{}</p></div></form></body>",
        "<div><p>{}</p></div><article class='teaser'><a>Read more</a></article>",
        "<main><p>{}</p></main><div class='comments'><p>" + "I disagree. " * 90 + "</p></div>",
        "<div class='widget'>{}</div><div class='widget'><a>More</a></div>",
    ],
)
def test_names_of_wrappers_do_not_drop_the_page(html):
    said = "The whole text of an article, told at some length. " * 9
    (text,) = html_extract.extract_run([html.format(said)])
    assert said.strip() in text and "Home" not in text and "About us" not in text and "disagree" not in text


def plain_weight(a, b):
    """The textbook recurrence of simple tree matching, over block elements."""
    if a.label != b.label:
        return 0
    x, y = a.blocks(), b.blocks()
    table = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x)):
        for j in range(len(y)):
            table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j], table[i][j] + plain_weight(x[i], y[j]))
    return 1 + table[-1][-1]


def odd_tree(rng, depth=4):
    inner = "".join(odd_tree(rng, depth - 1) for _ in range(rng.randrange(5))) if depth else "t"
    return rng.choice(("<div>{}</div>", "<ul>{}</ul>", "<div class='a'>{}</div>", "<section>{}</section>")).format(inner)


@pytest.mark.parametrize("cells", [1 << 20, 4])
def test_matching_equals_the_plain_recurrence(monkeypatch, cells):
    monkeypatch.setattr(html_extract, "CELLS", cells)
    rng = random.Random(cells)
    for _ in range(120):
        a, b = (html_extract.parse(odd_tree(rng)) for _ in "ab")
        for tree in (a, b):
            html_extract.measure(tree)
        matching = html_extract.Matching()
        assert matching.weight(a, b) == plain_weight(a, b)
        pairs = matching.align(a.blocks(), b.blocks())
        assert 1 + sum(plain_weight(x, y) for x, y in pairs) == plain_weight(a, b)
        firsts, seconds = ([n.first for n in side] for side in (zip(*pairs, strict=True) if pairs else ([], [])))
        assert firsts == sorted(set(firsts)) and seconds == sorted(set(seconds))


def site(rng, n, words=60):
    """A page without ``article``: constant notice, varying menu, content, sidebar and footer."""
    said = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(words)) for _ in range(rng.randrange(1, 6))]
    menu = "".join(f"<li><a href='/{i}'>link{rng.randrange(99)}</a></li>" for i in range(rng.randrange(3, 7)))
    extra = "<div class='box'>A box of its own</div>" if n % 3 == 0 else ""
    page = (
        "<body><div class='top'><p>We use cookies. <a href='/c'>More</a></p></div>"
        f"<ul>{menu}</ul>{'<hr>' * (n % 2)}<div class='text'><h2>Title {n}</h2>{''.join(f'<p>{p}</p>' for p in said)}{extra}</div>"
        f"<div class='recommended'><p>Read too: {rng.randrange(10**9)}</p></div><div><span>Imprint and rights</span></div></body>"
    )
    return page, [f"Title {n}", *said] + (["A box of its own"] if extra else [])


@pytest.mark.parametrize("odd", [[], [""], ["", "<body><table><tr><td>Another layout</table></body>"]])
def test_template_of_pages_without_article(odd):
    rng = random.Random(31)
    made = [site(rng, n) for n in range(9)]
    texts = html_extract.extract_run([*(page for page, _ in made), *odd])
    assert texts[:9] == ["\n".join(want) for _, want in made]
    assert texts[9:] == ["", "Another layout"][: len(odd)]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<p>{}</p><p>Be <math><mi>x</mi></math> a <label>name</label> of <object>it</object></p>", "{}\nBe x a name of it"),
        ("<p>{}</p><div class='related-work'><p>Work before</p></div>", "{}\nWork before"),
        ("<p>{}</p><div class='alert'>Mind the gap</div><section class='social-history'>Of towns</section>", "{}\nMind the gap\nOf towns"),
        ("<p title=it's>{}</p><p>That's all</p>", "{}\nThat's all"),
        ("<p title='a>b'>{}</p><p data-x=\"'>'\">Quoted</p>", "{}\nQuoted"),
        ("<p>{}</p><div class='ad-box'>Buy</div><ul class='comments'><li>Nice</ul><form><label>Name</label></form>", "{}"),
        ("<p>{}</p><p>1 < 2 and a<b</p>", "{}\n1 < 2 and a"),
        ("<h1 class='entry-title'>{}</h1></b></span><p>Stray ends</p></div>", "{}\nStray ends"),
    ],
)
def test_article_text_is_kept(html, want):
    said = "Enough words to be the main part of this page. " * 5
    (text,) = html_extract.extract_run([f"<body><article>{html.format(said)}</article></body>"])
    assert text == want.format(said.strip())


@pytest.mark.parametrize(
    "html",
    [
        '<p title="x> hello ' * 40_000,
        "<div>" * 50_000 + "x" + "</span>" * 50_000,
        "<b>" * 50_000 + "<p>x</p>" * 25_000 + "</i>" * 25_000,
        "<p><div>" + "<b>" * 50_000 + "<hr>" * 50_000,
        "<a " * 150_000 + 'x=">"',
        "<" * 300_000 + "<!" * 100_000,
        "<div class='comments'>" * 20_000 + "text " * 100,
        "<ul><li>" * 20_000 + "text " * 100,
        "<table>" + "<tr><td>1<td>2" * 25_000,
    ],
    ids=lambda html: html[:12],
)
def test_broken_pages_take_linear_time(html):
    import time

    begin = time.perf_counter()
    html_extract.extract_run([html, html])
    assert time.perf_counter() - begin < 15


def test_long_lists_of_blocks_align():
    rng = random.Random(2)
    kinds = ["<p>{}</p>", "<div>{}</div>", "<pre>{}</pre>"]
    pages = []
    for n in range(6):
        body = "".join(rng.choice(kinds).format(f"{n} {i}") for i in range(1500))
        pages.append(f"<body><main>{body}<p>The same on all pages</p></main></body>")
    texts = html_extract.extract_run(pages)
    assert all(len(t.split("\n")) == 1500 and "The same" not in t for t in texts)


def test_extract_keeps_columns_of_any_name(spark):
    names = ["_host", "_bucket", "_mark", "_kept", "_html", "_size", "text", "url", "html"]
    rows = [(*[f"{name}{i}" for name in names[:7]], f"http://h{i % 2}.org/", f"<p>Page {i}</p>") for i in range(4)] + [("x",) * 7 + (None, None)]
    got = html_extract.extract(spark.createDataFrame(rows, names))
    assert got.columns == [*names[:6], "url", "text", "n_chars"]
    assert sorted((r._host, r._kept, r._mark, r.text, r.n_chars) for r in got.collect()) == sorted(
        [(f"_host{i}", f"_kept{i}", f"_mark{i}", f"Page {i}", 6) for i in range(4)] + [("x", "x", "x", "", 0)]
    )
    assert html_extract.extract(spark.createDataFrame(rows, names).where("false")).count() == 0


def test_runs_do_not_depend_on_batches():
    import pyarrow as pa

    keys = ["a"] * 5 + ["b"] * 7 + ["c"]
    whole = pa.RecordBatch.from_pydict({"_host": keys, "_bucket": [0] * 13})
    for size in (1, 2, 5, 13):
        cut = [b.to_pydict()["_host"] for b in html_extract.whole_runs((whole.slice(i, size) for i in range(0, 13, size)), 3)]
        runs = [k for b in cut for k in b]
        assert runs == keys
        at = 0
        for b in cut:
            at += len(b)
            assert at in (3, 5, 8, 11, 12, 13)


# --- pipeline ----------------------------------------------------------------------------


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert rows and all(r.round_trip for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows) <= docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns


def test_stages_read_few_rows_at_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20)
    before = spark.conf.get(common.READ_ROWS_KEY)
    try:
        for name, stage in corpus_pipeline.STAGES:
            spark.conf.set(common.READ_ROWS_KEY, "4096")
            stage(spark, docs, sf_dir)
            assert int(spark.conf.get(common.READ_ROWS_KEY)) == common.READ_ROWS, name
    finally:
        spark.conf.set(common.READ_ROWS_KEY, before)


def test_short_items_do_not_drop_documents(spark, tmp_path):
    long = " ".join(f"w{i}" for i in range(10))
    spark.createDataFrame([(1, "Yes"), (2, "São Paulo"), (3, long), (4, None), (5, "...")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    rows = [(1, "A clean text, yes.", 18), (2, f"yes {long}", 0), (3, "são PAULO", 9), (4, None, None), (5, "no hit", 6), (6, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    got = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).collect()
    want = [(1, "A clean text, .", 15), (4, "", None), (5, "no hit", 6), (6, "", 0)]
    assert sorted((r.doc_id, r.text or "", r.n_chars) for r in got) == want
