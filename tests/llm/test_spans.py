"""Periodic runs, personal data and whitening against plain Python, on edge cases and in the queries' contracts."""

import hashlib
import itertools
import math
import random
import re
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationflow.llm import periodic, pii, whitening
from stationflow.llm.queries import QUERIES

# --- periodic runs ----------------------------------------------------------------------


def all_runs(words, least=24, periods=3):
    found = {}
    for p in range(1, len(words) // periods + 1):
        i = 0
        while i < len(words) - p:
            start = i
            while i < len(words) - p and words[i] == words[i + p]:
                i += 1
            if i > start and i + p - start >= max(least, periods * p):
                found.setdefault((start, i + p), p)
            i += i == start
    return sorted((s, e - s, p) for (s, e), p in found.items())


def odd_words(rng):
    words = []
    while len(words) < rng.choice([20, 60, 250]):
        kind = rng.randrange(4)
        if kind == 0:
            words += [rng.randrange(rng.choice([2, 50])) for _ in range(rng.randrange(1, 30))]
        elif kind == 1:
            part = [rng.randrange(rng.choice([1, 2, 40])) for _ in range(rng.randrange(1, rng.choice([4, 12, 40])))]
            words += (part * 40)[: rng.randrange(len(part), 6 * len(part) + 30)]
        elif kind == 2 and words:
            at = rng.randrange(len(words))
            words += words[at : at + rng.randrange(1, 60)]
        else:
            words += [0] * rng.randrange(1, 40)
    return words


@pytest.mark.parametrize("step", [1, 13, 1 << 15])
def test_runs_equal_brute_force_in_any_steps(step):
    rng = random.Random(step)
    some = 0
    for _ in range(250):
        words = odd_words(rng)
        want = all_runs(words)
        assert sorted(periodic.runs_of(np.array(words), step=step)) == want
        some += len(want)
    assert some > 100


def test_long_periods_and_regular_words():
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    thue = [bin(i).count("1") % 2 for i in range(2048)]
    for words in (b, thue, [0] * 2000, list(range(700)) * 3, list(range(700)) * 3 + [5]):
        assert sorted(periodic.runs_of(np.array(words))) == all_runs(words)


def runs_row(doc_id, text):
    """The query's contract word by word."""
    words = (text or "").encode().split()
    if doc_id is not None and words:
        h = crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = all_runs(words)
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    gone = {i for s, size, p in runs for i in range(s + p, s + size)}
    said = "".join(f"{s},{size},{p}\n" for s, size, p in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def written_table(df, folder, name):
    df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_periodic_query_equals_brute_force(spark, make_docs, edges, tmp_path):
    rng = random.Random(4)
    spell = lambda words: rng.choice([" ", "\n", "\t \x0b"]).join(f"w{w}" for w in words)
    rows = [*edges, *[(i, spell(odd_words(rng))) for i in range(100, 220)], (17, " ".join(f"u{i}" for i in range(300))), (9, "a\xa0b " * 40)]
    got = QUERIES["op11_periodic"](spark, written_table(make_docs(rows), tmp_path, "documents")).collect()
    # Brute force is too slow for the long edge text, 40,000 times the same word.
    assert sorted((tuple(r) for r in got if r.doc_id != 4), key=repr) == sorted((runs_row(*row) for row in rows if row[0] != 4), key=repr)
    (long,) = [r for r in got if r.doc_id == 4]
    assert (long.n_runs, long.start, long.length, long.period) == (1, 0, 40_000, 1)


def test_periodic_keeps_columns_and_empty_tables(spark, make_docs):
    rows = [(1, "a b " * 20 + "c"), (2, None), (3, "")]
    docs = make_docs(rows).withColumnRenamed("shard", "collapsed")
    got = {r.doc_id: r for r in periodic.find_runs(docs).collect()}
    assert [(r.start, r.length, r.period) for r in got[1].runs] == [(0, 40, 2)]
    assert got[1].collapsed == "a b c" and got[2].runs == [] == got[3].runs and got[2].text is None
    assert periodic.find_runs(docs.where("false")).count() == 0


# --- personal data ----------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for match in re.finditer(pattern, text):
            said, digits = match.group(), re.sub("[^0-9]", "", match.group())
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(part) <= 255 for part in said.split(".")),  # noqa: B023
                "card": lambda: 12 <= len(digits) <= 19 and pii.passes_luhn(digits),  # noqa: B023
                "phone": lambda: 9 <= len(digits) <= 15,  # noqa: B023
            }[kind]()
            if good:
                found.append((kind, *match.span()))
    return pii.in_order(found)


def odd_text(rng):
    parts = ["1", "23", "45678901", "+", ".", "-", " ", "(", ")", "@", "a", "b.c", "é", "_", "%", "\n", "4539578763621486", " at ", "(dot)", "255", "0001"]
    return "".join(rng.choices(parts, k=rng.randrange(1, 40)))


@pytest.fixture(scope="module")
def trained():
    return pii.fit(pii.made_examples())


def test_base_spans_equal_plain_patterns():
    rng = random.Random(8)
    for _ in range(4000):
        text = odd_text(rng)
        assert pii.base_spans(text) == plain_spans(text)


def test_luhn():
    assert pii.passes_luhn("4539578763621486") and not pii.passes_luhn("4539578763621487") and pii.passes_luhn("0" * 12)


def all_segmentations(zone):
    """Every set of segments that do not overlap, as index lists in order."""
    out = [[]]
    for size in range(1, 4):
        for chosen in itertools.combinations(sorted(range(len(zone.segments)), key=lambda i: zone.segments[i][0]), size):
            if all(zone.segments[a][1] <= zone.segments[b][0] for a, b in itertools.pairwise(chosen)):
                out.append(list(chosen))
    return out


def small_zones(want=25):
    rng = random.Random(11)
    seen = 0
    while seen < want:
        text = odd_text(rng)
        for low, high in pii.zones(text, pii.base_spans(text)):
            zone = pii.zone_at(text, low, high)
            every = all_segmentations(zone) if 2 <= len(zone.segments) <= 12 else []
            # At most three spans, so that all segmentations are listed.
            if every and max(map(len, every)) < 3:
                seen += 1
                yield zone, every


def test_dynamic_programming_equals_all_segmentations(trained):
    rng = random.Random(2)
    field = pii.Field(dict(trained.weights), [[rng.uniform(-2, 2) for _ in range(4)] for _ in range(4)] + [[0.0] * 4])
    for zone, every in small_zones():
        scores = [field.score_of(zone, chosen)[0] for chosen in every]
        total, chances, _ = field.expected(zone)
        assert math.isclose(total, math.log(sum(map(math.exp, scores))), rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(field.score_of(zone, field.best(zone))[0], max(scores), rel_tol=1e-9, abs_tol=1e-9)
        for index, chance in enumerate(chances):
            plain = sum(math.exp(s - total) for s, chosen in zip(scores, every, strict=True) if index in chosen)
            assert math.isclose(chance, plain, rel_tol=1e-6, abs_tol=1e-9)


def test_slopes_equal_differences():
    data = [pair for text, gold in pii.made_examples(3) for pair in pii.labelled(text, gold)]
    rng = random.Random(1)
    names = sorted({name for zone, _ in data for segment in zone.segments for name in segment[3]})
    field = pii.Field({name: rng.uniform(-1, 1) for name in names}, [[rng.uniform(-1, 1) for _ in range(4)] for _ in range(4)] + [[0.0] * 4])
    _, slopes, moves = pii.objective(field, data)
    step = 1e-5
    for name in rng.sample(names, 12):
        up, down = (pii.Field({**field.weights, name: field.weights[name] + d}, field.follows) for d in (step, -step))
        assert math.isclose(slopes[name], (pii.objective(up, data)[0] - pii.objective(down, data)[0]) / (2 * step), abs_tol=1e-6)
    for s, k in [(0, 1), (2, 3), (3, 1)]:
        values = []
        for d in (step, -step):
            follows = [list(row) for row in field.follows]
            follows[s][k] += d
            values.append(pii.objective(pii.Field(field.weights, follows), data)[0])
        assert math.isclose(moves[s][k], (values[0] - values[1]) / (2 * step), abs_tol=1e-6)


def test_held_out_spans(trained):
    """Ways of writing the base patterns do not know, from another seed than the field was fitted on."""
    hit = false = missed = 0
    for text, gold in pii.made_examples(40, seed=99):
        spans = pii.spans_of(text, trained)
        base, added = ({s[:3] for s in spans if s[3] is flag} for flag in (True, False))
        assert base == set(plain_spans(text))
        hit += len(added & set(gold))
        false += len(added - set(gold))
        missed += len(set(gold) - base - added)
    assert hit > 150 and false / (hit + false) < 0.02 and missed / (hit + missed) < 0.05


@pytest.mark.parametrize(
    ("text", "added"),
    [
        ("ring +1 (826) 555-4081 190.137.223.204 now", [("phone", "+1 (826) 555-4081")]),
        ("from 4539578763621486 4539578763621486 to", [("card", "4539578763621486")] * 2),
        ("write to jo.doe (at) mail4.example (dot) org today", [("email", "jo.doe (at) mail4.example (dot) org")]),
        ("telephone: 212 555 0187 or so", [("phone", "212 555 0187")]),
        ("we met at example.com in 2024-10-11, order 1234567890", []),
        ("Total 1234567 of 12345678901234567", []),
    ],
)
def test_added_spans(trained, text, added):
    spans = pii.spans_of(text, trained)
    assert [(kind, text[start:end]) for kind, start, end, base in spans if not base] == added


def test_added_spans_overlap_nothing(trained):
    rng = random.Random(12)
    for _ in range(1500):
        spans = pii.spans_of(odd_text(rng), trained)
        for a, b in itertools.combinations(spans, 2):
            assert a[3] and b[3] or a[2] <= b[1] or b[2] <= a[1]


@pytest.mark.parametrize("text", ["1 " * 60_000, "7" * 200_000, "a" * 200_000 + "@", "@" * 100_000, "1." * 60_000, "+1(" * 50_000, "a@b" * 50_000, " at " * 50_000, "a.b at c." * 20_000])
def test_long_texts_take_linear_time(trained, text):
    import time

    begin = time.perf_counter()
    pii.spans_of(text, trained)
    assert time.perf_counter() - begin < 30


def test_pii_query_keeps_base_spans(spark, make_docs, edges, tmp_path):
    rng = random.Random(6)
    rows = [*edges, *[(i, f"say {odd_text(rng)} now") for i in range(100, 400)], (500, "x +1 (826) 555-4081 190.137.223.204")]
    got = QUERIES["op12_pii"](spark, written_table(make_docs(rows), tmp_path, "documents")).collect()

    def digest(row):
        spans = plain_spans(row[1] or "")
        said = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        return (row[0], *[sum(k == kind for k, _, _ in spans) for kind in PATTERNS], hashlib.sha256(said.encode()).hexdigest())

    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted(map(digest, rows), key=repr)
    for row in got:
        if row.doc_id == 500:
            assert row.spans == "phone:2:19,ip:20:35"
    assert pii.scan(make_docs([]), pii.fit([])).count() == 0


# --- whitening --------------------------------------------------------------------------


def with_values(values, seed=0):
    rng = np.random.default_rng(seed)
    turn = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0]
    matrix = (turn * values) @ turn.T
    return (matrix + matrix.T) / 2


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 2, 40),
        np.r_[np.ones(8), np.linspace(0, 0.5, 24)],
        np.r_[1 + np.arange(8) * 1e-9, np.full(12, 0.5), np.zeros(12)],
        1 + np.arange(20) * 1e-7,
        np.ones(16),
        np.geomspace(1, 1e-12, 30),
        np.zeros(5),
        np.array([3.0]),
        np.array([1e30, 1e29, 1e-5]),
    ],
    ids=str,
)
def test_eigenvectors_to_double_precision(values):
    matrix = with_values(values)
    found, vectors = whitening.eigenvectors(matrix)
    wide, x = matrix.astype(np.longdouble), vectors.astype(np.longdouble)
    size = max(float(np.abs(matrix).max()), 1e-300)
    assert np.abs(x.T @ x - np.eye(len(x))).max() < 4e-16
    assert np.abs(wide @ x - x * found).max() < 1e-15 * size * len(x)
    assert (np.diff(found) <= 1e-15 * size).all()
    assert np.allclose(found, np.linalg.eigvalsh(matrix)[::-1], rtol=0, atol=1e-13 * size)


def test_correction_starts_from_single_precision_and_squares_the_error():
    matrix = with_values(np.linspace(1, 3, 24)).astype(np.longdouble)
    x = np.linalg.eigh(matrix.astype(np.float32))[1].astype(np.longdouble)
    errors = []
    for _ in range(3):
        errors.append(float(np.abs(x.T @ x - np.eye(24)).max()))
        x = whitening._corrected(matrix, x)[0]
    assert errors[0] > 1e-8 and errors[1] < 1e-10 and errors[2] < 1e-16


def plain_whitening(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(axis=0)
    centred = x - total / n
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1][:k], turn[:, ::-1][:, :k]
    return x, n, total, values, centred @ turn / np.sqrt(values), np.trace(centred.T @ centred / n)


def test_whitening_query(spark, tmp_path):
    rng = np.random.default_rng(5)
    good = (rng.normal(size=(120, 12)) * np.linspace(0.1, 3, 12)).astype(np.float32).astype(float)
    good[7] = good[8]
    rows = [(i, v) for i, v in enumerate(good.tolist())]
    bad = [(500, None), (501, [float("nan")] * 12), (502, [0.0] * 11 + [float("inf")]), (503, [None] * 12), (504, []), (505, [1.0, 2.0])]
    rows[3] = (None, rows[3][1])
    rows[4] = (9, rows[4][1])
    frame = spark.createDataFrame([*rows, *bad], "vec_id long, embedding array<float>")
    got = QUERIES["op13_whitening"](spark, written_table(frame, tmp_path, "embeddings")).toPandas()
    x, n, total, values, want, trace = plain_whitening([v for _, v in rows])
    assert len(got) == 120 * 8 and set(got["n"]) == {120}
    by_row = [got[got["component"] == k + 1] for k in range(8)]
    for k, part in enumerate(by_row):
        order = lambda names, column: sorted(zip(names, np.abs(column).round(9), strict=True), key=repr)
        ids = [None if np.isnan(i) else int(i) for i in part["vec_id"]]
        assert order(ids, part["whitened"].to_numpy()) == order([i for i, _ in rows], want[:, k])
        assert np.allclose(part["explained"], values[k] / trace, rtol=1e-12)
    assert sorted(by_row[0]["deviation"]) == sorted(((n * x - total) ** 2).sum(axis=1).tolist())
    assert set(got["identity_error"]) == {got["identity_error"][0]} and got["identity_error"][0] < 1e-12


def test_whitening_edges(spark):
    kind = "vec_id long, component string, _row string, embedding array<double>"
    empty = spark.createDataFrame([], kind)
    assert whitening.whiten(empty).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, "a", "b", None)], kind)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, "a", "b", [0.5, 2.0])] * 2, kind)).collect()
    assert len(one) == 4 and {(r.vec_id, r._row, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in one} == {
        (1, "b", 2, 0, None, None, None)
    }
    line = [(i, "a", "b", [float(i), 0.25]) for i in range(5)]
    flat = whitening.whiten(spark.createDataFrame(line, kind)).orderBy("vec_id", "component").collect()
    assert [abs(round(r.whitened, 9)) for r in flat if r.component == 1] == [1.414213562, 0.707106781, 0, 0.707106781, 1.414213562]
    assert all(r.whitened is None and r.explained == 0 for r in flat if r.component == 2) and flat[0].identity_error < 1e-12


def test_large_entries_stay_exact(spark):
    rng = random.Random(3)
    rows = [(i, [float(rng.randrange(-(2**41), 2**41)) for _ in range(3)]) for i in range(50)]
    got = whitening.whiten(spark.createDataFrame([*rows, (99, [2.0**43, 0.0, 0.0])], "vec_id long, embedding array<double>"))
    x = [[int(c) * 1024 + 100_000 for c in v] for _, v in rows]
    total = [sum(column) for column in zip(*x, strict=True)]
    want = {i: sum((50 * c - s) ** 2 for c, s in zip(v, total, strict=True)) for (i, _), v in zip(rows, x, strict=True)}
    found = {r.vec_id: int(r.deviation) for r in got.where(F.col("component") == 1).collect()}
    assert found == want
    assert got.first().identity_error < 1e-9


def test_products_are_exact():
    rng = random.Random(1)
    rows = [[rng.randrange(-(2**51), 2**51) for _ in range(4)] for _ in range(30)]
    want = [[sum(r[i] * r[j] for r in rows) for j in range(4)] for i in range(4)]
    assert whitening._products(np.array(rows)).tolist() == want
