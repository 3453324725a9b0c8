"""Empty tables, nulls and repeated rows through every operator and stage; places and fit against plain Python."""

import math
import random
import struct

import numpy as np
import public_tokenizers
import pytest
import xxhash

import corpus_pipeline
from stationflow.llm import bpe, decontaminate, html_extract, line_dedup, periodic, pii, quality, sharding, simhash, topk, whitening

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, extra string"
LABELS = "doc_id long, quality int, toxic int"
ITEMS = "item_id long, text string"


def test_places_equal_a_plain_feistel_network(spark, make_docs):
    def noise(value, turn, seed, below):
        h = 42
        for packed in (struct.pack("<q", value), struct.pack("<i", turn), struct.pack("<i", seed)):
            h = xxhash.xxh64_intdigest(packed, h)
        return (h - (1 << 64) if h >> 63 else h) % below

    def place(row, n, seed=42):
        bits = int(math.log2(math.isqrt(n)))
        b = 1 << bits
        a = -(-n // b)
        while True:
            left, right = row >> bits, row & (b - 1)
            for turn in range(4):
                if turn % 2 == 0:
                    left = (left + noise(right, turn, seed, a)) % a
                else:
                    right = (right + noise(left, turn, seed, b)) % b
            row = left * b + right
            if row < n:
                return row

    rng = random.Random(3)
    rows = [(rng.randrange(10**6), f"t{i}") for i in range(157)] + [(None, "x")]
    got = sharding.assign(make_docs(rows), 7).orderBy("row_number").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [(r.doc_id, r.text) for r in got] == order
    for number, r in enumerate(got):
        to = place(number, len(rows))
        assert (r.row_number, r.shard, r.slot) == (number, to % 7, to // 7)


def test_fit_is_where_the_likelihood_is_flat():
    """The slopes of the penalised likelihood, taken by differences, vanish at the fitted model."""
    rng = np.random.default_rng(4)
    names = np.r_[3, 12, 100 + np.arange(10)].astype(np.int32)
    rows = [np.sort(rng.choice(names, 5, replace=False)) for _ in range(150)]
    grades = np.array([min(2, int(rng.integers(0, 3) + (100 in row) - (101 in row) > 0) + (102 in row)) for row in rows])
    l2 = 0.01
    model = quality.fit(rows, grades, l2=l2, steps=4000)
    value = np.where(names < quality.SHAPES, quality.SHAPE_VALUE, 1.0)
    own = model.weights[names] / value

    def objective(values, thresholds):
        total = 0.0
        for row, grade in zip(rows, grades, strict=True):
            score = sum(values[i] * value[i] for i in np.searchsorted(names, row))
            upto = [0.0, *(1 / (1 + math.exp(score - t)) for t in thresholds), 1.0]
            total += math.log(upto[grade + 1] - upto[grade])
        return total / len(rows) - l2 / 2 * float(values @ values)

    step = 1e-5
    for i in range(len(own)):
        move = np.eye(len(own))[i] * step
        assert abs(objective(own + move, model.thresholds) - objective(own - move, model.thresholds)) / (2 * step) < 1e-3
    for i in range(2):
        move = np.eye(2)[i] * step
        assert abs(objective(own, model.thresholds + move) - objective(own, model.thresholds - move)) / (2 * step) < 1e-3
    assert model.thresholds[0] < model.thresholds[1]


def test_empty_tables(spark, make_docs):
    docs, items = make_docs([]), spark.createDataFrame([], ITEMS)
    model = quality.train(docs, quality.grade_of(spark.createDataFrame([], LABELS)))
    vocabulary = bpe.read_vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    vectors = spark.createDataFrame([], "vec_id long, weights array<long>")
    results = [
        topk.top_k(vectors, vectors),
        line_dedup.dedup_lines(docs), line_dedup.dedup_lines(docs, group_bytes=0),
        decontaminate.mark(docs, items), decontaminate.mark(docs, items, remove_spans=True),
        html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")),
        simhash.group_near_duplicates(docs), quality.grade(docs, model),
        bpe.decode(bpe.encode(docs, vocabulary), vocabulary),
        periodic.find_runs(docs), pii.scan(docs, pii.fit([])),
        whitening.whiten(spark.createDataFrame([], "vec_id long, embedding array<float>")),
    ]
    assert [result.count() for result in results] == [0] * len(results)


@pytest.fixture
def tables(spark, tmp_path):
    def write(documents, labels=(), items=()):
        for name, rows, kind in (("documents", documents, DOCUMENTS), ("labels", labels, LABELS), ("benchmark", items, ITEMS)):
            spark.createDataFrame(list(rows), kind).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


PASSAGE = "one two three four five six seven eight nine ten eleven twelve"
LINE = "A line of more than forty code points that many documents share"
ODD = [
    (None, "text without an id", None, None, None, None), (1, None, "en", "a", 0, "x"), (2, "", "en", None, 0, "x"), (3, "same", "de", "a", 4, "y"),
    (3, "same", "de", "a", 4, "y"), (None, None, None, None, None, None), (4, f"{PASSAGE} and more", "en", "b", 70, None),
    *[(10 + i, f"{LINE}\nown text {i}", "en", "b", 80, "z") for i in range(6)], (20, "word " * 30_000, "fr", "c", 150_000, None),
]


def key(row):
    return repr(row)


def test_stages_take_nulls_and_repeated_rows(spark, tables):
    sf_dir = tables(ODD, [(1, 1, 0), (None, 1, None), (3, None, None)], [(1, PASSAGE), (None, None), (2, "")])
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # Without two grades among the labels nothing is rejected.
    chosen = corpus_pipeline.select_quality(spark, docs, sf_dir)
    assert chosen.columns == docs.columns and sorted(map(tuple, chosen.collect()), key=key) == sorted(ODD, key=key)
    cut = corpus_pipeline.drop_shared_lines(spark, docs, sf_dir)
    got = sorted(((r.doc_id, r.text, r.n_chars) for r in cut.collect()), key=key)
    text = lambda row: f"own text {row[0] - 10}" if row[0] in range(10, 15) else (row[1] or "")
    assert cut.columns == docs.columns and got == sorted(((row[0], text(row), len(text(row))) for row in ODD), key=key)
    unique = corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir)
    ids = sorted((r.doc_id for r in unique.collect()), key=key)
    # Null and empty texts are alike, so are both rows of id 3; texts that share 10 of 12 shingles are near.
    assert unique.columns == docs.columns and ids == sorted([None, 1, 3, 4, 10, 20], key=key)
    clean = corpus_pipeline.drop_contaminated(spark, docs, sf_dir)
    assert clean.columns == docs.columns and clean.count() == len(ODD) - 1 and clean.where("doc_id = 4").count() == 0
    tokens = corpus_pipeline.encode_tokens(spark, docs, sf_dir)
    assert tokens.count() == len(ODD) and tokens.where("not round_trip").count() == 0


def test_pipeline_of_empty_tables(spark, tables):
    assert corpus_pipeline.run(spark, tables([])).count() == 0
