"""Importance resampling against brute force; the compression classifier by its accuracy on rows it did not learn from."""

import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barspan.llm import compression_quality as cq
from barspan.llm import importance_sampling as sampling
from barspan.llm import queries


def frame(spark, rows, kind="doc_id long, text string"):
    clashes = ["word", "n", "buckets", "weight", "score", "rank", "_at", "_n", "good", "hash", "quality_score"]
    df = spark.createDataFrame(rows, kind)
    return df.withColumns({c: F.lit("clash") for c in clashes if c not in df.columns}).repartition(5)


def tables(monkeypatch, **known):
    monkeypatch.setattr(queries, "table", lambda _spark, _dir, name: known[name])


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    pool = ["".join(rng.choice("abcdefghijäéñ0189") for _ in range(rng.randint(1, 24))) for _ in range(300)]
    pick = lambda: pool[min(int(rng.expovariate(0.03)), len(pool) - 1)]
    join = lambda n: "".join(pick() + rng.choice([" ", ", ", "\n", "!!", "\x00", "_"]) for _ in range(n))
    docs = [(i, join(rng.randint(0, 120))) for i in range(150)]
    docs += [(200 + i, docs[7][1]) for i in range(20)]
    docs += [(300, None), (301, ""), (302, "?!"), (303, "x" * 5000), (304, "A" * 47 + " b " + "c" * 49), (305, join(30_000)), (None, join(40)), (7, docs[7][1]), (7, join(60))]
    return docs, [(i, join(50)) for i in range(10)] + [(10, None), (11, "")]


def test_features_of_any_head(corpus):
    texts = [t for _, t in corpus[0]]
    words = sampling.Words(pa.array(texts, pa.string()))
    vocabulary = sorted({w for t in texts for w in brute.feature_list(t)[0] if len(w.encode()) <= sampling.HEAD_BYTES})
    for size in (0, 5, len(vocabulary)):
        head_words = vocabulary[:size]
        pairs = [(a, b) for a in range(min(size, 40)) for b in range(min(size, 40)) if (a + b) % 3]
        buckets, counts = sampling.feature_buckets(words, sampling.make_head(head_words, pairs))
        ends = np.cumsum(counts)
        for text, n, end in zip(texts, counts, ends):
            want = [zlib.crc32(f.encode()) % sampling.BUCKETS for f in brute.feature_list(text)[1]]
            assert buckets[end - n : end].tolist() == want


def test_words_with_one_hash(monkeypatch):
    """A word that only shares the hash of a frequent one is no frequent word."""
    monkeypatch.setattr(sampling, "_key_hash", lambda keys: np.zeros(len(keys), np.uint64))
    head = sampling.make_head(["alpha"], [])
    buckets, _ = sampling.feature_buckets(sampling.Words(pa.array(["alpha beta"])), head)
    assert buckets.tolist() == [zlib.crc32(f) % sampling.BUCKETS for f in (b"alpha", b"alpha beta", b"beta")]


def test_resample(spark, corpus, monkeypatch):
    docs, bench = corpus
    tables(monkeypatch, documents=frame(spark, docs), benchmark=frame(spark, bench, "item_id long, text string"))
    found = queries.QUERIES["op11_resample"](spark, "")
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint"] * 5
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(brute.resample(docs, [t for _, t in bench]), key=repr)


def test_resample_of_much(spark, corpus):
    docs, bench = corpus
    found = sampling.resample(frame(spark, docs), frame(spark, bench), percent=60, least_words=1, seed=5).drop("n_words")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(brute.resample(docs, [t for _, t in bench], 60, 1, 5), key=repr)


def test_resample_of_nothing(spark, corpus):
    none = frame(spark, [])
    assert sampling.resample(none, frame(spark, corpus[1])).collect() == []
    only_empty = sampling.resample(frame(spark, [(1, None), (2, "")]), none).collect()
    assert {(r.doc_id, r.n_features, r.weight, r["rank"]) for r in only_empty} == {(1, 0, 0, None), (2, 0, 0, None)}


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(4)
    stems = ["wind", "stone", "river", "light", "house", "garden", "winter", "paper"]
    good = lambda: " ".join(rng.choice(stems) + rng.choice(["", "s", "ed", "ing"]) for _ in range(rng.randint(30, 300)))
    bad = lambda: " ".join(rng.choice(stems).upper() + rng.choice(["!!", "$$$", "###"]) for _ in range(rng.randint(30, 300)))
    docs, labels = [], []
    for i in range(400):
        is_good = rng.random() < 0.7
        docs.append((i, good() if is_good else bad()))
        labels.append((i, int(is_good)))
    docs += [(900, None), (901, ""), (902, bad() * 200), (None, good())]
    # Both labels, a null one, another one, no id, an id without a document, and an empty text.
    labels += [(1, 0), (1, 1), (2, None), (3, 7), (None, 1), (5000, 1), (901, 1), (900, 0)]
    return docs, labels


def test_quality(spark, labelled, monkeypatch):
    docs, labels = labelled
    tables(monkeypatch, documents=frame(spark, docs), labels=spark.createDataFrame(labels, "doc_id long, quality int"))
    found = {r.doc_id: r for r in queries.QUERIES["op13_quality"](spark, "").collect()}
    assert set(found) == {d for d, _ in docs}
    truth = dict(labels)
    held = [r for i, r in found.items() if r.held_out and i is not None and 3 < i < 400]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found.values() if r.doc_id is not None)
    assert len(held) > 50 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found.values())
    assert found[902].predicted == 0 and found[900].score == found[901].score


def test_scores_take_the_text_alone(spark, labelled):
    docs, labels = labelled
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    model = cq.fit(frame(spark, docs), known, F.col("doc_id") % 2 == 0)
    again = cq.fit(frame(spark, docs).repartition(2), known, F.col("doc_id") % 2 == 0)
    assert (model.good, model.bad) == (again.good, again.bad) and model.values.tolist() == again.values.tolist()
    moved = [(i or 0) * 7 + 1 for i, _ in docs]
    one = [r.quality_score for r in cq.classify(frame(spark, docs), model).orderBy(F.col("doc_id").asc_nulls_first()).collect()]
    texts = [t for _, t in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))]
    plain = model.scores(cq.evidence(texts, model.compressors()))
    assert one == plain.tolist() and len(moved) == len(one)


def test_quality_without_labels(spark, labelled):
    docs, labels = labelled
    none = spark.createDataFrame([], "doc_id long, quality int")
    for known, share in ((none, 0.5), (spark.createDataFrame([(1, 1), (4, 1), (6, 1)], none.schema), 4 / 5)):
        model = cq.fit(frame(spark, docs), known, F.lit(True))
        assert {round(r.quality_score, 9) for r in cq.classify(frame(spark, docs), model).collect()} == {round(share, 9)}
    assert cq.classify(frame(spark, []), cq.fit(frame(spark, []), none, F.lit(True))).collect() == []


def test_curve_never_falls():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, 900), np.zeros(100)])
    good = rng.random(1000) < 1 / (1 + np.exp(-3 * x))
    places, values = cq.fit_curve(x, good)
    assert (np.diff(places) > 0).all() and (np.diff(values) >= 0).all()
    for low, high in ((-3, -1), (-1, 0), (0, 1), (1, 3)):
        inside = (x >= low) & (x < high)
        assert abs(np.interp(x[inside], places, values).mean() - good[inside].mean()) < 0.06
    assert (cq.fit_curve(np.zeros(0), np.zeros(0, bool))[1] == 0.5).all()
