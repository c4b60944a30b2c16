"""Language ID against a naive Bayes in plain Python; likeness of fingerprints against the shared pieces."""

import random
import zlib

import brute
import pytest
from pyspark.sql import functions as F

from barspan.llm import queries


def invented(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(n))


def test_language_id(spark, monkeypatch):
    rng = random.Random(11)
    kinds = {"aa": "abcdeimno", "bb": "nopqrstuä", "cc": "aeiouxyzÉß"}
    rows = []
    for i in range(150):
        lang = rng.choice(list(kinds))
        text = invented(rng, kinds[lang] if rng.random() < 0.8 else "".join(kinds.values()), rng.randint(1, 30))
        rows.append((i, text + rng.choice(["", "! 12", "\n\t", " İ"]), None if i % 13 == 0 else lang))
    rows += [(500, None, "aa"), (501, "", "bb"), (502, "12 !?", "cc"), (503, "abc", None), (None, "nop", "bb")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"language": F.lit("x"), "source": F.lit("s")}).repartition(4)
    monkeypatch.setattr(queries, "table", lambda *_: df)
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    model = brute.language_model([(t, lang) for i, t, lang in rows if lang is not None and t is not None and i is not None and not held(i)])
    got = {r.doc_id: r for r in queries.QUERIES["op10_language_id"](spark, "").collect()}
    assert len(got) == len(rows)
    for i, text, _ in rows:
        lang, score = brute.language(model, text)
        assert got[i].lang_pred == lang and got[i].score == pytest.approx(score, abs=2e-3), (i, text)
        assert i is None or got[i].held_out == held(i)


def test_likeness_grows_with_what_texts_share(spark, monkeypatch):
    """Equal texts 1, unrelated ones 0, and in between about the share of the words that both hold."""
    rng = random.Random(2)
    pool = [invented(rng, "abcdefghij", 1) for _ in range(3000)]
    base = [rng.choice(pool) for _ in range(2000)]
    texts = {0: base}
    for i, share in enumerate((1.0, 0.9, 0.7, 0.5, 0.3, 0.0), 1):
        n = int(len(base) * share)
        # Even documents are the base; odd ones keep its first words.
        texts[2 * i - 1] = base[:n] + [rng.choice(pool) + "x" for _ in range(len(base) - n)]
        texts[2 * i] = base
    rows = [(i, " ".join(w)) for i, w in texts.items()]
    monkeypatch.setattr(queries, "table", lambda *_: spark.createDataFrame(rows, "doc_id long, text string"))
    near = {r.doc_id: r.near_next for r in queries.QUERIES["op1_fingerprints"](spark, "").collect()}
    found = [near[2 * i - 2] for i in range(1, 7)]
    assert found[0] == 1.0 and found[-1] < 0.05 and found == sorted(found, reverse=True)
    for share, value in zip((0.9, 0.7, 0.5, 0.3), found[1:-1]):
        # Of two sets of equal size that share this part: intersection over union, or over one of them.
        assert share / (2 - share) - 0.1 <= value <= share + 0.1
