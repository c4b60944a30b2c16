"""The pipeline's stages on a test table, each against brute force on its own input."""

import os

import brute
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barspan.llm import mixing, queries

SF_DIR = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents and each stage's rows."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = [(-1, None, "en", "src0", 0), (-2, "", "en", "src0", 0), (-3, "12 !! 34", None, None, 8), (-4, docs.first().text, None, "src1", 5)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumn("language_of", F.lit("clash"))
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], SF_DIR).write.parquet(f"{folder}/{i}")
        out.append(spark.read.parquet(f"{folder}/{i}"))
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_all_but_the_last_stage_keep_the_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert stages[-1].columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_only_documents_without_language_go(stages):
    assert ids(stages[0]) - ids(stages[1]) == {-1, -2, -3}


def test_one_of_near_copies_stays(stages):
    want = brute.near_dedup(pairs(stages[1]), 5, 80)
    assert ids(stages[2]) == {i for i, (_, component) in want.items() if i == component}


def test_benchmark_passages_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    runs = {tuple(w[i : i + 15]) for _, t in items for w in [t.translate(brute.FOLD).split()] for i in range(len(w) - 14)}
    hit = set()
    for doc_id, text in pairs(stages[2]):
        w = text.translate(brute.FOLD).split()
        if any(tuple(w[i : i + 15]) in runs for i in range(len(w) - 14)):
            hit.add(doc_id)
    gone = ids(stages[2]) - ids(stages[3])
    near = brute.contaminated([p for p in pairs(stages[2]) if p[0] in gone - hit], items)
    assert hit and hit <= gone and {d for d, _ in near} == gone - hit


def test_the_mixture(spark, stages):
    levels = queries.mix_levels()
    rows = stages[3].select("doc_id", "text", *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()]).collect()
    docs = [(r.doc_id, r.text, tuple(r[n] for n in levels)) for r in rows]
    weights = {(level, path): w for level, path, w in queries.MIX_WEIGHTS}
    assert ids(stages[4]) == set(brute.mixture(docs, lambda x: x, weights, list(levels), queries.MIX_SHARE, 17, 1))


def test_the_token_files(stages):
    from tokenizers import Tokenizer

    want = brute.token_output(pairs(stages[4]), Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))
    assert sorted(tuple(r) for r in stages[5].collect()) == sorted(want)


def test_run_equals_the_stages(spark):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.count() == got.select("doc_id").distinct().count() > 50


def test_held_out_accuracy(spark):
    found = queries.QUERIES["op10_language_id"](spark, SF_DIR)
    truth = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    share = found.where("held_out").join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert share > 0.97


def test_mix_keeps_to_its_budget(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    taken = mixing.mix(docs, queries.mix_levels(), queries.mix_weights(spark), share=0.5, max_epochs=2)
    used = taken.agg(F.sum(mixing.word_count() * F.col("mix.epochs"))).first()[0]
    assert used <= docs.agg(F.sum(mixing.word_count())).first()[0] * 0.5
