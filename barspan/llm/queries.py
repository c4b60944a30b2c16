"""Registered queries of the operators, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barspan.llm import compression_quality, conversations, fingerprints, importance_sampling, language_id, line_dedup, mixing, near_dedup, repeated_bytes, secrets, spaced_seeds, token_output, warc
from barspan.llm.texts import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

# Target weights of the mixture: domains, then languages within a domain; sources of a language weigh alike.
MIX_SHARE = 0.6
MIX_WEIGHTS = [
    ("domain", "crawl", 0.4), ("domain", "news", 0.25), ("domain", "forum", 0.2), ("domain", "books", 0.15),
    *[("lang", f"{d}/{lang}", w) for d in ("crawl", "news", "forum", "books") for lang, w in (("en", 0.5), ("de", 0.2), ("fr", 0.2), ("es", 0.1))],
]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def mix_levels() -> dict:
    """Domain, language and source; the test tables name no domain, so sources are dealt to domains by their number."""
    number = F.expr("try_cast(regexp_extract(source, '([0-9]+)$', 1) AS int)")
    domain = F.when(number == 0, "crawl").when(number % 3 == 0, "news").when(number % 3 == 1, "forum").otherwise("books")
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def mix_weights(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MIX_WEIGHTS, "level string, path string, weight double")


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


@query
def op2_token_output(spark, sf):
    manifest = token_output.token_files(table(spark, sf, "documents"), TOKENIZER)
    return token_output.read_token_files(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op3_decontaminate(spark, sf):
    return spaced_seeds.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op5_mix(spark, sf):
    docs = table(spark, sf, "documents")
    taken = mixing.mix(docs, mix_levels(), mix_weights(spark), share=MIX_SHARE, max_epochs=2)
    return taken.select("doc_id", "lang", "source", F.col("mix.leaf").alias("leaf"), F.col("mix.epochs").alias("epochs"))


@query
def op8_near_dedup(spark, sf):
    found = near_dedup.near_duplicates(table(spark, sf, "documents"), k=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


@query
def op10_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    model = language_id.fit(docs, train=~held_out())
    found = language_id.classify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


@query
def op4_warc(spark, sf):
    found = warc.read_archives(warc.archives(table(spark, sf, "pages")), payloads=False).where("gap IS NULL")
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op7_line_dedup(spark, sf):
    docs = table(spark, sf, "documents")
    rows = line_dedup.with_bitmaps(docs, line_dedup.keep_bitmaps(docs))

    def digests(batches):
        for batch in batches:
            rows = zip(batch.column("text").to_pylist(), batch.column("keep").to_pylist())
            kept = [line_dedup.kept_lines(text, keep) for text, keep in rows]
            columns = [
                batch.column("doc_id"), pa.array([k[1] for k in kept], pa.int64()), pa.array([k[2] for k in kept], pa.int64()),
                pa.array([hashlib.sha256(k[0].encode()).hexdigest() for k in kept], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    return rows.mapInArrow(digests, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


@query
def op9_secrets(spark, sf):
    found = secrets.find_secrets(table(spark, sf, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


@query
def op6_repeated_bytes(spark, sf):
    docs = table(spark, sf, "documents")
    rows = repeated_bytes.with_starts(docs, repeated_bytes.repeated_starts(docs))

    def digests(batches):
        for batch in batches:
            full = [text.encode() for text in batch.column("text").to_pylist()]
            kept = [repeated_bytes.without_repeats(*x) for x in zip(full, batch.column("starts").to_pylist())]
            columns = [
                batch.column("doc_id"), pa.array([len(d) for d in full], pa.int64()), pa.array([len(d) - len(k[0]) for d, k in zip(full, kept)], pa.int64()),
                pa.array([k[1] for k in kept], pa.int64()), pa.array([hashlib.sha256(k[0]).hexdigest() for k in kept], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.mapInArrow(digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


@query
def op1_fingerprints(spark, sf):
    return fingerprints.compare_with_next(table(spark, sf, "documents"))


@query
def op11_resample(spark, sf):
    found = importance_sampling.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op12_conversations(spark, sf):
    rows = table(spark, sf, "conversations")
    lines = conversations.digests(conversations.repair(conversations.damaged(rows))).withColumnRenamed("conv", "_conv")
    every = rows.select("conv_id").distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    # A conversation that lost all its rows has no line.
    return every.join(lines, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


QUALITY_THRESHOLD = 0.3


@query
def op13_quality(spark, sf):
    docs, held = table(spark, sf, "documents"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = compression_quality.fit(docs, table(spark, sf, "labels"), train=~held)
    score = F.col("quality_score")
    found = compression_quality.classify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held.alias("held_out"), score.alias("score"), (score >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


# The same results in DuckDB's SQL. A-Z are folded and words and lines are cut at \x20 and \x09 to \x0D.
_FOLDED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

SQL["op4_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
h AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS name FROM p),
b AS (SELECT *, CAST(unhex(name) AS BIT)::VARCHAR AS bits, min(page_id) OVER (PARTITION BY name) AS first FROM h)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
    list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST(list_sum(list_transform(range(0, 5), lambda j: CAST(substr(bits, 5 * i + j + 1, 1) AS INTEGER) * (1 << (4 - j)))) AS INTEGER) + 1, 1)),
        'string_agg', '') AS payload_digest,
    CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id > first THEN first END AS refers_to
FROM b"""

SQL["op7_line_dedup"] = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (SELECT *, {_FOLDED.format(f"trim(line, {_SPACES})")} AS key FROM l),
c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, coalesce(doc_id <> keeper, false) AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""

SQL["op8_near_dedup"] = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_FOLDED.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS words FROM documents),
x AS (SELECT doc_id, CASE WHEN len(words) >= 3 THEN list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' '))
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS shingles FROM w),
s AS (SELECT DISTINCT doc_id, unnest(shingles) AS shingle FROM x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * p.n >= 85 * (x.n + y.n - p.n)),
r AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.doc_id),
c AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id)
SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)"""
