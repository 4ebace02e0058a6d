"""Registered queries of the numbered operators and the pipeline, and their SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from skyledger.llm import decontaminate, langid, lm, mixing, neardup, pieces, pseudonyms, resample, resharding, runs, secret_scan, substrings, vectors
from skyledger.llm.shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.held_out("doc_id", 3, 1)
    model = langid.train(docs.where(~out))
    return langid.identify(docs.select("doc_id", "text", out.alias("held_out")), model).drop("text")


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "doc_id")
    listed = F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), listed, "contaminated")


# Words that DuckDB cuts; the window length of an item is 13, or all its words.
ORACLES["op2_decontaminate"] = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(13, len(words)) AS n, words[pos:pos + least(13, len(words)) - 1] AS win
    FROM (SELECT item_id, words, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS pos FROM b WHERE len(words) > 0)),
lens AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, pos, words[pos:pos + n - 1] AS win
    FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS pos FROM w, lens WHERE len(words) >= n)),
hit AS (SELECT doc_id, pos, dw.n, item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.win = iw.win),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT w.doc_id, coalesce(len(words), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(words), 0) AS contaminated
FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    taken = (F.col("mix.size") * F.col("mix.times")).alias("taken")
    return mixing.mix(docs).select("doc_id", "mix.size", "mix.source_size", "mix.target", taken)


@query
def op6_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = resharding.reshard(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return resharding.slotted(placed).select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.col("old").alias("old_shard"),
    )


@query
def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.components_of(table(spark, sf_dir, "documents"), k=3, share=85)
    return found.select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept")
    )


ORACLES["op3_minhash_dedup"] = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words FROM documents),
sh AS (SELECT DISTINCT doc_id, hash(words[pos:pos + 2]) AS s
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS pos FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
reach AS (SELECT doc_id, doc_id AS r FROM w UNION SELECT reach.doc_id, b FROM reach JOIN link ON a = r),
c AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removed(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("kept", "kept_sha256")


ORACLES["op8_substring_dedup"] = r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
win AS (SELECT doc_id, pos, words[pos:pos + 19] AS win FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS pos FROM w)),
later AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS rn FROM win) WHERE rn > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(pos, pos + 20)) AS p FROM later) GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept
    FROM (SELECT w.doc_id, p, words[p] AS word, gone FROM (SELECT *, unnest(range(1, len(words) + 1)) AS p FROM w) w LEFT JOIN gone g ON g.doc_id = w.doc_id)
    WHERE gone IS NULL OR NOT list_contains(gone, p) GROUP BY doc_id)
SELECT w.doc_id, len(words) AS n_words, coalesce(len(gone), 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query
def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vectors.near_vectors(table(spark, sf_dir, "embeddings"))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept")
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", kept)


ORACLES["op7_embedding_dedup"] = """
WITH RECURSIVE sound AS (SELECT vec_id FROM (SELECT vec_id, unnest(embedding) AS x FROM embeddings WHERE label IS NOT NULL)
    GROUP BY vec_id HAVING bool_and(x IS NOT NULL AND isfinite(x)) AND bool_or(x <> 0)),
v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IN (SELECT vec_id FROM sound)),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a),
reach AS (SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT reach.vec_id, b FROM reach JOIN link ON a = r),
c AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e LEFT JOIN n USING (vec_id) JOIN c USING (vec_id)
"""


@query
def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = langid.held_out("doc_id", 7, 2)
    return lm.scored(docs, docs.where(~out)).withColumn("held_out", out)


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumnRenamed("id", "doc_id")


@query
def op10_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is spark.skyledger.pseudonymKey; the query's own is for tests and checks."""
    key = spark.conf.get("spark.skyledger.pseudonymKey", "not a secret")
    out = pseudonyms.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), key)
    return out.select("doc_id", "text", *[F.col(f"found.{k}").alias(f"n_{k}") for k in pseudonyms.KINDS])


@query
def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pieces.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"), decoded="decoded")
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def _with_planted_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents, chosen by crc32 of the id, the words from some place on repeat a stretch."""

    def plant(rows: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, seeds in rows:
            out = texts.to_pylist()
            for k, (text, h) in enumerate(zip(out, seeds.to_pylist())):
                words = text.split() if text and h is not None and h % 10 == 0 else []
                if words:
                    g, n = h // 10, len(words)
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    out[k] = b" ".join(words[:a] + [words[a + (i - a) % p] for i in range(a, n)])
            yield pa.array(out, pa.binary())

    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return docs.select("doc_id", F.arrow_udf(plant, "binary")(F.col("text").cast("binary"), h).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = runs.periodic_runs(_with_planted_tails(table(spark, sf_dir, "documents")))
    found = F.col("periodic.runs")
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    # Runs come by start and period, so of equal exponents the first one stays.
    best = F.reduce(found, none, lambda top, x: F.when(top.isNull() | (x.length * top.period > top.length * x.period), x).otherwise(top))
    lines = F.array_join(F.transform(found, lambda x: F.concat(F.concat_ws(",", x.start, x.length, x.period), F.lit("\n"))), "")
    return out.withColumn("best", best).select(
        "doc_id",
        F.size(found).cast("long").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2("periodic.collapsed", 256).alias("collapsed_sha256"),
    )


# crc32 as a table and a fold over bytes, which are read from hexadecimal digits.
_CRC = """
steps(i, c, k) AS (SELECT i, i, 0 FROM range(256) r(i) UNION ALL
    SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
bytes AS (SELECT s, list_transform(range(1, strlen(s) + 1),
        lambda i: (instr('0123456789ABCDEF', hex(encode(s))[2 * i - 1]) - 1) * 16 + instr('0123456789ABCDEF', hex(encode(s))[2 * i]) - 1) AS b FROM strings),
crc AS (SELECT s, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[xor(c, x) % 256 + 1])), 4294967295) AS h FROM bytes, tab)
"""

# Places of a grid whose words agree three times over name the periods to look at; stretches of agreeing places make the runs.
ORACLES["op12_periodic_runs"] = rf"""
WITH RECURSIVE strings AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS s FROM documents), {_CRC},
cut AS (SELECT doc_id, coalesce(h, 1) AS h, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w
    FROM documents LEFT JOIN crc ON s = CAST(doc_id AS VARCHAR)),
tail AS (SELECT *, len(w) AS n, (h // 10) % len(w) AS a, 1 + (len(w) - (h // 10) % len(w)) // (3 + (h // 10) % 8) AS p FROM cut),
word AS MATERIALIZED (SELECT doc_id, n, i, CASE WHEN h % 10 = 0 AND i >= a THEN w[1 + a + (i - a) % p] ELSE w[1 + i] END AS x FROM (SELECT *, unnest(range(n)) AS i FROM tail)),
grid AS (SELECT doc_id, q, unnest(range(0, n - 3 * q, q)) AS i FROM (SELECT doc_id, n, unnest(range(1, n // 4 + 1)) AS q FROM tail)),
one AS MATERIALIZED (SELECT g.*, x, g.i + q AS j FROM grid g JOIN word o USING (doc_id, i)),
two AS MATERIALIZED (SELECT g.doc_id, q, g.x, j + q AS j FROM one g JOIN word o ON o.doc_id = g.doc_id AND o.i = j WHERE o.x = g.x),
three AS MATERIALIZED (SELECT g.doc_id, q, g.x, j + q AS j FROM two g JOIN word o ON o.doc_id = g.doc_id AND o.i = j WHERE o.x = g.x),
per AS MATERIALIZED (SELECT DISTINCT g.doc_id, q FROM three g JOIN word o ON o.doc_id = g.doc_id AND o.i = j WHERE o.x = g.x),
pair AS MATERIALIZED (SELECT per.doc_id, q, i, x, i + q AS j FROM per JOIN word USING (doc_id)),
same AS (SELECT g.doc_id, q, g.i, g.i - row_number() OVER (PARTITION BY g.doc_id, q ORDER BY g.i) AS island
    FROM pair g JOIN word o ON o.doc_id = g.doc_id AND o.i = j WHERE o.x = g.x),
run AS MATERIALIZED (SELECT doc_id, start, length, min(q) AS period FROM (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM same GROUP BY doc_id, q, island)
    WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines FROM run GROUP BY doc_id),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) AS nth FROM run),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS text FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
    sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM documents LEFT JOIN listed USING (doc_id) LEFT JOIN (SELECT * FROM best WHERE nth = 1) USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query
def op13_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = resample.resampled(docs, table(spark, sf_dir, "benchmark"), key="doc_id", keep=["doc_id"])
    return out.select("doc_id", "drawn.n_features", "drawn.weight", "drawn.score", "drawn.rank")


ORACLES["op13_importance_resample"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS s FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS s FROM benchmark),
strings AS (SELECT s FROM d UNION SELECT s FROM b), {_CRC},
spot AS (SELECT s, h % 10000 AS k FROM crc),
n_s AS (SELECT k, count(*) AS n FROM d JOIN spot USING (s) GROUP BY k),
n_t AS (SELECT k, count(*) AS n FROM b JOIN spot USING (s) GROUP BY k),
gain AS (SELECT k, CAST(floor(1000 * ln((coalesce(n_t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM d) + 10000)
        / ((coalesce(n_s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM b) + 10000)))) AS BIGINT) AS g FROM n_s FULL JOIN n_t USING (k)),
w AS (SELECT doc_id, count(*) AS n, CAST(floor(sum(g)::DOUBLE / count(*)) AS BIGINT) AS weight FROM d JOIN spot USING (s) JOIN gain USING (k) GROUP BY doc_id),
noise AS (SELECT doc_id, hex(encode(sha256(concat('2024:', doc_id))[1:8])) AS x FROM documents),
h AS (SELECT doc_id, list_sum(list_transform(range(8), lambda i: (instr('0123456789abcdef', chr(('0x' || x[2 * i + 1:2 * i + 2])::INT)) - 1) * (1::BIGINT << (28 - 4 * i)))) AS h FROM noise),
scored AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM documents LEFT JOIN w USING (doc_id) JOIN h USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, rank FROM scored LEFT JOIN (SELECT doc_id, rank FROM ranked WHERE rank <= 10 * n // 100) USING (doc_id)
"""


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
