"""The queries op1 to op10 over the whole tables, and the SQL of those that DuckDB can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postalith.llm import embeddings, html, language, lines, media, mixing, ngram_join, packing, quality, warc
from postalith.llm.common import Scratch
from postalith.ship import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a recording: digests of what is read back and of the stored form, and its landmarks' hash."""
    stored = media.encode(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return media.fingerprint(stored).select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32",
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(":", F.size("landmarks").cast("string"), F.lower(F.hex(F.xxhash64("landmarks")))).alias("feature"),
        F.size("landmarks").cast("long").alias("n_landmarks"),
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document, against its source's target."""
    chosen = mixing.decide(table(spark, sf_dir, "documents"), Scratch(spark, "op2"))
    rows = mixing.each(chosen, [F.col(c) for c in ("doc_id", "source", "size", "source_size", "target")])
    return rows.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("taken")).alias("taken"), F.col("taken").alias("copies"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents connected by a Jaccard similarity of 0.8 or more of their five-word shingles."""
    return ngram_join.connect(table(spark, sf_dir, "documents"), Scratch(spark, "op3"))


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.95 or more among all embeddings."""
    return embeddings.links(table(spark, sf_dir, "embeddings"), Scratch(spark, "op4"))


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document after line dedup: how many lines it had and lost, and its text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("n_lines", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long"))
    return lines.dedup(docs, Scratch(spark, "op5")).select("doc_id", "n_lines", "removed_lines", "text")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by a model that saw three of four folds."""
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(remainder("doc_id", 4) != 2).select("doc_id", "lang", "text"))
    found = language.detect(docs, model)
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, written to an archive, put together from it again, parsed and checked."""
    archive = warc.write(table(spark, sf_dir, "pages"), Scratch(spark, "op7"))
    return warc.read(warc.records(archive), archive.kind).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def remainder(key: str, by: int) -> Column:
    """The fold of a row: crc32 of the key as text, modulo by."""
    return F.crc32(F.col(key).cast("string")) % by


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by a model that saw four of five folds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0))
    held = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    return quality.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(table(spark, sf_dir, "pages"), Scratch(spark, "op9"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of 1024 ids."""
    cut = packing.pieces(table(spark, sf_dir, "documents"), tokenizer_path())
    return packing.pack(cut, Scratch(spark, "op10"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_media": op1_media,
    "op2_mixing": op2_mixing,
    "op3_ngram_join": op3_ngram_join,
    "op4_embeddings": op4_embeddings,
    "op5_lines": op5_lines,
    "op6_language": op6_language,
    "op7_warc": op7_warc,
    "op8_quality": op8_quality,
    "op9_html": op9_html,
    "op10_packing": op10_packing,
}

_REACH = """
reach AS (SELECT id AS node, id AS low FROM nodes UNION SELECT links.b, reach.low FROM reach JOIN links ON links.a = reach.node),
lows AS (SELECT node, min(low) AS low FROM reach GROUP BY node)"""

ORACLE: dict[str, str] = {
    "op3_ngram_join": rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(1, len(w) - 4) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS shingle FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * i >= 80 * (p.n + q.n - i)),
nodes AS (SELECT doc_id AS id FROM documents), {_REACH}
SELECT doc_id, coalesce(n, 0) AS n_shingles, low AS component_id FROM documents LEFT JOIN n USING (doc_id) JOIN lows ON node = doc_id""",
    "op4_embeddings": f"""
WITH RECURSIVE e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS norm FROM embeddings),
links AS (SELECT x.id AS a, y.id AS b FROM e x JOIN e y ON x.id <> y.id WHERE x.norm > 0 AND y.norm > 0 AND list_dot_product(x.v, y.v) >= 0.95 * x.norm * y.norm),
nodes AS (SELECT id FROM e), {_REACH},
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT id AS vec_id, coalesce(n, 0) AS n_links, low AS component_id, low = id AS kept FROM e JOIN lows ON node = id LEFT JOIN n ON a = id""",
    "op7_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
t AS (SELECT *, strlen(html) >= 100 AND page_id <> first AS again FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to FROM t""",
}
