"""Registered queries of the corpus operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.llm import (
    bpe,
    byte_bpe,
    chat,
    collocations,
    decontaminate,
    html,
    quality,
    sharding,
    simhash,
    suffixes,
    token_files,
    warc,
    whitening,
)
from scoreloom.llm.common import stored
from scoreloom.plans.durable import fresh_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


SHARDS = 40
SHARD_SEED = 17


@register("op1_sharding")
def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Law ``rows``: every document by the permutation of its row number; see shard_rows."""
    keys = sharding.document_keys(table(spark, folder, "documents"))
    placed = sharding.shard_rows(keys, ["doc_id", "text_crc32", "size"], SHARDS, SHARD_SEED)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )


# Windows of ten words of both sides, joined on their words.
DECONTAMINATE_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
items AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k,
         array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS phrase
  FROM b, unnest(range(1, greatest(0, len(w) - least(10, len(w)) + 1) + 1)) AS t(i)
  WHERE len(w) > 0),
sizes AS (SELECT DISTINCT k FROM items),
places AS (
  SELECT rid, k, i, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM d, sizes, unnest(range(1, greatest(0, len(w) - k + 1) + 1)) AS t(i)),
hits AS (
  SELECT p.rid, p.i, p.k, x.item_id
  FROM places p JOIN items x ON x.k = p.k AND x.phrase = p.phrase),
hit_words AS (
  SELECT rid, count(DISTINCT i + j) AS n_hit
  FROM (SELECT DISTINCT rid, i, k FROM hits) h, unnest(range(0, k)) AS t(j) GROUP BY rid),
hit_items AS (
  SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)
"""


@register("op2_decontamination", DECONTAMINATE_SQL)
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(documents, table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@register("op3_html_extraction")
def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return html.extract(pages).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )


@register("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    left = suffixes.remove_repeats(documents)
    return left.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


PLANTED = r"\### Assistant: </turn> ok"


@register("op5_chat_format")
def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(
        [(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)], given.schema
    )
    return chat.read_back(chat.format_chat(given.union(planted)))


# Records whose copy in the second replica is damaged: those whose URL's digest starts with 07.
WARC_SQL = r"""
WITH r AS (
  SELECT page_id, coalesce(url, '') AS url,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) ||
         'WARC-Record-ID: <urn:page:' || coalesce(CAST(page_id AS VARCHAR), '') || '>' ||
         chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) ||
         'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' ||
         strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) ||
         coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages),
n AS (
  SELECT page_id, url, CAST(strlen(record) AS BIGINT) AS size, sha256(record) AS record_sha256,
         row_number() OVER (ORDER BY page_id NULLS FIRST, sha256(record)) - 1 AS ordinal
  FROM r)
SELECT page_id, ordinal, ordinal // 1000 AS file,
       CAST(coalesce(sum(size) OVER (PARTITION BY ordinal // 1000 ORDER BY ordinal
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
       size, record_sha256, substr(sha256(url), 1, 2) = '07' AS damaged
FROM n
"""


@register("op6_warc_fixity", WARC_SQL)
def op6_warc_fixity(spark: SparkSession, folder: str) -> DataFrame:
    """Audit of all pages, as an archive, against a replica in which some records have rotted."""
    pages = table(spark, folder, "pages")
    record = warc.record(F.col("page_id"), F.col("url"), F.col("html"))
    rotten = F.sha2(F.coalesce("url", F.lit("")).cast("binary"), 256).startswith("07")
    changed = F.concat(F.lit("WARC/1.1").cast("binary"), F.substring("record", 9, (1 << 31) - 1))
    records = pages.select("page_id", record.alias("record"), rotten.alias("rotten")).select(
        "page_id",
        F.octet_length("record").cast("long").alias("size"),
        warc.digest(F.col("record")).alias("first_copy"),
        warc.digest(F.when(F.col("rotten"), changed).otherwise(F.col("record"))).alias("second"),
    )
    placed = stored(warc.manifest(records, ["page_id", "first_copy"]), "manifest")
    trees = [warc.tree(placed.withColumn("hash", F.col(c))) for c in ("first_copy", "second")]
    damaged = warc.audit(*trees).withColumn("damaged", F.lit(True))
    return placed.join(damaged, F.col("ordinal") == F.col("node"), "left").select(
        "page_id",
        "ordinal",
        "file",
        "offset",
        "size",
        F.col("first_copy").alias("record_sha256"),
        F.coalesce("damaged", F.lit(False)).alias("damaged"),
    )


@register("op7_simhash")
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(documents, shingle=4, max_distance=4)
    return found.select(
        "doc_id", simhash.hexadecimal(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )


@register("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    counted = stored(quality.with_counts(documents).drop("text"), "counts")
    judged = quality.judge(counted, quality.learn_rules(counted))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", "quality")


def tokenizer(name: str) -> str:
    """Where the file of a public tokenizer is on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op9_bpe")
def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    file = tokenizer("word_bpe_49k.json")
    return bpe.encode(documents, file, extra=bpe.digests, fields=bpe.DIGESTS)


END_ID = 2


@register("op10_token_files")
def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    path = fresh_path(spark, "token-files")
    token_files.write_token_files(documents, path, tokenizer("byte_bpe_50k.json"), END_ID)
    return token_files.read_token_files(spark, path).select(
        F.col("key").alias("doc_id"),
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


# Every contiguous run of one to five words within a piece, counted for each language.
COLLOCATIONS_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
  FROM p, unnest(range(1, 6)) AS lengths(k), unnest(range(1, len(w) - k + 2)) AS starts(i)
  GROUP BY ALL HAVING count(*) >= 100),
s AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
inside AS (
  SELECT lang, array_to_string(w[i:i + j - 1], ' ') AS phrase, max(a) AS longer
  FROM s, unnest(range(2, k)) AS lengths(j), unnest(range(1, k - j + 2)) AS starts(i)
  GROUP BY ALL),
kept AS (
  SELECT s.* FROM s LEFT JOIN inside USING (lang, phrase)
  WHERE longer IS NULL OR 100 * longer < 100 * a),
cuts AS (
  SELECT kept.lang, kept.phrase, kept.a, c AS k, x.a AS l, y.a AS r, n,
         CAST((1000::HUGEINT * kept.a * n) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
  FROM kept JOIN totals USING (lang), unnest(range(1, kept.k)) AS places(c)
  JOIN f x ON x.lang = kept.lang AND x.phrase = array_to_string(kept.w[1:c], ' ')
  JOIN f y ON y.lang = kept.lang AND y.phrase = array_to_string(kept.w[c + 1:], ' ')),
best AS (
  SELECT * FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""


@register("op11_collocations", COLLOCATIONS_SQL)
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("lang", "text")
    return collocations.collocations(documents, least=100, most_words=5, covered=100, top=2000)


@register("op12_byte_bpe")
def op12_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    file = tokenizer("byte_bpe_50k.tiktoken")
    documents = table(spark, folder, "documents").select("doc_id", "text")
    encoded = byte_bpe.encode(documents, file, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, file).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register("op13_whitening")
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each usable vector and component, of the eight that explain most."""
    embeddings = table(spark, folder, "embeddings").select("vec_id", "embedding")
    rows = whitening.whiten(embeddings, components=8)
    both = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "of")
    return rows.select("vec_id", "n", "deviation", "identity_error", both).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        "of.whitened",
        "of.explained",
        "identity_error",
    )
