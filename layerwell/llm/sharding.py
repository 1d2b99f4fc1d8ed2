"""Sharding: proportional stratified interleaving, in DataFrame operations only.

Rows of a source are shuffled by a seeded key and ranked. Row number r of n has
the fraction (2r + 1) / 2n. Sorting all rows by fraction interleaves the sources
in proportion, so cutting that order into equal pieces gives shards whose counts
are at most one apart and which all hold the mixture of the whole.

Both rankings are running totals in two levels (see ``running_total``), over
ranges of the shuffle key and ranges of the fraction: neither a hot source nor
the final order is ever sorted by one task. Text is reduced to a length and a
checksum at the scan and takes no part in any exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from layerwell.llm.common import RANGES, columns, running_total

SEED = 20
SHARDS = 24
ROW_OVERHEAD = 8  # bytes a row is counted beside its text


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Every row with its shard and its place there.

    Columns: doc_id, size (UTF-8 bytes of the text plus 8), text_crc32, law
    (``rows``: counts at most one apart), shard, slot (from 0 without gaps),
    grown_shard (null: the law is not ``key``), source.

    A null text counts no bytes and has the checksum of an empty one. Null
    sources form a source of their own. Rows that share a doc_id are ordered by
    checksum and size; rows equal in all of these are interchangeable. An empty
    table gives no rows. Other columns of the input are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    # With the checksum, since many rows may share an id or have none.
    id_or_none = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), id_or_none, F.crc32(text).cast("string")))
    rows = columns(docs, "doc_id", "text", "source").select(
        "doc_id",
        (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        "source",
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("stratum"),
        key.alias("shuffled"),
    )
    bits = RANGES.bit_length() - 1
    first_bits = F.conv(F.substring("shuffled", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("range", F.shiftright(first_bits, 32 - bits))

    one = F.lit(1).cast("long")
    ranked = running_total(
        rows, ["stratum"], "range", ["shuffled", "doc_id", "text_crc32", "size"], one,
        "rank", total="rows_of_source",
    )
    fraction = (2 * F.col("rank") + 1).cast("double") / (2 * F.col("rows_of_source"))
    spread = ranked.withColumn("fraction", fraction)
    spread = spread.withColumn("range", F.floor(F.col("fraction") * RANGES))
    placed = running_total(spread, [], "range", ["fraction", "stratum"], one, "place", total="total")

    shard = F.expr(f"(place * {shards}L) div total")
    # The first place of shard s is ceil(s * total / shards).
    first = F.expr(f"((shard * total) + {shards - 1}L) div {shards}L")
    return (
        placed.withColumn("shard", shard.cast("long"))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("place") - first).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "source",
        )
    )


ORACLE_SQL = f"""
WITH crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(
    list_concat([b], range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step
), docs AS (
  SELECT doc_id, source, coalesce(text, '') AS body, hex(encode(coalesce(text, ''))) AS digits,
         CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS stratum
  FROM documents
), sums AS (
  SELECT docs.*, strlen(body) + {ROW_OVERHEAD} AS size,
         xor(4294967295, list_reduce(
           list_concat([4294967295::BIGINT],
             list_transform(range(strlen(body)),
               lambda i: (instr('123456789ABCDEF', substr(digits, 2 * i + 1, 1)) * 16
                   + instr('123456789ABCDEF', substr(digits, 2 * i + 2, 1)))::BIGINT)),
           lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])))::BIGINT AS text_crc32
  FROM docs, crc
), keyed AS (
  SELECT *, md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || text_crc32) AS shuffled FROM sums
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY stratum
                               ORDER BY shuffled, doc_id NULLS FIRST, text_crc32, size) - 1 AS r,
         count(*) OVER (PARTITION BY stratum) AS n, count(*) OVER () AS total
  FROM keyed
), placed AS (
  SELECT *, row_number() OVER (ORDER BY (2 * r + 1)::DOUBLE / (2 * n), stratum) - 1 AS place
  FROM ranked
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law,
       (place * {SHARDS} // total)::INTEGER AS shard,
       (place - ((place * {SHARDS} // total) * total + {SHARDS - 1}) // {SHARDS})::BIGINT AS slot,
       NULL::INTEGER AS grown_shard, source
FROM placed
"""
