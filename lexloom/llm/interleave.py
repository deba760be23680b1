"""Operator 6 [native]: proportional stratified interleaving into shards.

Law ``rows``: shard sizes are at most one apart.  Every source's rows are put into a seeded hash
order; row r of n has the fractional rank (r - 1/2) / n; all rows sorted by fractional rank (then
source, then hash) are cut into equal runs, so each shard holds each source in the mixture's
proportion, within a row or so.

Ranks without any single sort: the seeded hash (60 bits of an MD5 sum) is uniform, so rows are ranked inside narrow hash
buckets (about ``bucket_rows`` rows each, also within one hot source) and each bucket adds the count
of the buckets before it, from a small table of counts.  The global order is ranked in the same
way over buckets of the fractional rank.  Two shuffles of a few numbers per row; texts stay at
the scan, reduced to their size and checksum.

Defined cases: a null text has size 8 and checksum 0; a null source is the source ''; rows that
tie entirely are interchangeable; repeated rows are placed one by one; other columns are ignored;
an empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ranked(df: DataFrame, keys: list[str], bucket: str, order: list[str], out: str) -> DataFrame:
    """Add the 0-based rank among the rows of the same keys, in order of bucket, then ``order``."""
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(*keys, bucket).agg(F.count("*").alias("_n"))
    starts = counts.select(*keys, bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, bucket).orderBy(*order)
    return df.withColumn("_inside", F.row_number().over(inside) - 1).join(starts, [*keys, bucket]).withColumn(out, F.col("_before") + F.col("_inside")).drop("_before", "_inside")


def interleave(docs: DataFrame, shards: int = 24, seed: int = 7, bucket_rows: int = 2048) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and source of every row."""
    total = docs.count()  # from the files' footers
    buckets = max(1, total // bucket_rows)
    unit: Column = F.shiftright("_hash", 7) / F.lit(float(1 << 53))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce("source", F.lit("")).alias("source"),
    )
    name = F.md5(F.concat_ws("|", F.lit(seed), "doc_id", "text_crc32", "size").cast("binary"))
    rows = rows.withColumn("_hash", F.conv(F.substring(name, 1, 15), 16, 10).cast("long")).withColumn("_bucket", F.floor(unit * buckets))
    ranked = _ranked(rows, ["source"], "_bucket", ["_hash", "doc_id", "text_crc32", "size"], "_rank")
    sizes = rows.groupBy("source").agg(F.count("*").alias("_of"))
    placed = ranked.join(sizes, "source").withColumn("_share", (F.col("_rank") + 0.5) / F.col("_of"))
    placed = placed.withColumn("_all", F.lit(0)).withColumn("_wide", F.floor(F.col("_share") * buckets))
    placed = _ranked(placed, ["_all"], "_wide", ["_share", "source", "_hash", "doc_id", "text_crc32", "size"], "_at")
    exact = F.expr(f"(_at * {shards}L) div {max(1, total)}L")
    first = F.expr(f"(((_at * {shards}L) div {max(1, total)}L) * {total}L + {shards - 1}L) div {shards}L")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), exact.cast("int").alias("shard"), (F.col("_at") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "source")


def _crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes in DuckDB SQL, four bits at a time."""
    table = []
    for c in range(16):
        for _ in range(4):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)

    def step(c: str) -> str:
        return f"xor(({c}) >> 4, {table}[(({c}) & 15) + 1])"

    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, b: {step(step('xor(c, b)'))}), 4294967295::BIGINT)"


#: DuckDB: 24 shards, seed 7; ranks by plain windows instead of buckets.
ORACLE = f"""
WITH sized AS (SELECT doc_id::BIGINT AS doc_id, strlen(coalesce(text, ''))::BIGINT + 8 AS size, {_crc32_sql("coalesce(text, '')")} AS text_crc32, coalesce(source, '') AS source FROM documents),
hashed AS (SELECT *, ('0x' || substr(md5(concat_ws('|', 7, doc_id, text_crc32, size)), 1, 15))::BIGINT AS h FROM sized),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY h, doc_id, text_crc32, size) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY source) AS share FROM hashed),
placed AS (SELECT *, row_number() OVER (ORDER BY share, source, h, doc_id, text_crc32, size) - 1 AS place, count(*) OVER () AS total FROM ranked),
cut AS (SELECT *, (place * 24) // total AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INT AS shard, place - (shard * total + 23) // 24 AS slot, NULL::INT AS grown_shard, source FROM cut
"""
