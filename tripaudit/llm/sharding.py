"""Sharding by jump consistent hashing (operator 3).

A row's shard follows from its key and the number of shards alone; with one
shard more, a row either stays or goes to the new shard. No ring table exists.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import running_total, staged

#: Key of rows without one; fixed, so that they all land in one defined shard.
NULL_KEY = -1


def jump_shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key, as in Lamping and Veach (2014), for all keys at once."""
    key = keys.astype(np.int64).view(np.uint64).copy()
    shard, jump = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    while len(live):
        shard[live] = jump[live]
        key[live] = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        step = float(1 << 31) / ((key[live] >> np.uint64(33)).astype(np.float64) + 1.0)
        jump[live] = ((shard[live] + 1).astype(np.float64) * step).astype(np.int64)
        live = live[jump[live] < shards]
    return shard


def shard_rows(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, size, text_crc32, law, shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus 8; a null text has none and the
    checksum 0. Slots number a shard's rows from 0 in key order; rows with
    equal keys share a shard and take adjacent slots. A null key is hashed as
    one fixed key. Empty input gives no rows; other columns are ignored.
    """

    @F.pandas_udf("shard int, grown_shard int")
    def deal(k: pd.Series) -> pd.DataFrame:
        k = k.to_numpy(np.int64)
        return pd.DataFrame({"shard": jump_shard(k, shards).astype(np.int32), "grown_shard": jump_shard(k, shards + 1).astype(np.int32)})

    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(key).alias("doc_id"), (F.length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), deal(F.coalesce(F.col(key).cast("long"), F.lit(NULL_KEY).cast("long"))).alias("_to"))
    rows = staged(rows.select("doc_id", "size", "text_crc32", "_to.*", F.lit(1).alias("_one")), "shards")
    out = running_total(rows, "shard", ["doc_id", "text_crc32", "size"], "_one", "slots")
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("before").alias("slot"), "grown_shard")


#: DuckDB: the same for 24 and 25 shards; the checksum's table is built by its rule.
SQL = r"""
WITH RECURSIVE tbl AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM (SELECT unnest(range(256)) AS i))
), src AS (
  SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), jumps(rid, n, b, j, k) AS (
  SELECT rid, n, CAST(-1 AS HUGEINT), CAST(0 AS HUGEINT), CAST(coalesce(doc_id, -1) AS HUGEINT) + CASE WHEN coalesce(doc_id, -1) < 0 THEN CAST(18446744073709551616 AS HUGEINT) ELSE 0 END
  FROM src, (SELECT unnest([24, 25]) AS n)
  UNION ALL
  SELECT rid, n, j, CAST(floor(CAST(j + 1 AS DOUBLE) * (2147483648.0::DOUBLE / (CAST(nk >> 33 AS DOUBLE) + 1.0::DOUBLE))) AS HUGEINT), nk
  FROM (SELECT *, (k * 2862933555777941757 + 1) % CAST(18446744073709551616 AS HUGEINT) AS nk FROM jumps WHERE j < n)
), dealt AS (
  SELECT rid, CAST(max(b) FILTER (n = 24) AS INTEGER) AS shard, CAST(max(b) FILTER (n = 25) AS INTEGER) AS grown_shard FROM jumps WHERE j >= n GROUP BY rid
), sums AS (
  SELECT rid, doc_id, CAST(length(h) // 2 + 8 AS BIGINT) AS size,
    xor(list_reduce([4294967295] || list_transform(range(0, length(h) // 2), lambda p: CAST(('0x' || h[2 * p + 1 : 2 * p + 2]) AS BIGINT)),
      lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) AS text_crc32
  FROM src, tbl
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM sums JOIN dealt USING (rid)
"""
