"""Mixing sources to target weights by weighted fair queueing (operator 8).

Every document of a source gets a place in a shuffled order, and its virtual
finish time is the source's cumulative size up to and with it, divided by the
source's target. A second pass over the same order serves repeats. All items
are sorted by finish time over the whole corpus and taken until the budget is
used up, so all sources advance in step with their targets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_SQL, running_total, small, staged

#: Weights of the sources in code point order, repeating; share of all sizes that the mix takes; most passes over a document.
WEIGHTS, SHARE, PASSES = (3, 1, 2), 1.5, 2


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """(source, source_size) -> source, source_size, rank, target.

    Budget is shared by weight; a source over ``passes`` times its size stops
    there and the excess is shared anew among the others by weight, until no
    source is above. Each round is one aggregate over the table of sources and
    stops at least one source, or is the last.
    """
    ranked = running_total(sizes.withColumn("_all", F.lit(0)).withColumn("_one", F.lit(1)).withColumn("_null", F.col("source").isNull()), "_all", ["_null", "source"], "_one", "sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("before") % len(weights) + 1).cast("int"))
    rows = staged(ranked.select("source", "source_size", F.col("before").alias("rank"), weight.alias("weight"), (F.col("source_size") * passes).cast("double").alias("cap")), "weights")
    budget = share * (rows.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    level, stopped = None, F.lit(False)
    while True:
        full, open_weight = rows.agg(F.sum(F.when(stopped, F.col("cap")).otherwise(0.0)), F.sum(F.when(stopped, 0).otherwise(F.col("weight")))).first()
        if not open_weight:
            break
        new = (budget - full) / open_weight
        if level is not None and new == level:
            break
        level = new
        stopped = F.col("weight") * F.lit(level) > F.col("cap")
    target = F.when(stopped, F.col("cap")).otherwise(F.col("weight") * F.lit(level or 0.0))
    return rows.select("source", "source_size", "rank", target.alias("target"))


def shuffle_key(seed: str) -> Column:
    """The place of a document in its source's shuffled order."""
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))))


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES, seed: str = "mix") -> DataFrame:
    """One row per document: its columns, size, source_size, target, taken.

    size counts words; a null or empty text has size 0 and is never taken. A
    null source is a source of its own, last in order. The shuffled order is
    by md5 of seed, id and text, so reruns agree; equal rows are
    interchangeable. The whole mix ends with the last document that still fits
    the budget, so each source comes within about one document of its target.
    Empty input gives no rows.
    """
    word_count = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD_SQL)), F.lit(0)).cast("long")
    rows = staged(docs.select("doc_id", "source", word_count.alias("size"), shuffle_key(seed).alias("_order")), "mix-sizes")
    targets = staged(source_targets(staged(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources"), weights, share, passes), "mix-targets")
    known = rows.join(small(targets, targets.count()), rows["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    placed = running_total(known, "rank", ["_order"], "size", "mix-order")
    done = F.col("before") + F.col("size")
    finish = F.array(*[(done + F.col("source_size") * k) / F.col("target") for k in range(passes)])
    placed = placed.withColumn("_finish", F.when(F.col("size") > 0, finish))
    items = placed.select(F.explode("_finish").alias("finish"), "rank", "_order", "size", F.lit(0).alias("_all"))
    budget = share * (targets.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    queue = running_total(items, "_all", ["finish", "rank", "_order"], "size", "mix-queue")
    last = queue.where(F.col("before") + F.col("size") <= budget).agg(F.max(F.struct("finish", "rank", "_order")).alias("m")).first()["m"]
    if last is None:
        served = F.lit(0)
    else:
        end = F.struct(F.lit(last["finish"]).alias("finish"), F.lit(last["rank"]).alias("rank"), F.lit(last["_order"]).alias("_order"))
        at = lambda f: F.struct(f.alias("finish"), "rank", "_order")
        served = F.coalesce(F.size(F.filter("_finish", lambda f: at(f) <= end)), F.lit(0))
    return placed.select("doc_id", "source", "_order", "size", "source_size", "target", F.when(F.col("size") > 0, F.col("size") * served).otherwise(0).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, seed: str = "mix", **options) -> DataFrame:
    """The mix itself: every taken document with its columns, once for each time that it is taken."""
    plan = mix_plan(docs, seed=seed, **options).where("taken > 0")
    times = plan.groupBy("_order").agg(F.sum((F.col("taken") / F.col("size")).cast("int")).alias("_times"))
    keyed = docs.withColumn("_order", shuffle_key(seed))
    one = keyed.join(times, "_order").dropDuplicates(["_order"])
    return one.withColumn("_time", F.explode(F.sequence(F.lit(1), "_times"))).select(*[F.col(f"`{c}`") for c in docs.columns])


#: DuckDB: the same with the weights, share and passes above.
SQL = r"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5(concat_ws(':', 'mix', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(text, ''))) AS o
  FROM documents
), src AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM rows GROUP BY source
), w AS (SELECT *, [3, 1, 2][rank % 3 + 1] AS weight, 2.0::DOUBLE * source_size AS cap FROM src),
lev(n, level) AS (
  SELECT 0, (1.5::DOUBLE * (SELECT sum(source_size)::BIGINT FROM w)) / (SELECT sum(weight)::BIGINT FROM w)
  UNION ALL
  SELECT n + 1, (SELECT (1.5::DOUBLE * sum(source_size)::BIGINT - sum(CASE WHEN weight * level > cap THEN cap ELSE 0 END))
      / sum(CASE WHEN weight * level > cap THEN 0 ELSE weight END)::BIGINT FROM w)
  FROM lev WHERE n < 60
), t AS (
  SELECT source, source_size, rank, CASE WHEN weight * l > cap THEN cap ELSE weight * l END AS target
  FROM w, (SELECT max_by(level, n) AS l FROM lev)
), placed AS (
  SELECT r.*, t.source_size, t.rank, t.target, sum(size) OVER (PARTITION BY t.rank ORDER BY o)::BIGINT AS done
  FROM rows r JOIN t ON r.source IS NOT DISTINCT FROM t.source
), items AS (
  SELECT *, (done + k * source_size)::DOUBLE / target AS finish FROM placed, (SELECT unnest([0, 1]) AS k) WHERE size > 0
), queue AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank, o) AS used FROM items
), took AS (
  SELECT doc_id, o, sum(size)::BIGINT AS taken FROM queue WHERE used <= 1.5 * (SELECT sum(source_size) FROM src) GROUP BY doc_id, o
)
SELECT p.doc_id, p.size, p.source_size, p.target, coalesce(taken, 0) AS taken FROM placed p LEFT JOIN took k ON p.o = k.o AND p.doc_id IS NOT DISTINCT FROM k.doc_id
"""
