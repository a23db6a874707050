"""Embedding near-duplicates by a robust-pruned flat graph (operator 1).

1. Equal vectors become one class. Classes are dealt to overlapping cluster
   shards, each to its nearest centroids.
2. In each shard every vector keeps, of its nearest neighbours, those that no
   kept one already covers (robust pruning). A vector's lists from all its
   shards are united.
3. In each shard every vector is searched: best-first from the shard's medoid
   until the vector itself is met, then on through everything within a wider
   range. What is found is verified by cosine in double precision.
4. A bounded sample is compared with all vectors by brute force; while it
   shows too low a recall, the work is repeated with more shards a vector, and
   if even the most are too few, all pairs that a bound on the angles to the
   centroids allows are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged
from .components import components

#: Vectors of a shard, and at most before it is cut into parts; centroids at most; sampled vectors for each centroid.
SHARD, PART, MOST_CENTROIDS, SAMPLE = 1500, 4000, 4096, 40
#: Shards a vector is put in, at first and at most; neighbours before and after pruning; the pruning's slack.
OVERLAP, MOST_OVERLAP, NEAREST, DEGREE, ALPHA = 2, 8, 64, 24, 1.2
#: Radians by which the exact join's bound on angles is widened for rounding.
ROUNDING = 1e-6
#: How far below the threshold the search still expands; queries searched together; nodes expanded at once.
SLACK, QUERIES, EXPAND = 0.06, 256, 4
#: The audit's sample and the least recall that it accepts.
AUDIT, LEAST_RECALL = 200, 0.95


def matrix(column) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in column])


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def fit_centroids(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means on a bounded sample of unit vectors."""
    rng = np.random.default_rng(3)
    c = sample[rng.choice(len(sample), k, replace=False)]
    for _ in range(rounds):
        to = (sample @ c.T).argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, to, sample)
        size = np.sqrt((total * total).sum(1, keepdims=True))
        c = np.where(size > 0, total / np.where(size > 0, size, 1), c)
    return c


def robust_prune(x: np.ndarray) -> np.ndarray:
    """Neighbour lists (rows padded with -1) of unit vectors: nearest first, without those that a kept one covers."""
    n = len(x)
    m = min(NEAREST, n - 1)
    out = np.full((n, min(DEGREE, m)), -1, np.int64)
    for at in range(0, n, 512):
        rows = np.arange(at, min(at + 512, n))
        sim = x[rows] @ x.T
        sim[np.arange(len(rows)), rows] = -2
        near = np.argpartition(-sim, m - 1, axis=1)[:, :m]
        near = np.take_along_axis(near, np.argsort(-np.take_along_axis(sim, near, 1), axis=1, kind="stable"), 1)
        far = 1 - np.take_along_axis(sim, near, 1)  # distance to the vector
        between = 1 - np.einsum("rid,rjd->rij", x[near], x[near])
        open_ = np.ones(near.shape, bool)
        for slot in range(out.shape[1]):
            pick = open_.argmax(1)
            has = open_.any(1)
            out[rows[has], slot] = near[has, pick[has]]
            covered = ALPHA * between[np.arange(len(rows)), pick] <= far
            open_ &= ~covered
            open_[np.arange(len(rows)), pick] = False
    return out


def search(x: np.ndarray, lists: np.ndarray, queries: np.ndarray, entry: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) with similarity of at least ``least`` that best-first search from ``entry`` meets.

    Every query is a node. Until it is met, the best open nodes are expanded;
    from then on, all open ones within ``least``. A query that the graph does
    not lead to starts at itself.
    """
    found_q, found_v = [], []
    n = len(x)
    for at in range(0, len(queries), QUERIES):
        own = queries[at : at + QUERIES]
        k = len(own)
        q = x[own]
        sim = np.full((k, n), -3.0, np.float32)  # open nodes; -3: not met, -2: expanded
        met = np.zeros((k, n), bool)
        near = np.zeros((k, n), bool)
        first = q @ x[entry]
        sim[:, entry], met[:, entry], near[:, entry] = first, True, first >= least
        live = np.arange(k)
        while len(live):
            s = sim[live]
            top = np.argpartition(-s, EXPAND - 1, axis=1)[:, :EXPAND] if n > EXPAND else np.tile(np.arange(n), (len(live), 1))
            best = np.take_along_axis(s, top, 1)
            arrived = met[live, own[live]]
            use = (best > -2) & (~arrived[:, None] | (best >= least))
            lost = ~use.any(1) & ~arrived
            if lost.any():  # not reachable from the entry
                r = live[lost]
                sim[r, own[r]], met[r, own[r]], near[r, own[r]] = 1.0, True, True
            go = use.any(1)
            rows = np.repeat(live, use.sum(1))
            nodes = top[use]
            sim[rows, nodes] = -2
            nb = lists[nodes]
            rr, vv = np.repeat(rows, nb.shape[1]), nb.reshape(-1)
            ok = vv >= 0
            rr, vv = rr[ok], vv[ok]
            ok = ~met[rr, vv]
            rr, vv = rr[ok], vv[ok]
            key = np.unique(rr * n + vv)
            rr, vv = key // n, key % n
            value = np.einsum("ij,ij->i", q[rr], x[vv])
            met[rr, vv], sim[rr, vv] = True, value
            hit = value >= least
            near[rr[hit], vv[hit]] = True
            live = live[go | lost]
        r, v = np.nonzero(near)
        found_q.append(own[r])
        found_v.append(v)
    if not found_q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_q), np.concatenate(found_v)


def _exact(x: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    norm = np.sqrt((x * x).sum(1))
    out = np.zeros(len(a), bool)
    for c in range(0, len(a), 1 << 16):
        p, q = a[c : c + (1 << 16)], b[c : c + (1 << 16)]
        out[c : c + (1 << 16)] = np.einsum("ij,ij->i", x[p], x[q]) / (norm[p] * norm[q]) >= threshold
    return out


def _deal(centroids: np.ndarray, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(matrix(batch.column("embedding").to_pylist()))
            k = min(overlap, len(centroids))
            sim = x @ centroids.T
            near = np.argpartition(-sim, k - 1, axis=1)[:, :k] if k < len(centroids) else np.tile(np.arange(k), (len(x), 1))
            take = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays([batch.column("cid").take(take), batch.column("embedding").take(take), pa.array(near.reshape(-1), pa.int64())], ["cid", "embedding", "shard"])

    return run


def _build(least: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) < 2:
            return pd.DataFrame({"cid": [], "to": [], "close": []})
        cid = pdf["cid"].to_numpy()
        x = unit(matrix(pdf["embedding"]))
        lists = robust_prune(x)
        a, slot = np.nonzero(lists >= 0)
        b = lists[a, slot]
        close = np.concatenate([np.einsum("ij,ij->i", x[a[c : c + 65536]], x[b[c : c + 65536]]) for c in range(0, len(a), 65536)]) >= least
        return pd.DataFrame({"cid": cid[a], "to": cid[b], "close": close})

    return run


def _search(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["member", "asked"], ascending=False, kind="stable").drop_duplicates("cid")  # a vector may be searched here and be a neighbour, too
        cid = pdf["cid"].to_numpy()
        raw = matrix(pdf["embedding"])
        x = unit(raw).astype(np.float32)
        place = pd.Series(np.arange(len(cid)), index=cid)
        edge = pdf["list"].explode().dropna()
        src = place.reindex(pdf["cid"].to_numpy()[edge.index.map(pd.Series(np.arange(len(pdf)), index=pdf.index))]).to_numpy(np.int64) if len(edge) else np.zeros(0, np.int64)
        dst = place.reindex(edge.to_numpy()).to_numpy(float) if len(edge) else np.zeros(0)
        src, dst = src[~np.isnan(dst)], dst[~np.isnan(dst)].astype(np.int64)
        both = np.unique(np.concatenate([src * len(cid) + dst, dst * len(cid) + src])) if len(src) else np.zeros(0, np.int64)
        src, dst = both // len(cid), both % len(cid)
        degree = np.bincount(src, minlength=len(cid))
        lists = np.full((len(cid), max(1, degree.max())), -1, np.int64)
        lists[src, np.arange(len(src)) - np.repeat(np.cumsum(degree) - degree, degree)] = dst
        member = pdf["member"].to_numpy(bool)
        mean = x[member].mean(0) if member.any() else x.mean(0)
        entry = int(np.where(member, x @ mean, -2).argmax()) if member.any() else 0
        q, v = search(x, lists, np.flatnonzero(pdf["asked"].to_numpy(bool)), entry, threshold - SLACK)
        go = q != v
        a, b = np.minimum(q[go], v[go]), np.maximum(q[go], v[go])
        key = np.unique(a * len(cid) + b)
        a, b = key // len(cid), key % len(cid)
        ok = _exact(raw, a, b, threshold)
        return pd.DataFrame({"a": np.minimum(cid[a[ok]], cid[b[ok]]), "b": np.maximum(cid[a[ok]], cid[b[ok]])})

    return run


def _centroids(classes: DataFrame) -> np.ndarray | None:
    """Centroids of the shards, from a bounded sample; None if it is empty."""
    n = classes.count()
    k = int(min(MOST_CENTROIDS, max(1, round(n / SHARD))))
    share = min(1.0, SAMPLE * k / max(n, 1))
    sample = classes.where(F.pmod(F.xxhash64("cid"), F.lit(1_000_003)) < F.lit(share * 1_000_003 + 1)).select("cid", "embedding").toPandas().sort_values("cid")
    return fit_centroids(unit(matrix(sample["embedding"])), max(1, min(k, len(sample)))) if len(sample) else None


def _angles(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Radians between unit vectors and centroids, which are brought to length 1."""
    return np.arccos(np.clip(x @ unit(centroids).T, -1, 1))


def _home(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                far = _angles(unit(matrix(batch.column("embedding").to_pylist())), centroids)
                yield pa.RecordBatch.from_arrays([batch.column("cid"), batch.column("embedding"), pa.array(far.argmin(1), pa.int64()), pa.array(far.min(1))], ["cid", "embedding", "shard", "angle"])

    return run


def _visit(centroids: np.ndarray, reach: np.ndarray):
    """Every vector in each later shard than its own that may hold one within the threshold of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                far = _angles(unit(matrix(part.column("embedding").to_pylist())), centroids)
                row, shard = np.nonzero((far <= reach) & (np.arange(len(reach)) > part.column("shard").to_numpy()[:, None]))
                for c in range(0, len(row), 4096):
                    take = pa.array(row[c : c + 4096])
                    yield pa.RecordBatch.from_arrays([part.column("cid").take(take), part.column("embedding").take(take), pa.array(shard[c : c + 4096], pa.int64())], ["cid", "embedding", "shard"])

    return run


def _compare(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        member = pdf["member"].to_numpy(bool)
        cid, raw = pdf["cid"].to_numpy(), matrix(pdf["embedding"])
        x = unit(raw)
        own, other = np.flatnonzero(member), np.flatnonzero(~member)
        found = []
        for c in range(0, len(own), 512):
            i, j = np.nonzero(x[own[c : c + 512]] @ x[other].T >= threshold - ROUNDING)
            i, j = own[c + i], other[j]
            i, j = i[cid[i] != cid[j]], j[cid[i] != cid[j]]
            ok = _exact(raw, i, j, threshold)
            found.append(pd.DataFrame({"a": np.minimum(cid[i[ok]], cid[j[ok]]), "b": np.maximum(cid[i[ok]], cid[j[ok]])}))
        return pd.concat(found) if found else pd.DataFrame({"a": [], "b": []})

    return run


def exact_links(classes: DataFrame, threshold: float) -> DataFrame:
    """All links, as ``graph_links`` has them: blocks of at most about ``PART`` vectors are compared whole.

    A vector is at home in the shard of its nearest centroid, and visits each
    later shard whose centroid is within the shard's radius and the
    threshold's angle of it; by the triangle inequality no other shard after
    its own holds a link of it.
    """
    centroids = _centroids(classes)
    if centroids is None:
        return classes.sparkSession.createDataFrame([], "a binary, b binary")
    home = staged(classes.mapInArrow(_home(centroids), "cid binary, embedding array<double>, shard long, angle double"), "homes")
    reach = np.full(len(centroids), -1.0)
    for r in home.groupBy("shard").agg(F.max("angle").alias("angle")).collect():  # one row for each centroid at most
        reach[r["shard"]] = r["angle"] + np.arccos(np.clip(threshold, -1, 1)) + ROUNDING
    member = home.select("shard", "cid", "embedding")
    guest = member.union(staged(home.mapInArrow(_visit(centroids, reach), "cid binary, embedding array<double>, shard long"), "guests").select("shard", "cid", "embedding"))
    parts = lambda df, name: df.groupBy("shard").agg(F.ceil(F.count("*") / PART).cast("int").alias(name))
    size = staged(parts(member, "rows").join(parts(guest, "columns"), "shard"), "blocks")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    of = lambda n: F.pmod(F.xxhash64("cid", F.lit(5)), n).cast("int")
    down = member.join(F.broadcast(size), "shard").select("shard", of("rows").alias("row"), each("columns").alias("column"), "cid", "embedding", F.lit(True).alias("member"))
    across = guest.join(F.broadcast(size), "shard").select("shard", each("rows").alias("row"), of("columns").alias("column"), "cid", "embedding", F.lit(False).alias("member"))
    return staged(down.union(across).groupBy("shard", "row", "column").applyInPandas(_compare(threshold), "a binary, b binary").distinct(), "exact-links")


def graph_links(classes: DataFrame, threshold: float, overlap: int) -> DataFrame:
    """(a, b) verified links between classes (cid binary, embedding array<double>) of one dimension."""
    spark = classes.sparkSession
    centroids = _centroids(classes)
    if centroids is None:
        return spark.createDataFrame([], "a binary, b binary")
    dealt = staged(classes.mapInArrow(_deal(centroids, overlap), "cid binary, embedding array<double>, shard long"), "shards")
    size = dealt.groupBy("shard").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    dealt = dealt.join(F.broadcast(size), "shard").withColumn("part", F.pmod(F.xxhash64("cid", F.lit(5)), "parts").cast("int"))  # one row for each centroid at most
    built = dealt.groupBy("shard", "part").applyInPandas(_build(threshold - SLACK), "cid binary, to binary, close boolean")
    lists = staged(built.groupBy("cid", "to").agg(F.max("close").alias("close")), "lists")
    united = lists.groupBy("cid").agg(F.collect_set("to").alias("list"))  # at most DEGREE for each shard of a vector
    members = dealt.join(united, "cid", "left")
    # a part's block: its members, the other parts' vectors that are searched in it, and neighbours outside that
    # are within the range the search expands (farther ones lead nowhere that matters)
    asked = dealt.where("parts > 1").withColumn("to_part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("to_part != part")
    asked = asked.join(united, "cid", "left").select("shard", F.col("to_part").alias("part"), "cid", "embedding", "list", F.lit(False).alias("member"), F.lit(True).alias("asked"))
    block = members.select("shard", "part", "cid", "embedding", "list", F.lit(True).alias("member"), F.lit(True).alias("asked")).union(asked)
    there = dealt.select("shard", "part", "cid")
    rim = there.join(lists.where("close"), "cid").select("shard", "part", F.col("to").alias("cid")).distinct().join(there, ["shard", "part", "cid"], "left_anti")
    rim = rim.join(classes, "cid").select("shard", "part", "cid", "embedding", F.lit(None).cast("array<binary>").alias("list"), F.lit(False).alias("member"), F.lit(False).alias("asked"))
    block = block.union(rim)
    return staged(block.groupBy("shard", "part").applyInPandas(_search(threshold), "a binary, b binary").distinct(), "vector-links")


def audit(classes: DataFrame, links: DataFrame, threshold: float, most: int = AUDIT) -> float:
    """Share of the brute-force links of a bounded sample of classes that are in ``links``; 1 if there are none."""
    n = classes.count()
    some = classes.where(F.pmod(F.xxhash64("cid", F.lit(11)), F.lit(1_000_003)) < F.lit(min(1.0, most / max(n, 1)) * 1_000_003 + 1)).select("cid", "embedding").toPandas()
    if not len(some):
        return 1.0
    q, names = unit(matrix(some["embedding"])), some["cid"].to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cid = np.array(batch.column("cid").to_pylist(), object)
                i, j = np.nonzero(q @ unit(matrix(batch.column("embedding").to_pylist())).T >= threshold)
                a, b = names[i], cid[j]
                go = a != b
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a[go], b[go]), pa.binary()), pa.array(np.maximum(a[go], b[go]), pa.binary())], ["a", "b"])

    true = classes.mapInArrow(run, "a binary, b binary").distinct()
    both = true.join(links.withColumn("hit", F.lit(1)), ["a", "b"], "left").agg(F.count("*"), F.count("hit")).first()
    return both[1] / both[0] if both[0] else 1.0


def vector_duplicates(rows: DataFrame, threshold: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding).

    Vectors that are null, empty or zero, or hold null or non-finite
    components, link with nothing: n_links 0, their own id as component, kept.
    Equal vectors are one class and link with each other; vectors of
    different lengths never link. Labels and other columns are not read. A
    null vec_id takes part in links but names no component.
    """
    spark = rows.sparkSession
    x = F.col("embedding")
    good = x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))) & F.exists(x, lambda v: v != 0)
    base = rows.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("embedding")).withColumn("good", F.coalesce(good, F.lit(False)))
    named = base.withColumn("cid", F.when(F.col("good"), F.unhex(F.md5(F.concat_ws(",", F.transform("embedding", lambda v: (v + F.lit(0.0)).cast("string")))))))
    ids = staged(named.select("vec_id", "cid"), "vector-ids")
    classes = staged(named.where("good").groupBy("cid").agg(F.first("embedding").alias("embedding"), F.min("vec_id").alias("id"), F.count("*").alias("n")), "vector-classes")
    links: DataFrame | None = None
    for size in sorted(r[0] for r in classes.select(F.size("embedding")).distinct().collect()):  # lengths: one, as a rule
        own = classes.where(F.size("embedding") == size).select("cid", "embedding")
        overlap = OVERLAP
        while True:
            part = graph_links(own, threshold, overlap)
            if audit(own, part, threshold) >= LEAST_RECALL:
                break
            if overlap >= MOST_OVERLAP:
                part = exact_links(own, threshold)
                break
            overlap *= 2
        links = part if links is None else links.union(part)
    if links is None:
        links = spark.createDataFrame([], "a binary, b binary")
    size = classes.select("cid", "id", "n")
    both = links.union(links.select("b", "a"))
    count = both.join(size.select(F.col("cid").alias("b"), "n"), "b").groupBy("a").agg(F.sum("n").alias("others"))
    labels = components(links, "vector-components")
    known = size.join(count, size["cid"] == count["a"], "left").join(labels, size["cid"] == labels["node"], "left")
    known = staged(known.select("cid", "id", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("label", "cid").alias("label")), "vector-known")
    least = known.groupBy("label").agg(F.min("id").alias("component_id"))
    found = known.join(least, "label").select(F.col("cid").alias("_cid"), "n_links", "component_id")
    out = ids.join(found, ids["cid"] == found["_cid"], "left")
    component = F.when(F.col("cid").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


#: DuckDB: the same by brute force.
SQL = r"""
WITH RECURSIVE e AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, coalesce(len(list_filter(embedding, lambda z: z IS NULL OR NOT isfinite(z))) = 0 AND len(list_filter(embedding, lambda z: z <> 0)) > 0, false) AS good FROM embeddings
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM e a JOIN e b ON a.vec_id <> b.vec_id AND a.good AND b.good AND len(a.v) = len(b.v)
  WHERE list_inner_product(a.v, b.v) / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= 0.95
), n AS (SELECT x, count(*) AS n FROM links GROUP BY x),
r(vec_id, c) AS (SELECT x, x FROM links UNION SELECT l.y, r.c FROM r JOIN links l ON l.x = r.vec_id),
c AS (SELECT vec_id, min(c) AS component_id FROM r GROUP BY vec_id)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.component_id, e.vec_id) AS component_id, coalesce(c.component_id, e.vec_id) = e.vec_id AS kept
FROM e LEFT JOIN n ON n.x = e.vec_id LEFT JOIN c ON c.vec_id = e.vec_id
"""
