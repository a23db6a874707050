"""N-gram Jaccard join with rare-first prefix filtering (operator 2).

1. Each text becomes the set of its shingles' 64-bit hashes. Tasks send the
   hashes, with the number of the document in its batch, to hash ranges;
   there, document frequencies are counted, and those of two or more go back.
2. A document's shingles are ordered rare first. Two sets that reach the
   threshold share a shingle in their prefixes, the first n - ceil(t n) + 1;
   shingles of one document alone come first and can't be shared, so most
   documents end here.
3. Documents that share prefix shingles form candidate groups (components of
   a star for each shingle). Each group is verified in a task of its own, a
   large one in blocks of two parts: pairs meet at their first common prefix
   shingle, pass the length, positional and suffix filters, and are verified
   once. A task returns a spanning forest of the links that it found.
4. Components of these links give each document's class.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import free_models, staged
from .components import components
from .shingles import mixed, shingle_sets
from .token_files import opened

#: Bytes of text, and documents, that are sent as one batch; bytes of one hash range that a task holds before it spools them.
BATCH_BYTES, BATCH_DOCS, HELD_BYTES = 8 << 20, 60_000, 128 << 20
#: Members of a part of a large group; parts of the suffix filter.
PART, SUFFIX_PARTS = 1024, 16


def signature(s: np.ndarray) -> bytes:
    """16 bytes for a set of hashes, whatever its order; empty for the empty set."""
    if not len(s):
        return b""
    a, b = mixed(s + np.uint64(0x51ED270B7A2F1C43)), mixed(s ^ np.uint64(0x2545F4914F6CDD1D))
    return np.array([a.sum() + np.uint64(len(s)), b.sum()], ">u8").tobytes()


def _pack(h: np.ndarray) -> bytes:
    """Sorted hashes as differences of as few bytes as hold them, 6 at least: that number, the first hash, the differences."""
    gap = h[1:] - h[:-1]
    width = max(6, (int(gap.max()).bit_length() + 7) // 8) if len(gap) else 6
    return bytes([width]) + h[:1].tobytes() + np.ascontiguousarray(gap.view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    first, rest = np.frombuffer(raw, np.uint64, 1, 1), np.frombuffer(raw, np.uint8, -1, 9)
    wide = np.zeros((len(rest) // raw[0], 8), np.uint8)
    wide[:, : raw[0]] = rest.reshape(-1, raw[0])
    gap = wide.reshape(-1).view(np.uint64)
    return np.cumsum(np.concatenate([first, gap]), dtype=np.uint64)


_SENT = "bucket int, batch long, hashes binary, docs binary, extra binary"
_SENT_NAMES = ["bucket", "batch", "hashes", "docs", "extra"]
_SENT_ARROW = pa.schema([("bucket", pa.int32()), ("batch", pa.int64()), ("hashes", pa.binary()), ("docs", pa.binary()), ("extra", pa.binary())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SENT_ARROW, strict=True)], schema=_SENT_ARROW)


def _send(buckets: int, width: int):
    """Per batch one header (signatures, ids and set sizes) and its hashes by range."""

    def batch_rows(number: int, ids: list, texts: list) -> Iterator[pa.RecordBatch]:
        sets = shingle_sets(texts, width)
        sizes = np.array([len(s) for s in sets], np.uint32)
        key = np.array([0 if i is None else i for i in ids], np.int64)
        head = key.tobytes() + np.array([i is None for i in ids], np.uint8).tobytes()
        rows = [(-1 - number % 997, number, b"".join(signature(s).ljust(16, b"\0") for s in sets), sizes.tobytes(), head)]
        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        every, doc = every[order], np.repeat(np.arange(len(sets), dtype=np.uint16), sizes)[order]
        place = ((every >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        cut = np.searchsorted(place, np.arange(buckets + 1, dtype=np.uint64))
        for b in range(buckets):
            i, j = cut[b], cut[b + 1]
            if j > i:
                rows.append((b, number, _pack(every[i:j]), doc[i:j].tobytes(), None))
        for k in range(0, len(rows), 64):
            yield _rows(rows[k : k + 64])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_models()
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 24
        ids, held, size = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids.append(i)
                held.append(t)
                size += len(t or "")
                if size >= BATCH_BYTES or len(ids) >= BATCH_DOCS:
                    yield from batch_rows(number, ids, held)
                    number, ids, held, size = number + 1, [], [], 0
        if ids:
            yield from batch_rows(number, ids, held)

    return run


class _Spool:
    """Packed rows of one hash range: in memory up to HELD_BYTES, then in a file of the shared folder."""

    def __init__(self, root: str):
        self.root, self.rows, self.size, self.path = root, [], 0, None

    def add(self, row: tuple[int, bytes, bytes]) -> None:
        self.rows.append(row)
        self.size += len(row[1]) + len(row[2])
        if self.size > HELD_BYTES:
            if self.path is None:
                self.where, base = opened(self.root)
                self.where.create_dir(base, recursive=True)
                self.path = f"{base}/{uuid.uuid4().hex}"
                self.sink = self.where.open_output_stream(self.path)
            for number, h, d in self.rows:
                self.sink.write(np.array([number, len(h), len(d)], np.int64).tobytes() + h + d)
            self.rows, self.size = [], 0

    def __iter__(self):
        if self.path is not None:
            self.sink.close()
            with self.where.open_input_stream(self.path) as f:
                while head := f.read(24):
                    number, a, b = np.frombuffer(head, np.int64).tolist()
                    yield number, f.read(a), f.read(b)
        yield from self.rows

    def close(self) -> None:
        if self.path is not None:
            self.where.delete_file(self.path)


def _count(known: tuple[np.ndarray, np.ndarray], new: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    h = np.concatenate([known[0], *new])
    n = np.concatenate([known[1], np.ones(len(h) - len(known[0]), np.int64)])
    order = np.argsort(h, kind="stable")
    h, n = h[order], n[order]
    at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[at], np.add.reduceat(n, at) if len(at) else n


def _frequent(root: str):
    """Of each hash range: what occurs in two documents or more, with the frequency, by batch."""

    def finish(bucket: int, spool: _Spool, known, pending) -> Iterator[pa.RecordBatch]:
        h, n = _count(known, pending)
        h, n = h[n > 1], np.minimum(n[n > 1], 0xFFFFFFFF).astype(np.uint32)
        rows = []
        for number, packed, docs in spool if len(h) else ():
            own = _unpack(packed)
            at = np.minimum(np.searchsorted(h, own), len(h) - 1)
            hit = h[at] == own
            if hit.any():
                rows.append((bucket, number, own[hit].tobytes(), np.frombuffer(docs, np.uint16)[hit].tobytes(), n[at[hit]].tobytes()))
            if len(rows) >= 64:
                yield _rows(rows)
                rows = []
        if rows:
            yield _rows(rows)
        spool.close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_models()
        none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        bucket, spool, known, pending, waiting = None, _Spool(root), none, [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in _SENT_NAMES), strict=True):
                if row[0] < 0:
                    yield _rows([row])
                    continue
                if row[0] != bucket:
                    if bucket is not None:
                        yield from finish(bucket, spool, known, pending)
                    bucket, spool, known, pending, waiting = row[0], _Spool(root), none, [], 0
                spool.add((row[1], row[2], row[3]))
                pending.append(_unpack(row[2]))
                waiting += len(pending[-1])
                if waiting > 4_000_000:
                    known, pending, waiting = _count(known, pending), [], 0
        if bucket is not None:
            yield from finish(bucket, spool, known, pending)

    return run


_SETS = "doc_id long, n_shingles long, sig binary, shared binary, lead int, lead_df binary"


def _order(percent: int):
    """Per document its shared shingles rare first, and how many of them its prefix holds."""

    def finish(head: tuple, parts: list[tuple]) -> pa.RecordBatch:
        sigs, sizes, extra = head
        n = np.frombuffer(sizes, np.uint32).astype(np.int64)
        count = len(n)
        ids, null = np.frombuffer(extra, np.int64, count), np.frombuffer(extra, np.uint8, count, 8 * count).astype(bool)
        h = np.concatenate([np.frombuffer(p[0], np.uint64) for p in parts]) if parts else np.zeros(0, np.uint64)
        doc = np.concatenate([np.frombuffer(p[1], np.uint16) for p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64)
        df = np.concatenate([np.frombuffer(p[2], np.uint32) for p in parts]) if parts else np.zeros(0, np.uint32)
        m = np.bincount(doc, minlength=count)
        prefix = np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)
        lead = np.clip(prefix - (n - m), 0, m)
        use = lead[doc] > 0
        h, doc, df = h[use], doc[use], df[use]
        order = np.lexsort((h, df, doc))
        h, df, cut = h[order], df[order], np.searchsorted(doc[order], np.arange(count + 1))
        shared = [h[cut[k] : cut[k + 1]].tobytes() if lead[k] else None for k in range(count)]
        lead_df = [df[cut[k] : cut[k] + lead[k]].tobytes() if lead[k] else None for k in range(count)]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64(), mask=null), pa.array(n, pa.int64()), pa.array([sigs[16 * k : 16 * k + 16] if n[k] else None for k in range(count)], pa.binary()), pa.array(shared, pa.binary()), pa.array(lead.astype(np.int32), pa.int32()), pa.array(lead_df, pa.binary())],
            ["doc_id", "n_shingles", "sig", "shared", "lead", "lead_df"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_models()
        number, head, parts = None, None, []
        for batch in batches:
            for bucket, at, hashes, docs, extra in zip(*(batch.column(c).to_pylist() for c in _SENT_NAMES), strict=True):
                if at != number:
                    if head is not None:
                        yield finish(head, parts)
                    number, head, parts = at, None, []
                if bucket < 0:
                    head = (hashes, docs, extra)
                else:
                    parts.append((hashes, docs, extra))
        if head is not None:
            yield finish(head, parts)

    return run


def shingle_table(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, sig (of the set), shared (shingles of two documents or more, rare first), lead (how many are in the prefix), lead_df (their document frequencies)."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_send(4 * parts, width), _SENT)
    counted = sent.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_frequent(scratch_path(spark, "spool")), _SENT)
    back = counted.repartition(parts, "batch").sortWithinPartitions("batch", "bucket").mapInArrow(_order(percent), _SETS)
    return staged(back, "shingles")


def _suffix_counts(sets: list[np.ndarray]) -> np.ndarray:
    """For each set, how many hashes fall into each of SUFFIX_PARTS ranges."""
    out = np.zeros((len(sets), SUFFIX_PARTS), np.int64)
    for k, s in enumerate(sets):
        out[k] = np.bincount((s >> np.uint64(60)).astype(np.int64), minlength=SUFFIX_PARTS)
    return out


def linked_pairs(sizes: np.ndarray, shared: list[np.ndarray], lead_df: list[np.ndarray], side: np.ndarray, percent: int) -> np.ndarray:
    """Index pairs with percent * union <= 100 * intersection, among those that share a prefix shingle.

    side: 0 throughout compares all; with 0 and 1, only pairs of both sides.
    Shingles are taken in the order of all prefixes, so a pair meets at its
    first common one: nothing before that place can be common.
    """
    k = len(sizes)
    held, lead = np.array([len(s) for s in shared]), np.array([len(s) for s in lead_df])
    universe, inverse = np.unique(np.concatenate(shared), return_inverse=True)
    bits = np.zeros((k, (len(universe) + 63) // 64), np.uint64)
    np.bitwise_or.at(bits, (np.repeat(np.arange(k), held), inverse // 64), np.uint64(1) << (inverse % 64).astype(np.uint64))
    start = np.cumsum(held) - held
    owner = np.repeat(np.arange(k), lead)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(lead) - lead, lead)
    token = inverse[start[owner] + place]
    order = np.lexsort((token, np.concatenate(lead_df)))
    owner, place, token = owner[order], place[order], token[order]
    at = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1], [True]]))
    seen = np.zeros((k, k), bool)
    counts = _suffix_counts(shared)
    found = []
    for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if j - i < 2:
            continue
        x, y = np.triu_indices(j - i, 1)
        a, b = owner[i:j][x], owner[i:j][y]
        new = ~seen[a, b] & ((side[a] != side[b]) if side.any() else True)
        a, b, x, y = a[new], b[new], x[new], y[new]
        seen[a, b] = seen[b, a] = True
        need = -(-percent * (sizes[a] + sizes[b]) // (100 + percent))  # least intersection
        go = 100 * np.minimum(sizes[a], sizes[b]) >= percent * np.maximum(sizes[a], sizes[b])  # length
        go &= np.minimum(held[a] - place[i:j][x], held[b] - place[i:j][y]) >= need  # positional
        a, b, need = a[go], b[go], need[go]
        step = max(1, (1 << 22) // max(SUFFIX_PARTS, bits.shape[1]))
        for c in range(0, len(a), step):
            p, q = a[c : c + step], b[c : c + step]
            go = np.minimum(counts[p], counts[q]).sum(1) >= need[c : c + step]  # suffix, by hash ranges
            p, q = p[go], q[go]
            same = np.bitwise_count(bits[p] & bits[q]).sum(1, dtype=np.int64)
            ok = 100 * same >= percent * (sizes[p] + sizes[q] - same)
            found.append(np.stack([p[ok], q[ok]], 1))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def _forest(pairs: np.ndarray, k: int) -> list[tuple[int, int]]:
    root = list(range(k))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in pairs.tolist():
        x, y = top(a), top(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def _verify(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, g in pdf.groupby("comp", sort=False):
            if len(g) < 2:
                continue
            shared = [np.frombuffer(x, np.uint64) for x in g["shared"]]
            pairs = linked_pairs(g["n"].to_numpy(np.int64), shared, [np.frombuffer(x, np.uint32) for x in g["lead_df"]], g["side"].to_numpy(np.int64), percent)
            sig = g["sig"].tolist()
            out += [(bytes(sig[a]), bytes(sig[b])) for a, b in _forest(pairs, len(g))]
        return pd.DataFrame(out, columns=["a", "b"])

    return run


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lead = batch.column("lead").to_numpy()
        tokens = [np.frombuffer(s.as_py(), np.int64, n) for s, n in zip(batch.column("shared"), lead.tolist(), strict=True)]
        if tokens:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens), pa.int64()), batch.column("sig").take(pa.array(np.repeat(np.arange(len(lead)), lead)))], ["token", "sig"])


def class_links(sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between signatures that connect every class of near-equal sets; from a shingle_table."""
    spark = sets.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    classes = staged(sets.where("lead > 0").groupBy("sig").agg(F.first("n_shingles").alias("n"), F.first("shared").alias("shared"), F.first("lead").alias("lead"), F.first("lead_df").alias("lead_df")), "classes")
    postings = staged(classes.select("sig", "shared", "lead").mapInArrow(_postings, "token long, sig binary"), "postings")
    stars = postings.groupBy("token").agg(F.min("sig").alias("b"), F.max("sig").alias("_max")).where("b != _max").drop("_max")
    groups = staged(components(postings.join(stars, "token").select(F.col("sig").alias("a"), "b").distinct(), "groups").withColumnsRenamed({"node": "sig", "label": "comp"}), "groups")
    size = groups.groupBy("comp").agg(F.count("*").alias("size"))
    sized = groups.join(size, "comp").withColumn("cuts", F.ceil(F.col("size") / PART).cast("int"))
    part = sized.withColumn("part", F.pmod(F.xxhash64("sig", F.lit(1)), "cuts").cast("int"))
    few = part.where("cuts = 1").select("sig", "comp", F.concat_ws("-", F.lit("p"), F.pmod(F.xxhash64("comp"), F.lit(8 * parts))).alias("block"), F.lit(0).alias("side"))
    many = part.where("cuts > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    many = many.select("sig", "comp", F.concat_ws("-", F.hex("comp"), F.least("part", "other"), F.greatest("part", "other")).alias("block"), (F.col("part") > F.col("other")).cast("int").alias("side"))
    blocks = classes.join(few.union(many), "sig").select("block", "comp", "sig", "n", "shared", "lead_df", "side")
    return staged(blocks.groupBy("block").applyInPandas(_verify(percent), "a binary, b binary"), "links")


def jaccard_classes(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; component_id is the least doc_id reachable by links.

    Two rows link when ``100 * intersection >= percent * union`` of their
    shingle sets. Null, empty and blank texts have no shingles, link with
    nothing and keep their own id. Rows with equal sets are one class, so
    repeated rows and copies are never paired. A null doc_id takes part in
    links but names no component unless all its ids are null. Other columns
    are ignored; an empty table gives no rows.
    """
    sets = shingle_table(docs, width, percent)
    nodes = components(class_links(sets, percent), "linked")
    ids = sets.where(F.col("sig").isNotNull()).groupBy("sig").agg(F.min("doc_id").alias("id"))
    known = ids.join(nodes, ids["sig"] == nodes["node"], "left").select("sig", "id", F.coalesce("label", "sig").alias("label"))
    known = staged(known, "labels")
    least = known.groupBy("label").agg(F.min("id").alias("component"))
    named = staged(known.join(least, "label").select(F.col("sig").alias("_sig"), "component"), "names")
    out = sets.join(named, sets["sig"] == named["_sig"], "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))


#: DuckDB: the same for four words and 85 percent, by all shared shingles.
SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), sh AS (
  SELECT doc_id, array_to_string(ws[p : p + 3], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS p FROM d WHERE len(ws) > 0)
), s AS (SELECT DISTINCT doc_id, g FROM sh),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
rare AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
both_ AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN rare USING (g) JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM both_ JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 85 * (a.n + b.n - o)),
e AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
r(doc_id, c) AS (SELECT x, x FROM e UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.doc_id),
c AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""
