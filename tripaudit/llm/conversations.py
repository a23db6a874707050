"""Conversation structure repair with an audit of its edits (operator 12).

Each row of a conversation has a fault or none; the cheapest edits that give
the roles an alternating order are found by dynamic programming over the rows,
with four states: nothing yet, after a system turn, after a user turn, after
an assistant turn. Edit sequences share their prefixes as linked nodes. Where
two of equal cost meet, their longest common prefix is found over binary
lifted ancestors and rolling hashes, and the edit after it decides; equal
hashes of different nodes are verified edit by edit.

A conversation may hold a third of all rows, so it is cut into chunks of rows.
Tasks solve a chunk from each state to each state; then the chunks of a
conversation are chained by the same nodes, with whole chunks in place of
edits. The repaired turns are hashed as they stream by.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

#: Rows of a chunk (a power of two), and rows up to which a chunk is solved where it is chained.
CHUNK_BITS, SHORT = 10, 64
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"
#: Codes of rows by their role's initial (s, u, a, another): sound, truncated, to be deleted.
SOUND, CUT, GONE = "suax", "SUAX", "1234"
_INITIAL = {c: "suax"[i % 4] for i, c in enumerate(SOUND + CUT + GONE)}
_LEGAL = {"su", "ua", "au"}
#: State after a turn of the next role; the states in which a conversation may end, and the edits that lead there from the others.
NEXT = (2, 2, 3, 2)
ENDING = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))
_PRIME, _BASE = (1 << 61) - 1, 911382323 * 972663749


class Edits:
    """Sequences of edits as nodes: each is its parent's sequence and one more edit."""

    def __init__(self):
        self.up: list[tuple[int, ...]] = [()]  # ancestors 1, 2, 4, ... edits before
        self.edit, self.depth, self.hash = [0], [0], [0]

    def add(self, parent: int, edit: int) -> int:
        up, at = [parent], parent
        while len(self.up[at]) >= len(up):
            at = self.up[at][len(up) - 1]
            up.append(at)
        self.up.append(tuple(up))
        self.edit.append(edit)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * _BASE + edit + 1) % _PRIME)
        return len(self.edit) - 1

    def listed(self, node: int) -> list[int]:
        out = []
        while node:
            out.append(self.edit[node])
            node = self.up[node][0]
        return out[::-1]

    def _lifted(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            node = self.up[node][(self.depth[node] - depth).bit_length() - 1]
        return node

    def _same(self, x: int, y: int) -> bool:
        """Whether sequences of one length and hash are equal, edit by edit down to a shared node."""
        while x != y:
            if self.edit[x] != self.edit[y]:
                return False
            x, y = self.up[x][0], self.up[y][0]
        return True

    def before(self, a: int, b: int) -> bool:
        """Whether the sequence of ``a`` sorts before that of ``b``; a prefix sorts before what it begins."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self._lifted(a, depth), self._lifted(b, depth)
        if self.hash[x] == self.hash[y]:
            return self.depth[a] < self.depth[b] if self._same(x, y) else self.listed(a) < self.listed(b)
        for k in reversed(range(len(self.up[x]))):
            if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                x, y = self.up[x][k], self.up[y][k]
        if not self._same(self.up[x][0], self.up[y][0]):
            return self.listed(a) < self.listed(b)
        return self.edit[x] < self.edit[y]

    def cheapest(self, found: list[tuple[int, int, tuple[int, ...]]]) -> tuple[int, int] | None:
        """The least (cost, node, further edits) by cost, then by sequence, as (cost, node)."""
        if not found:
            return None
        cost = min(f[0] for f in found)
        best = None
        for c, node, more in found:
            if c == cost:
                for edit in more:
                    node = self.add(node, edit)
                if best is None or self.before(node, best):
                    best = node
        return cost, best


_K, _R, _D, _I = map(ord, "KRDI")


def _row(edits: Edits, states: list, code: str) -> list:
    """The states after a row: turns inserted before it, then the row kept, given a role or deleted."""
    at = [[(*s, ())] if s else [] for s in states]
    for state, s in enumerate(states):
        more, cost = (), 0
        while s and len(more) < 2:
            state, more, cost = NEXT[state], (*more, _I), cost + INSERT
            at[state].append((s[0] + cost, s[1], more))
    ready = [edits.cheapest(f) for f in at]
    out: list[list] = [[], [], [], []]
    fine = code in SOUND
    initial = _INITIAL[code]
    for state, s in enumerate(ready):
        if not s:
            continue
        cost, node = s
        out[state].append((cost + DELETE, node, (_D,)))
        if code in GONE:
            continue
        cost += 0 if fine else TRUNCATED
        to = NEXT[state]
        if initial == "ua"[to - 2]:
            out[to].append((cost, node, (_K,)))
        elif initial == "s" and state == 0:
            out[1].append((cost, node, (_K,)))
        out[to].append((cost + REROLE, node, (_R,)))
    return [edits.cheapest(f) for f in out]


def solve(codes: str) -> list[list[tuple[int, str] | None]]:
    """[from][to]: the cheapest edits of these rows from one state to another, as (cost, audit), or None."""
    table = []
    for start in range(4):
        edits = Edits()
        states: list = [None] * 4
        states[start] = (0, 0)
        for code in codes:
            states = _row(edits, states, code)
        table.append([s and (s[0], bytes(edits.listed(s[1])).decode()) for s in states])
    return table


_short = lru_cache(20_000)(solve)


def _illegal(codes: str) -> int:
    return sum(_INITIAL[x] + _INITIAL[y] not in _LEGAL for x, y in zip(codes, codes[1:]))


def chain(chunks: list[tuple[str, list | None]]) -> tuple[int, int, str]:
    """(illegal, cost, audit) of a conversation from its (codes, solved table or None) in order."""
    edits = Edits()
    states: list = [(0, 0), None, None, None]
    texts = [""]  # of each node's own chunk
    illegal, last = 0, ""
    for codes, table in chunks:
        illegal += _illegal(codes) + (_illegal(last + codes[0]) if last else 0)
        last = codes[-1]
        table = table or _short(codes)
        ranks = sorted({t[1] for row in table for t in row if t})
        rank = {t: i for i, t in enumerate(ranks)}
        after: list = []
        for to in range(4):
            found = [(s[0] + table[state][to][0], s[1], (rank[table[state][to][1]],)) for state, s in enumerate(states) if s and table[state][to]]
            after.append(edits.cheapest(found))
            texts += [ranks[e] for e in edits.edit[len(texts) :]]
        states = after
    best = None
    for (more, tail), s in zip(ENDING, states, strict=True):
        if s and (best is None or s[0] + more < best[0] or s[0] + more == best[0] and edits.before(s[1], best[1])):
            best = (s[0] + more, s[1], tail)
    cost, node, tail = best
    out = [tail]
    while node:
        out.append(texts[node])
        node = edits.up[node][0]
    return illegal, cost, "".join(reversed(out))


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the solved table of the long chunks."""
    for batch in batches:
        tables = [None if len(c) <= SHORT else zlib.compress(json.dumps(solve(c)).encode()) for c in batch.column("codes").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tables, pa.binary())], [*batch.schema.names, "solved"])


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks by conversation and number -> one row per conversation."""

    def row(key, chunks):
        illegal, cost, audit = chain([(c, t and json.loads(zlib.decompress(t))) for c, t in chunks])
        return key, illegal, cost, audit

    def packed(rows):
        keys, *rest = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(keys, kind), *(pa.array(c, t) for c, t in zip(rest, (pa.int64(), pa.int64(), pa.string()), strict=True))], ["conv_id", "illegal", "cost", "audit"])

    key, chunks, out, kind = None, [], [], None
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for conv, codes, solved in zip(batch.column("conv_id").to_pylist(), batch.column("codes").to_pylist(), batch.column("solved").to_pylist(), strict=True):
            if chunks and conv != key:
                out.append(row(key, chunks))
                chunks = []
            key = conv
            chunks.append((codes, solved))
        if len(out) >= 1000:
            yield packed(out)
            out = []
    if chunks:
        out.append(row(key, chunks))
    if out:
        yield packed(out)


class _Repaired:
    """Hash of one conversation's repaired turns, fed row by row."""

    def __init__(self, audit: str):
        self.edits, self.at, self.state, self.n, self.hash = audit, 0, 0, 0, hashlib.sha256()

    def _turn(self, role: str | None, text: str) -> None:
        """A turn of this role, or of the next one."""
        self.state = NEXT[self.state] if role is None or role[:1] != "s" else 1
        role = ("user", "assistant")[self.state - 2] if role is None else role
        self.hash.update(("\n" if self.n else "").encode() + f"{role}:{text}".encode())
        self.n += 1

    def inserted(self) -> None:
        while self.edits[self.at : self.at + 1] == "I":
            self.at += 1
            self._turn(None, "")

    def row(self, role: str, text: str) -> None:
        self.inserted()
        edit = self.edits[self.at]
        self.at += 1
        if edit != "D":
            self._turn(role if edit == "K" else None, text)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's audit (the row without a text), then its turns in order -> conv_id and the hash."""
    now, key, out, kind = None, None, [], None

    def done():
        now.inserted()
        out.append((key, now.hash.hexdigest(), now.n))

    def packed():
        keys, sums, n = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(sums, pa.string()), pa.array(n, pa.int64())], ["conv_id", "repaired_sha256", "n_repaired"])

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for conv, role, text, audit in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "audit")), strict=True):
            if audit is not None:
                if now:
                    done()
                now, key = _Repaired(audit), conv
            else:
                now.row(role, text)
        if len(out) >= 1000:
            yield packed()
            out.clear()
    if now:
        done()
    if out:
        yield packed()


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that a turn's checksum picks."""
    blank = F.lit(" ")
    key = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)).cast("binary")) % 20
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    hit = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), key.alias("_hit")).where("_hit <> 0")
    twice = F.when(F.col("_hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return hit.select(
        "conv_id", "turn", F.when(F.col("_hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_hit") == 1, "").when(F.col("_hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"), F.explode(twice).alias("_copy"),
    ).drop("_copy")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text): the faults, and the cheapest repair with its audit.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 and n_repaired (turns after the repair). Turns are taken
    in the order of turn (nulls first), role, text, so repeated rows and ties
    have a fixed order. A null text or role is one space, rows without a
    conversation are one of their own, a role other than system, user and
    assistant has to be changed or deleted. A conversation without rows gets
    zeros and an empty audit. Other columns are ignored; an empty table gives
    no rows.
    """
    keys = ["conv_id", "turn", "role", "text"]
    # the written order: `at` grows along a conversation, over all ranges that hold it
    turns = staged(rows.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()), "turns")
    bare = F.rtrim("text", F.lit(SPACES))
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    slim = turns.select(
        "conv_id", "turn", "at", F.substring("role", 1, 1).alias("initial"), (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"),
        F.unhex(F.sha2(F.concat_ws(":", F.length(conv), F.length("role"), conv, "role", "text"), 256)).alias("same"),
    )
    firsts = slim.where("NOT blank").groupBy("same").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("same", "first")
    judged = slim.join(firsts, "same", "left").select(
        "conv_id", "turn", "at", "initial", "blank", (~F.col("blank") & F.coalesce(F.col("first") < F.col("at"), F.lit(False))).alias("duplicate"), "cut"
    )
    kind = F.when(F.col("initial") == "s", 1).when(F.col("initial") == "u", 2).when(F.col("initial") == "a", 3).otherwise(4)
    gone = F.col("blank") | F.col("duplicate")
    fates = F.when(gone, F.lit(GONE)).when(F.col("cut"), F.lit(CUT)).otherwise(F.lit(SOUND))
    judged = staged(judged.select("conv_id", "turn", "at", "blank", "duplicate", (F.col("cut") & ~gone).alias("truncated"), F.substr(fates, kind, F.lit(1)).alias("code")), "turns-judged")
    count = [F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated")]
    counts = judged.groupBy("conv_id", "turn").agg(*count).groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")], F.min("turn").alias("_lo"), F.max("turn").alias("_hi"), F.count("turn").alias("_n"))
    gaps = F.coalesce((F.col("_hi").cast("decimal(38,0)") - F.col("_lo").cast("decimal(38,0)") + 1 - F.col("_n")).try_cast("long"), F.lit(0).cast("long"))
    counts = counts.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated")
    # at most 2 ** CHUNK_BITS rows to a group, however long the conversation
    chunk = judged.groupBy("conv_id", F.shiftright("at", CHUNK_BITS).alias("chunk")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "code"))), lambda x: x["code"]), "").alias("codes"))
    id_type = rows.schema["conv_id"].dataType.simpleString()
    solved = chunk.mapInArrow(_solved, f"conv_id {id_type}, chunk long, codes string, solved binary")
    audits = staged(
        solved.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(_chained, f"conv_id {id_type}, illegal long, cost long, audit string"), "audits"
    )
    null = F.lit(None).cast("string")
    stream = audits.select("conv_id", F.lit(-1).cast("long").alias("at"), null.alias("role"), null.alias("text"), "audit").union(turns.select("conv_id", "at", "role", "text", null))
    hashed = stream.repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(_hashed, f"conv_id {id_type}, repaired_sha256 string, n_repaired long")
    facts = audits.join(counts, audits["conv_id"].eqNullSafe(counts["conv_id"])).drop(counts["conv_id"])
    return facts.join(hashed, facts["conv_id"].eqNullSafe(hashed["conv_id"])).select(
        facts["conv_id"], "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256", "n_repaired"
    )


def damage_and_repair(rows: DataFrame) -> DataFrame:
    """The conversations of ``rows`` after the damage, repaired (see ``repair``); every original conv_id has a row."""
    found = repair(damaged(rows)).withColumnRenamed("conv_id", "_id")
    every = rows.select("conv_id").distinct()
    out = every.join(found, F.col("conv_id").eqNullSafe(F.col("_id")), "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))


def _least(*options: str) -> str:
    return f"list_sort(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))[1]"


def _then(x: str, cost: str, edit: str, turn: str | None = None, when: str = "TRUE") -> str:
    turns = f"{x}.r" if turn is None else f"list_append({x}.r, {turn})"
    return f"CASE WHEN {x} IS NOT NULL AND ({when}) THEN {{'c': {x}.c + {cost}, 'a': {x}.a || '{edit}', 'r': {turns}}} END"


def _steps() -> list[str]:
    """DuckDB: the four states after a row, from the states m0..m3 with turns inserted before it."""
    kept = "3 * CAST(cut AS BIGINT)"
    turn = "role || ':' || text"

    def keep(m: str, initial: str) -> str:
        return _then(m, kept, "K", turn, f"i = '{initial}' AND NOT gone")

    def change(m: str, role: str) -> str:
        return _then(m, f"3 + {kept}", "R", f"'{role}:' || text", "NOT gone")

    delete = [_then(f"m{s}", "4", "D") for s in range(4)]
    user = [f(f"m{s}", r) for s in (0, 1, 3) for f, r in ((keep, "u"), (change, "user"))]
    return [_least(delete[0]), _least(delete[1], keep("m0", "s")), _least(delete[2], *user), _least(delete[3], keep("m2", "a"), change("m2", "assistant"))]


_STATE = "STRUCT(c BIGINT, a VARCHAR, r VARCHAR[])"
_IN_USER, _IN_ASSISTANT = (f"'{r}:'" for r in ("user", "assistant"))
_N0, _N1, _N2, _N3 = _steps()

#: DuckDB: the same, with whole edit strings in place of nodes; the checksum's table is built by its rule.
SQL = rf"""
WITH RECURSIVE tbl AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM (SELECT unnest(range(256)) AS i))
), src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS h FROM conversations
), summed AS (
  SELECT *, xor(list_reduce([4294967295] || list_transform(range(0, length(h) // 2), lambda p: CAST(('0x' || h[2 * p + 1 : 2 * p + 2]) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) % 20 AS hit FROM src, tbl
), damaged AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role, CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN hit = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM summed WHERE hit <> 0
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS rn, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare FROM damaged
), seen AS (
  SELECT *, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 AS dup, left(role, 1) AS i FROM ordered
), judged AS (
  SELECT *, blank OR dup AS gone, NOT blank AND NOT dup AND right(bare, 1) NOT IN ('.', '!', '?') AS cut, lag(i) OVER (PARTITION BY conv_id ORDER BY rn) || i AS pair FROM seen
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate,
    count(*) FILTER (cut) AS truncated, count(*) FILTER (rn > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n_rows
  FROM judged GROUP BY conv_id
), walk(conv_id, rn, b0, b1, b2, b3) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), CAST({{'c': 0, 'a': '', 'r': []}} AS {_STATE}), CAST(NULL AS {_STATE}), CAST(NULL AS {_STATE}), CAST(NULL AS {_STATE}) FROM judged
  UNION ALL
  SELECT conv_id, rn, {_N0}, {_N1}, {_N2}, {_N3}
  FROM (SELECT *, {_least("b3", _then("m2", "3", "I", _IN_ASSISTANT))} AS m3
    FROM (SELECT j.conv_id, j.rn, j.i, j.cut, j.gone, j.role, j.text, b0 AS m0, b1 AS m1, b3,
      {_least("b2", *(_then(f"b{s}", "3", "I", _IN_USER) for s in (0, 1, 3)))} AS m2
      FROM walk JOIN judged j ON j.conv_id IS NOT DISTINCT FROM walk.conv_id AND j.rn = walk.rn + 1))
), ended AS (
  SELECT w.conv_id, {_least("b0", _then("e1", "3", "I", _IN_ASSISTANT), _then("b2", "3", "I", _IN_ASSISTANT), "b3")} AS best
  FROM (SELECT *, {_then("b1", "3", "I", _IN_USER)} AS e1 FROM walk) w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n_rows = w.rn
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
