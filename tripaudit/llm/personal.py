"""Personal data by patterns, and by the contexts that known data stand in (operator 11).

Base: e-mail and network addresses, card and telephone numbers by their
patterns and checks. They seed a bootstrap: the words around a seed are a
lexical pattern, and what else stands in such a pattern and looks like a near
miss of a kind (a number that fails a check, a telephone number without its
plus, an address without a domain's dot) is an instance. Patterns and
instances form a bipartite graph. A pattern's confidence in a kind is the
share of its instances' scores, an instance's score is the chance that not all
its confident patterns err, and the rounds go on until nothing changes.
Instances with a high score are spans of their kind, wherever they stand.

Everything is built-in functions: matches and the text between them come as
two arrays of one pattern, whose lengths give the places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

KINDS = ("email", "ip", "card", "phone")
#: The same matches as the plain forms; possessive and tied to the start of a run, so that no run is read twice or by recursion.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # near misses of any kind
    "": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+|\(?[0-9](?:[\x20().-]{0,2}+[0-9]){6,}+",
}
#: The plain forms.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*|\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,}",
}
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: Characters on either side in which the words of a context are sought.
REACH = 96
_WORD = r"\p{L}[\p{L}'-]*"
_TWO_BEFORE = rf"({_WORD})[^\p{{L}}\p{{N}}\n]{{1,3}}({_WORD})[^\p{{L}}\p{{N}}\n]{{1,3}}\z"
_AFTER = rf"\A[^\p{{L}}\p{{N}}\n]{{1,3}}({_WORD})"
#: Scores and confidences are whole millionths, so that sums don't depend on their order.
UNIT = 1_000_000
#: Accepted instances that a pattern needs, the confidence from which it counts, the score from which an instance is accepted, most rounds.
SUPPORT, CONFIDENT, ACCEPTED, ROUNDS = 4, 700_000, 900_000, 8


def _match(kind: str):
    def match(x: Column, i: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.length(x["left"]).cast("long").alias("gap"), F.length(x["value"]).cast("long").alias("size"), x["value"].alias("value"),
            F.right(x["left"], F.lit(REACH)).alias("before"), F.left(x["right"], F.lit(REACH)).alias("after"),
        )

    return match


def _hits(docs: DataFrame) -> DataFrame:
    """(id, doc_id, hits): every match with the length of the text between it and the one before, and what stands around it."""
    digit = F.regexp_like("text", F.lit("[0-9]"))
    signs = {"email": F.contains("text", F.lit("@")), "phone": F.contains("text", F.lit("+")), "": digit | F.contains("text", F.lit("@"))}
    found = docs.select("*", *[F.when(signs.get(kind, digit), F.regexp_extract_all("text", F.lit(p), F.lit(0))).alias(f"_m{n}") for n, (kind, p) in enumerate(PATTERNS.items())])
    split = found.select("*", *[F.when(F.size(f"_m{n}") > 0, F.split("text", p, -1)).alias(f"_p{n}") for n, p in enumerate(PATTERNS.values())])
    none = F.array().cast("array<struct<kind:string,i:int,gap:bigint,size:bigint,value:string,before:string,after:string>>")
    lists = []
    for n, kind in enumerate(PATTERNS):
        size = F.size(f"_m{n}")
        zipped = F.arrays_zip(F.col(f"_m{n}").alias("value"), F.slice(f"_p{n}", F.lit(1), size).alias("left"), F.slice(f"_p{n}", F.lit(2), size).alias("right"))
        lists.append(F.coalesce(F.when(size > 0, F.transform(zipped, _match(kind))), none))
    return split.select("id", "doc_id", F.concat(*lists).alias("hits"))


def _valid(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", F.regexp_like(value, F.lit(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")))
        .when(kind == "card", F.when(n.between(12, 19), F.call_function("luhn_check", digits)).otherwise(False))
        .when(kind == "phone", n.between(9, 15))
        .otherwise(False)
    )


def _like(value: Column) -> Column:
    """The kinds that a near miss may be."""
    n = F.length(F.regexp_replace(value, "[^0-9]", ""))
    at = F.contains(value, F.lit("@"))
    dotted = F.regexp_like(value, F.lit(r"^[0-9]+(?:\.[0-9]+){3}$"))
    plain = F.regexp_like(value, F.lit(r"^[0-9](?:[\x20.-]?[0-9])*+$"))
    kinds = F.array(F.when(at, F.lit("email")), F.when(dotted, F.lit("ip")), F.when(~at & ~dotted & plain & n.between(12, 19), F.lit("card")), F.when(~at & ~dotted & n.between(7, 15), F.lit("phone")))
    return F.array_compact(kinds)


def _contexts(before: Column, after: Column) -> Column:
    """Lexical patterns of a place: the two words before it; the word before and the word after it."""
    low, high = F.lower(before), F.lower(after)
    w2, w1, w3 = F.regexp_extract(low, _TWO_BEFORE, 1), F.regexp_extract(low, _TWO_BEFORE, 2), F.regexp_extract(high, _AFTER, 1)
    return F.array_compact(F.array(F.when(w2 != "", F.concat_ws(" ", w2, w1, F.lit("_"))), F.when((w1 != "") & (w3 != ""), F.concat_ws(" ", w1, F.lit("_"), w3))))


def _places(hits: DataFrame) -> DataFrame:
    """The base spans, and the near misses that no base span overlaps: (id, kind, start, end, base, value, like, contexts)."""
    flat = hits.select("id", F.inline("hits"))
    earlier = Window.partitionBy("id", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(earlier)
    spans = flat.select("id", "kind", (end - F.col("size")).alias("start"), end.alias("end"), _valid(F.col("kind"), F.col("value")).alias("base"), "value", "before", "after")
    # a near miss may stand there as a failed match too: one row for a place
    spans = spans.groupBy("id", "start", "end", F.when(F.col("base"), F.col("kind")).otherwise("").alias("kind"), "base").agg(*[F.min(c).alias(c) for c in ("value", "before", "after")])
    onward = Window.partitionBy("id").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    backward = Window.partitionBy("id").orderBy(F.desc("start"), F.desc("end"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max(F.when(F.col("base"), F.col("end"))).over(onward)
    ahead = F.min(F.when(F.col("base"), F.col("start"))).over(backward)
    free = F.coalesce(reached <= F.col("start"), F.lit(True)) & F.coalesce(ahead >= F.col("end"), F.lit(True))
    kept = spans.withColumn("_free", free).where(F.col("base") | F.col("_free"))
    like = F.when(F.col("base"), F.array("kind")).otherwise(_like(F.col("value")))
    plain = F.when(F.contains("value", F.lit("@")), F.lower("value")).when(F.regexp_like("value", F.lit(r"^[0-9]+(?:\.[0-9]+){3}$")), F.col("value")).otherwise(F.regexp_replace("value", "[^0-9]", ""))
    return kept.select("id", "kind", "start", "end", "base", plain.alias("value"), like.alias("like"), _contexts(F.col("before"), F.col("after")).alias("contexts")).where(F.size("like") > 0)


def _discovered(places: DataFrame) -> DataFrame:
    """(value, kind) of the near misses that confident patterns accept."""
    spark = places.sparkSession
    edges = staged(places.select(F.explode("contexts").alias("pattern"), "value", F.explode("like").alias("kind"), "base").distinct(), "pattern-edges")
    whole = edges.groupBy("pattern").agg(F.count_distinct("value").alias("n"))
    known = edges.where("base").select("value").distinct()
    open_edges = staged(edges.where("NOT base").join(known, "value", "left_anti").select("pattern", "value", "kind"), "pattern-open")
    seeds = edges.where("base").groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("seeds"))
    # a pattern speaks for something only where something open stands in it
    stats = staged(open_edges.select("pattern", "kind").distinct().join(seeds, ["pattern", "kind"], "left").join(whole, "pattern").select("pattern", "kind", F.coalesce("seeds", F.lit(0)).alias("seeds"), "n"), "pattern-stats")
    scores = spark.createDataFrame([], "value string, kind string, score long")
    sign = None
    for _ in range(ROUNDS):
        own = open_edges.join(scores, ["value", "kind"]).groupBy("pattern", "kind").agg(F.sum("score").alias("own"), F.count_if(F.col("score") >= ACCEPTED).alias("accepted"))
        summed = stats.join(own, ["pattern", "kind"], "left").select("pattern", "kind", "seeds", "n", F.coalesce("own", F.lit(0)).alias("own"), F.coalesce("accepted", F.lit(0)).alias("accepted"))
        confidence = F.floor((F.col("seeds") * UNIT + F.col("own")) / (F.col("n") + 1))
        firm = summed.where(F.col("seeds") + F.col("accepted") >= SUPPORT).select("pattern", "kind", confidence.alias("confidence")).where(F.col("confidence") >= CONFIDENT)
        doubt = F.round(-F.log(1 - F.least(F.col("confidence"), F.lit(UNIT - 1)) / UNIT) * UNIT).cast("long")
        score = (F.lit(UNIT) - F.ceil(F.exp(-F.sum(doubt) / UNIT) * UNIT)).cast("long")
        scores = staged(open_edges.join(firm, ["pattern", "kind"]).groupBy("value", "kind").agg(score.alias("score")), "pattern-scores")
        now = scores.agg(F.count(F.lit(1)), F.sum("score")).first()
        if now == sign or not now[0]:
            break
        sign = now
    rank = F.element_at(F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(-i))]), F.col("kind"))
    best = scores.where(F.col("score") >= ACCEPTED).groupBy("value").agg(F.max_by("kind", F.struct("score", rank)).alias("found"))
    return best


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.get(F.array(*map(F.lit, KINDS)), s["k"]), s["start"], s["end"])), ",")


def personal_spans(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, counts and hash of the base spans, and all spans, found ones included.

    Places count code points, ends are exclusive. A null text is empty; an
    empty one has no spans. Repeated rows get a row each, other columns are
    ignored, an empty table gives no rows. Spans of different kinds may
    overlap. A near miss that may be of several kinds gets the one with the
    highest score, then the first as listed.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("id", F.monotonically_increasing_id())
    hits = staged(_hits(rows), "personal-hits")
    places = staged(_places(hits), "personal-places")
    found = places.where("NOT base").join(_discovered(places), "value").select("id", F.col("found").alias("kind"), "start", "end", "base")
    spans = places.where("base").select("id", "kind", "start", "end", "base").union(found)
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    spans = spans.select("id", "kind", "base", F.struct("start", order.alias("k"), "end").alias("at"))
    counts = [F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS]
    by_doc = spans.groupBy("id").agg(*counts, F.collect_list(F.when(F.col("base"), F.col("at"))).alias("own"), F.collect_list("at").alias("every"))
    out = hits.select("id", "doc_id").join(by_doc, "id", "left")
    zero = [F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS]
    base = F.coalesce(_listed(F.col("own")), F.lit(""))
    added = F.coalesce(F.size("every") - F.size("own"), F.lit(0)).cast("long")
    return out.select("doc_id", *zero, F.sha2(base.cast("binary"), 256).alias("base_sha256"), F.coalesce(_listed(F.col("every")), F.lit("")).alias("spans"), added.alias("n_added"))


def _rounds() -> str:
    """DuckDB: the scores round by round; once they stay, they stay."""
    out = ["scores0 AS (SELECT CAST('' AS VARCHAR) AS value, CAST('' AS VARCHAR) AS kind, CAST(0 AS BIGINT) AS score WHERE false)"]
    for n in range(1, ROUNDS + 1):
        out.append(
            f"own{n} AS (SELECT pattern, o.kind, sum(score) AS own, count(*) FILTER (score >= {ACCEPTED}) AS accepted FROM open_edges o JOIN scores{n - 1} s ON s.value = o.value AND s.kind = o.kind GROUP BY ALL),\n"
            f"firm{n} AS (SELECT s.pattern, s.kind, CAST(floor((seeds * {UNIT} + coalesce(own, 0)) / (n + 1)) AS BIGINT) AS confidence FROM stats s LEFT JOIN own{n} o ON o.pattern = s.pattern AND o.kind = s.kind "
            f"WHERE seeds + coalesce(accepted, 0) >= {SUPPORT} AND floor((seeds * {UNIT} + coalesce(own, 0)) / (n + 1)) >= {CONFIDENT}),\n"
            f"scores{n} AS MATERIALIZED (SELECT value, o.kind, {UNIT} - CAST(ceil(exp(-sum(CAST(round(-ln(1 - least(confidence, {UNIT - 1}) / {UNIT}) * {UNIT}) AS BIGINT)) / {UNIT}) * {UNIT}) AS BIGINT) AS score "
            f"FROM open_edges o JOIN firm{n} f ON f.pattern = o.pattern AND f.kind = o.kind GROUP BY ALL)"
        )
    return ",\n".join(out)


def _q(pattern: str) -> str:
    return pattern.replace("'", "''")


_MATCHES = " UNION ALL ".join(
    f"SELECT rid, '{kind}' AS kind, unnest(range(1, len(v) + 1)) AS i, v, p FROM (SELECT rid, regexp_extract_all(text, '{p}') AS v, string_split_regex(text, '{p}') AS p FROM d)" for kind, p in PLAIN.items()
)
_KIND_LIST = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
_DIGIT_SUM = "list_sum(list_transform(range(1, length(digits) + 1), lambda i: CASE WHEN (length(digits) - i) % 2 = 1 THEN (2 * CAST(digits[i] AS INTEGER)) // 10 + (2 * CAST(digits[i] AS INTEGER)) % 10 ELSE CAST(digits[i] AS INTEGER) END))"
_LISTED = f"string_agg({_KIND_LIST}[k] || ':' || s || ':' || e, ',' ORDER BY s, k, e)"

#: DuckDB: the same with the plain patterns, all rounds written out.
SQL = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
m AS (SELECT rid, kind, i, v[i] AS value, p[i] AS lft, p[i + 1] AS rgt FROM ({_MATCHES})),
placed AS (
  SELECT rid, kind, value, right(lft, {REACH}) AS before, left(rgt, {REACH}) AS after, regexp_replace(value, '[^0-9]', '', 'g') AS digits,
    CAST(sum(length(lft) + length(value)) OVER (PARTITION BY rid, kind ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS e
  FROM m
), checked AS (
  SELECT *, e - length(value) AS s, CASE kind WHEN 'email' THEN true WHEN 'ip' THEN regexp_full_match(value, '{_OCTET}(?:\.{_OCTET}){{3}}')
    WHEN 'card' THEN CASE WHEN length(digits) BETWEEN 12 AND 19 THEN {_DIGIT_SUM} % 10 = 0 ELSE false END WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15 ELSE false END AS base
  FROM placed
), spans AS (
  SELECT rid, s, e, CASE WHEN base THEN kind ELSE '' END AS kind, base, min(value) AS value, min(before) AS before, min(after) AS after, min(digits) AS digits FROM checked GROUP BY ALL
), around AS (
  SELECT *, max(CASE WHEN base THEN e END) OVER (PARTITION BY rid ORDER BY s, e, kind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached,
    min(CASE WHEN base THEN s END) OVER (PARTITION BY rid ORDER BY s, e, kind ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ahead,
    contains(value, '@') AS mail, regexp_full_match(value, '[0-9]+(?:\.[0-9]+){{3}}') AS dotted
  FROM spans
), likely AS (
  SELECT rid, s, e, kind, base, CASE WHEN mail THEN lower(value) WHEN dotted THEN value ELSE digits END AS value, lower(before) AS before, lower(after) AS after,
    CASE WHEN base THEN [kind] ELSE list_filter([CASE WHEN mail THEN 'email' END, CASE WHEN dotted THEN 'ip' END,
      CASE WHEN NOT mail AND NOT dotted AND regexp_full_match(value, '[0-9](?:[ .-]?[0-9])*') AND length(digits) BETWEEN 12 AND 19 THEN 'card' END,
      CASE WHEN NOT mail AND NOT dotted AND length(digits) BETWEEN 7 AND 15 THEN 'phone' END], lambda x: x IS NOT NULL) END AS likes
  FROM around WHERE base OR (coalesce(reached <= s, true) AND coalesce(ahead >= e, true))
), worded AS (
  SELECT *, regexp_extract(before, '{_q(_TWO_BEFORE)}', 1) AS w2, regexp_extract(before, '{_q(_TWO_BEFORE)}', 2) AS w1, regexp_extract(after, '{_q(_AFTER)}', 1) AS w3 FROM likely WHERE len(likes) > 0
), places AS MATERIALIZED (
  SELECT rid, s, e, kind, base, value, likes, list_filter([CASE WHEN w2 <> '' THEN w2 || ' ' || w1 || ' _' END, CASE WHEN w1 <> '' AND w3 <> '' THEN w1 || ' _ ' || w3 END], lambda x: x IS NOT NULL) AS contexts FROM worded
), edges AS MATERIALIZED (SELECT DISTINCT pattern, value, unnest(likes) AS kind, base FROM (SELECT unnest(contexts) AS pattern, value, likes, base FROM places)),
whole AS (SELECT pattern, count(DISTINCT value) AS n FROM edges GROUP BY pattern),
open_edges AS MATERIALIZED (SELECT pattern, value, kind FROM edges WHERE NOT base AND value NOT IN (SELECT value FROM edges WHERE base)),
seeded AS (SELECT pattern, kind, count(*) AS seeds FROM edges WHERE base GROUP BY ALL),
stats AS MATERIALIZED (
  SELECT o.pattern, o.kind, coalesce(seeds, 0) AS seeds, n FROM (SELECT DISTINCT pattern, kind FROM open_edges) o JOIN whole w ON w.pattern = o.pattern LEFT JOIN seeded s ON s.pattern = o.pattern AND s.kind = o.kind
), {_rounds()},
best AS (SELECT value, kind AS found FROM scores{ROUNDS} WHERE score >= {ACCEPTED} QUALIFY row_number() OVER (PARTITION BY value ORDER BY score DESC, list_position({_KIND_LIST}, kind)) = 1),
every AS (
  SELECT rid, s, e, list_position({_KIND_LIST}, kind) AS k, true AS base FROM places WHERE base
  UNION ALL SELECT rid, s, e, list_position({_KIND_LIST}, found), false FROM places p JOIN best b ON b.value = p.value WHERE NOT base
), by_doc AS (
  SELECT rid, {", ".join(f"count(*) FILTER (base AND k = {i + 1}) AS n_{k}" for i, k in enumerate(KINDS))}, {_LISTED} FILTER (base) AS own, {_LISTED} AS spans, count(*) FILTER (NOT base) AS n_added FROM every GROUP BY rid
)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in KINDS)}, sha256(coalesce(own, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_added, 0) AS n_added
FROM d LEFT JOIN by_doc USING (rid)
"""
