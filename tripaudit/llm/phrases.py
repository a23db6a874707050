"""Phrase collocations of each language by partitioned mining (operator 13).

The texts are read in shards, runs of documents that fit in a task. With a
global support of S over N words, a shard of N_p words mines every phrase that
occurs at least ceil(S * N_p / N) times in it: a phrase with S occurrences
reaches that in one shard or more, so the union of what the shards found holds
every frequent phrase. A second pass counts the union exactly. Lengths are
mined one after the other, and a shard leaves out what contains a phrase that
the length before found infrequent everywhere.

With many shards the local support falls to 1; a shard then withholds
nothing, its counts are whole, and the second pass is not needed. (A support
that does not grow with the corpus gives every corpus of more than S shards a
local support of 1; what bounds the work there is the filter of the length
before.)

Counts travel in blobs: a shard sends one row for each language and bucket of
phrase hashes, all of its phrases there one after the other. The JVM only deals
the blobs out and sorts them by bucket; a worker adds up one bucket at a time,
and buckets are as many as keep that small at any size of input.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_models, staged

#: A shard ends once it holds so many bytes of text.
SHARD_BYTES = 2 << 20
#: Texts are cut into words, and phrases sent on, in parts of this size.
PART_BYTES, PART_ROWS = 1 << 20, 1 << 16
#: The corpus's words for each bucket of phrases, at most; counts of a bucket are merged after so many rows.
BUCKET_WORDS, MERGE_ROWS = 1 << 20, 1 << 19
#: Bits of the filter of known phrases that every task gets: 8 MB at any size of input.
FILTER_BITS = 1 << 26
BLOCK_BITS = 1 << 15
_SHIFT = np.uint64(65 - FILTER_BITS.bit_length())
UNKNOWN = "und"
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))
_TABLE = bytes.maketrans(_UPPER + _BREAKS + b"\t", _UPPER.lower() + b"\n" * len(_BREAKS) + b" ")
BLOBS = "bucket long, lang string, phrases binary, lengths binary, counts binary"
ROWS = "lang string, phrase string, f long"


def word_ids(texts: list[bytes]) -> tuple[np.ndarray, pa.BinaryArray]:
    """Word numbers of all texts in a row, -1 where a piece ends, and the words by number."""
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)  # a method of its own would keep it until a full collection of garbage
    end, blank = numbers[b"\n"], numbers[b""]
    found, start, held = [], 0, 0
    for k, text in enumerate(texts, 1):
        held += len(text)
        if held < PART_BYTES and k < len(texts):
            continue
        tokens = (b"\n".join(texts[start:k]) + b"\n").translate(_TABLE).replace(b"\n", b" \n ").split(b" ")
        ids = np.fromiter(map(numbers.__getitem__, tokens), np.int32, len(tokens))
        found.append(ids[ids != blank])
        start, held = k, 0
    ids = np.concatenate(found) - 2
    ids[ids == end - 2] = -1
    return ids, pa.array(list(numbers)[2:], pa.binary())


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def phrase_hashes(parts: list[np.ndarray]) -> np.ndarray:
    """Of phrases, from the hashes of their first words, of their second words and so on."""
    h = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        h = (h ^ part) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


class Known:
    """A filter of fixed size: every phrase put in is in it, a few others may be."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @classmethod
    def of(cls, phrases: DataFrame) -> Known:
        """From (lang, phrase) rows. Tasks make the blocks of bits; the driver gets the blocks, 8 MB at most."""

        def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lang, phrase = batch.column("lang").to_pylist(), batch.column("phrase").cast(pa.binary()).to_pylist()
                bits = [phrase_hashes([word_hashes(g, [w]) for w in p.split(b" ")]) for g, p in zip(lang, phrase, strict=True)]
                if bits:
                    yield pa.RecordBatch.from_arrays([pa.array((np.concatenate(bits) >> _SHIFT).astype(np.int64))], ["bit"])

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[int, np.ndarray] = {}
            for batch in batches:
                bits = batch.column("bit").to_numpy()
                for b in np.unique(bits // BLOCK_BITS):
                    block = found.setdefault(int(b), np.zeros(BLOCK_BITS // 8, np.uint8))
                    at = bits[bits // BLOCK_BITS == b] % BLOCK_BITS
                    np.bitwise_or.at(block, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([x.tobytes() for x in found.values()], pa.binary())], ["block", "bits"])

        dealt = phrases.select("lang", "phrase").mapInArrow(hashed, "bit long").distinct().repartition(F.floor(F.col("bit") / BLOCK_BITS))
        bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for row in dealt.mapInArrow(blocks, "block long, bits binary").toLocalIterator():
            at = row["block"] * BLOCK_BITS // 8
            bits[at : at + BLOCK_BITS // 8] |= np.frombuffer(row["bits"], np.uint8)
        return cls(bits)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        bit = (hashes >> _SHIFT).astype(np.int64)
        return (self.bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def phrase_counts(ids: np.ndarray, hashes: np.ndarray, length: int, known: list[Known]) -> tuple[list[np.ndarray], np.ndarray]:
    """Phrases of so many words, as arrays of their first words, second words and so on, and their counts; those left out that hold a shorter one which ``known`` lacks.

    ``hashes`` are those of the words by number. Where ``known`` goes as far
    as ``length``, its last filter is of the phrases themselves.
    """
    grams, counts, start = ids, np.bincount(ids[ids >= 0], minlength=len(hashes)), None
    for k in range(1, length + 1):
        if k > 1:
            pairs = np.flatnonzero((grams[:-1] >= 0) & (grams[1:] >= 0))
            if not len(pairs):
                return [ids[:0]] * length, np.zeros(0, np.int64)
            codes = grams[pairs].astype(np.int64) * len(counts) + grams[pairs + 1]
            if k < length:
                _, first, at, counts = np.unique(codes, return_index=True, return_inverse=True, return_counts=True)
                grams = np.full(len(ids), -1, np.int32)
                grams[pairs] = at
                del at
            else:
                _, first, counts = np.unique(codes, return_index=True, return_counts=True)
            start = pairs[first]
            del codes, pairs, first
        if k <= len(known):
            passed = known[k - 1].has(phrase_hashes([hashes] if k == 1 else [hashes[ids[start + j]] for j in range(k)]))
            if k == length:
                start, counts = start[passed], counts[passed]
            else:
                number = np.full(len(counts) + 1, -1, np.int32)  # the last one is that of -1
                number[:-1][passed] = np.flatnonzero(passed)
                grams = number[grams]
    return [np.arange(len(hashes))] if length == 1 else [ids[start + j] for j in range(length)], counts


def _over_shards(docs: DataFrame, shard: Callable[[dict[str, list[bytes]]], Iterator[pa.RecordBatch]], shard_bytes: int) -> DataFrame:
    """Applies ``shard`` to texts by language, shard by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_models()
        texts: dict[str, list[bytes]] = {}
        held = 0
        for batch in batches:
            body = batch.column("text").cast(pa.binary())
            for lang, text in zip(batch.column("lang"), body, strict=True):
                raw = text.as_py()
                texts.setdefault(lang.as_py(), []).append(raw)
                held += len(raw)
                if held >= shard_bytes:
                    yield from shard(texts)
                    texts, held = {}, 0
        if texts:
            yield from shard(texts)

    return docs.mapInArrow(run, BLOBS)


def _cut(data: pa.Buffer | np.ndarray, edges: np.ndarray) -> pa.BinaryArray:
    """The bytes from each edge to the next, not copied."""
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(data)])


def _bytes_of(column: pa.BinaryArray) -> tuple[pa.Buffer, np.ndarray]:
    """All bytes of a column without nulls, and where its values begin and end in them."""
    _, edges, data = column.buffers()
    return data or pa.py_buffer(b""), np.frombuffer(edges, np.int32)[column.offset :][: len(column) + 1]


def _numbers_of(column: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """All 32-bit numbers that a column's values hold, and where each value's begin and end among them."""
    data, edges = _bytes_of(column)
    return np.frombuffer(data, np.int32, (edges[-1] - edges[0]) // 4, edges[0]), (edges - edges[0]) // 4


def _blobs(lang: str, phrases: list[np.ndarray], counts: np.ndarray, words: pa.BinaryArray, hashes: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Phrases, as ``phrase_counts`` has them, in the order of their buckets: a row for each bucket in a part."""
    bucket = (phrase_hashes([hashes[p] for p in phrases]) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    for at in range(0, len(order), PART_ROWS):
        own = order[at : at + PART_ROWS]
        texts = [words.take(pa.array(p[own])) for p in phrases]
        data, ends = _bytes_of(pc.binary_join_element_wise(*texts, b" ") if len(texts) > 1 else texts[0])
        b = bucket[own]
        edges = np.r_[0, np.flatnonzero(b[1:] != b[:-1]) + 1, len(own)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(b[edges[:-1]]), pa.repeat(lang, len(edges) - 1), _cut(data, ends[edges]), _cut(np.diff(ends).astype(np.int32), 4 * edges), _cut(counts[own].astype(np.int32), 4 * edges)],
            ["bucket", "lang", "phrases", "lengths", "counts"],
        )


def _counted(docs: DataFrame, length: int, filters: list, buckets: int, shard_bytes: int) -> DataFrame:
    """Counts, shard by shard, of the phrases that the filters let pass; with words, a row without a language for each shard's number of words."""

    def shard(texts: dict[str, list[bytes]]) -> Iterator[pa.RecordBatch]:
        known = [f.value for f in filters]
        n = 0
        for lang, own in texts.items():
            ids, words = word_ids(own)
            hashes = word_hashes(lang, words.to_pylist())
            phrases, counts = phrase_counts(ids, hashes, length, known)
            n += int(counts.sum())
            yield from _blobs(lang, phrases, counts, words, hashes, buckets)
        if length == 1:
            row = {"bucket": n % buckets, "lang": None, "phrases": b"", "lengths": b"", "counts": np.int32(n).tobytes()}
            yield pa.RecordBatch.from_pylist([row], pa.schema([("bucket", pa.int64()), ("lang", pa.string()), ("phrases", pa.binary()), ("lengths", pa.binary()), ("counts", pa.binary())]))

    return _over_shards(docs, shard, shard_bytes)


def _mined(docs: DataFrame, length: int, filters: list, support: int, total: int, buckets: int, shard_bytes: int) -> DataFrame:
    """What is frequent within a shard, with its count there; without a support, everything."""

    def shard(texts: dict[str, list[bytes]]) -> Iterator[pa.RecordBatch]:
        known = [f.value for f in filters]
        read = {lang: word_ids(own) for lang, own in texts.items()}
        least = max(1, -(-support * sum(int((ids >= 0).sum()) for ids, _ in read.values()) // total))
        for lang, (ids, words) in read.items():
            hashes = word_hashes(lang, words.to_pylist())
            phrases, counts = phrase_counts(ids, hashes, length, known)
            if least > 1:
                kept = np.flatnonzero(counts >= least)
                phrases, counts = [p[kept] for p in phrases], counts[kept]
            yield from _blobs(lang, phrases, counts, words, hashes, buckets)

    return _over_shards(docs, shard, shard_bytes)


def _summed(blobs: DataFrame, least: int, buckets: int, with_words: bool = False) -> DataFrame:
    """(lang, phrase, f) of the phrases whose counts in all shards add up to ``least``.

    With words, also rows without a phrase: a language's number of words in
    each bucket, and without a language a shard's number of words.
    """
    tasks = int(blobs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def rows(lang: pa.Array, phrase: pa.Array, f: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([lang, phrase, f], ["lang", "phrase", "f"])

    def merged(held: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(held).group_by(["lang", "phrase"], use_threads=False).aggregate([("f", "sum")]).rename_columns({"f_sum": "f"})

    def frequent(held: list[pa.Table], langs: list[str]) -> Iterator[pa.RecordBatch]:
        found, names = merged(held), pa.array(langs, pa.string())
        if with_words:
            n = found.group_by("lang", use_threads=False).aggregate([("f", "sum")]).combine_chunks().to_batches()[0]
            yield rows(names.take(n["lang"]), pa.nulls(n.num_rows, pa.string()), n["f_sum"])
        for part in found.filter(pc.field("f") >= least).combine_chunks().to_batches(PART_ROWS):
            yield rows(names.take(part["lang"]), part["phrase"].cast(pa.string()), part["f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_models()
        number: defaultdict[str, int] = defaultdict(count().__next__)
        held: list[pa.Table] = []
        current, fresh = None, 0
        for batch in batches:
            if with_words and batch.column("lang").null_count:
                shards = batch.filter(pc.is_null(batch.column("lang")))
                n = np.array([np.frombuffer(c, np.int32)[0] for c in shards.column("counts").to_pylist()], np.int64)
                yield rows(pa.nulls(len(n), pa.string()), pa.nulls(len(n), pa.string()), pa.array(n))
                batch = batch.filter(pc.is_valid(batch.column("lang")))
            if not batch.num_rows:
                continue
            bucket, coded = batch.column("bucket").to_numpy(), batch.column("lang").dictionary_encode()
            lang = np.array([number[x] for x in coded.dictionary.to_pylist()], np.int32)[coded.indices.to_numpy()]
            data, ends = _bytes_of(batch.column("phrases"))
            lengths, at = _numbers_of(batch.column("lengths"))
            counts, _ = _numbers_of(batch.column("counts"))
            phrases = _cut(data, ends[0] + np.r_[0, np.cumsum(lengths)])
            table = pa.table({"lang": np.repeat(lang, np.diff(at)), "phrase": phrases, "f": counts.astype(np.int64)})
            edges = np.r_[0, np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(bucket)]
            for begin, end in zip(edges[:-1], edges[1:], strict=True):
                if held and bucket[begin] != current:
                    yield from frequent(held, list(number))
                    held, fresh = [], 0
                current = bucket[begin]
                held.append(table.slice(at[begin], at[end] - at[begin]))
                fresh += held[-1].num_rows
                if fresh >= MERGE_ROWS:
                    held, fresh = [merged(held)], 0
        if held:
            yield from frequent(held, list(number))

    dealt = blobs.repartitionById(tasks, (F.col("bucket") % tasks).cast("int"))
    return (dealt.sortWithinPartitions("bucket") if buckets > tasks else dealt).mapInArrow(run, ROWS)


def frequent_phrases(docs: DataFrame, most_words: int = 3, support: int = 10, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f, k) of every phrase of 1 to ``most_words`` words with f >= ``support``, and (lang, n): all words.

    A null language is ``und``, a null text has no words, a text of any length
    is taken whole, repeated rows all count, other columns are ignored; empty
    input gives empty results.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = staged(_summed(_counted(rows, 1, [], buckets, shard_bytes), support, buckets, with_words=True), "frequent-1")
    # rows without a phrase hold the words of a language, those without a language the words of a shard
    shards, found = words.where("lang IS NULL"), [words.where("phrase IS NOT NULL")]
    n = words.where("lang IS NOT NULL AND phrase IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    total, largest = (x or 0 for x in shards.agg(F.sum("f"), F.max("f")).first())
    withhold = support * largest > total  # some local support is over 1
    buckets *= max(1, -(-total // (buckets * BUCKET_WORDS)))  # the same number for each task
    filters: list = []
    for k in range(2, most_words + 1):
        filters.append(spark.sparkContext.broadcast(Known.of(found[-1])))
        local = _mined(rows, k, filters, support if withhold else 0, max(total, 1), buckets, shard_bytes)
        if withhold:
            union = spark.sparkContext.broadcast(Known.of(staged(_summed(local, 1, buckets), f"phrases-{k}")))
            local = _counted(rows, k, [*filters, union], buckets, shard_bytes)
        found.append(staged(_summed(local, support, buckets), f"frequent-{k}"))
    parts = [f.select("lang", "phrase", "f", F.lit(k).alias("k")) for k, f in enumerate(found, 1)]
    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    return every, n


def _span(words: Column, first: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, first, length), " ")


def collocations(docs: DataFrame, most_words: int = 3, support: int = 10, top: int = 2000, inside: int = 50, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase's score is that of its worst cut, floor(10^6 a^2 / (l r)); cuts
    that tie go to the shortest first part, phrases that tie to the more
    frequent, then to the lesser in bytes. A phrase goes if a longer frequent
    one around it has ``inside`` percent of its occurrences or more. Nulls,
    long texts, repeated rows and empty tables as in ``frequent_phrases``.
    """
    every, n = frequent_phrases(docs, most_words, support, shard_bytes)
    phrases = every.where("k > 1").select("lang", "phrase", F.col("f").alias("a"), "k", F.split("phrase", " ").alias("words"))
    cuts = phrases.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", _span(F.col("words"), F.lit(1), F.col("cut")).alias("first"), _span(F.col("words"), F.col("cut") + 1, F.size("words") - F.col("cut")).alias("rest"))
    first = every.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rest = every.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    wide = "CAST({} AS DECIMAL(19, 0))".format
    score = F.expr(f"(CAST(1000000 * ({wide('a')} * {wide('a')}) AS DECIMAL(38, 0))) div CAST({wide('l')} * {wide('r')} AS DECIMAL(38, 0))")
    worst = (
        cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).select("lang", "phrase", "a", F.struct(score.alias("score"), "cut", "l", "r").alias("at")).groupBy("lang", "phrase", "a").agg(F.min("at").alias("at"))
    )
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("k") - m + 1), lambda i: _span(F.col("words"), i, m))))
    around = phrases.where("k > 2").select("lang", F.col("a").alias("longer"), F.explode(F.array_distinct(inner)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = worst.join(around, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a")))
    scored = kept.select("lang", "phrase", "a", "at.l", "at.r", "at.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language may hold most rows: its best are picked in many parts first
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = scored.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    best = salted.withColumn("_at", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_at") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: DuckDB: the same with the defaults.
SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM d),
spots AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS p FROM w),
grams AS (SELECT lang, k, array_to_string(ws[p : p + k - 1], ' ') AS phrase FROM spots, (VALUES (1), (2), (3)) AS lengths(k) WHERE p + k - 1 <= len(ws)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY lang),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, cut, x.f AS l, y.f AS r, (CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(ws[1 : cut], ' ') JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(ws[cut + 1 : cuts.k], ' ')
), worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
around AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, array_to_string(ws[1 : 2], ' ') AS phrase FROM c WHERE k = 3 UNION ALL SELECT lang, a, array_to_string(ws[2 : 3], ' ') FROM c WHERE k = 3
  ) GROUP BY lang, phrase
), ranked AS (
  SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank
  FROM worst w LEFT JOIN around o ON o.lang = w.lang AND o.phrase = w.phrase WHERE longer IS NULL OR 100 * longer < 50 * a
)
SELECT r.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked r JOIN n ON n.lang = r.lang WHERE rank <= 2000
"""
