"""Token-id files with a minimal perfect hash index (operator 9).

A shard is two files: ``*.ids``, raw little-endian ids (16 bits where the
vocabulary allows, else 32), and ``*.index``, arrays that map a document key
to its place. The index places keys by levels of bits: a key belongs to the
first level where no other key shares its bit, and the bit's rank is its slot.
A slot holds the key's fingerprint, its offset and its length, so a lookup
touches a few bits and one slot, and a key that is not in the shard is told.
"""

from __future__ import annotations

import io
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .bpe import LETTERS, OTHER
from .common import remembered, small, staged

#: LETTERS and what they are in lower case.
LOWER = LETTERS + r"\u0250-\u02af\u2c65\u2c66"
#: The vocabulary's own pieces of a lower-cased text whose characters are plain; the same for words on lines of their own.
PIECE = re.compile(rf"'(?:[stmd]|re|ve|ll)|[{LOWER}]+|[0-9]|[^\s0-9{LOWER}]+")
LINES = re.compile(rf"{PIECE.pattern}|\n")
#: Pieces that a worker remembers, and the longest of them; bytes of texts that are encoded together; pieces that are encoded in one call; bits per key and level.
MEMORY, LONGEST, CHUNK, CALL, SPREAD = 800_000, 64, 10 << 20, 2000, 2


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hash(doc_id: np.ndarray, is_null: np.ndarray, copy: np.ndarray) -> np.ndarray:
    """64-bit hash of a key: the id (or none) and the number of earlier rows with that id."""
    return mixed(mixed(doc_id.astype(np.int64).view(np.uint64), 101) ^ mixed(copy.astype(np.uint64), 102) ^ np.where(is_null, np.uint64(0x5851F42D4C957F2D), np.uint64(0)), 103)


def build_index(keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bits by level, and the slot of each key (a permutation of 0 .. n - 1). Keys are distinct hashes."""
    if len(np.unique(keys)) != len(keys):
        raise ValueError("keys are not distinct")
    levels, rest, slot, used = [], np.arange(len(keys)), np.zeros(len(keys), np.int64), 0
    while len(rest):
        m = SPREAD * len(rest) + 1
        at = (mixed(keys[rest], len(levels)) % np.uint64(m)).astype(np.int64)
        alone = np.bincount(at, minlength=m)[at] == 1
        bits = np.zeros(m, bool)
        bits[at[alone]] = True
        slot[rest[alone]] = used + np.cumsum(bits)[at[alone]] - 1
        used += int(alone.sum())
        levels.append(bits)
        rest = rest[~alone]
    return levels, slot


class Index:
    """A shard's index as read from its file."""

    def __init__(self, arrays):
        self.sizes = arrays["sizes"]
        self.levels = np.split(np.unpackbits(arrays["bits"])[: int(self.sizes.sum())].astype(bool), np.cumsum(self.sizes)[:-1]) if len(self.sizes) else []
        self.ranks = [np.cumsum(x) for x in self.levels]
        self.prints, self.offset, self.length = arrays["prints"], arrays["offset"], arrays["length"]
        self.keys = arrays["keys"], arrays["nulls"], arrays["copies"]

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key hash, -1 where the key is not in the shard."""
        out, rest, used = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for k, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = (mixed(keys[rest], k) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[rest[hit]] = used + ranks[at[hit]] - 1
            rest, used = rest[~hit], used + int(ranks[-1])
        known = out >= 0
        wrong = np.zeros(len(keys), bool)
        wrong[known] = self.prints[out[known]] != (mixed(keys[known], 104) >> np.uint64(32)).astype(np.uint32)
        out[wrong] = -1
        return out


def opened(path: str):
    """File system and path of a shared location; ``file:/x`` counts as ``file:///x``."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


class Words:
    """Ids of pieces, as bytes, as the tokenizers library gives them; the latest used MEMORY / 2 to MEMORY are kept.

    ``ends``: the ids that can end a piece, if the vocabulary marks them. The
    memory is two Arrow arrays, the first entry a line end, which has no ids.
    """

    def __init__(self, tokenizer, kind, ends: np.ndarray):
        self.tokenizer, self.kind, self.ends = tokenizer, kind, ends
        self.pieces, self.ids = pa.array(["\n"], pa.string()), pa.array([b""], pa.large_binary())
        self.used, self.now = np.zeros(1, np.int64), 0

    def each(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that are encoded one by one."""
        calls = (self.tokenizer.encode_batch_fast(texts[k : k + CALL], add_special_tokens=False) for k in range(0, len(texts), CALL))
        return [np.array(e.ids, self.kind).tobytes() for call in calls for e in call]

    def learn(self, pieces: pa.Array) -> pa.Array:
        """Encodes what is not known, many pieces in one call with blanks between them."""
        out = []
        for k in range(0, len(pieces), CALL):
            part = pieces[k : k + CALL].to_pylist()
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.int64)
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) == len(part):
                out.append(strings(np.r_[0, cut] * self.kind.itemsize, pa.py_buffer(ids.astype(self.kind).tobytes())))
            else:  # a piece without an end, or with several
                out.append(pa.array(self.each(part), pa.large_binary()))
        return pa.concat_arrays(out)

    def look(self, pieces: pa.Array) -> pa.Array:
        """Ids of distinct pieces; new ones are learned."""
        at = pc.index_in(pieces, value_set=self.pieces)
        new = np.asarray(at.is_null())
        self.now += 1
        self.used[at.drop_null().to_numpy()] = self.now
        if not new.any():
            return self.ids.take(at)
        names = pieces.filter(pa.array(new))
        ids = self.learn(names)
        out = pa.concat_arrays([self.ids, ids]).take(pa.array(np.where(new, len(self.ids) - 1 + np.cumsum(new), np.asarray(at.fill_null(0)))))
        short = pc.less_equal(pc.utf8_length(names), LONGEST)
        self.pieces, self.ids = pa.concat_arrays([self.pieces, names.filter(short)]), pa.concat_arrays([self.ids, ids.filter(short)])
        self.used = np.r_[self.used, np.full(len(self.ids) - len(self.used), self.now)]
        if len(self.ids) > MEMORY:
            keep = np.r_[0, 1 + np.sort(np.argsort(self.used[1:], kind="stable")[-(MEMORY // 2) :])]
            self.pieces, self.ids, self.used = self.pieces.take(pa.array(keep)), self.ids.take(pa.array(keep)), self.used[keep]
        return out


def strings(edges: np.ndarray, data: pa.Buffer | None) -> pa.Array:
    """The byte strings between consecutive edges in ``data``."""
    return pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), data or pa.py_buffer(b"")])


def joined(values: pa.Array, at: pa.Array) -> tuple[np.ndarray, pa.Buffer | None]:
    """Byte strings put one after the other: their edges, their bytes."""
    out = values.take(at)
    return (np.frombuffer(out.buffers()[1], np.int64)[: len(out) + 1] if len(out) else np.zeros(1, np.int64)), out.buffers()[2]


@remembered
def tokenizer_words(path: str) -> Words:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    vocab = t.get_vocab()
    ends = np.zeros(max(vocab.values()) + 1, bool)
    ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
    return Words(t, np.dtype("<u2") if t.get_vocab_size() <= 1 << 16 else np.dtype("<u4"), ends)


def encoded(texts: list[str], words: Words) -> list[bytes]:
    """Ids of each text.

    The vocabulary drops blanks, lower-cases and never joins across the
    pieces of PIECE. So texts are cut at blanks, each distinct word is cut into
    pieces, and each distinct piece is looked up once; the ids are put together
    by position. Words with rarer characters or with what may be special tokens
    go to the library whole.
    """
    if not texts:
        return []
    cut = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
    found = cut.values.dictionary_encode()
    names = found.dictionary.to_pylist()
    rare: list[int] = []
    if unlike("\n".join(names)):
        rare = [k for k, name in enumerate(names) if unlike(name)]
    plain = names
    if rare:
        plain = list(names)
        for k in rare:
            plain[k] = ""
    # each word begins with a line end, which is therefore the first of the distinct pieces
    pieces = pa.array(LINES.findall("\n" + "\n".join(plain).lower()), pa.string()).dictionary_encode()
    edges, data = joined(words.look(pieces.dictionary), pieces.indices)
    begin = np.flatnonzero(np.asarray(pieces.indices) == 0)
    ids = strings(edges[np.r_[begin, len(pieces)]], data)
    if rare:
        place = np.arange(len(names))
        place[rare] = len(names) + np.arange(len(rare))
        ids = pa.concat_arrays([ids, pa.array(words.each([names[k] for k in rare]), pa.large_binary())]).take(pa.array(place))
    edges, data = joined(ids, found.indices)
    data, edges = memoryview(data or b""), edges[np.asarray(cut.offsets)].tolist()
    return [bytes(data[i:j]) for i, j in pairwise(edges)]


def unlike(text: str) -> bool:
    """Whether a text may hold what PIECE and ``lower`` do not treat as the vocabulary does."""
    return OTHER.search(text) is not None or "<|" in text or "\u0130" in text


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together up to CHUNK bytes; a larger one stays alone."""
    kept, size = [], 0
    for batch in batches:
        if kept and size + batch.nbytes > CHUNK:
            yield from pa.Table.from_batches(kept).combine_chunks().to_batches()
            kept, size = [], 0
        kept.append(batch)
        size += batch.nbytes
    if kept:
        yield from pa.Table.from_batches(kept).combine_chunks().to_batches()


def write_token_files(docs: DataFrame, root: str, path: str, end_id: int) -> DataFrame:
    """Writes shards of ascending doc_id under ``root``; returns their table (shard, file, n_docs, n_tokens).

    Every document's ids end with ``end_id``; a null text has that id alone.
    Null ids come first. Rows that share an id are told apart by their number
    among them. Each attempt of a task has file names of its own, and only
    those of finished tasks are in the table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer_words(path)
        end = np.array([end_id], words.kind).tobytes()
        width = words.kind.itemsize
        where, sink, name = None, None, uuid.uuid4().hex
        keys, nulls, lengths = [], [], []
        for batch in grouped(batches):
            if not batch.num_rows:
                continue
            if sink is None:
                where, base = opened(root)
                where.create_dir(base, recursive=True)
                sink = where.open_output_stream(f"{base}/{name}.ids")
            ids = batch.column("doc_id")
            nulls.append(np.asarray(ids.is_null()))
            keys.append(np.asarray(ids.fill_null(0)).astype(np.int64))
            out = [x + end for x in encoded(["" if t is None else t for t in batch.column("text").to_pylist()], words)]
            sink.write(b"".join(out))
            lengths.append(np.fromiter(map(len, out), np.int64, len(out)) // width)
        if sink is None:
            return
        sink.close()
        key, null, length = map(np.concatenate, (keys, nulls, lengths))
        first = np.r_[True, (key[1:] != key[:-1]) | (null[1:] != null[:-1])]
        copies = np.arange(len(key)) - np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
        hashes = key_hash(key, null, copies)
        levels, slot = build_index(hashes)
        at = lambda x: (lambda out: (out.__setitem__(slot, x), out)[1])(np.empty_like(x))
        buffer = io.BytesIO()
        np.savez(
            buffer, sizes=np.array([len(x) for x in levels]), bits=np.packbits(np.concatenate(levels)), prints=at((mixed(hashes, 104) >> np.uint64(32)).astype(np.uint32)),
            offset=at(np.cumsum(length) - length), length=at(length), keys=key, nulls=null, copies=copies,
        )
        with where.open_output_stream(f"{base}/{name}.index") as f:
            f.write(buffer.getvalue())
        yield pa.RecordBatch.from_pydict({"file": pa.array([f"{root}/{name}"]), "n_docs": pa.array([len(key)], pa.int64()), "n_tokens": pa.array([int(length.sum())], pa.int64()), "width": pa.array([width], pa.int32())})

    dealt = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return staged(dealt.mapInArrow(run, "file string, n_docs long, n_tokens long, width int").withColumn("shard", F.spark_partition_id()), "token-shards")


def read_token_files(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, each found through its shard's index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                where, path = opened(row["file"])
                with where.open_input_file(f"{path}.index") as f:
                    index = Index(np.load(io.BytesIO(f.read())))
                kind = np.dtype("<u2") if row["width"] == 2 else np.dtype("<u4")
                key, null, copies = index.keys
                slots = index.slots(key_hash(key, null, copies))
                if (slots < 0).any():
                    raise ValueError(f"{row['file']}: keys are missing from the index")
                offset, length = index.offset[slots], index.length[slots]
                with where.open_input_file(f"{path}.ids") as f:
                    sums = []
                    for o, n in zip(offset.tolist(), length.tolist(), strict=True):
                        f.seek(o * kind.itemsize)
                        ids = np.frombuffer(f.read(n * kind.itemsize), kind)
                        sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(key, pa.int64(), mask=null), "start": pa.array(offset + row["base"], pa.int64()), "n_tokens": pa.array(length, pa.int64()), "ids_crc32": pa.array(sums, pa.int64())})

    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row for each shard
    based = shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))
    n = max(1, shards.count())
    spread = shards.select("shard", "file", "width").join(small(based.select("shard", "base"), n), "shard").repartition(n)
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Writes the files under the shared folder and reads every document back from them."""
    return read_token_files(write_token_files(docs, scratch_path(docs.sparkSession, "tokens"), path, end_id))
