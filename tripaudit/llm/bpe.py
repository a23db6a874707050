"""Byte-level BPE by backtracking, and decoding by an offset table (operator 10).

The longest token at each place comes from an Aho-Corasick automaton. A
sequence of tokens is the merge result exactly if every adjacent pair is
compatible, i.e. if encoding the two tokens' bytes gives the pair again; the
encoder falls back to shorter tokens, and drops the last one where none fits.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import remembered

#: The pattern that splits text before the merges (fixed by the vocabulary's pre-tokeniser).
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: The same over characters for which the standard library's classes are known to agree, which is faster; the rest goes by PATTERN.
LETTERS = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-ɏ"
OTHER = re.compile(rf"[^\t\n\r\x20-\x7e{LETTERS}–—‘-‟…]")
PLAIN = re.compile(rf" ?[{LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\s0-9{LETTERS}]+|\s+(?!\S)|\s+")
#: Entries of each of a worker's memories; those that were not asked for since it last filled up go.
MEMORY = 200_000
#: The same where texts are only encoded: there a worker shares its executor's memory with what the stages before left.
ENCODE_MEMORY = 65_536


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Tables of a byte-level BPE file: ranks (bytes first, then merges in order), splits, offsets; memories of so many entries."""

    def __init__(self, path: str, memory: int | None = None):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = byte_chars()
        to_byte = {c: b for b, c in enumerate(chars)}
        ids = spec["model"]["vocab"]
        text_of = [c for c in chars]
        rank_of = {c: b for b, c in enumerate(chars)}
        self.left, self.right = list(range(256)), list(range(256))
        self.joined: dict[tuple[int, int], int] = {}
        for pair in spec["model"]["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            if a + b in rank_of:
                raise ValueError(f"two merges give {a + b!r}")
            rank = len(text_of)
            rank_of[a + b] = rank
            text_of.append(a + b)
            self.left.append(rank_of[a])
            self.right.append(rank_of[b])
            self.joined[rank_of[a], rank_of[b]] = rank
        self.raw = [bytes(to_byte[c] for c in t) for t in text_of]
        self.id_of = [ids[t] for t in text_of]
        self.size = [len(t) for t in self.raw]
        self.most = max(self.size)
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        self.special_at = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        by_bytes = {t: r for r, t in enumerate(self.raw)}
        self.shorter = [next((by_bytes[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in by_bytes), -1) for t in self.raw]
        self.automaton = ahocorasick.Automaton()
        for r, t in enumerate(self.raw):
            self.automaton.add_word(t.decode("latin-1"), r)
        self.automaton.make_automaton()
        memory = memory or MEMORY
        self.fits = Memory(lambda pair: self.compatible(pair >> 32, pair & 0xFFFFFFFF), memory)
        self.longest = Memory(lambda text: next(self.automaton.iter_long(text))[1], memory)
        self.pieces = Memory(lambda text: packed(self.piece(text)), memory)
        self.native = Memory(lambda text: native(self.piece(text)), memory)
        # the decoder's table: all tokens' bytes in id order, and where each starts
        raw_of = {i: t for i, t in zip(self.id_of, self.raw, strict=True)} | {i: t.encode() for t, i in self.special.items()}
        sizes = np.array([len(raw_of.get(i, b"")) for i in range(max(raw_of, default=-1) + 1)], np.int64)
        self.offsets = np.r_[0, np.cumsum(sizes)].astype(np.int64)
        self.blob = np.frombuffer(b"".join(raw_of.get(i, b"") for i in range(len(sizes))), np.uint8)

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b together ends with the border between them kept."""
        before = len(self.raw)
        while True:
            if (new := self.joined.get((a, b))) is not None and new < before:
                return False
            if a < 256 and b < 256:
                return True
            # undo the later of the two merges: across the border, its parts were there first
            if a > b:
                before, a = a, self.right[a]
            else:
                before, b = b + 1, self.left[b]

    def piece(self, text: str) -> list[int]:
        """Ids of one piece of the pattern."""
        text = text.encode().decode("latin-1")
        size, longest, fits, whole = self.size, self.longest, self.fits, len(text)
        out: list[int] = []
        closed: set[int] = set()
        at, token, last = 0, longest[text], -1
        while True:
            end = at + size[token]
            if end not in closed and (last < 0 or fits[last << 32 | token]):
                out.append(token)
                if end == whole:
                    return list(map(self.id_of.__getitem__, out))
                at, last = end, token
                token = longest[text[at : at + self.most]]
            elif self.shorter[token] >= 0:
                token = self.shorter[token]
            else:  # no token fits here: take the last one back and never end there again
                closed.add(at)
                token = out.pop()
                at -= size[token]
                last = out[-1] if out else -1

    def plain(self, text: str, known: Memory) -> list:
        """The encoded pieces of a text without special tokens."""
        return list(map(known.__getitem__, (PATTERN if OTHER.search(text) else PLAIN).findall(text)))

    def found(self, text: str, known: Memory, pack) -> list:
        """The encoded pieces and special tokens of a text."""
        found, at = [], 0
        for m in self.special_at.finditer(text) if self.special_at is not None else ():
            found += self.plain(text[at : m.start()], known)
            found.append(pack([self.special[m[0]]]))
            at = m.end()
        return found + self.plain(text[at:] if at else text, known)

    def encode(self, text: str) -> tuple[bytes, bytes]:
        """Ids as native int32 bytes and as decimal text joined by commas."""
        found = self.found(text, self.pieces, packed)
        return b"".join([x for x, _ in found]), b",".join([y for _, y in found])

    def encode_native(self, text: str) -> bytes:
        """Ids as native int32 bytes."""
        return b"".join(self.found(text, self.native, native))

    def decode(self, ids: np.ndarray) -> bytes:
        start = self.offsets[ids]
        size = self.offsets[ids + 1] - start
        end = np.cumsum(size)
        if not len(end):
            return b""
        return self.blob[np.repeat(start - (end - size), size) + np.arange(end[-1])].tobytes()


def native(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


def packed(ids: list[int]) -> tuple[bytes, bytes]:
    return native(ids), ",".join(map(str, ids)).encode()


class Memory(dict):
    """Answers that were given before, the newest ``most`` to 2 * ``most`` of them; long questions are not kept."""

    def __init__(self, answer, most: int):
        super().__init__()
        self.answer, self.most, self.older = answer, most, {}

    def __missing__(self, key):
        if (new := self.older.get(key)) is None:
            new = self.answer(key)
            if isinstance(key, str) and len(key) > 64:
                return new
        if len(self) >= self.most:
            self.older = self.copy()
            self.clear()
        self[key] = new
        return new


@remembered
def vocabulary(path: str, memory: int | None = None) -> Vocabulary:
    return Vocabulary(path, memory)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return ["" if t is None else t for t in batch.column(column).to_pylist()]


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row's whole text.

    A null text is empty: no ids, digests of the empty string. Equal rows give
    equal rows; other columns are ignored; empty input gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in texts(batch):
                raw, decimal = v.encode(text)
                ids = np.frombuffer(raw, np.int32)
                whole = v.decode(ids).decode("utf-8", "replace")
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(decimal).hexdigest())
                text_sha.append(hashlib.sha256(whole.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def bpe_encode(docs: DataFrame, path: str) -> DataFrame:
    """Adds ``ids`` (array of int) to every row; a null text has no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path, ENCODE_MEMORY)
        for batch in batches:
            ids = [np.frombuffer(v.encode_native(t), np.int32) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32()))], [*batch.schema.names, "ids"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, ids array<int>")
