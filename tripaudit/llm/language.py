"""Language by compression (operator 7).

Each language has a raw-content zstandard dictionary of its texts, as long as
they fill it. A text is lower-cased and cut into blocks, each is compressed
with every dictionary, and the language with the smallest total wins; a narrow
margin is marked as rejected. A long dictionary helps any text a little, so
each total is calibrated by what its dictionary saves on the other languages'
training texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held_out, remembered

#: The bounded sample: distinct texts for each language, bytes taken from each (at a place that its hash picks), bytes of a dictionary.
TRAIN_DOCS, TRAIN_BYTES, DICT_BYTES = 200, 2048, 112 * 1024
#: Bytes of a block; compression level; margin (share of the smallest size) under which a prediction is marked as rejected; pieces of each language that calibrate the others.
BLOCK, LEVEL, LEAST_MARGIN, CALIBRATE = 4096, 6, 0.005, 20
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


@remembered
def compressors(dictionaries: tuple[bytes, ...]) -> list[zstandard.ZstdCompressor]:
    out = []
    for raw in dictionaries:
        d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False))
    return out


def rates(raw: bytes, dictionaries: tuple[bytes, ...]) -> np.ndarray:
    """Bytes that each dictionary leaves for each byte of a text."""
    blocks = [raw[k : k + BLOCK] for k in range(0, len(raw), BLOCK)]
    return np.array([sum(len(c.compress(b)) for b in blocks) for c in compressors(dictionaries)], np.float64) / len(raw)


class Model(NamedTuple):
    languages: tuple[str, ...]
    dictionaries: tuple[bytes, ...]
    foreign: tuple[float, ...]  # what each dictionary leaves of the other languages' texts


def classify(text: str | None, model: Model) -> tuple[str, float, float, bool]:
    """Language, score, margin, rejected. Ties go to the first language by code point."""
    languages = model.languages
    if text is None or not languages or not _LETTER.search(text):
        return UNKNOWN, 0.0, 0.0, True
    found = rates(text.lower().encode(), model.dictionaries) - np.array(model.foreign) + max(model.foreign)
    best = int(found.argmin())
    score = float(1 / np.exp(-200 * (found - found[best])).sum())
    margin = float((np.partition(found, 1)[1] - found[best]) / max(found[best], 1e-9)) if len(found) > 1 else 1.0
    return languages[best], score, margin, margin < LEAST_MARGIN


def train(docs: DataFrame) -> Model:
    """Dictionaries from a bounded sample of the rows with a language that are not held out.

    For each language the ``TRAIN_DOCS`` distinct texts with the least hashes,
    however many copies there are, so a rare language is learned from all its
    texts. The driver gets that many pieces of ``TRAIN_BYTES`` a language, and
    the tasks a dictionary of ``DICT_BYTES`` at most for each.
    """
    h = F.xxhash64("text")
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("lang", "text", h.alias("h"))
    distinct = usable.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))  # a row for each language
    share = F.lit(3.0 * TRAIN_DOCS) / F.col("n")  # enough by far, whatever the estimate's error
    near = usable.join(F.broadcast(distinct), "lang").where(F.pmod("h", F.lit(1_000_003)) / F.lit(1_000_003.0) < share)
    body = F.lower("text").cast("binary")
    place = F.pmod(F.xxhash64(F.lit(1), "h"), F.greatest(F.length(body) - TRAIN_BYTES + 1, F.lit(1)).cast("long")).cast("int")
    pieces = near.select("lang", "h", F.substring(body, place + 1, F.lit(TRAIN_BYTES)).alias("body")).groupBy("lang", "h").agg(F.min("body").alias("body"))
    order = Window.partitionBy("lang").orderBy("h")
    rows = pieces.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= TRAIN_DOCS).orderBy("lang", "_at").collect()
    languages = tuple(sorted({r["lang"] for r in rows}))
    parts = {k: [bytes(r["body"]) for r in rows if r["lang"] == k and len(r["body"])] for k in languages}
    languages = tuple(k for k in languages if parts[k])
    dictionaries = tuple(b"".join(parts[k])[:DICT_BYTES] for k in languages)
    probes = [[rates(p, dictionaries) for p in parts[k][-CALIBRATE:]] for k in languages]
    foreign = tuple(float(np.mean([x[i] for j, own in enumerate(probes) if j != i for x in own])) if len(languages) > 1 else 0.0 for i in range(len(languages)))
    return Model(languages, dictionaries, foreign)


def languages_of(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, margin, rejected for every document.

    A null text, one without a letter, or no training rows give ``und`` with
    score 0. Repeated rows are judged alike; other columns are ignored.
    """
    model = train(docs.select("doc_id", "text", "lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [classify(t.as_py(), model) for t in batch.column("text")]
            cols = list(zip(*found, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.float64(), pa.float64(), pa.bool_()), strict=True))], ["doc_id", "lang_pred", "score", "margin", "rejected"])

    out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, margin double, rejected boolean")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "margin", "rejected")
