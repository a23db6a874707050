"""Quality scores by Bradley-Terry pairwise ranking (operator 5).

A pair is a good and a bad labelled document, and the good one is preferred.
The model is linear in features of the text; its weights minimise the
logistic loss on the features' differences within pairs. The score puts the
quantile that the bad share of the training documents marks at the threshold.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_models, held_out

#: The bounded sample: labelled documents that are used for training at most (in expectation, dealt by hash), and pairs.
TRAIN_DOCS, TRAIN_PAIRS, THRESHOLD = 6000, 30_000, 0.3
BLOCK = 200
SPACE = " \t\n\v\f\r"
_END = re.compile(r"""[.!?\u2026][)\]"'\u201D\u00BB]*(?=[\x20\x09-\x0D]|$)""")
_SYMBOL = re.compile(r"[#*$%&|<>]")
FEATURES = ("log words", "words by line", "characters by word", "symbols by word", "shouts by word", "upper-case words", "distinct words in blocks", "words equal to the one before", "repeated lines", "lines without an end", "sentence ends by word", "digits", "letters", "menu marks by word")


def features(text: str | None) -> list[float]:
    """Features of a whole text, each bounded; a null or empty text has zeros and no words."""
    text = "" if text is None else text
    words = text.split()
    n = len(words) or 1
    lines = [x for x in (x.strip(SPACE) for x in text.split("\n")) if x]
    m, chars = len(lines) or 1, len(text) or 1
    distinct = sum(len(set(words[k : k + BLOCK])) for k in range(0, len(words), BLOCK))
    open_lines = sum(len(x) for x in lines if not _END.search(x[-4:]))
    letters = sum(map(str.isalpha, words))
    return [
        np.log1p(len(words)) / 10, min(len(words) / m, 400) / 400, min(sum(map(len, words)) / n, 40) / 40, min(len(_SYMBOL.findall(text)) / n, 1), min(text.count("!!") / n, 1),
        sum(map(str.isupper, words)) / n, distinct / n, sum(map(str.__eq__, words, words[1:])) / n, 1 - len(set(lines)) / m if lines else 0, open_lines / chars,
        min(len(_END.findall(text)) / n, 1), sum(map(text.count, "0123456789")) / chars, letters / n, min(text.count(" | ") / n, 1),
    ]


def fit(x: np.ndarray, y: np.ndarray, pairs: int = TRAIN_PAIRS, rounds: int = 300, ridge: float = 1e-3) -> dict:
    """Weights on standardised features, and the raw score at the quantile of the bad share.

    With one class only there are no pairs: all weights are zero and every
    score is the same, above the threshold.
    """
    mean, sd = (x.mean(0), x.std(0)) if len(x) else (np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
    sd = np.where(sd > 1e-9, sd, 1)
    z = (x - mean) / sd
    w = np.zeros(z.shape[1] if len(x) else len(FEATURES))
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return {"mean": mean, "sd": sd, "w": w, "at": -1.0, "scale": 1.0}
    rng = np.random.default_rng(7)
    d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    moment = np.zeros_like(w)
    for _ in range(rounds):  # gradient descent with momentum on a convex loss
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        moment = 0.9 * moment + (p @ d) / pairs - ridge * w
        w = w + 0.3 * moment
    raw = np.sort(z @ w)
    k = len(bad)
    return {"mean": mean, "sd": sd, "w": w, "at": float(raw[k - 1] + raw[k]) / 2, "scale": float(max(raw.std(), 1e-9))}


def score(model: dict, x: np.ndarray) -> np.ndarray:
    """0 to 1; the model's quantile gets exactly the threshold."""
    raw = ((x - model["mean"]) / model["sd"]) @ model["w"]
    odds = np.log(THRESHOLD / (1 - THRESHOLD)) + 4 * (raw - model["at"]) / model["scale"]
    return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> dict:
    """Fits on a bounded sample of the labelled documents that are not held out; ids only join texts to labels.

    An id counts once, with the label that most of its rows have (a tie is
    bad) and the text with the least hash, so the driver gets ``most`` rows
    in expectation however often an id is repeated.
    """
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy(F.col("doc_id").alias("_id")).agg((F.avg("quality") > 0.5).cast("int").alias("_quality"))
    n = usable.count()
    share = min(1.0, most / max(n, 1))
    sample = usable.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_003)) < F.lit(share * 1_000_003))
    text = F.coalesce("text", F.lit(""))
    found = docs.select("doc_id", text.alias("text")).join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))  # about ``most`` ids at any size
    rows = found.groupBy("doc_id", "_quality").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("one")).select("doc_id", "_quality", "one.text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_models()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([features(t.as_py()) for t in batch.column("text")], pa.list_(pa.float64())), batch.column("_quality").cast(pa.int32()), batch.column("doc_id").cast(pa.int64())], ["x", "y", "doc_id"])

    found = rows.mapInArrow(run, "x array<double>, y int, doc_id long").toPandas().sort_values("doc_id")
    x = np.array(found["x"].tolist(), np.float64).reshape(-1, len(FEATURES))
    order = np.lexsort((*x.T, found["doc_id"].to_numpy())) if len(x) else []
    return fit(x[order], found["y"].to_numpy()[order])


def with_scores(docs: DataFrame, model: dict) -> DataFrame:
    """Adds ``score`` and ``predicted`` to every row; repeated rows score alike, a null text as an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_models()
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column("text")], np.float64).reshape(-1, len(FEATURES))
            s = score(model, x)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64()), pa.array((s >= THRESHOLD).astype(np.int32), pa.int32())], [*batch.schema.names, "score", "predicted"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, score double, predicted int")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    Repeated rows and equal texts score alike, a null text as an empty one;
    without labels of both kinds every score is the same; other columns are
    ignored; an empty table gives no rows.
    """
    rows = docs.select("doc_id", "text")
    model = train(rows, labels)
    return with_scores(rows, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
