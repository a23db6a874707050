"""The pipeline's stages on a small corpus with known good, bad, near-equal and repeated documents."""

from __future__ import annotations

import os
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from tripaudit.llm import bpe  # noqa: E402
from tripaudit.llm.bpe import bpe_digests  # noqa: E402
from tripaudit.llm.quality_model import FEATURES, fit, with_scores  # noqa: E402

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _corpus(spark, path):
    rng = random.Random(1)
    words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    sentence = lambda n: " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."
    good = [" ".join(sentence(9) for _ in range(12)) for _ in range(60)]
    passage = " ".join(sentence(10) for _ in range(6))
    data = [(k, t) for k, t in enumerate(good)]
    data += [(100, good[3]), (101, good[3].replace(good[3].split()[40], "changed", 1)), (102, f"{sentence(30)} {passage} {sentence(30)}"), (103, f"{sentence(30)} {passage} {sentence(30)}")]
    data += [(200 + k, f"BUY!! {k}!! NOW!! " * 40) for k in range(30)] + [(300, None), (301, ""), (None, sentence(30))]
    docs = spark.createDataFrame([(i, t, "en", "ab"[(i or 0) % 2], len(t or "")) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 200), 0) for i, _ in data if i is not None and i < 300], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return dict(data), passage


def test_stages(spark, scratch):
    texts, passage = _corpus(spark, f"{scratch}/in")
    docs, seen = spark.read.parquet(f"{scratch}/in/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, f"{scratch}/in").write.parquet(f"{scratch}/{k}")
        docs = spark.read.parquet(f"{scratch}/{k}")
        seen[name] = docs.collect()
        assert name == "encode" or tuple(docs.columns) == corpus_pipeline.COLUMNS
    ids = {n: {r.doc_id for r in v} for n, v in seen.items()}
    assert ids["quality"] >= {k for k in texts if k is not None and k < 200} and not any(k is not None and 200 <= k < 300 for k in ids["quality"])
    assert {100, 101} & ids["near_dups"] == set() and ids["near_dups"] >= {*range(60), 102, 103}
    kept = {r.doc_id: r.text for r in seen["repeats"]}
    assert passage[2:-2] in kept[102] and passage[20:120] not in kept[103] and all(kept[k] == texts[k] for k in range(60))
    taken = sorted(-1 if r.doc_id is None else r.doc_id for r in seen["mix"])
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in seen["encode"]) == taken and max(map(taken.count, taken)) <= 2
    want = {(r.doc_id, r.n_tokens) for r in bpe_digests(spark.createDataFrame(seen["mix"], "doc_id long, text string, lang string, source string, n_chars long"), public_tokenizers.path("byte_bpe_50k.json")).collect()}
    assert {(r.doc_id, r.n_tokens) for r in seen["encode"]} == want and all(len(r.ids) == r.n_tokens for r in seen["encode"])
    whole = corpus_pipeline.run(spark, f"{scratch}/in")
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens) for r in whole.collect()) == sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens) for r in seen["encode"])


def test_empty_tables(spark, scratch):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{scratch}/in/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/in/labels.parquet")
    assert corpus_pipeline.run(spark, f"{scratch}/in").collect() == []


class _Rows:
    """Takes the place of a DataFrame: mapInArrow gives the function that tasks run."""

    def __init__(self, schema):
        self.schema = schema

    def mapInArrow(self, run, _):
        return run


_GROWTH = """
import re, sys
import pyarrow as pa
from pyspark.sql import types as T
from tripaudit.llm.bpe import bpe_encode
from test_pipeline import VOCABULARY, _Rows

def used():
    return sum(map(int, re.findall(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

word = lambda n: "".join(chr(97 + n // 26**d % 26) for d in range(7))
run = bpe_encode(_Rows(T.StructType([T.StructField("text", T.StringType())])), VOCABULARY)
batch = lambda k: pa.RecordBatch.from_pydict({"text": [" ".join(word((k * 5000 + i) * 479001599 % 26**7) for i in range(5000))]})
list(run(iter([batch(0)])))
before = used()
ids = sum(len(b.column("ids")[0]) for b in run(map(batch, range(1, 100))))
print(ids, used() - before)
"""


def test_memory_of_a_worker_that_encodes():
    """500,000 words that all differ: answers that are kept take 60 MB at most."""
    here = Path(__file__).resolve().parent
    said = subprocess.run([sys.executable, "-c", _GROWTH], env=os.environ | {"PYTHONPATH": f"{here}:{here.parents[1]}"}, capture_output=True, text=True, timeout=300, check=True).stdout.split()
    assert int(said[0]) > 99 * 5000 and float(said[1]) < 60, said


def test_first_stage_lets_go_of_the_models_of_the_last():
    schema = T.StructType([T.StructField("text", T.StringType())])
    kept, batch = bpe.vocabulary, pa.RecordBatch.from_pydict({"text": ["some words here"]})
    list(bpe.bpe_encode(_Rows(schema), VOCABULARY)(iter([batch])))
    assert kept.cache_info().currsize > 0
    list(with_scores(_Rows(schema), fit(np.zeros((0, len(FEATURES))), np.zeros(0, int)))(iter([batch])))
    assert kept.cache_info().currsize == 0
