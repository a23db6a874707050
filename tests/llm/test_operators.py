"""The operators against brute force on small tables with nulls, empty and long texts, ties, copies and foreign columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard

from tripaudit.llm import bpe, jaccard, language, mixing, quality_model, quality_rules, repeats, sharding, token_files, vector_graph
from tripaudit.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, sig string, before long, shard int"
BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _texts() -> list[str | None]:
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeé ") for _ in range(rng.randint(1, 9))).strip() or "x" for _ in range(300)]
    passage = " ".join(rng.choice(words) for _ in range(40))
    base = [rng.choice(words) for _ in range(120)]
    out: list[str | None] = [None, "", " \n\t ", "one", "Two words", "a b  ć \U0001f600 <|endoftext|> don't IT'S", "x" * 700, "ab " * 400, "\x1c\x1f\x0b tab"]
    for k in range(12):
        own = list(base)
        for _ in range(k):
            own[rng.randrange(len(own))] = rng.choice(words)
        out.append(" ".join(own))
    for _ in range(14):
        own = " ".join(rng.choice(words) for _ in range(rng.randint(5, 90)))
        out.append(f"{own}. {passage}\n{own[: rng.randint(0, 60)]}" if rng.random() < 0.5 else own)
    out += [out[10], out[10], out[10].upper(), out[12]]
    out.append(" ".join(rng.choice(words) for _ in range(30_000)))  # a very long one
    return out


TEXTS = _texts()


@pytest.fixture(scope="module")
def rows():
    data = [(i * 3 % 101, t, [None, "en", "de"][i % 3], [None, "b", "a", "a", "é"][i % 5], 1, 7, "s", 3, 9) for i, t in enumerate(TEXTS)]
    data.append((None, "no id at all", "en", "a", 1, 7, "s", 3, 9))
    data.append(data[12])  # the same row again
    return data


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_sharding(docs, empty, rows):
    got = sharding.shard_rows(docs, 24).collect()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted((str(r[0]), len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    for s in {r.shard for r in got}:
        own = sorted((r.slot, -1 if r.doc_id is None else r.doc_id) for r in got if r.shard == s)
        assert [x for x, _ in own] == list(range(len(own))) and [y for _, y in own] == sorted(y for _, y in own)
    assert all(r.grown_shard in (r.shard, 24) for r in got)
    assert sharding.shard_rows(empty).collect() == []


def test_jump_hash_moves_only_into_the_new_shard():
    keys = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 5000)
    before = sharding.jump_shard(keys, 1)
    for n in range(2, 40):
        now = sharding.jump_shard(keys, n)
        assert ((now == before) | (now == n - 1)).all() and np.bincount(now, minlength=n).min() > 5000 / n / 2
        before = now


def test_mixing(docs, empty, rows):
    got = mixing.mix_plan(docs).collect()
    count = lambda t: len(WORD.findall(t or ""))
    sizes: dict = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + count(r[1])
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = dict(zip(order, [3, 1, 2, 3, 1], strict=False))
    target, left, open_ = {}, 1.5 * sum(sizes.values()), set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        for s in full or open_:
            target[s] = float(2 * sizes[s]) if full else weight[s] * level
            left -= target[s]
        open_ -= full or open_
    assert {(r.source, r.source_size, round(r.target, 6)) for r in got} == {(s, sizes[s], round(target[s], 6)) for s in sizes}
    assert len(got) == len(rows) and all(r.taken in (0, r.size, 2 * r.size) for r in got)
    for s in sizes:
        taken, most = sum(r.taken for r in got if r.source == s), max(r.size for r in got if r.source == s)
        assert abs(taken - target[s]) <= most
    assert sum(r.taken for r in got) <= 1.5 * sum(sizes.values())
    again = mixing.mix_plan(docs.repartition(5)).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r._order, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and sum(count(r.text) for r in mixed.collect()) == sum(r.taken for r in got)
    assert mixing.mix_plan(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []


def test_bpe_as_the_library(docs, empty, rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTE_BPE)
    want = []
    for r in rows:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids
        want.append((str(r[0]), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.bpe_digests(docs, BYTE_BPE).collect()) == sorted(want)
    assert bpe.bpe_digests(empty, BYTE_BPE).collect() == []
    full = bpe.bpe_encode(docs, BYTE_BPE)
    assert full.columns == [*docs.columns, "ids"] and sorted(len(r.ids) for r in full.collect()) == sorted(w[1] for w in want)


def test_bpe_random_text_with_a_small_memory(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(bpe, "MEMORY", 50)
    t, v, rng = Tokenizer.from_file(BYTE_BPE), bpe.Vocabulary(BYTE_BPE), random.Random(3)
    for k in range(300):
        text = "".join(rng.choice(["the", "ing", " ", "\n", "é", "ß", "中", "12", "'s", "_", "!!", chr(rng.randrange(1, 0x3000)), " "]) for _ in range(rng.randint(0, 60)))
        raw, decimal = v.encode(text)
        ids = t.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(raw, np.int32).tolist() == ids and decimal.decode() == ",".join(map(str, ids)) and v.decode(np.array(ids, int)).decode() == text


def test_token_files(docs, empty, rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD_BPE)
    got = token_files.token_files(docs, WORD_BPE, 2).collect()
    ids = [(r[0], t.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in rows]
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(k), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for k, x in ids)
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    order = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert order == sorted(order)
    assert token_files.token_files(empty, WORD_BPE).collect() == []


def test_token_words_are_objects_once():
    """Encoding holds Python objects for distinct words, not one for each occurrence."""
    import tracemalloc

    words = token_files.tokenizer_words(WORD_BPE)
    text = " ".join(f"Word{'abcdefghij'[k % 10]}" for k in range(200_000))
    token_files.encoded([text[:60]], words)
    tracemalloc.start()
    try:
        got = token_files.encoded([text], words)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 10 * 200_000
    assert got == words.each([text])


@pytest.mark.parametrize(("memory", "call"), [(800_000, 2000), (20, 3)])
def test_token_words_match_the_library(monkeypatch, memory, call):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "MEMORY", memory)
    monkeypatch.setattr(token_files, "CALL", call)
    t, rng = Tokenizer.from_file(WORD_BPE), random.Random(9)
    words = token_files.tokenizer_words.__wrapped__(WORD_BPE)
    parts = ["the", "Ing", " ", "  ", "\n", "\x0b", "\x1c", "\x85", "\xa0", "é", "E\u0301", "\u0301", "ß", "İ", "Σ", "Ɩ", "Ɵ", "Ⱥ", "ſ", "中文", "12", "'s", "'LL", "''", "...", "–", "×", "<|endoftext|>", "<|", "\U0001f600", "y" * 70]
    for _ in range(20):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(40)]
        got = token_files.encoded(texts, words)
        assert [np.frombuffer(x, words.kind).tolist() for x in got] == [t.encode(x, add_special_tokens=False).ids for x in texts]
        assert len(words.ids) == len(words.pieces) == len(words.used) <= memory
    assert token_files.encoded([], words) == [] and token_files.encoded(["", " \n"], words) == [b"", b""]


def test_index_is_minimal_and_tells_strangers():
    keys = token_files.key_hash(np.arange(20_000), np.zeros(20_000, bool), np.zeros(20_000, np.int64))
    levels, slot = token_files.build_index(keys)
    assert sorted(slot.tolist()) == list(range(20_000)) and sum(map(len, levels)) < 6 * 20_000
    prints = np.empty(20_000, np.uint32)
    prints[slot] = (token_files.mixed(keys, 104) >> np.uint64(32)).astype(np.uint32)
    arrays = {"sizes": np.array([len(x) for x in levels]), "bits": np.packbits(np.concatenate(levels)), "prints": prints, "offset": slot, "length": slot, "keys": keys, "nulls": keys, "copies": keys}
    index = token_files.Index(arrays)
    assert (index.slots(keys) == slot).all()
    strangers = token_files.key_hash(np.arange(20_000, 40_000), np.zeros(20_000, bool), np.zeros(20_000, np.int64))
    assert (index.slots(strangers) == -1).all()


def _rules_by_hand(text: str | None) -> tuple:
    words = WORD.findall(text or "")
    grams = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    inside = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), sum(x in lines[:k] for k, x in enumerate(lines)), len(inside)


def test_line_rules(docs, empty, rows):
    got = quality_rules.line_rules(docs).collect()
    short = [r for r in rows if len(r[1] or "") < 20_000]
    have = sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got if r.n_words < 3000)
    assert have == sorted(_rules_by_hand(r[1]) for r in short) and len(got) == len(rows)
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.kept and r.base_failed) for r in got)
    assert quality_rules.line_rules(empty).collect() == []


@pytest.mark.parametrize("line, rule", [("A clean line ends here.", None), ("Home | News | Sport | About | More. ", "navigation"), ("no end of a sentence", "punctuation"), ("WHAT!! IS!! THIS!! EVEN!! ABOUT!!", "punctuation"), ("a% b$ c# d& e* f.", "punctuation"), ("All rights reserved.", "boilerplate"), ("He said: “We came.”", None)])
def test_line_rule(line, rule):
    assert quality_rules.failed_rule(line.strip()) == rule


def test_quality_model_orders_pairs(spark, docs, empty):
    good = [f"This is number {k} of the plain sentences. It has an end, and words that differ much." for k in range(80)]
    bad = [f"BUY!! NOW!! {k} CHEAP!! CHEAP!! CHEAP!! | go | go | go" for k in range(60)]
    own = spark.createDataFrame([*enumerate(good + bad), (None, None), (999, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 80), 0) for k in range(140)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_model.quality_scores(own, labels).collect()}
    assert len(got) == 142 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [k for k in range(140) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(got[k].held_out == (k in held) for k in range(140)) and all(got[k].predicted == int(k < 80) for k in held)
    one = quality_model.quality_scores(own, labels.where("quality = 1")).collect()
    assert len(one) == 142 and {r.predicted for r in one} == {1}
    assert quality_model.quality_scores(empty, labels.limit(0)).collect() == [] and len(quality_model.quality_scores(docs, labels.limit(0)).collect()) == docs.count()


def test_labels_of_held_out_rows_are_not_read(spark):
    own = spark.createDataFrame([(k, ("Plain words end here. " if k % 2 else "LOUD!! LOUD!! | x | ") * (2 + k % 5)) for k in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(100)], "doc_id long, quality int")
    turned = spark.createDataFrame([(k, 1 - k % 2 if zlib.crc32(str(k).encode()) % 5 == 0 else k % 2) for k in range(100)], "doc_id long, quality int")
    a, b = (sorted(map(tuple, quality_model.quality_scores(own, x).collect())) for x in (labels, turned))
    assert a == b


def test_language(spark, docs, empty):
    rng = random.Random(2)
    make = lambda parts, n: " ".join("".join(rng.choice(parts) for _ in range(rng.randint(2, 4))) for _ in range(n))
    data = [(k, make(["the", "ing", "tion", "er"], 60) if k % 2 else make(["sch", "ung", "keit", "ein"], 60), "en" if k % 2 else "de") for k in range(200)]
    data += [(1000, None, "en"), (1001, "123 456", "en"), (1002, "", "de"), (1003, make(["sch", "ung"], 9), None)]
    got = {r.doc_id: r for r in language.languages_of(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()}
    assert all(got[k].lang_pred == ("en" if k % 2 else "de") for k in range(200)) and got[1003].lang_pred == "de"
    assert [got[k].lang_pred for k in (1000, 1001, 1002)] == ["und"] * 3 and all(0 <= r.score <= 1 for r in got.values())
    assert language.languages_of(empty).collect() == [] and {r.lang_pred for r in language.languages_of(docs.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()} == {"und"}


def _components(nodes, links) -> dict:
    root = {n: n for n in nodes}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = top(a), top(b)
        root[max(x, y)] = min(x, y)
    return {n: top(n) for n in nodes}


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)] + [(900, k) for k in range(901, 960)]
    got = {r.node: r.label for r in components(spark.createDataFrame([*links, (None, 3), (7, 7)], "a long, b long")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == _components(nodes, links)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def _sets(text: str | None, width: int) -> frozenset:
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))) if words else frozenset()


@pytest.mark.parametrize("width, percent, part", [(4, 85, 1024), (5, 80, 3), (2, 50, 1024)])
def test_jaccard(spark, docs, empty, rows, monkeypatch, width, percent, part):
    monkeypatch.setattr(jaccard, "PART", part)  # 3: groups are cut into blocks
    sets = [_sets(r[1], width) for r in rows]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    top = _components(range(len(rows)), links)
    least: dict = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[top[i]] = min(r[0], least.get(top[i], r[0]))
    want = sorted((str(r[0]), len(sets[i]), str(least.get(top[i]))) for i, r in enumerate(rows))
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.jaccard_classes(docs, width, percent).collect())
    assert got == want and len({w[2] for w in want}) < len(rows) - 3
    assert jaccard.jaccard_classes(empty, width, percent).collect() == []


def test_spooled_hash_ranges_give_the_same(docs, monkeypatch):
    want = sorted(map(str, jaccard.jaccard_classes(docs, 4, 85).collect()))
    monkeypatch.setattr(jaccard, "HELD_BYTES", 100)
    monkeypatch.setattr(jaccard, "BATCH_BYTES", 500)
    assert sorted(map(str, jaccard.jaccard_classes(docs, 4, 85).collect())) == want


def _repeats_by_hand(rows, length):
    seen, out = set(), []
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, 0)):
        b = (r[1] or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if b[k : k + length] in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(b[k : k + length])
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((str(r[0]), len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("length", [100, 33])
def test_repeats(docs, empty, rows, monkeypatch, length):
    want = _repeats_by_hand(rows, length)
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    got = repeats.remove_repeats(docs, length, carry=("source", "size")).collect()
    assert sorted((str(r.doc_id), *(r[c] for c in columns[1:])) for r in got) == want and sum(w[2] for w in want) > 500
    assert sorted(str(r.source) for r in got) == sorted(str(r[3]) for r in rows) and {r["size"] for r in got} == {7}
    monkeypatch.setattr(repeats, "BATCH_BYTES", 900)
    got = repeats.remove_repeats(docs, length, with_text=False).collect()
    assert sorted((str(r.doc_id), *(r[c] for c in columns[1:])) for r in got) == want
    assert repeats.remove_repeats(empty, length).collect() == []


def test_repeats_of_a_hot_anchor_are_split(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh ") for _ in range(90))
    least = lambda t: repeats._hash_at(repeats._prefix_hash(np.frombuffer(t.encode(), np.uint8)), np.array([0]), repeats.ANCHOR)[0]
    with np.errstate(over="ignore"):
        rule = min((word()[:32] for _ in range(2000)), key=least)  # one that is the anchor of most strings around it
    shared = word()
    texts = [word() + (rule if k % 3 == 0 else "") + (shared[: 40 + k % 50] if k % 5 == 0 else "") + word() for k in range(900)]
    rows = [(k, t) for k, t in enumerate(texts + texts[:20])]
    monkeypatch.setattr(repeats, "SHARD_BYTES", 4000, raising=False)
    monkeypatch.setattr(repeats, "SPLIT_BYTES", 16_000, raising=False)
    monkeypatch.setattr(repeats, "BATCH_BYTES", 6000)
    real = repeats._shard

    def checked(length, root):
        inner = real(length, root)

        def run(batches):
            held: dict[int, int] = {}
            for batch in (batches := list(batches)):
                for r in batch.to_pylist():
                    if r["bucket"] >= 0:
                        held[r["bucket"]] = held.get(r["bucket"], 0) + len(zstandard.decompress(r["docs"]))
            assert max(held.values(), default=0) <= 24_000, held  # single strings are dealt by hash, so about as many
            yield from inner(iter(batches))

        return run

    monkeypatch.setattr(repeats, "_shard", checked)
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), with_text=False).collect()
    want = _repeats_by_hand(rows, 100)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want and sum(w[2] for w in want) > 3000


def test_anchors_are_dealt_to_bounded_shards():
    n = np.array([2, 3, 500, 2, 2, 7000, 10])
    shard, ways = repeats.dealt(n, 100, 4000, 16_000)
    assert ways.tolist() == [0, 0, 218, 0, 0, 3049, 0] and shard[2] + 218 == shard[5]
    filled = np.bincount(shard[ways == 0], n[ways == 0] * 169)
    assert filled.max() <= 4000 and shard[2] >= len(filled)
    text = np.frombuffer(b"abcabdabc", np.uint8).reshape(3, 3)
    one, two, three = repeats.equal_texts(np.zeros(3, np.uint64), text)  # equal hashes, texts that differ
    assert one == three != two


def test_suffix_ranks(monkeypatch):
    from tripaudit.llm import suffix_sort

    rng = np.random.default_rng(0)
    for k in range(150):
        x = rng.integers(1, rng.integers(2, 6), rng.integers(0, 60))
        t = np.concatenate([np.tile(x, 1 + k % 3), [0]]).astype(np.int64)
        want = sorted(range(len(t)), key=lambda i: tuple(t[i:]))
        monkeypatch.setattr(suffix_sort, "RUN_BLOCK", 7 if k % 2 else 1 << 18)
        assert suffix_sort.suffix_ranks(t, None, 5 if k % 2 else None).argsort().tolist() == want  # 5: runs in files


def test_vectors(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(40, 8))
    x = np.concatenate([base, *(base[rng.integers(0, 40, 60)] + rng.normal(scale=s, size=(60, 8)) for s in (0.02, 0.15, 0.3)), np.repeat(base[:1], 20, 0), 3 * base[1:3]])
    data = [(i, [float(v) for v in row], 1) for i, row in enumerate(x.astype(np.float32))]
    n = len(data)
    data += [(n, None, 1), (n + 1, [0.0] * 8, 1), (n + 2, [float("nan")] * 8, 1), (n + 3, [1.0, None], 1), (n + 4, [], 1), (n + 5, [1.0, 2.0], 1), (n + 6, [2.0, 4.0], 1), (n + 7, [float("inf")] * 8, 1)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>, n long")
    y = x.astype(np.float32).astype(float)
    cos = y @ y.T / np.outer(np.sqrt((y * y).sum(1)), np.sqrt((y * y).sum(1)))
    links = [(i, j) for i in range(n) for j in range(i) if cos[i, j] >= 0.95] + [(n + 5, n + 6)]
    count = {i: 0 for i in range(n + 8)}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    top = _components(range(n + 8), links)
    got = sorted(tuple(r) for r in vector_graph.vector_duplicates(frame, 0.95).collect())
    assert got == [(i, count[i], top[i], top[i] == i) for i in range(n + 8)]
    assert vector_graph.vector_duplicates(frame.limit(0)).collect() == []


def test_vectors_in_many_shards_and_parts(spark, monkeypatch):
    for name, value in (("SHARD", 60), ("PART", 40), ("SAMPLE", 10)):
        monkeypatch.setattr(vector_graph, name, value)
    rng = np.random.default_rng(8)
    base = rng.normal(size=(150, 16))
    x = np.concatenate([base, base[:100] + rng.normal(scale=0.1, size=(100, 16)), base[0] + rng.normal(scale=0.1, size=(120, 16))]).astype(np.float32)
    frame = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    y = vector_graph.unit(x.astype(float))
    true = {(i, j) for i, j in zip(*np.nonzero(y @ y.T >= 0.95)) if i != j}
    found = sum(r.n_links for r in vector_graph.vector_duplicates(frame, 0.95).collect())
    assert 0.95 * len(true) <= found <= len(true)


def test_vectors_that_the_graph_misses_are_joined_exactly(spark, monkeypatch):
    for name, value in (("SHARD", 4), ("PART", 9), ("MOST_OVERLAP", 2)):
        monkeypatch.setattr(vector_graph, name, value)
    rng = np.random.default_rng(6)
    centre = rng.normal(size=24)
    near = centre + rng.normal(size=(150, 24)) * 0.16  # one group of distinct near copies over dozens of shards
    x = np.concatenate([near, rng.normal(size=(150, 24))])
    y = vector_graph.unit(x)
    want = (y @ y.T >= 0.95).sum(1) - 1
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in vector_graph.vector_duplicates(frame, 0.95).collect()}
    assert [got[k] for k in range(300)] == want.tolist() and want.sum() > 3000
