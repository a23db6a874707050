"""Personal data, conversation repair and collocations against brute force, with nulls, long texts, ties, copies and foreign columns."""

from __future__ import annotations

import gc
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripaudit.llm import conversations, jaccard, language, personal, phrases, quality_model, repeats, shingles

DOCS = "doc_id long, text string, lang string, source string, id long, value string, hits int, n long, phrase string"
OTHER = ("s", 7, "v", 3, 9, "p")

# --- personal data ---------------------------------------------------------------------------------------------------

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def _luhn(digits: str) -> bool:
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x // 10 + x % 10 for x in twice) % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")), "card": 12 <= len(digits) <= 19 and _luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def listed(spans) -> str:
    return ",".join(f"{list(PLAIN)[k]}:{a}:{e}" for a, k, e in spans)


def _personal_texts() -> list[str | None]:
    rng = random.Random(3)
    bits = ["a@b.c", "a@b.c@d.e", "x_y@q.r_s@t.u", "@", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.02.3.255", "4111 1111-1111 1111", "4111111111111112", "0" * 12, "+1 (743) 555-3824", "+1  2", "++12 345.678-90", "é\U0001f600", " ", "-", ".", "+", "word", "\n", "(", "5" * 25, "a.@b..c", "%+-@-.-"]
    out: list[str | None] = [None, "", "x"]
    out += ["".join(rng.choice(bits) for _ in range(rng.randint(1, 14))) for _ in range(250)]
    out += ["7" * 9_000, "ab." * 3_000, "1 " * 60_000 + "@", "+1" + " " * 50_000 + "x", "1.2.3.4 " * 3_000]
    return out


def test_base_spans_equal_the_plain_patterns(spark):
    texts = _personal_texts()
    docs = spark.createDataFrame([(i, t, "en", *OTHER[:1], *OTHER[1:]) for i, t in enumerate(texts)] + [(None, "a@b.c", None, *OTHER), (None, "a@b.c", None, *OTHER)], DOCS)
    got = personal.personal_spans(docs).collect()
    assert len(got) == len(texts) + 2
    rows = {r["doc_id"]: r for r in got}
    for i, text in enumerate([*texts, "a@b.c"]):
        r, want = rows[i if i < len(texts) else None], base_spans(text)
        assert r["base_sha256"] == hashlib.sha256(listed(want).encode()).hexdigest(), text and text[:80]
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(s[1] == k for s in want) for k in range(4)]
        assert set(filter(None, listed(want).split(","))) <= set(r["spans"].split(","))
    assert personal.personal_spans(docs.limit(0)).count() == 0


def test_contexts_of_seeds_find_near_misses(spark):
    rng = random.Random(8)

    def number():
        return f"{rng.randint(200, 989)}-555-{rng.randint(1000, 9999)}"

    texts = [f"Notes of {rng.random()} go here. Please call +1 {number()} today." for _ in range(30)]
    missed = [number() for _ in range(3)]
    texts += [f"Other text. Please call {m} today." for m in missed]
    texts.append(f"Nothing else says so: {missed[0]}.")  # the same number where no pattern stands
    clean = [f"Your order number {number()} shipped." for _ in range(20)]
    broken = [f"Write to me at user{k}@host.example.org please." for k in range(12)] + ["Write to me at admin@localhost please."]
    docs = spark.createDataFrame([(i, t, "en", *OTHER) for i, t in enumerate(texts + clean + broken)], DOCS).repartition(5)
    rows = {r["doc_id"]: r for r in personal.personal_spans(docs).collect()}
    for i, text in enumerate(texts[30:33], 30):
        a = text.index(missed[i - 30])
        assert rows[i]["spans"] == f"phone:{a}:{a + len(missed[i - 30])}" and rows[i]["n_phone"] == 0 and rows[i]["n_added"] == 1
    a = texts[33].index(missed[0])
    assert rows[33]["spans"] == f"phone:{a}:{a + len(missed[0])}"
    assert all(rows[i]["spans"] == "" for i in range(34, 54))
    last = max(rows)
    a = broken[-1].index("admin")
    assert rows[last]["spans"] == f"email:{a}:{a + len('admin@localhost')}"
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": range(len(rows)), "text": texts + clean + broken}))
    by_sql = con.sql(personal.SQL).df().set_index("doc_id")
    assert all(by_sql.loc[i, c] == r[c] for i, r in rows.items() for c in by_sql.columns)


def test_personal_data_runs_on_built_in_functions_alone(spark):
    docs = spark.createDataFrame([(1, "mail a@b.c", "en", *OTHER)], DOCS)
    plan = personal.personal_spans(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- conversations ---------------------------------------------------------------------------------------------------


def cheapest(codes: str) -> tuple[int, str]:
    """Costs to the end from each row and state, then the least letter that stays on a cheapest way."""
    n, far = len(codes), 10**9
    after = {"K": lambda s, c: {"s": 1 if s == 0 else None, "u": 2 if s != 2 else None, "a": 3 if s == 2 else None, "x": None}[c], "R": lambda s, c: conversations.NEXT[s]}

    def steps(i, s):
        yield "I", i, conversations.NEXT[s], 3
        if i < n:
            c = conversations._INITIAL[codes[i]]
            yield "D", i + 1, s, 4
            if codes[i] not in conversations.GONE:
                cut = 3 if codes[i] in conversations.CUT else 0
                for edit, price in (("K", 0), ("R", 3)):
                    to = after[edit](s, c)
                    if to is not None:
                        yield edit, i + 1, to, price + cut

    best = [[far] * 4 for _ in range(n + 1)]
    best[n][0] = best[n][3] = 0
    for i in range(n, -1, -1):
        for _ in range(4):
            for s in range(4):
                best[i][s] = min([best[i][s], *(p + best[j][t] for _, j, t, p in steps(i, s))])
    i, s, out = 0, 0, ""
    while i < n or s in (1, 2):
        edit, i, s = min((e, j, t) for e, j, t, p in steps(i, s) if p + best[j][t] == best[i][s])
        out += edit
    return best[0][0], out


@settings(max_examples=300, deadline=None)
@given(st.text("suaxSUAX1234", max_size=14), st.integers(1, 6))
def test_chained_chunks_give_the_least_cheapest_audit(codes, size):
    chunks = [codes[i : i + size] for i in range(0, len(codes), size)]
    want = cheapest(codes)
    assert conversations.chain([(c, None) for c in chunks])[1:] == want
    assert conversations.chain([(c, conversations.solve(c)) for c in chunks])[1:] == want


def test_equal_hashes_are_verified(monkeypatch):
    rng = random.Random(1)
    monkeypatch.setattr(conversations, "_PRIME", 3)  # nearly all hashes collide
    for _ in range(200):
        codes = "".join(rng.choice("suaxSUAX12") for _ in range(rng.randint(0, 12)))
        assert conversations.chain([(codes, conversations.solve(codes))] if codes else [])[1:] == cheapest(codes)


def _damage(rows):
    out = []
    for conv, turn, role, text in rows:
        text, role = " " if text is None else text, " " if role is None else role
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if hit:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(hit, text)
            out += [(conv, turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return out


def brute_repair(rows):
    out = {}
    damaged = defaultdict(list)
    for row in _damage(rows):
        damaged[row[0]].append(row)
    for conv in {r[0] for r in rows}:
        own = sorted(damaged[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, codes, counts = set(), "", Counter()
        for _, _, role, text in own:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
            at = "suax".index(letter)
            codes += (conversations.CUT if fault == "truncated" else conversations.GONE if fault else conversations.SOUND)[at]
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit = cheapest(codes) if own else (0, "")
        repaired, queue = [], iter(own)
        for edit in audit:
            last = repaired[-1][0][:1] if repaired else ""
            following = "assistant" if last == "u" else "user"
            if edit == "I":
                repaired.append((following, ""))
                continue
            _, _, role, text = next(queue)
            if edit != "D":
                repaired.append((role if edit == "K" else following, text))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha)
    return out


def _conversations():
    rng = random.Random(12)
    texts = ["Yes.", "No!", "Well?", "cut off", "", " \t\n", None, "é ", "end.\u0085", "Long " * 500 + "."]
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(0, 9)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            rows.append((conv, rng.choice([turn, turn, turn, None, 40 - turn]), role, rng.choice(texts)))
    rows += rows[:40]  # repeated rows
    rows += [(1000, t, ["user", "assistant"][t % 2 if rng.random() < 0.9 else 0], rng.choice(["Same.", f"Turn {t}.", "cut"])) for t in range(3000)]  # one that spans chunks
    return rows


def test_repair_equals_brute_force(spark):
    rows = _conversations()
    schema = "conv_id long, turn long, role string, text string, at long, code string, audit string"
    frame = spark.createDataFrame([(*r, 1, "c", "a") for r in rows], schema).repartition(4)
    got = {r["conv_id"]: tuple(r)[1:] for r in conversations.damage_and_repair(frame).collect()}
    want = brute_repair(rows)
    assert got.keys() == want.keys()
    assert {k: (v, want[k]) for k, v in got.items() if v != want[k]} == {}
    assert conversations.damage_and_repair(frame.limit(0)).count() == 0


# --- collocations ----------------------------------------------------------------------------------------------------


def brute_collocations(docs, support, top=2000, most=3, inside=50):
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, most + 1):
                f.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    found = {g: a for g, a in f.items() if a >= support and len(g) > 2}
    out = defaultdict(list)
    for (lang, *words), a in found.items():
        longer = [b for (other, *around), b in found.items() if other == lang and len(around) > len(words) and any(around[i : i + len(words)] == words for i in range(len(around)))]
        if any(100 * b >= inside * a for b in longer):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[(lang, *words[:k])], f[(lang, *words[k:])]
            cuts.append((10**6 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out[lang].append((-score, -a, " ".join(words).encode(), left, right))
    rows = set()
    for lang, all_of in out.items():
        for rank, (s, a, phrase, left, right) in enumerate(sorted(all_of)[:top], 1):
            rows.add((lang, rank, phrase.decode(), -a, left, right, n[lang], -s))
    return rows


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(21)
    words = ["New", "york", "City", "the", "of", "é", "Ünder", "x\x00y", " ", "a", "İ", "run"] + [f"w{k}" for k in range(60)]
    texts = [None, "", " . ,\t;", "a " * 30_000, "one,two. New York!City"]
    for _ in range(260):
        line = [rng.choice(words[: rng.choice([6, 12, 72])]) for _ in range(rng.randint(1, 40))]
        if rng.random() < 0.4:
            line[rng.randrange(len(line)) : 0] = ["New", "York", "City"]
        texts.append("".join(w + rng.choice([" ", " ", " ", "\t", ". ", ",", "\n", "\r"]) for w in line))
    texts += texts[20:60]  # copies
    return [(t, [None, "en", "de", "en"][i % 4]) for i, t in enumerate(texts)]


@pytest.mark.parametrize("shard_bytes, top", [(1 << 24, 2000), (700, 15)])
def test_collocations_equal_brute_force(spark, prose, shard_bytes, top):
    """Large shards withhold phrases and are counted anew; small ones have a local support of 1."""
    docs = spark.createDataFrame([(i, t, lang, *OTHER) for i, (t, lang) in enumerate(prose)], DOCS).repartition(3)
    got = phrases.collocations(docs, support=10, top=top, shard_bytes=shard_bytes)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert set(map(tuple, got.collect())) == brute_collocations(prose, 10, top)
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_words_leave_no_garbage():
    """A worker reads shard after shard; what it numbered before must not wait for a full collection."""
    gc.collect()
    gc.disable()
    try:
        for _ in range(3):
            ids, words = phrases.word_ids([b"New york, new york", b"a b"])
        assert (ids.tolist(), words.to_pylist()) == ([0, 1, -1, 0, 1, -1, 2, 3, -1], [b"new", b"york", b"a", b"b"])
        assert gc.collect() == 0
    finally:
        gc.enable()


def test_counts_reach_the_jvm_in_blobs(spark, prose):
    """A row for each bucket of a shard, not for each phrase: no aggregate of the JVM holds the phrases."""
    docs = spark.createDataFrame(prose, "text string, lang string").where("lang IS NOT NULL AND text IS NOT NULL").coalesce(1)
    blobs = phrases._mined(docs, 2, [], 0, 1, 3, 1 << 24)
    summed = phrases._summed(blobs, 1, 3)
    assert blobs.count() <= 3 * 2 < summed.count()
    assert "Aggregate" not in summed._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("shard_bytes", [1 << 24, 700])
def test_collocations_of_many_buckets(spark, prose, shard_bytes, monkeypatch):
    """More buckets than tasks: a task sorts its own and adds up one after the other."""
    monkeypatch.setattr(phrases, "BUCKET_WORDS", 100)
    docs = spark.createDataFrame(prose, "text string, lang string").repartition(3)
    got = phrases.collocations(docs, support=10, shard_bytes=shard_bytes)
    assert set(map(tuple, got.collect())) == brute_collocations(prose, 10)


class OneWorker:
    """Stands for a table: keeps what it would run on each partition."""

    sparkSession = conf = property(lambda self: self)
    get = lambda self, key: "1"
    repartitionById = sortWithinPartitions = lambda self, *_: self

    def mapInArrow(self, run, schema):
        return run


@pytest.mark.parametrize("part, merge", [(1, 1), (2, 3), (1 << 16, 1 << 19)])
def test_blobs_add_up(part, merge, monkeypatch):
    """Parts, batches that are cut anywhere, merges in between, empty languages and words of any bytes."""
    monkeypatch.setattr(phrases, "PART_ROWS", part)
    monkeypatch.setattr(phrases, "MERGE_ROWS", merge)
    shards = [{"en": [b"a b a", b"x\x00y \xc3\xa9"], "": [b"a b"]}, {"en": [b"b", b""], "und": [b" . "]}, {"": [b"a " * 9]}]
    batches = iter([pa.RecordBatch.from_pylist([{"lang": g, "text": t.decode()} for g, own in s.items() for t in own]) for s in shards])
    sent = pa.Table.from_batches(phrases._counted(OneWorker(), 1, [], 5, 4)(batches)).combine_chunks()
    sent = sent.sort_by("bucket").combine_chunks().to_batches()[0]
    cut = [sent.slice(at, 2) for at in range(0, sent.num_rows, 2)]
    got = [r for b in phrases._summed(OneWorker(), 2, 5, with_words=True)(iter(cut)) for r in b.to_pylist()]
    assert sorted((r["lang"], r["phrase"], r["f"]) for r in got if r["phrase"] is not None) == [("", "a", 10), ("en", "a", 2), ("en", "b", 2)]
    n = Counter()
    for r in got:
        if r["phrase"] is None:
            n[r["lang"]] += r["f"]
    assert n == {"en": 6, "": 11, None: 17}


def test_exact_scores_beyond_64_bits(spark):
    wide = "CAST({} AS DECIMAL(19, 0))".format
    a = 4_000_000_007
    got = spark.sql(f"SELECT CAST(1000000 * ({wide(a)} * {wide(a)}) AS DECIMAL(38, 0)) div CAST({wide(a + 1)} * {wide(a + 2)} AS DECIMAL(38, 0)) AS s").first()["s"]
    assert got == 10**6 * a * a // ((a + 1) * (a + 2))


def test_the_filter_knows_what_was_put_in(spark):
    pairs = [("en", "new york"), ("und", "é ü"), ("de", "x" * 100 + " y"), ("", "a b")]
    known = phrases.Known.of(spark.createDataFrame(pairs, "lang string, phrase string"))
    hashed = lambda lang, phrase: phrases.phrase_hashes([phrases.word_hashes(lang, [w.encode()]) for w in phrase.split(" ")])
    assert all(known.has(hashed(*p))[0] for p in pairs)
    assert not known.has(phrases.phrase_hashes([phrases.word_hashes("en", [b"no%d" % k for k in range(1000)]), phrases.word_hashes("en", [b"york"] * 1000)])).any()
    assert not known.has(hashed("de", "new york"))[0]


# --- strings of a shard ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("sort_bytes", [1, 400, 1 << 20])
def test_strings_of_a_shard_are_sorted_in_parts(monkeypatch, sort_bytes):
    """Pieces around anchors: those of one anchor are sorted together, strings of their own are left out."""
    rng = random.Random(sort_bytes)
    monkeypatch.setattr(repeats, "SORT_BYTES", sort_bytes)
    monkeypatch.setattr(repeats, "PART_BYTES", 300)
    words = ["".join(rng.choice("abcd ") for _ in range(rng.randint(20, 60))) for _ in range(12)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(2, 8))).encode() for _ in range(60)]
    raw, ends = b"".join(texts), np.cumsum([len(t) for t in texts])
    with np.errstate(over="ignore"):
        first, count, _ = repeats.anchors(raw, ends, 50)
    body = np.frombuffer(raw, np.uint8)
    got = repeats.repeated_strings(body, first, count, 50)
    seen, want = set(), []
    for f, n in zip(first.tolist(), count.tolist(), strict=True):
        for at in range(f, f + n):
            want.append(raw[at : at + 50] in seen)
            seen.add(raw[at : at + 50])
    assert got.tolist() == want and 100 < sum(want) < len(want)


def test_pieces_with_equal_hashes_are_compared():
    body = np.frombuffer(b"aaaabbbbaaaacc", np.uint8)
    place, size = np.array([0, 4, 8, 12]), np.array([4, 4, 4, 2])
    same = repeats.equal_pieces(np.array([1, 1, 1, 2], np.uint64), body, place, size)
    assert same[0] == same[2] != same[1] and len(set(same.tolist())) == 3


# --- bounded training samples ----------------------------------------------------------------------------------------


def test_rare_and_copied_languages_are_learned(spark):
    rng = random.Random(2)
    make = lambda parts, n: " ".join("".join(rng.choice(parts) for _ in range(rng.randint(2, 4))) for _ in range(n))
    parts = {"en": ["the", "ing", "tion", "er"], "de": ["sch", "ung", "keit", "ein"], "rr": ["zab", "okw", "ylu"]}
    data = [(k, make(parts[lang := ["de", "en"][k % 2]], 60), lang) for k in range(800)]
    data += [(5000 + k, make(parts["rr"], 12), "rr") for k in range(6)]
    data += [(9000 + k, "lorem ipsum dolor sit amet consectetur", "cc") for k in range(3000)]
    data += [(20_000 + k, make(parts[lang := ["rr", "en"][k % 2]], 30), None) for k in range(60)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(4)
    model = language.train(docs)
    assert model.languages == ("cc", "de", "en", "rr") and len(model.dictionaries[1]) > 40_000 and len(model.dictionaries[3]) < 3000
    got = {r.doc_id: r.lang_pred for r in language.languages_of(docs).collect()}
    assert all(got[i] == (lang or ["rr", "en"][i % 2]) for i, _, lang in data)
    one = language.languages_of(docs.where("lang = 'de'"))
    assert {r.lang_pred for r in one.collect()} == {"de"}


def test_a_repeated_id_counts_once_in_training(spark, monkeypatch):
    rng = random.Random(3)
    good = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(80)) + "."
    bad = lambda: " ".join(rng.choice(["BUY!!", "$$$", "NOW", "offer", "###"]) for _ in range(rng.randint(20, 90)))
    data = [(k, good() if k % 2 else bad()) for k in range(200)] + [(1, bad())] * 3000
    labels = [(k, k % 2) for k in range(200)] + [(1, 1), (1, 1), (1, 0), (3, None), (None, 1), (5, 7)]
    docs, marks = spark.createDataFrame(data, "doc_id long, text string").repartition(4), spark.createDataFrame(labels, "doc_id long, quality int")
    seen = []
    real = quality_model.fit
    monkeypatch.setattr(quality_model, "fit", lambda x, y: seen.append(len(x)) or real(x, y))
    got = quality_model.quality_scores(docs, marks).dropDuplicates(["doc_id"]).collect()
    assert seen[0] <= 200
    assert sum(r.predicted == r.doc_id % 2 for r in got if r.doc_id != 1) >= 195


def test_long_words_that_sums_of_powers_confuse_stay_apart(spark):
    one = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    two = "".join("ba"[bin(k).count("1") % 2] for k in range(1024))
    a, b, c = shingles.shingle_sets([one, two, one.upper()], 4)
    assert a[0] != b[0] and a[0] == c[0]
    docs = spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard.jaccard_classes(docs, 4, 85).collect()} == {1: 1, 2: 2, 3: 1}
