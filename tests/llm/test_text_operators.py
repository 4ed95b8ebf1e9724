"""The text operators against plain versions, on null, empty, repeated and clashing input and on empty tables."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import struct
import time
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lumetra.llm import bpe, html, lm, neardups, packing, pii, quality, substrings, topk, toxicity
from tests.llm import brute

WORDS, BYTES = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_near_duplicates_are_the_components_of_exact_links(spark):
    want = brute.components(brute.TEXTS, 4, 80)
    rows = neardups.classes(brute.frame(spark), size=4).collect()
    assert ids(rows) == sorted(i for i, _ in brute.TEXTS)
    for r in rows:
        assert r["component_id"] == want[r["doc_id"]] and r["kept"] == (want[r["doc_id"]] == r["doc_id"])
    sizes = collections.Counter((r["doc_id"], r["n_shingles"]) for r in rows)
    assert sizes == collections.Counter((i, len(brute.shingles(t, 4))) for i, t in brute.TEXTS)


def test_a_group_that_drifts_is_one_component_and_blocks_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(neardups, "BLOCK", 4)
    monkeypatch.setattr(neardups, "CENTRE_ROUNDS", 1)
    rnd, rows = random.Random(5), []
    words = [f"v{i}" for i in range(100)]
    for i in range(60):
        rows.append((i, " ".join(words)))
        words[rnd.randrange(100)] = f"n{i}"
    want = brute.components(rows, 4, 80)
    got = neardups.classes(brute.frame(spark, rows), size=4).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


@pytest.mark.parametrize("rounds", [0, 3])
def test_a_linked_pair_with_a_low_estimate_is_found(spark, monkeypatch, rounds):
    monkeypatch.setattr(neardups, "CENTRE_ROUNDS", rounds)
    words = [f"s22162w{i}" for i in range(103)]  # 80 of 100 shingles, estimate 0.63
    rows = [(1, " ".join(words)), (2, " ".join(words[:83]))]
    assert brute.components(rows, 4, 80) == {1: 1, 2: 1}
    assert {r["component_id"] for r in neardups.classes(brute.frame(spark, rows), size=4).collect()} == {1}


def test_bits_estimate_similarity():
    import numpy as np

    rnd = np.random.default_rng(1)
    base = rnd.integers(0, 2**63, 1000, dtype=np.uint64)
    functions = neardups._functions()
    for share in (1.0, 0.8, 0.3, 0.0):
        other = base.copy()
        n = round(1000 * (1 - share) / (1 + share)) if share else 1000
        other[:n] = rnd.integers(0, 2**63, n, dtype=np.uint64)
        a, b = (np.frombuffer(neardups.packed(neardups.minima(x, functions)), np.uint64) for x in (base, other))
        assert abs(neardups.estimate(a, b) - share) < 0.15


def test_repeated_passages(spark):
    want = brute.removed(brute.TEXTS, 13)
    got = substrings.digests(brute.frame(spark), 13).collect()
    digest = lambda kept: hashlib.sha256(" ".join(kept).encode()).hexdigest()
    assert sorted(map(tuple, got)) == sorted((i, len(w), len(w) - len(k), digest(k)) for i, w, k in want)
    texts = {(r["doc_id"], r["text"]) for r in substrings.remove(brute.frame(spark), 13).collect()}
    assert texts == {(i, t if w == k else " ".join(k)) for (i, t), (_, w, k) in zip(brute.TEXTS, want, strict=True)}


def test_language_model_counts_and_a_proper_distribution(spark):
    rows = [(i, t) for i, t in brute.TEXTS] + [(i, brute.BASE) for i in range(100, 140)]
    tokens = [(i, brute.WORD.findall((t or "").translate(brute.LOWER)) + [0]) for i, t in rows]
    out = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    counts = collections.Counter(w for i, ws in tokens if not out(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = sorted((i, out(i), len(ws), sum(counts[w] > 0 for w in ws), n) for i, ws in tokens)
    got = lm.score(brute.frame(spark, rows)).collect()
    assert sorted(tuple(r[:5]) for r in got) == want
    base = {i: sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws) for i, ws in tokens}
    assert all(math.isclose(r["base_score"], base[r["doc_id"]], rel_tol=1e-9) for r in got)
    seen = [r for r in got if r["doc_id"] >= 100 and r["held_out"]]
    assert seen and all(0 >= r["score"] > r["base_score"] for r in seen)


def test_language_model_scores_equal_the_plain_ones(spark):
    rnd = random.Random(21)
    common = [f"c{i}" for i in range(30)]
    rows = brute.TEXTS + [
        (100 + i, " ".join(rnd.choice(common) if rnd.random() < 0.8 else f"r{rnd.randrange(900)}" for _ in range(rnd.randint(0, 60))))
        for i in range(120)
    ] + [(None, "c1 c2 c3")]
    docs = brute.frame(spark, rows)
    by_id = {r["doc_id"]: r["w"] for r in docs.selectExpr("doc_id", "pmod(xxhash64(doc_id, 3), 10) = 0 AS w").collect()}
    folds = ["test" if i is not None and zlib.crc32(str(i).encode()) % 7 == 2 else "weigh" if by_id[i] else "learn" for i, _ in rows]
    assert {"test", "learn", "weigh"} == set(folds)
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(((r["doc_id"], r["score"]) for r in lm.score(docs).collect()), key=order)
    want = sorted(zip([i for i, _ in rows], brute.interpolated(rows, folds)), key=order)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert all(math.isclose(a, b, rel_tol=1e-9) for (_, a), (_, b) in zip(got, want, strict=True))


def test_rows_without_an_id(spark):
    long = " ".join(f"q{i}" for i in range(30))
    rows = [(None, brute.BASE), (None, None), (3, brute.BASE), (5, brute.BASE), (7, long), (None, long)]
    docs = brute.frame(spark, rows)
    got = sorted(map(tuple, neardups.classes(docs, size=4).collect()), key=repr)
    n = len(brute.shingles(brute.BASE, 4))
    assert got == sorted([(None, n, None, True), (None, 0, None, True), (3, n, 3, True), (5, n, 3, False), (7, 27, 7, True),
                          (None, 27, None, True)], key=repr)
    assert sorted(map(repr, (r[0] for r in neardups.keep_one(docs).collect()))) == ["3", "7", "None", "None", "None"]
    gone = sorted(((r["doc_id"], r["n_words"], r["n_removed"]) for r in substrings.digests(docs).collect()), key=repr)
    assert gone == sorted([(None, 60, 0), (None, 0, 0), (3, 60, 0), (5, 60, 60), (7, 30, 0), (None, 30, 0)], key=repr)
    assert [r["held_out"] for r in lm.score(docs).collect() if r["doc_id"] is None] == [False] * 3


def test_stages_take_columns_called_as_their_own(spark):
    names = ("_gone", "_doc", "_mark", "_spans", "_bit", "_bits", "_word", "row", "kept", "component_id")
    rows = [(i, brute.BASE if i < 3 else " ".join([f"t{i}", brute.BASE, *(f"e{i}x{j}" for j in range(36))]), *[f"{n}{i}" for n in names]) for i in range(1, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    kept = neardups.keep_one(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {1, 3, 4}
    cut = {r["doc_id"]: r for r in substrings.remove(docs).collect()}
    plain = {i: " ".join(words) for i, _, words in brute.removed([r[:2] for r in rows], 13)}
    assert {i: " ".join(r["text"].split()) for i, r in cut.items()} == plain and cut[2]["text"] == ""
    assert all(tuple(r)[2:] == tuple(f"{n}{i}" for n in names) for i, r in cut.items())


def test_weights_come_from_expectation_maximisation():
    weights = lm.learn_weights([(5, 0, -20, 90.0), (5, 1, -20, 10.0)], 1e-6)
    assert weights.sum(axis=1) == pytest.approx(1) and 0.85 < weights[5][0] < 0.93


def test_word_bpe_equals_the_library():
    reference, own, rnd = Tokenizer.from_file(WORDS), bpe.WordBpe(WORDS), random.Random(3)
    texts = ["", " ", "a" * 3000, "ΑΣ İstanbul it's we'LL", "x<|endoftext|>Y <|startoftext|>", "\x1c\x85a　b", "é é", "日本 🤣🤣 ½"]
    texts += ["".join(rnd.choice("abcdehinorst .'ÀéÜ1🤣\n") for _ in range(rnd.randint(1, 300))) for _ in range(200)]
    texts += ["".join(rnd.choice("aeinorst") for _ in range(2000)) for _ in range(5)]
    for t in texts:
        want = reference.encode(t, add_special_tokens=False).ids
        assert own.run(t) == (struct.pack(f"<{len(want)}I", *want), reference.decode(want, skip_special_tokens=False))


def test_transducer_keeps_a_bounded_window_and_the_decoder_holds_back_partial_characters():
    encoder, most = bpe.Encoder(bpe.Merges(WORDS)), 0
    for _ in encoder.feed("thequickbrownfox" * 2000):
        most = max(most, len(encoder.text))
    assert most <= 4 * encoder.m.lookahead
    decoder = bpe.Decoder(bpe.Merges(BYTES))
    text = "héllo 🤣 wörld"
    parts = [decoder.feed([i]) for i in Tokenizer.from_file(BYTES).encode(text).ids]
    assert "".join(parts) + decoder.finish() == text


def test_round_trip_of_rows(spark):
    got = bpe.round_trip(brute.frame(spark), WORDS).collect()
    assert ids(got) == sorted(i for i, _ in brute.TEXTS)
    assert all((r["ids"], r["decoded"]) == (b"", "") for r in got if r["doc_id"] in (1, 2, 3))


def test_digests_equal_the_library_row_by_row(spark):
    reference, rnd = Tokenizer.from_file(WORDS), random.Random(11)
    texts = brute.TEXTS + [(300 + i, "".join(rnd.choice("aeinorst ÀéΣ'.1🤣\n\x1d") for _ in range(rnd.randint(0, 4000)))) for i in range(60)]
    texts += [(400, "Word, word! " * 60_000), (401, "ab" * 150_000), (402, "a <|endoftext|>" * 20_000), (403, "é" * 270_000)]
    want = []
    for i, t in texts:
        ids = reference.encode(t or "", add_special_tokens=False).ids
        said = reference.decode(ids, skip_special_tokens=False)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        want.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(said.encode()).hexdigest()))
    got = [tuple(r) for r in bpe.digests(brute.frame(spark, texts), WORDS).collect()]
    assert sorted(got) == sorted(want)


def test_pieces_and_packing(spark):
    texts = brute.TEXTS + [(200 + i, "word " * (i * 37)) for i in range(90)]
    rows = packing.pack_documents(brute.frame(spark, texts), RANKS, {"<|endoftext|>": 50256}).collect()
    reference = Tokenizer.from_file(BYTES)
    want = collections.Counter()
    for i, t in texts:
        tokens = reference.encode(t or "", add_special_tokens=False).ids + [0]
        cuts = [0, *range((len(tokens) - 1) % 2048 + 1, len(tokens) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *tokens[a:b]))] += 1
    assert collections.Counter(tuple(r[:5]) for r in rows) == want
    places = collections.defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for found in places.values():
        ends = [0]
        for offset, length in sorted(found):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 2048
    assert len(places) <= math.ceil(sum(r["length"] for r in rows) / 2048) + 1


def _fewest(lengths, capacity):
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for j in range(len(rooms)):
            if rooms[j] >= lengths[i]:
                place(i + 1, [*rooms[:j], rooms[j] - lengths[i], *rooms[j + 1 :]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best


def test_dominance_never_costs_a_sequence():
    rnd = random.Random(2)
    for _ in range(150):
        lengths = sorted((rnd.randint(1, 12) for _ in range(rnd.randint(1, 8))), reverse=True)
        fixed, rest = packing.reduce_by_dominance(collections.Counter(lengths), 12)
        left = [s for s, n in rest.items() for _ in range(n)]
        assert sum(n for n, _ in fixed) + _fewest(sorted(left, reverse=True), 12) == _fewest(lengths, 12)


def test_quality_ledger_policies_and_ablation(spark):
    entries = quality.ledger(brute.frame(spark))
    rows = {r["doc_id"]: r for r in entries.collect()}
    assert [rows[1][m] for m in quality.MEASURES] == [0] * 6 and rows[1]["failed"] & 1
    assert rows[10]["n_repeat_words"] == 40 and rows[6]["failed"] == 0
    kept = {r["doc_id"] for r in quality.apply_policy(entries.drop("kept"), "v1").where("kept").collect()}
    assert kept == {i for i, r in rows.items() if r["failed"] & quality.mask("v1") == 0}
    table = {r["rule"]: r for r in quality.ablation(entries).collect()}
    failed = [r["failed"] for r in entries.collect()]
    for rule in quality.RULES:
        bit = 1 << rule.bit
        assert table[rule.name][1:] == (
            sum(f & bit > 0 for f in failed), sum(f == bit for f in failed), sum(f & ~bit == 0 for f in failed))


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind, match):
    digits = [int(c) for c in match if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def test_confirmed_personal_data(spark):
    texts = [
        (1, None), (2, ""), (3, "a@b@c.d é a@b.c_d@e.f x@y"), (4, "1.2.3.4.5.6.7.8 300.1.1.1 0300.1.1.1 001.2.3.4"),
        (5, "4111 1111 1111 1111 and 4111-1111-1111-1112"), (6, "+1 (988) 555-2485 +12 +49 30 1234567"), (6, "ü😀 x.y@z.com"),
        (7, "a" * 20000 + "@b.c"), (8, "1" * 20000), (9, "+1" + " " * 5000),
    ]
    want = []
    for i, t in texts:
        found = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PATTERNS.items())
                 for m in re.finditer(p, t or "") if _valid(kind, m[0])]
        want.append((i, ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))))
    assert sorted((r["doc_id"], r["base"]) for r in pii.find(brute.frame(spark, texts)).collect()) == sorted(want)
    redacted = {r["doc_id"]: r["text"] for r in pii.redact(brute.frame(spark, texts)).collect()}
    assert redacted[1] is None and redacted[5] == "[CARD] and 4111-1111-1111-1112"


def test_trees_add_likely_spans_and_nothing_else(spark):
    rnd = random.Random(4)
    card = lambda ok: next(c for c in iter(lambda: str(rnd.randrange(4 * 10**15, 5 * 10**15)), "") if _valid("card", c) == ok)
    texts = [(i, f"pay by card {card(i % 300 > 0)} today, room {rnd.randrange(10**11, 10**12 - 1)}x") for i in range(600)]
    rows = {r["doc_id"]: r for r in pii.find(brute.frame(spark, texts)).collect()}
    assert "card:12:28" in rows[300]["spans"] and "card:12:28" not in rows[300]["base"]
    assert all(set(filter(None, r["base"].split(","))) <= set(r["spans"].split(",")) for r in rows.values())


def test_texts_of_many_spans(spark):
    """Time grows with the spans of a text, parts of an address may be 0, and the redacted text is whole."""
    hosts = "".join(f"10.0.{i % 256}.{i % 300} é " for i in range(20_000))
    texts = [(1, "a@b.c " * 30_000), (2, hosts), (3, "1 " * 50_000), (4, "0123-555-2485 x " * 5_000), (5, "call +1 988 555 2485")]
    rows = {r["doc_id"]: r for r in pii.find(brute.frame(spark, texts)).collect()}
    for i, text in texts:
        found = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PATTERNS.items())
                 for m in re.finditer(p, text) if _valid(kind, m[0])]
        assert rows[i]["base"] == ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))
    redacted = {r["doc_id"]: r["text"] for r in pii.redact(brute.frame(spark, texts)).collect()}
    assert redacted[1] == "[EMAIL] " * 30_000
    for i, text in texts:
        out, at = [], 0
        for kind, a, b in (s.split(":") for s in filter(None, rows[i]["spans"].split(","))):
            if int(a) >= at:
                out += [text[at : int(a)], f"[{kind.upper()}]"]
            at = max(at, int(b))
        assert redacted[i] == "".join(out) + text[at:]


def test_columns_may_be_called_as_the_operator_calls_its_own(spark):
    row = (1, "mail a@b.c", "x", "y", "z", "v")
    docs = spark.createDataFrame([row], "doc_id long, text string, _text string, _base string, `_spans` string, `a.b` string")
    assert tuple(pii.redact(docs).first()) == (1, "mail [EMAIL]", "x", "y", "z", "v")


def _loose_texts(often):
    """Per kind a few confirmed spans, ``often`` times as many in looser forms, and numbers that are neither."""
    rnd, texts = random.Random(8), []
    card = lambda: next(c for c in iter(lambda: str(rnd.randrange(4 * 10**15, 5 * 10**15)), "") if _valid("card", c))
    ip = lambda sep: sep.join([*(str(rnd.randrange(100, 256)) for _ in range(3)), str(rnd.randrange(10, 100))])
    digits = lambda n: str(rnd.randrange(10 ** (n - 1), 10**n))
    for _ in range(15):
        c = card()
        texts += [("base", t) for t in (f"+1 ({digits(3)}) 555-{digits(4)}", f"hein.{digits(2)}@mail{digits(1)}.example.com", c, ip("."))]
    for _ in range(15 * often):
        c = card()
        texts += [("phone", f"{digits(3)}-555-{digits(4)}"), ("email", "jane (at) example (dot) org"),
                  ("card", ".".join(c[i : i + 4] for i in range(0, 16, 4))), ("ip", ip(","))]
        texts += [("", t) for t in (f"{digits(10)}", f"a{digits(11)}b", f"2024-0{digits(1)}-1{digits(1)} 1{digits(1)}", "1,999,300,777", "1,2,3,4,5,6")]
    return texts


@pytest.mark.parametrize("often", [1, 20])
def test_frequent_loose_forms_are_found_and_other_numbers_are_not(spark, often):
    texts = _loose_texts(often)
    rows = enumerate(f"word nr{i % 7} is {t} and so on" for i, (_, t) in enumerate(texts))
    got = {r["doc_id"]: (r["base"], r["spans"]) for r in pii.find(brute.frame(spark, list(rows))).collect()}
    for i, (kind, t) in enumerate(texts):
        base, spans = got[i]
        assert bool(base) == (kind == "base"), t
        if kind == "base":
            assert spans == base, t
        else:
            start = len(f"word nr{i % 7} is ")
            assert spans == (f"{kind}:{start}:{start + len(t)}" if kind else ""), t


def test_toxicity_ranks_held_out_documents(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    toxic, clean = ([r["score"] for r in scored if r["toxic"] == t] for t in (1, 0))
    wins = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert wins > 0.8
    assert sum(r["predicted"] for r in scored if r["toxic"] == 0) <= 0.1 * len(clean)
    none = toxicity.score(brute.frame(spark), toxicity.fit(brute.frame(spark), labels.limit(0)))
    assert {r["predicted"] for r in none.collect()} == {0}


def test_a_low_rate_still_samples_unlabelled_documents(spark):
    docs = spark.range(20_000_000).selectExpr("id AS doc_id", "'x' AS text")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert 1 <= toxicity.sample(docs, labels, 10, 6, 7)[0].count() <= 20


def test_large_scores_are_exact(spark):
    big = 2**31
    rows = [(0, [big, big, 1]), (1, [big, -big, 5]), (2, [big, 1, 0]), (3, [big, 1, 1]), (4, [-big, -big, 0]), (5, [big, 1, 1])]
    vectors = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = topk.top_k(vectors, vectors.where("vec_id = 0"), k=5).collect()
    scored = sorted((-sum(a * b for a, b in zip(rows[0][1], v, strict=True)), i) for i, v in rows[1:])
    assert sorted(map(tuple, got)) == [(0, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    beyond = spark.createDataFrame([(0, [2**62, 1]), (1, [4, 0])], "vec_id long, v array<long>")
    with pytest.raises(Exception, match="beyond the longs"):
        topk.top_k(beyond, beyond.where("vec_id = 0")).collect()


def test_top_k_equals_sorting(spark):
    rnd = random.Random(6)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(8)]) for i in range(400)] + [(i, [0.5] * 8) for i in range(400, 440)]
    rows += [(500, None), (501, [1.0, None]), (502, [float("nan")]), (None, [1.0]), (600, [])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, rank string")
    vectors = topk.whole_numbers(frame)
    whole = {r["vec_id"]: r["v"] for r in vectors.collect()}
    got = topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10, per_shard=64, per_block=2).collect()
    want = []
    for q in (i for i in whole if i % 100 == 0):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], whole[c], strict=False)), c) for c in whole if c != q)
        want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored[:10])]
    assert sorted(map(tuple, got)) == sorted(want)
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header>Site</header><nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="ad">Buy the best of it now</div>
<article><h1>Of &amp; on</h1><p><b>The cat\n is&nbsp;on the mat, and it was there for a long time; that is all of it.<br><p>Short.
<aside>See also this one and that one</aside><p>A &lt;tag&gt; &#233;</p><section class="comments"><p>I like this</p></section></article>
<form>Name <input></form><!-- x --><footer>&copy; Site</footer>"""


def test_main_text(spark):
    want = "Of & on\n\nThe cat is on the mat, and it was there for a long time; that is all of it.\n\nShort.\n\nA <tag> é"
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "v", ""), (4, "w", "<p>x" * 3), (5, "w", "<a \"" * 2000)]
    frame = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in html.extract(frame).collect())
    assert got[:2] == [(1, want, len(want))] * 2 and got[2:4] == [(2, "", 0), (3, "", 0)] and len(got) == 6


POLISH = "Wczoraj rano mała dziewczynka poszła przez ciemny las, gdzie spotkała starego wilka, który czytał gazetę."


@pytest.mark.parametrize("page,want", [
    (f"<nav><a href=x>Dom</a></nav><p>{POLISH}</p><div>{POLISH}</div><p>© Strona</p>", [POLISH, POLISH]),
    (f"<p>{'The cat is on the mat and it was there for all of it. ' * 3}</p><pre>{'alpha = beta + gamma; ' * 6}</pre>", [0, 1]),
    (f"<p>{'The cat is on the mat and it was there for all of it. ' * 4} © in the text</p>", [0]),
    (f"<article><p>Text</p></article><p>{POLISH}</p>", ["Text"]),
])
def test_plain_blocks_with_few_known_words_are_kept(page, want):
    texts = [b.text for b in html.blocks(page)]
    assert html.main_text(page) == "\n\n".join(texts[x] if isinstance(x, int) else x for x in want)


@pytest.mark.parametrize("run", [
    lambda d: neardups.classes(d), lambda d: substrings.digests(d), lambda d: lm.score(d), lambda d: bpe.digests(d, WORDS),
    lambda d: packing.pack_documents(d, RANKS, {}), lambda d: quality.ledger(d), lambda d: pii.find(d), lambda d: pii.redact(d),
])
def test_empty_tables(spark, run):
    assert run(brute.frame(spark).limit(0)).count() == 0


# ---- long texts ----


@pytest.mark.parametrize("text", [" " * 1_200_000 + "a", "x " + " \n" * 100_001 + "y<|endoftext|>", "a" + "\n" * 150_000, "\u3000" * 100_005 + " c"])
def test_long_white_space_is_encoded_as_the_library_does(text):
    encoding = packing.byte_encoding(RANKS, {"<|endoftext|>": 50256})
    assert packing.encode(encoding, text).tolist() == Tokenizer.from_file(BYTES).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("page", ["<div>x" * 100_000, "<div><p>x" * 50_000 + "</b></ul>" * 50_000, "<header>" * 50_000 + "y"])
def test_deep_pages_take_seconds(page):
    start = time.perf_counter()
    html.main_text(page)
    assert time.perf_counter() - start < 20


def test_articles_stay_whole():
    short = [f"Plain paragraph number {i} of forty letters" for i in range(20)]
    assert html.main_text("<body>" + "".join(f"<p>{t}</p>" for t in short)) == "\n\n".join(short)
    colours = " ".join(["gelb", "blau"] * 16)
    assert html.main_text(f"<article><p>{colours}</p><ul><li><a href=x>a link</a></li></ul></article>") == f"{colours}\n\na link"
    said = "Let <math><mi>x</mi></math> and <object>this</object> be some of the terms that are in the sum of all of these"
    assert html.main_text(f"<article><p>{said}</p></article>") == re.sub("<[^>]*>", "", said)
    assert "text" not in html.main_text("<p>" + "the of and is in to a " * 10 + "</p><iframe src=http://x/>text</iframe>")
    assert html.main_text("") == "" == html.main_text("<nav><a href=x>menu</a></nav>")


def test_toxicity_and_the_pipeline_on_an_empty_table(spark, tmp_path):
    docs, labels = brute.frame(spark).limit(0), spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.fit(docs, labels)).count() == 0
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_empty_pages_table(spark):
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_spans_are_joined_with_texts_that_have_some(spark):
    docs = brute.frame(spark)
    plan = substrings._with_spans(docs.select("doc_id", "text"), 13, "doc_id", "text")
    rows = plan.collect()
    assert len(rows) == len(brute.TEXTS) and any(r["_spans"] for r in rows) and any(r["_spans"] is None for r in rows)
