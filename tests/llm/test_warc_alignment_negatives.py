"""The archive, alignment and hard-negative operators against plain versions."""

from __future__ import annotations

import base64
import collections
import hashlib
import io
import math
import random
import struct

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lumetra.llm import align, negatives, warc
from lumetra.session import scratch_path

RANKS, BYTES, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"))

# ---- archives ----

PAGES = [
    (3, "http://a/", "<p>x</p>"), (1, "http://b/\r\nX: y", "<p>x</p>"), (2, None, None), (7, "http://c/ü", ""), (4, "u", "ü😀\r\n\r\nWARC/1.1\r\n"),
    (5, "u", "long " * 40_000), (6, "u", "long " * 40_000), (8, "u", "<p>y</p>"), (8, "u", "<p>y</p>"), (None, "u", "<p>x</p>"), (None, "u", "n"),
]
PAGE_COLUMNS = "page_id long, url string, html string, record_id string, batch long, which int"


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "clash", 1, None) for r in rows], PAGE_COLUMNS)


def told_plainly(rows, revisit_from=0):
    out = collections.Counter()
    by_payload = collections.defaultdict(list)
    for page, _, html in rows:
        by_payload[(html or "").encode()].append(page)
    for payload, ids in by_payload.items():
        ids.sort(key=lambda i: (i is None, i))
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        for n, page in enumerate(ids):
            old = n > 0 and len(payload) >= revisit_from
            out[page, len(payload), digest, "revisit" if old else "response", ids[0] if old else None] += 1
    return out


@pytest.mark.parametrize("sizes", [{}, {"bundle_bytes": 1, "frame_bytes": 1}, {"bundle_bytes": 500, "frame_bytes": 300}, {"revisit_from": 9}])
def test_archives_read_back_as_written(spark, sizes):
    path = scratch_path(spark, "warc")
    warc.write(pages(spark), path, **sizes)
    rows = warc.read(spark, path).collect()
    got = collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows)
    assert got == told_plainly(PAGES, sizes.get("revisit_from", 0))
    assert len({r["record_id"] for r in rows}) == len(PAGES)
    texts = collections.Counter(bytes(r["payload"]) for r in rows if r["record_type"] == "response")
    assert set(texts) == {(h or "").encode() for _, _, h in PAGES}
    urls = {r["page_id"]: r["url"] for r in rows}
    assert urls[1] == "http://b/%0D%0AX:%20y" and urls[2] is None and urls[7] == "http://c/ü"


def test_a_bundle_is_a_plain_zstandard_stream_and_records_are_found_by_their_place(spark):
    path = scratch_path(spark, "warc")
    warc.write(pages(spark).coalesce(1), path, frame_bytes=1000)
    files = [r["content"] for r in spark.read.format("binaryFile").load(path).collect() if r["content"]]
    whole = b"".join(zstandard.ZstdDecompressor().stream_reader(io.BytesIO(f), read_across_frames=True).read() for f in files)
    assert whole.count(b"WARC-Record-ID") == len(PAGES)
    places = warc.index(spark, path)
    assert places.count() == len(PAGES) and places.select("frame").distinct().count() > 2
    asked = places.where("page_id IN (1, 4, 6)")
    got = {r["page_id"]: r for r in warc.fetch(asked).collect()}
    assert set(got) == {1, 4, 6} and bytes(got[4]["payload"]) == PAGES[4][2].encode() and got[6]["refers_to"] == 5
    assert warc.fetch(places.where("false")).count() == 0


def test_a_damaged_bundle_is_told():
    out = warc.BundleWriter(100, 3)
    out.add("<urn:x-page:1:0.0>", warc.record(1, "u", (0, 0), b"abc" * 50, 150, warc.base32(hashlib.sha1(b"abc" * 50).digest()), None, "d"))
    data = out.finish()
    (packed, size, checksum), _ = warc.seek_table(data[-9 - 24 :])
    assert warc.parse(warc.frame(data[:packed], size, checksum), 0)[0]["payload"] == b"abc" * 50
    with pytest.raises(ValueError, match="checksum"):
        warc.frame(data[:packed], size, checksum ^ 1)
    with pytest.raises(ValueError, match="no seek table"):
        warc.seek_table(data[:-1])


def test_an_empty_table_gives_an_empty_archive(spark):
    path = scratch_path(spark, "warc")
    warc.write(pages(spark, []), path)
    assert warc.read(spark, path).count() == 0 and warc.index(spark, path).count() == 0


# ---- alignment ----

DOCS = [
    (1, None), (2, ""), (3, "hello world"), (3, "hello world"), (4, "The quick brown fox, aged 12345, ünïcödé 😀 jumps.\n\n\tover"),
    (5, " "), (6, "▁x"), (7, "<|endoftext|> <s> </s> <unk> <0x41>"), (None, "hello world again"), (8, "x" * 3000), (9, " " * 300_000 + "a"),
    (10, "internationalization " * 500), (11, "\x00　﻿"),
    (12, " lead and  two\n next \n\tx \x1c y trail "), (13, "a ▁ b"), (14, "don't  it's\u00a0 we'll \u2028x\u0085 y"),
]


def aligned_plainly(rows):
    byte = Tokenizer.from_file(BYTES)
    byte.encode_special_tokens = True
    piece = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    letters = {c: b for b, c in enumerate(align.byte_letters())}
    docs, counts = [], collections.Counter()
    for doc, text in rows:
        a = byte.encode(" " + text, add_special_tokens=False).ids if text else []
        b = piece.encode(text) if text else []
        said_a = [bytes(letters[c] for c in byte.id_to_token(i)) for i in a]
        said_b = [bytes([int(p[3:5], 16)]) if piece.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [piece.id_to_piece(i)]]
        if not text or not b"".join(said_a) == b"".join(said_b) == (" " + text).encode():
            a = b = []
        ends = [np.cumsum([len(x) for x in (s if ids else [])]).tolist() for s, ids in ((said_a, a), (said_b, b))]
        shared = sorted(set(ends[0]) & set(ends[1]))
        groups, links, i, j = [], [], 0, 0
        for e in shared:
            m, n = ends[0].index(e, i) + 1, ends[1].index(e, j) + 1
            groups.append(",".join(map(str, a[i:m])) + "|" + ",".join(map(str, b[j:n])))
            links.append((a[m - 1], b[n - 1]))
            i, j = m, n
        counts.update(links)
        docs.append((doc, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    most = collections.defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return collections.Counter(
        (d, n_a, n_b, len(ls), len(ls), sum(counts[x] == most[x[1]] for x in ls), sum(counts[x] for x in ls), h) for d, n_a, n_b, ls, h in docs
    )


@pytest.mark.parametrize("sizes", [{}, {"tokens_per_batch": 1, "pairs_per_bucket": 3, "asks_per_group": 2}])
def test_alignment_equals_the_plain_one(spark, sizes):
    docs = spark.createDataFrame([(*d, "x", 1) for d in DOCS], "doc_id long, text string, batch string, n_a int")
    got = align.align(docs, RANKS, BYTES, PIECES, **sizes)
    assert got.columns == [c.split()[0] for c in align.ALIGNED.split(", ")]
    assert collections.Counter(map(tuple, got.collect())) == aligned_plainly(DOCS)


def test_alignment_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert align.align(docs, RANKS, BYTES, PIECES).count() == 0 and align.groups(docs, RANKS, BYTES, PIECES).count() == 0


def test_groups_cover_both_tokenizations(spark):
    docs = spark.createDataFrame(DOCS[:6], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in align.groups(docs, RANKS, BYTES, PIECES).collect()}
    assert rows[1]["ends_a"] == [] and len(rows) == 5
    for doc in (3, 4, 5):
        assert rows[doc]["ends_a"][-1] == len(rows[doc]["ids_a"]) - 1 and rows[doc]["ends_b"][-1] == len(rows[doc]["ids_b"]) - 1


def test_runs_find_all_shared_ends():
    rnd = random.Random(3)
    for _ in range(300):
        n = rnd.randrange(1, 300)
        a, b = (sorted({*rnd.sample(range(1, n + 1), rnd.randrange(0, n)), n}) for _ in range(2))
        if rnd.random() < 0.5:
            b = sorted({*a, *b[:2], n})
        at_a, at_b = align.group_ends([align.runs(np.array(a), np.array(b))])
        assert [a[i] for i in at_a] == [b[j] for j in at_b] == sorted(set(a) & set(b))
    assert align.runs(align.NONE, align.NONE) == [] and align.runs(np.array([1, 2, 3]), np.array([1, 2, 3])) == [(0, 0, 3)]


# ---- hard negatives ----


def mined_plainly(rows, asked, n_positives=5, k=10):
    out = []
    for anchor, label, v in dict.fromkeys(asked):
        others = [(i, other, sum(x * y for x, y in zip(v, w))) for i, other, w in rows if i != anchor]
        best = sorted(((-s, i) for i, other, s in others if other == label))[:n_positives]
        for ps, positive in ((-s, i) for s, i in best):
            near = sorted((-s, i) for i, other, s in others if other != label and 30 * ps <= 100 * s <= 90 * ps)[:k]
            out += [(anchor, positive, r + 1, i, ps, -s) for r, (s, i) in enumerate(near)]
    return collections.Counter(out)


def vectors(n, width, seed, spread):
    """Clustered vectors, with copies, zeros and vectors of other lengths; labels follow the clusters only in part."""
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    rows = []
    for i in range(n):
        c = rnd.randrange(5)
        x = [centres[c][d] + rnd.gauss(0, spread) for d in range(width)]
        x = [0.0] * width if i % 41 == 0 else x[: width // 2] if i % 37 == 0 else x
        rows.append((i, [float(np.float32(e)) for e in x], (c if rnd.random() < 0.7 else rnd.randrange(5))))
    rows += [(n + i, rows[i][1], rows[i][2]) for i in range(0, n, 9)] + [rows[3], rows[0], rows[10]]
    return rows


@pytest.mark.parametrize("spread", [0.05, 1.0])
@pytest.mark.parametrize("sizes", [{}, {"per_shard": 50, "per_block": 7}])
def test_negatives_equal_the_plain_ones(spark, spread, sizes):
    rows = vectors(300, 8, 5, spread)
    bad = [(900, None, 1), (None, [1.0] * 8, 1), (901, [1.0, None], 1), (902, [float("nan")] * 8, 1), (903, [1.0] * 8, None), (910, [float("inf")], 2)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows + bad], "vec_id long, embedding array<double>, label int, window string, shard int")
    prepared = negatives.prepared(frame)
    plain = [(i, label, tuple(math.floor(256 * x) for x in v)) for i, v, label in rows]
    got = negatives.mine(prepared, prepared.where("vec_id % 10 = 0"), **sizes)
    assert collections.Counter(map(tuple, got.collect())) == mined_plainly(plain, [r for r in plain if r[0] % 10 == 0])


def test_scores_beyond_doubles_are_whole(spark):
    rnd = random.Random(1)
    plain = [(i, i % 2, tuple(rnd.randrange(2**28, 2**29) for _ in range(3))) for i in range(40)]
    rows = spark.createDataFrame(plain, "vec_id long, label long, v array<long>")
    got = negatives.mine(rows, rows.where("vec_id < 10"))
    assert collections.Counter(map(tuple, got.collect())) == mined_plainly(plain, plain[:10])


def test_no_anchors_and_no_rows(spark):
    rows = spark.createDataFrame([(1, 1, [1, 2])], "vec_id long, label long, v array<long>")
    assert negatives.mine(rows, rows.where("false")).count() == 0
    assert negatives.mine(rows.where("false"), rows.where("false")).count() == 0
    assert negatives.mine(rows, rows).count() == 0


def test_bounds_hold_and_filter():
    rnd = np.random.default_rng(2)
    centres = rnd.normal(size=(4, 6)) * 500
    x = np.floor(centres[rnd.integers(0, 4, 400)] + rnd.normal(size=(400, 6)) * 20)
    directions = centres / np.linalg.norm(centres, axis=1)[:, None]
    norms = np.linalg.norm(x, axis=1)
    angles = np.arccos(np.clip(x @ directions.T / norms[:, None], -1, 1)).astype(np.float32).astype(np.float64)
    ruled_out = 0
    for a in range(0, 400, 7):
        low, high = negatives.bounds(norms[a], angles[a], norms, angles)
        scores = x @ x[a]
        assert (low <= scores).all() and (scores <= high).all()
        ruled_out += (high < 0.9 * norms[a] ** 2).sum()
    assert ruled_out > 57 * 200  # clusters apart are told by their angles


def test_windows_are_exact():
    for s in (-7, 0, 1, 3, 10, 11, 2**62):
        lo, hi = negatives.window(s, 30, 90)
        for n in {lo - 1, lo, hi, hi + 1, 0}:
            assert (lo <= n <= hi) == (30 * s <= 100 * n <= 90 * s)
