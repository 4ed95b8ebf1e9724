"""Alignment of two tokenizations of the same bytes by diagonal run skipping.

Both tokenizations of a text are ascending arrays of the byte offsets where their tokens end. Where the i-th end of one is
the (i + shift)-th of the other, and so are the next ones, both go along a diagonal: windows of doubling length are compared
at the current shift, and a whole stretch of one-to-one tokens is jumped at once. At a mismatch the two sides are advanced
in turn until their ends meet; that irregular group gives the new shift.

What a document's links need to know of the corpus is counted per batch of documents first: a batch names each distinct
id pair once, with its number of links. The counts of all pairs are a table bounded by the two vocabularies. It goes back to
the batches by buckets of pairs; a bucket is repeated for every so many batches, so that no group grows with the corpus.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lumetra.llm.asking import forget, kept, mix, pack, per_row, told, unpack
from lumetra.llm.asking import _dealt as dealt
from lumetra.llm.bpe import byte_letters
from lumetra.llm.common import id_and_text
from lumetra.llm.packing import BYTE_PATTERN

BATCHES = ("batch long, docs array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, groups_sha256 array<string>, "
           "sizes array<int>, pairs binary, counts binary, links binary, n_pairs long")
ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
GROUPS = "doc_id long, ends_a array<int>, ends_b array<int>, ids_a array<int>, ids_b array<int>"
LONG_SPACE = 100_000
FIRST_WIDTH = 16
NONE = np.empty(0, np.int64)
Runs = list[tuple[int, int, int]]


def runs(ends_a: np.ndarray, ends_b: np.ndarray) -> Runs:
    """(i, j, n): the groups of two ascending arrays of ends, in order; both arrays end alike. With n > 0 the tokens i to
    i + n - 1 and j to j + n - 1 are one-to-one; with n = 0, i and j are the last tokens of an irregular group.

    A window of ends is compared as one number: the lowest bit in which two windows differ lies in the first end that differs.
    """
    a, b = ends_a.astype("<u4"), ends_b.astype("<u4")  # a text is less than 2 GB
    (raw_a, list_a), (raw_b, list_b) = (a.tobytes(), a.tolist()), (b.tobytes(), b.tolist())
    number, i, j, n_a, out = int.from_bytes, 0, 0, len(a), []
    while i < n_a:
        start, width = i, FIRST_WIDTH
        while True:
            differ = number(raw_a[4 * i : 4 * (i + width)], "little") ^ number(raw_b[4 * j : 4 * (j + width)], "little")
            if differ:
                same = ((differ & -differ).bit_length() - 1) >> 5
                i, j = i + same, j + same
                break
            i, j, width = i + width, j + width, 2 * width
            if i >= n_a:  # the last window was cut off by the end
                i, j = n_a, j - (i - n_a)
                break
        if i > start:
            out.append((start, j - (i - start), i - start))
        if i == n_a:
            break
        x, y = list_a[i], list_b[j]
        while x != y:
            if x < y:
                i += 1
                x = list_a[i]
            else:
                j += 1
                y = list_b[j]
        out.append((i, j, 0))
        i, j = i + 1, j + 1
    return out


def group_ends(found: list[Runs], starts_a: np.ndarray | int = 0, starts_b: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The positions of the last tokens of the groups in the arrays of several texts in a row, which start where told."""
    sizes = list(map(len, found))
    i, j, n = np.fromiter(chain.from_iterable(chain.from_iterable(found)), np.int64, 3 * sum(sizes)).reshape(-1, 3).T
    i, j, n = i + np.repeat(starts_a, sizes), j + np.repeat(starts_b, sizes), np.maximum(n, 1)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(i, n) + within, np.repeat(j, n) + within


class Pair:
    """Both tokenizers: A byte-level (a rank file and the equal tokenizer file), B pieces with byte fallback."""

    def __init__(self, ranks: str, byte_file: str, pieces: str):
        with open(ranks, "rb") as f:
            by_rank = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self.a = tiktoken.Encoding("a", pat_str=BYTE_PATTERN, mergeable_ranks=by_rank, special_tokens={})
        self.byte_file, self.slow = byte_file, None
        self.bytes_a = [b""] * (max(by_rank.values()) + 1)
        for token, r in by_rank.items():
            self.bytes_a[r] = token
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.len_a, self.len_b = (np.array(list(map(len, t)), np.int64) for t in (self.bytes_a, self.bytes_b))
        # an id before another token of its side, and at the end of a group
        self.said_a, self.said_b = (np.array([f"{i}{c}" for c in "," + end for i in range(len(t))], object)
                                    for t, end in ((self.bytes_a, "|"), (self.bytes_b, ";")))

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def ids_a(self, text: str) -> np.ndarray:
        """The ids of A. The rank library gives up on very long white space; the file's own library does not."""
        if len(text) > LONG_SPACE and max(map(len, re.findall(r"\s+", text)), default=0) > LONG_SPACE:
            if self.slow is None:
                self.slow = Tokenizer.from_file(self.byte_file)
                self.slow.encode_special_tokens = True
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.int64)
        return np.array(self.a.encode_ordinary(text), np.int64)

    def __call__(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text, the ids of A for a space and the text, and of B for the text; none if either spells other bytes
        than these."""
        of_b = iter(self.b.encode([t for t in texts if t], num_threads=1))
        for text in texts:
            if text:
                raw = (" " + text).encode()
                a, b = self.ids_a(" " + text), next(of_b)
                # A cuts the bytes as they are: it could only leave some out
                if self.len_a[a].sum() == len(raw) and b"".join(map(self.bytes_b.__getitem__, b)) == raw:
                    yield a, np.array(b, np.int64)
                    continue
            yield NONE, NONE

    def runs(self, a: np.ndarray, b: np.ndarray) -> Runs:
        return runs(self.len_a[a].cumsum(), self.len_b[b].cumsum())

    def said(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> list[str]:
        """The strings of which ``a1,a2|b1;a3|b2,b3;`` is made, one by token: those of A before those of B in each group."""
        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        last_a[at_a], last_b[at_b] = True, True
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        out = np.empty(len(a) + len(b), object)
        out[np.arange(len(a)) + np.concatenate([[0], at_b + 1])[group_a]] = self.said_a[a + len(self.bytes_a) * last_a]
        out[np.arange(len(b)) + (at_a + 1)[group_b]] = self.said_b[b + len(self.bytes_b) * last_b]
        return out.tolist()


def _few(texts: list, size: int = 64) -> Iterator[list]:
    return (texts[i : i + size] for i in range(0, len(texts), size))


def groups(docs: DataFrame, ranks: str, byte_file: str, pieces: str) -> DataFrame:
    """``GROUPS``: the ids of both tokenizations of each text, and the positions of their tokens that end each group.

    Null and empty texts, and those that a tokenizer spells in other bytes, have none. Repeated rows are kept; other
    columns are not read. The three files have to be on every executor.
    """
    schema = pa.schema([("doc_id", pa.int64())] + [(n, pa.list_(pa.int32())) for n in ("ends_a", "ends_b", "ids_a", "ids_b")])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(ranks, byte_file, pieces)
        for batch in rows:
            docs_, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for doc, (a, b) in zip(docs_, chain.from_iterable(map(pair, _few(texts))), strict=True):
                columns = [[doc], *[[c] for c in (*group_ends([pair.runs(a, b)]), a, b)]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return id_and_text(docs).mapInArrow(run, GROUPS)


def _batches(docs: DataFrame, ranks: str, byte_file: str, pieces: str, tokens_per_batch: int) -> DataFrame:
    """Documents of a partition in batches of about ``tokens_per_batch`` tokens of A, stored. ``links`` are positions in the batch's
    distinct ``pairs`` (A's id in the upper, B's in the lower half), ``sizes`` the number of links by document."""
    names = [c.split()[0] for c in BATCHES.split(", ")]
    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
             "array<string>": pa.list_(pa.string())}
    types = [kinds[c.split()[1]] for c in BATCHES.split(", ")]

    def start(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, part, made = Pair(ranks, byte_file, pieces), TaskContext.get().partitionId(), 0
        docs_, ids_a, ids_b, found, sizes, n_a = [], [NONE], [NONE], [], [], 0

        def flush() -> pa.RecordBatch:
            a, b = np.concatenate(ids_a), np.concatenate(ids_b)
            of_a, of_b = ([len(x) for x in ids[1:]] for ids in (ids_a, ids_b))
            starts_a, starts_b = np.cumsum([0, *of_a]), np.cumsum([0, *of_b])
            at_a, at_b = group_ends(found, starts_a[:-1], starts_b[:-1])
            which, pairs = pd.factorize(a[at_a].astype(np.uint64) << np.uint64(32) | b[at_b].astype(np.uint64))
            tokens, upto = pair.said(a, b, at_a, at_b), starts_a + starts_b
            said = ["".join(tokens[x:y])[:-1] for x, y in zip(upto, upto[1:])]
            hashes = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in said]
            # only the last tokens of a group end together, so links are groups
            columns = [[part << 34 | made], [docs_], [of_a], [of_b], [sizes], [hashes], [sizes], [pairs.astype(np.uint64).tobytes()],
                       [pack(np.bincount(which, minlength=len(pairs)))], [pack(which)], [len(pairs)]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in rows:
            for few in _few(list(zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True))):
                for (doc, _), (a, b) in zip(few, pair([text for _, text in few]), strict=True):
                    mine = pair.runs(a, b)
                    found.append(mine)
                    sizes.append(sum(n or 1 for _, _, n in mine))
                    docs_.append(doc)
                    ids_a.append(a)
                    ids_b.append(b)
                    n_a += len(a)
                    if n_a >= tokens_per_batch or len(docs_) >= 100_000:
                        yield flush()
                        made += 1
                        docs_, ids_a, ids_b, found, sizes, n_a = [], [NONE], [NONE], [], [], 0
        if docs_:
            yield flush()

    return kept(id_and_text(docs).mapInArrow(start, BATCHES), "aligned")


class _Batch:
    """A row of ``_batches``; its pairs' keys are a bijection of theirs that spreads them evenly over buckets."""

    def __init__(self, row: dict):
        self.id, self.keys = row["batch"], mix(np.frombuffer(row["pairs"], np.uint64))


def _pair_counts(rows: DataFrame) -> DataFrame:
    """``a``, ``b``, ``n`` and ``best`` (whether no A id has more links with b) of all pairs, stored."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pairs = np.frombuffer(row["pairs"], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((pairs >> np.uint64(32)).astype(np.int32)), pa.array((pairs & np.uint64(0xFFFFFFFF)).astype(np.int32)),
                     pa.array(unpack(row["counts"]).astype(np.int64))], names=["a", "b", "n"],
                )

    n = kept(rows.select("pairs", "counts").mapInArrow(each, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n")), "counts")
    most = n.groupBy("b").agg(F.max("n").alias("most"))
    # one row per id of B: bounded by its vocabulary
    out = kept(n.join(F.broadcast(most), "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best")), "counts")
    forget(n)
    return out


def align(docs: DataFrame, ranks: str, byte_file: str, pieces: str, tokens_per_batch: int = 1_000_000,
          pairs_per_bucket: int = 1_000_000, asks_per_group: int = 256) -> DataFrame:
    """Per document, what its two tokenizations share (``ALIGNED``).

    A is the byte-level file's encoding of a space and the text, B the piece model's of the text. Their common byte offsets
    cut them into ``n_groups``; a pair of tokens that end together is a link. ``count_sum`` adds, over a document's links,
    the number of links of the same two ids in all documents; ``n_best`` are the links whose number is the highest of
    their B id, ties included. Null and empty texts, and those that a tokenizer spells in other bytes, have zeros and ''
    as ``groups_sha256``. Repeated rows are counted and kept each; an empty table gives no rows; other columns are not read.
    """
    rows = _batches(docs, ranks, byte_file, pieces, tokens_per_batch)
    counts = _pair_counts(rows)
    buckets = max(1, -(-counts.count() // pairs_per_bucket), rows.sparkSession.sparkContext.defaultParallelism)
    salts = max(1, -(-rows.count() // asks_per_group))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in batches:
            for row in record.to_pylist():
                batch = _Batch(row)
                order, at = dealt(batch.keys, buckets)
                for b in np.flatnonzero(np.diff(at)):
                    mine = batch.keys[order[at[b] : at[b + 1]]]
                    yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([batch.id], pa.int64()), pa.array([mine.tobytes()], pa.binary())],
                                                     names=["bucket", "batch", "keys"])

    def bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n, best = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "n", "best"))
            keys = mix(a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64))
            order, at = dealt(keys, buckets)
            told_ = n.astype(np.uint64) << np.uint64(1) | best.astype(np.uint64)
            for k in np.flatnonzero(np.diff(at)):
                mine = order[at[k] : at[k + 1]]
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([keys[mine].tobytes()], pa.binary()), pa.array([pack(told_[mine])], pa.binary())],
                                                 names=["bucket", "keys", "told"])

    def answer(asks: pa.Table, known: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(k, np.uint64) for k in known.column("keys").to_pylist()])
        values = np.concatenate([unpack(t) for t in known.column("told").to_pylist()])
        order = np.argsort(keys)
        keys, values = keys[order], values[order]
        out = [pack(values[np.searchsorted(keys, np.frombuffer(k, np.uint64))]) for k in asks.column("keys").to_pylist()]
        return pa.table({"batch": asks.column("batch"), "kind": pa.array([0] * len(out), pa.int32()), "bucket": asks.column("bucket"),
                         "answers": pa.array([[x] for x in out], pa.list_(pa.binary()))})

    salt = F.pmod(F.xxhash64("batch"), F.lit(salts)).cast("int").alias("salt")
    asks = rows.select("batch", "pairs").mapInArrow(ask, "bucket int, batch long, keys binary").select("*", salt)
    known = counts.mapInArrow(bucketed, "bucket int, keys binary, told binary").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    schema = "batch long, kind int, bucket int, answers array<binary>"
    # a bucket without asks of a salt gives no answers
    answers = kept(asks.groupBy("bucket", "salt").cogroup(known.groupBy("bucket", "salt")).applyInArrow(
        lambda x, y: answer(x, y) if x.num_rows else pa.table({
            "batch": pa.array([], pa.int64()), "kind": pa.array([], pa.int32()), "bucket": pa.array([], pa.int32()),
            "answers": pa.array([], pa.list_(pa.binary())),
        }), schema), "answers")
    forget(counts)

    def scores(row: dict, replies: list[dict]) -> pa.Table:
        batch = _Batch(row)
        of_link = told(replies, 0, batch.keys, buckets, 1)[0][unpack(row["links"]).view(np.int64)]
        starts = np.concatenate([[0], np.cumsum(np.asarray(row["sizes"], np.int64))])
        summed = lambda x: np.diff(np.concatenate([[0], np.cumsum(x.astype(np.int64))])[starts])
        return pa.table({
            "doc_id": pa.array(row["docs"], pa.int64()), "n_a": pa.array(row["n_a"], pa.int64()), "n_b": pa.array(row["n_b"], pa.int64()),
            "n_groups": pa.array(row["n_groups"], pa.int64()), "n_links": pa.array(row["sizes"], pa.int64()),
            "n_best": summed(of_link & np.uint64(1)), "count_sum": summed(of_link >> np.uint64(1)),
            "groups_sha256": pa.array(row["groups_sha256"], pa.string()),
        })

    return per_row(rows, answers, scores, ALIGNED)
