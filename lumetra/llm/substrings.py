"""Removal of long repeated passages by a compacted de Bruijn graph.

Every window of ``k`` words is an edge between the k - 1 words at its start and those at its end. Only windows that more
than one document holds are kept. Where all documents that hold such an edge go on with the same next edge, the two are
one path; a join on the nodes finds out where that is so. Each passage in common so becomes a few paths, and a join on the
paths finds the first document of each. All other documents lose the words at the path's source coordinates. A path is
told by its first window, its length and a second hash of all its words, so a wrong match of windows does not count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumetra.llm.asking import (
    Batch, Questions, answer, ask, batches, bucket_count, forget, kept, mix, pack, per_row, told, total, unpack,
)
from lumetra.llm.common import per_batch

WINDOW, NODE, PATH = 0, 1, 2
RUNS = ("batch long, docs array<long>, marks array<long>, starts array<int>, sizes array<int>, words binary, tokens binary, "
        "n_edges long")
PATHS = ("batch long, docs array<long>, marks array<long>, paths binary, owners binary, starts binary, sizes binary, "
         "n_paths long")
SPANS = "_doc long, _mark long, _spans array<struct<start:int,end:int>>"


def window_hashes(words: np.ndarray, k: int, seed: int) -> np.ndarray:
    """A hash of each window of ``k`` words, by its start; windows may run over the end of a document."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    spread = mix(words ^ np.uint64(seed))
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + spread[i : i + n]
    return mix(out)


def _windows(b: Batch, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows within documents, and their starts among the batch's words."""
    hashes = window_hashes(b.words, k, 1)
    inside = np.flatnonzero(b.doc[: len(hashes)] == b.doc[k - 1 :])
    return hashes[inside], inside


class _Runs:
    """A row of runs (stretches of windows in common) as arrays over all of its edges, or nodes."""

    def __init__(self, row: dict, k: int):
        self.id, self.docs, self.marks = row["batch"], row["docs"], row["marks"]
        self.starts, self.sizes = np.asarray(row["starts"], np.int64), np.asarray(row["sizes"], np.int64)
        words = np.frombuffer(row["words"], np.uint64)[unpack(row["tokens"]).view(np.int64)]
        self.run = np.repeat(np.arange(len(self.sizes)), self.sizes)  # of each edge
        self.first = np.cumsum([0, *self.sizes[:-1]]) if len(self.sizes) else np.empty(0, np.int64)
        self.place = np.arange(len(self.run)) - self.first[self.run]  # in its run
        at = np.arange(len(self.run)) + self.run * (k - 1)  # of each edge's first word
        self.edges, self.checks = window_hashes(words, k, 1)[at], window_hashes(words, k, 3)[at]
        self.node = np.arange(len(self.run)) + self.run  # the node at the start of each edge
        ends = self.first + self.sizes + np.arange(len(self.sizes))  # the last node of each run
        nodes = window_hashes(words, k - 1, 2)
        self.nodes = np.empty(len(self.run) + len(self.sizes), np.uint64)
        self.nodes[self.node] = nodes[at]
        self.nodes[ends] = nodes[np.cumsum(self.sizes + k - 1) - (k - 1)]

    def sides(self) -> tuple[np.ndarray, np.ndarray]:
        """For each node, the edge into it and the edge out of it along the run; 0 where the run starts or ends."""
        into, out = np.zeros(len(self.nodes), np.uint64), np.zeros(len(self.nodes), np.uint64)
        out[self.node], into[self.node + 1] = self.edges, self.edges
        return into, out


def _shared_runs(rows: DataFrame, k: int) -> DataFrame:
    """For each batch, the stretches of windows that other documents seem to hold too, stored."""
    n = total(rows, "n_tokens")
    buckets = bucket_count(rows, n)
    # windows are only candidates here, so a shorter hash does: of a thousand windows less than one is taken for another
    drop = np.uint64(64 - min(64, int(n).bit_length() + 12))

    def ask_windows(b: Batch) -> Questions:
        hashes, at = _windows(b, k)
        keys, which = np.unique(hashes >> drop, return_inverse=True)
        ids = np.asarray(b.docs, np.int64)[b.doc[at]]
        low, high = np.full(len(keys), np.iinfo(np.int64).max), np.full(len(keys), np.iinfo(np.int64).min)
        np.minimum.at(low, which, ids)
        np.maximum.at(high, which, ids)
        return [(WINDOW, keys, [(low != high).astype(np.uint64)])]

    def shared(_: int, which: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
        return [((np.bincount(which) > 1) | (np.bincount(which, weights=values[0]) > 0)).astype(np.uint64)]

    def runs(row: dict, replies: list[dict]) -> pa.Table:
        b = Batch(row)
        hashes, at = _windows(b, k)
        keys, which = np.unique(hashes >> drop, return_inverse=True)
        at = at[told(replies, WINDOW, keys, buckets, 1)[0][which] > 0]
        doc = b.doc[at]
        first = np.flatnonzero(np.append(True, (np.diff(at) != 1) | (np.diff(doc) != 0))[: len(at)])
        sizes, starts = np.diff(np.append(first, len(at))), at[first]
        lengths = sizes + k - 1
        place = np.repeat(starts - np.cumsum([0, *lengths[:-1]])[: len(starts)], lengths) + np.arange(lengths.sum())
        used, tokens = np.unique(b.tokens[place], return_inverse=True)
        owner = doc[first]
        return pa.table({
            "batch": pa.array([b.id], pa.int64()),
            "docs": pa.array([[b.docs[d] for d in owner]], pa.list_(pa.int64())),
            "marks": pa.array([[b.marks[d] for d in owner]], pa.list_(pa.int64())),
            "starts": pa.array([(starts - b.starts[owner]).astype(np.int32)], pa.list_(pa.int32())),
            "sizes": pa.array([sizes.astype(np.int32)], pa.list_(pa.int32())),
            "words": pa.array([b.vocabulary[used].tobytes()], pa.binary()), "tokens": pa.array([pack(tokens)], pa.binary()),
            "n_edges": pa.array([len(at)], pa.int64()),
        })

    answers = answer(ask(rows, Batch, ask_windows, buckets), shared)
    found = kept(per_row(rows, answers, runs, RUNS), "runs")
    forget(answers)
    return found


def _compacted(found: DataFrame, k: int) -> DataFrame:
    """For each batch, the paths that its runs fall into, stored. A path's key covers its length and a second hash of
    all its words, so that only occurrences that read the same have the same key."""
    buckets = bucket_count(found, total(found, "n_edges"))
    read = lambda row: _Runs(row, k)

    def range_of(which: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = int(which.max(initial=-1)) + 1
        low, high = np.full(n, np.uint64(2**64 - 1)), np.zeros(n, np.uint64)
        np.minimum.at(low, which, values)
        np.maximum.at(high, which, values)
        return low, high

    def ask_nodes(r: _Runs) -> Questions:
        into, out = r.sides()
        # 40 bits that stand for the way through the node, 0 where a run starts or ends there
        way = np.where((into != 0) & (out != 0), mix(into + mix(out)) >> np.uint64(24) | np.uint64(1), np.uint64(0))
        keys, which = np.unique(r.nodes, return_inverse=True)
        low, high = range_of(which, way)
        return [(NODE, keys, [np.where(low == high, low, np.uint64(0))])]

    def one_way(_: int, which: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
        """Nodes that all documents pass in the same way."""
        low, high = range_of(which, values[0])
        return [((low == high) & (low != 0)).astype(np.uint64)]

    def compact(row: dict, replies: list[dict]) -> pa.Table:
        r = _Runs(row, k)
        keys, which = np.unique(r.nodes, return_inverse=True)
        through = told(replies, NODE, keys, buckets, 1)[0][which] > 0
        at = np.flatnonzero(~through[r.node] | (r.place == 0))
        sizes = np.diff(np.append(at, len(r.edges)))
        step = (np.arange(len(r.edges)) - np.repeat(at, sizes)).astype(np.uint64)
        check = np.add.reduceat(mix(r.checks + step), at) if len(at) else np.empty(0, np.uint64)
        paths = mix(r.edges[at] + mix(check + sizes.astype(np.uint64)))
        owners = r.run[at]
        return pa.table({
            "batch": pa.array([r.id], pa.int64()), "docs": pa.array([r.docs], pa.list_(pa.int64())),
            "marks": pa.array([r.marks], pa.list_(pa.int64())), "paths": pa.array([paths.tobytes()], pa.binary()),
            "owners": pa.array([pack(owners)], pa.binary()), "starts": pa.array([pack(r.starts[owners] + r.place[at])], pa.binary()),
            "sizes": pa.array([pack(sizes)], pa.binary()), "n_paths": pa.array([len(at)], pa.int64()),
        })

    answers = answer(ask(found, read, ask_nodes, buckets), one_way)
    paths = kept(per_row(found, answers, compact, PATHS), "paths")
    forget(answers)
    return paths


class _Paths:
    """A row of paths as arrays."""

    def __init__(self, row: dict):
        self.id, self.marks = row["batch"], row["marks"]
        self.docs = np.asarray(row["docs"], np.int64)
        self.paths = np.frombuffer(row["paths"], np.uint64)
        self.owners, self.starts, self.sizes = (unpack(row[c]).view(np.int64) for c in ("owners", "starts", "sizes"))


FILTER_BITS = 1 << 26  # 8 MB


def repeats(docs: DataFrame, k: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Word spans to remove: ``_doc``, ``_mark`` (a hash of the text), ``_spans`` (start and end, end exclusive).

    Of a window of ``k`` words that several documents hold, the one with the smallest id keeps it. Rows with a null id
    neither keep nor lose words; rows of the same id do not count against each other.
    """
    texts = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.lit(0).alias("fold"), F.xxhash64(text_col).alias("mark"),
        F.col(text_col).cast("string").alias("text"),
    )
    rows = batches(texts, lower=False, end=False)
    lowest = rows.select(F.min(F.array_min("docs"))).first()[0] or 0
    found = _shared_runs(rows, k)
    forget(rows)
    paths = _compacted(found, k)
    forget(found)
    buckets = bucket_count(paths, total(paths, "n_paths"))

    def ask_first(p: _Paths) -> Questions:
        keys, which = np.unique(p.paths, return_inverse=True)
        first = np.full(len(keys), np.uint64(2**64 - 1))
        np.minimum.at(first, which, (p.docs[p.owners] - lowest).view(np.uint64))
        return [(PATH, keys, [first])]

    def first_of_all(_: int, which: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
        first = np.full(int(which.max(initial=-1)) + 1, np.uint64(2**64 - 1))
        np.minimum.at(first, which, values[0])
        return [first]

    def lost(row: dict, replies: list[dict]) -> pa.Table:
        p = _Paths(row)
        keys, which = np.unique(p.paths, return_inverse=True)
        later = told(replies, PATH, keys, buckets, 1)[0][which] < (p.docs[p.owners] - lowest).view(np.uint64)
        spans: dict[tuple[int, int], list[list[int]]] = {}
        for owner, start, size in zip(p.owners[later].tolist(), p.starts[later].tolist(), p.sizes[later].tolist(), strict=True):
            mine, end = spans.setdefault((int(p.docs[owner]), p.marks[owner]), []), start + size + k - 1
            if mine and mine[-1][0] <= start <= mine[-1][1]:
                mine[-1][1] = max(mine[-1][1], end)
            else:
                mine.append([start, end])
        return pa.table({
            "_doc": pa.array([d for d, _ in spans], pa.int64()), "_mark": pa.array([m for _, m in spans], pa.int64()),
            "_spans": pa.array([[{"start": a, "end": b} for a, b in s] for s in spans.values()],
                               pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        })

    answers = answer(ask(paths, _Paths, ask_first, buckets), first_of_all)
    # rows of one id and text have the same spans
    spans = kept(per_row(paths, answers, lost, SPANS).dropDuplicates(["_doc", "_mark"]), "spans")
    forget(answers, paths)
    return spans


def _with_spans(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """``row`` (the columns of ``docs``, as a struct, so that none can clash) and ``_spans``. Only texts that may have some
    are joined with them: a filter of ``FILTER_BITS`` bits by the hash of id and text, which is broadcast and has the same
    size for any corpus, lets the others pass."""
    spans = repeats(docs, k, id_col, text_col)
    bit = F.pmod(F.xxhash64("_doc", "_mark"), F.lit(FILTER_BITS))
    words = spans.select(bit.alias("_bit")).groupBy(F.shiftright("_bit", 6).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_bit & 63 AS INT))")).alias("_bits")
    )
    marked = docs.select(
        F.struct("*").alias("row"), F.col(id_col).cast("long").alias("_doc"), F.xxhash64(text_col).alias("_mark")
    ).withColumn("_bit", bit)
    marked = marked.withColumn("_word", F.shiftright("_bit", 6)).join(F.broadcast(words), "_word", "left")
    may = F.coalesce(F.expr("shiftright(_bits, cast(_bit & 63 AS INT)) & 1") == 1, F.lit(False)) & F.col("_doc").isNotNull()
    without = marked.where(~may).select("row", F.lit(None).cast(spans.schema["_spans"].dataType).alias("_spans"))
    joined = marked.where(may).select("row", "_doc", "_mark").join(spans, ["_doc", "_mark"], "left").select("row", "_spans")
    return without.unionByName(joined)


def covered(n: int, spans: list) -> np.ndarray:
    """Which of ``n`` words are in a span."""
    edge = np.zeros(n + 1, np.int64)
    if spans:
        np.add.at(edge, [s["start"] for s in spans], 1)
        np.add.at(edge, [s["end"] for s in spans], -1)
    return np.cumsum(edge[:-1]) > 0


def digests(docs: DataFrame, k: int = 13) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and the SHA-256 of the kept words joined by spaces.

    Null and empty texts have no words. Texts shorter than ``k`` words keep all. Other columns of ``docs`` are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])

    def of(batch: pa.RecordBatch) -> dict:
        out = []
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for text, spans in zip(texts, batch.column("_spans").to_pylist(), strict=True):
            words = (text or b"").split()
            gone = covered(len(words), spans) if spans else None
            rest = words if gone is None else [w for w, g in zip(words, gone, strict=True) if not g]
            out.append((len(words), len(words) - len(rest), hashlib.sha256(b" ".join(rest)).hexdigest()))
        columns = list(zip(*out, strict=True)) or [()] * 3
        return {"doc_id": batch.column("doc_id")} | dict(zip(schema.names[1:], columns, strict=True))

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return _with_spans(texts, k, "doc_id", "text").select("row.doc_id", "row.text", "_spans").mapInArrow(
        per_batch(of, schema), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove(docs: DataFrame, k: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the repeated words; texts that lose some have the others joined by single spaces. Texts that
    lose nothing, null texts and all other columns stay as they are."""
    schema = docs.schema

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            row = batch.column("row")
            texts = row.field(text_col).to_pylist()
            for i, spans in enumerate(batch.column("_spans").to_pylist()):
                if spans:
                    words = texts[i].encode().split()
                    gone = covered(len(words), spans)
                    texts[i] = b" ".join([w for w, g in zip(words, gone, strict=True) if not g]).decode()
            arrays = [pa.array(texts, pa.string()) if c == text_col else row.field(c) for c in schema.names]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return _with_spans(docs, k, id_col, text_col).mapInArrow(run, schema)
