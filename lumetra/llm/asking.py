"""Corpus-wide look-ups for batches of documents.

Exploding every word window of a corpus into a row shuffles far more than the text. Here a task turns documents into
batches of about a million words, and each batch asks once about each distinct key in it (a word, a word pair, a window).
Keys go as packed arrays to the bucket that their hash names, so a key that a third of all documents hold is one entry per
batch, and all buckets are alike. A bucket sees all batches' entries for its keys, and answers each batch in the order
of its question. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumetra.session import scratch_path

ASKS = "kind int, bucket int, batch long, keys binary, values array<binary>"
ANSWERS = "batch long, kind int, bucket int, answers array<binary>, some long"
BATCHES = ("batch long, fold int, docs array<long>, marks array<long>, sizes array<int>, words binary, tokens binary, "
           "n_tokens long")
TEXTS = "doc_id long, fold int, mark long, text string"

Questions = list[tuple[int, np.ndarray, list[np.ndarray]]]  # kind, ascending unique keys, values by key


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a compressed table in the shared folder: computed once, whatever reads it."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.kept_in = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes tables of ``kept`` that nothing will read again."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.kept_in)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned numbers in as many bytes each as the largest needs; all low bytes come first, since the high ones are
    mostly alike and compress well."""
    width = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    raw = numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + raw.T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    raw = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, :width] = raw.T
    return out.view("<u8").reshape(-1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads neighbours (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Local(dict):
    """Numbers new words in order."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def batches(texts: DataFrame, lower: bool, end: bool, words_per_batch: int = 1_000_000) -> DataFrame:
    """Documents of a partition in batches of one ``fold``, stored.

    ``texts`` has ``doc_id``, ``fold``, ``mark`` (any number that goes with the row) and ``text``. ``words`` are the
    64-bit hashes of the batch's distinct words, ``tokens`` the words of all its documents as positions in it (``pack``).
    Bits 32 and 33 of the batch number are the fold (0 to 3).
    ``lower`` lower-cases A to Z; ``end`` adds a token (the empty word) to each document. A longer document is a batch of
    its own.
    """

    def start(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        open_: dict[int, tuple] = {}

        def flush(fold: int) -> pa.RecordBatch:
            nonlocal made
            local, docs, marks, parts, _ = open_.pop(fold)
            words = np.fromiter(map(xxhash.xxh64_intdigest, local), np.uint64, len(local))
            tokens = np.concatenate(parts)
            columns = [[part << 34 | fold << 32 | made], [fold], [docs], [marks], [[len(p) for p in parts]], [words.tobytes()],
                       [pack(tokens)], [len(tokens)]]
            made += 1
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
            )

        for batch in rows:
            texts_ = batch.column("text").cast(pa.binary()).to_pylist()
            for doc, fold, mark, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "fold", "mark")), texts_, strict=True):
                words = (text.lower() if lower else text).split() if text else []  # at 0x20 and 0x09 to 0x0D
                if end:
                    words.append(b"")
                state = open_.get(fold) or open_.setdefault(fold, (_Local(), [], [], [], [0]))
                state[1].append(doc)
                state[2].append(mark)
                state[3].append(np.fromiter(map(state[0].__getitem__, words), np.int32, len(words)))
                state[4][0] += len(words)
                if state[4][0] >= words_per_batch:
                    yield flush(fold)
        for fold in list(open_):
            yield flush(fold)

    names = [c.split()[0] for c in BATCHES.split(", ")]
    types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(),
             pa.binary(), pa.int64()]
    return kept(texts.select("doc_id", "fold", "mark", "text").mapInArrow(start, BATCHES), "batches")


class Batch:
    """A row of ``batches`` as arrays: ``words`` per token, ``doc`` (position of its document) per token."""

    def __init__(self, row: dict):
        self.id, self.fold, self.docs, self.marks = row["batch"], row["fold"], row["docs"], row["marks"]
        self.sizes = np.asarray(row["sizes"], np.int64)
        self.vocabulary = np.frombuffer(row["words"], np.uint64)
        self.tokens = unpack(row["tokens"]).view(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])

    @property
    def words(self) -> np.ndarray:
        return self.vocabulary[self.tokens]

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)


def _dealt(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys by bucket, and where each bucket starts in it."""
    bucket = keys % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def ask(rows: DataFrame, read: Callable[[dict], object], questions: Callable[[object], Questions], buckets: int) -> DataFrame:
    """The questions of each row, by bucket."""

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("batch", pa.int64()), ("keys", pa.binary()),
                            ("values", pa.list_(pa.binary()))])
        for record in batches_:
            for i in range(len(record)):
                row = read(record.slice(i, 1).to_pylist()[0])
                for kind, keys, values in questions(row):
                    order, at = _dealt(keys, buckets)
                    out = []
                    for b in np.flatnonzero(np.diff(at)):
                        mine = order[at[b] : at[b + 1]]
                        high = keys[mine] // np.uint64(buckets)
                        out.append((kind, b, row.id, pack(np.diff(high, prepend=np.uint64(0))), [pack(v[mine]) for v in values]))
                    if out:
                        columns = zip(*out, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
                        )

    return rows.mapInArrow(run, ASKS)


def answer(asks: DataFrame, judge: Callable[[int, np.ndarray, list[np.ndarray]], list[np.ndarray]]) -> DataFrame:
    """One row per question. ``judge(kind, which, values)`` gets, for all entries of a bucket, the number of their key
    (0 to n - 1) and their values, and gives arrays by key number. The answers are stored. The column ``some`` adds up
    to the number of keys whose first answer is not 0."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()  # of about as many keys as a batch has tokens
        keys = [np.cumsum(unpack(r["keys"]), dtype=np.uint64) for r in rows]
        sizes = [len(k) for k in keys]
        _, which = np.unique(np.concatenate(keys), return_inverse=True)
        values = [np.concatenate([unpack(r["values"][j]) for r in rows]) for j in range(len(rows[0]["values"]))]
        told = judge(rows[0]["kind"], which, values)
        at = np.cumsum([0, *sizes])
        answers = [[pack(t[which[a:b]]) for t in told] for a, b in zip(at, at[1:])]
        return pa.table({
            "batch": pa.array([r["batch"] for r in rows], pa.int64()), "kind": pa.array([r["kind"] for r in rows], pa.int32()),
            "bucket": pa.array([r["bucket"] for r in rows], pa.int32()), "answers": pa.array(answers, pa.list_(pa.binary())),
            "some": pa.array([int(np.count_nonzero(told[0])), *[0] * (len(rows) - 1)], pa.int64()),
        })

    return kept(asks.groupBy("kind", "bucket").applyInArrow(run, ANSWERS), "answers")


def told(rows: Iterable[dict], kind: int, keys: np.ndarray, buckets: int, n_values: int) -> list[np.ndarray]:
    """The answers to a question of ``kind`` about ``keys``, as arrays by key."""
    order, at = _dealt(keys, buckets)
    out = [np.zeros(len(keys), np.uint64) for _ in range(n_values)]
    for r in rows:
        if r["kind"] == kind:
            for array, data in zip(out, r["answers"], strict=True):
                array[order[at[r["bucket"]] : at[r["bucket"] + 1]]] = unpack(data)
    return out


def per_row(rows: DataFrame, answers: DataFrame, fn: Callable[[dict, list[dict]], pa.Table], schema: str) -> DataFrame:
    """``fn`` of each row of batches and the answers to it; there must be no answers to other rows."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return fn(left.to_pylist()[0], right.to_pylist())

    return rows.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(run, schema)


def bucket_count(rows: DataFrame, n_keys: int, per_bucket: int = 1_000_000) -> int:
    """Buckets of about ``per_bucket`` entries, and enough for all cores."""
    return max(-(-n_keys // per_bucket), rows.sparkSession.sparkContext.defaultParallelism)


def total(rows: DataFrame, column: str) -> int:
    return rows.agg(F.coalesce(F.sum(column), F.lit(0))).first()[0]
