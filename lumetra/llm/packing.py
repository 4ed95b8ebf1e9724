"""Packing tokenised documents into sequences of fixed capacity.

Lengths are whole numbers up to the capacity, so a packing instance is a histogram of at most ``capacity`` rows, whatever
the number of documents. The plan is made on that histogram: first the reduction by dominance after Martello and Toth,
which fixes small sets that some best packing contains, then best fit decreasing on what is left. Spark counts the
histogram, numbers the pieces of each length and looks up their places.
"""

from __future__ import annotations

import base64
import bisect
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumetra.llm.common import id_and_text, per_batch
from lumetra.session import stored

#: Fixed value: how texts are split before the merges of the byte-level file.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def byte_encoding(path: str, special: dict[str, int]) -> tiktoken.Encoding:
    """The encoding of a rank file. ``special`` maps strings that are taken out of texts first to their ids."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    return tiktoken.Encoding("bytes", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens=special)


#: Fixed value: white space by Unicode.
WHITE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
LONG_WHITE = 100_000


def encode(bpe: tiktoken.Encoding, text: str) -> np.ndarray:
    """The ids of a text. The pattern gives up on very long white space, which is a piece of its own but for its last
    character, if more text follows; so it is encoded apart."""
    if len(text) <= LONG_WHITE:
        return bpe.encode_to_numpy(text, allowed_special="all")
    out, at = [], 0
    for m in re.finditer(WHITE + "{2,}+", text):
        if len(m[0]) > LONG_WHITE:
            end = m.end() - (m.end() < len(text))
            out += [bpe.encode_to_numpy(text[at : m.start()], allowed_special="all"), bpe._encode_single_piece(text[m.start() : end])]
            at = end
    return np.concatenate([*out, bpe.encode_to_numpy(text[at:], allowed_special="all")]) if out else bpe.encode_to_numpy(text, allowed_special="all")


def cut(docs: DataFrame, path: str, special: dict[str, int], end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """The pieces of each document: its ids and then ``end_id``; only longer documents are cut, into pieces of
    ``capacity`` tokens of which the first may be shorter. ``ids_crc32`` is of the piece's ids as little-endian
    unsigned 32-bit integers. A null or empty text is the piece of ``end_id`` alone; repeated rows are kept.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64())])
    end = end_id.to_bytes(4, "little")

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_encoding(path, special)

        def of(batch: pa.RecordBatch) -> dict:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = encode(bpe, text or "").astype("<u4").tobytes() + end
                n = len(ids) // 4
                at, upto, k = 0, (n - 1) % capacity + 1, 0
                while at < n:
                    rows.append((doc, k, at, upto - at, zlib.crc32(memoryview(ids)[4 * at : 4 * upto])))
                    at, upto, k = upto, upto + capacity, k + 1
            return dict(zip(schema.names, zip(*rows, strict=True) if rows else [()] * 5, strict=True))

        return per_batch(of, schema)(batches)

    return id_and_text(docs).mapInArrow(start, PIECES)


class _Sizes:
    """The lengths that are left, with their counts, in order."""

    def __init__(self, counts: dict[int, int]):
        self.n = {s: k for s, k in counts.items() if k > 0}
        self.order = sorted(self.n)

    def take(self, size: int, k: int) -> None:
        self.n[size] -= k
        if not self.n[size]:
            del self.n[size]
            del self.order[bisect.bisect_left(self.order, size)]

    def upto(self, room: int, without: int | None = None) -> int | None:
        """The longest length of at most ``room``; ``without``: one of that length is taken already."""
        i = bisect.bisect_right(self.order, room) - 1
        while i >= 0 and self.order[i] == without and self.n[without] == 1:
            i -= 1
        return self.order[i] if i >= 0 else None

    def smallest(self, k: int, without: int) -> int | None:
        """The sum of the k smallest, one ``without`` aside; None if there are fewer."""
        total = 0
        for size in self.order:
            have = min(k, self.n[size] - (size == without))
            total, k = total + have * size, k - have
            if not k:
                return total
        return None

    def best_pair(self, room: int, without: int) -> int:
        """The largest sum of at most ``room`` of two lengths, one ``without`` aside; 0 if none."""
        have = dict(self.n)
        have[without] -= 1
        order = [s for s in self.order if have[s]]
        best, lo, hi = 0, 0, len(order) - 1
        while lo <= hi:
            total = order[lo] + order[hi]
            if total > room or lo == hi and have[order[lo]] < 2:
                hi -= 1
                continue
            best = max(best, total)
            lo += 1
        return best


Plan = list[tuple[int, tuple[int, ...]]]


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[Plan, dict[int, int]]:
    """Sets that some packing with the fewest sequences contains, and the counts of what is left.

    For the longest length j: alone if nothing fits beside it. With k, the longest that fits beside it, {j, k} is fixed
    if they fill the sequence, if no two pieces fit beside j, or if no three do and no two are longer together than k:
    whatever else stood beside j could change places with k. Passing on to smaller lengths goes on until nothing
    is fixed any more.
    """
    left, fixed = _Sizes(counts), []
    changed = True
    while changed:
        changed = False
        for j in sorted(left.n, reverse=True):
            while j in left.n:
                room = capacity - j
                k = left.upto(room, j)
                if k is None:
                    n, made = left.n[j], (j,)
                else:
                    two, three = left.smallest(2, j), left.smallest(3, j)
                    sure = j + k == capacity or two is None or two > room
                    if not sure and (three is None or three > room):
                        sure = left.best_pair(room, j) <= k
                    if not sure:
                        break
                    # as long as both last, the same holds for the next pair of them
                    n, made = (left.n[j] // 2 if j == k else min(left.n[j], left.n[k])), (j, k)
                for size in made:
                    left.take(size, n)
                fixed.append((n, made))
                changed = True
    return fixed, dict(left.n)


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best fit decreasing on counts: sequences with equal content are one entry, so the work depends on the number of
    lengths, not of pieces."""
    open_: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    rooms: list[int] = []
    done: Plan = []

    def put(n: int, made: tuple[int, ...]) -> None:
        room = capacity - sum(made)
        if room == 0:
            done.append((n, made))
        else:
            if room not in open_:
                bisect.insort(rooms, room)
            open_.setdefault(room, []).append((n, made))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            i = bisect.bisect_left(rooms, size)
            if i == len(rooms):
                each = min(capacity // size, left)
                n = left // each
                put(n, (size,) * each)
                left -= n * each
                continue
            room = rooms[i]
            n, made = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(i)
            each = min(room // size, left)
            used = min(n, left // each)
            put(used, made + (size,) * each)
            left -= used * each
            if n > used:
                put(n - used, made)
    return done + [x for xs in open_.values() for x in xs]


def plan(counts: dict[int, int], capacity: int) -> Plan:
    """(number of sequences, lengths in them) for a histogram of lengths."""
    fixed, rest = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def _places(spark: SparkSession, made: Plan) -> DataFrame:
    """For each length the ranges of ranks that go to equal sequences. Rank r of the range from ``lo`` has the
    place ``offset + (r - lo) % each * size`` in sequence ``first + (r - lo) // each``.

    The number of rows depends on the number of different lengths only (at most the capacity), so it may be broadcast.
    """
    rows, used, first = [], Counter(), 0
    for n, lengths in made:
        offset = 0
        for size, each in Counter(lengths).items():
            rows.append((size, used[size], used[size] + n * each, first, each, offset))
            used[size] += n * each
            offset += size * each
        first += n
    return spark.createDataFrame(rows, "length long, lo long, hi long, first long, each long, at long")


def pack(pieces: DataFrame, capacity: int = 2048, rows_per_bucket: int = 20_000) -> DataFrame:
    """``pieces`` (``doc_id``, ``piece``, ``length`` from 1 to ``capacity``, other columns) with ``sequence_id`` and
    ``offset``: in each sequence the pieces stand without gaps from 0, and their lengths sum to at most ``capacity``.

    ``pieces`` must be a stored table, since it is read more than once. Pieces of a length are numbered within hashed
    buckets, so a length that a third of all pieces has is spread like the others. Repeated rows get a place each;
    an empty table gives an empty one. Columns of the input called ``sequence_id`` or ``offset`` are replaced.
    """
    spark = pieces.sparkSession
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset", "_bucket", "_rank")]
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    buckets = max(1, sum(histogram.values()) // rows_per_bucket)
    dealt = pieces.select(*kept, F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).alias("_bucket"))
    counts = dealt.groupBy("length", "_bucket").count()
    before = counts.select(
        "length", "_bucket",
        F.coalesce(
            F.sum("count").over(Window.partitionBy("length").orderBy("_bucket").rowsBetween(
                Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
    )
    order = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", *[c for c in ("start",) if c in kept])
    ranked = dealt.withColumn("_row", F.row_number().over(order) - 1).join(before, ["length", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_row") + F.col("_before"))
    places = F.broadcast(_places(spark, plan(histogram, capacity)).withColumnRenamed("length", "_length"))
    placed = ranked.join(
        places, (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("lo")) & (F.col("_rank") < F.col("hi"))
    )
    nth = F.col("_rank") - F.col("lo")
    return placed.select(
        *kept,
        (F.col("first") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + nth % F.col("each") * F.col("length")).alias("offset"),
    )


def pack_documents(docs: DataFrame, path: str, special: dict[str, int], end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """Documents to placed pieces: ``cut``, stored once, then ``pack``."""
    return pack(stored(cut(docs, path, special, end_id, capacity), "pieces"), capacity)
