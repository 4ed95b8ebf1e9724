"""Near-duplicate documents by b-bit MinHash.

Texts with the same shingle set are one class first. Of each class's set, the minima under ``BANDS * ROWS`` hash functions are taken.
Bands of minima propose candidates; of the minima only the low ``BITS`` bits are kept, packed, and two packed signatures
give an estimate of the similarity that is corrected for chance matches of the bits (Li and Koenig, 2010). The estimate
only says which pairs to look at first; every pair is decided on the full sets.

A band's bucket can hold any share of all documents, so its pairs are never listed. Members are first compared with one
centre, the member that shares most buckets; those that fail get a centre among themselves, a few times. Then components
are formed, and only buckets that still hold several components are searched for links between them, block by block; a
block gives out links that unite components, never all of its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumetra.llm.asking import forget, kept, mix
from lumetra.llm.common import Memo, id_and_text, per_batch
from lumetra.llm.components import components
from lumetra.llm.substrings import window_hashes

BANDS, ROWS, BITS = 32, 4, 4  # at similarity 0.8 a pair shares no band once in 20 million
CENTRE_ROUNDS = 3
BLOCK = 512
MAX_BROADCAST_PAIRS = 200_000
SKETCH = "doc_id long, n_shingles long, print1 long, print2 long, signature binary, bands array<long>"


def shingle_set(text: bytes, of_word, size: int) -> np.ndarray:
    """Ascending hashes of the distinct shingles; a text of fewer words is one shingle, one without words has none."""
    words = text.lower().split()  # of bytes: A to Z; at 0x20 and 0x09 to 0x0D
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(of_word, words), np.uint64, len(words))
    return np.unique(window_hashes(hashes, min(size, len(words)), 4))


def _functions() -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (seeds[0::2] | np.uint64(1))[:, None], seeds[1::2][:, None]


def minima(shingles: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    out = np.full(BANDS * ROWS, np.uint64(2**64 - 1))
    for at in range(0, len(shingles), 1024):
        np.minimum(out, (functions[0] * shingles[None, at : at + 1024] + functions[1]).min(axis=1), out=out)
    return out


def packed(least: np.ndarray) -> bytes:
    low = (mix(least) & np.uint64(2**BITS - 1)).astype(np.uint8)
    return (low[0::2] | low[1::2] << BITS).tobytes()


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = least.reshape(BANDS, ROWS)
    key = mix(np.arange(BANDS, dtype=np.uint64))
    for i in range(ROWS):
        key = mix(key * np.uint64(0xD1342543DE82EF95) + rows[:, i])
    return key.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity from packed signatures (rows of 64-bit words): the share of equal groups of bits, less chance matches."""
    differ = a ^ b
    for shift in range(1, BITS):
        differ = differ | (a ^ b) >> np.uint64(shift)
    ones = np.uint64(sum(1 << i for i in range(0, 64, BITS)))
    same = 1 - np.bitwise_count(differ & ones).sum(axis=-1) / (BANDS * ROWS)
    return (same - 2.0**-BITS) / (1 - 2.0**-BITS)


def sketch(docs: DataFrame, size: int) -> DataFrame:
    """Set size, fingerprint, packed signature and band keys of each text, one narrow pass."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("print1", pa.int64()), ("print2", pa.int64()),
                        ("signature", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_word, functions = Memo(xxhash.xxh64_intdigest).__getitem__, _functions()

        def of(batch: pa.RecordBatch) -> dict:
            rows = []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                shingles = shingle_set(text or b"", of_word, size)
                least = minima(shingles, functions)
                prints = [mix(shingles ^ np.uint64(s)).sum(dtype=np.uint64).view(np.int64) for s in (5, 6)]
                keys = band_keys(least) if len(shingles) else []
                rows.append((len(shingles), *prints, packed(least), keys))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            return {"doc_id": batch.column("doc_id")} | dict(zip(schema.names[1:], columns, strict=True))

        return per_batch(of, schema)(batches)

    return id_and_text(docs).mapInArrow(start, SKETCH)


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """The full sets, signatures and bands of the wanted documents, stored."""
    schema = pa.schema([("doc", pa.int64()), ("set", pa.binary()), ("signature", pa.binary()), ("bands", pa.binary())])

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_word, functions = Memo(xxhash.xxh64_intdigest).__getitem__, _functions()

        def of(batch: pa.RecordBatch) -> dict:
            sets = [shingle_set(t or b"", of_word, size) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            least = [minima(s, functions) for s in sets]
            return {"doc": batch.column("doc_id"), "set": [s.tobytes() for s in sets],
                    "signature": [packed(x) for x in least], "bands": [band_keys(x).tobytes() for x in least]}

        return per_batch(of, schema)(batches)

    wanted = wanted.select(F.col("doc").alias("doc_id")).distinct()
    if wanted.count() <= 2 * MAX_BROADCAST_PAIRS:
        wanted = F.broadcast(wanted)
    return kept(id_and_text(docs).join(wanted, "doc_id", "left_semi").mapInArrow(
        start, "doc long, set binary, signature binary, bands binary"), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``u``, ``v``) that reach the similarity on the full sets, stored."""
    pairs = kept(pairs, "pairs")
    sides = pairs.withColumn("doc", F.explode(F.array("u", "v")))
    if pairs.count() <= MAX_BROADCAST_PAIRS:
        sides = F.broadcast(sides)
    both = sets.select("doc", "set").join(sides, "doc").groupBy("u", "v").agg(F.collect_list(F.struct("doc", "set")).alias("x"))

    def of(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"u": [], "v": []}
        for u, v, found in zip(*(batch.column(c).to_pylist() for c in ("u", "v", "x")), strict=True):
            left, right = ([np.frombuffer(f["set"], np.uint64) for f in found if f["doc"] == d] for d in (u, v))
            if any(_alike(a, b, percent) for a in left for b in right):
                out["u"].append(u)
                out["v"].append(v)
        return out

    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    confirmed = kept(both.mapInArrow(per_batch(of, schema), "u long, v long"), "confirmed")
    forget(pairs)
    return confirmed


def _alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    together = len(a) + len(b)
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (together - common)


def _between(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links between documents of different components that share a bucket, enough of them to unite what is
    linked. ``members``: key, doc, component.

    Each two blocks of a bucket meet in one group. Pairs are taken by descending estimate, and only while their
    components are still apart; a pair that shares several buckets is looked at in that of its first common band.
    """
    sizes = kept(
        members.groupBy("key").agg(F.count("*").alias("n"), F.min("component").alias("a"), F.max("component").alias("b"))
        .where("a < b").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "open",
    )
    own = F.pmod(F.xxhash64("doc", F.lit(11)), F.col("blocks")).cast("int")
    dealt = members.join(sizes, "key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    groups = max(1, sizes.agg(F.coalesce(F.sum(F.col("blocks") * F.col("blocks")), F.lit(0))).first()[0] // 20)
    dealt = dealt.withColumn("group", F.pmod(F.xxhash64("key", "i", "j"), F.lit(groups))).join(sets, "doc")

    def run(table: pa.Table) -> pa.Table:
        t = table.sort_by([("key", "ascending"), ("i", "ascending"), ("j", "ascending")]).combine_chunks()
        key, i, j, doc, component, own = (t.column(c).to_numpy() for c in ("key", "i", "j", "doc", "component", "own"))
        words = [np.frombuffer(s, np.uint64) for s in t.column("set").to_pylist()]
        signature, bands = (np.frombuffer(b"".join(t.column(c).to_pylist()), kind).reshape(len(doc), -1)
                            for c, kind in (("signature", np.uint64), ("bands", np.int64)))
        new = (np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)
        at = [0, *(np.flatnonzero(new) + 1), len(doc)]
        sizes, out = np.array([len(x) for x in words]), []
        above: dict[int, int] = {}

        def top(c: int) -> int:
            while above.get(c, c) != c:
                c = above[c]
            return c

        for a, b in zip(at, at[1:]):
            band = np.argmax(bands[a] == key[a])
            found = []
            for x in range(a, b):
                ys = np.arange(x + 1, b)
                ys = ys[(component[ys] != component[x]) & ((i[a] == j[a]) | (own[ys] != own[x]))]
                ys = ys[100 * np.minimum(sizes[ys], sizes[x]) >= percent * np.maximum(sizes[ys], sizes[x])]
                ys = ys[~(bands[ys, :band] == bands[x, :band]).any(axis=1)]
                found += zip(-estimate(signature[x], signature[ys]), [x] * len(ys), ys.tolist(), strict=True)
            for _, x, y in sorted(found):
                u, v = top(int(component[x])), top(int(component[y]))
                if u != v and _alike(words[x], words[y], percent):
                    above[max(u, v)] = min(u, v)
                    out.append((max(doc[x], doc[y]), min(doc[x], doc[y])))
        return pa.table({"u": pa.array([u for u, _ in out], pa.int64()), "v": pa.array([v for _, v in out], pa.int64())})

    columns = dealt.select("group", "key", "i", "j", "doc", "component", "own", "set", "signature", "bands")
    out = kept(columns.groupBy("group").applyInArrow(run, "u long, v long").distinct(), "between")
    forget(sizes)
    return out


def classes(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (the smallest id that links reach), ``kept``
    (it is that smallest one).

    Words are lower-cased (A to Z); a set has the distinct shingles of ``size`` words, or the whole text if it has fewer.
    Documents are linked from ``percent`` per cent of intersection to union. Null and empty texts have no shingles and no
    links. Rows without id are kept, with a null component. Repeated rows are reported each; rows with one id are one
    document, linked with what any of them is linked with, and all of them are kept or none.
    """
    sketches = kept(sketch(docs, size), "sketches")
    full = sketches.where("doc_id IS NOT NULL AND n_shingles > 0").withColumnRenamed("doc_id", "doc")
    prints = ["n_shingles", "print1", "print2"]
    copies = kept(full.groupBy(*prints).agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
                  .drop("last"), "copies")
    same = full.join(copies, prints).where("doc > first").select(F.col("doc").alias("u"), F.col("first").alias("v"))
    links = [kept(same, "same")]
    single = full.join(copies, prints, "left").where("first IS NULL OR doc = first")
    banded = single.select("doc", F.explode("bands").alias("key"))
    buckets = kept(banded.groupBy("key").agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.count("*").alias("n"))
                   .where("a < b").select("key", "n"), "buckets")
    shared = kept(banded.join(buckets, "key").distinct(), "shared")
    sizes = kept(sketches.select("doc_id", "n_shingles"), "sizes")
    forget(sketches, copies, buckets)  # every table goes with its last reader
    popular = kept(shared.groupBy("doc").agg(F.sum("n").alias("popularity")), "popular")
    members = kept(shared.join(popular, "doc").select("key", "doc", "popularity"), "members")
    forget(shared)
    sets = _sets(docs, popular, size)
    forget(popular)

    open_ = members
    for _ in range(CENTRE_ROUNDS):
        centres = kept(open_.groupBy("key").agg(F.max(F.struct("popularity", -F.col("doc"))).alias("c"))
                       .select("key", (-F.col("c.col2")).alias("centre")), "centres")
        paired = open_.join(centres, "key").where("doc <> centre").select(
            "key", "doc", "popularity", F.greatest("doc", "centre").alias("u"), F.least("doc", "centre").alias("v")
        )
        confirmed = _confirmed(paired.select("u", "v").distinct(), sets, percent)
        links.append(confirmed)
        before = open_
        open_ = kept(paired.join(confirmed, ["u", "v"], "left_anti").select("key", "doc", "popularity"), "open")
        forget(centres, *([before] if before is not members else []))

    found = components(_union(links))
    labelled = kept(members.join(found, F.col("doc") == F.col("node"), "left").select(
        "key", "doc", F.coalesce("component", "doc").alias("component")), "labelled")
    forget(*([members] if open_ is members else [members, open_]))
    more = _between(labelled, sets, percent)
    forget(labelled, sets)
    if not more.isEmpty():
        forget(found)
        found = components(_union([*links, more]))
    forget(*links, more)
    return sizes.join(found, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("component").isNull() | (F.col("component") == F.col("doc_id")), F.lit(True)).alias("kept"),
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0].select("u", "v")
    for p in parts[1:]:
        out = out.unionByName(p.select("u", "v"))
    return out


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that are not the first of their class. Repeated rows of one id are one document:
    they stay or go together. All columns stay."""
    gone = kept(classes(docs, size, percent).where(~F.col("kept")).select("doc_id").distinct(), "gone")
    return docs.join(gone, docs["doc_id"].cast("long") == gone["doc_id"], "left_anti")
