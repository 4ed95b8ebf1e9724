"""Quality rules as a ledger: each rule is evaluated once; policies and ablations work on the stored bits."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"


@dataclass(frozen=True)
class Rule:
    """A rule fails a document where ``fails``, SQL over the measures, holds. ``bit`` never changes its meaning."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "short_words", "word_chars < 2 * n_words"),
    Rule(3, "long_words", "word_chars > 25 * n_words"),
    Rule(4, "symbols", "10 * n_symbols > 3 * n_words"),
    Rule(5, "duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
)

#: Versions stay as they are once used; a change is a new version.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "short_words", "long_words", "symbols", "duplicate_lines"),
}


def _measure(text: str) -> tuple[int, ...]:
    words = text.encode().split()  # bytes split at 0x20 and 0x09 to 0x0D only
    word_chars = len(text) - sum(map(text.count, SPACES))
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.encode().split()] if "\n" in text else [text] * bool(words)
    repeated = 0
    windows = len(words) - 2
    if windows > 1 and len(set(zip(words, words[1:], words[2:], strict=False))) < windows:
        found = list(zip(words, words[1:], words[2:], strict=False))
        times, covered = Counter(found), 0
        for i, window in enumerate(found):
            if times[window] > 1:
                repeated += i + 3 - max(i, covered)
                covered = i + 3
    return len(words), word_chars, n_symbols, len(lines), len(lines) - len(set(lines)), repeated


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` and its measures, one narrow pass.

    Null and empty texts have zeros. Repeated rows are measured each on its own. Columns of ``docs`` that carry the
    name of a measure are replaced; all others pass through unchanged.
    """
    kept = [c for c in docs.columns if c not in MEASURES]
    schema = docs.select(*kept).schema
    for name in MEASURES:
        schema = schema.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_measure(x or "") for x in batch.column(text_col).to_pylist()]
            columns = list(zip(*rows, strict=True)) or [()] * len(MEASURES)
            arrays = batch.columns + [pa.array(c, pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, *MEASURES])

    return docs.select(*kept).mapInArrow(run, schema)


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """``measure`` and ``failed``: the bits of the rules that a document fails."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in rules]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measure(docs, text_col).withColumn("failed", failed)


def mask(policy: str, rules: tuple[Rule, ...] = RULES) -> int:
    return sum(1 << r.bit for r in rules if r.name in POLICIES[policy])


def apply_policy(entries: DataFrame, policy: str = "v1", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds ``kept``: no rule of the policy fails."""
    return entries.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask(policy, rules))) == 0)


def ablation(entries: DataFrame, policy: str = "v1", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each rule of the policy: how many documents fail it, how many fail nothing else, and how many the policy
    would keep without it. Documents are first counted per set of failed rules, so no text is read again."""
    all_bits = mask(policy, rules)
    sets = entries.groupBy(F.col("failed").bitwiseAND(F.lit(all_bits)).alias("bits")).agg(F.count("*").alias("n"))
    own = sets.sparkSession.createDataFrame(
        [(r.name, 1 << r.bit) for r in rules if r.name in POLICIES[policy]], "rule string, bit long"
    )
    rows = sets.select("bits", "n", F.explode(F.array(*[F.lit(1 << r.bit).cast("long") for r in rules
                                                        if r.name in POLICIES[policy]])).alias("bit"))

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    counted = rows.groupBy("bit").agg(
        total(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        total(F.col("bits") == F.col("bit")).alias("n_only"),
        total(F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0).alias("n_kept_without"),
    )
    return own.join(counted, "bit", "left").select(
        "rule", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_failed", "n_only", "n_kept_without")]
    )
