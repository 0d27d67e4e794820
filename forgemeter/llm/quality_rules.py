"""Quality rules as a bitmask ledger.

Every document is measured once, in whole, and every rule is evaluated once: the ledger keeps the
measurements and one bit per rule that failed. Policies are versioned masks over those bits; a document is
kept if it meets the base rule and fails none of the policy's rules. Ablations need only the counts by
bitmask (at most two to the number of rules rows), never the documents again.

Defined cases: a null or blank text has no words and fails the base rule; repeated rows each get a row; a
null id is kept as null; an empty table gives an empty ledger, and ablations of zeros.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
WINDOW = 3
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]

#: Rule name -> condition under which a document fails; a rule's bit is its place here.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "many_symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "5 * n_dup_lines > 2 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "some_repetition": "100 * n_repeat_words > 20 * n_words",
}
BASE_RULES = ["few_words", "repeated_words"]
#: Policy version -> its rules. Versions are never changed, only added.
POLICIES = {
    1: ["few_words", "repeated_words"],
    2: ["few_words", "repeated_words", "many_symbols", "duplicate_lines", "short_words", "long_words"],
    3: list(RULES),
}
CURRENT = 2


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(rules: list[str]) -> int:
    return sum(bit(rule) for rule in rules)


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three words that occurs twice or more in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(word, len(numbers)) for word in words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
    _, place, count = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    again = count[place] > 1
    covered = np.zeros(len(words), bool)
    for k in range(WINDOW):
        covered[k : k + n] |= again
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The values of ``MEASURES`` of a whole text."""
    if not text:
        return (0,) * len(MEASURES)
    words = text.encode("utf-8", "surrogatepass").split()  # bytes: exactly space and the controls 9 to 13 part words
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    chars = len(text) - sum(map(text.count, BLANKS))
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines), len(lines) - len(set(lines)), repeated_words(words)


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            columns = zip(*[measure(text.as_py()) for text in part.column("text")])
            arrays = [part.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns]]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *MEASURES])


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and fail_bits."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    measured = rows.mapInArrow(_measure_batches, "doc_id long, " + ", ".join(f"{name} long" for name in MEASURES))
    bits = [F.when(F.expr(condition), F.lit(bit(rule))).otherwise(F.lit(0)) for rule, condition in RULES.items()]
    fails = bits[0]
    for other in bits[1:]:
        fails = fails.bitwiseOR(other)
    return measured.withColumn("fail_bits", fails.cast("long"))


_LEDGERS: dict[tuple[str, int], list[tuple[DataFrame, DataFrame]]] = {}


def stored_ledger(docs: DataFrame) -> DataFrame:
    """The ledger as a stored table; the same documents are measured once in an application, whatever reads it.

    Documents are the same where Spark says that both frames are (``sameSemantics``). A later state of files
    that were rewritten in place needs a session of its own.
    """
    key = (docs.sparkSession.sparkContext.applicationId, docs.semanticHash())
    for known, table in _LEDGERS.get(key, []):
        if known.sparkSession is docs.sparkSession and known.sameSemantics(docs):
            return table
    table = stored(ledger(docs), "quality-ledger")
    _LEDGERS.setdefault(key, []).append((docs, table))
    return table


def fails(bits: Column, rules: list[str]) -> Column:
    return bits.bitwiseAND(F.lit(mask(rules))) != 0


def judged(ledger_rows: DataFrame, version: int = CURRENT) -> DataFrame:
    """The ledger with base_failed, kept and the policy's version."""
    base, other = fails(F.col("fail_bits"), BASE_RULES), fails(F.col("fail_bits"), POLICIES[version])
    return ledger_rows.withColumns({"base_failed": base, "kept": ~(base | other), "policy": F.lit(version)})


def ablations(ledger_rows: DataFrame) -> DataFrame:
    """Per policy and rule: documents that fail the rule, that fail it alone, and kept with and without it."""
    counts = ledger_rows.groupBy("fail_bits").agg(F.count("*").alias("docs"))
    cases = [F.struct(F.lit(v).alias("policy"), F.lit(rule).alias("rule"), F.lit(bit(rule)).alias("rule_bit"), F.lit(mask(rules)).alias("policy_mask")) for v, rules in POLICIES.items() for rule in rules]
    rows = counts.sparkSession.range(1).select(F.explode(F.array(*cases)).alias("c")).select("c.*")
    spread = counts.select(F.explode(F.array(*cases)).alias("c"), "fail_bits", "docs").select("c.*", "fail_bits", "docs")
    failed = F.col("fail_bits").bitwiseAND(F.col("policy_mask"))
    total = {
        "failing": F.col("fail_bits").bitwiseAND(F.col("rule_bit")) != 0,
        "failing_alone": failed == F.col("rule_bit"),
        "kept_with": failed == 0,
        "kept_without": failed.bitwiseAND(F.bitwise_not(F.col("rule_bit"))) == 0,
    }
    sums = spread.groupBy("policy", "rule").agg(*[F.sum(F.when(c, F.col("docs")).otherwise(0)).alias(name) for name, c in total.items()])
    joined = rows.select("policy", "rule").join(sums, ["policy", "rule"], "left")
    return joined.select("policy", "rule", *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in total])
