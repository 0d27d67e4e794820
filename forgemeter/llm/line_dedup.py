"""Line dedup by pairwise alignment: blocks of lines that an earlier document has are cut from the later one.

A line is told by a hash of its trimmed text; lines without a word take no part. Documents are ordered by
id, and different texts under one id, or without one, by their hash. A stretch is a run of consecutive lines that other documents have too. Only stretches of at least
``min_words`` words can hold a block worth deleting, so short common lines never make candidates. In such
a stretch every rare line (in at most ``rare`` documents) anchors its document to the first document that
holds the line. Frequent lines anchor only where a run of them alone reaches ``min_words``: that is the
exact way for large groups of copies and for long passages that very many documents share. The lines of a block
may have first holders of their own, none with the whole block, so every shortest run of lines that
reaches ``min_words`` is also anchored to the run's first holder. Every document is linked to first holders only,
so pairs never grow with the square of a group.

Each pair is aligned by patience diff: lines unique on both sides, in longest increasing order, are
fixed points; the gaps between them are aligned in the same way, and where no line is unique, the k-th
occurrence of a line stands for the k-th one of the other side. Aligned blocks of at least
``min_words`` words are deleted from the later document, and so are blocks of that size that it holds in
another order, or once more. The first holder of a line never loses it.

Defined cases: a null text stays null; repeated rows are one document, each keeping the same result; a
document without id comes after all others; an empty table gives no rows. Extra columns are kept.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import WORD, id_order, stored, text_hash, unpacked, whole_row

MIN_WORDS = 20
BLANKS = " \t\n\v\f\r"
RARE = 64
#: Groups that a line's, or a first holder's, documents are dealt to at most.
HOLDER_SALTS = 64
_KEY = ["_id", "_hash"]


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain of pairs, given by rising first place, whose second places rise too."""
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(tails, j)
        back.append(at[k - 1] if k else -1)
        tails[k : k + 1] = [j]
        at[k : k + 1] = [n]
    chain, n = [], at[-1] if at else -1
    while n >= 0:
        chain.append(pairs[n])
        n = back[n]
    return chain[::-1]


def _fixed_points(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    in_a, in_b = Counter(a), Counter(b)
    places = {x: j for j, x in enumerate(b) if in_b[x] == 1}
    pairs = [(i, places[x]) for i, x in enumerate(a) if in_a[x] == 1 and x in places]
    if pairs:
        return _increasing(pairs)
    seen: Counter = Counter()
    nth = {}
    for j, x in enumerate(b):
        nth[x, seen[x]] = j
        seen[x] += 1
    seen.clear()
    for i, x in enumerate(a):
        if (x, seen[x]) in nth:
            pairs.append((i, nth[x, seen[x]]))
        seen[x] += 1
    return _increasing(pairs)


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places (i, j) with a[i] == b[j], both rising."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        points = [(a0 + i, b0 + j) for i, j in _fixed_points(a[a0:a1], b[b0:b1])]
        out += points
        if points:
            for (i, j), (k, m) in zip([(a0 - 1, b0 - 1), *points], [*points, (a1, b1)]):
                if i + 1 < k and j + 1 < m:
                    todo.append((i + 1, k, j + 1, m))
    return sorted(out)


def _runs(lines: list[int], words: dict[int, int], min_words: int) -> Iterator[tuple[int, tuple[int, ...]]]:
    """(first place, lines) of the shortest runs of known lines with ``min_words`` words from and up to every place."""
    for n in range(len(lines)):
        for step in (1, -1):
            end, total = n, 0
            while 0 <= end < len(lines) and lines[end] in words and total < min_words:
                total += words[lines[end]]
                end += step
            if total >= min_words:
                yield (n, tuple(lines[n:end])) if step == 1 else (end + 1, tuple(lines[end + 1 : n + 1]))


def common_blocks(later: list[int], words: list[int], earlier: list[int], min_words: int) -> list[int]:
    """Places of ``later`` in blocks (consecutive on both sides) of at least ``min_words`` words.

    Aligned blocks first; then, of what is left, blocks that the alignment can't hold: in another order, or again.
    """
    shared = set(later) & set(earlier)
    if sum(w for x, w in zip(later, words) if x in shared) < min_words:
        return []
    gone, block, total = [], [], 0
    last = (-2, -2)
    for i, j in [*patience(later, earlier), (-5, -5)]:
        if (i, j) != (last[0] + 1, last[1] + 1):
            if total >= min_words:
                gone += block
            block, total = [], 0
        if i >= 0:
            block.append(i)
            total += words[i]
        last = (i, j)
    left = {n for n, x in enumerate(later) if x in shared} - set(gone)
    if sum(words[n] for n in left) >= min_words or gone and left:
        size = {later[n]: words[n] for n in range(len(later)) if later[n] in shared}
        held = {run for _, run in _runs(earlier, size, min_words)}
        again = {n for first, run in _runs(later, size, min_words) if run in held for n in range(first, first + len(run))}
        gone += sorted(again & left)
    return gone


def _align(min_words: int):
    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, hashes, places = [], [], []
            for row in batch.itertuples(index=False):
                gone = common_blocks(row.later.tolist(), row.words.tolist(), row.earlier.tolist(), min_words)
                ids += [row.later_id] * len(gone)
                hashes += [row.later_hash] * len(gone)
                places += gone
            yield pd.DataFrame({"_id": np.array(ids, np.int64), "_hash": np.array(hashes, np.int64), "place": np.array(places, np.int32)})

    return align


def line_tables(docs: DataFrame) -> DataFrame:
    """One row per document: hashes and numbers of words of its lines that have a word."""
    trimmed = F.transform(F.split("text", "\n"), lambda x: F.trim(x, F.lit(BLANKS)))
    rows = docs.select(id_order(F.col("doc_id")).alias("_id"), text_hash(F.col("text")).alias("_hash"), trimmed.alias("_lines"))
    rows = rows.withColumn("_lines", F.filter("_lines", lambda x: x != "")).filter(F.size("_lines") > 0)
    rows = rows.select(
        *_KEY,
        F.transform("_lines", lambda x: F.xxhash64(x)).alias("keys"),
        F.transform("_lines", lambda x: F.regexp_count(x, F.lit(WORD))).alias("words"),
    )
    return rows.groupBy(*_KEY).agg(F.first("keys").alias("keys"), F.first("words").alias("words"))


def _run_anchors(lines: DataFrame, min_words: int) -> DataFrame:
    """Documents with the first holder of each shortest run of several lines of a stretch with ``min_words`` words."""
    # A run holds the lines that begin less than min_words words after its own first one: at most min_words lines.
    words_before = F.sum("words").over(Window.partitionBy(*_KEY, "stretch").orderBy("place")) - F.col("words")
    run = Window.partitionBy(*_KEY, "stretch").orderBy("words_before").rangeBetween(0, min_words - 1)
    runs = lines.withColumn("words_before", words_before).select(
        *_KEY, "salt", F.sum("words").over(run).alias("run_words"), F.collect_list("line").over(run).alias("run_lines")
    )
    runs = runs.filter((F.col("run_words") >= min_words) & (F.size("run_lines") > 1))
    runs = runs.select(*_KEY, "salt", F.xxhash64("run_lines").alias("run"))
    salted = runs.groupBy("run", "salt").agg(F.count("*").alias("runs"), F.min(F.struct(*_KEY)).alias("first"))
    shared = salted.groupBy("run").agg(F.sum("runs").alias("runs"), F.min("first").alias("first")).filter("runs > 1")
    shared = salted.select("run", "salt").join(shared, "run")
    return runs.join(shared, ["run", "salt"]).filter(F.col("first") != F.struct(*_KEY)).select(*_KEY, "first")


def candidate_pairs(tables: DataFrame, min_words: int = MIN_WORDS, rare: int = RARE) -> DataFrame:
    """Rows (later_id, later_hash, earlier_id, earlier_hash)."""
    salt = F.pmod(F.xxhash64(*_KEY), F.lit(HOLDER_SALTS)).alias("salt")
    held = tables.select(*_KEY, salt, F.explode(F.array_distinct("keys")).alias("line"))
    salted = held.groupBy("line", "salt").agg(F.count("*").alias("docs"), F.min(F.struct(*_KEY)).alias("first"))
    shared = salted.groupBy("line").agg(F.sum("docs").alias("docs"), F.min("first").alias("first")).filter("docs > 1")
    # What is known of a line goes to every salt that has it, so a line of a third of all documents is no hot key.
    shared = salted.select("line", "salt").join(shared, "line")
    lines = tables.select(*_KEY, salt, F.posexplode(F.arrays_zip("keys", "words")).alias("place", "entry"))
    lines = lines.select(*_KEY, "salt", "place", F.col("entry.keys").alias("line"), F.col("entry.words").alias("words"))
    lines = lines.join(shared, ["line", "salt"]).withColumn("frequent", F.col("docs") > rare)
    stretch = F.col("place") - F.row_number().over(Window.partitionBy(*_KEY).orderBy("place"))
    lines = lines.withColumn("stretch", stretch)
    lines = lines.withColumn("total", F.sum("words").over(Window.partitionBy(*_KEY, "stretch"))).filter(F.col("total") >= min_words)
    run = F.col("place") - F.row_number().over(Window.partitionBy(*_KEY, "frequent").orderBy("place"))
    lines = lines.withColumn("run", run)
    lines = lines.withColumn("run_total", F.sum("words").over(Window.partitionBy(*_KEY, "frequent", "run")))
    anchors = lines.filter((~F.col("frequent") | (F.col("run_total") >= min_words)) & (F.col("first") != F.struct(*_KEY)))
    anchors = anchors.select(*_KEY, "first").unionAll(_run_anchors(lines, min_words))
    earlier = (F.col("first._id").alias("earlier_id"), F.col("first._hash").alias("earlier_hash"))
    return anchors.select(F.col("_id").alias("later_id"), F.col("_hash").alias("later_hash"), *earlier).distinct()


def deleted_lines(tables: DataFrame, min_words: int = MIN_WORDS, rare: int = RARE) -> DataFrame:
    """_id, _hash and the sorted places (among lines with a word) that go."""
    pairs = stored(candidate_pairs(tables, min_words, rare), "line-pairs")
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("later_id", "later_hash"), F.lit(HOLDER_SALTS)))
    holder = ["earlier_id", "earlier_hash"]
    earlier = tables.select(F.col("_id").alias("earlier_id"), F.col("_hash").alias("earlier_hash"), F.col("keys").alias("earlier"))
    handed = pairs.select(*holder, "salt").distinct().join(earlier, holder)
    later = tables.select(F.col("_id").alias("later_id"), F.col("_hash").alias("later_hash"), F.col("keys").alias("later"), "words")
    rows = pairs.join(handed, [*holder, "salt"]).select("later_id", "later_hash", "earlier")
    rows = rows.join(later, ["later_id", "later_hash"]).select("later_id", "later_hash", "later", "words", "earlier")
    gone = rows.mapInPandas(_align(min_words), "_id long, _hash long, place int")
    return gone.groupBy(*_KEY).agg(F.sort_array(F.collect_set("place")).alias("gone"))


def cut(text: str | None, gone: list[int] | None) -> tuple[str | None, int]:
    """The text without the given lines (counted among lines with a word), and its number of such lines."""
    if text is None:
        return None, 0
    lines = text.split("\n")
    full = [n for n, line in enumerate(lines) if line.strip(BLANKS)]
    if not gone:
        return text, len(full)
    if len(gone) == len(full):
        return "", len(full)
    dropped = {full[k] for k in gone}
    return "\n".join(line for n, line in enumerate(lines) if n not in dropped), len(full)


def cut_lines(docs: DataFrame, min_words: int = MIN_WORDS, rare: int = RARE) -> DataFrame:
    """row (all columns but text as one value), text (cut), n_lines and n_deleted (lines with a word) of every document."""
    tables = stored(line_tables(docs), "line-tables")
    gone = deleted_lines(tables, min_words, rare)
    own = docs.select(whole_row(docs, "text").alias("row"), "text", id_order(F.col("doc_id")).alias("_id"), text_hash(F.col("text")).alias("_hash"))
    rows = own.join(gone, _KEY, "left").select("row", "text", "gone")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, text, gone = (batch.column(c) for c in ("row", "text", "gone"))
            done = [cut(t.as_py(), g.as_py()) for t, g in zip(text, gone)]
            columns = [
                row,
                pa.array([kept for kept, _ in done], text.type),
                pa.array([n for _, n in done], pa.int64()),
                pa.array([len(g) if g.is_valid else 0 for g in gone], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["row", "text", "n_lines", "n_deleted"])

    numbers = [T.StructField("n_lines", T.LongType()), T.StructField("n_deleted", T.LongType())]
    return rows.mapInArrow(rewrite, T.StructType([*rows.schema.fields[:2], *numbers]))


def dedupe_lines(docs: DataFrame, min_words: int = MIN_WORDS, rare: int = RARE) -> DataFrame:
    """The rows of ``docs`` with ``text`` cut, and ``n_lines`` and ``n_deleted`` (lines with a word).

    Columns of the input that have one of these two names are replaced; see :func:`cut_lines` for a form that keeps them.
    """
    own = docs.drop("n_lines", "n_deleted")
    return cut_lines(own, min_words, rare).select(*unpacked(own, "row", {"text": F.col("text")}), "n_lines", "n_deleted")
