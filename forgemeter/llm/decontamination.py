"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

A document is contaminated by a benchmark item of m characters if some region of its text is within
k = floor(m * ERROR_RATE) edits of the whole item (both in lower case, white space as single spaces).
By the q-gram lemma such a region shares at least (m - q + 1) - k q of the item's q-grams with it, all on
diagonals at most k apart from its first one, so they lie in one of the overlapping bands of 2 w
diagonals that begin at every multiple of w, for any w >= k, and that band has room for the whole alignment.
Bands with that many shared q-grams are kept, also those whose first w diagonals hold none of them.

Items often share a phrase, and a text may hold many copies of it; long grams then pass a band for each item and
copy. The lemma with a short gram asks for a larger part of the item: the bands of one place are held against the set of
its short grams together, and only items with enough of them there are verified by a banded alignment with free ends
in the text. A band is too narrow for two disjoint regions of an item, so the best region of each band,
best first and without overlap, gives every region that is not covered by a better one.

Items so short that the bound is not positive take a shorter q, and items shorter than that are searched
for exactly. Texts are worked on in windows, so what a task holds goes by the window and the block's index. The
benchmark is read in blocks of about ``BLOCK_CHARS`` characters (more only for one longer item); a block's index
is bounded, goes to every task, and the documents are scanned once per block, each block in tasks of its own.
Documents never leave their task, so no document, source or group of copies is a hot spot.

Defined cases: null and blank texts and items match nothing; equal items are each reported; a repeated
document row is reported once per row; all columns of a document are kept whatever their names; empty tables
give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import stored

ERROR_RATE = 0.08
Q = 10
#: Characters of benchmark items whose index one pass over the documents carries.
BLOCK_CHARS = 4_000_000
SHORT_Q = 3
#: Characters of a text whose bands are looked for at a time.
WINDOW = 1 << 14
_BINS = 4096
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BITMAP_BITS = 22
OUTPUT = "doc_id long, item_id long, edits int, begin long, end long"


def normalise(text: str) -> str:
    return " ".join(text.lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(points: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of every q-gram; equal grams have equal hashes, and a collision only adds work."""
    total = len(points) - q + 1
    if total <= 0:
        return np.empty(0, np.uint64)
    block, size, done, out = points.astype(np.uint64), 1, 0, np.zeros(total, np.uint64)
    while True:  # a gram is put together from blocks of 1, 2, 4 ... characters
        factor = np.uint64(pow(int(_MULTIPLIER), size, 1 << 64))
        if q & size:
            out = out * factor + block[done : done + total]
            done += size
        if done == q:
            break
        block = block[: len(block) - size] * factor + block[size:]
        size *= 2
    out ^= out >> np.uint64(29)
    out *= _MULTIPLIER
    return out


def budget(length: int) -> int:
    return int(length * ERROR_RATE)


def gram_size(length: int) -> int:
    """The largest q up to ``Q`` for which the lemma asks for at least one shared q-gram."""
    k = budget(length)
    return max(1, min(Q, length // (k + 1)))


@dataclass
class Index:
    """The q-grams of one block of items that share q: sorted hashes with their item and place."""

    q: int
    hashes: np.ndarray
    items: np.ndarray
    places: np.ndarray
    bitmap: np.ndarray


@dataclass
class Block:
    """Items, their indexes by q, and the short grams of all items one after the other (from, for item n, ``starts[n]``)."""

    ids: list[int | None]
    texts: list[np.ndarray]
    indexes: list[Index]
    lengths: np.ndarray
    budgets: np.ndarray
    widths: np.ndarray
    short: np.ndarray
    starts: np.ndarray


def build_block(rows: list[tuple[int | None, str | None]]) -> Block:
    kept = [(i, codes(t)) for i, text in rows if (t := normalise(text or ""))]
    by_q: dict[int, list[int]] = {}
    for n, (_, points) in enumerate(kept):
        by_q.setdefault(gram_size(len(points)), []).append(n)
    indexes = []
    for q, members in sorted(by_q.items()):
        grams = [gram_hashes(kept[n][1], q) for n in members]
        hashes = np.concatenate(grams)
        items = np.repeat(np.array(members, np.int64), [len(g) for g in grams])
        places = np.concatenate([np.arange(len(g)) for g in grams])
        order = np.argsort(hashes, kind="stable")
        bitmap = np.zeros(1 << _BITMAP_BITS, bool)
        bitmap[hashes >> np.uint64(64 - _BITMAP_BITS)] = True
        indexes.append(Index(q, hashes[order], items[order], places[order], bitmap))
    lengths = np.array([len(points) for _, points in kept], np.int64)
    budgets = np.array([budget(n) for n in lengths], np.int64)
    widths = np.maximum(np.maximum(budgets, np.minimum(8, lengths // 3)), 1)
    short = [short_grams(points) for _, points in kept]
    starts = np.concatenate([[0], np.cumsum([len(g) for g in short], dtype=np.int64)])
    joined = np.concatenate(short) if short else np.zeros(0, np.uint16)
    return Block([i for i, _ in kept], [p for _, p in kept], indexes, lengths, budgets, widths, joined, starts)


def short_grams(points: np.ndarray) -> np.ndarray:
    return (gram_hashes(points, SHORT_Q) >> np.uint64(48)).astype(np.uint16)


def _ranges(low: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The numbers low, low + 1 ... of each range of ``many``, one range after the other."""
    return np.repeat(low - np.cumsum(many) + many, many) + np.arange(int(many.sum()))


def shared_bands(points: np.ndarray, index: Index, block: Block) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Items, lowest and highest diagonals of the bands that meet the lemma's bounds, window by window."""
    hashes = gram_hashes(points, index.q)
    at = np.flatnonzero(index.bitmap[hashes >> np.uint64(64 - _BITMAP_BITS)])
    wanted = hashes[at]
    low = np.searchsorted(index.hashes, wanted, "left")
    many = np.searchsorted(index.hashes, wanted, "right") - low
    at, low, many = at[many > 0], low[many > 0], many[many > 0]
    if not len(at):
        return
    longest, widest = int(block.lengths.max()), int(block.widths.max())
    reach = longest + 2 * widest  # how far from its lowest diagonal a band's grams may lie
    step = max(WINDOW, 2 * reach)
    for begin in range(-longest - widest, len(points), step):
        a, z = np.searchsorted(at, (begin, begin + step + reach))
        if a < z:
            found = _bands_of_window(points, at[a:z], low[a:z], many[a:z], index, block, begin, begin + step)
            if len(found[0]):
                yield found


def _bands_of_window(
    points: np.ndarray, at: np.ndarray, low: np.ndarray, many: np.ndarray, index: Index, block: Block, begin: int, end: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bands whose lowest diagonal lies in [begin, end)."""
    entries = _ranges(low, many)
    items, places, texts = index.items[entries], index.places[entries], np.repeat(at, many)
    bound = np.maximum(block.lengths - index.q + 1 - block.budgets * index.q, 1)
    shift = int(block.lengths.max()) + 1
    cell = (texts - places + shift) // block.widths[items] + 1  # a shared gram counts in the bands that begin at cell and at cell - 1
    span = np.int64(cell.max() + 2)
    keys = items * span + cell
    in_order = np.sort(keys)
    seen = in_order[np.append(True, in_order[1:] != in_order[:-1])]
    # The lowest diagonals of a region may hold no shared gram, so a band may begin at an empty cell.
    starts = np.union1d(seen, seen - 1)
    n = np.searchsorted(in_order, starts + 2, "left") - np.searchsorted(in_order, starts, "left")
    item = starts // span
    lowest = (starts % span - 1) * block.widths[item] - shift
    kept = np.flatnonzero((n >= bound[item]) & (lowest >= begin) & (lowest < end))
    kept = kept[with_short_grams(points, block, item[kept], lowest[kept])]
    starts, item, lowest = starts[kept], item[kept], lowest[kept]
    # Unchanged grams pair off one to one, so as many different places must take part, in the item and in the text.
    taking_part = np.flatnonzero(np.isin(keys, np.concatenate([starts, starts + 1])))
    taking_part = taking_part[np.argsort(keys[taking_part], kind="stable")]
    keys, places, texts = keys[taking_part], places[taking_part], texts[taking_part]
    first = np.searchsorted(keys, starts, "left")
    n = np.searchsorted(keys, starts + 2, "left") - first
    for side in (places, texts):
        if not len(n):
            break
        base = int(side.min())
        size = np.int64(int(side.max()) - base + 1)
        pairs = np.unique(np.repeat(np.arange(len(n)), n) * size + side[_ranges(first, n)] - base)
        enough = np.bincount(pairs // size, minlength=len(n)) >= bound[item]
        first, n, item, lowest = first[enough], n[enough], item[enough], lowest[enough]
    return item, lowest, lowest + 2 * block.widths[item] - 1


def with_short_grams(points: np.ndarray, block: Block, item: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which of the bands of the items, that begin at diagonals ``first``, hold as many of their item's short grams as the lemma asks for.

    The bands of one place are held against one set of grams, that of the widest of them.
    """
    passed = np.ones(len(item), bool)
    asked = block.lengths - SHORT_Q + 1 - block.budgets * SHORT_Q
    order = np.argsort(first, kind="stable")
    for here in np.split(order, np.flatnonzero(np.diff(first[order])) + 1):
        here = here[asked[item[here]] > 0]
        if not len(here):
            continue
        place = first[here[0]]
        until = int((place + 2 * block.widths[item[here]] + block.lengths[item[here]]).max())
        known = np.zeros(1 << 16, bool)
        known[short_grams(points[max(0, int(place)) : max(0, until)])] = True
        low = block.starts[item[here]]
        many = block.starts[item[here] + 1] - low
        held = np.add.reduceat(known[block.short[_ranges(low, many)]].astype(np.int64), np.cumsum(many) - many)
        passed[here] = held >= asked[item[here]]
    return passed


def banded_distance(item: np.ndarray, text: np.ndarray, first: int, last: int, most: int) -> tuple[int, int, int] | None:
    """Least edits, at most ``most``, between the item and any region of the text on diagonals first to last.

    Returns (edits, begin, end) of the best region: fewest edits, then the first end. Row by row over
    the item; a cell's column is its diagonal, so a row is one vector; insertions run along it.
    Characters before and after the text equal nothing, which costs what dropping the item's would.
    """
    size = last - first + 1
    left, right = max(0, -first), max(0, last + len(item) - len(text))
    middle = text[max(0, first) : max(0, min(len(text), last + len(item)))].astype(np.int64)
    padded = np.concatenate([np.full(left, -1), middle, np.full(right, -1)])
    steps, cost, begin = np.arange(size), np.zeros(size, np.int64), np.arange(first, last + 1)
    for i, char in enumerate(item.astype(np.int64)):
        best, start = cost + (padded[i : i + size] != char), begin.copy()
        dropped = cost[1:] + 1  # the item's character has no partner
        use = np.flatnonzero(dropped < best[:-1])
        best[use], start[use] = dropped[use], begin[use + 1]
        # A character of the text has no partner: from an earlier diagonal of the same row.
        level = best - steps
        through = np.minimum.accumulate(level)
        cost = through + steps
        if cost.min() > most:
            return None
        begin = start[np.maximum.accumulate(np.where(level == through, steps, 0))]
    n = int(cost.argmin())
    limit = len(text)
    return int(cost[n]), min(max(int(begin[n]), 0), limit), min(max(first + n + len(item), 0), limit)


def matches(text: str | None, block: Block) -> list[tuple[int, int, int, int]]:
    """(item, edits, begin, end) of all regions that hold an item: of regions that overlap the best, then the first."""
    if not text or not block.indexes:
        return []
    points = codes(normalise(text))
    found: dict[int, set[tuple[int, int, int]]] = {}
    for index in block.indexes:
        for items, firsts, lasts in shared_bands(points, index, block):
            for item, first, last in zip(items.tolist(), firsts.tolist(), lasts.tolist()):
                pattern = block.texts[item]
                region = banded_distance(pattern, points, first, last, budget(len(pattern)))
                if region:
                    found.setdefault(item, set()).add((region[0], region[2], region[1]))
    out = []
    for item, regions in found.items():
        taken: list[tuple[int, int]] = []
        for edits, end, begin in sorted(regions):
            if all(end <= a or begin >= z for a, z in taken):
                taken.append((begin, end))
                out.append((item, edits, begin, end))
    return sorted(out, key=lambda m: (m[0], m[2]))


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[Block]:
    """The benchmark in bounded blocks, by running sums of item lengths within bins and over the bins."""
    own = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    own = own.withColumn("chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).filter("chars > 0")
    own = own.withColumn("bin", F.pmod(F.xxhash64("item_id", "text"), F.lit(_BINS)))
    sums = own.groupBy("bin").agg(F.sum("chars").alias("in_bin"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("bin", F.coalesce(F.sum("in_bin").over(before.orderBy("bin")), F.lit(0)).alias("start"))
    running = F.coalesce(F.sum("chars").over(before.partitionBy("bin").orderBy("item_id", "text")), F.lit(0))
    placed = own.withColumn("running", running).join(F.broadcast(starts), "bin")
    placed = placed.withColumn("block", F.floor((F.col("start") + F.col("running")) / block_chars))
    placed = stored(placed.select("block", "item_id", "text"), "benchmark-blocks")
    for n in [row[0] for row in placed.select("block").distinct().sort("block").collect()]:
        rows = placed.filter(F.col("block") == n).select("item_id", "text").sort("item_id", "text").collect()
        yield build_block([tuple(row) for row in rows])


def leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, edits and the region [begin, end) in the normalised text, for every match."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for block in _blocks(benchmark, block_chars):
        shared = spark.sparkContext.broadcast(block)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for batch in batches:
                found = []
                for doc, text in zip(batch.column("doc_id"), batch.column("text")):
                    found += [(doc.as_py(), block.ids[i], e, b, z) for i, e, b, z in matches(text.as_py(), block)]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                columns = list(zip(*found)) or [[]] * 5
                arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "item_id", "edits", "begin", "end"])

        part = rows.mapInArrow(scan, OUTPUT)
        out = part if out is None else out.unionAll(part)
    return rows.sparkSession.createDataFrame([], OUTPUT) if out is None else out


def clean_documents(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` without a match, unchanged; texts are judged one by one, ids play no part.

    With one block a task drops what matches it. With more, each block marks texts in tasks of its own, so a worker
    never holds two indexes, and what is marked goes by an anti-join on a hash of the text.
    """
    spark = docs.sparkSession

    def filtered(rows: DataFrame, block: Block, matching: bool) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("text"))
                yield batch.filter(pa.array([bool(matches(text.as_py(), shared.value)) == matching for text in texts], pa.bool_()))

        return rows.mapInArrow(keep, rows.schema)

    blocks = _blocks(benchmark, block_chars)
    first = next(blocks, None)
    second = next(blocks, None)
    if first is None:
        return docs
    if second is None:
        return filtered(docs, first, False)
    text = docs.select(F.col("text").cast("string").alias("text"))
    marked = filtered(text, first, True).union(filtered(text, second, True))
    for block in blocks:
        marked = marked.union(filtered(text, block, True))
    named = [F.sha2(F.col("text").cast("string"), 256).alias("h")]
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *named)
    kept = whole.join(marked.select(*named).distinct(), "h", "left_anti")
    return kept.select("row.*")
