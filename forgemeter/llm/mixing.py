"""Mixes sources to target weights by a multivariate-hypergeometric splitting tree.

The documents of a source, in a pseudo-random order of their ids, lie on a line of words that is cut
into blocks of equal length. A source's target gives its exact quota of blocks: whole passes over a
permutation of its blocks, then a part of one more. A binary tree splits the vector of all quotas among
the output shards: each node draws the left half's share from a multivariate hypergeometric
distribution, so every shard gets its exact number of blocks, with the composition of a random shuffle.
Each shard then takes its own range of every source's permuted blocks, disjoint from the others', and
shuffles them locally.

Places on the line are running sums in two levels (buckets of the order key, then inside a bucket), so
a hot source is spread over tens of thousands of groups. Rows per source and shard are the only
things gathered by source.

Defined cases: a null or blank text has size 0 and is never taken; a null source is a source of its own,
after all others; repeated rows are documents of their own; documents without an id are ordered by their text and copy; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import id_order, stored, text_hash, unpacked, whole_row, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2
BLOCK_WORDS = 1024
LEAST_BLOCKS = 256
SHARDS = 64
#: Steps of the permutation of a source's blocks, block = (step * n + start) mod blocks; primes. The seed and the source
#: choose one of them and the start; the other step takes the place of one that divides the number of blocks.
STEPS, OTHER_STEP = (1000003, 1000033, 1000037, 1000039, 1000081, 1000099, 1000117, 1000121), 999983
_DRAW_LIMIT = 500_000_000
_SOURCE = ["no_source", "src"]


def documents_line(docs: DataFrame) -> DataFrame:
    """One row per document with its size, its order key and ``copy``, which tells repeated rows apart."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").isNull().alias("no_source"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("src"),
        word_count(F.col("text")).alias("size"),
        text_hash(F.col("text")).alias("hash"),
        F.when(F.col("doc_id").isNull(), F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))).alias("said"),
    )
    copy = F.row_number().over(Window.partitionBy("doc_id", "hash").orderBy(*_SOURCE))
    rows = rows.withColumn("copy", copy)
    nameless = F.concat(F.lit(":"), F.col("said"), F.lit(":"), F.col("copy").cast("string"))
    own = F.coalesce(F.col("doc_id").cast("string"), nameless)
    order = F.md5(F.concat(F.lit("mix:"), own).cast("binary"))
    return rows.withColumns({"order": order, "bucket": F.substring(order, 1, 4)}).drop("said")


def source_targets(line: DataFrame) -> DataFrame:
    """Per source: words, target, block length, number of blocks and quota of blocks.

    Water filling in closed form: with sources by rising cap per weight, the level is the largest
    quotient of what is left after the first k caps and the weights from k on.
    """
    sums = line.groupBy(*_SOURCE).agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(*_SOURCE)
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), F.pmod(F.row_number().over(by_name) - 1, len(WEIGHTS)) + 1)
    rows = sums.withColumns({"weight": weight, "source_no": F.row_number().over(by_name).cast("long")})
    cap = F.col("source_size") * MOST_REPEATS
    by_cap = Window.orderBy(cap / F.col("weight"), "source_no")
    capped = F.coalesce(F.sum(cap).over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy()) * SHARE
    rows = rows.withColumn("level", (total - capped) / rest)
    level = F.max("level").over(Window.partitionBy())
    rows = rows.withColumn("target", F.least(cap.cast("double"), F.col("weight") * level)).drop("level")
    length = F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.ceil(F.col("source_size") / LEAST_BLOCKS))).cast("long")
    rows = rows.withColumn("length", length).withColumn("blocks", F.ceil(F.col("source_size") / F.col("length")).cast("long"))
    quota = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * F.col("blocks") + 0.5))
    return rows.withColumn("quota", F.coalesce(quota, F.lit(0)).cast("long"))


def hypergeometric(rng: np.random.Generator, counts: np.ndarray, take: int) -> np.ndarray:
    """How many of each kind are among ``take`` drawn from ``counts``; huge counts are drawn in layers."""
    layers = int(counts.sum() // _DRAW_LIMIT) + 1
    drawn, left, wanted = np.zeros_like(counts), counts.copy(), take
    for layer in range(layers, 0, -1):
        part = left // layer
        size = wanted if layer == 1 else min(round(wanted * int(part.sum()) / max(int(left.sum()), 1)), int(part.sum()))
        drawn += rng.multivariate_hypergeometric(part, size, method="marginals")
        left -= part
        wanted -= size
    return drawn


def shard_quotas(targets: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """Rows (source_no, shard, quota): every level of the tree splits each node's vector in two.

    ``shards`` is a power of two. A group is one node: a row per source.
    """

    def split(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        level, node = int(rows["level"].iloc[0]), int(key[0])
        rows = rows.sort_values("source_no")
        counts = rows["quota"].to_numpy(np.int64)
        rng = np.random.default_rng([seed, level, node])
        total = int(counts.sum())
        left = hypergeometric(rng, counts, total // 2 + (total % 2 and int(rng.integers(2))))
        halves = [rows.assign(node=2 * node + k, level=level + 1, quota=half) for k, half in enumerate((left, counts - left))]
        return pd.concat(halves)[["source_no", "node", "level", "quota"]]

    nodes = targets.select("source_no", F.lit(0).cast("long").alias("node"), F.lit(0).alias("level"), "quota")
    for _ in range(shards.bit_length() - 1):
        nodes = nodes.groupBy("node").applyInPandas(split, "source_no long, node long, level int, quota long")
    return nodes.select("source_no", F.col("node").cast("int").alias("shard"), "quota")


def block_draws(targets: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """One row per drawn block: source_no, block, shard, pass (0 first) and place, its rank in the shard's shuffle."""
    window = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum("quota").over(window), F.lit(0))
    ranges = shard_quotas(targets, shards, seed).withColumn("begin", begin).filter("quota > 0")
    ranges = ranges.join(targets.select("source_no", "blocks"), "source_no")
    chunk = 4096  # two explodes, so that no array grows with the input
    ranges = ranges.withColumn("at", F.explode(F.expr(f"sequence(0L, quota - 1, {chunk}L)")))
    drawn = ranges.withColumn("n", F.explode(F.expr(f"sequence(begin + at, begin + least(at + {chunk}, quota) - 1)")))
    chance = F.md5(F.concat(F.lit(f"blocks:{seed}:"), F.col("source_no").cast("string")).cast("binary"))
    start, choice = (F.conv(F.substring(chance, at, 8), 16, 10).cast("long") for at in (1, 9))
    step = F.element_at(F.array(*[F.lit(s) for s in STEPS]), (choice % len(STEPS)).cast("int") + 1)
    step = F.when(F.col("blocks") % step != 0, step).otherwise(F.lit(OTHER_STEP)).cast("long")
    block = ((F.col("n") % F.col("blocks")) * step + start) % F.col("blocks")
    return drawn.select(
        "source_no",
        block.alias("block"),
        "shard",
        F.expr("n div blocks").cast("int").alias("pass"),
        F.xxhash64(F.lit(seed), "shard", "source_no", "n").alias("place"),
    )


def mix(docs: DataFrame, shards: int = SHARDS, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """The documents on their lines (with source_size and target), and the pieces that are taken.

    A piece is (doc_id, hash, copy, from_word, words, shard, pass, place): the words of one document
    inside one drawn block; shards order their pieces by place, then by document.
    """
    rows = stored(documents_line(docs), "mix-documents")
    targets = stored(source_targets(rows), "mix-targets")
    buckets = rows.groupBy(*_SOURCE, "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy(*_SOURCE).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.withColumn("offset", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words")
    offsets = offsets.join(targets.drop("weight"), _SOURCE)
    inside = Window.partitionBy(*_SOURCE, "bucket").orderBy("order", "size", id_order(F.col("doc_id")), "hash", "copy")
    end = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    line = rows.withColumn("end", end).join(offsets, [*_SOURCE, "bucket"])
    line = line.withColumn("end", F.col("end") + F.col("offset")).withColumn("begin", F.col("end") - F.col("size"))
    blocks = F.explode(F.expr("sequence(begin div length, (end - 1) div length)")).alias("block")
    cut = line.filter("size > 0").select("source_no", "doc_id", "hash", "copy", "begin", "end", "length", blocks)
    first = F.greatest("begin", F.col("block") * F.col("length"))
    last = F.least("end", (F.col("block") + 1) * F.col("length"))
    pieces = cut.select(
        "source_no", "block", "doc_id", "hash", "copy", (first - F.col("begin")).alias("from_word"), (last - first).alias("words")
    ).join(block_draws(targets, shards, seed), ["source_no", "block"])
    return line, pieces.drop("block", "source_no")


def _taken(docs: DataFrame, shards: int, seed: int) -> tuple[DataFrame, DataFrame]:
    line, pieces = mix(docs, shards, seed)
    piece = F.struct("shard", "place", F.col("pass").alias("pass_no"), "from_word", "words")
    taken = pieces.groupBy(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"), F.col("copy").alias("_copy"))
    return line, taken.agg(F.sum("words").alias("taken"), F.sort_array(F.collect_list(piece)).alias("pieces"))


def digest(docs: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every document."""
    line, taken = _taken(docs, shards, seed)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")) & (F.col("copy") == F.col("_copy"))
    source = F.when(~F.col("no_source"), F.col("src")).alias("source")
    return line.join(taken.drop("pieces"), same, "left").select(
        "doc_id", source, "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """The documents that the mix takes, whole rows, with ``taken`` and ``pieces``: where their words go.

    Where the input has a column of one of these names, the new one is called ``mix_taken`` or ``mix_pieces``.
    """
    _, taken = _taken(docs, shards, seed)
    own = docs.select(
        whole_row(docs).alias("row"), F.col("doc_id").cast("long").alias("id"), text_hash(F.col("text")).alias("hash"),
        F.col("source").isNull().alias("no"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("src"),
    )
    own = own.withColumn("copy", F.row_number().over(Window.partitionBy("id", "hash").orderBy("no", "src")))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")) & (F.col("copy") == F.col("_copy"))
    present = {c.lower() for c in docs.columns}
    new = [F.col(c).alias(f"mix_{c}" if c in present else c) for c in ("taken", "pieces")]
    return own.join(taken, same).select(*unpacked(docs, "row"), *new)
