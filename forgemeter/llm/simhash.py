"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are computed from whole texts and stored with the ids only. Comparison runs over the
distinct fingerprints, so exact copies cost nothing. Two 64-bit fingerprints that differ in at most
``RADIUS`` bits agree in at least one of ``RADIUS + 1`` blocks of bits; rows are dealt out by block
value (a lossless partition), a value with many fingerprints is cut into tiles, and every pair of its
tiles is a group of its own. Inside a group the fingerprints are sorted by population count and
compared tile by tile with exclusive-or and bit counts; tile pairs whose population counts differ by
more than the radius are skipped. A group reports a spanning forest of its links, never all pairs.

Defined cases: a null or blank text has fingerprint zero and is linked like any other; repeated rows
share a component; the component of rows without any id is null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from .common import components, id_order, stored, text_hash, unpacked, whole_row

RADIUS = 4
SHINGLE_WORDS = 4
SEED = 42
#: (first bit, number of bits) of the RADIUS + 1 blocks.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Fingerprints of one block value in one tile; a group holds two tiles at most.
GROUP_TILE = 8192
COMPARED_TILE = 512
_BIT_ROWS = 4096


def shingle_hashes(raw: bytes | None) -> np.ndarray:
    """XXH64 of all shingles, repeats included, of a text in UTF-8."""
    words = raw.lower().split() if raw else []  # bytes: A-Z and the separators of ASCII only
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) < SHINGLE_WORDS:
        return np.array([xxh64_intdigest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, stops = (ends - lengths).tolist(), ends[SHINGLE_WORDS - 1 :].tolist()
    return np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops)], np.uint64)


def fingerprint(raw: bytes | None) -> int:
    """A bit is set if it is set in over half of the shingle hashes; as a signed 64-bit number."""
    hashes = shingle_hashes(raw)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BIT_ROWS):
        octets = hashes[at : at + _BIT_ROWS].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes)).view(">i8")[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = part.column("_text").cast(pa.binary())
            prints = pa.array([fingerprint(x.as_py()) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("_hash"), prints], ["doc_id", "_hash", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, _hash (of the text) and fp of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(F.col("text")).alias("_hash"), F.col("text").alias("_text"))
    return rows.mapInArrow(_fingerprint_batches, "doc_id long, _hash long, fp long")


def _hook(roots: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merges the trees of i[k] and j[k]; every tree's root is its smallest member."""
    while True:
        a, b = roots[i], roots[j]
        differ = a != b
        if not differ.any():
            return
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(roots, np.maximum(a, b), np.minimum(a, b))
        while (above := roots[roots]) is not None and not np.array_equal(above, roots):
            roots[:] = above


def linked(prints: np.ndarray, ones: np.ndarray, radius: int = RADIUS, tile: int = COMPARED_TILE) -> np.ndarray:
    """For each fingerprint (sorted by population count) the position of its root in the group."""
    roots = np.arange(len(prints))
    for a in range(0, len(prints), tile):
        left, most = prints[a : a + tile], ones[min(a + tile, len(prints)) - 1]
        for b in range(a, len(prints), tile):
            if ones[b] - most > radius:
                break
            near = np.bitwise_count(left[:, None] ^ prints[None, b : b + tile]) <= radius
            if a == b:
                np.fill_diagonal(near, False)
            if near.any():
                i, j = np.nonzero(near)
                _hook(roots, i + a, j + b)
    return roots


def _compare_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by group and population count; a group may run over several batches."""

    def found(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        keys = rows[["part", "first", "second"]].to_numpy()
        edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        prints, ones = rows["fp"].to_numpy(), rows["ones"].to_numpy()
        out_a, out_b = [], []
        for lo, hi in pairwise([0, *edges.tolist(), len(rows)]):
            if hi - lo > 1:
                own = prints[lo:hi]
                roots = linked(own.view(np.uint64), ones[lo:hi])
                moved = roots != np.arange(hi - lo)
                if moved.any():
                    out_a.append(own[moved])
                    out_b.append(own[roots[moved]])
        if out_a:
            yield pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})

    kept: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch[["part", "first", "second"]].to_numpy()
        before = np.flatnonzero((keys != keys[-1]).any(axis=1))
        last = int(before[-1]) + 1 if len(before) else 0  # where the last group begins
        if kept and (kept[-1][["part", "first", "second"]].to_numpy()[-1] != keys[0]).any():
            yield from found(pd.concat(kept))
            kept = []
        if last:
            yield from found(pd.concat([*kept, batch.iloc[:last]]))
            kept = []
        kept.append(batch.iloc[last:])
    if kept:
        yield from found(pd.concat(kept))


def links(prints: DataFrame, group_tile: int = GROUP_TILE) -> DataFrame:
    """Spanning links (a, b) between the distinct fingerprints ``fp`` of ``prints``."""
    parts = [
        F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << bits) - 1)) + F.lit(k << 13)
        for k, (first, bits) in enumerate(BLOCKS)
    ]
    dealt = prints.select("fp", F.bit_count("fp").alias("ones"), F.explode(F.array(*parts)).alias("part"))
    tiles = dealt.groupBy("part").agg(F.ceil(F.count("*") / group_tile).cast("int").alias("tiles")).filter("tiles > 0")
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    tiled = dealt.join(tiles, "part").withColumn("own", own)
    others = F.filter(F.sequence(F.lit(0), F.col("tiles") - 1), lambda x: (x != F.col("own")) | (F.col("tiles") == 1))
    grouped = tiled.withColumn("other", F.explode(others)).select(
        "part", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"), "ones", "fp"
    )
    return (
        grouped.repartition("part", "first", "second")
        .sortWithinPartitions("part", "first", "second", "ones")
        .mapInPandas(_compare_groups, "a long, b long")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, _hash, fp, root and component_id (the smallest id reachable over links) of every row."""
    rows = stored(fingerprints(docs), "simhash-prints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-distinct")
    roots = components(links(prints), "simhash-links").select(F.col("node").alias("fp"), "root")
    mapped = prints.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least_id")
    least = mapped.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_print = mapped.join(least, "root").select("fp", "root", "component_id")
    return rows.join(by_print, "fp").select("doc_id", "_hash", "fp", "root", "component_id")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint as 16 hexadecimal digits, component_id."""
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return near_duplicates(docs).select("doc_id", hexed.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, the first by id and then by text hash; its row comes whole."""
    key = F.struct(id_order(F.col("doc_id")).alias("_id"), F.col("_hash").alias("_hash"))
    chosen = near_duplicates(docs).groupBy("root").agg(F.min(key).alias("_key")).select("_key.*")
    own = docs.select(whole_row(docs).alias("row"), id_order(F.col("doc_id")).alias("_id"), text_hash(F.col("text")).alias("_hash"))
    rows = own.join(chosen, ["_id", "_hash"], "left_semi")
    return rows.dropDuplicates(["_id", "_hash"]).select(*unpacked(docs, "row"))
