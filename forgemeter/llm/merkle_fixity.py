"""Merkle fixity audit of web-archive replicas.

A record is the archive text of one page (header and payload); an archive file holds the records of
``FILE_RECORDS`` consecutive ids, in order. Leaves are the files' record places in order of their offsets, a node is the hash
of the up to ``FANOUT`` children of its range, and both replicas' trees share the same ranges. The audit
compares roots and descends only where the hashes of a range differ, level by level with joins on the
node, down to the records at fault and their offsets in the primary.

A place may hold repeated records (or all records without an id): its leaf hash is made from their number
and sums of their digests, which are aggregated before the shuffle, so no place is ever gathered.

Defined cases: null url and html count as empty; records without an id share the place -1; empty replicas
have equal, empty trees; a replica without any record misses everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored

FANOUT = 16
FILE_RECORDS = 1000
_DIGEST_PARTS = (1, 17, 33, 49)


def archive_record(page_id: Column, url: Column, html: Column) -> Column:
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def hashed_records(pages: DataFrame) -> DataFrame:
    """place, bytes and digest of every record of a replica with columns page_id, url, html."""
    record = archive_record(F.col("page_id"), F.col("url"), F.col("html"))
    rows = pages.select(F.coalesce(F.col("page_id").cast("long"), F.lit(-1)).alias("place"), record.alias("record"))
    return rows.select("place", F.octet_length("record").cast("long").alias("bytes"), F.sha2("record", 256).alias("digest"))


def leaves(records: DataFrame) -> DataFrame:
    """node (the place), records, bytes and hash."""
    parts = {f"d{k}": F.sum(F.conv(F.substring("digest", at, 15), 16, 10).cast("decimal(20,0)")) for k, at in enumerate(_DIGEST_PARTS)}
    grouped = records.groupBy(F.col("place").alias("node")).agg(
        F.count("*").alias("records"), F.sum("bytes").alias("bytes"), *[value.alias(name) for name, value in parts.items()]
    )
    content = F.concat_ws(":", "records", "bytes", *[F.col(name).cast("string") for name in parts])
    return grouped.select("node", "records", "bytes", F.sha2(content.cast("binary"), 256).alias("hash"))


def _parent(node: Column) -> Column:
    return F.floor(node / F.lit(float(FANOUT))).cast("long")


def trees(primary: DataFrame, replica: DataFrame) -> list[DataFrame]:
    """Stored levels from the leaves up, each with ``side`` (0 primary, 1 replica), node and hash."""
    both = leaves(hashed_records(primary)).withColumn("side", F.lit(0))
    both = both.union(leaves(hashed_records(replica)).withColumn("side", F.lit(1)))
    levels = [stored(both, "merkle-leaves")]
    low, high = levels[0].agg(F.min("node"), F.max("node")).first()
    while low is not None and (low < -1 or high > 0):
        below = levels[-1].select("side", _parent(F.col("node")).alias("parent"), "node", "hash")
        children = F.sort_array(F.collect_list(F.struct("node", "hash")))  # FANOUT at most
        nodes = below.groupBy("side", "parent").agg(children.alias("children"))
        content = F.concat_ws("|", F.transform("children", lambda c: F.concat_ws(":", c["node"].cast("string"), c["hash"])))
        levels.append(stored(nodes.select("side", F.col("parent").alias("node"), F.sha2(content.cast("binary"), 256).alias("hash")), "merkle-level"))
        low, high = low // FANOUT, high // FANOUT
    return levels


def _differing(level: DataFrame) -> DataFrame:
    """Nodes whose hashes differ between the sides, or that one side lacks."""
    sums = level.groupBy("node").agg(F.count("*").alias("sides"), F.min("hash").alias("least"), F.max("hash").alias("most"))
    return sums.filter("sides < 2 OR least <> most").select("node")


def suspects(levels: list[DataFrame]) -> DataFrame:
    """Leaves at fault: from the roots down, only the children of differing nodes are compared."""
    wrong = _differing(levels[-1])
    for level in levels[-2::-1]:
        below = level.withColumn("parent", _parent(F.col("node")))
        wrong = _differing(below.join(wrong.withColumnRenamed("node", "parent"), "parent", "left_semi"))
    return wrong


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """file, place, offset and bytes in the primary, records on both sides, and kind of every fault.

    Kinds: missing (not in the replica), extra (only there), changed.
    """
    levels = trees(primary, replica)
    wrong = stored(suspects(levels), "merkle-suspects")
    file = F.floor(F.col("node") / F.lit(float(FILE_RECORDS))).cast("long")
    sides = levels[0].withColumn("file", file)
    in_file = Window.partitionBy("file").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    files = wrong.select(file.alias("file")).distinct()
    placed = sides.filter("side = 0").join(files, "file", "left_semi")
    placed = placed.withColumn("offset", F.coalesce(F.sum("bytes").over(in_file), F.lit(0)))
    first = wrong.join(placed.select("node", "offset", "bytes", F.col("records").alias("primary_records")), "node", "left")
    second = levels[0].filter("side = 1").join(wrong, "node", "left_semi").select("node", F.col("records").alias("replica_records"))
    found = first.join(second, "node", "left")
    kind = F.when(F.col("replica_records").isNull(), "missing").when(F.col("primary_records").isNull(), "extra").otherwise("changed")
    return found.select(
        file.alias("file"),
        F.col("node").alias("place"),
        "offset",
        "bytes",
        F.coalesce("primary_records", F.lit(0)).cast("long").alias("primary_records"),
        F.coalesce("replica_records", F.lit(0)).cast("long").alias("replica_records"),
        kind.alias("kind"),
    )
