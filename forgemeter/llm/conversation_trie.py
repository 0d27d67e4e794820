"""Prefix trie of rebuilt conversations, by whole-sequence collapse.

Identical conversations are one weighted sequence first, with a list of the conversations that end there. From
then on only distinct sequences are worked on: those that are proper prefixes of others go by an anti-join, which leaves
the leaves, and prefixes of the weighted sequences are aggregated to the nodes of the trie.

Why sums over subtrees need no descent: the sequences through a node are those through its whole subtree. What
a sequence adds below a depth is a difference of its running word counts. What every node of the subtree adds only
once is added by the sequence that owns it, that of its smallest member; a sequence owns its path from some depth on.

Hot keys: a conversation is numbered by a range sort and sums over its stretches, so one with a third of all turns lies
in many tasks; prefix hashes go by blocks of depth. Identical conversations are counted before anything joins,
and their ids are joined to one list in pieces of 1,024 ids, which one task only hashes, piece by piece.

Defined cases: turns are ordered by turn (null first), ties by the hash of role and text; repeated rows are repeated
turns; null roles and texts are empty; turns without a conversation id belong to no conversation and are left
out; an empty table gives no rows; extra columns are ignored. A text is read whole, once; hashes (128 bits) stand
for it afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored, word_count

#: A conversation takes at most this many turns less one from its donor.
HEAD = 4
#: Conversations whose ids agree up to this step share a donor.
FAMILY = 20
DEPTH_BLOCK_BITS = 10
ID_RANGE_BITS = 10
NO_IDS = hashlib.sha256(b"").hexdigest()

_PATH = ["depth", "x0", "x1"]


def said(chats: DataFrame) -> DataFrame:
    """conv, turn, said (hash of role and text), words of every turn with a conversation id."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = chats.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), key.alias("said"), word_count(text).alias("words"))
    return rows.filter("conv IS NOT NULL")


def numbered(turns: DataFrame) -> DataFrame:
    """Turns with their place in the conversation, from 1: conv, place, said, words.

    Rows are dealt out by range of (conv, turn, said, copy), so a conversation of any size is cut into
    stretches of about a task each; a stretch starts after the sum of those before it.
    """
    order = ["conv", F.col("turn").asc_nulls_first(), "said", "copy"]
    rows = turns.groupBy("conv", "turn", "said", "words").agg(F.count("*").alias("copies"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies")
    dealt = stored(stored(rows, "chat-turns").repartitionByRange(*order).withColumn("stretch", F.spark_partition_id()), "chat-stretches")
    sizes = dealt.groupBy("conv", "stretch").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("conv", "stretch", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("conv", "stretch").orderBy(*order[1:])
    ranked = dealt.withColumn("in_stretch", F.row_number().over(inside)).join(starts, ["conv", "stretch"])
    return ranked.select("conv", (F.col("start") + F.col("in_stretch")).cast("long").alias("place"), "said", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt turns (conv, depth, said, words), and all conversations (conv), turnless ones included."""
    convs = turns.groupBy("conv").agg(F.max("place").alias("n"))
    heads = turns.filter((F.col("conv") % FAMILY == 0) & (F.col("place") < HEAD)).withColumnRenamed("conv", "donor")
    share = F.crc32(F.col("conv").cast("string").cast("binary")) % HEAD
    plan = convs.select("conv", (F.col("conv") - F.col("conv") % FAMILY).alias("donor"), share.alias("h"))
    lengths = convs.select(F.col("conv").alias("donor"), F.col("n").alias("donor_n"))
    plan = plan.join(lengths, "donor", "left").withColumn("taken", F.least("h", F.coalesce("donor_n", F.lit(0)))).drop("donor_n")
    taken = plan.filter("taken > 0").join(heads, "donor").filter("place <= taken")
    own = turns.join(plan, "conv").filter("place > h")
    rows = taken.select("conv", F.col("place").alias("depth"), "said", "words").union(
        own.select("conv", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "said", "words")
    )
    return rows, convs.select("conv")


def _bits(values: Column) -> Column:
    return F.coalesce(values, F.lit(0).cast("long"))


def rolling(rows: DataFrame) -> DataFrame:
    """Every rebuilt turn with the 128-bit hash of the sequence up to it, and the words up to it.

    The hash of a prefix is the exclusive or of hashes of (depth, turn), so it goes by blocks of depths.
    """
    rows = rows.select(
        "conv", "depth", "words", F.shiftright("depth", DEPTH_BLOCK_BITS).alias("block"),
        *[F.xxhash64(F.lit(seed), "depth", "said").alias(f"t{seed}") for seed in (0, 1)],
    )
    sums = rows.groupBy("conv", "block").agg(F.bit_xor("t0").alias("b0"), F.bit_xor("t1").alias("b1"), F.sum("words").alias("bw"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(
        "conv", "block", _bits(F.bit_xor("b0").over(earlier)).alias("b0"), _bits(F.bit_xor("b1").over(earlier)).alias("b1"),
        _bits(F.sum("bw").over(earlier)).alias("bw"),
    )
    running = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    x0, x1 = (F.bit_xor(f"t{s}").over(running).bitwiseXOR(F.col(f"b{s}")) for s in (0, 1))
    joined = rows.join(before, ["conv", "block"])
    done = joined.select("conv", "depth", "words", "t0", "t1", x0.alias("x0"), x1.alias("x1"), (F.sum("words").over(running) + F.col("bw")).alias("upto"))
    return done.select(
        "conv", "depth", "x0", "x1", "words", "upto",
        F.col("x0").bitwiseXOR(F.col("t0")).alias("up0"), F.col("x1").bitwiseXOR(F.col("t1")).alias("up1"),
    )


def _hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists come in pieces sorted by sequence and piece; one hash runs at a time, so a list of any length is never held."""
    key, state = None, None
    for batch in batches:
        done: list[tuple] = []
        for now, ids in zip(batch.column("seq").to_pylist(), batch.column("ids").to_pylist()):
            if now == key:
                state.update(b",")
            else:
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = now, hashlib.sha256()
            state.update(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done])], names=["seq", "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([state.hexdigest()])], names=["seq", "ends_sha256"])


def end_hashes(members: DataFrame) -> DataFrame:
    """seq, ends_sha256 from (seq, conv): the hash of the ids in numeric order with commas between."""
    pieces = members.groupBy("seq", F.shiftright("conv", ID_RANGE_BITS).alias("piece")).agg(F.sort_array(F.collect_set("conv")).alias("convs"))
    pieces = pieces.select("seq", "piece", F.array_join(F.transform("convs", lambda c: c.cast("string")), ",").alias("ids"))
    # Written before they meet: lists are put together by (sequence, piece), and one task reads only the pieces.
    in_order = stored(pieces, "chat-ends").repartition("seq").sortWithinPartitions("seq", "piece")
    return in_order.select("seq", "ids").mapInArrow(_hash_lists, "seq long, ends_sha256 string")


def sequences(path_rows: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct rebuilt conversations (seq is the smallest id that has it) with weight and length; and (seq, conv)."""
    zero = F.lit(0).cast("long")
    ends = path_rows.groupBy("conv").agg(F.max(F.struct("depth", "x0", "x1", "upto")).alias("e"))
    whole = convs.join(ends, "conv", "left").select("conv", *[F.coalesce(f"e.{c}", zero).alias(c) for c in [*_PATH, "upto"]])
    whole = stored(whole, "chat-whole")
    distinct = whole.groupBy(*_PATH).agg(F.min("conv").alias("seq"), F.count("*").alias("weight"), F.max("upto").alias("total"))
    members = whole.join(distinct.select(*_PATH, "seq"), _PATH).select("seq", "conv")
    return distinct.withColumnRenamed("depth", "n"), members


def nodes(chats: DataFrame) -> DataFrame:
    """One row per node of the trie: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows, convs = rebuilt(stored(numbered(said(chats)), "chat-places"))
    prefix_rows = stored(rolling(rows), "chat-prefixes")
    distinct, members = sequences(prefix_rows, convs)
    distinct = stored(distinct, "chat-sequences")

    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    paths = prefix_rows.join(distinct.select(F.col("seq").alias("conv")), "conv").withColumnRenamed("conv", "seq")
    roots = distinct.select("seq", zero.alias("depth"), zero.alias("x0"), zero.alias("x1"), zero.alias("words"), zero.alias("upto"), none.alias("up0"), none.alias("up1"))
    paths = stored(paths.unionByName(roots), "chat-paths")

    inner = paths.join(distinct.select("seq", "n"), "seq").filter("depth < n").select(F.col("depth").alias("n"), "x0", "x1").distinct()
    leaves = distinct.join(inner, ["n", "x0", "x1"], "left_anti").select("seq", F.lit(1).cast("long").alias("leaf"))

    place = F.struct("seq", "up0", "up1", (F.col("upto") - F.col("words")).alias("before"))
    owners = stored(paths.groupBy(*_PATH).agg(F.min(place).alias("o")).select(*_PATH, "o.*"), "chat-owners")
    first = owners.groupBy("seq").agg(F.min(F.struct("depth", "up0", "up1", "before")).alias("f")).select("seq", "f.*")
    above = owners.select((F.col("depth") + 1).alias("depth"), F.col("x0").alias("up0"), F.col("x1").alias("up1"), F.col("seq").alias("up_seq"))
    first = first.join(above, ["depth", "up0", "up1"], "left").select("seq", F.col("depth").alias("own"), F.col("before").alias("own_before"), "up_seq")

    known = distinct.select("seq", "n", "weight", "total").join(leaves, "seq", "left").join(first, "seq", "left")
    known = stored(known.join(end_hashes(members), "seq", "left"), "chat-known")

    depth, total = F.col("depth"), F.col("total")
    before = F.col("upto") - F.col("words")
    copies = F.col("weight") * (total - before)
    once = F.when(F.col("own").isNull(), 0).when(depth >= F.col("own"), total - before).otherwise(total - F.col("own_before"))
    parent = F.when(depth > F.col("own"), F.col("seq")).otherwise(F.col("up_seq"))
    per_node = paths.join(known, "seq").groupBy(*_PATH).agg(
        F.min(F.struct("seq", parent.alias("parent"))).alias("top"),
        F.sum("weight").alias("n_convs"),
        F.count(F.when((F.col("own") <= depth + 1) & (F.col("n") > depth), 1)).alias("n_children"),
        F.count("leaf").alias("n_leaves"),
        F.sum(copies - once).alias("saved_tokens"),
        F.coalesce(F.max(F.when(depth == F.col("n"), F.col("ends_sha256"))), F.lit(NO_IDS)).alias("ends_sha256"),
    )
    return per_node.select(
        F.col("top.seq").alias("conv_id"), "depth", F.col("top.parent").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    )
