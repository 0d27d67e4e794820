"""Chat formatting with cumulative-snapshot collapse, in DataFrame operations only.

A chat log often holds the same conversation again and again, each time with a few more turns. Rolling
prefix hashes identify a conversation that is a prefix of a longer one: each turn adds the hash of its position,
role and text to running sums, so a prefix hash costs one addition per turn and is a window sum. Anti-joins on the
prefix hashes keep maximal conversations (of equal ones the least id), and only these are rendered.

Running sums go in two levels, blocks of turns first, so a conversation with a third of all turns is
spread over many groups. Rendering gives a row per ``PART_TURNS`` turns for the same reason: parts are numbered from
0 and every row has the number of parts, so a conversation of up to 1,024 turns is one row. Until then hashes
stand for the texts.
Equal conversations are counted before the anti-join, so a very common one is one row there.

Defined cases: turns are ordered by turn (null last), role, hash; a turn logged twice counts once; null roles
and texts are told from empty ones and render as empty; a turn without a conversation id is a conversation
of its own; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored

PART_TURNS = 1024
_SUMS = ["s0", "s1", "s2", "s3"]


def keyed(chats: DataFrame) -> DataFrame:
    """Turns with ``conv``, a key that is never null, the block of their turn number, and two hashes of the turn."""
    text, role, turn = F.col("text").cast("string"), F.col("role").cast("string"), F.col("turn").cast("long")
    lone = F.md5(F.to_json(F.struct(turn.alias("n"), role.alias("role"), text.alias("text")), {"ignoreNullFields": "false"}).cast("binary"))
    conv = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.concat(F.lit("n"), lone))
    block = F.coalesce(F.floor(turn / F.lit(float(PART_TURNS))), F.lit(2**62)).cast("long")
    known = [turn.isNull(), turn, role.isNull(), role, text.isNull(), text]
    hashes = [F.xxhash64(F.lit(seed), *known).alias(f"h{seed}") for seed in (0, 1)]
    said = [F.xxhash64(F.lit(seed), *known[2:]).alias(f"said{seed}") for seed in (0, 1)]
    return chats.select(
        conv.alias("conv"), F.col("conv_id").cast("long").alias("conv_id"), block.alias("block"), turn.alias("turn"),
        role.alias("role"), text.alias("text"), *hashes, *said,
    )


def turns(chats: DataFrame) -> DataFrame:
    """Distinct turns without their texts: hashes stand for them until the end."""
    return keyed(chats).drop("text").distinct()


def _before(rows: DataFrame, columns: dict[str, Column], label: str) -> DataFrame:
    """What the blocks before a block of the conversation hold of each sum."""
    sums = rows.groupBy("conv", "block").agg(*[F.sum(c).alias(name) for name, c in columns.items()])
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("conv", "block", *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"{label}{name}") for name in columns])


def prefixes(turn_rows: DataFrame) -> DataFrame:
    """Every turn with its position (1 first) and the hash of the conversation up to it."""
    order = [F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), "h0", "h1"]
    in_block = Window.partitionBy("conv", "block").orderBy(*order)
    numbered = turn_rows.join(_before(turn_rows, {"n": F.lit(1)}, "b_"), ["conv", "block"])
    numbered = numbered.withColumn("position", (F.row_number().over(in_block) + F.col("b_n")).cast("long")).drop("b_n")
    halves = []
    for seed in (0, 1):
        value = F.xxhash64("position", f"said{seed}")
        halves += [F.shiftrightunsigned(value, 32), value.bitwiseAND(F.lit(0xFFFFFFFF))]
    numbered = numbered.withColumns(dict(zip(_SUMS, halves)))
    rolled = numbered.join(_before(numbered, {s: F.col(s) for s in _SUMS}, "b_"), ["conv", "block"])
    running = Window.partitionBy("conv", "block").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    parts = [(F.sum(s).over(running) + F.col(f"b_{s}")).cast("string") for s in _SUMS]
    prefix = F.md5(F.concat_ws(":", F.col("position").cast("string"), *parts).cast("binary"))
    return rolled.withColumn("prefix", prefix).select("conv", "conv_id", "block", "h0", "h1", "position", "prefix")


def maximal(prefix_rows: DataFrame) -> DataFrame:
    """conv, n_turns and n_logged (equal conversations) of those that are no prefix of a longer one."""
    length = prefix_rows.groupBy("conv", "conv_id").agg(F.max(F.struct("position", "prefix")).alias("last"))
    whole = length.groupBy(F.col("last.prefix").alias("prefix"), F.col("last.position").alias("n_turns")).agg(
        F.min(F.struct(F.coalesce("conv_id", F.lit(2**63 - 1)).alias("id"), "conv")).alias("first"), F.count("*").alias("n_logged")
    )
    inner = prefix_rows.join(length.select("conv", F.col("last.position").alias("n_turns")), "conv")
    inner = inner.filter("position < n_turns").select("prefix").distinct()
    kept = whole.join(inner, "prefix", "left_anti")
    return kept.select(F.col("first.conv").alias("conv"), "n_turns", "n_logged")


def render(chats: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per kept conversation and part: its turns, in order, between role marks.

    ``kept`` has conv, block, h0, h1 and position of every turn to render. Part n holds the turns at positions
    ``PART_TURNS`` n + 1 and on, however they are numbered.
    """
    key = ["conv", "block", "h0", "h1"]
    marked = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("\n<|end|>\n"))
    texts = keyed(chats).select(*key, marked.alias("turn_text"))
    placed = texts.join(kept.select(*key, "conv_id", "n_turns", "n_logged", "position"), key)
    part = F.floor((F.col("position") - 1) / F.lit(float(PART_TURNS))).cast("int")
    turn = F.struct("position", "turn_text")
    rows = placed.groupBy("conv", "conv_id", "n_turns", "n_logged", part.alias("part")).agg(F.sort_array(F.collect_set(turn)).alias("ts"))
    n_parts = F.ceil(F.col("n_turns") / F.lit(float(PART_TURNS))).cast("int")
    return rows.select(
        "conv_id", "part", n_parts.alias("n_parts"), "n_turns", "n_logged", F.array_join(F.transform("ts", lambda t: t["turn_text"]), "").alias("rendered")
    )


def formatted(chats: DataFrame) -> DataFrame:
    """conv_id, part, n_parts, n_turns, n_logged, rendered of every maximal conversation."""
    rows = stored(prefixes(turns(chats)), "chat-prefixes")
    return render(chats, rows.join(maximal(rows), "conv"))
