"""What the operators of this subpackage share: words, row keys, stored tables, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..workspace import fresh_path

#: A word is a run of code points other than space and the controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: its lineage ends here and executors may be lost."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def whole_row(df: DataFrame, *without: str) -> Column:
    """All columns of a row (but those named) as one value, so that no name of a caller's column can clash with one used here."""
    fields = [F.col(f"`{c}`").alias(f"c{n}") for n, c in enumerate(df.columns) if c not in without]
    return F.struct(F.lit(0).alias("none"), *fields)


def unpacked(df: DataFrame, row: str, own: dict[str, Column] | None = None) -> list[Column]:
    """The columns of a caller's frame ``df`` from a :func:`whole_row`, in order; those in ``own`` are taken from there."""
    own = own or {}
    return [own[c].alias(c) if c in own else F.col(row).getField(f"c{n}").alias(c) for n, c in enumerate(df.columns)]


def id_order(doc_id: Column) -> Column:
    """Ids as they are ordered everywhere here: a missing id comes last."""
    return F.coalesce(doc_id.cast("long"), F.lit(2**63 - 1))


def text_hash(text: Column) -> Column:
    """Tells apart documents that carry the same id; xxhash64 of null is the seed."""
    return F.xxhash64(text)


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of undirected links (a, b): rows (node, root), root the smallest node.

    Large-star and small-star steps alternate until the edges no longer change, each result being a
    stored table. Nodes without a link to another node don't appear. Every step aggregates by node
    before it joins, and its joins may be split by adaptive execution where a hub is hot.
    """
    edges = stored(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label
    )
    before = None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before or now[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        edges = stored(small.union(least.select("a", F.col("m").alias("b"))).distinct(), label)
