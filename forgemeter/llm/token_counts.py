"""Edit-aware token counts.

A document keeps a segment tree over runs of pre-tokens: leaves hold the tokens of about ``LEAF_CHARS`` code
points, inner nodes the sums. Leaves end only where a blank follows a character that is none: no
pre-token crosses such a place, and what stands before it is cut the same whatever follows. An edit re-encodes
the leaves that it touches, with the neighbour where it touches a leaf's border (whose safety rests on the characters
beside it) and updates the sums above; a region that has grown is cut into leaves again, so a leaf stays near its
size whatever is inserted, and then the sums are made anew from the leaves' counts. Leaves and trees are columns of the document, so they can be stored and
edited again; every document is counted in its own task, without a shuffle.

Edits are (start, removed, added) in code points of the text before any of them. Defined cases: they are
taken by start; what lies beyond the text or inside an earlier edit's removal is clipped; a null text has no
tokens and no leaves and edits leave it null; null edits are none; repeated rows are counted each.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F, types as T

TOKENIZERS = "/opt/tokenizers"
RANKS = "byte_bpe_50k.tiktoken"
LEAF_CHARS = 256
#: Fixed value: the pattern that parts text before the merges of the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SAFE = re.compile(r"(?<=\S)(?=[ \n])")


def rank_file(folder: str) -> bytes:
    """The vocabulary; read on the driver only, tasks get it as a broadcast (a file of under a megabyte)."""
    with open(f"{folder}/{RANKS}", "rb") as file:
        return file.read()


@cache
def coder_of(ranks: bytes) -> tiktoken.Encoding:
    known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=known, special_tokens={})


def encoding(folder: str) -> tiktoken.Encoding:
    return coder_of(rank_file(folder))


def leaf_texts(text: str) -> list[str]:
    out, start = [], 0
    while start < len(text):
        found = _SAFE.search(text, start + LEAF_CHARS)
        end = found.start() if found else len(text)
        out.append(text[start:end])
        start = end
    return out


def count(text: str, coder: tiktoken.Encoding) -> int:
    return sum(len(coder.encode_ordinary(leaf)) for leaf in leaf_texts(text))


def build(text: str | None, coder: tiktoken.Encoding) -> tuple[list[int], list[int]]:
    """(code points of each leaf, tree); the tree's node 1 is the root and node n has 2 n and 2 n + 1 below it."""
    leaves = leaf_texts(text or "")
    return [len(leaf) for leaf in leaves], _tree_over([len(coder.encode_ordinary(leaf)) for leaf in leaves])


def _tree_over(tokens: list[int]) -> list[int]:
    width = 1
    while width < len(tokens):
        width *= 2
    tree = [0] * width + tokens + [0] * (width - len(tokens))
    for n in range(width - 1, 0, -1):
        tree[n] = tree[2 * n] + tree[2 * n + 1]
    return tree


def _set(tree: list[int], leaf: int, value: int) -> None:
    n = len(tree) // 2 + leaf
    change = value - tree[n]
    while n:
        tree[n] += change
        n //= 2


def clipped(edits: list[tuple[int, int, str]], length: int) -> list[tuple[int, int, str]]:
    out, free = [], 0
    for start, removed, added in sorted(edits, key=lambda e: e[:2]):
        end = min(max(start, 0) + max(removed, 0), length)
        start = min(max(start, free), length)
        out.append((start, max(end, start), added))
        free = max(end, start)
    return out


def edit(text: str, chars: list[int], tree: list[int], edits: list[tuple[int, int, str]], coder: tiktoken.Encoding) -> tuple[str, list[int], list[int], int]:
    """The edited text, its leaves and tree, and the code points that were encoded again."""
    chars, tree = list(chars) or [0], list(tree)
    begins = [0]
    for n in chars:
        begins.append(begins[-1] + n)
    groups: list[list] = []  # [first leaf, last leaf, edits]
    leaf = 0
    for start, end, added in clipped(edits, len(text)):
        while leaf + 1 < len(chars) and begins[leaf + 1] <= start:
            leaf += 1
        first = leaf - 1 if leaf and start == begins[leaf] else leaf
        last = leaf
        while last + 1 < len(chars) and begins[last + 1] <= end:
            last += 1
        if groups and first <= groups[-1][1]:
            groups[-1][1] = max(last, groups[-1][1])
            groups[-1][2].append((start, end, added))
        else:
            groups.append([first, last, [(start, end, added)]])
    parts, done, encoded = [], 0, 0
    new_leaves: list[tuple[int, int, list[str], list[int]]] = []
    for first, last, own in groups:
        low, high = begins[first], begins[last + 1]
        pieces, at = [], low
        for start, end, added in own:
            pieces += [text[at:start], added]
            at = end
        region = "".join([*pieces, text[at:high]])
        parts += [text[done:low], region]
        done = high
        encoded += len(region)
        leaves = leaf_texts(region)
        new_leaves.append((first, last, leaves, [len(coder.encode_ordinary(leaf)) for leaf in leaves]))
    parts.append(text[done:])
    if all(len(leaves) == last - first + 1 for first, last, leaves, _ in new_leaves):
        for first, _, leaves, tokens in new_leaves:
            for n, (leaf, held) in enumerate(zip(leaves, tokens)):
                chars[first + n] = len(leaf)
                _set(tree, first + n, held)
        return "".join(parts), chars, tree, encoded
    # Leaves were split or went: the other leaves keep their counts, only the sums are made again.
    held = tree[len(tree) // 2 :][: len(chars)]
    for first, last, leaves, tokens in reversed(new_leaves):
        chars[first : last + 1] = [len(leaf) for leaf in leaves]
        held[first : last + 1] = tokens
    return "".join(parts), chars, _tree_over(held), encoded


def _with_columns(rows: DataFrame, added: list[T.StructField], change) -> DataFrame:
    names = [field.name for field in added]
    kept = [field for field in rows.schema.fields if field.name not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                columns = {name: c for name, c in zip(part.schema.names, part.columns)}
                new = change(columns)
                columns = {field.name: columns[field.name] for field in kept} | new
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return rows.mapInArrow(run, T.StructType([*kept, *added]))


def with_trees(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """The rows with leaf_chars, tree and n_tokens; columns of these names are replaced."""
    ints = T.ArrayType(T.IntegerType())
    ranks = docs.sparkSession.sparkContext.broadcast(rank_file(folder))
    added = [T.StructField("leaf_chars", ints), T.StructField("tree", ints), T.StructField("n_tokens", T.LongType())]

    def change(columns: dict) -> dict:
        coder = coder_of(ranks.value)
        built = [build(text.as_py(), coder) for text in columns["text"]]
        kind = pa.list_(pa.int32())
        return {"leaf_chars": pa.array([c for c, _ in built], kind), "tree": pa.array([t for _, t in built], kind), "n_tokens": pa.array([t[1] for _, t in built], pa.int64())}

    return _with_columns(docs, added, change)


def with_edits(rows: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """Rows of :func:`with_trees` that also have ``edits`` (array of start, removed, added), edited.

    text, leaf_chars, tree and n_tokens are those after the edits; n_encoded is the code points that were
    encoded for them. Columns of these names are replaced.
    """
    fields = {field.name: field for field in rows.schema.fields}
    ranks = rows.sparkSession.sparkContext.broadcast(rank_file(folder))
    added = [fields["text"], fields["leaf_chars"], fields["tree"], T.StructField("n_tokens", T.LongType()), T.StructField("n_encoded", T.LongType())]

    def change(columns: dict) -> dict:
        out = []
        for text, chars, tree, edits in zip(*[columns[name] for name in ("text", "leaf_chars", "tree", "edits")]):
            own = [(e["start"], e["removed"], e["added"] or "") for e in edits.as_py() or ()]
            if text.is_valid and own:
                out.append(edit(text.as_py(), chars.as_py(), tree.as_py(), own, coder_of(ranks.value)))
            else:
                out.append((text.as_py(), chars.as_py(), tree.as_py(), 0))
        kind = pa.list_(pa.int32())
        texts, chars, trees, encoded = zip(*out)
        return {
            "text": pa.array(texts, columns["text"].type), "leaf_chars": pa.array(chars, kind), "tree": pa.array(trees, kind),
            "n_tokens": pa.array([tree[1] for tree in trees], pa.int64()), "n_encoded": pa.array(encoded, pa.int64()),
        }

    return _with_columns(rows, added, change)


def sample_edits(doc_id, text):
    """Edits that follow from a document: a replacement at a third; at two thirds an insertion or a removal."""
    n = F.length(text)
    none = F.lit(0)
    one = lambda start, removed, added: F.struct(start.cast("int").alias("start"), removed.cast("int").alias("removed"), F.lit(added).alias("added"))
    second = F.when(F.coalesce(doc_id, F.lit(0)) % 2 == 0, one(F.floor(n * 2 / 3), none, "\n\nA new paragraph, no. 12.\n")).otherwise(one(F.floor(n * 2 / 3), F.lit(25), ""))
    return F.when(n >= 60, F.array(one(F.floor(n / 3), F.lit(7), " revised text"), second)).otherwise(F.array(one(none, none, "New. ")))


def digest(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """doc_id, tokens before and after the sample edits, code points, leaves, and code points encoded for the edits."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = with_trees(rows, folder).withColumn("n_tokens_before", F.col("n_tokens"))
    rows = with_edits(rows.withColumn("edits", sample_edits(F.col("doc_id"), F.col("text"))), folder)
    return rows.select(
        "doc_id", "n_tokens_before", F.col("n_tokens").alias("n_tokens_after"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars_after"),
        F.size("leaf_chars").cast("long").alias("n_leaves"), "n_encoded",
    )
