"""The conversation trie against a brute-force trie of the rebuilt conversations, and its defined cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from forgemeter.llm import conversation_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string, seq string, stretch string, depth string, weight string"


def turn_hash(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    """rows (conv_id, turn, role, text) -> set of node rows."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, turn_hash(role or "", text or ""), (role or "", text or "")))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    made = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        donor = c - int(c / 20) * 20 if c < 0 else c % 20
        made[c] = own.get(c - donor, [])[:h] + ts[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in made.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    found = set()

    def walk(node):
        leaves, saved = (0 if children[node] else 1), 0
        if node:
            saved = (len(members[node]) - 1) * len(WORD.findall(node[-1][1]))
        for child in children[node]:
            more = walk(child)
            leaves, saved = leaves + more[0], saved + more[1]
        listed = ",".join(str(c) for c in sorted(ends[node]))
        up = min(members[node[:-1]]) if node else None
        found.add((min(members[node]), len(node), up, len(members[node]), len(children[node]), leaves, saved, hashlib.sha256(listed.encode()).hexdigest()))
        return leaves, saved

    if members:
        walk(())
    return found


def got(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    rows = [tuple(r) for r in conversation_trie.nodes(df).select(*columns).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA)


def test_trie_agrees_with_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for c in range(-45, 160):
        if c % 20 == 0 and c % 3 == 0:
            continue  # families without a donor
        for turn in range(rng.choice([1, 1, 2, 3, 4, 6])):
            rows.append((c, turn, rng.choice(["user", "assistant"]), " ".join(rng.choice("ab") for _ in range(rng.randint(1, 2)))))
    assert got(frame(spark, rows)) == brute(rows)


def test_trie_defined_cases(spark):
    rows = [
        (None, 1, "user", "nobody's"), (3, None, "user", "first"), (3, 0, None, None), (3, 0, "", ""), (3, 2, "user", "same"), (3, 2, "user", "same"),
        (3, 2, "user", "another at that place"), (0, 5, "system", " \t"), (0, 6, "user", "x " * 40_000), (20, 0, "user", None), (21, 0, None, "one"), (22, 0, "a", "b"),
        (2**62, 1, "user", "far"), (-7, 1, "user", "negative"), (400, 1, "user", "a"), (401, 9, "user", "a"),
    ]
    found = got(frame(spark, rows))
    assert found == brute(rows)
    assert got(frame(spark, rows).filter("false")) == set()


def test_trie_with_one_hot_conversation_and_many_equal_ones(spark):
    rows = [(7, n, "user", f"turn {n % 50}") for n in range(3000)]
    rows += [(c, n, "user", "the same words") for c in range(1000, 2600) for n in range(5)]
    found = got(frame(spark, rows).repartition(9, F.col("turn")))
    assert found == brute_iterative(rows)


def brute_iterative(rows):
    import sys

    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(20_000)
    try:
        return brute(rows)
    finally:
        sys.setrecursionlimit(limit)
