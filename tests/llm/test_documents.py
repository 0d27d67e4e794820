"""The document operators against brute-force versions, and their defined cases."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from compare import connect, difference, spark_rows, sql_rows
from forgemeter.llm import decontamination, language_id, line_dedup, mixing, quality_rules, queries, simhash, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_agrees_with_sql(spark, sf_dir, name):
    assert difference(spark_rows(queries.QUERIES[name](spark, sf_dir)), sql_rows(connect(sf_dir), queries.SQL[name])) is None


# SimHash


def brute_print(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """prints: doc -> fingerprint; doc -> smallest doc reachable."""
    docs = sorted(prints)
    root = {d: d for d in docs}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for n, a in enumerate(docs):
        for b in docs[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in docs}


def test_simhash_agrees_with_brute_force(documents):
    prints = {r.doc_id: brute_print(r.text) for r in documents.collect()}
    root = brute_components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.digest(documents).collect()}
    assert got == {d: (f"{prints[d]:016x}", root[d]) for d in prints}


def test_simhash_tiles_and_batches(spark):
    import random

    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(40)]
    prints = set(base)
    for _ in range(400):
        p = rng.choice(base)
        for b in rng.sample(range(64), rng.randint(1, 5)):
            p ^= 1 << b
        prints.add(p)
        base.append(p)
    signed = {p - (1 << 64) if p >> 63 else p: p for p in prints}
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), group_tile=3)
    from forgemeter.llm.common import components

    root = {r.node: r.root for r in components(found).collect()}
    got, want = defaultdict(set), defaultdict(set)
    for p in signed:
        got[root.get(p, p)].add(p)
    for p, r in brute_components(signed).items():
        want[r].add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_simhash_odd_cases(odd_docs):
    rows = simhash.digest(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    blank = {r.component_id for r in rows if r.fingerprint == "0" * 16}
    assert blank == {1}
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    texts = [r.text for r in kept.collect()]
    assert texts.count("one two three") == 1 and sum(not (t or "").strip() for t in texts) == 1
    assert simhash.digest(odd_docs.limit(0)).count() == 0 and simhash.keep_one(odd_docs.limit(0)).count() == 0


# Line dedup


def brute_line_dedup(rows, min_words, rare):
    """rows: (id, text) with distinct ids; id -> text. Candidates by definition, alignment by the operator's diff."""
    lines = {d: [x.strip(" \t\n\v\f\r") for x in (t or "").split("\n") if WORD.search(x)] for d, t in rows}
    holders = defaultdict(set)
    for d, own in lines.items():
        for x in own:
            holders[x].add(d)
    sizes = {d: [len(WORD.findall(x)) for x in own] for d, own in lines.items()}

    def shortest(d, n):
        """The run from line n on that reaches min_words, if it does."""
        for end in range(n + 1, len(lines[d]) + 1):
            if sum(sizes[d][n:end]) >= min_words:
                return tuple(lines[d][n:end])

    firsts = {}
    for d in sorted(lines):
        for n in range(len(lines[d])):
            firsts.setdefault(shortest(d, n), d)
    out = {}
    for d, t in rows:
        own = lines[d]
        shared = [len(holders[x]) > 1 for x in own]

        def runs(flags):
            start = None
            for n, flag in enumerate([*flags, False]):
                if flag and start is None:
                    start = n
                if not flag and start is not None:
                    yield range(start, n)
                    start = None

        size = sizes[d]
        good = {n for r in runs(shared) if sum(size[k] for k in r) >= min_words for n in r}
        often = {n for r in runs([n in good and len(holders[x]) > rare for n, x in enumerate(own)]) if sum(size[k] for k in r) >= min_words for n in r}
        partners = {min(holders[own[n]]) for n in good if len(holders[own[n]]) <= rare or n in often}
        partners = (partners | {firsts[run] for n in good if (run := shortest(d, n))}) - {d}
        gone = set()
        for p in partners:
            gone |= set(line_dedup.common_blocks(own, size, lines[p], min_words))
        out[d] = line_dedup.cut(t, sorted(gone))[0]
    return out


def test_line_dedup_agrees_with_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = {r.doc_id: r.text for r in line_dedup.dedupe_lines(documents, 20, 2).collect()}
    want = brute_line_dedup(rows, 20, 2)
    assert got == want and any(want[d] != t for d, t in rows)


def test_patience_aligns():
    assert line_dedup.patience([1, 2, 3, 4], [9, 1, 2, 8, 4]) == [(0, 1), (1, 2), (3, 4)]
    assert line_dedup.patience([5, 5, 1], [5, 5, 5]) == [(0, 0), (1, 1)]
    assert line_dedup.patience([], [1]) == []


def test_line_dedup_cuts_copies_and_keeps_the_first(make_docs):
    passage = "\n".join(" ".join(f"w{k}x{n}" for n in range(30)) for k in range(3))
    rows = [(1, f"own start\n{passage}\nend"), (2, passage), (3, f"short other\n{passage}\nlast line"), (4, "All rights reserved."), (5, "All rights reserved.")]
    many = [(n, passage + f"\ntail {n}") for n in range(100, 180)]  # more holders than a rare line has
    got = {r.doc_id: r.text for r in line_dedup.dedupe_lines(make_docs([(i, t, "en", "a") for i, t in rows + many])).collect()}
    assert got[1] == rows[0][1] and got[2] == "" and got[3] == "short other\nlast line"
    assert got[4] == got[5] == "All rights reserved." and got[150] == "tail 150"


def test_line_dedup_finds_a_block_whose_lines_have_other_first_holders(make_docs):
    """Documents 1 and 2 hold one line each, 3 both but apart, 4 is the first with the block."""
    a, b = ("\n".join(f"{x}{k} {x}{k} {x}{k} {x}{k} {x}{k} {x}{k}" for k in range(2)) for x in "ab")
    texts = [f"{a}\nfirst alone", f"{b}\nsecond alone", f"{a}\nbetween\n{b}", f"head\n{a}\n{b}\ntail", f"{a}\n{b}\nlast"]
    got = {r.doc_id: r.text for r in line_dedup.dedupe_lines(make_docs([(n, t, "en", "a") for n, t in enumerate(texts, 1)])).collect()}
    assert [got[n] for n in range(1, 6)] == [*texts[:4], "last"]


def test_line_dedup_cuts_blocks_in_another_order_and_again(make_docs):
    a, b = ("\n".join(" ".join(f"{x}{k}w{n}" for n in range(12)) for k in range(3)) for x in "ab")
    texts = [f"{a}\nbetween\n{b}", f"head\n{b}\nmiddle\n{a}\ntail", f"{a}\nx\n{a}\ny\n{a}\nz"]
    got = {r.doc_id: r.text for r in line_dedup.dedupe_lines(make_docs([(n, t, "en", "a") for n, t in enumerate(texts, 1)])).collect()}
    assert got == {1: texts[0], 2: "head\nmiddle\ntail", 3: "x\ny\nz"}


def test_line_dedup_between_documents_of_one_id(make_docs):
    passage = "\n".join(" ".join(f"w{k}x{n}" for n in range(30)) for k in range(3))
    for doc in (None, 7):
        texts = [f"own {n} start\n{passage}\nend {n}" for n in range(4)]
        out = [r.text for r in line_dedup.dedupe_lines(make_docs([(doc, t, "en", "a") for t in texts])).collect()]
        assert sum(passage in text for text in out) == 1
        assert sorted(t.replace(f"\n{passage}", "") for t in out) == [f"own {n} start\nend {n}" for n in range(4)]


def test_line_dedup_odd_cases(odd_docs):
    out = line_dedup.dedupe_lines(odd_docs)
    assert out.count() == odd_docs.count() and set(odd_docs.columns) <= set(out.columns)
    assert out.filter("text IS NULL").count() == 1
    assert line_dedup.dedupe_lines(odd_docs.limit(0)).count() == 0


# Quality rules


def test_quality_odd_cases(odd_docs):
    rows = quality_rules.judged(quality_rules.ledger(odd_docs)).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 50)
    assert quality_rules.ledger(odd_docs.limit(0)).count() == 0
    empty = quality_rules.ablations(quality_rules.ledger(odd_docs.limit(0))).collect()
    assert len(empty) == sum(map(len, quality_rules.POLICIES.values())) and all(r.failing == 0 for r in empty)


def test_quality_keeps_documents_labelled_good(spark, sf_dir):
    rows = queries.QUERIES["op2_quality_rules"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    rows = rows.filter("NOT base_failed")
    assert rows.filter("quality = 1 AND NOT kept").count() <= 0.02 * rows.filter("quality = 1").count()
    assert rows.filter("quality = 0 AND kept").count() <= 0.05 * rows.filter("quality = 0").count() + 1


# Language


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.digest(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert sum(r.rejected for r in rows) <= 0.005 * len(rows)


def test_language_odd_cases(odd_docs, documents):
    rows = language_id.digest(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_text = [(r.lang_pred, r.score) for r in rows if r.doc_id in (1, 2, 5)]
    assert by_text == [("und", 0.0)] * 3
    assert language_id.digest(odd_docs.limit(0)).count() == 0
    model = language_id.fit(documents.sparkSession.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    out = language_id.identify(odd_docs, model)
    assert out.columns[-3:] == ["lang_pred", "score", "rejected"] and out.count() == odd_docs.count()
    assert model.predict(["これは日本語の文章です。" * 20])[0][2]
    assert language_id.known_language(odd_docs).columns == odd_docs.columns


# Decontamination


def brute_distance(item, text):
    row = [0] * (len(text) + 1)
    for a in item:
        new = [row[0] + 1]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_leaks_agree_with_brute_force(spark, make_docs):
    import random

    rng = random.Random(5)
    letters = "abcdefgh ijklm"
    items = ["".join(rng.choice(letters) for _ in range(n)) for n in (5, 12, 40, 90, 90, 150)]
    docs = []
    for n in range(60):
        body = "".join(rng.choice(letters) for _ in range(rng.randint(0, 300)))
        item = list(rng.choice(items))
        for _ in range(rng.randint(0, max(1, int(len(item) * 0.12)))):
            p = rng.randrange(len(item))
            item[p : p + 1] = rng.choice([[], ["z"], [item[p], "q"]])
        at = rng.randint(0, len(body))
        docs.append((n, body[:at] + "".join(item) + body[at:], "en", "a"))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = {}
    for n, text, *_ in docs:
        for k, item in enumerate(items):
            a, b = decontamination.normalise(item), decontamination.normalise(text)
            if (d := brute_distance(a, b)) <= decontamination.budget(len(a)):
                want[n, k] = d
    for block_chars in (4_000_000, 100):
        got = {(r.doc_id, r.item_id): r.edits for r in decontamination.leaks(make_docs(docs), bench, block_chars).collect()}
        assert got == want
    clean = {r.doc_id for r in decontamination.clean_documents(make_docs(docs), bench).collect()}
    assert clean == {n for n, *_ in docs} - {n for n, _ in want}


def test_leaks_with_an_insertion_near_the_start_at_every_offset():
    import random

    rng = random.Random(11)
    item = "".join(rng.choice("abcdefghijklmno") for _ in range(100))
    block = decontamination.build_block([(1, item)])
    k = decontamination.budget(len(item))
    for place in range(1, 10):
        copy = list(item)
        for at in range(21, 21 + 11 * (k - 1), 11):
            copy[at] = "z"  # all grams but those between the edits are gone
        copy.insert(place, "q")
        for offset in range(2 * max(k, 8)):
            text = "w" * offset + "".join(copy) + "w" * 30
            want = brute_distance(item, text)
            assert want <= k and [(i, e) for i, e, *_ in decontamination.matches(text, block)] == [(0, want)], (place, offset)


def test_leaks_odd_cases(spark, odd_docs):
    odd = spark.createDataFrame([(None, None), (1, ""), (2, "One  TWO\nthree"), (2, "One  TWO\nthree")], "item_id long, text string")
    found = decontamination.leaks(odd_docs, odd).collect()
    assert Counter((r.doc_id, r.item_id) for r in found) == {(4, 2): 4, (None, 2): 2}
    assert decontamination.leaks(odd_docs, odd.limit(0)).count() == 0 and decontamination.leaks(odd_docs.limit(0), odd).count() == 0
    assert decontamination.clean_documents(odd_docs, odd).count() == odd_docs.count() - 3


# Mixing


def test_mix_meets_its_targets(spark, documents):
    rows = mixing.digest(documents).collect()
    assert len(rows) == documents.count() and all(0 <= r.taken <= 2 * r.size for r in rows)
    by_source = defaultdict(list)
    for r in rows:
        by_source[r.source].append(r)
    total = sum(r.size for r in rows)
    assert abs(sum(own[0].target for own in by_source.values()) - 1.5 * total) < 1e-6 * total
    for own in by_source.values():
        assert own[0].target <= 2 * own[0].source_size + 1e-6
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.01 * own[0].source_size + 1
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.digest(documents).collect()))


def test_tree_splits_exactly_and_pieces_are_disjoint(spark, documents):
    line, pieces = mixing.mix(documents, shards=8)
    per_shard = Counter()
    seen = Counter()
    for r in pieces.select("shard", "doc_id", "hash", "copy", "pass", "from_word", "words").collect():
        per_shard[r.shard] += r.words
        seen[tuple(r)[1:6]] += 1
    assert len(per_shard) == 8 and max(seen.values()) == 1
    targets = mixing.source_targets(mixing.documents_line(documents))
    quotas = mixing.shard_quotas(targets, 8).groupBy("shard").agg(F.sum("quota").alias("q")).collect()
    sums = [r.q for r in quotas]
    assert max(sums) - min(sums) <= 3
    split = mixing.shard_quotas(targets, 8).groupBy("source_no").agg(F.sum("quota").alias("q"))
    assert split.join(targets, "source_no").filter("q <> quota").count() == 0


def test_mix_odd_cases(odd_docs):
    rows = mixing.digest(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r.taken == 0 for r in rows if not r.size)
    mixed = mixing.mixed_documents(odd_docs)
    assert mixed.columns == [*odd_docs.columns, "mix_taken", "pieces"]
    assert mixed.filter("text = 'one two three' AND doc_id = 4").count() <= 2
    assert mixing.digest(odd_docs.limit(0)).count() == 0


# Token counts


def test_token_counts_agree_with_a_full_count(documents):
    coder = token_counts.encoding(token_counts.TOKENIZERS)
    rows = token_counts.with_edits(token_counts.with_trees(documents).withColumn("edits", token_counts.sample_edits(F.col("doc_id"), F.col("text"))))
    for r in rows.collect():
        assert r.n_tokens == len(coder.encode_ordinary(r.text)) == r.tree[1] and sum(r.leaf_chars) == len(r.text)


def test_edits_anywhere_agree_with_a_full_count():
    import random

    coder, rng = token_counts.encoding(token_counts.TOKENIZERS), random.Random(9)
    for _ in range(150):
        text = "".join(rng.choice(["word", " ", "  ", "\n", "'s", "12", "é", " ", "!", "zz "]) for _ in range(rng.randint(0, 1500)))
        chars, tree = token_counts.build(text, coder)
        for _ in range(2):
            edits = [(rng.randint(-2, len(text) + 2), rng.choice([0, 1, 5, 400]), rng.choice(["", " ", "new", "\n\n", "a b"])) for _ in range(rng.randint(1, 4))]
            want, free = [], 0
            for start, end, added in token_counts.clipped(edits, len(text)):
                want += [text[free:start], added]
                free = end
            full = "".join(want) + text[free:]
            text, chars, tree, _ = token_counts.edit(text, chars, tree, edits, coder)
            assert text == full and tree[1] == len(coder.encode_ordinary(text)) and sum(chars) == len(text)


def test_token_counts_odd_cases(odd_docs):
    rows = token_counts.digest(odd_docs).collect()
    assert len(rows) == odd_docs.count() and token_counts.digest(odd_docs.limit(0)).count() == 0
    assert [r.n_tokens_after for r in rows if r.doc_id is None and r.n_chars_after == 0] == [0]


# Pipeline


def test_pipeline_stages(spark, sf_dir, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf_dir)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == documents.columns
        docs = docs.cache()
        assert 0.75 * before.count() <= docs.count() <= before.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    items = [decontamination.normalise(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert not any(item in decontamination.normalise(t) for t in texts.values() for item in items)
    assert sorted(map(str, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(str, docs.collect()))
