"""Collocations against plain counting, the quality model against exhaustive search and held-out rows, and defined cases."""

from __future__ import annotations

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from forgemeter.llm import collocations, quality_gam, queries

CASES = "doc_id long, text string, lang string, phrase string, key string, shard string, place string"


# Collocations


def brute(rows, support=10):
    """rows (lang, text) -> set of (lang, rank, phrase, a, l, r, n, score)."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = tuple(re.findall("[^\x20\x09]+", piece))
            totals[lang] += len(words)
            for k in (1, 2, 3):
                counts.update((lang, words[i : i + k]) for i in range(len(words) - k + 1))
    some = {p: n for p, n in counts.items() if len(p[1]) > 1 and n >= support}
    absorbed = set()
    for (lang, words), n in some.items():
        if len(words) == 3:
            absorbed |= {(lang, w) for w in (words[:2], words[1:]) if (lang, w) in some and 100 * n >= 50 * some[lang, w]}
    by_lang = {}
    for (lang, words), a in some.items():
        if (lang, words) not in absorbed:
            cuts = []
            for k in range(1, len(words)):
                left, right = counts[lang, words[:k]], counts[lang, words[k:]]
                cuts.append((10**6 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            by_lang.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return {
        (lang, n + 1, p.decode(), -a, left, right, totals[lang], -score)
        for lang, found in by_lang.items()
        for n, (score, a, p, left, right) in enumerate(sorted(found)[:2000])
    }


def got(df):
    rows = [tuple(r) for r in collocations.collocations(df).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def frame(spark, rows):
    return spark.createDataFrame([(n, t, lang, "a", "b", "c", "d") for n, (lang, t) in enumerate(rows)], CASES)


def noise(rng, n, words="alpha Beta gamma delta été x y zeta".split()):
    return " ".join(rng.choice(words) + rng.choice(["", "", "", ".", ",", "\n", "\t", ";"]) for _ in range(n))


def test_collocations_agree_with_plain_counts(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["en", "de", None]), noise(rng, rng.randint(0, 120))) for _ in range(150)]
    rows += [("en", None), ("en", ""), ("und", "alpha beta " * 30), ("fr", "un deux trois"), ("en", " \t.;")]
    expected = brute(rows)
    assert len(expected) > 100
    assert got(frame(spark, rows)) == expected
    assert got(frame(spark, rows).filter("false")) == set()


def test_collocations_across_stretches_and_with_a_crowded_filter(spark, monkeypatch):
    """Small stretches, one long piece, and so few filter bits that nearly all phrases pass by chance."""
    rng = random.Random(3)
    rows = [("en", noise(rng, 4000, [f"w{n}" for n in range(25)]).replace(".", "")), ("en", "same same " * 3000)]
    words, found = [], []
    monkeypatch.setattr(collocations, "CHUNK", 200)
    for stretch, own in collocations.stretches([t for _, t in rows]):
        words += stretch[:own]
        found += [tuple(stretch[i : i + 3]) for i in range(min(own, len(stretch) - 2))]
    whole = "\n".join(t for _, t in rows)
    plain = re.sub("[.,;:!?\x0a-\x0d]", " \xff ", whole + "\n").encode("latin-1").split()
    assert words == plain and found == [tuple(plain[i : i + 3]) for i in range(len(plain) - 2)]
    monkeypatch.setattr(collocations, "FILTER_BITS", 16)
    assert got(frame(spark, rows)) == brute(rows)


def test_every_frequent_phrase_is_found_by_a_shard(spark):
    """Phrases with exactly the support, spread over documents so that shards hold two or three each."""
    rows = [("en", f"pair{p} tail{p} end{p}") for p in range(40) for _ in range(10)]
    assert {r[2] for r in got(frame(spark, rows))} == {f"pair{p} tail{p} end{p}" for p in range(40)}


def test_words_of_a_stretch_are_numbered_without_a_python_object_each():
    raw = "b  a \u00e9\u00e9 b".encode() + b" \xff  a \xff b " + "x" .encode() * 40 + b" "
    words = collocations.Words(raw)
    assert words[:] == raw.split() and len(words) == len(raw.split()) and words[2:4] == ["\u00e9\u00e9".encode(), b"b"]
    assert words.vocabulary.to_pylist() == [b"\xff", b"b", b"a", "\u00e9\u00e9".encode(), b"x" * 40]
    assert words.ids.tolist() == [1, 2, 3, 1, 0, 2, 0, 1, 4]
    assert words.phrases(np.array([1, 3]), np.array([2, 1])).to_pylist() == ["b a", "\u00e9\u00e9 b"]
    assert collocations.Words(b"")[:] == [] and collocations.Words(b"  ")[:] == []


def test_a_word_has_one_key_in_every_vocabulary():
    rng = random.Random(5)
    known = [bytes(rng.choice(b"ab\x00z") for _ in range(rng.randint(1, 33))) for _ in range(3000)]
    known = list(dict.fromkeys(known + [b"a", b"a\x00", b"a" * 8, b"a" * 8 + b"\x00", b"a" * 9, b"a" * 16, b"a" * 17]))
    keys = dict(zip(known, collocations.word_keys(pa.array(known, pa.binary()), "en").tolist()))
    assert len(set(keys.values())) == len(known)
    other = known[::-3]
    assert collocations.word_keys(pa.array([b"first"] + other, pa.binary()).slice(1), "en").tolist() == [keys[w] for w in other]
    assert not set(collocations.word_keys(pa.array(known, pa.binary()), "de").tolist()) & set(keys.values())


def test_distinct_phrases_of_a_chunk_agree_with_plain_counts():
    rng = random.Random(6)
    for n in (0, 1, 2, 3, 400):
        ((words, own),) = collocations.stretches([" ".join(rng.choice(["a", "b", "ccc", "d.", "e"]) for _ in range(n))])
        plain = words[:]
        chunk = collocations.Chunk("en", 1, words, own)
        for length, at in ((2, chunk.pair), (3, chunk.triple)):
            found, count = chunk.distinct(at, length)
            spans = [tuple(plain[i : i + length]) for i in range(len(plain) - length + 1)]
            assert dict(zip(words.phrases(*found).to_pylist(), count)) == Counter(b" ".join(x).decode() for x in spans if b"\xff" not in x)


def test_scores_beyond_64_bits(spark):
    big = 3 * 10**12
    row = spark.createDataFrame([(big, big, big + 7), (big, 2 * big, 5 * big)], "a long, l long, r long")
    scores = [r[0] for r in row.select(collocations._score(row["a"], row["l"], row["r"])).collect()]
    assert scores == [10**6 * big * big // (big * (big + 7)), 10**6 // 10]


# Quality


def plain_features(text):
    """The features by loops over words and characters."""
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    if not words:
        return [0.0] * len(quality_gam.FEATURES)
    raw = text.encode()
    share = [sum(b in members for b in raw) / len(raw) for members in quality_gam._SETS.values()]
    sizes = [len(w.encode()) for w in words]
    mean = sum(sizes) / len(sizes)
    lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    marks = [b in b".,;:!?" for b in raw]
    upper, lower = (sum(lo <= b <= hi for b in raw) for lo, hi in ((65, 90), (97, 122)))
    count = Counter(raw)
    return [
        *share, math.log1p(len(words)), mean, math.sqrt(sum((s - mean) ** 2 for s in sizes) / len(sizes)), math.log1p(max(sizes)),
        len(set(words)) / len(words), max(Counter(words).values()) / len(words), len(set(windows)) / len(windows) if windows else 1.0,
        1 - len(set(lines)) / len(lines), math.log1p(len(words) / len(lines)),
        sum(x.rstrip(" \t\r\x0b\x0c").endswith((".", "!", "?")) for x in lines) / len(lines), sum(w[-1] in "#*$%&|<>" for w in words) / len(words),
        sum(a and b for a, b in zip(marks, marks[1:])) / (len(raw) - 1) if len(raw) > 1 else 0.0,
        upper / (upper + lower) if upper + lower else 0.0, -sum(n / len(raw) * math.log2(n / len(raw)) for n in count.values()),
    ]


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_features_of_whole_texts(documents):
    texts = [r.text for r in documents.select("text").limit(120).collect()] + [None, "", " \n", "x", "| | |", "A.. b!\n\nA.. b!", "ß" * 9]
    for text in texts:
        assert quality_gam.features(text) == pytest.approx(plain_features(text), abs=1e-9)


def leaves_loss(parts, grad, hess):
    return sum(grad[lo:hi].sum() ** 2 / (hess[lo:hi].sum() + quality_gam.RIDGE) for lo, hi in parts)


def test_tree_takes_the_best_cut():
    rng = np.random.default_rng(1)
    for _ in range(50):
        grad, rows = rng.normal(size=9), rng.integers(0, 40, 9).astype(float)
        hess = rows * 0.2
        cuts = [c for c in range(1, 9) if min(rows[:c].sum(), rows[c:].sum()) >= quality_gam.LEAST]
        tree = quality_gam.shallow_tree(grad, hess, rows, leaves=2)
        best = max(cuts, key=lambda c: leaves_loss([(0, c), (c, 9)], grad, hess))
        expected = np.concatenate([np.full(hi - lo, -grad[lo:hi].sum() / (hess[lo:hi].sum() + quality_gam.RIDGE)) for lo, hi in ((0, best), (best, 9))])
        assert tree == pytest.approx(expected)


def test_pair_takes_the_best_cut_in_four():
    rng = np.random.default_rng(2)
    for _ in range(20):
        grad, rows = rng.normal(size=(5, 4)), rng.integers(5, 40, (5, 4)).astype(float)
        hess = rows * 0.2
        whole = grad.sum() ** 2 / (hess.sum() + quality_gam.RIDGE)
        gains = {}
        for i, j in itertools.product(range(1, 5), range(1, 4)):
            cells = [(a, b) for a in (slice(0, i), slice(i, 5)) for b in (slice(0, j), slice(j, 4))]
            if min(rows[c].sum() for c in cells) >= quality_gam.LEAST:
                gains[i, j] = sum(grad[c].sum() ** 2 / (hess[c].sum() + quality_gam.RIDGE) for c in cells) - whole
        assert quality_gam.cut_in_four(grad, hess, rows)[0] == pytest.approx(max(gains.values()))


def test_interactions_are_learned_and_scores_add_up():
    """The exclusive or of two features can't be told by single features, only by their pair."""
    rng = np.random.default_rng(4)
    rows = rng.random((3000, 4))
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 2] > 0.5)).astype(float)
    model = quality_gam.fit_tables(rows, labels)
    assert model.pairs[0] == (0, 2)
    test = rng.random((500, 4))
    right = (model.scores(test) > 0.5) == ((test[:, 0] > 0.5) ^ (test[:, 2] > 0.5))
    assert right.mean() > 0.9
    for row, odds in zip(test[:20], model.log_odds(test[:20])):
        total = model.base + sum(t[sum(row[f] >= e)] for f, (e, t) in enumerate(zip(model.edges, model.tables)))
        for (a, b), t in zip(model.pairs, model.pair_tables):
            total += t[sum(row[a] >= model.coarse[a]), sum(row[b] >= model.coarse[b])]
        assert odds == pytest.approx(total)


def test_held_out_rows_are_told(spark):
    folder = "/root/testdata/sf0.1"
    found = {r.doc_id: r for r in queries.QUERIES["op13_quality_gam"](spark, folder).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(found) == 10_000
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for d, r in found.items())
    told = [(found[d].predicted, q) for d, q in labels.items() if found[d].held_out]
    assert sum(p == q for p, q in told) / len(told) > 0.98
    assert sum(p == 0 for p, q in told if q == 0) / sum(q == 0 for _, q in told) > 0.95


def test_quality_defined_cases(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality_gam.digest(odd_docs, none).collect()} == {0.5}
    few = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (5, None, 0), (None, 1, 0), (3, 1, 1), (3, 1, 1)], "doc_id long, quality int, toxic int")
    rows = quality_gam.digest(odd_docs, few).collect()
    assert len(rows) == odd_docs.count() and all(0 < r.score < 1 for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False] * 3
    assert quality_gam.digest(odd_docs.filter("false"), few).collect() == []
