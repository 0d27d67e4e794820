"""Every stage of the pipeline with extra columns whose names the operators use inside, and what the operators promise at odd inputs."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from forgemeter.llm import decontamination, line_dedup, mixing, quality_rules, simhash, token_counts

INNER = (
    "_id _hash _key gone n_lines n_deleted row h copy id hash no src said order bucket taken pieces mix fp root component_id held_out lang_pred score rejected "
    "size place part block key keys words line first later earlier place2 _ host rules"
).split()


@pytest.fixture(scope="module")
def crowded(spark, sf_dir):
    """Documents with a column for every name that the operators use, each with a value of its own."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("*", *[F.concat(F.lit(f"{name}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias(name) for name in INNER])


@pytest.mark.parametrize("stage", range(5))
def test_no_stage_loses_or_alters_a_callers_column(spark, sf_dir, crowded, stage):
    name, apply = corpus_pipeline.STAGES[stage]
    got = apply(spark, crowded, sf_dir)
    own = crowded.columns
    assert got.columns[: len(own)] == own, name
    wrong = [F.col(f"`{c}`") != F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")) for c in INNER]
    bad = wrong[0]
    for other in wrong[1:]:
        bad = bad | other
    assert got.count() > 0 and got.filter(bad).count() == 0
    if name == "mixing":
        assert got.columns[len(own) :] == ["mix_taken", "mix_pieces"]
    else:
        assert got.columns == own


def test_operators_carry_columns_whole(crowded):
    cut = line_dedup.dedupe_lines(crowded)
    assert set(cut.columns) == set(crowded.columns) and dict(cut.dtypes)["n_lines"] == "bigint"
    kept = simhash.keep_one(crowded)
    assert kept.columns == crowded.columns and kept.exceptAll(crowded).count() == 0


# Decontamination


def question(rng, phrase):
    words = "of the and to in that is was for on are with as his they at be this from have or by".split()
    return phrase + " " + " ".join(rng.choice(words) + rng.choice(words) for _ in range(9))


def test_items_that_share_a_phrase_do_not_multiply_the_work():
    rng = random.Random(1)
    phrase = "which of the following best describes the role of"
    block = decontamination.build_block([(n, question(rng, phrase)) for n in range(10_000)])
    text = " ".join(f"{phrase} {rng.randint(0, 9)}" for _ in range(20))
    start = time.perf_counter()
    assert decontamination.matches(text, block) == []
    assert time.perf_counter() - start < 3


def test_all_regions_of_an_item_are_found():
    rng = random.Random(2)
    phrase = "which of the following best describes the role of"
    items = [question(rng, phrase) for _ in range(30)] + ["short one", "ab", "x"]
    block = decontamination.build_block(list(enumerate(items)))
    for _ in range(30):
        wanted, text = [], ""
        for n in [rng.randrange(30) for _ in range(6)]:
            text += " zq " * rng.randint(1, 4)
            copy = list(items[n])
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(1, len(copy) - 1)] = "#"
            text += "".join(copy)
            wanted.append(n)
        found = [m[0] for m in decontamination.matches(text, block) if m[0] < 30]
        assert sorted(found) == sorted(wanted)
    doubled = decontamination.matches("short one and ab short one x x", block)
    assert [(m[0], m[2], m[3]) for m in doubled if m[0] != 32] == [(30, 0, 9), (30, 17, 26), (31, 14, 16)]
    assert sum(m[0] == 32 for m in doubled) == 2


def test_long_texts_in_windows_agree_with_one_window(monkeypatch):
    rng = random.Random(3)
    items = [question(rng, "what is") for _ in range(40)]
    block = decontamination.build_block(list(enumerate(items)))
    text = " ".join(items[rng.randrange(40)] if rng.random() < 0.3 else question(rng, "so") for _ in range(200))
    monkeypatch.setattr(decontamination, "WINDOW", 1 << 30)
    whole = decontamination.matches(text, block)
    monkeypatch.setattr(decontamination, "WINDOW", 1)
    assert decontamination.matches(text, block) == whole and len(whole) > 40


def test_many_blocks_clean_as_one_does(spark, sf_dir, crowded):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    one = decontamination.clean_documents(crowded, bench)
    many = decontamination.clean_documents(crowded, bench, 4000)
    assert many.columns == crowded.columns
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0
    leaks = [{tuple(r) for r in decontamination.leaks(crowded, bench, size).collect()} for size in (decontamination.BLOCK_CHARS, 4000)]
    assert leaks[0] == leaks[1]


# Mixing


def test_documents_without_ids_are_spread_and_the_seed_counts(spark, make_docs):
    docs = make_docs([(None, f"text number {n} " * (n % 5 + 1), "en", "a") for n in range(600)] + [(None, "the same", "en", "a")] * 50)
    line = mixing.documents_line(docs)
    assert line.select("bucket").distinct().count() > 400
    taken = [{(r.size, r.taken) for r in mixing.digest(docs, seed=seed).collect()} for seed in (0, 0, 1)]
    draws = [
        {(r.block, r["pass"], r.shard) for r in mixing.block_draws(mixing.source_targets(line), seed=seed).collect()} for seed in (0, 0, 1)
    ]
    assert taken[0] == taken[1] and draws[0] == draws[1] and draws[0] != draws[2]


# Quality ledger and token counts


def test_the_ledger_is_stored_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = quality_rules.stored_ledger(docs)
    again = quality_rules.stored_ledger(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert first.inputFiles() == again.inputFiles()
    assert quality_rules.stored_ledger(docs.filter("doc_id > 5")).inputFiles() != first.inputFiles()
    assert first.exceptAll(quality_rules.ledger(docs)).count() == 0


def test_grown_leaves_are_split():
    coder = token_counts.encoding(token_counts.TOKENIZERS)
    text = "Start of it. " * 40
    long = "An insertion of many words, line by line.\n" * 5000
    text, chars, tree, _ = token_counts.edit(text, *token_counts.build(text, coder), [(100, 0, long)], coder)
    assert max(chars) < 2 * token_counts.LEAF_CHARS and tree[1] == len(coder.encode_ordinary(text))
    text, chars, tree, encoded = token_counts.edit(text, chars, tree, [(60_000, 1, "z")], coder)
    assert encoded < 4 * token_counts.LEAF_CHARS and tree[1] == len(coder.encode_ordinary(text))
    text, chars, tree, _ = token_counts.edit(text, chars, tree, [(0, len(text), "")], coder)
    assert (text, sum(chars), tree[1]) == ("", 0, 0)
    text, chars, tree, _ = token_counts.edit(text, chars, tree, [(0, 0, "Anew.")], coder)
    assert tree[1] == len(coder.encode_ordinary("Anew.")) and chars == [5]
