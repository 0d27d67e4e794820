from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from forgemeter.operators import events as E
from forgemeter.sources import sample_tables as S
from forgemeter.streaming import ingest as I
from forgemeter.streaming.levels import LevelledTable, live_parts
from forgemeter.workspace import fresh_path

FLAT = "id long, created_at timestamp, actor_id long, repo_id long, type string"


def flat(spark, numbers, start=datetime(2024, 1, 1)):
    rows = [(n, start + timedelta(minutes=n), n % 3, n % 5, "PushEvent" if n % 2 else "WatchEvent") for n in numbers]
    return spark.createDataFrame(rows, FLAT)


def add_file(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def run(query):
    query.awaitTermination()
    return query


def test_ingest_resumes_where_it_stopped(spark):
    source, out, state = (fresh_path(spark, name) for name in ("src", "out", "state"))
    for part in (range(0, 10), range(10, 20)):
        add_file(flat(spark, part), source)
        rows = I.file_stream(spark, source, flat(spark, [0]).schema, files_per_batch=1)
        run(I.stream_event_ingest(rows, out, state))
    run(I.stream_event_ingest(rows, out, state))
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(20))


def test_dedupe_drops_repeats_across_runs_and_counts_late_rows(spark):
    source, out, state = (fresh_path(spark, name) for name in ("src", "out", "state"))
    schema = flat(spark, [0]).schema

    def stream():
        return I.file_stream(spark, source, schema, files_per_batch=1)

    add_file(flat(spark, [*range(0, 10), *range(5, 10)]), source)
    run(I.stream_dedupe(stream(), out, state, delay="1 hour"))
    add_file(flat(spark, range(8, 15)), source)
    run(I.stream_dedupe(stream(), out, state, delay="1 hour"))
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(15))
    add_file(flat(spark, range(5000, 5003)), source)
    run(I.stream_dedupe(stream(), out, state, delay="1 hour"))
    add_file(flat(spark, range(20, 24)), source)
    late = run(I.stream_dedupe(stream(), out, state, delay="1 hour"))
    assert I.late_rows(late) == 4
    assert spark.read.parquet(out).count() == 18


def test_time_buckets_equal_batch_for_closed_windows(spark):
    source, out, state = (fresh_path(spark, name) for name in ("src", "out", "state"))
    everything = flat(spark, range(0, 600))
    for part in (range(0, 300), range(300, 600)):
        add_file(flat(spark, part), source)
        rows = I.file_stream(spark, source, everything.schema, files_per_batch=1)
        run(I.stream_time_buckets(rows, out, state, "hour", "10 minutes"))
    found = {tuple(r) for r in spark.read.parquet(out).collect()}
    whole = {tuple(r) for r in E.events_per_bucket(everything).collect()}
    closed = {row for row in whole if row[0] < datetime(2024, 1, 1, 9)}
    assert closed <= found <= whole


def test_incremental_statistics_equal_batch(spark, sf_dir):
    source, archive, stats, state = (fresh_path(spark, n) for n in ("src", "archive", "stats", "state"))
    lines = S.table(spark, sf_dir, "lineitem")
    for part in range(3):
        add_file(lines.where(F.pmod(F.hash("l_orderkey", "l_partkey"), F.lit(3)) == part), source)
        rows = I.file_stream(spark, source, lines.schema, files_per_batch=1)
        run(I.stream_org_upsert(S.archive_events(spark, sf_dir, rows), archive, stats, state, 1996, 2000))
    expected = E.org_yearly_stats(S.archive_events(spark, sf_dir), 1996, 2000)
    columns = expected.columns
    found = I.current_stats(spark, stats).select(columns)
    assert found.count() == expected.count()
    assert found.exceptAll(expected).count() == 0


def test_a_batch_of_statistics_reads_no_earlier_batch(spark, sf_dir):
    """Earlier outputs are unreadable files here; a later batch is not disturbed by them."""
    source, archive, stats, state = (fresh_path(spark, n) for n in ("src", "archive", "stats", "state"))
    lines = S.table(spark, sf_dir, "lineitem")
    for folder in (archive, stats):
        spark.createDataFrame([("no parquet",)], "value string").write.text(f"{folder}/ingest=-1")
    add_file(lines, source)
    rows = I.file_stream(spark, source, lines.schema)
    run(I.stream_org_upsert(S.archive_events(spark, sf_dir, rows), archive, stats, state, 1996, 2000))
    expected = E.org_yearly_stats(S.archive_events(spark, sf_dir), 1996, 2000)
    found = E.merged_parts(spark.read.parquet(f"{stats}/level=0/part=0")).select(expected.columns)
    assert found.exceptAll(expected).count() == 0 and found.count() == expected.count()


def test_live_parts_are_the_digits_of_the_number_of_batches():
    for fan in (2, 3, 8):
        for batch in range(300):
            covered = [n for level, part in live_parts(batch, fan) for n in range(part * fan**level, (part + 1) * fan**level)]
            assert covered == list(range(batch + 1))
            levels = 1
            while fan**levels <= batch + 1:
                levels += 1
            assert len(live_parts(batch, fan)) <= (fan - 1) * levels


def sums_of(rows):
    return rows.groupBy("k").agg(F.sum("n").alias("n"))


def levelled(spark, path, fan=3):
    return LevelledTable(spark, path, "k long, n long", sums_of, fan)


def test_levelled_table_reads_few_parts_and_loses_nothing(spark):
    table = levelled(spark, fresh_path(spark, "levels"))
    assert table.read().columns == ["k", "n"] and table.read().count() == 0
    expected = {}
    for batch in range(50):
        rows = [(batch % 7, batch), (100 + batch, 1)]
        for k, n in rows:
            expected[k] = expected.get(k, 0) + n
        table.add(batch, spark.createDataFrame(rows, "k int, n int"))
        last, parts = table.manifest()
        assert last == batch and parts == live_parts(batch, 3) and len(parts) <= 8
    assert {r["k"]: r["n"] for r in sums_of(table.read()).collect()} == expected
    stored_rows = spark.read.schema("k long, n long").parquet(f"{table.path}/level=*/part=*").count()
    assert stored_rows <= table.read().count() + 40  # parts that were merged are emptied


def test_levelled_table_takes_a_batch_again(spark):
    """A batch that failed after its parts, or after its manifest, is added anew; an unfinished slot is not read."""
    table = levelled(spark, fresh_path(spark, "levels"))
    add = lambda n: table.add(n, spark.createDataFrame([(1, n)], "k long, n long"))
    for batch in range(9):
        add(batch)
        add(batch)
        assert sums_of(table.read()).first()["n"] == sum(range(batch + 1))
    before = table.manifest()
    spark.createDataFrame([(1, 10**6)], "k long, n long").write.parquet(table._part(0, 9))  # a batch that stopped here
    assert table.manifest() == before and sums_of(table.read()).first()["n"] == 36
    spark.createDataFrame([], "batch long, level int, number long").write.mode("overwrite").parquet(table._slot(9))
    assert table.manifest() == before
    add(9)
    assert sums_of(table.read()).first()["n"] == 45


def test_statistics_before_the_first_batch(spark):
    assert I.current_stats(spark, fresh_path(spark, "nothing")).collect() == []


def test_statistics_of_many_small_batches(spark, sf_dir):
    source, archive, stats, state = (fresh_path(spark, n) for n in ("src", "archive", "stats", "state"))
    lines = S.table(spark, sf_dir, "lineitem")
    for part in range(12):
        add_file(lines.where(F.pmod(F.hash("l_orderkey", "l_linenumber"), F.lit(12)) == part), source)
    rows = I.file_stream(spark, source, lines.schema, files_per_batch=1)
    run(I.stream_org_upsert(S.archive_events(spark, sf_dir, rows), archive, stats, state, 1996, 2000))
    last, parts = I.stats_table(spark, stats).manifest()
    assert last == 11 and parts == live_parts(11)
    expected = E.org_yearly_stats(S.archive_events(spark, sf_dir), 1996, 2000)
    found = I.current_stats(spark, stats).select(expected.columns)
    assert found.count() == expected.count() and found.exceptAll(expected).count() == 0


def test_late_rows_are_counted_past_the_last_hundred_batches(spark):
    """The first batches are late and long out of the query's own reports when it ends."""
    source, out, state = (fresh_path(spark, name) for name in ("src", "out", "state"))
    schema = flat(spark, [0]).schema
    listener = I.LateRows()
    spark.streams.addListener(listener)
    try:
        add_file(flat(spark, range(90_000, 90_003)), source)
        run(I.stream_dedupe(I.file_stream(spark, source, schema, files_per_batch=1), out, state, delay="1 hour"))
        for n in range(104):
            add_file(flat(spark, [n] if n < 5 else [90_000 + n]), source)
        query = run(I.stream_dedupe(I.file_stream(spark, source, schema, files_per_batch=1), out, state, delay="1 hour"))
        assert listener.count(query) == 5
        assert listener.batches[str(query.id)] > 100 and I.late_rows(query) < 5
    finally:
        spark.streams.removeListener(listener)
    assert spark.read.parquet(out).count() == 3 + 99


def test_time_buckets_with_late_rows_repaired_equal_the_batch(spark):
    source, archive, out, late = (fresh_path(spark, name) for name in ("src", "archive", "out", "late"))
    states = [fresh_path(spark, "state") for _ in range(3)]
    schema = flat(spark, [0]).schema
    # hours 0-5, then hour 9, then rows of hours 1, 3 and 6 that come late (hour 6 had none before), then a far one
    for numbers in (range(0, 330, 7), range(540, 560), [61, 62, 200, 365, 366], range(541, 570, 2), [2000]):
        add_file(flat(spark, numbers), source)
    stream = lambda n: I.file_stream(spark, source, schema, files_per_batch=n)
    run(I.stream_event_ingest(stream(2), archive, states[0]))
    run(I.stream_time_buckets(stream(1), out, states[1], "hour", "10 minutes"))
    run(I.stream_late_rows(stream(3), late, states[2], "hour", "10 minutes"))
    events, buckets = spark.read.parquet(archive), spark.read.parquet(out)
    late_table = spark.read.schema(I.LATE).parquet(f"{late}/rows")
    whole = {tuple(r) for r in E.events_per_bucket(events).collect()}
    closed = {row for row in whole if row[0] < datetime(2024, 1, 2)}
    emitted = {tuple(r) for r in buckets.collect()}
    assert emitted != closed
    assert {tuple(r) for r in I.repaired_buckets(buckets, late_table, events).collect()} == closed
    nothing = late_table.where("false")
    assert {tuple(r) for r in I.repaired_buckets(buckets, nothing, events).collect()} == emitted
