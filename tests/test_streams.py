import os
import random
import time

import pytest
from helpers import page, page_schema, pages, seen
from pyspark.sql import functions as F

from millrace.operators import jumps, logs, visits
from millrace.operators.joins import interval_join
from millrace.sources.topics import delimited
from millrace.streaming import state
from millrace.streaming.joins import interval_join_stream
from millrace.streaming.late import start_splitting
from millrace.streaming.runner import late_rows, run_to_table, start_batches
from millrace.streaming.stats import visitor_stats_stream

DAY = 86_400
NOW = {"availableNow": True}


class Feed:
    """A folder of Parquet files, one per micro-batch, in the order added."""

    def __init__(self, spark, root, schema):
        self._spark, self._root, self._schema, self._n = spark, str(root), schema, 0

    def add(self, *rows):
        path = f"{self._root}/in/{self._n}"
        logs_ = not isinstance(self._schema, str) and "displays" in self._schema.names
        made = pages(self._spark, *rows) if logs_ else self._spark.createDataFrame(list(rows), self._schema)
        made.coalesce(1).write.parquet(path)
        for name in os.listdir(path):
            os.utime(f"{path}/{name}", (1_000_000 + self._n * 10,) * 2)
        self._n += 1
        return self

    def stream(self):
        reader = self._spark.readStream.schema(self._schema).option("maxFilesPerTrigger", 1)
        return reader.option("recursiveFileLookup", "true").parquet(f"{self._root}/in")

    def run(self, operator):
        return run_to_table(operator(self.stream()), "t", f"{self._root}/run")


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path, page_schema())


def test_bounces_wait_for_the_watermark(feed):
    feed.add(page("a", 1, "E"), page("b", 3, "E")).add(page("a", 5), page("a", 4, "E")).add(page("c", 90, "E"))
    got = feed.run(state.jumps_stream).select("common.mid", "ts", "outcome").collect()
    assert sorted(map(tuple, got)) == [("a", 1000, "match"), ("b", 3000, "timeout")]


def test_bounces_resume_from_the_checkpoint(feed):
    feed.add(page("a", 1, "E")).add(page("b", 2, "E"))
    assert seen(feed.run(state.jumps_stream)) == []
    feed.add(page("a", 3), page("z", 60))
    assert seen(feed.run(state.jumps_stream)) == [("b", 2.0)]
    assert seen(feed.run(state.jumps_stream)) == [("b", 2.0)]
    feed.add(page("z", 200))
    assert seen(feed.run(state.jumps_stream)) == [("b", 2.0)]


@pytest.mark.parametrize("slice_ms", [10_000, None])
def test_streamed_bounces_equal_the_batch(spark, feed, slice_ms):
    rng = random.Random(5)
    rows = [
        page(rng.choice(["hot", "hot", "b"]), rng.randrange(1, 300), rng.choice("EEN"), seq=i)
        for i in range(150)
    ]
    rows.sort(key=lambda r: r[4] + rng.randrange(0, 2000))  # within the lateness
    for i in range(0, len(rows), 30):
        feed.add(*rows[i:i + 30])
    feed.add(page("end", 1000))
    got = feed.run(lambda s: state.jumps_stream(s, slice_ms=slice_ms))
    pick = lambda df: sorted(tuple(r) for r in df.select("common.mid", "ts", "seq", "outcome").collect())
    assert pick(got) == pick(jumps.consecutive_match(pages(spark, *rows)))


def test_daily_visits_by_arrival(feed):
    feed.add(page("a", 1), page("a", 3, "E"), page("a", 2, "E"), page("a", DAY + 1, "E"))
    feed.add(page("a", DAY + 9, "E")).add(page("a", 5, "E"))
    assert seen(feed.run(state.unique_visits_stream)) == [("a", 2.0), ("a", 5.0), ("a", DAY + 1.0)]


def test_daily_visits_equal_the_batch_in_time_order(spark, feed):
    rng = random.Random(2)
    rows = sorted(
        (page(rng.choice("ab"), rng.randrange(0, 4 * DAY), rng.choice("EN"), seq=i) for i in range(80)),
        key=lambda r: r[4],
    )
    for i in range(0, 80, 20):
        feed.add(*rng.sample(rows[i:i + 20], 20))
    assert seen(feed.run(state.unique_visits_stream)) == seen(visits.unique_visits(pages(spark, *rows)))


def test_daily_visits_with_expiry_end_without_empty_batches(feed, tmp_path):
    feed.add(page("a", 1, "E"), page("a", 2, "E"))
    found = []
    query = start_batches(
        state.unique_visits_stream(feed.stream(), ttl_ms=state.DAY_MS),
        lambda batch, n: found.extend(seen(batch)), str(tmp_path / "ck"), NOW, close_windows=False,
    )
    assert query.awaitTermination(120)
    assert found == [("a", 1.0)]


def test_deduplicated_visits(feed):
    feed.add(page("a", 1, "E"), page("a", DAY + 1, "E")).add(page("a", 5, "E"), page("b", 1))
    assert seen(feed.run(state.unique_visits_dedup_stream)) == [("a", 1.0), ("a", DAY + 1.0)]


def test_deduplicated_visits_across_lanes(feed):
    feed.add(*[page("a", i, "E") for i in range(1, 30)]).add(*[page("a", i, "E") for i in range(30, 60)])
    found = feed.run(lambda s: state.unique_visits_dedup_stream(s.repartition(3), lanes=3))
    assert len(seen(found)) == 1


def test_delimited_streams_joined_on_seconds(spark, tmp_path):
    for side, text in (("l", "1,ann,100\n2,bob,100\n"), ("r", "1,f,105\n1,m,106\n2,m,95\n")):
        (tmp_path / side).mkdir()
        (tmp_path / side / "a.csv").write_text(text)
    read = lambda side, name: delimited(
        spark, str(tmp_path / side), f"id string, {name} string, s bigint", streaming=True
    ).withColumn("ts", F.col("s") * 1000)
    joined = interval_join_stream(
        read("l", "name"), read("r", "sex"), [("id", "id")], "ts", "ts", -5_000, 5_000
    )
    got = run_to_table(joined.select("l.name", "r.sex"), "demo", str(tmp_path / "run"))
    assert sorted(map(tuple, got.collect())) == [("ann", "f"), ("bob", "m")]


def test_first_claim_across_batches(feed):
    feed.add(page("a", 1, is_new="0"), page("a", 3, is_new="1"), page("a", 2, is_new="1"))
    feed.add(page("a", 4, is_new="1"), page("b", 5, is_new="1"), page("c", 6, is_new=None))
    got = feed.run(state.repair_is_new_stream).orderBy("ts").select("ts", "common.is_new", "common.ar")
    assert [tuple(r) for r in got.collect()] == [
        (1000, "0", "a"), (2000, "1", "a"), (3000, "0", "a"), (4000, "0", "a"), (5000, "1", "a"),
        (6000, None, "a"),
    ]


@pytest.mark.parametrize("lanes", [1, 3])
def test_streamed_repair_equals_the_batch(spark, feed, lanes):
    rows = [page(f"m{i % 4}", i, seq=i, is_new=str((i // 3) % 2)) for i in range(60)]
    for i in range(0, 60, 15):
        feed.add(*rows[i:i + 15][::-1])
    flags = lambda df: sorted(map(tuple, df.select("seq", "common.is_new").collect()))
    repair = lambda s: state.repair_is_new_stream(s.repartition(3), lanes=lanes)
    assert flags(feed.run(repair)) == flags(logs.repair_is_new(pages(spark, *rows)))


def test_records_without_a_time_come_first(spark, feed):
    timed = page("a", 1, "E", is_new="1")
    untimed = (*page("a", 0, "E", is_new="1")[:4], None, 9)
    feed.add(timed, untimed)
    flags = lambda df: sorted(map(tuple, df.select("seq", "common.is_new").collect()))
    expected = flags(logs.repair_is_new(pages(spark, timed, untimed)))
    assert flags(feed.run(state.repair_is_new_stream)) == expected == [(9, "1"), (1000, "0")]


def test_records_keep_their_fields_in_state(spark, feed):
    row = page("a", 1, "E", during=7, displays=[{"item": "i", "n": None}], start="{}")
    feed.add(row)
    texts = lambda df: df.select(F.to_json(F.struct("*"))).collect()
    assert texts(feed.run(state.unique_visits_stream)) == texts(pages(spark, row))


def test_interval_join_equals_the_batch(spark, tmp_path):
    rng = random.Random(3)
    layout = "k string, t bigint"
    make = lambda n: sorted(((rng.choice(["hot", "x"]), rng.randrange(0, 60_000)) for _ in range(n)), key=lambda r: r[1])
    left_rows, right_rows = make(40), make(60)
    left, right = (Feed(spark, tmp_path / side, layout) for side in "lr")
    for feed, rows in ((left, left_rows), (right, right_rows)):
        for i in range(0, len(rows), len(rows) // 4):
            feed.add(*rows[i:i + len(rows) // 4])
    args = [("k", "k")], "t", "t", -5_000, 2_000
    pairs = lambda df: df.select("l.k", F.col("l.t").alias("lt"), F.col("r.t").alias("rt"))
    streamed = interval_join_stream(
        left.stream(), right.stream(), *args, left_delay="1 minute", right_delay="1 minute"
    )
    got = run_to_table(pairs(streamed), "join", str(tmp_path / "run"))
    batch = interval_join(
        spark.createDataFrame(left_rows, layout), spark.createDataFrame(right_rows, layout), *args
    )
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(got) == rows(pairs(batch))


def test_windows_close_and_late_rows_are_counted(feed, tmp_path):
    # A batch drops what lies behind the watermark its predecessor ran with.
    feed.add(page("a", 1, during=5), page("a", 30)).add(page("a", 31))
    feed.add(page("a", 2, during=100)).add(page("a", 60))
    windows = []
    stream = feed.stream()
    none = stream.where("false")
    query = start_batches(
        visitor_stats_stream(none, none, stream),
        lambda batch, n: windows.extend(map(tuple, batch.select("stt", "pv_ct", "dur_sum").collect())),
        str(tmp_path / "ck"), NOW,
    )
    query.awaitTermination()
    assert sorted(windows) == [("1970-01-01 00:00:00", 1, 5), ("1970-01-01 00:00:30", 2, 0)]
    assert late_rows(query) == 1


@pytest.mark.parametrize("n", [3, 4])
def test_streamed_runs_equal_the_batch(spark, feed, n):
    rng = random.Random(n)
    rows = [page(rng.choice("ab"), rng.randrange(1, 200), rng.choice("EEEN"), seq=i) for i in range(120)]
    rows.sort(key=lambda r: r[4] + rng.randrange(0, 2000))
    for i in range(0, len(rows), 40):
        feed.add(*rows[i:i + 40])
    feed.add(page("end", 1000))
    pick = lambda df: sorted(tuple(r) for r in df.select("common.mid", "ts", "seq", "outcome").collect())
    got = pick(feed.run(lambda s: state.consecutive_match_stream(s, n, 9_000)))
    assert got == pick(jumps.consecutive_match(pages(spark, *rows), n, 9_000))
    assert {r[-1] for r in got} == {"match", "timeout"}


def test_a_visitor_is_forgotten_after_the_time_to_live(spark, feed, tmp_path):
    passed, checkpoint = [], str(tmp_path / "ck")

    def run():
        start_batches(
            state.unique_visits_stream(feed.stream(), ttl_ms=8_000), lambda df, n: passed.extend(seen(df)),
            checkpoint, NOW, close_windows=False,
        ).awaitTermination()

    def kept():
        days = spark.read.format("statestore").option("stateVarName", "day").load(checkpoint)
        return sorted(r[0] for r in days.select("key.mid").collect())

    feed.add(page("a", 1, "E"))
    run()
    assert kept() == ["a"]
    time.sleep(9)
    feed.add(page("b", 2, "E"))
    run()
    assert kept() == ["b"]
    feed.add(page("a", 3, "E"))
    run()
    # Only a visitor forgotten passes a second time on one day.
    assert passed == [("a", 1.0), ("b", 2.0), ("a", 3.0)]


def test_late_and_untimed_rows_are_handed_over_once(spark, tmp_path):
    feed, taken = Feed(spark, tmp_path, "id int, ts bigint"), {"on_time": {}, "refused": {}}
    keep = lambda name: lambda df, n: taken[name].update({n: sorted(map(tuple, df.collect()))})
    run = lambda: start_splitting(
        feed.stream(), keep("on_time"), keep("refused"), str(tmp_path / "ck"), 10, trigger=NOW
    ).awaitTermination()
    feed.add((1, None)).add((2, 100), (3, 5)).add((4, 89), (5, 90), (6, None))
    run()
    feed.add((7, 89), (8, 300)).add((9, 289), (10, 290))
    run()
    assert taken["refused"] == {0: [(1, None, "untimed")], 1: [], 2: [(4, 89, "late"), (6, None, "untimed")],
                                3: [(7, 89, "late")], 4: [(9, 289, "late")]}
    assert sum(len(rows) for rows in taken["on_time"].values()) == 5
    before = {name: dict(rows) for name, rows in taken.items()}
    for name in ("4", ".4.crc"):
        (tmp_path / "ck" / "commits" / name).unlink()
    run()
    assert taken == before
