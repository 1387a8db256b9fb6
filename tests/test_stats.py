import random

from helpers import page, pages

from millrace.operators import stats
from millrace.schemas import VISITOR_STATS


def test_one_window(spark):
    views = pages(
        spark, page("a", 1, "E", during=10), page("a", 2, "E", during=20), page("b", 3, "N"),
    )
    visit, bounce = pages(spark, page("a", 1, "E")), pages(spark, page("a", 2, "E"))
    got = stats.visitor_stats(visit, bounce, views)
    kinds = got.schema.simpleString()
    assert kinds == VISITOR_STATS.simpleString()
    [row] = got.collect()
    assert (row.uv_ct, row.pv_ct, row.sv_ct, row.uj_ct, row.dur_sum, row.ts) == (1, 3, 2, 1, 30, 1000)
    assert (row.stt, row.edt) == ("1970-01-01 00:00:00", "1970-01-01 00:00:10")
    assert (row.vc, row.ch, row.ar, row.is_new) == ("v", "c", "a", "0")


def test_window_end_is_exclusive(spark):
    none = pages(spark).limit(0)
    views = pages(spark, page("a", 9.999), page("a", 10))
    got = stats.visitor_stats(none, none, views)
    assert sorted(r.stt for r in got.collect()) == ["1970-01-01 00:00:00", "1970-01-01 00:00:10"]


def test_repair_after_union_equals_repair_before(spark):
    from millrace.operators import jumps, logs, visits
    rows = pages(spark, *[
        page(f"m{i % 3}", i * 3, "E" if i % 2 else "N", seq=i, is_new=str(i % 2), during=i)
        for i in range(40)
    ])
    fixed = logs.repair_is_new(rows)
    before = stats.visitor_stats(visits.unique_visits(fixed), jumps.detect(fixed), fixed)
    after = stats.visitor_stats_of_logs(rows)
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(before) == key(after)


def test_one_pass_equals_the_three_tables(spark):
    """Hot visitors over several slices and days, ties, records without a time, missing flags."""
    from millrace.operators import jumps, logs, visits
    rng = random.Random(6)
    rows = [
        page(rng.choice("aaab"), rng.choice([rng.randrange(0, 2000), 86_399, 86_400, 90_000]), rng.choice("EeNB"), seq=i,
             is_new=rng.choice(["1", "1", "0", None]), during=rng.choice([None, i]), dims=(rng.choice("vw"), "c", "a"))
        for i in range(300)
    ]
    untimed = list(page("b", 1, "E", seq=900, is_new="1"))
    untimed[4] = None
    rows = pages(spark, *rows, tuple(untimed))
    fixed = logs.repair_is_new(rows)
    key = lambda df: sorted(map(repr, df.collect()))
    before = stats.visitor_stats(visits.unique_visits(fixed), jumps.detect(fixed, 5_000), fixed)
    for slice_ms in (None, 5_000):
        assert key(stats.visitor_stats_of_logs(rows, 5_000, slice_ms=slice_ms)) == key(before)
