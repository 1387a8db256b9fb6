import random

import pytest
from helpers import page, pages, seen

from millrace.operators import jumps, visits

DAY = 86_400


def test_entry_rule(spark):
    rows = pages(spark, page("a", 1, "E"), page("a", 2, "e"), page("a", 3, "B"), page("a", 4, "N"))
    assert seen(rows.where(visits.is_entry())) == [("a", 1.0), ("a", 2.0)]


def test_first_entry_of_each_day(spark):
    rows = pages(
        spark, page("a", 1), page("a", 2, "E"), page("a", 3, "E"), page("a", DAY + 1, "E"),
        page("b", 5, "E"),
    )
    assert seen(visits.unique_visits(rows)) == [("a", 2.0), ("a", DAY + 1.0), ("b", 5.0)]


def test_late_day_counts_once_in_batch(spark):
    rows = pages(spark, page("a", 1, "E"), page("a", DAY + 1, "E"), page("a", 2, "E"))
    assert len(seen(visits.unique_visits(rows))) == 2


JUMP_CASES = {
    "alone, pair, last": (
        [("a", 1, "E"), ("a", 4, "E"), ("a", 5, "N"), ("b", 3, "E"), ("c", 90, "E")],
        [("a", 1.0), ("b", 3.0), ("c", 90.0)],
    ),
    "limit counts as timed out": (
        [("a", 0, "E"), ("a", 10, "N"), ("b", 0, "E"), ("b", 9.999, "N")], [("a", 0.0)],
    ),
    "empty text is an entry": ([("a", 0, "e"), ("a", 50, "N")], [("a", 0.0)]),
    "blank is a page": ([("a", 0, "B")], []),
    "overlapping matches": (
        [("a", 0, "E"), ("a", 1, "E"), ("a", 2, "E"), ("a", 3, "N")], [("a", 0.0), ("a", 1.0)],
    ),
}


@pytest.mark.parametrize("case", JUMP_CASES)
def test_bounces(spark, case):
    rows, expected = JUMP_CASES[case]
    for order in (rows, rows[::-1]):
        assert seen(jumps.detect(pages(spark, *[page(*r) for r in order]))) == expected


def brute_force(rows, n, within):
    """(visitor, ts, outcome) by walking each visitor's events."""
    found = []
    for mid in {r[0] for r in rows}:
        events = sorted((ts, seq, kind == "E") for m, ts, seq, kind in rows if m == mid)
        for i, (ts, seq, entry) in enumerate(events):
            if not entry:
                continue
            outcome = "match"
            for k in range(1, n):
                if i + k >= len(events) or events[i + k][0] - ts >= within:
                    outcome = "timeout"
                    break
                if not events[i + k][2]:
                    outcome = None
                    break
            if outcome:
                found.append((mid, ts, seq, outcome))
    return sorted(found)


@pytest.mark.parametrize("n", [2, 3])
@pytest.mark.parametrize("slice_ms", [10_000, 17_000, None])
def test_slices_change_nothing(spark, n, slice_ms):
    """One visitor holds most rows; many share an instant or sit at a slice's edge."""
    rng = random.Random(n)
    rows = [
        (rng.choice(["hot", "hot", "hot", "b", "c"]), rng.randrange(0, 200) * 1000, seq,
         rng.choice("EEN"))
        for seq in range(400)
    ]
    df = pages(spark, *[page(m, ts / 1000, k, seq=s) for m, ts, s, k in rows])
    got = jumps.consecutive_match(df, n, slice_ms=slice_ms)
    got = sorted(tuple(r) for r in got.select("common.mid", "ts", "seq", "outcome").collect())
    assert got == brute_force(rows, n, 10_000)


def test_outcomes_make_up_the_bounces(spark):
    df = pages(spark, page("a", 1, "E"), page("a", 4, "E"), page("a", 20, "N"))
    outcomes = jumps.consecutive_match(df)
    assert seen(jumps.matched(outcomes)) == [("a", 1.0)]
    assert seen(jumps.timed_out(outcomes)) == [("a", 4.0)]
    assert seen(jumps.detect(df)) == [("a", 1.0), ("a", 4.0)]
