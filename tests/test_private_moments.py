"""Moments as a stream, and their release per journey."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_streams import Feed, _at

from feedlake.operators import delays, privacy
from feedlake.session import work_dir
from feedlake.streaming import clock, moments
from feedlake.streaming import jobs as streams

LATE = "rid string, event_time timestamp, tpl string, delay double"
NUMBERS = st.lists(st.floats(-100, 100), min_size=1, max_size=20)


@settings(max_examples=200, deadline=None)
@given(st.lists(NUMBERS, min_size=2, max_size=6), st.sampled_from([0.0, 1e6]))
def test_moments_combine_and_come_apart(groups, shift):
    arrays = [np.array(g) + shift for g in groups]
    whole = np.concatenate(arrays)
    n, mean, apart = moments.together([moments.of(a) for a in arrays])
    assert n == len(whole) and mean == pytest.approx(whole.mean(), rel=1e-12, abs=1e-9)
    assert apart == pytest.approx(((whole - whole.mean()) ** 2).sum(), rel=1e-9, abs=1e-6)
    left = np.concatenate(arrays[1:])
    n, mean, apart = moments.without((n, mean, apart), moments.of(arrays[0]))
    assert n == len(left) and mean == pytest.approx(left.mean(), rel=1e-12, abs=1e-9)
    assert apart == pytest.approx(((left - left.mean()) ** 2).sum(), rel=1e-7, abs=1e-4)
    assert moments.without(moments.of(left), moments.of(left)) == moments.NOTHING


@pytest.mark.parametrize("shift", [0.0, 1e6])
def test_stream_moments_follow_journeys_that_move(spark, shift):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", clock.STATE_PROVIDER)
    rng = random.Random(4)
    rows = [(f"j{rng.randrange(9)}", _at(k), f"T{k % 3}", shift + rng.gauss(0, 3)) for k in range(120)]
    feed = Feed(spark, LATE)
    planes = delays.planes(4, delays.VECTOR_LENGTH, 42)
    seen_buckets = {}
    for upto in (40, 80, 120):
        feed.deliver(rows[upto - 40 : upto])
        out = feed.drained(moments.moment_changes(feed.stream(), parts=2))
        own, want = {}, {}
        for rid, _, _, delay in rows[:upto]:
            own.setdefault(rid, []).append(delay)
        for rid, values in own.items():
            last = values[-5:] + [0.0] * (5 - len(values[-5:]))
            bucket = "".join("1" if sum(a * b for a, b in zip(last, p)) >= 0 else "0" for p in planes)
            want.setdefault(bucket, []).extend(values)
            seen_buckets.setdefault(rid, set()).add(bucket)
        got = {r.bucket: r for r in moments.latest_moments(out).collect()}
        assert {b: r.n for b, r in got.items()} == {b: len(v) for b, v in want.items()}
        for bucket, values in want.items():
            assert got[bucket]["mean"] == pytest.approx(np.mean(values), rel=1e-9, abs=1e-9)
            assert got[bucket].variance == pytest.approx(np.var(values), rel=1e-9, abs=1e-9)
    assert shift or any(len(b) > 1 for b in seen_buckets.values())


def test_a_journey_changes_one_row_by_what_is_stated(spark):
    rng = random.Random(2)
    rows = [(f"j{rng.randrange(6)}", _at(k), "T", rng.choice([-1, 1]) * 10.0 ** rng.randrange(4)) for k in range(90)]
    rows += [("j0", _at(1000 + k), "T", 5.0) for k in range(50)]  # a busy journey counts for no more
    whole = {r.bucket: r for r in privacy.journey_sums(spark.createDataFrame(rows, LATE), rows=7).collect()}
    assert len(whole) == 16
    for gone in ("j0", "j3", "j5"):
        less = privacy.journey_sums(spark.createDataFrame([r for r in rows if r[0] != gone], LATE), rows=7).collect()
        changed = [(whole[r.bucket], r) for r in less if tuple(r) != tuple(whole[r.bucket])]
        assert len(changed) == 1 and len(less) == 16
        (before, after) = changed[0]
        assert 0 < before.n - after.n <= 7
        assert abs(before.total - after.total) <= 7 * 120 and 0 <= before.squares - after.squares <= 7 * 120**2


def test_the_ledger_refuses_what_is_not_left(spark):
    late = [(f"j{k % 5}", _at(k), "T", float(k)) for k in range(30)]
    sums = privacy.journey_sums(spark.createDataFrame(late, LATE))
    ledger = privacy.Ledger(spark, f"{work_dir(spark, 'ledger')}/table", budget=1.0)
    first = sorted(privacy.release_moments(sums, ledger, "monday", "s", epsilon=0.6).collect())
    assert ledger.spent() == 0.6
    # Once more, unchanged: the same values, at no cost.
    assert sorted(privacy.release_moments(sums, ledger, "monday", "s", epsilon=0.6).collect()) == first
    assert ledger.spent() == 0.6
    with pytest.raises(privacy.BudgetSpent):
        privacy.release_moments(sums, ledger, "tuesday", "s", epsilon=0.6)
    other = sorted(privacy.release_moments(sums, ledger, "wednesday", "s", epsilon=0.4).collect())
    assert [r.noisy_n for r in other] != [r.noisy_n for r in first] and ledger.spent() == pytest.approx(1.0)
    changed = privacy.journey_sums(spark.createDataFrame(late[:-1], LATE))
    with pytest.raises(ValueError, match="other data"):
        privacy.release_moments(changed, ledger, "monday", "s", epsilon=0.6)
