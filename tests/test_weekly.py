"""Weekly reports: truth tables, week edges, and the two mask plans agree."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from agora.operators.activity import week_masks, week_masks_literal
from agora.plans import weekly

MONDAY = dt.date(2024, 1, 8)


def staging_df(spark, rows):
    return spark.createDataFrame(rows, "author_id string, etl_ts date")


def mask_rows(mask, user):
    return [(user, MONDAY + dt.timedelta(days=d)) for d in range(7) if mask >> d & 1]


def python_flags(s):
    def has(p):
        return all(c == "1" for c, q in zip(s, p) if q == "1")

    return (
        int(has("1111111")),
        int(has("1111110") or has("0111111")),
        int(has("1111101") or has("1011111")),
    )


@pytest.fixture(scope="module")
def all_masks(spark):
    rows = []
    for m in range(1, 128):
        rows += mask_rows(m, f"u{m:03d}")
    return staging_df(spark, rows)


@pytest.mark.parametrize("literal", [False, True])
def test_all_masks_truth_table(spark, all_masks, literal):
    out = {r.author_id: r for r in weekly.consecutive_day_flags(all_masks, literal=literal).collect()}
    assert len(out) == 127
    for m in range(1, 128):
        r = out[f"u{m:03d}"]
        expect_s = format(m, "07b")
        assert r.weekly_activity == expect_s
        assert (
            r.is_active_7_consecutive_days,
            r.is_active_6_consecutive_days,
            r.is_active_5_consecutive_days,
        ) == python_flags(expect_s)


@pytest.mark.parametrize(
    "s,flags",
    [
        ("1111111", (1, 1, 1)),
        ("1111110", (0, 1, 0)),
        ("0111111", (0, 1, 0)),
        ("1111101", (0, 0, 1)),
        ("1011111", (0, 0, 1)),
        ("0111110", (0, 0, 0)),
        ("1111100", (0, 0, 0)),
        ("0011111", (0, 0, 0)),
    ],
)
def test_golden_flag_cases(spark, s, flags):
    df = staging_df(spark, mask_rows(int(s, 2), "x"))
    r = weekly.consecutive_day_flags(df).collect()[0]
    assert r.weekly_activity == s
    assert (r.is_active_7_consecutive_days, r.is_active_6_consecutive_days, r.is_active_5_consecutive_days) == flags


def test_monday_and_sunday_only(spark):
    df = staging_df(spark, [("mon", dt.date(2024, 1, 8)), ("sun", dt.date(2024, 1, 14))])
    out = {r.author_id: r for r in weekly.weekly_activity_rate(df).collect()}
    assert out["mon"].weekly_activity == "0000001"
    assert out["sun"].weekly_activity == "1000000"
    assert out["mon"].avg_activity_rate_per_week == 0.14
    assert out["sun"].avg_activity_rate_per_week == 0.14


def test_duplicates_missing_authors_and_edges(spark):
    df = staging_df(
        spark,
        [
            ("a", dt.date(2024, 1, 9)),
            ("a", dt.date(2024, 1, 9)),  # same user and day loaded twice
            ("None", dt.date(2024, 1, 9)),  # missing-author sentinel
            (None, dt.date(2024, 1, 9)),
            ("b", dt.date(2024, 1, 7)),  # week 1
            ("c", dt.date(2024, 1, 15)),  # week 3
            ("d", None),
        ],
    )
    for literal in (False, True):
        out = {r.author_id: r.user_num_active_in_week for r in weekly.weekly_active_days(df, literal=literal).collect()}
        assert out == {"a": 1}


def test_year_caveat_parity_and_prune(spark):
    # 2023-01-09 is in ISO week 2 of 2023: the reports keep the user with 0 days.
    df = staging_df(spark, [("old", dt.date(2023, 1, 9)), ("new", dt.date(2024, 1, 10))])
    parity = {r.author_id: r.user_num_active_in_week for r in weekly.weekly_active_days(df).collect()}
    literal = {r.author_id: r.user_num_active_in_week for r in weekly.weekly_active_days(df, literal=True).collect()}
    pruned = {r.author_id: r.user_num_active_in_week for r in weekly.weekly_active_days(df, prune=True).collect()}
    assert parity == literal == {"old": 0, "new": 1}
    assert pruned == {"new": 1}


def test_other_week_parameter(spark):
    df = staging_df(spark, [("a", dt.date(2024, 12, 30)), ("a", dt.date(2025, 1, 5))])
    # 2024-12-30 is Monday of ISO week 1 of 2025.
    out = weekly.weekly_activity_rate(df, year=2025, week=1, prune=True).collect()
    assert [(r.author_id, r.weekly_activity) for r in out] == [("a", "1000001")]


def random_staging(seed, users=300, rows=4000):
    rnd = random.Random(seed)
    start = dt.date(2024, 1, 1)
    out = []
    for _ in range(rows):
        u = rnd.choice([None, "None"] + [f"u{i}" for i in range(users)])
        d = start + dt.timedelta(days=rnd.randrange(0, 30))
        out.append((u, d))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bit_or_equals_literal_form(spark, seed):
    df = staging_df(spark, random_staging(seed))
    fast = week_masks(df).select("author_id", "mask")
    slow = week_masks_literal(df).select("author_id", "mask")
    assert fast.count() == slow.count()
    assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0


def brute_longest(rows):
    days = defaultdict(set)
    for u, d in rows:
        if u is not None and u != "None" and d is not None:
            days[u].add(d)
    out = {}
    for u, ds in days.items():
        best = 0
        for d in ds:
            if d - dt.timedelta(days=1) not in ds:
                n = 1
                while d + dt.timedelta(days=n) in ds:
                    n += 1
                best = max(best, n)
        out[u] = best
    return out


def test_longest_streak_brute_force(spark):
    rows = random_staging(7, users=60, rows=700)
    got = {r.author_id: r.longest_streak for r in weekly.longest_streak(staging_df(spark, rows)).collect()}
    assert got == brute_longest(rows)


def test_weekly_active_users_brute_force(spark):
    rows = random_staging(11)
    expect = defaultdict(set)
    for u, d in rows:
        if u is not None and u != "None":
            expect[d - dt.timedelta(days=d.weekday())].add(u)
    got = {r.week_start: r.active_users for r in weekly.weekly_active_users(staging_df(spark, rows)).collect()}
    assert got == {k: len(v) for k, v in expect.items()}


def test_shared_masks_reused(spark, all_masks):
    masks = week_masks(all_masks)
    a = weekly.weekly_active_days(masks=masks)
    b = weekly.consecutive_day_flags(masks=masks)
    assert a.count() == b.count() == 127


user_days = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", "None"]), st.integers(min_value=-10, max_value=16)),
    min_size=1,
    max_size=40,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=user_days)
def test_mask_property_against_python(spark, rows):
    """Week masks equal a Python computation, for both plans (days around week 2 of 2024)."""
    data = [(u, MONDAY + dt.timedelta(days=d)) for u, d in rows]
    expect = defaultdict(int)
    for u, day in data:
        if u == "None" or day.isocalendar()[1] != 2:
            continue
        offset = (day - MONDAY).days
        expect[u] |= (1 << offset) if 0 <= offset < 7 else 0
    df = staging_df(spark, data)
    for build in (week_masks, week_masks_literal):
        got = {r.author_id: r.mask for r in build(df).collect()}
        assert got == dict(expect)


def test_all_reports_from_one_mask_table(spark, tmp_dir):
    rows = random_staging(5, users=40, rows=500)
    df = staging_df(spark, rows)
    paths = weekly.write_all_reports(df, tmp_dir)
    for name, build in weekly.REPORT_BUILDERS.items():
        written = spark.read.parquet(paths[name])
        direct = build(df)
        assert written.exceptAll(direct).count() == 0 and direct.exceptAll(written).count() == 0


@pytest.mark.parametrize("year,week", [(2024, 2), (2024, 3), (2025, 1)])
def test_sql_reports_equal_dataframe_reports(spark, year, week):
    from agora.plans import reports_sql

    rows = random_staging(13, users=50, rows=800)
    rows += [("edge", dt.date(2024, 12, 30)), ("edge", dt.date(2025, 1, 5))]
    df = staging_df(spark, rows)
    pairs = [
        ("active_days", weekly.weekly_active_days),
        ("activity_rate", weekly.weekly_activity_rate),
        ("consecutive_days", weekly.consecutive_day_flags),
    ]
    for name, build in pairs:
        via_sql = reports_sql.run_report(spark, name, df, year, week, view=f"stg_{name}_{year}_{week}")
        direct = build(df, year=year, week=week)
        assert sorted(map(tuple, via_sql.collect())) == sorted(map(tuple, direct.collect())), name
