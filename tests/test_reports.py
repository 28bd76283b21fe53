"""Edges that generated data rarely hits: ties, thresholds, empty and null groups, gaps, zero bases, hot keys."""

import random
from collections import defaultdict
from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from skytally import reports, rollup_flights
from skytally.functions.columns import decode_reason
from skytally.operators import change_over_periods, share_of_total, top_k_per_group


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_support_is_strict(make_flights):
    flights = make_flights(*[{"ORIGIN": o, "DEP_DELAY": 5.0} for o in ["A"] * 3 + ["B"] * 4])
    assert rows(reports.worst_groups(flights, min_support=3)) == [("B", 4, 5.0)]


def test_route_support_is_strict(make_flights):
    flights = make_flights(
        *[{"OP_CARRIER": "X", "ORIGIN": "A", "DEST": d, "ARR_DELAY": 5.0} for d in ["M"] * 50 + ["N"] * 51]
    )
    assert rows(reports.top_routes(flights)) == [("X", "A", "N", 5.0, 51, 1)]


def test_ties_go_by_key(make_flights):
    flights = make_flights(*[{"OP_CARRIER": c, "ARR_DELAY": 7.0} for c in "DBCA"])
    assert rows(reports.volume_by_group(flights, limit=2)) == [("A", 1), ("B", 1)]
    assert [r[1] for r in rows(reports.top_carriers_per_year(flights, k=3))] == ["A", "B", "C"]
    assert reports.headline_extremes(flights).collect()[0].worst_carrier == "A"


def test_ranks_go_by_rounded_means(make_flights):
    flights = make_flights({"OP_CARRIER": "A", "ARR_DELAY": 1.001}, {"OP_CARRIER": "B", "ARR_DELAY": 1.004})
    assert [r[:3] for r in rows(reports.top_carriers_per_year(flights))] == [(2017, "A", 1.0), (2017, "B", 1.0)]


def test_rounding_is_half_up_on_decimal_text(make_flights):
    flights = make_flights({"OP_CARRIER": "A", "ARR_DELAY": 2.675}, {"OP_CARRIER": "B", "ARR_DELAY": 1.005})
    assert [r[2] for r in rows(reports.delay_by_group(flights))] == [2.68, 1.01]


def test_zero_and_missing_delays_do_not_count(make_flights):
    flights = make_flights(*[{"OP_CARRIER": "A", "ARR_DELAY": d} for d in (0.0, -3.0, None, 4.0)])
    assert rows(reports.delay_by_group(flights)) == [("A", 1, 4.0, 4.0)]


def test_codes_of_flights_that_took_place_do_not_count(make_flights):
    flights = make_flights({"CANCELLATION_CODE": "A"}, {"CANCELLATION_CODE": "A", "CANCELLED": 1.0})
    assert rows(reports.reason_counts(flights)) == [("A", 1)]
    assert rows(reports.reason_counts(rollup_flights(flights))) == [("A", 1)]


def test_blank_codes(make_flights):
    flights = make_flights(*[{"CANCELLED": 1.0, "CANCELLATION_CODE": c} for c in ("B", " B ", "", "  ", None, "E")])
    assert rows(reports.reason_counts(flights, drop_blank=True, decode=True)) == [
        ("B", 2, "Weather"),
        ("E", 1, "Unknown"),
    ]
    assert sum(n for _, n in rows(reports.reason_counts(flights))) == 6


def test_decode_reason(spark):
    codes = spark.createDataFrame([("A",), (" B",), ("C",), ("D",), ("Z",), ("",), (None,)], "code string")
    assert [r[0] for r in codes.select(decode_reason(F.col("code"))).collect()] == [
        "Carrier",
        "Weather",
        "National Air System",
        "Security",
        "Unknown",
        "Unknown",
        "Unknown",
    ]


def test_year_without_cancellations_has_rate_zero(make_flights):
    assert rows(reports.year_summary(make_flights({"ARR_DELAY": None}))) == [(2017, 1, 0, 0, None, 0.0)]


def test_change_needs_a_base(make_flights):
    flights = make_flights(
        {"FL_DATE": date(2015, 1, 1), "NAS_DELAY": 0.0},
        {"FL_DATE": date(2016, 1, 1), "NAS_DELAY": 8.0},
        {"FL_DATE": date(2018, 1, 1), "NAS_DELAY": 2.0},
    )
    nas = {"NAS_DELAY": "NAS"}
    assert [r[3] for r in rows(reports.cause_change(flights, nas))] == [None, None, -75.0]
    assert [r[3] for r in rows(reports.cause_change(flights, nas, adjacent_only=True))] == [None, None, None]


def test_change_between_rounded_millions(make_flights):
    flights = make_flights(
        {"FL_DATE": date(2017, 1, 1), "NAS_DELAY": 1_004_000.0},
        {"FL_DATE": date(2018, 1, 1), "NAS_DELAY": 1_503_000.0},
    )
    millions = reports.cause_change(flights, {"NAS_DELAY": "NAS"}, unit=1e6, unit_digits=2)
    assert rows(millions) == [(2017, "NAS", 1.0, None), (2018, "NAS", 1.5, 50.0)]


def test_empty_input(make_flights):
    flights = make_flights({}).filter("false")
    assert rows(reports.flight_count(flights)) == [(0,)]
    assert rows(reports.cause_totals(flights)) == [(None,) * 5]
    assert rows(reports.year_summary_change(flights)) == []
    assert rows(reports.reason_share(flights)) == []
    assert [r[1:] for r in rows(reports.cause_share(flights))] == [(None, None)] * 5
    assert rows(reports.headline_extremes(flights)) == [(None,) * 12]


def test_rollup_refuses_what_it_does_not_keep(make_flights):
    rolled = rollup_flights(make_flights({}))
    with pytest.raises(ValueError):
        reports.delay_by_group(rolled, only_positive=False)
    with pytest.raises(ValueError):
        rollup_flights(rolled)


def test_operators_on_other_tables(spark):
    sales = spark.createDataFrame(
        [("x", 2001, 10.0), ("x", 2002, 15.0), ("y", 2001, 30.0), ("y", 2002, 45.0)],
        "shop string, year int, amount double",
    )
    top = top_k_per_group(sales, ["year"], [F.desc("amount")], 1).orderBy("year")
    assert rows(top) == [("y", 2001, 30.0, 1), ("y", 2002, 45.0, 1)]
    shares = share_of_total(sales, "amount", digits=0).orderBy("shop", "year")
    assert [r[3] for r in rows(shares)] == [10.0, 15.0, 30.0, 45.0]
    changes = change_over_periods(sales, "year", {"amount": "growth"}, by=["shop"]).orderBy("shop", "year")
    assert [r[3] for r in rows(changes)] == [None, 50.0, None, 50.0]


def half_up(x, digits=2):
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_flights_against_brute_force(make_flights, seed):
    """One carrier on one route holds more than a third of all flights."""
    rng = random.Random(seed)
    data = []
    for _ in range(600):
        hot = rng.random() < 0.4
        data.append(
            {
                "FL_DATE": date(rng.choice([2016, 2017, 2018]), rng.randint(1, 12), rng.randint(1, 28)),
                "OP_CARRIER": "HOT" if hot else rng.choice("ABCDE"),
                "ORIGIN": "HUB" if hot else rng.choice(["P", "Q", "R"]),
                "DEST": "END" if hot else rng.choice(["S", "T"]),
                "ARR_DELAY": rng.choice([None, *map(float, range(-5, 12))]),
                "DEP_DELAY": rng.choice([None, *map(float, range(-5, 12))]),
                "CANCELLED": float(rng.random() < 0.2),
                "CANCELLATION_CODE": rng.choice([None, "A", "B", "C"]),
            }
        )
    flights = make_flights(*data)

    routes, volume, years = defaultdict(list), defaultdict(int), defaultdict(list)
    for r in data:
        volume[r["OP_CARRIER"]] += 1
        years[r["FL_DATE"].year].append(r)
        if r["ARR_DELAY"] is not None and r["ARR_DELAY"] > 0:
            routes[r["OP_CARRIER"], r["ORIGIN"], r["DEST"]].append(r["ARR_DELAY"])

    assert rows(reports.volume_by_group(flights)) == sorted(volume.items(), key=lambda kv: (-kv[1], kv[0]))

    ranked = defaultdict(list)
    for (carrier, origin, dest), delays in routes.items():
        if len(delays) > 5:
            ranked[carrier].append((-half_up(sum(delays) / len(delays)), origin, dest, len(delays)))
    want = [
        (carrier, origin, dest, -mean, n, i + 1)
        for carrier in sorted(ranked)
        for i, (mean, origin, dest, n) in enumerate(sorted(ranked[carrier])[:3])
    ]
    assert rows(reports.top_routes(flights, min_support=5)) == want

    summary = []
    for year in sorted(years):
        delays = [r["ARR_DELAY"] for r in years[year] if (r["ARR_DELAY"] or 0) > 0]
        cancelled = sum(r["CANCELLED"] == 1 for r in years[year])
        mean, rate = half_up(sum(delays) / len(delays)), half_up(cancelled / len(years[year]) * 100)
        summary.append((year, len(years[year]), len(delays), cancelled, mean, rate))
    assert rows(reports.year_summary(flights)) == summary


def test_rows_without_a_period_are_no_base(make_flights):
    flights = make_flights(
        {"FL_DATE": None, "ARR_DELAY": 1.0, "WEATHER_DELAY": 1.0},
        *[{"FL_DATE": date(2017, 1, d), "ARR_DELAY": 10.0, "WEATHER_DELAY": 2.0} for d in (1, 2)],
        {"FL_DATE": date(2018, 1, 1), "ARR_DELAY": 20.0, "WEATHER_DELAY": 8.0},
    )
    changes = {r.year: r for r in reports.year_summary_change(flights).collect()}
    assert changes[None].total_flights_change_pct is None and changes[2017].total_flights_change_pct is None
    assert changes[2018].total_flights_change_pct == -50.0 and changes[2018].avg_delay_min_change_pct == 100.0
    weather = {r.year: r.change_pct for r in reports.cause_change(flights).collect() if r.cause == "Weather"}
    assert weather == {None: None, 2017: None, 2018: 100.0}


def test_missing_keys_win_no_headline(make_flights):
    flights = make_flights(
        {"FL_DATE": None, "OP_CARRIER": None, "ORIGIN": None, "ARR_DELAY": 99.0, "DEP_DELAY": 99.0},
        {"FL_DATE": None, "OP_CARRIER": None, "ORIGIN": None, "ARR_DELAY": 99.0, "DEP_DELAY": 99.0},
        {"OP_CARRIER": "A", "ORIGIN": "X", "ARR_DELAY": 5.0, "DEP_DELAY": 5.0},
        {"CANCELLED": 1.0},
    )
    row = reports.headline_extremes(flights, min_support=0).collect()[0]
    assert (row.busiest_carrier, row.worst_carrier, row.worst_origin, row.worst_month) == ("A", "A", "X", 1)
    assert row.top_reason == "Unknown"


def test_columns_that_look_derived_change_nothing(make_flights):
    flights = make_flights({"ARR_DELAY": 5.0}, {"ARR_DELAY": 7.0})
    decoys = flights.withColumns({"Year": F.lit(3000), "month": F.lit(13), "n_flights": F.lit(9)})
    assert rows(reports.year_summary(decoys)) == rows(reports.year_summary(flights))
    assert rows(reports.monthly_trend(decoys)) == rows(reports.monthly_trend(flights))
    assert rows(reports.flight_count(rollup_flights(decoys))) == [(2,)]
