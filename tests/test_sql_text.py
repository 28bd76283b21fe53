"""The SQL texts and the DataFrame reports return the same rows in the same order."""

import pytest

from skytally import bind_flights, register_view, reports, sql_report
from skytally.plans.sql_text import SQL_REPORTS

TWINS = {
    "volume_by_carrier": lambda f: reports.volume_by_group(f, limit=10),
    "delay_by_carrier": lambda f: reports.delay_by_group(f, limit=10),
    "cause_totals": reports.cause_totals,
    "worst_origins": lambda f: reports.worst_groups(f, limit=10),
    "cancel_reasons": reports.reason_counts,
    "monthly_trend": reports.monthly_trend,
}


def test_all_texts_have_a_twin():
    assert set(TWINS) == set(SQL_REPORTS)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_text_equals_dataframe(spark, name, fixture_flights):
    for flights in (fixture_flights, bind_flights(spark, "/root/testdata/sf0.01")):
        text, frame = sql_report(flights, name), TWINS[name](flights)
        assert text.dtypes == frame.dtypes
        assert text.collect() == frame.collect()


def test_view(spark, fixture_flights):
    register_view(fixture_flights, "small_flights")
    assert spark.sql("select count(*) from small_flights where ARR_DELAY > 0").collect()[0][0] == 6
