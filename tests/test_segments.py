from __future__ import annotations

from datetime import date

from tests.fixtures import AS_OF, DAY, by_id, customers, mart, mart_row, telemetry
from usagemart.operators.mart import customer_mart, to_mart_types
from usagemart.operators.segments import (
    IN_BAND, OUT_OF_BAND, customer_analytics, segment_counts, segment_load_stats, segment_map,
    segment_performance, segment_review, segment_value_counts, top_engaged, top_segment)
from usagemart.sources.dimensions import segment_dim


def test_seeds_lie_in_their_band(spark):
    rows = by_id(customer_analytics(mart(spark), segment_dim(spark), AS_OF))
    assert {r.segment_validation for r in rows.values()} == {IN_BAND}
    assert rows[1001].segment_name == "Премиум" and rows[1001].full_name == "Иван Иванов"
    assert rows[1001].years_as_customer == 1 and rows[1003].years_as_customer == 0
    assert segment_review(mart(spark), segment_dim(spark)).isEmpty()


def test_formula_scores_are_out_of_band(spark):
    typed = to_mart_types(customer_mart(customers(spark), telemetry(spark), DAY, AS_OF))
    assert segment_review(typed, segment_dim(spark)).count() == 5


def test_unknown_segment_and_missing_score_need_review(spark):
    rows = [mart_row(1, "partner"), mart_row(2, None), mart_row(3, "standard", None),
            mart_row(4, "standard", "50"), mart_row(5, "premium", "50"),
            mart_row(6, "inactive", "10.01")]
    verdicts = by_id(customer_analytics(mart(spark, rows), segment_dim(spark), AS_OF))
    assert len(verdicts) == 6
    assert {k for k, v in verdicts.items() if v.segment_validation == OUT_OF_BAND} == {1, 2, 3, 6}
    assert verdicts[1].segment_name is None
    review = by_id(segment_review(mart(spark, rows), segment_dim(spark)))
    assert set(review) == {1, 2, 3, 6}


def test_performance(spark):
    rows = [mart_row(1, "a", "10", value="100", rate="5", conversions=2),
            mart_row(2, "a", "20", value="50", rate=None, conversions=3, loaded=date(2024, 2, 1)),
            mart_row(3, None, "7")]
    result = {r.segment: r for r in segment_performance(mart(spark, rows)).collect()}
    a = result["a"]
    assert (a.customer_count, a.avg_lifetime_value, a.avg_engagement) == (2, 75.0, 15.0)
    assert (a.total_conversions, a.avg_conversion_rate) == (5, 5.0)
    assert a.last_update_date == date(2024, 2, 1)
    assert result[None].customer_count == 1
    assert sum(r.customer_count for r in result.values()) == 3


def test_counts_and_ties(spark):
    rows = [mart_row(1, "b"), mart_row(2, "a"), mart_row(3, None), mart_row(4, None),
            mart_row(5, None)]
    frame = mart(spark, rows)
    assert [tuple(r) for r in segment_value_counts(frame).collect()] == [("a", 1), ("b", 1)]
    assert [tuple(r) for r in segment_counts(frame).collect()] == [(None, 3), ("a", 1), ("b", 1)]
    assert tuple(top_segment(frame).first()) == (None, 3)
    assert tuple(top_segment(frame.where("segment IS NOT NULL")).first()) == ("a", 1)


def test_map_and_stats(spark):
    frame = mart(spark, [mart_row(1, "a", "10"), mart_row(2, "a", "11"), mart_row(3, None, "1")])
    row = segment_map(frame, AS_OF).first()
    assert row.total_records == 3
    assert row.segment_distribution["a"].asDict() == {"count": 2, "avg_engagement": 10.5}
    assert row.segment_distribution["null"]["count"] == 1
    assert {(r.segment, r.n) for r in segment_load_stats(frame).collect()} == {("a", 2), (None, 1)}


def test_empty_mart(spark):
    row = segment_map(mart(spark, []), AS_OF).first()
    assert (row.total_records, row.segment_distribution) == (0, {})


def test_top_engaged(spark):
    frame = mart(spark, [mart_row(i, engagement=str(i // 2)) for i in range(10)])
    assert [r.customer_id for r in top_engaged(frame, 3).collect()] == [8, 9, 6]
