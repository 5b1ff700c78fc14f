from eventlake.operators import gold
from eventlake.operators.silver import silver
from eventlake.sources.fixtures import read_bronze
from tests.conftest import PURCHASE, SMALL, at


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_purchase_after_midnight_leaves_the_cart_abandoned(events):
    df = events(
        {"event_type": "add_to_cart", "event_timestamp": at(23 * 60 + 59)},
        {**PURCHASE, "event_timestamp": at(1, day=2)},
    )
    row = gold.kpi_cart_abandonment(df).first()
    assert (row["sessions_with_cart"], row["abandoned_carts"], row["abandonment_rate"]) == (1, 1, 1.0)


def test_purchase_before_the_cart_add_converts(events):
    df = events(PURCHASE, {"event_type": "add_to_cart", "event_timestamp": at(5)})
    assert gold.kpi_cart_abandonment(df).first()["abandoned_carts"] == 0


def test_session_counts_once(events):
    df = events(*[{"event_type": "add_to_cart"}] * 3, {"event_type": "add_to_cart", "session_id": "s2"})
    row = gold.kpi_cart_abandonment(df).first()
    assert (row["sessions_with_cart"], row["abandoned_carts"]) == (2, 2)


def test_day_without_buyers_is_present_with_zero(events):
    row = gold.kpi_conversion_rate(events({}, {"user_id": 2})).first()
    assert (row["dau_count"], row["unique_buyers"], row["conversion_rate"]) == (2, 0, 0.0)


def test_revenue_absent_on_days_without_purchases(events):
    assert gold.kpi_revenue_daily(events({})).isEmpty()


def test_revenue(events):
    df = events({**PURCHASE, "price": 10.0}, {**PURCHASE, "price": 5.0}, {**PURCHASE, "price": 5.0})
    row = gold.kpi_revenue_daily(df).first()
    assert (row["total_revenue"], row["total_purchases"], row["avg_order_value"]) == (20.0, 3, 6.67)


def test_average_does_not_depend_on_the_order_of_the_sum(spark):
    s = silver(read_bronze(spark, SMALL))
    answers = {
        tuple(rows(gold.kpi_revenue_daily(s.repartition(n, "event_id")).select("event_date", "avg_order_value"), "event_date"))
        for n in (1, 3, 8)
    }
    assert len(answers) == 1


def test_null_page_is_its_own_group(events):
    assert rows(gold.dim_pages(events({"page": None}, {"page": None}, {})), "page") == [(None, 2), ("/home", 1)]


def test_rollups_equal_direct_kpis(spark):
    s = silver(read_bronze(spark, SMALL))
    users, pages, sales = gold.user_day(s), gold.page_day(s), gold.kpi_category_sales(s)
    pairs = [
        (gold.dim_users(s), gold.dim_users_from_rollup(users), ("user_id",)),
        (gold.dim_pages(s), gold.dim_pages_from_rollup(pages), ("page",)),
        (gold.kpi_dau(s), gold.dau_from_rollup(users), ("event_date",)),
        (gold.kpi_events_per_source(s), gold.events_per_source_from_rollup(users), ("event_date", "source")),
        (gold.kpi_purchases_per_page(s), gold.purchases_per_page_from_rollup(pages), ("event_date", "page")),
        (gold.kpi_conversion_rate(s), gold.conversion_from_rollup(users), ("event_date",)),
        (gold.kpi_conversion_rate(s), gold.join_buyers(gold.kpi_dau(s), gold.unique_buyers(s)), ("event_date",)),
    ]
    for direct, derived, keys in pairs:
        assert rows(direct, *keys) == rows(derived, *keys)
    by_day = {r[0]: r for r in gold.kpi_revenue_daily(s).collect()}
    for r in gold.revenue_from_category_sales(sales).collect():
        direct = by_day[r[0]]
        assert abs(r[1] - direct[1]) < 1e-6 and r[2] == direct[2] and r[3] == direct[3]


def test_bounds(spark):
    s = silver(read_bronze(spark, SMALL))
    assert gold.kpi_conversion_rate(s).filter("unique_buyers > dau_count").isEmpty()
    assert gold.kpi_cart_abandonment(s).filter("abandoned_carts > sessions_with_cart").isEmpty()


def test_purchase_filter_reaches_the_scan(spark, tmp_path):
    silver(read_bronze(spark, SMALL)).write.partitionBy("event_date").parquet(str(tmp_path / "silver"))
    df = gold.kpi_revenue_daily(spark.read.parquet(str(tmp_path / "silver")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,purchase)" in plan
    schema = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "price" in schema and "session_id" not in schema and "page" not in schema
