"""Marts, measures and visuals on the CSV fixtures (orphans, duplicates, nulls)."""

from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.operators import marts, measures, quality, visuals


def _clean(retail_csv):
    return quality.clean_sales(retail_csv["sales"])


def test_enrich_inner_join_drops_orphans_and_fans_out_duplicates(retail_csv):
    e = marts.enrich(_clean(retail_csv), retail_csv["customers"], retail_csv["products"])
    ids = sorted(r["transaction_id"] for r in e.collect())
    # T7 is an orphan (unknown customer and product); T3 belongs to C2, a
    # duplicated customer key, so it appears twice.
    assert ids == ["T1", "T1", "T3", "T3", "T8", "T9", "TA", "TB"]


def test_monthly_trends_null_handling(retail_csv):
    clean = _clean(retail_csv)
    sql_trend = {r["month"]: (r["monthly_revenue"], r["num_transactions"]) for r in marts.monthly_trend(clean).collect()}
    assert sql_trend == {
        "2024-01": (Decimal("40.51"), 3),
        "2024-02": (Decimal("500.00"), 1),
        "2024-03": (Decimal("5.00"), 1),
    }
    e = marts.enrich(clean, retail_csv["customers"], retail_csv["products"])
    gold = {r["month"]: (r["monthly_revenue"], r["num_transactions"]) for r in marts.gold_monthly_trend(e).collect()}
    assert gold[None] == (6.6, 3)
    assert gold["2024-01"] == (40.51, 3)


def test_high_value_is_inclusive(retail_csv):
    hv = marts.high_value_sales(_clean(retail_csv), Decimal("500.00"))
    assert [r["transaction_id"] for r in hv.collect()] == ["T9"]


def test_fact_level_measures_keep_orphans(retail_csv):
    clean = _clean(retail_csv)
    assert measures.total_sales(clean).first()["total_sales"] == 579.81
    # 7 distinct transactions (T1 twice): 579.81 / 7 = 82.83
    assert measures.average_order_value(clean).first()["average_order_value"] == 82.83
    assert measures.customer_count(clean).first()["customer_count"] == 3


def test_two_average_order_values_differ(retail_csv):
    clean = _clean(retail_csv)
    e = marts.enrich(clean, retail_csv["customers"], retail_csv["products"])
    line_mean = marts.gold_revenue_by_city(e).filter(F.col("city") == "Pune").first()["avg_order_value"]
    # Pune lines: 20.20, 5.00, 20.20, 0.11, 6.00, 500.00 -> mean 91.918333 -> 91.92
    assert line_mean == 91.92


def test_sales_by_dimension_left_join_keeps_unknown_member(retail_csv):
    clean = _clean(retail_csv)
    by_city = {r["city"]: r["total_sales"] for r in visuals.sales_by_city(clean, retail_csv["customers"]).collect()}
    assert by_city[None] == 28.0  # T7, unknown customer
    assert by_city["Delhi"] == 0.6  # T3 fans out over the duplicated C2
    assert round(sum(by_city.values()), 2) == 580.11  # 579.81 plus the fanned-out 0.30


def test_top_category_tie_goes_to_alphabetically_first(spark):
    fact = spark.createDataFrame(
        [("P1", Decimal("10.00")), ("P2", Decimal("10.00")), ("P3", Decimal("3.00"))],
        "product_id string, revenue decimal(23,2)",
    )
    products = spark.createDataFrame(
        [("P1", "Toys"), ("P2", "Food"), ("P3", "Books")], "product_id string, category string"
    )
    assert measures.top_category(fact, products).first()["top_category"] == "Food"


def test_growth_by_month_uses_previous_calendar_month(spark):
    fact = spark.createDataFrame(
        [
            ("2024-01-15", Decimal("100.00")),
            ("2024-02-10", Decimal("150.00")),
            ("2024-04-01", Decimal("80.00")),
            ("2024-05-31", Decimal("40.00")),
        ],
        "ts string, revenue decimal(23,2)",
    ).select(F.to_timestamp("ts").alias("timestamp"), "revenue")
    got = {r["month"]: r["growth"] for r in measures.sales_growth_by_month(fact).collect()}
    assert got == {"2024-01": 0.0, "2024-02": 0.5, "2024-04": 0.0, "2024-05": -0.5}


def test_growth_mtd_window(spark):
    fact = spark.createDataFrame(
        [
            ("2024-03-01", Decimal("10.00")),
            ("2024-03-15", Decimal("20.00")),  # latest date: this = Mar 1..15
            ("2024-02-01", Decimal("7.00")),
            ("2024-02-15", Decimal("8.00")),  # last = Feb 1..15
            ("2024-02-20", Decimal("1000.00")),  # after Feb 15: not in the span
        ],
        "ts string, revenue decimal(23,2)",
    ).select(F.to_timestamp("ts").alias("timestamp"), "revenue")
    r = measures.sales_growth_mtd(fact).first()
    assert (r["this_month"], r["last_month"], r["growth"]) == (30.0, 15.0, 1.0)


def test_revenue_by_segment_repeats_segment_total(retail_csv):
    clean = _clean(retail_csv)
    rows = measures.revenue_by_segment(clean, retail_csv["customers"]).collect()
    for r in rows:
        seg_total = sum(x["revenue"] for x in rows if x["segment"] == r["segment"])
        assert abs(r["segment_revenue"] - seg_total) < 1e-9


def test_low_sales_days_with_calendar(spark):
    from ledgerline.operators.star import dim_date

    fact = spark.createDataFrame(
        [("2024-01-01", Decimal("5.00")), ("2024-01-03", Decimal("2000.00"))],
        "ts string, revenue decimal(23,2)",
    ).select(F.to_timestamp("ts").alias("timestamp"), "revenue")
    daily = fact.groupBy(F.to_date("timestamp").alias("date")).agg(F.sum("revenue").alias("daily_revenue"))
    plain = sorted(str(r["date"]) for r in marts.low_sales_days(daily, Decimal("1000")).collect())
    filled = sorted(str(r["date"]) for r in marts.low_sales_days(daily, Decimal("1000"), dim_date(fact)).collect())
    assert plain == ["2024-01-01"]
    assert filled == ["2024-01-01", "2024-01-02"]


def test_invariant_city_sum_equals_enriched_total(retail_csv):
    clean = _clean(retail_csv)
    e = marts.enrich(clean, retail_csv["customers"], retail_csv["products"])
    city_total = sum(r["total_revenue"] for r in marts.gold_revenue_by_city(e).collect())
    enriched_total = e.agg(F.sum("revenue")).first()[0]
    assert round(city_total, 2) == float(enriched_total)


def test_dashboard_covers_the_layout(retail_csv):
    clean = _clean(retail_csv)
    pages = visuals.dashboard(clean, retail_csv["customers"], retail_csv["products"])
    assert {p: set(v) for p, v in pages.items()} == {
        "Executive Overview": {"KPI Cards"},
        "Sales by Geography": {"Filled Map", "Bar Chart"},
        "Sales Trend": {"Line Chart", "Area Chart"},
        "Top Products": {"Bar Chart", "Treemap"},
        "Customer Segmentation": {"Donut Chart", "Table"},
    }
    kpi = pages["Executive Overview"]["KPI Cards"].first()
    assert (kpi["total_sales"], kpi["average_order_value"], kpi["customer_count"]) == (579.81, 82.83, 3)
    donut = {r["segment"]: r["total_sales"] for r in pages["Customer Segmentation"]["Donut Chart"].collect()}
    assert donut == {"Gold": 551.51, "Silver": 0.6, None: 28.0}


def test_fact_sample(retail_csv):
    from ledgerline.operators.star import SAMPLE_COLUMNS, fact_sample

    e = marts.enrich(_clean(retail_csv), retail_csv["customers"], retail_csv["products"])
    rows = fact_sample(e).collect()
    assert len(rows) == 5 and tuple(rows[0].asDict()) == SAMPLE_COLUMNS
    assert [r["transaction_id"] for r in rows] == ["T1", "T1", "T3", "T3", "T8"]


def test_segment_summary_reads_the_fact_once(spark, tmp_path):
    """Members of a segment are counted once each, from one pass over the fact."""
    from decimal import Decimal

    from ledgerline.operators.visuals import segment_summary

    rows = [
        ("T1", "C1", "10.00"), ("T1", "C1", "5.00"), ("T1", "C2", "1.00"),  # one transaction of two customers
        ("T2", "C1", "4.00"), ("T3", "C3", "2.00"), ("T4", "C9", "7.00"), ("T5", "C8", "1.00"),
    ]
    customers = [("C1", "A"), ("C2", "A"), ("C3", "A"), ("C3", "B"), ("C4", "B"), ("C8", None)]
    spark.createDataFrame([(t, c, Decimal(r)) for t, c, r in rows], "transaction_id string, customer_id string, revenue decimal(23,2)").write.parquet(f"{tmp_path}/fact")
    spark.createDataFrame(customers, "customer_id string, segment string").write.parquet(f"{tmp_path}/customers")
    got = segment_summary(spark.read.parquet(f"{tmp_path}/fact"), spark.read.parquet(f"{tmp_path}/customers"))
    assert sorted(map(tuple, got.collect()), key=str) == [("A", 22.0, 7.33, 3), ("B", 2.0, 2.0, 1), (None, 8.0, 4.0, 2)]
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") == 2
