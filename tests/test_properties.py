"""Property tests: the closed-form level equals the recursion over the
zero-filled calendar; a hot key holding a third of the rows changes nothing."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tillroll.operators import clean, forecast, star, validate, warehouse


def recursion(values):
    alpha = min(1.0, max(0.01, 2.0 / (len(values) + 1)))
    level = values[0]
    for v in values[1:]:
        level = alpha * v + (1 - alpha) * level
    return level


series = st.lists(
    st.tuples(st.integers(min_value=0, max_value=400), st.floats(min_value=0, max_value=1e6, allow_nan=False)),
    min_size=1, max_size=25, unique_by=lambda t: t[0],
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(points=series)
def test_closed_form_level_equals_recursion(spark, points):
    start = dt.date(2026, 1, 1)
    rows = [(start + dt.timedelta(days=o), "r", "R", v) for o, v in points]
    df = spark.createDataFrame(rows, "metric_date date, region_key string, region_name string, revenue double")
    got = forecast.smoothing_levels(df).first()
    first, last = min(o for o, _ in points), max(o for o, _ in points)
    filled = [0.0] * (last - first + 1)
    for o, v in points:
        filled[o - first] = v
    want = recursion(filled)
    assert got.n_days == len(filled)
    assert abs(got.level - want) <= 1e-9 * max(1.0, abs(want))


def test_hot_stock_code_and_duplicate_rows(spark, raw_frame):
    day = dt.date(2026, 7, 21)
    rows = []
    for i in range(300):
        code = "HOT" if i % 3 == 0 else f"S{i}"
        rows.append((str(1000 + i), code, f"D{i}", "1", f"{1 + i % 28:02d}/12/2010 08:00", "1.0", str(i % 7), "UK"))
    rows += [rows[0]] * 200  # one row repeated: a third of the batch
    labelled = validate.label_rows(raw_frame(rows), day)
    cleaned = clean.clean_transactions(validate.accepted_rows(labelled))
    s = star.build_star_schema(cleaned)
    assert cleaned.count() == 300
    products = {r.stock_code: r.description for r in s["dim_product"].collect()}
    assert products["HOT"] == "D0"  # earliest day, then invoice
    assert warehouse.fact_partition_rows(None, s["fact_sales"]).count() == 300
