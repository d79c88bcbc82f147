"""Questions and the report read the published result set, not the fact."""
import uuid

import pytest

from tillcast import jobs
from tillcast.plans import catalog, report, serving
from tillcast.plans.context import Tables
from tillcast.session import checkpoint_dir
from tillcast.sources import testdata

SF = "/root/testdata/sf0.001"
NAMES = ["sales_forecast_results", "sales_anomaly_results", "primary_category_anomaly_results", "category_anomaly_results",
         "forecastable_categories"]


def test_views_read_the_published_set(spark):
    root = f"{checkpoint_dir(spark)}/test-serving-{uuid.uuid4().hex}"
    given = dict(locations=testdata.locations(spark, SF), weather=testdata.local_weather(spark, SF),
                 local_events=testdata.local_events(spark, SF), forecast_weather=testdata.weather_forecast(spark, SF))
    fact = testdata.item_sales(spark, SF)
    t = Tables(spark, as_of=testdata.AS_OF, fact=fact, root=root, **given)
    with pytest.raises(ValueError):
        serving.sales_forecast(t)          # a given root is only read: nothing is published on demand
    assert all(jobs.refresh(t, root, "2001-08-02 06:00:00", only=NAMES).values())

    # the same answers from tables whose fact is gone
    empty = Tables(spark, as_of=testdata.AS_OF, fact=fact.where("false"), root=root, **given)
    assert {r["count"] for r in serving.sales_forecast(empty).groupBy("location").count().collect()} == {14}
    spikes = catalog.anomalies_since(serving.category_anomalies(empty), testdata.AS_OF, days=30)
    plan = spikes._jdf.queryExecution().toString()
    assert "lineitem" not in plan and "PushedFilters: [IsNotNull(is_anomaly), IsNotNull(report_date)" in plan
    one_day = report.day_anomalies(serving.category_anomalies(empty), "2000-06-15")
    derived = Tables(spark, SF)
    assert sorted(map(str, one_day.collect())) == sorted(map(str, report.day_anomalies(serving.category_anomalies(derived), "2000-06-15").collect()))
    assert sorted(map(str, serving.sales_anomalies(empty).collect())) == sorted(map(str, serving.sales_anomalies(derived).collect()))
