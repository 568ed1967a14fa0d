"""Plans of the log jobs: generated methods that the JIT compiles, pruned columns, no shuffle and no Python where none is needed."""

import pytest
from pyspark.sql import functions as F

from traffic_signals import catalog
from traffic_signals.plans.jobs import nginx_to_observations
from traffic_signals.sources.nginx import parse_nginx

#: HotSpot leaves methods of more bytes to the interpreter.
JIT_LIMIT = 8000


def method_sizes(spark, df):
    plan = df._jdf.queryExecution().executedPlan()
    parts = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$").codegenStringSeq(plan)
    return [parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())]


@pytest.fixture
def plain(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("name", ["nginx_common_parse", "nginx_json_parse", "nginx_auto_dead_letter", "provider_bucket_rollup", "cloudfront_parse", "observe_cloudflare", "observe_vercel", "url_forms", "validate_event_records", "delivery_job", "nginx_repeated_keys"])
def test_generated_methods_are_compiled(plain, data, name):
    assert 0 < max(method_sizes(plain, catalog.QUERIES[name](plain, data))) <= JIT_LIMIT


def test_jobs_on_lines_are_narrow(plain):
    lines = plain.range(10).select(F.col("id").cast("string").alias("value"))
    plan = nginx_to_observations(lines)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan and "ArrowEval" not in plan


def test_unasked_columns_are_not_computed(plain):
    lines = plain.range(10).select(F.col("id").cast("string").alias("value"))
    some = parse_nginx(lines, columns=["observed_at", "path"])
    assert some.columns == ["value", "error", "observed_at", "path"]
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert "body_bytes_sent" not in plan and "http_user_agent" not in plan and "body_bytes_sent" in parse_nginx(lines)._jdf.queryExecution().optimizedPlan().toString()
