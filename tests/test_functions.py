"""Scalar functions: names, URLs, errors, backoff and text formats."""

from pyspark.sql import functions as F

from ndflow.functions import scalars as X


def one(spark, col_fn, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(col_fn(F.col("v"))).collect()]


def test_url_to_name(spark):
    urls = ["https://h/a/b.ndjson", "https://h/a/Patient", "https://h/x/y.NDJSON", "", "///", "https://h/p?q=1"]
    assert one(spark, X.url_to_name, urls) == ["b.ndjson", "Patient.ndjson", "y.NDJSON", "download.ndjson",
                                              "download.ndjson", "p?q=1.ndjson"]
    assert one(spark, lambda c: X.url_to_name(c, strip_query=True), ["https://h/p?q=1"]) == ["p.ndjson"]


def test_absolute_url(spark):
    base = "https://api.example.org:8443"
    got = one(spark, lambda c: X.absolute_url(c, base),
              ["/fhir/result/1.ndjson", "http://torch:8080/r/2?x=1#f", "https://localhost/a", "https://ext.org/z"])
    assert got == [base + "/fhir/result/1.ndjson", base + "/r/2?x=1", base + "/a", "https://ext.org/z"]


def test_network_error_parity_and_classes(spark):
    msgs = ["dial tcp: Connection Refused", "geofence failed", "no space left on device", "Permission denied", "boom"]
    assert one(spark, X.is_network_error, msgs) == [True, True, False, False, False]
    assert one(spark, lambda c: X.is_network_error(c, word_boundary=True), ["geofence failed"]) == [False]
    cats = one(spark, lambda c: X.classify_error(c)["category"], msgs)
    assert cats == ["network", "network", "filesystem", "filesystem", "validation"]


def test_transient_status_and_backoff(spark):
    assert one(spark, X.is_transient_status, [500, 599, 600, 408, 429, 404, 200], "int") == \
        [True, True, False, True, True, False, False]
    assert one(spark, lambda c: X.backoff_ms(c, 1000, 30000), [-1, 0, 1, 4, 5, 10], "int") == \
        [1000, 1000, 2000, 16000, 30000, 30000]


def test_format_bytes(spark):
    vals = [0, 1023, 1024, 1536, 5 * 1024 ** 2, 3 * 1024 ** 3, 2 * 1024 ** 4]
    assert one(spark, X.format_bytes, vals, "long") == ["0 B", "1023 B", "1.00 KB", "1.50 KB", "5.00 MB",
                                                         "3.00 GB", "2.00 TB"]
    assert one(spark, lambda c: X.format_bytes(c, with_tb=False), [2 * 1024 ** 4], "long") == ["2048.00 GB"]


def test_durations(spark):
    us = [0, 150_400, 999_600, 1_500_000, 61_000_000, 3_723_000_000, 90_000_000_000]
    assert one(spark, X.format_duration, us, "long") == ["0s", "150ms", "1s", "2s", "1m1s", "1h2m3s", "25h0m0s"]
    assert one(spark, X.format_eta, us, "long") == ["< 1s", "< 1s", "< 1s", "2s", "1m1s", "1h2m", "25h0m"]
    assert one(spark, X.format_age, us, "long") == ["0s", "0s", "0s", "1s", "1m", "1h", "1d"]


def test_rates_and_symbols(spark):
    assert one(spark, X.format_items_rate, [0.001, 2.3456], "double") == ["< 0.01 items/sec", "2.35 items/sec"]
    assert one(spark, X.format_bytes_rate, [10.4, 2048.0, 5 * 1024.0 ** 2], "double") == \
        ["10 B/sec", "2.00 KB/sec", "5.00 MB/sec"]
    assert one(spark, X.status_symbol, ["completed", "pending", "x"]) == ["✓", "○", " "]
    assert one(spark, lambda c: X.status_symbol(c, for_job=False), ["pending"]) == [" "]


def test_internal_hosts_are_compared_as_written(spark):
    from ndflow.functions.scalars import absolute_url
    cases = {"http://torch:8080/a?x=1": "https://h:1/a?x=1", "http://user:pw@torch/a": "https://h:1/a", "http://Torch/a": "http://Torch/a", "http://torch.org/a": "http://torch.org/a",
             "/a": "https://h:1/a", "http://h2/u@torch": "http://h2/u@torch"}
    df = spark.createDataFrame([(k,) for k in cases], "u string")
    assert {r.u: r.a for r in df.select("u", absolute_url(df["u"], "https://h:1").alias("a")).collect()} == cases
