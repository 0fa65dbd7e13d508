"""A line of so many MiB through scan, parse, sinks and the flow; run by
``test_strict_flow`` in a process of its own with 6 GB of heap."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from ndflow.operators import bundle as B  # noqa: E402
from ndflow.operators.flatten import PATIENT_PATHS, flatten  # noqa: E402
from ndflow.plans.flow import plan_flow, run_directory  # noqa: E402
from ndflow.session import get_spark  # noqa: E402
from ndflow.sinks.files import write_ndjson  # noqa: E402
from ndflow.sources import ndjson as N  # noqa: E402


def big(n):
    return json.dumps({"id": "big", "resourceType": "Patient", "gender": "male", "note2": "x" * n, "address": [{"country": "DE"}]}, separators=(",", ":"))


def main(mib, folder):
    spark = get_spark("local[1]", shuffle_partitions=2, extra={"spark.ui.showConsoleProgress": "false"})
    value = big(mib << 20)
    os.makedirs(folder + "/in")
    with open(folder + "/in/Patient.ndjson", "w") as f:
        f.write(value + "\n" + '{"resourceType":"Patient","id":"2","gender":"female"}\n')
    lines = N.read_ndjson(spark, folder + "/in")
    assert sorted(r.status for r in N.parse_lines(lines).select("status").collect()) == ["ok", "ok"]
    write_ndjson(lines, folder + "/out")
    assert sorted(spark.read.text(folder + "/out").select(F.length("value")).toPandas().iloc[:, 0]) == [53, len(value)]
    assert {tuple(r) for r in flatten(lines, PATIENT_PATHS, "Patient").select("id", "gender", "country").collect()} == {("big", "male", "DE"), ("2", "female", None)}
    assert B.oversized_resources(N.parse_lines(lines), 1000).select("size").first().size == len(value)
    rules = {"*": {"note2": "keep"}}  # without a rule the field goes
    out = plan_flow(lines, "k", 1 << 30, rules=rules)["deidentified"]
    got = {r.n: r.g for r in out.select(F.length("value").alias("n"), F.get_json_object("value", "$.gender").alias("g")).collect()}
    assert sorted(got.values()) == ["female", "male"] and max(got) > mib << 20
    doc = spark.createDataFrame([('{"id":"b","type":"t","entry":[' + value + "]}",)], "v string") if mib <= 30 else None
    assert doc is None or doc.select(B.bundle_structure(F.col("v"))).first()[0] is None
    paths = run_directory(spark, folder + "/in", "k", 1 << 30, folder + "/flow", rules=rules)
    assert sorted(n > mib << 20 for (n,) in spark.read.text(paths["ndjson"]).select(F.length("value")).collect()) == [False, True]
    spark.stop()
    print("fine")


if __name__ == "__main__":
    main(int(sys.argv[1]), sys.argv[2])
