"""Lost work is redone: with a task that fails on its first attempt (as when an executor is
lost), landing counts and silver accounting stay exact. Runs in its own process because
retries need a ``local[n, maxFailures]`` master."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent("""
    import os, sys, tempfile, json
    sys.path.insert(0, REPO)
    import pandas as pd
    from pyspark import TaskContext
    from quarry.session import get_spark, ensure_databases
    from quarry.operators.landing import land
    from quarry.plans import analogues as A
    from quarry.plans.silver import accounting, classify

    root = tempfile.mkdtemp()
    spark = get_spark("local[4,3]", 4, extra={"spark.sql.warehouse.dir": root + "/wh",
                                               "spark.checkpoint.dir": root + "/ck"})
    ensure_databases(spark)

    def flaky(batches):
        ctx = TaskContext.get()
        if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
            raise RuntimeError("simulated loss of an executor")
        for b in batches:
            yield b

    src = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").repartition(4)
    src = src.union(src.limit(100))                      # 100 exact copies inside the batch
    flaky_src = src.mapInPandas(flaky, src.schema)
    first = land(spark, flaky_src, "orders", "bronze.orders")
    again = land(spark, flaky_src, "orders", "bronze.orders")

    bronze = A.orders_bronze(spark, "/root/testdata/sf0.001")
    flaky_bronze = bronze.repartition(4).mapInPandas(flaky, bronze.schema)
    acc = accounting(classify(flaky_bronze, A.ORDERS, A.ORDERS_AS_OF)).first().asDict()
    ref = accounting(classify(bronze, A.ORDERS, A.ORDERS_AS_OF)).first().asDict()
    print(json.dumps({"first": [first.rows_received, first.rows_inserted, first.rows_skipped],
                      "again": [again.rows_received, again.rows_inserted],
                      "rows": spark.table("bronze.orders").count(), "acc": acc, "ref": ref,
                      "n": src.count()}))
""").replace("REPO", repr(REPO))


def test_counts_stay_exact_when_tasks_are_retried():
    import json
    out = subprocess.run([sys.executable, "-c", SCRIPT], capture_output=True, text=True, timeout=600)
    line = [x for x in out.stdout.splitlines() if x.startswith("{")]
    assert line, out.stderr[-3000:]
    assert "simulated loss of an executor" in out.stderr     # the failure really happened
    r = json.loads(line[-1])
    n = r["n"]
    assert r["first"] == [n, n - 100, 100]
    assert r["again"] == [n, 0]
    assert r["rows"] == n - 100
    assert r["acc"] == r["ref"]
