import os

import numpy as np
from pyspark.sql import functions as F

from geokernel.operators import fit, neighbours, tables


def tables_in(spark):
    return set(os.listdir(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))) if os.path.isdir(spark.conf.get("spark.checkpoint.dir").removeprefix("file://")) else set()


def cloud(spark, p):
    return spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(p)], "id long, x double, y double, z double")


def test_rounds_of_a_registration_leave_no_tables(spark, monkeypatch):
    p = np.random.default_rng(2).uniform(0, 20, (400, 3))
    before, seen, found = tables_in(spark), [], fit.nearest

    def counted(*args, **kwargs):
        seen.append(len(tables_in(spark) - before))
        return found(*args, **kwargs)

    monkeypatch.setattr(fit, "nearest", counted)
    r, t, history = fit.registered(cloud(spark, p + [0.05, -0.04, 0.03]), cloud(spark, p), rounds=4)
    assert np.allclose(t + r @ [0.05, -0.04, 0.03], 0, atol=1e-6) and np.allclose(r, np.eye(3), atol=1e-6)
    assert len(history) > 1 and max(seen) == min(seen)
    assert tables_in(spark) == before


def test_columns_of_queries_go_along(spark):
    rng = np.random.default_rng(3)
    q, p = cloud(spark, rng.uniform(0, 9, (50, 3))), cloud(spark, rng.uniform(0, 9, (200, 3)))
    got = neighbours.nearest(q.withColumn("lx", F.col("x")), p.withColumn("wx", F.col("x")), payload=("wx",), carried=("lx",))
    x, w = ({r["id"]: r["x"] for r in df.collect()} for df in (q, p))
    rows = got.collect()
    assert len(rows) == 50 and all(r["lx"] == x[r["id"]] and r["wx"] == w[r["other"]] for r in rows)


def test_scratch_blocks_may_lie_in_one_another(spark):
    before = tables_in(spark)
    with tables.scratch(spark):
        outer = tables.written(spark.range(5), "outer")
        with tables.scratch(spark):
            assert tables.written(spark.range(7), "inner").count() == 7
        assert outer.count() == 5
    assert tables_in(spark) == before
