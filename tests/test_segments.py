import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from prefspark.operators import segments


def _data(spark):
    rnd = random.Random(3)
    rows = [(1, t * 3 + rnd.randint(0, 2), f"a{t}") for t in range(200)]
    rows += [(2, t, f"b{t}") for t in range(5)] + [(3, 0, "c")]
    rows += [(4, t * 100, None if t % 7 == 0 else f"d{t}") for t in range(60)]
    return spark.createDataFrame(rows, "g long, k long, v string")


@pytest.mark.parametrize("offset", [1, -1])
def test_shift_within_equals_window(spark, offset):
    df = _data(spark)
    got = segments.shift_within(df, "g", "k", ["v", "k"], offset, ["sv", "sk"], part_size=16)
    w = Window.partitionBy("g").orderBy("k")
    f = F.lag if offset == 1 else F.lead
    ref = df.select("*", f("v").over(w).alias("sv"), f("k").over(w).alias("sk"))
    key = lambda r: (r.g, r.k)
    assert sorted(got.collect(), key=key) == sorted(ref.collect(), key=key)


def test_hot_parts_bounded(spark):
    parts = segments.hot_parts(_data(spark), "g", "k", part_size=16)
    sizes = {(r.g, r.part): r["count"] for r in parts.groupBy("g", "part").count().collect()}
    assert max(n for (g, _), n in sizes.items() if g == 1) <= 32
    assert {p for (g, p) in sizes if g in (2, 3)} == {0}
