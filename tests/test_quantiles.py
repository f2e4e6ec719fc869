"""Order-preserving keys and exact quantiles against sorted Python lists."""

import math
import random
import struct

from pyspark.sql import functions as F

from portolan.functions.columns import from_order_key, with_order_key
from portolan.operators.quality import numeric_summary
from portolan.operators.quantiles import exact_quantiles


def _bits(x):
    n = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -n if x < 0 else n


def _awkward():
    rng = random.Random(5)
    out = [0.0, -0.0, math.inf, -math.inf, 5e-324, -5e-324, 2.0 ** -1022, 2.0 ** -1023, 1.7976931348623157e308, 1.0]
    for e in range(-1074, 1024, 13):
        p = math.ldexp(1.0, e)
        out += [p, -p, math.nextafter(p, 0), math.nextafter(p, math.inf)]
    out += [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(4000)]
    return [x for x in out if not math.isnan(x)]


def test_keys_are_the_bits_and_turn_back(spark):
    values = _awkward()
    df = spark.createDataFrame([(x,) for x in values], "v double")
    rows = with_order_key(df, "v", "k").withColumn("back", from_order_key("k")).collect()
    assert all(r.k == _bits(r.v) and r.back == r.v for r in rows) and len(rows) == len(values)
    empty = with_order_key(spark.createDataFrame([(None,), (math.nan,)], "v double"), "v", "k").collect()
    assert [r.k for r in empty] == [None, None]


def test_quantiles_equal_a_sort(spark):
    rng = random.Random(9)
    columns = {"any": _awkward(), "ties": [float(rng.randrange(4)) for _ in range(997)],
               "near": [1.0 + rng.randrange(3) * 2.0 ** -52 for _ in range(500)], "one": [-7.25], "none": []}
    n = max(map(len, columns.values()))
    rows = [tuple(v[i] if i < len(v) else (math.nan if i % 2 else None) for v in columns.values()) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r.column_name, r.probability): r.value for r in exact_quantiles(df, list(columns), probabilities).collect()}
    want = {(c, p): sorted(v)[max(math.ceil(p * len(v)), 1) - 1] for c, v in columns.items() if v for p in probabilities}
    assert got == want


def test_summary_of_nulls_nan_and_nothing(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None), (math.nan, math.nan), (None, None)], "a double, b double")
    rows = {r.column_name: r.asDict() for r in numeric_summary(df, ["a", "b"]).collect()}
    assert rows["a"] == {"column_name": "a", "n": 2, "mean": 2.0, "stddev": math.sqrt(2), "min": 1.0, "q25": 1.0,
                         "q50": 1.0, "q75": 3.0, "max": 3.0}
    assert rows["b"] == dict.fromkeys(rows["b"]) | {"column_name": "b", "n": 0}
    assert numeric_summary(df.limit(0), ["a"]).first().n == 0


def test_rounds_read_the_input_once_each(spark):
    plan = exact_quantiles(spark.range(10).select(F.col("id").cast("double").alias("v")), ["v"], [0.5])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Range (0, 10") == 4 and "Sort" not in text
