from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import splits
from quarry.plans.ranks import row_number_global, running_sums

EV = "/root/testdata/sf0.001/events.parquet"


def test_row_number_matches_window(spark):
    df = spark.read.parquet(EV)
    a = row_number_global(df, ["ts", "event_id"], n_buckets=5)
    b = df.withColumn("rn2", F.row_number().over(Window.orderBy("ts", "event_id")) - 1)
    assert a.join(b, "event_id").filter(F.col("rn") != F.col("rn2")).count() == 0


def test_running_sums_partitioned_desc(spark):
    df = spark.read.parquet(EV)
    c = running_sums(df, [("event_id", False)], ["value"], ["event_type"], n_buckets=4)
    d = df.withColumn("cv", F.sum("value").over(Window.partitionBy("event_type").orderBy(F.desc("event_id"))))
    assert c.join(d, "event_id").filter(F.abs(F.col("cum_value") - F.col("cv")) > 1e-9).count() == 0


def test_folds_disjoint_complete_balanced_and_stable(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").select("c_custkey", "c_mktsegment")
    f = splits.kfold(df, 4, "c_custkey", 7, n_buckets=3)
    sizes = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert sum(sizes) == df.count() and max(sizes) - min(sizes) <= 1
    f1 = splits.kfold(df.repartition(1), 4, "c_custkey", 7).select("c_custkey", F.col("fold").alias("f1"))
    f17 = splits.kfold(df.repartition(17), 4, "c_custkey", 7).select("c_custkey", F.col("fold").alias("f17"))
    assert f1.join(f17, "c_custkey").filter("f1 != f17").count() == 0
    s = splits.stratified_kfold(df, "c_mktsegment", 3, "c_custkey", 7)
    per = s.groupBy("c_mktsegment", "fold").count().collect()
    by = {}
    for r in per:
        by.setdefault(r["c_mktsegment"], []).append(r["count"])
    assert all(max(v) - min(v) <= 1 for v in by.values())


def test_stratified_needs_two_classes(spark):
    import pytest
    df = spark.createDataFrame([(i, "a") for i in range(10)], "k int, c string")
    with pytest.raises(ValueError):
        splits.stratified_kfold(df, "c", 2, "k", 1)


def test_sorted_quantiles_equal_percentile(spark):
    from quarry.operators import scaling
    from quarry.plans.quantiles import sorted_quantiles
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    want = df.agg(F.percentile("l_extendedprice", F.array(*[F.lit(p) for p in probs]))).first()[0]
    assert all(abs(a - b) < 1e-9 for a, b in zip(sorted_quantiles(df, "l_extendedprice", probs), want))
    a = scaling.fit_scaler(df, ["l_quantity", "l_extendedprice"], "robust")
    q = df.agg(*[F.percentile(c, F.array(*map(F.lit, (0.25, 0.5, 0.75)))).alias(c) for c in a.center]).first()
    assert all(abs(a.center[c] - q[c][1]) < 1e-9 and abs(a.scale[c] - (q[c][2] - q[c][0])) < 1e-9 for c in a.center)


def test_row_number_within_groups(spark):
    df = spark.read.parquet(EV)
    a = row_number_global(df, ["ts", "event_id"], ["event_type"], n_buckets=4)
    b = df.withColumn("rn2", F.row_number().over(Window.partitionBy("event_type").orderBy("ts", "event_id")) - 1)
    assert a.join(b, "event_id").filter(F.col("rn") != F.col("rn2")).count() == 0


def _quantiles_by_hand(rows, probs):
    import math
    groups = {}
    for g, x in rows:
        if x is not None and not math.isnan(x):
            groups.setdefault(g, []).append(x)
    out = {}
    for g, xs in groups.items():
        xs.sort()
        at = [p * (len(xs) - 1) for p in probs]
        lo = [xs[math.floor(a)] for a in at]
        hi = [xs[math.ceil(a)] for a in at]
        out[g] = [a if a == b else a + (b - a) * (t - math.floor(t)) for a, b, t in zip(lo, hi, at)]
    return out


def test_quantiles_by_narrowing(spark, monkeypatch):
    """Any numbers, any group names, ties, nulls, NaN and infinities; with narrowing and shuffled joins forced."""
    import math
    import random

    from quarry.plans import quantiles
    rng = random.Random(4)
    inf = float("inf")
    rows = [(None, rng.gauss(0, 1)) for _ in range(500)] + [("a", rng.choice([0.0, -0.0, 1.0, 1.0000001, 30.0])) for _ in range(700)]
    rows += [("wide", s * 2.0 ** rng.uniform(-1074, 1023)) for _ in range(300) for s in (1, -1)] + [("wide", 0.0)]
    rows += [("edge", x) for x in (1.7976931348623157e308, 8.98846567431158e307, 4.9e-324, 2.0, math.nextafter(2.0, 0), -2.0, 0.0, 1e308)]
    rows += [("inf", x) for x in (inf, -inf, 1.0, 2.0, inf)] + [("one", 5.0), ("none", None), ("none", float("nan"))]
    rows += [("near", 1.0 + rng.randint(0, 40) * 2.0 ** -52) for _ in range(900)] + [("int", float(rng.randint(1, 50))) for _ in range(900)]
    df = spark.createDataFrame(rows, "b0 string, x double").repartition(4)
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    want = _quantiles_by_hand(rows, probs)

    def same(a, b):
        return a == b or (math.isnan(a) and math.isnan(b)) or abs(a - b) <= 1e-12 * max(abs(a), abs(b))

    for few, bins in ((1 << 16, 200_000), (3, 200_000), (3, 0)):
        monkeypatch.setattr(quantiles, "SORTED_ROWS", few)
        monkeypatch.setattr(quantiles, "BROADCAST_BINS", bins)
        got = {r["b0"]: r["k0"] for r in quantiles.group_quantiles(df, "x", ["b0"], probs, "k0").collect()}
        assert got.keys() == want.keys()
        for g, qs in want.items():
            assert all(map(same, got[g], qs)), (few, g, got[g], qs)
    every = quantiles.sorted_quantiles(df.filter("b0 = 'int'"), "x", [0.5])
    assert every == _quantiles_by_hand([(0, x) for g, x in rows if g == "int"], [0.5])[0]
    assert quantiles.sorted_quantiles(df.filter("b0 = 'none'"), "x", [0.5, 1.0]) == [None, None]


def test_describe_groups_any_group_name(spark):
    from quarry.operators import stattests
    for name in ("_n", "_q", "quartiles", "x", "n_"):
        df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0)], f"`{name}` string, value double")
        got = {r[name]: (r["n"], r["median"]) for r in stattests.describe_groups(df, "value", name).collect()}
        assert got == {"a": (2, 2.0), None: (1, 5.0)}
