import math

from pyspark.sql import functions as F

from quarry.operators import encoding, metrics
from quarry.operators.relief import relief_weights


def test_label_codes_by_broadcast_and_by_shuffle(spark, monkeypatch):
    rows = [(i, None if i % 50 == 0 else f"c{i * 7 % 40}", "x") for i in range(200)] + [(200, "NaN", "x")]
    df = spark.createDataFrame(rows, "id long, c string, d string")
    st = encoding.fit_encoder(df, ["c", "d"], "label", "NaN")
    codes = {v: i for i, v in enumerate(sorted({r[1] for r in rows if r[1]}))}
    want = {i: (codes.get(c), 0) for i, c, _ in rows}
    new = spark.createDataFrame([(1, "unseen", "x"), (2, None, "x"), (3, "c1", "x")], df.schema)
    seen = lambda st, d: {r.id: (r.c, r.d) for r in encoding.transform(d, st).collect()}
    for limit in (encoding.BROADCAST_BYTES, -1):
        monkeypatch.setattr(encoding, "BROADCAST_BYTES", limit)
        assert seen(st, df) == want
        assert seen(st, new) == {1: (codes["NaN"], 0), 2: (None, 0), 3: (codes["c1"], 0)}
        back = encoding.inverse_transform(encoding.transform(df, st), st)
        assert back.columns == df.columns and sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
    again = encoding.encoder_from_table(encoding.encoder_table(spark, st), "label", "NaN")
    assert seen(again, df) == want


def test_names_do_not_clash(spark):
    rows = [(0, "a-b"), (1, "a_b"), (2, "a b"), (3, "a_b__1"), (4, "é"), (5, None)]
    df = spark.createDataFrame([(*r, 7) for r in rows], "id long, c string, `c_é` int")
    st = encoding.fit_encoder(df, ["c"], "one_hot")
    out = encoding.transform(df, st)
    assert len(set(out.columns)) == len(out.columns) == 2 + 5
    back = encoding.inverse_transform(out, st)
    assert {(r.id, r.c) for r in back.collect()} == set(rows)
    many = spark.createDataFrame([(0, ["a-b", "a_b"]), (1, None), (2, []), (3, ["a b", "a b", None])], "id long, c array<string>")
    for layout in encoding.LAYOUTS:
        st = encoding.fit_encoder(many, ["c"], "multi_label", layout=layout)
        got = {r.id: r.c for r in encoding.inverse_transform(encoding.transform(many, st), st).collect()}
        assert got == {0: ["a-b", "a_b"], 1: [], 2: [], 3: ["a b"]}


def test_sparse_indicators(spark):
    """Any number of categories: indices by a names table, back to the categories, equal to the wide columns."""
    df = spark.range(30_050).select(F.col("id"), F.format_string("c%06d", "id").alias("c"), (F.col("id") % 2).alias("two"))
    df = df.withColumn("c", F.when(F.col("id") != 5, F.col("c")))
    for method in ("one_hot", "binarize"):
        st = encoding.fit_encoder(df, ["c", "two"], method, layout="sparse")
        out = encoding.transform(df, st)
        row = out.filter("id = 7").first()
        assert row.c.size == 30_049 and row.c["values"] == [1.0] and out.filter("id = 5").first().c.indices == []
        name = st.names().filter((F.col("column") == "c") & (F.col("code") == row.c.indices[0])).first()
        assert (name.category, name["name"]) == ("c000007", "c_c000007")
        back = encoding.inverse_transform(out, st)
        assert back.select("id", "c", "two").exceptAll(df.withColumn("two", F.col("two").cast("string"))).count() == 0 and back.count() == 30_050
    few = df.filter("id < 20").select("id", F.array(F.concat(F.lit("k"), F.col("id") % 7), F.lit("z")).alias("c"))
    wide, sparse = (encoding.fit_encoder(few, ["c"], "multi_label", layout=x) for x in encoding.LAYOUTS)
    names = {r.code: r["name"] for r in sparse.names().collect()}
    indices = {r.id: {names[i] for i in r.c.indices} for r in encoding.transform(few, sparse).collect()}
    assert indices == {r["id"]: {c for c, v in r.asDict().items() if c != "id" and v} for r in encoding.transform(few, wide).collect()}


def test_more_than_the_old_caps(spark):
    df = spark.range(100_050).select(F.col("id"), F.format_string("c%06d", "id").alias("c"))
    st = encoding.fit_encoder(df, ["c"], "label")
    out = encoding.transform(df, st)
    assert out.filter(F.col("c") != F.col("id")).count() == 0 and out.count() == 100_050
    assert encoding.inverse_transform(out, st).join(df, ["id", "c"]).count() == 100_050


def test_many_classes(spark, monkeypatch):
    df = spark.createDataFrame([(f"k{i % 5}", [0.1 * (1 + (i + j) % 5) for j in range(5)]) for i in range(40)], "y string, p array<double>")
    value = lambda: [f(df, "y", "p").first().value for f in (metrics.log_loss, metrics.roc_auc_ovr)]
    few = value()
    monkeypatch.setattr(metrics, "MAX_CLASSES", 3)
    assert all(math.isclose(a, b, abs_tol=1e-12) for a, b in zip(few, value()))


def test_relief_of_named_targets(spark):
    rows = [(i, "abc"[i % 3], i % 3, (i * 37 % 101) / 7 + i % 3, (i * 53 % 97) / 9) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, name string, y int, a double, b double")
    a, b = ({r.feature: round(r.weight, 9) for r in relief_weights(df, ["a", "b"], t, "id", k=3).collect()} for t in ("name", "y"))
    assert a == b
