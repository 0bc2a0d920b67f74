"""Encoders (P11-P15, P16 for codes).

The categories of all columns are one table (column, category, code, name), made by
one distributed sort, whatever their number. Codes are joined to the rows and back;
the table is sent to every task where its measured bytes allow, and joined by a
shuffle beyond. Indicators come either as one column for each category (``wide``)
or, for any number of categories, as one column of indices and values (``sparse``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.cleaning import NAN_CATEGORY
from quarry.plans.quantiles import fresh_name
from quarry.plans.ranks import row_number_global
from quarry.session import cut_lineage

ENCODERS = ("label", "one_hot", "binarize", "multi_label")
DEFAULT_ENCODER = "label"
LAYOUTS = ("wide", "sparse")
#: Bytes of a column's categories up to which they are sent to every task.
BROADCAST_BYTES = 32 << 20
#: Indicator columns of the wide layout; Spark can't plan many more, the sparse layout holds any number.
MAX_WIDE = 10_000


@dataclass
class EncoderState:
    method: str
    columns: list = field(default_factory=list)
    nan_category: str = NAN_CATEGORY
    layout: str = "wide"
    dictionary: DataFrame | None = None            # (column, category, code, name), codes by sorted category
    sizes: dict = field(default_factory=dict)      # column -> (categories, bytes of them)
    nan_codes: dict = field(default_factory=dict)  # column -> code of nan_category, where it was seen
    shown: dict = field(default_factory=dict)      # wide: column -> [(category, name)] by code

    def codes(self, column: str, category: str, code: str) -> DataFrame:
        """(category, code) of a column under these names, marked for a broadcast where it is small."""
        t = self.dictionary.filter(F.col("column") == column).select(F.col("category").alias(category), F.col("code").alias(code))
        return F.broadcast(t) if self.sizes.get(column, (0, 0))[1] <= BROADCAST_BYTES else t

    def names(self) -> DataFrame:
        """(column, code, category, name): what each index of the sparse layout, or each wide column, stands for."""
        return self.dictionary.select("column", "code", "category", "name")


def fit_encoder(df: DataFrame, cols: Sequence[str], method: str = DEFAULT_ENCODER, nan_category: str = NAN_CATEGORY,
                layout: str = "wide") -> EncoderState:
    """Categories of ``cols`` as text, without nulls; codes follow their sorted order."""
    if method not in ENCODERS:
        raise ValueError(f"unknown encoder {method!r}; expected one of {ENCODERS}")
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}; expected one of {LAYOUTS}")
    cols = list(cols)
    spark = df.sparkSession
    if not cols:
        return _state(spark.createDataFrame([], "column string, category string, code int, name string"), method, cols, nan_category, layout)
    if method == "multi_label":
        values = [F.transform(F.col(f"`{c}`"), lambda x: x.cast("string")) for c in cols]
    else:
        values = [F.array(F.col(f"`{c}`").cast("string")) for c in cols]
    each = F.array(*[F.struct(F.lit(c).alias("column"), v.alias("values")) for c, v in zip(cols, values)])
    found = (df.select(F.explode(each).alias("e")).select("e.column", F.explode("e.values").alias("category"))
             .filter(F.col("category").isNotNull()).distinct())
    numbered = row_number_global(found, ["category"], ["column"], out="code").select(
        "column", "category", F.col("code").cast("int").alias("code"))
    named = numbered.withColumn("name", F.lit(None).cast("string")) if method == "label" else _named(numbered, df.columns)
    return _state(cut_lineage(named), method, cols, nan_category, layout)


def _named(numbered: DataFrame, taken: Sequence[str]) -> DataFrame:
    """A name for each category's indicator: column_category with signs as underscores; where that is taken by
    another category (which has the name: the first) or a column of the table, the code is appended."""
    plain = F.concat("column", F.lit("_"), F.regexp_replace("category", r"[^\p{L}\p{N}_]", "_"))
    rows = numbered.withColumn("name", plain)
    while True:
        rows = cut_lineage(rows)
        double = (rows.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("column", "code")).alias("first"))
                  .withColumn("free", ~F.col("name").isin(*taken)).filter("n > 1 OR NOT free"))
        if double.isEmpty():
            return rows
        stays = F.col("n").isNull() | (F.col("free") & (F.struct("column", "code") == F.col("first")))
        rows = rows.join(double, "name", "left").select("column", "category", "code", F.when(stays, F.col("name")).otherwise(
            F.concat("name", F.lit("__"), F.col("code").cast("string"))).alias("name"))


def _state(dictionary: DataFrame, method: str, cols: list, nan_category: str, layout: str) -> EncoderState:
    st = EncoderState(method, cols, nan_category, layout, dictionary)
    stats = st.dictionary.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("category") + 16).alias("bytes"),
        F.max(F.when(F.col("category") == nan_category, F.col("code"))).alias("nan")).collect()  # one row per column
    st.sizes = {r["column"]: (r["n"], r["bytes"]) for r in stats}
    st.nan_codes = {r["column"]: r["nan"] for r in stats if r["nan"] is not None}
    if method != "label" and layout == "wide":
        for c, (n, _) in st.sizes.items():
            if n > MAX_WIDE:
                raise ValueError(f"column {c} has {n} categories: too many for one column each; use layout='sparse'")
        st.shown = {c: [] for c in cols}
        for r in st.dictionary.orderBy("column", "code").collect():  # what become column names
            st.shown[r["column"]].append((r["category"], r["name"]))
    return st


def _coded(df: DataFrame, st: EncoderState, c: str, out: str, unseen: str) -> DataFrame:
    """``df`` with the code of column ``c``: null for null; a category that the fit didn't see becomes that of
    ``nan_category`` or raises."""
    text = F.col(f"`{c}`").cast("string")
    key = fresh_name([*df.columns, out], "category")
    fallback = (F.lit(st.nan_codes[c]) if unseen == "unknown" and c in st.nan_codes
                else F.raise_error(F.concat(F.lit(f"unseen category in {c}: "), text)).cast("int"))
    joined = df.join(st.codes(c, key, out), text == F.col(key), "left")
    code = F.when(text.isNull(), F.lit(None).cast("int")).otherwise(F.coalesce(F.col(out), fallback))
    return joined.drop(key).withColumn(out, code)


def _coded_sets(df: DataFrame, st: EncoderState, c: str, out: str) -> DataFrame:
    """``df`` with the sorted codes of an array column's categories; unseen ones are left out, null gives none.
    Each different array is looked up once."""
    texts = F.array_sort(F.array_distinct(F.transform(F.coalesce(F.col(f"`{c}`"), F.array().cast(df.schema[c].dataType)), lambda x: x.cast("string"))))
    key, one, code = (fresh_name([*df.columns, out], n) for n in ("categories", "category", "code"))
    given = df.withColumn(key, texts)
    codes = st.codes(c, one + "_", code)
    sets = (given.select(key).distinct().select(key, F.explode(key).alias(one))
            .join(codes, F.col(one) == F.col(one + "_")).groupBy(key).agg(F.array_sort(F.collect_list(code)).alias(out)))
    return given.join(sets, key, "left").drop(key).withColumn(out, F.coalesce(F.col(out), F.array().cast("array<int>")))


def _sparse(size: int, indices: Column) -> Column:
    return F.struct(F.lit(size).alias("size"), indices.alias("indices"), F.transform(indices, lambda _: F.lit(1.0)).alias("values"))


def _shown(st: EncoderState, c: str) -> list:
    """(code, category, name) of the wide columns: of a binarized pair the second only."""
    rows = [(i, v, n) for i, (v, n) in enumerate(st.shown[c])]
    return rows[1:] if st.method == "binarize" and len(rows) == 2 else rows


def transform(df: DataFrame, st: EncoderState, unseen: str = "unknown") -> DataFrame:
    """Apply the fitted encoder. ``unseen='unknown'`` maps categories not seen in
    fit to the code of ``nan_category`` when that category was seen in fit,
    and raises otherwise; ``unseen='error'`` always raises (P15). Multi-label arrays
    leave unseen categories out.

    Label: the column holds its code. Wide: indicator columns in its place. Sparse: a
    struct of ``size``, ``indices`` (codes) and ``values`` in its place."""
    order, made = df.columns, {}
    for c in [c for c in order if c in st.columns]:
        out = made[c] = fresh_name([*df.columns, *order], f"code_{c}")
        df = _coded_sets(df, st, c, out) if st.method == "multi_label" else _coded(df, st, c, out, unseen)
    cols = []
    for c in order:
        if c not in made:
            cols.append(F.col(f"`{c}`"))
            continue
        code = F.col(f"`{made[c]}`")
        if st.method == "label":
            cols.append(code.alias(c))
        elif st.layout == "sparse":
            indices = code if st.method == "multi_label" else F.when(code.isNull(), F.array().cast("array<int>")).otherwise(F.array(code))
            cols.append(_sparse(st.sizes.get(c, (0, 0))[0], indices).alias(c))
        elif st.method == "multi_label":
            cols += [F.array_contains(code, i).cast("int").alias(n) for i, _, n in _shown(st, c)]
        else:
            cols += [(code == i).cast("int").alias(n) for i, _, n in _shown(st, c)]
    return df.select(*cols)


def _decoded(df: DataFrame, st: EncoderState, c: str, code: Column, out: str) -> DataFrame:
    """``df`` with the category of ``code``."""
    key = fresh_name([*df.columns, out], "code")
    return df.join(st.codes(c, out, key), code.cast("int") == F.col(key), "left").drop(key)


def inverse_transform(df: DataFrame, st: EncoderState, cols: Sequence[str] | None = None) -> DataFrame:
    """Codes back to categories; indicators, wide or sparse, back to their category
    (one-hot, binarized) or to the array of categories (multi-label)."""
    wanted = [c for c in (cols or st.columns) if c in st.columns]
    if st.method != "label" and st.layout == "wide":
        used, made = set(), {}
        for c in wanted:
            rows = _shown(st, c)
            used |= {n for _, _, n in rows}
            if st.method == "multi_label":
                made[c] = F.filter(F.array(*[F.when(F.col(f"`{n}`") == 1, F.lit(v)) for _, v, n in rows]), lambda x: x.isNotNull())
            elif len(rows) < len(st.shown[c]):
                only = F.col(f"`{rows[0][2]}`")
                made[c] = F.when(only == 1, F.lit(rows[0][1])).when(only == 0, F.lit(st.shown[c][0][0]))
            else:
                made[c] = F.coalesce(*[F.when(F.col(f"`{n}`") == 1, F.lit(v)) for _, v, n in rows], F.lit(None).cast("string"))
        return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in used and c not in made], *[e.alias(c) for c, e in made.items()])
    order, made = df.columns, {}
    for c in [c for c in wanted if c in df.columns]:
        out = made[c] = fresh_name([*df.columns, *order], f"category_{c}")
        if st.method == "label":
            df = _decoded(df, st, c, F.col(f"`{c}`"), out)
        elif st.method == "multi_label":
            key, i, v = (fresh_name([*df.columns, out], n) for n in ("indices", "index", "value"))
            given = df.withColumn(key, F.col(f"`{c}`.indices"))
            sets = _decoded(given.select(key).distinct().select(key, F.explode(key).alias(i)), st, c, F.col(i), v)
            sets = sets.groupBy(key).agg(F.array_sort(F.collect_list(v)).alias(out))
            df = given.join(sets, key, "left").drop(key).withColumn(out, F.coalesce(F.col(f"`{out}`"), F.array().cast("array<string>")))
        else:
            df = _decoded(df, st, c, F.get(F.col(f"`{c}`.indices"), F.lit(0)), out)
    return df.select(*[F.col(f"`{made[c]}`").alias(c) if c in made else F.col(f"`{c}`") for c in order])


def encoder_table(spark, st: EncoderState) -> DataFrame:
    """The state as rows: column, method, layout, code, category, name."""
    return st.dictionary.select("column", F.lit(st.method).alias("method"), F.lit(st.layout).alias("layout"), "code", "category", "name")


def encoder_from_table(table: DataFrame, method: str, nan_category: str, columns: Sequence[str] | None = None,
                       layout: str = "wide") -> EncoderState:
    cols = list(columns) if columns is not None else sorted(r[0] for r in table.select("column").distinct().collect())
    return _state(table.select("column", "category", "code", "name"), method, cols, nan_category, layout)
