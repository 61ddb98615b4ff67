"""Encoding and scaling (survey §2.4, E1-E12).

Dictionaries (category -> code) are fitted by one grouped aggregate.  Up to
``MAX_LITERAL_CATEGORIES`` values of a column are replayed as a literal map
inside one projection; wider columns keep their dictionary as a stored table
(value, code), ranked slice-wise, and are replayed by a join that Spark sizes
itself.  Only small dictionaries ever reach the driver.  Scalers fit one wide
aggregate (or the exact-quantile job for the robust scaler) and transform
with literals.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentio.plans.ordering import quantile_row, row_index
from retentio.session import cut_lineage

MAX_LITERAL_CATEGORIES = 1_000

# Spellings read as the positive / negative class of a binary column.
POSITIVE_SPELLINGS = ["yes", "y", "true", "t", "1"]
NEGATIVE_SPELLINGS = ["no", "n", "false", "f", "0"]


def _distinct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct non-null (column, value), values as strings; one partial aggregation."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    return long.where(F.col("value").isNotNull()).distinct()


def distinct_values(df: DataFrame, cols: Sequence[str], limit: int = MAX_LITERAL_CATEGORIES) -> dict[str, list | None]:
    """Sorted distinct values per column; None for a column with more than ``limit``."""
    cols = list(cols)
    if not cols:
        return {}
    d = cut_lineage(_distinct(df, cols))
    sizes = {r["column"]: r["n"] for r in d.groupBy("column").agg(F.count("*").alias("n")).collect()}
    out: dict[str, list | None] = {c: None if sizes.get(c, 0) > limit else [] for c in cols}
    small = [c for c in cols if out[c] is not None]
    for r in d.where(F.col("column").isin(small)).collect():        # at most limit x columns rows
        out[r["column"]].append(r["value"])
    return {c: None if v is None else sorted(v) for c, v in out.items()}


def _lookup(mapping: dict, key: Column, default=None) -> Column:
    if not mapping:
        return F.lit(default)
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    out = m[key]
    return F.coalesce(out, F.lit(default)) if default is not None else out


# ----------------------------------------------------------------- E4, E5, E12


def _as_class(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("nan"))


@dataclass(frozen=True)
class LabelEncoder:
    """Sorted distinct string values -> 0..n-1; NULL is the class 'nan'.  E5: an unknown
    value at transform takes the code of the transformed frame's most frequent value."""
    classes: dict[str, list[str]]
    dictionaries: dict[str, DataFrame] = field(default_factory=dict)      # wide columns: (value, code)

    @property
    def columns(self) -> list[str]:
        return [*self.classes, *self.dictionaries]

    def codes(self, c: str) -> dict[str, int]:
        return {v: i for i, v in enumerate(self.classes[c])}

    def code_of(self, c: str, value) -> int | None:
        if c in self.classes:
            return self.codes(c).get(value)
        row = self.dictionaries[c].where(F.col("value") == F.lit(value)).select("code").first()
        return row["code"] if row else None

    def transform(self, df: DataFrame, unknown: str = "mode", codes: dict[str, int] | None = None) -> DataFrame:
        """``unknown``: 'mode' (E5), 'none' (NULL) or 'fitted' (the code of the column in ``codes``)."""
        from retentio.operators.clean import modes
        cols = [c for c in self.columns if c in df.columns]
        fallback = dict(codes or {}) if unknown == "fitted" else {}
        if unknown == "mode" and cols:
            most = modes(df.select(*[_as_class(c).alias(c) for c in cols]), cols)
            fallback = {c: self.code_of(c, most[c]) for c in cols if most[c] is not None}
        out, coded = df, {}
        for i, c in enumerate(c for c in cols if c in self.dictionaries):
            d = self.dictionaries[c].select(F.col("value").alias(f"_value{i}"), F.col("code").alias(f"_code{i}"))
            out = out.join(d, _as_class(c) == F.col(f"_value{i}"), "left")
            coded[c] = F.coalesce(F.col(f"_code{i}"), F.lit(fallback.get(c))).cast("int")
        for c in cols:
            if c in self.classes:
                coded[c] = _lookup(self.codes(c), _as_class(c), fallback.get(c)).cast("int")
        return out.select(*[coded[c].alias(c) if c in coded else F.col(c) for c in df.columns])


def _dictionary(df: DataFrame, c: str) -> DataFrame:
    """(value, code) of a wide column, codes in the order of the strings.  The first seven
    bytes as a number cut the values into slices; the whole string orders within them."""
    values = df.select(_as_class(c).alias("value")).distinct()
    head = F.conv(F.rpad(F.hex(F.substring(F.encode("value", "utf-8"), 1, 7)), 14, "0"), 16, 10).cast("long")
    ranked = row_index(values.withColumn("_head", head), ["_head", "value"], name="_rank")
    return cut_lineage(ranked.select("value", (F.col("_rank") - 1).cast("int").alias("code")))


def fit_label_encoder(df: DataFrame, cols: Sequence[str]) -> LabelEncoder:
    vals = distinct_values(df.select(*[_as_class(c).alias(c) for c in cols]), cols)
    return LabelEncoder({c: v for c, v in vals.items() if v is not None},
                        {c: _dictionary(df, c) for c, v in vals.items() if v is None})


def prepare_for_model(df: DataFrame, id_col: str, target: str) -> tuple[DataFrame, LabelEncoder]:
    """Label-encode every remaining string column except id and target."""
    cols = [c for c, t in df.dtypes if t == "string" and c not in (id_col, target)]
    enc = fit_label_encoder(df, cols)
    return enc.transform(df, unknown="none"), enc


# ----------------------------------------------------------------- E1-E3


@dataclass(frozen=True)
class BinaryEncoder:
    """Per column either a polarity map (value -> 1/0, others NULL) or label codes,
    where an unknown value takes the most frequent value's code (E5)."""
    polarity: dict[str, dict[str, int]] = field(default_factory=dict)
    labels: LabelEncoder = field(default_factory=lambda: LabelEncoder({}))

    def transform(self, df: DataFrame) -> DataFrame:
        out = df.select(*[_lookup(self.polarity[c], F.col(c).cast("string")).cast("int").alias(c)
                          if c in self.polarity else F.col(c) for c in df.columns])
        return self.labels.transform(out) if any(c in df.columns for c in self.labels.columns) else out


def fit_binary_encoder(df: DataFrame, cols: Sequence[str]) -> BinaryEncoder:
    cols = list(cols)
    spelled = POSITIVE_SPELLINGS + NEGATIVE_SPELLINGS
    seen: dict[str, dict[str, int]] = {c: {} for c in cols}
    # the spellings a column holds: bounded by the upper / lower case variants of ten short words
    for r in (_distinct(df, cols).where(F.lower("value").isin(spelled)).collect() if cols else []):
        seen[r["column"]][r["value"]] = int(r["value"].lower() in POSITIVE_SPELLINGS)
    polar = {c: m for c, m in seen.items() if len(set(m.values())) == 2}
    rest = [c for c in cols if c not in polar]
    return BinaryEncoder(polar, fit_label_encoder(df, rest) if rest else LabelEncoder({}))


def strict_binary_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Columns whose non-null values are exactly {'Yes', 'No'}; one aggregate of fixed size."""
    cols = list(cols)
    if not cols:
        return []
    v = {c: F.col(c).cast("string") for c in cols}
    row = df.agg(*[f(x).alias(f"{n}{i}") for i, c in enumerate(cols) for n, f, x in (
        ("yes", F.max, v[c] == "Yes"), ("no", F.max, v[c] == "No"), ("other", F.max, ~v[c].isin("Yes", "No")))]).first()
    return [c for i, c in enumerate(cols) if row[f"yes{i}"] and row[f"no{i}"] and not row[f"other{i}"]]


# ----------------------------------------------------------------- E6, E7


def _sparse_one(place: Column, size: int) -> Column:
    """A sparse vector of ``size`` numbers with a 1 at ``place``; all zeros where it is NULL."""
    fields = F.concat(F.lit(f'{{"v":{{"type":0,"size":{size},"indices":['), F.coalesce(place.cast("string"), F.lit("")),
                      F.lit('],"values":['), F.when(place.isNull(), "").otherwise("1.0"), F.lit("]}}"))
    return F.from_json(fields, T.StructType([T.StructField("v", VectorUDT())]))["v"]


@dataclass(frozen=True)
class OneHotEncoder:
    """``{col}_{category}`` double indicators over the fitted categories;
    unknown or NULL -> all zeros; the source column is dropped.  E7 with
    ``drop_first``.  The categories of a wide column are the places of one sparse
    vector ``{col}_onehot``, in the order of their codes in its dictionary."""
    categories: dict[str, list[str]]
    drop_first: bool = False
    dictionaries: dict[str, DataFrame] = field(default_factory=dict)      # wide columns: (value, code)
    sizes: dict[str, int] = field(default_factory=dict)                   # their numbers of values

    def output_columns(self, c: str) -> list[tuple[str, str]]:
        cats = self.categories[c][1:] if self.drop_first else self.categories[c]
        return [(f"{c}_{v}", v) for v in cats]

    def _vector(self, df: DataFrame, c: str, i: int) -> DataFrame:
        """``df`` with the sparse vector of the wide column ``c``."""
        first = int(self.drop_first)
        n = self.sizes[c] - first
        known = self.dictionaries[c].select(F.col("value").alias(f"_value{i}"), (F.col("code") - first).alias(f"_code{i}"))
        place = F.when(F.col(f"_code{i}") >= 0, F.col(f"_code{i}"))
        coded = df.join(known, F.col(c).cast("string") == F.col(f"_value{i}"), "left")
        # Spark ML's encoder names every category in the column's metadata, which the driver holds: here the metadata
        # has their number only
        sized = {"ml_attr": {"num_attrs": n}}
        return coded.withColumn(f"{c}_onehot", _sparse_one(place, n)) \
            .withMetadata(f"{c}_onehot", sized).drop(f"_value{i}", f"_code{i}")

    def transform(self, df: DataFrame) -> DataFrame:
        out, vectors = [], {}
        for c in df.columns:
            if c in self.dictionaries:
                if self.sizes[c] > int(self.drop_first):
                    out.append(F.col(f"{c}_onehot"))
                    vectors[c] = len(vectors)
            elif c not in self.categories:
                out.append(F.col(c))
            else:
                for name, v in self.output_columns(c):
                    out.append(F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("double"), F.lit(0.0)).alias(name))
        for c, i in vectors.items():
            df = self._vector(df, c, i)
        return df.select(*out)

    def source_of(self) -> dict[str, str]:
        """Encoded column -> source column (kept as metadata, not parsed from names)."""
        return {**{name: c for c in self.categories for name, _ in self.output_columns(c)},
                **{f"{c}_onehot": c for c in self.dictionaries}}


def fit_one_hot(df: DataFrame, cols: Sequence[str], drop_first: bool = False,
                limit: int = MAX_LITERAL_CATEGORIES) -> OneHotEncoder:
    """Indicator columns for columns of up to ``limit`` categories, a dictionary table (and one
    sparse vector column) for wider ones; no column is refused."""
    vals = distinct_values(df, cols, limit)
    wide = [c for c, v in vals.items() if v is None]
    tables = {c: _dictionary(df.where(F.col(c).isNotNull()), c) for c in wide}
    return OneHotEncoder({c: vals[c] for c in cols if c not in tables}, drop_first, tables,
                         {c: t.count() for c, t in tables.items()})


# ----------------------------------------------------------------- E8-E11


@dataclass(frozen=True)
class Scaler:
    """(x - center) / scale with fitted literals; NULL stays NULL."""
    center: dict[str, float]
    scale: dict[str, float]
    kind: str

    def transform(self, df: DataFrame) -> DataFrame:
        def sc(c):
            return ((F.col(c).cast("double") - F.lit(self.center[c])) / F.lit(self.scale[c])).alias(c)
        return df.select(*[sc(c) if c in self.center else F.col(c) for c in df.columns])


def fit_standard_scaler(df: DataFrame, cols: Sequence[str]) -> Scaler:
    """Population std (ddof=0, N5); zero std -> 1."""
    cols = list(cols)
    row = df.agg(*[x for i, c in enumerate(cols) for x in (
        F.avg(F.col(c).cast("double")).alias(f"m{i}"), F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}"))]).first()
    center = {c: row[f"m{i}"] for i, c in enumerate(cols)}
    scale = {c: (row[f"s{i}"] if row[f"s{i}"] not in (None, 0.0) else 1.0) for i, c in enumerate(cols)}
    return Scaler(center, scale, "standard")


def fit_minmax_scaler(df: DataFrame, cols: Sequence[str]) -> Scaler:
    """(x - min) / (max - min); zero range -> 1."""
    cols = list(cols)
    row = df.agg(*[x for i, c in enumerate(cols) for x in (
        F.min(F.col(c).cast("double")).alias(f"lo{i}"), F.max(F.col(c).cast("double")).alias(f"hi{i}"))]).first()
    center = {c: row[f"lo{i}"] for i, c in enumerate(cols)}
    scale = {}
    for i, c in enumerate(cols):
        rng = (row[f"hi{i}"] - row[f"lo{i}"]) if row[f"hi{i}"] is not None else None
        scale[c] = rng if rng not in (None, 0.0) else 1.0
    return Scaler(center, scale, "minmax")


def fit_robust_scaler(df: DataFrame, cols: Sequence[str]) -> Scaler:
    """(x - median) / (q75 - q25), exact quantiles; zero IQR -> 1."""
    q = quantile_row(df, list(cols), [0.25, 0.5, 0.75])
    center = {c: q[c][1] for c in cols}
    scale = {c: ((q[c][2] - q[c][0]) if q[c][0] is not None and q[c][2] != q[c][0] else 1.0) for c in cols}
    return Scaler(center, scale, "robust")


def scale(df: DataFrame, cols: Sequence[str], kind: str = "standard") -> tuple[DataFrame, Scaler | None]:
    """E11 switch: 'standard' | 'minmax' | 'robust' | 'none' (fit on ``df``)."""
    if kind == "none":
        return df, None
    fit = {"standard": fit_standard_scaler, "minmax": fit_minmax_scaler, "robust": fit_robust_scaler}[kind]
    s = fit(df, cols)
    return s.transform(df), s
