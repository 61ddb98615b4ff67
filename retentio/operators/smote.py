"""SMOTE and hybrid resampling (survey §2.7, R6/R7).

Neighbours come from a forest of random-projection trees on standardized
features: every node is cut at quantiles of a random projection (sketched per
node, a partial aggregation) until leaves hold about ``leaf_rows`` rows; rows
that no projection tells apart are cut by hash.  Inside a leaf k-NN is exact,
and a row keeps the best k over all trees, so every minority row gets k
neighbours (or all others, if fewer) and the table has at most
rows x k x trees rows on the way.  It is stored once.  Synthetic rows follow
from a deterministic assignment of base rows, neighbours and gaps
(hash-derived uniforms): a rerun or a recomputed partition yields the same.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentio.plans.ordering import k_smallest, row_index
from retentio.session import cut_lineage, stored

#: children of a node
FAN_OUT = 4


def _uniform(*cols, seed: int):
    return (F.pmod(F.xxhash64(*cols, F.lit(seed)), F.lit(1_000_003)).cast("double") + 0.5) / 1_000_003.0


def _standardized(df: DataFrame, id_col: str, features: Sequence[str]) -> DataFrame:
    """(id, v): features as an array with mean 0 and deviation 1; NULL counts as 0."""
    x = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features]
    m = df.agg(*[F.avg(v).alias(f"m{i}") for i, v in enumerate(x)],
               *[F.stddev_samp(v).alias(f"s{i}") for i, v in enumerate(x)]).first()
    return df.select(F.col(id_col).alias("id"), F.array(*[
        (v - F.lit(m[f"m{i}"] or 0.0)) / F.lit(m[f"s{i}"] or 1.0) for i, v in enumerate(x)]).alias("v"))


def _projection(dim: int, seed: tuple[int, ...]) -> Column:
    w = np.random.default_rng(seed).normal(size=dim).tolist()
    return F.aggregate(F.zip_with("v", F.lit(w), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)


def _merged(least: int) -> Column:
    """Map child -> child with the small children of a leaf joined to the ones before them (the first
    to the one after), from ``_kids``, the sorted (child, n) of the leaf."""
    acc = F.struct(F.array().cast("array<struct<child:long,into:long>>").alias("m"), F.lit(-1).cast("long").alias("into"),
                   F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("before"))

    def add(a, x):
        new = (a["into"] < 0) | (a["n"] >= least)
        into = F.when(new, x["child"]).otherwise(a["into"])
        return F.struct(F.concat(a["m"], F.array(F.struct(x["child"].alias("child"), into.alias("into")))).alias("m"), into.alias("into"),
                        (x["n"] + F.when(new, F.lit(0)).otherwise(a["n"])).cast("long").alias("n"),
                        F.when(new & (a["into"] >= 0), a["into"]).otherwise(a["before"]).alias("before"))

    def close(a):
        # the last group may be too small: it joins the one before it, if there is one
        first = a["m"][0]["into"]
        last = F.when((a["n"] < least) & (a["into"] != first), a["before"]).otherwise(a["into"])
        return F.map_from_entries(F.transform(a["m"], lambda e: F.struct(
            e["child"], F.when(e["into"] == a["into"], last).otherwise(e["into"]))))

    return F.aggregate("_kids", acc, add, close)


def _leaves(vec: DataFrame, n: int, dim: int, leaf_rows: int, least: int, seed: int) -> DataFrame:
    """``vec`` with ``leaf`` and ``part``: groups of about ``leaf_rows`` rows that lie close together.
    A leaf is cut only while it has more rows, and no cut leaves fewer than ``least`` rows."""
    probs = [i / FAN_OUT for i in range(1, FAN_OUT)]
    out = vec.withColumn("leaf", F.lit(0).cast("long"))
    depth = max(0, math.ceil(math.log(max(1, n) / leaf_rows, FAN_OUT))) if n > leaf_rows else 0
    for level in range(depth):
        out = out.withColumn("_p", _projection(dim, (seed, level)))
        cuts = out.groupBy("leaf").agg(F.percentile_approx("_p", probs, 1000).alias("_cuts"), F.count("*").alias("_m"))
        child = F.when(F.col("_m") <= leaf_rows, F.lit(0)).otherwise(F.size(F.filter("_cuts", lambda c: c < F.col("_p"))))
        out = stored(out.join(cuts, "leaf").select("id", "v", "leaf", child.cast("long").alias("_child")), "leaves")
        kids = (out.groupBy("leaf", "_child").agg(F.count("*").alias("n")).groupBy("leaf")       # at most FAN_OUT a leaf
                .agg(F.sort_array(F.collect_list(F.struct(F.col("_child").alias("child"), "n"))).alias("_kids")))
        out = stored(out.join(kids.select("leaf", _merged(least).alias("_into")), "leaf")
                     .select("id", "v", (F.col("leaf") * FAN_OUT + F.col("_into")[F.col("_child")]).alias("leaf")), "leaves")
    sizes = out.groupBy("leaf").agg(F.count("*").alias("_m"))
    parts = F.greatest(F.floor(F.col("_m") / F.lit(leaf_rows)), F.lit(1))
    return (out.join(sizes, "leaf").withColumn("part", F.pmod(F.xxhash64("id"), parts)).select("id", "v", "leaf", "part"))


def _nearest(k: int):
    def search(leaf: pa.Table) -> pa.Table:
        v = np.array(leaf.column("v").to_pylist(), float)
        ids = leaf.column("id")
        take = min(k, len(v) - 1)
        rows, others, dist = [], [], []
        for lo in range(0, len(v), 256):
            d = np.sqrt(((v[lo:lo + 256, None, :] - v[None, :, :]) ** 2).sum(axis=2))
            d[np.arange(len(d)), np.arange(lo, lo + len(d))] = np.inf
            near = np.argsort(d, axis=1, kind="stable")[:, :take]
            rows.append(np.repeat(np.arange(lo, lo + len(d)), take))
            others.append(near.ravel())
            dist.append(np.take_along_axis(d, near, 1).ravel())
        rows, others, dist = (np.concatenate(x) for x in (rows, others, dist))
        return pa.table({"qid": ids.take(pa.array(rows, pa.int64())), "nb_id": ids.take(pa.array(others, pa.int64())),
                         "dist": pa.array(dist, pa.float64())})

    return search


def minority_neighbours(minority: DataFrame, id_col: str, features: Sequence[str], k: int = 5,
                        leaf_rows: int = 256, trees: int = 3, seed: int = 42) -> DataFrame:
    """(qid, nb_id, dist, nb_rank): the ``k`` nearest minority rows found, stored once."""
    vec = cut_lineage(_standardized(minority, id_col, features))
    n = vec.count()
    kind = vec.schema["id"].dataType.simpleString()
    found = None
    for t in range(trees):
        one = (_leaves(vec, n, len(features), max(leaf_rows, 4 * (k + 1)), 2 * (k + 1), seed + t).groupBy("leaf", "part")
               .applyInArrow(_nearest(k), f"qid {kind}, nb_id {kind}, dist double"))
        found = one if found is None else found.unionByName(one)
    pairs = found.groupBy("qid", "nb_id").agg(F.min("dist").alias("dist"))
    return cut_lineage(k_smallest(pairs, ["dist", "nb_id"], k, ["qid"], rank_name="nb_rank"))


def smote(df: DataFrame, id_col: str, label: str, features: Sequence[str], ratio: float = 1.0, k: int = 5,
          seed: int = 42) -> DataFrame:
    """Add int(ratio * n_majority) - n_minority synthetic minority rows
    x + u * (neighbour - x); their id and all columns that are not features are NULL.
    Not binary or already balanced enough: unchanged (R8)."""
    from retentio.operators.sample import is_binary
    binary, counts = is_binary(df, label)
    if not binary:
        return df
    (minority, n_min), (_, n_maj) = sorted(counts.items(), key=lambda kv: (kv[1], kv[0]))
    n_new = int(ratio * n_maj) - n_min
    if n_new <= 0 or n_min < 2:
        return df
    synth = synthetic_rows(df, id_col, label, features, minority, n_min, n_new, k, seed)
    return df.unionByName(synth.select(*[
        F.col(c).cast(df.schema[c].dataType).alias(c) if c in (label, *features)
        else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in df.columns]))


def synthetic_rows(df: DataFrame, id_col: str, label: str, features: Sequence[str], minority, n_min: int,
                   n_new: int, k: int = 5, seed: int = 42) -> DataFrame:
    """(base_id, nb_id, gap, label, features...): the synthetic rows and what made them."""
    mino = df.where(F.col(label) == minority).select(F.col(id_col).alias("base_id"), *features)
    nbs = minority_neighbours(mino, "base_id", features, k, seed=seed)
    own = nbs.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("nb_rank", "nb_id"))).alias("_nbs"))   # at most k
    base = row_index(mino.withColumn("_key", F.xxhash64("base_id", F.lit(seed))), ["_key", "base_id"], name="_pos").drop("_key")
    reps = F.lit(n_new // n_min) + F.when(F.col("_pos") <= n_new % n_min, 1).otherwise(0)
    base = base.join(own, F.col("base_id").eqNullSafe(F.col("qid")), "left")
    gen = base.select("base_id", "_nbs", *features, F.explode(F.sequence(F.lit(0), reps)).alias("_rep")).where(F.col("_rep") > 0)
    pick = F.pmod(F.xxhash64("base_id", "_rep", F.lit(seed)), F.size("_nbs")).cast("int")
    # a row alone in its leaf of every tree would be its own neighbour
    gen = gen.withColumn("nb_id", F.coalesce(F.get("_nbs", pick)["nb_id"], F.col("base_id"))).drop("_nbs")
    gen = gen.withColumn("gap", _uniform(F.col("base_id"), F.col("_rep"), seed=seed + 1))
    nb_feats = mino.select(F.col("base_id").alias("_nb"), *[F.col(c).alias(f"_nb_{c}") for c in features])
    j = gen.join(nb_feats, F.col("nb_id").eqNullSafe(F.col("_nb")))
    return j.select("base_id", "nb_id", "gap", F.lit(minority).alias(label),
                    *[(F.col(c) + F.col("gap") * (F.col(f"_nb_{c}") - F.col(c))).alias(c) for c in features])


def hybrid(df: DataFrame, id_col: str, label: str, features: Sequence[str], ratio: float = 1.0, k: int = 5,
           seed: int = 42) -> DataFrame:
    """Undersample to minority:majority = 0.3, then SMOTE to ``ratio``; when the
    ratio is already above 0.3 the undersampling step is skipped."""
    from retentio.operators.sample import is_binary, undersample
    binary, counts = is_binary(df, label)
    if not binary:
        return df
    n_min, n_maj = sorted(counts.values())      # classes only: a NULL label is none
    step = undersample(df, id_col, label, 0.3, seed) if n_min / n_maj < 0.3 else df
    return smote(step, id_col, label, features, ratio, k, seed)
