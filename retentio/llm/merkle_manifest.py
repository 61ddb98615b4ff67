"""Merkle manifest of a dataset by slot pivots.

Every row is a leaf: the SHA-256 of its fields.  The leaves of a group (source)
ascend by id; runs of ``fanout`` nodes become their parent until one node, the
subroot, is left; the subroots, ordered by group, become the root the same way.

* Places.  Leaves are sorted by range over all partitions; a table of the runs
  (partition, group), at most partitions + groups rows, turns places in a partition
  into places in a group.  A group of any size so lies in many tasks.
* Slot pivot.  A parent row has one column a slot: conditional aggregates spread its
  children over them.  All columns concatenated give its digest, all but the own
  column the siblings.  A level has a ``fanout``-th of the rows of the one below and is
  stored, so a lost executor costs one level.
* Paths go down from the root: a parent's path is joined once a level on (group,
  place), unique on both sides, and extended by the child's siblings.

Digests are 32 bytes inside; texts are hashed where they are read and not moved.

Defined results: a NULL field is ``-``; a NULL group is a group of its own and the first;
NULL ids come first in a group; rows of one id are ordered by their digest, and
repeated rows take consecutive places; other columns are ignored; an empty table
gives no rows.  Only DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retentio.llm.common import stage, table

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: paths are stored after so many levels, so that no plan holds the joins of all levels
STORE_EVERY = 3
PATH = "array<struct<left:binary,right:binary>>"


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def sha(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def row_digest(*fields: Column) -> Column:
    """Digest of a row: each field as its length in bytes, ``:`` and value, or ``-`` if NULL."""
    texts = [f.cast("string") for f in fields]
    return sha(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]))


def places(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((grp, pos, size, digest, item) of every leaf, (grp, size) of every group).

    ``leaves`` has src, id, digest and item; ``grp`` numbers the groups in their order."""
    fixed = stage(leaves.withColumn("row", F.monotonically_increasing_id()), "leaves")
    ordered = stage(fixed.repartitionByRange("src", "id", "digest", "row")
                    .sortWithinPartitions("src", "id", "digest", "row").drop("row")
                    .withColumn("mid", F.monotonically_increasing_id()), "leaves-ordered")
    part = F.shiftright("mid", 33).alias("part")
    runs = stage(ordered.groupBy(part, "src").agg(F.min("mid").alias("first"), F.count("*").alias("n")), "runs")
    groups = runs.groupBy("src").agg(F.min("first").alias("first"), F.sum("n").alias("size"))
    # groups are numbered where they begin: those of earlier partitions, then those of its own
    begin = groups.withColumn("part", F.shiftright("first", 33))
    earlier = begin.groupBy("part").agg(F.count("*").alias("n")).select("part", (F.sum("n").over(
        Window.orderBy("part")) - F.col("n")).alias("earlier"))
    numbered = stage(begin.withColumn("k", F.row_number().over(Window.partitionBy("part").orderBy("first")))
                     .join(earlier, "part").select("src", "size", (F.col("earlier") + F.col("k") - 1).alias("grp")), "groups")
    before = F.sum("n").over(Window.partitionBy("src").orderBy("part")) - F.col("n")
    starts = stage(runs.withColumn("base", F.col("first") - before).alias("r")
                   .join(numbered.alias("g"), F.col("r.src").eqNullSafe(F.col("g.src")))
                   .select("r.part", "r.src", "base", "grp", "size"), "starts")
    placed = ordered.withColumn("part", part).alias("o").join(
        starts.alias("s"), (F.col("o.part") == F.col("s.part")) & F.col("o.src").eqNullSafe(F.col("s.src")))
    return (placed.select("grp", (F.col("mid") - F.col("base")).alias("pos"), "size", "digest", "item"),
            numbered.select("grp", "size"))


def pivot(nodes: DataFrame, fanout: int) -> DataFrame:
    """Parents of ``nodes``: (grp, pos, below, size, s0, s1, ..., digest); ``below`` counts the
    group's nodes on the children's level.  The only node of a group keeps its digest."""
    slot = F.pmod("pos", F.lit(fanout))
    slots = [F.max(F.when(slot == k, F.struct("digest", "item"))).alias(f"s{k}") for k in range(fanout)]
    wide = nodes.groupBy("grp", F.floor(F.col("pos") / fanout).alias("pos")).agg(F.max("size").alias("below"), *slots)
    joined = F.concat(*[F.coalesce(hexed(F.col(f"s{k}.digest")), F.lit("")) for k in range(fanout)])
    return wide.select("grp", "pos", "below", F.ceil(F.col("below") / fanout).alias("size"), *[f"s{k}" for k in range(fanout)],
                       F.when(F.col("below") == 1, F.col("s0.digest")).otherwise(sha(joined)).alias("digest"))


def grow(nodes: DataFrame, largest: int, fanout: int, name: str) -> list[DataFrame]:
    """The stored levels of parents, from the lowest; ``largest`` counts the largest group's nodes."""
    levels = []
    while not levels or largest > 1:
        below = levels[-1].filter("size > 1").select("grp", "pos", "size", "digest", F.lit(None).cast("int").alias("item")) \
            if levels else nodes
        levels.append(stage(pivot(below, fanout), f"{name}-{len(levels)}"))
        largest = -(-largest // fanout)
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """(grp, digest) of the last node of every group."""
    return reduce(DataFrame.unionByName, [lv.filter("size = 1").select("grp", "digest") for lv in levels])


def paths(levels: list[DataFrame], top: DataFrame, fanout: int) -> DataFrame:
    """(item, digest, path, *more) of the lowest nodes.  ``top`` has grp, the path above a group's last node,
    and more columns that are handed down."""
    more = [c for c in top.columns if c not in ("grp", "path")]
    siblings = []
    for k in range(fanout):
        side = lambda ks: F.concat(*[F.coalesce(F.col(f"s{j}.digest"), F.lit(b"")) for j in ks]) \
            if ks else F.lit(b"")                                                           # noqa: E731
        siblings.append(F.when(F.col(f"s{k}").isNotNull(), F.struct(
            (F.col("pos") * fanout + k).alias("pos"), F.col(f"s{k}.item").alias("item"), F.col(f"s{k}.digest").alias("digest"),
            side(range(k)).alias("left"), side(range(k + 1, fanout)).alias("right"))))
    above = None
    for height, level in reversed(list(enumerate(levels))):
        here = level.filter("size = 1").select("grp", "pos").join(top, "grp").select("grp", "pos", "path", *more)
        above = here if above is None else here.unionByName(above.select("grp", "pos", "path", *more))
        own = F.when(F.col("below") > 1, F.array(F.struct("c.left", "c.right"))).otherwise(F.array().cast(PATH))
        above = (level.join(above, ["grp", "pos"])
                 .select("grp", "below", "path", *more, F.explode(F.filter(F.array(*siblings), lambda x: x.isNotNull())).alias("c"))
                 .select("grp", "c.pos", "c.item", "c.digest", F.concat(own, "path").alias("path"), *more))
        if height and height % STORE_EVERY == 0:
            above = stage(above.drop("item"), "paths").withColumn("item", F.lit(None))
    return above.drop("grp", "pos")


def build(docs: DataFrame, fields=FIELDS, id_col: str = "doc_id", group_col: str = "source", fanout: int = 3,
          **also: Column) -> DataFrame:
    """(id, leaf, subroot, root, path, *also): the manifest, one row per row of ``docs``.

    ``path`` has, from the leaf's level to the root's, the siblings to the left and to the right as
    concatenated digests.  ``also`` are expressions over ``docs`` that are kept beside the leaf."""
    if not 2 <= fanout <= 64:
        raise ValueError("a fanout of 2 to 64")
    item = F.struct(F.col(id_col).alias("id"), *[c.alias(k) for k, c in also.items()])
    leaves = docs.select(F.col(group_col).alias("src"), F.col(id_col).alias("id"),
                         row_digest(*[F.col(c) for c in fields]).alias("digest"), item.alias("item"))
    placed, groups = places(leaves)
    n, largest = groups.agg(F.count("*"), F.max("size")).first()
    levels = grow(placed, largest or 1, fanout, "tree")
    subroots = tops(levels)
    over = grow(subroots.select(F.lit(0).alias("grp"), F.col("grp").alias("pos"), F.lit(n).alias("size"), "digest",
                                F.col("grp").alias("item")), n, fanout, "tree-of-groups")
    root = tops(over).first()
    none = F.array().cast(PATH)
    end = over[-1].filter("size = 1").select("grp", none.alias("path"))
    top = paths(over, end, fanout).select(F.col("item").alias("grp"), "path", F.col("digest").alias("subroot"))
    rows = paths(levels, top, fanout)
    return rows.select(F.col("item.id").alias(id_col), F.col("digest").alias("leaf"), "subroot",
                       F.lit(bytes(root["digest"]) if root else None).cast("binary").alias("root"), "path",
                       *[F.col(f"item.{k}").alias(k) for k in also])


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings on its path."""
    return F.aggregate(path, leaf, lambda d, p: sha(F.concat(hexed(p["left"]), hexed(d), hexed(p["right"]))))


def proof(path: Column) -> Column:
    """One digest of all siblings on a path, in hex."""
    return F.sha2(F.array_join(F.transform(path, lambda p: hexed(F.concat(p["left"], p["right"]))), ""), 256)


def digests(manifest: DataFrame, seen: Column, id_col: str = "doc_id") -> DataFrame:
    """The manifest in hex, and whether the leaf ``seen`` later still folds to the root."""
    return (manifest.withColumn("_folded", fold(seen, F.col("path")))
            .select(id_col, hexed(F.col("leaf")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"),
                    hexed(F.col("root")).alias("root"), proof(F.col("path")).alias("proof_sha256"),
                    hexed(F.col("_folded")).alias("folded_root"), (F.col("_folded") == F.col("root")).alias("verified")))


def query(spark, sf_dir):
    """op11: manifest of all documents; line feeds vanish from the texts whose crc32(doc_id) is even.
    A document without id is not tampered with."""
    docs = table(spark, sf_dir, "documents")
    changed = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0
    text = F.replace("text", F.lit("\n"), F.lit(""))
    seen = F.when(changed, row_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text))
    return digests(build(docs, tampered=seen), F.coalesce("tampered", "leaf"))


SQL = r"""
WITH RECURSIVE f AS (
  SELECT doc_id, source, text, concat(
      CASE WHEN doc_id IS NULL THEN '-' ELSE concat(strlen(doc_id::VARCHAR), ':', doc_id) END,
      CASE WHEN source IS NULL THEN '-' ELSE concat(strlen(source), ':', source) END,
      CASE WHEN lang IS NULL THEN '-' ELSE concat(strlen(lang), ':', lang) END,
      CASE WHEN n_chars IS NULL THEN '-' ELSE concat(strlen(n_chars::VARCHAR), ':', n_chars) END) AS head,
    (xor(4294967295::BIGINT, list_reduce(list_transform(range(1, length(doc_id::VARCHAR) + 1),
        lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT),
        lambda c, b: list_reduce(range(8)::BIGINT[], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)),
        4294967295::BIGINT)) & 1) = 0 AS changed
  FROM documents),
l AS (
  SELECT doc_id, source, sha256(concat(head, CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(text), ':', text) END)) AS leaf,
    CASE WHEN changed THEN sha256(concat(head, CASE WHEN text IS NULL THEN '-' ELSE
      concat(strlen(replace(text, chr(10), '')), ':', replace(text, chr(10), '')) END)) END AS seen
  FROM f),
n AS (
  SELECT doc_id, leaf, coalesce(seen, leaf) AS fold, '' AS proof, leaf AS digest,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS size FROM l),
t AS (
  SELECT doc_id, leaf, fold, proof, digest, grp::BIGINT AS grp, pos::BIGINT AS pos, size::BIGINT AS size FROM n
  UNION ALL
  SELECT doc_id, leaf, sha256(concat(CASE WHEN slot > 0 THEN s0 ELSE '' END, CASE WHEN slot > 1 THEN s1 ELSE '' END, fold,
      CASE WHEN slot < 1 THEN s1 ELSE '' END, CASE WHEN slot < 2 THEN s2 ELSE '' END)),
    concat(proof, CASE WHEN slot <> 0 THEN s0 ELSE '' END, CASE WHEN slot <> 1 THEN s1 ELSE '' END, CASE WHEN slot <> 2 THEN s2 ELSE '' END),
    sha256(concat(s0, s1, s2)), grp, pos // 3, (size + 2) // 3
  FROM (SELECT *, pos % 3 AS slot, max(CASE WHEN pos % 3 = 0 THEN digest ELSE '' END) OVER w AS s0,
          max(CASE WHEN pos % 3 = 1 THEN digest ELSE '' END) OVER w AS s1,
          max(CASE WHEN pos % 3 = 2 THEN digest ELSE '' END) OVER w AS s2
        FROM t WHERE size > 1 WINDOW w AS (PARTITION BY grp, pos // 3)) AS x),
u AS (
  SELECT doc_id, leaf, fold, proof, digest, digest AS subroot, grp AS pos, max(grp) OVER () + 1 AS size FROM t WHERE size = 1
  UNION ALL
  SELECT doc_id, leaf, sha256(concat(CASE WHEN slot > 0 THEN s0 ELSE '' END, CASE WHEN slot > 1 THEN s1 ELSE '' END, fold,
      CASE WHEN slot < 1 THEN s1 ELSE '' END, CASE WHEN slot < 2 THEN s2 ELSE '' END)),
    concat(proof, CASE WHEN slot <> 0 THEN s0 ELSE '' END, CASE WHEN slot <> 1 THEN s1 ELSE '' END, CASE WHEN slot <> 2 THEN s2 ELSE '' END),
    sha256(concat(s0, s1, s2)), subroot, pos // 3, (size + 2) // 3
  FROM (SELECT *, pos % 3 AS slot, max(CASE WHEN pos % 3 = 0 THEN digest ELSE '' END) OVER w AS s0,
          max(CASE WHEN pos % 3 = 1 THEN digest ELSE '' END) OVER w AS s1,
          max(CASE WHEN pos % 3 = 2 THEN digest ELSE '' END) OVER w AS s2
        FROM u WHERE size > 1 WINDOW w AS (PARTITION BY pos // 3)) AS x)
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = digest AS verified
FROM u WHERE size = 1
"""
