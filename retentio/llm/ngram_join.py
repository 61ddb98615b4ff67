"""N-gram Jaccard join with Bayesian candidate pruning.

Documents become sets of word 5-grams; two documents are linked at a Jaccard
similarity of 0.8 or more.

1. Documents with equal sets form one copy class (128-bit set key,
   pre-aggregated); only classes go on, so copies are never paired.
2. Each class has 128 MinHash values, cut into 32 bands of 4: a pair at the
   threshold misses every band with a probability of 5e-8.  Classes that share
   a band with another one meet in its bucket.
3. In a bucket, pairs are compared value by value in steps of 16; a pair is
   dropped as soon as the posterior probability that its similarity reaches
   the threshold (uniform prior) falls below ``tolerance``.  Of what is left
   only a spanning star is sent on, so a bucket gives no more rows than it has
   members.  Pairs already joined through a third class are not compared.
4. Components of these edges hold every link.  Within a component all pairs
   are verified exactly from the whole sets, and each class reports the number
   of its links and a spanning star of verified ones.  Components of the
   verified links are the classes of the result.

Buckets and components of any size are split into blocks: the members of
blocks i and j meet in cell (i, j), whose size is bounded; only sums and stars
leave a cell, never pairs.

Defined results: a text of one to four words is a single n-gram; NULL and
empty texts have no set, are linked to nothing and are their own class; a NULL
id sorts after all ids, so it names a class only if nothing else can; rows
that share id and text are one document with one link partner set each;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentio.llm.common import list_values, mix64, stage, table, window_hashes, word_hashes
from retentio.llm.components import connected_components

BANDS, ROWS = 32, 4
STEP = 16
#: MinHash values that travel to the buckets (16 bits of each)
SENT = 64
LAST_ID = (1 << 63) - 1


@dataclass(frozen=True)
class JoinSettings:
    n: int = 5
    threshold: float = 0.8
    tolerance: float = 1e-6
    bucket_block: int = 2048     # classes of a bucket in one block
    set_block: int = 512         # classes of a component in one block


def needed_matches(compared: int, threshold: float, tolerance: float) -> int:
    """Fewest matches among ``compared`` MinHash values for which
    P(similarity >= threshold | matches) is at least ``tolerance``."""
    total = compared + 1
    tail = 0.0
    for k in range(total):
        # P(Beta(k+1, compared-k+1) > t) = P(Binomial(compared+1, t) <= k)
        tail += math.comb(total, k) * threshold ** k * (1 - threshold) ** (total - k)
        if tail >= tolerance:
            return k
    return compared


def shingles(h: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(document row, hash) of the distinct n-grams of each document of a batch, sorted."""
    h = h.view(np.uint64)
    size = np.diff(offsets)
    row_of = np.repeat(np.arange(len(size)), size)
    grams = window_hashes(h, n)
    inside = row_of[:len(grams)] == row_of[n - 1:] if len(grams) else np.empty(0, bool)
    rows, values = row_of[:len(grams)][inside], grams[inside]
    for i in np.flatnonzero((size > 0) & (size < n)):       # short texts: the text itself
        rows = np.append(rows, i)
        values = np.append(values, window_hashes(h[offsets[i]:offsets[i + 1]], int(size[i])) ^ np.uint64(size[i]))
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[new], values[new]


_MULTIPLIERS = mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def minhash(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(sets, 128) 32-bit MinHash values of consecutive runs of ``values``."""
    out = np.empty((len(starts), BANDS * ROWS), np.uint32)
    with np.errstate(over="ignore"):
        for k, a in enumerate(_MULTIPLIERS):
            out[:, k] = np.minimum.reduceat((values * a) >> np.uint64(32), starts)
    return out


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """(doc, text_key, cls, size, sig); ``cls`` is the 16-byte key of the set, NULL for no set."""
    src = docs.select("doc", "text_key", word_hashes(F.col("text")).alias("h"))

    def sign(batches):
        for b in batches:
            flat, offsets = list_values(b.column("h"))
            count = b.num_rows
            cls, size = [None] * count, np.zeros(count, np.int64)
            sig = [None] * count
            lo = 0
            while lo < count:                               # at most about a million words at once
                hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + (1 << 20))) - 1)
                hi = min(hi, count)
                rows, values = shingles(flat[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], n)
                if len(rows):
                    starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
                    with np.errstate(over="ignore"):
                        keys = np.stack([np.add.reduceat(mix64(values), starts),
                                         np.bitwise_xor.reduceat(mix64(values + np.uint64(0x5851F42D4C957F2D)), starts)], 1)
                    mins = minhash(values, starts)
                    lengths = np.diff(np.append(starts, len(rows)))
                    for r, k, s, m in zip(rows[starts] + lo, keys, lengths, mins):
                        cls[r], size[r], sig[r] = k.tobytes(), s, m.tobytes()
                lo = hi
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), b.column("text_key"), pa.array(cls, pa.binary()), pa.array(size), pa.array(sig, pa.binary())],
                names=["doc", "text_key", "cls", "size", "sig"])

    return src.mapInArrow(sign, "doc long, text_key long, cls binary, size long, sig binary")


def _band_rows(batches):
    """(bucket, cls): one row per class and band."""
    for b in batches:
        if not b.num_rows:
            continue
        sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint32).reshape(b.num_rows, BANDS, ROWS)
        with np.errstate(over="ignore"):
            key = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], b.num_rows, 0)
            for k in range(ROWS):
                key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, k])
        cls = b.column("cls").take(pa.array(np.repeat(np.arange(b.num_rows), BANDS)))
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64).ravel()), cls], names=["bucket", "cls"])


def cells(group: str, size: Column, block: int, member: str) -> Column:
    """The (i, j) cells, i <= j, in which a member of a group of ``size`` meets all others."""
    blocks = F.ceil(size / F.lit(block)).cast("int")
    mine = F.pmod(F.xxhash64(member), blocks).cast("int")
    return F.explode(F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: F.struct(
        F.least(mine, j).alias("i"), F.greatest(mine, j).alias("j"), mine.alias("mine"))))


def _groups(batches, keys: tuple[str, ...]):
    """Tables of whole groups out of a stream sorted by ``keys``; one group is held at a time."""
    held = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        cols = [t.column(k).to_numpy() for k in keys]
        new = np.zeros(t.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in cols)
        if last is not None and first != last:
            yield pa.concat_tables(held)
            held = []
        cuts = [0, *np.flatnonzero(new).tolist(), t.num_rows]
        for lo, hi in zip(cuts[:-2], cuts[1:-1]):
            held.append(t.slice(lo, hi - lo))
            yield pa.concat_tables(held) if len(held) > 1 else held[0]
            held = []
        held.append(t.slice(cuts[-2]))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.concat_tables(held)


def spanning_stars(n: int, like) -> np.ndarray:
    """root[i] for the graph whose edges ``like(i, candidates) -> bool array`` tells;
    a vertex is compared only with those not joined yet."""
    root = np.full(n, -1)
    for seed in range(n):
        if root[seed] >= 0:
            continue
        root[seed] = seed
        frontier = [seed]
        while frontier:
            free = np.flatnonzero(root < 0)
            if not len(free):
                return root
            i = frontier.pop()
            found = free[like(i, free)]
            root[found] = seed
            frontier.extend(found.tolist())
    return root


def plausible_edges(members: DataFrame, settings: JoinSettings) -> DataFrame:
    """(cls, other): spanning stars of the pairs of a bucket that pass the Bayesian test."""
    limits = [(k, needed_matches(k, settings.threshold, settings.tolerance)) for k in range(STEP, SENT + 1, STEP)]

    def prune(batches):
        for t in _groups(batches, ("bucket", "i", "j")):
            cls = t.column("cls").to_pylist()
            sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint16).reshape(len(cls), SENT)

            def like(i, free):
                alive, matches = np.arange(len(free)), np.zeros(len(free), np.int64)
                for k, least in limits:
                    matches = matches + (sig[free[alive], k - STEP:k] == sig[i, k - STEP:k]).sum(axis=1)
                    go = matches >= least
                    alive, matches = alive[go], matches[go]
                out = np.zeros(len(free), bool)
                out[alive] = True
                return out

            root = spanning_stars(len(cls), like)
            at = np.flatnonzero(root != np.arange(len(root)))
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cls[i] for i in at], pa.binary()), pa.array([cls[root[i]] for i in at], pa.binary())],
                    names=["cls", "other"])

    return (members.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
            .mapInArrow(prune, "cls binary, other binary"))


def _adjacency(rows: np.ndarray, values: np.ndarray, size: np.ndarray, threshold: float) -> np.ndarray:
    """Exact Jaccard >= threshold for all pairs of a cell: intersections by blocked products
    over the n-grams that at least two of its documents hold."""
    _, code, count = np.unique(values, return_inverse=True, return_counts=True)
    shared = count[code] > 1
    rows, code = rows[shared], code[shared]
    _, code = np.unique(code, return_inverse=True)
    order = np.argsort(code, kind="stable")
    rows, code = rows[order], code[order]
    n = len(size)
    both = np.zeros((n, n), np.float32)
    width = 4096
    edges = np.searchsorted(code, np.arange(0, (code[-1] + 1 if len(code) else 0) + width, width))
    for b, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        if hi > lo:
            m = np.zeros((n, width), np.float32)
            m[rows[lo:hi], code[lo:hi] - b * width] = 1
            both += m @ m.T
    union = size[:, None] + size[None, :] - both
    return both >= threshold * union - 1e-6


def verified(members: DataFrame, settings: JoinSettings) -> DataFrame:
    """(cls, links, other): links of a class within a cell, and a verified partner star."""
    src = members.select("root_key", "i", "j", "mine", "cls", "copies", word_hashes(F.col("text")).alias("h"))

    def verify(batches):
        for t in _groups(batches, ("root_key", "i", "j")):
            cls = t.column("cls").to_pylist()
            seen: dict[bytes, int] = {}
            for k, c in enumerate(cls):                   # repeated rows of a representative
                seen.setdefault(c, k)
            t = t.take(pa.array(list(seen.values())))
            cls = list(seen)
            flat, offsets = list_values(t.column("h"))
            rows, values = shingles(flat, offsets, settings.n)
            size = np.bincount(rows, minlength=len(cls))
            linked = _adjacency(rows, values, size, settings.threshold)
            np.fill_diagonal(linked, False)
            mine = t.column("mine").to_numpy()
            if t.column("i")[0].as_py() != t.column("j")[0].as_py():
                linked &= mine[:, None] != mine[None, :]   # pairs within a block are cell (i, i)'s
            links = linked @ t.column("copies").to_numpy()
            root = spanning_stars(len(cls), lambda i, free: linked[i, free])
            at = np.flatnonzero(links)
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cls[i] for i in at], pa.binary()), pa.array(links[at].astype(np.int64)),
                     pa.array([cls[root[i]] for i in at], pa.binary())], names=["cls", "links", "other"])

    return src.mapInArrow(verify, "cls binary, links long, other binary")


def _keys(id_col: str, text_col: str) -> tuple[Column, Column]:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)), F.xxhash64(F.col(text_col).cast("string"))


def classes_of(docs: DataFrame, settings: JoinSettings = JoinSettings(), id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(doc, text_key, first, copy, n_links), one row per row of ``docs``; ``first`` and
    ``copy`` are the (doc, text_key) that stand for its class and for its equal sets."""
    doc, text_key = _keys(id_col, text_col)
    src = docs.select(doc.alias("doc"), text_key.alias("text_key"), F.col(text_col).cast("string").alias("text"))
    signed = stage(signatures(src, settings.n), "signatures")
    # rows that share id and text count once
    copies = (signed.filter("cls IS NOT NULL").groupBy("cls")
              .agg(F.min(F.struct("doc", "text_key")).alias("rep"),
                   F.count_distinct("doc", "text_key").alias("copies")))
    classes = stage(copies.select("cls", "rep.doc", "rep.text_key", "copies"), "classes")
    reps = (signed.join(classes.select("cls", "doc", "text_key"), ["cls", "doc", "text_key"], "left_semi")
            .select("cls", "sig").dropDuplicates(["cls"]))
    bands = stage(reps.mapInArrow(_band_rows, "bucket long, cls binary"), "bands")
    buckets = bands.groupBy("bucket").agg(F.count("*").alias("m")).filter("m > 1")
    sent = reps.select("cls", "sig").mapInArrow(_short_signatures, "cls binary, sig binary")
    members = (bands.join(buckets, "bucket").join(sent, "cls")
               .select("bucket", "cls", "sig", cells("bucket", F.col("m"), settings.bucket_block, "cls").alias("c"))
               .select("bucket", "cls", "sig", "c.i", "c.j"))
    near = connected_components(plausible_edges(members, settings), "cls", "other")
    near = stage(near.withColumnRenamed("node", "cls"), "near")
    sizes = near.groupBy("root").agg(F.count("*").alias("m"))
    chosen = (near.join(sizes, "root").join(classes, "cls")
              .select("cls", "doc", "text_key", "copies", F.xxhash64("root").alias("root_key"),
                      cells("root", F.col("m"), settings.set_block, "cls").alias("c"))
              .select("cls", "doc", "text_key", "copies", "root_key", "c.i", "c.j", "c.mine"))
    spread = (src.join(chosen, ["doc", "text_key"])
              .select("root_key", "i", "j", "mine", "cls", "copies", "text")
              .repartition("root_key", "i", "j").sortWithinPartitions("root_key", "i", "j"))
    checked = stage(verified(spread, settings), "verified")
    links = checked.groupBy("cls").agg(F.sum("links").alias("links"))
    final = connected_components(checked.select("cls", "other"), "cls", "other")
    own = F.struct("doc", "text_key")
    grouped = (classes.join(links, "cls", "left").join(final.withColumnRenamed("node", "cls"), "cls", "left")
               .select("cls", own.alias("copy"), "copies", F.coalesce("links", F.lit(0)).alias("links"),
                       F.coalesce("root", "cls").alias("root")))
    named = (grouped.join(grouped.groupBy("root").agg(F.min("copy").alias("first")), "root")
             .select("cls", "first", "copy", (F.col("links") + F.col("copies") - 1).alias("n_links")))
    return (signed.select("doc", "text_key", "cls").join(named, "cls", "left")
            .select("doc", "text_key", F.coalesce("first", own).alias("first"), F.coalesce("copy", own).alias("copy"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def join_documents(docs: DataFrame, settings: JoinSettings = JoinSettings(), id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(id, class_id, copy_id, n_links), one row per row of ``docs``: the smallest id of the
    documents linked directly or through others, the smallest id with an equal set, and
    the number of other documents at the threshold or above."""
    shown = lambda c: F.when(F.col(c) != LAST_ID, F.col(c))
    return classes_of(docs, settings, id_col, text_col).select(
        shown("doc").alias(id_col), shown("first.doc").alias("class_id"), shown("copy.doc").alias("copy_id"), "n_links")


def _short_signatures(batches):
    for b in batches:
        sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint32).reshape(b.num_rows, BANDS * ROWS)
        short = (sig[:, ::BANDS * ROWS // SENT] & 0xFFFF).astype(np.uint16)
        yield pa.RecordBatch.from_arrays([b.column("cls"), pa.array([x.tobytes() for x in short], pa.binary())],
                                         names=["cls", "sig"])


def keep_one(docs: DataFrame, settings: JoinSettings = JoinSettings()) -> DataFrame:
    """One document of every class, the first by id, with all its columns; of repeated rows one."""
    doc, text_key = _keys("doc_id", "text")
    stay = (classes_of(docs, settings).filter(F.struct("doc", "text_key") == F.col("first"))
            .select(F.col("doc").alias("_doc"), F.col("text_key").alias("_text_key")))
    rows = docs.select(doc.alias("_doc"), text_key.alias("_text_key"), F.struct(*docs.columns).alias("_row"))
    return (rows.join(stay, ["_doc", "_text_key"], "left_semi").dropDuplicates(["_doc", "_text_key"])
            .select("_row.*"))


def query(spark, sf_dir):
    """op4: class and number of links of every document."""
    return join_documents(table(spark, sf_dir, "documents"))


#: links of the table {docs} as CTEs up to ``label`` (doc_id, class_id) and ``nl`` (doc_id, n)
SQL_LINKS = r"""
w4 AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM {docs}),
sh AS (SELECT DISTINCT doc_id, g FROM (
         SELECT doc_id, array_to_string(ws[i:i+4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w4)
         UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w4 WHERE len(ws) BETWEEN 1 AND 4)),
sz AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pr AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
lk AS (SELECT x, y FROM pr JOIN sz p ON p.doc_id = x JOIN sz q ON q.doc_id = y WHERE 10 * k >= 8 * (p.n + q.n - k)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM {docs} UNION SELECT r.x, l.y FROM reach r JOIN lk l ON r.y = l.x),
label AS (SELECT x AS doc_id, min(y) AS class_id FROM reach GROUP BY x),
nl AS (SELECT x AS doc_id, count(*) AS n FROM lk GROUP BY x)"""

SQL = "WITH RECURSIVE " + SQL_LINKS.format(docs="documents") + r""",
same AS (SELECT l.x, l.y FROM pr l JOIN sz p ON p.doc_id = l.x JOIN sz q ON q.doc_id = l.y WHERE l.k = p.n AND l.k = q.n),
cp AS (SELECT x AS doc_id, min(y) AS y FROM same GROUP BY x)
SELECT d.doc_id, class_id, least(d.doc_id, coalesce(y, d.doc_id)) AS copy_id, coalesce(n, 0)::BIGINT AS n_links
FROM documents d JOIN label USING (doc_id) LEFT JOIN nl USING (doc_id) LEFT JOIN cp USING (doc_id)
"""
