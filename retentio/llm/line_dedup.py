"""Line dedup by content-defined line chunks.

A document is cut into chunks of lines where a rolling hash over the last
``window`` line hashes says so, never right after another cut candidate, so a
cut depends on a few lines only and insertions elsewhere do not move it.
Chunks with at least two lines that hold a word and that occur earlier
(smaller id, then smaller chunk number) are removed after their bytes have
been compared with the first occurrence.

Only 128-bit chunk keys of all chunks are shuffled; the texts of repeated
chunks alone follow, for the comparison.  Counting is pre-aggregated per
task, so a chunk that a third of all rows hold arrives once per task; the
comparison is a plain equi-join, which Spark splits where a key is hot.  Only
DataFrame functions are used.

Defined results: NULL text stays NULL with zero counts; a NULL id sorts before
all ids; rows that share an id count as one place (a chunk is not a repeat of
the same chunk number under the same id); kept chunks are joined by a line
feed, a fully removed text is empty; an empty table gives no rows; other
columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentio.llm.common import NULL_ID, let, stage, table

# Fixed values of the rolling hash: a prime modulus and a base
MODULUS, BASE = 2147483647, 1000003
REAL_LINE = r"[^\x20\x09-\x0D]"


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def chunks(text: Column, window: int = 2, divisor: int = 3) -> Column:
    """Array of (no, n_lines, n_real, text, key) of a text; NULL for a NULL text."""
    def rolling(h, i):
        total = None
        for back in range(window):
            term = F.coalesce(F.get(h, i - back), F.lit(0)) * F.lit(pow(BASE, back, MODULUS)) % MODULUS
            total = term if total is None else total + term
        return total % MODULUS % divisor == 0

    def cut(lines):
        marks = let(F.transform(lines, line_hash), lambda h: F.transform(h, lambda _, i: rolling(h, i)))
        ends = let(marks, lambda m: F.filter(F.sequence(F.lit(1), F.size(lines)), lambda i: (
            (F.get(m, i - 1) & ~F.coalesce(F.get(m, i - 2), F.lit(False))) | (i == F.size(lines)))))
        return let(ends, lambda e: F.transform(e, lambda end, k: let(
            F.coalesce(F.get(e, k - 1), F.lit(0)), lambda begin: let(
                F.slice(lines, begin + 1, end - begin), lambda part: let(
                    F.array_join(part, "\n"), lambda t: F.struct(
                        (k + 1).alias("no"), (end - begin).alias("n_lines"),
                        F.size(F.filter(part, lambda x: x.rlike(REAL_LINE))).alias("n_real"),
                        t.alias("text"), F.unhex(F.md5(t)).alias("key")))))))

    return let(F.split(text, "\n", -1), cut)


def _deduplicated(docs: DataFrame, id_col: str, text_col: str, window: int, divisor: int) -> DataFrame:
    """(_row, text, stats): every row of ``docs`` as a struct, its new text and its counts."""
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("_doc"),
                      F.col(text_col).cast("string").alias("_text"),
                      F.struct(*[c for c in docs.columns if c != text_col]).alias("_row"))
    cut = chunks(F.col("_text"), window, divisor)
    keys = stage(src.select("_doc", F.explode(F.transform(F.filter(cut, lambda c: c["n_real"] >= 2),
                                                          lambda c: F.struct(c["no"].alias("no"), c["key"].alias("key")))).alias("c"))
                 .select("_doc", "c.no", "c.key"), "chunk-keys")
    first = (keys.groupBy("key").agg(F.min(F.struct("_doc", "no")).alias("first"), F.count("*").alias("n"))
             .filter("n > 1").select("key", "first"))
    first = stage(first, "repeated-chunks")    # two stored sides: Spark may split a hot key of the join
    # every place of a repeated chunk, the first marked
    places = (keys.join(first, "key")
              .select("_doc", F.struct("no", "key", (F.struct("_doc", "no") == F.col("first")).alias("first")).alias("c"))
              .groupBy("_doc").agg(F.collect_set("c").alias("wanted")))
    texts = (src.select("_doc", "_text").join(places, "_doc")
             .select("_doc", F.explode(let(F.col("wanted"), lambda w: F.transform(
                 F.filter(cut, lambda c: F.exists(w, lambda x: (x["no"] == c["no"]) & (x["key"] == c["key"]))),
                 lambda c: F.struct(c["no"].alias("no"), c["key"].alias("key"), c["text"].alias("text"),
                                    F.exists(w, lambda x: (x["no"] == c["no"]) & x["first"]).alias("first"))))).alias("c"))
             .select("_doc", "c.*"))
    # equal keys AND equal bytes
    repeats = (texts.filter(~F.col("first")).join(texts.filter("first").select("key", "text"), ["key", "text"], "left_semi")
               .groupBy("_doc").agg(F.collect_set(F.struct("no", "key")).alias("_gone")))
    out = src.join(repeats, "_doc", "left").withColumn("_all", cut)
    gone = F.coalesce("_gone", F.array().cast("array<struct<no:int,key:binary>>"))
    out = out.withColumn("_x", let(gone, lambda g: F.transform("_all", lambda c: F.struct(
        c["n_lines"].alias("n_lines"), c["text"].alias("text"),
        F.exists(g, lambda x: (x["no"] == c["no"]) & (x["key"] == c["key"])).alias("gone")))))
    lines = lambda only_gone: F.coalesce(F.aggregate(
        F.filter("_x", lambda c: c["gone"]) if only_gone else F.col("_x"), F.lit(0).cast("long"),
        lambda a, c: a + c["n_lines"]), F.lit(0).cast("long"))
    text = F.array_join(F.transform(F.filter("_x", lambda c: ~c["gone"]), lambda c: c["text"]), "\n")
    return out.select("_row", text.alias("text"), F.struct(
        lines(False).alias("n_lines"), F.coalesce(F.size("_x"), F.lit(0)).cast("long").alias("n_chunks"),
        F.coalesce(F.size(F.filter("_x", lambda c: c["gone"])), F.lit(0)).cast("long").alias("n_removed_chunks"),
        lines(True).alias("n_removed_lines")).alias("stats"))


def remove_repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 2,
                           divisor: int = 3) -> DataFrame:
    """(id, text, n_lines, n_chunks, n_removed_chunks, n_removed_lines), one row per row of ``docs``."""
    out = _deduplicated(docs.select(id_col, text_col), id_col, text_col, window, divisor)
    return out.select(F.col(f"_row.`{id_col}`").alias(id_col), F.col("text").alias(text_col), "stats.*")


def dedup_documents(docs: DataFrame) -> DataFrame:
    """Documents with deduplicated text and all their columns; ``n_chars`` follows the text."""
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    out = _deduplicated(docs, "doc_id", "text", 2, 3)
    return out.select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def query(spark, sf_dir):
    """op1: line counts and digest of every document after line dedup."""
    out = remove_repeated_chunks(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines",
                      F.sha2("text", 256).alias("kept_sha256"))


#: chunks of the table {docs} as CTEs up to ``chunk`` (doc_id, no, n_lines, n_real, t)
SQL_CHUNKS = r"""
ln AS (SELECT doc_id, i, ls[i] AS l, ('0x' || md5(ls[i])[1:8])::BIGINT AS h
       FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i
             FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM {docs}))),
mk AS (SELECT *, (h % 2147483647 + coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0) * 1000003 % 2147483647)
                 % 2147483647 % 3 = 0 AS m FROM ln),
bd AS (SELECT *, m AND NOT coalesce(lag(m) OVER (PARTITION BY doc_id ORDER BY i), false) AS b FROM mk),
num AS (SELECT *, 1 + coalesce(sum(b::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS no FROM bd),
chunk AS (SELECT doc_id, no, count(*) AS n_lines, count(*) FILTER (regexp_matches(l, '[^\x20\x09-\x0D]')) AS n_real,
                 string_agg(l, chr(10) ORDER BY i) AS t FROM num GROUP BY doc_id, no),
judged AS (SELECT *, n_real >= 2 AND row_number() OVER (PARTITION BY t ORDER BY doc_id, no) > 1 AS gone FROM chunk)"""

SQL = "WITH " + SQL_CHUNKS.format(docs="documents") + r"""
SELECT d.doc_id, coalesce(sum(n_lines), 0)::BIGINT AS n_lines, count(no)::BIGINT AS n_chunks,
       count(*) FILTER (gone)::BIGINT AS n_removed_chunks, coalesce(sum(n_lines) FILTER (gone), 0)::BIGINT AS n_removed_lines,
       CASE WHEN any_value(text) IS NULL THEN NULL
            ELSE sha256(coalesce(string_agg(t, chr(10) ORDER BY no) FILTER (NOT gone), '')) END AS kept_sha256
FROM documents d LEFT JOIN judged j ON d.doc_id = j.doc_id GROUP BY d.doc_id
"""
