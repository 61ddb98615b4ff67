"""Fill-in-middle transformation by a counted-quantifier regex.

A text is a run of units, words of ASCII letters and single other characters.
``regexp_count`` gives their number n, two draws give the cuts a <= b, and a pattern
of the row itself, ``(unit{a}+)(unit{b-a}+)(rest)``, takes prefix, middle and suffix
in one match, whose replacement is the output.  The counted groups are possessive:
the engine runs them as a loop, so neither stack nor time grows by backtracking on
a long text.  Draws are digits of a hash of (epoch, id), so a retried task draws the
same cuts.

Texts that hold a marker stay plain, so each marker stands once in an output, and
``restore`` is exact.

Defined results: NULL text is empty and stays plain; a NULL id draws as the empty
string; repeated rows give repeated rows; other columns are ignored; an empty table
gives no rows.  One narrow pass of DataFrame functions, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentio.llm.common import table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = "[A-Za-z]++|[^A-Za-z]"


def draw(digest: Column, k: int) -> Column:
    """The k-th group (from 0) of 8 hex digits as an unsigned number."""
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def cut(text: Column, a: Column, b: Column, output: str) -> Column:
    """``output`` with $1, $2 and $3 for the first ``a`` units, those up to ``b``, and the rest."""
    pattern = F.concat(F.lit(rf"(?s)\A((?:{UNIT}){{"), a.cast("string"), F.lit(rf"}}+)((?:{UNIT}){{"),
                       (b - a).cast("string"), F.lit(r"}+)(.*+)\z"))
    return F.regexp_replace(text, pattern, F.lit(output))


def transform(docs: DataFrame, epoch: int = 1, plain_percent: int = 10, spm_percent: int = 20,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output): every text in the form drawn for it."""
    key = F.concat(F.lit(f"{epoch}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = (docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"),
                        F.sha2(key, 256).alias("_h"))
            .withColumn("n", F.regexp_count("_text", F.lit(UNIT)).cast("long")))
    x, y = (F.pmod(draw(F.col("_h"), k), F.col("n") + 1) for k in (0, 1))
    marked = F.contains("_text", F.lit(PREFIX)) | F.contains("_text", F.lit(SUFFIX)) | F.contains("_text", F.lit(MIDDLE))
    plain = (F.col("_text") == "") | marked | (F.pmod(draw(F.col("_h"), 2), F.lit(100)) >= 100 - plain_percent)
    form = (F.when(plain, "plain").when(F.pmod(draw(F.col("_h"), 3), F.lit(100)) < spm_percent, "spm").otherwise("psm"))
    rows = rows.withColumn("form", form).withColumn("_a", F.least(x, y)).withColumn("_b", F.greatest(x, y))
    text, a, b = F.col("_text"), F.col("_a"), F.col("_b")
    rows = rows.withColumn("output", F.when(F.col("form") == "psm", cut(text, a, b, f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2"))
                           .when(F.col("form") == "spm", cut(text, a, b, f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")).otherwise(text))
    at = {m: F.instr("output", m).cast("long") for m in (PREFIX, SUFFIX, MIDDLE)}
    follows = F.when(F.col("form") == "psm", at[SUFFIX]).when(F.col("form") == "spm", at[MIDDLE])
    return rows.select(id_col, "n", "form", (follows - at[PREFIX] - len(PREFIX)).alias("prefix_chars"),
                       F.when(F.col("form") != "plain", F.length("output") - at[MIDDLE] - len(MIDDLE) + 1).cast("long")
                       .alias("middle_chars"), "output")


def restore(output: Column, form: Column) -> Column:
    """The text from which an output was made."""
    psm = F.regexp_replace(output, rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*+)\z", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*+)\z", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def query(spark, sf_dir):
    """op12: every document in fill-in-middle form, and the text read back from it."""
    return transform(table(spark, sf_dir, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256(concat('1:', doc_id)) AS h FROM documents),
u AS (
  SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units FROM d),
c AS (
  SELECT *, len(units) AS n,
    concat('0x', substr(h, 1, 8))::BIGINT % (len(units) + 1) AS x, concat('0x', substr(h, 9, 8))::BIGINT % (len(units) + 1) AS y,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
           OR concat('0x', substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
         WHEN concat('0x', substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (
  SELECT *, array_to_string(list_slice(units, 1, least(x, y)), '') AS pre,
    array_to_string(list_slice(units, least(x, y) + 1, greatest(x, y)), '') AS mid,
    array_to_string(list_slice(units, greatest(x, y) + 1, n), '') AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', pre, '<S>', suf, '<M>', mid)
         ELSE concat('<S>', suf, '<P>', pre, '<M>', mid) END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p
"""
