"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger row keeps the raw
measurements and one ``failed`` bit per rule.  A policy is a named, versioned
set of rules: applying it is one bitwise AND, and its ablations (how many
documents each rule alone holds back) are one aggregate over the ledger.

Defined results: a NULL text has no words and zero measurements; a NULL id is
kept as NULL; repeated rows each get their own ledger row; an empty table
gives an empty ledger; other columns of the input are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentio.llm.common import WORD

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_exclaim", "n_capitals")

# Fixed values of the base rules: at least 50 words, at most half of them in
# repeated three-word windows; symbols are the characters # * $ % & | < >
BASE_RULES = ("too_short", "repeated_words")
SYMBOLS = "#*$%&|<>"

#: rule name -> condition over the measurements under which a document fails
RULES = {
    "too_short": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbol_heavy": "100 * n_symbols > 10 * n_words",
    "exclaiming": "100 * n_exclaim > 50 * n_words",
    "shouting": "100 * n_capitals > 50 * word_chars",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "no_spaces": "word_chars > 40 * n_words",
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A versioned choice of rules; a document is kept if none of them failed."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BITS[r] for r in self.rules)


BASE_POLICY = Policy("base", 1, BASE_RULES)
DEFAULT_POLICY = Policy("default", 1, tuple(RULES))

_WORD = re.compile(WORD)
_SPACE = " \t\n\x0b\x0c\r"


def _repeat_words(words: list[str]) -> int:
    """Words inside three-word windows that occur twice or more in the text."""
    if len(words) < 4:
        return 0
    seen: dict[str, int] = {}
    code = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    n = len(seen)
    pair = code[:-1] * n + code[1:]
    if n > 2_000_000:          # three codes no longer fit 63 bits: number the pairs first
        pair = np.unique(pair, return_inverse=True)[1]
    key = pair[:-1] * n + code[2:]
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    again = count[inverse] > 1
    covered = np.zeros(len(words), bool)
    covered[:-2] |= again
    covered[1:-1] |= again
    covered[2:] |= again
    return int(covered.sum())


def _measure(text: str | None) -> tuple[int, ...]:
    if not text:
        return (0,) * len(MEASURES)
    words = _WORD.findall(text)
    lines = [x for x in text.split("\n") if x.strip(_SPACE)]
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), _repeat_words(words), len(lines),
            text.count("!"), len(re.findall("[A-Z]", text)))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, the measurements, ``failed`` (rule bits).

    The measurements come from one pass over the whole text in Arrow batches;
    the rules are column expressions over them.  Any column may serve as id,
    also a struct of a whole row."""
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    schema = T.StructType([src.schema["_id"], *(T.StructField(m, T.LongType()) for m in MEASURES)])

    def measure(batches):
        for b in batches:
            found = [_measure(t.as_py()) for t in b.column("_text")]
            cols = np.array(found, np.int64).reshape(len(found), len(MEASURES))
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), *(pa.array(cols[:, i]) for i in range(len(MEASURES)))], names=["_id", *MEASURES])

    failed = F.lit(0).cast("long")
    for name, rule in RULES.items():
        failed = failed + F.when(F.expr(rule), F.lit(BITS[name]).cast("long")).otherwise(F.lit(0).cast("long"))
    return src.mapInArrow(measure, schema).select(F.col("_id").alias(id_col), *MEASURES, failed.alias("failed"))


def fails(policy: Policy) -> Column:
    return F.col("failed").bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def apply_policy(rows: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Ledger rows with ``kept`` under ``policy``."""
    return rows.withColumn("kept", ~fails(policy))


def ablations(rows: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Per rule of the policy: documents that fail it, and documents that only
    this rule holds back (they would return if it were dropped).  One aggregate."""
    hit = F.col("failed").bitwiseAND(F.lit(policy.mask).cast("long"))
    sums = []
    for r in policy.rules:
        bit = F.lit(BITS[r]).cast("long")
        sums += [F.count_if(hit.bitwiseAND(bit) != 0).alias(f"f_{r}"), F.count_if(hit == bit).alias(f"o_{r}")]
    one = rows.agg(*sums)
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(policy.name).alias("policy"), F.lit(policy.version).alias("version"),
                 F.lit(r).alias("rule"), F.col(f"f_{r}").alias("n_failed"), F.col(f"o_{r}").alias("n_only"))
        for r in policy.rules])).alias("x")).select("x.*")


def keep_documents(docs: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """The documents that pass the policy, with all their columns."""
    rows = ledger(docs.select(F.struct(*docs.columns).alias("_row"), "text"), "_row")
    return rows.filter(~fails(policy)).select("_row.*")


def query(spark, sf_dir):
    """op9: measurements, base verdict and verdict of the default policy."""
    from retentio.llm.common import table
    rows = apply_policy(ledger(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       fails(BASE_POLICY).alias("base_failed"), "kept", "failed")


SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
tri AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
ln AS (SELECT doc_id, l FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM w)
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n FROM ln GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
         coalesce(cov.n, 0) AS n_repeat_words, coalesce(dup.n_lines, 0) AS n_lines,
         length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclaim,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals
  FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN dup USING (doc_id)),
b AS (
  SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
         + 4 * (100 * n_symbols > 10 * n_words)::BIGINT + 8 * (100 * n_exclaim > 50 * n_words)::BIGINT
         + 16 * (100 * n_capitals > 50 * word_chars)::BIGINT + 32 * (100 * n_dup_lines > 50 * n_lines)::BIGINT
         + 64 * (word_chars > 40 * n_words)::BIGINT AS failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed FROM b
"""
