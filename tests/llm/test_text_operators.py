"""Quality rules, line dedup, substring dedup, licence scan."""

import hashlib
from collections import Counter

import pytest

pytest.importorskip("retentio.llm")

from pyspark.sql import functions as F  # noqa: E402

from retentio.llm import license_scan, line_dedup, quality_rules, substring_dedup  # noqa: E402
from tests.llm.helpers import collect, corpus, frame, words  # noqa: E402

CLASH = ("key", "kind", "failed", "n_words", "stats", "_row", "_text", "_doc", "c", "h")


# ---- quality rules

def brute_rules(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    count = Counter(tri)
    covered = {i + k for i, g in enumerate(tri) if count[g] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_ledger_matches_brute_force(spark):
    rows = corpus() + [(900, None), (None, "x y z x y z"), (901, "#a |b| <c> & $ % *\n#a |b|\n" * 30)]
    got = collect(quality_rules.ledger(frame(spark, rows, CLASH)), "doc_id", *quality_rules.MEASURES[:5])
    assert got == sorted(((i, *brute_rules(t)) for i, t in rows), key=lambda r: tuple((x is None, x) for x in r))


def test_policies_and_ablations(spark):
    rows = [(1, "word " * 60), (2, " ".join(f"w{i}" for i in range(60))), (3, "a b"), (4, " ".join(f"#w{i}" for i in range(60)))]
    led = quality_rules.ledger(frame(spark, rows))
    assert collect(quality_rules.apply_policy(led), "doc_id", "kept") == [(1, False), (2, True), (3, False), (4, False)]
    only_short = quality_rules.Policy("short", 2, ("too_short",))
    assert collect(quality_rules.apply_policy(led, only_short), "doc_id", "kept") == [(1, True), (2, True), (3, False), (4, True)]
    abl = {r["rule"]: (r["n_failed"], r["n_only"]) for r in quality_rules.ablations(led).collect()}
    assert abl["too_short"] == (1, 1) and abl["repeated_words"] == (1, 1) and abl["symbol_heavy"] == (1, 1)
    assert abl["shouting"] == (0, 0)


def test_keep_documents_keeps_columns_and_rows(spark):
    good = " ".join(f"w{i}" for i in range(80))
    rows = [(1, good), (1, good), (2, "short"), (None, good), (3, None)]
    out = quality_rules.keep_documents(frame(spark, rows, CLASH))
    assert out.columns == frame(spark, [], CLASH).columns
    assert collect(out, "doc_id") == [(1,), (1,), (None,)]
    assert quality_rules.keep_documents(frame(spark, [])).count() == 0


# ---- line dedup

def brute_chunks(text):
    if text is None:
        return []
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    p = line_dedup.MODULUS
    mark = [(h[i] % p + (h[i - 1] if i else 0) * line_dedup.BASE % p) % p % 3 == 0 for i in range(len(h))]
    out, cur = [], []
    for i, x in enumerate(lines):
        cur.append(x)
        if mark[i] and not (i and mark[i - 1]):
            out.append(cur)
            cur = []
    return out + ([cur] if cur else [])


def brute_line_dedup(rows):
    first = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        for no, c in enumerate(brute_chunks(t)):
            if sum(bool(words(x)) for x in c) >= 2:
                first.setdefault("\n".join(c), (i, no))
    out = []
    for i, t in rows:
        cs = brute_chunks(t)
        gone = ["\n".join(c) in first and first["\n".join(c)] != (i, no) for no, c in enumerate(cs)]
        out.append((i, None if t is None else "\n".join("\n".join(c) for c, g in zip(cs, gone) if not g),
                    sum(map(len, cs)), len(cs), sum(gone)))
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


def test_line_dedup_matches_brute_force(spark):
    rows = corpus() + [(900, None), (None, corpus()[3][1]), (901, "long line " * 3000 + "\n" + corpus()[5][1])]
    out = line_dedup.remove_repeated_chunks(frame(spark, rows, CLASH))
    got = collect(out, "doc_id", "text", "n_lines", "n_chunks", "n_removed_chunks")
    assert got == brute_line_dedup(rows)
    assert sum(r[4] for r in got) > 10


def test_line_dedup_documents_and_edges(spark):
    text = "\n".join(f"line {i} of many" for i in range(40))
    rows = [(1, text), (1, text), (2, text)]
    out = line_dedup.dedup_documents(frame(spark, rows, CLASH))
    assert out.columns == frame(spark, [], CLASH).columns
    got = collect(out, "doc_id", "text", "n_chars", "failed")
    assert got[0] == got[1] == (1, text, len(text), 7)          # repeated rows are one place
    assert got[2][0] == 2 and len(got[2][1]) < 60 and got[2][2] == len(got[2][1])
    assert line_dedup.dedup_documents(frame(spark, [])).count() == 0


def test_cuts_resist_insertions():
    import random
    rng = random.Random(5)
    lines = [f"line {rng.random()}" for _ in range(200)]
    a = {"\n".join(c) for c in brute_chunks("\n".join(lines))}
    b = {"\n".join(c) for c in brute_chunks("\n".join(lines[:50] + ["new"] + lines[50:]))}
    assert len(a - b) <= 3


# ---- substring dedup

def brute_substrings(rows, window=20):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    first = {}
    texts = [(i, words(t)) for i, t in rows]
    for i, w in texts:
        for k in range(len(w) - window + 1):
            g = tuple(w[k:k + window])
            if g not in first or (first[g][0] == i and k < first[g][1]):
                first[g] = (i, k)
    out = []
    for i, w in texts:
        gone = {k + x for k in range(len(w) - window + 1) if first[tuple(w[k:k + window])] != (i, k) for x in range(window)}
        out.append((i, " ".join(x for k, x in enumerate(w) if k not in gone), len(w), len(gone)))
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("seed", [3, 4])
def test_substring_dedup_matches_brute_force(spark, seed):
    base = corpus(50, seed)
    long = " ".join(t for _, t in base[:20])
    rows = base + [(900, None), (None, base[7][1]), (901, long * 3), (902, base[2][1]), (902, base[2][1]),
                   (903, "same " * 300), (904, "a b c d e f g " * 60)]
    out = substring_dedup.remove_repeats(frame(spark, rows, CLASH), shard_words=500)
    got = collect(out, "doc_id", "text", "n_words", "n_removed")
    assert got == brute_substrings(rows)
    assert sum(r[3] for r in got) > 1000


def test_substring_dedup_small_batches(spark):
    """Keys and kinds that run across Arrow batches."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = corpus(40, 9)
        got = collect(substring_dedup.remove_repeats(frame(spark, rows)), "doc_id", "text", "n_words", "n_removed")
        assert got == brute_substrings(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_substring_dedup_empty(spark):
    assert substring_dedup.remove_repeats(frame(spark, [])).count() == 0
    got = collect(substring_dedup.remove_repeats(frame(spark, [(1, None), (2, "")])), "doc_id", "text", "n_words", "n_removed")
    assert got == [(1, "", 0, 0), (2, "", 0, 0)]


def test_query_digest(spark, sf):
    row = substring_dedup.query(spark, sf).orderBy("doc_id").first()
    text = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").first()["text"]
    assert row["kept_sha256"] == hashlib.sha256(" ".join(words(text)).encode()).hexdigest()


# ---- licences

def test_license_scan(spark):
    t = license_scan.TEMPLATES
    rows = [(1, "Prose here.\n" + t["MIT"] + "\nmore prose follows"), (2, t["Apache-2.0"].upper().replace(",", " ;")),
            (3, "This work is licensed under the GNU General Public License, version 2."), (4, None), (5, ""),
            (None, t["CC-BY-NC-4.0"]), (6, "license"), (7, t["MIT grant"].replace("copy, modify", "copy,\nmodify")),
            (8, "nothing about it " * 2000), (1, t["MIT"])]
    got = collect(license_scan.scan(frame(spark, rows, ("unit", "dice", "u", "license"))), "doc_id", "unit", "line_no", "license")
    assert got == [(1, "line", 1, "MIT"), (1, "line", 2, "MIT"), (2, "line", 1, "Apache-2.0"), (3, "line", 1, "GPL-2.0"),
                   (7, "text", 0, "MIT grant"), (None, "line", 1, "CC-BY-NC-4.0")]
    assert license_scan.scan(frame(spark, [])).count() == 0


def test_license_versions(spark):
    t = license_scan.TEMPLATES
    rows = [(1, t["GPL-2.0 header"]), (2, t["GPL-3.0 header"]), (3, t["LGPL-2.1"]), (4, t["LGPL-3.0"]),
            (5, t["GPL-3.0"].replace("3", "4")), (6, "Some prose before.\n" + t["GPL-2.0 header"] + "\nand after it")]
    got = collect(license_scan.scan(frame(spark, rows)), "doc_id", "unit", "line_no", "license")
    assert got == [(1, "line", 1, "GPL-2.0 header"), (2, "line", 1, "GPL-3.0 header"), (3, "line", 1, "LGPL-2.1"),
                   (4, "line", 1, "LGPL-3.0"), (6, "line", 2, "GPL-2.0 header"), (6, "text", 0, "GPL-2.0 header")]


def test_license_size_bounds_lose_nothing():
    for a in range(1, 60):
        for b in range(1, 60):
            least, most = license_scan.size_bounds(b, 0.8)
            assert (least <= a <= most) == (20 * min(a, b) >= 8 * (a + b))


def test_license_passages(spark):
    """Notices that wrap inside a longer text, or lie inside a longer line; the version has to agree."""
    import textwrap
    t = license_scan.TEMPLATES
    prose = "A paragraph about something else that goes on for quite some time before it ends. " * 4
    other = " ".join(f"word{k}" for k in range(200))
    wrapped = textwrap.fill(t["MIT grant"], 70)
    rest = ("\nThe above copyright notice and this permission notice shall be included in all copies.\n"
            "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO\n"
            "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.")
    rows = [(1, "MIT License\n\nCopyright (c) 2020 Someone\n\n" + wrapped + rest), (2, prose + t["MIT"] + " " + prose),
            (3, prose + t["GPL-2.0"] + " " + prose), (4, other + "\n" + textwrap.fill(t["GPL-3.0 header"], 60) + "\n" + other),
            (5, prose), (6, prose + t["MIT"] + " " + prose + t["MIT"]), (7, prose + t["GPL-3.0"].replace("3", "7") + " " + prose)]
    got = collect(license_scan.scan(frame(spark, rows)), "doc_id", "unit", "line_no", "license", "dice")
    assert got == [(1, "passage", 5, "MIT grant", 1.0), (2, "passage", 1, "MIT", 1.0), (3, "passage", 1, "GPL-2.0", 1.0),
                   (4, "passage", 2, "GPL-3.0 header", 1.0), (6, "passage", 1, "MIT", 1.0), (6, "passage", 1, "MIT", 1.0)]


def test_license_dice_value(spark):
    text = "Released under the new MIT License."
    got = license_scan.scan(frame(spark, [(1, text)]), threshold=0.5).first()
    a, b = set(license_scan.template_bigrams(text)), set(license_scan.template_bigrams(license_scan.TEMPLATES["MIT"]))
    assert got["license"] == "MIT" and got["dice"] == pytest.approx(2 * len(a & b) / (len(a) + len(b)))
    assert license_scan.scan(frame(spark, [(1, text)]).filter(F.lit(False))).count() == 0
