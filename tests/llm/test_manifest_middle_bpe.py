"""Merkle manifest, fill-in-middle and byte-level BPE against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

pytest.importorskip("retentio.llm")

from pyspark.sql import functions as F  # noqa: E402

from retentio.llm import byte_bpe, fill_in_middle, merkle_manifest  # noqa: E402
from tests.llm.helpers import corpus, frame  # noqa: E402

CLASH = ("_id", "n", "form", "output", "leaf", "grp", "pos", "path", "ids", "offsets", "decoded", "_text", "item", "src", "digest")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- Merkle manifest

def brute_leaf(row, fields):
    out = ""
    for f in fields:
        v = row[f]
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(out)


def brute_tree(digests, fanout):
    """(root, path of every leaf)"""
    nodes = [(d, [i]) for i, d in enumerate(digests)]
    paths = [[] for _ in digests]
    while len(nodes) > 1:
        up = []
        for a in range(0, len(nodes), fanout):
            run = nodes[a:a + fanout]
            for k, (_, under) in enumerate(run):
                left, right = "".join(d for d, _ in run[:k]), "".join(d for d, _ in run[k + 1:])
                for i in under:
                    paths[i].append((left, right))
            up.append((sha("".join(d for d, _ in run)), [i for _, under in run for i in under]))
        nodes = up
    return nodes[0][0], paths


def brute_manifest(rows, fields, fanout):
    """{(id, leaf): set of (subroot, root, path)}"""
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, brute_leaf(r, fields), r["doc_id"]))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: brute_tree([d for _, _, d, _ in sorted(groups[s], key=lambda g: g[:3])], fanout) for s in order}
    root, above = brute_tree([trees[s][0] for s in order], fanout)
    out = []
    for j, s in enumerate(order):
        for (_, _, leaf, i), path in zip(sorted(groups[s], key=lambda g: g[:3]), trees[s][1]):
            out.append((i, leaf, trees[s][0], root, "".join(a + b for a, b in path + above[j])))
    return sorted(out, key=str)


def hex_rows(manifest):
    rows = manifest.select("doc_id", *[merkle_manifest.hexed(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")], "path",
                           (merkle_manifest.fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok")).collect()
    assert all(r["ok"] for r in rows)
    return sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"],
                    "".join(p["left"].hex() + p["right"].hex() for p in r["path"])) for r in rows), key=str)


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_manifest_equals_brute_force(spark, fanout):
    rng = random.Random(fanout)
    sources = [None, "", "a", "Z", "é", "hot", "hot", "hot", "hot"]
    rows = [(i, t, rng.choice(["en", None]), rng.choice(sources), rng.choice([None, 5])) for i, t in corpus(90)]
    rows += [(None, None, None, None, None)] * 12 + [(None, "x", "en", "hot", 1)] * 7 + [(3, "other", "en", "hot", 1)] * 2
    rows += [(-5, "lone", "en", "only", 4)]
    docs = frame(spark, [], CLASH)
    docs = spark.createDataFrame([(*r, *[7] * len(CLASH)) for r in rows], docs.schema).repartition(7)
    want = brute_manifest(docs.collect(), merkle_manifest.FIELDS, fanout)
    assert hex_rows(merkle_manifest.build(docs, fanout=fanout)) == want


def test_manifest_of_few_rows(spark):
    assert merkle_manifest.build(frame(spark, [])).count() == 0
    one = frame(spark, [(1, "a")])
    row = merkle_manifest.build(one).first()
    assert row["leaf"] == row["subroot"] == row["root"] and row["path"] == []
    proof = merkle_manifest.build(one).select(merkle_manifest.proof(F.col("path"))).first()[0]
    assert proof == sha("")
    same = frame(spark, [(None, None)] * 50)
    assert hex_rows(merkle_manifest.build(same)) == brute_manifest(same.collect(), merkle_manifest.FIELDS, 3)
    with pytest.raises(ValueError):
        merkle_manifest.build(one, fanout=1)


def test_manifest_finds_tampering(spark, sf):
    out = merkle_manifest.query(spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(out) == len(texts) and len({r["root"] for r in out}) == 1
    for r in out:
        hit = zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and "\n" in (texts[r["doc_id"]] or "")
        assert r["verified"] == (not hit) == (r["folded_root"] == r["root"])
    assert {r["verified"] for r in out} == {True, False}


# ---- fill-in-middle

UNITS = re.compile("[A-Za-z]+|[^A-Za-z]")


def brute_middle(i, text, epoch=1):
    text = text or ""
    units = UNITS.findall(text)
    digest = sha(f"{epoch}:{'' if i is None else i}")
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return i, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return i, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return i, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_middle_equals_brute_force(spark):
    rng = random.Random(4)
    rows = corpus(80)
    rows += [(200 + k, "".join(rng.choice("ab<>PSM \n\r \\${}é漢😀\x00") for _ in range(rng.randint(0, 40)))) for k in range(300)]
    rows += [(None, "no id at all"), (None, None), (600, None), (601, "<P>"), (602, "a <S> b"), (603, "x<M>"), (1, rows[1][1]),
             (604, "wort " * 60_000), (605, "\n" * 100_000), (606, "z" * 200_000), (607, "$1\\2 <P <S <M " * 500), (608, "😀" * 30_000)]
    rows += [(700 + k, "short text with words") for k in range(40)]
    out = fill_in_middle.transform(frame(spark, rows, CLASH))
    got = out.withColumn("back", fill_in_middle.restore(F.col("output"), F.col("form"))).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted((brute_middle(*r) for r in rows), key=key)
    assert sorted(r["back"] for r in got) == sorted(t or "" for _, t in rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_middle_parameters(spark):
    rows = [(i, "one two three four") for i in range(60)]
    forms = lambda **p: {r["form"] for r in fill_in_middle.transform(frame(spark, rows), **p).collect()}
    assert forms(plain_percent=100) == {"plain"}
    assert forms(plain_percent=0, spm_percent=100) == {"spm"}
    assert forms(plain_percent=0, spm_percent=0) == {"psm"}
    cuts = [{(r["doc_id"], r["output"]) for r in fill_in_middle.transform(frame(spark, rows), epoch=e).collect()} for e in (1, 1, 2)]
    assert cuts[0] == cuts[1] != cuts[2]
    assert fill_in_middle.transform(frame(spark, [])).count() == 0


# ---- byte-level BPE

def library(name="byte_bpe_multi_50k.tiktoken"):
    import public_tokenizers as P
    import tiktoken
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.load_ranks(P.path(name)), special_tokens={})


def hard_texts(n=4000, seed=5):
    rng = random.Random(seed)
    alphabet = list("aabst'' '  \n\t revlmd1٣²Ⅷ,.!é漢字😀́\x1c　\xa0Ᲊ\U00010d40\x00")
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return out + ["", " ", "  ", "\n", "'", "'s", "''s", " 's", "a's't'll've", "'re", "'r", "'l", "x 'll", "\n's", " \n's", "\t\ta",
                  "a" * 5000, "'" * 300, " " * 500, "1" * 700, "漢" * 900, "ab" * 2000, "\r\n\r\n x", "trail  "]


def test_encoding_equals_the_library(spark):
    texts = hard_texts() + [t for _, t in corpus(60)]
    rows = [*enumerate(texts), (None, "no id"), (-1, None), (3, texts[3])]
    for name in (None, "byte_bpe_50k.tiktoken"):
        path = None
        if name:
            import public_tokenizers as P
            path = P.path(name)
        encoding = library(name or "byte_bpe_multi_50k.tiktoken")
        out = byte_bpe.encode(frame(spark, rows, CLASH), path)
        got = byte_bpe.decode(out, path).join(out.select("doc_id", "ids", "offsets").distinct(), ["doc_id", "ids"]).collect()
        assert len(got) == len(rows) - 1                         # the NULL id does not join
        want = dict(rows)
        for r in got:
            text = want[r["doc_id"]] or ""
            ids = np.frombuffer(r["ids"], "<u4").tolist()
            assert ids == encoding.encode_ordinary(text) and r["n_tokens"] == len(ids)
            assert bytes(r["decoded"]) == text.encode()
            ends = np.cumsum([0] + [len(encoding.decode_single_token_bytes(t)) for t in ids])
            assert np.frombuffer(r["offsets"], "<u4").tolist() == ends[:-1].tolist()


def test_runs_scan_and_merge(spark, monkeypatch):
    rng = np.random.default_rng(1)
    product = byte_bpe.automaton()[0]
    for n in (1, 2, 63, 64, 65, 4096, 5000):
        x = rng.integers(0, 17, n).astype(np.uint8)
        want, state = [], byte_bpe.NOTHING
        for f in x:
            state = product[state, f]
            want.append(state)
        for width in (64, 2):                                    # equal functions may have two numbers
            assert product[byte_bpe.NOTHING][byte_bpe.scan(x, width)].tolist() == want
    for a in range(len(product)):                                # composition is associative
        assert (product[product[a]] == product[a][product]).all()
    vocabulary = byte_bpe.PieceIds(byte_bpe.default_ranks())
    pieces = [bytes(rng.choice(list(b"abcdes etion\xc3\xa9"), rng.integers(1, 60)).tolist()) for _ in range(800)]
    for p in pieces:
        assert byte_bpe._merge_short(p, vocabulary.ranks) == byte_bpe._merge_long(p, vocabulary.ranks)
    texts = [t.encode() for t in hard_texts(500)]
    limits = np.append(0, np.cumsum([len(t) for t in texts]))
    ids, _, bounds = byte_bpe.encode_run(b"".join(texts), limits, vocabulary)
    alone = [byte_bpe.encode_run(t, np.array([0, len(t)]), vocabulary)[0] for t in texts]
    assert all((ids[a:b] == w).all() and b - a == len(w) for a, b, w in zip(bounds, bounds[1:], alone))
    assert list(byte_bpe._runs(np.array([0, 5, 5, 100, 101]), 10)) == [(0, 2), (2, 3), (3, 4)]
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 5)
    forgetful = byte_bpe.PieceIds(byte_bpe.default_ranks())
    assert (byte_bpe.encode_run(b"".join(texts), limits, forgetful)[0] == ids).all() and len(forgetful) <= 5


def test_encoding_edges(spark, sf):
    assert byte_bpe.decode(byte_bpe.encode(frame(spark, []))).count() == 0
    long = "wörter und 123 zahlen, \n" * 120_000                  # longer than a run
    row = byte_bpe.decode(byte_bpe.encode(frame(spark, [(1, long), (2, ""), (None, None)]))).orderBy(F.desc("doc_id")).collect()
    assert [r["n_tokens"] for r in row[1:]] == [len(library().encode_ordinary(long)), 0] and row[0]["n_tokens"] == 0
    out = {r["doc_id"]: r for r in byte_bpe.query(spark, sf).collect()}
    encoding = library()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = encoding.encode_ordinary(r["text"] or "")
        assert out[r["doc_id"]]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert out[r["doc_id"]]["decoded_sha256"] == sha(r["text"] or "")
