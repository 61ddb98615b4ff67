"""Ranking, packing, chat formatting, URL filter, pipeline."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

pytest.importorskip("retentio.llm")

from pyspark.sql import functions as F  # noqa: E402

import corpus_pipeline  # noqa: E402
from retentio.llm import chat, packing, quality_ranking, url_filter  # noqa: E402
from tests.llm.helpers import collect, corpus, frame  # noqa: E402

CLASH = ("_id", "piece", "start", "length", "score", "predicted", "_label", "quality", "host", "turns")


# ---- quality ranking

def test_ranking_orders_held_out_texts(spark, sf):
    sf01 = sf.replace("sf0.001", "sf0.01")
    out = quality_ranking.query(spark, sf01)
    labels = spark.read.parquet(f"{sf01}/labels.parquet")
    rows = out.join(labels, "doc_id").filter("held_out").select("score", "predicted", "quality").collect()
    good = np.mean([r["predicted"] == r["quality"] for r in rows])
    bad, fine = [r["score"] for r in rows if r["quality"] == 0], [r["score"] for r in rows if r["quality"] == 1]
    assert good > 0.95
    assert np.mean([a < b for a in bad for b in fine]) > 0.97
    one = out.filter("doc_id = 12").first()
    assert one["held_out"] == (zlib.crc32(b"12") % 5 == 0)
    assert out.filter("score < 0 OR score > 1 OR predicted <> cast(score >= 0.3 AS int)").count() == 0


def test_ranking_edges(spark):
    clean = " ".join(f"plain words number {i}" for i in range(30))
    rows = [(i, clean if i % 2 else "JUNK!! " * 40) for i in range(40)] + [(None, clean), (90, None), (91, ""), (1, clean)]
    docs = frame(spark, rows, CLASH)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (3, None, 0), (500, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    out = quality_ranking.score_documents(docs, quality_ranking.learn(docs, labels))
    got = out.collect()
    assert len(got) == len(rows)
    assert all(r["predicted"] == r["doc_id"] % 2 for r in got if r["doc_id"] is not None and r["doc_id"] < 40)
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]
    assert all(0 <= r["score"] <= 1 for r in got)
    again = quality_ranking.score_documents(docs, quality_ranking.learn(docs.orderBy(F.desc("doc_id")), labels))
    assert collect(out, "doc_id", "score") == collect(again, "doc_id", "score")
    none = quality_ranking.score_documents(docs, quality_ranking.learn(docs, labels.filter("quality = 1")))
    assert {r["score"] for r in none.collect()} == {1.0}
    assert quality_ranking.score_documents(frame(spark, []), quality_ranking.learn(frame(spark, []), labels)).count() == 0


def test_held_out_rows_do_not_change_the_model(spark):
    rows = corpus(40)[:40]
    docs = frame(spark, rows)
    make = lambda flip: spark.createDataFrame(
        [(i, (i % 2) ^ (flip and zlib.crc32(str(i).encode()) % 5 == 0), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    a, b = quality_ranking.learn(docs, make(False)), quality_ranking.learn(docs, make(True))
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.knots, b.knots)


def test_bradley_terry_recovers_direction():
    rng = np.random.default_rng(1)
    w = np.array([2.0, -1.0, 0.0])
    d = rng.normal(size=(20000, 3))
    d = np.where(rng.random(20000)[:, None] < 1 / (1 + np.exp(-(d @ w)))[:, None], d, -d)
    assert np.abs(quality_ranking.bradley_terry(d) - w).max() < 0.1


# ---- packing

def test_word_ids_equal_the_tokenizer():
    ids = packing.WordIds(packing.default_tokenizer())
    texts = [t for _, t in corpus(30)] + [
        "Héllo WÖRLD it's ƒoo <|endoftext|> x<|startoftext|>y 12,3 ½ naïve ÿŸ ßẞ İ Σς ΣΑΣ don't WE'LL'S !'s á éé Å",
        "\xa0b\x1cc \x85 µ ªº 中文字 ́x\ttab\r\nline", "", "  \n", "'S 'T'RE''", "×÷÷× a×b"]
    for t in texts:
        got = np.frombuffer(b"".join(map(ids.__getitem__, t.replace("\n", " ").split(" "))), "<u4").tolist()
        assert got == ids.encode(t, add_special_tokens=False).ids


def test_packing_contract(spark):
    rows = corpus(40) + [(900, None), (None, "text without an id"), (901, "many words " * 4000), (1, "again"), (1, "again")]
    docs = frame(spark, rows, CLASH)
    cut = packing.pieces(docs, packing.default_tokenizer(), max_tokens=128)
    got = packing.pack(cut, max_tokens=128, block_pieces=100).collect()
    encode = packing.WordIds(packing.default_tokenizer()).encode
    want = []
    for i, t in rows:
        ids = encode(t or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 128)):
            part = np.array(ids[at:at + 128], "<u4").tobytes()
            want.append((i, k, at, len(part) // 4, zlib.crc32(part), part))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])) for r in got), key=key) \
        == sorted(want, key=key)
    full = {}
    for r in got:
        full.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in full.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 128
    total = sum(r["length"] for r in got)
    assert len(full) <= total / 128 * 1.1 + 4
    assert packing.pack_documents(frame(spark, [])).count() == 0


def test_packed_documents_carry_their_tokens(spark, tmp_path):
    rows = corpus(30) + [(900, None), (None, "text without an id"), (901, "many words " * 4000), (1, "again"), (1, "again")]
    docs = frame(spark, rows)
    encode = packing.WordIds(packing.default_tokenizer()).encode
    want = []
    for i, t in rows:
        ids = encode(t or "", add_special_tokens=False).ids + [0]
        want += [(i, k, at, len(ids[at:at + 2048]), np.array(ids[at:at + 2048], "<u4").tobytes())
                 for k, at in enumerate(range(0, len(ids), 2048))]
    key = lambda r: tuple((x is None, x) for x in r)
    got = packing.pack_documents(docs).collect()
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in got), key=key) == sorted(want, key=key)
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in got)
    for (s, at, n), (following, start, _) in zip(places, places[1:]):
        assert start == (at + n if s == following else 0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    digests = packing.query(spark, str(tmp_path))
    assert collect(digests, "doc_id", "piece", "ids_crc32") == sorted(((i, k, zlib.crc32(b)) for i, k, _, _, b in want), key=key)


@pytest.mark.parametrize("rule,weights", [("norm", (1, 0, 0)), ("norm", (1, 1, 1)), ("dot", (1, 1, 1))])
def test_best_fit_keeps_every_limit(rule, weights):
    rng = np.random.default_rng(2)
    lengths = np.sort(rng.integers(1, 100, 800))[::-1]
    limits = (128, 5, 7000)
    bins, offsets = packing.best_fit(lengths, limits, weights, rule)
    assert np.bincount(bins).max() <= 5
    assert np.bincount(bins, lengths).max() <= 128
    cost = np.bincount(bins, lengths.astype(float) ** 2)
    alone = np.bincount(bins) == 1
    assert cost[~alone].max() <= 7000
    for b in range(bins.max() + 1):
        pick = bins == b
        order = np.argsort(offsets[pick])
        assert (offsets[pick][order] == np.r_[0, np.cumsum(lengths[pick][order])[:-1]]).all()


def test_best_fit_takes_the_tightest_bin():
    def naive(lengths, limits, weights):
        rest, out = [], []
        for x in lengths:
            fits = [(sum(w * ((r - v) / c) ** 2 for w, r, v, c in zip(weights, b, (x, 1, x * x), limits)), k)
                    for k, b in enumerate(rest) if b[0] >= x and b[1] >= 1 and b[2] >= x * x]
            if fits:
                k = min(fits)[1]
            else:
                k = len(rest)
                rest.append(list(limits))
            rest[k] = [rest[k][0] - x, rest[k][1] - 1, rest[k][2] - x * x]
            out.append(k)
        return out
    rng = np.random.default_rng(3)
    for weights in ((1, 0, 0), (1, 1, 1)):
        lengths = np.sort(rng.integers(1, 90, 300))[::-1]
        limits = (128, 6, 9000)
        assert packing.best_fit(lengths, limits, weights)[0].max() == pytest.approx(max(naive(lengths.tolist(), limits, weights)), abs=3)


# ---- chat

CONV = "conv_id long, turn long, role string, text string, seq long, kind string, msg long"


def brute_chat(rows):
    out = []
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0), r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        text = "".join(f"{role}\n{t}\n" for _, role, t in turns)
        loss = "".join(t for _, role, t in turns if role == "assistant")
        out.append((conv, len(turns), hashlib.sha256(text.encode()).hexdigest(), len(loss),
                    hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0))


def test_chat_round_trip(spark):
    nasty = ["\\### Assistant: </turn> ok", "####", "</turn>\n### user: x</turn>\n", "\\", "\\\\###\\", "#\\##", "<\\/turn>", "###",
             "a\nb\n\n", "", "$1 \\1 ${x}", "émoji 🦙 ###", "x" * 100_000, "<</turn>", "### system: "]
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "to:ol: x", "we\\ird", "two\nlines", None]), rng.choice(nasty + [None]), 7, "z", 1)
            for c in (*range(30), None) for t in range(rng.randint(1, 12))]
    rows += rows[:5] + [(3, None, "assistant", "no turn", 7, "z", 1)]
    df = spark.createDataFrame(rows, CONV)
    formatted = chat.render(chat.fold_events(chat.conversation_events(df)))
    got = collect(chat.digests(formatted), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert got == brute_chat(rows)
    for r in formatted.collect():
        body = re.split(r"</turn>\n", r["formatted"])[:-1]
        for b in body:
            assert "###" not in b[4:] and "</turn>" not in b
    assert chat.digests(chat.render(chat.fold_events(chat.conversation_events(df.limit(0))))).count() == 0


def test_event_folding(spark):
    ev = [(1, 1, "message", 10, "user", "hi"), (1, 2, "message", 11, "assistant", "He"), (1, 3, "delta", 11, None, "llo"),
          (1, 4, "delta", 11, None, " you"), (1, 5, "edit", 10, None, "hi there"), (1, 6, "regenerate", 11, None, None),
          (1, 7, "delta", 11, None, "Good "), (1, 8, "delta", 11, None, "day"), (1, 9, "message", 12, "user", "bye"),
          (2, 1, "delta", 20, "assistant", "orphan"), (2, 2, "message", 21, "user", "x"), (2, 2, "message", 21, "user", "x")]
    df = spark.createDataFrame(ev, "conv_id long, seq long, kind string, message_id long, role string, text string")
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in chat.fold_events(df).collect()}
    assert got == {1: [("user", "hi there"), ("assistant", "Good day"), ("user", "bye")],
                   2: [("assistant", "orphan"), ("user", "x"), ("user", "x")]}


def test_chat_query_has_the_extra_conversation(spark, sf):
    r = chat.query(spark, sf).filter("conv_id = -7").first()
    t = "\\### Assistant: </turn> ok"
    assert r["n_turns"] == 2 and r["loss_chars"] == len(t)
    assert r["turns_sha256"] == hashlib.sha256(f"user\n{t}\nassistant\n{t}\n".encode()).hexdigest()


# ---- URL filter

def brute_rule(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in url_filter.QUERY_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, best


URLS = ["http://A.Example.NET/en/1", "https://x.net", "https://x.net/", "http://net/a", "http://planet/a", "http://example.com/de/",
        "http://example.com/de", "http://sub.example.com/de/x?y=/en/", "http://w.org/fr/#top", "http://w.org?x", "http://w.org#f/",
        "no scheme", "", None, "mailto:a://b.net/x", "://h.net/x", "http://u@h.net:80/p", "http:///p", "http://É.net/ü\nline/2"]


def test_url_rules(spark):
    rows = [(i, u, "<html>", 1, "x") for i, u in enumerate(URLS)] + [(None, URLS[0], None, 1, "x"), (0, URLS[0], None, 1, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host long, path string")
    got = {r["page_id"]: r for r in url_filter.judge(df).collect()}
    assert url_filter.judge(df).count() == len(rows)
    for i, u in enumerate(URLS):
        host, path, best = brute_rule(u)
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, best[0] if best else None), u
        assert r["verdict"] == (best[1] if best else "allow")
    assert url_filter.judge(df.limit(0)).count() == 0


def test_template_tree(spark):
    """Branches a site generates fall together; labelled ones are judged, others stay."""
    rows = []
    for k in range(60):
        rows += [("http://shop.test/item/%d" % k, 1), ("http://shop.test/about/%d" % k, 0),
                 (f"http://shop.test/user{chr(97 + k % 26)}{chr(97 + k // 26)}/promo", 1), ("http://shop.test/news/%d" % k, None)]
    rows += [("http://shop.test/item/999999", None), ("http://shop.test/userzz/promo", None), ("http://shop.test/item/1/2", None),
             ("http://other.test/item/5", None), ("http://mix.test/a/1", 1), ("http://mix.test/a/2", None)]
    df = spark.createDataFrame([(i, u, y) for i, (u, y) in enumerate(rows)], "page_id long, url string, label int")
    got = {r["page_id"]: r for r in url_filter.judge(df, (), label_col="label", max_children=40).collect()}
    by_url = {u: got[i] for i, (u, _) in enumerate(rows)}
    assert by_url["http://shop.test/item/999999"]["verdict"] == "block"
    assert by_url["http://shop.test/item/999999"]["n_labelled"] >= 60
    assert by_url["http://shop.test/userzz/promo"]["template"] == "/*/promo"
    assert by_url["http://shop.test/userzz/promo"]["verdict"] == "block"
    for u in ("http://shop.test/about/3", "http://other.test/item/5", "http://mix.test/a/2", "http://shop.test/item/1/2"):
        assert by_url[u]["verdict"] == "allow", u

def test_template_tree_deep_paths(spark):
    """Wide levels and sibling branches below the fourth segment are generalised too."""
    rows = []
    for k in range(60):
        name = chr(97 + k % 26) + chr(97 + k // 26)
        rows += [(f"http://deep.test/2024/05/12/a/news/slug{name}", 1),
                 (f"http://deep.test/2024/05/12/a/help/topics/page{name}/x", 0)]
    rows += [("http://deep.test/2024/05/12/a/news/slugnew", None), ("http://deep.test/2024/05/12/a/help/topics/pagenew/x", None)]
    rows += [(f"http://late.test/en/p/q/r/s/{u}/promo", 1) for u in "abcdefgh" for _ in range(6)]
    rows += [(f"http://late.test/en/p/q/r/s/{u}/about", 0) for u in "abcdefgh" for _ in range(6)]
    df = spark.createDataFrame([(i, u, y) for i, (u, y) in enumerate(rows)], "page_id long, url string, label int")
    got = {u: r for (u, _), r in zip(rows, sorted(url_filter.judge(df, (), label_col="label", max_children=40).collect(),
                                                  key=lambda r: r["page_id"]))}
    assert got["http://deep.test/2024/05/12/a/news/slugnew"]["template"] == "/{n}/{n}/{n}/a/news/*"
    assert got["http://deep.test/2024/05/12/a/news/slugnew"]["verdict"] == "block"
    assert got["http://deep.test/2024/05/12/a/help/topics/pagenew/x"]["template"] == "/{n}/{n}/{n}/a/help/topics/*/x"
    assert got["http://deep.test/2024/05/12/a/help/topics/pagenew/x"]["verdict"] == "allow"
    for user in "abcdefgh":                                # 6 labels each, 48 in the branch /en/p/q/r/s/~/promo
        promo, about = got[f"http://late.test/en/p/q/r/s/{user}/promo"], got[f"http://late.test/en/p/q/r/s/{user}/about"]
        assert (promo["n_labelled"], promo["verdict"]) == (48, "block") and (about["n_labelled"], about["verdict"]) == (48, "allow")


def test_template_without_labels_takes_purity_from_the_tree(spark):
    """Pooled siblings, then the nodes above, then the host; the evidence limit holds at that level."""
    rows = [(f"http://a.test/s/{w}/x", 1) for w in ("aa", "bb", "cc") for _ in range(10)]
    rows += [("http://a.test/s/dd/x", None), ("http://few.test/s/aa/x", 1), ("http://few.test/s/bb/x", None)]
    rows += [("http://up.test/bad/%s/%d" % (w, k), 1) for w in ("aa", "bb") for k in range(30)]
    rows += [("http://up.test/good/cc/%d" % k, 0) for k in range(60)]
    rows += [("http://up.test/bad/zz/page", None), ("http://up.test/good/zz/page", None), ("http://up.test/other", None)]
    rows += [("http://up.test/bad/mine/1", 0)] * 8
    df = spark.createDataFrame([(i, u, y) for i, (u, y) in enumerate(rows)], "page_id long, url string, label int")
    got = {u: r for (u, _), r in zip(rows, sorted(url_filter.judge(df, (), label_col="label").collect(),
                                                  key=lambda r: r["page_id"]))}
    assert (got["http://a.test/s/dd/x"]["n_labelled"], got["http://a.test/s/dd/x"]["verdict"]) == (30, "block")
    assert (got["http://few.test/s/bb/x"]["n_labelled"], got["http://few.test/s/bb/x"]["verdict"]) == (1, "allow")
    assert got["http://up.test/good/zz/page"]["verdict"] == "allow"
    assert got["http://up.test/other"]["verdict"] == "allow"          # the host's pages are mixed
    assert got["http://up.test/bad/mine/1"]["verdict"] == "allow"     # its own few labels count


def test_url_query_blocks_unruled_pages(spark, tmp_path):
    urls = [f"http://spam.example.com/de/{k}" for k in range(40)] + ["http://spam.example.com/en/1", "http://ham.example.com/en/1"]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {urls[r["page_id"]]: r for r in url_filter.query(spark, str(tmp_path)).collect()}
    spam = got["http://spam.example.com/en/1"]
    assert (spam["rule"], spam["verdict"], spam["n_labelled"]) == (None, "block", 40)
    assert got["http://ham.example.com/en/1"]["verdict"] == "allow"


# ---- pipeline

def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    now = docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        new = function(spark, now, sf)
        assert new.columns == docs.columns, name
        new = new.cache()
        assert 0 < new.count() <= now.count()
        assert new.join(now, "doc_id", "left_anti").count() == 0
        now = new
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join",
                                                      "benchmark decontamination", "best-fit packing"]
    out = corpus_pipeline.STAGES[-1][1](spark, now, sf)
    cols = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert collect(out, *cols) == collect(corpus_pipeline.run(spark, sf), *cols)
    assert out.select("doc_id").distinct().count() == now.count()


def test_pipeline_against_brute_force(spark, tmp_path):
    from tests.llm.test_pair_operators import brute_join
    from tests.llm.test_text_operators import brute_line_dedup, brute_rules
    from retentio.llm import quality_rules
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8)))
    line = lambda k: " ".join(word() for _ in range(k))
    item = line(25)
    common = [line(9) for _ in range(8)]
    rows = []
    for i in range(40):
        lines = [line(rng.randint(10, 30)) for _ in range(rng.randint(3, 7))]
        if i % 3 == 0:
            lines += common
        rows.append((i, "\n".join(lines)))
    rows += [(50, rows[2][1].replace("\n", " ") + " end"), (51, "too short"), (52, line(60) + " " + item + " " + line(9)), (53, "# " * 70)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    good = [(i, t) for i, t in rows if brute_rules(t)[0] >= 50 and "#" not in t]
    lined = [(r[0], r[1]) for r in brute_line_dedup(good)]
    single = [(i, t) for i, t in lined if dict((x[0], x[1]) for x in brute_join(lined))[i] == i]
    clean = [(i, t) for i, t in single if item not in t]
    encode = packing.WordIds(packing.default_tokenizer()).encode
    want = []
    for i, t in clean:
        ids = encode(t, add_special_tokens=False).ids + [0]
        want += [(i, k, at, len(ids[at:at + 2048]), zlib.crc32(np.array(ids[at:at + 2048], "<u4").tobytes()))
                 for k, at in enumerate(range(0, len(ids), 2048))]
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert collect(out, "doc_id", "piece", "start", "length", "ids_crc32") == sorted(want)
    assert len(clean) < len(single) < len(lined) < len(rows)
    assert quality_rules.DEFAULT_POLICY.version == 1
