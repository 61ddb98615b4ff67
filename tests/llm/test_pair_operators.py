"""N-gram join, connected components, decontamination."""

import itertools
import random

import numpy as np
import pytest

pytest.importorskip("retentio.llm")

from retentio.llm import components, decontamination, ngram_join  # noqa: E402
from tests.llm.helpers import collect, corpus, frame, vocabulary, words  # noqa: E402

CLASH = ("doc", "text_key", "cls", "first", "copy", "_row", "h", "item_id")


def grams(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute_join(rows):
    """(id, class, copy, links) by comparing all pairs; ids not NULL and different."""
    sets = {i: grams(t) for i, t in rows}
    links = {i: set() for i in sets}
    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 10 * len(x & y) >= 8 * len(x | y):
            links[a].add(b)
            links[b].add(a)
    out = []
    for i in sets:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        copy = min([j for j in links[i] if sets[j] == sets[i]] + [i])
        out.append((i, min(seen), copy, len(links[i])))
    return sorted(out)


def near_rows(seed=5):
    """Chains and groups of near copies around the threshold."""
    rng, vocab = random.Random(seed), vocabulary()
    rows = []
    for g in range(6):
        w = [rng.choice(vocab) for _ in range(rng.randint(30, 200))]
        for _ in range(rng.randint(3, 12)):
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((1000 + len(rows), " ".join(w)))
    return rows


def test_join_matches_brute_force(spark):
    rows = corpus(60, 11) + near_rows()
    out = ngram_join.join_documents(frame(spark, rows, CLASH))
    got = collect(out, "doc_id", "class_id", "copy_id", "n_links")
    assert got == brute_join(rows)
    assert sum(r[3] > 0 for r in got) > 30


def test_join_in_small_blocks(spark):
    rows = near_rows(6)
    settings = ngram_join.JoinSettings(bucket_block=3, set_block=2)
    got = collect(ngram_join.join_documents(frame(spark, rows), settings), "doc_id", "class_id", "copy_id", "n_links")
    assert got == brute_join(rows)


def test_join_edges(spark):
    text = "one two three four five six seven"
    rows = [(1, text), (1, text), (2, text), (None, text), (None, "alone in the world"), (3, None), (4, ""), (5, ""),
            (6, "one"), (7, "one"), (8, "word " * 20000)]
    got = collect(ngram_join.join_documents(frame(spark, rows, CLASH)), "doc_id", "class_id", "copy_id", "n_links")
    assert got == [(1, 1, 1, 2), (1, 1, 1, 2), (2, 1, 1, 2), (3, 3, 3, 0), (4, 4, 4, 0), (5, 5, 5, 0), (6, 6, 6, 1),
                   (7, 6, 6, 1), (8, 8, 8, 0), (None, 1, 1, 2), (None, None, None, 0)]
    kept = ngram_join.keep_one(frame(spark, rows, CLASH))
    assert kept.columns == frame(spark, [], CLASH).columns
    assert collect(kept, "doc_id") == [(1,), (3,), (4,), (5,), (6,), (8,), (None,)]
    assert ngram_join.join_documents(frame(spark, [])).count() == 0
    assert ngram_join.keep_one(frame(spark, [])).count() == 0


def test_needed_matches_is_the_posterior():
    rng = np.random.default_rng(2)
    j = rng.random(2_000_000)
    m = rng.binomial(16, j)
    k = ngram_join.needed_matches(16, 0.8, 0.01)
    assert (j[m == k] >= 0.8).mean() >= 0.008 and (j[m == k - 1] >= 0.8).mean() < 0.012
    assert ngram_join.needed_matches(64, 0.8, 1e-6) < 45


def test_minhash_estimates_jaccard():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 62, 1000, dtype=np.uint64)
    b = a.copy()
    b[:100] = rng.integers(0, 1 << 62, 100, dtype=np.uint64)
    s = ngram_join.minhash(np.concatenate([a, b]), np.array([0, 1000]))
    assert abs((s[0] == s[1]).mean() - 900 / 1100) < 0.12


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)]
    edges += [(200, x) for x in range(201, 260)] + [(300, 300)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(collect(components.connected_components(df, "a", "b"), "node", "root"))
    assert got == {x: find(x) for x in parent}
    assert components.connected_components(df.limit(0), "a", "b").count() == 0


# ---- decontamination

def edit_distance(item, text):
    d = [0] * (len(text) + 1)
    for i, x in enumerate(item):
        prev, d[0] = d[0], i + 1
        for j, y in enumerate(text):
            prev, d[j + 1] = d[j + 1], min(d[j + 1] + 1, d[j] + 1, prev + (x != y))
    return min(d)


def test_edit_distances():
    rng = np.random.default_rng(1)
    items, texts = rng.integers(0, 4, (50, 12)).astype(np.uint64), rng.integers(0, 4, (50, 30)).astype(np.uint64)
    got = decontamination.edit_distances(items, texts)
    assert got.tolist() == [edit_distance(a.tolist(), b.tolist()) for a, b in zip(items, texts)]


def test_shared_run_bound():
    """e edits leave a run of at least the length that the search relies on."""
    rng = random.Random(1)
    for n in range(1, 70):
        e = decontamination.allowed_edits(n, 0.8)
        q = max(1, -(-(n - e) // (e + 1)))
        for _ in range(50):
            gone = set(rng.sample(range(n), e))
            runs = "".join("x" if i in gone else "." for i in range(n)).split("x")
            assert max(map(len, runs)) >= q


def leaky(spark, trials=300, edits=0.8):
    """Documents with an edited benchmark item, and clean ones."""
    rng, vocab = random.Random(8), vocabulary(3000)
    items = [(k, " ".join(rng.choice(vocab) for _ in range(rng.randint(10, 60)))) for k in range(40)]
    rows, planted = [], set()
    for i in range(trials):
        prose = [rng.choice(vocab) for _ in range(rng.randint(20, 200))]
        if i % 3:
            k, text = rng.choice(items)
            w = text.split(" ")
            for _ in range(int(edits * decontamination.allowed_edits(len(w), 0.8))):
                p, kind = rng.randrange(len(w)), rng.randrange(3)
                w[p:p + (kind != 1)] = [] if kind == 2 else [rng.choice(vocab)]
            at = rng.randint(0, len(prose))
            prose[at:at] = [x.upper() + "," for x in w]
            planted.add((i, k))
        rows.append((i, " ".join(prose)))
    return rows, items, planted


def test_decontamination_finds_edited_items(spark):
    rows, items, planted = leaky(spark)
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontamination.find_items(frame(spark, rows, CLASH[:-1]), bench)
    got = {(r["doc_id"], r["item_id"]): r for r in out.collect()}
    assert len(planted - set(got)) <= 0.02 * len(planted)
    assert set(got) <= planted                            # clean documents stay clean
    norm = lambda t: "".join(c.lower() if c.isalnum() else " " for c in t).split()
    texts, by_item = dict(rows), dict(items)
    for (d, k), r in itertools.islice(got.items(), 60):
        exact = edit_distance(norm(by_item[k]), norm(texts[d]))
        assert r["edits"] == exact and r["n_words"] == len(norm(by_item[k]))


def test_decontamination_in_blocks_and_stage(spark):
    rows, items, planted = leaky(spark, 60, 0)
    rows += [(None, items[0][1]), (900, None), (901, ""), (902, "pad " * 20000 + items[1][1]), (902, "pad")]
    bench = spark.createDataFrame(items + [(77, None), (78, ""), (items[1][0], items[1][1])], "item_id long, text string")
    settings = decontamination.Settings(block_items=7)
    found = collect(decontamination.find_items(frame(spark, rows), bench, settings), "doc_id", "item_id")
    assert set(found) == planted | {(None, 0), (902, 1)}
    kept = decontamination.clean_documents(frame(spark, rows, CLASH), bench, settings)
    assert kept.columns == frame(spark, [], CLASH).columns
    assert collect(kept, "doc_id") == sorted([(i,) for i, _ in rows if i is not None and i < 900 and i % 3 == 0]
                                             + [(900,), (901,), (902,)])
    nothing = bench.limit(0)
    assert decontamination.find_items(frame(spark, rows), nothing).count() == 0
    assert decontamination.clean_documents(frame(spark, rows), nothing).count() == len(rows)
    assert decontamination.find_items(frame(spark, []), bench).count() == 0


@pytest.mark.parametrize("kind", ["short", "long", "mixed"])
def test_decontamination_recall_at_all_allowed_edits(kind):
    """More than 200 items of differing lengths, the shortest first, copies with the largest number of edits."""
    rng = np.random.default_rng(4)
    sizes = {"short": [3, 4, 5, 10, 15] * 50, "long": [120, 200] * 110, "mixed": [3] * 110 + [4] * 110 + [60, 200] * 60}[kind]
    codes = [rng.integers(1, 1 << 62, n).astype(np.uint64) for n in sizes]
    block = decontamination.Block(list(range(len(codes))), codes, decontamination.Settings())
    texts, planted = [], []
    for k, c in enumerate(codes):
        for _ in range(2):
            w = c.tolist()
            for _ in range(decontamination.allowed_edits(len(c), 0.8)):
                p, what = int(rng.integers(0, len(w))), int(rng.integers(0, 3))
                w[p:p + (what != 1)] = [] if what == 2 else [int(rng.integers(1, 1 << 62))]
            planted.append((len(texts), k))
            texts.append(np.concatenate([rng.integers(1, 1 << 62, 40).astype(np.uint64), np.array(w, np.uint64),
                                         rng.integers(1, 1 << 62, 40).astype(np.uint64)]))
    got = {(r, k) for r, k, _, _ in block.search(np.concatenate(texts).view(np.int64),
                                                 np.cumsum([0] + [len(t) for t in texts]))}
    for size in set(sizes):
        want = [x for x in planted if sizes[x[1]] == size]
        assert len(got & set(want)) >= 0.97 * len(want), size
