"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

An item is found in a document if some passage is within
``floor((1 - similarity) * n)`` word edits of the item's ``n`` normalised words
(lower case, letters and digits).

1. *Item-sized windows.*  A passage with at most e edits keeps a run of at
   least ``ceil((n - e) / (e + 1))`` item words unchanged, so only windows
   aligned with such a shared run can match; this loses nothing.
2. *CGK embedding.*  Item and window walk through their words: at step j the
   current word is written and, if random bit j of that word is set, the walk
   moves on.  With the same random bits, few edits give few differing places
   among the 3n written ones.
3. *Bit-sampling LSH.*  Each of R repetitions draws new bits and samples
   ``samples`` places; a window whose samples equal the item's is a candidate.
   Collisions at the largest allowed number of edits are measured for each item
   length on edited copies of the items, with the windows of step 1, and R is
   chosen for the length so that a passage is found with probability ``recall``.
   A length that needs more than ``max_repeats`` has all its windows verified.
4. *Exact verification.*  The word edit distance between the item and the best
   passage around the window.

One narrow pass over whole texts: items (at most ``block_items`` at a time,
in blocks beyond that) travel to the documents, nothing is shuffled.

Defined results: NULL and empty texts and items match nothing; NULL ids stay
NULL; repeated rows of either side are reported as often as they occur; empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentio.llm.common import list_values, mix64, table, window_hashes

PAD = np.uint64(0xFFFFFFFFFFFFFFFF)

# Measuring the repetitions: edited copies a length, seeds a copy
COPIES, SEEDS = 40, 32


@dataclass(frozen=True)
class Settings:
    similarity: float = 0.8
    recall: float = 0.99
    samples: int = 2            # embedded places that must agree in one repetition
    max_repeats: int = 64
    block_items: int = 5_000


def normalised_hashes(text: Column) -> Column:
    """64-bit codes of the normalised words of a text."""
    found = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(found, lambda w: F.xxhash64(w))


def allowed_edits(n: int, similarity: float) -> int:
    return int((1 - similarity) * n + 1e-9)


def shared_run(n: int, e: int) -> int:
    """Length of a run of item words that ``e`` edits leave unchanged, 8 at most."""
    return min(8, max(1, math.ceil((n - e) / (e + 1))))


def embed(codes: np.ndarray, begin: np.ndarray, n: np.ndarray, seed, steps: int) -> np.ndarray:
    """(rows, steps) CGK embedding of the words ``codes[begin:begin+n]``; PAD after the last word.
    ``seed`` is one number or one a row."""
    out = np.empty((len(begin), steps), np.uint64)
    at = np.zeros(len(begin), np.int64)
    last = len(codes) - 1
    seeds = np.atleast_1d(np.asarray(seed, np.uint64)) << np.uint64(20)
    for j in range(steps):
        word = np.where(at < n, codes[np.minimum(begin + at, last)], PAD)
        out[:, j] = word
        salt = mix64(seeds + np.uint64(j + 1))
        at += (mix64(word ^ salt) & np.uint64(1)).astype(np.int64)
    return out


def sampled_places(n: int, seed: int, samples: int) -> np.ndarray:
    return np.random.default_rng((n, seed)).integers(0, 3 * n, samples)


def edit_distances(items: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Edits between each item (rows, n) and the closest passage of its text (rows, m)."""
    rows, n = items.shape
    m = texts.shape[1]
    place = np.arange(m + 1)
    d = np.zeros((rows, m + 1), np.int32)                  # a passage may start anywhere
    for i in range(n):
        new = np.empty_like(d)
        new[:, 0] = i + 1
        np.minimum(d[:, 1:] + 1, d[:, :-1] + (items[:, i:i + 1] != texts), out=new[:, 1:])
        d = np.minimum.accumulate(new - place, axis=1) + place      # words left out of the item's passage
    return d.min(axis=1)


@dataclass
class Block:
    """Items prepared for the pass: their words, shared-run tables and embeddings."""

    ids: list
    codes: list                                            # one array of word codes per item
    settings: Settings
    runs: dict = field(default_factory=dict)               # run length -> (hashes, item, offset), sorted
    repeats: dict = field(default_factory=dict)            # item length -> repetitions; None: verify all windows

    def __post_init__(self):
        by_run: dict[int, list] = {}
        for k, c in enumerate(self.codes):
            n = len(c)
            e = allowed_edits(n, self.settings.similarity)
            q = shared_run(n, e)
            h = window_hashes(c, q)
            by_run.setdefault(q, []).append((h, np.full(len(h), k), np.arange(len(h))))
        for q, parts in by_run.items():
            h, k, o = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(h, kind="stable")
            self.runs[q] = (h[order], k[order], o[order])
        self.repeats = self._measured_repeats()
        self.flat = np.concatenate(self.codes) if self.codes else np.empty(0, np.uint64)
        self.n = np.array([len(c) for c in self.codes], np.int64)
        self.begin = np.cumsum(self.n) - self.n

    def _measured_repeats(self) -> dict:
        """Repetitions for the wanted recall by item length.  Lengths within a few percent share
        the figure of the one among them with the highest share of edits."""
        by_length: dict[int, list] = {}
        for c in self.codes:
            by_length.setdefault(len(c), []).append(c)
        edits = {n: allowed_edits(n, self.settings.similarity) for n in by_length}
        out = {n: 1 for n in by_length if edits[n] == 0}       # equal words have equal embeddings
        classes: dict[int, list] = {}
        for n in by_length.keys() - out.keys():
            classes.setdefault(n if n <= 32 else 32 + int(math.log(n / 32) / math.log(1.08)) + 1, []).append(n)
        for part in classes.values():
            hardest = max(part, key=lambda n: (edits[n] / n, n))
            out.update(dict.fromkeys(part, self._repeats_for(by_length[hardest], edits[hardest])))
        return out

    def _repeats_for(self, items: list, e: int) -> int | None:
        """Repetitions that find copies of the items (of one length) with ``e`` edits, in other text,
        with probability ``recall``; the mean is over the copies, whose rates differ."""
        rng = np.random.default_rng(11)
        rates = []
        for c in (items[i * len(items) // COPIES] for i in range(COPIES)):
            n = len(c)
            edited = c.tolist()
            for _ in range(e):
                p = int(rng.integers(0, len(edited)))
                kind = rng.integers(0, 3)
                edited[p:p + (kind != 1)] = [] if kind == 2 else [int(rng.integers(1, 1 << 62))]
            around = rng.integers(1, 1 << 62, 2 * n).astype(np.uint64)
            text = np.concatenate([around[:n], np.array(edited, np.uint64), around[n:]])
            q = shared_run(n, e)
            own, h = window_hashes(c, q), window_hashes(text, q)
            order = np.argsort(own, kind="stable")
            first = np.searchsorted(own[order], h, "left")
            count = np.searchsorted(own[order], h, "right") - first
            pick = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
            starts = np.unique(np.repeat(np.arange(len(h)), count) - order[pick])
            both = np.concatenate([c, text])
            begin = np.concatenate([[0], n + np.maximum(starts, 0)])
            size = np.minimum(n, len(both) - begin)
            hits = 0
            together = max(1, 8_000_000 // (len(begin) * 3 * n))       # seeds in one walk, bounded in memory
            for lo in range(1000, 1000 + SEEDS, together):
                seeds = np.arange(lo, min(lo + together, 1000 + SEEDS))
                row_seed = np.repeat(seeds, len(begin))
                x = embed(both, np.tile(begin, len(seeds)), np.tile(size, len(seeds)), row_seed, 3 * n)
                at = np.stack([sampled_places(n, int(k), self.settings.samples) for k in seeds])
                x = np.take_along_axis(x, np.repeat(at, len(begin), axis=0), axis=1).reshape(len(seeds), len(begin), -1)
                hits += int((x[:, 1:] == x[:, :1]).all(axis=2).any(axis=1).sum())
            rates.append((hits + 0.5) / (SEEDS + 1))
        miss = 1 - np.array(rates)
        for r in range(1, self.settings.max_repeats + 1):
            if (miss ** r).mean() <= 1 - self.settings.recall:
                return r
        return None

    def search(self, flat: np.ndarray, offsets: np.ndarray):
        """(document row, item, edits, start) of every item found in a batch."""
        flat = flat.view(np.uint64)
        row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        rows, items, starts = [], [], []
        for q, (known, item, offset) in self.runs.items():
            table_bits = np.zeros(1 << 20, bool)
            table_bits[(known >> np.uint64(44)).astype(np.int64)] = True
            for lo in range(0, max(0, len(flat) - q + 1), 1 << 20):
                h = window_hashes(flat[lo:lo + (1 << 20) + q - 1], q)
                at = np.flatnonzero(table_bits[(h >> np.uint64(44)).astype(np.int64)])
                first = np.searchsorted(known, h[at], "left")
                count = np.searchsorted(known, h[at], "right") - first
                at, first, count = at[count > 0] + lo, first[count > 0], count[count > 0]
                inside = row_of[at] == row_of[at + q - 1]
                at, first, count = at[inside], first[inside], count[inside]
                pick = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
                pos = np.repeat(at, count)
                rows.append(row_of[pos])
                items.append(item[pick])
                starts.append(pos - offset[pick])
        if not rows:
            return []
        rows, items, starts = (np.concatenate(x) for x in (rows, items, starts))
        found = np.unique(np.stack([rows, items, starts], 1), axis=0)
        out: dict[tuple[int, int], tuple[int, int]] = {}
        for lo in range(0, len(found), 20_000):
            self._verify(flat, offsets, self._candidates(flat, offsets, found[lo:lo + 20_000]), out)
        return [(r, k, *v) for (r, k), v in sorted(out.items())]

    def _candidates(self, flat, offsets, found):
        """Windows that agree with their item in the sampled places of some repetition."""
        rows, items, starts = found.T
        begin = np.maximum(starts, offsets[rows])
        n = np.maximum(0, np.minimum(starts + self.n[items], offsets[rows + 1]) - begin)
        hit = np.zeros(len(found), bool)
        sizes = np.unique(self.n[items]).tolist()
        for size in sizes:
            if self.repeats[size] is None:
                hit |= self.n[items] == size
        for seed in range(max((self.repeats[size] or 0 for size in sizes), default=0)):
            for size in sizes:
                if seed >= (self.repeats[size] or 0):
                    continue
                todo = np.flatnonzero(~hit & (self.n[items] == size))
                if not len(todo):
                    continue
                s = sampled_places(size, seed, self.settings.samples)
                steps = int(s.max()) + 1
                own, which = np.unique(items[todo], return_inverse=True)
                a = embed(self.flat, self.begin[own], self.n[own], seed, steps)[:, s]
                b = embed(flat, begin[todo], n[todo], seed, steps)[:, s]
                hit[todo] = (a[which] == b).all(axis=1)
        return found[hit]

    def _verify(self, flat, offsets, found, out):
        """Exact edit distance of the candidates; the best per (document, item) is kept."""
        rows, items, starts = found.T
        for size in np.unique(self.n[items]):
            e = allowed_edits(int(size), self.settings.similarity)
            pick = np.flatnonzero(self.n[items] == size)
            for lo in range(0, len(pick), 2_000):
                p = pick[lo:lo + 2_000]
                place = starts[p][:, None] - e + np.arange(size + 2 * e)[None, :]
                inside = (place >= offsets[rows[p]][:, None]) & (place < offsets[rows[p] + 1][:, None])
                text = np.where(inside, flat[place.clip(0, len(flat) - 1)], PAD)
                item = self.flat[self.begin[items[p]][:, None] + np.arange(size)[None, :]]
                edits = edit_distances(item, text)
                for r, k, d, at in zip(rows[p].tolist(), items[p].tolist(), edits.tolist(),
                                       (starts[p] - offsets[rows[p]]).tolist()):
                    if d <= e and (d, at) < out.get((r, k), (1 << 60, 0)):
                        out[(r, k)] = (d, at)


def find_items(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
               text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item, n_words, edits, start_word): every benchmark item that a document holds,
    with the closest passage's edits and the window it was found by."""
    item_type = benchmark.schema[item_col].dataType
    src = docs.select(F.col(id_col).alias("_id"), normalised_hashes(F.col(text_col).cast("string")).alias("h"))
    schema = T.StructType([src.schema["_id"], T.StructField("_item", item_type), T.StructField("n_words", T.IntegerType()),
                           T.StructField("edits", T.IntegerType()), T.StructField("start_word", T.LongType())])
    out = None
    for block in _blocks(benchmark, settings, item_col, item_text):
        part = src.mapInArrow(_searcher(block, item_type), schema)
        out = part if out is None else out.unionByName(part)
    return out.withColumnsRenamed({"_id": id_col, "_item": item_col})


def _blocks(benchmark: DataFrame, settings: Settings, item_col: str, item_text: str):
    """The items in blocks of about ``block_items``, one block on the driver at a time."""
    items = benchmark.select(F.col(item_col).alias("item"), normalised_hashes(F.col(item_text)).alias("h")) \
        .filter(F.size("h") > 0)
    blocks = max(1, -(-items.count() // settings.block_items))
    for number in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).toArrow()
        ids = part.column("item").to_pylist()
        flat, offsets = list_values(part.column("h"))
        order = sorted(range(len(ids)), key=lambda i: (str(ids[i]), flat[offsets[i]:offsets[i + 1]].tolist()))
        yield Block([ids[i] for i in order], [flat[offsets[i]:offsets[i + 1]].view(np.uint64) for i in order], settings)


def _searcher(block: Block, item_type):
    from pyspark.sql.pandas.types import to_arrow_type
    kind = to_arrow_type(item_type)

    def search(batches):
        for b in batches:
            flat, offsets = list_values(b.column("h"))
            found = block.search(flat, offsets) if len(block.ids) and len(flat) else []
            yield pa.RecordBatch.from_arrays(
                [b.column("_id").take(pa.array([x[0] for x in found], pa.int64())),
                 pa.array([block.ids[x[1]] for x in found], kind),
                 pa.array([len(block.codes[x[1]]) for x in found], pa.int32()),
                 pa.array([x[2] for x in found], pa.int32()), pa.array([x[3] for x in found], pa.int64())],
                names=["_id", "_item", "n_words", "edits", "start_word"])

    return search


def clean_documents(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Documents that hold no benchmark item, with all columns; one narrow pass per block."""
    out = docs
    for block in _blocks(benchmark, settings, "item_id", "text"):
        src = out.select(F.struct(*docs.columns).alias("_row"),
                         normalised_hashes(F.col("text").cast("string")).alias("h"))
        out = src.mapInArrow(_without(block), T.StructType([src.schema["_row"]])).select("_row.*")
    return out


def _without(block: Block):
    def keep(batches):
        for b in batches:
            flat, offsets = list_values(b.column("h"))
            stay = np.ones(b.num_rows, bool)
            stay[[x[0] for x in block.search(flat, offsets)] if len(block.ids) and len(flat) else []] = False
            yield pa.RecordBatch.from_arrays([b.column("_row").filter(pa.array(stay))], names=["_row"])

    return keep


def query(spark, sf_dir):
    """op3: benchmark items found in the documents."""
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
