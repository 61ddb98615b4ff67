"""Substring dedup with repeated-phrase automata.

A window is ``window`` consecutive words of a document; every word covered by
a window whose word sequence also starts earlier (smaller id, or same id and
earlier start) is removed.  Three steps, none of which shuffles all windows:

1. *Recurring passages.*  Every window has an anchor: the smallest hash of its
   ``anchor``-word runs.  Equal windows have equal anchors, so windows that
   share an anchor are cut into segments (runs of windows with one anchor,
   about a ninth of the words) and only segments are shuffled, by anchor.
   Each Arrow batch first keeps its own first segment of every kind, so a
   passage that a third of all rows hold arrives once per batch.  A segment
   equal to an earlier one is covered by it; where one anchor has different
   segments (the rims of copies), their first ones are taken apart into
   windows, which are compared in the same way.
2. *Phrases.*  The earlier occurrence of every covered span is read from its
   document: the confirmed recurring phrase, as words.
3. *Automata.*  Phrases travel to the documents that should hold them.  Each
   task compiles shards of Aho-Corasick automata over word codes (blocks of
   ``window // 2`` words, of which every window holds one whole; at most
   ``shard_words`` words a shard), streams the documents through, extends
   every hit to the longest equal run, and removes what such runs of
   ``window`` words or more cover.  Only this exact match removes a word.

Defined results: NULL text has no words; a NULL id sorts before all ids and
comes back as NULL; rows that share an id are one document to the order (a
window of one covers the other only if it starts at an earlier word); an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentio.llm.common import (NULL_ID, WORD, list_values, mix64, sliding_min, stage, table, window_hashes,
                                 word_hashes, words)

_WORD = re.compile(WORD)
_CANDIDATE = "key long, kind long, doc long, start int, n int, source long, source_start int"
_SPAN = "doc long, start int, n int, source long, source_start int"
_FIELDS = ("key", "kind", "doc", "start", "n", "source", "source_start")

#: windows that one vector pass handles
CHUNK = 1 << 20


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _batch(names, arrays, masks=None) -> pa.RecordBatch:
    masks = masks or {}
    types = {"start": pa.int32(), "n": pa.int32(), "source_start": pa.int32()}
    return pa.RecordBatch.from_arrays(
        [pa.array(a, types.get(k, pa.int64()), mask=masks.get(k)) for k, a in zip(names, arrays)], names=list(names))


def _join_runs(doc, start, n, source, source_start):
    """Spans in (doc, start) order that continue one another on both sides become one."""
    order = np.lexsort((start, doc))
    doc, start, n, source, source_start = (a[order] for a in (doc, start, n, source, source_start))
    if not len(doc):
        return doc, start, n, source, source_start
    new = np.ones(len(doc), bool)
    new[1:] = ((doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + n[:-1]) | (source[1:] != source[:-1])
               | (source_start[1:] != source_start[:-1] + n[:-1]))
    at = np.flatnonzero(new)
    return doc[at], start[at], np.add.reduceat(n, at), source[at], source_start[at]


def _reduce(key, kind, doc, start, n):
    """The first row of every (key, kind) as a candidate, the others as spans covered by it."""
    order = np.lexsort((start, doc, kind, key))
    key, kind, doc, start, n = (a[order] for a in (key, kind, doc, start, n))
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (kind[1:] != kind[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0)) if len(key) else np.empty(0, np.int64)
    rest = ~new & ((doc != doc[first]) | (start != start[first])) if len(key) else new
    spans = _join_runs(doc[rest], start[rest], n[rest], doc[first][rest], start[first][rest])
    yield _batch(_FIELDS, [key[new], kind[new], doc[new], start[new], n[new], doc[new], start[new]],
                 {"source": np.ones(new.sum(), bool), "source_start": np.ones(new.sum(), bool)})
    if len(spans[0]):
        yield _batch(_FIELDS, [_signed(mix64(spans[0].view(np.uint64))), np.zeros(len(spans[0]), np.int64), *spans])


def _segments(flat, offsets, ids, window, anchor):
    """Segments of a batch of documents, chunk by chunk: key = anchor, kind = the segment's words."""
    flat = flat.view(np.uint64)
    doc_of_first = np.repeat(np.arange(len(ids)), np.diff(offsets))
    for at in range(0, len(flat) - window + 1, CHUNK):
        h = flat[at:at + CHUNK + window - 1]
        m = len(h) - window + 1
        row = doc_of_first[at:at + m]
        valid = row == doc_of_first[at + window - 1:at + window - 1 + m]
        whole = window_hashes(h, window)
        least = sliding_min(window_hashes(h, anchor), window - anchor + 1)
        change = np.ones(m, bool)
        change[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1]) | (valid[1:] != valid[:-1])
        run = np.flatnonzero(change)[np.cumsum(change) - 1]
        change |= (np.arange(m) - run) % (window - anchor + 1) == 0
        begin = np.flatnonzero(change)
        # a segment that repeats within itself (a short period) is taken apart into windows
        periodic = np.zeros(m, bool)
        for d in range(1, min(window - anchor + 1, m)):
            periodic[:-d] |= whole[:-d] == whole[d:]
        if periodic.any():
            change |= np.logical_or.reduceat(periodic, begin)[np.cumsum(change) - 1]
            begin = np.flatnonzero(change)
        n = np.diff(np.append(begin, m))
        ok = valid[begin]
        begin, n = begin[ok], n[ok]
        with np.errstate(over="ignore"):
            kind = mix64(whole[begin] * np.uint64(0xD6E8FEB86659FD93) + whole[begin + n - 1] + n.astype(np.uint64))
        yield _signed(least[begin]), _signed(kind), ids[row[begin]], (begin + at - offsets[row[begin]]), n


def _first_of_kind(batches):
    """Rows sorted by (key, kind, doc, start), in a stream: every row that is not the
    first of its kind is a span (tag 0); the firsts of keys with several kinds come
    out as well (tag 1).  Holds one row between batches."""
    last_key = last_kind = None
    first = held = None          # first row of the current kind; the first of the current key if its only one
    names = ("tag", "doc", "start", "n", "source", "source_start")
    for b in batches:
        if not b.num_rows:
            continue
        source = b.column("source")
        done = source.is_valid().to_numpy(zero_copy_only=False)
        key, kind, doc, start, n = (b.column(c).to_numpy() for c in ("key", "kind", "doc", "start", "n"))
        if done.any():
            yield _batch(names, [np.zeros(done.sum(), np.int64), doc[done], start[done], n[done],
                                 source.filter(pa.array(done)).to_numpy(),
                                 b.column("source_start").filter(pa.array(done)).to_numpy()])
            key, kind, doc, start, n = (a[~done] for a in (key, kind, doc, start, n))
        if not len(key):
            continue
        new_key = np.ones(len(key), bool)
        new_key[1:] = key[1:] != key[:-1]
        new_key[0] = key[0] != last_key if last_key is not None else True
        new_kind = new_key.copy()
        new_kind[1:] |= kind[1:] != kind[:-1]
        new_kind[0] |= kind[0] != last_kind
        index = np.maximum.accumulate(np.where(new_kind, np.arange(len(key)), -1))
        early = index < 0                                  # their kind began in an earlier batch
        f_doc, f_start = doc[index], start[index]
        if early.any():
            f_doc, f_start = f_doc.copy(), f_start.copy()
            f_doc[early], f_start[early] = first
        rest = ~new_kind & ((doc != f_doc) | (start != f_start))
        if rest.any():
            yield _batch(names, [np.zeros(rest.sum(), np.int64), doc[rest], start[rest], n[rest], f_doc[rest], f_start[rest]])
        # keys with several kinds
        group = np.cumsum(new_key)                         # 0: the key that was open before
        kinds = np.bincount(group, weights=new_kind, minlength=group[-1] + 1).astype(int)
        many = kinds > 1
        if kinds[0] and last_key is not None:
            many[0] = True                                 # the open key already had one
            if held is not None:
                yield _batch(names, [np.array([x]) for x in (1, *held, 0, 0)])
                held = None
        out = new_kind & many[group]
        if out.any():
            z = np.zeros(out.sum(), np.int64)
            yield _batch(names, [z + 1, doc[out], start[out], n[out], z, z])
        if group[-1] > 0:
            held = None
            if not many[-1]:
                at = np.flatnonzero(new_key)[-1]
                held = (doc[at], start[at], n[at])
        last_key, last_kind = key[-1], kind[-1]
        if index[-1] >= 0:
            first = (doc[index[-1]], start[index[-1]])


def _spans_by_document(rows: DataFrame) -> DataFrame:
    """(tag, doc, ...) rows -> joined spans, dealt out by document."""
    def join(batches):
        for b in batches:
            tag = b.column("tag").to_numpy()
            cols = [b.column(c).to_numpy().astype(np.int64) for c in ("doc", "start", "n", "source", "source_start")]
            for t in (0, 1):
                pick = tag == t
                if pick.any():
                    if t:      # a first of its kind has no source: runs go by their own place
                        cols[3], cols[4] = np.zeros(len(tag), np.int64), cols[1]
                    runs = _join_runs(*[c[pick] for c in cols])
                    yield _batch(("tag", "doc", "start", "n", "source", "source_start"),
                                 [np.full(len(runs[0]), t), *runs])

    schema = "tag long, " + _SPAN
    return (rows.repartition("doc").sortWithinPartitions("doc", "tag", "start")
            .mapInArrow(join, schema))


def _compare(candidates: DataFrame) -> DataFrame:
    """Candidates -> spans and, tagged 1, firsts of keys with several kinds."""
    return (candidates.repartition("key").sortWithinPartitions("key", "kind", "doc", "start")
            .mapInArrow(_first_of_kind, "tag long, " + _SPAN))


def recurring_spans(docs: DataFrame, window: int = 20, anchor: int = 5) -> DataFrame:
    """(doc, start, n, source, source_start): the ``n`` windows from ``start`` on have
    equal hashes to those of ``source`` from ``source_start`` on, an earlier place.
    ``docs`` has ``doc`` (long, not null) and ``text``."""
    hashed = docs.select("doc", word_hashes(F.col("text")).alias("h"))

    def cut(batches):
        for b in batches:
            flat, offsets = list_values(b.column("h"))
            for columns in _segments(flat, offsets, b.column("doc").to_numpy(), window, anchor):
                yield from _reduce(*columns)

    found = stage(_spans_by_document(_compare(hashed.mapInArrow(cut, _CANDIDATE))), "segments")

    def windows(batches):
        for b in batches:
            flat, offsets = list_values(b.column("h"))
            flat = flat.view(np.uint64)
            ids = b.column("doc").to_numpy()
            starts, sizes = [], []
            runs = b.column("runs")
            for i, spans in enumerate(runs.to_pylist()):
                for s in spans:
                    starts.append(offsets[i] + s["start"])
                    sizes.append(s["n"])
            starts, sizes = np.array(starts, np.int64), np.array(sizes, np.int64)
            row = np.repeat(np.arange(len(ids)), [len(x) for x in runs.to_pylist()])
            at = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            row = np.repeat(row, sizes)
            for lo in range(0, len(at), CHUNK):
                p, r = at[lo:lo + CHUNK], row[lo:lo + CHUNK]
                a, z = p.min(), p.max() + window
                h = flat[a:z]
                key = window_hashes(h, window)[p - a]
                kind = window_hashes(h, window, 0xC2B2AE3D27D4EB4F)[p - a]
                yield from _reduce(_signed(key), _signed(kind), ids[r], p - offsets[r], np.ones(len(p), np.int64))

    rims = (found.filter("tag = 1").groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start", "n"))).alias("runs")))
    rim_windows = (docs.join(rims, "doc").select("doc", word_hashes(F.col("text")).alias("h"), "runs")
                   .mapInArrow(windows, _CANDIDATE))
    rim_spans = _compare(rim_windows).filter("tag = 0")
    spans = _spans_by_document(found.filter("tag = 0").unionByName(rim_spans))
    return spans.select("doc", "start", "n", "source", "source_start")


class PhraseShard:
    """An Aho-Corasick automaton over the words of a bounded set of phrases."""

    def __init__(self, window: int):
        import ahocorasick
        self.window, self.block = window, window // 2
        self.code: dict[str, int] = {}
        self.phrases: list[np.ndarray] = []
        self.places: list[tuple[int, int]] = []          # (source, source_start) of each phrase
        self.known: dict[tuple, int] = {}
        self.size = 0
        self.blocks: dict[tuple, list] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)

    def add(self, phrase: str, source: int, source_start: int) -> int:
        name = (phrase, source, source_start)
        if name not in self.known:
            code = self.code
            codes = tuple(code.setdefault(w, len(code) + 1) for w in phrase.split(" "))
            j = self.known[name] = len(self.phrases)
            self.phrases.append(np.array(codes, np.int64))
            self.places.append((source, source_start))
            self.size += len(codes)
            for o in range(0, len(codes) - self.block + 1, self.block):
                self.blocks.setdefault(codes[o:o + self.block], []).append((j, o))
        return self.known[name]

    def compile(self) -> None:
        for block, places in self.blocks.items():
            self.automaton.add_word(block, places)
        if self.blocks:
            self.automaton.make_automaton()

    def covered(self, doc: int, words_: list[str], own: set[int]) -> np.ndarray:
        """Words of the document inside a run that equals an earlier passage."""
        get, w = self.code.get, self.window
        codes = tuple(get(x, 0) for x in words_)
        array = np.array(codes, np.int64)
        out = np.zeros(len(codes), bool)
        if not self.blocks or len(codes) < w:
            return out
        marked = np.zeros(len(codes) - w + 1, bool)        # windows known to be repeats
        for end, places in self.automaton.iter(codes):
            p = end - self.block + 1
            around = marked[max(0, p + self.block - w):p + 1]
            for j, o in places:
                if j not in own or around.all():
                    continue
                source, source_start = self.places[j]
                shift = p - o                              # document word of the phrase's first word
                if not (source < doc or source == doc and source_start < shift):
                    continue
                phrase = self.phrases[j]
                lo, hi = max(0, -shift), min(len(phrase), len(codes) - shift)
                differs = np.flatnonzero(phrase[lo:hi] != array[shift + lo:shift + hi]) + lo
                k = np.searchsorted(differs, o)
                a = differs[k - 1] + 1 if k else lo
                z = differs[k] if k < len(differs) else hi
                if z - a >= w:
                    out[shift + a:shift + z] = True
                    marked[shift + a:shift + z - w + 1] = True
        return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20,
                   anchor: int = 5, shard_words: int = 400_000) -> DataFrame:
    """(id, text, n_words, n_removed): ``text`` is the kept words joined by one space."""
    own_id = F.col(id_col).cast("long")
    src = docs.select(F.coalesce(own_id, F.lit(NULL_ID)).alias("doc"), F.col(text_col).cast("string").alias("text"))
    spans = stage(recurring_spans(src, window, anchor), "spans")
    place = ["source", "source_start", "n"]
    phrases = (spans.select(*place).distinct().withColumnRenamed("source", "doc").join(src, "doc")
               .select(F.col("doc").alias("source"), "source_start", "n",
                       F.array_join(F.slice(words(F.col("text")), F.col("source_start") + 1,
                                            F.col("n") + window - 1), " ").alias("phrase")))
    wanted = (spans.select("doc", *place).join(phrases, place)
              .groupBy("doc").agg(F.collect_set(F.struct("phrase", "source", "source_start")).alias("phrases")))

    def shards(rows):
        """Documents in groups whose phrases fit one shard."""
        group, shard = [], PhraseShard(window)
        for doc, text, wanted_ in rows:
            own = {shard.add(x["phrase"], x["source"], x["source_start"]) for x in wanted_ or ()}
            group.append((doc, text, own))
            if shard.size >= shard_words or len(group) >= 2000:
                yield shard, group
                group, shard = [], PhraseShard(window)
        if group:
            yield shard, group

    def apply(batches):
        for b in batches:
            rows = ((b.column("doc")[i].as_py(), b.column("text")[i].as_py(), b.column("phrases")[i].as_py())
                    for i in range(b.num_rows))
            for shard, group in shards(rows):
                shard.compile()
                ids, texts, counts, removed = [], [], [], []
                for doc, text, own in group:
                    found = _WORD.findall(text or "")
                    kept = found
                    if own:
                        gone = shard.covered(doc, found, own)
                        kept = [x for x, g in zip(found, gone.tolist()) if not g]
                    ids.append(None if doc == NULL_ID else doc)
                    texts.append(" ".join(kept))
                    counts.append(len(found))
                    removed.append(len(found) - len(kept))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(counts, pa.int64()),
                     pa.array(removed, pa.int64())], names=["doc", "text", "n_words", "n_removed"])

    out = (src.join(wanted, "doc", "left").select("doc", "text", "phrases")
           .mapInArrow(apply, "doc long, text string, n_words long, n_removed long"))
    return out.withColumnRenamed("doc", id_col)


def query(spark, sf_dir):
    """op2: digest of every document after 20-word substring dedup."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i+19], ' ') AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS r FROM win)
         WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM late, (SELECT unnest(range(0, 20)) AS k)),
pos AS (SELECT doc_id, i, ws[i] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM pos ANTI JOIN gone USING (doc_id, i)
         GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
