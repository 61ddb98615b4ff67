"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Boundaries of the pieces come from arrays, not from a regex over the texts:

* A table gives the class of every code point (letter, number, white space, other);
  it is read off the tokenizer library's own pattern engine, so both know the same
  Unicode version.
* A symbol is the class and what one look ahead adds: a space that a word can take,
  the last white space of a run, an apostrophe that begins a contraction.
* A symbol is a function from automaton state to state.  Functions compose, and
  composition is associative: the closure of the symbols' functions is a small set
  with a product table, and a blocked prefix scan over products gives every state.
  A piece begins where the state before and the symbol say so.

The slices between boundaries are merged by rank, lowest rank and then leftmost first,
with a memory of bounded size per worker.  Each id keeps the byte offset of its token
in the text; decoding copies the tokens' bytes to these offsets.

Arrow batches are worked off in runs of texts of about ``CHUNK`` bytes (a longer text is
a run of its own), one narrow pass, no shuffle.  Defined results: NULL text is empty and
has no ids; NULL ids of documents stay NULL; repeated rows give repeated rows; other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import heapq
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentio.llm.common import table

CHUNK = 1 << 20
#: pieces whose ids a worker remembers (it forgets all when full); longer pieces are never remembered
REMEMBERED, LONGEST = 400_000, 200
#: pieces of up to so many bytes are merged in a list, longer ones with a heap
SHORT = 64

# ------------------------------------------------------------------ symbols and states

OTHER, LETTER, NUMBER, SPACE, END = range(5)
#: symbols: three classes, white space before white space or the end, a blank and another white
#: space as last of their run, apostrophes that one or two letters make a contraction
O, L, N, W, BLANK, LAST, A1, A2 = range(8)
#: states: between pieces, in letters / numbers / others, after a blank that joins what follows,
#: in white space, one and two letters of a contraction to come
REST, IN_L, IN_N, IN_O, JOIN, IN_W, C1, C2 = range(8)
#: a symbol plus FIRST is the same at the start of a text; NOTHING changes no state
FIRST, NOTHING = 8, 16

# The contractions that the public pattern takes as pieces
CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")


def _step(symbol: int, state: int) -> tuple[int, bool]:
    """(state after, whether a piece begins) at a symbol that is not the first of a text."""
    if symbol == L:
        if state in (C1, C2):
            return (REST, C1)[state == C2], False
        return IN_L, state not in (IN_L, JOIN)
    if symbol == N:
        return IN_N, state not in (IN_N, JOIN)
    if symbol in (A1, A2) and state not in (IN_O, JOIN):
        return (C1, C2)[symbol == A2], True
    if symbol in (O, A1, A2):
        return IN_O, state not in (IN_O, JOIN)
    if symbol == W:
        return IN_W, state != IN_W
    return (JOIN if symbol == BLANK else REST), True


@cache
def automaton():
    """(product, value, begins): product[f, g] is f followed by g, value[f] the state that f makes of
    REST, begins[8 * symbol + state]; functions 0 to 16 are those of the symbols."""
    functions = [tuple(_step(x, s)[0] for s in range(8)) for x in range(8)]
    functions += [(_step(x, REST)[0],) * 8 for x in range(8)] + [tuple(range(8))]
    number = {}
    for i, f in enumerate(functions):
        number.setdefault(f, i)
    at = 0
    while at < len(functions):                       # closure under composition
        for g in functions[:17]:
            h = tuple(g[s] for s in functions[at])
            if h not in number:
                number[h] = len(functions)
                functions.append(h)
        at += 1
    size = len(functions)
    product = np.array([[number[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint8)
    assert size < 256
    begins = [[_step(x, s)[1] for s in range(8)] for x in range(8)] + [[True] * 8] * 8
    return product, np.array([f[REST] for f in functions], np.uint8), np.array(begins).ravel()


def scan(functions: np.ndarray, width: int = 64) -> np.ndarray:
    """Inclusive prefix products: blocks of ``width`` side by side, then the blocks' totals the same way."""
    product = automaton()[0]
    size = len(product)
    flat = product.ravel()
    n = len(functions)
    rows = -(-n // width)
    padded = np.full(rows * width, NOTHING, np.uint8)
    padded[:n] = functions
    cols = np.ascontiguousarray(padded.reshape(rows, width).T).astype(np.uint16)
    for t in range(1, width):
        cols[t] = flat[cols[t - 1] * size + cols[t]]
    if rows > 1:
        carry = np.empty(rows, np.uint16)
        carry[0] = NOTHING
        carry[1:] = scan(cols[-1].astype(np.uint8), width)[:-1]
        cols = flat[carry * size + cols]
    return cols.T.reshape(-1)[:n].astype(np.uint8)


@cache
def classes() -> np.ndarray:
    """Class of every code point, read off the library's pattern engine."""
    import tiktoken
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.zeros(0x110000, np.uint8)
    for pattern, code in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        bytewise = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)},
                                     special_tokens={})
        found = bytes(bytewise.encode_ordinary(every)).decode()
        out[np.frombuffer(found.encode("utf-32-le"), "<u4")] = code
    return out


def symbols(points: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Symbols of code points of several texts; ``first`` and ``end`` are the texts' limits (none is empty)."""
    kind = classes()[points]
    after = np.empty_like(kind)
    after[:-1] = kind[1:]
    after[end - 1] = END
    out = kind.copy()                                # OTHER, LETTER and NUMBER are O, L and N
    last = (kind == SPACE) & (after < SPACE)
    out[last] = np.where(points[last] == 0x20, BLANK, LAST)
    quote = np.flatnonzero(points == 0x27)
    if len(quote):
        room = end[np.searchsorted(end, quote, "right")] - quote
        ahead = [points[np.minimum(quote + k, len(points) - 1)] for k in (1, 2)]
        for c in CONTRACTIONS:
            hit = room > len(c)
            for k, letter in enumerate(c):
                hit &= ahead[k] == ord(letter)
            out[quote[hit]] = A1 if len(c) == 1 else A2
    out[first] += FIRST
    return out


def piece_starts(points: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Places at which pieces begin."""
    if not len(points):
        return np.empty(0, np.int64)
    _, value, begins = automaton()
    symbol = symbols(points, first, end)
    before = np.empty_like(symbol)
    before[0] = REST
    before[1:] = value[scan(symbol)[:-1]]
    return np.flatnonzero(begins[symbol * np.uint8(8) + before])


# ------------------------------------------------------------------ merging


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: the adjacent pair of lowest rank, the leftmost of ties, is joined until none has a rank."""
    if piece in ranks:
        return [ranks[piece]]
    return (_merge_short if len(piece) <= SHORT else _merge_long)(piece, ranks)


def _merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    none = 1 << 32                                    # above every rank
    at = list(range(len(piece) + 1))                 # limits of the tokens so far
    pair = [ranks.get(piece[i:i + 2], none) for i in at[:-2]]
    while pair:
        best = min(pair)
        if best == none:
            break
        i = pair.index(best)
        del pair[i], at[i + 1]
        if i < len(pair):
            pair[i] = ranks.get(piece[at[i]:at[i + 2]], none)
        if i:
            pair[i - 1] = ranks.get(piece[at[i - 1]:at[i + 1]], none)
    return [ranks[piece[a:b]] for a, b in zip(at, at[1:])]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """With a heap of pairs, whose time does not grow with the square of the length."""
    n = len(piece)
    end = list(range(1, n + 1))                      # of the token that begins at a place; 0: none does
    previous = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue                                 # one of the two tokens has changed since
        end[i], end[middle] = stop, 0
        if stop < n:
            previous[stop] = i
            if (r := ranks.get(piece[i:end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := previous[i]) >= 0 and (r := ranks.get(piece[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at:end[at]]])
        at = end[at]
    return out


class PieceIds(dict):
    """piece -> its ids as little-endian unsigned 32-bit bytes, filled on demand."""

    def __init__(self, path: str):
        super().__init__()
        self.ranks = load_ranks(path)
        tokens = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def __missing__(self, piece: bytes) -> bytes:
        ids = np.array(merge(piece, self.ranks), "<u4").tobytes()
        if len(piece) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids


@cache
def worker_ids(path: str) -> PieceIds:
    """The worker process's memory for a vocabulary, kept from task to task."""
    return PieceIds(path)


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


# ------------------------------------------------------------------ Arrow batches


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; NULL is empty."""
    column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data, offsets


def _runs(offsets: np.ndarray, limit: int):
    """Row ranges of about ``limit`` bytes; at least one row each."""
    at, n = 0, len(offsets) - 1
    while at < n:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, stop
        at = stop


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def encode_run(data: bytes, limits: np.ndarray, vocabulary: PieceIds) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, byte offset of each token in its text, first token of each text and the end) of texts that
    lie one behind the other in ``data``, between ``limits``."""
    raw = np.frombuffer(data, np.uint8)
    lead = np.flatnonzero((raw & 0xC0) != 0x80)      # byte at which each code point begins
    points = np.frombuffer(data.decode().encode("utf-32-le"), "<u4")
    filled = limits[1:] > limits[:-1]
    first = np.searchsorted(lead, limits[:-1][filled])
    end = np.append(first[1:], len(lead)) if len(first) else first
    starts = lead[piece_starts(points, first, end)].tolist()
    pieces = [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)])]
    ids = np.frombuffer(b"".join(map(vocabulary.__getitem__, pieces)), "<u4")
    length = vocabulary.length[ids]
    places = np.cumsum(length) - length
    bounds = np.append(np.searchsorted(places, limits[:-1], "left"), len(ids))
    return ids, places - np.repeat(limits[:-1], np.diff(bounds)), bounds


def encode(docs: DataFrame, ranks_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, offsets): ``ids`` are little-endian unsigned 32-bit numbers, ``offsets`` of the same
    form are the byte at which each token begins in its text."""
    path = ranks_path or default_ranks()
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))

    def run(batches):
        vocabulary = worker_ids(path)
        for batch in batches:
            data, offsets = _flat(batch.column("_text"))
            for a, b in _runs(offsets, CHUNK):
                limits = offsets[a:b + 1] - offsets[a]
                ids, places, bounds = encode_run(data[offsets[a]:offsets[b]].tobytes(), limits, vocabulary)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(a, b - a), pa.array(np.diff(bounds), pa.int64()),
                     _binary(ids.view(np.uint8), bounds * 4), _binary(places.astype("<u4").view(np.uint8), bounds * 4)],
                    names=["_id", "n_tokens", "ids", "offsets"])

    kind = src.schema["_id"].dataType.simpleString()
    return src.mapInArrow(run, f"_id {kind}, n_tokens long, ids binary, offsets binary").withColumnRenamed("_id", id_col)


def decode(encoded: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its tokens put at their offsets, in place of ``offsets``."""
    path = ranks_path or default_ranks()
    schema = encoded.drop("offsets").schema.add("decoded", "binary")

    def run(batches):
        vocabulary = worker_ids(path)
        for batch in batches:
            data, limits = _flat(batch.column("ids"))
            places = _flat(batch.column("offsets"))
            for a, b in _runs(limits, CHUNK):
                ids = np.frombuffer(data[limits[a]:limits[b]].tobytes(), "<u4")
                at = np.frombuffer(places[0][places[1][a]:places[1][b]].tobytes(), "<u4").astype(np.int64)
                length = vocabulary.length[ids]
                bounds = (limits[a:b + 1] - limits[a]) // 4
                total = np.append(0, np.cumsum(length))[bounds]          # bytes before each text
                target = at + np.repeat(total[:-1], np.diff(bounds))
                shift = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
                out = np.empty(int(length.sum()), np.uint8)
                out[np.repeat(target, length) + shift] = vocabulary.bytes[np.repeat(vocabulary.start[ids], length) + shift]
                kept = batch.slice(a, b - a).drop_columns(["offsets"])
                yield pa.RecordBatch.from_arrays([*kept.columns, _binary(out, total)], names=[*kept.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)


def query(spark, sf_dir):
    """op13: ids of all documents, and the bytes decoded from them."""
    rows = decode(encode(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
