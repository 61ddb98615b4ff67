"""Best-fit packing of tokenised documents under several capacities.

Documents are tokenised in Arrow batches, followed by an end id, and cut into
pieces of at most ``max_tokens``.  Pieces are dealt by hash into blocks of
about ``block_pieces`` (the number of blocks follows the table's count, so a
task's memory does not), and every block is packed by vector best-fit
decreasing: a bin has residual capacities (tokens, documents, attention cost =
sum of squared lengths); a piece goes to the fitting bin with the smallest
weighted norm of what would remain, or, with ``rule="dot"``, the best weighted
alignment of piece and residual.  Every block leaves at most one badly filled
bin, so the loss against one global packing vanishes with size.

The default limits for documents and cost follow from the token limit and do
not bind, so their default weight is 0.  A piece that exceeds a limit alone
gets a sequence of its own.  Defined results: NULL text is empty and gives the end id alone;
NULL ids stay NULL; repeated rows are packed as often as they occur; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentio.llm.common import stage, table

#: words, and parts of words, whose ids a worker remembers; a memory is cleared when it is full
REMEMBERED = 600_000

# The parts into which the word-level BPE vocabulary takes a word (its published
# pattern), for lower-case letters of ASCII and Latin-1; words with other characters take the
# tokenizer's own path
_LETTER = "a-z\u00df-\u00f6\u00f8-\u00ff"
_PART = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^{_LETTER}0-9]+")
_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_LATIN = "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)]))


class _PartIds(dict):
    """part of a word -> ids, through the tokenizer's model alone."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenize = tokenizer.model.tokenize
        byte_form = tokenizer.pre_tokenizer.pre_tokenize_str
        self.byte_form = str.maketrans({c: byte_form(c)[0][0] for c in _LATIN})

    def __missing__(self, part: str) -> bytes:
        ids = np.array([t.id for t in self.tokenize(part.translate(self.byte_form))], "<u4").tobytes()
        if len(self) >= REMEMBERED:
            self.clear()
        self[part] = ids
        return ids


class WordIds(dict):
    """word -> its token ids as little-endian 32-bit bytes, filled on demand.

    For tokenizers that drop white space and treat each word alone, such as the
    word-level BPE vocabulary; texts are split at blanks and line feeds, which
    is never inside one of its words."""

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer
        super().__init__()
        tokenizer = Tokenizer.from_file(tokenizer_path)
        self.encode = tokenizer.encode
        special = [re.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values()]
        self.holds_special = re.compile("|".join(special) or "(?!)").search
        self.parts = _PartIds(tokenizer)
        self[""] = b""

    def __missing__(self, word: str) -> bytes:
        if _PLAIN.fullmatch(word) and not self.holds_special(word):
            # a word of letters only is one part
            ids = self.parts[word.lower()] if word.isalpha() else b"".join(map(self.parts.__getitem__, _PART.findall(word.lower())))
        else:
            ids = np.array(self.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) >= REMEMBERED:
            self.clear()
            self[""] = b""
        self[word] = ids
        return ids


_WORD_IDS: dict[str, WordIds] = {}


def worker_word_ids(tokenizer_path: str) -> WordIds:
    """The worker process's table for a tokenizer, kept from task to task."""
    if tokenizer_path not in _WORD_IDS:
        _WORD_IDS[tokenizer_path] = WordIds(tokenizer_path)
    return _WORD_IDS[tokenizer_path]


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = 2048, end_id: int = 0,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, ids): the cut token sequences; ``ids`` is little-endian unsigned 32-bit."""
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    id_type = src.schema["_id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * max_tokens

    def cut(batches):
        word_ids = worker_word_ids(tokenizer_path)
        for batch in batches:
            row, number, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column("_text")):
                parts = (text.as_py() or "").replace("\n", " ").split(" ")
                data = b"".join(map(word_ids.__getitem__, parts)) + end
                for k, at in enumerate(range(0, len(data), step)):
                    piece = data[at:at + step]
                    row.append(i)
                    number.append(k)
                    start.append(at // 4)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    ids.append(piece)
            cols = [batch.column("_id").take(pa.array(row, pa.int64())), pa.array(number, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                    pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["_id", "piece", "start", "length", "ids_crc32", "ids"])

    out = src.mapInArrow(cut, f"_id {id_type}, piece int, start long, length long, ids_crc32 long, ids binary")
    return out.withColumnRenamed("_id", id_col)


def best_fit(lengths: np.ndarray, capacity: tuple[int, int, int], weights=(1.0, 0.0, 0.0),
             rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every piece; ``lengths`` sorted from long to short.

    Open bins are kept by residual tokens, so bins that are too full are never
    looked at, and a search under the norm rule ends as soon as the tokens
    alone weigh more than the best bin found."""
    weigh = [w / c ** 2 for w, c in zip(weights, capacity)]
    by_rest: dict[int, list] = {}            # residual tokens -> bins [number, documents left, cost left, used]
    filled = 0                               # bit r is set if by_rest[r] has bins
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    n_bins = 0
    shortest = int(lengths[-1]) if len(lengths) else 0
    for i, size in enumerate(lengths.tolist()):
        cost = size * size
        best, best_score, at = None, math.inf, None
        look = filled >> size
        while look:
            r = size + (look & -look).bit_length() - 1
            tokens_alone = weigh[0] * (r - size) ** 2
            if rule == "norm" and tokens_alone >= best_score:
                break
            for b in by_rest[r]:
                if b[1] < 1 or b[2] < cost:
                    continue
                if rule == "norm":
                    score = tokens_alone + weigh[1] * (b[1] - 1) ** 2 + weigh[2] * (b[2] - cost) ** 2
                else:                        # alignment of piece and residual, the tighter bin first
                    dot = weigh[0] * r * size + weigh[1] * b[1] + weigh[2] * b[2] * cost
                    score = -dot / (weigh[0] * r * r + weigh[1] * b[1] ** 2 + weigh[2] * b[2] ** 2)
                if score < best_score:
                    best, best_score, at = b, score, r
                    if rule == "norm" and score <= tokens_alone:
                        break                # no bin of this or a larger residual is better
            look &= look - 1
        if best is None:
            best, at = [n_bins, capacity[1], capacity[2], 0], capacity[0]
            n_bins += 1
        else:
            same = by_rest[at]
            same.remove(best)
            if not same:
                filled &= ~(1 << at)
        bins[i], offsets[i] = best[0], best[3]
        best[1], best[2], best[3] = best[1] - 1, best[2] - cost, best[3] + size
        rest = at - size
        if rest >= shortest and best[1] >= 1 and best[2] >= shortest * shortest:
            by_rest.setdefault(rest, []).append(best)
            filled |= 1 << rest
    return bins, offsets


def pack(cut: DataFrame, max_tokens: int = 2048, max_docs: int | None = None, max_cost: int | None = None,
         weights=(1.0, 0.0, 0.0), rule: str = "norm", block_pieces: int = 50_000,
         id_col: str = "doc_id") -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to the pieces."""
    capacity = (max_tokens, max_docs or max_tokens, max_cost or max_tokens ** 2)
    blocks = max(1, -(-cut.count() // block_pieces))
    src = cut.withColumn("_block", F.pmod(F.xxhash64(id_col, "piece"), F.lit(blocks)))
    schema = cut.schema.add("sequence_id", "long").add("offset", "long")

    def pack_block(block: pa.Table) -> pa.Table:
        number = block.column("_block")[0].as_py()
        block = block.drop_columns("_block").sort_by([("length", "descending"), (id_col, "ascending"),
                                                      ("piece", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = best_fit(block.column("length").to_numpy(), capacity, weights, rule)
        return (block.append_column("sequence_id", pa.array(bins + (number << 32)))
                .append_column("offset", pa.array(offsets)))

    return src.groupBy("_block").applyInArrow(pack_block, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, max_tokens: int = 2048, **limits) -> DataFrame:
    """Tokenise, cut and pack: every piece with its token ids (``ids``) and its place.

    The pieces are stored once; the packing deals their lengths alone, numbered by stored row (ids of documents
    may repeat or be NULL), and the places are joined to the token ids, so no block holds tokens."""
    cut = stage(pieces(docs, tokenizer_path or default_tokenizer(), max_tokens)
                .withColumn("_row", F.monotonically_increasing_id()), "pieces")
    places = pack(cut.drop("ids"), max_tokens, **limits).select("_row", "sequence_id", "offset")
    return cut.join(places, "_row").drop("_row")


def query(spark, sf_dir):
    """op6: all documents in sequences of at most 2048 tokens; the digest is that of the packed ids."""
    packed = pack_documents(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
