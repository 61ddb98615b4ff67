"""JSON array files read by many tasks (survey §2.1, S2).

Spark's ``multiLine`` reader gives a whole file to one task.  Here a file is cut at byte
ranges.  Whether a range starts inside a string, after a backslash or at which depth depends
on all bytes before it, so one pass summarises every range for each of the three possible
starts (outside a string, inside, inside after a backslash): the state at its end and the
change of depth.  The driver composes the summaries, some 100 bytes a range, in order.  A
second pass lets every range emit the records that begin in it, reading on past its end until
the last of them closes.  Both passes take a range in blocks of ``BLOCK_BYTES``, so a task's memory
follows from the block and the longest record, not from the range.

Holds for one object, objects one after another and arrays of objects; what lies between the
records is skipped.  Files are opened in the tasks through ``pyarrow.fs``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentio.session import checkpoint_dir

RANGE_BYTES = 64 * 1024 * 1024
#: bytes that a task scans at a time
BLOCK_BYTES = 1 << 20
OUTSIDE, INSIDE, ESCAPED = range(3)
QUOTE, BACKSLASH = ord('"'), ord("\\")

#: how a byte changes the depth
STEP = np.zeros(256, np.int8)
STEP[[ord("{"), ord("[")]] = 1
STEP[[ord("}"), ord("]")]] = -1


def _open(path: str):
    from pyarrow import fs
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
    system, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1) if "://" in path else f"file://{path}")
    return system.open_input_file(inner)


def scan(data: bytes, state: int) -> tuple[np.ndarray, int]:
    """The change of depth at every byte, 0 inside strings, and the state after the last byte."""
    a = np.frombuffer(data, np.uint8)
    if not a.size:
        return np.zeros(0, np.int8), state
    slash = a == BACKSLASH
    quote, ends_escaped = a == QUOTE, False
    if slash.any():
        at = np.arange(a.size, dtype=np.int32 if a.size < 1 << 31 else np.int64)
        other = np.maximum.accumulate(np.where(slash, at.dtype.type(-1), at))           # last byte that is no backslash
        run = at - other + (state == ESCAPED) * (other == -1)            # backslashes that end here
        quote[1:] &= run[:-1] % 2 == 0
        ends_escaped = bool(run[-1] % 2 == 1 and slash[-1])
    if state == ESCAPED:
        quote[0] = False
    inside = (np.cumsum(quote, dtype=np.uint8) + np.uint8(state != OUTSIDE)) % 2 == 1       # the parity outlasts the overflow
    end = OUTSIDE if not inside[-1] else ESCAPED if ends_escaped else INSIDE
    return np.where(inside, np.int8(0), STEP[a]), end


def _blocks(f, at: int, length: int) -> Iterator[bytes]:
    """The bytes of a range, ``BLOCK_BYTES`` at a time: a task holds a few blocks, not its range."""
    for k in range(at, at + length, BLOCK_BYTES):
        yield f.read_at(min(BLOCK_BYTES, at + length - k), k)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, at, ends, steps): state after the range and change of depth for each state before it."""
    for b in batches:
        rows = b.to_pylist()
        ends, steps = [], []
        for r in rows:
            states, depths = [OUTSIDE, INSIDE, ESCAPED], [0, 0, 0]
            with _open(r["path"]) as f:
                for data in _blocks(f, r["at"], r["length"]):
                    found = {s: scan(data, s) for s in set(states)}
                    sums = {s: int(d.sum(dtype=np.int64)) for s, (d, _) in found.items()}
                    depths = [d + sums[s] for d, s in zip(depths, states)]
                    states = [found[s][1] for s in states]
            ends.append(states)
            steps.append(depths)
        yield pa.RecordBatch.from_arrays(
            [b.column("file"), b.column("at"), pa.array(ends, pa.list_(pa.int32())), pa.array(steps, pa.list_(pa.int64()))],
            names=["file", "at", "ends", "steps"])


def _records(data: bytes, state: int, depth: int, base: int, more) -> list[str]:
    """The records that begin in ``data``; ``more()`` gives the bytes that follow it, empty at the end of the file."""
    return _found(data, *scan(data, state), depth, base, more)


def _found(data: bytes, change: np.ndarray, state: int, depth: int, base: int, more) -> list[str]:
    """``_records`` of scanned bytes; ``state`` is the one after them."""
    out, size, start = [], len(data), None
    buffer, read = data, 0
    while True:
        level = depth + np.cumsum(change, dtype=np.int64)
        edges = np.flatnonzero(((change > 0) & (level == base + 1)) | ((change < 0) & (level == base)))
        for i in edges.tolist():
            if change[i] > 0:
                if read + i >= size:
                    return out                    # begins in the next range
                start = read + i
            elif start is not None:
                out.append(buffer[start:read + i + 1].replace(b"\r", b" ").replace(b"\n", b" ").decode("utf-8", "replace"))
                start = None
        if start is None:
            return out
        depth, read = (int(level[-1]) if level.size else depth), len(buffer)
        following = more()
        if not following:
            return out                            # the file ends inside a record
        if read == size:
            buffer = bytearray(buffer)            # grows in place
        buffer += following
        change, state = scan(following, state)


def _following(f, at: int):
    """Reads on from ``at``, more at every call: most records end soon, a long one takes few calls."""
    step = 1 << 14

    def more() -> bytes:
        nonlocal at, step
        data = f.read_at(step, at)
        at, step = at + len(data), min(2 * step, BLOCK_BYTES)
        return data
    return more


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for r in b.to_pylist():
            at, state, depth = r["at"], r["state"], r["depth"]
            with _open(r["path"]) as f:
                for data in _blocks(f, at, r["length"]):
                    at += len(data)
                    change, state = scan(data, state)
                    found = _found(data, change, state, depth, r["base"], _following(f, at))
                    depth += int(change.sum(dtype=np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["value"])


def _files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, bytes) of a file, of the files of a folder or of a pattern, hidden ones left out."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for found in fs.globStatus(p):
        for s in (fs.listStatus(found.getPath()) if found.isDirectory() else [found]):
            if not s.isDirectory() and not s.getPath().getName().startswith(("_", ".")):
                out.append((s.getPath().toString(), s.getLen()))
    return sorted(out)


def _base(path: str) -> int:
    """The depth around the records: 1 in an array, 0 otherwise."""
    at = 0
    with _open(path) as f:
        while data := f.read_at(4096, at):
            head = data.lstrip(b" \t\r\n\xef\xbb\xbf")
            if head:
                return int(head[:1] == b"[")
            at += len(data)
    return 0


def json_records(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Every record of the files at ``path`` as one line of text (``value``)."""
    files = _files(spark, path)
    ranges = [(i, p, at, min(range_bytes, size - at)) for i, (p, size) in enumerate(files) for at in range(0, size, range_bytes)]
    if not ranges:
        return spark.createDataFrame([], "value string")

    def spread(rows, schema):       # one range a task
        df = spark.createDataFrame(rows, schema)
        return df.repartitionByRange(len(rows), *[c for c in ("file", "at") if c in df.columns])

    found = {(r["file"], r["at"]): r for r in spread(ranges, "file int, path string, at long, length long").mapInArrow(
        _summaries, "file int, at long, ends array<int>, steps array<long>").collect()}     # some 100 bytes a range
    starts, state, depth, base = [], OUTSIDE, 0, 0
    for i, p, at, length in ranges:
        if at == 0:
            state, depth, base = OUTSIDE, 0, _base(p)
        starts.append((i, p, at, length, state, depth, base))
        summary = found[(i, at)]
        state, depth = summary["ends"][state], depth + summary["steps"][state]
    return spread(starts, "file int, path string, at long, length long, state int, depth long, base int").mapInArrow(
        _emit, "value string")


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                    range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of JSON array files as rows.  Without ``schema`` the records are written once as JSON lines
    under the checkpoint folder, from which Spark infers it as it does for ``multiLine``."""
    import uuid
    records = json_records(spark, path, range_bytes)
    if schema is not None:
        return records.select(F.from_json("value", schema).alias("r")).select("r.*")
    lines = f"{checkpoint_dir(spark).rstrip('/')}/retentio-json-{uuid.uuid4().hex}"
    records.write.text(lines)
    return spark.read.json(lines)
