"""JSON arrays cut at byte ranges against Spark's whole-file reader."""

import json
import random
import tempfile

import pytest

from retentio.sources import io as IO
from retentio.sources import json_array as JA

HARD = ['', 'plain', '}{][', 'a "quoted" {brace', '\\', '\\\\"', 'tail\\', 'é€𝄞 "}', '[{"x": 1}]', 'line\nbreak\r\n', None]


def _rows(n, seed=1):
    rng = random.Random(seed)
    return [{"id": i, "s": rng.choice(HARD), "t": "".join(filter(None, rng.choices(HARD, k=3))),
             "nested": {"a": [rng.randint(0, 9)] * rng.randint(0, 3), "b": {"c": rng.choice(HARD)}}} for i in range(n)]


def _write(text):
    path = tempfile.mkdtemp(prefix="retentio-test-") + "/x.json"
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def test_every_cut_gives_the_same_records():
    text = json.dumps(_rows(12), ensure_ascii=False, indent=1).encode()
    want = _rows(12)
    for size in (1, 2, 3, 7, 50, 1000, len(text) + 1):
        got, state, depth = [], JA.OUTSIDE, 0
        for at in range(0, len(text), size):
            data, pos = text[at:at + size], [at + size]

            def more():
                out = text[pos[0]:pos[0] + 5]
                pos[0] += 5
                return out
            got += [json.loads(r) for r in JA._records(data, state, depth, 1, more)]
            step, state = JA.scan(data, state)
            depth += int(step.sum())
        assert got == want and (state, depth) == (JA.OUTSIDE, 0)


@pytest.mark.parametrize("dump", [lambda r: json.dumps(r, ensure_ascii=False, indent=2), lambda r: " \n " + json.dumps(r),
                                  lambda r: json.dumps(r[0])])
def test_equals_the_whole_file_reader(spark, dump):
    path = _write(dump(_rows(400)))
    want = spark.read.option("multiLine", True).json(path)
    got = JA.read_json_array(spark, path, range_bytes=1000)
    assert got.schema == want.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    typed = JA.read_json_array(spark, path, want.schema, range_bytes=777)
    assert sorted(map(str, typed.collect())) == sorted(map(str, want.collect()))


def test_one_file_is_read_by_many_tasks(spark):
    path = _write(json.dumps(_rows(300)))
    records = JA.json_records(spark, path, range_bytes=2000)
    assert records.rdd.getNumPartitions() > 10
    assert [json.loads(r["value"])["id"] for r in records.orderBy("value").collect()].__len__() == 300


def test_empty_array_and_folder_of_files(spark):
    assert IO.load(spark, _write("[]")).count() == 0
    folder = tempfile.mkdtemp(prefix="retentio-test-")
    for i in range(3):
        with open(f"{folder}/{i}.json", "w") as f:
            json.dump([{"id": 10 * i + j} for j in range(4)], f)
    assert sorted(r["id"] for r in IO.load(spark, f"{folder}/*.json").collect()) == [10 * i + j for i in range(3) for j in range(4)]


def test_memory_follows_the_block_not_the_range(tmp_path):
    import tracemalloc

    import pyarrow as pa
    text = json.dumps([{"id": i, "s": "a \\\\ \" { " * 6} for i in range(80_000)]).encode()
    path = str(tmp_path / "x.json")
    with open(path, "wb") as f:
        f.write(text)
    rows = [{"file": 0, "path": path, "at": 0, "length": len(text), "state": JA.OUTSIDE, "depth": 0, "base": 1}]
    tracemalloc.start()
    summary = next(JA._summaries(iter([pa.RecordBatch.from_pylist(rows)]))).to_pylist()[0]
    assert summary["ends"][JA.OUTSIDE] == JA.OUTSIDE and summary["steps"][JA.OUTSIDE] == 0
    n = sum(b.num_rows for b in JA._emit(iter([pa.RecordBatch.from_pylist(rows)])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 80_000 and peak < 64 << 20, peak           # several 100 MB when the range is scanned at once


def test_ranges_taken_in_blocks_give_the_same_records(tmp_path, monkeypatch):
    import pyarrow as pa
    text = json.dumps(_rows(60), ensure_ascii=False, indent=1).encode()
    path = str(tmp_path / "x.json")
    with open(path, "wb") as f:
        f.write(text)
    batch = lambda r: iter([pa.RecordBatch.from_pylist([r])])                                  # noqa: E731
    for size in (1, 7, 100, 1 << 20):
        monkeypatch.setattr(JA, "BLOCK_BYTES", size)
        got, state, depth = [], JA.OUTSIDE, 0
        for at in range(0, len(text), 333):
            row = {"file": 0, "path": path, "at": at, "length": min(333, len(text) - at), "state": state, "depth": depth, "base": 1}
            got += [json.loads(v) for b in JA._emit(batch(row)) for v in b.column("value").to_pylist()]
            out = next(JA._summaries(batch(row))).to_pylist()[0]
            state, depth = out["ends"][state], depth + out["steps"][state]
        assert got == _rows(60) and (state, depth) == (JA.OUTSIDE, 0)
