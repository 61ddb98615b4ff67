"""Frames and brute-force versions shared by the tests of the training-data operators."""

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def words(text):
    return WORD.findall(text or "")


def frame(spark, rows, extra=()):
    """Documents (id, text); ``extra`` adds columns with the given names."""
    schema = T.StructType([*DOCS, *[T.StructField(c, T.LongType()) for c in extra]])
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None, *[7] * len(extra))
                                  for i, t in rows], schema)


def collect(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))


def vocabulary(n=400, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnoprstuvwé") for _ in range(rng.randint(2, 9))) for _ in range(n)]


def corpus(n=60, seed=3, shared=True):
    """Texts with copies, near copies, shared passages, repeated lines, short and empty texts."""
    rng, vocab = random.Random(seed), vocabulary()
    line = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    common = [line(rng.randint(8, 30)) for _ in range(6)]
    out = []
    for i in range(n):
        lines = [line(rng.randint(1, 25)) for _ in range(rng.randint(1, 8))]
        if shared and rng.random() < 0.5:
            at = rng.randint(0, len(lines))
            lines[at:at] = common[:rng.randint(2, 6)]
        text = "\n".join(lines)
        if out and rng.random() < 0.15:
            text = rng.choice(out)[1]
        elif out and rng.random() < 0.2:
            w = rng.choice(out)[1].split(" ")
            w[rng.randrange(len(w))] = "changed"
            text = " ".join(w)
        if rng.random() < 0.1:
            text = " ".join([rng.choice(vocab)] * 45 + line(10).split() + ["a", "b", "c"] * 15)
        out.append((i, text))
    return out + [(n, ""), (n + 1, " \n\n "), (n + 2, "one"), (n + 3, "one two three")]
