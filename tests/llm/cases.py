"""Small hostile tables for the corpus operators."""

import random

from pyspark.sql import types as T

#: Columns whose names the operators use inside, beside the ones they read.
DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *(T.StructField(c, T.StringType()) for c in ("id", "doc", "fp", "pos", "words", "key", "n_words", "sh", "path")),
    ]
)


def prose(seed, words, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('bdfgklm')}{rng.randrange(vocabulary)}" for _ in range(words))


def texts():
    base = [prose(i, 60) for i in range(12)]
    near = base[0].split()
    near[30] = "changed"
    return [
        *base,
        base[1],
        base[1],
        " ".join(near),
        None,
        "",
        " \n\t ",
        "one two",
        "ÀÉ straße Ünï" * 5,
        prose(99, 9_000),
        "token = \"" + "0f" * 20 + "\" and\n" + base[2] + "\n" + base[2],
    ]


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    data = [(i, t, "en", f"src{i % 3}", len(t or ""), *("clash",) * 9) for i, t in enumerate(rows)]
    data += [(None, "a row without an id", None, None, None, *(None,) * 9)]
    data.append(data[3])
    return spark.createDataFrame(data, DOCUMENTS)


def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
