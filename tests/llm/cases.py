"""Small documents with everything that operators must stand."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(n))


def awkward(seed=1, n=60):
    """(doc_id, text): nulls, empties, copies, near copies, shared lines, one long text."""
    rng = random.Random(seed)
    base = [words(rng, rng.randint(1, 160)) for _ in range(n // 3)]
    line = "All rights reserved by the owners of this text."
    rows = [(0, None), (1, ""), (2, " \t\n "), (3, "a"), (4, "a  "), (5, words(rng, 9000))]
    for i in range(6, n):
        text = rng.choice(base)
        kind = rng.randrange(6)
        if kind == 0:
            text = text.replace(" ", " \n", 3)
        elif kind == 1:
            text = f"{line}\n{text}\n{line.upper()}"
        elif kind == 2:
            text = text + " " + words(rng, 2)
        elif kind == 3:
            text = words(rng, 30) + "\n" + text
        rows.append((i, text))
    return rows


def frame(spark, rows):
    full = [(i, t, "en" if i is None or i % 2 else None, None, None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def clashing(df):
    """Columns named like those that operators use inside and return."""
    from pyspark.sql import functions as F

    names = ["row", "row_key", "id", "kept", "keep_id", "block", "name", "pos", "n", "digest", "bucket",
             "line", "lines", "body", "head", "size", "count", "batch", "h1", "h2", "owner", "start", "end",
             "fp", "key", "a", "b", "label", "component_id", "piece", "ids", "length", "offset", "score", "a.b"]
    for name in names:
        df = df.withColumn(name, F.lit(name))
    return df
