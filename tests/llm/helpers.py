"""Small document tables with the awkward cases that every operator must bear."""

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ing"]) for _ in range(n))


def awkward(seed=1, n=40):
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randint(3, 60)), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None]), i) for i in range(n)]
    rows += [(100, None, None, None, None), (101, "", "en", "a", 0), (102, "   \n\t ", "en", "b", 3), (103, "!!! ???", "en", "b", 7),
             (104, prose(rng, 30_000), "en", "a", 1), (105, rows[3][1], "en", "a", 1), (106, rows[3][1].upper(), "en", "b", 1),
             (None, rows[4][1], "en", "a", 1), (None, "null id", "en", "a", 1), (107, "漢字 кириллица ελληνικά \U0001F600", None, "c", 1)]
    rows += [rows[5], rows[5]]                       # the same row three times
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)


def clashing(df):
    """With extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F
    for c in ("id", "value", "len", "size", "h", "key", "label", "expected_grade", "tails", "n_lines", "host", "uid", "component_id", "bands"):
        df = df.withColumn(c, F.lit("x"))
    return df


def empty(spark):
    return frame(spark, [])
