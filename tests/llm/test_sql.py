"""The SQL of the queries that have some, on planted tables."""

import math

from pyspark.sql import types as T

from seqrisk.llm import queries

FLOATS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def both(spark, folder, table, df, key):
    """Rows of the query and rows of its SQL, sorted, over one written table."""
    import duckdb
    df.write.parquet(f"{folder}/{table}.parquet")
    mine = queries.QUERIES[key](spark, str(folder))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
    names = ", ".join(mine.columns)
    theirs = con.execute(f"SELECT {names} FROM ({queries.ORACLE[key]})").fetchall()
    return sorted(tuple(r) for r in mine.collect()), sorted(theirs)


def test_vectors_chains_labels_and_defined_cases(spark, tmp_path):
    def at(degrees):
        return [math.cos(math.radians(degrees)), math.sin(math.radians(degrees)), 0.0]
    rows = [(9, at(0), 1), (4, at(20), 1), (7, at(40), 1), (2, at(90), 1), (3, at(0), 2), (5, at(0), None), (6, None, 1), (8, [0.0] * 3, 1),
            (10, [float("nan"), 1.0, 0.0], 1), (11, [None, 1.0, 0.0], 1), (12, [float("inf"), 1.0, 0.0], 1), (13, at(90), 1), (14, at(90), 1), (15, [], 1)]
    mine, theirs = both(spark, tmp_path, "embeddings", spark.createDataFrame(rows, FLOATS), "op2_embedding_dedup")
    assert mine == theirs
    got = {r[0]: r[1:] for r in mine}
    assert got[9] == (1, 4, False) and got[4] == (2, 4, True) and got[7] == (1, 4, False)
    assert got[2] == (2, 2, True) and got[14] == (2, 2, False)
    assert all(got[i] == (0, i, True) for i in (3, 5, 6, 8, 10, 11, 12, 15))


def test_lines_within_one_edit(spark, tmp_path):
    rows = [(1, "Read more >>\nabcd\n\nfirst long line of the page, as it is"), (2, "read more >>>\nabce\n\nFirst long line of the pagé, as it is"),
            (3, None), (4, ""), (5, "Read mord >>\n  READ MORE >>\t\nsomething else altogether"), (6, "first long line of page, as it is\nvwxyz\nvwxyzz"),
            (7, "abcd\n abcd\nvwxy"), (8, "read more >>")]
    mine, theirs = both(spark, tmp_path, "documents", spark.createDataFrame(rows, "doc_id long, text string"), "op5_line_dedup")
    assert mine == theirs
    assert {r[0]: r[1:3] for r in mine} == {1: (4, 0), 2: (4, 2), 3: (1, 0), 4: (1, 0), 5: (3, 2), 6: (3, 1), 7: (3, 1), 8: (1, 1)}
