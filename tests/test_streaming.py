"""M7 on Structured Streaming: same answers as the batch job."""

from pyspark.sql import functions as F

from seqrisk.operators.scoring import linear_scorer, score_requests
from seqrisk.streaming.requests import score_stream


def test_stream_equals_batch(spark, tmp_path):
    rows = [("2023_01_Bahrain", "3", (None, 20.0)), (None, "3", (None, None)), ("2023_01_X", "x7", None),
            ("2024_02_Y", "10", ("VER", None))]
    df = spark.createDataFrame(rows, "race_id string, lap string, lap_data struct<Driver:string,TyreLife:double>")
    src = str(tmp_path / "src")
    df.write.parquet(src)
    scorer = linear_scorer({"TyreLife": 0.1, "LapNumber": 0.05}, -1.0)
    q = score_stream(spark, src, df.schema, scorer, str(tmp_path / "out"), str(tmp_path / "ck"), 0.5)
    q.awaitTermination()
    key = lambda r: repr(tuple(r))
    got = sorted((tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()), key=key)
    exp = sorted((tuple(r) for r in score_requests(df, scorer, 0.5).collect()), key=key)
    assert got == exp and len(got) == 4
