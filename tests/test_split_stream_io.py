import pytest
from pyspark.sql import functions as F

from parley.operators.split import stratified_split
from parley.sources import io as IO
from parley.sources.fixtures import fx
from parley.streaming import jobs as SJ

SF = "/root/testdata/sf0.001"


def test_split_exact_disjoint_and_equal_to_sql(spark):
    calls = fx(spark, SF, "fx_calls")
    mine = stratified_split(calls, hex_digits=2)          # fewer buckets: same result
    sql = spark.table("fx_split")
    assert mine.count() == calls.count() == mine.select("call_id").distinct().count()
    assert mine.exceptAll(sql).count() == 0 and sql.exceptAll(mine).count() == 0


def test_split_proportions_per_stratum(spark):
    calls = fx(spark, SF, "fx_calls")
    j = calls.join(stratified_split(calls), "call_id")
    for r in j.groupBy("csat_range", "issue_type").agg(
            F.count(F.lit(1)).alias("n"), F.sum((F.col("split") == "train").cast("int")).alias("tr")).collect():
        assert r.tr == int(r.n * 0.70 + 1e-9)


def test_stream_equals_batch(spark):
    path = f"{SF}/events.parquet"
    out = SJ.read_portfolio(spark, SJ.portfolio_stream(spark, SF, glob="events.parquet"))
    batch = SJ.windowed_portfolio(SJ.events_as_calls(spark.read.parquet(path)))
    cols = ["window_start", "issue_type", "n_calls"]
    assert out.select(*cols).exceptAll(batch.select(*cols)).count() == 0
    assert out.count() == batch.count()


def test_csv_roundtrip_keeps_multiline_and_spaces(spark):
    df = spark.createDataFrame([(1, 'Turn 1: AGENT: "hi",\nTurn 2: CUSTOMER: ok', "billing", 60.0, " Yes", " Resolved ", 4.0, "high")],
                               IO.CALLS_SCHEMA)
    path = SJ.scratch_path(spark, "test-csv")
    IO.write_csv(df, path)
    back = IO.read_csv(spark, path).collect()[0]
    assert back.transcript_text == 'Turn 1: AGENT: "hi",\nTurn 2: CUSTOMER: ok'
    assert back.resolution_status == " Resolved " and back.repeat_contact == " Yes"


def test_update_table_refuses_in_place(spark):
    with pytest.raises(ValueError):
        IO.update_table(spark, "/x/y", "/x/y/", lambda d: d)


def test_preds_roundtrip_and_json_arrays(spark):
    preds = spark.createDataFrame([(1, "test", "ridge", 3.5), (2, "test", "rf", 2.0), (3, "val", "ridge", 4.0)],
                                  IO.PREDS_SCHEMA)
    path = SJ.scratch_path(spark, "test-preds")
    IO.write_preds(preds, path)
    back = IO.read_preds(spark, path)
    assert sorted(map(tuple, back.select("call_id", "split", "model", "pred").collect())) == \
        sorted(map(tuple, preds.collect()))
    assert back.where("split = 'val'").count() == 1          # partition pruning path
    doc = spark.createDataFrame([([3.0, 4.0], [2.9, 4.2], 3.5)], "y_true array<double>, ridge array<double>, dataset_mean double")
    jpath = SJ.scratch_path(spark, "test-json")
    IO.write_json(doc, jpath)
    rows = IO.explode_arrays(IO.read_json(spark, jpath), ["y_true", "ridge"]).orderBy("i").collect()
    assert [(r.y_true, r.ridge) for r in rows] == [(3.0, 2.9), (4.0, 4.2)]
    assert IO.header_columns(spark, path) == ["call_id", "pred", "split", "model"]
    js = IO.metrics_json(preds.limit(1)).collect()[0].json
    assert '"model"' in js


def test_stream_windows_independent_of_session_zone(spark):
    path = f"{SF}/events.parquet"
    base = SJ.windowed_portfolio(SJ.events_as_calls(spark.read.parquet(path)))
    utc = sorted(map(tuple, base.select("window_start", "issue_type", "n_calls").collect()))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        base2 = SJ.windowed_portfolio(SJ.events_as_calls(spark.read.parquet(path)))
        ny = sorted(map(tuple, base2.select("window_start", "issue_type", "n_calls").collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert utc == ny


def test_csv_with_text_ids_raises_or_keeps_them(spark):
    from pyspark.sql import types as T
    path = SJ.scratch_path(spark, "test-ids")
    spark.createDataFrame([("CALL_0001", "hi")], "call_id string, transcript_text string").select(
        "call_id", "transcript_text", *[F.lit(None).cast("string").alias(f.name) for f in IO.CALLS_SCHEMA.fields[2:]]) \
        .write.option("header", True).csv(path)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        IO.read_csv(spark, path).collect()
    assert IO.read_csv(spark, path, IO.calls_schema(T.StringType())).collect()[0].call_id == "CALL_0001"


def test_cluster_needs_a_shared_checkpoint_folder():
    from parley.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_stream_in_two_triggers_equals_batch(spark):
    folder = SJ.scratch_path(spark, "test-events")
    events = spark.read.parquet(f"{SF}/events.parquet")
    for k in (0, 1):
        events.where(F.col("event_id") % 2 == k).coalesce(1).write.mode("append").parquet(folder)
    out = SJ.read_portfolio(spark, SJ.portfolio_stream(spark, folder, watermark="400 days", max_files_per_trigger=1))
    cols = ["window_start", "issue_type", "n_calls", "repeat_rate"]
    want = SJ.windowed_portfolio(SJ.events_as_calls(events)).select(*cols)
    assert sorted(map(tuple, out.select(*cols).collect())) == sorted(map(tuple, want.collect()))


def test_stream_of_out_of_order_files_closes_each_window_once(spark):
    """Eight triggers, neighbouring slices of time swapped: windows close as the watermark passes, the rest is one snapshot."""
    events = spark.read.parquet(f"{SF}/events.parquet").orderBy("ts", "event_id").toPandas()
    edge = [events.ts.iloc[min(len(events) * k // 8, len(events) - 1)] for k in range(9)]
    delay = max(int((b - a).total_seconds()) for a, b in zip(edge, edge[2:])) + 3600
    folder = SJ.scratch_path(spark, "test-disorder")
    for k in (1, 0, 3, 2, 5, 4, 7, 6):
        part = events.iloc[len(events) * k // 8:len(events) * (k + 1) // 8].sample(frac=1, random_state=k)
        spark.createDataFrame(part, spark.read.parquet(f"{SF}/events.parquet").schema).coalesce(1).write.mode("append").parquet(folder)
    path = SJ.portfolio_stream(spark, folder, watermark=f"{delay} seconds", max_files_per_trigger=1)
    cols = ["window_start", "issue_type", "n_calls", "repeat_rate", "avg_csat"]
    rows = lambda df: sorted((r[0], r[1], r[2], round(r[3], 9), round(r[4], 9)) for r in df.select(*cols).collect())
    want = rows(SJ.windowed_portfolio(SJ.events_as_calls(spark.read.parquet(f"{SF}/events.parquet"))))
    assert rows(SJ.read_portfolio(spark, path)) == want
    closed = spark.read.parquet(f"{path}/closed")
    key = ["window_start", "issue_type"]
    assert closed.select("epoch").distinct().count() > 2 and closed.count() == closed.select(*key).distinct().count() > 0
    newest = spark.read.parquet(f"{path}/epochs").agg(F.max("epoch")).first()[0]
    still = spark.read.parquet(f"{path}/open/epoch={newest}")
    assert 0 < still.count() < len(want) and still.join(closed, key).count() == 0
    # A reader takes no earlier snapshot, and starting again finds nothing new.
    files = SJ.read_portfolio(spark, path).inputFiles()
    assert files and all("/closed/" in f or f"/open/epoch={newest}/" in f for f in files)
    SJ.portfolio_stream(spark, folder, out_path=path, watermark=f"{delay} seconds", max_files_per_trigger=1)
    assert rows(SJ.read_portfolio(spark, path)) == want
