import zipfile

from pyspark.sql import functions as F

from quireflow.sources import files
from quireflow.streaming import incremental


def test_inventory_notes_and_archives(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "n.md").write_bytes(b"\xef\xbb\xbf# T\ntext")
    (tmp_path / ".hidden.md").write_text("x")
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("full.md", "body")
        z.writestr("../bad.md", "no")
    (tmp_path / "broken.zip").write_bytes(b"zip?")
    assert {(r.name, r.extension) for r in files.inventory(spark, str(tmp_path)).collect()} == {("n.md", "md"), ("z.zip", "zip"), ("broken.zip", "zip")}
    assert "# T\ntext" in [r.text for r in files.notes(spark, str(tmp_path)).collect()]
    got = {(r.member, r.content and bytes(r.content), r.error) for r in files.archives(spark, str(tmp_path)).collect()}
    assert got == {("full.md", b"body", None), ("../bad.md", None, "unsafe name"), (None, None, "no archive")}


def test_page_blocks(spark, get):
    rows = [(1, '[{"type":"text","page_idx":2,"text":"a"}]'), (2, '[[{"text":"b"}],[{"text":"c"}]]'), (3, '{"blocks":[{"block_id":"q","page":7,"text":"d"}]}'), (4, "[]"), (5, None)]
    df = files.page_blocks(spark.createDataFrame(rows, "id int, j string"), "j").select("id", "block_id", "page", "text")
    assert get(df) == [(1, "b1", 3, "a"), (2, "b1", 1, "b"), (2, "b2", 2, "c"), (3, "q", 7, "d")]


def test_stream_keeps_the_latest_and_counts_late_rows(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "k string, v int, t timestamp"
    day = lambda d: F.expr(f"timestamp '2025-01-{d:02} 00:00:00'")
    spark.range(3).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"), day(1).alias("t")).coalesce(1).write.parquet(src)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        q = stream.writeStream.foreachBatch(incremental.keep_latest(out, ["k"], "v")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination()

    run()
    spark.range(1, 5).select(F.col("id").cast("string").alias("k"), F.lit(2).alias("v"), day(2).alias("t")).coalesce(1).write.mode("append").parquet(src)
    run()
    got = {r.k: r.v for r in incremental.latest_version(spark, out).collect()}
    assert got == {"0": 1, "1": 2, "2": 2, "3": 2, "4": 2}
    counts = incremental.windowed_counts(spark.readStream.schema(schema).parquet(src), "t", ["v"], "1 day")
    q = counts.writeStream.format("memory").queryName("counted").outputMode("update").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp2")).start()
    q.awaitTermination()
    assert {(r.v, r.n) for r in spark.sql("select v, n from counted").collect()} >= {(1, 3), (2, 4)}
    first = incremental.first_arrivals(spark.readStream.schema(schema).parquet(src), "k", "t")
    q = first.writeStream.format("memory").queryName("firsts").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp3")).start()
    q.awaitTermination()
    assert spark.sql("select count(distinct k) = count(*) as one from firsts").first().one
