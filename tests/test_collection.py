import numpy as np

from benthos.sources import collection


def test_parts_come_before_the_merged_report(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(f"{tmp_path}/EX1.parquet")
    assert collection.expedition(spark, str(tmp_path), "EX1").count() == 3
    spark.range(5).toPandas().to_parquet((tmp_path / "EX1").mkdir() or (tmp_path / "EX1/parts").mkdir() or tmp_path / "EX1/parts/a.parquet")
    assert collection.expedition(spark, str(tmp_path), "EX1").count() == 5


def test_first_answer(spark, tmp_path):
    (tmp_path / "b.txt").write_text("1,7,0,0,5,5\n")
    assert collection.first_answer(spark, [f"{tmp_path}/a.txt", f"{tmp_path}/b.txt"]).count() == 1
    assert collection.first_answer(spark, [f"{tmp_path}/a.txt"]) is None


def test_deployments(spark):
    reg = spark.createDataFrame([("A-1", "1", "2016-01-01T00:00:00", "2017-01-01T00:00:00", "44.5", "-125", "80"), ("A-1", "2", "2017-02-01T00:00:00", "", "44.6", "-125", "81"), ("A-1", "3", "2017-02-01T00:00:00", "", "x", "-125", "81")], ["Reference Designator", "deploymentNumber", "startDateTime", "stopDateTime", "lat", "lon", "deployment_depth"])
    rec = spark.sql("SELECT * FROM VALUES ('a', 'A-1', timestamp_ntz'2016-05-01'), ('b', 'A-1', timestamp_ntz'2024-05-01'), ('c', 'A-1', timestamp_ntz'2017-01-15') AS t(name, ref, recorded_at)")
    assert {r["name"]: r["no"] for r in collection.deployed(rec, reg).collect()} == {"a": 1, "b": 2, "c": None}


def test_frames_source(spark, tmp_path):
    stack = np.arange(10 * 4 * 3, dtype=np.float32).reshape(10, 4, 3)
    stack[6] = np.nan
    np.save(tmp_path / "clip.npy", stack)
    spark.dataSource.register(collection.Frames)
    df = spark.read.format("frames").option("path", f"{tmp_path}/clip.npy").option("framesPerPartition", 3).load()
    rows = {r["frame"]: np.frombuffer(r["plane"], np.float32).reshape(r["height"], r["width"]) for r in df.collect()}
    assert sorted(rows) == [0, 1, 2, 3, 4, 5, 7, 8, 9] and (rows[9] == stack[9]).all() and df.rdd.getNumPartitions() == 4
