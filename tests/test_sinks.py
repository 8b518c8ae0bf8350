"""Keyed, document and routed sinks. The database is Derby inside the session's own process."""

import os

from conftest import rows
from pyspark.sql import functions as F

from tidemark.sinks import documents, keyed, streams

URL = "jdbc:derby:memory:sinks"
DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def derby(spark, *statements):
    spark._jvm.org.apache.derby.iapi.jdbc.AutoloadedDriver()
    connection = spark._jvm.java.sql.DriverManager.getConnection(URL + ";create=true")
    statement = connection.createStatement()
    for sql in statements:
        statement.execute(sql)
    connection.close()


def readings(spark, data):
    return spark.createDataFrame(data, "id string, seq long, temperature double")


SETTINGS = {
    "url": URL, "driver": DRIVER, "target": "temps", "keys": ["id"], "values": ["temperature"], "order": ["seq"],
}


def stored(spark):
    table = spark.read.format("jdbc").options(url=URL, driver=DRIVER, dbtable="temps").load()
    return {r[0]: r[1] for r in table.collect()}


def test_upsert(spark):
    derby(spark, "CREATE TABLE temps (id VARCHAR(255), temperature DOUBLE)")
    keyed.upsert(readings(spark, [("a", 1, 1.0), ("a", 2, 2.0), ("b", 3, 3.0)]), **SETTINGS)
    assert stored(spark) == {"a": 2.0, "b": 3.0}
    keyed.upsert(readings(spark, [("b", 4, 4.0), ("c", 5, 5.0)]), **SETTINGS)
    assert stored(spark) == {"a": 2.0, "b": 4.0, "c": 5.0}
    write = keyed.upsert_each_batch(**SETTINGS)
    for _ in range(2):
        write(readings(spark, [("a", 9, 9.0)]), 0)
    assert stored(spark) == {"a": 9.0, "b": 4.0, "c": 5.0}


def test_merge_statement():
    sql = keyed.merge_statement("t1", "s1", ["id"], ["v"])
    assert sql.startswith('MERGE INTO t1 t USING s1 s ON t.id = s."id" WHEN MATCHED')


def test_hash_rows(spark):
    out = keyed.hash_rows(readings(spark, [("a", 1, 1.0), ("a", 2, 2.5), ("b", 3, 3.0)]), "id", "temperature", ["seq"])
    assert rows(out) == [("sensor_temperature", "a", "2.5"), ("sensor_temperature", "b", "3.0")]


def test_write_hash(spark, tmp_path):
    out = keyed.hash_rows(readings(spark, [("a", 1, 1.0), ("b", 3, 3.0)]), "id", "temperature", ["seq"])
    folder = str(tmp_path)

    def put(found):
        for r in found:
            with open(os.path.join(folder, r.field), "w") as f:
                f.write(r.value)

    keyed.write_hash(out, put)
    assert sorted(os.listdir(folder)) == ["a", "b"]


def test_documents(spark, hot):
    df = readings(spark, [(f"s{i}", i, float(i)) for i in range(25)])
    out = documents.index_documents(df, "sensor", ["id", "temperature"], ["seq"], hot=hot)
    bulks = {r.bulk: r.n for r in out.groupBy("bulk").agg(F.count("*").alias("n")).collect()}
    assert bulks == {0: 10, 1: 10, 2: 5}
    assert out.filter("seq = 3").first().document == '{"id":"s3","temperature":"3.0"}'
    text = documents.text_documents(df.filter("seq = 3"), ["id", "temperature"]).first().document
    assert text == '{"data":"(s3,3.0)"}'
    assert documents.bulk_options("n1")["es.batch.size.entries"] == "10"


def test_routes_of_a_stream(spark, tmp_path):
    source, sinks = str(tmp_path / "in"), {k: str(tmp_path / k) for k in ("main", "late")}
    spark.createDataFrame([(1, "main"), (2, "late"), (3, "main")], "v int, output string").write.parquet(source)
    stream = spark.readStream.schema("v int, output string").parquet(source)
    writers = {k: (lambda df, p=p: df.write.mode("append").parquet(p)) for k, p in sinks.items()}
    streams.route_stream(stream, writers, str(tmp_path / "checkpoint")).awaitTermination()
    assert rows(spark.read.parquet(sinks["main"])) == [(1,), (3,)]
    assert rows(spark.read.parquet(sinks["late"])) == [(2,)]


def test_console(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([(1,)], "v int").write.parquet(source)
    query = streams.to_console(spark.readStream.schema("v int").parquet(source), label="values")
    query.processAllAvailable()
    query.stop()
