"""Sources, sinks, catalog tables, marks and incremental loading."""

from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from martflow import schemas
from martflow.operators import ingest
from martflow.session import materialize, shared_folder
from martflow.sources import files, jdbc, sinks, tables


def test_csv_forms(spark, tmp_path, rows):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, t string")
    sinks.write_csv(df, path)
    assert files.read_csv(spark, path).dtypes == [("n", "string"), ("t", "string")]
    assert files.read_csv(spark, path, infer=True).dtypes[0] == ("n", "int")
    assert rows(files.read_csv(spark, path, schema="n int, t string")) == [(1, "a"), (2, None)]
    assert rows(files.read_csv(spark, path + "/*.csv", schema=df.schema)) == [(1, "a"), (2, None)]
    assert files.read_csv(spark, str(tmp_path), recursive=True).count() == 2
    with pytest.raises(AnalysisException):  # the folder exists
        sinks.write_csv(df, path)


def test_swapped_header_is_noticed(spark, tmp_path):
    path = str(tmp_path / "csv")
    sinks.write_csv(spark.createDataFrame([("1", "2")], "b string, a string"), path)
    with pytest.raises(Exception):
        files.read_csv(spark, path, schema="a string, b string").collect()
    by_position = files.read_csv(spark, path, schema="a string, b string", check_header=False)
    assert by_position.first().a == "1"


def test_single_file(spark, tmp_path):
    path = tmp_path / "one"
    sinks.write_csv(spark.range(100).repartition(5), str(path), header=False, single_file=True)
    assert len(list(path.glob("part-*.csv"))) == 1


def test_csv_is_replaced_only_by_something(spark, tmp_path):
    path = str(tmp_path / "out")
    assert sinks.write_csv_if_any(spark.range(3), path)
    assert not sinks.write_csv_if_any(spark.range(0), path)
    assert files.read_csv(spark, path).count() == 3
    assert sinks.write_csv_if_any(files.read_csv(spark, path).filter("id > 0"), path)  # from itself
    assert files.read_csv(spark, path).count() == 2


def test_delimited_file(spark, tmp_path, rows):
    (tmp_path / "in.txt").write_text("s1,d,1.5\nbad\ns2,d,2\n")
    got = files.read_delimited(spark, str(tmp_path / "in.txt"), schemas.READINGS)
    assert rows(files.accepted(got)) == [("s1", "d", 1.5), ("s2", "d", 2.0)]


def test_messages_as_text_files(spark, tmp_path, rows):
    path = str(tmp_path / "m")
    df = spark.createDataFrame([(1,), (2,)], "a int")
    sinks.publish(df, "text", path=path)
    sinks.publish(df, "text", path=path)
    assert rows(spark.read.text(path)) == [('{"a":1}',)] * 2 + [('{"a":2}',)] * 2


def test_tables(spark, tmp_path, rows):
    tables.ensure_database(spark, "shop", str(tmp_path / "db"))
    store = spark.createDataFrame([(10, "A", 1)], "store_size int, store_type string, store_id int")
    path = str(tmp_path / "orc")
    first = tables.load_table(
        store.withColumn("last_modified", F.lit(None).cast("date")), "shop.dim_store", schemas.DIM_STORE, path
    )
    assert [tuple(r) for r in first.collect()] == [(1, "A", 10, None)]  # by name, not position
    tables.load_table(
        store.withColumn("last_modified", F.lit(None)), "shop.dim_store", schemas.DIM_STORE, path
    )
    assert tables.scan(spark, "dim_store", "shop").count() == 1  # overwritten, not appended
    assert "ORC" in str(spark.sql("DESCRIBE EXTENDED shop.dim_store").collect()).upper()
    assert tables.describe(spark, "shop.dim_store").count() >= 4

    tables.create_external(spark, "shop.seed", schemas.IMPORT_PRODUCTS, str(tmp_path / "seed"))
    tables.append_rows(spark, "shop.seed", [(118, "F"), (119, "G")], ["product_id", "name"])
    assert rows(spark.table("shop.seed"), "product_id", "name", "category") == [
        (118, "F", None),
        (119, "G", None),
    ]
    tables.drop_table(spark, "shop.seed")
    assert not spark.catalog.tableExists("shop.seed")


def test_external_csv_table_reads_in_place(spark, tmp_path, rows):
    path = str(tmp_path / "ext")
    sinks.write_csv(spark.createDataFrame([(1, "x")], "a int, b string"), path, header=False)
    schema = spark.createDataFrame([], "a int, b string").schema
    assert rows(files.register_external_csv(spark, "ext_csv", schema, path)) == [(1, "x")]
    sinks.write_csv(spark.createDataFrame([(2, "y")], "a int, b string"), path, "append", header=False)
    spark.catalog.refreshTable("ext_csv")
    assert spark.table("ext_csv").count() == 2


def test_bucketed_tables_join_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        left = tables.write_table(spark.range(1000).withColumnRenamed("id", "k"), "b1", bucket_by=(4, ["k"]))
        right = tables.write_table(spark.range(500).withColumnRenamed("id", "k"), "b2", bucket_by=(4, ["k"]))
        joined = left.join(right, "k")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_jdbc_options(monkeypatch):
    split = jdbc.Split("id", 0, 1000, 8)
    got = jdbc.read_options("jdbc:x", "t", split=split, properties={"user": "u"})
    assert got["dbtable"] == "t" and got["numPartitions"] == "8" and got["user"] == "u"
    assert jdbc.read_options("jdbc:x", query="select 1")["query"] == "select 1"
    with pytest.raises(ValueError):
        jdbc.read_options("jdbc:x")
    with pytest.raises(ValueError):
        jdbc.read_options("jdbc:x", query="select 1", split=split)
    assert jdbc.write_options("jdbc:x", "t", connections=4)["numPartitions"] == "4"
    monkeypatch.setenv("MARTFLOW_DB_USER", "me")
    assert jdbc.credentials() == {"user": "me"}


def t(text):
    return datetime.fromisoformat(text)


STAMPED = [
    (1, "2024-01-01 00:00:00.100"),
    (2, "2024-01-01 00:00:00.200"),
    (3, "2024-01-01 00:00:00.200"),
    (4, "2024-01-02 00:00:00"),
]


@pytest.fixture
def stamped(spark):
    return spark.createDataFrame(STAMPED, "id int, s string").select(
        "id", F.to_timestamp("s").alias("last_modified")
    )


def test_marks_keep_fractions_of_seconds(stamped):
    news = ingest.fetch_since(stamped, "last_modified", t("2024-01-01 00:00:00.100"))
    assert sorted(r.id for r in news.collect()) == [2, 3, 4]


def test_equal_stamps_are_told_apart_by_the_key(stamped):
    news = ingest.fetch_since(
        stamped, "last_modified", t("2024-01-01 00:00:00.200"), key="id", key_value=2
    )
    assert sorted(r.id for r in news.collect()) == [3, 4]
    mark = ingest.high_water_mark(stamped.filter("id < 4"), "last_modified", "id").first()
    assert (mark.last_modified, mark.id) == (t("2024-01-01 00:00:00.200"), 3)


def test_empty_target_means_everything_is_new(stamped):
    mark = ingest.high_water_mark(stamped.limit(0), "last_modified").first()[0]
    assert mark is None
    assert ingest.fetch_since(stamped, "last_modified", mark).count() == 4
    first = ingest.fetch_since(stamped, "last_modified", mark, 2, key="id")
    assert [r.id for r in first.collect()] == [1, 2]


def test_mark_store(spark, tmp_path):
    store = ingest.MarkStore(spark, str(tmp_path / "marks"), "k bigint, s timestamp")
    assert store.load({"k": 0}) == {"k": 0}
    store.save(k=5, s=t("2024-01-01 00:00:00.123456"))
    store.save(k=7, s=None)
    assert store.load() == {"k": 7, "s": None}
    assert len(list((tmp_path / "marks").glob("version=*"))) == 2


def test_load_by_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "c")], "id int, v string")
    loaded = ingest.load_by_key(df, "id", 1)
    assert [r.id for r in loaded.collect()] == [2, 3]
    assert ingest.new_last_key(loaded, "id", 1).first()[0] == 3
    nothing = ingest.load_by_key(df, "id", 117)
    assert ingest.new_last_key(nothing, "id", 117).first()[0] == 117


@pytest.fixture
def incremental(spark, tmp_path):
    source, target, extract = (str(tmp_path / n) for n in ("src", "target", "extract"))
    schema = "id int, v string, last_modified timestamp"
    spark.createDataFrame([], schema).write.parquet(target)
    marks = ingest.MarkStore(spark, str(tmp_path / "marks"), "last_modified timestamp, id int")

    def stored():
        return spark.read.schema(schema).parquet(target)

    def append(df):
        df.select("id", "v", "last_modified").write.mode("append").parquet(target)

    def run(n, append=append, with_marks=True):
        feed = ingest.Feed("t", source, stored, append, extract, ["id"], n=n, marks=marks if with_marks else None)
        if not ingest.run_incremental(spark, [feed])["t"]:
            return []
        return sorted(int(r.id) for r in files.read_csv(spark, extract).collect())

    def write(low, high):
        sinks.write_csv(spark.range(low, high).selectExpr("id", "concat('v', id) v"), source, "overwrite")

    return write, run, stored, append


@pytest.mark.parametrize("with_marks", [True, False])
def test_incremental_job_goes_on_after_the_last_row(incremental, with_marks):
    write, run, stored, _ = incremental
    write(0, 250)
    assert [len(run(100, with_marks=with_marks)) for _ in range(4)] == [100, 100, 50, 0]
    assert sorted(r.id for r in stored().collect()) == list(range(250))


def test_incremental_job_loads_all_by_default(incremental):
    write, run, stored, _ = incremental
    write(0, 250)
    assert run(None) == list(range(250))
    write(0, 300)  # the file grew
    assert run(None) == list(range(250, 300))
    assert run(None) == []
    assert stored().count() == 300


def test_incremental_job_extracts_what_an_interrupted_run_left(incremental):
    write, run, stored, append = incremental
    write(0, 5)
    assert run(3) == [0, 1, 2]

    def stop_after(df):
        append(df)
        raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        run(3, stop_after)
    assert run(3) == [3, 4]
    assert stored().count() == 5


def test_intermediate_tables_go_to_the_shared_folder(spark):
    out = materialize(spark.range(5), "x")
    assert all(shared_folder(spark) in f for f in out.inputFiles())
    assert out.count() == 5


class Settings:
    """A session with these settings only."""

    def __init__(self, **values):
        self.values = {k.replace("_", "."): v for k, v in values.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_shared_folder_follows_the_session():
    cluster = Settings(spark_master="yarn", spark_checkpoint_dir="hdfs://x/shared/")
    assert shared_folder(cluster) == "hdfs://x/shared"
    with pytest.raises(ValueError):
        shared_folder(Settings(spark_master="yarn"))
    local = Settings(spark_master="local[2]", spark_app_id="a")
    assert shared_folder(local) == shared_folder(local)
