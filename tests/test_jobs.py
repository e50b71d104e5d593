"""Whole jobs on small tables: what they write can be read back and adds up."""

from datetime import date

from pyspark.sql import functions as F

from martflow import fixtures as fx
from martflow import schemas
from martflow.operators import clean
from martflow.plans import jobs, star
from martflow.sources import files, tables
from conftest import SMALL


def test_loyalty_answers_are_written_under_their_names(spark, tmp_path):
    answers = jobs.loyalty_answers(
        fx.sales(spark, SMALL), fx.menu(spark, SMALL), fx.members(spark, SMALL), date(1999, 12, 31)
    )
    jobs.write_all(answers, lambda df, name: df.write.parquet(str(tmp_path / name)))
    counts = {n: spark.read.parquet(str(tmp_path / n)).count() for n in answers}
    assert len(counts) == 10 and counts["total_spent"] == 150 and counts["top_product"] == 1


def test_product_report_reads_what_it_wrote(spark, tmp_path):
    path = str(tmp_path / "cleaned")
    pivot, second = jobs.product_report(fx.products(spark, SMALL), path, single_file=True)
    assert second.count() == 6
    sizes = [F.coalesce(F.sum(c), F.lit(0)) for c in pivot.columns[1:]]
    assert sum(pivot.agg(*sizes).first()) == files.read_csv(spark, path).count() == 200


def test_curated_data_pass_their_checks(spark, tmp_path):
    raw = fx.raw_events(spark, SMALL).drop("user_id")
    late = F.coalesce(F.col("date") >= "2024-01-20", F.lit(False))

    def drop(df):
        return clean.clean_drop(df).dropDuplicates()

    checks, verdict = jobs.curate(raw.filter(~late), raw.filter(late), drop, str(tmp_path / "c"))
    assert checks.filter("not passed").isEmpty()
    assert verdict.first().passed


RETAIL_TEXT = {
    "store": "1,A,100,2024-01-01T00:00:00.000Z",
    "features": "1,2010-02-05,1,2,3,4,5,6,7,8,9,false,2024-01-01T00:00:00.000Z",
    "past_sales": "1,2,2010-02-05,10.5,false,2024-01-02T00:00:00.000Z",
}


def test_star_from_raw_text(spark, tmp_path, rows):
    kinds = {"store": schemas.STORE, "features": schemas.FEATURES, "past_sales": schemas.PAST_SALES}
    loaded = {}
    for name, schema in kinds.items():
        values = RETAIL_TEXT[name].split(",")
        columns = ", ".join(f"{c} string" for c in schema.fieldNames())
        raw = spark.createDataFrame([values, ["NA"] * len(values)], columns)
        loaded[name] = jobs.load_retail_table(
            raw, schema, f"raw_{name}", str(tmp_path / name), str(tmp_path / f"{name}_csv")
        )
        assert files.read_csv(spark, str(tmp_path / f"{name}_csv")).count() == 1
    stars = jobs.store_star(
        spark, loaded["past_sales"], loaded["features"], loaded["store"], "mart", str(tmp_path / "mart")
    )
    fact = stars["fact_sales"].first()
    assert (fact.store_id, fact.dept_id, fact.date_id) == (1, 2, date(2010, 2, 5))
    assert stars["dim_features"].first().feature_id == fact.feature_id
    assert tables.scan(spark, "dim_holiday", "mart").count() == 1
    jobs.unload(stars, str(tmp_path / "unload"), single_file=True)
    jobs.unload(stars, str(tmp_path / "unload"), single_file=True)  # replaces
    days = files.register_external_csv(
        spark, "unloaded_days", schemas.DIM_DATE, str(tmp_path / "unload" / "dim_date")
    )
    assert rows(days) == [(date(2010, 2, 5), 2010, 2, 5)]


def test_catalog_tables_in_other_formats(spark, tmp_path):
    df = star.dim_store(fx.store(spark, SMALL))
    one = tables.write_table(df, "stores_csv", "csv", str(tmp_path / "csv"), single_file=True)
    assert one.count() == df.count()
    by_type = tables.write_table(
        df, "stores_parquet", path=str(tmp_path / "parquet"), partition_by=["store_type"]
    )
    assert "PartitionFilters: [isnotnull(store_type" in by_type.filter(
        "store_type = 'A'"
    )._jdf.queryExecution().executedPlan().toString()
