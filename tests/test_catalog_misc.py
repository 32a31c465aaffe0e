import json

import pytest
from pyspark.sql import functions as F

from fileflow.operators import catalog, contracts
from fileflow.plans.lake import Lake
from fileflow.plans.extract import extract
from fileflow.plans.transform import transform_load
from fileflow.sources.landing import bronze_object, exists, read_manifest_document
from tests.conftest import write


def test_catalog_listing_and_resolve(spark):
    spark.createDataFrame([(1, None)], "a long, loaded_at timestamp").createOrReplaceTempView("zz_one")
    spark.createDataFrame([], "b string").createOrReplaceTempView("zz_two")
    names = {r.name: r.row_count for r in catalog.list_datasets(spark).collect()}
    assert names["zz_one"] == 1 and names["zz_two"] == 0
    assert catalog.resolve(spark, "zz_one").columns == ["a", "loaded_at"]
    with pytest.raises(KeyError):
        catalog.resolve(spark, "no_such_dataset")
    st = catalog.stats(catalog.resolve(spark, "zz_one"), "zz_one").first()
    assert st.row_count == 1 and st.null_rates == {"a": 0.0, "loaded_at": 1.0}


def test_nested_manifest_document(spark, scratch):
    doc = {"run_date": "2024-01-01", "created_at": "2024-01-01T00:00:00", "file_count": 2,
           "files": [{"file_name": "a.csv", "minio_key": "2024-01-01/a.csv", "size_bytes": 3},
                     {"file_name": "b.csv", "minio_key": "2024-01-01/b.csv", "size_bytes": 4}]}
    write(f"{scratch}/m/manifest.json", json.dumps(doc, indent=2))
    write(f"{scratch}/n/manifest.json", json.dumps({"run_date": "2024-01-02"}))
    got = read_manifest_document(spark, f"{scratch}/m").collect()
    assert sorted(r.file_name for r in got) == ["a.csv", "b.csv"]
    assert read_manifest_document(spark, f"{scratch}/n").count() == 0


def test_exists_and_null_counts(spark):
    man = spark.createDataFrame([("d/a.csv",), ("d/b.csv",)], "storage_path string")
    keys = spark.createDataFrame([("d/a.csv",), ("d/zz.csv",)], "storage_path string")
    assert [r.storage_path for r in exists(man, keys).collect()] == ["d/a.csv"]
    df = spark.createDataFrame([(1, None), (None, None)], "a long, b string")
    got = {r.column: r.n_null for r in contracts.null_counts(df, ["a", "b"]).collect()}
    assert got == {"a": 1, "b": 2}


def test_packed_mode_and_bronze_object(spark, scratch):
    src = f"{scratch}/src"
    write(f"{src}/a.csv", "id,name\n1,x\n2,\n")
    lake = Lake(spark, f"{scratch}/lake")
    extract(spark, lake, src, "2024-01-01", "r1")
    res = transform_load(spark, lake, "2024-01-01", "r1", mode="packed")
    assert (res.rows_inserted, res.rows_updated) == (2, 0)
    rows = sorted(lake.table("elt_data").read().collect(), key=lambda r: r.row_id)
    assert [r.data_id for r in rows] == [1, 2]
    assert [json.loads(r.data_json) for r in rows] == [{"id": 1, "name": "x"},
                                                       {"id": 2, "name": None}]
    # a second load of the same run updates in place and keeps the identities
    res2 = transform_load(spark, lake, "2024-01-01", "r1", mode="packed")
    assert (res2.rows_inserted, res2.rows_updated) == (0, 2)
    assert sorted(r.data_id for r in lake.table("elt_data").read().collect()) == [1, 2]
    b = bronze_object(lake.bronze.read(), "2024-01-01/a.csv").first()
    assert bytes(b.content) == b"id,name\n1,x\n2,\n"
