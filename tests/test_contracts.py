import pytest

from fileflow.operators.contracts import (SchemaValidationError, duplicate_summary, enforce, orphans,
                                          raise_on_error, validate)
from fileflow.schemas import ColumnSpec

PARCEL = "parcel_no long, depot string, route string, weight double"
PARCELS = [(71, "north", "A7", 2.5), (72, "south", "B1", 0.4), (73, "north", "C22", 11.0)]
SPECS = [ColumnSpec("parcel_no", "int64", nullable=False),
         ColumnSpec("route", "object", max_length=3),
         ColumnSpec("depot", "object", allowed_values=["north", "south", "harbour"]),
         ColumnSpec("weight", "float64")]


def test_pass(spark):
    assert validate(spark.createDataFrame(PARCELS, PARCEL), SPECS) == []


def test_missing_required_column(spark):
    df = spark.createDataFrame(PARCELS, PARCEL).drop("parcel_no")
    vs = validate(df, SPECS + [ColumnSpec("remark", "object")])
    assert [v.message for v in vs] == ["Missing required column: 'parcel_no'"]


def test_nulls_in_non_nullable(spark):
    df = spark.createDataFrame([(None, "x"), (4, None), (None, None), (9, "y")], "slot int, crew string")
    vs = validate(df, [ColumnSpec("slot", "int32", nullable=False), ColumnSpec("crew", "object")])
    assert [(v.rule, v.n_bad) for v in vs] == [("not_null", 2)]


def test_allowed_values_samples(spark):
    rows = [(c,) for c in ["red", "teal", "teal", None, "ochre", "blue", "umber", "sand", "lime", "mint"]]
    vs = validate(spark.createDataFrame(rows, "paint string"),
                  [ColumnSpec("paint", "object", allowed_values=["red", "blue"])])
    assert vs[0].n_bad == 7 and vs[0].samples == ["lime", "mint", "ochre", "sand", "teal"]
    assert "Allowed: ['red', 'blue']" in vs[0].message


def test_max_length_and_types(spark):
    df = spark.createDataFrame([("K-1", 3), ("K-1234", 4), ("K-98765", None)], "tag string, load_t int")
    specs = [ColumnSpec("tag", "object", max_length=5), ColumnSpec("load_t", "float64")]
    assert [(v.column, v.rule, v.n_bad) for v in validate(df, specs)] == [
        ("tag", "max_length", 2), ("load_t", "float_type", 1)]
    with pytest.raises(SchemaValidationError, match="failed with 2 error"):
        raise_on_error(df, specs)


def test_constraints(spark):
    df = spark.createDataFrame([(5, "u"), (5, "u"), (6, "v"), (5, "w"), (None, "x")], "pier long, ship string")
    r = duplicate_summary(df, ["pier"]).first()
    assert (r.dup_groups, r.surplus_rows) == (1, 2)
    piers = spark.createDataFrame([(6,), (8,)], "pier long")
    assert sorted(x.ship for x in orphans(df, piers, ["pier"]).collect()) == ["u", "u", "w"]
    enforce(df, not_null=["ship"], unique=["pier", "ship", "ship"][:0])
    with pytest.raises(SchemaValidationError, match="null values in"):
        enforce(df, not_null=["pier", "ship"])
    with pytest.raises(SchemaValidationError, match="2 repeated rows"):
        enforce(df, unique=["pier"])
