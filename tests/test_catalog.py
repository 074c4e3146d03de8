"""Catalog: ensure, look-up, listing, views, drop, teardown."""

import pytest

from shoreline.operators.catalog import Catalog, CatalogError
from shoreline.operators.schema import SchemaError


@pytest.fixture
def cat(spark, scratch):
    return Catalog(spark, scratch("warehouse"), "harbour").ensure("moorings")


def test_look_up_and_listing(spark, cat):
    df = spark.range(4).selectExpr("id", "id * 2 as twice")
    cat.create("berths", df.schema, data=df)
    cat.create("_staging", df.schema)
    assert cat.exists() and cat.ensure() is cat
    assert cat.table_names() == ["_staging", "berths"]
    assert {(r.table_name, r.rows, r.columns) for r in cat.tables().collect()} == {("berths", 4, 2), ("_staging", 0, 2)}
    assert cat.table_by_name("berths").read().count() == 4 and cat.table_by_name("nope") is None
    assert cat.table("nope").name == "nope" and cat.table("nope").column_names() is None
    assert cat.register_views() == ["_staging", "berths"]
    assert spark.sql("SELECT sum(twice) AS s FROM berths").first().s == 12


def test_unknown_columns_raise(spark, cat):
    t = cat.create("strict", "id long, v string")
    with pytest.raises(SchemaError, match="_score"):
        t.insert(spark.createDataFrame([(1, "a", 0.5)], "id long, v string, _score double"))
    assert t.row_count() == 0


def test_drop(spark, cat, scratch):
    cat.create("one", "id long")
    assert cat.drop("one") and not cat.drop("one")
    with pytest.raises(CatalogError):
        cat.drop("one", if_exists=False)
    cat.create("two", "id long")
    cat.drop_catalog()
    assert not cat.exists() and cat.table_names() == []
    with pytest.raises(CatalogError):
        cat.create("three", "id long", auto_create_catalog=False)


def test_numeric_keeps_its_digits(spark, cat):
    t = cat.create("sums", [{"name": "v", "type": "NUMERIC"}])
    t.insert(spark.sql("SELECT CAST('12345678901234567.123456789' AS DECIMAL(38, 9)) AS v"))
    assert str(t.read().first().v) == "12345678901234567.123456789"
