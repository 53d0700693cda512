"""Sets of tables that change as a whole, and tables that are never missing."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ordermill.plans import cleaning
from ordermill.sources import tables as loading
from ordermill.sources import versions
from ordermill.sources.schemas import CLEAN_SCHEMAS, SCHEMAS


def raw(spark, label, broken=False):
    one = {
        "customers": [(f"C{label}", "n", "a@b.c", None, "VIP")],
        "products": [(f"P{label}", "a name", "Home", "s", None)],
        "orders": [(f"O{label}", f"C{label}", "2024-03-05", "S", "R")],
        "order_items": [(f"I{label}", f"O{label}", f"P{label}", 1, None, 0.0)],
    }
    tables = {n: spark.createDataFrame(rows, SCHEMAS[n]) for n, rows in one.items()}
    if broken:  # killed while the items are written, after the three tables before them
        killed = F.raise_error(F.lit("killed")).cast("int")
        tables["order_items"] = tables["order_items"].withColumn("quantity", killed)
    return tables


def ids(spark, folder):
    found = versions.published(spark, folder, CLEAN_SCHEMAS)
    return {n: [r[0] for r in df.collect()] for n, df in found.items()}


def whole(label):
    return {"customers": [f"C{label}"], "products": [f"P{label}"], "orders": [f"O{label}"], "order_items": [f"I{label}"]}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_run_killed_between_two_tables_changes_nothing(spark, tmp_path, fmt):
    folder = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        versions.current(spark, folder)
    cleaning.run_pipeline(raw(spark, 1), folder, fmt, versioned=True)
    before = versions.published(spark, folder, CLEAN_SCHEMAS)
    with pytest.raises(PySparkException, match="killed"):
        cleaning.run_pipeline(raw(spark, 2, broken=True), folder, fmt, versioned=True)
    written = [p for p in (tmp_path / "out" / "versions").iterdir() if (p / f"customers.{fmt}").exists()]
    assert len(written) == 2  # the killed run had got to its customers
    assert ids(spark, folder) == whole(1)
    cleaning.run_pipeline(raw(spark, 3), folder, fmt, versioned=True)
    assert ids(spark, folder) == whole(3)
    # Who began with the version before still reads it, whole.
    assert {n: [r[0] for r in df.collect()] for n, df in before.items()} == whole(1)


def test_a_reader_never_mixes_versions(spark, tmp_path):
    folder = str(tmp_path)
    versions.publish(raw(spark, 1), folder)
    found = versions.published(spark, folder, SCHEMAS)
    customers = found["customers"].collect()
    versions.publish(raw(spark, 2), folder)
    assert [customers[0][0], found["orders"].first()[0]] == ["C1", "O1"]
    assert versions.published(spark, folder, SCHEMAS)["orders"].first()[0] == "O2"


def test_old_and_lost_versions_go(spark, tmp_path):
    folder = str(tmp_path)
    for label in range(4):
        assert versions.publish(raw(spark, label), folder) == label + 1
    assert len(list((tmp_path / "versions").iterdir())) == len([p for p in (tmp_path / "commits").iterdir() if p.name.isdigit()]) == 2
    lost = versions.new_version(folder)
    spark.range(1).write.parquet(f"{lost}/orders.parquet")
    assert versions.sweep(spark, folder) == []
    assert versions.sweep(spark, folder, hours=0) == [lost.rsplit("/", 1)[1]]
    assert versions.published(spark, folder, SCHEMAS)["orders"].first()[0] == "O3"


def test_two_writers_get_two_numbers(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    versions.publish(raw(spark, 1), folder)
    other = versions.new_version(folder)
    spark.range(1).write.parquet(f"{other}/orders.parquet")
    known = versions._commits
    monkeypatch.setattr(versions, "_commits", lambda f: known(f)[:-1] if len(known(f)) == 1 else known(f))
    assert versions.commit(spark, folder, other, ["orders"], "parquet") == 2  # 1 was taken meanwhile


def test_a_loaded_table_is_never_missing(spark, tmp_path, monkeypatch):
    """Its content changes in one step of the catalog; what is asked between all others finds it."""
    spark.sql("CREATE DATABASE IF NOT EXISTS always")
    header = "product_id,product_name,category,subcategory,cost_price\n"
    (tmp_path / "products.csv").write_text(header + "P1,a,b,c,1\n")
    loading.load_tables(spark, str(tmp_path), ["products"], database="always")
    (tmp_path / "products.csv").write_text(header + "P2,a,b,c,1\n")
    seen, sql = [], spark.sql

    def spied(text, *args):
        seen.append((text.split()[0], [r[0] for r in spark.table("always.products").collect()]))
        return sql(text, *args)

    monkeypatch.setattr(spark, "sql", spied)
    report = loading.load_tables(spark, str(tmp_path), ["products"], database="always").first()
    monkeypatch.undo()
    assert report.status == "loaded" and all(len(rows) == 1 for _, rows in seen)
    assert "DROP" not in [word for word, rows in seen if rows == ["P1"]] and ("ALTER", ["P1"]) in seen
    assert [r[0] for r in spark.table("always.products").collect()] == ["P2"]
    for label in (3, 4):
        (tmp_path / "products.csv").write_text(f"{header}P{label},a,b,c,1\n")
        loading.load_tables(spark, str(tmp_path), ["products"], database="always")
    assert len(loading._contents(spark, "always", "products")) == versions.KEPT
    loading.drop_loaded(spark, "always", "products")
    assert not spark.catalog.tableExists("always.products") and loading._contents(spark, "always", "products") == []


def test_a_table_of_an_earlier_release_gives_way(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS older")
    spark.createDataFrame([("P0",)], "product_id string").write.mode("overwrite").saveAsTable("older.products")
    header = "product_id,product_name,category,subcategory,cost_price\n"
    (tmp_path / "products.csv").write_text(header + "P1,a,b,c,1\n")
    assert loading.load_tables(spark, str(tmp_path), ["products"], database="older").first().status == "loaded"
    assert [r[0] for r in spark.table("older.products").collect()] == ["P1"]
