"""Files with breaks inside quotes, cut into many byte ranges, against the csv module."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from ordermill.sources import split_csv, tables
from ordermill.sources.schemas import SCHEMAS
from ordermill.sources.tables import load_tables, read_csv_table

PRODUCTS = SCHEMAS["products"]
HEADER = "product_id,product_name,category,subcategory,cost_price"


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of a few lines."""
    conf = {"spark.sql.files.maxPartitionBytes": "200b", "spark.sql.files.openCostInBytes": "1b"}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key in conf:
        spark.conf.unset(key)


def write(path, rows, end, quoting=csv.QUOTE_MINIMAL):
    text = io.StringIO()
    writer = csv.writer(text, lineterminator=end, quoting=quoting)
    writer.writerow(HEADER.split(","))
    writer.writerows(rows)
    path.write_bytes(text.getvalue().encode())


def odd_rows(seed, count, breaks="\n"):
    draw = random.Random(seed)
    pool = ["a", "é", '"', '""', ",", " ", "x y", breaks, breaks + breaks, '"' + breaks, "long " * 30]
    return [(f"P{i}", "n" + "".join(draw.choice(pool) for _ in range(draw.randint(0, 12))), "c", f"s{i}", "1.5") for i in range(count)]


def both(spark, path):
    found = read_csv_table(spark, str(path), PRODUCTS).collect()
    return sorted((r.product_id, r.product_name, r.subcategory) for r in found)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", range(3))
def test_like_the_csv_module(spark, tmp_path, small_ranges, seed, end):
    rows = odd_rows(seed, 150, ["\n", "\r\n", "\n\r"][seed])
    write(tmp_path / "products.csv", rows, end)
    path = str(tmp_path / "products.csv")
    assert split_csv.largest_file(spark, path) > split_csv.split_bytes(spark)
    assert split_csv._lines(spark, path).rdd.getNumPartitions() > 20
    assert both(spark, path) == sorted((r[0], r[1], r[3]) for r in rows)


def test_a_record_over_many_ranges_and_an_open_end(spark, tmp_path, small_ranges):
    rows = [("P1", "line\n" * 300 + "end", "c", "s1", "1"), ("P2", "x", "c", "s2", ""), ("P3", 'q"\n' * 100, "c", "s3", "2")]
    write(tmp_path / "products.csv", rows, "\n")
    assert both(spark, tmp_path / "products.csv") == sorted((r[0], r[1], r[3]) for r in rows)


def test_several_files_and_like_the_unsplit_reader(spark, tmp_path, small_ranges):
    folder = tmp_path / "products.csv"
    folder.mkdir()
    rows = odd_rows(7, 90)
    for k in range(3):
        write(folder / f"part-{k}.csv", rows[k * 30 : k * 30 + 30], "\n", csv.QUOTE_ALL)
    (folder / "empty.csv").write_text(HEADER + "\n")
    split = both(spark, folder)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert split == both(spark, folder) == sorted((r[0], r[1], r[3]) for r in rows)


def test_files_without_breaks_take_the_plain_reader(spark, tmp_path, small_ranges):
    rows = [(f"P{i}", f'quoted, "{i}"', "c", "s", "1") for i in range(100)]
    write(tmp_path / "products.csv", rows, "\n")
    path = str(tmp_path / "products.csv")
    assert split_csv.read_records(spark, path, PRODUCTS.fieldNames()) is None
    plan = read_csv_table(spark, path, PRODUCTS)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "Format: CSV" in plan
    assert len(both(spark, path)) == 100


@pytest.mark.parametrize("line", ["P1,a,b,c,1,extra", "P1,a,b", "P1,a,b,c,much"])
def test_broken_records_raise(spark, tmp_path, small_ranges, line):
    write(tmp_path / "products.csv", odd_rows(1, 60), "\n")
    with open(tmp_path / "products.csv", "a") as file:
        file.write(line + "\n")
    with pytest.raises(Exception):
        read_csv_table(spark, str(tmp_path / "products.csv"), PRODUCTS).collect()


def test_a_record_of_the_wrong_length_raises_for_any_column(spark, tmp_path, small_ranges):
    write(tmp_path / "products.csv", odd_rows(1, 60) + [("P1", "a", "b")], "\n")
    with pytest.raises(Exception):
        read_csv_table(spark, str(tmp_path / "products.csv"), PRODUCTS).select(F.max("product_id")).collect()


def test_a_wrong_header_raises(spark, tmp_path, small_ranges):
    write(tmp_path / "products.csv", odd_rows(1, 60), "\n")
    text = (tmp_path / "products.csv").read_text().replace("product_id,product_name", "product_name,product_id", 1)
    (tmp_path / "products.csv").write_text(text)
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_table(spark, str(tmp_path / "products.csv"), PRODUCTS).collect()


@pytest.mark.parametrize("database", [None, "split_loads"])
def test_load_tables_splits_too(spark, tmp_path, small_ranges, database):
    spark.sql("CREATE DATABASE IF NOT EXISTS split_loads")
    rows = odd_rows(3, 120)
    write(tmp_path / "products.csv", rows, "\n")
    report = load_tables(spark, str(tmp_path), ["products"], database=database, prefix="split_").first()
    assert (report.rows, report.status) == (120, "loaded")
    found = spark.table(f"{database}.split_products" if database else "split_products").collect()
    assert sorted((r.product_id, r.product_name) for r in found) == sorted(r[:2] for r in rows)


def test_a_filter_does_not_parse_twice(spark, tmp_path, small_ranges):
    write(tmp_path / "products.csv", odd_rows(1, 60), "\n")
    df = read_csv_table(spark, str(tmp_path / "products.csv"), PRODUCTS).where("product_id = 'P3'")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") == 1 and tables.split_csv is split_csv
