"""Cleaning steps, text and date rules, readers and writers."""

import datetime as dt
import random
import re

import pandas as pd
import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from ordermill.functions.dates import parse_mixed_timestamp
from ordermill.functions.text import is_valid_email, title_case
from ordermill.plans import cleaning
from ordermill.sources import tables as storing
from ordermill.sources.schemas import CLEAN_SCHEMAS, NA_TOKENS, SCHEMAS
from ordermill.sources.tables import load_tables, read_csv_table, read_raw, write_tables

DATES = {
    "2024-03-05 10:00:00": dt.datetime(2024, 3, 5, 10),
    "05-03-2024 10:00:00": dt.datetime(2024, 3, 5, 10),
    "25-12-2023 01:02:03": dt.datetime(2023, 12, 25, 1, 2, 3),
    "12-25-2023 01:02:03": dt.datetime(2023, 12, 25, 1, 2, 3),
    "5/3/2024": dt.datetime(2024, 3, 5),
    "2024-03-05": dt.datetime(2024, 3, 5),
    # A local time that some zones skip; no zone may touch it.
    "31-03-2024 02:30:00": dt.datetime(2024, 3, 31, 2, 30),
}


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def computed(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_dates(spark):
    got = computed(column(spark, DATES), parse_mixed_timestamp(F.col("x")))
    assert got == list(DATES.values())
    for text, value in DATES.items():
        assert pd.to_datetime(text, format="mixed", dayfirst=True) == value


@pytest.mark.filterwarnings("ignore")
def test_dates_against_pandas(spark):
    rng = random.Random(5)
    moments = [dt.datetime(2022, 1, 1) + dt.timedelta(seconds=rng.randrange(10**8)) for _ in range(500)]
    formats = ["%Y-%m-%d %H:%M:%S", "%d-%m-%Y %H:%M:%S", "%d/%m/%Y", "%Y-%m-%d"]
    texts = [m.strftime(rng.choice(formats)) for m in moments]
    got = computed(column(spark, texts), parse_mixed_timestamp(F.col("x")))
    assert got == [t.to_pydatetime() for t in pd.to_datetime(texts, format="mixed", dayfirst=True)]


def test_dates_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        got = computed(column(spark, DATES), parse_mixed_timestamp(F.col("x")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == list(DATES.values())


@pytest.mark.parametrize("text", ["junk", "2024-13-45", "45-45-2024 10:00:00", "", "10:00"])
def test_no_date(spark, text):
    assert computed(column(spark, [text, None]), parse_mixed_timestamp(F.col("x"))) == [None, None]


def raw_orders(spark, *rows):
    return spark.createDataFrame(rows, "order_id string, customer_id string, order_date string")


def test_clean_orders_drops_null_customers_only(spark):
    orders = raw_orders(
        spark,
        ("O1", "C1", "2024-03-05 10:00:00"),
        ("O2", None, "junk"),
        ("O3", "C2", "05-03-2024 10:00:00"),
        ("O4", "C2", None),
    )
    got = {r.order_id: r.order_date for r in cleaning.clean_orders(orders).collect()}
    moment = dt.datetime(2024, 3, 5, 10)
    assert got == {"O1": moment, "O3": moment, "O4": None}


def test_bad_date_raises_or_is_quarantined(spark):
    orders = raw_orders(spark, ("O1", "C1", "junk"), ("O2", "C1", "2024-01-01 00:00:00"))
    with pytest.raises(PySparkException, match="not a date: junk"):
        cleaning.clean_orders(orders).collect()
    kept = cleaning.clean_orders(orders, on_bad="quarantine").filter("order_date IS NULL")
    assert [r.order_id for r in kept.collect()] == ["O1"]
    assert [r.order_id for r in cleaning.bad_order_dates(orders).collect()] == ["O1"]
    with pytest.raises(ValueError):
        cleaning.clean_orders(orders, on_bad="ignore")


def python_title(text):
    return " ".join(text.strip().title().split())


def test_title_case(spark):
    texts = ["  o'neil   x-ray 3d ", "GREAT\tBLUE  bolt", "", "   ", "a", "éclair ÉTÉ", "4x4 tyre"]
    got = computed(column(spark, [*texts, None]), title_case(F.col("x")))
    assert got == [*map(python_title, texts), None]
    assert got[0] == "O'Neil X-Ray 3D"


def test_title_case_on_random_text(spark):
    rng = random.Random(11)
    letters = "abcXYZéÀñ019 '-_.,\t\n  \x1c  "
    texts = ["".join(rng.choices(letters, k=rng.randrange(0, 25))) for _ in range(3000)]
    assert computed(column(spark, texts), title_case(F.col("x"))) == [*map(python_title, texts)]


EMAILS = {
    "a@b.co": True,
    "a@b": False,
    "ab.co": False,
    "a b@c.de": False,
    "a@b@c.de": False,
    "a@b..co": True,
    "@b.co": False,
    "a@.co": False,
    "a@b.": False,
    " a@b.co": False,
    "a@b.c o": False,
    "ü@b.co": True,
    "": False,
}


def test_emails(spark):
    got = computed(column(spark, [*EMAILS, None]), is_valid_email(F.col("x")))
    assert got == [*EMAILS.values(), False]


def test_emails_against_a_python_pattern(spark):
    # A fixed value: the rule that malformed emails are defined by.
    pattern = re.compile(r"^[^@\s]+@[^@\s]+\.[^@\s]+$")
    rng = random.Random(2)
    texts = ["".join(rng.choices("ab@@..  \t\n\x1d é", k=rng.randrange(3, 9))) for _ in range(4000)]
    got = computed(column(spark, texts), is_valid_email(F.col("x")))
    assert got == [bool(pattern.match(t)) for t in texts]
    assert any(got)


def test_items_of_dropped_orders_are_orphans(spark):
    orders = raw_orders(spark, ("O1", "C1", "2024-01-01"), ("O2", None, "2024-01-01"))
    items = spark.createDataFrame(
        [("I1", "O1"), ("I2", "O2"), ("I3", "O9"), ("I4", None)], "item_id string, order_id string"
    )
    found = cleaning.orphan_items(items, cleaning.clean_orders(orders))
    assert sorted(r.item_id for r in found.collect()) == ["I2", "I3", "I4"]
    assert cleaning.count_orphan_items(items, cleaning.clean_orders(orders)).first().n == 3


@pytest.fixture
def raw_tables(spark):
    moment = dt.datetime(2024, 1, 1, 9, 30)
    return {
        "customers": spark.createDataFrame(
            [
                ("C1", "Ann", "a@b.co", moment, "VIP"),
                ("C2", "Bob", "bob", moment, "VIP"),
                ("C3", "Cy", None, moment, "VIP"),
                ("C4", "Di", "x@y", moment, "VIP"),
                ("C5", "Ed", "x y@z.co", moment, None),
            ],
            SCHEMAS["customers"],
        ),
        "products": spark.createDataFrame(
            [("P1", '  odd "name", x  ', "Home", "s", None), ("P2", "PLAIN", "Books", "s", None)],
            SCHEMAS["products"],
        ),
        "orders": raw_orders(
            spark, ("O1", "C1", "05-03-2024 10:00:00"), ("O2", None, "2024-03-05 10:00:00")
        ).withColumns({"status": F.lit("PLACED"), "region_code": F.lit("KA")}),
        "order_items": spark.createDataFrame(
            [("I1", "O1", "P1", -3, None, 150.0), ("I2", "O2", "P2", 2, None, None)],
            SCHEMAS["order_items"],
        ),
    }


def test_validation_report(spark, raw_tables):
    report = {r.check: (r.n, r["sample"]) for r in cleaning.validation_report(raw_tables).collect()}
    assert report == {
        "null_customer_orders": (1, None),
        "invalid_emails": (4, ["C2", "C3", "C4"]),
        "orphan_items": (1, None),
    }


def test_split_invalid(raw_tables):
    passed, rejected = cleaning.split_invalid(cleaning.clean_tables(raw_tables))
    ids = {n: sorted(r[0] for r in df.collect()) for n, df in passed.items()}
    assert ids["customers"] == ["C1"] and ids["order_items"] == ["I1"] and len(ids["products"]) == 2
    assert sorted(r[0] for r in rejected["customers"].collect()) == ["C2", "C3", "C4", "C5"]
    assert [r[0] for r in rejected["order_items"].collect()] == ["I2"]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_pipeline_from_csv_to_loaded_tables(spark, raw_tables, tmp_path, fmt):
    write_tables(raw_tables, str(tmp_path / "raw"))
    report = cleaning.run_pipeline(read_raw(spark, str(tmp_path / "raw")), str(tmp_path / "out"), fmt)
    assert {r.check: r.n for r in report.collect()}["invalid_emails"] == 4
    loaded = load_tables(spark, str(tmp_path / "out"), fmt=fmt, schemas=CLEAN_SCHEMAS)
    assert {r.table: (r.rows, r.status) for r in loaded.collect()} == {
        "customers": (5, "loaded"),
        "products": (2, "loaded"),
        "orders": (1, "loaded"),
        "order_items": (2, "loaded"),
    }
    names = [r[0] for r in spark.table("products").orderBy("product_id").select("product_name").collect()]
    assert names == ['Odd "Name", X', "Plain"]
    assert spark.table("orders").first().order_date == dt.datetime(2024, 3, 5, 10)
    assert sorted(r.quantity for r in spark.table("order_items").collect()) == [2, 3]
    assert spark.table("customers").filter("customer_id = 'C3'").first().email is None


def test_load_goes_on_after_a_missing_and_a_bad_table(spark, raw_tables, tmp_path):
    write_tables({n: raw_tables[n] for n in ("products", "orders")}, str(tmp_path))
    (tmp_path / "order_items.csv").write_text(
        "item_id,order_id,product_id,quantity,unit_price,discount_percent\nI1,O1,P1,many,1,1\n"
    )
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    report = load_tables(spark, str(tmp_path), database="shop")
    status = {r.table: (r.rows, r.status.split(":")[0]) for r in report.collect()}
    assert status == {
        "customers": (None, "missing"),
        "products": (2, "loaded"),
        "orders": (2, "loaded"),
        "order_items": (None, "failed"),
    }
    again = load_tables(spark, str(tmp_path), ["products"], database="shop").first()
    assert (again.rows, again.status) == (2, "loaded") and spark.table("shop.products").count() == 2


def test_missing_raw_table_raises_at_once(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_raw(spark, str(tmp_path))


def test_missing_value_texts(spark, tmp_path):
    path = tmp_path / "orders.csv"
    lines = [f"O{i},{token},2024-01-01,PLACED,KA" for i, token in enumerate([*NA_TOKENS, "na", " "])]
    path.write_text("order_id,customer_id,order_date,status,region_code\n" + "\n".join(lines))
    got = read_csv_table(spark, str(path), SCHEMAS["orders"]).orderBy("order_id").collect()
    ours = {r.order_id: r.customer_id for r in got}
    theirs = pd.read_csv(path).set_index("order_id").customer_id
    assert ours == {k: None if pd.isna(v) else v for k, v in theirs.items()}


def test_csv_header_must_match(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text("order_id,status,order_date,customer_id,region_code\nO1,PLACED,2024-01-01,C1,KA\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_table(spark, str(path), SCHEMAS["orders"]).collect()


def test_numbers_with_a_decimal_point_fit_integer_columns(spark, tmp_path):
    path = tmp_path / "order_items.csv"
    path.write_text(
        "item_id,order_id,product_id,quantity,unit_price,discount_percent\nI1,O1,P1,3.0,2.50,150\n"
    )
    row = read_csv_table(spark, str(path), SCHEMAS["order_items"]).first()
    assert (row.quantity, float(row.unit_price), row.discount_percent) == (3, 2.5, 150.0)


def test_line_breaks_inside_quotes(spark, tmp_path):
    products = spark.createDataFrame([("P1", 'two\n"lines"', "Home", "s", None)], SCHEMAS["products"])
    write_tables({"products": products}, str(tmp_path))
    schemas = {"products": SCHEMAS["products"]}
    back = read_raw(spark, str(tmp_path), schemas, multiline=True)["products"]
    assert back.first().product_name == 'two\n"lines"'


ITEMS = "item_id,order_id,product_id,quantity,unit_price,discount_percent\n"


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("multiline", [True, False])
@pytest.mark.parametrize(
    "record",
    [
        "I1,O1,P1,2.7,1,0",
        "I1,O1,P1,many,1,0",
        "I1,O1,P1,3000000000,1,0",
        "I1,O1,P1,2,1.1234567,0",
        "I1,O1,P1,2,1,0,extra",
        "I1,O1,P1,2",
    ],
)
def test_nothing_is_altered_silently(spark, tmp_path, ansi, multiline, record):
    (tmp_path / "order_items.csv").write_text(f"{ITEMS}I0,O0,P0,1,1.125,0\n{record}\n")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        read = read_csv_table(spark, str(tmp_path / "order_items.csv"), SCHEMAS["order_items"], multiline)
        with pytest.raises(Exception):
            read.collect()
        report = load_tables(spark, str(tmp_path), ["order_items"], prefix="altered_").first()
        assert report.status.startswith("failed") and report.rows is None
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_three_decimals_are_read(spark, tmp_path):
    (tmp_path / "order_items.csv").write_text(f"{ITEMS}I0,O0,P0,1,0.125,12.345\n")
    row = read_csv_table(spark, str(tmp_path / "order_items.csv"), SCHEMAS["order_items"]).first()
    assert (float(row.unit_price), row.discount_percent) == (0.125, 12.345)


def test_a_quoted_break_raises_where_it_is_not_expected(spark, tmp_path):
    products = spark.createDataFrame([("P1", "two\nlines", "Home", "s", None)], SCHEMAS["products"])
    write_tables({"products": products}, str(tmp_path))
    schemas = {"products": SCHEMAS["products"]}
    assert read_raw(spark, str(tmp_path), schemas)["products"].first().product_name == "two\nlines"
    with pytest.raises(Exception):
        read_raw(spark, str(tmp_path), schemas, multiline=False)["products"].collect()


def test_swapped_headers_fail_in_view_mode(spark, tmp_path):
    swapped = ITEMS.replace("item_id,order_id", "order_id,item_id")
    (tmp_path / "order_items.csv").write_text(f"{swapped}I0,O0,P0,1,1,0\n")
    assert load_tables(spark, str(tmp_path), ["order_items"]).first().status.startswith("failed")


def test_a_failed_load_keeps_the_old_table(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS kept")
    path = tmp_path / "order_items.csv"
    path.write_text(f"{ITEMS}I0,O0,P0,1,1,0\n")
    assert load_tables(spark, str(tmp_path), ["order_items"], database="kept").first().status == "loaded"
    path.write_text(f"{ITEMS}I0,O0,P0,many,1,0\n")
    assert load_tables(spark, str(tmp_path), ["order_items"], database="kept").first().status.startswith("failed")
    assert spark.table("kept.order_items").collect()[0].item_id == "I0"
    assert [t.name for t in spark.catalog.listTables("kept") if not t.isTemporary] == ["order_items"]
    path.write_text(f"{ITEMS}I5,O0,P0,1,1,0\n")
    load_tables(spark, str(tmp_path), ["order_items"], database="kept")
    assert [r.item_id for r in spark.table("kept.order_items").collect()] == ["I5"]


def test_refused_buckets_show(spark, tmp_path, monkeypatch):
    spark.sql("CREATE DATABASE IF NOT EXISTS refused")
    rows = "".join(f"I{i},O0,P0,1,1,0\n" for i in range(50))
    (tmp_path / "order_items.csv").write_text(ITEMS + rows)
    monkeypatch.setattr(storing, "MANY_ROWS", 10)
    status = load_tables(spark, str(tmp_path), ["order_items"], database="refused", buckets=8).first().status
    assert status.startswith("loaded without buckets")


def test_other_date_forms(spark):
    forms = {
        "2024/03/05": "2024-03-05 00:00:00",
        "05 Mar 2024": "2024-03-05 00:00:00",
        "March 5, 2024": "2024-03-05 00:00:00",
        "5-3-24": "2024-03-05 00:00:00",
        "20240305": "2024-03-05 00:00:00",
        "05-03-2024 10:00 PM": "2024-03-05 22:00:00",
        "5-Mar-2024 12:30 am": "2024-03-05 00:30:00",
        "2024-03-05 10:00:00+05:30": "2024-03-05 04:30:00",
        "2024-03-05T10:00:00Z": "2024-03-05 10:00:00",
        "2024-02-30": None,
        "2024-03-05 25:00:00": None,
        "05/03/2024 13:00 PM": None,
        "5 Mux 2024": None,
    }
    got = computed(column(spark, list(forms)), parse_mixed_timestamp(F.col("x")))
    assert [None if g is None else str(g) for g in got] == list(forms.values())


def test_quarantine_keeps_the_raw_text(spark, tmp_path):
    orders = [("O1", "C1", "2024-03-05", "S", "R"), ("O2", "C1", "soon", "S", "R"), ("O3", None, "never", "S", "R")]
    raw = {n: spark.createDataFrame([], s) for n, s in SCHEMAS.items()}
    raw["orders"] = spark.createDataFrame(orders, SCHEMAS["orders"])
    found = {r.check: r.n for r in cleaning.run_pipeline(raw, str(tmp_path), on_bad="quarantine").collect()}
    assert found == {"null_customer_orders": 1, "bad_order_dates": 1, "orphan_items": 0, "invalid_emails": 0}
    rejected = spark.read.parquet(str(tmp_path / "rejected_orders.parquet")).collect()
    assert [(r.order_id, r.order_date) for r in rejected] == [("O2", "soon")]
