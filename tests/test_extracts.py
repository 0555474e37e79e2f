"""CSV extracts: a round trip of the shop, and published totals where extracts are given."""

import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from basketry.plans import marts, quality
from basketry.plans.warehouse import Warehouse
from basketry.sources import RAW_COLUMNS, raw_extracts
from tests import shop

EXTRACTS = os.environ.get("BASKETRY_EXTRACTS")


def write_csv(folder, name, data, newline="\n"):
    lines = [RAW_COLUMNS[name], *data]
    text = newline.join(",".join('"' + (x or "") + '"' for x in line) for line in lines)
    (folder / f"raw_{name}.csv").write_bytes((text + newline).encode())


def test_quoted_extracts_with_either_line_end(spark, tmp_path):
    write_csv(tmp_path, "users", shop.USERS, "\r\n")
    write_csv(tmp_path, "products", shop.PRODUCTS)
    write_csv(tmp_path, "orders", shop.ORDERS)
    write_csv(tmp_path, "order_items", shop.ITEMS)
    write_csv(tmp_path, "returns", shop.RETURNS)
    wh = Warehouse(raw_extracts(spark, str(tmp_path)))
    assert [t.count() for _, t in wh.staged.items()] == [4, 4, 7, 8, 3]
    assert wh.staged.users.where("user_id = 1").first().customer_segment == "PREMIUM"
    assert wh.fct_orders.count() == 7


def test_a_doubled_quote_is_part_of_the_field(spark, tmp_path):
    product = ("10", 'Shelf 30"", oak', "home", "7", "4.00", shop.T0)
    write_csv(tmp_path, "products", [product])
    row = raw_extracts(spark, str(tmp_path)).products.first()
    assert row.product_name == 'Shelf 30", oak' and row.category == "home"


def test_a_changed_header_is_an_error(spark, tmp_path):
    write_csv(tmp_path, "users", shop.USERS)
    path = tmp_path / "raw_users.csv"
    path.write_text(path.read_text().replace('"email"', '"mail"'))
    from basketry.sources import read_raw

    with pytest.raises((PySparkException, Py4JJavaError), match="header"):
        read_raw(spark, str(tmp_path), "users").collect()


@pytest.mark.skipif(not EXTRACTS, reason="set BASKETRY_EXTRACTS to a folder of raw_*.csv files")
def test_published_totals(spark):
    wh = Warehouse(raw_extracts(spark, EXTRACTS))
    done = wh.order_metrics.where("is_completed")
    totals = done.agg(
        F.sum("gross_item_sales"), F.sum("total_refund_amount"), F.sum("net_sales"), F.count("*")
    ).first()
    assert [float(x) for x in totals] == [13722.49, 3845.0, 9877.49, 117]
    dim = wh.dim_customers
    tiers = {r[0]: r[1] for r in dim.groupBy("loyalty_tier").count().collect()}
    assert tiers == {"VIP": 1, "GROWTH": 23, "NEW": 16}
    bands = {r[0]: r[1] for r in dim.groupBy("engagement_band").count().collect()}
    assert bands == {"LOYAL": 1, "ACTIVE": 37, "NEW": 2}
    assert marts.segment_performance(dim).count() == 7
    assert wh.product_performance.where("orders_sold = 0").count() == 12
    staged = {f"stg_{n}": df for n, df in wh.staged.items()}
    report = quality.run_checks(staged)
    assert report.where("status = 'fail'").count() == 0
