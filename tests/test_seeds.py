"""Seed files with wrong rows: what is accepted, what is rejected and why."""

import datetime as dt
import os
from decimal import Decimal

from loanmart.sources import seeds


def write(tmp_path, name, text):
    path = os.path.join(tmp_path, name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def test_rejects_have_reasons(spark, tmp_path):
    write(tmp_path, "delinquency_buckets.csv", "bucket_code,bucket_name,dpd_min,dpd_max,is_delinquent,severity_order\r\n"
          "OK,Al día,0,0,N,1\r\nBAD,words,one,29,Y,2\r\n,no code,1,2,Y,3\r\nTURNED,over,9,3,Y,4\r\nOK,again,5,6,N,7\r\n"
          "SHORT,row,1\r\nLONG,row,1,2,Y,3,4\r\nTWO,  ,x,2,Y,3\r\n\"Q,uoted\",a b,1,2,Y,5\r\n")
    accepted, rejects = seeds.split_seed(spark, str(tmp_path), "buckets")
    assert accepted.dtypes == [(f.name, f.dataType.simpleString()) for f in seeds.BUCKET_SCHEMA.fields]
    assert sorted((r.bucket_code, r.bucket_name, r.dpd_min, r.severity_order) for r in accepted.collect()) == [("OK", "Al día", 0, 1), ("Q,uoted", "a b", 1, 5)]
    got = {(r.bucket_code, r.bucket_name): r.reason for r in rejects.collect()}
    assert got == {("BAD", "words"): "dpd_min: not a bigint", (None, "no code"): "bucket_code: missing", ("TURNED", "over"): "not dpd_min <= dpd_max",
                   ("OK", "again"): "bucket_code: repeated", ("SHORT", "row"): "wrong number of columns", ("LONG", "row"): "wrong number of columns",
                   ("TWO", "  "): "bucket_name: missing; dpd_min: not a bigint"}


def test_accepted_rows_and_empty_files(spark, tmp_path):
    p = write(tmp_path, "holidays.csv", "date,holiday_name,holiday_type,is_bank_holiday\n2024-01-01,Año Nuevo,national,true\n2024-02-30,none,national,true\n")
    accepted, rejects = seeds.split_seed_csv(spark, p, seeds.HOLIDAY_SCHEMA)
    assert [tuple(r) for r in accepted.collect()] == [(dt.date(2024, 1, 1), "Año Nuevo", "national", True)]
    assert [(r.date, r.reason) for r in rejects.collect()] == [("2024-02-30", "date: not a date")]
    empty = write(tmp_path, "products.csv", "product_code,product_name,product_type,risk_tier,min_amount_ars,max_amount_ars,max_term_months\n")
    assert [d.count() for d in seeds.split_seed_csv(spark, empty, seeds.PRODUCT_SCHEMA, "min_amount_ars <= max_amount_ars", "product_code")] == [0, 0]
    write(tmp_path, "products.csv", "product_code,product_name,product_type,risk_tier,min_amount_ars,max_amount_ars,max_term_months\nA,a,t,low,1.50,2,0\nB,b,t,low,9,2,0\n")
    accepted, rejects = seeds.split_seed(spark, str(tmp_path), "products")
    assert [(r.product_code, r.min_amount_ars) for r in accepted.collect()] == [("A", Decimal("1.50"))]
    assert [r.reason for r in rejects.collect()] == ["not min_amount_ars <= max_amount_ars"]
