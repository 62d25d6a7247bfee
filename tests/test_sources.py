"""CSV, lake and catalog sources; ingest checks."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from paylens.operators import ingest
from paylens.schemas import SOURCES
from paylens.sources import files

PAYMENTS = SOURCES["payments"]
HEADER = "payment_value,order_id,payment_sequential,payment_type,payment_installments"


def write(tmp_path, text):
    path = tmp_path / "in.csv"
    path.write_text(text)
    return str(path)


def read(spark, tmp_path, text, **options):
    return files.read_csv(spark, write(tmp_path, text), PAYMENTS, **options)


def test_columns_are_found_by_name_and_extra_ones_kept(spark, tmp_path):
    df = read(spark, tmp_path, HEADER + ",note\n10.50,a,1,voucher,2,x\n")
    assert dict(df.dtypes) == {**PAYMENTS.columns, "note": "string"}
    assert df.first().asDict() == {
        "payment_value": 10.5,
        "order_id": "a",
        "payment_sequential": 1,
        "payment_type": "voucher",
        "payment_installments": 2,
        "note": "x",
    }


def test_doubled_quotes_and_backslashes(spark, tmp_path):
    df = read(spark, tmp_path, HEADER + '\n1,"say ""hi"", ok",1,"a\\",1\n')
    assert (df.first().order_id, df.first().payment_type) == ('say "hi", ok', "a\\")


@pytest.mark.parametrize("text", ["", '""', "NA", "nan", "NULL", "None", "N/A"])
def test_missing_values_are_null(spark, tmp_path, text):
    row = read(spark, tmp_path, HEADER + f"\n{text},a,1,{text},{text}\n").first()
    assert (row.payment_value, row.payment_type, row.payment_installments) == (None,) * 3


def test_whole_numbers_may_have_a_point(spark, tmp_path):
    row = read(spark, tmp_path, HEADER + "\n1,a,1.0,x,12.000\n").first()
    assert (row.payment_sequential, row.payment_installments) == (1, 12)
    with pytest.raises(Exception, match="payment_installments is not a whole number: 1.5"):
        read(spark, tmp_path, HEADER + "\n1,a,1.0,x,1.5\n").collect()


def test_landing_counts_rows_and_checks_amounts(spark, tmp_path):
    text = HEADER + "\n0.000001,a,1,voucher,1\n5,a,2,not_defined,1\n,b,1,boleto,1\n"
    landed = ingest.land(read(spark, tmp_path, text), PAYMENTS, str(tmp_path / "good"))
    assert (landed.rows_read, landed.rows_kept) == (3, 2)
    kept = spark.read.parquet(str(tmp_path / "good"))
    assert sorted(r.order_id for r in kept.collect()) == ["a", "b"]
    text = HEADER + "\n0.0000001,a,1,voucher,1\n1.00000009,a,2,voucher,1\n2.5,a,3,voucher,1\n"
    with pytest.raises(ValueError, match="2 amounts in payment_value do not fit 6 decimals"):
        ingest.land(read(spark, tmp_path, text), PAYMENTS, str(tmp_path / "bad"))


def test_bad_number_raises(spark, tmp_path):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read(spark, tmp_path, HEADER + "\nabc,a,1,x,1\n").collect()


def test_line_break_in_quotes(spark, tmp_path):
    text = HEADER + '\n10.50,a,1,"cre\ndit",2\n'
    with pytest.raises(Exception):  # not silently two rows
        read(spark, tmp_path, text).collect()
    assert read(spark, tmp_path, text, multi_line=True).first().payment_type == "cre\ndit"


def test_missing_column_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read(spark, tmp_path, "order_id\na\n")


def test_optional_source(spark, tmp_path):
    def gone():
        return files.read_csv(spark, str(tmp_path / "none.csv"), SOURCES["sellers"])

    assert files.read_optional(gone) is None
    with pytest.raises(AnalysisException):  # a different problem is not hidden
        files.read_optional(lambda: read(spark, tmp_path, "order_id\na\n"))


def test_required_source_must_exist(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.read_sources(spark, str(tmp_path))


def test_status_distribution_leaves_out_null(spark, rows):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",)], "order_status string")
    assert rows(ingest.status_distribution(df)) == [("b", 2), ("a", 1), ("c", 1)]


def test_invalid_payments_are_dropped_but_null_types_kept(spark, rows):
    df = spark.createDataFrame([("voucher",), (None,), ("not_defined",)], "payment_type string")
    assert {kind for (kind,) in rows(ingest.valid_payments(df))} == {None, "voucher"}


def test_source_counts(spark, rows):
    payments = spark.createDataFrame([("x",), ("not_defined",)], "payment_type string")
    counts = ingest.source_counts({"orders": spark.range(3), "payments": payments, "sellers": None})
    assert sorted(rows(counts)) == [("orders", 3, 3), ("payments", 2, 1)]


def test_multi_line_files_of_a_folder_are_read_side_by_side(spark, tmp_path):
    spec, folder = SOURCES["orders"], tmp_path / "orders.csv"
    folder.mkdir()
    names = [*spec.columns, "note"]
    for part in range(6):
        rows = [f'{part}-{i},c,delivered,2017-10-02 10:56:33,"a\n""b"", {i}\n"' for i in range(50)]
        (folder / f"part-{part}.csv").write_text("\n".join([",".join(names), *rows]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "4k")
    try:
        df = files.read_source(spark, str(tmp_path), spec, multi_line=True)
        assert df.rdd.getNumPartitions() == 6
    finally:
        for key in ("maxPartitionBytes", "openCostInBytes"):
            spark.conf.unset(f"spark.sql.files.{key}")
    got = {r.order_id: r.note for r in df.collect()}
    assert got == {f"{p}-{i}": f'a\n"b", {i}\n' for p in range(6) for i in range(50)}
