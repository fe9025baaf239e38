"""Rows of a delimited file that do not have its number of fields."""

import pytest
from shops import BAD, CLEAN_IDS, LINES, reasons_of, shop_spec, write_shops

from sluice import run
from sluice.operators.checks import bad_records, clean_records, malformed_records, with_row_id
from sluice.operators.duplicates import flag_repeated, flag_unrepeated, repeated_keys
from sluice.plans.registry import create_registry, lookup, register
from sluice.sources.files import MALFORMED, read_file

ODD = [
    "50|Short|north",  # three fields: no bad key, no bad date
    "51|Long|north|2024-03-08|extra",
    '52|"In | quotes"|north|2024-03-08',
    "53|Twin|north|2024-03-08",
    "53|Twin|north|2024-03-08|",  # a copy of it but for one more field
    "40|Harbour Tea|north|2024-03-01|1|2",  # has the key of a clean row
    "54",
    "|x",
]
ODD_BAD = [
    ("50", "Short", ("_is_row_malformed",)),
    ("51", "Long", ("_is_row_malformed",)),
    ("53", "Twin", ("_is_row_malformed",)),
    ("40", "Harbour Tea", ("_is_row_malformed",)),
    ("54", None, ("_is_row_malformed", "_is_zone_null")),
    (None, "x", ("_is_row_malformed", "_is_stall_null", "_is_zone_null")),
]


@pytest.fixture
def spec(tmp_path):
    path = tmp_path / "stalls.csv"
    path.write_text("\n".join([*LINES, *ODD]))
    return shop_spec(path, reject_malformed=True)


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_bad_and_clean(spark, spec, hot_rows):
    rows = with_row_id(read_file(spark, spec.file_path, spec.header, spec.delimiter, True), spec)
    bad = bad_records(rows, spec, hot_rows)
    assert reasons_of(bad) == sorted(BAD + ODD_BAD, key=str)
    assert {r[MALFORMED] for r in bad.collect()} - {None} == {o for o in ODD if o[:2] not in ("52",) and o != ODD[3]}
    clean = clean_records(rows, spec, hot_rows)
    assert clean.columns == spec.column_names
    assert sorted((r.stall, r.label) for r in clean.collect() if r.stall > 48) == [(52, "In | quotes"), (53, "Twin")]
    assert sorted(r.stall for r in clean.collect() if r.stall <= 48) == CLEAN_IDS
    assert len(malformed_records(rows, spec).collect()) == len(ODD_BAD)
    marked = rows.select("label", MALFORMED).collect()
    assert sum(r[MALFORMED] is not None for r in marked) == len(ODD_BAD)


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_few_repeated_keys(spark, spec, limit):
    rows = with_row_id(read_file(spark, spec.file_path, spec.header, spec.delimiter, True), spec)
    repeated = repeated_keys(rows, spec, limit)
    assert repeated.few == bool(limit)
    once, again = flag_unrepeated(rows, repeated, spec), flag_repeated(rows, spec, repeated, limit=limit)
    flagged = once.unionByName(again)
    ids = [r["_sk"] for r in flagged.collect()]
    assert sorted(ids) == sorted(r["_sk"] for r in rows.collect()) and len(set(ids)) == len(ids)


@pytest.mark.parametrize("run_id", [None, "r"])
def test_tables(spark, database, spec, run_id):
    spec = shop_spec(spec.file_path, f"{database}.stalls", reject_malformed=True)
    run(spark, [spec], run_id)
    assert spark.table(spec.raw_table).count() == len(LINES) + len(ODD) - 1
    assert reasons_of(spark.table(spec.bad_table)) == sorted(BAD + ODD_BAD, key=str)
    assert spark.table(spec.clean_table).count() == len(CLEAN_IDS) + 2
    if run_id:
        counts = {r.counted: r.rows for r in spark.table(spec.counts_table).collect()}
        assert counts["_is_row_malformed"] == len(ODD_BAD)


def test_a_file_without_a_header(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("1|a\n2\n3|c|d\n\n4|")
    got = read_file(spark, str(path), None, "|", True)
    assert got.columns == ["_c0", "_c1", MALFORMED]
    assert [tuple(r) for r in got.collect()] == [("1", "a", None), ("2", None, "2"), ("3", "c", "3|c|d"), ("4", None, None)]


def test_well_formed_rows_are_as_before(spark, tmp_path):
    spec = shop_spec(write_shops(tmp_path), reject_malformed=True)
    marked = read_file(spark, spec.file_path, spec.header, spec.delimiter, True)
    plain = read_file(spark, spec.file_path, spec.header, spec.delimiter)
    assert marked.drop(MALFORMED).collect() == plain.collect()
    assert marked.dtypes[:-1] == plain.dtypes


def test_only_delimited_files(spark, tmp_path):
    with pytest.raises(ValueError):
        shop_spec("x.parquet", reject_malformed=True)
    with pytest.raises(ValueError):
        read_file(spark, "x.parquet", mark_malformed=True)


def test_registry_keeps_it(spark, database):
    table = f"{database}.specs"
    create_registry(spark, table)
    spec = shop_spec("/x.csv", reject_malformed=True)
    register(spark, table, spec)
    assert lookup(spark, table, spec.name) == spec
    # A registry from before the column was there.
    spark.table(table).drop("reject_malformed").write.saveAsTable(f"{table}_old")
    assert lookup(spark, f"{table}_old", spec.name) == shop_spec("/x.csv")
    register(spark, f"{table}_old", spec)
    assert lookup(spark, f"{table}_old", spec.name) == spec
