"""Import, preparation and end-to-end jobs on small files."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from rollcall.functions.names import Header
from rollcall.operators.broken_rows import chunk_of, field_count
from rollcall.operators.orders import output_name
from rollcall.operators.reports import counted, quality_report
from rollcall.operators.row_numbers import number_lines, number_rows
from rollcall.operators.zip_split import split_zip_plus4
from rollcall.plans import jobs
from rollcall.sinks.files import register_table, write_csv, write_parquet, write_table
from rollcall.sources.delimited import clean_columns, import_list
from rollcall.sources.exports import read_exports
from rollcall.sources.grid import read_grid
from rollcall.sources.lines import read_lines
from tests.test_matching import CONSUMER_DDL, CONSUMERS, EXPECTED, MAPPING

LIST = """FINDER NUMBER,firstname,lastname,street,city,state,zipcode,plus4
A1,JOHN,STRAITOR,12 Main St,Adams,OH,43001,12
A2, Mary ,Straitor,12  Main St,Adams,OH,43001,0012
A3,Zed,Quill,12 Main St,Adams,OH,43001-9999,0012
A4,John,Straitor,99 Oak Ave,Adams,OH,43001,0012
A5,John,Straitor,12 Main St,Adams,OH,,
A6,JOHN,STRAITOR,12 Main St,Adams,OH,43001,12
A7,John,"Smith-Jones",5 Elm St,"Berne, North",oh,1234,
"""


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as out:
        out.write(text)
    return str(path)


@pytest.fixture()
def list_path(tmp_path):
    return put(tmp_path / "list" / "list.csv", LIST)


def test_import(spark, list_path):
    imported = import_list(spark, list_path)
    rows = {r["finder_number"]: r for r in imported.rows.collect()}
    assert imported.rows.columns[0] == "finder_number"
    assert {t for _, t in imported.rows.dtypes} == {"string"}
    assert len(rows) == 7 and imported.counts.lines == 8
    assert rows["A2"]["firstname"] == "Mary"
    assert rows["A5"]["zipcode"] is None and rows["A5"]["plus4"] is None
    assert rows["A7"]["city"] == "Berne, North" and rows["A7"]["lastname"] == "Smith-Jones"
    assert imported.misfits.count() == 0


def test_import_folder_repeats_headers_and_reports_misfits(spark, tmp_path):
    put(tmp_path / "in" / "a.csv", "a|b c\n1|x\na|b c\n2\n\n")
    put(tmp_path / "in" / "b.csv", 'a|b c\r\n3|y|z\r\n"4|open\r\n')
    imported = import_list(spark, str(tmp_path / "in"), "pipe")
    assert sorted(map(tuple, imported.rows.collect()), key=str) == sorted(
        [("1", "x"), ("2", None), (None, None), ("3", "y"), ("4|open", None)], key=str)
    misfits = {r["value"]: os.path.basename(r["file_path"]) for r in imported.misfits.collect()}
    assert misfits == {"2": "a.csv", "3|y|z": "b.csv", '"4|open': "b.csv"}


def test_import_refuses_empty_input_and_other_headers(spark, tmp_path):
    with pytest.raises(ValueError, match="no lines"):
        import_list(spark, put(tmp_path / "empty.csv", ""))
    with pytest.raises(ValueError, match="no data rows"):
        import_list(spark, put(tmp_path / "head.csv", "a,b\na,b\n"))
    put(tmp_path / "two" / "a.csv", "a,b\n1,2\n")
    put(tmp_path / "two" / "b.csv", "b,a\n1,2\n")
    with pytest.raises(ValueError, match="differ"):
        import_list(spark, str(tmp_path / "two"))
    assert import_list(spark, str(tmp_path / "two"), same_header=False).rows.count() == 3


def test_trim_is_for_spaces_only(spark):
    df = spark.createDataFrame([(" x ", "  ", "\t")], "`a.b` string, `c` string, `d` string")
    assert tuple(clean_columns(df).first()) == ("x", None, "\t")


def test_quality_report_and_counts(spark, list_path):
    rows, seen = counted(import_list(spark, list_path).rows, "rows")
    assert [tuple(r) for r in quality_report(rows).collect()] == [("RowCount > 0", "Passed", 7.0)]
    assert seen.get["rows"] == 7
    rules = {"RowCount > 0": (F.count(F.lit(1)), lambda n: n > 0), "zips": (F.count("zipcode"), lambda n: n > 99)}
    outcome = quality_report(rows.filter("false"), rules).collect()
    assert [r["outcome"] for r in outcome] == ["Failed", "Failed"]


def test_import_job_writes_table(spark, list_path, tmp_path):
    report = jobs.import_job(spark, list_path, str(tmp_path / "out"), "imported_list")
    assert report.counts == {"files": 1, "lines": 8, "imported": 7}
    assert report.renamed["FINDER NUMBER"] == "finder_number"
    assert spark.table("imported_list").count() == 7
    assert report.reports["quality"].first()["outcome"] == "Passed"
    by_state = str(tmp_path / "by_state")
    write_table(report.output, "list_by_state", by_state, ["state"])
    assert glob.glob(by_state + "/state=OH") and spark.table("list_by_state").count() == 7


def test_import_and_match_job(spark, list_path, tmp_path):
    consumers = str(tmp_path / "consumers")
    write_parquet(spark.createDataFrame(CONSUMERS, CONSUMER_DDL), consumers)
    mapping = json.dumps({**MAPPING, "zip": "ZIPCODE"})
    report = jobs.import_and_match_job(
        spark, list_path, consumers, str(tmp_path / "out"), "matched_list", 92, mapping
    )
    matched = {r["finder_number"]: r for r in spark.table("matched_list").collect()}
    assert {k: (r["match_id"], r["match_type"]) for k, r in matched.items()} == {
        k: (v[0], v[4]) for k, v in EXPECTED.items()}
    assert report.counts == {"files": 1, "lines": 8, "matched": 4}
    types = {r["match_type"]: r["match_count"] for r in report.reports["match_types"].collect()}
    assert types == {"INDIVIDUAL_MATCH": 1, "HOUSEHOLD_MATCH": 2, "ADDRESS_MATCH": 1}
    assert report.reports["scores"].count() == 3
    with pytest.raises(ValueError, match="JSON"):
        jobs.column_mapping("{")


def test_match_tables_job(spark, list_path, tmp_path):
    import_list(spark, list_path).rows.write.mode("overwrite").saveAsTable("people_table")
    spark.createDataFrame(CONSUMERS, CONSUMER_DDL).write.mode("overwrite").saveAsTable("consumer_table")
    report = jobs.match_tables_job(
        spark, "people_table", "consumer_table", str(tmp_path / "out"), "matched_tables", 92, MAPPING, "oh"
    )
    assert report.counts == {"matched": 4}


def test_register_table_replaces_a_stale_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    write_parquet(spark.range(3), path)
    register_table(spark, "stale", path)
    write_parquet(spark.range(2).select(F.lit("x").alias("other")), path)
    register_table(spark, "stale", path)
    assert spark.table("stale").columns == ["other"] and spark.table("stale").count() == 2


# ------------------------------------------------ preparation


BROKEN = 'a,b,c\n1,2,3\n1,2\n\n"x,y",2,3\n4,5,6\n7,8,9\n'


def chunk_files(folder):
    found = {}
    for path in glob.glob(folder + "/chunk_id=*/part-*"):
        key = path.split("chunk_id=")[1].split("/")[0]
        assert key not in found, "one file per chunk"
        found[key] = open(path).read().splitlines()
    return found


def test_clean_and_chunk(spark, tmp_path):
    path = put(tmp_path / "in.csv", BROKEN)
    paths = jobs.clean_and_chunk_job(spark, path, str(tmp_path / "out"), "in", 2)
    bad = sorted(line["value"] for line in spark.read.text(paths["bad_rows"]).collect())
    assert bad == ['Line 3: 1,2', "Line 4: ", 'Line 5: "x,y",2,3']
    assert chunk_files(paths["parts"]) == {"0": ["a,b,c", "1,2,3", "4,5,6"], "1": ["a,b,c", "7,8,9"]}
    quoted = jobs.clean_and_chunk_job(spark, path, str(tmp_path / "q"), "in", 100, quote_aware=True)
    assert len(chunk_files(quoted["parts"])["0"]) == 5


def test_only_broken_rows_give_no_chunks(spark, tmp_path):
    path = put(tmp_path / "in.csv", "a,b\n1\n2\n")
    paths = jobs.clean_and_chunk_job(spark, path, str(tmp_path / "out"), "in")
    assert spark.read.text(paths["bad_rows"]).count() == 2
    assert chunk_files(paths["parts"]) == {}


def test_line_numbers_over_many_splits(spark, tmp_path):
    size = 3_000
    text = "".join(f"line {i} {'x' * (i % 50)}\n" for i in range(1, size + 1))
    put(tmp_path / "n" / "a.txt", text)
    put(tmp_path / "n" / "b.txt", text[: len(text) // 2])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        lines = read_lines(spark, str(tmp_path / "n"))
        assert lines.select("block_start").distinct().count() > 5
        wrong = number_lines(lines).filter(
            F.split("value", " ")[1].cast("long") != F.col("line_number"))
        # The second file may end in the middle of a line.
        assert wrong.count() <= 1
        odd = lines.filter(F.split("value", " ")[1].cast("long") % 2 == 1)
        numbered = number_lines(odd, "n").filter("file_path LIKE '%a.txt'")
        assert numbered.filter(F.split("value", " ")[1].cast("long") != 2 * F.col("n") - 1).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_row_numbers_and_chunks(spark):
    df = spark.range(10_000).select((F.col("id") * 7919 % 10_007).alias("k")).repartition(7)
    rows = sorted(number_rows(df, "k", name="n").collect())
    assert [r["n"] for r in rows] == list(range(1, 10_001))
    sizes = number_rows(df, "k", name="n").groupBy(chunk_of(F.col("n"), 3_000)).count().collect()
    assert sorted(r["count"] for r in sizes) == [1_000, 3_000, 3_000, 3_000]
    with pytest.raises(ValueError):
        chunk_of(F.lit(1), 0)


def test_field_count(spark):
    row = spark.range(1).select(
        field_count(F.lit("")), field_count(F.lit("a")), field_count(F.lit(",")),
        field_count(F.lit('"x,y",2')), field_count(F.lit('"x,y",2'), quote_aware=True),
        field_count(F.lit("a||b"), "||"),
    ).first()
    assert tuple(row) == (0, 1, 2, 3, 2, 2)


def test_split_zip(spark, tmp_path):
    df = spark.createDataFrame(
        [("1", "43001-1234", "x"), ("2", "43001", "x"), ("3", "", "x"), ("4", "1-2-3", "x"), ("5", None, "x")],
        "id string, ZIP string, last string")
    split = split_zip_plus4(df)
    assert split.columns == ["id", "zip", "plus4", "last"]
    assert [tuple(r)[1:3] for r in split.collect()] == [
        ("43001", "1234"), ("43001", ""), ("", ""), ("1", "2"), ("", "")]
    with pytest.raises(ValueError):
        split_zip_plus4(df.withColumnRenamed("ZIP", "Zip"))
    path = put(tmp_path / "z.csv", "id,ZIP,n\r\n1,02134-1234,a\r\n2,,\r\n")
    jobs.split_zip_job(spark, path, str(tmp_path / "split"))
    parts = [open(p).read() for p in glob.glob(str(tmp_path / "split" / "part-*"))]
    assert parts == ["id,zip,plus4,n\n1,02134,1234,a\n2,,,\n"]


def test_stamp_orders(spark, tmp_path):
    folder = tmp_path / "exports"
    put(folder / "QB127_OmitFile_Export_1125.csv", "id,zip\n1,00501\n2,\n")
    put(folder / "QB9_OmitFile_Export_1125.csv", "id,zip\n3,x\n")
    put(folder / "Z1_OmitFile_Export_1.csv", "id,OrderCode\n4,old\n")
    put(folder / "other.csv", "id\n9\n")
    out = str(tmp_path / "out")
    written = jobs.stamp_orders_job(spark, str(folder), out, order_date="2025-11-25")
    assert len(written) == 2
    files = {}
    for path in glob.glob(out + "/layout=*/file=*/part-*"):
        files[path.split("file=")[1].split("/")[0]] = open(path).read()
    assert files == {
        "QB127_OmitFile_Export_1125_with_orders.csv": "id,zip,OrderCode,OrderDate\n1,00501,QB127,2025-11-25\n2,,QB127,2025-11-25\n",
        "QB9_OmitFile_Export_1125_with_orders.csv": "id,zip,OrderCode,OrderDate\n3,x,QB9,2025-11-25\n",
        "Z1_OmitFile_Export_1_with_orders.csv": "id,OrderCode,OrderDate\n4,Z1,2025-11-25\n",
    }
    with pytest.raises(FileNotFoundError):
        list(read_exports(spark, str(folder), "*.none"))
    assert spark.range(1).select(output_name(F.lit("a.b.csv")), output_name(F.lit("plain"))).first() == (
        "a.b_with_orders.csv", "plain_with_orders")


def test_geo_job_reads_sheets(spark, tmp_path):
    put(tmp_path / "sheets" / "Tier 1.csv", 'h,43999\n43001,430\n"Tier 1 OH - x, y",43002\n,431\n')
    put(tmp_path / "sheets" / "Tier + 2.csv", 'h\n"all zips in ""Rhode Island"""\n')
    cells = {(r["sheet"], r["row"], r["col"]): r["value"] for r in read_grid(spark, str(tmp_path / "sheets")).collect()}
    assert cells[("Tier 1", 2, 0)] == "Tier 1 OH - x, y" and cells[("Tier 1", 3, 1)] == "431"
    assert cells[("Tier + 2", 1, 0)] == 'all zips in "Rhode Island"'
    flat, summary = jobs.geo_tiers_job(spark, str(tmp_path / "sheets"), str(tmp_path / "out"), "SW1")
    assert flat.endswith("SW1_flattened.csv")
    rows = {tuple(r) for r in spark.read.option("header", True).csv(flat).collect()}
    assert rows == {("43001", "zip", "tier_1"), ("43002", "zip", "tier_1_tier_1_oh_x_y"),
                    ("431", "scf", "tier_1_tier_1_oh_x_y"), ("RI", "state", "tier_2")}
    assert spark.read.option("header", True).csv(summary).count() == 3


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.createDataFrame([("00501", 'a "b", c'), ("x", None)], "zip string, t string")
    write_csv(df, path, rows_per_file=1)
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_a_long_delimiter_within_quotes_is_no_delimiter(spark, tmp_path):
    assert Header.parse('a||"b||c"||d', "||").original == ("a", "b||c", "d")
    assert Header.parse("a||b|c||", "||").original == ("a", "b|c", "")
    (tmp_path / "x.csv").write_text('a||"b||c"||d\n1||"2||3"||4\n')
    rows = import_list(spark, str(tmp_path), "||").rows
    assert rows.columns == ["a", "b_c", "d"]
    assert [tuple(r) for r in rows.collect()] == [("1", "2||3", "4")]
