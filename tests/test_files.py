"""Loading and unloading on small written files."""

import gzip

import pytest
from helpers import rows_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cartloom.operators.groups import Order
from cartloom.sources import loading, readers, writers
from cartloom.sources.loading import LoadError, OnError
from cartloom.sources.readers import CsvFormat

# The load example with two bad cells.
DDL = "id bigint, name string, price double, created_at date"
ERROR_TEST = """id,name,price,created_at
1,Widget A,19.99,2024-01-15
2,Widget B,NOT_A_NUMBER,2024-01-16
3,Widget C,29.99,NOT_A_DATE
4,Widget D,39.99,2024-01-18
5,Widget E,49.99,2024-01-19
"""
CLEAN = "id,name,price,created_at\n6,Widget F,1.5,2024-01-20\n7,N/A, 2.5 ,\n"


@pytest.fixture
def inbox(tmp_path):
    (tmp_path / "error_test.csv").write_text(ERROR_TEST)
    (tmp_path / "clean.csv").write_text(CLEAN)
    return str(tmp_path)


def test_validate_lists_each_bad_cell(spark, inbox):
    cells = loading.bad_cells(loading.checked(spark, inbox, DDL)).orderBy("line").collect()
    assert [(c["line"], c["column"], c["type"], c["value"]) for c in cells] == [
        (3, "price", "double", "NOT_A_NUMBER"),
        (4, "created_at", "date", "NOT_A_DATE"),
    ]
    assert all(c["file"].endswith("error_test.csv") and c["value"] in c["message"] for c in cells)
    assert loading.bad_cells(loading.checked(spark, f"{inbox}/clean.csv", DDL)).isEmpty()


def test_line_numbers_across_blocks(spark, tmp_path):
    lines = [f"{i},name {i},{'x' if i % 1000 == 0 else i},2024-01-01" for i in range(1, 20001)]
    (tmp_path / "long.csv").write_text("id,name,price,created_at\n" + "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        checked = loading.checked(spark, str(tmp_path), DDL)
        assert checked.rdd.getNumPartitions() > 4
        assert checked.filter(F.col("_line") != F.col("id") + 1).isEmpty()
        assert loading.bad_cells(checked).count() == 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_policies(spark, inbox):
    checked = loading.checked(spark, inbox, DDL)
    assert rows_of(loading.load(checked, OnError.CONTINUE), "id") == [(1,), (4,), (5,), (6,), (7,)]
    assert rows_of(loading.load(checked, OnError.SKIP_FILE), "id") == [(6,), (7,)]
    with pytest.raises(LoadError, match="line 3 column price"):
        loading.load(checked, OnError.ABORT)
    clean = loading.checked(spark, f"{inbox}/clean.csv", DDL)
    assert loading.load(clean, OnError.ABORT).count() == 2
    seventh = clean.filter("id = 7").first()
    assert seventh["name"] is None and seventh["price"] == 2.5 and seventh["created_at"] is None


@pytest.mark.parametrize(
    "policy, status, loaded",
    [(OnError.ABORT, "LOAD_FAILED", 0), (OnError.CONTINUE, "PARTIALLY_LOADED", 3), (OnError.SKIP_FILE, "LOAD_SKIPPED", 0)],
)
def test_history(spark, inbox, policy, status, loaded):
    h = loading.history(loading.checked(spark, inbox, DDL), policy).orderBy("file").collect()
    clean = ("LOAD_FAILED", 2, 0, 0) if policy is OnError.ABORT else ("LOADED", 2, 2, 0)
    assert (h[0]["status"], h[0]["rows_parsed"], h[0]["rows_loaded"], h[0]["error_count"]) == clean
    bad = h[1]
    assert (bad["status"], bad["rows_parsed"], bad["rows_loaded"], bad["error_count"]) == (status, 5, loaded, 2)
    assert bad["first_error_line"] == 3 and bad["first_error_column"] == "price"


def test_wrong_number_of_columns_and_formats(spark, tmp_path):
    (tmp_path / "extra.csv").write_text("id,ok,day\n1,Y,12/31/2024\n2,N,01/15/2024,surplus\n3,maybe,2024-01-01\n")
    fmt = CsvFormat(date_format="MM/dd/yyyy", true_text=["Y"], false_text=["N"])
    checked = loading.checked(spark, str(tmp_path), "id bigint, ok boolean, day date", fmt)
    cells = loading.bad_cells(checked).orderBy("line", "column").collect()
    assert [(c["line"], c["column"]) for c in cells] == [(3, ""), (4, "day"), (4, "ok")]
    assert "3 columns" in cells[0]["message"]
    first = loading.load(checked, OnError.CONTINUE).collect()
    assert [(r["id"], r["ok"], str(r["day"])) for r in first] == [(1, True, "2024-12-31")]


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("created_at,price,note,id,name\n2024-01-15,2.5,x,1,one\n2024-01-16,bad,y,2,two\n")
    checked = loading.checked(spark, str(tmp_path), DDL)
    assert rows_of(loading.load(checked, OnError.CONTINUE), "id", "name", "price") == [(1, "one", 2.5)]
    assert rows_of(loading.bad_cells(checked), "line", "column") == [(3, "price")]
    with pytest.raises(LoadError, match="no columns"):
        loading.checked(spark, str(tmp_path), "id bigint, weight double")


def test_loaded_files_are_skipped_unless_forced(spark, inbox, tmp_path):
    nothing = spark.createDataFrame([], "file string, status string")
    assert len(loading.new_files(spark, inbox, nothing, pattern="*.csv")) == 2
    seen = loading.history(loading.checked(spark, inbox, DDL), OnError.SKIP_FILE).select("file", "status")
    again = loading.new_files(spark, inbox, seen, pattern="*.csv")
    assert [f.split("/")[-1] for f in again] == ["error_test.csv"]  # skipped, hence offered again
    assert len(loading.new_files(spark, inbox, seen, pattern="*.csv", force=True)) == 2


def test_typed_load_is_strict(spark, inbox):
    assert readers.csv_typed(spark, f"{inbox}/clean.csv", DDL).count() == 2
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        readers.csv_typed(spark, f"{inbox}/error_test.csv", DDL).collect()


def test_dialects(spark, tmp_path):
    pipe = tmp_path / "pipe"
    pipe.mkdir()
    (pipe / "a.csv").write_bytes("id|name\r\n1|Größe\r\n2|\"a|b\"\r\n".encode("latin-1"))
    fmt = CsvFormat(sep="|", encoding="ISO-8859-1")
    assert rows_of(readers.csv_typed(spark, str(pipe), "id bigint, name string", fmt)) == [(1, "Größe"), (2, "a|b")]
    packed = tmp_path / "packed"
    packed.mkdir()
    with gzip.open(packed / "b.csv.gz", "wt") as f:
        f.write("name,id\nx,1\n")
    # By header name, not by position.
    assert rows_of(readers.csv_typed(spark, str(packed), "id bigint, name string")) == [(1, "x")]


def test_json_array_and_lines_agree(spark, tmp_path):
    (tmp_path / "array.json").write_text('[{"a": 1, "t": ["x", "y"]},\n {"a": null}, {"a": "text"}]')
    (tmp_path / "lines.ndjson").write_text('{"a": 1, "t": ["x", "y"]}\n{"a": null}\n{"a": "text"}\n')
    get = F.try_variant_get("doc", "$.a", "string").alias("a")
    array = readers.json_arrays(spark, str(tmp_path / "array.json")).select(get)
    lines = readers.json_lines(spark, str(tmp_path / "lines.ndjson")).select(get)
    assert rows_of(array) == rows_of(lines) == sorted([("1",), ("text",), (None,)], key=repr)


def test_positional_and_lineage(spark, inbox):
    p = readers.csv_positional(spark, f"{inbox}/clean.csv", {3: ("price", "double"), 1: ("id", "bigint")})
    assert rows_of(p, "id", "price") == [(6, 1.5), (7, 2.5)]
    raw = readers.csv_text(spark, inbox, pattern="*.csv")
    per_file = raw.groupBy(F.col("_metadata.file_name").alias("f")).count()
    assert rows_of(per_file, "f", "count") == [("clean.csv", 2), ("error_test.csv", 5)]


def test_epoch(spark):
    df = spark.createDataFrame([(1617398772000000,)], "us bigint")
    for scale, value in ((6, F.col("us")), (3, F.expr("us div 1000")), (0, F.expr("us div 1000000"))):
        assert str(df.select(readers.epoch_timestamp(value, scale)).first()[0]) == "2021-04-02 21:26:12"


def test_writers(spark, tmp_path):
    df = spark.range(2500).select("id", F.when(F.col("id") > 5, F.col("id") % 3).alias("g"))
    writers.single_csv(df, f"{tmp_path}/one", [Order("id", True)], 10, sep="|")
    files = list((tmp_path / "one").glob("*.csv"))
    assert len(files) == 1 and files[0].read_text().splitlines()[:2] == ["id|g", "2499|0"]
    writers.single_csv(df, f"{tmp_path}/all", [Order("id")], 10**9)  # a limit has no upper bound
    assert spark.read.option("header", True).csv(f"{tmp_path}/all").count() == 2500
    writers.csv_parts(df.coalesce(1), f"{tmp_path}/parts", rows_per_file=1000)
    assert len(list((tmp_path / "parts").glob("*.csv.gz"))) == 3
    writers.json_lines(df.filter("id < 7"), f"{tmp_path}/lines")
    text = "".join(p.read_text() for p in (tmp_path / "lines").glob("*.json"))
    assert '{"id":0}' in text and '{"id":6,"g":0}' in text
    writers.json_arrays(df, f"{tmp_path}/arrays", [Order("id")], rows_per_array=1000)
    assert readers.json_arrays(spark, f"{tmp_path}/arrays").count() == 2500
    assert len(list((tmp_path / "arrays").glob("*.txt"))) == 3
    writers.partitioned(df, f"{tmp_path}/by", ["g"])
    assert len(list((tmp_path / "by").glob("g=*"))) == 4
    with pytest.raises(PySparkException):
        writers.create_table_as(df, f"{tmp_path}/by")
    assert writers.create_table_as(df, f"{tmp_path}/t").count() == 2500
    assert writers.create_table_as(df, f"{tmp_path}/t", "append").count() == 5000
    assert writers.create_table_as(df, f"{tmp_path}/t", "overwrite").count() == 2500


def test_names_that_need_encoding(spark, tmp_path):
    (tmp_path / "c d+é%41.csv").write_text("id,name\n1,a\n")
    done = loading.history(loading.checked(spark, str(tmp_path), "id bigint, name string"), OnError.CONTINUE)
    assert loading.new_files(spark, str(tmp_path), done) == []
