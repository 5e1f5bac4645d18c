import pytest
from conftest import as_list, as_set

from catalogue.planted import raw_tables, worse_tables
from tallyloom.plans import pipeline, publish, reports
from tallyloom.plans.store import store_tables
from tallyloom.schemas import ORDER_DETAIL, ORDER_HEADER, PRODUCT
from tallyloom.sources.csv import read_csv, read_raw_tables, write_csv
from tallyloom.sources.layers import entries, write_layer, write_table
from tallyloom.sources.scratch import fresh_folder, settle, shared_folder

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def csv_file(tmp_path):
    def write(text):
        path = tmp_path / "table.csv"
        path.write_text(text)
        return str(path)

    return write


def test_everything_is_read_as_text(spark, csv_file):
    df = read_csv(spark, csv_file('a,b,c\n1,,"x, ""y"""\n 2 ,"",2021-06-07\n'))
    assert [t for _, t in df.dtypes] == ["string"] * 3
    assert as_list(df) == [(" 2 ", None, "2021-06-07"), ("1", None, 'x, "y"')]


def test_line_break_in_quotes_splits_a_record_unless_asked(spark, csv_file):
    path = csv_file('a,b\n1,"x\ny"\n')
    assert read_csv(spark, path).count() == 2
    assert as_list(read_csv(spark, path, multi_line=True)) == [("1", "x\ny")]


def test_given_schema_must_match_the_header(spark, csv_file):
    good = csv_file(",".join(ORDER_DETAIL.columns) + "\n1,2,3,4,5,6\n")
    assert read_csv(spark, good, schema=ORDER_DETAIL.raw_schema).collect() == [("1", "2", "3", "4", "5", "6")]
    swapped = csv_file(",".join(reversed(ORDER_DETAIL.columns)) + "\n1,2,3,4,5,6\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, swapped, schema=ORDER_DETAIL.raw_schema).collect()


def test_ragged_records_are_told(spark, csv_file):
    path = csv_file('a,b,c\n1,2,3\n1,2\n1,2,3,4\n"x,y",,\n,,\n1\n')
    df = read_csv(spark, path, ragged="bad")
    assert as_set(df.where("bad is not null").select("bad")) == {("1,2",), ("1,2,3,4",), ("1",)}
    assert as_set(df.where("bad is null").drop("bad")) == {("1", "2", "3"), ("x,y", None, None), (None, None, None)}
    assert df.select("a").count() == 6 and df.where("bad is not null").count() == 3
    with pytest.raises(ValueError, match="column 'b'"):
        read_csv(spark, path, ragged="b")


def test_csv_round_trip_keeps_spaces_quotes_and_nulls(spark, rows, tmp_path):
    df = rows([(" a ", 'say "hi"'), (None, "x,y"), ("\tb", "back\\slash")], "x string, y string")
    write_csv(df, str(tmp_path / "t"))
    assert as_set(read_csv(spark, str(tmp_path / "t"))) == as_set(df)


def test_from_csv_files_to_reports(spark, tmp_path):
    """The whole way over files gives what one plan over the raw tables gives."""
    direct = raw_tables(spark, SF_DIR)
    for layout, df in zip((PRODUCT, ORDER_HEADER, ORDER_DETAIL), direct):
        write_csv(df, str(tmp_path / layout.file_name))
    store = pipeline.write_store(read_raw_tables(spark, str(tmp_path)), str(tmp_path / "layers"))
    published = pipeline.write_publish(store, str(tmp_path / "layers"))
    expected = publish.publish_tables(store_tables(direct))
    assert published.product.dtypes == expected.product.dtypes
    assert published.orders.dtypes == expected.orders.dtypes
    assert as_set(published.product) == as_set(expected.product)
    assert as_list(published.orders) == as_list(expected.orders)
    for report in (reports.top_color_per_year, reports.lead_time_by_known_category):
        assert as_set(report(*reversed(published))) == as_set(report(*reversed(expected)))


def test_layer_is_not_overwritten(rows, tmp_path):
    df = rows([(1,)], "a int")
    write_layer(df, str(tmp_path / "layer"))
    with pytest.raises(Exception, match="(?i)already exists"):
        write_layer(df, str(tmp_path / "layer"))


@pytest.fixture
def breaks_at_header(monkeypatch):
    """The run ends after the files of the order headers and before their entry."""

    def write(df, folder, name, seen=None):
        if name == "store_header":
            write_layer(df, f"{folder}/{name}-half")
            raise RuntimeError("the driver is gone")
        write_table(df, folder, name, seen)

    monkeypatch.setattr(pipeline, "write_table", write)


@pytest.mark.parametrize("write", [pipeline.write_store, pipeline.write_store_reported])
def test_broken_run_is_not_read_and_can_go_on(spark, tmp_path, breaks_at_header, monkeypatch, write):
    raw, folder = worse_tables(spark, SF_DIR), str(tmp_path / "layers")
    with pytest.raises(RuntimeError):
        write(raw, folder)
    with pytest.raises(FileNotFoundError, match="store_header, store_detail"):
        pipeline.read_store(spark, folder)
    kept = entries(spark, folder)
    assert set(kept) == {"store_product"}

    monkeypatch.setattr(pipeline, "write_table", write_table)
    with pytest.raises(FileExistsError, match="restart"):
        write(raw, folder)
    again, whole = write(raw, folder, restart=True), write(raw, str(tmp_path / "whole"))
    assert entries(spark, folder)["store_product"] == kept["store_product"]
    if write is pipeline.write_store_reported:
        assert as_list(again.report) == as_list(whole.report)
        again, whole = again.tables, whole.tables
    for a, b in zip(again, whole):
        assert a.dtypes == b.dtypes
        assert as_list(a) == as_list(b)
    assert as_list(pipeline.write_store(raw, folder, restart=True).detail) == as_list(whole.detail)


def test_counts_of_tables_that_were_not_counted_are_null(spark, tmp_path):
    raw = raw_tables(spark, SF_DIR)
    pipeline.write_store(raw, str(tmp_path / "layers"))
    report = pipeline.write_store_reported(raw, str(tmp_path / "layers"), restart=True).report
    assert report.count() == 3 and report.where("StoreRows is null").count() == 3


def test_entries_of_an_unfinished_manifest_and_of_two_runs(spark, rows, tmp_path):
    folder, df = str(tmp_path / "layers"), rows([(1,)], "a int")
    assert entries(spark, folder) == {}
    (tmp_path / "layers" / "manifest" / "_temporary").mkdir(parents=True)
    assert entries(spark, folder) == {}
    write_table(df.limit(0), folder, "t")
    assert set(entries(spark, folder)) == {"t"}
    write_table(df, folder, "t")
    with pytest.raises(ValueError, match="two runs"):
        entries(spark, folder)


def test_files_with_other_column_order_are_refused(spark, tmp_path):
    folder = tmp_path / "products.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("ProductID,Color\n1,Red\n")
    (folder / "b.csv").write_text("Color,ProductID\nBlue,2\n")
    for name in ("sales_order_header.csv", "sales_order_detail.csv"):
        (tmp_path / name).write_text("SalesOrderID\n1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_tables(spark, str(tmp_path)).product.collect()


def test_scratch_uses_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named
    assert fresh_folder(spark, "x").startswith(named)
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")


def test_settled_table_has_no_lineage(spark):
    settled = settle(spark.range(10).repartition(3))
    assert as_set(settled) == {(n,) for n in range(10)}
    assert "ExistingRDD" in settled._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get("spark.checkpoint.dir") in spark.sparkContext.getCheckpointDir()
