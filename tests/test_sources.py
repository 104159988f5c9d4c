import pytest

from clickloom.operators.parse import parse_events
from clickloom.operators.quality import quality
from clickloom.schema import BRONZE_COLUMNS, CORRUPT, RAW_COLUMNS
from clickloom.session import shared_folder
from clickloom.sources import events_csv, lake
from clickloom.sources.events_csv import check_inputs, input_files, read_events, staged_events

GOOD = "2022-07-09 18:05:00 UTC,cart,910,64,sport.ball,kicker,14.95,5,visit-7"
UNCLOSED = '2022-07-09 18:06:00 UTC,cart,911,64,"sport.bat,kicker,24.95,5,visit-8'


def test_malformed_line_is_reported(spark, csv_file):
    rows = read_events(spark, [csv_file("a.csv", [GOOD, UNCLOSED])])
    found = quality(parse_events(rows)).first()
    assert found["record_count"] == 2
    assert found["corrupt_records"] == 1


def test_malformed_lines_show_in_narrow_queries(spark, csv_file):
    lines = [GOOD, GOOD + ",extra", "2019-10-01 10:01:00 UTC,view"]
    rows = read_events(spark, [csv_file("a.csv", lines)]).select("user_session", CORRUPT)
    assert [r["user_session"] for r in rows.where(f"{CORRUPT} IS NOT NULL").collect()] == [
        "visit-7",
        None,
    ]


def test_quoted_commas_are_no_defect(spark, csv_file):
    line = GOOD.replace("kicker", '"kick, er"')
    found = read_events(spark, [csv_file("a.csv", [line])]).first()
    assert found["brand"] == "kick, er"
    assert found[CORRUPT] is None


@pytest.mark.parametrize("name", ["a b.csv", "a+b.csv", "a%b.csv", "ñ.csv"])
def test_file_names_come_decoded(spark, csv_file, name):
    path = csv_file(name, [GOOD])
    assert read_events(spark, [path]).first()["source_file"] == name
    sizes = input_files(spark, [path]).first()
    assert sizes["source_file"] == name
    assert sizes["file_bytes"] == len(",".join(RAW_COLUMNS) + "\n" + GOOD + "\n")


def test_byte_order_mark_and_header_only_files_pass(spark, csv_file):
    paths = [csv_file("bom.csv", [GOOD], encoding="utf-8-sig"), csv_file("none.csv", [])]
    check_inputs(spark, paths)
    assert read_events(spark, paths).count() == 1


@pytest.mark.parametrize(
    "header",
    [
        ",".join(RAW_COLUMNS).upper(),
        ",".join(RAW_COLUMNS[:-1]),
        ",".join([*RAW_COLUMNS, "more"]),
        ",".join(reversed(RAW_COLUMNS)),
    ],
)
@pytest.mark.parametrize("name", ["a.csv", "z.csv"])
def test_other_headers_are_refused_in_any_file(spark, csv_file, header, name):
    paths = [csv_file("m.csv", [GOOD]), csv_file(name, [GOOD], header=header)]
    with pytest.raises(Exception, match="header|Header"), staged_events(spark, paths):
        pass


def test_the_callers_session_stays_as_it_is(spark, csv_file, monkeypatch):
    """Other queries of the caller's session see no change of the case rule while files are
    staged, and the session of the scan has the caller's settings otherwise."""
    seen = []

    def watched(session, paths):
        seen.append(session.conf.get("spark.sql.caseSensitive"))
        seen.append(session.conf.get("spark.sql.shuffle.partitions"))
        seen.append(spark.conf.get("spark.sql.caseSensitive"))
        seen.append(spark.range(1).select("ID").count())
        return read_events(session, paths)

    monkeypatch.setattr(events_csv, "read_events", watched)
    with staged_events(spark, [csv_file("m.csv", [GOOD])]) as rows:
        assert rows.select("BRAND").first()[0] == "kicker"
        assert rows.sparkSession is spark
    assert seen == ["true", spark.conf.get("spark.sql.shuffle.partitions"), "false", 1]


def test_staged_events_keep_added_columns(spark, csv_file):
    with staged_events(spark, [csv_file("m.csv", [GOOD])], parse_events) as rows:
        plan = rows.agg({"ts": "max", "amount": "max"})._jdf.queryExecution().executedPlan().toString()
        assert rows.collect() == parse_events(rows.select(*BRONZE_COLUMNS)).collect()
    assert "ReadSchema: struct<ts:timestamp,amount:double>" in plan and "event_time" not in plan


def test_staged_events_are_freed(spark, csv_file):
    with staged_events(spark, [csv_file("m.csv", [GOOD])]) as rows:
        path = rows.inputFiles()[0].rsplit("/", 1)[0]
    assert spark.read.schema(rows.schema).parquet(path).count() == 0


def test_exact_headers_are_staged(spark, csv_file):
    paths = [csv_file("m.csv", [GOOD]), csv_file("bom.csv", [GOOD], encoding="utf-8-sig")]
    with staged_events(spark, paths) as rows:
        assert rows.count() == 2


def test_no_input_empty_and_missing_files_and_equal_names_are_refused(spark, csv_file, tmp_path):
    with pytest.raises(ValueError, match="no input"):
        check_inputs(spark, [])
    (tmp_path / "empty.csv").write_text("")
    good = csv_file("a.csv", [GOOD])
    with pytest.raises(ValueError, match="empty"):
        check_inputs(spark, [good, str(tmp_path / "empty.csv")])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        check_inputs(spark, [str(tmp_path / "absent.csv")])
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "a.csv").write_text((tmp_path / "a.csv").read_text())
    with pytest.raises(ValueError, match="equal names"):
        check_inputs(spark, [good, str(tmp_path / "other" / "a.csv")])


@pytest.mark.parametrize("path", ["data/raw/out", "/x/RAW/y", "raw", "hdfs://h/Raw/z", "a\\raw\\b"])
def test_raw_folders_are_never_written(path):
    with pytest.raises(ValueError, match="raw"):
        lake.guard_raw("fine", path)
    lake.guard_raw("data/rawish/out")


def test_summary_round_trip_and_no_nan(spark, tmp_path):
    path = str(tmp_path / "summary")
    lake.write_summary(spark, {"a": {"ñ": [1, None]}}, path)
    assert lake.read_summary(spark, path) == {"a": {"ñ": [1, None]}}
    with pytest.raises(ValueError):
        lake.write_summary(spark, {"a": float("nan")}, path)
    (tmp_path / "plain.json").write_text('{\n "a": 1\n}\n')
    assert lake.read_summary(spark, str(tmp_path / "plain.json")) == {"a": 1}


def test_staged_table_is_freed(spark):
    with lake.staged(spark.range(5), "test") as table:
        path = table.inputFiles()[0].rsplit("/", 1)[0]
        assert table.count() == 5
    assert spark.read.schema("id bigint").parquet(path).count() == 0


def test_shared_folder_is_the_one_the_session_names(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark, "x").startswith(f"{root}/clickloom-x-")


def month_files(table):
    found = table.select("event_month", "_metadata.file_path").distinct().collect()
    return {m: sorted(r[1] for r in found if r[0] == m) for m in {r[0] for r in found}}


def test_a_month_is_written_again_and_the_others_stay(spark, tmp_path):
    path = str(tmp_path / "silver")
    table = spark.range(90).selectExpr("id", "concat('2019-1', id % 3) AS event_month")
    before = month_files(lake.write_silver(table, path))
    changed = table.where("id >= 30").selectExpr("-id AS id", "event_month")
    after = lake.rewrite_months(changed, path, ["2019-11"])
    assert dict(after.groupBy("event_month").count().collect()) == {"2019-10": 30, "2019-11": 20, "2019-12": 30}
    assert after.where("event_month = '2019-11' AND id > 0").count() == 0
    files = month_files(after)
    assert files["2019-11"] != before.pop("2019-11")
    assert {m: files[m] for m in before} == before
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_months_without_rows_or_none_are_refused(spark, tmp_path):
    path = str(tmp_path / "silver")
    table = spark.range(4).selectExpr("id", "'2019-10' AS event_month")
    lake.write_silver(table, path)
    for months, said in ((["2019-10", "2019-11"], "2019-11"), ([], "no month")):
        with pytest.raises(ValueError, match=said):
            lake.rewrite_months(table, path, months)
    with pytest.raises(ValueError, match="raw"):
        lake.rewrite_months(table, f"{tmp_path}/raw/silver", ["2019-10"])
    assert spark.read.parquet(path).count() == 4


def test_small_tables_are_one_file_and_months_are_folders(spark, tmp_path):
    table = spark.range(100).selectExpr(
        "id", "concat('2019-1', id % 2) AS event_month"
    ).repartition(8)
    small = lake.write_table(table, str(tmp_path / "small"))
    assert len(small.inputFiles()) == 1
    silver = lake.write_silver(table, str(tmp_path / "silver"))
    assert dict(silver.dtypes)["event_month"] == "string"
    assert len(silver.where("event_month = '2019-10'").inputFiles()) == 2
    assert len(silver.inputFiles()) == 2
