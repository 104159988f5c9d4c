import json
from pathlib import Path

import pytest

from clickloom.plans import medallion, profile, purchase_model
from clickloom.schema import FEATURES, GOLD_TABLES
from clickloom.sources.lake import read_summary


def written(csv_file, shop_files):
    return [csv_file(name, lines) for name, lines in shop_files.items()]


def test_medallion_writes_silver_gold_and_audit(spark, csv_file, shop_files, tmp_path):
    lake = tmp_path / "lake"
    paths = written(csv_file, shop_files)
    before = {Path(path).name: Path(path).read_bytes() for path in paths}
    result = medallion.run_medallion(
        spark, paths, f"{lake}/silver", f"{lake}/gold", f"{lake}/summary"
    )
    assert result["silver_rows"] == result["silver"]["rows"] == 10
    assert result["gold"]["row_counts"] == {
        "funnel_by_month": 1,
        "funnel_by_utc_weekday_hour": 3,
        "purchases_by_category": 4,
        "purchases_by_category_day": 4,
        "purchases_by_utc_time": 4,
    }
    saved = read_summary(spark, f"{lake}/summary")
    assert (saved["rejected_rows"], saved["duplicate_excess_rows_removed"]) == (3, 2)
    assert saved["quality_counts"]["unexpected_event_type_rows"] == 1
    assert saved["bronze"]["input_files"] == 2 and not saved["bronze"]["raw_modified"]
    files = spark.read.parquet(saved["bronze"]["input_files_table"]).collect()
    assert {r["source_file"]: r["file_bytes"] for r in files} == {
        name: len(data) for name, data in before.items()
    }
    assert saved["bronze"]["input_bytes"] == sum(map(len, before.values()))
    assert {Path(path).name: Path(path).read_bytes() for path in paths} == before
    assert spark.read.parquet(f"{lake}/silver").count() == 10
    for name in GOLD_TABLES:
        assert spark.read.parquet(f"{lake}/gold/{name}").count() > 0


def test_medallion_runs_again_over_its_own_output(spark, csv_file, shop_files, tmp_path):
    lake = tmp_path / "lake"
    targets = f"{lake}/silver", f"{lake}/gold", f"{lake}/summary"
    april, may = written(csv_file, shop_files)
    assert medallion.run_medallion(spark, [april, may], *targets)["silver_rows"] == 10
    assert medallion.run_medallion(spark, [may], *targets)["silver_rows"] == 5
    assert spark.read.parquet(targets[0]).count() == 5


def test_medallion_of_only_rejects_is_empty(spark, csv_file, shop_files, tmp_path):
    lake = tmp_path / "lake"
    path = csv_file("rejects.csv", [shop_files["april.csv"][-1], *shop_files["may.csv"][-2:]])
    result = medallion.run_medallion(
        spark, [path], f"{lake}/silver", f"{lake}/gold", f"{lake}/s"
    )
    assert (result["silver_rows"], result["rejected_rows"]) == (0, 3)
    assert set(result["gold"]["row_counts"].values()) == {0}


def test_outputs_below_raw_are_refused_before_anything_is_read(spark, tmp_path):
    for target in range(3):
        outputs = [str(tmp_path / name) for name in ("silver", "gold", "summary")]
        outputs[target] = str(tmp_path / "raw" / "x")
        with pytest.raises(ValueError, match="raw"):
            medallion.run_medallion(spark, ["/absent.csv"], *outputs)


def test_profile_document_and_tables(spark, csv_file, shop_files, tmp_path):
    paths = written(csv_file, {"april a+b.csv": shop_files["april.csv"], "may.csv": shop_files["may.csv"]})
    output = str(tmp_path / "profile")
    document = profile.profile(spark, paths, output)
    combined = document["combined"]
    assert combined["record_count"] == 15
    assert combined["file_bytes"] == sum(Path(p).stat().st_size for p in paths)
    assert combined["period_utc"] == {"min": "2021-04-29T20:15:00Z", "max": "2021-05-02T12:10:00Z"}
    assert combined["event_counts"] == {"view": 6, "cart": 2, "purchase": 5, "remove_from_cart": 1}
    assert (combined["unexpected_event_count"], combined["unexpected_event_types"]) == (1, 1)
    assert combined["null_counts"]["category_code"] == 2
    assert combined["null_counts"]["category_id"] == 2
    assert combined["invalid_timestamp_count"] == 1
    assert combined["invalid_numeric_counts"]["product_id"] == 1
    assert (combined["duplicate_groups"], combined["duplicate_excess_rows"]) == (2, 2)
    assert combined["price"]["nonpositive_count"] == 4
    assert combined["price"]["max"] == 250.0
    assert [combined["funnel"][f"{stage}_sessions"] for stage in
            ("view", "cart_after_view", "purchase_after_cart")] == [4, 2, 2]
    assert combined["frequency"]["observed_utc_hours"] == 6
    assert combined["purchases"]["purchase_event_count"] == 5
    assert combined["purchases"]["top_categories"][0]["category_code"] == "home.light.lamp"
    assert read_summary(spark, f"{output}/overview") == json.loads(json.dumps(document, default=str))
    for path in document["tables"].values():
        assert spark.read.parquet(path).count() > 0
    files = {r["source_file"]: r for r in spark.read.parquet(f"{output}/file_inventory").collect()}
    assert files["april a+b.csv"]["record_count"] == 8
    assert files["may.csv"]["file_bytes"] == Path(paths[1]).stat().st_size
    assert spark.read.parquet(f"{output}/events_per_hour").count() == 6


def many_sessions():
    """Sessions in two months; those with a cart buy after six minutes."""
    rows = []
    for month in ("10", "11"):
        for i in range(60):
            start = f"2019-{month}-{2 + i % 25:02d} {i % 24:02d}:10"
            session = f"{month}-{i}"

            def event(offset, kind, start=start, session=session):
                minute = int(start[-2:]) + offset
                return (
                    f"{start[:-2]}{minute:02d}:00 UTC,{kind},1,10,cat.a,brand,5.00,7,{session}"
                )

            rows.append(event(0, "view"))
            if i % 3 == 0:
                rows += [event(1, "cart"), event(6, "purchase")]
    edges = [
        f"2019-{day} 00:00:00 UTC,view,1,10,cat.a,brand,5.00,7,edge-{day}" for day in ("10-01", "12-01")
    ]
    return rows + edges


def test_train_reads_silver_and_profile_and_saves_the_whole_pipeline(spark, csv_file, tmp_path):
    lake = tmp_path / "lake"
    path = csv_file("events.csv", many_sessions())
    medallion.run_medallion(spark, [path], f"{lake}/silver", f"{lake}/gold", f"{lake}/summary")
    profile.profile(spark, [path], f"{lake}/profile")
    result = purchase_model.train_purchase_model(
        spark,
        f"{lake}/silver",
        f"{lake}/profile/overview",
        f"{lake}/model",
        f"{lake}/metrics",
        sample_percent=100,
    )
    assert result["sampling"]["sampled_event_rows"] == 60 * 2 + 40 * 2 + 2
    assert sum(result["metrics"]["confusion_matrix"].values()) == 60
    assert result["temporal_split"]["train_class_counts"] == {"0": 40, "1": 20}
    assert result["metrics"]["roc_auc"] == 1.0
    assert [r["feature"] for r in result["feature_coefficients"]] == list(FEATURES)
    assert read_summary(spark, f"{lake}/metrics") == json.loads(json.dumps(result, default=str))
    model = purchase_model.PipelineModel.load(f"{lake}/model")
    row = spark.createDataFrame([(1.0, *[0.5] * len(FEATURES))], ["label", *FEATURES])
    assert 0 < purchase_model.score(model, row).first()["probability"] < 1


def test_a_sample_fits_and_all_sessions_are_judged(spark, csv_file, tmp_path):
    lake = tmp_path / "lake"
    path = csv_file("events.csv", many_sessions())
    medallion.run_medallion(spark, [path], f"{lake}/silver", f"{lake}/gold", f"{lake}/summary")
    profile.profile(spark, [path], f"{lake}/profile")
    result = purchase_model.train_purchase_model(
        spark, f"{lake}/silver", f"{lake}/profile/overview", f"{lake}/model", f"{lake}/metrics", 60
    )
    trained = sum(result["temporal_split"]["train_class_counts"].values())
    assert 0 < trained < 60
    assert result["temporal_split"]["test_class_counts"] == {"0": 40, "1": 20}
    assert sum(result["metrics"]["confusion_matrix"].values()) == 60
    assert sum(row["session_count"] for row in result["score_deciles"]) == 60
