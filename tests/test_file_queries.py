"""Queries that go through event files: what makes the rows is done once, by many tasks."""

from pathlib import Path

import pytest

from verification import registry
from verification.clicks import clicks_raw

SF = "/root/testdata/sf0.001"
QUERIES = ("file_sizes", "source_names", "file_inventory", "header_contract", "profile_overview",
           "medallion_audit", "model_document")
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables here")


def test_the_one_writer_of_a_file_makes_no_rows(spark, monkeypatch):
    plans, write = [], registry.csv_files

    def noted(rows):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return write(rows)

    monkeypatch.setattr(registry, "csv_files", noted)
    assert len(registry.queries()["file_sizes"](spark, SF).collect()) == len(plans) == 2
    for plan in plans:
        assert "Join" not in plan and "Generate" not in plan


@pytest.mark.parametrize("name", QUERIES)
def test_rows_are_made_once(spark, monkeypatch, name):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    def rows(spark, sf_dir):
        raw = clicks_raw(spark, sf_dir)
        return raw.mapInArrow(counted, raw.schema)

    monkeypatch.setattr(registry, "clicks_raw", rows)
    registry.queries()[name](spark, SF).collect()
    assert made.value == clicks_raw(spark, SF).count()
