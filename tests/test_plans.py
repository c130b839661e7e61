from __future__ import annotations

from orderloom.plans import catalog
from orderloom.plans.layers import Layers
from tests.lines import GOOD, line, text_lines


def layers(spark, tmp_path):
    lines = text_lines(spark, *[line(row_id=str(k), order_id=f"O{k}") for k in range(40)], GOOD)
    return Layers(spark, lambda: lines, str(tmp_path / "layers"))


def test_csv_files_are_bounded(spark, tmp_path, monkeypatch):
    """A file with line feeds in its values is read by one task, so none may grow with the input."""
    monkeypatch.setattr(catalog, "RECORDS_PER_FILE", 5)
    rows = catalog._from_csv(layers(spark, tmp_path))
    assert rows.count() == 41 and len(rows.inputFiles()) >= 9


def test_a_micro_batch_keeps_all_cores_busy(spark):
    assert catalog.files_per_batch(spark) >= 2 * spark.sparkContext.defaultParallelism


def test_cleaned_arrivals_do_not_need_the_arrivals(spark, tmp_path):
    built = layers(spark, tmp_path)
    assert built.table("clean_arrivals").count() == 41
    assert "arrivals" not in built._paths
