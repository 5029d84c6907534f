from pyspark.sql import functions as F

from ledgerlake.__main__ import main
from ledgerlake.sinks.writers import export_csv
from ledgerlake.sources import fixture
from tests.conftest import SF_SMALL


def test_cli_runs_pipeline_on_csv_folders(spark, tmp_dir, capsys):
    raw = fixture.raw_text(spark, SF_SMALL).cache()
    years = sorted(r[0] for r in raw.select("Source_Year").distinct().collect())
    for y in years:
        export_csv(raw.filter(F.col("Source_Year") == y), f"{tmp_dir}/raw/sales_{y}")
    export_csv(fixture.returns_source(spark, SF_SMALL), f"{tmp_dir}/raw/returns")
    export_csv(fixture.salespeople(spark), f"{tmp_dir}/raw/salesperson")
    rc = main(["run", "--orders", *[f"{tmp_dir}/raw/sales_{y}" for y in years],
               "--returns", f"{tmp_dir}/raw/returns", "--salesperson", f"{tmp_dir}/raw/salesperson",
               "--store", f"{tmp_dir}/store", "--batch-time", "2024-01-01 06:00:00",
               "--years", *[str(y) for y in years], "--regions", "Africa", "America", "Asia", "Europe", "Middle East"])
    out = capsys.readouterr().out
    assert rc == 0
    assert "gold executive_kpis" in out and out.count("[") >= 37
    assert "[PASS] Category 1: Data Accuracy & Consistency | Row Retention" in out
    raw.unpersist()
