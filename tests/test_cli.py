"""End-to-end through the command line entry, on Bronze files with the contract schema."""

from __future__ import annotations

import json

import pytest

from meterlake import cli
from meterlake.sources.fixtures import readings

from tests.conftest import SF_SMALL


def test_cli_commands(spark, tmp_warehouse, capsys):
    bronze = f"{tmp_warehouse}/bronze"
    readings(spark, SF_SMALL).write.parquet(bronze)
    common = ["--source-uri", bronze, "--warehouse-uri", f"{tmp_warehouse}/lake", "--run-date", "2024-01-12"]

    assert cli.main(["transform", *common], spark=spark) == 0
    record = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert record["status"] == "SUCCESS" and record["input_row_count"] > 0

    assert cli.main(["backfill", *common, "--start-date", "2024-01-10", "--end-date", "2024-01-12"], spark=spark) == 0
    capsys.readouterr()

    assert cli.main(["qa", *common], spark=spark) == 0
    out = capsys.readouterr().out
    assert "qa_business_rules" in out and "freshness_status" in out
    # ~33 readings a day at this scale: completeness fails, so strict mode exits 1
    assert cli.main(["qa", *common, "--strict"], spark=spark) == 1
    assert "qa_completeness" in capsys.readouterr().err

    assert cli.main(["insights", *common], spark=spark) == 0
    assert "uses most per day" in capsys.readouterr().out

    saved = f"{tmp_warehouse}/answer"
    q = "SELECT consumption_date, count(*) AS n FROM gold_peak_demand_substation_day " \
        "WHERE consumption_date = :run_date GROUP BY consumption_date"
    assert cli.main(["sql", *common, "--query", q, "--save-json", saved], spark=spark) == 0
    row = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert row["consumption_date"] == "2024-01-12" and row["n"] > 0
    assert spark.read.json(saved).count() == 1

    assert cli.main(["source-profile", *common], spark=spark) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    assert json.loads(lines[0])["row_count"] > 0
    assert any("data_collection_log_timestamp" in line for line in lines[2:])

    assert cli.main(["sql", *common, "--query", "SELECT * FROM bronze_readings", "--max-rows", "7", "--save-json", f"{saved}-all"], spark=spark) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    assert len(lines) == 8 and lines[-1] == "# first 7 rows of more"
    assert spark.read.json(f"{saved}-all").count() == spark.table("bronze_readings").count() > 100

    assert cli.main(["log-run", *common, "--status", "FAILED", "--error", "by hand"], spark=spark) == 0
    record = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert record["status"] == "FAILED" and record["silver_row_count"] > 0
    assert spark.table("pipeline_run_log").where("error_message = 'by hand'").count() >= 0


def test_cli_rejects_unknown_options(spark):
    with pytest.raises(SystemExit):
        cli.main(["transform", "--zscore-treshold", "5"], spark=spark)


def test_cli_moments_mode_matches_full_scan(spark, tmp_warehouse, capsys):
    from pyspark.sql import functions as F

    bronze = f"{tmp_warehouse}/bronze"
    readings(spark, SF_SMALL, "dirty").write.parquet(bronze)
    base = ["--source-uri", bronze, "--run-date", "2024-01-12"]
    full = [*base, "--warehouse-uri", f"{tmp_warehouse}/full"]
    mom = [*base, "--warehouse-uri", f"{tmp_warehouse}/mom", "--baseline-mode", "moments"]
    assert cli.main(["transform", *full], spark=spark) == 0
    assert cli.main(["build-moments", *mom], spark=spark) == 0
    assert cli.main(["transform", *mom], spark=spark) == 0
    capsys.readouterr()

    def silver(root):
        df = spark.read.parquet(f"{tmp_warehouse}/{root}/silver/half_hourly_clean")
        return sorted(df.select("dataset_id", "dq_action", F.round("adjusted_total_consumption_active_import", 6)).collect())

    assert silver("full") == silver("mom") and len(silver("full")) > 0
