from trips import raw_frame, whole_month

from curbline.__main__ import main


def test_build_publish_and_check(spark, tmp_path, capsys):
    raw_frame(spark, whole_month(2024, 1)).write.parquet(str(tmp_path / "raw" / "yellow_tripdata_2024-01.parquet"))
    (tmp_path / "zones.csv").write_text("Location ID,Zone,Borough\n1,One,North\n")
    places = [str(tmp_path / name) for name in ("raw", "wh", "zones.csv")]
    assert main([*places, "--check"]) == 1
    assert main([*places, "--publish", str(tmp_path / "out")]) == 0
    assert "months loaded: 2024-01" in capsys.readouterr().out
    assert main([*places, "--check"]) == 0
    assert main([*places, "--publish", str(tmp_path / "out"), "--study", str(tmp_path / "study")]) == 0
    assert spark.read.parquet(str(tmp_path / "study" / "clean")).count() == 31
    nulls = spark.read.parquet(str(tmp_path / "study" / "nulls"))
    assert nulls.where("column = 'tip_amount'").first()["nulls"] == 31
    assert "months loaded: none" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "out" / "dws_daily_taxi")).count() == 31
