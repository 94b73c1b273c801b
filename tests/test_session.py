from curbline.session import freeze, fit_shuffles, scratch_path, shared_dir


def test_shuffles_are_raised_to_fit_and_never_lowered(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        fit_shuffles(spark, 1000)
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        fit_shuffles(spark, 128 << 30)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "1024"
        fit_shuffles(spark, 100 << 40)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "819200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_scratch_lies_in_the_shared_folder(spark):
    first, second = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert first != second
    assert first.startswith(shared_dir(spark))
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_dir(spark) == configured


def test_freeze_keeps_rows(spark):
    assert freeze(spark.range(5)).count() == 5
