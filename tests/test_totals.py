"""Totals kept up by differences against full roll-ups, through every kind of change."""

import datetime as dt
import glob
import os

import pytest

from curbline.operators import metrics as M
from curbline.operators.clean import clean_detail
from curbline.plans import totals
from curbline.plans.incremental import overwrite_by_date
from curbline.sinks.parquet import drop_partitions, replace_partitions
from trips import raw_frame, rows_of, trip


def partials(spark, rows):
    return M.partial_metrics(clean_detail(raw_frame(spark, rows)), M.PARTIAL_KEYS)


def day(number, pu=1, hour=10, **changes):
    return trip(f"2024-01-{number:02} {hour}:00:00", pu=pu, **changes)


def check(spark, folder, keys=("PULocationID",), measures=M.LOCATION_MEASURES, name="totals"):
    found = totals.maintain_totals(spark, f"{folder}/partials", f"{folder}/{name}", list(keys), measures)
    whole = M.roll_up(spark.read.parquet(f"{folder}/partials"), list(keys), measures)
    assert sorted(found.columns) == sorted(whole.columns)
    assert rows_of(found.select(*whole.columns)) == rows_of(whole)
    return found


ROWS = [day(1), day(1, pu=2, total=7.25), day(2, pu=2, hour=11), day(3, pu=3, distance=1.5), day(3)]


@pytest.mark.parametrize(
    "keys, measures",
    [
        (["PULocationID"], M.LOCATION_MEASURES),
        (["pickup_hour"], M.HOURLY_MEASURES),
        (["pickup_hour", "PULocationID"], M.DAILY_MEASURES),
    ],
)
def test_add_change_and_drop(spark, folder, keys, measures):
    path = f"{folder}/partials"
    overwrite_by_date(partials(spark, ROWS), path)
    check(spark, folder, keys, measures)
    replace_partitions(partials(spark, [day(4, pu=5), day(4, seconds=60)]), path)
    check(spark, folder, keys, measures)
    # zone 3 is gone, and the longest trip with it
    replace_partitions(partials(spark, [day(3, seconds=90, total=3.1)]), path)
    found = check(spark, folder, keys, measures)
    if keys == ["PULocationID"]:
        assert 3 not in [row["PULocationID"] for row in found.collect()]
    drop_partitions(spark, path, [dt.date(2024, 1, 1), dt.date(2024, 1, 4)])
    check(spark, folder, keys, measures)
    replace_partitions(partials(spark, [day(1, total=99.99)]), path)
    check(spark, folder, keys, measures)
    assert len(os.listdir(f"{folder}/totals/totals")) == 2


def test_digits_beyond_cents_and_nan_come_and_go(spark, folder):
    path = f"{folder}/partials"
    overwrite_by_date(partials(spark, ROWS), path)
    check(spark, folder)
    fine = partials(spark, [day(2, total=1.125, distance=0.001)])
    replace_partitions(fine, path)
    check(spark, folder)
    replace_partitions(partials(spark, [day(2, pu=2)]).selectExpr(
        *[f"double('NaN') AS {name}" if name == "total_amount__rest" else name for name in fine.columns]
    ), path)
    found = totals.maintain_totals(spark, path, f"{folder}/totals", ["PULocationID"], M.LOCATION_MEASURES)
    assert {str(r["total_amount__rest"]) for r in found.where("PULocationID = 2").collect()} == {"nan"}
    replace_partitions(partials(spark, [day(2, pu=2)]), path)
    check(spark, folder)


def test_null_keys_and_values(spark, folder):
    path = f"{folder}/partials"
    odd = partials(spark, ROWS).selectExpr(
        "trip_date", "pickup_hour", "nullif(PULocationID, 2) AS PULocationID", "trip_count",
        "nullif(total_amount__cents, 1000) AS total_amount__cents",
        "if(total_amount__cents = 1000, NULL, total_amount__rest) AS total_amount__rest",
        "if(total_amount__cents = 1000, 0L, total_amount__n) AS total_amount__n",
        "trip_distance__cents", "trip_distance__rest", "trip_distance__n",
    )
    overwrite_by_date(odd, path)
    found = check(spark, folder)
    assert None in [row["PULocationID"] for row in found.collect()]
    drop_partitions(spark, path, [dt.date(2024, 1, 2)])
    check(spark, folder)


def test_untouched_partials_are_not_read(spark, folder):
    path = f"{folder}/partials"
    overwrite_by_date(partials(spark, ROWS), path)
    check(spark, folder)
    expected = M.roll_up(partials(spark, [*ROWS, day(9, pu=8)]), ["PULocationID"], M.LOCATION_MEASURES)
    for file in glob.glob(f"{path}/trip_date=*/*.parquet"):
        size = os.path.getsize(file)
        with open(file, "wb") as out:
            out.write(b"x" * size)
    for file in glob.glob(f"{path}/trip_date=*/.*.crc"):
        os.remove(file)
    replace_partitions(partials(spark, [day(9, pu=8)]), path)
    found = totals.maintain_totals(spark, path, f"{folder}/totals", ["PULocationID"], M.LOCATION_MEASURES)
    assert rows_of(found.select(*expected.columns)) == rows_of(expected)


@pytest.mark.parametrize("broken", ["_sum_up", "_clean_up"])
def test_a_batch_that_broke_off_is_done_again(spark, folder, monkeypatch, broken):
    path = f"{folder}/partials"
    overwrite_by_date(partials(spark, ROWS), path)
    check(spark, folder)
    replace_partitions(partials(spark, [day(2, total=5.5)]), path)

    def fail(*arguments):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(totals, broken, fail)
        with pytest.raises(RuntimeError):
            totals.maintain_totals(spark, path, f"{folder}/totals", ["PULocationID"], M.LOCATION_MEASURES)
    replace_partitions(partials(spark, [day(5)]), path)
    drop_partitions(spark, path, [dt.date(2024, 1, 1)])
    check(spark, folder)


def test_all_dates_gone_nothing_new_and_other_measures(spark, folder):
    path = f"{folder}/partials"
    with pytest.raises(ValueError, match="no partials"):
        totals.maintain_totals(spark, path, f"{folder}/totals", ["PULocationID"], M.LOCATION_MEASURES)
    overwrite_by_date(partials(spark, ROWS), path)
    check(spark, folder)
    files = sorted(glob.glob(f"{folder}/totals/*/*/*"))
    check(spark, folder)
    assert sorted(glob.glob(f"{folder}/totals/*/*/*")) == files
    with pytest.raises(ValueError, match="other keys or measures"):
        totals.maintain_totals(spark, path, f"{folder}/totals", ["pickup_hour"], M.HOURLY_MEASURES)
    drop_partitions(spark, path, [dt.date(2024, 1, n) for n in (1, 2, 3)])
    found = totals.maintain_totals(spark, path, f"{folder}/totals", ["PULocationID"], M.LOCATION_MEASURES)
    assert found.count() == 0
    replace_partitions(partials(spark, [day(2)]), path)
    check(spark, folder)
