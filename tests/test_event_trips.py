"""The next event of a user, against a plain loop, with a hot user and crowded seconds."""

import datetime as dt
import random

from curbline.plans.event_trips import with_next_time


def test_next_time_with_hot_user_and_ties(spark):
    pick = random.Random(9)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(4000):
        user = 1 if i % 3 == 0 else pick.randrange(2, 40)
        offset = pick.choice([pick.randrange(0, 120), pick.randrange(0, 30 * 86_400)])
        rows.append((i, start + dt.timedelta(seconds=offset, microseconds=pick.choice([0, 0, 5])), user, 1.0))
    expected = {}
    by_user = {}
    for event, ts, user, _ in sorted(rows, key=lambda r: (r[2], r[1], r[0])):
        if user in by_user:
            expected[by_user[user]] = ts
        by_user[user] = event
        expected[event] = None
    df = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, value double")
    found = {row["event_id"]: row["next_ts"] for row in with_next_time(df.repartition(7)).collect()}
    assert found == expected
