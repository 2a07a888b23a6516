"""The cleaning chain runs unchanged on a stream source."""

import os

from tabulon.plans import fixtures as fx
from tabulon.streaming import clean_trip_stream


def test_trip_stream(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "in")
    os.makedirs(src)
    good = ",".join(["m", "L1", "x", "x", "x", "2013-01-01 10:00:00", "2013-01-01 10:30:00", "x", "x", "x",
                     "2.5", "2.5", "2.5", "2.5"])
    far = good.replace("2013-01-01 10:30:00", "2013-01-01 15:00:00")
    zero = good.replace("2.5", "bad")
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write("\n".join([good, far, zero]) + "\n")
    s = clean_trip_stream(spark, src, fx.regions(spark))
    q = (s.writeStream.format("memory").queryName("trip_stream_test").outputMode("append")
         .option("checkpointLocation", os.path.join(tmpdir_fresh, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    rows = spark.sql("SELECT license, region FROM trip_stream_test").collect()
    assert [(r["license"], r["region"]) for r in rows] == [("L1", "west")]
