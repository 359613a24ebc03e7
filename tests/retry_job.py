"""Run clean → star → collapse with or without injected task failures and
print a digest of the result (used by test_retry.py in a separate process,
because task retries need a ``local[n, maxFailures]`` master)."""

import hashlib
import json
import sys

sys.path.insert(0, sys.argv[1])

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from shelfwise.plans import star as S  # noqa: E402
from shelfwise.plans.cleaning import clean_titles  # noqa: E402
from shelfwise.session import get_spark  # noqa: E402
from shelfwise.sources import fixtures as fx  # noqa: E402


def _flaky(x):  # test-only: the first attempt of every task of partition 1 fails
    tc = TaskContext.get()
    if tc.attemptNumber() == 0 and tc.partitionId() == 1:
        raise RuntimeError("injected task failure")
    return x


def main():
    inject = sys.argv[2] == "inject"
    spark = get_spark("local[4,4]", app="retry", shuffle_partitions=4)
    flaky = F.udf(_flaky, "long")
    raw = fx.titles_with_duplicates(spark, sys.argv[3]).repartition(4, "title_id")
    if inject:
        raw = raw.withColumn("title_id", flaky("title_id"))
    titles = S.star_titles(S.build_star(clean_titles(raw)))
    rows = sorted(repr(tuple(r)) for r in titles.collect())
    print(json.dumps({"n": len(rows), "digest": hashlib.sha256("\n".join(rows).encode()).hexdigest()}))
    spark.stop()


if __name__ == "__main__":
    main()
