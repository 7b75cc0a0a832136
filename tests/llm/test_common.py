"""Helpers that the operators share."""

import glob
import os
import time

from vigil.llm.common import stored


def shuffled(spark):
    return {f for f in glob.glob(f"{spark.conf.get('spark.local.dir')}/**/shuffle_*.data", recursive=True) if os.path.exists(f)}


def test_shuffles_of_a_stored_table_are_gone_when_it_is_there(spark):
    before = shuffled(spark)
    kept = stored(spark.range(10_000).repartition(4, "id"))
    for _ in range(50):  # removal is not waited for
        if not shuffled(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffled(spark) - before
    assert kept.count() == 10_000
    other = spark.range(10_000).repartition(4, "id")
    assert other.count() == 10_000 and shuffled(spark) - before  # what others shuffle stays while they hold it
