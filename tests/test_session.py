"""What the session settings bound."""

from __future__ import annotations

import pytest

from doseline.session import ADVISORY, MOST_READ, configure, size_in_bytes


@pytest.fixture
def advised(spark):
    before = spark.conf.get(ADVISORY)
    yield
    spark.conf.set(ADVISORY, before)


@pytest.mark.parametrize("asked", ["64MB", "1g", "67108864b", "67108864"])
def test_a_task_reads_a_bounded_part_of_a_shuffle(spark, advised, asked):
    spark.conf.set(ADVISORY, asked)
    configure(spark)
    assert size_in_bytes(spark.conf.get(ADVISORY)) == MOST_READ


def test_smaller_partitions_are_kept(spark, advised):
    spark.conf.set(ADVISORY, "16k")
    configure(spark)
    assert spark.conf.get(ADVISORY) == "16k"


def test_spark_s_own_size_is_bounded(spark, advised):
    spark.conf.unset(ADVISORY)
    configure(spark)
    assert size_in_bytes(spark.conf.get(ADVISORY)) == MOST_READ
