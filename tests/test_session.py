from tally.session import partition_conf, size_partitions

from tests.conftest import SF_SMALL


def test_partition_conf_scales_with_input():
    small = partition_conf(10 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"            # at least two per core
    mid = partition_conf(1 << 40, 2000)
    assert mid["spark.sql.shuffle.partitions"] == "4096"            # 1 TiB / 256 MiB
    huge = partition_conf(100 << 40, 8000)
    assert int(huge["spark.sql.shuffle.partitions"]) == 400 * 1024    # no bound unless the caller gives one
    assert partition_conf(100 << 40, 8000, max_shuffle_partitions=30_000)["spark.sql.shuffle.partitions"] == "30000"
    assert huge["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == huge["spark.sql.shuffle.partitions"]
    assert small["spark.sql.adaptive.coalescePartitions.minPartitionSize"] == str(64 * 1024)
    assert huge["spark.sql.adaptive.coalescePartitions.minPartitionSize"] == str(1 << 20)


def test_size_partitions_reads_sizes_and_sets_session(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    conf = {}
    try:
        conf = size_partitions(spark, SF_SMALL, cores=4)
        assert spark.conf.get("spark.sql.shuffle.partitions") == conf["spark.sql.shuffle.partitions"] == "8"
    finally:
        for key in conf:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", before)
