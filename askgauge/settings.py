"""Session settings for the length of a job: put in place before it starts, put back behind it."""

from contextlib import contextmanager

from pyspark.sql import SparkSession

# Shuffle files go when the write that made them has ended. Otherwise they stay until the driver happens to
# collect garbage, which one that only schedules seldom does, and the shuffles of all steps add up on disk.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# Wide rows are not sorted where they need not be: adaptive execution hashes the smaller side of a join if each of
# its partitions is below this size, and a task keeps a file open for each of a few table partitions.
NO_WIDE_SORTS = {
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "128MB",
    "spark.sql.maxConcurrentOutputFileWriters": "12",
}
# State on local disk in bounded memory per executor; the default store holds every key as objects on the heap,
# 213 bytes for a (run, question) pair.
_STORE = "spark.sql.streaming.stateStore"
ROCKS_DB = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.maxMemoryUsageMB": "1000",
    f"{_STORE}.rocksdb.writeBufferSizeMB": "16",
}
# Counting what is held costs a look-up per new key.
UNCOUNTED = {f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false"}


@contextmanager
def settings(spark: SparkSession, *values: dict[str, str]):
    """The settings hold for writes inside the block and for streams started in it, which keep them."""
    wanted = {name: value for part in values for name, value in part.items()}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
