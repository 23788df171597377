"""Session settings that grow with the data."""

from __future__ import annotations

MIB = 1 << 20
TASK_BYTES = 128 * MIB


def recommended(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for jobs over ``input_bytes``, to be set before the first query.

    Shuffles start with partitions of about 128 MiB and never fewer than the cores;
    adaptive execution merges those that turn out small and splits those that a hot
    key makes large.
    """
    partitions = max(cores, -(-input_bytes // TASK_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(TASK_BYTES),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
