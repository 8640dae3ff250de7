"""Access logs: text lines and JSON container logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The access-log format (address, time, request line, status, bytes, optional user agent).
ACCESS_LINE = (
    r'^([^ ]*) - - \[([^\]]*)\] "(\S+) (\S+) HTTP/\S+" ([^ ]*) ([^ "]*)(?: "([^"]*)")?\s*$'
)
ACCESS_TIME = "dd/MMM/yyyy:HH:mm:ss Z"

CONTAINER_LOG = T.StructType(
    [
        T.StructField("log", T.StringType()),
        T.StructField("stream", T.StringType()),
        T.StructField("time", T.TimestampType()),
        T.StructField(
            "kubernetes",
            T.StructType(
                [
                    T.StructField("pod_name", T.StringType()),
                    T.StructField("namespace_name", T.StringType()),
                    T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
                ]
            ),
        ),
    ]
)


def parse_access_log(df: DataFrame, line: str = "line") -> DataFrame:
    """Parse access-log lines into typed columns; ``malformed`` marks lines that do not match or hold a unit separator."""
    # one match per line: its groups are written side by side and read back from an array
    between = "\x1f"
    groups = F.regexp_replace(F.col(line), F.lit(ACCESS_LINE), F.lit(between + between.join(f"${i}" for i in range(1, 8))))
    source = df.withColumn("_parts", F.split(groups, between))
    matched = F.coalesce((F.size("_parts") == 8) & (F.get("_parts", F.lit(0)) == "") & ~F.col(line).contains(between), F.lit(False))

    def part(i: int):
        return F.when(matched, F.get("_parts", F.lit(i)))

    target = part(4)
    at = F.instr(target, "?")
    agent = part(7)
    return source.select(
        *df.columns,
        part(1).alias("remote_addr"),
        F.try_to_timestamp(part(2), F.lit(ACCESS_TIME)).alias("timestamp"),
        part(3).alias("method"),
        F.when(at > 0, target.substr(F.lit(1), at - 1)).otherwise(target).alias("path"),
        F.when(at > 0, target.substr(at + 1, F.length(target))).otherwise(F.when(matched, F.lit(""))).alias("query"),
        part(5).try_cast("int").alias("status"),
        part(6).try_cast("bigint").alias("body_bytes_sent"),
        F.when(agent != "", agent).alias("user_agent"),
        F.coalesce(~matched, F.lit(True)).alias("malformed"),
    )


def read_log_stream(spark: SparkSession, path: str, schema: T.StructType = CONTAINER_LOG, files_per_trigger: int = 1000) -> DataFrame:
    """Tail a folder of JSON container logs from its oldest file; pod, namespace and labels are flattened."""
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)
    return flatten_container_log(raw)


def flatten_container_log(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("log").alias("line"),
        F.col("time").alias("log_time"),
        F.col("kubernetes.pod_name").alias("pod"),
        F.col("kubernetes.namespace_name").alias("namespace"),
        F.col("kubernetes.labels")["app"].alias("app"),
    )
