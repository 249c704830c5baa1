"""Reading recordings: file listings and tracking logs, as tables or as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: One row for each video frame, in the order of the log's columns.
TRACKING = ", ".join(
    f"{name} {kind}"
    for kind, names in (
        ("long", ["frame"]),
        ("double", ["d_cam_x", "d_cam_y", "d_cam_z", "d_error", "d_lab_x", "d_lab_y", "d_lab_z", "cam_x", "cam_y", "cam_z", "lab_x", "lab_y", "lab_z", "pos_x", "pos_y", "heading", "direction", "speed", "forward", "side", "t"]),
        ("long", ["sequence"]),
    )
    for name in names
)
_CSV = {"ignoreLeadingWhiteSpace": True, "ignoreTrailingWhiteSpace": True, "mode": "PERMISSIVE"}


def tracking_log(spark: SparkSession, path: str) -> DataFrame:
    """The tracking logs at path (a file, folder or glob); a field that is missing or no number is null."""
    return spark.read.options(**_CSV).schema(TRACKING).csv(path)


def tracking_stream(spark: SparkSession, path: str) -> DataFrame:
    """The same of a folder, as a stream of its files."""
    return spark.readStream.options(**_CSV).schema(TRACKING).csv(path)


def files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, modificationTime, length) of the files at any depth below root whose name fits the pattern; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return found.select("path", "modificationTime", "length")
