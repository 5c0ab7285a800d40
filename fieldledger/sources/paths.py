"""Small questions to the file system that Spark reads from."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """Hadoop path and its file system; works for every store Spark can read."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = file_system(spark, path)
    return fs.exists(hadoop_path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a job finished writing ``path``."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS")


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` has an entry that Spark would read."""
    hadoop_path, fs = file_system(spark, path)
    if not fs.exists(hadoop_path):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(hadoop_path))


def list_periods(spark: SparkSession, path: str, column: str = "PERIOD") -> list[int]:
    """Periods a stage dataset holds, from its partition folders; no data file is opened."""
    hadoop_path, fs = file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    found = [re.fullmatch(rf"{column}=(\d+)", s.getPath().getName()) for s in fs.listStatus(hadoop_path)]
    return sorted(int(match.group(1)) for match in found if match)


def list_folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers ``n`` of the folders ``<prefix>=<n>`` below ``path``."""
    return list_periods(spark, path, prefix)


def first_lines(spark: SparkSession, files: Sequence[str]) -> dict[str, str]:
    """The first line of each text file that is not blank; a file without one is left out.

    Files are opened side by side and no more than their beginnings is read, packed files included.
    """
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first(file: str) -> str | None:
        target = spark._jvm.org.apache.hadoop.fs.Path(file)
        stream = target.getFileSystem(conf).open(target)
        try:
            codec = codecs.getCodec(target)
            plain = stream if codec is None else codec.createInputStream(stream)
            lines = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(plain, "UTF-8"))
            line = lines.readLine()
            if line is not None:
                line = line.removeprefix("\ufeff")
            while line is not None and not line.strip(" "):
                line = lines.readLine()
            return line
        finally:
            stream.close()

    with ThreadPoolExecutor(16) as pool:
        found = list(pool.map(first, files))
    return {file: line for file, line in zip(files, found, strict=True) if line is not None}
