"""Where the readers of published sections find them: the manifest names the version that is whole.

A publication is a folder with

    _versions/<version>/<section>/...   the sections of each run, written before anyone looks for them
    _manifests/<number>.json            one small file per run that came to its end, the largest number holds

A run writes its sections, then its manifest. Until that file is there, readers see the sections of the run before, all of them.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

VERSIONS, MANIFESTS = "_versions", "_manifests"


def hadoop(spark: SparkSession, name: str):
    """(file system, path) of a name, on any file system Spark can reach."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _text(spark: SparkSession, name: str) -> str:
    system, path = hadoop(spark, name)
    stream = system.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def manifests(spark: SparkSession, output: str) -> list[str]:
    """Names of the manifests, the newest first; there are two at most, as a run removes those before the last."""
    system, path = hadoop(spark, f"{output}/{MANIFESTS}")
    if not system.exists(path):
        return []
    names = [status.getPath().getName() for status in system.listStatus(path)]
    return sorted((n for n in names if n.endswith(".json") and not n.startswith(".")), reverse=True)


def current(spark: SparkSession, output: str) -> dict | None:
    """The newest manifest: version, and the format of each section; None where nothing was published."""
    found = manifests(spark, output)
    return json.loads(_text(spark, f"{output}/{MANIFESTS}/{found[0]}")) | {"number": int(found[0][:-5])} if found else None


def resolve(spark: SparkSession, path: str) -> str:
    """The folder to read for `<output>/<section>`: the section's current version, or the path itself if it is not published."""
    output, _, name = path.rstrip("/").rpartition("/")
    manifest = current(spark, output) if output else None
    return f"{output}/{VERSIONS}/{manifest['version']}/{name}" if manifest and name in manifest["sections"] else path


def read_section(spark: SparkSession, output: str, name: str, schema: str | None = None) -> DataFrame:
    """One section of the current version; `schema` in place of an inferred one."""
    manifest = current(spark, output)
    if not manifest or name not in manifest["sections"]:
        raise FileNotFoundError(f"No published section {name} in {output}")
    reader = spark.read.option("header", True) if manifest["sections"][name] == "csv" else spark.read
    reader = reader.schema(schema) if schema else reader
    return reader.format(manifest["sections"][name]).load(resolve(spark, f"{output}/{name}"))
