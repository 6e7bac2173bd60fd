"""Artefact versions over a registry table.

The original lists the model folder, keeps names starting with "v", reads
characters 2-5 as a number and takes the maximum (current model) or the
maximum plus 0.01 (name for the next save). Here the listing is a table of
fitted runs ``(model, name)``, so many models are resolved in one
aggregation instead of a driver-side directory walk.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: version text layout ---
VERSION_PREFIX = "v"
VERSION_FIRST_CHAR = 2      # 1-based position of the number in the name
VERSION_CHARS = 4           # characters 2..5
VERSION_STEP = 0.01
FILE_SUFFIX = "_model_gbm.RData"


def with_version(files: DataFrame, name: str = "name") -> DataFrame:
    """Keep names starting with "v" and add their numeric ``version``."""
    return (files.filter(F.col(name).startswith(VERSION_PREFIX))
            .withColumn("version", F.substring(F.col(name), VERSION_FIRST_CHAR, VERSION_CHARS)
                        .try_cast("double")))


def version_text(v) -> F.Column:
    """``paste0("v", format(v, nsmall = 2), suffix)``."""
    return F.format_string(VERSION_PREFIX + "%.2f" + FILE_SUFFIX, v)


def resolve_versions(files: DataFrame, group: Sequence[str] = ("model",),
                     name: str = "name") -> DataFrame:
    """Per model: current version (max), its file name, next version and next file name."""
    v = with_version(files, name)
    agg = v.groupBy(*group).agg(F.max("version").alias("current_version"),
                                F.max_by(F.col(name), F.col("version")).alias("current_name"))
    nxt = F.col("current_version") + F.lit(VERSION_STEP)
    return agg.select(*group, "current_version", "current_name",
                      version_text(F.col("current_version")).alias("current_file"),
                      nxt.alias("next_version"), version_text(nxt).alias("next_file"))


# ---- a stored registry --------------------------------------------------------------------
# <root>/entries/model=<model>/<version file>   one line each: the file's name
# <root>/artefacts/<model>/<version>            what was saved

def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _create(spark: SparkSession, path: str, line: str) -> bool:
    """Create a file that must not exist; False if another caller was first."""
    p, fs = _file_system(spark, path)
    data = (line + "\n").encode()
    if fs.getScheme() == "file":              # Hadoop's local files check and create in two steps
        local = p.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            with open(local, "xb") as f:
                f.write(data)
        except FileExistsError:
            return False
        return True
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if fs.exists(p):
            return False
        raise e
    out.write(bytearray(data))
    out.close()
    return True


def stored_registry(spark: SparkSession, root: str) -> DataFrame:
    """(model, name) of every version taken under ``root``."""
    p, fs = _file_system(spark, f"{root}/entries")
    if not fs.exists(p):
        return spark.createDataFrame([], "model string, name string")
    return spark.read.schema("value string, model string").text(f"{root}/entries").select("model", F.col("value").alias("name"))


def take_version(spark: SparkSession, root: str, model: str, tries: int = 1000) -> str:
    """The model's next version file name, taken by creating its entry: of several callers each gets another.

    Only the folder of this model is listed. A caller that dies after it leaves a version without an artefact.
    """
    folder = f"{root}/entries/model={model}"
    for _ in range(tries):
        p, fs = _file_system(spark, folder)
        names = [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []
        taken = [float(n[VERSION_FIRST_CHAR - 1:VERSION_FIRST_CHAR - 1 + VERSION_CHARS]) for n in names
                 if n.startswith(VERSION_PREFIX) and n.endswith(FILE_SUFFIX)]
        name = f"{VERSION_PREFIX}{max(taken) + VERSION_STEP if taken else 1.0:.2f}{FILE_SUFFIX}"
        if _create(spark, f"{folder}/{name}", name):
            return name
    raise RuntimeError(f"no version of {model} could be taken")


def artefact_path(root: str, model: str, name: str) -> str:
    return f"{root}/artefacts/{model}/{name.removesuffix('.RData')}"


def save_version(spark: SparkSession, root: str, model: str, write: Callable[[str], None]) -> tuple[str, str]:
    """Take the next version and ``write`` its artefact; (version file name, path)."""
    name = take_version(spark, root, model)
    path = artefact_path(root, model, name)
    write(path)
    return name, path
