"""Small helpers shared by the operators."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

from vaultmart.session import cut_lineage, ensure_checkpoint_dir, scratch_folder  # noqa: F401  (re-exported)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their Python workers can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_llm_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="llm-py-")
    path = os.path.join(folder, "llm_tasks.zip")
    with zipfile.ZipFile(path, "w") as z:
        for package in (here, os.path.join(os.path.dirname(here), "vaultmart")):
            for top, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(top, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(here)))
    sc.addPyFile(path)
    sc._llm_shipped = True


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores behind it as it takes to be none of the columns of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_table(df: DataFrame) -> None:
    """Delete a table written by ``cut_lineage`` that no later read needs."""
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        if "/tables/" in folder:
            delete_folder(df.sparkSession, folder)
