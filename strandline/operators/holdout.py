"""A holdout that is looked at once: eras by time, a claim that only one run can get, development before and nothing after."""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators.features import grouped_auroc
from strandline.sources.tables import append_ledger


class HoldoutUsed(RuntimeError):
    """The holdout of this protocol has been looked at; ``run`` is the run that did."""

    def __init__(self, run: str):
        super().__init__(f"the holdout was evaluated by run {run}")
        self.run = run


@dataclass(frozen=True)
class Protocol:
    """What is fixed before the data are seen. Eras are [from, to) by the time column ``at``; rows outside both are sealed: no scan reads them."""

    name: str
    at: str
    dev: tuple[str, str]
    holdout: tuple[str, str]
    features: tuple[str, ...]
    label: str
    settings: str = ""

    def hash(self) -> str:
        """Of all fields, so that any change is another protocol."""
        return hashlib.sha256(json.dumps(self.__dict__, sort_keys=True, default=list).encode()).hexdigest()


def during(df: DataFrame, at: str, era: tuple[str, str]) -> DataFrame:
    """Rows of an era by plain comparisons of the stored column, which reach the scan."""
    kind = df.schema[at].dataType.simpleString()
    return df.where((F.col(at) >= F.lit(era[0]).cast(kind)) & (F.col(at) < F.lit(era[1]).cast(kind)))


def claim(spark: SparkSession, ledger: str, name: str, note: dict) -> str | None:
    """Creates the file ``name`` in the ledger folder with ``note``, or gives the text of the one that is there. Creating fails where a file exists, on a local disk as in a shared store, so of two runs one gets it."""
    path = f"{ledger.rstrip('/')}/{name}"
    text = json.dumps(note)
    local = path.removeprefix("file://")
    if local.startswith("/"):
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            made = os.open(local, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
        except FileExistsError:
            with open(local) as f:
                return f.read()
        with os.fdopen(made, "w") as f:
            f.write(text)
        return None
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        out = fs.create(at, False)
    except Exception as failed:  # noqa: BLE001 the store's own exception for an existing file
        if not fs.exists(at):
            raise failed
        return "\n".join(r[0] for r in spark.read.text(path).collect())  # the note of one run
    out.write(bytearray(text.encode()))
    out.close()
    return None


def one_look(df: DataFrame, protocol: Protocol, fit: Callable[[DataFrame], Callable[[DataFrame], DataFrame]], ledger: str, run: str | None = None) -> DataFrame:
    """part (dev, holdout), n, positives, auroc. ``fit`` gets the development rows and gives a function that adds p.

    The model is fitted on the development era; then the run claims (protocol hash, holdout era), and only the run that gets it reads the holdout, once. Others raise HoldoutUsed with the first run's id, before the
    holdout is scanned. The claim is made before the look, so a run that breaks in between has used it too. Results go to the ledger.
    """
    run = run or uuid.uuid4().hex
    spark = df.sparkSession
    predict = fit(during(df, protocol.at, protocol.dev))
    key = hashlib.sha256(f"{protocol.hash()}/{protocol.holdout}".encode()).hexdigest()
    first = claim(spark, f"{ledger}/claims", key, {"run": run, "protocol": protocol.hash(), "holdout": protocol.holdout})
    if first is not None:
        raise HoldoutUsed(json.loads(first)["run"] if first else "unknown")
    parts = [predict(during(df, protocol.at, era)).select(F.lit(part).alias("part"), "p", F.col(protocol.label).cast("boolean").alias("_y")) for part, era in (("dev", protocol.dev), ("holdout", protocol.holdout))]
    rows = grouped_auroc(parts[0].unionByName(parts[1]), ["part"], "p", F.col("_y")).select("part", "n", "positives", "auroc").collect()  # two rows
    out = spark.createDataFrame(rows, "part string, n long, positives long, auroc double")
    append_ledger(out.withColumn("run", F.lit(run)).withColumn("protocol", F.lit(protocol.hash())), f"{ledger}/results")
    return out
