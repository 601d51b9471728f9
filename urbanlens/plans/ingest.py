"""Ingestion of datasets that don't depend on one another.

Each dataset is validated against its contract, landed as a new folder and published in
its own version log. A dataset that fails keeps its last good version while the others
move on; the outcomes name the stage and the error.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import astuple, dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from urbanlens.operators.versions import VersionLog
from urbanlens.sources import contracts as V


@dataclass(frozen=True)
class Outcome:
    dataset: str
    stage: str  # the last one that was reached
    status: str  # success, failed
    rows: int
    error: str | None = None


class StageError(RuntimeError):
    def __init__(self, stage: str, cause: BaseException):
        super().__init__(str(cause))
        self.stage, self.cause = stage, cause


def write_counted(df: DataFrame, path: str, write: Callable[[DataFrame, str], None] = lambda df, path: df.write.parquet(path)) -> int:
    """Write ``df`` and return its number of rows, which the files' footers hold."""
    write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def run_each(steps: Mapping[str, Callable[[], int]]) -> list[Outcome]:
    """Run one step for each dataset; a failure is that dataset's outcome and stops no other."""
    out = []
    for dataset, step in steps.items():
        try:
            out.append(Outcome(dataset, "load", "success", step()))
        except StageError as exc:
            out.append(Outcome(dataset, exc.stage, "failed", 0, str(exc.cause)))
        except (RuntimeError, ValueError, OSError, PySparkException) as exc:
            out.append(Outcome(dataset, "load", "failed", 0, f"{type(exc).__name__}: {str(exc).splitlines()[0]}"))
    return out


def ingest(spark: SparkSession, base: str, dataset: str, paths: str | Sequence[str], contract: V.Contract) -> int:
    """Validate the files, land them as text under ``base/dataset`` and publish the folder."""
    from urbanlens.sources.delimited import read_delimited

    found = V.validate(spark, paths, contract)
    try:
        V.raise_on_errors(found)
    except V.ContractError as exc:
        raise StageError("validate", ValueError(f"{exc.check}: {exc.column}")) from exc
    folder = f"{base.rstrip('/')}/{dataset}/v-{uuid.uuid4().hex[:12]}"
    # parquet of any column name; the contract's columns under their names, in its order
    rows = write_counted(read_delimited(spark, paths, columns=contract.names), folder)
    VersionLog(spark, f"{base.rstrip('/')}/_versions/{dataset}").push({"path": folder, "rows": rows})
    return rows


def ingest_all(spark: SparkSession, base: str, deliveries: Mapping[str, tuple[str | Sequence[str], V.Contract]]) -> list[Outcome]:
    return run_each({name: lambda n=name, p=paths, c=contract: ingest(spark, base, n, p, c)
                     for name, (paths, contract) in deliveries.items()})


def snapshot(spark: SparkSession, base: str, datasets: Sequence[str]) -> dict[str, str]:
    """Folder of the newest good version of each dataset that has one."""
    newest = {d: VersionLog(spark, f"{base.rstrip('/')}/_versions/{d}").newest() for d in datasets}
    return {d: v.body["path"] for d, v in newest.items() if v is not None}


def summary(spark: SparkSession, outcomes: Sequence[Outcome]) -> DataFrame:
    """The outcomes and a totals row."""
    return V.run_summary(spark, [astuple(o) for o in outcomes])
