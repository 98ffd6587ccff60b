"""An append-only journal of runs: typed entries, read back as a table of runs.

Every entry is a file of its own, written once and never changed, so runs can write at the same time and a
stopped run leaves what it had. An entry has the version of its form; readers take the versions they know and
count the others.

============  ===================================================
RUN_STARTED   first entry of a run; detail has its arguments
STEP_DONE     a step, with the rows it made
QUOTA_HIT     a service's budget is used up; the run may end early
RULE_BROKEN   a quality rule and how many rows break it
RUN_DONE      the run ended well
RUN_FAILED    detail has the error
============  ===================================================
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.sources.files import path_exists

ENTRY = (
    "version int, run_id string, seq bigint, job string, type string, step string, rows bigint, "
    "detail map<string,string>, ts timestamp"
)
VERSION = 1
TYPES = ("RUN_STARTED", "STEP_DONE", "QUOTA_HIT", "RULE_BROKEN", "RUN_DONE", "RUN_FAILED")
RUNS = (
    "run_id string, job string, status string, started timestamp, ended timestamp, steps bigint, rows bigint, "
    "quota_hits bigint, rules_broken bigint, error string"
)


class RunJournal:
    """The entries of one run; as a context it starts the run and ends it well or failed."""

    def __init__(self, spark: SparkSession, folder: str, job: str, run_id: str | None = None, **arguments: object) -> None:
        self.spark, self.folder, self.job = spark, folder, job
        self.run_id = run_id or uuid.uuid4().hex
        self.seq, self.arguments = 0, arguments

    def write(self, kind: str, step: str | None = None, rows: int | None = None, **detail: object) -> None:
        if kind not in TYPES:
            raise ValueError(f"{kind!r} is no type of entry")
        texts = {k: str(v) for k, v in detail.items() if v is not None}
        entry = (VERSION, self.run_id, self.seq, self.job, kind, step, rows, texts, dt.datetime.now(dt.timezone.utc))
        self.spark.createDataFrame([entry], ENTRY).coalesce(1).write.mode("append").parquet(self.folder)
        self.seq += 1

    def step(self, name: str, rows: int | None = None, **detail: object) -> None:
        self.write("STEP_DONE", name, rows, **detail)

    def quota_hit(self, name: str, used: int) -> None:
        self.write("QUOTA_HIT", name, used)

    def rules(self, table: str, report: DataFrame) -> int:
        """An entry for each broken rule of a quality report; returns how many break an error rule."""
        found = report.filter("broken > 0").collect()  # a row for each rule at most
        for r in found:
            self.write("RULE_BROKEN", f"{table}.{r['rule']}", r["broken"], severity=r["severity"], checked=r["checked"])
        return sum(r["severity"] == "error" for r in found)

    def __enter__(self) -> RunJournal:
        self.write("RUN_STARTED", **self.arguments)
        return self

    def __exit__(self, kind, error, trace) -> None:
        if error is None:
            self.write("RUN_DONE")
        else:
            self.write("RUN_FAILED", error=f"{kind.__name__}: {error}"[:2000])


def entries(spark: SparkSession, folder: str) -> DataFrame:
    """All entries of known versions, an entry written twice once; empty before the first run."""
    if not path_exists(spark, folder):
        return spark.createDataFrame([], ENTRY)
    stored = spark.read.schema(ENTRY).parquet(folder)
    return stored.filter(F.col("version").between(1, VERSION)).dropDuplicates(["run_id", "seq"])


def unknown_entries(spark: SparkSession, folder: str) -> int:
    """How many entries a newer version wrote."""
    return spark.read.schema(ENTRY).parquet(folder).filter(~F.col("version").between(1, VERSION)).count() if path_exists(spark, folder) else 0


def runs(journal: DataFrame) -> DataFrame:
    """A row for each run: status RUNNING, DONE or FAILED, its times and what it counted.

    A run whose entries lack an end is RUNNING; of a run with several ends the last counts.
    """
    kind = F.col("type")

    def when(*kinds: str) -> Column:
        return kind.isin(*kinds)

    end = F.max(F.when(when("RUN_DONE", "RUN_FAILED"), F.struct("seq", "type", "ts", F.element_at("detail", "error").alias("error"))))
    found = journal.groupBy("run_id", "job").agg(
        F.min("ts").alias("started"), end.alias("end"), F.count_if(when("STEP_DONE")).alias("steps"), F.sum(F.when(when("STEP_DONE"), F.col("rows"))).alias("rows"),
        F.count_if(when("QUOTA_HIT")).alias("quota_hits"), F.count_if(when("RULE_BROKEN")).alias("rules_broken"))
    status = F.when(F.col("end.type") == "RUN_DONE", "DONE").when(F.col("end.type") == "RUN_FAILED", "FAILED").otherwise("RUNNING")
    return found.select("run_id", "job", status.alias("status"), "started", F.col("end.ts").alias("ended"), "steps", "rows", "quota_hits", "rules_broken",
                        F.col("end.error").alias("error"))


def latest_runs(journal: DataFrame) -> DataFrame:
    """The last started run of each job."""
    order = Window.partitionBy("job").orderBy(F.desc("started"), F.desc("run_id"))
    return runs(journal).withColumn("n", F.row_number().over(order)).filter("n = 1").drop("n")
