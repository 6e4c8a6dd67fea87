"""The whole load: ingest, dimensions, fact, rejects.

    spark-submit dimweave/plans/job.py --start_date 1997-01-01 --end_date 1997-12-31 \
        --sources <folder with one folder or file per sheet> --warehouse <folder>
"""

from __future__ import annotations

import argparse
import datetime
import logging
import sys
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dimweave.operators.facts import Window
from dimweave.plans.gate import IntegrityError, problems
from dimweave.plans.steps import StepResult, dimension_step, fact_step, reject_step
from dimweave.sources.ingest import stage_frame, stage_sheet
from dimweave.sources.schemas import FACT_TABLE, POLICIES, REJECT_TABLE, SOR, SOR_TABLE, SOURCES, sor_rows
from dimweave.sources.scratch import released
from dimweave.sources.warehouse import Change, Snapshot, Warehouse

log = logging.getLogger("dimweave")

AUDIT_TABLE = "LoadAudit"
AUDIT = T.StructType([
    T.StructField("execution_id", T.StringType()), T.StructField("step_no", T.IntegerType()),
    T.StructField("step", T.StringType()), T.StructField("source_table", T.StringType()),
    T.StructField("target_table", T.StringType()), T.StructField("n_rows", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("message", T.StringType()),
])


class _Run:
    """One execution: runs steps in turn, each committed alone, and records them."""

    def __init__(self, warehouse: Warehouse):
        self.warehouse = warehouse
        self.execution_id = str(uuid.uuid4())
        self.records: list[tuple] = []

    def step(self, name: str, source: str, target: str, load) -> None:
        """Load and write the changes of a step on the latest state, then publish them if they keep its integrity."""
        def written():
            base = self.warehouse.snapshot()
            with released():
                result: StepResult = load(base)
                draft = self.warehouse.write(base, result.changes, result.last_keys)
            wrong = problems(draft, base, [c.table for c in result.changes])
            if wrong:
                raise IntegrityError("; ".join(wrong))
            return draft, result, base

        self._publish(name, source, target, written)

    def ingest(self, loads: dict) -> None:
        """Stage and write all sheets at the same time, then publish them in turn up to the first failure."""
        base = self._with_sources(self.warehouse.snapshot())

        def staged(load):
            with released():
                result: StepResult = load(base)
                return self.warehouse.write(base, result.changes, {}), result

        with ThreadPoolExecutor(len(loads)) as pool:
            running = {source: pool.submit(staged, load) for source, load in loads.items()}
        for source, future in running.items():
            def written(source=source, future=future):
                draft, result = future.result()
                base = self.warehouse.snapshot()
                return base.with_table(source, draft), result, base

            self._publish(f"ingest_{source}", source, source, written)

    def _with_sources(self, base: Snapshot) -> Snapshot:
        """The state with the system-of-record table, seeded by the first run."""
        if SOR_TABLE in base.tables:
            return base
        seed = self.warehouse.spark.createDataFrame(sor_rows(), SOR).coalesce(1)
        self.warehouse.publish(self.warehouse.write(base, [Change(SOR_TABLE, seed)], {}))
        return self.warehouse.snapshot()

    def _publish(self, name: str, source: str, target: str, written) -> None:
        log.info("execution %s: starting %s", self.execution_id, name)
        try:
            draft, result, base = written()
            snapshot = self.warehouse.publish(draft, base)
        except Exception as error:
            self._record(name, source, target, None, "Failed", str(error))
            raise
        rows = snapshot.rows(target) if result.rows is None else result.rows
        self._record(name, source, target, rows, "Completed", None)
        log.info("execution %s: finished %s, %s rows", self.execution_id, name, rows)

    def _record(self, name, source, target, rows, status, message) -> None:
        self.records.append((self.execution_id, len(self.records) + 1, name, source, target, rows, status, message))

    def write_audit(self) -> None:
        spark = self.warehouse.spark
        rows = spark.createDataFrame(self.records, AUDIT).coalesce(1)
        base = self.warehouse.snapshot()
        self.warehouse.publish(self.warehouse.write(base, [Change(AUDIT_TABLE, rows, append=True)], {}), base)


def read_audit(spark: SparkSession, warehouse: str) -> DataFrame:
    """All recorded steps of all runs."""
    return Warehouse(spark, warehouse).snapshot().frame(AUDIT_TABLE, schema=AUDIT)


def _ingest(given, source: str, fmt: str, spark: SparkSession):
    def load(_: Snapshot) -> StepResult:
        if isinstance(given, DataFrame):
            staged = stage_frame(given, source)
        else:
            staged = stage_sheet(spark, given, source, fmt)
        return StepResult([Change(source, staged)], {})

    return load


def run_load(spark: SparkSession, sources: dict[str, DataFrame | str], warehouse: str, window: Window,
             as_of: datetime.date, load_ts: datetime.datetime | None = None, source_format: str = "parquet",
             collation: str | None = None) -> dict:
    """Run all steps; stop at the first failure, leaving the tables as the last good step left them.

    ``sources`` gives a DataFrame or a path for each source table.
    """
    load_ts = load_ts or datetime.datetime.combine(as_of, datetime.time())
    run = _Run(Warehouse(spark, warehouse))
    result = {"success": True, "execution_id": run.execution_id, "status": "Completed"}
    try:
        missing = [s for s in SOURCES if s not in sources]
        if missing:
            raise ValueError(f"no source given for {', '.join(missing)}")
        run.ingest({s: _ingest(sources[s], s, source_format, spark) for s in SOURCES})
        for policy in POLICIES.values():
            run.step(f"update_{policy.target}", policy.source, policy.target,
                     lambda base, p=policy: dimension_step(base, p, as_of, collation))
        both = "Orders, OrderDetails"
        run.step("update_fact", both, FACT_TABLE, lambda base: fact_step(base, window, load_ts, collation))
        run.step("update_rejects", both, REJECT_TABLE, lambda base: reject_step(base, window, load_ts, collation))
    except Exception as error:
        log.exception("execution %s failed", run.execution_id)
        result = {"success": False, "execution_id": run.execution_id, "status": "Failed", "error": str(error)}
    if run.records:
        run.write_audit()
    return result


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Load order data into the star schema")
    parser.add_argument("--start_date", required=True)
    parser.add_argument("--end_date", required=True)
    parser.add_argument("--sources", required=True, help="folder with one entry per source table")
    parser.add_argument("--warehouse", required=True)
    parser.add_argument("--source_format", default="parquet", choices=["parquet", "csv"])
    parser.add_argument("--collation", default=None, help="text collation, for example UTF8_LCASE_RTRIM")
    parser.add_argument("--as_of", default=None, help="load date, today if not given")
    args = parser.parse_args(argv)
    window = Window.parse(args.start_date, args.end_date)
    now = datetime.datetime.now()
    as_of = datetime.date.fromisoformat(args.as_of) if args.as_of else now.date()
    spark = SparkSession.builder.appName("dimensional-load").getOrCreate()
    suffix = "" if args.source_format == "parquet" else ".csv"
    sources = {s: f"{args.sources.rstrip('/')}/{s}{suffix}" for s in SOURCES}
    result = run_load(spark, sources, args.warehouse, window, as_of,
                      datetime.datetime.combine(as_of, now.time()), args.source_format, args.collation)
    return 0 if result["success"] else 1


if __name__ == "__main__":
    sys.exit(main())
