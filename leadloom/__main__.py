"""python -m leadloom run INPUT OUTPUT | run --source crm OUTPUT | capture INPUT BASELINE | compare BASELINE INPUT"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from leadloom.operators import gates, report
from leadloom.operators.gates import GateError
from leadloom.plans import hygiene
from leadloom.sources import crm, csv_leads, dictionaries
from leadloom.sources.memory import VerdictMemory


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="leadloom", description=__doc__)
    how = argparse.ArgumentParser(add_help=False)
    how.add_argument("--verdicts", help="JSON of domains that take mail")
    how.add_argument("--memory", help="folder of answers about mail domains from earlier runs")
    how.add_argument("--guard", action="store_true", help=f"refuse more than {csv_leads.MAX_ROWS} rows or {csv_leads.MAX_CHARS} bytes")
    commands = p.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", parents=[how], help="clean, resolve and write leads")
    run.add_argument("--source", choices=("csv", "crm"), default="csv")
    run.add_argument("--accept-changes", action="store_true")
    run.add_argument("--baseline", help="the last good result: changes to its rows stop the run")
    run.add_argument("paths", nargs="+", help="INPUT and OUTPUT; only OUTPUT with --source crm")
    capture = commands.add_parser("capture", parents=[how], help="keep a run's result as a baseline")
    capture.add_argument("input")
    capture.add_argument("baseline")
    compare = commands.add_parser("compare", parents=[how], help="show what a run changes against a baseline")
    compare.add_argument("baseline")
    compare.add_argument("input")
    compare.add_argument("--expect", action="append", default=[], help="a column that may change")
    compare.add_argument("--key", default="Id")
    a = p.parse_args(given)
    if a.command == "run" and len(a.paths) != (2 if a.source == "csv" else 1):
        run.error("give INPUT and OUTPUT" if a.source == "csv" else "give OUTPUT")
    return a


def read(spark: SparkSession, path: str, guard: bool) -> DataFrame:
    limits = {"max_bytes": csv_leads.MAX_CHARS} if guard else {}
    return csv_leads.require(csv_leads.read_leads(spark, path, order=hygiene.ORDER, **limits), max_rows=csv_leads.MAX_ROWS if guard else None)


def run(spark: SparkSession, a: argparse.Namespace, connection: crm.Connection | None = None, transport: crm.Transport | None = None) -> int:
    mx = dictionaries.read_verdicts(spark, a.verdicts) if a.verdicts else None
    memory = VerdictMemory(spark, a.memory) if a.memory else None
    if a.command == "capture":
        done = hygiene.run(read(spark, a.input, a.guard), mx=mx, memory=memory)
        csv_leads.write_leads(done.leads, [c for c in done.leads.columns if c != hygiene.ORDER], a.baseline, single=True)
        return 0
    if a.command == "compare":
        old = csv_leads.read_leads(spark, a.baseline)
        new = hygiene.run(read(spark, a.input, a.guard), mx=mx, memory=memory).leads.drop(hygiene.ORDER)
        told = gates.frame_report(old, new, a.key, tuple(a.expect))
        print("\n".join(gates.report_lines(told)))
        return int(bool(told["added_columns"] or told["dropped_columns"]) or not told["unexpected"].isEmpty())
    if a.source == "crm":
        connection = connection or crm.Connection.from_environment()
        source = csv_leads.require(crm.read_crm(spark, connection, transport), max_rows=csv_leads.MAX_ROWS if a.guard else None)
    else:
        connection, source = None, read(spark, a.paths[0], a.guard)
    done = hygiene.run(source, mx=mx, memory=memory, baseline=csv_leads.read_leads(spark, a.baseline) if a.baseline else None, accept_changes=a.accept_changes)
    hygiene.save(done, a.paths[-1], connection=connection, transport=transport)
    print("\n".join(report.lines(report.summary(done))))
    return 0


def main() -> int:
    a = arguments()
    try:
        return run(SparkSession.builder.getOrCreate(), a)
    except (GateError, csv_leads.SourceError, crm.NotConnected, crm.RequestFailed) as e:
        print(f"nothing written: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
