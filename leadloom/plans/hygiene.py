"""The whole run: validate, normalize, resolve, drop, restore, gate, write."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from leadloom.functions import domains, fixed_values, names
from leadloom.functions import sqltext as F
from leadloom.functions.text import add_flags, flag_list
from leadloom.operators import audit, dedupe, gates
from leadloom.operators.enrich import Provider, enrich, enrich_stats
from leadloom.operators.normalize import normalize
from leadloom.operators.validate import AUDIT, Resolver, resolve_domains, validate
from leadloom.sources import crm, csv_leads, folders
from leadloom.sources.memory import VerdictMemory
from leadloom.tables import Scratch

ORDER = "row_order"


@dataclass
class Run:
    """Tables of a finished run. leads has the source's columns, internal also the audit columns."""

    leads: DataFrame
    internal: DataFrame
    audit: DataFrame
    log: DataFrame
    dropped: DataFrame
    source: DataFrame
    counts: dict[str, int] = field(default_factory=dict)


def fill_websites(df: DataFrame) -> DataFrame:
    """Websites resolved again with what merging brought together."""
    if "Website" not in df.columns:
        return df
    v = lambda c: F.col(c) if c in df.columns else F.lit("")
    return df.withColumn("Website", F.coalesce(domains.resolved_website(v("Website"), v("Company"), v("Email"))["value"], F.lit("")))


def mark_drops(df: DataFrame) -> DataFrame:
    """df with _drop: test and junk rows, those included that became junk by normalizing, which get the flag."""
    v = lambda c: F.col(c) if c in df.columns else F.lit("")
    flagged = F.arrays_overlap(flag_list(F.col("data_quality_flags")), F.array(F.lit("test_data"), F.lit("junk_lead")))
    junk = names.is_junk_lead(v("Company"), v("Email"), F.col("Phone") if "Phone" in df.columns else None)
    out = df.withColumn("_drop", flagged | junk)
    return out.withColumn("data_quality_flags", F.array_join(add_flags(flag_list(F.col("data_quality_flags")), (F.col("_drop") & ~flagged, "junk_lead")), "|"))


def run(source: DataFrame, mx: DataFrame | None = None, aliases: names.Aliases = fixed_values.ALIASES, baseline: DataFrame | None = None, accept_changes: bool = False, check: bool = True, resolver: Resolver | None = None, memory: VerdictMemory | None = None) -> Run:
    """All stages over a table of leads. Raises GateError, and writes nothing, if a gate is closed.

    resolver: asked for mail domains that mx lacks, and that memory, if given, doesn't know from earlier runs. baseline: the last good result; changed cells of Ids that it has close the gate unless accept_changes.
    """
    spark = source.sparkSession
    scratch = Scratch(spark, "hygiene")
    columns = [c for c in source.columns if c not in (*AUDIT, ORDER)]
    rows = source if ORDER in source.columns else csv_leads.numbered(source)
    rows = scratch.keep(rows)
    if resolver is not None and "Email" in rows.columns:
        mx = resolve_domains(rows, mx, resolver, memory=memory)
    elif memory is not None and "Email" in rows.columns:
        mx = resolve_domains(rows, mx, lambda domain: None, memory=memory)
    valid = scratch.keep(validate(rows, mx))
    normal = scratch.keep(normalize(valid.drop("_issues"), aliases))
    survivors, log = dedupe.dedupe(normal.drop("_changes"), ORDER)
    marked = scratch.keep(mark_drops(fill_websites(survivors)))
    dropped = marked.filter("_drop").drop("_drop")
    kept = marked.filter("NOT _drop").drop("_drop")
    lines = scratch.keep(audit.audit_log(marked.drop("_drop"), log)) if "Id" in source.columns else log
    out = scratch.keep(gates.strip_phone_markers(gates.restore_from_source(rows, kept)))
    leads = out.select(*columns, ORDER)
    if check:
        violations = [gates.invariants(out), gates.row_growth(rows, out), gates.schema_violations(leads), gates.phone_state_violations(out)]
        if "Id" in source.columns:
            violations.append(gates.provenance(rows, out, log, dropped))
        more = gates.header_violations(leads.columns[:-1], columns)
        if baseline is not None and not accept_changes:
            changed = gates.cell_changes(baseline, leads)
            violations.append(changed.groupBy(F.lit("changed_since_baseline").alias("rule")).agg(F.count("*").alias("n"), F.array(F.min(F.concat_ws(" ", "Id", "column"))).alias("samples")).filter("n > 0"))
        gates.close_gate(*violations, more=more)
    a, b, c = (valid.agg(F.sum("_issues")).first()[0], normal.agg(F.sum("_changes")).first()[0], audit.run_counts(rows, out).first()) if check else (None, None, None)
    counts = {} if c is None else c.asDict() | {"validation_issues": a or 0, "values_normalized": b or 0, "records_dropped": dropped.count()}
    if counts:
        counts["duplicates_merged"] = counts["leads_in"] - counts["leads_out"] - counts["records_dropped"]
    return Run(leads, out, lines, log, dropped, rows, counts)


def save(result: Run, folder: str, single: bool = False, connection: crm.Connection | None = None, transport: crm.Transport | None = None) -> None:
    """Leads, a copy for spreadsheets and the audit log, all of them or none, in the place of a former run's.

    Nothing is put in place unless everything could be written and the header, read back from the files, is the source's. A CRM, if
    the leads came from one, is updated once all files stand ready; what it refused, record by record, is one more part.
    """
    spark, columns = result.leads.sparkSession, [c for c in result.leads.columns if c != ORDER]
    parts = {
        "deduped": lambda path: csv_leads.write_leads(result.leads, columns, path, ORDER, single),
        "deduped_review": lambda path: csv_leads.write_leads(result.leads, columns, path, ORDER, single, guard=True),
        "dedup_log": lambda path: result.audit.orderBy("surviving_lead_id").write.mode("overwrite").csv(path, header=True, escape='"', emptyValue=""),
    }

    def check(staged: str) -> None:
        gates.close_gate(more=gates.header_violations(csv_leads.read_header(spark, f"{staged}/deduped"), csv_leads.written_header(columns)))
        if connection is not None:
            refused = crm.write_crm(result.leads.select(columns), connection, transport)
            refused.write.csv(f"{staged}/crm_refused", header=True, escape='"', emptyValue="")

    folders.publish(spark, folder, parts, check, ("crm_refused",) if connection is not None else ())


TABLES = ("leads", "internal", "audit", "log", "dropped", "source")


class Session:
    """Steps that need each other: lookup and enrichment work on the last good run.

    A run can be kept in a folder and reopened by another session, under its own identity.
    """

    def __init__(self) -> None:
        self.last: Run | None = None
        self.identity: dict[str, str] = {}

    def run(self, source: DataFrame, **how: object) -> Run:
        self.last = None
        self.last = run(source, **how)
        self.identity = {"id": uuid.uuid4().hex, "made": datetime.now(UTC).isoformat(timespec="seconds")}
        return self.last

    def keep(self, folder: str) -> dict[str, str]:
        """Store the last run's tables, counts and identity, all of them or none, in the place of a run kept there before."""
        done, store = self._need(), folders.Store(self._need().leads.sparkSession, folder)
        told = json.dumps({"identity": self.identity, "counts": done.counts, "rows": {n: getattr(done, n).count() for n in TABLES}})
        parts = {n: (lambda path, n=n: getattr(done, n).write.parquet(path)) for n in TABLES} | {"run.json": lambda path: store.write(path, told)}
        folders.publish(done.leads.sparkSession, folder, parts)
        return self.identity

    @staticmethod
    def reopen(spark: SparkSession, folder: str) -> Session:
        """A session whose last run is the one that was kept in a folder; a commit that broke off is finished first."""
        folders.recover(spark, folder)
        store, out = folders.Store(spark, folder), Session()
        if not store.exists(f"{folder}/run.json"):
            raise csv_leads.SourceError(f"{folder}: no run was kept here")
        told = json.loads(store.read(f"{folder}/run.json"))
        out.identity, out.last = told["identity"], Run(**{n: spark.read.parquet(f"{folder}/{n}") for n in TABLES}, counts=told["counts"])
        return out

    def _need(self) -> Run:
        if self.last is None:
            raise csv_leads.SourceError("no finished run in this session; run it first")
        return self.last

    def find(self, query: str) -> tuple[DataFrame, int]:
        return audit.find_leads(self._need().leads, query)

    def enrich(self, companies: Provider | None, contacts: Provider | None) -> tuple[DataFrame, DataFrame]:
        """The last run's leads with blanks filled, and statistics."""
        done = enrich(csv_leads.require(self._need().leads, enrichment=True), companies, contacts)
        return done.drop("_filled", "_sent", "_matched"), enrich_stats(done)
