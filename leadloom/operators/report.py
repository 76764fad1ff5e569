"""What a run did, as tables of any size, and as a bounded report for people and for other programs.

merges, set_aside and directory give whole tables. A report holds counts and the first rows of each by Id, as many as a person
reads; how many more there are is counted, not listed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from leadloom.functions import sqltext as F
from leadloom.functions.text import cell, flag_list

from . import audit
from .audit import EXAMPLES

#: Rows of a list in a report, and changed cells in all.
LISTED, CELLS = 200, 400


def _name(alias: str | None = None) -> Column:
    at = (lambda c: F.col(f"{alias}.{c}")) if alias else F.col
    return F.trim(F.concat_ws(" ", cell(at("FirstName")), cell(at("LastName"))))


def people(df: DataFrame) -> DataFrame:
    """(id, name, company, email, phone) of leads; blank where a column is missing."""
    whole = df.select(*df.columns, *[F.lit("").alias(c) for c in ("Id", "FirstName", "LastName", "Company", "Email", "Phone") if c not in df.columns])
    return whole.select(cell(F.col("Id")).alias("id"), _name().alias("name"), cell(F.col("Company")).alias("company"), cell(F.col("Email")).alias("email"), cell(F.col("Phone")).alias("phone"))


def merges(log: DataFrame, source: DataFrame, out: DataFrame) -> DataFrame:
    """(survivor_id, survivor_name, merged_from, signals, confidence, line) of merges; merged_from: who went into the survivor."""
    who = people(source).select("id", "name", "company").dropDuplicates(["id"])
    now = people(out).select("id", F.col("name").alias("now")).dropDuplicates(["id"])
    m = log.filter("decision = 'auto_merge'").select("surviving_lead_id", "match_signals_used", "confidence_score", F.posexplode(F.filter(F.split("merged_from_ids", ";"), lambda x: x != "")).alias("place", "lost"))
    m = m.join(who.select(F.col("id").alias("lost"), F.col("name").alias("lost_name"), F.col("company").alias("lost_company")), "lost", "left")
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    one = m.groupBy(F.col("surviving_lead_id").alias("survivor_id")).agg(F.array_sort(F.collect_list(F.struct("place", F.col("lost").alias("id"), blank("lost_name").alias("name"), blank("lost_company").alias("company")))).alias("from"), F.first("match_signals_used").alias("used"), F.first("confidence_score").alias("confidence"))
    one = one.withColumn("merged_from", F.transform("from", lambda x: F.struct(x["id"].alias("id"), x["name"].alias("name"), x["company"].alias("company"))))
    one = one.join(now.withColumnRenamed("id", "survivor_id"), "survivor_id", "left").join(who.select(F.col("id").alias("survivor_id"), "name"), "survivor_id", "left")
    one = one.withColumns({"survivor_name": F.coalesce(F.nullif("now", F.lit("")), "name", F.lit("")), "signals": flag_list(F.col("used"))})
    called = lambda i, n: F.when(n == "", i).otherwise(F.concat(i, F.lit(" "), n))
    line = F.concat(called(F.col("survivor_id"), F.col("survivor_name")), F.lit(" <- "), F.array_join(F.transform("merged_from", lambda x: called(x["id"], x["name"])), ", "), F.lit(" ["), F.array_join("signals", ", "), F.lit("; "), F.lower("confidence"), F.lit("]"))
    return one.select("survivor_id", "survivor_name", "merged_from", "signals", "confidence", line.alias("line"))


def set_aside(lines: DataFrame, source: DataFrame, out: DataFrame) -> DataFrame:
    """(kind, id, name, company, flags) of rows that were dropped, or that wait for a person and are still there."""
    flags = flag_list(F.col("data_quality_flags"))
    kind = F.when(F.col("decision").isin("dropped_test_data", "dropped_junk_lead"), "dropped").when((F.col("decision") == "hitl_review") | F.array_contains(flags, "hitl_review"), "review")
    rows = lines.select(kind.alias("kind"), F.col("surviving_lead_id").alias("id"), flags.alias("flags")).filter("kind IS NOT NULL")
    there = people(out).select("id", F.lit(True).alias("there")).distinct()
    rows = rows.join(there, "id", "left").filter("kind = 'dropped' OR there")
    return rows.join(people(source).select("id", "name", "company").dropDuplicates(["id"]), "id", "left").select("kind", "id", F.coalesce("name", F.lit("")).alias("name"), F.coalesce("company", F.lit("")).alias("company"), "flags")


def directory(out: DataFrame, dropped: DataFrame) -> DataFrame:
    """people() of the result and, marked, of what was dropped."""
    return people(out).withColumn("dropped", F.lit(False)).unionByName(people(dropped).withColumn("dropped", F.lit(True)))


@dataclass
class Report:
    totals: dict[str, int]
    merges: list[dict] = field(default_factory=list)
    dropped: list[dict] = field(default_factory=list)
    review: list[dict] = field(default_factory=list)
    more: dict[str, int] = field(default_factory=dict)
    changed: dict[str, dict[str, int]] = field(default_factory=dict)
    examples: dict[str, list[dict]] = field(default_factory=dict)
    narrative: list[str] = field(default_factory=list)
    flags: dict[str, int] = field(default_factory=dict)
    phones: dict[str, int] = field(default_factory=dict)


def summary(run: object, listed: int = LISTED) -> Report:
    """The report of a hygiene.Run."""
    changes = audit.field_changes(run.source, run.leads)
    out = Report(totals=run.counts)

    def first(df: DataFrame, by: str, name: str) -> list[dict]:
        rows = [r.asDict(recursive=True) for r in df.orderBy(by).limit(listed + 1).collect()]
        if len(rows) > listed:
            out.more[name] = df.count() - listed
        return rows[:listed]

    out.merges = first(merges(run.log, run.source, run.leads), "survivor_id", "merges")
    aside = set_aside(run.audit, run.source, run.leads)
    out.dropped, out.review = first(aside.filter("kind = 'dropped'"), "id", "dropped"), first(aside.filter("kind = 'review'"), "id", "review")
    out.changed = {r["column"]: {"changed": r.changed, "critical": r.critical} for r in audit.change_summary(changes).orderBy("column").collect()}
    some = audit.change_examples(changes, EXAMPLES).orderBy("column", "k").limit(CELLS).collect()
    for r in some:
        out.examples.setdefault(r["column"], []).append({"id": r.Id, "from": r.before, "to": r.after})
    out.more |= {"cells": n} if (n := sum(c["changed"] for c in out.changed.values()) - len(some)) > 0 else {}
    out.narrative = audit.narrative(changes)
    out.flags = {r.flag: r.n for r in audit.flag_counts(run.audit).collect()}
    if "phone_status" in run.internal.columns:
        out.phones = {r.phone_status: r.n for r in audit.phone_state_counts(run.internal).collect()}
    return out


def lines(r: Report) -> list[str]:
    """The report as text."""
    t = r.totals
    said = [f"{t['leads_in']} leads read, {t['leads_out']} to write back", f"{t['duplicates_merged']} merged, {t['records_dropped']} dropped as tests or junk", f"{t['validation_issues']} problems found, {t['values_normalized']} values brought to their usual form"]
    said += [f"{t['blank_email_kept']} without an e-mail, kept"] * bool(t["blank_email_kept"]) + [f"{t['hitl_records']} wait for a person"] * bool(t["hitl_records"])
    if r.phones:
        said.append("phones: " + ", ".join(f"{n} {k}" for k, n in sorted(r.phones.items())))
    for head, rows in (("merged", [m["line"] for m in r.merges]), ("dropped", [f"{d['id']} {d['name']}".strip() for d in r.dropped])):
        if rows:
            more = r.more.get("merges" if head == "merged" else head)
            said += [f"{head}:", *[f"  {x}" for x in rows]] + [f"  and {more} more"] * bool(more)
    if r.narrative:
        said += ["changed:", *[f"  {x}" for x in r.narrative]]
    elif r.changed:
        said += ["changed:", *[f"  {c}: {n['changed']}" for c, n in r.changed.items()]]
    return said


def slim(r: Report) -> dict:
    """What another program needs to tell about the run: the merges first, no list of all leads."""
    return {"merge_lines": [m["line"] for m in r.merges], "totals": r.totals, "merges": r.merges, "dropped": r.dropped, "critical": r.narrative, "flags": r.flags, "more": r.more}
