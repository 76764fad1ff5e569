"""Gates before writing: invariants, schema, phone states, provenance and baselines, each as a table of violations.

A violation has its rule, the number of rows and a few samples. Samples come from the least value of each of SALTS groups,
so no rule gathers its rows in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from leadloom.functions import domains, fixed_values, phones
from leadloom.functions import sqltext as F
from leadloom.functions.names import is_domain_like
from leadloom.functions.text import bare_digits, cell, normalized_email, raw, reasons, strip_markers

from leadloom.tables import Scratch

from .dedupe import IDENTITY

SAMPLES, SALTS = 5, 64


class GateError(Exception):
    """A gate is closed: nothing may be written."""


def _report(found: DataFrame) -> DataFrame:
    """(rule, detail) rows as (rule, n, samples)."""
    salted = found.groupBy("rule", F.pmod(F.xxhash64("detail"), F.lit(SALTS)).alias("salt")).agg(F.count("*").alias("n"), F.min("detail").alias("detail"))
    return salted.groupBy("rule").agg(F.sum("n").alias("n"), F.slice(F.array_sort(F.collect_list("detail")), 1, SAMPLES).alias("samples"))


def bad_dotted_case(c: Column) -> Column:
    """Whether a word has a small letter after a dot and is neither a domain nor a known form."""
    words = F.transform(F.split(cell(c), r"(?U)\s+"), lambda w: F.regexp_replace(w, r"^[,;:()\[\]\"']+|[,;:()\[\]\"']+$", ""))
    known = [*fixed_values.DOTTED_LOWERCASE]
    return F.exists(words, lambda w: w.rlike(r"\.[a-z]") & ~w.isin(*known) & ~F.regexp_replace(w, r"\.+$", "").isin(*known) & ~is_domain_like(w))


def invariants(df: DataFrame) -> DataFrame:
    """Broken invariants of finished rows: (rule, n, samples)."""
    has = lambda c: c in df.columns
    id_ = cell(F.col("Id")) if has("Id") else F.lit("")
    checks: list[tuple[Column, str, Column]] = []
    for c in ("Phone", "MobilePhone"):
        if has(c):
            checks += [(phones.has_text_marker(F.col(c)), "phone_text_marker", id_), (phones.is_formula(F.col(c)), "phone_formula", id_)]
    if has("Phone") and has("Phone_raw"):
        checks.append((phones.lost_code(F.col("Phone_raw"), F.col("Phone")), "phone_lost_country_code", id_))
    if has("Company"):
        checks.append((bad_dotted_case(F.col("Company")), "company_dotted_case", id_))
    if has("Website"):
        checks.append((domains.is_free_provider_site(F.col("Website")), "website_free_provider", F.concat_ws("=", id_, cell(F.col("Website")))))
    each = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(rule).alias("rule"), d.alias("detail"))) for c, rule, d in checks]))
    found = df.select(F.explode(each).alias("v")).select("v.*") if checks else df.sparkSession.createDataFrame([], "rule string, detail string")
    if has("Email"):
        twice = df.select(normalized_email(F.col("Email")).alias("e")).filter("e <> ''").groupBy("e").count().filter("count > 1")
        found = found.unionByName(twice.select(F.lit("duplicate_email").alias("rule"), F.col("e").alias("detail")))
    return _report(found)


def row_growth(rows_in: DataFrame, rows_out: DataFrame) -> DataFrame:
    counts = rows_in.agg(F.count("*").alias("a")).crossJoin(rows_out.agg(F.count("*").alias("b")))  # one row each
    return counts.filter("b > a").select(F.lit("rows_grew").alias("rule"), (F.col("b") - F.col("a")).alias("n"), F.array(F.concat_ws(" -> ", "a", "b")).alias("samples"))


def absorbed(log: DataFrame) -> DataFrame:
    """(lost, survivor, signals) of each merged Id."""
    own = F.transform(F.filter(F.split(raw(F.col("absorbed_match_signals")), ";"), lambda p: F.contains(p, F.lit(":"))), lambda p: F.struct(cell(F.substring_index(p, ":", 1)).alias("id"), F.filter(F.split(F.regexp_replace(p, "^[^:]*:", ""), r"\|"), lambda s: s != "").alias("s")))
    other = F.transform(F.filter(F.split(raw(F.col("merged_from_ids")), ";"), lambda p: cell(p) != ""), lambda p: F.struct(cell(p).alias("id"), F.filter(F.split(raw(F.col("match_signals_used")), r"\|"), lambda s: s != "").alias("s")))
    rows = log.select(cell(F.col("surviving_lead_id")).alias("survivor"), own.alias("own"), other.alias("other"))
    both = F.concat("own", F.filter("other", lambda x: ~F.exists("own", lambda y: y["id"] == x["id"])))
    return rows.select("survivor", F.explode(both).alias("x")).select(F.col("x.id").alias("lost"), "survivor", F.col("x.s").alias("signals")).filter("lost <> ''")


def traces(ids_in: DataFrame, ids_out: DataFrame, log: DataFrame, dropped: DataFrame) -> DataFrame:
    """(rule, detail) of Ids that vanished without a trace, by weak signals, or into a survivor that vanished as well. All but log: (Id).

    Chains of merges may be of any length: each round doubles how far a link reaches, and no chain has more hops than there are
    links. What is still under way after that goes round in a circle, and dangles as well.
    """
    id_ = lambda d: d.select(cell(F.col("Id")).alias("Id")).filter("Id <> ''").distinct()
    scratch = Scratch(ids_in.sparkSession, "traces")
    ends = scratch.keep(id_(ids_out).unionByName(id_(dropped)).distinct())
    missing = id_(ids_in).join(ends, "Id", "left_anti")
    link = absorbed(log).groupBy("lost").agg(F.max_by(F.struct("survivor", "signals"), F.col("survivor")).alias("x")).select("lost", "x.*")
    traced = scratch.keep(missing.join(link, missing.Id == link.lost, "left"))
    lost = traced.filter("lost IS NULL").select(F.lit("no_paper_trail").alias("rule"), F.col("Id").alias("detail"))
    weak = traced.filter(F.col("lost").isNotNull() & ~F.arrays_overlap("signals", F.array(*[F.lit(s) for s in IDENTITY]))).select(F.lit("weak_identity").alias("rule"), F.col("Id").alias("detail"))
    ends = ends.withColumnRenamed("Id", "end")
    open_ = lambda w: w.join(ends, F.col("at") == F.col("end"), "left_anti")
    walk = scratch.keep(open_(traced.filter("lost IS NOT NULL").select("Id", "survivor", F.col("survivor").alias("at"))))
    dangling = walk.filter("false").select("Id", "survivor")
    if not walk.isEmpty():  # most runs end here
        # steps stop at ends, so that doubling doesn't pass them
        step = scratch.keep(link.select(F.col("lost").alias("l"), F.col("survivor").alias("next")).join(ends, F.col("l") == F.col("end"), "left_anti"))
        links, reach = step.count(), 1
        while reach <= links and not walk.isEmpty():
            ahead = walk.join(step, F.col("at") == F.col("l"), "left")
            dangling = dangling.unionByName(ahead.filter("l IS NULL").select("Id", "survivor"))
            walk = scratch.keep(open_(ahead.filter("l IS NOT NULL").select("Id", "survivor", F.col("next").alias("at"))))
            more = step.withColumnsRenamed({"l": "k", "next": "n"})
            step, reach = scratch.keep(step.join(more, F.col("next") == F.col("k"), "left").select("l", F.coalesce("n", "next").alias("next"))), 2 * reach
        dangling = dangling.unionByName(walk.select("Id", "survivor"))
    chain = dangling.select(F.lit("dangling_survivor").alias("rule"), F.concat_ws("->", "Id", "survivor").alias("detail"))
    return lost.unionByName(weak).unionByName(chain)


def provenance(ids_in: DataFrame, ids_out: DataFrame, log: DataFrame, dropped: DataFrame) -> DataFrame:
    return _report(traces(ids_in, ids_out, log, dropped))


def header_violations(columns: list[str], expected: list[str]) -> list[str]:
    if columns != expected:
        return [f"headers {columns} != {expected}"]
    return [f"header carries quotes: {c}" for c in columns if c[:1] == '"' or c[-1:] == '"']


def schema_violations(df: DataFrame) -> DataFrame:
    """Blank or repeated Ids and websites that aren't http(s): (rule, n, samples)."""
    parts = []
    if "Id" in df.columns:
        ids = df.groupBy(raw(F.col("Id")).alias("detail")).count()
        parts.append(ids.filter("detail = ''").select(F.lit("blank_id").alias("rule"), "detail"))
        parts.append(ids.filter("detail <> '' AND count > 1").select(F.lit("repeated_id").alias("rule"), "detail"))
    if "Website" in df.columns:
        parts.append(df.filter((raw(F.col("Website")) != "") & ~F.col("Website").rlike("^https?://")).select(F.lit("website_scheme").alias("rule"), F.col("Website").alias("detail")))
    out = parts[0] if parts else df.sparkSession.createDataFrame([], "rule string, detail string")
    for p in parts[1:]:
        out = out.unionByName(p)
    return _report(out)


def phone_state_violations(df: DataFrame) -> DataFrame:
    """Phones that are neither valid E.164 nor kept as submitted for review."""
    if "Phone" not in df.columns:
        return _report(df.sparkSession.createDataFrame([], "rule string, detail string"))
    phone, coded = raw(F.col("Phone")), raw(F.col("Phone")).rlike(r"^\+[0-9]")
    if "phone_status" not in df.columns:
        rules = [((phone != "") & ~coded, "not_e164")]
    else:
        status = raw(F.col("phone_status"))
        rules = [((phone != "") & ~status.isin("valid", "needs_review"), "phone_without_state"), ((status == "valid") & ~coded, "valid_but_not_e164")]
        if "Phone_raw" in df.columns:
            rules.append(((phone != "") & (status == "needs_review") & (bare_digits(F.col("Phone_raw")) != "") & (bare_digits(phone) != bare_digits(F.col("Phone_raw"))), "review_value_changed"))
    detail = F.concat_ws("=", raw(F.col("Id")) if "Id" in df.columns else F.lit(""), phone)
    return _report(df.select(F.explode(F.array_compact(F.array(*[F.when(c, F.lit(r)) for c, r in rules]))).alias("rule"), detail.alias("detail")))


def restore_from_source(source: DataFrame, out: DataFrame) -> DataFrame:
    """out with phones that lost their code and valid websites that were blanked put back from the source, by Id."""
    if "Id" not in out.columns or "Id" not in source.columns:
        return out
    for c in ("data_quality_flags", "hitl_review", "phone_status", "change_reasons"):
        out = out if c in out.columns else out.withColumn(c, F.lit(""))
    kept = [c for c in ("Phone", "Website") if c in source.columns and c in out.columns]
    src = source.select(cell(F.col("Id")).alias("_id"), *[F.col(c).alias(f"_{c}") for c in kept]).dropDuplicates(["_id"])
    both = out.join(src, cell(F.col("Id")) == F.col("_id"), "left")
    changes: dict[str, Column] = {}
    reason = cell(F.col("change_reasons"))
    if "Phone" in kept:
        both = both.withColumn("_lost", F.coalesce(phones.lost_code(F.col("_Phone"), F.col("Phone")) & F.col("_id").isNotNull(), F.lit(False)))
        lost, flags = F.col("_lost"), F.filter(F.split(cell(F.col("data_quality_flags")), r"\|"), lambda x: x != "")
        changes |= {"Phone": F.when(lost, cell(F.col("_Phone"))).otherwise(F.col("Phone")), "phone_status": F.when(lost, "needs_review").otherwise(F.col("phone_status")), "hitl_review": F.when(lost, "Yes").otherwise(F.col("hitl_review")), "data_quality_flags": F.when(lost, F.array_join(F.array_union(flags, F.array(F.lit("needs_country_code_review"))), "|")).otherwise(F.col("data_quality_flags"))}
        reason = F.when(lost, reasons(reason, F.lit("phone: restored original; country code would have been dropped"))).otherwise(reason)
    if "Website" in kept:
        both = both.withColumn("_kept", F.when(cell(F.col("Website")) == "", domains.website(F.col("_Website"))))
        changes["Website"] = F.coalesce(F.col("_kept"), F.col("Website"))
        reason = F.when(F.col("_kept").isNotNull(), reasons(reason, F.lit("website: restored existing valid value (lookup must not delete)"))).otherwise(reason)
    return both.withColumns(changes | {"change_reasons": reason}).select(out.columns)


def strip_phone_markers(df: DataFrame) -> DataFrame:
    return df.withColumns({c: strip_markers(F.col(c)) for c in ("Phone", "MobilePhone") if c in df.columns})


def cell_changes(old: DataFrame, new: DataFrame, key: str = "Id", clean: bool = True) -> DataFrame:
    """(key, column, before, after) of cells that differ in rows and columns that both have. clean: compare without blanks' spellings."""
    columns = [c for c in old.columns if c in new.columns and c != key]
    form = cell if clean else (lambda c: raw(c))
    k = cell(F.col(key)) if clean else raw(F.col(key))
    long = lambda d, name: d.select(k.alias(key), F.explode(F.array(*[F.struct(F.lit(c).alias("column"), form(F.col(c)).alias(name)) for c in columns])).alias("x")).select(key, "x.*").filter(F.col(key) != "") if columns else None
    before, after = long(old, "before"), long(new, "after")
    return before.join(after, [key, "column"]).filter("before <> after")


def only_in(one: DataFrame, other: DataFrame, key: str = "Id") -> DataFrame:
    return one.select(raw(F.col(key)).alias(key)).distinct().join(other.select(raw(F.col(key)).alias(key)).distinct(), key, "left_anti")


def frame_report(old: DataFrame, new: DataFrame, key: str = "Id", expected: tuple[str, ...] = ()) -> dict[str, object]:
    """Columns that came and went, counts, and the changes outside the expected columns."""
    changes = cell_changes(old, new, key, clean=False)
    return {"added_columns": [c for c in new.columns if c not in old.columns], "dropped_columns": [c for c in old.columns if c not in new.columns], "rows_old": old.count(), "rows_new": new.count(), "only_in_old": only_in(old, new, key), "only_in_new": only_in(new, old, key), "changes": changes, "unexpected": changes.filter(~F.col("column").isin(*expected)) if expected else changes}


def report_lines(report: dict[str, object], limit: int = 40) -> list[str]:
    """The report as lines for people; lists are cut at limit."""
    unexpected = report["unexpected"]
    lines = [f"rows: {report['rows_old']} -> {report['rows_new']}"]
    lines += [f"{k.replace('_', ' ')}: {', '.join(report[k])}" for k in ("added_columns", "dropped_columns") if report[k]]
    lines += [f"{k.replace('_', ' ')}: {', '.join(r[0] for r in report[k].limit(10).collect())}" for k in ("only_in_old", "only_in_new")]
    n = unexpected.count()
    lines.append(f"unexpected cell changes: {n}")
    return lines + [f"  {r[0]} {r.column}: {r.before!r} -> {r.after!r}" for r in unexpected.orderBy(unexpected.columns[0], "column").limit(limit).collect()] + ([f"  ... {n - limit} more"] if n > limit else [])


def close_gate(*violations: DataFrame, more: list[str] | None = None) -> None:
    """Raise GateError if any table has a row."""
    said = list(more or [])
    for v in violations:
        said += [f"{r.rule}: {r.n} ({', '.join(r.samples)})" for r in v.collect()]
    if said:
        raise GateError("; ".join(said))

