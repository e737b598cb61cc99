"""Data-quality checks: failing rows per check, and one report for many checks.

Semantics follow the declared tests of the reference (dbt built-ins):

* ``not_null(col)`` fails once per NULL row.
* ``unique(col)`` fails once per duplicated non-NULL value.
* ``accepted_values(col, values)`` fails once per distinct value outside the
  list; NULL passes.
* ``unique_combination(cols)`` fails once per duplicated key combination.

Extra expectations (row count range, freshness, missing share, value range,
pattern) use the same report format.

Cost model: all row-level checks of one table run in a *single* aggregation
pass (``count_if`` per check); each uniqueness check is one ``groupBy`` with
map-side partial counts. The report is a union of one-row results, so it never
grows with the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from forgeline.functions.columns import ntz_literal

REPORT_COLUMNS = ["check_name", "table_name", "column_name", "failures"]


@dataclass(frozen=True)
class Check:
    kind: str                    # not_null | unique | accepted_values | unique_combination | extras below
    table: str
    columns: tuple[str, ...]
    values: tuple = field(default=())          # accepted values
    params: tuple = field(default=())          # (min, max) / (as_of, max_age_hours) / (pattern,) ...

    @property
    def column_label(self) -> str:
        return ",".join(self.columns)

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.table}:{self.column_label}"


def not_null(table: str, column: str) -> Check:
    return Check("not_null", table, (column,))


def unique(table: str, column: str) -> Check:
    return Check("unique", table, (column,))


def accepted_values(table: str, column: str, values: Sequence) -> Check:
    return Check("accepted_values", table, (column,), tuple(values))


def unique_combination(table: str, columns: Sequence[str]) -> Check:
    return Check("unique_combination", table, tuple(columns))


def value_between(table: str, column: str, lo, hi) -> Check:
    return Check("value_between", table, (column,), params=(lo, hi))


def matches_pattern(table: str, column: str, pattern: str) -> Check:
    return Check("matches_pattern", table, (column,), params=(pattern,))


def row_count_between(table: str, lo: int, hi: int | None = None) -> Check:
    return Check("row_count_between", table, (), params=(lo, hi))


def missing_share_at_most(table: str, column: str, max_share: float) -> Check:
    return Check("missing_share_at_most", table, (column,), params=(max_share,))


def fresh_within(table: str, column: str, as_of, max_age_hours: float) -> Check:
    return Check("fresh_within", table, (column,), params=(as_of, max_age_hours))


# ------------------------------------------------------------------ failing rows
def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows (or duplicated keys) that make ``check`` fail."""
    cols = list(check.columns)
    if check.kind == "not_null":
        return df.filter(F.col(cols[0]).isNull())
    if check.kind in ("unique", "unique_combination"):
        keyed = df.filter(F.col(cols[0]).isNotNull()) if check.kind == "unique" else df
        return keyed.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")
    if check.kind == "accepted_values":
        c = F.col(cols[0])
        return df.filter(c.isNotNull() & ~c.isin(*check.values))
    if check.kind in ("value_between", "matches_pattern"):
        return df.filter(_row_violation(check))
    raise ValueError(f"no row-level form for {check.kind}")


def _row_violation(check: Check) -> Column:
    c = F.col(check.columns[0]) if check.columns else None
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "value_between":
        lo, hi = check.params
        return c.isNotNull() & ((c < F.lit(lo)) | (c > F.lit(hi)))
    if check.kind == "matches_pattern":
        return c.isNotNull() & ~c.rlike(check.params[0])
    raise ValueError(check.kind)


# ------------------------------------------------------------------ report
def _lit_row(check: Check, failures: Column) -> list[Column]:
    return [F.lit(check.kind).alias("check_name"), F.lit(check.table).alias("table_name"),
            F.lit(check.column_label).alias("column_name"), failures.cast("bigint").alias("failures")]


def _report_struct(check: Check, failures: Column) -> Column:
    return F.struct(*_lit_row(check, failures))


def _table_pass(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All row-level and table-level checks of one table in one aggregation."""
    aggs: list[Column] = [F.count(F.lit(1)).alias("_n")]
    for i, ch in enumerate(checks):
        if ch.kind in ("not_null", "value_between", "matches_pattern"):
            aggs.append(F.count_if(_row_violation(ch)).alias(f"_c{i}"))
        elif ch.kind == "accepted_values":
            c = F.col(ch.columns[0])
            bad = F.when(c.isNotNull() & ~c.isin(*ch.values), c)
            aggs.append(F.count_distinct(bad).alias(f"_c{i}"))
        elif ch.kind == "missing_share_at_most":
            aggs.append(F.count_if(F.col(ch.columns[0]).isNull()).alias(f"_c{i}"))
        elif ch.kind == "fresh_within":
            aggs.append(F.max(ch.columns[0]).alias(f"_c{i}"))
        elif ch.kind == "row_count_between":
            pass
        else:
            raise ValueError(ch.kind)
    one = df.agg(*aggs)
    rows: list[Column] = []
    for i, ch in enumerate(checks):
        if ch.kind == "row_count_between":
            lo, hi = ch.params
            ok = F.col("_n") >= lo
            if hi is not None:
                ok = ok & (F.col("_n") <= hi)
            failures = F.when(ok, 0).otherwise(1)
        elif ch.kind == "missing_share_at_most":
            share = F.when(F.col("_n") == 0, F.lit(0.0)).otherwise(F.col(f"_c{i}") / F.col("_n"))
            failures = F.when(share <= F.lit(ch.params[0]), 0).otherwise(F.col(f"_c{i}"))
        elif ch.kind == "fresh_within":
            as_of, max_age_hours = ch.params
            limit = _age_limit(as_of, max_age_hours)
            failures = F.when(F.col(f"_c{i}").isNotNull() & (F.col(f"_c{i}") >= limit), 0).otherwise(1)
        else:
            failures = F.col(f"_c{i}")
        rows.append(_report_struct(ch, failures))
    # one aggregate row fanned out into one report row per check (no re-aggregation per check)
    return one.select(F.inline(F.array(*rows)))


def _group_check(df: DataFrame, check: Check) -> DataFrame:
    dup = failing_rows(df, check)
    return dup.agg(*_lit_row(check, F.count(F.lit(1))))


def quality_report(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """``(check_name, table_name, column_name, failures)``, one row per check."""
    parts: list[DataFrame] = []
    by_table: dict[str, list[Check]] = {}
    for ch in checks:
        if ch.kind in ("unique", "unique_combination"):
            parts.append(_group_check(tables[ch.table], ch))
        else:
            by_table.setdefault(ch.table, []).append(ch)
    for table, chs in by_table.items():
        parts.append(_table_pass(tables[table], chs))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------------ checks taken during a write
def observed_values(obs: Observation) -> dict:
    """Metrics of a finished observation; empty where Spark proved the input empty and pruned the plan with its metrics."""
    # Observation.get cannot turn a row without values into Python, so the row itself is asked
    return dict(obs.get) if obs._jo.getRow().length() else {}


class Watch:
    """Row-level checks as metrics of the jobs that write: :meth:`on` marks a frame, :meth:`rows` gives the report once those jobs are done.

    A metric counts rows as they pass, so a check that is met is met; after a lost executor a repeated map task can count failing rows twice.
    Uniqueness needs all rows of a key together and is not a metric (:func:`is_row_level`).
    """

    def __init__(self, checks: Sequence[Check]):
        self.checks = [c for c in checks if is_row_level(c)]
        self.watched: dict[str, tuple[Observation, list[Check], DataFrame]] = {}

    def on(self, table: str, df: DataFrame) -> DataFrame:
        own = [c for c in self.checks if c.table == table]
        if not own or table in self.watched:
            return df
        obs = Observation(f"checks_{table}")
        self.watched[table] = obs, own, df
        return df.observe(obs, F.count(F.lit(1)).alias("n"), *[_metric(c).alias(f"c{i}") for i, c in enumerate(own)])

    def rows(self) -> list[tuple]:
        """Report rows of what was written since the last call."""
        out = []
        for obs, checks, df in self.watched.values():
            got = observed_values(obs)
            for i, c in enumerate(checks):
                value = got.get(f"c{i}")
                if c.kind == "accepted_values" and value:
                    # the metric counts rows; only a failing check is counted again, by distinct value
                    value = failing_rows(df, c).select(*c.columns).distinct().count()
                out.append((c.kind, c.table, c.column_label, _failures(c, got.get("n") or 0, value)))
        self.watched.clear()
        return out


def is_row_level(check: Check) -> bool:
    return check.kind not in ("unique", "unique_combination")


def _metric(check: Check) -> Column:
    if check.kind in ("not_null", "value_between", "matches_pattern"):
        return F.count_if(_row_violation(check))
    c = F.col(check.columns[0]) if check.columns else None
    if check.kind == "accepted_values":
        return F.count_if(c.isNotNull() & ~c.isin(*check.values))
    if check.kind == "missing_share_at_most":
        return F.count_if(c.isNull())
    if check.kind == "fresh_within":
        as_of, hours = check.params
        return F.coalesce(F.max(c >= _age_limit(as_of, hours)), F.lit(False)).cast("bigint")
    return F.count(F.lit(1))  # row_count_between


def _failures(check: Check, n: int, value: int | None) -> int:
    if check.kind == "row_count_between":
        lo, hi = check.params
        return int(not (n >= lo and (hi is None or n <= hi)))
    if check.kind == "missing_share_at_most":
        return 0 if n == 0 or (value or 0) / n <= check.params[0] else value
    if check.kind == "fresh_within":
        return int(not value)
    return int(value or 0)


def _age_limit(as_of, max_age_hours: float) -> Column:
    return ntz_literal(as_of) - F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.lit(f"{max_age_hours * 3600:.6f}").cast("decimal(18, 6)"))


REPORT_SCHEMA = "check_name string, table_name string, column_name string, failures bigint"


class QualityGateError(RuntimeError):
    pass


def enforce(report: DataFrame) -> list[tuple]:
    """Gate: raise when any check failed. The report has one row per check,
    so collecting it is bounded by the number of checks, not the data."""
    return enforce_rows(report.collect())


def enforce_rows(rows: Sequence) -> list[tuple]:
    """The gate on an evaluated report; the error names every failed check."""
    failed = [tuple(r) for r in rows if r["failures"] > 0]
    if failed:
        raise QualityGateError(f"{len(failed)} checks failed: {failed}")
    return failed


# ------------------------------------------------------------------ declared checks
def declared_checks() -> list[Check]:
    """The 29 declared checks of sources and models."""
    return [
        # Bronze sources
        not_null("repo_metadata", "full_name"),
        not_null("repo_metadata", "stargazers_count"),
        not_null("repo_metadata", "fetched_at"),
        not_null("issue_or_pr", "repo_full_name"),
        not_null("issue_or_pr", "number"),
        not_null("issue_or_pr", "state"),
        accepted_values("issue_or_pr", "state", ["open", "closed"]),
        not_null("issue_or_pr", "is_pull_request"),
        not_null("commit", "sha"),
        not_null("commit", "repo_full_name"),
        # staging
        not_null("stg_repo_metadata", "repo_full_name"),
        not_null("stg_repo_metadata", "stargazers_count"),
        not_null("stg_repo_metadata", "fetched_at"),
        not_null("stg_issue_or_pr", "repo_full_name"),
        not_null("stg_issue_or_pr", "number"),
        not_null("stg_issue_or_pr", "state"),
        accepted_values("stg_issue_or_pr", "state", ["open", "closed"]),
        not_null("stg_commit", "sha"),
        # silver
        unique("dim_repos", "repo_full_name"),
        not_null("dim_repos", "repo_full_name"),
        not_null("fct_issues", "repo_full_name"),
        not_null("fct_issues", "issue_number"),
        not_null("fct_pull_requests", "pr_number"),
        not_null("fct_commits", "sha"),
        # gold
        not_null("repo_daily_metrics", "repo_full_name"),
        not_null("repo_daily_metrics", "day"),
        unique_combination("repo_daily_metrics", ["repo_full_name", "day"]),
        unique("repo_health_snapshot", "repo_full_name"),
        not_null("repo_health_snapshot", "repo_full_name"),
    ]


def added_checks() -> list[Check]:
    """Uniqueness of the fact grains, which the reference leaves untested."""
    return [
        unique_combination("fct_issues", ["repo_full_name", "issue_number"]),
        unique_combination("fct_pull_requests", ["repo_full_name", "pr_number"]),
        unique_combination("fct_commits", ["repo_full_name", "sha"]),
    ]
