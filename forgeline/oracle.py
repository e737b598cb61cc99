"""DuckDB SQL for every registered query (the correctness oracle).

Each string runs on DuckDB against the driver tables registered as views. The
GitHub-shaped Bronze projection of ``events`` is written once as CTEs; the models on top are
written from each table's grain (newest row per key, tagged acts, conditional counts).
Counts are cast to BIGINT (DuckDB sums are HUGEINT).
"""

from __future__ import annotations

# --------------------------------------------------------------------------- Bronze
_ISO = "strftime({x}, '%Y-%m-%dT%H:%M:%S.%fZ')"


def _iso(x: str) -> str:
    return _ISO.format(x=x)


_BASE = """
ev_base AS (
    SELECT event_id, ts, user_id, event_type, value,
           CAST(json_extract_string(props, '$.k') AS INTEGER) + 100 * CAST(event_id // 4000 AS INTEGER) AS k,
           user_id % 12 + 12 * (event_id // 40000) AS rid,
           'org' || CAST(user_id % 3 AS VARCHAR) || '/repo' || CAST(rid AS VARCHAR) AS repo
    FROM events
)"""

_BRONZE_REPO = f"""
bronze_repo_metadata AS (
    SELECT repo AS full_name,
           'repo' || CAST(rid AS VARCHAR) AS name,
           'org' || CAST(user_id % 3 AS VARCHAR) AS owner_login,
           CASE WHEN k % 10 = 0 THEN NULL
                ELSE 'Project repo' || CAST(rid AS VARCHAR) || ' rev ' || CAST(k AS VARCHAR) END AS description,
           CAST(k * 10 AS BIGINT) AS stargazers_count,
           CAST(k AS BIGINT) AS forks_count,
           CAST(k % 17 AS BIGINT) AS open_issues_count,
           CAST(k * 10 AS BIGINT) AS watchers_count,
           CAST(user_id % 50 AS BIGINT) AS subscribers_count,
           CAST(k + user_id % 50 AS BIGINT) AS network_count,
           CASE WHEN k % 5 = 0 THEN 'master' ELSE 'main' END AS default_branch,
           CASE WHEN k % 4 = 0 THEN 'Python' WHEN k % 4 = 1 THEN 'Rust' WHEN k % 4 = 2 THEN 'Go' END AS language,
           CASE WHEN k % 3 = 1 THEN 'MIT' WHEN k % 3 = 2 THEN 'Apache-2.0' END AS license_spdx,
           (k % 13 = 0) AS archived,
           FALSE AS disabled,
           (k % 9 = 0) AS fork,
           '2019-0' || CAST(user_id % 9 + 1 AS VARCHAR) || '-15T08:00:00Z' AS created_at,
           {_iso('ts')} AS updated_at,
           CASE WHEN k % 8 = 0 THEN NULL ELSE {_iso('ts - to_hours(k % 5)')} END AS pushed_at,
           {_iso('ts')} AS fetched_at,
           '{{"id":' || CAST(event_id AS VARCHAR) || ',"full_name":"' || repo
               || '","stargazers_count":' || CAST(k * 10 AS VARCHAR) || '}}' AS raw_payload,
           event_id AS ingest_seq
    FROM ev_base WHERE event_type IN ('view')
)"""

_BRONZE_ISSUE = f"""
bronze_issue_or_pr AS (
    SELECT repo AS repo_full_name,
           CAST(k AS BIGINT) AS number,
           CASE WHEN value >= 100 THEN 'closed' ELSE 'open' END AS state,
           'Item ' || CAST(k AS VARCHAR) || ' of ' || repo || CASE WHEN k % 4 = 1 THEN ' révisé 修正' ELSE '' END AS title,
           CASE WHEN user_id % 10 = 0 THEN NULL ELSE 'user' || CAST(user_id AS VARCHAR) END AS user_login,
           event_type IN ('signup', 'purchase') AS is_pull_request,
           (k % 19 = 0) AS locked,
           CASE WHEN k % 3 = 0 THEN []::VARCHAR[] WHEN k % 3 = 1 THEN ['bug'] ELSE ['bug', 'enhancement'] END AS labels,
           CASE WHEN k % 4 = 0 THEN ['user' || CAST(user_id AS VARCHAR)] ELSE []::VARCHAR[] END AS assignees,
           CAST(k % 23 AS BIGINT) AS comments,
           {_iso('ts')} AS created_at,
           {_iso('ts + to_hours(k % 6)')} AS updated_at,
           CASE WHEN value >= 100 THEN {_iso('ts + to_hours(12)')} END AS closed_at,
           {_iso('ts')} AS fetched_at,
           '{{"id":' || CAST(event_id AS VARCHAR) || ',"number":' || CAST(k AS VARCHAR)
               || ',"type":"' || event_type || '"}}' AS raw_payload,
           event_id AS ingest_seq
    FROM ev_base WHERE event_type IN ('click', 'signup', 'purchase')
)"""

_BRONZE_COMMIT = f"""
bronze_commit AS (
    SELECT repo AS repo_full_name,
           md5(CAST(k AS VARCHAR)) AS sha,
           'Change ' || CAST(k AS VARCHAR) || ' in ' || repo AS message,
           CASE WHEN k % 7 = 0 THEN NULL ELSE 'user' || CAST(user_id AS VARCHAR) END AS author_login,
           'user' || CAST(user_id AS VARCHAR) || '@example.com' AS author_email,
           {_iso('ts - to_hours(1)')} AS authored_date,
           CASE WHEN k % 2 = 0 THEN 'web-flow' ELSE 'user' || CAST(user_id AS VARCHAR) END AS committer_login,
           CASE WHEN k % 2 = 0 THEN 'noreply@example.com'
                ELSE 'user' || CAST(user_id AS VARCHAR) || '@example.com' END AS committer_email,
           CASE WHEN k % 11 = 0 THEN NULL ELSE {_iso('ts')} END AS committed_date,
           CASE WHEN k % 10 = 0 THEN [md5(CAST(k + 100 AS VARCHAR)), md5(CAST(k + 200 AS VARCHAR))]
                ELSE [md5(CAST(k + 100 AS VARCHAR))] END AS parents,
           {_iso('ts')} AS fetched_at,
           '{{"id":' || CAST(event_id AS VARCHAR) || ',"sha":"' || md5(CAST(k AS VARCHAR)) || '"}}' AS raw_payload,
           event_id AS ingest_seq
    FROM ev_base WHERE event_type IN ('error')
)"""

# --------------------------------------------------------------------------- models
# Written from the grain of each table. ``p`` prefixes all names, so that a second
# chain over other Bronze rows can stand in the same statement.
def _staging(p: str = "") -> str:
    """Typed Bronze: ISO texts become timestamps, the other columns keep their contract names."""
    stamp = lambda *cols: ", ".join(f"{c}::TIMESTAMP AS {c}" for c in cols)
    return f"""
{p}stg_repo_metadata AS (
    SELECT * EXCLUDE (full_name, name) REPLACE ({stamp("created_at", "updated_at", "pushed_at", "fetched_at")}),
           full_name AS repo_full_name, name AS repo_name
    FROM {p}bronze_repo_metadata),
{p}stg_issue_or_pr AS (
    SELECT * REPLACE ({stamp("created_at", "updated_at", "closed_at", "fetched_at")}) FROM {p}bronze_issue_or_pr),
{p}stg_commit AS (
    SELECT * REPLACE ({stamp("authored_date", "committed_date", "fetched_at")}) FROM {p}bronze_commit)"""


def _current(p: str = "") -> str:
    """The newest landed version of every repository, item and commit (``arg_max`` of the whole row)."""
    newest = "(fetched_at, ingest_seq)"
    item = "v.state, v.title, v.user_login AS author_login"
    times = "v.labels, v.assignees, v.comments, v.created_at, v.updated_at, v.closed_at, v.fetched_at"
    return f"""
{p}repo_now AS (
    SELECT repo_full_name, arg_max(r, {newest}) AS v FROM {p}stg_repo_metadata r GROUP BY repo_full_name),
{p}item_now AS (
    SELECT repo_full_name, number, is_pull_request, arg_max(r, {newest}) AS v
    FROM {p}stg_issue_or_pr r GROUP BY ALL),
{p}commit_now AS (
    SELECT repo_full_name, sha, arg_max(r, {newest}) AS v FROM {p}stg_commit r GROUP BY repo_full_name, sha),
{p}dim_repos AS (
    SELECT repo_full_name, v.repo_name, v.owner_login, v.description, v.stargazers_count, v.forks_count,
           v.open_issues_count, v.watchers_count, v.default_branch, v.language, v.license_spdx, v.archived, v.disabled,
           v.fork AS is_fork, v.created_at AS repo_created_at, v.updated_at AS repo_updated_at,
           v.pushed_at AS last_pushed_at, v.fetched_at AS snapshot_at
    FROM {p}repo_now),
{p}fct_issues AS (
    SELECT repo_full_name, number AS issue_number, {item}, v.locked, {times} FROM {p}item_now WHERE NOT is_pull_request),
{p}fct_pull_requests AS (
    SELECT repo_full_name, number AS pr_number, {item}, {times} FROM {p}item_now WHERE is_pull_request),
{p}fct_commits AS (
    SELECT repo_full_name, sha, v.message, v.author_login, v.author_email, v.authored_date, v.committer_login,
           v.committer_email, v.committed_date, len(v.parents)::INTEGER AS parent_count, v.fetched_at
    FROM {p}commit_now)"""


def _measured(p: str = "") -> str:
    """Every act (issue, PR, dated commit) as one tagged row, and the daily counts of those rows."""
    return f"""
{p}acts AS (
    SELECT repo_full_name, number AS nr, CASE WHEN is_pull_request THEN 'P' ELSE 'I' END AS what, v.created_at AS happened,
           CASE WHEN is_pull_request THEN v.state = 'closed' ELSE v.closed_at::DATE = v.created_at::DATE END AS done,
           NULL::VARCHAR AS who
    FROM {p}item_now WHERE is_pull_request IS NOT NULL
    UNION ALL
    SELECT repo_full_name, NULL, 'C', v.committed_date, NULL, v.author_login
    FROM {p}commit_now WHERE v.committed_date IS NOT NULL),
{p}repo_daily_metrics AS (
    SELECT repo_full_name, happened::DATE AS day,
           count(*) FILTER (WHERE what = 'I')::BIGINT AS issues_opened, count(*) FILTER (WHERE what = 'I' AND done)::BIGINT AS issues_closed_same_day,
           count(*) FILTER (WHERE what = 'P')::BIGINT AS prs_opened, count(*) FILTER (WHERE what = 'P' AND done)::BIGINT AS prs_closed,
           count(*) FILTER (WHERE what = 'C')::BIGINT AS commits, count(DISTINCT who)::BIGINT AS distinct_authors
    FROM {p}acts GROUP BY ALL)"""


def _health(as_of: str = "2024-01-31", p: str = "") -> str:
    """Repositories with the counts of their acts in the 28 days before ``as_of`` (and after)."""
    count = lambda what: f"count(what) FILTER (what = '{what}')::BIGINT"
    return f"""
{p}lately AS (
    SELECT d.repo_full_name, {count("C")} AS recent_commits_28d, {count("P")} AS recent_prs_28d,
           {count("I")} AS recent_issues_28d, count(DISTINCT who)::BIGINT AS recent_authors_28d
    FROM {p}dim_repos d LEFT JOIN {p}acts a
      ON a.repo_full_name = d.repo_full_name AND a.happened >= DATE '{as_of}' - 28
    GROUP BY d.repo_full_name),
{p}repo_health_snapshot AS (
    SELECT repo_full_name, repo_name, owner_login, description, language, license_spdx, stargazers_count, forks_count,
           open_issues_count, watchers_count, last_pushed_at, recent_commits_28d, recent_prs_28d, recent_issues_28d,
           recent_authors_28d, snapshot_at
    FROM {p}dim_repos JOIN {p}lately USING (repo_full_name))"""


def _earlier(cut: str, as_of: str, p: str = "p_") -> str:
    """A second chain over the records that landed before ``cut``."""
    bronze = ",".join(f"\n{p}bronze_{k} AS (SELECT * FROM bronze_{k} WHERE fetched_at::TIMESTAMP < TIMESTAMP '{cut}')"
                      for k in ("repo_metadata", "issue_or_pr", "commit"))
    return ",".join([bronze, _staging(p), _current(p), _measured(p), _health(as_of, p)])


def with_models(select: str, extra_ctes: str = "", as_of: str = "2024-01-31") -> str:
    """Full CTE chain (Bronze projection .. gold) followed by ``select``."""
    ctes = [_BASE, _BRONZE_REPO, _BRONZE_ISSUE, _BRONZE_COMMIT, _staging(), _current(), _measured(), _health(as_of)]
    if extra_ctes:
        ctes.append(extra_ctes)
    return "WITH " + ",".join(ctes) + "\n" + select


def model_sql() -> dict[str, str]:
    """Oracles of the staging, silver and gold models."""
    q = {}
    for name in ("stg_repo_metadata", "stg_issue_or_pr", "stg_commit",
                 "dim_repos", "fct_issues", "fct_pull_requests", "fct_commits",
                 "repo_daily_metrics", "repo_health_snapshot"):
        q[name] = with_models(f"SELECT * FROM {name}")
    q["repo_daily_metrics_joined"] = q["repo_daily_metrics"]
    q["activity_spine"] = with_models("SELECT DISTINCT repo_full_name, happened::DATE AS day FROM acts")
    return q


# --------------------------------------------------------------------------- serving
TARGET_REPOS_TEXT = " org0/repo0, ,org1/repo1 ,  org2/repo5,"
SINCE = "2024-01-24 00:00:00"


def serving_sql() -> dict[str, str]:
    top5 = """top5 AS (
    SELECT repo_full_name, stargazers_count,
           row_number() OVER (ORDER BY stargazers_count DESC NULLS LAST, repo_full_name) AS star_rank
    FROM repo_health_snapshot ORDER BY star_rank LIMIT 5
)"""
    series = """
SELECT repo_full_name, day, 'commits' AS metric, commits AS count FROM sel
UNION ALL SELECT repo_full_name, day, 'prs_opened', prs_opened FROM sel
UNION ALL SELECT repo_full_name, day, 'issues_opened', issues_opened FROM sel"""
    targets = ", ".join(f"'{t.strip()}'" for t in TARGET_REPOS_TEXT.split(",") if t.strip())
    return {
        "dashboard_kpis": with_models("""
SELECT CAST(count(*) AS BIGINT) AS repos_tracked, CAST(sum(stargazers_count) AS BIGINT) AS total_stars,
       CAST(sum(recent_commits_28d) AS BIGINT) AS recent_commits_28d,
       CAST(sum(recent_prs_28d) AS BIGINT) AS recent_prs_28d
FROM repo_health_snapshot"""),
        "top_repos": with_models("SELECT * FROM top5", top5),
        "activity_series": with_models(series, top5 + """,
sel AS (SELECT repo_full_name, day, commits, prs_opened, issues_opened FROM repo_daily_metrics
        WHERE repo_full_name IN (SELECT repo_full_name FROM top5))"""),
        "target_repo_filter": with_models(series, f"""
sel AS (SELECT repo_full_name, day, commits, prs_opened, issues_opened FROM repo_daily_metrics
        WHERE repo_full_name IN ({targets}))"""),
        "since_filter": with_models(f"""
SELECT repo_full_name, number, state, is_pull_request, updated_at, ingest_seq
FROM stg_issue_or_pr WHERE updated_at >= TIMESTAMP '{SINCE}'"""),
        "json_field_extract": with_models("""
SELECT repo_full_name, ingest_seq, stargazers_count,
       CAST(json_extract_string(raw_payload, '$.stargazers_count') AS BIGINT) AS payload_stars,
       CAST(json_extract_string(raw_payload, '$.id') AS BIGINT) AS payload_id,
       json_extract_string(raw_payload, '$.missing.key') AS payload_missing
FROM stg_repo_metadata"""),
    }


def sketch_sql() -> str:
    """Exact distinct authors of 28 days; the estimate must be within its error everywhere."""
    return with_models("SELECT repo_full_name, recent_authors_28d, true AS within_error FROM repo_health_snapshot WHERE recent_authors_28d > 0")


#: Which repositories of the target table are enabled.
TARGET_ENABLED = "stargazers_count % 4 <> 0 OR repo_full_name LIKE '%1'"


def targets_pruned_sql() -> str:
    return with_models(f"""SELECT repo_full_name, state, count(*)::BIGINT AS records FROM bronze_issue_or_pr
WHERE repo_full_name IN (SELECT repo_full_name FROM dim_repos WHERE {TARGET_ENABLED}) GROUP BY ALL""")


# --------------------------------------------------------------------------- quality
_BRONZE_CTE = {"repo_metadata": "bronze_repo_metadata", "issue_or_pr": "bronze_issue_or_pr",
               "commit": "bronze_commit"}


def _sql_lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def check_sql(ch) -> str:
    """DuckDB form of one check, as one report row."""
    t = _BRONZE_CTE.get(ch.table, ch.table)
    head = f"SELECT '{ch.kind}' AS check_name, '{ch.table}' AS table_name, '{ch.column_label}' AS column_name"
    c = ch.columns[0] if ch.columns else None
    if ch.kind == "not_null":
        return f"{head}, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {t}"
    if ch.kind == "accepted_values":
        vals = ", ".join(_sql_lit(v) for v in ch.values)
        return (f"{head}, CAST(count(DISTINCT CASE WHEN {c} IS NOT NULL AND {c} NOT IN ({vals}) THEN {c} END)"
                f" AS BIGINT) AS failures FROM {t}")
    if ch.kind in ("unique", "unique_combination"):
        cols = ", ".join(ch.columns)
        where = f"WHERE {c} IS NOT NULL" if ch.kind == "unique" else ""
        return (f"{head}, CAST(count(*) AS BIGINT) AS failures FROM "
                f"(SELECT {cols} FROM {t} {where} GROUP BY {cols} HAVING count(*) > 1) d")
    if ch.kind == "value_between":
        lo, hi = ch.params
        return (f"{head}, CAST(count(*) FILTER (WHERE {c} IS NOT NULL AND ({c} < {_sql_lit(lo)} OR {c} > "
                f"{_sql_lit(hi)})) AS BIGINT) AS failures FROM {t}")
    if ch.kind == "matches_pattern":
        return (f"{head}, CAST(count(*) FILTER (WHERE {c} IS NOT NULL AND NOT regexp_matches({c}, "
                f"{_sql_lit(ch.params[0])})) AS BIGINT) AS failures FROM {t}")
    if ch.kind == "row_count_between":
        lo, hi = ch.params
        cond = f"count(*) >= {lo}" + (f" AND count(*) <= {hi}" if hi is not None else "")
        return f"{head}, CAST(CASE WHEN {cond} THEN 0 ELSE 1 END AS BIGINT) AS failures FROM {t}"
    if ch.kind == "missing_share_at_most":
        nulls = f"count(*) FILTER (WHERE {c} IS NULL)"
        share = f"CASE WHEN count(*) = 0 THEN 0.0 ELSE {nulls} / count(*) END"
        return (f"{head}, CAST(CASE WHEN {share} <= {ch.params[0]} THEN 0 ELSE {nulls} END AS BIGINT)"
                f" AS failures FROM {t}")
    if ch.kind == "fresh_within":
        as_of, hours = ch.params
        return (f"{head}, CAST(CASE WHEN max({c}) IS NOT NULL AND max({c}) >= TIMESTAMP '{as_of}' - "
                f"to_microseconds({round(hours * 3_600_000_000)}) THEN 0 ELSE 1 END AS BIGINT) AS failures FROM {t}")
    raise ValueError(ch.kind)


def report_sql(checks) -> str:
    return with_models("\nUNION ALL\n".join(check_sql(ch) for ch in checks))


# --------------------------------------------------------------------------- landing
def _landing_ctes(kind: str) -> str:
    from forgeline.sources.fixtures import ITEM_SQL, KIND_EVENT_TYPES, PAGE_SIZE
    types = ", ".join(f"'{t}'" for t in KIND_EVENT_TYPES[kind])
    return f"""WITH {_BASE.strip()},
lb AS (
    SELECT *, {_iso('ts')} AS iso_ts, {_iso('ts + to_hours(k % 6)')} AS iso_upd,
           {_iso('ts + to_hours(12)')} AS iso_closed, {_iso('ts - to_hours(1)')} AS iso_auth,
           {_iso('ts - to_hours(k % 5)')} AS iso_push,
           {_iso(f'max(ts) OVER (PARTITION BY repo, event_id // {PAGE_SIZE})')} AS page_fetched_at
    FROM ev_base WHERE event_type IN ({types})
),
items AS (SELECT *, {ITEM_SQL[kind]} AS item FROM lb)
"""


def landing_sql() -> dict[str, str]:
    issue = _landing_ctes("issue_or_pr") + """
SELECT repo AS repo_full_name, CAST(k AS BIGINT) AS number,
       CASE WHEN value >= 100 THEN 'closed' ELSE 'open' END AS state,
       'Item ' || CAST(k AS VARCHAR) || ' of ' || repo AS title,
       CASE WHEN user_id % 10 = 0 THEN NULL ELSE 'user' || CAST(user_id AS VARCHAR) END AS user_login,
       event_type IN ('signup', 'purchase') AS is_pull_request,
       CASE WHEN k % 5 = 1 THEN false ELSE k % 19 = 0 END AS locked,
       CASE WHEN k % 3 = 0 THEN []::VARCHAR[] WHEN k % 3 = 1 THEN ['bug'] ELSE ['bug', 'enhancement'] END AS labels,
       CASE WHEN k % 4 = 0 THEN ['user' || CAST(user_id AS VARCHAR)] ELSE []::VARCHAR[] END AS assignees,
       CAST(k % 23 AS BIGINT) AS comments,
       iso_ts AS created_at, iso_upd AS updated_at,
       CASE WHEN value >= 100 THEN iso_closed END AS closed_at,
       page_fetched_at AS fetched_at, item AS raw_payload
FROM items WHERE NOT (event_id % 41 = 0 OR event_id % 53 = 0)"""
    commit = _landing_ctes("commit") + """
SELECT repo AS repo_full_name, md5(CAST(k AS VARCHAR)) AS sha,
       'Change ' || CAST(k AS VARCHAR) || ' in ' || repo || ' — fix' AS message,
       CASE WHEN k % 7 = 0 THEN NULL ELSE 'user' || CAST(user_id AS VARCHAR) END AS author_login,
       'user' || CAST(user_id AS VARCHAR) || '@example.com' AS author_email,
       iso_auth AS authored_date,
       CASE WHEN k % 2 = 0 THEN 'web-flow' ELSE 'user' || CAST(user_id AS VARCHAR) END AS committer_login,
       CASE WHEN k % 11 = 0 THEN NULL WHEN k % 2 = 0 THEN 'noreply@example.com'
            ELSE 'user' || CAST(user_id AS VARCHAR) || '@example.com' END AS committer_email,
       CASE WHEN k % 11 = 0 THEN NULL ELSE iso_ts END AS committed_date,
       CASE WHEN k % 10 = 0 THEN [md5(CAST(k + 100 AS VARCHAR)), md5(CAST(k + 200 AS VARCHAR))]
            WHEN k % 10 = 5 THEN []::VARCHAR[] ELSE [md5(CAST(k + 100 AS VARCHAR))] END AS parents,
       page_fetched_at AS fetched_at, item AS raw_payload
FROM items WHERE NOT (event_id % 37 = 0 OR event_id % 31 = 0)"""
    repo = _landing_ctes("repo_metadata") + """
SELECT repo AS full_name, 'repo' || CAST(rid AS VARCHAR) AS name,
       'org' || CAST(user_id % 3 AS VARCHAR) AS owner_login,
       CASE WHEN k % 6 = 0 OR k % 10 = 0 THEN NULL
            ELSE 'Dépôt repo' || CAST(rid AS VARCHAR) || ' rév ' || CAST(k AS VARCHAR) END AS description,
       CAST(CASE WHEN k % 6 = 0 THEN 0 ELSE k * 10 END AS BIGINT) AS stargazers_count,
       CAST(CASE WHEN k % 6 = 0 THEN 0 ELSE k END AS BIGINT) AS forks_count,
       CAST(CASE WHEN k % 6 = 0 THEN 0 ELSE k % 17 END AS BIGINT) AS open_issues_count,
       CAST(CASE WHEN k % 6 = 0 THEN 0 ELSE k * 10 END AS BIGINT) AS watchers_count,
       CAST(CASE WHEN k % 6 = 0 THEN 0 ELSE user_id % 50 END AS BIGINT) AS subscribers_count,
       CAST(CASE WHEN k % 6 = 0 THEN 0 ELSE k + user_id % 50 END AS BIGINT) AS network_count,
       CASE WHEN k % 6 <> 0 AND k % 5 = 0 THEN 'master' ELSE 'main' END AS default_branch,
       CASE WHEN k % 6 = 0 THEN NULL WHEN k % 4 = 0 THEN 'Python' WHEN k % 4 = 1 THEN 'Rust'
            WHEN k % 4 = 2 THEN 'Go' END AS language,
       CASE WHEN k % 6 = 0 OR k % 3 = 0 THEN NULL WHEN k % 3 = 1 THEN 'MIT' ELSE 'Apache-2.0' END AS license_spdx,
       (k % 6 <> 0 AND k % 13 = 0) AS archived, false AS disabled, (k % 6 <> 0 AND k % 9 = 0) AS fork,
       CASE WHEN k % 6 = 0 THEN NULL ELSE '2019-0' || CAST(user_id % 9 + 1 AS VARCHAR) || '-15T08:00:00Z' END
           AS created_at,
       CASE WHEN k % 6 = 0 THEN NULL ELSE iso_ts END AS updated_at,
       CASE WHEN k % 6 = 0 OR k % 8 = 0 THEN NULL ELSE iso_push END AS pushed_at,
       page_fetched_at AS fetched_at, item AS raw_payload
FROM items WHERE NOT (event_id % 43 = 0 OR (k % 6 <> 0 AND event_id % 47 = 0))"""
    rejects = []
    for kind, reasons in (
        ("issue_or_pr", "CASE WHEN event_id % 41 = 0 THEN 'missing:title' END, "
                        "CASE WHEN event_id % 53 = 0 THEN 'null:comments' END"),
        ("commit", "CASE WHEN event_id % 37 = 0 THEN 'missing:sha' END, "
                   "CASE WHEN event_id % 31 = 0 THEN 'null:commit.message' END"),
        ("repo_metadata", "CASE WHEN event_id % 43 = 0 THEN 'missing:owner' END, "
                          "CASE WHEN k % 6 <> 0 AND event_id % 47 = 0 THEN 'null:stargazers_count' END"),
    ):
        rejects.append(f"""SELECT * FROM (
{_landing_ctes(kind)}
SELECT '{kind}' AS kind, repo AS repo_full_name, item AS raw_payload, concat_ws(';', {reasons}) AS reason
FROM items) r{len(rejects)} WHERE reason <> ''""")
    return {"landing_parse_issue": issue, "landing_parse_commit": commit, "landing_parse_repo": repo,
            "landing_rejects": "\nUNION ALL\n".join(rejects)}


#: An item's text with white space between tokens, in both engines' SQL.
SPACED_ITEM = "'{{  ' || substring({0}, 2, length({0}) - 2) || ' }}'"


def landed_lines_sql() -> str:
    """Items as they landed, line by line."""
    return f"""SELECT repo_full_name, number, title, {SPACED_ITEM.format('raw_payload')} AS raw_payload
FROM ({landing_sql()['landing_parse_issue']}) x"""


def pages_to_daily_sql() -> str:
    """Daily metrics over the parsed items of all landed pages; ties at one instant go by the item's MD5."""
    parsed = landing_sql()
    seq = "CAST('0x' || substr(md5(raw_payload), 1, 15) AS BIGINT) AS ingest_seq"
    bronze = ",\n".join(f"bronze_{kind} AS (SELECT *, {seq} FROM ({parsed[name]}) x)" for kind, name in (
        ("repo_metadata", "landing_parse_repo"), ("issue_or_pr", "landing_parse_issue"), ("commit", "landing_parse_commit")))
    return f"WITH {bronze},{_staging()},{_current()},{_measured()}\nSELECT * FROM repo_daily_metrics"


def page_rejects_sql() -> str:
    """Per repository: records, rejected items and rejected pages, when some pages arrive damaged."""
    from forgeline.sources.fixtures import DAMAGED_PAGES, PAGE_SIZE
    bad = " OR ".join(cond for cond, _ in DAMAGED_PAGES)
    return _landing_ctes("issue_or_pr") + f""",
paged AS (SELECT *, ({bad}) AS lost, event_id % 41 = 0 OR event_id % 53 = 0 AS refused
          FROM (SELECT *, event_id // {PAGE_SIZE} AS page_no FROM items) i)
SELECT repo AS repo_full_name, count(*) FILTER (WHERE NOT lost AND NOT refused)::BIGINT AS records,
       count(*) FILTER (WHERE NOT lost AND refused)::BIGINT AS rejected_items,
       count(DISTINCT page_no) FILTER (WHERE lost)::BIGINT AS rejected_pages
FROM paged GROUP BY repo"""


def bronze_roundtrip_sql(run_id: str) -> str:
    return f"""WITH {_BASE.strip()}, {_BRONZE_ISSUE.strip()}
SELECT *, '{run_id}' AS run_id, split_part(repo_full_name, '/', 1) AS owner,
       split_part(repo_full_name, '/', 2) AS repo,
       CAST(year(CAST(fetched_at AS TIMESTAMP)) AS INTEGER) AS year,
       CAST(month(CAST(fetched_at AS TIMESTAMP)) AS INTEGER) AS month,
       CAST(day(CAST(fetched_at AS TIMESTAMP)) AS INTEGER) AS day
FROM bronze_issue_or_pr"""


# --------------------------------------------------------------------------- upsert
def upsert_sql(cut: str, as_of: str, ops: tuple[str, ...] = ()) -> str:
    """Previous mart = health over records landed before ``cut`` as of ``as_of``, without repositories ending in 3
    (new), those ending in 7 as they are now (unchanged); those ending in 4 are not in the fresh rows (retained)."""
    cols = ["repo_name", "owner_login", "description", "language", "license_spdx", "stargazers_count",
            "forks_count", "open_issues_count", "watchers_count", "last_pushed_at", "recent_commits_28d",
            "recent_prs_28d", "recent_issues_28d", "recent_authors_28d", "snapshot_at"]
    picked = ",\n       ".join(f"CASE WHEN n.repo_full_name IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}"
                               for c in cols)
    same = " AND ".join(f"n.{c} IS NOT DISTINCT FROM o.{c}" for c in cols)
    select = f"""
SELECT coalesce(n.repo_full_name, o.repo_full_name) AS repo_full_name,
       {picked},
       CASE WHEN o.repo_full_name IS NULL THEN 'insert'
            WHEN n.repo_full_name IS NULL THEN 'retained'
            WHEN {same} THEN 'unchanged' ELSE 'update' END AS change_op
FROM fresh n FULL OUTER JOIN mart o ON n.repo_full_name = o.repo_full_name"""
    if ops:
        select = f"SELECT * FROM ({select}) m WHERE change_op IN ({', '.join(repr(x) for x in ops)})"
    return with_models(select, _earlier(cut, as_of) + """,
fresh AS (SELECT * FROM repo_health_snapshot WHERE repo_full_name NOT LIKE '%4'),
mart AS (SELECT * FROM p_repo_health_snapshot WHERE NOT regexp_matches(repo_full_name, '[37]$')
         UNION ALL BY NAME SELECT * FROM repo_health_snapshot WHERE repo_full_name LIKE '%7')""")


# --------------------------------------------------------------------------- streaming
def stream_counts_sql(delay: str) -> str:
    """Closed windows only: a day is emitted once ``day + 1 day <= max(ts) - delay``."""
    n, unit = delay.split()
    return f"""WITH {_BASE.strip()},
r AS (SELECT repo AS repo_full_name,
             CASE WHEN event_type = 'view' THEN 'repo_metadata' WHEN event_type = 'error' THEN 'commit'
                  ELSE 'issue_or_pr' END AS kind,
             ts FROM ev_base),
wm AS (SELECT max(ts) - INTERVAL {n} {unit} AS watermark FROM r)
SELECT repo_full_name, kind, CAST(ts AS DATE) AS day,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) AS window_start,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY AS window_end,
       CAST(count(*) AS BIGINT) AS records
FROM r
WHERE CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT watermark FROM wm)
GROUP BY ALL"""


def stream_dedup_sql(delay: str) -> str:
    return f"SELECT * EXCLUDE (day) FROM ({stream_counts_sql(delay)}) c"


def stream_late_sql(delay: str, cuts: tuple[str, str], late: str) -> str:
    """Events come in three batches by time, the late ones with the last; a row is late if its day ended by the watermark of the batches before."""
    n, unit = delay.split()
    return f"""WITH {_BASE.strip()},
r AS (SELECT repo AS repo_full_name,
             CASE WHEN event_type = 'view' THEN 'repo_metadata' WHEN event_type = 'error' THEN 'commit'
                  ELSE 'issue_or_pr' END AS kind,
             CASE WHEN {late} THEN 2 WHEN ts < TIMESTAMP '{cuts[0]}' THEN 0 WHEN ts < TIMESTAMP '{cuts[1]}' THEN 1 ELSE 2 END AS batch,
             ts, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS window_start
      FROM ev_base),
before AS (SELECT b AS batch, (SELECT max(ts) FROM r WHERE r.batch < b) - INTERVAL {n} {unit} AS watermark FROM range(4) t(b)),
placed AS (SELECT *, window_start + INTERVAL 1 DAY AS window_end, coalesce(window_start + INTERVAL 1 DAY <= watermark, false) AS is_late
           FROM r JOIN before USING (batch))
SELECT repo_full_name, kind, window_start, window_end, count(*) FILTER (WHERE NOT is_late)::BIGINT AS records,
       count(*) FILTER (WHERE is_late)::BIGINT AS late_records,
       window_end <= (SELECT watermark FROM before WHERE batch = 3) AS closed
FROM placed GROUP BY ALL"""


def stream_latest_sql() -> str:
    cols = ", ".join(f"v.{c}" for c in ("state", "title", "user_login", "created_at", "closed_at", "fetched_at", "ingest_seq"))
    return with_models(f"SELECT repo_full_name, number, is_pull_request, {cols} FROM item_now")


def rebuilt_sql(cut: str, as_of: str) -> str:
    """Daily metrics of a build on the records landed before ``cut`` only."""
    return with_models("SELECT * FROM p_repo_daily_metrics", _earlier(cut, as_of))


# --------------------------------------------------------------------------- features
def anomaly_sql(window: int = 28, min_history: int = 7, threshold: float = 3.0) -> str:
    metrics = ("commits", "prs_opened", "issues_opened")
    longs = "\nUNION ALL ".join(f"SELECT repo_full_name, day, '{m}' AS metric, {m} AS value FROM filled"
                                for m in metrics)
    frame = f"(PARTITION BY repo_full_name, metric ORDER BY day ROWS BETWEEN {window} PRECEDING AND 1 PRECEDING)"
    return with_models(f"""
SELECT repo_full_name, day, metric, value, history_days,
       round(mean, 6) AS baseline_mean, round(std, 6) AS baseline_std,
       round(CASE WHEN history_days >= {min_history} AND std > 0 THEN (value - mean) / std END, 6) AS z_score,
       coalesce(abs(CASE WHEN history_days >= {min_history} AND std > 0 THEN (value - mean) / std END)
                >= {threshold}, false) AS is_anomaly
FROM (SELECT *, CAST(count(value) OVER w AS BIGINT) AS history_days, avg(value) OVER w AS mean,
             stddev_samp(value) OVER w AS std
      FROM long WINDOW w AS {frame}) s""", f"""
span AS (SELECT repo_full_name, min(day) AS lo, max(day) AS hi FROM repo_daily_metrics GROUP BY 1),
days AS (SELECT repo_full_name, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
                                                           INTERVAL 1 DAY)) AS DATE) AS day FROM span),
filled AS (SELECT d.repo_full_name, d.day,
                  CAST(coalesce(m.commits, 0) AS BIGINT) AS commits,
                  CAST(coalesce(m.prs_opened, 0) AS BIGINT) AS prs_opened,
                  CAST(coalesce(m.issues_opened, 0) AS BIGINT) AS issues_opened
           FROM days d LEFT JOIN repo_daily_metrics m USING (repo_full_name, day)),
long AS ({longs})""")


def vectors_sql() -> str:
    """What the vectors must have: a non-zero entry per term that not every document has, and length one."""
    return term_weights_sql(f"""
SELECT doc_kind, repo_full_name, doc_key, count_if(weight > 0)::BIGINT AS n_terms,
       CASE WHEN count_if(weight > 0) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS norm, round(max(weight), 6) AS largest
FROM weights GROUP BY ALL""")


def term_weights_sql(select: str = "SELECT * REPLACE (round(weight, 6) AS weight) FROM weights") -> str:
    return with_models(select, _TERM_CTES)


_TERM_CTES = """
docs AS (
    SELECT 'issue' AS doc_kind, repo_full_name, CAST(issue_number AS VARCHAR) AS doc_key, title AS text FROM fct_issues
    UNION ALL SELECT 'pr', repo_full_name, CAST(pr_number AS VARCHAR), title FROM fct_pull_requests
    UNION ALL SELECT 'commit', repo_full_name, sha, message FROM fct_commits
),
toks AS (SELECT doc_kind, repo_full_name, doc_key, unnest(regexp_extract_all(lower(text), '[\\pL\\pM\\pN]+')) AS term
         FROM docs),
tf AS (SELECT doc_kind, repo_full_name, doc_key, term, CAST(count(*) AS BIGINT) AS tf FROM toks GROUP BY ALL),
dfreq AS (SELECT term, CAST(count(*) AS BIGINT) AS df FROM tf GROUP BY term),
weights AS (
SELECT doc_kind, repo_full_name, doc_key, term, tf, df, CASE WHEN norm > 0 THEN w / norm ELSE 0.0 END AS weight
FROM (SELECT *, sqrt(sum(w * w) OVER (PARTITION BY doc_kind, repo_full_name, doc_key)) AS norm
      FROM (SELECT t.*, d.df, t.tf * ln(((SELECT count(*) FROM docs) + 1) / (d.df + 1)) AS w
            FROM tf t JOIN dfreq d USING (term)) x) y)"""
