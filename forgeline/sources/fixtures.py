"""GitHub-shaped Bronze records projected from the driver's ``events`` table.

The driver only provides generic tables, so the activity the models consume is
a deterministic projection of ``events``: each event becomes one landed record
(a repository snapshot, an issue/PR version or a commit version). Many events
map to the same key, so deduplication and aggregation do real work. Every
expression is a plain SQL built-in (given as ``selectExpr`` text: one call to
the JVM per frame instead of one per column function), so the same projection
can be written for the DuckDB oracle (see ``forgeline.oracle``).

Projection (fixed values):
  k                = props.k (0..99) + 100 for every 4,000 events: item numbers and commits grow with the table
  rid              = user_id % 12 + 12 for every 40,000 events: so do repositories
  repo_full_name   = 'org' || user_id % 3 || '/repo' || rid
  repo_metadata    <- event_type = 'view'
  issue_or_pr      <- event_type in ('click', 'signup', 'purchase'); PR for signup, purchase
  commit           <- event_type = 'error'
  fetched_at       = ts; ingest_seq = event_id
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.functions.columns import ISO_UTC_PATTERN

# Which event types land as which record kind.
REPO_EVENT_TYPES = ("view",)
ISSUE_EVENT_TYPES = ("click", "signup", "purchase")
PR_EVENT_TYPES = ("signup", "purchase")
COMMIT_EVENT_TYPES = ("error",)


def _in(types: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{t}'" for t in types) + ")"


def _iso(x: str) -> str:
    return f"date_format({x}, \"{ISO_UTC_PATTERN}\")"


def _hours(n: str) -> str:
    return f"make_dt_interval(0, {n}, 0, 0)"


#: The repository number, also needed where a stream has no other fixture column.
REPO_ID = "(user_id % 12 + 12 * (event_id div 40000))"
REPO_NAME = f"concat('org', CAST(user_id % 3 AS STRING), '/repo', CAST({REPO_ID} AS STRING))"

_BASE = [
    "event_id", "ts", "user_id", "event_type", "value",
    "CAST(get_json_object(props, '$.k') AS INT) + 100 * CAST(event_id div 4000 AS INT) AS k",
    f"{REPO_ID} AS rid", f"{REPO_NAME} AS repo",
]


def _base(events: DataFrame, types: tuple[str, ...]) -> DataFrame:
    return events.where(f"event_type IN {_in(types)}").selectExpr(*_BASE)


_REPO_COLUMNS = [
    "repo AS full_name",
    "concat('repo', CAST(rid AS STRING)) AS name",
    "concat('org', CAST(user_id % 3 AS STRING)) AS owner_login",
    "CASE WHEN k % 10 = 0 THEN CAST(NULL AS STRING) "
    "ELSE concat('Project repo', CAST(rid AS STRING), ' rev ', CAST(k AS STRING)) END AS description",
    "CAST(k * 10 AS BIGINT) AS stargazers_count",
    "CAST(k AS BIGINT) AS forks_count",
    "CAST(k % 17 AS BIGINT) AS open_issues_count",
    "CAST(k * 10 AS BIGINT) AS watchers_count",
    "CAST(user_id % 50 AS BIGINT) AS subscribers_count",
    "CAST(k + user_id % 50 AS BIGINT) AS network_count",
    "CASE WHEN k % 5 = 0 THEN 'master' ELSE 'main' END AS default_branch",
    "CASE WHEN k % 4 = 0 THEN 'Python' WHEN k % 4 = 1 THEN 'Rust' WHEN k % 4 = 2 THEN 'Go' END AS language",
    "CASE WHEN k % 3 = 1 THEN 'MIT' WHEN k % 3 = 2 THEN 'Apache-2.0' END AS license_spdx",
    "(k % 13 = 0) AS archived",
    "false AS disabled",
    "(k % 9 = 0) AS fork",
    "concat('2019-0', CAST(user_id % 9 + 1 AS STRING), '-15T08:00:00Z') AS created_at",
    f"{_iso('ts')} AS updated_at",
    f"CASE WHEN k % 8 = 0 THEN CAST(NULL AS STRING) ELSE {_iso('ts - ' + _hours('k % 5'))} END AS pushed_at",
    f"{_iso('ts')} AS fetched_at",
    "concat('{\"id\":', CAST(event_id AS STRING), ',\"full_name\":\"', repo, "
    "'\",\"stargazers_count\":', CAST(k * 10 AS STRING), '}') AS raw_payload",
    "event_id AS ingest_seq",
]

_ISSUE_COLUMNS = [
    "repo AS repo_full_name",
    "CAST(k AS BIGINT) AS number",
    "CASE WHEN value >= 100 THEN 'closed' ELSE 'open' END AS state",
    "concat('Item ', CAST(k AS STRING), ' of ', repo, CASE WHEN k % 4 = 1 THEN ' révisé 修正' ELSE '' END) AS title",
    "CASE WHEN user_id % 10 = 0 THEN CAST(NULL AS STRING) ELSE concat('user', CAST(user_id AS STRING)) END "
    "AS user_login",
    f"event_type IN {_in(PR_EVENT_TYPES)} AS is_pull_request",
    "(k % 19 = 0) AS locked",
    "CASE WHEN k % 3 = 0 THEN CAST(array() AS ARRAY<STRING>) WHEN k % 3 = 1 THEN array('bug') "
    "ELSE array('bug', 'enhancement') END AS labels",
    "CASE WHEN k % 4 = 0 THEN array(concat('user', CAST(user_id AS STRING))) "
    "ELSE CAST(array() AS ARRAY<STRING>) END AS assignees",
    "CAST(k % 23 AS BIGINT) AS comments",
    f"{_iso('ts')} AS created_at",
    f"{_iso('ts + ' + _hours('k % 6'))} AS updated_at",
    f"CASE WHEN value >= 100 THEN {_iso('ts + ' + _hours('12'))} END AS closed_at",
    f"{_iso('ts')} AS fetched_at",
    "concat('{\"id\":', CAST(event_id AS STRING), ',\"number\":', CAST(k AS STRING), "
    "',\"type\":\"', event_type, '\"}') AS raw_payload",
    "event_id AS ingest_seq",
]

_COMMIT_COLUMNS = [
    "repo AS repo_full_name",
    "md5(CAST(k AS STRING)) AS sha",
    "concat('Change ', CAST(k AS STRING), ' in ', repo) AS message",
    "CASE WHEN k % 7 = 0 THEN CAST(NULL AS STRING) ELSE concat('user', CAST(user_id AS STRING)) END "
    "AS author_login",
    "concat('user', CAST(user_id AS STRING), '@example.com') AS author_email",
    f"{_iso('ts - ' + _hours('1'))} AS authored_date",
    "CASE WHEN k % 2 = 0 THEN 'web-flow' ELSE concat('user', CAST(user_id AS STRING)) END AS committer_login",
    "CASE WHEN k % 2 = 0 THEN 'noreply@example.com' "
    "ELSE concat('user', CAST(user_id AS STRING), '@example.com') END AS committer_email",
    f"CASE WHEN k % 11 = 0 THEN CAST(NULL AS STRING) ELSE {_iso('ts')} END AS committed_date",
    "CASE WHEN k % 10 = 0 THEN array(md5(CAST(k + 100 AS STRING)), md5(CAST(k + 200 AS STRING))) "
    "ELSE array(md5(CAST(k + 100 AS STRING))) END AS parents",
    f"{_iso('ts')} AS fetched_at",
    "concat('{\"id\":', CAST(event_id AS STRING), ',\"sha\":\"', md5(CAST(k AS STRING)), '\"}') AS raw_payload",
    "event_id AS ingest_seq",
]


def bronze_repo_metadata(events: DataFrame) -> DataFrame:
    return _base(events, REPO_EVENT_TYPES).selectExpr(*_REPO_COLUMNS)


def bronze_issue_or_pr(events: DataFrame) -> DataFrame:
    return _base(events, ISSUE_EVENT_TYPES).selectExpr(*_ISSUE_COLUMNS)


def bronze_commit(events: DataFrame) -> DataFrame:
    return _base(events, COMMIT_EVENT_TYPES).selectExpr(*_COMMIT_COLUMNS)


_KIND_FN = {"repo_metadata": bronze_repo_metadata, "issue_or_pr": bronze_issue_or_pr, "commit": bronze_commit}


def bronze_from_events_kind(events: DataFrame, kind: str) -> DataFrame:
    return _KIND_FN[kind](events)


def bronze_from_events(events: DataFrame) -> dict[str, DataFrame]:
    return {kind: fn(events) for kind, fn in _KIND_FN.items()}


# ---------------------------------------------------------------------------- landed JSON
# GitHub-shaped item texts, written as engine-neutral SQL over the columns of
# ``landing_base`` (k, repo, user_id, event_id, event_type, value and the ISO
# strings iso_ts, iso_upd, iso_closed, iso_auth, iso_push). Compact JSON, no
# whitespace, some non-ASCII text. Planted defects (by event_id) must land in
# the quarantine: a missing title, a null comment count, a null owner, a null
# star count, a null sha, a null commit message.
ITEM_SQL = {
    "issue_or_pr": """'{"number":' || CAST(k AS STRING)
 || ',"state":"' || (CASE WHEN value >= 100 THEN 'closed' ELSE 'open' END) || '"'
 || (CASE WHEN event_id % 41 = 0 THEN '' ELSE ',"title":"Item ' || CAST(k AS STRING) || ' of ' || repo || '"' END)
 || ',"user":' || (CASE WHEN user_id % 10 = 0 THEN 'null' ELSE '{"login":"user' || CAST(user_id AS STRING) || '"}' END)
 || (CASE WHEN event_type = 'signup' THEN ',"pull_request":{"url":"https://example.com/pr/' || CAST(k AS STRING) || '"}'
          WHEN event_type = 'purchase' THEN ',"pull_request":null' ELSE '' END)
 || (CASE WHEN k % 5 = 1 THEN '' ELSE ',"locked":' || (CASE WHEN k % 19 = 0 THEN 'true' ELSE 'false' END) END)
 || ',"labels":' || (CASE WHEN k % 3 = 0 THEN '[]' WHEN k % 3 = 1 THEN '[{"name":"bug"}]'
                         ELSE '[{"name":"bug","color":"d73a4a"},{"name":"enhancement"}]' END)
 || (CASE WHEN k % 4 = 0 THEN ',"assignees":[{"login":"user' || CAST(user_id AS STRING) || '"}]'
          WHEN k % 4 = 1 THEN '' ELSE ',"assignees":[]' END)
 || ',"comments":' || (CASE WHEN event_id % 53 = 0 THEN 'null' ELSE CAST(k % 23 AS STRING) END)
 || ',"created_at":"' || iso_ts || '","updated_at":"' || iso_upd || '"'
 || ',"closed_at":' || (CASE WHEN value >= 100 THEN '"' || iso_closed || '"' ELSE 'null' END)
 || '}'""",
    "commit": """'{"sha":' || (CASE WHEN event_id % 37 = 0 THEN 'null' ELSE '"' || md5(CAST(k AS STRING)) || '"' END)
 || ',"commit":{"message":' || (CASE WHEN event_id % 31 = 0 THEN 'null'
                                      ELSE '"Change ' || CAST(k AS STRING) || ' in ' || repo || ' — fix"' END)
 || ',"author":{"email":"user' || CAST(user_id AS STRING) || '@example.com","date":"' || iso_auth || '"}'
 || ',"committer":' || (CASE WHEN k % 11 = 0 THEN 'null'
                             ELSE '{"email":"' || (CASE WHEN k % 2 = 0 THEN 'noreply@example.com'
                                                        ELSE 'user' || CAST(user_id AS STRING) || '@example.com' END)
                                  || '","date":"' || iso_ts || '"}' END)
 || '}'
 || ',"author":' || (CASE WHEN k % 7 = 0 THEN 'null' ELSE '{"login":"user' || CAST(user_id AS STRING) || '"}' END)
 || ',"committer":{"login":"' || (CASE WHEN k % 2 = 0 THEN 'web-flow' ELSE 'user' || CAST(user_id AS STRING) END) || '"}'
 || ',"parents":' || (CASE WHEN k % 10 = 0 THEN '[{"sha":"' || md5(CAST(k + 100 AS STRING)) || '"},{"sha":"'
                                                || md5(CAST(k + 200 AS STRING)) || '"}]'
                           WHEN k % 10 = 5 THEN '[]'
                           ELSE '[{"sha":"' || md5(CAST(k + 100 AS STRING)) || '","url":"u"}]' END)
 || '}'""",
    "repo_metadata": """'{"full_name":"' || repo || '","name":"repo' || CAST(rid AS STRING) || '"'
 || ',"owner":' || (CASE WHEN event_id % 43 = 0 THEN 'null' ELSE '{"login":"org' || CAST(user_id % 3 AS STRING) || '"}' END)
 || (CASE WHEN k % 6 = 0 THEN '' ELSE
        ',"description":' || (CASE WHEN k % 10 = 0 THEN 'null'
                                   ELSE '"Dépôt repo' || CAST(rid AS STRING) || ' rév ' || CAST(k AS STRING) || '"' END)
     || ',"stargazers_count":' || (CASE WHEN event_id % 47 = 0 THEN 'null' ELSE CAST(k * 10 AS STRING) END)
     || ',"forks_count":' || CAST(k AS STRING) || ',"open_issues_count":' || CAST(k % 17 AS STRING)
     || ',"watchers_count":' || CAST(k * 10 AS STRING) || ',"subscribers_count":' || CAST(user_id % 50 AS STRING)
     || ',"network_count":' || CAST(k + user_id % 50 AS STRING)
     || ',"default_branch":"' || (CASE WHEN k % 5 = 0 THEN 'master' ELSE 'main' END) || '"'
     || ',"language":' || (CASE WHEN k % 4 = 3 THEN 'null'
                                ELSE '"' || (CASE WHEN k % 4 = 0 THEN 'Python' WHEN k % 4 = 1 THEN 'Rust' ELSE 'Go' END) || '"' END)
     || ',"license":' || (CASE WHEN k % 3 = 0 THEN 'null'
                               ELSE '{"key":"x","spdx_id":"' || (CASE WHEN k % 3 = 1 THEN 'MIT' ELSE 'Apache-2.0' END) || '"}' END)
     || ',"archived":' || (CASE WHEN k % 13 = 0 THEN 'true' ELSE 'false' END)
     || ',"disabled":false,"fork":' || (CASE WHEN k % 9 = 0 THEN 'true' ELSE 'false' END)
     || ',"created_at":"2019-0' || CAST(user_id % 9 + 1 AS STRING) || '-15T08:00:00Z"'
     || ',"updated_at":"' || iso_ts || '"'
     || ',"pushed_at":' || (CASE WHEN k % 8 = 0 THEN 'null' ELSE '"' || iso_push || '"' END)
   END)
 || '}'""",
}

KIND_EVENT_TYPES = {"repo_metadata": REPO_EVENT_TYPES, "issue_or_pr": ISSUE_EVENT_TYPES,
                    "commit": COMMIT_EVENT_TYPES}

# Fixed value: items per landed page (the listing page size of the collector).
PAGE_SIZE = 100


def landing_base(events: DataFrame, kind: str) -> DataFrame:
    return _base(events, KIND_EVENT_TYPES[kind]).selectExpr(
        "*",
        f"{_iso('ts')} AS iso_ts",
        f"{_iso('ts + ' + _hours('k % 6'))} AS iso_upd",
        f"{_iso('ts + ' + _hours('12'))} AS iso_closed",
        f"{_iso('ts - ' + _hours('1'))} AS iso_auth",
        f"{_iso('ts - ' + _hours('k % 5'))} AS iso_push",
    )


def landed_items(events: DataFrame, kind: str) -> DataFrame:
    """One landed item per event: ``(repo_full_name, event_id, ts, payload)``."""
    return landing_base(events, kind).selectExpr(
        "repo AS repo_full_name", "event_id", "ts", f"{ITEM_SQL[kind]} AS payload")


def landed_pages(events: DataFrame, kind: str) -> DataFrame:
    """Items grouped into response pages of at most ``PAGE_SIZE`` items.

    A page is one (repo, event_id block) group, so its size is bounded by
    construction; the page is stamped with the landing time of its last item.
    """
    items = landed_items(events, kind)
    return (items.groupBy("repo_full_name", (items.event_id / PAGE_SIZE).cast("bigint").alias("page_no"))
            .agg(F.expr("'[' || array_join(collect_list(payload), ',') || ']'").alias("page"),
                 F.max("ts").alias("fetched_at")))


# Pages that arrive damaged (cut short, an error object, no JSON), by page number.
DAMAGED_PAGES = (("page_no % 7 = 0", "substring(page, 1, length(page) - 1)"),
                 ("page_no % 11 = 1", "'{\"message\":\"Server Error\"}'"),
                 ("page_no % 13 = 2", "'Bad gateway'"))


def damaged_pages(events: DataFrame, kind: str) -> DataFrame:
    """The landed pages, some of them damaged."""
    whens = " ".join(f"WHEN {cond} THEN {text}" for cond, text in DAMAGED_PAGES)
    return landed_pages(events, kind).withColumn("page", F.expr(f"CASE {whens} ELSE page END"))
