"""Raw JSON mapping: null vs absent keys, quarantine, page flattening, Bronze write/read."""

from __future__ import annotations

import datetime as dt
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from forgeline.sources import bronze, landing

TS = dt.datetime(2024, 1, 5, 10, 0, 0)


def _landed(spark, payloads, repo="o/r"):
    return spark.createDataFrame([(repo, TS, p) for p in payloads], "repo_full_name string, fetched_at timestamp_ntz, payload string")


def _issue(**kw):
    base = {"number": 1, "state": "open", "title": "t", "user": {"login": "u"}, "created_at": "2024-01-01T00:00:00Z",
            "updated_at": "2024-01-01T00:00:00Z"}
    base.update(kw)
    return json.dumps({k: v for k, v in base.items() if v is not ...}, separators=(",", ":"))


def test_issue_rules(spark):
    payloads = [
        _issue(pull_request=None),                 # key present with null: a PR
        _issue(),                                   # no key: an issue
        _issue(title=...),                         # required key missing
        _issue(comments=None),                     # explicit null in a defaulted field
        _issue(user=None, labels=[{"name": "bug"}], locked=True),
        _issue(labels=[{"color": "x"}]),           # label without name
        "not json",
    ]
    good, rejected = landing.parse_issue_or_pr(_landed(spark, payloads))
    g = good.orderBy("raw_payload").collect()
    assert len(g) == 3
    by_payload = {r["raw_payload"]: r for r in g}
    assert by_payload[payloads[0]]["is_pull_request"] is True
    assert by_payload[payloads[1]]["is_pull_request"] is False
    assert by_payload[payloads[1]]["comments"] == 0 and by_payload[payloads[1]]["locked"] is False
    assert by_payload[payloads[1]]["labels"] == [] and by_payload[payloads[1]]["assignees"] == []
    assert by_payload[payloads[4]]["user_login"] is None and by_payload[payloads[4]]["labels"] == ["bug"]
    reasons = {r["raw_payload"]: r["reason"] for r in rejected.collect()}
    assert reasons[payloads[2]] == "missing:title"
    assert reasons[payloads[3]] == "null:comments"
    assert reasons[payloads[5]] == "missing:labels.name"
    assert reasons["not json"].startswith("malformed")


def test_repo_defaults_and_nested_nulls(spark):
    minimal = json.dumps({"full_name": "o/r", "name": "r", "owner": {"login": "o"}})
    full = json.dumps({"full_name": "o/r", "name": "r", "owner": {"login": "o"}, "license": None,
                       "stargazers_count": 12345, "description": "Dépôt"}, ensure_ascii=False)
    no_login = json.dumps({"full_name": "o/r", "name": "r", "owner": {}})
    good, rejected = landing.parse_repo_metadata(_landed(spark, [minimal, full, no_login]))
    rows = {r["raw_payload"]: r for r in good.collect()}
    assert rows[minimal]["stargazers_count"] == 0 and rows[minimal]["default_branch"] == "main"
    assert rows[minimal]["archived"] is False
    assert rows[full]["license_spdx"] is None and rows[full]["stargazers_count"] == 12345
    assert rows[full]["description"] == "Dépôt"      # non-ASCII kept
    assert [r["reason"] for r in rejected.collect()] == ["missing:owner.login"]


def test_commit_nested_defaults(spark):
    no_commit = json.dumps({"sha": "a", "commit": None, "author": None})
    null_msg = json.dumps({"sha": "b", "commit": {"message": None}})
    good, rejected = landing.parse_commit(_landed(spark, [no_commit, null_msg]))
    row = good.collect()[0]
    assert row["message"] == "" and row["author_login"] is None and row["parents"] == []
    assert [r["reason"] for r in rejected.collect()] == ["null:commit.message"]


def test_page_flattening_keeps_item_text(spark):
    items = [_issue(number=i) for i in range(3)]
    pages = spark.createDataFrame([("o/r", TS, "[" + ",".join(items) + "]")],
                                  "repo_full_name string, fetched_at timestamp_ntz, page string")
    flat = landing.flatten_pages(pages)
    assert sorted(r["payload"] for r in flat.collect()) == sorted(items)


def test_empty_write_writes_nothing(spark, tmp_dir):
    from forgeline import schemas
    empty = spark.createDataFrame([], schemas.nullable(schemas.ISSUE_OR_PR))
    assert bronze.write_bronze(empty, tmp_dir, "issue_or_pr", partition_date=dt.date(2024, 1, 1)) == 0
    written = [f for _, _, fs in os.walk(tmp_dir) for f in fs if f.endswith(".parquet")]
    assert written == []


def test_write_counts_and_prunes(spark, tmp_dir):
    from forgeline import schemas
    rows = [("o/r", i, "open", "t", None, False, False, [], [], 0, "2024-01-01T00:00:00Z", "2024-01-01T00:00:00Z",
             None, "2024-01-01T00:00:00Z", "{}", i) for i in range(5)]
    df = spark.createDataFrame(rows, schemas.nullable(schemas.ISSUE_OR_PR))
    assert bronze.write_bronze(df, tmp_dir, "issue_or_pr", partition_date=dt.date(2024, 1, 2), run_id="r1") == 5
    back = bronze.read_bronze(spark, tmp_dir, "issue_or_pr").filter("owner = 'o' AND day = 2")
    assert back.count() == 5
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_foreign_layout_reader(spark, tmp_dir):
    path = os.path.join(tmp_dir, "commit", "octo", "hello", "year=2024", "month=01", "day=05")
    os.makedirs(path)
    table = pa.table({"repo_full_name": ["octo/hello"], "sha": ["abc"], "message": ["m"],
                      "fetched_at": ["2024-01-05T00:00:00Z"]})
    pq.write_table(table, os.path.join(path, "run42.parquet"), compression="zstd")
    df = bronze.read_foreign_bronze(spark, tmp_dir, "commit")
    row = df.select("sha", "owner", "repo", "year", "month", "day", "run_id").collect()[0]
    assert tuple(row) == ("abc", "octo", "hello", 2024, 1, 5, "run42")


def test_normalize_foreign_null_typed_columns(spark, tmp_dir):
    """A collector file whose closed_at is always null and labels always empty (null-typed
    Arrow columns) is read under the declared schema and landed in our layout."""
    src = os.path.join(tmp_dir, "src", "issue_or_pr", "octo", "hello", "year=2024", "month=01", "day=05")
    os.makedirs(src)
    table = pa.table({
        "repo_full_name": ["octo/hello"], "number": [1], "state": ["open"], "title": ["t"], "user_login": ["u"],
        "is_pull_request": [False], "locked": [False], "labels": pa.array([[]], type=pa.list_(pa.null())),
        "assignees": pa.array([[]], type=pa.list_(pa.null())), "comments": [0],
        "created_at": ["2024-01-05T00:00:00Z"], "updated_at": ["2024-01-05T00:00:00Z"],
        "closed_at": pa.array([None], type=pa.null()), "fetched_at": ["2024-01-05T01:00:00Z"],
        "raw_payload": ["{}"],
    })
    pq.write_table(table, os.path.join(src, "run7.parquet"), compression="zstd")
    dst = os.path.join(tmp_dir, "dst")
    n = bronze.normalize_foreign_bronze(spark, os.path.join(tmp_dir, "src"), "issue_or_pr", dst)
    assert n == 1
    row = bronze.read_bronze(spark, dst, "issue_or_pr").collect()[0]
    assert row["closed_at"] is None and row["labels"] == [] and row["run_id"] == "run7"
    assert (row["owner"], row["repo"], row["year"], row["month"], row["day"]) == ("octo", "hello", 2024, 1, 5)
    assert spark.conf.get("spark.sql.parquet.enableVectorizedReader") in ("true", None)


def test_read_landed_jsonl(spark, tmp_dir):
    items = [_issue(number=i) for i in range(4)] + [_issue(title=...)]
    root = os.path.join(tmp_dir, "landing", "issue_or_pr")
    spark.createDataFrame([(p,) for p in items], "value string").coalesce(1).write.text(
        os.path.join(root, "owner=octo", "repo=hello", "run=1"))
    landed = landing.read_landed_jsonl(spark, root)
    good, rejected = landing.parse_issue_or_pr(landed)
    assert good.count() == 4 and rejected.count() == 1
    row = good.select("repo_full_name", "fetched_at").first()
    assert row["repo_full_name"] == "octo/hello" and row["fetched_at"] is not None
    assert sorted(r["raw_payload"] for r in good.collect()) == sorted(items[:4])


def test_date_partitioned_bronze_is_clustered_by_repo(spark, tmp_dir):
    import glob

    from pyspark.sql import functions as F

    from forgeline.sources import fixtures, tables
    from tests.conftest import SF_SMALL

    src = fixtures.bronze_issue_or_pr(tables.events(spark, SF_SMALL))
    n = bronze.write_bronze(src, tmp_dir, "issue_or_pr", partition_date=F.to_date(F.col("fetched_at")),
                            partition_by=bronze.DATE_PARTITIONS)
    assert n == src.count()
    for path in glob.glob(os.path.join(tmp_dir, "issue_or_pr", "year=*", "month=*", "day=*", "*.parquet"))[:5]:
        repos = pq.read_table(path, columns=["repo_full_name"]).column(0).to_pylist()
        assert repos == sorted(repos)


def test_ill_typed_fields_are_rejected(spark):
    bad = {"type:title": _issue(title=5), "type:state": _issue(state=True), "type:user": _issue(user="bob"),
           "type:user.login": _issue(user={"login": 7}), "type:created_at": _issue(created_at="2024")}
    objects = _issue(title={"a": 1})
    good, rejected = landing.parse_issue_or_pr(_landed(spark, [*bad.values(), objects, _issue(user={"login": "x"})]))
    assert good.count() == 1
    reasons = {r["raw_payload"]: r["reason"] for r in rejected.collect()}
    assert all(reason in reasons[p].split(";") for reason, p in bad.items())
    assert "type:title" in reasons[objects]


def test_damaged_pages_are_quarantined_whole(spark):
    one, two = _issue(), _issue(number=2)
    texts = [f"[{one},{two}]", f"[{one},{two}"[:-5], '{"message": "error"}', "oops", None, "[]", f"[{one}, 5, null]"]
    pages = spark.createDataFrame([("o/r", TS, t) for t in texts], "repo_full_name string, fetched_at timestamp_ntz, page string")
    good, rejected = landing.land(pages, "issue_or_pr")
    assert good.count() == 3
    reasons = sorted((r["reason"], r["raw_payload"] or "") for r in rejected.collect())
    assert [x for x in reasons if x[0].startswith("page:")] == sorted(("page:not an array", t or "") for t in texts[1:5])
    assert len(reasons) == 6  # and the two items that are no objects


def test_kinds_are_checked_whatever_the_spelling(spark):
    """Values of the wrong kind are found by a pattern first: spaces, line ends, escaped keys, nested and repeated names."""
    from forgeline.sources import landing

    whole = '"number":1,"created_at":"2024-01-01T00:00:00Z","updated_at":"2024-01-01T00:00:00Z"'
    cases = {
        '{%s,"state":"open","title":"t"}': "", '{%s,"state":"open","title":5}': "type:title", '{%s,"state" :\n true,"title":"t"}': "type:state",
        '{%s,"state":"open","t\\u0069tle":7}': "type:title", '{%s,"state":"open","title":["x"]}': "type:title",
        '{%s,"state":"open","title":"a \\"title\\": 5","milestone":{"title":3}}': "", '{%s,"state":"open","title":"t","user":"x"}': "type:user",
        '{%s,"state":"open","title":"t","user" : null}': "", '{%s,"state":"open","title":"t","user":{"login": 4}}': "type:user.login",
        '{%s,"state":"open","title":"t","closed_at":12}': "type:closed_at", '{%s,"state":"open","title":"t","locked":null}': "null:locked",
        '{%s,"state":"open","title":"t","pull_request":null}': "",
    }
    rows = [(i, t % whole) for i, t in enumerate(cases)]
    landed = spark.createDataFrame(rows, "i int, payload string").selectExpr("i", "'o/r' AS repo_full_name", "TIMESTAMP_NTZ '2024-01-02 00:00:00' AS fetched_at", "payload")
    good, rejected = landing.parse_issue_or_pr(landed)
    reasons = {r["i"]: r["reason"] for r in rejected.select("i", "reason").collect()}
    want = {i: reason for i, reason in enumerate(cases.values()) if reason}
    assert reasons.keys() == want.keys() and all(want[i] in reasons[i] for i in want)
    flags = [r["is_pull_request"] for r in good.collect()]
    assert len(flags) == len(cases) - len(want) and sum(flags) == 1


def test_an_item_is_parsed_once_unless_something_is_open(spark):
    """The second look at an item stands behind a condition in the plan."""
    from forgeline.sources import landing

    landed = spark.createDataFrame([("o/r", "{}")], "repo_full_name string, payload string").selectExpr("*", "TIMESTAMP_NTZ '2024-01-02 00:00:00' AS fetched_at")
    for parse in landing.PARSERS.values():
        plan = parse(landed)[0]._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(StructField") == 1 and "CASE WHEN _s" in plan


def test_lax_numbers_are_a_switch(spark):
    """Numbers as texts, with a zero fraction and as booleans: read with the switch, rejected without."""
    from forgeline.sources import landing

    rest = '"state":"open","title":"t","created_at":"2024-01-01T00:00:00Z","updated_at":"2024-01-01T00:00:00Z"'
    numbers = {'7': 7, '"8"': 8, '" 9 "': 9, '10.0': 10, 'true': 1, '"x"': None, '5.5': None, '"1e3"': None, 'null': None, '[1]': None}
    landed = spark.createDataFrame([(i, f'{{{rest},"number":{n},"comments":"3"}}') for i, n in enumerate(numbers)], "i int, payload string").selectExpr(
        "i", "'o/r' AS repo_full_name", "TIMESTAMP_NTZ '2024-01-02 00:00:00' AS fetched_at", "payload")
    good, rejected = landing.parse_issue_or_pr(landed, lax=True)
    assert sorted((r["number"], r["comments"]) for r in good.collect()) == sorted((n, 3) for n in numbers.values() if n)
    assert {r["i"] for r in rejected.collect()} == {i for i, n in enumerate(numbers.values()) if n is None}
    strict, refused = landing.parse_issue_or_pr(landed)
    assert strict.count() == 0 and refused.count() == len(numbers)
    plain = landed.withColumn("payload", F.regexp_replace("payload", '"comments":"3"', '"comments":3'))
    assert [r["number"] for r in landing.parse_issue_or_pr(plain)[0].collect()] == [7]
