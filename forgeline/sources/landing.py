"""Landed JSON -> typed Bronze records, with a quarantine for bad items.

Input is what the collector lands: one row per response page (a JSON array of
items) or per item, with the repository it was fetched for and the landing
time. Everything runs on executors: ``from_json`` against the declared wire
schema, key-presence tests on the raw text, and one reject predicate per rule.

Rules (the contract of the reference's mappers):

* required keys (``payload["k"]``) must be present and non-null;
* defaulted keys (``payload.get(k, d)``) take the default only when *absent*;
  an explicit null in a non-optional field is rejected, not defaulted;
* optional keys may be absent or null; nested reads are null-safe;
* ``is_pull_request`` is key presence, true even for a null value (the field is a VARIANT in the parse);
* list items must carry their projected key (``lbl["name"]`` ...);
* a present, non-null value that does not fit the declared type is rejected: texts
  must be JSON strings (numbers and booleans are not turned into text), numbers JSON numbers (a
  numeric string is not read as a number), nested records JSON objects, times ISO date-times;
* a page that is not an array (truncated, an error object, no JSON, null) is rejected as a whole.

With ``lax=True`` whole numbers may also come as texts, as numbers without a fraction (``5.0``) and as booleans, as in a model that coerces; what
cannot be read as a whole number is still rejected.

``raw_payload`` of items that land one to a line (:func:`read_landed_jsonl`) is the line byte for byte; an item of a page is handed back by
the array's parse, so white space between its tokens is not kept.

Rejected rows keep the payload (or page) and a ``;``-joined list of reasons, so
every landed item or page is either a record or a reject.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgeline import schemas
from forgeline.functions.columns import ISO_UTC_PATTERN, utc_wall_clock

PAYLOAD = "payload"
PAGE = "_page"


def flatten_pages(pages: DataFrame, page_col: str = "page") -> DataFrame:
    """One row per item of each landed page (a JSON array of objects).

    Parsing the array as ``array<string>`` hands back every element as its own
    compact JSON text (white space between tokens is not kept). A page that is not an array is one
    row: its text as payload and the reason in ``_page``, which the parsers reject.
    """
    items = F.from_json(F.col(page_col), "array<string>")
    no_reason = F.lit(None).cast("string").alias(PAGE)
    whole = F.array(F.struct(F.col(page_col).alias(PAYLOAD), F.lit("page:not an array").alias(PAGE)))
    rows = F.coalesce(F.transform(items, lambda x: F.struct(x.alias(PAYLOAD), no_reason)), whole)
    keep = [c for c in pages.columns if c != page_col]
    return pages.select(*keep, F.inline(rows))


# ------------------------------------------------------------------ rule helpers
# Two stages, both produced by generators (``inline`` of a one-element array) so
# the optimizer can neither push the reject filter beneath a parse nor inline a
# parse into each of the ~30 rule expressions:
#
# 1. every item: one typed parse ``_j``. A field that must only be there is a VARIANT in it (absent is NULL, a JSON null is
#    not). Only where that parse leaves something open, the item is looked at again: its top-level keys ``_k`` if a field that may be
#    absent came out NULL, and the JSON kinds of texts and objects (the typed parse would turn any value into text) if one pattern over
#    the raw text finds a value that begins otherwise than it should. A cheap *coarse* test over these, a superset of every reject
#    rule, flags the items that may be bad;
# 2. flagged items only: ``_m``, a map of top-level keys to raw JSON text, from
#    which the exact reasons are named. Rejects are rare, so this parse is too.
_MAP = "_m"
_KEYS = "_k"
_BAD = "_maybe_bad"
_TYPES = "_types"


def _wrong_kind(path: str, kind: str) -> Column:
    """Reason if the value at ``path`` is there, not null and not of the JSON kind (STRING, OBJECT)."""
    found = F.schema_of_variant(F.try_variant_get(F.col("_v"), f"$.{path}", "variant"))
    return F.when(found.isNotNull() & (found != "VOID") & ~found.startswith(kind), F.lit(f"type:{path}"))


def _suspect(texts: Sequence[str], objects: Sequence[str]) -> str:
    """A pattern found in every item with a text or object field of another kind (and in some without): the key, then a value that
    begins with neither the mark of its kind nor ``null``; or an escape that could hide a letter of a key."""
    def of(paths: Sequence[str], mark: str) -> str:
        names = "|".join(sorted({p.rpartition(".")[2] for p in paths}))
        return rf'"(?:{names})"\s*:\s*[^{mark}n\s]'
    # a name that is an object at one place and a text at another is open to both
    both = {p.rpartition(".")[2] for p in texts} & {p.rpartition(".")[2] for p in objects}
    parts = [of([p for p in texts if p.rpartition(".")[2] not in both], '"'), of([p for p in objects if p.rpartition(".")[2] not in both], "{")]
    if both:
        parts.append(rf'"(?:{"|".join(sorted(both))})"\s*:')
    return "|".join([*parts, r"\\u00[0-7]"])


def _coerced(parsed: Column, ddl: str) -> Column:
    """The whole-number fields of a parse that took them as texts."""
    for name in re.findall(r"(\w+) bigint", ddl):
        text = F.trim(parsed[name])
        number = F.regexp_replace(F.when(text == "true", "1").when(text == "false", "0").otherwise(text), r"\.0*$", "")
        parsed = parsed.withField(name, F.when(number.rlike(r"^[+-]?\d+$"), number.try_cast("bigint")))
    return parsed


def _stage1(landed: DataFrame, ddl: str, texts: Sequence[str], objects: Sequence[str], may_lack: Sequence[str], lax: bool = False) -> DataFrame:
    """The typed parse; the keys of items that lack one of ``may_lack`` or have none of it; the fields that are not of their JSON kind."""
    typed = F.from_json(F.col(PAYLOAD), ddl.replace(" bigint", " string") if lax else ddl).alias("_j")
    parsed = F.struct(typed, F.col(PAYLOAD).rlike(_suspect(texts, objects)).alias("_s"))
    lacks = _any([F.col(f"_j.{k}").isNull() for k in may_lack])
    again = F.struct(F.when(lacks, F.json_object_keys(F.col(PAYLOAD))).alias(_KEYS),
                     F.when(F.col("_s"), F.try_parse_json(F.col(PAYLOAD))).alias("_v"))
    kinds = [_wrong_kind(p, "STRING") for p in texts] + [_wrong_kind(p, "OBJECT") for p in objects]
    none = F.array().cast("array<string>")
    checked = F.struct(F.when(F.col("_s"), F.array_compact(F.array(*kinds))).otherwise(none).alias(_TYPES))
    out = landed.select("*", F.inline(F.array(parsed)))
    if lax:
        out = out.select(*landed.columns, F.inline(F.array(F.struct(_coerced(F.col("_j"), ddl).alias("_j"), "_s"))))
    return out.select("*", F.inline(F.array(again))).select("*", F.inline(F.array(checked))).drop("_v", "_s")


def _stage2(parsed: DataFrame, coarse: Column) -> DataFrame:
    flagged = F.struct(coarse.alias(_BAD),
                       F.when(coarse, F.from_json(F.col(PAYLOAD), "map<string,string>")).alias(_MAP))
    return parsed.select("*", F.inline(F.array(flagged)))


def _raw(key: str) -> Column:
    """Top-level value of ``key`` as JSON text; NULL when absent *or* JSON null (stage 2)."""
    return F.col(_MAP)[key]


def _present(key: str) -> Column:
    return F.coalesce(F.array_contains(F.col(_KEYS), F.lit(key)), F.lit(False))


def _any(conds: Sequence[Column]) -> Column:
    out = F.lit(False)
    for c in conds:
        out = out | F.coalesce(c, F.lit(False))
    return out


def _reasons(*conds: tuple[Column, str]) -> Column:
    parts = [F.when(c, F.lit(r)) for c, r in conds]
    named = F.array_distinct(F.concat(F.array_compact(F.array(*parts)), F.coalesce(F.col(_TYPES), F.array().cast("array<string>"))))
    return F.when(F.col(_BAD), named).otherwise(F.array().cast("array<string>"))


def _required(keys: Sequence[str]) -> list[tuple[Column, str]]:
    return [(_raw(k).isNull(), f"missing:{k}") for k in keys]


def _not_null_if_present(keys: Sequence[str]) -> list[tuple[Column, str]]:
    return [(_present(k) & _raw(k).isNull(), f"null:{k}") for k in keys]


def _typed(j: str, keys: Sequence[str]) -> list[tuple[Column, str]]:
    """Present and non-null in the text, yet NULL after parsing: wrong type."""
    return [(_raw(k).isNotNull() & F.col(f"{j}.{k}").isNull(), f"type:{k}") for k in keys]


def _bad_timestamp(c: Column) -> Column:
    return c.isNotNull() & (F.try_to_timestamp(c).isNull() | ~c.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}"))


def _timestamps(j: str, keys: Sequence[str]) -> list[tuple[Column, str]]:
    return [(_bad_timestamp(F.col(f"{j}.{k}")), f"type:{k}") for k in keys]


def _list_items(j: str, key: str, field: str) -> tuple[Column, str]:
    return (F.coalesce(F.exists(F.col(f"{j}.{key}"), lambda x: x[field].isNull()), F.lit(False)),
            f"missing:{key}.{field}")


def _is_object() -> tuple[Column, str]:
    return (F.col(_MAP).isNull(), "malformed")


def _coarse(j: str, required: Sequence[str], defaulted: Sequence[str], extra: Sequence[Column]) -> Column:
    """Superset of the reject rules over stage-1 columns only: not an object, a
    required field NULL after parsing (absent, JSON null or wrong type), a
    present defaulted field NULL after parsing (JSON null or wrong type)."""
    return _any([F.col(j).isNull(), F.size(_TYPES) > 0,
                 *[F.col(f"{j}.{k}").isNull() for k in required],
                 *[_present(k) & F.col(f"{j}.{k}").isNull() for k in defaulted],
                 *extra])


def _tagged(parsed: DataFrame, reasons: Column) -> DataFrame:
    """Items with their reasons; a page that is not an array has that reason alone."""
    if PAGE in parsed.columns:
        reasons = F.when(F.col(PAGE).isNotNull(), F.array(F.col(PAGE))).otherwise(reasons)
    return parsed.withColumn("_reasons", reasons)


def _split(parsed: DataFrame, reasons: Column, good_cols: list[Column], keep: list[str]) -> tuple[DataFrame, DataFrame]:
    return split_tagged(_tagged(parsed, reasons), good_cols, keep)


def split_tagged(tagged: DataFrame, good_cols: list[Column], keep: list[str]) -> tuple[DataFrame, DataFrame]:
    good = tagged.filter(F.size("_reasons") == 0).select(*good_cols)
    rejected = tagged.filter(F.size("_reasons") > 0).select(
        *keep, F.col(PAYLOAD).alias("raw_payload"), F.array_join("_reasons", ";").alias("reason"))
    return good, rejected


def _landing_cols(fetched_col: str) -> list[Column]:
    return [
        F.date_format(F.col(fetched_col), ISO_UTC_PATTERN).alias("fetched_at"),
        F.col(PAYLOAD).alias("raw_payload"),
        # content hash: deterministic tie-break between versions landed at the same instant
        F.xxhash64(F.col(PAYLOAD)).alias("ingest_seq"),
    ]


def _default(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))


# ------------------------------------------------------------------ mappers
def parse_repo_metadata(landed: DataFrame, fetched_col: str = "fetched_at", pieces: bool = False, lax: bool = False):
    """Repository payloads -> ``REPO_METADATA`` records and rejects."""
    j = "_j"
    d = schemas.REPO_DEFAULTS
    defaulted = list(d)
    stamps = ["created_at", "updated_at", "pushed_at"]
    coarse = _coarse(j, ["full_name", "name", "owner.login"], defaulted,
                     [_bad_timestamp(F.col(f"{j}.{k}")) for k in stamps])
    parsed = _stage2(_stage1(
        landed, schemas.RAW_REPO_DDL, ["full_name", "name", "description", "default_branch", "language", *stamps,
                                       "owner.login", "license.spdx_id"], ["owner", "license"], ["full_name", *defaulted], lax), coarse)
    reasons = _reasons(
        _is_object(),
        *_required(["full_name", "name", "owner"]),
        (_raw("owner").isNotNull() & F.col(f"{j}.owner.login").isNull(), "missing:owner.login"),
        *_not_null_if_present(defaulted),
        *_typed(j, [k for k in defaulted]),
        *_timestamps(j, stamps),
    )
    good_cols = [
        F.col(f"{j}.full_name").alias("full_name"),
        F.col(f"{j}.name").alias("name"),
        F.col(f"{j}.owner.login").alias("owner_login"),
        F.col(f"{j}.description").alias("description"),
        *[_default(F.col(f"{j}.{k}"), d[k]).alias(k) for k in
          ("stargazers_count", "forks_count", "open_issues_count", "watchers_count",
           "subscribers_count", "network_count", "default_branch")],
        F.col(f"{j}.language").alias("language"),
        F.col(f"{j}.license.spdx_id").alias("license_spdx"),
        *[_default(F.col(f"{j}.{k}"), d[k]).alias(k) for k in ("archived", "disabled", "fork")],
        F.col(f"{j}.created_at").alias("created_at"),
        F.col(f"{j}.updated_at").alias("updated_at"),
        F.col(f"{j}.pushed_at").alias("pushed_at"),
        *_landing_cols(fetched_col),
    ]
    keep = [c for c in landed.columns if c not in (PAYLOAD, PAGE)]
    if pieces:
        return _tagged(parsed, reasons), good_cols, keep
    return _split(parsed, reasons, good_cols, keep)


def parse_issue_or_pr(landed: DataFrame, repo_col: str = "repo_full_name",
                      fetched_col: str = "fetched_at", pieces: bool = False, lax: bool = False):
    """Issue / pull request payloads of one repo -> ``ISSUE_OR_PR`` records and rejects."""
    j = "_j"
    required = ["number", "state", "title", "created_at", "updated_at"]
    defaulted = ["locked", "labels", "assignees", "comments"]
    stamps = ["created_at", "updated_at", "closed_at"]
    lists = [_list_items(j, "labels", "name"), _list_items(j, "assignees", "login")]
    coarse = _coarse(j, required, defaulted,
                     [c for c, _ in lists] + [_bad_timestamp(F.col(f"{j}.{k}")) for k in stamps])
    parsed = _stage2(_stage1(landed, schemas.RAW_ISSUE_DDL, ["state", "title", *stamps, "user.login"], ["user"],
                              ["number", *defaulted], lax), coarse)
    reasons = _reasons(
        _is_object(),
        *_required(required),
        *_not_null_if_present(defaulted),
        *_typed(j, ["number", "locked", "labels", "assignees", "comments"]),
        *lists,
        *_timestamps(j, stamps),
    )
    empty = F.array().cast("array<string>")
    good_cols = [
        F.col(repo_col).alias("repo_full_name"),
        F.col(f"{j}.number").alias("number"),
        F.col(f"{j}.state").alias("state"),
        F.col(f"{j}.title").alias("title"),
        F.col(f"{j}.user.login").alias("user_login"),
        F.col(f"{j}.pull_request").isNotNull().alias("is_pull_request"),
        _default(F.col(f"{j}.locked"), False).alias("locked"),
        F.coalesce(F.transform(F.col(f"{j}.labels"), lambda x: x["name"]), empty).alias("labels"),
        F.coalesce(F.transform(F.col(f"{j}.assignees"), lambda x: x["login"]), empty).alias("assignees"),
        _default(F.col(f"{j}.comments"), 0).cast("bigint").alias("comments"),
        F.col(f"{j}.created_at").alias("created_at"),
        F.col(f"{j}.updated_at").alias("updated_at"),
        F.col(f"{j}.closed_at").alias("closed_at"),
        *_landing_cols(fetched_col),
    ]
    keep = [c for c in landed.columns if c not in (PAYLOAD, PAGE)]
    if pieces:
        return _tagged(parsed, reasons), good_cols, keep
    return _split(parsed, reasons, good_cols, keep)


def parse_commit(landed: DataFrame, repo_col: str = "repo_full_name",
                 fetched_col: str = "fetched_at", pieces: bool = False, lax: bool = False):
    """Commit payloads of one repo -> ``COMMIT`` records and rejects."""
    j = "_j"
    dates = [F.col(f"{j}.commit.author.date"), F.col(f"{j}.commit.committer.date")]
    # coarse: a commit object whose message parsed to NULL (absent is fine, so stage 2 decides)
    msg_maybe_null = F.col(f"{j}.commit").isNotNull() & F.col(f"{j}.commit.message").isNull()
    coarse = _coarse(j, ["sha"], ["parents"],
                     [msg_maybe_null, _list_items(j, "parents", "sha")[0], *[_bad_timestamp(c) for c in dates]])
    parsed = _stage2(_stage1(
        landed, schemas.RAW_COMMIT_DDL,
        ["sha", "commit.message", "author.login", "committer.login",
         *[f"commit.{who}.{k}" for who in ("author", "committer") for k in ("email", "date")]],
        ["commit", "author", "committer", "commit.author", "commit.committer"], ["sha", "parents"], lax), coarse)
    # "commit" may be absent or null (then {}), but a present "message" must not be null
    commit_present_null_msg = (_raw("commit").isNotNull()
                               & F.coalesce(F.array_contains(
                                   F.json_object_keys(_raw("commit")), F.lit("message")), F.lit(False))
                               & F.col(f"{j}.commit.message").isNull())
    reasons = _reasons(
        _is_object(),
        *_required(["sha"]),
        (commit_present_null_msg, "null:commit.message"),
        *_not_null_if_present(["parents"]),
        *_typed(j, ["parents"]),
        _list_items(j, "parents", "sha"),
        (_bad_timestamp(dates[0]), "type:commit.author.date"),
        (_bad_timestamp(dates[1]), "type:commit.committer.date"),
    )
    good_cols = [
        F.col(repo_col).alias("repo_full_name"),
        F.col(f"{j}.sha").alias("sha"),
        _default(F.col(f"{j}.commit.message"), schemas.COMMIT_DEFAULTS["message"]).alias("message"),
        F.col(f"{j}.author.login").alias("author_login"),
        F.col(f"{j}.commit.author.email").alias("author_email"),
        F.col(f"{j}.commit.author.date").alias("authored_date"),
        F.col(f"{j}.committer.login").alias("committer_login"),
        F.col(f"{j}.commit.committer.email").alias("committer_email"),
        F.col(f"{j}.commit.committer.date").alias("committed_date"),
        F.coalesce(F.transform(F.col(f"{j}.parents"), lambda x: x["sha"]),
                   F.array().cast("array<string>")).alias("parents"),
        *_landing_cols(fetched_col),
    ]
    keep = [c for c in landed.columns if c not in (PAYLOAD, PAGE)]
    if pieces:
        return _tagged(parsed, reasons), good_cols, keep
    return _split(parsed, reasons, good_cols, keep)


PARSERS = {
    "repo_metadata": parse_repo_metadata,
    "issue_or_pr": parse_issue_or_pr,
    "commit": parse_commit,
}


def land(pages: DataFrame, kind: str, lax: bool = False) -> tuple[DataFrame, DataFrame]:
    """Pages of one record kind -> (typed records, rejects).

    Each output is its own plan over the pages: writing both re-parses the
    input. To write both from one parse, use :func:`land_tagged`, persist the
    tagged frame and split it with :func:`split_tagged`.
    """
    return PARSERS[kind](flatten_pages(pages), lax=lax)


def land_tagged(pages: DataFrame, kind: str, lax: bool = False) -> tuple[DataFrame, list[Column], list[str]]:
    """Parsed items with their reject reasons, plus what :func:`split_tagged` needs."""
    return PARSERS[kind](flatten_pages(pages), pieces=True, lax=lax)


_REPO_FROM_PATH = r"owner=([^/]+)/repo=([^/]+)/"


def read_landed_jsonl(spark, path: str, page_per_line: bool = False) -> DataFrame:
    """Landed JSON-lines files -> ``(repo_full_name, fetched_at, payload|page)``.

    One item (or one response page) per line under ``.../owner=<o>/repo=<r>/...``.
    The repository comes from the file's path and the landing time from the
    file's modification time (``_metadata``), so nothing is read twice and the
    text of each line is kept as is. Splittable: large files are read by many
    tasks.
    """
    raw = spark.read.text(path, recursiveFileLookup=True)
    fp = F.col("_metadata.file_path")
    return raw.select(
        F.concat_ws("/", F.regexp_extract(fp, _REPO_FROM_PATH, 1),
                    F.regexp_extract(fp, _REPO_FROM_PATH, 2)).alias("repo_full_name"),
        utc_wall_clock(F.col("_metadata.file_modification_time"), spark).alias("fetched_at"),
        F.col("value").alias("page" if page_per_line else PAYLOAD),
    )
