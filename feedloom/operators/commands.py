"""Form rows to update calls, as text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.predicates import valid_address
from .ordered import forward_fill

TO_BE_PROVIDED = "TO_BE_PROVIDED"
REMOVAL_NAME = '"**** issued for removal ****"'
DIVIDER = "§"

# The arguments of each call, in order; * marks bare numbers.
_ACCESS = ("authentication_type*", "authentication_info_url", "api_key_parameter_name")
_PLACE = ("country_code", "subdivision_name", "municipality")
CALLS = {
    ("add", "schedule"): ("provider", "country_code", "direct_download_url", *_ACCESS, *_PLACE[1:], "license_url", "name", "status", "feed_contact_email"),
    ("add", "realtime"): ("entity_type*", "provider", "direct_download_url", *_ACCESS, "license_url", "name", "note", "status", "feed_contact_email"),
    ("update", "schedule"): ("mdb_source_id*", "provider", "name", *_PLACE, *_ACCESS, "status", "feed_contact_email"),
    ("update", "realtime"): ("mdb_source_id*", "entity_type*", "provider", *_ACCESS, "name", "note", "status", "feed_contact_email"),
}
#: Arguments that are left out when empty.
OPTIONAL = ("provider", "entity_type", "country_code", "authentication_type", "authentication_info_url", "api_key_parameter_name", "subdivision_name", "municipality", "license_url", "name", "status", "features", "note", "feed_contact_email", "redirects")


_TEXTS = ("timestamp", "provider", "issue_type", "downloadurl", "country", "subdivision", "municipality", "name", "license_url", "auth_type", "auth_info_url", "api_key_name", "note", "status", "email")


def prepared(rows: DataFrame, order: str) -> DataFrame:
    """Form rows (columns as in ``sources.form.FORM_FIELDS``) ready for calls: trimmed, classified, with the last known provider
    suggested where there is none."""
    # one column for each stripped text, so that nothing below strips again
    stripped = {n: tx.strip(F.coalesce(F.col(n), F.lit(""))).alias(n) for n in _TEXTS}
    kept = [order, *(c for c in ("__part",) if c in rows.columns)]
    rows = rows.select(*kept, *stripped.values(), *[F.coalesce(F.col(n), F.lit("")).alias(n) for n in ("datatype", "old_id", "redirects")])
    known = forward_fill(rows, [order], F.nullif("provider", F.lit("")), "known_provider")
    suggestion = F.concat(F.lit(TO_BE_PROVIDED + " ("), F.coalesce("known_provider", F.lit(TO_BE_PROVIDED)), F.lit(" ?)"))
    known = known.withColumns({"low_issue": F.lower("issue_type"), "low_type": tx.unspaced(F.col("datatype"))})
    own = {
        "provider": F.when(F.col("provider") == "", suggestion).otherwise(F.col("provider")),
        "issue": tx.first_match(F.col("low_issue"), list(tx.ISSUE_WORDS), "unknown"),
        "kind": tx.kind_of(F.col("low_type")),
        "day": tx.found_date(F.col("timestamp")),
        "direct_download_url": valid_address(F.col("downloadurl")),
        "license_url": valid_address(F.col("license_url")),
        "mdb_source_id": tx.whole_number(F.btrim("old_id", F.lit('"')), 0),
        "authentication_type": tx.whole_number(F.col("auth_type"), 0),
        "authentication_info_url": F.col("auth_info_url"),
        "api_key_parameter_name": F.col("api_key_name"),
        "country_code": F.col("country"),
        "subdivision_name": F.col("subdivision"),
        "feed_contact_email": F.col("email"),
        "redirect": tx.redirect_list(F.col("redirects")),
        **{n: F.col(n) for n in ("municipality", "name", "note", "status")},
    }
    return known.select(order, *[c.alias(n) for n, c in own.items()])


def _call(verb: str, kind: str, shown: Mapping[str, Column]) -> Column:
    args = [shown[a] for a in CALLS[verb, kind]] + ([shown["redirects"]] if kind == "schedule" else [])
    return F.concat(F.lit(f"{verb}_gtfs_{kind}_source("), F.concat_ws(", ", *args), F.lit(")"))


def call_text(df: DataFrame, order: str) -> DataFrame:
    """(order, command): one call for each row with a known kind; unknown issues count as new feeds, removals are updates under a
    name that says so."""
    # a kind that is known always gives a call; the calls themselves needn't be looked at to leave out the others
    df = df.filter(F.col("kind") != tx.UNKNOWN_TYPE)
    values = {c: F.col(c) for c in df.columns} | {"entity_type": F.concat(F.lit('["'), F.col("kind"), F.lit('"]'))}
    values["name"] = F.when(F.col("issue") == "removed", F.lit(REMOVAL_NAME)).otherwise(F.col("name"))
    shown = {}
    for a in sorted({a for args in CALLS.values() for a in args}):
        name, value = a.rstrip("*"), values[a.rstrip("*")].cast("string")
        text = F.concat(F.lit(name + "="), value) if a.endswith("*") else F.concat(F.lit(name + '="'), value, F.lit('"'))
        # an optional text that holds nothing, or only the marker of an empty value, is left out
        shown[a] = F.when(~value.isin("", '""'), text) if name in OPTIONAL else text
    entries = F.transform("redirect", lambda r: F.concat(F.lit('{"id": "'), r["id"], F.lit('", "comment": " "}')))
    shown["redirects"] = F.concat(F.lit("redirects=["), F.array_join(entries, ", "), F.lit("]"))
    # the arguments are columns of their own, so that the calls only join them
    args = df.select(order, "issue", "kind", *[c.alias(f"__{a}") for a, c in shown.items()])
    shown = {a: F.col(f"`__{a}`") for a in shown}
    updates = F.col("issue").isin("Feed update", "removed")
    out = F.when(F.col("kind") == "Schedule", F.when(updates, _call("update", "schedule", shown)).otherwise(_call("add", "schedule", shown)))
    out = out.otherwise(F.when(updates, _call("update", "realtime", shown)).otherwise(_call("add", "realtime", shown)))
    return args.select(order, tx.typographic(out).alias("command"))


def script(calls: DataFrame, order: str) -> DataFrame:
    """(script): all calls of a batch in order, divided by the sign that the caller splits at. One batch's calls are one text."""
    pairs = F.array_sort(F.collect_list(F.struct(order, "command")))
    return calls.agg(F.array_join(F.transform(pairs, lambda p: p["command"]), DIVIDER).alias("script"))
