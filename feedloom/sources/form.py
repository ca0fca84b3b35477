"""Lines of the submission form: 19 comma-separated fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.csvrows import judge, parse_lines, split_rows

#: The fields of a form row, in order.
FORM_FIELDS = (
    "clientError", "timestamp", "provider", "old_id", "datatype", "issue_type", "downloadurl", "country", "subdivision",
    "municipality", "name", "license_url", "auth_type", "auth_info_url", "api_key_name", "note", "status", "redirects", "email",
)

_EDGES = r"^[\s\p{Z}]+|[\s\p{Z}]+$"
#: http or https, a host of at least two dotted labels, an optional port, then nothing or a rest without white space.
URL_PATTERN = r"^https?://[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+(?::[0-9]+)?(?:[/?#][^\s\p{Z}]*)?$"
#: U+FFFD, U+007F and the controls below U+0020 other than tab, line feed and carriage return.
NOTE_PATTERN = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F�]"


def trimmed(c: Column) -> Column:
    return F.regexp_replace(c, _EDGES, "")


def form_rules(fields: Column, sound: Column, width: int = len(FORM_FIELDS)) -> list[tuple[str, Column]]:
    """quoting, columns and value, in the order in which they are judged."""
    get = lambda name: F.get(fields, F.lit(FORM_FIELDS.index(name)))
    provider, url = trimmed(get("provider")), trimmed(get("downloadurl"))
    bad_provider = (provider != "") & (provider.startswith("#") | ~provider.rlike(r"\p{L}"))
    bad_url = (url != "") & ~url.rlike(URL_PATTERN)
    return [
        ("quoting", ~sound),
        ("columns", F.size(fields) != width),
        ("value", bad_provider | bad_url | get("note").rlike(NOTE_PATTERN)),
    ]


#: Columns that reading adds.
_ADDED = ("fields", "sound", "errors", "reason")


def read_form(lines: DataFrame, line: str = "line") -> DataFrame:
    """``lines`` with the parsed ``fields`` and the array ``errors``.

    A null or empty line is one empty field, so it fails with ``columns``. Rows are independent; repeated lines and a
    repeated header are judged like any other. Columns of ``lines`` with the name of an added one, in any case, are left out.
    """
    own = lines.select(*[F.col(f"`{c}`") for c in lines.columns if c.lower() not in _ADDED])
    parsed = parse_lines(own, line)
    return judge(parsed, form_rules(F.col("fields"), F.col("sound")))


def load_form(lines: DataFrame, line: str = "line") -> tuple[DataFrame, DataFrame]:
    """(good rows with one text column per form field, empty texts as null; bad rows with ``reason``).

    Other columns stay, but for those with the name of an added one and, among the good rows, of a form field.
    """
    good, bad = split_rows(read_form(lines, line))
    texts = [F.nullif(F.get("fields", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(FORM_FIELDS)]
    taken = {*_ADDED, *(n.lower() for n in FORM_FIELDS)}
    own = [F.col(f"`{c}`") for c in lines.columns if c.lower() not in taken]
    return good.select(*own, *texts), bad.drop("fields", "sound", "errors")
