"""Scalar functions on text, dates and ids, as columns."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _latin_table() -> tuple[str, str]:
    """Accented Latin letters and the plain ones that they decompose to, with those that don't decompose."""
    pairs = {}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        c = chr(code).lower()
        plain = unicodedata.normalize("NFKD", c)[0]
        if c.isalpha() and plain.isascii() and plain != c:
            pairs[c] = plain
    # Letters without a decomposition.
    pairs |= {"ø": "o", "ł": "l", "đ": "d", "ħ": "h", "ı": "i", "ŧ": "t"}
    return "".join(pairs), "".join(pairs.values())


_ACCENTED, _PLAIN = _latin_table()
#: Letters written as two.
_DOUBLE = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ð": "d"}


def strip(c: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.btrim(c, F.lit(" \t\n\v\f\r"))


@F.pandas_udf(T.StringType())
def _without_other_scripts(s: pd.Series) -> pd.Series:
    """What is left of other scripts after decomposition; only reached by texts that hold any."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode())


def normalize(c: Column, other_scripts: bool = False) -> Column:
    """For file names: up to the first comma, lower case, only letters, digits, spaces and hyphens, words joined by hyphens,
    accented Latin letters made plain. Letters of other scripts stay unless ``other_scripts``."""
    text = F.lower(F.substring_index(c, ",", 1))
    text = F.trim(F.regexp_replace(text, r"[^\p{L}\p{N} \-]", ""))
    text = F.regexp_replace(text, " +", "-")
    for letter, plain in _DOUBLE.items():
        text = F.replace(text, F.lit(letter), F.lit(plain))
    text = F.translate(text, _ACCENTED, _PLAIN)
    return F.when(text.rlike(r"[^\x00-\x7F]"), _without_other_scripts(text)).otherwise(text) if other_scripts else text


def filename(country: Column, subdivision: Column, provider: Column, data_type: Column, source_id: Column, extension: str) -> Column:
    """Parts joined by hyphens; missing parts count as the text None, as a template would print them."""
    parts = [normalize(F.coalesce(p, F.lit("None"))) for p in (country, subdivision, provider)]
    return F.concat(F.concat_ws("-", *parts, data_type, source_id), F.lit("." + extension))


def latest_url(name: Column, template: str) -> Column:
    """``template`` with its ``{filename}`` filled."""
    before, _, after = template.partition("{filename}")
    return F.concat(F.lit(before), name, F.lit(after))


def realtime_filename(country: Column, subdivision: Column, provider: Column, name: Column, entity_type: Column, source_id: Column, extension: str = "json") -> Column:
    """The name stands for the provider where there is one; the entity types are part of the data type."""
    return filename(country, subdivision, F.coalesce(name, provider), F.concat(F.lit("gtfs-rt-"), F.array_join(entity_type, "-")), source_id, extension)


def iso_time(ts: Column) -> Column:
    """UTC to the second, for a session in UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def piped(values: Column) -> Column:
    """Joined by pipes; an empty array prints as brackets, null stays null."""
    return F.when(F.size(values) > 0, F.array_join(values, "|")).when(F.size(values) == 0, F.lit("[]"))


def redirect_ids(redirect: Column) -> Column:
    return F.coalesce(F.array_join(F.transform(redirect, lambda r: r["id"]), "|", ""), F.lit(""))


def redirect_comments(redirect: Column) -> Column:
    """A missing comment counts as empty."""
    return F.coalesce(F.array_join(F.transform(redirect, lambda r: F.coalesce(r["comment"], F.lit(""))), "|"), F.lit(""))


def gtfs_date(c: Column) -> Column:
    """yyyyMMdd; anything else is null."""
    text = c.cast("string")
    return F.when(text.rlike(r"^\d{8}$"), F.try_to_date(text, "yyyyMMdd"))


def recent(end_date: Column, now: Column, weeks: int = 26) -> Column:
    """Aggregate: any parsed date after ``now`` less so many weeks; false for none."""
    limit = now - F.expr(f"INTERVAL {weeks * 7} DAYS")
    return F.coalesce(F.bool_or(gtfs_date(end_date).cast("timestamp") > limit), F.lit(False))


def whole_number(c: Column, default: int | None = None) -> Column:
    number = F.trim(c).try_cast("int")
    return number if default is None else F.coalesce(number, F.lit(default))


def without_prefix(c: Column, prefix: str) -> Column:
    return F.replace(c, F.lit(prefix), F.lit(""))


def base_name(path: Column) -> Column:
    """The file's name without folder and last extension."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


#: Issue types and the words for them, in the order in which they are tried.
ISSUE_WORDS = (("New feed", ("new feed", "new source")), ("Feed update", ("source update", "feed update")), ("removed", ("removed",)))
#: Data types, the text looked for without spaces, and their codes, in the order in which they are tried.
DATA_TYPE_WORDS = (("schedule", "Schedule"), ("realtime", "Realtime"), ("vehiclepositions", "vp"), ("tripupdates", "tu"), ("servicealerts", "sa"))
UNKNOWN_TYPE = "gu"


def first_match(text: Column, options: list[tuple[str, tuple[str, ...]]], default: str) -> Column:
    """The first option any of whose words the text holds."""
    out = F.lit(default)
    for value, words in reversed(options):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(text, F.lit(w))
        out = F.when(hit, F.lit(value)).otherwise(out)
    return out


def issue_type(c: Column) -> Column:
    return first_match(F.lower(c), list(ISSUE_WORDS), "unknown")


def data_type(c: Column, specific: bool = False) -> Column:
    """Texts of fewer than three characters are unknown. By the order, ``Realtime - Trip Updates`` is Realtime; ``specific``
    tries the entity types first."""
    return F.when(F.length(c) >= 3, kind_of(unspaced(c), specific)).otherwise(F.lit(UNKNOWN_TYPE))


def unspaced(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"\s+", "")


def kind_of(text: Column, specific: bool = False) -> Column:
    """The data type of a text from ``unspaced``."""
    words = [(code, (w,)) for w, code in DATA_TYPE_WORDS]
    if specific:
        words = [words[0], *words[2:], words[1]]
    return first_match(text, words, UNKNOWN_TYPE)


def found_date(c: Column, default: str = "01/01/1970", both_forms: bool = True) -> Column:
    """The first date in the text as MM/dd/yyyy; ``both_forms`` also reads yyyy-MM-dd, which a strict parser of the first form
    turns into the default."""
    # fixed value: what counts as a date within a text
    found = F.regexp_extract(c, r"[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2}", 0)
    day = F.try_to_date(found, "M/d/yyyy")
    if both_forms:
        day = F.coalesce(day, F.try_to_date(found, "yyyy-MM-dd"))
    return F.coalesce(F.date_format(day, "MM/dd/yyyy"), F.lit(default))


def redirect_list(c: Column) -> Column:
    """Ids parted by white space, as an array of (id, comment); fewer than three characters give an empty one, an empty text
    null."""
    clean = F.replace(c, F.lit('"'), F.lit(""))
    entries = F.transform(F.split(clean, " "), lambda x: F.struct(x.alias("id"), F.lit(" ").alias("comment")))
    return F.when(c != "", F.when(F.length(clean) >= 3, entries).otherwise(F.slice(entries, 1, 0)))


def typographic(c: Column) -> Column:
    """Single quotes as apostrophes, line breaks removed."""
    return F.replace(F.translate(c, "'", "ʼ"), F.lit("\n"), F.lit(""))


def dated_if(flag: Column, day: Column) -> Column:
    return F.when(flag.isNotNull() & (flag != ""), day)


def referer(url: Column) -> Column:
    """Protocol and authority of an address (the port stays); null where it has none."""
    return F.concat(F.try_parse_url(url, F.lit("PROTOCOL")), F.lit("://"), F.try_parse_url(url, F.lit("AUTHORITY")))


def listed(values: Column) -> Column:
    return F.array_join(values, ", ")


def id_order(c: Column) -> list[Column]:
    """Numeric ids by their number, then the others as text."""
    return [c.try_cast("bigint").asc_nulls_last(), c.asc()]
