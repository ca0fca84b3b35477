"""Work split in balanced, hashed jobs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import both_urls, status_outside
from ..functions.text import without_prefix
from .ordered import chunks, ordered_join


def split_ready(df: DataFrame, direct: Column, latest: Column, status: Column) -> tuple[DataFrame, DataFrame]:
    """(rows with both addresses, all rows looked at with ``ready``); ignored statuses are left out of both."""
    looked = df.filter(status_outside(status)).withColumn("ready", both_urls(direct, latest))
    return looked.filter("ready").drop("ready"), looked


# The texts of the log.
def log_line(base: Column, direct: Column, latest: Column) -> Column:
    failed = F.concat(base, F.lit(": FAILURE! Direct download URL is "), F.coalesce(direct, F.lit("None")), F.lit(" and latest URL is "), F.coalesce(latest, F.lit("None")), F.lit(". Both URLS must be defined to update the source latest URL."))
    return F.when(both_urls(direct, latest), F.concat(base, F.lit(": SUCCESS! Both direct download and latest URLs were fetched."))).otherwise(failed)


def ascii_json(text: Column) -> Column:
    """A JSON string in ASCII: all but printable ASCII escaped, by UTF-16 units in lower-case hexadecimal."""
    code = F.hex(F.encode(text, "UTF-16BE"))
    short = {"0022": '\\"', "005C": "\\\\", "000A": "\\n", "000D": "\\r", "0009": "\\t", "0008": "\\b", "000C": "\\f"}

    def unit(i: Column) -> Column:
        u = code.substr(i * 4 + 1, F.lit(4))
        out = F.when(u.between("0020", "007E"), F.chr(F.conv(u, 16, 10).cast("bigint"))).otherwise(F.concat(F.lit("\\u"), F.lower(u)))
        for value, written in short.items():
            out = F.when(u == value, F.lit(written)).otherwise(out)
        return out

    escaped = F.array_join(F.transform(F.sequence(F.lit(0), (F.length(code) / 4 - 1).cast("int")), unit), "")
    # most texts need no escape
    return F.concat(F.lit('"'), F.when(text.rlike(r'[^ !#-\[\]-~]'), escaped).otherwise(text), F.lit('"'))


def compact_json(fields: dict[str, Column], present: Mapping[str, Column] | None = None) -> Column:
    """A JSON object of texts in ASCII without spaces. A field is there if it isn't null or, where ``present`` names it, if that
    holds; a null that is there is ``null``."""
    present = present or {}
    parts = [F.when(present[n] if n in present else c.isNotNull(), F.concat(F.lit(f'"{n}":'), F.coalesce(ascii_json(c.cast("string")), F.lit("null")))) for n, c in fields.items()]
    return F.concat(F.lit("{"), F.array_join(F.filter(F.array(*parts), lambda p: p.isNotNull()), ","), F.lit("}"))


def key_present(authentication_type: Column, api_key_parameter_name: Column) -> Column:
    """Whether a job's object names the key's parameter: where there is any authentication, or a name that isn't empty."""
    return (F.coalesce(authentication_type, F.lit(0)) != 0) | (F.coalesce(api_key_parameter_name, F.lit("")) != "")


def jobs(ready: DataFrame, order: list[str], text: Column, most: int = 64) -> DataFrame:
    """(chunk, hash, data): each chunk's objects from its last row to its first, with the SHA-1 of the texts put together."""
    parts = chunks(ready, order, most)
    joined = ordered_join(parts, ["chunk"], [-F.col("row_no")], text, "joined")
    return joined.select("chunk", F.sha1("joined").alias("hash"), F.replace("joined", F.lit("}{"), F.lit("} {")).alias("data"))


def matrix_json(job_rows: DataFrame) -> DataFrame:
    """(matrix): all jobs as one JSON object; there are at most 64."""
    each = F.array_sort(F.collect_list(F.struct("chunk", "hash", "data")))
    return job_rows.agg(F.to_json(F.struct(F.transform(each, lambda j: F.struct(j["hash"].alias("hash"), j["data"].alias("data"))).alias("include"))).alias("matrix"))


def latest_path(latest: Column, prefix: str) -> Column:
    return without_prefix(latest, prefix)
