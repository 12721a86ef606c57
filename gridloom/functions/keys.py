"""Object keys, runs, dates and names as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

RUNS = ("00z", "06z", "12z", "18z")


def or_default(value: Column, default: Column | str) -> Column:
    """The trimmed value, or the default where it is null or blank."""
    default = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(F.nullif(F.trim(value), F.lit("")), default)


def normalize_run(run: Column, default: str = "00z") -> Column:
    """Lower case with a final z; null or blank gives the default."""
    low = F.lower(or_default(run, default))
    return F.when(F.endswith(low, F.lit("z")), low).otherwise(F.concat(low, F.lit("z")))


def parse_date(date: Column, strict: bool = False) -> Column:
    """The date of yyyyMMdd text; otherwise null, or an error if ``strict``."""
    good = date.rlike(r"^\d{8}$")
    if strict:
        return F.when(good, F.to_date(date, "yyyyMMdd")).otherwise(F.raise_error(F.concat(F.lit("not a yyyyMMdd date: "), F.coalesce(date, F.lit("null")))).cast("date"))
    return F.when(good, F.try_to_date(date, "yyyyMMdd"))


def key_date(key: Column, default: str) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(key, r"(20\d{6})", 1), F.lit("")), F.lit(default))


def key_run(key: Column, default: str = "00z") -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(F.lower(key), rf"/({'|'.join(RUNS)})/", 1), F.lit("")), F.lit(default))


def root_date_run(root: str, default: str) -> tuple[str, str]:
    """What the folders of a root tell that are nothing but a date or a run; digits within other names tell nothing."""
    folders = root.lower().split("/")
    dates, runs = [x for x in folders if re.fullmatch(r"20\d{6}", x)], [x for x in folders if x in RUNS]
    return (dates or [default])[-1], (runs or ["00z"])[-1]


def path_date_run(path: Column, root: str, default: str) -> tuple[Column, Column]:
    """Date and run of a file by its key below ``root``; what the key doesn't tell, the root's folders do."""
    if root.endswith(".grib2"):  # a file of its own
        root = root.rpartition("/")[0]
    date, run = root_date_run(root, default)
    key = F.concat(F.lit("/"), relative_key(path, root))
    return key_date(key, date), key_run(key, run)


def run_hour(run: Column) -> Column:
    return F.substring(run, 1, 2)


def candidate_key(prefix: Column, date: Column, run: Column, lead: str = "0h") -> Column:
    """[prefix/]DATE/RUN/ifs/0p25/oper/DATEHH0000-LEAD-oper-fc.grib2"""
    bare = F.nullif(F.regexp_replace(prefix, "^/+|/+$", ""), F.lit(""))
    name = F.concat(date, run_hour(run), F.lit(f"0000-{lead}-oper-fc.grib2"))
    return F.concat_ws("/", bare, date, run, F.lit("ifs/0p25/oper"), name)


def partition_prefix(base: Column, date: Column, run: Column) -> Column:
    """base/year=/month=/day=/run= of a date column."""
    bare = F.nullif(F.regexp_replace(base, "^/+|/+$", ""), F.lit(""))
    return F.concat_ws("/", bare, F.concat(F.lit("year="), F.date_format(date, "yyyy")), F.concat(F.lit("month="), F.date_format(date, "MM")), F.concat(F.lit("day="), F.date_format(date, "dd")), F.concat(F.lit("run="), run))


def sliced_prefix(base: Column, date: Column, run: Column) -> Column:
    """The same from the digits of a date text, unchecked."""
    cut = lambda name, a, n: F.concat(F.lit(f"{name}="), F.substring(date, a, n))
    return F.concat_ws("/", base, cut("year", 1, 4), cut("month", 5, 2), cut("day", 7, 2), F.concat(F.lit("run="), run))


def base_name(key: Column) -> Column:
    return F.substring_index(key, "/", -1)


def relative_key(path: Column, root: str) -> Column:
    """The key of a file below ``root``; the whole path where it isn't. A scheme's slashes don't count."""
    plain = lambda c: F.regexp_replace(c, r"^(\w+):/+", "$1:/")
    top = plain(F.lit(root.rstrip("/") + "/"))
    bare = plain(path)
    return F.when(F.startswith(bare, top), F.substring(bare, F.length(top) + 1, F.length(bare))).otherwise(path) if root else path


def output_name(key: Column, suffix: str = ".parquet") -> Column:
    return F.concat(F.regexp_replace(base_name(key), r"\.[^.]+$", ""), F.lit(suffix))


def effective_date_run(key: Column, date: Column, run: Column, default: str) -> tuple[Column, Column]:
    """Arguments win over what the key tells."""
    return or_default(date, key_date(key, default)), normalize_run(or_default(run, key_run(key)))
