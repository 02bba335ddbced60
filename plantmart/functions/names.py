"""Path and name rules of the landed zone as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Recognised data extensions and environment suffixes of an extract name.
DATA_EXTENSIONS = r"\.(csv\.gz|tsv\.gz|csv|tsv)$"
ENVIRONMENT_SUFFIXES = r"_(prod|qa|dev)_extract$"

_PART_OF_EXTRACT = r"(?i)(/[^/]+\.(?:csv\.gz|tsv\.gz|csv|tsv))/[^/]+$"
# Group 1 is the bucket (empty for a plain file system), group 2 the key below it.
_URI = r"^(?:(?:file|hdfs|viewfs):/+|(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/]*)/?)(.*)$"


def extract_path(path: Column) -> Column:
    """An extract delivered as a folder of part files counts as one file, named by the folder."""
    return F.regexp_replace(path, _PART_OF_EXTRACT, "$1")


def uri_bucket(uri: Column) -> Column:
    return F.regexp_extract(uri, _URI, 1)


def uri_key(uri: Column) -> Column:
    return F.regexp_extract(uri, _URI, 2)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def source_system(path: Column) -> Column:
    """Name of the enclosing folder, NULL for a key that lies in none."""
    return F.try_element_at(F.split(uri_key(path), "/"), F.lit(-2))


def config_stem(file_name: Column) -> Column:
    """File name without one data extension and one environment suffix."""
    bare = F.regexp_replace(file_name, "(?i)" + DATA_EXTENSIONS, "")
    return F.regexp_replace(bare, "(?i)" + ENVIRONMENT_SUFFIXES, "")


def join_path(base: Column | str, *parts: Column) -> Column:
    start = F.lit(base) if isinstance(base, str) else base
    return F.concat_ws("/", F.regexp_replace(start, "/+$", ""), *parts)
