"""Names of stores as Hadoop and as Arrow spell them.

Byte ranges of files are read with Arrow on the executors, since Spark has no scan for them. Both sides
know the same stores, but not always under the same scheme.
"""

from __future__ import annotations

from urllib.parse import quote

# Hadoop's schemes of stores that Arrow reads as well, and Arrow's names for them.
ARROW_SCHEMES = {
    "file": "", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss",
}


class UnknownStore(ValueError):
    """A store whose files can be listed, but not read in ranges."""


def arrow_uri(path: str) -> str:
    """The name under which Arrow opens a file that Spark knows by this path."""
    if path.startswith("/"):
        return path
    scheme, _, rest = path.partition(":")
    if scheme not in ARROW_SCHEMES:
        raise UnknownStore(f"{path}: files below {scheme}: cannot be replicated; known are {sorted(ARROW_SCHEMES)}")
    if scheme == "file":
        return "/" + rest.lstrip("/")
    return f"{ARROW_SCHEMES[scheme]}:{quote(rest, safe='/:@')}"
