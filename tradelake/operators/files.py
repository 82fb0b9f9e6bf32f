"""File selection: wildcard match, limit, not-yet-loaded filter.

Wildcards follow Python ``fnmatch``: ``*`` matches any text *including* ``/``,
``?`` one character, ``[...]`` / ``[!...]`` a class. Hadoop globs do not cross
``/``, so patterns are never handed to the file system as globs: the literal
root before the first wildcard is listed recursively and the rest is matched as
an anchored regex on the path.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def split_uri(uri: str) -> tuple[str, str]:
    """``scheme://authority`` (possibly empty) and the path part of a URI."""
    m = re.match(_SCHEME, uri)
    if not m:
        return "", uri
    return uri[: m.end()], uri[m.end():]


def has_wildcard(pattern: str) -> bool:
    return "*" in pattern or "?" in pattern or "[" in pattern


def root_prefix(pattern: str) -> str:
    """Literal folder before the first wildcard (up to and including its last ``/``)."""
    _, path = split_uri(pattern)
    cut = min([i for i in (path.find("*"), path.find("?"), path.find("[")) if i >= 0] + [len(path)])
    head = path[:cut]
    slash = head.rfind("/")
    return pattern[: len(pattern) - len(path)] + (head[: slash + 1] if slash >= 0 else "")


def wildcard_to_regex(pattern: str) -> str:
    """fnmatch pattern -> Java regex over the path, scheme and authority optional."""
    _, path = split_uri(pattern)
    out, i, n = [], 0, len(path)
    while i < n:
        ch = path[i]
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif ch == "[":
            j = i + 1
            if j < n and path[j] == "!":
                j += 1
            if j < n and path[j] == "]":
                j += 1
            while j < n and path[j] != "]":
                j += 1
            if j >= n:
                out.append(re.escape(ch))
            else:
                body = path[i + 1 : j].replace("\\", "\\\\")
                if body.startswith("!"):
                    body = "^" + body[1:]
                elif body.startswith("^"):
                    body = "\\" + body
                out.append(f"[{body}]")
                i = j
        else:
            out.append(re.escape(ch))
        i += 1
    # Spark reports local paths as file:/x; the pattern may say /x or file:///x.
    return "^(?:[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)?" + "".join(out) + "$"


ANYTHING = "*"


def pattern_steps(pattern: str) -> list:
    """The path of a wildcard pattern as steps: ``ANYTHING`` for a ``*``, else a regex for one character."""
    _, path = split_uri(pattern)
    found = re.findall(r"\*|\?|\[!?\]?[^\]]*\]|.", path, re.S)
    return [ANYTHING if f == "*" else re.compile(wildcard_to_regex(f)) for f in found]


def open_steps(steps: list, text: str) -> set[int]:
    """The places in a pattern where it stands after ``text``; none if no path that begins so can match."""

    def skipped(at: set[int]) -> set[int]:
        out = set()
        for i in at:
            while i < len(steps) and steps[i] == ANYTHING:  # may match nothing
                out.add(i)
                i += 1
            out.add(i)
        return out

    at = skipped({0})
    for ch in text:
        inside = {i for i in at if i < len(steps) and steps[i] == ANYTHING}
        on = {i + 1 for i in at - inside if i < len(steps) and steps[i].match(ch)}
        at = skipped(inside | on)
    return at


def match_files(files: DataFrame, pattern: str) -> DataFrame:
    """Rows of a listing whose ``path`` matches the wildcard ``pattern``."""
    return files.where(F.col("path").rlike(wildcard_to_regex(pattern)))


def limit_files(files: DataFrame, n: int | None) -> DataFrame:
    """First ``n`` files by path (L1). None or 0 means no limit; negative is an error."""
    if n is None or n == 0:
        return files
    if n < 0:
        raise ValueError("limit must be positive")
    return files.orderBy("path").limit(n)


def loaded_names(ledger: DataFrame) -> DataFrame:
    """File names recorded as loaded (A2, S15); the anti join does not mind repeats."""
    if "status" in ledger.columns:
        ledger = ledger.where(F.col("status") == "loaded")
    return ledger.select("file_name")


def pending_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed files not yet recorded as loaded (F7, J1, U1): a left anti join.

    No broadcast hint: the ledger grows with every load, so the join strategy is
    left to AQE, which broadcasts it at run time only when it is actually small.
    Duplicated listing rows are kept (unlike EXCEPT).
    """
    return files.join(loaded_names(ledger), files["path"] == F.col("file_name"), "left_anti")
