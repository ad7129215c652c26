"""Run a load over many files so that files that cannot be read fail alone."""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from driftline.sources.listing import canonical_name

# A plan that cannot be made raises the first, a job that fails at run time either.
JOB_ERRORS = (PySparkException, Py4JJavaError)

# How Spark says that one file is missing or cannot be read.
_UNREADABLE = re.compile(r"FAILED_READ_FILE|Encountered error while reading file|PATH_NOT_FOUND|Path does not exist|FileNotFoundException")
_NAMED = re.compile(r"while reading file (\S+?)\.?\s|Path does not exist: (.+?)\. SQLSTATE|Path does not exist: (\S+)")


def load_isolated(
    files: list[str], attempt: Callable[[list[str]], None], failed: Callable[[str, Exception], None]
) -> None:
    """Load all files in one job; a file that cannot be read is reported and left out of the next attempt.

    Each such file costs one more attempt, since Spark names it. Where it does not, the list is halved. Any other error
    (a full disk, a refused write) is not a file's fault and goes up. ``attempt`` must leave nothing behind when it raises.
    """
    files = list(files)
    while files:
        try:
            attempt(files)
            return
        except JOB_ERRORS as error:
            text = whole_message(error)
            if not _UNREADABLE.search(text):
                raise
            broken = _named_file(text, files) if len(files) > 1 else files[0]
            if broken is None:
                middle = len(files) // 2
                load_isolated(files[:middle], attempt, failed)
                files = files[middle:]
                continue
            failed(broken, error)
            files.remove(broken)


def _named_file(text: str, files: list[str]) -> str | None:
    found = _NAMED.search(f"{text} ")
    if not found:
        return None
    name = next(g for g in found.groups() if g)
    return next((n for n in (canonical_name(unquote(name)), canonical_name(name)) if n in files), None)


def whole_message(error: Exception) -> str:
    """All of what went wrong; for a failed job that of its innermost cause as well."""
    if not isinstance(error, Py4JJavaError):
        return str(error).strip() or type(error).__name__
    cause, texts = error.java_exception, []
    while cause is not None:
        texts.append(cause.toString())
        cause = cause.getCause()
    return "\n".join(dict.fromkeys(texts))
