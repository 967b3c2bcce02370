"""Names of target tables and columns: in plain Python for the plans of a run, as Spark columns for any number of tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
MAX_NAME = 63
KEPT_BYTES = 49
# How many characters of each part stay when a table name is too long.
TRIMS = {
    "Registration": (6, 6),
    "RegistrationRepeatableQuestionGroup": (6, 20),
    "Encounter": (6, 20),
    "EncounterRepeatableQuestionGroup": (6, 20, 20),
    "ProgramEnrolment": (6, 20),
    "ProgramEnrolmentRepeatableQuestionGroup": (6, 20, 20),
    "ProgramEncounter": (6, 6, 20),
    "ProgramEncounterRepeatableQuestionGroup": (6, 6, 20, 20),
}
# --- end of fixed values ----------------------------------------------------


def _slug(parts: Sequence[str]) -> str:
    clean = (re.sub(r"[^a-z0-9_\s]", "", p.lower()) for p in parts)
    return "_".join(re.sub(r"\s+", "_", p) for p in clean)


def table_name(parts: Sequence[str], kind: str, suffix: str | None = None) -> str:
    """Lower-case parts joined by ``_``; long names are trimmed part by part.

    When trimmed, the suffix follows every part. A kind without trim lengths
    keeps its full name.
    """
    tail = [suffix] if suffix else []
    full = _slug([*parts, *tail])
    if len(full) <= MAX_NAME or kind not in TRIMS:
        return full
    cut = (part[:size] for part, size in zip(parts, TRIMS[kind]))
    return _slug([" ".join([part, *tail]) for part in cut])


#: White space as Python sees it, for the JVM.
_SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _slug_column(parts: Sequence[Column]) -> Column:
    clean = (F.regexp_replace(F.lower(p), f"[^a-z0-9_{_SPACE}]", "") for p in parts)
    return F.concat_ws("_", *(F.regexp_replace(p, f"[{_SPACE}]+", "_") for p in clean))


def table_name_column(parts: Sequence[Column], kind: str, suffix: str | None = None) -> Column:
    """As :func:`table_name`, of columns that are not null."""
    tail = [F.lit(suffix)] if suffix else []
    full = _slug_column([*parts, *tail])
    if kind not in TRIMS:
        return full
    cut = _slug_column([F.concat_ws(" ", F.substring(part, 1, size), *tail) for part, size in zip(parts, TRIMS[kind])])
    return F.when(F.length(full) <= MAX_NAME, full).otherwise(cut)


def hash32(text: str) -> int:
    """The JVM's 32-bit string hash, over UTF-16 code units."""
    units = memoryview(text.encode("utf-16-le", "surrogatepass")).cast("H")
    value = 0
    for unit in units:
        value = (value * 31 + unit) % (1 << 32)
    return value - (1 << 32) if value >= 1 << 31 else value


def _abs32(value: int) -> int:
    # the most negative 32-bit number has no positive counterpart
    return value if value == -(1 << 31) else abs(value)


def column_name(name: str) -> str:
    """A name over 63 bytes keeps 49 bytes and gets a hash of the rest."""
    name = name.replace('"', "")
    while len(name.encode()) > MAX_NAME:
        head = name.encode()[:KEPT_BYTES].decode("utf-8", "replace")
        name = f"{head} ({_abs32(hash32(name))})"
    return name


def voided_name(name: str) -> str:
    return f"voided_{name}"


def view_name(table: str) -> str:
    """Name of the coded-answer view of a table."""
    suffix = "_coded"
    return table[: MAX_NAME - len(suffix)] + suffix
