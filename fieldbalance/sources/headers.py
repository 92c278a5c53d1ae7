"""Headers of hand-kept sheets: unique, syntactic names and picking by pattern."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame

_RESERVED = {
    "if", "else", "repeat", "while", "function", "for", "next", "break", "in",
    "TRUE", "FALSE", "NULL", "Inf", "NaN", "NA",
}


def _syntactic(name: str) -> str:
    name = re.sub(r"[^\w.]", ".", name)
    number = re.match(r"\.{0,2}(\d.*)$", name)
    if number:
        rest = number.group(1)
        return ("..." if rest.isdigit() else "..") + rest
    if name in _RESERVED or name.startswith("_"):
        return "." + name
    return name


def repair_names(names: Sequence[str | None]) -> list[str]:
    """Unique syntactic names: blank and repeated ones get ``...<position>``."""
    plain = [_syntactic(re.sub(r"(\.\.\.?\d+)+$", "", (n or "").strip())) for n in names]
    seen = Counter(plain)
    return [f"{n}...{i}" if not n or seen[n] > 1 else n
            for i, n in enumerate(plain, start=1)]


def repair_header(df: DataFrame, names: Sequence[str | None]) -> DataFrame:
    """Give a table read without header the repaired form of its header cells."""
    return df.toDF(*repair_names(names))


def matching_columns(df: DataFrame, pattern: str) -> list[str]:
    return [c for c in df.columns if re.search(pattern, c)]


def select_by_regex(df: DataFrame, pattern: str) -> DataFrame:
    """Columns whose name matches; a dot in a name stays part of the name."""
    return df.select(*[f"`{c}`" for c in matching_columns(df, pattern)])
