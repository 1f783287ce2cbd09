"""Column roles (date, text, target) and types, inferred per file.

One aggregate job profiles all files of a group. A second one parses values as
dates, only of columns that names and types leave undecided.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, TimestampNTZType, TimestampType

from tickerloom.functions.dates import parse_mixed
from tickerloom.functions.labels import as_number
from tickerloom.functions.naming import col

# --- fixed values -----------------------------------------------------------
DATE_NAME = r"(date|time|timestamp|datetime|publish|created|updated|posted|dt)"
TEXT_NAME = r"(headline|title|description|text|content)"
TARGET_NAME = r"(sentiment|label)"
NAME_SCORE, TYPE_SCORE = 5, 4
RATIO_SCORES = [(0.6, 3), (0.3, 1)]
# ----------------------------------------------------------------------------

STRING, NUMBER, TIME = "string", "number", "time"


@dataclass(frozen=True)
class Roles:
    date: str | None
    text: tuple[str, ...]
    target: tuple[str, ...]


def _has(pattern: str, name: str) -> bool:
    return re.search(pattern, name.strip(), re.I) is not None


def profile(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
            extra: Sequence[Column] = ()) -> DataFrame:
    """Per key: row count and, per column, non-null and numeric values.

    ``extra`` aggregates ride along in the same pass.
    """
    counts = [F.count("*").alias("n_rows"), *extra]
    for name in columns:
        counts.append(F.count(col(name)).alias(f"{name}__non_null"))
        counts.append(F.count(as_number(col(name))).alias(f"{name}__numeric"))
    return df.groupBy(*[col(k) for k in keys]).agg(*counts)


def kinds_of(counts: Mapping[str, int], schema: Mapping[str, DataType]) -> dict[str, str]:
    """Column kinds from one profile row. An all-null column counts as numeric."""
    kinds = {}
    for name, kind in schema.items():
        if isinstance(kind, (TimestampType, TimestampNTZType, DateType)):
            kinds[name] = TIME
        elif not isinstance(kind, StringType):
            kinds[name] = NUMBER
        else:
            same = counts[f"{name}__non_null"] == counts[f"{name}__numeric"]
            kinds[name] = NUMBER if same else STRING
    return kinds


def infer_text_columns(kinds: Mapping[str, str]) -> list[str]:
    return [n for n, kind in kinds.items()
            if kind == STRING and _has(TEXT_NAME, n) and not _has(TARGET_NAME, n)]


def infer_target_columns(names: Sequence[str]) -> list[str]:
    return [n for n in names if _has(TARGET_NAME, n)]


def base_scores(kinds: Mapping[str, str]) -> dict[str, int]:
    """Date score per column from its name and type; label columns never qualify."""
    return {
        n: NAME_SCORE * _has(DATE_NAME, n) + TYPE_SCORE * (kind == TIME)
        for n, kind in kinds.items() if not _has(TARGET_NAME, n)
    }


def undecided(kinds: Mapping[str, str]) -> list[str]:
    """The string columns whose values can still decide the winner.

    A parse rate adds at most three points, and only to string columns.
    """
    scores = base_scores(kinds)
    if not scores:
        return []
    most = RATIO_SCORES[0][1]
    reach = {n: s + (most if kinds[n] == STRING else 0) for n, s in scores.items()}
    floor = max(scores.values())
    contenders = [n for n in scores if reach[n] >= max(floor, 1)]
    if len(contenders) == 1 and scores[contenders[0]] > 0:
        return []
    return [n for n in contenders if kinds[n] == STRING]


def parse_rates(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, one column per name): share of all its non-null values that parse as a date."""
    named = df.select(*[col(k) for k in keys],
                      *[col(c).cast("string").alias(f"__v{i}") for i, c in enumerate(columns)])
    for i in range(len(columns)):
        named = parse_mixed(named, f"__v{i}", f"__p{i}", day_first=True)
    return named.groupBy(*[col(k) for k in keys]).agg(*[
        (F.count(f"__p{i}") / F.count(f"__v{i}")).alias(c) for i, c in enumerate(columns)])


def pick_date_column(kinds: Mapping[str, str], rates: Mapping[str, float]) -> str | None:
    """Best score wins, ties go to the smaller name; nothing scored is no date."""
    scores = base_scores(kinds)
    for name, rate in rates.items():
        if name in scores and kinds[name] == STRING:
            scores[name] += next((s for least, s in RATIO_SCORES if rate >= least), 0)
    scored = [(-s, n) for n, s in scores.items() if s > 0]
    return min(scored)[1] if scored else None


def infer_roles(df: DataFrame, ignored: Sequence[str] = ()) -> Roles:
    """Roles of one frame seen as a single file, without its ``ignored`` columns."""
    names = [c for c in df.columns if c not in ignored]
    strings = [n for n in names if isinstance(df.schema[n].dataType, StringType)]
    counts = profile(df, [], strings).first().asDict()
    kinds = kinds_of(counts, {n: df.schema[n].dataType for n in names})
    date = None
    if counts["n_rows"]:
        open_columns = undecided(kinds)
        rates = parse_rates(df, [], open_columns).first().asDict() if open_columns else {}
        date = pick_date_column(kinds, {n: r for n, r in rates.items() if r is not None})
    return Roles(date, tuple(infer_text_columns(kinds)), tuple(infer_target_columns(names)))
