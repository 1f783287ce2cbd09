"""Label columns: numeric codes, title case, binary alpha, label blocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickerloom.functions.text import trim_ws

# --- fixed values -----------------------------------------------------------
SENTIMENT_NAMES = {-1.0: "Negative", 0.0: "Neutral", 1.0: "Positive"}
NUMERIC_LABEL_NAME = r"\b(sentiment|label)\b"
MISSING_LABELS = ["", "nan", "none", "null"]
LABEL_KEYS = ["Sentiment", "Confidence", "Impact", "Horizon", "Event", "Summary", "Decision"]
LABEL_MARKERS = ["Sentiment:", "Decision:"]
# ----------------------------------------------------------------------------


def as_number(c: Column) -> Column:
    """Numeric text as double, else null.

    The cast alone would read a type suffix (``1d``, ``2f``) as part of a number.
    """
    text = c.cast("string")
    return F.when(~text.rlike(r"(?i)^[\s\d.+e-]*\d\.?[df]\s*$"), text.try_cast("double"))


def map_numeric_sentiment(c: Column, names: dict[float, str] = SENTIMENT_NAMES) -> Column:
    """Known codes to names; any other value stays as its own text."""
    code = as_number(c)
    mapped = F.lit(None).cast("string")
    for value, name in names.items():
        mapped = F.when(code == value, F.lit(name)).otherwise(mapped)
    return F.coalesce(mapped, c.cast("string"))


def title_case(c: Column) -> Column:
    """Trim and capitalise every run of letters (``very-good`` -> ``Very-Good``)."""
    text = trim_ws(c.cast("string"))
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.when(text.rlike(r"^\p{L}*$"), F.initcap(text)).otherwise(
        F.array_join(F.transform(runs, F.initcap), ""))


def binary_alpha_label(alpha: Column) -> Column:
    return (alpha > 0).cast("int")


def is_missing_label(c: Column) -> Column:
    text = F.lower(trim_ws(c.cast("string")))
    return c.isNull() | text.isin(MISSING_LABELS)


def is_well_formed_block(c: Column) -> Column:
    """Both markers are there; a null block is not well formed."""
    found = F.lit(True)
    for marker in LABEL_MARKERS:
        found = found & c.contains(marker)
    return F.coalesce(found, F.lit(False))


def label_block_field(block: Column, key: str) -> Column:
    value = trim_ws(F.regexp_extract(block, rf"(?m)^{key}:[ \t]*(.*)$", 1))
    return F.when(value != "", value)


def label_block_columns(block: Column) -> dict[str, Column]:
    """The seven ``Key: value`` lines as columns; absent keys are null."""
    fields = {key.lower(): label_block_field(block, key) for key in LABEL_KEYS}
    fields["confidence"] = fields["confidence"].try_cast("double")
    return fields
