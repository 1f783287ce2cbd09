"""Text clean-up queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.catalog.tables import table
from tickerloom.functions import text as X

SAMPLE_LEAD = "They're sure it's "
PLAIN = "".join(chr(c) for c in range(0x21, 0x7F))
WIDE = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F))
SAMPLE_TAIL = " and WON'T say what's in there; I'd say we couldn't."


def normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("row_key"), "text")
    turns = table(spark, sf, "conversations").select(
        F.concat(F.lit("c"), F.col("conv_id"), F.lit("-"), F.col("turn")).alias("row_key"), "text")
    return X.normalize_text(docs.unionByName(turns), ["text"])


def strip_html(spark: SparkSession, sf: str) -> DataFrame:
    plain = X.collapse_ws(X.unescape_entities(X.strip_tags(X.fill_empty(F.col("html")))))
    return table(spark, sf, "pages").select("page_id", plain.alias("text"))


def contractions(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(F.lit(SAMPLE_LEAD), F.col("text"), F.lit(SAMPLE_TAIL))
    return table(spark, sf, "documents").select("doc_id", text.alias("text")).select(
        "doc_id", X.expand_contractions(F.col("text")).alias("text"))


def text_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Each remaining step on its own, over whole pages."""
    pages = table(spark, sf, "pages").select("page_id", "html", "url")
    html = F.col("html")
    return pages.select(
        "page_id",
        X.strip_artefacts(html).alias("no_artefacts"),
        X.ascii_only(html).alias("ascii_text"),
        F.lower(X.collapse_ws(html)).alias("one_line"),
        X.nfkc(html).alias("nfkc_text"),
        X.fill_empty(F.nullif(F.col("url"), F.lit(""))).alias("url_text"))


def compatibility_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents in full-width letters and ligatures, brought back by NFKC."""
    wide = F.translate(F.replace("text", F.lit("fi"), F.lit("\ufb01")), PLAIN, WIDE)
    return table(spark, sf, "documents").select("doc_id", X.nfkc(wide).alias("text"))


QUERIES = {
    "compatibility_forms": compatibility_forms,
    "normalize_text": normalize_text,
    "strip_html": strip_html,
    "contractions": contractions,
    "text_steps": text_steps,
}

_WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_NO_TAGS = "regexp_replace(coalesce({c}, ''), '<[^>]+>', ' ', 'g')"


def _collapse(expression: str) -> str:
    return f"trim(regexp_replace({expression}, '{_WS}', ' ', 'g'), ' ')"


def _contract(expression: str) -> str:
    """Nested replacements, longest contraction first."""
    for short in sorted(X.CONTRACTIONS, key=len, reverse=True):
        pattern = f"(?i)\\b{short}\\b".replace("'", "''")
        expression = f"regexp_replace({expression}, '{pattern}', '{X.CONTRACTIONS[short]}', 'g')"
    return expression


_ENTITIES = [("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;", "&")]


def _unescape(expression: str) -> str:
    for entity, char in _ENTITIES:
        expression = f"replace({expression}, '{entity}', '{char}')"
    return expression


_ARTEFACT_SQL = "[ÂâÃã]"

# The whole clean-up of a column called text.
NORMALIZED_SQL = _collapse("lower(regexp_replace(" + _contract(
    f"regexp_replace({_unescape(_NO_TAGS.format(c='text'))}, '{_ARTEFACT_SQL}', ' ', 'g')")
    + ", '[^\\x00-\\x7F]', '', 'g'))")

ORACLES = {
    "compatibility_forms": "SELECT doc_id, text FROM documents",
    "normalize_text": f"""
WITH src AS (
  SELECT 'd' || doc_id AS row_key, text FROM documents
  UNION ALL SELECT 'c' || conv_id || '-' || turn, text FROM conversations)
SELECT row_key, {NORMALIZED_SQL} AS text
FROM src""",
    "strip_html": f"""
SELECT page_id, {_collapse(_unescape(_NO_TAGS.format(c='html')))} AS text FROM pages""",
    "contractions": f"""
SELECT doc_id, {_contract("'" + SAMPLE_LEAD.replace("'", "''") + "' || text || '"
                          + SAMPLE_TAIL.replace("'", "''") + "'")} AS text
FROM documents""",
    "text_steps": f"""
SELECT page_id,
       regexp_replace(html, '(?:â€œ|â€\x9d|â€—|â€–|{_ARTEFACT_SQL})', ' ', 'g') AS no_artefacts,
       regexp_replace(html, '[^\\x00-\\x7F]', '', 'g') AS ascii_text,
       lower({_collapse('html')}) AS one_line,
       html AS nfkc_text,
       coalesce(nullif(url, ''), '') AS url_text
FROM pages""",
}
