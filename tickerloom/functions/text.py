"""Text clean-up as column expressions.

Everything runs in the JVM except entity unescaping and Unicode NFKC, which
have no built-in counterpart. Those two share one Arrow-batched call, and a
row's text is sent to Python only when the call could change it.
"""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tickerloom.functions.naming import col

# --- fixed values -----------------------------------------------------------
TAG = r"<[^>]+>"

# UTF-8 punctuation read as Windows-1252, and the two stray lead letters.
ARTEFACTS = [
    "â€™",
    "â€œ",
    "â€\u009d",
    "â€—",
    "â€–",
    "â€…",
    "Â",
    "Ã",
]

CONTRACTIONS = {
    "can't": "cannot",
    "won't": "will not",
    "n't": " not",
    "'re": " are",
    "'ve": " have",
    "'ll": " will",
    "'d": " would",
    "'m": " am",
    "it's": "it is",
    "that's": "that is",
    "what's": "what is",
    "there's": "there is",
    "here's": "here is",
    "isn't": "is not",
    "aren't": "are not",
    "wasn't": "was not",
    "weren't": "were not",
    "don't": "do not",
    "doesn't": "does not",
    "didn't": "did not",
    "hasn't": "has not",
    "haven't": "have not",
    "hadn't": "had not",
}
# ----------------------------------------------------------------------------

# Unicode white space beside the blank; Java's \s covers only part of it.
_ASCII_SPACE = r"\t-\r\x1c-\x1f"
_SPACE = (_ASCII_SPACE + r"\x85\x{a0}\x{1680}\x{2000}-\x{200a}"
          r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
SPACE_CHARS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
_WORD = r"[\p{L}\p{N}_]"


def fill_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def strip_tags(c: Column) -> Column:
    return F.when(c.contains("<"), F.regexp_replace(c, TAG, " ")).otherwise(c)


def is_ascii(c: Column) -> Column:
    """True when every character takes one byte."""
    return F.octet_length(c) == F.length(c)


def _stable_ranges() -> str:
    """Regex class body: non-ASCII characters that NFKC never touches.

    Marks are left out because they may combine with what precedes them.
    """
    blocks = [
        (0x0080, 0x052F),  # Latin, Greek, Cyrillic
        (0x2010, 0x205E),  # punctuation
        (0x20A0, 0x20BF),  # currency signs
        (0x3041, 0x30FF),  # kana
        (0x4E00, 0x9FFF),  # ideographs
        (0xAC00, 0xD7A3),  # Hangul syllables
    ]
    parts: list[str] = []
    for low, high in blocks:
        start = None
        for code in range(low, high + 2):
            char = chr(code)
            keep = (
                code <= high
                and unicodedata.normalize("NFKC", char) == char
                and unicodedata.category(char)[0] != "M"
            )
            if keep and start is None:
                start = code
            elif not keep and start is not None:
                parts.append(rf"\x{{{start:x}}}-\x{{{code - 1:x}}}")
                start = None
    return "".join(parts)


_UNSTABLE = f"[^{_stable_ranges()}]"


def needs_nfkc(c: Column) -> Column:
    """True when NFKC might change the text; false is certain."""
    non_ascii = F.regexp_replace(c, r"[\x00-\x7F]+", "")
    return ~is_ascii(c) & non_ascii.rlike(_UNSTABLE)


def _per_batch(change: Callable[[str], str]):
    """An Arrow-batched column function from a text function.

    The inner function is local, so it is shipped by value and executors need
    not have this package installed.
    """
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(change, na_action="ignore")

    return F.pandas_udf(run, StringType())


_unescape = _per_batch(html.unescape)
_nfkc = _per_batch(lambda t: unicodedata.normalize("NFKC", t))
_unescape_nfkc = _per_batch(lambda t: unicodedata.normalize("NFKC", html.unescape(t)))


def unescape_entities(c: Column) -> Column:
    """HTML entities to characters, one pass; texts without ``&`` stay in the JVM."""
    return F.coalesce(_unescape(F.when(c.contains("&"), c)), c)


def nfkc(c: Column) -> Column:
    return F.coalesce(_nfkc(F.when(needs_nfkc(c), c)), c)


def strip_artefacts(c: Column, repair_mojibake: bool = False) -> Column:
    """Encoding artefacts to spaces, in any case.

    ``repair_mojibake`` first puts the punctuation back that the sequences
    stood for; by default the fixed behaviour above is kept.
    """
    if repair_mojibake:
        quotes = {"™": "'", "œ": '"', "\u009d": '"',
                  "—": "-", "–": "-", "…": "..."}
        for last, plain in quotes.items():
            c = F.replace(c, F.lit("â€" + last), F.lit(plain))
        c = F.replace(c, F.lit("â€TM"), F.lit("'"))
    return F.when(is_ascii(c), c).otherwise(
        F.regexp_replace(c, "(?iu)(?:" + "|".join(ARTEFACTS) + ")", " ")
    )


def _contraction_pattern(short: str) -> str:
    before = f"(?<={_WORD})" if short.startswith("'") else f"(?<!{_WORD})"
    return f"(?iu){before}{short}(?!{_WORD})"


def expand_contractions(c: Column) -> Column:
    """Whole-word contractions, any case, to lower-case phrases.

    The patterns never overlap, so replacing them one after another, longest
    first, gives the same text as one scan over all of them. A plain substring
    search picks the few a text can hold; only those run as patterns.
    """
    known = F.array(*[
        F.struct(F.lit(short).alias("short"), F.lit(_contraction_pattern(short)).alias("pattern"),
                 F.lit(CONTRACTIONS[short]).alias("phrase"))
        for short in sorted(CONTRACTIONS, key=len, reverse=True)])
    # Three letters match an ASCII letter in any-case search but not in lower().
    folded = F.when(is_ascii(c), c).otherwise(F.translate(c, "\u0131\u017f\u212a", "isk"))
    held = F.get(F.transform(F.array(F.lower(folded)), lambda low: F.filter(
        known, lambda k: low.contains(k["short"]))), F.lit(0))
    expanded = F.aggregate(
        held, c, lambda text, k: F.regexp_replace(text, k["pattern"], k["phrase"]))
    return F.when(c.contains("'"), expanded).otherwise(c)


def ascii_only(c: Column) -> Column:
    return F.when(is_ascii(c), c).otherwise(F.regexp_replace(c, r"[^\x00-\x7F]+", ""))


def collapse_ws(c: Column) -> Column:
    """White-space runs to one blank, trimmed.

    Other white space becomes blanks first (ASCII text is scanned with the much
    cheaper ASCII class), then runs of blanks shrink.
    """
    blanks = F.when(is_ascii(c), F.regexp_replace(c, f"[{_ASCII_SPACE}]", " ")).otherwise(
        F.regexp_replace(c, f"[{_SPACE}]", " "))
    return F.trim(F.regexp_replace(blanks, " {2,}", " "))


def trim_ws(c: Column) -> Column:
    """Trim Unicode white space, not only blanks."""
    return F.btrim(c, F.lit(SPACE_CHARS))


def is_blank(c: Column) -> Column:
    """Null, or nothing but white space."""
    return F.coalesce(trim_ws(c) == "", F.lit(True))


def normalize_text(df: DataFrame, columns: Iterable[str],
                   repair_mojibake: bool = False) -> DataFrame:
    """Run the whole clean-up over ``columns``; other columns pass through.

    The steps are separate projections so that each intermediate text is
    computed once although several expressions look at it.
    """
    names = [c for c in columns if c in df.columns]
    if not names:
        return df

    def each(frame: DataFrame, fn) -> DataFrame:
        return frame.withColumns({n: fn(col(n)) for n in names})

    order = df.columns
    out = each(df, fill_empty)
    out = each(out, strip_tags)
    sent = {f"__sent_{n}": F.when(col(n).contains("&") | needs_nfkc(col(n)), col(n))
            for n in names}
    out = out.withColumns(sent)
    out = out.withColumns(
        {n: F.coalesce(_unescape_nfkc(col(f"__sent_{n}")), col(n)) for n in names}
    ).drop(*sent)
    out = each(out, lambda c: strip_artefacts(c, repair_mojibake))
    out = each(out, expand_contractions)
    out = each(out, ascii_only)
    out = each(out, F.lower)
    out = each(out, collapse_ws)
    return out.select(*[col(n) for n in order])
