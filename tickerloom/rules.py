"""Folder and file rules, and which of them govern a file."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FolderRule:
    """Applies to every file below a folder of that name."""
    date_pattern: str | None = None
    complex_dates: bool = False
    day_first: bool = False
    drop_unnamed: bool = False
    sentiment_names: Mapping[float, str] = field(default_factory=dict)


@dataclass(frozen=True)
class FileRule:
    """Applies to a file of that (lower-case) name anywhere."""
    sep: str | None = None
    names: tuple[str, ...] | None = None   # no header row: these are the columns
    encoding: str | None = None
    rename: Mapping[str, str] = field(default_factory=dict)
    drop: tuple[str, ...] = ()
    skip_dates: bool = False
    melt: bool = False


# --- fixed values -----------------------------------------------------------
FOLDER_RULES: dict[str, FolderRule] = {
    "Sentiment Analysis for Financial News": FolderRule(),
    "Stock market prediction business news India": FolderRule(),
    "Stock Market Prediction  India news headlines": FolderRule(date_pattern="yyyyMMdd"),
    "Indian financial news articles 2003 to 2020": FolderRule(complex_dates=True),
    "News_sentiments_india 2001 to 2022": FolderRule(
        sentiment_names={-1.0: "Negative", 0.0: "Neutral", 1.0: "Positive"}),
    "Business News Headlines with Sentiment (2017-2021)": FolderRule(
        drop_unnamed=True, day_first=True),
    "Business News Description with sentiment": FolderRule(drop_unnamed=True, day_first=True),
    "Economic Times Headlines India 2022 to 2025": FolderRule(day_first=True),
}

_AGREEMENT = FileRule(sep="@", names=("text", "sentiment"))
_NEWS_LIST = {"Text": "text", "Date": "date"}

FILE_RULES: dict[str, FileRule] = {
    "all-data.csv": FileRule(names=("sentiment", "text"), encoding="latin1"),
    "sentences_50agree.txt": _AGREEMENT,
    "sentences_66agree.txt": _AGREEMENT,
    "sentences_75agree.txt": _AGREEMENT,
    "sentences_allagree.txt": _AGREEMENT,
    **{f"mnews_{year}.xlsx": FileRule(melt=True) for year in range(2014, 2021)},
    "india-news-headlines.csv": FileRule(names=("Date", "Category", "Headline")),
    "final_news_sentiment_analysis.csv": FileRule(
        names=("company", "symbol", "text", "date", "sentiment")),
    "gnew_list_2021_processed.csv": FileRule(rename=_NEWS_LIST, drop=("Unnamed: 2",)),
    "gnew_list_2022_processed.csv": FileRule(rename=_NEWS_LIST),
    "gnew_list_2023_processed.csv": FileRule(rename=_NEWS_LIST),
    "training_data_26000.csv": FileRule(skip_dates=True),
    "data_raw.csv": FileRule(skip_dates=True),
    "info.csv": FileRule(skip_dates=True),
}
# ----------------------------------------------------------------------------


def resolve_rules(files: DataFrame, folder_rules: Mapping[str, FolderRule] = FOLDER_RULES,
                  file_rules: Mapping[str, FileRule] = FILE_RULES) -> DataFrame:
    """Adds ``folder_rule`` and ``file_rule`` keys to a listing with ``path``.

    The nearest ancestor folder that has a rule wins; file rules go by the
    lower-case file name. A wide-table rule kept under a spreadsheet name also
    governs the same table exported to another format. Rules are a fixed small
    set, so they are looked up in the row instead of joined.
    """
    parts = F.split("path", "/")
    ancestors = F.reverse(F.slice(parts, 1, F.size(parts) - 1))
    governed = F.filter(ancestors, lambda name: name.isin(list(folder_rules)))
    name = F.lower(F.element_at(parts, -1))
    twin = F.concat(F.regexp_replace(name, r"\.[^.]*$", ""), F.lit(".xlsx"))
    wide = [key for key, rule in file_rules.items() if rule.melt]
    return files.withColumns({
        "folder_rule": F.get(governed, F.lit(0)),
        "file_rule": F.when(name.isin(list(file_rules)), name)
                      .when(twin.isin(wide), twin),
    })
