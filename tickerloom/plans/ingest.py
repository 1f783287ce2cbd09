"""Ingest a folder of mixed files into cleaned, typed, deduplicated Parquet.

Files are grouped by how they are read (format, separator, header, encoding,
rules). What is known of a file (its plan, its profile, its shape, its outcome) is
a row of a DataFrame; only the distinct plans and shapes reach the driver, which
runs one profiling aggregate per plan and one write per distinct shape. Many folders
of JSON or Parquet files with the same columns are one group. A group's
files are read by their folders, or joined by path where a folder holds others too.
A run is published at once, by one commit at its end.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType, LongType, StringType, StructType, TimestampNTZType, TimestampType,
)

from tickerloom.functions.dates import parse_dates, parse_exact, to_iso_utc
from tickerloom.functions.labels import NUMERIC_LABEL_NAME, as_number, map_numeric_sentiment, title_case
from tickerloom.functions.naming import col, quoted
from tickerloom.functions.text import normalize_text
from tickerloom.operators import columns as P
from tickerloom.operators import roles as R
from tickerloom.operators.aggregates import MIN_PARSE_PERCENT, rows_per, status_totals
from tickerloom.operators.dedup import dedup_keep_unlabelled
from tickerloom.operators.numbering import global_row_number
from tickerloom.rules import FILE_RULES, FOLDER_RULES, FileRule, FolderRule, resolve_rules
from tickerloom.session import shared_dir
from tickerloom.sources import publishing, readers, sinks
from tickerloom.sources.described import described
from tickerloom.sources.listing import (
    list_input_files, probe_text_files, qualified,
)

TEXT_SUFFIXES = (".csv", ".txt", ".tsv", "")
SPREADSHEETS = (".xlsx", ".xls")
# Names differing in case are different columns; nanosecond timestamps arrive as numbers.
READ_CONF = {
    "spark.sql.caseSensitive": "true",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}
PATH, PLACE = readers.PATH, readers.PLACE

MANIFEST_SCHEMA = """
    input_file string, status string, rows_in long, rows_out long, folder_rule string,
    file_rule string, date_column string, text_columns array<string>,
    target_columns array<string>, n_coerced long, valid_pct double, low_rate boolean,
    schema_group int, error string"""


# Groups of so few files are read by their names.
FEW_FILES = 32
# Up to so many groups of JSON and Parquet files are left as they are, one per folder.
FEW_GROUPS = 8
# Paths that are broadcast to pick a group's rows: about 64 MB.
BROADCAST_FILES = 250_000


@dataclass(frozen=True)
class ReadPlan:
    """How the files of one group are read. Equal plans share a group."""
    kind: str                       # delimited | json | parquet
    folder_rule: str | None
    file_rule: str | None
    in_symbol_folder: bool
    sep: str | None = ","
    head: str | None = None         # header line, None when names are imposed
    encoding: str | None = "utf-8"
    multiline: bool = False
    folder: str = ""                # keeps self-describing files of one folder together,
                                    # or a digest of columns: those of all folders that have them
    suffix: str = ""                # theirs


PLAN_FIELDS = list(ReadPlan.__dataclass_fields__)


@dataclass(frozen=True)
class Shape:
    """What is done to a file after reading. Equal shapes share a write."""
    kinds: tuple[tuple[str, str], ...]
    whole: frozenset[str]
    date: str | None

    def to_json(self) -> str:
        return json.dumps([self.kinds, sorted(self.whole), self.date])

    @staticmethod
    def of(text: str) -> Shape:
        kinds, whole, date = json.loads(text)
        return Shape(tuple(map(tuple, kinds)), frozenset(whole), date)


@dataclass(frozen=True)
class Files:
    """The files of a group: ``frame`` has a ``path`` column, ``n`` rows.

    ``paths`` are their names if they are known to the driver. Otherwise ``folders``
    are read; ``alone`` says that these hold no other files (``alone_by_suffix``: no
    others of their suffix), ``nested`` that other folders lie below them.
    """
    frame: DataFrame
    n: int
    paths: tuple[str, ...] | None = None
    folders: tuple[str, ...] = ()
    alone: bool = False
    alone_by_suffix: bool = False
    nested: bool = False

    def named(self) -> Files:
        """The same files by name; for groups that are few or have failed."""
        if self.paths is not None:
            return self
        return replace(self, paths=tuple(r[0] for r in self.frame.select("path").collect()))

    def some(self, paths: tuple[str, ...]) -> Files:
        chosen = self.frame.where(F.col("path").isin(list(paths)))
        return Files(chosen, len(paths), paths)


def by_rule(values: Mapping[str, str | None]) -> Column:
    """A column looked up by ``file_rule``; null for rules without a value."""
    found = [F.when(F.col("file_rule") == k, F.lit(v)) for k, v in values.items() if v]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def plan_id() -> Column:
    return F.sha2(F.to_json(F.struct(*PLAN_FIELDS)), 256)


class Ingest:
    """One run over an input root. ``run`` returns the manifest."""

    def __init__(self, spark: SparkSession, root: str, output: str,
                 folder_rules: Mapping[str, FolderRule] = FOLDER_RULES,
                 file_rules: Mapping[str, FileRule] = FILE_RULES, keep_order: bool = False):
        self.spark = spark
        self.keep_order = keep_order
        self.output = output.rstrip("/")
        self.root = root.rstrip("/")
        self.base = qualified(spark, root)
        self.folder_rules, self.file_rules = folder_rules, file_rules
        self.publication = publishing.Publication(spark, output)
        self._written = 0
        self._folders: list[str] = []

    # -- reading ---------------------------------------------------------------

    def planned(self) -> DataFrame:
        """One row per listed file: path, folder, length, the plan's columns, why refused."""
        files = resolve_rules(list_input_files(self.spark, self.root),
                              self.folder_rules, self.file_rules)
        probes = probe_text_files(self.spark, self.root, [*TEXT_SUFFIXES, ".json"])
        parents = F.slice(F.split("path", "/"), 1, F.size(F.split("path", "/")) - 1)
        rules = self.file_rules
        sep, encoding = ({k: getattr(r, name) for k, r in rules.items()}
                         for name in ("sep", "encoding"))
        named = [k for k, r in rules.items() if r.names]
        textual = F.col("suffix").isin(list(TEXT_SUFFIXES))
        self_describing = ~textual & ~F.col("suffix").isin(list(SPREADSHEETS))
        default_sep = F.when(F.col("suffix") == ".tsv", F.lit("\t")).when(
            F.col("suffix") == "", F.col("sep")).otherwise(F.lit(","))
        json_lines = (F.col("suffix") == ".jsonl") | F.coalesce(
            F.ltrim("head").startswith("{"), F.lit(False))
        planned = files.join(probes, "path", "left").withColumns({
            "kind": F.when(textual, "delimited").when(F.col("suffix") == ".parquet", "parquet")
                     .otherwise("json"),
            "in_symbol_folder": F.exists(parents, lambda p: F.lower(p) == P.SYMBOL_FOLDER),
            "plan_sep": F.when(textual, F.coalesce(by_rule(sep), default_sep)),
            "plan_head": F.when(textual & ~F.coalesce(F.col("file_rule").isin(named), F.lit(False)),
                                F.col("head")),
            "plan_encoding": F.when(textual, F.coalesce(
                by_rule(encoding), F.when(F.col("valid_utf8"), "utf-8").otherwise("latin1"))),
            "multiline": F.when(textual, F.coalesce("open_quotes", F.lit(False)))
                          .otherwise(~json_lines),
            "own_folder": F.array_join(parents, "/"),
            "refused": F.when(F.col("suffix").isin(list(SPREADSHEETS)),
                              "spreadsheets have to be exported to CSV or Parquet")
                        .when(F.col("hidden"), "hidden files cannot be read")
                        .when((F.col("length") == 0) | (textual & F.col("head").isNull()),
                              "no columns to parse from an empty file"),
        })
        empty = F.lit("")
        return self._joined(planned.select(
            "path", "wanted", "hidden", "length", "refused", F.col("own_folder").alias("parent"),
            F.col("suffix").alias("own_suffix"), "kind", "folder_rule", "file_rule",
            "in_symbol_folder", F.col("plan_sep").alias("sep"), F.col("plan_head").alias("head"),
            F.col("plan_encoding").alias("encoding"), "multiline",
            F.when(self_describing, F.col("own_folder")).otherwise(empty).alias("folder"),
            F.when(self_describing, F.col("suffix")).otherwise(empty).alias("suffix"),
        ).withColumn("plan", plan_id()).checkpoint())

    def _joined(self, planned: DataFrame) -> DataFrame:
        """``planned`` with one plan for self-describing files of the same columns.

        Files of one folder are read under one schema. Where all of them say the same of
        their columns, so may those of other folders be, and the schema stays. A group has
        a fixed cost, and folders grow with the input.
        """
        own = planned.where((F.col("folder") != "") & F.col("wanted") & F.col("refused").isNull())
        if own.select("plan").distinct().count() <= FEW_GROUPS:
            return planned
        said = own.select("path", "plan").join(described(own), "path", "left")
        columns = said.groupBy("plan").agg(
            F.min("columns").alias("columns"),
            F.count_distinct(F.coalesce("columns", F.lit(""))).alias("kinds")).where("kinds = 1")
        joined = planned.join(columns.select("plan", "columns"), "plan", "left")
        return joined.withColumn("folder", F.coalesce("columns", "folder")).drop(
            "columns").withColumn("plan", plan_id()).checkpoint()

    def groups(self, planned: DataFrame) -> list[tuple[ReadPlan, Files]]:
        """The distinct plans, each with its files; folders come along, files do not."""
        seen = planned.where(~F.col("hidden") & (F.col("length") > 0))
        self._folders = sorted(r[0] for r in planned.select("parent").distinct().collect())
        # What else a reader of the folder would meet.
        use = F.when(F.col("wanted") & F.col("refused").isNull(), F.col("plan")).otherwise("-")
        mixed = seen.groupBy("parent").agg(F.count_distinct(use).alias("uses"))
        mixed_by_suffix = seen.groupBy("parent", F.col("own_suffix").alias("like")).agg(
            F.count_distinct(use).alias("uses_by_suffix"))
        ready = planned.where(F.col("wanted") & F.col("refused").isNull())
        plans = (ready.join(mixed, "parent")
                 .join(mixed_by_suffix.withColumnRenamed("like", "own_suffix"),
                       ["parent", "own_suffix"])
                 .groupBy("plan").agg(
                     *[F.first(c).alias(c) for c in PLAN_FIELDS], F.count("*").alias("n"),
                     F.sort_array(F.collect_set("parent")).alias("parents"),
                     F.max("uses").alias("uses"), F.max("uses_by_suffix").alias("uses_by_suffix"))
                 .orderBy("plan").collect())
        return [(ReadPlan(**{c: r[c] for c in PLAN_FIELDS}),
                 Files(ready.where(F.col("plan") == r.plan).select("path"), r.n, None,
                       tuple(r.parents), r.uses == 1, r.uses_by_suffix == 1,
                       any(self._nested(f) for f in r.parents))) for r in plans]

    def _nested(self, folder: str) -> bool:
        place = bisect_right(self._folders, folder + "/")
        return place < len(self._folders) and self._folders[place].startswith(folder + "/")

    def load(self, plan: ReadPlan, files: Files) -> DataFrame:
        """The group's rows after the schema tweaks, with path and place."""
        rule = self.file_rules.get(plan.file_rule, FileRule())
        if plan.kind != "delimited":
            df = self._self_describing(plan, files)
        else:
            files = files.named() if files.n <= FEW_FILES else files
            names = list(rule.names or readers.header_names(plan.head, plan.sep))
            df = readers.read_delimited(
                self.spark, list(files.paths or files.folders), names, sep=plan.sep,
                header=rule.names is None, encoding=plan.encoding, multiline=plan.multiline)
            if files.paths is None:
                df = self._only(df, files)
        if rule.melt:
            df = self._melted(df)
        df = P.drop_columns(P.rename_columns(df, dict(rule.rename)), rule.drop)
        if plan.in_symbol_folder:
            df = P.inject_symbol(df, F.col(PATH))
        df = P.canonical_names(df)
        if self.folder_rules.get(plan.folder_rule, FolderRule()).drop_unnamed:
            df = P.drop_unnamed(df)
        return df

    def _self_describing(self, plan: ReadPlan, files: Files) -> DataFrame:
        """JSON and Parquet take their schema from what they read, so from members only."""
        whole = files.alone_by_suffix and not files.nested and files.n > FEW_FILES
        files = files if whole else files.named()
        paths, suffix = list(files.paths or files.folders), plan.suffix if whole else None
        if plan.kind == "parquet":
            return readers.read_parquet(self.spark, paths, suffix)
        return readers.read_json(self.spark, paths, lines=not plan.multiline, suffix=suffix)

    def _only(self, df: DataFrame, files: Files) -> DataFrame:
        """The rows of the group's files among those of its folders.

        Folders below are left out by their paths before they are opened.
        """
        if files.nested:
            parent = F.regexp_replace(col(PATH), "/[^/]*$", "")
            df = df.where(parent.isin(list(files.folders)))
        if files.alone:
            return df
        members = files.frame.select(F.col("path").alias(PATH))
        return df.join(F.broadcast(members) if files.n <= BROADCAST_FILES else members,
                       PATH, "left_semi")

    def _melted(self, df: DataFrame) -> DataFrame:
        date = R.infer_roles(df, (PATH, PLACE)).date
        keep = [PATH, PLACE]
        values = [c for c in df.columns if c not in (*keep, date)]
        wide = df.select(*keep, *([col(date).alias("date")] if date else []),
                         *[col(c).cast("string").alias(c) for c in values])
        ids = [*keep, *(["date"] if date else [])]
        long = wide.unpivot(ids, [col(c) for c in values], "__src", "text")
        # Column after column, each from top to bottom.
        column = F.array_position(F.array(*map(F.lit, values)), col("__src"))
        return long.where("text is not null").withColumn(
            PLACE, F.struct(column.alias("column"), col(PLACE).alias("row"))).drop("__src")

    # -- deciding --------------------------------------------------------------

    def decide(self, plan: ReadPlan, df: DataFrame) -> DataFrame:
        """(path, shape, n_rows, n_parsed, n_present) per file, from one aggregate.

        Likely date columns are parsed in the same pass, so their parse rate
        needs no second look at the data. The aggregate's rows become kinds and
        shapes where they lie.
        """
        names = [c for c in df.columns if c not in (PATH, PLACE)]
        schema = {n: df.schema[n].dataType for n in names}
        strings = [n for n in names if isinstance(schema[n], StringType)]
        likely = [n for n, s in R.base_scores({n: R.STRING for n in names}).items() if s > 0]
        rule = self.file_rules.get(plan.file_rule, FileRule())
        likely = [] if rule.skip_dates else likely
        looked = df
        extra: list[Column] = []
        for index, name in enumerate(likely):
            looked = self._parsed(plan, looked, name, f"__ts{index}")
            extra.append(F.count(F.col(f"__ts{index}")).alias(f"{name}__parsed"))
            if name not in strings:
                extra.append(F.count(col(name)).alias(f"{name}__non_null"))
        for n in strings:
            digits = col(n).rlike(r"^\s*[+-]?\d+\s*$")
            extra += [F.count_if(digits).alias(f"{n}__digits"),
                      F.count_if(digits & F.trim(col(n)).try_cast("long").isNotNull())
                      .alias(f"{n}__whole")]
        counted = R.profile(looked, [PATH], strings, extra)
        counted = counted.select(F.col(PATH).alias("path"), F.to_json(F.struct(*[
            col(c) for c in counted.columns if c != PATH])).alias("counts"))
        return self._shaped(self._with_rates(counted, df, schema, rule.skip_dates), schema,
                            strings, rule.skip_dates)

    def _with_rates(self, counted: DataFrame, df: DataFrame, schema: Mapping,
                    skip_dates: bool) -> DataFrame:
        """``counted`` with the parse rates, as JSON, of columns that names leave undecided."""
        if skip_dates:
            return counted.withColumn("rates", F.lit(None).cast("string"))

        def undecided(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                counts = batch.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(
                    [R.undecided(R.kinds_of(json.loads(c), schema)) for c in counts],
                    pa.list_(pa.string()))], names=["path", "counts", "open"])

        first = counted.mapInArrow(
            undecided, "path string, counts string, open array<string>").checkpoint()
        names = sorted(r[0] for r in first.select(F.explode("open")).distinct().collect())
        if not names:
            return first.drop("open").withColumn("rates", F.lit(None).cast("string"))
        some = first.where(F.size("open") > 0).select(F.col("path").alias(PATH))
        rates = R.parse_rates(df.join(some, PATH, "left_semi"), [PATH], names)
        rates = rates.select(F.col(PATH).alias("path"), F.to_json(F.struct(
            *[col(n) for n in names])).alias("rates"))
        return first.join(rates, "path", "left").select("path", "counts", "open", "rates")

    def _shaped(self, counted: DataFrame, schema: Mapping, strings: list[str],
                skip_dates: bool) -> DataFrame:
        out = "path string, shape string, n_rows long, n_parsed long, n_present long"

        def shape_of(counts: dict, rates: dict, open_columns: list) -> tuple[Shape, int, int]:
            kinds = R.kinds_of(counts, schema)
            date = None if skip_dates else R.pick_date_column(
                kinds, {n: rates[n] for n in open_columns if rates.get(n) is not None})
            # Digits that no long holds stay text: a double would merge different ids.
            for n in strings:
                if counts[f"{n}__whole"] < counts[f"{n}__digits"]:
                    kinds[n] = R.STRING
            whole = frozenset(n for n in strings if kinds[n] == R.NUMBER
                              and counts[f"{n}__whole"] == counts["n_rows"])
            return (Shape(tuple(kinds.items()), whole, date), counts.get(f"{date}__parsed"),
                    counts.get(f"{date}__non_null"))

        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                rows = []
                for row in batch.to_pylist():
                    counts = json.loads(row["counts"])
                    rates = json.loads(row["rates"]) if row["rates"] else {}
                    shape, parsed, present = shape_of(
                        counts, rates, row.get("open") or list(rates))
                    rows.append((row["path"], shape.to_json(), counts["n_rows"], parsed, present))
                columns = list(zip(*rows)) or [()] * 5
                kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["path", "shape", "n_rows", "n_parsed", "n_present"])

        return counted.mapInArrow(run, out).checkpoint()

    def _parsed(self, plan: ReadPlan, df: DataFrame, source: str, target: str) -> DataFrame:
        rule = self.folder_rules.get(plan.folder_rule, FolderRule())
        kind = df.schema[source].dataType
        if isinstance(kind, (TimestampType, TimestampNTZType, DateType)):
            return df.withColumn(target, col(source).cast("timestamp"))
        if isinstance(kind, LongType):
            return self._parsed_number(df, source, target)
        return parse_dates(df, source, target, pattern=rule.date_pattern,
                           complex_dates=rule.complex_dates, day_first=rule.day_first)

    def _parsed_number(self, df: DataFrame, source: str, target: str) -> DataFrame:
        """Whole numbers: ``yyyymmdd`` when they have eight digits, else epoch nanoseconds."""
        digits = col(source).between(10_000_000, 99_999_999)
        day = parse_exact(F.when(digits, col(source)))
        return df.withColumn(target, F.coalesce(
            day, F.when(~digits, F.timestamp_micros(F.expr(f"{quoted(source)} div 1000")))))

    # -- transforming ----------------------------------------------------------

    def transform(self, plan: ReadPlan, shape: Shape, df: DataFrame) -> DataFrame:
        """Labels, dates, text, types and dedup for files of one shape."""
        rule = self.folder_rules.get(plan.folder_rule, FolderRule())
        kinds = dict(shape.kinds)
        targets = R.infer_target_columns(list(kinds))
        texts = R.infer_text_columns(kinds)
        order = df.columns
        if rule.sentiment_names:
            for name in self._numeric_labels(kinds):
                df = df.withColumn(name, map_numeric_sentiment(
                    col(name), dict(rule.sentiment_names)))
                kinds[name] = R.STRING
        if shape.date:
            df = self._parsed(plan, df, shape.date, "__ts")
            df = df.withColumn(shape.date, to_iso_utc(F.col("__ts"))).drop("__ts")
        typed = {n: F.trim(col(n)).try_cast("long") if n in shape.whole else as_number(col(n))
                 for n, kind in kinds.items()
                 if kind == R.NUMBER and n != shape.date
                 and isinstance(df.schema[n].dataType, StringType)}
        if typed:
            df = df.withColumns(typed)
        df = normalize_text(df, texts)
        named = {t: title_case(col(t)) for t in targets if kinds[t] == R.STRING}
        if named:
            df = df.withColumns(named)
        if self.keep_order:
            return dedup_keep_unlabelled(df.select(*[col(c) for c in order]), targets, PLACE)
        return dedup_keep_unlabelled(df.select(*[col(c) for c in order if c != PLACE]), targets)

    def _numeric_labels(self, kinds: Mapping[str, str]) -> list[str]:
        return [n for n in kinds if re.search(NUMERIC_LABEL_NAME, n, re.I)]

    # -- running ---------------------------------------------------------------

    def run(self) -> DataFrame:
        """Ingest everything, publish it, and return the manifest."""
        shared_dir(self.spark)
        conf = self.spark.conf
        before = {name: conf.get(name) for name in READ_CONF}
        for name, value in READ_CONF.items():
            conf.set(name, value)
        try:
            with self.publication as run:
                planned = self.planned()
                self._record(self._failed(
                    planned.where(F.col("wanted") & F.col("refused").isNotNull()),
                    F.col("refused")))
                for plan, files in self.groups(planned):
                    self._isolated(plan, files)
                run.commit()
        finally:
            for name, value in before.items():
                conf.set(name, value)
        return self.spark.read.parquet(f"{self.publication.folder}/_manifest")

    def _record(self, rows: DataFrame) -> None:
        sinks.append_manifest(rows, f"{self.publication.folder}/_manifest")

    def _isolated(self, plan: ReadPlan, files: Files) -> None:
        """A group at once, and by halves when it fails, so a bad file fails alone.

        Only then do the names of its files come to the driver. What a failed
        attempt has written goes before the halves begin; nothing of it was public.
        """
        before = self._written
        try:
            records = self._group(plan, files)
        except Exception as error:
            for group in range(before, self._written + 1):
                publishing.remove(self.spark, f"{self.publication.folder}/schema_group={group}")
            self._written = before
            paths = files.named().paths
            if len(paths) > 1:
                half = len(paths) // 2
                self._isolated(plan, files.some(paths[:half]))
                self._isolated(plan, files.some(paths[half:]))
                return
            reason = f"{type(error).__name__}: {error}"
            records = self._failed(files.frame, F.lit(reason), plan)
        self._record(records)

    def _group(self, plan: ReadPlan, files: Files) -> DataFrame:
        decided = self.decide(plan, self.load(plan, files))
        shapes = decided.groupBy("shape").agg(F.count("*").alias("n")).orderBy("shape").collect()
        records = [self._failed(files.frame.join(decided.select("path"), "path", "left_anti"),
                                F.lit("no rows could be read"), plan)]
        prepared = []
        for row in shapes:
            members = decided.where(F.col("shape") == row["shape"])
            some = files
            if len(shapes) > 1:
                some = replace(files, frame=members.select("path"), n=row["n"], paths=None,
                               alone=False, alone_by_suffix=False)
            shape = Shape.of(row["shape"])
            prepared.append((shape, members, self.transform(plan, shape, self.load(plan, some))))
        for shape, members, rows in prepared:
            records.append(self._succeeded(plan, shape, members, self._write(rows)))
        return reduce(DataFrame.unionByName, records)

    def _inside(self, path: Column) -> dict[str, Column]:
        inside = F.substr(path, F.lit(len(self.base) + 2))
        return {
            "source_folder": F.when(inside.contains("/"), F.regexp_replace(
                inside, "/[^/]*$", "")).otherwise(F.lit(".")),
            "source_file": F.substring_index(inside, "/", -1),
        }

    def _write(self, rows: DataFrame) -> int:
        group = self._written
        placed = rows.withColumns(self._inside(F.col(PATH))).drop(PATH)
        folder = self.publication.folder
        if self.keep_order:
            sinks.write_ordered_tree(placed, f"{folder}/schema_group={group}", PLACE)
        else:
            sinks.write_parquet_tree(placed.withColumn("schema_group", F.lit(group)), folder)
        self._written += 1
        return group

    def rows_out(self, group: int) -> DataFrame:
        """Rows written per file; reads Parquet footers only."""
        written = read_group(self.spark, self.publication.folder, group)
        return rows_per(written, ["source_folder", "source_file"], "rows_out")

    def _succeeded(self, plan: ReadPlan, shape: Shape, members: DataFrame,
                   group: int) -> DataFrame:
        kinds = dict(shape.kinds)
        place = ["source_folder", "source_file"]
        counted = members.withColumns(self._inside(F.col("path"))).join(
            self.rows_out(group), place, "left")
        percent = F.expr("if(n_rows > 0, 100.0D * n_parsed / n_rows, null)")
        return self._manifest_rows(counted, plan, {
            "status": F.lit("success"), "rows_in": F.col("n_rows"),
            "rows_out": F.coalesce("rows_out", F.lit(0).cast("long")),
            "date_column": F.lit(shape.date),
            "text_columns": F.array(*map(F.lit, R.infer_text_columns(kinds))),
            "target_columns": F.array(*map(F.lit, R.infer_target_columns(list(kinds)))),
            "n_coerced": F.expr("n_present - n_parsed"), "valid_pct": percent,
            "low_rate": percent < MIN_PARSE_PERCENT, "schema_group": F.lit(group)})

    def _failed(self, files: DataFrame, reason: Column, plan: ReadPlan | None = None) -> DataFrame:
        return self._manifest_rows(files, plan, {
            "status": F.lit("failed"), "rows_in": F.lit(0), "rows_out": F.lit(0),
            "text_columns": F.array(), "target_columns": F.array(), "error": reason})

    def _manifest_rows(self, files: DataFrame, plan: ReadPlan | None,
                       known: Mapping[str, Column]) -> DataFrame:
        if plan is not None:
            known = {**known, "folder_rule": F.lit(plan.folder_rule),
                     "file_rule": F.lit(plan.file_rule)}
        known = {**known, "input_file": F.col("path")}
        return files.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                              for f in StructType.fromDDL(MANIFEST_SCHEMA)])


def ingest(spark: SparkSession, root: str, output: str, **rules) -> DataFrame:
    """Run the whole flow; returns the manifest, one row per input file.

    ``keep_order=True`` writes the rows of a file in the order they had there, for one
    more shuffle; of equal rows the first stays. ``read_in_order`` gives them so.
    """
    return Ingest(spark, root, output, **rules).run()


def read_manifest(spark: SparkSession, output: str) -> DataFrame:
    """The manifest of the published run."""
    return spark.read.parquet(f"{_published(spark, output)}/_manifest")


def read_ingested(spark: SparkSession, output: str, group: int) -> DataFrame:
    """The cleaned rows of one schema group of the published run, with their source."""
    return read_group(spark, _published(spark, output), group)


def read_in_order(spark: SparkSession, output: str, group: int,
                  number: str = "line") -> DataFrame:
    """``read_ingested`` with rows numbered from 1 by folder, file and place in the file.

    Meant for outputs written with ``keep_order``: a row's part file and its place there
    give the order.
    """
    rows = read_ingested(spark, output, group).select(
        "*", F.col("_metadata.file_name").alias("__part_file"),
        F.col("_metadata.row_index").alias("__row"))
    order = [F.col(c) for c in ("source_folder", "source_file", "__part_file", "__row")]
    return global_row_number(rows, order, number).drop("__part_file", "__row")


def _published(spark: SparkSession, output: str) -> str:
    folder = publishing.committed(spark, output)
    if folder is None:
        raise FileNotFoundError(f"nothing has been published in {output}")
    return folder


def read_group(spark: SparkSession, folder: str, group: int) -> DataFrame:
    """The rows of a group of a run.

    Folder names stay text, also where they look like numbers; Spark decides
    that when the path is read, by a session setting.
    """
    inference = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(inference)
    spark.conf.set(inference, "false")
    try:
        return spark.read.option("basePath", folder).parquet(f"{folder}/schema_group={group}")
    finally:
        spark.conf.set(inference, before)


def totals(manifest: DataFrame) -> DataFrame:
    return status_totals(manifest)
