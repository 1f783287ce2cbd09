"""What self-describing files say of their columns, one short text per file.

Files with the same text get the same schema from Spark's readers, alone or together.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.sources.listing import opened

# Larger files are not looked at; a reader's fixed cost is small beside them.
DESCRIBED_BYTES = 64 << 20
# Bytes that a task looks at.
TASK_BYTES = 16 << 20


class _Object(tuple):
    """(name, kind) of the fields of a JSON object, by name."""


def _kind(value):
    """Kind of a JSON value as Spark infers types; an empty string says no more than a null."""
    if value is None or value == "":
        return "null"
    if isinstance(value, (_Object, list)):
        return value if isinstance(value, _Object) else ("list", frozenset(map(_kind, value)))
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, int):
        return "long" if -2**63 <= value < 2**63 else f"integer of {len(str(abs(value)))}"
    return "double" if isinstance(value, float) else "string"


def _merged(kinds: Iterable) -> list:
    """The kinds a value has in several records as nested lists in a fixed order."""
    kinds = list(kinds)
    out: list = sorted({k for k in kinds if isinstance(k, str)} - {"null"})
    objects = [k for k in kinds if isinstance(k, _Object)]
    if objects:
        out.append(["object", _fields(objects)])
    lists = [k[1] for k in kinds if isinstance(k, tuple) and not isinstance(k, _Object)]
    if lists:
        out.append(["list", _merged(frozenset().union(*lists))])
    return out or ["null"]


def _fields(objects: Iterable[_Object]) -> list:
    fields: dict[str, set] = {}
    for one in objects:
        for name, kind in one:
            fields.setdefault(name, set()).add(kind)
    return [[name, _merged(fields[name])] for name in sorted(fields)]


def json_columns(data: bytes, multiline: bool) -> str:
    """The columns of a JSON document, or of one record per line; an error if it is odd."""
    seen: dict[_Object, _Object] = {}

    def shape(pairs: list) -> _Object:
        one = _Object(sorted(((name, _kind(value)) for name, value in pairs), key=lambda p: p[0]))
        if len({name for name, _ in one}) < len(one):
            raise ValueError("a name occurs twice")
        return seen.setdefault(one, one)

    if multiline:
        found = json.loads(data, object_pairs_hook=shape)
        records = set(found) if isinstance(found, list) else {found}
    else:
        lines = [line for line in map(bytes.strip, data.split(b"\n")) if line]
        if any(b"\r" in line for line in lines):
            raise ValueError("another line end")
        records = {json.loads(line, object_pairs_hook=shape) for line in lines}
    if not all(isinstance(r, _Object) for r in records) or not any(records):
        raise ValueError("not a table")
    return json.dumps(_fields(records))


def parquet_columns(file) -> str:
    """The columns of a Parquet file, from its footer."""
    import pyarrow.parquet as pq

    footer = pq.ParquetFile(file).metadata
    own = (footer.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"")
    return str(footer.schema).split("\n", 1)[1] + own.decode("utf-8", "replace")


def described(files: DataFrame) -> DataFrame:
    """(path, columns) for ``files`` (path, length, kind, multiline); null where unknown.

    ``columns`` is a digest of what a file says of them. Large and odd files have none.
    """
    files = files.where((F.col("kind") == "parquet") | (F.col("length") <= DESCRIBED_BYTES))
    total, n = files.agg(F.sum("length"), F.count("*")).first()
    tasks = max(files.sparkSession.sparkContext.defaultParallelism, (total or 0) // TASK_BYTES)
    files = files.select("path", "kind", "multiline").repartition(max(1, min(tasks, n)))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            made = []
            for path, kind, multiline in zip(*(c.to_pylist() for c in batch.columns)):
                try:
                    system, inner = opened(path)
                    with system.open_input_file(inner) as file:
                        said = (parquet_columns(file) if kind == "parquet"
                                else json_columns(file.read(), multiline))
                    made.append(hashlib.sha256(said.encode("utf-8")).hexdigest())
                except Exception:  # whatever it is, the readers will say so
                    made.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made, pa.string())], names=["path", "columns"])

    return files.mapInArrow(run, "path string, columns string")
