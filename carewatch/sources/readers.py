"""Sources (A1-A8, A10, A11). Every reader returns a lazy DataFrame; raw text columns
stay strings until a contract (`operators.contracts`) parses them."""

from __future__ import annotations

import csv
import itertools
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import clean
from .versions import current, publish, publish_table


@dataclass(frozen=True)
class Header:
    """The column names of a header line and the files that have it."""
    names: tuple[str, ...]
    files: tuple[str, ...]


#: One file a task while headers are scanned: an open cost above any file's size.
_WHOLE_FILE = str(1 << 40)


def _column_names(line: str, sep: str, quotes: str) -> tuple[str, ...]:
    """Names of a header line, as Spark names columns: an empty one `_c<i>`, a repeated one with its number."""
    cells = next(csv.reader([line.lstrip("\ufeff")], delimiter=sep, quotechar='"'), [])
    cells = [c.strip().strip(quotes).strip() if quotes else c for c in cells]
    often = Counter(c.lower() for c in cells)
    return tuple(f"_c{i}" if not c else f"{c}{i}" if often[c.lower()] > 1 else c for i, c in enumerate(cells))


def file_headers(spark: SparkSession, path: str | Sequence[str], sep: str = ",", encoding: str | None = None,
                 marker: str | None = None, quotes: str = "") -> list[Header]:
    """The different headers of the text files at `path`, each with its files, in the order of the first
    ones. A header is a file's first line, or with `marker` the first line that contains it; a
    file without one is empty, or with `marker` an error.

    One task a file reads lines until it has the header and stops there, so the scan costs the first
    buffers of each file. The driver gets one line a file, as it holds one entry a file of any table."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line"))

    def first_lines(batches):
        for batch in batches:
            for file, line in zip(batch.column(0), batch.column(1), strict=True):
                text = line.as_py().decode(encoding or "utf-8", "replace")
                if marker is None or marker in text:
                    yield pa.RecordBatch.from_pydict({"file": [file.as_py()], "line": [text]})
                    return
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    held = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, _WHOLE_FILE)
        found = {r["file"]: r["line"] for r in lines.mapInArrow(first_lines, "file string, line string").collect()}
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    plain = lambda uri: re.sub("^([A-Za-z0-9+.-]+):/+", r"\1:/", uri)  # noqa: E731  file:/x and file:///x are one
    have = {plain(f) for f in found}
    if marker is not None and (bare := sorted(f for f in lines.inputFiles() if plain(f) not in have)):
        raise ValueError(f"header marker {marker!r} not found in {bare[:5]}")
    by: dict[tuple[str, ...], list[str]] = {}
    for file in sorted(found):
        by.setdefault(_column_names(found[file], sep, quotes), []).append(unquote(file))
    return [Header(names, tuple(files)) for names, files in by.items()]


def _by_name(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def _text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_text_table(spark: SparkSession, path: str | Sequence[str], fmt: str = "csv",
                    blanks_to_null: bool = True, encoding: str | None = None, sep: str = ",",
                    schema: T.StructType | str | None = None, where: Column | None = None,
                    partitions: int | None = None, same_header: bool = False) -> DataFrame:
    """CSV / gzip CSV / legacy-encoded CSV with every column a string (A1, A2, A3).

    Every file is bound by its own header: files are grouped by header (`file_headers`) and the groups
    united by name, so files of other column orders, or without some columns (NULL), are read
    right. `same_header` skips the scan where all files are known to be alike; an explicit `schema`
    binds by position. No schema inference (stable types). Blank cells become NULL. Gzip files
    are not splittable: pass `partitions` to spread rows before heavy work."""
    if encoding:  # cp1252 and the like are no charsets of Spark's own list
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")

    def load(files, bound):
        r = spark.read.option("header", True).option("inferSchema", False).option("sep", sep) \
            .option("multiLine", False).option("escape", '"')
        if encoding:
            r = r.option("encoding", encoding)
        if bound is not None:
            r = r.schema(bound)
        if files is not path and isinstance(path, str) and any("=" in f.rsplit("/", 2)[-2] for f in files):
            r = r.option("basePath", path)  # scope folders are columns
        return r.format(fmt).load(files)
    headers = [] if schema is not None or same_header or fmt != "csv" else file_headers(spark, path, sep, encoding)
    if len(headers) > 1:
        df = _by_name([load(list(h.files), _text_schema(h.names)) for h in headers])
    else:
        df = load(path, schema)
    if blanks_to_null:
        df = df.select(*[F.when(clean(F.col(f"`{c}`")) == "", F.lit(None).cast("string"))
                         .otherwise(F.col(f"`{c}`")).alias(c) for c in df.columns])
    if where is not None:
        df = df.where(where)
    if partitions:
        df = df.repartition(partitions)
    return df


def read_csv_with_preamble(spark: SparkSession, path: str, header_marker: str, sep: str = ",",
                           encoding: str | None = None) -> DataFrame:
    """CSV whose header is not on line 1 (A4): each file is bound by the names of its own header, the
    first line that contains `header_marker`; what stands before it is no data.

    Files are read in splits like any text: the task that has a file's first split drops the lines up
    to the header, the others hold data alone (the preamble is shorter than a split; a first
    split without the header is an error). Adds `_source_file` and `_seq`, which ascends with the
    lines of a file."""
    def body(batches):
        found, current = True, None
        for batch in batches:
            files, starts = batch.column(0).dictionary_encode(), np.asarray(batch.column(1))
            codes, names = np.asarray(files.indices), files.dictionary.to_pylist()
            # runs of one split: a file's splits may be packed into one task
            cuts = [0, *(np.flatnonzero((np.diff(codes) != 0) | (np.diff(starts) != 0)) + 1).tolist(), len(codes)]
            for a, b in itertools.pairwise(cuts):
                if (split := (names[codes[a]], int(starts[a]))) != current:
                    if not found:
                        raise ValueError(f"no header in the first split of {current[0]}")
                    current, found = split, starts[a] != 0
                lines = batch.column(2).slice(a, b - a)
                at = 0
                if not found:
                    at = next((i + 1 for i, line in enumerate(lines) if marker in line.as_py()), b - a)
                    found = at < b - a or marker in lines[b - a - 1].as_py()
                if at < b - a:
                    text = lines.slice(at)
                    if encoding:
                        text = pa.array([line.decode(encoding) for line in text.to_pylist()], pa.string())
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(a + at, b - a - at), batch.column(1).slice(
                        a + at, b - a - at), batch.column(3).slice(a + at, b - a - at), text.cast(pa.string())],
                        names=["file", "start", "n", "line"])
        if not found:
            raise ValueError(f"no header in the first split of {current[0]}")
    marker = header_marker.encode(encoding or "utf-8")
    parts = []
    for h in file_headers(spark, path, sep, encoding, header_marker, quotes="'\""):
        raw = spark.read.text(list(h.files)).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
            F.col("value").cast("binary").alias("line"), F.monotonically_increasing_id().alias("n"))
        lines = raw.mapInArrow(body, "file string, start long, n long, line string").where(F.length(F.trim("line")) > 0)
        ddl = ", ".join(f"`c{i}` string" for i in range(len(h.names)))
        # the splits of a file in order, then its lines: 33 bits count the lines of a task
        seq = F.shiftleft("start", 20) + F.col("n").bitwiseAND((1 << 33) - 1)
        parsed = lines.select("file", seq.alias("seq"), F.from_csv("line", ddl, {"sep": sep}).alias("r"))
        parts.append(parsed.select(*[F.col(f"r.c{i}").alias(n) for i, n in enumerate(h.names)],
                                   F.col("file").alias("_source_file"), F.col("seq").alias("_seq")))
    return _by_name(parts)


def read_columns(spark: SparkSession, path: str, cols: Sequence[str], where: Column | None = None) -> DataFrame:
    """Columnar scan with pruning (A5) and pushed-down filter."""
    df = spark.read.parquet(path).select(*cols)
    return df.where(where) if where is not None else df


def read_pages(spark: SparkSession, path: str, wrapper: str | None = "results",
               schema: T.StructType | None = None, where: Column | None = None) -> DataFrame:
    """Landed API pages -> one row per record.

    A page is either `{"count": n, "results": [...]}` (wrapper="results") or a bare
    array (wrapper=None). Each record keeps provenance `_source_file`, the page's
    declared `_declared` count (wrapped pages) and its position `_pos` in the page, so
    file order can be reproduced (T18) with (_source_file, _pos)."""
    if wrapper:
        page_schema = None
        if schema is not None:
            page_schema = T.StructType([T.StructField("count", T.LongType()),
                                        T.StructField(wrapper, T.ArrayType(schema))])
        r = spark.read.option("multiLine", True)
        if page_schema is not None:
            r = r.schema(page_schema)
        pages = r.json(path).select(F.col("_metadata.file_path").alias("_source_file"),
                                    F.col("count").cast("long").alias("_declared"), F.col(wrapper).alias("_arr"))
    else:
        raw = spark.read.text(path, wholetext=True)
        arr_t = T.ArrayType(schema) if schema is not None else T.ArrayType(T.MapType(T.StringType(), T.StringType()))
        pages = raw.select(F.col("_metadata.file_path").alias("_source_file"),
                           F.lit(None).cast("long").alias("_declared"),
                           F.from_json("value", arr_t).alias("_arr"))
    rec = pages.select("_source_file", "_declared", F.posexplode("_arr").alias("_pos", "_rec"))
    if isinstance(rec.schema["_rec"].dataType, T.StructType):
        out = rec.select("_rec.*", "_source_file", "_declared", "_pos")
    else:  # bare arrays without a schema: records stay maps
        out = rec
    return out.where(where) if where is not None else out


def read_array_rows(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Array-of-arrays JSON whose row 0 is the header of its file (A8): every row of a file is bound by
    that header, so files may differ in the order and choice of columns. `columns` are the ones
    wanted, else all that any file has (one pass over the headers); a column that a file lacks is NULL.

    A file is parsed once to a VARIANT, whose rows are generated one by one with the header beside
    them; cells are text, whatever their JSON type."""
    raw = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("_source_file"), F.parse_json("value").alias("_v"))
    raw = raw.withColumn("_header", F.variant_get("_v", "$[0]", "array<string>"))
    if columns is None:
        heads = raw.select("_source_file", F.posexplode("_header").alias("at", "name")).groupBy("name").agg(
            F.min(F.struct("_source_file", "at")).alias("first")).orderBy("first").collect()
        columns = [r["name"] for r in heads]
    rows = raw.lateralJoin(spark.tvf.variant_explode(F.col("_v").outer()).select(
        F.col("pos").alias("_pos"), F.col("value").alias("_row"))).where("_pos > 0")
    cells = rows.select("_source_file", "_pos", "_header", F.expr("CAST(_row AS array<string>)").alias("_r"))

    def cell(name):
        at = F.array_position("_header", F.lit(name)).cast("int")
        return F.when(at > 0, F.try_element_at("_r", at)).alias(name)
    return cells.select(*[cell(c) for c in columns], "_source_file", "_pos")


def load_table(spark: SparkSession, csv_path: str, schema: T.StructType | str, target: str,
               as_table: bool = False, min_rows: int = 1) -> DataFrame:
    """Bulk load a CSV with an explicit schema (A10): the target's content is replaced once the new rows
    are written and checked (`versions`), never before."""
    df = spark.read.option("header", True).schema(schema).csv(csv_path)
    if as_table:
        publish_table(df, target, min_rows=min_rows, same_fields=False)
        return spark.table(target)
    publish(df, target, min_rows=min_rows, same_fields=False)
    return current(spark, target)


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool) or not isinstance(value, str):
        return str(value) if not hasattr(value, "isoformat") else f"'{value.isoformat()}'"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A small in-program table (A11) as inline values: a local relation of known size, which
    the planner broadcasts by its bytes and scans without a job."""
    st = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    cols = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in st.fields)
    names = ", ".join(f"`{f.name}`" for f in st.fields)
    body = ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in rows) or "(" + ", ".join(["NULL"] * len(st)) + ")"
    return spark.sql(f"SELECT {cols} FROM VALUES {body} AS t({names})" + ("" if rows else " WHERE false"))
