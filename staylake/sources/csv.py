"""CSV folders whose files carry different headers, read and written by name.

A plain ``spark.read.csv(folder)`` assigns columns by position, so files
with reordered or extra columns are silently misread.  Here the first line
of every file is found in tasks, files are grouped by header, every group is
read with its own column order and the groups are unioned by name.

Text is quoted as RFC 4180 has it: a quote inside a value is doubled, and
quoted values may hold commas and line breaks.  Reading line breaks inside
values means that a file is not split between tasks; ``multi_line=False``
allows splitting for files known to have none.
"""

from __future__ import annotations

import csv as _csv
from collections import OrderedDict
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TEXT_DEFAULT_FIELDS
from .files import path_exists

# Fixed value: text tokens read as missing, as common CSV readers do.
NULL_TOKENS = ["", "NA", "N/A", "NaN", "nan", "NULL", "null", "None", "<NA>"]


# One dialect for reading and writing.
DIALECT = {"header": "true", "quote": '"', "escape": '"'}
CSV_NAMES = "*.csv{,.gz}"  # plain and gzip files
WHOLE_BYTES = 1 << 20  # files up to this size are read whole for their header
HEADER_JOBS = 8        # first lines asked for at a time
GZIP_LEVEL = "TWO"     # a fifth larger than zlib's usual level, in half the time
_GLOB = str.maketrans({c: "\\" + c for c in "\\{}[]*?"})


def literal_path(path: str) -> str:
    """A path in which no character is taken as a glob."""
    return path.translate(_GLOB)


def _listed(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The ``.csv`` and ``.csv.gz`` files below ``paths``, listed once; contents only if asked for."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", CSV_NAMES).load([literal_path(p) for p in paths]))


def csv_files(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    """The ``.csv`` files below ``paths`` (a listing, no file is read)."""
    return sorted(r["path"] for r in _listed(spark, paths).select("path").collect())


def header_lines(listed: DataFrame) -> DataFrame:
    """(path, line) of the listed files: their first lines, found in tasks.

    Files of up to ``WHOLE_BYTES`` share tasks that read them whole.  A larger
    or compressed one has no line yet; see :func:`_first_lines`.
    """
    whole = (F.col("length") <= WHOLE_BYTES) & ~F.col("path").endswith(".gz")
    small = listed.where(whole).select(
        "path", F.regexp_extract(F.col("content").cast("string"), r"\A[^\r\n]*", 0).alias("line"))
    large = listed.where(~whole).select(
        "path", F.lit(None).cast("string").alias("line"))
    return small.union(large)


def _first_lines(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """First lines of large or compressed files: a task each, which stops after one record."""
    # Records of several lines, as such files are never split: one task sees the start.
    reader = (spark.read.schema("line string").option("multiLine", "true").option("sep", "\x01")
              .option("quote", "").option("header", "false"))

    def first(path: str) -> str:
        row = reader.csv(literal_path(path)).first()
        return (row["line"] or "") if row else ""

    with ThreadPoolExecutor(max_workers=HEADER_JOBS) as pool:
        return dict(zip(paths, pool.map(first, paths)))


def file_headers(spark: SparkSession, paths: str | Sequence[str]) -> dict[str, list[str]]:
    """Every ``.csv`` file below ``paths`` -> its parsed header line.

    The driver opens no file: it receives one line per file, as the lists of
    files to read are the driver's to make.
    """
    lines = {r["path"]: r["line"] for r in header_lines(_listed(spark, paths)).collect()}
    large = [path for path, line in lines.items() if line is None]
    if large:
        found = _first_lines(spark, large)
        lines.update((path, found.get(path, "")) for path in large)
    headers = {}
    for path in sorted(lines):
        line = lines[path].lstrip("\ufeff")
        headers[path] = next(_csv.reader([line])) if line else []
    return headers


def distinct_names(header: Sequence[str]) -> list[str]:
    """Header names with a number behind the second and later of a name.

    Spark compares names without case, so ``City`` repeats ``city``."""
    taken = {h.lower() for h in header}
    seen: set[str] = set()
    out = []
    for name in header:
        new, n = name, 2
        if name.lower() in seen:
            while f"{name}_{n}".lower() in taken:
                n += 1
            new = f"{name}_{n}"
        seen.add(new.lower())
        taken.add(new.lower())
        out.append(new)
    return out


_FLOATING = (T.DoubleType, T.FloatType)
_INTEGRAL = (T.IntegerType, T.LongType, T.ShortType, T.ByteType)


def _read_schema(header: Sequence[str], schema: T.StructType | None) -> T.StructType:
    """Per-file-group read schema in the file's column order.

    Floating columns are parsed by the CSV reader itself (a malformed cell
    becomes NULL in PERMISSIVE mode); the others are read as text and
    finished in ``_typed``.
    """
    declared = {f.name.lower(): f.dataType for f in schema.fields} if schema else {}
    types = [declared.get(h.lower()) for h in header]
    return T.StructType([T.StructField(h, t if isinstance(t, _FLOATING) else T.StringType())
                         for h, t in zip(header, types)])


def _integral(text: Column, dtype: T.DataType) -> Column:
    """Whole numbers, also written with a fraction of zero (``12.0``).

    The rare second form is a lambda, which Spark does not inline: a table has many
    such columns, and the JVM does not compile a row loop above 8,000 bytes.
    """
    def fraction(t: Column) -> Column:
        exact = t.try_cast("decimal(38,6)")
        return F.when(exact == F.floor(exact), exact.cast("string").try_cast("decimal(38,0)")
                      .try_cast(dtype))

    return F.coalesce(text.try_cast(dtype), F.element_at(F.transform(F.array(text), fraction), 1))


def _typed(df: DataFrame, schema: T.StructType | None,
           null_tokens: Sequence[str]) -> DataFrame:
    """Missing tokens -> NULL, then cast by name to the declared types.

    NaN becomes NULL for floating columns.  Other types are cast with
    ``try_cast`` (every token gives NULL).  Only text columns compare against
    the token list.
    """
    declared = {f.name.lower(): f.dataType for f in schema.fields} if schema else {}
    tokens = [t for t in null_tokens if t.strip()]
    cols = []
    for field in df.schema.fields:
        name = field.name
        raw = F.col(f"`{name}`")
        dtype = declared.get(name.lower())
        if isinstance(field.dataType, _FLOATING):
            clean = F.nanvl(raw, F.lit(None).cast(field.dataType))
        elif isinstance(dtype, _INTEGRAL):
            clean = _integral(F.trim(raw), dtype)
        elif dtype is None or isinstance(dtype, T.StringType):
            blank = F.trim(raw) == ""
            clean = F.when(blank | raw.isin(tokens), F.lit(None).cast("string")).otherwise(raw)
        else:
            clean = raw.try_cast(dtype)
        cols.append(clean.alias(name))
    return df.select(*cols)


def read_csv_by_name(spark: SparkSession, paths: str | Sequence[str],
                     schema: T.StructType | None = None,
                     null_tokens: Sequence[str] = NULL_TOKENS,
                     keep_extra: bool = True, multi_line: bool = True) -> DataFrame:
    """All ``.csv`` files below ``paths``, aligned by header name.

    Columns of ``schema`` come first in its order and type (absent ones are
    NULL); columns not in the schema follow as text in first-seen order when
    ``keep_extra``.  A malformed cell becomes NULL instead of failing the
    job.  Of a header that names a column twice, the first holds the name and
    the later ones are extra columns ``name_2``, ``name_3`` and so on.
    """
    headers = file_headers(spark, paths)
    groups: "OrderedDict[tuple[str, ...], list[str]]" = OrderedDict()
    for path in sorted(headers):
        groups.setdefault(tuple(distinct_names(headers[path])), []).append(path)

    parts = []
    for header, files in groups.items():
        if not header:
            continue
        reader = (spark.read.schema(_read_schema(header, schema)).options(**DIALECT)
                  .option("multiLine", str(multi_line).lower())
                  .option("enforceSchema", "true").option("mode", "PERMISSIVE"))
        # the files whose headers were read, not what has landed since
        part = reader.csv([literal_path(f) for f in files])
        parts.append(_typed(part, schema, null_tokens))

    if not parts:
        base = schema or T.StructType([])
        return spark.createDataFrame([], base)

    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return align_to_schema(out, schema, keep_extra) if schema else out


def align_to_schema(df: DataFrame, schema: T.StructType, keep_extra: bool = True) -> DataFrame:
    present = {c.lower() for c in df.columns}
    cols = [(F.col(f"`{f.name}`").cast(f.dataType) if f.name.lower() in present
             else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
    if keep_extra:
        names = {f.name.lower() for f in schema.fields}
        cols += [F.col(f"`{c}`") for c in df.columns if c.lower() not in names]
    return df.select(*cols)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Exploration read with type inference (an extra pass over the data;
    production paths declare the schema instead)."""
    return (spark.read.options(**DIALECT).option("inferSchema", "true").option("multiLine", "true")
            .option("recursiveFileLookup", "true").option("pathGlobFilter", CSV_NAMES)
            .csv(literal_path(path)))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite",
              max_records_per_file: int | None = None, compression: str = "none") -> str:
    """CSV with a header line; ``max_records_per_file`` cuts output into
    batches of at most that many rows per file; ``compression`` may be ``gzip``."""
    writer = (df.write.mode(mode).options(**DIALECT).option("compression", compression)
              .option("ignoreLeadingWhiteSpace", "false")
              .option("ignoreTrailingWhiteSpace", "false"))
    if compression == "gzip":
        writer = writer.option("zlib.compress.level", GZIP_LEVEL)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    writer.csv(path)
    return path


def snapshot_csv(df: DataFrame, base: str, run: str) -> str:
    """Write a run's table under ``base/run=<id>``; never into the folder
    that is scanned for input."""
    return write_csv(df, f"{base.rstrip('/')}/run={run}")


def merged_field_order(existing: Sequence[str], base: Sequence[str],
                       incoming: Iterable[str]) -> list[str]:
    """Existing header first, then base fields not yet present, then the
    remaining new fields sorted by name."""
    order = list(existing)
    for f in base:
        if f not in order:
            order.append(f)
    extra = sorted(set(incoming) - set(order))
    return order + extra


def fill_defaults(df: DataFrame, text_fields: Sequence[str],
                  numeric_default: float = 0) -> DataFrame:
    """Absent text fields -> '' and absent numeric fields -> 0, by type."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in text_fields:
            c = F.coalesce(c.cast("string"), F.lit(""))
        elif isinstance(f.dataType, T.NumericType):
            c = F.coalesce(c, F.lit(numeric_default).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def append_records(df: DataFrame, folder: str, base_fields: Sequence[str],
                   existing_fields: Sequence[str] | None = None,
                   text_fields: Sequence[str] = TEXT_DEFAULT_FIELDS,
                   batch_size: int | None = None, fill: bool = True) -> list[str]:
    """Append rows to a CSV folder as new self-describing files.

    The header is that of the folder's files (read from their first lines
    unless ``existing_fields`` is given), then base fields not yet present,
    then the remaining new fields sorted by name.  Absent values are filled
    by type unless ``fill`` is off.  Earlier files keep their own headers;
    ``read_csv_by_name`` aligns all of them, so no existing data is
    rewritten.  ``batch_size`` caps rows per file.  Returns the header used.
    """
    spark = df.sparkSession
    if existing_fields is None:
        held = file_headers(spark, folder) if path_exists(spark, folder) else {}
        existing_fields = list(dict.fromkeys(c for p in sorted(held) for c in held[p]))
    order = merged_field_order(existing_fields, base_fields, df.columns)
    present = set(df.columns)
    absent = {c: "string" if c in text_fields or not fill else "int" for c in order}
    aligned = df.select(*[(F.col(f"`{c}`") if c in present else F.lit(None).cast(absent[c])).alias(c)
                          for c in order])
    if fill:
        aligned = fill_defaults(aligned, text_fields)
    write_csv(aligned, folder, mode="append", max_records_per_file=batch_size)
    return order
