"""Scans (S1-S6, S12).

Every reader uses an explicit or all-string schema: no type sniffing
(Q3), so a column whose values look like '1.000' stays text and the money
cleaner sees what the file says.  Files are split across tasks (no
``multiLine`` unless asked for).
"""

from __future__ import annotations

import csv
import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.functions.money import whole_number

LATIN1 = "ISO-8859-1"


def read_header(spark: SparkSession, path: str, sep: str = ";",
                encoding: str = LATIN1) -> list[str]:
    """The header row as written, duplicates and case kept.

    Reads one line of the first file: a tiny job, no inference.  For files
    that may differ, see :func:`headers_of`.
    """
    first = (spark.read.options(sep=sep, encoding=encoding, header=False, inferSchema=False)
             .csv(path).limit(1).collect())
    return [c if c is not None else f"_c{i}" for i, c in enumerate(first[0])] if first else []


def read_lenient_csv(spark: SparkSession, path, sep: str = ";", encoding: str = LATIN1,
                     header: bool = True, multiline: bool = False,
                     corrupt_column: str | None = None, columns=None) -> DataFrame:
    """Delimited text, every column STRING, dirty rows kept.

    PERMISSIVE mode pads short rows with NULL and cuts over-long rows at
    the header width.  ``corrupt_column`` adds a column holding the raw
    text of malformed rows (for a quarantine output).  ``columns`` gives
    the header when it is known (skips the header probe).
    """
    reader = spark.read.options(sep=sep, encoding=encoding, header=header, inferSchema=False,
                                mode="PERMISSIVE", multiLine=multiline, quote='"', escape='"')
    if columns is None and header:
        if isinstance(path, str):
            columns = read_header(spark, path, sep, encoding)
        else:  # one header for all files: columns are never matched by position across headers
            heads = headers_of(spark, path, encoding)
            if len(heads) > 1:
                raise ValueError(f"files of {len(heads)} different headers; read each group by itself: {sorted(heads)}")
            columns = split_header(next(iter(heads)), sep) if heads else []
    if columns is not None:
        fields = [T.StructField(f"_c{i}", T.StringType()) for i in range(len(columns))]
        if corrupt_column:
            fields.append(T.StructField(corrupt_column, T.StringType()))
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        reader = reader.schema(T.StructType(fields)).option("enforceSchema", True)
    return reader.csv(path)


def existing_paths(spark: SparkSession, sources):
    """Keep ``(name, path)`` pairs whose path exists (S12), checked through
    the Hadoop FileSystem of each path (works for any cluster store)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    kept = []
    for name, path in sources:
        p = jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(conf).exists(p):
            kept.append((name, path))
    return kept


def read_parquet_sources(spark: SparkSession, sources, tag: str | None = "origen_fuente") -> DataFrame | None:
    """UNION ALL of the Parquet sources that exist."""
    frames = []
    for name, path in existing_paths(spark, sources):
        df = spark.read.parquet(path)
        frames.append(df.withColumn(tag, F.lit(name)) if tag else df)
    if not frames:
        return None
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def file_keys(path: Column, pattern: str, names) -> dict:
    """Key columns captured by ``pattern`` groups from a file path."""
    return {n: F.regexp_extract(path, pattern, i + 1) for i, n in enumerate(names)}


def read_keyed_csv(spark: SparkSession, path, pattern: str, names, sep: str = ",",
                   encoding: str = "UTF-8", key_type: str = "int", schema=None) -> DataFrame:
    """CSV files whose keys live in the file name (S4 + S6).

    ``pattern`` is matched against the file path; files that do not match
    are skipped (their rows are filtered, never read into a key).
    """
    reader = spark.read.options(sep=sep, encoding=encoding, header=True, inferSchema=False,
                                mode="PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    fpath = plain_path()
    keys = file_keys(fpath, pattern, names)
    df = df.withColumns({k: F.nullif(v, F.lit("")).try_cast(key_type) for k, v in keys.items()})
    return df.filter(fpath.rlike(pattern))


def _as_text(item: T.StructType) -> T.StructType:
    """The item with every number as text, as the document has it."""
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.NumericType) else f.dataType)
                         for f in item.fields])


def _typed(value: Column, kind: T.DataType) -> Column:
    """Text of a JSON number, or a quoted number, as ``kind``: 1000, 1000.0 and
    "1000" are the same number."""
    if isinstance(kind, T.IntegralType):
        return whole_number(value).try_cast(kind)
    return F.btrim(value).try_cast(kind) if isinstance(kind, T.NumericType) else value


def envelope_schemas(item: T.StructType):
    """Both JSON envelope shapes over one item type."""
    wrapped = T.StructType([T.StructField("id", T.StringType()),
                            T.StructField("attributes", item)] + [f for f in item.fields if f.name != "id"])
    paged = T.StructType([T.StructField("data", T.StructType([T.StructField("data", T.ArrayType(wrapped))]))])
    plain = T.StructType([T.StructField("data", T.ArrayType(wrapped))])
    return wrapped, paged, plain


def parse_envelopes(docs: DataFrame, item: T.StructType, text: str = "value",
                    rejected: str | None = None) -> DataFrame:
    """One row per item of ``{"data": {"data": [...]}}`` or ``{"data": [...]}``
    documents; ``attributes`` unwrapped when present (S5, X19).

    Numbers are read as text and cast through decimal, so 1000.0 or "1000" is
    no NULL.  ``rejected`` names a column that counts, per item, the fields
    that hold something that is no number of their type.  A document that is
    not valid JSON, or has neither shape, yields no rows.
    """
    _, paged, plain = envelope_schemas(_as_text(item))
    opts = {"mode": "PERMISSIVE"}
    items = F.coalesce(F.from_json(F.col(text), paged, opts)["data"]["data"],
                       F.from_json(F.col(text), plain, opts)["data"])
    exploded = docs.select(*[c for c in docs.columns if c != text], F.explode(items).alias("_it"))
    names = [f.name for f in item.fields]
    body = F.when(F.col("_it.attributes").isNotNull(), F.col("_it.attributes")).otherwise(
        F.struct(*[F.col(f"_it.{n}").alias(n) for n in names]))
    rest = [c for c in exploded.columns if c != "_it"]
    rows = exploded.select(*rest, body.alias("_body"))
    typed = {f.name: _typed(F.col("_body")[f.name], f.dataType) for f in item.fields}
    out = [typed[n].alias(n) for n in names]
    if rejected:
        bad = [(F.col("_body")[n].isNotNull() & typed[n].isNull()).cast("int") for n in names]
        out.append(reduce(lambda x, y: x + y, bad).alias(rejected))
    return rows.select(*rest, *out)


def read_envelopes(spark: SparkSession, path: str, item: T.StructType, rejected: str | None = None) -> DataFrame:
    """JSON documents, one per file or one per line of ``.jsonl`` files, in
    either envelope shape (S5)."""
    lines = path.endswith((".jsonl", ".txt"))
    docs = spark.read.text(path, wholetext=not lines).withColumn("source_file", F.col("_metadata.file_path"))
    return parse_envelopes(docs, item, rejected=rejected)


def plain_path(file: Column | None = None) -> Column:
    """The path of the file a row comes from, as written (not URL-encoded);
    ``file``: such a path kept in a column."""
    file = F.col("_metadata.file_path") if file is None else file
    return F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B")))


def literal_path(path: str) -> str:
    """``path`` with its glob characters escaped."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def split_header(head: str, sep: str) -> list[str]:
    cols = next(csv.reader([head], delimiter=sep, quotechar='"'))
    return [c if c else f"_c{i}" for i, c in enumerate(cols)]


def apart(names: list[str]) -> list[str]:
    """Column names that Spark can tell apart: a repeated one, or one that
    differs in case only, gets ``.1``, ``.2`` and so on."""
    seen: dict[str, int] = {}
    out: list[str] = []
    for name in names:
        low, plain = name.lower(), name
        while name.lower() in seen:
            seen[low] += 1
            name = f"{plain}.{seen[low]}"
        seen[name.lower()] = 0
        out.append(name)
    return out


HEADER_BLOCK = 64 * 1024
LONGEST_HEADER = 1 << 20


def first_line(file) -> bytes:
    """The first line of an open file, read block by block up to its end
    (a mebibyte at most: no header is longer)."""
    text = b""
    while not re.search(rb"[\r\n]", text) and len(text) < LONGEST_HEADER:
        block = file.read(HEADER_BLOCK)
        if not block:
            break
        text += block
    return re.split(rb"[\r\n]", text, maxsplit=1)[0]


def open_file(path: str):
    """A file of a store that Arrow reaches (local or shared folders, HDFS, S3, GCS)."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file" or path.startswith("/"):
        return fs.LocalFileSystem().open_input_stream(re.sub("^//[^/]*", "", rest) if scheme == "file" else path)
    store, name = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))
    return store.open_input_stream(name)


def probed(files: DataFrame, encoding: str) -> DataFrame:
    """path, file, head (the first line), opened of every file (path, file).  A block of
    each file is read, whatever its size; ``opened`` is false where Arrow cannot reach it."""

    def scan(batches):
        for batch in batches:
            rows = []
            for path, uri in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    with open_file(path) as file:
                        rows.append((path, uri, first_line(file).decode(encoding, "replace"), True))
                except Exception:  # noqa: BLE001 - any store's errors: the file is read by Spark instead
                    rows.append((path, uri, None, False))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows, strict=True) if rows else ([], [], [], []),
                (pa.string(), pa.string(), pa.string(), pa.bool_()), strict=True)],
                ["path", "file", "head", "opened"])

    return files.mapInArrow(scan, "path string, file string, head string, opened boolean")


def scanned(spark: SparkSession, paths, encoding: str) -> DataFrame:
    """path, head of files that only Spark can open: of each file's first split the
    row with the least ``monotonically_increasing_id`` (ids grow in file order
    inside a partition).  Spark's text scan cannot stop after a line."""
    # whole lines: the text source does not decode, so a separator that no line has
    text = (spark.read.options(encoding=encoding, recursiveFileLookup=True, sep="\x01", quote="", header=False)
            .schema("value string").csv([literal_path(p) for p in paths]))
    rows = text.select(plain_path().alias("path"), F.col("_metadata.file_block_start").alias("start"), "value",
                       F.monotonically_increasing_id().alias("rid")).filter("start = 0")
    return rows.groupBy("path").agg(F.min_by("value", "rid").alias("head"))


def _files_by_header(spark: SparkSession, paths, encoding: str, pattern: str | None) -> dict[str, dict[str, str]]:
    """``{header line: {path: the same as ``_metadata.file_path`` has it}}``; see :func:`headers_of`."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .load([literal_path(p) for p in paths]).select("path", F.col("_metadata.file_path").alias("file")))
    if pattern:
        files = files.filter(F.col("path").rlike(pattern))
    clean = F.btrim("head", F.lit("\ufeff\r")).alias("head")
    found: dict[str, dict[str, str]] = {}
    closed: dict[str, str] = {}
    spread = files.repartition(spark.sparkContext.defaultParallelism)  # paths only: small files share a scan task
    groups = (probed(spread, encoding).select("path", "file", clean, "opened").groupBy("opened", "head")
              .agg(F.collect_list(F.struct("path", "file")).alias("files")).collect())
    for group in groups:
        (found.setdefault(group["head"], {}) if group["opened"] else closed).update(group["files"])
    if closed:
        heads = scanned(spark, list(closed), encoding).select("path", clean)
        for group in heads.groupBy("head").agg(F.collect_list("path").alias("paths")).collect():
            found.setdefault(group["head"], {}).update((p, closed[p]) for p in group["paths"])
    return {head: dict(sorted(files.items())) for head, files in sorted(found.items(), key=lambda g: min(g[1]))
            if head and head.strip()}


def headers_of(spark: SparkSession, paths, encoding: str = "UTF-8", pattern: str | None = None) -> dict[str, list[str]]:
    """``{header line: files that have it}`` of all files under ``paths``.

    Two jobs, whatever the number of files: a listing (no content is read), and
    tasks that read the first block of each file.  Files that those cannot open,
    in stores that only Spark reaches, are scanned.  Files without a first line, or whose
    path does not match ``pattern``, are left out.  The driver gets a path per
    file, as it does to plan any scan of them.
    """
    return {head: list(files) for head, files in _files_by_header(spark, paths, encoding, pattern).items()}


def read_keyed_groups(spark: SparkSession, root: str, pattern: str, names, sep: str = ",",
                      encoding: str = "UTF-8", key_type: str = "int", skipped: list | None = None) -> list[DataFrame]:
    """Monthly drops whose columns differ from file to file.

    Files matching ``pattern`` (keys captured from the path) are grouped by
    their exact header line; each group is one CSV scan, read by position and
    then named by its header (see :func:`apart` for repeated names), carrying
    the keys.  Files that are empty or hold only a header contribute no rows;
    files whose header cannot be read as one are left out, and ``skipped``
    collects (path, reason); a missing root gives no frames.

    The keys are taken from each path once and reach the rows by a broadcast of
    the list of files: matched per row they cost more than reading it.
    """
    if not existing_paths(spark, [("", root)]):
        return []
    frames = []
    for head, files in _files_by_header(spark, root, encoding, pattern).items():
        try:
            header = apart(split_header(head, sep))
        except csv.Error as error:
            if skipped is not None:
                skipped += [(p, f"header: {error}") for p in files]
            continue
        schema = T.StructType([T.StructField(f"_p{i}", T.StringType()) for i in range(len(header))])
        # the probed header is the schema: no inference job per group
        df = (spark.read.options(sep=sep, encoding=encoding, header=True, inferSchema=False,
                                 enforceSchema=True, mode="PERMISSIVE", quote='"', escape='"')
              .schema(schema).csv([literal_path(p) for p in files]))
        keys = {k: F.nullif(v, F.lit("")).try_cast(key_type)
                for k, v in file_keys(plain_path(F.col("_file")), pattern, names).items()}
        listed = spark.createDataFrame(pa.table({"_file": pa.array(list(files.values()), pa.string())}))  # no Python task
        by_file = F.broadcast(listed.select("_file", *[v.alias(f"_k{i}") for i, v in enumerate(keys.values())]))
        keyed = df.withColumn("_from", F.col("_metadata.file_path")).join(by_file, F.col("_from") == F.col("_file"), "left")
        taken = {k.lower() for k in keys}
        frames.append(keyed.select(*[F.col(f"_p{i}").alias(c) for i, c in enumerate(header) if c.lower() not in taken],
                                   *[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)]))
    return frames
