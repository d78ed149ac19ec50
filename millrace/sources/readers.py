"""Reading tables: format dispatch, CSV sniffing, JSON layouts, many files."""

from __future__ import annotations

import fnmatch
import os
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.numeric import col
from millrace.operators import schema as S
from millrace.operators.skew import with_row_number

# Fixed values of the sniffer.
DELIMITERS = [",", ";", "\t", "|"]
SNIFF_CHARS = 2048
EXTENSIONS = {
    ".csv": "csv", ".tsv": "tsv", ".txt": "tsv", ".json": "json", ".jsonl": "jsonl",
    ".ndjson": "jsonl", ".parquet": "parquet", ".pq": "parquet",
}
# Files above this size are hashed while they are read, by lines up to the second size.
WHOLE_FILE = 16 << 20
LONG_LINE = 16 << 20


def sniff_delimiter(spark: SparkSession, path: str) -> str:
    """The delimiter that occurs most in the first characters of the text."""
    head = "\n".join(r[0] for r in spark.read.text(path).limit(200).collect())[:SNIFF_CHARS]
    counts = [head.count(d) for d in DELIMITERS]
    return DELIMITERS[counts.index(max(counts))]


def detect_encoding(spark: SparkSession, path: str) -> str:
    """UTF-8 unless some line is invalid; NUL characters mean UTF-16.

    A filter with an early stop over the text; pass ``encoding`` to skip it.
    """
    lines = spark.read.text(path)
    nul = F.col("value").contains("\x00")
    odd = lines.where(~F.is_valid_utf8("value") | nul).select(nul.alias("wide")).limit(1).collect()
    if not odd:
        return "UTF-8"
    return "UTF-16" if odd[0]["wide"] else "ISO-8859-1"


def read_csv(spark: SparkSession, path: str, sep: str | None = None, encoding: str | None = None, bad_rows: str = "keep", schema=None, header: bool = True) -> DataFrame:
    """bad_rows: keep (with ``_corrupt_record``), drop, fail.  A given schema
    saves the inference pass over the data."""
    mode = {"keep": "PERMISSIVE", "drop": "DROPMALFORMED", "fail": "FAILFAST"}[bad_rows]
    options = dict(
        header=header, sep=sep or sniff_delimiter(spark, path), mode=mode,
        encoding=encoding or detect_encoding(spark, path),
    )
    if schema is None:
        schema = spark.read.csv(path, inferSchema=True, **options).schema
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if bad_rows == "keep":
        schema = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
        options["columnNameOfCorruptRecord"] = "_corrupt_record"
    return spark.read.csv(path, schema=schema, enforceSchema=True, **options)


def read_tsv(spark: SparkSession, path: str, **kw) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, inferSchema="schema" not in kw, **kw)


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def _typed(df: DataFrame, keep=()) -> DataFrame:
    """Text columns that parse completely as whole or real numbers get the type."""
    cols = [c for c in S.text_columns(df) if c not in keep]
    if not cols:
        return df
    ok = lambda c, t: F.coalesce(F.bool_and(F.when(col(c).isNotNull(), col(c).try_cast(t).isNotNull())), F.lit(False))
    row = df.agg(*[e for c in cols for e in (ok(c, "bigint"), ok(c, "double"))]).head()
    types = {}
    for i, c in enumerate(cols):
        if row[2 * i]:
            types[c] = "bigint"
        elif row[2 * i + 1]:
            types[c] = "double"
    return df.withColumns({c: col(c).cast(t) for c, t in types.items()}) if types else df


def read_json(spark: SparkSession, path: str, orient: str = "auto") -> DataFrame:
    """orient: lines, records ([{..}]), index ({row: {col: v}}), columns
    ({col: {row: v}}), values ([[..]]); auto decides by the first characters.

    Line-delimited input is splittable; the other layouts are one document per
    file by nature, and files are still read in parallel.
    """
    if orient == "auto":
        head = (spark.read.text(path).where("trim(value) <> ''").limit(1).collect() or [[""]])[0][0].strip()
        compact = head.replace(" ", "")
        if compact.startswith("[["):
            orient = "values"
        elif compact.startswith("["):
            orient = "records"
        elif compact.startswith("{") and compact.split(":", 1)[-1].startswith("{"):
            outer, inner = (k.strip('{"').lstrip("-").isdigit() for k in compact.split(":", 2)[:2])
            if outer == inner and not compact.split(":", 1)[-1].startswith("{}"):
                raise ValueError("rows or columns first? pass orient='index' or orient='columns'")
            orient = "index" if outer else "columns"
        else:
            orient = "lines"
    if orient == "lines":
        return spark.read.json(path)
    if orient == "records":
        return spark.read.json(path, multiLine=True)
    docs = spark.read.text(path, wholetext=True)
    if orient == "values":
        rows = docs.select(F.posexplode(F.from_json("value", "array<array<string>>")).alias("row", "cells"))
        width = rows.agg(F.max(F.size("cells"))).head()[0] or 0
        return _typed(rows.select(*[F.get("cells", F.lit(i)).alias(str(i)) for i in range(width)]))
    outer = docs.select(F.explode(F.from_json("value", "map<string,map<string,string>>")).alias("k", "inner"))
    if orient == "index":
        names = [r[0] for r in outer.select(F.explode(F.map_keys("inner")).alias("n")).distinct().orderBy("n").collect()]
        return _typed(outer.select(*[F.try_element_at("inner", F.lit(n)).alias(n) for n in names]))
    if orient == "columns":
        # a row label counts within its file
        marked = docs.select(F.col("_metadata.file_path").alias("file"), F.explode(F.from_json("value", "map<string,map<string,string>>")).alias("k", "inner"))
        cells = marked.select("file", F.col("k").alias("name"), F.explode("inner").alias("row", "value"))
        names = [r[0] for r in outer.select("k").distinct().orderBy("k").collect()]
        wide = cells.groupBy("file", "row").pivot("name", names).agg(F.first("value"))
        return _typed(wide.drop("file", "row"))
    raise ValueError(f"unknown JSON layout {orient!r}")


def read_any(spark: SparkSession, source, fallback: str | None = "csv", **options) -> DataFrame:
    """A DataFrame passes through; a path is read by its extension.  Unknown
    extensions are read as CSV, or raise when ``fallback`` is None."""
    if isinstance(source, DataFrame):
        return source
    kind = EXTENSIONS.get(os.path.splitext(source.rstrip("/"))[1].lower(), fallback)
    if kind is None:
        raise ValueError(f"no reader for {source!r}; known: {sorted(EXTENSIONS)}")
    if kind == "parquet":
        return read_parquet(spark, source)
    if kind == "tsv":
        return read_tsv(spark, source, **options)
    if kind in ("json", "jsonl"):
        return read_json(spark, source, "lines" if kind == "jsonl" else "auto", **options)
    return read_csv(spark, source, **{"bad_rows": "drop", **options})


def load_rows(spark: SparkSession, sources: list, **options) -> DataFrame:
    """Files one below the other by column name; missing columns are null."""
    frames = [read_any(spark, s, **options) for s in sources]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def load_cols(spark: SparkSession, sources: list, order_by: list[list[str]], **options) -> DataFrame:
    """Files side by side by position; each needs the columns that order it."""
    frames = [
        with_row_number(read_any(spark, s, **options), keys, name="__pos") for s, keys in zip(sources, order_by)
    ]
    return reduce(lambda a, b: a.join(b, "__pos", "full_outer"), frames).drop("__pos")


def peek(spark: SparkSession, source, n: int = 5, order_by: list[str] = ()) -> DataFrame:
    df = read_any(spark, source)
    return (df.orderBy(*[col(c) for c in order_by]) if order_by else df).limit(n)


def file_inventory(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = False, digest: str = "md5") -> DataFrame:
    """(path, name, size, digest) of the files that match a glob.

    Contents are read and hashed by the tasks: files up to ``WHOLE_FILE`` bytes as
    one value, larger ones line by line and at once, so that no task holds such a file
    unless it goes on for ``LONG_LINE`` bytes without a newline.  Spark's file sources
    leave out empty files, so those are added from the listing.
    """
    content = F.col("content")
    hashed = {"md5": F.md5(content), "sha1": F.sha1(content), "sha256": F.sha2(content, 256)}[digest]
    options = {"pathGlobFilter": pattern, "recursiveFileLookup": str(recursive).lower()}
    files = spark.read.format("binaryFile").options(**options).load(path)
    empty = spark.createDataFrame(
        [(p,) for p in _empty_files(spark, path, pattern, recursive)], "path string"
    ).select("path", F.lit(0).cast("bigint").alias("length"), F.lit("").cast("binary").alias("content"))
    large = files.where(F.col("length") > WHOLE_FILE).select(F.col("_metadata.file_path").alias("file"), _extension().alias("e")).collect()
    done = [r for e in sorted({r["e"] for r in large}) for r in _hash_lines(spark, path, options, e, digest).collect()]
    columns = ["path", "length", "content"]
    whole = files.where(F.col("length") <= WHOLE_FILE).select(*columns).unionByName(empty)
    long = sorted({r["file"] for r in large} - {r["file"] for r in done})
    if long:
        whole = whole.unionByName(files.where(F.col("_metadata.file_path").isin(long)).select(*columns))
    found = whole.select("path", F.col("length").alias("size"), hashed.alias("digest"))
    if done:
        rows = [(unquote(r["file"]), r["size"], r["digest"]) for r in done]
        found = found.unionByName(spark.createDataFrame(rows, "path string, size bigint, digest string"))
    return found.select("path", F.regexp_extract("path", "([^/]+)$", 1).alias("name"), "size", "digest")


def _extension() -> Column:
    """The file's extension with its dot; empty where a codec could not be named after it."""
    return F.regexp_extract("_metadata.file_name", r"(\.\w+)$", 1)


def _hash_lines(spark: SparkSession, path: str, options: dict, ext: str, digest: str) -> DataFrame:
    """(file, size, digest) of the files above ``WHOLE_FILE`` bytes with one extension.

    A digest is a chain over the bytes, so one task follows a file from its start, a batch
    of lines at a time (bytes between newlines, also in binary files).  The reader leaves
    out lines from ``LONG_LINE`` bytes on; a file that has one is left out here.
    Hadoop's pass-through codec for the extension keeps the file in one piece and
    undoes no compression; files without an extension are split, and sorted by place.
    """
    codec = {
        "io.compression.codecs": "org.apache.hadoop.io.compress.PassthroughCodec",
        "io.compress.passthrough.extension": ext,
        # the name of that option in Spark's own Hadoop client
        "org.apache.hadoop.shaded.io.compress.passthrough.extension": ext,
    }
    text = spark.read.format("text").options(**options, **(codec if ext else {})).options(
        **{"lineSep": "\n", "mapreduce.input.linerecordreader.line.maxlength": str(LONG_LINE)}
    ).load(path)
    meta = lambda c: F.col(f"_metadata.file_{c}")
    rows = text.where((meta("size") > WHOLE_FILE) & (_extension() == ext)).select(
        meta("path").alias("file"), meta("size").alias("size"), meta("block_start").alias("start"),
        F.concat(F.col("value").cast("binary"), F.lit("\n").cast("binary")).alias("line"),
    )
    if not ext:
        rows = rows.withColumn("n", F.monotonically_increasing_id()).repartition("file").sortWithinPartitions("file", "start", "n")

    longest = LONG_LINE

    def follow(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        mark = b"\xef\xbb\xbf"
        file = size = None

        def result():
            # the reader leaves out a byte order mark and does not tell whether the last line has its newline
            ends = {size: (plain, b"\n"), size + 1: (plain, b""), size - 3: (marked, b"\n"), size - 2: (marked, b"")}
            if seen in ends and not cut:
                state, last = ends[seen]
                state.update(last)
                yield pa.RecordBatch.from_pydict({"file": [file], "size": pa.array([size], pa.int64()), "digest": [state.hexdigest()]})

        for batch in batches:
            if not batch.num_rows:
                continue
            names, line = batch.column("file"), batch.column("line")
            at = np.frombuffer(line.buffers()[1], dtype=np.int64 if pa.types.is_large_binary(line.type) else np.int32)[line.offset :]
            runs = pc.run_end_encode(names)
            first = 0
            for name, last in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if name != file:
                    if file is not None:
                        yield from result()
                    file, size, seen = name, batch.column("size")[first].as_py(), 0
                    plain, marked = hashlib.new(digest), hashlib.new(digest, mark)
                    held, cut = b"", False
                data = line.buffers()[2][int(at[first]) : int(at[last])]
                for state in (plain, marked):
                    state.update(held)
                    state.update(data[: data.size - 1])
                held = b"\n"
                seen += data.size
                cut = cut or int(np.diff(at[first : last + 1]).max()) > longest
                first = last
        if file is not None:
            yield from result()

    return rows.select("file", "size", "line").mapInArrow(follow, "file string, size bigint, digest string")


def _empty_files(spark: SparkSession, path: str, pattern: str, recursive: bool) -> list[str]:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, recursive)
    out = []
    while found.hasNext():
        status = found.next()
        name = status.getPath().getName()
        if status.getLen() == 0 and fnmatch.fnmatch(name, pattern) and not name.startswith(("_", ".")):
            out.append(status.getPath().toString())
    return out
