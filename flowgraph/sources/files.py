"""Period files: discovery, cap, footer probe, reading with one schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgraph.functions.normalize import strip_zone
from flowgraph.operators.numbering import assign_shards
from flowgraph.schemas import CANONICAL, LATE_COLUMNS, SHARDS
from flowgraph.session import materialize, new_path


def list_files(
    spark: SparkSession, root: str, pattern: str = "part-*.parquet", below: str | None = "parquet", times: bool = False
) -> DataFrame:
    """(path, size) and, if wanted, ``modified`` of the matching files, or only of those below a folder ``below`` inside ``root``.

    Spark lists the tree; only names and sizes are read.  Fails when nothing matches.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", F.col("length").alias("size"), *([F.col("modificationTime").alias("modified")] if times else []))
    )
    if below:
        inside = F.substring(F.col("path"), len(_qualified(spark, root)) + 1, 1 << 30)
        files = files.filter(F.concat(F.lit("/"), F.ltrim(inside, F.lit("/"))).contains(f"/{below}/"))
    if files.isEmpty():
        raise FileNotFoundError(f"no {pattern} in {root}" + (f" below a folder {below}" if below else ""))
    return files


def _qualified(spark: SparkSession, root: str) -> str:
    """``root`` as Spark writes it in the paths it lists."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def cap_files(files: DataFrame, n: int, require_ack: bool = False) -> tuple[DataFrame, bool]:
    """The first ``n`` files by path, and whether that left any out."""
    total = files.count()
    if total <= n:
        return files, False
    if require_ack:
        raise RuntimeError(f"{total} files exceed the cap of {n}")
    return files.orderBy("path").limit(n), True


_PROBE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("fields", T.StringType()),
        T.StructField("row_groups", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)


def probe_footers(files: DataFrame) -> DataFrame:
    """Schema, row groups and row count of every file, or the reason it cannot be read.

    Tasks read footers only; the file list is spread over them.  Where the workers have no client of
    their own for a store, or no right to it, Spark reads the file for them, with the cluster's settings; a file above
    Spark's limit for one value (``spark.sql.sources.binaryFile.maxLength``) is opened by its Parquet reader, which does
    not tell the row groups.  Whatever cannot be read is a row with its error.
    """
    spark = files.sparkSession
    direct = materialize(_probe_directly(files), "footers")
    failed = direct.filter(F.col("error").isNotNull())
    if failed.isEmpty():
        return direct
    limit = int(spark.conf.get("spark.sql.sources.binaryFile.maxLength"))
    written, some = new_path(spark, "footers"), False
    whole, large = failed.filter(F.col("size") <= limit).select("path"), failed.filter(F.col("size") > limit).select("path", "size")
    for paths in _batches((r["path"] for r in whole.toLocalIterator()), _BY_SPARK):
        escaped = [p.replace("\\", "\\\\") for p in map(_no_glob, paths)]
        content = spark.read.format("binaryFile").load(escaped).select("path", F.col("length").alias("size"), "content")
        content.mapInArrow(_probe_contents, _PROBE).write.mode("append").parquet(written)
        some = True
    for lines in _batches((_probe_by_scan(spark, r["path"], r["size"]) for r in large.toLocalIterator()), _BY_SPARK):
        spark.createDataFrame(lines, _PROBE).write.mode("append").parquet(written)
        some = True
    again = spark.read.schema(_PROBE).parquet(written) if some else direct.limit(0)
    found = direct.filter(F.col("error").isNull()).unionByName(again)
    return found.unionByName(failed.join(again.select("path"), "path", "left_anti").select(found.columns))


#: Files whose footers Spark looks up at a time, until none is left; no more paths are on the driver at once.
_BY_SPARK = 10_000


def _batches(values, size: int):
    from itertools import islice

    values = iter(values)
    while batch := list(islice(values, size)):
        yield batch


def _probe_by_scan(spark: SparkSession, path: str, size: int) -> tuple:
    """The probe of a file too large for one value: what Spark's own reader finds in its footer, or its error."""
    import json

    from pyspark.sql.pandas.types import to_arrow_type

    try:
        table = spark.read.parquet(_no_glob(path))
        fields = json.dumps([[f.name, str(to_arrow_type(f.dataType))] for f in table.schema])
        return (path, size, fields, None, table.count(), None)
    except Exception as e:  # the error is the result here
        return (path, size, None, None, None, f"{type(e).__name__}: {str(e).splitlines()[0]}")


def _no_glob(path: str) -> str:
    return "".join("\\" + c if c in "*?[]{}" else c for c in path)


def _footer(source) -> dict:
    import json

    import pyarrow.parquet as pq

    footer = pq.ParquetFile(source)
    fields = json.dumps([[f.name, str(f.type)] for f in footer.schema_arrow])
    return {"fields": fields, "row_groups": footer.num_row_groups, "rows": footer.metadata.num_rows, "error": None}


def _probed(lines: list[dict]):
    import pyarrow as pa

    kinds = [("path", pa.string()), ("size", pa.int64()), ("fields", pa.string()), ("row_groups", pa.int64()), ("rows", pa.int64()), ("error", pa.string())]
    empty = {"fields": None, "row_groups": None, "rows": None}
    return pa.RecordBatch.from_pylist([{**empty, **line} for line in lines], schema=pa.schema(kinds))


def _probe_contents(batches):
    import io

    for batch in batches:
        for path, size, content in zip(*(batch.column(c).to_pylist() for c in ("path", "size", "content"))):
            try:
                yield _probed([{"path": path, "size": size, **_footer(io.BytesIO(content))}])
            except Exception as e:  # the error is the result here
                yield _probed([{"path": path, "size": size, "error": f"{type(e).__name__}: {e}"}])


def _probe_directly(files: DataFrame) -> DataFrame:

    def probe(batches):
        from urllib.parse import quote

        from pyarrow import fs

        for batch in batches:
            lines = []
            for path, size in zip(batch.column("path").to_pylist(), batch.column("size").to_pylist()):
                try:
                    scheme, _, rest = path.partition(":")
                    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
                    uri = f"{scheme}://{quote(rest if rest.startswith('//') else '//' + rest, safe='/:@')[2:]}"
                    system, name = fs.FileSystem.from_uri(uri)
                    with system.open_input_file(name) as source:
                        lines.append({"path": path, "size": size, **_footer(source)})
                except Exception as e:  # the error is the result here
                    lines.append({"path": path, "size": size, "error": f"{type(e).__name__}: {e}"})
            if lines:
                yield _probed(lines)

    return files.select("path", "size").mapInArrow(probe, _PROBE)


def require_readable(probed: DataFrame, shown: int = 20) -> None:
    """Fail if files are unreadable: the first ones are named, the table of all of them is written and named."""
    failed = probed.filter(F.col("error").isNotNull()).select("path", "error")
    n = failed.count()
    if n:
        path = new_path(probed.sparkSession, "unreadable-files")
        failed.write.parquet(path)
        lines = [f"  {r['path']}: {r['error']}" for r in failed.orderBy("path").limit(shown).collect()]
        raise RuntimeError(f"{n} file(s) failed, all of them listed in {path}:\n" + "\n".join(lines))


def with_source_period(df: DataFrame) -> DataFrame:
    """Name of the file's folder; call it directly on the file scan, whose paths are written as in a URL."""
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return df.withColumn("source_period", F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B"))))


def fill_late_columns(df: DataFrame, columns=LATE_COLUMNS) -> DataFrame:
    return df.withColumns({c: F.lit("unknown") for c in columns if c not in df.columns})


def _cast(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast as file readers do: reals lose their fraction, text that is no number is NULL."""
    if source == target:
        return c
    if isinstance(source, T.TimestampType) and isinstance(target, T.TimestampNTZType):
        return strip_zone(c)
    return c.try_cast(target)


def canonicalize(df: DataFrame, schema: T.StructType = CANONICAL) -> DataFrame:
    """Columns of ``schema`` in order and type; absent ones are typed NULLs, others are dropped."""
    kind = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[
            (_cast(F.col(f.name), kind[f.name], f.dataType) if f.name in kind else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def read_periods(spark: SparkSession, files: DataFrame, shards: int | None = SHARDS) -> DataFrame:
    """All files as canonical rows with ``source_period`` and, if wanted, ``shard``.

    Files with the same footer schema are read together: one scan per schema (and shard), not
    per file.  Paths come to the driver, as they do for any scan, with a number for their schema.
    """
    probed = materialize(probe_footers(files).drop("rows", "row_groups"), "footers")
    require_readable(probed)
    named = probed.withColumn("kind", F.xxhash64("fields"))
    rows = (assign_shards(named, shards) if shards else named.withColumn("shard", F.lit(0))).select("path", "kind", "shard").collect()
    groups: dict[tuple, list[str]] = {}
    for r in rows:
        groups.setdefault((r["kind"], r["shard"]), []).append(r["path"])
    out = None
    for (_, shard), paths in sorted(groups.items()):
        part = with_source_period(spark.read.parquet(*map(_no_glob, sorted(paths))))
        part = canonicalize(fill_late_columns(part))
        if shards:
            part = part.withColumn("shard", F.lit(shard).cast("int"))
        out = part if out is None else out.unionByName(part)
    return out


def footer_report(files: DataFrame) -> DataFrame:
    """(file name, row groups, rows, columns) from the footers."""
    probed = probe_footers(files)
    return probed.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file"),
        "row_groups",
        "rows",
        F.transform(F.from_json("fields", "array<array<string>>"), lambda f: f[0]).alias("columns"),
        "error",
    )


def rows_by_table(report: DataFrame, root: str) -> DataFrame:
    """(file, rows) of the tables directly in ``root``, each one file or a folder of files, from ``footer_report``."""
    inside = F.substring(F.col("path"), len(_qualified(report.sparkSession, root)) + 1, 1 << 30)
    table = F.split(F.ltrim(inside, F.lit("/")), "/")[0]
    return report.groupBy(table.alias("file")).agg(F.sum("rows").alias("rows"))


def missing_by_file(report: DataFrame, required) -> DataFrame:
    """Required columns that a file of ``footer_report`` lacks: one row per file and column."""
    wanted = F.array(*[F.lit(c) for c in required])
    return report.select("file", "path", F.explode(F.array_except(wanted, F.col("columns"))).alias("missing"))
