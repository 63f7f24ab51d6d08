"""Incremental file ingest with a stored, growing schema."""

from __future__ import annotations

import json
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakejobs.operators.projections import ingest_audit
from lakejobs.operators.tables import few_rows
from lakejobs.session import fresh_dir, path_exists

_ENTRY = "version bigint, schema string"
_FILE = "path string, modified timestamp, size bigint"
CORRUPT = "_corrupt_record"
RECORD = "record"
# Files whose columns are read at once.
_LOOKED_AT = 10_000


def _last_entry(spark: SparkSession, schema_dir: str) -> tuple[T.StructType, int] | None:
    folder = f"{schema_dir}/versions"
    if not path_exists(spark, folder):
        return None
    row = spark.read.schema(_ENTRY).parquet(folder).orderBy(F.desc("version")).first()
    return (T.StructType.fromJson(json.loads(row.schema)), row.version) if row else None


def stored_schema(spark: SparkSession, schema_dir: str) -> T.StructType | None:
    """The newest schema recorded for a source."""
    last = _last_entry(spark, schema_dir)
    return last[0] if last else None


def grown(stored: T.StructType, seen: T.StructType) -> T.StructType:
    """Stored columns as they are, then the columns seen for the first time."""
    return T.StructType(stored.fields + [f for f in seen.fields if f.name not in stored.names])


def observed_schema(
    spark: SparkSession, path: str, fmt: str, files: list[str] | None = None
) -> T.StructType:
    """Columns of the files in the source, or of some of them.

    JSON is read for its types, Parquet gives them in its footers, and CSV
    columns stay text until the cleaning step casts them.
    """
    reader = spark.read.format(fmt)
    if files is not None:
        reader = reader.option("basePath", path)
    if fmt == "csv":
        reader = reader.option("header", True)
    elif fmt != "json":
        reader = reader.option("mergeSchema", True)
    schema = reader.load(path if files is None else files).schema
    return T.StructType([f for f in schema.fields if f.name != CORRUPT])


def unseen_files(spark: SparkSession, path: str, schema_dir: str) -> DataFrame:
    """Files of the source whose columns were not looked at yet, whatever their times."""
    there = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))
    )
    if not path_exists(spark, f"{schema_dir}/files"):
        return there
    known = spark.read.schema(_FILE).parquet(f"{schema_dir}/files")
    return there.join(known, ["path", "modified", "size"], "left_anti")


def register_schema(spark: SparkSession, path: str, fmt: str, schema_dir: str) -> T.StructType:
    """Bring the stored schema up to date with the files of the source and return it.

    A stream keeps one schema for a run, so this is called before each run.
    Stored columns are never dropped and never change type.  Only files that no
    run has looked at are read, known by path, time and size: the cost follows
    the new files, and a file that arrives with an old time is looked at.  The listing is
    written once, so what is looked at is what is noted as seen; the driver holds the paths of
    ``_LOOKED_AT`` files at a time.
    """
    last = _last_entry(spark, schema_dir)
    listed = fresh_dir(spark, "listed")
    unseen_files(spark, path, schema_dir).write.parquet(listed)
    files = spark.read.schema(_FILE).parquet(listed)
    schema, version = (T.StructType([]), 0) if last is None else (last[0], last[1] + 1)
    if last is None:
        schema = observed_schema(spark, path, fmt)
    else:
        paths = (r.path for r in files.select("path").toLocalIterator())
        while some := list(islice(paths, _LOOKED_AT)):
            schema = grown(schema, observed_schema(spark, path, fmt, some))
    _save_schema(spark, schema_dir, schema, version)
    # Behind the schema: a run that dies in between looks at the files again.
    files.write.mode("append").parquet(f"{schema_dir}/files")
    return schema


def _save_schema(spark: SparkSession, schema_dir: str, schema: T.StructType, version: int) -> None:
    entry = {"version": version, "schema": schema.json()}
    kinds = T.StructType([T.StructField("version", T.LongType()),
                          T.StructField("schema", T.StringType())])
    few_rows(spark, [entry], kinds).write.mode("append").parquet(f"{schema_dir}/versions")


# -- JSON: whole records in bronze, columns drawn behind it ------------------


_FOLDERS = T.StructType([T.StructField("folder", T.StringType()),
                         T.StructField("files", T.LongType()),
                         T.StructField("bytes", T.LongType())])
_FITTING = T.StructType([T.StructField("version", T.LongType()),
                         T.StructField("batch_id", T.StringType())])
_BATCH = "batch_id="
RECORDS = T.StructType([
    T.StructField(RECORD, T.VariantType()), T.StructField(CORRUPT, T.StringType()),
    T.StructField("ingestion_timestamp", T.TimestampType()),
    T.StructField("source_file", T.StringType()), T.StructField("source_system", T.StringType()),
    T.StructField("batch_id", T.StringType()),
])


def record_stream(
    spark: SparkSession, path: str, batch_id: str, source_system: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """New lines of JSON files, each whole as a VARIANT: no column can be missed.

    Blank lines are no records; a line that is no JSON object is kept as text in
    ``_corrupt_record``."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = ingest_audit(reader.load(path).filter(F.trim("value") != ""), batch_id, source_system)
    parsed = F.try_parse_json("value")
    # JSON that begins with a brace is an object; that costs less than the type of every record.
    whole = parsed.isNotNull() & F.ltrim("value", F.lit(" \t\r\n")).startswith("{")
    cells = {RECORD: F.when(whole, parsed), CORRUPT: F.when(~whole, F.col("value"))}
    named = lines.withColumns(cells)
    return named.select(*[
        F.col(f.name) if f.name in named.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in RECORDS.fields
    ])


def stored_type(kind: T.DataType) -> T.DataType:
    """The column type for values of a VARIANT: doubles for decimals, text for what is mixed."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, stored_type(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(stored_type(kind.elementType))
    if isinstance(kind, T.DecimalType):
        return T.DoubleType()
    return T.StringType() if isinstance(kind, (T.NullType, T.VariantType)) else kind


def record_path(name: str) -> str | None:
    """The path of a field; a name with both quotes, or with "?", has none and is no column."""
    if "?" in name or ('"' in name and "'" in name):
        return None
    return f"$['{name}']" if '"' in name else f'$["{name}"]'


def record_columns(records: DataFrame) -> T.StructType:
    """The columns that the objects of a frame have, in the order of their names."""
    return _columns_of(records.agg(F.schema_of_variant_agg(RECORD)).first()[0])


def _columns_of(text: str | None) -> T.StructType:
    if not text or not text.startswith("OBJECT<"):
        return T.StructType([])
    kind = stored_type(T.DataType.fromDDL(text.replace("OBJECT<", "STRUCT<")))
    return T.StructType([f for f in kind.fields if record_path(f.name)])


def _all_fit(seen: T.StructType, schema: T.StructType) -> bool:
    """Whether no value can fail the stored type, by the types that the values were seen with."""
    plain = (T.LongType, T.DoubleType, T.BooleanType)
    kinds = {f.name: f.dataType for f in schema.fields}
    return all(isinstance(kinds[f.name], T.StringType)
               or (isinstance(kinds[f.name], plain) and kinds[f.name] == f.dataType)
               for f in seen.fields)


def _folders(spark: SparkSession, bronze: str) -> DataFrame:
    """The batch folders of a bronze table with the number and bytes of their files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.parquet").load(bronze)
    return files.groupBy(_folder("path").alias("folder")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def _folder(path: str) -> Column:
    """The folder of a file.  It is asked for on every row, and a search by pattern tries all the
    places of a long path: that took half the CPU time of a streaming flow."""
    return F.substring_index(F.substring_index(path, "/", -2), "/", 1)


def register_records(spark: SparkSession, bronze: str, schema_dir: str) -> T.StructType:
    """Bring the stored schema up to date with the records of a bronze table and return it.

    Only batches that are new, or have files more than when they were looked at, are read.  As
    bronze keeps whole records, it does not matter when a file landed: its columns are seen once
    it is there."""
    last = _last_entry(spark, schema_dir)
    schema, version = (T.StructType([]), 0) if last is None else (last[0], last[1] + 1)
    folders = _folders(spark, bronze)
    if path_exists(spark, f"{schema_dir}/batches"):
        known = spark.read.schema(_FOLDERS).parquet(f"{schema_dir}/batches")
        folders = folders.join(known, _FOLDERS.names, "left_anti")
    new = [r.asDict() for r in folders.collect()]  # one record per batch since the last run
    if new:
        table = spark.read.schema(RECORDS).parquet(bronze)
        names = [r["folder"] for r in new]
        batches = [n.removeprefix(_BATCH) for n in names]
        # Names with "%" are written in more than one way; other folders are no batches.
        told = all(n.startswith(_BATCH) and "%" not in n and "__HIVE_" not in n for n in names)
        if told:  # whole folders are skipped, and no row is asked for its file
            table = table.filter(F.col("batch_id").isin(batches))
        row = table.agg(F.schema_of_variant_agg(RECORD), F.count(CORRUPT)).first()
        seen = _columns_of(row[0])
        schema = grown(schema, seen)
        _save_schema(spark, schema_dir, schema, version)
        if told and row[1] == 0 and _all_fit(seen, schema):
            few_rows(spark, [{"version": version, "batch_id": b} for b in batches], _FITTING) \
                .write.mode("append").parquet(f"{schema_dir}/fitting")
        few_rows(spark, new, _FOLDERS).write.mode("append").parquet(f"{schema_dir}/batches")
    return schema


def misfits(spark: SparkSession, records: DataFrame, schema_dir: str) -> DataFrame:
    """Records without the batches in which every value was seen to fit, of those looked at last.

    Such a batch has no line for the quarantine; its folder is skipped.  Any other batch is
    read, also one that came before and was not."""
    last = _last_entry(spark, schema_dir)
    if last is None or not path_exists(spark, f"{schema_dir}/fitting"):
        return records
    rows = spark.read.schema(_FITTING).parquet(f"{schema_dir}/fitting")
    fitting = [r.batch_id for r in rows.filter(F.col("version") == last[1]).collect()]
    batch = F.col("batch_id")
    return records.filter(batch.isNull() | ~batch.isin(fitting)) if fitting else records


def drawn(records: DataFrame, schema: T.StructType, origin: bool = False) -> DataFrame:
    """Bronze records with the columns of a schema; for batch and streaming input.

    ``origin`` keeps ``source_system``, which not every source tells.

    A value that does not fit its type reads as NULL, and the record is kept as text in
    ``_corrupt_record``.  Text that reads as a number of the type fits; a fraction does not
    fit a whole number."""

    def at(name: str, kind: str) -> Column:
        return F.try_variant_get(RECORD, record_path(name), kind)

    cells, fits = {}, F.lit(True)
    for f in schema.fields:
        value = at(f.name, f.dataType.simpleString())
        text = at(f.name, "string")  # NULL for a field that is missing or null, and for no other
        good = value.isNotNull()
        if isinstance(f.dataType, T.IntegralType):
            good = F.coalesce(value.cast("string") == text, F.lit(False))
            value = F.when(good, value)
        cells[f.name] = value
        if not isinstance(f.dataType, T.StringType):  # every value fits text
            fits = fits & (good | text.isNull())
    left = (RECORD, CORRUPT, *cells) if origin else (RECORD, CORRUPT, "source_system", *cells)
    kept = [f.name for f in RECORDS.fields if f.name not in left]
    corrupt = F.coalesce(CORRUPT, F.when(~fits, F.to_json(RECORD)))
    return records.select(*[c.alias(n) for n, c in cells.items()], corrupt.alias(CORRUPT), *kept)


def read_records(spark: SparkSession, bronze: str, schema_dir: str) -> DataFrame:
    """A bronze table of records with the columns seen so far."""
    schema = register_records(spark, bronze, schema_dir)
    return drawn(spark.read.schema(RECORDS).parquet(bronze), schema)


def ingest_stream(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema_dir: str,
    batch_id: str,
    source_system: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """New files of a folder as a stream with audit columns.

    JSON lines come as whole records, see :func:`record_stream`.  CSV headers must agree with
    the stored columns; a file with others fails instead of being read out of place.
    """
    if fmt == "json":
        return record_stream(spark, path, batch_id, source_system, max_files)
    schema = register_schema(spark, path, fmt, schema_dir)
    reader = spark.readStream.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return ingest_audit(reader.schema(schema).load(path), batch_id, source_system)


def start_table(
    df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None
) -> StreamingQuery:
    """Append a stream to a Parquet table, taking what is there now and ending."""
    writer = (
        df.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path)
