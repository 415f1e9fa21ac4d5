"""Sinks. All of them write from the executors; nothing passes through the driver."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltgate.functions import sql
from siltgate.operators.dedup import ARRIVAL
from siltgate.sources.files import ESCAPES, Folders, is_catalog_of_its_own, table_folder

LAYER = "_layer"
COLUMNS_FILE = "_common_metadata"  # where Parquet readers look for a folder's columns first


def write_layer(df: DataFrame, where: str) -> Observation:
    """Replace a layer table (path, or table name without a slash), schema included.

    Returns an observation whose ``get["rows"]`` is the row count, taken while
    writing. The target must not be one of the inputs of ``df``.

    The new rows are written beside the old ones, which stay as they are until the
    job is done, and then swapped in: a job that fails leaves the old layer. Between
    the two renames of a swap a folder is missing for a moment; should the driver be
    lost just then, ``read_layer`` and the next write put the old folder back. A layer
    has one writer at a time.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    spark = df.sparkSession
    if is_catalog_of_its_own(spark, where):
        counted.writeTo(where).using("parquet").createOrReplace()
        return seen
    folders = Folders(spark)
    beside = folders.beside(_home(spark, where))
    try:
        counted.write.parquet(beside)
        _swap_in(spark, folders, beside, where, df.schema)
    finally:
        folders.delete(beside)
    return seen


def write_layers(df: DataFrame, targets: Mapping[str, tuple[str, T.StructType]]) -> None:
    """Replace several layers in one job, from rows that name theirs in ``_layer``.

    ``targets`` has the place and the columns of each layer; ``df`` has all columns, of one
    type each. Rows are written once, partitioned by layer, and each partition's
    folder becomes that layer. It holds the other layers' columns too, as NULLs; a
    file of its own columns (``COLUMNS_FILE``), or a table's schema, tells readers
    which to take. Rows of a layer without a target are not written anywhere; the
    write fails before it replaces anything if there are any.
    """
    spark = df.sparkSession
    folders = Folders(spark)
    seen = Observation()
    known = F.col(LAYER).isin(list(targets))
    counted = df.observe(seen, F.count_if(~F.coalesce(known, F.lit(False))).alias("strays"))
    beside = folders.beside(_home(spark, next(iter(targets.values()))[0]))
    try:
        counted.write.partitionBy(LAYER).parquet(beside)
        if strays := seen.get["strays"]:
            raise ValueError(f"{strays} row(s) belong to none of the layers {list(targets)}")
        for layer, (_, schema) in targets.items():
            folder = f"{beside}/{LAYER}={layer}"
            folders.make(folder)
            _store_columns(spark, folders, schema, folder)
        for layer, (where, schema) in targets.items():
            _swap_in(spark, folders, f"{beside}/{LAYER}={layer}", where, schema)
    finally:
        folders.delete(beside)


def _store_columns(spark: SparkSession, folders: Folders, schema: T.StructType, folder: str) -> None:
    """A Parquet file without rows, of these columns, as the folder's ``COLUMNS_FILE``."""
    empty = f"{folder}/_columns"
    spark.createDataFrame([], schema).coalesce(1).write.parquet(empty)
    folders.move(folders.data_files(empty)[0], f"{folder}/{COLUMNS_FILE}")
    folders.delete(empty)


def _home(spark: SparkSession, where: str) -> str:
    """The folder that a layer's data is, or would be, in."""
    return where.rstrip("/") if "/" in where else table_folder(spark, where)


def _swap_in(spark: SparkSession, folders: Folders, new: str, where: str, schema: T.StructType) -> None:
    if "/" in where:
        folders.swap(new, where.rstrip("/"))
        return
    # A table goes on pointing at its old folder until one step of the catalog.
    own = folders.fresh(table_folder(spark, where))
    folders.move(new, own)
    old = None
    if spark.catalog.tableExists(where):
        detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {where}").collect()}
        old = detail.get("Location")
        if _kinds(spark.table(where).schema) == _kinds(schema) and detail.get("Provider") == "parquet":
            spark.sql(f"ALTER TABLE {where} SET LOCATION {sql.text(own)}")
            spark.catalog.refreshTable(where)
            folders.delete(old)
            return
        spark.sql(f"DROP TABLE {where}")
    spark.catalog.createTable(where, path=own, source="parquet", schema=schema)
    if old:
        folders.delete(old)


def _kinds(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


MOST_RANKED = 1_000_000  # files whose hashes and ranks, 16 bytes each, go to all executors


def land(df: DataFrame, where: str) -> Observation:
    """Store raw rows with an ``_arrival`` number, so that 'first seen' means the same in
    every later pass. It is unique. Rows of files go by file name, then by their place
    in the file, however the files are cut and dealt to tasks; other rows by partition.

    The number is one decimal of fixed width: the rank of the file among the sorted names,
    the place of the file's block, and the row's number in its task. A row carries no
    path, and a least arrival is found by hashing."""
    return write_layer(_numbered(df), where)


def _numbered(df: DataFrame) -> DataFrame:
    number = F.monotonically_increasing_id()
    try:
        rows = df.select(
            "*",
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_block_start").alias("_block"),
            number.bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"),
        )
    except AnalysisException:  # no file source
        return df.withColumn(ARRIVAL, number)
    paths = sorted(df.inputFiles())
    ranks = df.sparkSession.createDataFrame(list(enumerate(paths)), "_rank long, _name string")
    ranks = ranks.withColumn("_name", _one_slash(F.col("_name")))
    rows = rows.withColumn("_path", _one_slash(F.col("_path")))
    hashed = ranks.select("_rank", F.xxhash64("_name").alias("_file"))
    if hashed.agg(F.count_distinct("_file")).first()[0] < len(paths):
        hashed, key = ranks.withColumnRenamed("_name", "_file"), F.col("_path")
    else:
        key = F.xxhash64("_path")
    if len(paths) <= MOST_RANKED:
        hashed = F.broadcast(hashed)
    rank = F.coalesce("_rank", F.raise_error(F.concat(F.lit("not a file of the input: "), "_path")))
    # Less than 10^10 rows to a task and 10^14 bytes to a file: 37 digits in all.
    arrival = (
        rank.cast("decimal(12,0)") * F.lit(Decimal(10**24))
        + F.col("_block").cast("decimal(15,0)") * F.lit(Decimal(10**10))
        + F.col("_row").cast("decimal(10,0)")
    ).cast("decimal(38,0)")
    met = rows.join(hashed, key == F.col("_file"), "left")
    return met.select(*df.columns, arrival.alias(ARRIVAL))


def _one_slash(path: Column) -> Column:
    """A path however many slashes follow its scheme, which Spark writes in two ways."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def append_history(df: DataFrame, where: str) -> None:
    """Add a run's rows to a history, a folder or (without a slash) a catalog table, that
    is partitioned by ``run_id``, a string.

    Writing the same run again (a retried job) replaces that run and leaves all
    other runs alone. Columns that the history lacks are added to it, and earlier runs
    read as NULL there; columns that the run lacks are NULL for it. A table refuses a
    run whose column can't be stored under the type it has there, before anything is
    written; names are compared as the catalog does, in any case of letters.
    """
    spark = df.sparkSession
    typed = df.withColumn("run_id", F.col("run_id").cast("string"))
    if "/" not in where and spark.catalog.tableExists(where):
        fitted = _fitted(spark, typed, where)
        writer = fitted.write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").insertInto(where)
        return
    writer = typed.write.mode("overwrite").partitionBy("run_id")
    writer = writer.option("partitionOverwriteMode", "dynamic")
    if "/" in where:
        writer.parquet(where)
    else:
        writer.saveAsTable(where, format="parquet")


# To what a column's values may go without loss, in the order of width.
_WIDER = ("tinyint", "smallint", "int", "bigint")


def _fitted(spark: SparkSession, run: DataFrame, where: str) -> DataFrame:
    """The run's rows under the history table's columns, new ones added to it first."""
    stored = {f.name.lower(): f for f in spark.table(where).schema.fields}
    own = {f.name.lower(): f for f in run.schema.fields}
    for name, field in own.items():
        known = stored.get(name)
        if known is not None and not _storable(field.dataType, known.dataType):
            raise ValueError(
                f"{where}: column {known.name!r} is {known.dataType.simpleString()} in the history"
                f" and {field.dataType.simpleString()} in this run"
            )
    new = [f for name, f in own.items() if name not in stored]
    if new:
        added = ", ".join(f"{sql.name(f.name)} {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {where} ADD COLUMNS ({added})")
    return run.select(*[_stored_as(own.get(f.name.lower()), f) for f in spark.table(where).schema.fields])


def _storable(own: T.DataType, stored: T.DataType) -> bool:
    a, b = own.simpleString(), stored.simpleString()
    if a == b or a == "void":
        return True
    return a in _WIDER and b in _WIDER and _WIDER.index(a) < _WIDER.index(b)


def _stored_as(own: T.StructField | None, stored: T.StructField) -> Column:
    value = F.lit(None) if own is None else F.col(sql.name(own.name))
    return value.cast(stored.dataType).alias(stored.name)


def write_csv(df: DataFrame, path: str, escaped: bool = False) -> None:
    """A folder of CSV parts, each with a header. NULL and the empty string are both an
    empty field; spaces and microseconds are kept.

    A line break inside a text would make readers that cut files into splits see two
    rows. With ``escaped`` texts hold no line break, quote-breaking backslash or percent sign but as
    ``%0A``, ``%0D``, ``%5C`` and ``%25``; ``read_csv(..., escaped=True)`` undoes that,
    and files stay splittable.
    """
    if escaped:
        df = df.select(*[_escape(f) for f in df.schema.fields])
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .csv(path)
    )


def _escape(field: T.StructField) -> Column:
    value = F.col(sql.name(field.name))
    if isinstance(field.dataType, T.StringType):
        for plain, code in ESCAPES:
            value = F.replace(value, F.lit(plain), F.lit(code))
    return value.alias(field.name)
