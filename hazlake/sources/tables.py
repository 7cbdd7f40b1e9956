"""Silver Parquet and the keyed store tables."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from hazlake.operators.dedupe import first_arrival, new_rows, numbered, picked
from hazlake.operators.normalize import marks
from hazlake.operators.ranges import CELLS, cell_of
from hazlake.schemas import KEYS, LAKE_COLUMNS, LAKE_ON_DISK, TABLES
from hazlake.session import STAGED, Scratch, path_exists


# More folders than a filter should name; beyond that none is left out.
MAX_FOLDERS = 5_000

# A number of its own for every row of a staged batch, by which narrow tables name its rows.
ROW = "_row"


# -- silver: as normalised, duplicates kept, one folder per date and source ---


def read_silver(spark: SparkSession, path: str, skip_corrupt: bool = False) -> DataFrame:
    """The ``lake`` rows with path columns ``date`` and ``source``; empty with all columns if unwritten."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LAKE_ON_DISK)
    reader = spark.read.schema(LAKE_ON_DISK).option("ignoreCorruptFiles", str(skip_corrupt).lower())
    return reader.parquet(path)


def reload_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver rows as typed records: nulls become defaults, unreadable files are skipped."""
    rows = read_silver(spark, path, skip_corrupt=True)
    empty = F.array().cast("array<string>")
    defaults = {
        **{
            c: F.coalesce(c, F.lit(""))
            for c in ("lake_id", "source_type", "source_name", "record_id", "collected_at", "date_partition")
        },
        "language": F.coalesce(F.nullif("language", F.lit("")), F.lit("en")),
        "keywords_hit": F.coalesce("keywords_hit", empty),
        "media_urls": F.coalesce("media_urls", empty),
    }
    return rows.withColumns(defaults).select(*LAKE_COLUMNS)


def unread_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, length, promised, found): silver files of which ``reload_silver`` skips rows.

    ``promised`` is the number of rows by the file's footer, null if that cannot be read; ``found`` the number of
    rows that could be decoded in all columns. Files are listed by the scan, so one
    of no bytes, which Spark skips without opening, is not among them. The rows of all files are read once.
    """
    columns = "file string, length long, promised long, found long"
    if not path_exists(spark, path):
        return spark.createDataFrame([], columns)
    name = F.col("_metadata.file_path").alias("file")
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
        .select(name, F.col("_metadata.file_size").alias("length"))
    )
    rows = read_silver(spark, path, skip_corrupt=True)
    # Without a column to decode, rows are counted by footers alone; the hash makes the other count decode all of them.
    promised = rows.select(name).groupBy("file").agg(F.count("*").alias("promised"))
    decoded = rows.select(name, F.xxhash64(*rows.columns).alias("h")).groupBy("file")
    found = decoded.agg(F.count("h").alias("found"))
    joined = listed.join(promised, "file", "left").join(found, "file", "left")
    files = joined.withColumn("found", F.coalesce("found", F.lit(0).cast("long")))
    return files.filter("promised IS NULL OR found < promised").select("file", "length", "promised", "found")


def write_silver(records: DataFrame, path: str, merge: bool = False) -> None:
    """Replace the touched date/source folders.

    ``merge`` is for input that may be only part of a folder's records: stored
    rows with other ids are kept, and so are those of an id whose rows the batch brings again as they are,
    each as often. Folders in which the batch replaces no stored id only get files added, so
    that a batch costs what it changes; of the others the rows to keep are staged first, because
    a folder is never overwritten while it is being read. Records with a column ``_row`` are staged already
    and lie by folder. For others ``rebalance`` lets AQE split a folder that holds much of the data over several files and tasks.
    """
    spark = records.sparkSession
    folders = {"date": F.coalesce("date_partition", F.lit("")), "source": F.coalesce("source_type", F.lit(""))}
    out = records.withColumns(folders)
    staged = ROW in records.columns
    if not staged:
        out = out.hint("rebalance", F.col("date"), F.col("source"))
    if not (merge and path_exists(spark, path)):
        _write_folders(out, path, "overwrite")
        return
    at = ["lake_id", "date", "source"]
    with Scratch(spark) as scratch:
        batch = out if staged else scratch.stage(numbered(_marked(out)))
        narrow = scratch.stage(_marked(batch).select(*at, *marks(), ROW))
        # The folders the batch touches, as literals: the stored side then lists and reads no other folder.
        stored = _named_folders(read_silver(spark, path), narrow.select("date", "source").distinct())
        hit = scratch.stage(stored.select(*at).join(narrow.select(*at), at, "left_semi").select("date", "source").distinct())
        if hit.isEmpty():
            _write_folders(batch, path, "append")
            return
        # Where a stored row lies and its marks are short; only that is shuffled to find the rows to leave out.
        placed = read_silver(spark, path).withColumns({"file": F.col("_metadata.file_path"), ROW: F.col("_metadata.row_index")})
        stored = _inside(_named_folders(placed, hit), hit)
        held = scratch.stage(_marked(stored).select(*at, *marks(), "file", ROW))
        other = scratch.stage(narrow.join(_unchanged(narrow, held, at), at, "left_anti").select(*at, ROW))
        if other.isEmpty():
            return
        new = picked(batch, other, [])
        gone = scratch.stage(held.join(other.select(*at), at, "left_semi").select("date", "source", "file", ROW))
        replaced = scratch.stage(gone.select("date", "source").distinct())
        _write_folders(_outside(new, replaced), path, "append")
        if not replaced.isEmpty():
            kept = scratch.stage(picked(_inside(stored, replaced), gone, ["file"], keep=False).select(*LAKE_COLUMNS, "date", "source"))
            _write_folders(kept.unionByName(_inside(new, replaced).select(*kept.columns)), path, "overwrite")


def _marked(rows: DataFrame) -> DataFrame:
    return rows if set(marks()) <= set(rows.columns) else rows.withColumns(marks())


def _unchanged(batch: DataFrame, held: DataFrame, at: list[str]) -> DataFrame:
    """The ids (with their folder) whose rows in ``batch`` are those of ``held``, each as often."""
    both = batch.select(*at, *marks(), F.lit(1).alias("n")).unionAll(held.select(*at, *marks(), F.lit(-1).alias("n")))
    rows = both.groupBy(*at, *marks()).agg(F.sum("n").alias("more"))
    return rows.groupBy(*at).agg(F.bool_and(F.col("more") == 0).alias("same")).filter("same").select(*at)


def _named_folders(stored: DataFrame, folders: DataFrame) -> DataFrame:
    """Silver rows of folders with a date and a source that ``folders`` names; no other folder is listed."""
    named = folders.limit(MAX_FOLDERS + 1).collect()
    # An empty name is read back as null.
    names = {name: F.coalesce(name, F.lit("")) for name in ("date", "source")}
    if len(named) <= MAX_FOLDERS:
        for name, value in names.items():
            stored = stored.filter(value.isin(sorted({r[name] for r in named})))
    return stored.withColumns(names)


def _inside(rows: DataFrame, folders: DataFrame) -> DataFrame:
    return rows.join(F.broadcast(folders), ["date", "source"], "left_semi").select(*rows.columns)


def _outside(rows: DataFrame, folders: DataFrame) -> DataFrame:
    return rows.join(F.broadcast(folders), ["date", "source"], "left_anti").select(*rows.columns)


def _write_folders(out: DataFrame, path: str, mode: str) -> None:
    (
        out.select(*LAKE_COLUMNS, "date", "source").write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("date", "source")
        .parquet(path)
    )


def list_partitions(spark: SparkSession, path: str) -> DataFrame:
    """Stored date/source folders, from a listing of the folders; no file is opened."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/date=*/source=*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    folders = [(f.getPath().getParent().getName(), f.getPath().getName()) for f in found]
    rows = sorted((unquote(d.partition("=")[2]), unquote(s.partition("=")[2])) for d, s in folders)
    return spark.createDataFrame(rows, "date string, source string")


# -- store: one row per key, first arrival wins -------------------------------
#
# ``<table>/date=/insert=``            rows, an insert's files in folders of its own
# ``keys/<table>/bucket=/insert=``     their keys by hash, in order of the hash
# ``inserts/<table>/<id>``             an empty file per insert, made before its first row is written
# ``done/<work>/<id>``                 an empty file per insert, made after the work on it is done
#
# What is derived from rows goes by insert: the inserts that a work has no file for are what it still has to do.

KEY_BUCKETS = 16
# So many keys are named in the filter on the key table; it then skips row groups too.
NAMED_KEYS = 1_000


def table_path(store_dir: str, table: str) -> str:
    return f"{store_dir}/{table}"


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _touch(spark: SparkSession, path: str) -> None:
    at, fs = _files(spark, path)
    fs.create(at, True).close()


def _names(spark: SparkSession, pattern: str) -> list[str]:
    """Last names of the paths that match, in order."""
    at, fs = _files(spark, pattern)
    return sorted(f.getPath().getName() for f in fs.globStatus(at) or [])


def _paths(spark: SparkSession, patterns: list[str]) -> list[str]:
    found = []
    for pattern in patterns:
        at, fs = _files(spark, pattern)
        found += [f.getPath().toString() for f in fs.globStatus(at) or []]
    return found


def pending(spark: SparkSession, store_dir: str, table: str, work: str) -> list[str]:
    """Inserts of a table that ``work`` is not done for, from two folder listings."""
    done = set(_names(spark, f"{store_dir}/done/{work}/*"))
    return [i for i in _names(spark, f"{store_dir}/inserts/{table}/*") if i not in done]


def mark_done(spark: SparkSession, store_dir: str, work: str, insert: str) -> None:
    _touch(spark, f"{store_dir}/done/{work}/{insert}")


def _disk_schema(table: str) -> T.StructType:
    cells = [*[T.StructField(c, T.IntegerType()) for c in CELLS], T.StructField("doc", T.LongType())] if table == "lake_records" else []
    return T.StructType(TABLES[table].fields + cells + [T.StructField("date", T.StringType()), T.StructField("insert", T.StringType())])


def _stored(spark: SparkSession, store_dir: str, table: str) -> DataFrame:
    """A store table with the folder columns ``date`` and ``insert``; empty if unwritten."""
    path, schema = table_path(store_dir, table), _disk_schema(table)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_table(spark: SparkSession, store_dir: str, table: str) -> DataFrame:
    """A store table with its folder column ``date``; empty when nothing was stored yet."""
    return _stored(spark, store_dir, table).drop("insert", "doc", *CELLS)


def read_cells(spark: SparkSession, store_dir: str) -> DataFrame:
    """``lake_records`` with the grid cell each row was stored under."""
    return _stored(spark, store_dir, "lake_records").drop("insert", "doc")


def read_numbers(spark: SparkSession, store_dir: str) -> DataFrame:
    """(insert, doc, lake_id, date_partition) of ``lake_records``: the text index names a record by the first two."""
    return _stored(spark, store_dir, "lake_records").select("insert", "doc", "lake_id", "date_partition")


def read_insert(spark: SparkSession, store_dir: str, table: str, insert: str) -> DataFrame:
    """The rows of one insert; no other insert's folder is listed."""
    return read_folders(spark, table_path(store_dir, table), f"date=*/insert={insert}", _disk_schema(table)).drop("insert")


def read_folders(spark: SparkSession, path: str, pattern: str, schema: T.StructType) -> DataFrame:
    """The rows below ``path`` in folders of a pattern; no other folder is listed."""
    found = _paths(spark, [f"{path}/{pattern}"])
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*found)


def put(df: DataFrame, path: str, *folders: str) -> None:
    """Replace the folders that ``df`` has rows for.

    Spark then gathers a job's files in a folder of the job's own, so that writers at the
    same time do not disturb each other, and a repeated write replaces itself.
    """
    out = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**STAGED)
    out.partitionBy(*folders).parquet(path)


def _key(table: str) -> Column:
    return F.xxhash64(*KEYS[table])


def _bucket(key: Column) -> Column:
    return F.pmod(key, F.lit(KEY_BUCKETS)).cast("int")


def read_keys(spark: SparkSession, store_dir: str, table: str, buckets: list[int] | None = None) -> DataFrame:
    """Stored keys with their hash ``key``, of some buckets or of all; other buckets are not listed."""
    path, fields = f"{store_dir}/keys/{table}", {f.name: f for f in TABLES[table].fields}
    schema = T.StructType(
        [fields[k] for k in KEYS[table]] + [T.StructField("key", T.LongType()), T.StructField("bucket", T.IntegerType()), T.StructField("insert", T.StringType())]
    )
    wanted = ["*"] if buckets is None else [str(b) for b in buckets]
    found = _paths(spark, [f"{path}/bucket={b}" for b in wanted])
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*found)


def write_keys(spark: SparkSession, store_dir: str, table: str, insert: str) -> None:
    """Add the keys of an insert to the key table; writing them again replaces them."""
    rows = read_insert(spark, store_dir, table, insert).select(*KEYS[table], _key(table).alias("key"))
    keyed = rows.withColumns({"bucket": _bucket(F.col("key")), "insert": F.lit(insert)})
    ordered = keyed.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "key")
    put(ordered, f"{store_dir}/keys/{table}", "bucket", "insert")
    mark_done(spark, store_dir, f"keys-{table}", insert)


def stored_keys(batch: DataFrame, store_dir: str, table: str) -> DataFrame:
    """The stored keys that can be a key of ``batch``: its buckets are named, and few keys one by one."""
    spark = batch.sparkSession
    if not path_exists(spark, f"{store_dir}/keys/{table}"):
        return read_keys(spark, store_dir, table)
    # At most KEY_BUCKETS numbers.
    held = batch.agg(F.count("*").alias("rows"), F.collect_set(_bucket(_key(table))).alias("buckets")).first()
    keys = read_keys(spark, store_dir, table, sorted(held["buckets"]))
    if held["rows"] > NAMED_KEYS:
        return keys
    return keys.filter(F.col("key").isin([r["key"] for r in batch.select(_key(table).alias("key")).collect()]))


def insert_new(batch: DataFrame, store_dir: str, table: str) -> str:
    """Append rows with new keys; returns the id of the insert.

    What is stored already is looked up in the key table, in the batch's buckets alone, so an insert
    costs what its batch costs; of rows with stored keys nothing but the keys is read. Which of the others come first is found on keys and times; whole rows are shuffled once,
    by date, when the batch is staged, and not at all if it is staged already (column ``_row``). Inserts whose job died before it wrote their keys are given theirs first.
    Inserts at the same time break nothing, but may both store a key that is new to both.
    """
    spark = batch.sparkSession
    fields = TABLES[table].fields
    carried = [c for c in batch.columns if c in (ROW, "_hash")]
    typed = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields], *carried)
    for left in pending(spark, store_dir, table, f"keys-{table}"):
        write_keys(spark, store_dir, table, left)
    with Scratch(spark) as scratch:
        if ROW not in typed.columns:
            typed = scratch.stage(numbered(typed.hint("rebalance", F.col("date_partition"))))
        keys = scratch.stage(typed.select(*KEYS[table], ROW))
        new = scratch.stage(new_rows(keys, stored_keys(keys, store_dir, table), KEYS[table]).select(ROW))
        if new.isEmpty():
            return uuid.uuid4().hex
        row_hash = F.col("_hash") if "_hash" in carried else F.xxhash64(*[f.name for f in fields]).alias("_hash")
        narrow = picked(typed, new, []).select(
            *KEYS[table], "date_partition", *[c for c in ("collected_at",) if c not in KEYS[table]], row_hash, ROW,
        )
        firsts = first_arrival(narrow, KEYS[table], [F.col("date_partition"), F.col("collected_at"), F.col("_hash")])
        return _append(picked(typed, firsts, []).drop(ROW, "_hash"), store_dir, table)


def _append(fresh: DataFrame, store_dir: str, table: str) -> str:
    """Write the rows of an insert, then their keys; returns its id."""
    spark, insert = fresh.sparkSession, uuid.uuid4().hex
    if table == "lake_records":
        fresh = fresh.withColumns({c: cell_of(F.col(c.removesuffix("_cell"))) for c in CELLS})
    # Within a folder, rows lie by grid cell where they have a position: box queries then skip row groups.
    layout = ["date"] + [c for c in (*CELLS, "lat", "lon") if c in fresh.columns]
    rows = fresh.withColumns({"date": F.col("date_partition"), "insert": F.lit(insert)})
    rows = rows.sortWithinPartitions(*layout)
    if table == "lake_records":
        rows = rows.withColumn("doc", F.monotonically_increasing_id())
    at = f"{store_dir}/inserts/{table}/{insert}"
    _touch(spark, at)
    put(rows, table_path(store_dir, table), "date", "insert")
    if _paths(spark, [f"{table_path(store_dir, table)}/date=*/insert={insert}"]):
        write_keys(spark, store_dir, table, insert)
    else:
        path, fs = _files(spark, at)
        fs.delete(path, False)
    return insert


def insert_or_ignore(batch: DataFrame, store_dir: str, table: str) -> DataFrame:
    """Append rows with new keys; returns the inserted rows, read back from the table.

    Running the same batch again inserts nothing, so a failed or repeated job is safe to rerun.
    """
    insert = insert_new(batch, store_dir, table)
    return read_insert(batch.sparkSession, store_dir, table, insert).select(*TABLES[table].fieldNames())
