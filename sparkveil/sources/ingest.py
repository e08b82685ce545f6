"""Extracts in, batches committed by manifest, mappings versioned, authorised landing."""

import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import authorized, contradictory, unauthorized
from ..operators.schema import ContractError, require_rows
from . import files
from .ledger import Ledger
from .tables import STORED, delete

# stored_columns and data: the columns of the batch as stored, and its folder. Readers follow them.
MANIFEST = "dataset string, batch_id string, source_file string, source_file_hash string, rows bigint, column_count int, column_names array<string>, ingested_at string, duration_seconds double, stored_columns array<string>, data string"
WAREHOUSE = "305"  # the extract holds this warehouse alone


def manifest(spark: SparkSession, root: str) -> Ledger:
    return Ledger(spark, f"{root}/manifest", MANIFEST)


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """A row a file, in the order of version."""
    return manifest(spark, root).read()


def extracts(spark: SparkSession, folder: str, prefix: str = "") -> DataFrame:
    """file_name, path, modified of the files and folders of part files in a drop folder whose names start with prefix."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(folder)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(target)
    rows = [(s.getPath().getName(), s.getPath().toString(), s.getModificationTime()) for s in found]
    return spark.createDataFrame(rows, "file_name string, path string, modified bigint").where(F.col("file_name").startswith(prefix) | F.col("file_name").startswith(f"~${prefix}"))


def newest_file(files: DataFrame) -> DataFrame:
    """The file modified last; lock files do not count, ties go to the later name."""
    return files.where(~F.col("file_name").startswith("~$")).agg(F.max_by("file_name", F.struct("modified", "file_name")).alias("file_name"))


def find_extract(spark: SparkSession, folder: str, prefix: str = "") -> str:
    name = newest_file(extracts(spark, folder, prefix)).first().file_name
    if name is None:
        raise ContractError(f"no extract {prefix}* in {folder}")
    return f"{folder.rstrip('/')}/{name}"


def snapshot_date(file_name: F.Column) -> F.Column:
    day = F.regexp_extract(file_name, r"(\d{8})", 1)
    return F.when(F.try_to_timestamp(day, F.lit("yyyyMMdd")).isNotNull(), day)


def new_files(hashes: DataFrame, taken: DataFrame, dataset: str) -> DataFrame:
    """Files whose content this dataset has not taken in."""
    return hashes.join(taken.where(F.col("dataset") == dataset).select("source_file_hash"), "source_file_hash", "left_anti")


def _uri(spark: SparkSession, path: str) -> str:
    """A path as Spark writes it in its metadata, but for the slashes of file: URIs."""
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).toUri().toString()


def _commit(spark: SparkSession, rows: DataFrame, found: list, dataset: str, batch: str, key: str, root: str, run_time: str, began: float, check: Callable[[DataFrame], None]) -> None:
    """rows in a folder of their own, then a manifest row a file, in one commit that makes the batch visible. Rows a file
    are counted in what has been written. Whatever fails before leaves a folder that nothing names, which is deleted
    where the failure can still be met."""
    stored = [c for c in rows.columns if c != files.SOURCE]
    if key in stored:
        raise ContractError(f"the extract has a column {key} of its own")
    place = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(batch)
    data = f"{root}/{dataset}/{key}={place}/load={uuid.uuid4().hex}"
    try:
        rows.write.option("compression", STORED).parquet(data)
        plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
        counts = spark.read.schema(f"{files.SOURCE} string").parquet(data).groupBy(plain(F.col(files.SOURCE)).alias("place")).agg(F.count("*").alias("rows"))
        known = spark.createDataFrame([(f.path, _uri(spark, f.path), f.source_file_hash, list(f.header)) for f in found], "source_file string, uri string, source_file_hash string, column_names array<string>")
        record = known.withColumn("place", plain(F.col("uri"))).join(counts, "place", "left").select(
            F.lit(dataset).alias("dataset"), F.lit(batch).alias("batch_id"), "source_file", "source_file_hash", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), F.lit(len(stored) + 1).alias("column_count"),
            "column_names", F.lit(run_time).alias("ingested_at"), F.lit(round(time.time() - began, 3)).alias("duration_seconds"), F.array(*map(F.lit, stored)).alias("stored_columns"), F.lit(data).alias("data"),
        )
        manifest(spark, root).append(record, check)
    except Exception:
        delete(spark, data)
        raise


def refuse_batch(dataset: str, batch: str) -> Callable[[DataFrame], None]:
    def check(taken: DataFrame) -> None:
        if not taken.where((F.col("dataset") == dataset) & (F.col("batch_id") == batch)).isEmpty():
            raise ContractError(f"{dataset} {batch} has been ingested")

    return check


def ingest(spark: SparkSession, dataset: str, path: str, root: str, batch_id: str, run_time: str, force: bool = False) -> DataFrame:
    """The files of an extract as a batch. Of several files those are taken whose content this dataset has not taken in
    yet; if that is none, the extract is refused; force takes all. A batch id that is in use is always refused, also if
    another run commits it, or the same content, while this one is at work."""
    began = time.time()
    unused = refuse_batch(dataset, batch_id)
    taken = read_manifest(spark, root)
    unused(taken)
    hashes = files.scanned(spark, path)
    found = (hashes if force else new_files(hashes, taken, dataset)).collect()  # one row a file of the extract
    if not found:
        raise ContractError(f"{path} has been ingested as {dataset}")
    rows = files.read_files(spark, found).withColumn("ingested_at", F.lit(run_time))
    require_rows(rows, path)
    own = spark.createDataFrame([(f.source_file_hash,) for f in found], "source_file_hash string")

    def check(before: DataFrame) -> None:
        unused(before)
        if not force and not own.join(before.where(F.col("dataset") == dataset), "source_file_hash", "left_semi").isEmpty():
            raise ContractError(f"{path} has been ingested as {dataset} meanwhile")

    _commit(spark, rows, found, dataset, batch_id, "batch_id", root, run_time, began, check)
    return committed(spark, dataset, root)


def ingest_inventory(spark: SparkSession, path: str, root: str, run_time: str, force: bool = False) -> DataFrame:
    """A stock extract as the snapshot of the date in its name. A snapshot that is there already is refused; force
    replaces it, that one alone: readers take the last one committed."""
    began = time.time()
    day = spark.range(1).select(snapshot_date(F.lit(path.rstrip("/").rsplit("/", 1)[-1])).alias("day")).first().day
    if day is None:
        raise ContractError(f"no date yyyyMMdd in the name of {path}")
    check = (lambda before: None) if force else refuse_batch("inventory", day)
    check(read_manifest(spark, root))
    found = files.scanned(spark, path).collect()
    if not found:
        raise ContractError(f"{path} has no files")
    rows = files.read_files(spark, found, "stage").withColumn("warehouse_code", F.lit(WAREHOUSE))
    require_rows(rows, path)
    _commit(spark, rows, found, "inventory", day, "snapshot_date", root, run_time, began, check)
    return committed(spark, "inventory", root, "snapshot_date")


def batches(spark: SparkSession, dataset: str, root: str) -> DataFrame:
    """batch_id, stored_columns, data of each batch as last committed."""
    own = read_manifest(spark, root).where(F.col("dataset") == dataset)
    return own.groupBy("batch_id").agg(F.max_by(F.struct("stored_columns", "data"), "version").alias("v")).select("batch_id", "v.*")


def _read(spark: SparkSession, found: list, dataset: str, root: str, key: str) -> DataFrame:
    """Batches by the schemas that the manifest has of them: those of one schema are read together, a column that a batch
    lacks is null there."""
    groups: dict[tuple, list[str]] = {}
    for b in found:
        groups.setdefault(tuple(b.stored_columns), []).append(b.data)
    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    parts = []
    for columns, folders in sorted(groups.items()):
        schema = ", ".join([*(f"{quoted(c)} string" for c in columns), f"{quoted(key)} string", "load string"])
        parts.append(spark.read.schema(schema).option("basePath", f"{root}/{dataset}").parquet(*folders).drop("load"))
    if not parts:
        return spark.createDataFrame([], f"{key} string")
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return whole.select(key, *(whole[quoted(c)] for c in whole.columns if c != key))


def committed(spark: SparkSession, dataset: str, root: str, key: str = "batch_id") -> DataFrame:
    """All committed batches, under all columns that any of them has."""
    return _read(spark, batches(spark, dataset, root).collect(), dataset, root, key)  # one row a batch


def read_batch(spark: SparkSession, dataset: str, root: str, batch: str | None = None, key: str = "batch_id") -> DataFrame:
    """One batch, the last by name unless told, under its own columns: one that is new in it is there, one that only
    other batches have is not."""
    found = batches(spark, dataset, root)
    wanted = found.agg(F.max_by(F.struct("*"), "batch_id").alias("b")).where("b IS NOT NULL").select("b.*") if batch is None else found.where(F.col("batch_id") == batch)
    if not (own := wanted.collect()):
        raise ContractError(f"{dataset} has no batch {batch or ''}")
    return _read(spark, own, dataset, root, key)


def vacuum(spark: SparkSession, dataset: str, root: str) -> int:
    """Deletes the loads that no batch reads any more: those that were replaced, and what failed writers could not delete.
    To be called when no writer and no reader of replaced snapshots is at work. Returns how many went."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root}/{dataset}/*/load=*")
    system = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    kept = {jvm.org.apache.hadoop.fs.Path(b.data).toUri().getPath() for b in batches(spark, dataset, root).collect()}
    gone = [s.getPath() for s in system.globStatus(pattern) or [] if s.getPath().toUri().getPath() not in kept]
    for path in gone:
        system.delete(path, True)
    return len(gone)


def latest_batch(df: DataFrame, key: str = "batch_id") -> DataFrame:
    """Rows of the last batch by name; the scalar subquery prunes partitions."""
    return df.where(F.col(key) == df.agg(F.max(key)).scalar())


VERSIONS = "folder string"


def publish(mapping: DataFrame, root: str, base_version: int) -> int:
    """mapping as version base_version + 1, in a folder of its own. Of two publishers from one base one is refused."""
    folder = f"{root}/table-{uuid.uuid4().hex}"
    spark = mapping.sparkSession
    mapping.write.parquet(folder)
    try:
        return Ledger(spark, f"{root}/versions", VERSIONS).append(spark.createDataFrame([(folder,)], VERSIONS), expected=base_version)
    except Exception:
        delete(spark, folder)
        raise


def current(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(Ledger(spark, f"{root}/versions", VERSIONS).read().agg(F.max_by("folder", "version")).first()[0])


def write_profiles(customers: DataFrame, products: DataFrame, categories: DataFrame, root: str) -> None:
    """The bases of the mappings and the products of each category."""
    for name, df in (("customer_base", customers), ("product_base", products), ("category_profile", categories)):
        df.write.mode("overwrite").parquet(f"{root}/{name}")


LANDED = "batch string, rows bigint, data string, report string"


def land(facts: DataFrame, reports: DataFrame, destination: str, dataset: str, key: str = "batch_id") -> int:
    """Facts and their reports under the destination, visible by one commit that names both. Refused as a whole if a batch
    lacks a report of its own that authorises it, or has reports that disagree; reports of other batches are not landed.
    A batch that is landed again replaces what it was."""
    spark = facts.sparkSession
    require_rows(facts, dataset)
    if bad := [r[0] for r in unauthorized(facts, reports, key).limit(20).collect()]:
        raise ContractError(f"{dataset}: batches without an authorising report: {bad}")
    own = reports.join(facts.select(F.col(key).alias("batch")).distinct(), "batch", "left_semi")
    if bad := [r[0] for r in contradictory(own).limit(20).collect()]:
        raise ContractError(f"{dataset}: batches whose reports disagree: {bad}")
    load = f"{destination}/{dataset}/load={uuid.uuid4().hex}"
    data, report = f"{load}/facts", f"{load}/quality_reports"
    try:
        authorized(facts, reports, key).write.option("compression", STORED).partitionBy(key).parquet(data)
        own.write.parquet(report)
        counts = spark.read.schema(f"{facts.schema[key].name} string").parquet(data).groupBy(F.col(key).alias("batch")).agg(F.count("*").alias("rows"))
        return Ledger(spark, f"{destination}/{dataset}/landings", LANDED).append(counts.select("batch", "rows", F.lit(data).alias("data"), F.lit(report).alias("report")))
    except Exception:
        delete(spark, load)
        raise


def landings(spark: SparkSession, destination: str, dataset: str) -> DataFrame:
    """batch, rows, data, report, version: each batch as last landed."""
    rows = Ledger(spark, f"{destination}/{dataset}/landings", LANDED).read()
    return rows.groupBy("batch").agg(F.max_by(F.struct("rows", "data", "report", "version"), "version").alias("v")).select("batch", "v.*")


def _landed(spark: SparkSession, destination: str, dataset: str, folder: str, schema: str, batch: str) -> DataFrame:
    """Rows of landed batches from the folders that their commits name; a batch that was landed anew is taken from the
    last alone."""
    by: dict[str, list[str]] = {}
    for r in landings(spark, destination, dataset).collect():  # one row a batch
        by.setdefault(r[folder], []).append(r.batch)
    parts = [spark.read.schema(schema).parquet(path).where(F.col(batch).isin(names)) for path, names in sorted(by.items())]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def landed(spark: SparkSession, destination: str, dataset: str, schema: str, key: str = "batch_id") -> DataFrame:
    return _landed(spark, destination, dataset, "data", schema, key)


def landed_reports(spark: SparkSession, destination: str, dataset: str, schema: str = "batch string, overall_status string") -> DataFrame:
    return _landed(spark, destination, dataset, "report", schema, "batch")
