"""A replica stored by key buckets: a compaction rewrites the buckets that changed, no others.

Every key belongs to one of a fixed number of buckets by its hash, the hash Spark shuffles by.
A bucket's rows lie in one folder per version; a manifest of one row names the current version
of every bucket and the batches applied. Versions are never written twice and the manifest
comes last: a compaction that dies leaves folders nobody reads, and the next one starts anew.

Rows keep the sequence number of the change they came from, deleted ones stay as markers, so
an older change that arrives late has no effect. The storage is read as a bucketed table: a
join by key shuffles the changes alone, whatever the replica's size.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.merge import DELETE, latest_changes
from strata.streaming.replica import Snapshot, later_changes
from strata.streaming.tables import BATCH, WRITER, read_table

BUCKET, VERSION = "replica_bucket", "replica_version"  # folders
APPLIED, GONE = "replica_seq", "replica_gone"  # stored beside the columns of a row
MANIFEST = "buckets int, keys array<string>, columns string, versions map<int,string>, upto map<string,long>"
_TABLES: dict[tuple, str] = {}  # tables declared by this process: a state never changes


@dataclass(frozen=True)
class Store:
    """One state of a stored replica; ``versions`` has the buckets that hold rows."""

    location: str
    number: int
    buckets: int
    keys: tuple[str, ...]
    columns: StructType
    versions: dict[int, str]
    upto: dict[str, int]

    def bucket_of(self) -> Column:
        """The bucket of a row, as Spark's own bucketed files number it."""
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets))


def _names(columns: Sequence[str]) -> str:
    return ", ".join("`" + c.replace("`", "``") + "`" for c in columns)


def _declared(spark: SparkSession, store: Store) -> str:
    """A state's versions as a bucketed table of the session; its name."""
    name = f"replica_{uuid.uuid4().hex}"
    stored = ", ".join(f"{_names([f.name])} {f.dataType.simpleString()}" for f in store.columns)
    location = f"{store.location}/rows".replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({stored}, {APPLIED} bigint, {GONE} boolean, {BUCKET} int, {VERSION} string) "
        f"USING parquet PARTITIONED BY ({BUCKET}, {VERSION}) CLUSTERED BY ({_names(store.keys)}) "
        f"SORTED BY ({_names(store.keys)}) INTO {store.buckets} BUCKETS LOCATION '{location}'")
    folders = " ".join(f"PARTITION ({BUCKET}={b}, {VERSION}='{v}')" for b, v in store.versions.items())
    if folders:
        spark.sql(f"ALTER TABLE {name} ADD {folders}")
    return name


def _write(spark: SparkSession, store: Store, rows: DataFrame) -> dict[int, str]:
    """Store rows under a new version of their buckets; the versions written.

    Rows of a bucket come from one task, so a bucket is one file, split by nothing.
    """
    version, name = uuid.uuid4().hex, _declared(spark, replace(store, versions={}))
    rows.select(*[f.name for f in store.columns], APPLIED, GONE, store.bucket_of().alias(BUCKET),
                F.lit(version).alias(VERSION)).write.insertInto(name)
    written = [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]  # a row per bucket written
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return {int(p.split("/")[0].split("=")[1]): version for p in written}


def _committed(spark: SparkSession, store: Store) -> Store:
    if store.number and open_store(spark, store.location).number >= store.number:
        raise ValueError(f"{store.location} has a state {store.number} already")
    row = (store.buckets, list(store.keys), store.columns.json(), store.versions, store.upto)
    # The folder may hold what a writer that died left; the first state must find none.
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("overwrite" if store.number else "errorifexists").parquet(
        f"{store.location}/manifests/number={store.number}")
    return store


def create(
    spark: SparkSession, rows: DataFrame, keys: Sequence[str], location: str, buckets: int
) -> Store:
    """Store the first rows of a replica; keys are unique and not NULL.

    ``buckets`` stays for the life of the store: the size expected in some years over 200 MB.
    Nested types are stored by their declared names.
    """
    store = Store(location, 0, buckets, tuple(keys), rows.schema, {}, {})
    ready = _checked(rows, keys).repartition(buckets, *keys)
    first = ready.withColumns({APPLIED: F.lit(None).cast("bigint"), GONE: F.lit(False)})
    return _committed(spark, replace(store, versions=_write(spark, store, first)))


def open_store(spark: SparkSession, location: str, number: int | None = None) -> Store:
    """The newest state of a store, or the one with a number."""
    found = spark.read.parquet(f"{location}/manifests")
    if number is None:
        number = found.agg(F.max("number")).first()[0]
    row = found.filter(F.col("number") == number).first()
    if row is None:
        raise ValueError(f"{location} has no state {number}")
    return Store(location, row["number"], row["buckets"], tuple(row["keys"]),
                 StructType.fromJson(json.loads(row["columns"])), row["versions"], row["upto"])


def _checked(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are whole; a NULL in a key is an error, as it would match nothing."""
    broken = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
    refuse = F.raise_error(F.lit(f"NULL in the key {list(keys)}")).cast("boolean")
    return df.filter(F.when(broken, refuse).otherwise(True))


def stored(spark: SparkSession, store: Store, buckets: Sequence[int] | None = None) -> DataFrame:
    """Rows with their markers, of some buckets only if given; other folders are not read."""
    state_of = (spark.sparkContext.applicationId, store.location, store.number)
    if state_of not in _TABLES:
        _TABLES[state_of] = _declared(spark, store)
    state = spark.table(_TABLES[state_of])
    if buckets is not None:
        state = state.filter(F.col(BUCKET).isin(list(buckets)))
    return state.drop(BUCKET, VERSION)


def _later(
    spark: SparkSession, store: Store, path: str, sequence: str, upto: dict[str, int] | None = None
) -> DataFrame:
    """The last change per key of batches the store lacks, keys in the stored types to hash alike."""
    held = Snapshot(read_table(spark, path), upto=store.upto)  # sequence numbers are compared in the join
    changes = later_changes(spark, held, path, store.keys, sequence, upto)
    typed = changes.withColumns({k: F.col(k).cast(store.columns[k].dataType) for k in store.keys})
    return latest_changes(_checked(typed, store.keys), store.keys, sequence)


def _applied(
    state: DataFrame, last: DataFrame, store: Store, sequence: str, operation: str
) -> DataFrame:
    """State rows after their changes: a change wins over a smaller sequence number."""
    rest = [f.name for f in store.columns if f.name not in store.keys]
    change = last.select(*store.keys, F.struct(*rest).alias("__row"), F.col(sequence).alias("__seq"),
                         (F.col(operation) == DELETE).alias("__delete"))
    joined = state.join(change, list(store.keys), "full_outer")
    wins = F.col("__seq").isNotNull() & (F.col(APPLIED).isNull() | (F.col("__seq") > F.col(APPLIED)))
    return joined.select(
        *store.keys,
        *[F.when(wins, F.col("__row")[c].cast(store.columns[c].dataType)).otherwise(F.col(c)).alias(c) for c in rest],
        F.when(wins, F.col("__seq")).otherwise(F.col(APPLIED)).cast("bigint").alias(APPLIED),
        F.when(wins, F.coalesce("__delete", F.lit(False))).otherwise(F.col(GONE)).alias(GONE),
    )


def rows(
    spark: SparkSession, store: Store, path: str | None = None, sequence: str = "seq", operation: str = "op"
) -> DataFrame:
    """The replica's rows; with the path of a change table, all changes after the store applied."""
    state = stored(spark, store)
    if path is not None:
        last = _later(spark, store, path, sequence)
        state = _applied(state, last, store, sequence, operation)
    return state.filter(~F.col(GONE)).select(*store.columns.names)


def compact(
    spark: SparkSession, store: Store, path: str, sequence: str = "seq", operation: str = "op"
) -> Store:
    """Apply the change table's later batches; buckets without a change keep their files.

    Which batches it holds is settled first. One compaction runs at a time: a second one on
    a state that was followed already fails at its manifest.
    """
    newest = read_table(spark, path).groupBy(WRITER).agg(F.max(BATCH).alias(BATCH)).collect()  # a row per writer
    upto = store.upto | {r[WRITER]: r[BATCH] for r in newest}
    last = _later(spark, store, path, sequence, upto)
    touched = [r[0] for r in last.select(store.bucket_of()).distinct().collect()]  # at most ``buckets`` numbers
    versions = store.versions
    if touched:
        state = stored(spark, store, touched)
        versions = versions | _write(spark, store, _applied(state, last, store, sequence, operation))
    return _committed(spark, replace(store, number=store.number + 1, versions=versions, upto=upto))


def vacuum(spark: SparkSession, location: str, keep: int = 1) -> int:
    """Delete the folders that none of the newest ``keep`` states names; their number.

    Not while a compaction runs: its folders are in no manifest yet. Older states can no
    longer be opened.
    """
    newest = open_store(spark, location).number
    numbers = range(max(0, newest - keep + 1), newest + 1)
    live = {(b, v) for n in numbers for b, v in open_store(spark, location, n).versions.items()}
    jvm, configuration = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(f"{location}/rows")
    files, count = root.getFileSystem(configuration), 0
    for found in files.globStatus(jvm.org.apache.hadoop.fs.Path(root, f"{BUCKET}=*/{VERSION}=*")):
        bucket, version = (part.split("=")[1] for part in found.getPath().toString().rsplit("/", 2)[1:])
        if (int(bucket), version) not in live:
            count += bool(files.delete(found.getPath(), True))
    for number in range(0, numbers.start):
        files.delete(jvm.org.apache.hadoop.fs.Path(f"{location}/manifests/number={number}"), True)
    return count
