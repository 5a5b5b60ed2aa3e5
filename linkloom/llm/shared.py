"""Places and names that the operators share."""

from __future__ import annotations

import posixpath
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which the driver and all executors see.

    Only where the session has no such setting and runs in local mode (tests), a temporary
    folder of this machine serves; on a cluster the missing setting is an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where
    if not (spark.conf.get("spark.master", "") or "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="linkloom-shared-")
        spark.sparkContext.setCheckpointDir(_LOCAL[app])
    return _LOCAL[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other call gets."""
    return posixpath.join(shared_dir(spark), "linkloom", f"{label}-{uuid.uuid4().hex}")


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.options(**options).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_at = path
    return table


def drop_written(*tables: DataFrame) -> None:
    """Deletes the files of written tables that no result reads any more."""
    for table in tables:
        drop_path(table.sparkSession, table.written_at)


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder through the file system that owns it."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like the wanted ones that df doesn't have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


#: A key is hot with at least HOT_ROWS rows and more than one row in HOT_KEYS: no table has more than HOT_KEYS of them.
HOT_ROWS, HOT_KEYS = 500, 10_000


def hot_keys(rows: DataFrame, key: str) -> DataFrame | None:
    """The hot keys of a written table, HOT_KEYS at most, or None if there are none."""
    least = max(HOT_ROWS, rows.count() // HOT_KEYS + 1)
    found = rows.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") >= least).select(key).collect()
    return rows.sparkSession.createDataFrame(found, rows.select(key).schema) if found else None


def keyed_join(rows: DataFrame, table: DataFrame, key: str, how: str = "inner", hot: DataFrame | None | str = "find") -> DataFrame:
    """rows (a written table) joined with a table that has at most one row of each key, inner or left.

    Rows of one hot key would meet in one task, so they get the few rows of the table that are theirs by a
    broadcast of at most HOT_KEYS rows; all other keys are joined as usual. Rows without a key match nothing.
    """
    hot = hot_keys(rows, key) if isinstance(hot, str) else hot
    keyed = rows.where(F.col(key).isNotNull())
    if hot is None:
        out = keyed.join(table, key, how)
    else:
        few = F.broadcast(hot)
        out = keyed.join(few, key, "left_anti").join(table, key, how).unionByName(keyed.join(few, key, "left_semi").join(F.broadcast(table.join(few, key, "left_semi")), key, how))
    return out.unionByName(rows.where(F.col(key).isNull()), allowMissingColumns=True) if how == "left" else out


def content_key(id_col: str, text_col: str) -> Column:
    """A 64-bit hash of a row's id and text."""
    return F.xxhash64(id_col, F.col(text_col).cast("string"))


def content_sha(text_col: str) -> Column:
    """The sha256 of a row's text, null for a null text."""
    return F.unhex(F.sha2(F.col(text_col).cast("string"), 256))


def _tag(id_: Column, sha: Column) -> Column:
    return F.concat_ws(":", F.coalesce(F.hex(sha), F.lit("-")), F.coalesce(id_.cast("string"), F.lit("-")))


def kept_once(docs: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of docs whose id and text are those of kept(key, id, sha), with all their columns; of rows that
    repeat an id and a text one. key is their content_key, by which alone both are dealt; id and sha256 of the
    text decide (in a form that isn't taken for a join key). One shuffle of docs: the window reuses the join's
    partitioning."""
    key, theirs, tag, place = free_names(docs, "content_key", "kept_key", "kept_tag", "kept_place")
    wanted = kept.select(F.col("key").alias(theirs), _tag(F.col("id"), F.col("sha")).alias(tag)).distinct()
    same = (F.col(key) == F.col(theirs)) & F.array_contains(F.array(tag), _tag(F.col(id_col), content_sha(text_col)))
    joined = docs.withColumn(key, content_key(id_col, text_col)).join(wanted, same, "left_semi")
    ranked = joined.withColumn(place, F.row_number().over(Window.partitionBy(key, id_col, text_col).orderBy(key)))
    return ranked.where(F.col(place) == 1).select(*docs.columns)
