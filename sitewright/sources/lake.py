"""Publishing of stage outputs: scope replacement on a partitioned table, manifests, catalog states (K1-K7, J17, §2.13 o, p)."""

from __future__ import annotations

import hashlib
import json
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Arguments whose values are never recorded.
SECRET = ("password", "secret", "token", "credential", "dbconn", "dbconfig", "command")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds; one that is not there is no error."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _prints(df: DataFrame) -> list[Column]:
    """Number of rows and an order-free sum of their hashes."""
    return [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("h")]


def write_verified(df: DataFrame, path: str) -> int:
    """K1, K4: write df as Parquet, read it back and hold number and hashes of the rows against those that were written.

    Returns the number of rows. A difference is an error. The written side is counted by the job that writes.
    """
    seen = Observation()
    df.observe(seen, *_prints(df)).write.mode("overwrite").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    read = back.agg(*_prints(back)).first()
    written = seen.get
    if (read["n"], read["h"]) != (written["n"], written["h"] if written["h"] is not None else 0):
        raise ValueError(f"{path}: {written['n']} rows written, {read['n']} read, or their contents differ")
    return read["n"]


def write_tsv(df: DataFrame, path: str) -> None:
    """K3: tab-separated files with a header, gzipped, one a task; nulls are NA."""
    df.write.mode("overwrite").option("compression", "gzip").csv(path, sep="\t", header=True, nullValue="NA", emptyValue="")


def write_manifest(spark: SparkSession, path: str, module: str, arguments: dict, parents: list[str] = (), rows: int | None = None) -> str:
    """§2.13 p: a JSON record beside the table; returns its id, a hash of the content. Secrets are left out."""
    plain = {k: v for k, v in sorted(arguments.items()) if not any(s in k.lower() for s in SECRET)}
    record = {"version": 2, "module": module, "time": datetime.now(timezone.utc).isoformat(), "arguments": plain, "parents": sorted(parents), "rows": rows}
    record["id"] = "run_" + hashlib.md5(json.dumps(record, sort_keys=True).encode()).hexdigest()
    fs, p = _fs(spark, f"{path}/_manifest.json")
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(record, indent=1).encode()))
    out.close()
    return record["id"]


def read_manifest(spark: SparkSession, path: str) -> dict:
    """The record of a table; without one its history is unavailable, never guessed."""
    fs, p = _fs(spark, f"{path}/_manifest.json")
    if not fs.exists(p):
        return {"id": None, "history": "unavailable"}
    stream = fs.open(p)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return json.loads(text)


def check_scope(rows: DataFrame, groups: DataFrame, scope: list[str]) -> None:
    """Every row lies in a processed group, and groups are unique and without nulls or blanks."""
    blank = groups.where(" or ".join(f"`{c}` is null or trim(`{c}`) = ''" for c in scope))
    twice = groups.groupBy(*scope).count().where("count > 1")
    outside = rows.select(*scope).join(groups, scope, "left_anti")
    for bad, text in ((blank, "a group has a blank key"), (twice, "a group is given twice"), (outside, "rows outside the processed groups")):
        if not bad.isEmpty():
            raise ValueError(text)


def replace_scope(spark: SparkSession, rows: DataFrame, groups: DataFrame, path: str, scope: list[str]) -> None:
    """K6: replace all rows of the processed groups, also of those that end up without rows; nothing else is touched.

    The table is partitioned by scope. The new rows overwrite their partitions dynamically, under Spark's
    commit protocol; partitions of processed groups without a new row are then removed. Partition
    directories are looked up by name, so the data of other groups are neither read nor rewritten.
    """
    check_scope(rows, groups, scope)
    rows.repartition(*scope).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*scope).parquet(path)
    empty = groups.select(*scope).join(rows.select(*scope).distinct(), scope, "left_anti")
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for r in empty.toLocalIterator():
        remove_path(spark, "/".join([path, *[f"{c}={escape(str(r[c]))}" for c in scope]]))


def merge_history(incoming: DataFrame, archive: DataFrame, key: list[str]) -> DataFrame:
    """§2.11: archived rows whose full key comes in again give way to the incoming ones."""
    return incoming.unionByName(archive.join(incoming.select(*key).distinct(), key, "left_anti"), allowMissingColumns=True)


def register_samples(catalog: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """K7: catalog rows of new samples, with a null count. A key that exists in any letter case is an error."""
    fold = [F.upper(c).alias(c) for c in key]
    if not new.select(*fold).join(catalog.select(*fold), key, "left_semi").isEmpty():
        raise ValueError("a sample is registered already")
    return new.select(*key).withColumn("demultiplexed_reads", F.lit(None).cast("long"))


def update_counts(catalog: DataFrame, counts: DataFrame, key: list[str]) -> DataFrame:
    """K7: the catalog with counts filled in, each exactly once: only null counts may be set."""
    joined = catalog.join(counts.withColumnRenamed("demultiplexed_reads", "_new"), key, "left")
    clash = F.col("_new").isNotNull() & F.col("demultiplexed_reads").isNotNull()
    value = F.when(clash, F.raise_error(F.lit("a count is set already")).cast("long")).otherwise(F.coalesce("_new", "demultiplexed_reads"))
    return joined.select(*key, value.alias("demultiplexed_reads"))


def missing_updates(expected: DataFrame, updated: DataFrame, key: list[str]) -> DataFrame:
    """Keys that should have got an update and did not."""
    return expected.select(*key).distinct().join(updated.select(*key).distinct(), key, "left_anti")


#: Names among which suggestions are looked for at most (files of a folder, genomes, trials); more are an error.
MOST_NAMES = 10_000


def nearest_names(values: DataFrame, value: str, names: DataFrame, name: str, k: int = 3) -> DataFrame:
    """Every distinct value that is no name, with the k names of least edit distance, equal ones by name.

    names is a list of at most MOST_NAMES, which goes to every task; a null is neither value nor name. Columns: value,
    rank from 1, name, distance.
    """
    listed = names.select(name).where(F.col(name).isNotNull()).distinct().agg(F.sort_array(F.collect_set(name)).alias("_names"))
    checked = F.when(F.size("_names") <= MOST_NAMES, F.col("_names")).otherwise(F.raise_error(F.lit(f"more than {MOST_NAMES} names")).cast("array<string>"))
    rows = values.select(value).where(F.col(value).isNotNull()).distinct().join(F.broadcast(listed.select(checked.alias("_names"))))  # one row
    order = F.slice(F.array_sort(F.transform("_names", lambda n: F.struct(F.levenshtein(F.col(value), n).alias("distance"), n.alias("name")))), 1, k)
    near = rows.where(~F.array_contains("_names", F.col(value))).select(value, F.posexplode(order).alias("rank", "_n"))
    return near.select(value, (F.col("rank") + 1).alias("rank"), F.col("_n.name").alias("name"), F.col("_n.distance").alias("distance"))


def merge_heads(records: list[dict]) -> list[str]:
    """The ids of the manifests that an output comes from, in order of first appearance; two records of one id must be equal."""
    seen: dict[str, dict] = {}
    for record in records:
        if seen.setdefault(record["id"], record) != record:
            raise ValueError(f"two different records {record['id']}")
    return list(seen)


def pull_records(catalog: DataFrame, **wanted: list[str]) -> DataFrame:
    """catalog rows whose columns are among the values asked for; a column without values is not restricted."""
    for column, values in wanted.items():
        if values:
            catalog = catalog.where(F.col(column).isin(list(values)))
    return catalog
