"""Shared building blocks: table access, terms of the data model, checkpoints.

Fixed readings used by every operator:

* ``ms``: seconds times 1000, rounded half to even, as BIGINT; NULL, NaN and
  infinities give NULL.
* ``normalised``: Unicode NFC, U+0020 stripped at both ends, lower case.
* ``missing``: NULL or normalised to one of ``''``, ``'-'``, ``'unknown'``.
* ``current``: per key the row with the latest order value; identical copies
  count once, rows without a key are no records and are left out.
"""

from __future__ import annotations

import os
import re
import tempfile
import unicodedata
import uuid
from collections.abc import Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Entries that stand for "no value" once normalised.
MISSING = ("", "-", "unknown")


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it.

    Enough on one machine and where the path is shared; other clusters get it by --py-files."""
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``sf_dir``."""
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ms(seconds: Column | str) -> Column:
    """Whole milliseconds of a DOUBLE of seconds (half to even); NULL if not finite."""
    col = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.rint(col * F.lit(1000.0)).try_cast("bigint")


def _composed(values: pa.Array) -> pa.Array:
    """NFC of every value, worked out once for each distinct one."""
    coded = values.cast(pa.string()).dictionary_encode()
    names = [unicodedata.normalize("NFC", x) for x in coded.dictionary.to_pylist()]
    return pa.array(names, pa.string()).take(coded.indices)


@F.arrow_udf(T.StringType())
def _nfc(col: pa.Array) -> pa.Array:
    return _composed(col)


def nfc(text: Column | str) -> Column:
    """Unicode NFC. Spark has no built-in for it; one Arrow call does it."""
    return _nfc(F.col(text) if isinstance(text, str) else text)


@F.arrow_udf(T.ArrayType(T.StringType()))
def _nfc_all(col: pa.Array) -> pa.Array:
    values = _composed(col.flatten())
    ends = np.concatenate([[0], np.cumsum(col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
    return pc.if_else(col.is_valid(), lists, None) if col.null_count else lists


def nfc_all(texts: Column | str) -> Column:
    """nfc of every entry of an array: several columns cost one call."""
    return _nfc_all(F.col(texts) if isinstance(texts, str) else texts)


def normalised(text: Column | str) -> Column:
    """NFC, spaces (U+0020) at both ends removed, lower case."""
    return F.lower(F.trim(nfc(text)))


def is_missing(norm: Column) -> Column:
    """True where a *normalised* value counts as missing. Never NULL."""
    return norm.isNull() | norm.isin(*MISSING)


def picked(*paths: str) -> list[Column]:
    """Columns of dotted paths, fields of one struct in a struct of their own, so that a scan reads nothing else.

    picked("a", "m.x", "m.i.y") gives a and m: struct<x, i: struct<y>>."""
    tree: dict = {}
    for path in paths:
        node = tree
        *above, last = path.split(".")
        for name in above:
            node = node.setdefault(name, {})
        node[last] = path

    def built(name: str, node) -> Column:
        return (F.col(node) if isinstance(node, str) else F.struct(*[built(n, x) for n, x in node.items()])).alias(name)

    return [built(name, node) for name, node in tree.items()]


def current(
    df: DataFrame,
    key: Sequence[str] = ("instance_id",),
    order: str = "ingested_at",
    payload: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the latest by ``order``; ties are broken by a hash of the payload.

    ``payload``: dotted paths of what is needed besides key and order (default: all
    columns); only these are read, shuffled and hashed. The row_number filter is
    planned as a WindowGroupLimit before the exchange, so that at most one row per
    key and map task is shuffled, however many copies one key has. NULL keys are
    dropped; a NULL order value is the oldest."""
    cols = picked(*(payload if payload is not None else [f"`{c}`" if "." in c else c for c in df.columns if c not in (*key, order)]))
    for k in key:
        df = df.where(F.col(k).isNotNull())
    ranked = Window.partitionBy(*key).orderBy(F.col(order).desc_nulls_last(), F.col("_tie"))
    return (
        df.select(*key, order, *cols, F.xxhash64(*cols).alias("_tie") if cols else F.lit(0).alias("_tie"))
        .withColumn("_rn", F.row_number().over(ranked))
        .where("_rn = 1")
        .drop("_rn", "_tie")
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir. Only where the master is this machine alone a fresh folder stands in."""
    sc = spark.sparkContext
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        return conf
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tierflow-"))
    return sc._jsc.sc().getCheckpointDir().get()


#: Tables written by cut() and not yet removed.
_TABLES: list[str] = []


def cut(df: DataFrame) -> DataFrame:
    """Writes ``df`` once as a table in the shared checkpoint folder and reads that.

    Lineage ends there, so a lost executor costs no recomputation before it. The table
    is removed by discard_tables() or when the application's file systems are closed."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/tierflow-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    _TABLES.append(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession) -> str:
    """A new path in the shared checkpoint folder for what a query writes and reads back; removed like the tables of cut()."""
    _TABLES.append(f"{checkpoint_dir(spark)}/tierflow-{uuid.uuid4().hex}")
    return _TABLES[-1]


def discard_tables(spark: SparkSession) -> int:
    """Removes the tables of cut(), once the results that read them are written out; returns how many."""
    for path in _TABLES:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    n = len(_TABLES)
    _TABLES.clear()
    return n


#: Most rows that small() lets through to a broadcast.
SMALL_ROWS = 100_000


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows (counted), else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def spread_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", salts: int = 16) -> DataFrame:
    """``left`` joined to ``right``, which has one row per key; a hot key of ``left`` (NULL, too) is spread.

    A small right side (counted) is broadcast. Otherwise each of its rows comes once
    for every salt, and a row of ``left`` goes to the salt of its hash."""
    held = small(right)
    if held is not right:
        return left.join(held, list(keys), how)
    (salt,) = fresh(left, "_salt")
    own = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts)).cast("int")
    every = right.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn(salt, own).join(every, [*keys, salt], how).drop(salt)


def bucketed_rank(df: DataFrame, group: Sequence[str], draw: str, rank: str = "rank", buckets: int = 4096) -> DataFrame:
    """``rank``: 1, 2, ... by (draw, all columns) within ``group``, exact for groups of any size.

    ``draw`` is an evenly spread BIGINT. Rows are counted by group and bucket of
    draw, the counts are summed up over the buckets, and only rows of one group
    and bucket are sorted together; a group of a third of all rows is so spread
    over ``buckets`` tasks. ``df`` is read twice: give a table or a cheap plan."""
    cell, before = fresh(df, "_bucket", "_before")
    width = (1 << 63) // (buckets // 2)
    cells = df.withColumn(cell, F.floor(F.col(draw) / F.lit(width)).cast("int"))
    counted = cells.groupBy(*group, cell).agg(F.count(F.lit(1)).alias(before))
    earlier = Window.partitionBy(*group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    inside = Window.partitionBy(*group, cell).orderBy(draw, *[c for c in df.columns if c != draw and c not in group])
    ranked = cells.withColumn(rank, F.row_number().over(inside)).alias("r")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}")) for c in (*group, cell)]
    return ranked.join(offsets.alias("o"), same).select(
        *[F.col(f"r.{c}") for c in df.columns], (F.col(f"r.{rank}") + F.col(f"o.{before}")).alias(rank)
    )


def before_in_order(df: DataFrame, order: Sequence[str], amount: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``amount`` over all rows before, by distinct ``order`` columns.

    Rows are range-partitioned, summed per partition, and each partition adds what
    the earlier ones hold: no task sorts more than its range."""
    placed = cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("_part").agg(F.sum(amount).alias("_sum"))
    offsets = sums.select("_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))  # a row per partition
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = placed.withColumn("_own", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return own.join(F.broadcast(offsets), "_part").select(*df.columns, (F.col("_own") + F.col("_before")).alias(name))


def with_totals(df: DataFrame, **totals: Column) -> DataFrame:
    """``df`` with aggregates over all its rows as columns: one broadcast row instead of a window in one task."""
    return df.crossJoin(F.broadcast(df.agg(*[c.alias(n) for n, c in totals.items()])))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names derived from ``names`` that no column of ``df`` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
