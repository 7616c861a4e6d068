"""Readers and writers of record tables: JSON lines, Parquet, CSV, globs."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """JSON lines with a schema; blank lines are skipped, a broken line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_tolerant(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """As read_jsonl; a broken line is a row with its text in _broken and NULL elsewhere."""
    full = T.StructType([*schema.fields, T.StructField("_broken", T.StringType())])
    return spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken").json(path)


def read_raw(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Each line as a VARIANT ``v`` (NULL if broken): keeps absent and null keys apart."""
    return spark.read.option("singleVariantColumn", "v").json(path)


def stream_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, files_per_trigger: int = 100) -> DataFrame:
    """The lazy reader: new files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None, n: int | None = None) -> DataFrame:
    """A Parquet data set; only the named columns are read (binary audio stays on disk)."""
    df = spark.read.parquet(path)
    df = df.select(*columns) if columns else df
    return df if n is None else df.limit(n)


def read_lookup(spark: SparkSession, path: str, key: str, sep: str = ",") -> DataFrame:
    """A CSV look-up with header; ``key`` must be a column, split (if there) one of the valid ones."""
    df = spark.read.option("header", True).option("sep", sep).csv(path)
    if key not in df.columns:
        raise ValueError(f"{path} has no column {key!r}: {df.columns}")
    if "split" in df.columns:
        ok = F.col("split").isin("train", "dev", "test")
        df = df.withColumn("split", F.when(ok, F.col("split")).otherwise(F.raise_error(F.concat(F.lit("bad split: "), F.coalesce("split", F.lit("NULL"))))))
    return df


def list_files(spark: SparkSession, path: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """path, length, modificationTime of files, in order of path; contents aren't read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", recursive)
    return reader.load(path).select("path", "length", "modificationTime").orderBy("path")


def cap_per_layer(files: DataFrame, layer: Column, n: int) -> DataFrame:
    """At most n files of each layer, in order of path (a report's sample)."""
    from pyspark.sql import Window

    w = Window.partitionBy("_layer").orderBy("path")
    return files.withColumn("_layer", layer).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn", "_layer")


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Writes JSON lines and returns the number of rows, counted while writing."""
    from pyspark.sql import Observation

    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).option("ignoreNullFields", False).json(path)
    return seen.get["n"]


def write_recipes(tables: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """One folder per table with its number of rows; each is worked out once, and what turns out empty is removed."""
    counts = {}
    for name, df in tables.items():
        counts[name] = write_jsonl(df, f"{folder}/{name}")
        if not counts[name]:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    return {name: n for name, n in counts.items() if n}


def write_by(df: DataFrame, path: str, *keys: str) -> None:
    """One folder per value of the keys (task, split): readers of one value read nothing else."""
    df.repartition(*keys, F.pmod(F.xxhash64(*[c for c in df.columns if c not in keys][:1]), F.lit(16))).write.mode("overwrite").partitionBy(*keys).parquet(path)


def write_table(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Delimited text with header: manifests and reports."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def append_runs(df: DataFrame, path: str) -> None:
    """Appends the rows of a run (few) as one file to a results table; every file has its header, as readers expect."""
    df.coalesce(1).write.mode("append").option("header", True).csv(path)


def markdown(df: DataFrame, most: int = 1000) -> str:
    """A small aggregate as a Markdown table; more than ``most`` rows are refused."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows: aggregate first")
    cell = lambda x: "" if x is None else f"{x:.3f}" if isinstance(x, float) else str(x).replace("|", "\\|")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join(map(cell, r)) + " |" for r in rows])


def read_with_broken(lines: DataFrame, raw: str = "raw") -> DataFrame:
    """One row: lines, blank and broken ones (no JSON object) of raw text lines."""
    v = F.try_parse_json(raw)
    blank = F.coalesce(F.trim(raw), F.lit("")) == ""
    whole = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    return lines.agg(F.count(F.lit(1)).alias("lines"), F.count_if(blank).alias("blank"), F.count_if(~blank & ~whole).alias("broken"))


def write_report(tables: dict[str, DataFrame], title: str) -> str:
    """A Markdown report of several small aggregates, each under its heading."""
    return "\n\n".join([f"# {title}", *(f"## {name}\n\n{markdown(df)}" for name, df in tables.items())]) + "\n"


def summary_json(tables: dict[str, DataFrame], most: int = 1000) -> str:
    """Small aggregates as one JSON object: name -> rows."""
    rows = {}
    for name, df in tables.items():
        rows[name] = [json.loads(r) for r in df.limit(most + 1).toJSON().collect()]
        if len(rows[name]) > most:
            raise ValueError(f"{name} has more than {most} rows: aggregate first")
    return json.dumps(rows, ensure_ascii=False, indent=1)
