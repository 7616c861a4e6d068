"""TextGrid files: a parser in Arrow batches and a JVM-side writer.

The reader takes binaryFile rows, tells UTF-16 (by its mark), UTF-8 and Latin-1
apart, and reads the long and the short text form. Blank intervals stay; a tier
name met before in the file gets a number."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "path string, tier string, tier_type string, idx int, start_t double, end_t double, label string"
_TOKEN = re.compile(r'"(?:[^"]|"")*"|-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?(?![\]:\w])|<exists>')


def decode(content: bytes) -> str:
    if content[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return content.decode("utf-16")
    try:
        return content.decode("utf-8-sig")
    except UnicodeDecodeError:
        return content.decode("latin-1")


def parse(text: str) -> list[tuple]:
    """(tier, type, idx, start, end, label); points have equal start and end."""
    tokens = iter([t for line in text.splitlines() for t in _TOKEN.findall(re.sub(r"^\s*(?:intervals|points|item)\s*\[\d*\]:?", "", line))])
    out, seen = [], {}
    word = lambda: next(tokens)[1:-1].replace('""', '"')
    word(), word()  # file and object type
    next(tokens), next(tokens)  # span of the file
    if next(tokens) != "<exists>":
        return out
    for _ in range(int(next(tokens))):
        kind, name = word(), word()
        seen[name] = seen.get(name, 0) + 1
        tier = name if seen[name] == 1 else f"{name}_{seen[name]}"
        next(tokens), next(tokens)
        for i in range(int(next(tokens))):
            start = float(next(tokens))
            end = float(next(tokens)) if kind == "IntervalTier" else start
            out.append((tier, "interval" if kind == "IntervalTier" else "point", i, start, end, word()))
    return out


def read_textgrids(spark: SparkSession, path: str) -> DataFrame:
    """The long interval table of all TextGrid files below ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.TextGrid").option("recursiveFileLookup", True).load(path)
    return parsed(files.select("path", "content"))


def parsed(files: DataFrame) -> DataFrame:
    """The intervals of files given as path and content (binary)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in SCHEMA.split(", ")]
        for batch in batches:
            rows = [(p, *r) for p, c in zip(batch["path"], batch["content"]) for r in parse(decode(c))]
            yield pd.DataFrame(rows, columns=columns)

    return files.mapInPandas(run, SCHEMA)


def to_textgrid(tiers: DataFrame, key: str = "base", short: bool = False) -> DataFrame:
    """key, content: one TextGrid (long or short form) per key of key, tier, place, idx, start_t, end_t, label.

    Built in the JVM; a file is one row, so it must fit an executor's memory as it must a reader's."""
    quoted = F.concat(F.lit('"'), F.replace(F.coalesce("label", F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    number = lambda c: F.format_string("%.3f", c)
    line = lambda *x: F.concat(*[F.lit(t) if isinstance(t, str) else t for t in x])
    item = F.struct("idx", "start_t", "end_t", quoted.alias("text"))
    per_tier = tiers.groupBy(key, "place", "tier").agg(
        F.array_sort(F.collect_list(item)).alias("items"), F.min("start_t").alias("lo"), F.max("end_t").alias("hi")
    )
    if short:  # the same values in the same order, one a line and without names
        bare = F.transform("items", lambda x: line(number(x["start_t"]), "\n", number(x["end_t"]), "\n", x["text"], "\n"))
        body = line('"IntervalTier"\n"', F.col("tier"), '"\n', number(F.col("lo")), "\n", number(F.col("hi")), "\n", F.size("items").cast("string"), "\n", F.array_join(bare, ""))
        per_file = per_tier.select(key, "place", "lo", "hi", body.alias("body")).groupBy(key).agg(
            F.array_sort(F.collect_list(F.struct("place", "body"))).alias("t"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
        )
        return per_file.select(key, line(
            'File type = "ooTextFile"\nObject class = "TextGrid"\n\n', number(F.col("lo")), "\n", number(F.col("hi")), "\n<exists>\n",
            F.size("t").cast("string"), "\n", F.array_join(F.transform("t", lambda x: x["body"]), "")).alias("content"))
    lines = F.transform("items", lambda x, i: line(
        "        intervals [", (i + 1).cast("string"), "]:\n            xmin = ", number(x["start_t"]), "\n            xmax = ",
        number(x["end_t"]), "\n            text = ", x["text"], "\n"))
    body = line(
        '        class = "IntervalTier"\n        name = "', F.col("tier"), '"\n        xmin = ', number(F.col("lo")), "\n        xmax = ", number(F.col("hi")),
        "\n        intervals: size = ", F.size("items").cast("string"), "\n", F.array_join(lines, ""),
    )
    per_file = per_tier.select(key, "place", "lo", "hi", body.alias("body")).groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("place", "body"))).alias("t"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    items = F.transform("t", lambda x, i: line("    item [", (i + 1).cast("string"), "]:\n", x["body"]))
    return per_file.select(key, line(
        'File type = "ooTextFile"\nObject class = "TextGrid"\n\nxmin = ', number(F.col("lo")), "\nxmax = ", number(F.col("hi")),
        "\ntiers? <exists>\nsize = ", F.size("t").cast("string"), "\nitem []:\n", F.array_join(items, "")).alias("content"))
