"""Identifiers, paths and stable hashes as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierflow.functions.values import col


def sanitise(part: Column | str) -> Column:
    """ASCII-safe part of an id: every run outside A-Z a-z 0-9 . _ - becomes one '-'."""
    return F.regexp_replace(col(part), r"[^A-Za-z0-9._\-]+", "-")


def sanitise_unicode(name: Column | str) -> Column:
    """Every character that is no letter, digit, '-' or '_' becomes one '_'."""
    return F.regexp_replace(col(name), r"[^\p{L}\p{N}_-]", "_")


def instance_id(dataset, file_id, speaker=None, start_t=None, end_t=None) -> Column:
    """dataset_file[_speaker][_start][_end], times with three decimals; NULL parts are left out."""
    parts = [sanitise(dataset), sanitise(file_id)]
    if speaker is not None:
        parts.append(sanitise(speaker))
    for t in (start_t, end_t):
        if t is not None:
            parts.append(F.when(col(t).isNotNull(), F.format_string("%.3f", col(t))))
    return F.concat_ws("_", *parts)


def event_id(parent: Column | str, index: Column | str, start: Column | str, end: Column | str) -> Column:
    """Id of an event of a parent record: parent_ev03_1.250-1.500; a bound that isn't known is 'null'."""
    time = lambda t: F.when(col(t).isNotNull(), F.format_string("%.3f", col(t))).otherwise("null")
    return F.format_string("%s_ev%02d_%s-%s", col(parent), col(index), time(start), time(end))


def before_last(text: Column | str, mark: str = "_") -> Column:
    """The text before the last mark; '' if there is none."""
    return F.regexp_extract(col(text), rf"(?s)^(.*){mark}[^{mark}]*$", 1)


def basename(path: Column | str) -> Column:
    return F.substring_index(col(path), "/", -1)


def stem(path: Column | str) -> Column:
    """Base name without its last suffix."""
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def audio_bucket(path: Column | str) -> Column:
    """Folder to put a source into: the first part of the path unless it is 'audio' or
    there is none; else the stem before its last '_'; else its first two characters; else 'misc'."""
    first = F.when(F.instr(col(path), "/") > 0, F.split_part(col(path), F.lit("/"), F.lit(1)))
    base = stem(path)
    return F.coalesce(
        F.when(~first.isin("", "audio"), first), F.nullif(before_last(base), F.lit("")),
        F.nullif(F.substring(base, 1, 2), F.lit("")), F.lit("misc"),
    )


def layer_of(path: Column | str) -> Column:
    """struct(base, layer) of <base>.<layer>.TextGrid, NULL if the name has another form."""
    form = r"^(.+)\.([^.]+)\.TextGrid$"
    name = basename(path)
    return F.when(
        name.rlike(form), F.struct(F.regexp_extract(name, form, 1).alias("base"), F.regexp_extract(name, form, 2).alias("layer"))
    )


def stress_file(path: Column | str, corpora: dict[str, str] | None = None, other: str = "unknown") -> Column:
    """struct(source_id, speaker, start_t, end_t, corpus) of {source}_{speaker}_{i}_{f}-{i}_{f}.TextGrid.

    ``corpora``: prefix of the source id -> corpus. NULL if the name has another form."""
    form = r"^(.+)_([^_]+)_(\d+)_(\d+)-(\d+)_(\d+)\.TextGrid$"
    name = basename(path)
    part = lambda i: F.regexp_extract(name, form, i)
    time = lambda i: F.concat_ws(".", part(i), part(i + 1)).try_cast("double")
    corpus = F.lit(other)
    for prefix, title in reversed((corpora or {}).items()):
        corpus = F.when(part(1).startswith(prefix), title).otherwise(corpus)
    return F.when(
        name.rlike(form),
        F.struct(part(1).alias("source_id"), part(2).alias("speaker"), time(3).alias("start_t"), time(5).alias("end_t"), corpus.alias("corpus")),
    )


def relative_to(path: Column | str, root: str) -> Column:
    """The path below ``root`` with forward slashes; other paths stay."""
    flat = F.translate(col(path), "\\", "/")
    prefix = root.rstrip("/") + "/"
    return F.when(flat.startswith(prefix), F.substring(flat, len(prefix) + 1, 1 << 30)).otherwise(flat)


def stable_hash(text: Column | str) -> Column:
    """A number in [0, 1] from the first eight hex digits of the MD5 of a text."""
    return F.conv(F.substring(F.md5(col(text)), 1, 8), 16, 10).cast("double") / F.lit(4294967295.0)


def draw(seed: str, item: Column | str) -> Column:
    """Order of a seeded shuffle: the MD5 of seed::item."""
    return F.md5(F.concat(F.lit(f"{seed}::"), col(item).cast("string")))
