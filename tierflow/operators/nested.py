"""Deeply nested JSON records as related flat tables (problem 3).

Method: one higher-order projection per record. The raw line is parsed to a
VARIANT; nested ``transform`` calls attach the ancestors' positions, ``flatten``
joins the arrays of all levels, and one ``inline`` per target table emits its
rows. Everything stays in the JVM after the choice of the current line of each
record (the only shuffle, at most one row per id and task); a query of one table
works out nothing of the others.

Shapes: a list is taken as it is; a lone object or scalar is a list of one; a
string that holds a JSON object or list is what it holds (not in labels).
Null entries keep their place and give no row; a missing or null node has no
children. A line that isn't a valid JSON object has no rows and cannot be the
current line of a record.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.common import current, cut
from tierflow.functions.values import let

VARIANTS = "array<variant>"


def opened(node: Column) -> Column:
    """A VARIANT; if it is a string that holds an object or a list, what it holds."""

    def held(n: Column) -> Column:
        text = F.try_variant_get(n, "$", "string")
        holds = (F.schema_of_variant(n) == "STRING") & text.rlike(r"^\s*[\[{]")
        return F.when(F.coalesce(holds, F.lit(False)), F.coalesce(F.try_parse_json(text), n)).otherwise(n)

    return let(node, held)


def field(node: Column, key: str) -> Column:
    """A key of an object VARIANT, NULL if there is none."""
    return F.try_variant_get(node, f"$['{key}']", "variant")


def entries(node: Column) -> Column:
    """The array<variant> of a node: NULL and JSON null have none, others are lists of one."""

    def listed(n: Column) -> Column:
        none = n.isNull() | F.coalesce(F.is_variant_null(n), F.lit(False))
        return F.when(none, F.array().cast(VARIANTS)).otherwise(F.coalesce(F.try_variant_get(n, "$", VARIANTS), F.array(n)))

    return let(node, listed)


def present(entry: Column) -> Column:
    return entry.isNotNull() & ~F.coalesce(F.is_variant_null(entry), F.lit(True))


def rows_of(items: Column, child: Column, parent_pos=None) -> Column:
    """array<struct<child, parent_pos, pos, node>> of the present entries of a list."""
    parent = (lambda x: F.lit(-1)) if parent_pos is None else parent_pos
    made = F.transform(
        items, lambda x, i: F.struct(child.alias("child"), parent(x).cast("int").alias("parent_pos"), i.cast("int").alias("pos"), x.alias("node"))
    )
    return F.filter(made, lambda r: present(r["node"]))


def records(lines: DataFrame) -> DataFrame:
    """instance_id and ``v`` (the VARIANT) of the current line of every record.

    Latest ingested_at, then highest line_no; identical lines count once. Lines
    that aren't JSON objects or have no instance_id are left out."""
    parsed = lines.select(
        F.try_variant_get(F.try_parse_json("raw"), "$.instance_id", "string").alias("instance_id"),
        F.struct("ingested_at", "line_no").alias("_order"),
        "raw",
    )
    return current(parsed, order="_order").select("instance_id", F.try_parse_json("raw").alias("v"))


def child_arrays(recs: DataFrame) -> DataFrame:
    """instance_id and per kind of child (see COLUMNS) the array<struct<child, parent_pos, pos, node>> of its rows.

    What is made of one kind depends on no other (primary_stress looks at words_align),
    so a query of one table works out only that table's array."""
    meta = recs.select("instance_id", field(F.col("v"), "labels").alias("_labels"), opened(field(F.col("v"), "metadata")).alias("_m"))
    lists = meta.select(
        "instance_id", "_labels", opened(field(F.col("_m"), "speaker_info")).alias("_s"),
        *[entries(opened(field(F.col("_m"), k))).alias(k) for k in ("words_align", "primary_stress", "filled_pauses")],
    ).select(
        "instance_id", "words_align", "primary_stress", "filled_pauses",
        entries(opened(field(F.col("_s"), "Memberships"))).alias("memberships"),
        F.map_entries(F.coalesce(F.try_variant_get("_labels", "$", "map<string,variant>"), F.create_map().cast("map<string,variant>"))).alias("_l"),
    )
    # entries of a list may be JSON strings themselves
    lists = lists.withColumns({k: F.transform(k, opened) for k in ("words_align", "primary_stress", "filled_pauses", "memberships")})

    def word_at(stress: Column) -> Column:
        def in_words(at: Column) -> Column:
            whole = (at == F.floor(at)) & (at >= 0) & (at < F.size("words_align"))
            there = present(F.get("words_align", F.when(whole, at).cast("int")))
            return F.when(F.coalesce(whole & there, F.lit(False)), at.cast("int")).otherwise(-1)

        return let(F.try_variant_get(stress, "$.words_align_idx", "double"), in_words)

    roles = F.flatten(
        F.transform(
            "memberships",
            lambda m, i: rows_of(F.transform(entries(opened(field(m, "Roles"))), opened), F.lit("roles"), lambda x: i),
        )
    )
    labels = F.flatten(F.transform("_l", lambda e: rows_of(entries(e["value"]), F.concat(F.lit("labels."), e["key"]))))
    own = lambda k, parent=None: rows_of(F.col(k), F.lit(k), parent).alias(f"_{k}")
    return lists.select(
        "instance_id", own("words_align"), own("primary_stress", word_at), own("filled_pauses"), own("memberships"),
        roles.alias("_roles"), labels.alias("_labels"),
    )


def child_rows(recs: DataFrame, kind: str) -> DataFrame:
    """instance_id, child, parent_pos, pos, node of one target table: one generator over its own array."""
    # outer, as Catalyst would otherwise work out all rows once more in a filter before the generator
    return child_arrays(recs).select("instance_id", F.inline_outer(f"_{kind}")).where("child is not null")


def child_positions(recs: DataFrame) -> DataFrame:
    """instance_id, child, parent_pos, pos of every child row of every record.

    Each record is parsed once; the places of its children, a column for each target
    table, are written as a table, of which one generator a target table reads its column."""
    place = lambda k: F.transform(f"_{k}", lambda r: r.dropFields("node")).alias(k)
    places = cut(child_arrays(recs).select("instance_id", *[place(k) for k in COLUMNS]))
    return functools.reduce(DataFrame.unionByName, [places.select("instance_id", F.inline(k)) for k in COLUMNS])


def words_and_marks(recs: DataFrame) -> DataFrame:
    """instance_id, text, words, marks: typed arrays of words_align and primary_stress, null entries in their places."""
    m = opened(field(F.col("v"), "metadata"))
    node = recs.select("instance_id", F.try_variant_get("v", "$.text", "string").alias("text"), m.alias("_m"))
    number = lambda x, key, kind: F.try_variant_get(x, f"$['{key}']", kind).alias(key)
    word = lambda x: F.struct(*[number(x, c, t) for c, (_, t) in COLUMNS["words_align"].items()])
    mark = lambda x: F.struct(number(x, "words_align_idx", "double"), numbers(field(x, "raw")).alias("raw"))
    typed = lambda key, made: F.transform(F.transform(entries(opened(field(F.col("_m"), key))), opened), lambda x: F.when(present(x), made(x)))
    return node.select("instance_id", "text", typed("words_align", word).alias("words"), typed("primary_stress", mark).alias("marks"))


def record_table(recs: DataFrame) -> DataFrame:
    """The flat parent table: one row per record."""
    v = F.col("v")
    m = opened(field(v, "metadata"))
    text = lambda node, key: F.try_variant_get(node, f"$['{key}']", "string").alias(key.lower())
    return recs.select("instance_id", v, m.alias("_m"), opened(field(m, "speaker_info")).alias("_s")).select(
        "instance_id",
        *[text(v, k) for k in ("dataset", "file_id", "speaker", "split", "text")],
        text(F.col("_m"), "source_audio"),
        F.try_variant_get("_m", "$.audio_length", "double").alias("audio_length"),
        text(F.col("_m"), "lang"),
        *[text(F.col("_s"), k) for k in ("Speaker_ID", "Speaker_name", "Speaker_gender", "Speaker_birth", "Date")],
        text(F.col("_s"), "Lang").alias("speaker_lang"),
    )


#: child -> columns of its flat table: name -> (JSON key, type).
COLUMNS = {
    "words_align": {"time_s": ("time_s", "double"), "time_e": ("time_e", "double"), "char_s": ("char_s", "int"), "char_e": ("char_e", "int"), "text": ("text", "string")},
    "primary_stress": {"words_align_idx": ("words_align_idx", "int"), "raw": ("raw", "array<double>")},
    "filled_pauses": {"time_s": ("time_s", "double"), "time_e": ("time_e", "double")},
    "memberships": {"party": ("Speaker_party", "string"), "status": ("Party_status", "string")},
    "roles": {"role": ("Role", "string"), "since": ("Since", "string"), "value": ("", "string")},
    "labels": {"value": ("", "string")},
}


def numbers(node: Column) -> Column:
    """The array<double> of a list, of what a JSON string holds or of a lone number; NULL if there is none."""
    listed = let(opened(node), lambda n: F.when(present(n), entries(n)))
    return F.transform(listed, lambda x: F.try_variant_get(x, "$", "double"))


def child_table(recs: DataFrame, kind: str) -> DataFrame:
    """The typed flat table of one kind of child, keyed by instance_id, child, parent_pos, pos."""
    path = lambda key: f"$['{key}']" if key else "$"
    cell = lambda key, t: numbers(field(F.col("node"), key)) if t == "array<double>" else F.try_variant_get("node", path(key), t)
    return child_rows(recs, kind).select(
        "instance_id", "child", "parent_pos", "pos", *[cell(key, t).alias(name) for name, (key, t) in COLUMNS[kind].items()]
    )
