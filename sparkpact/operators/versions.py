"""Version histories: numbering, diffs, compatibility, conflicts.

A history is a table of built documents, one per version. The versions of one
``contract_id`` are in order of ``seq`` and, where that is equal, of ``file_path``;
the three together are a version's key. Nothing here joins a contract's versions
with each other: neighbours come from an ordered pass, and "all earlier versions"
is one summary row per contract.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkpact.functions.ordered import HOT_ROWS, Ordered
from sparkpact.functions.types import FIELD_CODES, map_types, readable
from sparkpact.operators.avro import to_avro
from sparkpact.operators.documents import built_contracts

# The compatibility modes.
MODES = ("BACKWARD", "FORWARD", "BOTH", "FORWARD_ALL", "DISABLED")

# Texts of changes and warnings.
ADDED, RETYPED, REMOVED, LOST = "Added column: ", "Modified column type: ", "Removed column: ", " (data will be lost)"

OFFENDING_TYPE = "array<struct<column:string,reason:string>>"
KEY = ("contract_id", "seq", "file_path")


def definition_hash(avro_schema: Column) -> Column:
    """Equal for equal definitions; the rendered text is canonical already."""
    return F.sha2(avro_schema, 256)


def history(docs: DataFrame, order: str = "seq") -> DataFrame:
    """Built documents as ``contract_id, seq, file_path, version, definition_hash, contract``; an unknown path is empty."""
    return to_avro(built_contracts(docs)).select(
        F.col("contract.contract_id").alias("contract_id"),
        F.col(order).cast("bigint").alias("seq"),
        F.col("contract.version").alias("version"),
        definition_hash(F.col("avro_schema")).alias("definition_hash"),
        "contract",
        (F.col("file_path") if "file_path" in docs.columns else F.lit("")).alias("file_path"),
    )


def version_history(versions: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Number versions by change of definition, not by label.

    Adds ``prev_seq``, ``prev_version``, ``changed`` and ``registry_version``. A new
    description, owner or service level is a change; a new label alone is not.
    """
    ordered = Ordered(versions, ["contract_id"], "seq", tie="file_path", hot_rows=hot_rows).previous(
        {"prev_seq": F.col("seq"), "prev_version": F.col("version"), "_prev_hash": F.col("definition_hash")}
    )
    changed = F.col("_prev_hash").isNull() | (F.col("_prev_hash") != F.col("definition_hash"))
    return ordered.with_columns({"changed": changed}).running_sum(F.col("changed").cast("int"), "registry_version").rows().drop("_prev_hash")


# -- diffs ---------------------------------------------------------------------


def _classify(old: Column, new: Column, old_type: Column, new_type: Column) -> list[Column]:
    """The facts about one column, present on the old side, the new side or both."""
    type_changed = F.coalesce(old_type != new_type, F.lit(False))
    nullable_changed = F.coalesce(old["nullable"] != new["nullable"], F.lit(False))
    kind = (
        F.when(new["name"].isNull(), "removed")
        .when(old["name"].isNull() & new["nullable"], "added_optional")
        .when(old["name"].isNull() & new["has_default"], "added_defaulted")
        .when(old["name"].isNull(), "added_required")
        .when(type_changed, "type_modified")
        .when(nullable_changed, "nullable_changed")
        .otherwise("same")
    )
    return [
        F.coalesce(new["name"], old["name"]).alias("column"),
        kind.alias("kind"),
        old_type.alias("old_type"),
        new_type.alias("new_type"),
        old["nullable"].alias("old_nullable"),
        new["nullable"].alias("new_nullable"),
        nullable_changed.alias("nullable_changed"),
    ]


def _type_at(level: str):
    return (lambda c: c["data_type"]) if level == "contract" else (lambda c: map_types(c["data_type"], "avro"))


def diff_versions(old_cols: DataFrame, new_cols: DataFrame, keys: list[str] | None = None, level: str = "contract") -> DataFrame:
    """Compare two column tables: one row per key and column.

    Both have the keys, ``name``, ``data_type`` and ``nullable``; the new side may
    have ``has_default`` (a default other than null). ``level="avro"`` compares the
    rendered types, at which for instance a date and a string are the same.
    """
    keys = keys or ["contract_id"]
    if "has_default" not in new_cols.columns:
        new_cols = new_cols.withColumn("has_default", F.lit(False))
    fields = ["name", "data_type", "nullable"]
    old = old_cols.select(*keys, "name", F.struct(*fields).alias("old"))
    new = new_cols.select(*keys, "name", F.struct(*fields, "has_default").alias("new"))
    both = old.join(new, [*keys, "name"], "full_outer")
    kind = _type_at(level)
    return both.select(*keys, *_classify(F.col("old"), F.col("new"), kind(F.col("old")), kind(F.col("new"))))


_COLUMN = "struct<name:string,data_type:string,nullable:boolean,description:string>"


def side_by_side(old: Column, new: Column) -> Column:
    """Two column lists of one row as pairs (old, new) by name; NULL where there is no old list.

    Both lists are on the row already, so pairing them needs no join.
    """
    kept = F.transform(
        new, lambda n: F.struct(F.try_element_at(F.filter(old, lambda o: o["name"] == n["name"]), F.lit(1)).alias("old"), n.alias("new"))
    )
    gone = F.transform(
        F.filter(old, lambda o: ~F.array_contains(new["name"], o["name"])),
        lambda o: F.struct(o.alias("old"), F.lit(None).cast(_COLUMN).alias("new")),
    )
    return F.when(old.isNotNull(), F.concat(kept, gone))


def _paired(versions: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Each version with ``pairs``: its columns next to its predecessor's, NULL for a first version."""
    with_previous = (
        Ordered(versions, ["contract_id"], "seq", tie="file_path", hot_rows=hot_rows)
        .previous({"prev_seq": F.col("seq"), "prev_columns": F.col("contract.columns")})
        .rows()
    )
    return with_previous.withColumn("pairs", side_by_side(F.col("prev_columns"), F.col("contract.columns")))


def history_diff(versions: DataFrame, level: str = "contract", hot_rows: int = HOT_ROWS) -> DataFrame:
    """``diff_versions`` of every version against its predecessor, keyed (contract_id, seq, file_path)."""
    kind = _type_at(level)
    pair = _paired(versions, hot_rows).select(*KEY, "prev_seq", F.explode("pairs").alias("p"))
    pair = pair.select(
        *KEY,
        "prev_seq",
        F.col("p.old").alias("old"),
        F.col("p.new").alias("n"),
    ).withColumn("new", F.when(F.col("n").isNotNull(), F.struct("n.*", F.lit(False).alias("has_default"))))
    return pair.select(
        *KEY, "prev_seq", *_classify(F.col("old"), F.col("new"), kind(F.col("old")), kind(F.col("new")))
    )


def diff_summary(diff: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per pair of versions: texts of changes and warnings, and how many of each kind.

    What was added or retyped is a change; what was removed or retyped is a warning.
    A group holds the columns of two versions, never more.
    """
    keys = keys or ["contract_id"]
    kind = F.col("kind")
    retyped = F.concat(F.lit(RETYPED), F.col("column"), F.lit(" ("), F.col("old_type"), F.lit(" → "), F.col("new_type"), F.lit(")"))
    added = F.concat(F.lit(ADDED), F.col("column"), F.lit(" ("), F.col("new_type"), F.lit(")"))
    removed = F.concat(F.lit(REMOVED), F.col("column"), F.lit(LOST))
    is_added = kind.startswith("added_")

    def texts(*cases: Column) -> Column:
        return F.sort_array(F.collect_list(F.coalesce(*cases)))

    return diff.groupBy(*keys).agg(
        texts(F.when(is_added, added), F.when(kind == "type_modified", retyped)).alias("changes"),
        texts(F.when(kind == "removed", removed), F.when(kind == "type_modified", retyped)).alias("warnings"),
        *[
            F.count_if(kind == k).alias(k)
            for k in ("added_required", "added_optional", "added_defaulted", "removed", "type_modified", "nullable_changed", "same")
        ],
    )


# -- compatibility -------------------------------------------------------------


def _is_code(avro: Column, nullable: Column, code: tuple[str, bool]) -> Column:
    return (avro == code[0]) & (nullable if code[1] else ~nullable)


def _reads(writer: Column, reader: Column) -> Column:
    """Whether a value written under one column can be read under another."""
    w, r = map_types(writer["data_type"], "avro"), map_types(reader["data_type"], "avro")
    pairs = [(a, b) for a in FIELD_CODES for b in FIELD_CODES if readable((a[0], False), (b[0], False)) and not a[1] and not b[1]]
    promotes = reduce(lambda x, y: x | y, [(w == a[0]) & (r == b[0]) for a, b in pairs])
    return promotes & (reader["nullable"] | ~writer["nullable"])


def _offences(pairs: Column, reader: str, writer: str) -> Column:
    """Reader fields that the writer's data cannot fill."""
    bad = F.filter(
        pairs,
        lambda p: p[reader].isNotNull()
        & ((p[writer].isNull() & ~p[reader]["nullable"]) | (p[writer].isNotNull() & ~_reads(p[writer], p[reader]))),
    )
    return F.transform(
        bad,
        lambda p: F.struct(
            p[reader]["name"].alias("column"),
            F.when(p[writer].isNull(), "no_default").otherwise("type").alias("reason"),
        ),
    ).cast(OFFENDING_TYPE)


def pair_offences(pairs: Column, mode: str) -> Column:
    """Offending columns of one (old, new) pairing under a mode that looks one version back."""
    none = F.array().cast(OFFENDING_TYPE)
    if mode == "DISABLED":
        return none
    forward, backward = _offences(pairs, "old", "new"), _offences(pairs, "new", "old")
    found = {"FORWARD": forward, "BACKWARD": backward, "BOTH": F.array_union(forward, backward)}[mode]
    return F.coalesce(F.array_sort(found), none)


def compatibility(versions: DataFrame, mode: str = "FORWARD_ALL", hot_rows: int = HOT_ROWS) -> DataFrame:
    """``contract_id, seq, file_path, version, compatible, offending`` for every version.

    FORWARD: the data of a version must be readable with its predecessor's schema;
    BACKWARD the other way round; BOTH both; FORWARD_ALL: readable with every
    earlier schema. A reading field without counterpart needs a default, which
    only a nullable column has; types must be equal or promote.
    """
    if mode not in MODES:
        raise ValueError(f"unknown compatibility mode {mode!r}")
    if mode != "FORWARD_ALL":
        checked = _paired(versions, hot_rows).withColumn("offending", pair_offences(F.col("pairs"), mode))
    else:
        declared = first_declared(versions.select(*KEY, F.col("contract.columns").alias("columns")))
        checked = versions.join(declared, "contract_id", "left")
        offending = forward_all_offences(F.col("contract.columns"), F.struct("seq", "file_path"))
        checked = checked.withColumn("offending", offending)
    return checked.select(*KEY, "version", (F.size("offending") == 0).alias("compatible"), "offending")


def first_declared(rows: DataFrame) -> DataFrame:
    """``contract_id, declared``: what each column was, and since when, over all versions of a contract.

    ``rows`` has the key and ``columns``. A version shrinks, before anything is
    shuffled, to when each column first appeared under each type; a contract is one
    row with one entry per column it ever had.
    """
    place = F.struct("seq", "file_path")
    cols = rows.select("contract_id", place.alias("place"), F.explode("columns").alias("c")).select(
        "contract_id", "place", F.col("c.name").alias("column"), map_types(F.col("c.data_type"), "avro").alias("avro"), F.col("c.nullable").alias("nullable")
    )
    # The least place of each type comes first, in rows of one place: the wide rows below are few, not one per version.
    least = cols.groupBy("contract_id", "column", "avro", "nullable").agg(F.min("place").alias("place"))
    firsts = least.groupBy("contract_id", "column").agg(
        *[F.min(F.when(_is_code(F.col("avro"), F.col("nullable"), code), F.col("place"))).alias(_first(code)) for code in FIELD_CODES]
    )
    # Since when a column of a code is one that an earlier version cannot read.
    bad = {code: _least([F.col(_first(r)) for r in FIELD_CODES if not readable(writer=code, reader=r)]) for code in FIELD_CODES}
    required = _least([F.col(_first(code)) for code in FIELD_CODES if not code[1]])
    entry = F.struct("column", required.alias("required"), F.struct(*[value.alias(_bad(code)) for code, value in bad.items()]).alias("bad"))
    return firsts.groupBy("contract_id").agg(F.collect_list(entry).alias("declared"))


def forward_all_offences(columns: Column, place: Column) -> Column:
    """Offences of a version with ``columns`` at ``place`` against all versions before it, from ``declared``.

    A version offends by a column that some earlier type cannot read, or by lacking
    one that an earlier version requires. Everything is on the row: no join.
    """
    declared = F.col("declared")

    def since(c: Column, entry: Column) -> Column:
        avro = map_types(c["data_type"], "avro")
        cases = F.when(F.lit(False), entry["required"])
        for code in FIELD_CODES:
            cases = cases.when(_is_code(avro, c["nullable"], code), entry["bad"][_bad(code)])
        return cases

    retyped = F.filter(
        columns, lambda c: F.exists(F.filter(declared, lambda d: d["column"] == c["name"]), lambda d: F.coalesce(since(c, d) < place, F.lit(False)))
    )
    lacked = F.filter(declared, lambda d: F.coalesce(d["required"] < place, F.lit(False)) & ~F.array_contains(columns["name"], d["column"]))
    found = F.concat(
        F.transform(retyped, lambda c: F.struct(c["name"].alias("column"), F.lit("type").alias("reason"))).cast(OFFENDING_TYPE),
        F.transform(lacked, lambda d: F.struct(d["column"].alias("column"), F.lit("no_default").alias("reason"))).cast(OFFENDING_TYPE),
    )
    return F.coalesce(F.array_sort(found), F.array().cast(OFFENDING_TYPE))


def _first(code: tuple[str, bool]) -> str:
    return f"first_{code[0]}_{'null' if code[1] else 'req'}"


def _bad(code: tuple[str, bool]) -> str:
    return f"bad_{code[0]}_{'null' if code[1] else 'req'}"


def _least(columns: list[Column]) -> Column:
    if not columns:
        return F.lit(None).cast("struct<seq:bigint,file_path:string>")
    return F.least(*columns) if len(columns) > 1 else columns[0]


# -- conflicts -----------------------------------------------------------------


def table_name(contract_id: Column) -> Column:
    return F.lower(F.translate(contract_id, "-", "_"))


def conflicts(versions: DataFrame, file_col: str | None = None) -> DataFrame:
    """``kind, key, version, distinct_items``: what should be one and is several.

    - ``version_redefined``: one id and version label with several definitions
    - ``id_in_several_files``: one id in several files (if ``file_col`` is given)
    - ``table_name_collision``: several ids with one table name

    Each counts distinct values, which Spark first reduces per task.
    """
    redefined = versions.groupBy("contract_id", "version").agg(F.count_distinct("definition_hash").alias("n"))
    found = redefined.where("n > 1").select(F.lit("version_redefined").alias("kind"), F.col("contract_id").alias("key"), "version", "n")
    names = versions.groupBy(table_name(F.col("contract_id")).alias("key")).agg(F.count_distinct("contract_id").alias("n"))
    none = F.lit(None).cast("string").alias("version")
    found = found.unionByName(names.where("n > 1").select(F.lit("table_name_collision").alias("kind"), "key", none, "n"))
    if file_col:
        files = versions.groupBy(F.col("contract_id").alias("key")).agg(F.count_distinct(file_col).alias("n"))
        found = found.unionByName(files.where("n > 1").select(F.lit("id_in_several_files").alias("kind"), "key", none, "n"))
    return found.withColumnRenamed("n", "distinct_items")
