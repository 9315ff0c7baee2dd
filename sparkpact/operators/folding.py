"""Decisions over whole histories: each version held against what was accepted before it.

Whether a version is accepted depends on which ones before it were. Contracts of up to ``CHUNK`` versions are folded in one
aggregate each, side by side. Longer histories are cut into blocks of ``CHUNK`` versions, and the number of jobs stays the same
whatever their length:

1. every block is reduced, in parallel, to its distinct definitions and the order in which they come;
2. one walk per long contract goes over its blocks in order and notes the state at the beginning of each. It streams, holds one
   block and the state, and compares a definition once for each state it meets;
3. all blocks are folded, in parallel, from their states.

Under DISABLED nothing is compared: a version is accepted if it differs from the one before, which is one ordered pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkpact.functions.ordered import HOT_ROWS, Ordered
from sparkpact.functions.types import FIELD_CODES, map_types, readable
from sparkpact.operators.versions import KEY, MODES
from sparkpact.session import materialize

CHUNK = 500
STATE = "struct<hash:string,registry_version:bigint,codes:array<string>,names:array<string>,required:array<string>>"
_DECISIONS = "array<struct<seq:bigint,file_path:string,action:string,registry_version:bigint>>"
_MARK = "\u0001"


def _code_text(code: tuple[str, bool]) -> str:
    return code[0] + ("?" if code[1] else "")


def _code(c: Column) -> Column:
    return F.concat(map_types(c["data_type"], "avro"), F.when(c["nullable"], "?").otherwise(""))


def _token(name: Column, code: Column) -> Column:
    return F.concat(name, F.lit(_MARK), code)


def _barred(columns: Column, as_reader: bool) -> Column:
    """Tokens of the codes that a list of columns cannot read (or be read by)."""
    table = []
    for own in FIELD_CODES:
        others = [o for o in FIELD_CODES if not (readable(o, own) if as_reader else readable(own, o))]
        table += [F.lit(_code_text(own)), F.array(*[F.lit(_code_text(o)) for o in others])]
    lookup = F.create_map(*table)
    return F.flatten(
        F.transform(columns, lambda c: F.transform(F.try_element_at(lookup, _code(c)), lambda o: _token(c["name"], o)))
    )


def _with_tokens(rows: DataFrame, mode: str) -> DataFrame:
    columns = F.col("columns")
    none = F.array().cast("array<string>")
    return rows.withColumns(
        {
            "codes": F.transform(columns, lambda c: _token(c["name"], _code(c))),
            "names": columns["name"],
            "required": F.filter(columns, lambda c: ~c["nullable"])["name"],
            "bars_forward": _barred(columns, as_reader=False) if mode != "BACKWARD" else none,
            "bars_backward": _barred(columns, as_reader=True) if mode in ("BACKWARD", "BOTH") else none,
        }
        if mode != "DISABLED"
        # Nothing is compared, so nothing is carried along.
        else dict.fromkeys(("codes", "names", "required", "bars_forward", "bars_backward"), none)
    )


def _acceptable(state: Column, v: Column, mode: str) -> Column:
    forward = (F.size(F.array_except(state["required"], v["names"])) == 0) & ~F.arrays_overlap(state["codes"], v["bars_forward"])
    backward = (F.size(F.array_except(v["required"], state["names"])) == 0) & ~F.arrays_overlap(state["codes"], v["bars_backward"])
    rules = {"FORWARD": forward, "FORWARD_ALL": forward, "BACKWARD": backward, "BOTH": forward & backward, "DISABLED": F.lit(True)}
    return rules[mode]


def _fold(versions: Column, start: Column, mode: str) -> Column:
    """Run the versions, in order, from a state: ``STRUCT<state, decisions>``."""

    def step(acc: Column, v: Column) -> Column:
        state = acc["state"]
        action = (
            F.when(state["hash"].isNull(), "create")
            .when(state["hash"] == v["definition_hash"], "unchanged")
            .when(_acceptable(state, v, mode), "new_version")
            .otherwise("rejected")
        )

        def after(action: Column) -> Column:
            taken = action.isin("create", "new_version")
            number = F.coalesce(state["registry_version"], F.lit(0)) + F.when(taken, 1).otherwise(0)

            def carry(key: str) -> Column:
                new = F.array_union(state[key], v[key]) if mode == "FORWARD_ALL" else v[key]
                return F.when(taken, new).otherwise(state[key]).alias(key)

            return F.struct(
                F.struct(
                    F.when(taken, v["definition_hash"]).otherwise(state["hash"]).alias("hash"),
                    number.alias("registry_version"),
                    carry("codes"),
                    carry("names"),
                    carry("required"),
                ).cast(STATE).alias("state"),
                F.concat(
                    acc["decisions"],
                    F.array(F.struct(v["seq"], v["file_path"], action, number)).cast(_DECISIONS),
                ).alias("decisions"),
            )

        # A one-element array names the action, so that it is worked out once.
        return F.transform(F.array(action), after)[0]

    empty = F.array().cast("array<string>")
    fresh = F.struct(F.lit(None), F.lit(None), empty, empty, empty).cast(STATE)
    begin = F.struct(F.coalesce(start, fresh).cast(STATE).alias("state"), F.array().cast(_DECISIONS).alias("decisions"))
    return F.aggregate(versions, begin, step)


def registered_state(registry: DataFrame, mode: str) -> DataFrame:
    """Where each contract stands: its current entry, and under FORWARD_ALL all it ever declared."""
    current = _with_tokens(registry, mode).groupBy("contract_id").agg(
        F.max_by(F.struct("definition_hash", "registry_version", "codes", "names", "required"), "registry_version").alias("now")
    )
    if mode != "FORWARD_ALL":
        return current.select("contract_id", F.struct("now.definition_hash", "now.registry_version", "now.codes", "now.names", "now.required").cast(STATE).alias("state"))
    declared = (
        registry.select("contract_id", F.explode("columns").alias("c"))
        .select("contract_id", F.col("c.name").alias("name"), _code(F.col("c")).alias("code"))
        .distinct()
        .groupBy("contract_id")
        .agg(
            F.collect_list(_token(F.col("name"), F.col("code"))).alias("codes"),
            F.collect_set(F.when(~F.col("code").endswith("?"), F.col("name"))).alias("required"),
        )
    )
    none = F.array().cast("array<string>")
    return current.join(declared, "contract_id").select(
        "contract_id", F.struct("now.definition_hash", "now.registry_version", "codes", none, "required").cast(STATE).alias("state")
    )



# -- long histories --------------------------------------------------------------

_TOKENS = ("codes", "names", "required", "bars_forward", "bars_backward")
_SETS = ("codes", "names", "required")
_ENTRY = {"contract_id": pa.string(), "_chunk": pa.int64(), "hash": pa.string(), "registry_version": pa.int64()} | {k: pa.list_(pa.string()) for k in _SETS}
_ENTRY_DDL = "contract_id string, _chunk bigint, hash string, registry_version bigint, " + ", ".join(f"{k} array<string>" for k in _SETS)
# Strings of states that a batch of the walk returns at most, beside those of its last one.
_BATCH_STRINGS = 100_000


class _Walk:
    """The state of one contract, carried over its blocks."""

    def __init__(self, contract_id: str, state: dict | None, mode: str):
        self.contract_id, self.mode = contract_id, mode
        self.hash = state["hash"] if state else None
        self.number = (state["registry_version"] if state else None) or 0
        self.sets = {k: set(state[k] if state else ()) for k in _SETS}

    def _accepts(self, v: dict) -> bool:
        forward = self.sets["required"] <= v["names"] and self.sets["codes"].isdisjoint(v["bars_forward"])
        if self.mode in ("FORWARD", "FORWARD_ALL"):
            return forward
        backward = v["required"] <= self.sets["names"] and self.sets["codes"].isdisjoint(v["bars_backward"])
        return backward if self.mode == "BACKWARD" else forward and backward

    def block(self, definitions: list[dict], order: list[int]) -> None:
        """Go over the versions of a block, given by their place among its distinct definitions (from 1)."""
        wide = [{"hash": d["hash"]} | {k: frozenset(d[k]) for k in _TOKENS} for d in definitions]
        known: dict[int, bool] = {}
        for place in order:
            v = wide[place - 1]
            if v["hash"] == self.hash:
                continue
            if place not in known:
                known[place] = self.hash is None or self._accepts(v)
            if not known[place]:
                continue
            self.hash, self.number = v["hash"], self.number + 1
            before = sum(map(len, self.sets.values()))
            for k in _SETS:
                if self.mode == "FORWARD_ALL":
                    self.sets[k] |= v[k]
                else:
                    self.sets[k] = set(v[k])
            # Verdicts hold as long as the state does; what is only gathered is the same when it has not grown.
            if self.mode != "FORWARD_ALL" or sum(map(len, self.sets.values())) != before:
                known = {}

    def row(self, chunk: int) -> tuple:
        return self.contract_id, chunk, self.hash, self.number, *(sorted(self.sets[k]) for k in _SETS)


def _entry_states(blocks: DataFrame, state: DataFrame, mode: str) -> DataFrame:
    """``contract_id, _chunk, state``: where each block but the first of a long contract begins.

    ``blocks`` has one row per contract and block with its ``versions``. Blocks of one contract come to one task, one
    after another, reduced to what the walk needs; contracts are walked side by side.
    """
    long = blocks.where("_chunk = 1").select("contract_id")
    distinct = F.array_distinct(F.transform("versions", lambda v: F.struct(v["definition_hash"].alias("hash"), *(v[k] for k in _TOKENS))))
    order = F.transform("versions", lambda v: F.array_position(F.col("definitions.hash"), v["definition_hash"]).cast("int"))
    reduced = (
        blocks.join(long, "contract_id", "left_semi")
        .withColumn("definitions", distinct)
        .select("contract_id", "_chunk", "definitions", order.alias("places"))
        .join(state.withColumn("_chunk", F.lit(0).cast("bigint")), ["contract_id", "_chunk"], "left")
        .select("contract_id", "_chunk", "definitions", "places", "state")
    )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: _Walk | None = None
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for i in range(batch.num_rows):
                contract_id, chunk, definitions, places, start = (column[i].as_py() for column in batch.columns)
                if own is None or own.contract_id != contract_id:
                    own = _Walk(contract_id, start, mode)
                else:
                    rows.append(own.row(chunk))
                    size += sum(map(len, rows[-1][4:]))
                    if size > _BATCH_STRINGS:
                        yield _as_batch(rows)
                        rows, size = [], 0
                own.block(definitions, places)
        yield _as_batch(rows)

    ordered = reduced.repartition("contract_id").sortWithinPartitions("contract_id", "_chunk")
    found = ordered.mapInArrow(walk, _ENTRY_DDL)
    return found.select("contract_id", "_chunk", F.struct("hash", "registry_version", *_SETS).cast(STATE).alias("state"))


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_ENTRY)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, _ENTRY.values())], names=list(_ENTRY))


def _spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Dealt to as many tasks as the session says: small rows that are costly to fold are not put together by their bytes."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _versions_of(rows: DataFrame, mode: str, *keys: str) -> DataFrame:
    """The versions of each group as one array, in order, with the tokens that decide."""
    version = F.struct("seq", "file_path", "definition_hash", *_TOKENS)
    return _with_tokens(_spread(rows, *keys), mode).groupBy(*keys).agg(F.array_sort(F.collect_list(version)).alias("versions"))


def _decided(folded: Column) -> list[Column]:
    return ["contract_id", F.inline(folded["decisions"])]


def _by_fold(lean: DataFrame, state: DataFrame, mode: str, chunk: int, hot_rows: int) -> DataFrame:
    longest = lean.groupBy("contract_id").count().agg(F.max("count")).first()[0] or 0
    if longest <= chunk:
        whole = _versions_of(lean, mode, "contract_id").join(state, "contract_id", "left")
        return whole.select("contract_id", _fold(F.col("versions"), F.col("state"), mode).alias("f")).select(*_decided(F.col("f")))
    numbered = (
        Ordered(lean, ["contract_id"], "seq", tie="file_path", hot_rows=hot_rows)
        .running_sum(F.lit(1), "_place")
        .rows()
        .withColumn("_chunk", F.expr(f"(_place - 1) div {chunk}"))
        .drop("_place")
    )
    # Read by the walk and by the fold: written once.
    blocks = materialize(_versions_of(numbered, mode, "contract_id", "_chunk"), "blocks")
    first = state.select("contract_id", F.lit(0).cast("bigint").alias("_chunk"), "state")
    begin = first.unionByName(materialize(_entry_states(blocks, state, mode), "entry-states"))
    each = _spread(blocks, "contract_id", "_chunk").join(begin, ["contract_id", "_chunk"], "left")
    return each.select("contract_id", _fold(F.col("versions"), F.col("state"), mode).alias("f")).select(*_decided(F.col("f")))


def _by_change(lean: DataFrame, current: DataFrame, hot_rows: int) -> DataFrame:
    """Without comparison what was accepted last is always the version before."""
    versions = lean.join(current.select("contract_id", F.col("state.hash").alias("_hash"), F.col("state.registry_version").alias("_number")), "contract_id", "left")
    ordered = Ordered(versions, ["contract_id"], "seq", tie="file_path", hot_rows=hot_rows).previous({"_previous": F.col("definition_hash")})
    before = F.coalesce("_previous", "_hash")
    action = F.when(before.isNull(), "create").when(before == F.col("definition_hash"), "unchanged").otherwise("new_version")
    numbered = ordered.with_columns({"action": action}).running_sum(F.when(F.col("action") == "unchanged", 0).otherwise(1), "_accepted").rows()
    return numbered.select(*KEY, "action", (F.coalesce("_number", F.lit(0)) + F.col("_accepted")).alias("registry_version"))


def decide(rows: DataFrame, mode: str, state: DataFrame | None, chunk: int = CHUNK, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``contract_id, seq, file_path, action, registry_version`` of every version of ``rows``.

    ``rows`` has the key, ``definition_hash`` and ``columns``; of nothing else is anything moved. ``state`` says where
    contracts stand before them (``registered_state``).
    """
    if mode not in MODES:
        raise ValueError(f"unknown compatibility mode {mode!r}")
    if state is None:
        state = rows.sparkSession.createDataFrame([], f"contract_id string, state {STATE}")
    if mode == "DISABLED":
        return _by_change(rows.select(*KEY, "definition_hash"), state, hot_rows)
    return _by_fold(rows.select(*KEY, "definition_hash", "columns"), state, mode, chunk, hot_rows)
