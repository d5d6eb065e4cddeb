"""Repair of conversation structure: faults, the cheapest edits, and the repaired turns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from stayflow.llm import audit_dp
from stayflow.llm.rows import Work

SPACE = r"[\x20\x09-\x0D]"
ROLES = {"u": "user", "a": "assistant"}
# Role initials that may follow each other.
LEGAL = ("su", "ua", "au")
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"


@dataclass(frozen=True)
class Repaired:
    """``audits``: a row per conversation (``key``, n_turns, gaps, blank, duplicate,
    truncated, illegal, cost, audit). ``turns``: the repaired turns (``key``, pos, k, role, text),
    in the order of pos and k."""

    audits: DataFrame
    turns: DataFrame


def damaged(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, turn, role, text) with faults put in by a hash of key and turn: of 20 rows one is
    dropped, one emptied, one loses its sentence ends, one is repeated and one gets the role
    user. Null roles and texts are one space, and so are null keys and turns in the hash."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (key, turn)]
    kind = F.crc32(F.concat(named[0], F.lit(":"), named[1]).cast("binary")) % 20
    own_role, own_text = (F.coalesce(F.col(c), F.lit(" ")) for c in (role, text))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    rows = df.select(
        F.col(key).alias(key),
        F.col(turn).alias(turn),
        F.when(kind == 4, F.lit("user")).otherwise(own_role).alias(role),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(own_text, "[.!?]", "")).otherwise(own_text).alias(text),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy"),
    )
    return rows.drop("_copy")


def repair(
    df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> Repaired:
    """Faults of every conversation and the cheapest edits that mend its structure.

    Turns go by ``turn`` (an integer, nulls first), equal ones by role and the SHA-256 of the text. A turn's
    first fault counts: blank, duplicate (role and text were there earlier), truncated (no
    sentence end at its end). Edits: Keep 0, Rerole to user or assistant 2, Delete 3 (blank and
    duplicate turns must go), Insert an empty user or assistant turn 2; a truncated turn that
    stays adds 1. The repaired role initials are an optional s and pairs ua, or nothing. Of the
    cheapest edits the ASCII-least string of initials is the audit.

    Null roles and texts are one space; a turn whose role is empty cannot be kept as it is; null keys are one conversation; repeated rows are turns
    of their own; other columns are left out. An empty table gives empty tables.

    Rows are sorted by ranges, not by conversation, so one conversation of very many turns is spread over
    tasks. Each task works out its own stretch; for a conversation that goes on in
    another task it does so from every state to every state, and the stretches are joined
    by the same steps afterwards. Only a turn's role initial and fault get there, and the edits
    come back to the texts by position.
    """
    work = Work(df.sparkSession)
    kind = df.schema[key].dataType
    blank_as = F.lit(" ")
    rows = df.select(
        F.col(key).alias("key"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), blank_as).alias("role"),
        F.coalesce(F.col(text), blank_as).alias("text"),
    )
    rows = rows.withColumn("digest", F.sha2("text", 256)).withColumn("row", F.monotonically_increasing_id())
    order = ["key", "turn", "role", "digest", "row"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = work.store(placed.drop("row").withColumn("pos", F.monotonically_increasing_id()), "turns")
    coded = work.store(_with_faults(placed), "faults")
    stretches = work.store(_stretches(coded, kind), "stretches")
    paths = stretches.where("complete").select("key", "pos", F.col("cost")[0].alias("cost"), F.col("path")[0].alias("path"))
    paths = work.store(paths.unionByName(_joined(stretches.where("not complete"), kind)), "paths")
    return Repaired(_audits(placed, coded, stretches, paths, key), _turns(placed, paths, key))


def _with_faults(placed: DataFrame) -> DataFrame:
    """(key, pos, initial, fault); duplicates are turns that are not the first of their kind."""
    firsts = placed.groupBy("key", "role", "digest").agg(F.min("pos").alias("pos"))
    firsts = firsts.select("pos", F.lit(True).alias("first"))
    solid = F.regexp_replace("text", rf"{SPACE}+\z", "")
    fault = (
        F.when(solid == "", BLANK)
        .when(F.col("first").isNull(), DUPLICATE)
        .when(~F.substring(solid, -1, 1).isin(*".!?"), TRUNCATED)
    )
    return placed.join(firsts, "pos", "left").select(
        "key", "pos", F.substring("role", 1, 1).alias("initial"), fault.alias("fault")
    )


def _stretches(coded: DataFrame, kind) -> DataFrame:
    """A row per conversation and task: illegal neighbours, and the cheapest edits; from every
    state to every state where the conversation may go on before or after."""
    names = ["key", "pos", "complete", "initials", "illegal", "ways", "cost", "path"]
    types = [
        to_arrow_type(kind), pa.int64(), pa.bool_(), pa.list_(pa.string()), pa.int64(),
        pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.string()),
    ]
    ddl = (
        f"key {kind.simpleString()}, pos bigint, complete boolean, initials array<string>, illegal bigint, "
        "ways array<int>, cost array<bigint>, path array<string>"
    )
    codes = {BLANK: audit_dp.MUST_GO, DUPLICATE: audit_dp.MUST_GO, TRUNCATED: audit_dp.CUT_SHORT}

    def stretch(key, pos, turns, complete):
        initials = [i for i, _ in turns]
        illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
        if complete:
            found = {(0, 0): audit_dp.whole(turns)}
        else:
            found = {(s, e): way for s in audit_dp.STATES for e, way in audit_dp.part(turns, s).items()}
        ways = [4 * s + e for s, e in found]
        costs, paths = zip(*found.values())
        return key, pos, complete, [initials[0], initials[-1]], illegal, ways, list(costs), list(paths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, turns, start, last, begun, out = None, [], None, None, False, []
        for batch in batches:
            for key, pos, initial, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if turns and (key != now or pos != last + 1):
                    out.append(stretch(now, start, turns, begun and key != now))
                    begun, turns = key != now, []
                if not turns:
                    now, start = key, pos
                turns.append((initial, codes.get(fault, audit_dp.FINE)))
                last = pos
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                out = []
        if turns:
            out.append(stretch(now, start, turns, False))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    ranged = coded.repartitionByRange("pos").sortWithinPartitions("pos")
    return ranged.select("key", "pos", "initial", "fault").mapInArrow(run, ddl)


def _joined(stretches: DataFrame, kind) -> DataFrame:
    """(key, pos, cost, path) of conversations that tasks share: a few stretches for each task."""
    ddl = f"key {kind.simpleString()}, pos bigint, cost bigint, path string"

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        parts = [
            {divmod(int(w), 4): (int(c), p) for w, c, p in zip(r.ways, r.cost, r.path)} for r in rows.itertuples()
        ]
        cost, paths = audit_dp.joined(parts)
        costs = [cost] + [0] * (len(paths) - 1)
        return pd.DataFrame({"key": rows["key"].to_numpy(), "pos": rows["pos"].to_numpy(), "cost": costs, "path": paths})

    return stretches.groupBy("key").applyInPandas(run, ddl)


def _audits(placed: DataFrame, coded: DataFrame, stretches: DataFrame, paths: DataFrame, key: str) -> DataFrame:
    turns = placed.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
    )
    faults = coded.groupBy("key").agg(
        *[F.count_if(F.col("fault") == f).alias(f) for f in (BLANK, DUPLICATE, TRUNCATED)]
    )
    ends = F.array_sort(F.collect_list(F.struct("pos", "initials")))
    seams = F.transform(
        F.sequence(F.lit(1), F.size("ends") - 1), lambda i: F.concat(F.col("ends")[i - 1].initials[1], F.col("ends")[i].initials[0])
    )
    seams = F.size(F.filter(seams, lambda pair: ~pair.isin(*LEGAL)))
    illegal = stretches.groupBy("key").agg(F.sum("illegal").alias("within"), ends.alias("ends"))
    illegal = illegal.select("key", (F.col("within") + F.when(F.size("ends") > 1, seams).otherwise(0)).alias("illegal"))
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "path"))), lambda p: p["path"]), "")
    edits = paths.groupBy("key").agg(F.sum("cost").alias("cost"), F.regexp_replace(audit, "[a-z-]", "").alias("audit"))
    result = turns
    for more in (faults, illegal, edits):
        more = more.withColumnRenamed("key", "key2")
        result = result.join(more, F.col("key").eqNullSafe(F.col("key2")), "left").drop("key2")
    return result.withColumnRenamed("key", key)


def _turns(placed: DataFrame, paths: DataFrame, key: str) -> DataFrame:
    """The turns that the edits leave, with those they add."""
    of_turn = F.regexp_extract_all("path", F.lit("(?:I[ua])*[KRD][a-z-](?:(?:I[ua])+$)?"), 0)
    edits = paths.select("pos", F.posexplode(of_turn).alias("i", "edits"))
    edits = edits.select((F.col("pos") + F.col("i")).alias("pos"), F.regexp_extract_all("edits", F.lit(".."), 0).alias("edits"))
    role = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])

    def done(edit: Column) -> Column:
        what, initial = F.substring(edit, 1, 1), F.substring(edit, 2, 1)
        new_role = F.when(what == audit_dp.KEEP, F.col("role")).otherwise(role[initial])
        return F.struct(new_role.alias("role"), F.when(what == audit_dp.INSERT, "").otherwise(F.col("text")).alias("text"))

    left = F.filter("edits", lambda e: F.substring(e, 1, 1) != audit_dp.DELETE)
    rows = placed.join(edits, "pos").select("key", "pos", F.posexplode(F.transform(left, done)).alias("k", "turn"))
    return rows.select(F.col("key").alias(key), "pos", "k", "turn.role", "turn.text")


def digests(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, sha256): hash of each conversation's turns as ``role:text`` lines. A conversation's
    hash can only be worked out in order, so its turns pass one task, a few at a time."""
    kind = turns.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, begun = None, None, False
        for batch in batches:
            keys, found = [], []
            for value, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun or value != now:
                    if begun:
                        keys.append(now)
                        found.append(digest.hexdigest())
                    now, digest, begun = value, hashlib.sha256(), True
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, to_arrow_type(kind)), pa.array(found, pa.string())], ["key", "sha256"])
        if begun:
            yield pa.RecordBatch.from_arrays(
                [pa.array([now], to_arrow_type(kind)), pa.array([digest.hexdigest()])], ["key", "sha256"]
            )

    ordered = turns.repartition(key).sortWithinPartitions(key, "pos", "k").select(key, "role", "text")
    return ordered.mapInArrow(run, f"key {kind.simpleString()}, sha256 string").withColumnRenamed("key", key)
