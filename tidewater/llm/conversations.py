"""Conversation repair by a shortest path over edits, with checkpointed backward costs.

A conversation's role initials should read ``(s?(ua)+)?``: four states (nothing yet, after s,
after u, after a). Edits move through rows and states; the cheapest way from (row, state) to the
end is a backward dynamic program. Only its vectors at checkpoints are stored, about a square
root of the rows of them apart; walking forward, a block's vectors are computed again from the
checkpoint behind it, and of the edits that are tight (cost plus what is left equals the cost
here) the ASCII-least is emitted, which gives the least audit of all cheapest ones.

A conversation of any size is cut into segments: rows are dealt by ranges of (conversation,
turn, ...), so one conversation may span many tasks. Each segment first becomes a min-plus matrix
(cost from each state to each state); products of those matrices are the checkpoints at the
segments' ends; then all segments are walked side by side, those that don't begin a conversation
from every state, and the walk that fits the segment before is kept. Only features of rows (role
initial, fault, number of copies) take part; texts move once, for the repaired rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from tidewater.llm.common import shuffle_partitions, table, written
from tidewater.llm.registry import register

FAR = 1 << 60                              # no way
START, AFTER_S, AFTER_U, AFTER_A = range(4)
ENDS = (0, FAR, FAR, 0)                    # costs at the end of a conversation: allowed in START and AFTER_A
WANTED = ("u", "u", "a", "u")              # the role an insert or rerole gives in each state
AFTER = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
DELETE, EDIT = 3, 2                        # costs; an undeleted truncated row adds 1
ROLES = {"u": "user", "a": "assistant"}
GOES, STAYS, PENALTY = 0, 1, 2             # must be deleted; may stay; may stay at a cost of 1


def _kept_state(state: int, initial: str) -> int | None:
    """The state after a row that is kept, None if its role doesn't fit."""
    if initial == "s":
        return AFTER_S if state == START else None
    return AFTER[state] if initial == WANTED[state] else None


def _inserts(row: list[int]) -> tuple[int, ...]:
    """Costs with up to two inserts before ``row``'s (more never help)."""
    return tuple(min(row[q], EDIT + row[AFTER[q]], 2 * EDIT + row[AFTER[AFTER[q]]]) for q in range(4))


def step_back(initial: str, kind: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before a row from the costs behind it."""
    row = []
    for q in range(4):
        best = DELETE + after[q]
        if kind != GOES:
            extra = int(kind == PENALTY)
            best = min(best, EDIT + extra + after[AFTER[q]])
            kept = _kept_state(q, initial)
            if kept is not None:
                best = min(best, extra + after[kept])
        row.append(min(best, FAR))
    return _inserts(row)


class Segment:
    """Rows of one conversation in order: one character of ``initials`` and one of ``kinds`` each."""

    def __init__(self, initials: str, kinds: bytes):
        self.initials, self.kinds = initials, kinds

    def matrix(self) -> list[int]:
        """Costs from each state before the rows to each state behind them, row by row. Inserts
        behind the last row belong to what follows."""
        columns = [tuple(0 if q == end else FAR for q in range(4)) for end in range(4)]
        for initial, kind in zip(reversed(self.initials), reversed(self.kinds)):
            columns = [step_back(initial, kind, c) for c in columns]
        return [columns[end][q] for q in range(4) for end in range(4)]

    def walk(self, state: int, ends: tuple[int, ...]) -> tuple[list[tuple[str, str, str]], int]:
        """The ASCII-least tight edits from ``state``: per row the initials inserted before it, its own
        edit and the initial it is rerolled to; and the state behind the last row. ``ends``: costs
        there, with the inserts that follow."""
        n = len(self.initials)
        size = max(1, isqrt(n))
        stored, costs = {}, ends
        for k in range(n - 1, -1, -1):
            if (k + 1) % size == 0:
                stored[k + 1] = costs
            costs = step_back(self.initials[k], self.kinds[k], costs)
        edits = []
        for first in range(0, n, size):
            last = min(first + size, n)
            block = [stored.get(last, ends)]
            for k in range(last - 1, first - 1, -1):
                block.append(step_back(self.initials[k], self.kinds[k], block[-1]))
            block.reverse()
            for k in range(first, last):
                here, after, inserted = block[k - first], block[k - first + 1], ""
                extra = int(self.kinds[k] == PENALTY)
                while DELETE + after[state] != here[state] and EDIT + here[AFTER[state]] == here[state]:
                    inserted, state = inserted + WANTED[state], AFTER[state]
                kept = _kept_state(state, self.initials[k])
                if DELETE + after[state] == here[state]:
                    edits.append((inserted, "D", ""))
                elif kept is not None and extra + after[kept] == here[state]:
                    edits.append((inserted, "K", ""))
                    state = kept
                else:
                    edits.append((inserted, "R", WANTED[state]))
                    state = AFTER[state]
        return edits, state


CLOSED = _inserts(list(ENDS))  # costs behind a conversation's last row


def closing_inserts(state: int) -> str:
    """Initials inserted behind the last row, until the conversation may end."""
    out = ""
    while ENDS[state]:
        out, state = out + WANTED[state], AFTER[state]
    return out


# rows and their faults ------------------------------------------------------
WHITE = " \t\n\x0b\x0c\r"


def damage_rows(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text``, ``copies`` (1, or 2 for a repeated row): rows damaged by
    crc32 of ``conv_id:turn`` modulo 20. A null counts as one space, in the hashed string too;
    ``conv_id`` and ``turn`` themselves stay null."""
    def spaced(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    return rows.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("damage")).where("damage != 0").select(
        "conv_id", "turn", F.when(F.col("damage") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("damage") == 3, 2).otherwise(1).cast("long").alias("copies"))


def _with_digest(damaged: DataFrame) -> DataFrame:
    return damaged.withColumn("digest", F.md5(F.col("text").cast("binary")))


ROW = ["conv_id", "turn", "role", "digest"]


def row_features(damaged: DataFrame) -> DataFrame:
    """One row per different (conv_id, turn, role, text): ``copies``, ``initial`` (a space for an empty
    role), ``fault`` of its first copy: blank, duplicate, truncated or null. Texts are told apart by
    128-bit hashes and don't move; copies are added up before they are shuffled."""
    words = F.rtrim(F.col("text"), F.lit(WHITE))
    look = F.when(words == "", 0).when(F.substring(words, -1, 1).isin(".", "!", "?"), 1).otherwise(2)
    seen = _with_digest(damaged).select(*ROW, "copies", look.alias("look"))
    distinct = written(seen.groupBy(*ROW).agg(F.sum("copies").alias("copies"), F.min("look").alias("look")), "turns")
    # A (role, text) that stands at several turns is a duplicate at all but the first of them.
    turns = (distinct.groupBy("conv_id", "role", "digest")
             .agg(F.count("*").alias("n"), F.min("turn").alias("least"), F.bool_or(F.col("turn").isNull()).alias("untimed")).where("n > 1")
             .select(F.col("conv_id").alias("f_conv"), F.col("role").alias("f_role"), F.col("digest").alias("f_digest"), "least", "untimed"))
    same = F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("role") == F.col("f_role")) & (F.col("digest") == F.col("f_digest"))
    later = F.col("f_digest").isNotNull() & F.col("turn").isNotNull() & (F.col("untimed") | (F.col("turn") > F.col("least")))
    fault = F.when(F.col("look") == 0, "blank").when(later, "duplicate").when(F.col("look") == 2, "truncated")
    initial = F.when(F.col("role") == "", " ").otherwise(F.substring("role", 1, 1))
    return distinct.join(turns, same, "left").select(*ROW, "copies", initial.alias("initial"), fault.alias("fault"))


# segments ---------------------------------------------------------------------
KINDS = {"blank": GOES, "duplicate": GOES, "truncated": PENALTY, None: STAYS}


def _whole_runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[pa.Table, list[int]]]:
    """Tables of whole runs of equal ``names``, each with the starts of its runs and its length. Only
    a run that goes on past its batch is held back."""
    waiting: list[pa.Table] = []
    key = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if not len(rows):
            continue
        keys = list(zip(*(rows[n].to_pylist() for n in names)))
        starts = [k for k in range(1, len(keys)) if keys[k] != keys[k - 1]]
        if waiting and keys[0] != key:
            starts = [0, *starts]
        if starts:
            held = sum(map(len, waiting))
            ends = [held + k for k in starts]
            yield pa.concat_tables([*waiting, rows.slice(0, starts[-1])]), [0, *ends]
            waiting, rows = [], rows.slice(starts[-1])
        waiting.append(rows)
        key = keys[-1]
    if waiting:
        yield pa.concat_tables(waiting), [0, sum(map(len, waiting))]


RUN = ["part", "conv_id"]


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[tuple[int, int, Segment]]]]:
    for rows, starts in _whole_runs(batches, RUN):
        initials, kinds = rows["initial"].to_pylist(), list(map(KINDS.__getitem__, rows["fault"].to_pylist()))
        yield rows, [(a, b, Segment("".join(initials[a:b]), bytes(kinds[a:b]))) for a, b in zip(starts, starts[1:])]


def _edges(schema: pa.Schema):
    """(part, at, conv_id, matrix) of the first and the last conversation of each part: only those
    can go on in another part. ``at`` is the place of the segment's first row and names it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges: list[tuple] = []
        last = None
        for rows, segments in _segments(batches):
            for a, _, segment in segments:
                here = rows["part"][a].as_py(), rows["at"][a].as_py(), rows["conv_id"][a].as_py(), segment
                if last is None or last[0] != here[0]:
                    edges += [here] if last is None else [last, here]
                last = here
        edges += [last] if last is not None else []
        unique = {e[1]: (*e[:3], e[3].matrix()) for e in edges}.values()
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*unique), schema)] if unique else
                                         [pa.array([], f.type) for f in schema], schema=schema)
    return run


def checkpoints(edges: list) -> dict[int, tuple[bool, tuple[int, ...] | None]]:
    """``edges``: rows (part, at, conv_id, matrix) in order. For each segment of a conversation that spans
    parts: whether it goes on from a segment before, and the costs at its end (None: the
    conversation ends there)."""
    found: dict[int, tuple[bool, tuple[int, ...] | None]] = {}
    after, costs = None, CLOSED  # the segment behind, and the costs at its end
    for edge in reversed(edges):
        if after is not None and after.part != edge.part and after.conv_id == edge.conv_id:
            costs = tuple(min(after.matrix[4 * q + e] + costs[e] for e in range(4)) for q in range(4))
            found[after.at] = (True, found.get(after.at, (True, None))[1])
            found[edge.at] = (False, costs)
        else:
            costs = CLOSED
        after = edge
    return found


STEP = [("segment", pa.int64()), ("from_state", pa.int32()), ("to_state", pa.int32()), ("continues", pa.bool_()),
        ("inserted", pa.string()), ("edit", pa.string()), ("becomes", pa.string()), ("tail", pa.string())]


def _walks(known: dict[int, tuple[bool, tuple[int, ...] | None]], schema: pa.Schema):
    """Rows with the edits of the walks over their segment: from the start, or one from each state
    where it goes on. ``to_state`` is set on the last row of segments in ``known``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, segments in _segments(batches):
            take, out = [], {name: [] for name, _ in STEP}
            places = rows["at"].to_pylist()
            for a, b, segment in segments:
                name = places[a]
                continues, ends = known.get(name, (False, None))
                for state in range(4) if continues else (START,):
                    edits, last = segment.walk(state, CLOSED if ends is None else ends)
                    take.extend(range(a, b))
                    blank = [None] * (b - a - 1)
                    for key, values in (("segment", [name] * (b - a)), ("from_state", [state] * (b - a)), ("continues", [continues] * (b - a)),
                                        ("to_state", [*blank, last if name in known else None]), ("inserted", [e[0] for e in edits]),
                                        ("edit", [e[1] for e in edits]), ("becomes", [e[2] for e in edits]),
                                        ("tail", [*blank, closing_inserts(last) if ends is None else None])):
                        out[key] += values
            table = rows.take(pa.array(take, pa.int64()))
            for key, kind in STEP:
                table = table.append_column(key, pa.array(out[key], kind))
            yield from table.cast(schema).to_batches()
    return run


def chosen_walks(ends: list) -> list[tuple[int, int]]:
    """(segment, from_state) of the walk that fits, for segments that go on from the one before.
    ``ends``: rows (segment, from_state, to_state, continues) in order of segments."""
    chosen, state = [], START
    for segment, group in groupby(ends, key=lambda r: r.segment):
        walks = {w.from_state: w for w in group}
        if walks[START].continues:
            chosen.append((segment, state))
        else:
            state = START
        state = walks[state].to_state
    return chosen


def plan_repairs(features: DataFrame, parts: int | None = None) -> DataFrame:
    """``features`` (see row_features) plus ``at`` (place, in order of conversation, turn with nulls first,
    role, text hash), ``inserted`` (role initials put in before the row), ``edit`` (K, R or D of its first
    copy; further copies are deleted), ``becomes`` (initial after R) and ``tail`` (initials put in behind
    the conversation's last row).

    Rows are dealt to ``parts`` ranges; a conversation spans as many as it needs, and a task holds
    one segment at a time. The driver sees at most two segments of each part. An empty table
    gives an empty plan. Of rows of one turn those with the lesser role, then text hash, come first."""
    spark = features.sparkSession
    parts = parts or shuffle_partitions(spark)
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest"]
    ranged = features.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = written(ranged.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "placed")
    dealt = placed.repartition(parts, "part").sortWithinPartitions("at")
    names = ("part", "at", "conv_id")
    edge = T.StructType([*(placed.schema[n] for n in names), T.StructField("matrix", T.ArrayType(T.LongType()))])
    edges = sorted(dealt.mapInArrow(_edges(to_arrow_schema(edge)), edge).collect(), key=lambda r: r.at)  # at most two a part
    known = checkpoints(edges)
    step = T.StructType([*placed.schema, *from_arrow_schema(pa.schema(STEP))])
    walks = written(dealt.mapInArrow(_walks(known, to_arrow_schema(step)), step), "walks")
    ends = walks.where("to_state IS NOT NULL").select("segment", "from_state", "to_state", "continues").collect()  # at most 8 a part
    chosen = spark.createDataFrame(chosen_walks(sorted(ends, key=lambda r: (r.segment, r.from_state))), "c_segment long, c_state int")
    fits = (F.col("segment") == F.col("c_segment")) & (F.col("from_state") == F.col("c_state"))
    kept = walks.join(F.broadcast(chosen), fits, "left").where(~F.col("continues") | F.col("c_segment").isNotNull())
    return kept.select(*features.columns, "at", "inserted", "edit", "becomes", F.coalesce("tail", F.lit("")).alias("tail"))


# results ------------------------------------------------------------------------
def repair_steps(damaged: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` plus ``text`` of the rows that stay (else null)."""
    texts = _with_digest(damaged).groupBy(*ROW).agg(F.first("text").alias("text"))
    texts = texts.select(*(F.col(c).alias(f"t_{c}") for c in ROW), "text")
    same = [F.col(c).eqNullSafe(F.col(f"t_{c}")) for c in ROW]
    return plan.join(texts, [*same, F.col("edit") != "D"], "left").select(*plan.columns, "text")


def _full(initial: Column) -> Column:
    return F.when(initial == "u", ROLES["u"]).when(initial == "a", ROLES["a"])


def repaired_rows(steps: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``at``, ``place`` (order within ``at``), ``turn`` (null for inserted
    rows), ``role``, ``text``, ``edit``."""
    def inserted(initials: Column, first: Column, like: Column) -> Column:
        letters = F.filter(F.split(initials, ""), lambda c: c != "")
        return F.transform(letters, lambda c, k: F.struct((first + k).cast("int").alias("place"), F.lit(None).cast(like).alias("turn"),
                                                          _full(c).alias("role"), F.lit("").alias("text"), F.lit("I").alias("edit")))
    kind = steps.schema["turn"].dataType
    role = F.when(F.col("edit") == "R", _full(F.col("becomes"))).otherwise(F.col("role"))
    own = F.array(F.struct(F.length("inserted").cast("int").alias("place"), "turn", role.alias("role"), "text", "edit"))
    lines = F.concat(inserted(F.col("inserted"), F.lit(0), kind), F.when(F.col("edit") != "D", own).otherwise(F.slice(own, 1, 0)),
                     inserted(F.col("tail"), F.length("inserted") + 1, kind))
    return steps.select("conv_id", "at", F.inline(lines))


def repair_conversations(damaged: DataFrame, parts: int | None = None) -> DataFrame:
    """The repaired rows (see repaired_rows) of ``damaged`` (conv_id, turn, role, text and, if it has one,
    ``copies``; others don't matter, whatever their names). A null role or text counts as one space."""
    copies = F.col("copies") if "copies" in damaged.columns else F.lit(1)
    rows = damaged.select("conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")), copies.cast("long").alias("copies"))
    return repaired_rows(repair_steps(rows, plan_repairs(row_features(rows), parts)))


LEGAL = {"su", "ua", "au"}


class _Digest:
    """What the contract asks of one conversation, from its steps in order; texts pass through."""

    def __init__(self):
        self.sha, self.lines, self.audit = hashlib.sha256(), 0, []
        self.turns = self.low = self.high = None
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal = self.cost = 0
        self.initial = None

    def line(self, role: str, text: str) -> None:
        self.sha.update(("\n" * bool(self.lines) + f"{role}:{text}").encode("utf-8", "replace"))
        self.lines += 1

    def insert(self, initials: str) -> None:
        for i in initials:
            self.line(ROLES[i], "")
        self.audit.append("I" * len(initials))
        self.cost += EDIT * len(initials)

    def step(self, s: dict) -> None:
        if s["turn"] is not None:
            self.turns = (self.turns or 0) + (s["turn"] != self.high)
            self.low, self.high = s["turn"] if self.low is None else self.low, s["turn"]
        if self.initial is not None:
            self.illegal += self.initial + s["initial"] not in LEGAL
        self.initial = s["initial"]
        more = s["copies"] - 1
        self.illegal += more
        if s["fault"]:
            self.counts[s["fault"]] += 1
        self.counts["blank" if s["fault"] == "blank" else "duplicate"] += more
        self.insert(s["inserted"])
        if s["edit"] != "D":
            self.line(ROLES[s["becomes"]] if s["edit"] == "R" else s["role"], s["text"])
            self.cost += (EDIT if s["edit"] == "R" else 0) + (s["fault"] == "truncated")
        else:
            self.cost += DELETE
        self.cost += DELETE * more
        self.audit.append(s["edit"] + "D" * more)
        self.insert(s["tail"])

    def row(self) -> tuple:
        gaps = 0 if self.turns is None else self.high - self.low + 1 - self.turns
        return gaps, *self.counts.values(), self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest()


def _digests(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, key, done = None, None, []
        for batch in batches:
            for s in batch.to_pylist():
                if now is None or s["conv_id"] != key:
                    if now is not None:
                        done.append((key, *now.row()))
                    now, key = _Digest(), s["conv_id"]
                now.step(s)
            if len(done) > 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
                done = []
        if now is not None:
            done.append((key, *now.row()))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
    return run


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def audit_conversations(rows: DataFrame, damaged: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per ``conv_id`` of ``rows``: faults of its ``damaged`` rows, cost and audit of the cheapest
    repair, hash of the repaired rows. Null ids are one conversation. A conversation without
    damaged rows has zeros, an empty audit and the hash of nothing; an empty table gives no rows.
    Hash and audit are sequential by nature: the steps of a conversation stream through one
    task, which holds a batch of them and the audit."""
    steps = repair_steps(damaged, plan_repairs(row_features(damaged), parts))
    schema = T.StructType([rows.schema["conv_id"], *(T.StructField(c, T.LongType()) for c in COUNTS),
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    needed = ["conv_id", "at", "turn", "role", "copies", "initial", "fault", "inserted", "edit", "becomes", "tail", "text"]
    ordered = steps.select(*needed).repartition("conv_id").sortWithinPartitions("conv_id", "at")
    found = ordered.mapInArrow(_digests(to_arrow_schema(schema)), schema).withColumnRenamed("conv_id", "of")
    empty = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    every = rows.select("conv_id").distinct()
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        "conv_id", *(F.coalesce(F.col(c), F.lit(empty.get(c, 0))).alias(c) for c in [*COUNTS, *empty]))


@register("op11_conversation_repair")
def op11_conversation_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return audit_conversations(rows, damage_rows(rows))
