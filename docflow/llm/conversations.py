"""Conversation structure repair: cheapest edits by a cost DP, the least audit among them by prefix-doubling path ranking."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from docflow.llm.common import stored

# States: nothing given yet, last given role.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = (USER, USER, ASSISTANT, USER)  # what a reroled or inserted turn is given as in each state
ENDS = (START, ASSISTANT)
COST = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED_COST = 5
NEVER = 1 << 40
LETTERS = "DIKR"  # rising
# A row as one byte: role by its initial (0 another one, else as the states), 4 for truncated, 8 for a row that must go.
CUT, GONE = 4, 8


def arcs(code: int, state: int) -> dict[str, tuple[int, int]]:
    """Edits of a row in a state, with cost and next state. No two edits of one letter: a letter tells the next state."""
    found = {"D": (COST["D"], state)}
    if not code & GONE:
        more = TRUNCATED_COST if code & CUT else 0
        found["R"] = (COST["R"] + more, AFTER[state])
        role = code & 3
        if role == AFTER[state] or (role == SYSTEM and state == START):
            found["K"] = (COST["K"] + more, role)
    return found


ARCS = [[arcs(code, state) for state in range(4)] for code in range(16)]


def with_inserts(costs: list[int]) -> list[int]:
    """Costs to go before a row, if turns may be inserted first. Two inserts lead through all states worth reaching."""
    out = []
    for state in range(4):
        once = AFTER[state]
        out.append(min(costs[state], COST["I"] + costs[once], 2 * COST["I"] + costs[AFTER[once]]))
    return out


def costs_to_go(codes: bytes, last: list[int]) -> list[list[int]]:
    """Least cost from each state before each row to the end, where it is ``last``."""
    table = [last]
    for code in reversed(codes):
        after = table[-1]
        table.append(with_inserts([min(c + after[to] for c, to in options.values()) for options in ARCS[code]]))
    return table[::-1]


def end_costs() -> list[int]:
    return with_inserts([0 if state in ENDS else NEVER for state in range(4)])


def transfer(codes: bytes) -> list[list[int]]:
    """Least cost from each state before the rows to each state after them."""
    columns = [costs_to_go(codes, [0 if s == end else NEVER for s in range(4)])[0] for end in range(4)]
    return [[min(NEVER, columns[end][state]) for end in range(4)] for state in range(4)]


def ranked_paths(codes: bytes, last: list[int], closing: bool) -> list[tuple[str, str, int]]:
    """From each state: audit, given roles (an initial for each letter, ``-`` for a deletion) and last state of the least
    cheapest path. ``closing``: the rows end the conversation, turns may be inserted after the last one.

    Nodes are (row, state); an optimal arc's cost and its end's cost to go make up its start's. Nodes are ranked by their next
    1, 2, 4, ... letters: a rank pairs a node's rank with the one of the node its pointer leads to, and pointers double. Of a
    node's optimal arcs the one with the least letter, then the least rank of its end, is taken; as a letter tells the next
    node, the least prefix of any length ends in one node. All nodes of a path are read off at once through the pointers.
    """
    n = len(codes)
    table = costs_to_go(codes, last)
    stop = 4 * (n + 1)
    none = len(LETTERS) + 1
    letters = np.full((stop + 1, len(LETTERS)), none, np.int64)
    ends = np.full((stop + 1, len(LETTERS)), stop, np.int64)
    for row in range(n + 1):
        for state in range(4):
            best = table[row][state]
            if best >= NEVER or (row == n and (not closing or state in ENDS)):
                continue
            moves = [(k, c + table[row + 1][to], 4 * (row + 1) + to) for k, (c, to) in ARCS[codes[row]][state].items()] if row < n else []
            moves.append(("I", COST["I"] + table[row][AFTER[state]], 4 * row + AFTER[state]))
            for i, (k, cost, to) in enumerate(moves):
                if cost == best:
                    letters[4 * row + state, i], ends[4 * row + state, i] = 1 + LETTERS.index(k), to
    every = np.arange(stop + 1)
    taken = letters.argmin(axis=1)
    while True:
        letter = letters[every, taken] % none  # 0: the path stops
        jumps, rank = [ends[every, taken]], letter
        while (jumps[-1][jumps[-1]] != jumps[-1]).any():
            rank = np.unique(rank * (stop + none) + rank[jumps[-1]], return_inverse=True)[1]
            jumps.append(jumps[-1][jumps[-1]])
        again = (letters * (stop + none) + rank[ends]).argmin(axis=1)
        if (again == taken).all():
            break
        taken = again
    found = []
    steps = np.arange(1 << len(jumps))
    for state in range(4):
        nodes = np.full(len(steps), state, np.int64)
        for k, jump in enumerate(jumps):
            nodes = np.where(steps >> k & 1, jump[nodes], nodes)
        path = nodes[letter[nodes] > 0]
        to = jumps[0][path] % 4
        audit = "".join(LETTERS[i - 1] for i in letter[path])
        given = "".join("-" if a == "D" else "?sua"[t] for a, t in zip(audit, to.tolist()))
        found.append((audit, given, int(to[-1]) if len(path) else state))
    return found


def read(rows: DataFrame, names: tuple[str, str, str, str]) -> DataFrame:
    """``ck, conv, turn, role, text, code``; ``ck`` is the conversation as text that is never NULL. NULLs count as one space."""
    conv, turn, role, text = (F.col(f"`{n}`") for n in names)
    space = F.lit(" ")
    name = F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space))
    return rows.select(
        F.concat(F.when(conv.isNull(), "n").otherwise("k"), F.coalesce(conv.cast("string"), space)).alias("ck"),
        conv.alias("conv"),
        turn.alias("turn"),
        F.coalesce(role, space).alias("role"),
        F.coalesce(text, space).alias("text"),
        (F.crc32(name.cast("binary")) % 20).alias("hit"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """``ck, turn, role, text, copies`` after the damage that ``hit`` asks for; equal rows of a turn are one with a count."""
    hit = F.col("hit")
    hurt = rows.filter(hit != 0).select(
        "ck",
        "turn",
        F.when(hit == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(hit == 3, 2).otherwise(1).alias("copies"),
    )
    return hurt.groupBy("ck", "turn", "role", "text").agg(F.sum("copies").alias("copies"))


def judged(rows: DataFrame) -> DataFrame:
    """``rows`` with ``fault`` (blank, duplicate, truncated or NULL) and ``code`` of the first copy. Further copies are duplicates,
    unless blank."""
    named = rows.withColumns({"h1": F.xxhash64("text"), "h2": F.md5("text")})
    turn = F.struct(F.col("turn").isNotNull().alias("b"), F.col("turn").alias("t"))
    first = named.groupBy("ck", "role", "h1", "h2").agg(F.min(turn).alias("first"))
    end = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    again = ~F.col("first.t").eqNullSafe(F.col("turn"))
    fault = F.when(end == "", "blank").when(again, "duplicate").when(~F.right(end, F.lit(1)).isin(".", "!", "?"), "truncated")
    initial = F.instr(F.lit("sua"), F.left("role", F.lit(1)))
    role = F.when(F.length("role") == 0, 0).otherwise(initial)
    met = named.join(first, ["ck", "role", "h1", "h2"]).withColumn("fault", fault)
    code = role + F.when(F.col("fault") == "truncated", CUT).when(F.col("fault").isNotNull(), GONE).otherwise(0)
    return met.select("ck", "turn", "role", "text", "copies", "fault", code.cast("int").alias("code"), F.col("h1").alias("h"))


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` in the order of their conversations, dealt by range, with ``part`` and ``at``: the partition, and the place of the
    first copy among the rows of its conversation there. A large conversation lies over many partitions.

    Rows of one turn stand by role and text hash."""
    order = [F.col("ck"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("h")]
    parts = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, "text").drop("h")
    schema = T.StructType(ranged.schema.fields + T.StructType.fromDDL("part int, at bigint").fields)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, at = TaskContext.get().partitionId(), None, 0
        for b in batches:
            places = []
            for ck, copies in zip(b.column("ck").to_pylist(), b.column("copies").to_pylist()):
                if ck != now:
                    now, at = ck, 0
                places.append(at)
                at += copies
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * b.num_rows, pa.int32()), pa.array(places, pa.int64())], names=schema.names)

    return ranged.mapInArrow(number, schema)


def illegal_pairs(roles: np.ndarray) -> int:
    """Neighbours other than su, ua, au."""
    a, b = roles[:-1], roles[1:]
    return int((~(((a == SYSTEM) & (b == USER)) | ((a == USER) & (b == ASSISTANT)) | ((a == ASSISTANT) & (b == USER)))).sum())


def mapped(df: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(row) -> row`` over the rows, as dicts, in Arrow batches; a list of rows gives several."""
    names = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from pa.Table.from_pylist([x for row in b.to_pylist() for x in fn(row)], schema=arrow).to_batches()

    return df.mapInArrow(run, names)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Dealt by keys over a fixed number of tasks: rows here are small, but each one takes time."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def pieces(rows: DataFrame) -> DataFrame:
    """One row per conversation and partition that it lies in: its codes, cost matrix, illegal neighbours, outer roles."""
    lists = spread(rows.select("ck", "part", "at", "code", "copies"), "ck", "part").groupBy("ck", "part").agg(F.sort_array(F.collect_list(F.struct("at", "code", "copies"))).alias("rows"))

    def piece(row):
        codes = b"".join(bytes([r["code"]]) + bytes([r["code"] & 3 | GONE]) * (r["copies"] - 1) for r in row["rows"])
        roles = np.frombuffer(codes, np.uint8) & 3
        yield {"ck": row["ck"], "part": row["part"], "codes": codes, "matrix": transfer(codes), "illegal": illegal_pairs(roles), "first": int(roles[0]), "last": int(roles[-1])}

    return mapped(lists, piece, "ck string, part int, codes binary, matrix array<array<bigint>>, illegal bigint, first int, last int")


def cost_chain(found: DataFrame) -> DataFrame:
    """``ck, part, ends, closing`` of each piece: costs to go at its end; with the whole cost and illegal neighbours on the first
    piece. A conversation has at most one small matrix per partition here."""
    lists = spread(found, "ck").groupBy("ck").agg(F.sort_array(F.collect_list(F.struct("part", "matrix", "illegal", "first", "last"))).alias("ps"))

    def chain(row):
        ps, ends, out = row["ps"], end_costs(), []
        for i in range(len(ps) - 1, -1, -1):
            out.append({"ck": row["ck"], "part": ps[i]["part"], "ends": ends, "closing": i == len(ps) - 1, "cost": 0, "illegal": 0})
            ends = [min(NEVER, *(c + e for c, e in zip(line, ends))) for line in ps[i]["matrix"]]
        between = sum(illegal_pairs(np.array([a["last"], b["first"]])) for a, b in zip(ps, ps[1:]))
        out[-1] |= {"cost": ends[START], "illegal": sum(p["illegal"] for p in ps) + between}
        yield from out

    return mapped(lists, chain, "ck string, part int, ends array<bigint>, closing boolean, cost bigint, illegal bigint")


PATHS = "array<struct<audit:string,given:string,last:int>>"


def audits(found: DataFrame, chained: DataFrame) -> DataFrame:
    """``ck, part, audit, given`` of each piece: its least path from the state that the pieces before it end in."""

    def ranked(row):
        paths = ranked_paths(row["codes"], row["ends"], row["closing"])
        yield {"ck": row["ck"], "part": row["part"], "paths": [dict(zip(("audit", "given", "last"), p)) for p in paths]}

    paths = stored(mapped(spread(found, "ck", "part").join(spread(chained, "ck", "part").hint("merge"), ["ck", "part"]).select("ck", "part", "codes", "ends", "closing"), ranked, f"ck string, part int, paths {PATHS}"), "turn-paths")
    lists = paths.select("ck", "part", F.transform("paths", lambda p: p["last"]).alias("to")).groupBy("ck").agg(F.sort_array(F.collect_list(F.struct("part", "to"))).alias("ps"))

    def entries(row):
        state = START
        for p in row["ps"]:
            yield {"ck": row["ck"], "part": p["part"], "state": state}
            state = p["to"][state]

    taken = F.col("paths")[F.col("state")]
    return paths.join(mapped(lists, entries, "ck string, part int, state int").hint("merge"), ["ck", "part"]).select("ck", "part", taken["audit"].alias("audit"), taken["given"].alias("given"))


def repaired_turns(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """``ck, part, at, sub, role, text``: the turns after repair; ``part, at, sub`` give their order."""

    def turns(row):
        at = sub = 0
        for edit, role in zip(row["audit"], row["given"]):
            if edit != "D":
                yield {"ck": row["ck"], "part": row["part"], "at": at, "sub": sub, "edit": edit, "given": {"u": "user", "a": "assistant"}.get(role)}
            at, sub = (at, sub + 1) if edit == "I" else (at + 1, 0)

    made = mapped(audited, turns, "ck string, part int, at bigint, sub int, edit string, given string")
    own = rows.select("ck", "part", "at", F.col("role").alias("was"), "text")
    kept = made.filter("edit <> 'I'").join(own.hint("merge"), ["ck", "part", "at"])
    kept = kept.select("ck", "part", "at", "sub", F.when(F.col("edit") == "K", F.col("was")).otherwise(F.col("given")).alias("role"), "text")
    return kept.unionAll(made.filter("edit = 'I'").select("ck", "part", "at", "sub", F.col("given").alias("role"), F.lit("").alias("text")))


def digests(turns: DataFrame) -> DataFrame:
    """``ck, repaired_sha256`` over the turns as ``role:text`` lines. A digest is one chain of bytes: they stream through a task
    in order, and no conversation is held as a whole."""
    ordered = turns.repartition("ck").sortWithinPartitions("ck", "part", "at", "sub").select("ck", F.concat("role", F.lit(":"), "text").alias("line"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for b in batches:
            done: list[tuple[str, str]] = []
            for ck, line in zip(b.column("ck").to_pylist(), b.column("line").to_pylist()):
                if ck != now:
                    if state:
                        done.append((now, state.hexdigest()))
                    now, state = ck, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line.encode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.string()), pa.array([h for _, h in done], pa.string())], names=["ck", "repaired_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], names=["ck", "repaired_sha256"])

    return ordered.mapInArrow(run, "ck string, repaired_sha256 string")


COLUMNS = ("conv_id", "turn", "role", "text")


def repaired(df: DataFrame, names: tuple[str, str, str, str] = COLUMNS, damage: bool = True) -> tuple[DataFrame, DataFrame]:
    """Reports, one row per conversation, and the repaired turns ``ck, part, at, sub, role, text``.

    Rows count in the order of their turn (NULL first), rows of one turn by role and text hash; NULL conversations are one.
    Equal rows of one turn count once and then as duplicates. A role counts by its initial, so one of another initial can't be
    kept. Repeated rows, blank rows and long texts need no room of their own: only a byte per row reaches the cost DP, and a
    conversation is cut where Spark's range partitions end, so one of any size is shared by tasks. The pieces meet through
    4 x 4 cost matrices. Without rows after the damage, everything is zero or empty."""
    all_rows = read(df, names)
    hurt = damaged(all_rows if damage else all_rows.withColumn("hit", F.lit(19)))
    rows = stored(placed(judged(stored(hurt, "turns-damaged"))), "turns-placed")
    found = stored(pieces(rows), "turn-pieces")
    chained = stored(cost_chain(found), "turn-costs")
    audited = stored(audits(found, chained), "turn-audits")
    turns = repaired_turns(rows, audited)
    extra = F.when(F.col("fault").isNull() | (F.col("fault") != "blank"), F.col("copies") - 1).otherwise(0)
    counts = rows.groupBy("ck").agg(
        F.sum(F.when(F.col("fault") == "blank", F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("fault") == "duplicate", 1).otherwise(0) + extra).alias("duplicate"),
        F.sum(F.when(F.col("fault") == "truncated", 1).otherwise(0)).alias("truncated"),
    )
    spans = rows.filter("turn IS NOT NULL").select("ck", "turn").distinct().groupBy("ck").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    costs = chained.groupBy("ck").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"))
    joined = audited.groupBy("ck").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "audit"))), lambda p: p["audit"]), "").alias("audit"))
    report = all_rows.groupBy("ck").agg(F.min("conv").alias(names[0]))
    for more in (spans, counts, costs, joined, digests(turns)):
        report = report.join(more.hint("merge"), "ck", "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return report.select(names[0], *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256")), turns
