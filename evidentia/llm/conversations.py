"""Repair of the turn structure of conversations by a checkpointed DP.

A conversation must read ``(s?(ua)+)?`` in role initials. Rows are kept (0),
given the role that the place asks for (1) or deleted (2); turns without text
are inserted (5); a truncated row that stays costs 5 more. Four states say what
the repaired turns so far end in: nothing, system, user, assistant. In each
state one role may follow (at the start also a kept system turn), so an edit
leads to one state and a string of edits names one repair.

Backward costs (the cheapest way from a row and a state to a legal end) are
stored only at checkpoints, one in about the square root of the rows; walking
forward, each stretch between two checkpoints is computed again and the
ASCII-least edit that keeps to the cheapest cost (Delete, Insert, Keep, Rerole)
is emitted.

Spark deals the rows out by ranges of (conversation, turn, role, text), so a
conversation with a third of all rows is spread over many tasks. Each task cuts
its sorted rows into blocks of bounded size. A conversation that lies within
one block is finished there. For the others Spark finds duplicates across
blocks by a grouping, every block gives its costs between states (4 x 4), these
are combined backwards into the costs at the block ends (the checkpoints
between blocks), all blocks walk at once from each state, and the states at
their starts are chained forward. Only these narrow rows, one of 65,536 turns,
meet in one task. The digest of repaired turns is fed block by block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from evidentia.llm.common import BLANKS, stored

#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_NAMES = {_USER: "user", _ASSISTANT: "assistant"}
_FAR = 1 << 60
#: Faults of a row, in the order in which the first one counts.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
FAULTS = {BLANK: "blank", DUPLICATE: "duplicate", TRUNCATED: "truncated"}
#: Bounds of a block: rows, and characters of text.
BLOCK_ROWS, BLOCK_CHARACTERS = 1 << 16, 1 << 24
#: The costs behind the last row: nothing and assistant are legal ends, others need inserted turns.
END = (0, 2 * INSERT, INSERT, 0)


def damage(turns: DataFrame) -> DataFrame:
    """Turns with planted faults: (conv_id, turn, role, text, dropped), one row more for each repeated turn.

    The fault is crc32 of ``conv_id:turn`` modulo 20: 0 dropped (the row stays,
    marked and without text), 1 emptied, 2 without ``[.!?]``, 3 repeated, 4 with
    role user. Nulls are one space, in the key as in role and text.
    """
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *part).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    text = F.when(fault <= 1, F.lit("")).when(fault == 2, F.translate(text, ".!?", "")).otherwise(text)
    rows = turns.select(
        "conv_id",
        "turn",
        F.when(fault == 4, F.lit("user")).otherwise(role).alias("role"),
        text.alias("text"),
        (fault == 0).alias("dropped"),
        F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1).cast("int"))).alias("copy"),
    )
    return rows.drop("copy")


def coded(rows: DataFrame) -> DataFrame:
    """``code`` of each row as the DP sees it: the state its role leads to (0: none) times 4 plus its fault, duplicates apart."""
    initial, last = F.substring("role", 1, 1), F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    state = F.when(initial == "s", _SYSTEM).when(initial == "u", _USER).when(initial == "a", _ASSISTANT).otherwise(_NOTHING)
    fault = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    return rows.withColumn("code", (state * 4 + fault).cast("int"))


# -- the DP over the codes of some rows ---------------------------------------------------------


def _moves(code: int, state: int) -> tuple[tuple[str, int, int], ...]:
    """Edits of a row in a state: (initial, cost, state after), in ASCII order."""
    role, fault = divmod(code, 4)
    moves = [("D", DELETE, state)]
    if fault in (SOUND, TRUNCATED):
        cost = CUT_OFF if fault == TRUNCATED else 0
        if role == _NEXT[state] or (role == _SYSTEM and state == _NOTHING):
            moves.append(("K", cost, role))
        moves.append(("R", cost + REROLE, _NEXT[state]))
    return tuple(moves)


#: What a row may become, by code and state.
MOVES = tuple(tuple(_moves(code, state) for state in range(4)) for code in range(16))


def _before(code: int, after: list[int]) -> list[int]:
    """Costs from each state before a row, given those behind it; turns may be inserted before the row."""
    cost = [min(c + after[to] for _, c, to in MOVES[code][state]) for state in range(4)]
    for state in (_USER, _ASSISTANT, _USER, _SYSTEM, _NOTHING):
        cost[state] = min(cost[state], INSERT + cost[_NEXT[state]])
    return cost


def backward(codes: bytes, end: list[int], step: int) -> list[list[int]]:
    """Costs at every ``step``-th row, from the first to the one behind the last stretch; nothing between."""
    cost, kept = list(end), [list(end)]
    for at in range(len(codes) - 1, -1, -1):
        cost = _before(codes[at], cost)
        if at % step == 0:
            kept.append(cost)
    return kept[::-1]


def walk(codes: bytes, end: list[int], start: int) -> tuple[str, int]:
    """The ASCII-least of the cheapest edits from state ``start``, and the state they lead to."""
    step = max(1, isqrt(len(codes)))
    checkpoints = backward(codes, end, step)
    out, state = [], start
    for number, first in enumerate(range(0, len(codes), step)):
        stretch = codes[first : first + step]
        table = backward(stretch, checkpoints[number + 1], 1)
        for at, code in enumerate(stretch):
            while True:
                left = table[at][state]
                tight = [m for m in MOVES[code][state] if m[1] + table[at + 1][m[2]] == left]
                if (tight and tight[0][0] == "D") or INSERT + table[at][_NEXT[state]] != left:
                    break
                out.append("I")
                state = _NEXT[state]
            edit, _, state = tight[0]
            out.append(edit)
    return "".join(out), state


def closing(state: int) -> str:
    """Turns to insert behind the last row so that the end is legal."""
    return "I" * (END[state] // INSERT)


def costs_between(codes: bytes) -> list[int]:
    """Cheapest cost from each state before the rows to each state behind them, row by row (16 values)."""
    table = [[0 if s == e else _FAR for s in range(4)] for e in range(4)]
    for code in reversed(codes):
        table = [[min(c, _FAR) for c in _before(code, column)] for column in table]
    return [table[e][s] for s in range(4) for e in range(4)]


def repaired(roles: list[str], texts: list[str], audit: str, state: int) -> Iterator[str]:
    """``role:text`` of the turns that the edits leave, in order, from state ``state`` on."""
    at = 0
    for edit in audit:
        if edit == "I":
            state = _NEXT[state]
            yield f"{_NAMES[state]}:"
            continue
        if edit == "K":
            state = _SYSTEM if roles[at][:1] == "s" else _NEXT[state]
            yield f"{roles[at]}:{texts[at]}"
        elif edit == "R":
            state = _NEXT[state]
            yield f"{_NAMES[state]}:{texts[at]}"
        at += 1


def _illegal(pair: str) -> bool:
    return pair not in ("su", "ua", "au")


# -- blocks of sorted rows ----------------------------------------------------------------------

_AT = ("conv_id", "part", "number")


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def _finished(roles: list[str], texts: list[str], turns: list, codes: list[int]) -> dict:
    """Everything about one whole conversation."""
    seen: set[tuple[str, str]] = set()
    for i, row in enumerate(zip(roles, texts)):
        if codes[i] % 4 != BLANK and row in seen:
            codes[i] = codes[i] // 4 * 4 + DUPLICATE
        seen.add(row)
    packed = bytes(codes)
    audit, state = walk(packed, list(END), _NOTHING)
    audit += closing(state)
    given = {t for t in turns if t is not None}
    return {
        "turn_span": max(given) - min(given) + 1 - len(given) if given else 0,
        **{name: sum(c % 4 == fault for c in packed) for fault, name in FAULTS.items()},
        "illegal": _illegal([r[:1] for r in roles]),
        "cost": backward(packed, list(END), max(1, len(packed)))[0][_NOTHING],
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(repaired(roles, texts, audit, _NOTHING)).encode()).hexdigest(),
    }


def _cut(schema: pa.Schema, block_rows: int, block_characters: int):
    """Sorted rows (conv_id, turn, role, text, dropped, code, part) -> finished conversations, and pieces of others.

    A conversation is finished if it begins and ends inside the task and fits a
    block; pieces keep their rows and have no audit.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        roles, texts, turns, codes = [], [], [], []
        key, part, number, size, waiting = None, 0, 0, 0, 0
        begun, first = False, True

        def close(whole: bool) -> None:
            found = _finished(roles, texts, turns, codes) if whole else {"roles": roles, "texts": texts, "turns": turns, "codes": codes}
            out.append({"conv_id": key, "part": part, "number": number} | found)

        def table() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in out], f.type) for f in schema], schema=schema)

        for batch in batches:
            for conv, turn, role, text, dropped, code, task in zip(*(column.to_pylist() for column in batch.columns)):
                another = not begun or conv != key
                if another or len(roles) >= block_rows or size >= block_characters:
                    if begun:
                        close(whole=another and not first and not number)
                        waiting += 0 if another and not first and not number else size
                    first, number = (not begun, 0) if another else (first, number + 1)
                    key, part, begun, size = conv, task, True, 0
                    roles, texts, turns, codes = [], [], [], []
                    if waiting >= block_characters or len(out) >= 5_000:
                        yield table()
                        out, waiting = [], 0
                if not dropped:
                    roles.append(role)
                    texts.append(text)
                    turns.append(turn)
                    codes.append(code)
                    size += len(text)
        if begun:
            close(whole=False)  # it may go on in the next task
            yield table()

    return run


def _per_row(function, kind: str):
    """A vectorised function of some columns, row by row."""
    arrow = to_arrow_type(T._parse_datatype_string(kind))

    @F.arrow_udf(kind)
    def run(*arrays: pa.Array) -> pa.Array:
        return pa.array([function(*row) for row in zip(*(a.to_pylist() for a in arrays))], arrow)

    return run


def _ends(group: pa.Table) -> pa.Table:
    """Costs behind each block of a conversation: those between states, combined from the last block back."""
    group = group.sort_by([("part", "ascending"), ("number", "ascending")])
    ends, cost = [], list(END)
    for between in group["between"].to_pylist()[::-1]:
        ends.append(cost)
        cost = [min(between[4 * s + e] + cost[e] for e in range(4)) for s in range(4)]
    group = group.drop_columns(["between"]).append_column("end", pa.array(ends[::-1], pa.list_(pa.int64())))
    return group.append_column("cost", pa.array([cost[_NOTHING]] * len(ends), pa.int64()))


def _starts(group: pa.Table) -> pa.Table:
    """State at the start of each block, chained from the first on; turns inserted at the end; illegal borders."""
    group = group.sort_by([("part", "ascending"), ("number", "ascending")])
    starts, borders, state, last = [], [], _NOTHING, None
    for to, edge in zip(group["to"].to_pylist(), group["edge"].to_pylist()):
        starts.append(state)
        state = to[state]
        borders.append(_illegal([last, edge[0]]) if edge and last is not None else 0)
        last = edge[-1] if edge else last
    new = {
        "start": pa.array(starts, pa.int32()),
        "tail": pa.array([*[""] * (len(starts) - 1), closing(state)], pa.string()),
        "border": pa.array(borders, pa.int64()),
    }
    for name, values in new.items():
        group = group.append_column(name, values)
    return group.drop_columns(["to", "edge"])


def _digests(key: pa.DataType):
    """(conv_id, lines) sorted by conversation and block -> a digest for each conversation, fed block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha, now, lead = None, None, b""

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"conv_id": pa.array([now], key), "repaired_sha256": pa.array([sha.hexdigest()])})

        for batch in batches:
            for conv, lines in zip(batch["conv_id"].to_pylist(), batch["lines"].to_pylist()):
                if sha is None or conv != now:
                    if sha is not None:
                        yield row()
                    sha, now, lead = hashlib.sha256(), conv, b""
                for line in lines:
                    sha.update(lead + line.encode())
                    lead = b"\n"
        if sha is not None:
            yield row()

    return run


def _joined(left: DataFrame, right: DataFrame, on: tuple[str, ...] = _AT, how: str = "inner") -> DataFrame:
    """A join where null keys meet."""
    match = F.expr(" and ".join(f"l.{c} <=> r.{c}" for c in on))
    rest = [F.col(f"r.{c}") for c in right.columns if c not in on]
    return left.alias("l").join(right.alias("r"), match, how).select("l.*", *rest)


def _across(pieces: DataFrame) -> DataFrame:
    """Conversations in several blocks, or in one that may go on: the columns of finished ones."""
    key = pieces.schema["conv_id"].dataType
    named = f"conv_id {key.simpleString()}"
    at = f"{named}, part int, number long"
    rows = pieces.select(*_AT, F.posexplode(F.arrays_zip("roles", "texts", "turns", "codes")).alias("place", "row"))
    rows = rows.select(*_AT, "place", "row.turns", "row.codes", "row.roles", F.sha2(F.col("row.texts").cast("binary"), 256).alias("sha"))
    # Duplicates: only what occurs twice in a conversation is joined back; AQE splits hot keys of this join.
    here, blank = F.struct("part", "number", "place"), F.col("codes") % 4 == BLANK
    twice = rows.where(~blank).groupBy("conv_id", "roles", "sha").agg(F.min(here).alias("earliest"), F.count("*").alias("m"))
    narrow = _joined(rows, twice.where("m > 1").drop("m"), ("conv_id", "roles", "sha"), "left")
    again = F.coalesce(~blank & (here != F.col("earliest")), F.lit(False))
    code = F.when(again, F.col("codes") - F.col("codes") % 4 + DUPLICATE).otherwise(F.col("codes"))
    narrow = narrow.withColumn("codes", code.cast("int"))
    sequence = F.sort_array(F.collect_list(F.struct("place", "codes"))).getField("codes")
    blocks = _joined(pieces.select(*_AT, "roles"), narrow.groupBy(*_AT).agg(sequence.alias("codes")), how="left")
    blocks = blocks.withColumn("codes", F.coalesce("codes", F.array().cast("array<int>")))
    initials = F.transform("roles", lambda r: F.substring(r, 1, 1))
    inner = _per_row(_illegal, "long")(initials)
    edge = F.filter(F.array(F.get(initials, F.lit(0)), F.get(initials, F.size("roles") - 1)), lambda i: i.isNotNull())
    counts = [F.expr(f"cast(size(filter(codes, c -> c % 4 = {f})) as long)").alias(n) for f, n in FAULTS.items()]
    blocks = stored(blocks.select(*_AT, "codes", edge.alias("edge"), inner.alias("illegal"), *counts))
    # Costs between states of each block, combined backwards; all walks of each block, chained forward.
    between = _per_row(lambda codes: costs_between(bytes(codes)), "array<long>")
    chain = blocks.select(*_AT, between("codes").alias("between"))
    ends = chain.groupBy("conv_id").applyInArrow(_ends, f"{at}, end array<long>, cost long")
    walks = _per_row(lambda codes, end: [dict(zip(("audit", "to"), walk(bytes(codes), end, s))) for s in range(4)], "array<struct<audit:string,to:int>>")
    blocks = _joined(blocks, ends)
    blocks = stored(blocks.withColumn("walks", walks("codes", "end")).drop("codes", "end"))
    chain = blocks.select(*_AT, F.col("walks.to").alias("to"), "edge")
    starts = chain.groupBy("conv_id").applyInArrow(_starts, f"{at}, start int, tail string, border long")
    blocks = _joined(blocks, starts)
    audit = F.concat(F.element_at("walks", F.col("start") + 1).getField("audit"), "tail")
    blocks = stored(blocks.withColumn("audit", audit).drop("walks", "tail", "edge"))
    # Texts meet their edits block by block and stream into the digest of their conversation.
    lines = _per_row(lambda roles, texts, audit, start: list(repaired(roles, texts, audit, start)), "array<string>")
    done = _joined(pieces.select(*_AT, "roles", "texts"), blocks.select(*_AT, "audit", "start"))
    done = done.select(*_AT, lines("roles", "texts", "audit", "start").alias("lines"))
    done = done.repartition("conv_id").sortWithinPartitions(*_AT).select("conv_id", "lines")
    digests = done.mapInArrow(_digests(to_arrow_type(key)), f"{named}, repaired_sha256 string")
    audits = F.sort_array(F.collect_list(F.struct("part", "number", "audit"))).getField("audit")
    sums = blocks.groupBy("conv_id").agg(
        *[F.sum(name).alias(name) for name in FAULTS.values()],
        F.sum(F.col("illegal") + F.col("border")).alias("illegal"),
        F.max("cost").alias("cost"),
        F.array_join(audits, "").alias("audit"),
    )
    span = F.max("turns") - F.min("turns") + 1 - F.count("turns")
    spans = rows.select("conv_id", "turns").distinct().groupBy("conv_id").agg(F.coalesce(span, F.lit(0)).cast("long").alias("turn_span"))
    result = _joined(_joined(sums, digests, ("conv_id",)), spans, ("conv_id",), "left")
    return result.withColumn("turn_span", F.coalesce("turn_span", F.lit(0)))


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS, block_characters: int = BLOCK_CHARACTERS) -> DataFrame:
    """Faults and cheapest repair of each conversation of (conv_id, turn, role, text, dropped).

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost (longs),
    audit and repaired_sha256. Turns go in order, nulls first, equal ones by
    role and text. Rows with ``dropped`` only name their conversation; one
    without other rows has zeros, an empty audit and the digest of nothing.
    Null roles and texts count as one space, null conv_ids are one
    conversation. Equal rows are duplicates of the first one. Further columns
    are ignored; an empty table gives an empty one. The bounds of a block
    change no result.
    """
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], "dropped")
    # Equal rows may lie in any order, so a row number parts even a group of them among tasks.
    spread = (F.substring("text", 1, 32), F.monotonically_increasing_id())
    rows = coded(rows).repartitionByRange("conv_id", "turn", "role", *spread).sortWithinPartitions("conv_id", "turn", "role", "text")
    key = rows.schema["conv_id"].dataType
    schema = T._parse_datatype_string(
        f"conv_id {key.simpleString()}, part int, number long, turn_span long, blank long, duplicate long, truncated long, illegal long, cost long, "
        "audit string, repaired_sha256 string, roles array<string>, texts array<string>, turns array<long>, codes array<int>"
    )
    rows = rows.select("conv_id", "turn", "role", "text", "dropped", "code", F.spark_partition_id().alias("part"))
    cut = stored(rows.mapInArrow(_cut(to_arrow_schema(schema), block_rows, block_characters), schema))
    names = ["conv_id", "turn_span", *FAULTS.values(), "illegal", "cost", "audit", "repaired_sha256"]
    whole = cut.where("audit is not null").select(*names)
    every = whole.unionByName(_across(cut.where("audit is null").select(*_AT, "roles", "texts", "turns", "codes")).select(*names))
    return every.withColumnRenamed("turn_span", "gaps")
