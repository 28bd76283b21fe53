"""Repair of conversations at least cost, by a Viterbi search that runs over chunks of a conversation at once.

Rows of a conversation are ordered by turn (null first); rows of one turn by the digest of role and text. A row's first fault counts: *blank*
(nothing but white space), *duplicate* (its role and text stood before), *truncated* (its last character that is no white space
ends no sentence). The repaired roles are an optional system row and then pairs of user and assistant, or nothing. Edits are
Keep (0), Rerole to user or assistant (1), Delete (2, required for blank and duplicate rows) and Insert an empty user or
assistant row (5); a truncated row that is not deleted adds 5. Of the cheapest edits, those whose initials are least as ASCII
text are taken.

Rows are range-partitioned by conversation and turn and cut into chunks of at most ``chunk_rows`` rows, so a long conversation is many
chunks in many tasks. Costs go backwards: what the rest costs from each of four states. All chunks start at once, those that
are not the end of their conversation from a speculative vector. In fix-up passes a chunk takes the vector of the chunk
behind it and runs again, only until its vectors differ from those of before by a constant (their ranks have converged);
passes are repeated until no vector changes but by a constant. Constants do not change which edits are cheapest, and
their sum is the cost. The edits are then traced forwards in every chunk from each state that it may be entered in; maps from
entries to exits are composed in rounds that double their reach.

Conversations of one chunk, which are nearly all, need none of this but one pass. The hash of a repaired conversation is one
SHA-256 over all of its text, so the chunks of a long one pass through one task at the end, as a stream; its edits are one value.

Null roles and texts are one blank; a null id is a conversation of its own; null turns come first and count for no gap. A role without
initial s, u or a cannot be kept. Rows may repeat. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.shared import drop_stored, numbered, stored, task_count

CHUNK_ROWS = 512
CHUNK_CHARS = 1 << 22

# Costs of edits, sentence ends, white space.
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
ENDS, WHITE = ".!?", " \t\n\x0b\x0c\r"

# States: nothing yet, after a system row, after a user row, after an assistant row. Where the next user or assistant row leads.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
KINDS = {"s": 0, "u": 1, "a": 2}
OTHER = 3
# Where keeping a row of a kind leads from each state.
KEPT = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
LEGAL = {"su", "ua", "au"}

FINE, GONE, CUT = range(3)
Vector = tuple[int, int, int, int]


def _with_inserts(v: Sequence[int]) -> Vector:
    user, assistant = min(v[USER], INSERT + v[ASSISTANT]), min(v[ASSISTANT], INSERT + v[USER])
    return min(v[START], INSERT + user), min(v[SYSTEM], INSERT + user), user, assistant


def levelled(v: Sequence[int]) -> Vector:
    least = min(v)
    return tuple(x - least for x in v)  # type: ignore[return-value]


END = _with_inserts([0, 10**6, 10**6, 0])
SPECULATED = _with_inserts([0, 0, 0, 0])


@lru_cache(maxsize=1 << 16)
def back(after: Vector, code: int) -> Vector:
    """What the rest costs before a row, per state, given that behind it. ``code`` is 3 * kind + fault."""
    kind, fault = divmod(code, 3)
    out = []
    for state in range(4):
        best = DELETE + after[state]
        if fault != GONE:
            extra = TRUNCATED * (fault == CUT)
            best = min(best, REROLE + extra + after[NEXT[state]])
            if (state, kind) in KEPT:
                best = min(best, extra + after[KEPT[state, kind]])
        out.append(best)
    return _with_inserts(out)


@lru_cache(maxsize=1 << 18)
def edits_at(after: Vector, code: int, state: int) -> tuple[str, int]:
    """The least initials among the cheapest edits before and of a row, and the state behind them."""
    before, (kind, fault), letters = back(after, code), divmod(code, 3), ""
    extra = TRUNCATED * (fault == CUT)
    while True:
        cost = before[state]
        if cost == DELETE + after[state]:
            return letters + "D", state
        if cost == INSERT + before[NEXT[state]]:
            letters, state = letters + "I", NEXT[state]
        elif (state, kind) in KEPT and cost == extra + after[KEPT[state, kind]]:
            return letters + "K", KEPT[state, kind]
        else:
            return letters + "R", NEXT[state]


def run_back(codes: bytes, right: Vector) -> Vector:
    """The vector in front of a chunk, given the levelled one behind it."""
    v, total = right, 0
    for code in reversed(codes):
        v = back(v, code)
        if least := min(v):
            total, v = total + least, levelled(v)
    return tuple(x + total for x in v)  # type: ignore[return-value]


def fix_up(codes: bytes, old_right: Vector, old_left: Vector, right: Vector) -> Vector:
    """``run_back`` from a new vector: it ends where the vectors differ from those of the old run by a constant."""
    old, new, ahead = old_right, right, 0  # how much more the new run has added than the old one
    for code in reversed(codes):
        if old == new:
            return tuple(x + ahead for x in old_left)  # type: ignore[return-value]
        old, new = back(old, code), back(new, code)
        ahead += min(new) - min(old)
        old, new = levelled(old), levelled(new)
    if old == new:
        return tuple(x + ahead for x in old_left)  # type: ignore[return-value]
    return run_back(codes, right)


def trace(codes: bytes, right: Vector, state: int, last: bool) -> tuple[list[str], int]:
    """The edits of a chunk entered in a state: initials per row, at the end those behind the last row; and the state left in."""
    behind = [right]
    for code in reversed(codes):
        behind.append(levelled(back(behind[-1], code)))
    letters = []
    for code, after in zip(codes, reversed(behind[:-1]), strict=True):
        found, state = edits_at(after, code, state)
        letters.append(found)
    tail = ""
    while last and state in (SYSTEM, USER):
        tail, state = tail + "I", NEXT[state]
    return [*letters, tail], state


def repaired_lines(rows: list[tuple[str, str]], letters: list[str], state: int) -> list[str]:
    """``role:text`` of the rows that the edits leave or insert."""
    out = []
    for (role, text), edits in zip([*rows, ("", "")], letters, strict=True):
        for edit in edits:
            if edit == "K":
                out.append(f"{role}:{text}")
                state = KEPT[state, KINDS[role[:1]]]
            elif edit in "RI":
                state = NEXT[state]
                out.append(f"{ROLES[state]}:{text if edit == 'R' else ''}")
    return out


def codes_of(rows: list[tuple[str, str]], digests: list[bytes], before: set[bytes]) -> tuple[bytes, list[int]]:
    """One code per row, and how many rows are blank, duplicate and truncated. ``before``: digests of chunks in front."""
    codes, counts, seen = bytearray(), [0, 0, 0], set(before)
    for (role, text), digest in zip(rows, digests, strict=True):
        bare = text.rstrip(WHITE)
        fault = FINE
        if not bare:
            fault, counts[0] = GONE, counts[0] + 1
        elif digest in seen:
            fault, counts[1] = GONE, counts[1] + 1
        elif bare[-1] not in ENDS:
            fault, counts[2] = CUT, counts[2] + 1
        seen.add(digest)
        codes.append(3 * KINDS.get(role[:1], OTHER) + fault)
    return bytes(codes), counts


def _illegal(initials: list[str]) -> int:
    return sum(x + y not in LEGAL for x, y in zip(initials, initials[1:], strict=False))


def _cut(batches: Iterator[pa.RecordBatch], chunk_rows: int, chunk_chars: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Sorted rows as chunks, each with its place and whether its conversation stands in the chunks around it."""
    base, number = TaskContext.get().partitionId() << 33, 0
    rows: list[tuple] = []
    held = chars = 0
    before = None  # whether the open chunk goes on with the conversation of the one in front
    names = ["place", "conv", "joined", "goes_on", "turns", "roles", "texts", "digests"]

    def closed(goes_on: bool | None) -> pa.RecordBatch:
        turns, roles, texts, digests = (list(c) for c in zip(*[r[1:] for r in rows], strict=True))
        values = [base + number, rows[0][0], before, goes_on, turns, roles, texts, b"".join(digests)]
        kinds = [pa.int64(), kind, pa.bool_(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "digest")]
        for row in zip(*columns, strict=True):
            same = bool(rows) and rows[0][0] == row[0]
            if rows and (not same or held >= chunk_rows or chars >= chunk_chars):
                yield closed(same)
                rows, held, chars, before, number = [], 0, 0, same, number + 1
            rows.append(row)
            held, chars = held + 1, chars + len(row[3])
    if rows:
        yield closed(None)


def _rows_of(chunk: dict) -> tuple[list[tuple[str, str]], list[bytes]]:
    digests = chunk["digests"]
    return list(zip(chunk["roles"], chunk["texts"], strict=True)), [digests[i : i + 16] for i in range(0, len(digests), 16)]


def _gaps(turns: list[int | None]) -> int:
    known = {t for t in turns if t is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations of one chunk, in one go."""
    names = ["conv", *(c.split()[0] for c in _COUNTS.split(", "))]
    for batch in batches:
        out = []
        for chunk in batch.select(["turns", "roles", "texts", "digests"]).to_pylist():
            rows, digests = _rows_of(chunk)
            codes, counts = codes_of(rows, digests, set())
            letters, _ = trace(codes, END, START, True)
            text = "\n".join(repaired_lines(rows, letters, START))
            cost = run_back(codes, END)[START]
            illegal = _illegal([role[:1] for role, _ in rows])
            digest = hashlib.sha256(text.encode()).hexdigest()
            out.append((_gaps(chunk["turns"]), *counts, illegal, cost, "".join(letters), digest))
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)] if out else [pa.array([], t) for t in kinds]
        yield pa.RecordBatch.from_arrays([batch.column("conv"), *columns], names)


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Codes, counts and the first, partly speculative, vectors of chunks of longer conversations."""
    for batch in batches:
        out = []
        for chunk in batch.drop_columns(["conv"]).to_pylist():
            rows, digests = _rows_of(chunk)
            codes, counts = codes_of(rows, digests, set(chunk["again"] or ()))
            right = SPECULATED if chunk["goes_on"] else END
            initials = [role[:1] for role, _ in rows]
            known = [t for t in chunk["turns"] if t is not None]
            out.append(
                {
                    "rank": chunk["rank"], "head": chunk["head"], "goes_on": chunk["goes_on"], "joined": chunk["joined"], "codes": codes,
                    "blank": counts[0], "duplicate": counts[1], "truncated": counts[2], "illegal": _illegal(initials),
                    "first_initial": initials[0], "last_initial": initials[-1], "low": min(known, default=None),
                    "high": max(known, default=None), "turns": len(set(known)), "right_side": list(right),
                    "left_side": list(run_back(codes, right)),
                }
            )
        if out:
            yield pa.RecordBatch.from_pylist(out, _arrow(PREPARED))


PREPARED = (
    "rank long, head long, goes_on boolean, joined boolean, codes binary, blank long, duplicate long, truncated long, "
    "illegal long, first_initial string, last_initial string, low long, high long, turns long, right_side array<long>, "
    "left_side array<long>"
)
_ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _ARROW[c.split()[1]]) for c in ddl.split(", ")])


def _levelled(column: str):
    return F.transform(column, lambda x: x - F.array_min(column))


def _converge(vectors: DataFrame) -> DataFrame:
    """Fix-up passes over ``rank, goes_on, codes, right_side, left_side`` until all chunks start from the levelled vector of the
    chunk behind them."""

    def rerun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                old_right, old_left, right = (tuple(r[c]) for c in ("right_side", "left_side", "given"))
                r["left_side"], r["right_side"] = list(fix_up(r["codes"], old_right, old_left, right)), r["given"]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _arrow(kept + ", given array<long>")).drop_columns(["given"])

    kept = "rank long, goes_on boolean, codes binary, right_side array<long>, left_side array<long>"
    names = [c.split()[0] for c in kept.split(", ")]
    vectors = vectors.select(*names)
    passes = []
    while True:
        behind = vectors.select((F.col("rank") - 1).alias("rank"), _levelled("left_side").alias("given"))
        met = vectors.join(behind, "rank", "left")
        open_ = met.filter(F.col("goes_on") & (F.col("given") != F.col("right_side")))
        if open_.isEmpty():
            return vectors
        settled = met.filter(~F.col("goes_on") | (F.col("given") == F.col("right_side"))).select(*names)
        again = open_.select(*names, "given").mapInArrow(rerun, kept)
        vectors = stored(settled.unionByName(again), "conversation-vectors")
        passes.append(vectors)
        if len(passes) > 1:
            drop_stored(passes.pop(0))


def _entries(vectors: DataFrame) -> DataFrame:
    """The state in which every chunk is entered: ``rank``, ``entry``. ``vectors`` has ``rank, joined, goes_on, codes, right_side``."""

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                right = tuple(r["right_side"])
                to = [trace(r["codes"], right, s, not r["goes_on"])[1] for s in range(4)]
                # The first chunk is entered in one state only.
                to = to if r["joined"] else [to[START]] * 4
                out.append({"rank": r["rank"], "exits": to, "reach": r["rank"] - 1 if len(set(to)) > 1 else None})
            if out:
                yield pa.RecordBatch.from_pylist(out, _arrow("rank long, exits array<long>, reach long"))

    maps = stored(vectors.mapInArrow(exits, "rank long, exits array<long>, reach long"), "conversation-exits")
    while not maps.filter("reach is not null").isEmpty():
        front = maps.select(F.col("rank").alias("reach"), F.col("exits").alias("first"), F.col("reach").alias("further"))
        met = maps.join(front, "reach", "left")
        both = F.transform("first", lambda x: F.get("exits", x.cast("int")))
        met = met.select("rank", F.when(F.col("first").isNull(), F.col("exits")).otherwise(both).alias("exits"), "further")
        settled = F.size(F.array_distinct("exits")) == 1
        maps = stored(met.select("rank", "exits", F.when(~settled, F.col("further")).alias("reach")), "conversation-exits")
    left = maps.select((F.col("rank") + 1).alias("rank"), F.get("exits", F.lit(0)).alias("entry"))
    found = vectors.select("rank", "joined").join(left, "rank", "left")
    return found.select("rank", F.when(F.col("joined"), F.col("entry")).otherwise(F.lit(START)).alias("entry"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The traced edits and the repaired text of chunks whose entry and vector are known."""
    for batch in batches:
        out = []
        for chunk in batch.to_pylist():
            rows = list(zip(chunk["roles"], chunk["texts"], strict=True))
            letters, _ = trace(chunk["codes"], tuple(chunk["right_side"]), chunk["entry"], not chunk["goes_on"])
            lines = repaired_lines(rows, letters, chunk["entry"])
            text = "\n".join(lines) if lines else None
            out.append({"head": chunk["head"], "rank": chunk["rank"], "letters": "".join(letters), "repaired": text})
        if out:
            yield pa.RecordBatch.from_pylist(out, _arrow("head long, rank long, letters string, repaired string"))


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits and the hash of every conversation from its sorted pieces, one piece at a time."""
    head, letters, state, lines = None, [], hashlib.sha256(), False

    def closed() -> pa.RecordBatch:
        row = {"head": head, "audit": "".join(letters), "repaired_sha256": state.hexdigest()}
        return pa.RecordBatch.from_pylist([row], _arrow("head long, audit string, repaired_sha256 string"))

    for batch in batches:
        for piece in batch.to_pylist():
            if piece["head"] != head:
                if head is not None:
                    yield closed()
                head, letters, state, lines = piece["head"], [], hashlib.sha256(), False
            letters.append(piece["letters"])
            if piece["repaired"] is not None:
                state.update((("\n" if lines else "") + piece["repaired"]).encode())
                lines = True
    if head is not None:
        yield closed()


def _repair_long(chunks: DataFrame) -> DataFrame:
    """Conversations of several chunks: ``chunks`` are theirs, ranked."""
    spark = chunks.sparkSession
    tasks = task_count(spark)
    heads = stored(chunks.groupBy("conv").agg(F.min("rank").alias("head")), "conversation-heads")
    of = heads.select(F.col("conv").alias("of"), "head")
    keyed = chunks.join(of, F.col("conv").eqNullSafe(F.col("of"))).drop("of")
    # Role and text of a row may have stood in a chunk in front: the first chunk of each digest is found by partial minima.
    starts = F.sequence(F.lit(1), F.octet_length("digests"), F.lit(16))
    stood = keyed.select("head", "rank", F.explode(F.transform(starts, lambda i: F.substring("digests", i, F.lit(16)))).alias("digest"))
    first = stood.groupBy("head", "digest").agg(F.min("rank").alias("first"), F.max("rank").alias("end")).filter("first < end")
    later = stood.join(first.select("head", "digest", "first"), ["head", "digest"]).filter("rank > first")
    again = stored(later.groupBy("rank").agg(F.collect_set("digest").alias("again")), "conversation-repeats")
    prepared = stored(keyed.join(again, "rank", "left").mapInArrow(_prepare, PREPARED), "conversation-codes")

    vectors = _converge(prepared)
    states = vectors.join(prepared.select("rank", "joined", "head"), "rank")
    states = stored(states.join(_entries(states.drop("head")), "rank"), "conversation-states")
    traced = chunks.select("rank", "roles", "texts").join(
        states.select("rank", "head", "codes", "right_side", "goes_on", "entry"), "rank"
    )
    pieces = traced.mapInArrow(_pieces, "head long, rank long, letters string, repaired string")
    streams = pieces.repartition(tasks, "head").sortWithinPartitions("head", "rank")
    texts = streams.mapInArrow(_put_together, "head long, audit string, repaired_sha256 string")

    front = prepared.select((F.col("rank") + 1).alias("rank"), F.col("last_initial").alias("front"), F.col("high").alias("front_high"))
    both = prepared.join(front, "rank", "left").join(states.select("rank", F.col("left_side").alias("costs")), "rank")
    meets = F.col("joined") & ~F.concat("front", "first_initial").isin(*LEGAL)
    shared_turn = F.col("joined") & (F.col("front_high") == F.col("low"))
    counts = both.groupBy("head").agg(
        F.sum("blank").alias("blank"),
        F.sum("duplicate").alias("duplicate"),
        F.sum("truncated").alias("truncated"),
        F.sum(F.col("illegal") + F.when(meets, 1).otherwise(0)).alias("illegal"),
        F.sum(F.when(F.col("joined"), F.array_min("costs")).otherwise(F.get("costs", F.lit(START)))).alias("cost"),
        (F.max("high") - F.min("low") + 1 - F.sum(F.col("turns") - F.when(shared_turn, 1).otherwise(0))).alias("gaps"),
    )
    out = counts.join(texts, "head").join(of, "head")
    return out.select(
        F.col("of").alias("conv"), F.coalesce("gaps", F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal",
        "cost", "audit", "repaired_sha256",
    )


def repair_conversations(
    df: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    chunk_rows: int = CHUNK_ROWS,
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """One row per conversation: its id, ``gaps`` (turns that are missing between the first and the last), ``blank``, ``duplicate``,
    ``truncated``, ``illegal`` (neighbouring roles in an order that is none), ``cost``, ``audit`` (initials of the edits), ``repaired_sha256``
    (of the repaired rows as ``role:text``, joined by line ends)."""
    spark, kind = df.sparkSession, df.schema[conv_col].dataType.simpleString()
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in (role_col, text_col))
    mark = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = df.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        F.substring(F.unhex(mark), 1, 16).alias("digest"), F.monotonically_increasing_id().alias("row"),
    )
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("digest"), F.asc("row")]
    dealt = rows.repartitionByRange(task_count(spark), *order).sortWithinPartitions(*order)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            kind_ = first.schema.field("conv").type
            yield from _cut((b for part in ([first], batches) for b in part), chunk_rows, chunk_chars, kind_)

    chunks = stored(
        dealt.mapInArrow(
            cut,
            f"place long, conv {kind}, joined boolean, goes_on boolean, turns array<long>, roles array<string>, "
            "texts array<string>, digests binary",
        ),
        "conversation-chunks",
    )
    # A task does not know what stands in the next one. The first and the last conversation of each: one row per task.
    part = F.shiftright("place", 33)
    ends = chunks.groupBy(part.alias("part")).agg(
        F.min_by(F.struct("conv"), "place").alias("first"), F.max_by(F.struct("conv"), "place").alias("last")
    )
    over = Window.orderBy("part")
    ends = ends.select(
        "part",
        F.coalesce(F.lag("last").over(over).eqNullSafe(F.col("first")), F.lit(False)).alias("from_front"),
        F.coalesce(F.lead("first").over(over).eqNullSafe(F.col("last")), F.lit(False)).alias("to_next"),
    )
    known = numbered(chunks).join(F.broadcast(ends), part == F.col("part"))
    known = known.withColumns(
        {"joined": F.coalesce("joined", "from_front"), "goes_on": F.coalesce("goes_on", "to_next")}
    ).drop("part", "from_front", "to_next", "place")
    alone = ~F.col("joined") & ~F.col("goes_on")
    out = known.filter(alone).select("conv", "turns", "roles", "texts", "digests").mapInArrow(_whole, f"conv {kind}, {_COUNTS}")
    longer = known.filter(~alone)
    if not longer.isEmpty():
        out = out.unionByName(_repair_long(longer))
    return out.withColumnRenamed("conv", conv_col)


def damage(df: DataFrame) -> DataFrame:
    """Rows of ``conv_id, turn, role, text`` with faults put in, by the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1
    empties its text, 2 takes the ends of its sentences, 3 repeats it, 4 makes it the user's. Nulls in what is read are one blank."""
    blank = F.lit(" ")
    mark = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    fault = (F.crc32(mark.cast("binary")) % 20).cast("int")
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    faulty = df.select(
        "conv_id",
        "turn",
        F.when(fault == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        fault.alias("fault"),
    ).filter("fault != 0")
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return faulty.select("conv_id", "turn", "role", "text", copies.alias("copy")).drop("copy")


def repair_damaged(df: DataFrame, **options) -> DataFrame:
    """``repair_conversations`` of the damaged rows, with a row for every conversation of ``df``, also where none of its rows are left."""
    ids = df.select(F.col("conv_id").alias("of")).distinct()
    found = repair_conversations(damage(df), **options)
    out = ids.join(found, F.col("of").eqNullSafe(F.col("conv_id")), "left")
    zeros = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.col("of").alias("conv_id"),
        *[v.alias(c) for c, v in zeros.items()],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
