"""Operator 11: conversation structure repair by iterative-deepening A*.

A conversation should read ``(s?(ua)+)?`` in role initials: an optional system
message, then pairs of user and assistant. Each row is kept (K, 0), given the role
that is due (R, 3) or deleted (D, 4: always for blank and repeated rows); an empty
message of the role that is due can be inserted anywhere (I, 3); a truncated row that
stays costs 3 more. The audit is the cheapest sequence of edits, the ASCII-least of
equally cheap ones.

Search: depth first over (row, state) in the order D, I, K, R under a cost bound that
rises to the least cost the last try left open. The transposition table keeps for
every failed (row, state) the least cost it still needs: a bound below that fails at
once, in later tries too. The first accepting path is the answer.

Long conversations are cut: rows are range-partitioned by their whole order, so one
conversation may fill many partitions, and searched ``BLOCK`` rows at a time. A block
has a cheapest path from each state to each state. No such path of a block is the start
of another one (all end with the same number of row edits), so the cheapest and least
audit of the conversation is the chain of the blocks' least paths: 16 costs and ranks a
block decide it, in one pass from the end and one from the start. What is not cut is
the digest: a sha256 reads one text from start to end, so a conversation's texts pass
through one task, as a stream of sorted rows that holds one block's audit and no text.

Defined results: nulls in role and text are one space; a null conv_id is a conversation.
Rows go by turn (nulls first), then role, then sha256 of the text, so ties and repeated
rows have one order. A role that starts with none of s, u, a (an empty one too) cannot be
kept. Equal rows are counted before any shuffle. Conversations without rows give zeros,
an empty audit and the hash of nothing. Columns other than the four are not read.
"""

from __future__ import annotations

import hashlib
from collections import deque

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerlake.llm.scratch import stored

BLOCK = 128  # rows that one search takes
BLANKS = " \t\n\x0b\x0c\r"
NEVER = 1 << 30
START, SYSTEM, USER, ASSISTANT = range(4)  # what was said last
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
END = ((0, ""), (6, "II"), (3, "I"), (0, ""))  # what completes a conversation that stops in a state
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
SOUND, TRUNCATED, GONE = range(3)


def messages(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies (1) without nulls in role and text."""
    return conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                                F.coalesce("text", F.lit(" ")).alias("text"), F.lit(1).alias("copies"))


def damage(conversations: DataFrame) -> DataFrame:
    """``messages`` with one row in four damaged, as crc32 of conv_id:turn modulo 20 says:
    0 drops it, 1 empties its text, 2 removes its [.!?], 3 repeats it, 4 makes it the user's."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = (F.crc32(key.cast("binary")) % 20).cast("int")
    rows = messages(conversations).withColumn("kind", kind)
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
        .alias("text"), F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


def _marked(rows: DataFrame) -> DataFrame:
    """With mark (first 16 bytes of the text's sha256), blank and truncated."""
    body = F.rtrim("text", F.lit(BLANKS))
    return rows.select("*", F.unhex(F.left(F.sha2("text", 256), F.lit(32))).alias("mark"), (body == "").alias("blank"),
                       (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("truncated"))


def search(codes: bytes, goal: int, entries) -> dict[int, tuple[int, str]]:
    """{entry state: (cost, least of the cheapest paths)} over the rows ``codes`` (state that the role
    leads to, or 0, + 4 * fault) to the state ``goal``. The last row's edit ends the path."""
    n = len(codes)
    least = [0] * (4 * n + 4)  # admissible: what the rows need whatever the state, then what failed tries have shown
    for i in range(n - 1, -1, -1):
        role, fault = codes[i] & 3, codes[i] >> 2
        own = 4 if fault == GONE else 3 * (fault == TRUNCATED) + 3 * (role == 0)
        least[4 * i:4 * i + 4] = [least[4 * i + 4] + min(own, 4)] * 4
    for s in range(4):
        if s != goal:
            least[4 * n + s] = NEVER
    if goal < USER:  # once a user or an assistant spoke, only they can have spoken last
        opens = False
        for i in range(n, -1, -1):
            opens |= i < n and codes[i] == SYSTEM or i < n and codes[i] == SYSTEM + 4 * TRUNCATED
            least[4 * i + USER] = least[4 * i + ASSISTANT] = NEVER
            least[4 * i + (START if goal == SYSTEM else SYSTEM)] = NEVER
            if goal == SYSTEM and opens and i < n:
                least[4 * i + START] = least[4 * i + SYSTEM]
    path: list[str] = []

    def moves(i, s):
        role, fault = codes[i] & 3, codes[i] >> 2
        after, due = 4 * i + 4, NEXT[s]
        yield "D", i + 1, s, 4, after + s
        yield "I", i, due, 3, 4 * i + due
        if fault != GONE:
            if role == due or role == SYSTEM and s == START:
                yield "K", i + 1, role, 3 * fault, after + role
            if role != due:
                yield "R", i + 1, due, 3 + 3 * fault, after + due

    def down(i, s, left) -> bool:
        if i == n:
            return True
        lowest = NEVER
        for edit, j, t, cost, at in moves(i, s):
            if cost + least[at] <= left:
                path.append(edit)
                if down(j, t, left - cost):
                    return True
                path.pop()
            lowest = min(lowest, cost + least[at])
        least[4 * i + s] = max(least[4 * i + s], lowest)
        return False

    found = {}
    for s in entries:
        path.clear()
        while (bound := least[s]) < NEVER:
            if down(0, s, bound):
                found[s] = (bound, "".join(path))
                break
    return found


def _block(codes: bytes, entries) -> tuple[list[int], list[int], list[str]]:
    """(costs, ranks, paths) by 4 * entry + exit; ranks order the paths of one entry."""
    costs, ranks, paths = [NEVER] * 16, [0] * 16, [""] * 16
    for goal in range(4):
        for s, (cost, path) in search(codes, goal, entries).items():
            costs[4 * s + goal], paths[4 * s + goal] = cost, path
    for s in entries:
        for k, goal in enumerate(sorted(range(4), key=lambda g: paths[4 * s + g])):
            ranks[4 * s + goal] = k
    return costs, ranks, paths


_BLOCK = ("conv_id {0}, turn {1}, role string, mark binary, part int, seq long, blank long, duplicate long, truncated long, "
          "costs array<int>, ranks array<int>, paths array<string>")


_PICKS = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("pick", pa.int32()), ("ending", pa.string())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _cut(schema: pa.Schema):
    """Sorted rows to blocks."""
    def cut(batches):
        part, seq = TaskContext.get().partitionId(), 0
        out: list = []
        conv, first, any_row, codes, head, counts = None, True, False, bytearray(), None, [0, 0, 0]
        known = False  # the conversation's first row is in this partition
        started = False

        def close():
            nonlocal seq, codes, counts, known, any_row
            costs, ranks, paths = _block(bytes(codes), [START] if known else range(4))
            out.append((conv, *head, part, seq, *counts, costs, ranks, paths))
            seq += 1
            any_row, known, codes, counts = True, False, bytearray(), [0, 0, 0]

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in
                             ("conv_id", "turn", "role", "mark", "n", "blank", "truncated", "earlier"))):
                cid, turn, role, mark, n, blank, truncated, earlier = row
                if not started or cid != conv:
                    if started and (codes or not any_row):
                        close()
                    known, started, conv, any_row, head = started, True, cid, False, (turn, role, mark)
                for k in range(n):
                    if not codes:
                        head = (turn, role, mark)
                    fault = GONE if blank or earlier or k else TRUNCATED if truncated else SOUND
                    counts[0 if blank else 1 if fault == GONE else 2] += fault != SOUND
                    codes.append(INITIALS.get(role[:1], 0) + 4 * fault)
                    if len(codes) == BLOCK:
                        close()
                if len(out) >= 2000:
                    yield _batch(out, schema)
                    out = []
        if started and (codes or not any_row):
            close()
        if out:
            yield _batch(out, schema)
    return cut


def _chain(batches):
    """Blocks of conversations in order (16 costs and ranks each) to the path that each contributes."""
    def solved(blocks):
        tail, tails = [c for c, _ in END], []
        for _, _, costs, _ in reversed(blocks):
            tails.append(tail)
            tail = [min(costs[4 * s + t] + tail[t] for t in range(4)) for s in range(4)]
        state = START
        for k, ((part, seq, costs, ranks), tail) in enumerate(zip(blocks, reversed(tails))):
            t = min(range(4), key=lambda t: (costs[4 * state + t] + tail[t], ranks[4 * state + t]))
            yield part, seq, 4 * state + t, END[t][1] if k + 1 == len(blocks) else ""
            state = t

    conv, blocks, out = None, [], []
    for batch in batches:
        for cid, *block in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "part", "seq", "costs", "ranks"))):
            if blocks and cid != conv:
                out.extend(solved(blocks))
                blocks = []
            conv = cid
            blocks.append(block)
            if len(out) >= 20_000:
                yield _batch(out, _PICKS)
                out = []
    out.extend(solved(blocks))
    if out:
        yield _batch(out, _PICKS)


def plan_edits(rows: DataFrame) -> DataFrame:
    """The blocks of all conversations with their part of the audit and their counts of faults.
    rows: conv_id, turn, role, text, copies as ``messages`` or ``damage`` give them."""
    spark = rows.sparkSession
    kinds = [rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn")]
    light = (_marked(rows).groupBy("conv_id", "turn", "role", "mark", "blank", "truncated")
             .agg(F.sum("copies").alias("n")))
    light = stored(light, "messages")
    place = F.struct(F.col("turn").isNotNull().alias("set"), F.col("turn").alias("turn"))
    said = (light.filter("n > 0 AND NOT blank").groupBy("conv_id", "role", "mark").agg(F.min(place).alias("first"), F.count("*").alias("k"))
            .filter("k > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("mark").alias("m"), "first"))
    rows = light.join(said, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("mark") == F.col("m")), "left")
    order = ("conv_id", "turn", "role", "mark")
    rows = rows.select(*order, "n", "blank", "truncated",
                       F.coalesce(place > F.col("first"), F.lit(False)).alias("earlier"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = T.StructType.fromDDL(_BLOCK.format(*kinds))
    blocks = stored(ordered.mapInArrow(_cut(to_arrow_schema(schema)), schema), "blocks")
    picks = (blocks.select("conv_id", "part", "seq", "costs", "ranks").repartition("conv_id")
             .sortWithinPartitions("conv_id", "part", "seq").mapInArrow(_chain, "part int, seq long, pick int, ending string"))
    return (blocks.join(picks, ["part", "seq"])
            .select("conv_id", "turn", "role", "mark", "part", "seq", "blank", "duplicate", "truncated",
                    F.concat(F.get("paths", F.col("pick")), "ending").alias("path")))


def _stream(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """Messages and the blocks' edits of a conversation side by side, in order."""
    texts = _marked(rows.filter("copies > 0")).select(
        "conv_id", "turn", "role", "mark", F.lit(1).alias("kind"), F.lit(None).cast("int").alias("part"),
        F.lit(None).cast("long").alias("seq"), "text", "copies", F.col("truncated").cast("long").alias("truncated"),
        F.lit(0).cast("long").alias("blank"), F.lit(0).cast("long").alias("duplicate"))
    plans = edits.select("conv_id", "turn", "role", "mark", F.lit(0).alias("kind"), "part", "seq", F.col("path").alias("text"),
                         F.lit(0).alias("copies"), "truncated", "blank", "duplicate")
    order = ("conv_id", "turn", "role", "mark", "kind", "part", "seq")
    return texts.unionByName(plans).repartition("conv_id").sortWithinPartitions(*order).drop("mark", "part", "seq")


class _Conversation:
    """Applies the edits of one conversation to its rows as they come."""

    def __init__(self):
        self.paths, self.at, self.state = deque(), 0, START

    def _edit(self, inserts_only=False) -> str | None:
        while self.paths and self.at == len(self.paths[0]):
            self.paths.popleft()
            self.at = 0
        if not self.paths or inserts_only and self.paths[0][self.at] != "I":
            return None
        self.at += 1
        return self.paths[0][self.at - 1]

    def inserted(self):
        """(edit, role, text) of the messages inserted next."""
        while self._edit(inserts_only=True):
            self.state = NEXT[self.state]
            yield "I", NAMES[self.state], ""

    def row(self, role: str, text: str):
        """Of the messages inserted before a row, and of the row itself (role None: deleted)."""
        yield from self.inserted()
        edit = self._edit()
        if edit == "R":
            self.state = NEXT[self.state]
            role = NAMES[self.state]
        elif edit == "K":
            self.state = INITIALS[role[0]]
        else:
            role = None
        yield edit, role, text


def _conversations(batches):
    """(conv_id, event, values): "start"; "plan" counts; "row" turn, role, truncated; "edit" edit, role, text, turn,
    truncated; "end"."""
    conv, now = None, None
    for batch in batches:
        for cid, turn, role, kind, text, copies, truncated, blank, duplicate in zip(*(batch.column(c).to_pylist() for c in (
                "conv_id", "turn", "role", "kind", "text", "copies", "truncated", "blank", "duplicate"))):
            if now is None or cid != conv:
                if now:
                    for e in now.inserted():
                        yield conv, "edit", (*e, None, 0)
                    yield conv, "end", ()
                conv, now = cid, _Conversation()
                yield conv, "start", ()
            if kind == 0:
                now.paths.append(text)
                yield conv, "plan", (blank, duplicate, truncated)
            for _ in range(copies):
                yield conv, "row", (turn, role)
                for e in now.row(role, text):
                    yield conv, "edit", (*e, None if e[0] == "I" else turn, truncated)
    if now:
        for e in now.inserted():
            yield conv, "edit", (*e, None, 0)
        yield conv, "end", ()


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired messages: conv_id, place (from 0), turn (null: inserted), edit, role, text."""
    edits = plan_edits(rows)
    schema = T.StructType.fromDDL("conv_id {}, place long, turn {}, edit string, role string, text string".format(
        *(rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))))
    shape = to_arrow_schema(schema)

    def replay(batches):
        out, place, size = [], 0, 0
        for conv, what, x in _conversations(batches):
            if what == "start":
                place = 0
            elif what == "edit" and x[1] is not None:
                out.append((conv, place, x[3], x[0], x[1], x[2]))
                place, size = place + 1, size + len(x[2])
                if len(out) >= 10_000 or size >= 4_000_000:
                    yield _batch(out, shape)
                    out, size = [], 0
        if out:
            yield _batch(out, shape)

    return _stream(rows, edits).mapInArrow(replay, schema)


def audits(rows: DataFrame) -> DataFrame:
    """Per conversation: gaps, faults, illegal neighbours, cost, audit and repaired_sha256."""
    edits = plan_edits(rows)
    schema = T.StructType.fromDDL(
        "conv_id {}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
        "repaired_sha256 string".format(rows.schema["conv_id"].dataType.simpleString()))
    shape = to_arrow_schema(schema)
    price = {"D": 4, "I": 3, "K": 0, "R": 3}

    def digest(batches):
        out, held = [], 0
        for conv, what, x in _conversations(batches):
            if what == "start":
                low = high = last = initial = None
                distinct = illegal = cost = 0
                faults, audit, sha, said = [0, 0, 0], [], hashlib.sha256(), False
            elif what == "plan":
                faults = [a + b for a, b in zip(faults, x)]
            elif what == "row":
                turn, role = x
                if turn is not None and turn != last:
                    low, high, last, distinct = turn if low is None else low, turn, turn, distinct + 1
                illegal += initial is not None and initial + role[:1] not in ("su", "ua", "au")
                initial = role[:1]
            elif what == "edit":
                edit, role, text, _, cut = x
                audit.append(edit)
                cost += price[edit]
                if role is not None:
                    cost += 3 * cut * (edit != "I")
                    sha.update(f"{chr(10) * said}{role}:{text}".encode())
                    said = True
            else:
                gaps = 0 if low is None else high - low + 1 - distinct
                audit = "".join(audit)
                out.append((conv, gaps, *faults, illegal, cost, audit, sha.hexdigest()))
                held += len(audit)
                if len(out) >= 5000 or held >= 4_000_000:
                    yield _batch(out, shape)
                    out, held = [], 0
        if out:
            yield _batch(out, shape)

    return _stream(rows, edits).mapInArrow(digest, schema)
