"""Conversation structure repair: faults, and the cheapest edits that make the roles alternate.

A conversation's rows are taken by turn (nulls first; rows of one turn by role, then text). A row's first fault
counts: blank (no character but white space), duplicate (role and text seen earlier in the
conversation), truncated (its last character that is no white space is none of ``.!?``). Edits: Keep (0),
Rerole to user or assistant (3), Delete (4; blank and duplicate rows must go), Insert an empty user or
assistant row anywhere (3); a truncated row that stays adds 3. The roles left must read
``(s?(ua)+)?`` by their initials. A role is known by its first letter; a row whose role is empty
or begins with another letter is reroled or deleted.

*Persistent audit DP.* The DP runs over the rows from the last to the first with the four states of that pattern
(nothing yet, after s, after u, after a); a state's value is the least cost of what is left and, of the
cheapest edit lists, the one whose initials are least in ASCII. Taken from the end, the first differing
edit decides between two lists whatever comes before it, which is not so from the front (there one
list can begin another). Lists are linked nodes (an edit and the node of the edits after it), so all
states share what they have in common. Each node has its ancestors 2^k edits on and the
rolling hash of the 2^k initials up to there; of two lists of one cost the first difference is found by going 2^k edits
on while the hashes are equal. Two runs of one hash are verified when the later one is made, by
their halves, whose names are exact already; a hash that is taken by another run gets another name.

*Long conversations.* One of at most ``long_rows`` rows is repaired in one step of a task. A longer one is not
gathered: equal rows are added up, all are sorted by ranges, and cut into segments of ``segment`` rows. A segment
gives, for each pair of states, the cheapest edits from one to the other; these are folded from the last segment
to the first, holding one linked list of pieces for each state; then each segment knows its edits.
One string for the audit and one SHA-256 are asked for each conversation, so these are made of its pieces
and rows in order as a stream: the audit's letters are held in a task, its texts are not.

Nulls (damage): one space, for text, role and in the key. A null conv_id is a conversation of its own. Empty
tables give no row. A text is handled whole. Repeated rows are two rows of one turn. Only
the four named columns are read, whatever the others are called.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, scratch_scope

LONG_ROWS = 4096
SEGMENT = 4096
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
_SPACE = " \t\n\x0b\x0c\r"
_FAR = 1 << 60
_MOD = (1 << 61) - 1
_BASE = 0x1F3D5B79A2C4E68 % _MOD
# States of s?(ua)+ by the last role: nothing yet, s, u, a. NEXT[state][role] is the state after it.
_START, _S, _U, _A = range(4)
NEXT = ({"s": _S, "u": _U}, {"u": _U}, {"a": _A}, {"u": _U})
NAMES = {"u": "user", "a": "assistant"}
_ENDS = (0, _FAR, _FAR, 0)  # nothing at all, or after an assistant's row


class Lists:
    """Edit lists as linked nodes; node 0 is the empty list."""

    def __init__(self):
        self.letter, self.size, self.jumps = [""], [0], [()]
        self.made, self.names = {}, {}
        self.power = [_BASE]

    def add(self, letter: str, after: int) -> int:
        node = self.made.get((letter, after))
        if node is not None:
            return node
        node = len(self.letter)
        self.made[letter, after] = node
        self.letter.append(letter)
        self.size.append(self.size[after] + 1)
        # (ancestor 2^k edits on, name of the 2^k initials up to it)
        jumps, at = [(after, ord(letter))], after
        while len(jumps) <= len(self.jumps[at]):
            k = len(jumps) - 1
            ancestor, right = self.jumps[at][k]
            jumps.append((ancestor, self._name(k, jumps[k][1], right)))
            at = ancestor
        self.jumps.append(tuple(jumps))
        return node

    def _name(self, k: int, left: int, right: int) -> int:
        """The rolling hash of two runs of 2^k initials, or the next free number where another pair has it."""
        while len(self.power) <= k:
            self.power.append(self.power[-1] * self.power[-1] % _MOD)
        name = (left * self.power[k] + right) % _MOD
        while self.names.setdefault((k, name), (left, right)) != (left, right):
            name += 1
        return name

    def less(self, a: int, b: int) -> bool:
        """Whether list a comes before list b."""
        while a != b and a and b:
            step = min(len(self.jumps[a]), len(self.jumps[b])) - 1
            while step >= 0 and self.jumps[a][step][1] != self.jumps[b][step][1]:
                step -= 1
            if step < 0:
                return self.letter[a] < self.letter[b]
            a, b = self.jumps[a][step][0], self.jumps[b][step][0]
        return a != b and a == 0

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.jumps[node][0][0]
        return "".join(out)


def _better(lists: Lists, x, y):
    return y if y[0] < x[0] or (y[0] == x[0] < _FAR and lists.less(y[1], x[1])) else x


def _with_inserts(lists: Lists, best: list) -> list:
    def one(state, after):
        return (after[0] + INSERT, lists.add("I", after[1])) if after[0] < _FAR else after

    u, a = best[_U], best[_A]
    best[_U], best[_A] = _better(lists, u, one(_U, a)), _better(lists, a, one(_A, u))
    for state in (_START, _S):
        best[state] = _better(lists, best[state], one(state, best[_U]))
    return best


def solve(rows: list[tuple[str, bool, bool]], lists: Lists, ends=_ENDS) -> list:
    """(cost, list of edits) from each state over all rows (initial, must go, truncated) to the end,
    where a state costs ``ends``."""
    best = _with_inserts(lists, [(c, 0) for c in ends])
    for initial, must_go, cut in reversed(rows):
        now = []
        for state in range(4):
            c, after = best[state]
            value = (c + DELETE, lists.add("D", after)) if c < _FAR else (_FAR, 0)
            if not must_go:
                extra = CUT if cut else 0
                for role, target in NEXT[state].items():
                    c, after = best[target]
                    if c >= _FAR:
                        continue
                    if role == initial:
                        value = _better(lists, value, (c + extra, lists.add("K", after)))
                    if role != "s":
                        value = _better(lists, value, (c + extra + REROLE, lists.add("R", after)))
            now.append(value)
        best = _with_inserts(lists, now)
    return best


def replay(state: int, audit: str, rows):
    """Yield (edit, role, text) of the edits in order, and the state after each; ``rows`` yields (role, text)."""
    rows = iter(rows)
    for edit in audit:
        role, text = next(rows) if edit != "I" else (None, "")
        if edit == "K":
            state = NEXT[state][role[0]]
        elif edit != "D":
            initial = "a" if "a" in NEXT[state] else "u"
            role, state = NAMES[initial], NEXT[state][initial]
        yield edit, role, text, state


def fault(text: str) -> str:
    """blank, truncated or none, from the text alone."""
    end = text.rstrip(_SPACE)
    return "blank" if not end else "" if end[-1] in ".!?" else "truncated"


def _illegal(initials: list[str]) -> int:
    return sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))


def _space(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damage(convs: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` after the damage that crc32 of ``conv_id:turn`` tells."""
    rows = convs.select("conv_id", "turn", _space(F.col("role")).alias("role"), _space(F.col("text")).alias("text"))
    kind = F.crc32(F.concat(_space(F.col("conv_id")), F.lit(":"), _space(F.col("turn"))).cast("binary")) % 20
    rows = rows.withColumn("kind", kind.cast("int")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


#: What a conversation's row holds besides its id.
FIELDS = ["gaps long", "blank long", "duplicate long", "truncated long", "illegal long", "cost long", "audit string",
          "repaired_sha256 string"]


def _repair(rows: list[tuple]) -> tuple:
    """The fields of one conversation's rows (turn, role, text), in order."""
    faults, seen, turns = [], set(), {t for t, _, _ in rows if t is not None}
    for _, role, text in rows:
        kind = fault(text)
        if kind != "blank" and (role, text) in seen:
            kind = "duplicate"
        seen.add((role, text))
        faults.append(kind)
    initials = [role[:1] for _, role, _ in rows]
    lists = Lists()
    cost, node = solve([(i, k in ("blank", "duplicate"), k == "truncated") for i, k in zip(initials, faults)], lists)[_START]
    audit, sha = lists.text(node), hashlib.sha256()
    for i, line in enumerate(_lines(_START, audit, ((r, t) for _, r, t in rows))):
        sha.update(("\n" if i else "").encode() + line)
    gaps = int(max(turns) - min(turns) + 1 - len(turns)) if turns else 0
    return (gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), _illegal(initials), cost, audit,
            sha.hexdigest())


def _lines(state: int, audit: str, rows):
    for edit, role, text, _ in replay(state, audit, rows):
        if edit != "D":
            yield f"{role}:{text}".encode()


def _short(rows: DataFrame) -> DataFrame:
    """One row for each conversation; a task holds one conversation's rows at a time."""
    kind = rows.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), *T._parse_datatype_string(", ".join(FIELDS)).fields])

    def run(batches):
        own, held, out, some, arrow_type = None, [], [], False, None

        def send():
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], type=arrow_type), *[pa.array(c, pa.int64()) for c in cols[1:7]],
                 *[pa.array(c, pa.string()) for c in cols[7:]]], names=["conv_id", *(f.split()[0] for f in FIELDS)])

        for batch in batches:
            arrow_type = batch.schema.field(0).type
            for conv, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if some and conv != own:
                    out.append((own, *_repair(held)))
                    held = []
                    if len(out) >= 4096:
                        yield send()
                        out = []
                own, some = conv, True
                held.append(tuple(row))
        if some:
            out.append((own, *_repair(held)))
            yield send()

    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text"]
    return rows.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions(*order).mapInArrow(
        run, schema)


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _segments(rows: DataFrame, segment: int) -> DataFrame:
    """Written ``(conv_id, part, seg, off, turn, role, text, copies, seen)``: different rows of long
    conversations in order, in segments; seen: role and text were in an earlier turn."""
    rows = materialize(rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies")), "different")
    low = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("low")
    text = [F.xxhash64("role", "text").alias("t1"), F.sha2("text", 256).alias("t2")]
    first = rows.select("conv_id", "turn", "role", *text).groupBy("conv_id", "role", "t1", "t2").agg(
        low, F.count(F.lit(1)).alias("c")).where("c > 1").select(
        F.col("conv_id").alias("c0"), F.col("role").alias("r0"), F.col("t1").alias("x1"), F.col("t2").alias("x2"), "low")
    met = rows.select("*", *text).join(first, _same("conv_id", "c0") & (F.col("role") == F.col("r0"))
                                       & (F.col("t1") == F.col("x1")) & (F.col("t2") == F.col("x2")), "left")
    seen = F.col("low").isNotNull() & ~F.col("low.turn").eqNullSafe(F.col("turn"))
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text"]
    named = ["conv_id", "turn", "role", "text", "copies", "seen"]
    dealt = met.select(*named[:-1], seen.alias("seen")).repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType([*dealt.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("off", T.LongType())])

    def number(batches):
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)),
                                              pa.array(np.arange(at, at + n))], names=[*named, "part", "off"])
            at += n

    placed = dealt.mapInArrow(number, schema)
    return materialize(placed.withColumn("seg", F.expr(f"off div {int(segment)}")), "placed")


def _expanded(table: pa.Table):
    """Of a segment in order: (initial, fault) of every row, copies one after the other."""
    for role, text, copies, seen in zip(*[table.column(c).to_pylist() for c in ("role", "text", "copies", "seen")]):
        kind = fault(text)
        for i in range(copies):
            yield role, text, kind if kind == "blank" else "duplicate" if seen or i else kind


def _long(rows: DataFrame, segment: int) -> DataFrame:
    kind = rows.schema["conv_id"].dataType
    conv = T.StructField("conv_id", kind)
    placed = _segments(rows, segment)
    key = ["conv_id", "part", "seg"]

    def tell(table: pa.Table) -> pa.Table:
        table = table.sort_by("off")
        rows = [(r[:1], k) for r, _, k in _expanded(table)]
        initials, faults = [r for r, _ in rows], [k for _, k in rows]
        lists, ways = Lists(), {}
        given = [(i, k in ("blank", "duplicate"), k == "truncated") for i, k in rows]
        for end in range(4):
            for start, (cost, node) in enumerate(solve(given, lists, [0 if s == end else _FAR for s in range(4)])):
                if cost < _FAR:
                    ways[start, end] = cost, lists.text(node)
        return pa.table({
            "conv_id": table.column("conv_id").slice(0, 1), "part": table.column("part").slice(0, 1),
            "seg": table.column("seg").slice(0, 1),
            **{k: pa.array([faults.count(k)], pa.int64()) for k in ("blank", "duplicate", "truncated")},
            "illegal": pa.array([_illegal(initials)], pa.int64()), "first": [initials[0]], "last": [initials[-1]],
            "ways": pa.array([[{"start": s, "end": e, "cost": c, "edits": x} for (s, e), (c, x) in ways.items()]],
                             pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())])))})

    told = T.StructType([conv, *T._parse_datatype_string(
        "part int, seg long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
        "ways array<struct<start:int,end:int,cost:bigint,edits:string>>").fields])
    summaries = materialize(placed.groupBy(*key).applyInArrow(tell, told), "segments")

    # Fold from the last segment to the first; out comes each segment's piece, in any order.
    def fold(batches):
        own, some, best, before, kind = None, False, None, "", None

        def pieces():
            state, (cost, chain) = _START, best[_START]
            out = []
            while chain is not None:
                (part, seg, extra), edits, end, chain = chain
                out.append((own, part, seg, state, edits, cost, extra))
                state = end
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], type=kind), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.string()), pa.array(cols[5], pa.int64()),
                 pa.array(cols[6], pa.int64())], names=["conv_id", "part", "seg", "state", "edits", "cost", "border"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for row in batch.to_pylist():
                if not some or row["conv_id"] != own:
                    if some:
                        yield pieces()
                    own, some, best, before = row["conv_id"], True, [(c, None) for c in _ENDS], None
                border = int(before is not None and row["last"] + before not in ("su", "ua", "au"))
                before, now = row["first"], [(_FAR, None)] * 4
                place = (row["part"], row["seg"], border)
                for way in row["ways"]:
                    cost, chain = best[way["end"]]
                    if cost < _FAR:
                        new = way["cost"] + cost, (place, way["edits"], way["end"], chain)
                        old = now[way["start"]]
                        if new[0] < old[0] or (new[0] == old[0] and _before(new[1], old[1])):
                            now[way["start"]] = new
                best = now
        if some:
            yield pieces()

    piece = T.StructType([conv, *T._parse_datatype_string(
        "part int, seg long, state int, edits string, cost long, border long").fields])
    dealt = summaries.select("conv_id", "part", "seg", "first", "last", "ways").repartition("conv_id").sortWithinPartitions(
        "conv_id", F.desc("part"), F.desc("seg"))
    pieces = materialize(dealt.mapInArrow(fold, piece), "pieces")

    def edit(key, left: pa.Table, right: pa.Table) -> pa.Table:
        rows = [(r, t) for r, t, _ in _expanded(left.sort_by("off"))]
        one = right.slice(0, 1).to_pylist()[0]
        lines = [x.decode() for x in _lines(one["state"], one["edits"], rows)]
        n = len(lines)
        return pa.table({"conv_id": pa.array([one["conv_id"]] * n, type=right.schema.field("conv_id").type),
                         "part": pa.array([one["part"]] * n, pa.int32()), "seg": pa.array([one["seg"]] * n, pa.int64()),
                         "at": pa.array(range(n), pa.int64()), "line": pa.array(lines, pa.string())})

    line = T.StructType([conv, *T._parse_datatype_string("part int, seg long, at long, line string").fields])
    lines = placed.groupBy(*key).cogroup(pieces.groupBy(*key)).applyInArrow(edit, line)

    def digest(batches):
        own, some, sha, kind = None, False, None, None

        def send():
            return pa.RecordBatch.from_arrays([pa.array([own], type=kind), pa.array([sha.hexdigest()])],
                                              names=["conv_id", "repaired_sha256"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for conv, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if some and conv == own:
                    sha.update(b"\n" + text.encode())
                    continue
                if some:
                    yield send()
                own, some, sha = conv, True, hashlib.sha256(text.encode())
        if some:
            yield send()

    shas = lines.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seg", "at").select("conv_id", "line").mapInArrow(
        digest, T.StructType([conv, T.StructField("repaired_sha256", T.StringType())]))
    audits = pieces.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "seg", "edits"))), lambda x: x["edits"]), "").alias("audit"),
        F.max("cost").alias("cost"), F.sum("border").alias("border"))
    faults = summaries.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    turns = placed.select("conv_id", "turn").distinct().groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    out = faults
    for other in (turns, audits, shas):
        named = other.withColumnRenamed("conv_id", "c0")
        out = out.join(named, _same("conv_id", "c0"), "left").drop("c0")
    empty = hashlib.sha256().hexdigest()
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", (F.col("illegal") + F.col("border")).alias("illegal"),
                      "cost", "audit", F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


def _before(a, b) -> bool:
    """Whether the edits of chain a come before those of chain b; each link has (place, edits, end, next)."""
    x = y = ""
    while True:
        if not x and not y and a is b:
            return False
        if not x and a is not None:
            x, a = a[1], a[3]
            continue
        if not y and b is not None:
            y, b = b[1], b[3]
            continue
        n = min(len(x), len(y))
        if not n:
            return not x and bool(y)
        if x[:n] != y[:n]:
            return x[:n] < y[:n]
        x, y = x[n:], y[n:]


def audit(convs: DataFrame, damaged: DataFrame | None = None, long_rows: int = LONG_ROWS, segment: int = SEGMENT) -> DataFrame:
    """One row for each conv_id of ``convs(conv_id, turn, role, text)``: ``(conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256)`` of its rows in ``damaged`` (where not given: as they
    are, nulls one space). A conversation without rows there has zeros, no edits and the hash of no text.
    ``long_rows`` and ``segment`` choose the route only."""
    if damaged is None:
        damaged = convs.select("conv_id", "turn", _space(F.col("role")).alias("role"), _space(F.col("text")).alias("text"))
    sizes = damaged.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > long_rows)
    sizes, seen = materialize(sizes.select(F.col("conv_id").alias("c1")), "long_conversations", {"n": F.count(F.lit(1))})
    if seen["n"]:
        done = _short(damaged.join(sizes, _same("conv_id", "c1"), "left_anti")).union(
            _long(damaged.join(sizes, _same("conv_id", "c1"), "left_semi"), segment))
    else:
        done = _short(damaged)
    done = done.withColumnRenamed("conv_id", "c0")
    every = convs.select("conv_id").distinct()
    out = every.join(done, _same("conv_id", "c0"), "left")
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
