"""Conversation repair: the cheapest edits that make the turns of a conversation alternate.

The turns are aligned to the strings of the grammar ``(s?(ua)+)?`` by a Wagner-Fischer table
(rows: turns, columns: places of the target).  All targets without and all targets with a
leading ``s`` are prefixes of one string, so one table per kind holds every feasible length:
its last line says which columns end a target.  A quick left-to-right repair gives an
incumbent cost; what it leaves above the unavoidable edits bounds how far a path can stray
from the diagonal, and only that band is filled (Ukkonen).  The lines are filled from the
last turn back, each cell keeping the ASCII-least letter of a cheapest rest, so walking from
the first cell writes the least audit of its kind; the audits of both kinds are compared.
Targets repeat every two places, so columns two apart have equal rests: where a band would
exceed ``CELLS``, the table is folded onto four columns, with equal results in linear time.

On Spark: the damage, the faults and the digests are built-in expressions.  One shuffle of
(conversation, turn, role, digest, code) sorts the turns, first by text to mark repeats, then
by turn; tasks stream them and keep a byte per turn of one conversation.  A second shuffle
puts every conversation's audit before its turns, whose texts are hashed as they pass.  No
task holds the texts of a conversation.  The repaired digest is one sequential hash, so a
conversation is read by one task, however long it is.

Defined results: null roles and texts, and null ids and turns inside the damage key, are one
space; a null conv_id is a conversation of its own; turns of one number are ordered by role,
then by the SHA-256 of their text; an empty role counts as no known role; a conversation without
turns after the damage gives zeros and the digest of the empty text; an empty table gives no
rows; other columns are not read; long texts are taken whole."""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULE = 20                               # one damage per residue 0 to 4
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
CELLS = 1 << 20
_SPACES = " \t\n\x0b\x0c\r"
_INITIAL, _SHORT, _BLANK, _AGAIN = 3, 4, 8, 16       # of a turn's code: initial (0 none, 1 s, 2 u, 3 a) and its first fault
_FORCED = _BLANK | _AGAIN
_NAMES = {2: "user", 3: "assistant"}
_INF = 1 << 60


# --- alignment of one conversation ------------------------------------------------------
def incumbent(codes: bytes) -> int:
    """The cost of a quick repair: on a clash, insert the missing turn or change this one, by the next turn."""
    free = [c for c in codes if not c & _FORCED]
    cost, want, out = 0, 2, 0
    for k, c in enumerate(free):
        sym = c & _INITIAL
        if sym == want:
            want = 5 - want
        elif not (sym == 1 and not out):
            cost += REROLE
            if sym < 2 or k + 1 < len(free) and free[k + 1] & _INITIAL == sym:
                want = 5 - want                                  # changed
        out += 1
    if want == 3:
        cost += INSERT
    elif out == 1 and free[0] & _INITIAL == 1:
        cost += 2 * INSERT
    return min(_unavoidable(codes) + cost, DELETE * len(codes))


def _unavoidable(codes: bytes) -> int:
    return sum(DELETE if c & _FORCED else TRUNCATED if c & _SHORT else 0 for c in codes)


def _symbol(j: int, lead: int) -> int:
    return 1 if j < lead else 2 + (j - lead) % 2


def _ends(j: int, lead: int) -> bool:
    return j >= 3 and j % 2 == 1 if lead else j % 2 == 0


def _best(code: int, symbol: int, drop: int, insert: int, match: int) -> tuple[int, int]:
    """The least cost of a cell and its letter, from the costs of the cells behind; ties by letter."""
    best, letter = drop + DELETE, 68                             # D
    if symbol > 1 and insert + INSERT < best:
        best, letter = insert + INSERT, 73                       # I
    if not code & _FORCED:
        extra = TRUNCATED if code & _SHORT else 0
        if code & _INITIAL == symbol:
            if match + extra < best:
                best, letter = match + extra, 75                 # K
        elif symbol > 1 and match + REROLE + extra < best:
            best, letter = match + REROLE + extra, 82            # R
    return best, letter


def band(codes: bytes, bound: int) -> tuple[int, int]:
    """How far a path of cost ``bound`` can lie below and above the diagonal of turns that may stay."""
    spare = bound - _unavoidable(codes)
    cheap = sum(c & (_SHORT | _FORCED) == _SHORT for c in codes)      # deleting these costs one more only
    return (spare if spare <= cheap else cheap + (spare - cheap) // DELETE), spare // INSERT


def align(codes: bytes, lead: int, below: int, above: int) -> tuple[int, str]:
    """``(cost, audit)`` for the targets with (1) or without (0) a leading ``s``, inside the band."""
    n, width = len(codes), below + above + 1
    base = sum(not c & _FORCED for c in codes) - below           # the target place of a line's first cell
    line = [_INF] * (width + 1)
    letters = [bytearray(width)]
    for b in range(width - 1, -1, -1):
        j = base + b
        if j >= 0:
            if _ends(j, lead):
                line[b] = 0
            elif _symbol(j, lead) > 1 and line[b + 1] < _INF:
                line[b], letters[0][b] = line[b + 1] + INSERT, 73
    for code in reversed(codes):
        moved = 0 if code & _FORCED else 1
        base -= moved
        behind, line, row = line, [_INF] * (width + 1), bytearray(width)
        for b in range(width - 1, max(0, -base) - 1, -1):
            drop = behind[b - moved] if b >= moved else _INF
            line[b], row[b] = _best(code, _symbol(base + b, lead), drop, line[b + 1], behind[b])
        letters.append(row)
    cost = line[below]
    if cost >= _INF:
        return _INF, ""
    audit, i, j, base = bytearray(), n, 0, -below
    while letters[i][j - base]:
        step = letters[i][j - base]
        audit.append(step)
        if step != 73:
            base += not codes[n - i] & _FORCED
            i -= 1
        j += step != 68
    return cost, audit.decode()


def fold(codes: bytes) -> tuple[int, str]:
    """``(cost, audit)`` over all targets on four columns: nothing, ``s``, a ``u`` or an ``a`` written last."""
    after = {0: (2, 2), 1: (2, 2), 2: (3, 3), 3: (2, 2)}         # column -> (symbol, column) that follows
    line = [0, 2 * INSERT, INSERT, 0]
    letters = [bytearray((0, 73, 73, 0))]
    for code in reversed(codes):
        behind, line, row = line, [_INF] * 4, bytearray(4)
        for _ in range(2):                                       # inserts go round the columns, twice at most
            for at, (symbol, to) in after.items():
                line[at], row[at] = _best(code, symbol, behind[at], line[to], behind[to])
        if code & _INITIAL == 1 and not code & _FORCED:          # the leading s can only be kept
            cost = behind[1] + (TRUNCATED if code & _SHORT else 0)
            if cost < line[0] or cost == line[0] and row[0] > 75:
                line[0], row[0] = cost, 76                       # L: kept as the lead
        letters.append(row)
    audit, i, at, n = bytearray(), len(codes), 0, len(codes)
    while letters[i][at]:
        step = letters[i][at]
        audit.append(75 if step == 76 else step)
        if step != 68:
            at = 1 if step == 76 else after[at][1]
        i -= step != 73
    return line[0], audit.decode()


def repair(codes: bytes, cells: int = CELLS) -> tuple[int, str]:
    """The least cost and, among its audits, the ASCII-least."""
    below, above = band(codes, incumbent(codes))
    if (len(codes) + 1) * (below + above + 1) > cells:
        return fold(codes)
    found = [align(codes, 0, below, above)]
    if any(c & _INITIAL == 1 and not c & _FORCED for c in codes):
        found.append(align(codes, 1, below, above))
    return min(found)


# --- Spark --------------------------------------------------------------------------------
def damaged(conversations: DataFrame) -> DataFrame:
    """The turns after the damage of the contract; of a dropped turn its conversation stays, as ``gone``."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))     # noqa: E731
    rule = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % RULE
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), rule.alias("rule"))
    changed = F.when(F.col("rule").isin(0, 1), "").when(F.col("rule") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("rule") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", F.when(F.col("rule") == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"),
                       (F.col("rule") == 0).alias("gone"), F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).drop("copy")


def untouched(conversations: DataFrame) -> DataFrame:
    """The turns as they are, in the shape of ``damaged``."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))     # noqa: E731
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), F.lit(False).alias("gone"))


def _coded(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, code)`` per turn, in order inside each conversation; code -1 for a dropped turn."""
    seen = F.rtrim(F.col("text"), F.lit(_SPACES))
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 1).when(first == "u", 2).when(first == "a", 3).otherwise(0)
    fault = F.when(seen == "", _BLANK).when(~F.substring(seen, -1, 1).isin(".", "!", "?"), _SHORT).otherwise(0)
    rows = turns.select("conv_id", "turn", "role", _digest().alias("digest"), initial.alias("initial"), fault.alias("fault"), "gone")
    from pyspark.sql import Window
    same = Window.partitionBy("conv_id", "gone", "role", "digest").orderBy("turn")
    code: Column = F.col("initial") + F.when(F.col("fault") == _BLANK, _BLANK).when(F.col("nth") > 1, _AGAIN).otherwise(F.col("fault"))
    rows = rows.repartition("conv_id").withColumn("nth", F.row_number().over(same))
    rows = rows.select("conv_id", "turn", "role", "digest", F.when(F.col("gone"), -1).otherwise(code).alias("code"))
    return rows.sortWithinPartitions("conv_id", "turn", "role", "digest").select("conv_id", "turn", "code")


def _digest() -> Column:
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256))


class _Conversation:
    """What a task keeps of the conversation it reads."""

    def __init__(self, conv_id):
        self.conv_id, self.codes, self.illegal = conv_id, bytearray(), 0
        self.low = self.high = None
        self.turns = 0

    def add(self, turn, code: int) -> None:
        if code < 0:
            return
        if turn is not None:
            if self.low is None:
                self.low = turn
            self.turns += turn != self.high
            self.high = turn
        if self.codes and (self.codes[-1] & _INITIAL, code & _INITIAL) not in ((1, 2), (2, 3), (3, 2)):
            self.illegal += 1
        self.codes.append(code)

    def row(self) -> tuple:
        codes = bytes(self.codes)
        cost, audit = repair(codes)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        faults = [sum(c & bit > 0 for c in codes) for bit in (_BLANK, _AGAIN, _SHORT)]
        return (self.conv_id, gaps, *faults, self.illegal, cost, audit)


def _blocks(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows in batches of at most ``size`` rows or about a million letters of their last column."""
    held, letters = [], 0
    for row in rows:
        held.append(row)
        letters += len(row[-1])
        if len(held) >= size or letters >= 1 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, letters = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def audits(turns: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)`` per conversation of ``turns``."""
    id_type = turns.schema["conv_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None

        def rows(batches):
            now = None
            for batch in batches:
                for conv_id, turn, code in zip(*[c.to_pylist() for c in batch.columns]):
                    if now is None or conv_id != now.conv_id:
                        if now is not None:
                            yield now.row()
                        now = _Conversation(conv_id)
                    now.add(turn, code)
            if now is not None:
                yield now.row()

        batches = iter(batches)
        for head in batches:
            schema = pa.schema([("conv_id", head.schema.field(0).type), *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string())])
            yield from _blocks(rows(_chain(head, batches)), schema)

    counts = ", ".join(f"{c} long" for c in _COUNTS)
    return _coded(turns).mapInArrow(read, f"conv_id {id_type}, {counts}, audit string")


def _chain(head, rest):
    yield head
    yield from rest


class _Repaired:
    """The hash of the repaired conversation, fed turn by turn."""

    def __init__(self, found: tuple):
        self.found, self.audit = found, found[-1]
        self.hash, self.at, self.last, self.any = hashlib.sha256(), 0, 0, False

    def _write(self, role: str, text: str) -> None:
        self.hash.update(("\n" * self.any + role + ":").encode("utf-8", "surrogatepass"))
        self.hash.update(text.encode("utf-8", "surrogatepass"))
        self.any = True

    def _next(self) -> str:
        self.last = 3 if self.last == 2 else 2
        return _NAMES[self.last]

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._write(self._next(), "")
            self.at += 1

    def turn(self, role: str, text: str) -> None:
        self.inserts()
        step = self.audit[self.at]
        self.at += 1
        if step == "K":
            self.last = {"s": 1, "u": 2, "a": 3}[role[0]]
            self._write(role, text)
        elif step == "R":
            self._write(self._next(), text)

    def row(self) -> tuple:
        self.inserts()
        return (*self.found, self.hash.hexdigest())


def repaired(turns: DataFrame) -> DataFrame:
    """The audits with ``repaired_sha256``, the SHA-256 of the repaired ``role:text`` lines."""
    found = audits(turns).select("conv_id", F.lit(0).alias("kind"), *_COUNTS, "audit")
    lines = turns.where("NOT gone").select("conv_id", F.lit(1).alias("kind"), "turn", "role", _digest().alias("digest"), "text")
    rows = found.unionByName(lines, allowMissingColumns=True).repartition("conv_id")
    rows = rows.sortWithinPartitions("conv_id", "kind", "turn", "role", "digest").select("conv_id", "kind", *_COUNTS, "audit", "role", "text")
    id_type = turns.schema["conv_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(batches):
            now = None
            for batch in batches:
                columns = [c.to_pylist() for c in batch.columns]
                for i, kind in enumerate(columns[1]):
                    if kind == 0:
                        if now is not None:
                            yield now.row()
                        now = _Repaired((columns[0][i], *[c[i] for c in columns[2:-2]]))
                    else:
                        now.turn(columns[-2][i], columns[-1][i])
            if now is not None:
                yield now.row()

        batches = iter(batches)
        for head in batches:
            schema = pa.schema([("conv_id", head.schema.field(0).type), *[(c, pa.int64()) for c in _COUNTS],
                                ("audit", pa.string()), ("repaired_sha256", pa.string())])
            yield from _blocks(rows(_chain(head, batches)), schema)

    counts = ", ".join(f"{c} long" for c in _COUNTS)
    return rows.mapInArrow(read, f"conv_id {id_type}, {counts}, audit string, repaired_sha256 string")
