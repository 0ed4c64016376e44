"""Structure repair of damaged conversations: faults of single rows, then the cheapest edits that give a legal order of roles."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.role_glr import Repair

BLANK, TRUNCATED = 1, 2
LEGAL_PAIRS = {"su", "ua", "au"}
ROLES = {"u": "user", "a": "assistant"}


def _or_space(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn") -> DataFrame:
    """(id, turn, role, text, there): rows damaged by crc32 of ``id:turn`` modulo 20; nulls count as one space, null turns stay.

    0 drops the row, which stays as a row that is not ``there``; 1 empties its text; 2 removes full stops, exclamation and question
    marks; 3 repeats it; 4 makes its role user.
    """
    kind = F.crc32(F.concat(_or_space(id_column), F.lit(":"), _or_space(turn_column)).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(_or_space("text"), "[.!?]", "")).otherwise(_or_space("text"))
    role = F.when(kind == 4, "user").otherwise(_or_space("role"))
    copies = F.when(kind == 3, 2).otherwise(1)
    return conversations.select(
        F.col(id_column).alias("id"), F.col(turn_column).alias("turn"), role.alias("role"), text.alias("text"),
        (kind != 0).alias("there"), F.explode(F.sequence(F.lit(1), copies)).alias("copy"),
    ).drop("copy")


class _Conversation:
    """What is known of one conversation while its rows pass in order."""

    def __init__(self, name):
        self.name = name
        self.least = self.most = self.last_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.seen: set[bytes] = set()
        self.initial = None
        self.repair = Repair()
        self.waiting: list[tuple[str, str]] = []  # rows whose edit is open
        self.edits: list[str] = []
        self.digest = hashlib.sha256()
        self.written = False
        self.expected = "u"

    def row(self, turn, role: str, text: str, fault: int) -> None:
        if turn is not None and turn != self.last_turn:
            self.least, self.most = (turn if self.least is None else self.least), turn
            self.turns, self.last_turn = self.turns + 1, turn
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL_PAIRS:
            self.illegal += 1
        self.initial = initial
        name = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        twice = name in self.seen
        self.seen.add(name)
        must_go = fault == BLANK or twice
        cut = not must_go and fault == TRUNCATED
        self.blank += fault == BLANK
        self.duplicate += fault != BLANK and twice
        self.truncated += cut
        self.waiting.append((role, text))
        self._apply(self.repair.row(initial, must_go, int(cut)))

    def _write(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.written else "") + f"{role}:{text}").encode())
        self.written = True

    def _apply(self, edits: str) -> None:
        """Carry out final edits on the waiting rows."""
        if not edits:
            return
        self.edits.append(edits)
        done = 0
        for edit in edits:
            if edit == "I":
                self._write(ROLES[self.expected], "")
            else:
                role, text = self.waiting[done]
                done += 1
                if edit == "D":
                    continue
                if edit == "K":
                    self._write(role, text)
                    if role[:1] == "s":
                        continue
                else:
                    self._write(ROLES[self.expected], text)
            self.expected = "a" if self.expected == "u" else "u"
        del self.waiting[:done]

    def result(self) -> tuple:
        cost, edits = self.repair.finish()
        self._apply(edits)
        gaps = 0 if self.turns == 0 else self.most - self.least + 1 - self.turns
        return (
            self.name, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, "".join(self.edits), self.digest.hexdigest()
        )


def repair_structure(damaged: DataFrame) -> DataFrame:
    """(id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), a row for each id.

    ``damaged`` holds id, turn (an integer), role, text and there, as ``damage`` gives them; nulls of role and text are empty.
    Rows are taken by turn, nulls first, then by role and text. A row's first fault counts: blank, duplicate of an earlier row, truncated.
    Keeping costs 0, a new role 2, deleting 3 (a must for blank and duplicate rows), an empty row put in 2; truncated rows that are not deleted 1
    more. Of the cheapest edits the ASCII-least letters win. Ids without rows there have zeros and the digest of nothing; a null id
    is an id; an empty table gives no rows.

    A conversation streams through one task in Spark's sorted order, as its digest asks for. The task holds the names of its distinct rows, the letters,
    and rows whose edit is still open: a few, or a run as long as its roles stay unknown to the grammar.
    """
    kind = damaged.schema["id"].dataType.simpleString()
    schema = (
        f"id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    )
    bare = F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", "")
    fault = F.when(bare == "", BLANK).when(~F.substring(bare, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(0)
    rows = damaged.select("id", F.col("turn").cast("long").alias("turn"), *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")), "there")
    rows = rows.withColumn("fault", fault).repartition("id").sortWithinPartitions(
        F.col("id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", F.desc("there")
    )

    def batch_of(done: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*done)) or [()] * 9
        types = [id_type, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    names = [part.split()[0] for part in schema.split(", ")]

    def stream(batches):
        now, done = None, []
        for batch in batches:
            id_type = batch.schema.field(0).type
            columns = [c.to_pylist() for c in batch.columns]
            for name, turn, role, text, there, fault in zip(*columns):
                if now is None or name != now.name:
                    if now is not None:
                        done.append(now.result())
                    now = _Conversation(name)
                if there:
                    now.row(turn, role, text, fault)
            yield batch_of(done, id_type)
            done = []
        if now is not None:
            yield batch_of([now.result()], id_type)

    return rows.mapInArrow(stream, schema)
