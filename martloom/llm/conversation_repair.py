"""Repair of the structure of conversations by the cheapest edits.

Rows are reduced to one byte each, initial of the role and fault, before a conversation meets in
one task: ranges of (conversation, turn, ...) are sorted side by side, so a conversation that
holds much of the table is coded by many tasks, and what they hand on is a byte string each. Edits are
found on the bytes (`repair_paths`), many conversations at once. Only then are the texts sorted,
once, and hashed as they stream by: a digest of one text cannot be split, but it needs no memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from martloom.llm.common import ASCII_SPACE, staging
from martloom.llm.repair_paths import INITIALS, MUST_GO, OTHER, SOUND, TRUNCATED, solve

# Rows whose edits are looked for at a time; a longer conversation is solved alone.
SOLVED_ROWS = 1 << 15
# Codes of one byte string, and the longest piece of rows that a task holds as Python objects.
BLOCK = 1 << 20
# Fixed value: pairs of initials that may follow each other.
LEGAL = np.zeros((4, 4), bool)
LEGAL[0, 1] = LEGAL[1, 2] = LEGAL[2, 1] = True

MADE_ROLES = {"u": "user", "a": "assistant"}
COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): rows after damage by crc32 of `conv_id:turn` modulo 20, a
    rule of the test of repair. 0 drops a row (it stays with `gone`, so that its conversation is
    known), 1 empties its text, 2 takes out `[.!?]`, 3 repeats it, 4 makes it the user's. Nulls
    count as one space."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    key = F.concat(shown("conv_id"), F.lit(":"), shown("turn"))
    rule = F.crc32(key.cast("binary")) % 20
    text = F.when(rule == 1, "").when(rule == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    copies = F.explode(F.when(rule == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(rule == 4, "user").otherwise(shown("role")).alias("role"),
        text.alias("text"),
        (rule == 0).alias("gone"),
        copies.alias("copy"),
    )
    return rows.drop("copy")


def undamaged(conversations: DataFrame) -> DataFrame:
    """The columns of `damaged` with the rows as they are; nulls count as one space."""
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
        F.lit(False).alias("gone"),
    )


def _text_key() -> Column:
    return F.unhex(F.md5(F.col("text").cast("binary"))).alias("text_key")


# Rows of a conversation in order; null turns first.
_ORDER = ("turn", "role", "text_key")


def _codes(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text_key, row, gone, code) without texts; `code` has no duplicates yet."""
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1)) - 1
    initial = F.when((F.col("role") == "") | (initial < 0), OTHER).otherwise(initial)
    blank = ~F.col("text").rlike(f"[^{ASCII_SPACE}]")
    ended = F.col("text").rlike(rf"[.!?][{ASCII_SPACE}]*\z")
    fault = F.when(blank, MUST_GO).when(~ended, TRUNCATED).otherwise(SOUND)
    return rows.select(
        "conv_id", "turn", "role", _text_key(), F.monotonically_increasing_id().alias("row"), "gone",
        blank.alias("blank"), initial.cast("byte").alias("initial"), fault.cast("byte").alias("fault"),
    )


def _coded_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to one row per conversation and block: its codes, its counts, and its turns from
    first to last, so that blocks of a conversation can be put together."""
    part = TaskContext.get().partitionId()
    number = 0
    for batch in batches:
        names = batch.schema.names
        ids = batch.column("conv_id")
        keys = pc.dictionary_encode(ids, null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        turns = batch.column("turn")
        gone = batch.column("gone").to_numpy(zero_copy_only=False)
        blank = batch.column("blank").to_numpy(zero_copy_only=False)
        first = batch.column(names.index("first")).to_numpy(zero_copy_only=False)
        fault = batch.column("fault").to_numpy(zero_copy_only=False)
        repeated = ~blank & ~first
        code = (batch.column("initial").to_numpy(zero_copy_only=False) * 4).astype(np.uint8)
        code += np.where(repeated, MUST_GO, fault).astype(np.uint8)
        cuts = np.flatnonzero(np.diff(keys)) + 1
        firsts = np.concatenate([[0], cuts]) if len(keys) else np.zeros(0, int)
        lasts = np.concatenate([cuts, [len(keys)]]) if len(keys) else firsts
        known = turns.is_valid().to_numpy(zero_copy_only=False) & ~gone
        turn = turns.fill_null(0).to_numpy(zero_copy_only=False)
        out: dict[str, list] = {n: [] for n in ("at", "codes", "low", "high", "turns", "blank", "duplicate")}
        for a, b in zip(firsts.tolist(), lasts.tolist(), strict=True):
            here = ~gone[a:b]
            seen = turn[a:b][known[a:b]]
            out["at"].append((part << 33) + number)
            out["codes"].append(code[a:b][here].tobytes())
            out["low"].append(int(seen[0]) if len(seen) else None)
            out["high"].append(int(seen[-1]) if len(seen) else None)
            out["turns"].append(int((np.diff(seen) != 0).sum()) + 1 if len(seen) else 0)
            out["blank"].append(int((blank[a:b] & here).sum()))
            out["duplicate"].append(int((repeated[a:b] & here).sum()))
            number += 1
        if out["at"]:
            kinds = {"codes": pa.binary()}
            columns = {n: pa.array(v, kinds.get(n, pa.int64())) for n, v in out.items()}
            yield pa.RecordBatch.from_pydict({"conv_id": ids.take(pa.array(firsts)), **columns})


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by conversation and place to one row per conversation with its edits."""
    ids: list[pa.Array] = []
    codes: list[list[bytes]] = []
    facts: list[list] = []  # low, high, distinct turns, blank, duplicate
    last: tuple | None = None

    def flush(whole: int) -> pa.RecordBatch:
        """The first `whole` conversations."""
        parts = [np.frombuffer(b"".join(c), np.uint8).astype(np.int64) for c in codes[:whole]]
        found = solve(np.concatenate(parts), np.array([len(p) for p in parts]))
        illegal = [int((~LEGAL[p[:-1] // 4, p[1:] // 4]).sum()) for p in parts]
        truncated = [int((p % 4 == TRUNCATED).sum()) for p in parts]
        done = facts[:whole]
        gaps = [h - lo + 1 - n if lo is not None else 0 for lo, h, n, _, _ in done]
        columns = {
            "gaps": gaps, "blank": [f[3] for f in done], "duplicate": [f[4] for f in done],
            "truncated": truncated, "illegal": illegal, "cost": found.costs,
        }
        batch = pa.RecordBatch.from_pydict(
            {
                "conv_id": pa.concat_arrays(ids[:whole]),
                **{n: pa.array(v, pa.int64()) for n, v in columns.items()},
                "audit": pa.array(found.audits, pa.string()),
                "made": pa.array(found.made, pa.string()),
            }
        )
        del ids[:whole], codes[:whole], facts[:whole]
        return batch

    waiting = 0
    for batch in batches:
        column = batch.column("conv_id")
        rows = batch.drop_columns(["conv_id", "at"]).to_pylist()
        for i, (name, row) in enumerate(zip(column.to_pylist(), rows, strict=True)):
            if last is None or last[0] != name:
                if waiting >= SOLVED_ROWS:
                    yield flush(len(codes))
                    waiting = 0
                ids.append(column.slice(i, 1))
                codes.append([])
                facts.append([None, None, 0, 0, 0])
                last = (name,)
            fact = facts[-1]
            codes[-1].append(row["codes"])
            waiting += len(row["codes"]) + 1
            if row["low"] is not None:
                # a turn may end one block and start the next
                fact[2] += row["turns"] - (fact[1] == row["low"])
                fact[0] = row["low"] if fact[0] is None else fact[0]
                fact[1] = row["high"]
            fact[3] += row["blank"]
            fact[4] += row["duplicate"]
    if codes:
        yield flush(len(codes))


def plans(store, rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, made) of every
    conversation of `rows` (columns of `damaged`)."""
    coded = store.save("codes", _codes(rows))
    # of equal messages the first one; found before the shuffle, so a message repeated everywhere is few rows
    firsts = (
        coded.filter("not blank and not gone")
        .groupBy("conv_id", "role", "text_key")
        .agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn", "row")).alias("first"))
        .select(F.col("first.row").alias("first_row"))
    )
    marked = coded.join(firsts, coded["row"] == firsts["first_row"], "left").select(
        "conv_id", *_ORDER, "row", "gone", "blank", "initial", "fault", F.col("first_row").isNotNull().alias("first")
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", *_ORDER, "row")]
    ranges = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = coded.schema["conv_id"].dataType.simpleString()
    blocks = ranges.drop("role", "text_key", "row").mapInArrow(
        _coded_blocks,
        f"conv_id {kind}, at long, codes binary, low long, high long, turns long, blank long, duplicate long",
    )
    blocks = blocks.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "at")
    return blocks.mapInArrow(_solved, f"conv_id {kind}, {COUNTS}, audit string, made string")


class _Reader:
    """One conversation's rows as they stream by, edited and hashed."""

    def __init__(self, audit: str, made: str) -> None:
        self.audit, self.made = audit, made
        self.at = 0
        self.digest = hashlib.sha256()
        self.any = False

    def _write(self, role: str, text: str) -> None:
        if self.any:
            self.digest.update(b"\n")
        self.digest.update(f"{role}:{text}".encode())
        self.any = True

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._write(MADE_ROLES[self.made[self.at]], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        if edit != "D":
            self._write(MADE_ROLES[self.made[self.at]] if edit == "R" else role, text)
        self.at += 1


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, each conversation's plan before its texts, to one row per conversation."""
    reader: _Reader | None = None
    head: pa.RecordBatch | None = None
    names: list[str] = []

    def done() -> pa.RecordBatch:
        reader.inserts()
        digest = pa.array([reader.digest.hexdigest()], pa.string())
        return pa.RecordBatch.from_arrays([*head.columns, digest], [*names, "repaired_sha256"])

    for batch in batches:
        names = [n for n in batch.schema.names if n not in ("is_row", "role", "text", "made")]
        is_row = batch.column("is_row").to_pylist()
        roles, texts = batch.column("role"), batch.column("text")
        roles, texts = roles.to_pylist(), texts.to_pylist()
        audits, made = batch.column("audit").to_pylist(), batch.column("made").to_pylist()
        finished: list[pa.RecordBatch] = []
        for i, row in enumerate(is_row):
            if row:
                reader.row(roles[i], texts[i])
            else:
                if reader is not None:
                    finished.append(done())
                reader, head = _Reader(audits[i], made[i]), batch.select(names).slice(i, 1)
        if finished:
            yield pa.Table.from_batches(finished).combine_chunks().to_batches()[0]
    if reader is not None:
        yield done()


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256): one row for
    each conversation of `rows`, which has the columns of `damaged` or `undamaged`.

    Rows stand by turn, null turns first; rows of one turn by role and MD5 of the text. A message
    is a duplicate if an earlier one of its conversation has the same role and the same MD5 of its
    text. Null conversation ids are one conversation. A conversation that has lost all of its rows has
    zeros, an empty audit and the hash of no text; an empty table gives no rows. A row's role may
    be any text; one that does not start with s, u or a must be re-roled or deleted.

    The codes of one conversation, a byte a row like its audit, meet in one task, which needs some
    hundred bytes for each while it looks for the edits.
    """
    store = staging(rows.sparkSession)
    found = store.save("plans", plans(store, rows))
    null = F.lit(None)
    facts = [c for c in found.columns if c not in ("conv_id", "audit", "made")]
    heads = found.select(
        "conv_id", F.lit(False).alias("is_row"), null.cast("long").alias("turn"), null.cast("string").alias("role"),
        null.cast("binary").alias("text_key"), null.cast("string").alias("text"), *facts, "audit", "made",
    )
    texts = rows.filter("not gone").select(
        "conv_id", F.lit(True).alias("is_row"), "turn", "role", _text_key(), "text",
        *[null.cast("long").alias(c) for c in facts],
        null.cast("string").alias("audit"), null.cast("string").alias("made"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "is_row", *_ORDER)]
    both = heads.unionByName(texts).repartition("conv_id").sortWithinPartitions(*order)
    kind = found.schema["conv_id"].dataType.simpleString()
    return both.drop("turn", "text_key").mapInArrow(
        _hashed, f"conv_id {kind}, {COUNTS}, audit string, repaired_sha256 string"
    )
