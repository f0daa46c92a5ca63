"""Repair of the turn structure of conversations by cheapest edits, ties by the least audit.

Each row of a conversation is kept (K, 0), given another role (R, 2) or deleted (D, 3); turns with an empty
text are inserted (I, 2). Blank and repeated rows must go, a truncated row that stays costs 1 more. The
initials of the roles must in the end read ``(s?(ua)+)?``. The audit is the row of edit letters; of the
cheapest audits the least in ASCII counts.

The places between rows and the four states (nothing yet, after s, after u, after a) are nodes, edits are
arcs. A backward cost DP leaves the arcs that lie on cheapest paths. Prefix doubling ranks the nodes by the first
1, 2, 4, ... letters of their least audits: a node of a new length is ranked by its rank and that of the node
its pointer reaches. The arc of least letter and least rank behind it is the node's; no two arcs of a node have the
same letter, so a pointer never changes once set. The doubled pointers lay out the whole path in as many
steps. All conversations of a batch do this at once, in NumPy.

Rows are range-partitioned and sorted by conversation and turn and cut into pieces of at most ``PIECE_ROWS``
rows or ``PIECE_BYTES`` of text. A conversation inside one partition is one piece. Of the others, at most two a
partition besides the very long ones, each piece becomes a 4 x 4 matrix of costs; the products from the
end give the cost behind each piece, the exits of each piece the state before the next. Only these rows
of fixed size meet by conversation, one for each piece; digests are then taken in a stream, piece by piece.

* Null roles and texts count as one space; a null conv_id is a conversation, null turns come first.
* Rows of one turn go by role and then by a hash of the text; equal rows are repeats of each other.
* A role that does not begin with s, u or a (an empty one too) can't be kept, only changed or deleted.
* A conversation whose rows all were dropped has zeros, an empty audit and no turns. An empty table gives no
  rows. A row with a very long text is a piece of its own. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeline.session import stored
from lakeline.sources.files import table

PIECE_ROWS = 4096
PIECE_BYTES = 4 << 20
BATCH_ROWS = 8192

SPACES = " \t\n\x0b\x0c\r"
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
INITIALS = "sua"
LEGAL = {"su", "ua", "au"}
LETTERS = "DIKR"
DELETE, INSERT, KEEP, REROLE = range(4)
#: States: nothing yet, after s, after u, after a. Where a turn that is inserted or given a role leads to.
NEXT = np.array([2, 2, 3, 2])
#: Where a kept row leads to, by state and initial (s, u, a, other); -1 where it can't be kept.
KEPT = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
BIG = 1 << 40
ACCEPTED = np.array([0, BIG, BIG, 0])

_PIECE = ("conv string, seq bigint, whole boolean, edits string, roles array<string>, texts array<string>, "
          "faults binary, cost bigint, n bigint, low bigint, high bigint, first bigint, last bigint, "
          "turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
          "head string, tail string")
_REPORT = ("conv string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
           "cost bigint, audit string, repaired_sha256 string")


@dataclass
class Piece:
    """Consecutive rows of one conversation."""

    conv: str | None
    seq: int
    whole: bool = True
    turns: list[int | None] = field(default_factory=list)
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    faults: list[int] = field(default_factory=list)
    size: int = 0

    def initials(self) -> np.ndarray:
        return np.array([INITIALS.find(role[0]) if role and role[0] in INITIALS else 3 for role in self.roles], int)

    def judge(self) -> None:
        """The first fault of each row, repeats only within the piece."""
        seen = set()
        for role, text in zip(self.roles, self.texts):
            bare = text.rstrip(SPACES)
            repeat = (role, text) in seen
            seen.add((role, text))
            self.faults.append(
                BLANK if not bare else DUPLICATE if repeat else SOUND if bare[-1] in ".!?" else TRUNCATED)

    def facts(self) -> dict:
        known = [turn for turn in self.turns if turn is not None]
        heads = [role[:1] for role in self.roles]
        return {
            "conv": self.conv, "seq": self.seq, "whole": self.whole, "n": len(self.roles),
            "low": min(known, default=None), "high": max(known, default=None),
            "first": known[0] if known else None, "last": known[-1] if known else None,
            "turns": len(set(known)), "blank": self.faults.count(BLANK),
            "duplicate": self.faults.count(DUPLICATE), "truncated": self.faults.count(TRUNCATED),
            "illegal": sum(a + b not in LEGAL for a, b in zip(heads, heads[1:])),
            "head": heads[0] if heads else None, "tail": heads[-1] if heads else None,
        }


def with_inserts(base: np.ndarray) -> np.ndarray:
    """Costs to go of the four states when turns may be inserted first."""
    c2 = np.minimum(base[:, 2], base[:, 3] + 2)
    c3 = np.minimum(base[:, 3], base[:, 2] + 2)
    return np.stack([np.minimum(base[:, 0], c2 + 2), np.minimum(base[:, 1], c2 + 2), c2, c3], axis=1)


@dataclass
class Grid:
    """Nodes of several pieces: the places of each, one more than its rows, by four states."""

    initials: list[np.ndarray]
    faults: list[np.ndarray]

    def __post_init__(self):
        lengths = np.array([len(x) for x in self.faults])
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        self.start = np.concatenate([[0], np.cumsum(self.lengths + 1)[:-1]])
        self.end = self.start + self.lengths
        total = int((self.lengths + 1).sum())
        initial, fault = np.full(total, 3), np.full(total, BLANK)
        for at, number in zip(self.start, self.order):
            initial[at:at + len(self.faults[number])] = self.initials[number]
            fault[at:at + len(self.faults[number])] = self.faults[number]
        stays = np.where((fault == BLANK) | (fault == DUPLICATE), BIG, (fault == TRUNCATED).astype(int))
        self.kept_to = KEPT[:, initial].T
        self.keep = np.where(self.kept_to >= 0, stays[:, None], BIG)
        self.rerole = stays + 2

    def costs(self, ends: np.ndarray, final: np.ndarray) -> np.ndarray:
        """Cost from each node to the end; ``ends`` by piece, with inserts after the last row if ``final``."""
        ends, final = ends[self.order], final[self.order]
        go = np.full((len(self.rerole), 4), BIG)
        go[self.end] = np.where(final[:, None], with_inserts(ends), ends)
        for place in range(int(self.lengths.max(initial=0)) - 1, -1, -1):
            live = int(np.searchsorted(-self.lengths, -place, side="left"))
            at = self.start[:live] + place
            behind = go[at + 1]
            base = np.minimum(behind + 3, self.rerole[at][:, None] + behind[:, NEXT])
            kept = self.keep[at] + np.take_along_axis(behind, np.maximum(self.kept_to[at], 0), axis=1)
            go[at] = with_inserts(np.minimum(base, kept))
        return np.minimum(go, BIG)

    def least_paths(
        self, go: np.ndarray, final: np.ndarray, entries: np.ndarray
    ) -> tuple[list[tuple[str, np.ndarray]], np.ndarray]:
        """For each piece its letters with the state each leads to, and the state at its end."""
        nodes = np.arange(go.size)
        places = np.arange(len(go))[:, None]
        last = np.zeros(len(go), bool)
        last[self.end] = True
        closed = np.zeros(len(go), bool)
        closed[self.end[~final[self.order]]] = True
        after = np.minimum(places + 1, len(go) - 1)
        target = np.stack([
            after * 4 + np.arange(4), places * 4 + NEXT, after * 4 + np.maximum(self.kept_to, 0),
            after * 4 + NEXT + 0 * places], axis=2).reshape(-1, 4)
        flat = go.reshape(-1)
        total = flat[target] + np.stack(
            [np.full_like(go, 3), np.full_like(go, 2), self.keep, self.rerole[:, None] + 0 * go],
            axis=2).reshape(-1, 4)
        optimal = (total == flat[:, None]) & (flat < BIG)[:, None]
        optimal[np.repeat(last, 4)] &= np.array([False, True, False, False])
        optimal[np.repeat(closed, 4)] = False
        done = ~optimal.any(axis=1)

        def least_arc(rank: np.ndarray) -> np.ndarray:
            width = rank.max() + 1
            return np.where(optimal, np.arange(4) * width + rank[target], BIG).argmin(axis=1)

        rank = np.where(done, 0, optimal.argmax(axis=1) + 1)
        pointers = [np.where(done, nodes, target[nodes, least_arc(rank)])]
        while not done[pointers[-1]].all():
            rank = np.unique(rank * (rank.max() + 1) + rank[pointers[-1]], return_inverse=True)[1]
            pointers.append(pointers[-1][pointers[-1]])
        letter = least_arc(rank)
        path = (self.start * 4 + entries[self.order])[:, None]
        for pointer in pointers:
            path = np.concatenate([path, pointer[path]], axis=1)
        size = (~done[path]).sum(axis=1)
        found: list = [None] * len(size)
        exits = np.empty(len(size), int)
        for row, number in enumerate(self.order):
            steps = path[row, :size[row] + 1]
            found[number] = ("".join(LETTERS[x] for x in letter[steps[:-1]]), steps[1:] % 4)
            exits[number] = steps[-1] % 4
        return found, exits


def repaired(roles: list[str], texts: list[str], edits: str, states: np.ndarray) -> tuple[list[str], list[str]]:
    """Roles and texts after the edits."""
    new_roles, new_texts, at = [], [], 0
    for letter, state in zip(edits, states):
        if letter != "D":
            new_roles.append(roles[at] if letter == "K" else "user" if state == 2 else "assistant")
            new_texts.append("" if letter == "I" else texts[at])
        at += letter != "I"
    return new_roles, new_texts


def _batches(rows: list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(),
             "array<string>": pa.list_(pa.string()), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def _solved(pieces: list[Piece]) -> list[dict]:
    """Rows of whole conversations, repaired."""
    grid = Grid([p.initials() for p in pieces], [np.array(p.faults, int) for p in pieces])
    final = np.ones(len(pieces), bool)
    go = grid.costs(np.tile(ACCEPTED, (len(pieces), 1)), final)
    paths, _ = grid.least_paths(go, final, np.zeros(len(pieces), int))
    cost = np.empty(len(pieces), int)
    cost[grid.order] = go[grid.start, 0]
    rows = []
    for piece, (edits, states), spent in zip(pieces, paths, cost):
        roles, texts = repaired(piece.roles, piece.texts, edits, states)
        rows.append(piece.facts() | {"edits": edits, "roles": roles, "texts": texts, "cost": int(spent), "faults": None})
    return rows


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to pieces; whole conversations leave repaired, in batches of like length."""
    schema = _schema(_PIECE)
    waiting: dict[int, list[Piece]] = {}
    held: dict[int, int] = {}
    piece = None

    def close(piece: Piece) -> Iterator[pa.RecordBatch]:
        piece.judge()
        if not piece.whole:
            yield from _batches([piece.facts() | {
                "edits": None, "roles": piece.roles, "texts": piece.texts, "cost": None,
                "faults": bytes(piece.faults)}], schema)
            return
        kind = len(piece.roles).bit_length()
        waiting.setdefault(kind, []).append(piece)
        held[kind] = held.get(kind, 0) + len(piece.roles) + piece.size // 64 + 1
        if held[kind] >= BATCH_ROWS:
            held[kind] = 0
            yield from _batches(_solved(waiting.pop(kind)), schema)

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("conv", "seq", "turn", "role", "text", "dropped")]
        for conv, seq, turn, role, text, dropped in zip(*columns):
            if piece is None or conv != piece.conv:
                if piece is not None:
                    yield from close(piece)
                piece = Piece(conv, seq, whole=piece is not None)
            elif len(piece.roles) >= PIECE_ROWS or piece.size + len(text) > PIECE_BYTES and piece.roles:
                piece.whole = False
                yield from close(piece)
                piece = Piece(conv, seq, whole=False)
            if not dropped:
                piece.turns.append(turn)
                piece.roles.append(role)
                piece.texts.append(text)
                piece.size += len(text)
    if piece is not None:
        piece.whole = False  # it may go on in the next partition
        yield from close(piece)
    for pieces in waiting.values():
        yield from _batches(_solved(pieces), schema)


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``conv, seq, place, mark`` of the first rows of each text of a piece."""
    schema = _schema("conv string, seq bigint, place bigint, mark binary")
    for batch in batches:
        for row in batch.to_pylist():
            yield from _batches([
                {"conv": row["conv"], "seq": row["seq"], "place": place,
                 "mark": hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()}
                for place, (role, text, fault) in enumerate(zip(row["roles"], row["texts"], row["faults"]))
                if fault in (SOUND, TRUNCATED)], schema)


def _grid_of(rows: list[dict]) -> Grid:
    shapes = [Piece(None, 0, roles=row["roles"]) for row in rows]
    return Grid([shape.initials() for shape in shapes], [np.frombuffer(row["faults"], np.uint8) for row in rows])


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``conv, seq, matrix``: cost from each state before a piece to each one behind it."""
    schema = _schema("conv string, seq bigint, matrix array<bigint>")
    for batch in batches:
        for row in batch.to_pylist():
            grid = _grid_of([row] * 4)
            go = grid.costs(np.where(np.eye(4, dtype=bool), 0, BIG), np.zeros(4, bool))
            yield from _batches([{"conv": row["conv"], "seq": row["seq"],
                                  "matrix": go[grid.start][np.argsort(grid.order)].T.reshape(-1).tolist()}], schema)


def _ends(rows: pd.DataFrame) -> pd.DataFrame:
    """``seq, ends, final`` of the pieces of one conversation, from the last one back."""
    rows = rows.sort_values("seq")
    behind, found = ACCEPTED, []
    for number, (seq, matrix) in enumerate(zip(rows["seq"][::-1], rows["matrix"][::-1])):
        found.append((seq, behind.tolist(), number == 0))
        after = with_inserts(behind[None])[0] if number == 0 else behind
        behind = np.minimum((np.array(matrix).reshape(4, 4) + after).min(axis=1), BIG)
    return pd.DataFrame(found, columns=["seq", "ends", "final"])


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``conv, seq, exits``: the state behind a piece for each state before it."""
    schema = _schema("conv string, seq bigint, exits array<bigint>")
    for batch in batches:
        for row in batch.to_pylist():
            grid, final = _grid_of([row] * 4), np.full(4, row["final"])
            go = grid.costs(np.tile(np.array(row["ends"]), (4, 1)), final)
            yield from _batches([{"conv": row["conv"], "seq": row["seq"],
                                  "exits": grid.least_paths(go, final, np.arange(4))[1].tolist()}], schema)


def _entries(rows: pd.DataFrame) -> pd.DataFrame:
    """``seq, entry`` of the pieces of one conversation, from the first one on."""
    rows = rows.sort_values("seq")
    state, found = 0, []
    for seq, exits in zip(rows["seq"], rows["exits"]):
        found.append((seq, state))
        state = int(exits[state])
    return pd.DataFrame(found, columns=["seq", "entry"])


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces whose surroundings are known, repaired."""
    schema = _schema(_PIECE)
    for batch in batches:
        for row in batch.to_pylist():
            grid, final = _grid_of([row]), np.array([row["final"]])
            go = grid.costs(np.array([row["ends"]]), final)
            entry = row["entry"]
            ((edits, states),), (left,) = grid.least_paths(go, final, np.array([entry]))
            roles, texts = repaired(row["roles"], row["texts"], edits, states)
            behind = 0 if row["final"] else row["ends"][left]
            row |= {"edits": edits, "roles": roles, "texts": texts, "cost": int(go[0, entry]) - behind,
                    "blank": row["faults"].count(BLANK), "duplicate": row["faults"].count(DUPLICATE),
                    "truncated": row["faults"].count(TRUNCATED)}
            yield from _batches([{name: row[name] for name in schema.names}], schema)


def _with_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets the fault of rows whose text an earlier piece of the conversation has."""
    for batch in batches:
        rows = batch.to_pylist()
        for row in rows:
            faults = bytearray(row["faults"])
            for place in row.pop("later") or ():
                faults[place] = DUPLICATE
            row["faults"] = bytes(faults)
        yield from _batches(rows, _schema(_PIECE))


def repair(rows: DataFrame) -> DataFrame:
    """Pieces of repaired conversations: ``conv, seq, edits, roles, texts, cost`` and facts of the input.

    ``rows`` has ``conv_id, turn, role, text`` and may have ``dropped``: such a row only names its
    conversation. The pieces of a conversation follow each other by ``seq``.
    """
    spark = rows.sparkSession
    if "dropped" not in rows.columns:
        rows = rows.withColumn("dropped", F.lit(False))
    rows = rows.select(
        F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "dropped",
        F.xxhash64(F.coalesce("text", F.lit(" "))).alias("tie"), F.monotonically_increasing_id().alias("number"))
    keys = ["conv", "turn", "role", "tie", "number"]
    ordered = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys)
    ordered = ordered.sortWithinPartitions(*keys).withColumn("seq", F.monotonically_increasing_id())
    pieces = stored(
        ordered.select("conv", "seq", "turn", "role", "text", "dropped").mapInArrow(_cut, _PIECE), "pieces")

    parts = pieces.where("NOT whole")
    marks = parts.select("conv", "seq", "roles", "texts", "faults").mapInArrow(
        _marks, "conv string, seq bigint, place bigint, mark binary")
    before = F.min("seq").over(Window.partitionBy("conv", "mark"))
    later = marks.withColumn("before", before).where("before < seq").groupBy("seq").agg(
        F.collect_list("place").alias("later"))
    parts = stored(parts.join(later, "seq", "left").select(*pieces.columns, "later").mapInArrow(
        _with_repeats, _PIECE), "parts")
    shapes = parts.select("conv", "seq", "roles", "faults")
    ends = stored(shapes.mapInArrow(_matrices, "conv string, seq bigint, matrix array<bigint>").groupBy(
        "conv").applyInPandas(_ends, "seq bigint, ends array<bigint>, final boolean"), "ends")
    entries = shapes.join(ends, "seq").mapInArrow(_exits, "conv string, seq bigint, exits array<bigint>").groupBy(
        "conv").applyInPandas(_entries, "seq bigint, entry bigint")
    joined = parts.join(ends, "seq").join(entries, "seq").select(*pieces.columns, "ends", "final", "entry")
    return pieces.where("whole").union(joined.mapInArrow(_applied, _PIECE))


def turns(pieces: DataFrame) -> DataFrame:
    """The repaired turns: ``conv, seq, place, role, text``, in order by ``seq, place``."""
    both = F.arrays_zip(F.col("roles").alias("role"), F.col("texts").alias("text"))
    return pieces.select("conv", "seq", F.posexplode(both).alias("place", "turn")).select(
        "conv", "seq", "place", "turn.role", "turn.text")


def _reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums and digests of each conversation, its pieces following each other."""
    schema = _schema(_REPORT)
    now: dict | None = None
    sums = ("blank", "duplicate", "truncated", "illegal", "cost")

    def result(now: dict) -> dict:
        gaps = 0 if now["low"] is None else now["high"] - now["low"] + 1 - now["turns"]
        return {name: now[name] for name in sums} | {
            "conv": now["conv"], "gaps": gaps, "audit": "".join(now["audit"]),
            "repaired_sha256": now["hash"].hexdigest()}

    for batch in batches:
        ready = []
        for row in batch.to_pylist():
            if now is None or now["conv"] != row["conv"] or row["whole"]:
                if now is not None:
                    ready.append(result(now))
                now = {name: 0 for name in sums} | {
                    "conv": row["conv"], "low": None, "high": None, "last": None, "turns": 0, "tail": None,
                    "audit": [], "hash": hashlib.sha256(), "any": False}
            for name in sums:
                now[name] += row[name]
            if row["head"] is not None:
                if now["tail"] is not None:
                    now["illegal"] += now["tail"] + row["head"] not in LEGAL
                now["tail"] = row["tail"]
            if row["low"] is not None:
                now["turns"] += row["turns"] - (now["last"] == row["first"])
                now["low"] = row["low"] if now["low"] is None else now["low"]
                now["high"], now["last"] = row["high"], row["last"]
            now["audit"].append(row["edits"])
            for role, text in zip(row["roles"], row["texts"]):
                now["hash"].update(f"{chr(10) if now['any'] else ''}{role}:{text}".encode())
                now["any"] = True
        yield from _batches(ready, schema)
    if now is not None:
        yield from _batches([result(now)], schema)


def report(pieces: DataFrame) -> DataFrame:
    """One row for each conversation: counts of faults, cost, audit and digest of the repaired turns."""
    whole = pieces.where("whole").mapInArrow(_reported, _REPORT)
    parts = pieces.where("NOT whole").repartition("conv").sortWithinPartitions("conv", "seq")
    return whole.union(parts.mapInArrow(_reported, _REPORT))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given role user, by a checksum of conversation and turn."""
    gap = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), gap), F.coalesce(F.col("turn").cast("string"), gap))
    fate, text = F.crc32(key.cast("binary")) % 20, F.coalesce("text", gap)
    return rows.select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(F.coalesce("role", gap)).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (fate == 0).alias("dropped"),
        F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def op12_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cheapest repair and digest of each conversation of the damaged table."""
    rows = table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    found = report(repair(damaged(rows)))
    return found.select(F.col("conv").cast(rows.schema["conv_id"].dataType).alias("conv_id"), *found.columns[1:])
