"""Hard negatives, near vectors and repaired conversations against plain brute force."""

import hashlib
import math
import re
import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeline.llm import near_vectors, negatives, repair

VECTORS = "vec_id bigint, label int, embedding array<float>, anchor string, key string, node string, mark int"


def vector_rows(rows):
    return [(*row, "x", "y", "z", 1) for row in rows]


def random_vectors(seed, count, width=16, labels=3, near=0.0):
    pick = np.random.default_rng(seed)
    base = pick.normal(size=(count, width))
    if near:
        base = np.repeat(base[: count // 4 + 1], 4, axis=0)[:count] + near * pick.normal(size=(count, width))
    base /= np.linalg.norm(base, axis=1)[:, None]
    return [(number, int(pick.integers(labels)), [float(np.float32(x)) for x in row]) for number, row in enumerate(base)]


ODD = [
    (900, None, [0.1] * 16), (901, 1, None), (902, 1, [0.1] * 15 + [None]), (903, 1, [math.nan] + [0.1] * 15),
    (904, 1, [math.inf] + [0.1] * 15), (905, 1, [0.0] * 16), (906, 1, []), (1400, 2, []),
]


# hard negatives


def brute_negatives(rows):
    kept = []
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [math.floor(256 * x) for x in vector]))
    out = []
    for a, label, v in kept:
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), b, other) for b, other, w in kept if b != a)
        for minus, positive, _ in [s for s in scored if s[2] == label][:5]:
            score = -minus
            fit = [s for s in scored if s[2] != label and 30 * score <= -100 * s[0] <= 90 * score][:10]
            out += [(a, positive, rank, b, score, -m) for rank, (m, b, _) in enumerate(fit, 1)]
    return sorted(out)


def mined(frame):
    vectors = frame.where(negatives.usable(F.col("embedding")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.select(
        F.col("vec_id").alias("id"), label.alias("label"), negatives.whole(F.col("embedding")).alias("numbers"))
    return sorted(map(tuple, negatives.hard_negatives(vectors, F.col("id") % 100 == 0).collect()))


def test_negatives_equal_brute_force(spark):
    rows = random_vectors(1, 700) + [(v + 10_000, *r) for v, *r in random_vectors(2, 40, near=0.1)] + ODD
    rows += [(number + 20_000, 2, rows[100][2]) for number in range(60)]  # ties
    frame = spark.createDataFrame(vector_rows(rows), VECTORS).repartition(3)
    assert mined(frame) == brute_negatives(rows)


def test_negatives_in_many_groups(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 64)
    monkeypatch.setattr(negatives, "GROUP", 3)
    monkeypatch.setattr(negatives, "PER_CELL", 2)
    rows = [(v * 10, *r) for v, *r in random_vectors(3, 300, near=0.3)]
    assert mined(spark.createDataFrame(vector_rows(rows), VECTORS)) == brute_negatives(rows)


def test_negatives_of_wide_numbers_and_empty_table(spark):
    rows = [(number * 50, number % 2, [float(2.0**18 * (number + k) + 1) for k in range(3)]) for number in range(12)]
    assert mined(spark.createDataFrame(vector_rows(rows), VECTORS)) == brute_negatives(rows)
    assert mined(spark.createDataFrame([], VECTORS)) == []


def test_walk_stops_early():
    pick = np.random.default_rng(5)
    centre = np.zeros(32)
    centre[0] = 1
    members = np.floor(256 * (centre + 0.02 * pick.normal(size=(8, 32)))).astype(np.int64)
    near = np.floor(256 * (centre + 0.1 * pick.normal(size=(300, 32)))).astype(np.int64)
    far = np.floor(256 * pick.normal(size=(50_000, 32)) / 6).astype(np.int64)
    numbers, steps = np.concatenate([far, near]), []
    slots = np.arange(8)
    wide = np.full(8, 1 << 40)
    slot, ids, score = negatives.walk(
        np.arange(len(numbers)), numbers, members, np.full(8, -1), slots, -wide, wide, 5, steps)
    exact = np.sort(members @ numbers.T, axis=1)[:, :-6:-1]
    assert score.reshape(8, 5).tolist() == exact.tolist()
    assert steps[0] < len(numbers) / 5


# near vectors


def brute_links(rows):
    usable = [r for r in rows if r[1] is not None and r[2] and all(x is not None and math.isfinite(x) for x in r[2]) and any(r[2])]
    near = {id(r): [] for r in rows}
    for number, a in enumerate(usable):
        for b in usable[number + 1:]:
            if a[1] == b[1] and len(a[2]) == len(b[2]):
                x, y = np.array(a[2]), np.array(b[2])
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.93:
                    near[id(a)].append(b)
                    near[id(b)].append(a)
    out = []
    for row in rows:
        seen, todo = {id(row): row}, [row]
        while todo:
            for other in near[id(todo.pop())]:
                if id(other) not in seen:
                    seen[id(other)] = other
                    todo.append(other)
        least = min((r[0] for r in seen.values() if r[0] is not None), default=None)
        out.append((row[0], len(near[id(row)]), least, row[0] is not None and row[0] == least))
    return sorted(out, key=str)


def linked(frame):
    return sorted(map(tuple, near_vectors.near_vectors(frame).collect()), key=str)


def test_near_vectors_equal_brute_force(spark):
    rows = random_vectors(7, 400, near=0.09) + ODD
    rows += [(number + 2000, 1, rows[5][2]) for number in range(50)] + [(7, *rows[7][1:]), (None, 1, rows[5][2])]
    rows += [(3000 + n, 0, [math.cos(n / 5), math.sin(n / 5)]) for n in range(30)]  # a ring, linked by chains
    frame = spark.createDataFrame(vector_rows(rows), VECTORS).repartition(3)
    expected = brute_links([tuple(r) for r in rows])
    assert max(r[1] for r in expected) >= 50
    assert linked(frame) == expected


def test_near_vectors_in_sampled_and_cut_buckets(spark, monkeypatch):
    rows = random_vectors(8, 900, width=24, labels=2, near=0.05)
    pick = np.random.default_rng(9)
    rows += [(5000 + n, 1, [float(np.float32(x)) for x in 1 + 0.15 * pick.normal(size=24)]) for n in range(150)]
    expected = brute_links([tuple(r) for r in rows])
    monkeypatch.setattr(near_vectors, "BUCKET", 24)
    monkeypatch.setattr(near_vectors, "CUT", 48)
    tables, bits = near_vectors.shape_of(500)
    assert bits >= 4 and tables >= 6
    found = linked(spark.createDataFrame(vector_rows(rows), VECTORS))
    links, known = sum(r[1] for r in found), sum(r[1] for r in expected)
    assert known >= links >= 0.99 * known


def test_near_vectors_of_nothing(spark):
    assert linked(spark.createDataFrame([], VECTORS)) == []
    assert linked(spark.createDataFrame(vector_rows(ODD), VECTORS)) == brute_links(ODD)


def test_estimates_are_unbiased():
    pick = np.random.default_rng(4)
    a = near_vectors.unit(pick.normal(size=(4000, 64)))
    b = near_vectors.unit(0.95 * a + 0.31 * near_vectors.unit(pick.normal(size=(4000, 64))))
    (first, _), (_, second) = (near_vectors.estimates(*near_vectors.codes_of(x)) for x in (a, b))
    wrong = (first * second).sum(axis=1) - (a * b).sum(axis=1)
    assert abs(wrong.mean()) < 4 * wrong.std() / math.sqrt(len(wrong))


# conversations

TURNS = "conv_id bigint, turn bigint, role string, text string, seq int, conv string, dropped_too int"


def brute_least(roles, faults):
    """Cost and least audit by a search over whole strings, state by state."""
    def legal(state, role):
        return role in {"": "su", "s": "u", "u": "a", "a": "u"}[state]

    def grown(states):
        todo = list(states.items())
        while todo:
            state, (cost, audit) = todo.pop()
            for role in "ua":
                if legal(state, role):
                    new = (cost + 2, audit + "I")
                    if role not in states or new < states[role]:
                        states[role] = new
                        todo.append((role, new))
        return states

    frontier = grown({"": (0, "")})  # by the last initial
    for role, fault in zip(roles, faults):
        behind = {}

        def offer(state, value):
            if state not in behind or value < behind[state]:
                behind[state] = value

        for state, (cost, audit) in frontier.items():
            offer(state, (cost + 3, audit + "D"))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if role[:1] in ("s", "u", "a") and legal(state, role[0]):
                    offer(role[0], (cost + more, audit + "K"))
                for new in "ua":
                    if legal(state, new):
                        offer(new, (cost + 2 + more, audit + "R"))
        frontier = grown(behind)
    return min(frontier[state] for state in ("", "a") if state in frontier)


def brute_report(rows, damage=True):
    conversations = {}
    for conv, turn, role, text in rows:
        kept = conversations.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(key.encode()) % 20 if damage else 19
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        kept += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    out = []
    for conv, turns in conversations.items():
        turns = sorted(turns, key=lambda x: (x[0] is not None, x[0] or 0))
        seen, faults = set(), []
        for _, role, text in turns:
            bare = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen
                          else "" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        heads = [role[:1] for _, role, _ in turns]
        known = [t for t, _, _ in turns if t is not None]
        cost, audit = brute_least([r for _, r, _ in turns], faults)
        repaired, left = [], list(turns)
        for letter in audit:
            after = "assistant" if repaired and repaired[-1][0][0] == "u" else "user"
            if letter == "I":
                repaired.append((after, ""))
            else:
                _, role, text = left.pop(0)
                if letter != "D":
                    repaired.append((role if letter == "K" else after, text))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out.append((conv, max(known) - min(known) + 1 - len(set(known)) if known else 0,
                    *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:])), cost, audit, digest))
    return sorted(out, key=str)


def reported(frame):
    rows = repair.report(repair.repair(frame))
    return sorted(((None if r[0] is None else int(r[0]), *r[1:]) for r in map(tuple, rows.collect())), key=str)


def test_conversations_equal_brute_force(spark, folder):
    frame = spark.read.parquet(f"{folder}/conversations.parquet")
    expected = brute_report([(r.conv_id, r.turn, r.role, r.text) for r in frame.collect()])
    found = sorted(map(tuple, repair.op12_conversations(spark, folder).collect()), key=str)
    assert found == expected


@pytest.fixture(scope="module")
def odd_turns():
    pick = np.random.default_rng(12)
    rows = []
    for conv in range(120):
        for turn in range(int(pick.integers(0, 9))):
            role = ["system", "user", "assistant", "tool", "", None][int(pick.choice(6, p=[.1, .4, .35, .05, .05, .05]))]
            text = [f"Text {turn}.", "same!", "cut off", " \t", "", None, "é😀?\n"][int(pick.integers(7))]
            rows.append((conv, None if pick.random() < 0.02 and not turn else 2 * turn + int(pick.integers(2)), role, text))
    rows += [(1000, turn, ["user", "assistant"][turn % 2 ^ (turn % 17 == 0)], f"Row {turn % 210}{'.' if turn % 5 else ''}")
             for turn in range(700)]
    rows += [(None, 0, "user", "Hello."), (None, 1, "assistant", "x" * 200_000)]
    return rows


@pytest.mark.parametrize("rows, size", [(4096, 1 << 22), (7, 1 << 22), (1, 50)])
def test_odd_conversations_in_pieces(spark, odd_turns, monkeypatch, rows, size):
    monkeypatch.setattr(repair, "PIECE_ROWS", rows)
    monkeypatch.setattr(repair, "PIECE_BYTES", size)
    frame = spark.createDataFrame([(*r, 1, "c", 2) for r in odd_turns], TURNS).repartition(5)
    assert reported(repair.damaged(frame)) == brute_report(odd_turns)


def test_every_short_conversation(spark):
    shapes = [list(zip(roles, texts)) for n in range(1, 4)
              for roles in product("suat", repeat=n) for texts in product(("A.", "B", ""), repeat=n)]
    rows = [(number, turn, role, f"{text and turn}{text}") for number, shape in enumerate(shapes)
            for turn, (role, text) in enumerate(shape)]
    frame = spark.createDataFrame([(*r, 1, "c", 2) for r in rows], TURNS).select("conv_id", "turn", "role", "text")
    assert reported(frame) == brute_report(rows, damage=False)


def test_repaired_turns_are_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Bye!")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    pieces = repair.repair(frame)
    assert "".join(r.edits for r in pieces.orderBy("seq").collect()) == "KIKKI"
    assert [tuple(r) for r in repair.turns(pieces).orderBy("seq", "place").select("role", "text").collect()] == [
        ("system", "Be kind."), ("user", ""), ("assistant", "Hello."), ("user", "Bye!"), ("assistant", "")]


def test_no_conversations(spark):
    assert reported(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")) == []


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    rows = [(1, 0, role, text) for role in ("user", "assistant") for text in ("A.", "B", "C!", "A.")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    assert reported(frame) == reported(frame.repartition(3)) == reported(frame.orderBy("text"))
