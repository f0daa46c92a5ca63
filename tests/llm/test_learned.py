"""Operators that are probable or learned: near copies, leaks, languages, and the pipeline."""

import collections
import random

import numpy as np
import pytest

import corpus_pipeline
from lakeline.llm import boosting, languages, leaks, near_copies
from lakeline.llm.graph import components
from lakeline.llm.words import Words

FOLDER = "/root/testdata/sf0.001"
BENCHMARK = "item_id bigint, text string, doc_id int"


def words_of(text, vocabulary=400):
    pick = random.Random(text)
    return [f"{pick.choice('bdgkmnprst')}{pick.choice('aeiou')}{pick.randint(0, vocabulary)}" for _ in range(120)]


def edited(words, edits, seed):
    pick, words = random.Random(seed), list(words)
    for number in range(edits):
        at = pick.randrange(len(words))
        kind = pick.random()
        if kind < 0.4:
            words[at] = f"new{seed}x{number}"
        elif kind < 0.7:
            del words[at]
        else:
            words.insert(at, f"put{seed}x{number}")
    return words


def shingle_share(one, other):
    one, other = ({tuple(words[at:at + 5]) for at in range(max(1, len(words) - 4))} for words in (one, other))
    return len(one & other) / len(one | other)


def unioned(pairs, nodes):
    root = {node: node for node in nodes}

    def find(node):
        while root[node] != node:
            node = root[node]
        return node

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {node: find(node) for node in nodes}


def test_components(spark):
    pick = random.Random(1)
    pairs = [(n, n + 1) for n in range(40)] + [(pick.randint(100, 400), pick.randint(100, 400)) for _ in range(150)]
    pairs += [(500, n) for n in range(501, 700)] + [(7, 7)]
    pairs = [(f"{a:04}", f"{b:04}") for a, b in pairs]
    found = {row.node: row.root for row in components(spark.createDataFrame(pairs, "a string, b string")).collect()}
    nodes = {node for pair in pairs for node in pair if pair[0] != pair[1]}
    assert found == {node: root for node, root in unioned(pairs, {n for p in pairs for n in p}).items() if node in nodes}
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_near_copies_find_all_similar_texts(spark, monkeypatch):
    """Every pair at the similarity shares a class; buckets above the size limit are split, not cut."""
    monkeypatch.setattr(near_copies, "SMALL", 4)
    texts = []
    for group in range(25):
        base = words_of(group)
        texts += [base] + [edited(base, random.Random((group, n).__hash__()).randint(0, 3), group * 50 + n) for n in range(group % 9)]
    texts += [words_of(f"alone {n}") for n in range(60)]
    docs = spark.createDataFrame([(n, " ".join(words)) for n, words in enumerate(texts)], "doc_id bigint, text string")
    found = {row.doc_id: row.class_id for row in near_copies.classes(docs).collect()}
    similar = [(a, b) for b in range(len(texts)) for a in range(b) if shingle_share(texts[a], texts[b]) >= 0.8]
    assert len(similar) > 100
    want = unioned(similar, range(len(texts)))
    # the alignment may match less than the sets do in a pair or two, never more
    assert sum(found[a] != found[b] for a, b in similar) <= 0.01 * len(similar)
    assert all(want[a] == want[b] for a in found for b in found if found[a] == found[b] and a < b)


def test_near_copies_join_every_pair_at_the_similarity(spark, monkeypatch):
    """A text and the same over and over share few sketches, but all k-mers. Phrases of many texts, and copies, change nothing."""
    monkeypatch.setattr(near_copies, "COMMON", 2)
    texts = []
    for group in range(30):
        base = words_of(f"near {group}")[:60] + words_of(f"phrase {group % 3}")[:20]
        texts += [base, edited(base, 2, group), base[:30] * 2, base[:30] * 20]
    docs = spark.createDataFrame(
        [(n, " ".join(words)) for n, words in enumerate(texts + texts[:20])], "doc_id bigint, text string")
    found = {row.doc_id: row.class_id for row in near_copies.classes(docs).collect()}
    hashes = [near_copies._wide(near_copies._narrow(Words([" ".join(words).encode()]).hashes[0])) for words in texts]
    near = [(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts))
            if near_copies.aligned_share(hashes[a], hashes[b]) >= near_copies.SIMILARITY]
    assert {(a, a + 1) for a in range(2, len(texts), 4)} <= set(near)
    assert {n: found[n] for n in range(len(texts))} == unioned(near, range(len(texts)))
    assert all(found[len(texts) + n] == found[n] for n in range(20))


def test_near_copies_meet_at_rare_runs(spark):
    """Variants of one text that are no links are not made into pairs of each with each; those at the similarity all are."""
    from lakeline.session import Scratch

    base, texts = words_of("variants") * 2, []
    base = [f"{word}{place}" for place, word in enumerate(base)][:144]
    for n in range(160):
        places = random.Random(n).sample(range(0, 144, 6), 5)
        texts.append([f"own{n}" if place in places else word for place, word in enumerate(base)])
    texts += [[*text[:70], f"more{n}", *text[70:]] for n, text in enumerate(texts[:20])]
    hashes = [Words([" ".join(words).encode()]).hashes[0] for words in texts]
    seqs = spark.createDataFrame([(n, bytearray(near_copies._narrow(own))) for n, own in enumerate(hashes)], "mark bigint, seq binary")
    placed = seqs.selectExpr("mark", "mark AS node", "mark AS root")
    first = near_copies.rare_runs(seqs, placed, 0.8, Scratch(spark, "meeting"))
    sets = [set(near_copies.shingles(near_copies._wide(near_copies._narrow(own))).tolist()) for own in hashes]
    similar = {(a, b) for b in range(len(sets)) for a in range(b) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    found = {tuple(row) for row in near_copies.sharing(first, 0.8).collect()}
    assert {(n, n + 160) for n in range(20)} <= similar <= found
    assert near_copies.meeting(first, 0.8).count() < 10 * len(texts) and len(found) < 2 * len(texts)


def test_near_copies_outlines_deny_no_similar_pair(spark):
    pick = np.random.default_rng(8)
    words = [pick.integers(1, 2**62, size).astype(np.uint64) for size in (4, 30, 400, 3000)]
    pairs = [(own, own) for own in words]
    for own in words[1:]:
        for share in (0.005, 0.02, 0.05, 0.3):
            changed = own.copy()
            changed[pick.random(len(own)) < share] = 1
            pairs += [(own, changed), (own, own[:int(len(own) * (1 - share))])]
    pairs += [(words[2], np.concatenate((words[2][:40], words[1]))), (words[3], words[3][::-1].copy())]
    near = [near_copies.aligned_share(a, b) >= near_copies.SIMILARITY for a, b in pairs]
    outlines = [np.stack([near_copies.outline(text) for text in side]) for side in zip(*pairs)]
    may = near_copies.may_reach(*outlines, near_copies.SIMILARITY)
    assert any(near) and may[near].all() and not may[-2:].any()
    # counts beyond a byte say nothing
    long = [pick.integers(1, 2**62, 90_000).astype(np.uint64) for _ in range(2)]
    assert near_copies.may_reach(*(near_copies.outline(text)[None] for text in long), 0.8).all()

    nodes = spark.createDataFrame([(n, bytearray(near_copies.outline(own).tobytes())) for n, own in enumerate(
        [*words, words[3]])], "node bigint, outline binary")
    met = spark.createDataFrame([(2, 3), (3, 4), (0, 1)], "a bigint, b bigint")
    assert [tuple(row) for row in near_copies.promising(met, nodes, 0.8).collect()] == [(3, 4)]


def test_near_copies_shuffle_whole_rows_once(spark):
    docs = spark.createDataFrame([(n, f"some words of text {n // 2} that are here " * 4) for n in range(8)], "doc_id bigint, text string")
    kept = near_copies.keep_one(docs)
    # an aggregate over rows takes the first text of each group
    assert "first(text" not in kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(row.doc_id for row in kept.collect()) == [0, 2, 4, 6]


def test_alignment_needs_order():
    words = Words([" ".join(words_of("a")).encode()]).hashes[0]
    moved = np.concatenate((words[60:], words[:60]))
    assert near_copies.aligned_share(words, words) == 1
    assert near_copies.aligned_share(words, moved) < 0.6
    values = np.array([3, 1, 2, 9, 4, 5, 0])
    assert values[near_copies.longest_rise(values)].tolist() == [1, 2, 4, 5]


def test_near_copies_edges(edge, empty):
    rows = near_copies.classes(edge).collect()
    assert len(rows) == edge.count() and near_copies.classes(empty).count() == 0
    assert {row.class_id for row in rows if row.wordless} == {0, 1, 2, None}
    kept = near_copies.keep_one(edge)
    assert {tuple(row) for row in kept.collect()} <= {tuple(row) for row in edge.collect()}
    assert kept.columns == edge.columns and near_copies.keep_one(empty).count() == 0
    worded = [row.text for row in kept.collect() if (row.text or "").strip()]
    assert len(worded) == len(set(worded)) == 6  # of the base text, its copies and its near copy one is left


@pytest.fixture(scope="module")
def items():
    pick = random.Random(8)
    return [[f"{pick.choice('bdgkmnprst')}{pick.choice('aeiou')}{pick.randint(0, 60)}" for _ in range(pick.randint(15, 60))] for _ in range(60)]


@pytest.mark.parametrize(("share", "least"), [(0.0, 1.0), (0.1, 0.999), (0.2, 0.95)])
def test_leaks_recall(items, share, least):
    known = leaks.index(list(range(len(items))), [" ".join(words).encode() for words in items])
    filler = words_of("filler", 30)
    texts = [" ".join(filler[:seed % 50] + edited(words, int(share * len(words)), seed) + filler)
             for seed in range(5) for words in items]
    found = {(text, item): distance for text, item, distance, _ in leaks.leaks(Words([t.encode() for t in texts]), known)}
    assert np.mean([(n, n % len(items)) in found for n in range(len(texts))]) >= least
    for (text, item), distance in found.items():
        exact, _ = leaks.edit_distance(known.words[item], Words([texts[text].encode()]).hashes[0])
        assert exact <= distance <= leaks.EDITS * len(items[item])


def test_edit_distance():
    item = np.array([1, 2, 3, 4, 5])
    assert leaks.edit_distance(item, np.array([9, 1, 2, 3, 4, 5, 9])) == (0, 6)
    assert leaks.edit_distance(item, np.array([9, 1, 3, 4, 7, 5, 9]))[0] == 2
    assert leaks.edit_distance(item, np.zeros(0, int)) == (5, 0)


def test_leaks_edges(spark, edge, empty, items, monkeypatch):
    monkeypatch.setattr(leaks, "INDEX_WORDS", 40)  # several passes
    long = edge.where("length(text) > 100000 AND text LIKE '% %'").first().text
    benchmark = spark.createDataFrame(
        [(1, " ".join(long.split()[20_000:20_040]), 0), (2, None, 0), (3, "", 0), (4, "short text", 0), (None, "a b c d e", 0),
         (1, " ".join(long.split()[20_000:20_040]), 0)], BENCHMARK)
    found = leaks.find(edge, benchmark).collect()
    assert [(row.doc_id, row.item_id, row.edit_distance, row.end_word) for row in found] == [(6, 1, 0, 20_040)]
    kept = leaks.clean(edge, benchmark)
    assert kept.columns == edge.columns and kept.count() == edge.count() - 1
    assert leaks.find(empty, benchmark).count() == leaks.find(edge, benchmark.limit(0)).count() == 0


def test_languages_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {row.doc_id: row for row in languages.predict(docs, languages.learn(docs)).collect()}
    held = [(rows[row.doc_id].lang_pred, row.lang) for row in docs.collect() if rows[row.doc_id].held_out]
    assert len(held) > 150 and np.mean([found == lang for found, lang in held]) > 0.97
    assert all(0 <= row.score <= 1 for row in rows.values())


def test_languages_edges(spark, edge, empty):
    model = languages.learn(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    rows = languages.predict(edge.select("*"), model).collect()
    assert len(rows) == edge.count()
    assert collections.Counter(row.lang_pred == "und" for row in rows)[True] == 5
    assert all(row.held_out for row in rows if row.doc_id is None)
    assert languages.learn(empty) is None and languages.predict(empty, None).count() == 0
    assert {row.lang_pred for row in languages.predict(edge, None).collect()} == {"und"}


def test_boosting():
    pick = np.random.default_rng(4)
    rows = pick.random((3000, 5))
    truth = ((rows[:, 0] > 0.5) ^ (rows[:, 1] > 0.3)).astype(float)
    scores = boosting.fit(rows[:2000], truth[:2000]).score(rows[2000:])
    assert np.mean((scores > 0.5) == truth[2000:]) > 0.95
    limit = boosting.threshold(scores, truth[2000:], 0.98, 20)
    assert truth[2000:][scores >= limit].mean() >= 0.98
    assert boosting.threshold(scores, np.zeros(1000), 0.98, 20) == float("inf")


def test_pipeline(spark):
    folder, names = FOLDER, [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "decontamination", "personal_data", "encoding"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left, before = stage(spark, left, folder).cache(), left
        assert left.columns == docs.columns
        if name == "personal_data":
            assert left.count() == before.count()
        else:
            assert left.exceptAll(before).count() == 0
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {row.doc_id for row in rows} == {row.doc_id for row in left.collect()}
    assert 0.5 * docs.count() < len(rows) < docs.count()
