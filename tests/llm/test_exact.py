"""Operators with an exact brute-force twin: licenses, tokens, repeats, measures, spans, archives."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeline.llm import bpe, licenses, personal, quality, repeats, warc, wavelet
from lakeline.llm.license_rules import Rule
from lakeline.llm.words import Words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_row(rows, *names):
    return collections.Counter(tuple(row[name] for name in names) for row in rows)


def test_words_are_those_of_the_pattern():
    texts = ["", " ", "a", " a\tbb\n", "é x y" * 3, "w" * 9000 + " z", "a b"]
    words = Words([text.encode() for text in texts], seeds=2)
    found = [words.bytes_of(n).decode() for n in range(len(words.starts))]
    assert found == [word for text in texts for word in WORD.findall(text)]
    assert words.counts.tolist() == [len(WORD.findall(text)) for text in texts]
    for hashes in words.hashes:
        assert len(set(zip(hashes.tolist(), found))) == len(set(hashes.tolist())) == len(set(found))


def license_row(text):
    words = re.findall(licenses.WORD, (text or "").translate(str.maketrans(licenses.UPPER, licenses.LOWER)))
    phrases = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}
    starts, labels = [], set()
    for label, phrase in phrases.items():
        for at in range(len(words)):
            if words[at:at + len(phrase)] == phrase:
                starts.append(at)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_license_base(spark, documents, edge):
    odd = spark.createDataFrame([(1, "CC BY cc-by, CC\nby; GENERAL public\tLicense all rights reserved É all"),
                                 (2, "ccby cc é by")], "doc_id bigint, text string")
    for docs in (documents, edge, odd):
        found = licenses.scan(docs)
        rows = found.selectExpr(
            "n_words", "size(base) n_base", "array_min(base.first) first", "array_max(base.first) last", "base_labels")
        assert by_row(rows.collect(), "n_words", "n_base", "first", "last", "base_labels") == collections.Counter(
            license_row(row.text) for row in docs.collect())


def test_license_rules_resolve(spark):
    text = "Licensed under the Apache License, Version 2.0. x MIT license; GNU General Public License v3"
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert row.labels == "apache-2.0,gpl,gpl-3.0,mit"
    rules = [Rule(3, "first", "a", 0.5, "a b c"), Rule(4, "inner", "b", 0.5, "b"), Rule(5, "later", "c", 0.5, "c d e"),
             Rule(6, "twin", "a", 0.5, "a b c"), Rule(7, "free", "z", 0.5, "z")]
    row = licenses.scan(spark.createDataFrame([(1, "a b c d e z z")], "doc_id bigint, text string"), rules).first()
    assert [(hit.first, hit.last, hit.number) for hit in row.detections] == [(0, 2, 3), (5, 5, 7), (6, 6, 7)]
    assert row.score == pytest.approx(1 - 0.25)


def resolved_by_hand(hits):
    """Layer by layer, over all hits."""
    within = lambda h, o: o[0] <= h[0] and h[1] <= o[1] and (o[:2] != h[:2] or o[2] < h[2])
    overlap = lambda h, o: h[0] <= o[1] and o[0] <= h[1]
    left, kept = sorted(set(hits)), []
    while left:
        for hit in sorted((h for h in left if not any(within(h, o) for o in left)), key=lambda h: (h[2], h[0], h[1])):
            if not any(overlap(hit, other) for other in kept):
                kept.append(hit)
        left = [h for h in left if not any(overlap(h, other) for other in kept)]
    return sorted(kept)


def test_license_detections_lose_only_to_what_stays(spark):
    cases = [[(0, 2, 5), (2, 5, 4), (5, 7, 3)], [(1, 2, 9), (0, 4, 8), (4, 6, 1)], [], [(3, 3, 1)], [(0, 1, 2), (0, 1, 2)]]
    pick = random.Random(4)
    for _ in range(300):
        starts = [pick.randrange(20) for _ in range(pick.randrange(12))]
        cases.append(sorted({(at, at + pick.randrange(6), pick.randrange(9)) for at in starts}))
    hits = [[dict(zip(("first", "last", "number"), hit)) for hit in case] for case in cases]
    frame = spark.createDataFrame(list(enumerate(hits)), f"id int, hits {licenses.HITS}")
    rows = frame.select("id", licenses._resolved(F.col("hits")).alias("kept")).orderBy("id").collect()
    assert [tuple(h) for h in rows[0].kept] == [(0, 2, 5), (5, 7, 3)]
    assert [tuple(h) for h in rows[1].kept] == [(1, 2, 9), (4, 6, 1)]
    for case, row in zip(cases, rows):
        assert [tuple(h) for h in row.kept] == resolved_by_hand(case)


def test_license_of_very_long_texts(spark):
    years = "copyright " + " ".join(str(1950 + n % 70) for n in range(100_000))
    many = "copyright 2019 20211 x mit license " * 3000
    rows = licenses.scan(spark.createDataFrame([(1, years), (2, many)], "doc_id bigint, text string")).orderBy("doc_id").collect()
    assert rows[0].labels == "copyright-notice" and tuple(rows[0].detections[0])[:2] == (0, 100_000)
    assert len(rows[1].detections) == 6000 and tuple(rows[1].detections[0])[:2] == (0, 1)


def test_license_empty(empty):
    assert licenses.scan(empty).count() == 0


HARD = ["", " ", "  ", "a  b", "a \n b", " a", "\n\n x", "\t x y\t", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>",
        "x" * 3000, "é" * 50, "日本語 テスト", "²³ ½ x", "\x00a", "😀😀 a", "a\xa0b", "don't I'll 've '' s's", "12 345", "\x1c a", "\x85",
        "।१२३ हिन्दी", "ª º × ÷ «µ»"]


def test_bpe_is_the_librarys(spark):
    pick = random.Random(5)
    letters = "ab cd'se 12\n\t.,!é ü\xa0²中_"
    texts = HARD + ["".join(pick.choice(letters) for _ in range(pick.randint(1, 60))) for _ in range(1500)]
    library = Tokenizer.from_file(bpe.tokenizer_path())
    codes = library.encode_batch(texts, add_special_tokens=False)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {row.doc_id: row for row in bpe.encode_digests(rows).collect()}
    for number, code in enumerate(codes):
        shown = ",".join(map(str, code.ids))
        assert (found[number].n_tokens, found[number].ids_sha256) == (len(code.ids), sha(shown)), texts[number]
        assert found[number].decoded_sha256 == sha(library.decode(code.ids, skip_special_tokens=False))
    for row in bpe.encode(rows.limit(30)).collect():
        assert list(row.ids) == codes[row.doc_id].ids


def test_bpe_checks_agree_with_merging():
    known = bpe.vocabulary(bpe.tokenizer_path())
    pick = random.Random(3)
    words = [bytes(pick.choice(b"abcdeghinorst ") for _ in range(pick.randint(1, 12))) for _ in range(4000)]
    words += [token for token in known.bytes[::97]]
    tokens, _ = known.words(words)
    assert tokens == [known.merge(word) for word in words]
    long = [bytes(pick.choice(b"abc ") for _ in range(pick.randint(40, 200))) for _ in range(60)]
    assert all(known._merge_short(word) == known._merge_long(word) for word in long)


def test_bpe_edges(edge, empty):
    rows = bpe.encode_digests(edge).collect()
    assert len(rows) == edge.count() and bpe.encode_digests(empty).count() == 0
    assert {row.ids_sha256 for row in rows if row.n_tokens == 0} == {sha("")}


def test_wavelet_matrix():
    ids = np.random.default_rng(1).integers(0, 300, 1999)
    matrix = wavelet.WaveletMatrix.build(ids)
    assert (matrix.ids() == ids).all()
    assert all(matrix.access(place) == ids[place] for place in range(0, len(ids), 31))
    for token in (0, 7, 299, 300, 100_000):
        assert matrix.count(token, 1500) == (ids[:1500] == token).sum()
        assert matrix.places(token) == np.flatnonzero(ids == token).tolist()
    with pytest.raises(IndexError):
        matrix.select(7, 10_000)
    assert wavelet.WaveletMatrix.build(np.zeros(0, np.uint32)).ids().tolist() == []


@pytest.mark.parametrize("shard_tokens", [500, 1 << 22])
def test_shards_read_back(documents, shard_tokens):
    library = Tokenizer.from_file(bpe.tokenizer_path())
    docs = sorted(documents.select("doc_id", "text").collect())
    want, start = {}, 0
    for row, code in zip(docs, library.encode_batch([row.text or "" for row in docs], add_special_tokens=False)):
        ids = np.array([*code.ids, 0], "<u4")
        want[row.doc_id] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    manifest = wavelet.write_tokens(documents, shard_tokens=shard_tokens)
    found = wavelet.read_documents(manifest).collect()
    assert {row.doc_id: (row.start, row.n_tokens, row.ids_crc32) for row in found} == want and len(found) == len(docs)


def test_shards_edges(edge, empty):
    found = sorted(wavelet.read_documents(wavelet.write_tokens(edge)).collect(), key=lambda row: row.start)
    assert len(found) == edge.count() and found[0].doc_id is None and found[0].start == 0
    assert all(a.start + a.n_tokens == b.start for a, b in zip(found, found[1:]))
    assert wavelet.read_documents(wavelet.write_tokens(empty)).count() == 0


def test_repeats(spark, documents, edge):
    passage = " ".join(f"p{n}" for n in range(45))
    odd = spark.createDataFrame(
        [(n, f"{' '.join(f'{n}w{k}' for k in range(n * 3))} {passage} tail{n}") for n in range(30)]
        + [(40, "k " * 70), (41, passage[:60]), (42, None), (43, "")], "doc_id bigint, text string")
    for docs in (documents, odd, edge.where("doc_id IS NULL OR doc_id <> 3").dropDuplicates(["doc_id"])):
        rows = sorted(docs.select("doc_id", "text").collect(), key=lambda row: (row.doc_id is not None, row.doc_id))
        seen, want = {}, collections.Counter()
        texts = [(row.doc_id, WORD.findall(row.text or "")) for row in rows]
        for number, (_, words) in enumerate(texts):
            for at in range(len(words) - 19):
                seen.setdefault(tuple(words[at:at + 20]), (number, at))
        for number, (doc_id, words) in enumerate(texts):
            gone = set()
            for at in range(len(words) - 19):
                if seen[tuple(words[at:at + 20])] < (number, at):
                    gone.update(range(at, at + 20))
            kept = " ".join(word for at, word in enumerate(words) if at not in gone)
            want[doc_id, len(words), len(gone), sha(kept)] += 1
        assert by_row(repeats.without_repeats(docs, True).collect(), "doc_id", "n_words", "n_removed", "kept_sha256") == want


def test_repeats_of_shared_ids(edge, empty):
    """Rows that share an id are no copies of each other; those of a smaller id are."""
    rows = repeats.without_repeats(edge).collect()
    assert len(rows) == edge.count() and repeats.without_repeats(empty).count() == 0
    assert sorted(row.n_removed for row in rows if row.doc_id == 3) == [0, 120, 120]


def quality_row(text):
    text = text or ""
    words = WORD.findall(text)
    counts = collections.Counter(tuple(words[at:at + 8]) for at in range(len(words) - 7))
    covered = {place for at in range(len(words) - 7) if counts[tuple(words[at:at + 8])] > 1 for place in range(at, at + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered), failed)


def test_quality_measures(spark, documents, edge, empty):
    odd = spark.createDataFrame([(1, "a\nb\na\n \n#é <b> 12\n" * 4), (2, "u " * 40), (3, "x y z")], "doc_id bigint, text string")
    for docs in (documents, edge, odd, empty):
        rows = quality.with_measures(docs).select("__measures.*", quality.base_failed().alias("base_failed")).collect()
        names = [*quality.MEASURES[:5], "base_failed"]
        assert by_row(rows, *names) == collections.Counter(quality_row(row.text) for row in docs.collect())


def test_quality_rules_learn():
    pick = np.random.default_rng(2)
    values = {name: pick.random(3000) for name in quality.SHARES}
    bad = (values["symbols"] > 0.8) & (values["upper"] > 0.5) | (values["digits"] > 0.9)
    rules = quality.learned(values, bad)
    caught = np.zeros(3000, bool)
    for rule in rules:
        held = np.ones(3000, bool)
        for condition in rule.conditions:
            held &= condition.holds(values)
        caught |= held
    assert (caught & bad).sum() > 0.8 * bad.sum() and (caught & ~bad).sum() < 0.02 * (~bad).sum()
    assert quality.learned(values, np.zeros(3000, bool)) == []


def test_quality_rules_learn_from_few_bad_rows():
    pick = np.random.default_rng(6)
    values = {name: pick.random(400) for name in quality.SHARES}
    bad = values["symbols"] > 0.93  # 28 rows, so about nine in the part that prunes
    rules = quality.learned(values, bad)
    assert 20 <= bad.sum() <= 36 and [rule.conditions[0].share for rule in rules] == ["symbols"]
    mixed = pick.random(400) < 0.07
    assert quality.learned(values, mixed) == []
    assert quality.lower_bound(1.0, 7) > 0.8 > quality.lower_bound(1.0, 6) and quality.lower_bound(0.9, 0) == 0


def test_quality_keeps_columns(edge, empty, spark):
    labels = spark.createDataFrame([(3, 1), (3, 0), (None, 1), (5, None)], "doc_id bigint, quality int")
    kept = quality.keep_good(edge, labels)
    assert kept.columns == edge.columns
    assert collections.Counter(row.text for row in kept.collect()) == collections.Counter(
        row.text for row in edge.collect() if not quality_row(row.text)[-1])
    assert not collections.Counter(map(tuple, kept.collect())) - collections.Counter(map(tuple, edge.collect()))
    assert quality.keep_good(empty, labels).count() == quality.keep_good(edge, labels.limit(0)).count() - kept.count() == 0


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def slow_spans(text):
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match.group())
            if kind == "ip" and any(int(part) > 255 for part in match.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and personal._luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((match.start(), rank, match.end()))
    return ",".join(f"{personal.KINDS[rank]}:{start}:{end}" for start, rank, end in sorted(found))


def test_strict_spans():
    pick = random.Random(2)
    parts = ["1", "23", ".", "@", "a", "b-c", "+", " ", "(", ")", "-", "4012888888881881", "\n", "é", "255", "x.y", "%"]
    for _ in range(20_000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(1, 25)))
        assert personal.listed(personal.strict(text)) == slow_spans(text), text
    assert personal.strict("1" * 20_000 + "@" + "." * 20_000) == []


def test_personal_adds_and_redacts(spark, edge, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = personal.learn(docs)
    rows = {row.doc_id: row for row in personal.find(docs, model).collect()}
    for row in docs.select("doc_id", "text").collect():
        base = slow_spans(row.text or "")
        assert rows[row.doc_id].base_sha256 == sha(base)
        assert set(filter(None, base.split(","))) <= set(rows[row.doc_id].spans.split(","))
    text = "mail jo.doe@mail.example.com or +1 (555) 010-9999 now"
    row = personal.redact(spark.createDataFrame([(1, text, 7)], "doc_id bigint, text string, found int"), model).first()
    assert (row.text, row.found) == ("mail <email> or <phone> now", 7)
    assert personal.learn(empty) is None and personal.redact(empty, None).columns == empty.columns
    clean = personal.redact(edge, None)
    assert by_row(clean.collect(), "doc_id", "text") == by_row(edge.collect(), "doc_id", "text")


def test_warc(spark):
    big, other = "<p>é</p>" * 300, "<b>" * 400
    rows = [(1, "u", big, 0), (2, "u 2\r\nx", big, 0), (3, None, "small", 0), (4, "u", "small", 0), (5, "u", None, 0),
            (6, "u", "", 0), (7, "u", big, 0), (7, "u", big, 0), (None, "u", big, 0), (9, "u", other, 0), (None, None, None, 0)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, digest int").repartition(3)
    manifest = warc.write_archives(pages, archive_bytes=500)
    found = warc.read_archives(manifest).collect()
    assert collections.Counter((row.page_id, row.record_type, row.refers_to) for row in found) == collections.Counter(
        [(n, "revisit", 7) for n in (1, 2, None)] + [(7, "response", None)] * 2
        + [(n, "response", None) for n in (3, 4, 5, 6, 9, None)])
    for row in found:
        if row.record_type == "response":
            assert hashlib.sha1(row.payload).hexdigest() == row.payload_digest and len(row.payload) == row.payload_bytes
    assert {row.payload_bytes for row in found if row.record_type == "revisit"} == {len(big.encode())}
    path = manifest.first().path
    assert int.from_bytes(open(path.removeprefix("file:"), "rb").read(4), "little") == warc.SKIPPABLE
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0
