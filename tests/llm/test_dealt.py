"""Importance resampling, filter audit and anchored repeats on small tables, each against a plain computation."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from meterline.llm import anchors, filter_audit, importance, packs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# importance resampling

def test_position_table_gives_crc32():
    table = importance.PositionTable(8)
    raw = np.random.default_rng(1).integers(0, 256, 3000).astype(np.uint8)
    r = random.Random(2)
    spans = [(0, 3000), (5, 6), (0, 8), (0, 9), (7, 23), (1, 17)]
    spans += [(a, r.randint(a + 1, min(3000, a + 90))) for a in (r.randrange(2999) for _ in range(400))]
    begin, end = (np.array(x) for x in zip(*spans))
    assert table.crcs(raw, begin, end).tolist() == [zlib.crc32(raw[a:b].tobytes()) for a, b in spans]
    assert importance.PositionTable().crcs(raw, begin, end).tolist() == [zlib.crc32(raw[a:b].tobytes()) for a, b in spans]
    assert len(table.crcs(raw, begin[:0], end[:0])) == 0


def plain_features(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain_resample(rows, target, percent, least, buckets):
    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in plain_features(t)[1])
    s, t = counts(x for _, x in rows), counts(target)
    total = lambda c: sum(c.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total(s) + buckets) / ((s[b] + 1) * (total(t) + buckets)))) for b in range(buckets)]
    out = []
    for doc, text in rows:
        words, feats = plain_features(text)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in feats)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(feats), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= least])
    order = sorted((r for r in out if r[4]), key=lambda r: (-r[3], -1 if r[0] is None else r[0], r[1], r[2]))
    drawn = order[:len(order) * percent // 100]
    return sorted(((*r[:4], next((i + 1 for i, d in enumerate(drawn) if d is r), None)) for r in out), key=repr)


def test_resampling(spark, docs, prose, rows):
    texts = [(i, prose(5 + 3 * i, i)) for i in range(40)]
    texts += [(50, None), (51, ""), (None, prose(30, 3)), (52, "Ünïcode 漢字漢字漢字漢字漢字漢字漢字漢字漢字漢字漢字漢字漢字漢字 -- 1a2B\x00c " * 9),
              (53, "x" * 5000 + " y" * 30), (54, prose(30, 3)), (55, prose(30, 3)), (55, prose(30, 3)), (56, "...!?"), (57, prose(4000, 9))]
    target = [prose(60, 3), prose(40, 7), None, ""]
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    for percent in (5, 40, 100):
        got = importance.resample(docs(texts, clash=True), bench, percent=percent, least_words=20, buckets=997)
        assert rows(got, "doc_id", "n_features", "weight", "score", "rank") == plain_resample(texts, target, percent, 20, 997)
    ranks = importance.resample(docs(texts), bench, percent=20)
    assert importance.drawn_documents(docs(texts, clash=True), ranks).columns == docs(texts, clash=True).columns
    assert importance.resample(docs([]), bench).count() == 0
    assert importance.resample(docs(texts), bench.limit(0)).count() == len(texts)


# filter audit

def plain_audit(table, labels):
    def fails(doc, text):
        text = text or ""
        words = WORD.findall(text)
        smaller = [d for d, t, _ in table if (t or "") == text and d is not None and doc is not None and d < doc]
        return [len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
                bool(re.search("[#$%&*|]", text)), bool(smaller)]
    judged = [(lang or "", dict(zip("ABCDE", fails(doc, text))), any(d == doc and q == 1 for d, q, _ in labels if doc is not None),
               any(d == doc and t == 1 for d, _, t in labels if doc is not None)) for doc, text, lang in table]
    out = []
    for part in {j[0] for j in judged}:
        own = [j for j in judged if j[0] == part]
        shapley = Counter()
        lines = []
        for order in itertools.permutations("ABCDE"):
            for i, f in enumerate(order):
                alive = [j for j in own if not any(j[1][x] for x in order[:i])]
                hit = [j for j in alive if j[1][f]]
                shapley[f] += len(hit)
                lines.append((part, "".join(order), i + 1, len(alive) - len(hit), len(hit), sum(j[1][f] for j in own) - len(hit),
                              sum(j[1][f] and sum(j[1].values()) == 1 for j in own), sum(j[2] for j in hit), sum(j[3] for j in hit), f))
        out += [(*line[:-1], shapley[line[-1]]) for line in lines]
    return sorted(out, key=repr)


AUDIT = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_filter_audit(spark, prose, rows):
    shapes = [prose(120, 1), prose(20, 2), "ABC DEF " * 60, prose(110, 4) + " #", "", None, "a b " * 80, prose(130, 5).upper(), " \t\n ", prose(120, 1) + "$ " + prose(30, 6)]
    r = random.Random(4)
    table = [(r.randrange(60) if r.random() < 0.9 else None, r.choice(shapes), r.choice(["en", "de", None, ""])) for _ in range(150)]
    table += [(100 + i, prose(150, 100 + i), "clean") for i in range(3)]
    table += [(200 + i, shapes[0], "hot") for i in range(50)]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(0, 260, 2) for _ in range(r.choice([1, 1, 2]))] + [(None, 1, 1)]
    schema = "doc_id long, text string, lang string"
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    frame = spark.createDataFrame(table, schema)
    clash = frame.selectExpr("*", *(f"'x' AS {c}" for c in ("row", "part", "filter", "prefix", "digest", "good", "n", "A")))
    assert rows(filter_audit.audit(clash, marks), *AUDIT) == plain_audit(table, labels)
    assert filter_audit.audit(frame.limit(0), marks).count() == 0
    assert rows(filter_audit.audit(frame, marks.limit(0)), *AUDIT) == plain_audit(table, [])


# anchored repeats

def plain_repeats(table, length):
    low = -1 << 63
    first = {}
    for doc, text in table:
        words = WORD.findall(text or "")
        for i in range(len(words) - length + 1):
            key, at = tuple(words[i:i + length]), (low if doc is None else doc, i)
            first[key] = min(first.get(key, at), at)
    out = []
    for doc, text in table:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - length + 1):
            if first[tuple(words[i:i + length])] < (low if doc is None else doc, i):
                gone[i:i + length] = [True] * length
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(words), sum(gone), runs, " ".join(w for w, g in zip(words, gone) if not g)))
    return sorted(out, key=repr)


@pytest.fixture
def shared(prose):
    r = random.Random(8)
    passages = [prose(r.randint(15, 60), 1000 + i) for i in range(12)]
    table = []
    for i in range(150):
        parts = [prose(r.randint(0, 40), i)]
        for _ in range(r.randint(0, 3)):
            parts += [r.choice(passages), prose(r.randint(0, 25), 5000 + r.randrange(10 ** 6))]
        table.append((i, r.choice([" ", "\n", " \t "]).join(parts)))
    table += [(200 + i, table[3][1]) for i in range(40)] + [(300, "tick tock " * 100), (301, None), (302, ""), (303, " \x0b\x0c "), (304, "une fée " * 30)]
    table += [(None, table[5][1]), (None, table[6][1]), (7, table[8][1]), (400, table[9][1]), (400, table[9][1]), (400, "Uno " + table[9][1])]
    return table + [(500, prose(30000, 77)), (501, prose(30000, 77).upper() + " " + passages[0])]


@pytest.mark.parametrize("length", [20, 7])
def test_repeats(docs, shared, rows, monkeypatch, length):
    want = plain_repeats(shared, length)
    columns = ["doc_id", "n_words", "n_removed", "n_spans", "kept_text"]
    for portion, window in ((anchors.PORTION, anchors.RANGE), (4000, 9000)):
        monkeypatch.setattr(anchors, "PORTION", portion)
        monkeypatch.setattr(anchors, "RANGE", window)
        assert rows(anchors.cut_texts(docs(shared, clash=True), length), *columns) == want


def test_repeats_of_empty_tables(docs):
    assert anchors.cut_texts(docs([])).count() == 0
    assert anchors.cut_texts(docs([(1, None), (2, "")])).count() == 2


def test_packed_hashes_come_back():
    values = np.sort(np.random.default_rng(3).integers(0, 1 << 32, 5000).astype(np.uint32))
    assert (packs.unpacked_rising(packs.packed_rising(values), 5000) == values).all()
    hashes = np.sort(np.random.default_rng(4).integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2))
    for ranges in (1, 7, 1000):
        part, local = packs.dealt(hashes, ranges)
        assert [(int(h) * ranges) >> 64 for h in hashes] == part.tolist()
        assert [((int(h) * ranges) >> 32) & 0xFFFFFFFF for h in hashes] == local.tolist()
