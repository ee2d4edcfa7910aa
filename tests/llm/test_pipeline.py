"""Each stage of the pipeline against a plain computation on what the stage before kept."""

import random
from collections import Counter

import pytest

import corpus_pipeline as pipeline
from meterline.llm import packing, quality
from meterline.llm.q_text import RANKS

from .test_pairs import closure, shingle_set
from .test_texts import plain_repeats

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars int, score string, block string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n)) + "."
    base, passage = text(80), text(70)
    rows = []
    for k in range(120):
        if k % 6 == 0:
            body = " | ".join(word() for _ in range(30))
        elif k % 6 == 1:
            words = base.split()
            words[r.randrange(80)] = word()
            body = " ".join(words)
        elif k % 6 == 2:
            body = f"{text(12)} {passage} {text(12)}"
        else:
            body = text(r.randint(1, 300))
        rows.append((k, body, "en", f"s{k % 3}" if k % 7 else None, len(body), "x", "y"))
    rows += [rows[5], (500, None, None, None, None, None, None), (501, "", "en", "s0", 0, "x", "y"), (None, text(20), "en", "s1", 9, "x", "y")]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, int(k % 6 > 0), 0) for k in range(120)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


@pytest.fixture(scope="module")
def kept(spark, folder):
    """What each stage kept, as rows and as a stored frame."""
    frames = [spark.read.parquet(f"{folder}/documents.parquet")]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, frames[-1], folder)
        out.write.parquet(f"{folder}/stage-{k}")
        frames.append(spark.read.parquet(f"{folder}/stage-{k}"))
    return frames


def ids(frame):
    return Counter(r["doc_id"] for r in frame.collect())


def test_stages(spark):
    assert [name for name, _ in pipeline.STAGES] == ["quality_classifier", "minhash_near_dedup", "suffix_array_dedup", "source_mixing", "best_fit_packing"]


def test_columns_are_those_of_documents(kept):
    for frame in kept[1:-1]:
        assert frame.columns == kept[0].columns and frame.dtypes == kept[0].dtypes
        assert {r["score"] for r in frame.collect()} <= {"x", None} and {r["block"] for r in frame.collect()} <= {"y", None}


def test_rejected_documents_go_and_clean_ones_stay(spark, kept, folder):
    model = quality.fitted(kept[0], spark.read.parquet(f"{folder}/labels.parquet"))
    scored = quality.score(kept[0], model, "q").collect()
    assert ids(kept[1]) == Counter(r["doc_id"] for r in scored if r["q"] >= pipeline.KEEP_FROM)
    clean = {r["doc_id"] for r in scored if r["doc_id"] is not None and r["doc_id"] < 120 and r["doc_id"] % 6}
    assert clean <= set(ids(kept[1])) and not any(k is not None and k < 120 and k % 6 == 0 for k in ids(kept[1]))


def test_one_of_each_group_of_copies_stays(kept):
    sets = {r["doc_id"]: shingle_set(r["text"]) for r in kept[1].collect() if r["doc_id"] is not None}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    component = closure(sets, pairs)
    wanted = Counter(k for k, c in component.items() if k == c)
    assert ids(kept[2]) == wanted + Counter({None: 1}) and len(pairs) > 10


def test_repeats_are_cut(kept):
    rows = kept[2].collect()
    left = plain_repeats([r["text"] for r in rows], 200)
    wanted = Counter((r["doc_id"], None if r["text"] is None else b.decode(errors="ignore")) for r, (_, _, _, b) in zip(rows, left))
    out = kept[3].collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == wanted and sum(n for _, n, _, _ in left) > 200
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in out)


def test_mixing_keeps_every_document(kept):
    row = lambda r: (r["doc_id"], r["text"], r["source"])
    assert Counter(map(row, kept[3].collect())) == Counter(map(row, kept[4].collect()))


def test_sequences_hold_every_token(kept):
    encode = packing.encoder(RANKS).encode_ordinary
    wanted = Counter({r["doc_id"]: len(encode(r["text"] or "")) + 1 for r in kept[4].collect()})
    got, load = Counter(), Counter()
    for r in kept[5].collect():
        got[r["doc_id"]] += r["length"]
        load[r["sequence_id"]] += r["length"]
    assert got == wanted and max(load.values()) <= 1024
    assert len(load) <= -(-sum(got.values()) // 1024) + 2


def test_run(spark, kept, folder):
    out = pipeline.run(spark, folder)
    assert out.columns == kept[5].columns and out.count() == kept[5].count()


def test_sequences_follow_the_mix(kept, spark, folder):
    paths = sorted(kept[4].inputFiles())
    mixed = [r["doc_id"] for path in paths for r in spark.read.parquet(path).collect()]
    place = {doc: k for k, doc in enumerate(mixed)}
    rows = kept[5].collect()
    first = {}
    for r in rows:
        at = (place[r["doc_id"]], r["piece"])
        first[r["sequence_id"]] = min(first.get(r["sequence_id"], at), at)
    by_number = [first[s] for s in sorted(first)]
    assert by_number == sorted(by_number) and len(by_number) > 5
