"""Near copies, vectors and pages on small tables, each against a plain computation."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterline.llm import grid_join, near, site_tree, topk
from meterline.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def closure(ids, pairs):
    parent = {i: i for i in ids}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in pairs:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def test_components_of_chains_and_stars(spark):
    r = random.Random(1)
    pairs = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(r.randint(200, 400), r.randint(200, 400)) for _ in range(120)]
    found = {x["id"]: x["component"] for x in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    wanted = closure({i for p in pairs for i in p}, pairs)
    assert all(found.get(i, i) == c for i, c in wanted.items())
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingle_set(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


@pytest.mark.parametrize("block", [near.BLOCK, 4])
def test_near_copies_against_all_pairs(docs, prose, block, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", block)
    monkeypatch.setattr(near, "PIECE", block)
    r = random.Random(5)
    rows = []
    for family in range(6):
        base = prose(60, family).split()
        for _ in range(12):
            words = list(base)
            for _ in range(r.randint(0, 5)):
                words[r.randrange(len(words))] = prose(1, r.random())
            rows.append((len(rows), " ".join(words)))
    rows += [(100, None), (101, ""), (102, " \n"), (103, "two words"), (104, "Two WORDS"), (105, rows[0][1].upper()), (106, "one"),
             (107, prose(3000, 50)), (108, prose(3000, 50) + " and more"), (0, rows[0][1])]
    sets = dict((k, shingle_set(t)) for k, t in rows)
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    wanted = closure(sets, pairs)
    out = near.near_duplicates(docs(rows, clash=True)).collect()
    assert len(out) == len(rows)
    assert all(x["n_shingles"] == len(sets[x["doc_id"]]) for x in out)
    assert {x["doc_id"]: x["component_id"] for x in out} == wanted
    assert all(x["kept"] == (x["doc_id"] == x["component_id"]) for x in out)
    assert near.near_duplicates(docs([])).count() == 0


@pytest.mark.parametrize("piece", [near.PIECE, 3])
def test_near_copies_with_repeated_and_missing_ids(docs, prose, piece, monkeypatch):
    """Ids of several texts, rows without id, and one key of many settled classes with a few loose ones."""
    monkeypatch.setattr(near, "BLOCK", piece)
    monkeypatch.setattr(near, "PIECE", piece)
    a, b, c, d = (prose(40, k) for k in range(4))
    rows = [(5, a), (5, b), (6, a + " x"), (7, b + " y"), (7, None), (None, c), (None, c + " z"), (9, c + " z w"), (None, d), (None, d),
            (None, None), (None, ""), (20, prose(30, 9)), (20, ""), (21, prose(30, 8)), (22, prose(30, 8)), (20, prose(30, 8) + " v")]
    r = random.Random(3)
    base = prose(60, 77).split()
    for k in range(25):
        words = list(base)
        words[r.randrange(60)] = prose(1, r.random())
        rows.append((40 + k % 20, " ".join(words)))
    sets = [shingle_set(t) for _, t in rows]
    similar = [(x, y) for x in range(len(rows)) for y in range(x) if sets[x] and sets[y]
               and (100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]) or (rows[x][0] is not None and rows[x][0] == rows[y][0]))]
    group = closure(range(len(rows)), similar)
    wanted = []
    for k, (doc, _) in enumerate(rows):
        least = min((rows[m][0] for m in range(len(rows)) if group[m] == group[k] and rows[m][0] is not None), default=None)
        wanted.append((str(doc), len(sets[k]), str(least), doc is None or doc == least))
    found = [(str(x["doc_id"]), x["n_shingles"], str(x["component_id"]), x["kept"]) for x in near.near_duplicates(docs(rows)).collect()]
    assert sorted(found) == sorted(wanted)
    assert ("6", 37, "5", False) in found and ("7", 37, "5", False) in found


def test_blocks_that_meet_under_many_keys_are_given_once():
    sketch = near.registers(np.random.default_rng(3).integers(0, 1 << 63, 500).astype(np.uint64), np.zeros(500, np.int64), 1).tobytes()
    rows = [{"key": key, "i": 0, "j": 0, "left": k < 200, "component": k, "n": 500, "registers": sketch, "block": k % 7}
            for key in range(5) for k in range(400)]
    batches = pa.Table.from_pylist(rows).to_batches(300)
    found = pa.Table.from_batches(list(near._promising_blocks(75)(iter(batches)))).to_pylist()
    assert sorted((r["i"], r["j"]) for r in found) == [(a, b) for a in range(7) for b in range(a, 7)]


def test_estimates_are_near_the_similarity():
    r = np.random.default_rng(2)
    shared, own = r.integers(0, (1 << 64) - 1, 900, np.uint64), r.integers(0, (1 << 64) - 1, 100, np.uint64)
    rows = [np.concatenate([shared, own]), np.concatenate([shared, r.integers(0, (1 << 64) - 1, 100, np.uint64)])]
    sketch = np.stack([near.registers(np.sort(v), np.zeros(len(v), int), 1)[0] for v in rows])
    n = np.array([1000])
    value, used = near.estimate(sketch[:1], sketch[1:], n, n)
    assert used[0] == near.REGISTERS and abs(value[0] - 900 / 1100) < 0.2
    assert near.expected_collisions(n, n)[0] < 0.1


VECTORS = "vec_id long, embedding array<float>"


def vector_rows():
    r = np.random.default_rng(3)
    base = r.standard_normal((30, 12))
    rows = [(k, (base[k % 30] + (0.15 * r.standard_normal(12) if k >= 30 else 0)).astype(np.float32).tolist()) for k in range(200)]
    rows += [(300, None), (301, [0.0] * 12), (302, [float("nan")] + [1.0] * 11), (303, [None] + [1.0] * 11), (304, []), (305, rows[0][1]), (306, rows[0][1]),
             (307, [float("inf")] * 12), (308, [2 * x for x in rows[1][1]]), (310, [1.0, 0.0]), (311, [1.0, 0.01])]
    return rows


def usable(v):
    return v and all(x is not None and math.isfinite(x) for x in v)


def test_top_k_against_all_pairs(spark):
    rows = vector_rows()
    frame = spark.createDataFrame(rows, VECTORS).withColumn("score", F.lit(1)).withColumn("rank", F.lit(2))
    out = sorted(tuple(x) for x in topk.top_k(frame, F.col("vec_id") % 20 == 0, k=7).collect())
    ints = {k: [math.floor(64 * x) for x in v] for k, v in rows if usable(v)}
    wanted = []
    for q in ints:
        if q % 20 == 0:
            found = sorted((-sum(a * b for a, b in zip(ints[q], v)), k) for k, v in ints.items() if k != q and len(v) == len(ints[q]))
            wanted += [(q, rank, k, -s) for rank, (s, k) in enumerate(found[:7], 1)]
    assert out == sorted(wanted)
    assert topk.top_k(frame.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_bounds_are_never_below_the_product():
    r = np.random.default_rng(4)
    q, c = r.standard_normal((20, 50)), r.standard_normal((40, 50))
    for segments in (1, 3, 8, 50):
        assert (topk.segment_statistics(q, segments) @ topk.segment_statistics(c, segments).T >= q @ c.T - 1e-9).all()


@pytest.mark.parametrize("interval", [grid_join.INTERVAL, 16])
def test_near_vectors_against_all_pairs(spark, interval, monkeypatch):
    monkeypatch.setattr(grid_join, "INTERVAL", interval)
    monkeypatch.setattr(grid_join, "BLOCK", 8)
    monkeypatch.setattr(grid_join, "FAN", 3)
    rows = vector_rows()
    frame = spark.createDataFrame(rows, VECTORS).withColumn("id", F.lit("x")).withColumn("digest", F.lit("y"))
    out = {x["vec_id"]: (x["n_links"], x["component_id"], x["kept"]) for x in grid_join.near_vectors(frame).collect()}
    good = {k: np.array(v, float) for k, v in rows if usable(v) and any(v)}
    pairs = [(a, b) for a in good for b in good if a < b and len(good[a]) == len(good[b])
             and good[a] @ good[b] >= 0.95 * np.linalg.norm(good[a]) * np.linalg.norm(good[b])]
    component = closure([k for k, _ in rows], pairs)
    assert out == {k: (sum(k in p for p in pairs), component[k], component[k] == k) for k, _ in rows}
    assert grid_join.near_vectors(frame.where("false")).count() == 0


# pages

def page(*parts):
    return "<!DOCTYPE html><html><head><title>t</title></head><body>" + "".join(parts)


def texts(spark, rows):
    out = site_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit(1)).withColumn("path", F.lit("x")))
    return {x["page_id"]: x["text"] for x in out.collect()}


def test_main_text(spark):
    rows = [
        (1, "http://a.example/1", page("<nav><a>Menu</a></nav><article><h1>Head &amp; line</h1><p>One\n two<br>three <b>bold</b>.<p>Four &lt; five"
                                       "<aside>note</aside><div class='ad-box'>buy</div></article><div class=comments>nice</div><footer>f</footer>")),
        (2, "http://a.example/2", None), (3, None, ""), (4, "nonsense", "just text & more"),
        (5, "http://a.example/5", page("<script>var t='</p><p>no';</script><main><p>Kept</p><form>no</form><style>p{}</style></main>")),
        (6, "http://a.example/6", page("<article><p>cut off <b>at the")),
        (7, "http://a.example/7", page("<article><p>a&nbsp;b &am c &copy</p><ul><li>x<li>y</ul><article class='comment'>no</article></article>")),
        (8, "http://a.example/8", page("<div class='cookie-notice'>no</div><div><p>1 < 2</p></div><div role=navigation>no</div><!-- <p>no</p> -->"))]
    found = texts(spark, rows)
    assert found == {1: "Head & line\nOne two three bold.\nFour < five", 2: "", 3: "", 4: "just text & more", 5: "Kept", 6: "cut off at the",
                     7: "a b &am c ©\nx\ny", 8: "1 < 2"}
    assert texts(spark, []) == {}


def test_frame_of_a_site_is_removed(spark, prose):
    frame = "<div class='top'><p>Always the same line</p></div>"
    rows = [(k, f"http://Site.example:80/{k}", page(frame, f"<div class='body'><p>{prose(9, k)}</p></div>", "<div class='end'>Same end</div>")) for k in range(8)]
    rows += [(20, "http://other.example/", rows[0][2])]
    found = texts(spark, rows)
    assert all(found[k] == prose(9, k) for k in range(8))
    assert found[20] == f"Always the same line\n{prose(9, 0)}\nSame end"  # a host with one page shows no frame


def test_repeated_paragraphs_of_articles_stay(spark, prose):
    rows = [(k, "http://site.example/", page(f"<article><p>{prose(9, 1)}</p></article>")) for k in range(8)]
    assert set(texts(spark, rows).values()) == {prose(9, 1)}


def test_copies_of_a_page_count_once(spark, prose):
    frame = "<div class='top'><p>Always the same line</p></div>"
    one = page(frame, f"<div class='body'><p>{prose(9, 1000)}</p></div>")
    rows = [(k, f"http://site.example/{k}", one) for k in range(90)]
    rows += [(k, f"http://site.example/{k}", page(frame, f"<div class='body'><p>{prose(9, k)}</p></div>")) for k in range(90, 100)]
    found = texts(spark, rows)
    assert all(found[k] == prose(9, 1000 if k < 90 else k) for k in range(100))


def test_frame_inside_articles_is_removed(spark, prose):
    call = "<div class='cta'><p>Join us today</p></div>"
    rows = [(k, f"http://site.example/{k}", page(f"<article><p>{prose(9, k)}</p>{call}</article>")) for k in range(30)]
    rows += [(30, "http://site.example/30", page("<article><div class='cta'><p>Only here</p></div></article>"))]
    rows += [(40, "http://other.example/", rows[0][2])]
    found = texts(spark, rows)
    assert all(found[k] == prose(9, k) for k in range(30))
    assert found[30] == "Only here" and found[40] == f"{prose(9, 0)}\nJoin us today"


def test_names_inside_articles(spark, prose):
    inner = ("<section id='related-work'><p>one</p></section><div class='share-price'>two</div><p class='notice'>three</p>"
             "<div class='share-buttons'>no</div><div class='wide ad'>no</div><ul class='relatedPosts'><li>no</ul><div id=ad-slot-3>no</div>")
    assert texts(spark, [(1, "http://a.example/", page(f"<article>{inner}</article>"))]) == {1: "one\ntwo\nthree"}


def test_siblings_are_judged_by_their_place(spark, prose):
    rows = [(k, f"http://site.example/{k}", page("<article><p>Read this first</p>", *(f"<p>{prose(20, 100 * k + i)}</p>" for i in range(1 + k % 4)),
                                                 "<p>Subscribe to our daily letter today</p></article>")) for k in range(30)]
    found = texts(spark, rows)
    assert all(found[k] == "\n".join(prose(20, 100 * k + i) for i in range(1 + k % 4)) for k in range(30))


def test_versions_of_an_article_stay_whole(spark, prose):
    shared = [prose(20, i) for i in range(5)]
    rows = [(k, f"http://site.example/{k}", page("<article>", *(f"<p>{t}</p>" for t in [*shared, prose(20, 50 + k)]), "</article>")) for k in range(30)]
    found = texts(spark, rows)
    assert all(found[k] == "\n".join([*shared, prose(20, 50 + k)]) for k in range(30))
