"""The methods themselves: intersected postings, flattened trees, splits of hot lists, one block of the benchmark."""

import random

import numpy as np
import pytest

from edgeloom.llm import op2_decontaminate, op6_license_scan, op7_jaccard_join, trees
from edgeloom.llm.op2_decontaminate import words_of
from llm_data import prose


def test_license_postings_are_intersected():
    index = op6_license_scan.Index(1000, {"license": 500, "the": 900, "public": 90, "general": 80})
    for k, (_, words, _, at, key, _) in enumerate(index.templates):
        assert all(at <= i < at + len(key) and words[i] == w for i, w in index.rare[k])
    text = "mit said: a license. general use of public license; the general public license and mit license"
    found = set(index.alignments(words_of(text)))
    labels = {index.templates[k][0] for k, _ in found}
    assert {"mit", "gpl"} <= labels and "apache" not in labels
    assert len([k for k, _ in found if index.templates[k][0] == "mit"]) == 1  # of two places of "mit"
    n, places, scores = index.scan(text)
    assert n == 16 and sorted(index.templates[k][0] for k, _ in places) == ["gpl", "mit"] and scores["mit"] == pytest.approx(1.0)


def test_alignments_miss_no_phrase():
    r = random.Random(3)
    index = op6_license_scan.Index(50, {})
    for _ in range(200):
        words = [r.choice("general public license mit apache the cc by nc 4 0 version gnu affero".split()) for _ in range(60)]
        words = words_of(" ".join(words))
        found = set(index.alignments(words))
        for k, (_, _, _, at, key, _) in enumerate(index.templates):
            for i in range(len(words) - len(key) + 1):
                if words[i:i + len(key)] == key:
                    assert (k, i - at) in found


def test_flattened_trees_score_as_a_walk_does():
    r = np.random.default_rng(1)
    x = r.normal(size=(500, 6))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(float)
    forest = trees.fit(x, y, monotone={0: 1}, trees=12, depth=3)

    def walk(row):
        total = forest.base
        for f, t, v in zip(forest.feature, forest.threshold, forest.value, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > t[node] else 1)
            total += v[node - len(f)]
        return 1 / (1 + np.exp(-total))

    rows = np.vstack([r.normal(size=(200, 6)), x[:50]])
    assert np.allclose(forest.score(rows), [walk(row) for row in rows])
    up = rows.copy()
    up[:, 0] += 1
    assert (forest.score(up) >= forest.score(rows) - 1e-12).all()


def test_a_hot_token_is_cut_into_blocks(spark, monkeypatch):
    """A token of many sets that do not link: blocks of its list, no task with all of it."""
    monkeypatch.setattr(op7_jaccard_join, "_BLOCK", 16)
    r = random.Random(5)
    common = [f"c{k}" for k in range(30)]
    docs = [(k, " ".join(r.sample(common, 26) + [f"own{k % 97}x{j}" for j in range(5)])) for k in range(150)]
    docs += [(1000 + k, " ".join(common) + f" z{k % 3}") for k in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {x.doc_id: (x.n_links, x.component_id) for x in op7_jaccard_join.jaccard_join(frame, size=1, percent=80, group=8).collect()}
    sets = {d: frozenset(t.split()) for d, t in docs}
    links = {d: [e for e in sets if e != d and 100 * len(sets[d] & sets[e]) >= 80 * len(sets[d] | sets[e])] for d in sets}
    assert {d: n for d, (n, _) in got.items()} == {d: len(v) for d, v in links.items()}
    for d in sets:  # smallest id of the component
        seen, todo = {d}, [d]
        while todo:
            for e in links[todo.pop()]:
                if e not in seen:
                    seen.add(e)
                    todo.append(e)
        assert got[d][1] == min(seen)


def test_overlaps_are_derived_from_the_pivot():
    r = np.random.default_rng(2)
    base = r.integers(0, 10 ** 9, 300)
    sets = lambda n: [np.unique(np.concatenate([r.choice(base, 270, False), r.integers(0, 10 ** 9, r.integers(0, 40))])) for _ in range(n)]
    x, y = sets(12), sets(9)
    got = op7_jaccard_join.overlaps(np.concatenate(x), np.array([len(s) for s in x]), np.concatenate(y), np.array([len(s) for s in y]))
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in y] for a in x]


def test_one_block_of_the_benchmark_is_small():
    import tracemalloc
    r = random.Random(1)
    vocabulary = [f"w{k}" for k in range(30_000)]
    items = [(k, " ".join(r.choices(vocabulary, k=200))) for k in range(1000)]  # 200,000 words
    tracemalloc.start()
    found = op2_decontaminate.matchers(items)
    used, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 200_000 * 150  # a block of 2,000,000 words stays below 300 MB
    text = prose(1, 50) + " " + " ".join(items[5][1].split()[20:60]) + " " + prose(2, 50)
    n, spans, hit = op2_decontaminate.search(text, found)
    assert n == 140 and spans == [(50, 90)] and hit == {5}
