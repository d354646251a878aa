"""Every operator of edgeloom.llm against a plain restatement of its contract, over awkward rows and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_data import EDGE_DOCS, GERMAN, WORDS, prose

from edgeloom.llm import op1_mix, op2_decontaminate, op4_pii, op5_warc, op6_license_scan, op7_jaccard_join, \
    op8_substring_dedup, trees
from edgeloom.llm.catalog import queries

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def space_words(t):
    return SPACE.findall(t or "")


def alnum_words(t):
    return ALNUM.findall((t or "").translate(LOWER))


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def multiset(rows):
    return Counter(map(tuple, rows))


def crc(doc_id, parts):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % parts


@pytest.mark.parametrize("name", sorted(queries()))
def test_empty_tables(spark, empty_dir, name):
    assert queries()[name](spark, empty_dir).count() == 0


def test_mix(spark, edge_dir):
    rows = queries()["op1_mix"](spark, edge_dir).collect()
    again = queries()["op1_mix"](spark, edge_dir).collect()
    assert multiset(rows) == multiset(again)
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((d, len(space_words(t))) for d, t, _, _ in EDGE_DOCS)
    by_source = defaultdict(int)
    for _, t, _, s in EDGE_DOCS:
        by_source[s] += len(space_words(t))
    order = sorted((s for s in by_source if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, target = 1.5 * sum(by_source.values()), set(order), {}
    while True:  # share, cut at twice the size, share the rest again
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level > 2 * by_source[s]]
        if not over:
            target |= {s: weight[s] * level for s in open_}
            break
        for s in over:
            target[s] = 2.0 * by_source[s]
            left -= target[s]
            open_.discard(s)
    source_of = {d: s for d, _, _, s in EDGE_DOCS if d is not None}
    taken = defaultdict(int)
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"]
        if r.doc_id is not None:
            s = source_of[r.doc_id]
            assert r.source_size == by_source[s] and r.target == pytest.approx(target[s])
        taken[r.source_size, r.target] += r.taken
    for (_, t), got in taken.items():
        assert t - 1 < got <= t


def test_mix_without_words(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, " ", None), (2, " ", None)], "doc_id long, text string, source string")
    assert multiset(op1_mix.mix(docs).collect()) == multiset([(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)])


def test_schedule_interleaves_sources(spark):
    docs = spark.createDataFrame([(i, "w " * 10, f"s{i % 3}") for i in range(300)], "doc_id long, text string, source string")
    sources = docs.selectExpr("false as is_null", "source as source_key").groupBy("is_null", "source_key").count()
    allotment = op1_mix.allot(sources.selectExpr("is_null", "source_key", "count * 10 as source_size"), share=1.0)
    slots = op1_mix.schedule(spark, allotment, 10).orderBy("slot").collect()
    want = {r.source_key: r.words for r in allotment.collect()}
    for n in (30, 60, 150):  # every prefix of the schedule is close to the weights
        seen = Counter(r.source_key for r in slots[:n])
        assert all(abs(seen[s] - n * w / sum(want.values())) <= 3 for s, w in want.items())
    for s in want:
        assert sorted(r.block for r in slots if r.source_key == s) == list(range(-(-want[s] // 10)))


def test_mix_takes_blocks_in_schedule_order(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 7 + 1), f"s{i % 4}") for i in range(400)], "doc_id long, text string, source string")
    rows = op1_mix.mix(docs, weights=(5, 1), share=1.0, block_words=4).collect()
    for t in {r.target for r in rows}:
        assert sum(r.taken for r in rows if r.target == t) == sum({r.source_size: int(t) for r in rows if r.target == t}.values())


def test_mix_pieces_follow_the_schedule(spark):
    docs = [(i, " ".join(f"d{i}w{k}" for k in range(i % 7 + 1)), (None, "a", "b")[i % 3]) for i in range(120)] + [(500, "", "a"), (501, None, "b")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    args = {"weights": (5, 1), "share": 1.2, "block_words": 4}
    rows = op1_mix.mixed_pieces(frame, **args).collect()
    target = {}
    for r in op1_mix.mix(frame, **args).collect():
        assert r.taken == sum(p.words for p in rows if p.doc_id == r.doc_id)
        target[dict((d, s) for d, _, s in docs)[r.doc_id]] = int(r.target)
    order = sorted(docs, key=lambda d: hashlib.md5(str(d[0]).encode()).hexdigest())
    text, got, blocks = {d: space_words(t) for d, t, _ in docs}, defaultdict(list), defaultdict(list)
    assert [p.slot for p in rows] == sorted(p.slot for p in rows)
    for p in rows:
        assert p["at"] == sum(q.words for q in rows if (q.slot, q.source, q.block) == (p.slot, p.source, p.block) and q["at"] < p["at"])
        got[p.source] += text[p.doc_id][p.first_word:p.first_word + p.words]
        blocks[p.source].append((p.slot, p.block))
    for s, words in target.items():  # a source's pieces, slot after slot, are its repeated stream up to the target
        stream = [w for d, _, source in order if source == s for w in text[d]]
        assert got[s] == (stream * 3)[:words] and len(got[s]) == words
        assert blocks[s] == sorted(blocks[s])
    spans, total, point = [], sum(target.values()), 0
    for s in ("a", "b", None):
        spans.append((s, point / total, (point + target[s]) / total))
        point += target[s]
    last = -(-total // 4)
    for p in rows:  # the golden-ratio point of a slot lies in its source's span
        if p.slot < last:
            at = p.slot * 2654435769 % 2 ** 32 / 2 ** 32
            assert any(s == p.source and low - 1e-6 <= at <= high + 1e-6 for s, low, high in spans)


def brute_windows(words, items):
    hit, found = set(), set()
    for item, text in items:
        w = alnum_words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            for j in range(len(words) - n + 1):
                if words[j:j + n] == w[i:i + n]:
                    hit.update(range(j, j + n))
                    if item is not None:
                        found.add(item)
    return hit, found


def test_decontaminate(spark, edge_dir):
    items = [tuple(r) for r in spark.read.parquet(f"{edge_dir}/benchmark.parquet").collect()]
    got = multiset(queries()["op2_decontaminate"](spark, edge_dir).collect())
    want = []
    for d, t, _, _ in EDGE_DOCS:
        w = alnum_words(t)
        if len(w) > 10_000:  # the long text is random words: only its counts are compared
            continue
        hit, found = brute_windows(w, items)
        want.append((d, len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))),
                     len(hit) > 0 and 20 * len(hit) >= len(w)))
    assert sum(got.values()) == len(EDGE_DOCS)
    assert multiset(want) <= got


@pytest.mark.parametrize("seed", range(8))
def test_wu_manber_finds_every_occurrence(seed):
    r = random.Random(seed)
    items = [(i, " ".join(r.choices("abc", k=r.randrange(0, 18)))) for i in range(6)]
    text = " ".join(r.choices("abc", k=300))
    _, spans, found = op2_decontaminate.search(text, op2_decontaminate.matchers(items))
    hit, want = brute_windows(alnum_words(text), items)
    assert found == want and {k for a, z in spans for k in range(a, z)} == hit


def test_decontaminate_in_several_blocks(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{edge_dir}/benchmark.parquet")
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    one = op2_decontaminate.verdicts(op2_decontaminate.find_windows(docs, bench)).select(cols)
    many = op2_decontaminate.verdicts(op2_decontaminate.find_windows(docs, bench, block_words=1)).select(cols)
    assert multiset(one.collect()) == multiset(many.collect())


def brute_counts(t):
    t = t or ""
    w = space_words(t)
    seen = Counter(zip(w, w[1:], w[2:], strict=False))
    repeated = {i + k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines, dup = set(), 0
    for line in t.split("\n"):
        if SPACE.search(line):
            dup += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(repeated)


def test_quality_rules(spark, edge_dir):
    got = queries()["op3_quality_rules"](spark, edge_dir).collect()
    counts = multiset((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
    want = [(d, *(c := brute_counts(t)), c[0] < 50 or 100 * c[4] > 50 * c[0]) for d, t, _, _ in EDGE_DOCS]
    assert counts == multiset(want)
    assert not any(r.kept and r.base_failed for r in got)


@pytest.mark.parametrize("sign", [1, -1])
def test_trees_keep_monotone_constraints(sign):
    r = np.random.default_rng(3)
    x = r.normal(size=(600, 3))
    y = ((x[:, 0] + np.sin(3 * x[:, 1]) + r.normal(size=600)) > 0).astype(float)
    forest = trees.fit(x, y, {1: sign})
    grid = np.repeat(x[:40], 50, axis=0)
    grid[:, 1] = np.tile(np.linspace(-4, 4, 50), 40)
    steps = np.diff(forest.score(grid).reshape(40, 50), axis=1)
    assert (sign * steps >= -1e-12).all()
    assert ((trees.fit(x, y).score(x) > 0.5) == y).mean() > 0.8


def brute_pii(t):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()]
        total = sum(sum(divmod(2 * v, 10)) if i % 2 else v for i, v in enumerate(reversed(d)))
        if 14 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return [(a, z, k) for a, k, z in sorted(out)]


def test_pii(spark, edge_dir):
    got = queries()["op4_pii"](spark, edge_dir).collect()
    want = []
    for d, t, _, _ in EDGE_DOCS:
        spans = brute_pii(t or "")
        n = Counter(k for _, _, k in spans)
        want.append((d, n[0], n[1], n[2], n[3], sha(",".join(f"{op4_pii.KINDS[k]}:{a}:{z}" for a, z, k in spans))))
    assert multiset(tuple(r)[:6] for r in got) == multiset(want)


@pytest.mark.parametrize("seed", range(30))
def test_base_spans_are_leftmost(seed):
    r = random.Random(seed)
    t = "".join(r.choices("ab1.@+- 45()\n", k=200)) + "x@y.z@w.v 1.2.3.4.5 999.1.1.1 4111 1111 1111 1111 00000000000000"
    assert op4_pii.base_spans(t) == brute_pii(t)


def test_skip_edges_carry_labels():
    docs = ["call +1 (243) 555-5526 today. or 243-555-5526 later 99887 and 1234567."] * 5
    crf = op4_pii.Crf({}, np.log(np.array([.9, .025, .025, .025, .025])), np.zeros((5, 5)), 6 * np.eye(5) - 3)
    base, spans = op4_pii.find(docs[0], crf)
    words = [docs[0][a:z] for a, z, _ in spans]
    assert [s[2] for s in base] == [3] and words == ["+1 (243) 555-5526", "243-555-5526"]
    assert op4_pii.masked(docs[0], spans) == "call [PHONE] today. or [PHONE] later 99887 and 1234567."


def test_warc(spark, edge_dir):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{edge_dir}/pages.parquet").collect()]
    keeper = {}
    for p, _, h in pages:
        if p is not None:
            keeper[h or ""] = max(p, keeper.get(h or "", p))
    want = []
    for p, _, h in pages:
        raw = (h or "").encode()
        k = keeper.get(h or "")
        same = sum((x[2] or "") == (h or "") for x in pages)
        to = k if len(raw) >= 1000 and same > 1 and p != k else None
        want.append((p, len(raw), hashlib.sha1(raw).hexdigest(), "response" if to is None else "revisit", to))
    got = queries()["op5_warc"](spark, edge_dir).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert multiset(got.collect()) == multiset(want)


def test_capture_index_finds_keys_over_block_and_file_borders(spark, scratch_dir):
    pages = spark.createDataFrame([(i, f"http://h{i % 5}.org/{i % 3}", f"page {i}") for i in range(300)], "page_id long, url string, html string")
    captures = op5_warc.write_archives(pages, f"file://{scratch_dir}/warc", archive_bytes=5_000)
    assert captures.select("file").distinct().count() > 3
    index = op5_warc.write_index(captures, f"file://{scratch_dir}/cdx", block_lines=7)
    some = pages.where("page_id % 4 = 0 or page_id > 290").unionByName(spark.createDataFrame(
        [(1000, "http://h1.org/1", ""), (None, "http://zzz.org", "")], pages.schema))
    got = op5_warc.lookup(some, index, f"file://{scratch_dir}/warc")
    assert sorted(r.page_id for r in got.collect()) == [i for i in range(300) if i % 4 == 0 or i > 290]


def test_url_key():
    assert op5_warc.url_key("http://www.Example.com/a?b#c") == "com,example,www)/a?b"
    assert op5_warc.url_key("http://[bad") == "http://[bad" and op5_warc.url_key(None) == ""


def test_license_scan(spark, edge_dir):
    want = []
    for d, t, _, _ in EDGE_DOCS:
        w, starts, labels = alnum_words(t), [], set()
        for label, _, phrase in op6_license_scan.TEMPLATES:
            p = phrase.split()
            at = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
            if at:
                labels.add(label)
            if label in ("mit", "apache", "gpl"):
                starts += [(i, label) for i in at]
        want.append((d, len(w), len(starts), min(starts, default=(None,))[0], max(starts, default=(None,))[0],
                     ",".join(sorted({x for _, x in starts})), ",".join(sorted(labels))))
    got = queries()["op6_license_scan"](spark, edge_dir).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score").collect()
    assert multiset(tuple(r)[:7] for r in got) == multiset(want)
    assert all(0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) for r in got)


def brute_sets(t, size):
    w = [x.translate(LOWER) for x in space_words(t)]
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute_components(docs, size, percent):
    sets = defaultdict(list)
    for d, t in docs:
        if d is not None:
            sets[d].append(brute_sets(t, size))
    ids = sorted(sets)
    part = {d: d for d in ids}

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                lo, hi = sorted((root(a), root(b)))
                part[hi] = lo
    return {d: root(d) for d in ids}


def test_jaccard_join(spark, edge_dir):
    part = brute_components([(d, t) for d, t, _, _ in EDGE_DOCS], 4, 85)
    want = [(d, len(brute_sets(t, 4)), part.get(d)) for d, t, _, _ in EDGE_DOCS]
    got = queries()["op7_jaccard_join"](spark, edge_dir).select("doc_id", "n_shingles", "component_id")
    assert multiset(got.collect()) == multiset(want)


@pytest.mark.parametrize("seed,percent", [(1, 85), (2, 70), (3, 60), (4, 50)])
def test_jaccard_join_on_drifting_copies(spark, seed, percent):
    r = random.Random(seed)
    docs, base = [], []
    for i in range(240):
        if not base or r.random() < 0.1:
            base = r.choices(WORDS + GERMAN, k=r.randrange(5, 60))
        else:  # copies of copies: many links stand only between neighbours
            for _ in range(r.randrange(0, 4)):
                base = list(base)
                base[r.randrange(len(base))] = r.choice(WORDS)
        docs.append((i * 7 % 240, " ".join(base)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = op7_jaccard_join.jaccard_components(frame, size=2, percent=percent).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(docs, 2, percent)


def drifting(seed, n):
    r = random.Random(seed)
    docs, base = [], []
    for i in range(n):
        if not base or r.random() < 0.05:
            base = r.choices(WORDS + GERMAN, k=r.randrange(20, 60))
        else:
            for _ in range(r.randrange(0, 3)):
                base = list(base)
                base[r.randrange(len(base))] = r.choice(WORDS)
        docs.append((i * 7 % n, " ".join(base)))
    return docs


@pytest.mark.parametrize("seed,percent,group", [(1, 85, 256), (2, 70, 5), (3, 60, 2), (4, 50, 3)])
def test_jaccard_join_counts_every_link(spark, seed, percent, group):
    docs = drifting(seed, 240) + [(1000, None), (1001, "a b c"), (1002, "A  b\nc"), (None, "a b c")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    sets = {d: frozenset(brute_sets(t, 2)) for d, t in docs if d is not None}
    rep = {}
    for d in sorted(sets):
        rep.setdefault(sets[d], d)
    linked = {(a, b) for a in sets for b in sets if a != b and sets[a] and sets[b]
              and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
    got = op7_jaccard_join.jaccard_join(frame, size=2, percent=percent, group=group).collect()
    part = brute_components(docs, 2, percent)
    degree = Counter(a for a, _ in linked)
    assert multiset((r.doc_id, r.n_links, r.component_id) for r in got) == multiset(
        (d, degree[d], part.get(d)) for d, _ in docs)
    links = op7_jaccard_join.jaccard_links(frame, size=2, percent=percent, group=group).collect()
    pairs = {(rep[sets[a]], rep[sets[b]]) for a, b in linked if rep[sets[a]] < rep[sets[b]]}
    by_rep = {d: s for s, d in rep.items()}
    assert multiset(links) == Counter((a, b, len(by_rep[a] & by_rep[b]), len(by_rep[a] | by_rep[b])) for a, b in pairs)


def test_jaccard_join_links_documents_of_one_pivot(spark):
    base = prose(41, 120).split()
    near = [" ".join([*base[:k], "zebra", *base[k + 1:]]) for k in (20, 90)]
    docs = spark.createDataFrame([(1, " ".join(base)), (2, near[0]), (3, near[1]), (4, near[1])], "doc_id long, text string")
    got = op7_jaccard_join.jaccard_join(docs)
    assert sorted((r.doc_id, r.n_links) for r in got.collect()) == [(1, 3), (2, 3), (3, 3), (4, 3)]


def brute_removed(docs, n):
    first = {}
    for d, t in docs:
        w = space_words(t)
        for i in range(len(w) - n + 1 if d is not None else 0):
            k = tuple(w[i:i + n])
            first[k] = min(d, first.get(k, d))
    out = []
    for d, t in docs:
        w = space_words(t)
        gone = {i + j for i in range(len(w) - n + 1 if d is not None else 0) if first[tuple(w[i:i + n])] < d for j in range(n)}
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def test_substring_dedup(spark, edge_dir):
    want = [(d, n, k, sha(t)) for d, n, k, t in brute_removed([(d, t) for d, t, _, _ in EDGE_DOCS], 50)]
    got = queries()["op8_substring_dedup"](spark, edge_dir).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert multiset(got.collect()) == multiset(want)


@pytest.mark.parametrize("seed,window", [(1, 4), (2, 5), (3, 8), (4, 2)])
def test_substring_dedup_short_windows(spark, seed, window):
    r = random.Random(seed)
    docs = [(i - 5, " ".join(r.choices("abcdefgh", k=r.randrange(0, 40)))) for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = op8_substring_dedup.dedup_substrings(frame, window)
    assert multiset(got.select("doc_id", "n_words", "n_removed", "kept").collect()) == multiset(brute_removed(docs, window))
    for row in got.collect():
        assert sum(z - a for a, z in row.spans) == row.n_removed


def test_quality_classifier(spark, edge_dir):
    got = queries()["op9_quality_classifier"](spark, edge_dir).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, _, _, _ in EDGE_DOCS)
    for r in got:
        assert r.held_out == (crc(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_language_id(spark, edge_dir):
    got = queries()["op10_language_id"](spark, edge_dir).collect()
    texts = {d: t for d, t, _, _ in EDGE_DOCS if d is not None}
    assert Counter(r.doc_id for r in got) == Counter(d for d, _, _, _ in EDGE_DOCS)
    for r in got:
        assert r.held_out == (crc(r.doc_id, 3) == 1) and 0 <= r.score <= 1
        if r.doc_id is not None:
            none = not any(c.isalpha() for c in texts[r.doc_id] or "")
            assert (r.lang_pred == "und") == none
        if r.doc_id and 100 <= r.doc_id:
            assert r.lang_pred == ("en" if r.doc_id < 200 else "de")


def test_prose_is_deterministic():
    assert prose(1, 20) == prose(1, 20)
