import random
import re
from collections import Counter

import numpy as np

from seqrisk.llm import components, embed_dedup, line_dedup, minhash
from tests.llm.helpers import awkward, clashing, empty, frame, prose


def _shingles(t):
    w = re.findall("[a-z0-9\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    return Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def _probability_jaccard(a, b):
    keys = set(a) | set(b)
    return sum(1 / sum(max(a[e] / a[k], b[e] / b[k]) for e in keys) for k in set(a) & set(b))


def _components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_probability_jaccard_matches_definition():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = ({int(k): int(v) for k, v in zip(rng.choice(30, 12, False), rng.integers(1, 5, 12))} for _ in range(2))
        ha, hb = (np.array(sorted(x), np.uint64) for x in (a, b))
        got = minhash.probability_jaccard(ha, np.array([a[int(k)] for k in ha]), hb, np.array([b[int(k)] for k in hb]))
        assert abs(got - _probability_jaccard(Counter(a), Counter(b))) < 1e-9


def test_signature_estimates_probability_jaccard():
    rng = np.random.default_rng(2)
    h = rng.integers(1, 2**63, 300).astype(np.uint64)
    w = rng.integers(1, 4, 300)
    a, b = np.arange(0, 240), np.arange(60, 300)
    hashes, doc = np.concatenate([h[a], h[b]]), np.repeat([0, 1], 240)
    sig = minhash.prob_min_hash(hashes, doc, np.concatenate([w[a], w[b]]), 2, 4096)
    exact = _probability_jaccard(Counter(dict(zip(h[a].tolist(), w[a].tolist()))), Counter(dict(zip(h[b].tolist(), w[b].tolist()))))
    assert abs((sig[0] == sig[1]).mean() - exact) < 0.04


def near_rows(seed=5):
    rng = random.Random(seed)
    rows = awkward(seed)
    base = [prose(rng, n) for n in (8, 40, 120, 400)]
    for i in range(60):
        w = rng.choice(base).split()
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(["other", "words", "here"])
        rows.append((200 + i, " ".join(w), "en", "a", 1))
    return rows


def test_minhash_groups_match_brute_force(spark):
    rows = near_rows()
    sets = {r[0]: _shingles(r[1]) for r in rows if r[0] is not None}
    ids = [i for i in sets if sets[i]]
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if set(sets[a]) & set(sets[b]) and _probability_jaccard(sets[a], sets[b]) >= 0.8]
    want = _components(sets, links)
    member, found = minhash.near_duplicates(clashing(frame(spark, rows)))
    got = {(r.id, r.component_id, r.kept) for r in member.collect()}
    assert got == {(i, c, i == c) for i, c in want.items()} | {(None, None, True)}
    assert member.count() == len(rows)
    assert all(r.similarity >= 0.8 for r in found.collect())
    kept = minhash.keep_one(clashing(frame(spark, rows)))
    assert {r.doc_id for r in kept.collect()} == {c for c in want.values()} | {None}
    assert minhash.keep_one(empty(spark)).count() == 0


def test_bucket_that_holds_several_groups_is_compared_fully(spark):
    """With one register per band unlike texts share buckets: links that do not
    touch the smallest text of the bucket must still be found."""
    rows = near_rows(6)
    loose, _ = minhash.near_duplicates(frame(spark, rows), bands=40, rows=1)
    tight, _ = minhash.near_duplicates(frame(spark, rows), bands=60, rows=4)
    assert {tuple(r) for r in loose.collect()} == {tuple(r) for r in tight.collect()}


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 30)] + [(100, k) for k in range(101, 140)] + [(7, 7), (500, 400)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for l in links for n in l if l[0] != l[1]}
    assert got == _components(nodes, links)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def vector_rows():
    rng = np.random.default_rng(3)
    rows, i = [], 0
    for label in (0, 1, None):
        for _ in range(12):
            centre = rng.normal(size=16)
            for _ in range(rng.integers(1, 9)):
                rows.append((i, (centre + rng.normal(size=16) * rng.choice([0.05, 0.25, 0.4])).astype("float32").tolist(), label))
                i += 1
    x = rows[0][1]
    rows += [(1000, x, 0), (1001, x, 0), (1002, x, 1), (1003, [0.0] * 16, 0), (1004, None, 0), (1005, [], 0), (1006, [1.0, None] * 8, 0),
             (1007, [float("nan")] * 16, 0), (1008, [float("inf")] * 16, 0), (1009, [1e38] * 16, 0), (1010, [1e-30] * 16, 0), (1011, [1.0] * 8, 0),
             (None, x, 0), (1000, x, 0)]
    return rows


def test_embedding_links_match_brute_force(spark):
    rows = vector_rows()
    ok = {i: (v, l) for i, v, l in rows if i is not None and l is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    unit = {i: np.array(v, float) / np.abs(v).max() for i, (v, _) in ok.items()}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    links = [(a, b) for a in ok for b in ok if a < b and ok[a][1] == ok[b][1] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.93]
    degree = Counter(x for l in links for x in l)
    ids = {i for i, _, _ in rows if i is not None}
    comp = _components(ids, links)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for tile in (1024, 8):
        out = embed_dedup.near_vectors(df.withColumnsRenamed({"vec_id": "node"}), id_col="node", tile_rows=tile).collect()
        assert {(r.id, r.n_links, r.component_id, r.kept) for r in out} == {(i, degree[i], comp[i], i == comp[i]) for i in ids} | {(None, 0, None, True)}
        assert len(out) == len(rows)
    assert embed_dedup.near_vectors(df.limit(0)).count() == 0


def _one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    return a == b or a[p + 1:] == b[p + 1:] or a[p:] == b[p + 1:] or a[p + 1:] == b[p:]


def line_rows():
    rng = random.Random(3)
    base = ["the quick brown fox jumps over", "a second line with some more words", "short", "12345678901234567890", "zz" * 300]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = rng.choice(base) + rng.choice(["", "", " "])
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                k, how = rng.randrange(len(line)), rng.choice("sdi")
                line = line[:k] + ("" if how == "d" else rng.choice("abXé\U0001F600")) + line[k + (how != "i"):]
            lines.append(line)
        rows.append((i, "\n".join(lines) if rng.random() > 0.05 else None, None, None, 1))
    return rows + [(5, rows[5][1], None, None, 1), (None, base[0], None, None, 1), (None, base[0], None, None, 1)]


def test_line_dedup_matches_brute_force(spark):
    rows = line_rows()
    norm = lambda s: "".join(c.lower() if c.isascii() else c for c in s.strip())
    place = lambda i: 1 << 63 if i is None else i
    lines = [(place(r[0]), k, norm(x)) for r in rows for k, x in enumerate((r[1] or "").split("\n"))]
    want = Counter()
    for r in rows:
        kept = []
        for k, x in enumerate((r[1] or "").split("\n")):
            n = norm(x)
            if not (n and any((a, b) < (place(r[0]), k) and (m == n or min(len(m), len(n)) >= 20 and _one_edit(m, n)) for a, b, m in lines)):
                kept.append(x)
        n_lines = len((r[1] or "").split("\n"))
        want[(r[0], None if r[1] is None else "\n".join(kept), n_lines, n_lines - len(kept))] += 1
    out = line_dedup.dedup_lines(clashing(frame(spark, rows)))
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()) == want
    assert line_dedup.dedup_lines(empty(spark)).count() == 0
