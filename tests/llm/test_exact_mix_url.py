import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from seqrisk.llm import exact_dedup, mixing, queries, url_filter
from tests.llm.helpers import awkward, clashing, empty, frame


def _lower(t):
    return "".join(c.lower() if c.isascii() else c for c in t or "")


def test_exact_groups_match_brute_force(spark):
    rows = awkward()
    groups = defaultdict(list)
    for r in rows:
        groups[_lower(r[1])].append(r[0])
    want = Counter()
    for r in rows:
        g = groups[_lower(r[1])]
        keep = max((i for i in g if i is not None), default=None)
        want[(r[0], keep, len(g), r[0] == keep, hashlib.sha256(_lower(r[1]).encode()).hexdigest())] += 1
    got = Counter(tuple(r) for r in exact_dedup.mark_duplicates(clashing(frame(spark))).collect())
    assert got == want
    assert exact_dedup.mark_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("limit", [200_000, 0])
def test_exact_drop_keeps_one_row_each(spark, monkeypatch, limit):
    monkeypatch.setattr(exact_dedup, "small", lambda df: limit > 0)      # both ways to join
    kept = exact_dedup.drop_duplicates(clashing(frame(spark)))
    assert kept.columns == clashing(frame(spark)).columns
    texts = Counter(_lower(r.text) for r in kept.collect())
    assert set(texts) == {_lower(r[1]) for r in awkward()} and max(texts.values()) == 1
    assert exact_dedup.drop_duplicates(empty(spark)).count() == 0


def test_same_length_and_prefix_are_told_apart(spark):
    long = "p" * 100
    rows = [(1, long + "a", None, None, 1), (2, long + "b", None, None, 1), (3, long + "A", None, None, 1)]
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.mark_duplicates(frame(spark, rows)).collect()}
    assert got == {1: (3, 2), 2: (2, 1), 3: (3, 2)}


def _targets(sizes, weights=(5, 2, 1), total=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, target = set(), {}
    while True:
        rest = total * sum(sizes.values()) - sum(cap * sizes[s] for s in full)
        free = [s for s in order if s not in full]
        target = {s: cap * sizes[s] for s in full} | {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if target[s] > cap * sizes[s] + 1e-9]
        if not over:
            return target
        full |= set(over)


def test_mix_targets_and_counts(spark):
    import re
    rows = awkward(seed=2, n=400)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size(r[1])
    want = _targets(sizes)
    out = mixing.mix_sources(clashing(frame(spark, rows)), chunk_rows=16).collect()
    assert Counter((r.id, r.size) for r in out) == Counter((r[0], size(r[1])) for r in rows)
    taken, longest = Counter(), Counter()
    for r in out:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.copies <= 2 and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
    for s, t in want.items():
        assert abs(taken[s] - t) <= longest[s]
    again = mixing.mix_sources(frame(spark, rows).repartition(7), chunk_rows=16).collect()
    assert Counter((r.id, r.copies) for r in again) == Counter((r.id, r.copies) for r in out)


def test_mix_keeps_expectations(spark):
    rows = [(i, "w " * (1 + i % 7), None, "ab"[i % 2], 1) for i in range(300)]
    total = Counter()
    for seed in range(6):
        for r in mixing.mix_sources(frame(spark, rows), seed=seed, chunk_rows=32).collect():
            total[r.source] += r.copies / 6 / 150
    want = _targets({s: sum(1 + i % 7 for i in range(300) if "ab"[i % 2] == s) for s in "ab"})
    for s in "ab":
        assert abs(total[s] - want[s] / sum(1 + i % 7 for i in range(300) if "ab"[i % 2] == s)) < 0.1


def test_repeated_rows_are_dealt_over_chunks(spark, monkeypatch):
    rows = [(7, "one two three", "en", "a", 1)] * 2000 + [(100 + i, "one two", "en", "ab"[i % 2], 1) for i in range(400)]
    most, write = [], mixing.saved

    def watch(df):
        out = write(df)
        if "end" in out.columns:
            most.append(out.agg(F.max(F.size("end.out") + 1)).first()[0])
        return out
    monkeypatch.setattr(mixing, "saved", watch)
    out = mixing.mix_sources(frame(spark, rows), chunk_rows=16).collect()
    assert len(out) == 2400 and sum(r.id == 7 for r in out) == 2000 and max(most) < 60
    for s in "ab":
        mine = [r for r in out if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 3
    assert len({r.row_hash for r in out if r.id == 7}) == 1


def test_take_mix_repeats_rows(spark):
    docs = clashing(frame(spark))
    mixed = Counter()
    for r in mixing.mix_sources(docs).collect():
        mixed[r.id] += r.copies
    taken = mixing.take_mix(docs)
    assert taken.columns == docs.columns
    got = Counter(r.doc_id for r in taken.collect())
    assert got == +mixed
    assert mixing.take_mix(empty(spark)).count() == 0 and mixing.mix_sources(empty(spark)).count() == 0


def _url_parts(url):
    import re
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    return (_lower(m[1]), m[2]) if m else ("", "")


def test_urls_split_and_rules(spark):
    urls = ["http://Example.ORG/es/1", "http://a.example.org/en/17?x=/es/", "https://x.org", "https://x.com/fr/a#b", "http://com/de/",
            "http://notexample.org/es/", None, "no scheme/es/", "", "ftp://a.b.com?u=http://example.org/es/", "http://x.com/DE/", "http://é.com/de/é"]
    pages = spark.createDataFrame([(i, u, "kept") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = {r.page_id: r for r in url_filter.judge_urls(pages, None, queries.URL_RULES).collect()}
    table = {r.page_id: r for r in url_filter.judge_urls(pages, None, url_filter.rule_table(spark, queries.URL_RULES)).collect()}
    for i, u in enumerate(urls):
        host, path = _url_parts(u)
        fits = [(len(h + p), h + p, v) for v, h, p in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, "allow"))
        for r in (got[i], table[i]):
            assert (r.host, r.path, r.rule, r.verdict) == (host, path, best[1], best[2])


def test_repeated_urls_do_not_fill_the_labelled_table(spark):
    urls = [f"http://host{i}.com/{'casino' if i % 4 == 0 else 'news'}/{i}" for i in range(60)]
    pages = spark.createDataFrame([(u,) for u in urls for _ in range(40)], "url string")
    table = queries.labelled_urls(pages, 50)
    assert table.count() == 50 and table.distinct().count() == 50
    every = queries.labelled_urls(pages, 1000).select("url", "label")
    assert every.count() == 60
    first = {r.url: r.label for r in every.orderBy(F.xxhash64("url"), "url").collect()}
    other = next(i for i, v in enumerate(first.values()) if v != list(first.values())[0])
    rows = [(u, v) for u, v in first.items() for _ in range(40)]
    assert url_filter.fit_urls(spark.createDataFrame(rows, "url string, label int"), max_rows=other + 1) is not None


def test_url_model_learns_and_bears_odd_tables(spark):
    good = [f"http://site{i}.example.net/en/{i}" for i in range(60)]
    bad = [f"http://casino-win{i}.example.net/en/{i}" for i in range(20)]
    schema = "url string, label int"
    model = url_filter.fit_urls(spark.createDataFrame([(u, 0) for u in good[:40]] + [(u, 1) for u in bad[:15]] + [(None, 1), ("x://y", None)], schema))
    pages = spark.createDataFrame([(u,) for u in good[40:] + bad[15:]] + [(None,)], "url string")
    for r in url_filter.judge_urls(pages, model).collect():
        assert r.verdict == ("block" if r.url and "casino" in r.url else "allow")
    assert url_filter.fit_urls(spark.createDataFrame([], schema)) is None
    assert url_filter.fit_urls(spark.createDataFrame([("http://a", 1)], schema)) is None
    assert url_filter.judge_urls(pages.limit(0), model, queries.URL_RULES).count() == 0
