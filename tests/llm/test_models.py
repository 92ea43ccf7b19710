import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seqrisk.llm import bytes_text as bt, langid, packing, quality, queries, secret_scan
from tests.llm.helpers import awkward, clashing, empty, frame, prose

VOCABULARY = queries.vocabulary()


def test_words_and_shingles():
    texts = pa.array(["Ab c-d", None, "", "one two three four five six", "é9 x"])
    [(_, n, data, offsets)] = list(bt.blocks(texts))
    start, end, word, first = bt.words(data, offsets)
    assert [data[s:e].tobytes().decode() for s, e in zip(start, end)] == ["Ab", "c", "d", "one", "two", "three", "four", "five", "six", "é9", "x"]
    assert np.diff(first).tolist() == [3, 0, 0, 6, 2]
    s, doc = bt.shingles(word, first)
    assert doc.tolist() == [0, 3, 3, 4] and len(set(s.tolist())) == 4
    again = [bt.shingles(*bt.words(d, o)[2:])[0].tolist() for _, _, d, o in bt.blocks(texts, max_bytes=1)]
    assert sum(again, []) == s.tolist()


def rated(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(1200):
        g = i % 3
        rows.append((i, prose(rng, 40) + (" junk!!! trash###" * 6, " idiot", "")[g], "en", "a", 1))
        labels.append((i, g))
    return frame(spark, rows), spark.createDataFrame(labels + [(None, 1), (1, None), (7, 1), (9999, 2)], "doc_id long, grade int")


def test_ordinal_regression_orders_grades(spark):
    docs, labels = rated(spark)
    model = quality.train(docs, labels.where("doc_id % 2 = 0"))
    assert (np.diff(model.thresholds) > 0).all()
    out = quality.rate(docs, model).where("doc_id % 2 = 1").collect()
    right = [round(r.expected_grade) == r.doc_id % 3 for r in out]
    assert np.mean(right) > 0.9
    assert all(r.tails[0] >= r.tails[1] and abs(sum(r.tails) - r.expected_grade) < 1e-9 for r in out)


def test_quality_odd_inputs(spark):
    docs, labels = rated(spark)
    model = quality.train(docs, labels)
    odd = clashing(frame(spark))
    kept = quality.keep_good(odd, model)
    assert kept.columns.sort() == odd.columns.sort() and not {100, 101, 102} & {r.doc_id for r in kept.collect()}
    assert {r.expected_grade for r in quality.rate(odd, model).where("doc_id in (100, 101, 102)").collect()} == {0.0}
    assert quality.rate(empty(spark), model).count() == 0
    none = quality.train(docs, labels.limit(0))
    assert quality.keep_good(docs, none).count() == 1200
    low = quality.train(docs, labels.where("grade = 0"))
    assert quality.keep_good(docs, low).count() == 0


def test_toxic_documents_are_not_kept(spark, tmp_path):
    import corpus_pipeline
    docs, labels = rated(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    known = labels.where("doc_id % 2 = 0 and doc_id < 1200").selectExpr("doc_id", "int(grade > 0) AS quality", "int(grade = 1) AS toxic")
    known.write.parquet(f"{tmp_path}/labels.parquet")
    marked = {r.doc_id: r for r in queries.op4_quality_grade(spark, str(tmp_path)).collect()}
    passed = {r.doc_id for r in corpus_pipeline.quality_classifier(spark, docs, str(tmp_path)).collect()}
    assert passed == {i for i, r in marked.items() if r.kept}
    share = lambda g: np.mean([i in passed for i in range(1, 1200, 2) if i % 3 == g])
    assert share(0) < 0.02 and share(1) < 0.1 and share(2) > 0.95
    assert np.mean([marked[i].p_good >= 0.5 for i in range(1, 1200, 6)]) > 0.95      # good but toxic


def test_top_grade_without_labels_of_it(spark):
    docs, labels = rated(spark)
    for seen, kept in (("grade < 2", 0), ("grade = 1", 0), ("grade = 2", 1200), ("false", 1200)):
        model = quality.train(docs, labels.where(seen), top=2)
        assert len(model.thresholds) == 2 and quality.keep_good(docs, model).count() == kept


def test_languages_and_spans(spark):
    rng = random.Random(4)
    vocabulary = {"en": "the of and water house through which".split(), "de": "der und nicht wasser haus durch schön".split(),
                  "ru": "вода дом через который большой".split()}
    text = lambda l, n: " ".join(rng.choice(vocabulary[l]) for _ in range(n))
    rows = [(i, text(l, 40), l, "s", 1) for i, l in enumerate(["en", "de", "ru"] * 40)]
    model = langid.train(frame(spark, rows), F.col("doc_id") < 90)
    assert model.languages == ["de", "en", "ru"]
    mixed = text("en", 30) + "\n" + text("de", 20) + " " + text("ru", 9)
    odd = [(500, mixed, None, None, 1), (501, None, None, None, 1), (502, " 12 !?", None, None, 1), (503, "", None, None, 1), (504, "日本", None, None, 1),
           (505, "½ ✓ 😀", None, None, 1)]
    out = {r.id: r for r in langid.predict(clashing(frame(spark, rows + odd)).drop("id"), model).collect()}
    assert np.mean([out[i].lang_pred == rows[i][2] for i in range(90, 120)]) == 1.0
    assert [(s.lang, s.first_word, s.words) for s in out[500].spans] == [("en", 0, 30), ("de", 30, 20), ("ru", 50, 9)]
    assert out[500].lang_pred in ("en", "de") and 0 < out[500].score < 1
    assert [out[i].lang_pred for i in (501, 502, 503, 505)] == ["und"] * 4 and out[504].lang_pred in model.languages
    assert all(out[i].score == 0 and out[i].spans == [] for i in (501, 502, 503, 505))
    none = langid.train(empty(spark), F.lit(True))
    assert {r.lang_pred for r in langid.predict(frame(spark), none).collect()} == {"und"}
    assert langid.predict(empty(spark), model).count() == 0


def test_signs_and_digits_are_no_letters(spark):
    rows = [(i, "the water house" if i % 2 else "вода дом", "en" if i % 2 else "ru", "s", 1) for i in range(40)]
    model = langid.train(frame(spark, rows), F.lit(True))
    odd = ["3 × 4", "8 ÷ 2 = 4", "\u0661\u0662\u0663", "\u0967\u0968", "\u0e51 \u0e52", "\u0482 \u037e"]
    out = {r.id: r for r in langid.predict(frame(spark, [(i, t, None, "s", 1) for i, t in enumerate([*odd, "3 × дом"])]), model).collect()}
    assert [(out[i].lang_pred, out[i].score, out[i].spans) for i in range(len(odd))] == [("und", 0.0, [])] * len(odd)
    assert out[len(odd)].lang_pred == "ru" and out[len(odd)].score == 1


def test_viterbi_matches_dynamic_programming():
    rng = np.random.default_rng(5)
    first = np.array([0, 4, 4, 13, 20, 21])
    score = rng.normal(size=(21, 3)).astype(np.float32)
    got = langid.viterbi(score, first, 1.5)
    import itertools
    for a, b in zip(first, first[1:]):
        value = lambda p: sum(score[a + i, s] for i, s in enumerate(p)) - 1.5 * sum(x != y for x, y in zip(p, p[1:]))
        paths = itertools.product(range(3), repeat=b - a)
        assert abs(value(got[a:b]) - max(map(value, paths))) < 1e-4


def test_secret_scan_removes_false_positives(spark):
    rng = random.Random(6)
    key = lambda n, s="0123456789abcdef": "".join(rng.choice(s) for _ in range(n))
    rows = []
    for i in range(150):
        t = prose(rng, 20) + (f' token = "{key(40)}" ' if i % 3 == 0 else f" {rng.choice(['internationalization', 'alphabetagammadelta'])} " if i % 3 == 1 else f" order {key(16, '0123456789')} ")
        rows.append((i, t + prose(rng, 5), "en", "src", 1))
    rows += awkward()
    out = secret_scan.scan(clashing(frame(spark, rows)), queries.finding_label()).collect()
    import re
    want = sum(len(re.findall(secret_scan.CANDIDATE, r[1] or "")) for r in rows)
    assert len(out) == want
    for r in out:
        if r.id is not None and r.id < 150 and len(r.value) in (16, 40):
            assert r.is_secret == (r.id % 3 == 0 and len(r.value) == 40)
    assert secret_scan.scan(empty(spark), queries.finding_label()).count() == 0


def test_values_behind_a_name_are_candidates(spark):
    run = "0123456789abcdef0123"
    cases = [("password = hunter2!", ["hunter2!"]), ("pwd: s3cr.t@x9 next", ["s3cr.t@x9"]), ("db_passwd='Tr0ub4 dor&3' x", ["Tr0ub4 dor&3"]),
             ('{"Password": "a#1$%", "user": "bob"}', ["a#1$%"]), (f'token = "{run}"', [run]), (f"auth={run}, then", [run]), ('password = ""', []),
             (f"secret={run}.x!", [run, f"{run}.x!"]), ("token: password = q.9;", ["q.9"]), ('auth: token="my pass 1"', ["my pass 1"]),
             ('pwd="open9! more', ["open9!"]), ("password:\n  x1", ["x1"]), ("password", []), ("the author: Smith", []), (None, [])]
    docs = frame(spark, [(i, t, "en", "src", 1) for i, (t, _) in enumerate(cases)] + [(99, "pwd=" + "a!" * 500_000, "en", "src", 1)])
    found = secret_scan.candidates(docs).where("id < 99").collect()
    for i, (_, want) in enumerate(cases):
        mine = sorted((r.place, r.value) for r in found if r.id == i)
        assert mine == list(enumerate(want)), (cases[i], mine)
    assert all(cases[r.id][0].replace("\n", " ").find(r.before.replace("\n", " ") + r.value + r.after.replace("\n", " ")) >= 0 for r in found)
    assert secret_scan.candidates(docs).where("id = 99 and length(value) = 1000000").count() == 1


def test_short_passwords_are_found(spark):
    rng = random.Random(11)
    word = lambda s, n: "".join(rng.choice(s) for _ in range(n))
    rows = []
    for i in range(240):
        t = (f" password = {word('abcdefghkmnp', 5)}.{word('23456789', 3)}! ", f" password: {rng.choice(['alpha', 'beta', 'gamma'])} ", " ")[i % 3]
        rows.append((i, prose(rng, 12) + t + prose(rng, 4), "en", "src", 1))
    out = secret_scan.scan(frame(spark, rows), queries.finding_label()).collect()
    assert len(out) == 160 and all(r.is_secret == (r.id % 3 == 0) for r in out)


def test_forest_sample_holds_a_finding_once(spark, monkeypatch):
    key = lambda i: f"{zlib.crc32(str(i).encode()):08x}" * 3
    rows = [(i, f"token = {key(i)} sent", "en", "src", 1) for i in range(40)] + [(i, f"see {'alphabetagamma' + 'xyz'[i % 3] * 4}", "en", "src", 1) for i in range(40, 46)]
    rows += [(100 + n * 40 + i, rows[i][1], "en", "src", 1) for i in range(40) for n in range(10)]
    found = secret_scan.featurise(secret_scan.candidates(frame(spark, rows)), secret_scan.dictionary(frame(spark, rows)))
    kept, write = [], secret_scan.saved
    monkeypatch.setattr(secret_scan, "saved", lambda df: kept.append(write(df)) or kept[-1])
    assert secret_scan.fit_forest(found.withColumn("label", queries.finding_label()), max_rows=30, trees=2) is not None
    assert kept[0].where("label = 1").select("value").distinct().count() == 30
    assert kept[0].where("label = 0").count() == 3


TEXTS = ["it's  a 'test' don't we'll  \n\n x\t y  ", "", None, "'s 're I'm he'd 'LL '", "a <|endoftext|> b", "漢字 test × ÷ é à", " lead", "trail ",
         "\n\n\n", "x'", "it'sound 'v 've've'", "1234 56a7 !!?? ... a'l 'l", "\x1c\x0b\x00 \u00a0 ²", "naïve Éa\u00aa", "'s", "''s 's's'd  'm"]


def test_pieces_are_those_of_the_tokenizer():
    from tokenizers import Tokenizer
    own, encoder = Tokenizer.from_file(VOCABULARY), packing._Encoder(VOCABULARY)
    rng = random.Random(7)
    texts = TEXTS + ["".join(rng.choice("ab é'stmdrevl 12.,\n\tÀ×") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    got = [x.tolist() for _, _, d, o in bt.blocks(pa.array(texts), 200) for x in encoder.encode(d, o)]
    assert got == [e.ids for e in own.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("settings", [{}, {"block": 16, "full": 0.9}])
def test_packing_round_trip(spark, settings):
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(VOCABULARY)
    rows = awkward(n=150)
    out = packing.pack_documents(clashing(frame(spark, rows)), VOCABULARY, **settings).collect()
    ids = {}
    for r in rows:
        ids.setdefault(r[0], []).append(own.encode(r[1] or "", add_special_tokens=False).ids + [2])
    assert len({i for i, *_ in map(tuple, out)}) == len(ids)
    fill, by_seq = {}, {}
    for r in out:
        assert 0 < r.length <= 1024
        whole = [x for x in ids[r.doc_id] if zlib.crc32(np.array(x[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32]
        assert whole and (r.piece == 0 or r.length == 1024)
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.length for r in out) == sum(len(x) for v in ids.values() for x in v)
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    least = -(-sum(r.length for r in out) // 1024)
    assert len(by_seq) <= least * 1.1 + 2
    assert packing.pack_documents(empty(spark), VOCABULARY).count() == 0


def test_crossover_keeps_every_piece_once():
    rng = random.Random(8)
    size = [rng.randint(1, 1023) for _ in range(300)]
    a = packing.best_fit(sorted(range(300), key=lambda i: -size[i]), size, 1024)
    b = packing.best_fit(list(range(300)), size, 1024)
    child = packing.crossover(a, b, size, 1024, rng)
    assert sorted(i for x in child for i in x) == list(range(300)) and all(sum(size[i] for i in x) <= 1024 for x in child)
    best = packing.evolve(size, [], 1024, "s", 4, 10)[0]
    assert len(best) <= len(a)


def test_pipeline_matches_its_operators(spark, tmp_path):
    import corpus_pipeline
    rng = random.Random(9)
    rows = [(i, prose(rng, 30) + (" junk!!! trash###" * 8 if i % 5 == 0 else ""), "en", "abc"[i % 3], 1) for i in range(120)]
    rows += [(200 + i, rows[i][1].upper(), "en", "a", 1) for i in range(10)] + [(300 + i, rows[i + 20][1] + " extra", "en", "b", 1) for i in range(10)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = frame(spark, rows), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        seen[name] = docs = spark.createDataFrame(out.collect(), out.schema)
    good = {r.doc_id for r in seen["quality_classifier"].collect()}
    assert {i for i in range(120) if i % 5} <= good and not {i for i in range(0, 120, 5)} & good
    exact = {r.doc_id for r in seen["exact_dedup"].collect()}
    assert exact == {i for i in good if not (i < 10 and i + 200 in good)}
    assert {r.doc_id for r in seen["minhash_near_dedup"].collect()} == {i for i in exact if not (i >= 300 and i - 280 in exact)}
    assert {r.doc_id for r in seen["source_mix"].collect()} <= exact
    final = corpus_pipeline.run(spark, str(tmp_path))
    key = lambda r: (r.doc_id, r.piece, r.ids_crc32)
    assert sorted(map(key, final.collect())) == sorted(map(key, seen["best_fit_packing"].collect()))


def test_encoder_keeps_a_bounded_number_of_pieces():
    """Every block has new words; what is kept of them stays small, and the ids are those of the tokenizer."""
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, tokenizer = packing._Encoder(path), Tokenizer.from_file(path)
    word = lambda i: "".join(chr(97 + i // 26 ** k % 26) for k in range(4))
    for turn in range(4):
        text = " ".join(word(i) for i in range(turn * 50_000, (turn + 1) * 50_000))
        data = np.frombuffer(text.encode(), np.uint8)
        ids = encoder.encode(data, np.array([0, len(data)]))[0]
        assert len(encoder.known) < 130_000
    assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_learns_a_piece_once_and_trusts_bytes():
    """Words of several blocks come again: none is merged twice, and a hash that leads to another piece changes no id."""
    import types
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, tokenizer = packing._Encoder(path), Tokenizer.from_file(path)
    word = lambda i: "".join(chr(97 + i // 26 ** k % 26) for k in range(4))
    texts = [" ".join(["", *(word(i) for i in range(turn * 40_000, (turn + 1) * 40_000))]) for turn in range(4)]
    model, merged = encoder.tokenizer.model, []
    encoder.tokenizer = types.SimpleNamespace(model=types.SimpleNamespace(tokenize=lambda s: merged.append(s) or model.tokenize(s)),
                                              encode_batch=tokenizer.encode_batch)
    for text in texts * 2:
        data = np.frombuffer(text.encode(), np.uint8)
        assert encoder.encode(data, np.array([0, len(data)]))[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert len(merged) == len(set(merged)) == 160_000
    encoder.numbers = np.roll(encoder.numbers, 1)
    data = np.frombuffer(texts[0].encode(), np.uint8)
    assert encoder.encode(data, np.array([0, len(data)]))[0].tolist() == tokenizer.encode(texts[0], add_special_tokens=False).ids
    long = [chr(97 + i) * 9_000 for i in range(20)]
    for w in long:
        data = np.frombuffer(w.encode(), np.uint8)
        assert encoder.encode(data, np.array([0, len(data)]))[0].tolist() == tokenizer.encode(w, add_special_tokens=False).ids
