"""Cross-tokenizer alignment (12): against the tokenizers and a plain count of links."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqrisk.llm import token_alignment as ta
from tests.llm import helpers as H

public_tokenizers = pytest.importorskip("public_tokenizers")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

ODD = ["<|endoftext|> and <s> </s> <unk> <0x41>", "  two  spaces ", " ", "\n\t x\r\n", "a▁b", "x ▁", "\x00\x01", "ﬁ ①    ",
       "don't we'll I'm x's", "né café ÀÉ×÷", "\U0001F600\U0001F468‍\U0001F469", "tail  ", "日本語 текст 123 4567", "a" * 300, " ", "é" * 50]


def expected(rows):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    t, m = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    t.encode_special_tokens = True
    letters = {b: b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255}
    letters |= {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in letters)}
    back = {chr(c): b for b, c in letters.items()}
    found, count = [], Counter()
    for doc, text in rows:
        a = b = []
        if text:
            a, b = t.encode(" " + text, add_special_tokens=False).ids, m.encode(text)
            ab = [bytes(back[c] for c in t.id_to_token(i)) for i in a]
            bb = [bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if not b"".join(ab) == b"".join(bb) == (" " + text).encode():
                a = b = []
        links, groups = [], []
        if a:
            ae, be = np.cumsum([len(x) for x in ab]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
            i = j = at = 0
            ga, gb = [a[0]], [b[0]]
            while True:
                links.append((a[i], b[j]))
                x, y = ae[i], be[j]
                if x == y:
                    groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
                    ga, gb = [], []
                if x == y == ae[-1]:
                    break
                if x <= y:
                    i += 1
                    ga.append(a[i])
                if y <= x:
                    j += 1
                    gb.append(b[j])
        count.update(links)
        found.append((doc, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    top = defaultdict(int)
    for (x, y), n in count.items():
        top[y] = max(top[y], n)
    return [(d, na, nb, ng, len(ls), sum(count[p] == top[p[1]] for p in ls), sum(count[p] for p in ls), h) for d, na, nb, ng, ls, h in found]


def key(row):
    return tuple((x is not None, x) for x in row)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


def table(spark):
    rows = H.awkward(3, 60) + [(200 + i, s, "en", "a", 1) for i, s in enumerate(ODD)]
    rng = random.Random(9)
    signs = "ab é.,'<>|  \n\t0?Джあ"
    rows += [(300 + i, "".join(rng.choice(signs) for _ in range(rng.randint(0, 80))), "en", "a", 1) for i in range(120)]
    return rows, H.frame(spark, rows)


def test_alignment_matches_plain_count(spark):
    rows, df = table(spark)
    assert result(ta.align_tokens(df, A, B)) == sorted(expected([(r[0], r[1]) for r in rows]), key=key)


def test_many_runs_and_merges_give_the_same(spark):
    rows, df = table(spark)
    df = df.repartition(5)
    assert result(ta.align_tokens(df, A, B, run_links=500, fan_in=3)) == sorted(expected([(r[0], r[1]) for r in rows]), key=key)


def test_defined_cases(spark):
    empty = ta.align_tokens(H.empty(spark), A, B)
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows, df = table(spark)
    assert result(ta.align_tokens(H.clashing(df), A, B)) == result(ta.align_tokens(df, A, B))
    nothing = ta.align_tokens(H.frame(spark, [(1, None, None, None, None), (2, "", "x", "y", 0)]), A, B).collect()
    assert [tuple(r) for r in nothing] == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_packed_numbers_come_back():
    rng = np.random.default_rng(2)
    for top in (1, 255, 256, 70_000, 2 ** 40):
        v = rng.integers(0, top + 1, 1000).astype(np.uint64)
        assert (ta.unpack(ta.pack(v)) == v).all()
    assert len(ta.unpack(ta.pack(np.zeros(0, np.uint64)))) == 0


def test_sums_leave_early_without_loss(spark, monkeypatch):
    monkeypatch.setattr(ta, "HELD_DOCS", 3)
    rows, df = table(spark)
    assert result(ta.align_tokens(df, A, B, run_links=500, fan_in=3).where(F.col("doc_id") < 200)) == [
        r for r in sorted(expected([(r[0], r[1]) for r in rows]), key=key) if r[0] is not None and r[0] < 200]


def test_side_b_learns_a_word_once():
    """Words that come again in later texts are not encoded anew, and the ids are those of the whole text."""
    import types
    import numpy as np
    import public_tokenizers
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    side, model = ta._SideB(path), sentencepiece.SentencePieceProcessor(model_file=path)
    asked = []

    def encode(words, **settings):
        asked.extend([words] if isinstance(words, str) else words)
        return model.encode(words, **settings)

    side.model = types.SimpleNamespace(encode=encode)
    word = lambda i: "".join(chr(97 + i // 26 ** k % 26) for k in range(4))
    texts = [" ".join(["", *(word(i) for i in range(turn * 40_000, (turn + 1) * 40_000))]) for turn in range(4)]
    for text in texts * 2:
        data = np.frombuffer(text.encode(), np.uint8)
        assert side.encode(data, np.array([0, len(data)]))[0].tolist() == model.encode(text[1:])
    assert len(asked) == len(set(asked)) == 160_000
