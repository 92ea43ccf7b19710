"""Language ID (3): script ranges, then Viterbi over words.

Training counts hashed byte trigrams (with word borders) and whole words per
language, and how often the words of a language are in a script. Scripts
narrow the languages of each word: a language is a candidate for a word's
script if it had at least ``SCRIPT_SHARE`` of its training words in it. A
word's score per language is the naive Bayes log likelihood of its trigrams
and itself. Viterbi with a switching penalty labels the words of a text, so
mixed text becomes spans; the text's language is the one with most bytes of
words, its score the share of these.

Training uses at most about ``PER_LANGUAGE`` documents of each language
(smallest id hashes), a bound that does not grow with the input. The model is
one table of languages x buckets; it goes to the tasks with the function.
Prediction reads whole texts in one pass without a shuffle.

Defined cases: null texts and texts without a letter are ``und`` with score 0
and no spans; texts whose letters are in no script of the training words get the
language with most training documents and score 0; of languages with equal
scores the first by name counts; repeated rows count as often in training and
each get a row; without training rows everything is
``und``; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, functions as F

from seqrisk.llm import bytes_text as bt
from seqrisk.llm.common import by_value

BUCKETS = 1 << 15
PER_LANGUAGE = 3_000
SWITCH = 12.0
SCRIPT_SHARE = 0.01
GROUP_BYTES = 1 << 24
SMOOTHING = 0.5
_U = np.uint64
by_value(__name__)

# Scripts by first code point of a range (public Unicode blocks); 0 is none of these.
_RANGES = [(0x00, 0), (0xC0, 1), (0x250, 1), (0x2B0, 0), (0x370, 2), (0x400, 3), (0x530, 4), (0x590, 5), (0x600, 6),
           (0x700, 0), (0x900, 7), (0x980, 8), (0xA00, 0), (0xE00, 9), (0xE80, 0), (0x10A0, 10), (0x1100, 11),
           (0x1200, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x3040, 12), (0x3100, 0), (0x3400, 13), (0xA000, 0),
           (0xAC00, 11), (0xD7B0, 0), (0xF900, 13), (0xFB00, 0)]
LISTED = 14
PLANES = 4               # code points above have no script
# All other letters: one class for each 128 code points of the first plane, and for each 4096 of the others.
SCRIPTS = LISTED + (1 << 16 >> 7) + (PLANES << 16 >> 12)
# Script of every code point; signs and digits have none.
_SCRIPT = np.zeros(PLANES << 16, np.uint16)
for (_at, _number), (_end, _) in zip(_RANGES, [*_RANGES[1:], (PLANES << 16, 0)]):
    for _c in range(max(_at, 0x80), _end):
        if chr(_c).isalpha():
            _SCRIPT[_c] = _number or LISTED + (_c >> 7 if _c < 1 << 16 else (1 << 9) + (_c >> 12))


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    scores: np.ndarray       # float32 (2 x BUCKETS, languages): trigrams, then words
    candidate: np.ndarray    # bool (SCRIPTS, languages)
    prior: int               # the language with most training documents


def _scripts(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Script of each word: that of its last non-ASCII letter with one, else Latin if it has an ASCII letter."""
    low = bt.FOLD[data]
    letters = np.concatenate([[0], np.cumsum((low >= 97) & (low <= 122))])
    script = (letters[end] > letters[start]).astype(np.int64)
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        padded = np.append(data, np.zeros(3, np.uint8)).astype(np.int64)
        b0, b1, b2, b3 = padded[lead], padded[lead + 1] & 63, padded[lead + 2] & 63, padded[lead + 3] & 63
        code = np.where(b0 < 0xE0, (b0 & 31) << 6 | b1, np.where(b0 < 0xF0, (b0 & 15) << 12 | b1 << 6 | b2, (b0 & 7) << 18 | b1 << 12 | b2 << 6 | b3))
        found = _SCRIPT[np.where(code < len(_SCRIPT), code, 0)]
        word = np.searchsorted(start, lead, "right") - 1
        some = (found > 0) & (word >= 0)
        script[word[some]] = found[some]
    return script


def _features(data: np.ndarray, offsets: np.ndarray):
    """Of a block's words: first word of each text, length, script, word bucket,
    and for every byte of a word its trigram's bucket, with each word's first."""
    start, end, word, first = bt.words(data, offsets)
    low = bt.FOLD[data].astype(np.uint32)
    inside = low != 0
    before, after = np.zeros_like(low), np.zeros_like(low)
    before[1:], after[:-1] = low[:-1], low[1:]
    before[start] = 0
    after[end - 1] = 0
    code = (before << np.uint32(16) | low << np.uint32(8) | after)[inside]
    gram = (code * np.uint32(2654435761) >> np.uint32(17)).astype(np.int64) % BUCKETS
    length = end - start
    at = np.cumsum(length) - length
    return first, length, _scripts(data, start, end), BUCKETS + (word % _U(BUCKETS)).astype(np.int64), gram, at


def train(docs: DataFrame, use: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Learn from text and language of the rows where ``use`` holds and the language is not null."""
    rows = docs.where(use & F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull()).select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"),
        (F.xxhash64(F.col(f"`{id_col}`")).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))).alias("h"))
    size = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}   # one row per language
    if not size:
        return LanguageModel([], np.zeros((2 * BUCKETS, 0), np.float32), np.zeros((SCRIPTS, 0), bool), -1)
    share = F.create_map(*[F.lit(x) for k, n in size.items() for x in (k, min(1.0, per_language / n))])
    sample = rows.where(F.col("h") < share[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for at, n, data, offsets in bt.blocks(batch.column(1)):
                first, length, script, word, gram, begin = _features(data, offsets)
                langs = np.array(batch.column(0).slice(at, n).to_pylist(), object)
                ends = np.append(begin, len(gram))
                for k, lang in enumerate(langs):
                    t = total.setdefault(lang, np.zeros(2 * BUCKETS + SCRIPTS, np.int64))
                    a, b = first[k], first[k + 1]
                    np.add.at(t, gram[ends[a]:ends[b]], 1)
                    np.add.at(t, word[a:b], 1)
                    np.add.at(t, 2 * BUCKETS + script[a:b], 1)
        for lang, t in total.items():
            some = np.flatnonzero(t)
            yield pa.record_batch([pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(t[some])],
                                  names=["lang", "slot", "n"])

    counts = (sample.mapInArrow(count, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
              .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("slot", "n"))).alias("c")))   # at most 2 x BUCKETS + SCRIPTS each
    languages = sorted(size)
    table = np.zeros((2 * BUCKETS + SCRIPTS, len(languages)))
    for r in counts.toLocalIterator():
        c = np.array([(x["slot"], x["n"]) for x in r["c"]], np.int64).reshape(-1, 2)
        table[c[:, 0], languages.index(r["lang"])] = c[:, 1]
    parts = []
    for part in (table[:BUCKETS], table[BUCKETS:2 * BUCKETS]):
        p = np.log((part + SMOOTHING) / (part.sum(axis=0) + SMOOTHING * BUCKETS))
        parts.append(p - p.mean(axis=1, keepdims=True))
    scripts = table[2 * BUCKETS:]
    return LanguageModel(languages, np.concatenate(parts).astype(np.float32),
                         scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1), max(range(len(languages)), key=lambda i: size[languages[i]]))


def viterbi(score: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """Best language of every word. score: (words, languages); all texts take
    their t-th step together, longest texts first."""
    n_words = np.diff(first)
    order = np.argsort(-n_words, kind="stable")
    n_words, begin = n_words[order], first[:-1][order]
    steps = int(n_words[0]) if len(n_words) else 0
    active = np.searchsorted(-n_words, -np.arange(steps), "left")
    value = np.zeros((len(n_words), score.shape[1]), np.float32)
    own = np.arange(score.shape[1], dtype=np.int16)[None, :]
    back = []
    for t in range(steps):
        k = active[t]
        v = value[:k]
        top = v.argmax(axis=1)
        change = v[np.arange(k), top][:, None] - np.float32(switch)
        stay = v >= change
        back.append(np.where(stay, own, top[:, None].astype(np.int16)))
        value[:k] = np.where(stay, v, change) + score[begin[:k] + t]
    label = np.zeros(len(score), np.int16)
    state = value.argmax(axis=1) if score.shape[1] else np.zeros(len(n_words), np.int64)
    for t in range(steps - 1, -1, -1):
        k = active[t]
        label[begin[:k] + t] = state[:k]
        state[:k] = back[t][np.arange(k), state[:k]]
    return label


def _word_scores(model: LanguageModel, data: np.ndarray, offsets: np.ndarray):
    first, length, script, word, gram, at = _features(data, offsets)
    if len(at):
        score = np.add.reduceat(model.scores[gram], at, axis=0) + model.scores[word]
        allowed = model.candidate[script]
        known = allowed.any(axis=1) & (script > 0)
        score = np.where(known[:, None], np.where(allowed, score, np.float32(-1e4)), np.float32(0))
    else:
        score, known = np.zeros((0, len(model.languages)), np.float32), np.zeros(0, bool)
    return first, length, score, known


def _spans(label: np.ndarray, first: np.ndarray, languages: list[str]) -> pa.Array:
    """Runs of words with one label, per text: (lang, first word of it, words)."""
    n = len(label)
    new = np.ones(n, bool)
    new[1:] = label[1:] != label[:-1]
    new[first[:-1][first[:-1] < n]] = True
    at = np.flatnonzero(new)
    doc = np.searchsorted(first, at, "right") - 1
    words = np.diff(np.append(at, n))
    span = pa.StructArray.from_arrays([pa.array(languages, pa.string()).take(pa.array(label[at])), pa.array(at - first[doc], pa.int64()),
                                       pa.array(words, pa.int64())], names=["lang", "first_word", "words"])
    return pa.ListArray.from_arrays(np.searchsorted(at, first).astype(np.int32), span)


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text",
            switch: float = SWITCH) -> DataFrame:
    """id, lang_pred, score, spans (lang, first word, number of words) of every row; only the text is looked at."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    n_lang = len(model.languages)
    block = max(1 << 16, bt.BLOCK_BYTES * 4 // max(4, n_lang))

    def finish(ids: pa.Array, texts: pa.Array, parts: list) -> pa.RecordBatch:
        first = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p[0]) for p in parts]))])
        length, score, known = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
        n = len(first) - 1
        label = viterbi(score, first, switch) if n_lang else np.zeros(len(score), np.int16)
        doc = np.repeat(np.arange(n), np.diff(first))
        share = np.bincount(doc[known] * max(n_lang, 1) + label[known], length[known], n * max(n_lang, 1)).reshape(n, -1)
        total = share.sum(axis=1)
        best = share.argmax(axis=1)
        lang = [model.languages[b] if n_lang and t > 0 else "und" for b, t in zip(best.tolist(), total.tolist())]
        for i in np.flatnonzero(total == 0):
            if n_lang and any(c.isalpha() for c in texts[int(i)].as_py() or ""):
                lang[i] = model.languages[model.prior]
        spans = _spans(label, first, model.languages or ["und"])
        spans = pa.compute.if_else(pa.array(total > 0), spans, pa.scalar([], spans.type))
        return pa.record_batch([ids, pa.array(lang, pa.string()), pa.array(share.max(axis=1) / np.maximum(total, 1)), spans],
                               names=["id", "lang_pred", "score", "spans"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, size, begin = [], 0, 0
            for at, n, data, offsets in bt.blocks(batch.column(1), block):
                parts.append(_word_scores(model, data, offsets))
                size += len(data) * max(1, n_lang // 4)
                if size >= GROUP_BYTES or at + n == batch.num_rows:
                    rows_ = at + n - begin
                    yield finish(batch.column(0).slice(begin, rows_), batch.column(1).slice(begin, rows_), parts)
                    parts, size, begin = [], 0, at + n

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(work, f"id {kind}, lang_pred string, score double, spans array<struct<lang:string,first_word:bigint,words:bigint>>")
