"""MinHash near-dedup (7): ProbMinHash signatures, banding, verification.

A text's shingles of five words, weighted by how often they occur, arrive as
Poisson processes: the r-th arrival of a shingle of weight w is a sum of
exponentials over w, and falls on a register chosen by hash; a register keeps
the first arrival. Arrivals of a shingle stop once they are later than the
text's largest register (early termination). Two registers agree with the
probability Jaccard of the weighted shingles.

Texts of equal words are one class with one signature. Signatures are cut
into bands; classes that share a band are candidates. Per band value all
classes are compared with the smallest one (a star, not all pairs), and with
a few others chosen by hash if they are many. Where a
band value still holds more than one component, every pair between members of
different components is compared too, unless it cannot reach the threshold:
with a and b at most the shares of weight that two texts have in shingles that
the other lacks, their probability Jaccard is at most
(1 - a) (1 - b) / (1 - a b); if no shingle repeats in either, it is the Jaccard
of sets of x and y shingles that share at most c = min(x (1 - a), y (1 - b)),
so at most c / (x + y - c). Two such shares are known without the texts: that
of shingles of no other text in question, and that of the bits that only one of
the two has in a map of ``MAP_BITS`` bits which a text's shingles set (each such
bit is a shingle that the other lacks). So each candidate pair is compared,
already connected or impossible. Comparison recomputes the exact probability
Jaccard from the whole texts.

Defined cases: null texts and texts without a word link with nothing; a text
of fewer than five words is one shingle; rows with a null id keep a null
class and are kept; rows that share an id are one document; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from seqrisk.llm import bytes_text as bt
from seqrisk.llm.common import by_value, saved, small
from seqrisk.llm.components import components

WORDS = 5
SIMILARITY = 0.8
PAIRS_AT_ONCE = 512       # bounds the shingles that a task holds
PIVOTS, MANY = 3, 8      # more centres of comparison for band values with many texts
MAP_BITS = 1024          # of a text's shingle map; a bound only, so its size changes no result
BANDS, ROWS = 24, 7      # a pair of similarity 0.8 shares a band with probability 0.996
_U = np.uint64
by_value(__name__)


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def prob_min_hash(hashes: np.ndarray, doc: np.ndarray, weight: np.ndarray, n_docs: int, registers: int) -> np.ndarray:
    """Signatures (n_docs, registers): the shingle that reached each register first."""
    first = np.full(n_docs * registers, np.inf)
    winner = np.zeros(n_docs * registers, _U)
    latest = np.full(n_docs, np.inf)
    h, d, w = hashes, doc, weight.astype(np.float64)
    time = np.zeros(len(h))
    turn = 0
    while len(h):
        turn += 1
        draw = bt.mix(h + bt.spread(turn))
        time = time - np.log(_uniform(draw)) / w
        alive = time < latest[d]
        h, d, w, time, draw = h[alive], d[alive], w[alive], time[alive], draw[alive]
        place = d * registers + (bt.mix(draw ^ _U(0xA5A5A5A5A5A5A5A5)) % _U(registers)).astype(np.int64)
        np.minimum.at(first, place, time)
        hit = first[place] == time
        winner[place[hit]] = h[hit]
        latest = first.reshape(n_docs, registers).max(axis=1)
        alive = time < latest[d]
        h, d, w, time = h[alive], d[alive], w[alive], time[alive]
    return winner.reshape(n_docs, registers)


def _shingles(data: np.ndarray, offsets: np.ndarray, size: int):
    _, _, word, first = bt.words(data, offsets)
    s, doc = bt.shingles(word, first, size)
    return word, first, bt.weighted(s, doc)


def signatures(docs: DataFrame, id_col: str, text_col: str, size: int, bands: int, rows: int) -> DataFrame:
    """id, key1, key2 (of the word sequence; null without words), total (number of
    shingles), plain (none repeats), bits (the shingle map), bands."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n, data, offsets in bt.blocks(batch.column(1)):
                word, first, (h, d, c) = _shingles(data, offsets, size)
                sig = prob_min_hash(h, d, c, n, bands * rows).reshape(n, bands, rows)
                key = np.zeros((n, bands), _U)
                for r in range(rows):
                    key = bt.mix(key * _U(0x100000001B3) + sig[:, :, r])
                key = bt.mix(key + np.arange(bands, dtype=_U))
                k1 = bt.span_hashes(word, first[:-1], first[1:])
                k2 = bt.span_hashes(bt.mix(word ^ _U(0x5851F42D4C957F2D)), first[:-1], first[1:])
                empty = np.diff(first) == 0
                bits = np.zeros((n, MAP_BITS // 64), _U)
                np.bitwise_or.at(bits, (d, ((h >> _U(6)) % _U(MAP_BITS // 64)).astype(np.int64)), _U(1) << (h & _U(63)))
                maps = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * bits.shape[1], bits.view(np.int64).ravel())
                lists = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * bands, key.view(np.int64).ravel())
                total = np.bincount(d, c, n).astype(np.int64)
                yield pa.record_batch([batch.column(0).slice(at, n), pa.array(k1.view(np.int64), mask=empty),
                                       pa.array(k2.view(np.int64), mask=empty), pa.array(total),
                                       pa.array(total == np.bincount(d, minlength=n)), maps, lists],
                                      names=["id", "key1", "key2", "total", "plain", "bits", "bands"])

    rows_ = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows_.mapInArrow(work, "id long, key1 long, key2 long, total long, plain boolean, bits array<long>, bands array<long>")


def probability_jaccard(h1: np.ndarray, w1: np.ndarray, h2: np.ndarray, w2: np.ndarray) -> float:
    """Sum over shared shingles d of 1 / sum over e of max(x_e / x_d, y_e / y_d).
    For shared d the inner sum is Y(t) / y_d with e's term max(x_e t, y_e),
    t = y_d / x_d, so shingles are sorted by y_e / x_e once."""
    both, i, j = np.intersect1d(h1, h2, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    x = np.concatenate([w1[i], np.delete(w1, i), np.zeros(len(h2) - len(j))]).astype(np.float64)
    y = np.concatenate([w2[j], np.zeros(len(h1) - len(i)), np.delete(w2, j)]).astype(np.float64)
    with np.errstate(divide="ignore"):
        ratio = np.where(x > 0, y / x, np.inf)
    order = np.argsort(ratio, kind="stable")
    below = np.concatenate([[0.0], np.cumsum(x[order])])           # of e with ratio <= t: x_e t
    above = np.concatenate([[0.0], np.cumsum(y[order])])           # of the others: y_e
    t = y[:len(both)] / x[:len(both)]
    k = np.searchsorted(ratio[order], t, "right")
    return float(np.sum(y[:len(both)] / (below[k] * t + above[-1] - above[k])))


def verify(pairs: DataFrame, texts: DataFrame, size: int, least: float) -> DataFrame:
    """Pairs (a, b) with similarity of at least ``least``, with it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, PAIRS_AT_ONCE) for b in batches for k in range(0, b.num_rows, PAIRS_AT_ONCE)):
            sides = []
            for col in (2, 3):
                found = []
                for _, n, data, offsets in bt.blocks(batch.column(col)):
                    _, _, (h, d, c) = _shingles(data, offsets, size)
                    cut = np.searchsorted(d, np.arange(n + 1))
                    found += [(h[cut[k]:cut[k + 1]], c[cut[k]:cut[k + 1]]) for k in range(n)]
                sides.append(found)
            s = np.array([probability_jaccard(*p, *q) for p, q in zip(*sides)], np.float64)
            yes = pa.array(s >= least)
            yield pa.record_batch([batch.column(0).filter(yes), batch.column(1).filter(yes), pa.array(s[s >= least])],
                                  names=["a", "b", "similarity"])

    at = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    bt_ = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    return (pairs.select("a", "b").join(at, "a").join(bt_, "b").select("a", "b", "ta", "tb")
            .mapInArrow(work, "a long, b long, similarity double"))


def own_share(texts: DataFrame, size: int) -> DataFrame:
    """(node, own): share of a text's shingle weight in shingles of no other of ``texts``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n, data, offsets in bt.blocks(batch.column(1)):
                _, _, (h, d, c) = _shingles(data, offsets, size)
                share = c / np.bincount(d, c, n)[d]
                yield pa.record_batch([batch.column(0).slice(at, n).take(pa.array(d)), pa.array(h.view(np.int64)), pa.array(share)],
                                      names=["node", "shingle", "share"])

    each = texts.select("id", "text").mapInArrow(work, "node long, shingle long, share double")
    alone = each.groupBy("shingle").agg(F.count("*").alias("n"), F.min("node").alias("node"), F.min("share").alias("share")).where("n = 1")
    return alone.groupBy("node").agg(F.sum("share").alias("own"))


def _texts(docs: DataFrame, id_col: str, text_col: str, ids: DataFrame) -> DataFrame:
    """Texts of the given ids, one row each, as a table."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    ids = F.broadcast(ids) if small(ids) else ids
    return saved(rows.join(ids, "id", "left_semi").dropDuplicates(["id"]))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS,
                    least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """(membership, links): one row per row of ``docs`` with id, class_id (the
    smallest id of texts with equal words), component_id (the smallest id
    linked with it, directly or not) and kept; and the compared pairs of
    classes that are similar (a, b, similarity)."""
    sig = saved(signatures(docs, id_col, text_col, size, bands, rows))
    known = sig.where("id is not null and key1 is not null")
    classes = saved(known.groupBy("key1", "key2").agg(F.min("id").alias("class_id"), F.any_value("total").alias("total"),
                                                        F.any_value("plain").alias("plain"), F.any_value("bits").alias("bits"),
                                                        F.any_value("bands").alias("bands")))
    member = saved(classes.select("class_id", F.posexplode("bands").alias("band", "value"))
                   .select(F.xxhash64("band", "value").alias("bucket"), F.col("class_id").alias("node")))
    by_hash = [F.min(F.struct(F.xxhash64(F.lit(p), "node"), "node"))["node"] for p in range(PIVOTS)]
    hubs = member.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("hub"), F.array(*by_hash).alias("more")).where("n > 1")
    hubs = hubs.select("bucket", F.when(F.col("n") > MANY, F.array_distinct(F.concat(F.array("hub"), "more"))).otherwise(F.array("hub")).alias("hubs"))
    shared = saved(member.join(hubs, "bucket").select("bucket", "node", "hubs"))
    stars = shared.select("node", F.explode("hubs").alias("hub")).where("node <> hub")
    stars = saved(stars.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct())
    texts = _texts(docs, id_col, text_col, shared.select(F.col("node").alias("id")).distinct())
    links = saved(verify(stars, texts, size, least))
    found = components(links)

    labelled = saved(shared.join(found, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component")))
    per = labelled.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    mixed = (per.groupBy("bucket").agg(F.max(F.struct("n", "component"))["component"].alias("main"), F.count("*").alias("parts"))
             .where("parts > 1").drop("parts"))
    rest = saved(labelled.join(mixed, "bucket"))
    left = saved(rest.select(F.col("node").alias("id")).distinct())
    own = own_share(texts.join(F.broadcast(left) if small(left) else left, "id", "left_semi"), size)
    # what cannot reach the threshold with any text leaves first, then pairs that cannot
    size_of = classes.select(F.col("class_id").alias("node"), "total", "plain", "bits")
    rest = saved(rest.join(own, "node", "left").withColumn("own", F.coalesce("own", F.lit(0.0)))
                 .where(F.col("own") <= 1 - least + 1e-9).join(size_of, "node"))
    minor = rest.where("component <> main").select("bucket", F.col("node").alias("u"), F.col("component").alias("cu"),
                                                   F.col("own").alias("ou"), F.col("total").alias("tu"), F.col("plain").alias("pu"), F.col("bits").alias("bu"))

    def lacking(one: str, other: str) -> Column:
        """Number of bits that only ``one`` of two maps has."""
        each = [F.bit_count(F.col(one)[i].bitwiseAND(F.bitwise_not(F.col(other)[i]))) for i in range(MAP_BITS // 64)]
        return sum(each[1:], each[0])

    a = F.greatest("own", lacking("bits", "bu") / F.col("total"))
    b = F.greatest("ou", lacking("bu", "bits") / F.col("tu"))
    some = (1 - a) * (1 - b) >= (least - 1e-9) * (1 - a * b)
    common = F.least(F.col("total") * (1 - a), F.col("tu") * (1 - b))
    can = some & (~(F.col("plain") & F.col("pu")) | (common * (1 + least) >= (least - 1e-9) * (F.col("total") + F.col("tu"))))
    more = (minor.join(rest.withColumnRenamed("bucket", "other"), (F.col("bucket") == F.col("other")) & can & F.expr(
                "cu <> component and (component = main or u < node)"))
            .select(F.least("u", "node").alias("a"), F.greatest("u", "node").alias("b")).distinct()
            .join(stars, ["a", "b"], "left_anti"))
    links = saved(links.unionByName(verify(saved(more), texts, size, least)))
    found = components(links)
    named = classes.select("key1", "key2", "class_id").join(
        found.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        "key1", "key2", "class_id", F.coalesce("component", "class_id").alias("component_id"))
    rows_ = sig.select("id", "key1", "key2").join(named, ["key1", "key2"], "left")
    class_id = F.when(F.col("id").isNotNull(), F.coalesce("class_id", "id"))
    component_id = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    out = rows_.select("id", class_id.alias("class_id"), component_id.alias("component_id"),
                       F.coalesce(F.col("id") == component_id, F.lit(True)).alias("kept"))
    return out, links


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` without all but the smallest id of every group of near-duplicates
    (rows that share an id are one document and stay or go together)."""
    member, _ = near_duplicates(docs, id_col, text_col, **settings)
    member = saved(member)
    gone = saved(member.where("not kept").select("id").distinct())
    g = F.broadcast(gone) if small(gone) else gone
    return docs.join(g.withColumnRenamed("id", "__gone"), F.col(f"`{id_col}`") == F.col("__gone"), "left_anti")
