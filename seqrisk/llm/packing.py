"""Best-fit packing (10): a grouping genetic algorithm on islands.

``tokenize`` turns each document into token ids and cuts documents longer
than a sequence into full pieces and one shorter first piece. ``pack`` places
the pieces into as few sequences as it can. Full pieces are sequences of their
own. The others are dealt by hash into blocks of about ``BLOCK`` pieces. Every
block is worked on by several islands, each with a population of packings: a
child takes over whole well-filled bins of one parent, bins of the other
parent that repeat an injected piece are dissolved, and the pieces displaced
by this are placed best-fit, longest first. After each epoch the elite of an
island moves on to the next island of its block. Of the best packing of a
block, the full enough bins are final; the pieces of the other bins are dealt
into blocks again, of which there are far fewer, until one block is left.

No task holds more than a block; blocks are dealt by hash, so a source or a
length that a third of all rows share is spread. Each stage is a narrow table
in the shared folder: tokens are made once.

Defined cases: a null text is empty and is the end token alone; an empty
table gives an empty result; repeated rows are packed each; columns beside
id and text are ignored.
"""

from __future__ import annotations

import random
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from seqrisk.llm import bytes_text as bt
from seqrisk.llm.common import by_value, saved

CAPACITY = 1024
END_ID = 2
BLOCK = 2048
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
CHILDREN = 6
CACHE = 1 << 16          # pieces that a task keeps in a dictionary, some 0.4 KB each
KEPT = 1 << 20           # pieces that a task keeps in flat arrays, some 50 bytes each
SPECIAL = b"<|endoftext|>"
by_value(__name__)

# Byte classes of the vocabulary's split pattern; 4: only the tokenizer itself decides.
_SPACE, _LETTER, _DIGIT, _OTHER, _ASK = range(5)
_kind = np.full(256, _ASK, np.uint8)
for _c in range(0x21, 0x7F):
    _kind[_c] = _LETTER if chr(_c).isalpha() else _DIGIT if chr(_c).isdigit() else _OTHER
for _c in (0x20, 0x09, 0x0A, 0x0D):
    _kind[_c] = _SPACE
for _c in (0xC3, *range(0x80, 0xC0)):
    _kind[_c] = _LETTER


def _plain(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts hold only ASCII and accented Latin letters, and no special token."""
    odd = _kind[data] == _ASK
    lead = data == 0xC3
    tail = (data >= 0x80) & (data < 0xC0)
    if len(data):
        odd[1:] |= tail[1:] & (~lead[:-1] | (data[1:] == 0x97) | (data[1:] == 0xB7))
    seen = np.concatenate([[0], np.cumsum(odd)])
    plain = seen[offsets[1:]] == seen[offsets[:-1]]
    raw = data.tobytes()
    if SPECIAL in raw:
        for i in np.flatnonzero(plain):
            plain[i] = SPECIAL not in raw[offsets[i]:offsets[i + 1]]
    return plain


def _piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces begin that byte pairs are merged within: a run of
    letters, of digits or of other signs with one space before it, the rest of
    white space by itself, and the English endings behind an apostrophe."""
    n = len(data)
    kind = _kind[data]
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    space = kind == _SPACE
    before, after = np.roll(kind, 1), np.roll(kind, -1)
    start = np.where(space, (before != _SPACE) | ((after != _SPACE) & ~border[1:]),
                     (before != kind) & (np.roll(data, 1) != 0x20))
    start |= border[:n]
    quote = np.flatnonzero((data == 0x27) & start)
    if len(quote):
        text_end = offsets[np.searchsorted(offsets, quote, "right")]
        one = np.append(data, [0, 0, 0])[quote + 1]
        two = np.append(data, [0, 0, 0])[quote + 2]
        pair = one.astype(np.int64) << 8 | two
        long = np.isin(pair, [0x7265, 0x7665, 0x6C6C]) & (quote + 2 < text_end)      # re ve ll
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8)) & (quote + 1 < text_end)
        for some, size in ((long & ~short, 3), (short, 2)):
            at = quote[some]
            start[at + 1] = False
            rest = at + size
            start[rest[rest < text_end[some]]] = True
    return np.flatnonzero(start)


class _Encoder:
    """Token ids of many texts. A piece's ids are found once and kept in flat
    arrays. New pieces are found in a dictionary; when it holds ``CACHE`` of them
    they move into arrays sorted by hash, which are emptied at ``KEPT`` pieces or
    16 bytes for each."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tokenizer = Tokenizer.from_file(path)
        # the letters that stand for bytes in the vocabulary: printable ones for
        # themselves, the rest from 256 on
        self.letters = {b: b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255}
        self.letters |= {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in self.letters)}
        assert {chr(c) for c in self.letters.values()} == set(ByteLevel.alphabet())
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.begin = array("I"), array("q", [0])
        self.raw, self.raw_begin = bytearray(), array("q", [0])
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def _merge(self, pieces: list[bytes]) -> tuple[list[int], np.ndarray]:
        """Ids of all ``pieces``, and how many each has."""
        merge, letters = self.tokenizer.model.tokenize, self.letters
        found = [[t.id for t in merge(p.decode("latin-1").translate(letters))] for p in pieces]
        return [i for ids in found for i in ids], np.array([len(ids) for ids in found], np.int64)

    def _learn(self, pieces: list[bytes]) -> None:
        """Take new pieces into the dictionary."""
        ids, n = self._merge(pieces)
        first = len(self.begin) - 1
        self.flat.extend(ids)
        self.begin.extend((self.begin[-1] + np.cumsum(n)).tolist())
        self.raw += b"".join(pieces)
        self.raw_begin.extend((self.raw_begin[-1] + np.cumsum([len(p) for p in pieces])).tolist())
        self.known.update(zip(pieces, range(first, first + len(pieces))))

    def _settle(self) -> None:
        """Move the dictionary's pieces into the sorted arrays."""
        if len(self.begin) > KEPT or len(self.raw) > 16 * KEPT:
            self._forget()
            return
        number = np.fromiter(self.known.values(), np.int64, len(self.known))        # neighbours: they were learnt in a row
        ends = np.frombuffer(self.raw_begin, np.int64)[number[0]:]
        made = bt.span_hashes(np.frombuffer(self.raw, np.uint8)[ends[0]:], ends[:-1] - ends[0], ends[1:] - ends[0])
        hashes, numbers = np.append(self.hashes, made), np.append(self.numbers, number)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.numbers = hashes[order], numbers[order]
        self.known = {}

    def _settled(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Number of each piece in the sorted arrays, -1: it has none. The bytes decide, not the hash."""
        out = np.full(len(hashes), -1)
        at = np.searchsorted(self.hashes, hashes)
        seen = np.flatnonzero(at < len(self.hashes))
        seen = seen[self.hashes[at[seen]] == hashes[seen]]
        number, begin = self.numbers[at[seen]], np.frombuffer(self.raw_begin, np.int64)
        size = ends[seen] - starts[seen]
        alike = size == begin[number + 1] - begin[number]
        seen, number, size = seen[alike], number[alike], size[alike]
        if len(seen):
            ahead = np.cumsum(size) - size
            within = np.arange(int(size.sum()))
            differs = (data[np.repeat(starts[seen] - ahead, size) + within]
                       != np.frombuffer(self.raw, np.uint8)[np.repeat(begin[number] - ahead, size) + within])
            same = np.add.reduceat(differs, ahead, dtype=np.int64) == 0
            out[seen[same]] = number[same]
        return out

    def _plain_ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, and where each piece's begin."""
        hashes, at, which = np.unique(bt.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > CACHE or len(self.raw) > 16 * KEPT:
            self._settle()
        found = self._settled(data, starts[at], ends[at], hashes)
        asked = np.flatnonzero(found < 0)
        raw, known = data.tobytes(), self.known
        pieces = [raw[s:e] for s, e in zip(starts[at[asked]].tolist(), ends[at[asked]].tolist())]
        new = list(dict.fromkeys(p for p in pieces if p not in known))
        if new:
            self._learn(new)
        found[asked] = [known[p] for p in pieces]
        flat = np.frombuffer(self.flat, np.uint32) if self.flat else np.zeros(0, np.uint32)
        begin = np.frombuffer(self.begin, np.int64)
        token = found[which]
        n = begin[token + 1] - begin[token]
        ahead = np.cumsum(n) - n
        ids = flat[np.repeat(begin[token] - ahead, n) + np.arange(int(n.sum()))]
        return ids, np.append(ahead, len(ids))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each text."""
        plain = _plain(data, offsets)
        starts = _piece_starts(data, offsets)
        ends = np.append(starts[1:], len(data)).astype(np.int64)
        use = np.repeat(plain, np.diff(np.searchsorted(starts, offsets)))
        starts, ends = starts[use], ends[use]
        out = [np.zeros(0, np.uint32)] * len(plain)
        if len(starts):
            ids, begin = self._plain_ids(data, starts, ends)
            cut = begin[np.searchsorted(starts, offsets)]
            for i in np.flatnonzero(plain):
                out[i] = ids[cut[i]:cut[i + 1]]
        asked = np.flatnonzero(~plain)
        texts = [data[offsets[i]:offsets[i + 1]].tobytes().decode() for i in asked]
        for i, e in zip(asked, self.tokenizer.encode_batch(texts, add_special_tokens=False)):
            out[i] = np.array(e.ids, np.uint32)
        return out


def tokenize(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
             end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(path)
        for batch in batches:
            for first, n, data, offsets in bt.blocks(batch.column(1)):
                ids = encoder.encode(data, offsets)
                rows: list[tuple[int, int, int, int, int]] = []
                for i in range(n):
                    own = np.append(ids[i], np.uint32(end_id)).astype("<u4")
                    cuts = [0, *range(len(own) % capacity or capacity, len(own) + 1, capacity)]
                    rows += [(i, k, a, b - a, zlib.crc32(own[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
                cols = list(zip(*rows))
                yield pa.record_batch([batch.column(0).take(pa.array(np.array(cols[0]) + first)),
                                       pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:])],
                                      names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, piece int, start long, length long, ids_crc32 long")


class _Bins:
    """Open bins by room left; best fit in constant time for integer sizes."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.by_room, self.mask = capacity, [[] for _ in range(capacity + 1)], 0

    def add(self, bin_: list[int], room: int) -> None:
        if room:
            self.by_room[room].append(bin_)
            self.mask |= 1 << room

    def place(self, item: int, size: int) -> list[int] | None:
        """Put ``item`` into the bin with least room that holds it; a new bin is returned."""
        fits = self.mask >> size
        made = None
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            bin_ = self.by_room[room].pop()
            if not self.by_room[room]:
                self.mask ^= 1 << room
        else:
            room, bin_ = self.capacity, []
            made = bin_
        bin_.append(item)
        self.add(bin_, room - size)
        return made


def best_fit(items: list[int], size: list[int], capacity: int, start: list[list[int]] = ()) -> list[list[int]]:
    """Best fit of ``items`` in their order into copies of the bins ``start`` and new ones."""
    bins = [list(b) for b in start]
    open_ = _Bins(capacity)
    for b in bins:
        open_.add(b, capacity - sum(size[i] for i in b))
    for i in items:
        made = open_.place(i, size[i])
        if made is not None:
            bins.append(made)
    return bins


def fitness(bins: list[list[int]], size: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins are better, then fuller and emptier ones rather than even ones."""
    return -len(bins), sum((sum(size[i] for i in b) / capacity) ** 2 for b in bins)


def crossover(giver: list[list[int]], taker: list[list[int]], size: list[int], capacity: int,
              rng: random.Random) -> list[list[int]]:
    """Whole well-filled bins of ``giver`` go into ``taker``; bins that repeat a
    piece are dissolved and their other pieces placed best-fit, longest first."""
    full = sorted(giver, key=lambda b: sum(size[i] for i in b), reverse=True)
    some = rng.sample(full[:max(1, len(full) * 3 // 4)], max(1, len(full) // 4))
    taken = {i for b in some for i in b}
    stays, displaced = [], []
    for b in taker:
        if taken.isdisjoint(b):
            stays.append(b)
        else:
            displaced += [i for i in b if i not in taken]
    displaced.sort(key=lambda i: (-size[i], rng.random()))
    return best_fit(displaced, size, capacity, some + stays)


def evolve(size: list[int], elite: list[list[list[int]]], capacity: int, seed: str, population: int,
           children: int) -> list[list[list[int]]]:
    """The two best packings of one island after an epoch; ``elite`` are packings
    that it starts from. A packing at the lower bound ends the search."""
    rng = random.Random(seed)
    least = -(-sum(size) // capacity)
    pool = list(elite)
    while len(pool) < population:
        spread = 0.0 if not pool else 0.1
        order = sorted(range(len(size)), key=lambda i: -size[i] * (1 - spread * rng.random()))
        pool.append(best_fit(order, size, capacity))
        if len(pool[-1]) <= least:
            break
    rank = lambda b: fitness(b, size, capacity)
    pool.sort(key=rank, reverse=True)
    for _ in range(children):
        if len(pool[0]) <= least or len(pool) < 2:
            break
        giver, taker = rng.sample(pool[:population], 2)
        pool = sorted([*pool, crossover(giver, taker, size, capacity, rng)], key=rank, reverse=True)[:population]
    return pool[:2]


def _numbers(bins: list[list[int]], n: int) -> list[int]:
    of = [0] * n
    for k, b in enumerate(bins):
        for i in b:
            of[i] = k
    return of


def _bins(numbers: list[int]) -> list[list[int]]:
    out: dict[int, list[int]] = {}
    for i, k in enumerate(numbers):
        out.setdefault(k, []).append(i)
    return list(out.values())


def _epoch(state: DataFrame, capacity: int, population: int, children: int, epoch: int, seed: int) -> DataFrame:
    """(block, island, items, sizes, elite) with the elite after one epoch."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, island, sizes, elite in zip(*(batch.column(c).to_pylist() for c in ("block", "island", "sizes", "elite"))):
                best = evolve(sizes, [_bins(e) for e in elite], capacity, f"{seed}/{epoch}/{block}/{island}", population, children)
                yield pa.record_batch([pa.array([block]), pa.array([island], pa.int32()),
                                       pa.array([[_numbers(b, len(sizes)) for b in best]], pa.list_(pa.list_(pa.int32()))),
                                       pa.array([len(best[0])], pa.int32())], names=["block", "island", "elite", "n_bins"])

    return state.select("block", "island", "sizes", "elite").mapInArrow(
        work, "block long, island int, elite array<array<int>>, n_bins int")


def _pack_level(items: DataFrame, blocks: int, capacity: int, islands: int, epochs: int, population: int, children: int,
                level: int, seed: int) -> DataFrame:
    """``items`` (uid, length) with block and bin of the best packing of their block."""
    spark = items.sparkSession
    block = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "uid"), F.lit(blocks))
    dealt = saved(items.groupBy(block.alias("block")).agg(F.sort_array(F.collect_list(F.struct("length", "uid")), asc=False).alias("items"))
                  .select("block", F.expr("items.uid").alias("uids"), F.expr("transform(items, i -> cast(i.length as int))").alias("sizes")))
    tasks = max(1, min(blocks * islands, spark.sparkContext.defaultParallelism * 4))
    none = F.array().cast("array<array<int>>")
    state = dealt.select("block", "sizes", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), none.alias("elite"))
    for epoch in range(epochs):
        spread = state.repartition(tasks, "block", "island")
        best = saved(_epoch(spread, capacity, population, children, epoch, seed))
        if epoch + 1 < epochs:  # the elite stays and goes to the next island of the ring
            moved = best.select("block", F.explode(F.array(F.col("island"), (F.col("island") + 1) % islands)).alias("island"),
                                "elite").groupBy("block", "island").agg(F.flatten(F.collect_list("elite")).alias("elite"))
            state = dealt.select("block", "sizes").join(moved, "block").select("block", "sizes", "island", "elite")
    top = best.groupBy("block").agg(F.min(F.struct("n_bins", "island", "elite")).alias("b")).select("block", F.col("b.elite")[0].alias("bin"))
    return saved(dealt.join(top, "block").select("block", F.explode(F.arrays_zip("uids", "sizes", "bin")).alias("z"))
                 .select(F.col("z.uids").alias("uid"), F.col("z.sizes").cast("long").alias("length"), "block",
                         F.col("z.bin").alias("bin")))


def pack(pieces: DataFrame, capacity: int = CAPACITY, block: int = BLOCK, islands: int = ISLANDS, epochs: int = EPOCHS,
         population: int = POPULATION, children: int = CHILDREN, full: float = 0.995, seed: int = 10) -> DataFrame:
    """``pieces`` (a table with a ``uid`` per row and ``length``) as uid,
    sequence_id, offset."""
    whole = pieces.where(F.col("length") >= capacity).select("uid", F.struct(F.lit(-1).alias("level"), F.col("uid").alias("block"), F.lit(0).alias("bin")).alias("seq"), "length")
    done = [whole]
    items = pieces.where(F.col("length") < capacity).select("uid", "length")
    n, level = items.count(), 0
    while n:
        blocks = max(1, round(n / block))
        packed = _pack_level(items, blocks, capacity, islands, epochs, population, children, level, seed)
        named = packed.select("uid", F.struct(F.lit(level).alias("level"), "block", "bin").alias("seq"), "length")
        if blocks == 1:
            done.append(named)
            break
        ready = packed.groupBy("block", "bin").agg(F.sum("length").alias("fill")).where(F.col("fill") >= capacity * full).select("block", "bin")
        done.append(packed.join(ready, ["block", "bin"]).select("uid", F.struct(F.lit(level).alias("level"), "block", "bin").alias("seq"), "length"))
        items = saved(packed.join(ready, ["block", "bin"], "left_anti").select("uid", "length"))
        left, level = items.count(), level + 1
        if left > 0.9 * n:      # what is left doesn't shrink: this packing is the result
            done[-1] = named
            break
        n = left
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    place = W.partitionBy("seq").orderBy(F.col("length").desc(), "uid").rowsBetween(W.unboundedPreceding, -1)
    # (level, block, bin) as one number: bins of a block are fewer than 2^16, blocks of a level fewer than 2^40; a piece
    # that is a sequence of its own takes its unique id above all of these
    number = F.when(F.col("seq.level") < 0, F.col("seq.block") + F.lit(1 << 62)).otherwise(
        F.shiftleft(F.shiftleft(F.col("seq.level").cast("long"), 40) + F.col("seq.block"), 16) + F.col("seq.bin"))
    return out.select("uid", "seq", F.coalesce(F.sum("length").over(place), F.lit(0)).alias("offset")).select(
        "uid", number.alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   **settings) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    pieces = saved(tokenize(docs, path, id_col, text_col, capacity).withColumn("uid", F.monotonically_increasing_id()))
    placed = pack(pieces, capacity, **settings)
    return pieces.join(placed, "uid").drop("uid")
