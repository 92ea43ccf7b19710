"""Line dedup (5): deletion-neighbourhood join over all lines of all documents.

A line goes if an earlier line of the corpus (by id, then line number) is
within one edit (a character replaced, added or left out) of it, after
trimming and lower-casing A-Z. Everything is DataFrame work; groups are met by
their minimum only, so no pairs of lines are listed, however common a line is.

1. Equal lines form a class, known by a 128-bit hash and its first place.
2. A lossless filter finds the classes that can have a partner. If two lines
   whose longer one has N characters are within one edit, then for any number
   of parts m some r exists such that they share the first r q and the last
   (m - 1 - r) q characters, q = N div m. Each class emits these as hashed
   keys for N = its length and its length + 1; keys of a single class leave.
   This is done with 2 parts for all classes, then with 16 for the rest.
3. Classes that are left emit their deletion variants at the places of the
   windows they share: a variant with the place left open is shared by lines
   that differ by a replacement there; a variant as a whole is shared with the
   line that it equals. So all lines that share a variant are within the bound
   of the earliest (or of the whole line), and a minimum per key is enough.
   Variant hashes are XORs of place-and-character hashes: linear work.
4. Each class's earliest partner per key is verified by edit distance.

Defined cases: null and empty texts have one empty line; blank lines always
stay; lines shorter than ``MIN_CHARS`` only go when an earlier line is equal;
a null id is after all others; lines of rows that repeat in full are at the
same place and stay or go together; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from seqrisk.llm.common import UPPER, saved, small

MIN_CHARS = 20
LAST = (1 << 63) - 1


def _windows(text: Column, n: Column, parts: int) -> Column:
    """Keys of all shared-window conditions of a line, as (longest, window, key)."""
    def key(longest: Column, r: Column) -> Column:
        q = F.floor(longest / parts).cast("int")
        tail = (parts - 1 - r) * q
        return F.struct(longest.alias("longest"), r.alias("window"), F.xxhash64(
            longest, r, F.substring(text, F.lit(1), r * q), F.substring(text, n - tail + 1, tail)).alias("key"))
    return F.flatten(F.transform(F.array(n, n + 1), lambda longest: F.transform(
        F.sequence(F.lit(0), F.lit(parts - 1)), lambda r: key(longest, r))))


def _halves(text: Column, n: Column) -> Column:
    """The keys of two windows, spelled out (compiled, where the general form is not)."""
    keys = []
    for longest in (n, n + 1):
        q = F.floor(longest / 2).cast("int")
        keys += [F.xxhash64(longest, F.lit(0), F.right(text, q)), F.xxhash64(longest, F.lit(1), F.left(text, q))]
    return F.array(*keys)


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line that is not blank: place (id, copy, line), n, h1, h2, norm."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("copy"),
                       F.posexplode(F.split(text, "\n")).alias("line", "raw"))
    norm = F.trim(F.translate("raw", "\t\r" + UPPER, "  " + UPPER.lower()))
    rows = rows.select("id", "copy", "line", norm.alias("norm")).where("norm <> ''")
    return rows.select("id", "copy", "line", F.length("norm").alias("n"), F.xxhash64("norm").alias("h1"),
                       F.xxhash64(F.lit(5), "norm").alias("h2"), "norm")


def _place(id_: str = "id", line: str = "line") -> Column:
    return F.struct(F.coalesce(F.col(id_), F.lit(LAST)).alias("id"), F.col(line).alias("line"))


def _shared(keys: DataFrame) -> DataFrame:
    """Rows whose key another class has too."""
    common = keys.groupBy("key").agg((F.min("h1") != F.max("h1")).alias("many")).where("many").select("key")
    return keys.join(common, "key", "left_semi")


def _variants(lines: DataFrame) -> DataFrame:
    """Deletion variants at the places of the shared windows: key, whole (it is
    the line itself), h1, h2, first."""
    q = F.floor(F.col("longest") / F.col("parts"))
    low = (F.col("window") * q).cast("int")
    high = F.least(F.col("n") - 1, (F.col("longest") - 1 - (F.col("parts") - 1 - F.col("window")) * q).cast("int"))
    places = F.when(high >= low, F.sequence(low, F.greatest(low, high))).otherwise(F.array().cast("array<int>"))
    at = lines.withColumns({"c": F.regexp_extract_all("norm", F.lit("(?s)."), 0), "low": low, "places": places})
    at = at.withColumns({"x": F.expr("transform(c, (s, i) -> xxhash64(s, i))"), "y": F.expr("transform(c, (s, i) -> xxhash64(s, i - 1))")})
    # XOR of all, and running XORs from the start to each place of the window
    total = "aggregate({0}, 0L, (a, v) -> a ^ v)"
    run = "aggregate(slice({0}, low + 1, size(places)), array(aggregate(slice({0}, 1, low), 0L, (a, v) -> a ^ v)), (a, v) -> array_append(a, element_at(a, -1) ^ v))"
    at = at.withColumns({"all": F.expr(total.format("x")), "ally": F.expr(total.format("y")),
                         "px": F.expr(run.format("x")), "py": F.expr(run.format("y"))})
    same = F.when(F.col("longest") == F.col("n"), F.expr(
        "transform(places, i -> named_struct('key', xxhash64('open', n, i, all ^ x[i]), 'whole', -1))")).otherwise(
        F.expr("array(named_struct('key', xxhash64('whole', n, all), 'whole', 1))"))
    less = F.when(F.col("longest") == F.col("n"), F.expr(
        "transform(places, (i, k) -> named_struct('key', xxhash64('whole', n - 1, px[k] ^ ally ^ py[k + 1]), 'whole', 0))")).otherwise(
        F.expr("cast(array() as array<struct<key:bigint,whole:int>>)"))
    return (at.select("h1", "h2", "first", F.explode(F.concat(same, less)).alias("v"))
            .select("v.key", "v.whole", "h1", "h2", "first").distinct())


def near_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
               parts: int = 16) -> DataFrame:
    """id, copy (hash of the text), lines: the numbers (from 0) of the lines that go, per row with any."""
    every = _lines(docs, id_col, text_col)
    keys = F.when(F.col("n") >= min_chars, _halves(F.col("norm"), F.col("n")))
    places = saved(every.select("id", "copy", "line", "h1", "h2", keys.alias("keys")))
    classes = saved(places.groupBy("h1", "h2").agg(F.min(_place()).alias("first"), F.count("*").alias("times"), F.any_value("keys").alias("keys")))
    can = saved(_shared(classes.where("keys is not null").select("h1", "h2", F.explode("keys").alias("key"))).select("h1", "h2").distinct())
    # a class's text is read at its first place: only documents that hold one are split again
    seeds = saved(classes.join(can, ["h1", "h2"], "left_semi").select(F.col("first.id").alias("__id")).distinct())
    own = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST))
    some = docs.join(F.broadcast(seeds) if small(seeds) else seeds, own == F.col("__id"), "left_semi")
    few = small(can)
    texts = (_lines(some, id_col, text_col).where(F.col("n") >= min_chars).select("h1", "h2", "n", "norm").join(F.broadcast(can) if few else can, ["h1", "h2"], "left_semi")
             .groupBy("h1", "h2").agg(F.first("norm").alias("norm"), F.first("n").alias("n")))
    texts = saved(texts.join(classes.select("h1", "h2", "first"), ["h1", "h2"]))
    narrow = texts.select("h1", "h2", F.explode(_windows(F.col("norm"), F.col("n"), parts)).alias("w")).select("h1", "h2", "w.*")
    windows = _shared(narrow).select("h1", "h2", "longest", "window").distinct().withColumn("parts", F.lit(parts))
    variants = saved(_variants(texts.join(windows, ["h1", "h2"])))
    # open: the earliest of all; whole: the line itself against the earliest longer line, and the reverse
    best = (variants.groupBy("key").agg(F.min("first").alias("any"), F.max("first").alias("last"),
                                        F.min(F.when(F.col("whole") == 1, F.col("first"))).alias("line_"),
                                        F.min(F.when(F.col("whole") == 0, F.col("first"))).alias("longer")).where("any < last"))
    partner = F.when(F.col("whole") == -1, F.col("any")).when(F.col("whole") == 1, F.col("longer")).otherwise(F.col("line_"))
    pairs = (variants.join(best, "key").withColumn("partner", partner).where("partner < first")
             .select("h1", "h2", "partner").distinct())
    other = texts.select(F.col("first").alias("partner"), F.col("norm").alias("other"))
    near = (pairs.join(texts.select("h1", "h2", "norm"), ["h1", "h2"]).join(other, "partner")
            .where(F.levenshtein("norm", "other", 1) >= 0).select("h1", "h2").distinct().withColumn("near", F.lit(True)))
    marked = (classes.select("h1", "h2", "first", "times").join(near, ["h1", "h2"], "left")
              .where("times > 1 or near").drop("times"))
    gone = places.select("id", "copy", "line", "h1", "h2").join(saved(marked), ["h1", "h2"]).where(F.coalesce("near", F.lit(False)) | (_place() > F.col("first")))
    return gone.groupBy("id", "copy").agg(F.sort_array(F.collect_set("line")).alias("lines"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with the lines that go taken out of the text, and n_lines, n_dropped."""
    gone = saved(near_lines(docs, id_col, text_col, **settings))
    gone = gone.select(F.col("id").alias("__id"), F.col("copy").alias("__copy"), F.col("lines").alias("__lines"))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    named = docs.withColumn("__hash", F.xxhash64(text))
    # one way to join at every size: texts meet their line numbers by shuffle
    joined = named.join(gone.hint("merge"), (F.col("__hash") == F.col("__copy")) & F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("__id")), "left")
    lines = F.split(F.col(f"`{text_col}`").cast("string"), "\n")
    left = F.concat_ws("\n", F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__lines")), lambda i: F.get(lines, i)))
    cleaned = F.when(F.col("__lines").isNull(), F.col(f"`{text_col}`")).otherwise(left)
    made = {"n_lines": F.size(F.split(text, "\n")), "n_dropped": F.coalesce(F.size("__lines"), F.lit(0))}
    cols = [cleaned.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c not in made]
    return joined.select(*cols, *[v.alias(k) for k, v in made.items()])
