"""Secret scans (6): candidates by pattern, false positives removed by a forest.

Candidates are runs of 16 or more key characters, and whole values of any
length and characters behind a secret's name and = or : (up to the closing
quote, else up to a blank), unless such a value is just a run. A random forest on their
length, character transitions, dictionary coverage, path and neighbouring
words decides which are secrets; it is trained on labelled findings. All of it
is DataFrame work and Spark ML.

The dictionary is the ``DICTIONARY`` most frequent words of all documents; a
candidate's coverage is the share of its letter trigrams that dictionary words
hold (an equality join on distinct candidates). Training uses at most
``MAX_LABELLED`` different findings of each label (smallest hashes), each once as it is
and once without its neighbours, so that the string itself counts too.

Defined cases: null and empty texts have no candidates; a null path is an
empty one; without labelled findings of both kinds every candidate is kept as
a finding with probability 1; an empty table gives an empty result; other
columns are ignored; rows that repeat give findings each.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from seqrisk.llm.common import saved

CANDIDATE = r"[A-Za-z0-9+/_\-]{16,}={0,2}"
CONTEXT = 48
DICTIONARY = 5_000
MAX_LABELLED = 4_000
TREES, DEPTH = 30, 8
NAMES = r"(?i)(pass|passwd|password|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|private[_-]?key)"
# A name, its assignment and an opening quote (group 1), then the value. A value that is
# itself a name with an assignment is left to the match that starts there.
_VALUE = (rf"""(?<=")(?!{CANDIDATE}")[^"\r\n]+(?=")|(?<=')(?!{CANDIDATE}')[^'\r\n]+(?=')"""
          r"""|(?:(?<!["'])|(?<=")(?![^"\r\n]*")|(?<=')(?![^'\r\n]*'))"""
          rf"""(?!{CANDIDATE}["',;]{{0,3}}(?:\s|$))(?!\S*{NAMES}["']?\s*[=:]+>?[\s"'])[^\s"']\S*?(?=["',;]{{0,3}}(?:\s|$))""")
NAMED = rf"""({NAMES}["']?\s*[=:]+>?\s*["']?)(?:{_VALUE})"""
BUCKETS = 8

FEATURES = ["length", "digits", "uppers", "lowers", "signs", "hex", "distinct", "to_digit", "from_digit", "case_change",
            "vowel_change", "longest_letters", "coverage", "named", "assigned", "quoted", "path_test",
            *[f"path_{k}" for k in range(BUCKETS)], *[f"word_{k}" for k in range(BUCKETS)]]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """id, path, place (number within the text, runs first), value, before, after."""
    text = F.col(f"`{text_col}`").cast("string")
    between = F.split(text, CANDIDATE, -1)
    found = F.regexp_extract_all(text, F.lit(CANDIDATE), 0)
    # contexts are cut before the explode: no candidate carries its whole text
    item = F.transform("found", lambda v, i: F.struct(
        v.alias("value"), F.right(F.get("between", i), F.lit(CONTEXT)).alias("before"),
        F.left(F.get("between", i + 1), F.lit(CONTEXT)).alias("after")))
    named = F.transform("named", lambda v, i: F.struct(
        F.substring(v, F.length(F.get("heads", i)) + 1, F.length(v)).alias("value"),
        F.right(F.concat(F.get("apart", i), F.get("heads", i)), F.lit(CONTEXT)).alias("before"),
        F.left(F.get("apart", i + 1), F.lit(CONTEXT)).alias("after")))
    rows = docs.where(text.rlike(CANDIDATE) | text.rlike(NAMED)).select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{path_col}`").cast("string"), F.lit("")).alias("path"),
        found.alias("found"), between.alias("between"), F.regexp_extract_all(text, F.lit(NAMED), 0).alias("named"),
        F.regexp_extract_all(text, F.lit(NAMED), 1).alias("heads"), F.split(text, NAMED, -1).alias("apart"))
    return rows.select("id", "path", F.posexplode(F.concat(item, named)).alias("place", "c")).select("id", "path", "place", "c.*")


def dictionary(docs: DataFrame, text_col: str = "text", words: int = DICTIONARY) -> DataFrame:
    """Letter trigrams of the most frequent words of 3 to 12 letters."""
    every = docs.select(F.explode(F.split(F.lower(F.col(f"`{text_col}`").cast("string")), "[^a-z]+")).alias("word")).where(F.length("word").between(3, 12))
    top = every.groupBy("word").count().orderBy(F.desc("count"), "word").limit(words)
    return top.select(F.explode(_trigrams(F.col("word"))).alias("gram")).distinct()


def _trigrams(word: Column) -> Column:
    return F.when(F.length(word) >= 3, F.transform(F.sequence(F.lit(1), F.greatest(F.length(word) - 2, F.lit(1))),
                                                   lambda i: F.substring(word, i, F.lit(3)))).otherwise(F.array().cast("array<string>"))


def _coverage(values: DataFrame, grams: DataFrame) -> DataFrame:
    """value, coverage of every distinct value."""
    letters = F.filter(F.split(F.lower("value"), "[^a-z]+"), lambda w: F.length(w) >= 3)
    own = values.select("value", F.explode_outer(F.flatten(F.transform(letters, _trigrams))).alias("gram"))
    g = grams.withColumn("known", F.lit(1.0))
    return own.join(F.broadcast(g), "gram", "left").groupBy("value").agg(
        (F.sum(F.coalesce("known", F.lit(0.0))) / F.greatest(F.count("gram"), F.lit(1))).alias("coverage"))


def featurise(found: DataFrame, grams: DataFrame) -> DataFrame:
    """``found`` with the feature columns."""
    size = F.length("value")
    share = lambda pattern: F.regexp_count("value", F.lit(pattern)) / size
    word = F.lower(F.regexp_extract("before", r"([A-Za-z]+)[^A-Za-z]*$", 1))
    cols = {
        "length": size.cast("double"), "digits": share("[0-9]"), "uppers": share("[A-Z]"), "lowers": share("[a-z]"),
        "signs": share("[^A-Za-z0-9]"), "hex": F.rlike("value", F.lit("^[0-9a-f]+$")).cast("double"),
        "distinct": F.size(F.array_distinct(F.split("value", ""))) / size,
        "to_digit": share("[A-Za-z](?=[0-9])"), "from_digit": share("[0-9](?=[A-Za-z])"), "case_change": share("[a-z](?=[A-Z])"),
        "vowel_change": share("[aeiouAEIOU](?=[b-df-hj-np-tv-zB-DF-HJ-NP-TV-Z])"),
        "longest_letters": F.array_max(F.transform(F.split("value", "[^A-Za-z]+"), F.length)) / size,
        "named": F.rlike(F.regexp_extract("before", r"(\S+\s*[=:]?\s*[\"']?)$", 1), F.lit(NAMES)).cast("double"),
        "assigned": F.rlike("before", F.lit(r"[=:]\s*[\"']?$")).cast("double"),
        "quoted": (F.rlike("before", F.lit("[\"']$")) & F.rlike("after", F.lit("^[\"']"))).cast("double"),
        "path_test": F.rlike(F.lower("path"), F.lit("test|example|sample|mock|fixture")).cast("double"),
        **{f"path_{k}": (F.pmod(F.xxhash64("path"), F.lit(BUCKETS)) == k).cast("double") for k in range(BUCKETS)},
        **{f"word_{k}": ((word != "") & (F.pmod(F.xxhash64(word), F.lit(BUCKETS)) == k)).cast("double") for k in range(BUCKETS)}}
    cover = _coverage(found.select("value").distinct(), grams)
    return found.withColumns(cols).join(cover, "value")


_NEIGHBOURS = ["named", "assigned", "quoted", *[f"word_{k}" for k in range(BUCKETS)]]


def fit_forest(labelled: DataFrame, max_rows: int = MAX_LABELLED, trees: int = TREES, depth: int = DEPTH,
               seed: int = 6) -> RandomForestClassificationModel | None:
    """Fit on featurised findings with a column ``label`` (1 secret, 0 not)."""
    rows = labelled.where("label in (0, 1)").select("value", F.col("label").cast("double").alias("label"), *FEATURES).distinct()
    order = (F.xxhash64("value"), "value", *FEATURES)
    part = [rows.where(F.col("label") == k).orderBy(*order).limit(max_rows) for k in (0.0, 1.0)]
    bounded = saved(part[0].unionByName(part[1]))
    if bounded.select("label").distinct().count() < 2:
        return None
    bare = bounded.withColumns({c: F.lit(0.0) for c in _NEIGHBOURS})
    train = VectorAssembler(inputCols=FEATURES, outputCol="__features").transform(bounded.unionByName(bare))
    return RandomForestClassifier(featuresCol="__features", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed,
                                  probabilityCol="__p", rawPredictionCol="__raw", predictionCol="__pred").fit(train.coalesce(2))


def judge(found: DataFrame, model: RandomForestClassificationModel | None, threshold: float = 0.5) -> DataFrame:
    """id, path, place, value, probability, is_secret of featurised candidates."""
    if model is None:
        scored = found.withColumn("probability", F.lit(1.0))
    else:
        features = VectorAssembler(inputCols=FEATURES, outputCol="__features")
        scored = PipelineModel([features, model]).transform(found).withColumn("probability", vector_to_array("__p")[1])
    return scored.select("id", "path", "place", "value", "probability", (F.col("probability") >= threshold).alias("is_secret"))


def scan(docs: DataFrame, label: Column, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """All candidates of ``docs``, judged. ``label`` makes the labelled findings:
    1, 0 or null from the columns of a candidate."""
    grams = saved(dictionary(docs, text_col))
    found = saved(featurise(saved(candidates(docs, id_col, text_col, path_col)), grams))
    return judge(found, fit_forest(found.withColumn("label", label)))
