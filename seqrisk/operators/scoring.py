"""Request scoring as a table job.

A table of requests (race_id, lap, lap_data struct) goes in; a table of
responses comes out. The job is stateless row-by-row, so it runs on a batch
DataFrame or, unchanged, on a streaming one (see ``seqrisk.streaming``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqrisk.config import DEFAULT_THRESHOLD, INTERACTIONS, REQUEST_DEFAULTS
from seqrisk.functions.expr import decide, parse_race_id
from seqrisk.operators.features import add_interactions

# The error and message texts of the response contract.
MISSING = ("Invalid request", "Missing required parameters: race_id, lap")


def validate_requests(df: DataFrame, race_id: str = "race_id", lap: str = "lap") -> DataFrame:
    """Adds ``lap_number`` (int), ``error`` and ``message`` (null when
    the row is valid). race_id and lap are required; lap must read as an int."""
    lap_s = F.col(lap).cast("string")
    lap_i = F.trim(lap_s).try_cast("int")
    missing = F.col(race_id).isNull() | F.col(lap).isNull()
    bad_lap = lap_i.isNull()
    err = F.when(missing, F.lit(MISSING[0])).when(bad_lap, F.lit("Invalid value"))
    msg = (F.when(missing, F.lit(MISSING[1]))
           .when(bad_lap, F.concat(F.lit("invalid literal for int() with base 10: '"), lap_s, F.lit("'"))))
    return df.withColumns({"lap_number": F.when(~missing, lap_i), "error": err, "message": msg})


def apply_defaults(df: DataFrame, defaults: dict = REQUEST_DEFAULTS, struct_col: str = "lap_data",
                   lap_number: str = "lap_number") -> DataFrame:
    """One column per default key, taken from the request struct
    when present and non-null, else the default; LapNumber from the request."""
    fields = set()
    if struct_col in df.columns:
        dt = df.schema[struct_col].dataType
        fields = set(getattr(dt, "fieldNames", lambda: [])())
    cols = {}
    for k, v in defaults.items():
        lit = F.lit(v)
        cols[k] = F.coalesce(F.col(f"{struct_col}.{k}").cast(lit_type(v)), lit) if k in fields else lit
    cols["LapNumber"] = F.col(lap_number)
    return df.withColumns(cols)


def lit_type(v) -> str:
    if isinstance(v, bool):
        return "boolean"
    if isinstance(v, int):
        return "int"
    if isinstance(v, float):
        return "double"
    return "string"


def linear_scorer(coefs: dict, intercept: float) -> Callable[[DataFrame], Column]:
    """A fixed logistic scorer: sigmoid(intercept + sum coef * x)."""
    def prob(df: DataFrame) -> Column:
        z = F.lit(float(intercept))
        for c, w in coefs.items():
            z = z + F.lit(float(w)) * F.col(c).cast("double")
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return prob


def score_requests(df: DataFrame, scorer: Callable[[DataFrame], Column] | object, threshold=DEFAULT_THRESHOLD,
                   defaults: dict = REQUEST_DEFAULTS, race_id: str = "race_id", lap: str = "lap",
                   keep: list[str] | None = None) -> DataFrame:
    """M7: validate, parse the race id (year, track), fill defaults, add the
    interactions, score. Valid rows get probability / will_deploy_sc; invalid
    rows keep error and message with null scores (no invented answers).
    ``scorer`` is a DataFrame -> Column function or a ``ModelScorer`` (a trained
    model with its feature parameters); batch and stream alike."""
    keep = keep or []
    v = validate_requests(df, race_id, lap)
    parsed = v.withColumn("__p", parse_race_id(race_id))
    d = apply_defaults(parsed, defaults)
    d = d.withColumns({"Year": F.col("__p.year"), "TrackId": F.col("__p.track")})
    d = add_interactions(d, INTERACTIONS)
    ok = F.col("error").isNull()
    t = F.lit(float(threshold)) if isinstance(threshold, (int, float)) else threshold
    if hasattr(scorer, "add_probability"):
        d = scorer.add_probability(d, "__probability")
        p = F.when(ok, F.col("__probability"))
    else:
        p = F.when(ok, scorer(d))
    return d.select(*keep, F.col(race_id).alias("race_id"), F.col("lap_number").alias("lap"),
                    F.when(ok, F.col("Year")).alias("year"), F.when(ok, F.col("TrackId")).alias("track"),
                    p.alias("probability"), F.when(ok, t.cast("double")).alias("threshold"),
                    F.when(ok, decide(p, t) == 1).alias("will_deploy_sc"), "error", "message")


# Messages for bodies that cannot be read as a request.
NOT_JSON = ("Invalid request", "The body is not JSON")
BAD_LAP = ("Invalid value", "lap must be a number or text")
BAD_LAP_DATA = ("Invalid value", "lap_data must be an object")


def parse_bodies(df: DataFrame, body: str = "body", defaults: dict = REQUEST_DEFAULTS) -> DataFrame:
    """Raw JSON request bodies as (race_id, lap, lap_data struct) beside the
    columns of ``df``, with ``body_error`` / ``body_message`` for those that are none.

    The text is parsed once into a VARIANT, and each field is taken from it with
    its type. Not JSON, a lap that is an object or a list, a ``lap_data`` that is
    no object, and a field of it that does not read as its default's type are
    errors of their own (the first of them, fields in the order of ``defaults``).
    A body that is JSON but no object, and one without race_id or lap (or with
    null), lacks the required parameters, which ``validate_requests`` reports. A
    lap that is a number is cut to its whole part, as is a true or false one."""
    v = "__v"
    d = df.withColumn(v, F.try_parse_json(F.col(body)))
    part = lambda path, kind: F.try_variant_get(F.col(v), f"$.{path}", kind)
    type_of = lambda path: F.schema_of_variant(part(path, "variant"))
    lap_type, data_type = type_of("lap"), type_of("lap_data")
    number = part("lap", "double")
    lap = (F.when(lap_type == "STRING", part("lap", "string")).when(lap_type == "BOOLEAN", part("lap", "boolean").cast("int").cast("string"))
           .otherwise(F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number)).cast("string")))
    fields, problems = [], []
    for k, default in defaults.items():
        kind = lit_type(default)
        kind = "double" if kind == "int" else kind
        value, given = part(f"lap_data.{k}", kind), type_of(f"lap_data.{k}")
        wrong = given.isNotNull() & (given != "VOID") & value.isNull()
        if kind != "string":
            wrong = wrong | (given == "STRING") & F.col("__object")       # a quoted number is text
        else:
            wrong = wrong | given.startswith("OBJECT") | given.startswith("ARRAY")
        what = {"boolean": "true or false", "double": "a number", "string": "text"}[kind]
        problems.append(F.when(wrong, F.lit(f"lap_data.{k}: not {what}")))
        fields.append(F.when(~wrong, value).alias(k))
    d = d.withColumn("__object", F.coalesce(data_type.startswith("OBJECT"), F.lit(False)))
    bad_data = data_type.isNotNull() & (data_type != "VOID") & ~F.col("__object")
    broken = F.col(body).isNull() | F.col(v).isNull()
    bad_lap = lap_type.startswith("OBJECT") | lap_type.startswith("ARRAY")
    cases = [(broken, NOT_JSON), (bad_lap, BAD_LAP), (bad_data, BAD_LAP_DATA)]
    error, message = F.lit(None).cast("string"), F.coalesce(*problems) if problems else F.lit(None).cast("string")
    error = F.when(message.isNotNull(), "Invalid value")
    for test, (e, m) in reversed(cases):
        hit = F.coalesce(test, F.lit(False))
        error, message = F.when(hit, e).otherwise(error), F.when(hit, m).otherwise(message)
    lacking = ~broken & (part("race_id", "string").isNull() | type_of("lap").isNull() | (type_of("lap") == "VOID"))
    lacking = F.coalesce(lacking, F.lit(False))          # reported before any value is looked at
    out = d.select(*df.columns, part("race_id", "string").alias("race_id"), lap.alias("lap"), F.struct(*fields).alias("lap_data"),
                   F.when(~lacking, error).alias("body_error"), F.when(~lacking, message).alias("body_message"))
    return out


def score_bodies(df: DataFrame, scorer: Callable[[DataFrame], Column] | object, threshold=DEFAULT_THRESHOLD, defaults: dict = REQUEST_DEFAULTS,
                 body: str = "body", keep: list[str] | None = None) -> DataFrame:
    """M7 from raw bodies, batch or stream: the columns of ``score_requests``; every row has a score or its error."""
    keep = keep or []
    parsed = parse_bodies(df.select(*keep, body), body, defaults)
    s = score_requests(parsed, scorer, threshold, defaults, keep=[*keep, "body_error", "body_message"])
    fine = F.col("body_error").isNull()
    scored = [F.when(fine, F.col(c)).alias(c) for c in ("race_id", "lap", "year", "track", "probability", "threshold", "will_deploy_sc")]
    return s.select(*keep, *scored, F.coalesce("body_error", "error").alias("error"), F.coalesce("body_message", "message").alias("message"))
