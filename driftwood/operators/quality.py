"""Row-level data-quality validation (QUA-1..13, SET-3) and the quality
summary (AGG-9).

Messages are dynamic JSON held as VARIANT, so a key that is absent stays
apart from a key whose value is null, and each value keeps its JSON type.
Rules compile to Column expressions: validation is one projection, no
shuffle, and runs unchanged on a stream.

Semantics kept from the original: penalties lower the score, warnings never
do; a value that fails numeric conversion gets only the type error; unknown
fields are ignored; ``<field>_quality`` exists for present fields only.
Divergences: null counts as missing (D6), the age check compares instants
against an explicit ``as_of`` (D5), cross-field checks on non-numeric text
do not fire (D7), ISO-8601 is checked by pattern before parsing (D16).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FieldRule:
    name: str
    type: str = "str"                     # "str" | "float" | "int"
    required: bool = False
    pattern: str | None = None
    min_length: int | None = None
    max_length: int | None = None
    allowed: tuple[str, ...] | None = None
    iso8601: bool = False
    max_age_hours: float | None = None
    min_value: float | None = None
    max_value: float | None = None
    precision: int | None = None


# The field rules of the validator.
DEFAULT_RULES = (
    FieldRule("device_id", "str", required=True, pattern=r"^[a-zA-Z0-9_-]+$",
              min_length=3, max_length=50),
    FieldRule("timestamp", "str", required=True, iso8601=True, max_age_hours=24),
    FieldRule("temperature", "float", min_value=-50.0, max_value=100.0, precision=2),
    FieldRule("humidity", "float", min_value=0.0, max_value=100.0, precision=2),
    FieldRule("pressure", "float", min_value=800.0, max_value=1200.0, precision=2),
    FieldRule("protocol", "str", required=True,
              allowed=("MQTT", "SNMP", "CoAP", "TCP", "WebSocket")),
)

# Penalties (score) and quality deductions (per field).
PENALTY = {"missing": 20, "type": 15, "pattern": 10, "min_length": 5, "allowed": 10,
           "format": 15, "min_value": 10, "max_value": 10}
QUALITY = {"type": 30, "pattern": 20, "min_length": 15, "max_length": 5, "allowed": 25,
           "format": 30, "age": 10, "min_value": 20, "max_value": 20, "precision": 5}

# Number text accepted by a float conversion (digits, optional sign,
# fraction, exponent; nan/inf words).
NUMBER_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf|infinity))\s*$"
ISO_8601 = (r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?"
            r"(Z|[+-]\d{2}(:?\d{2})?)?)?$")
SNMP_DEVICE_OK = (r"^\d+\.\d+\.\d+\.\d+", r"^snmp_")


def _py_float_text(v: float) -> str:
    return repr(float(v))


def _field(msg: Column, name: str) -> Column:
    path = "$['" + name.replace("'", "\\'") + "']"
    return F.try_variant_get(msg, path, "variant")


def _errors(pairs: list[tuple[Column, str | Column]]) -> Column:
    return F.array_compact(F.array(*[
        F.when(cond, text if isinstance(text, Column) else F.lit(text))
        for cond, text in pairs]))


def _stage_fields(df: DataFrame, msg: str, rules) -> DataFrame:
    """Extract each field once into its own columns (value, type, text,
    number). Later projections refer to these columns, so the optimizer does
    not inline and repeat the VARIANT reads inside every rule."""
    m = F.col(msg)
    staged = df.select("*", *[_field(m, r.name).alias(f"_v_{i}") for i, r in enumerate(rules)])
    cols = []
    for i, _ in enumerate(rules):
        v = F.col(f"_v_{i}")
        cols += [F.schema_of_variant(v).alias(f"_k_{i}"),
                 F.try_variant_get(v, "$", "string").alias(f"_t_{i}"),
                 F.try_variant_get(v, "$", "double").alias(f"_d_{i}"),
                 (v.isNotNull() & ~F.is_variant_null(v)).alias(f"_p_{i}")]
    return staged.select("*", *cols)


def _derive_fields(staged: DataFrame, rules) -> DataFrame:
    """Second stage: per field the value as text (``_s``), as number
    (``_n``), the type-error flag (``_tb``) and, for ISO fields, the parsed
    instant (``_ts``)."""
    cols = []
    for i, rule in enumerate(rules):
        present, kind, text = F.col(f"_p_{i}"), F.col(f"_k_{i}"), F.col(f"_t_{i}")
        is_string = kind == F.lit("STRING")
        if rule.type in ("float", "int"):
            numeric_kind = kind.rlike(r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)")
            convertible = (numeric_kind | (kind == F.lit("BOOLEAN"))
                           | (is_string & text.rlike(NUMBER_TEXT)))
            type_bad = present & ~convertible
            number = F.when(present & convertible, F.col(f"_d_{i}"))
            if rule.type == "int":
                # int() truncates a float toward zero.
                number = F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number)) \
                          .cast("double")
            # A failed conversion leaves the text; string rules apply to it.
            string_value = F.when(type_bad & is_string, text)
        else:
            # Conversion to text always succeeds (str() of the value).
            type_bad = F.lit(False)
            number = F.lit(None).cast("double")
            string_value = F.when(present, F.when(kind == F.lit("BOOLEAN"), F.initcap(text))
                                  .otherwise(text))
        cols += [string_value.alias(f"_s_{i}"), number.alias(f"_n_{i}"),
                 type_bad.alias(f"_tb_{i}")]
    out = staged.select("*", *cols)
    iso = [F.when(F.col(f"_s_{i}").rlike(ISO_8601), F.try_to_timestamp(F.col(f"_s_{i}")))
            .alias(f"_ts_{i}") for i, r in enumerate(rules) if r.iso8601]
    return out.select("*", *iso) if iso else out


def _field_checks(i: int, rule: FieldRule, as_of: Column):
    """Returns (present, errors, warnings, penalty, quality, number, text)
    for one derived field."""
    present = F.col(f"_p_{i}")
    n = rule.name
    errors: list[tuple[Column, str]] = []
    warnings: list[tuple[Column, str]] = []
    pen: list[tuple[Column, int]] = []
    qual: list[tuple[Column, int]] = []
    s, number = F.col(f"_s_{i}"), F.col(f"_n_{i}")

    if rule.type in ("float", "int"):
        type_bad = F.col(f"_tb_{i}")
        errors.append((type_bad, f"{n}: Invalid type. Expected {rule.type}"))
        pen.append((type_bad, PENALTY["type"]))
        qual.append((type_bad, QUALITY["type"]))
    if rule.pattern:
        bad = s.isNotNull() & ~s.rlike(rule.pattern)
        errors.append((bad, f"{n}: Does not match required pattern"))
        pen.append((bad, PENALTY["pattern"]))
        qual.append((bad, QUALITY["pattern"]))
    if rule.min_length is not None:
        bad = s.isNotNull() & (F.char_length(s) < rule.min_length)
        errors.append((bad, f"{n}: Too short (min: {rule.min_length})"))
        pen.append((bad, PENALTY["min_length"]))
        qual.append((bad, QUALITY["min_length"]))
    if rule.max_length is not None:
        bad = s.isNotNull() & (F.char_length(s) > rule.max_length)
        warnings.append((bad, f"{n}: Too long (max: {rule.max_length})"))
        qual.append((bad, QUALITY["max_length"]))
    if rule.allowed:
        bad = s.isNotNull() & ~s.isin(list(rule.allowed))
        errors.append((bad, f"{n}: Invalid value. Allowed: {list(rule.allowed)!r}"))
        pen.append((bad, PENALTY["allowed"]))
        qual.append((bad, QUALITY["allowed"]))
    if rule.iso8601:
        ts = F.col(f"_ts_{i}")
        bad = s.isNotNull() & ts.isNull()
        errors.append((bad, f"{n}: Invalid timestamp format"))
        pen.append((bad, PENALTY["format"]))
        qual.append((bad, QUALITY["format"]))
        if rule.max_age_hours is not None:
            old = ts.isNotNull() & (
                (F.unix_micros(as_of) - F.unix_micros(ts))
                > F.lit(int(rule.max_age_hours * 3_600_000_000)))
            warnings.append((old, f"{n}: Timestamp is too old"))
            qual.append((old, QUALITY["age"]))

    if rule.type in ("float", "int"):
        x = number
        if rule.min_value is not None:
            bad = x < F.lit(rule.min_value)
            errors.append((bad, f"{n}: Below minimum ({_py_float_text(rule.min_value)})"))
            pen.append((bad, PENALTY["min_value"]))
            qual.append((bad, QUALITY["min_value"]))
        if rule.max_value is not None:
            bad = x > F.lit(rule.max_value)
            errors.append((bad, f"{n}: Above maximum ({_py_float_text(rule.max_value)})"))
            pen.append((bad, PENALTY["max_value"]))
            qual.append((bad, QUALITY["max_value"]))
        if rule.precision is not None and rule.type == "float":
            bad = x.isNotNull() & ~F.isnan(x) & (F.round(x, rule.precision) != x)
            warnings.append((bad, f"{n}: Too many decimal places"))
            qual.append((bad, QUALITY["precision"]))

    def total(items):
        if not items:
            return F.lit(0)
        return reduce(lambda a, b: a + b,
                      [F.when(c, F.lit(w)).otherwise(F.lit(0)) for c, w in items])

    penalty = total(pen)
    quality = F.greatest(F.lit(0.0), F.lit(100.0) - total(qual))
    return present, errors, warnings, penalty, quality, number, s


def validate(df: DataFrame, msg: str = "msg", rules=DEFAULT_RULES,
             as_of: Column | None = None, cross_fields: bool = True,
             out: str = "validation") -> DataFrame:
    """QUA-1..13: adds ``out`` = struct(is_valid, errors, warnings,
    quality_score, metrics map<string,double>)."""
    rules = tuple(rules)
    as_of = F.current_timestamp() if as_of is None else as_of
    staged = _derive_fields(_stage_fields(df, msg, rules), rules)
    req_errors, errors, warnings = [], [], []
    penalties: list[Column] = []
    metric_args: list[Column] = []
    numbers: dict[str, Column] = {}
    strings: dict[str, Column] = {}
    presents: dict[str, Column] = {}
    for i, rule in enumerate(rules):
        present, e, w, pen, q, num, s = _field_checks(i, rule, as_of)
        presents[rule.name], numbers[rule.name], strings[rule.name] = present, num, s
        if rule.required:
            req_errors.append((~present, f"Missing required field: {rule.name}"))
            penalties.append(F.when(~present, F.lit(PENALTY["missing"])).otherwise(F.lit(0)))
        errors += e
        warnings += w
        penalties.append(pen)
        metric_args += [F.lit(f"{rule.name}_quality"), F.when(present, q)]

    cross_w = []
    if cross_fields and "temperature" in numbers and "humidity" in numbers:
        t, h = numbers["temperature"], numbers["humidity"]
        cross_w.append(((t > 30) & (h > 80), "Unusual: High temperature with high humidity"))
        cross_w.append(((t < 0) & (h > 90),
                        "Suspicious: Sub-zero temperature with very high humidity"))
    if cross_fields and "protocol" in strings and "device_id" in strings:
        dev = strings["device_id"]
        snmp_bad = ((strings["protocol"] == "SNMP") & dev.isNotNull()
                    & ~dev.rlike(SNMP_DEVICE_OK[0]) & ~dev.rlike(SNMP_DEVICE_OK[1]))
        cross_w.append((snmp_bad, "SNMP device ID format may be incorrect"))

    err = _errors(req_errors + errors)
    warn = _errors(warnings + cross_w)
    penalty = reduce(lambda a, b: a + b, penalties)
    metrics = F.map_filter(F.create_map(*metric_args), lambda k, v: v.isNotNull())
    temp = [c for c in staged.columns if c not in df.columns]
    return staged.withColumn(out, F.struct(
        (F.size(err) == 0).alias("is_valid"),
        err.alias("errors"),
        warn.alias("warnings"),
        F.greatest(F.lit(0.0), F.lit(100.0) - penalty.cast("double")).alias("quality_score"),
        metrics.alias("metrics"))).drop(*temp)


def quality_summary(validated: DataFrame, out: str = "validation") -> DataFrame:
    """AGG-9: valid/invalid counts, rate, error and warning totals, mean
    score (one global aggregate; partial sums run before the shuffle)."""
    v = F.col(out)
    return validated.agg(
        F.count_if(v["is_valid"]).alias("valid_messages"),
        F.count_if(~v["is_valid"]).alias("invalid_messages"),
        (F.count_if(v["is_valid"]) / F.count(F.lit(1))).alias("validation_rate"),
        F.sum(F.size(v["errors"])).cast("long").alias("total_errors"),
        F.sum(F.size(v["warnings"])).cast("long").alias("total_warnings"),
        F.avg(v["quality_score"]).alias("average_quality_score"))


def errors_by_rule(validated: DataFrame, out: str = "validation") -> DataFrame:
    """Error and warning texts with their counts."""
    v = F.col(out)
    tagged = F.concat(
        F.transform(v["errors"], lambda x: F.struct(F.lit("error").alias("kind"),
                                                    x.alias("message"))),
        F.transform(v["warnings"], lambda x: F.struct(F.lit("warning").alias("kind"),
                                                      x.alias("message"))))
    return (validated.select(F.inline(tagged))
                     .groupBy("kind", "message").agg(F.count(F.lit(1)).alias("n")))
