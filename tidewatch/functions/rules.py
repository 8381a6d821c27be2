"""Validation rules as Column expressions.

One ordered rule list, compiled two ways:

* ``first_failure`` reads the typed columns of ``parse_events`` and names the
  first broken rule (NULL for a valid row);
* ``all_failures`` reads the JSON itself, where an absent field, a null and a
  wrong type are still different things, and lists every broken rule.

``strict_failures`` checks the published JSON contract.  Nothing here leaves
the JVM, and every compiled expression is linear in the number of rules.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import WIRE_FIELDS, RuleBounds
from .parse import add_once, iso_timestamp

# The codes of the rules and the texts of the reasons, here and in
# the rules below, are read by those who receive dead letters.
CORRUPTED = "corrupted_json: payload was not parseable"


# --- the bounds both readings share -----------------------------------------


@dataclass(frozen=True)
class BoundRule:
    """A value check: which field, when it fails, and how the failure reads."""

    code: str
    field: str
    fails: Callable[[Column], Column]
    short: str
    detail: Callable[[Column], Column]


def bound_rules(b: RuleBounds) -> list[BoundRule]:
    def text(*parts) -> Column:
        return F.concat(*[p if isinstance(p, Column) else F.lit(str(p)) for p in parts])

    allowed = "[" + ", ".join(f"'{x}'" for x in sorted(b.exchanges)) + "]"
    change_range = f"[{b.change_percent_min}, {b.change_percent_max}]"
    return [
        BoundRule("invalid_price", "price", lambda x: x <= b.price_min, "price <= min",
                  lambda t: text(t, f" <= min {b.price_min}")),
        BoundRule("invalid_price", "price", lambda x: x > b.price_max, "price > max",
                  lambda t: text(t, f" > max {b.price_max}")),
        BoundRule("invalid_volume", "volume", lambda x: x < b.volume_min, "volume < min",
                  lambda t: text(t, f" < min {b.volume_min}")),
        BoundRule("invalid_change_percent", "change_percent",
                  lambda x: (x < b.change_percent_min) | (x > b.change_percent_max),
                  "out of range", lambda t: text(t, f" outside {change_range}")),
        BoundRule("invalid_exchange", "exchange", lambda x: ~x.isin(*b.exchanges),
                  "not allowed", lambda t: text("'", t, f"' not in {allowed}")),
    ]


# --- first failure over typed columns -----------------------------------------


def first_failure(bounds: RuleBounds = RuleBounds(), timestamp_first: bool = False) -> Column:
    """The first broken rule of a parsed row, or NULL.

    ``timestamp_first`` lets an unreadable timestamp be reported as such;
    otherwise the required-field rule, which comes earlier, claims it.
    """

    def typed(field: str) -> Column:
        return F.col("event_ts" if field == "timestamp" else field)

    corrupted = [
        (F.col("event_id").isNull() & F.col("symbol").isNull() & F.col("price").isNull(),
         CORRUPTED)
    ]
    required = [(typed(f).isNull(), f"missing_or_null: {f}") for f in bounds.required]
    timestamp = [
        (F.col("timestamp").isNotNull() & F.col("event_ts").isNull(),
         "invalid_timestamp: not ISO-8601")
    ]
    ranges, exchange = [], []
    for rule in bound_rules(bounds):
        check = (rule.fails(typed(rule.field)), f"{rule.code}: {rule.short}")
        (exchange if rule.field == "exchange" else ranges).append(check)

    if timestamp_first:
        checks = corrupted + timestamp + required + ranges + exchange
    else:
        checks = corrupted + required + ranges + timestamp + exchange
    return F.coalesce(*[F.when(failed, F.lit(reason)) for failed, reason in checks])


# --- every failure, over the JSON itself --------------------------------------

# How each JSON type is named in a failure message.
_TYPE_NAMES = {
    "STRING": "str",
    "BOOLEAN": "bool",
    "BIGINT": "int",
    "DOUBLE": "float",
    "DECIMAL": "float",
    "ARRAY": "list",
    "OBJECT": "dict",
    "VOID": "NoneType",
}
_NUMBER = ("BIGINT", "DECIMAL", "DOUBLE")


def _type_name(json_type: str) -> Column:
    pairs = ", ".join(f"'{x}'" for kv in _TYPE_NAMES.items() for x in kv)
    return F.expr(f"element_at(map({pairs}), {json_type})")


def read_json(df: DataFrame, raw: str = "raw_value") -> DataFrame:
    """Add the JSON reading of ``raw``: the document and, per field, value, type, text, number.

    Plain projections, so that what no rule asks for is pruned; put what is
    concluded from them behind ``add_once`` before filtering on it.
    """
    numeric = ("price", "volume", "change", "change_percent")
    numbers = ", ".join(f"'{t}'" for t in _NUMBER)

    def json_type(value: str) -> str:
        # The leading type name: DECIMAL(4,2) -> DECIMAL, OBJECT<...> -> OBJECT.
        return f"regexp_extract(schema_of_variant({value}), '^([A-Z]+)', 1)"

    df = df.withColumn("_doc", F.try_parse_json(raw)).selectExpr(
        "*", *[f"try_variant_get(_doc, '$.{f}', 'variant') AS _v_{f}" for f in WIRE_FIELDS]
    )
    df = df.selectExpr(
        "*",
        *[f"{json_type(f'_v_{f}')} AS _t_{f}" for f in WIRE_FIELDS],
        *[f"try_variant_get(_v_{f}, '$', 'string') AS _s_{f}" for f in WIRE_FIELDS],
    )
    root = F.when(F.col(raw).rlike(r"^\s*\{"), "OBJECT").otherwise(F.expr(json_type("_doc")))
    stamp = F.when(F.col("_t_timestamp") == "STRING", iso_timestamp(F.col("_s_timestamp")))
    return df.selectExpr(
        "*",
        *[
            f"CASE WHEN _t_{f} IN ({numbers}) THEN try_variant_get(_v_{f}, '$', 'double') END "
            f"AS _n_{f}"
            for f in numeric
        ],
    ).withColumns({"_iso_ts": stamp, "_doc_type": root})


def drop_json(df: DataFrame) -> DataFrame:
    """Remove the helper columns of ``read_json``."""
    return df.drop(*[c for c in df.columns if c[:3] in ("_v_", "_t_", "_s_", "_n_")],
                   "_doc", "_doc_type", "_iso_ts")


def _absent(field: str) -> Column:
    return F.expr(f"_v_{field} IS NULL")


def _null(field: str) -> Column:
    return F.expr(f"_t_{field} = 'VOID'")


def _given(field: str) -> Column:
    return F.expr(f"_v_{field} IS NOT NULL AND _t_{field} <> 'VOID'")


def _has_type(field: str, *types: str) -> Column:
    return F.expr(f"_t_{field} IN ({', '.join(repr(t) for t in types)})")


def failure_list(
    as_of: Column, bounds: RuleBounds = RuleBounds(), raw: str = "raw_value"
) -> Column:
    """Every broken rule as an array of ``code: detail`` texts, in rule order.

    Needs the columns of ``read_json``.
    """
    checks: list[tuple[Column, Column]] = []
    for f in bounds.required:
        checks.append((_absent(f), F.lit(f"missing_field: '{f}' is absent")))
        checks.append((_null(f), F.lit(f"null_value: '{f}' is null")))

    for f in ("price", "change", "change_percent"):
        shown = F.when(
            _has_type(f, "STRING"), F.concat(F.lit("'"), F.col(f"_s_{f}"), F.lit("'"))
        ).when(_has_type(f, "BOOLEAN"), F.initcap(F.col(f"_s_{f}"))).otherwise(
            F.to_json(F.col(f"_v_{f}"))
        )
        said = F.concat(F.lit(f"wrong_type: '{f}' must be numeric, got "),
                        _type_name(f"_t_{f}"), F.lit(" ("), shown, F.lit(")"))
        checks.append((_given(f) & ~_has_type(f, *_NUMBER), said))
    said = F.concat(F.lit("wrong_type: 'volume' must be integer, got "),
                    _type_name("_t_volume"))
    checks.append((_given("volume") & ~_has_type("volume", "BIGINT"), said))

    exchange = []
    for rule in bound_rules(bounds):
        if rule.field == "exchange":
            shown = F.concat(F.lit(f"{rule.code}: "), rule.detail(F.col("_s_exchange")))
            # A list, object, number or flag is no exchange code either.
            other = _given("exchange") & ~_has_type("exchange", "STRING")
            shown = F.when(other, F.concat(
                F.lit(f"{rule.code}: "), rule.detail(F.to_json(F.col("_v_exchange")))
            )).otherwise(shown)
            exchange.append((other | rule.fails(F.col("_s_exchange")), shown))
        else:
            # A variant's decimal has no -0.0; the text has.
            below = (F.col(f"_n_{rule.field}") == 0) & F.get_json_object(
                raw, f"$.{rule.field}").startswith("-")
            number = F.when(
                _has_type(rule.field, "BIGINT"), F.col(f"_s_{rule.field}")
            ).when(below, "-0.0").otherwise(F.col(f"_n_{rule.field}").cast("string"))
            shown = F.concat(F.lit(f"{rule.code}: "), rule.detail(number))
            checks.append((rule.fails(F.col(f"_n_{rule.field}")), shown))

    stamp, text = F.col("_iso_ts"), F.col("_s_timestamp")
    is_text = _has_type("timestamp", "STRING")
    ahead = (F.unix_micros(stamp) - F.unix_micros(as_of)) / 1e6
    checks += [
        (_given("timestamp") & ~is_text,
         F.concat(F.lit("invalid_timestamp: must be ISO-8601 string, got "),
                  _type_name("_t_timestamp"))),
        (is_text & stamp.isNull(),
         F.concat(F.lit("invalid_timestamp: '"), text, F.lit("' is not valid ISO-8601"))),
        (ahead > bounds.max_skew_seconds,
         F.concat(F.lit("future_timestamp: '"), text, F.lit("' is "),
                  ahead.cast("long").cast("string"),
                  F.lit(f"s ahead of now (max {bounds.max_skew_seconds}s)"))),
    ]
    found = F.array(*[F.when(failed, said) for failed, said in checks + exchange])
    return (
        F.when(F.col("_doc").isNull(), F.array(F.lit(CORRUPTED)))
        .when(
            F.col("_doc_type") != "OBJECT",
            F.array(F.concat(F.lit("wrong_root_type: expected object, got "),
                             _type_name("_doc_type"))),
        )
        .otherwise(F.filter(found, lambda x: x.isNotNull()))
    )


def all_failures(
    df: DataFrame,
    as_of: Column | None = None,
    bounds: RuleBounds = RuleBounds(),
    raw: str = "raw_value",
) -> DataFrame:
    """Add the verdict: ``is_valid``, ``reasons``, ``reason_codes``, ``error_reason``."""
    judged = add_once(
        read_json(df, raw), reasons=failure_list(F.current_timestamp() if as_of is None else as_of,
                                                 bounds, raw)
    )
    return drop_json(judged).withColumns(
        {
            "is_valid": F.size("reasons") == 0,
            "reason_codes": F.transform("reasons", lambda x: F.split_part(x, F.lit(":"), F.lit(1))),
            "error_reason": F.concat_ws("; ", "reasons"),
        }
    )


# --- the strict JSON contract ------------------------------------------------

# Text fields with their longest length (None: any).
_TEXT_FIELDS = {"event_id": None, "symbol": 12, "company": None, "exchange": None}


def strict_failures(df: DataFrame, raw: str = "raw_value") -> DataFrame:
    """Add ``contract_errors``: how ``raw`` breaks the published JSON contract.

    All nine fields present, no others, text fields non-empty and within their
    length, numbers typed, ``price > 0``, integral ``volume >= 0``.
    """
    checks = [(_absent(f), f"required: {f}") for f in WIRE_FIELDS]
    extra = F.size(F.array_except(F.json_object_keys(raw), F.array(*map(F.lit, WIRE_FIELDS)))) > 0
    checks.append((extra, "additional_properties"))
    for f in (*_TEXT_FIELDS, "timestamp"):
        checks.append((~_absent(f) & ~_has_type(f, "STRING"), f"type: {f}"))
    for f in ("price", "change", "change_percent"):
        checks.append((~_absent(f) & ~_has_type(f, *_NUMBER), f"type: {f}"))
    whole = F.col("_n_volume").isNotNull() & (F.col("_n_volume") == F.floor("_n_volume"))
    checks.append((~_absent("volume") & ~whole, "type: volume"))
    for f, longest in _TEXT_FIELDS.items():
        size = F.when(_has_type(f, "STRING"), F.char_length(f"_s_{f}"))
        checks.append((size < 1, f"min_length: {f}"))
        if longest:
            checks.append((size > longest, f"max_length: {f}"))
    checks.append((F.col("_n_price") <= 0, "minimum: price"))
    checks.append((F.col("_n_volume") < 0, "minimum: volume"))

    found = F.array(*[F.when(failed, F.lit(code)) for failed, code in checks])
    verdict = (
        F.when(F.col("_doc").isNull(), F.array(F.lit("not_json")))
        .when(F.col("_doc_type") != "OBJECT", F.array(F.lit("type: root")))
        .otherwise(F.filter(found, lambda x: x.isNotNull()))
    )
    return drop_json(add_once(read_json(df, raw), contract_errors=verdict))


# --- reasons as data ------------------------------------------------------------

# Who rejected the record, as the reason's prefix tells.
ORIGINS = (
    "producer_validation_failed",
    "kafka_delivery_failed",
    "producer_serialize_or_send_error",
)


def split_reason(reason: Column) -> Column:
    """A dead-letter reason as ``origin``, ``code`` and ``detail``."""
    prefix = F.regexp_extract(reason, rf"^({'|'.join(ORIGINS)}): ", 1)
    origin = F.when(prefix != "", prefix).otherwise(F.lit("stream_validation"))
    rest = F.regexp_replace(reason, rf"^({'|'.join(ORIGINS)}): ", "")
    return F.struct(
        origin.alias("origin"),
        F.regexp_extract(rest, r"^([a-z_]+)", 1).alias("code"),
        F.trim(F.regexp_replace(rest, r"^[a-z_]+:?", "")).alias("detail"),
    )


def first_reason(reason: Column) -> Column:
    """The first of ``;``-joined reasons."""
    return F.trim(F.split_part(reason, F.lit(";"), F.lit(1)))


# --- single-record predicates of the scorecard ----------------------------------


def is_complete(bounds: RuleBounds = RuleBounds()) -> Column:
    """Every required field present and not null (JSON reading)."""
    return F.coalesce(_all(_given(f) for f in bounds.required), F.lit(False))


def is_consistent(bounds: RuleBounds = RuleBounds()) -> Column:
    """A numeric price within the bounds (JSON reading)."""
    price = F.col("_n_price")
    return F.coalesce((price > bounds.price_min) & (price <= bounds.price_max), F.lit(False))


def is_timely(as_of: Column, bounds: RuleBounds = RuleBounds()) -> Column:
    """A readable timestamp no further from ``as_of`` than the freshness limit."""
    limit = max(bounds.max_skew_seconds, bounds.freshness_seconds)
    age = F.abs(F.unix_micros(as_of) - F.unix_micros("_iso_ts")) / 1e6
    return F.coalesce(age <= limit, F.lit(False))


def _all(conditions: Iterable[Column]) -> Column:
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result
