"""Message contracts: which JSON payloads are accepted, and why others are not.

A contract is an ordered list of checks over one payload column. The first
failing check gives the error text; NULL means accepted. Everything is a column
expression, so batch frames and streams share it and no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAYLOAD = "payload"
ERROR = "error"
_BODY = "__body"
_UTF8 = "__utf8"
_MISSING = "__missing"


@dataclass(frozen=True)
class Domain:
    """The text value of ``field`` must be one of ``allowed``."""

    field: str
    allowed: tuple[str, ...]
    label: str


@dataclass(frozen=True)
class NonNegativeInteger:
    """``field`` must be a JSON integer of at least zero (no text, no fraction)."""

    field: str


@dataclass(frozen=True)
class IsoTime:
    """``field`` must be ISO-8601 text."""

    field: str


@dataclass(frozen=True)
class IntegerLike:
    """``field`` must convert to an integer; number text and fractions do."""

    field: str


Check = Domain | NonNegativeInteger | IsoTime | IntegerLike


@dataclass(frozen=True)
class Contract:
    """Required keys, the typed checks after them, and the accepted columns."""

    required: tuple[str, ...]
    columns: str
    checks: tuple[Check, ...] = field(default=())
    missing_label: str = "Missing fields"


# Keys, domains and message texts of the four message kinds.
CORRIDORS = ("north", "central", "south")
TRAFFIC_KEYS = ("event_id", "event_time", "user_id", "path", "bytes_sent")
CORRIDOR_KEYS = ("event_id", "event_time", "corridor", "speed_kph")
GAMEPLAY_KEYS = (
    "event_id", "event_time", "match_id", "player_id", "event_type", "action", "score_delta",
)


def traffic_contract() -> Contract:
    """Web traffic: keys, and ``bytes_sent`` must convert to an integer."""
    return Contract(
        TRAFFIC_KEYS,
        "event_id string, event_time string, user_id string, path string, bytes_sent bigint",
        (IntegerLike("bytes_sent"),),
        missing_label="Missing traffic fields",
    )


def corridor_contract(corridors: Sequence[str] = CORRIDORS) -> Contract:
    """Road sensors: keys, known corridor, integer speed, readable time."""
    return Contract(
        CORRIDOR_KEYS,
        "event_id string, event_time string, corridor string, speed_kph bigint",
        (
            Domain("corridor", tuple(corridors), "Unknown corridor"),
            NonNegativeInteger("speed_kph"),
            IsoTime("event_time"),
        ),
    )


def gameplay_contract(missing_label: str = "Missing fields") -> Contract:
    """Match events: keys only, time and types stay unchecked."""
    return Contract(
        GAMEPLAY_KEYS,
        "event_id string, event_time string, match_id string, player_id string, "
        "event_type string, action string, score_delta bigint, message string",
        missing_label=missing_label,
    )


def key_list(keys: Column) -> Column:
    """``['a', 'b']`` text of a string array."""
    quoted = F.transform(keys, lambda k: F.concat(F.lit("'"), k, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def _failure(check: Check) -> Column:
    path = f"$.{check.field}"
    if isinstance(check, IntegerLike):
        number = F.try_variant_get(F.col(_BODY), path, "bigint")
        return F.when(number.isNull(), F.lit(f"{check.field} is not an integer"))
    kind = F.schema_of_variant(F.try_variant_get(F.col(_BODY), path, "variant"))
    text = F.try_variant_get(F.col(_BODY), path, "string")
    if isinstance(check, Domain):
        known = F.coalesce((kind == "STRING") & text.isin(*check.allowed), F.lit(False))
        shown = F.coalesce(text, F.lit("None"))
        return F.when(~known, F.concat(F.lit(f"{check.label}: "), shown))
    if isinstance(check, NonNegativeInteger):
        # Integers beyond 64 bits parse as wide decimals; a trimmed fraction such
        # as 50.0 parses as a narrow one and is refused.
        whole = F.coalesce(kind.rlike(r"^(BIGINT|DECIMAL\((19|[23]\d),0\))$"), F.lit(False))
        negative = F.coalesce(text.startswith("-"), F.lit(True))
        return F.when(
            ~whole | negative, F.lit(f"{check.field} must be a non-negative integer")
        )
    good = (kind == "STRING") & text.contains("-") & F.try_to_timestamp(text).isNotNull()
    return F.when(
        ~F.coalesce(good, F.lit(False)),
        F.concat(F.lit("Invalid isoformat string: "), F.coalesce(text, F.lit("None"))),
    )


def check_messages(df: DataFrame, contract: Contract, value: str = "value") -> DataFrame:
    """Replace the bytes or text column ``value`` by ``payload``, ``error`` and the
    contract's columns. The columns are NULL for refused rows; other columns stay.

    The payload is parsed once, into a variant; a key that is present with a JSON
    null is not missing.
    """
    raw = F.col(value).cast("string")
    kept = [c for c in df.columns if c != value]
    fields = [part.split() for part in contract.columns.split(",")]
    clash = {PAYLOAD, ERROR, *(name for name, _ in fields)} & set(kept)
    if clash:
        raise ValueError(f"Rename the message columns {sorted(clash)} first")
    parsed = df.select(
        *kept, F.make_valid_utf8(raw).alias(PAYLOAD), F.is_valid_utf8(raw).alias(_UTF8)
    ).withColumn(_BODY, F.try_parse_json(PAYLOAD))
    keys = sorted(contract.required)
    absent = [
        F.when(F.try_variant_get(F.col(_BODY), f"$.{k}", "variant").isNull(), F.lit(k))
        for k in keys
    ]
    listed = parsed.withColumn(_MISSING, F.array_compact(F.array(*absent)))
    missing = F.col(_MISSING)
    # Only a payload without any of the keys can be something else than an object.
    no_object = (F.size(missing) == len(keys)) & ~F.schema_of_variant(F.col(_BODY)).startswith(
        "OBJECT"
    )
    error = F.coalesce(
        F.when(~F.col(_UTF8), F.lit("payload is not valid UTF-8")),
        F.when(F.col(_BODY).isNull() | no_object, F.lit("payload is not a JSON object")),
        F.when(
            F.size(missing) > 0,
            F.concat(F.lit(f"{contract.missing_label}: "), key_list(missing)),
        ),
        *[_failure(check) for check in contract.checks],
        F.lit(None).cast("string"),
    )
    accepted_row = F.col(ERROR).isNull()
    outcome = F.struct(
        PAYLOAD,
        ERROR,
        *[
            F.when(accepted_row, F.try_variant_get(F.col(_BODY), f"$.{name}", kind)).alias(name)
            for name, kind in fields
        ],
    )
    # Filters on the outcome stay above a generator. Pushed below the parse, every
    # mention of the variant in them would parse the payload again.
    return listed.withColumn(ERROR, error).select(*kept, F.inline(F.array(outcome)))


def accepted(checked: DataFrame) -> DataFrame:
    """Rows that passed their contract, without the contract's own columns."""
    return checked.filter(F.col(ERROR).isNull()).drop(PAYLOAD, ERROR)


def dead_letters(checked: DataFrame, failed_at: Column | None = None) -> DataFrame:
    """Refused messages: payload, reason and time of refusal. A replay gives the time it stands for."""
    time = F.current_timestamp() if failed_at is None else failed_at
    return checked.filter(F.col(ERROR).isNotNull()).select(PAYLOAD, ERROR, time.alias("failed_at"))


def demand_accepted(checked: DataFrame) -> DataFrame:
    """Fail the job on the first refused message instead of routing it."""
    return checked.withColumn(
        ERROR,
        F.when(F.col(ERROR).isNull(), F.col(ERROR)).otherwise(
            F.raise_error(F.concat(F.col(ERROR), F.lit(" in "), F.col(PAYLOAD)))
        ),
    ).filter(F.col(ERROR).isNull())


def encode(df: DataFrame, sort_keys: bool = False, value: str = "value") -> DataFrame:
    """Rows as compact JSON text; NULL members are kept as ``null``."""
    columns = sorted(df.columns) if sort_keys else df.columns
    body = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return df.select(body.alias(value))
