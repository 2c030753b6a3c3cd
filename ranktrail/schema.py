"""Table schemas, the ordered status type and the built-in rulesets."""

from pyspark.sql import Column, types as T
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Names, orders and defaults that results depend on.
# ---------------------------------------------------------------------------

RANKINGS = ("topstories", "beststories", "newstories")

#: Best status first. The position is the code every comparison uses.
STATUSES = (
    "new",
    "hot",
    "tepid",
    "cooling",
    "cold",
    "unknown",
    "frozen",
    "missing",
    "failed",
    "deleted",
    "unexpected",
)

ERROR_SOURCES = ("run", "run_story")

#: Marker stored for an item whose response was the JSON value null.
JSON_NULL_MARKER = '"json_null"'

RULE_ID = "run_story_param"

BUILTIN_RULESETS = {
    "debug": """{
"new_repeat":1,
"hot_repeat":1,
"hot_rank":30,
"tepid_rank":60,
"tepid_age":"1 minute",
"cooling_repeat":1,
"cooling_age":"1 minute",
"cold_repeat":1,
"cold_age":"1 minute",
"failed_repeat":4,
"frozen_age":"1 minute",
"frozen_window":0
}""",
    "production_default": """{
"new_repeat":12,
"hot_repeat":6,
"hot_rank":30,
"tepid_rank":60,
"tepid_age":"19 minute",
"cooling_repeat":12,
"cooling_age":"59 minute",
"cold_repeat":2,
"cold_age":"6 hour",
"failed_repeat":4,
"frozen_age":"7 day",
"frozen_window":600
}""",
}

DEFAULT_RULESET = "production_default"

#: Rank jump of the pre-0.1.4 rule, same in both of its rulesets.
LEGACY_HOT_RANKBUMP = 30

#: Rulesets that ship with the software and are left out of a migration/export.
MIGRATION_BUILTINS = ("debug", "production", "production_default")

#: Values the 0.1.5 migration writes into the two columns it adds.
MIGRATED_VERSION = "0.1.5"
MIGRATED_RULESET = "unknown"

# ---------------------------------------------------------------------------

CODE = {name: code for code, name in enumerate(STATUSES)}


# The next two are SQL text because they sit in every plan: one call builds the expression.


def status_code(status: str = "status") -> Column:
    """Int code of a status column; NULL for NULL and for an unknown name."""
    arms = " ".join(f"WHEN '{name}' THEN {code}" for name, code in CODE.items())
    return F.expr(f"CASE {status} {arms} END")


def status_name(code: str) -> Column:
    """Inverse of :func:`status_code`."""
    names = ", ".join(f"'{name}'" for name in STATUSES)
    return F.expr(f"try_element_at(array({names}), {code} + 1)")


def checked_status(status: Column) -> Column:
    """The status itself; an unknown name fails the query, as a typed column would."""
    return F.when(status.isNull() | status.isin(*STATUSES), status).otherwise(
        F.raise_error(F.concat(F.lit("not a story status: "), status))
    )


def checked_error_source(source: Column) -> Column:
    return F.when(source.isNull() | source.isin(*ERROR_SOURCES), source).otherwise(
        F.raise_error(F.concat(F.lit("not an error source: "), source))
    )


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


_TS = T.TimestampNTZType()
_IDS = T.ArrayType(T.LongType())

RUN = _struct(
    ts_run=_TS,
    topstories=_IDS,
    beststories=_IDS,
    newstories=_IDS,
    ts_end=_TS,
    extversion=T.StringType(),
    ruleset_id=T.StringType(),
)
RUN_STORY = _struct(
    ts_run=_TS,
    story_id=T.LongType(),
    status=T.StringType(),
    score=T.IntegerType(),
    descendants=T.LongType(),
    ts_payload=_TS,
)
ERROR = _struct(
    ts_run=_TS,
    error_source=T.StringType(),
    source_id=T.StringType(),
    report=T.StringType(),
)
STORY = _struct(id=T.LongType(), status=T.StringType())
RULESET = _struct(id=T.StringType())
RULES = _struct(
    ruleset_id=T.StringType(), id=T.StringType(), type_val=T.StringType(), val=T.StringType()
)

_RESPONSE = dict(
    url=T.StringType(),
    payload=T.StringType(),
    ts_end=_TS,
    duration=T.DoubleType(),
    batch=T.LongType(),
    retries=T.IntegerType(),
    batch_failrate=T.DoubleType(),
)
RANKINGS_RAW = _struct(ts_run=_TS, id=T.StringType(), **_RESPONSE)
ITEMS_RAW = _struct(ts_run=_TS, id=T.LongType(), **_RESPONSE)

#: Natural keys; merging and idempotent writes rely on them.
KEYS = {
    "run": ("ts_run",),
    "run_story": ("ts_run", "story_id"),
    "error": ("ts_run", "error_source", "source_id"),
    "ruleset": ("id",),
    "rules": ("ruleset_id", "id"),
}

#: Number of records a story has in each status, one column per status.
COUNT_COLUMNS = tuple(f"n_{name}" for name in STATUSES) + ("n_none",)

#: One row per story: everything classification needs to know about its past.
STORY_STATE = T.StructType(
    [
        T.StructField("story_id", T.LongType()),
        T.StructField("last_ts", _TS),
        T.StructField("last_code", T.IntegerType()),
        T.StructField("last_score", T.IntegerType()),
    ]
    + [T.StructField(name, T.LongType()) for name in COUNT_COLUMNS]
)
