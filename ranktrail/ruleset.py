"""Rulesets: twelve parameters that drive classification."""

import json
from dataclasses import dataclass, fields

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema
from .functions.times import check_window, duration_seconds


@dataclass(frozen=True)
class Ruleset:
    """Thresholds; ages are in seconds."""

    name: str
    new_repeat: int
    hot_repeat: int
    hot_rank: int
    tepid_rank: int
    tepid_age: float
    cooling_repeat: int
    cooling_age: float
    cold_repeat: int
    cold_age: float
    failed_repeat: int
    frozen_age: float
    frozen_window: int

    def __post_init__(self):
        check_window(self.frozen_window)


class RulesetError(ValueError):
    """A ruleset is missing, ambiguous or incomplete."""


PARAMETERS = [f.name for f in fields(Ruleset) if f.name != "name"]
_AGES = [p for p in PARAMETERS if p.endswith("_age")]


def rules_table(spark: SparkSession, rulesets: dict[str, str]) -> DataFrame:
    """A ``rules`` table from JSON texts by name; a local relation, read without a job."""
    names = list(rulesets)
    columns = [names, [schema.RULE_ID] * len(names), ["jsonb"] * len(names), rulesets.values()]
    table = pa.table([pa.array(c, pa.string()) for c in columns], names=schema.RULES.names)
    return spark.createDataFrame(table, schema.RULES)


def builtin_rules(spark: SparkSession) -> DataFrame:
    """The ``rules`` table as shipped."""
    return rules_table(spark, schema.BUILTIN_RULESETS)


def builtin_rulesets(spark: SparkSession) -> DataFrame:
    """The ``ruleset`` table as shipped."""
    return spark.createDataFrame([(n,) for n in schema.BUILTIN_RULESETS], schema.RULESET)


def load_ruleset(rules: DataFrame, name: str = schema.DEFAULT_RULESET) -> Ruleset:
    """Read one ruleset, checking that it exists once and sets every parameter."""
    wanted = (F.col("ruleset_id") == name) & (F.col("id") == schema.RULE_ID)
    # one row is expected; a second one is enough to refuse
    found = rules.filter(wanted).select("val").limit(2).collect()
    if len(found) != 1:
        count = "no" if not found else "more than one"
        raise RulesetError(f'{count} rule "{schema.RULE_ID}" in ruleset "{name}"')
    if found[0].val is None:
        raise RulesetError(f'rule "{schema.RULE_ID}" of ruleset "{name}" is NULL')
    values = json.loads(found[0].val)
    parameters = {}
    for parameter in PARAMETERS:
        if values.get(parameter) is None:
            raise RulesetError(f'parameter {parameter} of ruleset "{name}" is NULL')
        read = duration_seconds if parameter in _AGES else int
        try:
            parameters[parameter] = read(values[parameter])
        except (TypeError, ValueError) as error:
            raise RulesetError(f'parameter {parameter} of ruleset "{name}": {error}') from error
    return Ruleset(name, **parameters)
