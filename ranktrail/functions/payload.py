"""Columns over landed JSON text."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import JSON_NULL_MARKER

#: Rendering of one response as JSON: every field present, ISO timestamps.
_JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

#: Fields read from an item payload.
ITEM_FIELDS = {
    "score": "int",
    "by": "string",
    "id": "bigint",
    "url": "string",
    "type": "string",
    "time": "bigint",
    "descendants": "bigint",
    "title": "string",
    "kids": "array<bigint>",
    "text": "string",
    "parent": "bigint",
}


def id_list(payload: Column) -> Column:
    """Ordered IDs of a JSON list; NULL for no response, bad JSON or an empty list.

    Elements are read as text, so an ID may be quoted. What is no integer leaves a NULL in its
    place, and the elements around it keep their positions.
    """
    texts = F.from_json(payload, "array<string>")
    return F.when(F.size(texts) > 0, F.transform(texts, lambda t: t.try_cast("bigint")))


def marked_payload(payload: Column) -> Column:
    """A landed payload, with a JSON null told apart from no response at all.

    White space around the null does not matter: a landed line may end in one.
    """
    return F.when(F.btrim(payload, F.lit(" \t\r\n")) == "null", F.lit(JSON_NULL_MARKER)).otherwise(payload)


def json_fields(df: DataFrame, json: str, **fields: str) -> DataFrame:
    """Add top-level members of a JSON column, cast to the given types.

    The text is parsed once for all of them. A member is NULL where it is absent, not of
    its type, or where the column holds no object; nested values come as JSON text.
    """
    names = list(fields)
    parsed = F.json_tuple(json, *names).alias(*[f"_{n}" for n in names])
    return df.select("*", parsed).withColumns(
        {n: F.col(f"_{n}").try_cast(t) for n, t in fields.items()}
    ).drop(*[f"_{n}" for n in names])


def to_report(fields: list[Column]) -> Column:
    return F.to_json(F.struct(*fields), _JSON_OPTIONS)


def splice(head: list[Column], name: str, raw: Column, tail: list[Column]) -> Column:
    """One JSON object whose member ``name`` is JSON text kept as it landed.

    Re-encoding through ``to_json`` would turn the payload into a quoted string.
    """
    front, back = to_report(head), to_report(tail)
    return F.concat(
        F.substring(front, F.lit(1), F.length(front) - 1),
        F.lit(f',"{name}":'),
        F.coalesce(raw, F.lit("null")),
        F.lit(","),
        F.substring(back, F.lit(2), F.length(back)),
    )
