"""Landed responses: what was requested, and what came back as JSON text.

The network client is not part of this library. Responses are read from files of the
``RANKINGS_RAW`` / ``ITEMS_RAW`` layout; a request without a file row has failed.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.payload import ITEM_FIELDS, id_list, marked_payload
from ..schema import ITEMS_RAW, RANKINGS, RANKINGS_RAW

RESPONSE_FIELDS = ["ts_end", "duration", "batch", "retries", "batch_failrate"]

#: Where requests point; ``%s`` takes the list name or the item ID.
RANKING_URL = "%s.json"
ITEM_URL = "item/%s.json"


def read_rankings(
    spark: SparkSession, path: str, stream: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.schema(RANKINGS_RAW).json(path)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ITEMS_RAW).json(path)


def _url(template: str, value: Column) -> Column:
    return F.format_string(template, value)


def parse_rankings(
    responses: DataFrame,
    names=RANKINGS,
    url: str = RANKING_URL,
    runs: DataFrame | None = None,
) -> DataFrame:
    """One row per run and requested list, its ordered IDs, and how the request went.

    ``runs`` (ts_run) is the schedule: a run in which no fetch left a row still has its lists, all
    failed. Without it the runs are those with any response. The request set multiplies each
    run by the few requested names, so responses are looked up by (run, name).
    """
    wanted = F.explode(F.array(*[F.lit(n) for n in dict.fromkeys(names)])).alias("id")
    known = responses.select("ts_run")
    if runs is not None:
        known = known.unionAll(runs.select("ts_run"))
    requests = known.distinct().select("ts_run", wanted)
    return (
        requests.join(
            responses.select("ts_run", "id", "payload", *RESPONSE_FIELDS), ["ts_run", "id"], "left"
        )
        .withColumn("url", _url(url, F.col("id")))
        .withColumn("payload", id_list(F.col("payload")))
        .select("ts_run", "id", "url", "payload", *RESPONSE_FIELDS)
    )


def attach_responses(requests: DataFrame, responses: DataFrame, url: str = ITEM_URL) -> DataFrame:
    """Requests, unique on (ts_run, story_id), with their response.

    Three payload states: JSON text, the marker for a JSON null, and NULL where the
    request failed or nothing landed.
    """
    landed = responses.select(
        "ts_run", F.col("id").alias("story_id"), "payload", *RESPONSE_FIELDS
    )
    return (
        requests.join(landed, ["ts_run", "story_id"], "left")
        .withColumn("url", _url(url, F.col("story_id").cast("string")))
        .withColumn("payload", marked_payload(F.col("payload")))
    )


def parse_items(requests: DataFrame, responses: DataFrame, url: str = ITEM_URL) -> DataFrame:
    """One row per distinct requested (ts_run, story_id) with its payload and how it went."""
    wanted = requests.select("ts_run", "story_id").distinct()
    return attach_responses(wanted, responses, url).select(
        "ts_run", F.col("story_id").alias("id"), "url", "payload", *RESPONSE_FIELDS
    )


def extract_item_fields(items: DataFrame) -> DataFrame:
    """The item fields of each payload as typed columns."""
    schema = ", ".join(f"`{name}` {dtype}" for name, dtype in ITEM_FIELDS.items())
    keys = [F.col("ts_run"), F.col("id").alias("story_id")]
    return items.select(*keys, F.from_json("payload", schema).alias("item")).select(
        "ts_run", "story_id", *[F.col("item")[name].alias(name) for name in ITEM_FIELDS]
    )
