"""Keyed parallel collect with per-key failure isolation.

The caller injects ``transport(key: dict) -> dict`` (e.g. an HTTP client
returning the API document). Each key is fetched inside a task; a failure
becomes a row with ``status='error'`` and the message, never a failed job
and never a ``None`` collected on the driver.

Two entry points:

* ``register_keyed_source`` - a Python Data Source with one input
  partition per key, for a literal key list of bounded size (the city
  dimension).
* ``collect_keyed`` - keys come from a DataFrame (any size); the calls run
  in ``mapInPandas`` over Arrow batches of the key rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from nimbus.operators.flatten import flatten_payload
from nimbus.operators.validate import MALFORMED
from nimbus.schemas import PAYLOAD
from nimbus.session import ship_package
from nimbus.sources.tolerant import CORRUPT, text_schema, type_records

RESULT_FIELDS = [
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("fetched_at", T.StringType()),
]

Transport = Callable[[dict], dict]


def _call(transport: Transport, key: dict) -> tuple[str, str | None, str | None, str]:
    fetched_at = datetime.now(timezone.utc).isoformat()
    try:
        doc = transport(key)
        if doc is None:
            return "error", "empty response", None, fetched_at
        return "ok", None, json.dumps(doc), fetched_at
    except Exception as exc:  # noqa: BLE001 - isolation is the point
        return "error", f"{type(exc).__name__}: {exc}", None, fetched_at


def register_keyed_source(spark: SparkSession, keys: list[tuple], key_schema: str,
                          transport: Transport, name: str = "keyed") -> str:
    """Register format ``name``: one partition (and one call) per key."""
    ship_package(spark)
    key_struct = T._parse_datatype_string(key_schema)
    key_names = [f.name for f in key_struct.fields]
    out_schema = T.StructType(list(key_struct.fields) + RESULT_FIELDS)
    fixed_keys = [tuple(k) for k in keys]

    class _Reader(DataSourceReader):
        def partitions(self):
            return [InputPartition(k) for k in fixed_keys]

        def read(self, partition):
            key = tuple(partition.value)
            yield key + _call(transport, dict(zip(key_names, key)))

    class _Source(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return out_schema

        def reader(self, schema):
            return _Reader()

    spark.dataSource.register(_Source)
    return name


def collect_keyed(keys: DataFrame, transport: Transport) -> DataFrame:
    """Call ``transport`` once per key row, inside tasks, in Arrow batches."""
    ship_package(keys.sparkSession)
    out_schema = T.StructType(list(keys.schema.fields) + RESULT_FIELDS)
    names = keys.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            res = [_call(transport, {n: r[i] for i, n in enumerate(names)})
                   for r in pdf.itertuples(index=False, name=None)]
            extra = pd.DataFrame(res, columns=[f.name for f in RESULT_FIELDS], index=pdf.index)
            yield pd.concat([pdf, extra], axis=1)

    return keys.mapInPandas(run, out_schema)


def payload_readings(fetched: DataFrame, city: str = "name", state: str = "state",
                     lat: str | None = "lat", lon: str | None = "lon") -> DataFrame:
    """Successful fetches -> flat readings (P1 over the attached city, J5).

    The answer is parsed leaf by leaf (``sources.tolerant``): what does not fit
    is named in ``_malformed``, and ``_corrupt_record`` holds the whole answer
    wherever something does not."""
    ok = fetched.filter(F.col("status") == "ok")
    # key columns get a prefix: the document has its own ``name``/``id`` fields
    keys = {"_k_city": city, "_k_state": state, "_k_fetched": "fetched_at"}
    if lat:
        keys["_k_lat"] = lat
    if lon:
        keys["_k_lon"] = lon
    parsed = ok.select(*[F.col(v).alias(k) for k, v in keys.items()],
                       "payload", F.from_json("payload", text_schema(PAYLOAD), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("_doc"))
    answer = "_k_payload"
    leaves = type_records(parsed.select(*keys, F.col("payload").alias(answer), "_doc.*"), PAYLOAD, [*keys, answer])
    whole = F.when(F.col(MALFORMED) != "", F.coalesce(CORRUPT, answer))
    return flatten_payload(leaves.withColumn(CORRUPT, whole), city="_k_city", state="_k_state", fetched_at="_k_fetched",
                           dim_lat="_k_lat" if lat else None, dim_lon="_k_lon" if lon else None)


def fetch_counts(fetched: DataFrame) -> tuple[DataFrame, Observation]:
    """Attach an observation counting ok / failed keys while the data flows."""
    obs = Observation("fetch")
    return fetched.observe(obs, F.count_if(F.col("status") == "ok").alias("ok"),
                           F.count_if(F.col("status") != "ok").alias("failed")), obs
