"""Registered queries for scalar date/JSON functions over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bindings as B
from .registry import register
from ..functions.dates import epoch_ts, parse_ts
from ..functions.text import extract_field


@register("extract_field", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def q_extract_field(spark, sf):
    ev = B.read(spark, sf, "events")
    return ev.select("event_id", extract_field("props", "k").cast("long").alias("k"))


@register("epoch_ts", """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch,
    to_timestamp(CAST(floor(epoch(ts)) AS BIGINT))::TIMESTAMP AS ts_utc FROM events""")
def q_epoch_ts(spark, sf):
    ev = B.read(spark, sf, "events")
    ep = F.unix_seconds(F.col("ts").cast("timestamp"))
    return ev.select("event_id", ep.alias("epoch"), epoch_ts(ep).alias("ts_utc"))


@register("parse_ts", """SELECT event_id, strptime(strftime(ts, '%d/%m/%Y %H:%M:%S'), '%d/%m/%Y %H:%M:%S') AS parsed,
    try_strptime(props, '%d/%m/%Y %H:%M:%S') AS bad,
    strptime(strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%dT%H:%M:%SZ') AS iso FROM events""")
def q_parse_ts(spark, sf):
    ev = B.read(spark, sf, "events")
    txt = F.date_format("ts", "dd/MM/yyyy HH:mm:ss")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return ev.select("event_id", parse_ts(txt, "dd/MM/yyyy HH:mm:ss").alias("parsed"),
                     parse_ts("props", "dd/MM/yyyy HH:mm:ss").alias("bad"),
                     parse_ts(iso, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"))
