"""Protocol payload normalisation (NRM-1..7, SET-2, FLT-7).

The network clients of the original are single-machine I/O; here their
payload logic runs over a landing table of captured payloads
(``RAW_PAYLOAD_SCHEMA``), batch or stream, and yields standard messages
``(device_id, protocol, timestamp, data map, metadata map)``.

SNMP and CoAP polls return several values that form one message: a value
repeated within a poll keeps its last arrival (as a dictionary update does),
and the entries left, bounded by the configured OIDs or resources, are folded
to one map.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING_MAP = T.MapType(T.StringType(), T.StringType())
POLL_SPAN = "5 minutes"          # on a stream: the longest pause within a poll
MESSAGE_COLUMNS = ["source_id", "device_id", "protocol", "timestamp", "data", "metadata"]


def _text(payload: str = "payload") -> Column:
    return F.col(payload).cast("string")


def whole_json(text: Column) -> Column:
    """The text as a VARIANT, null unless it is one JSON value and nothing
    else. Spark's JSON parsers stop behind the first value, so the text is
    parsed as the only element of an array. Where it holds a ``]`` of its own,
    which might close that array early, it must be the value of an object,
    too: what stands behind a value cannot close both."""
    array = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    value = F.try_variant_get(F.try_parse_json(F.concat(F.lit('{"k":'), text, F.lit("}"))), "$.k", "variant")
    alone = ~F.contains(text, F.lit("]")) | value.isNotNull()
    return F.when(F.try_variant_get(array, "$[1]", "variant").isNull() & alone,
                  F.try_variant_get(array, "$[0]", "variant"))


def object_or_wrapped(text: Column, key: str) -> Column:
    """A JSON object as a string map; anything else (plain text, a JSON
    scalar or array, D15) wrapped as ``{key: text}``."""
    is_object = F.startswith(F.schema_of_variant(whole_json(text)), F.lit("OBJECT"))
    parsed = F.when(is_object, F.from_json(text, STRING_MAP))
    return F.coalesce(parsed, F.create_map(F.lit(key), text))


def device_from_topic(topic: Column) -> Column:
    """NRM-1: second level of ``sensors/<device>/data``, else ``unknown``."""
    seg = F.try_element_at(F.split(topic, "/"), F.lit(2))
    return F.coalesce(seg, F.lit("unknown"))


def _message(df: DataFrame, device: Column, protocol: str, data: Column,
             metadata: Column, source: Column) -> DataFrame:
    return df.select(source.alias("source_id"), device.alias("device_id"),
                     F.lit(protocol).alias("protocol"),
                     F.col("received_at").alias("timestamp"), data.alias("data"),
                     metadata.alias("metadata"))


def _meta(**cols: Column) -> Column:
    args = []
    for k, v in cols.items():
        args += [F.lit(k), v.cast("string")]
    return F.create_map(*args)


def normalize_mqtt(raw: DataFrame, source: str = "source_id") -> DataFrame:
    """NRM-1/2: MQTT payloads."""
    r = raw.where(F.col("protocol") == "MQTT")
    return _message(r, device_from_topic(F.col("topic")), "MQTT",
                    object_or_wrapped(_text(), "raw_message"),
                    _meta(topic=F.col("topic"), qos=F.col("qos"),
                          retain=F.lower(F.col("retain").cast("string"))),
                    F.col(source))


def normalize_websocket(raw: DataFrame, source: str = "source_id") -> DataFrame:
    """NRM-6: WebSocket text frames; metadata uri and message size."""
    r = raw.where(F.col("protocol") == "WebSocket")
    text = _text()
    return _message(r, F.coalesce(F.col("device_id"), F.lit("websocket_client")), "WebSocket",
                    object_or_wrapped(text, "raw_message"),
                    _meta(uri=F.col("uri"), message_size=F.char_length(text)),
                    F.col(source))


def normalize_tcp(raw: DataFrame, source: str = "source_id") -> DataFrame:
    """NRM-5: TCP bytes: UTF-8 JSON object -> map; other UTF-8 text ->
    ``{raw_text}``; bytes that are not UTF-8 -> ``{raw_binary: hex, size}``."""
    r = raw.where(F.col("protocol") == "TCP")
    text = _text()
    utf8 = F.is_valid_utf8(text)
    data = F.when(~utf8, F.create_map(
        F.lit("raw_binary"), F.lower(F.hex(F.col("payload"))),
        F.lit("size"), F.octet_length(F.col("payload")).cast("string"))
    ).otherwise(object_or_wrapped(text, "raw_text"))
    device = F.coalesce(F.col("device_id"),
                        F.concat(F.lit("tcp_"), F.col("host"), F.lit("_"),
                                 F.col("port").cast("string")))
    return _message(r, device, "TCP", data,
                    _meta(host=F.col("host"), port=F.col("port"),
                          data_size=F.octet_length(F.col("payload"))),
                    F.col(source))


def fold_polls(raw: DataFrame, source: str = "source_id",
               resources: Sequence[str] | None = None, span: str = POLL_SPAN) -> DataFrame:
    """NRM-3/4: one message per SNMP or CoAP poll, both in one pass.

    * SNMP: the var-binds of a poll -> map OID -> value.
    * CoAP: its successful (2.xx) responses -> map resource -> JSON document
      (the payload if it is JSON, else ``{raw_data}``); polls without one
      emit nothing. The metadata name the polled ``resources``, by default
      those that answered.

    A value repeated within a poll keeps its last arrival: one aggregate per
    (poll, entry), combined before the shuffle, so repeats are never
    collected; a second one folds the poll's entries, as many as there are
    OIDs or resources. A row without a poll id is a poll of its own.

    On a stream (``received_at`` with a watermark, append mode) the two
    aggregates are chained stateful ones. A poll is closed ``span`` after its
    last row, once the watermark has passed; its rows may lie that far apart.
    """
    live = raw.isStreaming
    snmp = F.col("protocol") == "SNMP"
    ok = snmp | ((F.col("protocol") == "CoAP") & F.startswith(F.col("response_code"), F.lit("2.")))
    text = _text()
    doc = F.coalesce(F.to_json(whole_json(text)), F.to_json(F.struct(text.alias("raw_data"))))
    values = raw.where(ok).select(
        "protocol", "host", "port", "poll_id", "received_at", F.col(source).alias("source_id"),
        F.coalesce("device_id", F.concat(F.lower("protocol"), F.lit("_"), F.col("host"))).alias("device_id"),
        F.when(F.col("poll_id").isNull(), F.col(source)).alias("_own"),
        F.when(snmp, F.col("community")).alias("community"),
        F.when(snmp, F.col("oid")).otherwise(F.col("resource")).alias("k"),
        F.when(snmp, F.col("oid_value")).otherwise(doc).alias("v"))
    keys = ["protocol", "device_id", "poll_id", "_own", "host", "port", "community"]
    entry = [F.session_window("received_at", span).alias("_w")] if live else []
    last = values.groupBy(*entry, *keys, "k").agg(
        F.max_by("v", "source_id").alias("v"), F.max("received_at").alias("received_at"),
        F.min("source_id").alias("source_id"))
    poll = [F.session_window(F.window_time("_w"), span)] if live else []
    polls = last.groupBy(*poll, *keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("data"),
        F.max("received_at").alias("timestamp"), F.min("source_id").alias("source_id"))
    polled = F.array_join(F.map_keys("data"), ",") if resources is None else F.lit(",".join(resources))
    return polls.select(
        "source_id", "device_id", "protocol", "timestamp", "data",
        F.when(F.col("protocol") == "SNMP", _meta(host=F.col("host"), port=F.col("port"), community=F.col("community")))
        .otherwise(_meta(host=F.col("host"), port=F.col("port"), resources=polled)).alias("metadata"), "poll_id")


def fold_snmp(raw: DataFrame, source: str = "source_id") -> DataFrame:
    """NRM-3 alone (see :func:`fold_polls`)."""
    return fold_polls(raw.where(F.col("protocol") == "SNMP"), source)


def fold_coap(raw: DataFrame, source: str = "source_id",
              resources: Sequence[str] | None = None) -> DataFrame:
    """NRM-4 alone (see :func:`fold_polls`)."""
    return fold_polls(raw.where(F.col("protocol") == "CoAP"), source, resources)


def normalize_row_local(raw: DataFrame, source: str = "source_id") -> DataFrame:
    """MQTT, WebSocket and TCP rows in ONE projection (a per-protocol CASE),
    so the landing data is read once for all row-local protocols."""
    r = raw.where(F.col("protocol").isin("MQTT", "WebSocket", "TCP"))
    text = _text()
    proto = F.col("protocol")
    tcp_data = F.when(~F.is_valid_utf8(text), F.create_map(
        F.lit("raw_binary"), F.lower(F.hex(F.col("payload"))),
        F.lit("size"), F.octet_length(F.col("payload")).cast("string"))
    ).otherwise(object_or_wrapped(text, "raw_text"))
    data = (F.when(proto == "TCP", tcp_data)
             .otherwise(object_or_wrapped(text, "raw_message")))
    device = (F.when(proto == "MQTT", device_from_topic(F.col("topic")))
               .when(proto == "WebSocket", F.coalesce(F.col("device_id"), F.lit("websocket_client")))
               .otherwise(F.coalesce(F.col("device_id"), F.concat(
                   F.lit("tcp_"), F.col("host"), F.lit("_"), F.col("port").cast("string")))))
    metadata = (F.when(proto == "MQTT", _meta(topic=F.col("topic"), qos=F.col("qos"),
                                              retain=F.lower(F.col("retain").cast("string"))))
                 .when(proto == "WebSocket", _meta(uri=F.col("uri"),
                                                   message_size=F.char_length(text)))
                 .otherwise(_meta(host=F.col("host"), port=F.col("port"),
                                  data_size=F.octet_length(F.col("payload")))))
    return r.select(F.col(source).alias("source_id"), device.alias("device_id"),
                    proto.alias("protocol"), F.col("received_at").alias("timestamp"),
                    data.alias("data"), metadata.alias("metadata"))


def normalize_all(raw: DataFrame, source: str = "source_id",
                  resources: Sequence[str] | None = None, span: str = POLL_SPAN) -> DataFrame:
    """SET-2: one stream of standard messages from every protocol: the
    row-local protocols in one pass, the polls in another. The same function
    serves streams (see :func:`fold_polls`)."""
    return normalize_row_local(raw, source).unionByName(
        fold_polls(raw, source, resources, span).select(*MESSAGE_COLUMNS))
