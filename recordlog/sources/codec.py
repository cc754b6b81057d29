"""Decoding and encoding keys and values, JSON payloads and produce requests."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_FORMAT, FORMATS
from ..functions.names import parse_bool

RECORD_DDL = "key string, value string"
PRODUCE_REQUEST_DDL = ("keyFormat string, keySchema string, keySchemaId int, keySchemaVersion int, keySchemaSubject string, "
                       "valueFormat string, valueSchema string, valueSchemaId int, valueSchemaVersion int, valueSchemaSubject string, "
                       "records array<struct<key:string, value:string, partition:int, timestamp:bigint, "
                       "headers:map<string,string>, correlationId:string, traceabilityId:string>>")
RECORD_COLUMNS = ("key", "value", "partition", "headers", "correlationId", "traceabilityId")
SCHEMA_COLUMNS = {"schema": "Schema", "schema_id": "SchemaId", "schema_version": "SchemaVersion", "schema_subject": "SchemaSubject"}


def _fmt(f: str) -> str:
    f = f.upper()
    if f not in FORMATS:
        raise ValueError(f"unknown format {f}")
    if f in ("AVRO", "PROTOBUF"):
        raise NotImplementedError(f"{f} needs the spark-avro / spark-protobuf package and a schema registry")
    return f


CORRUPT = "_corrupt_record"


def _with_corrupt(schema) -> T.StructType:
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    if not isinstance(st, T.StructType):
        raise ValueError("a JSON value schema must be a struct")
    return T.StructType([f for f in st.fields if f.name != CORRUPT] + [T.StructField(CORRUPT, T.StringType())])


def decode_col(c: Column, fmt: str, schema: str | T.DataType | None = None) -> Column:
    """Key or value column by format: BINARY -> base64 text, STRING -> text,
    JSON / JSONSCHEMA -> struct of ``schema`` (the JSON text when no schema).  Malformed
    JSON gives a struct of nulls here; ``decode`` applies the error policy."""
    f = _fmt(fmt)
    if f == "BINARY":
        return F.base64(c.cast("binary"))
    if f == "STRING" or schema is None:
        return c.cast("string")
    return F.from_json(c.cast("string"), schema)


def decode(df: DataFrame, key_format: str = "STRING", value_format: str = "JSON", value_schema=None,
           on_error: str = "fail") -> DataFrame:
    """Decode key and value by format.

    For JSON values with a schema, a text that is not a JSON object of that schema is
    corrupt: ``fail`` raises at the first one, ``skip`` drops those records, ``keep``
    keeps them with a null value and the text in ``corrupt_value``.  A null value (a
    tombstone) is not corrupt."""
    if on_error not in ("fail", "skip", "keep"):
        raise ValueError("on_error must be fail, skip or keep")
    out = df.withColumn("key", decode_col(F.col("key"), key_format))
    if value_schema is None or _fmt(value_format) not in ("JSON", "JSONSCHEMA"):
        return out.withColumn("value", decode_col(F.col("value"), value_format, value_schema))
    parsed = F.from_json(F.col("value").cast("string"), _with_corrupt(value_schema),
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    out = out.withColumn("_p", parsed)
    bad = F.col("_p").isNotNull() & F.col(f"_p.{CORRUPT}").isNotNull()
    clean = F.when(bad, F.lit(None)).otherwise(F.col("_p").dropFields(CORRUPT))
    if on_error == "skip":
        return out.filter(~bad).withColumn("value", F.col("_p").dropFields(CORRUPT)).drop("_p")
    if on_error == "fail":
        err = F.raise_error(F.concat(F.lit("corrupt record value: "), F.col(f"_p.{CORRUPT}")))
        return (out.withColumn("_ok", F.when(bad, err.cast("boolean")).otherwise(F.lit(True)))
                .filter(F.col("_ok")).withColumn("value", F.col("_p").dropFields(CORRUPT)).drop("_p", "_ok"))
    return out.withColumn("corrupt_value", F.col(f"_p.{CORRUPT}")).withColumn("value", clean).drop("_p")


def encode_col(c: Column, fmt: str) -> Column:
    """Inverse of ``decode_col`` to bytes: BINARY expects base64 text, STRING text,
    JSON / JSONSCHEMA a struct/map (serialised with nulls kept) or JSON text."""
    f = _fmt(fmt)
    if f == "BINARY":
        return F.unbase64(c)
    return c.cast("binary")


def to_json_value(c: Column) -> Column:
    return F.to_json(c, {"ignoreNullFields": "false"})


def to_outgoing(df: DataFrame, topic: str | Column | None = None, key_format: str = "STRING",
                value_format: str = "JSON", keep=()) -> DataFrame:
    """Records ready for a sink (``key``/``value`` bytes, ``topic``, ``headers``); structs and
    maps in JSON formats are serialised first."""
    t = F.col("topic") if topic is None else (topic if isinstance(topic, Column) else F.lit(topic))
    kt = dict((f.name, f.dataType) for f in df.schema.fields)

    def ser(name: str, fmt: str) -> Column:
        c = F.col(name)
        if _fmt(fmt) in ("JSON", "JSONSCHEMA") and isinstance(kt[name], (T.StructType, T.MapType, T.ArrayType)):
            c = to_json_value(c)
        return encode_col(c, fmt)

    cols = [t.alias("topic"), ser("key", key_format).alias("key"), ser("value", value_format).alias("value")]
    if "headers" in df.columns:
        cols.append(F.col("headers"))
    return df.select(*cols, *keep)


def records_to_json(df: DataFrame) -> DataFrame:
    """One JSON object per record (topic, key, value, partition, offset) -- no driver collect."""
    return df.select(F.to_json(F.struct(
        "topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        F.col("partition_id").alias("partition"), F.col("log_offset").alias("offset")),
        {"ignoreNullFields": "false"}).alias("json"))


def explode_batch(df: DataFrame, col: str, element_ddl: str, mode: str = "FAILFAST") -> DataFrame:
    """A JSON array payload (one batch) -> one row per element; malformed text raises
    (FAILFAST) or yields no rows (PERMISSIVE)."""
    arr = F.from_json(F.col(col), f"array<struct<{element_ddl}>>", {"mode": mode})
    keep = [c for c in df.columns if c != col]
    return df.select(*keep, F.explode(arr).alias("_e")).select(*keep, "_e.*")


def ingest_requests(df: DataFrame, col: str = "request", defaults: tuple[str, str] = (DEFAULT_FORMAT, DEFAULT_FORMAT),
                    schemas: bool = False) -> DataFrame:
    """Produce-request JSON -> one row per record with its position ``seq``; missing key and
    value formats take the defaults, names upper-cased, an unknown name raises.

    With ``schemas`` also ``record_ts`` (the record's own time, epoch millis in the request) and, for key and
    value, ``*_schema``, ``*_schema_id``, ``*_schema_version`` and ``*_schema_subject`` as the request names
    them (see ``json_schema.Schemas``)."""
    r = F.from_json(F.col(col), PRODUCE_REQUEST_DDL, {"mode": "FAILFAST"}).alias("_r")
    keep = [c for c in df.columns if c != col]
    sides = ("key", "value")

    def known(side: str, default: str) -> Column:
        f = F.upper(F.coalesce(F.col(f"_r.{side}Format"), F.lit(default)))
        return F.when(f.isin(*FORMATS), f).otherwise(F.raise_error(F.concat(F.lit("unknown format "), f)))

    named = [F.col(f"_r.{side}{field}").alias(f"{side}_{name}") for side in sides for name, field in SCHEMA_COLUMNS.items()]
    more = [F.timestamp_millis("_rec.timestamp").alias("record_ts"), *[f"{s}_{n}" for s in sides for n in SCHEMA_COLUMNS]]
    return (df.select(*keep, r)
            .select(*keep, *[known(s, d).alias(f"{s}_format") for s, d in zip(sides, defaults)], *named,
                    F.posexplode("_r.records").alias("seq", "_rec"))
            .select(*keep, "key_format", "value_format", F.col("seq").cast("bigint").alias("seq"),
                    *[f"_rec.{c}" for c in RECORD_COLUMNS], *(more if schemas else [])))


def write_kafka(df: DataFrame, bootstrap: str, topic: str | None = None, options: dict | None = None,
                key_format: str = "STRING", value_format: str = "JSON") -> None:
    """Produce records to Kafka (needs the spark-sql-kafka package).  Rows carry their
    topic unless ``topic`` is given; the broker assigns offsets."""
    out = to_outgoing(df, topic, key_format, value_format)
    if "headers" in out.columns:
        out = out.withColumn("headers", F.transform(F.map_entries("headers"), lambda h: F.struct(
            h["key"].alias("key"), h["value"].cast("binary").alias("value"))))
    w = out.write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    try:
        w.save()
    except Exception as e:  # noqa: BLE001
        if "find data source" in str(e).lower() or "DATA_SOURCE_NOT_FOUND" in str(e):
            raise RuntimeError("the Kafka sink is not on the class path (spark-sql-kafka package)") from e
        raise


_RECORD_FIELDS = ("topic string, key string, value string, partition int, offset bigint, "
                  "headers map<string,string>, timestamp bigint")
RESULT_LIST_DDL = (f"array<struct<record:struct<{_RECORD_FIELDS}>, consumerRecord:struct<{_RECORD_FIELDS}>, "
                   "processed:string, stacktrace:string, correlationId:string, traceabilityId:string, key:string>>")


def results_from_json(df: DataFrame, col: str = "body", mode: str = "FAILFAST") -> DataFrame:
    """A backend's response body (JSON list of per-record results) -> results DataFrame.

    The record may come as ``record`` or as ``consumerRecord`` (both names occur);
    ``processed`` may be a JSON boolean or text (``true`` in any case is true, anything else
    false); missing it stays null (not counted as failed, still a dead letter)."""
    keep = [c for c in df.columns if c != col]
    r = df.select(*keep, F.explode(F.from_json(F.col(col), RESULT_LIST_DDL, {"mode": mode})).alias("_r"))
    rec = F.coalesce(F.col("_r.record"), F.col("_r.consumerRecord"))
    return r.select(
        *keep, rec["topic"].alias("topic"), rec["partition"].alias("partition_id"),
        rec["offset"].alias("log_offset"), F.timestamp_millis(rec["timestamp"]).alias("timestamp"),
        rec["key"].alias("key"), rec["value"].alias("value"), rec["headers"].alias("headers"),
        F.col("_r.key").alias("result_key"), F.col("_r.correlationId").alias("correlation_id"),
        F.col("_r.traceabilityId").alias("traceability_id"), F.when(F.col("_r.processed").isNotNull(), parse_bool("_r.processed")).alias("processed"),
        F.col("_r.stacktrace").alias("stacktrace"))
