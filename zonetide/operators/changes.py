"""Change records: parse, flatten, route, type, and rebuild the current table. Batch and streaming frames alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonetide.functions import columns as C
from zonetide.functions import fixed_values as V
from zonetide.operators.joins import lookup_join
from zonetide.sources import schemas


def _fields_of(json_text: Column, schema: str | T.StructType) -> Column:
    """The fields of a JSON text as columns of their own, parsed once per row.

    A generator is a barrier: filters on the fields stay above it. As a plain projection, each filter would be pushed
    below with a copy of the parse.
    """
    return F.inline(F.array(F.from_json(json_text, schema)))


ENVELOPE_FIELDS = ("op", "ts_ms", "before", "after", "source")


def parse_envelope(
    broker: DataFrame,
    col: str = "value",
    keep: Sequence[str] = ("timestamp", "offset"),
    fields: Sequence[str] = ENVELOPE_FIELDS,
) -> DataFrame:
    """Broker rows to operation, source time, before/after text and source names, or to the asked `fields` of these.

    An object read into a string field keeps its JSON text, so the payload schema is chosen later. Fields that are not
    asked for are not parsed: nothing else would prune them behind the generator.
    """
    kept = [c for c in keep if c in broker.columns]
    wanted = T.StructType([f for f in T.StructType.fromDDL(schemas.ENVELOPE).fields if f.name in fields])
    plain = [f for f in fields if f != "source"]
    source = [F.col(f"source.{f}").alias(f"source_{f}") for f in ("db", "table", "ts_ms")] if "source" in fields else []
    return broker.select(*kept, _fields_of(F.col(col).cast("string"), wanted)).select(*kept, *plain, *source)


def parse_payload(envelopes: DataFrame, schema: str = schemas.TRIP_PAYLOAD) -> DataFrame:
    """The row after the change, flattened next to the change's metadata."""
    kept = [c for c in envelopes.columns if c not in ("before", "after")]
    return envelopes.select(*kept, _fields_of(F.col("after"), schema))


def flatten_change(envelopes: DataFrame, schema: str = schemas.TRIP_PAYLOAD) -> DataFrame:
    """Current row plus `__` metadata; a delete keeps its last row and is marked."""
    kept = [c for c in ("timestamp", "offset", "value") if c in envelopes.columns]
    meta = {
        "__op": F.col("op"),
        "__source_ts_ms": F.col("source_ts_ms"),
        "__source_db": F.col("source_db"),
        "__source_table": F.col("source_table"),
        "__deleted": F.col("op") == V.DELETE,
    }
    fields = T.StructType.fromDDL(schema).names
    return envelopes.select(
        *kept, *[c.alias(n) for n, c in meta.items()], _fields_of(F.coalesce("after", "before"), schema)
    ).select(*kept, *fields, *meta)


def with_target(df: DataFrame, topic_col: str = "topic") -> DataFrame:
    return df.withColumn("target", C.route_topic(topic_col))


def route(df: DataFrame, targets: Sequence[str], topic_col: str = "topic") -> dict[str, DataFrame]:
    """One frame per target table."""
    routed = with_target(df, topic_col)
    return {t: routed.filter(F.col("target") == t) for t in targets}


def type_change(
    rows: DataFrame,
    money: Sequence[str] = (),
    coordinates: Sequence[str] = (),
    micros: Sequence[str] = (),
    texts: Sequence[str] = (),
) -> DataFrame:
    """Loose JSON values to table types: money decimal(8,2), coordinates decimal(18,14), micros and text to times.

    A value that does not fit its type becomes null, and the stream goes on.
    """
    casts = {c: F.col(c).try_cast("decimal(8,2)") for c in money}
    casts |= {c: F.col(c).try_cast("decimal(18,14)") for c in coordinates}
    casts |= {c: F.timestamp_micros(c) for c in micros}
    casts |= {c: C.parse_ts(c) for c in texts}
    return rows.withColumns(casts)


MONEY = ("trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "total_amount")
PLACES = ("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")
TIMES = ("pickup_datetime", "dropoff_datetime", "created_at", "updated_at")


def _mirror_columns() -> dict[str, dict[str, T.DataType]]:
    """For each field of the source tables its type as it is sent, by table."""
    out: dict[str, dict[str, T.DataType]] = {}
    for table, payload in schemas.MIRROR_PAYLOADS.items():
        for field in T.StructType.fromDDL(payload).fields:
            out.setdefault(field.name, {})[table] = field.dataType
    return out


def mirrored(broker: DataFrame, col: str = "value") -> DataFrame:
    """Broker rows as rows of all mirror tables at once, with the columns of `mirror_schema`; `target` names the table.

    The text is parsed once, into a variant; every field is taken from it. A record that is no envelope, has no known
    operation or table, no object with an id, or a value that does not fit its type has the target `bad` and only its text.
    Times come as microseconds or as text.
    """
    text = F.col(col).cast("string")
    parsed = broker.select(
        text.alias("value"), F.inline(F.array(F.struct(F.try_parse_json(text).alias("_all"))))
    )
    take = lambda path, kind: F.try_variant_get("_all", path, kind)
    heads = {
        "__op": take("$.op", "string"),
        "__source_ts_ms": take("$.source.ts_ms", "bigint"),
        "__source_db": take("$.source.db", "string"),
        "__source_table": take("$.source.table", "string"),
    }
    # A delete has its last row before the change.
    after = take("$.after", "variant")
    row = F.when(after.isNull() | F.is_variant_null(after), take("$.before", "variant")).otherwise(after)
    rows = parsed.select("value", *[c.alias(n) for n, c in heads.items()], row.alias("_row"))
    fields, lost = {}, F.lit(False)
    for name, kinds in _mirror_columns().items():
        widest = "bigint" if "bigint" in {k.simpleString() for k in kinds.values()} else next(iter(kinds.values())).simpleString()
        raw = F.try_variant_get("_row", f"$.{name}", widest)
        typed = raw
        if name in MONEY:
            typed = raw.try_cast("decimal(8,2)")
        elif name in PLACES:
            typed = raw.try_cast("decimal(18,14)")
        elif name in TIMES:
            typed = F.coalesce(F.timestamp_micros(raw.try_cast("bigint")), C.parse_ts(raw))
        here = F.col("__source_table").isin(*kinds)
        narrow = [t for t, k in kinds.items() if k.simpleString() == "int" and widest == "bigint"]
        if typed is not raw:
            lost = lost | (here & raw.isNotNull() & typed.isNull())
        if narrow:
            lost = lost | (F.col("__source_table").isin(*narrow) & raw.isNotNull() & raw.try_cast("int").isNull())
        fields[name] = F.when(here, typed)
    known = F.col("__op").isin(*V.ALL_OPS) & F.col("__source_table").isin(*schemas.MIRROR_PAYLOADS)
    fits = known & F.try_variant_get("_row", "$.id", "string").isNotNull() & ~F.coalesce(lost, F.lit(False))
    typed_rows = rows.select("value", *heads, *[c.alias(n) for n, c in fields.items()], F.coalesce(fits, F.lit(False)).alias("_fits"))
    good = {n: F.when(F.col("_fits"), F.col(n)).alias(n) for n in (*fields, *heads)}
    return typed_rows.select(
        F.when(~F.col("_fits"), F.col("value")).alias("value"),
        *good.values(),
        F.when(F.col("_fits"), F.to_date("pickup_datetime")).alias("pickup_date"),
        F.when(F.col("_fits"), F.col("__source_table")).otherwise("bad").alias("target"),
    )


def _mirror_type(name: str, kinds: dict[str, T.DataType]) -> str:
    if name in MONEY:
        return "decimal(8,2)"
    if name in PLACES:
        return "decimal(18,14)"
    if name in TIMES:
        return "timestamp"
    names = {k.simpleString() for k in kinds.values()}
    return "bigint" if "bigint" in names else names.pop()


def mirror_schema() -> str:
    """What `mirrored` returns: the fields of all source tables and the change's metadata."""
    fields = ", ".join(f"{n} {_mirror_type(n, kinds)}" for n, kinds in _mirror_columns().items())
    meta = "__op string, __source_ts_ms bigint, __source_db string, __source_table string"
    return f"value string, {fields}, {meta}, pickup_date date, target string"


def split_bad(broker: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Good and bad broker rows: a bad one does not parse as an envelope, has no known operation, or has no row in it.

    The row is `after`, or `before` where that is missing, and must be a JSON object with an id.
    """
    parsed = F.from_json(
        F.col(col).cast("string"),
        "op string, before string, after string, _bad string",
        {"columnNameOfCorruptRecord": "_bad"},
    )
    payload = F.from_json(
        F.coalesce("_after", "_before"), "id string, _bad string", {"columnNameOfCorruptRecord": "_bad"}
    )
    is_bad = (
        F.col("_bad").isNotNull()
        | ~F.coalesce(F.col("_op").isin(*V.ALL_OPS), F.lit(False))
        | F.col("_row._bad").isNotNull()
        | F.col("_row.id").isNull()
    )
    marked = (
        broker.select("*", F.inline(F.array(parsed)).alias("_op", "_before", "_after", "_bad"))
        .withColumn("_row", payload)
        .withColumn("_is_bad", is_bad)
    )
    good, bad = marked.filter(~F.col("_is_bad")), marked.filter("_is_bad")
    return good.select(*broker.columns), bad.select(*broker.columns)


def latest_per_key(
    changes: DataFrame, pk: str | Sequence[str], order: Sequence[str] = ("ts_ms", "offset")
) -> DataFrame:
    """Newest change per key, of one column or several.

    `max` of a struct keeps one row per key and task before the shuffle, where ranking all changes of a key would
    bring a hot key's whole history into one task. The order columns must be unique together within a key.
    """
    keys = [pk] if isinstance(pk, str) else list(pk)
    rest = [c for c in changes.columns if c not in keys and c not in order]
    newest = changes.groupBy(*keys).agg(F.max_by(F.struct(*order, *rest), F.struct(*order)).alias("_row"))
    return newest.select(*keys, "_row.*").select(*changes.columns)


#: A log holds several tables, whose ids overlap.
ROW_KEY = ("__source_table", "id")


def current_state(
    log: DataFrame, pk: str | Sequence[str] = ROW_KEY, order: Sequence[str] = ("__source_ts_ms", "offset")
) -> DataFrame:
    """The current tables from a flattened change log: newest change per key, deleted keys left out."""
    return latest_per_key(log, pk, order).filter(~F.col("__deleted"))


def apply_updates(base: DataFrame, updates: DataFrame, key: str = "id", only_newer: bool = False) -> DataFrame:
    """Tip updates applied to trips: new tip, total recomputed from its parts, new updated_at; other rows unchanged.

    The latest update of a key counts, and of several at one time the highest tip. With `only_newer` an update from before
    the stored row's own last change is left out, so that batches give one result in whatever order they come.
    """
    parts = ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount")
    new = updates.groupBy(key).agg(
        F.max_by("tip_amount", F.struct("updated_at", "tip_amount")).alias("_tip"),
        F.max("updated_at").alias("_at"),
        F.lit(True).alias("_hit"),
    )
    joined = lookup_join(base, new, [key])
    if only_newer:
        hit = F.coalesce(F.col("_hit") & (F.col("updated_at").isNull() | (F.col("_at") >= F.col("updated_at"))), F.lit(False))
        joined = joined.withColumns(
            {"_hit": hit, "_tip": F.when(hit, F.col("_tip")), "_at": F.when(hit, F.col("_at"))}
        )
    joined = joined.withColumn("tip_amount", F.coalesce("_tip", "tip_amount"))
    present = [p for p in parts if p in base.columns]
    out = joined.withColumns(
        {
            "total_amount": F.when(F.col("_hit"), C.total(*present)).otherwise(F.col("total_amount")),
            "updated_at": F.coalesce("_at", "updated_at"),
        }
    )
    return out.select(*base.columns)
