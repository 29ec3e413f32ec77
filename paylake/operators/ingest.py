"""Change-data ingest: extracts, watermarks, message envelopes, the
dead-letter split, schema alignment, insert-ignore and the state fold."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO_NTZ = "yyyy-MM-dd'T'HH:mm:ss"
JSON_OPTS = {"timestampNTZFormat": ISO_NTZ, "ignoreNullFields": "false"}


# -- extracts --------------------------------------------------------------

def incremental(df: DataFrame, watermark_col: str, since: str, inclusive: bool = False) -> DataFrame:
    """Rows changed after ``since``. ``inclusive`` (>=) keeps rows of the
    same second as the last watermark (repair of D7; dedup by key after).
    The predicate is pushed into the scan."""
    wm = F.col(watermark_col)
    since_c = F.lit(since).cast(df.schema[watermark_col].dataType)
    return df.filter(wm >= since_c if inclusive else wm > since_c)


def next_watermark(df: DataFrame, table: str, watermark_col: str, since: str) -> DataFrame:
    """Advance a table's watermark to the max of the new rows; unchanged
    when there are none (S4). One global aggregate."""
    since_c = F.lit(since).cast(df.schema[watermark_col].dataType)
    new = incremental(df, watermark_col, since)
    return new.agg(F.max(watermark_col).alias("m")).select(
        F.lit(table).alias("table_name"), F.coalesce("m", since_c).alias("watermark"),
        F.col("m").isNotNull().alias("advanced"))


def poll(df: DataFrame, table: str, watermark_col: str, state: DataFrame, start: str) -> tuple[DataFrame, DataFrame]:
    """One incremental poll with a persisted watermark (S4, T2; repair of
    D9 and D7).

    ``state`` holds ``(table_name, watermark)`` rows appended by earlier
    polls; the last one per table is where this poll starts (``start`` on
    the first run). Rows at or after it are extracted (``>=``: rows of the
    same second are not lost; downstream dedup by key absorbs the repeat),
    and the returned state row is to be appended once the extract is
    written. Returns ``(rows, new_state_row)``."""
    wm_type = df.schema[watermark_col].dataType
    # one value per table: read it, so the predicate is a literal that the
    # scan can push down (partition / row-group pruning)
    last = state.filter(F.col("table_name") == table).agg(F.max("watermark")).first()[0]
    since = F.lit(last).cast(wm_type) if last is not None else F.lit(start).cast(wm_type)
    rows = df.filter(F.col(watermark_col) >= since)
    new_state = rows.agg(F.max(watermark_col).alias("m")).select(
        F.lit(table).alias("table_name"), F.coalesce("m", since).alias("watermark"))
    return rows, new_state


def hybrid_load(df: DataFrame, watermark_col: str, cutoff: str) -> DataFrame:
    """Snapshot (op ``r``) of everything up to ``cutoff``, then the changes
    after it (op ``c``), as one stream of rows (S5)."""
    cut = F.lit(cutoff).cast(df.schema[watermark_col].dataType)
    wm = F.col(watermark_col)
    snap = df.filter(wm.isNull() | (wm <= cut)).withColumn("op", F.lit("r"))
    delta = df.filter(wm > cut).withColumn("op", F.lit("c"))
    return snap.unionByName(delta)


def paged(df: DataFrame, key: str, page: int, size: int) -> DataFrame:
    """One page of ``size`` rows in key order, LIMIT/OFFSET style (L2).
    Spark keeps the top ``(page + 1) * size`` rows per task, so deep pages
    grow; iterate with :func:`page_after` instead, and use the partitioned
    scan for full extracts."""
    return df.orderBy(F.col(key).asc_nulls_last()).offset(page * size).limit(size)


def page_after(df: DataFrame, key: str, after, size: int) -> DataFrame:
    """Keyset page: the ``size`` rows following key ``after``. The predicate
    is pushed into the scan and each task keeps at most ``size`` rows, at
    any depth."""
    rest = df if after is None else df.filter(F.col(key) > F.lit(after))
    return rest.orderBy(F.col(key).asc()).limit(size)


def hash_sample(df: DataFrame, key: str, fraction: float, salt: str = "") -> DataFrame:
    """Repeatable sample: keep a row when the md5 of its key falls in the
    first ``fraction`` of the hash space (L3). No sort, no shuffle; the same
    key is always in or out."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.col(key).cast("string"))), 1, 8), 16, 10)
    return df.filter(h.cast("bigint") < F.lit(int(fraction * 0xFFFFFFFF)))


# -- messages --------------------------------------------------------------

def _jsonable(df: DataFrame) -> list[Column]:
    """Decimal -> double, as the producer's JSON encoder does (K2)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        out.append(c.alias(f.name))
    return out


def envelope(df: DataFrame, table: str, op: str, ts_ms: int, key_col: str) -> DataFrame:
    """Wrap each row as ``{_meta:{table,op,ts_ms}, payload:{...}}`` on topic
    ``pg.<table>`` (K1). Times are ISO text, NULLs are kept."""
    meta = F.struct(F.lit(table).alias("table"), F.lit(op).alias("op"), F.lit(ts_ms).cast("bigint").alias("ts_ms"))
    msg = F.struct(meta.alias("_meta"), F.struct(*_jsonable(df)).alias("payload"))
    return df.select(F.lit(f"pg.{table}").alias("topic"),
                     F.col(key_col).cast("string").alias("message_key"),
                     F.to_json(msg, JSON_OPTS).alias("value"))


RESCUED = "_rescued"   # column of landed tables for fields that their schema lacks

META = T.StructType([T.StructField("table", T.StringType()), T.StructField("op", T.StringType()),
                     T.StructField("ts_ms", T.LongType())])


def _parse_schema(schema: T.StructType) -> T.StructType:
    """Envelope fields, the payload, the same fields at top level (a message
    without an envelope is its own payload) and a corrupt-record column."""
    return T.StructType([T.StructField("_meta", META), T.StructField("payload", schema), *schema.fields,
                         T.StructField("_corrupt", T.StringType())])


def decode(messages: DataFrame, schema: T.StructType, rescue: str | None = None) -> DataFrame:
    """Parse message values against ``schema``; classify rejects.

    Adds ``error_msg`` (NULL for good rows) and one typed column per schema
    field. Reasons: ``malformed_json``, ``not_an_object``, ``null_payload``,
    ``type_mismatch:<field>``. A value without ``payload`` is the payload.

    The typed parse is one ``from_json`` (PERMISSIVE, corrupt-record
    column): malformed text, non-objects and values of the wrong type all
    land in the corrupt column. Only rejected rows and rows without a parsed
    payload or with nulls alone are parsed again as VARIANT, inside one ``when``, to name
    the reason; a good row passes one parse and no other operator.

    With ``rescue`` a VARIANT column of that name holds the payload's fields that ``schema`` lacks
    (null if there are none), so that a field the source has added is not lost."""
    keep = list(messages.columns)
    j = F.from_json(F.col("value"), _parse_schema(schema),
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    parsed = messages.select(*keep, j.alias("_j"))
    corrupt = F.col("_j._corrupt").isNotNull()
    no_payload = F.col("_j.payload").isNull()
    field = {f.name: F.when(~no_payload, F.col(f"_j.payload.{f.name}")).otherwise(F.col(f"_j.{f.name}")) for f in schema.fields}
    bare = reduce(lambda a, b: a & b, [c.isNull() for c in field.values()])
    # evaluated for the few rows in doubt; the parsed value is bound once
    doubt = F.transform(F.array(F.try_parse_json(F.col("value"))), lambda p: _reason(p, schema, corrupt))[0]
    out = parsed.select(*keep, "_j", F.when(corrupt | no_payload | bare, doubt).alias("error_msg"))
    more = []
    if rescue:
        payload = F.coalesce(F.get_json_object("value", "$.payload"), F.col("value"))
        known = F.array(*[F.lit(f.name) for f in schema.fields], F.lit("_meta"))
        unknown = F.size(F.array_except(F.json_object_keys(payload), known)) > 0
        rest = F.map_filter(F.from_json(payload, "map<string,variant>"), lambda k, _: ~F.array_contains(known, k))
        more = [F.when(F.col("error_msg").isNull() & unknown, F.try_parse_json(F.to_json(rest))).alias(rescue)]
    return out.select(*keep, "error_msg", *[c.alias(n) for n, c in field.items()], *more)


def _reason(p: Column, schema: T.StructType, corrupt: Column) -> Column:
    """Why a message in doubt is rejected (null: it is good), from its value parsed as VARIANT."""
    value = F.col("value")
    payload = F.try_variant_get(p, "$.payload", "variant")
    body = F.coalesce(payload, p)
    mism, known = [], F.lit(False)
    for f in schema.fields:
        raw = F.try_variant_get(body, f"$.{f.name}", "variant")
        known = known | raw.isNotNull()
        mism.append(F.when(raw.isNotNull() & ~F.is_variant_null(raw)
                           & F.try_variant_get(body, f"$.{f.name}", f.dataType.simpleString()).isNull(),
                           F.lit(f"type_mismatch:{f.name}")))
    rejected = (F.when(p.isNull(), "malformed_json")
                .when(~value.rlike(r"^\s*\{"), "not_an_object")
                .when(payload.isNotNull() & ~F.schema_of_variant(payload).startswith("OBJECT"), "not_an_object")
                .otherwise(F.coalesce(*mism, F.lit("corrupt_record"))))
    return (F.when(value.isNull() | ~value.rlike(r"\S"), "malformed_json").when(corrupt, rejected)
            .when(F.col("_j.payload").isNull() & payload.isNotNull(), "null_payload")
            .when(~known, "no_known_field"))


def split_dead_letters(decoded: DataFrame, schema: T.StructType, stored: bool = False) -> tuple[DataFrame, DataFrame]:
    """Good rows as rows of the table, rejected messages with their reason. The rows of each side
    are taken by an explode: a filter would be pushed below the parse and repeat it for every
    reference to its result. Where the decoded rows are a ``stored`` table there is no parse, and a
    filter is pushed to the scan."""
    def side(wanted: Column, *cols: Column) -> DataFrame:
        if stored:
            return decoded.filter(wanted).select(*cols)
        return decoded.select(F.explode(F.when(wanted, F.array(F.struct(*cols)))).alias("r")).select("r.*")

    rescued = [F.col(c) for c in decoded.columns if c == RESCUED]
    good = side(F.col("error_msg").isNull(), F.regexp_replace("topic", r"^pg\.", "").alias("table_name"),
                *[F.col(f.name) for f in schema.fields], *rescued)
    bad = side(F.col("error_msg").isNotNull(), F.col("message_key"), F.col("value"), F.col("error_msg"),
               F.col("topic").alias("original_topic"))
    return good, bad


def normalise(df: DataFrame) -> DataFrame:
    """Types safe for a schema-inferring writer: decimals to double, nested
    values to JSON text, times to ISO text (P8)."""
    out = []
    for f in df.schema.fields:
        c, t = F.col(f.name), f.dataType
        if isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, (T.StructType, T.MapType, T.ArrayType)):
            c = F.to_json(c, {"ignoreNullFields": "false"})
        elif isinstance(t, T.TimestampNTZType):
            c = F.date_format(c, ISO_NTZ)
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        out.append(c.alias(f.name))
    return df.select(*out)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto ``schema``: missing columns become typed NULLs, extra
    columns are dropped (P9)."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name).cast(f.dataType) if f.name in have
                        else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def union_aligned(parts: Sequence[DataFrame], schema: T.StructType) -> DataFrame:
    return union([align(p, schema) for p in parts])


def insert_ignore(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
                  order: Sequence[Column]) -> DataFrame:
    """Append only rows whose key is new; within ``incoming`` the first row
    under ``order`` wins (K8). Existing rows are never changed."""
    w = Window.partitionBy(*keys).orderBy(*order)
    first = incoming.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    fresh = first.join(existing.select(*keys), list(keys), "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def latest_state(log: DataFrame) -> DataFrame:
    """Fold a state changelog ``(key, status, offset)`` to the completed set (A8):
    ``completed`` adds a key, ``reset`` removes it, any other status changes
    nothing. ``max_by`` is a partial aggregate: one row per key per task."""
    return (log.filter(F.col("status").isin("completed", "reset")).groupBy("key").agg(F.max_by("status", "offset").alias("status"),
                                   F.max("offset").alias("offset"))
               .filter(F.col("status") == "completed").select(F.col("key").alias("table_name"), "offset"))
