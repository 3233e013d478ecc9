"""Change rows to current state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.operators.quality import dead_letters

CHANGE_ORDER = ("ts_ms", "seq")
# Of one key's changes in its partition of the log.
LOG_ORDER = ("seq",)
_MARKS = ("op", "__deleted")
# The marks of a flattened change row and its operations (create, update, delete, snapshot read).
_CAPTURED = "__op string, __ts_ms bigint, __deleted string"
_OPS = ("c", "u", "d", "r")
_CORRUPT = "_corrupt"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order``.

    Spark turns the rank filter into a per-partition group limit ahead of the shuffle, so
    each map task sends at most one row of a key, however many changes it holds.
    """
    newest = Window.partitionBy(*keys).orderBy(*(F.col(name).desc() for name in order))
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def is_delete(df: DataFrame) -> Column:
    """A delete is marked by its operation, by the rewrite flag, or is a tombstone (no value)."""
    op = F.col("op")
    deleted = op.isNull() | (op == "d")
    if "__deleted" in df.columns:
        deleted = deleted | F.coalesce(F.col("__deleted") == "true", F.lit(False))
    return deleted


def current_state(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str] = CHANGE_ORDER
) -> DataFrame:
    """Current rows of a captured table: the latest change per key, deletes removed."""
    latest = latest_per_key(changes, keys, order)
    return latest.where(~is_delete(latest)).drop(*_MARKS)


def split_changes(
    rows: DataFrame, table: str, keys: Sequence[str], *, topic: str, failed_at: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(changes, dead letters) from a capture topic's key, value, partition and offset.

    Where both are used, persist :func:`check_changes` and split that with :func:`split_checked`: values are then
    parsed once.
    """
    return split_checked(check_changes(rows, table, keys), topic=topic, failed_at=failed_at)


def check_changes(rows: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Rows of a capture topic that hold a value, with the change it holds and what is wrong with it, if anything.

    Values are flattened JSON rows with ``__op``, ``__ts_ms`` and ``__deleted``; decimals and times may be
    text. A change has the columns of ``table`` (DDL) plus op, ts_ms, ``__deleted``, log_partition and seq, the
    offset. A tombstone, a null value, adds nothing after the rewritten delete it follows. A value that is no
    JSON object, has a field of another type, no known operation or no key goes to the letters with its original bytes.
    """
    text = F.col("value").cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    inside = F.concat(F.lit('{"body":'), text, F.lit("}"))
    read = F.from_json(inside, f"body struct<{table}, {_CAPTURED}>, {_CORRUPT} string", options)
    held = rows.where("value is not null").withColumn("_read", read)
    # Parsers stop at the end of a value: one object alone is one both inside an array and inside an object. The strict
    # parser also knows keys that come twice.
    listed = F.concat(F.lit("["), text, F.lit("]"))
    sound = (
        F.col(f"_read.{_CORRUPT}").isNull() & F.col("_read.body").isNotNull() & F.try_parse_json(listed).isNotNull()
    )
    # Only of values that aren't sound: whether they are objects at least.
    kind = F.schema_of_variant(F.try_parse_json(inside))
    whole = (F.json_array_length(listed) == 1) & F.startswith(kind, F.lit("OBJECT<body: OBJECT"))
    unsound = F.when(F.coalesce(whole, F.lit(False)), "value: a field of another type").otherwise(
        "value: not a JSON object"
    )
    op = F.col("_read.body.__op")
    reason = (
        F.when(~sound, unsound)
        .when(op.isNull(), "__op: missing")
        .when(~op.isin(*_OPS), "__op: unknown")
    )
    for key in keys:
        reason = F.coalesce(reason, F.when(F.col(f"_read.body.{key}").isNull(), f"{key}: missing"))
    return held.select("*", F.inline(F.array(F.struct(reason.alias("failure_reason")))))


def split_checked(
    checked: DataFrame, *, topic: str, failed_at: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(changes, dead letters) from the rows of :func:`check_changes`."""
    good = checked.where("failure_reason is null").select(
        "_read.body.*", F.col("partition").alias("log_partition"), F.col("offset").alias("seq")
    )
    good = good.withColumnsRenamed({"__op": "op", "__ts_ms": "ts_ms"})
    bad = checked.where("failure_reason is not null").drop("_read")
    return good, dead_letters(bad, topic, stage="deserialize", failed_at=failed_at)


def topic_changes(rows: DataFrame, table: str) -> DataFrame:
    """Change rows from a capture topic's key, value and offset: columns of ``table`` (DDL) plus op,
    ts_ms, seq and ``__deleted``.

    For topics that hold change rows only: a value without marks stops the job, where :func:`split_changes`
    puts it aside. The offset orders changes (``current_state(..., order=("seq",))``) of one partition.
    """
    body = F.from_json(F.col("value").cast("string"), f"{table}, {_CAPTURED}", {"mode": "PERMISSIVE"})
    read = rows.where("value is not null").select(body.alias("body"), F.col("offset").alias("seq"))
    read = read.select("body.*", "seq")
    missing = F.raise_error(F.concat(F.lit("no change marks at offset "), F.col("seq").cast("string")))
    op = F.when(F.col("__op").isNull(), missing.cast("string")).otherwise(F.col("__op"))
    return read.withColumn("op", op).withColumnRenamed("__ts_ms", "ts_ms").drop("__op")


def moved_keys(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose changes lie in several partitions of their log, with the first and last of them."""
    spans = changes.groupBy(*keys).agg(
        F.min("log_partition").alias("first_partition"), F.max("log_partition").alias("last_partition")
    )
    return spans.where("first_partition < last_partition")


def log_state(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current rows of a captured table whose log has several partitions.

    Offsets order the changes of one partition only, so a key must stay in one: a key found in two stops the
    job (``moved_keys`` lists them). Both come from one aggregate, which runs ahead of the shuffle as well.
    """
    values = F.struct(*(name for name in changes.columns if name not in keys))
    latest = changes.groupBy(*keys).agg(
        F.max_by(values, "seq").alias("last"),
        F.min("log_partition").alias("first"),
        F.max("log_partition").alias("other"),
    )
    moved = F.concat(F.lit("in several log partitions: "), F.to_json(F.struct(*keys)))
    stays = F.when(F.col("first") == F.col("other"), True).otherwise(F.raise_error(moved).cast("boolean"))
    state = latest.where(stays).select(*keys, "last.*")
    return state.where(~is_delete(state)).drop(*_MARKS)
