"""Order-dependent columns over long sequences.

A window over ``key`` sends all rows of one key to one task, so a single
sequence that holds a large share of the table would stop the job. These
helpers window over (key, chunk of positions) instead and carry the little that
crosses a chunk border separately. Positions count from 0 without gaps, as the
readers, the conversion and the session view number them; ``close_gaps``
establishes that for other input.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 4096


def _chunk_of(pos: str, chunk: int) -> Column:
    return F.expr(f"{pos} div {chunk}")


def keep_sequences(
    df: DataFrame, key: str, pos: str, kept: DataFrame, last_pos: str, chunk: int = CHUNK
) -> DataFrame:
    """Rows of the sequences listed in ``kept`` (one row per key, with the sequence's last position).

    The join is on key and chunk: the listed key is repeated once per chunk of its
    sequence, so a long sequence is filtered by many tasks. Gaps do no harm.
    """
    last = F.expr(f"cast({last_pos} div {chunk} as int)")
    wanted = kept.select(key, F.explode(F.sequence(F.lit(0), last)).alias("_chunk"))
    rows = df.withColumn("_chunk", _chunk_of(pos, chunk).cast("int"))
    return rows.join(wanted, [key, "_chunk"], "left_semi").drop("_chunk")


def close_gaps(df: DataFrame, key: str, pos: str, chunk: int = CHUNK) -> DataFrame:
    """Number the rows of each sequence from 0 without gaps, in the order they had.

    The helpers below rely on such positions; use this on input that may lack some.
    """
    parts = df.withColumn("_chunk", _chunk_of(pos, chunk))
    totals = parts.groupBy(key, "_chunk").agg(F.count("*").alias("_total"))
    before = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(key, "_chunk", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(key, "_chunk").orderBy(pos)
    number = F.row_number().over(inside) - 1 + F.col("_before")
    return parts.join(carried, [key, "_chunk"]).withColumn(pos, number.cast(df.schema[pos].dataType)).drop("_chunk", "_before")


def with_previous(
    df: DataFrame, key: str, pos: str, columns: dict[str, str], chunk: int = CHUNK
) -> DataFrame:
    """Add the previous row's value of each column, as {column: new name}."""
    return with_recent(df, key, pos, {old: [new] for old, new in columns.items()}, chunk)


def with_recent(
    df: DataFrame, key: str, pos: str, columns: dict[str, list[str]], chunk: int = CHUNK
) -> DataFrame:
    """Add the values that the rows before have, nearest first, as {column: new names}.

    The last rows of a chunk are sent to the next chunk as well, where they serve
    as predecessors and are then removed: one shuffle, few extra rows.
    """
    n = max(map(len, columns.values()))
    own = _chunk_of(pos, chunk)
    late = F.expr(f"{pos} % {chunk} >= {chunk - n}")
    targets = F.when(late, F.array(own, own + 1)).otherwise(F.array(own))
    spread = df.select("*", F.explode(targets).alias("_chunk"))
    order = Window.partitionBy(key, "_chunk").orderBy(pos)
    added = {new: F.lag(old, i).over(order) for old, names in columns.items() for i, new in enumerate(names, 1)}
    return spread.withColumns(added).where(F.col("_chunk") == own).drop("_chunk")


def with_next(df: DataFrame, key: str, pos: str, columns: dict[str, str], chunk: int = CHUNK) -> DataFrame:
    """Add the next row's value of each column, as {column: new name}; mirrors :func:`with_previous`."""
    own = _chunk_of(pos, chunk)
    first = F.expr(f"{pos} % {chunk} = 0")
    targets = F.when(first, F.array(own, own - 1)).otherwise(F.array(own))
    spread = df.select("*", F.explode(targets).alias("_chunk"))
    order = Window.partitionBy(key, "_chunk").orderBy(pos)
    added = {new: F.lead(old).over(order) for old, new in columns.items()}
    return spread.withColumns(added).where(F.col("_chunk") == own).drop("_chunk")


def _carried(totals: DataFrame, key: str, total: Column, name: str) -> DataFrame:
    """Per chunk after the first: what the chunks before it add up to."""
    before = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(key, "_chunk", total.over(before).alias(name)).where("_chunk > 0")


def with_running_total(
    df: DataFrame, key: str, pos: str, value: str, name: str, chunk: int = CHUNK
) -> DataFrame:
    """Add the sum of ``value`` from the start of the sequence up to this row."""
    parts = df.withColumn("_chunk", _chunk_of(pos, chunk))
    totals = parts.groupBy(key, "_chunk").agg(F.sum(value).alias("_total"))
    carried = _carried(totals, key, F.sum("_total"), "_before")
    upto = (
        Window.partitionBy(key, "_chunk").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        parts.join(carried, [key, "_chunk"], "left")
        .withColumn(name, F.sum(value).over(upto) + F.coalesce("_before", F.lit(0)))
        .drop("_chunk", "_before")
    )


def with_last_known(
    df: DataFrame, key: str, pos: str, value: str, name: str, chunk: int = CHUNK
) -> DataFrame:
    """Add the latest non-null ``value`` at or before this row."""
    parts = df.withColumn("_chunk", _chunk_of(pos, chunk))
    known = F.col(value).isNotNull()
    totals = parts.groupBy(key, "_chunk").agg(
        F.max_by(value, F.when(known, F.col(pos))).alias("_total")
    )
    carried = _carried(totals, key, F.last("_total", ignorenulls=True), "_before")
    upto = (
        Window.partitionBy(key, "_chunk").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        parts.join(carried, [key, "_chunk"], "left")
        .withColumn(name, F.coalesce(F.last(value, ignorenulls=True).over(upto), "_before"))
        .drop("_chunk", "_before")
    )


def _time_bucket(time_us: str, width_us: int) -> Column:
    return F.expr(f"({time_us} - pmod({time_us}, {width_us})) div {width_us}")


def with_sessions(
    events: DataFrame,
    user: str,
    time_us: str,
    tie: str,
    gap_us: int,
    width_us: int | None = None,
) -> DataFrame:
    """Number each user's sessions (``sess``, from 1) and their rows (``pos``, from 0).

    A session ends when the next event comes more than ``gap_us`` later. Events
    are cut into (user, time bucket) pieces no wider than the gap, so a session
    can only end between two pieces. That makes the per-piece summary (first
    time, last time, count) enough to find all session borders, and one user's
    events are spread over as many tasks as they have busy buckets. The default
    width of five minutes keeps the pieces of a user with billions of events small.
    """
    width_us = min(gap_us, 300_000_000) if width_us is None else width_us
    if width_us > gap_us:
        raise ValueError("a bucket wider than the gap could hide a session border")
    pieces = events.withColumn("_bucket", _time_bucket(time_us, width_us))
    by_user = Window.partitionBy(user).orderBy("_bucket")
    in_session = (
        Window.partitionBy(user, "sess")
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    silence = F.col("_first") - F.lag("_last").over(by_user)
    borders = (
        pieces.groupBy(user, "_bucket")
        .agg(
            F.min(time_us).alias("_first"),
            F.max(time_us).alias("_last"),
            F.count("*").alias("_n"),
        )
        .withColumn("_starts", F.coalesce((silence > gap_us).cast("bigint"), F.lit(1)))
        .withColumn("sess", F.sum("_starts").over(by_user))
        .withColumn("_before", F.coalesce(F.sum("_n").over(in_session), F.lit(0)))
        .select(F.col(user).alias("_user"), F.col("_bucket").alias("_piece"), "sess", "_before")
    )
    # Events without a user or a time are kept: null keys count as equal here.
    same = F.col(user).eqNullSafe(F.col("_user")) & F.col("_bucket").eqNullSafe(F.col("_piece"))
    inside = Window.partitionBy(user, "_bucket").orderBy(time_us, tie)
    return (
        pieces.join(borders, same)
        .withColumn("pos", (F.row_number().over(inside) - 1 + F.col("_before")).cast("int"))
        .drop("_bucket", "_before", "_user", "_piece")
    )
