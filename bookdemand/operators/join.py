"""T3: requests × rooms, many-to-one, with a size-checked join strategy.

Strategy is chosen from measured facts, not guesses:

* ``auto`` — one aggregate job over the *dimension* measures its rows, bytes
  and the largest group per key.  The dimension is broadcast only when those
  measured bytes fit the session's ``spark.sql.autoBroadcastJoinThreshold``;
  otherwise the join is a sort-merge join, where AQE's skew-join splits a hot
  key's partition at run time.
* ``broadcast`` / ``merge`` / ``shuffle_hash`` — forced, for studying plans.
* ``salted`` — explicit hot-key salting for the shuffle path: keys holding at
  least ``hot_key_rows`` fact rows are spread over ``salt_buckets`` sub-keys,
  and only those keys' dimension rows are replicated.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DecimalType, MapType, StringType, StructType, VariantType

from bookdemand import schemas as S
from bookdemand.session import MEASURED_BROADCAST_LIMIT, checkpoint_dir

# Room columns T3 adds, renamed so nothing clashes with request columns.
ROOM_VIEW = [
    (S.CODE, S.ROOM_CODE),
    (S.NAME, S.ROOM_NAME),
    (S.CAPACITY, S.CAPACITY),
    (S.STATE, S.ROOM_STATE),
    (S.ACTIVE, S.ROOM_ACTIVE),
]
STRATEGIES = ("auto", "broadcast", "merge", "shuffle_hash", "salted")
# Per-row overhead of a broadcast hash relation on top of the value bytes.
_ROW_OVERHEAD_BYTES = 32


@dataclass(frozen=True)
class DimensionProfile:
    rows: int
    null_keys: int
    max_rows_per_key: int
    value_bytes: int

    @property
    def broadcast_bytes(self) -> int:
        return self.value_bytes + self.rows * _ROW_OVERHEAD_BYTES


def _value_bytes(df: DataFrame) -> Column:
    parts = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)))
        elif isinstance(field.dataType, (ArrayType, MapType, StructType, VariantType)):
            # as JSON text: digits take at least the bytes of the number they write,
            # twice over for short ones in 8-byte slots
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(F.col(field.name)))) * 4, F.lit(0)))
        elif isinstance(field.dataType, DecimalType):
            parts.append(F.lit(24))
        else:
            parts.append(F.lit(8))
    return sum(parts[1:], parts[0]) if parts else F.lit(0)


def profile_dimension(dim: DataFrame, key: str, *, per_key: bool = True) -> DimensionProfile:
    """Rows, null keys, largest group per non-null key and value bytes.

    One job; the per-key count aggregates partially before its shuffle.
    ``per_key=False`` measures only rows, null keys and bytes with a global
    aggregate (one row per task reaches a single small exchange, no shuffle
    of the keys); the largest group is then unknown (-1).
    """
    if not per_key:
        row = dim.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count(F.when(F.col(key).isNull(), F.lit(1))).alias("null_keys"),
            F.coalesce(F.sum(_value_bytes(dim)), F.lit(0)).alias("bytes"),
        ).first()
        return DimensionProfile(int(row["rows"]), int(row["null_keys"]), -1, int(row["bytes"]))
    per_key = dim.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(_value_bytes(dim)).alias("b"))
    row = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
        F.coalesce(F.max(F.when(F.col(key).isNotNull(), F.col("n"))), F.lit(0)).alias("max_n"),
        F.coalesce(F.sum("b"), F.lit(0)).alias("bytes"),
    ).first()
    return DimensionProfile(int(row["rows"]), int(row["null_keys"]), int(row["max_n"]), int(row["bytes"]))


_PROFILES: OrderedDict[tuple, DimensionProfile] = OrderedDict()
_PROFILES_KEEP = 64  # most recently measured dimensions kept


def _file_states(spark: SparkSession, files: Sequence[str]) -> tuple:
    """Name, length and modification time of each file, from the file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    states = []
    for name in sorted(files):
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        status = path.getFileSystem(conf).getFileStatus(path)
        states.append((name, status.getLen(), status.getModificationTime()))
    return tuple(states)


def forget_profiles() -> None:
    """Measure every dimension anew (for timings that should include it)."""
    _PROFILES.clear()


def cached_profile(dim: DataFrame, key: str, *, per_key: bool = True) -> DimensionProfile:
    """``profile_dimension`` measured once per immutable input.

    File-backed dimensions of few files are keyed by their plan's semantic
    hash and each input file's name, length and modification time, so a file
    rewritten in place is measured again; anything else — in-memory frames,
    streams, many files — is measured every time.  A per-key profile also
    answers a size-only request.
    """
    files = dim.inputFiles()
    if not files or len(files) > 100:
        return profile_dimension(dim, key, per_key=per_key)
    spark = dim.sparkSession
    base = (spark.sparkContext.applicationId, dim.semanticHash(), _file_states(spark, files), key)
    hit = _PROFILES.get(base + (True,)) or _PROFILES.get(base + (per_key,))
    if hit is None:
        hit = _PROFILES[base + (per_key,)] = profile_dimension(dim, key, per_key=per_key)
        while len(_PROFILES) > _PROFILES_KEEP:
            _PROFILES.popitem(last=False)
    return hit


def check_many_to_one(dim: DataFrame, key: str) -> DimensionProfile:
    """J-2: raise if any non-null key appears more than once in ``dim``."""
    profile = cached_profile(dim, key)
    if profile.max_rows_per_key > 1:
        raise ValueError(
            f"many-to-one contract broken: a '{key}' value appears {profile.max_rows_per_key} times"
        )
    return profile


def _bytes(raw: str) -> int:
    raw = raw.strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if raw.endswith(suffix):
            return int(float(raw[: -len(suffix)]) * units[suffix])
    return int(raw)


def broadcast_limit(spark: SparkSession) -> int:
    """Largest *measured* dimension the library broadcasts, in bytes.

    The adaptive threshold (which AQE also applies to measured shuffle
    output) is used; -1 disables broadcasting.  The planning-time
    ``autoBroadcastJoinThreshold`` is deliberately not consulted: the library
    session turns it off because it acts on estimates.
    """
    raw = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    return _bytes(raw) if raw else MEASURED_BROADCAST_LIMIT


def resolve_strategy(spark: SparkSession, strategy: str, profile: DimensionProfile | None,
                     max_broadcast_bytes: int | None = None) -> str:
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown join strategy {strategy!r}; choose one of {STRATEGIES}")
    if strategy != "auto":
        return strategy
    limit = broadcast_limit(spark) if max_broadcast_bytes is None else max_broadcast_bytes
    if profile is not None and 0 <= profile.broadcast_bytes <= limit:
        return "broadcast"
    return "merge"


def salted_join(fact: DataFrame, dim: DataFrame, key: str, *, salt_buckets: int = 16,
                hot_key_rows: int = 1_000_000) -> DataFrame:
    """Inner equi-join that splits hot keys over ``salt_buckets`` sub-keys.

    Hot keys are found with a partially aggregated count; their number is at
    most ``fact rows / hot_key_rows``.  Their list is broadcast when its
    measured bytes fit the session's limit, and joined by key otherwise (the
    salt then follows that join, and Spark splits its skewed partitions).  The salt is a hash of the whole fact row, so a retried task
    sends every row to the same sub-key again.
    """
    checkpoint_dir(fact.sparkSession)
    # one aggregation pass over the fact; the (small) hot-key set is kept in
    # the shared checkpoint folder so the join below does not recompute it
    hot = fact.groupBy(key).count().filter(F.col("count") >= F.lit(hot_key_rows)).select(key)
    hot = hot.checkpoint(eager=True)
    size = profile_dimension(hot, key, per_key=False)
    if size.rows == 0:
        return fact.join(dim.hint("merge"), on=key, how="inner")
    hot_flag = hot.withColumn("_hot", F.lit(True))
    fits = size.broadcast_bytes <= broadcast_limit(fact.sparkSession)
    hot_flag = F.broadcast(hot_flag) if fits else hot_flag.hint("merge")
    f = fact.join(hot_flag, on=key, how="left").withColumn(
        "_salt",
        F.when(F.col("_hot"), F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns]), F.lit(salt_buckets)))
        .otherwise(F.lit(0)),
    ).drop("_hot")
    d = dim.join(hot_flag, on=key, how="left").withColumn(
        "_salt",
        F.explode(
            F.when(F.col("_hot"), F.sequence(F.lit(0).cast("long"), F.lit(salt_buckets - 1).cast("long")))
            .otherwise(F.array(F.lit(0).cast("long")))
        ),
    ).drop("_hot")
    return f.join(d, on=[key, "_salt"], how="inner").drop("_salt")


_SLIM: OrderedDict[tuple, tuple[DataFrame, DataFrame]] = OrderedDict()
_SLIM_KEEP = 32  # most recently used dimensions kept


def _slim(dim: DataFrame, dim_key: str, fact_key: str, columns: tuple[tuple[str, str], ...]) -> DataFrame:
    """The dimension's join key and added columns, built once per ``dim``
    object (a plan, no data; DataFrames are immutable).  A small LRU, so a
    long-running driver does not keep every dimension it ever joined."""
    memo_key = (id(dim), dim_key, fact_key, columns)
    hit = _SLIM.get(memo_key)
    if hit is None or hit[0] is not dim:
        hit = (dim, dim.select(F.col(dim_key).alias(fact_key), *[F.col(src).alias(dst) for src, dst in columns]))
        _SLIM[memo_key] = hit
    _SLIM.move_to_end(memo_key)
    while len(_SLIM) > _SLIM_KEEP:
        _SLIM.popitem(last=False)
    return hit[1]


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    *,
    fact_key: str,
    dim_key: str,
    columns: Sequence[tuple[str, str]],
    strategy: str = "auto",
    validate: bool = True,
    max_broadcast_bytes: int | None = None,
    salt_buckets: int = 16,
    hot_key_rows: int = 1_000_000,
) -> DataFrame:
    """Inner N:1 equi-join adding ``columns`` (``(source, output name)``) of
    ``dim`` to every ``fact`` row whose ``fact_key`` equals ``dim_key``.

    ``validate`` runs the many-to-one check (J-2) — one aggregate over the
    dimension, which also measures it for the broadcast decision.  Output:
    the fact columns in their order, then the dimension columns (an explicit
    select, so the order never depends on the join form, X8).  Null keys
    never match (SQL semantics, X6).
    """
    S.require_columns(fact, (fact_key,), "join_dimension fact")
    S.require_columns(dim, [dim_key] + [src for src, _ in columns], "join_dimension dimension")
    slim = _slim(dim, dim_key, fact_key, tuple(columns))
    profile = None
    if validate:
        profile = check_many_to_one(slim, fact_key)
    elif strategy == "auto":
        # only the size decides the strategy: no per-key shuffle of the dimension
        profile = cached_profile(slim, fact_key, per_key=False)
    chosen = resolve_strategy(fact.sparkSession, strategy, profile, max_broadcast_bytes)
    if chosen == "salted":
        joined = salted_join(fact, slim, fact_key, salt_buckets=salt_buckets, hot_key_rows=hot_key_rows)
    else:
        right = F.broadcast(slim) if chosen == "broadcast" else slim.hint(chosen)
        joined = fact.join(right, on=fact_key, how="inner")
    return joined.select(*fact.columns, *[dst for _, dst in columns])


def join_rooms(
    requests: DataFrame,
    rooms: DataFrame,
    *,
    strategy: str = "auto",
    validate: bool = True,
    max_broadcast_bytes: int | None = None,
    salt_buckets: int = 16,
    hot_key_rows: int = 1_000_000,
) -> DataFrame:
    """T3: requests × rooms on ``room_id``, adding room code, name, capacity,
    state and active flag under names that cannot clash with request columns."""
    S.require_columns(requests, (S.ROOM_ID,), "join_rooms requests")
    S.require_columns(rooms, [S.ROOM_ID] + [src for src, _ in ROOM_VIEW], "join_rooms rooms")
    return join_dimension(
        requests, rooms, fact_key=S.ROOM_ID, dim_key=S.ROOM_ID, columns=ROOM_VIEW, strategy=strategy,
        validate=validate, max_broadcast_bytes=max_broadcast_bytes, salt_buckets=salt_buckets,
        hot_key_rows=hot_key_rows,
    )
