"""Keeping stored tables up to date: full, append, merge, interval, snapshot.

A stored table is Parquet folders plus commit records. A change writes new folders
next to the old ones and then one small record, which names every folder of the
table; renaming the record into place is the commit. Readers take the newest record,
so they never see half a change, and a job that is lost before the rename leaves
the table as it was. Two writers cannot take the same number: the later one fails.

* Without ``day_of`` the table is one unit: a merge rewrites the rows it keeps.
* With ``day_of`` every date of that timestamp has folders of its own, and a change
  rewrites only the dates it touches. ``period`` takes months or years as units
  instead; a date below is the first day of such a unit. This is the layout for large
  tables; lists on the driver have the length of the number of units, never of rows.

The record also holds, for each folder, the range of the keys in it, by which a
merge finds the dates that can hold a key, and the last batch of each writer, by
which a repeated batch is skipped.
"""

from __future__ import annotations

import json
import uuid
from datetime import date, datetime, timedelta
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.operators.quality import schema_unchanged
from meterline.session import as_timestamps

STRATEGIES = ("view", "table", "append", "merge", "delete+insert", "time_interval")
DAY = "_day"
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(hadoop_path)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, folder = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


# commit records

def _versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, oldest first."""
    return [int(n[:-5]) for n in _names(spark, f"{path}/_commits") if n.endswith(".json") and not n.startswith(".")]


def _record_path(path: str, version: int) -> str:
    return f"{path}/_commits/{version:08d}.json"


def _record(spark: SparkSession, path: str, version: int) -> dict:
    fs, file = _fs(spark, _record_path(path, version))
    stream = fs.open(file)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _latest(spark: SparkSession, path: str) -> dict | None:
    versions = _versions(spark, path)
    return _record(spark, path, versions[-1]) | {"version": versions[-1]} if versions else None


def _commit(spark: SparkSession, path: str, before: dict | None, record: dict) -> None:
    """Make ``record`` the newest, unless another writer has followed ``before`` meanwhile."""
    version = (before["version"] if before else 0) + 1
    fs, unfinished = _fs(spark, f"{path}/_commits/.{uuid.uuid4().hex}")
    out = fs.create(unfinished)
    out.write(bytearray(json.dumps({k: v for k, v in record.items() if k != "version"}).encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    never_over = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        (hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
         .rename(unfinished, _fs(spark, _record_path(path, version))[1], never_over))
    except Py4JJavaError as error:
        fs.delete(unfinished, False)
        if "FileAlreadyExists" not in str(error.java_exception):
            raise
        raise RuntimeError(f"another writer committed version {version} of {path}; run the load again") from error


def _read(spark: SparkSession, path: str, record: dict, folders: list[dict]) -> DataFrame:
    schema = T.StructType.fromJson(record["schema"])
    if not folders:
        return as_timestamps(spark.createDataFrame([], schema))
    return as_timestamps(spark.read.schema(schema).parquet(*[f"{path}/{f['path']}" for f in folders]))


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table as of its last committed change, or None before the first."""
    record = _latest(spark, path)
    return None if record is None else _read(spark, path, record, record["folders"])


def committed(spark: SparkSession, path: str, writer: str) -> int | None:
    """The last batch of a writer that is in the table."""
    record = _latest(spark, path)
    return None if record is None else record["writers"].get(writer)


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete all but the newest records and the folders only the deleted ones name.

    Frames that still read an older version fail from then on.
    """
    versions = _versions(spark, path)
    kept, dropped = versions[-max(1, keep):], versions[:-max(1, keep)]
    paths = lambda vs: {f["path"] for v in vs for f in _record(spark, path, v)["folders"]}
    for folder in paths(dropped) - paths(kept):
        fs, at = _fs(spark, f"{path}/{folder}")
        fs.delete(at, True)
    for v in dropped:
        fs, at = _fs(spark, _record_path(path, v))
        fs.delete(at, False)


# folders

PERIODS = ("day", "month", "year")


def _date_of(day_of: str, period: str) -> Column:
    return F.to_date(day_of) if period == "day" else F.to_date(F.trunc(F.to_date(day_of), period))


def _next_date(first: datetime, period: str) -> datetime:
    if period == "day":
        return first + timedelta(days=1)
    return (first + timedelta(days=31)).replace(day=1) if period == "month" else first.replace(year=first.year + 1)


def _store(df: DataFrame, path: str, day_of: str | None, period: str = "day", part: str | None = None) -> list[dict]:
    """Write rows to new folders, one per date with ``day_of``; nobody reads them before the commit."""
    spark, name = df.sparkSession, f"data/{uuid.uuid4().hex}"
    if day_of is None:
        df.write.parquet(f"{path}/{name}")
        return [{"path": name, "day": None, "part": part}]
    dated = df.withColumn(DAY, _date_of(day_of, period))
    dated.hint("rebalance", F.col(DAY)).write.partitionBy(DAY).parquet(f"{path}/{name}")
    found = [n for n in _names(spark, f"{path}/{name}") if n.startswith(f"{DAY}=")]
    value = lambda n: None if n.endswith(_NO_DAY) else n.partition("=")[2]
    return [{"path": f"{name}/{n}", "day": value(n), "part": part} for n in found]


_RANGED = (T.IntegralType, T.StringType, T.DateType, T.TimestampType)


def _add_key_ranges(df: DataFrame, folders: list[dict], keys: list[str], day_of: str | None, period: str = "day") -> None:
    """Note smallest and largest key of each folder, and whether a key is null there."""
    wanted = [k for k in keys if isinstance(df.schema[k].dataType, _RANGED)]
    if not wanted:
        return
    plain = lambda k: F.date_format(k, "yyyy-MM-dd HH:mm:ss.SSSSSS") if isinstance(df.schema[k].dataType, (T.DateType, T.TimestampType)) else F.col(k)
    ranges = [F.struct(F.min(plain(k)).alias("low"), F.max(plain(k)).alias("high"), F.count_if(F.col(k).isNull()).alias("nulls")).alias(k)
              for k in wanted]
    day = _date_of(day_of, period).cast("string") if day_of else F.lit(None).cast("string")
    by_day = {r[DAY]: r for r in df.groupBy(day.alias(DAY)).agg(*ranges).collect()}
    for f in folders:
        if f["day"] in by_day:
            f["keys"] = {k: [by_day[f["day"]][k]["low"], by_day[f["day"]][k]["high"], by_day[f["day"]][k]["nulls"] > 0] for k in wanted}


def _may_share_keys(left: dict, right: dict, keys: list[str]) -> bool:
    """Whether a key can be in both folders, as far as their noted ranges tell."""
    def overlap(a, b) -> bool:
        if a is None or b is None:
            return True
        return (a[2] and b[2]) or (a[0] is not None and b[0] is not None and a[0] <= b[1] and b[0] <= a[1])
    return all(overlap(left.get("keys", {}).get(k), right.get("keys", {}).get(k)) for k in keys)


def _wider(entries: list[dict]) -> dict:
    """Key ranges that cover those of all entries, for the keys noted in each."""
    noted = [e.get("keys", {}) for e in entries]
    out = {}
    for k in set(noted[0]).intersection(*noted[1:]) if noted else ():
        lows, highs = ([n[k][i] for n in noted if n[k][i] is not None] for i in (0, 1))
        out[k] = [min(lows, default=None), max(highs, default=None), any(n[k][2] for n in noted)]
    return out


def _store_kept(kept: DataFrame, path: str, record: dict, old: list[dict]) -> list[dict]:
    """Write what stays of the rewritten folders; their key ranges still hold for a part of them."""
    out = _store(kept, path, record["day_of"], record["period"])
    for f in out:
        f["keys"] = _wider([o for o in old if o["day"] == f["day"]])
    return out


# strategies

def _refuse_shared_keys(df: DataFrame, keys: list[str]) -> None:
    """Keys meet by a hash of 8 bytes; whole keys are compared only among rows whose hash came twice."""
    hashed = df.select(F.xxhash64(*keys).alias("_h"), *keys)
    often = hashed.groupBy("_h").agg(F.count("*").alias("_n")).where("_n > 1").select("_h")
    if not often.take(1):
        return
    if hashed.join(often, "_h", "left_semi").groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").take(1):
        raise ValueError(f"rows to store share a key ({', '.join(keys)})")


def _same_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Semi or anti join in which null keys match, so that a re-run replaces them too."""
    side = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return left.join(side, on, how)


def _moment(value) -> datetime:
    return datetime.fromisoformat(str(value))


def _inside(time_column: str, start, end) -> Column:
    at = F.col(time_column)
    return F.coalesce((at >= F.lit(start).cast("timestamp")) & (at < F.lit(end).cast("timestamp")), F.lit(False))


def _without_interval(spark: SparkSession, path: str, record: dict, time_column: str, start, end) -> list[dict]:
    """The folders of the table without the rows in [start, end).

    Dates wholly inside go unread, dates wholly outside stay as they are.
    """
    def lies(f: dict) -> str:
        if record["day_of"] != time_column:
            return "across"
        if f["day"] is None:
            return "outside"
        first = datetime.combine(date.fromisoformat(f["day"]), datetime.min.time())
        last = _next_date(first, record["period"])
        if first >= _moment(end) or last <= _moment(start):
            return "outside"
        return "inside" if first >= _moment(start) and last <= _moment(end) else "across"
    where = {f["path"]: lies(f) for f in record["folders"]}
    across = [f for f in record["folders"] if where[f["path"]] == "across"]
    kept = _read(spark, path, record, across).filter(~_inside(time_column, start, end))
    return ([f for f in record["folders"] if where[f["path"]] == "outside"]
            + (_store_kept(kept, path, record, across) if across else []))


def days_of_keys(spark: SparkSession, path: str, record: dict, fresh: list[dict], keys: list[str]) -> DataFrame | None:
    """The dates without new rows on which stored rows have a key of the ``fresh`` folders.

    Only folders whose key range meets that of a fresh folder are read; None if there are none.
    """
    new_days = {f["day"] for f in fresh}
    possible = [f for f in record["folders"] if f["day"] not in new_days and any(_may_share_keys(f, g, keys) for g in fresh)]
    if not possible:
        return None
    stored = _read(spark, path, record, possible).select(_date_of(record["day_of"], record["period"]).alias(DAY), *keys)
    return _same_keys(stored, _read(spark, path, record, fresh), keys, "left_semi").select(DAY).distinct()


def _without_keys(spark: SparkSession, path: str, record: dict, fresh: list[dict], keys: list[str], day_in_key: bool) -> list[dict]:
    """The folders of the table without the rows whose key is in the fresh folders."""
    touched = {f["day"] for f in fresh}
    # A key that holds the timestamp cannot have rows on other dates.
    if record["day_of"] is not None and record["day_of"] not in keys and not day_in_key:
        elsewhere = days_of_keys(spark, path, record, fresh, keys)
        touched |= {r[0] and r[0].isoformat() for r in elsewhere.collect()} if elsewhere is not None else set()
    old = [f for f in record["folders"] if f["day"] in touched]
    if not old:
        return record["folders"]
    kept = _same_keys(_read(spark, path, record, old), _read(spark, path, record, fresh), keys, "left_anti")
    return [f for f in record["folders"] if f["day"] not in touched] + _store_kept(kept, path, record, old)


def materialize(df: DataFrame, target: str, strategy: str = "table", keys: list[str] | None = None,
                time_column: str | None = None, start=None, end=None, full_refresh: bool = False,
                day_of: str | None = None, period: str = "day", day_in_key: bool = False, batch: tuple[str, int] | None = None) -> bool:
    """Bring the table at ``target`` up to date with ``df``; False if nothing was to do.

    ``merge`` and ``delete+insert`` replace all rows of the keys in ``df``; for
    ``merge`` a key may occur once in ``df``, else nothing is stored;
    ``time_interval`` replaces the rows in ``[start, end)``. ``full_refresh``
    rebuilds whatever the strategy. For ``view`` the target is a view name.
    ``day_of`` names the timestamp whose date partitions the table, by day, month or
    year; both must stay the same for all loads; ``day_in_key`` says that a key never moves to another date.
    ``batch`` is a writer's name and a number that rises with its loads: a load whose
    number the table already has is skipped, so a retried one does no harm. ``keys``
    given when the table is built lets the first merge find its dates.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}")
    if period not in PERIODS:
        raise ValueError(f"unknown period {period!r}")
    if strategy == "view":
        df.createOrReplaceTempView(target)
        return True
    if strategy in ("merge", "delete+insert") and not keys:
        raise ValueError(f"{strategy} needs keys")
    spark = df.sparkSession
    before = _latest(spark, target)
    if batch and before and before["writers"].get(batch[0], batch[1] - 1) >= batch[1]:
        return False
    rebuild = strategy == "table" or full_refresh or before is None
    if not rebuild:
        schema_unchanged(_read(spark, target, before, []), df)
        if (before["day_of"], before["period"]) != (day_of, period):
            raise ValueError(f"the table is stored by {before['period']} of {before['day_of']!r}, not by {period} of {day_of!r}")
    record = {"schema": df.schema.jsonValue(), "day_of": day_of, "period": period,
              "writers": (before["writers"] if before else {}) | ({batch[0]: batch[1]} if batch else {})}
    fresh = _store(df, target, day_of, period)  # the rows are computed once; the rest reads what was stored
    incoming = _read(spark, target, record, fresh)
    if strategy == "merge":
        _refuse_shared_keys(incoming, keys)
    if keys:
        _add_key_ranges(incoming, fresh, keys, day_of, period)
    if rebuild:
        stay = []
    elif strategy == "append":
        stay = before["folders"]
    elif strategy == "time_interval":
        stay = _without_interval(spark, target, before, time_column, start, end)
    else:
        stay = _without_keys(spark, target, before, fresh, keys, day_in_key)
    _commit(spark, target, before, record | {"folders": stay + fresh})
    return True


def high_water(spark: SparkSession, target: str, time_column: str, lookback: str | None = None):
    """Largest stored time, fetched as a value so that the filter reaches the scan.

    Of a table stored by that time only the newest date is read.
    """
    record = _latest(spark, target)
    if record is None:
        return None
    folders = record["folders"]
    if record["day_of"] == time_column:
        newest_day = max((f["day"] for f in folders if f["day"] is not None), default=None)
        folders = [f for f in folders if f["day"] == newest_day]
    newest = F.max(time_column)
    return _read(spark, target, record, folders).agg(newest - F.expr(f"interval {lookback}") if lookback else newest).first()[0]


def incremental_filter(df: DataFrame, target: str, time_column: str, lookback: str | None = None) -> DataFrame:
    """Rows strictly newer than the stored maximum. Equal or older rows stay out unless
    ``lookback`` moves the bound back."""
    bound = high_water(df.sparkSession, target, time_column, lookback)
    return df if bound is None else df.filter(F.col(time_column) > F.lit(bound))


def snapshot(df: DataFrame, target: str, keys: list[str], columns: list[str], as_of) -> None:
    """Keep the history of rows: ``valid_from`` and ``valid_to`` per version of a key.

    A changed or vanished row is closed at ``as_of``; its new form opens then. A key
    may occur once in ``df``. Closed rows are stored apart from open ones and never
    written again: a snapshot reads and writes the open rows and adds those it closes.
    """
    spark = df.sparkSession
    now = F.lit(as_of).cast("timestamp")
    before = _latest(spark, target)
    fresh = df.select(*keys, *columns)
    _refuse_shared_keys(fresh, keys)
    opened = lambda rows: rows.withColumns({"valid_from": now, "valid_to": F.lit(None).cast("timestamp")})
    record = {"schema": opened(fresh).schema.jsonValue(), "day_of": None, "period": "day", "writers": {}}
    if before is None:
        _commit(spark, target, None, record | {"folders": _store(opened(fresh), target, None, part="open")})
        return
    schema_unchanged(_read(spark, target, before, []), opened(fresh))
    closed = [f for f in before["folders"] if f["part"] == "closed"]
    live = _read(spark, target, before, [f for f in before["folders"] if f["part"] == "open"])
    new_side = fresh.select(*[F.col(k).alias(f"_n_{k}") for k in keys],
                            F.struct(*columns).alias("_new"), F.lit(True).alias("_there"))
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_n_{k}")) for k in keys])
    stays = F.coalesce(F.col("_there"), F.lit(False)) & F.struct(*columns).eqNullSafe(F.col("_new"))
    compared = live.join(new_side, on, "left").withColumn("_stays", stays)
    unchanged = compared.filter("_stays").select(*live.columns)
    closing = compared.filter("NOT _stays").withColumn("valid_to", now).select(*live.columns)
    old_side = live.select(*[F.col(k).alias(f"_o_{k}") for k in keys], F.struct(*columns).alias("_old"))
    same = [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys] + [F.struct(*columns).eqNullSafe(F.col("_old"))]
    added = opened(fresh.join(old_side, reduce(lambda a, b: a & b, same), "left_anti"))
    folders = closed + _store(unchanged.unionByName(added), target, None, part="open")
    if not closing.isEmpty():
        folders += _store(closing, target, None, part="closed")
    _commit(spark, target, before, record | {"folders": folders})
