"""One sink mechanism for every upsert-style output (K2-K5, K7).

Parquet has no MERGE, so an upsert is written as a change log plus a latest
view:

* ``write_batch`` overwrites the folder ``batch_id=<id>`` of the log (the
  folder name is the partition column) -- a batch that is replayed after a
  failure replaces its own earlier attempt, so the sink is idempotent per batch
  id (exactly-once together with the query's checkpoint).
* ``latest`` folds the log: per key, the row with the greatest order key
  (``batch_id`` then an in-batch sequence).  ``max_by`` is a partial aggregate,
  so a key updated in a third of all rows is reduced map-side.
* ``compact`` / ``compact_totals`` fold the batches after the newest run into a run
  of level 0.  Runs are kept in levels: the ``FANOUT``-th run of a level is merged with the
  others of that level into one run of the next, in the same write.  A row is so
  rewritten once a level, a number of times that grows with the logarithm of the
  batches, and a reader folds at most ``FANOUT - 1`` runs a level.
* A snapshot's manifest names its runs: the batches each one holds, its level, its rows
  and the clusters of keys in it.  A manifest is published when its runs are complete;
  runs that no manifest names any more are deleted by ``expire``.
* Runs are clustered by a hash of one key (``monitor_id``) in a fixed number of folders;
  reads of one key (``of``) list and read one folder of the runs that have it, push the
  key down to the files, and skip row groups by Bloom filters on text keys.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BATCH = "batch_id"
MANIFEST, RUNS = "manifest", "runs"
CLUSTER, DAY, SPLIT = "key_cluster", "key_day", "key_split"
#: folders of a run; a folder has a file for every SPLIT_ROWS rows that are folded, MAX_SPLITS at most
CLUSTERS, SPLIT_ROWS, MAX_SPLITS = 16, 1_000_000, 64
#: runs of a level that become one of the next
FANOUT = 4
#: manifests whose runs are kept for readers that began before the newest one
KEPT_MANIFESTS = 2


def latest(log: DataFrame, keys: Sequence[str], order: Sequence[str],
           values: Sequence[str] | None = None) -> DataFrame:
    """Newest row per key.  Values are wrapped in one struct, so a newer null
    replaces an older value (the newest record wins as a whole)."""
    keys = list(keys)
    values = list(values) if values is not None else [c for c in log.columns if c not in keys]
    order = list(order)
    by = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    if len(values) == 1:
        # one value, one order column: fixed-width buffer -> hash aggregate
        return log.groupBy(*keys).agg(F.max_by(values[0], by).alias(values[0]))
    newest = F.max_by(F.struct(*values), by)
    return log.groupBy(*keys).agg(newest.alias("_v")).select(*keys, "_v.*")


def _fs(spark: SparkSession, path: str):
    """Hadoop's file system and path object of ``path`` (driver calls)."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def names(spark: SparkSession, path: str) -> list[str] | None:
    """Names in a folder, by one listing; None where it doesn't exist."""
    fs, root = _fs(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(root)] if fs.exists(root) else None


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def read_note(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None where there is none."""
    fs, at = _fs(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; fails where there is one."""
    fs, at = _fs(spark, path)
    local = fs.getScheme() == "file"
    if local:  # its create() asks and then creates, so that of two writers both could succeed
        fs.mkdirs(at.getParent())
        if not spark.sparkContext._jvm.java.io.File(at.toUri().getPath()).createNewFile():
            raise FileExistsError(f"{path} exists already")
    out = fs.create(at, local)
    out.write(bytearray(text.encode()))
    out.close()


def move_files(spark: SparkSession, source: str, target: str) -> None:
    """Move the data files of a finished folder into another one, each in one step."""
    fs, root = _fs(spark, target)
    fs.mkdirs(root)
    for name in names(spark, source) or ():
        if name.startswith("part-") and not fs.rename(_fs(spark, f"{source}/{name}")[1], _fs(spark, f"{target}/{name}")[1]):
            raise OSError(f"{source}/{name} could not be moved to {target}")
    delete(spark, source)


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def create(spark: SparkSession, path: str) -> None:
    """Make an empty sink, so that a sink without batches differs from a missing one."""
    fs, root = _fs(spark, path)
    fs.mkdirs(root)


def write_batch(df: DataFrame, path: str, batch_id: int, seq: str | None = None) -> None:
    """Write one micro-batch into the log as partition ``batch_id=<id>``.

    ``seq`` (optional) names a column that orders rows inside the batch (e.g.
    the topic offset); it is kept for :func:`latest`.
    """
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={int(batch_id)}")


def batches(spark: SparkSession, path: str) -> list[int]:
    """Ids of the batches in the log; raises where there is no log."""
    found = names(spark, path)
    if found is None:
        raise FileNotFoundError(f"no sink at {path}")
    return sorted(int(n.split("=", 1)[1]) for n in found if n.startswith(f"{BATCH}="))


def read_log(spark: SparkSession, path: str, after: int | None = None, upto: int | None = None,
             schema=None) -> DataFrame:
    """The batches in (``after``, ``upto``] (all by default); ``batch_id`` comes from the
    folder names.  Only those folders are listed and read.  With no batch there the result
    is empty, with ``schema`` (or that of the newest batch)."""
    ids = batches(spark, path)
    wanted = [i for i in ids if (after is None or i > after) and (upto is None or i <= upto)]
    if not wanted:
        if schema is None and not ids:
            raise FileNotFoundError(f"no batch in {path}")
        empty = schema if schema is not None else spark.read.parquet(f"{path}/{BATCH}={ids[-1]}").schema
        return spark.createDataFrame([], empty).withColumn(BATCH, F.lit(None).cast("bigint"))
    read = spark.read.option("basePath", path).parquet(*[f"{path}/{BATCH}={i}" for i in wanted])
    return read.withColumn(BATCH, F.col(BATCH).cast("bigint"))


@dataclass(frozen=True)
class Run:
    """The folded rows of the batches ``first`` to ``last``."""

    path: str
    first: int
    last: int
    level: int
    rows: int
    schema: str
    cluster_by: str | None = None
    clusters: list[int] | None = None
    day_of: str | None = None
    days: list[str] | None = None


def _manifests(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n) for n in names(spark, f"{root}/{MANIFEST}") or () if n.isdigit())


def _manifest(spark: SparkSession, root: str, number: int) -> list[Run] | None:
    """The runs of a manifest, oldest first; None where it isn't written to its end."""
    try:
        return [Run(**r) for r in json.loads(read_note(spark, f"{root}/{MANIFEST}/{number:012d}") or "")]
    except ValueError:
        return None


def runs(spark: SparkSession, root: str) -> list[Run]:
    """The runs of the newest complete manifest, oldest first."""
    for number in reversed(_manifests(spark, root)):
        found = _manifest(spark, root, number)
        if found is not None:
            return found
    return []


def latest_version(spark: SparkSession, root: str) -> int | None:
    """The last batch in the snapshot; None where nothing was compacted."""
    live = runs(spark, root)
    return live[-1].last if live else None


def expire(spark: SparkSession, path: str, snapshot: str, keep: int = 2) -> list[int]:
    """Delete the batch folders that the snapshot holds, but for the last ``keep`` of them (a
    reader that began before it may still read those), and the runs that none of the newest
    manifests names.  Returns the ids of the batches deleted."""
    version = latest_version(spark, snapshot)
    folded = [] if version is None else [i for i in batches(spark, path) if i <= version]
    gone = folded[:-keep] if keep else folded
    for i in gone:
        delete(spark, f"{path}/{BATCH}={i}")
    numbers = _manifests(spark, snapshot)
    named = {r.path for n in numbers[-KEPT_MANIFESTS:] for r in _manifest(spark, snapshot, n) or ()}
    for number in numbers[:-KEPT_MANIFESTS]:
        for run in _manifest(spark, snapshot, number) or ():
            if run.path not in named:
                delete(spark, f"{snapshot}/{run.path}")
        delete(spark, f"{snapshot}/{MANIFEST}/{number:012d}")
    return gone


def only(df: DataFrame, of: Mapping[str, object] | None) -> DataFrame:
    """The rows of given key values; the values take the columns' types, so that they reach the files."""
    for column, value in (of or {}).items():
        df = df.where(F.col(column) == F.lit(value).cast(df.schema[column].dataType))
    return df


def _read_run(spark: SparkSession, root: str, run: Run, of: Mapping[str, object] | None = None,
              since: str | None = None) -> DataFrame | None:
    """A run's rows; None where its clusters can't hold the key asked for.  ``since``: only days from
    that one on, of a run that is laid out by day.  Keys are columns of
    the files; only the cluster number, an integer, is a folder name, so no key changes its type."""
    schema = StructType.fromJson(json.loads(run.schema))
    for name, kind in ((CLUSTER, "integer"), (DAY, "date")):
        if name == CLUSTER and run.cluster_by is not None or name == DAY and run.day_of is not None:
            schema = schema.add(name, kind)
    df = spark.read.schema(schema).parquet(f"{root}/{run.path}")
    if since is not None and run.day_of is not None:
        df = df.where(F.col(DAY) >= F.lit(since).cast("date"))
    if run.cluster_by is not None and run.cluster_by in (of or {}):
        wanted = F.lit(of[run.cluster_by]).cast(df.schema[run.cluster_by].dataType)
        number = spark.sql("SELECT 1").select(cluster(wanted)).first()[0]  # a constant, no job
        if number not in run.clusters:
            return None
        df = df.where(F.col(CLUSTER) == number)
    return only(df, of).withColumn(BATCH, F.lit(run.last).cast("bigint"))


def _with_snapshot(spark: SparkSession, path: str, snapshot: str | None, upto: int | None = None,
                   of: Mapping[str, object] | None = None, since: str | None = None) -> DataFrame:
    """The log up to ``upto``, or the snapshot's runs plus only the batches after them; with
    ``of`` only the rows of those key values, with ``since`` only those days of the runs."""
    live = runs(spark, snapshot) if snapshot is not None else []
    if not live:
        return only(read_log(spark, path, upto=upto), of)
    schema = StructType.fromJson(json.loads(live[-1].schema))
    out = only(read_log(spark, path, after=live[-1].last, upto=upto, schema=schema), of)
    for run in live:
        folded = _read_run(spark, snapshot, run, of, since)
        if folded is not None:
            out = out.unionByName(folded.drop(CLUSTER, DAY), allowMissingColumns=True)
    return out


def newest(spark: SparkSession, path: str, keys: Sequence[str], values: Sequence[str], snapshot: str | None, hour: str, n: int,
           of: Mapping[str, object], additive: bool = True) -> DataFrame:
    """The view of one key (``of``), with at least its ``n`` newest hours: runs are read backwards by
    day, twice as many days each time, until the hours are found."""
    days = sorted({d for r in (runs(spark, snapshot) if snapshot is not None else []) for d in r.days or ()}, reverse=True)
    width = max(1, -(-n // 24) + 1)
    while True:
        since = days[width - 1] if width < len(days) else None
        log = _with_snapshot(spark, path, snapshot, of=of, since=since)
        view = _fold_totals(log, keys, values) if additive else _fold_latest(log, keys, ())
        if since is None:
            return view
        # days before ``since`` that only newer batches hold are not whole, those after it are
        whole = view.where(F.col(hour) >= F.lit(since).cast("date"))
        if whole.select(hour).distinct().limit(n).count() >= n:
            return whole
        width *= 2


def latest_view(spark: SparkSession, path: str, keys: Sequence[str], seq: Sequence[str] = (),
                snapshot: str | None = None, of: Mapping[str, object] | None = None) -> DataFrame:
    """Latest value per key from the log and its snapshot; ``of`` asks for some keys only."""
    log = _with_snapshot(spark, path, snapshot, of=of)
    return _fold_latest(log, keys, seq)


def _fold_latest(log: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    values = [c for c in log.columns if c not in keys]
    return latest(log, keys, [BATCH, *seq], values).drop(BATCH, *seq)


def totals_view(spark: SparkSession, path: str, keys: Sequence[str], values: Sequence[str],
                snapshot: str | None = None, upto: int | None = None, of: Mapping[str, object] | None = None) -> DataFrame:
    """Read side of an additive (delta) log: per key, the sum of every batch's
    delta (a run holds the sums of its batches); ``of`` asks for some keys only."""
    return _fold_totals(_with_snapshot(spark, path, snapshot, upto, of), keys, values)


def _fold_totals(log: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    return log.groupBy(*keys).agg(*[F.sum(v).cast("bigint").alias(v) for v in values])


def cluster(column: str | Column, clusters: int = CLUSTERS) -> Column:
    """The cluster a key's rows are stored in; filter on it to read one folder."""
    return F.pmod(F.xxhash64(column), F.lit(clusters)).cast("int")


def _laid_out(df: DataFrame, keys: Sequence[str], cluster_by: str, rows: int) -> DataFrame:
    """Rows dealt over the files of a run, with the numbers of their cluster and split.  CLUSTERS folders
    of a bounded number of files each, however many keys there are; the rows of one heavy cluster are
    spread over the splits, which grow with the ``rows``."""
    splits = min(max(1, -(-rows // SPLIT_ROWS)), MAX_SPLITS)
    numbered = df.withColumn(CLUSTER, cluster(cluster_by)).withColumn(SPLIT, F.pmod(F.xxhash64(*keys), F.lit(splits)))
    return numbered.repartition(CLUSTERS * splits, CLUSTER, SPLIT)


def _write_run(df: DataFrame, keys: Sequence[str], root: str, first: int, last: int, level: int,
               cluster_by: str | None, day_of: str | None = None) -> Run:
    """Write a run, of rows that are laid out where it has clusters, in the order of its keys.  Text keys
    get Bloom filters; ``day_of`` (with a cluster) lays a folder out by the days of a column."""
    writer, df = df.drop(BATCH, DAY, SPLIT), df.drop(BATCH, CLUSTER, DAY, SPLIT)
    path = f"{RUNS}/{first}-{last}-{uuid.uuid4().hex[:8]}"
    order = [cluster_by, *(k for k in keys if k != cluster_by)] if cluster_by else list(keys)
    if cluster_by is not None:
        if day_of is not None:
            writer = writer.withColumn(DAY, F.to_date(day_of))
        by = [CLUSTER] if day_of is None else [CLUSTER, DAY]
        writer = writer.sortWithinPartitions(*by, *order)
    out = writer.write.option("parquet.bloom.filter.adaptive.enabled", "true")
    for field in df.schema:
        if field.name in keys and field.dataType.typeName() == "string":
            out = out.option(f"parquet.bloom.filter.enabled#{field.name}", "true")
    (out if cluster_by is None else out.partitionBy(*by)).parquet(f"{root}/{path}")
    spark = df.sparkSession
    rows = spark.read.schema(df.schema).parquet(f"{root}/{path}").count()  # from the files' footers
    folders = None if cluster_by is None else sorted(int(n.split("=")[1]) for n in names(spark, f"{root}/{path}") if n.startswith(f"{CLUSTER}="))
    days = None
    if day_of is not None:
        found = {n.split("=")[1] for c in folders for n in names(spark, f"{root}/{path}/{CLUSTER}={c}") or () if n.startswith(f"{DAY}=")}
        days = sorted(d for d in found if d[:1].isdigit())
    return Run(path, first, last, level, rows, df.schema.json(), cluster_by, folders, day_of, days)


def _new_batches(spark: SparkSession, path: str, snapshot: str) -> tuple[list[Run], list[int]]:
    """The live runs, and the batches that none of them holds."""
    live = runs(spark, snapshot)
    return live, [i for i in batches(spark, path) if not live or i > live[-1].last]


def _compact(spark: SparkSession, path: str, snapshot: str, keys: Sequence[str], cluster_by: str | None,
             fold: Callable[[DataFrame, Sequence[str]], DataFrame], day_of: str | None = None, few: bool = False) -> int | None:
    """``few``: a key has a row a batch, so rows are laid out as they are and folded where they then lie, in
    one shuffle; else a key's many rows are folded first."""
    live, newer = _new_batches(spark, path, snapshot)
    if not newer:
        return live[-1].last if live else None
    level, merged = 0, []
    while sum(r.level == level for r in live) >= FANOUT - 1:  # with the new run, the level is full
        merged = [r for r in live if r.level == level] + merged
        live = [r for r in live if r.level != level]
        level += 1
    log = read_log(spark, path, after=newer[0] - 1, upto=newer[-1])
    for run in merged:
        log = log.unionByName(_read_run(spark, snapshot, run).drop(CLUSTER, DAY), allowMissingColumns=True)
    first = merged[0].first if merged else newer[0]
    if cluster_by is None:
        folded = fold(log, keys)
    else:
        rows = log.count()  # from the files' footers
        folded = (fold(_laid_out(log, keys, cluster_by, rows), [CLUSTER, SPLIT, *keys]) if few
                  else _laid_out(fold(log, keys), keys, cluster_by, rows))
    run = _write_run(folded, keys, snapshot, first, newer[-1], level, cluster_by, day_of)
    # published once the run is complete; of two writers one fails here and leaves no trace but its run
    number = max(_manifests(spark, snapshot), default=-1) + 1
    write_note(spark, f"{snapshot}/{MANIFEST}/{number:012d}", json.dumps([asdict(r) for r in [*live, run]]))
    return newer[-1]


def compact(spark: SparkSession, path: str, keys: Sequence[str], snapshot: str, seq: Sequence[str] = (),
            cluster_by: str | None = None, day_of: str | None = None) -> int | None:
    """Fold the batches after the snapshot into a run of it, newest row per key.  The last batch
    is fixed first; one that lands meanwhile is left for the next run.
    ``cluster_by`` (e.g. ``monitor_id``) lets point reads prune folders.
    Returns the last batch in the snapshot (None when it has none)."""
    return _compact(spark, path, snapshot, keys, cluster_by, lambda log, by: _fold_latest(log, by, seq), day_of)


def compact_totals(spark: SparkSession, path: str, keys: Sequence[str], values: Sequence[str],
                   snapshot: str, cluster_by: str | None = None, day_of: str | None = None) -> int | None:
    """Additive twin of :func:`compact`: a run holds the sums of its batches."""
    return _compact(spark, path, snapshot, keys, cluster_by, lambda log, by: _fold_totals(log, by, values), day_of, few=True)
