"""Tables of a run that become visible together (K1, K2, K4-K7, S7), and keyed writes (K3).

A warehouse is a folder of tables. Each write of a table makes a new version folder; nothing
is overwritten. ``_commits/<n>.json`` names the version of every table, and of every bucket of
a keyed table; the file with the greatest number is the state of the warehouse. A run writes its
versions and then one such file, which is created only if it isn't there yet: readers see all
tables of the run or none, and of two runs that end together one is second and either builds
on the first or fails, if both wrote the same table.

Keyed tables are dealt to hash buckets of their key: ``<table>/file_version=<v>/key_bucket=<b>/run_id=<run>``.
An upsert rewrites the buckets that hold an incoming key and leaves the files of all others as
they are. Rows lie in a folder of the run that wrote them, so a run's rows are found by listing.
"""

from __future__ import annotations

import json
import os
import uuid
from urllib.parse import quote, urlparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

COMMITS, ATTEMPTS = "_commits", "_attempts"
VERSION, BUCKET = "file_version", "key_bucket"  # folder columns: no table may have them
BUCKETS = 32           # of a new keyed table, unless its writer says otherwise
BUCKET_ROWS = 50_000_000  # a table whose buckets grow beyond this gets twice as many at its next write


class CommitConflict(RuntimeError):
    """Another run has committed a table that this one also writes."""


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at  # noqa: SLF001


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def _read_text(spark: SparkSession, path: str) -> str:
    fs, at = _path(spark, path)
    stream = fs.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()  # noqa: SLF001
    finally:
        stream.close()


def create_exclusive(spark: SparkSession, path: str, text: str = "") -> bool:
    """Creates a file with its whole content, or returns False if it is there already. The content
    is written beside it and takes the name in one step that fails if the name is taken."""
    fs, target = _path(spark, path)
    fs.mkdirs(target.getParent())
    _, own = _path(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    stream = fs.create(own, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if fs.getUri().getScheme() == "file":  # a local rename would replace the file
            os.link(urlparse(own.toString()).path, urlparse(target.toString()).path)
        else:
            jvm = spark._jvm  # noqa: SLF001
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)  # noqa: SLF001
            none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(own, target, none)  # noqa: SLF001
    except FileExistsError:
        return False
    except Exception as exc:
        if "FileAlreadyExists" in str(exc):
            return False
        raise
    finally:
        fs.delete(own, False)
    return True


def claim_attempt(spark: SparkSession, root: str, run_id: str, after: int = 0) -> int:
    """The number of a new attempt of ``run_id``: one more than its last (and than ``after``), which no
    other caller gets, also not one that asks at the same time."""
    folder = f"{root.rstrip('/')}/{ATTEMPTS}/{quote(run_id, safe='')}"
    number = max([after, *(int(n) for n in _names(spark, folder) if n.isdigit())]) + 1
    while not create_exclusive(spark, f"{folder}/{number}"):
        number += 1
    return number


# ── state of a warehouse ────────────────────────────────────────────────────
def _commit_path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/{COMMITS}/{number:012d}.json"


def commit_numbers(spark: SparkSession, root: str) -> list[int]:
    names = _names(spark, f"{root.rstrip('/')}/{COMMITS}")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_commit(spark: SparkSession, root: str, number: int | None = None) -> dict:
    """``{"number", "run_id", "attempt", "changed", "tables"}``: a commit, the latest by default; number 0
    and no tables where there is none."""
    if number is None:
        number = max(commit_numbers(spark, root), default=0)
    if not number:
        return {"number": 0, "run_id": None, "attempt": None, "changed": [], "tables": {}}
    return json.loads(_read_text(spark, _commit_path(root, number)))


def _schema_with_folders(entry: dict) -> StructType:
    schema = StructType.fromJson(entry["schema"])
    extra = [StructField(VERSION, StringType())]
    if "n_buckets" in entry:
        extra.append(StructField(BUCKET, IntegerType()))
    return StructType([*schema.fields, *extra])


def _read_entry(spark: SparkSession, root: str, table: str, entry: dict, buckets: list[int] | None = None) -> DataFrame:
    schema = StructType.fromJson(entry["schema"])
    base = f"{root.rstrip('/')}/{table}"
    if "n_buckets" in entry:
        held = {int(b): v for b, v in entry["buckets"].items()}
        paths = [f"{base}/file_version={v}/key_bucket={b}" for b, v in sorted(held.items()) if buckets is None or b in buckets]
    else:
        paths = [f"{base}/file_version={entry['version']}" + (f"/{entry['folder']}" if entry.get("folder") else "")]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(_schema_with_folders(entry)).option("basePath", base).parquet(*paths).select(*schema.names)


def read_table(spark: SparkSession, root: str, table: str, number: int | None = None) -> DataFrame:
    """A table as of the latest commit, or of commit ``number``. A filter on ``run_id`` of a keyed
    table is answered by folders, without reading other runs' files."""
    tables = read_commit(spark, root, number)["tables"]
    if table not in tables:
        raise LookupError(f"{root} holds no table {table}")
    return _read_entry(spark, root, table, tables[table])


def bucket_of(keys: list[str], n_buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(n_buckets)).cast("int")


def matching(rows: DataFrame, wanted: DataFrame, keys: list[str], how: str = "left_semi") -> DataFrame:
    """``rows`` that agree with a row of ``wanted`` in ``keys``, nulls included (``left_anti``: that agree with none)."""
    other = wanted.select(*[F.col(k).alias(f"w_{k}") for k in keys])
    return rows.join(other, [F.col(k).eqNullSafe(F.col(f"w_{k}")) for k in keys], how)


class RunWrites:
    """What one run writes. Nothing of it is seen by others before ``publish``; ``read`` sees it at once."""

    def __init__(self, spark: SparkSession, root: str, run_id: str | None = None, attempt: int | None = None):
        self.spark, self.root, self.run_id, self.attempt = spark, root.rstrip("/"), run_id, attempt
        self.base = read_commit(spark, root)
        self.tables: dict[str, dict] = dict(self.base["tables"])
        self.changed: dict[str, int] = {}

    def read(self, table: str) -> DataFrame:
        if table not in self.tables:
            raise LookupError(f"{self.root} holds no table {table}")
        return _read_entry(self.spark, self.root, table, self.tables[table])

    def _write(self, df: DataFrame, table: str, partition_by: list[str], counts: dict) -> tuple[str, dict]:
        if {VERSION, BUCKET} & (set(df.columns) - set(partition_by)):
            raise ValueError(f"{table} has a column {VERSION} or {BUCKET}")
        version = uuid.uuid4().hex[:16]
        seen = Observation(f"rows_{version}")
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in counts.items()])
        df.write.mode("errorifexists").partitionBy(*partition_by).parquet(f"{self.root}/{table}/file_version={version}")
        return version, seen.get

    def replace(self, table: str, df: DataFrame, *, counts: dict | None = None) -> dict:
        """A plain table: its rows become those of ``df``. Returns ``rows`` and the ``counts`` (aggregates)
        of the written rows, from the same job."""
        version, seen = self._write(df, table, [], counts or {})
        self.tables[table] = {"version": version, "schema": json.loads(df.schema.json()), "rows": seen["rows"]}
        self.changed[table] = seen["rows"]
        return seen

    def land(self, table: str, df: DataFrame, schema: StructType, outcome: str, accepted: str, counts: dict) -> tuple[dict, DataFrame]:
        """A plain table from rows of several outcomes in one write: all rows go to folders
        ``<outcome>=<value>``, and those of ``accepted``, with the columns of ``schema``, are the table.
        Returns the ``counts`` of that job, and all written rows with their outcome."""
        version, seen = self._write(df, table, [outcome], counts)
        base = f"{self.root}/{table}"
        fs, at = _path(self.spark, f"{base}/file_version={version}/{outcome}={accepted}")
        fs.mkdirs(at)  # a folder without rows reads as an empty table
        self.tables[table] = {"version": version, "folder": f"{outcome}={accepted}", "schema": json.loads(schema.json()), "rows": seen["rows"]}
        self.changed[table] = seen["rows"]
        return seen, self.spark.read.schema(df.schema).parquet(f"{base}/file_version={version}").select(*df.columns)

    def held(self, table: str, wanted: DataFrame) -> DataFrame:
        """Rows of a keyed table that agree with a row of ``wanted`` in all its columns (nulls agree), which
        hold the columns that buckets are dealt by: other buckets are not read."""
        entry = self.tables[table]
        numbers = wanted.select(bucket_of(entry.get("deal", entry["keys"]), entry["n_buckets"]).alias("b")).distinct().collect()  # at most n_buckets
        return matching(_read_entry(self.spark, self.root, table, entry, [r.b for r in numbers]), wanted, wanted.columns)

    def replace_keyed(self, table: str, df: DataFrame, keys: list[str], n_buckets: int = BUCKETS, keep_if_empty: bool = False,
                      deal: list[str] | None = None) -> int:
        """A keyed table: its rows become those of ``df``, dealt to ``n_buckets`` by ``deal``, some of the
        keys (all by default). With ``keep_if_empty`` an empty ``df`` leaves a table that exists as it is."""
        before = self.tables.get(table)
        rows = self._put(table, df, keys, n_buckets, {}, deal or keys)
        if not rows and keep_if_empty and before:
            self.tables[table] = before
            del self.changed[table]
        return rows

    def _put(self, table: str, df: DataFrame, keys: list[str], n_buckets: int, kept: dict, deal: list[str]) -> int:
        """Writes ``df`` to buckets; ``kept``: buckets that stay as they are."""
        folders = [BUCKET, "run_id"] if "run_id" in df.columns else [BUCKET]
        dealt = df.withColumn(BUCKET, bucket_of(deal, n_buckets)).hint("rebalance", BUCKET)  # AQE sizes files, splits large buckets
        version, seen = self._write(dealt, table, folders, {})
        new = [int(n.split("=")[1]) for n in _names(self.spark, f"{self.root}/{table}/file_version={version}") if n.startswith(f"{BUCKET}=")]
        self.tables[table] = {"keys": keys, "deal": deal, "n_buckets": n_buckets, "buckets": {**kept, **{str(b): version for b in new}},
                              "schema": json.loads(df.schema.json()), "rows": seen["rows"]}
        self.changed[table] = seen["rows"]
        return seen["rows"]

    def upsert(self, table: str, df: DataFrame, keys: list[str], *, order: str | None = None, ignore: tuple[str, ...] = ("run_id", "enriched_at"),
               n_buckets: int = BUCKETS, deal: list[str] | None = None) -> int:
        """K3: rows of ``df`` replace the rows with their keys, others stay. Returns the rows that
        changed: a row that says the same as the one it would replace (but for the columns in
        ``ignore``) is not written, and only buckets with a changed key are written anew. Of rows of
        ``df`` with one key the one with the greatest ``order`` counts; without ``order`` they are an error. ``deal``: as for ``replace_keyed``, for a table that is not there yet."""
        from tidewater.sinks.warehouse import one_per_key
        from tidewater.staging import staged
        if table not in self.tables:
            names = [c for c in df.columns if c != order or c in keys]
            return self.replace_keyed(table, one_per_key(df, keys, order, names), keys, n_buckets, deal=deal)
        entry = self.tables[table]
        if entry.get("keys") != keys:
            raise ValueError(f"{table} is keyed by {entry.get('keys')}, not by {keys}")
        names = StructType.fromJson(entry["schema"]).names
        n_buckets, deal = entry["n_buckets"], entry.get("deal", keys)
        current = self.read(table)
        told = [c for c in names if c not in ignore and c not in keys]
        mine, theirs = F.struct(*told), F.col("is_now")
        same = [F.col(k).eqNullSafe(F.col(f"c_{k}")) for k in keys]
        was = current.select(*[F.col(k).alias(f"c_{k}") for k in keys], F.struct(*told).alias("is_now"))
        incoming = one_per_key(df, keys, order, names)
        changed = incoming.join(was, [*same, mine.eqNullSafe(theirs)], "left_anti") if told else incoming
        changed = staged(changed.withColumn(BUCKET, bucket_of(deal, n_buckets)), "upsert")
        touched = [r[0] for r in changed.select(BUCKET).distinct().collect()]  # at most n_buckets
        if not touched:
            self.changed.setdefault(table, 0)
            return 0
        grown = entry["rows"] > n_buckets * BUCKET_ROWS
        affected = current if grown else _read_entry(self.spark, self.root, table, entry, touched)
        new_keys = changed.select(*[F.col(k).alias(f"c_{k}") for k in keys])
        rest = affected.join(new_keys, same, "left_anti")
        rows = rest.unionByName(changed.select(*names))
        count = changed.count()
        kept = {} if grown else {b: v for b, v in entry["buckets"].items() if int(b) not in touched}
        untouched = 0 if grown else entry["rows"] - affected.count()
        self._put(table, rows, keys, 2 * n_buckets if grown else n_buckets, kept, deal)
        self.tables[table]["rows"] += untouched
        self.changed[table] = count
        return count

    def publish(self) -> int:
        """Makes all writes visible in one step; returns the commit's number (the latest one's if
        nothing was written). If others committed since this run began, their tables are taken over;
        ``CommitConflict`` if one of them is among those written here."""
        if not self.changed:
            return self.base["number"]
        latest = self.base
        while True:
            number = latest["number"] + 1
            tables = {**latest["tables"], **{t: self.tables[t] for t in self.changed}}
            commit = {"number": number, "run_id": self.run_id, "attempt": self.attempt, "changed": sorted(self.changed), "tables": tables}
            if create_exclusive(self.spark, _commit_path(self.root, number), json.dumps(commit)):
                return number
            latest = read_commit(self.spark, self.root, number)
            both = set(latest["changed"]) & set(self.changed)
            if both:
                raise CommitConflict(f"commit {number} of run {latest['run_id']} wrote {', '.join(sorted(both))} since this run began")


def history(spark: SparkSession, root: str) -> list[dict]:
    """All commits, oldest first: number, run_id, attempt, changed."""
    return [{k: c[k] for k in ("number", "run_id", "attempt", "changed")} for c in (read_commit(spark, root, n) for n in commit_numbers(spark, root))]


def _versions(commit: dict) -> set[tuple[str, str]]:
    return {(t, v) for t, e in commit["tables"].items() for v in ({e["version"]} if "version" in e else set(e["buckets"].values()))}


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Deletes version folders that only commits before the last ``keep`` name. Folders that no commit
    names (a run still at work, or one that failed) are left alone."""
    numbers = commit_numbers(spark, root)
    held = set().union(*(_versions(read_commit(spark, root, n)) for n in numbers[-keep:]), set())
    old = set().union(*(_versions(read_commit(spark, root, n)) for n in numbers[:-keep]), set())
    gone = [f"{root.rstrip('/')}/{t}/file_version={v}" for t, v in sorted(old - held)]
    for path in gone:
        fs, at = _path(spark, path)
        fs.delete(at, True)
    return gone

