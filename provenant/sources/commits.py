"""A commit log: batches of several tables become visible together, by one manifest file for each commit.

A commit first writes its rows to folders that no reader knows, and then one small manifest under the next version number,
moved into place without overwriting. Until then readers see nothing of it, afterwards all of it, and of two writers that
want the same number one is refused (where renaming without overwriting is atomic, as on HDFS). Manifests and data folders never change, so an earlier version can be read as it was.
A reader lists the manifests since the last checkpoint, which repeats the state of all before it.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Commits between two checkpoints, and tokens that a checkpoint remembers.
CHECKPOINT_EVERY, TOKENS = 50, 10_000
BUCKET = "_bucket"
MANIFEST = "version long, token string, tables map<string, struct<folder: string, n_rows: long, removes: array<string>>>"


class ConflictError(ValueError):
    """Rows that an append-only table refuses, or a commit that another writer was ahead of."""


@dataclass
class State:
    """``folders``: of each table, the data folders and the partition folders in each; ``tokens``: version by token."""

    version: int = 0
    schemas: dict[str, str] = field(default_factory=dict)
    folders: dict[str, dict[str, list]] = field(default_factory=dict)
    tokens: dict[str, int] = field(default_factory=dict)

    def apply(self, manifest: dict) -> None:
        self.version = manifest["version"]
        self.tokens[manifest["token"]] = self.version
        for name, change in manifest["tables"].items():
            self.schemas[name] = change["schema"]
            own = self.folders.setdefault(name, {})
            for gone in change["removes"]:
                own.pop(gone)
            own[change["folder"]] = change["values"]


class Files:
    """The few calls of the shared file system that a log needs."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.spark = spark._jvm, spark
        self.root = self.path(root)
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.root.getFileSystem(self.conf)

    def path(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join(parts))

    def names(self, folder: str) -> list[str]:
        at = self.path(str(self.root), folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> dict:
        stream = self.fs.open(self.path(str(self.root), name))
        try:
            return json.loads(bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
        finally:
            stream.close()

    def publish(self, name: str, content: dict) -> bool:
        """Write a file beside its place and move it there; False where the place is taken."""
        staged, final = self.path(str(self.root), f"_staged/{uuid.uuid4().hex}"), self.path(str(self.root), name)
        self.fs.mkdirs(final.getParent())
        out = self.fs.create(staged, False)
        out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        out.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        none = self.spark.sparkContext._gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(self.fs.makeQualified(staged), self.fs.makeQualified(final), none)
        except Py4JJavaError as error:
            self.fs.delete(staged, False)
            if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            return False
        return True


def manifest_name(version: int, kind: str = "json") -> str:
    return f"_commits/{version:020d}.{kind}"


def state(spark: SparkSession, root: str, version: int | None = None) -> State:
    """What the log holds, at ``version`` where that is given."""
    files, out = Files(spark, root), State()
    names = [n for n in files.names("_commits") if version is None or int(n.split(".")[0]) <= version]
    known = [n for n in names if n.endswith(".checkpoint")]
    if known:
        out = State(**files.read(f"_commits/{known[-1]}"))
    for name in names:
        if name.endswith(".json") and int(name.split(".")[0]) > out.version:
            out.apply(files.read(f"_commits/{name}"))
    if version is not None and out.version != version:
        raise ValueError(f"the log has no version {version}")
    return out


def bucket(keys: list[str], n: int) -> Column:
    """A partition column that follows from the key, so that looking for keys reads the buckets of these keys only."""
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def commit(spark: SparkSession, root: str, token: str, tables: dict[str, DataFrame], partition: dict[str, str] | None = None, expected: int | None = None, replaces: dict[str, list[str]] | None = None) -> int:
    """Add rows to tables in one step; the version that holds them.

    A ``token`` that the log knows adds nothing, so a batch can be retried. ``expected`` is the version that the rows were
    made from; where another commit came in between, they are refused.
    """
    now = state(spark, root)
    if token in now.tokens:
        return now.tokens[token]
    if expected is not None and expected != now.version:
        raise ConflictError(f"the log is at version {now.version}, not {expected}")
    changes = {}
    for name, rows in tables.items():
        folder, by = f"{name}/commit={uuid.uuid4().hex}", (partition or {}).get(name)
        if by:
            rows.hint("rebalance", by).write.partitionBy(by).parquet(f"{root}/{folder}")
        else:
            rows.write.parquet(f"{root}/{folder}")
        own = [n for n in Files(spark, root).names(folder) if n.startswith(f"{by}=")] if by else []
        n_rows = spark.read.schema(rows.schema).parquet(f"{root}/{folder}").count()
        changes[name] = {"folder": folder, "n_rows": n_rows, "schema": rows.schema.json(), "values": own, "removes": (replaces or {}).get(name, [])}
    manifest = {"version": now.version + 1, "token": token, "tables": changes}
    if not Files(spark, root).publish(manifest_name(now.version + 1), manifest):
        raise ConflictError(f"another writer has made version {now.version + 1}")
    if manifest["version"] % CHECKPOINT_EVERY == 0:
        now.apply(manifest)
        now.tokens = dict(list(now.tokens.items())[-TOKENS:])
        Files(spark, root).publish(manifest_name(now.version, "checkpoint"), vars(now))
    return manifest["version"]


def read(spark: SparkSession, root: str, name: str, version: int | None = None, values: list | None = None, schema: T.StructType | None = None) -> DataFrame:
    """The rows of a table, at ``version`` where that is given; with ``values`` those of these partitions only, and the
    others are not even listed. ``schema`` is that of a table which may not exist yet."""
    now = state(spark, root, version)
    if name not in now.folders:
        return spark.createDataFrame([], schema or T.StructType())
    known = T.StructType.fromJson(json.loads(now.schemas[name]))
    columns = (schema or T.StructType([f for f in known.fields if f.name != BUCKET])).names
    wanted = None if values is None else {str(v) for v in values}
    paths = [f"{root}/{f}" if wanted is None else f"{root}/{f}/{v}" for f, own in now.folders[name].items() for v in ([""] if wanted is None else own) if wanted is None or v.split("=", 1)[1] in wanted]
    if not paths:
        return spark.createDataFrame([], known).select(*columns)
    full = T.StructType([*known.fields, T.StructField("commit", T.StringType())])
    return spark.read.schema(full).option("basePath", f"{root}/{name}").parquet(*paths).select(*columns)


def added(spark: SparkSession, root: str, name: str, token: str) -> DataFrame:
    """The rows that the commit of ``token`` added to a table."""
    version = state(spark, root).tokens[token]
    manifest = Files(spark, root).read(manifest_name(version))["tables"][name]
    return spark.read.schema(T.StructType.fromJson(json.loads(manifest["schema"]))).parquet(f"{root}/{manifest['folder']}")


def fresh(spark: SparkSession, root: str, name: str, rows: DataFrame, keys: list[str], by: str, order: str | None = None) -> DataFrame:
    """The rows whose key the table does not hold, the first by ``order`` of equal keys. ``by``, a column that follows from
    the key, is what the table is partitioned by: only partitions that the rows touch are read, and of these the keys."""
    first = rows.groupBy(*keys).agg(F.min_by(F.struct(*rows.columns), F.col(order or keys[0])).alias("row")).select("row.*")
    touched = [r[0] for r in rows.select(by).distinct().collect()]  # partitions of one table
    earlier = read(spark, root, name, values=touched, schema=T.StructType([rows.schema[k] for k in keys]))
    return first.join(earlier, [first[k].eqNullSafe(earlier[k]) for k in keys], "left_anti")


def history(spark: SparkSession, root: str) -> DataFrame:
    """(version, token, name, n_rows, n_removed) of every table in every commit."""
    changes = spark.read.schema(MANIFEST).json(f"{root}/_commits/*.json").select("version", "token", F.explode("tables").alias("name", "change"))
    return changes.select("version", "token", "name", F.col("change.n_rows").alias("n_rows"), F.size("change.removes").cast("long").alias("n_removed"))


def compact(spark: SparkSession, root: str, name: str, by: str | None = None) -> int:
    """Write a table's rows into one folder, in a commit that gives up its present ones; earlier versions stay as they are."""
    now = state(spark, root)
    rows = read(spark, root, name, schema=T.StructType.fromJson(json.loads(now.schemas[name])))
    return commit(spark, root, f"compact-{name}-{now.version}", {name: rows}, {name: by} if by else None, now.version, {name: list(now.folders[name])})


def unreferenced(spark: SparkSession, root: str) -> list[str]:
    """Data folders that the present version does not hold: left by commits that failed or are still going on, or given up."""
    files, now = Files(spark, root), state(spark, root)
    found = [f"{t}/{f}" for t in files.names("") if not t.startswith("_") for f in files.names(t)]
    return [f for f in found if not any(f in own for own in now.folders.values())]
