"""Versioned tables in a commit log, and the workspace the import plans run in."""

from __future__ import annotations

import dataclasses
import functools
import json
import os
import uuid
from collections import UserDict
from collections.abc import Callable, Iterable, Mapping, Sequence
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlift.operators.merge import ACTION, merge_into
from ledgerlift.operators.schema import SchemaChange, schema_changes
from ledgerlift.session import empty_table

#: Prefix of the tables that hold staged rows.
STAGE = "stage_"
#: Buckets of a table that is merged into.
BUCKETS = 64
_ACTIONS = ("insert", "update", "keep")
Forms = Mapping[str, Callable[[Column], Column]]


class ConcurrentWrite(RuntimeError):
    pass


class NoVersion(KeyError):
    pass


@dataclasses.dataclass(frozen=True)
class Part:
    """One folder of data files: rows of one bucket (or of all) that one version wrote in one layout."""

    path: str
    bucket: int | None
    version: int
    layout: int


@dataclasses.dataclass(frozen=True)
class Manifest:
    """All there is to know of a version: columns by id, the folders that hold its rows, and what it counted.

    Files name columns by id, so that a column may be added, widened or dropped without touching them:
    a part without it shows the column's default.  `spread` says what the buckets hash; `counts` are the
    rows that this version wrote, by action.
    """

    version: int
    operation: str
    columns: tuple[tuple[int, str, str, str | None], ...] = ()  # id, name, type, default
    layouts: tuple[tuple[tuple[int, str], ...], ...] = ()  # id, type
    parts: tuple[Part, ...] = ()
    spread: str | None = None
    buckets: int = BUCKETS
    keys: tuple[str, ...] = ()
    next_id: int = 0
    rows: int = 0
    counts: Mapping[str, int] = dataclasses.field(default_factory=dict)
    undoes: int | None = None

    def text(self) -> str:
        return json.dumps(dataclasses.asdict(self))

    @staticmethod
    def of(text: str) -> Manifest:
        raw = json.loads(text)
        nested = {"columns": tuple(map(tuple, raw["columns"])), "layouts": tuple(tuple(map(tuple, x)) for x in raw["layouts"]), "parts": tuple(Part(**p) for p in raw["parts"]), "keys": tuple(raw["keys"])}
        return Manifest(**raw | nested)


class _Files:
    """The few file operations that Spark's readers and writers don't offer, on any Hadoop file system."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf, self.gateway = spark._jvm, spark._jsc.hadoopConfiguration(), spark.sparkContext._gateway

    def _at(self, path: str):
        hadoop = self.jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.conf), hadoop

    def names(self, folder: str) -> list[str]:
        fs, path = self._at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def text(self, path: str) -> str:
        fs, hadoop = self._at(path)
        stream = fs.open(hadoop)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def remove(self, path: str) -> None:
        fs, hadoop = self._at(path)
        fs.delete(hadoop, True)

    def create(self, path: str, text: str) -> bool:
        """Make a file with its whole content, or do nothing and say so where the name is taken."""
        (fs, target), (_, fresh) = self._at(path), self._at(f"{path}.{uuid.uuid4().hex}")
        stream = fs.create(fresh, False)
        stream.write(text.encode())
        stream.close()
        try:
            if fs.getUri().getScheme() == "file":
                # A rename would replace a local file; a link is made only if absent.
                os.link(*[unquote(urlparse(fs.makeQualified(p).toUri().toString()).path) for p in (fresh, target)])
            else:
                fail_if_there = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
                self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.conf).rename(fresh, target, fail_if_there)
            return True
        except (OSError, Py4JJavaError):
            if not fs.exists(target):
                raise
            return False
        finally:
            fs.delete(fresh, False)


class TableStore:
    """Named tables under one folder of any Hadoop file system with atomic renames.

    Every change is a numbered manifest that is created only if absent, so of two writers that started
    from the same version one fails.  Data files are never overwritten: a version is readable until it
    expires, and a plan may read the table it replaces.  A merge rewrites only the buckets that its
    source hashes to; the others are carried over by reference.
    """

    LOG, DATA = "log", "data"

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self._files = _Files(spark)
        self._spreads: dict[str, tuple[str, Column, tuple[str, ...]]] = {}

    # --- reading

    def versions(self, name: str) -> list[int]:
        """Versions of a table that are still there, oldest first."""
        found = (n.removesuffix(".json") for n in self._files.names(f"{self.root}/{name}/{self.LOG}") if n.endswith(".json"))
        return sorted(int(n) for n in found)

    def manifest(self, name: str, version: int | None = None) -> Manifest | None:
        """What a version is made of, the current one by default."""
        if version is None:
            there = self.versions(name)
            if not there:
                return None
            version = there[-1]
        elif version not in self.versions(name):
            raise NoVersion(f"no version {version} of {name} under {self.root}")
        return Manifest.of(self._files.text(self._log(name, version)))

    def exists(self, name: str) -> bool:
        return bool(self.versions(name))

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """The table as it is, or as it was at a version.  Rows that the version did not write have the action ``keep``."""
        manifest = self.manifest(name, version)
        if manifest is None:
            raise KeyError(f"no table {name} under {self.root}")
        return self._load(name, manifest, manifest.parts)

    def names(self) -> list[str]:
        """Tables that have a version, staged rows left out."""
        return [n for n in self._files.names(self.root) if not n.startswith(STAGE) and self.exists(n)]

    def _log(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/{self.LOG}/{version:020d}.json"

    def _load(self, name: str, manifest: Manifest, parts: Iterable[Part]) -> DataFrame:
        alike: dict[tuple[int, bool], list[str]] = {}
        for part in parts:
            alike.setdefault((part.layout, part.version == manifest.version), []).append(f"{self.root}/{name}/{part.path}")
        frames = []
        for (layout, fresh), paths in alike.items():
            stored = dict(manifest.layouts[layout])
            files = self.spark.read.schema(", ".join(f"c{i} {t}" for i, t in stored.items())).parquet(*paths)
            frames.append(files.select(*[_shown(c, stored, fresh).alias(c[1]) for c in manifest.columns]))
        if not frames:
            return empty_table(self.spark, ", ".join(f"`{n}` {t}" for _, n, t, _ in manifest.columns))
        return functools.reduce(DataFrame.unionAll, frames)

    # --- writing

    def replace(self, name: str, df: DataFrame, operation: str = "replace", undoes: int | None = None, count: Mapping[str, Column] | None = None) -> DataFrame:
        """Write `df` as the next version; fails if somebody else changed the table meanwhile.

        `count` are aggregates over the rows that the same job works out; the manifest keeps them.
        """
        before = self.manifest(name)
        written = self._written(name, before, df, self._spread_of(name, before, df), operation, count)
        self._commit(name, dataclasses.replace(written, undoes=undoes))
        return self.read(name, written.version)

    def change(self, name: str, df: DataFrame, flag: str) -> int:
        """Write `df` without its column `flag` if any row has it set, and say how many: one job for count and table."""
        before = self.manifest(name)
        table = df.drop(flag)
        written = self._written(name, before, df, self._spread_of(name, before, table), "change", {"changed": F.count_if(flag)}, leave=(flag,))
        if written.counts["changed"]:
            self._commit(name, written)
        else:
            self._discard(name, written)
        return written.counts["changed"]

    def _spread_of(self, name: str, before: Manifest | None, df: DataFrame):
        spread = self._spreads.get(name) if before is not None and before.spread else None
        return spread if spread is not None and set(spread[2]) <= set(df.columns) else None

    def merge(self, name: str, source: DataFrame, keys: Sequence[str], schema: str | None = None, combine: Callable[[DataFrame, DataFrame], DataFrame] | None = None, **options) -> DataFrame:
        """`merge_into` the stored table, rewriting only the buckets that the keys of `source` fall into.

        Or another `combine` of (target, source) that changes no row of other keys.

        A table that is not bucketed by these keys, compared in this form, is rewritten as a whole
        once.  `schema` names columns that the table shall have anyway.
        """
        forms = {**dict(options.get("match_on") or {}), **dict(options.get("fold") or {})}
        compared = [forms[k](F.col(f"`{k}`")) if k in forms else F.col(f"`{k}`") for k in keys]
        text = json.dumps([self.buckets, [str(c) for c in compared]])
        bucket = F.pmod(F.xxhash64(*[c.cast("string") for c in compared]), F.lit(self.buckets)).cast("int")
        self._spreads[name] = (text, bucket, tuple(keys))
        before = self.manifest(name)
        alike = before is not None and before.spread == text
        kinds = {n: t for _, n, t, _ in before.columns} if before else {}
        stored = source.select(*[F.col(f"`{k}`").cast(kinds[k]).alias(k) if k in kinds else F.col(f"`{k}`") for k in keys])
        touched = {r[0] for r in stored.select(bucket).distinct().collect()} if alike else set()
        old = [p for p in before.parts if p.bucket in touched] if alike else before.parts if before else ()
        if before is None:
            target = empty_table(self.spark, schema) if schema else source.drop(ACTION).limit(0)
        else:
            target = self._load(name, before, old).drop(ACTION)
            known = set(target.columns)
            absent = [f for f in (_schema(schema) if schema else ()) if f.name not in known]
            target = target.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent])
        merged = combine(target, source) if combine else merge_into(target, source, list(keys), **options)
        written = self._written(name, before, merged, self._spreads[name], "merge")
        if alike:
            kept = tuple(p for p in before.parts if p.bucket not in touched)
            written = dataclasses.replace(written, parts=kept + written.parts, rows=before.rows + written.counts.get("insert", 0))
        self._commit(name, written)
        return self.read(name, written.version)

    def align(self, name: str, want: StructType, defaults: Mapping[str, str] | None = None, drop: Sequence[str] = ()) -> list[SchemaChange]:
        """Bring a stored table to a schema without writing a data file: add, cast and drop are entries of the log.

        As `schema.align_schema`: wanted columns first and in order, then the others; a cast that fails
        for a value shows NULL.  `defaults` are texts that are cast to the type of an added column.
        """
        before = self.manifest(name)
        if before is None:
            raise KeyError(f"no table {name} under {self.root}")
        have = {c[1]: c for c in before.columns}
        shape = StructType.fromDDL(", ".join(f"`{n}` {t}" for _, n, t, _ in before.columns))
        changes = schema_changes(shape, want, drop)
        columns, free = [], before.next_id
        for field in want.fields:
            kind = field.dataType.simpleString()
            if field.name in have:
                columns.append((have[field.name][0], field.name, kind, have[field.name][3]))
            else:
                columns.append((free, field.name, kind, (defaults or {}).get(field.name)))
                free += 1
        known = {f.name for f in want.fields} | set(drop)
        columns += [c for c in before.columns if c[1] not in known]
        if changes or tuple(columns) != before.columns:
            self._commit(name, dataclasses.replace(before, version=before.version + 1, operation="align", columns=tuple(columns), next_id=free, counts={}, undoes=None))
        return changes

    def reset(self, name: str) -> None:
        """Empty a table (staging before an import) without touching its older versions."""
        before = self.manifest(name)
        if before is not None:
            self._commit(name, dataclasses.replace(before, version=before.version + 1, operation="reset", parts=(), rows=0, counts={}, undoes=None))

    def expire(self, name: str, keep: int = 2) -> list[int]:
        """Forget all but the newest `keep` versions and remove the data that only they had.  Returns their numbers."""
        there = self.versions(name)
        manifests = {v: self.manifest(name, v) for v in there}
        gone, kept = there[: -max(1, keep)], there[-max(1, keep) :]
        needed = {p.path for v in kept for p in manifests[v].parts}
        for version in gone:  # oldest first: what is left is always a run up to the current version
            self._files.remove(self._log(name, version))
        for path in {p.path for v in gone for p in manifests[v].parts} - needed:
            self._files.remove(f"{self.root}/{name}/{path}")
        return gone

    def _written(self, name: str, before: Manifest | None, df: DataFrame, spread, operation: str, count: Mapping[str, Column] | None = None, leave: Sequence[str] = ()) -> Manifest:
        """The data files of the next version, and its manifest, not yet committed; columns of `leave` only count."""
        known = {c[1]: c for c in before.columns} if before else {}
        free, columns, layout = before.next_id if before else 0, [], []
        for field in df.drop(*leave).schema.fields:
            kind = field.dataType.simpleString()
            if field.name in known and (before.parts == () or known[field.name][2] == kind):
                columns.append((known[field.name][0], field.name, kind, known[field.name][3]))
            else:
                columns.append((free, field.name, kind, None))
                free += 1
            layout.append((columns[-1][0], kind))
        counted = Observation()
        acted = ACTION in df.columns
        counts = [F.count_if(F.col(ACTION) == a).alias(a) for a in _ACTIONS] if acted else []
        counts += [c.alias(n) for n, c in (count or {}).items()]
        observed = df.observe(counted, F.count(F.lit(1)).alias("rows"), *counts)
        named = [F.col(f"`{n}`").alias(f"c{i}") for i, n, _, _ in columns]
        folder = f"{self.DATA}/{uuid.uuid4().hex}"
        if spread is None:
            observed.select(*named).write.parquet(f"{self.root}/{name}/{folder}")
            places = [(folder, None)]
        else:
            observed.select(*named, spread[1].alias("bucket")).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.root}/{name}/{folder}")
            found = [n for n in self._files.names(f"{self.root}/{name}/{folder}") if n.startswith("bucket=")]
            places = [(f"{folder}/{n}", int(n.partition("=")[2])) for n in found]
        seen = dict(counted.get)
        version = before.version + 1 if before else 1
        layouts = before.layouts if before else ()
        layouts = layouts if tuple(layout) in layouts else (*layouts, tuple(layout))
        parts = tuple(Part(path, bucket, version, layouts.index(tuple(layout))) for path, bucket in places)
        return Manifest(version, operation, tuple(columns), layouts, parts, spread[0] if spread else None, self.buckets, spread[2] if spread else (), free, seen.pop("rows"), seen)

    def _commit(self, name: str, manifest: Manifest) -> None:
        if not self._files.create(self._log(name, manifest.version), manifest.text()):
            self._discard(name, manifest)
            raise ConcurrentWrite(f"{name} got its version {manifest.version} from another writer")

    def _discard(self, name: str, manifest: Manifest) -> None:
        """Remove what was written for a version that will not be."""
        for path in {p.path.split("/bucket=")[0] for p in manifest.parts if p.version == manifest.version}:
            self._files.remove(f"{self.root}/{name}/{path}")

    # --- history

    def changes(self, name: str, version: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
        """Row images of one commit: ``_change`` (insert, update or delete), the keys, and `before` and `after`.

        Only buckets that the commit wrote are read.  Rows are matched by the keys of the table's last
        merge, or by those that are given, which must tell its rows apart; NULL equals NULL.
        """
        now = self.manifest(name, version)
        if now is None:
            raise KeyError(f"no table {name} under {self.root}")
        there = self.versions(name)
        was = self.manifest(name, now.version - 1) if now.version - 1 in there else None
        if was is None and now.version > 1:
            raise NoVersion(f"version {now.version - 1} of {name} has expired")
        return self._compared(name, was, now, keys)

    def _compared(self, name: str, was: Manifest | None, now: Manifest, keys: Sequence[str]) -> DataFrame:
        keys = list(keys or now.keys or (was.keys if was else ()))
        if not keys:
            raise ValueError(f"say by which keys rows of {name} are matched")
        old_parts = set(was.parts) if was else set()
        same = old_parts & set(now.parts)
        columns = [c[1] for c in now.columns if c[1] != ACTION]
        new = self._load(name, now, [p for p in now.parts if p not in same]).drop(ACTION)
        old = self._load(name, was, [p for p in was.parts if p not in same]).drop(ACTION) if was else new.limit(0)
        old = old.select(*[(F.col(f"`{c}`") if c in old.columns else F.lit(None)).cast(new.schema[c].dataType).alias(c) for c in columns])
        image = lambda df, as_: df.select(*[F.col(f"`{k}`").alias(f"{as_}{i}") for i, k in enumerate(keys)], F.struct(*[F.col(f"`{c}`") for c in columns]).alias(as_))
        matched = functools.reduce(lambda a, b: a & b, [F.col(f"before{i}").eqNullSafe(F.col(f"after{i}")) for i in range(len(keys))])
        both = image(old, "before").join(image(new, "after"), matched, "full_outer").where(~F.col("before").eqNullSafe(F.col("after")))
        kind = F.when(F.col("before").isNull(), "insert").when(F.col("after").isNull(), "delete").otherwise("update")
        return both.select(kind.alias("_change"), *[F.coalesce(f"before{i}", f"after{i}").alias(k) for i, k in enumerate(keys)], "before", "after")

    def undo(self, name: str, version: int, keys: Sequence[str] = ()) -> DataFrame:
        """Take one commit back and keep those after it, as the next version.

        A column that the commit changed gets its old value back where it still has the commit's; what
        was changed since then stays.  Rows that the commit inserted go unless they were changed since,
        rows that it deleted come back unless their key is taken.
        """
        images = self.changes(name, version, keys)
        now = self.manifest(name)
        keys = list(keys or self.manifest(name, version).keys or now.keys)
        current = self._load(name, now, now.parts).drop(ACTION)
        marked = images.select(F.col("_change"), *[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)], F.col("before").alias("__before"), F.col("after").alias("__after"))
        matched = functools.reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
        joined = current.withColumn("__here", F.lit(True)).join(marked, matched, "full_outer")
        have = set(self._column_names(name, version))
        part = lambda side, c: F.col(side)[c] if c in have else F.lit(None)
        value = {c: F.col(f"`{c}`") for c in current.columns}
        untouched = functools.reduce(lambda a, b: a & b, [value[c].eqNullSafe(part("__after", c).cast(current.schema[c].dataType)) for c in current.columns if c in have])
        goes = F.coalesce(F.col("__here") & (F.col("_change") == "insert") & untouched, F.lit(False)) | (F.col("__here").isNull() & (F.col("_change") != "delete"))
        back = {
            c: F.when(F.col("__here").isNull(), part("__before", c))
            .when((F.col("_change") == "update") & ~part("__before", c).eqNullSafe(part("__after", c)) & value[c].eqNullSafe(part("__after", c).cast(current.schema[c].dataType)), part("__before", c))
            .otherwise(value[c])
            .cast(current.schema[c].dataType)
            if c in have
            else value[c]
            for c in current.columns
        }
        return self.replace(name, joined.where(~goes).select(*[v.alias(c) for c, v in back.items()]), "undo", version)

    def _column_names(self, name: str, version: int) -> list[str]:
        return [c[1] for c in self.manifest(name, version).columns if c[1] != ACTION]


def _shown(column: tuple[int, str, str, str | None], stored: Mapping[int, str], fresh: bool) -> Column:
    """A column of a version as a part of some layout has it."""
    at, name, kind, default = column
    if name == ACTION and not fresh:
        return F.lit("keep")
    if at not in stored:
        return F.lit(default).cast(kind)
    return F.col(f"c{at}") if stored[at] == kind else F.col(f"c{at}").try_cast(kind)


class Deferred:
    """A DataFrame built on first use."""

    def __init__(self, build: Callable[[], DataFrame]):
        self._build, self._df = build, None

    def __call__(self) -> DataFrame:
        if self._df is None:
            self._df = self._build()
        return self._df


class _Named(UserDict):
    """Name -> DataFrame; deferred entries are built when read."""

    def __getitem__(self, name: str) -> DataFrame:
        value = self.data[name]
        return value() if isinstance(value, Deferred) else value


class Workspace:
    """The tables an import reads and replaces.

    Without a store every step is deferred and lazy: asking for one table plans only what
    that table needs.  With a store, staged rows and merged tables are written once, in the
    order of the plan, and read back, because later steps use them several times.
    """

    def __init__(self, tables: Mapping[str, DataFrame] | None = None, store: TableStore | None = None):
        self.tables = _Named(tables or {})
        self.merged = _Named()
        self.staged = _Named()
        self.store = store
        self._stored: set[str] = set()
        self._counts: dict[str, Manifest] = {}
        self._reports: dict[str, Mapping[str, Column]] = {}

    def _define(self, build: Callable[[], DataFrame]) -> Deferred:
        step = Deferred(build)
        if self.store:
            step()
        return step

    def table(self, name: str, schema: str) -> Deferred:
        """The table as of now, with at least the columns of `schema`; an absent one is empty."""
        known = self.tables.data.get(name)

        def build() -> DataFrame:
            if known is not None:
                df = known() if isinstance(known, Deferred) else known
            elif self.store is not None and self.store.exists(name):
                df = self.store.read(name).drop(ACTION)
            else:
                spark = self.store.spark if self.store else SparkSession.getActiveSession()
                return empty_table(spark, schema)
            have = set(df.columns)
            absent = [f for f in _schema(schema) if f.name not in have]
            return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent]) if absent else df

        return self._define(build)

    def all_tables(self) -> Mapping[str, DataFrame]:
        """The tables of this workspace and, where it has a store, all other stored ones."""
        for name in self.store.names() if self.store else ():
            if name not in self.tables.data:
                self.tables[name] = Deferred(functools.partial(lambda n: self.store.read(n).drop(ACTION), name))
        return self.tables

    def hold(self, name: str, build: Callable[[], DataFrame], count: Mapping[str, Column] | None = None) -> Deferred:
        """Keep staged rows for the steps that follow; `count` is what `report` will say about them."""
        self.staged[name] = self._define(lambda: self.store.replace(f"{STAGE}{name}", build(), count=count) if self.store else build())
        self._reports[name] = count or {}
        if self.store:
            self._counts[f"{STAGE}{name}"] = self.store.manifest(f"{STAGE}{name}")
        return self.staged.data[name]

    def report(self, name: str) -> DataFrame:
        """One row about staged rows; with a store it was counted while they were written, and nothing is read again."""
        count = self._reports[name]
        if not self.store:
            return self.staged[name].agg(*[c.alias(n) for n, c in count.items()])
        counts = self._counts[f"{STAGE}{name}"].counts
        return self.store.spark.createDataFrame([tuple(counts[n] for n in count)], ", ".join(f"`{n}` bigint" for n in count))

    def change(self, name: str, candidates: Callable[[], DataFrame], flag: str) -> int:
        """Make a repaired table the current one if any row has `flag`; returns how many have.

        With a store the table is written and counted in one job; without one it is counted, and
        repaired when it is asked for.
        """
        if self.store:
            changed = self.store.change(name, candidates(), flag)
            if changed:
                version = self.store.versions(name)[-1]
                self.tables[name] = Deferred(lambda: self.store.read(name, version).drop(ACTION))
                self._stored.add(name)
            return changed
        changed = candidates().agg(F.count_if(flag)).first()[0]
        if changed:
            self.replace(name, lambda: candidates().drop(flag))
        return changed

    def put(self, name: str, build: Callable[[], DataFrame]) -> Deferred:
        """Make a merged table (with ``_action``) the current one; returns it without the action."""
        return self._merged(name, lambda: self.store.replace(name, build()) if self.store else build())

    def upsert(self, name: str, schema: str, source: Callable[[], DataFrame], keys: Sequence[str], **options) -> Deferred:
        """Merge rows into a table of the workspace (`merge_into`); a stored one is rewritten where they fall only."""
        if self.store and (name not in self.tables.data or name in self._stored):
            return self._merged(name, lambda: self.store.merge(name, source(), keys, schema, **options))
        target = self.table(name, schema)
        return self.put(name, lambda: merge_into(target(), source(), list(keys), **options))

    def provide(
        self,
        name: str,
        schema: str,
        source: Callable[[], DataFrame],
        keys: Sequence[str],
        combine: Callable[[DataFrame, DataFrame], DataFrame],
        fold: Forms | None = None,
    ) -> Deferred:
        """Like `upsert` by another rule: `combine` of (table, source) gives the table with actions and changes no other keys."""
        if self.store and (name not in self.tables.data or name in self._stored):
            return self._merged(name, lambda: self.store.merge(name, source(), keys, schema, combine, fold=fold))
        target = self.table(name, schema)
        return self.put(name, lambda: combine(target(), source()))

    def _merged(self, name: str, build: Callable[[], DataFrame]) -> Deferred:
        merged = self._define(build)
        if self.store:
            self._stored.add(name)
            self._counts[name] = self.store.manifest(name)
        self.merged[name] = merged
        self.tables[name] = Deferred(lambda: merged().drop(ACTION))
        return self.tables.data[name]

    def replace(self, name: str, build: Callable[[], DataFrame]) -> Deferred:
        """Make a repaired table, without actions, the current one."""
        self.tables[name] = self._define(lambda: self.store.replace(name, build()) if self.store else build())
        if self.store:
            self._stored.add(name)
        return self.tables.data[name]

    def summary(self, names: Iterable[str] | None = None) -> DataFrame:
        """Rows inserted, updated and kept per merged table; with a store, as counted while they were written."""
        if self.store:
            asked = [(n, self._counts[n]) for n in names or self.merged]
            rows = [(n, m.counts.get("insert", 0), m.counts.get("update", 0), m.rows - m.counts.get("insert", 0) - m.counts.get("update", 0)) for n, m in asked]
            return self.store.spark.createDataFrame(rows, "table_name string, inserted bigint, updated bigint, kept bigint")
        parts = None
        for name in names or self.merged:
            counts = self.merged[name].agg(
                *[F.count_if(F.col(ACTION) == a).alias(n) for a, n in (("insert", "inserted"), ("update", "updated"), ("keep", "kept"))]
            )
            row = counts.select(F.lit(name).alias("table_name"), "inserted", "updated", "kept")
            parts = row if parts is None else parts.unionByName(row)
        return parts


@functools.cache
def _schema(text: str):
    return StructType.fromDDL(text).fields
