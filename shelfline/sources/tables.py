"""Stored tables, published by one pointer file each.

Plain Parquet has no DELETE or MERGE and cannot be overwritten while it is read, so a state function yields new rows, and
this module writes them to a new folder and publishes it. A table's folder holds

* data folders, each written once by one job and never changed;
* manifests, one for each version: which data folders make it up, and the schema;
* ``_current``, the pointer: which manifests are kept and which is the current one. It is replaced by one atomic rename.

A reader resolves the pointer once, when it asks for the table. What it then reads are folders that no later write touches,
so it sees one version whole, even if others are published meanwhile; only versions that have fallen out of ``keep`` are
removed. A write that breaks off before the rename changes nothing, and what it left behind is removed by ``vacuum``.
The store lists a folder only to learn which partitions a job has written: its calls to the file system do not depend on the
number of files. One writer a table at a time is assumed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_POINTER, _MANIFESTS = "_current", "_manifests"
_PART, _STATE = "part_key", "state"


def shared_folder(spark: SparkSession) -> str:
    """A new folder all executors can reach: below the checkpoint folder, or the warehouse where a session names none.

    It goes when the session's JVM ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{base.rstrip('/')}/shelfline-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def written(df: DataFrame) -> DataFrame:
    """``df`` as a stored table: computed once, then read by whatever uses it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def buckets_for(*sources: DataFrame, each: int = 8 << 20, least: int = 8) -> int:
    """Buckets for what is made of ``sources``: one for every ``each`` bytes of the files these read, so that a bucket stays as large as it is."""
    spark, total = sources[0].sparkSession, 0
    for file in {f for df in sources for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        total += path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
    return max(least, -(-total // each))


class TableStore:
    """Tables below one root folder, addressed as ``layer/name``.

    A table is of one of three kinds: replaced whole; refreshed by partition; or a history, whose open part is replaced
    while its closed part only grows.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # File system access goes through Hadoop, so any store Spark can write works.

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _text(self, *parts: str) -> str | None:
        path, files = self._path(*parts), self._files()
        if not files.exists(path):
            return None
        stream = files.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _put(self, text: str, *parts: str) -> None:
        stream = self._files().create(self._path(*parts), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def _delete(self, *parts: str) -> None:
        self._files().delete(self._path(*parts), True)

    def _children(self, *parts: str) -> list[str]:
        path, files = self._path(*parts), self._files()
        if not files.exists(path):
            return []
        return [status.getPath().getName() for status in files.listStatus(path)]

    # Pointer and manifests.

    def _pointer(self, table: str) -> dict | None:
        """{"current": version, "kept": {version: manifest's name}}"""
        text = self._text(table, _POINTER)
        return json.loads(text) if text else None

    def _manifest(self, table: str, version: int | None = None) -> dict | None:
        pointer = self._pointer(table)
        if pointer is None:
            return None
        name = pointer["kept"].get(str(pointer["current"] if version is None else version))
        if name is None:
            raise FileNotFoundError(f"{self.root}/{table} keeps no version {version}")
        return json.loads(self._text(table, _MANIFESTS, name))

    def _publish(self, table: str, manifest: dict, keep: int) -> None:
        """Make ``manifest`` the current version and drop the oldest beyond ``keep``."""
        pointer = self._pointer(table) or {"current": 0, "kept": {}}
        number = pointer["current"] + 1
        name = f"{number:06d}-{uuid.uuid4().hex}.json"
        self._put(json.dumps(manifest), table, _MANIFESTS, name)
        versions = {int(n): m for n, m in pointer["kept"].items()} | {number: name}
        kept = dict(sorted(versions.items())[-keep:])
        draft = f"_draft-{uuid.uuid4().hex}"
        self._put(json.dumps({"current": number, "kept": kept}), table, draft)
        self._swap(self._path(table, draft), self._path(table, _POINTER))
        self._drop(table, [m for n, m in versions.items() if n not in kept], list(kept.values()))

    def _swap(self, draft, pointer) -> None:
        """The commit: an atomic rename over the old pointer."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        option = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark._sc._gateway.new_array(option, 1)
        options[0] = option.OVERWRITE
        whole = self._files().makeQualified(pointer)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole.toUri(), conf)
        context.rename(self._files().makeQualified(draft), whole, options)

    def _drop(self, table: str, dropped: list[str], kept: list[str]) -> None:
        if not dropped:
            return
        live = {f for m in kept for f in _folders(json.loads(self._text(table, _MANIFESTS, m)))}
        roots = {f.split("/")[0] for f in live}
        gone = {f for m in dropped for f in _folders(json.loads(self._text(table, _MANIFESTS, m)))} - live
        # A data folder without any live part goes as a whole.
        for folder in {f if f.split("/")[0] in roots else f.split("/")[0] for f in gone}:
            self.spark.sql(f"drop table if exists `{_catalog_name(folder.split('/')[0])}`")
            self._delete(table, folder)
        for name in dropped:
            self._delete(table, _MANIFESTS, name)

    def vacuum(self, table: str) -> list[str]:
        """Remove what writes that broke off have left; the names of the folders removed. No write may be under way."""
        pointer = self._pointer(table) or {"kept": {}}
        kept = set(pointer["kept"].values())
        roots = {f.split("/")[0] for m in kept for f in _folders(json.loads(self._text(table, _MANIFESTS, m)))}
        left = [n for n in self._children(table) if n.startswith(("data-", "_draft-")) and n not in roots]
        for name in left:
            self._delete(table, name)
        for name in self._children(table, _MANIFESTS):
            if name not in kept and name.endswith(".json"):
                self._delete(table, _MANIFESTS, name)
        return left

    # Whole tables.

    def versions(self, table: str) -> list[int]:
        """Versions that can be read, oldest first."""
        pointer = self._pointer(table)
        return sorted(int(n) for n in pointer["kept"]) if pointer else []

    def exists(self, table: str) -> bool:
        return self._pointer(table) is not None

    def _read(self, table: str, manifest: dict, folders: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(manifest["schema"]))
        if not folders:
            return self.spark.createDataFrame([], schema)
        if "buckets" in manifest:
            return self._bucketed(table, manifest)
        paths = [f"{self.root}/{table}/{folder}" for folder in folders]
        return self.spark.read.schema(schema).parquet(*paths)

    def replace(self, table: str, df: DataFrame, keep: int = 2) -> DataFrame:
        """Publish ``df`` as the table's new content and return it as stored.

        ``df`` may read the table it replaces. All but the last ``keep`` versions are removed afterwards.
        """
        folder = f"data-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(f"{self.root}/{table}/{folder}")
        self._publish(table, {"folder": folder, "schema": df.schema.json()}, keep)
        return self.read(table)

    def replace_bucketed(self, table: str, df: DataFrame, keys: Sequence[str], buckets: int, keep: int = 2) -> DataFrame:
        """As ``replace``, with the rows dealt to ``buckets`` files by ``keys`` and sorted by them within.

        Sums by these keys, or more, and joins on exactly these keys with a table of as many buckets stay where the rows are.
        All rows of one key share a file, so take keys that few rows share, and buckets that fit a task: as many as ``buckets_for`` says.
        """
        folder = f"data-{uuid.uuid4().hex}"
        name = _catalog_name(folder)
        (
            df.repartition(buckets, *keys)
            .write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet")
            .option("path", f"{self.root}/{table}/{folder}").saveAsTable(name)
        )
        manifest = {"folder": folder, "schema": df.schema.json(), "buckets": {"keys": list(keys), "count": buckets}}
        self._publish(table, manifest, keep)
        return self.read(table)

    def _bucketed(self, table: str, manifest: dict) -> DataFrame:
        """Only the catalog can say that files are buckets: a table there stands for the folder, in each session anew."""
        name, buckets = _catalog_name(manifest["folder"]), manifest["buckets"]
        schema = T.StructType.fromJson(json.loads(manifest["schema"]))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        keys = ", ".join(f"`{k}`" for k in buckets["keys"])
        self.spark.sql(
            f"create table if not exists `{name}` ({columns}) using parquet clustered by ({keys}) "
            f"sorted by ({keys}) into {buckets['count']} buckets location '{self.root}/{table}/{manifest['folder']}'"
        )
        return self.spark.table(name)

    def truncate(self, table: str) -> DataFrame:
        """Publish an empty version with the present schema; nothing is read or written but the pointer and a manifest."""
        manifest = self._required(table)
        self._publish(table, {"schema": manifest["schema"]}, 2)
        return self.read(table)

    def _required(self, table: str, version: int | None = None) -> dict:
        manifest = self._manifest(table, version)
        if manifest is None:
            raise FileNotFoundError(f"{self.root}/{table} has no committed version")
        return manifest

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """The current version, or a given earlier one that is still kept, whatever the kind of table."""
        manifest = self._required(table, version)
        return self._read(table, manifest, _folders(manifest))

    def register(self, table: str, df: DataFrame) -> None:
        """Make ``df``, read from this store, queryable in SQL as ``layer.name``.

        The catalog has a view with the columns and types of ``df`` on the current version. A partitioned table's key is a
        partition column there: filters and joins on it skip partitions. Register again to show a newer version.
        """
        layer, name = table.split("/")
        manifest = self._required(table)
        self.spark.sql(f"create database if not exists `{layer}`")
        folders = _folders(manifest)
        files = ", ".join(f"parquet.`{self.root}/{table}/{f}`" for f in folders[:1])
        key = manifest.get("key")
        if len(folders) != 1 or key:
            files = f"`{layer}`.`{name}__files`"
            self._as_table(files, table, manifest, key)
        columns = ", ".join(
            f"cast(`{_PART if f.name == key else f.name}` as {f.dataType.simpleString()}) as `{f.name}`" for f in df.schema
        )
        self.spark.sql(f"create or replace view `{layer}`.`{name}` as select {columns} from {files}")

    def _as_table(self, name: str, table: str, manifest: dict, key: str | None) -> None:
        schema = T.StructType.fromJson(json.loads(manifest["schema"]))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        location = f"{self.root}/{table}/_none"
        self.spark.sql(f"drop table if exists {name}")
        self.spark.sql(f"create table {name} ({columns}, `{_PART}` bigint) using parquet partitioned by (`{_PART}`) location '{location}'")
        parts = manifest.get("parts") or {str(k): f for k, f in enumerate(_folders(manifest))}
        for some in _chunks(list(parts.items()), 500):
            added = " ".join(f"partition (`{_PART}` = {k}) location '{self.root}/{table}/{f}'" for k, f in some)
            self.spark.sql(f"alter table {name} add {added}")

    # Histories.

    def open_part(self, table: str) -> DataFrame:
        """The part of a history that the next run may change. A table that was replaced whole is open as a whole."""
        manifest = self._required(table)
        return self._read(table, manifest, [manifest["folder"]] if "folder" in manifest else [])

    def evolve(self, table: str, rows: DataFrame, closed: Column, keep: int = 2) -> DataFrame:
        """Publish ``rows`` as the new open part, but for those ``closed``, which join the closed part for good.

        One job writes both. What was closed before is neither read nor written again.
        """
        manifest = self._manifest(table) or {}
        folder = f"data-{uuid.uuid4().hex}"
        state = F.when(closed, "closed").otherwise("open").alias(_STATE)
        rows.select("*", state).write.partitionBy(_STATE).parquet(f"{self.root}/{table}/{folder}")
        new = {name.removeprefix(f"{_STATE}="): f"{folder}/{name}" for name in self._children(table, folder) if "=" in name}
        found = {"closed": manifest.get("closed", []) + [new[k] for k in ("closed",) if k in new], "schema": rows.schema.json()}
        if "open" in new:
            found["folder"] = new["open"]
        self._publish(table, found, keep)
        return self.read(table)

    def compact(self, table: str, keep: int = 2) -> DataFrame:
        """Bring the closed part's folders, of which each run adds one, together in one."""
        manifest = self._required(table)
        if len(manifest.get("closed", [])) > 1:
            folder = f"data-{uuid.uuid4().hex}"
            self._read(table, manifest, manifest["closed"]).write.parquet(f"{self.root}/{table}/{folder}")
            self._publish(table, manifest | {"closed": [folder]}, keep)
        return self.read(table)

    # Partitioned tables.

    def last_key(self, table: str, key: str) -> int:
        """The greatest partition key, 0 when there is none. Opens no data file."""
        return max(map(int, (self._manifest(table) or {}).get("parts", {})), default=0)

    def read_partitioned(
        self, table: str, schema: T.StructType, key: str, from_key: int | None = None
    ) -> DataFrame:
        """A partitioned table under its declared schema; empty before the first write.

        With ``from_key`` the folders of smaller keys are not even named.
        """
        parts = (self._manifest(table) or {}).get("parts", {})
        wanted = [f for k, f in sorted(parts.items(), key=_by_key) if from_key is None or int(k) >= from_key]
        return self._read(table, {"schema": schema.json()}, wanted).select(schema.fieldNames())

    def refresh_partitions(
        self,
        table: str,
        state: DataFrame,
        key: str,
        from_key: int,
        sort_by: tuple[str | Column, ...] = (),
        keep: int = 2,
        before_commit: Callable[[], None] | None = None,
        row_group: int | None = None,
    ) -> None:
        """Make the partitions with ``key >= from_key`` equal to those rows of ``state``.

        Rows of ``state`` below ``from_key`` are ignored, and it may read the table it goes to. Rows are gathered by key
        before writing, with large keys split and small ones packed together, so each partition gets a few well-sized files.
        Sorted by ``functions.clustering.interleaved``, a file serves filters on each of several columns; ``row_group`` is
        then the bytes of what a reader can skip. ``before_commit`` runs between the write and the commit; if it raises, the table stays as it was.
        """
        folder = f"data-{uuid.uuid4().hex}"
        rows = state.filter(F.col(key) >= from_key).hint("rebalance", key)
        # A sort works its expressions out anew for every comparison of rows: as columns they are worked out once a row.
        named = {f"{_PART}_{n}": c for n, c in enumerate(sort_by) if not isinstance(c, str)}
        order = [c if isinstance(c, str) else f"{_PART}_{n}" for n, c in enumerate(sort_by)]
        (
            rows.withColumns(named)
            .sortWithinPartitions(key, *order)
            .drop(*named)
            .withColumn(_PART, F.col(key))
            .write.partitionBy(_PART)
            .options(**({"parquet.block.size": row_group} if row_group else {}))
            .parquet(f"{self.root}/{table}/{folder}")
        )
        if before_commit is not None:
            before_commit()
        old = (self._manifest(table) or {}).get("parts", {})
        prefix = f"{_PART}="
        new = {n.removeprefix(prefix): f"{folder}/{n}" for n in self._children(table, folder) if n.startswith(prefix)}
        parts = {k: f for k, f in old.items() if int(k) < from_key} | new
        self._publish(table, {"key": key, "parts": parts, "schema": state.schema.json()}, keep)


def _folders(manifest: dict) -> list[str]:
    """All data folders of a version."""
    whole = [manifest["folder"]] if "folder" in manifest else []
    parts = [f for _, f in sorted(manifest.get("parts", {}).items(), key=_by_key)]
    return whole + manifest.get("closed", []) + parts


def _catalog_name(folder: str) -> str:
    return f"shelfline_{folder.replace('-', '_')}"


def _by_key(part: tuple[str, str]) -> int:
    return int(part[0])


def _chunks(items: list, size: int):
    return (items[k : k + size] for k in range(0, len(items), size))
