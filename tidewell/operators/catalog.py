"""Parquet tables whose rows and resume states become visible together.

Each commit writes data files in new folders, then names them in one new manifest; a reader takes the latest.
Manifests are created with a rename that fails if the number is taken, so two writers can't both commit.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Iterable
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.merge import ORDINAL, POLICIES, complete, with_ordinal
from tidewell.plans.schemas import MIGRATIONS, TABLES, Table

#: Hashes of the keys of a folder's rows, by the number of the unique key.
HASHES = "folder string, k int, h long"
#: A row's place; folders of such notes that a table may have.
PLACE = T.StructType([T.StructField("tw_file", T.StringType()), T.StructField("tw_row", T.LongType())])
MOST_NOTES = 20


@dataclass
class Manifest:
    number: int = 0
    tables: dict[str, list[str]] = field(default_factory=dict)
    #: Saved state (JSON text), when it was saved, and last batch of each source.
    states: dict[str, str] = field(default_factory=dict)
    saved: dict[str, str] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)
    #: Runs that have started and not ended: id to source and start.
    running: dict[str, list[str]] = field(default_factory=dict)
    #: By folder, its rows and the least and greatest value of the table's zone columns.
    rows: dict[str, int] = field(default_factory=dict)
    zones: dict[str, dict[str, list[Any]]] = field(default_factory=dict)
    #: By folder, the folder of its keys' hashes, for tables with unique keys.
    keys: dict[str, str] = field(default_factory=dict)
    #: By table, folders of places (file, row) whose rows were replaced; reads leave these out.
    gone: dict[str, list[str]] = field(default_factory=dict)
    #: By table with a serial column, the number that the next row gets.
    serials: dict[str, int] = field(default_factory=dict)

    def reaching(self, name: str, column: str, after: Any) -> list[str]:
        """A table's folders that may have a value of a zone column over `after`, by their greatest value; those without zones come first."""
        zone = lambda x: self.zones.get(x, {}).get(column)
        some = [x for x in self.tables.get(name, []) if zone(x) is None or zone(x)[1] > after]
        return sorted(some, key=lambda x: (zone(x) is not None, zone(x) and zone(x)[1]))


class Catalog:
    def __init__(self, spark: SparkSession, base: str, tables: dict[str, Table] = TABLES) -> None:
        self.spark, self.base, self.tables = spark, base.rstrip("/"), tables
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._text = jvm.org.apache.commons.io.IOUtils
        self._staged: list[str] = []

    def _manifests(self) -> list[str]:
        folder = self._path(f"{self.base}/_manifest")
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return sorted(n for n in names if n.endswith(".json"))

    def manifest(self) -> Manifest:
        names = self._manifests()
        if not names:
            return Manifest()
        stream = self._fs.open(self._path(f"{self.base}/_manifest/{names[-1]}"))
        try:
            return Manifest(**json.loads(self._text.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def _publish(self, m: Manifest) -> None:
        final = self._path(f"{self.base}/_manifest/{m.number:012d}.json")
        temporary = self._path(f"{self.base}/_manifest/.{uuid.uuid4().hex}")
        stream = self._fs.create(temporary, False)
        try:
            stream.write(bytearray(json.dumps(m.__dict__).encode()))
        finally:
            stream.close()
        if self._fs.exists(final) or not self._fs.rename(temporary, final):
            self._fs.delete(temporary, False)
            raise RuntimeError(f"another writer committed {m.number}")

    def init(self) -> int:
        """Applies the migrations that aren't yet, each once; returns how many.  Other tables are declared with them."""
        m = self.manifest()
        done = {r.version for r in self.table("_migrations", m).select("version").collect()} if "_migrations" in m.tables else set()
        known = [(v, n, [t for t in names if t in self.tables]) for v, n, names in MIGRATIONS]
        todo = [x for x in known if x[0] not in done and x[2]]
        rest = [t for t in self.tables if not any(t in names for *_, names in known)]
        new = [t for names in [*(x[2] for x in todo), rest] for t in names if t not in m.tables]
        if todo or new:
            m.tables |= {t: [] for t in new}
            if todo and "_migrations" in self.tables:
                now = datetime.now(timezone.utc)
                rows = self.spark.createDataFrame([(v, n, now) for v, n, _ in todo], self.tables["_migrations"].schema)
                self._append("_migrations", rows, m)
            m.number += 1
            self._publish(m)
        return len(todo)

    def _written(self, name: str, rows: DataFrame, m: Manifest, number: bool = True, folder: str = "") -> str:
        """Writes rows to a new folder of a table, named if asked for.  Its rows and zones are observed by the write itself; a serial column gets its numbers there.

        Numbers rise from commit to commit: each task's go on from where 2**33 rows of the task before would end.
        """
        spec, folder = self.tables[name], folder or f"{name}/{uuid.uuid4().hex}"
        serial, zones = spec.serial if number else None, spec.zones
        if serial:
            rows = rows.withColumn(serial, F.monotonically_increasing_id() + F.lit(m.serials.get(name, 1)))
        seen = Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("n"), *(f(c).alias(f"{n} {c}") for c in zones for n, f in (("min", F.min), ("max", F.max)))).write.parquet(f"{self.base}/{folder}")
        got = seen.get
        m.rows[folder] = got["n"]
        if zone := {c: [got[f"min {c}"], got[f"max {c}"]] for c in zones if got["n"] and got[f"max {c}"] is not None}:
            m.zones[folder] = zone
        if serial and got["n"]:
            first = m.serials.get(name, 1)
            tasks = (got[f"max {serial}"] - first >> 33) + 1
            m.serials[name] = first + (tasks << 33)
        return folder

    def _append(self, name: str, rows: DataFrame, m: Manifest) -> str:
        return self._adopt(name, self._written(name, rows, m), m)

    def _adopt(self, name: str, folder: str, m: Manifest, keys: str = "") -> str:
        """A written folder becomes one of the table's, with the hashes of its keys (those of a folder of hashes, if it has them)."""
        m.tables[name] = [*m.tables.get(name, []), folder]
        if self.tables[name].keys and m.rows[folder]:
            m.keys[folder] = keys or self._keyed(name, self.folders(name, [folder]), folder)
        return folder

    def _keyed(self, name: str, rows: DataFrame, folder: str) -> str:
        """Writes the hashes of the keys of rows, as those of a folder of the table; '' if it has no unique keys."""
        if not self.tables[name].keys:
            return ""
        keys = f"{name}/keys-{uuid.uuid4().hex}"
        self._hashes(rows, name).select(F.lit(folder).alias("folder"), "k", "h").write.parquet(f"{self.base}/{keys}")
        return keys

    def _hashes(self, rows: DataFrame, name: str) -> DataFrame:
        """k and h: the hash of each unique key of rows; a key with a null has none, for it meets no other."""
        if len(self.tables[name].keys) == 1:
            (key,) = self.tables[name].keys
            return rows.filter(complete(key)).select(F.lit(0).alias("k"), F.xxhash64(*key).alias("h"))
        each = [F.when(complete(key), F.struct(F.lit(k).alias("k"), F.xxhash64(*key).alias("h"))) for k, key in enumerate(self.tables[name].keys)]
        return rows.select(F.explode(F.array_compact(F.array(*each))).alias("x")).select("x.k", "x.h")

    def _meeting(self, name: str, rows: DataFrame, m: Manifest, keys: str = "") -> list[str]:
        """Folders of a table that may hold a key of rows, by the hashes of their keys (keys: a folder of those of rows): 8 bytes for each row in place of its columns."""
        folders = m.tables.get(name, [])
        apart = self._apart(name, rows, m)
        known = [x for x in folders if x in m.keys and x not in apart]
        if not self.tables[name].keys:
            return folders
        met: set[str] = set()
        if known:
            there = self._read_hashes(m.keys[x] for x in known)
            new = self._read_hashes([keys]) if keys else self._hashes(rows, name)
            met = {r.folder for r in there.join(new.select("k", "h"), ["k", "h"], "left_semi").select("folder").distinct().collect()}
        return [x for x in folders if x in met or x not in m.keys]

    def _apart(self, name: str, rows: DataFrame, m: Manifest) -> set[str]:
        """Folders that can't hold a key of rows, as a zone column of each unique key lies apart from theirs: not even their hashes are read."""
        spec, zoned = self.tables[name], [x for x in m.tables.get(name, []) if x in m.zones]
        columns = sorted({c for key in spec.keys for c in key if c in spec.zones})
        if not zoned or not columns:
            return set()
        got = rows.agg(*(f(c).alias(f"{n} {c}") for c in columns for n, f in (("min", F.min), ("max", F.max)))).first()

        def apart(zone: list[Any] | None, c: str) -> bool:
            return zone is not None and got[f"max {c}"] is not None and (zone[1] < got[f"min {c}"] or got[f"max {c}"] < zone[0])

        return {x for x in zoned if all(any(apart(m.zones[x].get(c), c) for c in key) for key in spec.keys)}

    def _read_hashes(self, folders: Iterable[str]) -> DataFrame:
        return self.spark.read.schema(HASHES).parquet(*(f"{self.base}/{x}" for x in folders))

    def _distinct(self, keys: str) -> bool:
        """Whether the hashes in a folder of them all differ, and so the keys."""
        return not keys or self._read_hashes([keys]).groupBy("k", "h").count().filter("count > 1").isEmpty()

    def stage(self, df: DataFrame) -> DataFrame:
        """df written once and read again: what is counted, merged and looked at is then the same rows.  Kept until the next commit."""
        return self._staged_and_counted(df)[0]

    def _staged_and_counted(self, df: DataFrame) -> tuple[DataFrame, int]:
        path = f"{self.base}/_staging/{uuid.uuid4().hex}"
        self._staged.append(path)
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), seen.get["n"]

    def folders(self, name: str, folders: list[str], m: Manifest | None = None, placed: bool = False) -> DataFrame:
        """Rows of some folders of a table, without those that m says were replaced; placed: with file and row, their places."""
        schema = self.tables[name].schema
        if not folders:
            return self.spark.createDataFrame([], schema if not placed else T.StructType([*schema.fields, *PLACE.fields]))
        rows = self.spark.read.schema(schema).parquet(*(f"{self.base}/{x}" for x in folders))
        gone = m.gone.get(name) if m else None
        if not placed and not gone:
            return rows
        rows = rows.select("*", F.col("_metadata.file_name").alias("tw_file"), F.col("_metadata.row_index").alias("tw_row"))
        if gone:
            rows = rows.join(self.spark.read.schema(PLACE).parquet(*(f"{self.base}/{x}" for x in gone)), PLACE.names, "left_anti")
        return rows if placed else rows.drop(*PLACE.names)

    def table(self, name: str, m: Manifest | None = None) -> DataFrame:
        schema = self.tables[name].schema
        m = m or self.manifest()
        if name == "_source_state":
            rows = [(k, v, datetime.fromisoformat(m.saved[k]) if k in m.saved else None) for k, v in m.states.items()]
            return self.spark.createDataFrame(rows, schema)
        folders = m.tables.get(name, [])
        if name == "_runs" and m.running:
            rows = [(int(k), source, datetime.fromisoformat(at), "running") for k, (source, at) in m.running.items()]
            open_runs = self.spark.createDataFrame(rows, "id long, source string, started_at timestamp, status string")
            return self.folders(name, folders, m).unionByName(open_runs, allowMissingColumns=True)
        return self.folders(name, folders, m)

    def state(self, source: str) -> str:
        return self.manifest().states.get(source, "")

    def clear_state(self, source: str) -> None:
        m = self.manifest()
        m.saved.pop(source, None)
        if m.states.pop(source, None) is not None:
            m.number += 1
            self._publish(m)

    def start_run(self, source: str, at: datetime) -> int:
        """The id of a new run, which stands in _runs as running until finish_run()."""
        m = self.manifest()
        last = self.table("_runs", m).agg(F.max("id")).first()[0] or 0
        m.running[str(last + 1)] = [source, at.isoformat()]
        m.number += 1
        self._publish(m)
        return last + 1

    def finish_run(self, row: dict[str, Any]) -> None:
        m, schema = self.manifest(), self.tables["_runs"].schema
        m.running.pop(str(row["id"]), None)
        self._append("_runs", self.spark.createDataFrame([tuple(row[c] for c in schema.names)], schema), m)
        m.number += 1
        self._publish(m)

    def register(self) -> None:
        """Temporary views of all tables, for SQL."""
        m = self.manifest()
        for name in self.tables:
            self.table(name, m).createOrReplaceTempView(name)

    def commit(self, rows: dict[str, DataFrame], states: dict[str, str] | None = None, batch: tuple[str, int] | None = None, staged: Collection[str] = ()) -> dict[str, dict[str, int]]:
        """Merges rows into their tables by each table's policy and saves states, all at once.

        batch: (source, number); a number not over that source's last one was committed before and changes nothing.
        staged: tables whose rows come from stage() and have an ordinal; the others are staged here.
        Returns fetched, inserted and duplicates by table; a replaced row counts as inserted.
        """
        m = self.manifest()
        if batch and batch[1] <= m.batches.get(batch[0], -1):
            return {}
        counts: dict[str, dict[str, int]] = {}
        for name, df in rows.items():
            spec = self.tables[name]
            if name in staged:
                fetched = df.count()
                df = self._shaped(df, spec)
            else:  # parsed once, whatever is asked of it below
                df, fetched = self._staged_and_counted(with_ordinal(self._shaped(df, spec)))
            if not fetched:
                counts[name] = {"fetched": 0, "inserted": 0, "duplicates": 0}
                continue
            folders = m.tables.get(name, [])
            new = f"{name}/{uuid.uuid4().hex}"
            keys = self._keyed(name, df, new)  # the rows' keys are read once; their hashes are the new folder's if all rows are added
            met = self._meeting(name, df, m, keys)  # none of the others is read
            if not met and self._distinct(keys):  # nothing to decide: all rows are new, and none is shuffled
                added = df.drop(ORDINAL)
            else:
                added = POLICIES[spec.policy](self.folders(name, met, m) if met else None, df, spec.keys).appended
                if keys:
                    self._staged.append(f"{self.base}/{keys}")
                    keys = ""
            self._adopt(name, self._written(name, added, m, folder=new), m, keys)
            inserted = m.rows[new]
            if spec.policy == "replace" and met:
                self._replace(name, met, self.folders(name, [new]), m)
            elif not inserted:  # an empty folder says nothing
                m.tables[name] = folders
                m.rows.pop(new)
            counts[name] = {"fetched": fetched, "inserted": inserted, "duplicates": 0 if spec.policy == "replace" else fetched - inserted}
        m.states |= states or {}
        m.saved |= dict.fromkeys(states or {}, datetime.now(timezone.utc).isoformat())
        if batch:
            m.batches[batch[0]] = batch[1]
        m.number += 1
        self._publish(m)
        while self._staged:
            self._fs.delete(self._path(self._staged.pop()), True)
        return counts

    @staticmethod
    def _shaped(df: DataFrame, spec: Table) -> DataFrame:
        """The table's columns in order and type; columns that df lacks are null, an ordinal stays for the merge."""
        have = set(df.columns)
        extra = [c for c in (ORDINAL,) if c in have]
        return df.select(*(F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in spec.schema.fields), *extra)

    def _replace(self, name: str, folders: list[str], added: DataFrame, m: Manifest) -> None:
        """Notes the places of the rows whose key is among the added ones.  Files stay as they are; compact() takes such rows out.

        Once a table has notes in MOST_NOTES folders they are written as one.
        """
        (key,) = self.tables[name].keys
        placed = self.folders(name, folders, m, placed=True).select(*key, *PLACE.names)
        folder, seen = f"{name}/gone-{uuid.uuid4().hex}", Observation()
        placed.join(added.select(*key), key, "left_semi").select(*PLACE.names).observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.base}/{folder}")
        if not seen.get["n"]:
            return
        notes = [*m.gone.get(name, []), folder]
        if len(notes) > MOST_NOTES:
            together = f"{name}/gone-{uuid.uuid4().hex}"
            self.spark.read.schema(PLACE).parquet(*(f"{self.base}/{x}" for x in notes)).write.parquet(f"{self.base}/{together}")
            notes = [together]
        m.gone[name] = notes

    def compact(self, name: str) -> None:
        """Rewrites a table's folders as one, without replaced rows; serial numbers stay."""
        m = self.manifest()
        if len(m.tables.get(name, [])) > 1 or m.gone.get(name):
            folder = self._written(name, self.table(name, m), m, number=False)
            for x in m.tables[name]:
                for of in (m.rows, m.zones, m.keys):
                    of.pop(x, None)
            m.gone.pop(name, None)
            m.tables[name] = []
            self._adopt(name, folder, m)
            m.number += 1
            self._publish(m)
