"""Tables that change together: one commit per batch over several tables, visible as a whole.

A batch first writes its rows into new folders, which nobody reads, and then its manifest, one small file that names them.
The manifest appears by a rename, so a reader sees all of a batch or nothing, whatever was killed in between; a batch
whose manifest exists is not done again, so a replay changes nothing.

Two kinds of table:

* appended tables (history): every batch adds a folder;
* keyed tables (one live row per key): rows lie in ``buckets`` folders by the hash of the key. A batch reads the buckets
  that its keys fall into, merges, and writes new versions of those alone, so its cost follows its own size and not the
  table's. The manifest names the new version of each touched bucket.

Readers take the newest version of each bucket and every appended folder, by explicit path and schema. ``compact`` folds
the manifests into one and ``vacuum`` removes folders that no manifest names any more. One writer at a time, as a stream
has; readers need no lock.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Merge = Callable[[DataFrame, Sequence[str]], DataFrame]

#: Where a row of a keyed table lies: its bucket, and its part of that while a batch is merged.
PLACE = ["bucket", "part"]
PARTS = 16


@dataclass(frozen=True)
class Keyed:
    """A keyed table: where its rows lie and how a batch's rows meet the stored ones.

    ``merge(rows, place)`` returns the live rows of the touched buckets from the stored and the new ones; ``place`` are
    columns that follow from the key, which it groups by as well and keeps, so that rows laid out by them are not moved
    again. ``bucket_by`` (default: the keys) is the part of the key that readers ask for."""
    schema: str
    keys: Sequence[str]
    merge: Merge
    bucket_by: Sequence[str] | None = None
    buckets: int = 32

    def bucket(self):
        return F.pmod(F.xxhash64(*(self.bucket_by or self.keys)), F.lit(self.buckets)).cast("int")

    def placed(self, rows: DataFrame) -> DataFrame:
        """``rows`` with their ``PLACE``; a bucket's parts spread its keys over several tasks."""
        part = F.pmod(F.xxhash64(F.lit("part"), *self.keys), F.lit(PARTS)).cast("int")
        return rows.select("*", self.bucket().alias("bucket"), part.alias("part"))


def newest_wins(keys: Sequence[str], order: str) -> Merge:
    """Of each key the row with the greatest ``order``; of several such rows the greatest in all columns."""
    def merge(rows: DataFrame, place: Sequence[str]) -> DataFrame:
        rest = [c for c in rows.columns if c not in (*keys, *place) and c != order]
        top = rows.groupBy(*place, *keys).agg(F.max(F.struct(order, *rest)).alias("r"))
        return top.select(*place, *keys, "r.*").select(*rows.columns)
    return merge


def added_up(keys: Sequence[str], sums: Sequence[str]) -> Merge:
    """Signed deltas are added to the stored totals; NULL keys are keys like others."""
    def merge(rows: DataFrame, place: Sequence[str]) -> DataFrame:
        return rows.groupBy(*place, *keys).agg(*[F.sum(c).alias(c) for c in sums])
    return merge


def shaped(df: DataFrame, schema: str) -> DataFrame:
    """The columns of ``schema`` in its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in T._parse_datatype_string(schema)])


class BatchStore:
    def __init__(self, spark: SparkSession, root: str, appended: dict[str, str], keyed: dict[str, Keyed] | None = None):
        """``appended``: schema by table name; ``keyed``: keyed tables by name. ``root`` lies on shared storage."""
        self.spark, self.root, self.appended, self.keyed = spark, root.rstrip("/"), appended, keyed or {}

    # ---- files: only names and manifests, never rows

    def _fs(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def _names(self, folder: str) -> list[str]:
        fs, path = self._fs()
        at = path(os.path.join(self.root, folder))
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def _put(self, name: str, entries: list[dict]) -> bool:
        """Make a manifest appear as a whole; False if it is there already."""
        fs, path = self._fs()
        final, tmp = path(f"{self.root}/commits/{name}"), path(f"{self.root}/commits/.{uuid.uuid4().hex}")
        if fs.exists(final):
            return False
        out = fs.create(tmp, False)
        out.write(bytearray("\n".join(map(json.dumps, entries)).encode()))
        out.close()
        return fs.rename(tmp, final)

    def _manifests(self) -> list[str]:
        """The manifests that count: the newest fold and the batches after it."""
        names = [n for n in self._names("commits") if not n.startswith(".")]
        folds = [n for n in names if n.startswith("upto-")]
        since = int(folds[-1][5:-5]) if folds else -1
        return folds[-1:] + [n for n in names if n.startswith("batch-") and int(n[6:-5]) > since]

    def entries(self) -> list[dict]:
        """What the manifests name: batch, table, bucket (None for appended tables), path; one per folder."""
        names = self._manifests()
        if not names:
            return []
        rows = self.spark.read.schema("batch long, table string, bucket int, path string").json(
            [f"{self.root}/commits/{n}" for n in names]).where("path IS NOT NULL").collect()
        return [r.asDict() for r in rows]

    def committed(self, batch: int) -> bool:
        names = self._names("commits")
        return f"batch-{batch:020d}.json" in names or any(
            n.startswith("upto-") and int(n[5:-5]) >= batch for n in names)

    # ---- reading

    def _rows(self, paths: list[str], schema: str) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{p}" for p in paths])

    def read(self, table: str, keys: DataFrame | None = None) -> DataFrame:
        """The table as of the last commit. ``keys``: of a keyed table, only the buckets of these keys are read (its
        distinct buckets come to the driver, at most ``buckets`` numbers); filter or join by key afterwards."""
        found = [e for e in self.entries() if e["table"] == table]
        if table in self.appended:
            return self._rows([e["path"] for e in found], self.appended[table])
        spec = self.keyed[table]
        live = self._live(found)
        if keys is not None:
            wanted = {r[0] for r in keys.select(spec.bucket().alias("b")).distinct().collect()}
            live = {b: p for b, p in live.items() if b in wanted}
        return self._rows(list(live.values()), spec.schema)

    @staticmethod
    def _live(entries: list[dict]) -> dict[int, str]:
        return {e["bucket"]: e["path"] for e in sorted(entries, key=lambda e: e["batch"])}

    # ---- writing

    def commit(self, batch: int, rows: dict[str, DataFrame]) -> bool:
        """Write ``rows`` (by table) as batch ``batch`` and make them visible at once. False, and nothing done, if the
        batch has been committed before."""
        if self.committed(batch):
            return False
        attempt, before = uuid.uuid4().hex, self.entries()

        def write(table: str) -> list[dict]:
            folder = f"{table}/{batch:020d}-{attempt}"
            if table in self.appended:
                self.stage(shaped(rows[table], self.appended[table]), folder)
                return [{"batch": batch, "table": table, "bucket": None, "path": folder}]
            spec = self.keyed[table]
            new = self.spark.read.schema(spec.schema).parquet(self.stage(shaped(rows[table], spec.schema), f"{folder}-new"))
            touched = sorted(r[0] for r in new.select(spec.bucket().alias("b")).distinct().collect())
            live = self._live([e for e in before if e["table"] == table])
            old = self._rows([live[b] for b in touched if b in live], spec.schema)
            # stored and new rows move once, to their place; they are merged, sorted and written there
            merged = spec.merge(spec.placed(old.unionByName(new)).repartition(*PLACE), PLACE)
            columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in T._parse_datatype_string(spec.schema)]
            (merged.select(*columns, "bucket").sortWithinPartitions("bucket", *spec.keys)
             .write.option("compression", "zstd").partitionBy("bucket").parquet(f"{self.root}/{folder}"))
            return [{"batch": batch, "table": table, "bucket": b, "path": f"{folder}/bucket={b}"} for b in touched]

        with ThreadPoolExecutor(len(rows)) as pool:  # the tables of a batch are written side by side
            entries = [e for found in pool.map(write, rows) for e in found]
        return self._put(f"batch-{batch:020d}.json", entries)

    def stage(self, df: DataFrame, folder: str) -> str:
        """Write ``df`` where no manifest names it, for steps that read it several times; ``vacuum`` removes it."""
        df.write.option("compression", "zstd").parquet(f"{self.root}/{folder}")
        return f"{self.root}/{folder}"

    # ---- upkeep

    def compact(self) -> None:
        """Fold all manifests into one; of keyed tables only the live buckets stay named."""
        found = self.entries()
        if not found:
            return
        kept = [e for e in found if e["bucket"] is None]
        for table in self.keyed:
            own = [e for e in found if e["table"] == table]
            live = set(self._live(own).values())
            kept += [e for e in own if e["path"] in live]
        last = max(int(n[6:-5]) if n.startswith("batch-") else int(n[5:-5]) for n in self._manifests())
        self._put(f"upto-{last:020d}.json", kept)

    def vacuum(self) -> int:
        """Delete what no counted manifest names: folders of failed attempts, staged rows, old bucket versions, folded
        manifests. Not while a batch is being written. Returns the number of deleted folders and files."""
        fs, path = self._fs()
        named = {e["path"] for e in self.entries()}
        gone = 0
        for table in [*self.appended, *self.keyed]:
            for name in self._names(table):
                folder = f"{table}/{name}"
                if folder in named:
                    continue
                if any(p.startswith(f"{folder}/") for p in named):  # some of its buckets are live
                    old = [f"{folder}/{n}" for n in self._names(folder) if n.startswith("bucket=") and f"{folder}/{n}" not in named]
                else:
                    old = [folder]
                for p in old:
                    gone += fs.delete(path(f"{self.root}/{p}"), True)
        counted = set(self._manifests())
        for name in self._names("commits"):
            if name not in counted:
                gone += fs.delete(path(f"{self.root}/commits/{name}"), False)
        return gone
