"""Tables as directories of published Parquet batches.

``<root>/<table>/b<number>`` holds the files of one load. A batch counts once it has a
``_PUBLISHED`` file, which names the batches it takes the place of: none for an append, all for a
replace, for an upsert those it rewrote, or single files of them (``batch/file``). So a load is written first, audited, then made visible in
one step; a failed or refused load leaves nothing visible, and a repeated one that names its batch
is recognised. One writer per table is assumed.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources import storage

MARKER = "_PUBLISHED"
# Lines of a marker: all of them.
WHOLE = (1 << 31) - 1

# Aggregates to observe on the frame that is written.
Metrics = Callable[[DataFrame], Sequence[Column]]


@dataclass
class Batch:
    """One written, possibly not yet published, load."""

    table: str
    path: str
    rows: int
    counters: dict = field(default_factory=dict)
    replaces: Sequence[str] = ()
    published: bool = False


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        # By path; what is published does not change any more.
        self._schemas: dict[str, T.StructType] = {}
        self._replaced: dict[str, list[str]] = {}

    def _published(self, name: str) -> tuple[list[str], set[str]]:
        """All published batches of a table, and which of them others have taken the place of."""
        base = f"{self.root}/{name}"
        markers = storage.glob_sizes(self.spark, f"{base}/*/{MARKER}")
        full = [f"{base}/{m}" for m, size in markers.items() if size]
        unread = [m for m in full if m not in self._replaced]
        self._replaced.update(storage.head_lines(self.spark, unread, WHOLE))
        gone = {batch for m in full for batch in self._replaced[m]}
        return [m.split("/")[0] for m in markers], gone

    def batches(self, name: str) -> list[str]:
        """Names of the batches that make up a table."""
        published, gone = self._published(name)
        return [b for b in published if b not in gone]

    def exists(self, name: str) -> bool:
        return bool(self.batches(name))

    def tables(self) -> list[str]:
        """Names of all tables with a published batch."""
        return sorted({m.split("/")[0] for m in storage.glob_sizes(self.spark, f"{self.root}/*/*/{MARKER}")})

    def table(self, name: str, batches: Sequence[str] | None = None, without: Sequence[str] = ()) -> DataFrame:
        """A table, or some of its batches, ``without`` what a batch that is not yet published replaces."""
        chosen = self.batches(name) if batches is None else [b for b in batches if b not in without]
        if not chosen:
            raise ValueError(f"table {name} does not exist")
        gone, paths = self.gone_files(name, without), []
        for b in chosen:
            folder = f"{self.root}/{name}/{b}"
            left = [f for f in storage.glob_files(self.spark, folder) if f.rsplit("/", 1)[1] not in gone[b]] if b in gone else [folder]
            paths += left
        first = f"{self.root}/{name}/{chosen[0]}"
        if not paths:
            return self.spark.createDataFrame([], self._schema(first))
        return self._read(paths, first)

    def gone_files(self, name: str, without: Sequence[str] = ()) -> dict[str, set[str]]:
        """Of batches that are only replaced in part, the files that are."""
        found: dict[str, set[str]] = {}
        for entry in {*self._published(name)[1], *without}:
            batch, _, file = entry.partition("/")
            if file:
                found.setdefault(batch, set()).add(file)
        return found

    def entry_names(self, name: str, batch: str, files: set[str]) -> list[str]:
        """Files of a batch as ``batch/file``, or the batch if these are all that it has left."""
        gone = self.gone_files(name).get(batch, set())
        own = {f.rsplit("/", 1)[1] for f in storage.glob_files(self.spark, f"{self.root}/{name}/{batch}")} - gone
        return [f"{batch}/{f}" for f in files] if own - files else [batch]

    def entries(self, name: str, entries: Sequence[str]) -> DataFrame:
        """The rows of batches or files, also of those that others have just taken the place of."""
        gone, paths = self.gone_files(name), []
        for entry in entries:
            path = f"{self.root}/{name}/{entry}"
            if entry in gone:  # a batch that had lost files before
                paths += [f for f in storage.glob_files(self.spark, path) if f.rsplit("/", 1)[1] not in gone[entry]]
            else:
                paths.append(path)
        return self._read(paths, f"{self.root}/{name}/{entries[0].split('/')[0]}")

    def _schema(self, path: str) -> T.StructType:
        if path not in self._schemas:
            self._schemas[path] = self.spark.read.parquet(path).schema
        return self._schemas[path]

    def _read(self, paths: Sequence[str], like: str | None = None) -> DataFrame:
        """All batches of a table have the schema of its first one."""
        return self.spark.read.schema(self._schema(like or paths[0])).parquet(*paths)

    def view(self, name: str) -> None:
        self.table(name).createOrReplaceTempView(name)

    def read_batch(self, batch: Batch) -> DataFrame:
        return self._read([batch.path])

    def has_batch(self, name: str, tag: str) -> bool:
        """Whether a batch of this name was ever published, also if it has been rewritten or removed since.

        Names of micro-batches end in ``_<number>``; of each stream the last one removed is kept.
        """
        if any(b.partition("-")[2] == tag for b in self._published(name)[0]):
            return True
        stream, _, number = tag.rpartition("_")
        return bool(stream) and number.isdigit() and int(number) <= self._marks(name).get(stream, -1)

    def _marks(self, name: str) -> dict[str, int]:
        """Of each stream into a table the last micro-batch that was vacuumed."""
        found: dict[str, int] = {}
        for mark in storage.list_dirs(self.spark, f"{self.root}/_marks_{name}"):
            stream, _, number = mark.rpartition("_")
            found[stream] = max(int(number), found.get(stream, -1))
        return found

    def write(
        self,
        name: str,
        df: DataFrame,
        replace: bool | Sequence[str] = False,
        tag: str | None = None,
        metrics: Metrics | None = None,
    ) -> Batch:
        """Write a batch without publishing it; it is to replace the whole table, or some batches.

        The row count and ``metrics`` are observed on the frame that is written, in the writing
        stage itself, so a task that is run again is still counted once.
        """
        base = f"{self.root}/{name}"
        used = storage.list_dirs(self.spark, base)
        number = int(used[-1][1:9]) + 1 if used else 1
        path = f"{base}/b{number:08d}" + (f"-{tag}" if tag else "")
        seen = Observation()
        self._schemas[path] = df.schema
        df.observe(seen, F.count(F.lit(1)).alias("rows"), *(metrics(df) if metrics else [])).write.parquet(path)
        got = dict(seen.get)
        replaces = (self.batches(name) if replace else []) if isinstance(replace, bool) else list(replace)
        return Batch(name, path, got.pop("rows"), got, replaces)

    def publish(self, batch: Batch) -> Batch:
        storage.put_text(self.spark, f"{batch.path}/{MARKER}", "\n".join(batch.replaces))
        batch.published = True
        return batch

    def discard(self, batch: Batch) -> None:
        """Remove the files of a batch that was never published."""
        if not batch.published:
            storage.delete_tree(self.spark, batch.path)

    def stage(self, name: str, df: DataFrame, metrics: Metrics | None = None) -> Batch:
        """Materialise a batch once, so that the passes of a load do not redo its source."""
        return self.write(f"_stage_{name}", df, metrics=metrics)

    def compact(self, name: str) -> Batch:
        """Rewrite a table of many small batches as one."""
        return self.publish(self.write(name, self.table(name).hint("rebalance"), replace=True))

    def vacuum(self, name: str) -> int:
        """Remove the batches and files others took the place of, oldest first; no reader may still use them."""
        published, gone = self._published(name)
        old = [b for b in published if b in gone]
        marks = self._marks(name)
        # Files go before the batches whose markers name them.
        for batch, files in self.gone_files(name).items():
            if batch not in old:
                for file in files:
                    storage.delete_tree(self.spark, f"{self.root}/{name}/{batch}/{file}")
        for batch in old:
            stream, _, number = batch.partition("-")[2].rpartition("_")
            if stream and number.isdigit() and int(number) > marks.get(stream, -1):
                # The new mark stands before the old one goes.
                storage.make_dir(self.spark, f"{self.root}/_marks_{name}/{stream}_{number}")
                if stream in marks:
                    storage.delete_tree(self.spark, f"{self.root}/_marks_{name}/{stream}_{marks[stream]}")
                marks[stream] = int(number)
            storage.delete_tree(self.spark, f"{self.root}/{name}/{batch}")
        return len(old)

    def sweep(self, older_hours: float = 24) -> int:
        """Remove what crashed loads left: staged batches, and batches never published, untouched for some hours."""
        before, swept = (time.time() - 3600 * older_hours) * 1000, 0
        for name in storage.list_dirs(self.spark, self.root):
            if name.startswith("_marks_"):
                continue
            published = set() if name.startswith("_stage_") else set(self._published(name)[0])
            for batch in set(storage.list_dirs(self.spark, f"{self.root}/{name}")) - published:
                path = f"{self.root}/{name}/{batch}"
                if storage.last_change(self.spark, path) <= before:
                    storage.delete_tree(self.spark, path)
                    swept += 1
        return swept
