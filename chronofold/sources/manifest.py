"""What is live in a chunked table.

A table folder holds data and manifests::

    data/L<layout>/_gen=<n>/_run=<run>/_chunk=<start>/_until=<end>/[_h_<column>=<bucket>/]part-*.parquet
    manifest/chunks-<n>-<run>/*.parquet      one row per chunk folder
    manifest/state-<n>.json                  spec, schema, layouts; publishing this file is the commit

A job writes a new generation, checks it, and publishes the next state. Each writer has a run of its own in the names of
its folders, so writers that overlap never touch each other's files; the one that publishes second fails. What a failed
job leaves is named by no state, and :meth:`Table.purge` deletes it. The driver only ever sees manifest rows (one per chunk), never data rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofold.plans.spec import RollupSpec, TableSpec
from chronofold.sources.files import Folder

CHUNK_SCHEMA = T.StructType(
    [
        T.StructField("layout", T.IntegerType()),
        T.StructField("gen", T.IntegerType()),
        # As in the folder names.
        T.StructField("chunk", T.LongType()),
        T.StructField("until", T.LongType()),
        T.StructField("buckets", T.MapType(T.StringType(), T.IntegerType())),
        # The range that the chunk stands for; differs from the folder names only for merged chunks.
        T.StructField("lo", T.LongType()),
        T.StructField("hi", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("min_time", T.LongType()),
        T.StructField("max_time", T.LongType()),
        T.StructField("files", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("compressed", T.BooleanType()),
        # Version whose job last changed the chunk's rows, which rewriting does not; null in old tables: that of `gen`.
        T.StructField("since", T.LongType()),
        T.StructField(
            "stats",
            T.MapType(T.StringType(), T.StructType([T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType())])),
        ),
    ]
)


class TableError(RuntimeError):
    """An operation that the table's present state does not allow."""


@dataclass(frozen=True)
class State:
    spec: TableSpec
    schema: T.StructType
    layouts: tuple[tuple[tuple[str, int], ...], ...]
    version: int = 0
    # Version whose chunk rows are live; 0: none yet.
    chunks: int = 0
    # Everything below this position may have been dropped by retention.
    dropped_until: int | None = None
    rollup: RollupSpec | None = None
    # End of the highest stored bucket of a rollup.
    high_water: int | None = None
    # "layout/generation" -> number of chunk folders it was written with, and how many of them are live.
    folders: dict[str, tuple[int, int]] = field(default_factory=dict)
    # Version whose chunk rows were live before; readers that are under way may still use them.
    previous_chunks: int = 0
    # "layout/generation" and "chunks/version" of what is live or was before -> run of its writer; folders of old tables have none.
    runs: dict[str, str] = field(default_factory=dict)
    # (version, limit): at that version all chunks that end by the limit were dropped. Only the last of each higher limit.
    drops: tuple[tuple[int, int], ...] = ()
    # (low, high, version of the source): stretches of time that a rollup has taken in.
    covered: tuple[tuple[int, int, int], ...] = ()
    # Folders of the rollups built on this table.
    dependents: tuple[str, ...] = ()
    # Stream -> number of its last batch, and whether a rollup may have several rows for a bucket because of them.
    streams: dict[str, int] = field(default_factory=dict)
    split: bool = False

    @property
    def time_type(self) -> T.DataType:
        return self.schema[self.spec.time].dataType

    @property
    def layout(self) -> int:
        return len(self.layouts) - 1

    def with_dims(self, dims: dict[str, int]) -> State:
        wanted = tuple(dims.items())
        if self.layouts and self.layouts[-1] == wanted:
            return self
        return replace(self, layouts=(*self.layouts, wanted))

    def to_json(self) -> str:
        data = {
            "spec": self.spec.to_dict(),
            "schema": json.loads(self.schema.json()),
            "layouts": self.layouts,
            "version": self.version,
            "chunks": self.chunks,
            "dropped_until": self.dropped_until,
            "rollup": None if self.rollup is None else self.rollup.to_dict(),
            "high_water": self.high_water,
            "folders": self.folders,
            "previous_chunks": self.previous_chunks,
            "runs": self.runs,
            "drops": self.drops,
            "covered": self.covered,
            "dependents": self.dependents,
            "streams": self.streams,
            "split": self.split,
        }
        return json.dumps(data, indent=1)

    @classmethod
    def from_json(cls, text: str) -> State:
        data: dict[str, Any] = json.loads(text)
        rollup = data.pop("rollup")
        data |= {name: tuple(map(tuple, data.get(name, ()))) for name in ("drops", "covered")}
        data["dependents"] = tuple(data.get("dependents", ()))
        return cls(
            spec=TableSpec.from_dict(data.pop("spec")),
            schema=T.StructType.fromJson(data.pop("schema")),
            layouts=tuple(tuple((name, n) for name, n in dims) for dims in data.pop("layouts")),
            rollup=None if rollup is None else RollupSpec.from_dict(rollup),
            **data,
        )


def dim_column(name: str) -> str:
    return f"_h_{name}"


@dataclass(frozen=True)
class Table:
    spark: SparkSession
    path: str
    folder: Folder = field(repr=False)
    state: State
    # Names the folders that this writer makes.
    run: str = field(default_factory=lambda: f"r{uuid.uuid4().hex}", repr=False, compare=False)

    @classmethod
    def at(cls, spark: SparkSession, path: str) -> Table:
        folder = Folder(spark, path)
        versions = [n for n in folder.names("manifest") if n.startswith("state-") and n.endswith(".json")]
        if not versions:
            raise TableError(f"no chunked table at {path}")
        return cls(spark, folder.root, folder, State.from_json(folder.read_text(f"manifest/{max(versions)}")))

    @classmethod
    def new(cls, spark: SparkSession, path: str, state: State) -> Table:
        folder = Folder(spark, path)
        if any(n.startswith("state-") for n in folder.names("manifest")):
            raise TableError(f"there is already a chunked table at {path}")
        return cls(spark, folder.root, folder, state)

    @property
    def next_version(self) -> int:
        return self.state.version + 1

    def dims(self, layout: int) -> list[str]:
        return [name for name, _ in self.state.layouts[layout]]

    def partition_columns(self, layout: int) -> list[str]:
        return ["_chunk", "_until", *[dim_column(name) for name in self.dims(layout)]]

    def run_of(self, kind: int | str, version: int) -> str | None:
        """The run that wrote a live generation of a layout, or live "chunks"; what comes next is this writer's own."""
        return self.run if version == self.next_version else self.state.runs.get(f"{kind}/{version}")

    def generation(self, layout: int, gen: int) -> str:
        run = self.run_of(layout, gen)
        return f"data/L{layout}/_gen={gen}" + (f"/_run={run}" if run else "")

    def chunks_folder(self, version: int) -> str:
        run = self.run_of("chunks", version)
        return f"manifest/chunks-{version:08d}" + (f"-{run}" if run else "")

    def folders_written(self, layout: int, gen: int) -> int:
        return self.state.folders[f"{layout}/{gen}"][0]

    def generations(self) -> list[tuple[int, int, bool]]:
        """(layout, generation, whether all its chunk folders are live) of everything live."""
        keys = [(*map(int, key.split("/")), written == live) for key, (written, live) in self.state.folders.items()]
        return sorted(keys)

    def chunks(self, version: int | None = None) -> DataFrame:
        """The live chunks, one row per chunk folder."""
        version = self.state.chunks if version is None else version
        if version == 0:
            return self.spark.createDataFrame([], CHUNK_SCHEMA)
        return self.spark.read.schema(CHUNK_SCHEMA).parquet(self.folder.url(self.chunks_folder(version)))

    def refuse_if_published(self) -> None:
        """A writer whose version somebody else has published has lost, also when that state is deleted already."""
        names = [n for n in self.folder.names("manifest") if n.startswith("state-") and n.endswith(".json")]
        if any(n >= f"state-{self.next_version:08d}.json" for n in names):
            raise TableError(f"version {self.next_version} of {self.folder.root} was published by another writer")

    def write_chunks(self, chunks: DataFrame) -> DataFrame:
        """Write the chunk rows of the next version; they go live with :meth:`publish`."""
        self.refuse_if_published()
        rows = chunks.select(*CHUNK_SCHEMA.names)
        rows.write.mode("errorifexists").parquet(self.folder.url(self.chunks_folder(self.next_version)))
        return self.chunks(self.next_version)

    def publish(self, new_chunks: bool = False, **changes: Any) -> Table:
        """Make the next version live."""
        self.refuse_if_published()
        version = self.next_version
        state = replace(self.state, version=version, **changes)
        if new_chunks:
            state = replace(state, chunks=version, previous_chunks=self.state.chunks)
            named = {f"{kind}/{n}": self.run_of(kind, n) for kind, n in (key.split("/") for key in state.folders) for n in [int(n)]}
            named |= {f"chunks/{n}": self.run_of("chunks", n) for n in (version, self.state.chunks)}
            state = replace(state, runs={key: run for key, run in named.items() if run})
        if not self.folder.publish_text(f"manifest/state-{version:08d}.json", state.to_json()):
            raise TableError(f"another writer published version {version} of {self.path}")
        # The version before stays for readers that are under way.
        if version > 2:
            self.folder.delete(f"manifest/state-{version - 2:08d}.json")
        if new_chunks and self.state.previous_chunks:
            self.folder.delete(self.chunks_folder(self.state.previous_chunks))
        return replace(self, state=state)

    def discard(self, replaced: Sequence[Row]) -> None:
        """Delete the folders of chunks that the live manifest no longer names."""
        generations: dict[tuple[int, int], list[Row]] = {}
        for row in replaced:
            generations.setdefault((row["layout"], row["gen"]), []).append(row)
        for (layout, gen), rows in generations.items():
            if f"{layout}/{gen}" not in self.state.folders:
                self.folder.delete(f"data/L{layout}/_gen={gen}")
            else:
                for row in rows:
                    self.folder.delete(self.chunk_folder(layout, gen, row))

    def purge(self) -> None:
        """Delete data folders that no live chunk uses, and manifests of earlier versions."""
        live = {(layout, gen): whole for layout, gen, whole in self.generations()}
        for layout_name in self.folder.names("data"):
            layout = int(layout_name[1:])
            for gen_name in self.folder.names(f"data/{layout_name}"):
                gen = int(gen_name.split("=")[1])
                if gen > self.state.version:
                    continue
                if (layout, gen) not in live:
                    self.folder.delete(f"data/{layout_name}/{gen_name}")
                    continue
                run = self.run_of(layout, gen)
                for name in self.folder.names(f"data/{layout_name}/{gen_name}"):
                    if name != f"_run={run}" and (run or name.startswith("_run=")):
                        self.folder.delete(f"data/{layout_name}/{gen_name}/{name}")
                if not live[layout, gen]:
                    self._purge_chunks(layout, gen)
        live_chunks = self.chunks_folder(self.state.chunks).split("/")[1]
        for name in self.folder.names("manifest"):
            number = int(name.split(".")[0].split("-")[1])
            old_state = name.startswith("state-") and number < self.state.version
            old_chunks = name.startswith("chunks-") and number <= self.state.version and name != live_chunks
            if old_state or old_chunks:
                self.folder.delete(f"manifest/{name}")

    def _purge_chunks(self, layout: int, gen: int) -> None:
        rows = self.chunks().where((F.col("layout") == layout) & (F.col("gen") == gen)).select("chunk", "until", "buckets")
        live = {self.chunk_folder(layout, gen, row) for row in rows.collect()}
        dead = [self.generation(layout, gen)]
        for _ in self.partition_columns(layout):
            dead = [f"{parent}/{name}" for parent in dead for name in self.folder.names(parent) if "=" in name]
        for name in dead:
            if name not in live:
                self.folder.delete(name)

    def chunk_folder(self, layout: int, gen: int, row: Row) -> str:
        parts = [self.generation(layout, gen), f"_chunk={row['chunk']}", f"_until={row['until']}"]
        parts += [f"{dim_column(name)}={row['buckets'][name]}" for name in self.dims(layout)]
        return "/".join(parts)
