"""A file tree as a DataFrame, hidden names included.

Spark's own binary source drops files and folders whose names begin with a dot or an
underscore, so this is a Python data source.  The root must be visible to the executors.

Columns: path (relative to the root, with slashes), is_file, size (bytes), at, content.  A
file larger than `part` bytes is several rows: `at` is where a row's bytes begin, and but
for the last each also holds the first `overlap` bytes of the next, so that what is at most
that long stands whole in one of them.  Folders have no size, at and content.

Only columns that are asked for are looked up: without size and content no file is touched,
and without content none is opened.  Filters on path and is_file are applied while listing;
of those that fix how a path begins the walk makes use, too, as it does of `skip` and
`bases`: what they rule out is never entered.

The driver lists a few levels, until there are enough folders to go round; what lies deeper
is listed by tasks.  If contents are asked for and folders are few, or one holds very many
files, several tasks share them: each lists them, and every part of a file is read by one.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringContains, StringEndsWith, StringStartsWith
from pyspark.sql.types import StructType

SCHEMA = "path string, is_file boolean, size long, at long, content binary"
KINDS = {"path": pa.string(), "is_file": pa.bool_(), "size": pa.int64(), "at": pa.int64(), "content": pa.binary()}
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
PART, OVERLAP = 64 << 20, 4096
#: A batch has at most so many rows, and ends after so many bytes of content.
ROWS, BYTES = 4096, 16 << 20
#: So many of a folder's files are worth a task; no folder is listed by more tasks than SHARES for other reasons.
FILES, SHARES = 10_000, 16


class Share(InputPartition):
    """Some folders, with everything below them or their own entries only; of these the k-th of n shares."""

    def __init__(self, folders: list[str], deep: bool, k: int, n: int):
        self.folders, self.deep, self.k, self.n = folders, deep, k, n


class Starts:
    """How paths begin: with one of some texts, or as one of some paths."""

    def __init__(self, heads: list[str], whole: bool):
        self.heads, self.whole = heads, whole

    def below(self, folder: str) -> bool:
        """Whether such a path can lie in the folder."""
        own = folder + "/"
        return any(h.startswith(own) or (not self.whole and own.startswith(h)) for h in self.heads)


class TreeReader(DataSourceReader):
    def __init__(self, options: dict[str, str], names: list[str]):
        self.root, self.names = os.path.abspath(options["path"]), names
        self.levels, self.tasks = int(options.get("levels", "3")), int(options.get("tasks", "64"))
        self.part, self.overlap = int(options.get("part", PART)), int(options.get("overlap", OVERLAP))
        self.skip = set(json.loads(options.get("skip", "[]")))
        self.tests: list[Callable[[str, bool], bool]] = []
        self.starts: list[Starts] = []
        if bases := json.loads(options.get("bases", "[]")):
            self.tests.append(lambda path, _: any(path == b or path.startswith(b + "/") for b in bases))
            self.starts.append(Starts([b + "/" for b in bases], False))

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if not self.takes(f):
                yield f

    def takes(self, f: Filter) -> bool:
        """Takes a filter on path or is_file over, if it is of a kind that names alone decide."""
        column, value = f.attribute, getattr(f, "value", None)
        if isinstance(f, IsNotNull):
            return column in (("path",), ("is_file",))
        if column == ("is_file",) and isinstance(f, EqualTo):
            self.tests.append(lambda _, is_file: is_file == value)
        elif column == ("path",) and isinstance(f, EqualTo | In):
            wanted = set(value) if isinstance(f, In) else {value}
            self.tests.append(lambda path, _: path in wanted)
            self.starts.append(Starts([v for v in wanted if v is not None], True))
        elif column == ("path",) and isinstance(f, StringStartsWith):
            self.tests.append(lambda path, _: path.startswith(value))
            self.starts.append(Starts([value], False))
        elif column == ("path",) and isinstance(f, StringEndsWith):
            self.tests.append(lambda path, _: path.endswith(value))
        elif column == ("path",) and isinstance(f, StringContains):
            self.tests.append(lambda path, _: value in path)
        else:
            return False
        return True

    def enters(self, folder: str) -> bool:
        return folder.rpartition("/")[2] not in self.skip and all(s.below(folder) for s in self.starts)

    def partitions(self) -> list[Share]:
        shallow: dict[str, int] = {}
        deep = [""]
        for _ in range(self.levels):
            if not deep or len(deep) >= self.tasks:
                break
            below = []
            for folder in deep:
                files = 0
                for own, entry in self.entries(folder):
                    if not entry.is_dir(follow_symlinks=False):
                        files += 1
                    elif self.enters(own):
                        below.append(own)
                shallow[folder] = files
            deep = below
        reads = "content" in self.names
        large = [f for f, n in shallow.items() if reads and n > FILES]
        small = [f for f in shallow if f not in large]
        bundles = [([f], False, -(-shallow[f] // FILES)) for f in large]
        groups = [(x, d) for folders, d in ((small, False), (deep, True)) for x in self.dealt(folders)]
        shares = min(SHARES, max(1, self.tasks // max(1, len(groups)))) if reads else 1
        bundles += [(x, d, shares) for x, d in groups]
        return [Share(x, d, k, n) for x, d, n in bundles for k in range(n)]

    def dealt(self, folders: list[str]) -> list[list[str]]:
        """The folders in at most `tasks` groups."""
        n = min(len(folders), self.tasks)
        return [folders[k::n] for k in range(n)]

    def entries(self, folder: str) -> Iterator[tuple[str, os.DirEntry]]:
        with os.scandir(os.path.join(self.root, folder)) as found:
            for entry in found:
                yield f"{folder}/{entry.name}" if folder else entry.name, entry

    def rows(self, share: Share) -> Iterator[tuple[str, bool, int | None, int | None, bytes | None]]:
        size, content = "size" in self.names or "content" in self.names, "content" in self.names
        mine = lambda own, k: share.n == 1 or zlib.crc32(f"{own}:{k}".encode()) % share.n == share.k
        waiting = list(share.folders)
        while waiting:
            for own, entry in self.entries(waiting.pop()):
                is_file = entry.is_file()
                if share.deep and not is_file and entry.is_dir(follow_symlinks=False) and self.enters(own):
                    waiting.append(own)
                if not all(test(own, is_file) for test in self.tests):
                    continue
                if not is_file:
                    if mine(own, 0):
                        yield own, False, None, None, None
                    continue
                n = entry.stat().st_size if size else None
                for k in range(max(1, -(-n // self.part)) if content else 1):
                    if mine(own, k):
                        yield own, True, n, k * self.part, self.bytes(entry.path, k) if content else None

    def bytes(self, path: str, k: int) -> bytes:
        with open(path, "rb") as file:
            file.seek(k * self.part)
            return file.read(self.part + self.overlap)

    def read(self, share: Share) -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[] for _ in self.names]
        kinds, held = [KINDS[n] for n in self.names], 0
        places = [list(KINDS).index(n) for n in self.names]
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], self.names)
        for row in self.rows(share):
            for column, at in zip(columns, places, strict=True):
                column.append(row[at])
            held += len(row[4] or b"")
            if len(columns[0]) >= ROWS or held >= BYTES:
                yield batch()
                columns, held = [[] for _ in self.names], 0
        if columns[0]:
            yield batch()


class TreeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "filetree"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> TreeReader:
        return TreeReader(self.options, schema.names)


def read_tree(
    spark: SparkSession, root: str, levels: int = 3, columns: tuple[str, ...] = ("path", "is_file", "size", "at", "content"), skip: list[str] = (), bases: list[str] = (), part: int = PART, overlap: int = OVERLAP
) -> DataFrame:
    """Files and folders below root, with the columns asked for.

    skip: names of folders that are shown but not entered.  bases: folders, relative to root,
    outside which nothing is looked at.  Switches filters of Python sources on for the session.
    """
    spark.dataSource.register(TreeSource)
    spark.conf.set(PUSHDOWN, "true")
    kinds = dict(c.split(" ") for c in SCHEMA.split(", "))
    options = {"levels": levels, "tasks": 2 * spark.sparkContext.defaultParallelism, "skip": json.dumps(list(skip)), "bases": json.dumps([b.strip("/") for b in bases]), "part": part, "overlap": overlap}
    return spark.read.format("filetree").schema(", ".join(f"{c} {kinds[c]}" for c in columns)).options(**options).load(root)


def literal(spark: SparkSession, column: str, values: list[str]) -> DataFrame:
    """A constant one-column relation."""
    return spark.createDataFrame([(v,) for v in values], f"{column} string")


def depth(path: str = "path") -> Column:
    """How many names a path has."""
    return F.size(F.split(path, "/"))


def below(base: str, levels: int, ending: str, path: str = "path") -> Column:
    """Paths exactly `levels` names below base (below the root, if it is empty), the last of which ends so."""
    base = base.rstrip("/")
    head, names = (base + "/", len(base.split("/"))) if base else ("", 0)
    return F.startswith(F.col(path), F.lit(head)) & (depth(path) == names + levels) & F.endswith(F.col(path), F.lit(ending))


def without(folders: list[str], suffixes: list[str] = (), names: list[str] = (), path: str = "path") -> Column:
    """Paths with none of these folders or names on them, and none of these suffixes."""
    parts = F.split(path, "/")
    name = F.element_at(parts, -1)
    out = ~F.arrays_overlap(parts, F.array(*map(F.lit, folders))) if folders else F.lit(True)
    for s in suffixes:
        out = out & ~(F.endswith(name, F.lit(s)) & (F.length(name) > len(s)))
    return out & ~name.isin(list(names)) if names else out


def other_than(own: str, path: str = "path") -> Column:
    """Every path but this one."""
    return F.col(path).cast("string") != own
