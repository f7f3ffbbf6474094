"""A sink for findings: rows as JSON lines, and a report that appears when all of them are there.

Tasks write their findings to files of their own, in batches, and hand the driver only
numbers by kind.  The commit puts the files in place, writes the report (ok, n_errors, the
numbers by kind, the given counts) and last a mark; an abort takes the files away.  So no
message is gathered anywhere, and what reads the mark reads a whole report.

    folder/findings/part-*.jsonl   {"kind", "subject", "message"} in each line
    folder/report.json             one JSON object
    folder/_COMMITTED              empty

The folder is a path or URI that Arrow's file systems know, the same for driver and
executors.  Writing again replaces what was there, when all of the new is there.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

MARK, REPORT, LINES = "_COMMITTED", "report.json", "findings"


@dataclass
class Written(WriterCommitMessage):
    """A task's file, and how many findings of each kind it holds."""

    name: str
    kinds: dict[str, int]


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    system, path = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("/") else folder.replace(":/", ":///", 1))
    return system, path.rstrip("/")


def there(system: fs.FileSystem, path: str) -> bool:
    return system.get_file_info(path).type != fs.FileType.NotFound


class ReportWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], names: list[str]):
        self.folder, self.counts = options["path"], json.loads(options.get("counts", "{}"))
        self.places = [names.index(n) for n in ("kind", "subject", "message")]
        self.pending = f"_pending-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = opened(self.folder)
        name, kinds = f"part-{uuid.uuid4().hex}.jsonl", Counter()
        system.create_dir(f"{folder}/{self.pending}")
        with system.open_output_stream(f"{folder}/{self.pending}/{name}") as out:
            for batch in iterator:
                kind, subject, message = (batch.column(i) for i in self.places)
                kinds.update({v["values"]: v["counts"] for v in pc.value_counts(kind).to_pylist()})
                each = zip(kind.to_pylist(), subject.to_pylist(), message.to_pylist(), strict=True)
                out.write("".join(json.dumps({"kind": k, "subject": s, "message": m}, ensure_ascii=False) + "\n" for k, s, m in each).encode("utf-8", "replace"))
        return Written(name, dict(kinds))

    def commit(self, messages: list[Written | None]) -> None:
        """Takes the old report's mark away first and sets the new one's last; files of failed attempts stay out."""
        system, folder = opened(self.folder)
        done = [m for m in messages if m is not None]
        kinds = sum((Counter(m.kinds) for m in done), Counter())
        for old in (MARK, REPORT):
            if there(system, f"{folder}/{old}"):
                system.delete_file(f"{folder}/{old}")
        if there(system, f"{folder}/{LINES}"):
            system.delete_dir(f"{folder}/{LINES}")
        system.create_dir(f"{folder}/{LINES}")
        for m in done:
            system.move(f"{folder}/{self.pending}/{m.name}", f"{folder}/{LINES}/{m.name}")
        report = {"ok": not kinds, "n_errors": sum(kinds.values()), "kinds": dict(sorted(kinds.items(), key=str)), "counts": self.counts}
        with system.open_output_stream(f"{folder}/{REPORT}") as out:
            out.write((json.dumps(report, ensure_ascii=False) + "\n").encode())
        system.open_output_stream(f"{folder}/{MARK}").close()
        self.clear(system, folder)

    def abort(self, messages: list[Written | None]) -> None:
        """What was there before stays as it is."""
        self.clear(*opened(self.folder))

    def clear(self, system: fs.FileSystem, folder: str) -> None:
        if there(system, f"{folder}/{self.pending}"):
            system.delete_dir(f"{folder}/{self.pending}")


class ReportSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "findings_report"

    def writer(self, schema: StructType, overwrite: bool) -> ReportWriter:
        return ReportWriter(self.options, schema.names)


def write_report(findings: DataFrame, counts: DataFrame | None, folder: str) -> None:
    """Writes findings (kind, subject, message) and the report on them; counts: one row of numbers."""
    spark = findings.sparkSession
    spark.dataSource.register(ReportSink)
    numbers = counts.first().asDict() if counts is not None else {}
    rows = findings.select("kind", "subject", "message")
    rows.write.format("findings_report").mode("append").option("counts", json.dumps(numbers)).save(folder)


def read_findings(spark, folder: str) -> DataFrame:
    """The findings of a report that was committed."""
    verdict(folder)
    return spark.read.schema("kind string, subject string, message string").json(f"{folder.rstrip('/')}/{LINES}")


def verdict(folder: str) -> dict:
    """The report; an error if none was committed."""
    system, path = opened(folder)
    if not there(system, f"{path}/{MARK}"):
        raise FileNotFoundError(f"no report was committed in {folder}")
    with system.open_input_stream(f"{path}/{REPORT}") as file:
        return json.loads(file.read())


def exit_code(folder: str) -> int:
    """0 if the report is clean, 1 if it has findings, 2 if none was committed."""
    try:
        return 0 if verdict(folder)["ok"] else 1
    except FileNotFoundError:
        return 2
