"""Files written by tasks: a folder of parts that appears whole or not at all.

A task writes its rows to a file of its own under a name that no reader lists. The job's commit gives each its final name;
of a task that ran twice, only the attempt that Spark accepted is named. An abort, or a task that fails, leaves no part.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSourceWriter, WriterCommitMessage
from pyspark.taskcontext import TaskContext

from tandemlake.sources import files


@dataclass
class Written(WriterCommitMessage):
    number: int
    path: str
    rows: int


class PartWriter(DataSourceWriter):
    """Writes what ``encode`` makes of a task's rows; suffix: of the parts' names."""

    suffix = ""

    def __init__(self, path: str, overwrite: bool) -> None:
        self.path, self.overwrite, self.run = path.rstrip("/"), overwrite, uuid.uuid4().hex
        if not overwrite and files.listed_names(self.path, self.suffix):
            raise FileExistsError(f"{path} has parts already; overwrite it or choose another folder")

    def encode(self, rows: Iterator) -> Iterator[bytes]:
        raise NotImplementedError

    def write(self, iterator: Iterator) -> Written:
        context = TaskContext.get()
        number = context.partitionId() if context else 0
        path = f"{self.path}/_run-{self.run}/{number:05d}-{uuid.uuid4().hex}"
        rows = 0

        def counted() -> Iterator:
            nonlocal rows
            for row in iterator:
                rows += 1
                yield row

        try:
            with files.created(path) as out:
                for piece in self.encode(counted()):
                    out.write(piece)
        except BaseException:
            files.removed(path)
            raise
        return Written(number, path, rows)

    def commit(self, messages: list[Written | None]) -> None:
        if self.overwrite:
            for name in files.listed_names(self.path, self.suffix):
                files.removed(f"{self.path}/{name}")
        for m in messages:
            if m is not None:
                files.moved(m.path, f"{self.path}/part-{m.number:05d}{self.suffix}")
        files.removed_folder(f"{self.path}/_run-{self.run}")

    def abort(self, messages: list[Written | None]) -> None:
        files.removed_folder(f"{self.path}/_run-{self.run}")
