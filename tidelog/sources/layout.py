"""The folders of a message log: which batches exist, and how one is made visible.

Only folder and file names pass through the driver here, never messages.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession

_CALLS_AT_ONCE = 16
STAGING = "_staging"
_DONE = "_COMPLETE"  # our own: Hadoop's marker may be turned off
_OLD_DONE = "_SUCCESS"
_SUMMARY = "_batch."  # the batch's summary follows in the file's name
_FILES = "_files"  # in the batch's folder, a line of JSON for each file
_INDEX = "_index"  # in the log's own folder, the names of all summaries
_LIMIT = "_limit."  # in the log's own folder, the messages of a file at most
_BETWEEN = "\x00"  # in no path
_LAYOUT = "_partitioned_by."  # in the log's own folder, with the columns


@dataclass(frozen=True)
class Summary:
    """What is known of a batch without a look into its files; None is not known."""

    rows: int | None = None
    first: int | None = None  # offsets
    last: int | None = None
    most: int | None = None  # messages in the largest file

    @property
    def numbered(self) -> bool:
        return self.last is not None

    def name(self) -> str:
        return ".".join("x" if value is None else str(value) for value in (self.rows, self.first, self.last, self.most))

    @classmethod
    def of(cls, name: str) -> Summary:
        return cls(*(None if value == "x" else int(value) for value in name.split(".")))


class LogFolder:
    """A log's folder on whatever file system Spark reads it from."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def date_files(self, publisher: str, batch_id: int, ms: int) -> None:
        """Give the files of a batch a date, as restored or copied files have that of their origin."""
        for file in self.data_files(publisher, batch_id):
            self._fs.setTimes(self._path(f"{self.path}/{file}"), ms, -1)

    def make(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def mark(self, name: str) -> None:
        """An empty file in the folder itself."""
        self._fs.create(self._path(f"{self.path}/{name}")).close()

    def move(self, staged: str, target: str) -> None:
        if not self._fs.rename(self._path(staged), self._path(target)):
            raise RuntimeError(f"{staged} could not be moved to {target}")

    def absolute(self) -> str:
        """The folder's path within its file system."""
        return self._fs.makeQualified(self._path(self.path)).toUri().getPath()

    def create(self) -> None:
        self._fs.mkdirs(self._path(self.path))

    def batch_path(self, publisher: str, batch_id: int) -> str:
        return f"{self.path}/publisher={publisher}/batch_id={batch_id}"

    def staging_path(self, publisher: str, batch_id: int) -> str:
        """A fresh folder to write a batch to: two jobs that write the same batch do not meet there."""
        return f"{self.path}/{STAGING}/{publisher}-{batch_id}-{uuid.uuid4().hex}"

    def publishers(self) -> list[str]:
        return self.values(self.path, "publisher")

    def batches(self, publisher: str) -> list[int]:
        """Complete batches of one publisher, oldest first."""
        ids = self.values(f"{self.path}/publisher={publisher}", "batch_id")
        return sorted(int(i) for i in ids)

    def newest_batches(self, keep: int = 1) -> list[str]:
        """Folders of the last ``keep`` batches of every publisher."""
        paths = []
        for publisher in self.publishers():
            for batch_id in self.batches(publisher)[-keep:]:
                paths.append(self.batch_path(publisher, batch_id))
        return paths

    def is_complete(self, publisher: str, batch_id: int) -> bool:
        batch = self.batch_path(publisher, batch_id)
        return any(self._fs.exists(self._path(f"{batch}/{name}")) for name in (_DONE, _OLD_DONE))

    def describe(self, staged: str, summary: Summary, files: Iterable[dict] = ()) -> None:
        """Put a summary, and the zone map of the files, beside the staged files; both go where the batch goes."""
        self._fs.create(self._path(f"{staged}/{_SUMMARY}{summary.name()}")).close()
        lines = [json.dumps(entry) for entry in files]
        if lines:
            self.write_text(f"{staged}/{_FILES}", "\n".join(lines))

    def summaries(self) -> dict[tuple[str, int], Summary]:
        """Of all batches. One listing for each publisher and one of its index; only what the index lacks is looked up."""
        found: dict[tuple[str, int], Summary] = {}
        for publisher in self.publishers():
            indexed = {}
            for name in self.names(f"{self.path}/{_INDEX}/publisher={publisher}"):
                batch_id, _, text = name.partition(".")
                indexed[int(batch_id)] = Summary.of(text)
            for batch_id in self.batches(publisher):
                found[publisher, batch_id] = indexed.get(batch_id) or self._own_summary(publisher, batch_id)
        return found

    def _own_summary(self, publisher: str, batch_id: int) -> Summary:
        names = self.names(self.batch_path(publisher, batch_id))
        return next((Summary.of(name[len(_SUMMARY):]) for name in names if name.startswith(_SUMMARY)), Summary())

    def files_between(self, after: int, upto: int, numbered_later: bool = True) -> list[str]:
        """Folders and files that hold offsets with ``after < offset <= upto``; each batch must be numbered.

        Without ``numbered_later`` batches that are not numbered are left out: the caller knows that they came after the slice.
        Batches are chosen by their summaries, and files of a batch that lies across an end by the batch's zone map.
        """
        summaries = self.summaries()
        if not numbered_later:
            summaries = {batch: summary for batch, summary in summaries.items() if summary.numbered}
        for (publisher, batch_id), summary in summaries.items():
            if not summary.numbered:
                raise ValueError(
                    f"{self.batch_path(publisher, batch_id)} has no offsets: land the messages, or publish with number=True"
                )
        paths = []
        for (publisher, batch_id), summary in sorted(summaries.items()):
            if summary.last <= after or summary.first > upto:
                continue
            batch = self.batch_path(publisher, batch_id)
            inside = summary.first > after and summary.last <= upto
            files = [] if inside else self._zone_map(batch)
            wanted = [f"{batch}/{file['file']}" for file in files if file["last"] > after and file["first"] <= upto]
            paths += wanted if files else [batch]
        return paths

    def _zone_map(self, batch: str) -> list[dict]:
        if not self._fs.exists(self._path(f"{batch}/{_FILES}")):
            return []
        return [json.loads(line) for line in self.read_text(f"{batch}/{_FILES}").split("\n")]

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        stream.write(bytearray(text, "utf-8"))
        stream.close()

    def limit(self) -> int | None:
        """The least limit under which any reader has subscribed: batches that come later keep to it."""
        limits = [int(name[len(_LIMIT):]) for name in self.names(self.path) if name.startswith(_LIMIT)]
        return min(limits, default=None)

    def keep_to_limit(self, most_messages: int) -> None:
        """Every file must hold at most so many messages, those to come included."""
        for (publisher, batch_id), summary in self.summaries().items():
            if summary.most is None or summary.most > most_messages:
                raise ValueError(
                    f"{self.batch_path(publisher, batch_id)} was not landed in batches of at most {most_messages} messages: "
                    "land it with max_batch_messages, or read it without maxBatchMessageNum"
                )
        if (self.limit() or most_messages + 1) > most_messages:
            self.mark(f"{_LIMIT}{most_messages}")

    def fix_layout(self, partition_by: list[str]) -> None:
        """The first batch of a log decides its partition columns; another layout is refused."""
        layout = ",".join(partition_by)
        self.create()
        fixed = [name[len(_LAYOUT):] for name in self.names(self.path) if name.startswith(_LAYOUT)]
        if not fixed:
            self.mark(f"{_LAYOUT}{layout}")
        elif layout not in fixed:
            raise ValueError(f"{self.path} is partitioned by {fixed[0] or 'nothing'}, this batch by {layout or 'nothing'}")

    def last_offset(self) -> int:
        """The highest offset in the log, -1 before the first numbered message."""
        return max((summary.last for summary in self.summaries().values() if summary.numbered), default=-1)

    def commit(self, staged: str, publisher: str, batch_id: int, summary: Summary = Summary()) -> None:
        """Show a staged batch to readers by renaming its folder into place, and put its summary into the index."""
        target = self._path(self.batch_path(publisher, batch_id))
        self._fs.mkdirs(target.getParent())
        if self.is_complete(publisher, batch_id):
            raise RuntimeError(f"batch {batch_id} of {publisher} was written to {self.path} by another job")
        self._fs.create(self._path(f"{staged}/{_DONE}")).close()
        if self._fs.exists(target):  # a rename that an unfit file system broke off
            self._fs.delete(target, True)
        if not self._fs.rename(self._path(staged), target):
            raise RuntimeError(f"batch {batch_id} of {publisher} could not be moved into {self.path}")
        index = f"{self.path}/{_INDEX}/publisher={publisher}"
        for name in self.names(index):  # of a batch of this number that was expired
            if name.startswith(f"{batch_id}."):
                self.discard(f"{index}/{name}")
        self._fs.create(self._path(f"{index}/{batch_id}.{summary.name()}")).close()

    def drop_batch(self, publisher: str, batch_id: int) -> str:
        batch = self.batch_path(publisher, batch_id)
        self.discard(batch)
        index = f"{self.path}/{_INDEX}/publisher={publisher}"
        for name in self.names(index):
            if name.startswith(f"{batch_id}."):
                self.discard(f"{index}/{name}")
        return batch

    def flatten_in_order(self, staged: str, column: str, started_ms: int) -> dict[str, str]:
        """Lift ``<column>=<k>/file`` to the top and date the files in order of k.

        A file stream takes files by their date, so it then takes the batches in
        arrival order. Dates go up by a millisecond from the start of the write:
        later than all batches before, and far from the age at which a file
        stream would ignore a file. One file is one micro-batch to come, so there
        are as many renames here as micro-batches that the reader will run. Gives the new name of
        each ``<column>=<k>/file``.
        """
        keys = sorted(int(value) for value in self.values(staged, column))
        width = len(str(keys[-1])) if keys else 1
        lifted: dict[str, str] = {}

        def lift(position: int, key: int) -> None:
            folder = self._path(f"{staged}/{column}={key}")
            for status in self._fs.listStatus(folder):
                name = status.getPath().getName()
                lifted[f"{column}={key}/{name}"] = f"{key:0{width}d}-{name}"
                target = self._path(f"{staged}/{key:0{width}d}-{name}")
                self._fs.rename(status.getPath(), target)
                self._fs.setTimes(target, started_ms + position, -1)
            self._fs.delete(folder, True)

        with ThreadPoolExecutor(_CALLS_AT_ONCE) as pool:  # the storage, not the driver, is waited for
            list(pool.map(lift, range(len(keys)), keys))
        return lifted

    def discard(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def data_files(self, publisher: str, batch_id: int) -> list[str]:
        """Paths, from the log's folder down, of the files that readers of a batch see."""
        top = self.batch_path(publisher, batch_id)
        listed = self._fs.listFiles(self._path(top), True)
        paths = []
        while listed.hasNext():
            path = listed.next().getPath().toString()
            below = path[path.rindex(f"publisher={publisher}/batch_id={batch_id}/"):]
            if not any(part.startswith(("_", ".")) and "=" not in part for part in below.split("/")):
                paths.append(below)
        return paths

    def names(self, path: str) -> list[str]:
        """What a folder holds; nothing where there is no such folder."""
        folder = self._path(path)
        if not self._fs.exists(folder):
            return []
        # put together there: a call for each name would make long listings slow
        paths = self._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(self._fs.listStatus(folder))
        listed = self._jvm.scala.collection.mutable.ArraySeq.make(paths).mkString(_BETWEEN)
        names = [path.rsplit("/", 1)[-1] for path in listed.split(_BETWEEN)] if listed else []
        return sorted(name for name in names if not name.endswith(".crc"))

    def values(self, path: str, column: str) -> list[str]:
        prefix = f"{column}="
        return [name[len(prefix):] for name in self.names(path) if name.startswith(prefix)]
