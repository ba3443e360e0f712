"""A streaming source over a table whose rows are announced by their ids, each given downstream once.

A notification says that a row with some id exists. What counts is the table, not the message: every poll asks the table
for ids above the last one it gave (since_id), so a message that was lost, or came while nobody listened, loses no row,
and a message that comes twice gives nothing again. Ids are drawn before their transactions end, so a smaller id may
appear after a larger one was given. The source therefore remembers the numbers that it passed over; each poll looks
whether one of them has come, and gives it then. Numbers that lie more than `patience` behind, or beyond the last
`most_gaps`, are given up: rolled-back transactions never fill them.

    read_ledger(spark, "id long, value double", state=..., path=...)

Options. `path`: a folder of Parquet files to which files are added; or `table`: a table of the database that the function
`connect` gives DB-API connections to. `columns`: the columns to read, as DDL; `id`: the one with the ids
(whole numbers, "id" if not said). `state`: a folder of this stream alone. `limit`: ids of a batch at most (100000).
`tasks`: tasks of a batch (8). `since`: the id behind which a new stream begins (0, the rows with ids from 1 on).
`patience` and `most_gaps`: 100000 and 1000 if not said.

Offsets are {upto, gaps, filled}: a batch has the ids in (start.upto, end.upto] without end.gaps, and end.filled. It depends
on its offsets only, so a batch that is made again after a failure has the rows it had. The engine does not tell a source
where a restarted stream stands, which the limit needs; the source writes the end of each batch it plans to `state`.

Defined cases: a null id is never given; a stream whose `state` was deleted is an error, as it would give ids again; rows that repeat an id inside a batch are one row, the first that is read; an
empty table gives no batches, a folder that is not there yet is an empty table.
"""

from __future__ import annotations

import itertools
import json
import logging
import sys
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pd
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

log = logging.getLogger(__name__)

LIMIT, TASKS, PATIENCE, MOST_GAPS = 100_000, 8, 100_000, 1000


class ParquetLedger:
    """A folder of Parquet files with an id column; files are added and never changed."""

    def __init__(self, path: str, key: str):
        self.fs, self.path = pyarrow.fs.FileSystem.from_uri(path)
        self.key, self.bounds = key, {}

    def _files(self) -> dict[str, tuple[int, int]]:
        """Smallest and largest id of each file, from its footer, which is read once."""
        found = self.fs.get_file_info(pyarrow.fs.FileSelector(self.path, allow_not_found=True, recursive=True))
        names = [f.path for f in found if f.is_file and f.path.endswith(".parquet") and not f.base_name.startswith((".", "_"))]
        for name in set(names) - self.bounds.keys():
            meta = pq.ParquetFile(name, filesystem=self.fs).metadata
            at = meta.schema.to_arrow_schema().names.index(self.key)
            stats = [s for g in range(meta.num_row_groups) if (s := meta.row_group(g).column(at).statistics) is not None and s.has_min_max]
            self.bounds[name] = (min(s.min for s in stats), max(s.max for s in stats)) if stats else (0, -1)
        return {n: self.bounds[n] for n in names}

    def _scan(self, low: int, high: int, condition: pc.Expression, columns: list[str]) -> Iterator[pa.RecordBatch]:
        names = sorted(n for n, (a, b) in self._files().items() if a <= high and b >= low)
        if names:
            yield from pd.dataset(names, filesystem=self.fs, format="parquet").to_batches(filter=condition, columns=columns)

    def ids_after(self, since: int, limit: int) -> list[int]:
        """The smallest ids above since, `limit` of them at most."""
        found = np.zeros(0, np.int64)
        files = sorted((max(a, since + 1), n) for n, (a, b) in self._files().items() if b > since)
        for low, name in files:  # by their smallest id: the rest is beyond reach once enough smaller ones are known
            if len(found) >= limit and low > found[limit - 1]:
                break
            key = pc.field(self.key)
            wanted = (key > since) & (key < int(found[limit - 1])) if len(found) >= limit else key > since
            for batch in pd.dataset(name, filesystem=self.fs, format="parquet").to_batches(filter=wanted, columns=[self.key]):
                new = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                # no more than is asked for stays, so a long backlog costs a look at its ids and no memory
                found = np.unique(np.concatenate((found, new if len(found) < limit else new[new < found[-1]])))[:limit]
        return found.tolist()

    def present(self, ids: Sequence[int]) -> list[int]:
        if not ids:
            return []
        batches = self._scan(min(ids), max(ids), pc.field(self.key).isin(list(ids)), [self.key])
        return sorted({i for b in batches for i in b.column(0).to_pylist()})

    def rows(self, low: int, high: int, only: Sequence[int], without: Sequence[int], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        key = pc.field(self.key)
        condition = key.isin(list(only)) if only else (key > low) & (key <= high) & ~key.isin(pa.array(without, pa.int64()))
        ends = (min(only), max(only)) if only else (low + 1, high)
        for b in self._scan(*ends, condition, schema.names):
            yield from pa.Table.from_batches([b]).cast(schema).to_batches()


class TableLedger:
    """A table of a database with an id column, through DB-API connections that `connect` gives."""

    def __init__(self, connect: Callable[[], object], table: str, key: str):
        self.connect, self.table, self.key = connect, table, key

    def _all(self, sql: str) -> list[tuple]:
        connection = self.connect()
        try:
            cursor = connection.cursor()
            cursor.execute(sql)
            return cursor.fetchall()
        finally:
            connection.close()

    def ids_after(self, since: int, limit: int) -> list[int]:
        return [r[0] for r in self._all(f"SELECT DISTINCT {self.key} FROM {self.table} WHERE {self.key} > {int(since)} ORDER BY {self.key} LIMIT {int(limit)}")]

    def present(self, ids: Sequence[int]) -> list[int]:
        return [r[0] for r in self._all(f"SELECT DISTINCT {self.key} FROM {self.table} WHERE {self.key} IN ({', '.join(str(int(i)) for i in ids)}) ORDER BY {self.key}")] if ids else []

    def rows(self, low: int, high: int, only: Sequence[int], without: Sequence[int], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        some = lambda ids: ", ".join(str(int(i)) for i in ids)
        condition = f"{self.key} IN ({some(only)})" if only else f"{self.key} > {int(low)} AND {self.key} <= {int(high)}" + (f" AND {self.key} NOT IN ({some(without)})" if without else "")
        connection = self.connect()
        try:
            cursor = connection.cursor()
            cursor.execute(f"SELECT {', '.join(schema.names)} FROM {self.table} WHERE {condition} ORDER BY {self.key}")
            while rows := cursor.fetchmany(10_000):
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)
        finally:
            connection.close()


def ledger(options: dict[str, str], connect: Callable[[], object] | None) -> ParquetLedger | TableLedger:
    key = options.get("id", "id")
    return TableLedger(connect, options["table"], key) if connect else ParquetLedger(options["path"], key)


@dataclass(frozen=True)
class Offset:
    """Ids up to `upto` were given but for `gaps`; the batch that ends here also gave `filled`."""

    upto: int
    gaps: tuple[int, ...] = ()
    filled: tuple[int, ...] = ()

    def told(self) -> dict:
        return {"upto": self.upto, "gaps": ",".join(map(str, self.gaps)), "filled": ",".join(map(str, self.filled))}

    @staticmethod
    def of(told: dict) -> Offset:
        numbers = lambda s: tuple(map(int, filter(None, s.split(","))))
        return Offset(int(told["upto"]), numbers(told["gaps"]), numbers(told["filled"]))


def following(now: Offset, found: Sequence[int], filled: Sequence[int], patience: int, most: int) -> Offset:
    """The offset after a poll that found these ids above now.upto, and these of its gaps."""
    if not found and not filled:
        return now
    upto = found[-1] if found else now.upto
    have, low = set(found), max(now.upto, upto - patience)
    # only the last `most` numbers that are missing are kept, so the search goes down from the newest
    missing = list(itertools.islice((i for i in range(upto, low, -1) if i not in have), most))
    waiting = [g for g in now.gaps if g not in set(filled) and g > upto - patience]
    gaps = sorted({*waiting, *missing})[-most:] if most else []
    if given_up := len(now.gaps) - len(filled) + len(missing) - len(gaps):
        log.info("%s ids that were passed over are waited for no longer", given_up)
    return Offset(upto, tuple(gaps), tuple(filled))


@dataclass
class Span(InputPartition):
    """Ids in (low, high] without some, or only some."""

    low: int
    high: int
    only: list[int] = field(default_factory=list)
    without: list[int] = field(default_factory=list)


class _Place:
    """Where a stream stands, as a small file that is replaced as a whole."""

    def __init__(self, folder: str):
        self.fs, self.folder = pyarrow.fs.FileSystem.from_uri(folder)

    def read(self) -> Offset | None:
        path = f"{self.folder}/planned.json"
        if self.fs.get_file_info(path).type == pyarrow.fs.FileType.NotFound:
            return None
        with self.fs.open_input_stream(path) as f:
            return Offset.of(json.loads(f.read()))

    def write(self, at: Offset) -> None:
        self.fs.create_dir(self.folder, recursive=True)
        new = f"{self.folder}/.planned-{uuid.uuid4().hex}"
        with self.fs.open_output_stream(new) as f:
            f.write(json.dumps(at.told()).encode())
        self.fs.move(new, f"{self.folder}/planned.json")


class LedgerReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str], schema: StructType, connect: Callable[[], object] | None):
        self.options, self.columns, self.connect = dict(options), schema, connect
        self.limit, self.tasks = int(options.get("limit", LIMIT)), int(options.get("tasks", TASKS))
        self.patience, self.most = int(options.get("patience", PATIENCE)), int(options.get("most_gaps", MOST_GAPS))
        self.at: Offset | None = None
        self.place, self.table = None, None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"place": None, "table": None}

    def _open(self) -> None:
        if self.table is None:
            self.table, self.place = ledger(self.options, self.connect), _Place(self.options["state"])

    def initialOffset(self) -> dict:
        return Offset(int(self.options.get("since", 0))).told()

    def latestOffset(self) -> dict:
        self._open()
        now = self.at or self.place.read() or Offset.of(self.initialOffset())
        return following(now, self.table.ids_after(now.upto, self.limit), self.table.present(now.gaps), self.patience, self.most).told()

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self._open()
        a, b = Offset.of(start), Offset.of(end)
        if a == b:
            return []
        if b.upto < a.upto:
            raise ValueError(f"the state of the stream is gone from {self.options['state']}: it stands at {a.upto}")
        if b != self.at:  # known before the batch runs: it is run again, with the same ends, if it fails
            self.place.write(b)
            self.at = b
        ids = self.table.ids_after(a.upto, self.limit) if b.upto > a.upto else []
        ends = [ids[len(ids) * (k + 1) // self.tasks - 1] for k in range(self.tasks) if len(ids) * (k + 1) // self.tasks] if ids else []
        ends = sorted({e for e in ends if a.upto < e < b.upto}) + [b.upto] if b.upto > a.upto else []
        lows = [a.upto, *ends[:-1]]
        spans = [Span(low, high, [], [g for g in b.gaps if low < g <= high]) for low, high in zip(lows, ends, strict=False)]
        return spans + ([Span(0, 0, list(b.filled))] if b.filled else [])

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        key, seen = self.options.get("id", "id"), set()
        for b in ledger(self.options, self.connect).rows(partition.low, partition.high, partition.only, partition.without, to_arrow_schema(self.columns)):
            fresh = []
            for i in b.column(key).to_pylist():
                fresh.append(i is not None and i not in seen)
                seen.add(i)
            if any(fresh):
                yield b.filter(pa.array(fresh))


class LedgerSource(DataSource):
    connect: Callable[[], object] | None = None

    @classmethod
    def name(cls) -> str:
        return "ledger"

    def schema(self) -> str:
        return self.options["columns"]

    def streamReader(self, schema: StructType) -> LedgerReader:
        for name in ("state", "columns"):
            if name not in self.options:
                raise ValueError(f"the ledger source needs the option {name}")
        return LedgerReader(self.options, schema, type(self).connect)


def read_ledger(spark: SparkSession, columns: str, state: str, connect: Callable[[], object] | None = None, **options: str) -> DataFrame:
    """The stream of a ledger's rows; the options are those above."""
    # planning runs in a Python process of the driver that has none of the packages which the executors were given
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    source = LedgerSource if connect is None else type("LedgerSource", (LedgerSource,), {"connect": staticmethod(connect)})
    spark.dataSource.register(source)
    return spark.readStream.format("ledger").options(columns=columns, state=state, **options).load()


def drain(start: Callable[[], StreamingQuery]) -> int:
    """Starts a stream that takes what is there and ends, again until a run moves no offset; gives the rows that were read.

    A run takes one batch of `limit` ids at most, or makes one again that was not committed, so this is how a backlog is worked off.
    """
    total = 0
    while True:
        query = start()
        query.awaitTermination()
        done = query.recentProgress
        total += sum(p["numInputRows"] for p in done)
        if all(s["startOffset"] == s["endOffset"] for p in done for s in p["sources"]):
            return total
