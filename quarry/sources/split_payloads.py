"""Payload files of any size, cut into records by many tasks.

``unwrap_payloads`` reads a payload file as one row, so one task parses it. Here Spark's
text reader cuts a file into byte ranges as it does for any large text, with ``}`` as the
line separator: rows are the stretches between closing braces, and a range's rows are
those that start in it (its *block*). A brace may stand inside a string or close an inner
object, so where records end depends on what came before the block. That is settled as a
parallel scan:

1. every block is read for both things that may hold where it starts, outside a string or
   inside one, and gives the state and nesting depth at its end in either case;
2. these few rows (one per block) are composed along each file, which tells every block
   its true state and depth;
3. every block is read again and cut at the commas of the record list. Whole records leave
   as they are; a record that runs over blocks leaves in pieces, which its number in the
   file brings together.

Each record then passes through ``unwrap`` as a list of one, so its text, its validation
and its errors are those of ``unwrap_payloads``. No task holds more than a batch of rows
and one record; a file on a store that only Spark reads is fine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import bounded_broadcast
from ..session import checkpoint_dir
from .landing import unwrap

QUOTE, ESCAPE, COMMA = 0x22, 0x5C, 0x2C
SPACE = b" \t\r\n"
KEY_BYTES = 4096  # in which the key of a list and the space around its colon must stand
MAX_BLOCKS = 1_000_000  # of one run: their states are broadcast (blocks of 128 MB: 128 TB)
OPEN, WHOLE, PART, END = "open", "whole", "part", "end"
_BLOCK_DDL = ("source_file string, block bigint, first string, size bigint, read bigint, "
              "out_in boolean, out_depth bigint, in_in boolean, in_depth bigint")
_PIECE_DDL = ("source_file string, block bigint, seq bigint, what string, cuts bigint, opening bigint, "
              "is_data boolean, piece string")


def payload_rows(spark: SparkSession, path: str) -> DataFrame:
    """``(source_file, block, value, size)``: stretches between closing braces, in order within
    a block; ``size`` is the file's."""
    return (spark.read.option("lineSep", "}").text(path)
            .select(F.col("_metadata.file_path").alias("source_file"),
                    F.col("_metadata.file_block_start").alias("block"), "value",
                    F.col("_metadata.file_size").alias("size")))


def scan(data: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Of some bytes of JSON that start ``inside`` a string or not: which bytes stand outside
    strings (quotes do not), what each adds to the depth, and whether the end is inside."""
    escape = data == ESCAPE
    quote = data == QUOTE
    if escape.any():
        # A quote behind an odd run of escapes is part of its string.
        at = np.arange(len(data))
        run = at - np.maximum.accumulate(np.where(escape, -1, at))
        quote = quote & (np.r_[0, run[:-1]] % 2 == 0)
    open_ = (np.cumsum(quote) + inside) % 2 == 1
    outside = ~open_ & ~quote
    step = ((data == 0x5B) | (data == 0x7B)).astype(np.int8) - ((data == 0x5D) | (data == 0x7D)).astype(np.int8)
    return outside, np.where(outside, step, 0), bool(open_[-1]) if len(data) else inside


def _blocks(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[bytes]]]:
    """Runs of rows of one block, batch by batch."""
    for part in parts:
        files, blocks = part.column(0).to_pylist(), part.column(1).to_pylist()
        values = part.column(2).cast(pa.binary()).to_pylist()
        low = 0
        for i in range(1, len(files) + 1):
            if i == len(files) or (files[i], blocks[i]) != (files[low], blocks[low]):
                yield files[low], blocks[low], values[low:i]
                low = i


def block_summaries(rows: DataFrame) -> DataFrame:
    """One row per block: its first character that is no space, and for both states it may
    start in whether it ends inside a string and how the depth changes."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list] = {}
        for part in parts:
            sizes, at = part.column(3).to_pylist(), 0
            for file, block, values in _blocks([part]):
                raw = b"}".join([*values, b""])
                data = np.frombuffer(raw, np.uint8)
                now = found.setdefault((file, block), ["", sizes[at], 0, False, 0, True, 0])
                now[0] = now[0] or raw.lstrip(SPACE)[:1].decode(errors="replace")
                now[2] += len(raw)
                for k in (3, 5):
                    _, step, now[k] = scan(data, now[k])
                    now[k + 1] += int(step.sum())
                at += len(values)
        names = [f.split()[0] for f in _BLOCK_DDL.split(", ")]
        yield pa.RecordBatch.from_pylist([dict(zip(names, (*key, *v))) for key, v in found.items()],
                                         schema=_schema(_BLOCK_DDL))

    return rows.mapInArrow(batches, _BLOCK_DDL)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(), "int": pa.int32()}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in ddl.split(", ")])


def block_states(summaries: DataFrame) -> DataFrame:
    """``(source_file, block, inside, depth, kind)``: what holds where each block starts.

    Composed along each file, over one small row per block. ``kind`` is the file's first
    character. A payload that is no list or object, or ends inside a string or a bracket,
    fails the job.
    """
    def along(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        name, kind = frame["source_file"].iloc[0], next((c for c in frame["first"] if c), "")
        if kind not in ("[", "{"):
            raise ValueError(f"payload is neither a list nor an object around one: {name} starts with {kind!r}")
        inside, depth, out = False, 0, []
        for r in frame.itertuples():
            out.append((name, r.block, inside, depth, kind))
            inside, depth = (r.in_in, depth + r.in_depth) if inside else (r.out_in, depth + r.out_depth)
        # Rows were joined with one brace too many unless the file ends in one.
        depth += int(frame["read"].sum()) > int(frame["size"].iloc[0])
        if inside or depth:
            raise ValueError(f"payload {name} is not whole: it ends inside "
                             f"{'a string' if inside else f'{depth} brackets'}")
        return pd.DataFrame(out, columns=["source_file", "block", "inside", "depth", "kind"])

    return summaries.groupBy("source_file").applyInPandas(
        along, "source_file string, block bigint, inside boolean, depth bigint, kind string")


def pieces(rows: DataFrame, states: DataFrame) -> DataFrame:
    """Records (``whole``) and parts of records of every block, and where lists open.

    ``cuts`` counts the record boundaries of the block before a row, ``opening`` the lists
    it has opened (0: the piece's list was open before), ``is_data`` tells whether the list
    is the payload's. The row ``end`` holds all cuts, and what is open at the block's end.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = None
        for part in parts:
            columns = [part.column(n).to_pylist() for n in ("inside", "depth", "kind")]
            at = 0
            for file, block, values in _blocks([part]):
                if cutter is None or cutter.name != (file, block):
                    if cutter is not None:
                        yield cutter.end()
                    cutter = _Cutter((file, block), *(c[at] for c in columns))
                yield cutter.take(values)
                at += len(values)
        if cutter is not None:
            yield cutter.end()

    # A broadcast join keeps the rows of a block in order; ``split_payloads`` bounds it.
    return rows.join(F.broadcast(states), ["source_file", "block"]).select(
        "source_file", "block", "value", "inside", "depth", "kind").mapInArrow(batches, _PIECE_DDL)


class _Cutter:
    """Cuts the rows of one block, batch by batch, at the boundaries of the record list."""

    def __init__(self, name: tuple[str, int], inside: bool, depth: int, kind: str):
        self.name, self.inside, self.depth = name, inside, depth
        self.level = 1 if kind == "[" else 2
        self.cuts = self.opened = self.seq = 0
        self.is_data = None
        self.open = depth >= self.level
        self.closed = name[1] > 0 and depth < 1
        self.begun = self.open  # the open record began before this block
        self.rest: list[bytes] = []
        self.before = b""

    def _row(self, what: str, piece: str | None = None) -> tuple:
        self.seq += 1
        return (*self.name, self.seq, what, self.cuts, self.opened, self.is_data, piece)

    def _piece(self, what: str) -> tuple:
        text, self.rest = b"".join(self.rest).decode(), []
        return self._row(PART if self.begun else what, text)

    def take(self, values: list[bytes]) -> pa.RecordBatch:
        raw = b"}".join([*values, b""])
        data = np.frombuffer(raw, np.uint8)
        outside, step, self.inside = scan(data, self.inside)
        depth = self.depth + np.cumsum(step)
        opens = (step == 1) & (depth == self.level) & (data == 0x5B)
        closes = (step == -1) & (depth == self.level - 1)
        commas = outside & (data == COMMA) & (depth == self.level)
        out, low = [], 0
        for at in np.flatnonzero(opens | closes | commas).tolist():
            if opens[at]:
                self.is_data = self.level == 1 or _is_data_key((self.before + raw[:at])[-KEY_BYTES:])
                self.opened += 1
                self.cuts += 1
                self.open, self.begun, self.rest = True, False, []
                out.append(self._row(OPEN))
            elif self.open:
                self.rest.append(raw[low:at])
                out.append(self._piece(WHOLE))
                self.begun = False
                self.cuts += 1
                if closes[at]:
                    self.open, self.closed, self.is_data = False, True, False
            low = at + 1
        if self.open:
            self.rest.append(raw[low:])
        elif self.closed and self.level == 1 and raw[low:].strip(SPACE) not in (b"", b"}"):
            raise ValueError(f"payload {self.name[0]} goes on after its list: {raw[low:low + 40]!r}")
        self.before = (self.before + raw)[-KEY_BYTES:]
        self.depth = int(depth[-1]) if len(depth) else self.depth
        return _batch(out)

    def end(self) -> pa.RecordBatch:
        out = [self._piece(PART)] if self.open else []
        return _batch([*out, self._row(END)])


def _is_data_key(text: bytes) -> bool:
    """True if ``text`` ends in the key ``data`` and a colon (key and list are never apart:
    no brace can stand between them)."""
    text = text.rstrip(SPACE)
    key = text[:-1].rstrip(SPACE) if text.endswith(b":") else b""
    return key.endswith(b'"data"') and not key.endswith(b'\\"data"')


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    schema = _schema(_PIECE_DDL)
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], schema.field(k).type) for k in range(len(schema))], schema=schema)


def _refuse(bad: DataFrame, says: str) -> None:
    first = bad.select(F.min("source_file")).first()[0]
    if first is not None:
        raise ValueError(f"{says}: {first}")


def split_payloads(spark: SparkSession, path: str) -> DataFrame:
    """``(source_file, position, raw)`` as ``unwrap_payloads`` gives them, one file read by many tasks.

    A payload is a JSON list of records or an object with one member ``data`` that is
    such a list; anything else fails the job, as does a list with an empty place. Empty
    files hold no payload and give no rows. Text between two closing braces is one row,
    so a list of bare numbers is not split.
    """
    checkpoint_dir(spark)
    rows = payload_rows(spark, path)
    states = block_states(block_summaries(rows)).checkpoint(eager=True)
    if states.count() > MAX_BLOCKS:
        raise ValueError(f"more than {MAX_BLOCKS} blocks: read the payloads in several runs")
    found = pieces(rows, states).checkpoint(eager=True)
    # Before each block: the cuts of all earlier ones, and whether the payload's list is open.
    ends = found.filter(F.col("what") == END).select("source_file", "block", "cuts", "is_data")
    along = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select("source_file", "block", F.coalesce(F.sum("cuts").over(along), F.lit(0)).alias("base"),
                         F.last("is_data", ignorenulls=True).over(along).alias("was_data"))
    placed = (found.filter(F.col("what") != END).join(F.broadcast(starts), ["source_file", "block"])
              .filter(F.coalesce(F.when(F.col("opening") > 0, F.col("is_data")).otherwise(F.col("was_data")),
                                 F.lit(False)))
              .select("source_file", "block", "seq", "what", (F.col("base") + F.col("cuts")).alias("number"), "piece"))
    lists = placed.filter(F.col("what") == OPEN).groupBy("source_file").agg(
        F.count(F.lit(1)).alias("lists"), F.min("number").alias("low"))
    files = states.select("source_file").distinct().join(lists, "source_file", "left")
    _refuse(files.filter(F.coalesce("lists", F.lit(0)) != 1),
            "payload is neither a list nor an object around one")
    parts = placed.filter(F.col("what") == PART).groupBy("source_file", "number").agg(
        F.array_sort(F.collect_list(F.struct("block", "seq", "piece"))).alias("parts"))
    texts = (placed.filter(F.col("what") == WHOLE).select("source_file", "number", F.col("piece").alias("text"))
             .unionByName(parts.select("source_file", "number", F.array_join("parts.piece", "").alias("text"))))
    blank = F.col("text").rlike(r"^[ \t\r\n]*$")
    empty = texts.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"), F.count_if(blank).alias("blanks"))
    _refuse(empty.filter("blanks > 0 AND n > 1"), "payload holds a list with an empty place")
    one = texts.filter(~blank).join(bounded_broadcast(lists.select("source_file", "low")), "source_file").select(
        "source_file", (F.col("number") - F.col("low")).cast("int").alias("at"),
        F.concat(F.lit("["), "text", F.lit("]")).alias("value"))
    return unwrap(one, "value", keep=("source_file", "at")).select(
        "source_file", F.col("at").alias("position"), "raw")
