"""CSV with quoted line breaks, read by many tasks per file.

A line of text may begin inside a quoted cell, and whether it does hangs on everything before it.
Two passes settle that without reading a file in one task. The first gives, for each range of a
file that Spark reads as one split, where it leaves the reader (inside a quoted cell or between
records) for either way of entering it; these two-state functions are then composed along each
file, range by range, so that every range knows how it is entered. The second pass puts the lines
of a range together to records. A record that crosses ranges leaves a piece in each; only these
pieces are shuffled.

A quote opens a cell only at the cell's start, two quotes in it are one, and text after the
closing quote belongs to the cell up to the next comma, as Spark's own parser has it. So a stray
quote in an unquoted cell does not turn the rest of the file around, as counting quotes would.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from snapgate.sinks.scratch import cut_lineage

# executors get this module's functions with the job, not from a package they would have to have
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BODY = r'[^"]*+(?:""[^"]*+)*+'
_CELLS = rf'(?:(?:"{_BODY}"[^,]*+|[^",][^,]*+|),)*+'
#: A line that is entered between records, or inside a quoted cell, and left inside one.
_OPENS = re.compile(rf'{_CELLS}"{_BODY}\Z')
_STAYS = re.compile(rf'{_BODY}(?:\Z|"[^,]*+,{_CELLS}"{_BODY}\Z)')

#: Bytes of a record in one range; beyond it a quote is taken for never closed and the read fails.
MAX_RECORD = 64 << 20

WHOLE, BEGINS, GOES_ON = 0, 1, 2
_LAST = (1 << 63) - 1


def moves(line: str) -> tuple[bool, bool]:
    """Whether the reader is inside a quoted cell after the line, entered between records and inside a cell."""
    return _OPENS.match(line) is not None, _STAYS.match(line) is not None


def _ranges(batch):
    """(file, block, first row, row after the last) of each run of lines of one range."""
    files, block = batch.column("file").dictionary_encode(), batch.column("block").to_numpy()
    number = files.indices.to_numpy()
    cuts = np.flatnonzero((np.diff(number) != 0) | (np.diff(block) != 0)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        yield files.dictionary[int(number[a])].as_py(), int(block[a]), a, b


def _quoted_lines(batch) -> np.ndarray:
    return np.flatnonzero(pc.match_substring(batch.column("value"), '"').to_numpy(zero_copy_only=False))


def _leave(batches):
    """(file, block, from_out, from_in) of each range."""
    at, state = None, [False, True]

    def row():
        return pa.RecordBatch.from_pydict({"file": [at[0]], "block": [at[1]], "from_out": [state[0]], "from_in": [state[1]]})
    for batch in batches:
        if not batch.num_rows:
            continue
        quoted, value = _quoted_lines(batch), batch.column("value")
        for file, block, a, b in _ranges(batch):
            if at != (file, block):
                if at:
                    yield row()
                at, state = (file, block), [False, True]
            lo, hi = np.searchsorted(quoted, [a, b])
            for line in value.take(pa.array(quoted[lo:hi])).to_pylist():
                move = moves(line)
                state = [move[s] for s in state]
    if at:
        yield row()


def crossings(lines: DataFrame) -> tuple[set[tuple[str, int]], set[tuple[str, int]]]:
    """The ranges that begin inside a quoted cell, and the files' last ranges that end inside one.

    A range either sets the state, whatever it was, or turns it, or leaves it; so the state behind
    a range is that of the last one to set it, turned as often as ranges since then did. There is
    one row for each range of ``spark.sql.files.maxPartitionBytes``, and the few that begin in
    the midst of a record come to the driver.
    """
    out = lines.select("file", "block", "value").mapInArrow(_leave, "file string, block long, from_out boolean, from_in boolean")
    order = Window.partitionBy("file").orderBy("block")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    turned = F.sum(F.when(F.col("from_out") & ~F.col("from_in"), 1).otherwise(0)).over(so_far)
    sets = F.when(F.col("from_out") == F.col("from_in"), (F.col("from_out").cast("int") + F.col("turned")) % 2)
    after = (F.coalesce(F.last("sets", ignorenulls=True).over(so_far), F.lit(0)) + F.col("turned")) % 2
    state = out.withColumn("turned", turned).withColumn("sets", sets).withColumn("after", after).withColumns({
        "inside": F.lag("after", 1, 0).over(order), "next": F.lead("block").over(order)})
    found = state.select("file", "block", (F.col("inside") == 1).alias("inside"),
                         ((F.col("after") == 1) & F.col("next").isNull()).alias("open")).where("inside or open").collect()
    return {(r[0], r[1]) for r in found if r[2]}, {(r[0], r[1]) for r in found if r[3]}


def _records(batches, inside: set[tuple[str, int]], left_open: set[tuple[str, int]], pieces: bool):
    """Records of each range with the place of their first line; with ``pieces`` those that cross ranges instead.

    Rows are (file, block, pos, snapshot, head, piece, text). ``head`` marks a file's first record
    that is not empty.
    """
    at, held, kind, start, first = None, [], WHOLE, 0, False
    names = ["file", "block", "pos", "snapshot", "head", "piece", "text"]

    def rows(texts, pos, snapshot, heads, piece):
        n = len(texts)
        return pa.RecordBatch.from_arrays(
            [pa.repeat(pa.scalar(at[0], pa.string()), n), pa.repeat(pa.scalar(at[1], pa.int64()), n), pos,
             pa.repeat(pa.scalar(snapshot, pa.string()), n), heads, pa.repeat(pa.scalar(piece, pa.int32()), n), texts], names)

    def end_of_range(snapshot):
        """What is left of an open record when its range ends."""
        alone = kind == BEGINS and at in left_open
        if held and pieces != alone:
            yield rows(pa.array(["\n".join(held)], pa.string()), pa.array([start if alone else _LAST], pa.int64()), snapshot,
                       pa.array([first and kind == BEGINS]), WHOLE if alone else kind)

    snapshot = None
    for batch in batches:
        if not batch.num_rows:
            continue
        quoted, value, pos = _quoted_lines(batch), batch.column("value"), batch.column("pos")
        for file, block, a, b in _ranges(batch):
            if at != (file, block):
                yield from end_of_range(snapshot)
                at, snapshot, first = (file, block), batch.column("snapshot")[a].as_py(), block == 0
                held, kind, start = ([], GOES_ON, -1) if at in inside else ([], WHOLE, 0)
            is_in = kind != WHOLE
            lo, hi = np.searchsorted(quoted, [a, b])
            turns = []          # (line, state after it) where the state changes
            for i, line in zip(quoted[lo:hi].tolist(), value.take(pa.array(quoted[lo:hi])).to_pylist()):
                if ((_STAYS if is_in else _OPENS).match(line) is not None) != is_in:
                    is_in = not is_in
                    turns.append(i)
            # stretches of lines between records, each a record, and of lines of one record
            line = a
            for i in [*turns, b]:
                if kind == WHOLE:
                    plain = value.slice(line, i - line)
                    line = i
                    texts, heads = pc.utf8_rtrim(plain, "\r"), np.zeros(len(plain), bool)
                    full = np.flatnonzero(pc.binary_length(texts).to_numpy(zero_copy_only=False))
                    if first and len(full):
                        heads[full[0]], first = True, False
                    if len(full) and not pieces:
                        yield rows(texts.take(pa.array(full)), pos.slice(line - len(plain), len(plain)).take(pa.array(full)),
                                   snapshot, pa.array(heads[full]), WHOLE)
                    if i < b:
                        kind, start, held = BEGINS, pos[i].as_py(), [value[i].as_py()]
                        line = i + 1
                else:
                    last = min(i + 1, b)
                    held += value.slice(line, last - line).to_pylist()
                    line = last
                    if sum(map(len, held)) > MAX_RECORD:
                        raise ValueError(f"quoted cell not closed within {MAX_RECORD} bytes: {at[0]}, range at byte {at[1]}")
                    if i < b:
                        if (kind == GOES_ON) == pieces:
                            yield rows(pa.array(["\n".join(held).rstrip("\r")], pa.string()), pa.array([start], pa.int64()), snapshot,
                                       pa.array([first and kind == BEGINS]), kind if pieces else WHOLE)
                        first, kind, held = first and kind != BEGINS, WHOLE, []
    yield from end_of_range(snapshot)


_ROW = "file string, block long, pos long, snapshot string, head boolean, piece int, text string"


def read_records(spark: SparkSession, paths: Sequence[str], base: str, by: str | None) -> DataFrame:
    """(file, block, pos, snapshot, head, text): every record that is not empty, with the place of its first line.

    Lines end in a line feed, with or without a carriage return before it, which then is no part of
    the record; within quotes both stay. Order by file, block and pos is that of the files. A
    record that is still open at its file's end ends there.
    """
    scan = spark.read.schema(f"value string{f', `{by}` string' if by else ''}").options(lineSep="\n", basePath=base)

    def lines(of):
        return scan.text(of).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                    F.monotonically_increasing_id().alias("pos"), (F.col(by) if by else F.lit(None).cast("string")).alias("snapshot"))
    found = lines(list(paths))
    inside, left_open = crossings(found)
    names = ["file", "block", "pos", "snapshot", "head", "text"]
    whole = found.mapInArrow(lambda batches: _records(batches, inside, left_open, False), _ROW).select(*names)
    if not inside:
        return whole
    files = sorted({file for file, _ in inside})
    pieces = cut_lineage(found.where(F.col("file").isin(files)).mapInArrow(
        lambda batches: _records(batches, inside, left_open, True), _ROW))
    along = Window.partitionBy("file").orderBy("block", F.col("piece").desc()).rowsBetween(Window.unboundedPreceding, 0)
    opened = F.last(F.when(F.col("piece") == BEGINS, F.col("block")), ignorenulls=True).over(along)
    parts = F.sort_array(F.collect_list(F.struct("block", "text")))
    joined = pieces.withColumn("opened", opened).groupBy("file", F.col("opened").alias("block")).agg(
        F.max("pos").alias("pos"), F.max("snapshot").alias("snapshot"), F.bool_or("head").alias("head"),
        F.array_join(F.transform(parts, lambda x: x["text"]), "\n").alias("text"))
    return whole.unionByName(joined)
