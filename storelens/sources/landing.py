"""Landing folders with CSV or JSON documents, read at once or as a stream of new files.

Files are cut into blocks that many tasks read, whatever their length. A first scan looks at the layout of each
block: whether every line (of CSV) or every piece up to a closing brace (of JSON) stands for itself. Where it
does, rows are made of these on their own. CSV files with line breaks inside quotes are read block by block as well:
the quotes counted before a block tell where its first record begins, and records that reach over the end of a block
are put together apart. Where quotes don't add up so, and in JSON files with objects inside objects, a file is put
together in order by one task, piece by piece. Cells are read as text, so that nothing a
file holds is lost: rows that don't fit the schema, and files that can't be read, come back with the reason
and their text. Line breaks inside of cells become line feeds.
"""

from __future__ import annotations

import csv
import json
import re
import sys
from collections import deque
from collections.abc import Iterator
from functools import reduce
from itertools import chain, groupby
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import number
from ..functions.payload import CORRUPT, parse_object
from ..session import ensure_checkpoint_dir

# Extensions in either case; Hadoop globs know no case folding.
CSV_GLOB, JSON_GLOB = "*.[cC][sS][vV]", "*.[jJ][sS][oO][nN]"

# Texts that stand for a missing cell.
MISSING = ["", "NA", "N/A", "n/a", "NaN", "nan", "NULL", "null", "None"]

# Fixed value: columns of the file source. The content is never read.
FILES = "path string, modificationTime timestamp, length bigint, content binary"
UNREADABLE, TOO_LONG, NO_OBJECT = "unreadable", "more cells than columns", "no object"
# A quoted cell, or an element, of more characters than this isn't closed any more.
LONGEST = 64 << 20
_BATCH_ROWS = 5_000
# Fixed value: an id behind all others.
_LAST = (1 << 63) - 1
_LINE = "key int, seam boolean, line bigint, value string, sound boolean"
_ROW = "path string, line bigint, cells array<string>, text string, reject string"
_ROW_KINDS = {"path": pa.string(), "line": pa.int64(), "cells": pa.list_(pa.string()), "text": pa.string(),
              "reject": pa.string()}


def _listed(reader, glob: str):
    return (reader.format("binaryFile").schema(FILES).option("pathGlobFilter", glob)
            .option("recursiveFileLookup", True))


def files(spark: SparkSession, path: str | list[str], glob: str) -> DataFrame:
    """``path, length`` of the files of a folder, or of those named one by one."""
    where = path if isinstance(path, str) else [_plain(name) for name in path]
    return _listed(spark.read, glob).load(where).select("path", "length")


def stream_files(spark: SparkSession, path: str, glob: str, max_files: int | None = None) -> DataFrame:
    reader = _listed(spark.readStream, glob)
    reader = reader.option("maxFilesPerTrigger", max_files) if max_files else reader
    return reader.load(path).select("path", "length")


def _plain(name: str) -> str:
    """A name that readers don't take for a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", name)


def _pieces(files: DataFrame, separator: str | None = None) -> DataFrame | None:
    """``file, size, block, id, value``: the lines of the files, or what stands before each ``separator``, numbered in
    order inside of each block. The names come to the driver, as they do to list the files."""
    names = [_plain(row.path) for row in files.filter(F.col("length") > 0).select("path").toLocalIterator()]
    if not names:
        return None
    reader = files.sparkSession.read
    reader = reader.option("lineSep", separator) if separator else reader
    return reader.text(names).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), "value")


def _path(file: Column) -> Column:
    """The name of a file from its address."""
    return F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B")))


def _in_order(pieces: DataFrame, *more: str) -> DataFrame:
    return (pieces.repartition("file").sortWithinPartitions("file", "block", "id")
            .select("path", F.make_valid_utf8("value").alias("value"), F.is_valid_utf8("value").alias("sound"), *more))


def _packed(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    some: list[tuple] = []
    for row in rows:
        some.append(row)
        if len(some) == _BATCH_ROWS:
            yield _batch(some)
            some = []
    if some:
        yield _batch(some)


def _batch(some: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), _ROW_KINDS.values())], names=list(_ROW_KINDS))


def _by_file(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Iterator[tuple]]]:
    """Rows that follow each other, file by file, without the name of the file."""
    rows = chain.from_iterable(zip(*[c.to_numpy(zero_copy_only=False).tolist() for c in batch.columns]) for batch in batches)
    for name, own in groupby(rows, itemgetter(0)):
        yield name, map(itemgetter(slice(1, None)), own)


def _records(lines: Iterator[tuple[str, bool]], short: list[int] | None = None) -> Iterator[tuple[int, list[str] | None, str]]:
    """Last line, cells and text of each CSV record. One that can't be parsed has no cells and ends with
    its first line, after which parsing goes on; the text of others is not given. ``short`` gets a number
    for each record that wants more lines than there are."""
    csv.field_size_limit(sys.maxsize)
    again: deque[tuple[str, bool]] = deque()
    at, done = 0, False
    while not done:
        used: list[tuple[str, bool]] = []

        def given() -> Iterator[str]:
            size = 0
            while (line := again.popleft() if again else next(lines, None)) is not None:
                size = size + len(line[0]) if used else len(line[0])
                if size > LONGEST and used:
                    again.appendleft(line)
                    raise csv.Error("not closed")
                used.append(line)
                yield line[0] + "\n"
            if used and short is not None:
                short.append(at)

        try:
            for row in csv.reader(given(), strict=True):
                at += len(used)
                sound = all(ok for _, ok in used)
                yield at, row if sound else None, "" if sound else "\n".join(text for text, _ in used)
                used.clear()
            done = True
        except csv.Error:
            at += 1
            yield at, None, used[0][0]
            again.extendleft(reversed(used[1:]))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """Lines that follow each other, key by key."""
    def parts() -> Iterator[tuple[int, pa.RecordBatch]]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            ends = [*(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for begin, end in zip([0, *ends], ends):
                if end > begin:
                    yield int(keys[begin]), batch.slice(begin, end - begin)

    for key, own in groupby(parts(), itemgetter(0)):
        yield key, map(itemgetter(1), own)


def _many_records(batches: Iterator[pa.RecordBatch], short: list[int]) -> Iterator[list[tuple[int, list[str] | None, str]]]:
    """``_records`` of lines that begin with a record, by the numbers that these bear, many at a time."""
    at, held = 0, []

    def one_by_one(lines: list[str], sound: list[bool]) -> Iterator[list[tuple]]:
        rest = chain(zip(lines, sound), chain.from_iterable(
            zip(b.column("value").to_pylist(), b.column("sound").to_pylist()) for b in batches))
        for line, row, text in _records(rest, short):
            yield [(at + line, row, text)]

    for batch in batches:
        at = at if held else batch.column("line")[0].as_py() - 1
        lines = held + batch.column("value").to_pylist()
        if not pc.all(batch.column("sound")).as_py() or sum(map(len, lines)) > LONGEST:
            yield from one_by_one(lines, [True] * len(held) + batch.column("sound").to_pylist())
            return
        reader = csv.reader([line + "\n" for line in lines], strict=True)
        found, failed = [], False
        try:
            for row in reader:
                found.append((at + reader.line_num, row, ""))
        except csv.Error:
            failed = True
        done = found[-1][0] - at if found else 0
        yield found
        at += done
        # A record that fails at the last line may only want the next ones, but not for long.
        if failed and (reader.line_num < len(lines) or (held and not done)):
            yield from one_by_one(lines[done:], [True] * (len(lines) - done))
            return
        held = lines[done:]
    if held:
        yield from one_by_one(held, [True] * len(held))


def _row_batch(found: list[tuple[int, list[str] | None, str]], path: str, places: list[int | None], width: int) -> pa.RecordBatch:
    """The rows of records, as ``_file_rows`` gives them, for a header of ``width`` columns."""
    rows = []
    for line, row, text in found:
        if row is None:
            rows.append((line, None, text, UNREADABLE))
        elif len(row) > width:
            rows.append((line, None, ",".join(row), TOO_LONG))
        elif row:
            row += [None] * (width + 1 - len(row))
            rows.append((line, [row[p] for p in places], None, None))
    columns = zip(*rows) if rows else [()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array([path] * len(rows), pa.string()), *[pa.array(c, t) for c, t in zip(columns, list(_ROW_KINDS.values())[1:])]],
        names=list(_ROW_KINDS))


def _file_rows(name: str, lines: Iterator[tuple[str, bool]], names: list[str]) -> Iterator[tuple]:
    """The rows of a CSV file whose lines don't stand for themselves."""
    header, places = None, []
    for line, row, text in _records(lines):
        if row is None:
            header = [] if header is None else header
            yield name, line, None, text, UNREADABLE
        elif header is None:
            header = [cell.strip().removeprefix("\ufeff").strip() for cell in row]
            places = [header.index(c) if c in header else None for c in names]
        elif len(row) > len(header):
            # Without a header that can be read no cell has a name.
            yield name, line, None, ",".join(row), TOO_LONG if header else UNREADABLE
        elif row:
            yield name, line, [row[p] if p is not None and p < len(row) else None for p in places], None, None


def _csv_layout(lines: DataFrame, names: list[str]) -> DataFrame:
    """A row per block: where the columns of ``names`` stand in its file, how many columns there are, what to add
    to ``id`` for the number of a line, whether the file has a header that can be read (``simple``) and, of the lines
    with an odd number of quotes, how many there are and which are the first and the last."""
    value = F.col("value")
    quoted = F.contains(value, F.lit('"'))
    odd = F.when(quoted, (F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))) % 2).otherwise(0)
    none = F.lit(None)
    blocks = lines.groupBy("file", "block").agg(
        F.count("*").alias("n"), F.min("id").alias("first"), F.sum(odd).alias("odd"), F.max(quoted).alias("quoted"),
        F.min(F.when(odd == 1, F.col("id"))).alias("odd_from"), F.max(F.when(odd == 1, F.col("id"))).alias("odd_to"))
    # Headers are looked for apart, among the lines that name a column, so that no text is sorted with the counts.
    named = reduce(lambda a, b: a | b, [F.contains(value, F.lit(name)) for name in names])
    tops = lines.filter((F.col("block") == 0) & named).groupBy("file").agg(F.min("id").alias("id"), F.min_by("value", "id").alias("top"))
    both = blocks.select("*", none.cast("bigint").alias("id"), none.cast("string").alias("top")).unionByName(tops.select(
        "file", F.lit(0).cast("bigint").alias("block"), none.cast("bigint").alias("n"), none.cast("bigint").alias("first"),
        none.cast("bigint").alias("odd"), none.cast("boolean").alias("quoted"), none.cast("bigint").alias("odd_from"),
        none.cast("bigint").alias("odd_to"), "id", "top"))
    found = both.groupBy("file", "block").agg(*[
        F.max(c).alias(c) for c in ("n", "first", "odd", "quoted", "odd_from", "odd_to", "id", "top")])
    of_file = Window.partitionBy("file").orderBy("block")
    # A first line that names no column is a header all the same.
    top = F.coalesce(F.first(F.when(F.col("id") == F.col("first"), F.col("top"))).over(of_file), F.lit(""))
    cell = r'("[^",]*"|[^",]*)'
    cells = F.transform(F.split(F.regexp_replace(F.make_valid_utf8("header"), '["\ufeff]', ""), ","), lambda c: F.trim(c))
    places = F.transform(F.array(*[F.array_position(cells, name) - 1 for name in names]), lambda p: F.when(p >= 0, p.cast("int")))
    # Files whose header isn't known for sure are read line after line from their first.
    simple = (F.col("header") != "") & F.is_valid_utf8("header") & F.col("header").rlike(f"^{cell}(,{cell})*$")
    return found.select(
        "*", top.alias("header"),
        F.coalesce(F.sum("n").over(of_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")).select(
        "file", _path(F.col("file")).alias("path"), "block", places.alias("places"), F.size(cells).alias("width"),
        (F.col("before") - F.col("first") + 1).alias("add"), simple.alias("simple"), "quoted", "odd",
        *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("odd_from", "odd_to")])


class _Block(NamedTuple):
    """A block of a file by its quotes: lines with ids up to ``head`` belong to a record begun in the block ``opened``,
    those from ``tail`` on to one that goes on in the next block."""
    key: int
    file: str
    path: str
    block: int
    places: list[int | None]
    width: int
    add: int
    route: str
    head: int | None
    tail: int | None
    opened: int | None


def _blocks(layout: pd.DataFrame) -> tuple[list[_Block], set[int]]:
    """The blocks of all files, with keys from 0, and those that end with a record which the file doesn't close."""
    found, unclosed = [], set()
    for file, own in layout.sort_values(["file", "block"]).groupby("file", sort=False):
        odd = opened = None
        route = "whole" if not own["simple"].all() else "parts" if own["odd"].any() else "lines"
        for r in own.itertuples():
            key, begun, some = len(found), bool(odd), r.odd > 0
            odd = begun != bool(r.odd % 2)
            head = None if not begun else int(r.odd_from) if some else _LAST
            tail = int(r.odd_to) if odd and some else None
            found.append(_Block(key, file, r.path, int(r.block), [None if p is None or p != p else int(p) for p in r.places],
                                int(r.width), int(r.add), route, head, tail, opened if begun else None))
            opened = key if tail is not None else opened
        if odd and route == "parts":
            unclosed.add(opened)
    return found, unclosed


def _csv_rows(files: DataFrame, names: list[str]) -> DataFrame:
    """``path, line, cells, text, reject`` of each row, cells in the order of ``names``.

    Columns are found by their name in the header; one that a file lacks is null and one that the
    schema lacks is left out. Quoted cells may hold line breaks.
    """
    spark = files.sparkSession
    lines = _pieces(files)
    if lines is None:
        return spark.createDataFrame([], _ROW)
    # A row per block of the files, of which the driver holds the names.
    layout = _csv_layout(lines, names).toPandas()
    blocks, unclosed = _blocks(layout)
    own = [(b.path, [b.width if p is None else p for p in b.places], b.width) for b in blocks]

    def placed_by(blocks: list[_Block]) -> DataFrame:
        known = spark.createDataFrame(blocks, "key int, file string, path string, block bigint, places array<int>, width int,"
                                      " add bigint, route string, head bigint, tail bigint, opened int")
        return lines.join(F.broadcast(known), ["file", "block"]).withColumn("line", F.col("id") + F.col("add"))

    def cut(placed: DataFrame) -> DataFrame:
        """The lines of files that are read by block, those of records over its end under the block of their first."""
        head, tail = F.coalesce(F.col("id") <= F.col("head"), F.lit(False)), F.coalesce(F.col("id") >= F.col("tail"), F.lit(False))
        return placed.filter((F.col("route") == "parts") & (F.col("line") > 1)).select(
            F.when(head, F.col("opened")).otherwise(F.col("key")).alias("key"), (head | tail).alias("seam"), "line",
            F.make_valid_utf8("value").alias("value"), F.is_valid_utf8("value").alias("sound"))

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Lines of seams as they are, and a line without text for each block with a record that wants more lines."""
        seams: list[pa.RecordBatch] = []

        def inner() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                seams.append(pa.RecordBatch.from_arrays(batch.filter(batch.column("seam")).columns, names=batch.schema.names))
                yield batch.filter(pc.invert(batch.column("seam")))

        for key, some in _runs(inner()):
            short: list[int] = []
            for _ in _many_records(some, short):
                yield from seams
                seams.clear()
            if short:
                yield lost(key)
        yield from seams

    def lost(key: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([key], pa.int32()), pa.array([False]), pa.array([0], pa.int64()), pa.array([None], pa.string()), pa.array([False])],
            names=["key", "seam", "line", "value", "sound"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, some in _runs(batches):
            short: list[int] = []
            for _ in _many_records(some, short):
                pass
            if short and key not in unclosed:
                yield lost(key)

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, some in _runs(batches):
            for found in _many_records(some, []):
                yield _row_batch(found, *own[key])

    placed, seams = placed_by(blocks), None
    if any(b.route == "parts" for b in blocks):
        # Each block is parsed from where its first record begins by the quotes before. If no block and no record over
        # blocks wants more lines than it has, the next one begins there indeed; else the file is read in order.
        ensure_checkpoint_dir(spark)
        found = cut(placed).mapInArrow(checked, _LINE).checkpoint()
        seams = found.filter("seam").repartition("key").sortWithinPartitions("key", "line")
        bad = found.filter("not seam").unionByName(seams.mapInArrow(joined, _LINE)).select("key").distinct().collect()
        wrong = {blocks[row.key].file for row in bad}
        if wrong:
            blocks = [b._replace(route="whole") if b.file in wrong else b for b in blocks]
            placed = placed_by(blocks)
            kept = [b.key for b in blocks if b.route == "parts"]
            seams = seams.join(F.broadcast(spark.createDataFrame([(k,) for k in kept], "key int")), "key", "left_semi")
            seams = seams.repartition("key").sortWithinPartitions("key", "line")
    rows = placed.filter((F.col("route") == "lines") & (F.col("line") > 1) & (F.col("value") != ""))
    cells = F.split("value", ",", -1)
    sound = F.is_valid_utf8("value")
    plain = rows.filter(~F.contains("value", F.lit('"'))).select("path", "line", "places", "width", "value", sound.alias("sound"), cells.alias("cells"))
    reject = F.when(~F.col("sound"), UNREADABLE).when(F.size("cells") > F.col("width"), TOO_LONG)
    parts = [plain.withColumn("reject", reject).select(
        "path", "line",
        F.when(F.col("reject").isNull(), F.transform("places", lambda p: F.get("cells", p))).alias("cells"),
        F.when(F.col("reject").isNotNull(), F.make_valid_utf8("value")).alias("text"), "reject")]

    def quoted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parsed() -> Iterator[tuple]:
            for batch in batches:
                for name, line, places, width, value, ok in zip(*[c.to_pylist() for c in batch.columns]):
                    _, row, text = next(_records(iter([(value, ok)])))
                    if row is None:
                        yield name, line, None, text, UNREADABLE
                    elif len(row) > width:
                        yield name, line, None, ",".join(row), TOO_LONG
                    else:
                        yield name, line, [row[p] if p is not None and p < len(row) else None for p in places], None, None

        return _packed(parsed())

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _packed(row for name, own in _by_file(batches) for row in _file_rows(name, own, names))

    routes = {b.route for b in blocks}
    if layout["quoted"][layout["file"].isin({b.file for b in blocks if b.route == "lines"})].any():
        some = rows.filter(F.contains("value", F.lit('"')))
        parts.append(some.select("path", "line", "places", "width", F.make_valid_utf8("value").alias("value"), sound.alias("sound"))
                     .mapInArrow(quoted, _ROW))
    if "parts" in routes:
        parts.append(cut(placed).filter("not seam").mapInArrow(parsed, _ROW))
        parts.append(seams.mapInArrow(parsed, _ROW))
    if "whole" in routes:
        parts.append(_in_order(placed.filter(F.col("route") == "whole")).mapInArrow(whole, _ROW))
    return reduce(DataFrame.unionByName, parts)


def _braced(read: int, size: int) -> bool:
    """Whether a file ends with a brace, by the bytes of its pieces with one for each brace. Spark's reader
    leaves out the three bytes of a byte order mark."""
    return read in (size, size - 3)


def _elements(chunks: Iterator[tuple[str, bool, int, int]]) -> Iterator[str]:
    """The elements of a JSON document given in pieces up to each closing brace, or the document itself if it is
    no list. A document that can't be read raises ``ValueError``."""
    def text() -> Iterator[str]:
        read, size, held = 0, 0, None
        for value, sound, size, length in chunks:
            if not sound:
                raise ValueError("no text")
            if held is not None:
                yield held + "}"
            held = value
            read += length + 1
        if held is not None:
            yield held + "}" * _braced(read, size)

    depth, quoted, listed, after = 0, False, None, False
    held: list[str] = []
    begun = 0
    for chunk in text():
        start = 0
        if listed is None:
            if not chunk.strip("\ufeff \t\r\n"):
                continue
            listed = chunk.lstrip("\ufeff \t\r\n").startswith("[")
            start = chunk.index("[") + 1 if listed else 0
        if not listed:
            held.append(chunk)
            continue
        if depth < 0 and chunk.strip():
            raise ValueError("text behind the list")
        for mark in re.compile(r'\\.|["\[\]{},]', re.S).finditer(chunk, start):
            at, sign = mark.start(), mark[0]
            if sign == '"':
                quoted = not quoted
            elif quoted or sign[0] == "\\":
                continue
            elif sign in "[{":
                depth += 1
            elif sign in "]}" and depth > 0:
                depth -= 1
            elif sign == "}" or depth < 0:
                raise ValueError("not balanced")
            elif depth == 0:
                element = ("".join(held) + chunk[start:at]).strip()
                if element or sign == "," or after:
                    json.loads(element)
                    yield element
                held, begun, start, after = [], 0, at + 1, sign == ","
                if sign == "]":
                    depth = -1
                    if chunk[start:].strip():
                        raise ValueError("text behind the list")
        if depth >= 0:
            held.append(chunk[start:])
            begun += len(held[-1])
            if begun > LONGEST:
                raise ValueError("an element without end")
    if listed and depth >= 0:
        raise ValueError("a list without end")
    if not listed:
        document = "".join(held).strip("\ufeff \t\r\n")
        json.loads(document)
        yield document


def _json_pieces(chunks: DataFrame) -> DataFrame:
    """Pieces with the length of their text, its first sign (``begin``, 0 if none), the text behind a bracket or comma
    (``cut``) and whether that opens an object."""
    space, mark = " \t\n\x0b\f\r", "\ufeff"
    lead = F.ltrim(F.when(F.col("sound"), F.col("value")), F.lit(space + mark))
    first = F.when(lead == "", 0).otherwise(F.ascii(lead))
    cut = F.when(first.isin(ord("["), ord(",")), F.ltrim(F.substr(lead, F.lit(2)), F.lit(space))).otherwise(lead)
    # The generator keeps texts from being cut anew for each use of them.
    pieces = chunks.withColumn("sound", F.is_valid_utf8("value")).select("*", F.inline(F.array(F.struct(
        F.octet_length("value").alias("length"), F.coalesce(first, F.lit(0)).alias("begin"), cut.alias("cut")))))
    return pieces.withColumn("opens", F.col("cut").startswith("{"))


def _json_layout(flat: DataFrame) -> DataFrame:
    """``file, flat``: whether a file holds one flat object or a list of them, so that each piece is one of them."""
    rest = ~F.coalesce(F.col("opens"), F.lit(False))
    keys = F.json_object_keys(F.concat("cut", F.lit("}"))).isNotNull() & (F.locate("{", F.col("cut"), 2) == 0)
    own = F.when(~rest, keys).otherwise(F.col("value").rlike(r"^[\s\ufeff]*[\[]?\s*\]?\s*$"))
    # By block first, so that only numbers are kept and compared where the rows are many.
    blocks = flat.groupBy("file", "block").agg(
        F.bool_and(F.col("sound") & own).alias("simple"), F.min_by("begin", "id").alias("first"), F.max_by("begin", "id").alias("last"),
        F.count_if(F.col("begin") == ord("[")).alias("opened"), F.count_if(F.col("begin") == ord(",")).alias("commas"),
        F.count_if(rest & (F.col("begin") == ord("]"))).alias("closed"), F.count_if(~rest).alias("objects"),
        F.max("size").alias("size"), F.sum(F.col("length") + 1).alias("read"))
    files = blocks.groupBy("file").agg(
        F.bool_and("simple").alias("simple"), F.min_by("first", "block").alias("first"), F.max_by("last", "block").alias("last"),
        *[F.sum(c).alias(c) for c in ("opened", "commas", "closed", "objects")],
        (F.max("size") - F.sum("read")).isin(0, 3).alias("braced"))
    one = (F.col("opened") == 0) & (F.col("objects") == 1) & (F.col("commas") == 0) & (F.col("closed") == 0)
    many = ((F.col("first") == ord("[")) & (F.col("opened") == 1) & (F.col("closed") == 1) & (F.col("objects") > 0)
            & (F.col("commas") == F.col("objects") - 1) & (F.col("last").isin(ord("]"), 0)))
    return files.select("file", (F.col("simple") & (one | many) & ~(F.col("braced") & many)).alias("flat"))


def _json_rows(files: DataFrame, names: list[str]) -> DataFrame:
    """The same for documents that hold one object or a list of them; ``line`` is the number of the element, and
    null in documents of flat objects, whose parts are read on their own."""
    spark = files.sparkSession
    empty = spark.createDataFrame([], "path string, line bigint, text string")
    chunks = _pieces(files, "}")
    if chunks is None:
        return _objects(empty, names)
    flat = _json_pieces(chunks)
    rest = ~F.coalesce(F.col("opens"), F.lit(False))
    whole = F.concat("cut", F.lit("}"))
    layout = _json_layout(flat)
    # A row per file, of which the driver holds the names.
    seen = layout.select("file", _path(F.col("file")).alias("path"), "flat").toPandas()
    known = spark.createDataFrame([(r.file, r.path, bool(r.flat)) for r in seen.itertuples()], "file string, path string, flat boolean")
    # Names are only looked up where files of both kinds are there.
    alone = seen["flat"].all()
    own = flat.withColumn("path", _path(F.col("file"))) if alone else flat.join(F.broadcast(known.filter("flat")), "file")
    parts = [own.filter(~rest).select("path", F.lit(None).cast("bigint").alias("line"), whole.alias("text"))]
    if not alone:
        others = flat.select("file", "size", "block", "id", "length", F.when(F.col("sound"), F.col("value")).alias("value")).join(
            F.broadcast(known.filter("not flat")), "file")
        ordered = _in_order(others.withColumn("value", F.coalesce("value", F.unhex(F.lit("FF")).cast("string"))), "size", "length")

        def broken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for name, own in _by_file(batches):
                try:
                    for _ in _elements(own):
                        pass
                except (ValueError, RecursionError):
                    yield pa.RecordBatch.from_arrays([pa.array([name])], names=["path"])

        bad = [row.path for row in ordered.mapInArrow(broken, "path string").collect()]
        lost = frozenset(bad)

        def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for name, own in _by_file(batches):
                if name not in lost:
                    for line, element in enumerate(_elements(own)):
                        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([line], pa.int64()), pa.array([element])],
                                                         names=["path", "line", "text"])

        parts.append(ordered.mapInArrow(elements, "path string, line bigint, text string"))
        parts.append(spark.createDataFrame([(name, 0, None) for name in bad], empty.schema))
    return _objects(reduce(DataFrame.unionByName, parts), names)


def _objects(rows: DataFrame, names: list[str]) -> DataFrame:
    fields = T.StructType([T.StructField(name, T.StringType()) for name in names])
    rows = rows.withColumn("record", F.explode(F.array(parse_object(F.col("text"), fields))))
    bad = F.col("record").isNull() | F.col(f"record.{CORRUPT}").isNotNull()
    return rows.select(
        "path", "line", F.when(~bad, F.array(*[F.col(f"record.{name}") for name in names])).alias("cells"), "text",
        F.when(F.col("text").isNull(), UNREADABLE).when(bad, NO_OBJECT).alias("reject"))


def _value(given: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return given
    value = number(given).try_cast(kind)
    if not isinstance(kind, T.LongType):
        return value
    # Whole numbers beyond the exact range of doubles are read as they stand. Only these are cast as whole numbers: a text
    # that isn't one, like 3.0, costs this cast an exception, which takes many times as long as all else of its row.
    return F.when(value.between(1 - (1 << 53), (1 << 53) - 1), value).otherwise(F.coalesce(given.try_cast("bigint"), value))


def typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``path, line, text, reject`` and the columns of the schema: rows with a cell that doesn't fit are
    rejects that name its column, and have no values."""
    base = ["path", "line", "text", "reject"]
    texts = [isinstance(f.dataType, T.StringType) for f in schema]
    given = [F.when(F.get("cells", i) != "" if text else ~F.get("cells", i).isin(MISSING), F.get("cells", i)).alias(f"_g{i}")
             for i, text in enumerate(texts)]
    # The generators keep the cells from being read anew for each use of them below.
    rows = rows.select(*base, F.inline(F.array(F.struct(*given))))
    values = [_value(F.col(f"_g{i}"), f.dataType).alias(f"_v{i}") for i, f in enumerate(schema)]
    rows = rows.select(*base, *[f"_g{i}" for i in range(len(texts))], F.inline(F.array(F.struct(*values))))
    bad = [F.col(f"_g{i}").isNotNull() & F.col(f"_v{i}").isNull() for i in range(len(texts))]
    fits = F.col("reject").isNull() & ~reduce(lambda a, b: a | b, bad)
    misfits = F.concat_ws(",", *[F.when(b, F.lit(f.name)) for b, f in zip(bad, schema)])
    reject = F.when(~fits, F.coalesce("reject", F.concat(F.lit("does not fit: "), misfits)))
    text = F.coalesce("text", F.when(F.col("reject").isNull() & ~fits, F.concat_ws(",", *[F.coalesce(f"_g{i}", F.lit("")) for i in range(len(texts))])))
    return rows.select("path", "line", text.alias("text"), reject.alias("reject"),
                       *[F.when(fits, F.col(f"_v{i}")).alias(f.name) for i, f in enumerate(schema)])


def parse_csv(files: DataFrame, schema: T.StructType) -> DataFrame:
    return typed(_csv_rows(files, schema.names), schema)


def parse_json(files: DataFrame, schema: T.StructType) -> DataFrame:
    return typed(_json_rows(files, schema.names), schema)


def landed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows that fit, in the columns of the schema."""
    return rows.filter(F.col("reject").isNull()).select(*schema.names)


def rejected(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reject").isNotNull()).select("path", "line", "text", "reject")


def _counted(rows: DataFrame) -> DataFrame:
    """``rows``; those that ``landed`` leaves out are counted by the observed metrics ``landing``."""
    return rows.observe("landing", F.count("*").alias("rows"), F.count("reject").alias("rejected"))


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, glob: str = CSV_GLOB) -> DataFrame:
    return landed(_counted(parse_csv(files(spark, path, glob), schema)), schema)


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType,
              glob: str = JSON_GLOB) -> DataFrame:
    return landed(_counted(parse_json(files(spark, path, glob), schema)), schema)
