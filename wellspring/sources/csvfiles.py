"""CSV folders as all-text DataFrames.

Three properties of real extracts matter here: files of one folder may order
their columns differently, a quoted field may hold line breaks, and a single
file may hold most of the rows. Spark's reader can split a CSV file between tasks
only when no field spans lines, so :func:`layouts` first scans the text once (in
parallel, splittable) and finds out per file what its header is and whether any
quote is left open at the end of a line. Files are then read in groups of equal
layout. Of those with open quotes, small ones are read unsplit; one that a text scan
would split is cut at the true ends of its records instead, see :func:`records`; the
tasks that do so take plainly written records apart as well.
"""

from __future__ import annotations

import csv
import os
import re
import urllib.parse
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Column that names the file a row came from.
FILE = "source_file"


def _lines(spark: SparkSession, paths, **options) -> DataFrame:
    """Lines with their file, also as a number, the start and length of their split and
    their order in it."""
    return spark.read.options(**options).text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )


class _Told(NamedTuple):
    """A split, and what its lines tell of it."""

    path: str
    start: int
    length: int
    quotes: int  # lines with an odd number of quotes
    returns: bool  # whether the first line ends in a carriage return
    inner: bool  # whether one is elsewhere in a line
    bytes: int  # of the lines, each with a line feed
    first: int  # places of the first and the last line
    last: int
    opened: int | None  # of the first and the last line with odd quotes
    reopened: int | None
    text: int | None  # of the first line that is not blank
    header: str | None  # that line, where a file begins


def _told(lines: DataFrame) -> list[_Told]:
    """What lines tell of the splits they are in. A row per split comes to the driver."""

    odd_quotes = _odd_quotes()

    def run(batches):
        now = None
        kinds = {
            "file": pa.int64(), "start": pa.int64(), "length": pa.int64(), "quotes": pa.int64(), "returns": pa.bool_(), "inner": pa.bool_(), "bytes": pa.int64(),
            "first": pa.int64(), "last": pa.int64(), "opened": pa.int64(), "reopened": pa.int64(), "text": pa.int64(), "header": pa.string(),
        }

        def row(split):
            return pa.RecordBatch.from_arrays([pa.array([split.get(name)], kind) for name, kind in kinds.items()], names=list(kinds))

        for batch in batches:
            file, start, length = (batch.column(c).to_numpy() for c in ("file", "start", "length"))
            change = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
            for a, b in zip([0, *change.tolist()], [*change.tolist(), len(file)], strict=True):
                if a == b:
                    continue
                value, place = batch.column("value").slice(a, b - a), batch.column("place")[a].as_py()
                if now is None or (now["file"], now["start"]) != (file[a], start[a]):
                    if now:
                        yield row(now)
                    now = {"file": int(file[a]), "start": int(start[a]), "length": int(length[a]), "quotes": 0, "bytes": 0, "first": place}
                    now |= {"returns": value[0].as_py().endswith("\r"), "inner": False}
                odd = np.flatnonzero(odd_quotes(value))
                sizes = pc.binary_length(value)
                now["quotes"] += len(odd)
                now["bytes"] += pc.sum(sizes).as_py() + b - a
                now["last"] = place + b - a - 1
                at = pc.find_substring(value, "\r")
                now["inner"] |= pc.any(pc.and_(pc.greater_equal(at, 0), pc.less(at, pc.subtract(sizes, 1)))).as_py()
                if len(odd):
                    now["opened"], now["reopened"] = now.get("opened", place + int(odd[0])), place + int(odd[-1])
                if "text" not in now:
                    at = next((i for i, line in enumerate(value) if line.as_py().removesuffix("\r").strip(" ")), None)
                    if at is not None:
                        now["text"] = place + at
                        now["header"] = value[at].as_py().removesuffix("\r") if now["start"] == 0 else None
        if now:
            yield row(now)

    kind = "file bigint, start bigint, length bigint, quotes bigint, returns boolean, inner boolean, bytes bigint"
    kind += ", first bigint, last bigint, opened bigint, reopened bigint, text bigint, header string"
    rows = lines.select("file", "start", "length", "place", "value").mapInArrow(run, kind).collect()
    listed = lines.inputFiles()  # in two spellings, of which a line's file has one
    listed = sorted({*listed, *(re.sub("^([^:/]+):///", r"\1:/", path) for path in listed)})
    paths = lines.sparkSession.createDataFrame([(path,) for path in listed], "path string").select("path", F.xxhash64("path"))
    names = {number: path for path, number in paths.collect()}
    if any(r.file not in names for r in rows):
        paths = lines.select("path", "file").distinct()
        names = {number: path for path, number in paths.collect()}
    if len(names) < paths.count():
        raise RuntimeError("files cannot be told by their numbers")
    return sorted((_Told(names[r.file], *r[1:]) for r in rows), key=lambda t: (t.path, t.start))


def readable(name: str) -> str:
    """The path of a file as a reader takes it, from its name in ``_metadata``, which is
    a URI; characters that a pattern would take as its own are marked."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", urllib.parse.unquote(name))


def layouts(spark: SparkSession, paths, **options) -> list[tuple[tuple[str, ...], bool, list[str]]]:
    """(header, has open quotes, paths) per group of files with the same layout."""
    groups: dict[tuple, list[str]] = {}
    for (names, way), files in _ways(spark, paths, **options).items():
        groups.setdefault((names, way != PLAIN), []).extend(files)
    return [(names, is_open, sorted(files)) for (names, is_open), files in sorted(groups.items())]


#: Ways to read a file: without open quotes, with some but small, of many splits.
PLAIN, WHOLE, CUT = "plain", "whole", "cut"


#: Longer lines are left out of the first scan, which then does not count.
_LONGEST = {"mapreduce.input.linerecordreader.line.maxlength": 1 << 26}


class _Ways(dict):
    """Files by header and way to read them."""

    #: The scan of all of them as lines that end at line feeds, if that has served.
    surveyed: tuple[DataFrame, list[_Told]] | None = None


def _ways(spark: SparkSession, paths, **options) -> _Ways:
    """Files by header and way to read them.

    What comes to the driver is one short row per split of a file.
    """
    lines = _lines(spark, paths, lineSep="\n", **_LONGEST, **options)
    told = _told(lines) if not any(re.search(r"\.(gz|bz2|deflate|lz4|snappy|zst)$", path) for path in lines.inputFiles()) else []
    size: dict[str, int] = {}
    for t in told:
        size[t.path] = size.get(t.path, 0) + t.bytes - t.length
    served = bool(told) and all(left in (0, 1) for left in size.values()) and not any(t.inner for t in told)
    if not served:
        told = _told(_lines(spark, paths, **options))
    files: dict[str, list] = {}
    for t in told:
        header, is_open, _ = files.get(t.path, (None, False, 0))
        files[t.path] = [t.header if t.start == 0 else header, is_open or t.quotes > 0, t.start]
    groups: dict[tuple, list[str]] = {}
    for path, (header, is_open, last) in files.items():
        if header:
            names = tuple(name.strip() for name in next(csv.reader([header.lstrip("\ufeff")])))
            way = PLAIN if not is_open else CUT if last else WHOLE
            groups.setdefault((names, way), []).append(readable(path))
    ways = _Ways({key: sorted(found) for key, found in sorted(groups.items())})
    ways.surveyed = (lines, told) if served else None
    return ways


RESPLIT = "the scan was split in another way the second time; read again"


def records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, record): the records of CSV files below their header as text, read split.

    Whether a split begins inside quotes follows from the quotes before it: their parity
    per split, summed up over the splits of the file. Knowing that, every task joins the
    lines of its records by itself. What a split's edge cuts, one record at most, is put
    together from its pieces afterwards; nothing else is shuffled. A quote that is never
    closed takes the rest of its file, less a line feed at the end.
    """
    scan = _Scan(spark, paths)
    pieces = scan.pieces().where(F.col("edge") == 0).select("path", "record")
    return pieces.unionByName(scan.cut_records())


#: Pieces of a record that a split's edge cuts.
PASSES, ENDS, BEGINS = 1, 2, 3


def _pieces(spark: SparkSession, paths: list[str], only_cut: bool = False) -> DataFrame:
    """(path, start, edge, record): whole records with edge 0, or with ``only_cut`` per
    split the piece of a record that passes through it, ends or begins in it."""
    scan = _Scan(spark, paths)
    return scan.cut_pieces() if only_cut else scan.pieces()


class _Split(NamedTuple):
    path: str
    start: int
    inside: bool  # whether it begins inside quotes
    returns: bool  # whether lines of the file end in a carriage return as well


class _Scan:
    """Files as lines, and what a first scan has found out of their splits: a row per
    split, as many as the scan has tasks at most, comes to the driver."""

    def __init__(self, spark: SparkSession, paths: list[str], surveyed: tuple[DataFrame, list[_Told]] | None = None):
        # Lines end at line feeds. If the first one of a file ends in a carriage return too,
        # both together are a line's end, also inside quotes, else the latter is text.
        # Other files beside them would split these in another way.
        if not surveyed or {readable(t.path) for t in surveyed[1]} != set(paths):
            lines = _lines(spark, paths, lineSep="\n")
            surveyed = lines, _told(lines)
        lines, told = surveyed
        number = F.xxhash64("file", "start", "length")
        self.spark, self.lines = spark, lines.withColumn("split", number)
        of = spark.createDataFrame([(i, *t[:3]) for i, t in enumerate(told)], "i int, path string, start bigint, length bigint")
        numbers = dict(of.select("i", F.xxhash64(F.xxhash64("path").alias("file"), "start", "length")).collect())
        self.splits: dict[int, _Split] = {}
        #: Lines of cut records: split, edge, first and last place.
        self.edges: list[tuple[int, int, int, int]] = []
        path = None
        for i, t in enumerate(told):
            if t.path != path:
                path, inside, returns = t.path, False, t.start == 0 and t.returns
            if numbers[i] in self.splits:
                raise RuntimeError("splits cannot be told by their numbers")
            self.splits[numbers[i]] = _Split(path, t.start, inside, returns)
            if inside:
                self.edges.append((numbers[i], ENDS if t.quotes else PASSES, t.first, t.opened if t.quotes else t.last))
            # A header that is cut is no record.
            header = t.start == 0 and t.quotes == 1 and t.opened == t.text
            inside ^= t.quotes % 2 == 1
            if inside and t.quotes and not header:
                self.edges.append((numbers[i], BEGINS, t.reopened, t.last))

    def cut_pieces(self) -> DataFrame:
        """(path, start, edge, record): per split the pieces of records its edges cut."""
        rows = [(*edge, self.splits[edge[0]].returns) for edge in self.edges]
        edges = self.spark.createDataFrame(rows, "_split bigint, edge int, lo bigint, hi bigint, returns boolean")
        mine = (F.col("split") == F.col("_split")) & F.col("place").between(F.col("lo"), F.col("hi"))
        found = self.lines.join(F.broadcast(edges), mine)
        value = F.when(F.col("returns") & F.endswith("value", F.lit("\r")), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
        found = found.groupBy("path", "start", "edge").agg(
            F.sort_array(F.collect_list(F.struct("place", value.alias("line")))).alias("lines"), F.first(F.col("hi") - F.col("lo") + 1).alias("n")
        )
        record = F.array_join(F.col("lines.line"), "\n")
        return found.select("path", "start", "edge", F.when(F.size("lines") == F.col("n"), record).otherwise(F.raise_error(F.lit(RESPLIT))).alias("record"))

    def cut_records(self) -> DataFrame:
        """(path, record): the records that splits' edges cut, put together."""
        # A piece belongs to the record that began last; in order of their splits, a split
        # ending a record before it begins another.
        order = W.partitionBy("path").orderBy("start", "edge")
        begun = F.last(F.when(F.col("edge") == BEGINS, F.col("start")), ignorenulls=True).over(order)
        whole = self.cut_pieces().withColumn("begun", begun).groupBy("path", "begun")
        whole = whole.agg(F.sort_array(F.collect_list(F.struct("start", "record"))).alias("pieces"))
        return whole.select("path", F.array_join(F.col("pieces.record"), "\n").alias("record"))

    def pieces(self, cells: int = 0) -> DataFrame:
        """(path, start, edge, record): records that lie in one split, with edge 0.

        With ``cells`` a record that has as many, all written as the format has them, comes
        as a struct ``cells`` of texts instead, its ``record`` being NULL."""
        # The tasks import nothing of this library: a worker may not find it.
        splits = {number: tuple(split) for number, split in self.splits.items()}
        taken_apart = _cells_of(cells) if cells > 1 else None
        odd_quotes = _odd_quotes()
        kinds = pa.struct([(f"c{i}", pa.string()) for i in range(cells)])

        def joined(lines, first):
            """Records of lines, beginning at the places ``first``, whose last one is an end."""
            if len(first) - 1 == first[-1] - first[0]:
                return lines.slice(first[0], first[-1] - first[0])
            return pc.binary_join(pa.ListArray.from_arrays(pa.array(first, pa.int32()), lines), "\n")

        def batch_of(path, start, found):
            """Records of a split as output, taken apart where that is plain."""
            parts = [(found, None)]
            if taken_apart:
                plain, columns = taken_apart(found)
                parts = [(found.filter(pc.invert(plain)), None), (pa.nulls(pc.sum(plain).as_py() or 0, pa.string()), columns)]
            for record, columns in parts:
                n = len(record)
                if n:
                    out = [pa.repeat(pa.scalar(path), n), pa.repeat(pa.scalar(start, pa.int64()), n), pa.repeat(pa.scalar(0, pa.int32()), n), record]
                    names = ["path", "start", "edge", "record"]
                    if cells:
                        out.append(pa.StructArray.from_arrays(columns, fields=list(kinds)) if columns else pa.nulls(n, kinds))
                        names.append("cells")
                    yield pa.RecordBatch.from_arrays(out, names=names)

        def run(batches):
            number, held = None, []
            for batch in batches:
                numbers = batch.column("split").to_numpy()
                change = np.flatnonzero(np.diff(numbers) != 0) + 1
                for a, b in zip([0, *change.tolist()], [*change.tolist(), len(numbers)], strict=True):
                    if a == b:
                        continue
                    if numbers[a] != number:  # what is held at a split's end goes on in the next one
                        number = int(numbers[a])
                        if number not in splits:
                            raise RuntimeError(RESPLIT)
                        path, start, inside, returns = splits[number]
                        held, cut, header, quotes = [], inside, start == 0, int(inside)
                    value = batch.column("value").slice(a, b - a)
                    odd = odd_quotes(value)
                    if returns:
                        value = pc.replace_substring_regex(value, r"\r\z", "")
                    # A record ends with every line after which no quotes are open.
                    after = (quotes + np.cumsum(odd)) % 2
                    quotes = int(after[-1])
                    ends = np.flatnonzero(after == 0)
                    first = np.concatenate(([0], ends + 1))
                    at = 0
                    while at < len(ends) and (held or cut or header):
                        lines = [*held, value.slice(first[at], ends[at] + 1 - first[at])]
                        if header:  # a file's first record that is not blank
                            header = not any(line.strip() for some in lines for line in some.to_pylist())
                        elif not cut:
                            yield from batch_of(path, start, joined(pa.chunked_array(lines).combine_chunks(), [0, sum(map(len, lines))]))
                        held, cut, at = [], False, at + 1
                    if first[-1] < len(value):
                        held.append(value.slice(first[-1]))
                    if at < len(ends):
                        yield from batch_of(path, start, joined(value, first[at:]))

        kind = "path string, start bigint, edge int, record string"
        if cells:
            kind += f", cells struct<{', '.join(f'c{i}: string' for i in range(cells))}>"
        return self.lines.select("split", "value").mapInArrow(run, kind)


def _odd_quotes():
    """A function from texts to 1 where one holds an odd number of quotes, else 0."""

    def odd_quotes(value: pa.Array) -> np.ndarray:
        _, offsets, text = value.buffers()
        ends = np.frombuffer(offsets, np.int32)[value.offset : value.offset + len(value) + 1]
        if text is None:  # all are empty
            return np.zeros(len(value), np.int64)
        places = np.flatnonzero(np.frombuffer(text, np.uint8)[ends[0] : ends[-1]] == ord('"'))
        return np.diff(np.searchsorted(places, ends - ends[0])) % 2

    return odd_quotes


def _cells_of(n: int):
    """A function from records to which of them are plainly written, and the texts of
    those by column. Plain are ``n`` cells, each bare or in quotes from end to end."""
    # No carriage return, which a reader may take as a line's end, and no zero byte, its mark
    # of a comment.
    cell = r'(?:"(?:[^"\r\x00]|"")*"|[^",\r\n\x00]*)'
    plain_record = rf"\A(?:{cell},){{{n - 1}}}{cell}\z"
    names = [f"c{i}" for i in range(n)]

    def taken_apart(found: pa.Array) -> tuple[pa.Array, list[pa.Array]]:
        none = pa.repeat(pa.scalar(False), len(found)), []
        if n > 1000:  # more than an expression can repeat
            return none
        try:
            found.validate(full=True)
        except pa.ArrowInvalid:  # not UTF-8
            return none
        plain = pc.match_substring_regex(found.cast(pa.binary()), plain_record)
        kept = found.filter(plain)
        if not len(kept):
            return none
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept), "\n")[0].as_buffer()
        table = pa.csv.read_csv(
            pa.BufferReader(text),
            pa.csv.ReadOptions(use_threads=False, block_size=max(1, text.size + 1), column_names=names),
            pa.csv.ParseOptions(newlines_in_values=True, ignore_empty_lines=False),
            pa.csv.ConvertOptions(check_utf8=False, column_types=dict.fromkeys(names, pa.string()), null_values=[""], strings_can_be_null=True),
        )
        if len(table) != len(kept):
            return none
        return plain, [column.combine_chunks() for column in table.columns]

    return taken_apart


def read_text_csv(
    spark: SparkSession, paths, with_file: bool = False, modified_after: str | None = None
) -> DataFrame:
    """CSV files with a header line, every value text.

    Short rows end in NULLs, extra cells are dropped, doubled quotes are one
    quote. A column a file lacks is NULL. ``modified_after`` (an ISO timestamp)
    leaves out files that have not changed since.
    """
    options = {"modifiedAfter": modified_after} if modified_after else {}
    parts = []
    ways = _ways(spark, paths, **options)
    for (names, way), files in ways.items():
        schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
        rules = {"escape": '"', "mode": "PERMISSIVE", "multiLine": str(way != PLAIN).lower()}
        if way == CUT:
            # What a task has not taken apart goes through Spark's own parser.
            scan, ddl = _Scan(spark, files, ways.surveyed), ", ".join(f"c{i} string" for i in range(len(names)))
            part = scan.pieces(len(names)).select("path", "record", "cells")
            part = part.unionByName(scan.cut_records().withColumn("cells", F.lit(None).cast(f"struct<{ddl}>")))
            part = part.where(F.col("record").isNull() | (F.trim("record") != ""))
            part = part.select(F.from_csv("record", ddl, {**rules, "lineSep": "\n"}).alias("_row"), "cells", F.col("path").alias(FILE))
            columns = [F.coalesce("cells", "_row")[f"c{i}"].alias(name) for i, name in enumerate(names)]
            file = F.col(FILE)
        else:
            part = spark.read.schema(schema).options(header=True, **rules).csv(files)
            columns = [F.col(f"`{name}`") for name in names]
            file = F.col("_metadata.file_path").alias(FILE)
        parts.append(part.select(*columns, *([file] if with_file else [])))
    if not parts:
        raise FileNotFoundError(f"no CSV rows in {paths}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def csv_folder(spark: SparkSession, folder: str) -> str:
    """Glob of the CSV files in a folder, those compressed by gzip included; an error if
    there are none."""
    plain = f"{folder.rstrip('/')}/*.csv"
    found = []
    for pattern in (plain, f"{plain}.gz"):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path):
            found.append(pattern)
    if not found:
        raise FileNotFoundError(f"no CSV files found: {plain}")
    return found[0] if len(found) == 1 else f"{folder.rstrip('/')}/*.{{csv,csv.gz}}"


def table_name(path: str) -> str:
    """Name of a file without folder and extension."""
    return os.path.splitext(os.path.basename(path.rstrip("/")))[0]


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", compression: str = "none") -> None:
    """Header line first. Every value is quoted and keeps the blanks at its ends; see
    :func:`write_typed_csv` for bare numbers. A file compressed by ``gzip`` is read by one
    task."""
    writer = df.write.mode(mode).option("header", True).option("quoteAll", True).option("escape", '"').option("compression", compression)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def csv_lines(df: DataFrame) -> DataFrame:
    """(value): rows as lines of CSV, numbers bare, all else quoted, NULL as empty quotes.
    The first line of every partition follows the header, in the same value."""
    def cell(field: T.StructField):
        text = F.col(f"`{field.name}`").cast("string")
        if isinstance(field.dataType, T.NumericType):
            return F.coalesce(text, F.lit('""'))
        return F.concat(F.lit('"'), F.coalesce(F.replace(text, F.lit('"'), F.lit('""')), F.lit("")), F.lit('"'))

    header = ",".join('"' + name.replace('"', '""') + '"' for name in df.columns)
    line = F.concat_ws(",", *map(cell, df.schema.fields))
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    return df.select(F.when(first, F.concat(F.lit(header + "\r\n"), line)).otherwise(line).alias("value"))


def write_typed_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV files whose numbers are bare and whose texts are quoted, each with a header
    line; lines end in a carriage return and a line feed. An empty result is a header."""
    lines = csv_lines(df)
    if df.isEmpty():
        header = ",".join('"' + name.replace('"', '""') + '"' for name in df.columns)
        lines = df.sparkSession.createDataFrame([(header,)], "value string").coalesce(1)
    lines.write.mode(mode).option("lineSep", "\r\n").text(path)
