"""Documents too large for one row: read as a stream, and parsed a few balls at a time.

A file is scanned once, by one task, which holds no more than a batch of it. The balls of every
over are cut out, some at a time; what remains of the document, its frame, has in their place one ball
that carries the number of the cut. Cuts and frame are parsed by the same rules as whole documents: a document
can be read if its frame and all its cuts can. The scan only has to know strings, brackets and commas, so it does not
matter how a document is indented or in which order its fields come. A document whose bulk is not in its
balls, or which is no object, remains whole in its frame; one with texts in single quotes, which Spark reads too, has none and is
to be read whole.

To layers such a document comes in parts: rows with the columns of a document, ``part`` and ``at``. One part, the ``head``, has
the document's ``info``; the ``balls`` have it too, and one ball each, or an over or innings without any, with
its place ``at`` innings, over and ball, counted from 0. Whole documents have null there.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType

from creaseline.sources import schemas
from creaseline.sources.documents import CORRUPT, lenient_json, literal_paths, parsed_texts
from creaseline.sources.lineage import with_source_path
from creaseline.sources.workspace import settled

HEAD, BALLS = "head", "balls"
PLACE = schemas.fields(**schemas.columns(schemas.INT, "innings", "over", "ball"))
CUT_BALLS, CUT_BYTES = 1000, 1 << 19
TEXT_PIECE = 1 << 20  # characters

# Rows end where an object begins: they are short, and no readable document ends there.
ROW_END = "{"
NESTING = (b"{", b"[", b"{", b"[", b"{", b"[")  # document, innings, side, overs, over, deliveries
KEYS = {1: "innings", 3: "overs", 5: "deliveries"}
KEY_BEFORE = re.compile(rb'[{,\s]("(?:[^"\\]|\\.)*")\s*:\s*\Z')
ESCAPED = re.compile(rb"\\.", re.DOTALL)
TOLD = bytes(int(c in b"\"'{}[],") for c in range(256))
STEP = np.zeros(256, np.int64)
STEP[list(b"{[")], STEP[list(b"}]")] = 1, -1
QUOTE, SINGLE, COMMA = ord('"'), ord("'"), ord(",")
CUT_SCHEMA = pa.schema([("src_file_path", pa.string()), ("cut", pa.int32()), ("at", pa.int32()), ("body", pa.binary())])


class Scanner:
    """One document's bytes, in order, to cuts of balls and a frame."""

    def __init__(self) -> None:
        self.frame: list[bytes] = []
        self.pending: list[bytes] = []  # of the cut that is being read
        self.tail: list[bytes] = []  # of the frame, from the last bracket on
        self.held = b""  # a backslash whose other half is to come
        self.matching: list[bool] = []  # per open bracket: do it and all around it lead to balls?
        self.depth = self.in_string = 0
        self.cut = self.balls = self.first = 0
        self.cutting = self.done = self.odd = False

    def feed(self, data: bytes) -> Iterator[tuple[int, int, bytes]]:
        """cut, number of its first ball, text: the balls that are whole by now."""
        if self.done or self.odd:
            return
        data, self.held = self.held + data, b""
        if (len(data) - len(data.rstrip(b"\\"))) % 2:
            data, self.held = data[:-1], data[-1:]
        start = 0
        for place, sign, depth in self._turns(data):
            if sign == SINGLE:
                self.odd = True
                return
            if sign == COMMA:
                if self.cutting:
                    self.balls += 1
                    if self.balls - self.first >= CUT_BALLS or place - start + sum(map(len, self.pending)) >= CUT_BYTES:
                        yield self._taken(data[start:place])
                        start, self.first = place + 1, self.balls
                continue
            if depth > len(self.matching):
                self.frame.append(data[start : place + 1])
                self.cutting = self._leads(data[place : place + 1], b"".join((*self.tail, data[start:place]))) and depth == len(NESTING)
                if self.cutting:
                    self.cut, self.balls, self.first = self.cut + 1, 0, 0
                start = place + 1
            else:
                if self.cutting:
                    text = b"".join((*self.pending, data[start:place]))
                    if self.balls or text.strip():
                        yield self._taken(data[start:place])
                        text = b'{"batter":"%d"}' % self.cut
                    self.frame.append(text)
                    self.pending, start, self.cutting = [], place, False
                self.frame.append(data[start : place + 1])
                start = place + 1
                if self.matching:
                    self.matching.pop()
                if depth <= 0:
                    self.done = True
                    return
            self.tail = [data[place : place + 1]]
        if self.cutting:
            self.pending.append(data[start:])
        else:
            self.frame.append(data[start:])
            self.tail.append(data[start:])

    def end(self) -> bytes | None:
        """The frame; None if the document is to be read whole."""
        return None if self.odd else b"".join((*self.frame, self.held))

    def _taken(self, text: bytes) -> tuple[int, int, bytes]:
        text = b"".join((*self.pending, text))
        self.pending = []
        return self.cut, self.first, text if text.strip() else COMMA.to_bytes()  # nothing between commas is an error

    def _leads(self, bracket: bytes, before: bytes) -> bool:
        level = len(self.matching)
        leads = bracket == NESTING[level] and all(self.matching[-1:]) and (level not in KEYS or key_before(before) == KEYS[level])
        self.matching.append(leads)
        return leads

    def _turns(self, data: bytes) -> Iterator[tuple[int, int, int]]:
        """place, sign, depth after it: brackets down to the balls' list, and the commas in lists of that depth."""
        plain = ESCAPED.sub(b"xx", data) if b"\\" in data else data
        places = np.flatnonzero(np.frombuffer(plain.translate(TOLD), np.bool_))
        signs = np.frombuffer(plain, np.uint8)[places]
        quotes = signs == QUOTE
        inside = (np.cumsum(quotes) + self.in_string) & 1
        outside = ~quotes & (inside == 0)
        self.in_string = int(inside[-1]) if len(inside) else self.in_string
        places, signs = places[outside], signs[outside]
        steps = STEP[signs]
        depths = self.depth + np.cumsum(steps)
        self.depth = int(depths[-1]) if len(depths) else self.depth
        deepest = len(NESTING)
        told = np.where(signs == COMMA, depths == deepest, (signs == SINGLE) | (depths < deepest + (steps > 0)))
        return zip(places[told].tolist(), signs[told].tolist(), depths[told].tolist())


def key_before(text: bytes) -> str | None:
    """The key that a text ends with."""
    found = KEY_BEFORE.search(text)
    try:
        return json.loads(found[1]) if found else None
    except ValueError:
        return None


def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of files, one file after the other, to their cuts and, with null ``cut``, frames."""
    name, scanner = None, None
    for batch in batches:
        out, paths, values = [], batch.column("src_file_path"), batch.column("value")
        for path, first, count in runs(paths):
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, count], pa.int32()), values.slice(first, count)), pa.scalar(ROW_END.encode(), pa.binary()))
            data = joined[0].as_py()
            if scanner is not None and path == name:
                data = ROW_END.encode() + data
            else:
                if scanner is not None:
                    out.append((name, None, None, scanner.end()))
                name, scanner = path, Scanner()
            out += [(name, *cut) for cut in scanner.feed(data)]
        if out:
            yield cut_batch(out)
    if scanner is not None:
        yield cut_batch([(name, None, None, scanner.end())])


def cut_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), CUT_SCHEMA)], schema=CUT_SCHEMA)


def runs(values: pa.Array) -> Iterator[tuple[str, int, int]]:
    """Value, first place and length of every run of equal values."""
    runs = pc.run_end_encode(values)
    ends = runs.run_ends.to_pylist()
    return zip(runs.values.to_pylist(), [0, *ends[:-1]], [end - start for start, end in zip([0, *ends[:-1]], ends)])


@contextmanager
def unsplit_files(spark: SparkSession, largest: int) -> Iterator[None]:
    """Files of up to so many bytes are read by one task each meanwhile."""
    wanted = {"spark.sql.files.maxPartitionBytes": f"{largest}b", "spark.sql.files.minPartitionNum": "1"}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def file_rows(spark: SparkSession, paths: Sequence[str], row_end: str) -> DataFrame:
    """value, block, src_file_path: the files as rows that end as given, and where the stretch of the file begins they were read from."""
    rows = with_source_path(spark.read.option("lineSep", row_end).text(literal_paths(paths)))
    return rows.select("value", F.col("_metadata.file_block_start").alias("block"), "src_file_path")


def staged_pieces(spark: SparkSession, paths: Sequence[str], largest: int) -> DataFrame:
    """src_file_path, cut, bad, ball_at, ball; in one row per document, without a cut, its frame if it has one. ``largest`` is the most bytes of a file."""
    text = F.when(F.col("block") == 0, F.col("value")).otherwise(F.raise_error(F.lit("a file was read in stretches")).cast("string"))
    rows = file_rows(spark, paths, ROW_END).select("src_file_path", text.cast("binary").alias("value"))
    cuts = rows.mapInArrow(cut_batches, "src_file_path string, cut int, at int, body binary")
    body, cut = F.col("body").cast("string"), F.col("cut")
    balls = lenient_json(F.concat(F.lit('{"balls":['), body, F.lit("]}")), schemas.fields(balls=ArrayType(schemas.BALL)))
    parsed = cuts.select("src_file_path", "cut", "at", F.when(cut.isNotNull(), balls).alias("parsed"), F.when(cut.isNull(), body).alias("frame"))
    bad = F.col(f"parsed.{CORRUPT}").isNotNull().alias("bad")
    single = parsed.select("src_file_path", "cut", "frame", bad, "at", F.posexplode_outer("parsed.balls").alias("next", "ball"))
    with unsplit_files(spark, largest):
        return settled(single.select("src_file_path", "cut", "frame", "bad", (F.col("at") + F.col("next")).alias("ball_at"), "ball"), "pieces")


def framed_documents(staged: DataFrame) -> DataFrame:
    """One row per document: its path, info and innings with a mark for the balls of each over, and whether it is ``bad``."""
    frames = staged.where("cut IS NULL AND frame IS NOT NULL").select(F.col("frame").alias("value"), "src_file_path")
    broken = staged.where("bad").select("src_file_path").distinct().withColumn("broken", F.lit(True))
    bad = F.col(CORRUPT).isNotNull() | F.col("broken").isNotNull()
    return settled(parsed_texts(frames).join(broken, "src_file_path", "left").select("src_file_path", "info", "innings", bad.alias("bad")), "frames")


def without_frame(staged: DataFrame) -> list[str]:
    """The paths of the documents that are to be read whole."""
    return [row.src_file_path for row in staged.where("cut IS NULL AND frame IS NULL").select("src_file_path").toLocalIterator()]


def whole_parts(documents: DataFrame) -> DataFrame:
    """Whole documents beside documents in parts."""
    return documents.select("info", "innings", "src_file_path", F.lit(None).cast("string").alias("part"), F.lit(None).cast(PLACE).alias("at"))


def document_parts(framed: DataFrame, staged: DataFrame) -> DataFrame:
    """The readable documents in parts: info, innings, src_file_path, part, at."""
    innings = schemas.MATCH_DOCUMENT["innings"].dataType
    sides = framed.where("NOT bad").select("src_file_path", "info", F.posexplode_outer("innings").alias("innings_at", "side"))
    overs = sides.select("*", F.posexplode_outer("side.overs").alias("over_at", "six"))
    overs = overs.withColumn("cut", F.get("six.deliveries", 0)["batter"].cast("int"))
    overs = settled(overs.withColumns({"side": F.col("side").dropFields("overs"), "six": F.col("six").dropFields("deliveries")}), "overs")

    def part(kind: str, nested: Column, ball_at: Column) -> list[Column]:
        at = F.struct(F.col("innings_at").alias("innings"), F.col("over_at").alias("over"), ball_at.alias("ball")).cast(PLACE)
        return ["info", nested.cast(innings).alias("innings"), "src_file_path", F.lit(kind).alias("part"), at.alias("at")]

    def nested(balls: Column) -> Column:
        six = F.when(F.col("six").isNotNull(), F.struct("six.over", balls.alias("deliveries")))
        side = F.struct("side.team", F.when(F.col("over_at").isNotNull(), F.array(six)).alias("overs"))
        return F.when(F.col("innings_at").isNotNull(), F.array(F.when(F.col("side").isNotNull(), side)))

    some = staged.where("cut IS NOT NULL AND NOT bad").select("src_file_path", "cut", "ball_at", "ball")
    some = some.join(overs.where("cut IS NOT NULL"), ["src_file_path", "cut"]).select(*part(BALLS, nested(F.array("ball")), F.col("ball_at")))
    none = overs.where("cut IS NULL").select(*part(BALLS, nested(F.lit(None).cast(ArrayType(schemas.BALL))), F.lit(None).cast("int")))
    heads = framed.where("NOT bad").select("info", F.lit(None).cast(innings).alias("innings"), "src_file_path", F.lit(HEAD).alias("part"), F.lit(None).cast(PLACE).alias("at"))
    return some.union(none).union(heads)


def text_pieces(rows: DataFrame, key: str, order: Sequence[str], text: str, size: int = TEXT_PIECE) -> DataFrame:
    """The texts of a key's rows, one after the other, cut anew into pieces of so many characters: key, ``piece`` from 0, ``text``."""
    length = F.length(text)
    start = F.sum(length).over(Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - length
    placed = rows.select(key, F.col(text).alias("text"), start.alias("start"))
    end = F.col("start") + F.greatest(F.length("text"), F.lit(1)) - 1
    number = lambda at: F.floor(at / size).cast("int")
    dealt = placed.select("*", F.explode(F.sequence(number(F.col("start")), number(end))).alias("piece"))
    first = F.col("piece").cast("bigint") * size
    held = F.substring("text", (F.greatest(first - F.col("start"), F.lit(0)) + 1).cast("int"), (first + size - F.greatest(first, F.col("start"))).cast("int"))
    return dealt.groupBy(key, "piece").agg(joined_in_order("start", held).alias("text"))


def joined_in_order(number: str, text: Column) -> Column:
    """The texts of a group, one after the other."""
    ordered = F.sort_array(F.collect_list(F.struct(F.col(number), text.alias("text"))))
    return F.array_join(F.transform(ordered, lambda x: x["text"]), "")


def file_texts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """src_file_path, piece, text: files as they are, in pieces."""
    bytes_but_end = F.sum(F.octet_length("value")) + F.count(F.lit(1)) - 1  # all but the end of a file that ends like a row
    counted = lambda end, name: file_rows(spark, paths, end).groupBy("src_file_path").agg(bytes_but_end.alias(name))
    ends = counted(ROW_END, "rows").join(counted("\n", "lines"), "src_file_path").select("src_file_path", (F.col("rows") < F.col("lines")).alias("ends"))
    rows = file_rows(spark, paths, ROW_END).withColumn("n", F.monotonically_increasing_id())
    last = F.lead("n").over(Window.partitionBy("src_file_path").orderBy("block", "n")).isNull()
    rows = rows.withColumn("last", last).join(ends, "src_file_path")
    end = F.when(F.col("last") & ~F.col("ends"), "").otherwise(ROW_END)
    return text_pieces(rows.select("src_file_path", "block", "n", F.concat("value", end).alias("value")), "src_file_path", ("block", "n"), "value")
