"""Packing of tokenised documents into sequences by the sum-of-squares rule.

A document becomes the token ids of its text and an end token; only a document longer than a
sequence is cut, into pieces of one whole sequence each and a shorter last one. A piece goes
to the place that makes the sum of N(gap)^2 smallest, N(gap) being the number of open
sequences with that much room left: into an open sequence with room, or a new one. Large
pieces come first, in an order by hash, then the smallest in falling order, which fill what
is left.

Pieces are dealt by a stored row number into groups of some 20,000, each packed by itself
from the lengths alone, so no task depends on a key: equal documents spread like others.
A group leaves less than one sequence more than it needs in practice. Pieces of a whole
sequence take part in no group.

Words are tokenised once per slice of texts: the vocabulary's pattern never joins what white
space parts, nor a letter and a following mark, so a text is the sequence of its words' ids.
Texts with ``<|`` may hold special tokens and are tokenised whole.

Nulls: null text is empty, and an empty text is one piece with the end token alone; a null
id is carried along. Repeated rows are documents of their own. An empty table gives no
rows. The input row is carried as one struct, so its columns never clash with new ones.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from creaseline.llm.words import mixed_bits
from creaseline.sources.workspace import settled

SEQUENCE_TOKENS = 4096
PIECES_PER_GROUP = 20_000
SMALL_SHARE = 0.15  # the share of pieces that come last
SLICE_BYTES = 2_000_000
WORDS_KEPT = 600_000

# A letter and a run of ASCII marks (no apostrophe, and none of a special token's) are never one token;
# only the capital i with a dot ends in a mark of its own in lower case.
LETTER_MARKS = r"([^\PL\x{130}])([!#$%&*+,./:;=?@^_~-]+)"


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Runs of texts of about so many bytes; a longer text is a slice of its own."""
    begin, held = 0, 0
    for k, size in enumerate(pc.binary_length(texts).to_pylist()):
        if held and held + size > most:
            yield texts.slice(begin, k - begin)
            begin, held = k, 0
        held += size
    if len(texts) > begin:
        yield texts.slice(begin)


class Encoder:
    """Token ids of whole texts, words being looked up."""

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.known: dict[str, bytes] = {}

    def plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def lookup(self, words: list[str]) -> list[bytes]:
        if len(self.known) > WORDS_KEPT:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        self.known.update(zip(new, self.plain(new)))
        return [self.known[w] for w in words]

    def encoded(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a slice, without nulls."""
        special = pc.match_substring(texts, "<|")
        usual = pc.if_else(special, "", texts)
        parted = pc.replace_substring_regex(pc.ascii_lower(usual), LETTER_MARKS, r"\1 \2")
        lists = pc.ascii_split_whitespace(parted)
        words = lists.flatten().dictionary_encode()
        ids = self.lookup(words.dictionary.to_pylist())
        sizes = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
        flat, begins = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes
        at = words.indices.to_numpy()
        each = sizes[at]
        ends = np.cumsum(each)
        tokens = flat[np.repeat(begins[at] - ends + each, each) + np.arange(each.sum())]
        marks = np.concatenate([[0], ends])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        out = np.split(tokens, marks[1:-1])
        for k in np.flatnonzero(special.to_numpy(zero_copy_only=False)):
            out[k] = np.frombuffer(self.plain([texts[int(k)].as_py()])[0], "<u4")
        return out


def token_pieces(
    docs: DataFrame, vocabulary: str, end_token: int = 1, limit: int = SEQUENCE_TOKENS, text: str = "text", carried: list[str] | None = None
) -> DataFrame:
    """row (the carried columns, all by default), piece, start, length, ids (little-endian, 32 bits).

    ``vocabulary`` is the tokenizer's file; every executor must be able to read that path.
    """
    names = docs.columns if carried is None else carried
    table = docs.select(F.struct(*names).alias("row"), F.coalesce(text, F.lit("")).alias("text"))
    kinds = (("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()))
    schema = T.StructType([table.schema["row"], *(T.StructField(*k) for k in kinds)])
    arrow = to_arrow_schema(schema)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            done = 0
            for part in slices(batch.column(1)):
                rows, pieces, starts, lengths, ids = [], [], [], [], []
                for k, tokens in enumerate(encoder.encoded(part)):
                    tokens = np.append(tokens, np.array([end_token], "<u4")).astype("<u4")
                    for n, start in enumerate(range(0, len(tokens), limit)):
                        piece = tokens[start : start + limit]
                        rows.append(done + k)
                        pieces.append(n)
                        starts.append(start)
                        lengths.append(len(piece))
                        ids.append(piece.tobytes())
                done += len(part)
                row = batch.column(0).take(pa.array(rows, pa.int64())).cast(arrow.field(0).type)
                columns = [pa.array(c, f.type) for c, f in zip((pieces, starts, lengths, ids), list(arrow)[1:])]
                yield pa.RecordBatch.from_arrays([row, *columns], schema=arrow)

    return table.mapInArrow(cut, schema)


def sum_of_squares(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, in the order given; all lengths are in 1..limit.

    A piece that leaves a gap g for g - length changes the sum by 2 (N(g - length) - N(g)) + 2,
    one that fills it by 1 - 2 N(g), and one in a new sequence by 2 N(limit - length) + 1.
    Ties: the fuller sequence first.
    """
    count = np.zeros(limit + 1, np.int64)
    waiting: list[list[int]] = [[] for _ in range(limit + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    used = 0
    never = np.int64(1) << 40
    for k, size in enumerate(lengths.tolist()):
        best = 2 * count[limit - size] + 1 if size < limit else 0
        gap = limit
        held = count[size + 1 : limit]
        if len(held):
            change = np.where(held > 0, 2 * (count[1 : limit - size] - held) + 2, never)
            first = int(change.argmin())
            if change[first] <= best:
                best, gap = change[first], size + 1 + first
        if count[size] and 1 - 2 * count[size] <= best:
            gap = size
        if gap == limit and not waiting[limit]:
            waiting[limit].append(used)
            used += 1
        else:
            count[gap] -= 1
        sequence[k], offset[k] = waiting[gap].pop(), limit - gap
        if gap > size:
            count[gap - size] += 1
            waiting[gap - size].append(sequence[k])
    return sequence, offset


def packing_order(lengths: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Large pieces by a hash of their number, then the smallest ones in falling order."""
    drawn = np.lexsort((numbers, mixed_bits(numbers.astype(np.uint64))))
    small = lengths <= np.quantile(lengths, SMALL_SHARE)
    last = np.flatnonzero(small)
    return np.concatenate([drawn[~small[drawn]], last[np.lexsort((numbers[last], -lengths[last]))]])


def packed(pieces: DataFrame, limit: int = SEQUENCE_TOKENS, pieces_per_group: int = PIECES_PER_GROUP) -> DataFrame:
    """The pieces, with sequence_id and offset (tokens before it in its sequence).

    Needs a column ``length`` in 1..limit. Sequence numbers are unique, not dense.
    """
    length = F.col("length").cast("int")
    whole = F.struct(*pieces.columns).alias("piece")
    stored = settled(pieces.select(whole, length.alias("length"), F.monotonically_increasing_id().alias("number")), "pieces")
    groups = max(1, -(-stored.where(F.col("length") < limit).count() // pieces_per_group))
    alone = stored.where(F.col("length") == limit).select(
        "piece", (-1 - F.col("number")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    kinds = (T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()))
    schema = T.StructType([stored.schema["piece"], *kinds])
    arrow = to_arrow_schema(schema)

    def pack(group: pa.Table) -> pa.Table:
        lengths, numbers = group.column("length").to_numpy().astype(np.int64), group.column("number").to_numpy()
        order = packing_order(lengths, numbers)
        sequence, offset = sum_of_squares(lengths[order], limit)
        base = int(group.column("group")[0].as_py()) << 32
        columns = [group.column("piece").take(pa.array(order)), pa.array(base + sequence), pa.array(offset)]
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    dealt = stored.where(F.col("length") < limit).withColumn("group", F.pmod(F.xxhash64("number"), F.lit(groups)))
    together = dealt.groupBy("group").applyInArrow(pack, schema).union(alone)
    return together.select("piece.*", "sequence_id", "offset")


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, length, ids: the packed sequences, at most ``limit`` tokens each."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda have, part: F.concat(have, part["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
