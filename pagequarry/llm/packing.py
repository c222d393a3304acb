"""Best-fit packing of documents into sequences of a fixed number of tokens.

Documents become ids and one end id each; only those longer than a sequence are
cut. Pieces are packed by the sum-of-squares rule: of the open sequences with room,
a piece goes where the squared counts of open sequences per gap, summed over gaps,
become smallest; it opens a new one only if none has room. Pieces come by falling
length, so that small ones are left to close the gaps.

Groups of rows are packed on their own. Pieces of sequences that are not full go
on to the next round, with fewer groups, until one group is left or a round fills
few sequences; what a group holds is bounded, and only row counts reach the driver.
Rounds see lengths only; ids and other columns are joined to their places at the end.

Null and empty texts are a single end id. Repeated rows are packed each. Extra
columns of ``pack``'s input are kept, but for sequence_id and offset.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagequarry.llm.tokens import encode_texts, vocabulary_size
from pagequarry.llm.words import binary_column, gathered, slices, text_bytes
from pagequarry.session import Workspace

CAPACITY = 2048
END = 0
GROUP_ROWS = 100_000
TOKENIZED_BYTES = 4 << 20  # of text at once


def tokenize(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, keep_ids: bool = True
) -> DataFrame:
    """Pieces of docs(doc_id, text): doc_id, piece, start, length, ids_crc32, and ids if kept.

    ``ids`` is binary, little-endian numbers of 16 bits if the vocabulary allows, else of 32;
    :func:`widened` gives those of 32. The first piece of a document is the one that may be shorter.
    """
    narrow = max(vocabulary_size(path), end + 1) <= 1 << 16

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", TOKENIZED_BYTES):
            for part in slices(batch, "text", TOKENIZED_BYTES):
                plain, counts = encode_texts(*text_bytes(part.column("text")), path)
                n = counts + 1
                ids = np.full(int(n.sum()), end, "<u4")
                inside = np.ones(len(ids), bool)
                inside[np.cumsum(n) - 1] = False
                ids[inside] = plain
                many = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), many)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
                head = n - capacity * (many - 1)
                start = np.where(piece == 0, 0, head[doc] + capacity * (piece - 1))
                length = np.where(piece == 0, head[doc], capacity)
                bounds = np.r_[0, np.cumsum(length)]
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
                columns = [
                    part.column("doc_id").take(pa.array(doc)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                if keep_ids:
                    columns.append(binary_column(ids.astype("<u2") if narrow else ids, length))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    schema += ", ids binary" if keep_ids else ""
    names = [x.split()[0] for x in schema.split(", ")]
    return docs.select("doc_id", "text").mapInArrow(pieces, schema)


def widened(packed: DataFrame) -> DataFrame:
    """packed(length, ids, ...) with ids of 32 bits."""
    place = packed.columns.index("ids")

    def wide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            data, offsets = text_bytes(batch.column("ids"))
            narrow = np.diff(offsets) == 2 * length
            if narrow.all():
                ids = binary_column(data.view("<u2").astype("<u4"), length)
                batch = batch.set_column(place, batch.schema.field(place), ids)
            yield batch

    return packed.mapInArrow(wide, packed.schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, offset) of each length, and the fill of each sequence."""
    count = np.zeros(capacity + 1, np.int64)  # open sequences by fill
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    fills: list[int] = []
    sequence = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    for k, size in zip(order.tolist(), lengths[order].tolist()):
        fill = 0
        if size < capacity:
            level = np.flatnonzero(count[1 : capacity - size + 1]) + 1
            if len(level):
                # what the sum of squares gains if a sequence moves up from each level
                change = 2 * (count[level + size] - count[level] + 1)
                if level[-1] + size == capacity:  # it is closed and no longer counts
                    change[-1] = 1 - 2 * count[level[-1]]
                fill = int(level[len(change) - 1 - int(change[::-1].argmin())])  # ties: the fullest
        if fill:
            number = open_at[fill].pop()
            count[fill] -= 1
        else:
            number = len(fills)
            fills.append(0)
        sequence[k], offset[k] = number, fill
        fills[number] = fill + size
        if fill + size < capacity:
            count[fill + size] += 1
            open_at[fill + size].append(number)
    return sequence, offset, np.array(fills, np.int64)


def pack(
    pieces: DataFrame, ws: Workspace, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """pieces(length, ...) with sequence_id and offset; each length is 1 to ``capacity``."""
    rest = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    # a number of each stored row, since equal rows are packed each, under a name that is free
    row = "_row"
    while row in {c.lower() for c in rest}:
        row += "_"
    whole = ws.save(pieces.select(*rest, F.monotonically_increasing_id().alias(row)), "pieces")
    left = whole.select(F.col(row).alias("_row"), "length")
    rows = left.count()
    done: list[DataFrame] = []
    for number in itertools.count():
        groups = max(1, -(-rows // group_rows))
        made = ws.save(_packed(left, groups, number, capacity), f"round_{number}")
        left, before = made.where("NOT _full").select("_row", "length"), rows
        rows = left.count()
        # where most sequences cannot be filled, another round would not fill them either
        if groups == 1 or 2 * rows > before:
            done.append(made)
            break
        done.append(made.where("_full"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return whole.join(out.select(F.col("_row").alias(row), "sequence_id", "offset"), row).select(*rest, "sequence_id", "offset")


def _packed(left: DataFrame, groups: int, number: int, capacity: int) -> DataFrame:
    schema = T.StructType([*left.schema.fields]).add("sequence_id", "long").add("offset", "long").add("_full", "boolean")

    def place(key: tuple, group: pa.Table) -> pa.Table:
        lengths = group.column("length").to_numpy().astype(np.int64)
        sequence, offset, fills = sum_of_squares(lengths, capacity)
        base = (number << 56) + (key[0].as_py() << 24)
        return (
            group.select(["_row", "length"])
            .append_column("sequence_id", pa.array(base + sequence, pa.int64()))
            .append_column("offset", pa.array(offset, pa.int64()))
            .append_column("_full", pa.array(fills[sequence] == capacity))
        )

    # each round deals anew
    group = F.pmod(F.xxhash64("_row", F.lit(number)), F.lit(groups)).cast("int")
    dealt = left.select("_row", "length", group.alias("_group"))
    return dealt.groupBy("_group").applyInArrow(place, schema)
