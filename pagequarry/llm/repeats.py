"""Substring dedup: runs of words that an earlier document has too, by suffix trees.

Every word of a text starts a suffix. Suffixes are split by prefixes of variable
length: by their first word, and where too many share it, by their first two, and
so on, until a group fits into a task's memory. Each group is one subtree. A node
at the depth of ``WINDOW`` words is a window; it repeats if suffixes of several
documents lie below it. Deeper nodes lie below exactly one such node, so maximal
repeats are the maximal runs of repeated windows. Trees hold the 64-bit hash of a
suffix's path to that depth.

Documents are dealt out in blocks, by ranges of ids. A block sends each group its
distinct windows, in an order both sides know, and gets back one bit for each: is
the window in an earlier block? Repeats inside a block are found there. So neither
positions nor texts go to the trees, and a window that very many documents share
counts once for each block.

Texts are shuffled twice, from the input. Equal ids are one document, nulls come
after all numbers and count as one id. Null and empty texts have no words. Extra
columns are kept; result columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pagequarry.llm.ranges import id_bounds, release, text_size
from pagequarry.llm.words import column_words, release_memory, slices, text_bytes, window_hashes
from pagequarry.session import Workspace

WINDOW = 13
BLOCK_BYTES = 8 << 20  # of text in a block
GROUP_SUFFIXES = 2_000_000  # in a subtree
SLOTS = 1 << 14
_LAST = np.iinfo(np.int64).max


def _prefix_slots(words: np.ndarray, length: int, slots: int) -> np.ndarray:
    """A slot for the first ``length`` words of each suffix that has a whole window."""
    n = max(len(words) - WINDOW + 1, 0)
    return (window_hashes(words, length)[:n] % np.uint64(slots)).astype(np.int64)


class Plan:
    """Which group a suffix belongs to: ``levels[p - 1]`` gives, for each slot of its
    first p words, the group, or -1 if one more word is looked at."""

    def __init__(self, levels: list[np.ndarray], groups: int):
        self.levels, self.groups = levels, groups

    def group(self, words: np.ndarray) -> np.ndarray:
        n = max(len(words) - WINDOW + 1, 0)
        group = np.full(n, -1, np.int64)
        for p, table in enumerate(self.levels, 1):
            open_ = group < 0
            if not open_.any():
                break
            group[open_] = table[_prefix_slots(words, p, len(table))[open_]]
        return group


def plan_groups(docs: DataFrame, group_suffixes: int = GROUP_SUFFIXES, slots: int = SLOTS) -> Plan:
    """Count prefixes, one more word at each pass, until every group is small enough.

    Slots of few suffixes share a group. At most ``slots`` counts for each length
    reach the driver; prefixes of a whole window are not split, because a group
    has a window once for each block.
    """
    levels: list[np.ndarray] = []
    groups = 0
    for length in range(1, WINDOW + 1):
        plan = Plan(levels, groups)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(slots, np.int64)
            for batch in batches:
                for part in slices(batch, "text"):
                    found = column_words(part.column(0))
                    words = found.hashes()
                    at = _prefix_slots(words, length, slots)
                    inside = found.doc[: len(at)] == found.doc[WINDOW - 1 :] if len(at) else np.zeros(0, bool)
                    sums += np.bincount(at[inside & (plan.group(words) < 0)], minlength=slots)
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[at])], names=["slot", "n"])

        rows = docs.select("text").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
        table = np.zeros(slots, np.int64)
        size = 0
        for slot, n in zip(rows["slot"], rows["n"]):
            if n > group_suffixes and length < WINDOW:
                table[slot] = -1
                continue
            if size and size + n > group_suffixes:
                groups, size = groups + 1, 0
            table[slot], size = groups, size + n
        groups += 1
        levels.append(table)
        if not (table < 0).any():
            break
    return Plan(levels, groups)


class _Block:
    """The windows of the documents of one block: distinct ones by group, then hash."""

    def __init__(self, ids: np.ndarray, texts: pa.Array, plan: Plan):
        words, firsts, at = [], [0], 0
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        self.starts, self.ends = [], []
        for part in slices(batch, "text"):
            found = column_words(part.column(0))
            words.append(found.hashes())
            firsts += (found.first[1:] + at).tolist()
            at += int(found.first[-1])
            shift = found.offsets[np.repeat(np.arange(part.num_rows), found.counts)]
            self.starts.append(found.starts - shift)
            self.ends.append(found.ends - shift)
        self.first = np.array(firsts)
        words = np.concatenate(words) if words else np.zeros(0, np.uint64)
        self.starts = np.concatenate(self.starts) if self.starts else np.zeros(0, np.int64)
        self.ends = np.concatenate(self.ends) if self.ends else np.zeros(0, np.int64)
        counts = np.diff(self.first)
        doc = np.repeat(np.arange(len(counts)), counts)
        n = max(len(words) - WINDOW + 1, 0)
        self.place = np.flatnonzero(doc[:n] == doc[WINDOW - 1 :]) if n else np.zeros(0, np.int64)
        owner = ids[doc[self.place]]
        hashes = window_hashes(words, WINDOW)[self.place]
        group = plan.group(words)[self.place]
        order = np.lexsort((owner, hashes, group))
        self.place, owner, hashes, group = self.place[order], owner[order], hashes[order], group[order]
        new = np.ones(len(order), bool)
        if len(order) > 1:
            new[1:] = (hashes[1:] != hashes[:-1]) | (group[1:] != group[:-1])
        self.node = np.cumsum(new) - 1  # of each window
        self.hashes, self.groups = hashes[new], group[new]
        self.later = owner > owner[new][self.node] if len(order) else np.zeros(0, bool)

    def covered(self, earlier: np.ndarray) -> np.ndarray:
        """Which words lie in a window that an earlier document has."""
        hit = self.place[self.later | earlier[self.node]]
        change = np.zeros(int(self.first[-1]) + 1, np.int64)
        np.add.at(change, hit, 1)
        np.add.at(change, hit + WINDOW, -1)
        return np.cumsum(change)[:-1] > 0


def _blocks(docs: DataFrame, bounds: np.ndarray) -> DataFrame:
    """docs with ``_block``, the number of the range its id is in."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("_id")).to_numpy(zero_copy_only=False)
            block = np.searchsorted(bounds, ids, "right") - 1
            yield batch.append_column("_block", pa.array(block, pa.int32()))

    named = docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(int(_LAST))))
    return named.mapInArrow(deal, T.StructType([*named.schema.fields]).add("_block", "integer"))


def _ids(table: pa.Table) -> np.ndarray:
    return table.column("_id").to_numpy().astype(np.int64)


def _texts(table: pa.Table) -> pa.Array:
    return pa.concat_arrays(table.column("text").chunks)


def remove_repeats(
    docs: DataFrame,
    ws: Workspace,
    block_bytes: int = BLOCK_BYTES,
    group_suffixes: int = GROUP_SUFFIXES,
) -> DataFrame:
    """docs(doc_id, text, ...) with kept_text, n_words, n_removed and repeats.

    ``kept_text`` has the kept words joined by a space; ``repeats`` are the removed
    maximal runs of words, as (start, end) in words, end exclusive.
    """
    spark = docs.sparkSession
    new = ("kept_text", "n_words", "n_removed", "repeats", "_id", "_block")
    docs = docs.select(*[c for c in docs.columns if c not in new])
    bounds = id_bounds(docs, max(1, -(-text_size(docs) // block_bytes)), int(_LAST))
    plan = plan_groups(docs, group_suffixes)

    def windows(key: tuple, table: pa.Table) -> pa.Table:
        block = _Block(_ids(table), _texts(table), plan)
        first = np.flatnonzero(np.r_[True, block.groups[1:] != block.groups[:-1]]) if len(block.groups) else []
        pieces = np.split(block.hashes, first[1:]) if len(first) else []
        release_memory()
        return pa.table(
            {
                "group": pa.array(block.groups[first] if len(first) else [], pa.int32()),
                "block": pa.array([key[0].as_py()] * len(first), pa.int32()),
                "hashes": pa.array([p.tobytes() for p in pieces], pa.binary()),
            }
        )

    def subtree(table: pa.Table) -> pa.Table:
        blocks = table.column("block").to_numpy()
        order = np.argsort(blocks, kind="stable")
        parts = table.column("hashes").to_pylist()
        hashes = [np.frombuffer(parts[k], np.uint64) for k in order]
        leaves = np.concatenate(hashes)
        by = np.argsort(leaves, kind="stable")  # leaves of a node stand in order of block
        again = np.zeros(len(leaves), bool)
        again[by[1:]] = leaves[by][1:] == leaves[by][:-1]
        bits = np.split(again, np.cumsum([len(x) for x in hashes])[:-1])
        del leaves, by, hashes, parts
        release_memory()
        return pa.table(
            {
                "group": table.column("group"),
                "_block": pa.array(blocks[order], pa.int32()),
                "earlier": pa.array([np.packbits(x).tobytes() for x in bits], pa.binary()),
            }
        )

    slim = _blocks(docs.select("doc_id", "text"), bounds).select("_id", "text", "_block")
    sent = slim.groupBy("_block").applyInArrow(windows, "group int, block int, hashes binary")
    found = sent.groupBy("group").applyInArrow(subtree, "group int, _block int, earlier binary")
    found = ws.save(found, "earlier")
    release(spark)

    span = T.StructType().add("start", "integer").add("end", "integer")
    schema = T.StructType([*docs.schema.fields]).add("kept_text", "string").add("n_words", "long")
    schema = schema.add("n_removed", "long").add("repeats", T.ArrayType(span))
    arrow, names = to_arrow_schema(schema), docs.columns

    def cut(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        texts = _texts(table)
        block = _Block(_ids(table), texts, plan)
        bits = dict(zip(answers.column("group").to_pylist(), answers.column("earlier").to_pylist()))
        earlier = np.zeros(len(block.groups), bool)
        groups, first = np.unique(block.groups, return_index=True)
        for group, start, end in zip(groups.tolist(), first, np.r_[first[1:], len(block.groups)]):
            earlier[start:end] = np.unpackbits(np.frombuffer(bits[group], np.uint8), count=end - start)
        gone = block.covered(earlier)
        kept, n_words, n_removed, repeats = [], [], [], []
        data, offsets = text_bytes(texts)
        for d in range(len(texts)):
            a, b = block.first[d], block.first[d + 1]
            own = gone[a:b]
            text = data[offsets[d] : offsets[d + 1]].tobytes()
            words = text.split()
            if own.any():
                words = [w for w, g in zip(words, own.tolist()) if not g]
                edge = np.flatnonzero(np.diff(np.r_[0, own.astype(np.int8), 0]))
                repeats.append([{"start": s, "end": e} for s, e in zip(edge[::2].tolist(), edge[1::2].tolist())])
            else:
                repeats.append([])
            kept.append(b" ".join(words).decode("utf-8", "replace"))
            n_words.append(int(b - a))
            n_removed.append(int(own.sum()))
        release_memory()
        made = table.select(names)
        for name, values in (("kept_text", kept), ("n_words", n_words), ("n_removed", n_removed), ("repeats", repeats)):
            made = made.append_column(name, pa.array(values, arrow.field(name).type))
        return made

    blocks = _blocks(docs, bounds)
    return blocks.groupBy("_block").cogroup(found.groupBy("_block")).applyInArrow(cut, schema)
