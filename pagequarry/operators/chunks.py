"""Overlapping chunks of long texts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.functions.fixed import CHUNK_OVERLAP, CHUNK_SIZE

# Where a text is cut, coarsest first: blank line, line break, space, anywhere.
SEPARATORS = ("\n\n", "\n", " ", "")
# What is taken off both ends of a chunk: all white space of Unicode.
_BLANKS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                            0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def _pieces(text: Column, separator: str) -> Column:
    """The text cut before each separator; pieces joined again are the text."""
    mark = re.escape(separator)
    if len(separator) > 1:
        ahead = f"(?={mark}|\\z)"
        pattern = f"{mark}[\\s\\S]*?{ahead}|[\\s\\S]+?{ahead}"
    else:
        pattern = f"{mark}[^{mark}]*|[^{mark}]+" if separator else "[\\s\\S]"
    pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(F.contains(text, F.lit(separator)), pieces).otherwise(F.array(text))


def _atoms(text: Column, size: int, length: Callable[[Column], Column], level: int = 0) -> Column:
    """Pieces in order as (piece, n, stop): too long ones are cut by the next separator,
    and a stop before and after each keeps them apart from their neighbours."""
    def atom(piece: Column, n: Column, stop: bool) -> Column:
        return F.struct(piece.alias("piece"), n.cast("long").alias("n"), F.lit(stop).alias("stop"))

    stop = F.array(atom(F.lit(""), F.lit(0), True))

    def cut(piece: Column) -> Column:
        last = level + 1 == len(SEPARATORS)
        finer = F.array(atom(piece, length(piece), False)) if last else _atoms(piece, size, length, level + 1)
        return F.when(length(piece) < size, F.array(atom(piece, length(piece), False))).otherwise(
            F.concat(stop, finer, stop)
        )

    return F.flatten(F.transform(_pieces(text, SEPARATORS[level]), cut))


def _packed(atoms: Column, size: int, overlap: int) -> Column:
    """Chunks as (start, first, end): where it starts in the text, and its atoms.

    One fold over the atoms. Its state is the chunk that is being filled: its
    first atom, where that starts, and its size. An atom that does not fit ends
    the chunk; a second fold, over that chunk's atoms alone, then drops leading
    ones until at most ``overlap`` is taken over and the atom fits.
    """
    zero = F.lit(0).cast("long")
    no_chunks = F.array().cast("array<struct<start:bigint,first:bigint,end:bigint>>")

    def window(first: Column, start: Column, total: Column) -> Column:
        return F.struct(first.alias("first"), start.alias("start"), total.alias("total"))

    def ended(state: Column) -> Column:
        chunk = F.struct(state["start"].alias("start"), state["first"].alias("first"), state["at"].alias("end"))
        return F.concat(state["chunks"], F.array(chunk))

    def state(window: Column, old: Column, atom: Column, chunks: Column) -> Column:
        return F.struct(
            window["first"].alias("first"),
            window["start"].alias("start"),
            (window["total"] + atom["n"]).alias("total"),
            (old["at"] + 1).alias("at"),
            (old["pos"] + F.char_length(atom["piece"])).alias("pos"),
            chunks.alias("chunks"),
        )

    def take(old: Column, atom: Column) -> Column:
        def drop(kept: Column, leading: Column) -> Column:
            too_much = (kept["total"] > overlap) | (
                (kept["total"] + atom["n"] > size) & (kept["total"] > 0)
            )
            less = window(
                kept["first"] + 1,
                kept["start"] + F.char_length(leading["piece"]),
                kept["total"] - leading["n"],
            )
            return F.when(too_much, less).otherwise(kept)

        filled = F.slice(atoms, (old["first"] + 1).cast("int"), (old["at"] - old["first"]).cast("int"))
        begun = old["first"] < old["at"]
        return (
            F.when(
                atom["stop"],
                state(
                    window(old["at"], old["pos"], zero), old, atom,
                    F.when(begun, ended(old)).otherwise(old["chunks"]),
                ),
            )
            .when(
                begun & (old["total"] + atom["n"] > size),
                F.aggregate(
                    filled,
                    window(old["first"], old["start"], old["total"]),
                    drop,
                    lambda kept: state(kept, old, atom, ended(old)),
                ),
            )
            .otherwise(state(old, old, atom, old["chunks"]))
        )

    empty = F.struct(
        *[zero.alias(name) for name in ("first", "start", "total", "at", "pos")], no_chunks.alias("chunks")
    )
    return F.aggregate(
        atoms,
        empty,
        take,
        lambda s: F.when(s["first"] < s["at"], ended(s)).otherwise(s["chunks"]),
    )


def split_documents(
    documents: DataFrame,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    length: Callable[[Column], Column] = F.char_length,
) -> DataFrame:
    """``documents(source, content)`` to (source, chunk_no, start_index, page_content).

    A text is cut before each of the coarsest separators it has; pieces of
    ``size`` or more are cut by the next separator. Neighbouring pieces are
    packed up to ``size``; the next chunk takes over trailing pieces of at most
    ``overlap``. Chunks are stripped of white space, and empty ones left out;
    ``start_index`` is where a chunk starts, in characters. Texts that are null
    or empty have no chunks.

    ``length`` (X4) is a column function that measures a piece, in characters
    unless given. Everything is column functions in the rows: no shuffle, no
    Python worker, and work that grows with the length of a text.
    """
    atoms = documents.select("source", _atoms(F.col("content"), size, length).alias("_atoms"))
    packed = atoms.select("source", "_atoms", _packed(F.col("_atoms"), size, overlap).alias("_bounds"))

    def text_of(chunk: Column) -> Column:
        own = F.slice(
            "_atoms", (chunk["first"] + 1).cast("int"), (chunk["end"] - chunk["first"]).cast("int")
        )["piece"]
        return F.struct(chunk["start"].alias("start"), F.array_join(own, "").alias("text"))

    def stripped(chunk: Column) -> Column:
        text = chunk["text"]
        leading = F.char_length(text) - F.char_length(F.ltrim(text, F.lit(_BLANKS)))
        return F.struct(
            (chunk["start"] + leading).cast("int").alias("start_index"),
            F.btrim(text, F.lit(_BLANKS)).alias("page_content"),
        )

    chunks = F.transform(F.transform("_bounds", text_of), stripped)
    kept = packed.select("source", F.filter(chunks, lambda c: c["page_content"] != "").alias("_chunks"))
    # "outer", or Spark works the chunks out a second time, to drop rows without any first
    rows = kept.select("source", F.posexplode_outer("_chunks").alias("chunk_no", "_chunk"))
    return rows.where(F.col("chunk_no").isNotNull()).select(
        "source", "chunk_no", "_chunk.start_index", "_chunk.page_content"
    )


def chunk_counts(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row (n_documents, n_chunks)."""
    n_documents = documents.agg(F.count(F.lit(1)).alias("n")).scalar()
    return chunks.agg(F.count(F.lit(1)).alias("n_chunks")).select(
        n_documents.alias("n_documents"), "n_chunks"
    )
