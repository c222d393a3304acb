"""Spelling variants: words of a corpus that are one edit apart, grouped under their commonest form.

Words are maximal runs of Latin letters. The permuterm list of a word holds every
rotation of the word with an end mark: ``word$``, ``ord$w``, ... ``$word``. Two words
that differ by one replaced letter have rotations that are equal but for the last
letter, and if a letter is left out of a word, the rotation of what remains is the
word's rotation without its last letter. So in the sorted list of all rotations, the
neighbours of a word stand in prefix ranges: each range is a rotation without its
last letter, the word that has just this rotation, and the rotations one letter
longer. A range has one row for each letter at most, so the scan holds little, and
pairs are never rows: each member of a range is sent its number of neighbours there and the
best of them.

Rotations are dealt by ranges of the sorted list. Where the boundary of two ranges
falls between a rotation and its prefix, the rotation goes to both, in one role each. The
boundaries come from a bounded sample of words; they balance tasks and change no result.

Nulls and empty texts have no words; repeated rows count each; a null id counts as an empty
one. Empty tables give no words. Extra columns are ignored. Rotations of a word take
the square of its length, so they are yielded in slices of bounded size.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.session import Workspace

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
LETTERS = r"[a-z\xC0-\xFF]"  # after lower-casing; texts are Latin-1 here, a letter is a byte
END = b"$"  # sorts before every letter
HELD_WORDS = 200_000  # counted in a task before they are sent on
SAMPLE_WORDS = 4096  # whose rotations set the boundaries of ranges
SLICE_ROWS, SLICE_BYTES = 20_000, 4 << 20
RANGE_WORDS = 25_000
_LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 0x100))


def misspelt(word: bytes, prefix_crc: int, one_in: int) -> bytes:
    """``word`` without one letter, if its crc32 after the prefix is a multiple of ``one_in``."""
    utf8 = word if word.isascii() else word.decode("latin-1").encode()
    h = zlib.crc32(utf8, prefix_crc)
    if h % one_in:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, one_in: int | None = None) -> DataFrame:
    """(word binary, n) of the words of docs(doc_id, text) with ``min_length`` letters or more.

    Words are Latin-1. With ``one_in``, that share of (document, word) is misspelt by a keyed
    hash before it is counted.
    """
    run = re.compile(LETTERS.encode() + b"{%d,}" % min_length, re.DOTALL)

    def sent(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "n"]
        )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch.column("doc_id"), batch.column("text")):
                text = text.as_py()
                if not text:
                    continue
                # what Latin-1 lacks becomes a question mark, which is no letter
                found = run.findall(text.encode("latin-1", "replace").translate(_LOWER))
                if one_in is None:
                    counts.update(found)
                else:
                    name = doc.as_py()
                    crc = zlib.crc32(f"{'' if name is None else name}:".encode())
                    for word, n in Counter(found).items():
                        word = misspelt(word, crc, one_in)
                        if len(word) >= min_length:
                            counts[word] += n
                if len(counts) > HELD_WORDS:
                    yield sent(counts)
                    counts = Counter()
        if counts:
            yield sent(counts)

    found = docs.select("doc_id", "text").mapInArrow(counted, "word binary, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def rotations(word: bytes) -> list[bytes]:
    twice = (word + END) * 2
    size = len(word) + 1
    return [twice[j : j + size] for j in range(size)]


def _boundaries(words: DataFrame, ranges: int) -> list[bytes]:
    """Rotations that cut the sorted list into about equal ranges."""
    if ranges < 2:
        return []
    sample = words.select("word").orderBy(F.xxhash64("word"), "word").limit(SAMPLE_WORDS).collect()
    # a few rotations of each, so that long words are not held whole many times
    found = sorted({bytes(r["word"][j:] + END + r["word"][:j])[:64] for r in sample for j in range(min(len(r["word"]) + 1, 64))})
    return sorted({found[k * len(found) // ranges] for k in range(1, ranges)})


def _dealt(words: DataFrame, boundaries: list[bytes]) -> DataFrame:
    """(part, rotation, n, roles): roles 1 is a range's own word, 2 one with a letter more."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows, many, roles, held = [], [], [], [], 0

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(rows, pa.binary()), pa.array(many, pa.int64()), pa.array(roles, pa.int8())],
                names=["part", "rotation", "n", "roles"],
            )

        for batch in batches:
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                twice, size = (word + END) * 2, len(word) + 1
                for j in range(size):
                    rotation = twice[j : j + size]
                    own = bisect.bisect_right(boundaries, rotation)
                    # the rotation that ends in the mark has no letter to leave out
                    before = bisect.bisect_right(boundaries, rotation[:-1]) if j else own
                    if own == before:
                        part.append(own), rows.append(rotation), many.append(n), roles.append(3 if j else 1)
                    else:
                        part.extend((own, before)), rows.extend((rotation, rotation)), many.extend((n, n)), roles.extend((1, 2))
                    held += size
                    if len(rows) >= SLICE_ROWS or held >= SLICE_BYTES:
                        yield made()
                        part, rows, many, roles, held = [], [], [], [], 0
        if rows:
            yield made()

    return words.select("word", "n").mapInArrow(spread, "part int, rotation binary, n long, roles byte")


class _Range:
    """Rows with one prefix: the word that is the prefix, and those with one letter more."""

    __slots__ = ("prefix", "own", "longer")

    def __init__(self, prefix: bytes):
        self.prefix = prefix
        self.own: tuple[int, bytes] | None = None
        self.longer: list[tuple[int, bytes, bool]] = []  # -n, word, whether it counts as an insertion

    def neighbours(self) -> Iterator[tuple[bytes, int, int, bytes]]:
        """(word, neighbours in this range, n and spelling of the best of them)."""
        inserted = [x for x in self.longer if x[2]] if self.own else []
        if self.own and inserted:
            best = min(inserted)
            yield self.own[1], len(inserted), -best[0], best[1]
        if len(self.longer) > 1 or inserted:
            first = sorted(self.longer)[:2]
            for one in self.longer:
                others = [x for x in first if x[1] != one[1]][:1]
                n = len(self.longer) - 1
                if self.own and one[2]:
                    others.append(self.own)
                    n += 1
                if n:
                    best = min(others, key=lambda x: (x[0], x[1]))
                    yield one[1], n, -best[0], best[1]


def scan(rows: Iterator[tuple[int, bytes, int, int]]) -> Iterator[tuple[bytes, int, int, bytes]]:
    """Neighbours by range, of (part, rotation, n, roles) in order of part and rotation."""
    stack: list[_Range] = []
    last = None
    for part, rotation, n, roles in rows:
        if part != last:
            while stack:
                yield from stack.pop().neighbours()
            last = part
        while stack and not rotation.startswith(stack[-1].prefix):
            yield from stack.pop().neighbours()
        at = rotation.index(END)
        word = rotation[at + 1 :] + rotation[:at]
        if roles & 2:
            prefix = rotation[:-1]
            # two rows of one rotation never meet in a part, so this rotation opens no range yet
            if not stack or stack[-1].prefix != prefix:
                stack.append(_Range(prefix))
            # of equal letters in a row only the first is left out, so that a pair counts once
            first = rotation[-2] != rotation[-1]
            stack[-1].longer.append((-n, word, first))
        if roles & 1:
            stack.append(_Range(rotation))
            stack[-1].own = (-n, word)
    while stack:
        yield from stack.pop().neighbours()


def _scanned(dealt: DataFrame) -> DataFrame:
    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, bytes, int, int]]:
            for batch in batches:
                yield from zip(*(batch.column(k).to_pylist() for k in range(4)))

        def made(held: list) -> pa.RecordBatch:
            word, n_near, best_n, best = zip(*held)
            return pa.RecordBatch.from_arrays(
                [pa.array(word, pa.binary()), pa.array(n_near, pa.int64()), pa.array(best_n, pa.int64()), pa.array(best, pa.binary())],
                names=["word", "n_near", "best_n", "best"],
            )

        held, size = [], 0
        for row in scan(rows()):
            held.append(row)
            size += 2 * len(row[0])
            if len(held) >= SLICE_ROWS or size >= SLICE_BYTES:
                yield made(held)
                held, size = [], 0
        if held:
            yield made(held)

    return dealt.mapInArrow(scanned, "word binary, n_near long, best_n long, best binary")


def neighbours(words: DataFrame, ws: Workspace, rows: int | None = None) -> DataFrame:
    """(word, n_near, best_n, best) of the words(word, n) that have a neighbour."""
    rows = words.count() if rows is None else rows
    ranges = max(1, -(-rows // RANGE_WORDS))
    boundaries = _boundaries(words, ranges)
    dealt = _dealt(words, boundaries).repartition(len(boundaries) + 1, "part")
    found = _scanned(dealt.sortWithinPartitions("part", "rotation"))
    # of the best of each range, the one with the largest n; ties: the smallest spelling
    top = F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("top")
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), top)
    return summed.select("word", "n_near", (-F.col("top.m")).alias("best_n"), F.col("top.best").alias("best"))


def roots(forms: DataFrame, ws: Workspace) -> DataFrame:
    """(word, root) of forms(word, form): forms are followed to the last, doubling the way each time.

    A form is at least twice as frequent as its word, so the ways are short and have no rings.
    """
    chain = ws.save(forms.select("word", F.col("form").alias("root")), "chain_0")
    step = 0
    while True:
        on = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step += 1
        longer = chain.join(on, "root", "left")
        moved = longer.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = ws.save(moved, f"chain_{step}")
        if not moved.where("moved").limit(1).count():
            return moved.select("word", "root")
        chain = moved.select("word", "root")


def spelling_variants(
    docs: DataFrame,
    ws: Workspace,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    one_in: int | None = None,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of docs(doc_id, text).

    A word's form is its neighbour of largest n (ties: the smallest in code-point
    order), if that is at least ``ratio`` (2 or more) times as frequent, else null. A root is
    what following the forms ends at.
    """
    words = ws.save(count_words(docs, min_length, one_in).where(F.col("n") >= min_count), "words")
    near = neighbours(words, ws)
    known = words.join(near, "word", "left")
    has = F.col("best_n") >= ratio * F.col("n")
    known = known.select(
        "word",
        F.when(has, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(has, F.col("best_n")).alias("form_n"),
    )
    known = ws.save(known, "known")
    chain = roots(known.where("form IS NOT NULL"), ws)
    whole = known.join(chain, "word", "left")

    def shown(name: str):
        return F.decode(F.col(name), "ISO-8859-1").alias(name)

    return whole.select(
        shown("word"), shown("form"), F.decode(F.coalesce("root", "word"), "ISO-8859-1").alias("root"), "n", "n_near", "form_n"
    )
