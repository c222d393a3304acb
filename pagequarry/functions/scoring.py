"""Relevance formulas as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagequarry.functions.fixed import BLEND_ALPHA, BLEND_RANK_SCALE, BM25_B, BM25_K1

# (bm25, max_bm25, rank) -> score of one term in one document
Scorer = Callable[[Column, Column, Column], Column]

# Scores are compared after rounding, so that sums that differ only in the
# order of addition tie, and ties are then broken by id.
SCORE_DIGITS = 9


def idf(n_docs: Column, df: Column) -> Column:
    return F.log(n_docs / (df + 1)) + 1


def bm25(idf_: Column, tf: Column, length: Column, avg_length: Column) -> Column:
    """M1."""
    norm = BM25_K1 * ((1 - BM25_B) + BM25_B * length / avg_length)
    return idf_ * (tf * (BM25_K1 + 1)) / (tf + norm)


def bm25_only(bm25_: Column, max_bm25: Column, rank: Column) -> Column:
    """Plain relevance."""
    return bm25_


def blend(alpha: float = BLEND_ALPHA, rank_scale: float = BLEND_RANK_SCALE) -> Scorer:
    """M2: share of the best possible relevance, plus scaled rank."""

    def score(bm25_: Column, max_bm25: Column, rank: Column) -> Column:
        return alpha * (bm25_ / max_bm25) + (1 - alpha) * (rank / rank_scale)

    return score


def page_count(n: Column, per_page: int) -> Column:
    """L4: pages needed for n results."""
    return F.ceil(n / F.lit(float(per_page))).cast("int")
