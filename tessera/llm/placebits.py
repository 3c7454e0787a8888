"""Bit maps of a fixed size over hashed places, built by tasks page by page."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGE_BITS = 18


def _page_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per page (rows come sorted by page)."""
    page, held = None, np.zeros(1 << PAGE_BITS, bool)

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([page], pa.int64()), pa.array([np.packbits(held).tobytes()], pa.binary())], ["page", "bits"])

    for batch in batches:
        place = batch.column("place").to_numpy()
        pages = place >> PAGE_BITS
        cut = [0, *(np.flatnonzero(pages[1:] != pages[:-1]) + 1).tolist(), len(place)]
        for lo, hi in zip(cut, cut[1:], strict=False):
            if lo == hi:
                continue
            if pages[lo] != page:
                if page is not None:
                    yield done()
                page, held = int(pages[lo]), np.zeros(1 << PAGE_BITS, bool)
            held[place[lo:hi] & ((1 << PAGE_BITS) - 1)] = True
    if page is not None:
        yield done()


def place_bits(places: DataFrame, bits: int) -> np.ndarray:
    """The places (column ``place``, below ``2 ** bits``) that occur, as
    ``2 ** bits / 8`` bytes, however many rows there are."""
    pages = (places.select(F.col("place").cast("long").alias("place")).distinct()
             .repartition(F.shiftright("place", PAGE_BITS)).sortWithinPartitions("place").mapInArrow(_page_task, "page long, bits binary"))
    size = (1 << PAGE_BITS) // 8
    out = np.zeros(max((1 << bits) // 8, size), np.uint8)
    for r in pages.toLocalIterator():
        out[r["page"] * size:(r["page"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return out


def has_place(bitmap: np.ndarray, place: np.ndarray) -> np.ndarray:
    place = place.astype(np.int64)
    return (bitmap[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
