"""Bounded-space online best-fit packing of token sequences (op8).

Documents are tokenised, ended with id 0, and only those longer than a
sequence are cut. Pieces are spread over partitions by hash, put there in hash
order (Spark's spilling sort), and packed online: each goes to the open bin
with the least free space that holds it. They come in runs of RUN pieces, each
by falling length, so that every run mixes lengths and the short pieces of one
fill the bins that its long ones opened, however large the partition. The open bins are kept by
free space, with a bitset of the spaces that occur, so a placement costs a
shift and the lowest set bit. At most ``open_bins`` are open; when another is
needed the fullest is closed. Only placements move, never texts or ids.

Cases: a null or empty text is the end id alone; equal lengths of a run go in
hash order; repeated documents are packed each; a row without doc_id is packed
like any other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake.llm.tables import id_text, map_rows
from lendlake.llm.tokens import crc32, default_path, encoder, ids_of, pieces

CAPACITY = 2048
OPEN_BINS = 1024
#: Pieces that are sorted by length at a time: few enough that the bins they open stay open.
RUN = 1024

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class BestFit:
    """Open bins by free space."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.spaces = 0  # bit f: a bin with f free is open
        self.bins: dict[int, list[int]] = {}
        self.open = self.made = 0

    def _take(self, free: int) -> int:
        here = self.bins[free]
        number = here.pop()
        if not here:
            self.spaces &= ~(1 << free)
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) for a piece of ``length``."""
        fits = self.spaces >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.made
            self.made += 1
        if free > length:
            if self.open == self.open_bins:
                self._take((self.spaces & -self.spaces).bit_length() - 1)  # the fullest closes
            self.bins.setdefault(free - length, []).append(number)
            self.spaces |= 1 << (free - length)
            self.open += 1
        return number, self.capacity - free


def runs(batches: Iterator[list], length: int) -> Iterator[list[tuple]]:
    """The rows of ``batches`` in runs of RUN, each by falling length (the
    column of that number)."""
    rows: list[tuple] = []
    for columns in batches:
        rows += zip(*columns)
        while len(rows) >= RUN:
            yield sorted(rows[:RUN], key=lambda r: -r[length])
            del rows[:RUN]
    if rows:
        yield sorted(rows, key=lambda r: -r[length])


def tokenised(docs: DataFrame, size: int, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row for each piece of at most ``size`` ids (binary, little-endian
    unsigned 32-bit, if asked for)."""
    path = path or default_path()

    def cut(batches: Iterator[list]) -> Iterator[list]:
        enc = encoder(path)
        for doc_ids, texts in batches:
            rows = []
            for i, text in zip(doc_ids, texts):
                for k, start, ids in pieces(ids_of(text, enc), size):
                    row = (i, k, start, len(ids), crc32(ids))
                    rows.append((*row, ids.tobytes()) if with_ids else row)
                if with_ids and len(rows) >= 512:
                    yield rows
                    rows = []
            yield rows

    return map_rows(id_text(docs), cut, _PIECES + ", ids binary" * with_ids)


def pack(
    docs: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, path: str | None = None, with_ids: bool = False
) -> DataFrame:
    """The pieces with their place: sequence_id and offset."""
    found = tokenised(docs, capacity, path, with_ids)
    at = found.columns.index("length")

    def placed(batches: Iterator[list]) -> Iterator[list]:
        bins = BestFit(capacity, open_bins)
        base = TaskContext.get().partitionId() << 40
        for run in runs(batches, at):
            rows = []
            for row in run:
                number, offset = bins.place(row[at])
                rows.append((*row, base + number, offset))
            yield rows

    mixed = F.xxhash64("doc_id", "piece", "ids_crc32")
    spread = found.repartition(mixed).sortWithinPartitions(mixed, "doc_id", "piece")
    return map_rows(spread, placed, _PIECES + ", ids binary" * with_ids + ", sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """From ``pack(..., with_ids=True)`` the filled sequences: sequence_id and
    their ids (binary), a bounded group each."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (
        packed.groupBy("sequence_id")
        .agg(parts.alias("parts"))
        .select("sequence_id", F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
    )
