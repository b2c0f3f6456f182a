"""Best-fit packing of texts into sequences of several permitted lengths.

A text's length (by default its UTF-8 bytes, the tokens of a byte-level model) is cut
into pieces of the largest capacity and a rest. Pieces are dealt over shards by a hash
and every shard is packed in runs of a bounded number of pieces, longest first:

* a piece goes to the open bin with the least room that still holds it;
* where none does, a bin is opened with the permitted capacity of least cost per
  token that it can still expect to hold (its piece and all pieces of the run not yet
  placed, up to the capacity);
* at the end of a run every bin shrinks to the smallest capacity that holds it.

The cost of a sequence is a fixed part, its length and a quadratic part (attention).

A shard is a sorted stream; one run of it is in memory at a time, so a hash that many
rows share costs more runs, not more memory.

Defined results: an empty or null text is one piece of length 0 in no bin (null bin,
capacity and offset); repeated rows are packed each; ties are in order of id, start
and the scan.
"""

from __future__ import annotations

import bisect
import itertools
from collections import deque
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.session import materialize


@dataclass(frozen=True)
class Packing:
    """``capacities``: permitted lengths; ``overhead``: fixed cost of a sequence;
    ``square``: the length at which the quadratic part equals the linear one;
    ``run``: pieces packed together; ``shard``: pieces per shard on average."""

    capacities: tuple[int, ...] = (2_048, 4_096, 8_192)
    overhead: float = 256.0
    square: float = 65_536.0
    run: int = 50_000
    shard: int = 20_000

    def cost(self, capacity: int) -> float:
        return self.overhead + capacity + capacity * capacity / self.square


class _Bins:
    """Open bins by room: the room values in use are kept sorted; a room's bins wait in order of opening."""

    def __init__(self):
        self.rooms: list[int] = []
        self.waiting: dict[int, deque] = {}

    def take(self, need: int):
        k = bisect.bisect_left(self.rooms, need)
        if k == len(self.rooms):
            return None
        room = self.rooms[k]
        bins = self.waiting[room]
        found = bins.popleft()
        if not bins:
            del self.waiting[room], self.rooms[k]
        return found

    def put(self, room: int, bin_no: int) -> None:
        if room not in self.waiting:
            bisect.insort(self.rooms, room)
            self.waiting[room] = deque()
        self.waiting[room].append(bin_no)


def pack(sizes: list[int], p: Packing) -> tuple[list[int], list[int], list[int]]:
    """For sizes in descending order: each piece's bin and offset, each bin's final capacity."""
    capacities = sorted(p.capacities)
    rest, open_bins = sum(sizes), _Bins()
    where, offsets, used, capacity = [], [], [], []
    for size in sizes:
        rest -= size
        b = open_bins.take(size)
        if b is None:
            b = len(used)
            used.append(0)
            capacity.append(min((c for c in capacities if c >= size), key=lambda c: (p.cost(c) / min(c, size + rest), c)))
        where.append(b)
        offsets.append(used[b])
        used[b] += size
        if used[b] < capacity[b]:
            open_bins.put(capacity[b] - used[b], b)
    return where, offsets, [next(c for c in capacities if c >= u) for u in used]


def _pack_stream(p: Packing):
    names = ["doc_id", "piece", "start", "length", "bin_id", "bin_capacity", "bin_offset"]

    def packed(rows: list[tuple], shard: int, first: int):
        where, offsets, capacity = pack([r[3] for r in rows], p)
        ids = [(shard << 40) | (first + b) for b in where]
        cols = [*map(list, zip(*rows)), ids, [capacity[b] for b in where], offsets]
        types = [None, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        return cols, types, first + len(capacity)

    def run(batches):
        shard, held, first = None, [], 0
        kind = None

        def flush():
            nonlocal first, held
            cols, types, first = packed(held, shard, first)
            types[0], held = kind, []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

        for b in batches:
            kind = b.schema.field("doc_id").type
            rows = zip(*(b.column(c).to_pylist() for c in ("shard", "doc_id", "piece", "start", "length")), strict=True)
            for key, group in itertools.groupby(rows, key=lambda r: r[0]):
                if key != shard:
                    if held:
                        yield flush()
                    shard, first = key, 0
                for row in group:
                    held.append(row[1:])
                    if len(held) == p.run:
                        yield flush()
        if held:
            yield flush()

    return run


def pack_documents(documents: DataFrame, length: Column | None = None, params: Packing = Packing()) -> DataFrame:
    """``(doc_id, piece, start, length, bin_id, bin_capacity, bin_offset)``: every text's
    pieces in order, each in one bin. ``length``: a column of ``documents``, else the
    bytes of ``text``."""
    top = max(params.capacities)
    size = F.coalesce(F.octet_length(F.col("text").cast("string")) if length is None else length, F.lit(0)).cast("long")
    sized = materialize(documents.select("doc_id", size.alias("size")), "lengths")
    count = F.greatest(F.lit(1), F.ceil(F.col("size") / top)).cast("int")
    pieces = sized.select("doc_id", "size", F.explode(F.sequence(F.lit(0), count - 1)).alias("piece"))
    start = F.col("piece").cast("long") * top
    pieces = pieces.select("doc_id", "piece", start.alias("start"), F.least(F.col("size") - start, F.lit(top)).alias("length"))
    total = sized.agg(F.sum(count.cast("long")).alias("n")).first()["n"] or 0
    shards = max(1, -(-total // params.shard))
    kind = sized.schema["doc_id"].dataType.simpleString()
    dealt = pieces.where("length > 0").withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)).cast("long"))
    order = ["shard", F.col("length").desc(), F.col("doc_id").asc_nulls_last(), "start"]
    schema = f"doc_id {kind}, piece int, start long, length long, bin_id long, bin_capacity long, bin_offset long"
    out = dealt.repartition("shard").sortWithinPartitions(*order).mapInArrow(_pack_stream(params), schema)
    none = F.lit(None).cast("long")
    return out.unionByName(
        pieces.where("length = 0").select("doc_id", "piece", "start", "length", none.alias("bin_id"), none.alias("bin_capacity"), none.alias("bin_offset"))
    )
