"""Fill containers of fixed capacity with whole texts: bounded-space online best-fit.

Every task packs the texts of its own partition with a fixed number of open containers for each capacity. A bitset
holds the free spaces that open containers have, so the tightest one that still fits is found by one shift and one
lowest bit. When all are open and none fits, the fullest closes. Texts longer than the capacity are divided: full
containers of one piece each, and a rest that is packed like a text. When the input ends, the texts in the open
containers are packed once more, largest first. Nothing is shuffled, and a task's memory is bounded by the open
containers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lectern.llm.tokens import RANKS, count_tokens, encoding

#: Open containers a task and capacity.
OPEN_BINS = 512

Item = tuple[object, int, int, int]  # id, piece, first token, tokens


class Packer:
    """Open containers of one capacity; closed ones are handed out as (number, items)."""

    def __init__(self, capacity: int, most_open: int = OPEN_BINS):
        if capacity < 1:
            raise ValueError("a container must hold at least one token")
        self.capacity, self.most_open = capacity, most_open
        self.free: dict[int, list[list[Item]]] = {}
        self.spaces = self.open = self.closed = 0

    def _put(self, space: int, items: list[Item]) -> None:
        self.free.setdefault(space, []).append(items)
        self.spaces |= 1 << space

    def _take(self, space: int) -> list[Item]:
        own = self.free[space]
        items = own.pop()
        if not own:
            del self.free[space]
            self.spaces ^= 1 << space
        return items

    def _close(self, items: list[Item]) -> tuple[int, list[Item]]:
        self.closed += 1
        return self.closed, items

    def add(self, item: Item) -> Iterator[tuple[int, list[Item]]]:
        """Place an item no longer than the capacity; yields containers that close by it."""
        size = item[3]
        fitting = self.spaces >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            items = self._take(space)
            items.append(item)
            space -= size
        else:
            if self.open >= self.most_open:
                fullest = (self.spaces & -self.spaces).bit_length() - 1
                yield self._close(self._take(fullest))
                self.open -= 1
            items, space = [item], self.capacity - size
            self.open += 1
        if space:
            self._put(space, items)
        else:
            self.open -= 1
            yield self._close(items)

    def pack(self, key: object, size: int) -> Iterator[tuple[int, list[Item]]]:
        """Place a text of size tokens, divided only if it exceeds the capacity. An empty text takes no room but has a place."""
        full, rest = divmod(size, self.capacity)
        for piece in range(full):
            yield self._close([(key, piece, piece * self.capacity, self.capacity)])
        if rest or not full:
            yield from self.add((key, full, full * self.capacity, rest))

    def finish(self) -> Iterator[tuple[int, list[Item]]]:
        """Pack what lies in open containers once more, largest first, and close all."""
        items = sorted((x for own in self.free.values() for bin_ in own for x in bin_), key=lambda x: -x[3])
        self.free, self.spaces, self.open = {}, 0, 0
        self.most_open = len(items) + 1
        for item in items:
            yield from self.add(item)
        while self.spaces:
            yield self._close(self._take((self.spaces & -self.spaces).bit_length() - 1))
        self.open = 0


def pack_all(sizes: Iterable[tuple[object, int]], capacity: int, most_open: int = OPEN_BINS) -> list[list[Item]]:
    """Containers of a small list; for tests and as the definition of a task's work."""
    packer = Packer(capacity, most_open)
    out = [items for key, size in sizes for _, items in packer.pack(key, size)]
    return out + [items for _, items in packer.finish()]


def pack(df: DataFrame, capacities: dict[str, int], *, id_col: str = "doc_id", text: str | None = "text", size: str | None = None, path: str = RANKS, open_bins: int = OPEN_BINS) -> DataFrame:
    """(container_set, container_id, id, piece, token_start, tokens), one row a placed piece.

    Sizes are tokens of text, or the column size where given. Null and empty texts and sizes below 1 take a place of
    0 tokens, so no row is lost; repeated rows are placed as often as they come. Texts with equal sizes go in
    the order read. An empty table gives no rows; other columns are not read. capacities names container sets.
    """
    measured = F.col(f"`{size}`").cast("long") if size else F.col(f"`{text}`")
    rows = df.select(F.col(f"`{id_col}`").alias("_id"), measured.alias("_x"), F.spark_partition_id().alias("_part"))
    by_size, kind = size is not None, dict(rows.dtypes)["_id"]
    names = ["container_set", "container_id", id_col, "piece", "token_start", "tokens"]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packers = {name: Packer(capacity, open_bins) for name, capacity in capacities.items()}
        part, id_type = 0, None
        encode = None if by_size else encoding(path).encode_ordinary

        def rows_of(closed: list[tuple[str, int, list[Item]]]) -> pa.RecordBatch:
            flat = [(name, (part << 33) + number, *item) for name, number, items in closed for item in items]
            columns = list(zip(*flat, strict=True)) or [()] * 6
            kinds = [pa.string(), pa.int64(), id_type, pa.int32(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            part, id_type = batch.column(2)[0].as_py(), batch.schema.field(0).type
            values = batch.column(1).to_pylist()
            sizes = [max(0, x or 0) for x in values] if by_size else count_tokens(values, encode)
            keys = batch.column(0).to_pylist()
            closed = [(name, *done) for name, packer in packers.items() for key, n in zip(keys, sizes, strict=True) for done in packer.pack(key, n)]
            yield rows_of(closed)
        if id_type is not None:
            yield rows_of([(name, *done) for name, packer in packers.items() for done in packer.finish()])

    return rows.mapInArrow(fill, f"container_set string, container_id long, `{id_col}` {kind}, piece int, token_start long, tokens long")


def capacities(sizes: DataFrame, most: int = 1000) -> dict[str, int]:
    """Capacity of each container set of a small table (container_set, capacity_tokens); null rows are left out, the largest of repeats holds."""
    rows = sizes.filter("container_set is not null and capacity_tokens > 0").groupBy("container_set").agg(F.max("capacity_tokens").alias("n")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} container sets")
    return {r["container_set"]: r["n"] for r in sorted(rows, key=lambda r: r["container_set"])}


def placements(packed: DataFrame, capacity: dict[str, int], id_col: str = "doc_id") -> DataFrame:
    """(container_set, id, whole, fits) of every text of a packing, for checking it; ids must differ.

    whole: the pieces follow one another from token 0, and there are several only where a text exceeds the capacity.
    fits: no container of its pieces holds more than the capacity.
    """
    most = F.element_at(F.create_map(*[F.lit(x) for pair in capacity.items() for x in pair]), F.col("container_set"))
    held = packed.groupBy("container_set", "container_id").agg(F.sum("tokens").alias("_held"))
    each = packed.join(held, ["container_set", "container_id"]).groupBy("container_set", id_col).agg(
        F.count(F.lit(1)).alias("_n"), F.max("piece").alias("_last"), F.sum("tokens").alias("_sum"), F.max(F.col("token_start") + F.col("tokens")).alias("_end"), F.countDistinct("token_start").alias("_starts"), F.max("_held").alias("_held")
    )
    pieces = (F.col("_n") == F.col("_last") + 1) & (F.col("_starts") == F.col("_n")) & (F.col("_sum") == F.col("_end"))
    return each.select("container_set", id_col, (pieces & ((F.col("_n") == 1) | (F.col("_sum") > most))).alias("whole"), (F.col("_held") <= most).alias("fits"))


def fill_report(packed: DataFrame, capacity: dict[str, int]) -> DataFrame:
    """(container_set, capacity_tokens, containers, tokens, fewest_possible, used_share) of a packing."""
    each = packed.groupBy("container_set").agg(F.countDistinct("container_id").alias("containers"), F.sum("tokens").alias("tokens"))
    pairs = [F.lit(x) for pair in capacity.items() for x in pair]
    sized = each.withColumn("capacity_tokens", F.element_at(F.create_map(*pairs), F.col("container_set")).cast("long"))
    return sized.select("container_set", "capacity_tokens", "containers", "tokens", F.ceil(F.col("tokens") / F.col("capacity_tokens")).alias("fewest_possible"), (F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))).alias("used_share"))

