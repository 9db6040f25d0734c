"""Remote services as sources: a Python data source over an injected client, batched and rate-limited lookups."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

MAX_HITS, BATCH, DELAY_S, MIN_BYTES = 200, 20, 0.4, 5_000


class _Query(InputPartition):
    def __init__(self, place: int, query: str):
        super().__init__(place)
        self.query = query


def search_source(name: str, client: Callable[[str, int], tuple[int, list[str]]], max_hits: int = MAX_HITS) -> type[DataSource]:
    """A data source class (register it with spark.dataSource.register) that runs searches.

    client(query, most) gives (hits, ids). Queries come in option queries, one a line, each its own partition.
    Rows are (query, place, uid, capped); a search that fails gives none.
    """

    class Reader(DataSourceReader):
        def __init__(self, options: dict[str, str]):
            self.queries = [q for q in options.get("queries", "").split("\n") if q.strip()]

        def partitions(self) -> list[InputPartition]:
            return [_Query(i, q) for i, q in enumerate(self.queries)]

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            if not isinstance(partition, _Query):
                return
            try:
                hits, ids = client(partition.query, max_hits)
            except Exception:  # noqa: BLE001
                return
            for place, uid in enumerate(ids[:max_hits]):
                yield partition.query, place, uid, hits > len(ids)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "query string, place int, uid string, capped boolean"

        def reader(self, schema) -> DataSourceReader:
            return Reader(self.options)

    return Source


def lookup(ids: DataFrame, client: Callable[[list[str]], dict[str, dict]], schema: str, *, key: str = "uid", batch: int = BATCH, delay: float = DELAY_S, tasks: int = 4) -> DataFrame:
    """One row an id that the client knows, asked in batches; tasks and delay limit the rate. Errors of the client are raised."""
    names = [c.split()[0] for c in schema.split(", ")]

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys = frame[key].tolist()
            for at in range(0, len(keys), batch):
                found = client(keys[at : at + batch])
                rows = [{key: k, **found[k]} for k in keys[at : at + batch] if k in found]
                yield pd.DataFrame(rows, columns=names)
                time.sleep(delay)

    return ids.select(key).distinct().repartition(tasks).mapInPandas(ask, schema)


def download(urls: DataFrame, client: Callable[[str], tuple[int, bytes]], *, key: str = "pmcid", url: str = "url", min_bytes: int = MIN_BYTES, delay: float = DELAY_S, tasks: int = 4) -> DataFrame:
    """(key, content): the bytes of each address; null unless the status is 200 and there are more than min_bytes."""

    def get(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # a row at a time: a batch of whole files would not fit
        for frame in frames:
            for name, address in zip(frame["k"], frame["u"], strict=True):
                try:
                    status, data = client(address) if address else (0, b"")
                except Exception:  # noqa: BLE001
                    status, data = 0, b""
                yield pd.DataFrame({key: [name], "content": [data if status == 200 and len(data) > min_bytes else None]})
                time.sleep(delay)

    return urls.select(F.col(key).alias("k"), F.col(url).alias("u")).repartition(tasks).mapInPandas(get, f"{key} string, content binary")
