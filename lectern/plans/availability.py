"""The availability scan: where the data of a paper can be had, from its text, by an injected client and by patterns.

The client sees the window around the availability heading only. Its reply is read as JSON, else as prose, and coerced;
identifiers that stand plainly in the window are added whatever it says. A client that fails, or none, leaves the patterns.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lectern.functions import coerce, text as tx
from lectern.functions.jsonfix import availability_reply, salvage
from lectern.operators import merge
from lectern.plans.extraction import Client
from lectern.schema import AVAILABILITY

FOUND = ["data_availability", "data_accession_links", "data_availability_statement"]
SYSTEM = (
    "You judge how the data behind a scientific paper can be obtained, from a part of its text. Reply with one JSON object in a fenced block: "
    f"data_availability, one of {', '.join(AVAILABILITY)}; data_accession_links, a list of identifiers and addresses of deposited data, "
    "empty unless the data are in a public repository; data_availability_statement, the sentence that says so, copied, or an empty text. "
    "Data are in a public repository only if the text names an identifier or an address there; where it says nothing, answer not-stated."
)


def replies(papers: DataFrame, client: Client, system: str = SYSTEM) -> DataFrame:
    """(pmcid, window, reply, found) for each paper (pmcid, title, year, window): what the client said, and the JSON object in it.

    One call a paper, no second try; a client that raises and an empty window give nulls. Rows repeat as often as they come.
    """

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            said = []
            for row in frame.itertuples(index=False):
                reply = None
                if row.window:
                    user = f"Title: {row.title or ''}\nYear: {row.year or ''}\nPMCID: {row.pmcid}\n\n{row.window}"
                    try:
                        reply = client([{"role": "system", "content": system}, {"role": "user", "content": user}])
                    except Exception:  # noqa: BLE001
                        reply = None
                held = salvage(reply)
                said.append((row.pmcid, row.window, reply, None if held is None else json.dumps(held, ensure_ascii=False)))
            yield pd.DataFrame(said, columns=["pmcid", "window", "reply", "found"])

    return papers.select("pmcid", "title", "year", "window").mapInPandas(ask, "pmcid string, window string, reply string, found string")


def scan(papers: DataFrame, client: Client | None = None, *, system: str = SYSTEM) -> DataFrame:
    """(pmcid, data_availability, data_accession_links, data_availability_statement, told_by) of each paper (pmcid, title, year, text).

    told_by is model, patterns, both or, with nulls for the rest, none. Texts are read whole to find their window. A null
    or blank text tells nothing. pmcid names a paper; two rows of one pmcid are two papers.
    """
    windowed = papers.select("pmcid", "title", "year", F.coalesce(tx.availability_window(coerce.strip(F.col("text"))), F.lit("")).alias("window"))
    if client is None:
        told = windowed.select("pmcid", "window", F.lit(None).cast("string").alias("reply"), F.lit(None).cast("string").alias("found"))
    else:
        told = replies(windowed, client, system)
    fields = F.from_json("found", "data_availability string, data_accession_links string, data_availability_statement string")
    links = F.col("r.data_accession_links")
    listed = F.when(links.startswith("["), coerce.list_of(F.from_json(links, "array<string>"))).otherwise(coerce.list_of_text(links))
    by_json = F.when(F.col("found").isNotNull(), F.struct(coerce.availability(F.col("r.data_availability")).alias("a"), listed.alias("l"), F.coalesce("r.data_availability_statement", F.lit("")).alias("s")))
    prose = availability_reply(F.col("reply"))
    by_prose = F.when(F.col("found").isNull() & prose.isNotNull(), F.struct(prose["data_availability"].alias("a"), prose["data_accession_links"].alias("l"), prose["data_availability_statement"].alias("s")))
    said = told.withColumn("r", fields).select("pmcid", "window", F.coalesce(by_json, by_prose).alias("m"))
    # the links of a window are looked for once, in a projection of their own
    linked = said.withColumn("_links", tx.accession_links(F.col("window")))
    made = linked.select("pmcid", "m", "_links", merge.with_links_found(F.col("m.l"), F.col("m.a"), F.col("m.s"), F.col("window"), F.col("_links")).alias("w"))
    plain = F.size("_links") > 0
    by = F.when(F.col("m").isNotNull() & plain, "both").when(F.col("m").isNotNull(), "model").when(plain, "patterns").otherwise("none")
    return made.select("pmcid", *[F.col(f"w.{c}").alias(c) for c in FOUND], by.alias("told_by"))


def scanned_records(records: DataFrame, found: DataFrame) -> DataFrame:
    """records with what a scan found for them; papers that have no record yet come as partial ones, the other columns null.

    Both have one row a pmcid. A paper whose scan told nothing keeps what its record says.
    """
    told = found.filter("told_by <> 'none'").select("pmcid", *[F.col(c).alias(f"_{c}") for c in FOUND], F.lit(True).alias("_told"))
    joined = records.join(told, "pmcid", "full_outer")
    return joined.select(*[F.when(F.col("_told"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in FOUND else F.col(c) for c in records.columns])
