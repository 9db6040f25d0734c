"""Queries that go through files: records, batches, logs, metadata and articles are written and read again.

Files go to a folder of their own under the shared checkpoint folder, which the session's checkpoints use as well.
"""

from __future__ import annotations

import io
import tarfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lectern.functions import coerce, text as tx
from lectern.plans.corpus_queries import LATEST, as_text, as_text_sql, id_sql, latest
from lectern.plans.registry import Registry
from lectern.schema import CHECKLIST_COLUMNS
from lectern.session import ensure_checkpoint_dir, read_table
from lectern.sources import files, fulltext

REGISTRY = Registry()
query = REGISTRY.add


def scratch(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/files-{uuid.uuid4().hex}"


@query(f"with {LATEST} select {as_text_sql(CHECKLIST_COLUMNS)} from latest")
def record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus written as records in hash buckets and read again."""
    folder = scratch(spark)
    files.write_records(latest(spark, sf_dir).select(*CHECKLIST_COLUMNS), folder)
    return files.read_record_lines(spark, folder).select(*as_text(CHECKLIST_COLUMNS))


@query(f"with {LATEST} select {as_text_sql(CHECKLIST_COLUMNS)} from latest")
def batch_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch file, one record a line, read again."""
    folder = scratch(spark)
    files.write_batch(latest(spark, sf_dir).select(*CHECKLIST_COLUMNS), folder)
    return files.read_batch_lines(spark, folder).select(*as_text(CHECKLIST_COLUMNS))


@query(f"select {id_sql()} as pmcid, title, reason, 'excluded' as list from log_excluded union all select 'PMC' || uid, null, null, 'downloaded' from (select distinct uid from paper_metadata where uid is not null)")
def download_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A download log written list by list and read again."""
    excluded = read_table(spark, sf_dir, "log_excluded").select(coerce.pmcid(F.col("pmcid")).alias("pmcid"), "title", "reason")
    done = read_table(spark, sf_dir, "paper_metadata").filter("uid is not null").select("uid").distinct()
    folder = scratch(spark)
    files.write_log({"excluded": excluded, "downloaded": done}, folder)
    log = files.read_log_lists(spark, folder, ["excluded", "downloaded"])
    listed = log["excluded"].select("pmcid", "title", "reason", F.lit("excluded").alias("list"))
    return listed.unionByName(log["downloaded"].select(F.concat(F.lit("PMC"), "uid").alias("pmcid"), F.lit("downloaded").alias("list")), allowMissingColumns=True)


def _archives(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """An archive a paper: a supplement, a figure, two papers and a note, in that order."""
    for frame in frames:
        made = []
        for path, size, more in zip(frame["path"], frame["size"], frame["more"], strict=True):
            buffer = io.BytesIO()
            with tarfile.open(fileobj=buffer, mode="w:gz") as archive:
                for name, n in (("x/main_supp1.pdf", 9000), ("x/fig1.pdf", 8000), ("x/paper.pdf", size), ("x/other.pdf", size + more), ("x/notes.txt", 7000)):
                    member = tarfile.TarInfo(name)
                    member.size = n
                    archive.addfile(member, io.BytesIO(bytes(n)))
            made.append(buffer.getvalue())
        yield pd.DataFrame({"path": frame["path"], "content": made})


@query(f"with p as (select distinct {id_sql()} as path, cast(right({id_sql()}, 2) as int) as k from log_papers) select path, case when k % 3 > 1 then 'x/other.pdf' else 'x/paper.pdf' end as name, 100 + k + greatest(k % 3 - 1, 0) as size from p")
def archive_main_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive for every paper of the log, read again: its main paper, the larger of two, the first of equal ones."""
    papers = read_table(spark, sf_dir, "log_papers").select(coerce.pmcid(F.col("pmcid")).alias("path")).distinct()
    sized = papers.withColumn("k", F.right("path", F.lit(2)).cast("int")).select("path", (F.col("k") + 100).cast("long").alias("size"), F.greatest(F.col("k") % 3 - 1, F.lit(0)).cast("long").alias("more"))
    return fulltext.main_member(fulltext.archive_members(sized.mapInPandas(_archives, "path string, content binary")))


@query("select uid, max(title) as title, max(pubdate) as pubdate from paper_metadata where uid is not null group by uid")
def metadata_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata written as JSON lines, each id first with an older title, of which the last line counts."""
    rows = read_table(spark, sf_dir, "paper_metadata").filter("uid is not null").groupBy("uid").agg(F.max("title").alias("title"), F.max("pubdate").alias("pubdate"))
    twice = rows.select("uid", F.posexplode(F.array(F.lit("an older title"), F.col("title"))).alias("k", "title"), "pubdate")
    folder = scratch(spark)
    twice.repartition("uid").sortWithinPartitions("uid", "k").drop("k").write.option("ignoreNullFields", "false").json(folder)
    return files.read_metadata(spark, folder).select("uid", "title", "pubdate")


#: Characters that XML can't hold, and white space as Python strips it.
NOT_XML = r"[\x{0}-\x{8}\x{B}\x{C}\x{D}-\x{1F}\x{FFFE}\x{FFFF}]"
SPACE = r"[\s\x{B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def _escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(F.regexp_replace(text, NOT_XML, ""), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _stripped_sql(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{SPACE}', ''), '{SPACE}$', '')"


@query(
    rf"""with d as (select doc_id, regexp_replace(coalesce(section, ''), '{NOT_XML}', '', 'g') as s, regexp_replace(coalesce(text, ''), '{NOT_XML}', '', 'g') as t from documents),
p as (select doc_id, {_stripped_sql('s')} as s, {_stripped_sql('t')} as t from d)
select doc_id, 'xml' as format, md5(case when s = '' then t when t = '' then s else s || chr(10) || chr(10) || t end) as digest, length(t) > {fulltext.MIN_BODY_CHARS} as genuine from p"""
)
def article_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as an XML article: its text as extracted, and whether it is a genuine full text."""
    body = F.concat(F.lit('<article article-type="research"><front><article-title>'), _escaped(F.coalesce("section", F.lit(""))), F.lit("</article-title></front><body>"), _escaped(F.coalesce("text", F.lit(""))), F.lit("</body></article>"))
    made = read_table(spark, sf_dir, "documents").select(F.concat(F.lit("/articles/"), F.col("doc_id").cast("string"), F.lit(".xml")).alias("path"), body.cast("binary").alias("content"))
    told = fulltext.extract(made, keep_valid=True)
    return told.select(tx.stem_of(F.col("path")).cast("long").alias("doc_id"), "format", F.md5("text").alias("digest"), "genuine")


def queries() -> dict:
    return dict(REGISTRY.queries)


def oracle_sql() -> dict[str, str]:
    return dict(REGISTRY.sql)
