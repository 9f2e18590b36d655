"""Main text of web pages by consensus per host.

Every page scores its containers and votes for the generalised paths (tags and
classes without digits) of all of them, by their share of the score. Votes are integers summed per host and path
in Spark; the path with most votes wins the host. Every page is then read again,
and the text is taken from the winning path; a page without such a node falls
back on its own best container, then on its body.

A host with a third of all pages costs one partial sum per task and path. The
winners, one row per host, are written first and joined without a hint: Spark then
knows their size, broadcasts them only if it allows that, so that pages stay where
they are, and else splits the hot host's rows.

Defined results: null or empty html gives an empty text; a page without a
readable host (null, empty or relative url) takes no part in votes and uses its
own best container; equal pages give equal rows; ties go to the path that is
last in order; an empty table gives no rows. White space is what Unicode says.
"""

import pyarrow as pa
from pyspark.sql import functions as F

from lexitally.llm.html_pages import main_text, votes
from lexitally.session import stored

_HOST = r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"


def host(url):
    """Lower-cased host of a url column; null if there is none."""
    found = F.lower(F.regexp_extract(url, _HOST, 1))
    return F.when(found != "", found)


def host_paths(pages, url="url", html="html"):
    """Votes of all pages summed: (host, path, votes)."""

    def voted(batches):
        for batch in batches:
            hosts, paths, shares = [], [], []
            for name, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for path, share in votes(source):
                    hosts.append(name)
                    paths.append(path)
                    shares.append(share)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(shares, pa.int64())], ["host", "path", "share"])

    rows = pages.select(host(F.col(f"`{url}`")).alias("host"), F.col(f"`{html}`").alias("html")).where("host IS NOT NULL AND html <> ''")
    return rows.mapInArrow(voted, "host string, path string, share long").groupBy("host", "path").agg(F.sum("share").alias("votes"))


def winning_paths(summed):
    """The path with most votes of every host: (host, path)."""
    return summed.groupBy("host").agg(F.max(F.struct("votes", "path")).alias("best")).select("host", "best.path")


def extract(pages, id_col="page_id", url="url", html="html"):
    """Id, url and main text of every page."""
    winners = stored(winning_paths(host_paths(pages, url, html)).withColumnRenamed("host", "_won"), "host-paths")
    rows = pages.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"), host(F.col(f"`{url}`")).alias("_host")
    )
    joined = rows.join(winners, F.col("_host") == F.col("_won"), "left").select("id", "url", "html", "path")

    def read_again(batches):
        for batch in batches:
            sources, paths = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            texts = pa.array([main_text(s, p) if s else "" for s, p in zip(sources, paths)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], [id_name, "url", "text"])

    id_name = id_col
    schema = f"`{id_col}` {dict(pages.dtypes)[id_col]}, url {dict(pages.dtypes)[url]}, text string"
    return joined.mapInArrow(read_again, schema)
