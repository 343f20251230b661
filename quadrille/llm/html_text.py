"""Main texts of web pages by wrappers that are inferred per host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, with_results
from .wrappers import dumps, extract, loads, merge, read, wrapper

#: Hosts whose wrappers a task holds before it hands them on, and shares into which the wrappers of a host are dealt before they are merged as one.
HOSTS, SHARES = 2_000, 32


def host_of(url: Column) -> Column:
    """The host in lower case; empty for null and for addresses without one."""
    return F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.\-]*://([^/?#]*)", 1)


def infer(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(host, wrapper)``: one wrapper per host from all its pages, as JSON.

    Each task aligns the pages it reads, so of a host that holds most pages every task sends on one wrapper. These are aligned in two steps: in
    ``SHARES`` shares of a host each, and then the results of the shares.
    """
    import pyarrow as pa

    def rows(held: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([dumps(w) for w in held.values()], pa.string())], ["host", "wrapper"])

    def learn(batches):
        held: dict[str, list] = {}
        for batch in batches:
            for host, body in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                found = wrapper(read(body.decode("utf-8", "replace")))
                known = held.get(host)
                held[host] = found if known is None else merge(known, found)
            if len(held) > HOSTS:
                yield rows(held)
                held = {}
        yield rows(held)

    def align(batches):
        host, now = None, None
        done: dict[str, list] = {}
        for batch in batches:
            for name, text in zip(batch.column("host").to_pylist(), batch.column("wrapper").to_pylist()):
                if name != host:
                    if host is not None:
                        done[host] = now
                    host, now = name, loads(text)
                else:
                    now = merge(now, loads(text))
            if len(done) > HOSTS:
                yield rows(done)
                done = {}
        if host is not None:
            done[host] = now
        yield rows(done)

    schema = "host string, wrapper string"
    known = pages.where(column(html).isNotNull()).select(host_of(column(url)).alias("host"), column(html).cast("binary").alias("html"))
    share = F.pmod(F.xxhash64("wrapper"), F.lit(SHARES))
    some = known.mapInArrow(learn, schema).repartition(F.col("host"), share).sortWithinPartitions("host", "wrapper").mapInArrow(align, schema)
    return some.repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(align, schema)


def main_texts(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` per row of ``pages``.

    Character references are decoded, white space inside a block becomes one space, blocks are joined by one space in page
    order. Null and empty pages, and pages without a main text, give an empty text. Pages without a host share one wrapper.
    Repeated rows and null ids are rows like others. An empty table gives an empty result.
    """
    import pyarrow as pa

    schema = T.StructType([
        T.StructField("page_id", pages.schema[id].dataType), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()),
    ])

    def run(batches):
        for batch in batches:
            said = []
            for body, learnt in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist()):
                said.append(extract(read(body.decode("utf-8", "replace")), loads(learnt)) if body else "")
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(said, pa.string()), pa.array([len(t) for t in said], pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    wanted = pages.select(column(id).alias("page_id"), column(url).alias("url"), column(html).cast("binary").alias("html"), host_of(column(url)).alias("host"))
    return with_results(wanted, infer(pages, url, html), ["host"], "left").select("page_id", "url", "html", "wrapper").mapInArrow(run, schema)
