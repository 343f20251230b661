"""Queries on sources and sinks: everything written is read back and compared as rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.iri import Template
from ..model import DEFAULT_GRAPH, QUAD, RDF, RDF_TYPE, XSD_INTEGER, Val, as_set
from ..operators.caches import bulk_quads
from ..operators.graph import Pattern
from ..operators.mapping import Col, MappedGraph, Mapping, Rule, Table, direct_mapping
from ..operators.patterns import bgp
from ..operators.store import read_quads, restore, write_quads
from ..session import scratch
from ..sinks.blobs import write_blobs
from ..sinks.graphs import write_nquads, write_ntriples
from ..sinks.results import write_csv, write_json, write_tsv
from ..sources.lines import read_nquads
from ..sources.rdfxml import read_rdfxml_flat
from ..sources.results import read_results_json
from ..sources.tables import Sources, read_binary, read_json, read_lines_delimited
from .base import BASE, graph, iri, link, prop, query, store_of, table

DOCS = "urn:graph:documents"
TEXT = BASE + "text"
#: Descriptions of one XML document that is written, and folders of blobs that are read at a time.
XML_RECORDS, SCAN_FOLDERS = 50_000, 100


def document_graph(spark, folder) -> MappedGraph:
    """Whole texts as literals in a named graph; labels in the default graph."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    subject = Template(BASE + "documents/doc_id={doc_id}")
    return MappedGraph([
        Mapping(docs.select("doc_id", "text", "source"), (Rule(subject, TEXT, Col("text", lang="x-doc")), Rule(subject, BASE + "source", Col("source"))), DOCS, True),
        Mapping(labels.select("doc_id", "quality"), (Rule(subject, BASE + "quality", Col("quality")),), DEFAULT_GRAPH, True),
    ])


DOCUMENT_ROWS = f"""
    SELECT {iri('documents')} AS s, '{TEXT}' AS p, text AS o_value, 'literal' AS o_type, '' AS o_datatype, 'x-doc' AS o_lang, '{DOCS}' AS g FROM documents
    UNION ALL SELECT {iri('documents')}, '{BASE}source', source, 'literal', '', '', '{DOCS}' FROM documents
    UNION ALL SELECT {iri('documents')}, '{BASE}quality', CAST(quality AS VARCHAR), 'literal', '{XSD_INTEGER}', '', '{DEFAULT_GRAPH}' FROM labels"""


@query("nquads_scan", DOCUMENT_ROWS)
def nquads_scan(spark, folder):
    path = scratch(spark, "nquads")
    write_nquads(document_graph(spark, folder).quads(), path)
    return as_set(read_nquads(spark, path)).select(*QUAD)


def numbers_as_sql(quads, *predicates):
    """Quads with the doubles of some predicates shown as SQL writes them."""
    return quads.withColumn("o_value", F.when(F.col("p").isin(list(predicates)), F.col("o_value").cast("double").cast("string")).otherwise(F.col("o_value")))


@query("bulk_load", f"""
    SELECT {iri('nation')} AS s, '{RDF_TYPE}' AS p, '{BASE}nation' AS o_value, '{DEFAULT_GRAPH}' AS g FROM nation
    UNION ALL SELECT {iri('nation')}, '{prop('nation', 'n_nationkey')}', CAST(n_nationkey AS VARCHAR), '{DEFAULT_GRAPH}' FROM nation
    UNION ALL SELECT {iri('nation')}, '{prop('nation', 'n_name')}', n_name, '{DEFAULT_GRAPH}' FROM nation
    UNION ALL SELECT {iri('nation')}, '{prop('nation', 'n_regionkey')}', CAST(n_regionkey AS VARCHAR), '{DEFAULT_GRAPH}' FROM nation
    UNION ALL SELECT {iri('nation')}, '{link('nation', 'n_regionkey')}', {iri('region', 'n_regionkey')}, '{DEFAULT_GRAPH}' FROM nation
    UNION ALL SELECT {iri('supplier')}, '{RDF_TYPE}', '{BASE}supplier', 'urn:graph:suppliers' FROM supplier
    UNION ALL SELECT {iri('supplier')}, '{prop('supplier', 's_suppkey')}', CAST(s_suppkey AS VARCHAR), 'urn:graph:suppliers' FROM supplier
    UNION ALL SELECT {iri('supplier')}, '{prop('supplier', 's_name')}', s_name, 'urn:graph:suppliers' FROM supplier
    UNION ALL SELECT {iri('supplier')}, '{prop('supplier', 's_nationkey')}', CAST(s_nationkey AS VARCHAR), 'urn:graph:suppliers' FROM supplier
    UNION ALL SELECT {iri('supplier')}, '{link('supplier', 's_nationkey')}', {iri('nation', 's_nationkey')}, 'urn:graph:suppliers' FROM supplier
    UNION ALL SELECT {iri('supplier')}, '{prop('supplier', 's_acctbal')}', CAST(s_acctbal AS VARCHAR), 'urn:graph:suppliers' FROM supplier
    UNION ALL SELECT DISTINCT {iri('customer', 'o_custkey')}, '{BASE}status', o_orderstatus, 'urn:graph:orders' FROM orders""")
def bulk_load(spark, folder):
    """Three sources, each to its own graph; the last one holds repeated triples."""
    status = MappedGraph([Mapping(table(spark, folder, "orders"), (Rule(Template(BASE + "customer/c_custkey={o_custkey}"), BASE + "status", Col("o_orderstatus")),))])
    path = scratch(spark, "bulk")
    write_quads(bulk_quads(
        (graph(spark, folder, "nation").quads(), DEFAULT_GRAPH), (graph(spark, folder, "supplier").quads(), "urn:graph:suppliers"), (status.quads(), "urn:graph:orders"),
    ), path)
    return numbers_as_sql(read_quads(spark, path), prop("supplier", "s_acctbal")).select("s", "p", "o_value", "g")


@query("delimited_scan", f"""
    SELECT {iri('customer')} AS s, '{BASE}name' AS p, c_name AS o_value FROM customer
    UNION ALL SELECT {iri('customer')}, '{BASE}segment', c_mktsegment FROM customer
    UNION ALL SELECT {iri('customer')}, '{BASE}nation', {iri('nation', 'c_nationkey')} FROM customer
    UNION ALL SELECT {iri('customer')}, '{BASE}key', CAST(c_custkey AS VARCHAR) FROM customer
    UNION ALL SELECT {iri('customer')}, '{BASE}balance', CAST(c_acctbal AS VARCHAR) FROM customer""")
def delimited_scan(spark, folder):
    """Tab-separated text with a header as input of a mapping."""
    path = scratch(spark, "tsv")
    customer = table(spark, folder, "customer")
    customer.write.option("header", True).option("sep", "\t").csv(path)
    rows = read_lines_delimited(spark, path, customer.schema, "\t")
    s = Template(BASE + "customer/c_custkey={c_custkey}")
    literals = (("name", "c_name"), ("segment", "c_mktsegment"), ("key", "c_custkey"), ("balance", "c_acctbal"))
    rules = (*(Rule(s, BASE + p, Col(c)) for p, c in literals), Rule(s, BASE + "nation", Template(BASE + "nation/n_nationkey={c_nationkey}")))
    return numbers_as_sql(MappedGraph([Mapping(rows, rules, unique=True)]).quads(), BASE + "balance").select("s", "p", "o_value")


@query("json_scan", f"""
    SELECT {iri('orders')} AS s, '{BASE}customer' AS p, {iri('customer', 'o_custkey')} AS o_value FROM orders
    UNION ALL SELECT {iri('orders')}, '{BASE}price', CAST(o_totalprice AS VARCHAR) FROM orders
    UNION ALL SELECT {iri('orders')}, '{BASE}placed', strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') FROM orders
    UNION ALL SELECT {iri('orders')}, '{BASE}tag', o_orderstatus FROM orders
    UNION ALL SELECT {iri('orders')}, '{BASE}tag', o_orderpriority FROM orders""")
def json_scan(spark, folder):
    """JSON objects with an array: the object gives parent triples, its elements child triples."""
    path = scratch(spark, "json")
    by = F.struct("o_custkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("placed")).alias("by")
    table(spark, folder, "orders").select("o_orderkey", by, F.array("o_orderstatus", "o_orderpriority").alias("tags")).write.json(path)
    rows = read_json(spark, path, "o_orderkey long, by struct<o_custkey: long, o_totalprice: double, placed: string>, tags array<string>")
    s = Template(BASE + "orders/o_orderkey={o_orderkey}")
    parents = rows.select("o_orderkey", "by.*")
    children = rows.select("o_orderkey", F.explode("tags").alias("tag"))
    g = MappedGraph([
        Mapping(parents, (Rule(s, BASE + "customer", Template(BASE + "customer/c_custkey={o_custkey}")), Rule(s, BASE + "price", Col("o_totalprice")),
                          Rule(s, BASE + "placed", Col("placed"))), unique=True),
        Mapping(children, (Rule(s, BASE + "tag", Col("tag")),)),
    ])
    return numbers_as_sql(g.quads(), BASE + "price").select("s", "p", "o_value")


@query("jdbc_scan", f"""
    SELECT {iri('supplier')} AS s, s_name AS name, n_name AS nation FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def jdbc_scan(spark, folder):
    """Named relational sources behind a registry; the given tables stand in for a database."""
    sources = Sources()
    for name in ("supplier", "nation"):
        sources.register(name, table(spark, folder, name))
    g = direct_mapping([
        Table("supplier", sources.get("supplier"), ("s_suppkey",), {"s_nationkey": ("nation", "n_nationkey")}),
        Table("nation", sources.get("nation"), ("n_nationkey",)),
    ], BASE)
    return bgp(g, [
        Pattern("?s", prop("supplier", "s_name"), Val("?name", "string")), Pattern("?s", link("supplier", "s_nationkey"), "?n"),
        Pattern("?n", prop("nation", "n_name"), Val("?nation", "string")),
    ]).select("s", "name", "nation")


@query("rdfxml_flat_scan", f"""
    SELECT {iri('customer')} AS s, '{BASE}name' AS p, c_name AS o_value, 'literal' AS o_type FROM customer
    UNION ALL SELECT {iri('customer')}, '{BASE}segment', c_mktsegment, 'literal' FROM customer
    UNION ALL SELECT {iri('customer')}, '{BASE}balance', CAST(c_acctbal AS VARCHAR), 'literal' FROM customer
    UNION ALL SELECT {iri('customer')}, '{BASE}key', CAST(c_custkey AS VARCHAR), 'literal' FROM customer
    UNION ALL SELECT {iri('customer')}, '{BASE}nation', {iri('nation', 'c_nationkey')}, 'uri' FROM customer""")
def rdfxml_flat_scan(spark, folder):
    """Documents written by the XML writer; all their children are read, whatever they are called."""
    path = scratch(spark, "rdfxml")
    described = table(spark, folder, "customer").select(
        F.concat(F.lit(BASE + "customer/c_custkey="), "c_custkey").alias("_rdf:about"), F.col("c_name").alias("a:name"),
        F.struct(F.concat(F.lit(BASE + "nation/n_nationkey="), "c_nationkey").alias("_rdf:resource"), F.lit("").alias("_VALUE")).alias("a:nation"),
        F.col("c_mktsegment").alias("a:segment"), F.col("c_acctbal").alias("a:balance"), F.col("c_custkey").alias("a:key"),
    )
    options = {"validateName": "false", "rowTag": "rdf:Description", "rootTag": f'rdf:RDF xmlns:rdf="{RDF}" xmlns:a="{BASE}"'}
    # One task reads a whole document, so none grows with the table.
    described.write.format("xml").options(**options).option("maxRecordsPerFile", XML_RECORDS).save(path)
    return numbers_as_sql(read_rdfxml_flat(spark, path, {"rdf": RDF, "a": BASE}), BASE + "balance").select("s", "p", "o_value", "o_type")


@query("results_json_scan", f"""
    SELECT 'uri' AS e_type, {iri('events')} AS e, event_type AS t, CAST(user_id AS VARCHAR) AS u, '{XSD_INTEGER}' AS u_datatype FROM events""")
def results_json_scan(spark, folder):
    """Result documents, one per line, to rows."""
    events = table(spark, folder, "events")
    e = F.struct(F.lit("uri").alias("type"), F.concat(F.lit(BASE + "events/event_id="), F.col("event_id")).alias("value"))
    t = F.struct(F.lit("literal").alias("type"), F.col("event_type").alias("value"))
    u = F.struct(F.lit("literal").alias("type"), F.col("user_id").cast("string").alias("value"), F.lit(XSD_INTEGER).alias("datatype"))
    head = F.struct(F.array(F.lit("e"), F.lit("t"), F.lit("u")).alias("vars"))
    results = F.struct(F.array(F.struct(e.alias("e"), t.alias("t"), u.alias("u"))).alias("bindings"))
    path = scratch(spark, "results")
    events.select(head.alias("head"), results.alias("results")).write.json(path)
    rows = read_results_json(spark, path, ["e", "t", "u"], documents=False)
    return rows.select(
        F.col("e.type").alias("e_type"), F.col("e.value").alias("e"), F.col("t.value").alias("t"), F.col("u.value").alias("u"),
        F.col("u.datatype").alias("u_datatype"),
    )


@query("binary_docs_scan", """
    SELECT doc_id, CAST(strlen(doc_id || chr(10) || text) + 1 AS BIGINT) AS length, md5(doc_id || chr(10) || text || chr(10)) AS checksum FROM documents""")
def binary_docs_scan(spark, folder):
    """One file per document, read as blobs. The first line of a file is its id; a line break ends the file.

    The files are read some folders at a time and what is found is kept as a table, so that the driver never lists all files at once.
    """
    docs = table(spark, folder, "documents").repartition("doc_id").select(F.concat("doc_id", F.lit("\n"), "text").alias("value"))
    folders = write_blobs(docs, "value", scratch(spark, "blobs"))
    found = scratch(spark, "found")
    schema = "doc_id long, length long, checksum string"
    spark.createDataFrame([], schema).write.parquet(found)
    for i in range(0, len(folders), SCAN_FOLDERS):
        blobs = read_binary(spark, folders[i:i + SCAN_FOLDERS])
        first = F.substring_index(F.col("content").cast("string"), "\n", 1)
        rows = blobs.select(first.cast("long").alias("doc_id"), "length", F.md5("content").alias("checksum"))
        rows.write.mode("append").parquet(found)
    return spark.read.schema(schema).parquet(found)


ESCAPED = "replace(replace(replace(replace(replace(text, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"'), chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r'), chr(9), chr(92) || 't')"


@query("nquads_sink", f"""
    SELECT '<' || {iri('documents')} || '> <{TEXT}> "' || {ESCAPED} || '"@x-doc .' AS line FROM documents
    UNION ALL SELECT '<' || {iri('documents')} || '> <{BASE}source> "' || source || '" .' FROM documents""")
def nquads_sink(spark, folder):
    """Export of one named graph; the labels in the default graph stay out."""
    path = scratch(spark, "ntriples")
    write_ntriples(document_graph(spark, folder).quads(), path, DOCS)
    return spark.read.text(path).select(F.col("value").alias("line"))


CENTS = "CAST(round(p_retailprice * 100) AS BIGINT)"


def part_solutions(spark, folder):
    """Every column of the parts; prices in whole cents, so that all formats write the same text."""
    part = table(spark, folder, "part").withColumn("p_cents", F.round(F.col("p_retailprice") * 100).cast("long")).drop("p_retailprice")
    g = direct_mapping([Table("part", part, ("p_partkey",))], BASE)
    return bgp(g, [Pattern("?part", prop("part", c), f"?{c[2:]}") for c in ("p_name", "p_size", "p_brand", "p_type", "p_cents")]).select("part", "name", "size", "brand", "type", "cents")


@query("results_csv_sink", f"SELECT {iri('part')} AS part, p_name AS name, p_size AS size, p_brand AS brand, p_type AS type, {CENTS} AS cents FROM part")
def results_csv_sink(spark, folder):
    path = scratch(spark, "csv")
    write_csv(part_solutions(spark, folder), path)
    return read_lines_delimited(spark, path, "part string, name string, size int, brand string, type string, cents long")


@query("results_tsv_sink", f"""
    SELECT '<' || {iri('part')} || '>' || chr(9) || '"' || p_name || '"' || chr(9) || '"' || p_size || '"^^<{XSD_INTEGER}>' || chr(9) || '"' || p_brand || '"'
        || chr(9) || '"' || p_type || '"' || chr(9) || '"' || {CENTS} || '"^^<{XSD_INTEGER}>' AS line FROM part""")
def results_tsv_sink(spark, folder):
    path = scratch(spark, "tsv")
    write_tsv(part_solutions(spark, folder), path)
    return spark.read.text(path).filter(~F.col("value").startswith("?")).select(F.col("value").alias("line"))


@query("results_json_sink", f"""
    SELECT '{{"part":{{"type":"uri","value":"' || {iri('part')} || '"}},"name":{{"type":"literal","value":"' || p_name
        || '"}},"size":{{"type":"literal","value":"' || p_size || '","datatype":"{XSD_INTEGER}"}},"brand":{{"type":"literal","value":"' || p_brand
        || '"}},"type":{{"type":"literal","value":"' || p_type || '"}},"cents":{{"type":"literal","value":"' || {CENTS} || '","datatype":"{XSD_INTEGER}"}}}}' AS line FROM part""")
def results_json_sink(spark, folder):
    path = scratch(spark, "json")
    write_json(part_solutions(spark, folder), path)
    return spark.read.text(path + "/bindings").select(F.col("value").alias("line"))


SUPPLIER_ROWS = f"""
    SELECT {iri('supplier')} AS s, '{RDF_TYPE}' AS p, '{BASE}supplier' AS o_value FROM supplier
    UNION ALL SELECT {iri('supplier')}, '{prop('supplier', 's_suppkey')}', CAST(s_suppkey AS VARCHAR) FROM supplier
    UNION ALL SELECT {iri('supplier')}, '{prop('supplier', 's_name')}', s_name FROM supplier"""


def supplier_store(spark, folder):
    return store_of(spark, graph(spark, folder, "supplier", "nation").quads().filter(F.col("s").startswith(BASE + "supplier/")))


STORED_SUPPLIERS = SUPPLIER_ROWS + f"""
    UNION ALL SELECT {iri('supplier')}, '{prop('supplier', 's_nationkey')}', CAST(s_nationkey AS VARCHAR) FROM supplier
    UNION ALL SELECT {iri('supplier')}, '{link('supplier', 's_nationkey')}', {iri('nation', 's_nationkey')} FROM supplier
    UNION ALL SELECT {iri('supplier')}, '{prop('supplier', 's_acctbal')}', CAST(s_acctbal AS VARCHAR) FROM supplier
    UNION ALL SELECT 'prefix', n_name, '{BASE}' || n_nationkey FROM nation"""


def copied(store, folder) -> DataFrame:
    """Quads of a store and its prefixes; doubles are shown as SQL writes them."""
    quads = store.quads().select("s", "p", F.when(F.col("p") == prop("supplier", "s_acctbal"), F.col("o_value").cast("double").cast("string")).otherwise(F.col("o_value")).alias("o_value"))
    return quads.unionByName(store.prefixes().select(F.lit("prefix").alias("s"), F.col("prefix").alias("p"), F.col("iri").alias("o_value")))


def prefixed_store(spark, folder):
    store = supplier_store(spark, folder)
    store.set_prefixes(table(spark, folder, "nation").select(F.col("n_name").alias("prefix"), F.concat(F.lit(BASE), "n_nationkey").alias("iri")))
    return store


@query("graph_snapshot", STORED_SUPPLIERS)
def graph_snapshot(spark, folder):
    to = scratch(spark, "snapshot")
    prefixed_store(spark, folder).snapshot(to)
    return copied(restore(spark, to, scratch(spark, "store")), folder)


@query("graph_restore", STORED_SUPPLIERS)
def graph_restore(spark, folder):
    """To another name, then once more over the changed copy with force."""
    to = scratch(spark, "snapshot")
    prefixed_store(spark, folder).snapshot(to)
    copy = restore(spark, to, scratch(spark, "store"))
    copy.begin().clear().commit()
    return copied(restore(spark, to, copy.root, force=True), folder)

