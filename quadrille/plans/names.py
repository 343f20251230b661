"""Queries on prefixes, IRIs, strict conversions and answer logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.checks import ACTION_QUERY, first_action, is_uuid, parse_bool_strict
from ..functions.iri import Template, compact, expand, local_name, merge_prefixes, read_prefixes, resolve
from ..model import Val
from ..operators.graph import Pattern
from ..operators.mapping import Col, MappedGraph, Mapping, Rule
from ..operators.patterns import bgp
from .base import BASE, query, table


def nation_prefixes(spark, folder):
    """A prefix per nation, and the empty prefix."""
    rows = table(spark, folder, "nation").select(F.col("n_name").alias("prefix"), F.concat(F.lit("http://example.org/n/"), "n_nationkey", F.lit("/")).alias("iri"))
    return rows.unionByName(spark.createDataFrame([("", BASE)], "prefix string, iri string"))


@query("prefix_expand", f"""
    WITH names AS (SELECT 'NATION_' || (c_nationkey + CASE c_mktsegment WHEN 'BUILDING' THEN 20 ELSE 0 END) AS prefix, c_name FROM customer)
    SELECT prefix || ':' || c_name AS name, CASE WHEN n_nationkey IS NOT NULL THEN 'http://example.org/n/' || n_nationkey || '/' || c_name END AS iri
    FROM names LEFT JOIN nation ON prefix = n_name
    UNION ALL SELECT ':' || p_partkey, '{BASE}' || p_partkey FROM part""")
def prefix_expand(spark, folder):
    """Prefixed names of customers and parts to IRIs; a prefix that is not in the table gives NULL."""
    nation = F.col("c_nationkey") + F.when(F.col("c_mktsegment") == "BUILDING", 20).otherwise(0)
    customers = table(spark, folder, "customer").select(F.concat(F.lit("NATION_"), nation, F.lit(":"), "c_name").alias("name"))
    parts = table(spark, folder, "part").select(F.concat(F.lit(":"), "p_partkey").alias("name"))
    return expand(customers.unionByName(parts), "name", nation_prefixes(spark, folder))


HOST = "regexp_extract(url, '^[a-z]+://[^/]+/')"
DIRECTORY = "regexp_extract(url, '^[a-z]+://[^/]+/[^/?#]+/')"


@query("iri_compact", f"""
    WITH ns AS (SELECT DISTINCT {HOST} AS iri FROM pages UNION SELECT {DIRECTORY} FROM pages WHERE contains(url, 'example.org') AND {DIRECTORY} <> ''),
    hit AS (SELECT page_id, max(length(iri)) AS n FROM pages JOIN ns ON starts_with(url, iri) GROUP BY page_id)
    SELECT p.page_id AS page_id, 'p' || md5(substr(url, 1, n)) || ':' || substr(url, n + 1) AS name FROM pages p JOIN hit h ON p.page_id = h.page_id""")
def iri_compact(spark, folder):
    """Page addresses by their longest namespace: the host, or for some hosts the first directory."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    hosts = pages.select(F.regexp_extract("url", "^[a-z]+://[^/]+/", 0).alias("iri"))
    directories = pages.filter(F.col("url").contains("example.org")).select(F.regexp_extract("url", "^[a-z]+://[^/]+/[^/?#]+/", 0).alias("iri"))
    spaces = hosts.unionByName(directories).filter("iri <> ''").distinct()
    prefixes = spaces.select(F.concat(F.lit("p"), F.md5("iri")).alias("prefix"), "iri")
    return compact(pages, "url", prefixes).select("page_id", "name")


@query("prefix_import", """
    WITH new AS (SELECT 'b' || item_id AS prefix, 'http://example.org/item/' || item_id || '/' AS iri FROM benchmark
        UNION ALL SELECT n_name, 'http://example.org/new/' || n_name || '#' FROM nation
        UNION ALL SELECT 'x' || p_partkey, 'http://example.org/x/' || p_partkey || '#' FROM part)
    SELECT prefix, iri FROM new
    UNION ALL SELECT n_name, 'http://example.org/n/' || n_nationkey || '/' FROM nation WHERE n_name NOT IN (SELECT prefix FROM new)
    UNION ALL SELECT 'c' || c_custkey, 'http://example.org/c/' || c_custkey || '/' FROM customer
    UNION ALL SELECT '', 'http://example.org/data/'""")
def prefix_import(spark, folder):
    """Declarations in Turtle and RDF/XML text that holds much else; names in the table already are replaced, and the others stay."""
    items = table(spark, folder, "benchmark").select(
        F.format_string("# %s\n@prefix b%s: <http://example.org/item/%s/> .\n<a> <b> <c> .", F.translate("text", "\n\r", "  "), "item_id", "item_id").alias("value"))
    nations = table(spark, folder, "nation").select(
        F.format_string("PREFIX %s: <http://example.org/new/%s#>\n", "n_name", "n_name").alias("value"))
    parts = table(spark, folder, "part").select(
        F.format_string('<rdf:RDF xmlns:x%s="http://example.org/x/%s#">\n<a:b>%s</a:b></rdf:RDF>', "p_partkey", "p_partkey", "p_name").alias("value"))
    customers = table(spark, folder, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("prefix"), F.format_string("http://example.org/c/%s/", "c_custkey").alias("iri"))
    return merge_prefixes(nation_prefixes(spark, folder).unionByName(customers), read_prefixes(items.unionByName(nations).unionByName(parts)))


@query("iri_resolve", r"""
    WITH refs AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?:href|src)="([^"]*)"', 1)) AS ref FROM pages),
    parts AS (SELECT *, regexp_extract(url, '^([a-z]+:)', 1) AS scheme, regexp_extract(url, '^[a-z]+:(//[^/?#]*)', 1) AS host,
        regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '^[^?#]*(\?[^#]*)', 1) AS query FROM refs)
    SELECT page_id, ref, CASE
        WHEN regexp_matches(ref, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN ref WHEN starts_with(ref, '//') THEN scheme || ref
        WHEN starts_with(ref, '/') THEN scheme || host || ref WHEN starts_with(ref, '?') THEN scheme || host || path || ref
        WHEN starts_with(ref, '#') THEN scheme || host || path || query || ref WHEN ref = '' THEN scheme || host || path || query
        ELSE scheme || host || CASE WHEN regexp_extract(path, '^.*/') = '' THEN '/' ELSE regexp_extract(path, '^.*/') END || ref END AS target FROM parts""")
def iri_resolve(spark, folder):
    """References in whole pages against the address of the page."""
    pages = table(spark, folder, "pages")
    refs = pages.select("page_id", "url", F.explode(F.regexp_extract_all("html", F.lit('(?:href|src)="([^"]*)"'), F.lit(1))).alias("ref"))
    return refs.select("page_id", "ref", resolve(F.col("ref"), F.col("url")).alias("target"))


@query("local_name", "SELECT page_id, regexp_extract(url, '[^/#]*$') AS name FROM pages")
def local_name_query(spark, folder):
    return table(spark, folder, "pages").select("page_id", local_name(F.col("url")).alias("name"))


@query("unicode_terms", f"SELECT '{BASE}text/' || lang || '/ä' || doc_id AS s, text FROM documents")
def unicode_terms(spark, folder):
    """Non-ASCII subjects and whole texts come back unchanged."""
    docs = table(spark, folder, "documents").select("lang", F.concat(F.lit("ä"), "doc_id").alias("id"), "text")
    g = MappedGraph([Mapping(docs, (Rule(Template(BASE + "text/{lang}/{id}"), BASE + "text", Col("text")),), unique=True)])
    return bgp(g, [Pattern("?s", BASE + "text", Val("?text", "string"))])


@query("parse_bool_strict", "SELECT doc_id, quality = 1 AS good, toxic = 1 AS bad FROM labels")
def parse_bool(spark, folder):
    labels = table(spark, folder, "labels")
    good = F.when(F.col("quality") == 1, F.element_at(F.array(*map(F.lit, ["y", "True", "on"])), (F.col("doc_id") % 3 + 1).cast("int"))).otherwise("off")
    bad = F.when(F.col("toxic") == 1, "yes").otherwise(F.element_at(F.array(*map(F.lit, ["n", "False", "f"])), (F.col("doc_id") % 3 + 1).cast("int")))
    return labels.select("doc_id", parse_bool_strict(good).alias("good"), parse_bool_strict(bad).alias("bad"))


@query("action_extract", "SELECT conv_id, turn, CASE WHEN role = 'user' THEN text END AS question, 'turn ' || turn AS query FROM conversations")
def action_extract(spark, folder):
    """Logs of actions as JSON, one per message with its whole text; the first action of a kind is taken."""
    def action(kind, value):
        return F.struct(kind.alias("type"), F.lit("label").alias("label"), value.alias("value"))

    role, turn = F.col("role"), F.col("turn").cast("string")
    actions = F.array(
        action(role, F.col("text")), action(F.lit(ACTION_QUERY), F.concat(F.lit("turn "), turn)),
        action(F.lit(ACTION_QUERY), F.lit("a later one")),
    )
    logs = table(spark, folder, "conversations").select("conv_id", "turn", F.to_json(actions).alias("actions"))
    return logs.select("conv_id", "turn", first_action(F.col("actions"), "user").alias("question"), first_action(F.col("actions"), ACTION_QUERY).alias("query"))


@query("uuid_check", """
    SELECT conv_id, turn, CASE WHEN role = 'user' THEN regexp_replace(md5(text), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') ELSE role || '-' || md5(text) END AS id,
        role = 'user' AS valid FROM conversations""")
def uuid_check(spark, folder):
    hash_ = F.md5("text")
    uuid = F.concat_ws("-", *[F.substring(hash_, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    ids = F.when(F.col("role") == "user", uuid).otherwise(F.concat_ws("-", "role", hash_))
    return table(spark, folder, "conversations").select("conv_id", "turn", ids.alias("id")).withColumn("valid", is_uuid(F.col("id")))

