"""Queries on aggregation, windows, sorting and limits."""

from __future__ import annotations



from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import RDF_TYPE, Lit, Val
from ..operators.graph import Pattern
from ..operators.nested import group_concat
from ..operators.patterns import bgp, page
from ..operators.patterns import topk as first_rows
from ..operators.shapes import Shape, Validation, limit_per_shape, report_violations
from ..sources.tables import Sources
from .base import BASE, KEYS, graph, iri, link, prop, query, store_of, table

PRICE = prop("orders", "o_totalprice")
CUSTOMER = link("orders", "o_custkey")


def exact(col: str):
    """Money adds up exactly, in any order of rows."""
    return F.sum(F.col(col).cast("decimal(18,2)")).cast("double")


@query("count_agg", f"""
    SELECT '{BASE}customer' AS cls, count(*) AS n FROM customer UNION ALL SELECT '{BASE}orders', count(*) FROM orders
    UNION ALL SELECT '{BASE}part', count(*) FROM part""")
def count_agg(spark, folder):
    """Instances per class. One class may hold most of them; counting combines on the map side."""
    g = graph(spark, folder, "customer", "orders", "part")
    return bgp(g, [Pattern("?s", RDF_TYPE, "?c")]).groupBy(F.col("c.value").alias("cls")).agg(F.count("*").alias("n"))


@query("sum_agg", "SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders WHERE o_orderpriority = '1-URGENT'")
def sum_agg(spark, folder):
    found = bgp(graph(spark, folder, "orders"), [Pattern("?o", PRICE, Val("?price")), Pattern("?o", prop("orders", "o_orderpriority"), Lit("1-URGENT"))])
    return found.agg(exact("price").alias("revenue"))


@query("avg_group_by", """
    SELECT n_name AS nation, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_price
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def avg_group_by(spark, folder):
    """Average order total per nation name."""
    found = bgp(graph(spark, folder, "nation", "customer", "orders"), [
        Pattern("?o", CUSTOMER, "?c"), Pattern("?o", PRICE, Val("?price")), Pattern("?c", link("customer", "c_nationkey"), "?n"),
        Pattern("?n", prop("nation", "n_name"), Val("?nation", "string")),
    ])
    return found.groupBy("nation").agg((exact("price") / F.count("*")).alias("avg_price"))


@query("minmax_group_concat", """
    SELECT n_name AS nation, min(c_acctbal) AS lowest, max(c_acctbal) AS highest, string_agg(DISTINCT c_mktsegment, '|' ORDER BY c_mktsegment) AS segments
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def minmax_group_concat(spark, folder):
    """Equal segments are merged before any text is put together, so a large nation costs no more than a small one."""
    found = bgp(graph(spark, folder, "nation", "customer"), [
        Pattern("?c", prop("customer", "c_acctbal"), Val("?bal")), Pattern("?c", prop("customer", "c_mktsegment"), Val("?seg", "string")),
        Pattern("?c", link("customer", "c_nationkey"), "?n"), Pattern("?n", prop("nation", "n_name"), Val("?nation", "string")),
    ])
    ends = found.groupBy("nation").agg(F.min("bal").alias("lowest"), F.max("bal").alias("highest"))
    names = group_concat(found, ["nation"], "seg", "|", "segments", distinct=True)
    return ends.join(names, "nation").select("nation", "lowest", "highest", "segments")


@query("having_filter", "SELECT user_id AS user, count(*) AS n FROM events GROUP BY user_id HAVING count(*) > 70")
def having_filter(spark, folder):
    found = bgp(graph(spark, folder, "events"), [Pattern("?e", prop("events", "user_id"), Val("?user", "long"))])
    return found.groupBy("user").agg(F.count("*").alias("n")).filter("n > 70")


@query("count_distinct_agg", "SELECT o_orderpriority AS priority, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY o_orderpriority")
def count_distinct_agg(spark, folder):
    found = bgp(graph(spark, folder, "orders"), [Pattern("?o", CUSTOMER, "?c"), Pattern("?o", prop("orders", "o_orderpriority"), Val("?priority", "string"))])
    return found.groupBy("priority").agg(F.count_distinct("c").alias("customers"))


@query("graph_size_exact", """
    SELECT CAST((SELECT count(*) FROM orders) * 8 + (SELECT count(*) FROM customer) * 7 + (SELECT count(*) FROM nation) * 5 + (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderpriority, o_orderstatus FROM orders)) AS BIGINT) AS n""")
def graph_size_exact(spark, folder):
    """All graphs: mapped tables and the named graphs by status."""
    from .base import status_graphs

    g = graph(spark, folder, "orders", "customer", "nation")
    return g.quads().unionByName(status_graphs(spark, folder)).agg(F.count("*").alias("n"))


@query("graph_size_estimate", "SELECT CAST(count(*) * 4 - sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n FROM orders")
def graph_size_estimate(spark, folder):
    """A stored graph after a removal: row counts of base and delta files, without reading a row."""
    g = graph(spark, folder, "orders", columns={"orders": ["o_custkey", "o_orderstatus"]})
    store = store_of(spark, g.quads())
    batch = store.begin()
    done = bgp(batch.graph(), [Pattern("?o", prop("orders", "o_orderstatus"), Lit("F"))])
    batch.delete_where(done, [Pattern("?o", prop("orders", "o_orderstatus"), Lit("F"))]).commit()
    return store.size_estimate()


@query("predicate_estimates", f"""
    SELECT '{prop('lineitem', 'l_partkey')}' AS p, count(*) AS quads, true AS subjects_close, true AS objects_close FROM lineitem
    UNION ALL SELECT '{prop('lineitem', 'l_shipdate')}', count(*), true, true FROM lineitem
    UNION ALL SELECT '{prop('lineitem', 'l_quantity')}', count(*), true, true FROM lineitem""")
def predicate_estimates(spark, folder):
    """Per predicate of a stored graph: quads, and different subjects and objects from sketches of base and delta, within 5 % of the exact numbers."""
    columns = ["l_partkey", "l_shipdate", "l_quantity"]
    data = graph(spark, folder, "lineitem", columns={"lineitem": columns}).quads().filter(F.col("p") != RDF_TYPE).filter(~F.col("p").contains("#ref-"))
    store = store_of(spark, data.filter(F.col("p") != prop("lineitem", "l_quantity")))
    store.analyze()
    store.begin().add(data).commit()
    # Texts are told apart by 128 bits, which are moved instead of them.
    exact = store.quads().groupBy("p").agg(*[F.count_distinct(F.unhex(F.md5(c))).alias(n) for c, n in (("s", "s"), ("o_value", "o"))])
    met = store.estimates().join(exact, "p")

    def close(estimate, number):
        return (F.abs(F.col(estimate) - F.col(number)) <= 0.05 * F.col(number)).alias(f"{estimate}_close")

    return met.select("p", "quads", close("subjects", "s"), close("objects", "o"))


@query("table_row_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in KEYS))
def table_row_counts(spark, folder):
    sources = Sources()
    for name in KEYS:
        sources.register(name, table(spark, folder, name))
    return sources.row_counts()


@query("month_histogram", "SELECT strftime(o_orderdate, '%m') AS month, count(*) AS n FROM orders GROUP BY 1")
def month_histogram(spark, folder):
    found = bgp(graph(spark, folder, "orders"), [Pattern("?o", prop("orders", "o_orderdate"), Val("?d", "timestamp"))])
    return found.groupBy(F.lpad(F.month("d").cast("string"), 2, "0").alias("month")).agg(F.count("*").alias("n"))


def order_shapes() -> list[Shape]:
    return [
        Shape("status", "in", prop("orders", "o_orderstatus"), [Lit("F"), Lit("O")]),
        Shape("priority", "pattern", prop("orders", "o_orderpriority"), "^[1-3]"),
        Shape("segment", "in", prop("customer", "c_mktsegment"), [Lit("BUILDING"), Lit("MACHINERY"), Lit("HOUSEHOLD")]),
    ]


ORDER_VIOLATIONS = f"""
    SELECT 'status' AS shape, {iri('orders')} AS focus, '{prop('orders', 'o_orderstatus')}' AS path, o_orderstatus AS value, 'in' AS kind
        FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
    UNION ALL SELECT 'priority', {iri('orders')}, '{prop('orders', 'o_orderpriority')}', o_orderpriority, 'pattern' FROM orders WHERE NOT regexp_matches(o_orderpriority, '^[1-3]')
    UNION ALL SELECT 'segment', {iri('customer')}, '{prop('customer', 'c_mktsegment')}', c_mktsegment, 'in' FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')"""


@query("violation_limit_per_shape", f"""
    SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY shape ORDER BY focus, path, value, kind) AS n FROM ({ORDER_VIOLATIONS})) WHERE n <= 5""")
def violation_limit_per_shape(spark, folder):
    found = Validation(graph(spark, folder, "orders", "customer"), order_shapes()).violations()
    return limit_per_shape(found, 5)


@query("report_count_limit", f"SELECT * FROM ({ORDER_VIOLATIONS}) ORDER BY shape, focus, path, value, kind LIMIT 20")
def report_count_limit(spark, folder):
    return report_violations(graph(spark, folder, "orders", "customer"), order_shapes(), countLimit=20)


def priced(spark, folder) -> DataFrame:
    return bgp(graph(spark, folder, "orders"), [Pattern("?o", PRICE, Val("?price"))])


@query("order_by_desc", f"SELECT {iri('orders')} AS o, o_totalprice AS price FROM orders ORDER BY price DESC, o")
def order_by_desc(spark, folder):
    return page(priced(spark, folder), [F.desc("price"), "o"])


@query("limit_offset", f"SELECT {iri('orders')} AS o, o_totalprice AS price FROM orders ORDER BY price DESC, o LIMIT 50 OFFSET 25")
def limit_offset(spark, folder):
    return page(priced(spark, folder), [F.desc("price"), "o"], limit=50, offset=25)


@query("topk", f"SELECT {iri('orders')} AS o, o_totalprice AS price FROM orders ORDER BY price DESC, o LIMIT 10")
def topk(spark, folder):
    return first_rows(priced(spark, folder), [F.desc("price"), "o"], 10)



