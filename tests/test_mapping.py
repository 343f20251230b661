import pytest
from pyspark.sql import functions as F

from conftest import rows
from fixtures import music_tables
from quadrille.functions.iri import Template
from quadrille.functions.terms import iso_datetime
from quadrille.model import DEFAULT_GRAPH, RDF_TYPE, XSD_DATE, XSD_DATETIME, Lit, Val
from quadrille.operators.caches import materialize, virtual_view
from quadrille.operators.graph import Pattern, StoredGraph, UnionGraph
from quadrille.operators.mapping import Col, MappedGraph, Mapping, Rule, Table, direct_mapping
from quadrille.operators.patterns import bgp
from quadrille.operators.store import GraphStore
from quadrille.session import scratch

M = "http://example.org/music/"


def music_graph(spark):
    t = music_tables(spark)
    album, artist, song = (Template(M + k) for k in ("Album{id}", "Artist{id}", "Song{id}"))
    return MappedGraph([
        Mapping(t["Album"], (
            Rule(album, RDF_TYPE, M + "Album"), Rule(album, M + "name", Col("name")),
            Rule(album, M + "artist", Template(M + "Artist{artist}")), Rule(album, M + "date", Col("release_date")),
        ), unique=True),
        Mapping(t["Artist"], (Rule(artist, M + "name", Col("name")), Rule(artist, M + "description", Col("description"))), unique=True),
        Mapping(t["Artist"].filter("type = 1"), (Rule(artist, RDF_TYPE, M + "SoloArtist"),), unique=True),
        Mapping(t["Artist"].filter("type = 2"), (Rule(artist, RDF_TYPE, M + "Band"),), unique=True),
        Mapping(t["Membership"], (Rule(Template(M + "Artist{band}"), M + "member", Template(M + "Artist{artist}")),)),
        Mapping(t["Track"], (
            Rule(song, RDF_TYPE, M + "Song"), Rule(song, M + "name", Col("name")), Rule(song, M + "length", Col("length")),
            Rule(Template(M + "Album{album}"), M + "track", song),
        )),
        Mapping(t["Songwriter"], (Rule(Template(M + "Song{song}"), M + "writer", Template(M + "Artist{writer}")),)),
    ])


def music_direct(spark):
    t = music_tables(spark)
    return direct_mapping([
        Table("Artist", t["Artist"], ("id",)),
        Table("Album", t["Album"], ("id",), {"artist": ("Artist", "id")}),
        Table("Membership", t["Membership"], (), {"artist": ("Artist", "id"), "band": ("Artist", "id")}),
        Table("Track", t["Track"], ("id",), {"album": ("Album", "id")}),
        Table("Songwriter", t["Songwriter"], (), {"song": ("Track", "id"), "writer": ("Artist", "id")}),
    ], M)


def test_custom_mapping_gives_37_triples(spark):
    quads = music_graph(spark).quads()
    assert quads.count() == 37
    assert quads.filter(F.col("p") == M + "date").first()["o_datatype"] == XSD_DATE


def test_direct_mapping_gives_79_triples(spark):
    g = music_direct(spark)
    assert g.quads().count() == 79
    assert bgp(g, [Pattern(M + "Artist/id=1", "?p", "?o")]).count() == 5


def test_direct_mapping_of_one_hundred_rows_gives_800(spark):
    t = spark.range(100).select(
        F.col("id").cast("int").alias("user_id"), *[F.concat(F.lit(c), F.col("id")).alias(c) for c in ("username", "first_name", "last_name", "gender", "password")],
        F.lit(1).cast("byte").alias("status"),
    )
    assert direct_mapping([Table("user_details", t, ("user_id",))], M).quads().count() == 800


@pytest.mark.parametrize("make", [music_graph, music_direct])
def test_every_pattern_agrees_with_the_stored_quads(spark, make):
    g = make(spark)
    stored = StoredGraph(g.quads().cache())
    preds = [r[0] for r in stored.quads().select("p").distinct().collect()]
    for p in preds:
        a, b = bgp(g, [Pattern("?s", p, "?o")]), bgp(stored, [Pattern("?s", p, "?o")])
        assert rows(a, "s", "o") == rows(b, "s", "o")
    for one in (Pattern("?s", "?p", "?o"), Pattern(M + "Artist5", "?p", "?o"), Pattern("?s", "?p", M + "Artist1"), Pattern("?s", "?p", Lit("McCartney")),
                Pattern("?s", RDF_TYPE, M + "Album"), Pattern("?s", "?p", M + "Artist/id=5"), Pattern(M + "Artist/id=x", "?p", "?o")):
        a, b = bgp(g, [one]), bgp(stored, [one])
        assert rows(a, *b.columns) == rows(b, *b.columns), one
    assert a.count() == 0


def test_star_is_one_scan(spark):
    g = music_graph(spark)
    found = bgp(g, [Pattern("?a", RDF_TYPE, M + "Album"), Pattern("?a", M + "name", Val("?n", "string")), Pattern("?a", M + "date", Val("?d", "date"))])
    assert found.count() == 3
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()


def test_null_makes_no_triple(spark):
    t = spark.createDataFrame([(1, None, 2), (2, "x", None)], "id int, name string, ref int")
    g = direct_mapping([Table("T", t, ("id",), {"ref": ("T", "id")})], M)
    assert g.quads().count() == (1 + 2 + 1) + (1 + 2)
    assert bgp(g, [Pattern("?s", M + "T#name", "?o")]).count() == 1


def test_templates_encode(spark):
    t = spark.createDataFrame([("a b/ü*~&",), ("plain",)], "id string")
    g = MappedGraph([Mapping(t, (Rule(Template(M + "{id}"), RDF_TYPE, M + "C"),), unique=True)])
    assert rows(bgp(g, [Pattern("?s", RDF_TYPE, M + "C")]), "s") == [(M + "a%20b%2Fü%2A~%26",), (M + "plain",)]
    assert bgp(g, [Pattern(M + "a%20b%2Fü%2A~%26", RDF_TYPE, "?c")]).count() == 1
    assert bgp(g, [Pattern(M + "plain", RDF_TYPE, "?c")]).count() == 1


def test_json_block_gives_16_triples(spark, tmp_path):
    from quadrille.sources.tables import read_json

    path = str(tmp_path / "block.json")
    with open(path, "w") as f:
        f.write('{\n "hash": "00ae", "time": 1569266867591, "block_index": 1762564, "height": 575144,\n "txIndexes": [445123952, 445058113, 445054577, 445061250]}')
    raw = read_json(spark, path, "hash string, time long, block_index long, height long, txIndexes array<long>", documents=True)
    block, tx = Template(M + "block/{hash}"), Template(M + "tx/{txIndex}")
    blocks = raw.withColumn("at", F.timestamp_millis("time"))
    txs = raw.select("hash", F.explode("txIndexes").alias("txIndex"))
    g = MappedGraph([
        Mapping(blocks, (Rule(block, RDF_TYPE, M + "Block"), Rule(block, M + "hash", Col("hash")), Rule(block, M + "time", Col("at")), Rule(block, M + "height", Col("height")))),
        Mapping(txs, (Rule(block, M + "includesTx", tx), Rule(tx, RDF_TYPE, M + "Tx"), Rule(tx, M + "index", Col("txIndex")))),
    ])
    assert g.quads().count() == 16
    time = g.quads().filter(F.col("p") == M + "time").first()
    assert (time["o_value"], time["o_datatype"]) == ("2019-09-23T19:27:47.591Z", XSD_DATETIME)
    assert bgp(g, [Pattern("?s", M + "time", Val("?t", "timestamp"))]).count() == 1


def test_iso_text(spark):
    df = spark.sql("select timestamp'2012-12-31 23:57:00' t").select(iso_datetime(F.col("t")))
    assert df.first()[0] == "2012-12-31T23:57:00Z"


def test_materialize_append_and_replace(spark):
    store = GraphStore.create(spark, scratch(spark))
    g = music_graph(spark)
    assert materialize(store.begin(), g, "urn:music").commit() == {"added": 37, "removed": 0}
    assert materialize(store.begin(), g, "urn:music").commit() == {"added": 0, "removed": 0}
    small = MappedGraph([g.mappings[1]])
    assert materialize(store.begin(), small, "urn:music", remove_all=True).commit() == {"added": 0, "removed": 27}


def test_virtual_graph_joins_stored_triples(spark):
    from quadrille.model import quads

    stored = StoredGraph(quads(spark, [(M + "Artist1", "urn:likes", M + "Artist2")]))
    g = UnionGraph(stored, music_graph(spark), disjoint=True)
    found = bgp(g, [Pattern("?x", "urn:likes", "?y"), Pattern("?y", M + "name", Val("?n", "string"))])
    assert rows(found, "n") == [("Paul McCartney",)]
    virtual_view(music_graph(spark), "music_view")
    assert spark.sql("select count(*) from music_view").first()[0] == 37
    assert DEFAULT_GRAPH


def test_joins_use_bare_keys(spark):
    """Tables joined through templates of one column join on that column; the IRI is made afterwards."""
    g = music_direct(spark)
    found = bgp(g, [Pattern("?a", M + "Album#ref-artist", "?x"), Pattern("?x", M + "Artist#name", Val("?n", "string"))])
    assert rows(found, "a", "x", "n")[0] == (M + "Album/id=1", M + "Artist/id=5", "The Beatles")
    plan = found.select("n")._jdf.queryExecution().optimizedPlan().toString()
    assert "concat" not in plan and "Join" in plan
    stored = StoredGraph(g.quads())
    assert rows(bgp(stored, [Pattern("?a", M + "Album#ref-artist", "?x"), Pattern("?x", M + "Artist#name", Val("?n", "string"))]), "a", "x", "n") == rows(found, "a", "x", "n")
    # a key that is text on one side and a number on the other still joins, as IRIs
    t = spark.createDataFrame([("5",), ("x",)], "k string")
    mixed = MappedGraph([*g.mappings, Mapping(t, (Rule(Template("urn:t{k}"), "urn:of", Template(M + "Artist/id={k}")),), unique=True)])
    got = bgp(mixed, [Pattern("?t", "urn:of", "?x"), Pattern("?x", M + "Artist#name", Val("?n", "string"))])
    assert rows(got, "t", "x", "n") == [("urn:t5", M + "Artist/id=5", "The Beatles")]
    same = bgp(mixed, [Pattern("?x", "?p", "?x")])
    assert same.count() == 0


def test_numbers_match_by_their_text(spark):
    """Only the text a number is written with matches, at any size."""
    from quadrille.model import XSD_INTEGER

    t = spark.createDataFrame([(0, 7), (-5, 8), (9223372036854775807, 9)], "id long, v long")
    g = MappedGraph([Mapping(t, (Rule(Template(M + "n{id}"), "urn:v", Col("v")), Rule(Template(M + "n{id}"), "urn:id", Col("id"))), unique=True)])
    for text, n in (("0", 1), ("-0", 0), ("00", 0), ("-5", 1), ("9223372036854775807", 1), ("9999999999999999999", 0), ("99999999999999999999999", 0), ("", 0)):
        assert bgp(g, [Pattern(M + "n" + text, "urn:v", "?v")]).count() == n, text
        assert bgp(g, [Pattern("?s", "urn:id", Lit(text, XSD_INTEGER))]).count() == n, text


def test_repeated_rows_of_a_table_without_a_key_are_nodes_each(spark):
    from quadrille.operators import mapping

    rows_ = [(1, "a"), (1, "a"), (1, "a"), (2, None), (2, None), (3, "c")]
    df = spark.createDataFrame(rows_, "k int, v string")
    for step in (mapping.NUMBERED, 2, 1):
        before, mapping.NUMBERED = mapping.NUMBERED, step
        try:
            g = direct_mapping([Table("T", df.repartition(3))], "urn:")
            quads_ = g.quads()
        finally:
            mapping.NUMBERED = before
        assert quads_.count() == quads_.distinct().count() == 6 + 6 + 4  # types, keys, values that are not null
        assert quads_.select("s").distinct().count() == 6
        again = direct_mapping([Table("T", df.repartition(5))], "urn:").quads()
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, quads_.collect()))
