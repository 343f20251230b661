import bz2
import gzip

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from fixtures import SW
from quadrille.functions.checks import first_action, is_uuid, parse_bool_strict
from quadrille.functions.iri import compact, expand, local_name, merge_prefixes, read_prefixes, resolve
from quadrille.functions.terms import decode_term
from quadrille.model import DEFAULT_GRAPH, QUAD, XSD_INTEGER, Lit, quads
from quadrille.session import join_lookup, scratch
from quadrille.sinks import blobs
from quadrille.sinks.graphs import write_nquads, write_ntriples
from quadrille.sinks.results import csv_rows, json_bindings, write_csv, write_json, write_tsv
from quadrille.sources.lines import parse_lines, read_corrupt, read_nquads
from quadrille.sources.rdfxml import read_rdfxml_flat
from quadrille.sources.results import read_bindings_json, read_results_json
from quadrille.sources.tables import Sources, read_binary, read_delimited, read_jdbc, read_json, read_lines_delimited

LINES = [
    "<urn:s> <urn:p> <urn:o> .",
    "<urn:s>\t<urn:p>   \"text\" <urn:g> . # with <urn:comment>",
    "<urn:s> <urn:p> \"# . \\\"quoted\\\" \\\\n\\n\"@en-GB .",
    "<urn:s> <urn:p> \"5\"^^<http://www.w3.org/2001/XMLSchema#integer> <urn:g> .",
    "<urn:s> <urn:p> \"5\"^^<http://www.w3.org/2001/XMLSchema#string>.",
    "_:a <urn:p> _:b.c .",
    "<urn:\\u00FC> <urn:p> \"\\U0001F600 \\u00e9 \\'\" _:g .",
    "# comment",
    "   ",
    "<urn:s> <urn:p> <urn:o> . # see <urn:x> _:y \"z\"",
    "<urn:s> <urn:p> .",
    "<urn:s> \"p\" <urn:o> .",
    "<urn:s> <urn:p> \"bad \\q escape\" .",
    "<urn:s> <urn:p> \"open .",
    "not a statement",
    "<urn:s> <urn:p> \"half a pair \\uD83D\" .",
    "<urn:s> <urn:p> \"\\u005Cn \\\\u0041 \x01\\b\\f \\u0022\" .",
]


def test_lines(spark):
    df = spark.createDataFrame([(x,) for x in LINES], "value string")
    good, bad = parse_lines(df)
    assert bad.count() == 6
    got = [tuple(r) for r in good.collect()]
    g0 = DEFAULT_GRAPH
    assert got == [
        ("urn:s", "urn:p", "urn:o", "uri", "", "", g0),
        ("urn:s", "urn:p", "text", "literal", "", "", "urn:g"),
        ("urn:s", "urn:p", '# . "quoted" \\n\n', "literal", "", "en-GB", g0),
        ("urn:s", "urn:p", "5", "literal", XSD_INTEGER, "", "urn:g"),
        ("urn:s", "urn:p", "5", "literal", "", "", g0),
        ("_:a", "urn:p", "_:b.c", "bnode", "", "", g0),
        ("urn:ü", "urn:p", "😀 é '", "literal", "", "", "_:g"),
        ("urn:s", "urn:p", "urn:o", "uri", "", "", g0),
        ("urn:s", "urn:p", '\\n \\u0041 \x01\b\f "', "literal", "", "", g0),
    ]


def test_long_literals_need_no_deep_stack(spark):
    text = "<urn:s> <urn:p> \"" + "ab\\n\\\\ü" * 200_000 + "\" ."
    good, bad = parse_lines(spark.createDataFrame([(text,)], "value string"))
    assert good.first()["o_value"] == "ab\n\\ü" * 200_000 and bad.count() == 0


def test_compressed_files_and_corrupt_lines(spark, tmp_path):
    with gzip.open(tmp_path / "a.nt.gz", "wt") as f:
        f.write(LINES[0] + "\nbroken\n")
    with bz2.open(tmp_path / "b.nt.bz2", "wt") as f:
        f.write(LINES[1] + "\n")
    assert read_nquads(spark, str(tmp_path), "urn:mine", skip_bad_lines=True).count() == 2
    with pytest.raises(Exception, match="no statement: broken"):
        read_nquads(spark, str(tmp_path)).count()
    assert rows(read_corrupt(spark, str(tmp_path)), "value") == [("broken",)]


def test_export_and_load_give_the_same(spark, starwars):
    path = scratch(spark)
    write_nquads(starwars, path, compression="gzip")
    assert rows(read_nquads(spark, path), *QUAD) == rows(starwars, *QUAD)


def test_every_character_survives(spark):
    chars = [chr(i) for i in [*range(1, 0x3100), *range(0xFF00, 0x10000), *range(0x1F600, 0x1F650)]]
    df = quads(spark, [("urn:s", "urn:p", Lit(f"{c}\\{c}n\\n{c}")) for c in chars] + [("urn:" + c, "urn:p", "urn:o") for c in chars if c > " "])
    path = scratch(spark)
    write_nquads(df, path)
    back = read_nquads(spark, path)
    assert back.count() == df.count() and back.exceptAll(df).count() == 0


text = st.text(st.characters(exclude_categories=["Cs"]), max_size=12)


@settings(max_examples=8, deadline=None, phases=[Phase.explicit, Phase.reuse, Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(text, text, st.sampled_from(["", "en"])), min_size=1, max_size=8))
def test_any_text_survives(spark, items):
    data = [(f"urn:{i}", "urn:p", Lit(t, "", lang), f"urn:g/{g}") for i, (t, g, lang) in enumerate(items) if all(ord(c) > 31 for c in g)]
    if not data:
        return
    df = quads(spark, data)
    path = scratch(spark)
    write_nquads(df, path)
    assert rows(read_nquads(spark, path), *QUAD) == rows(df, *QUAD)


def test_export_of_one_graph(spark):
    df = quads(spark, [("urn:ds", "urn:dp", "urn:do"), ("urn:ns", "urn:np", "urn:no", "urn:named")])
    for graph, want in ((DEFAULT_GRAPH, "<urn:ds> <urn:dp> <urn:do> ."), ("urn:named", "<urn:ns> <urn:np> <urn:no> .")):
        path = scratch(spark)
        write_ntriples(df, path, graph)
        assert rows(spark.read.text(path), "value") == [(want,)]


RDF = """<?xml version="1.0"?>
<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:b="http://example.org/books#">
  <rdf:Description>
    <rdf:type resource="http://example.org/books#Book" />
    <b:shelf resource="urn:shelf:7" />
    <b:next resource="urn:book:2" />
    <b:title>Winter Fields</b:title>
    <b:pages>312</b:pages>
  </rdf:Description>
</rdf:RDF>"""


def test_flat_rdfxml(spark, tmp_path):
    (tmp_path / "a.rdf").write_text(RDF)
    names = {"rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#", "b": "http://example.org/books#"}
    elements = ["rdf:type", "b:shelf", "b:next", "b:title", "b:pages"]
    got = read_rdfxml_flat(spark, str(tmp_path / "a.rdf"), names, elements)
    assert got.count() == 5 and got.select("s").distinct().count() == 1
    assert ("http://example.org/books#title", "Winter Fields", "literal") in rows(got, "p", "o_value", "o_type")
    assert got.filter("o_type = 'uri'").count() == 3
    every = read_rdfxml_flat(spark, str(tmp_path / "a.rdf"), names)
    assert rows(every, "p", "o_value", "o_type") == rows(got, "p", "o_value", "o_type")


def test_prefixes(spark):
    defaults = spark.createDataFrame([("", "http://example.org/"), ("rdf", "http://www.w3.org/1999/02/22-rdf-syntax-ns#"), ("owl", "urn:owl#"), ("so", "urn:so#")], "prefix string, iri string")
    turtle = "PREFIX ga: <urn:garden:> PREFIX gb: <some:where>\n@prefix gc: <http://example.org/c> . @prefix gc: <http://example.org/last> .\nprefix owl: <urn:new#>\n@prefix : <http://example.org/x/> ."
    xml = RDF.replace("xmlns:b=", "xmlns='urn:none' xmlns:si='urn:si'\nxmlns:b=")
    t = read_prefixes(spark.createDataFrame([(turtle,)], "value string"))
    assert rows(t, "prefix", "iri") == [("", "http://example.org/x/"), ("ga", "urn:garden:"), ("gb", "some:where"), ("gc", "http://example.org/last"), ("owl", "urn:new#")]
    x = read_prefixes(spark.createDataFrame([(xml,)], "value string"))
    assert rows(x, "prefix", "iri") == [("", "urn:none"), ("b", "http://example.org/books#"), ("rdf", "http://www.w3.org/1999/02/22-rdf-syntax-ns#"), ("si", "urn:si")]
    merged = merge_prefixes(merge_prefixes(defaults, t), x)
    assert merged.count() == 4 + 3 + 2
    names = spark.createDataFrame([(":luke",), ("rdf:type",), ("nope:x",), ("<urn:a>",), ("owl:a:b",)], "n string")
    assert rows(expand(names, "n", defaults), "iri") == sorted(
        [("http://example.org/luke",), ("http://www.w3.org/1999/02/22-rdf-syntax-ns#type",), (None,), ("urn:a",), ("urn:owl#a:b",)], key=repr)
    two = defaults.union(spark.createDataFrame([("x", "http://example.org/x/")], "prefix string, iri string"))
    iris = spark.createDataFrame([("http://example.org/x/1",), ("http://example.org/2",), ("mailto:a",)], "i string")
    want = sorted([("x:1",), (":2",), ("<mailto:a>",)])
    assert sorted(rows(compact(iris, "i", two), "name")) == want


def test_relative_iris_and_local_names(spark):
    base = "http://example.com/base/doc?q=1#f"
    cases = {"urn:x": "urn:x", "a/b": "http://example.com/base/a/b", "/r": "http://example.com/r", "#z": "http://example.com/base/doc?q=1#z",
             "": "http://example.com/base/doc?q=1", "//h/p": "http://h/p", "?k": "http://example.com/base/doc?k", "_:b": "_:b",
             "../c": "http://example.com/c", "./c/./d": "http://example.com/base/c/d", "../../../c?x=../y": "http://example.com/c?x=../y", "..": "http://example.com/",
             "/a/b/../c/.": "http://example.com/a/c/", "a/../b#..": "http://example.com/base/b#..", "...": "http://example.com/base/..."}
    df = spark.createDataFrame([(k,) for k in cases], "r string")
    assert {r["r"]: r["x"] for r in df.select("r", resolve(F.col("r"), base).alias("x")).collect()} == cases
    df = spark.createDataFrame([("http://e.org/a/Tatoo",), ("http://e.org/a#B",)], "r string")
    assert rows(df.select(local_name(F.col("r")).alias("n")), "n") == [("B",), ("Tatoo",)]


def test_scalars(spark):
    df = spark.createDataFrame([(x,) for x in ["y", "on", "True", "off", "f", "False"]], "t string")
    assert [r[0] for r in df.select(parse_bool_strict(F.col("t"))).collect()] == [True] * 3 + [False] * 3
    for wrong in ("TRUE", "1", "", "maybe"):
        with pytest.raises(Exception, match="not a boolean"):
            spark.createDataFrame([(wrong,)], "t string").select(parse_bool_strict(F.col("t"))).collect()
    ids = spark.createDataFrame([("550e8400-e29b-41d4-a716-446655440000",), ("invalid-uuid",), ("{550E8400e29b41d4a716446655440000}",), (None,)], "i string")
    assert [r[0] for r in ids.select(is_uuid(F.col("i"))).collect()] == [True, False, True, False]
    log = '[{"type":"rewritten_query","label":"a","value":"Q"},{"type":"sparql","label":"b","value":"S"},{"type":"sparql","value":"T"}]'
    logs = spark.createDataFrame([(log,), ("[]",)], "a string")
    got = logs.select(first_action(F.col("a"), "sparql").alias("q"), first_action(F.col("a"), "rewritten_query").alias("r")).collect()
    assert [tuple(r) for r in got] == [("S", "Q"), (None, None)]
    terms = spark.createDataFrame([("uri", "urn:a"), ("bnode", "b"), ("literal", "x")], "t string, v string")
    assert [r[0] for r in terms.select(decode_term(F.col("t"), F.col("v"))).collect()] == ["<urn:a>", "_:b", "x"]
    with pytest.raises(Exception, match="unknown term type"):
        spark.createDataFrame([("other", "x")], "t string, v string").select(decode_term(F.col("t"), F.col("v"))).collect()


def solutions(spark):
    schema = "x string, y struct<type:string,value:string,datatype:string,lang:string>, n long"
    return spark.createDataFrame([
        ("urn:a", ("literal", 'tab\t"q",\n', "", "en"), 5), ("_:b", None, None), ("urn:c", ("bnode", "_:z", "", ""), 7),
    ], schema)


def test_result_files(spark):
    df = solutions(spark)
    path = scratch(spark)
    write_csv(df, path + "c")
    back = read_delimited(spark, path + "c", "x string, y string, n long")
    assert rows(back, "x", "y", "n") == rows(csv_rows(df).select("x", "y", F.col("n").cast("long").alias("n")), "x", "y", "n")
    write_tsv(df.coalesce(1), path + "t")
    lines = [r[0] for r in spark.read.text(path + "t").collect()]
    assert lines == ["?x\t?y\t?n", '<urn:a>\t"tab\\t\\"q\\",\\n"@en\t"5"^^<http://www.w3.org/2001/XMLSchema#integer>', "_:b\t\t",
                     '<urn:c>\t_:z\t"7"^^<http://www.w3.org/2001/XMLSchema#integer>']
    write_json(df, path + "j")
    back = read_bindings_json(spark, path + "j/bindings", ["x", "y", "n"])
    assert rows(back.select("x.value", "y.lang", "n.datatype"), "value", "lang", "datatype") == sorted(
        [("urn:a", "en", XSD_INTEGER), ("_:b", None, None), ("urn:c", "", XSD_INTEGER)], key=repr)
    one = [r["value"] for r in json_bindings(df).collect() if "_:b" in r["value"] or '"b"' in r["value"]]
    assert one == ['{"x":{"type":"bnode","value":"b"}}']


def test_result_documents(spark, tmp_path):
    good = '{"head":{"vars":["s"]},"results":{"bindings":[{"s":{"type":"uri","value":"urn:a"}},{"s":{"type":"literal","value":"5","datatype":"urn:t"}},{}]}}'
    (tmp_path / "a.json").write_text(good)
    got = read_results_json(spark, str(tmp_path / "a.json"), ["s"])
    assert got.count() == 3 and got.filter("s.type = 'uri'").count() == 1 and got.filter("s is null").count() == 1
    for i, bad in enumerate(['{"head":{"vars":["s"]}}', '{"results":{"bindings":[]}}', "<xml/>"]):
        (tmp_path / f"bad{i}.json").write_text(bad)
        with pytest.raises(Exception):
            read_results_json(spark, str(tmp_path / f"bad{i}.json"), ["s"]).collect()
    (tmp_path / "tag.json").write_text(good.replace('"literal"', '"thing"'))
    with pytest.raises(Exception, match="unknown term type"):
        read_results_json(spark, str(tmp_path / "tag.json"), ["s"]).collect()


@pytest.mark.parametrize("sep", [",", "\t", "|"])
def test_delimited_scores(spark, tmp_path, sep):
    from quadrille.functions.iri import Template
    from quadrille.operators.mapping import Col, MappedGraph, Mapping, Rule

    (tmp_path / "s.csv").write_text("\n".join([sep.join(["nr", "score"]), *[sep.join([str(i), str(i * 7 % 5)]) for i in range(100)]]))
    for read in (read_delimited, read_lines_delimited):
        df = read(spark, str(tmp_path / "s.csv"), "nr int, score int", sep)
        g = MappedGraph([Mapping(df, (Rule(Template("http://example.org/person/nr={nr}"), "urn:score", Col("score")),), unique=True)])
        assert g.quads().count() == 100


def test_files_as_documents_and_sources(spark, tmp_path):
    (tmp_path / "doc one.txt").write_bytes(b"x" * 113)
    assert rows(read_binary(spark, str(tmp_path)), "name", "length") == [("doc one.txt", 113)]
    (tmp_path / "l.json").write_text('{"a": 1}\n{"a": 2}\n')
    assert read_json(spark, str(tmp_path / "l.json"), "a int").count() == 2
    sources = Sources()
    sources.register("t", spark.range(5))
    sources.register("u", spark.range(7))
    with pytest.raises(ValueError):
        sources.register("t", spark.range(1))
    assert rows(sources.row_counts(), "table_name", "n_rows") == [("t", 5), ("u", 7)]
    sources.delete("u")
    assert sources.names() == ["t"]
    with pytest.raises(KeyError):
        sources.get("u")
    assert callable(read_jdbc)


def test_salted_lookup_equals_broadcast(spark):
    big = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 11).alias("k"), "id")
    small = spark.createDataFrame([(0, "a"), (0, "b"), (4, "c")], "k long, v string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        a, b = join_lookup(big, small, ["k"], how), join_lookup(big, small, ["k"], how, limit=0)
        assert a.columns == b.columns and rows(a, *a.columns) == rows(b, *b.columns)
    assert SW


def test_documents_that_are_written_do_not_grow_with_the_table(spark, tmp_path, monkeypatch):
    from quadrille.plans import files

    spark.range(25).select(F.col("id").alias("c_custkey"), F.lit("x").alias("c_name"), F.lit(1).alias("c_nationkey"), F.lit(1.5).alias("c_acctbal"), F.lit("y").alias("c_mktsegment")).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    monkeypatch.setattr(files, "XML_RECORDS", 10)
    monkeypatch.setattr(files, "scratch", lambda spark, name: f"{tmp_path}/{name}")
    found = files.rdfxml_flat_scan(spark, str(tmp_path))
    assert found.count() == 125 and len(list((tmp_path / "rdfxml").glob("part-*"))) == 3


@pytest.mark.parametrize("scheme", ["", "file:"])
def test_blobs_in_folders_of_some_files(spark, monkeypatch, scheme, tmp_path):
    monkeypatch.setattr(blobs, "FOLDER_FILES", 3)
    texts = [None, "", "ü\nb", "x" * 200_000, *[f"t{i}" for i in range(16)]]
    df = spark.createDataFrame([(t,) for t in texts], "value string").repartition(2)
    folders = blobs.write_blobs(df, "value", f"{scheme}{tmp_path}/a b")
    found = rows(read_binary(spark, folders), "length", "content")
    assert found == sorted([(len(c), bytearray(c)) for c in ((t or "").encode() + b"\n" for t in texts)], key=repr)
    assert 7 <= len(folders) <= 8 and not list(tmp_path.rglob("*.crc")) and max(len(list(f.iterdir())) for f in (tmp_path / "a b").iterdir()) == 3


def test_blobs_of_no_rows_and_of_failed_attempts(spark, tmp_path):
    assert blobs.write_blobs(spark.createDataFrame([], "value string"), "value", str(tmp_path / "none")) == []
    odd = spark.range(20).select(F.when(F.col("id") < 19, F.lit("x")).otherwise(F.raise_error(F.lit("no"))).alias("value")).coalesce(1)
    with pytest.raises(Exception, match="no"):
        blobs.write_blobs(odd, "value", str(tmp_path / "odd"))


def test_binary_documents_are_read_some_folders_at_a_time(spark, monkeypatch, tmp_path):
    from quadrille.plans import files, load

    monkeypatch.setattr(blobs, "FOLDER_FILES", 2)
    monkeypatch.setattr(files, "SCAN_FOLDERS", 2)
    sizes, read = [], read_binary
    monkeypatch.setattr(files, "read_binary", lambda spark, paths: sizes.append(len(paths)) or read(spark, paths))
    spark.createDataFrame([(i, f"text {i}") for i in range(15)] + [(3, "again")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = load()[0]["binary_docs_scan"](spark, str(tmp_path))
    assert sum(sizes) >= 8 and max(sizes) == 2
    assert rows(found, "doc_id", "length") == sorted([(i, len(f"{i}\ntext {i}\n")) for i in range(15)] + [(3, 8)], key=repr)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert load()[0]["binary_docs_scan"](spark, str(tmp_path / "none")).count() == 0
