"""Small graphs and tables with known counts. The facts are fixed values."""

from quadrille.model import DEFAULT_GRAPH, OWL, RDF_TYPE, RDFS, RDFS_SUBCLASS, XSD_INTEGER, Lit, quads

SW = "http://example.org/starwars/"


def starwars_quads(spark, graph=DEFAULT_GRAPH):
    rows = [
        (SW + "Character", RDF_TYPE, RDFS + "Class"),
        (SW + "Human", RDF_TYPE, OWL + "Class"),
        (SW + "Human", RDFS_SUBCLASS, SW + "Character"),
        (SW + "Droid", RDF_TYPE, OWL + "Class"),
        (SW + "Droid", RDFS_SUBCLASS, SW + "Character"),
    ]

    def add(s, cls, name=None, links=(), **values):
        rows.append((SW + s, RDF_TYPE, SW + cls))
        if name is not None:
            rows.append((SW + s, SW + "name", Lit(name)))
        for p, v in values.items():
            rows.append((SW + s, SW + p, Lit(str(v), XSD_INTEGER) if isinstance(v, int) else Lit(v)))
        for p, targets in links:
            rows.extend((SW + s, SW + p, SW + t) for t in targets.split())

    films = ("appearsIn", "NewHope Empire Jedi")
    add("luke", "Human", "Luke Skywalker", [("friends", "han leia threepio artoo"), films, ("homePlanet", "Tatooine")], id=1000)
    add("vader", "Human", "Darth Vader", [("friends", "tarkin"), films, ("homePlanet", "Tatooine")], id=1001)
    add("han", "Human", "Han Solo", [("friends", "luke leia artoo"), films], id=1002)
    add("leia", "Human", "Leia Organa", [("friends", "luke han threepio artoo"), films, ("homePlanet", "Alderaan")], id=1003)
    add("tarkin", "Human", "Wilhuff Tarkin", [("friends", "vader"), ("appearsIn", "NewHope")], id=1004)
    add("threepio", "Droid", "C-3PO", [("friends", "luke han leia artoo"), films], id=2000, primaryFunction="Protocol")
    add("artoo", "Droid", "R2-D2", [("friends", "luke han leia"), films], id=2001, primaryFunction="Astromech")
    add("rick", "Droid", "Rick βüãäoñr", id=2002)
    add("NewHope", "Episode", "A New Hope", index=4)
    add("Empire", "Episode", "The Empire Strikes Back", index=5)
    add("Jedi", "Episode", "Return of the Jedi", index=6)
    add("Tatooine", "Planet", None, [("region", "OuterRim"), ("sector", "Arkanis"), ("system", "Tatoo")])
    add("Alderaan", "Planet", None, [("region", "CoreWorlds"), ("sector", "Alderaan"), ("system", "Alderaan")])
    return quads(spark, rows, graph)


def music_tables(spark):
    """Five related tables: artists, albums, members of bands, tracks, writers."""
    from datetime import date

    artist = spark.createDataFrame(
        [(1, "John Lennon", "d1", 1), (2, "Paul McCartney", "d2", 1), (3, "Ringo Starr", "d3", 1), (4, "George Harrison", "d4", 1),
         (5, "The Beatles", "d5", 2)],
        "id int, name string, description string, type int",
    )
    album = spark.createDataFrame(
        [(1, "Please Please Me", date(1963, 3, 22), 5), (2, "McCartney", date(1970, 4, 17), 2), (3, "Imagine", date(1971, 10, 11), 1)],
        "id int, name string, release_date date, artist int",
    )
    membership = spark.createDataFrame([(i, 5) for i in (1, 2, 3, 4)], "artist int, band int")
    track = spark.createDataFrame([(1, "Love Me Do", 1, 125)], "id int, name string, album int, length int")
    writer = spark.createDataFrame([(1, 1), (1, 2)], "song int, writer int")
    return dict(Artist=artist, Album=album, Membership=membership, Track=track, Songwriter=writer)
