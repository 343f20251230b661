"""Knowledge-graph analytics on Spark DataFrames."""

from .functions.iri import Template
from .model import DEFAULT_GRAPH, RDF_TYPE, Lit, Val, quads
from .operators.graph import Dataset, Graph, Pattern, StoredGraph, UnionGraph
from .operators.mapping import Col, MappedGraph, Mapping, Rule, Table, direct_mapping
from .operators.patterns import ask, bgp, construct
from .operators.store import GraphStore, restore
from .session import tune

__all__ = [
    "DEFAULT_GRAPH", "RDF_TYPE", "Lit", "Val", "quads", "Dataset", "Graph", "Pattern", "StoredGraph", "UnionGraph", "Col",
    "MappedGraph", "Mapping", "Rule", "Table", "Template", "direct_mapping", "ask", "bgp", "construct", "GraphStore", "restore", "tune",
]
