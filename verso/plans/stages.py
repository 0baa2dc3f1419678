"""The batch pipeline as functions from tables to tables: words, features, whitespace, export, checks.

Each stage handles the pages it is given and can be run again for some of them; writing replaces
pages one by one (export.replace_pages).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..keep import keep
from ..operators import export, graph, quality, search, whitespace
from ..sources import typeset


@dataclass
class Whitespace:
    gutters: DataFrame
    docks: DataFrame
    graph: DataFrame


def some_pages(rows: DataFrame, pages: list[int] | None) -> DataFrame:
    """rows of the pages that are asked for; None is all."""
    return rows if pages is None else rows.where(F.col("page_num").isin(pages))


def extract(documents: DataFrame, pages: list[int] | None = None) -> DataFrame:
    """The words table with features; frequencies are those of the whole corpus."""
    return some_pages(typeset.features(typeset.words(documents)), pages)


def measure(words: DataFrame, bodies: DataFrame) -> Whitespace:
    """Gutters and slits with river scores, docks whose ports name their nodes, and the graph."""
    boxes = keep(words.select("id", "page_num", "line_idx", "bbox_x0", "bbox_y0", "bbox_x1", "bbox_y1"))
    gutters = keep(whitespace.h_gutters(boxes, bodies))
    slits = keep(whitespace.river_scores(whitespace.v_slits(boxes, bodies, gutters)))
    docks = keep(whitespace.docks(boxes, bodies, gutters, slits))
    nodes = keep(graph.nodes(gutters, slits, docks))
    all_gutters = gutters.withColumn("river_score", F.lit(0.0)).unionByName(slits)
    return Whitespace(all_gutters, export.ports_with_nodes(docks, nodes), graph.adjacency(nodes, graph.edges(nodes, gutters, slits)))


def publish(documents: DataFrame, path: str, pages: list[int] | None = None) -> None:
    """From texts to a package of pages, catalogue and index under path."""
    words = keep(extract(documents, pages))
    table, corrections = typeset.page_table(words), typeset.corrections(words)
    air = measure(words, typeset.bodies(words))
    docs = export.page_documents(table, corrections, words, air.gutters, air.docks, air.graph)
    export.package(docs, search.catalog(table, search.chapters(words)), search.inverted_index(words), path)


def check(documents: DataFrame, pages: list[int] | None = None) -> DataFrame:
    """The contract's checks on a typeset corpus: (name, ok, failures)."""
    words = keep(extract(documents, pages))
    table, corrections = typeset.page_table(words), typeset.corrections(words)
    air = measure(words, typeset.bodies(words))
    return quality.report({
        "pages exist": quality.pages_without_row(corrections, table), "canonical size": quality.wrong_sizes(table), "no orphan words": quality.orphan_words(words, table),
        "features complete": quality.incomplete_features(words), "boxes in bounds": quality.bad_boxes(words, table), "graph present": quality.graphless(corrections, air.graph),
        "graph has edges": quality.edgeless(air.graph), "docks present": quality.dockless(words, air.docks), "ports have nodes": quality.ports_without_node(air.docks), "header numbers": quality.poorly_numbered(words),
    })
