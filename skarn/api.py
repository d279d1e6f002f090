"""A code graph as one object: lookups, traversals, search and metrics over its tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import scalars as S
from .operators import context, graph, search
from .plans import adapters


@dataclass
class SymbolGraph:
    """``nodes`` (id, kind, name, qualified_name, file_path, language, start_line, is_exported) and ``edges`` (source, target, kind)."""

    nodes: DataFrame
    edges: DataFrame

    @classmethod
    def over(cls, spark: SparkSession, folder: str) -> SymbolGraph:
        """The graph of the test tables in a folder, or of its nodes.parquet and edges.parquet."""
        from .sources.bundle import exists

        if exists(spark, f"{folder}/nodes.parquet"):
            return cls(spark.read.parquet(f"{folder}/nodes.parquet"), spark.read.parquet(f"{folder}/edges.parquet"))
        return cls(adapters.nodes(spark, folder), adapters.edges(spark, folder))

    def ids(self, *names: str) -> DataFrame:
        """The nodes of these ids, or of these names."""
        return self.nodes.where(F.col("id").isin(*names) | F.col("name").isin(*names)).select("id")

    def node(self, *names: str) -> DataFrame:
        return self.nodes.join(self.ids(*names), "id", "left_semi")

    def search(self, query: str, limit: int = 20) -> DataFrame:
        return search.search(self.nodes, query, limit)

    def explore(self, query: str, limit: int = 5, most: int = 20) -> tuple[DataFrame, DataFrame]:
        """Nodes and edges around the best results of a search."""
        return context.assembled(self.nodes, self.edges, graph.kept(self.search(query, limit).select("id")), most=most, query=query)

    def context(self, *names: str) -> DataFrame:
        return graph.node_context(self.nodes, self.edges, self.ids(*names))

    def traverse(self, *names: str, depth: int | None = None, direction: str = "out", kinds: tuple | None = None) -> DataFrame:
        return graph.reach(self.edges, self.ids(*names), depth, direction, kinds)

    def callers(self, *names: str, depth: int = 1) -> DataFrame:
        return graph.callers(self.edges, self.ids(*names), depth)

    def callees(self, *names: str, depth: int = 1) -> DataFrame:
        return graph.callees(self.edges, self.ids(*names), depth)

    def call_graph(self, *names: str, depth: int = 2) -> DataFrame:
        return graph.call_graph(self.edges, self.ids(*names), depth)

    def hierarchy(self, *names: str) -> DataFrame:
        return graph.hierarchy(self.edges, self.ids(*names))

    def usages(self, *names: str) -> DataFrame:
        return graph.neighbours(self.edges, self.ids(*names), "in")

    def impact(self, *names: str, depth: int = 3) -> DataFrame:
        return graph.impact(self.nodes, self.edges, self.ids(*names), depth)

    def path(self, source: str, target: str, kinds: tuple | None = None) -> DataFrame:
        return graph.shortest_path(self.edges, source, target, kinds)

    def ancestors(self, *names: str) -> DataFrame:
        return graph.ancestors(self.edges, self.ids(*names))

    def children(self, *names: str) -> DataFrame:
        return graph.neighbours(self.edges, self.ids(*names), "out", ("contains",))

    def files(self) -> DataFrame:
        return graph.module_structure(self.nodes)

    def file_dependencies(self) -> DataFrame:
        return graph.file_edges(self.nodes, self.edges)

    def cycles(self) -> DataFrame:
        return graph.cycles(self.file_dependencies().select(F.col("source_file").alias("source"), F.col("target_file").alias("target")))

    def dead_code(self) -> DataFrame:
        return graph.dead_code(self.nodes, self.edges)

    def metrics(self) -> DataFrame:
        return graph.metrics(self.nodes, self.edges)

    def status(self) -> DataFrame:
        return graph.stats(self.nodes, self.edges)

    def affected(self, *files: str, is_test: Column | None = None, depth: int = 5) -> DataFrame:
        deps = self.file_dependencies().select(F.col("source_file").alias("source"), F.col("target_file").alias("target"))
        return graph.affected(deps, graph.ids(self.nodes, list(files)), S.is_test_file(F.col("id")) if is_test is None else is_test, depth)
