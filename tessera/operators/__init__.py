"""Operators: ``f(DataFrame, **params) -> DataFrame`` (graph loops and model
fits run one small aggregate per round/iteration; nothing else collects)."""

from tessera.operators import aggregates, graph, ml, people, ranking, similarity, splits, wordcount

__all__ = ["aggregates", "graph", "ml", "people", "ranking", "similarity", "splits", "wordcount"]
