from tessera.sources import bindings, sinks
from tessera.sources.readers import (adjacency_line_counts, adjacency_to_edges, parse_quoted_names,
                                     read_adjacency, read_customer_orders, read_json, read_labeled_points,
                                     read_people, read_quoted_names, read_ratings, read_station_readings,
                                     read_stop_words, read_stream, read_table, read_text, read_titles,
                                     read_users)

__all__ = ["bindings", "sinks", "adjacency_line_counts", "adjacency_to_edges", "parse_quoted_names", "read_adjacency",
           "read_customer_orders", "read_json", "read_labeled_points", "read_people", "read_quoted_names",
           "read_ratings", "read_station_readings", "read_stop_words", "read_stream", "read_table",
           "read_text", "read_titles", "read_users"]
