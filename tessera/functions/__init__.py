from tessera.functions.hashing import hash_prefix, weighted_bucket, weighted_bucket_sql
from tessera.functions.text import LINE_BREAK, hashtags, java_split, text_lines

__all__ = ["LINE_BREAK", "hash_prefix", "hashtags", "java_split", "text_lines",
           "weighted_bucket", "weighted_bucket_sql"]
