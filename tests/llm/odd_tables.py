"""Columns and texts that operators must cope with."""

from pyspark.sql import functions as F

# Names that the operators use inside, as columns of a caller's table.
CLASHING = (
    "size, shard, node, key, hash, score, n, taken, rank, group, bucket, language, doc, id, r, k, f,"
    " label, h, first, sketch, entry, place, part, file, own, told, hits, copies, copy, times, rows,"
    " served, row, repeat, finish, running, everything, target, source_size, kept, d, g, w, l"
).split(", ")

LONG = " ".join(f"word{i % 9000}" for i in range(60_000))


def with_clashing(df):
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING])
