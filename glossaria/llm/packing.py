"""Filling containers of fixed capacity with items of varying size.

Sum-of-squares online packing: an array holds how many open containers stand at each fill level. An item
goes to the level (0 is a new container) after which the sum of squared counts of partially filled
containers is least. That keeps levels evenly used, so that later items find one they complete.

Items come online, in an order that a hash of their id gives: each is placed for good before the next is seen, and no
sort by size is needed (measured, it would not fill better). They are spread by hash over shards of bounded size and each shard is packed by one task; half-empty
containers of all shards are then packed once more as if they were items. The number of shards grows with
the data, so a task's memory does not.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossaria.workspace import materialise


def sum_of_squares(sizes: Iterable[int], capacity: int) -> np.ndarray:
    """Container number of each item, in the given order; every size must be in 1..capacity."""
    counts = np.zeros(capacity + 1, dtype=np.int64)  # counts[h]: open containers at level h; 0 and capacity stay 0
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    sizes = list(sizes)
    out = np.empty(len(sizes), dtype=np.int64)
    made = 0
    far = np.int64(1) << 60
    for k, size in enumerate(sizes):
        if not 0 < size <= capacity:
            raise ValueError(f"item of size {size} for a capacity of {capacity}")
        # from level h to h + size: (N[h+s] + 1)^2 - N[h+s]^2 + (N[h] - 1)^2 - N[h]^2
        gain = 2 * counts[size : capacity + 1] - 2 * counts[: capacity + 1 - size] + 2
        gain[capacity - size] -= 1  # a full container is no longer counted
        gain[0] -= 1  # a new container leaves no level
        gain[1:][counts[1 : capacity + 1 - size] == 0] = far
        level = int(gain.argmin())
        if level:
            box = open_at[level].pop()
            counts[level] -= 1
        else:
            box, made = made, made + 1
        out[k] = box
        if level + size < capacity:
            open_at[level + size].append(box)
            counts[level + size] += 1
    return out


def _pack(items: DataFrame, name: str, most_items: int) -> DataFrame:
    """Adds ``container`` to ``(spec_id, capacity, item, size, ...)``; containers of different shards have different names."""
    n = items.groupBy("spec_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    shards = max(1, math.ceil(n / most_items))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["turn", "item"], kind="stable")
        boxes = sum_of_squares(group["size"].tolist(), int(group["capacity"].iloc[0]))
        return group.assign(container=[f"{name}-{shard}-{b}" for shard, b in zip(group["shard"], boxes, strict=True)]).drop(columns=["shard", "turn"])

    turn = F.xxhash64("item", F.lit(name))
    sharded = items.withColumn("turn", turn).withColumn("shard", F.pmod(F.xxhash64("item"), F.lit(shards)).cast("int"))
    return sharded.groupBy("spec_id", "shard").applyInPandas(run, items.schema.add("container", "string"))


def pack(sizes: DataFrame, specs: DataFrame, most_items: int = 25_000, most_specs: int = 100) -> DataFrame:
    """Containers for every specification: ``(spec_id, container, doc_id, piece, start_token, n_tokens)``.

    ``sizes (doc_id, n_tokens)`` with unique doc_id, ``specs (spec_id, capacity_tokens)``. An item is divided
    only if it exceeds the capacity: into full containers and one rest, which is packed like any other item.
    Items without tokens need no room and come out with a null container; null sizes count as no tokens.
    Specifications with a null capacity or one below 1 are left out. The order of the items depends
    on their ids only, so the result is the same on every run. At most ``most_items`` items are held by one task.
    """
    rows = specs.select("spec_id", F.col("capacity_tokens").cast("int").alias("capacity")).where("capacity >= 1").distinct().limit(most_specs + 1).collect()
    if len(rows) > most_specs:
        raise ValueError(f"more than {most_specs} specifications")
    kinds = [F.struct(F.lit(r[0]).alias("spec_id"), F.lit(r[1]).alias("capacity")) for r in rows]
    asked = F.array(*kinds) if kinds else F.array().cast("array<struct<spec_id:int,capacity:int>>")
    every = sizes.select("doc_id", F.coalesce(F.col("n_tokens"), F.lit(0)).cast("bigint").alias("n_tokens"), F.explode(asked).alias("k")).select("doc_id", "n_tokens", "k.*")
    empty = every.where("n_tokens = 0").select("spec_id", F.lit(None).cast("string").alias("container"), "doc_id", F.lit(0).alias("piece"), F.lit(0).cast("bigint").alias("start_token"), "n_tokens")
    filled = every.where("n_tokens > 0").withColumn("fulls", F.expr("cast(n_tokens div capacity as int)"))
    whole = (
        filled.where("fulls > 0")
        .select("spec_id", "capacity", "doc_id", F.explode(F.sequence(F.lit(0), F.col("fulls") - 1)).alias("piece"))
        .select(
            "spec_id",
            F.concat(F.lit("full-"), "doc_id", F.lit("-"), "piece").alias("container"),
            "doc_id",
            "piece",
            (F.col("piece") * F.col("capacity")).cast("bigint").alias("start_token"),
            F.col("capacity").cast("bigint").alias("n_tokens"),
        )
    )
    rest = filled.where("n_tokens % capacity > 0").select("spec_id", "capacity", F.col("doc_id").alias("item"), F.expr("cast(n_tokens % capacity as int)").alias("size"), F.col("fulls").alias("piece"), (F.col("fulls") * F.col("capacity")).cast("bigint").alias("start_token"))
    packed = materialise(_pack(rest, "a", most_items), "packed")
    # once more: containers that are at most half full are items now
    fill = packed.groupBy("spec_id", "capacity", "container").agg(F.sum("size").cast("int").alias("size"))
    half = fill.where("size * 2 <= capacity").select("spec_id", "capacity", F.col("container").alias("item"), "size")
    again = _pack(half, "b", most_items).select("spec_id", F.col("item").alias("container"), F.col("container").alias("merged"))
    rests = packed.join(again, ["spec_id", "container"], "left").select(
        "spec_id", F.coalesce("merged", "container").alias("container"), F.col("item").alias("doc_id"), "piece", "start_token", F.col("size").cast("bigint").alias("n_tokens")
    )
    return rests.unionByName(whole).unionByName(empty)


def check_packing(packed: DataFrame, sizes: DataFrame, specs: DataFrame) -> DataFrame:
    """Per specification: containers over their capacity, items placed, items divided without need, and tokens missing or doubled."""
    boxes = packed.where("container is not null").groupBy("spec_id", "container").agg(F.sum("n_tokens").alias("used")).join(F.broadcast(specs), "spec_id")
    over = boxes.groupBy("spec_id").agg(F.count_if(F.col("used") > F.col("capacity_tokens")).alias("n_over"))
    items = packed.groupBy("spec_id", "doc_id").agg(F.sum("n_tokens").alias("placed"), F.count(F.lit(1)).alias("pieces"))
    items = items.join(sizes.select("doc_id", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens")), "doc_id").join(F.broadcast(specs), "spec_id")
    by = items.groupBy("spec_id").agg(
        F.count(F.lit(1)).alias("n_items"), F.count_if((F.col("pieces") > 1) & (F.col("n_tokens") <= F.col("capacity_tokens"))).alias("n_divided"), F.count_if(F.col("placed") != F.col("n_tokens")).alias("n_wrong")
    )
    return over.join(by, "spec_id").select("spec_id", "n_items", "n_over", "n_divided", "n_wrong")


def fill_report(packed: DataFrame, specs: DataFrame) -> DataFrame:
    """Per specification: containers, tokens, and the share of the room that is used."""
    used = packed.where("container is not null").groupBy("spec_id").agg(F.count_distinct("container").alias("n_containers"), F.sum("n_tokens").alias("n_tokens"))
    return specs.select("spec_id", "capacity_tokens").join(used, "spec_id").withColumn("fill", F.round(F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens")), 6))
