"""Pointer entries: an index of keys in which the first entry wins, and chains of pointers of bounded length."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossaria.functions import quality, text
from glossaria.functions.normalize import letters, split_number

# Parts of speech of function words, as headword lines mark them.
FUNCTION_MARKS = ["conj", "praep", "adv", "pron", "interj", "num"]


def first_wins_index(entries: DataFrame, idx: str, key: str, head: str) -> DataFrame:
    """``(word, idx)``: for each normalised headword or key without its number, the first entry that has it.

    Within an entry the headword comes before the key; entries come in the order of ``idx``. Empty words are dropped.
    """
    stem, _ = split_number(F.col(key))
    words = entries.select(F.col(idx).alias("idx"), F.posexplode(F.array(letters(F.col(head)), letters(stem))).alias("turn", "word"))
    return words.where("word is not null and word != ''").groupBy("word").agg(F.min(F.struct("idx", "turn")).alias("m")).select("word", F.col("m.idx").alias("idx"))


def numbered_index(entries: DataFrame, idx: str, key: str) -> DataFrame:
    """``(word, number, idx)`` of entries whose key carries a homograph number; the first entry wins."""
    stem, number = split_number(F.col(key))
    rows = entries.select(F.col(idx).alias("idx"), letters(stem).alias("word"), number.alias("number"))
    return rows.where("number is not null and word != ''").groupBy("word", "number").agg(F.min("idx").alias("idx"))


def resolve_targets(pointers: DataFrame, index: DataFrame, numbered: DataFrame) -> DataFrame:
    """``(src, dst)`` of ``(src, word, number)``: the numbered entry if there is one, else the first of that name; never itself by name alone."""
    n = numbered.select(F.col("word").alias("_w"), F.col("number").alias("_n"), F.col("idx").alias("by_number"))
    b = index.select(F.col("word").alias("_v"), F.col("idx").alias("by_name"))
    rows = pointers.join(n, (F.col("word") == F.col("_w")) & (F.col("number") == F.col("_n")), "left").join(b, F.col("word") == F.col("_v"), "left")
    dst = F.coalesce("by_number", F.when(F.col("by_name") != F.col("src"), F.col("by_name")))
    return rows.select("src", dst.alias("dst")).where("dst is not null")


def chase(starts: DataFrame, edges: DataFrame, stops: DataFrame, hops: int = 4) -> DataFrame:
    """``(src, dst, hops)``: the first node on a start's chain that is in ``stops``, at most ``hops`` edges away.

    ``starts (src)`` and ``edges (src, dst)`` are unique in src, ``stops (node)`` in node. A chain that comes back to a
    node it has passed ends there without result. The loop is unrolled: every hop is one equi-join, and
    only chains that are still open go on.
    """
    step = edges.select(F.col("src").alias("_at"), F.col("dst").alias("_next"))
    stop = stops.select(F.col("node").alias("_stop")).distinct()
    open_ = starts.select("src", F.col("src").alias("at"), F.array("src").alias("path"))
    found = None
    for hop in range(1, hops + 1):
        open_ = open_.join(step, F.col("at") == F.col("_at")).where(~F.array_contains("path", F.col("_next")))
        open_ = open_.join(stop, F.col("_next") == F.col("_stop"), "left")
        done = open_.where("_stop is not null").select("src", F.col("_next").alias("dst"), F.lit(hop).alias("hops"))
        found = done if found is None else found.unionByName(done)
        open_ = open_.where("_stop is null").select("src", F.col("_next").alias("at"), F.concat("path", F.array("_next")).alias("path"))
    return found


def last_targets(edges: DataFrame, short: DataFrame, hops: int = 4) -> DataFrame:
    """``(src, dst)``: the last node on the chain of each node of ``short (node)``, which goes on only while the node reached is short too.

    At most ``hops`` edges ``(src, dst)``, unique in src; a chain that would come back to a node it has passed ends before it.
    """
    step = edges.select(F.col("src").alias("_at"), F.col("dst").alias("_next"))
    goes = short.select(F.col("node").alias("_short")).distinct()
    open_ = goes.select(F.col("_short").alias("src"), F.col("_short").alias("at"), F.array("_short").alias("path"))
    found = None
    for hop in range(1, hops + 1):
        on = open_.join(step, F.col("at") == F.col("_at")).where(~F.array_contains("path", F.col("_next")))
        reached = on.select("src", F.lit(hop).alias("hop"), F.col("_next").alias("dst"))
        found = reached if found is None else found.unionByName(reached)
        on = on.join(goes, F.col("_next") == F.col("_short"), "left_semi")
        open_ = on.select("src", F.col("_next").alias("at"), F.concat("path", F.array("_next")).alias("path"))
    return found.groupBy("src").agg(F.max_by("dst", "hop").alias("dst"))


def inherit_rejection(rejected: DataFrame, targets: DataFrame) -> DataFrame:
    """``(node)`` of the pointers ``targets (src, dst)`` whose target is in ``rejected (node)``; one hop, so what is rejected here passes nothing on."""
    nodes = rejected.select(F.col("node").alias("dst")).distinct()
    return targets.join(nodes, "dst", "left_semi").select(F.col("src").alias("node")).distinct()


def function_words(entries: DataFrame, targets: DataFrame) -> DataFrame:
    """``(idx)`` of the function words among ``(idx, headword, body)``: marked so, or a bare pointer ``(src, dst)`` to one that is.

    The mark stands in the headword line without parentheses. A pointer is bare below 60 characters and without '='; a prefix is no word.
    """
    body = F.coalesce("body", F.lit(""))
    head = text.pos_marker(F.substring(F.regexp_replace(body, r"\([^()]*\)", " "), 1, 60))
    marked = F.coalesce(head.isin(FUNCTION_MARKS), F.lit(False)) | (quality.function_entry(body) & (F.length(letters(F.col("headword"))) > 1))
    own = entries.where(marked).select("idx").distinct()
    bare = entries.where((F.length(body) < 60) & ~F.contains(body, F.lit("=")) & ~F.endswith(F.rtrim("headword"), F.lit("-")))
    return own.unionByName(bare.select("idx").join(inherit_rejection(own.select(F.col("idx").alias("node")), targets).select(F.col("node").alias("idx")), "idx", "left_semi")).distinct()
