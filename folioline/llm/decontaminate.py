"""Benchmark decontamination as a prefix-filtered set join, with DataFrame functions only.

A window is 13 words in a row of a benchmark item (all words of a shorter item). A document contains it
only if it contains the window's rarest word, so that word is the one necessary prefix token: the words of the
documents probe these tokens where they stand, position and length say whether the window fits, and the words
themselves are compared. Nothing of the documents is shuffled but what was found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from folioline.llm.rows import text_key, without
from folioline.session import settle

WINDOW = 13
#: A document is contaminated if one word in so many, at least, lies in an occurrence.
SHARE = 20
#: So many windows at most are sent to all executors at once (about 50 MB); a larger benchmark goes in blocks.
BLOCK_WINDOWS = 100_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_list(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lowering A-Z; null has none."""
    text = F.coalesce(text, F.lit(""))
    # the built-in lower() is right, and much faster, where there are only ASCII characters
    lowered = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(lowered, _BETWEEN), "")


def item_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, at, width, words): the windows of each item. Items without id or words have none."""
    items = benchmark.where(F.col(item_id).isNotNull()).select(
        F.col(item_id).alias("item_id"), word_list(F.col(text)).alias("_w")).distinct()
    n = F.size("_w")
    width = F.least(n, F.lit(WINDOW))
    return items.where(n > 0).select(
        "item_id", F.explode(F.sequence(F.lit(1), n - width + 1)).alias("at"), width.alias("width"), "_w").select(
        "item_id", "at", "width", F.slice("_w", F.col("at"), F.col("width")).alias("words"))


def _tokens(docs: DataFrame, text: str, ids: list[str]) -> DataFrame:
    return docs.select(*ids, word_list(F.col(text)).alias("_words"))


def _probes(docs: DataFrame, windows: DataFrame, text: str) -> DataFrame:
    """The windows with their rarest word: ``token``, and ``before``, how many words of the window precede it."""
    numbered = windows.select("window", F.posexplode("words").alias("before", "token"))
    vocabulary = settle(numbered.select("token").distinct(), "vocabulary")
    seen = _tokens(docs, text, []).select(F.explode("_words").alias("token"))
    frequent = seen.join(F.broadcast(vocabulary), "token").groupBy("token").agg(F.count("*").alias("df"))
    ranked = numbered.join(frequent, "token")  # a window with a word that no document has occurs nowhere
    whole = ranked.groupBy("window").agg(
        F.count("*").alias("_present"), F.min(F.struct("df", "token", "before")).alias("_rarest"))
    return windows.join(whole, "window").where(F.col("_present") == F.col("width")).select(
        "item_id", "width", "words", F.col("_rarest.token").alias("token"), F.col("_rarest.before").alias("before"))


def occurrences(docs: DataFrame, benchmark: DataFrame, text: str = "text", ids: list[str] | None = None) -> DataFrame:
    """``ids`` (default ``doc_id``), ``item_id``, ``start`` (from 0) and ``width`` of each occurrence of a window."""
    ids = ids or ["doc_id"]
    windows = settle(item_windows(benchmark).withColumn("window", F.monotonically_increasing_id()), "windows")
    blocks = max(1, -(-windows.count() // BLOCK_WINDOWS))
    found = None
    for block in range(blocks):
        part = windows.where(F.pmod("window", F.lit(blocks)) == block)
        probes = settle(_probes(docs, part, text), "probes")
        placed = _tokens(docs, text, ids).select(*ids, "_words", F.posexplode("_words").alias("_at", "token"))
        start = F.col("_at") - F.col("before")
        fits = (start >= 0) & (start + F.col("width") <= F.size("_words"))
        same = F.slice("_words", F.greatest(start, F.lit(0)) + 1, F.col("width")) == F.col("words")
        hits = placed.join(F.broadcast(probes), "token").where(fits).where(same).select(
            *ids, "item_id", start.alias("start"), "width")
        found = hits if found is None else found.unionByName(hits)
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256 and contaminated.

    Also ``text_key``, a hash of the text: rows of one id but unlike texts are judged each, rows that repeat alike.
    Null and empty texts have no words and no hits; nor does anything with an empty benchmark. Occurrences of a
    document are gathered in one row of at most as many entries as it has words and the benchmark has items.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"), text_key(text).alias("text_key"))
    found = occurrences(rows, benchmark, "_text", ["doc_id", "text_key"])
    per_doc = found.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("width")).alias("end")))).alias("_spans"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("_items"))
    # sorted spans: each adds what lies beyond the furthest end before it
    covered = F.aggregate(
        "_spans", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["end"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["end"], s["start"]))).alias("n")),
        lambda acc: acc["n"].cast("long"))
    hits = per_doc.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k"), covered.alias("n_hit"),
                          F.size("_items").cast("long").alias("n_items"),
                          F.sha2(F.concat_ws(",", "_items"), 256).alias("items_sha256"))
    counted = rows.select("doc_id", "text_key", F.size(word_list(F.col("_text"))).cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return counted.join(hits, counted["doc_id"].eqNullSafe(hits["_d"]) & (counted["text_key"] == hits["_k"]), "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((n_hit > 0) & (SHARE * n_hit >= F.col("n_words"))).alias("contaminated"), "text_key")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs (doc_id, text, ...)`` that are not contaminated, all columns as they were."""
    bad = settle(decontaminate(docs, benchmark).where("contaminated").select(
        "doc_id", F.col("text_key").alias("key")).distinct(), "contaminated")
    return without(docs, bad)
