"""Near copies of paragraphs: MinHash bands, exact Jaccard, removal by components.

Paragraphs are lines with a word; one of fewer than five words is one shingle as a whole. Equal ones are one node from the start. The minima of 30 hashes over a node's five-word
shingles make ten bands of three; nodes that share a band are compared on their whole sets. At a similarity of 0.8 a pair
shares a band with probability 1 - (1 - 0.8**3)**10 = 0.9992. Of each component the first paragraph stays.

Passages within lines: a line is cut where the hash of ``GRAM`` words is the least of ``SPREAD`` neighbouring ones, so that a
passage of ``PASSAGE`` words has two cuts or more of its own, wherever it stands (unless such words repeat within it). Words
from one cut to the end of the next one's are a piece; of equal pieces the first stays, and the others go from long lines. With
``across_lines`` the words of a text are cut as one line, so that passages over several lines, and in lines of any length, are found too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from folioline.llm import arrays, linking, shingles
from folioline.llm.rows import packed, same, text_key
from folioline.llm.near_join import GROUPS_PER_PARTITION, _shared_tokens
from folioline.session import settle, ship_package

#: Lines of fewer words, those without any, are no paragraphs.
MIN_WORDS = 1
#: Sets of fewer shingles are similar to equal sets only, which are the same node, so they need no bands.
MIN_BANDED = shingles.PERCENT // (100 - shingles.PERCENT)
BANDS, ROWS = 10, 3
_SEEDS = arrays.mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))
#: Passages of so many words are found within lines; lines of fewer words have no pieces, and runs of fewer count as short.
PASSAGE = 50
#: Pieces are cut out of lines of more words; lines up to that go or stay as a whole.
LONG = 70
#: Words that decide about a cut, and the number of places of which one is cut: two windows of places fit into a passage.
GRAM = 8
SPREAD = (PASSAGE - GRAM + 1) // 2


def _paragraphs(t: arrays.Texts):
    """(word hashes, edges of the paragraphs in them, text of each paragraph, its line in the text)."""
    hashes, begins, _ = shingles.word_hashes(t)
    line_begins, line_ends = arrays.runs(t.data != 10, t.offsets)
    first, last = np.searchsorted(begins, line_begins), np.searchsorted(begins, line_ends)
    # lines are counted by the line feeds before them
    feeds = np.zeros(len(t.data) + 1, np.int64)
    np.cumsum(t.data == 10, out=feeds[1:])
    text = np.searchsorted(t.offsets, line_begins, "right") - 1
    line = feeds[line_begins] - feeds[t.offsets[text]]
    long = last - first >= MIN_WORDS
    return hashes, first[long], last[long], text[long], line[long]


def _sets(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ascending distinct shingles of all paragraphs in a row, edges of the paragraphs in them), as :func:`shingles.sets_of`."""
    n = last - first
    widths = np.maximum(n - shingles.WORDS + 1, 1)
    edges = np.concatenate([[0], np.cumsum(widths)])
    owner = np.repeat(np.arange(len(n)), widths)
    items = np.zeros(edges[-1], np.uint64)
    for size in range(1, shingles.WORDS + 1):
        whole = n == size if size < shingles.WORDS else n >= size
        if whole.any():
            mine = whole[owner]
            at = first[owner[mine]] + np.flatnonzero(mine) - edges[owner[mine]]
            items[mine] = arrays.window_hashes(hashes, size)[at] ^ np.uint64(size if size < shingles.WORDS else 0)
    order = np.lexsort((items, owner))
    items = items[order]
    once = np.ones(len(items), bool)
    once[1:] = (items[1:] != items[:-1]) | (owner[1:] != owner[:-1])
    return items[once], np.concatenate([[0], np.cumsum(once)])[edges]


def _nodes(items: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """:func:`shingles.digest` of each set; none is empty."""
    if len(edges) < 2:
        return np.zeros(0, np.int64)
    sums = np.add.reduceat(arrays.mix(items), edges[:-1])
    return arrays.mix(sums + np.diff(edges).astype(np.uint64)).view(np.int64)


def _slid(values: np.ndarray, size: int, best) -> np.ndarray:
    """``best`` (a minimum or maximum) of each value and the ``size - 1`` after it."""
    width = 1
    while 2 * width <= size:
        values = best(values[:-width], values[width:])
        width *= 2
    return best(values[:len(values) - (size - width)], values[size - width:])


def _pieces(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
    """(paragraph, first word in it, number of words, hash of the words) of each piece."""
    if not ((last - first) >= PASSAGE).any():
        return tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.int64, np.uint64))
    grams = arrays.window_hashes(hashes, GRAM)
    least = _slid(grams, SPREAD, np.minimum)
    line = np.searchsorted(first, np.arange(len(least)), "right") - 1
    within = (np.arange(len(least)) + SPREAD + GRAM - 1 <= last[line]) & ((last - first)[line] >= PASSAGE)
    none = np.zeros(SPREAD - 1, np.uint64)
    highest = _slid(np.concatenate([none, np.where(within, least, np.uint64(0)), none]), SPREAD, np.maximum)
    cuts = np.flatnonzero(highest == grams)
    # of words that repeat one after the other the first
    cuts = cuts[np.concatenate([[True], grams[cuts[1:]] != grams[cuts[:-1]]])] if len(cuts) else cuts
    line = np.searchsorted(first, cuts, "right") - 1
    same = line[1:] == line[:-1]
    begin, end, line = cuts[:-1][same], cuts[1:][same] + GRAM, line[:-1][same]
    up, down = arrays.powers(arrays.R, len(hashes)), arrays.powers(arrays.R_INVERSE, len(hashes))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[:len(hashes)], dtype=np.uint64)])
    keys = arrays.mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))
    return line, begin - first[line], end - begin, keys


_TABLE = "paragraphs array<struct<line: int, node: long, n: int>>, pieces array<struct<line: int, at: int, n: int, cut: boolean, piece: long>>"


def _digests(docs: DataFrame, text: str, keep: list[str], across_lines: bool) -> DataFrame:
    """``keep``, ``paragraphs`` and ``pieces``: arrays of what each row has; ``across_lines`` a text counts as line 0 as a whole."""
    def listed(owner: np.ndarray, rows: int, **columns: np.ndarray) -> pa.Array:
        items = pa.StructArray.from_arrays([pa.array(x) for x in columns.values()], list(columns))
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32)), items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in arrays.texts_of(batch.column(0)):
                hashes, first, last, owner, line = _paragraphs(t)
                nodes, line = _nodes(*_sets(hashes, first, last)), line.astype(np.int32)
                if across_lines:
                    edges = np.append(first, len(hashes))[np.searchsorted(owner, np.arange(len(t) + 1))]
                    which, at, n, keys = _pieces(hashes, edges[:-1], edges[1:])
                    of, on, cut = which, np.zeros(len(which), np.int32), np.ones(len(which), bool)
                else:
                    which, at, n, keys = _pieces(hashes, first, last)
                    of, on, cut = owner[which], line[which], (last - first)[which] > LONG
                kept = batch.slice(t.first, len(t)).columns[1:]
                yield pa.RecordBatch.from_arrays(kept + [
                    listed(owner, len(t), line=line, node=nodes, n=(last - first).astype(np.int32)),
                    listed(of, len(t), line=on, at=at.astype(np.int32), n=n.astype(np.int32), cut=cut, piece=keys.view(np.int64)),
                ], [*keep, "paragraphs", "pieces"])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [_TABLE])
    return docs.select(F.col(text).alias("_text"), *keep).mapInArrow(run, schema)


def _bands(docs: DataFrame, text: str, groups: int) -> DataFrame:
    """Bands of each paragraph not met before in the task, packed by group: (grp, tokens, nodes, sizes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in batches:
            for t in arrays.texts_of(batch.column(0)):
                hashes, first, last, _, _ = _paragraphs(t)
                items, edges = _sets(hashes, first, last)
                sets, nodes = [], []
                for node, a, b in zip(_nodes(items, edges).tolist(), edges[:-1].tolist(), edges[1:].tolist()):
                    if b - a >= MIN_BANDED and node not in known:
                        known.add(node)
                        sets.append(items[a:b])
                        nodes.append(node)
                if not sets:
                    continue
                sizes = np.array([len(s) for s in sets], np.int64)
                all_, starts = np.concatenate(sets), np.cumsum(sizes) - sizes
                keys = np.zeros((BANDS, len(sets)), np.uint64)
                for k, seed in enumerate(_SEEDS):
                    least = np.minimum.reduceat(arrays.mix(all_ ^ seed), starts)
                    keys[k // ROWS] = arrays.mix(keys[k // ROWS] + least + seed)
                tokens, nodes, sizes = keys.ravel(), np.tile(np.array(nodes, np.int64), BANDS), np.tile(sizes.astype(np.int32), BANDS)
                grp = (tokens % np.uint64(groups)).astype(np.int32)
                order = np.argsort(grp, kind="stable")
                parts = np.split(order, np.flatnonzero(np.diff(grp[order])) + 1)
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(grp[p[0]]) for p in parts], pa.int32()), *[
                        pa.array([x[p].tobytes() for p in parts], pa.binary()) for x in (tokens, nodes, sizes)]],
                    ["grp", "tokens", "nodes", "sizes"])

    return docs.select(F.col(text).alias("_text")).mapInArrow(run, "grp int, tokens binary, nodes binary, sizes binary")


def _sets_for(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """(node, items, sketch) of the ``wanted`` nodes."""
    bits = wanted.sparkSession.sparkContext.broadcast(linking.node_filter(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in batches:
            for t in arrays.texts_of(batch.column(0)):
                hashes, first, last, _, _ = _paragraphs(t)
                all_, edges = _sets(hashes, first, last)
                nodes, items = [], []
                for node, a, b in zip(_nodes(all_, edges).tolist(), edges[:-1].tolist(), edges[1:].tolist()):
                    if node not in known and linking.in_filter(bits.value, node):
                        known.add(node)
                        nodes.append(node)
                        items.append(all_[a:b])
                yield linking.set_rows(nodes, items)

    found = docs.select(F.col(text).alias("_text")).mapInArrow(run, linking.SET_ROWS)
    return found.join(wanted, "node", "left_semi").groupBy("node").agg(
        F.first("items").alias("items"), F.first("sketch").alias("sketch"))


def _repeated_pieces(table: DataFrame) -> DataFrame:
    """(_pd, _pk, passages): the pieces of long lines that stand at an earlier place too."""
    each = table.select("doc_id", "key", F.explode("pieces").alias("p")).select("doc_id", "key", "p.*")
    # most pieces are met once; only the others are put in order
    several = each.groupBy("piece").agg(F.count("*").alias("m")).where("m > 1").select("piece")
    again = settle(each.join(settle(several, "several"), "piece"), "pieces")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "line", "at")
    first = again.groupBy("piece").agg(F.min(place).alias("stays"))
    return again.join(first, "piece").where("cut").where(place != F.col("stays")).groupBy(
        F.col("doc_id").alias("_pd"), F.col("key").alias("_pk")).agg(
        F.array_sort(F.collect_set(F.struct("line", "at", "n"))).alias("passages"))


def _short(gone: Column) -> Column:
    """How many of the paragraphs ``(i, line, n)`` are in runs, one beside the other, of fewer than ``PASSAGE`` words in all."""
    def state(i, words, lines, short):
        return F.struct(i.cast("int").alias("i"), words.cast("long").alias("words"), lines.cast("long").alias("lines"), short.cast("long").alias("short"))

    def ended(s):
        return s["short"] + F.when(s["words"] < PASSAGE, s["lines"]).otherwise(0)

    def step(s, p):
        on = p["i"] == s["i"] + 1
        return F.when(on, state(p["i"], s["words"] + p["n"], s["lines"] + 1, s["short"])).otherwise(
            state(p["i"], p["n"], F.lit(1), ended(s)))

    return F.aggregate(gone, state(*[F.lit(x) for x in (-2, 0, 0, 0)]), step, ended)


def _in_lines(paragraphs, pieces, gone):
    """(passages, n_short): ``pieces`` of a text as spans of the lines that stay, and how many of the ``gone`` are in short runs without
    a word of a piece."""
    if pieces is None:
        return None
    gone = gone or []
    removed, touched, passages = {g["line"] for g in gone}, set(), []
    spans: list[list[int]] = []
    for p in sorted(pieces, key=lambda p: p["at"]):
        if spans and p["at"] <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], p["at"] + p["n"])
        else:
            spans.append([p["at"], p["at"] + p["n"]])
    begin = k = 0
    for p in paragraphs:
        end = begin + p["n"]
        while k < len(spans) and spans[k][0] < end:
            touched.add(p["line"])
            if p["line"] not in removed:
                passages.append((p["line"], max(begin, spans[k][0]) - begin, min(end, spans[k][1]) - max(begin, spans[k][0])))
            if spans[k][1] > end:
                break
            k += 1
        begin = end
    n_short, run = 0, []
    for g in [*gone, None]:
        if run and (g is None or g["i"] != run[-1]["i"] + 1):
            if sum(r["n"] for r in run) < PASSAGE:
                n_short += sum(r["line"] not in touched for r in run)
            run = []
        run.append(g)
    return passages, n_short


def repeated_paragraphs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", across_lines: bool = False) -> DataFrame:
    """(doc_id, key, n_paragraphs, removed, n_short, passages) for each row: ``removed`` are the lines, counted from 0, that are near
    copies of a paragraph in a document of a smaller id or in an earlier line, ``n_short`` how many of them are in runs, one beside the
    other, of fewer than ``PASSAGE`` words. ``passages (line, at, n)`` are the pieces, ``n`` words from word ``at`` on, counted from 0, that stand at an
    earlier place too, of lines of more than ``LONG`` words that are not removed as a whole. Pieces may overlap.

    ``across_lines``: texts of ``PASSAGE`` words are cut without regard to lines. ``passages`` are then the repeated words of all lines
    that are not removed, whatever their length, a span each, and removed lines with words of a repeated piece are not short.

    Null and empty texts have no paragraphs. ``key`` is a hash of the text: rows of one id stand for documents of
    their own, in the order of their keys; rows that repeat in full are judged alike. Null ids come last.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("key"), F.col(text).alias("_text"))
    table = settle(_digests(rows, "_text", ["doc_id", "key"], across_lines), "paragraphs")
    groups = GROUPS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = _bands(rows, "_text", groups).groupBy("grp").applyInArrow(_shared_tokens, "node long, n int, token long, df int")
    index = settle(shared.select(F.col("token").alias("key"), "node"), "bands")
    sets = settle(_sets_for(rows, "_text", settle(index.select("node").distinct(), "candidates")), "sets")
    linked = linking.link(index, sets, shingles.PERCENT)

    each = table.select("doc_id", "key", F.posexplode("paragraphs").alias("i", "p")).select("doc_id", "key", "i", "p.line", "p.node", "p.n")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "line")
    nodes = each.groupBy("node").agg(F.min(place).alias("first"), F.count("*").alias("m"))
    joined = settle(nodes.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node")), "nodes")
    kept = joined.groupBy("component").agg(F.min("first").alias("stays"), F.sum("m").alias("all")).where(F.col("all") > 1)
    several = settle(joined.join(kept, "component").select("node", "stays"), "several")
    gone = each.join(several, "node").where(place != F.col("stays")).groupBy(
        F.col("doc_id").alias("_d"), F.col("key").alias("_k")).agg(
        F.array_sort(F.collect_set(F.struct("i", "line", "n"))).alias("gone")).select(
        "_d", "_k", "gone", F.col("gone.line").alias("removed"), _short(F.col("gone")).alias("n_short"))
    alike = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("key") == F.col("_k"))
    alike_too = F.col("doc_id").eqNullSafe(F.col("_pd")) & (F.col("key") == F.col("_pk"))
    met = table.select("doc_id", "key", "paragraphs", F.size("paragraphs").cast("long").alias("n_paragraphs")).join(gone, alike, "left").join(
        _repeated_pieces(table), alike_too, "left")
    none = F.array().cast("array<struct<line: int, at: int, n: int>>")
    if across_lines:
        split = F.udf(_in_lines, "passages array<struct<line: int, at: int, n: int>>, n_short long")
        met = met.withColumn("split", split(F.when(F.col("passages").isNotNull(), F.col("paragraphs")), "passages", "gone"))
        met = met.withColumn("passages", F.col("split.passages")).withColumn("n_short", F.coalesce("split.n_short", "n_short"))
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return met.select("doc_id", "key", "n_paragraphs", removed.alias("removed"), F.coalesce("n_short", F.lit(0).cast("long")).alias("n_short"),
                      F.filter(F.coalesce("passages", none), lambda p: ~F.array_contains(removed, p["line"])).alias("passages"))


_WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def _without_passages(text, passages):
    """``text`` without the words of its ``passages`` and what is between these."""
    if not passages:
        return text
    lines = text.split("\n")
    spans: dict[int, list] = {}
    for p in passages:
        spans.setdefault(p["line"], []).append((p["at"], p["at"] + p["n"]))
    for i, cuts in spans.items():
        words = [m.span() for m in _WORD.finditer(lines[i])]
        left, done = [], 0
        for a, b in sorted(cuts):
            left.append(lines[i][done:max(done, words[a][0])])
            done = max(done, words[b - 1][1])
        lines[i] = "".join(left) + lines[i][done:]
    return "\n".join(lines)


def remove_paragraphs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", across_lines: bool = False) -> DataFrame:
    """``docs`` without the lines and passages that :func:`repeated_paragraphs` finds; no row goes, and texts without any are as they were.

    A line of which passages go stays a line.
    """
    found = repeated_paragraphs(docs, doc_id, text, across_lines).where((F.size("removed") > 0) | (F.size("passages") > 0))
    cut = settle(found.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), F.col("removed").alias("_lines"), F.col("passages").alias(
        "_passages")).dropDuplicates(["_d", "_k"]), "removed")
    table = packed(docs, text, doc_id=doc_id)
    met = table.join(cut, same(table, cut), "left")
    own = F.col(f"row.`{text}`")
    # words are told apart as in the operator: by these bytes only
    shorter = F.when(F.size("_passages") > 0, F.udf(_without_passages, T.StringType())(own, "_passages")).otherwise(own)
    left = F.array_join(F.filter(F.split(shorter, "\n"), lambda _, i: ~F.array_contains("_lines", i)), "\n")
    new = F.when(F.col("_lines").isNull(), own).otherwise(left)
    return met.select(*[new.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
