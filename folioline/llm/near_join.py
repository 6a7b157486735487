"""Near-copy join of documents on word shingles: parts that must agree, the most frequent ones left out, then exact sets.

Two sets of Jaccard similarity 0.8 or more differ in at most a ninth of their joint number of tokens. Sets are put into
classes by size, and the tokens of a set are dealt by hash to a number of parts that is fixed for the class: more
than there can be unlike tokens, so that some parts, ``SPARE`` and one more, have the same tokens in both. The key of a part is a
hash of all its tokens; documents that merely share passages seldom have a part in common, near copies have many.

Each set leaves out as many of its parts as are spare, the most frequent ones by a count over all sets, ties by
key. Of the parts that two similar sets have in common, the rarest is left out by neither. Candidates have such a part in
common. Their whole sets are then compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from folioline.llm import arrays, linking, rows, shingles
from folioline.session import settle, ship_package

#: Keys are dealt to so many groups by their hash for each shuffle partition.
GROUPS_PER_PARTITION = 4
#: The same of parts; with fewer groups a set's number is stored fewer times.
PART_GROUPS_PER_PARTITION = 1
#: Parts are made of runs of rows of about so many bytes.
PART_BYTES = 1 << 19
#: A token counted in more than one of so many documents counts as frequent: parts without any other token are the first to be
#: left out, and documents that have them are not gathered.
FREQUENT_SHARE = 200
#: In a run of rows a token is counted for that from so many documents on.
FREQUENT_SEEN = 4
#: At most so many frequent tokens (8 bytes each) are sent to all executors.
MAX_FREQUENT = 1 << 18


def _least_sizes() -> np.ndarray:
    """The least size of each class. A set and a similar smaller one are of one class or of neighbouring ones."""
    sizes = [1]
    while sizes[-1] < 2**31:
        sizes.append(sizes[-1] * 5 // 4 + 1)
    return np.array(sizes, np.int64)


_LEAST = _least_sizes()
#: By class: how many tokens two similar sets may have that the other has not; how many parts are left out; how many there are.
_UNLIKE = 2 * (_LEAST[1:] - 1) // 9
SPARE = 2 + _UNLIKE // 4
_PARTS = _UNLIKE + 1 + SPARE
#: Bytes of a key that are shuffled, beside its group.
_KEY_BYTES = 5


def set_digests(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep``, ``n_shingles``, ``node`` (a number for the set; null if it is empty), and tokens frequent in a run of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in arrays.texts_of(batch.column(0)):
                words, _, edges = shingles.word_hashes(t)
                sets = shingles.sets_of(words, edges)
                nodes = [shingles.digest(s) if len(s) else None for s in sets]
                unlike = {k: s for k, s in zip(nodes, sets) if k is not None}
                tokens, counts = np.unique(np.concatenate(list(unlike.values()) or [np.zeros(0, np.uint64)]), return_counts=True)
                often = counts >= FREQUENT_SEEN
                seen = [None] * len(t)
                if often.any():
                    seen[0] = [{"token": a, "n": b} for a, b in zip(tokens[often].view(np.int64).tolist(), counts[often].tolist())]
                kept = batch.slice(t.first, len(t)).columns[1:]
                yield pa.RecordBatch.from_arrays(kept + [
                    pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.int64()), pa.array(seen, kind)], names)

    kind = pa.list_(pa.struct([("token", pa.int64()), ("n", pa.int64())]))
    names = [*keep, "n_shingles", "node", "seen"]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [
        "n_shingles long", "node long", "seen array<struct<token: long, n: long>>"])
    return docs.select(F.col(text).alias("_text"), *keep).mapInArrow(run, schema)


def _part_keys(sets: list[np.ndarray], frequent: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(number of the set, class, key, whether no token of it is rare) of each part: first in the sets' own classes, then in the next.

    A set has parts in the next class if it may be similar to a set of that. Sets of so few tokens that only equal ones are
    similar have none.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    tokens = np.concatenate(sets)
    hashes = arrays.mix(tokens)
    rare = ~np.isin(tokens, frequent)
    own = np.searchsorted(_LEAST, sizes, "right") - 1
    for kind in (own, own + 1):
        fits = (5 * sizes >= 4 * _LEAST[kind]) & (_UNLIKE[kind] > 0)
        parts = np.where(fits, _PARTS[kind], 0)
        begins = np.cumsum(parts) - parts
        all_ = int(parts.sum())
        mine = np.repeat(fits, sizes)
        h = hashes[mine]
        place = np.repeat(begins, sizes)[mine] + (h % np.repeat(parts, sizes)[mine].astype(np.uint64)).astype(np.int64)
        # sums of halves, which a float holds exactly
        low = np.bincount(place, h & np.uint64(0xFFFFFFFF), all_).astype(np.uint64)
        high = np.bincount(place, h >> np.uint64(32), all_).astype(np.uint64)
        owner = np.repeat(np.arange(len(sets)), parts)
        number = (np.arange(all_) - begins[owner]).astype(np.uint64)
        own_kind = kind[owner].astype(np.uint64)
        keys = arrays.mix(low + (high << np.uint64(32)) + arrays.mix((own_kind << np.uint64(32)) + number + np.uint64(1)))
        yield owner, kind[owner], keys, np.bincount(place, rare[mine], all_) == 0


def _part_groups(docs: DataFrame, text: str, frequent, groups: int) -> DataFrame:
    """Parts of each set, one row for each run of rows and group of keys: (grp, keys, nodes, kinds).

    Parts without a rare token are dealt by their nodes, to groups from ``groups`` on. Sets met before in the task are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in batches:
            for t in arrays.texts_of(batch.column(0), PART_BYTES):
                words, _, edges = shingles.word_hashes(t)
                sets, nodes = [], []
                for s in shingles.sets_of(words, edges):
                    if len(s) and (node := shingles.digest(s)) not in known:
                        known.add(node)
                        sets.append(s)
                        nodes.append(node)
                if not sets:
                    continue
                owner, kind, keys, often = map(np.concatenate, zip(*_part_keys(sets, frequent.value)))
                if not len(keys):
                    continue
                node = np.array(nodes, np.int64)
                grp = np.where(often, groups + _group_of(node, groups)[owner], (keys % np.uint64(groups)).astype(np.int32))
                order = np.lexsort((owner, grp))
                grp, owner = grp[order], owner[order]
                short = np.ascontiguousarray((keys[order] // np.uint64(groups)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_KEY_BYTES])
                yield _packed_rows(grp, {"keys": short, "nodes": node[owner], "kinds": kind[order].astype(np.uint8)})

    return docs.select(F.col(text).alias("_text")).mapInArrow(run, "grp int, keys binary, nodes binary, kinds binary")


def _group_of(nodes: np.ndarray, groups: int) -> np.ndarray:
    return (arrays.mix(nodes.view(np.uint64)) % np.uint64(groups)).astype(np.int32)


def _packed_rows(grp: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """A row for each group, by which the columns are sorted."""
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(grp)) + 1, [len(grp)]]).tolist() if len(grp) else [0]
    spans = list(zip(cuts[:-1], cuts[1:]))
    return pa.RecordBatch.from_arrays([pa.array(grp[cuts[:-1]], pa.int32()), *[
        pa.array([x[a:b].tobytes() for a, b in spans], pa.binary()) for x in columns.values()]], ["grp", *columns])


def _unpacked(row, kinds=(np.int64, np.int64, np.int32)) -> tuple[np.ndarray, ...]:
    return tuple(np.concatenate([np.frombuffer(x.as_buffer(), k) for x in column] or [np.zeros(0, k)])
                 for column, k in zip(row, kinds))


def _unpacked_parts(row, grp: int) -> tuple[np.ndarray, ...]:
    """(token, node, class) of each part; the token is the key with its group."""
    short, nodes, kinds = _unpacked(row, (np.uint8, np.int64, np.uint8))
    tokens = np.zeros((len(nodes), 8), np.uint8)
    tokens[:, :_KEY_BYTES] = short.reshape(-1, _KEY_BYTES)
    return (tokens.view("<i8")[:, 0] << 22) + grp + 1, nodes, kinds


def _shared(tokens: np.ndarray, nodes: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows, each once, whose token is of two nodes or more: the columns and the number ``df`` of these nodes."""
    order = np.argsort(tokens)
    t = tokens[order]
    same = t[1:] == t[:-1]
    order = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])] if len(t) else order
    order = order[np.lexsort((nodes[order], tokens[order]))]
    tokens, nodes, *others = (x[order] for x in (tokens, nodes, *others))
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (nodes[1:] != nodes[:-1])
    tokens, nodes, *others = (x[new] for x in (tokens, nodes, *others))
    starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.zeros(0, np.int64)
    df = np.diff(np.append(starts, len(tokens)))
    df = np.repeat(df, df).astype(np.int32)
    return tuple(x[df > 1] for x in (tokens, nodes, *others, df))


def _shared_tokens(table: pa.Table) -> pa.Table:
    """Of one group: tokens that two sets or more have, with their number ``df``, for each of these sets."""
    tokens, nodes, sizes, df = _shared(*_unpacked([table.column(c).combine_chunks() for c in ("tokens", "nodes", "sizes")]))
    return pa.table({"node": nodes, "n": sizes, "token": tokens, "df": df})


_BY_NODE = "grp int, tokens binary, nodes binary, kinds binary, dfs binary"


def _by_node(tokens: np.ndarray, nodes: np.ndarray, kinds: np.ndarray, df: np.ndarray, groups: int) -> pa.RecordBatch:
    """Parts dealt to groups by their nodes."""
    grp = _group_of(nodes, groups)
    order = np.lexsort((nodes, grp))
    return _packed_rows(grp[order], {"tokens": tokens[order], "nodes": nodes[order], "kinds": kinds[order], "dfs": df[order]})


def _shared_parts(table: pa.Table, groups: int) -> pa.Table:
    """Of one group: parts that two sets or more have, with their number, for each of these sets; of a group by nodes all parts."""
    row = [table.column(c).combine_chunks() for c in ("keys", "nodes", "kinds")]
    grp = table.column("grp")[0].as_py()
    if grp < groups:
        found = _shared(*_unpacked_parts(row, grp))
    else:
        parts = _unpacked_parts(row, -1)
        found = (*parts, np.full(len(parts[0]), 2**31 - 1, np.int32))
    return pa.Table.from_batches([_by_node(*found, groups)])


def _rarest_parts(table: pa.Table) -> pa.Table:
    """(key, node) of the parts that each set of one group does not leave out.

    Parts that no other set has are the rarest, so what is left out is among the given ones.
    """
    tokens, nodes, kinds, df = _unpacked([table.column(c).combine_chunks() for c in ("tokens", "nodes", "kinds", "dfs")],
                                         (np.int64, np.int64, np.uint8, np.int32))
    order = np.lexsort((tokens, df, kinds, nodes))[::-1]
    tokens, nodes, kinds = tokens[order], nodes[order], kinds[order]
    same = (nodes[1:] == nodes[:-1]) & (kinds[1:] == kinds[:-1])
    once = np.ones(len(tokens), bool)
    once[1:] = ~same | (tokens[1:] != tokens[:-1])
    tokens, nodes, kinds = tokens[once], nodes[once], kinds[once]
    new = np.ones(len(tokens), bool)
    new[1:] = (nodes[1:] != nodes[:-1]) | (kinds[1:] != kinds[:-1])
    begins = np.flatnonzero(new)
    place = np.arange(len(tokens)) - np.repeat(begins, np.diff(np.append(begins, len(tokens))))
    kept = place >= SPARE[kinds]
    return pa.table({"key": tokens[kept], "node": nodes[kept]})


def _sets_for(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """(node, items, sketch) of the ``wanted`` nodes."""
    bits = linking.node_filter(wanted)
    shared = wanted.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in batches:
            for t in arrays.texts_of(batch.column(0)):
                words, _, edges = shingles.word_hashes(t)
                nodes, items = [], []
                for s in shingles.sets_of(words, edges):
                    if len(s) and (node := shingles.digest(s)) not in known and linking.in_filter(shared.value, node):
                        known.add(node)
                        nodes.append(node)
                        items.append(s)
                yield linking.set_rows(nodes, items)

    found = docs.select(F.col(text).alias("_text")).mapInArrow(run, linking.SET_ROWS)
    return found.join(wanted, "node", "left_semi").groupBy("node").agg(
        F.first("items").alias("items"), F.first("sketch").alias("sketch"))


def near_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_shingles, component_id, component) and the columns ``keep`` for each row of ``docs``.

    Rows of equal sets are one node from the start. ``component_id`` is the least doc_id that is reached by links of
    80 per cent; null and empty texts, and rows of words in no set, reach only themselves. Rows that share an id are judged
    by their own texts. Ids that are null never name a component with others in it. ``component`` is the group's own
    number, null for empty sets.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"), *keep)
    stats = settle(set_digests(texts, "_text", ["doc_id", *keep]), "digests")
    members = stats.select("doc_id", "n_shingles", "node", *keep)
    total = members.select("node").count()
    counted = stats.where(F.col("seen").isNotNull()).select(F.explode("seen").alias("s")).groupBy(
        F.col("s.token").alias("token")).agg(F.sum("s.n").alias("n")).where(F.col("n") * FREQUENT_SHARE > total)
    # by their counts there are few; the limit only bounds what is broadcast, not what is found
    frequent = counted.orderBy(F.col("n").desc(), "token").limit(MAX_FREQUENT).select("token").toPandas()["token"].to_numpy(np.int64)
    frequent = spark.sparkContext.broadcast(np.sort(frequent.view(np.uint64)))

    groups = PART_GROUPS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = _part_groups(texts, "_text", frequent, groups)
    shared = packed.groupBy("grp").applyInArrow(lambda table: _shared_parts(table, groups), _BY_NODE)
    index = settle(shared.groupBy("grp").applyInArrow(_rarest_parts, "key long, node long"), "parts")
    met = index.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key")
    index = settle(index.join(met, "key", "left_semi"), "parts")
    wanted = settle(index.select("node").distinct(), "candidates")
    sets = settle(_sets_for(texts, "_text", wanted), "sets")
    linked = linking.link(index, sets, shingles.PERCENT)

    classes = members.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("least"))
    joined = classes.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    named = settle(joined.join(least, "component").select("node", "component", "component_id"), "named")
    return members.join(named, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "component", *keep)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs (doc_id, text, ...)`` but for near copies: of each group the row with the least id stays.

    Of rows that repeat one id and text one stays; null ids come last. Texts without words all stay.
    """
    table = rows.packed(docs)
    labels = near_copies(table.select("doc_id", "key", F.col("row.text").alias("text")), keep=("key",))
    labels = settle(labels.where(F.col("component").isNotNull()).select(
        "component", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key").alias("at")), "labels")
    first = labels.groupBy("component").agg(F.min("at").alias("first"), F.count("*").alias("m")).where("m > 1")
    grouped = settle(labels.join(first, "component"), "groups")
    lost = settle(grouped.where(F.col("at") != F.col("first")).select("at.doc_id", "at.key").distinct(), "lost")
    again = settle(grouped.where(F.col("at") == F.col("first")).groupBy("at").count().where("count > 1").select(
        F.col("at.doc_id").alias("_d"), F.col("at.key").alias("_k")), "again")
    kept = rows.without(docs, lost)
    if again.take(1):
        kept = rows.packed(kept)
        twice = rows.same(kept, again)
        kept = rows.unpacked(kept.join(again, twice, "left_anti").unionByName(
            kept.join(again, twice, "left_semi").dropDuplicates(["doc_id", "key"])))
    return kept
