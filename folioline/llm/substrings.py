"""Removal of repeated byte strings by blockwise sorting of sampled suffixes.

Sorting every suffix needs many times the space of the corpus. As only strings of 50 bytes matter, a
synchronising sample of the suffixes does: of each 50-byte window the 16-byte string with the least hash is the anchor,
wherever the window stands, and neighbouring windows mostly have the same one. So an occurrence of an
anchor stands for a run of windows, about one for each 18 bytes. Suffixes that begin at anchors are dealt to
buckets by the anchor, and one bucket at a time is sorted:

* runs that are equal as a whole, bytes and all, are settled at once: every document but the first loses them;
* the other runs of an anchor (ties of the anchor that break further on, at the borders of a shared passage) fetch their bytes, from
  the first document of each unlike run wherever it holds the run, and are sorted window by window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from folioline.llm import arrays
from folioline.llm.rows import text_key
from folioline.session import settle, ship_package

LENGTH = 50
ANCHOR = 16
_PLACES = LENGTH - ANCHOR + 1
#: Buckets for each shuffle partition.
BUCKETS_PER_PARTITION = 4
#: The id of rows without one: later than all others.
NO_ID = 2**63 - 1


def anchored_runs(t: arrays.Texts) -> tuple[np.ndarray, ...]:
    """(text, first window, number of windows, hash of the anchor, hash of all their bytes) of each run of windows."""
    lengths = np.diff(t.offsets)
    n = len(t.data)
    if n < LENGTH or not (lengths >= LENGTH).any():
        return tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    sums = arrays.prefix_hashes(t.data)
    at = np.arange(n - ANCHOR + 1)
    h = arrays.span_hashes(sums, at, at + ANCHOR)
    # place of the least hash in 1, 2, 4, ... places from each one on; of equals the left one
    best, width = at, 1
    while width * 2 <= _PLACES:
        left, right = best[:-width], best[width:]
        best, width = np.where(h[right] < h[left], right, left), width * 2
    left, right = best[:len(best) - (_PLACES - width)], best[_PLACES - width:]
    best = np.where(h[right] < h[left], right, left)[:n - LENGTH + 1]

    whole = np.ones(n - LENGTH + 1, bool)  # windows that lie within one text
    fits = t.offsets[1:][(t.offsets[1:] < n) & (t.offsets[1:] > 0)]
    for back in range(1, LENGTH):
        at_edge = fits - back
        whole[at_edge[(at_edge >= 0) & (at_edge < len(whole))]] = False
    new = whole.copy()
    new[1:] &= (best[1:] != best[:-1]) | ~whole[:-1]
    # texts that touch: the last window of one is never followed directly by the first of the next
    starts = np.flatnonzero(new)
    stop = whole.copy()
    stop[:-1] &= new[1:] | ~whole[1:]
    ends = np.flatnonzero(stop) + 1
    texts = np.searchsorted(t.offsets, starts, "right") - 1
    return texts, starts, ends - starts, h[best[starts]], arrays.span_hashes(sums, starts, ends - 1 + LENGTH)


#: The upper parts of ids and places hardly change from one to the next and take no room once the shuffle is compressed.
_PACK = ("bucket int, anchors binary, wholes binary, docs binary, upper_docs binary, keys binary, counts binary, starts binary, "
         "upper_starts binary, windows binary")
_FOUND = pa.schema([("kind", pa.int8()), ("doc", pa.int64()), ("key", pa.int32()), ("start", pa.int32()),
                    ("n", pa.int16()), ("anchor", pa.int64())])
REMOVED, UNSETTLED = 0, 1


def _cut(values: np.ndarray, size: int) -> bytes:
    """The low ``size`` bytes of each number."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _joined(data: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(data) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8).reshape(-1, size)
    return out.view("<u8")[:, 0]


def _pack_runs(buckets: int):
    """Runs of all texts, a row for each run of rows and bucket; ids once for each document in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, keys = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for t in arrays.texts_of(batch.column(0)):
                text, start, n, anchor, whole = anchored_runs(t)
                if not len(text):
                    continue
                bucket = (anchor % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.diff(bucket[order])) + 1
                rows = []
                for part in np.split(order, cuts):
                    inside = text[part]
                    own, first = np.unique(inside, return_index=True)
                    counts = np.diff(np.append(first, len(inside)))
                    ids, places = docs[t.first + own], start[part] - t.offsets[inside]
                    rows.append((int(bucket[part[0]]), _cut(anchor[part] // np.uint64(buckets), 5), _cut(whole[part], 6),
                                 ids.astype(np.uint16).tobytes(), (ids >> 16).tobytes(), keys[t.first + own].tobytes(),
                                 counts.astype(np.int32).tobytes(), places.astype(np.uint16).tobytes(),
                                 (places >> 16).astype(np.uint16).tobytes(), n[part].astype(np.uint8).tobytes()))
                columns = [pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(zip(*rows))]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _PACK.split(", ")])
    return run


def _settle_bucket(table: pa.Table) -> pa.Table:
    """Of one bucket: runs that an earlier document has as a whole, and the runs of first documents to be looked at closely."""
    rows = table.to_pydict()
    anchor = np.concatenate([_joined(x, 5) for x in rows["anchors"]])
    whole = np.concatenate([_joined(x, 6) for x in rows["wholes"]])
    counts = np.frombuffer(b"".join(rows["counts"]), np.int32)
    doc = np.repeat((np.frombuffer(b"".join(rows["upper_docs"]), np.int64) << 16) + np.frombuffer(b"".join(rows["docs"]), np.uint16), counts)
    key = np.repeat(np.frombuffer(b"".join(rows["keys"]), np.int32), counts)
    start = (np.frombuffer(b"".join(rows["upper_starts"]), np.uint16).astype(np.int32) << 16) + np.frombuffer(b"".join(rows["starts"]), np.uint16)
    n = np.frombuffer(b"".join(rows["windows"]), np.uint8)
    order = np.lexsort((start, key, doc, whole, anchor))
    anchor, whole, doc, key, start, n = (x[order] for x in (anchor, whole, doc, key, start, n))
    new_anchor = np.concatenate([[True], anchor[1:] != anchor[:-1]])
    new_whole = new_anchor | np.concatenate([[True], whole[1:] != whole[:-1]])
    anchors, wholes = np.flatnonzero(new_anchor), np.flatnonzero(new_whole)
    first_doc = np.repeat(doc[wholes], np.diff(np.append(wholes, len(doc))))
    removed = doc > first_doc
    # anchors with several unlike runs, in several documents: every occurrence in the first document of a run, as each may lose
    # windows to an earlier document; the least document of an anchor loses none, so there one stands for all
    sizes = np.diff(np.append(anchors, len(doc)))
    least, most = np.minimum.reduceat(doc, anchors), np.maximum.reduceat(doc, anchors)
    unlike = np.add.reduceat(new_whole.astype(np.int64), anchors)
    close = np.repeat((unlike > 1) & (least < most), sizes) & ~removed & (new_whole | (doc > np.repeat(least, sizes)))
    pick = np.concatenate([np.flatnonzero(removed), np.flatnonzero(close)])
    kind = np.concatenate([np.full(removed.sum(), REMOVED, np.int8), np.full(close.sum(), UNSETTLED, np.int8)])
    return pa.Table.from_arrays([pa.array(kind), pa.array(doc[pick]), pa.array(key[pick]), pa.array(start[pick]),
                                 pa.array(n[pick].astype(np.int16)), pa.array(anchor[pick].view(np.int64))], schema=_FOUND)


def _identified(docs: DataFrame, doc_id: str, text: str, *more: Column) -> DataFrame:
    """(doc, key, data, more): the id, a number that tells rows of one id apart by their texts, the bytes, and what else is asked for."""
    ids = docs.groupBy(doc_id).count().where("count > 1")
    key = text_key(text).bitwiseAND(0x7FFFFFFF).cast("int") if ids.take(1) else F.lit(0)
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"), key.alias("key"),
                       F.col(text).alias("data"), *more)


def _others(rows: DataFrame) -> list[T.StructField]:
    return [f for f in rows.schema if f.name not in ("doc", "key", "data", "zipped")]


def _compressed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``zipped`` (null texts: null) in place of ``data``, for a shuffle of whole texts."""
    names = ["doc", "key", *[f.name for f in _others(rows)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            data = [zip_.compress(x.as_buffer()) if x.is_valid else None for x in batch.column(0).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary()), *batch.columns[1:]], ["zipped", *names])

    # keys are never null, so that no join filters them and all joins of the texts have one shuffle
    schema = T.StructType([T.StructField("zipped", T.BinaryType()), T.StructField("doc", T.LongType(), False),
                           T.StructField("key", T.IntegerType(), False), *_others(rows)])
    return rows.select("data", *names).mapInArrow(run, schema)


def _fetch_runs(buckets: int):
    """The bytes of the asked runs, packed by bucket of their anchor."""
    names = ["bucket", "docs", "keys", "starts", "windows", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        zip_ = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packs: dict[int, list] = {}
            for doc, key, zipped, asked in zip(*[batch.column(c) for c in ("doc", "key", "zipped", "asked")]):
                text = unzip.decompress(zipped.as_py())
                for start, n, anchor in zip(*[asked.values.field(i).to_pylist() for i in range(3)]):
                    packs.setdefault(anchor % buckets, []).append((doc.as_py(), key.as_py(), start, n, text[start:start + n - 1 + LENGTH]))
            rows = []
            for bucket, found in packs.items():
                doc, key, start, n, data = zip(*found)
                rows.append((bucket, np.array(doc, np.int64).tobytes(), np.array(key, np.int32).tobytes(), np.array(start, np.int32).tobytes(),
                             np.array(n, np.int32).tobytes(), zip_.compress(b"".join(data))))
            columns = [pa.array([r[i] for r in rows], pa.int32() if i == 0 else pa.binary()) for i in range(6)]
            yield pa.RecordBatch.from_arrays(columns, names)
    return run


_SPANS = pa.schema([("doc", pa.int64()), ("key", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])


def _sort_windows(table: pa.Table) -> pa.Table:
    """Of one bucket of runs: windows that an earlier document has, as spans."""
    rows = table.to_pydict()
    doc, key, start, n = (np.frombuffer(b"".join(rows[c]), k) for c, k in zip(
        ("docs", "keys", "starts", "windows"), (np.int64, np.int32, np.int32, np.int32)))
    unzip = zstandard.ZstdDecompressor()
    data = np.frombuffer(b"".join(unzip.decompress(x) for x in rows["data"]), np.uint8)
    lengths = n.astype(np.int64) - 1 + LENGTH
    begins = np.cumsum(lengths) - lengths
    n = n.astype(np.int64)
    which = np.repeat(np.arange(len(n)), n)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = begins[which] + within
    hashes = arrays.span_hashes(arrays.prefix_hashes(data), at, at + LENGTH)
    owner = doc[which]
    order = np.lexsort((owner, hashes))
    h, d = hashes[order], owner[order]
    new = np.concatenate([[True], h[1:] != h[:-1]])
    least = np.repeat(d[new], np.diff(np.append(np.flatnonzero(new), len(d))))
    gone = np.zeros(len(at), bool)
    gone[order] = d > least
    # neighbouring windows of a run as one span
    begin = gone.copy()
    begin[1:] &= ~(gone[:-1] & (which[1:] == which[:-1]))
    stop = gone.copy()
    stop[:-1] &= ~(gone[1:] & (which[1:] == which[:-1]))
    b, e = np.flatnonzero(begin), np.flatnonzero(stop)
    w = which[b]
    return pa.Table.from_arrays([pa.array(doc[w]), pa.array(key[w]), pa.array((start[w] + within[b]).astype(np.int32)),
                                 pa.array((start[w] + within[e] + LENGTH).astype(np.int32))], schema=_SPANS)


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, key, start, end): byte spans, unmerged, whose 50-byte strings all start in a document of a smaller id too."""
    ship_package(docs.sparkSession)
    rows = _identified(docs, doc_id, text)
    return _spans(rows, _compressed(rows))


def _spans(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """``texts`` are the ``rows``, compressed."""
    spark = rows.sparkSession
    buckets = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = rows.select("data", "doc", "key").mapInArrow(_pack_runs(buckets), _PACK)
    found = settle(packed.groupBy("bucket").applyInArrow(
        _settle_bucket, "kind byte, doc long, key int, start int, n short, anchor long"), "runs")
    removed = found.where(F.col("kind") == REMOVED).select(
        "doc", "key", "start", (F.col("start") + F.col("n") - 1 + LENGTH).alias("end"))
    asked = found.where(F.col("kind") == UNSETTLED).groupBy("doc", "key").agg(
        F.collect_list(F.struct("start", "n", "anchor")).alias("asked"))
    fetched = texts.join(asked, ["doc", "key"]).mapInArrow(
        _fetch_runs(buckets), "bucket int, docs binary, keys binary, starts binary, windows binary, data binary")
    closer = fetched.groupBy("bucket").applyInArrow(_sort_windows, "doc long, key int, start int, end int")
    return removed.unionByName(closer)


def _cut_out(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, int, int]:
    """(bytes that are left, how many are gone, number of maximal removed runs)."""
    if not len(starts):
        return data.tobytes(), 0, 0
    edges = np.zeros(len(data) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, ends, -1)
    gone = np.cumsum(edges[:-1]) > 0
    n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return data[~gone].tobytes(), int(gone.sum()), n_spans


#: Rows that a task cuts before it gives them on.
_CUT_ROWS = 500


def _each_kept(rows: DataFrame, make, made: dict[str, pa.DataType]) -> DataFrame:
    """(doc, key, what else ``rows`` have, ``made``) of each row: ``make(length, left over, gone, spans)`` after removal; the length is null
    where the text is.

    The texts are shuffled once, for the runs to be looked at closely and for the removal.
    """
    texts = _compressed(rows)
    spans = _spans(rows, texts).groupBy("doc", "key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    names = ["doc", "key", *[f.name for f in _others(rows)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        none = np.zeros(0, np.int64)
        for batch in (b.slice(i, _CUT_ROWS) for b in batches for i in range(0, b.num_rows, _CUT_ROWS)):
            out = []
            for zipped, found in zip(batch.column("zipped"), batch.column("spans")):
                data = np.frombuffer(unzip.decompress(zipped.as_py()) if zipped.is_valid else b"", np.uint8)
                starts, ends = (found.values.field(i).to_numpy() for i in (0, 1)) if found.is_valid else (none, none)
                out.append(make(len(data) if zipped.is_valid else None, *_cut_out(data, starts, ends)))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(c, kind) for c, kind in zip(zip(*out), made.values())],
                                             [*names, *made])

    met = texts.join(spans, ["doc", "key"], "left")
    to_spark = {pa.int64(): T.LongType(), pa.string(): T.StringType(), pa.binary(): T.BinaryType()}
    return met.mapInArrow(run, T.StructType([met.schema[c] for c in names] + [T.StructField(c, to_spark[kind]) for c, kind in made.items()]))


def removal_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for each row.

    Null and empty texts have no bytes. A row without id is later than all others. Strings that only rows of the same id share
    stay; rows of one id are judged by their own texts, and repeated rows alike.
    """
    ship_package(docs.sparkSession)

    def make(length, left, gone, spans):
        return length or 0, gone, spans, hashlib.sha256(left).hexdigest()

    made = _each_kept(_identified(docs, doc_id, text), make, {
        "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string()})
    return made.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text`` (and ``n_chars`` counted anew); no row goes.

    A character that is cut within loses the rest of its bytes too. Null texts stay null.
    """
    ship_package(docs.sparkSession)

    def make(length, left, gone, spans):
        return gone, None if length is None else left.decode("utf-8", "ignore").encode() if gone else left

    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    made = _each_kept(_identified(docs, doc_id, text, F.struct(*rest).alias("rest")), make, {"gone": pa.int64(), "left": pa.binary()})
    out = {c: F.col(f"rest.`{c}`") for c in docs.columns if c != text}
    out[text] = F.col("left").cast(docs.schema[text].dataType)
    if n_chars in docs.columns:
        out[n_chars] = F.when(F.col("gone") > 0, F.length(out[text]).cast(docs.schema[n_chars].dataType)).otherwise(out[n_chars])
    return made.select(*[out[c].alias(c) for c in docs.columns])
