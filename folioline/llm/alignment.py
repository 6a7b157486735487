"""Alignment of two tokenizers' tokens over the same bytes, and corpus-wide counts of the token pairs that align.

A text is encoded by a byte-level BPE (A, of ``" " + text``) and by a SentencePiece model (B, of ``text``; it adds the space itself).
Both tile the bytes of ``" " + text``. Groups come from interval coalescing: all A and B tokens as byte intervals, sorted by start
(``lexsort``); a running maximum of ends (``maximum.accumulate``); a group ends where the next start reaches the running maximum, that
is at a byte offset where an A token and a B token both end. Within a group every A token is linked with every B token.

Per document: token counts, groups, links, and ``groups_sha256`` of ``a1,a2|b1;a3|b2,b3``. Corpus-wide: for each (A id, B id) pair,
the number of documents that hold it linked; then per document the links whose count is the highest of their A id (``n_best``) and
the sum of counts over its links. Counting is a map-side combined aggregate by pair, so a pair that every document holds is summed
in each task before any shuffle.

Cases, each with a defined result:

* a null or empty text, or one whose joined A or B bytes are not ``" " + text`` (for instance one holding U+2581, which B gives
  back as a space), has no tokens: all counts 0 and ``groups_sha256`` ''; it holds no pair;
* the special tokens' strings inside a text are plain text;
* every row is a document: a row that repeats counts as often as it occurs, and a pair linked twice in one document counts once
  for that document but is two links of it;
* a null ``doc_id`` is kept as it is; columns other than ``doc_id`` and ``text`` are ignored, whatever their names;
* an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from folioline.session import settle, ship_package

#: Where the public vocabularies are; parameters of the operator. A is read from its rank file, which holds the same vocabulary as
#: ``byte_bpe_50k.json`` and gives the same ids (tests/llm/test_alignment.py holds the two equal), at a quarter of the cost.
BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: Fixed value: the pattern that splits text before the merges of the byte-level BPE.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts are tokenised in runs of rows of about so many characters.
SLICE_CHARS = 1 << 20
#: The pair table is joined by broadcast when it has at most so many rows (about 40 bytes each); else by a shuffle on the pair.
BROADCAST_PAIRS = 2_000_000

_ALIGNED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType()),
    T.StructField("n_groups", T.LongType()), T.StructField("n_links", T.LongType()),
    T.StructField("groups_sha256", T.StringType()),
    # distinct linked pairs (A id << 32 | B id) and how often each is linked in the row
    T.StructField("pair_keys", T.ArrayType(T.LongType())), T.StructField("pair_links", T.ArrayType(T.LongType()))])


class _Vocabulary:
    """Each id's bytes, flat, for checks of whole texts without a loop over tokens."""

    def __init__(self, pieces: list[bytes]):
        self.length = np.array([len(x) for x in pieces], np.int64)
        self.offset = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)
        self.names = np.array([str(i) for i in range(len(pieces))], dtype=object)

    def spells(self, ids: np.ndarray, whole: np.ndarray) -> bool:
        """Whether the tokens' bytes, joined, are ``whole``."""
        lengths = self.length[ids]
        if int(lengths.sum()) != len(whole):
            return False
        at = np.repeat(self.offset[ids], lengths) + _ragged(lengths)
        return bool(np.array_equal(self.flat[at], whole))


class Tokenizers:
    """Both tokenizers built from their files' bytes, and each id's bytes."""

    def __init__(self, byte_bpe: bytes, pieces: bytes):
        import base64

        import sentencepiece
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in byte_bpe.splitlines() if line.strip())}
        self.a = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            a_bytes[rank] = token
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("\u2581", " ").encode("utf-8"))
        self.va, self.vb = _Vocabulary(a_bytes), _Vocabulary(b_bytes)

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Special tokens' strings are plain text in both."""
        return self.a.encode_ordinary_batch([" " + t for t in texts], num_threads=1), self.b.encode(texts, num_threads=1)


def groups(a_len: np.ndarray, b_len: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of each A and each B token, by interval coalescing of their byte ranges."""
    a_end, b_end = np.cumsum(a_len), np.cumsum(b_len)
    starts = np.concatenate([a_end - a_len, b_end - b_len])
    ends = np.concatenate([a_end, b_end])
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    new = np.ones(len(order), bool)
    new[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return group[:len(a_len)], group[len(a_len):]


def _ragged(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, concatenated."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    starts = np.repeat(np.cumsum(counts) - counts, counts)
    return np.arange(total) - starts


def align(a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray, va: _Vocabulary, vb: _Vocabulary):
    """(groups, links, digest text, distinct pair keys, their multiplicities) of one document's grouped tokens."""
    n_groups = int(ga[-1]) + 1
    na, nb = np.bincount(ga, minlength=n_groups), np.bincount(gb, minlength=n_groups)
    b_first = np.cumsum(nb) - nb
    # every A token with every B token of its group
    reps = nb[ga]
    left = np.repeat(a, reps)
    right = b[np.repeat(b_first[ga], reps) + _ragged(reps)]
    keys, mult = np.unique((left << 32) | right, return_counts=True)
    # a1,a2|b1;a3|b2,b3: per group its A ids, then its B ids
    a_sep = np.where(np.r_[ga[1:] != ga[:-1], True], "|", ",").astype(object)
    b_sep = np.where(np.r_[gb[1:] != gb[:-1], True], ";", ",").astype(object)
    b_sep[-1] = ""
    group = np.concatenate([ga, gb])
    order = np.lexsort((np.r_[np.zeros(len(a), np.int8), np.ones(len(b), np.int8)], group))
    text = np.empty(2 * len(order), object)
    text[0::2] = np.concatenate([va.names[a], vb.names[b]])[order]
    text[1::2] = np.concatenate([a_sep, b_sep])[order]
    return n_groups, int((na * nb).sum()), "".join(text.tolist()), keys, mult.astype(np.int64)


def _slices(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Runs of rows of about ``SLICE_CHARS`` characters of text; a longer text is a run of its own. Bounds what a worker holds."""
    sizes = batch["text"].str.len().fillna(0).to_numpy()
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > SLICE_CHARS:
            yield batch.iloc[start:i]
            start, total = i, 0
        total += n
    if start < len(batch):
        yield batch.iloc[start:]


def _aligned(byte_bpe: bytes, pieces: bytes):
    tokenizers = None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nonlocal tokenizers
        if tokenizers is None:
            tokenizers = Tokenizers(byte_bpe, pieces)
        t = tokenizers
        for batch in (part for whole in batches for part in _slices(whole)):
            texts = batch["text"].tolist()
            present = [i for i, x in enumerate(texts) if isinstance(x, str) and x]
            ids_a, ids_b = t.encode([texts[i] for i in present]) if present else ([], [])
            n_a, n_b, n_g, n_l = (np.zeros(len(texts), np.int64) for _ in range(4))
            none = np.zeros(0, np.int64)
            digests, keys, links = [""] * len(texts), [none] * len(texts), [none] * len(texts)
            for i, a, b in zip(present, ids_a, ids_b):
                whole = np.frombuffer((" " + texts[i]).encode("utf-8"), np.uint8)
                a, b = np.asarray(a, np.int64), np.asarray(b, np.int64)
                if not len(a) or not len(b) or not t.va.spells(a, whole) or not t.vb.spells(b, whole):
                    continue
                ga, gb = groups(t.va.length[a], t.vb.length[b])
                n_groups, n_links, text, keys[i], links[i] = align(a, b, ga, gb, t.va, t.vb)
                n_a[i], n_b[i], n_g[i], n_l[i] = len(a), len(b), n_groups, n_links
                digests[i] = hashlib.sha256(text.encode()).hexdigest()
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_a": n_a, "n_b": n_b, "n_groups": n_g, "n_links": n_l,
                                "groups_sha256": digests, "pair_keys": keys, "pair_links": links})
    return run


def aligned(docs: DataFrame, byte_bpe: str = BYTE_BPE, pieces: str = PIECES) -> DataFrame:
    """Per row of ``docs (doc_id, text)``: counts, digest, and distinct linked id pairs with how often each is linked."""
    ship_package(docs.sparkSession)
    with open(byte_bpe, "rb") as f, open(pieces, "rb") as g:
        run = _aligned(f.read(), g.read())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(run, _ALIGNED)


def alignment(docs: DataFrame, byte_bpe: str = BYTE_BPE, pieces: str = PIECES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    per_doc = settle(aligned(docs, byte_bpe, pieces), "aligned")
    # one row a document and pair; summed in each task before the shuffle, so a pair that all documents hold is no hot key
    counts = per_doc.select(F.explode("pair_keys").alias("key")).groupBy("key").agg(F.count("*").alias("n_docs"))
    a_id = F.shiftright("key", 32)
    best = counts.groupBy(a_id.alias("a")).agg(F.max("n_docs").alias("top"))
    table = settle(counts.join(best, a_id == best["a"]).select("key", "n_docs", (F.col("n_docs") == F.col("top")).alias("best")), "pairs")
    small = table.count() <= BROADCAST_PAIRS
    keyed = per_doc.withColumn("row", F.monotonically_increasing_id())
    exploded = keyed.select("row", F.explode(F.arrays_zip("pair_keys", "pair_links")).alias("p")).select(
        "row", F.col("p.pair_keys").alias("key"), F.col("p.pair_links").alias("m"))
    joined = exploded.join(F.broadcast(table) if small else table, "key")
    sums = joined.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("n_best"), F.sum(F.col("m") * F.col("n_docs")).alias("count_sum"))
    out = keyed.drop("pair_keys", "pair_links").join(sums, "row", "left")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
                      F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256")
