"""SentencePiece encoding and decoding, in numpy, many words at a time.

A text is cut into units (a run of spaces and what follows it) that no piece crosses. Each unit that differs
is worked out once per task; units of equal length advance together:

* a unigram model by Viterbi: hashes of all substrings that end at a position probe the sorted hashes of
  the pieces, and the best score and its backpointer are vectorised maxima;
* a BPE model by its merges: the adjacent pairs probe sorted pair keys, and in each step every unit merges its
  best pair (vectorised maximum, leftmost of equals). The most probable path is not what such a model's
  encoder gives, so Viterbi would yield other ids.

Characters without a piece fall back to bytes. Models with identity normalisation only.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, functions as F

from folioline.llm import arrays
from folioline.session import ship_package

MARK = "▁"
#: A vocabulary of more pieces is refused, as every task gets all of it.
MAX_PIECES = 1 << 20
#: Characters without a piece are symbols from here on.
_CHARS = 1 << 21
#: So many different units a task remembers before it starts anew.
_REMEMBERED = 1 << 19
#: Texts are encoded in runs of rows of about so many bytes.
_RUN_BYTES = 1 << 19
#: Longer units are merged one by one from a heap, in n log n steps.
_LONG = 64
_NONE = np.float32(-np.inf)
_Q = np.uint64(0xD6E8FEB86659FD93)
_Q_INVERSE = np.uint64(pow(int(_Q), -1, 2**64))


class Vocabulary(NamedTuple):
    pieces: list       # str; None for control pieces
    scores: np.ndarray
    bytes_at: np.ndarray  # piece id of each byte, -1 where there is none
    unknown: int
    kind: str          # "bpe" or "unigram"


def load_vocabulary(path: str, kind: str = "bpe") -> Vocabulary:
    """Read a model file on the driver. ``kind`` is the model's type."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    if size > MAX_PIECES:
        raise ValueError(f"{size} pieces are more than {MAX_PIECES}")
    bytes_at = np.full(256, -1, np.int32)
    pieces = []
    for i in range(size):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            bytes_at[int(piece[3:5], 16)] = i
        pieces.append(None if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else piece)
    scores = np.array([model.get_score(i) for i in range(size)], np.float32)
    return Vocabulary(pieces, scores, bytes_at, model.unk_id(), kind)


class Encoder:
    """The tables made from a vocabulary, and the units met so far. One per task."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        known = {p: i for i, p in enumerate(vocabulary.pieces) if p is not None}
        self.single = np.arange(0x110000, dtype=np.int64) + _CHARS
        for p, i in known.items():
            if len(p) == 1:
                self.single[ord(p)] = i
        used = {c for p in known for c in p}
        crossing = [p for p in known if MARK in p.lstrip(MARK)]
        if crossing:
            raise ValueError(f"pieces with a space inside, such as {crossing[0]!r}, need whole texts as units")
        #: Control bytes that are part of no piece end a unit too.
        self.breaks = np.array([i < 32 and chr(i) not in used for i in range(256)])
        if vocabulary.kind == "bpe":
            pairs = {}
            for p, i in known.items():
                for cut in range(1, len(p)):
                    left, right = known.get(p[:cut]), known.get(p[cut:])
                    if left is not None and right is not None:
                        pairs[left << 22 | right] = i
            keys = np.array(sorted(pairs), np.int64)
            self.pair_keys = np.append(keys, np.int64(2**62))
            self.pair_ids = np.array([pairs[k] for k in keys.tolist()] + [0], np.int64)
            self.pair_scores = np.append(vocabulary.scores[self.pair_ids[:-1]], _NONE).astype(np.float32)
        else:
            hashes = {}
            for p, i in known.items():
                h = _char_sums(np.array([[ord(c) for c in p]], np.int64))
                hashes[int(_substring(h, 0, len(p))[0])] = i
            keys = sorted(hashes)
            self.piece_keys = np.array(keys + [2**64 - 1], np.uint64)
            self.piece_ids = np.array([hashes[k] for k in keys] + [0], np.int64)
            self.longest = max(map(len, known), default=1)
            usual = [vocabulary.scores[i] for i in known.values()]
            self.unknown_score = np.float32(min(usual, default=0) - 10)
        self.forget()

    def forget(self) -> None:
        # hashes of the units, ascending, and the slot of each: a dictionary of so many numbers would take ten times the memory
        self.keys = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int32)
        self.lengths = np.zeros(1 << 12, np.int32)
        self.starts = np.zeros(1 << 12, np.int64)
        self.pool = np.zeros(1 << 14, np.int32)
        self.filled = 0

    # whole texts

    def encode(self, texts: arrays.Texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets of the texts in them)."""
        data, offsets = texts.data, texts.offsets
        n = len(data)
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        space, brk = data == 32, self.breaks[data]
        begin = brk.copy()
        begin[0] = True
        begin[1:] |= (space[1:] & ~space[:-1]) | brk[:-1]
        heads = np.unique(offsets[:-1][np.diff(offsets) > 0])
        begin[heads] = True
        begins = np.flatnonzero(begin)
        ends = np.append(begins[1:], n)
        keys = arrays.span_hashes(arrays.prefix_hashes(data), begins, ends)
        head = np.zeros(len(begins), bool)
        head[np.searchsorted(begins, heads)] = True
        keys[head] ^= np.uint64(0x5DEECE66D5DEECE6)  # the first unit of a text has a mark in front

        unlike, first, which = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) > _REMEMBERED:
            self.forget()
        missing = np.flatnonzero(~np.isin(unlike, self.keys, assume_unique=True))
        if len(missing):
            at = first[missing]
            raw = data.tobytes()
            units = [(MARK if h else "") + raw[b:e].decode("utf-8", "replace").replace(" ", MARK)
                     for b, e, h in zip(begins[at].tolist(), ends[at].tolist(), head[at].tolist())]
            self._remember(unlike[missing], *self.encode_units(units))
        slots = self.slots[np.searchsorted(self.keys, unlike)][which]
        lengths, starts = self.lengths[slots], self.starts[slots]
        total = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.pool[np.repeat(starts - total[:-1], lengths) + np.arange(total[-1])]
        return ids, total[np.searchsorted(begins, offsets)]

    def _remember(self, keys: np.ndarray, lengths: np.ndarray, more: np.ndarray) -> None:
        while self.filled + len(more) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while len(self.keys) + len(keys) > len(self.lengths):
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        slot = len(self.keys)
        self.lengths[slot:slot + len(keys)] = lengths
        self.starts[slot:slot + len(keys)] = self.filled + np.cumsum(lengths) - lengths
        self.pool[self.filled:self.filled + len(more)] = more
        self.filled += len(more)
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.slots = np.concatenate([self.slots, np.arange(slot, len(keys), dtype=np.int32)])[order]

    # units

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(how many ids each unit has, the ids of all in a row)."""
        sizes = np.array([len(u) for u in units], np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []  # members, and their symbols of equal number as a matrix
        order = np.argsort(sizes, kind="stable")
        for members in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
            length = int(sizes[members[0]])
            if self.v.kind == "bpe" and length > _LONG:
                parts += [(np.array([i]), self._merge_long(units[i])[None]) for i in members.tolist()]
                continue
            text = "".join([units[i] for i in members.tolist()]).encode("utf-32-le")
            chars = np.frombuffer(text, np.uint32).reshape(len(members), length).astype(np.int64)
            found = self._merge(chars) if self.v.kind == "bpe" else self._viterbi(chars)
            parts += [(members[rows], symbols) for rows, symbols in found]
        lengths = np.zeros(len(units), np.int64)
        for members, symbols in parts:
            lengths[members] = symbols.shape[1]
        starts = np.cumsum(lengths) - lengths
        flat = np.zeros(int(lengths.sum()), np.int64)
        for members, symbols in parts:
            flat[starts[members][:, None] + np.arange(symbols.shape[1])] = symbols
        return self._with_bytes(lengths, flat)

    def _with_bytes(self, lengths: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece as the pieces of their bytes."""
        strange = np.flatnonzero(flat >= _CHARS)
        if not len(strange):
            return lengths, flat.astype(np.int32)
        own = {}
        for c in np.unique(flat[strange]).tolist():
            ids = self.v.bytes_at[list(chr(c - _CHARS).encode("utf-8", "replace"))]
            own[c] = ids if (ids >= 0).all() else np.array([self.v.unknown], np.int32)
        stead = [own[c] for c in flat[strange].tolist()]
        widths = np.ones(len(flat), np.int64)
        widths[strange] = [len(x) for x in stead]
        begins = np.cumsum(widths) - widths
        out = np.repeat(flat, widths).astype(np.int32)
        more = widths[strange]
        within = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
        out[np.repeat(begins[strange], more) + within] = np.concatenate(stead)
        total = np.concatenate([[0], np.cumsum(widths)])
        ends = np.cumsum(lengths)
        return total[ends] - total[ends - lengths], out

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(merged piece, its score) of each pair of symbols."""
        keys = left << 22 | right
        at = np.searchsorted(self.pair_keys, keys)
        at[self.pair_keys[at] != keys] = len(self.pair_ids) - 1
        return self.pair_ids[at], self.pair_scores[at]

    def _merge(self, chars: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """All rows are units of one length; in each step every unfinished one merges one pair."""
        symbols = self.single[chars]
        out = []
        rows = np.arange(len(symbols))
        merged, scores = self._pairs(symbols[:, :-1], symbols[:, 1:])
        while len(rows):
            if symbols.shape[1] > 1:
                best = scores.argmax(1)
                going = scores[np.arange(len(rows)), best] > _NONE
            else:
                going = np.zeros(len(rows), bool)
            out.append((rows[~going], symbols[~going]))
            if not going.any():
                break
            rows, symbols, merged, scores, best = (x[going] for x in (rows, symbols, merged, scores, best))
            width, each = symbols.shape[1], np.arange(len(rows))
            symbols[each, best] = merged[each, best]
            symbols = np.take_along_axis(symbols, _without(width, best + 1), 1)
            # the pair itself is gone; those beside it are new
            keep = _without(width - 1, best)
            merged, scores = np.take_along_axis(merged, keep, 1), np.take_along_axis(scores, keep, 1)
            for at in (best - 1, best):
                fit = (at >= 0) & (at < width - 2)
                e, a = each[fit], at[fit]
                merged[e, a], scores[e, a] = self._pairs(symbols[e, a], symbols[e, a + 1])
        return out

    def _merge_long(self, unit: str) -> np.ndarray:
        symbols = self.single[np.frombuffer(unit.encode("utf-32-le"), np.uint32)].tolist()
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list = []

        def offer(lefts: list[int]) -> None:
            rights = [after[i] for i in lefts]
            ids, scores = self._pairs(np.array([symbols[i] for i in lefts], np.int64), np.array([symbols[i] for i in rights], np.int64))
            for i, j, x, s in zip(lefts, rights, ids.tolist(), scores.tolist()):
                if s > _NONE:
                    heapq.heappush(heap, (-s, i, j, symbols[i], symbols[j], x))

        offer(list(range(n - 1)))
        while heap:
            _, i, j, left, right, new = heapq.heappop(heap)
            if symbols[i] != left or after[i] != j or symbols[j] != right:
                continue
            symbols[i], symbols[j] = new, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            near = [x for x in (before[i], i) if x >= 0 and after[x] < n]
            if near:
                offer(near)
        return np.array([s for s in symbols if s >= 0], np.int64)

    def _viterbi(self, chars: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """The path of the greatest sum of scores; of equal ones that with the longest last piece, and so on."""
        n, width = chars.shape
        sums = _char_sums(chars)
        best = np.zeros((n, width + 1))
        back = np.zeros((n, width + 1), np.int64)
        piece = np.zeros((n, width + 1), np.int64)
        for end in range(1, width + 1):
            starts = np.arange(max(0, end - self.longest), end)  # longest first
            hashes = np.stack([_substring(sums, s, end) for s in starts], 1)
            at = np.searchsorted(self.piece_keys[:-1], hashes)
            hit = self.piece_keys[at] == hashes
            ids = self.piece_ids[at]
            scores = np.where(hit, self.v.scores[ids], _NONE).astype(np.float64)
            alone = ~hit[:, -1]
            scores[alone, -1] = self.unknown_score
            ids[alone, -1] = chars[alone, end - 1] + _CHARS
            scores += best[:, starts]
            top = scores.argmax(1)
            each = np.arange(n)
            best[:, end], back[:, end], piece[:, end] = scores[each, top], starts[top], ids[each, top]
        steps, place, each = [], np.full(n, width), np.arange(n)
        while (place > 0).any():
            steps.append(np.where(place > 0, piece[each, place], -1))
            place = np.where(place > 0, back[each, place], 0)
        paths = np.stack(steps[::-1], 1) if steps else np.zeros((n, 0), np.int64)
        taken = (paths >= 0).sum(1)  # the steps before a path's own are blank
        return [(np.flatnonzero(taken == k), paths[taken == k, paths.shape[1] - k:]) for k in np.unique(taken)]


def _without(width: int, column: np.ndarray) -> np.ndarray:
    """Index of all columns but one in each row."""
    places = np.arange(width - 1)
    return places + (places >= column[:, None])


def _char_sums(chars: np.ndarray) -> np.ndarray:
    sums = np.zeros((chars.shape[0], chars.shape[1] + 1), np.uint64)
    values = arrays.mix(chars.astype(np.uint64) + np.uint64(1)) * arrays.powers(_Q, chars.shape[1])[:chars.shape[1]]
    np.cumsum(values, 1, dtype=np.uint64, out=sums[:, 1:])
    return sums


def _substring(sums: np.ndarray, start: int, end: int) -> np.ndarray:
    inverse = arrays.powers(_Q_INVERSE, start + 1)[start]
    return arrays.mix((sums[:, end] - sums[:, start]) * inverse + np.uint64(end - start))


class Decoder:
    """Bytes of each id: the piece with spaces for marks, or the byte that it stands for."""

    def __init__(self, vocabulary: Vocabulary):
        raw = [b"" if p is None else p.replace(MARK, " ").encode("utf-8") for p in vocabulary.pieces]
        for byte, i in enumerate(vocabulary.bytes_at.tolist()):
            if i >= 0:
                raw[i] = bytes([byte])
        raw[vocabulary.unknown] = " ⁇ ".encode()
        self.lengths = np.array([len(x) for x in raw], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(raw), np.uint8)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts in a row, offsets); the space put in front of each text is gone."""
        lengths = self.lengths[ids]
        total = np.concatenate([[0], np.cumsum(lengths)])
        data = self.data[np.repeat(self.starts[ids] - total[:-1], lengths) + np.arange(total[-1])]
        begins = total[offsets]
        heads = begins[:-1][np.diff(begins) > 0]
        heads = heads[data[heads] == 32]
        keep = np.ones(len(data), bool)
        keep[heads] = False
        return data[keep], begins - np.searchsorted(heads, begins)


def _with_spaces(text: Column) -> Column:
    return F.replace(text, F.lit(MARK), F.lit(" "))


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default ``doc_id``) and ``ids`` (array of int) for each row.

    Null and empty texts have no ids. A mark in a text counts as a space.
    """
    return _in_batches(docs, vocabulary, text, keep, "ids array<int>", _encode_run)


def encode_and_check(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: list[str] | None = None,
                     marks_as_spaces: bool = True) -> DataFrame:
    """As :func:`encode`, plus ``round_trip``: whether the ids decode to the text, with its marks as spaces.

    Without ``marks_as_spaces`` to the text as it is, which is false for each text with a mark.
    """
    if marks_as_spaces:
        return _in_batches(docs, vocabulary, text, keep, "ids array<int>, round_trip boolean", _encode_and_decode_run)
    keep = keep or ["doc_id"]
    names = [f"_keep{i}" for i in range(len(keep))]
    marked = F.coalesce(F.contains(F.col(text), F.lit(MARK)), F.lit(False))
    renamed = docs.select(F.col(text).alias("_text"), marked.alias("_marked"), *[F.col(c).alias(n) for c, n in zip(keep, names)])
    made = encode_and_check(renamed, vocabulary, "_text", ["_marked", *names])
    return made.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], "ids",
                       (F.col("round_trip") & ~F.col("_marked")).alias("round_trip"))


def _encode_run(encoder: Encoder, decoder: Decoder, t: arrays.Texts) -> list[pa.Array]:
    ids, offsets = encoder.encode(t)
    return [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))]


def _encode_and_decode_run(encoder: Encoder, decoder: Decoder, t: arrays.Texts) -> list[pa.Array]:
    ids, offsets = encoder.encode(t)
    data, begins = decoder.decode(ids, offsets)
    if len(data) == len(t.data) and (begins == t.offsets).all() and (data == t.data).all():
        same = np.ones(len(t), bool)
    else:
        same = np.array([data[a:b].tobytes() == t.data[c:d].tobytes()
                         for a, b, c, d in zip(begins[:-1], begins[1:], t.offsets[:-1], t.offsets[1:])], bool)
    return [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)), pa.array(same)]


def _in_batches(docs: DataFrame, vocabulary: Vocabulary, text: str, keep: list[str] | None, columns: str, work) -> DataFrame:
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    keep = keep or ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = None, None
        for batch in batches:
            encoder, decoder = encoder or Encoder(shared.value), decoder or Decoder(shared.value)
            for t in arrays.texts_of(batch.column(0), _RUN_BYTES):
                kept = batch.slice(t.first, len(t)).columns[1:]
                made = work(encoder, decoder, t)
                yield pa.RecordBatch.from_arrays(kept + made, names)

    names = [*keep, *[c.split()[0] for c in columns.split(", ")]]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [columns])
    return docs.select(_with_spaces(F.col(text)).alias("_text"), *keep).mapInArrow(run, schema)


def decode(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default ``doc_id``) and ``text`` for each row; null ids give an empty text.

    Bytes that are no UTF-8 become the replacement character.
    """
    ship_package(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)
    keep = keep or ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = None
        for batch in batches:
            decoder = decoder or Decoder(shared.value)
            column = batch.column(0)
            lengths = np.array([0 if x is None else x for x in pa.compute.list_value_length(column).to_pylist()], np.int64)
            offsets = np.concatenate([[0], np.cumsum(lengths)])
            data, begins = decoder.decode(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), offsets)
            texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(begins[:-1], begins[1:])]
            yield pa.RecordBatch.from_arrays(batch.columns[1:] + [pa.array(texts, pa.string())], [*keep, "text"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + ["text string"])
    return rows.select(F.col(ids).cast("array<int>").alias("_ids"), *keep).mapInArrow(run, schema)
