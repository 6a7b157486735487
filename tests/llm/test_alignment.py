"""Cross-tokenizer alignment against a brute force built on the JSON tokenizer of A, over rows with every case."""

import hashlib
from collections import Counter

import pyarrow.parquet as pq
import sentencepiece
from tokenizers import Tokenizer

from folioline.llm import alignment
from tests.llm.fixtures import DOCS, messy_rows

JSON_A = "/opt/tokenizers/byte_bpe_50k.json"


def _byte_level_alphabet():
    """The byte-level BPE's characters for bytes: printable Latin-1 stands for itself, the rest from U+0100 on, in byte order."""
    kept = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out = {chr(b): b for b in kept}
    out.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in kept)})
    return out


def _json_a():
    t = Tokenizer.from_file(JSON_A)
    t.encode_special_tokens = True
    return t


def _brute(rows):
    a_tok, b_tok = _json_a(), sentencepiece.SentencePieceProcessor(model_file=alignment.PIECES)
    letters = _byte_level_alphabet()
    per_doc = []
    for r in rows:
        doc_id, text = r[0], r[1]
        if not text:
            per_doc.append((doc_id, None))
            continue
        a = a_tok.encode(" " + text, add_special_tokens=False)
        a_ids, a_bytes = a.ids, [bytes(letters[c] for c in tok) for tok in a.tokens]
        b_ids = b_tok.encode(text)
        b_bytes = [bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in zip(b_ids, (b_tok.id_to_piece(i) for i in b_ids))]
        whole = (" " + text).encode()
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            per_doc.append((doc_id, None))
            continue
        ends_a, ends_b, x = [], [], 0
        for t in a_bytes:
            x += len(t)
            ends_a.append(x)
        x = 0
        for t in b_bytes:
            x += len(t)
            ends_b.append(x)
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, i, j = [], 0, 0
        for c in cuts:
            ga, gb = [], []
            while i < len(a_ids) and ends_a[i] <= c:
                ga.append(a_ids[i]); i += 1
            while j < len(b_ids) and ends_b[j] <= c:
                gb.append(b_ids[j]); j += 1
            groups.append((ga, gb))
        per_doc.append((doc_id, (len(a_ids), len(b_ids), groups)))
    holders = Counter()
    for _, d in per_doc:
        if d:
            holders.update({(x, y) for ga, gb in d[2] for x in ga for y in gb})
    top = {}
    for (x, _), n in holders.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for doc_id, d in per_doc:
        if not d:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x, y) for ga, gb in d[2] for x in ga for y in gb]
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in d[2])
        out.append((doc_id, d[0], d[1], len(d[2]), len(links), sum(holders[p] == top[p[0]] for p in links),
                    sum(holders[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    rows = messy_rows()
    rows += [(900, "special <|endoftext|> and <s> and </s> are text", None, None, None, None, None, None, None, None, None),
             (901, "ä" * 300 + " x", None, None, None, None, None, None, None, None, None),
             (902, "  two  spaces\n\n\nlines\r\n", None, None, None, None, None, None, None, None, None)]
    got = sorted((tuple(r) for r in alignment.alignment(spark.createDataFrame(rows, DOCS).repartition(3)).collect()), key=repr)
    expected = _brute(rows)
    assert got == expected
    by_id = {r[0]: r for r in got if r[0] is not None}
    marked = next(r[0] for r in rows if r[1] == "▁ mark")
    assert by_id[marked][1] == 0   # U+2581 in the text: B cannot give the text back
    assert by_id[901][1] > 0 and by_id[900][1] > 0
    assert alignment.alignment(spark.createDataFrame([], DOCS)).collect() == []


def test_rank_file_gives_the_ids_of_the_json_file():
    """A is read from the rank file of the same vocabulary; on the given documents the ids are those of the JSON tokenizer."""
    t = alignment.Tokenizers(open(alignment.BYTE_BPE, "rb").read(), open(alignment.PIECES, "rb").read())
    texts = [x for x in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist() if x]
    texts += [r[1] for r in messy_rows() if r[1]]
    ids, _ = t.encode(texts)
    expected = [e.ids for e in _json_a().encode_batch([" " + x for x in texts], add_special_tokens=False)]
    assert ids == expected


def test_groups_break_where_both_end():
    import numpy as np
    ga, gb = alignment.groups(np.array([2, 3, 1, 4]), np.array([1, 4, 1, 2, 2]))
    # A ends 2 5 6 10; B ends 1 5 6 8 10: cuts at 5, 6, 10
    assert ga.tolist() == [0, 0, 1, 2] and gb.tolist() == [0, 0, 1, 2, 2]
