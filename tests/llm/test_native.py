"""Decontamination, license scan and chats against brute force on tables that hold every case."""

import hashlib
import re

from pyspark.sql import functions as F

from folioline.llm import chats, decontaminate, licenses
from tests.llm.fixtures import DOCS, messy_rows


def _words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def _bench(rows):
    """Items cut out of the documents, short ones, copies of an item, and ones that occur nowhere."""
    texts = [r[1] for r in rows if r[1] and 60 < len(_words(r[1])) < 200]
    items = [(i, " ".join(_words(t)[5:30])) for i, t in enumerate(texts[:6])]
    items += [(20, " ".join(_words(texts[7])[2:15])), (21, "A B, c D"), (21, "A B, c D"), (22, "nowhere to be found"),
              (23, ""), (24, None), (None, texts[0]), (25, " ".join(_words(texts[8])[:9] + ["odd"] + _words(texts[8])[10:24]))]
    return items


def _expected(rows, items):
    windows = set()
    for item, text in items:
        w = _words(text)
        if item is not None and w:
            k = min(13, len(w))
            windows |= {(item, tuple(w[i:i + k])) for i in range(len(w) - k + 1)}
    by_text = {}
    for item, w in windows:
        by_text.setdefault(w, set()).add(item)
    sizes = {len(w) for w in by_text}
    out = []
    for r in rows:
        w = _words(r[1])
        hit, found = set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                own = by_text.get(tuple(w[i:i + k]))
                if own:
                    hit.update(range(i, i + k))
                    found |= own
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((r[0], len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def test_decontaminate(spark, monkeypatch):
    rows = messy_rows()
    items = _bench(rows)
    docs = spark.createDataFrame(rows, DOCS)
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    expected = _expected(rows, items)
    assert sum(r[2] > 0 for r in expected) > 5

    def got():
        return sorted(map(tuple, decontaminate.decontaminate(docs, benchmark).drop("text_key").collect()), key=repr)

    assert got() == expected
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 30)
    assert got() == expected
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r[5] for r in expected)
    assert decontaminate.decontaminate(docs, benchmark.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.decontaminate(docs.limit(0), benchmark).count() == 0


def test_licenses(spark):
    docs = spark.createDataFrame([
        (1, "x y\nReleased under the MIT License.\nmore", "l"), (2, "released UNDER the mit-license", "l"),
        (3, "Released under the old MIT License.", None), (4, "Released under no license", None), (5, None, None), (6, "", None),
        (7, "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License.", None), (None, "Licensed under CC BY-NC 4.0.", None),
        (1, "x y\nReleased under the MIT License.\nmore", "l")], "doc_id long, text string, license string")
    found = licenses.scan(docs, licenses.templates(spark))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted([
        (1, "MIT", 1.0, 1), (1, "MIT", 1.0, 1), (2, "MIT", 1.0, 1), (3, None, None, 0), (4, None, None, 0), (5, None, None, 0),
        (6, None, None, 0), (7, "Apache-2.0", 1.0, 2), (None, "CC-BY-NC-4.0", 1.0, 1)], key=repr)
    lower = licenses.line_matches(docs, licenses.templates(spark), threshold=0.6).where("doc_id = 3").collect()
    assert [(r.license, r.dice) for r in lower] == [("MIT", 2 * 3 / (4 + 5))]
    assert licenses.scan(docs.limit(0), licenses.templates(spark)).count() == 0
    assert licenses.scan(docs, licenses.templates(spark).limit(0)).where("license is not null").count() == 0


def test_chats(spark, monkeypatch):
    def conversation(conv, *said):
        return [(conv, i, "user" if i % 2 == 0 else "assistant", t, "x") for i, t in enumerate(said)]

    turns = (conversation(1, "a", "b") + conversation(2, "a", "b", "c") + conversation(3, "a", "b", "c") + conversation(4, "a")
             + conversation(5, "a", "x") + conversation(6, None, "b") + conversation(7, "") + conversation(None, "n") + conversation(9, *"pqrstuvwxyz"))
    turns += [(10, 0, "user", "a", None), (10, 5, None, "b", None), (10, 5, None, "b", None), (11, None, "user", "q", None)]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, pos string").repartition(3)
    kept = {r.conv_id: r.n_turns for r in chats.maximal(table).collect()}
    # null and empty texts differ by hash; 7 is the beginning of none
    assert kept == {2: 3, 5: 2, 6: 2, 7: 1, None: 1, 9: 11, 10: 3, 11: 1}
    monkeypatch.setattr(chats, "TURNS_PER_PART", 4)
    parts = {(r.conv_id, r.part): (r.n_turns, r.text) for r in chats.format_chats(table).collect()}
    assert parts[9, 2] == (3, "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in (("user", "x"), ("assistant", "y"), ("user", "z"))))
    assert parts[2, 0][1].startswith("<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb")
    assert parts[10, 0] == (3, "<|im_start|>user\na<|im_end|>\n" + 2 * "<|im_start|>\nb<|im_end|>\n")
    assert chats.format_chats(table.limit(0)).count() == 0


def test_chats_with_equal_turns_over_ranges(spark):
    """Equal turns of two roles spread over several ranges keep the order (turn, role, text hash); a prefix is found as such."""
    import random

    rng = random.Random(5)
    rows = [(1, 1, rng.choice(["user", "assistant"]), f"t{i}") for i in range(400)]
    rows += [(2, t, role, text) for _, t, role, text in rows] + [(2, 2, "user", "one more")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    # small ranges stay apart, as on a cluster with many of them
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = {(r.conv_id, r.part): r.text for r in chats.format_chats(table).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    # conversation 1 is a prefix of 2 and goes
    assert {c for c, _ in parts} == {2}
    ordered = sorted(((t, role, hashlib.sha256(text.encode()).hexdigest(), role, text) for c, t, role, text in rows if c == 2))
    expected = "".join(f"<|im_start|>{role}\n{text}<|im_end|>\n" for *_, role, text in ordered)
    assert "".join(parts[(2, p)] for p in sorted(p for _, p in parts)) == expected
