"""Near-copy operators against brute force on small tables that hold every case."""

import hashlib
import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from folioline.llm import linking, near_join, paragraphs, substrings
from tests.conftest import plan_of
from tests.llm.fixtures import DOCS, VOCABULARY, messy_rows


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", _lower(text))


def _shingles(words):
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def _similar(a, b):
    k = len(a & b)
    return k > 0 and 100 * k >= 80 * (len(a) + len(b) - k)


def _groups(sets):
    """Component of each index by links between all pairs."""
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(sets)), 2):
        if 0.8 <= len(sets[i]) / max(1, len(sets[j])) <= 1.25 and _similar(sets[i], sets[j]):
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    return [find(i) for i in range(len(sets))]


def _crowd(seed):
    """Documents of one origin with different numbers of changes: many links, some broken, some only by way of others."""
    rng = random.Random(seed)
    base = [rng.choice(VOCABULARY) for _ in range(80)]
    rows = []
    for i in range(90):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4, 6])):
            copy[rng.randrange(len(copy))] = rng.choice(VOCABULARY)
        rows.append((i, " ".join(copy)))
    return rows


def _expected(rows):
    sets = [_shingles(_words(r[1])) for r in rows]
    group = _groups(sets)
    least = {}
    for r, g in zip(rows, group):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    return sorted(((r[0], len(s), least.get(g) if s else r[0]) for r, s, g in zip(rows, sets, group)), key=repr)


def _got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def test_near_copies_messy(spark):
    rows = messy_rows()
    assert _got(near_join.near_copies(spark.createDataFrame(rows, DOCS))) == _expected(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_of_a_crowd(spark, monkeypatch, seed):
    rows = _crowd(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = _expected(rows)
    assert _got(near_join.near_copies(docs)) == expected
    if seed == 1:  # leaders only; pairs at once; frequent tokens
        monkeypatch.setattr(linking, "FEW", -1)
        assert _got(near_join.near_copies(docs)) == expected
        monkeypatch.setattr(linking, "FEW", 10**9)
        monkeypatch.setattr(near_join, "FREQUENT_SEEN", 2)
        monkeypatch.setattr(near_join, "FREQUENT_SHARE", 10)
        assert _got(near_join.near_copies(docs)) == expected


def test_near_copies_empty(spark):
    docs = spark.createDataFrame([], DOCS)
    assert near_join.near_copies(docs).count() == 0
    assert near_join.one_of_each(docs).columns == docs.columns
    assert near_join.one_of_each(docs).count() == 0


def test_one_of_each(spark):
    rows = messy_rows()
    docs = spark.createDataFrame(rows, DOCS)
    kept = near_join.one_of_each(docs)
    assert kept.columns == docs.columns
    found = [tuple(r) for r in kept.collect()]
    assert set(found) <= set(rows)
    sets = [_shingles(_words(r[1])) for r in rows]
    group = _groups(sets)
    best = defaultdict(list)
    for r, s, g in zip(rows, sets, group):
        if s:
            best[g].append((r[0] is None, r[0] or 0))
    assert sorted(r[0] or -1 for r in found if _words(r[1])) == sorted(
        -1 if b[0] else b[1] for b in (min(v) for v in best.values()))
    assert sum(not _words(r[1]) for r in found) == sum(not s for s in sets)


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r.node: r.component for r in linking.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}


def _removal(rows):
    """Brute force of the removal of repeated 50-byte strings."""
    first = {}
    data = [(r[0] if r[0] is not None else 2**63 - 1, (r[1] or "").encode()) for r in rows]
    for doc, text in data:
        for i in range(len(text) - 49):
            s = text[i:i + 50]
            first[s] = min(first.get(s, doc), doc)
    out, left_over = [], []
    for (doc, text), r in zip(data, rows):
        gone = bytearray(len(text))
        for i in range(len(text) - 49):
            if first[text[i:i + 50]] < doc:
                gone[i:i + 50] = b"\1" * 50
        left = bytes(c for c, g in zip(text, gone) if not g)
        out.append((r[0], len(text), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(left).hexdigest()))
        left_over.append(left)
    return sorted(out, key=repr), left_over


def _some_rows():
    """Without the very long texts, which brute force does not bear; with passages that overlap."""
    rng = random.Random(8)
    rows = [r for r in messy_rows() if len(r[1] or "") < 5_000]
    passage = " ".join(rng.choice(VOCABULARY) for _ in range(40))
    for i in range(12):
        a, b = sorted(rng.sample(range(len(passage)), 2))
        rows.append((300 + i, f"{rng.random()} {passage[a:b]} {rng.random()} {passage[:a]}", *[None] * 9))
    return rows


def test_removal_report(spark):
    rows = _some_rows()
    found = substrings.removal_report(spark.createDataFrame(rows, DOCS).repartition(4))
    assert sorted(map(tuple, found.collect()), key=repr) == _removal(rows)[0]


def test_removal_of_runs_that_a_document_repeats(spark):
    """A passage twice or more in equal surroundings, of which an earlier document shares only a part."""
    rng = random.Random(12)

    def some(n):
        return " ".join(rng.choice(VOCABULARY) for _ in range(n))

    rows = []
    for i in range(20):
        passage, around = some(rng.randint(12, 30)), (some(10), some(10))
        again = f"{around[0]} {passage} {around[1]} "
        rows.append((10 * i, f"{some(10)} {passage} {some(10)}"))
        rows.append((10 * i + 1, again * rng.randint(2, 4) + some(5)))
        rows.append((rng.choice([10 * i + 1, None]), some(3) + f" {again}"))  # another row of the id, or of none
        rows.append((None, some(4) + f" {again}{some(2)} {again}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = substrings.removal_report(docs)
    assert sorted(map(tuple, found.collect()), key=repr) == _removal(rows)[0]


def test_remove_repeats(spark):
    rows = _some_rows()
    docs = spark.createDataFrame(rows, DOCS)
    cut = substrings.remove_repeats(docs)
    assert cut.columns == docs.columns
    left = _removal(rows)[1]
    expected = [(r[0], None if r[1] is None else x.decode("utf-8", "ignore")) for r, x in zip(rows, left)]
    assert sorted(((r.doc_id, r.text) for r in cut.collect()), key=repr) == sorted(expected, key=repr)
    # characters are counted anew where something was cut, and there only
    before = {(r[0], r[1], r[4]) for r in rows}
    changed = [r for r in cut.collect() if (r.doc_id, r.text, r.n_chars) not in before]
    assert changed and all(r.n_chars == len(r.text) for r in changed)


def test_texts_are_shuffled_once(spark):
    """The runs to be looked at closely and the removal read the same shuffle; null texts stay null."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(VOCABULARY) for _ in range(60)) if i % 2 else None) for i in range(40)]
    rows += [(100 + i, text and text[:200] + "x" + text[200:]) for i, text in rows]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cut = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
        left = {r.doc_id: r.text for r in cut.collect()}
        assert "ReusedExchange" in plan_of(cut).split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert all((left[i] is None) == (text is None) for i, text in rows)


def test_ids_and_places_of_many_bytes(spark):
    passage = " ".join(random.Random(6).choice(VOCABULARY) for _ in range(30))
    rows = [(-2**62, f"{'-' * 70_000}{passage}"), (2**62 + 5, f"{'+' * 200_000}{passage}+")]
    found = substrings.removal_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, found)) == _removal(rows)[0]


def test_long_texts_and_unique_ids(spark):
    rows = [r for r in messy_rows() if len(r[1] or "") > 5_000]
    assert len(rows) == 2
    found = substrings.removal_report(spark.createDataFrame(rows, DOCS)).orderBy("doc_id").collect()
    assert found[0].n_removed == 0 and found[1].n_removed == found[1].n_bytes


def test_removal_of_nothing(spark):
    docs = spark.createDataFrame([], DOCS)
    assert substrings.removal_report(docs).count() == 0
    assert substrings.remove_repeats(docs).count() == 0


def _paragraph_removal(rows):
    """Paragraphs as (row number, line, shingles), and their groups by links between all pairs."""
    found = []
    for n, r in enumerate(rows):
        for i, line in enumerate((r[1] or "").split("\n")):
            words = _words(line)
            if len(words) >= paragraphs.MIN_WORDS:
                found.append((n, i, _shingles(words)))
    return found, _groups([f[2] for f in found])


def test_paragraphs(spark):
    rng = random.Random(9)
    pool = [[rng.choice(VOCABULARY) for _ in range(rng.randint(12, 70))] for _ in range(40)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 5)):
            words = list(rng.choice(pool))
            for _ in range(rng.choice([0, 0, 1, 2])):
                words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
            lines.append(rng.choice(["", " "]) + " ".join(words))
        rows.append((i, rng.choice(["\n", "\n\n"]).join(lines + ["short line"])))
    found, group = _paragraph_removal(rows)
    expected = defaultdict(list)
    seen = set()
    for (n, i, _), g in zip(found, group):
        if g in seen:
            expected[n].append(i)
        seen.add(g)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.removed for r in paragraphs.repeated_paragraphs(docs).collect()}
    assert got == {i: expected.get(i, []) for i in range(60)}
    texts = {r.doc_id: r.text for r in paragraphs.remove_paragraphs(docs).collect()}
    for i, text in rows:
        assert texts[i] == "\n".join(x for k, x in enumerate(text.split("\n")) if k not in expected.get(i, []))


def test_short_paragraphs(spark):
    """Lines of one to nine words: copies in other case and spacing, near copies by four shingles of five, and unlike ones."""
    nine = "one two three four five six seven eight nine"
    lines = ["Home", "a b c d", "a b c d e", "a b c d e f g", nine, "", " ", "-"]
    rows = [(1, "\n".join(lines)), (2, "\n".join(x.upper().replace(" ", "  ") for x in lines)), (3, "Home page\na b c d f\nHome\nhome"),
            (4, "x " + nine[4:] + "\n" + nine[:-5] + "\none two three four five six seven x nine")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_paragraphs, r.removed) for r in paragraphs.repeated_paragraphs(docs).collect()}
    # the first eight words have four of the five shingles
    assert got == {1: (6, []), 2: (6, [0, 1, 2, 3, 4, 7]), 3: (4, [2, 3]), 4: (3, [1])}


def test_paragraphs_messy(spark):
    rows = messy_rows()
    docs = spark.createDataFrame(rows, DOCS)
    found = paragraphs.repeated_paragraphs(docs).collect()
    assert len(found) == len(rows)
    assert all(r.removed == [] for r in found if r.n_paragraphs == 0)
    assert paragraphs.remove_paragraphs(docs).columns == docs.columns
    assert paragraphs.remove_paragraphs(docs).count() == len(rows)
    assert paragraphs.repeated_paragraphs(docs.limit(0)).count() == 0


def _passage_words(rows):
    """By brute force: the words, as (row, line, word), of every 50 words of a line that a row of a smaller id has within a line too."""
    seen, out = {}, defaultdict(set)
    for n, (i, text) in enumerate(rows):
        for k, line in enumerate(text.split("\n")):
            words = _words(line)
            for a in range(len(words) - 49):
                first = seen.setdefault(tuple(words[a:a + 50]), i)
                if first < i:
                    out[n].update((k, b) for b in range(a, a + 50))
    return out


def test_passages_within_long_lines(spark):
    """Passages of 50 words and more in unlike long lines: each is found, and only words that an earlier document has too."""
    rng = random.Random(31)
    fresh = iter(range(10**6))
    own = lambda n: [f"{rng.choice(VOCABULARY)}{next(fresh)}" for _ in range(n)]
    passages = [own(rng.randint(50, 90)) for _ in range(40)]
    rows = []
    for i in range(160):
        lines = [" ".join(own(rng.randint(80, 200)) + passages[i % 40] + own(rng.randint(80, 200))), " ".join(own(30))]
        rows.append((i, rng.choice(["\n", "\n\n"]).join(rng.sample(lines, 2)) if i % 5 else lines[0].upper()))
    rows += [(500 + i, "  ".join(own(300))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r for r in paragraphs.repeated_paragraphs(docs).collect()}
    texts = {r.doc_id: r.text for r in paragraphs.remove_paragraphs(docs).collect()}
    truth = _passage_words(rows)
    assert len(truth) == 120
    for n, (i, text) in enumerate(rows):
        gone = {(p.line, b) for p in found[i].passages for b in range(p.at, p.at + p.n)}
        assert found[i].removed == [] and found[i].n_short == 0
        assert bool(gone) == bool(truth[n]) and gone <= truth[n]
        left = [" ".join(w for b, w in enumerate(line.split()) if (k, b) not in gone) for k, line in enumerate(text.split("\n"))]
        assert [" ".join(x.split()) for x in texts[i].split("\n")] == left
        if not gone:
            assert texts[i] == text


def test_passages_over_lines_of_any_length(spark):
    """Passages of 50 words and more broken into lines of 8 to 60 words, with own words before and after in the same lines."""
    rng = random.Random(32)
    fresh = iter(range(10**6))
    own = lambda n: [f"{rng.choice(VOCABULARY)}{next(fresh)}" for _ in range(n)]
    passages = [own(rng.randint(50, 70)) for _ in range(20)]
    rows = [(200, None), (201, ""), (202, " ".join(own(300)))]
    for i in range(60):
        words = own(rng.randint(30, 60)) + passages[i % 20] + own(rng.randint(30, 60))
        text, at = "", 0
        while at < len(words):
            size = rng.randint(8, 60)
            text, at = text + " ".join(words[at:at + size]) + rng.choice(["\n", "\n\n"]), at + size
        rows.append((i, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r for r in paragraphs.repeated_paragraphs(docs, across_lines=True).collect()}
    texts = {r.doc_id: r.text for r in paragraphs.remove_paragraphs(docs, across_lines=True).collect()}
    for i, text in rows:
        gone = {(p.line, b) for p in found[i].passages for b in range(p.at, p.at + p.n)}
        lines = [line.split() for line in (text or "").split("\n")]
        assert all(lines[k][b] in passages[i % 20] for k, b in gone)
        gone |= {(k, b) for k in found[i].removed for b in range(len(lines[k]))}
        assert bool(gone) == (20 <= i < 60)
        left = [w for k, line in enumerate(lines) for b, w in enumerate(line) if (k, b) not in gone]
        assert (texts[i] or "").split() == left


def test_a_line_that_goes_has_no_passages(spark):
    """A long line that goes as a whole is counted once, and short lines apart; null ids come last."""
    line = " ".join(f"w{k}" for k in range(120))
    more = " ".join(f"v{k}" for k in range(90))
    short = "\n\n".join(" ".join(f"s{j}x{k}" for k in range(9)) for j in range(6))
    rows = [(1, f"{line}\nhome\n{short}"), (2, f"{line}\nown words\nhome"), (3, f"{more} {line} home"), (4, f"{short}\nb\nhome"),
            (None, f"{more.upper().replace('V', 'u')} {line}"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.n_paragraphs): (r.removed, r.n_short, len(r.passages) > 0) for r in paragraphs.repeated_paragraphs(docs).collect()}
    # six short lines in a row are a passage of 54 words
    assert got == {(1, 8): ([], 0, False), (2, 3): ([0, 2], 1, False), (3, 1): ([], 0, True), (4, 8): ([0, 2, 4, 6, 8, 10, 12], 1, False),
                   (None, 1): ([], 0, True), (None, 0): ([], 0, False)}


def test_shared_passages_make_no_candidates(spark, monkeypatch):
    """Documents of passages that many others have too, but none similar: no key is left whose members would be paired."""
    rng = random.Random(21)
    pool = [" ".join(rng.choice(VOCABULARY) + str(rng.randrange(50)) for _ in range(40)) for _ in range(100)]
    rows = [(i, " ".join(rng.sample(pool, 5) + [f"own{i}word{k}" for k in range(20)])) for i in range(150)]
    rows += [(1000, rows[0][1]), (1001, rows[1][1] + " more")]
    seen = []
    link = linking.link

    def counted(index, *args, **settings):
        seen.append(index.count())
        return link(index, *args, **settings)

    monkeypatch.setattr(linking, "link", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert _got(near_join.near_copies(docs)) == _expected(rows)
    # the one near copy has some hundred keys; one pair of documents with a passage in common would have about ten
    assert seen[0] < 10 * len(rows)


def test_sets_of_other_nodes_are_not_fetched(spark):
    """Only the sets of nodes in pairs go on to be joined; numbers of either sign, a node in several pairs, no pair at all."""
    sets = spark.createDataFrame([(k * 7919 * (-1) ** k, bytes(8)) for k in range(2000)], "node long, items binary").repartition(3)
    nodes = [0, -7919, 2 * 7919, -7919]
    got = linking._sets_of(spark.createDataFrame([(n,) for n in nodes], "node long"), sets).collect()
    assert {r.node for r in got} >= set(nodes) and len(got) < 10 and all(r["items"] == bytes(8) for r in got)
    assert linking._sets_of(spark.createDataFrame([], "node long"), sets).count() == 0


def test_parts_of_similar_sets():
    """Similar sets keep a part in common, whatever their sizes and however frequent their tokens."""
    rng = random.Random(5)
    for n in [5, 6, 9, 14, 40, 41, 90, 333]:
        for _ in range(20):
            least = -(-4 * n // 5)
            own = rng.randint(least, n)
            a = np.array(sorted(rng.sample(range(1, 2**40), n)), np.uint64)
            # subsets, and sets with as many tokens of their own as similarity allows
            extra = max(0, 5 * own // 4 - n)
            b = np.unique(np.concatenate([np.array(rng.sample(a.tolist(), own), np.uint64), np.array(rng.sample(range(2**41, 2**42), extra), np.uint64)]))
            if not _similar(frozenset(a.tolist()), frozenset(b.tolist())):
                continue
            found = list(map(np.concatenate, zip(*near_join._part_keys([a, b], a[: rng.randint(0, n)]))))
            keys = [{(k, x) for o, k, x in zip(*found[:3]) if o == i} for i in (0, 1)]
            spare = {k: int(near_join.SPARE[k]) for k in found[1].tolist()}
            if _similar(frozenset(a.tolist()), frozenset(b.tolist())) and set(a.tolist()) != set(b.tolist()):
                both = keys[0] & keys[1]
                assert any(sum(k == kind for k, _ in both) > spare[kind] for kind in spare)
