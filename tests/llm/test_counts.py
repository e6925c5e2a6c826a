"""Operators on words: language-model scores, decontamination, the Jaccard join; each against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tillflow.llm import decontaminate, jaccard, words
from tillflow.llm.components import components
from tillflow.llm.fmindex import FMIndex
from tillflow.llm.jaccard import Allocation, Join, allocate, linked, near_classes
from tillflow.llm.lm import LanguageModel, score

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def not_space(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


@pytest.mark.parametrize(("kind", "split"), [(words.ALNUM, alnum), (words.NOT_SPACE, not_space)])
def test_word_hashes_tell_words_apart(edge_rows, random_texts, kind, split):
    texts = [t or "" for _, t in [*edge_rows, *random_texts]]
    by_hash = {}
    for text, hashes in zip(texts, words.hash_words(texts, kind), strict=True):
        found = split(text)
        assert len(found) == len(hashes)
        for word, h in zip(found, hashes.tolist(), strict=True):
            assert by_hash.setdefault(h, word) == word
    assert len(by_hash) == len({w for t in texts for w in split(t)})


def colliding(n):
    """Two different words of ``n`` letters that a polynomial modulo 2**64 takes for one if ``n`` is 1,024 or more."""
    one = "".join("ab"[i.bit_count() % 2] for i in range(n))
    return one, one.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [64, 255, 256, 257, 1024, 4096])
def test_words_of_a_pattern_do_not_collide(n):
    one, other = colliding(n)
    hashes = [h[0] for h in words.hash_words([one, other, one.upper(), one], words.ALNUM)]
    assert hashes[0] != hashes[1] and hashes[0] == hashes[2] == hashes[3]


def test_colliding_words_have_no_links_hits_or_counts(spark, documents):
    one, other = colliding(1024)
    docs = documents([(1, one), (2, other), (3, other.upper())])
    assert {r["doc_id"]: r["component_id"] for r in near_classes(docs, Join(3, 90)).collect()} == {1: 1, 2: 2, 3: 2}
    items = spark.createDataFrame([("x", one)], "item_id string, text string")
    hits = {r["doc_id"]: r["n_hit"] for r in decontaminate.find_passages(docs, items).collect()}
    assert hits == {1: 1, 2: 0, 3: 0}


def test_chunks_of_any_size_give_the_same_words(random_texts):
    import pyarrow as pa

    column = pa.array([None, *(t for _, t in random_texts)])
    whole = np.concatenate([words.words(c, words.NOT_SPACE).hashes for c in words.chunks(column)])
    small = np.concatenate([words.words(c, words.NOT_SPACE).hashes for c in words.chunks(column.slice(0), 7)])
    assert (whole == small).all()


def scores_of(rows, model):
    docs = [alnum(t) for _, t in rows]
    counts = [Counter(tuple(d[i : i + k]) for d in docs for i in range(len(d) - k + 1)) for k in range(1, model.order + 1)]
    total = sum(map(len, docs))
    out = []
    for d in docs:
        log, backed = 0.0, 0
        for i in range(len(d)):
            longest = min(model.order, i + 1)
            for k in range(longest, 0, -1):
                less = 0 if model.own or k == 1 else 1
                n = counts[k - 1][tuple(d[i - k + 1 : i + 1])] - less
                if n > 0:
                    context = counts[k - 2][tuple(d[i - k + 1 : i])] - less if k > 1 else total
                    log += math.log(n / context) + (longest - k) * math.log(model.backoff)
                    backed += k < longest
                    break
        out.append((len(d), backed, round(log, 6)))
    return out


@pytest.mark.parametrize("model", [LanguageModel(), LanguageModel(order=1), LanguageModel(order=2, own=True), LanguageModel(order=4, own=True), LanguageModel(order=4, backoff=0.1)])
@pytest.mark.parametrize("block_bytes", [1 << 20, 400])
def test_scores(documents, random_texts, edge_rows, model, block_bytes):
    rows = random_texts + [r for r in edge_rows if r[0] != 5]
    got = score(documents(rows), model, block_bytes).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_backed_off, round(r.log_score, 6)) for r in got) == sorted(
        (str(i), *s) for (i, _), s in zip(rows, scores_of(rows, model), strict=True)
    )
    assert all((r.mean_log_score is None) == (r.n_words == 0) for r in got)


def test_scores_of_nothing(documents):
    assert score(documents([])).collect() == []


def test_index_counts_and_finds():
    rng = np.random.default_rng(1)
    for _ in range(60):
        largest = int(rng.integers(1, 6))
        sequence = rng.integers(1, largest + 1, rng.integers(0, 50))
        index = FMIndex(sequence, largest, int(rng.integers(1, 9)))
        phrases, lengths = rng.integers(1, largest + 1, (20, 4)), rng.integers(1, 5, 20)
        low, high = index.search(phrases, lengths)
        for k in range(20):
            phrase = phrases[k, 4 - lengths[k] :]
            places = [i for i in range(len(sequence) - lengths[k] + 1) if (sequence[i : i + lengths[k]] == phrase).all()]
            assert sorted(index.locate(np.arange(low[k], high[k]))) == places


def hits_of(docs, items, window):
    windows = {}
    for item, text in items:
        w = alnum(text)
        k = min(window, len(w))
        for i in range(len(w) - k + 1):
            if w:
                windows.setdefault(tuple(w[i : i + k]), set()).add("null" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, names = alnum(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in windows:
                    hit.update(range(i, i + k))
                    names |= windows[tuple(w[i : i + k])]
        out.append((str(doc), len(w), len(hit), sorted(names)))
    return sorted(out)


@pytest.mark.parametrize("window", [13, 4, 1])
@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_passages(spark, documents, random_texts, edge_rows, window, block_bytes, monkeypatch):
    rng = random.Random(2)
    rows = random_texts + edge_rows
    items = [(7, None), (8, ""), (9, "..."), (None, "quick brown fox"), (10, "fox jumps over"), (10, "the old river"), (11, "w1")]
    for i in range(12):
        w = alnum(rng.choice(random_texts)[1])
        items.append((i + 20, " ".join(w[rng.randrange(len(w)) :] if w else [])))
    monkeypatch.setattr(decontaminate, "SHARD_DOCS", 9)
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, n_words string")
    got = decontaminate.find_passages(documents(rows), benchmark, window, block_bytes).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in got) == hits_of(rows, items, window)
    by_id = {r.doc_id: r for r in got}
    for doc, text in random_texts:
        cut = [alnum(text[s.start : s.end]) for s in by_id[doc].spans]
        assert cut == [alnum(text)[s.first : s["last"] + 1] for s in by_id[doc].spans]


def test_passages_of_an_empty_benchmark(spark, documents, edge_rows):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.find_passages(documents(edge_rows), benchmark).collect()
    assert len(got) == len(edge_rows) and all(r.n_hit == 0 and not r["items"] for r in got)
    assert decontaminate.find_passages(documents([]), benchmark).collect() == []


def test_cutting_spans(spark):
    df = spark.createDataFrame([("abcdef é ghi", [(1, 3), (7, 9)]), ("xyz", [])], "text string, spans array<struct<start:int,end:int>>")
    from pyspark.sql import functions as F

    assert [r[0] for r in df.select(decontaminate.without_spans(F.col("text"), F.col("spans"))).collect()] == ["adef ghi", "xyz"]


def set_of(text, n):
    w = not_space(text)
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def classes_of(rows, n, percent):
    """All pairs, then the smallest id of each component."""
    ids = sorted({i for i, _ in rows if i is not None})
    sets = {i: set_of(t, n) for i, t in rows if i is not None}
    component = {i: i for i in ids}

    def root(i):
        while component[i] != i:
            i = component[i]
        return i

    for a in ids:
        for b in ids:
            x, y = sets[a], sets[b]
            if a < b and x and y and 100 * len(x & y) >= percent * len(x | y):
                one, two = root(a), root(b)
                component[max(one, two)] = min(one, two)
    return sorted((i, len(sets[i]), root(i)) for i, _ in rows if i is not None)


@pytest.mark.parametrize("join", [Join(3, 90), Join(5, 80), Join(1, 50, band_growth=2.5), Join(2, 70, band_growth=1.5, overlap=0.9)])
def test_near_classes(documents, random_texts, edge_rows, join):
    rows = random_texts + edge_rows
    got = near_classes(documents(rows), join).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None) == classes_of(rows, join.n, join.percent)
    assert all(r.component_id is None for r in got if r.doc_id is None)


def test_near_classes_of_a_large_group_with_few_links(documents):
    """Members of one bucket that link only in part: later rounds have to find the other links."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(60):
        own = [f"o{i // 2}x{k}" for k in range(14)]
        rows.append((i, " ".join(base + own + [f"z{i}" for _ in range(i % 2)])))
    rng.shuffle(rows)
    join = Join(1, 90)
    got = near_classes(documents(rows), join).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == classes_of(rows, 1, 90)


@pytest.mark.parametrize("small", [2, 4, 1000])
def test_near_classes_by_pairs_and_by_pivots(documents, random_texts, edge_rows, monkeypatch, small):
    monkeypatch.setattr(jaccard, "SMALL_BUCKET", small)
    rows = random_texts + edge_rows
    got = near_classes(documents(rows), Join(2, 70, band_growth=1.5)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None) == classes_of(rows, 2, 70)


def test_unrelated_documents_are_not_verified(documents, monkeypatch):
    rng = random.Random(11)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    near = text(200)
    rows = [(i, text(rng.randrange(100, 400))) for i in range(300)] + [(1000, near), (1001, near + " more")]
    seen = []
    texts = jaccard._texts
    monkeypatch.setattr(jaccard, "_texts", lambda docs, join, nodes: seen.append(nodes.count()) or texts(docs, join, nodes))
    got = {r.doc_id: r.component_id for r in near_classes(documents(rows), Join(5, 80)).collect()}
    assert got == {i: i for i, _ in rows} | {1001: 1000}
    assert len(seen) == 1 and seen[0] <= 10


def test_entries_of_linked_sets_meet_without_empty_segments():
    rng = np.random.default_rng(4)
    for join in (Join(5, 80), Join(3, 90), Join(1, 50, band_growth=2.5)):
        for size in (1, 2, 5, 17, 60, 300, 1500):
            band = int(join.band(np.array(size)))
            a = jaccard.with_spare(join, band, allocate(join, band, 100))
            tolerated = join.most_different(size)
            for deletions in {0, min(2, a.exact // 2)}:
                b = Allocation(a.exact - 2 * deletions, deletions, a.spare)
                for _ in range(5):
                    x = rng.integers(0, 2**64, size, np.uint64)
                    gone = int(rng.integers(0, min(tolerated, size - 1) + 1))
                    y = np.concatenate([x[gone:], rng.integers(0, 2**64, min(tolerated - gone, 1), np.uint64)])
                    found = [set(jaccard._signatures(np.sort(s), words.mixed(np.sort(s)), band, b).tolist()) for s in (x, y)]
                    assert found[0] & found[1]


def test_sketches_differ_in_no_more_than_the_sets():
    rng = np.random.default_rng(5)
    for sizes in ((0, 3), (1, 1), (40, 64), (64, 65), (100, 300), (1000, 1100)):
        shared = rng.integers(0, 2**64, min(sizes) // 2, np.uint64)
        one, other = (np.concatenate([shared, rng.integers(0, 2**64, n - len(shared), np.uint64)]) for n in sizes)
        differ = jaccard._sketches_differ(jaccard._sketch(one), jaccard._sketch(other))
        assert differ <= sum(sizes) - 2 * len(shared) and (differ + sum(sizes)) % 2 == 0
        assert jaccard._sketches_differ(jaccard._sketch(one), jaccard._sketch(one)) == 0


def test_near_classes_of_nothing(documents):
    assert near_classes(documents([])).collect() == []
    assert [r.component_id for r in near_classes(documents([(4, None)])).collect()] == [4]


def test_links_are_real(documents, random_texts):
    _, _, links = linked(documents(random_texts), Join(2, 60, band_growth=1.7))
    texts = dict(random_texts)
    for r in links.collect():
        x, y = set_of(texts[r.a], 2), set_of(texts[r.b], 2)
        assert r.a < r.b and 100 * len(x & y) >= 60 * len(x | y)


def test_allocation_covers_the_tolerance_and_follows_the_cost():
    join = Join(3, 90)
    for band in range(1, 20):
        for n in (1, 10**9):
            a = allocate(join, band, n)
            assert a.exact + 2 * a.deletion == join.most_different(join.largest(band)) + 1
    assert allocate(join, 8, 10) == Allocation(join.most_different(join.largest(8)) + 1, 0)
    assert allocate(join, 8, 10**12).deletion > 0
    with pytest.raises(ValueError):
        Join(3, 50, band_growth=1.4)


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(None, 2), (2, None)], [(i, i + 1) for i in range(40)], [(5, 4), (4, 5), (9, 5), (7, 8), (8, 6)]])
def test_components(spark, edges):
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    links = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    want = {n: n for e in links for n in e}
    for _ in want:
        for a, b in links:
            want[a] = want[b] = min(want[a], want[b])
    assert got == want
