"""License notices, fill-in-the-middle and resampling, each against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_counts import alnum

from tillflow.llm import infill, licenses, resample, runs
from tillflow.llm.words import ALNUM, NOT_SPACE, chunks

MIXED = ["a", "B", "é", "日", "<", "P", "S", "M", ">", " ", "\n", "\t", ".", "𝄞", "\x00", "\xa0"]


@pytest.fixture(scope="module")
def mixed_texts():
    rng = random.Random(11)
    return ["".join(rng.choice(MIXED) for _ in range(rng.choice([0, 1, 2, 5, 30, 200]))) for _ in range(300)]


# --- runs of bytes


@pytest.mark.parametrize("slab", [1, 7, 64, 1 << 20])
def test_runs_in_slabs(mixed_texts, slab):
    for chunk in chunks(pa.array(mixed_texts), 500):
        starts, ends = runs.runs(chunk.data, chunk.bounds, NOT_SPACE, slab)
        got = [bytes(chunk.data[a:b]).decode() for a, b in zip(starts, ends, strict=True)]
        assert got == [w for t in mixed_texts[chunk.low : chunk.high] for w in re.findall(r"[^\x20\x09-\x0D]+", t)]


def test_checksums():
    rng = random.Random(3)
    words = [bytes(rng.randrange(256) for _ in range(rng.choice([1, 2, 7, 47, 48, 49, 300]))) for _ in range(200)]
    ends = np.cumsum([len(w) for w in words])
    data = np.frombuffer(b"".join(words), np.uint8)
    assert runs.checksums(data, ends - [len(w) for w in words], ends).tolist() == [zlib.crc32(w) for w in words]
    assert len(runs.checksums(data, ends[:0], ends[:0])) == 0


# --- fill-in-the-middle


def numbers(doc_id, seed):
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def rearranged(doc_id, text, seed=42, rate=50, spm_rate=80):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n = len(units)
    h1, h2, h3, h4 = numbers(doc_id, seed)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm_rate:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def as_text(rows):
    return sorted(str(tuple(r)) for r in rows)


@pytest.mark.parametrize(("rate", "spm_rate"), [(50, 80), (100, 0), (100, 100), (0, 50), (100, 40)])
def test_fill_in_middle(spark, documents, edge_rows, mixed_texts, rate, spm_rate):
    rows = edge_rows + list(enumerate([*mixed_texts, "<P> marked", "almost <P", "> almost", "x" * 70_000, " " * 3000], 100))
    found = infill.restore(infill.fill_in_middle(documents(rows), rate=rate, spm_rate=spm_rate)).collect()
    want = [(i, *rearranged(i, t, rate=rate, spm_rate=spm_rate), t or "") for i, t in rows]
    assert as_text(found) == as_text(want)
    assert infill.restore(infill.fill_in_middle(documents([]))).collect() == []


@pytest.mark.parametrize("slab", [5, 64])
def test_fill_in_middle_of_texts_longer_than_a_slab(monkeypatch, mixed_texts, slab):
    monkeypatch.setattr(infill, "SLAB", slab)
    rng = random.Random(slab)
    for chunk in chunks(pa.array(mixed_texts), 400):
        texts = mixed_texts[chunk.low : chunk.high]
        form = np.array([0 if not t or re.search("<[PSM]>", t) else rng.randrange(3) for t in texts])
        cuts = np.array([[rng.randrange(1 << 32) for _ in texts] for _ in range(2)])
        out = infill._cut(chunk, form, *cuts)["output"]
        assert [len(o) - len(t) for o, t in zip(out.to_pylist(), texts, strict=True)] == np.where(form > 0, 9, 0).tolist()
        for back in chunks(out, 1 << 20):
            assert infill._uncut(back, form[back.low : back.high]).to_pylist() == texts[back.low : back.high]


# --- resampling


def drawn(docs, target, rule):
    def bucket(word):
        return zlib.crc32(word.encode()) % rule.buckets

    def counts(texts):
        return Counter(bucket(w) for t in texts for w in alnum(t))

    s, t = counts([x for _, x in docs]), counts(target)
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + rule.buckets) / ((s[b] + 1) * (n_t + rule.buckets)))) for b in range(rule.buckets)]
    out = []
    for i, text in docs:
        g = [gain[bucket(w)] for w in alnum(text)]
        weight = sum(g) // len(g) if g else 0
        h = int(hashlib.sha256(f"{rule.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    able = sorted((r for r in out if r[1] >= rule.least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    k = rule.percent * len(able) // 100
    ranks = {id(r): n for n, r in enumerate(able[:k], 1)}
    return [(*r, ranks.get(id(r))) for r in out]


@pytest.mark.parametrize("rule", [resample.Draw(), resample.Draw(percent=37, least_words=2), resample.Draw(percent=100, least_words=0, buckets=64)])
def test_resample(spark, documents, edge_rows, random_texts, rule):
    rows = edge_rows + random_texts + [(8, "a")] * 30
    target = ["w1 w2 w3 w4 alpha", "", None, "w7 " * 40, "é x-y 1.5"]
    got = resample.resample(documents(rows), documents(list(enumerate(target))), rule).collect()
    assert as_text(got) == as_text(drawn(rows, target, rule))


def test_resample_without_enough(documents):
    target = documents([(1, "a b c")])
    assert resample.resample(documents([]), target).collect() == []
    short = resample.resample(documents([(1, "a"), (2, None)]), documents([])).collect()
    assert sorted((r.doc_id, r.n_features, r.rank) for r in short) == [(1, 1, None), (2, 0, None)]


def test_all_scores_tied(spark):
    # One id, one text: rows that only their place tells apart, of which exactly a tenth is drawn.
    text = " ".join(["same"] * 30)
    docs = spark.range(1000).select(F.lit(5).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    ranks = [r.rank for r in resample.resample(docs, docs.limit(1)).collect()]
    assert sorted(r for r in ranks if r) == list(range(1, 101)) and ranks.count(None) == 900


@pytest.mark.parametrize("seed", range(5))
def test_cutoff_is_the_smallest_that_suffices(seed):
    rng = random.Random(seed)
    spread = [3, 100, 1 << 20, 1 << 62][seed % 4]
    values = sorted(rng.randrange(-spread, spread) for _ in range(200))
    jobs = []

    def count(tried):
        assert tried == sorted(tried) and len(tried) <= resample.TRIED
        jobs.append(1)
        return [sum(v <= t for v in values) for t in tried]

    for needed in (1, 2, 57, 200):
        jobs.clear()
        assert resample._least(values[0], values[-1], needed, count) == values[needed - 1]
        assert len(jobs) <= 12


# --- licenses


def notices(text, templates):
    words, step = alnum(text), licenses.stride(templates)
    base, labels, base_labels, score = [], set(), set(), 0.0
    for low in range(0, len(words), step):
        block = words[low : low + 2 * step]
        for t in templates:
            share = len(set(block) & set(t.words))
            if share < t.least:
                continue
            places = [low + p for p in range(min(step, len(block))) if block[p : p + len(t.words)] == t.words]
            if t.phrase and not places:
                continue
            labels.add(t.label)
            score = max(score, share / len(set(t.words)))
            if t.base:
                base += places
                base_labels.add(t.label)
    ends = (min(base), max(base)) if base else (None, None)
    return len(words), len(base), *ends, ",".join(sorted(base_labels)), ",".join(sorted(labels)), score


@pytest.fixture(scope="module")
def license_texts():
    rng = random.Random(17)
    filler = [f"w{i}" for i in range(40)] + ["license", "the", "public", "of", "MIT", "software", "K"]
    out = ["MIT\nLicense", "mit licens", "the Apache  LICENSE, version 2.0", "GNU General-Public\tLicense mit license mit license", "mıt license", "general public"]
    for t in licenses.TEMPLATES:
        for lost in (0, 0.1, 0.2, 0.3):
            words = t.text.split()
            kept = [w if rng.random() >= lost else rng.choice(filler) for w in words]
            before, after = ([rng.choice(filler) for _ in range(rng.choice([0, 3, 27, 28, 29, 57, 58, 90]))] for _ in range(2))
            out.append(" ".join([*before, *kept, *after]))
    return out


def test_license_scan(documents, edge_rows, license_texts):
    rows = edge_rows + list(enumerate(license_texts, 100)) + [(101, license_texts[0])]
    got = licenses.scan(documents(rows)).collect()
    want = [(i, *notices(t, licenses.TEMPLATES)) for i, t in rows]
    assert as_text(got) == as_text(want)
    assert {label for *_, labels, _ in want for label in labels.split(",")} >= {t.label for t in licenses.TEMPLATES}
    assert licenses.scan(documents([])).collect() == []


def test_templates_as_parameters(documents, license_texts):
    templates = [licenses.Template("half", "w1 w2 w3 w4 w5 w6", 0.5), licenses.Template("one", "public", phrase=True, base=True), licenses.Template("rep", "w7 w7 w8", 1.0)]
    rows = list(enumerate(license_texts))
    assert as_text(licenses.scan(documents(rows), templates).collect()) == as_text((i, *notices(t, templates)) for i, t in rows)
    with pytest.raises(ValueError, match="more than"):
        licenses.scan(documents(rows), [licenses.Template("x", " ".join(f"w{i}" for i in range(licenses.VOCABULARY + 1)))])


def test_license_scan_is_native(documents, license_texts):
    plan = licenses.scan(documents(list(enumerate(license_texts))))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_words_agree_with_the_pattern(mixed_texts):
    for chunk in chunks(pa.array(mixed_texts)):
        data = resample._LOWER[chunk.data]
        starts, ends = runs.runs(data, chunk.bounds, ALNUM)
        assert [bytes(data[a:b]).decode() for a, b in zip(starts, ends, strict=True)] == [w for t in mixed_texts for w in alnum(t)]
