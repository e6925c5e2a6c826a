"""Operators on whole texts: exact deduplication, sharding, pieces, personal data, quality, language."""

import hashlib
import random
import re
import uuid
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillflow.llm import language, pii, quality
from tillflow.llm.dedup import DigestIndex, deduplicate
from tillflow.llm.pieces import MARK, Decoder, Encoder, PieceModel, decode, encode
from tillflow.llm.queries import PIECE_MODEL
from tillflow.llm.shards import shard


@pytest.fixture
def index(spark, tmp_path):
    return DigestIndex(spark, f"digests_{uuid.uuid4().hex}", str(tmp_path / "index"), buckets=4)


def bare(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_classes(documents, edge_rows, random_texts, index):
    rows = [r for r in edge_rows if r[0] is not None] + [(i + 100, t) for i, t in random_texts]
    groups = defaultdict(list)
    for i, t in rows:
        groups[bare(t)].append((-len(t or ""), i))
    want = []
    for i, t in rows:
        members = groups[bare(t)]
        want.append((i, min(members)[1], len(members), i == min(members)[1], hashlib.sha256(bare(t).encode()).hexdigest()))
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in deduplicate(documents(rows), index).collect()]
    assert sorted(got) == sorted(want)


def test_index_persists_and_grows(spark, documents, index, tmp_path):
    assert deduplicate(documents([]), index).collect() == []
    deduplicate(documents([(1, "a b"), (2, "ab"), (3, "c"), (None, "c")]), index)
    assert sorted((r.keep_id, r.keep_chars) for r in index.read().collect()) == [(1, 3), (3, 1)]
    again = DigestIndex(spark, f"digests_{uuid.uuid4().hex}", str(tmp_path / "index"), buckets=4)
    spark.catalog.refreshTable(again.name)
    second = deduplicate(documents([(10, "a  b  "), (11, "new"), (12, "new ")]), again).collect()
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in second) == [(10, 1, False), (11, 12, False), (12, 12, True)]
    assert again.read().count() == 3


def test_index_side_is_not_shuffled(documents, index, capsys):
    groups = documents([(1, "a")]).select(F.unhex(F.sha2("text", 256)).alias("digest")).repartition(4, "digest")
    groups.join(index.read().hint("merge"), "digest", "left_anti").explain("formatted")
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and plan.count("Exchange") <= 2 * 2  # the round-robin of the fixture and ours; each is named twice


def capacity_of(sizes, shards):
    def fits(c):
        used, room = 1, c
        for s in sizes:
            if s > c:
                return False
            if s > room:
                used, room = used + 1, c
            room -= s
        return used <= shards

    return next(c for c in range(1, sum(sizes) + 1) if fits(c))


@pytest.mark.parametrize("shards", [1, 4, 16])
def test_shards(documents, edge_rows, random_texts, shards):
    rows = edge_rows + [(i + 100, t) for i, t in random_texts]
    got = shard(documents(rows), shards).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    for r in got:
        texts = [t or "" for i, t in rows if i == r.doc_id]
        assert any(r.size == len(t.encode()) + 1 and r.text_crc32 == zlib.crc32(t.encode()) for t in texts)
    slots, of_text, total = defaultdict(list), defaultdict(set), Counter()
    for r in got:
        slots[r.shard].append(r.slot)
        of_text[r.text_crc32].add(r.shard)
        total[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    assert all(len(s) == 1 for s in of_text.values())
    # The long text has a shard of its own; the others are cut at the least capacity for their order.
    groups = Counter()
    for _, t in rows:
        groups[t or ""] += len((t or "").encode()) + 1
    if shards > 1:
        largest = max(groups.values())
        del groups[max(groups, key=groups.get)]
        sizes = [groups[t] for t in sorted(groups, key=lambda t: hashlib.md5(t.encode()).digest())]
        assert max(v for v in total.values() if v != largest) == capacity_of(sizes, shards - 1)


def test_shards_of_nothing(documents):
    assert shard(documents([])).collect() == []
    assert [(r.size, r.shard, r.slot) for r in shard(documents([(1, None)])).collect()] == [(1, 0, 0)]


def test_a_hot_text_lies_in_one_shard(documents):
    rows = [(i, "the same text") for i in range(300)] + [(i, f"text number {i}") for i in range(300, 900)]
    got = shard(documents(rows)).collect()
    assert len({r.shard for r in got if r.doc_id < 300}) == 1
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.size
    others = sorted(sizes.values())[:-1]
    assert len(sizes) == 16 and max(others) - min(others) < 0.1 * max(others)


@pytest.fixture(scope="module")
def model():
    return PieceModel.load(PIECE_MODEL)


def test_ids_equal_those_of_the_library(documents, edge_rows, model):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    rng = random.Random(1)
    letters = "aehtinors  éß日,.\n0123'’𝄞\u0000"
    rows = [(i, t) for i, t in edge_rows if i is not None]
    rows += [(100 + i, "".join(rng.choice(letters) for _ in range(rng.choice([1, 5, 80])))) for i in range(150)]
    rows += [(500, "  two  spaces" + " " * 40 + "end" + " " * 17), (501, "internationalization of x = y[0] + 1;"), (502, "the" * 500), (503, "a▁b")]
    got = encode(documents(rows), model)
    texts = defaultdict(set)
    for i, t in rows:
        texts[i].add(t)
    for r in got.collect():
        assert any(r.ids == (library.encode(t) if t else []) for t in texts[r.doc_id]), r.doc_id
        assert r.exact == (r.doc_id != 503)
    back = {r.doc_id: r.text for r in decode(got, model).collect()}
    for i, t in rows:
        assert back[i] == (t or "").replace(MARK, " ")


def test_pieces_of_nothing(documents, model):
    assert encode(documents([]), model).collect() == []


@pytest.mark.parametrize(("piece", "kind"), [("a▁b", 1), ("<sep>", 4)])
def test_models_that_cannot_be_matched_are_refused(tmp_path, piece, kind):
    from sentencepiece import sentencepiece_model_pb2

    other = sentencepiece_model_pb2.ModelProto()
    with open(PIECE_MODEL, "rb") as file:
        other.ParseFromString(file.read())
    other.pieces[-1].piece, other.pieces[-1].type = piece, kind
    path = tmp_path / "other.model"
    path.write_bytes(other.SerializeToString())
    with pytest.raises(ValueError, match="only models"):
        PieceModel.load(str(path))


def test_words_of_earlier_generations_are_encoded_alike(model, monkeypatch):
    from tillflow.llm import pieces

    monkeypatch.setattr(pieces, "CACHED_WORDS", 20)
    monkeypatch.setattr(pieces, "KNOWN_PAIRS", 50)
    rng, known, encoder = random.Random(5), pieces._Known(model), Encoder(model)
    for _ in range(40):
        words = sorted({MARK + "".join(rng.choice("thenioß") for _ in range(rng.randint(1, 3))) for _ in range(15)})
        assert [tuple(memoryview(ids).cast("i")) for ids in known.of(words)] == list(encoder.encode(words))
        assert not known.lost and len(known.now) <= 20 + 2 * 15


def test_words_that_come_again_take_little_memory(model):
    import tracemalloc

    import pyarrow as pa

    from tillflow.llm import pieces

    known = pieces._Known(model)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(300)), "text": ["the and of to it be as on by or " * 100] * 300})
    list(pieces._encode(known, iter([batch.slice(0, 1)])))
    tracemalloc.start()
    found = list(pieces._encode(known, iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(b.num_rows for b in found) == 300 and all(x for b in found for x in b.column("exact").to_pylist())
    assert peak < 100 * 300_000  # bytes for each word


def test_summed_scores_give_the_best_segmentation():
    rng = random.Random(4)
    for _ in range(20):
        scores = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))): -rng.random() * 10 for _ in range(12)}
        scores |= {c: -rng.random() * 10 for c in "ab"}
        toy = PieceModel({p: i + 300 for i, p in enumerate(scores)}, scores, 0, 299, merges=False)
        encoder, decoder = Encoder(toy), Decoder(toy)
        words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(40)})
        for word, ids in zip(words, encoder.encode(words), strict=True):
            best = [0.0] + [-1e9] * len(word)
            for end in range(1, len(word) + 1):
                for start in range(end):
                    if word[start:end] in scores:
                        best[end] = max(best[end], best[start] + scores[word[start:end]])
                if best[end] == -1e9 or not any(word[s:end] in scores for s in range(end)):
                    best[end] = best[end - 1] + encoder.far
            names = {i: p for p, i in toy.pieces.items()}
            got = sum(scores[names[i]] if i in names else encoder.far for i in ids)
            assert got == pytest.approx(best[-1]) and decoder.decode(ids) == word


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_of(text):
    out = []
    for number, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            holds = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if holds:
                name = m[0].translate(str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})) if kind in ("email", "ip") else digits
                out.append((m.start(), number, m.end(), name))
    return sorted(out)


def terms_of(rows, rule):
    """Words that disclose an entity, by plain loops."""
    contexts = []
    for key, text in rows:
        spans = base_of(text)
        for i, s in enumerate(spans):
            low = max(spans[i - 1][2] if i else 0, s[0] - rule.window)
            high = min(spans[i + 1][0] if i + 1 < len(spans) else len(text), s[2] + rule.window)
            found = []
            for m in re.finditer(r"[^\W_]+", text):
                inside = low <= m.start() and m.end() <= s[0] or s[2] <= m.start() and m.end() <= high
                if inside and len(m[0]) >= rule.shortest:
                    found.append((m[0].lower(), m.start(), m.end()))
            contexts.append((key, (s[1], s[3]), found))
    different = {(e, tuple(sorted({w for w, _, _ in found}))) for _, e, found in contexts}
    n_e, n_w, n_ew = Counter(e for e, _ in different), Counter(w for _, ws in different for w in ws), Counter((e, w) for e, ws in different for w in ws)
    n, out = len(different), defaultdict(set)
    for key, e, found in contexts:
        for w, a, b in found:
            information = np.log(n / n_e[e])
            if n_ew[e, w] >= rule.support and information > 0 and np.log(n_ew[e, w] * n / (n_e[e] * n_w[w])) >= rule.threshold * information:
                out[key].add((a, pii.KINDS.index("term"), b, w))
    return out


def test_personal_data(documents, edge_rows):
    rng = random.Random(6)
    bits = ["Call", "+49 (30) 1234-5678", "4111 1111 1111 1111", "4111-1111-1111-1112", "a.b@c.de", "x@y", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1",
            "0001.2.3.255", "+1 22", "a@b.co_m@d.ef", "é", "@", "+", ".", "-", "12", "a@b..c", "+12345678901234567", "00000000000000000000"]
    rows = [(i, t) for i, t in edge_rows if i is not None]
    rows += [(100 + i, rng.choice([" ", "", ", "]).join(rng.choice(bits) for _ in range(rng.randint(1, 9)))) for i in range(200)]
    rows += [(900 + i, f"number {i} of {n} Ludwig wrote from anna@example.org on day{i} today") for i, n in enumerate(["one", "two", "three", "four"])]
    rows += [(950 + i, f"mail bob{i}@example.org today about something else {i}") for i in range(5)]
    rows += [(990, "9" * 3000 + " " + "a" * 20_000 + "@")]
    rule = pii.Disclosure()
    got = pii.find_personal_data(documents(rows), rule).collect()
    terms = terms_of([(i, t or "") for i, t in rows], rule)
    assert any(w == "ludwig" for found in terms.values() for *_, w in found) and not any(w == "today" for found in terms.values() for *_, w in found)
    want = sorted((i, sorted(base_of(t) + list(terms[i]))) for i, t in rows)
    assert sorted((r.doc_id, [tuple(s) for s in r.spans]) for r in got) == want


def test_addresses_with_parts_of_zero(documents):
    parts = ["0", "00", "000", "1", "010", "0255", "255", "256", "0256", "100"]
    rng = random.Random(7)
    rows = list(enumerate(["10.0.0.1", "0.0.0.0", "000.1.2.3", "192.168.0.1", "255.255.255.0", "0" * 4000 + ".0.0.0", "0" * 4000 + "256.0.0.0"]))
    rows += [(100 + i, f"at {'.'.join(rng.choice(parts) for _ in range(4))}, then") for i in range(200)]
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find_personal_data(documents(rows)).collect()}
    base = {i: [s for s in spans if s[1] != pii.KINDS.index("term")] for i, spans in got.items()}
    assert base == {i: base_of(t) for i, t in rows} and len(base[0]) == len(base[1]) == len(base[2]) == 1


def test_disclosing_words_in_whole_texts(documents):
    far = " and so on" * 30
    rows = [(i, f"Ludwig wrote on day{i} from anna@example.org") for i in range(4)]
    rows += [(10 + i, f"mail bob{i}@example.net about something else {i}") for i in range(30)]
    texts = [
        "anna@example.org" + far + ": ludwig said LUDWIG, Ludwigs éLudwig Ludwig",  # far from the address
        "anna@example.org, bob1@example.net, 10.0.0.1, Ludwig",  # behind other addresses
        "ludwig@example.com" + far + " Ludwig, see anna@example.org",  # inside of another span
        "Ludwig" + far + " wrote to bob2@example.net",  # without the entity
    ]
    texts.append("anna@example.org " + "word " * 60_000 + "𝄞 Ludwig")
    rows += [(100 + i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (100, texts[0])]
    rule = pii.Disclosure(threshold=0.4)
    got = [(r.doc_id, [tuple(s) for s in r.spans if s.kind == pii.KINDS.index("term")]) for r in pii.find_personal_data(documents(rows), rule).collect()]
    by_id = defaultdict(set)
    for i, spans in got:
        by_id[i].add(tuple((a, b) for a, _, b, w in spans if w == "ludwig"))

    def want(text):
        bases = [(a, b) for a, _, b, _ in base_of(text)]
        spots = [m.span() for m in re.finditer(r"[^\W_]+", text) if m[0].lower() == "ludwig"]
        return tuple(s for s in spots if not any(a <= s[0] and s[1] <= b for a, b in bases))

    assert [by_id[100 + i] for i in range(5)] == [{want(t)} if "anna" in t else {()} for t in texts]
    assert by_id[None] == by_id[100] and [len(want(t)) for t in texts] == [3, 1, 1, 1, 1]


def terms_of_whole_texts(rows, rule):
    """Entities and the words that disclose them, by plain loops over different whole texts."""
    texts = {}
    for text in {t or "" for _, t in rows}:
        spans = base_of(text)
        words = [m for m in re.finditer(r"[^\W_]+", text) if len(m[0]) >= rule.shortest and not any(m.start() <= b and a <= m.end() for a, _, b, _ in spans)]
        texts[text] = {(s[1], s[3]) for s in spans}, {m[0].lower() for m in words}
    n, n_e, n_w = len(texts), Counter(e for es, _ in texts.values() for e in es), Counter(w for _, ws in texts.values() for w in ws)
    n_ew = Counter((e, w) for es, ws in texts.values() for e in es for w in ws)
    reaches = lambda e, w: np.log(n_ew[e, w] * n / (n_e[e] * n_w[w])) >= rule.threshold * np.log(n / n_e[e]) > 0
    return {(e, w) for (e, w), k in n_ew.items() if k >= rule.support and reaches(e, w)}


def test_disclosing_words_are_counted_in_whole_texts(documents):
    rng = random.Random(8)
    far = " and so on" * 30
    rows = [(i, f"Ludwig and Clara, {i}{far} anna@example.org") for i in range(4)]  # far from the address
    rows += [(10 + i, f"Clara spoke about {rng.random()}") for i in range(40)]  # often in texts without it
    rows += [(60 + i, f"anna@example.org, x{i}@example.net{far}: Otto {i}") for i in range(3)]  # behind another address
    rows += [(70 + i, f"Hedwig{far} carl@example.org") for i in range(5)]  # copies are one text
    rows += [(80 + i, f"about{far} {i} emil@example.org, éTheodor@example.org \uE000Hugo ") for i in range(3)] + [(None, None), (90, "")]
    rule = pii.Disclosure()
    disclosing = terms_of_whole_texts(rows, rule)
    assert {w for _, w in disclosing} == {"ludwig", "otto", "hugo"} and not any(terms_of(rows, rule).values())

    def want(text):
        spans = base_of(text or "")
        words = {w for e, w in disclosing if e in {(s[1], s[3]) for s in spans}}
        return [(m.start(), pii.KINDS.index("term"), m.end(), m[0].lower()) for m in re.finditer(r"[^\W_]+", text or "") if m[0].lower() in words]

    got = [(str(r.doc_id), [tuple(s) for s in r.spans if s.kind == pii.KINDS.index("term")]) for r in pii.find_personal_data(documents(rows), rule).collect()]
    assert sorted(got) == sorted((str(i), want(t)) for i, t in rows)


def test_personal_data_of_nothing(documents):
    assert pii.find_personal_data(documents([])).collect() == []


def test_sanitized(spark):
    spans = [(4, 0, 10, "a"), (6, 1, 9, "b"), (11, 4, 14, "c")]
    df = spark.createDataFrame([("mail x@y.de bob", spans)], f"text string, spans {pii._SPANS}")
    assert df.select(pii.sanitized(F.col("text"), F.col("spans"))).first()[0] == "mail<EMAIL>e<TERM>b"[:4] + "<EMAIL>e<TERM>b"


def test_a_text_with_very_many_matches(documents):
    text = "12 1.2.3.4 x@y.de " * 4000
    got = pii.find_personal_data(documents([(1, text)])).first()
    assert len(got.spans) == 8000 and all(a.start < b.start for a, b in pairwise(got.spans))


def test_quality_of_held_out_documents(spark, data):
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    held_out = language.remainder(F.col("doc_id"), 3) == 1
    found, classifier = quality.score_quality(docs, labels, ~held_out)
    rows = found.where(held_out).join(labels, "doc_id").collect()
    assert np.mean([(r.score >= 0.5) == (r.quality == 1) for r in rows]) > 0.9
    assert (np.diff(classifier.calibrated) >= 0).all()


def test_quality_of_edge_cases(spark, documents, edge_rows):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (5, 1), (9, None), (None, 1), (77, 0)], "doc_id long, quality int")
    found, _ = quality.score_quality(documents(edge_rows), labels, F.lit(True))
    rows = found.collect()
    assert len(rows) == len(edge_rows) and all(0 <= r.score <= 1 for r in rows)
    nothing, _ = quality.score_quality(documents(edge_rows), labels.limit(0), F.lit(True))
    assert {r.score for r in nothing.collect()} == {0.5}
    assert quality.score_quality(documents([]), labels, F.lit(True))[0].collect() == []


def test_isotonic_fit_is_the_closest():
    assert quality._isotonic(np.array([1.0, 0.0, 2.0, 2.0, 1.0]), np.array([1.0, 3.0, 1.0, 1.0, 2.0])).tolist() == [0.25, 0.25, 1.5, 1.5, 1.5]


def test_languages_of_held_out_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    held_out = language.remainder(F.col("doc_id"), 4) == 2
    found = language.identify(docs, language.train(docs.where(~held_out)))
    rows = found.where(held_out).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97


@pytest.fixture(scope="module")
def three_languages(spark):
    texts = {"en": "the cat and the dog went with her to the house of her father", "de": "der hund und die katze gingen nicht mit ihm in das haus",
             "ru": "кошка и собака пошли вместе домой к отцу вечером"}
    rows = [(t, lang) for lang, t in texts.items() for _ in range(5)] + [("und so weiter", None), (None, "de")]
    return texts, language.train(spark.createDataFrame(rows, "text string, lang string"), penalty=8.0)


def test_spans_of_mixed_text(documents, three_languages):
    texts, model = three_languages
    row = language.identify(documents([(1, f"{texts['en']}. {texts['ru']}, 1234 {texts['de']}")]), model).first()
    assert [s.lang for s in row.spans] == ["en", "ru", "de"]
    assert [(s.first, s["last"]) for s in row.spans] == [(0, 13), (14, 22), (23, 34)]
    assert 0 < row.score < 1


def test_best_path_is_viterbi():
    rng = np.random.default_rng(3)
    scores = rng.normal(0, 2, (60, 3)).astype(np.float32)
    first = np.array([0, 0, 7, 8, 40, 60, 60])
    got = language._best_path(scores, first, 1.5)
    for a, b in pairwise(first):
        best = {(k,): float(scores[a, k]) for k in range(3)} if b > a else {(): 0.0}
        for i in range(a + 1, b):
            ends = {}
            for path, value in best.items():
                for k in range(3):
                    v = value + float(scores[i, k]) - 1.5 * (k != path[-1])
                    if k not in ends or v > ends[k][1]:
                        ends[k] = ((*path, k), v)
            best = dict(ends.values())
        assert tuple(got[a:b]) == max(best, key=best.get)


@pytest.mark.parametrize("languages", [127, 128, 200, 300])
def test_best_path_among_many_languages(languages):
    want = np.arange(2 * languages) % languages
    got = language._best_path(10 * np.eye(languages, dtype=np.float32)[want], np.array([0, languages, 2 * languages]), 1.0)
    assert got.tolist() == want.tolist()


def test_two_hundred_languages(spark, documents):
    rng = random.Random(8)
    texts = {f"l{k:03}": " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(8)) for k in range(200)}
    model = language.train(spark.createDataFrame([(t, lang) for lang, t in texts.items()], "text string, lang string"), penalty=8.0)
    rows = language.identify(documents(list(enumerate(texts.values()))), model).collect()
    assert {r.doc_id: r.lang_pred for r in rows} == dict(enumerate(texts))


def test_texts_without_letters(spark, documents, edge_rows, three_languages):
    _, model = three_languages
    rows = language.identify(documents(edge_rows + [(20, "— … ·")]), model).collect()
    assert len(rows) == len(edge_rows) + 1
    for r in rows:
        assert (r.lang_pred == "und") == (r.doc_id in (2, 3, 4, 9, 20) or (r.doc_id is None and r.score == 0))
    nothing = language.train(spark.createDataFrame([], "text string, lang string"))
    assert {r.lang_pred for r in language.identify(documents(edge_rows), nothing).collect()} == {"und"}
    assert language.identify(documents([]), model).collect() == []
