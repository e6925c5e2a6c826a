"""Personal data, and the words around it that give it away, with DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.session import written

#: Kinds in the order in which spans with one start are listed. ``term`` marks words that disclose an entity.
KINDS = ["email", "ip", "card", "phone", "term"]

# The same matches as the plain patterns, in time that grows with the text: what can't be given back is possessive, and
# a match starts at the beginning of a run or where the last match ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this has no match.
HINTS = {"email": "@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}

#: Stands for a span in a text whose words are counted; words that touch a span are not counted.
_MARK = "\uE000"
_FREE_WORD = rf"(?<![\p{{L}}\p{{N}}{_MARK}])[\p{{L}}\p{{N}}]++(?!{_MARK})"

_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_WORD = r"[\p{L}\p{N}]++"


@dataclass(frozen=True)
class Disclosure:
    """When a word near an entity counts as giving it away."""

    #: Code points before and after an entity that are its near context.
    window: int = 48
    #: Pointwise mutual information of word and entity, as a share of the entity's information content.
    threshold: float = 0.8
    #: Contexts of the entity, near ones or whole texts, that must have the word.
    support: int = 3
    #: Shorter words are left alone.
    shortest: int = 3


def matches(text: Column, pattern: str) -> Column:
    """Every match with its first code point and the one after its last: ``array<struct<value, start, end>>``."""
    between = F.transform(F.split(text, pattern, -1), lambda piece: F.char_length(piece))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    start = F.struct(F.array().cast("array<struct<value:string,start:int,end:int>>").alias("out"), F.lit(0).alias("at"))

    def step(state: Column, pair: Column) -> Column:
        low = state["at"] + pair["gap"]
        high = low + F.char_length(pair["value"])
        return F.struct(
            F.concat(state["out"], F.array(F.struct(pair["value"].alias("value"), low.alias("start"), high.alias("end")))).alias("out"), high.alias("at")
        )

    # zip_with pads the shorter side; the piece after the last match has no value.
    pairs = F.filter(F.zip_with(between, found, lambda gap, value: F.struct(gap.alias("gap"), value.alias("value"))), lambda p: p["value"].isNotNull())
    return F.aggregate(pairs, start, step, lambda state: state["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    backwards = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(backwards, i, F.lit(1)).cast("int")
        double = 2 * digit
        return total + F.when(i % 2 == 1, digit).otherwise(F.when(double > 9, double - 9).otherwise(double))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


_SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"


def _spans_of(text: Column, kind: str) -> Column:
    """Spans of one kind; ``value`` names the entity."""
    held = F.filter(matches(text, PATTERNS[kind]), lambda m: _holds(kind, m["value"]))
    name = F.lower if kind in ("email", "ip") else _digits

    def span(m: Column) -> Column:
        return F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end"), name(m["value"]).alias("value"))

    return F.when(text.rlike(HINTS[kind]), F.transform(held, span)).otherwise(F.array().cast(_SPANS))


def base_spans(text: Column) -> Column:
    """Spans of all kinds but ``term``, by start and then kind."""
    return F.array_sort(F.concat(*(_spans_of(text, kind) for kind in KINDS[:-1])))


def _context(text: Column, spans: Column, rule: Disclosure) -> Column:
    """For every span: its entity, and the whole words within the window, up to the neighbouring spans."""
    size = F.char_length(text)

    def words_of(low: Column, high: Column) -> Column:
        # One more character on both sides shows whether a word at the edge is whole.
        wide_low, wide_high = F.greatest(low - 1, F.lit(0)), F.least(high + 1, size)
        piece = F.substr(text, wide_low + 1, F.greatest(wide_high - wide_low, F.lit(0)))
        whole = F.filter(matches(piece, _WORD), lambda m: (m["start"] + wide_low >= low) & (m["end"] + wide_low <= high))
        return F.filter(F.transform(whole, lambda m: F.lower(m["value"])), lambda word: F.char_length(word) >= rule.shortest)

    def of_span(span: Column, i: Column) -> Column:
        before = F.when(i > 0, F.element_at(spans, F.greatest(i, F.lit(1)))["end"]).otherwise(0)
        after = F.when(i + 1 < F.size(spans), F.element_at(spans, F.least(i + 2, F.size(spans)))["start"]).otherwise(size)
        low, high = F.greatest(before, span["start"] - rule.window), F.least(after, span["end"] + rule.window)
        words = F.concat(words_of(low, F.greatest(span["start"], low)), words_of(F.least(span["end"], high), high))
        return F.struct(F.concat(span["kind"].cast("string"), F.lit(":"), span["value"]).alias("entity"), words.alias("words"))

    return F.transform(spans, of_span)


def _different(words: Column, rule: Disclosure) -> Column:
    return F.filter(F.array_distinct(F.transform(words, F.lower)), lambda word: F.char_length(word) >= rule.shortest)


def _words_of(text: Column, rule: Disclosure) -> Column:
    """The different words of a whole text."""
    return _different(F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)), rule)


def _words_outside(text: Column, spans: Column, rule: Disclosure) -> Column:
    """The different words of a whole text, without those that lie in or touch ``spans``, with blanks between them."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    text = F.replace(text, F.lit(_MARK), F.lit(" "))

    def step(state: Column, s: Column) -> Column:
        ahead = F.concat(state["out"], F.substr(text, state["at"] + 1, s["start"] - state["at"]), F.lit(_MARK))
        return F.struct(F.when(s["start"] < state["at"], state["out"]).otherwise(ahead).alias("out"), F.greatest(state["at"], s["end"]).alias("at"))

    rest = F.aggregate(spans, start, step, lambda state: F.concat(state["out"], F.substr(text, state["at"] + 1)))
    free = F.when(F.size(spans) > 0, rest).otherwise(text)
    return F.array_join(_different(F.regexp_extract_all(free, F.lit(_FREE_WORD), F.lit(0)), rule), " ")


def _terms(text: Column, words: Column, spans: Column) -> Column:
    """Every occurrence of ``words`` in the whole text but for those inside of a base span, which is marked as it is."""
    between = F.transform(F.split(text, _WORD, -1), lambda piece: F.char_length(piece))
    found = F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))
    pairs = F.filter(F.zip_with(between, found, lambda gap, word: F.struct(gap.alias("gap"), word.alias("word"))), lambda p: p["word"].isNotNull())
    start = F.struct(F.array().cast(_SPANS).alias("out"), F.lit(0).alias("at"))

    def step(state: Column, pair: Column) -> Column:
        low, word = state["at"] + pair["gap"], F.lower(pair["word"])
        high = low + F.char_length(pair["word"])
        marked = F.array_contains(words, word) & ~F.exists(spans, lambda s: (s["start"] <= low) & (high <= s["end"]))
        term = F.struct(low.alias("start"), F.lit(KINDS.index("term")).alias("kind"), high.alias("end"), word.alias("value"))
        # Only what is marked is added, so that a long text is walked once.
        return F.struct(F.when(marked, F.concat(state["out"], F.array(term))).otherwise(state["out"]).alias("out"), high.alias("at"))

    return F.aggregate(pairs, start, step, lambda state: state["out"])


def _discloses(n: float, rule: Disclosure) -> Column:
    """By the counts of contexts with the entity, the word, and both; there are ``n`` contexts."""
    information = F.log(F.lit(n) / F.col("n_e"))
    mutual = F.log(F.col("n_ew") * F.lit(n) / (F.col("n_e") * F.col("n_w")))
    return (F.col("n_ew") >= rule.support) & (information > 0) & (mutual >= rule.threshold * information)


def _disclosing_near(contexts: DataFrame, rule: Disclosure) -> DataFrame:
    """``entity, word``, told from what stands near the entities."""
    # Copies of a passage are one context.
    different = written(contexts.select("entity", F.array_sort(F.array_distinct("words")).alias("words")).distinct())
    pairs = different.select("entity", F.explode("words").alias("word"))
    together = pairs.groupBy("entity", "word").agg(F.count(F.lit(1)).alias("n_ew")).where(F.col("n_ew") >= rule.support)
    of_entity = different.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    of_word = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_w"))
    counted = together.join(of_entity, "entity").join(of_word, "word")
    return counted.where(_discloses(float(different.count()), rule)).select("entity", "word")


def _disclosing_in_texts(found: DataFrame, rule: Disclosure) -> DataFrame:
    """``entity, word``, told from whole texts, with or without an entity."""
    ids = found.select("of_text", "row")
    firsts = ids.groupBy("of_text").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    # Copies of a text are one context. They are written, as with a known size they are broadcast if they are few.
    copies = written(ids.join(firsts, "of_text").where("row <> first").select("row"))
    texts = found.join(copies, "row", "left_anti")
    word = F.explode(F.split("free", " ")).alias("word")
    n = float(ids.select("of_text").distinct().count())

    entity = F.explode(F.array_distinct(F.transform("contexts", lambda c: c["entity"]))).alias("entity")
    holding = texts.where(F.size("spans") > 0)
    entities = holding.select("of_text", entity)
    of_entity = entities.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")).where(F.col("n_e") >= rule.support)
    entities = written(entities.join(of_entity, "entity"))
    of_word = texts.where("free <> ''").select(word).groupBy("word").agg(F.count(F.lit(1)).alias("n_w")).where(F.col("n_w") >= rule.support)
    words = holding.join(entities.select("of_text").distinct(), "of_text", "left_semi").select("of_text", word).join(of_word, "word")
    # No word of more texts reaches the threshold, even if all texts of the entity have it.
    most = F.lit(n * (1 + 1e-9)) * F.pow(F.col("n_e") / F.lit(n), F.lit(rule.threshold))
    pairs = entities.join(words, "of_text").where(F.col("n_w") <= most)
    counted = pairs.groupBy("entity", "word", "n_e", "n_w").agg(F.count(F.lit(1)).alias("n_ew"))
    return counted.where(_discloses(n, rule)).select("entity", "word")


def find_personal_data(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """``doc_id, spans`` for every row: personal data, and words that disclose it, by start and kind.

    E-mail addresses, IP addresses, card numbers and phone numbers are found by pattern and check. What stands with them
    is counted over the whole corpus: with ``n`` contexts in all, a word discloses an entity e if it occurs in
    ``support`` contexts of e and its pointwise mutual information with e, ``ln(n(e, w) n / (n(e) n(w)))``, reaches
    ``threshold`` of the information content of e, ``ln(n / n(e))``. That is asked twice, and either answer counts:
    contexts are the whole texts, with or without entities, equal texts once and without the words of the spans; and
    they are what stands within ``window`` around each entity, equal contexts of an entity once. In every text that
    holds e, such words get spans of kind ``term`` wherever they occur, but for occurrences inside of another span.

    A span has ``start``, ``kind`` (its place in ``KINDS``), ``end`` (exclusive; code points) and ``value``. A null text
    is empty and has no spans. Rows with the same id and text get the same spans; other columns are ignored. Texts are
    read once; after that only spans, the different words of each text and the texts that hold an entity move, and of
    the words of these texts only those that disclose some entity; what is counted is counted where it is read before it
    is shuffled. Words are paired only with entities of at least ``support`` texts.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("of_text")).withColumn("spans", base_spans(F.col("text")))
    context = F.when(F.size("spans") > 0, _context(F.col("text"), F.col("spans"), rule))
    held = F.when(F.size("spans") > 0, F.col("text"))
    free = _words_outside(F.col("text"), F.col("spans"), rule)
    columns = ["doc_id", "of_text", "spans", context.alias("contexts"), held.alias("text"), free.alias("free")]
    # The number of a row stays as it is written.
    found = written(rows.select(*columns, F.monotonically_increasing_id().alias("row")))

    contexts = found.where(F.size("spans") > 0).select("doc_id", "of_text", F.explode("contexts").alias("c"))
    contexts = contexts.select("doc_id", "of_text", "c.entity", "c.words")
    disclosing = written(_disclosing_near(contexts, rule).unionByName(_disclosing_in_texts(found, rule)).distinct())

    # A context has one entity, so a word discloses few of them, and the join on words grows with the texts.
    holds = contexts.select(F.col("doc_id").alias("d"), F.col("of_text").alias("t"), F.col("entity").alias("e")).distinct()
    words = found.where(F.size("spans") > 0).select("doc_id", "of_text", F.explode(_words_of(F.col("text"), rule)).alias("word"))
    of_doc = (F.col("doc_id").eqNullSafe(F.col("d"))) & (F.col("of_text") == F.col("t"))
    marked = words.join(disclosing, "word").join(holds, of_doc & (F.col("entity") == F.col("e")), "left_semi")
    # The words of one text; a text that occurs often adds nothing new to its set.
    known = written(marked.groupBy(F.col("doc_id").alias("d"), F.col("of_text").alias("t")).agg(F.collect_set("word").alias("words")))
    joined = found.select("doc_id", "of_text", "spans", "text").join(known, of_doc, "left")
    terms = F.when(F.col("words").isNotNull(), _terms(F.col("text"), F.col("words"), F.col("spans"))).otherwise(F.array().cast(_SPANS))
    return joined.select("doc_id", F.array_sort(F.concat("spans", terms)).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitized(text: Column, spans: Column) -> Column:
    """The text with every span generalised to its kind in angle brackets; of overlapping spans the first stays."""
    kinds = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(state: Column, s: Column) -> Column:
        replaced = F.concat(state["out"], F.substr(text, state["at"] + 1, s["start"] - state["at"]), F.element_at(kinds, s["kind"] + 1))
        return F.when(s["start"] < state["at"], state).otherwise(F.struct(replaced.alias("out"), s["end"].alias("at")))

    return F.aggregate(spans, start, step, lambda state: F.concat(state["out"], F.substr(text, state["at"] + 1)))
