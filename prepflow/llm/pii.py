r"""Personal data, and the words around it that give it away.

Direct identifiers are found by patterns. The information-theoretic step then asks
which terms of the same documents reveal an identifier: with frequencies n over N
different texts, a term t tells log2(N n(t,e) / (n(t) n(e))) bits of the log2(N / n(e))
bits that name the entity e. A term that tells at least ``threshold`` of them, and shares
more texts with e than chance explains, is sanitised too. DataFrame functions only.
"""

from __future__ import annotations

import re

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, texts, words_of

# Runs are matched from their start only (or from where a match ended) and possessively, so the search is linear.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "term"]
#: A text without this pattern has no match of the kind.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
PART = "trim(LEADING '0' FROM p)"
LUHN = (
    "aggregate(sequence(1, length(d)), 0, (s, i) -> s + CASE WHEN i % 2 = 1 THEN cast(substr(d, length(d) - i + 1, 1) AS int) "
    "ELSE element_at(array(0, 2, 4, 6, 8, 1, 3, 5, 7, 9), cast(substr(d, length(d) - i + 1, 1) AS int) + 1) END) % 10 = 0"
)
VALID = {
    "email": "true",
    "ip": f"forall(split(x.value, '[.]'), p -> CASE WHEN length({PART}) > 3 THEN false ELSE cast(concat('0', {PART}) AS int) <= 255 END)",
    "card": "element_at(transform(array(regexp_replace(x.value, '[^0-9]', '')), d -> "
    f"CASE WHEN length(d) BETWEEN 12 AND 19 THEN {LUHN} ELSE false END), 1)",
    "phone": "length(regexp_replace(x.value, '[^0-9]', '')) BETWEEN 9 AND 15",
}
SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"
WORD = r"[^\p{L}\p{N}]+"


def find_spans(text: str, kind: str) -> F.Column:
    """Valid matches of one kind in column ``text`` as an array of (start, rank, end, kind, value), in code points."""
    pattern = PATTERNS[kind].replace("\\", "\\\\")
    needed = f"contains({text}, '{NEEDS[kind]}') AND " if NEEDS[kind] else ""
    found = f"CASE WHEN {needed}true THEN regexp_extract_all({text}, '{pattern}', 0) ELSE cast(array() AS array<string>) END"
    # the gaps between matches give their places
    placed = (
        f"element_at(transform(array({found}), m -> CASE WHEN size(m) = 0 THEN cast(array() AS {SPAN}) ELSE "
        f"element_at(transform(array(split({text}, '{pattern}', -1)), g -> aggregate(sequence(1, size(m)), "
        f"named_struct('at', 0, 'spans', cast(array() AS {SPAN})), (a, i) -> named_struct("
        "'at', a.at + length(g[i - 1]) + length(m[i - 1]), 'spans', concat(a.spans, array(named_struct("
        f"'start', a.at + length(g[i - 1]), 'rank', {KINDS.index(kind)}, 'end', a.at + length(g[i - 1]) + length(m[i - 1]), "
        f"'kind', '{kind}', 'value', m[i - 1]))))).spans), 1) END), 1)"
    )
    return F.expr(f"filter({placed}, x -> {VALID[kind]})")


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and ``base``: all valid matches by start, then kind. A null text counts as empty."""
    d = texts(docs, id_col, text_col)
    for kind in PATTERNS:
        d = d.withColumn(f"_{kind}", find_spans("text", kind))
    return d.select("doc_id", "text", F.array_sort(F.concat(*[f"_{k}" for k in PATTERNS])).alias("base"))


ENTITY = "concat(s.kind, ':', CASE WHEN s.kind IN ('card', 'phone') THEN regexp_replace(s.value, '[^0-9]', '') ELSE lower(s.value) END)"
#: The text with each identifier overwritten by U+FFFF, code point for code point, so that words keep their places.
MASKED = (
    "aggregate(base, named_struct('at', 0, 'out', ''), (x, s) -> CASE WHEN s.end <= x.at THEN x ELSE named_struct('at', s.end, 'out', "
    "concat(x.out, substring(text, x.at + 1, greatest(s.start - x.at, 0)), repeat('\\uffff', s.end - greatest(s.start, x.at)))) END, "
    "x -> concat(x.out, substring(text, x.at + 1)))"
)
STEP = 256  # words between the places that are kept while a text is searched


def plain(word: F.Column) -> F.Column:
    return F.regexp_replace(F.lower(word), WORD, "")


def terms_of(masked: F.Column) -> F.Column:
    """The different terms of a masked text: words outside identifiers, without punctuation and case, and no function words."""
    words = F.filter(words_of(masked), lambda w: ~F.contains(w, F.lit("\uffff")))
    idle = sorted({re.sub("[^a-z]", "", w.lower()) for w in StopWordsRemover.loadDefaultStopWords("english")} | {""})
    return F.array_except(F.transform(words, plain), F.array(*map(F.lit, idle)))


def occurrences() -> F.Column:
    """Where the words of ``masked`` are that have one of the ``terms``, as spans."""
    total = "aggregate(slice(g, cast({first} AS int), cast({n} AS int)), 0, (n, w) -> n + length(w) + 1)"
    chunk = total.format(first=f"1 + {STEP} * k", n=STEP)
    before = total.format(first=f"1 + {STEP} * ((i - 1) div {STEP})", n=f"(i - 1) % {STEP}")
    heads = f"aggregate(sequence(0, cast((size(g) - 1) div {STEP} AS int)), array(0), (a, k) -> concat(a, array(element_at(a, -1) + {chunk})))"
    found = f"filter(sequence(1, size(g)), i -> NOT contains(g[i - 1], '\\uffff') AND array_contains(terms, regexp_replace(lower(g[i - 1]), r'{WORD}', '')))"
    lead = r"length(o.word) - length(regexp_replace(o.word, r'^[^\p{L}\p{N}]+', ''))"
    core = r"regexp_replace(o.word, r'^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$', '')"
    placed = (
        "element_at(transform(array(split(translate(masked, '\\t\\n\\u000b\\u000c\\r', '     '), ' ')), g -> "
        f"element_at(transform(array({heads}), h -> transform({found}, i -> "
        f"named_struct('at', h[(i - 1) div {STEP}] + {before}, 'word', g[i - 1]))), 1)), 1)"
    )
    return F.expr(
        f"transform({placed}, o -> named_struct('start', o.at + {lead}, 'rank', {KINDS.index('term')}, "
        f"'end', o.at + {lead} + length({core}), 'kind', 'term', 'value', {core}))"
    )


def surprise(n: str, n_t: str, n_e: str, n_te: str) -> F.Column:
    """A lower bound of -ln P for ``n_te`` or more shared texts, were the ``n_t`` texts drawn from all ``n`` without regard to the ``n_e``.

    Hoeffding's bound, which holds without replacement. Either set may be seen as the drawn one; the better bound counts.
    """

    def bound(drawn: str, marked: str) -> F.Column:
        r, q = F.col(n_te) / F.col(drawn), F.col(marked) / F.col(n)
        rest = F.when(r < 1, (1 - r) * F.log((1 - r) / (1 - q))).otherwise(F.lit(0.0))
        return F.when(r > q, F.col(drawn) * (r * F.log(r / q) + rest)).otherwise(F.lit(0.0))

    return F.greatest(bound(n_t, n_e), bound(n_e, n_t))


def term_counts(docs: DataFrame, copies: DataFrame, wanted: DataFrame, most_broadcast: int) -> DataFrame:
    """h (a term's hash) and n_t, the number of different texts that have it, for the wanted hashes.

    A text with c copies counts a c-th for each, so no text is shuffled to find the copies.
    """
    words = docs.withColumn("text_hash", F.xxhash64("text")).join(copies, "text_hash", "left")
    hashes = F.array_distinct(F.transform(words_of(F.col("text")), lambda w: F.xxhash64(plain(w))))
    words = words.select(F.explode(hashes).alias("h"), (1 / F.coalesce("copies", F.lit(1))).alias("part"))
    words = words.join(F.broadcast(wanted) if wanted.count() <= most_broadcast else wanted, "h", "left_semi")
    return words.groupBy("h").agg(F.round(F.sum("part")).alias("n_t"))


def disclosing_terms(held: DataFrame, slim: DataFrame, docs: DataFrame, threshold: float, risk: float, most_broadcast: int = 500_000) -> DataFrame:
    """text_hash and ``terms``, the terms of the text that tell too much about one of its entities.

    ``held``: text_hash, entities and terms of the different texts with identifiers. All
    counts are of different texts, so exact copies are no evidence. A term in n(t) texts can
    tell enough of e only if n(t) <= N^(1 - threshold) n(e)^threshold; the others are left
    out before terms meet entities. That loses nothing.

    The rest must also be unlikely by chance: P(n(t,e) or more shared texts) times the number
    of terms tried for e is at most ``risk``. An entity of a single text can pass, if there
    are some twenty times more texts than terms in its text.
    """
    copies = settle(slim.groupBy("text_hash").agg(F.count("*").alias("copies")), "pii-copies")
    total = float(copies.count())
    copies = settle(copies.where("copies > 1"), "pii-copies")

    def most(n_e):
        return F.lit(total ** (1 - threshold) * (1 + 1e-9)) * F.pow(n_e, F.lit(threshold))

    named = held.select("text_hash", F.size("terms").alias("tried"), F.explode("entities").alias("entity"))
    of_entity = settle(named.groupBy("entity").agg(F.count("*").cast("double").alias("n_e"), F.sum("tried").alias("tried")), "pii-entities")
    widest = of_entity.agg(F.max("n_e")).first()[0] or 0.0
    listed = held.select("text_hash", F.explode("terms").alias("term")).withColumn("h", F.xxhash64("term"))
    wanted = settle(listed.groupBy("h").count().where(F.col("count") <= most(F.lit(widest))).select("h"), "pii-wanted")
    seen = settle(term_counts(docs, copies, wanted, most_broadcast).where(F.col("n_t") <= most(F.lit(widest))), "pii-counts")
    listed = listed.join(F.broadcast(seen) if seen.count() <= most_broadcast else seen, "h").select("text_hash", "term", "n_t")
    beside = listed.join(named.select("text_hash", "entity").join(of_entity, "entity"), "text_hash").where(F.col("n_t") <= most(F.col("n_e")))
    pairs = beside.groupBy("entity", "term").agg(F.count("*").cast("double").alias("n_te"), *[F.max(c).alias(c) for c in ("n_t", "n_e", "tried")])
    pairs = pairs.withColumn("n", F.lit(total))
    share = F.expr("CASE WHEN n_e < n THEN log2(n * n_te / (n_t * n_e)) / log2(n / n_e) ELSE 0.0D END")
    sure = surprise("n", "n_t", "n_e", "n_te") >= F.log(F.col("tried") / F.lit(risk)) - 1e-9
    told = settle(pairs.where((share >= threshold - 1e-9) & sure).select("entity", "term"), "pii-told")
    return beside.join(told, ["entity", "term"], "left_semi").groupBy("text_hash").agg(F.collect_set("term").alias("terms"))


def sanitise(docs: DataFrame, threshold: float = 0.8, risk: float = 0.05, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: doc_id, text_hash, base (spans) and spans (base and disclosing terms).

    Spans are (start, rank, end, kind, value). Null and empty texts have none; repeated
    rows get the same spans; an empty table gives an empty result. Terms are the words of
    the whole text but for those that touch an identifier, and are marked in every text
    that also has the identifier they reveal.
    """
    d = base_spans(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text")).withColumn("text", F.translate("text", "\uffff", "\ufffe"))
    masked = F.when(F.size("base") > 0, F.expr(MASKED)).alias("masked")
    slim = settle(d.select("doc_id", "text_hash", "base", masked), "pii-spans")
    entities = F.expr(f"array_distinct(transform(base, s -> {ENTITY}))").alias("entities")
    held = slim.where("masked IS NOT NULL").select("text_hash", "masked", entities).dropDuplicates(["text_hash"])
    held = settle(held.withColumn("terms", terms_of(F.col("masked"))), "pii-held")
    hits = disclosing_terms(held, slim, texts(docs, id_col, text_col), threshold, risk)
    hits = settle(held.select("text_hash", "masked").join(hits, "text_hash").select("text_hash", occurrences().alias("terms")), "pii-hits")
    both = F.expr(f"array_sort(concat(base, coalesce(terms, cast(array() AS {SPAN}))))")
    return slim.drop("masked").join(hits, "text_hash", "left").select("doc_id", "text_hash", "base", both.alias("spans"))


def joined(spans: str) -> F.Column:
    return F.expr(f"concat_ws(',', transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)))")


def redact(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The texts with identifiers generalised to ``[KIND]`` and disclosing terms to ``[TERM]``; overlapping spans become one."""
    d = texts(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    once = found.dropDuplicates(["doc_id", "text_hash"])
    d = d.alias("a").join(once.alias("b"), F.expr("a.doc_id <=> b.doc_id AND a.text_hash = b.text_hash"), "left")
    rebuilt = F.expr(
        "aggregate(coalesce(spans, array()), named_struct('at', 0, 'out', ''), (x, s) -> CASE WHEN s.start < x.at THEN "
        "named_struct('at', greatest(x.at, s.end), 'out', x.out) ELSE named_struct('at', s.end, 'out', "
        "concat(x.out, substring(text, x.at + 1, s.start - x.at), '[', upper(s.kind), ']')) END, "
        "x -> concat(x.out, substring(text, x.at + 1)))"
    )
    return d.select("a.doc_id", rebuilt.alias("text"))
