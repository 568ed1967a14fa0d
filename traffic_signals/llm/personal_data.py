r"""Operator 8: personal data by patterns and by information-theoretic sanitisation. DataFrame expressions only.

Patterns find emails, IP addresses, card and phone numbers: the protected entities. The corpus then tells which words give an entity
away: for an entity e and a word t, p(e | t) = (documents with t and e) / (documents with t), and

    disclosure = PMI(e, t) / IC(e) = 1 + ln p(e | t) / -ln p(e)

is 1 for a word that only ever stands in documents of the entity and about 0 for one that is independent of it. In the documents
that mention the entity every occurrence of a word is removed if its score is REMOVE or more, and generalised if it is GENERALISE or
more: to the longest beginning of it that some word of so many documents shares that the class of all words with this beginning can't
disclose the entity, such as `[zeb*]`, or to `[TERM]` if there is none.

Most values are rare, so evidence is pooled: an entity is a value, and also each group it belongs to (an email's domain and name, the
front of a number). A kind as a whole is none, as the placeholder names it anyway. Estimates from n different texts are smoothed,
p(e | t) ** w * p(e) ** (1 - w) with w = n / (n + PRIOR), which multiplies the disclosure by w: a word's only text, or copies of it,
prove little, whatever the size of the corpus.

All counts cover the whole corpus and whole documents; a word counts where it stands outside of the mentions. Positions are worked out
in folds whose cost grows with the text, not with the text times its spans. Only documents with a mention take part in joins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, staged

PRIOR = 0.75  # texts that the prior counts for
REMOVE, GENERALISE = 0.9, 0.8
TERM = r"\p{L}{3,}"
PREFIX = 3, 12  # letters of a beginning that a word is generalised to
PIECE = 256  # code points of the pieces that texts are cut from

# The patterns of the contract. Look-behinds let a match start only at the start of a run of its first class (or right after the
# match before), which finds the same matches without trying every start in a long run; possessive repeats can't give back
# anything that the pattern could still use, and keep Java's matcher from recursing over long texts.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "term")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once: what stands in the lambda of an array function is computed for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(items: Column, start: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> Column:
    """array<kind> of what a fold gives for each item; step(state, item) is (next state, output).

    Outputs are gathered in blocks of 64, so an array isn't copied for each of very many items.
    """
    none = F.array().cast(f"array<{kind}>")
    numbers = lambda xs: F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / 64).cast("int"))
    blocks = bound(items, lambda xs: F.transform(numbers(xs), lambda i: F.slice(xs, i * 64 + 1, 64)))

    def one(acc: Column, x: Column) -> Column:
        state, out = step(acc.state, x)
        return F.struct(state.alias("state"), F.concat(acc.out, F.array(out)).alias("out"))

    def block(acc: Column, b: Column) -> Column:
        done = F.aggregate(b, F.struct(acc.state.alias("state"), none.alias("out")), one)
        return F.struct(done.state.alias("state"), F.concat(acc.out, F.array(done.out)).alias("out"))

    walked = F.aggregate(blocks, F.struct(start.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("out")), block)
    return F.flatten(walked.out)


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, m>> of the leftmost non-overlapping matches, in code points, ends exclusive.

    The pieces between the matches and the matches themselves, in turn, make up the text, so running sums of their lengths are places.
    """
    kind = "struct<start:int,end:int,m:string>"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    both = F.transform(F.arrays_zip(gaps.alias("g"), found.alias("m")), lambda x: F.struct(x.g.alias("g"), F.length(x.m).alias("n"), x.m.alias("m")))
    both = F.filter(both, lambda x: x.m.isNotNull())

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        end = at + x.g + x.n
        return end, F.struct((at + x.g).alias("start"), end.alias("end"), x.m.alias("m"))

    return F.when(text.rlike(pattern), running(both, F.lit(0), step, kind)).otherwise(F.array().cast(f"array<{kind}>"))


def pieces_of(text: Column) -> Column:
    """The text in pieces of PIECE code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def cut(pieces: Column, start: Column, end: Column) -> Column:
    """The text from start to end, read from the pieces that hold it alone."""
    first = F.floor(start / PIECE).cast("int")
    near = F.array_join(F.slice(pieces, first + 1, F.floor((end - 1) / PIECE).cast("int") - first + 1), "")
    return F.when(end > start, F.substring(near, start - first * PIECE + 1, end - start)).otherwise(F.lit(""))


def edited(pieces: Column, length: Column, edits: Column, by: Callable[[Column], Column]) -> Column:
    """The text after edits (start, end, ...), by start: spans are replaced by by(edit), which also knows at (the end of all before) and
    fresh. Where spans overlap, the one that starts first stands for all, and the text under the others goes."""
    kind = "struct<at:int,start:int,fresh:boolean,pad:int,by:string>"

    def step(at: Column, e: Column) -> tuple[Column, Column]:
        pad = F.greatest(F.lit(0), e.end - F.greatest(at, e.start))
        return F.greatest(at, e.end), F.struct(at.alias("at"), e.start.alias("start"), (e.start >= at).alias("fresh"), pad.alias("pad"), e.by.alias("by"))

    walked = running(edits, F.lit(0), step, kind)
    parts = F.transform(walked, lambda w: F.concat(cut(pieces, w.at, w.start), by(w)))
    return F.concat(F.array_join(parts, ""), cut(pieces, F.array_max(F.transform(edits, lambda e: e.end)), length))


def luhn(digits: Column) -> Column:
    """Whether a string of at most 19 digits passes Luhn's check."""
    back = lambda d: F.transform(F.sequence(F.lit(1), F.length(d)), lambda i: d.substr(i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1))
    each = bound(F.reverse(digits), back)
    return F.aggregate(each, F.lit(0), lambda s, v: s + F.when(v > 9, v - 9).otherwise(v)) % 10 == 0


def only_digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def passes(kind: str, m: Column) -> Column:
    if kind == "ip":
        fits = lambda p: (F.length(p) <= 3) & F.coalesce(p.try_cast("int") <= 255, F.lit(True))
        return F.forall(F.split(m, r"\."), lambda p: fits(F.ltrim(p, F.lit("0"))))
    if kind == "card":
        d = only_digits(m)
        return F.when(F.length(d).between(14, 19), luhn(d)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(only_digits(m)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """array<struct<start, kind, end, m>> of all kinds, by start, then kind."""

    def of(kind: int, name: str, pattern: str, needs: str | None) -> Column:
        good = F.filter(matches(text, pattern), lambda x: passes(name, x.m))
        found = F.transform(good, lambda x: F.struct(x.start.alias("start"), F.lit(kind).alias("kind"), x.end.alias("end"), x.m.alias("m")))
        return F.when(text.contains(needs), found).otherwise(F.array()) if needs else found

    every = [of(i, *p) for i, p in enumerate((("email", EMAIL, "@"), ("ip", IP, "."), ("card", CARD, None), ("phone", PHONE, "+")))]
    return F.array_sort(F.concat(*every))


def entities_of(kind: Column, m: Column) -> Column:
    """The value of a mention and the groups that it belongs to; a group is marked by a star."""
    digits, low = only_digits(m), F.lower(m)
    name = F.regexp_extract(low, r"^[^@a-z]*([a-z]+)[^@]*@", 1)
    email = F.array(low, F.concat(F.lit("*@"), F.substring_index(low, "@", -1)), F.concat(name, F.lit("*@")))
    ip = F.array(low, F.concat(F.substring_index(low, ".", 3), F.lit(".*")), F.concat(F.substring_index(low, ".", 2), F.lit(".*")))
    card, phone = F.array(digits, F.concat(digits.substr(1, 6), F.lit("*"))), F.array(digits, F.concat(digits.substr(1, 4), F.lit("*")))
    every = F.when(kind == 0, email).when(kind == 1, ip).when(kind == 2, card).otherwise(phone)
    return F.transform(F.filter(every, lambda e: e != "*@"), lambda e: F.concat(kind.cast("string"), F.lit(":"), e))


def terms_of(text: Column) -> Column:
    """The different words of a text, lowered one by one."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def blanked(pieces: Column, length: Column, base: Column) -> Column:
    """The text with line ends in place of the mentions, so that words outside of them keep their places."""
    edits = F.transform(base, lambda b: F.struct(b.start.alias("start"), b.end.alias("end"), F.lit("").alias("by")))
    return edited(pieces, length, edits, lambda w: F.repeat(F.lit("\n"), w.pad))


def disclosing(hits: DataFrame, docs: DataFrame, total: int, prior: float, remove: float, generalise: float) -> DataFrame:
    """(unit, marks): for different texts with mentions, the words in them that give an entity of theirs away, as
    map<word, struct<remove, by>>.

    hits: (unit, base, text, blank) of the documents with a mention; docs: all documents.
    """
    trust = F.col("texts") / (F.col("texts") + prior)  # a bound of the score: no entity or word below the threshold can be in a pair above
    # Equal texts are one piece of evidence, named by 64 bits.
    first = lambda c, name: F.first(c).alias(name)
    entities = F.array_distinct(F.flatten(F.transform("base", lambda s: entities_of(s.kind, s.m))))
    units = hits.groupBy("unit").agg(F.count("*").alias("copies"), first("base", "base"), first("text", "text"), first("blank", "blank"))
    units = units.select("unit", "copies", entities.alias("entities"), terms_of(F.col("blank")).alias("terms"), F.array_except(terms_of(F.col("text")), terms_of(F.col("blank"))).alias("inside"))
    units = staged(units, "mention-texts")
    # Entities that stand in the same texts are one class to words, and so are words to entities: a long list of values and names costs
    # one pair, not each with each.
    same = lambda name: (F.bit_xor(F.xxhash64("unit")).alias(f"{name}1"), F.bit_xor(F.xxhash64("unit", F.lit(name))).alias(f"{name}2"))
    owned = units.select("unit", "copies", F.explode("entities").alias("entity"))
    named = owned.groupBy("entity").agg(F.sum("copies").alias("n_entity"), F.count("*").alias("texts"), *same("e")).where((trust >= generalise) & (F.col("n_entity") < total)).drop("texts")
    # n_both is n_entity at most, so no word in more documents than this can reach the threshold with the entity.
    named = named.withColumn("most", F.col("n_entity") * F.pow(F.lit(total) / F.col("n_entity"), F.lit(1 - generalise)) * (1 + 1e-9))
    owners = staged(owned.join(named, "entity").drop("entity").distinct(), "entity-texts")
    most = owners.agg(F.max("most")).first()[0] or 0.0
    held = units.join(owners.select("unit").distinct(), "unit", "left_semi").select("unit", F.explode("terms").alias("term"))
    # Document frequencies of all words, less the documents where a word stands in mentions alone.
    words = docs.select(F.explode(terms_of(F.coalesce("text", F.lit("")))).alias("term"), F.lit(1).alias("n")).unionByName(units.select(F.explode("inside").alias("term"), (-F.col("copies")).alias("n")))
    words = staged(words.groupBy("term").agg(F.sum("n").alias("n_term")), "word-counts")
    usable = held.groupBy("term").agg(F.count("*").alias("texts"), *same("t")).where(trust >= generalise).drop("texts").join(words.where(F.col("n_term") <= most), "term")
    held = staged(held.join(usable, "term"), "words-near-mentions")
    pairs = held.groupBy("unit", "t1", "t2").agg(F.min("n_term").alias("rarest")).join(owners, "unit").where(F.col("rarest") <= F.col("most"))
    pairs = pairs.groupBy("e1", "e2", "t1", "t2").agg(F.sum("copies").alias("n_both"), F.count("*").alias("texts"), F.min("n_entity").alias("n_entity"), F.min("most").alias("most")).where(trust >= generalise)
    given = F.least(F.lit(1.0), F.col("n_both") / F.col("n_term"))
    scored = pairs.join(held.select("t1", "t2", "term", "n_term").distinct(), ["t1", "t2"]).withColumn("score", trust * (1 + F.log(given) / -F.log(F.col("n_entity") / F.lit(total))))
    scored = staged(scored.where(F.col("score") >= generalise).select("e1", "e2", "term", "score", "most"), "disclosing-terms")
    known = scored.join(kept_letters(scored.where(F.col("score") < remove), words), ["e1", "e2", "term"], "left")
    known = known.select("e1", "e2", "term", "score", F.coalesce("letters", F.lit(0)).alias("letters"))
    marks = held.select("unit", "term").join(known, "term").join(owners.select("unit", "e1", "e2"), ["unit", "e1", "e2"]).groupBy("unit", "term").agg((F.max("score") >= remove).alias("remove"), F.min("letters").alias("letters"))
    general = F.when(F.col("letters") > 0, F.concat(F.lit("["), F.col("term").substr(F.lit(1), F.col("letters")), F.lit("*]"))).otherwise(F.lit("[TERM]"))
    mark = F.struct("term", F.struct("remove", F.when(F.col("remove"), F.lit("")).otherwise(general).alias("by")).alias("mark"))
    return marks.groupBy("unit").agg(F.map_from_entries(F.collect_list(mark)).alias("marks"))


def kept_letters(soft: DataFrame, words: DataFrame) -> DataFrame:
    """(e1, e2, term, letters): how many first letters of a word to be generalised are safe to keep.

    A beginning is safe if some word that has it stands in more documents than `most`: so do then all words with it together, and in
    so many documents nothing can disclose the entity.
    """
    few, many = PREFIX

    def beginnings(df: DataFrame, *carry: str, less: int) -> DataFrame:
        lengths = F.sequence(F.lit(few), F.least(F.length("term") - less, F.lit(many)))
        return df.where(F.length("term") - less >= few).select(*carry, F.explode(lengths).alias("letters")).withColumn("start", F.col("term").substr(F.lit(1), F.col("letters")))

    asked = beginnings(soft, "e1", "e2", "term", "most", less=1)
    common = beginnings(words, "term", "n_term", less=0).join(asked.select("start").distinct(), "start").groupBy("start").agg(F.max("n_term").alias("largest"))
    return asked.join(common, "start").where(F.col("largest") > F.col("most")).groupBy("e1", "e2", "term").agg(F.max("letters").alias("letters"))


def annotated(docs: DataFrame, carry: tuple[str, ...], prior: float, remove: float, generalise: float) -> tuple[DataFrame, DataFrame]:
    """(rows without a mention: doc; rows with one: doc, base, pieces, length, terms). doc holds the columns in carry; terms is
    array<struct<start, end, by>>."""
    read_once = docs.select(F.struct(*carry).alias("doc"), F.coalesce("text", F.lit("")).alias("text")).withColumn("base", base_spans(F.col("text")))
    every = staged(read_once.select("doc", F.when(F.size("base") > 0, F.col("text")).alias("text"), F.when(F.size("base") > 0, F.col("base")).alias("base")), "personal-data")
    hits = every.where(F.col("base").isNotNull()).withColumns({"pieces": pieces_of(F.col("text")), "length": F.length("text")})
    hits = hits.withColumns({"blank": blanked(F.col("pieces"), F.col("length"), F.col("base")), "unit": F.xxhash64("text")})
    hits = staged(hits.drop("pieces"), "mentions")
    marks = disclosing(hits, docs.select("text"), every.count(), prior, remove, generalise)
    found = F.filter(matches(F.col("blank"), TERM), lambda w: F.map_contains_key("marks", F.lower(w.m)))
    spans = F.transform(found, lambda w: F.struct(w.start.alias("start"), w.end.alias("end"), F.element_at("marks", F.lower(w.m)).by.alias("by")))
    none = F.array().cast("array<struct<start:int,end:int,by:string>>")
    terms = F.when(F.col("marks").isNotNull(), spans).otherwise(none)
    return every.where(F.col("base").isNull()).select("doc"), hits.join(marks, "unit", "left").select("doc", "base", "text", "length", terms.alias("terms"))


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s.kind + 1), s.start, s.end)), ",")


def report(docs: DataFrame, prior: float = PRIOR, remove: float = REMOVE, generalise: float = GENERALISE) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans: one row for each row of docs (doc_id, text).

    Null and empty texts have no spans; texts may be of any length. Overlapping spans of different kinds are all reported, in the order
    of their starts, then of their kinds. Repeated rows are reported each, and alike; rows that share an id don't mix. An empty table
    gives no rows; further columns are not read.
    """
    plain, hits = annotated(docs, ("doc_id",), prior, remove, generalise)
    bare = F.transform("base", lambda b: F.struct(b.start.alias("start"), b.kind.alias("kind"), b.end.alias("end")))
    terms = F.transform("terms", lambda t: F.struct(t.start.alias("start"), F.lit(KINDS.index("term")).alias("kind"), t.end.alias("end")))
    count = lambda k: F.size(F.filter("base", lambda b: b.kind == k)).cast("long").alias(f"n_{KINDS[k]}")
    some = hits.select("doc.doc_id", *map(count, range(4)), F.sha2(written(bare), 256).alias("base_sha256"), written(F.array_sort(F.concat(bare, terms))).alias("spans"))
    return some.unionByName(plain.select("doc.doc_id", *(F.lit(0).cast("long").alias(f"n_{k}") for k in KINDS[:4]), F.sha2(F.lit(""), 256).alias("base_sha256"), F.lit("").alias("spans")))


def sanitise(docs: DataFrame, prior: float = PRIOR, remove: float = REMOVE, generalise: float = GENERALISE) -> DataFrame:
    """docs with its own columns; in text, mentions are replaced by their kind and disclosing words are generalised or removed.

    Where replaced spans overlap, the one that starts first stands for all. A null text stays null. n_chars, if there, is not changed.
    """
    plain, hits = annotated(docs, tuple(docs.columns), prior, remove, generalise)
    base = F.transform("base", lambda b: F.struct(b.start.alias("start"), b.end.alias("end"), F.concat(F.lit("["), F.upper(F.element_at(F.array(*map(F.lit, KINDS)), b.kind + 1)), F.lit("]")).alias("by")))
    hits = hits.withColumns({"edits": F.array_sort(F.concat(base, "terms")), "pieces": pieces_of(F.col("text"))})
    text = edited(F.col("pieces"), F.col("length"), F.col("edits"), lambda w: F.when(w.fresh, w.by).otherwise(F.lit("")))
    hits = hits.select("doc", text.alias("clean")).select(*(F.col("clean").alias(c) if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns))
    return plain.select("doc.*").unionByName(hits)


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(read(spark, sf_dir, "documents"))
