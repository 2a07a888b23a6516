"""Information-theoretic sanitisation, as DataFrame functions only.

Base spans are e-mail addresses, IPv4 addresses, card numbers (Luhn) and
phone numbers, found by regular expressions, leftmost and non-overlapping per
kind. Every found value is a protected entity e. Counts over all different
texts (equal texts count once) estimate how strongly a term t of a text that
holds e, wherever it stands, gives it away: with N texts, n(e) holding e, n(t)
holding t and n(t,e) holding both, the pointwise mutual information
log(N n(t,e) / (n(t) n(e))) is compared with the entity's information
log(N / n(e)). In each text that holds e, every place of a term that reveals
at least ``generalise`` of it, and stands with it in ``min_texts`` texts or
more, is generalised to its class; from ``remove`` on it is removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.base import cut, let, on_key, row_key, saved, small

#: Kinds in the order of their rank.
KINDS = ("email", "ip", "card", "phone", "term")
LOCAL = "A-Za-z0-9._%+-"
#: The patterns, with possessive repeats (nothing that follows could need a
#: shorter one) and a start that only the first character of a run has, or
#: the end of the match before: same matches, linear time, no recursion.
PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
#: Words of three letters or more, Chinese, Japanese and Korean ones of two.
TERM = r"\p{L}{3,}+|[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]{2,}+"
MIN_TEXTS = 2        # texts in which a term must stand with an entity
GENERALISE, REMOVE = 0.5, 0.9
BROADCAST_ROWS = 500_000
BLOCK = 256


def matches(text: Column, pattern: str) -> Column:
    """array of (s, e, v): all matches with their places in code points.

    The places are running sums of the lengths of matches and of the pieces
    between them, summed in two levels so that the cost stays linear."""
    none = F.array().cast("array<struct<s:int,e:int,v:string>>")

    def place(found):
        gaps = F.transform(F.split(text, pattern, -1), lambda g: F.char_length(g))
        pairs = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda v, g: F.struct(v.alias("v"), g.alias("g"), F.char_length(v).alias("n")))

        def blocks(p):
            count = F.floor((F.size(p) - 1) / BLOCK).cast("int")
            return F.transform(F.sequence(F.lit(0), count), lambda b: F.slice(p, b * BLOCK + 1, F.lit(BLOCK)))

        def sums(bs):
            return F.aggregate(bs, F.array(F.lit(0)), lambda a, b: F.concat(a, F.array(
                F.element_at(a, -1) + F.aggregate(b, F.lit(0), lambda x, y: x + y["g"] + y["n"]))))

        def run(b, at):
            zero = F.struct(at.alias("at"), none.alias("out"))
            return F.aggregate(b, zero, lambda a, y: F.struct((a["at"] + y["g"] + y["n"]).alias("at"), F.concat(a["out"], F.array(F.struct(
                (a["at"] + y["g"]).alias("s"), (a["at"] + y["g"] + y["n"]).alias("e"), y["v"].alias("v")))).alias("out")), lambda a: a["out"])
        return let(pairs, lambda p: let(blocks(p), lambda bs: let(sums(bs), lambda at: F.flatten(
            F.transform(bs, lambda b, i: run(b, F.get(at, i)))))))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda f: F.when(F.size(f) == 0, none).otherwise(place(f)))


def luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def step(a, i):
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return a + F.when(i % 2 == 0, twice).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def valid(kind: str, v: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return ~F.exists(F.split(v, r"\."), lambda p: let(F.regexp_replace(p, "^0+", ""), lambda x: (F.length(x) > 3) | ((F.length(x) == 3) & (x > "255"))))
    digits = F.regexp_replace(v, "[^0-9]", "")
    if kind == "card":
        return let(digits, lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False))
    return F.length(digits).between(9, 15)


def base_spans(text: Column) -> Column:
    """array of (s, k, e, v) of all valid matches, by start, then kind."""
    parts = []
    for k, kind in enumerate(KINDS[:4]):
        found = matches(text, PATTERNS[kind])
        kept = F.transform(F.filter(found, lambda m: valid(kind, m["v"])), lambda m: F.struct(
            m["s"].alias("s"), F.lit(k).alias("k"), m["e"].alias("e"), m["v"].alias("v")))
        if kind in NEEDS:
            none = F.array().cast("array<struct<s:int,k:int,e:int,v:string>>")
            kept = F.when(F.contains(text, F.lit(NEEDS[kind])), kept).otherwise(none)
        parts.append(kept)
    return F.array_sort(F.concat(*parts))


def entity(sp: Column) -> Column:
    """Hash of a found value, upper and lower case and separators aside."""
    return F.xxhash64(sp["k"], F.lower(F.when(sp["k"] == 0, sp["v"]).otherwise(F.regexp_replace(sp["v"], "[^0-9.]", ""))))


def terms(text: Column, spans: Column) -> Column:
    """array of (term, s, e): the terms of a text with base spans, outside
    its addresses (no other kind has letters); term is the hash of the
    lower-cased term."""
    none = F.array().cast("array<struct<term:bigint,s:int,e:int>>")
    found = F.transform(matches(text, TERM), lambda m: F.struct(F.xxhash64(F.lower(m["v"])).alias("term"), m["s"].alias("s"), m["e"].alias("e")))
    outside = let(F.filter(spans, lambda sp: sp["k"] == 0), lambda mails: F.filter(found, lambda t: ~F.exists(
        mails, lambda sp: (t["s"] < sp["e"]) & (t["e"] > sp["s"]))))
    return F.when(F.size(spans) > 0, outside).otherwise(none)


def texts_of(weight: Column) -> Column:
    """Number of different texts: the rows of a text weigh one together."""
    return F.round(F.sum(weight))


def sanitise(docs: DataFrame, doc: str = "doc_id", text: str = "text", generalise: float = GENERALISE,
             min_texts: int = MIN_TEXTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, th (text hash), base (array of
    s, k, e, v) and spans (array of s, k, e, score; k indexes KINDS, 4 is an
    added term), by start, then kind. ``sanitised_text`` applies the spans
    to a text. Null text counts as empty; spans of different kinds may
    overlap; rows repeated in full get equal results; an empty table gives
    an empty one."""
    rows = docs.select(*row_key(doc, text), F.coalesce(F.col(text), F.lit("")).alias("text"))
    copies = cut(rows.groupBy("th").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    copies = small(copies, BROADCAST_ROWS)
    weight = F.lit(1.0) / F.coalesce("n", F.lit(1))
    packed = let(base_spans(F.col("text")), lambda b: F.struct(b.alias("base"), terms(F.col("text"), b).alias("terms")))
    found = saved(rows.select("doc_id", "th", packed.alias("p")).select("doc_id", "th", "p.base", "p.terms"))
    total = float(found.select("th").distinct().count())

    # entities of one text only stand with each of its terms once: no pairs to count
    held = found.where(F.size("base") > 0).join(copies, "th", "left").select(
        "doc_id", "th", weight.alias("w"), F.array_distinct(F.transform("base", entity)).alias("ents"), "terms")
    each = held.select("doc_id", "th", "w", F.explode("ents").alias("ent"))
    ents = cut(each.groupBy("ent").agg(texts_of(F.col("w")).alias("n_e")))
    of = each.join(small(ents, BROADCAST_ROWS), "ent").groupBy("doc_id", "th").agg(
        F.max(F.col("n_e") == 1).alias("once"), F.collect_set(F.when(F.col("n_e") > 1, F.col("ent"))).alias("again"))
    held = on_key(held, of).withColumn("once", F.col("once") & F.lit(min_texts <= 1))
    held = saved(held.where(F.col("once") | (F.size("again") > 0)).select("doc_id", "th", "w", "once", "again", "terms"))
    both = held.select("w", F.explode("again").alias("ent"), F.array_distinct("terms.term").alias("t")).select("w", "ent", F.explode("t").alias("term"))
    pair = cut(both.groupBy("ent", "term").agg(texts_of(F.col("w")).alias("n_te")).where(F.col("n_te") >= min_texts))

    lone = held.where("once").select(F.explode(F.array_distinct("terms.term")).alias("term"))
    wanted = cut(pair.select("term").union(lone).distinct())
    words = F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)), lambda w: F.xxhash64(F.lower(w))))
    seen = rows.select("th", words.alias("t")).join(copies, "th", "left").select(weight.alias("w"), F.explode("t").alias("term"))
    if wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:  # else all terms are counted, by partial aggregation
        seen = seen.join(F.broadcast(wanted), "term", "left_semi")
    n_t = cut(seen.groupBy("term").agg(texts_of(F.col("w")).alias("n_t")).join(wanted, "term", "left_semi"))

    def scores(df):
        pmi = F.ln(F.lit(total) * F.col("n_te") / (F.col("n_t") * F.col("n_e")))
        info = F.ln(F.lit(total) / F.col("n_e"))
        score = F.when(info > 0, pmi / info).otherwise(F.lit(0.0))
        return small(cut(df.withColumn("score", score).where(F.col("score") >= generalise).drop("n_te", "n_t", "n_e")), BROADCAST_ROWS)

    places = held.select("doc_id", "th", "once", "again", F.explode("terms").alias("t")).select("doc_id", "th", "once", "again", "t.*")
    alone = scores(n_t.withColumns({"n_te": F.lit(1.0), "n_e": F.lit(1.0)}))
    alone = places.where("once").join(alone, "term").select("doc_id", "th", "s", "e", "score")
    shared = scores(pair.join(n_t, "term").join(ents, "ent"))
    shared = places.select("doc_id", "th", "term", "s", "e", F.explode("again").alias("ent")).join(shared, ["ent", "term"])
    added = alone.union(shared.select("doc_id", "th", "s", "e", "score")).groupBy("doc_id", "th", "s", "e").agg(F.max("score").alias("score"))
    added = added.groupBy("doc_id", "th").agg(F.collect_list(F.struct("s", F.lit(4).alias("k"), "e", "score")).alias("added"))

    base = F.transform("base", lambda b: F.struct(b["s"].alias("s"), b["k"].alias("k"), b["e"].alias("e"), F.lit(None).cast("double").alias("score")))
    none = F.array().cast("array<struct<s:int,k:int,e:int,score:double>>")
    out = on_key(found, added).select("doc_id", "th", "base", F.array_sort(F.concat(base, F.coalesce("added", none))).alias("spans"))
    return out


def sanitised_text(text: Column, spans: Column, remove: float = REMOVE) -> Column:
    """``text`` with its spans replaced: base kinds and generalised terms by
    a label, terms that reveal at least ``remove`` by nothing."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    labels = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(a, s):
        label = F.when((s["k"] == 4) & (s["score"] >= remove), F.lit("")).otherwise(F.get(labels, s["k"]))
        more = F.concat(a["out"], F.array(F.substring(text, a["at"] + 1, s["s"] - a["at"]), label))
        return F.when(s["s"] >= a["at"], F.struct(s["e"].alias("at"), more.alias("out"))).otherwise(a)
    return F.aggregate(spans, zero, step, lambda a: F.array_join(F.concat(a["out"], F.array(F.substring(text, a["at"] + 1, F.char_length(text)))), ""))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["k"]), s["s"].cast("string"), s["e"].cast("string"))), ",")
