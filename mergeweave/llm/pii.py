"""Personal data: found by patterns, then sanitised by what terms disclose. DataFrame functions only.

Patterns give the protected entities: e-mail and IP addresses, card and phone
numbers; and, since most of these stand in one document only, what they belong
to: an address's domain, an IP's network. Words of a text that holds an entity are
terms that may reveal it. Over the whole corpus, with N documents, a term t and an
entity e with document frequencies df(t) and df(e), and df(t, e) documents that
hold both:

    PMI(t; e) = log(N * df(t, e) / (df(t) * df(e)))      what t tells about e
    IC(e)     = log(N / df(e))                           all there is to tell

The ratio of the two is 1 where t occurs only beside e. Terms at ``REMOVE_AT`` or
more are removed, those at ``GENERALISE_AT`` or more are replaced by the class
that their letters show, if so many common documents are not chance: all pairs of
a term and an entity are tested, at a level of ``SIGNIFICANCE`` for all of them
together. Evidence are texts in which the entity has different surroundings, so
that copies reveal nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import stored

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
#: Each finds what the plain pattern in its comment finds, without trying a run of characters from each of its members.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+ of 14 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Characters on either side of an entity that are its surroundings.
WINDOW = 80
#: Probability that any pair at all passes by chance.
SIGNIFICANCE = 0.05
GENERALISE_AT = 0.9
REMOVE_AT = 0.99
#: Matches whose positions are summed at once.
RUN = 256
#: Texts of an entity from which its terms are dealt into parts, and parts at most.
TEXTS, PARTS = 512, 32
#: Entities fall into so many buckets by hash, those in ``LARGE`` documents or more into as many of their own.
BUCKETS, LARGE = 8, 64
#: Letters of a term at least.
TERM = 3
#: Up to so many terms go to all tasks; beyond, they are joined by a shuffle.
BROADCAST_TERMS = 100_000
#: Up to so many documents with terms to look for go to all tasks, with a pattern each; beyond, texts are shuffled to them.
BROADCAST_HITS = 20_000
#: Up to so many texts with entities go to all tasks, 20 bytes each; beyond, texts and their words are shuffled to them.
BROADCAST_TEXTS = 1_000_000
#: Bytes of strings that go to all tasks at most.
BROADCAST_BYTES = 32 << 20


def _broadcast_if_small(rows: DataFrame, string: str, most: int) -> DataFrame:
    """``rows``, a stored table, marked to go to all tasks if it has no more than ``most`` rows and the strings of one column are no longer than ``BROADCAST_BYTES``."""
    n, size = rows.agg(F.count("*"), F.sum(F.octet_length(string))).first()
    return F.broadcast(rows) if n <= most and (size or 0) <= BROADCAST_BYTES else rows


def _may_hold(text: Column, kind: str) -> Column:
    """A cheaper test that is true wherever the pattern matches."""
    return {
        "email": F.contains(text, F.lit("@")),
        "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike(r"[0-9][0-9\x20-]{12}"),
        "phone": F.contains(text, F.lit("+")),
    }[kind]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]++", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return luhn(_digits(value))
    return F.length(_digits(value)).between(10, 15)


def _located(found: Column, pieces: Column) -> Column:
    """Matches and the pieces between them to ``(start, end, value, left, right)``, in code points, end exclusive.

    Positions are sums over all matches before, first within runs of ``RUN``
    matches, then over runs, so that texts with very many don't take time by the
    square.
    """
    around = F.transform(found, lambda m, i: F.struct(F.get(pieces, i).alias("p"), m.alias("m"), F.get(pieces, i + 1).alias("q")))
    kind = "array<struct<start:int,end:int,value:string,left:string,right:string>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["p"])
        end = start + F.length(x["m"])
        one = F.struct(
            start.alias("start"), end.alias("end"), x["m"].alias("value"), F.right(x["p"], F.lit(WINDOW)).alias("left"), F.left(x["q"], F.lit(WINDOW)).alias("right")
        )
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    def join(state: Column, run: Column) -> Column:
        moved = F.transform(run["out"], lambda s: F.struct((s["start"] + state["at"]).alias("start"), (s["end"] + state["at"]).alias("end"), s["value"].alias("value"), s["left"].alias("left"), s["right"].alias("right")))
        return F.struct((state["at"] + run["at"]).alias("at"), F.concat(state["out"], F.array(moved)).alias("out"))

    firsts = F.when(F.size(found) > 0, F.sequence(F.lit(1), F.greatest(F.size(found), F.lit(1)), F.lit(RUN))).otherwise(F.array().cast("array<int>"))
    runs = F.transform(firsts, lambda i: F.aggregate(F.slice(around, i, F.lit(RUN)), zero, step))
    return F.flatten(F.aggregate(runs, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("out")), join)["out"])


def _validator(kind: str):
    return lambda s: _valid(kind, s["value"])


def _ranked(rank: int, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), *[s[n].alias(n) for n in ("end", "value", "left", "right")]))


def _count(rank: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")


def entities(docs: DataFrame) -> DataFrame:
    """``(doc_id, th, spans)`` of every row: th is a hash of the text, spans an array of ``(start, rank, end, value, left, right)`` by start, then kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.select("doc_id", text.alias("text")).withColumn("th", F.xxhash64("text"))
    parts = []
    for rank, kind in enumerate(KINDS):
        pattern = PATTERNS[kind]
        maybe = _may_hold(F.col("text"), kind)
        none = F.array().cast("array<string>")
        out = out.withColumn(f"m{rank}", F.when(maybe, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
        out = out.withColumn(f"p{rank}", F.when(F.size(f"m{rank}") > 0, F.split("text", pattern, -1)).otherwise(none))
        parts.append(_ranked(rank, F.filter(_located(F.col(f"m{rank}"), F.col(f"p{rank}")), _validator(kind))))
    return out.select("doc_id", "th", F.sort_array(F.concat(*parts)).alias("spans"))


def _same(rank: Column, value: Column) -> Column:
    """What makes two spans one entity: letters' case and the marks between digits don't count."""
    return F.when(rank == 0, F.lower(value)).when(rank == 1, value).otherwise(_digits(value))


def _group(rank: Column, value: Column) -> Column:
    """What an entity belongs to: an address's domain, an IP's first three numbers, the first six digits of a card, a phone's digits less the last seven."""
    digits = _digits(value)
    return (
        F.when(rank == 0, F.lower(F.substring_index(value, "@", -1)))
        .when(rank == 1, F.substring_index(value, ".", 3))
        .when(rank == 2, F.substring(digits, 1, 6))
        .otherwise(F.substring(digits, F.lit(1), F.length(digits) - 7))
    )


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}]++", -1), lambda w: F.length(w) >= TERM)


def _chance(k: Column, n: Column, q: Column) -> Column:
    """Hoeffding's bound of the logarithm of the probability of ``k`` or more among ``n``, each with probability ``q``; it holds without replacement too."""
    a = k / n
    rest = F.when(a < 1, (1 - a) * F.log((1 - a) / (1 - q))).otherwise(0.0)
    return F.when(a > q, -n * (a * F.log(a / q) + rest)).otherwise(0.0)


def disclosures(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``(term, ratio)``: the largest ratio of PMI to information content that a term reaches for any entity, at ``GENERALISE_AT`` or more and beyond chance.

    found: the stored result of ``entities``. All documents, all entities, what
    these belong to, and all words are counted. A hash of 64 bits stands for an
    entity.
    """
    spans = found.where(F.size("spans") > 0).select("doc_id", "th", F.explode("spans").alias("s")).select("doc_id", "th", "s.*")
    entity = F.struct(F.lit(0).alias("level"), "rank", _same(F.col("rank"), F.col("value")).alias("value"))
    belongs = F.struct(F.lit(1).alias("level"), "rank", _group(F.col("rank"), F.col("value")).alias("value"))
    base = stored(spans.select("doc_id", "th", F.xxhash64("left", "right").alias("context"), F.xxhash64(entity).alias("own"), F.xxhash64(belongs).alias("of")).distinct(), "base")
    # what one entity alone belongs to tells no more than the entity
    shared = base.groupBy("of").agg(F.min("own").alias("a"), F.max("own").alias("b")).where("a <> b").select("of")
    one, more = base.select("doc_id", "th", "context", F.col("own").alias("e")), base.join(shared, "of", "left_semi").select("doc_id", "th", "context", F.col("of").alias("e"))
    near = stored(one.unionByName(more).distinct(), "near")
    rows = docs.count()
    text = F.coalesce(F.col("text"), F.lit(""))
    holding = stored(near.select("th").distinct(), "holding")
    if holding.count() <= BROADCAST_TEXTS:
        holding = F.broadcast(holding)
    held = docs.select(text.alias("text")).withColumn("th", F.xxhash64("text")).join(holding, "th", "left_semi")
    held = stored(held.select("th", F.array_distinct(_words(F.col("text"))).alias("terms")).dropDuplicates(["th"]), "held")
    # of texts in which an entity has the same surroundings one is evidence
    evidence = near.groupBy("e", "context").agg(F.min("th").alias("th")).select("e", "th").distinct().withColumn("k", F.lit(1))
    pairs = near.groupBy("e", "th").agg(F.countDistinct(F.struct("doc_id")).alias("n")).join(evidence, ["e", "th"], "left").select("e", "th", "n", F.coalesce("k", F.lit(0)).alias("k"))
    pairs = stored(pairs, "pairs")
    tests = pairs.join(held.select("th", F.size("terms").alias("m")), "th").agg(F.sum("m")).first()[0] or 0
    entity = pairs.groupBy("e").agg(F.sum("n").alias("df_e"), F.sum("k").cast("double").alias("all_e")).where(F.col("df_e") < rows)
    level = F.log(F.lit(SIGNIFICANCE / max(1, tests)))
    # No term of an entity has less chance than one that is in all of its texts and nowhere else. Where that one would
    # not pass, as in every entity of a single text unless the corpus has many times more documents than there are tests, none can.
    entity = stored(entity.where(_chance(F.col("all_e"), F.col("all_e"), F.col("all_e") / rows) <= level + 1e-9), "entities")
    # A term occurs in as many documents at least as it stands beside any entity in. An entity's own frequency bounds
    # what stands beside it, so a term's ratio reaches the threshold only if its frequency is at most this; common words drop
    # out before texts go to entities, and no term that qualifies can.
    most = lambda df_e: F.pow(F.lit(float(max(rows, 1))), F.lit(1 - GENERALISE_AT)) * F.pow(df_e, F.lit(GENERALISE_AT)) * (1 + 1e-9)
    # Likewise, of a term's documents the entity must be in the share (df_e / N)^(1 - threshold), and in so many that chance is
    # ruled out if the term is nowhere else. Entities share buckets; a bucket that holds too few of a term's documents
    # holds no entity that the term tells of, and most terms have no other.
    bucket = (F.pmod("e", F.lit(BUCKETS)) + F.when(F.col("df_e") >= LARGE, BUCKETS).otherwise(0)).cast("int")
    entity = entity.withColumn("bucket", bucket).withColumn("bit", F.expr("shiftleft(1, bucket)"))
    share = F.min(F.pow(F.col("df_e") / rows, F.lit(1 - GENERALISE_AT)))
    bounds = entity.groupBy("bit").agg(share.alias("share"), F.min(-level / F.log(F.lit(float(rows)) / F.col("all_e"))).alias("least"), F.max(most(F.col("df_e"))).alias("most")).collect()
    if not bounds:
        return entity.select(F.lit("").alias("term"), F.lit(0.0).alias("ratio")).where("false")
    bits = pairs.join(entity.select("e", "bit"), "e").groupBy("th").agg(F.bit_or("bit").alias("bits"))
    holders = near.select("doc_id", "th").distinct().groupBy("th").agg(F.count("*").alias("times")).join(bits, "th", "left").select("th", "times", F.coalesce("bits", F.lit(0)).alias("bits"))
    holders = stored(holders, "holders")
    if holders.count() <= BROADCAST_TEXTS:
        holders = F.broadcast(holders)
    words_beside = held.join(holders, "th").select("th", "times", "bits", F.explode("terms").alias("term"))
    in_bucket = [F.sum(F.when(F.col("bits").bitwiseAND(b["bit"]) != 0, F.col("times")).otherwise(0)).alias(f"in{b['bit']}") for b in bounds]
    mask = F.lit(0)
    for b in bounds:
        enough = F.greatest(F.col("least_t") * b["share"], F.lit(b["least"])) * (1 - 1e-9)
        mask = mask + F.when((F.col(f"in{b['bit']}") >= enough) & (F.col("least_t") <= b["most"]), b["bit"]).otherwise(0)
    beside = words_beside.groupBy("term").agg(F.sum("times").alias("least_t"), *in_bucket).select("term", "least_t", mask.alias("mask")).where("mask <> 0")
    beside = _broadcast_if_small(stored(beside, "beside"), "term", BROADCAST_TERMS)
    told = words_beside.where("bits <> 0").drop("times").join(beside, "term").where(F.col("bits").bitwiseAND(F.col("mask")) != 0)
    rare = stored(told.groupBy("th").agg(F.collect_list(F.struct("term", "least_t", "mask")).alias("terms")), "rare")
    # Texts go to their entity as lists of the terms that may tell of it, those of an entity with many texts in several
    # parts by the terms' hash, and are counted there: lists are far smaller than rows of an entity and a term.
    spread = F.least(F.lit(PARTS), F.ceil(F.col("df_e") / TEXTS)).cast("int")
    dealt = pairs.join(entity.select("e", "bit", most(F.col("df_e")).alias("most"), spread.alias("parts")), "e").join(rare, "th")
    mine = F.filter("terms", lambda t: (t["mask"].bitwiseAND(F.col("bit")) != 0) & (t["least_t"] <= F.col("most")))
    dealt = dealt.select("e", "n", "k", mine.alias("terms"), "parts").where(F.size("terms") > 0)
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    mine = F.when(F.col("parts") == 1, F.col("terms")).otherwise(F.filter("terms", lambda t: F.pmod(F.hash(t["term"]), F.col("parts")) == F.col("part")))
    joint = (
        dealt.select("e", "part", "n", "k", mine.alias("terms"))
        .repartition("e", "part")
        .select("e", "part", "n", "k", F.explode("terms").alias("t"))
        .groupBy("e", "part", F.col("t.term").alias("term"))
        .agg(F.sum("n").alias("n"), F.sum("k").cast("double").alias("k"), F.max("t.least_t").alias("least_t"))
        .drop("part")
    )

    def ratio(df_t: str) -> Column:
        together = F.least("n", df_t, "df_e").cast("double")
        return F.log(together * rows / (F.col(df_t) * F.col("df_e"))) / F.log(F.lit(float(rows)) / F.col("df_e"))

    def beyond_chance(df_t: str) -> Column:
        # either of the two may be seen as drawn, the other as what is drawn from
        e, t = F.col("all_e"), F.col(df_t).cast("double")
        return F.least(_chance(F.col("k"), e, t / rows), _chance(F.col("k"), t, e / rows)) <= level

    likely = joint.join(entity, "e").where((ratio("least_t") >= GENERALISE_AT) & beyond_chance("least_t"))
    likely = stored(likely.select("term", "n", "df_e", "k", "all_e"), "likely")
    if likely.limit(1).count() == 0:
        return likely.select("term", F.lit(0.0).alias("ratio")).where("false")
    terms = _broadcast_if_small(stored(likely.select("term").distinct(), "terms"), "term", BROADCAST_TERMS)
    words = docs.select(F.explode(F.array_distinct(_words(F.coalesce(F.col("text"), F.lit(""))))).alias("term"))
    frequency = words.join(terms, "term").groupBy("term").agg(F.count("*").alias("df_t"))
    both = likely.join(frequency, "term").where(beyond_chance("df_t")).select("term", ratio("df_t").alias("ratio"))
    return both.where(F.col("ratio") >= GENERALISE_AT).groupBy("term").agg(F.max("ratio").alias("ratio"))


def shape_of(term: Column) -> Column:
    """The class that takes a term's place: what its letters show."""
    return F.when(term.rlike(r"^\p{Lu}{2,}$"), "acronym").when(term.rlike(r"^\p{Lu}"), "name").otherwise("word")


def term_spans(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``(doc_id, th, terms)``: where documents hold the terms, an array of ``(start, end, removed, shape)``; rows without any are left out."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("th", F.xxhash64("text"))
    hits = (
        rows.select("doc_id", "th", F.explode(F.array_distinct(_words(F.col("text")))).alias("term"))
        .join(terms, "term")
        .groupBy("doc_id", "th")
        .agg(F.array_sort(F.collect_set(F.when(F.col("ratio") >= REMOVE_AT, F.col("term")))).alias("out"), F.array_sort(F.collect_set("term")).alias("all"))
        .select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), "out", F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join("all", "|"), F.lit(r")(?!\p{L})")).alias("pattern"))
    )
    hits = _broadcast_if_small(stored(hits, "hits"), "pattern", BROADCAST_HITS)
    held = rows.join(hits, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th")))
    held = held.withColumn("m", F.regexp_extract_all("text", F.col("pattern"), F.lit(0))).withColumn("p", F.split("text", F.col("pattern"), -1))
    located = F.transform(
        _located(F.col("m"), F.col("p")),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.array_contains("out", F.lower(s["value"])).alias("removed"), shape_of(s["value"]).alias("shape")),
    )
    return held.select("doc_id", "th", located.alias("terms")).dropDuplicates(["doc_id", "th"])


def spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, th, spans, terms)`` of each row of ``docs(doc_id, text, ...)``; th is a hash of the text.

    spans: base spans ``(start, rank, end, value, left, right)``, rank by
    ``KINDS``. terms: disclosing terms ``(start, end, removed, shape)`` outside
    base spans. Null and empty texts have none. Rows that repeat each have a result.
    Texts are searched whole, however long. Other columns are ignored, whatever
    their names; an empty table gives an empty result.
    """
    found = stored(entities(docs), "spans")
    terms = stored(disclosures(docs, found), "terms")
    none = F.array().cast("array<struct<start:int,end:int,removed:boolean,shape:string>>")
    if terms.limit(1).count() == 0:
        return found.withColumn("terms", none)
    extra = term_spans(docs, _broadcast_if_small(terms, "term", BROADCAST_TERMS))
    extra = extra.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), F.col("terms").alias("__terms"))
    joined = found.join(extra, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th")), "left")
    outside = F.filter("__terms", lambda t: ~F.exists("spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    return joined.select("doc_id", "th", "spans", F.coalesce(outside, none).alias("terms"))


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs``, with ``text`` in which entities are replaced by their kind in brackets, terms by their class in brackets or, if removed, by nothing.

    All other columns stay as they are, whatever their names; so do null texts
    and those without a span. Repeated rows each have the same result.
    """
    marks = spans(docs)
    kinds = F.array(*map(F.lit, KINDS))
    bracketed = lambda c: F.concat(F.lit("["), c, F.lit("]"))
    masked = F.sort_array(
        F.concat(
            F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), bracketed(F.element_at(kinds, s["rank"] + 1)).alias("mask"))),
            F.transform("terms", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.when(t["removed"], F.lit("")).otherwise(bracketed(t["shape"])).alias("mask"))),
        )
    )
    cuts = marks.select(F.col("doc_id").alias("cut_id"), F.col("th").alias("cut_th"), masked.alias("cuts")).where(F.size("cuts") > 0).dropDuplicates(["cut_id", "cut_th"])
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("id"), "text", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("own"))
    joined = rows.join(cuts, F.col("id").eqNullSafe(F.col("cut_id")) & (F.col("own") == F.col("cut_th")), "left")
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, c: Column) -> Column:
        before = F.substring(F.col("text"), state["at"] + 1, F.greatest(c["start"] - state["at"], F.lit(0)))
        return F.when(c["start"] < state["at"], F.struct(F.greatest(state["at"], c["end"]).alias("at"), state["out"].alias("out"))).otherwise(
            F.struct(c["end"].alias("at"), F.concat(state["out"], F.array(before, c["mask"])).alias("out"))
        )

    done = joined.select("doc", "text", F.when(F.col("cuts").isNotNull(), F.aggregate("cuts", zero, step)).alias("done"))
    rest = F.concat(F.array_join("done.out", ""), F.substring(F.col("text"), F.col("done.at") + 1, F.length("text")))
    new = done.select("doc", F.when(F.col("done").isNull(), F.col("text")).otherwise(rest).alias("new"))
    return new.select(*[F.col("new").alias(c) if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns])


def _listed(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def digests(marks: DataFrame) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` of the result of ``spans``, a row for each of its rows.

    Without spans counts are zero, the hash is that of an empty string and the
    list is empty, for null and empty texts too. An empty table gives an empty result.
    """
    kinds = F.array(*map(F.lit, KINDS))
    base = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), F.element_at(kinds, s["rank"] + 1).alias("kind")))
    terms = F.transform("terms", lambda t: F.struct(t["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), t["end"].alias("end"), F.lit("term").alias("kind")))
    counts = [_count(rank).alias(f"n_{kind}") for rank, kind in enumerate(KINDS)]
    return marks.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.sort_array(F.concat(base, terms))).alias("spans"))
