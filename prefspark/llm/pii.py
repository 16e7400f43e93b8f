"""Personal data by information-theoretic sanitisation (operator 4). DataFrame functions only.

Protected entities are the base spans: email and IP addresses, card and phone numbers. The terms
(runs of three letters or more) of a document that holds an entity, wherever they stand, are seen
with it. Of all ``N`` documents of the corpus, with entities or without, ``n(t)`` hold term t,
``n(e)`` entity e and ``n(t, e)`` both. The pointwise mutual information
log2(n(t,e) N / (n(t) n(e))) tells how strongly t reveals e. A term with ``BITS`` bits, half of its
own documents at e and at least ``SUPPORT`` distinct texts with e exceeds the disclosure threshold
and becomes a span too, at all its places in every document that holds e. Copies count once for the
support. Comparisons are on whole numbers, so every engine agrees on them.

``sanitise`` generalises: an entity becomes its kind, a revealing term ``[TERM]``.

Positions come from the pieces between matches (``split``) and the matches themselves. The
patterns match what the plain ones match, but cannot go back over a long run of characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefspark.llm.common import materialize, packed, text_of

KINDS = ["email", "ip", "card", "phone"]
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Runs of three letters or more that are no part of an address, a host or a code.
TERM = r"(?<![\p{L}0-9._%+@-])\p{L}{3,}+(?![0-9_%+@]|[.-][A-Za-z0-9])"
SUPPORT = 3
BITS = 3
OCTET = "^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$"
FOUND = "array<struct<kind:int,i:int,gap:int,value:string>>"
SPAN = "struct<kind:int,start:int,end:int,value:string>"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(number, i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when((F.length(number) - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(OCTET)
    n = F.length(digits(value))
    if kind == "card":
        return F.when(n.between(13, 19), luhn(digits(value))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def candidates(text: Column) -> Column:
    """Every match of every pattern, with its place among the matches of its kind.

    ``gap`` is the length of what lies between the match before and this one. Nothing here goes
    over the text once per match.
    """

    def of(k: int, kind: str) -> Column:
        need = {"email": text.contains("@"), "phone": text.contains("+"), "ip": text.contains(".")}.get(kind, F.lit(True))
        found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
        gaps = F.split(text, PATTERNS[kind], -1)
        zipped = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("before"), found.alias("value"))

        def one(x: Column, i: Column) -> Column:
            return F.struct(F.lit(k).alias("kind"), i.alias("i"), F.length(x["before"]).alias("gap"), x["value"].alias("value"))

        return F.when(need & (F.size(found) > 0), F.transform(zipped, one)).otherwise(F.array().cast(FOUND))

    return F.concat(*[of(k, kind) for k, kind in enumerate(KINDS)])


def _valid(match: Column) -> Column:
    """Whether a match with its ``kind`` and ``value`` is one."""
    out = F.lit(True)
    for k, kind in enumerate(KINDS):
        out = F.when(match["kind"] == k, valid(kind, match["value"])).otherwise(out)
    return out


def terms_of(text: Column) -> Column:
    """The distinct terms of a text, in lower case."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)))
    return F.array_distinct(F.transform(found, F.lower))


def _places(texts: DataFrame) -> DataFrame:
    """``(row, term, start, end)`` of every term of ``texts(row, text)``; linear in the text."""
    found = F.regexp_extract_all("text", F.lit(TERM), F.lit(0))
    gaps = F.slice(F.split("text", TERM, -1), F.lit(1), F.size(found))
    zipped = F.zip_with(gaps, found, lambda g, v: F.struct(F.length(g).alias("gap"), F.length(v).alias("size"), F.lower(v).alias("term")))
    each = texts.select("row", F.posexplode(zipped).alias("i", "m")).select("row", "i", "m.*")
    so_far = Window.partitionBy("row").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far).cast("int"))
    return each.select("row", "term", (F.col("end") - F.col("size")).alias("start"), "end")


def revealing(entities: DataFrame, texts: DataFrame, every: DataFrame, n: int, support: int = SUPPORT, bits: int = BITS) -> DataFrame:
    """``(row, term)``: the terms above the disclosure threshold of an entity of their row.

    ``entities(row, key, entity)`` are those of each row, ``texts(row, text)`` the rows that hold
    one, and ``every(text)`` the ``n`` texts that terms are counted in. A pair above the
    threshold has n_t <= 2 n_e, and neither count is above n / 2**bits: all others are left out
    before pairs are made.
    """
    most = n >> bits
    by_entity = entities.groupBy("entity", "key").agg(F.count("*").alias("c")).groupBy("entity").agg(F.sum("c").alias("n_e"), F.count("*").alias("held"))
    by_entity = by_entity.where((F.col("held") >= support) & (F.col("n_e") <= most)).select("entity", "n_e")
    near = materialize(entities.join(by_entity, "entity"), "pii_entities")
    limit = min(most, 2 * (near.agg(F.max("n_e")).first()[0] or 0))
    by_term = every.select(F.explode(terms_of(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    by_term = materialize(by_term.where(F.col("n_t") >= support), "pii_terms")
    # Terms of more than one text in 64 are at most 64 times those of a mean text.
    common = by_term.where((F.col("n_t") > limit) & (F.col("n_t") > n >> 6)).select("term")
    own = texts.join(near.select("row").distinct(), "row", "left_semi").select("row", F.explode(terms_of(F.col("text"))).alias("term"))
    own = own.join(F.broadcast(common), "term", "left_anti").join(by_term.where(F.col("n_t") <= limit), "term")
    own = materialize(own, "pii_own_terms")

    pairs = materialize(class_pairs(with_class(near, "entity", "e"), with_class(own, "term", "t")), "pii_pairs")
    both = ["e1", "e2", "t1", "t2"]
    counts = pairs.groupBy(*both, "key").agg(F.count("*").alias("c"), F.first("n_e").alias("n_e"), F.first("n_t").alias("n_t"))
    counts = counts.groupBy(*both).agg(F.sum("c").alias("n_te"), F.count("*").alias("held"), F.first("n_e").alias("n_e"), F.first("n_t").alias("n_t"))
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    above = (wide("n_te") * F.lit(n).cast("decimal(18,0)") >= wide("n_t") * wide("n_e") * F.lit(1 << bits)) & (F.col("n_te") * 2 >= F.col("n_t"))
    flagged = counts.where((F.col("held") >= support) & above).select(*both)
    shown = pairs.join(flagged, both).select("row", "t1", "t2").distinct()
    return with_class(own, "term", "t").join(shown, ["row", "t1", "t2"]).select("row", "term")


def with_class(rows: DataFrame, what: str, name: str) -> DataFrame:
    """``rows`` plus the class of each value of ``what``: the set of rows that hold it, by two hashes.

    Values of one class are counted together: what holds for one of them holds for all.
    """
    sets = rows.groupBy(what).agg(F.bit_xor(F.xxhash64("row")).alias(f"{name}1"), F.bit_xor(F.xxhash64(F.lit(1), "row")).alias(f"{name}2"))
    return rows.join(sets, what)


def class_pairs(near: DataFrame, own: DataFrame) -> DataFrame:
    """``(row, key, e1, e2, n_e, t1, t2, n_t)``: classes of entities and of terms that share a row.

    Pairs are made of classes, not of values: a list of contacts that stands in a few copies has
    few of them, however many addresses and words it holds.
    """
    entities = near.select("row", "key", "e1", "e2", "n_e").distinct()
    terms = own.select("row", "t1", "t2", "n_t").distinct()
    return terms.join(entities, "row").where(F.col("n_t") <= 2 * F.col("n_e"))


def _spans(docs: DataFrame, id_col: str, text_col: str, support: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """The rows ``(row, id, key)`` and their spans ``(row, kind, start, end, value)``, terms included."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = rows.select("row", "id", F.xxhash64("text").alias("key"), "text", candidates(F.col("text")).alias("found"))
    rows = materialize(rows.withColumn("text", F.when(F.exists("found", _valid), F.col("text"))), "pii_candidates")
    texts = rows.where("text is not null").select("row", "text")
    each = rows.where("text is not null").select("row", "key", F.inline("found"))
    so_far = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("end", F.sum(F.col("gap") + F.length("value")).over(so_far).cast("int")).withColumn("start", F.col("end") - F.length("value"))
    value = F.when(F.col("kind") == 0, F.lower("value")).otherwise(digits(F.col("value")))
    entity = F.concat(F.col("kind").cast("string"), F.lit(":"), value)
    each = each.where(_valid(F.struct("kind", "value")))
    base = materialize(each.select("row", "key", "kind", "start", "end", "value", entity.alias("entity")), "pii_spans")
    every = docs.select(text_of(text_col).alias("text"))
    hits = materialize(revealing(base.select("row", "key", "entity").distinct(), texts, every, rows.count(), support, bits), "pii_hits")
    terms = _places(texts.join(hits.select("row").distinct(), "row", "left_semi")).join(hits, ["row", "term"])
    terms = terms.select("row", F.lit(len(KINDS)).alias("kind"), "start", "end", F.col("term").alias("value"))
    return rows.select("row", "id", "key"), base.select("row", "kind", "start", "end", "value").unionByName(terms)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT, bits: int = BITS) -> DataFrame:
    """``(id, key, base, terms)`` per input row: base spans and revealing terms, with their values.

    ``key`` is a hash of the text. Null and empty texts have no spans; repeated rows repeat
    their result (and count once for the support of a term).
    """
    rows, spans = _spans(docs, id_col, text_col, support, bits)
    lists = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end", "value"))).alias("all"))
    every = F.coalesce("all", F.array().cast(f"array<{SPAN}>"))
    term = len(KINDS)
    return rows.join(lists, "row", "left").select("id", "key", F.filter(every, lambda s: s["kind"] < term).alias("base"), F.filter(every, lambda s: s["kind"] == term).alias("terms"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT, bits: int = BITS) -> DataFrame:
    """``docs`` with every span generalised in ``text_col``; overlapping spans become one."""
    rows, spans = _spans(docs, id_col, text_col, support, bits)
    by = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("reached", F.coalesce(F.max("end").over(by), F.lit(0))).where("end > reached")
    # A span inside one before it is gone; one that only overlaps it lengthens it.
    cuts = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind", "reached"))).alias("_p_cuts"))
    cuts = rows.join(cuts, "row").select(F.col("id").alias("_p_id"), F.col("key").alias("_p_key"), "_p_cuts").dropDuplicates(["_p_id", "_p_key"])
    text = F.col("text")
    out = packed(docs, id=F.col(id_col), key=F.xxhash64(text_of(text_col)), text=F.col(text_col))
    out = out.join(cuts, F.col("id").eqNullSafe(F.col("_p_id")) & (F.col("key") == F.col("_p_key")), "left")
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in [*KINDS, "term"]])
    chars = F.split(text, "")
    piece = lambda a, n: F.array_join(F.slice("_p_chars", a + 1, n), "")
    kept = F.transform("_p_cuts", lambda s: F.when(s["start"] >= s["reached"], F.concat(piece(s["reached"], s["start"] - s["reached"]), F.get(names, s["kind"]))).otherwise(""))
    rest = piece(F.element_at("_p_cuts", -1)["end"], F.size("_p_chars"))
    out = out.withColumn("_p_chars", F.when(F.col("_p_cuts").isNotNull(), chars))
    clean = F.when(F.col("_p_cuts").isNotNull(), F.concat(F.array_join(kept, ""), rest)).otherwise(text)
    return out.select(F.col("row").withField(f"`{text_col}`", clean).alias("row")).select("row.*")


def listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in [*KINDS, "term"]])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find(docs)
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    n = [number(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select(F.col("id").alias("doc_id"), *n, F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.concat("base", "terms")).alias("spans"))
